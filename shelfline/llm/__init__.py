"""Operators for large text corpora: scans, filters, deduplication, mixing.

Nothing else in the library imports this subpackage.  Functions that run inside
Python tasks are shipped by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
