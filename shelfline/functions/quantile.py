"""Quantiles of one numeric column.

``approx_quantile`` is a lazy scalar subquery over ``percentile_approx``: one
pass, sketches built per partition and merged, bounded memory.  It is the
default median of the cleaning rules.

``exact_quantile`` has ``percentile_disc`` semantics (the smallest value whose
cumulative share reaches q).  It is a most-significant-digit radix selection
over an order-preserving 64-bit key of the double: at most four passes, each a
group-by into at most 65,536 buckets with map-side partial counts.  A hot value
that holds a third of all rows is counted map-side before any shuffle, and no
task or driver ever holds more than one 65,536-row histogram.  The buckets are
a bounded reduction, not a sample: the answer is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config

DIGIT_BITS = 16
_MIN_LONG = -(1 << 63)
_MAX_LONG = (1 << 63) - 1
_MANTISSA = float(1 << 52)


def with_order_key(df: DataFrame, column: str, out: str = "_key") -> DataFrame:
    """Adds ``out``: a signed 64-bit key with key(a) < key(b) exactly when
    a < b for doubles (NaN sorts last, -0.0 equals 0.0).  It is the IEEE-754
    bit pattern of |x| (negated for negative x), built with exact arithmetic
    on powers of two.  Each step is its own projection so that every
    sub-expression is evaluated once (and generated code stays small)."""
    a = F.abs(F.col(column).cast("double"))
    finite = (a > 0) & ~F.isnan(a) & (a < F.lit(float("inf")))
    keep = [c for c in df.columns]
    df = df.select(*keep, F.when(finite, a).otherwise(F.lit(1.0)).alias("_s"))
    df = df.select(*keep, "_s", F.floor(F.log2("_s")).cast("int").alias("_e0"))
    df = df.select(*keep, "_s", "_e0", F.pow(F.lit(2.0), F.col("_e0")).alias("_p0"))
    # log2 may be one off next to a power of two; fix with exact comparisons
    s, e0, p0 = F.col("_s"), F.col("_e0"), F.col("_p0")
    df = df.select(*keep, "_s", F.when(p0 > s, e0 - 1).when(p0 * 2.0 <= s, e0 + 1).otherwise(e0).alias("_e"))
    e = F.col("_e")
    normal = e >= -1022
    field = F.when(normal, e + 1023).otherwise(F.lit(0)).cast("long")
    mant = F.when(normal, (s / F.pow(F.lit(2.0), e) - 1.0) * _MANTISSA) \
        .otherwise(s * F.lit(2.0 ** 1022) * _MANTISSA).cast("long")
    df = df.select(*keep, (F.shiftleft(field, 52) + mant).alias("_bits"))
    x = F.col(column).cast("double")
    bits = (F.when(F.abs(x) == 0, F.lit(0).cast("long"))
            .when(F.abs(x) == F.lit(float("inf")), F.lit(2047 << 52).cast("long"))
            .otherwise(F.col("_bits")))
    key = F.when(F.isnan(x), F.lit(_MAX_LONG)).when(x < 0, -bits - 1).otherwise(bits)
    return df.select(*keep, key.alias(out))


def exact_quantile(df: DataFrame, column: str, q: float = 0.5):
    """Exact ``percentile_disc(q)`` of the non-null values of ``column``;
    ``None`` when there are none.  Runs at most four small aggregation jobs.

    Each pass groups every row by "its next digit if its higher digits
    equal the chosen prefix, else null", so no predicate over the key is
    pushed below the key's projections."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    keyed = with_order_key(values, "v", "_k").select(
        "v", F.col("_k").bitwiseXOR(F.lit(_MIN_LONG)).alias("u"))
    prefix = None
    rank = None
    mask = (1 << DIGIT_BITS) - 1
    lo = None
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        digit = F.shiftrightunsigned("u", shift).bitwiseAND(F.lit(mask))
        if prefix is not None:
            digit = F.when(F.shiftrightunsigned("u", shift + DIGIT_BITS) == F.lit(prefix), digit)
        hist = sorted((r for r in keyed.groupBy(digit.alias("d"))
                       .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                       .collect() if r["d"] is not None), key=lambda r: r["d"])
        if rank is None:
            total = sum(r["n"] for r in hist)
            if total == 0:
                return None
            rank = max(1, math.ceil(q * total))
        below = 0
        for r in hist:
            if below + r["n"] >= rank:
                break
            below += r["n"]
        rank -= below
        lo = r["lo"]
        if lo == r["hi"]:
            return lo
        prefix = r["d"] if prefix is None else (prefix << DIGIT_BITS) | r["d"]
    return lo


def approx_quantile(df: DataFrame, column: str, q: float = 0.5,
                    relative_error: float = config.QUANTILE_ERROR) -> Column:
    """Lazy scalar: ``percentile_approx`` with accuracy 1/relative_error."""
    accuracy = max(1, math.ceil(1.0 / relative_error)) if relative_error > 0 else 1_000_000
    return df.select(F.percentile_approx(F.col(column).cast("double"), q, accuracy)).scalar()


def median_price(df: DataFrame, column: str = "unit_price", method: str = "approx",
                 relative_error: float = config.QUANTILE_ERROR) -> Column:
    """Median of the positive values of ``column`` as a Column (F2 + A3).

    ``approx``: lazy sketch (the rules' default); ``exact``: percentile_disc,
    evaluated now and inlined as a literal (null when no positive value)."""
    positive = df.where(F.col(column) > 0)
    if method == "approx":
        return approx_quantile(positive, column, 0.5, relative_error)
    if method == "exact":
        m = exact_quantile(positive, column, 0.5)
        return F.lit(m).cast("double")
    raise ValueError(f"unknown median method {method!r}")
