"""Defaults of the cleaning and modelling rules.

Fixed values: these define the business rules and must keep these values for
results to match the published tables.
"""

# Fixed values (rule constants)
CAP_FACTOR = 5            # a unit price above CAP_FACTOR x median price is capped to it
VAT_RATE = 0.2            # VAT = round(unit_price * quantity * VAT_RATE, 2)
VAT_DECIMALS = 2
QUANTILE_ERROR = 0.05     # relative error of the approximate median price
UNKNOWN_METHOD = "Unknown"
DEFAULT_METHOD = "Card"   # payment method that replaces UNKNOWN_METHOD
FLOOR_TOTAL = 0.01        # total of a zero-total sale that has no cleaned lines
METHOD_DESCRIPTION_PREFIX = "Payment via "

# Layer and table names of the lake layout: (step, layer)
RAW_TX = ("raw", "transactions")
RAW_REF = ("raw", "reference")
RAW_KEYS = ("raw", "keys")
RAW_REJECTED = ("raw", "rejected")
CLEANED_TX = ("cleaned", "transactions")
CURATED = ("curated", "analytics")
SERVING = ("serving", "aggregated")
