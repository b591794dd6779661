"""Price and amount expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capped(price, cap) -> Column:
    """min(price, cap); a null cap (no positive prices) leaves prices unchanged.
    The result is double even for a decimal price (the cap is a double)."""
    cap = cap if isinstance(cap, Column) else F.lit(cap).cast("double")
    return F.when(_c(price) > cap, cap).otherwise(_c(price))


def vat(price="unit_price", qty="quantity", rate: float = config.VAT_RATE,
        decimals: int = config.VAT_DECIMALS) -> Column:
    """round(price * qty * rate, 2), rounding half up, kept in double."""
    return F.round(_c(price) * _c(qty) * F.lit(rate), decimals)


def line_amount(price="unit_price", qty="quantity") -> Column:
    return _c(price) * _c(qty)
