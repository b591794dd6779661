"""Column expressions (all built-in, JVM-side, codegen-friendly)."""
from .dates import date_key, month_label, month_of_parts, sale_date, month_range
from .money import capped, vat, line_amount
from .quantile import exact_quantile, approx_quantile, median_price

__all__ = ["date_key", "month_label", "month_of_parts", "sale_date", "month_range",
           "capped", "vat", "line_amount", "exact_quantile", "approx_quantile", "median_price"]
