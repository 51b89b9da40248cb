"""Column-level helpers built from ``pyspark.sql.functions`` only."""

from tributary.functions.dates import (
    EPOCH_TEXT, day_name, iso_date_text, iso_text, is_weekend, month_name,
    month_start, parse_series_date, series_date_text, sunday_week, window_start)
from tributary.functions.numeric import (
    MONEY_TYPE, coerce_double, coerce_kind, coerce_long, comma_decimal,
    decimal_comma_text, growth_factor, money, money_sum, safe_ratio_pct,
    seasonal_factor)

__all__ = [
    "EPOCH_TEXT", "MONEY_TYPE", "coerce_double", "coerce_kind", "coerce_long",
    "comma_decimal", "day_name", "decimal_comma_text", "growth_factor",
    "iso_date_text", "iso_text", "is_weekend", "money", "money_sum",
    "month_name", "month_start", "parse_series_date", "safe_ratio_pct",
    "seasonal_factor", "series_date_text", "sunday_week", "window_start",
]
