"""Date and time column functions (all built-in Spark expressions).

Each helper takes and returns ``Column`` objects so it stays inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Text formats of the source systems.
# Series dates arrive as day/month/year text ("31/01/2024"); single-digit
# day and month are accepted as well.
SERIES_DATE_PATTERN = "d/M/yyyy"
# Extraction windows are sent to the series API as zero-padded day/month/year.
SERIES_WINDOW_PATTERN = "dd/MM/yyyy"
# The default watermark when nothing was loaded yet.
EPOCH_TEXT = "1970-01-01T00:00:00"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_series_date(c: ColumnOrName, permissive: bool = False) -> Column:
    """``dd/mm/yyyy`` text → ``date``.

    Strict mode fails the job on an impossible date (``31/02/2023``), as the
    warehouse's ``parse_date`` does; ``permissive`` yields NULL instead.
    """
    if permissive:
        return F.try_to_date(_col(c), SERIES_DATE_PATTERN)
    return F.to_date(_col(c), SERIES_DATE_PATTERN)


def series_date_text(c: ColumnOrName) -> Column:
    """``date`` → zero-padded ``dd/MM/yyyy`` text."""
    return F.date_format(_col(c), SERIES_WINDOW_PATTERN)


def sunday_week(c: ColumnOrName) -> Column:
    """Week of the year with weeks starting on Sunday, 0–53.

    Days before the year's first Sunday are week 0.  This is *not*
    ``weekofyear`` (ISO weeks start on Monday and can belong to the previous
    year).
    """
    d = _col(c)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("bigint")


def is_weekend(c: ColumnOrName) -> Column:
    """True on Saturday and Sunday (``dayofweek`` is 1 on Sunday, 7 on Saturday)."""
    return F.dayofweek(_col(c)).isin(1, 7)


def month_name(c: ColumnOrName) -> Column:
    """English month name, e.g. ``January``."""
    return F.date_format(_col(c), "MMMM")


def day_name(c: ColumnOrName) -> Column:
    """English weekday name, e.g. ``Sunday``."""
    return F.date_format(_col(c), "EEEE")


def month_start(year: ColumnOrName, month: ColumnOrName) -> Column:
    """First day of the month, ``date(year, month, 1)``."""
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), F.lit(1))


def iso_text(c: ColumnOrName) -> Column:
    """Timestamp → ISO-8601 text as Python's ``isoformat`` writes it.

    ``2024-01-01T00:00:07.179575``; the fraction is left out when it is zero
    (``1998-10-03T00:00:00``).
    """
    moment = _col(c)
    whole = F.unix_micros(moment.cast("timestamp")) % 1_000_000 == 0
    return F.when(whole, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def iso_date_text(c: ColumnOrName) -> Column:
    """Date → ``yyyy-MM-dd`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def window_start(run_date: ColumnOrName, days: int = 3 * 365) -> Column:
    """Start of the sliding extraction window ending at ``run_date``."""
    return F.date_sub(_col(run_date), days)
