"""Numeric column functions: money sums, safe ratios, text→number coercion."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Money columns in the source system are NUMERIC(10,2).  Sums run on the
# exact decimal type and are turned into double only at the edge, so the
# result does not depend on the order in which partitions are combined.
MONEY_TYPE = "decimal(18,2)"
# Amounts below this are summed as whole cents: 2^63 cents are reached by no fewer than 9e10 of them.
CENTS_BELOW = 1e6


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnOrName) -> Column:
    """Cast a money value to its exact decimal type."""
    return _col(c).cast(MONEY_TYPE)


def _cents(c: ColumnOrName) -> tuple[Column, Column]:
    """(cents of an amount as a long, whether it is a whole number of them and not large).

    A double that is the one nearest to a whole number of cents reads as that
    number of cents.  Others (more digits, large amounts) have to be cast to a
    decimal type, which costs a conversion by text.
    """
    value = _col(c).cast("double")
    cents = F.rint(value * 100)
    return cents.cast("bigint"), (cents / 100 == value) & (F.abs(value) < CENTS_BELOW)


def money_of(c: ColumnOrName, digits: int) -> Column:
    """``cast(c as decimal(digits, 2))``, without a conversion by text for whole cents."""
    kind = f"decimal({digits},2)"
    cents, whole = _cents(c)
    return F.when(whole, (cents.cast(f"decimal({digits},0)") * F.lit(Decimal("0.01"))).cast(kind)).otherwise(_col(c).cast(kind))


def money_sum(c: ColumnOrName) -> Column:
    """Exact sum of a money column, returned as double; NULL if it has no value.

    Whole cents are added up as longs, other amounts as decimals.
    """
    cents, whole = _cents(c)
    in_cents = F.sum(F.when(whole, cents))
    others = F.sum(F.when(~whole, money(c)))
    nothing = F.lit(0).cast("decimal(18,2)")
    total = F.coalesce(in_cents.cast("decimal(19,0)") * F.lit(Decimal("0.01")), nothing) + F.coalesce(others, nothing)
    return F.when(in_cents.isNotNull() | others.isNotNull(), total.cast("double"))


def safe_ratio_pct(numerator: ColumnOrName, denominator: ColumnOrName,
                   digits: int = 2) -> Column:
    """``round(numerator / denominator * 100, digits)``; NULL when the
    denominator is zero or NULL (never an error, also under ANSI mode)."""
    return F.round(F.try_divide(_col(numerator), _col(denominator)) * 100, digits)


def comma_decimal(c: ColumnOrName, permissive: bool = False) -> Column:
    """Text with a decimal comma (``"5,1234"``) → double.

    Strict mode fails on a malformed number, permissive mode yields NULL.
    """
    text = F.replace(_col(c).cast("string"), F.lit(","), F.lit("."))
    return text.try_cast("double") if permissive else text.cast("double")


def decimal_comma_text(c: ColumnOrName) -> Column:
    """Number → text with a decimal comma (inverse of ``comma_decimal``)."""
    return F.replace(_col(c).cast("string"), F.lit("."), F.lit(","))


# An integer cell as Python's int() reads it: optional blanks and sign, digits.
_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
# A decimal cell as Python's float() reads it.  The cast alone would also take type suffixes ("5D", "12f").
_FLOAT_TEXT = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def coerce_long(c: ColumnOrName) -> Column:
    """The cell as bigint when it is an integer, else NULL.

    The pattern test runs first, so non-numeric text never reaches the cast
    (a failed cast is far more expensive than a regex test).
    """
    v = _col(c)
    return F.when(v.rlike(_INT_TEXT), F.trim(v).try_cast("bigint"))


def coerce_double(c: ColumnOrName) -> Column:
    """The cell as double when it is any number (integer or not), else NULL."""
    v = _col(c)
    return F.when(v.rlike(_FLOAT_TEXT), F.trim(v).try_cast("double"))


def coerce_kind(c: ColumnOrName) -> Column:
    """Which type a text cell parses as: ``int``, then ``float``, else ``string``.

    NULL stays NULL.  Integer parsing trims surrounding blanks, as the
    loader's ``int()`` does.
    """
    v = _col(c)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(coerce_long(v).isNotNull(), F.lit("int"))
            .when(coerce_double(v).isNotNull(), F.lit("float"))
            .otherwise(F.lit("string")))


def growth_factor(year: ColumnOrName, base_year: ColumnOrName | int,
                  rate: float) -> Column:
    """Compound growth ``(1 + rate) ** (year - base_year)``."""
    base = F.lit(base_year) if isinstance(base_year, int) else _col(base_year)
    return F.pow(F.lit(1.0 + rate), (_col(year) - base).cast("double"))


def seasonal_factor(month: ColumnOrName, factors: dict[int, float],
                    default: float = 1.0) -> Column:
    """Per-month multiplier from a ``{month: factor}`` table."""
    m = _col(month)
    expr = None
    for k, f in factors.items():
        expr = (F.when(m == k, F.lit(f)) if expr is None
                else expr.when(m == k, F.lit(f)))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
