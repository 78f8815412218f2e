"""Number rules and reproducible money sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(38,2)"
_COMMON = "decimal(18,2)"
_LARGE = 1e15


def whole(c: Column, to: str = "int") -> Column:
    """Text to a whole number, cutting a decimal part; null when it is not a number."""
    digits = F.regexp_extract(F.trim(c.cast("string")), r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1)
    return digits.try_cast(to)


def exact_whole(c: Column, to: str = "int") -> Column:
    """Text to a whole number; null when it is not a number or has a decimal part."""
    text = F.trim(c.cast("string"))
    as_double = text.try_cast("double")
    integral = F.when(as_double == F.floor(as_double), as_double)
    return F.coalesce(text.try_cast(to), integral.try_cast(to))


def real(c: Column) -> Column:
    """Text to a finite number; null otherwise."""
    value = F.trim(c.cast("string")).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def or_zero(c: Column, to: str) -> Column:
    return F.coalesce(c, F.lit(0).cast(to))


def money(c: Column) -> Column:
    """An amount with two decimals. ``NaN`` and infinity are no amounts; an amount with more
    than 36 digits before the point raises an error instead of vanishing from totals."""
    number = c.cast("double")
    return F.when(F.abs(number) < F.lit(1e36), c.try_cast(MONEY)).when(
        F.abs(number) < F.lit(float("inf")), F.raise_error(F.concat(F.lit("amount out of range: "), c.cast("string"))))


def money_sum(c: Column) -> Column:
    """Sum through fixed decimals, so the total does not depend on the order of rows.

    Common amounts are summed in decimals that fit a machine word, large ones beside them.
    """
    size = F.abs(c.cast("double"))
    common = F.sum(F.when(size < _LARGE, c).try_cast(_COMMON))
    large = F.sum(F.when(size >= _LARGE, money(c)))
    return (F.coalesce(common.cast(MONEY), F.lit(0).cast(MONEY)) + F.coalesce(large, F.lit(0).cast(MONEY))).cast("double")
