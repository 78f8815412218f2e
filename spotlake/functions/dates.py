"""Date rules. Raw text never throws: every parse is a ``try_`` parse."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from spotlake.functions.text import strip

def _try_date(c: Column, pattern: str) -> Column:
    return F.try_to_date(c, pattern)


# date, hours and minutes, then optional seconds with a fraction and an optional zone
_CLOCK = r"^.{10}T([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.,][0-9]{1,6})?)?(Z|[+-]([01][0-9]|2[0-3]):?[0-5][0-9])?$"


def feed_date(c: Column) -> Column:
    """Live feeds: ISO date-time when a ``T`` is present, compact ``yyyyMMdd`` otherwise.

    A date-time with a broken clock is no date.
    """
    return F.when(
        c.contains("T"), F.when(c.rlike(_CLOCK), _try_date(F.substring(c, 1, 10), "yyyy-MM-dd"))
    ).otherwise(_try_date(c, "yyyyMMdd"))


# Each rule rewrites one accepted shape to year-month-day and leaves other text alone.
_SHAPES = (
    # eight leading digits win over whatever follows them
    ("(?s)^([0-9]{8}).*$", "$1"),
    # compact, also with one-digit month or day
    ("^([0-9]{4})(1[0-2]|0?[1-9])(3[01]|[12][0-9]|0?[1-9])$", "$1-$2-$3"),
    ("^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$", "$1-$2-$3"),
    ("^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", "$3-$2-$1"),
    ("^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})$", "$3-$2-$1"),
    # date and clock
    ("^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})T([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]$", "$1"),
    # anything else: the first three runs of digits, with a plausible year
    (
        "(?s)^[^0-9]*0*(19[0-9]{2}|20[0-9]{2}|2100)[^0-9]+0*(1[0-2]|[1-9])"
        "[^0-9]+0*(3[01]|[12][0-9]|[1-9])([^0-9].*)?$",
        "$1-$2-$3",
    ),
)


def any_date(c: Column) -> Column:
    """Batch feeds: six formats, then the first three digit runs as year, month, day.

    A chain of rewrites, each used once, keeps the generated code small.
    """
    text = strip(c)
    for shape, rewritten in _SHAPES:
        text = F.regexp_replace(text, shape, rewritten)
    return _try_date(text, "yyyy-M-d")


def short_date(c: Column) -> Column:
    """Text of at least eight characters; the date part only when it is a date-time."""
    return F.when(
        F.length(c) >= 8, F.when(c.contains("T"), F.substring(c, 1, 10)).otherwise(c)
    )


def sliced_date(c: Column) -> Column:
    """Date read from fixed positions 1-4, 6-7 and 9-10, whatever the separators are."""
    parts = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 6, 2), F.substring(c, 9, 2))
    return F.when(F.length(c) >= 10, _try_date(parts, "yyyy-MM-dd"))


def is_day_key(c: Column) -> Column:
    """Exactly eight digits that form a real date."""
    return F.coalesce(c.rlike("^[0-9]{8}$"), F.lit(False)) & _try_date(c, "yyyyMMdd").isNotNull()


def day_from_key(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{8}$"), _try_date(c, "yyyyMMdd"))
