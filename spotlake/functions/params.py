"""List parameters and the audit text of a query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, functions as F


def parse_list(value: str | Sequence[str] | None) -> list[str]:
    """A comma-separated parameter as a list without blanks."""
    if not value:
        return []
    parts = value.split(",") if isinstance(value, str) else value
    return [p.strip() for p in parts if p.strip()]


def as_day(value: str | date) -> date:
    """A ``yyyyMMdd`` or ISO day parameter."""
    if isinstance(value, date):
        return value
    return datetime.strptime(value.replace("-", ""), "%Y%m%d").date()


def split_list(c: Column) -> Column:
    """The same rule for a list held in a column."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def _in_clause(name: str, values: Column) -> Column:
    quoted = F.transform(F.slice(values, 1, 3), lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    more = F.when(
        F.size(values) > 3,
        F.concat(F.lit(", ... ("), F.size(values).cast("string"), F.lit(" total)")),
    ).otherwise("")
    clause = F.concat(F.lit(f"{name} IN ("), F.concat_ws(", ", quoted), more, F.lit(")"))
    return F.when(F.size(values) > 0, clause)


def audit_text(
    instruction: Column,
    table: Column,
    start: Column,
    end: Column,
    filters: Mapping[str, Column],
    rows: Column | None = None,
    columns: Column | None = None,
) -> Column:
    """Readable text of a filtered read: at most three values per filter are spelled out.

    ``filters`` maps a column name to an array of values; an empty array adds no clause.
    """
    span = F.concat(
        F.lit("Fecha BETWEEN '"), F.date_format(start, "yyyy-MM-dd"),
        F.lit("' AND '"), F.date_format(end, "yyyy-MM-dd"), F.lit("'"),
    )
    where = F.concat_ws(" AND ", span, *[_in_clause(n, v) for n, v in filters.items()])
    head = F.concat_ws(" ", instruction, columns if columns is not None else F.lit("*"), F.lit("FROM"), table)
    tail = F.concat(F.lit("-- "), rows.cast("string"), F.lit(" rows")) if rows is not None else F.lit(None).cast("string")
    return F.concat_ws(" ", head, F.lit("WHERE"), where, tail)
