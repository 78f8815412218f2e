"""Date ranges, multi-value filters and what a filter means per medium."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from enum import Enum

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spotlake.functions.params import as_day, parse_list


class Without(Enum):
    """What a filter does on a medium that lacks the column."""

    EMPTY = "no row can match"
    IGNORED = "the filter does not apply"


# Filter name to column, per medium
_BROADCAST = {
    "anunciante": "Anunciante",
    "marca": "Marca",
    "submarca": "Submarca",
    "medio": "Medio",
    "tipo_medio": "TipoMedio",
    "localidad": "Localidad",
    "industria": "Industria",
    "sector_industria": "Industria",
}
_PRINT = {
    "anunciante": "Anunciante",
    "marca": "Marca",
    "submarca": "Submarca",
    "medio": "Medio",
    "categoria": "Categoria",
    "fuente": "Fuente",
    "sector": "Sector",
    "sector_industria": "Sector",
}
FILTER_COLUMNS: dict[str, dict[str, str]] = {"tv": _BROADCAST, "radio": _BROADCAST, "impresos": _PRINT}
FILTERS = (
    "anunciante", "marca", "submarca", "medio", "tipo_medio", "localidad",
    "categoria", "fuente", "sector", "sector_industria", "industria",
)
TOTALS_FILTERS = {
    "anunciante": "Anunciante",
    "marca": "Marca",
    "submarca": "Submarca",
    "medio": "Medio",
    "industria": "Industria",
    "segmento": "Segmento",
}
# TV and radio have no category: asking for one finds nothing. Everything else that a
# medium lacks is left out of the condition.
_EMPTY_WITHOUT = {("tv", "categoria"), ("radio", "categoria")}
# ---- end of fixed values

#: Values of one filter that are still a condition of the plan.
LONGEST_LIST = 1000

Filters = Mapping[str, "str | Sequence[str] | None"]


def resolve(medium: str, name: str) -> str | Without:
    """The column a filter uses on a medium, or what to do when there is none."""
    column = FILTER_COLUMNS[medium].get(name)
    if column:
        return column
    return Without.EMPTY if (medium, name) in _EMPTY_WITHOUT else Without.IGNORED


def active(filters: Filters | None) -> dict[str, list[str]]:
    """Parsed filters without the blank ones."""
    parsed = {name: parse_list(value) for name, value in (filters or {}).items()}
    return {name: values for name, values in parsed.items() if values}


def between_days(start: str | date, end: str | date, column: str = "Fecha") -> Column:
    """Inclusive day range as two literals, so it prunes partitions and row groups."""
    return F.col(column).between(F.lit(as_day(start)), F.lit(as_day(end)))


def keep_values(df: DataFrame, column: str, values: Sequence[str], longest: int = LONGEST_LIST) -> DataFrame:
    """Rows whose column is one of the values.

    A list of up to ``longest`` values is a condition, which reaches the scan. A longer one would
    bloat the plan and every task, so it becomes a table of its own and a semi join: Spark knows its
    size and broadcasts it or, where it is too large for that, joins by shuffle.
    """
    wanted = list(dict.fromkeys(v for v in values if v is not None))
    if len(wanted) <= longest:
        return df.where(F.col(column).isin(wanted))
    listed = df.sparkSession.createDataFrame(pa.table({"_listed": pa.array([str(v) for v in wanted], pa.string())}))
    listed = listed.select(F.col("_listed").try_cast(df.schema[column].dataType).alias("_listed")).distinct()
    return df.join(listed, F.col(column) == F.col("_listed"), "left_semi")


def filter_columns(df: DataFrame, mapping: Mapping[str, str], filters: Filters | None) -> DataFrame:
    """AND of the active filters over an explicit name-to-column mapping."""
    for name, values in active(filters).items():
        if name in mapping:
            df = keep_values(df, mapping[name], values)
    return df


def filter_medium(df: DataFrame, medium: str, filters: Filters | None) -> DataFrame:
    """AND of the active filters with the medium's own columns."""
    for name, values in active(filters).items():
        column = resolve(medium, name)
        if column is Without.EMPTY:
            df = df.where(F.lit(False))
        elif column is not Without.IGNORED:
            df = keep_values(df, column, values)
    return df


def select_range(
    df: DataFrame, medium: str, start: str | date, end: str | date, filters: Filters | None = None
) -> DataFrame:
    return filter_medium(df.where(between_days(start, end)), medium, filters)


def contains_text(column: str, needle: str, literal: bool = False) -> Column:
    """Case-insensitive search; ``%`` and ``_`` are wildcards unless ``literal``."""
    if literal:
        return F.lower(column).contains(needle.lower())
    return F.col(column).ilike(f"%{needle}%")


def filter_matrix(df: DataFrame, medium: str, filters: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows each filter keeps on its own: one scan, one aggregate, one line per filter.

    A frame with a ``tipo`` column is reported per medium; its media share their columns.
    """
    def kept(name: str) -> Column:
        column = resolve(medium, name)
        if column is Without.EMPTY:
            return F.lit(0).cast("bigint")
        if column is Without.IGNORED:
            return F.count("*")
        return F.count_if(F.col(column).isin(list(filters[name])))

    by = F.col("tipo") if "tipo" in df.columns else F.lit(medium)
    counts = df.groupBy(by.alias("medium")).agg(*[kept(n).alias(n) for n in filters])
    return counts.unpivot(["medium"], list(filters), "filter", "rows")
