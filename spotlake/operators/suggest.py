"""Cascading value suggestions over the media."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.functions.text import is_named, strip
from spotlake.operators.filters import (
    FILTER_COLUMNS, Filters, active, between_days, contains_text, filter_columns,
)

# Suggested column of each field in the spots (TV, radio) and in the print ads
FIELDS: dict[str, tuple[str | None, str | None]] = {
    "Anunciante": ("Anunciante", "Anunciante"),
    "Marca": ("Marca", "Marca"),
    "Categoria": (None, "Categoria"),
    "Localidad": ("Localidad", None),
    "TipoMedio": ("TipoMedio", None),
    "Medio": ("Medio", "Medio"),
    "Fuente": (None, "Fuente"),
    "Sector": (None, "Sector"),
    "SectorIndustria": ("Industria", "Sector"),
    "Industria": ("Industria", None),
    "Submarca": ("Submarca", "Submarca"),
}
NEVER_SUGGESTED = ("N.A.", "n.a.", "")
# ---- end of fixed values

# TV and radio have the same columns and filters, so the spots answer for both in one scan
_SOURCES = ("tv", "impresos")


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_named(F.col(column))).select(F.col(column).alias("value")).distinct()


def _applies(medium: str, column: str, filters: Mapping[str, list[str]]) -> bool:
    """A medium takes part only if it has every filtered column and none is the suggested one."""
    available = FILTER_COLUMNS[medium]
    return all(name in available and available[name] != column for name in filters)


def _union(frames: list[DataFrame]) -> DataFrame:
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def _finish(values: DataFrame, limit: int) -> DataFrame:
    trimmed = values.select(strip(F.col("value")).alias("value")).where(~F.col("value").isin(*NEVER_SUGGESTED))
    return trimmed.distinct().orderBy("value").limit(limit)


def suggest(
    spots: DataFrame,
    print_ads: DataFrame,
    field: str,
    search: str = "",
    filters: Filters | None = None,
    start: str | date | None = None,
    end: str | date | None = None,
    limit: int = 10,
) -> DataFrame:
    """Sorted distinct values of a field under the other filters, over every medium that has it.

    Values are reduced inside each task before they are shuffled, so a value that fills a
    third of the table costs no more than a rare one.
    """
    sources = [
        (medium, df, column)
        for medium, df, column in zip(_SOURCES, (spots, print_ads), FIELDS.get(field, (None, None)))
        if column in df.columns
    ]
    chosen = active(filters)
    parts = []
    for medium, df, column in sources:
        if not _applies(medium, column, chosen):
            continue
        if start or end:
            df = df.where(between_days(start or date.min, end or date.max))
        df = filter_columns(df, FILTER_COLUMNS[medium], chosen)
        if search:
            df = df.where(contains_text(column, search))
        parts.append(_values(df, column))
    if not parts:
        return spots.sparkSession.createDataFrame([], "value string")
    return _finish(_union(parts), limit)


def _long_values(df: DataFrame, columns: list[str], medium: Column, *keys: Column) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    named = df.select(medium.alias("medium"), *keys, F.explode(pairs).alias("pair"))
    long = named.select(*named.columns[:-1], "pair.*")
    return long.where(is_named(F.col("value"))).distinct()


def label_values(spots: DataFrame, print_ads: DataFrame | None = None) -> DataFrame:
    """Every named value of every suggestible column: medium, column, value.

    The small table that unfiltered suggestions can be served from.
    """
    aired, printed = (
        [c for c in dict.fromkeys(pair[i] for pair in FIELDS.values()) if df is not None and c in df.columns]
        for i, df in enumerate((spots, print_ads))
    )
    values = _long_values(spots, aired, F.col("tipo"))
    if print_ads is None:
        return values
    return values.unionByName(_long_values(print_ads, printed, F.lit("impresos")))


def label_values_by_day(spots: DataFrame, print_ads: DataFrame) -> DataFrame:
    """The same per day, so that a replaced day can be refreshed alone."""
    aired, printed = (
        [c for c in dict.fromkeys(pair[i] for pair in FIELDS.values()) if c in df.columns]
        for i, df in enumerate((spots, print_ads))
    )
    day = F.col("Fecha").alias("day")
    return _long_values(spots, aired, F.col("tipo"), day).unionByName(_long_values(print_ads, printed, F.lit("impresos"), day))


def suggest_from_values(values: DataFrame, field: str, search: str = "", limit: int = 10) -> DataFrame:
    """Unfiltered suggestions from the table of :func:`label_values`."""
    aired, printed = FIELDS[field]
    paper = F.col("medium") == "impresos"
    found = values.where((~paper & (F.col("column") == F.lit(aired))) | (paper & (F.col("column") == F.lit(printed))))
    if search:
        found = found.where(contains_text("value", search))
    return _finish(found.select("value"), limit)
