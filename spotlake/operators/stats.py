"""Coverage and spend statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.functions.numbers import money, money_sum
from spotlake.functions.params import as_day
from spotlake.operators.filters import (
    TOTALS_FILTERS, Filters, between_days, filter_columns, select_range,
)
from spotlake.schemas import MEDIA

# Report column names and what they count, per medium
_BROADCAST_DISTINCT = {
    "unique_dates": "Fecha",
    "unique_channels": "IdCanal",
    "unique_brands": "IdMarca",
    "unique_advertisers": "IdAnunciante",
}
DISTINCT = {
    "tv": _BROADCAST_DISTINCT,
    "radio": _BROADCAST_DISTINCT,
    "impresos": {
        "unique_dates": "Fecha",
        "unique_sources": "IdFuente",
        "unique_brands": "Marca",
        "unique_advertisers": "Anunciante",
    },
}
SPEND = {
    "tv": ("total_tarifa", "Tarifa"),
    "radio": ("total_tarifa", "Tarifa"),
    "impresos": ("total_costo", "Costo"),
}
TOTALS_DISTINCT = {
    "unique_masters": "IdMaster",
    "unique_medios": "Medio",
    "unique_brands": "Marca",
    "unique_advertisers": "Anunciante",
}
LIBRARY_DISTINCT = {
    "unique_masters": "IdMaster",
    "unique_types": "TipoMaster",
    "unique_advertisers": "Anunciante",
    "unique_brands": "Marca",
    "unique_industries": "Industria",
}
# ---- end of fixed values


def _distinct(columns: Mapping[str, str], approximate: bool = False) -> list[Column]:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return [count(F.col(c)).alias(name) for name, c in columns.items()]


def _rows() -> Column:
    return F.count("*").alias("total_records")


def _span(column: str, last: str | None = None) -> list[Column]:
    return [F.min(column).alias("first_date"), F.max(last or column).alias("last_date")]


def medium_stats(df: DataFrame, medium: str, approximate: bool = False) -> DataFrame:
    """All-time coverage of one medium. Distinct counts are exact unless asked otherwise."""
    name, column = SPEND[medium]
    return df.agg(
        _rows(),
        *_distinct(DISTINCT[medium], approximate),
        *_span("Fecha"),
        money_sum(F.col(column)).alias(name),
    ).select(F.lit(medium).alias("tipo"), "*")


def range_status(
    df: DataFrame, medium: str, start: str | date, end: str | date, filters: Filters | None = None
) -> DataFrame:
    """Coverage of a filtered day range."""
    first, last = as_day(start), as_day(end)
    name, column = SPEND[medium]
    return select_range(df, medium, first, last, filters).agg(
        _rows(), *_distinct(DISTINCT[medium]), money_sum(F.col(column)).alias(name)
    ).select(
        F.lit(first).alias("fecha_inicio"),
        F.lit(last).alias("fecha_fin"),
        F.lit((last - first).days + 1).alias("total_dates_in_range"),
        (F.col("total_records") > 0).alias("data_exists"),
        "*",
    )


def _load_columns(medium: str) -> dict[str, str]:
    return {n: c for n, c in DISTINCT[medium].items() if n != "unique_dates"}


def day_status(df: DataFrame, medium: str, day: str | date) -> DataFrame:
    """What is loaded for one day."""
    wanted = as_day(day)
    return df.where(F.col("Fecha") == F.lit(wanted)).agg(
        _rows(), *_distinct(_load_columns(medium))
    ).select(F.lit(wanted).alias("fecha"), "*", (F.col("total_records") > 0).alias("data_exists"))


def span_status(df: DataFrame, medium: str, start: str | date, end: str | date) -> DataFrame:
    """What is loaded in a range, as one row."""
    first, last = as_day(start), as_day(end)
    return df.where(between_days(first, last)).agg(
        _rows(), *_distinct(DISTINCT[medium])
    ).select(
        F.lit(first).alias("fecha_inicio"), F.lit(last).alias("fecha_fin"), "*",
        (F.col("total_records") > 0).alias("data_exists"),
    )


def date_spine(df: DataFrame, start: str | Column, end: str | Column, name: str = "Fecha") -> DataFrame:
    """One row per day of an inclusive range; the bounds are columns of ``df``."""
    return df.select("*", F.explode(F.sequence(start, end)).alias(name))


def calendar(df: DataFrame, start: str | date, end: str | date, name: str = "Fecha") -> DataFrame:
    """The days of a literal range; a range that ends before it starts is an error."""
    first, last = as_day(start), as_day(end)
    if first > last:
        raise ValueError("the first day must not come after the last day")
    one = df.sparkSession.range(1).select()
    return one.select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias(name))


def daily_status(df: DataFrame, medium: str, start: str | date, end: str | date) -> DataFrame:
    """What is loaded on each day of a range; days without rows show zeros."""
    counts = _load_columns(medium)
    per_day = df.where(between_days(start, end)).groupBy("Fecha").agg(_rows(), *_distinct(counts))
    numbers = ["total_records", *counts]
    return calendar(df, start, end).join(per_day, "Fecha", "left").select(
        F.col("Fecha").alias("fecha"),
        *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers],
        (F.coalesce("total_records", F.lit(0)) > 0).alias("data_exists"),
    )


def days_to_load(df: DataFrame, spine: DataFrame, keys: tuple[str, ...] = ("Fecha",)) -> DataFrame:
    """Days of the spine that have no rows yet. Loaded days are reduced before the join."""
    return spine.join(df.select(*keys).distinct(), list(keys), "left_anti")


def load_report(df: DataFrame, spine: DataFrame, keys: tuple[str, ...] = ("Fecha",)) -> DataFrame:
    """Per day of the spine: skipped with the rows already there, or accepted for loading."""
    loaded = df.groupBy(*keys).agg(F.count("*").alias("records"))
    return spine.join(loaded, list(keys), "left").select(
        *keys,
        F.when(F.col("records") > 0, "skipped").otherwise("accepted").alias("status"),
        F.coalesce("records", F.lit(0)).alias("records"),
    )


def library_stats(df: DataFrame) -> DataFrame:
    return df.agg(_rows(), *_distinct(LIBRARY_DISTINCT))


def totals_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows(), *_distinct(TOTALS_DISTINCT), *_span("FechaInicio", "FechaFin"),
        money_sum(F.col("TotalInversion")).alias("total_inversion"),
    )


def totals_range_status(
    df: DataFrame, start: str | date, end: str | date, filters: Filters | None = None
) -> DataFrame:
    """Statistics of the totals whose first day lies in the range."""
    inside = filter_columns(df.where(between_days(start, end, "FechaInicio")), TOTALS_FILTERS, filters)
    return inside.agg(
        _rows(), *_distinct(TOTALS_DISTINCT),
        money_sum(F.col("TotalInversion")).alias("total_inversion"),
        F.coalesce(F.sum("TotalHit"), F.lit(0)).alias("total_hits"),
    ).withColumn("data_exists", F.col("total_records") > 0)


def totals_summary(df: DataFrame) -> DataFrame:
    return df.agg(_rows(), money_sum(F.col("TotalInversion")).alias("total_inversion"))


def print_summary(df: DataFrame) -> DataFrame:
    """Summary over an already filtered set of print ads; the average skips null costs."""
    cost = money(F.col("Costo"))
    return df.agg(
        _rows(), F.count_distinct("Fecha").alias("unique_dates"), *_span("Fecha"),
        money_sum(F.col("Costo")).alias("total_costo"),
        F.count(cost).alias("priced"),
    ).select(
        "total_records", "unique_dates", "first_date", "last_date", "total_costo",
        F.when(F.col("priced") > 0, F.col("total_costo") / F.col("priced")).otherwise(0.0).alias("avg_costo"),
    )


def common_shape(df: DataFrame, medium: str | Column) -> DataFrame:
    """Detections in the shape shared by the cross-media reports.

    ``medium`` is ``"impresos"`` for print ads; for spots it is a medium or the column
    that holds it, so TV and radio come from one scan.
    """
    paper = isinstance(medium, str) and medium == "impresos"
    distinct = DISTINCT["impresos" if paper else "tv"]
    return df.select(
        (F.lit(medium) if isinstance(medium, str) else medium).alias("medium"),
        F.col("Fecha").alias("day"),
        F.col(distinct["unique_sources" if paper else "unique_channels"]).cast("string").alias("outlet"),
        F.col(distinct["unique_brands"]).cast("string").alias("brand_key"),
        F.col(distinct["unique_advertisers"]).cast("string").alias("advertiser_key"),
        F.col("Anunciante").alias("advertiser"),
        F.col("Marca").alias("brand"),
        F.col("Sector" if paper else "Industria").alias("sector"),
        money(F.col("Costo" if paper else "Tarifa")).alias("spend"),
    )


def all_media(spots: DataFrame, print_ads: DataFrame | None = None, media: Sequence[str] = MEDIA) -> DataFrame:
    """The media an account may see, in the common shape: spots (by ``tipo``) and print ads."""
    shaped = common_shape(spots, F.col("tipo"))
    if set(media) != set(MEDIA):
        shaped = shaped.where(F.col("medium").isin(list(media)))
    if print_ads is not None and "impresos" in media:
        shaped = shaped.unionByName(common_shape(print_ads, "impresos"))
    return shaped


def media_summary(media: DataFrame) -> DataFrame:
    """One line per medium, also for a medium without rows."""
    per_medium = media.groupBy("medium").agg(
        _rows(),
        F.count_distinct("day").alias("unique_dates"),
        F.count_distinct("outlet").alias("unique_outlets"),
        F.count_distinct("brand_key").alias("unique_brands"),
        F.count_distinct("advertiser_key").alias("unique_advertisers"),
        F.min("day").alias("first_date"),
        F.max("day").alias("last_date"),
        money_sum(F.col("spend")).alias("total_spend"),
    )
    return summary_lines(per_medium)


def summary_lines(per_medium: DataFrame) -> DataFrame:
    """The figures of each medium as report lines; a medium without figures shows zeros."""
    every = per_medium.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, MEDIA))).alias("medium"))
    counts = [
        "total_records", "unique_dates", "unique_outlets", "unique_brands", "unique_advertisers",
    ]
    return every.join(per_medium, "medium", "left").select(
        "medium",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        "first_date", "last_date",
        F.coalesce("total_spend", F.lit(0.0)).alias("total_spend"),
        F.when(F.coalesce("total_records", F.lit(0)) > 0, "disponible").otherwise("sin_datos").alias("status"),
    )


def media_grand_total(media: DataFrame) -> DataFrame:
    """Rows and spend per medium with the grand total in a ``total`` line."""
    return media.rollup("medium").agg(
        _rows(), money_sum(F.col("spend")).alias("total_spend")
    ).withColumn("medium", F.coalesce("medium", F.lit("total")))
