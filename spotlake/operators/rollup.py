"""Per-day rollup of the media: the small table behind all-time sums, counts and rankings.

Sums and counts add up over days; distinct counts do not, so those always read the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.functions.text import is_named
from spotlake.operators.rankings import ROWS, SPEND

KEYS = ("medium", "day", "advertiser", "brand", "sector")


def daily_rollup(media: DataFrame) -> DataFrame:
    """Rows and spend per medium, day, advertiser, brand and sector."""
    return media.groupBy(*KEYS).agg(F.count("*").alias("rows"), F.sum("spend").alias("spend"))


def day_rows(rollup: DataFrame, medium: str) -> DataFrame:
    """day, rows of one medium: the directory behind deep pages, without a look at the detections."""
    return rollup.where(F.col("medium") == medium).groupBy("day").agg(F.sum("rows").alias("rows"))


def _spend() -> Column:
    return F.coalesce(F.sum("spend"), F.lit(0)).cast("double")


def totals(rollup: DataFrame) -> DataFrame:
    """Rows, days, first and last day and spend per medium: the reduced statistics refresh."""
    return rollup.groupBy("medium").agg(
        F.sum("rows").alias("total_records"),
        F.count_distinct("day").alias("unique_dates"),
        F.min("day").alias("first_date"),
        F.max("day").alias("last_date"),
        _spend().alias("total_spend"),
    )


def top(rollup: DataFrame, medium: str, keys: dict[str, str], k: int = 10) -> DataFrame:
    """Ranking by spend from the rollup; the last key must not hold a sentinel.

    ``keys`` maps result names to rollup columns.
    """
    last = list(keys.values())[-1]
    groups = rollup.where((F.col("medium") == medium) & is_named(F.col(last))).groupBy(
        *[F.col(c).alias(n) for n, c in keys.items()]
    ).agg(F.sum("rows").alias(ROWS), _spend().alias(SPEND))
    return groups.orderBy(F.col(SPEND).desc(), *[F.col(n).asc_nulls_last() for n in keys]).limit(k)
