"""Top-k rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from spotlake.functions.numbers import money_sum
from spotlake.functions.text import is_named
from spotlake.schemas import SECTOR_COLUMN, SPEND_COLUMN

ROWS = "registros"
SPEND = "total_inversion"
HITS = "total_hits"


def top_groups(
    df: DataFrame,
    keys: Mapping[str, str],
    k: int,
    spend: str | None = None,
    hits: str | None = None,
    named: Sequence[str] = (),
) -> DataFrame:
    """The k groups with the largest spend (or, without spend, the most rows).

    ``keys`` maps result names to columns; rows whose ``named`` columns hold a sentinel
    are left out. Groups are reduced before the shuffle and only k rows leave each task;
    the keys themselves break ties, so the result is always the same.
    """
    for column in named:
        df = df.where(is_named(F.col(column)))
    metrics = [F.count("*").alias(ROWS)]
    if spend:
        metrics.append(money_sum(F.col(spend)).alias(SPEND))
    if hits:
        metrics.append(F.coalesce(F.sum(hits), F.lit(0)).alias(HITS))
    groups = df.groupBy(*[F.col(c).alias(n) for n, c in keys.items()]).agg(*metrics)
    order = [F.col(SPEND if spend else ROWS).desc()]
    order += [F.col(n).asc_nulls_last() for n in keys]
    return groups.orderBy(*order).limit(k)


def top_brands(df: DataFrame, medium: str, k: int = 10, named_advertiser: bool = False) -> DataFrame:
    """Brands with their advertiser by spend; the summary report also skips unnamed advertisers."""
    named = ["Marca", "Anunciante"] if named_advertiser else ["Marca"]
    return top_groups(
        df, {"anunciante": "Anunciante", "marca": "Marca"}, k, SPEND_COLUMN[medium], named=named
    )


def top_sectors(df: DataFrame, medium: str, k: int = 10) -> DataFrame:
    column = SECTOR_COLUMN[medium]
    return top_groups(df, {"sector": column}, k, SPEND_COLUMN[medium], named=[column])


def library_top_advertisers(df: DataFrame, k: int = 10) -> DataFrame:
    """Catalogue advertisers by number of versions (the catalogue has no spend)."""
    keys = {"anunciante": "Anunciante", "marca": "Marca"}
    return top_groups(df, keys, k, named=["Anunciante"]).withColumnRenamed(ROWS, "versiones")


def library_top_industries(df: DataFrame, k: int = 10) -> DataFrame:
    keys = {"industria": "Industria"}
    return top_groups(df, keys, k, named=["Industria"]).withColumnRenamed(ROWS, "versiones")


def totals_top(df: DataFrame, by: str, k: int = 10) -> DataFrame:
    """Totals by ``brand``, ``industry`` or ``medium`` with spend and hits."""
    keys = {
        "brand": {"anunciante": "Anunciante", "marca": "Marca"},
        "industry": {"industria": "Industria"},
        "medium": {"medio": "Medio"},
    }[by]
    return top_groups(df, keys, k, "TotalInversion", "TotalHit", named=[list(keys.values())[-1]])


def print_outlets(df: DataFrame, k: int = 10) -> DataFrame:
    """Print media by number of ads; a null or blank name is shown as ``N/A``.

    The name is replaced after grouping, so null and blank stay two lines.
    """
    groups = df.groupBy("Medio").agg(F.count("*").alias("count"))
    return groups.orderBy(F.col("count").desc(), F.col("Medio").asc_nulls_last()).limit(k).select(
        F.coalesce(F.nullif("Medio", F.lit("")), F.lit("N/A")).alias("medio"), "count"
    )


def top_per_medium(media: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    """k best groups of every medium by spend, from the cross-media shape.

    The last key must be named; in print the advertiser must be, too. Ranks are cut to k
    inside each task before the shuffle, so a medium with millions of groups never gathers
    in one task.
    """
    shown = is_named(F.col(keys[-1]))
    if "advertiser" in keys:
        shown = shown & ((F.col("medium") != "impresos") | is_named(F.col("advertiser")))
    groups = media.where(shown).groupBy("medium", *keys).agg(
        F.count("*").alias(ROWS), money_sum(F.col("spend")).alias(SPEND)
    )
    order = [F.col(SPEND).desc(), *[F.col(n).asc_nulls_last() for n in keys]]
    ranked = groups.withColumn("rank", F.row_number().over(Window.partitionBy("medium").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)
