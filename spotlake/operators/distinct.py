"""Exact distinct counts that merge over days: per medium and day a bitmap over dense ids.

Distinct counts do not add up over days, but the sets do. A dictionary gives every outlet, brand
and advertiser key a dense id; what a medium showed on a day is a few bitmaps of 4 KB. Any span of
days is then counted by joining bitmaps with OR, without a look at the detections, and a replaced
day replaces only its own bitmaps.

Nulls are no values. Ids are never taken back or given twice, so values that are gone cost a bit, not
a wrong count. The dictionary must have one writer at a time, as the tables it describes have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotlake.operators import rollup, stats

#: Report column of each counted column of the common shape.
KINDS = {"outlet": "unique_outlets", "brand_key": "unique_brands", "advertiser_key": "unique_advertisers"}
BINS = 256


def day_values(media: DataFrame, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """medium, day, kind, value: what every medium showed on every day, once each.

    Equal rows of the counted columns meet first, so a detail row is not multiplied.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in kinds])
    rows = media.groupBy("medium", "day", *kinds).agg(F.lit(1).alias("one"))
    return rows.select("medium", "day", F.inline(pairs)).where("value is not null").distinct()


def new_ids(values: DataFrame, ids: DataFrame) -> DataFrame:
    """kind, value, id of the values the dictionary ``ids`` lacks; ids go on from its largest.

    Values are numbered within bins of their hash, and the bins laid end to end, so no task sees
    all of them and the numbers have no gaps.
    """
    fresh = values.select("kind", "value").distinct().join(ids.select("kind", "value"), ["kind", "value"], "left_anti").withColumn(
        "bin", F.pmod(F.xxhash64("value"), F.lit(BINS)))
    order = Window.partitionBy("kind").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = fresh.groupBy("kind", "bin").agg(F.count("*").alias("size")).select(
        "kind", "bin", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("before"))
    last = ids.groupBy("kind").agg(F.max("id").alias("last"))
    rank = F.row_number().over(Window.partitionBy("kind", "bin").orderBy("value"))
    return fresh.withColumn("rank", rank).join(bins, ["kind", "bin"]).join(last, "kind", "left").select(
        "kind", "value", (F.coalesce("last", F.lit(0)) + F.col("before") + F.col("rank")).cast("bigint").alias("id"))


def no_ids(df: DataFrame) -> DataFrame:
    """An empty dictionary."""
    return df.sparkSession.createDataFrame([], "kind string, value string, id bigint")


def distinct_sets(values: DataFrame, ids: DataFrame) -> DataFrame:
    """medium, day, kind, bucket, bits: the bitmaps of each medium and day.

    The ids of a bitmap meet before it is made: a bitmap begun in each task of the join would
    send 4 KB for nearly every value.
    """
    keys = ["medium", "day", "kind", "bucket"]
    places = values.join(ids.select("kind", "value", "id"), ["kind", "value"]).select(
        "medium", "day", "kind", F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("place"))
    return places.repartition(*keys).groupBy(*keys).agg(F.bitmap_construct_agg("place").alias("bits"))


def distinct_counts(sets: DataFrame, *by: str) -> DataFrame:
    """Exact distinct counts per ``by``, or of everything."""
    merged = sets.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(name) for kind, name in KINDS.items()])


def media_summary(daily: DataFrame, sets: DataFrame, within: Column | None = None) -> DataFrame:
    """The summary of :func:`stats.media_summary` from the daily rollup and the bitmaps.

    ``within`` is a condition on ``day``; a span of days costs its days' bitmaps.
    """
    if within is not None:
        daily, sets = daily.where(within), sets.where(within)
    return stats.summary_lines(rollup.totals(daily).join(distinct_counts(sets, "medium"), "medium", "left"))
