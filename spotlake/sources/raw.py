"""Raw drops (JSON files under ``rawdata/{medium}/{yyyymmdd}/``) and arrival notices."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from spotlake.functions.params import as_day
from spotlake.schemas import MEDIA, raw_schema

# Layout of the landing area and of a notice
ROOT = "rawdata"
PLACEHOLDER = ".keep"
ENVELOPE = "Notification"
CREATED = "ObjectCreated"
# ---- end of fixed values

def path_parts(key: Column) -> dict[str, Column]:
    """Medium, day and outcome of an object key ``rawdata/{medium}/{day}/{file}``."""
    parts = F.split(key, "/")
    well_formed = (F.size(parts) >= 4) & (F.get(parts, 0) == ROOT)
    medium = F.when(well_formed, F.get(parts, 1))
    return {
        "medium": medium,
        "day": F.when(well_formed, F.get(parts, 2)),
        "outcome": F.when(key.isNull() | (key == ""), "no_key")
        .when(~well_formed, "bad_path")
        .when(key.endswith(PLACEHOLDER), "placeholder")
        .when(~medium.isin(*MEDIA), "unknown_medium")
        .otherwise("ok"),
    }


def key_of_path(path: Column) -> Column:
    """The part of a full file path that starts at the landing root."""
    return F.regexp_extract(path, f"({ROOT}/.*)$", 1)


def _document(c: Column) -> Column:
    """A complete JSON object as a variant, else null."""
    return F.when(F.trim(c).endswith("}"), F.try_parse_json(c))


def _text(document: str, path: str) -> Column:
    return F.try_variant_get(document, path, "string")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column so that later filters cannot be rewritten to compute it again:
    no condition moves below an ``explode``, here of a single value."""
    return df.withColumn(name, F.explode(F.array(value)))


def parse_notices(df: DataFrame, body: str = "body") -> DataFrame:
    """Unwrap arrival notices: adds ``event_name``, ``object_key``, ``medium``, ``day``, ``outcome``.

    A notice is either bare or wrapped in an envelope whose message is the notice as text.
    Only its first record counts, and only creations are accepted. Nothing is dropped: the
    outcome says why a notice is not usable. Each document is parsed once.
    """
    opened = _once(df, "_outer", _document(F.col(body)))
    wrapped = _text("_outer", "$.Type") == ENVELOPE
    message = F.when(wrapped, _text("_outer", "$.Message"))
    opened = opened.withColumn("_message", message)
    inner = F.when(F.coalesce(wrapped, F.lit(False)), _document(F.col("_message"))).otherwise(F.col("_outer"))
    opened = _once(opened, "_notice", inner)
    named = opened.withColumns({
        "event_name": F.coalesce(_text("_notice", "$.Records[0].eventName"), F.lit("")),
        "object_key": _text("_notice", "$.Records[0].s3.object.key"),
    })
    parts = path_parts(F.col("object_key"))
    outcome = (
        F.when(F.try_variant_get("_notice", "$.Records[0]", "variant").isNull(), "unreadable")
        .when(~F.col("event_name").startswith(CREATED), "not_created")
        .otherwise(parts["outcome"])
    )
    return named.withColumns({"medium": parts["medium"], "day": parts["day"], "outcome": outcome}).drop(
        "_outer", "_message", "_notice"
    )


def read_files(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """JSON files as text rows with their path; broken documents give one corrupt row each.

    Accepts both shapes: a file that holds one array, and files with one object per line.
    A file with one array is parsed by one task, so large drops should use lines.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return reader.option("multiLine", True).json(list(paths) if not isinstance(paths, str) else paths).select(
        "*", F.col("_metadata.file_path").alias("file_path")
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """The same for splittable files with one object per line, as :func:`write_raw` makes them."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return reader.json(list(paths) if not isinstance(paths, str) else paths).select(
        "*", F.col("_metadata.file_path").alias("file_path")
    )


def read_range(
    spark: SparkSession,
    landing: str,
    medium: str,
    start: str | date,
    end: str | date,
    limit: int | None = None,
    lines: bool = False,
) -> DataFrame:
    """Every raw row of a medium whose path day lies in the range.

    The day test uses only the file path, so files of other days are never opened.
    """
    read = read_lines if lines else read_files
    rows = read(spark, f"{landing.rstrip('/')}/{ROOT}/{medium}", raw_schema(medium))
    first, last = (as_day(d).strftime("%Y%m%d") for d in (start, end))
    day = F.regexp_extract("_metadata.file_path", f"/{ROOT}/{medium}/([0-9]{{8}})/", 1)
    rows = rows.where(day.between(first, last)).withColumn("path_day", F.regexp_extract(
        "file_path", f"/{ROOT}/{medium}/([0-9]{{8}})/", 1
    ))
    return rows.limit(limit) if limit is not None else rows


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Sub-feeds of one medium under each other; a column one of them lacks is null there."""
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed, allowMissingColumns=True)
    return union


def union_available(feeds: Mapping[str, Callable[[], DataFrame]]) -> tuple[DataFrame | None, dict[str, str]]:
    """The sub-feeds that can be read, under each other, and why each other one was passed over.

    Only a feed that is absent or unreadable when it is opened is passed over; a failure
    while rows are read still fails the load.
    """
    frames, missing = [], {}
    for name, opened in feeds.items():
        try:
            frames.append(opened())
        except AnalysisException as error:
            missing[name] = str(error)
    return (union_feeds(*frames) if frames else None), missing


def write_raw(df: DataFrame, landing: str, medium: str, day: str | date, drop: str) -> tuple[str, int]:
    """Write rows as a drop of JSON lines below the day's folder; returns its path and its rows.

    The drop may have any number of files; readers treat its folder as one unit. The rows
    are counted on their way to the files.
    """
    path = f"{landing.rstrip('/')}/{ROOT}/{medium}/{as_day(day).strftime('%Y%m%d')}/{drop}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path, seen.get["rows"]


def landed_days(spark: SparkSession, landing: str, medium: str, start: str | date, end: str | date) -> DataFrame:
    """Files per landed day of a medium, from the listing alone."""
    root = f"{landing.rstrip('/')}/{ROOT}/{medium}"
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option(
        "recursiveFileLookup", True).load(root)
    day = F.regexp_extract("path", f"/{ROOT}/{medium}/([0-9]{{8}})/", 1)
    first, last = (as_day(d).strftime("%Y%m%d") for d in (start, end))
    return listed.select(day.alias("day")).where(F.col("day").between(first, last)).groupBy("day").agg(
        F.count("*").alias("files"))


def delete_raw(
    spark: SparkSession, landing: str, medium: str, start: str | date, end: str | date | None = None
) -> int:
    """Remove every raw file of an inclusive day range; returns how many there were.

    Overwriting a day's folder with an empty marker removes what it held. The marker is not
    JSON, so readers and the arrival stream pass over it.
    """
    days = landed_days(spark, landing, medium, start, end or start).collect()  # one row per day
    for row in days:
        marker = spark.range(0).write.mode("overwrite").option("partitionOverwriteMode", "static")
        marker.parquet(f"{landing.rstrip('/')}/{ROOT}/{medium}/{row['day']}")
    return sum(row["files"] for row in days)
