"""Removal of lines that spread over many sites.

Per line (two independent 64-bit hashes) a HyperLogLog sketch of the sites that carry it is
built in every task and merged by aggregation. A line whose estimate is clearly above
``min_sites`` is boilerplate, one clearly below is not; lines within ``BAND`` standard
errors of the threshold get an exact count of their distinct sites, so the decision equals
the exact one. A boilerplate line stays in the document with the smallest id that has it
and goes from all others, so no text is lost altogether.

A very common line is reduced to one row per task before the shuffle; the join that
brings decisions back pairs two stored tables, so adaptive execution splits it.

Lines end at a line feed. Lines of white space only are kept and never counted. Nulls: a
null text has no lines and stays null, a null site is a site of its own, a null id comes
after all other ids; if only rows without an id have a line, it stays in all of them.
Repeated rows are treated alike. An empty table gives an empty result. The other
columns are passed through by ``without_common_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.llm.common import cut

LG_K = 10
#: The relative standard error of a sketch with 2**LG_K slots is below 1.04 / 2**(LG_K / 2).
BAND = 6 * 1.04 / 2 ** (LG_K / 2)
MIN_SITES = 10


def line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))


def is_blank(line: Column) -> Column:
    return F.length(F.trim(F.translate(line, "\t\r\x0b\x0c", "    "))) == 0


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def common_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """key and the id that keeps the line, of lines on at least ``min_sites`` sites."""
    spread = cut(lines.groupBy("key").agg(
        F.hll_sketch_agg("site", LG_K).alias("sketch"), F.min("id").alias("first_id")).select(
            "key", "first_id", F.hll_sketch_estimate("sketch").alias("sites")
        ).where(F.col("sites") >= min_sites * (1 - BAND)), "line-spread")
    sure = F.col("sites") > min_sites * (1 + BAND)
    near = spread.where(~sure)
    counted = lines.join(near.select("key"), "key", "left_semi").groupBy("key").agg(
        F.countDistinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(sure).select("key", "first_id").unionAll(
        near.select("key", "first_id").join(counted.select("key"), "key", "left_semi"))


def _marked(docs: DataFrame, id_column: str, text_column: str, site_column: str, min_sites: int) -> DataFrame:
    """``docs`` as one struct column beside the keys of the lines each document loses."""
    keys = F.array_distinct(F.transform(
        F.filter(lines_of(F.col(f"`{text_column}`")), lambda line: ~is_blank(line)), line_key))
    site = F.xxhash64(F.col(f"`{site_column}`").isNull(), F.col(f"`{site_column}`").cast("string"))
    lines = cut(docs.select(F.col(f"`{id_column}`").alias("id"), site.alias("site"), F.explode(keys).alias("key")), "lines")
    common = cut(common_lines(lines, min_sites), "common-lines")
    lost = lines.join(common, "key").where(~F.col("id").eqNullSafe(F.col("first_id"))).groupBy("id").agg(
        F.collect_set("key").alias("lost"))
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    return whole.join(lost, F.col("doc")[id_column].eqNullSafe(lost["id"]), "left").select("doc", "lost")


def _kept(text: Column) -> Column:
    lines = F.filter(lines_of(text), lambda line: is_blank(line) | ~F.array_contains(F.col("lost"), line_key(line)))
    return F.when(F.col("lost").isNull(), text).otherwise(F.array_join(lines, "\n"))


def line_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """id, n_lines, n_removed and the text that is left, of every row."""
    text = F.col("doc")[text_column]
    left = _kept(text)
    return _marked(docs, id_column, text_column, site_column, min_sites).select(
        F.col("doc")[id_column].alias(id_column),
        F.coalesce(F.size(lines_of(text)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter(lines_of(text), lambda line: ~is_blank(line) & F.array_contains(
            F.col("lost"), line_key(line)))), F.lit(0)).cast("long").alias("n_removed"),
        left.alias("text"))


def without_common_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``docs`` without common lines. A document all of whose lines live on elsewhere goes."""
    text = F.col("doc")[text_column]
    marked = _marked(docs, id_column, text_column, site_column, min_sites).select(
        "doc", _kept(text).alias("left"), F.col("lost").isNotNull().alias("changed"))
    return marked.where(~F.col("changed") | ~is_blank(F.translate(F.col("left"), "\n", ""))).select(*[
        (F.col("left") if name == text_column else F.col("doc")[name]).alias(name) for name in docs.columns])
