"""Exact duplicates by a tree merge of sorted digest runs.

Every row belongs to one of ``FAN ** LEVELS`` runs by the hash of its id. A run lists each
digest once, with the id that stays and the number of rows. In every round FAN neighbouring
runs meet in one node of the next level, where entries of the same text become one; each
level is written sorted by digest. Above the last round one entry per text is left. The way
back hands its answer down the same tree, so a text with a third of all rows is spread over
all runs in both directions, and no task meets more than FAN entries or one run's rows of it.

Two entries are the same text only if SHA-256, length in bytes and an independent 64-bit
hash all agree; this is verified at every level, because all three are the merge key.

Nulls: a null text counts as the empty text, a null id loses to every other id. Repeated
rows (same id and text) are counted and returned one by one and share ``kept``, as nothing
tells them apart. An empty table gives an empty result.
Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.llm.common import cut, text_of

FAN = 16
LEVELS = 3
SAME = ("digest", "n_bytes", "check")


def address(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One slim row per document: id, run, digest and what verifies it."""
    text = text_of(text_column)
    return docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.pmod(F.xxhash64(F.col(f"`{id_column}`")), F.lit(FAN**LEVELS)).cast("int").alias("node"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check"))


def best(keep: str) -> Column:
    return (F.max if keep == "largest" else F.min)("keep_id").alias("keep_id")


def merge(runs: DataFrame, keep: str) -> DataFrame:
    """Entries of the same text within a node become one entry."""
    return runs.groupBy("node", *SAME).agg(best(keep), F.sum("group_size").alias("group_size"))


def stored(runs: DataFrame, level: int) -> DataFrame:
    return cut(runs.sortWithinPartitions("node", "digest"), f"digest-runs-{level}")


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest",
) -> DataFrame:
    """id, keep_id, group_size, kept and text_sha256 of every row; see the module for the cases."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep!r}")
    rows = cut(address(docs, id_column, text_column), "digests")
    level = stored(merge(rows.select("node", *SAME, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")), keep), 0)
    levels = [level]
    for number in range(1, LEVELS + 1):
        level = stored(merge(level.withColumn("node", F.shiftright("node", 4)), keep), number)
        levels.append(level)
    answer = levels.pop()
    for level in reversed(levels):
        below = level.select(F.col("node").alias("child"), F.shiftright("node", 4).alias("node"), *SAME)
        answer = cut(
            below.join(answer, ["node", *SAME]).select(F.col("child").alias("node"), *SAME, "keep_id", "group_size"),
            "digest-answers")
    return rows.join(answer, ["node", *SAME]).select(
        F.col("id").alias(id_column), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
