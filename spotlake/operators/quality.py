"""Data-quality report and repair of leftover nulls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.functions.text import is_marker
from spotlake.schemas import MISSING

# Key columns whose distinct values are reported
REPORT_KEYS = ("IdPlaza", "IdMedio", "IdCanal", "IdMarca")

_NUMERIC = ("int", "bigint", "smallint", "tinyint")


def quality_report(df: DataFrame, keys: tuple[str, ...] = REPORT_KEYS) -> DataFrame:
    """One line per column: type, nulls and, for the key columns, distinct values.

    A null counts as one more distinct value. All figures come from a single aggregate.
    """
    counted = [k for k in keys if k in df.columns]
    metrics = [F.count("*").alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    metrics += [
        (F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).cast("bigint").alias(f"distinct_{c}")
        for c in counted
    ]
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("rows").alias("total_records"),
            F.lit(len(df.columns)).alias("columns"),
            F.col(f"nulls_{name}").alias("null_count"),
            (F.col(f"distinct_{name}") if name in counted else F.lit(None).cast("bigint")).alias("unique_count"),
        )
        for name, kind in df.dtypes
    ]
    return df.agg(*metrics).select(F.inline(F.array(*lines)))


def _rules(df: DataFrame, null_words: bool, skip: Sequence[str]) -> dict[str, tuple[Column, Column]]:
    """Per column: the test for a bad cell and the value that replaces it."""
    rules = {}
    for name, kind in df.dtypes:
        c = F.col(name)
        if name in skip:
            continue
        if kind == "string":
            bad = is_marker(c) if null_words else c.isNull() | (F.trim(c) == "")
            rules[name] = (bad, F.lit(MISSING))
        elif kind in _NUMERIC:
            rules[name] = (c.isNull(), F.lit(0).cast(kind))
        elif kind in ("double", "float"):
            rules[name] = (c.isNull(), F.lit(0.0).cast(kind))
    return rules


def repair(df: DataFrame, null_words: bool = True, skip: Sequence[str] = ()) -> DataFrame:
    """Replace leftover nulls and null words; ``null_words=False`` is the print variant."""
    rules = _rules(df, null_words, skip)
    return df.select([
        F.when(rules[n][0], rules[n][1]).otherwise(F.col(n)).alias(n) if n in rules else F.col(n)
        for n in df.columns
    ])


def changed_cells(df: DataFrame, null_words: bool = True, skip: Sequence[str] = ()) -> Column:
    """Number of cells of a row that :func:`repair` changes."""
    flags = [bad.cast("int") for bad, _ in _rules(df, null_words, skip).values()]
    return sum(flags, F.lit(0))


def repair_counts(df: DataFrame, null_words: bool = True, skip: Sequence[str] = ()) -> DataFrame:
    """Cells that :func:`repair` changes, per column, from one aggregate."""
    rules = _rules(df, null_words, skip)
    counts = df.agg(*[F.count_if(bad).alias(n) for n, (bad, _) in rules.items()])
    return counts.unpivot([], list(rules), "column_name", "cells")
