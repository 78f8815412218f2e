from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import SCHEMA, Writer  # noqa: E402


@pytest.fixture(scope="session")
def writer():
    return Writer


@pytest.fixture(scope="session")
def awkward() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, copies, near copies and shared passages."""
    w = Writer(1)
    base = w.text(30)
    near = base.replace(base.split()[40], "Xyzzy", 1)
    passage = w.text(8)
    rows = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, "  \n\t "), (7, "one"), (8, "one"), (9, "one two three"),
        (10, w.text(5) + " " + passage + " " + w.text(5)), (11, passage), (12, w.text(3) + " " + passage),
        (13, "é" * 60 + " ñandú"), (14, "é" * 61), (15, w.text(900)), (16, "a " * 3000), (17, "ab" * 200),
        (None, base), (None, None), (18, "Same line here\n" * 3 + w.sentence()),
    ]
    rows += [(18, rows[-1][1])]  # a row that stands twice
    rows += [(20 + i, f"{w.sentence()}\nSame line here\n{w.sentence()}") for i in range(14)]
    rows += [(40 + i, w.text(6)) for i in range(10)]
    sources = ["a", "b", None, "c", "é", "ab", "d", "e", "f", "g", "h", "i", "j"]
    return [(i, t, "en", sources[n % len(sources)], None if t is None else len(t)) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def docs(spark, awkward):
    return spark.createDataFrame(awkward, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with further columns named like ones the operators make."""
    from pyspark.sql import functions as F

    names = ("id", "size", "n", "run", "key", "site", "lost", "digest", "node", "path", "blob", "hash", "token", "unit",
             "keep_id", "component_id", "target", "score", "label", "item", "start", "end", "print", "word", "first")
    return docs.select("*", *[F.lit(f"own {name}").alias(name) for name in names])
