"""Shared by the test modules."""

from __future__ import annotations

import os

DATA = os.environ.get("SPOTLAKE_TEST_DATA", "/root/testdata/sf0.001")


def column(spark, values, build, kind="string"):
    """Apply a column rule to a list of values, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]
