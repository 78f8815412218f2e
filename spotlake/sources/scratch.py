"""Intermediate tables in the shared scratch space of a session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from spotlake.session import scratch_dir, shuffles_freed


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared scratch space of the session."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch space and read it back.

    The lineage ends there, so a lost executor costs only the task it ran, and later
    joins are planned with the true size of the data. The shuffle files of the way there go at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete what :func:`cut` wrote, once nothing reads ``df`` any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(folder), True)


def input_bytes(df: DataFrame) -> int:
    """Size of the tables ``df`` is read from, as Spark knows it; a table read twice counts twice."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
