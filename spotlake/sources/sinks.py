"""External targets: JDBC tables, the non-fatal mirror and export files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

# Fixed value: rows per insert batch
JDBC_BATCH = 1000

# connections a target is asked to hold at once, whatever the size of the frame
JDBC_WRITERS = 16


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "driver": self.driver,
            "batchsize": str(JDBC_BATCH),
            "numPartitions": str(JDBC_WRITERS),
            **self.properties,
        }

    def append(self, df: DataFrame) -> int:
        """Append the frame; Spark batches the inserts of every partition.

        The rows are dealt to the connections first, so the work before the write keeps its
        tasks, and counted on their way.
        """
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.repartition(JDBC_WRITERS).write.format("jdbc").options(**self.options()).mode("append").save()
        return seen.get["rows"]


@dataclass(frozen=True)
class MirrorResult:
    status: str
    error: str | None = None


def mirror(df: DataFrame, days: list[tuple], write: Callable[[DataFrame, list[tuple]], None] | None) -> MirrorResult:
    """Replace the same days on a second target. A failure is reported, never raised.

    ``days`` are the partitions that were replaced or emptied; the target has to clear them
    before it takes the rows, or a reload would repeat them.
    """
    if write is None:
        return MirrorResult("skipped")
    try:
        write(df, days)
    except Exception as error:  # the first write already succeeded and must stand
        return MirrorResult("error", str(error))
    return MirrorResult("success")


def write_export(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Store an export as CSV with a header or as Parquet."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(kind).save(path)
