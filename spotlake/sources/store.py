"""Date-partitioned tables: replace days, delete days, append, refresh a catalogue."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from spotlake.functions.params import as_day
from spotlake.operators.quality import changed_cells, repair
from spotlake.schemas import table_schema


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(38, 2),
    "binary": T.BinaryType(),
}


def _fields(*pairs: str) -> T.StructType:
    named = (pair.split() for pair in pairs)
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in named])


def _with(first: str, schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(first, T.StringType()), *schema.fields])


_EVENT = ("event_id string", "event_type string", "aggregate_type string", "aggregate_id string",
          "payload string", "occurred_at timestamp")

TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "spots": (_with("tipo", table_schema("tv")), ("tipo", "Fecha")),
    "print_ads": (table_schema("impresos"), ("Fecha",)),
    "media_totals": (table_schema("totals"), ("FechaInicio",)),
    "domain_events": (_fields(*_EVENT), ()),
    "event_states": (_fields("event_id string", "status string", "at timestamp", "consumer_id string"), ()),
    "run_log": (
        _fields("log_id string", "source string", "instruction string", "total_rows bigint",
                "total_records bigint", "status string", "error string", "at timestamp"), (),
    ),
    "audit_log": (
        _fields("id_user bigint", "at timestamp", "instruction string", "sql_command string", "source string"), (),
    ),
    # by run and reason, so a batch that is repeated replaces its own rejects
    "rejects": (
        _fields("file_path string", "day string", "row string", "at timestamp", "tipo string", "run string",
                "reason string"), ("tipo", "run", "reason"),
    ),
    "file_log": (
        _fields("drop string", "modified timestamp", "outcome string", "run string", "at timestamp", "tipo string",
                "day string"), ("tipo", "day"),
    ),
    "daily_rollup": (
        _fields("advertiser string", "brand string", "sector string", "rows bigint",
                "spend money", "medium string", "day date"), ("medium", "day"),
    ),
    "distinct_ids": (_fields("value string", "id bigint", "kind string"), ("kind",)),
    "distinct_sets": (
        _fields("kind string", "bucket bigint", "bits binary", "medium string", "day date"), ("medium", "day"),
    ),
    "label_values": (
        _fields("column string", "value string", "medium string", "day date"), ("medium", "day"),
    ),
}


def replaced_days(table: DataFrame, batch: DataFrame, days: Iterable[date], day: str = "Fecha") -> DataFrame:
    """What a table holds after the given days are replaced by ``batch``, as a plain frame.

    The days are literals, so nothing is shuffled and the kept part prunes partitions.
    """
    kept = table.where(~F.coalesce(F.col(day).isin(list(days)), F.lit(False)))
    return kept.unionByName(batch.select(table.columns))


def without_days(table: DataFrame, start: str | date, end: str | date, day: str = "Fecha") -> DataFrame:
    """What a table holds after an inclusive day range is deleted."""
    inside = F.col(day).between(F.lit(as_day(start)), F.lit(as_day(end)))
    return table.where(~F.coalesce(inside, F.lit(False)))


def in_partitions(names: Sequence[str], values: Iterable[tuple]) -> Column:
    """Condition for a list of partitions, in a form that prunes them: per leading value a list."""
    by_lead: dict[tuple, list] = {}
    for *lead, last in values:
        by_lead.setdefault(tuple(lead), []).append(last)
    wanted = F.lit(False)
    for lead, lasts in by_lead.items():
        mine = F.col(names[-1]).isin(lasts)
        for name, value in zip(names, lead):
            mine = mine & (F.col(name) == F.lit(value))
        wanted = wanted | mine
    return wanted


@dataclass(frozen=True)
class Store:
    """The tables of one database in the session catalog."""

    spark: SparkSession
    database: str = "default"

    def __post_init__(self) -> None:
        # an overwrite must touch only the partitions it brings
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def create(self) -> Store:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table, (schema, parts) in TABLES.items():
            columns = [f for f in schema.fields if f.name not in parts]
            columns += [schema[p] for p in parts]
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({ddl}) USING parquet {by}")
        return self

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def parts(self, table: str) -> tuple[str, ...]:
        return TABLES[table][1]

    def _aligned(self, table: str, df: DataFrame) -> DataFrame:
        """Target columns in target order; a column the frame lacks is null."""
        schema = self.read(table).schema
        present = set(df.columns)
        return df.select([
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ])

    def append(self, table: str, df: DataFrame) -> None:
        self._aligned(table, df).write.insertInto(self.name(table))

    def replace_days(self, table: str, df: DataFrame, emptied: Iterable[tuple] = ()) -> None:
        """Overwrite exactly the partitions the frame brings, and drop the ``emptied`` ones.

        Rows are rebalanced by partition before the write: small days share a task and a
        hot day is split over several, so neither many files nor one huge file appears.
        Running it again with the same rows gives the same table.
        """
        parts = self.parts(table)
        aligned = self._aligned(table, df).hint("rebalance", *[F.col(p) for p in parts])
        aligned.write.insertInto(self.name(table), overwrite=True)
        for values in emptied:
            self._drop(table, dict(zip(parts, values, strict=True)))

    def drop(self, table: str, **spec: object) -> None:
        """Drop every partition that has the given values."""
        self._drop(table, spec)

    def _drop(self, table: str, spec: dict) -> None:
        def literal(value: object) -> str:
            return f"DATE'{value}'" if isinstance(value, date) else "'" + str(value).replace("'", "\\'") + "'"

        pairs = ", ".join(f"`{k}`={literal(v)}" for k, v in spec.items())
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({pairs})")

    def _partitions(self, table: str, where: Column) -> list[tuple]:
        """Partition values matching a condition, from the catalog: one row per partition."""
        parts = self.parts(table)
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        types = {f.name: f.dataType for f in TABLES[table][0].fields}
        values = listed.select([
            F.regexp_extract("partition", f"(?:^|/){p}=([^/]*)", 1).try_cast(types[p]).alias(p) for p in parts
        ])
        return [tuple(r) for r in values.where(where).collect()]

    def delete(self, table: str, where: Column) -> int:
        """Drop the partitions that match a condition on the partition columns; returns their rows."""
        doomed = self._partitions(table, where)
        if not doomed:
            return 0
        deleted = self.read(table).where(where).count()
        for values in doomed:
            self._drop(table, dict(zip(self.parts(table), values, strict=True)))
        return deleted

    def delete_days(
        self, table: str, start: str | date, end: str | date | None = None, medium: str | None = None
    ) -> int:
        """Delete an inclusive day range (of one medium in a table that holds several)."""
        day = self.parts(table)[-1]
        where = F.col(day).between(F.lit(as_day(start)), F.lit(as_day(end or start)))
        if medium and "tipo" in self.parts(table):
            where = where & (F.col("tipo") == medium)
        return self.delete(table, where)

    def delete_all(self, table: str) -> int:
        deleted = self.read(table).count()
        self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")
        return deleted

    def repair(self, table: str, null_words: bool = True) -> int:
        """Repair leftover nulls, rewriting only the partitions that have any; returns cells changed."""
        parts = list(self.parts(table))
        rows = self.read(table)
        cells = rows.select(*parts, changed_cells(rows, null_words, parts).alias("cells"))
        dirty = cells.where(F.col("cells") > 0).groupBy(*parts).agg(F.sum("cells").alias("cells")).collect()
        if not dirty:
            return 0
        touched = rows.where(in_partitions(parts, [tuple(r[p] for p in parts) for r in dirty]))
        self.replace_days(table, repair(touched, null_words, parts))
        return sum(r["cells"] for r in dirty)

    def refresh(self, view: str, df: DataFrame, snapshot: str) -> None:
        """Full refresh: write a new snapshot table, then point the view at it.

        Readers see the old catalogue or the new one, never an empty one.
        """
        table = self.name(f"{view}_{snapshot}")
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS SELECT * FROM {table}")

