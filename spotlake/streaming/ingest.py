"""Ingestion: new files in the landing area become replaced days in the tables.

The stream carries one small row per new file (its path and time, never its content), the
counterpart of an object-created notice. Each micro-batch finds the newest drop of every
medium and day it mentions, reads those drops in one plan per file shape, and replaces the
days. A drop that is older than the one a day was loaded from is passed over, whether it
comes late, by backfill or by replay. Rejects are kept by run, and attempts are counted by
run, so a batch that is repeated after a failure changes nothing. Backfills and replays call
the same function with a plain frame. The rollup and the label table follow every load.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from spotlake.functions import dates
from spotlake.functions.params import as_day
from spotlake.operators import events, stats
from spotlake.operators.clean import BAD_DATE, NO_KEY, accepted, clean_live, project_known
from spotlake.schemas import KEY_COLUMN, raw_schema
from spotlake.session import scratch_dir
from spotlake.sources import derived, raw
from spotlake.sources.sinks import MirrorResult, mirror
from spotlake.sources.store import Store, in_partitions

CORRUPT, STRAY = "corrupt", "stray_day"
LOADED, PARTIAL, SUPERSEDED = "loaded", "partial", "superseded"

# bounds the list of paths the driver handles per micro-batch
FILES_PER_BATCH = 1000


def _drop(path: str) -> Column:
    """A file directly in the day's folder is a drop; files deeper down belong to their folder."""
    depth = F.size(F.split(raw.key_of_path(F.col(path)), "/"))
    deep_file = (depth > 4) & F.col(path).endswith(".json")
    return F.when(deep_file, F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(F.col(path))


def _now() -> str:
    return datetime.now(UTC).strftime("%Y%m%d%H%M%S%f")


@dataclass(frozen=True)
class Ingest:
    store: Store
    landing: str
    mirror_to: Callable[[DataFrame, list[tuple]], None] | None = None
    consumer: str = "spotlake"

    # -- arrivals ---------------------------------------------------------------------

    def _files(self, reader, below: str = "") -> DataFrame:
        """Path and time of landing files; ``binaryFile`` opens none of them for this."""
        listed = reader.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
        return listed.load(f"{self.landing.rstrip('/')}/{raw.ROOT}{below}").select("path", "modificationTime")

    def _files_of(self, medium: str, days: Iterable[str]) -> DataFrame | None:
        """Landing files in the folders of some days (or day patterns), None if there are none."""
        try:
            return self._files(self.store.spark.read, f"/{medium}/{{{','.join(sorted(set(days)))}}}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def start(
        self, checkpoint: str | None = None, files_per_batch: int = FILES_PER_BATCH, **trigger
    ) -> StreamingQuery:
        """Start the arrival stream; the default trigger handles what is there and stops.

        The checkpoint lies in the shared folder of the session unless another is named.
        """
        spark = self.store.spark
        checkpoint = checkpoint or f"{scratch_dir(spark)}/ingest/{self.store.database}"
        schema = "path string, modificationTime timestamp, length bigint, content binary"
        # a drop that keeps an old file time is as good as any other
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option(
            "maxFileAge", "36500d")
        return (
            self._files(reader)
            .writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(lambda batch, batch_id: self.process(batch, f"stream-{batch_id}"))
            .start()
        )

    def backfill(self, medium: str, start: str | date, end: str | date, force: bool = False) -> DataFrame:
        """Load a range of landed days; days that already have rows are left alone.

        Days are taken together up to the file bound of a micro-batch, so a long range is a
        few large jobs. Returns the report: one line per landed day with status and rows.
        """
        first, last = as_day(start), as_day(end)
        months = {f"{y}{m:02d}*" for y in range(first.year, last.year + 1) for m in range(1, 13)
                  if (first.year, first.month) <= (y, m) <= (last.year, last.month)}
        files = self._files_of(medium, months)
        if files is None:
            return self.store.spark.createDataFrame([], "Fecha date, status string, records bigint")
        parts = raw.path_parts(raw.key_of_path(F.col("path")))
        files = files.withColumn("Fecha", dates.day_from_key(parts["day"])).where(
            F.col("Fecha").between(F.lit(first), F.lit(last)))
        landed = files.groupBy("Fecha").agg(F.count("*").alias("files"))
        # one row per day, held because the report must tell what was there before the load
        plan = stats.load_report(self._rows(medium, first, last), landed.select("Fecha")).join(
            landed, "Fecha").orderBy("Fecha").collect()
        wanted = [r for r in plan if force or r["status"] == "accepted"]
        chunk: list[date] = []
        held = 0
        for row in wanted:
            if chunk and held + row["files"] > FILES_PER_BATCH:
                self._load_chunk(files, medium, chunk)
                chunk, held = [], 0
            chunk.append(row["Fecha"])
            held += row["files"]
        if chunk:
            self._load_chunk(files, medium, chunk)
        taken = {r["Fecha"] for r in wanted}
        status = self.store.spark.createDataFrame(
            [(r["Fecha"], "accepted" if r["Fecha"] in taken else "skipped") for r in plan],
            "Fecha date, status string",
        )
        records = self._rows(medium, first, last).groupBy("Fecha").agg(F.count("*").alias("records"))
        return status.join(records, "Fecha", "left").withColumn("records", F.coalesce("records", F.lit(0)))

    def _load_chunk(self, files: DataFrame, medium: str, days: list[date]) -> None:
        chosen = files.where(F.col("Fecha").isin(days)).select("path", "modificationTime")
        self.process(chosen, f"backfill-{medium}-{days[0]}-{days[-1]}")

    def _rows(self, medium: str, start: date, end: date) -> DataFrame:
        rows = self.store.read("print_ads" if medium == "impresos" else "spots")
        if medium != "impresos":
            rows = rows.where(F.col("tipo") == medium)
        return rows.where(F.col("Fecha").between(F.lit(start), F.lit(end)))

    # -- one batch --------------------------------------------------------------------

    def process(self, files: DataFrame, run: str) -> None:
        """Replace every medium and day that the files mention; the newest drop of a day wins."""
        spark = self.store.spark
        parts = raw.path_parts(raw.key_of_path(F.col("path")))
        valid_day = F.when(parts["outcome"] == "ok", F.when(dates.is_day_key(parts["day"]), "ok").otherwise("bad_path"))
        named = files.select(
            "path", "modificationTime", parts["medium"].alias("medium"), parts["day"].alias("day"),
            F.coalesce(valid_day, parts["outcome"]).alias("outcome"), _drop("path").alias("drop"),
        )
        self.store.drop("rejects", run=run)
        self._reject_paths(named.where(F.col("outcome") != "ok"), run)

        newest = F.max_by(F.struct("drop", F.col("drop").endswith(".json").alias("single"), "modificationTime"),
                          F.struct("modificationTime", "drop"))
        found = named.where(F.col("outcome") == "ok").groupBy("medium", "day").agg(newest.alias("d")).select(
            "medium", "day", "d.drop", "d.single", "d.modificationTime"
        ).collect()  # one short row per medium and day, bounded by the files of a batch
        drops = self._without_superseded(found, run)
        if not drops:
            return

        days = spark.createDataFrame(
            [(d["medium"], d["day"], d["drop"]) for d in drops], "medium string, day string, drop string"
        )
        ids = self._publish(days, run)
        rows = self._read(drops).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._load(rows, drops, ids, run)
        finally:
            rows.unpersist()

    def _log_of(self, found: list) -> DataFrame:
        """The file log of the media and days of some drops."""
        where = in_partitions(("tipo", "day"), [(d["medium"], d["day"]) for d in found])
        return self.store.read("file_log").where(where)

    def _without_superseded(self, found: list, run: str) -> list:
        """Drops that are not older than the one their day was loaded from."""
        if not found:
            return []
        loaded = self._log_of(found).where(F.col("outcome").isin(LOADED, PARTIAL)).groupBy("tipo", "day").agg(
            F.max("modified").alias("modified")).collect()
        newest = {(r["tipo"], r["day"]): r["modified"] for r in loaded}
        old = [d for d in found if newest.get((d["medium"], d["day"]), d["modificationTime"]) > d["modificationTime"]]
        if old:
            self._log_files([(d, SUPERSEDED) for d in old], run)
            keys = self.store.spark.createDataFrame(
                [(events.INGESTED, d["medium"], d["day"]) for d in old], f"{', '.join(f'{k} string' for k in events.KEYS)}")
            waiting = self._current(keys).where(F.col("status") == events.PENDING)
            self.store.append("event_states", events.state_rows(
                waiting, events.PROCESSED, F.current_timestamp(), SUPERSEDED))
        return [d for d in found if d not in old]

    def _log_files(self, outcomes: list[tuple], run: str) -> None:
        frame = self.store.spark.createDataFrame(
            [(d["drop"], d["modificationTime"], outcome, run, d["medium"], d["day"]) for d, outcome in outcomes],
            "drop string, modified timestamp, outcome string, run string, tipo string, day string")
        self.store.append("file_log", frame.withColumn("at", F.current_timestamp()))

    def _current(self, keys: DataFrame) -> DataFrame:
        """Events of some keys with their state; only the states of these events are aggregated."""
        history = self.store.read("domain_events").join(keys.select(*events.KEYS).distinct(), list(events.KEYS), "left_semi")
        states = self.store.read("event_states").join(history.select("event_id").distinct(), "event_id", "left_semi")
        return events.current_events(history, states)

    def _read(self, drops: list) -> DataFrame:
        """All rows of the drops as text, tagged with medium, day and reject reason."""
        spark, schema = self.store.spark, raw_schema("tv", "impresos")
        frames = []
        for single, read in ((True, raw.read_files), (False, raw.read_lines)):
            paths = [d["drop"] for d in drops if d["single"] == single]
            if paths:
                frames.append(read(spark, paths, schema))
        rows = raw.union_feeds(*frames)
        parts = raw.path_parts(raw.key_of_path(F.col("file_path")))
        rows = rows.withColumns({"medium": parts["medium"], "path_day": parts["day"]})
        day = dates.feed_date(F.col("Fecha"))
        key = F.when(F.col("medium") == "impresos", F.col(KEY_COLUMN["impresos"])).otherwise(F.col(KEY_COLUMN["tv"]))
        return rows.withColumn(
            "reason",
            F.when(F.col("_corrupt_record").isNotNull(), CORRUPT)
            .when(day.isNull(), BAD_DATE)
            .when(key.isNull(), NO_KEY)
            .when(day != dates.day_from_key(F.col("path_day")), STRAY),
        )

    def _load(self, rows: DataFrame, drops: list, ids: dict, run: str) -> None:
        counted = {
            (r["medium"], r["path_day"]): r
            for r in rows.groupBy("medium", "path_day").agg(
                F.count("*").alias("rows"),
                F.count_if(F.col("reason").isNull()).alias("valid"),
                F.count_if(F.col("reason") == CORRUPT).alias("corrupt"),
            ).collect()
        }
        if any(r["rows"] > r["valid"] for r in counted.values()):
            self._reject_rows(rows.where(F.col("reason").isNotNull()), run)

        # a broken document leaves its day as it was; a day whose rows are all bad becomes empty
        failed = {k for k, r in counted.items() if r["corrupt"] and not r["valid"]}
        emptied = [k for k, r in counted.items() if not r["valid"] and k not in failed]

        good = rows.where(F.col("reason").isNull())
        results = {}
        for media, table in ((("tv", "radio"), "spots"), (("impresos",), "print_ads")):
            if not any(medium in media for medium, _ in ids):
                continue
            chosen = good.where(F.col("medium").isin(*media)).withColumn("tipo", F.col("medium"))
            cleaned = accepted(clean_live(media[0], chosen, keep=("tipo",)))
            loaded = cleaned.select("tipo", *project_known(media[0], cleaned).columns)
            gone = [(m, as_day(d)) if table == "spots" else (as_day(d),) for m, d in emptied if m in media]
            self.store.replace_days(table, loaded, emptied=gone)
            kept = [(m, as_day(d)) if table == "spots" else (as_day(d),)
                    for (m, d), r in counted.items() if m in media and r["valid"]]
            results[media] = mirror(self._written(table, media, counted), kept + gone, self.mirror_to)
        derived.refresh(self.store, sorted({as_day(d) for k, d in ids if (k, d) not in failed and (k, d) in counted}))

        def outcome(drop) -> str:
            seen = counted.get((drop["medium"], drop["day"]))
            if seen is None or not seen["corrupt"]:
                return LOADED
            return PARTIAL if seen["valid"] else CORRUPT

        self._log_files([(d, outcome(d)) for d in drops], run)
        attempts = {}
        if failed:
            tried = self._attempts(self._log_of(drops))
            attempts = {(r["tipo"], r["day"]): r["attempt"] for r in tried.where(F.col("drop").isin(
                [d["drop"] for d in drops])).collect()}
        self._finish(counted, failed, ids, attempts, results, run)

    def _written(self, table: str, media: tuple[str, ...], counted: dict) -> DataFrame:
        """The rows just stored, read back from their partitions instead of being cleaned twice."""
        loaded = [(m, as_day(day)) for (m, day), r in counted.items() if m in media and r["valid"]]
        values = loaded if table == "spots" else [(day,) for _, day in loaded]
        return self.store.read(table).where(in_partitions(self.store.parts(table), values))

    # -- control rows: one per medium and day --------------------------------------------

    def _publish(self, days: DataFrame, run: str) -> dict[tuple[str, str], str]:
        """Write the events before the data; returns the event id of every medium and day."""
        store = self.store
        candidates = days.select(
            F.lit(events.INGESTED).alias("event_type"),
            F.col("medium").alias("aggregate_type"),
            F.col("day").alias("aggregate_id"),
            F.to_json(F.struct(F.col("drop").alias("path"), F.col("day").alias("fecha"))).alias("payload"),
        )
        rows = events.published(candidates, self._current(candidates), F.current_timestamp()).collect()
        frame = store.spark.createDataFrame(
            [tuple(r) for r in rows],
            "event_id string, event_type string, aggregate_type string, aggregate_id string, payload string, "
            "occurred_at timestamp, refreshed boolean",
        )
        store.append("domain_events", frame)
        store.append("event_states", events.state_rows(
            frame.where(~F.col("refreshed")), events.PENDING, F.col("occurred_at")))
        store.append("run_log", frame.select(
            self._log_id(run), F.concat_ws("/", "aggregate_type", "aggregate_id").alias("source"),
            F.lit("INSERT").alias("instruction"), F.lit(0).alias("total_rows"), F.lit(0).alias("total_records"),
            F.lit(events.RECORDING).alias("status"), F.lit(None).cast("string").alias("error"),
            F.col("occurred_at").alias("at"),
        ))
        return {(r["aggregate_type"], r["aggregate_id"]): r["event_id"] for r in rows}

    @staticmethod
    def _log_id(run: str) -> Column:
        return F.concat_ws("/", F.lit(run), "aggregate_type", "aggregate_id").alias("log_id")

    def _finish(self, counted, failed, ids, attempts, results, run: str) -> None:
        """State and log rows after the data is written."""
        lines = []
        for (medium, day), event_id in ids.items():
            seen = counted.get((medium, day))
            broken = (medium, day) in failed
            gave_up = broken and attempts.get((medium, day), 1) >= events.MAX_ATTEMPTS
            state = events.FAILED if gave_up else None if broken else events.PROCESSED
            copy = next((r for media, r in results.items() if medium in media), MirrorResult("skipped"))
            lines.append((
                event_id, state, medium, day, seen["rows"] if seen else 0, seen["valid"] if seen else 0,
                "ERROR" if broken else events.SUCCESS, CORRUPT if broken else copy.error,
            ))
        frame = self.store.spark.createDataFrame(
            lines, "event_id string, state string, aggregate_type string, aggregate_id string, total_rows bigint, "
                   "total_records bigint, status string, error string",
        ).withColumn("at", F.current_timestamp())
        self.store.append("event_states", frame.where(F.col("state").isNotNull()).select(
            "event_id", F.col("state").alias("status"), "at", F.lit(self.consumer).alias("consumer_id")))
        self.store.append("run_log", frame.select(
            self._log_id(run), F.concat_ws("/", "aggregate_type", "aggregate_id").alias("source"),
            F.lit("INSERT").alias("instruction"), "total_rows", "total_records", "status", "error", "at"))

    # -- rejects ----------------------------------------------------------------------

    def _reject_paths(self, named: DataFrame, run: str) -> None:
        self.store.replace_days("rejects", named.select(
            F.coalesce("medium", F.lit("unknown")).alias("tipo"), F.col("path").alias("file_path"), "day",
            F.col("outcome").alias("reason"), F.lit(None).cast("string").alias("row"), F.lit(run).alias("run"),
            F.current_timestamp().alias("at"),
        ))

    def _reject_rows(self, bad: DataFrame, run: str) -> None:
        text = F.coalesce("_corrupt_record", F.to_json(F.struct(
            *[f.name for f in raw_schema("tv", "impresos").fields if f.name != "_corrupt_record"])))
        self.store.replace_days("rejects", bad.select(
            F.col("medium").alias("tipo"), "file_path", F.col("path_day").alias("day"), "reason", text.alias("row"),
            F.lit(run).alias("run"), F.current_timestamp().alias("at"),
        ))

    @staticmethod
    def _attempts(log: DataFrame) -> DataFrame:
        """Drops whose last outcome is broken, with the runs that have failed since they last loaded."""
        broken = F.col("outcome").isin(CORRUPT, PARTIAL)
        good = log.where(~broken).groupBy("tipo", "day", "drop").agg(F.max("at").alias("good_at"))
        tried = log.where(broken).join(good, ["tipo", "day", "drop"], "left").where(
            F.col("good_at").isNull() | (F.col("at") > F.col("good_at")))
        return tried.groupBy("tipo", "drop", "day").agg(F.count_distinct("run").alias("attempt"))

    def broken_files(self, medium: str | None = None) -> DataFrame:
        """Drops that could not be read, with the number of attempts so far. A drop that is read
        in the end, or gives way to a newer one of its day, is broken no longer."""
        log = self.store.read("file_log")
        return self._attempts(log.where(F.col("tipo") == medium) if medium else log)

    def list_rejects(self, medium: str, limit: int = 10) -> DataFrame:
        rows = self.store.read("rejects").where(F.col("tipo") == medium)
        return rows.orderBy(F.col("at").desc(), "file_path", "row").limit(limit)

    def redeliver(self) -> None:
        """Try broken files again that still have attempts left."""
        self._again(self.broken_files().where(F.col("attempt") < events.MAX_ATTEMPTS), f"redeliver-{_now()}")

    def replay_failed(self, medium: str) -> None:
        """Put the failed events of a medium back to pending and ingest its broken files anew.

        The rejects of earlier runs go last, when the files have been read: a crash before
        that leaves the list as it was.
        """
        run = f"replay-{medium}-{_now()}"
        self._reopen(events.INGESTED, medium)
        self._again(self.broken_files(medium), run)
        self.store.delete("rejects", (F.col("tipo") == medium) & (F.col("reason") == CORRUPT) & ~F.col("run").startswith(run))

    def replay_event(self, event_id: str) -> None:
        """Put one ingestion event back to pending and read its file again."""
        found = self.store.read("domain_events").where(F.col("event_id") == event_id)
        row = events.latest(found, ["event_id"], ["occurred_at"]).first()
        if row is None or row["event_type"] != events.INGESTED:
            raise ValueError("only existing ingestion events can be replayed")
        self.store.append("event_states", events.state_rows(found.limit(1), events.PENDING, F.current_timestamp()))
        path = found.orderBy(F.col("occurred_at").desc()).limit(1).select(
            F.col("aggregate_type").alias("tipo"), F.get_json_object("payload", "$.path").alias("drop"),
            F.col("aggregate_id").alias("day"))
        self._again(path, f"replay-{event_id}-{_now()}")

    def _reopen(self, event_type: str, medium: str) -> None:
        mine = self.store.read("domain_events").where(
            (F.col("event_type") == event_type) & (F.col("aggregate_type") == medium))
        failed = events.current_events(mine, self.store.read("event_states")).where(F.col("status") == events.FAILED)
        self.store.append("event_states", events.state_rows(failed, events.PENDING, F.current_timestamp(), "replay"))

    def _again(self, drops: DataFrame, run: str) -> None:
        """Read drops (tipo, drop, day) anew, at most a micro-batch of them at a time.

        The files keep their own times, so an old file cannot replace a newer day.
        """
        for number, page in enumerate(self._pages(drops)):
            for medium in sorted({r["tipo"] for r in page}):
                mine = [r for r in page if r["tipo"] == medium]
                files = self._files_of(medium, (r["day"] for r in mine))
                if files is not None:
                    chosen = files.where(_drop("path").isin([r["drop"] for r in mine]))
                    self.process(chosen, f"{run}-{number}-{medium}")

    @staticmethod
    def _pages(drops: DataFrame) -> Iterator[list]:
        after = None
        while True:
            rest = drops if after is None else drops.where(F.struct("tipo", "drop") > F.struct(*map(F.lit, after)))
            page = rest.orderBy("tipo", "drop").limit(FILES_PER_BATCH).collect()
            if not page:
                return
            yield page
            after = (page[-1]["tipo"], page[-1]["drop"])

    def purge_rejects(self, medium: str) -> int:
        return self.store.delete("rejects", F.col("tipo") == medium)

    # -- deletion ---------------------------------------------------------------------

    def failure_counts(self) -> DataFrame:
        """Failed events, rejected rows and broken files per medium."""
        current = events.current_events(self.store.read("domain_events"), self.store.read("event_states"))
        return events.failure_counts(current, self.store.read("rejects"), self.broken_files())

    def delete_days(
        self, medium: str, start: str | date, end: str | date | None = None, raw_files: bool = False
    ) -> int:
        """Delete a day range (and, on request, its raw files); returns the rows deleted.

        The deletion is recorded as an event that is already processed.
        """
        store = self.store
        first, last = as_day(start), as_day(end or start)
        table = "print_ads" if medium == "impresos" else "spots"
        files = raw.delete_raw(store.spark, self.landing, medium, first, last) if raw_files else 0
        touched = [r["Fecha"] for r in self._rows(medium, first, last).select("Fecha").distinct().collect()]
        deleted = store.delete_days(table, first, last, medium)
        derived.refresh(store, touched)
        key = first.strftime("%Y%m%d") if first == last else f"{first:%Y%m%d}_{last:%Y%m%d}"
        row = store.spark.range(1).select(
            F.lit(events.DELETED).alias("event_type"), F.lit(medium).alias("aggregate_type"),
            F.lit(key).alias("aggregate_id"), F.current_timestamp().alias("occurred_at"),
            F.to_json(F.struct(
                F.lit(str(first)).alias("fecha_inicio"), F.lit(str(last)).alias("fecha_fin"),
                F.lit(files).alias("raw_files_deleted"), F.lit(deleted).alias("db_records_deleted"),
            )).alias("payload"),
        ).withColumn("event_id", events.event_id(F.col("occurred_at")))
        saved = store.spark.createDataFrame(row.collect(), row.schema)
        store.append("domain_events", saved)
        store.append("event_states", events.state_rows(saved, events.PROCESSED, F.col("occurred_at"), "delete"))
        return deleted
