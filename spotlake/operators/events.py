"""Event log and run log: append-only tables with a "latest row" view on top."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Event types and states
INGESTED, PROCESSED_DATA, DELETED = "DataIngested", "DataProcessed", "DataDeleted"
PENDING, PROCESSED, FAILED = "PENDING", "PROCESSED", "FAILED"
RECORDING, SUCCESS = "RECORDING", "SUCCESS"
MAX_ATTEMPTS = 3
# ---- end of fixed values

KEYS = ("event_type", "aggregate_type", "aggregate_id")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key.

    ``max_by`` reduces inside each task, so a key with a third of the log moves one row per
    task instead of its whole history.
    """
    values = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*values), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"row.{c}").alias(c) for c in values])


def current_state(states: DataFrame) -> DataFrame:
    """Latest state per event from the append-only state log.

    States that share an instant are ordered PENDING, PROCESSED, FAILED.
    """
    rank = F.when(F.col("status") == PENDING, 0).when(F.col("status") == PROCESSED, 1).otherwise(2)
    newest = latest(states.withColumn("rank", rank), ["event_id"], ["at", "rank"]).drop("rank")
    done = F.col("status") != PENDING
    return newest.select(
        "event_id", "status",
        F.when(done, F.col("at")).alias("processed_at"),
        F.when(done, F.col("consumer_id")).alias("consumer_id"),
    )


def current_events(events: DataFrame, states: DataFrame) -> DataFrame:
    """Events with their newest payload and state."""
    newest = latest(events, ["event_id"], ["occurred_at"])
    return newest.join(current_state(states), "event_id", "left").withColumn(
        "status", F.coalesce("status", F.lit(PENDING))
    )


def event_id(attempt: Column) -> Column:
    """Deterministic id, so publishing again after a failure does not add an event."""
    return F.sha2(F.concat_ws("|", *KEYS, attempt.cast("string")), 256)


def open_keys(events: DataFrame) -> DataFrame:
    """Keys that have a pending event, one row each."""
    return events.where(F.col("status") == PENDING).select(*KEYS).distinct()


def to_publish(candidates: DataFrame, events: DataFrame) -> DataFrame:
    """Candidates without a pending event of the same type and aggregate.

    Both sides are reduced to one row per key before the join.
    """
    return candidates.select(*KEYS).distinct().join(open_keys(events), list(KEYS), "left_anti")


def published(candidates: DataFrame, current: DataFrame, at: Column) -> DataFrame:
    """Event rows to append for candidates (keys plus payload), one per key.

    A key with a pending event gets a newer payload under the same id; any other key opens
    its next attempt.
    """
    history = current.groupBy(*KEYS).agg(
        F.count_distinct("event_id").alias("attempts"),
        F.max(F.when(F.col("status") == PENDING, F.col("event_id"))).alias("open_id"),
    )
    attempt = F.coalesce("attempts", F.lit(0)) + 1
    newest = candidates.groupBy(*KEYS).agg(F.max("payload").alias("payload"))
    return newest.join(history, list(KEYS), "left").select(
        F.coalesce("open_id", event_id(attempt)).alias("event_id"),
        *KEYS, "payload", at.alias("occurred_at"),
        F.col("open_id").isNotNull().alias("refreshed"),
    )


def list_events(
    events: DataFrame,
    medium: str | None = None,
    day: str | None = None,
    event_type: str | None = None,
    status: str | None = None,
    limit: int | None = 100,
) -> DataFrame:
    """Newest events first, filtered by equality; all of them without a ``limit``."""
    wanted = {"aggregate_type": medium, "aggregate_id": day, "event_type": event_type, "status": status}
    for column, value in wanted.items():
        if value:
            events = events.where(F.col(column) == value)
    ordered = events.orderBy(F.col("occurred_at").desc(), F.col("event_id").asc())
    return ordered if limit is None else ordered.limit(limit)


def event_detail(events: DataFrame, event_id: str) -> DataFrame:
    """One event by its id; an unknown id gives no row."""
    return events.where(F.col("event_id") == event_id)


def pending_events(events: DataFrame, medium: str | None = None, limit: int | None = 200) -> DataFrame:
    return list_events(events, medium, status=PENDING, limit=limit)


def payload_field(name: str, to: str = "string") -> Column:
    return F.get_json_object("payload", f"$.{name}").try_cast(to)


def replayable(events: DataFrame) -> DataFrame:
    """Ingestion events that did not succeed: the ones a replay puts back to pending."""
    return events.where((F.col("event_type") == INGESTED) & (F.col("status") != PROCESSED))


def state_rows(events: DataFrame, status: str, at: Column, consumer: str | None = None) -> DataFrame:
    """State rows to append for the given events."""
    return events.select(
        "event_id", F.lit(status).alias("status"), at.alias("at"), F.lit(consumer).cast("string").alias("consumer_id")
    )


def failed_by_medium(events: DataFrame) -> DataFrame:
    """Failed events per medium with their total."""
    return events.rollup("aggregate_type").agg(F.count_if(F.col("status") == FAILED).alias("failed_events")).select(
        F.coalesce("aggregate_type", F.lit("total")).alias("medium"), "failed_events"
    )


def failure_counts(events: DataFrame, rejects: DataFrame, broken: DataFrame) -> DataFrame:
    """Per medium: failed events, rejected rows and the broken files waiting for another try."""
    failed = events.where(F.col("status") == FAILED).groupBy(F.col("aggregate_type").alias("medium")).agg(
        F.count("*").alias("failed_events"))
    kept = rejects.groupBy(F.col("tipo").alias("medium")).agg(
        F.count("*").alias("rejected_rows"))
    waiting = broken.groupBy(F.col("tipo").alias("medium")).agg(F.count("*").alias("broken_files"))
    return failed.join(kept, "medium", "full").join(waiting, "medium", "full").select(
        "medium", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("failed_events", "rejected_rows", "broken_files")])


def run_log_current(log: DataFrame) -> DataFrame:
    """Latest row of every run: RECORDING while it works, then its final status and counts."""
    final = F.when(F.col("status") == RECORDING, 0).otherwise(1)
    return latest(log.withColumn("final", final), ["log_id"], ["final", "at"]).drop("final")


def run_summary(days: DataFrame) -> DataFrame:
    """Totals per medium over day results (``medium, extracted, loaded, failed``).

    ``status_any`` calls a run good when at least one day succeeded; ``status_all`` tells
    complete, partial and failed runs apart.
    """
    totals = days.groupBy("medium").agg(
        F.count("*").alias("total_dates"),
        F.count_if(~F.col("failed")).alias("successful_dates"),
        F.count_if("failed").alias("failed_dates"),
        F.sum("extracted").alias("total_extracted"),
        F.sum("loaded").alias("total_loaded"),
    )
    return totals.withColumns({
        "status_any": F.when(F.col("successful_dates") > 0, "success").otherwise("error"),
        "status_all": F.when(F.col("failed_dates") == 0, "success")
        .when(F.col("total_loaded") == 0, "error")
        .otherwise("partial"),
    })


def audit_rows(reads: DataFrame, users: DataFrame, at: Column) -> DataFrame:
    """Audit-log rows for reads (``user, instruction, sql_command, source``)."""
    return user_ids(reads, users).select("id_user", at.alias("at"), "instruction", "sql_command", "source")


def user_ids(log: DataFrame, users: DataFrame, name: str = "user") -> DataFrame:
    """Attach the user id to a log; unknown users get 0. Names are unique in ``users``."""
    ids = users.groupBy(name).agg(F.min("id").alias("id_user"))
    return log.join(ids, name, "left").withColumn("id_user", F.coalesce("id_user", F.lit(0)))
