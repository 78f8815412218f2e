"""Arrival stream, backfill, rejects, replay and deletion on real files."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from spotlake.operators import events
from spotlake.schemas import raw_schema
from spotlake.sources import raw
from spotlake.streaming.ingest import Ingest

DAY = date(2026, 1, 5)


def put(landing, medium, day, rows, name="data.json"):
    path = landing / "rawdata" / medium / day / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(rows if isinstance(rows, str) else json.dumps(rows))
    return path


def spot(number, day="20260105", **more):
    return {"Fecha": day, "IdDeteccion": number, "Marca": "Café", "Tarifa": "2.5", **more}


def ad(number, day="20260105", **more):
    return {"Fecha": day, "IdMedio": number, "Marca": "Ñandú", "Costo": 3, **more}


@pytest.fixture
def ingest(store, tmp_path):
    return Ingest(store, f"file://{tmp_path}")


def run_stream(ingest, tmp_path):
    query = ingest.start(str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None


def table(store, name, *columns):
    return sorted(tuple(r) for r in store.read(name).select(*columns).collect())


def states(store):
    """State of the newest event of every medium and day."""
    current = events.current_events(store.read("domain_events"), store.read("event_states"))
    newest = current.orderBy("occurred_at").collect()
    return {(r["aggregate_type"], r["aggregate_id"]): r["status"] for r in newest}


def test_stream_loads_all_media_and_sorts_out_bad_rows(spark, store, ingest, tmp_path):
    put(tmp_path, "tv", "20260105", [
        spot(1), spot(2, "2026-01-05T00:00:00"), spot(3, "sin fecha"), spot(4, "20260106"),
        {"Fecha": "20260105", "Marca": "x"}, spot(5, Foo=1)])
    put(tmp_path, "radio", "20260105", [spot(7)])
    put(tmp_path, "impresos", "20260106", [ad(1, "20260106"), ad(None, "20260106")])
    put(tmp_path, "cine", "20260105", [spot(9)])
    put(tmp_path, "tv", "20260107", [])
    run_stream(ingest, tmp_path)
    assert table(store, "spots", "tipo", "Fecha", "IdDeteccion", "Marca", "Tarifa") == [
        ("radio", DAY, 7, "CAFE", 2.5), ("tv", DAY, 1, "CAFE", 2.5), ("tv", DAY, 2, "CAFE", 2.5), ("tv", DAY, 5, "CAFE", 2.5)]
    assert table(store, "print_ads", "Fecha", "IdMedio", "Marca", "Costo") == [(date(2026, 1, 6), 1, "NANDU", 3.0)]
    assert table(store, "rejects", "tipo", "reason") == [
        ("cine", "unknown_medium"), ("impresos", "missing_key"), ("tv", "bad_date"), ("tv", "missing_key"), ("tv", "stray_day")]
    assert states(store) == {(m, d): "PROCESSED" for m, d in (
        ("tv", "20260105"), ("radio", "20260105"), ("impresos", "20260106"), ("tv", "20260107"))}
    log = {r["source"]: (r["status"], r["total_rows"], r["total_records"]) for r in events.run_log_current(store.read("run_log")).collect()}
    assert log["tv/20260105"] == ("SUCCESS", 6, 3) and log["tv/20260107"] == ("SUCCESS", 0, 0)


def test_running_again_changes_nothing(store, ingest, tmp_path):
    put(tmp_path, "tv", "20260105", [spot(1), spot(2)])
    run_stream(ingest, tmp_path)
    before = table(store, "spots", *store.read("spots").columns[:3], "IdDeteccion")
    run_stream(ingest, tmp_path)
    ingest.backfill("tv", DAY, DAY, force=True)
    assert table(store, "spots", *store.read("spots").columns[:3], "IdDeteccion") == before


def test_new_version_of_a_day_replaces_it(store, ingest, tmp_path):
    import os

    first = put(tmp_path, "tv", "20260105", [spot(1), spot(2)])
    run_stream(ingest, tmp_path)
    put(tmp_path, "tv", "20260105", [spot(3)], "data-2.json")
    os.utime(first, (1_600_000_000, 1_600_000_000))
    run_stream(ingest, tmp_path)
    assert table(store, "spots", "IdDeteccion") == [(3,)]


def test_newest_drop_of_a_batch_wins(store, ingest, tmp_path):
    import os

    old = put(tmp_path, "tv", "20260105", [spot(1)], "b.json")
    put(tmp_path, "tv", "20260105", [spot(2)], "a.json")
    os.utime(old, (1_600_000_000, 1_600_000_000))
    run_stream(ingest, tmp_path)
    assert table(store, "spots", "IdDeteccion") == [(2,)]


def test_written_drop_of_many_files_is_one_unit(spark, store, ingest, tmp_path):
    schema = raw_schema("tv")
    rows = spark.range(50).select(
        F.lit("20260105").alias("Fecha"), F.col("id").cast("string").alias("IdDeteccion")).repartition(5)
    path, written = raw.write_raw(rows, f"file://{tmp_path}", "tv", DAY, "drop-1")
    assert written == 50 and raw.read_lines(spark, path, schema).count() == 50
    query = ingest.start(str(tmp_path / "checkpoint"), files_per_batch=1)
    query.awaitTermination()
    assert store.read("spots").count() == 50


def test_day_with_only_bad_rows_becomes_empty(store, ingest, tmp_path):
    put(tmp_path, "tv", "20260105", [spot(1)])
    run_stream(ingest, tmp_path)
    put(tmp_path, "tv", "20260105", [spot(None)], "later.json")
    run_stream(ingest, tmp_path)
    assert store.read("spots").isEmpty()


def test_broken_file_keeps_the_day_and_fails_after_three_tries(store, ingest, tmp_path):
    put(tmp_path, "tv", "20260105", [spot(1)])
    run_stream(ingest, tmp_path)
    broken = put(tmp_path, "tv", "20260105", '[{"Fecha": "20260105", ', "broken.json")
    put(tmp_path, "radio", "20260105", [spot(2)])
    run_stream(ingest, tmp_path)
    assert table(store, "spots", "tipo", "IdDeteccion") == [("radio", 2), ("tv", 1)]
    assert states(store)["tv", "20260105"] == "PENDING" and states(store)["radio", "20260105"] == "PROCESSED"
    ingest.redeliver()
    assert states(store)["tv", "20260105"] == "PENDING"
    ingest.redeliver()
    assert states(store)["tv", "20260105"] == "FAILED"
    assert [r["attempt"] for r in ingest.broken_files("tv").collect()] == [3]
    assert [tuple(r) for r in ingest.failure_counts().collect()] == [("tv", 1, 3, 1)]
    ingest.redeliver()  # nothing is left to try
    assert len(ingest.list_rejects("tv").collect()) == 3

    broken.write_text(json.dumps([spot(5)]))
    ingest.replay_failed("tv")
    assert table(store, "spots", "tipo", "IdDeteccion") == [("radio", 2), ("tv", 5)]
    assert states(store)["tv", "20260105"] == "PROCESSED"
    assert ingest.purge_rejects("tv") == 0


def test_purge_drops_the_rejects_of_one_medium(store, ingest, tmp_path):
    put(tmp_path, "tv", "20260105", [spot(1, "x")])
    put(tmp_path, "radio", "20260105", [spot(1, "x")])
    run_stream(ingest, tmp_path)
    assert ingest.purge_rejects("tv") == 1
    assert table(store, "rejects", "tipo") == [("radio",)]


def test_replay_of_one_event_reads_its_file_again(store, ingest, tmp_path):
    path = put(tmp_path, "tv", "20260105", [spot(1)])
    run_stream(ingest, tmp_path)
    event = store.read("domain_events").first()["event_id"]
    path.write_text(json.dumps([spot(8)]))
    ingest.replay_event(event)
    assert table(store, "spots", "IdDeteccion") == [(8,)]
    assert states(store) == {("tv", "20260105"): "PROCESSED"}
    with pytest.raises(ValueError, match="ingestion"):
        ingest.replay_event("nobody")


def test_backfill_skips_loaded_days_and_reports(store, ingest, tmp_path):
    for day in ("20260105", "20260106", "20260107"):
        put(tmp_path, "tv", day, [spot(1, day), spot(2, day)])
    ingest.backfill("tv", "20260105", "20260105")
    put(tmp_path, "tv", "20260105", [spot(9)], "zz.json")
    report = {r["Fecha"].day: (r["status"], r["records"]) for r in ingest.backfill("tv", "20260105", "20260106").collect()}
    assert report == {5: ("skipped", 2), 6: ("accepted", 2)}
    forced = ingest.backfill("tv", "20260105", "20260105", force=True).collect()
    assert [(r["status"], r["records"]) for r in forced] == [("accepted", 1)]


def test_stream_and_backfill_agree(spark, store, ingest, tmp_path):
    from spotlake.sources.store import Store

    for day in ("20260105", "20260106"):
        put(tmp_path, "radio", day, [spot(n, day) for n in range(5)])
    run_stream(ingest, tmp_path)
    other = Store(spark, store.database + "_b").create()
    Ingest(other, ingest.landing).backfill("radio", "20260101", "20260131")
    columns = store.read("spots").columns
    assert table(store, "spots", F.to_json(F.struct(*columns))) == table(other, "spots", F.to_json(F.struct(*columns)))
    spark.sql(f"DROP DATABASE `{other.database}` CASCADE")


def test_mirror_failure_is_recorded_but_harmless(store, tmp_path):
    def broken(_, days):
        raise OSError("mirror is down")

    put(tmp_path, "tv", "20260105", [spot(1)])
    ingest = Ingest(store, f"file://{tmp_path}", mirror_to=broken)
    run_stream(ingest, tmp_path)
    assert store.read("spots").count() == 1
    last = events.run_log_current(store.read("run_log")).first()
    assert (last["status"], last["error"]) == ("SUCCESS", "mirror is down")


def test_long_backfill_runs_in_bounded_chunks(store, ingest, tmp_path, monkeypatch):
    from spotlake.streaming import ingest as module

    monkeypatch.setattr(module, "FILES_PER_BATCH", 2)
    for day in ("20260105", "20260106", "20260107"):
        put(tmp_path, "impresos", day, [ad(1, day)])
    report = ingest.backfill("impresos", "20260101", "20260131").collect()
    assert [(r["status"], r["records"]) for r in sorted(report)] == [("accepted", 1)] * 3
    runs = {r["log_id"].split("/")[0] for r in store.read("run_log").collect()}
    assert runs == {"backfill-impresos-2026-01-05-2026-01-06", "backfill-impresos-2026-01-07-2026-01-07"}


def test_mirror_gets_the_stored_rows(store, tmp_path):
    copies = []
    put(tmp_path, "tv", "20260105", [spot(1), spot(2)])
    put(tmp_path, "radio", "20260106", [spot(3, "20260106")])
    put(tmp_path, "impresos", "20260105", [ad(4)])
    Ingest(store, f"file://{tmp_path}", mirror_to=lambda df, days: copies.append((df.count(), sorted(days)))).process(
        Ingest(store, f"file://{tmp_path}")._files(store.spark.read), "run")
    assert copies == [(3, [("radio", date(2026, 1, 6)), ("tv", DAY)]), (1, [(DAY,)])]


def test_mirror_that_clears_its_days_never_repeats_rows(spark, store, tmp_path):
    from spotlake.sources.store import Store

    other = Store(spark, store.database + "_m").create()

    def write(rows, days):
        table_ = "spots" if len(days[0]) == 2 else "print_ads"
        present = {tuple(r) for r in rows.select(*other.parts(table_)).distinct().collect()}
        other.replace_days(table_, rows, emptied=[d for d in days if d not in present])

    ingest = Ingest(store, f"file://{tmp_path}", mirror_to=write)
    put(tmp_path, "tv", "20260105", [spot(1), spot(2)])
    run_stream(ingest, tmp_path)
    for _ in range(2):
        ingest.backfill("tv", DAY, DAY, force=True)
    assert table(other, "spots", "IdDeteccion") == [(1,), (2,)]
    put(tmp_path, "tv", "20260105", [spot(None)], "later.json")
    run_stream(ingest, tmp_path)
    assert other.read("spots").isEmpty() and store.read("spots").isEmpty()
    spark.sql(f"DROP DATABASE `{other.database}` CASCADE")


def test_an_old_file_never_replaces_a_newer_day(store, ingest, tmp_path):
    import os

    broken = put(tmp_path, "tv", "20260105", "[{", "broken.json")
    run_stream(ingest, tmp_path)
    assert ingest.broken_files("tv").count() == 1
    broken.write_text(json.dumps([spot(1)]))
    os.utime(broken, (1_700_000_000, 1_700_000_000))
    ingest.redeliver()
    assert table(store, "spots", "IdDeteccion") == [(1,)] and ingest.broken_files("tv").isEmpty()
    put(tmp_path, "tv", "20260105", [spot(2)], "newer.json")
    run_stream(ingest, tmp_path)
    assert table(store, "spots", "IdDeteccion") == [(2,)]
    ingest.redeliver()
    ingest.replay_failed("tv")
    first = store.read("domain_events").orderBy("occurred_at").first()["event_id"]
    ingest.replay_event(first)
    late = put(tmp_path, "tv", "20260105", [spot(3)], "late.json")
    os.utime(late, (1_700_000_001, 1_700_000_001))
    run_stream(ingest, tmp_path)
    assert table(store, "spots", "IdDeteccion") == [(2,)]
    assert set(states(store).values()) == {"PROCESSED"}


def test_a_late_drop_with_an_old_time_is_read(store, ingest, tmp_path):
    import os

    put(tmp_path, "tv", "20260106", [spot(2, "20260106")])
    run_stream(ingest, tmp_path)
    late = put(tmp_path, "tv", "20260105", [spot(1)])
    os.utime(late, (1_500_000_000, 1_500_000_000))
    run_stream(ingest, tmp_path)
    assert table(store, "spots", "IdDeteccion") == [(1,), (2,)]


def test_the_same_batch_twice_changes_no_log(store, ingest, tmp_path):
    put(tmp_path, "tv", "20260105", [spot(1), spot(2, "x"), spot(None)])
    put(tmp_path, "radio", "20260105", "[{")
    put(tmp_path, "cine", "20260105", [spot(9)])
    files = ingest._files(store.spark.read)
    seen = []
    for _ in range(2):
        ingest.process(files, "stream-0")
        seen.append((table(store, "rejects", "tipo", "reason", "run"), table(store, "spots", "IdDeteccion"),
                     [tuple(r) for r in ingest.broken_files().select("tipo", "attempt").collect()], states(store)))
    assert seen[0] == seen[1]
    assert seen[0][2] == [("radio", 1)] and len(seen[0][0]) == 4


def test_a_crash_before_clearing_keeps_the_list(store, ingest, tmp_path, monkeypatch):
    path = put(tmp_path, "tv", "20260105", "[{")
    run_stream(ingest, tmp_path)
    monkeypatch.setattr(Ingest, "process", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest.replay_failed("tv")
    monkeypatch.undo()
    assert len(ingest.list_rejects("tv").collect()) == 1 and ingest.broken_files("tv").count() == 1
    path.write_text(json.dumps([spot(4)]))
    ingest.replay_failed("tv")
    assert table(store, "spots", "IdDeteccion") == [(4,)] and ingest.list_rejects("tv").isEmpty()


def test_replay_goes_through_the_file_bound(store, ingest, tmp_path, monkeypatch):
    from spotlake.streaming import ingest as module

    days = ("20260105", "20260106", "20260107")
    paths = [put(tmp_path, "tv", day, "[{") for day in days]
    run_stream(ingest, tmp_path)
    for path, day in zip(paths, days):
        path.write_text(json.dumps([spot(1, day)]))
    sizes = []
    real = Ingest.process
    monkeypatch.setattr(module, "FILES_PER_BATCH", 2)
    monkeypatch.setattr(Ingest, "process", lambda self, files, run: (sizes.append(files.count()), real(self, files, run)))
    ingest.replay_failed("tv")
    assert sizes == [2, 1] and store.read("spots").count() == 3


def test_derived_tables_follow_reloads_and_deletions(store, ingest, tmp_path):
    from spotlake.operators import rollup, stats, suggest

    def in_step():
        media = stats.all_media(store.read("spots"), store.read("print_ads"))
        direct = rollup.daily_rollup(media).select(*sorted(store.read("daily_rollup").columns))
        held = store.read("daily_rollup").select(*sorted(store.read("daily_rollup").columns))
        assert sorted(map(str, direct.collect())) == sorted(map(str, held.collect()))
        labels = suggest.label_values(store.read("spots"), store.read("print_ads")).select("medium", "column", "value")
        kept = store.read("label_values").select("medium", "column", "value").distinct()
        assert sorted(labels.collect()) == sorted(kept.collect())

    put(tmp_path, "tv", "20260105", [spot(1, Anunciante="a"), spot(2)])
    put(tmp_path, "impresos", "20260105", [ad(1, Sector="s")])
    put(tmp_path, "tv", "20260106", [spot(3, "20260106", Marca="other")])
    run_stream(ingest, tmp_path)
    in_step()
    put(tmp_path, "tv", "20260105", [spot(4, Marca="new")], "newer.json")
    run_stream(ingest, tmp_path)
    in_step()
    ingest.delete_days("tv", "20260106", "20260106")
    in_step()


def test_delete_days_leaves_an_event(spark, store, ingest, tmp_path):
    for day in ("20260105", "20260106", "20260107"):
        put(tmp_path, "tv", day, [spot(1, day)])
    put(tmp_path, "tv", "20260105", [spot(1)], "again.json")
    run_stream(ingest, tmp_path)
    assert ingest.delete_days("tv", "20260105", "20260106", raw_files=True) == 2
    assert table(store, "spots", "Fecha") == [(date(2026, 1, 7),)]
    assert states(store)["tv", "20260105_20260106"] == "PROCESSED"
    event = store.read("domain_events").where("event_type = 'DataDeleted'").first()
    assert json.loads(event["payload"])["raw_files_deleted"] == 3
    assert raw.read_range(spark, ingest.landing, "tv", "20260101", "20260131").count() == 1
    run_stream(ingest, tmp_path)  # the emptied folders are not arrivals
    assert store.read("spots").count() == 1


def test_read_range_opens_only_its_days(spark, tmp_path):
    landing = f"file://{tmp_path}"
    for day in ("20260105", "20260106", "20260107"):
        put(tmp_path, "tv", day, [spot(1, day), spot(2, day)])
    rows = raw.read_range(spark, landing, "tv", "20260105", "20260106")
    assert {r["path_day"] for r in rows.collect()} == {"20260105", "20260106"} and rows.count() == 4
    assert raw.read_range(spark, landing, "tv", "20260105", "20260107", limit=3).count() == 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [(regexp_extract(file_path" in plan  # decided from the listing, before any file is opened


def test_a_missing_feed_is_passed_over_and_reported(spark, tmp_path):
    put(tmp_path, "radio", "20260105", [spot(1)])
    landing = f"file://{tmp_path}/rawdata"
    both, missing = raw.union_available({
        name: lambda n=name: raw.read_files(spark, f"{landing}/{n}", raw_schema("radio")) for name in ("radio", "radio2")})
    assert both.count() == 1 and list(missing) == ["radio2"]
    assert raw.union_available({"x": lambda: spark.read.json(f"{landing}/none")})[0] is None


def test_union_feeds_fills_missing_columns(spark):
    one, two = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3,)], "a int")
    assert sorted(map(tuple, raw.union_feeds(one, two).collect())) == [(1, 2), (3, None)]


NOTICE = '{"Records":[{"eventName":"ObjectCreated:Put","s3":{"bucket":{"name":"b"},"object":{"key":"%s"}}}]}'


@pytest.mark.parametrize(
    ("body", "outcome"),
    [
        (json.dumps({"Type": "Notification", "Message": NOTICE % "rawdata/tv/20260101/data.json"}), "ok"),
        (NOTICE % "rawdata/tv/20260101/data.json", "ok"),
        ((NOTICE % "rawdata/tv/20260101/data.json").replace("Created:Put", "Removed:Delete"), "not_created"),
        ('{"Records":[]}', "unreadable"),
        (NOTICE % "rawdata/tv/20260101", "bad_path"),
        (NOTICE % "other/tv/20260101/data.json", "bad_path"),
        (NOTICE % "rawdata/tv/20260101/.keep", "placeholder"),
        (NOTICE % "rawdata/cine/20260101/data.json", "unknown_medium"),
        ((NOTICE % "rawdata/tv/20260101/data.json")[:-4], "unreadable"),
        ('{"Type":"Notification","Message":"{"}', "unreadable"),
        ("not json", "unreadable"),
        ('{"Records":[{"eventName":"ObjectCreated:Put"}]}', "no_key"),
        (None, "unreadable"),
    ],
)
def test_notices(spark, body, outcome):
    row = raw.parse_notices(spark.createDataFrame([(body,)], "body string")).first()
    assert row["outcome"] == outcome
    if outcome == "ok":
        assert (row["medium"], row["day"]) == ("tv", "20260101")
