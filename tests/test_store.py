"""Partitioned tables: replacing, deleting, repairing and refreshing."""

from __future__ import annotations

from collections import Counter
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spotlake.operators import distinct, pages, rollup, stats, suggest
from spotlake.plans import registry
from spotlake.session import scratch_dir
from spotlake.sources import catalogues, derived, sinks
from spotlake.sources.store import replaced_days, without_days

DAYS = [date(2026, 1, d) for d in (1, 2, 3)]


def spots(spark, rows):
    return spark.createDataFrame(rows, "tipo string, Fecha date, IdDeteccion bigint, Marca string, Tarifa double")


def seed(spark):
    return spots(spark, [(m, d, i, "A", 1.0) for m in ("tv", "radio") for d in DAYS for i in range(4)])


def content(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or ("tipo", "Fecha", "IdDeteccion", "Tarifa"))).collect())


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_replace_touches_only_its_days_and_repeats(spark, store):
    store.replace_days("spots", seed(spark))
    before = content(store.read("spots"))
    batch = spots(spark, [("tv", DAYS[1], 99, "B", 5.0)])
    expected = replaced_days(store.read("spots").where("tipo = 'tv'"), store._aligned("spots", batch), [DAYS[1]])
    expected = content(expected) + content(store.read("spots").where("tipo = 'radio'"))
    for _ in range(2):
        store.replace_days("spots", batch)
        assert content(store.read("spots")) == expected
    assert sum(expected.values()) == sum(before.values()) - 3


def test_replace_with_nothing_empties_the_day(spark, store):
    store.replace_days("spots", seed(spark))
    store.replace_days("spots", seed(spark).limit(0), emptied=[("tv", DAYS[0])])
    left = store.read("spots").groupBy("tipo", "Fecha").count().collect()
    assert len(left) == 5 and ("tv", DAYS[0]) not in {(r["tipo"], r["Fecha"]) for r in left}


def test_hot_day_is_split_over_files(spark, store):
    hot = spark.range(300_000).select(
        F.lit("tv").alias("tipo"), F.lit(DAYS[0]).alias("Fecha"), F.col("id").alias("IdDeteccion"),
        F.sha2(F.col("id").cast("string"), 512).alias("Version"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        store.replace_days("spots", hot)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = store.read("spots").select(F.input_file_name()).distinct().count()
    assert files > 1 and store.read("spots").count() == 300_000


def test_delete_range_is_inclusive(spark, store):
    store.replace_days("spots", seed(spark))
    after = content(without_days(store.read("spots").where("tipo = 'tv'"), DAYS[0], DAYS[1]))
    assert store.delete_days("spots", DAYS[0], DAYS[1], "tv") == 8
    assert content(store.read("spots").where("tipo = 'tv'")) == after
    assert store.read("spots").where("tipo = 'radio'").count() == 12
    assert store.delete_days("spots", "20300101", "20301231") == 0
    assert store.delete_all("spots") == 16 and store.read("spots").isEmpty()


def test_repair_rewrites_dirty_days_only(spark, store):
    def files(where):
        return {r[0] for r in store.read("spots").where(where).select(F.input_file_name()).distinct().collect()}

    store.replace_days("spots", seed(spark))
    assert store.repair("spots") > 0 and store.repair("spots") == 0
    store.replace_days("spots", spots(spark, [("tv", DAYS[0], None, "nan", None), ("tv", DAYS[0], 1, "x", 2.0)]))
    others = "not (tipo = 'tv' and Fecha = '2026-01-01')"
    untouched, dirty = files(others), files("tipo = 'tv' and Fecha = '2026-01-01'")
    assert store.repair("spots") > 0
    assert files(others) == untouched and not files("tipo = 'tv' and Fecha = '2026-01-01'") & dirty
    row = store.read("spots").where("tipo = 'tv' and Fecha = '2026-01-01' and IdDeteccion = 0").first()
    assert (row["Marca"], row["Tarifa"], row["Plaza"], row["IdCanal"]) == ("N.A.", 0.0, "N.A.", 0)
    assert store.read("spots").count() == 22


def test_refresh_swaps_the_catalogue(spark, store):
    for snapshot, rows in (("v1", 3), ("v2", 5)):
        raw = spark.range(rows).select(F.col("id").cast("string").alias("IdMaster"), F.lit("Año").alias("Marca"))
        catalogues.load_library(store, raw, snapshot)
        assert store.read("media_library").count() == rows
    assert store.read("media_library").first()["Marca"] == "ANO"


def test_totals_are_replaced_by_day(spark, store):
    raw = spark.createDataFrame([("1", "9.5"), ("2", ""), (None, "1")], "IdMaster string, TotalInversion string")
    for _ in range(2):
        catalogues.load_totals(store, raw, "20260105")
    catalogues.load_totals(store, raw.limit(1), "20260106")
    assert store.read("media_totals").count() == 3
    catalogues.load_totals(store, raw.limit(0), "20260106")
    assert store.read("media_totals").count() == 2


def test_partitions_prune_the_scan(spark, store):
    store.replace_days("spots", seed(spark))
    plan = store.read("spots").where((F.col("tipo") == "tv") & (F.col("Fecha") == F.lit(DAYS[0]))).groupBy("Marca").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tipo" in text and "ReadSchema: struct<Marca:string>" in text


def test_rollup_and_values_tables_follow_the_days(spark, store):
    store.replace_days("spots", seed(spark))
    derived.refresh_rollup(store)
    keys = {"marca": "brand"}
    assert rows(rollup.top(store.read("daily_rollup"), "tv", keys)) == [("A", 12, 12.0)]
    store.replace_days("spots", spots(spark, [("tv", DAYS[0], 1, "B", 50.0)]))
    store.delete_days("spots", DAYS[2])
    derived.refresh_rollup(store, [DAYS[0], DAYS[2]])
    assert rows(rollup.top(store.read("daily_rollup"), "tv", keys)) == [("B", 1, 50.0), ("A", 4, 4.0)]
    derived.refresh_label_values(store)
    assert rows(suggest.suggest_from_values(store.read("label_values"), "Marca", "a")) == [("A",)]


def test_jdbc_target_options():
    target = sinks.JdbcTarget("jdbc:x", "public.spots", "driver.X", {"user": "u"})
    options = target.options()
    assert options["batchsize"] == "1000" and options["dbtable"] == "public.spots" and options["user"] == "u"
    assert int(options["numPartitions"]) <= 16


def test_reads_check_access_and_leave_an_audit_row(spark, store):
    from spotlake.sources.reads import Reader

    store.replace_days("spots", seed(spark))
    users = spark.createDataFrame([("ana", 7)], "user string, id bigint")
    ana = Reader(store, "ana", users, media=["tv"])
    assert ana.detections("tv", DAYS[0], DAYS[1], {"marca": "A,B"}).count() == 8
    with pytest.raises(PermissionError):
        ana.detections("radio", DAYS[0], DAYS[1])
    Reader(store, "nobody", users, admin=True).detections("radio", DAYS[0], DAYS[0], instruction="EXPORT", columns=["Fecha"])
    logged = sorted(tuple(r) for r in store.read("audit_log").select("id_user", "instruction", "sql_command", "source").collect())
    assert logged == [
        (0, "EXPORT", "EXPORT Fecha FROM spots WHERE Fecha BETWEEN '2026-01-01' AND '2026-01-01'", "records"),
        (7, "SELECT", "SELECT * FROM spots WHERE Fecha BETWEEN '2026-01-01' AND '2026-01-02' AND Marca IN ('A', 'B')", "records")]


def test_mirror_never_raises(spark, tmp_path):
    df = spark.range(3)
    assert sinks.mirror(df, [], None).status == "skipped"
    assert sinks.mirror(df, [], lambda d, days: d.write.parquet(str(tmp_path / "copy"))).status == "success"

    def broken(_, days):
        raise OSError("target is down")

    assert sinks.mirror(df, [], broken) == sinks.MirrorResult("error", "target is down")


def distinct_seed(spark, extra=()):
    """Spots whose brands, channels and advertisers recur on several days; some keys are null."""
    made = [(m, d, i, i % 3, None if i % 5 == 0 else i * (1 + d.day) % 7, i % 4, float(i))
            for m in ("tv", "radio") for d in DAYS for i in range(20)]
    return spark.createDataFrame([*made, *extra], "tipo string, Fecha date, IdDeteccion bigint, IdCanal int, IdMarca int,"
                                                  " IdAnunciante int, Tarifa double")


def test_distinct_sets_follow_the_days_and_equal_the_rows(spark, store):
    def check(within=None):
        media = stats.all_media(store.read("spots"), store.read("print_ads"))
        direct = stats.media_summary(media if within is None else media.where(within))
        held = distinct.media_summary(store.read("daily_rollup"), store.read("distinct_sets"), within)
        assert held.schema.names == direct.schema.names and sorted(rows(held)) == sorted(rows(direct))

    first = F.col("day").between(F.lit(DAYS[0]), F.lit(DAYS[1]))
    store.replace_days("spots", distinct_seed(spark))
    derived.refresh(store, DAYS)
    check(), check(first), check(F.lit(False))
    before = content(store.read("distinct_ids"), "kind", "value", "id")
    derived.refresh_distinct_sets(store, DAYS)  # a repeated load changes nothing
    assert content(store.read("distinct_ids"), "kind", "value", "id") == before
    check()
    batch = distinct_seed(spark, [("tv", DAYS[1], 99, 77, 78, 79, 1.0)]).where(F.col("Fecha") == F.lit(DAYS[1]))
    store.replace_days("spots", batch)
    store.delete_days("spots", DAYS[2])
    derived.refresh(store, DAYS[1:])
    check(), check(first)
    ids = rows(store.read("distinct_ids").select("kind", "value", "id"))
    for kind in distinct.KINDS:
        own = sorted(i for k, _, i in ids if k == kind)
        assert own == list(range(1, len(own) + 1)), "ids have no gaps and are not given twice"


def test_distinct_sets_of_many_values_use_several_bitmaps(spark):
    media = spark.range(100_000).select(
        F.lit("tv").alias("medium"), F.lit(DAYS[0]).alias("day"), (F.col("id") % 70_000).cast("string").alias("outlet"),
        F.lit(None).cast("string").alias("brand_key"), F.lit("x").alias("advertiser_key"))
    values = distinct.day_values(media)
    sets = distinct.distinct_sets(values, distinct.new_ids(values, distinct.no_ids(values)))
    assert sets.where("kind = 'outlet'").count() == 3
    assert rows(distinct.distinct_counts(sets)) == [(70_000, 0, 1)]
    assert rows(distinct.distinct_counts(sets.where("false"))) == [(0, 0, 0)]
    plan = distinct.distinct_counts(sets, "medium")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_ids_meet_before_a_bitmap_is_made(spark):
    values = spark.createDataFrame([("tv", DAYS[i % 3], "outlet", str(i)) for i in range(1000)], "medium string, day date, kind string, value string")
    sets = distinct.distinct_sets(values, distinct.new_ids(values, distinct.no_ids(values)))
    plan = sets._jdf.queryExecution().executedPlan().toString().splitlines()
    made = [i for i, line in enumerate(plan) if "bitmap_construct_agg" in line]
    assert made and not any("Exchange" in line for line in plan[:made[-1]]), "no bitmap is shuffled"
    assert rows(distinct.distinct_counts(sets)) == [(1000, 0, 0)]


@pytest.mark.parametrize("parts", [1, 4])
def test_summary_from_sets_in_parts_equals_the_rows_and_frees_what_it_read(spark, tmp_path, monkeypatch, parts):
    days = [None, *DAYS, *[DAYS[0] - timedelta(days=n) for n in range(1, 9)]]
    made = [(m, d, None if i % 5 == 0 else str(i % 3), str(i * (n + 1) % 7), None if i == 3 else str(i % 4), f"a{i % 4}", f"b{i % 7}",
             None if i % 9 == 0 else "x", None if i % 8 == 0 else Decimal(i * n))
            for m in ("tv", "impresos") for n, d in enumerate(days) for i in range(20)]
    spark.createDataFrame(made + made[:50], "medium string, day date, outlet string, brand_key string, advertiser_key string, "
                          "advertiser string, brand string, sector string, spend decimal(38,2)").write.parquet(str(tmp_path / "media"))
    media = spark.read.parquet(str(tmp_path / "media"))
    monkeypatch.setattr(registry, "PARTS", parts)
    monkeypatch.setattr(registry, "PART_BYTES", 1)
    home = Path(scratch_dir(spark))
    before = {p.name for p in home.iterdir()} if home.exists() else set()
    for within in (None, F.col("day") >= F.lit(DAYS[0])):
        direct = stats.media_summary(media if within is None else media.where(within))
        held = registry._summary_from_sets(media, within)
        assert held.schema.names == direct.schema.names and sorted(rows(held)) == sorted(rows(direct))
    left = Counter(p.name.rpartition("-")[0] for p in home.iterdir() if p.name not in before)
    assert left == {"rollup": 2 * parts, "sets": 2 * parts, "ids": 2 * parts}


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_export_files(spark, tmp_path, kind):
    sinks.write_export(spark.range(3), str(tmp_path / "out"), kind)
    read = spark.read.option("header", True).csv if kind == "csv" else spark.read.parquet
    assert read(str(tmp_path / "out")).count() == 3


def test_deep_page_reads_one_partition(spark, store):
    store.replace_days("spots", spots(spark, [("tv", d, i, f"M{i % 9}", float(i)) for d in DAYS for i in range(100)]))
    derived.refresh_rollup(store)
    tv = store.read("spots").where("tipo = 'tv'")
    days = rollup.day_rows(store.read("daily_rollup"), "tv")
    page = pages.records_page(tv, 26, 10, days)
    assert rows(page) == rows(pages.records_page(tv, 26, 10)) and page.first()["total"] == 300
    read = pages.page_by_days(tv, days, pages.ascending("Fecha"), 26, 10)
    read.collect()
    assert len(read.inputFiles()) and {r[0] for r in read.select("Fecha").distinct().collect()} == {DAYS[2]}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2026-01-03" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    store.delete_days("spots", DAYS[0], medium="tv")
    derived.refresh(store, [DAYS[0]])
    days = rollup.day_rows(store.read("daily_rollup"), "tv")
    assert rows(pages.records_page(tv, 16, 10, days)) == rows(pages.records_page(tv, 16, 10))
