"""Pages, exports, suggestions, filters, access, events and rollups on small frames."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spotlake.operators import access, events, filters, pages, rankings, rollup, stats, suggest

FIRST = date(2026, 1, 1)


def spots(spark, n=200, hot=0):
    """n rows over 5 days with repeated rows, plus ``hot`` copies of one row."""
    rows = [("tv" if i % 3 else "radio", FIRST + timedelta(days=i % 5), i % 7, i % 4, f"B{i % 6}" if i % 11 else "N.A.",
             f"A{i % 3}", "SUR" if i % 2 else None, float(i % 13)) for i in range(n)]
    rows += [("tv", FIRST, 1, 1, "HOT", "A0", "SUR", 1.0)] * hot
    return spark.createDataFrame(
        rows, "tipo string, Fecha date, IdDeteccion int, IdCanal int, Marca string, Anunciante string, "
              "Industria string, Tarifa double").withColumn("IdMarca", F.col("IdCanal")).withColumn(
        "IdAnunciante", F.col("IdCanal"))


def ads(spark):
    rows = [(i, FIRST + timedelta(days=i % 3), i % 4, f"B{i % 5}", "N.A." if i % 4 == 0 else f"A{i % 3}",
             None if i % 5 == 0 else "RADIO", "SUR", "CAT", float(i)) for i in range(60)]
    return spark.createDataFrame(
        rows, "id int, Fecha date, IdFuente int, Marca string, Anunciante string, Medio string, Sector string, "
              "Categoria string, Costo double")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_keyset_pages_cover_every_row_once(spark):
    df = spots(spark, hot=70).select("Fecha", "IdDeteccion", "Marca", "Tarifa")
    keys, cursor, seen, collected = ["Fecha", "IdDeteccion"], (date(1900, 1, 1), 0), 0, []
    while True:
        page = pages.keyset_page(df, keys, cursor, seen, 40).cache()
        got = rows_of(page)
        if not got:
            break
        collected += got
        last = pages.cursor_of(page, keys).first()
        same = (last["Fecha"], last["IdDeteccion"]) == tuple(cursor)
        seen = last["seen"] + (seen if same else 0)
        cursor = (last["Fecha"], last["IdDeteccion"])
        page.unpersist()
    assert Counter(collected) == Counter(rows_of(df))
    assert [r[:2] for r in collected] == sorted(r[:2] for r in collected)


def test_offset_pages_cover_every_row_once(spark):
    df = spots(spark, 90, hot=30).drop("tipo")
    shown, total = [], set()
    for number in range(1, 6):
        for row in pages.records_page(df, number, 25).collect():
            shown.append(tuple(row)[:-2])
            total.add((row["total"], row["total_pages"]))
    assert len(shown) == 120 and total == {(120, 5)}
    everything = pages.display(df.select([c for c in df.columns if not c.startswith("Id")]))
    assert Counter(shown) == Counter(rows_of(everything))
    assert pages.records_page(df, 9, 25).collect() == [] and pages.total_of(df).first()["total"] == 120
    with pytest.raises(ValueError, match="page"):
        pages.records_page(df, 0, 25)
    with pytest.raises(ValueError, match="page"):
        pages.records_page(df, 1, 500)


@pytest.mark.parametrize("page", [1, 2, 3, 5, 6, 9])
def test_pages_by_days_equal_pages_of_a_full_sort(spark, page):
    undated = spots(spark, 9).withColumn("Fecha", F.lit(None).cast("date"))
    df = spots(spark, 90, hot=30).unionByName(undated)
    days = pages.day_rows(df).unionByName(spark.createDataFrame([(date(2025, 1, 1), 0)], "day date, rows bigint"))
    assert rows_of(pages.records_page(df, page, 25, days)) == rows_of(pages.records_page(df, page, 25))
    order = [F.col("Fecha").desc_nulls_first()]
    assert rows_of(pages.page_by_days(df, days, order, page, 25, newest_first=True)) == rows_of(
        pages.page_of(df, order, page, 25))
    paper = ads(spark).withColumns({"Tiraje": F.col("id"), "Dimension": F.lit(None).cast("double"), "Fuente": F.lit("F")})
    assert rows_of(pages.print_page(paper, page, 11, pages.day_rows(paper))) == rows_of(pages.print_page(paper, page, 11))


def test_pages_by_days_of_nothing(spark):
    none = spots(spark).limit(0)
    assert pages.days_of_page(pages.day_rows(none), 1, 25) == []
    assert rows_of(pages.records_page(none, 1, 25, pages.day_rows(none))) == []


@pytest.mark.parametrize("column, values", [("Marca", ["B1", "B3", "B1", None, "none"]), ("IdCanal", ["1", "3", "x", ""])])
def test_long_list_is_joined_and_equals_the_condition(spark, column, values):
    df = spots(spark, hot=20).withColumn("Marca", F.when(F.col("IdCanal") != 2, F.col("Marca")))
    kept = [v for v in values if v not in ("x", "", None)]
    joined = filters.keep_values(df, column, values, longest=1)
    assert joined.columns == df.columns
    assert Counter(rows_of(joined)) == Counter(rows_of(df.where(F.col(column).cast("string").isin(kept))))
    many = filters.keep_values(df, "Marca", [f"B{n}" for n in range(100_000)])
    assert many.count() == df.where("Marca like 'B_'").count()
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and len(plan) < 20_000


@pytest.mark.parametrize("cap", [1, 10, 39, 40, 41, 120, 500])
def test_export_cap_equals_a_plain_sort(spark, cap):
    df = spots(spark, hot=100)
    got = pages.export_rows(df, ["Ins", "Fecha", "Nope", "Marca"], cap).collect()
    rows = sorted((r["Fecha"] for r in df.collect()))
    assert [r["Fecha"] for r in got] == rows[:cap]
    assert got[0].asDict().keys() == {"Ins", "Fecha", "Marca", "total_available", "truncated"}
    assert {(r["Ins"], r["total_available"], r["truncated"]) for r in got} == {(1, 300, cap < 300)}


def test_export_needs_a_known_column(spark):
    with pytest.raises(ValueError, match="none"):
        pages.export_rows(spots(spark), ["id", "Nope"])


def test_ranking_with_a_hot_group_equals_brute_force(spark):
    df = spots(spark, hot=400).where("tipo = 'tv'")
    totals: dict = {}
    for r in df.collect():
        if r["Marca"] not in ("N.A.", "", None):
            n, s = totals.get((r["Anunciante"], r["Marca"]), (0, 0.0))
            totals[r["Anunciante"], r["Marca"]] = (n + 1, s + r["Tarifa"])
    best = sorted(((a, b, n, s) for (a, b), (n, s) in totals.items()), key=lambda x: (-x[3], x[0], x[1]))
    assert rows_of(rankings.top_brands(df, "tv", 5)) == best[:5]


def test_print_outlets_keep_null_and_blank_apart(spark):
    df = spark.createDataFrame([("A",)] * 3 + [(None,)] * 2 + [("",)], "Medio string")
    assert rows_of(rankings.print_outlets(df)) == [("A", 3), ("N/A", 2), ("N/A", 1)]


def test_rollup_equals_the_rows(spark):
    media = stats.all_media(spots(spark, hot=50), ads(spark))
    day = rollup.daily_rollup(media)
    direct = media.groupBy("medium").agg(F.count("*").alias("n"), F.sum("spend").cast("double").alias("s")).collect()
    assert {(r["medium"], r["total_records"], r["total_spend"]) for r in rollup.totals(day).collect()} == {
        (r["medium"], r["n"], r["s"]) for r in direct}
    assert rows_of(rollup.top(day, "radio", {"anunciante": "advertiser", "marca": "brand"})) == rows_of(
        rankings.top_brands(spots(spark, hot=50).where("tipo = 'radio'"), "radio"))


def test_summary_lists_media_without_rows(spark):
    media = stats.all_media(spots(spark), ads(spark), media=["tv"])
    got = {r["medium"]: (r["total_records"], r["status"]) for r in stats.media_summary(media).collect()}
    assert got["tv"][1] == "disponible" and got["radio"] == got["impresos"] == (0, "sin_datos")


def test_approximate_statistics_are_an_option(spark):
    exact = stats.medium_stats(spots(spark), "tv").first()
    close = stats.medium_stats(spots(spark), "tv", approximate=True).first()
    assert exact["total_records"] == close["total_records"] and abs(exact["unique_dates"] - close["unique_dates"]) <= 1


def test_statistics_of_nothing_are_zero(spark):
    row = stats.range_status(spots(spark), "tv", "20300101", "20300102").first()
    assert (row["total_records"], row["total_tarifa"], row["data_exists"], row["total_dates_in_range"]) == (0, 0.0, False, 2)
    assert stats.print_summary(ads(spark).limit(0)).first()["avg_costo"] == 0.0


def test_calendar_refuses_a_reversed_range(spark):
    assert stats.calendar(spots(spark), "20260130", "20260202").count() == 4
    with pytest.raises(ValueError, match="first day"):
        stats.calendar(spots(spark), "20260202", "20260130")


def test_filters(spark):
    df = spots(spark).where("tipo = 'tv'")
    assert filters.filter_medium(df, "tv", {"categoria": "CAT"}).isEmpty()
    assert filters.filter_medium(df, "tv", {"categoria": " , ", "fuente": "x"}).count() == df.count()
    assert filters.filter_medium(ads(spark), "impresos", {"localidad": "x", "industria": "y"}).count() == 60
    assert filters.filter_medium(ads(spark), "impresos", {"sector_industria": "SUR", "marca": "B1, B2"}).count() == 24
    many = [f"B{i}" for i in range(2000)]
    assert filters.keep_values(df, "Marca", many).count() == filters.keep_values(df, "Marca", [f"B{i}" for i in range(6)]).count()


def test_search_wildcards(spark):
    df = spark.createDataFrame([("100% Azul",), ("100x Azul",), ("rojo",)], "Version string")
    assert df.where(filters.contains_text("Version", "100%a")).count() == 2
    assert df.where(filters.contains_text("Version", "100% a", literal=True)).count() == 1


def test_suggestions(spark):
    tv, paper = spots(spark, hot=300), ads(spark)
    values = lambda *a, **k: [r[0] for r in suggest.suggest(tv, paper, *a, **k).collect()]
    assert values("Marca") == ["B0", "B1", "B2", "B3", "B4", "B5", "HOT"]
    assert values("Marca", limit=2) == ["B0", "B1"]
    assert values("Marca", "hot") == ["HOT"]
    # print lacks the locality, and a filter on the suggested column rules a source out
    assert values("Categoria", filters={"localidad": "x"}) == []
    assert values("Marca", filters={"marca": "B1"}) == []
    assert values("Industria", "s", {"marca": "none"}) == []  # filters apply to short searches too
    assert values("Industria", "s") == ["SUR"]
    assert values("Industria", "sur", {"marca": "none"}) == []
    assert values("Unknown") == []
    table = suggest.label_values(tv, paper)
    for field, text in (("Marca", ""), ("Marca", "b"), ("SectorIndustria", ""), ("Categoria", "")):
        assert values(field, text) == [r[0] for r in suggest.suggest_from_values(table, field, text).collect()]


def test_access(spark):
    accounts = spark.createDataFrame([(1, 10), (1, 11), (1, 10), (2, 12), (3, 99)], "id_account int, id_sector_src int")
    sectors = spark.createDataFrame([(10, "Radio"), (11, "Televisión abierta"), (12, "Cine")], "id int, name string")
    got = dict(rows_of(access.account_media(accounts, sectors)))
    assert got == {1: ["radio", "tv"], 2: ["tv", "radio", "impresos"], 3: ["tv", "radio", "impresos"]}
    df = spots(spark)
    assert access.restrict(df, "tipo", ["radio"]).select("tipo").distinct().count() == 1
    assert access.restrict(df, "tipo", []).count() == access.restrict(df, "tipo", ["tv"], admin=True).count() == 200
    access.check_access("tv", None)
    with pytest.raises(PermissionError):
        access.check_access("tv", ["radio"])


AT = datetime(2026, 1, 1)


def event_rows(spark, rows):
    return spark.createDataFrame(
        [(i, "DataIngested", m, d, p, AT + timedelta(minutes=n), s) for n, (i, m, d, p, s) in enumerate(rows)],
        "event_id string, event_type string, aggregate_type string, aggregate_id string, payload string, "
        "occurred_at timestamp, status string")


def test_publishing_refreshes_a_pending_event_and_opens_a_new_attempt_otherwise(spark):
    current = event_rows(spark, [("a", "tv", "1", "{}", "PENDING"), ("b", "tv", "2", "{}", "PROCESSED")])
    wanted = event_rows(spark, [("x", "tv", str(d), '{"n": %d}' % d, "PENDING") for d in (1, 2, 3)])
    got = {r["aggregate_id"]: r for r in events.published(wanted, current, F.lit(AT)).collect()}
    assert got["1"]["event_id"] == "a" and got["1"]["refreshed"] and got["1"]["payload"] == '{"n": 1}'
    assert not got["2"]["refreshed"] and got["2"]["event_id"] not in ("b", got["3"]["event_id"])
    again = {r["aggregate_id"]: r["event_id"] for r in events.published(wanted, current, F.lit(AT)).collect()}
    assert again == {k: r["event_id"] for k, r in got.items()}
    assert sorted(r["aggregate_id"] for r in events.to_publish(wanted, current).collect()) == ["2", "3"]


def test_latest_state_wins_whatever_the_order_of_rows(spark):
    log = [("e", "PENDING", AT, None), ("e", "FAILED", AT + timedelta(1), "w"), ("e", "PENDING", AT + timedelta(2), "r"),
           ("f", "PROCESSED", AT, "w"), ("f", "PENDING", AT, None)]
    for rows in (log, log[::-1]):
        df = spark.createDataFrame(rows, "event_id string, status string, at timestamp, consumer_id string")
        got = {r["event_id"]: (r["status"], r["consumer_id"]) for r in events.current_state(df).collect()}
        assert got == {"e": ("PENDING", None), "f": ("PROCESSED", "w")}


def test_run_status_rules(spark):
    days = spark.createDataFrame(
        [("tv", 5, 5, False), ("tv", 5, 0, True), ("radio", 4, 4, False), ("impresos", 3, 0, True)],
        "medium string, extracted int, loaded int, failed boolean")
    got = {r["medium"]: (r["status_any"], r["status_all"]) for r in events.run_summary(days).collect()}
    assert got == {"tv": ("success", "partial"), "radio": ("success", "success"), "impresos": ("error", "error")}


def test_event_detail_and_audit_rows(spark):
    log = event_rows(spark, [("a", "tv", "1", "{}", "PENDING"), ("b", "tv", "2", "{}", "FAILED")])
    assert events.event_detail(log, "b").first()["status"] == "FAILED" and events.event_detail(log, "z").isEmpty()
    reads = spark.createDataFrame([("ana", "SELECT", "x", "spots"), ("eva", "EXPORT", "y", "spots")],
                                  "user string, instruction string, sql_command string, source string")
    users = spark.createDataFrame([("ana", 7)], "user string, id int")
    got = {r["instruction"]: r["id_user"] for r in events.audit_rows(reads, users, F.current_timestamp()).collect()}
    assert got == {"SELECT": 7, "EXPORT": 0}
