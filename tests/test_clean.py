"""Cleaning pipelines on rows in the shape of the feeds."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from spotlake.operators import clean, quality
from spotlake.schemas import SPECS, display_columns, raw_schema
from spotlake.sources import catalogues

SPOT = {"Fecha": "20260105", "IdDeteccion": "1", "Marca": "Café", "Tarifa": "12.5", "IdCanal": "7"}


def frame(spark, feed, rows):
    schema = raw_schema(feed)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def test_live_row_has_no_nulls(spark):
    df = frame(spark, "tv", [SPOT])
    row = clean.accepted(clean.clean_live("tv", df)).first().asDict()
    assert row["Fecha"] == date(2026, 1, 5) and row["Marca"] == "CAFE" and row["Tarifa"] == 12.5
    assert row["IdCanal"] == 7 and row["IdMarca"] == 0 and row["HInicio"] == "N.A." and row["Subtitulo"] == "N.A."
    untouched = {"Version", "Testigo"}
    assert {k for k, v in row.items() if v is None} == untouched


def test_live_types_and_order_follow_the_table(spark):
    cleaned = clean.accepted(clean.clean_live("tv", frame(spark, "tv", [SPOT])))
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(c.name, c.type) for c in SPECS["tv"]]


def test_live_numbers(spark):
    rows = [{**SPOT, "IdCanal": v, "NoCorte": "", "Tarifa": t} for v, t in (("abc", "x"), ("12.7", "NaN"))]
    got = clean.clean_live("tv", frame(spark, "tv", rows)).select("IdCanal", "NoCorte", "Tarifa").collect()
    assert [tuple(r) for r in got] == [(0, 0, 0.0), (12, 0, 0.0)]


def test_missing_subtitle_and_extra_column(spark):
    df = spark.createDataFrame([("20260105", "1", "x")], "Fecha string, IdDeteccion string, Foo string")
    assert clean.missing_columns("tv", df)[0] == "IdPlaza"
    cleaned = clean.clean_live("tv", df)
    assert cleaned.columns == ["Fecha", "IdDeteccion", "Subtitulo", clean.REASON]
    assert cleaned.first()["Subtitulo"] == "N.A."
    assert clean.project_known("tv", df).columns == ["Fecha", "IdDeteccion"]


@pytest.mark.parametrize("variant", [clean.clean_live, clean.clean_batch])
def test_accepted_and_rejected_add_up(spark, variant):
    rows = [SPOT, {**SPOT, "Fecha": "sin fecha"}, {**SPOT, "IdDeteccion": None}, {**SPOT, "Fecha": None}]
    cleaned = variant("tv", frame(spark, "tv", rows))
    counts = {r["outcome"]: r["rows"] for r in clean.reject_counts(cleaned).collect()}
    assert counts == {"accepted": 1, "bad_date": 2, "missing_key": 1}
    assert clean.accepted(cleaned).count() + clean.rejected(cleaned).count() == len(rows)


def test_unreadable_key_is_zero_live_and_absent_in_batch(spark):
    df = frame(spark, "tv", [{**SPOT, "IdDeteccion": "abc"}])
    assert clean.accepted(clean.clean_live("tv", df)).first()["IdDeteccion"] == 0
    assert clean.rejected(clean.clean_batch("tv", df)).first()[clean.REASON] == "missing_key"


def test_batch_zero_defaults_differ_by_feed(spark):
    row = {**SPOT, "DReal": "x", "IdMarca": "x", "Tarifa": "x"}
    tv = clean.clean_batch("tv", frame(spark, "tv", [row])).first()
    radio = clean.clean_batch("radio", frame(spark, "radio", [row])).first()
    assert (tv["DReal"], tv["IdMarca"], tv["Tarifa"]) == (None, None, None)
    assert (radio["DReal"], radio["IdMarca"], radio["Tarifa"]) == (0, None, 0.0)


def test_print_widths_and_long_text(spark):
    row = {"Fecha": "20260105", "IdMedio": "3", "Marca": "é" * 200, "Costo": "x", "TextoNota": "ñ" * 200}
    df = frame(spark, "impresos", [row])
    live, batch = clean.clean_live("impresos", df).first(), clean.clean_batch("impresos", df).first()
    assert live["Marca"] == batch["Marca"] == "E" * 128 and live["Costo"] == 0.0
    assert live["TextoNota"] == "N" * 128 and batch["TextoNota"] == "ñ" * 200


def test_one_bad_number_costs_one_cell_only(spark):
    rows = [{"IdMaster": "1", "NoCorte": "12.7", "DTeorica": "", "TotalInversion": ""},
            {"IdMaster": "2", "NoCorte": "3", "DTeorica": "4", "TotalInversion": "5.5", "TotalHit": "x"},
            {"IdMaster": None}]
    df = frame(spark, "totals", rows).drop("FechaInicio", "FechaFin", "Testigo")
    cleaned = catalogues.clean_totals(df, "20260105", "20260106")
    got = clean.accepted(cleaned).orderBy("IdMaster").collect()
    assert [(r["NoCorte"], r["DTeorica"], r["TotalInversion"], r["TotalHit"]) for r in got] == [
        (None, None, None, 0), (3, 4, 5.5, 0)]
    assert got[0]["FechaInicio"] == date(2026, 1, 5) and got[0]["FechaFin"] == date(2026, 1, 6)
    assert got[0]["Testigo"] == "N.A." and clean.rejected(cleaned).count() == 1


def test_dates_only_variant(spark):
    df = spark.createDataFrame([("2026-01-05T01:00:00",), ("2026",), ("texto largo",)], "Fecha string")
    assert [r[0] for r in clean.dates_only_filter(df).collect()] == ["2026-01-05", "texto largo"]


def test_all_label_columns_share_one_python_exchange(spark):
    plan = clean.clean_live("tv", frame(spark, "tv", [SPOT]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_repair(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), (None, None, None), (" ", 2, 0.5), ("N/A", 3, 1.0), ("N.A.", 4, 1.0)],
        "t string, i int, d double")
    fixed = quality.repair(df)
    assert [tuple(r) for r in fixed.collect()] == [
        ("a", 1, 1.0), ("N.A.", 0, 0.0), ("N.A.", 2, 0.5), ("N.A.", 3, 1.0), ("N.A.", 4, 1.0)]
    assert {r[0]: r[1] for r in quality.repair_counts(df).collect()} == {"t": 3, "i": 1, "d": 1}
    assert {r[0]: r[1] for r in quality.repair_counts(df, null_words=False).collect()} == {"t": 2, "i": 1, "d": 1}
    assert df.agg(F.sum(quality.changed_cells(df))).first()[0] == 5
    assert fixed.agg(F.sum(quality.changed_cells(fixed))).first()[0] == 0


def test_quality_report_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (1, None)], "IdMarca int, Marca string")
    got = {r["column_name"]: (r["data_type"], r["null_count"], r["unique_count"]) for r in quality.quality_report(df).collect()}
    assert got == {"IdMarca": ("int", 1, 2), "Marca": ("string", 1, None)}


def test_display_columns():
    assert display_columns(["id", "IdMarca", "Marca", "Fecha"]) == ["Marca", "Fecha"]
