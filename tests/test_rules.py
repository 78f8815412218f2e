"""Column rules, case by case and against plain Python."""

from __future__ import annotations

import re
import unicodedata
from datetime import date, datetime

import pytest
from shared import column
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from spotlake.functions import dates, numbers, params, text


def python_fold(value: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", value) if unicodedata.category(c) != "Mn")
    return re.sub(r"[^\x20-\x7E\n]", "", plain.upper())


FOLDED = ["Café Ñandú™", "straße", "½ kg", "ﬁn", "©®", "tab\there", "line\nbreak", "", "ŉ ĳ Ⅷ", "日本", "𝐀b", "á", "plain"]


def test_fold_cases(spark):
    assert column(spark, [*FOLDED, None], text.fold) == [*map(python_fold, FOLDED), None]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_fold_helper_equals_rule(value):
    assert text.fold_string(value) == python_fold(value)


def test_fold_every_short_code_point(spark):
    values = ["x" + chr(c) + "y" for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000]
    assert column(spark, values, text.fold) == [python_fold(v) for v in values]


@pytest.mark.parametrize(
    ("value", "live", "batch", "guarded"),
    [
        ("  Café Ñandú™ ", "CAFE NANDUTM", "CAFE NANDUTM", "  CAFE NANDUTM "),
        (None, "N.A.", "N.A.", None),
        ("", "N.A.", "N.A.", ""),
        ("   ", "N.A.", "N.A.", "   "),
        ("nan", "NAN", "N.A.", "nan"),
        ("None", "NONE", "N.A.", "None"),
        ("N.A.", "N.A.", "N.A.", "N.A."),
        (" " * 10 + "x" * 250, "X" * 245, "X" * 250, " " * 10 + "X" * 250),
        ("©®", "N.A.", "N.A.", ""),
        ("x" * 300, "X" * 255, "X" * 255, "X" * 300),
        ("\tTab ", "TAB ", "TAB", "TAB "),
    ],
)
def test_labels(spark, value, live, batch, guarded):
    assert column(spark, [value], lambda c: text.label(c, 255)) == [live]
    assert column(spark, [value], lambda c: text.batch_label(c, 255)) == [batch]
    assert column(spark, [value], text.fold_unless_marker) == [guarded]


def test_long_and_clock_text(spark):
    whole = "ñ" * 5000
    assert column(spark, [f" {whole}\n", "nan", "", None, "NaN"], text.long_text) == [
        whole, "N.A.", "N.A.", "N.A.", "NaN"]
    assert column(spark, ["NaN"], lambda c: text.long_text(c, "NaN")) == ["N.A."]
    assert column(spark, [" 08:30 ", "9" * 60, None], text.clock_text) == ["08:30", "9" * 50, None]
    assert column(spark, [" a ", "  ", None], text.optional_text) == ["a", "N.A.", "N.A."]


D = date(2026, 1, 5)


def test_feed_date(spark):
    values = ["20260105", "2026-01-05T00:00:00", "2026-01-05T00:00:00.123", "sin fecha", "", None, "2026-01-05", "20261305"]
    assert column(spark, values, dates.feed_date) == [D, D, D, None, None, None, None, None]
    clocks = ["2026-01-05T23:59", "2026-01-05T08:30:00Z", "2026-01-05T08:30:00-06:00", "2026-01-05Tgarbage",
              "2026-01-05T24:00:00", "2026-01-05T08:61:00", "2026-01-05T", "2026-01-05T08:30:00 x"]
    assert column(spark, clocks, dates.feed_date) == [D, D, D, None, None, None, None, None]


def python_any_date(value: str) -> date | None:
    value = value.strip()
    if value[:8].isdigit() and len(value) >= 8:
        value = value[:8]
    for form in ("%Y%m%d", "%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d", "%d/%m/%Y", "%d-%m-%Y"):
        try:
            return datetime.strptime(value, form).date()
        except ValueError:
            pass
    runs = [int(r) for r in re.findall(r"\d+", value)[:3]]
    if len(runs) == 3 and 1900 <= runs[0] <= 2100:
        try:
            return date(*runs)
        except ValueError:
            pass
    return None


ANY = [
    "20260105", "2026-01-05", "2026-01-05T08:30:00", "2026/01/05", "05/01/2026", "05-01-2026", "2026.1.5", "2026-1-5",
    "20260105T083000", "2026115", "202615", "2026131", "2026-02-31", "31/02/2026", "sin fecha", "", "nan", "1800-01-05",
    "1800.01.05", "2026-01-05T00:00:00.123", "2026-01-05T99:00:00", "  2026-01-05 ", "26-1-5", "2026-13-01", "día 2026, mes 1, 5",
    "02026.01.005x", "2101.1.1", "2100.1.1", "1/2/2026 extra", "12345678", "2026-1", "5/1/26", "1800-01-05T10:00:00", "2026 01 5 7",
]


def test_any_date_cases(spark):
    assert column(spark, [*ANY, None], dates.any_date) == [*map(python_any_date, ANY), None]


def test_any_date_many(spark):
    import random

    rng = random.Random(7)
    pick = lambda n: "".join(rng.choice("0123456789/-. T:x") for _ in range(n))
    shaped = lambda: rng.choice(["{}/{}/{}", "{}-{}-{}", "{}.{}.{}", "{2}/{1}/{0}", "{2}-{1}-{0}", "{}{:02}{:02}"]).format(
        rng.randint(1850, 2150), rng.randint(0, 14), rng.randint(0, 33))
    values = [pick(rng.randint(3, 14)) for _ in range(3000)] + [shaped() for _ in range(3000)]
    got = column(spark, values, dates.any_date)
    assert [(v, g) for v, g in zip(values, got) if g != python_any_date(v)] == []


def test_other_dates(spark):
    values = ["20260105", "2026-01-05T00:00:00", "2026-01-05", "2026", None]
    assert column(spark, values, dates.short_date) == ["20260105", "2026-01-05", "2026-01-05", None, None]
    assert column(spark, ["2026-01-05", "2026x01x05 rest", "20260105", "2026-02-31", None], dates.sliced_date) == [
        D, D, None, None, None]
    assert column(spark, ["20260105", "20260231", "2026-01-05", "202601050", None], dates.is_day_key) == [
        True, False, False, False, False]


def test_numbers(spark):
    values = ["7", "12.7", " 8 ", "abc", "", None, "-3", "99999999999", "1e3", "12."]
    assert column(spark, values, numbers.whole) == [7, 12, 8, None, None, None, -3, None, None, 12]
    assert column(spark, values, lambda c: numbers.whole(c, "bigint"))[7] == 99999999999
    assert column(spark, values, numbers.exact_whole) == [7, None, 8, None, None, None, -3, None, 1000, 12]
    assert column(spark, ["12.5", "abc", "NaN", "Infinity", "", None, "1e3"], numbers.real) == [
        12.5, None, None, None, None, None, 1000.0]
    assert column(spark, ["abc", "2"], lambda c: numbers.or_zero(numbers.whole(c), "int")) == [0, 2]


def test_money_sum_does_not_depend_on_order(spark):
    cents = [0.1, 0.2, 0.3, 1e9, -1e9] * 200
    sums = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(c,) for c in cents], "v double").repartition(parts)
        sums.add(df.agg(numbers.money_sum(F.col("v"))).first()[0])
    assert sums == {120.0}


def test_large_amounts_stay_in_the_total(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(numbers.money_sum(F.col("v"))).first()[0]

    assert total(1e17, 2.0) == 1e17 + 2 and total(1e15, -1e15, 0.5) == 0.5 and total(3e30, 1.0) == 3e30
    assert total(float("nan"), float("inf"), None, 1.5) == 1.5 and total() == 0.0
    with pytest.raises(Exception, match="amount out of range"):
        total(1e40, 1.0)


def test_parameters(spark):
    assert params.parse_list(" a, b ,,c ") == ["a", "b", "c"] and params.parse_list(None) == []
    assert column(spark, [" a, b ,,c ", "", None], params.split_list) == [["a", "b", "c"], [], None]
    assert params.as_day("20260105") == params.as_day("2026-01-05") == D


def test_audit_text(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"], ["x"], [], 12)], "m array<string>, t array<string>, e array<string>, n int")
    line = params.audit_text(
        F.lit("EXPORT"), F.lit("spots"), F.lit(D), F.lit(D),
        {"Marca": F.col("m"), "Medio": F.col("t"), "Sector": F.col("e")}, F.col("n"), F.lit("Fecha,Marca"),
    )
    assert df.select(line).first()[0] == (
        "EXPORT Fecha,Marca FROM spots WHERE Fecha BETWEEN '2026-01-05' AND '2026-01-05' "
        "AND Marca IN ('a', 'b', 'c', ... (4 total)) AND Medio IN ('x') -- 12 rows"
    )


def test_sector_names(spark):
    from spotlake.operators.access import sector_medium

    values = [" Televisión ", "TV abierta", "Radio FM", "PRENSA nacional", "Revistas", "Cine", None, "radio y tv"]
    assert column(spark, values, sector_medium) == ["tv", "tv", "radio", "impresos", "impresos", None, None, "tv"]
