"""Physical plans: what reaches the scan, what crosses to Python and what gathers in one task."""

from __future__ import annotations

import re

import pytest
from shared import DATA

import __spark_entry__ as entry

QUERIES = entry.queries()
FOLDING = {
    "normalize_text", "clean_labels", "clean_raw", "clean_print", "clean_batch_tv", "clean_batch_radio",
    "clean_batch_print", "clean_library", "clean_totals",
}


def plan_of(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def gathered(plan: list[str]) -> list[str]:
    """Operators directly below an exchange into a single partition."""
    return [plan[i + 1].lstrip(" :+-") for i, line in enumerate(plan) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("name", QUERIES)
def test_plan_scales(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    text = "\n".join(plan)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "PythonMapInArrow" not in text
    assert text.count("ArrowEvalPython") == (1 if name in FOLDING else 0)
    # whatever meets in one task was reduced or cut in every task before
    for below in gathered(plan):
        assert re.match(r"(\*\(\d+\) )?(HashAggregate|LocalLimit|Project|SortAggregate|ObjectHashAggregate)", below), below
        if "Project" in below:
            assert name == "export_spots"


def test_ranks_are_cut_before_the_shuffle(spark):
    text = "\n".join(plan_of(QUERIES["media_top_brands"](spark, DATA)))
    assert re.search(r"WindowGroupLimit .*Partial", text)
    assert text.index("Final") < text.index("Partial")


def test_range_reaches_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = "\n".join(plan_of(QUERIES["top_brands_range"](spark, DATA)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in scan
    assert "EqualTo(l_linestatus,O)" in scan and "l_tax" not in scan and "l_discount" not in scan


def test_page_takes_its_rows_without_a_global_sort(spark):
    text = "\n".join(plan_of(QUERIES["records_page"](spark, DATA)))
    assert "TakeOrderedAndProject" in text and "Window" not in text


def test_export_numbers_one_row_per_day_only(spark):
    plan = plan_of(QUERIES["export_spots"](spark, DATA))
    window = next(i for i, line in enumerate(plan) if "Window [" in line)
    below = "\n".join(plan[window:window + 8])
    assert "HashAggregate(keys=[Fecha" in below


def test_notices_are_parsed_once_each(spark):
    text = "\n".join(plan_of(QUERIES["notifications"](spark, DATA)))
    assert len(re.findall(r"parse_json|parseJson", text, re.I)) <= 4
