"""Timings of the headline queries. Prints one JSON line.

    BENCH_SF_DIR  data folder   (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads (default 8)
    BENCH_RUNS    warm runs per query, the median counts (default 5)

``queries`` holds the named queries as they stand, joins over the given tables included.
``stored`` holds the same questions asked of the date-partitioned tables the ingestion
fills, the shape the analyst's queries normally meet, and of the daily rollup.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, functions as F  # noqa: E402

from spotlake.operators import pages, quality, rankings, rollup, stats, suggest  # noqa: E402
from spotlake.plans import registry  # noqa: E402
from spotlake.plans.fixtures import Fixtures  # noqa: E402
from spotlake.session import local_session  # noqa: E402
from spotlake.sources import derived  # noqa: E402
from spotlake.sources.store import Store  # noqa: E402

HEADLINE = (
    "tv_stats", "radio_stats", "print_stats", "status_range_tv", "top_brands", "top_brands_range", "top_sectors",
    "totals_top_brands", "media_summary", "media_top_brands", "suggest_brand", "suggest_filtered", "suggest_industry",
    "records_page", "records_keyset", "export_spots", "quality_report", "clean_raw", "normalize_text", "clean_totals",
    "repair_counts", "event_state", "notifications", "load_status_range", "replace_day",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(tasks: dict, runs: int) -> dict[str, float]:
    """Median seconds per task; a first round over all tasks warms the engine up."""
    for work in tasks.values():
        work()
    medians = {}
    for name, work in tasks.items():
        spent = []
        for _ in range(runs):
            started = time.perf_counter()
            work()
            spent.append(time.perf_counter() - started)
        medians[name] = round(statistics.median(spent), 4)
    return medians


def build_store(spark, fx: Fixtures) -> Store:
    """All spots and print ads, with their derived tables.

    Only days are merged: the given dates span seven years, a partition per medium and day of
    which would time little but the file system, so all years are laid onto one.
    """
    store = Store(spark, "bench").create()
    day = F.date_add(F.lit("1996-01-01").cast("date"), (F.dayofyear("Fecha") - 1))
    store.replace_days("spots", fx.spots.withColumn("Fecha", day))
    store.replace_days("print_ads", fx.print_ads.withColumn("Fecha", day))
    derived.refresh_rollup(store)
    derived.refresh_label_values(store)
    return store


def stored_queries(store: Store) -> dict:
    tv = store.read("spots").where(F.col("tipo") == "tv")
    paper = store.read("print_ads")
    span = ("19960101", "19961231")
    inside = stats.select_range(tv, "tv", *span, registry.SPOT_FILTERS)
    day = tv.where(F.col("Fecha") == "1996-06-15").withColumn("Tarifa", F.col("Tarifa") * 2)
    day.write.mode("overwrite").saveAsTable(store.name("batch"))
    batch = store.read("batch")
    return {
        "tv_stats": lambda: run(stats.medium_stats(tv, "tv")),
        "top_brands_range": lambda: run(rankings.top_brands(inside, "tv")),
        "suggest_brand": lambda: run(suggest.suggest(tv, paper, "Marca", registry.BRAND)),
        "records_page": lambda: run(pages.records_page(stats.select_range(tv, "tv", *span), 3, 25)),
        "records_page_deep": lambda: run(pages.records_page(
            tv, 10_000, 25, days=rollup.day_rows(store.read("daily_rollup"), "tv"))),
        "records_page_deep_sorted": lambda: run(pages.records_page(tv, 10_000, 25)),
        "quality_report": lambda: run(quality.quality_report(tv)),
        "top_brands": lambda: run(rankings.top_brands(tv, "tv")),
        "top_brands_rollup": lambda: run(rollup.top(
            store.read("daily_rollup"), "tv", {"anunciante": "advertiser", "marca": "brand"})),
        "suggest_industry": lambda: run(suggest.suggest(tv, paper, "Industria")),
        "suggest_industry_values": lambda: run(suggest.suggest_from_values(store.read("label_values"), "Industria")),
        "replace_one_day": lambda: store.replace_days("spots", batch),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    warehouse = tempfile.mkdtemp(prefix="spotlake-bench-")
    spark = local_session(cpus, "bench", **{"spark.sql.warehouse.dir": warehouse})
    built = registry.queries()

    names = sys.argv[1:] or HEADLINE
    timings = timed({name: lambda n=name: run(built[n](spark, folder)) for name in names}, runs)
    result = {
        "metric": "median seconds over the headline queries, summed",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")),
        "cpus": int(cpus),
        "runs": runs,
        "rows": {"lineitem": spark.read.parquet(f"{folder}/lineitem.parquet").count()},
    }
    if not sys.argv[1:]:
        started = time.perf_counter()
        store = build_store(spark, Fixtures(spark, folder))
        stored = stored_queries(store)
        result["store_build_sec"] = round(time.perf_counter() - started, 2)
        result["store_rows"] = {name: store.read(name).count() for name in ("spots", "print_ads")}
        result["stored"] = timed(stored, runs)
        result["replaced_rows_per_sec"] = round(store.spark.table(store.name("batch")).count() / result["stored"]["replace_one_day"])
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
