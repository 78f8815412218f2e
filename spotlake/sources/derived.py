"""Small tables derived from the detections, kept in step with the replaced days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, functions as F

from spotlake.operators import distinct, rollup, stats, suggest
from spotlake.sources.store import Store


def _on(days: Sequence[date] | None) -> Column:
    return F.lit(True) if days is None else F.col("Fecha").isin(list(days))


def refresh_rollup(store: Store, days: Sequence[date] | None = None) -> None:
    """Recompute the daily rollup for the given days, or for all of them.

    Days that lost their rows lose their rollup as well.
    """
    media = stats.all_media(store.read("spots").where(_on(days)), store.read("print_ads").where(_on(days)))
    if days is not None:
        store.delete("daily_rollup", F.col("day").isin(list(days)))
    store.replace_days("daily_rollup", rollup.daily_rollup(media))


def refresh_distinct_sets(store: Store, days: Sequence[date] | None = None) -> None:
    """Recompute the bitmaps behind exact distinct counts for the given days, or for all of them.

    Values seen for the first time enter the dictionary before the bitmaps that use their ids.
    """
    media = stats.all_media(store.read("spots").where(_on(days)), store.read("print_ads").where(_on(days)))
    values = distinct.day_values(media)
    store.append("distinct_ids", distinct.new_ids(values, store.read("distinct_ids")))
    store.delete("distinct_sets", F.lit(True) if days is None else F.col("day").isin(list(days)))
    store.replace_days("distinct_sets", distinct.distinct_sets(values, store.read("distinct_ids")))


def refresh_label_values(store: Store, days: Sequence[date] | None = None) -> None:
    """Rebuild the table that unfiltered suggestions are served from, for the given days or for all."""
    values = suggest.label_values_by_day(store.read("spots").where(_on(days)), store.read("print_ads").where(_on(days)))
    if days is not None:
        store.delete("label_values", F.col("day").isin(list(days)))
    store.replace_days("label_values", values)


def refresh(store: Store, days: Sequence[date]) -> None:
    """Bring all derived tables in step with the given days."""
    if days:
        refresh_rollup(store, days)
        refresh_distinct_sets(store, days)
        refresh_label_values(store, days)
