"""Loading the two master catalogues."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from spotlake.functions.params import as_day
from spotlake.operators.clean import accepted, clean_batch, stamp_range
from spotlake.sources.store import Store


def clean_library(raw: DataFrame) -> DataFrame:
    return clean_batch("library", raw)


def clean_totals(raw: DataFrame, start: str | date, end: str | date) -> DataFrame:
    return clean_batch("totals", stamp_range(raw, as_day(start), as_day(end)))


def load_library(store: Store, raw: DataFrame, snapshot: str) -> None:
    """Full refresh of the media library."""
    store.refresh("media_library", accepted(clean_library(raw)), snapshot)


def load_totals(store: Store, raw: DataFrame, day: str | date) -> None:
    """Replace one day of the master totals; a day without rows becomes empty."""
    wanted = as_day(day)
    rows = accepted(clean_totals(raw, wanted, wanted))
    store.replace_days("media_totals", rows, emptied=[(wanted,)] if rows.isEmpty() else ())
