"""Helpers shared by the text operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from spotlake.sources.scratch import cut, scratch_path  # noqa: F401

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the module's functions to the workers by value: they need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def text_of(column: str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def uniform(*parts: Column) -> Column:
    """A reproducible number in [0, 1) drawn from the hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def let(value: Column, body) -> Column:
    """Bind a value once inside an expression: ``body`` receives it as a column."""
    return F.element_at(F.transform(F.array(value), body), 1)
