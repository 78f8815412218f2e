"""Cleaning pipelines: raw text rows to typed rows, driven by the column specification.

Each pipeline is one projection in two steps. Validity is a column (``reject_reason``), so accepted and
rejected rows come from the same pass and their counts always add up to the input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.functions import dates, numbers, text
from spotlake.schemas import KEY_COLUMN, LABEL_WIDTH, SPECS, Column as Spec

REASON = "reject_reason"
BAD_DATE, NO_KEY = "bad_date", "missing_key"


Rule = Callable[[Column], Column]


def _live_rules(feed: str) -> tuple[Mapping[str, Rule], Rule]:
    """Live feeds: numbers default to zero, labels are cut before they are folded.

    Returns the first step per kind and the second step of labels. Labels take two steps so
    that the trimmed text is computed once and then used several times.
    """
    width = LABEL_WIDTH[feed]
    first = {
        "date": dates.feed_date,
        "int": lambda c: numbers.or_zero(numbers.whole(c, "int"), "int"),
        "long": lambda c: numbers.or_zero(numbers.whole(c, "bigint"), "bigint"),
        "double": lambda c: numbers.or_zero(numbers.real(c), "double"),
        "label": lambda c: text.cut(c, width),
        "time": lambda c: text.cut(c, width),
        "text": text.optional_text,
        "raw": lambda c: c,
    }
    return first, text.folded_label


def _batch_rules(feed: str) -> tuple[Mapping[str, Rule], Rule]:
    """Batch feeds: numbers stay null when unreadable, labels are folded before they are cut."""
    width = LABEL_WIDTH[feed]
    first = {
        "date": dates.any_date,
        "int": lambda c: numbers.exact_whole(c, "int"),
        "long": lambda c: numbers.exact_whole(c, "bigint"),
        "double": numbers.real,
        "label": lambda c: text.strip(c.cast("string")),
        "time": text.clock_text,
        "text": text.long_text,
        "raw": lambda c: c,
    }
    return first, lambda c: text.folded_batch_label(c, width)


# Columns whose unreadable numbers become zero in the batch variants
BATCH_ZERO = {
    "tv": (),
    "radio": ("DReal", "DTeorica", "NoCorte", "Tarifa"),
    "impresos": ("IdFuente", "Tiraje", "Costo", "Dimension"),
    "library": ("DTeorica",),
    "totals": ("TotalHit",),
}


def known(feed: str, df: DataFrame) -> list[Spec]:
    """The specification columns that the frame really has, in table order."""
    present = set(df.columns)
    return [c for c in SPECS[feed] if c.name in present]


def missing_columns(feed: str, df: DataFrame) -> list[str]:
    present = set(df.columns)
    return [c.name for c in SPECS[feed] if c.name not in present]


def project_known(feed: str, df: DataFrame) -> DataFrame:
    """Drop everything the target table does not have."""
    return df.select([c.name for c in known(feed, df)])


def _reason(day: Column | None, key: Column) -> Column:
    no_key = F.when(key.isNull(), NO_KEY)
    return no_key if day is None else F.when(day.isNull(), BAD_DATE).otherwise(no_key)


def _finish_labels(df: DataFrame, labels: set[str], rule: Rule) -> DataFrame:
    return df.select([rule(F.col(c)).alias(c) if c in labels else F.col(c) for c in df.columns])


def clean_live(feed: str, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """TV, radio and print rows as the live path cleans them, plus ``reject_reason``.

    The key test looks at the text as it arrived: an unreadable key counts as zero, an
    absent one rejects the row.
    """
    first, second = _live_rules(feed)
    columns = [first[c.kind](F.col(c.name)).alias(c.name) for c in known(feed, df)]
    if "Subtitulo" in missing_columns(feed, df):
        columns.append(text.optional_text(F.lit(None).cast("string")).alias("Subtitulo"))
    reason = _reason(dates.feed_date(F.col("Fecha")), F.col(KEY_COLUMN[feed])).alias(REASON)
    labels = {c.name for c in known(feed, df) if c.kind in ("label", "time")}
    return _finish_labels(df.select(*keep, *columns, reason), labels, second)


def clean_batch(feed: str, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Any feed as the batch path cleans it, plus ``reject_reason``.

    Here an unreadable key is an absent key. Catalogues carry their own dates (see
    :func:`stamp_range`), so only the detection feeds are tested for a date.
    """
    first, second = _batch_rules(feed)
    long_texts = {"Testigo", "TextoNota"} if feed == "impresos" else set()

    def cleaned(c: Spec) -> Column:
        if feed in ("library", "totals") and c.kind == "date":
            return F.col(c.name)
        if c.name in long_texts:
            return text.long_text(F.col(c.name), "NaN")
        value = first[c.kind](F.col(c.name))
        return numbers.or_zero(value, c.type.simpleString()) if c.name in BATCH_ZERO[feed] else value

    present = known(feed, df)
    columns = [cleaned(c).alias(c.name) for c in present]
    columns += [
        text.long_text(F.lit(None).cast("string")).alias(n)
        for n in ("Testigo", "TextoNota", "Version")
        if feed not in ("tv", "radio") and n in missing_columns(feed, df)
    ]
    day = F.col("Fecha") if any(c.name == "Fecha" for c in present) else None
    typed = df.select(*keep, *columns).withColumn(REASON, _reason(day, F.col(KEY_COLUMN[feed])))
    labels = {c.name for c in present if c.kind == "label"} - long_texts
    return _finish_labels(typed, labels, second)


def stamp_range(df: DataFrame, start: date, end: date) -> DataFrame:
    """Totals rows carry the requested day range."""
    return df.withColumns({"FechaInicio": F.lit(start), "FechaFin": F.lit(end)})


def accepted(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col(REASON).isNull()).drop(REASON)


def rejected(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col(REASON).isNotNull())


def reject_counts(cleaned: DataFrame) -> DataFrame:
    """Rows per outcome; ``accepted`` plus the reasons equals the input."""
    return cleaned.groupBy(F.coalesce(REASON, F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("rows")
    )


def dates_only_filter(df: DataFrame) -> DataFrame:
    """The columnar variant's looser test: only a day text is required."""
    day = dates.short_date(F.col("Fecha"))
    return df.withColumn("Fecha", day).where(day.isNotNull() & (day != ""))
