"""Detail pages and bounded exports.

The total is a scalar subquery of its own (a partial count per task), never a window over
the whole result, and every order ends in a full tie-break.

A page behind a large offset need not sort what precedes it: with the number of rows per day
(:func:`day_rows`, or :func:`rollup.day_rows` from the stored rollup) their prefix sums name the
days the page lies in, and only these are read and sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotlake.functions.numbers import MONEY
from spotlake.schemas import display_columns

# Result limits
RECORDS_PAGE = (10, 200)
CATALOGUE_PAGE = (1, 500)

PRINT_PAGE_COLUMNS = (
    "id", "Fuente", "Medio", "Anunciante", "Marca", "Sector", "Categoria", "Fecha",
    "Costo", "Tiraje", "Dimension",
)
# ---- end of fixed values


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _check(page: int, size: int, bounds: tuple[int, int]) -> None:
    if page < 1 or not bounds[0] <= size <= bounds[1]:
        raise ValueError(f"page must be at least 1 and its size within {bounds}")


def display(df: DataFrame) -> DataFrame:
    """Reader-facing text: dates as ISO, amounts with two decimals, null as an empty string."""
    def shown(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "double":
            c = c.try_cast(MONEY)
        return F.coalesce(c.cast("string"), F.lit("")).alias(name)

    return df.select([shown(n, k) for n, k in df.dtypes])


def total_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def day_rows(df: DataFrame, day: str = "Fecha") -> DataFrame:
    """day, rows: how many rows every day has; rows without a day are a day of their own."""
    return df.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("rows"))


def with_total(rows: DataFrame, counted: DataFrame, size: int, days: DataFrame | None = None) -> DataFrame:
    """Attach the size of the whole result and its number of pages to the page rows."""
    total = total_of(counted) if days is None else days.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"))
    return rows.withColumns({
        "total": total.scalar(),
        "total_pages": F.ceil(total.scalar() / F.lit(size)).cast("bigint"),
    })


def page_of(df: DataFrame, order: Sequence[Column], page: int, size: int) -> DataFrame:
    """Rows of one page. ``order`` is completed with the remaining columns of the frame."""
    tie_break = ascending(*df.columns)
    return df.orderBy(*order, *tie_break).offset((page - 1) * size).limit(size)


def days_of_page(days: DataFrame, page: int, size: int, newest_first: bool = False) -> list[tuple]:
    """day and rows before it, of the days a page lies in: at most ``size``, since each has a row.

    ``days`` holds one line per day of the calendar, which one task numbers.
    """
    first = (page - 1) * size
    order = F.col("day").desc_nulls_first() if newest_first else F.col("day").asc_nulls_last()
    before = F.sum("rows").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    placed = days.where("rows > 0").select("day", "rows", F.coalesce(before, F.lit(0)).alias("before"))
    inside = placed.where((F.col("before") < first + size) & (F.col("before") + F.col("rows") > first))
    return [(r["day"], r["before"]) for r in inside.orderBy("before").limit(size).collect()]


def page_by_days(
    df: DataFrame, days: DataFrame | None, order: Sequence[Column], page: int, size: int,
    day: str = "Fecha", newest_first: bool = False,
) -> DataFrame:
    """:func:`page_of` for an order that begins with ``day``, reading only the days of the page.

    ``days`` are the rows per day of exactly this frame; without them the whole frame is ordered.
    """
    if days is None:
        return page_of(df, order, page, size)
    found = days_of_page(days, page, size, newest_first)
    if not found:
        return df.where(F.lit(False))
    dated = [value for value, _ in found if value is not None]
    wanted = F.col(day).isin(dated) if dated else F.lit(False)
    if len(dated) < len(found):
        wanted = wanted | F.col(day).isNull()
    skipped = (page - 1) * size - found[0][1]
    return df.where(wanted).orderBy(*order, *ascending(*df.columns)).offset(skipped).limit(size)


def records_page(df: DataFrame, page: int = 1, size: int = 25, days: DataFrame | None = None) -> DataFrame:
    """Detail page ordered by day, without the Id* columns."""
    _check(page, size, RECORDS_PAGE)
    shown = df.select(display_columns(df.columns))
    return with_total(display(page_by_days(shown, days, ascending("Fecha"), page, size)), shown, size, days)


def print_page(df: DataFrame, page: int = 1, size: int = 50, days: DataFrame | None = None) -> DataFrame:
    """Print ads, newest first; absent texts are empty, absent numbers zero."""
    _check(page, size, CATALOGUE_PAGE)
    shown = df.select(*PRINT_PAGE_COLUMNS)
    order = [F.col("Fecha").desc_nulls_first(), *ascending("id")]
    rows = page_by_days(shown, days, order, page, size, newest_first=True)
    texts = ("Fuente", "Medio", "Anunciante", "Marca", "Sector", "Categoria")
    rows = rows.withColumns({
        **{n: F.coalesce(n, F.lit("")) for n in texts},
        "Fecha": F.coalesce(F.date_format("Fecha", "yyyy-MM-dd"), F.lit("")),
        **{n: F.coalesce(n, F.lit(0)) for n in ("Costo", "Tiraje", "Dimension")},
    })
    return with_total(rows, df, size, days)


def library_page(df: DataFrame, page: int = 1, size: int = 50) -> DataFrame:
    _check(page, size, CATALOGUE_PAGE)
    return with_total(page_of(df, ascending("IdMaster"), page, size), df, size)


def totals_page(df: DataFrame, page: int = 1, size: int = 50, days: DataFrame | None = None) -> DataFrame:
    _check(page, size, CATALOGUE_PAGE)
    order = [F.col("FechaInicio").desc_nulls_first(), *ascending("IdMaster")]
    return with_total(page_by_days(df, days, order, page, size, "FechaInicio", newest_first=True), df, size, days)


def keyset_page(df: DataFrame, keys: Sequence[str], after: Sequence, seen: int, size: int) -> DataFrame:
    """The page that follows a cursor, however deep, without sorting what precedes it.

    The cursor is the key of the last row shown plus how many rows with that same key were
    shown. Keys need not be unique: rows with the cursor's key are skipped by count, in the
    order of the full tie-break, so none is lost or repeated. The keys must not be null.
    """
    keys, values = list(keys), [F.lit(v) for v in after]
    tied = F.lit(True)
    beyond = F.lit(False)
    for name, value in zip(keys, values, strict=True):
        beyond = beyond | (tied & (F.col(name) > value))
        tied = tied & (F.col(name) == value)
    # the leading bound on its own is what reaches the partitions and the scan
    rest = df.where(F.col(keys[0]) >= values[0]).where(beyond | tied)
    return rest.orderBy(*ascending(*keys), *ascending(*df.columns)).offset(seen).limit(size)


def cursor_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cursor for the page after ``rows``: last key and how often it occurs there."""
    last = rows.groupBy(*keys).agg(F.count("*").alias("seen"))
    return last.orderBy(*[F.col(k).desc() for k in keys]).limit(1)


def export_columns(df: DataFrame, wanted: Sequence[str]) -> list[Column]:
    """Requested columns in the requested order; ``Ins`` counts one per row, unknown names are skipped."""
    chosen = []
    for name in dict.fromkeys(wanted):
        if name == "Ins":
            chosen.append(F.lit(1).alias("Ins"))
        elif name in df.columns and name != "id":
            chosen.append(F.col(name))
    if not chosen:
        raise ValueError("none of the requested columns exists")
    return chosen


def _cut(df: DataFrame, cap: int) -> DataFrame:
    """One row: the total, the day that fills the cap (null if none does) and what it may still add.

    Counts per day come first, so the running count is as small as the calendar.
    """
    per_day = df.groupBy("Fecha").agg(F.count("*").alias("rows"))
    order = Window.orderBy(F.col("Fecha").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    running = per_day.withColumn("so_far", F.sum("rows").over(order))
    last = F.min(F.when(F.col("so_far") > cap, F.struct("so_far", F.col("Fecha").alias("day"), "rows")))
    return running.agg(F.struct(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"), last["day"].alias("day"), last.isNotNull().alias("cut"),
        (F.lit(cap) - last["so_far"] + last["rows"]).alias("left")).alias("cut"))


def export_rows(df: DataFrame, wanted: Sequence[str], cap: int | None = None) -> DataFrame:
    """Export of an already filtered range, ordered by day, cut only if a cap is asked for.

    The order is a range-partitioned sort. With a cap, days after the one that fills it are
    dropped before the sort, and only the rows of that one day are ranked to be cut.
    ``total_available`` and ``truncated`` say what the cap left out.
    """
    if cap is None:
        cut, needed = None, df
        total, truncated = total_of(df).scalar(), F.lit(False)
    else:
        cut = _cut(df, cap).scalar()
        total, truncated = cut["total"], cut["cut"]
        before = df.where(~cut["cut"] | (F.col("Fecha") < cut["day"]) | (cut["day"].isNull() & F.col("Fecha").isNotNull()))
        rank = F.row_number().over(Window.partitionBy("Fecha").orderBy(*ascending(*df.columns)))
        edge = df.where(cut["cut"] & F.col("Fecha").eqNullSafe(cut["day"])).withColumn("_rank", rank)
        needed = before.unionByName(edge.where(F.col("_rank") <= cut["left"]).drop("_rank"))
    ordered = needed.orderBy(*ascending("Fecha"), *ascending(*df.columns))
    return ordered.select(*export_columns(df, wanted), total.alias("total_available"), truncated.alias("truncated"))
