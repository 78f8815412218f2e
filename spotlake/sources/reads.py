"""Reads of the stored tables on behalf of a user: access is checked and the read is logged."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from spotlake.functions.params import as_day, audit_text
from spotlake.operators import events
from spotlake.operators.access import check_access
from spotlake.operators.filters import FILTER_COLUMNS, Filters, active, select_range
from spotlake.sources.store import Store


@dataclass(frozen=True)
class Reader:
    """A user, the media they may see (none: all) and the table of known users (``user``, ``id``)."""

    store: Store
    user: str
    users: DataFrame
    media: Sequence[str] | None = None
    admin: bool = False

    def detections(
        self, medium: str, start: str | date, end: str | date, filters: Filters | None = None,
        instruction: str = "SELECT", source: str = "records", columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """Rows of one medium in a range. A read without access fails; every other one leaves an audit row."""
        check_access(medium, list(self.media) if self.media else None, self.admin)
        table = "print_ads" if medium == "impresos" else "spots"
        rows = self.store.read(table)
        if table == "spots":
            rows = rows.where(F.col("tipo") == medium)
        self._log(medium, table, as_day(start), as_day(end), filters, instruction, source, columns)
        return select_range(rows, medium, start, end, filters)

    def _log(self, medium, table, start: date, end: date, filters, instruction: str, source: str, columns) -> None:
        spark = self.store.spark
        clauses = {
            FILTER_COLUMNS[medium][name]: F.array(*map(F.lit, values))
            for name, values in active(filters).items() if name in FILTER_COLUMNS[medium]}
        line = audit_text(
            F.lit(instruction), F.lit(table), F.lit(start), F.lit(end), clauses,
            columns=F.lit(", ".join(columns)) if columns else None)
        read = spark.range(1).select(
            F.lit(self.user).alias("user"), F.lit(instruction).alias("instruction"), line.alias("sql_command"),
            F.lit(source).alias("source"))
        self.store.append("audit_log", events.audit_rows(read, self.users, F.current_timestamp()))
