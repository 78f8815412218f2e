"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its content. The ledger, a folder of
three Parquet tables, remembers which blob was scanned under which version of which rule
(``scans``) and what was found (``findings``). A scan looks only at pairs of blob and rule
version it has not seen, reads the text of one path per new blob, and joins the findings
back to all paths of the blob. Copies are thus scanned once, a changed rule rescans
everything, a new text costs only itself.

Both joins that bring findings back to paths pair two stored tables, so a blob with a third
of all paths is split by adaptive execution.

Spans are counted in code points, end exclusive. Nulls: a null text is the empty text, a
null path is a path. Repeated rows are returned once each. An empty table gives an empty
result and leaves the ledger as it is. Other columns are not looked at. A run that dies
between the two appends rescans its blobs: scans are recorded last, findings are reduced to
one row per blob and rule when read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spotlake.llm.common import cut, let, scratch_path, text_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` is matched leftmost and non-overlapping; a match counts if
    its group ``measured`` has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    measured: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


# The kinds every scan reports, in the order of the report, then further kinds.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    # a run of fewer than 24 is dropped either way, so only long runs are matched
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
BASE = ("assign", "access", "hex")


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the matches of ``rule`` that are long enough."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,measured:int>>")

    def located(found: Column) -> Column:
        between = F.split(text, rule.pattern, -1)
        measured = F.length if rule.measured == 0 else lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.measured))
        sizes = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, match: F.struct(
            F.length(gap).alias("gap"), F.length(match).alias("size"), measured(match).alias("measured")))
        start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
        walked = F.aggregate(sizes, start, lambda acc, m: F.struct(
            (acc["at"] + m["gap"] + m["size"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + m["gap"]).alias("start"), (acc["at"] + m["gap"] + m["size"]).alias("end"),
                m["measured"].alias("measured")))).alias("spans")))
        return F.filter(walked["spans"], lambda s: s["measured"] >= rule.least)

    spans = let(matches, lambda found: F.when(F.size(found) == 0, empty).otherwise(located(found)))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


class BlobLedger:
    """The ledger in folder ``root``; the folder must be one that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def scans(self) -> DataFrame:
        return self._read("scans", "blob binary, rule string").distinct()

    def findings(self) -> DataFrame:
        return self._read("findings", "blob binary, rule string, spans array<struct<start:int,end:int>>")

    def update(self, versions: DataFrame, rules: tuple[Rule, ...], path_column: str, text_column: str) -> DataFrame:
        """Scan what is new in ``versions`` and return its (path, blob) rows."""
        paths = cut(versions.select(
            F.col(f"`{path_column}`").alias("path"), F.unhex(F.sha2(text_of(text_column), 256)).alias("blob")), "paths")
        seen = self.scans().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        keys = F.array(*[F.lit(rule.key) for rule in rules])
        # the pair of smallest path and blob names one text of the blob
        new = cut(paths.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left").select(
            "blob", "path", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))).alias("pending"),
        ).where(F.size("pending") > 0), "new-blobs").alias("n")
        texts = versions.select(F.col(f"`{path_column}`").alias("path"), text_of(text_column).alias("text")).alias("t")
        found = new.join(texts, F.col("n.path").eqNullSafe(F.col("t.path"))).where(
            F.unhex(F.sha2(F.col("text"), 256)) == F.col("blob")).select("blob", F.explode(F.array(*[
                F.when(F.array_contains("pending", F.lit(rule.key)), F.struct(
                    F.lit(rule.key).alias("rule"), spans_of(F.col("text"), rule).alias("spans"))) for rule in rules
            ])).alias("result")).select("blob", "result.*").where(F.size("spans") > 0)
        found.write.mode("append").parquet(f"{self.root}/findings")
        new.select("blob", F.explode("pending").alias("rule")).write.mode("append").parquet(f"{self.root}/scans")
        return paths

    def report(self, paths: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """path and spans (struct of start, order, kind, end, sorted) of every row of ``paths``."""
        order = {rule.key: (number, rule.kind) for number, rule in enumerate(rules)}
        current = self.findings().where(F.col("rule").isin(list(order))).dropDuplicates(["blob", "rule"])
        number = functools.reduce(lambda c, k: c.when(F.col("rule") == k, order[k][0]), order, F)
        kind = functools.reduce(lambda c, k: c.when(F.col("rule") == k, order[k][1]), order, F)
        by_blob = cut(current.select("blob", F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), number.alias("number"), kind.alias("kind"), s["end"].alias("end"))).alias("spans"),
        ).groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans")), "blob-spans")
        nothing = F.array().cast(by_blob.schema["spans"].dataType)
        return paths.join(by_blob, "blob", "left").select("path", "blob", F.coalesce("spans", nothing).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_scan(
    versions: DataFrame, ledger: BlobLedger | None = None, rules: tuple[Rule, ...] = RULES,
    path_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """path, n_assign, n_access, n_hex, base_sha256 and spans of every row of ``versions``."""
    spark = versions.sparkSession
    ledger = ledger or BlobLedger(spark, scratch_path(spark, "secret-ledger"))
    report = ledger.report(ledger.update(versions, rules, path_column, text_column), rules)

    def of_kinds(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return report.select(
        F.col("path").alias(path_column), *counts,
        F.sha2(listed(of_kinds(*BASE)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
