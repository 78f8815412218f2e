"""The same queries as SQL over the given tables, where SQL can say them."""

from __future__ import annotations

from spotlake.llm.secret_ledger import BASE, RULES

EXACT_DEDUP = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
             max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
             count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
      FROM documents)
"""

#: Lines on ten or more sites stay in the document with the smallest id only.
LINE_DEDUP = r"""
WITH split AS (
    SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, source, unnest(lines) AS line FROM split),
common AS (
    SELECT line, min(doc_id) AS first_id FROM lines
    WHERE NOT regexp_full_match(line, '[ \t\r\x0b\x0c]*')
    GROUP BY line HAVING count(DISTINCT coalesce('s' || source, 'n')) >= 10),
lost AS (
    SELECT doc_id, list(DISTINCT line) AS lost FROM lines JOIN common USING (line) WHERE doc_id <> first_id GROUP BY doc_id)
SELECT doc_id, coalesce(len(lines), 0) AS n_lines,
       coalesce(len(list_filter(lines, lambda x: list_contains(lost, x))), 0) AS n_removed,
       CASE WHEN lost IS NULL THEN text
            ELSE array_to_string(list_filter(lines, lambda x: NOT list_contains(lost, x)), chr(10)) END AS text
FROM split LEFT JOIN lost USING (doc_id)
"""


def _spans(kind: str, number: int, pattern: str, measured: int, least: int) -> str:
    """SQL rows (doc_id, start, number, kind, finish) of one rule."""
    return f"""
    SELECT doc_id, start, {number} AS number, '{kind}' AS kind, start + size AS finish
    FROM (SELECT doc_id,
                 list_sum(list_transform(between[1:place], lambda x: len(x))) +
                 coalesce(list_sum(list_transform(found[1:place - 1], lambda x: len(x))), 0) AS start,
                 len(found[place]) AS size, len(regexp_extract(found[place], pattern, {measured})) AS measured
          FROM (SELECT *, unnest(range(1, len(found) + 1)) AS place
                FROM (SELECT doc_id, pattern, regexp_extract_all(text, pattern) AS found,
                             regexp_split_to_array(text, pattern) AS between
                      FROM (SELECT doc_id, coalesce(text, '') AS text, '{pattern.replace("'", "''")}' AS pattern FROM documents))))
    WHERE measured >= {least}"""


def secret_scan_sql() -> str:
    rows = " UNION ALL ".join(
        _spans(rule.kind, number, rule.pattern.replace("\\x20", " "), rule.measured, rule.least)
        for number, rule in enumerate(RULES))
    listed = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(finish AS BIGINT), ',' ORDER BY start, number)"
    base = ", ".join(f"'{kind}'" for kind in BASE)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in BASE)
    return f"""
WITH spans AS ({rows})
SELECT doc_id, {counts}, sha256(coalesce({listed[:-1]}) FILTER (WHERE kind IN ({base})), '')) AS base_sha256,
       coalesce({listed}, '') AS spans
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_secret_scan": secret_scan_sql(),
        "op7_exact_dedup": EXACT_DEDUP,
        "op8_line_dedup": LINE_DEDUP,
    }
