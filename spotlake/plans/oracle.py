"""The named queries in plain SQL, for checking results against another engine."""

from __future__ import annotations

import re

from spotlake.functions.text import WHITESPACE
from spotlake.schemas import display_columns

# -- projections of the given tables --------------------------------------------------------

FIXTURES = {
    "fx_spots": """
SELECT CASE WHEN l_linestatus = 'O' THEN 'tv' ELSE 'radio' END AS tipo,
       CAST(l_shipdate AS DATE) AS Fecha,
       n_nationkey AS IdLocalidad, n_name AS Localidad,
       r_regionkey AS IdMedio, r_name AS Medio,
       l_returnflag AS TipoMedio,
       CAST(s_suppkey AS INT) AS IdCanal, s_name AS Canal,
       CAST(substr(p_brand, 7) AS INT) AS IdMarca,
       CASE WHEN p_partkey % 17 = 0 THEN 'N.A.' WHEN p_partkey % 23 = 0 THEN ''
            WHEN p_partkey % 29 = 0 THEN NULL ELSE p_brand END AS Marca,
       p_name AS Submarca, p_type AS Producto,
       p_partkey AS IdVersion, p_name || ' ' || p_type AS Version,
       CAST(l_quantity AS INT) AS DReal, p_size AS DTeorica, l_linenumber AS NoCorte,
       c_custkey AS IdAnunciante,
       CASE WHEN c_custkey % 31 = 0 THEN 'N.A.' ELSE c_name END AS Anunciante,
       CASE WHEN c_custkey % 37 = 0 THEN 'N.A.' ELSE c_mktsegment END AS Industria,
       l_orderkey * 10 + l_linenumber AS IdDeteccion,
       CASE WHEN l_quantity = 7 THEN NULL ELSE l_extendedprice END AS Tarifa
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "fx_print": """
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS Fecha,
       r_regionkey AS IdMedio,
       CASE WHEN r_regionkey = 4 THEN NULL ELSE r_name END AS Medio,
       n_nationkey AS IdFuente, n_name AS Fuente,
       o_orderstatus AS Seccion, CAST(o_orderkey % 64 AS VARCHAR) AS Pagina,
       o_custkey * 100 AS Tiraje,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_totalprice END AS Costo,
       CASE WHEN c_custkey % 31 = 0 THEN 'N.A.' ELSE c_name END AS Anunciante,
       CASE WHEN o_custkey % 17 = 0 THEN 'N.A.'
            ELSE 'Brand#' || CAST(o_custkey % 25 + 1 AS VARCHAR) END AS Marca,
       CASE WHEN c_custkey % 37 = 0 THEN '' ELSE c_mktsegment END AS Sector,
       o_orderpriority AS Categoria, o_totalprice / 1000 AS Dimension
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "fx_library": """
SELECT p_partkey AS IdMaster,
       CASE WHEN p_size % 2 = 0 THEN 'AUDIOVISUAL' ELSE 'AUDIO' END AS TipoMaster,
       p_name || ' ' || p_brand AS Version,
       CASE WHEN p_partkey % 41 = 0 THEN 'N.A.' ELSE p_name END AS Anunciante,
       p_brand AS Marca,
       CASE WHEN p_partkey % 43 = 0 THEN '' ELSE p_type END AS Industria,
       p_size AS DTeorica
FROM part""",
    "fx_totals": """
SELECT CAST(l_shipdate AS DATE) AS FechaInicio, CAST(l_shipdate AS DATE) AS FechaFin,
       CASE WHEN r_regionkey = 4 THEN 'N.A.' ELSE r_name END AS Medio,
       p_partkey AS IdMaster,
       CASE WHEN p_size % 2 = 0 THEN 'AUDIOVISUAL' ELSE 'AUDIO' END AS TipoMaster,
       p_name || ' ' || p_brand AS Version,
       p_name AS Anunciante,
       CASE WHEN p_partkey % 17 = 0 THEN 'N.A.' ELSE p_brand END AS Marca,
       CASE WHEN p_partkey % 43 = 0 THEN '' ELSE p_type END AS Industria,
       l_returnflag AS Segmento,
       CAST(l_quantity AS INT) AS TotalHit,
       CASE WHEN l_quantity = 7 THEN NULL ELSE l_extendedprice END AS TotalInversion
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "fx_events": """
SELECT event_id AS id, CAST(event_id AS VARCHAR) AS event_id,
       CASE event_type WHEN 'purchase' THEN 'DataIngested' WHEN 'view' THEN 'DataProcessed'
            WHEN 'signup' THEN 'DataDeleted' ELSE 'DataIngested' END AS event_type,
       CASE user_id % 3 WHEN 0 THEN 'tv' WHEN 1 THEN 'radio' ELSE 'impresos' END AS aggregate_type,
       replace(substr(CAST(ts AS VARCHAR), 1, 10), '-', '') AS aggregate_id,
       props AS payload, ts AS occurred_at,
       CASE WHEN event_id % 10 < 6 THEN 'PROCESSED' WHEN event_id % 10 < 8 THEN 'PENDING' ELSE 'FAILED' END AS status,
       CASE WHEN event_id % 10 < 6 THEN 'worker-' || CAST(event_id % 2 AS VARCHAR) END AS consumer_id
FROM events""",
    "fx_raw": """
SELECT doc_id,
       CASE doc_id % 8
         WHEN 0 THEN '202601' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0')
         WHEN 1 THEN '2026-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0')
         WHEN 2 THEN '2026-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T08:30:00'
         WHEN 3 THEN '2026/01/' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0')
         WHEN 4 THEN lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '/01/2026'
         WHEN 5 THEN lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '-01-2026'
         WHEN 6 THEN '' ELSE 'sin fecha' END AS Fecha,
       CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN 'abc'
            ELSE CAST(doc_id AS VARCHAR) END AS IdDeteccion,
       CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 9 = 0 THEN 'nan'
            ELSE '  ' || text END AS Marca,
       lang AS Medio,
       CASE WHEN doc_id % 5 = 0 THEN 'n/d' ELSE CAST(n_chars AS VARCHAR) END AS Tarifa
FROM documents""",
    "fx_accounts": """
SELECT c_custkey % 50 AS id_account, n_regionkey AS id_sector_src
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_sectors": """
SELECT r_regionkey AS id,
       CASE r_regionkey WHEN 0 THEN 'Television' WHEN 1 THEN 'Radio FM' WHEN 2 THEN 'Revistas'
            WHEN 3 THEN 'Prensa Nacional' ELSE 'Cine' END AS name
FROM region""",
    "fx_notices": """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 THEN substr(body, 1, 20)
            WHEN event_id % 5 = 0 THEN body
            ELSE '{"Type":"Notification","Message":"' || replace(body, '"', chr(92) || '"') || '"}' END AS body
FROM (SELECT event_id,
             CASE WHEN event_id % 13 = 0 THEN '{"Records":[]}' ELSE
             '{"Records":[{"eventName":"'
             || CASE WHEN event_id % 7 = 0 THEN 'ObjectRemoved:Delete' ELSE 'ObjectCreated:Put' END
             || '","s3":{"object":{"key":"' || CASE WHEN event_id % 17 = 0 THEN 'other/' ELSE 'rawdata/' END
             || CASE user_id % 3 WHEN 0 THEN 'tv' WHEN 1 THEN 'radio' ELSE 'impresos' END || '/'
             || replace(substr(CAST(ts AS VARCHAR), 1, 10), '-', '')
             || CASE WHEN event_id % 19 = 0 THEN '/.keep' ELSE '/data.json' END || '"}}}]}' END AS body
      FROM events) e""",
    "fx_opened": """
SELECT event_id, json_extract_string(inner_doc, '$.Records[0].eventName') AS event_name,
       json_extract_string(inner_doc, '$.Records[0].s3.object.key') AS object_key,
       coalesce(json_array_length(inner_doc, '$.Records'), 0) AS records
FROM (SELECT event_id,
             CASE WHEN NOT json_valid(body) THEN NULL
                  WHEN json_extract_string(body, '$.Type') = 'Notification'
                  THEN json_extract_string(body, '$.Message') ELSE body END AS inner_doc
      FROM fx_notices) o""",
    "fx_paths": """
SELECT event_id, object_key,
       CASE WHEN good THEN parts[2] END AS medium, CASE WHEN good THEN parts[3] END AS day,
       CASE WHEN records < 1 THEN 'unreadable'
            WHEN event_name IS NULL OR NOT starts_with(event_name, 'ObjectCreated') THEN 'not_created'
            WHEN object_key IS NULL OR object_key = '' THEN 'no_key'
            WHEN NOT good THEN 'bad_path'
            WHEN ends_with(object_key, '.keep') THEN 'placeholder'
            WHEN parts[2] NOT IN ('tv', 'radio', 'impresos') THEN 'unknown_medium'
            ELSE 'ok' END AS outcome
FROM (SELECT *, len(parts) >= 4 AND parts[1] = 'rawdata' AS good
      FROM (SELECT *, string_split(object_key, '/') AS parts FROM fx_opened) p) q""",
    "fx_media": """
SELECT tipo AS medium, Fecha AS day, CAST(IdCanal AS VARCHAR) AS outlet, CAST(IdMarca AS VARCHAR) AS brand_key,
       CAST(IdAnunciante AS VARCHAR) AS advertiser_key, Anunciante AS advertiser, Marca AS brand,
       Industria AS sector, CAST(Tarifa AS DECIMAL(18,2)) AS spend
FROM fx_spots
UNION ALL
SELECT 'impresos', Fecha, CAST(IdFuente AS VARCHAR), Marca, Anunciante, Anunciante, Marca, Sector,
       CAST(Costo AS DECIMAL(18,2))
FROM fx_print""",
    "fx_allowed": """
SELECT a.id_account, coalesce(list_sort(list(DISTINCT m.medium) FILTER (WHERE m.medium IS NOT NULL)), []) AS media
FROM fx_accounts a
LEFT JOIN (SELECT id, CASE id WHEN 0 THEN 'tv' WHEN 1 THEN 'radio' WHEN 2 THEN 'impresos'
                              WHEN 3 THEN 'impresos' END AS medium FROM fx_sectors) m ON m.id = a.id_sector_src
GROUP BY a.id_account""",
    "fx_grants": """
SELECT id_account, CASE WHEN len(media) = 0 THEN ['tv', 'radio', 'impresos'] ELSE media END AS media
FROM fx_allowed""",
}


def _names(sql: str) -> list[str]:
    return [n for n in FIXTURES if re.search(rf"\b{n}\b", sql)]


def with_fixtures(sql: str) -> str:
    """Prefix a query with the projections it uses, directly or through another one."""
    needed = set(_names(sql))
    while True:
        more = needed | {m for n in needed for m in _names(FIXTURES[n])}
        if more == needed:
            break
        needed = more
    head = ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in FIXTURES if n in needed)
    return f"WITH {head}\n{sql}" if head else sql


# -- building blocks ------------------------------------------------------------------------

RANGE = "BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"
SPOT_RANGE = f"Fecha {RANGE} AND Industria IN ('BUILDING','MACHINERY') AND TipoMedio IN ('R','A')"
PRINT_RANGE = f"Fecha {RANGE} AND Sector IN ('BUILDING','MACHINERY')"
TOTALS_RANGE = f"FechaInicio {RANGE} AND Segmento IN ('R','A')"


def _money(column: str) -> str:
    return f"CAST(COALESCE(SUM(CAST({column} AS DECIMAL(18,2))), 0) AS DOUBLE)"


def _fold(c: str) -> str:
    return f"regexp_replace(upper(strip_accents(replace({c}, 'ß', 'ss'))), '[^\\x20-\\x7E\\n]', '', 'g')"


def _strip(c: str) -> str:
    return f"trim({c}, '{WHITESPACE}')"


def _live_label(c: str, width: int) -> str:
    folded = _fold(f"trim(substr({c}, 1, {width}))")
    return f"CASE WHEN {c} IS NULL OR trim({folded}) = '' THEN 'N.A.' ELSE {folded} END"


def _guarded(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} IN ('N.A.', 'nan', 'None', '') THEN {c} ELSE {_fold(c)} END"


def _batch_label(c: str, width: int) -> str:
    folded = _guarded(_strip(c))
    return (
        f"substr(CASE WHEN {c} IS NULL OR ({folded}) IN ('nan', 'None', '') THEN 'N.A.' "
        f"ELSE {folded} END, 1, {width})"
    )


def _long_text(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {_strip(c)} IN ('nan', 'None', '') THEN 'N.A.' ELSE {_strip(c)} END"


FEED_DATE = (
    "CAST(CASE WHEN contains(Fecha, 'T') THEN try_strptime(substr(Fecha, 1, 10), '%Y-%m-%d') "
    "ELSE try_strptime(Fecha, '%Y%m%d') END AS DATE)"
)
ANY_DATE = (
    "CAST(coalesce(try_strptime(substr(Fecha, 1, 10), '%Y-%m-%d'), "
    "try_strptime(Fecha, ['%Y%m%d', '%Y-%m-%d', '%Y-%m-%dT%H:%M:%S', '%Y/%m/%d', '%d/%m/%Y', '%d-%m-%Y'])) AS DATE)"
)
KEY = "TRY_CAST(IdDeteccion AS BIGINT)"
AMOUNT = "TRY_CAST(Tarifa AS DOUBLE)"


def _stats(table: str, medium: str | None, where: str = "") -> str:
    if medium == "impresos":
        columns = f"""COUNT(DISTINCT Fecha) AS unique_dates, COUNT(DISTINCT IdFuente) AS unique_sources,
       COUNT(DISTINCT Marca) AS unique_brands, COUNT(DISTINCT Anunciante) AS unique_advertisers,
       MIN(Fecha) AS first_date, MAX(Fecha) AS last_date, {_money('Costo')} AS total_costo"""
        return f"SELECT 'impresos' AS tipo, COUNT(*) AS total_records, {columns} FROM {table} {where}"
    return f"""SELECT '{medium}' AS tipo, COUNT(*) AS total_records, COUNT(DISTINCT Fecha) AS unique_dates,
       COUNT(DISTINCT IdCanal) AS unique_channels, COUNT(DISTINCT IdMarca) AS unique_brands,
       COUNT(DISTINCT IdAnunciante) AS unique_advertisers, MIN(Fecha) AS first_date, MAX(Fecha) AS last_date,
       {_money('Tarifa')} AS total_tarifa FROM {table} WHERE tipo = '{medium}'"""


def _status(medium: str) -> str:
    if medium == "impresos":
        source, where, last = "fx_print", PRINT_RANGE, f"""COUNT(DISTINCT IdFuente) AS unique_sources,
       COUNT(DISTINCT Marca) AS unique_brands, COUNT(DISTINCT Anunciante) AS unique_advertisers,
       {_money('Costo')} AS total_costo"""
    else:
        source, where, last = "fx_spots", f"tipo = '{medium}' AND {SPOT_RANGE}", f"""
       COUNT(DISTINCT IdCanal) AS unique_channels, COUNT(DISTINCT IdMarca) AS unique_brands,
       COUNT(DISTINCT IdAnunciante) AS unique_advertisers, {_money('Tarifa')} AS total_tarifa"""
    return f"""SELECT DATE '1996-01-01' AS fecha_inicio, DATE '1997-12-31' AS fecha_fin,
       731 AS total_dates_in_range, COUNT(*) > 0 AS data_exists, COUNT(*) AS total_records,
       COUNT(DISTINCT Fecha) AS unique_dates, {last} FROM {source} WHERE {where}"""


_LOADED = """COUNT(*) AS total_records, COUNT(DISTINCT IdCanal) AS unique_channels,
       COUNT(DISTINCT IdMarca) AS unique_brands, COUNT(DISTINCT IdAnunciante) AS unique_advertisers"""


def _named(column: str) -> str:
    return f"{column} IS NOT NULL AND {column} NOT IN ('N.A.', '')"


def _top(source: str, keys: dict[str, str], where: str, spend: str | None, hits: str | None = None,
         rows: str = "registros") -> str:
    select = ", ".join(f"{c} AS {n}" for n, c in keys.items())
    group = ", ".join(keys.values())
    metrics = [f"COUNT(*) AS {rows}"]
    if spend:
        metrics.append(f"{_money(spend)} AS total_inversion")
    if hits:
        metrics.append(f"COALESCE(SUM({hits}), 0) AS total_hits")
    order = ("total_inversion" if spend else rows) + " DESC, " + ", ".join(f"{n} ASC NULLS LAST" for n in keys)
    return f"SELECT {select}, {', '.join(metrics)} FROM {source} WHERE {where} GROUP BY {group} ORDER BY {order} LIMIT 10"


BRAND_KEYS = {"anunciante": "Anunciante", "marca": "Marca"}


def _brands(medium: str, where: str = "TRUE", named_advertiser: bool = False) -> str:
    source, spend = ("fx_print", "Costo") if medium == "impresos" else ("fx_spots", "Tarifa")
    tests = [_named("Marca"), f"({where})"]
    if medium != "impresos":
        tests.append(f"tipo = '{medium}'")
    if named_advertiser:
        tests.append(_named("Anunciante"))
    return _top(source, BRAND_KEYS, " AND ".join(tests), spend)


def _sectors(medium: str, where: str = "TRUE") -> str:
    if medium == "impresos":
        return _top("fx_print", {"sector": "Sector"}, f"{_named('Sector')} AND ({where})", "Costo")
    return _top("fx_spots", {"sector": "Industria"}, f"{_named('Industria')} AND tipo = '{medium}' AND ({where})", "Tarifa")


def _totals_top(keys: dict[str, str], where: str = "TRUE") -> str:
    last = list(keys.values())[-1]
    return _top("fx_totals", keys, f"{_named(last)} AND ({where})", "TotalInversion", "TotalHit")


def _per_medium(keys: list[str]) -> str:
    shown = _named(keys[-1])
    if "advertiser" in keys:
        shown += f" AND (medium <> 'impresos' OR ({_named('advertiser')}))"
    names = ", ".join(keys)
    order = ", ".join(f"{k} ASC NULLS LAST" for k in keys)
    return f"""SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY medium ORDER BY total_inversion DESC, {order}) AS rank FROM (
    SELECT medium, {names}, COUNT(*) AS registros, {_money('spend')} AS total_inversion
    FROM fx_media WHERE {shown} GROUP BY medium, {names}) g) r
WHERE rank <= 10"""


# -- column lists of the projections, with the type names the report shows -------------------

SPOT_TYPES = {
    "tipo": "string", "Fecha": "date", "IdLocalidad": "int", "Localidad": "string", "IdMedio": "int",
    "Medio": "string", "TipoMedio": "string", "IdCanal": "int", "Canal": "string", "IdMarca": "int",
    "Marca": "string", "Submarca": "string", "Producto": "string", "IdVersion": "bigint", "Version": "string",
    "DReal": "int", "DTeorica": "int", "NoCorte": "int", "IdAnunciante": "bigint", "Anunciante": "string",
    "Industria": "string", "IdDeteccion": "bigint", "Tarifa": "double",
}
PRINT_TYPES = {
    "id": "bigint", "Fecha": "date", "IdMedio": "int", "Medio": "string", "IdFuente": "int", "Fuente": "string",
    "Seccion": "string", "Pagina": "string", "Tiraje": "bigint", "Costo": "double", "Anunciante": "string",
    "Marca": "string", "Sector": "string", "Categoria": "string", "Dimension": "double",
}


def _report(source: str, types: dict[str, str]) -> str:
    def line(name: str, kind: str) -> str:
        unique = "CAST(NULL AS BIGINT)"
        if name in ("IdPlaza", "IdMedio", "IdCanal", "IdMarca"):
            unique = f"COUNT(DISTINCT {name}) + MAX(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END)"
        return (
            f"SELECT '{name}' AS column_name, '{kind}' AS data_type, COUNT(*) AS total_records, "
            f"{len(types)} AS columns, COUNT(*) FILTER (WHERE {name} IS NULL) AS null_count, "
            f"{unique} AS unique_count FROM {source}"
        )

    return "\nUNION ALL\n".join(line(n, k) for n, k in types.items())


def _bad_text(c: str, words: bool = True) -> str:
    test = f"{c} IS NULL OR trim({c}) = ''"
    return f"({test} OR {c} IN ('nan', 'None', 'N/A', 'null'))" if words else f"({test})"


def _fixed(c: str, words: bool = True) -> str:
    return f"CASE WHEN {_bad_text(c, words)} THEN 'N.A.' ELSE {c} END AS {c}"


def _cells(table: str, source: str, column: str, test: str) -> str:
    return f"SELECT '{table}' AS \"table\", '{column}' AS column_name, COUNT(*) FILTER (WHERE {test}) AS cells FROM {source}"


def _shown(name: str, kind: str) -> str:
    if kind == "double":
        return f"coalesce(CAST(CAST({name} AS DECIMAL(18,2)) AS VARCHAR), '') AS {name}"
    if kind == "date":
        return f"coalesce(strftime({name}, '%Y-%m-%d'), '') AS {name}"
    return f"coalesce(CAST({name} AS VARCHAR), '') AS {name}"


def _records_page(where: str = f"tipo = 'tv' AND Fecha {RANGE}", offset: int = 50, names: tuple = ()) -> str:
    names = names or [n for n in display_columns(list(SPOT_TYPES)) if n != "tipo"]
    order = ", ".join(f"{n} ASC NULLS LAST" for n in names)
    total = f"(SELECT COUNT(*) FROM fx_spots WHERE {where})"
    shown = ", ".join(_shown(n, SPOT_TYPES[n]) for n in names)
    return f"""SELECT {shown}, {total} AS total, CAST(ceil({total} / 25.0) AS BIGINT) AS total_pages
FROM (SELECT * FROM fx_spots WHERE {where} ORDER BY {order} LIMIT 25 OFFSET {offset}) p"""


_PRINT_SHOWN = (
        "id, coalesce(Fuente, '') AS Fuente, coalesce(Medio, '') AS Medio, coalesce(Anunciante, '') AS Anunciante, "
        "coalesce(Marca, '') AS Marca, coalesce(Sector, '') AS Sector, coalesce(Categoria, '') AS Categoria, "
        "strftime(Fecha, '%Y-%m-%d') AS Fecha, coalesce(Costo, 0) AS Costo, coalesce(Tiraje, 0) AS Tiraje, "
        "coalesce(Dimension, 0) AS Dimension"
)


def _page(source: str, where: str, order: str, columns: str = "*", offset: int = 50) -> str:
    total = f"(SELECT COUNT(*) FROM {source} WHERE {where})"
    return f"""SELECT {columns}, {total} AS total, CAST(ceil({total} / 25.0) AS BIGINT) AS total_pages
FROM (SELECT * FROM {source} WHERE {where} ORDER BY {order} LIMIT 25 OFFSET {offset}) p"""


def _suggest(parts: list[tuple[str, str, str]]) -> str:
    """``parts``: source, column, condition."""
    union = " UNION ALL ".join(f"SELECT {c} AS v FROM {s} WHERE {_named(c)} AND {w}" for s, c, w in parts)
    return (
        f"SELECT DISTINCT {_strip('v')} AS value FROM ({union}) u "
        f"WHERE {_strip('v')} NOT IN ('N.A.', 'n.a.', '') ORDER BY value LIMIT 10"
    )


def _matrix() -> str:
    values = {
        "anunciante": ["Customer#000000001", "Customer#000000002"],
        "marca": ["Brand#11", "Brand#12", "Brand#23"],
        "medio": ["ASIA", "EUROPE"],
        "tipo_medio": ["R", "A"],
        "localidad": ["FRANCE", "GERMANY"],
        "categoria": ["1-URGENT", "2-HIGH"],
        "fuente": ["FRANCE", "GERMANY"],
        "sector": ["BUILDING", "MACHINERY"],
        "sector_industria": ["BUILDING", "MACHINERY"],
        "industria": ["BUILDING", "MACHINERY"],
    }
    spot = {"anunciante": "Anunciante", "marca": "Marca", "medio": "Medio", "tipo_medio": "TipoMedio",
            "localidad": "Localidad", "sector_industria": "Industria", "industria": "Industria", "categoria": "-"}
    paper = {"anunciante": "Anunciante", "marca": "Marca", "medio": "Medio", "categoria": "Categoria",
             "fuente": "Fuente", "sector": "Sector", "sector_industria": "Sector"}
    lines = []
    for medium, source, columns, base in (
        ("tv", "fx_spots", spot, "tipo = 'tv'"), ("radio", "fx_spots", spot, "tipo = 'radio'"),
        ("impresos", "fx_print", paper, "TRUE"),
    ):
        for name, wanted in values.items():
            column = columns.get(name)
            listed = ", ".join(f"'{w}'" for w in wanted)
            test = "TRUE" if column is None else "FALSE" if column == "-" else f"{column} IN ({listed})"
            lines.append(f"SELECT '{medium}' AS medium, '{name}' AS filter, "
                         f"COUNT(*) FILTER (WHERE {test}) AS rows FROM {source} WHERE {base}")
    return "\nUNION ALL\n".join(lines)


def _label_values() -> str:
    spot = ["Anunciante", "Industria", "Localidad", "Marca", "Medio", "Submarca", "TipoMedio"]
    paper = ["Anunciante", "Categoria", "Fuente", "Marca", "Medio", "Sector"]
    lines = [f"SELECT DISTINCT '{m}' AS medium, '{c}' AS \"column\", {c} AS value FROM fx_spots "
             f"WHERE tipo = '{m}' AND {_named(c)}" for m in ("tv", "radio") for c in spot]
    lines += [f"SELECT DISTINCT 'impresos' AS medium, '{c}' AS \"column\", {c} AS value FROM fx_print WHERE {_named(c)}"
              for c in paper]
    return "\nUNION ALL\n".join(lines)


_LATEST_KEYS = """SELECT event_type, aggregate_type, aggregate_id, status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type, aggregate_type, aggregate_id
                               ORDER BY occurred_at DESC, id DESC) AS n FROM fx_events) e WHERE n = 1"""
_YEARS = """SELECT tipo, CAST(unnest(generate_series(CAST(date_trunc('year', MIN(Fecha)) AS TIMESTAMP),
              CAST(make_date(year(MAX(Fecha)), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS Fecha
              FROM fx_spots GROUP BY tipo"""
_CLEAN_LIVE = f"""SELECT doc_id, {FEED_DATE} AS Fecha, {_live_label('Medio', 255)} AS Medio,
       {_live_label('Marca', 255)} AS Marca, coalesce({KEY}, 0) AS IdDeteccion,
       coalesce({AMOUNT}, 0.0) AS Tarifa, 'N.A.' AS Subtitulo
FROM fx_raw WHERE {FEED_DATE} IS NOT NULL AND IdDeteccion IS NOT NULL"""


def _clean_batch(tarifa: str) -> str:
    return f"""SELECT doc_id, {ANY_DATE} AS Fecha, {_batch_label('Medio', 255)} AS Medio,
       {_batch_label('Marca', 255)} AS Marca, {KEY} AS IdDeteccion, {tarifa} AS Tarifa
FROM fx_raw WHERE {ANY_DATE} IS NOT NULL AND {KEY} IS NOT NULL"""


def _catalogue(columns: str, source: str) -> str:
    return f"SELECT {columns}, 'N.A.' AS Testigo FROM {source} WHERE IdMaster IS NOT NULL"


_CATALOGUE_TEXT = ", ".join(f"{_batch_label(c, 255)} AS {c}" for c in ("TipoMaster", "Anunciante", "Marca", "Industria"))

def _media_summary(where: str = "TRUE") -> str:
    return f"""SELECT medium, COUNT(*) AS total_records, COUNT(DISTINCT day) AS unique_dates,
       COUNT(DISTINCT outlet) AS unique_outlets, COUNT(DISTINCT brand_key) AS unique_brands,
       COUNT(DISTINCT advertiser_key) AS unique_advertisers, MIN(day) AS first_date, MAX(day) AS last_date,
       {_money('spend')} AS total_spend, 'disponible' AS status FROM fx_media
WHERE {where} GROUP BY medium"""


_SQL = {
    # sources and sinks
    "raw_range": f"""SELECT doc_id, day, COUNT(*) OVER () AS total
FROM (SELECT doc_id, {ANY_DATE} AS day FROM fx_raw) d WHERE day BETWEEN DATE '2026-01-05' AND DATE '2026-01-20'""",
    "raw_union": """SELECT doc_id, Fecha, Medio, CASE WHEN Medio = 'en' THEN Tarifa END AS Tarifa FROM fx_raw""",
    "path_parts": "SELECT * FROM fx_paths",
    "notifications": "SELECT event_id, object_key, medium, day FROM fx_paths WHERE outcome = 'ok'",
    "replace_day": """SELECT Fecha, IdDeteccion, IdVersion, IdCanal, DReal, Tarifa FROM fx_spots
WHERE tipo = 'tv' AND NOT (Fecha = DATE '1996-06-15')
UNION ALL
SELECT Fecha, IdDeteccion, IdVersion, IdCanal, DReal, Tarifa * 2 FROM fx_spots
WHERE tipo = 'tv' AND Fecha = DATE '1996-06-15'""",
    "delete_range": f"""SELECT Fecha, IdDeteccion, IdVersion, IdCanal, Tarifa FROM fx_spots
WHERE tipo = 'tv' AND NOT (Fecha {RANGE})""",
    "export_spots": f"""SELECT Fecha, Canal, Marca, Anunciante, Tarifa, 1 AS Ins,
       COUNT(*) OVER () AS total_available, COUNT(*) OVER () > 1000000 AS truncated
FROM fx_spots WHERE tipo = 'tv' AND {SPOT_RANGE}""",
    # text, dates and numbers
    "clean_dates": f"SELECT doc_id, {FEED_DATE} AS day FROM fx_raw",
    "clean_dates_multi": f"SELECT doc_id, {ANY_DATE} AS day FROM fx_raw",
    "short_date": """SELECT doc_id, CASE WHEN length(Fecha) >= 8 THEN
       CASE WHEN contains(Fecha, 'T') THEN substr(Fecha, 1, 10) ELSE Fecha END END AS day_text FROM fx_raw""",
    "slice_date": """SELECT doc_id, CASE WHEN length(Fecha) >= 10 THEN CAST(try_strptime(
       substr(Fecha, 1, 4) || '-' || substr(Fecha, 6, 2) || '-' || substr(Fecha, 9, 2), '%Y-%m-%d') AS DATE) END AS day
FROM fx_raw""",
    "valid_day": """SELECT doc_id, regexp_full_match(Fecha, '[0-9]{8}')
       AND try_strptime(Fecha, '%Y%m%d') IS NOT NULL AS valid FROM fx_raw""",
    "normalize_text": f"SELECT doc_id, {_fold('text')} AS folded FROM documents",
    "clean_labels": f"""SELECT doc_id, {_live_label('Marca', 255)} AS live, {_live_label('Marca', 128)} AS live_print,
       {_batch_label('Marca', 255)} AS batch, {_guarded('Marca')} AS guarded FROM fx_raw""",
    "clean_long_text": f"SELECT doc_id, {_long_text('text')} AS text FROM documents",
    "clean_clock": f"SELECT doc_id, substr({_strip('Marca')}, 1, 50) AS clock FROM fx_raw",
    "clean_numbers": f"""SELECT doc_id, coalesce({KEY}, 0) AS key_or_zero, {KEY} AS key_or_null,
       coalesce(TRY_CAST(Tarifa AS INT), 0) AS whole_amount, coalesce({AMOUNT}, 0.0) AS amount_or_zero,
       {AMOUNT} AS amount_or_null FROM fx_raw""",
    "parse_list": """SELECT c_custkey, item FROM (
  SELECT c_custkey, trim(unnest(string_split(r_name || ' , ' || n_name || ',,' || c_name, ','))) AS item
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) p
WHERE item <> ''""",
    "audit_text": """SELECT n_name,
       'SELECT * FROM spots WHERE Fecha BETWEEN ''1996-01-01'' AND ''1997-12-31'' AND Localidad IN (''' || n_name
       || ''') AND Industria IN (' || array_to_string(list_transform(segments[1:3], lambda s: '''' || s || ''''), ', ')
       || CASE WHEN len(segments) > 3 THEN ', ... (' || len(segments) || ' total)' ELSE '' END
       || ') -- ' || rows || ' rows' AS sql_command
FROM (SELECT n_name, list_sort(list(DISTINCT c_mktsegment)) AS segments, COUNT(*) AS rows
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name) g""",
    "date_spine": """SELECT tipo, CAST(unnest(generate_series(CAST(MIN(Fecha) AS TIMESTAMP), CAST(MAX(Fecha) AS TIMESTAMP),
       INTERVAL 1 DAY)) AS DATE) AS day FROM fx_spots GROUP BY tipo""",
    # cleaning pipelines
    "clean_raw": _CLEAN_LIVE,
    "clean_print": f"""SELECT doc_id, {FEED_DATE} AS Fecha, coalesce(TRY_CAST(IdDeteccion AS INT), 0) AS IdMedio,
       {_live_label('Medio', 128)} AS Medio, {_live_label('Marca', 128)} AS Marca, coalesce({AMOUNT}, 0.0) AS Costo
FROM fx_raw WHERE {FEED_DATE} IS NOT NULL AND IdDeteccion IS NOT NULL""",
    "clean_batch_tv": _clean_batch(AMOUNT),
    "clean_batch_radio": _clean_batch(f"coalesce({AMOUNT}, 0.0)"),
    "clean_batch_print": f"""SELECT doc_id, {ANY_DATE} AS Fecha, TRY_CAST(IdDeteccion AS INT) AS IdMedio,
       {_batch_label('Medio', 128)} AS Medio, {_batch_label('Marca', 128)} AS Marca,
       coalesce({AMOUNT}, 0.0) AS Costo, 'N.A.' AS Testigo, 'N.A.' AS TextoNota
FROM fx_raw WHERE {ANY_DATE} IS NOT NULL AND {KEY} IS NOT NULL""",
    "clean_library": _catalogue(
        f"IdMaster, {_long_text('Version')} AS Version, {_CATALOGUE_TEXT}, DTeorica", "fx_library"),
    "clean_totals": _catalogue(
        f"DATE '1996-01-01' AS FechaInicio, DATE '1997-12-31' AS FechaFin, IdMaster, {_long_text('Version')} AS Version, "
        f"{_CATALOGUE_TEXT}, {_batch_label('Medio', 255)} AS Medio, {_batch_label('Segmento', 255)} AS Segmento, "
        "TotalHit, TotalInversion", "fx_totals"),
    "valid_rows": f"""SELECT doc_id, {ANY_DATE} AS Fecha, {KEY} AS IdDeteccion FROM fx_raw
WHERE {ANY_DATE} IS NOT NULL AND {KEY} IS NOT NULL""",
    "reject_counts": f"""SELECT 'live' AS variant, outcome, COUNT(*) AS rows FROM (
  SELECT CASE WHEN {FEED_DATE} IS NULL THEN 'bad_date' WHEN IdDeteccion IS NULL THEN 'missing_key'
              ELSE 'accepted' END AS outcome FROM fx_raw) l GROUP BY outcome
UNION ALL
SELECT 'batch', outcome, COUNT(*) FROM (
  SELECT CASE WHEN {ANY_DATE} IS NULL THEN 'bad_date' WHEN {KEY} IS NULL THEN 'missing_key'
              ELSE 'accepted' END AS outcome FROM fx_raw) b GROUP BY outcome""",
    # filters
    "filter_matrix": _matrix(),
    "inapplicable_filter": f"""SELECT 'tv' AS medium, FALSE AS data_exists, COUNT(*) AS total_records,
       COUNT(DISTINCT Fecha) AS unique_dates FROM fx_spots WHERE tipo = 'tv' AND FALSE
UNION ALL
SELECT 'impresos', COUNT(*) > 0, COUNT(*), COUNT(DISTINCT Fecha) FROM fx_print WHERE Fecha {RANGE}""",
    "inapplicable_ranking": _brands("impresos", f"Fecha {RANGE}"),
    "library_search": """SELECT IdMaster, Version FROM fx_library
WHERE Version ILIKE '%blue%' AND TipoMaster = 'AUDIO'""",
    "library_search_literal": "SELECT IdMaster, Version FROM fx_library WHERE contains(lower(Version), 'brand#1')",
    "totals_search": f"""SELECT COUNT(*) AS total_records, {_money('TotalInversion')} AS total_inversion FROM fx_totals
WHERE FechaInicio >= DATE '1996-01-01' AND FechaFin <= DATE '1997-12-31' AND Version ILIKE '%brand#_2%'""",
    # access
    "sector_media": """SELECT id, name, CASE WHEN contains(lower(name), 'television') THEN 'tv'
       WHEN contains(lower(name), 'radio') THEN 'radio' WHEN contains(lower(name), 'prensa') THEN 'impresos'
       WHEN contains(lower(name), 'revista') THEN 'impresos' END AS medium FROM fx_sectors""",
    "account_media": "SELECT id_account, array_to_string(media, ',') AS media FROM fx_grants",
    "allowed_rows": """SELECT id_account, COUNT(*) AS media_allowed, COALESCE(SUM(rows), 0) AS visible_rows
FROM (SELECT id_account, unnest(media) AS medium FROM fx_grants) g
LEFT JOIN (SELECT medium, COUNT(*) AS rows FROM fx_media GROUP BY medium) c USING (medium)
GROUP BY id_account""",
    # statistics
    "tv_stats": _stats("fx_spots", "tv"),
    "radio_stats": _stats("fx_spots", "radio"),
    "print_stats": _stats("fx_print", "impresos"),
    "status_range_tv": _status("tv"),
    "status_range_radio": _status("radio"),
    "status_range_print": _status("impresos"),
    "load_status_day": f"""SELECT DATE '1996-06-15' AS fecha, {_LOADED}, COUNT(*) > 0 AS data_exists
FROM fx_spots WHERE tipo = 'tv' AND Fecha = DATE '1996-06-15'""",
    "load_status_day_print": """SELECT DATE '1996-06-15' AS fecha, COUNT(*) AS total_records,
       COUNT(DISTINCT IdFuente) AS unique_sources, COUNT(DISTINCT Marca) AS unique_brands,
       COUNT(DISTINCT Anunciante) AS unique_advertisers, COUNT(*) > 0 AS data_exists
FROM fx_print WHERE Fecha = DATE '1996-06-15'""",
    "load_status_range": f"""SELECT CAST(s.d AS DATE) AS fecha, coalesce(total_records, 0) AS total_records,
       coalesce(unique_channels, 0) AS unique_channels, coalesce(unique_brands, 0) AS unique_brands,
       coalesce(unique_advertisers, 0) AS unique_advertisers, coalesce(total_records, 0) > 0 AS data_exists
FROM (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1997-12-31', INTERVAL 1 DAY)) AS d) s
LEFT JOIN (SELECT Fecha, {_LOADED} FROM fx_spots WHERE tipo = 'tv' GROUP BY Fecha) c ON c.Fecha = CAST(s.d AS DATE)""",
    "load_status_span": f"""SELECT DATE '1996-01-01' AS fecha_inicio, DATE '1997-12-31' AS fecha_fin, {_LOADED},
       COUNT(DISTINCT Fecha) AS unique_dates, COUNT(*) > 0 AS data_exists
FROM fx_spots WHERE tipo = 'tv' AND Fecha {RANGE}""",
    "library_stats": """SELECT COUNT(*) AS total_records, COUNT(DISTINCT IdMaster) AS unique_masters,
       COUNT(DISTINCT TipoMaster) AS unique_types, COUNT(DISTINCT Anunciante) AS unique_advertisers,
       COUNT(DISTINCT Marca) AS unique_brands, COUNT(DISTINCT Industria) AS unique_industries FROM fx_library""",
    "totals_stats": f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT IdMaster) AS unique_masters,
       COUNT(DISTINCT Medio) AS unique_medios, COUNT(DISTINCT Marca) AS unique_brands,
       COUNT(DISTINCT Anunciante) AS unique_advertisers, MIN(FechaInicio) AS first_date, MAX(FechaFin) AS last_date,
       {_money('TotalInversion')} AS total_inversion FROM fx_totals""",
    "totals_status_range": f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT IdMaster) AS unique_masters,
       COUNT(DISTINCT Medio) AS unique_medios, COUNT(DISTINCT Marca) AS unique_brands,
       COUNT(DISTINCT Anunciante) AS unique_advertisers, {_money('TotalInversion')} AS total_inversion,
       COALESCE(SUM(TotalHit), 0) AS total_hits, COUNT(*) > 0 AS data_exists FROM fx_totals WHERE {TOTALS_RANGE}""",
    "days_to_load": f"""SELECT tipo, Fecha FROM ({_YEARS}) s
WHERE NOT EXISTS (SELECT 1 FROM fx_spots f WHERE f.tipo = s.tipo AND f.Fecha = s.Fecha)""",
    "load_report": f"""SELECT s.tipo, s.Fecha, CASE WHEN n > 0 THEN 'skipped' ELSE 'accepted' END AS status,
       coalesce(n, 0) AS records FROM ({_YEARS}) s
LEFT JOIN (SELECT tipo, Fecha, COUNT(*) AS n FROM fx_spots GROUP BY tipo, Fecha) c
ON c.tipo = s.tipo AND c.Fecha = s.Fecha""",
    "totals_records_summary": f"""SELECT COUNT(*) AS total_records, {_money('TotalInversion')} AS total_inversion
FROM fx_totals WHERE FechaInicio >= DATE '1996-01-01' AND FechaFin <= DATE '1997-12-31'
AND TipoMaster = 'AUDIOVISUAL'""",
    "print_summary": f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT Fecha) AS unique_dates,
       MIN(Fecha) AS first_date, MAX(Fecha) AS last_date, {_money('Costo')} AS total_costo,
       CASE WHEN COUNT(Costo) > 0 THEN {_money('Costo')} / COUNT(Costo) ELSE 0.0 END AS avg_costo
FROM fx_print WHERE Fecha {RANGE}""",
    "print_media_breakdown": f"""SELECT coalesce(nullif(Medio, ''), 'N/A') AS medio, COUNT(*) AS count
FROM fx_print WHERE Fecha {RANGE} GROUP BY Medio ORDER BY count DESC, Medio ASC NULLS LAST LIMIT 10""",
    "media_summary": _media_summary(),
    "media_summary_sets": _media_summary(),
    "media_summary_range": _media_summary(f"day {RANGE}"),
    "media_grand_total": f"""SELECT coalesce(medium, 'total') AS medium, COUNT(*) AS total_records,
       {_money('spend')} AS total_spend FROM fx_media GROUP BY ROLLUP (medium)""",
    "media_top_brands": _per_medium(["advertiser", "brand"]),
    "media_top_sectors": _per_medium(["sector"]),
    "rollup_media_totals": f"""SELECT medium, COUNT(*) AS total_records, COUNT(DISTINCT day) AS unique_dates,
       MIN(day) AS first_date, MAX(day) AS last_date, {_money('spend')} AS total_spend FROM fx_media GROUP BY medium""",
    "rollup_top_brands": _brands("tv"),
    # rankings
    "top_brands": _brands("tv"),
    "top_brands_radio": _brands("radio"),
    "top_brands_print": _brands("impresos"),
    "top_brands_print_named": _brands("impresos", named_advertiser=True),
    "top_brands_range": _brands("tv", SPOT_RANGE),
    "top_brands_print_range": _brands("impresos", PRINT_RANGE),
    "top_sectors": _sectors("tv"),
    "top_sectors_radio": _sectors("radio"),
    "top_sectors_print": _sectors("impresos"),
    "top_sectors_range": _sectors("tv", f"Fecha {RANGE} AND TipoMedio IN ('R','A')"),
    "top_sectors_print_range": _sectors("impresos", f"Fecha {RANGE} AND Categoria IN ('1-URGENT','2-HIGH')"),
    "library_top_advertisers": _top("fx_library", BRAND_KEYS, _named("Anunciante"), None, rows="versiones"),
    "library_top_industries": _top("fx_library", {"industria": "Industria"}, _named("Industria"), None, rows="versiones"),
    "totals_top_brands": _totals_top(BRAND_KEYS),
    "totals_top_industries": _totals_top({"industria": "Industria"}),
    "totals_top_media": _totals_top({"medio": "Medio"}),
    "totals_top_brands_range": _totals_top(BRAND_KEYS, TOTALS_RANGE),
    "totals_top_industries_range": _totals_top({"industria": "Industria"}, TOTALS_RANGE),
    # quality
    "quality_report": _report("fx_spots", SPOT_TYPES),
    "quality_report_print": _report("fx_print", PRINT_TYPES),
    "repair_nulls": f"""SELECT IdDeteccion, IdVersion, {_fixed('Marca')}, {_fixed('Anunciante')}, {_fixed('Industria')},
       coalesce(Tarifa, 0.0) AS Tarifa FROM fx_spots""",
    "repair_nulls_print": f"""SELECT id, {_fixed('Medio', False)}, {_fixed('Marca', False)}, {_fixed('Sector', False)},
       coalesce(Costo, 0.0) AS Costo FROM fx_print""",
    "repair_counts": "\nUNION ALL\n".join(
        [_cells("spots", "fx_spots", c, _bad_text(c)) for c in ("Marca", "Anunciante", "Industria")]
        + [_cells("spots", "fx_spots", "Tarifa", "Tarifa IS NULL")]
        + [_cells("print_ads", "fx_print", c, _bad_text(c, False)) for c in ("Medio", "Marca", "Sector")]
        + [_cells("print_ads", "fx_print", "Costo", "Costo IS NULL")]
    ),
    # pages
    "records_page": _records_page(),
    "records_keyset": """SELECT Fecha, IdDeteccion, IdVersion, IdCanal, Marca, Tarifa FROM fx_spots
WHERE tipo = 'tv' AND (Fecha > DATE '1996-06-15' OR (Fecha = DATE '1996-06-15' AND IdDeteccion >= 0))
ORDER BY Fecha, IdDeteccion, IdVersion, IdCanal, Marca ASC NULLS LAST, Tarifa ASC NULLS LAST LIMIT 25""",
    "print_page": _page("fx_print", f"Fecha {RANGE}", "Fecha DESC, id", _PRINT_SHOWN),
    "records_page_deep": _records_page("tipo = 'tv'", 1225, tuple(display_columns(list(SPOT_TYPES)))),
    "print_page_deep": _page("fx_print", "true", "Fecha DESC, id", _PRINT_SHOWN, 1225),
    "long_filter": """SELECT IdDeteccion, Anunciante, Fecha FROM fx_spots
WHERE tipo = 'radio' AND regexp_full_match(Anunciante, 'Customer#[0-9]{9}')
  AND CAST(substr(Anunciante, 10) AS INT) BETWEEN 1 AND 20000 AND CAST(substr(Anunciante, 10) AS INT) % 2 = 1""",
    "library_page": _page("fx_library", "TipoMaster = 'AUDIO'", "IdMaster"),
    "totals_page": _page(
        "fx_totals", "FechaInicio >= DATE '1996-01-01' AND FechaFin <= DATE '1997-12-31'",
        "FechaInicio DESC, IdMaster, FechaFin, Medio, TipoMaster, Version, Anunciante, Marca, Industria, Segmento, "
        "TotalHit, TotalInversion ASC NULLS LAST"),
    # suggestions
    "suggest_brand": _suggest([(s, "Marca", "Marca ILIKE '%brand#1%'") for s in ("fx_spots", "fx_print")]),
    "suggest_filtered": _suggest([("fx_spots", "Marca", f"Marca ILIKE '%brand#1%' AND {SPOT_RANGE}")]),
    "suggest_sector": _suggest([("fx_spots", "Industria", "TRUE"), ("fx_print", "Sector", "TRUE")]),
    "suggest_sector_filtered": _suggest([
        (s, c, f"{c} ILIKE '%bui%' AND Medio IN ('ASIA','EUROPE') AND Fecha {RANGE}")
        for s, c in (("fx_spots", "Industria"), ("fx_print", "Sector"))]),
    "suggest_industry": _suggest([("fx_spots", "Industria", "Industria ILIKE '%b%' AND Marca IN ('Brand#12')")]),
    "suggest_advertiser": _suggest([(s, "Anunciante", "Anunciante ILIKE '%customer%'") for s in ("fx_spots", "fx_print")]),
    "suggest_category": _suggest([("fx_print", "Categoria", "Medio IN ('ASIA','EUROPE')")]),
    "label_values": _label_values(),
    # event and run logs
    "events_list": """SELECT *, TRY_CAST(json_extract_string(payload, '$.k') AS INT) AS k FROM fx_events
WHERE aggregate_type = 'tv' AND event_type = 'DataIngested' ORDER BY occurred_at DESC, event_id LIMIT 100""",
    "events_pending": """SELECT * FROM fx_events WHERE status = 'PENDING'
""",
    "event_state": """SELECT event_id, status,
       CASE WHEN status <> 'PENDING' THEN occurred_at + INTERVAL 1 MINUTE END AS processed_at,
       CASE WHEN status <> 'PENDING' THEN consumer_id END AS consumer_id FROM fx_events""",
    "publish_events": f"""SELECT DISTINCT e.event_type, e.aggregate_type, e.aggregate_id FROM fx_events e
WHERE NOT EXISTS (SELECT 1 FROM ({_LATEST_KEYS}) l WHERE l.status = 'PENDING' AND l.event_type = e.event_type
                  AND l.aggregate_type = e.aggregate_type AND l.aggregate_id = e.aggregate_id)""",
    "published_events": """SELECT coalesce(open_id, sha256(concat_ws('|', event_type, aggregate_type, aggregate_id,
                                                          CAST(attempts + 1 AS VARCHAR)))) AS event_id,
       event_type, aggregate_type, aggregate_id, payload, open_id IS NOT NULL AS refreshed
FROM (SELECT event_type, aggregate_type, aggregate_id, COUNT(DISTINCT event_id) AS attempts,
             MAX(CASE WHEN status = 'PENDING' THEN event_id END) AS open_id, MAX(payload) AS payload
      FROM fx_events GROUP BY event_type, aggregate_type, aggregate_id) k""",
    "failure_counts": f"""SELECT medium, coalesce(failed, 0) AS failed_events, coalesce(rejected, 0) AS rejected_rows,
       coalesce(broken, 0) AS broken_files
FROM (SELECT aggregate_type AS medium, COUNT(*) AS failed FROM fx_events WHERE status = 'FAILED' GROUP BY 1) f
FULL JOIN (SELECT CASE doc_id % 3 WHEN 0 THEN 'tv' WHEN 1 THEN 'radio' ELSE 'impresos' END AS medium,
                  COUNT(*) AS rejected, COUNT(*) FILTER (WHERE Fecha = '') AS broken
           FROM fx_raw WHERE {FEED_DATE} IS NULL OR IdDeteccion IS NULL GROUP BY 1) r USING (medium)""",
    "replayable_events": """SELECT event_id, aggregate_type, aggregate_id, status FROM fx_events
WHERE event_type = 'DataIngested' AND status <> 'PROCESSED'""",
    "failed_by_medium": """SELECT coalesce(aggregate_type, 'total') AS medium,
       COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_events FROM fx_events GROUP BY ROLLUP (aggregate_type)""",
    "etl_log_current": """SELECT event_id AS log_id, aggregate_type AS source,
       TRY_CAST(json_extract_string(payload, '$.k') AS BIGINT) AS total_rows,
       CASE WHEN status = 'PROCESSED' THEN TRY_CAST(json_extract_string(payload, '$.k') AS BIGINT) ELSE 0 END AS total_records,
       CASE WHEN status = 'PROCESSED' THEN 'SUCCESS' ELSE 'RECORDING' END AS status FROM fx_events""",
    "run_summary": """SELECT medium, COUNT(*) AS total_dates, COUNT(*) FILTER (WHERE NOT failed) AS successful_dates,
       COUNT(*) FILTER (WHERE failed) AS failed_dates, SUM(extracted) AS total_extracted, SUM(loaded) AS total_loaded,
       CASE WHEN COUNT(*) FILTER (WHERE NOT failed) > 0 THEN 'success' ELSE 'error' END AS status_any,
       CASE WHEN COUNT(*) FILTER (WHERE failed) = 0 THEN 'success' WHEN SUM(loaded) = 0 THEN 'error'
            ELSE 'partial' END AS status_all
FROM (SELECT aggregate_type AS medium, aggregate_id, COUNT(*) AS extracted,
             COUNT(*) FILTER (WHERE status = 'PROCESSED') AS loaded,
             MAX(CASE WHEN n = 1 THEN status END) = 'FAILED' AS failed
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY aggregate_type, aggregate_id
                                         ORDER BY occurred_at DESC, id DESC) AS n FROM fx_events) r
      GROUP BY aggregate_type, aggregate_id) d
GROUP BY medium""",
    "audit_users": """SELECT e.id, e.consumer_id AS "user", coalesce(u.id_user, 0) AS id_user FROM fx_events e
LEFT JOIN (SELECT CASE r_regionkey % 2 WHEN 0 THEN 'worker-' ELSE 'worker ' END || r_regionkey AS name,
                  r_regionkey + 1 AS id_user FROM region) u ON u.name = e.consumer_id""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_fixtures(sql) for name, sql in _SQL.items()}
