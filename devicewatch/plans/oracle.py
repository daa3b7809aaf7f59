"""SQL answers of the registered queries, computed on the base tables.

The SQL never builds or parses the JSON the Spark side goes through, but for the raw-layer
queries, whose result is JSON text.
"""

from __future__ import annotations

from devicewatch.params import HIGH_RISK_KEYWORDS
from devicewatch.plans.feed import TEXT_KEYWORDS

# One row per submitted version, with the source's text values.
_SUB = """
sub AS (
  SELECT o.*, l.*, p_name, p_brand, p_type, p_size, s_name, n_name,
    l_orderkey IS NOT NULL AS has_line,
    CAST(o_orderkey AS VARCHAR) AS report_number,
    concat_ws('-', l_linenumber, l_partkey, l_suppkey, CAST(floor(l_quantity) AS BIGINT),
              CAST(floor(l_extendedprice * 100) AS BIGINT), l_returnflag, l_linestatus) AS line_key,
    CASE WHEN l_orderkey IS NULL THEN 'initial'
         WHEN l_linestatus = 'F' THEN CAST(l_partkey * 10 + l_linenumber AS VARCHAR)
         ELSE line_key END AS mdr_report_key,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN ''
         WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'
           THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%Y%m%d') END AS received_text,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN NULL
         ELSE CAST(o_orderdate AS DATE) END AS received,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS event_date,
    CAST(l_shipdate AS DATE) AS ship_date,
    CASE l_returnflag WHEN 'R' THEN 'Injury' WHEN 'A' THEN 'Malfunction' WHEN 'N' THEN 'Death'
         ELSE 'No answer provided' END AS kind,
    CASE WHEN l_quantity <= p_size THEN 'Y'
         WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN ''
         WHEN l_orderkey IS NOT NULL THEN 'N' END AS adverse,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Y' ELSE 'N' END AS problem,
    CASE l_linestatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS single_use,
    CASE l_linestatus WHEN 'F' THEN 'User Facility report'
         WHEN 'O' THEN 'Manufacturer report' END AS source_code,
    CASE WHEN l_orderkey IS NOT NULL
         THEN CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END END AS implant,
    CASE WHEN l_orderkey IS NULL THEN '[]' WHEN p_size <= 9 THEN '["1"]'
         WHEN p_size <= 25 THEN '["2"]' ELSE '["3"]' END AS class_text,
    CASE WHEN l_orderkey IS NULL OR p_size IS NULL THEN '[]'
         ELSE '["880.' || p_size || '"]' END AS regulation_text,
    coalesce('"' || p_type || '"', '[]') AS specialty_text,
    CASE WHEN l_orderkey IS NULL OR l_returnflag = 'N' THEN NULL
         WHEN l_linestatus = 'F' THEN
           [CAST(l_linenumber AS VARCHAR), CAST(CAST(floor(l_quantity / 5) AS BIGINT) AS VARCHAR)]
         ELSE [CAST(l_linenumber AS VARCHAR)] END AS codes,
    strftime(coalesce(l_shipdate, o_orderdate), '%Y-%m-%dT00:00:00Z') AS fetched
  FROM orders o LEFT JOIN lineitem l ON l_orderkey = o_orderkey
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
)"""

# Report keys that are numbers are ordered as numbers, before all others.
_NUMBER = "TRY_CAST(mdr_report_key AS DECIMAL(38, 0))"

_REP = _SUB + f""",
rep AS (
  SELECT * FROM (
    SELECT *, CAST(year(received) AS INTEGER) AS yr, CAST(month(received) AS INTEGER) AS mon,
      row_number() OVER (PARTITION BY report_number
                         ORDER BY fetched DESC, {_NUMBER} DESC NULLS LAST,
                           mdr_report_key DESC) AS version
    FROM sub) WHERE version = 1
)"""

_CODE_TEXT = """CASE WHEN codes IS NULL THEN '[]'
  ELSE '["' || array_to_string(codes, '","') || '"]' END"""

_EVENT_COLUMNS = f"""
  report_number, mdr_report_key, source_code AS report_source_code, received AS date_received,
  event_date AS date_of_event, ship_date AS date_report, kind AS event_type,
  adverse AS adverse_event_flag, problem AS product_problem_flag, single_use AS single_use_flag,
  s_name AS manufacturer_g_name, s_name AS manufacturer_name, n_name AS manufacturer_country,
  p_brand AS brand_name, p_type AS generic_name, p_name AS model_number,
  CAST(l_partkey AS VARCHAR) AS catalog_number, 'LOT-' || l_suppkey AS lot_number,
  implant AS implant_flag, specialty_text AS medical_specialty, class_text AS device_class,
  regulation_text AS regulation_number, {_CODE_TEXT} AS patient_outcome,
  fetched AS _ingested_at, yr AS year, mon AS month, adverse = 'Y' AS is_adverse_event,
  problem = 'Y' AS is_product_problem, implant = 'Y' AS is_implant"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _count_flag(flag: str) -> str:
    return (f"CAST(sum(CASE WHEN {flag} IS NULL THEN NULL WHEN {flag} = 'Y' THEN 1 ELSE 0 END)"
            " AS BIGINT)")


def _product_risk(source: str, tail: str = "") -> str:
    return f"""
SELECT *, CASE WHEN adverse_event_rate >= 50 THEN 'High' WHEN adverse_event_rate >= 20
  THEN 'Medium' ELSE 'Low' END AS risk_tier
FROM (
  SELECT *, round(adverse_events / NULLIF(total_reports, 0) * 100, 1) AS adverse_event_rate
  FROM (
    SELECT p_brand AS brand_name, p_type AS generic_name, class_text AS device_class,
      count(report_number) AS total_reports, {_count_flag('adverse')} AS adverse_events,
      {_count_flag('problem')} AS product_problems,
      count(DISTINCT report_number) AS unique_reports,
      min(received) AS first_report_date, max(received) AS last_report_date
    FROM {source} GROUP BY 1, 2, 3))
{tail}"""


def _event_summary(source: str) -> str:
    return f"""
SELECT yr AS year, mon AS month, kind AS event_type, count(report_number) AS report_count,
  {_count_flag('adverse')} AS adverse_event_count,
  {_count_flag('problem')} AS product_problem_count
FROM {source} GROUP BY 1, 2, 3"""


def _outcomes(source: str) -> str:
    """CTE: one row per report and outcome code, from rows of (report_number, yr, codes)."""
    return f""",
outcomes AS (
  SELECT *, CASE outcome_code WHEN '1' THEN 'Death' WHEN '2' THEN 'Life Threatening'
    WHEN '3' THEN 'Hospitalization' WHEN '4' THEN 'Disability' WHEN '5' THEN 'Congenital Anomaly'
    WHEN '6' THEN 'Required Intervention' WHEN '7' THEN 'Other'
    ELSE 'No Information' END AS outcome_label
  FROM (
    SELECT report_number, yr AS year, unnest(coalesce(codes, [NULL])) AS outcome_code
    FROM {source})
)"""


def _devices(source: str) -> str:
    """CTE: the device list of each version: the item and, for returned items, an accessory."""
    common = "report_number, fetched, mdr_report_key, p_brand, s_name, p_name, p_type"
    return f""",
dev AS (
  SELECT {common}, l_partkey, l_suppkey, implant, 0 AS pos, p_type AS generic,
    l_linenumber AS seq
  FROM {source}
  UNION ALL
  SELECT {common}, l_partkey, l_suppkey, implant, 1, 'ACCESSORY',
    CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE l_linenumber + 7 END
  FROM {source} WHERE l_returnflag = 'R'
)"""


_DEVICE_SELECT = f"""
SELECT report_number, p_brand AS brand_name, generic AS generic_name,
  s_name AS manufacturer_name, p_name AS model_number,
  CAST(l_partkey AS VARCHAR) AS catalog_number, 'LOT-' || l_suppkey AS lot_number,
  CAST(seq AS VARCHAR) AS device_sequence_no, implant AS implant_flag,
  substr(p_type, 1, 3) AS product_code, fetched AS _ingested_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY report_number, seq
                               ORDER BY fetched DESC, {_NUMBER} DESC NULLS LAST,
                                 mdr_report_key DESC, pos) AS rank
  FROM dev) WHERE rank = 1"""

_TEXTS = """
doc AS (
  SELECT doc_id, lang, text,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN NULL
         ELSE CAST(o_orderdate AS DATE) END AS received,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN ''
         WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'
           THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%Y%m%d') END AS received_text
  FROM documents LEFT JOIN orders ON o_orderkey = doc_id),
doc_block AS (
  SELECT doc_id, received, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i
  FROM doc),
turn AS (
  SELECT *, '2002-02-01T00:00:00Z' AS fetched,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS version
  FROM conversations),
narrative AS (
  SELECT CAST(doc_id AS VARCHAR) AS report_number, received AS date_received,
    CASE WHEN i = 0 THEN 'Description of Event or Problem'
         ELSE 'Additional Manufacturer Narrative' END AS text_type_code,
    line AS narrative_text, doc_id || '-' || i AS mdr_text_key,
    '2002-01-01T00:00:00Z' AS _ingested_at, 1 AS version
  FROM doc_block WHERE line <> ''
  UNION ALL
  SELECT 'C' || conv_id, NULL, role, text, conv_id || '-' || turn, fetched, version FROM turn
)"""

_NARRATIVE_COLUMNS = """report_number, date_received, text_type_code, narrative_text,
  mdr_text_key, _ingested_at"""


def _matched(text: str, keywords: tuple[str, ...]) -> str:
    hits = ", ".join(f"CASE WHEN contains(lower({text}), '{k.lower()}') THEN '{k}' END" for k in keywords)
    return f"concat_ws(', ', {hits})"


def _flagged(keywords: tuple[str, ...], latest_only: bool, tail: str = "") -> str:
    blocks = "(SELECT * FROM narrative WHERE version = 1)" if latest_only else "narrative"
    return _with(_REP + "," + _TEXTS, f"""
SELECT * FROM (
  SELECT n.report_number, r.received AS date_received, p_brand AS brand_name,
    p_type AS generic_name, kind AS event_type, text_type_code, narrative_text,
    {_matched('narrative_text', keywords)} AS matched_keywords
  FROM {blocks} n LEFT JOIN rep r ON r.report_number = n.report_number)
WHERE matched_keywords <> '' {tail}""")


_CLASSES = """'{"device_class":' || class_text || ',"regulation_number":' || regulation_text
  || ',"medical_specialty_description":"' || p_type || '"}'"""


def _device_json(generic: str, seq: str) -> str:
    return f"""'{{"manufacturer_d_name":"' || s_name || '","manufacturer_d_country":"' || n_name
  || '","brand_name":"' || p_brand || '","generic_name":"' || {generic}
  || '","model_number":"' || p_name || '","catalog_number":"' || l_partkey
  || '","lot_number":"LOT-' || l_suppkey || '","device_sequence_no":"' || {seq}
  || '","device_event_key":"' || line_key || '","implant_flag":"' || implant
  || '","device_report_product_code":"'
  || substr(p_type, 1, 3) || '"'
  || CASE WHEN l_linestatus = 'F' THEN ',"openfda":' || {_CLASSES} ELSE '' END || '}}'"""


_BRONZE = {
    "report_number": "report_number",
    "mdr_report_key": "mdr_report_key",
    "report_source_code": "source_code",
    "date_received": "received_text",
    "date_of_event": "CASE WHEN l_returnflag = 'N' THEN strftime(l_shipdate, '%Y%m')"
                     " ELSE strftime(l_shipdate, '%Y%m%d') END",
    "date_report": "strftime(l_shipdate, '%Y%m%d')",
    "event_type": "kind",
    "adverse_event_flag": "adverse",
    "product_problem_flag": "problem",
    "single_use_flag": "single_use",
    "manufacturer_g_name": "s_name",
    "manufacturer_name": "s_name",
    "manufacturer_country": "n_name",
    "brand_name": "p_brand",
    "generic_name": "p_type",
    "model_number": "p_name",
    "catalog_number": "CAST(l_partkey AS VARCHAR)",
    "lot_number": "'LOT-' || l_suppkey",
    "device_sequence_no": "CAST(l_linenumber AS VARCHAR)",
    "device_event_key": "CASE WHEN has_line THEN line_key END",
    "implant_flag": "implant",
    "product_code": "substr(p_type, 1, 3)",
    "device_class": "class_text",
    "regulation_number": "regulation_text",
    "medical_specialty": "specialty_text",
    "patient_outcome": _CODE_TEXT,
    "date_of_birth": "CASE WHEN codes IS NOT NULL THEN strftime(o_orderdate, '%Y') END",
    "mdr_text_raw": "'[]'",
    "device_raw": f"""CASE WHEN NOT has_line THEN '[]' ELSE '[' || {_device_json('p_type', 'l_linenumber')}
  || CASE WHEN l_returnflag = 'R' THEN ',' || {_device_json(
      "'ACCESSORY'",
      "CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE l_linenumber + 7 END")}
     ELSE '' END || ']' END""",
    "patient_raw": f"""CASE WHEN codes IS NULL THEN '[]' ELSE '[{{"sequence_number_outcome":'
  || {_CODE_TEXT} || ',"date_of_birth":"' || strftime(o_orderdate, '%Y') || '"}}]' END""",
    "_ingested_at": "fetched",
    "_manufacturer_filter": "'Supplier#00000000'",
    "_date_from": "'19960101'",
    "_date_to": "'19981231'",
    "_run_id": "'run_reports'",
    "_source_file": "CASE WHEN has_line THEN 'tables/lineitem' ELSE 'tables/orders' END",
}


def _bronze(wrap: str = "{}", skip: tuple[str, ...] = ()) -> str:
    columns = ",\n  ".join(f"{wrap.format(sql)} AS {name}"
                           for name, sql in _BRONZE.items() if name not in skip)
    return _with(_SUB, f"SELECT {columns} FROM sub")


# The blocks of a document are its lines, the block of a turn is the turn.
_TEXT_BRONZE = {
    "report_number": ("CAST(doc_id AS VARCHAR)", "'C' || conv_id"),
    "mdr_report_key": ("lang", "CAST(turn AS VARCHAR)"),
    "date_received": ("received_text", "NULL"),
    **{c: ("'[]'", "'[]'") for c in ("device_class", "regulation_number", "medical_specialty",
                                     "patient_outcome", "device_raw", "patient_raw")},
    "mdr_text_raw": ("blocks", """'[{"text_type_code":' || to_json(role) || ',"foi_text":'
  || to_json(text) || ',"mdr_text_key":"' || conv_id || '-' || turn || '"}]'"""),
    "_ingested_at": ("'2002-01-01T00:00:00Z'", "fetched"),
    "_manufacturer_filter": ("'Supplier#00000000'",) * 2,
    "_date_from": ("'19960101'",) * 2,
    "_date_to": ("'19981231'",) * 2,
    "_run_id": ("'run_texts'",) * 2,
}
_TEXT_ROWS = _TEXTS + """,
doc_text AS (
  SELECT doc_id, any_value(lang) AS lang, any_value(received_text) AS received_text,
    len(list(line)) AS n_blocks, '[' || string_agg('{"text_type_code":"'
    || CASE WHEN i = 0 THEN 'Description of Event or Problem'
            ELSE 'Additional Manufacturer Narrative' END || '"'
    || CASE WHEN line <> '' THEN ',"foi_text":' || to_json(line) ELSE '' END
    || ',"mdr_text_key":"' || doc_id || '-' || i || '"}', ',' ORDER BY i) || ']' AS blocks
  FROM (SELECT doc_id, lang, received_text, unnest(string_split(text, chr(10))) AS line,
          unnest(range(len(string_split(text, chr(10))))) AS i FROM doc)
  GROUP BY doc_id)"""


def _text_rows(more: tuple[str, str] = ("", ""), skip: tuple[str, ...] = ()) -> str:
    """Both kinds of text reports as raw rows, each with more columns."""
    selects = []
    for side, source in enumerate(("doc_text", "turn")):
        columns = ", ".join(
            f"CAST({_TEXT_BRONZE.get(c, ('NULL', 'NULL'))[side]} AS VARCHAR) AS {c}"
            for c in _BRONZE if c != "_source_file" and c not in skip)
        selects.append(f"SELECT {columns}{more[side]} FROM {source}")
    return " UNION ALL ".join(selects)


def _all_bronze(more: str = "", text_more: tuple[str, str] = ("", ""),
                skip: tuple[str, ...] = ()) -> str:
    columns = ", ".join(f"{sql} AS {name}" for name, sql in _BRONZE.items()
                        if name != "_source_file" and name not in skip)
    return _with(_SUB + "," + _TEXT_ROWS,
                 f"SELECT {columns}{more} FROM sub UNION ALL {_text_rows(text_more, skip)}")


# Any device of the version is made by the supplier of its line.
_SEARCH = """FROM sub WHERE received BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
  AND contains(lower(s_name), 'supplier#00000000')"""

_TOP_RISK = """ORDER BY total_reports DESC, brand_name NULLS FIRST, generic_name NULLS FIRST,
  device_class NULLS FIRST LIMIT 20"""
_TOP_FLAGGED = """ORDER BY date_received DESC NULLS LAST, report_number, text_type_code,
  md5(narrative_text) LIMIT 20"""

# A page holds the reports of two hundred consecutive numbers.
_RUN_FILES = _SUB + """,
record AS (
  SELECT 'run_reports' AS run_id, o_orderkey // 200 AS page, fetched FROM sub
  UNION ALL SELECT 'run_texts', doc_id // 200, '2002-01-01T00:00:00Z' FROM documents
  UNION ALL SELECT 'run_texts', conv_id // 200, '2002-02-01T00:00:00Z' FROM conversations
)"""

# Reports of both runs, as the events table sees them when the runs share one raw layer: a
# document's report is newer than any version of the order with its number.
_ALL_EVENTS = _REP + "," + _TEXTS + """,
ev AS (
  SELECT report_number, received, yr, mon, codes, kind, p_brand, p_type, class_text,
    l_linestatus, l_returnflag, adverse, problem
  FROM rep
  WHERE report_number NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)
  UNION ALL
  SELECT CAST(doc_id AS VARCHAR), received, CAST(year(received) AS INTEGER),
    CAST(month(received) AS INTEGER), NULL, NULL, NULL, NULL, '[]', NULL, NULL, NULL, NULL
  FROM doc
  UNION ALL
  SELECT 'C' || conv_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '[]', NULL, NULL, NULL, NULL
  FROM turn WHERE version = 1
)""" + _outcomes("ev")

# One row per hit that did not land, of pages of 50.
_MISSING = _SUB + """,
hit AS (
  SELECT pos, pos // 50 + 1 AS page, n FROM (SELECT count(*) AS n FROM sub),
    LATERAL (SELECT unnest(range(n)) AS pos)),
gap AS (
  SELECT pos, page, pos - row_number() OVER (ORDER BY pos) AS island
  FROM hit
  WHERE NOT (page % 7 NOT IN (3, 4)
             AND pos % 50 < least(50, n - (page - 1) * 50) - CASE page % 11 WHEN 5 THEN 20 ELSE 0 END)
    AND NOT (page % 5 = 0 AND pos % 50 >= 10)
    AND NOT ((page - 1) % 5 = 0 AND page > 1 AND pos % 50 < 5)
)"""

_LATEST = """
SELECT report_number, mdr_report_key, kind AS event_type, fetched AS _ingested_at FROM rep"""

ORACLE: dict[str, str] = {
    "event_summary": _with(_REP, _event_summary("rep")),
    "product_risk": _with(_REP, _product_risk("rep")),
    "product_risk_all_versions": _with(_SUB, _product_risk("sub")),
    "product_risk_top20": _with(_REP, _product_risk("rep", _TOP_RISK)),
    "outcome_codes": _with(_REP + _outcomes("rep"), "SELECT * FROM outcomes"),
    "outcome_breakdown": _with(_REP + _outcomes("rep"), """
SELECT year, outcome_label, count(report_number) AS report_count FROM outcomes GROUP BY 1, 2"""),
    "reports_latest": _with(_REP, _LATEST),
    "stream_latest": _with(_REP, _LATEST),
    "events_silver": _with(_REP, f"SELECT {_EVENT_COLUMNS} FROM rep"),
    "events_partitioned": _with(_REP, f"SELECT {_EVENT_COLUMNS} FROM rep"),
    "events_partition_slice": _with(_REP, """
SELECT report_number, kind AS event_type, received AS date_received, yr AS year, mon AS month
FROM rep WHERE yr BETWEEN 1996 AND 1998"""),
    "devices_silver": _with(_REP + _devices("rep"), _DEVICE_SELECT),
    "devices_silver_all_versions": _with(_SUB + _devices("sub"), _DEVICE_SELECT),
    "narratives_silver": _with(
        _TEXTS, f"SELECT {_NARRATIVE_COLUMNS} FROM narrative WHERE version = 1"),
    "narratives_silver_all_versions": _with(
        _TEXTS, f"SELECT {_NARRATIVE_COLUMNS} FROM narrative"),
    "matched_keywords": f"""
SELECT * FROM (
  SELECT doc_id, {_matched('text', TEXT_KEYWORDS)} AS matched_keywords,
    {_matched('text', HIGH_RISK_KEYWORDS)} AS matched_high_risk
  FROM documents) WHERE matched_keywords <> ''""",
    "flagged_narratives": _flagged(HIGH_RISK_KEYWORDS, latest_only=True),
    "flagged_custom": _flagged(TEXT_KEYWORDS, latest_only=False),
    "flagged_latest20": _flagged(TEXT_KEYWORDS, False, _TOP_FLAGGED),
    "search_filter": _with(_SUB, f"""
SELECT report_number, mdr_report_key, received_text AS date_received,
  'Supplier#00000000' AS _manufacturer_filter, '19960101' AS _date_from,
  '19981231' AS _date_to {_SEARCH}"""),
    "matching_count": _with(_SUB, f"SELECT count(*) AS total {_SEARCH}"),
    "page_plan": _with(_SUB, """
SELECT CAST(p + 1 AS BIGINT) AS page_num, CAST(p * 1000 AS BIGINT) AS skip, 1000 AS page_limit,
  CAST(least(1000, n - p * 1000) AS BIGINT) AS records
FROM (SELECT count(*) AS n FROM sub),
  LATERAL (SELECT unnest(range(CAST(ceil(n / 1000) AS BIGINT))) AS p)"""),
    "bronze_flatten": _bronze(),
    "bronze_flatten_texts": _with(_TEXT_ROWS, _text_rows()),
    "null_to_empty": _bronze("coalesce({}, '')"),
    "date_parse": _with(_SUB, """
SELECT report_number, mdr_report_key, received AS date_received, event_date AS date_of_event,
  ship_date AS date_report FROM sub"""),
    "landing_roundtrip": _all_bronze(),
    "landing_stream_ingest": _all_bronze(),
    "array_pages_roundtrip": _all_bronze(),
    "responses_roundtrip": _all_bronze(skip=("_run_id",)),
    "bronze_append_merge": _all_bronze(
        ", CAST(NULL AS INTEGER) AS narrative_blocks",
        (", CAST(n_blocks AS INTEGER)", ", CAST(1 AS INTEGER)")),
    "corrupt_pages": _with(_TEXTS, """
SELECT CASE WHEN number % 14 = 7 THEN 'kept aside' ELSE 'read' END AS kind, report_number,
  mdr_report_key, CAST(0 AS BIGINT) AS records, CAST(0 AS BIGINT) AS corrupt_records
FROM (SELECT doc_id AS number, CAST(doc_id AS VARCHAR) AS report_number, lang AS mdr_report_key
      FROM documents
      UNION ALL SELECT conv_id, 'C' || conv_id, CAST(turn AS VARCHAR) FROM conversations)
UNION ALL
SELECT 'summary', 'run_texts', 'bronze', CAST(sum(CAST(n % 14 <> 7 AS INTEGER)) AS BIGINT),
  CAST(sum(CAST(n % 14 = 7 AS INTEGER)) AS BIGINT)
FROM (SELECT doc_id AS n FROM documents UNION ALL SELECT conv_id FROM conversations)"""),
    "gold_written": _with(_ALL_EVENTS, f"""
SELECT 'event_summary' AS layer, * FROM ({_event_summary('ev')})
UNION ALL BY NAME SELECT 'product_risk' AS layer, * FROM ({_product_risk('ev')})
UNION ALL BY NAME SELECT 'outcome_breakdown' AS layer, * FROM (
  SELECT year, outcome_label, count(report_number) AS report_count FROM outcomes GROUP BY 1, 2)
UNION ALL BY NAME SELECT 'flagged_narratives' AS layer, * FROM (
  SELECT n.report_number, received AS date_received, p_brand AS brand_name,
    p_type AS generic_name, kind AS event_type, text_type_code, narrative_text,
    {_matched('narrative_text', HIGH_RISK_KEYWORDS)} AS matched_keywords
  FROM narrative n LEFT JOIN ev ON ev.report_number = n.report_number WHERE version = 1)
WHERE layer <> 'flagged_narratives' OR matched_keywords <> ''"""),
    "run_summary": _with(_RUN_FILES, """
SELECT run_id, 'Supplier#00000000' AS manufacturer, '19960101' AS date_from,
  '19981231' AS date_to, count(DISTINCT page) AS total_pages, count(*) AS total_records,
  run_id AS landing_path, 'bronze' AS bronze_table, max(fetched) AS completed_at
FROM record GROUP BY run_id"""),
    "run_files": _with(_RUN_FILES, """
SELECT run_id AS _run_id, run_id AS _source_file, count(*) AS records
FROM record GROUP BY run_id, page"""),
    "missing_pages": _with(_MISSING, """
SELECT page AS page_num, CAST(min(pos) AS BIGINT) AS skip, count(*) AS records
FROM gap GROUP BY page, island"""),
    "fetch_ranges": _with(_MISSING, """
SELECT CAST(min(pos) AS BIGINT) AS skip, count(*) AS records, count(DISTINCT page) AS pages
FROM gap GROUP BY island"""),
    "flagged_by_table": """
WITH words AS (SELECT string_split(text, ' ') AS w FROM benchmark),
term AS (
  SELECT DISTINCT lower(t) AS term FROM (
    SELECT unnest(list_concat(w, list_transform(range(1, greatest(len(w), 2)),
      lambda i: concat_ws(' ', w[i], w[i + 1])))) AS t FROM words)
  WHERE length(t) >= 9)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_terms,
  md5(string_agg(term, '|' ORDER BY term)) AS terms_md5
FROM documents JOIN term ON contains(lower(text), term) GROUP BY doc_id""",
    "snapshot_read": _with(_SUB, """
SELECT 'during' AS layer, report_number, mdr_report_key FROM sub WHERE fetched < '1996'
UNION ALL SELECT 'after', report_number, mdr_report_key FROM sub"""),
    "gold_incremental": _with(_ALL_EVENTS, f"""
SELECT 'event_summary' AS layer, * FROM ({_event_summary('ev')})
UNION ALL BY NAME SELECT 'product_risk' AS layer, * FROM ({_product_risk('ev')})
UNION ALL BY NAME SELECT 'outcome_breakdown' AS layer, * FROM (
  SELECT year, outcome_label, count(report_number) AS report_count FROM outcomes GROUP BY 1, 2)"""),
    "layer_counts": _with(_ALL_EVENTS, f"""
SELECT 'bronze' AS layer, (SELECT count(*) FROM sub) + (SELECT count(*) FROM documents)
  + (SELECT count(*) FROM conversations) AS row_count
UNION ALL SELECT 'events', count(*) FROM ev
UNION ALL SELECT 'devices', CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O'
  THEN 2 ELSE 1 END) AS BIGINT) FROM ev
UNION ALL SELECT 'narratives', count(*) FROM narrative WHERE version = 1
UNION ALL SELECT 'event_summary', count(*) FROM (
  SELECT DISTINCT year(received), month(received), kind FROM ev)
UNION ALL SELECT 'product_risk', count(*) FROM (
  SELECT DISTINCT p_brand, p_type, class_text FROM ev)
UNION ALL SELECT 'outcome_breakdown', count(*) FROM (
  SELECT DISTINCT year, outcome_label FROM outcomes)
UNION ALL SELECT 'flagged_narratives', count(*) FROM narrative
  WHERE version = 1 AND {_matched('narrative_text', HIGH_RISK_KEYWORDS)} <> ''"""),
}

ORACLE["silver_incremental"] = f"""
SELECT 'events' AS layer, * FROM ({ORACLE["events_silver"]})
UNION ALL BY NAME SELECT 'devices' AS layer, * FROM ({ORACLE["devices_silver"]})
UNION ALL BY NAME SELECT 'narratives' AS layer, * FROM ({ORACLE["narratives_silver"]})"""
