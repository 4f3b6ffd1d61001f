"""The SQL that each query must agree with, for DuckDB on the same tables.

The SQL states results, not methods: where a query parses text that was made
from a table, the SQL takes the answer from the table.
"""

from __future__ import annotations

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

ORDERS = """(SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
    o_orderdate, o_orderpriority FROM orders)"""
CUSTOMER = "(SELECT * REPLACE (CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal) FROM customer)"
EVENTS = "(SELECT * REPLACE (CAST(value AS DECIMAL(18,2)) AS value) FROM events)"
LINEITEM = """(SELECT * REPLACE (CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(18,2)) AS l_discount,
    CAST(l_tax AS DECIMAL(18,2)) AS l_tax) FROM lineitem)"""


def _metric(func: str, col: str) -> str:
    if func == "SUM":
        return f"coalesce(CAST(sum({col}) AS VARCHAR), '0')"
    return f"coalesce(CAST({func.lower()}({col}) AS VARCHAR), '')"


def _long(relation: str, metrics: list[tuple[str, str]], table: str, where: str = "", by: str = "", extra: str = "") -> str:
    """Long profile: one row per metric, by way of a wide aggregate and a list."""
    structs = ["{'func': 'COUNT', 'col': '*', 'value': CAST(count(*) AS VARCHAR)}"]
    structs += [f"{{'func': '{f}', 'col': '{c}', 'value': {_metric(f, c)}}}" for f, c in metrics]
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT "table", {extra} m.func AS func, m.col AS col, m.value AS value FROM (
        SELECT {table} AS "table", unnest([{', '.join(structs)}]) AS m FROM {relation} {where} {group})"""


def _sums(*cols: str) -> list[tuple[str, str]]:
    return [("SUM", c) for c in cols]


def _extremes(*cols: str) -> list[tuple[str, str]]:
    return [(f, c) for f in ("MIN", "MAX") for c in cols]


ORDER_METRICS = _sums("o_totalprice", "o_orderkey") + _extremes("o_orderdate", "o_orderpriority", "o_totalprice")
CUSTOMER_METRICS = _sums("c_acctbal") + _extremes("c_name", "c_acctbal")
EVENT_METRICS = _sums("value") + _extremes("ts", "event_type", "props")
LINEITEM_METRICS = _sums("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey") + _extremes(
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
)

ORACLE: dict[str, str] = {}

# --- profiles ----------------------------------------------------------------

ORACLE["profile_count"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", 'COUNT' AS func, '*' AS col, CAST(count(*) AS VARCHAR) AS value FROM {t}""" for t in TABLES
)
ORACLE["profile_sum"] = " UNION ALL ".join([
    _long(LINEITEM, _sums("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"), "'lineitem'"),
    _long(ORDERS, _sums("o_totalprice", "o_orderkey"), "'orders'"),
    _long(CUSTOMER, _sums("c_acctbal"), "'customer'"),
])
ORACLE["profile_min_max"] = " UNION ALL ".join([
    _long(ORDERS, _extremes("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"), "'orders'"),
    _long(EVENTS, _extremes("event_id", "ts", "event_type", "value", "props"), "'events'"),
    _long("documents", _extremes("text", "lang"), "'documents'"),
])
ORACLE["profile_long"] = _long(LINEITEM, LINEITEM_METRICS, "'lineitem'")
ORACLE["profile_empty_input"] = _long(ORDERS, ORDER_METRICS, "'orders'", "WHERE o_totalprice < 0")
ORACLE["profile_filtered"] = " UNION ALL ".join([
    _long(ORDERS, ORDER_METRICS, "'orders'", "WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus <> 'P'"),
    _long(CUSTOMER, CUSTOMER_METRICS, "'customer'"),
])
MONTH = "'orders_1_prt_p' || strftime(o_orderdate, '%Y%m')"
ORACLE["profile_by_partition"] = f"""
    SELECT 'orders' AS base_table, replace("table", 'orders_1_prt_', '') AS part, func, col, value
    FROM ({_long(ORDERS, ORDER_METRICS, MONTH, by=MONTH)})"""
ORACLE["profile_cast_copy"] = f"""
    WITH copy AS (
        SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS quantity,
               CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS quantity_text,
               * FROM {LINEITEM})
    SELECT 'lineitem' AS "table", m.func AS func, m.col AS col, m.value AS value FROM (SELECT unnest([
        {{'func': 'COUNT', 'col': '*', 'value': CAST(count(*) AS VARCHAR)}},
        {{'func': 'SUM', 'col': 'l_quantity', 'value': CAST(sum(quantity) AS VARCHAR)}},
        {{'func': 'SUM', 'col': 'l_extendedprice', 'value': CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS VARCHAR)}},
        {{'func': 'SUM', 'col': 'l_linenumber', 'value': CAST(sum(l_linenumber) AS VARCHAR)}},
        {{'func': 'SUM', 'col': 'l_orderkey', 'value': CAST(sum(l_orderkey) AS VARCHAR)}},
        {{'func': 'MIN', 'col': 'l_quantity', 'value': CAST(min(quantity) AS VARCHAR)}},
        {{'func': 'MAX', 'col': 'l_quantity', 'value': max(quantity_text)}},
        {{'func': 'MIN', 'col': 'l_partkey', 'value': CAST(min(l_partkey) AS VARCHAR)}},
        {{'func': 'MAX', 'col': 'l_partkey', 'value': max(CAST(l_partkey AS VARCHAR))}},
        {{'func': 'MIN', 'col': 'l_shipdate', 'value': strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S')}},
        {{'func': 'MAX', 'col': 'l_shipdate', 'value': strftime(max(l_shipdate), '%Y-%m-%d')}},
        {{'func': 'MAX', 'col': 'l_comment_free', 'value': NULL}}]) AS m FROM copy)"""

ORACLE["profile_many_groups"] = " UNION ALL ".join([
    _long(EVENTS, EVENT_METRICS, "'user_' || user_id", by="user_id"),
    _long("documents", _sums("n_chars") + _extremes("text", "lang"), "source", by="source"),
])
ORACLE["profile_unbounded"] = """
    WITH parts AS (
        SELECT o_orderpriority AS "table", CASE o_orderstatus WHEN 'P' THEN -1 ELSE 1 END AS sign,
               CAST(lpad(CAST(o_orderkey AS VARCHAR), 10, '1') || lpad(CAST(o_custkey AS VARCHAR), 20, '2') AS HUGEINT) AS w,
               CAST(lpad(CAST(o_orderkey AS VARCHAR), 24, '3') || '0' AS HUGEINT) AS f
        FROM orders),
    sums AS (
        SELECT "table", count(*) AS n, sum(sign * w) AS w, sum(sign * f) AS f, CAST('10000000000000000000000000' AS HUGEINT) AS base,
               min({'w': sign * w, 'f': sign * f}) AS least, max({'w': sign * w, 'f': sign * f}) AS most
        FROM parts GROUP BY 1),
    rest AS (SELECT *, (f % base + base) % base AS over FROM sums)
    SELECT "table", m.func AS func, m.col AS col, m.value AS value FROM (SELECT "table", unnest([
        {'func': 'COUNT', 'col': '*', 'value': CAST(n AS VARCHAR)},
        {'func': 'SUM', 'col': 'n', 'value': CAST(w + CAST((f - over) // base AS HUGEINT) AS VARCHAR) || '.' || rtrim(lpad(CAST(over AS VARCHAR), 25, '0'), '0')},
        {'func': 'MIN', 'col': 'n', 'value': CAST(least.w AS VARCHAR) || '.' || rtrim(lpad(CAST(abs(least.f) AS VARCHAR), 25, '0'), '0')},
        {'func': 'MAX', 'col': 'n', 'value': CAST(most.w AS VARCHAR) || '.' || rtrim(lpad(CAST(abs(most.f) AS VARCHAR), 25, '0'), '0')}]) AS m FROM rest)"""

# --- lines -------------------------------------------------------------------

METRIC_TEXT = " || ',' || ".join(f"'{f}({c}):' || {_metric(f, c)}" for f, c in ORDER_METRICS)
ORACLE["line_encode"] = f"""
    SELECT 'orders_1_prt_c' || o_custkey AS "table",
           'whs|sales|orders_1_prt_c' || o_custkey || '|' || count(*) || '|' || {METRIC_TEXT} AS line
    FROM {ORDERS} GROUP BY o_custkey"""
ORACLE["line_decode"] = _long(EVENTS, EVENT_METRICS, "'user_' || user_id", by="user_id", extra="'web' AS \"schema\",")
ORACLE["line_parse"] = """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN 't_' || o_orderkey END AS "table",
           CAST(CASE o_orderpriority WHEN '3-MEDIUM' THEN 7 WHEN '4-NOT SPECIFIED' THEN 0 WHEN '5-LOW' THEN 5 END AS BIGINT) AS row_count,
           CASE o_orderpriority WHEN '2-HIGH' THEN 'SUM(a):1' WHEN '3-MEDIUM' THEN 'SUM(a):6'
                WHEN '5-LOW' THEN 'SUM(a):6,MAX(c):x,y:z' ELSE '' END AS metric_text,
           CASE o_orderpriority WHEN '3-MEDIUM' THEN 'MIN_MAX_STATUS: DATA_TYPE_FILE_MISSING' ELSE '' END AS line_remark,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Failed to parse GP Result' END AS reason
    FROM orders"""
ORACLE["export_lines"] = f"""
    SELECT 'orders_1_prt_c' || o_custkey AS "table", count(*) AS row_count, {METRIC_TEXT} AS metric_text
    FROM {ORDERS} GROUP BY o_custkey"""

# --- type rules --------------------------------------------------------------

# Every source type tried, with what the rules must say about it: ordered, the
# Spark type, the Spark type by whole names, its length, the scale shown.
TYPES = [
    ("numeric(18,2)", 1, "decimal(18,2)", "decimal(18,2)", "(18,2)", 2),
    ("decimal(10, 4)", 1, "decimal(10, 4)", "decimal(10, 4)", "(10, 4)", 4),
    ("NUMERIC", 1, "decimal(38,4)", "decimal(38,4)", "", 4),
    ("decimal", 1, "decimal(38,4)", "decimal(38,4)", "", 4),
    ("numeric (12)", 1, "decimal(12)", "decimal(12)", "(12)", 4),
    ("character varying(20)", 1, "string", "string", "(20)", 4),
    ("varchar", 1, "string", "string", "", 4),
    ("char(3)", 1, "string", "string", "(3)", 4),
    ("TEXT", 1, "string", "string", "", 4),
    ("string", 1, "string", "string", "", 4),
    ("int", 1, "long", "long", "", 0),
    ("integer", 1, "long", "long", "", 0),
    ("bigint", 1, "long", "long", "", 0),
    ("smallint", 1, "long", "long", "", 0),
    ("date", 1, "date", "date", "", 4),
    ("time without time zone", 1, "timestamp", "string", "", 4),
    ("timestamp with time zone", 1, "timestamp", "timestamp", "", 4),
    (" Timestamp ", 1, "timestamp", "timestamp", "", 4),
    ("float", 1, "string", "double", "", 4),
    ("real", 1, "string", "double", "", 4),
    ("double precision", 1, "string", "double", "", 4),
    ("boolean", 0, "string", "string", "", 4),
    ("bytea", 0, "string", "string", "", 4),
    ("uuid", 0, "string", "string", "", 4),
    ("interval", 1, "long", "string", "", 0),
    ("json", 0, "string", "string", "", 4),
    ("jsonb", 0, "string", "string", "", 4),
    ("xml", 0, "string", "string", "", 4),
    ("geometry(point)", 0, "long", "string", "(point)", 0),
    ("point", 0, "long", "string", "", 0),
    ("line", 0, "string", "string", "", 4),
    ("polygon", 0, "string", "string", "", 4),
    ("circle", 0, "string", "string", "", 4),
    ("integer[]", 1, "long", "string", "", 0),
    ("text[]", 1, "string", "string", "", 4),
    ("datetime", 1, "date", "string", "", 4),
]


def _pick(index: str, values: list) -> str:
    listed = ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values)
    return f"([{listed}])[CAST({index} % {len(values)} AS INTEGER) + 1]"


COPY_TYPES = [("text", 1), ("VARCHAR(30)", 1), ("string", 1), ("decimal(18,2)", 0), ("bytea", 0), ("char (1)", 1), ("int", 0)]
ORACLE["type_candidates"] = f"""
    SELECT p_partkey, {_pick('p_partkey', [t[0] for t in TYPES])} AS gp_type, {_pick('p_partkey', [t[0] for t in COPY_TYPES])} AS ext_type,
           {_pick('p_partkey', [t[1] for t in TYPES])} * {_pick('p_partkey', [t[1] for t in COPY_TYPES])} AS candidate
    FROM part"""
ORACLE["type_mapping"] = f"""
    SELECT p_partkey, {_pick('p_partkey', [t[2] for t in TYPES])} AS spark_type, {_pick('p_partkey', [t[3] for t in TYPES])} AS exact_type,
           {_pick('p_partkey', [t[4] for t in TYPES])} AS length, {_pick('p_partkey', [t[5] for t in TYPES])} AS scale
    FROM part"""

# --- control data ------------------------------------------------------------

ORACLE["table_list_parse"] = """
    SELECT o_orderkey AS ordinal, 'whs' AS db, 'sales' AS "schema",
           CASE o_orderpriority WHEN '1-URGENT' THEN 'orders_1_prt_p' ELSE 'orders_' END || o_orderkey AS "table",
           CASE o_orderpriority WHEN '1-URGENT' THEN 'orders' ELSE 'orders_' || o_orderkey END AS base_table,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'p' || o_orderkey END AS part
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')"""
ORACLE["table_list_keys"] = """
    SELECT o_orderkey AS ordinal, 'whs' AS db, 'sales' AS "schema", 'orders_' || o_orderkey AS "table",
           'o_orderkey, o_custkey' AS key_cols, 'orders_' || o_orderkey AS base_table, CAST(NULL AS VARCHAR) AS part
    FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'O'"""
ORACLE["table_list_rejects"] = """
    WITH entries AS (
        SELECT o_orderkey AS ordinal, o_orderpriority AS p, o_orderstatus AS s,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'whs | sales.orders_1_prt_p' || o_orderkey
                    WHEN '3-MEDIUM' THEN 'whs|sales.orders_' || o_orderkey
                    WHEN '4-NOT SPECIFIED' THEN 'whs|orders_' || o_orderkey
                    ELSE CASE o_orderstatus WHEN 'O' THEN 'whs|sales.orders_' || o_orderkey || '| o_orderkey, o_custkey|x' ELSE 'whs' END
               END AS entry
        FROM orders
        WHERE o_orderpriority <> '2-HIGH' AND NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F'))
    SELECT ordinal, entry,
           CASE p WHEN '4-NOT SPECIFIED' THEN 'expected one dot in Schema.Table' ELSE 'expected DB|Schema.Table' END AS reason,
           'plain' AS form
    FROM entries WHERE p IN ('4-NOT SPECIFIED', '5-LOW')
    UNION ALL
    SELECT ordinal, entry, 'expected DB|Schema.Table|KEY_COLS', 'keyed' FROM entries WHERE NOT (p = '5-LOW' AND s = 'O')"""

MASTER = """master AS (
        SELECT o_custkey AS custkey,
               CASE o_orderstatus WHEN 'F' THEN 'o_totalprice' WHEN 'O' THEN 'None' ELSE 'o_totalprice, o_orderkey,,' END AS sum_cols,
               CASE o_orderpriority WHEN '2-HIGH' THEN 'o_totalprice > 0' ELSE 'none' END AS "where"
        FROM orders WHERE o_orderpriority <> '5-LOW'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)"""
ORACLE["master_lookup"] = f"""
    WITH {MASTER}
    SELECT 'cust_' || c_custkey AS "table", CASE WHEN custkey IS NULL THEN 0 ELSE 1 END AS has_config, sum_cols, "where",
           CASE sum_cols WHEN 'o_totalprice' THEN 'o_totalprice' WHEN 'o_totalprice, o_orderkey,,' THEN 'o_totalprice/o_orderkey' ELSE '' END AS sum_list,
           CASE WHEN "where" = 'o_totalprice > 0' THEN 1 ELSE 0 END AS is_filtered
    FROM customer LEFT JOIN master ON c_custkey = custkey"""
ORACLE["master_missing"] = """
    SELECT 'whs' AS db, 'sales' AS "schema", 'cust_' || c_custkey AS "table" FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority <> '5-LOW')"""
ORDER_TYPE = _pick("o_orderkey", [t[0] for t in TYPES])
ORACLE["export_metrics"] = f"""
    WITH {MASTER}
    SELECT 'cust_' || c_custkey AS "table", 'SUM' AS func, col, 0 AS rank FROM (
        SELECT c_custkey, unnest(CASE sum_cols WHEN 'o_totalprice' THEN ['o_totalprice'] WHEN 'None' THEN []
            ELSE ['o_totalprice', 'o_orderkey'] END) AS col
        FROM customer JOIN master ON c_custkey = custkey)
    UNION ALL
    SELECT 'cust_' || o_custkey, f.func, 'c_' || o_orderkey, f.rank
    FROM orders CROSS JOIN (VALUES ('MIN', 1), ('MAX', 2)) AS f(func, rank)
    WHERE o_custkey IN (SELECT custkey FROM master) AND o_custkey IN (SELECT c_custkey FROM customer)
      AND o_orderstatus <> 'P' AND {_pick('o_orderkey', [t[1] for t in TYPES])} = 1"""
ORACLE["metric_types"] = f"""
    SELECT 'cust_' || o_custkey AS "table", 'c_' || o_orderkey AS type_key, lower(trim({ORDER_TYPE})) AS source_type FROM orders"""
ORACLE["success_latest"] = """
    WITH latest AS (
        SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus <> 'P'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
            CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END,
            year(o_orderdate) DESC, o_orderpriority DESC, o_orderkey) = 1)
    SELECT 'cust_' || c_custkey AS "table", CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END AS has_copy,
           '/mnt/new/' || o_orderkey AS file_path
    FROM customer LEFT JOIN latest ON c_custkey = o_custkey"""
ORACLE["result_latest"] = f"""
    WITH latest AS (
        SELECT user_id, event_id, value, '/out/' || event_type || '/whs_cust_' || user_id || '_' || event_id || '.txt' AS path
        FROM {EVENTS}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('hour', ts) DESC, path DESC) = 1)
    SELECT 'cust_' || c_custkey AS "table", event_id AS row_count, 'SUM(value):' || value AS metric_text, path,
           CASE WHEN path IS NULL THEN 'GP Result File Missing' END AS remark
    FROM customer LEFT JOIN latest ON c_custkey = user_id"""
ORACLE["special_columns"] = """
    WITH special AS (
        SELECT lower(p_brand) AS brand, string_agg(DISTINCT lower(p_type), ',' ORDER BY lower(p_type)) AS special
        FROM part WHERE p_size <= 30 GROUP BY lower(p_brand))
    SELECT s_suppkey, 'brand#' || s_nationkey AS "table", coalesce(special, '') AS special
    FROM supplier LEFT JOIN special ON brand = 'brand#' || s_nationkey"""
ORACLE["key_validation"] = """
    WITH has AS (
        SELECT l_suppkey, bool_or(l_linenumber = 1) AS n1, bool_or(l_linenumber = 2) AS n2, bool_or(l_linenumber = 3) AS n3,
               bool_or(l_linenumber = 7) AS n7, bool_or(l_linenumber = 9) AS n9
        FROM lineitem GROUP BY l_suppkey),
    wanted AS (
        SELECT s_suppkey, l_suppkey,
               CASE WHEN s_nationkey < 5 THEN 'all' WHEN s_nationkey < 10 THEN 'c_1, C_2,'
                    WHEN s_nationkey < 15 THEN 'C_3,no_such, nor_this' WHEN s_nationkey < 20 THEN 'c_9' ELSE 'C_7' END AS key_cols,
               CASE WHEN s_nationkey < 5 THEN NULL
                    WHEN s_nationkey < 10 THEN CASE WHEN NOT n1 THEN 'c_1' WHEN NOT n2 THEN 'C_2' END
                    WHEN s_nationkey < 15 THEN CASE WHEN NOT n3 THEN 'C_3' ELSE 'no_such' END
                    WHEN s_nationkey < 20 THEN CASE WHEN NOT n9 THEN 'c_9' END
                    ELSE CASE WHEN NOT n7 THEN 'C_7' END END AS unknown
        FROM supplier LEFT JOIN has ON s_suppkey = l_suppkey)
    SELECT 'sup_' || s_suppkey AS "table", key_cols,
           CASE key_cols WHEN 'all' THEN NULL WHEN 'c_1, C_2,' THEN 'c_1/C_2' WHEN 'C_3,no_such, nor_this' THEN 'C_3/no_such/nor_this'
                ELSE key_cols END AS keys,
           CASE WHEN l_suppkey IS NULL THEN 'No columns found'
                WHEN unknown IS NOT NULL THEN 'Key column ''' || unknown || ''' not found in table ''sales.sup_' || s_suppkey || '''' END AS error
    FROM wanted"""

# --- content -----------------------------------------------------------------


def _joined(columns: list[str]) -> str:
    return " || '~|~' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


def _content(relation: str, keys: list[str], columns: list[str], content: str | None = None) -> str:
    key, row = _joined(keys), _joined(columns)
    return f"""SELECT md5({key}) AS hash_key, {key} AS key, md5({row}) AS hash_content, {content or row} AS content FROM {relation}"""


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE["content_rows_keyed"] = _content(ORDERS, ["o_orderkey", "o_custkey"], ORDER_COLUMNS)
ORACLE["content_rows_all"] = _content(CUSTOMER, CUSTOMER_COLUMNS, CUSTOMER_COLUMNS)
ORACLE["content_rows_excluded"] = _content(LINEITEM, LINEITEM_COLUMNS, LINEITEM_COLUMNS, "''")
ORACLE["content_rows_nulls"] = _content(
    """(SELECT o_orderkey, o_custkey, o_orderstatus,
            CASE WHEN o_totalprice > 1000 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS o_totalprice, o_orderdate,
            CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders)""",
    ["o_orderkey", "o_orderpriority"],
    ORDER_COLUMNS,
)
# Bytes of the text as hex pairs, each replaced by its Windows-874 character.
REREAD = """chars AS (
        SELECT list(CASE WHEN b < 128 OR b = 160 THEN chr(CAST(b AS INTEGER))
                         WHEN b BETWEEN 161 AND 218 OR b BETWEEN 223 AND 251 THEN chr(CAST(b - 160 + 3584 AS INTEGER))
                         WHEN b = 128 THEN '€' WHEN b = 133 THEN '…'
                         WHEN b BETWEEN 145 AND 151 THEN ('‘’“”•–—')[CAST(b - 144 AS INTEGER)]
                         ELSE chr(65533) END ORDER BY b) AS c
        FROM range(1, 256) AS r(b)),
    reread AS (
        SELECT doc_id, lang, source, n_chars,
               array_to_string(list_transform(regexp_extract_all(hex(text), '..'), lambda x: c[CAST('0x' || x AS INTEGER)]), '') AS text
        FROM documents, chars)"""
ORACLE["content_rows_special"] = f"WITH {REREAD} {_content('reread', ['doc_id', 'text'], DOCUMENT_COLUMNS)}"
ORACLE["content_run_rows"] = f"""
    WITH {REREAD}
    SELECT *, 'orders' AS "table" FROM ({_content(ORDERS, ['o_orderkey', 'o_custkey'], ORDER_COLUMNS)})
    UNION ALL SELECT *, 'customer' FROM ({_content(CUSTOMER, CUSTOMER_COLUMNS[::-1], CUSTOMER_COLUMNS[::-1])})
    UNION ALL SELECT *, 'documents' FROM ({_content('reread', ['doc_id', 'text'], DOCUMENT_COLUMNS)})"""
ORACLE["content_run_status"] = """
    SELECT 'orders' AS "table", 'SUCCESS' AS status, '-' AS message, count(*) AS n FROM orders
    UNION ALL SELECT 'customer', 'SUCCESS', '-', count(*) FROM customer
    UNION ALL SELECT 'documents', 'SUCCESS', '-', count(*) FROM documents
    UNION ALL SELECT 'part', 'FAILED', 'Key column ''no_such_key'' not found in table ''sales.part''', 0
    UNION ALL SELECT 'supplier', 'FAILED', 'No key columns given', 0
    UNION ALL SELECT 'lineitem', 'FAILED', 'No columns found', 0
    UNION ALL SELECT 'nothing_here', 'FAILED', 'no such path', 0
    UNION ALL SELECT 'region', 'FAILED', 'no such column', 0"""
ORACLE["export_gzip"] = f"""
    SELECT hash_key || '|' || key || '|' || hash_content || '|' || content AS value
    FROM ({_content(ORDERS, ['o_orderkey', 'o_custkey'], ORDER_COLUMNS)})"""
ORACLE["export_content_parquet"] = _content("documents", ["doc_id"], DOCUMENT_COLUMNS)

# --- comparison --------------------------------------------------------------

MONTHS = f"""months AS (SELECT {MONTH} AS "table", count(*) AS n, sum(o_totalprice) AS total, sum(o_orderkey) AS keys,
        min(o_orderdate) AS d0, max(o_orderdate) AS d1, min(o_orderpriority) AS p0, max(o_orderpriority) AS p1,
        min(o_totalprice) AS t0, max(o_totalprice) AS t1 FROM {ORDERS} GROUP BY 1)"""
COPIED_MONTHS = f"""copied AS (SELECT o_orderkey, o_orderdate, o_orderpriority, {MONTH} AS "table",
            CASE WHEN year(o_orderdate) = 1998 AND o_orderstatus = 'P' THEN o_totalprice + 1
                 WHEN year(o_orderdate) = 2000 AND o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice END AS o_totalprice,
            unnest(CASE WHEN year(o_orderdate) = 1996 AND o_orderstatus = 'P' THEN [1, 2] ELSE [1] END) AS again
        FROM {ORDERS} WHERE NOT (year(o_orderdate) = 1997 AND o_orderpriority = '1-URGENT')),
    copies AS (SELECT "table", count(*) AS n, sum(o_totalprice) AS total, sum(o_orderkey) AS keys,
        min(o_orderdate) AS d0, max(o_orderdate) AS d1, min(o_orderpriority) AS p0, max(o_orderpriority) AS p1,
        min(o_totalprice) AS t0, max(o_totalprice) AS t1 FROM copied GROUP BY 1)"""


def _pair(func: str, col: str, kind: str, field: str, shown: str, compared: str) -> str:
    def side(s: str) -> str:
        return f"coalesce({shown.format(f'{s}.{field}')}, '')"

    left, right = f"m.{field}", f"c.{field}"
    if compared == "number":
        same = f"coalesce(abs(CAST({left} AS DOUBLE) - CAST({right} AS DOUBLE)) < 0.001, {left} IS NULL AND {right} IS NULL)"
    else:
        same = f"{side('m')} = {side('c')}"
    return f"""{{'func': '{func}', 'col': '{col}', 'source_type': '{kind}', 'source_value': {side('m')},
        'copy_value': {side('c')}, 'matched': CASE WHEN {same} THEN 1 ELSE 0 END}}"""


AMOUNT, PLAIN, MOMENT = "printf('%.2f', CAST({} AS DOUBLE))", "CAST({} AS VARCHAR)", "strftime({}, '%Y-%m-%d %H:%M:%S')"
PAIRS = [
    _pair("COUNT", "*", "string", "n", PLAIN, "text"),
    _pair("SUM", "o_totalprice", "numeric(18,2)", "total", AMOUNT, "number"),
    _pair("SUM", "o_orderkey", "bigint", "keys", PLAIN, "number"),
    _pair("MIN", "o_orderdate", "timestamp without time zone", "d0", MOMENT, "text"),
    _pair("MAX", "o_orderdate", "timestamp without time zone", "d1", MOMENT, "text"),
    _pair("MIN", "o_orderpriority", "character varying", "p0", PLAIN, "text"),
    _pair("MAX", "o_orderpriority", "character varying", "p1", PLAIN, "text"),
    _pair("MIN", "o_totalprice", "numeric(18,2)", "t0", AMOUNT, "number"),
    _pair("MAX", "o_totalprice", "numeric(18,2)", "t1", AMOUNT, "number"),
]
COMPARED = f"""{MONTHS}, {COPIED_MONTHS},
    compared AS (SELECT "table", p.* FROM (
        SELECT m."table", unnest([{', '.join(PAIRS)}]) AS p FROM months m LEFT JOIN copies c ON m."table" = c."table")),
    classified AS (
        SELECT "table", CAST(max(source_value) FILTER (func = 'COUNT') AS BIGINT) AS source_count,
               CAST(max(copy_value) FILTER (func = 'COUNT') AS BIGINT) AS copy_count,
               count(*) - 1 AS total_metrics, count(*) FILTER (func <> 'COUNT' AND matched = 0) AS mismatch_metrics
        FROM compared GROUP BY "table"),
    statuses AS (
        SELECT *, CASE WHEN source_count = copy_count AND mismatch_metrics = 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
               CASE WHEN source_count <> copy_count THEN 'Count Mismatch' WHEN mismatch_metrics = 0 THEN 'Success'
                    ELSE 'Data Mismatch (' || mismatch_metrics || '/' || total_metrics || ')' END AS remark
        FROM classified)"""
ORACLE["compare_metrics"] = f"""
    WITH {COMPARED}
    SELECT "table", func, col, source_type, source_value, copy_value, matched FROM compared"""
ORACLE["table_status"] = f"WITH {COMPARED} SELECT * FROM statuses"
ORACLE["column_log"] = f"""
    WITH {COMPARED}
    SELECT 'run-1' AS execution_id, "table" AS "partition", func, col, source_value, copy_value,
           CASE matched WHEN 1 THEN 'Matched' ELSE 'Mismatch' END AS "match", 'Data Comparison' AS remark
    FROM compared WHERE func <> 'COUNT'"""


def _exact(relation: str, table: str, metrics: list[tuple[str, str]], whole: set[str], amounts: set[str], by: str) -> str:
    """Faithful copies: both sides read the same, numbers with the scale of their type."""
    structs = ["{'func': 'COUNT', 'col': '*', 'value': CAST(count(*) AS VARCHAR)}"]
    for func, col in metrics:
        value = f"{func.lower()}({col})"
        shown = f"printf('%.2f', CAST({value} AS DOUBLE))" if col in amounts else f"CAST({value} AS VARCHAR)"
        structs.append(f"{{'func': '{func}', 'col': '{col}', 'value': {shown}}}")
    return f"""SELECT "table", m.func AS func, m.col AS col, m.value AS source_value, m.value AS copy_value, 1 AS matched
        FROM (SELECT '{table}_1_prt_' || {by} AS "table", unnest([{', '.join(structs)}]) AS m FROM {relation} GROUP BY {by})"""


LINEITEM_AMOUNTS = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
ORACLE["compare_metrics_exact"] = " UNION ALL ".join([
    _exact(CUSTOMER, "customer", _sums("c_acctbal") + _extremes("c_name"), set(), {"c_acctbal"}, "c_nationkey"),
    _exact(EVENTS, "events", EVENT_METRICS, set(), {"value"}, "event_type"),
    _exact(LINEITEM, "lineitem", LINEITEM_METRICS, set(), LINEITEM_AMOUNTS, "l_suppkey"),
])
ORACLE["table_status_many"] = """
    SELECT 'customer_1_prt_' || c_nationkey AS "table", count(*) AS source_count, count(*) AS copy_count, CAST(3 AS BIGINT) AS total_metrics,
           CAST(0 AS BIGINT) AS mismatch_metrics, 'WARNING' AS status, 'Success' AS remark
    FROM customer GROUP BY c_nationkey
    UNION ALL
    SELECT "table", n, n, 7, wrong, CASE wrong WHEN 0 THEN 'COMPLETED' ELSE 'FAILED' END,
           CASE wrong WHEN 0 THEN 'Success' ELSE 'Data Mismatch (' || wrong || '/7)' END
    FROM (SELECT 'events_1_prt_' || event_type AS "table", count(*) AS n,
                 CASE WHEN date_trunc('second', min(ts)) <> min(ts) THEN 1 ELSE 0 END
                 + CASE WHEN date_trunc('second', max(ts)) <> max(ts) THEN 1 ELSE 0 END AS wrong
          FROM events GROUP BY event_type)
    UNION ALL
    SELECT 'lineitem_1_prt_' || l_suppkey, count(*), count(*), 19, 0, 'COMPLETED', 'Success' FROM lineitem GROUP BY l_suppkey"""

FAILED = """failed AS (
        SELECT 'cust_' || c_custkey AS "table", c_acctbal > 0 AS has_copy,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Local path not found or inaccessible: /x/' || c_name
                    WHEN c_mktsegment = 'BUILDING' THEN 'Spark Parquet Aggregation Failed: Column ''a'' in ' || c_name
                    WHEN c_mktsegment = 'FURNITURE' THEN 'Greenplum result file not found for pattern: ' || c_name
                    WHEN c_nationkey < 8 THEN 'Failed to parse GP Result: ' || c_name
                    WHEN c_nationkey < 12 THEN 'short'
                    WHEN c_nationkey < 16 THEN repeat('An error nobody knows. ', 12) || c_name END AS error,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Source Parquet Not Found (Check Mount/Path)'
                    WHEN c_mktsegment = 'BUILDING' THEN 'PySpark Aggregation Failed (Check Data/Schema)'
                    WHEN c_mktsegment = 'FURNITURE' THEN 'GP Result File Missing'
                    WHEN c_nationkey < 8 THEN 'Invalid GP Result Format'
                    WHEN c_nationkey < 12 THEN 'Error: short'
                    ELSE 'Error: An error nobody knows. An error nobody k...' END AS reason
        FROM customer),
    unsuccessful AS (
        SELECT "table", CAST(0 AS BIGINT) AS source_count, CAST(0 AS BIGINT) AS copy_count,
               CAST(0 AS BIGINT) AS total_metrics, CAST(0 AS BIGINT) AS mismatch_metrics,
               CASE WHEN has_copy THEN 'FAILED' ELSE 'SKIPPED' END AS status,
               CASE WHEN has_copy THEN reason || ' | ' || substr(replace(error, '''', ''), 1,
                        CASE WHEN reason LIKE 'PySpark%' THEN 198 ELSE 200 END)
                    ELSE 'SKIPPED: Status is not SUCCEEDED in any log files' END AS remark
        FROM failed WHERE NOT has_copy OR error IS NOT NULL)"""
ORACLE["failure_class"] = f"WITH {FAILED} SELECT * FROM unsuccessful"
ORACLE["export_status"] = f"""
    WITH {MASTER}, {FAILED},
    mapped AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')
    SELECT "table", status, CASE status WHEN 'SKIPPED' THEN 'No Config' WHEN 'FAILED' THEN error WHEN 'SUCCESS' THEN '-'
        ELSE 'Count/Sum successful, unable to process min/max because the data type mapping file was not found.' END AS remark
    FROM (SELECT f."table", f.error,
                 CASE WHEN custkey IS NULL THEN 'SKIPPED' WHEN error IS NOT NULL THEN 'FAILED'
                      WHEN o_custkey IS NULL THEN 'WARNING' ELSE 'SUCCESS' END AS status
          FROM failed f LEFT JOIN master ON f."table" = 'cust_' || custkey
          LEFT JOIN mapped ON f."table" = 'cust_' || o_custkey)"""
ORACLE["run_summary"] = f"""
    WITH {COMPARED}, {FAILED}
    SELECT status, count(*) AS n FROM (SELECT status FROM statuses UNION ALL SELECT status FROM unsuccessful) GROUP BY status"""
ORACLE["table_log"] = f"""
    WITH {COMPARED}, {FAILED}
    SELECT execution_id, 'whs' AS db, 'sales' AS "schema", split_part("table", '_1_prt_', 1) AS "table", "table" AS "partition",
           '3.50' AS duration_exec, '2.50' AS duration_table, source_count, copy_count, total_metrics, mismatch_metrics,
           lower(status) AS status, remark
    FROM (SELECT 'run-1' AS execution_id, * FROM statuses UNION ALL SELECT 'run-2', * FROM unsuccessful)"""

# --- ingest ------------------------------------------------------------------

ORACLE["incremental_changed"] = """
    SELECT '/land/user_' || user_id AS directory, CAST(max(ts) AS VARCHAR) AS modified,
           CASE WHEN count(*) FILTER (event_type IN ('view', 'click')) = 0 THEN 'new' ELSE 'newer' END AS reason
    FROM events GROUP BY user_id
    HAVING count(*) FILTER (event_type IN ('view', 'click')) = 0
        OR max(ts) > max(ts) FILTER (event_type IN ('view', 'click'))"""
ORACLE["incremental_ingest"] = _long(
    f"(SELECT * FROM {LINEITEM} WHERE l_returnflag <> 'A')", LINEITEM_METRICS, "'lineitem_1_prt_' || l_returnflag", by="l_returnflag"
)

# --- whole runs --------------------------------------------------------------


def _text(metrics: list[tuple[str, str]]) -> str:
    return " || ',' || ".join(f"'{f}({c}):' || {_metric(f, c)}" for f, c in metrics)


ALL_LINEITEM = _sums("l_quantity", "l_extendedprice", "l_orderkey") + _extremes(*LINEITEM_COLUMNS)
ALL_EVENTS = _sums("value") + _extremes("event_id", "ts", "user_id", "event_type", "value", "props")
NOTE = "MIN_MAX_STATUS: DATA_TYPE_FILE_MISSING"
ALL_DOCUMENTS = _sums("n_chars") + _extremes(*DOCUMENT_COLUMNS)
ORACLE["export_run_unmapped"] = f"""
    SELECT 'whs' AS db, 'sales' AS "schema", 'lineitem' AS "table", count(*) AS row_count, {_text(ALL_LINEITEM)} AS metric_text,
           '' AS line_remark, CAST(NULL AS VARCHAR) AS reason FROM {LINEITEM}
    UNION ALL
    SELECT 'whs', 'sales', 'events', count(*), {_text(ALL_EVENTS)}, '', NULL FROM {EVENTS} WHERE value > 10
    UNION ALL
    SELECT 'whs', 'sales', 'documents', count(*), 'SUM(n_chars):' || sum(n_chars), '{NOTE}', NULL FROM documents"""
ORACLE["export_run_lines"] = f"""
    SELECT 'whs' AS db, 'sales' AS "schema", 'lineitem' AS "table", count(*) AS row_count, {_text(ALL_LINEITEM)} AS metric_text,
           '' AS line_remark, CAST(NULL AS VARCHAR) AS reason FROM {LINEITEM}
    UNION ALL
    SELECT 'whs', 'sales', 'events', count(*), {_text(ALL_EVENTS)}, '', NULL FROM {EVENTS} WHERE value > 10
    UNION ALL
    SELECT 'whs', 'sales', 'documents', count(*), {_text(ALL_DOCUMENTS)}, '', NULL FROM documents"""
ORACLE["export_run_at_source"] = ORACLE["export_run_lines"]
ALL_ORDERS = _sums("o_totalprice", "o_orderkey") + _extremes(*ORDER_COLUMNS)
KEPT = """CASE month(o_orderdate) WHEN 1 THEN o_orderstatus <> 'P' WHEN 12 THEN o_totalprice < 0 ELSE true END"""
ORACLE["export_run_family"] = f"""
    WITH kept AS (SELECT *, {MONTH} AS "table" FROM {ORDERS}),
    months AS (SELECT DISTINCT "table" FROM kept UNION ALL SELECT 'orders_1_prt_p190001'),
    found AS (SELECT "table", count(*) AS n, {_text(ALL_ORDERS)} AS metrics FROM kept WHERE {KEPT} GROUP BY "table"),
    nothing AS (SELECT {_text(ALL_ORDERS)} AS metrics FROM kept WHERE false)
    SELECT m."table", 'whs|sales|' || m."table" || '|' || coalesce(n, 0) || '|' || coalesce(f.metrics, nothing.metrics) AS line, 'SUCCESS' AS status
    FROM months m LEFT JOIN found f ON m."table" = f."table", nothing"""
ORACLE["log_rerun"] = """
    SELECT CAST(c_custkey % 3 + 1 AS VARCHAR) AS execution_id, 'cust_' || c_custkey AS "table",
           CASE WHEN c_acctbal > 0 OR c_custkey % 3 = 1 THEN 'completed' ELSE 'failed' END AS status
    FROM customer"""
ODD = "text || ' |,MAX(text):%2C' || chr(13) || chr(10) || 'MIN_MAX_STATUS: '"
ORACLE["export_run_escaped"] = _long(
    f"(SELECT * REPLACE ({ODD} AS text) FROM documents)", _sums("n_chars") + _extremes("text", "lang"), "source", by="source"
)
CUSTOMER_TYPE, CUSTOMER_ORDERED = _pick("c_custkey", [t[0] for t in TYPES]), _pick("c_custkey", [t[1] for t in TYPES])
ORACLE["type_map_files"] = f"""
    SELECT 'cust' || repeat('_long', CAST(c_nationkey % 4 AS INTEGER)) AS "table", 'c_' || c_custkey AS col, lower(trim({CUSTOMER_TYPE})) AS source_type,
           CASE WHEN c_acctbal > 0 THEN {CUSTOMER_ORDERED} ELSE 0 END AS ordered
    FROM customer"""
ORACLE["success_log_files"] = """
    SELECT 'sales_f' AS "schema", 'cust_' || o_custkey AS "table", '/land, all/' || o_orderkey AS file_path,
           CAST(NULL AS VARCHAR) AS reason, CAST(1 AS BIGINT) AS n
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1
    UNION ALL
    SELECT 'sales_o', 'cust_' || o_custkey, '/land, all/' || o_orderkey, NULL, 1
    FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1
    UNION ALL
    SELECT NULL, NULL, NULL, 'The log has no header', count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0
    UNION ALL
    SELECT NULL, NULL, NULL, 'The row ends before the table''s name and status', count(*)
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' HAVING count(*) > 0"""
ORACLE["latest_second_run"] = """
    SELECT 'cust_' || o_custkey AS "table", '/land/' || o_orderkey AS file_path FROM orders WHERE o_orderstatus <> 'P'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1
    UNION ALL
    SELECT 'cycle 1', CAST(count(DISTINCT year(o_orderdate)) - 2 AS VARCHAR) FROM orders
    UNION ALL
    SELECT * FROM (VALUES ('cycle 2', '2'), ('cycle 3', '0')) AS c(cycle, n)"""
ORACLE["incremental_second_run"] = f"""
    WITH flags AS (
        SELECT l_returnflag AS flag, count(*) AS n, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS total,
               row_number() OVER (ORDER BY l_returnflag) = 1 AS is_first, row_number() OVER (ORDER BY l_returnflag DESC) = 1 AS is_last
        FROM {LINEITEM} GROUP BY l_returnflag),
    cycles AS (
        SELECT cycle, flag, n, CASE WHEN is_last AND cycle >= 3 THEN 2 * total ELSE total END AS total,
               CASE cycle WHEN 1 THEN 'new' WHEN 3 THEN CASE WHEN is_last THEN 'newer' WHEN is_first THEN 'missing' ELSE 'current' END ELSE 'current' END AS reason
        FROM flags, (VALUES (1), (2), (3), (4)) AS c(cycle))
    SELECT cycle, 'lineitem_1_prt_' || flag AS "table", reason, CASE reason WHEN 'current' THEN 'CURRENT' ELSE 'COPIED' END AS status,
           CAST(n AS VARCHAR) AS n, CAST(CAST(total AS DECIMAL(38,2)) AS VARCHAR) AS total
    FROM cycles
    UNION ALL
    SELECT 4, 'nowhere', NULL, 'FAILED', NULL, NULL"""
ORACLE["export_run_status"] = """
    SELECT * FROM (VALUES ('lineitem', 'SUCCESS', '-'), ('events', 'SUCCESS', '-'),
        ('documents', 'WARNING', 'Count/Sum successful, unable to process min/max because the data type mapping file was not found.'),
        ('customer', 'FAILED', 'Column ''no_such_column'' not found'), ('part', 'SKIPPED', 'No Config'),
        ('nothing_here', 'FAILED', 'no such path')) AS r("table", status, remark)"""
YEARS = f"""years AS (
        SELECT 'orders_1_prt_' || year(o_orderdate) AS "table", count(*) AS source_count,
               count(*) FILTER (NOT (year(o_orderdate) = 1996 AND o_orderpriority = '5-LOW')) AS copy_count,
               sum(o_totalprice) AS total, min(o_totalprice) AS t0, max(o_totalprice) AS t1, sum(o_orderkey) AS keys,
               min(o_orderkey) AS k0, max(o_orderkey) AS k1, min(o_custkey) AS c0, max(o_custkey) AS c1,
               min(o_orderstatus) AS s0, max(o_orderstatus) AS s1, min(o_orderdate) AS d0, max(o_orderdate) AS d1,
               min(o_orderpriority) AS p0, max(o_orderpriority) AS p1
        FROM {ORDERS} GROUP BY 1),
    copied AS (
        SELECT 'orders_1_prt_' || year(o_orderdate) AS "table", sum(price) AS total, min(price) AS t0, max(price) AS t1,
               sum(o_orderkey) AS keys, min(o_orderkey) AS k0, max(o_orderkey) AS k1, min(o_custkey) AS c0, max(o_custkey) AS c1,
               min(o_orderstatus) AS s0, max(o_orderstatus) AS s1, min(o_orderdate) AS d0, max(o_orderdate) AS d1,
               min(o_orderpriority) AS p0, max(o_orderpriority) AS p1
        FROM (SELECT *, CASE WHEN year(o_orderdate) = 1997 AND o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS price
              FROM {ORDERS} WHERE NOT (year(o_orderdate) = 1996 AND o_orderpriority = '5-LOW'))
        GROUP BY 1),
    wrong AS (
        SELECT y."table", source_count, copy_count,
               {' + '.join(f'CAST(y.{m} <> c.{m} AS INTEGER)' for m in ('total', 't0', 't1', 'keys', 'k0', 'k1', 'c0', 'c1', 's0', 's1', 'd0', 'd1', 'p0', 'p1'))}
               AS mismatched
        FROM years y JOIN copied c ON y."table" = c."table"),
    run AS (
        SELECT "table", source_count, copy_count, CAST(14 AS BIGINT) AS total_metrics, CAST(mismatched AS BIGINT) AS mismatch_metrics,
               CASE WHEN source_count = copy_count AND mismatched = 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
               CASE WHEN source_count <> copy_count THEN 'Count Mismatch' WHEN mismatched = 0 THEN 'Success'
                    ELSE 'Data Mismatch (' || mismatched || '/14)' END AS remark
        FROM wrong
        UNION ALL
        SELECT 'customer', count(*), count(*), 1, 0, 'WARNING', 'Success | {NOTE}' FROM customer
        UNION ALL
        SELECT 'gone', 0, 0, 0, 0, 'FAILED',
               'Source Parquet Not Found (Check Mount/Path) | Local path not found or inaccessible: /copy/gone'
        UNION ALL
        SELECT 'part', 0, 0, 0, 0, 'SKIPPED', 'SKIPPED: Status is not SUCCEEDED in any log files')"""
ORACLE["reconcile_run"] = f"WITH {YEARS} SELECT * FROM run"
ORACLE["reconcile_run_logs"] = f"""
    WITH {YEARS}
    SELECT 'run-1' AS execution_id, lower(status) AS outcome, count(*) AS n FROM run GROUP BY status
    UNION ALL
    SELECT 'run-1', outcome, CAST(n AS BIGINT) FROM (
        SELECT unnest([{{'outcome': 'Matched', 'n': sum(total_metrics - mismatch_metrics)}},
                       {{'outcome': 'Mismatch', 'n': sum(mismatch_metrics)}}], recursive := true) FROM run)"""
