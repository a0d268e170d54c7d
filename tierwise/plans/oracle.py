"""ANSI SQL (DuckDB dialect) for every driver query: the correctness oracle.

Written independently of the DataFrame code, in the most direct form (window
ROW_NUMBER, correlated scalar sub-queries, EXCEPT), so that it checks the
Spark plans rather than mirroring them.  Tables are the pre-registered views.
"""

from __future__ import annotations

from .main_products import MAIN_ORACLE
from .product_queries import PRODUCT_ORACLE

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"

_LINE_ORDER = ("l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
               "l_tax, l_returnflag, l_linestatus")

_DEDUP_LINEITEM = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate ASC NULLS LAST,
                                            {", ".join(c.strip() + " ASC NULLS FIRST" for c in _LINE_ORDER.split(",")[1:])}) AS rn
      FROM lineitem) WHERE rn = 1
"""

_ORDERS_B = """
(WITH b AS (
   SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
          CASE WHEN o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'
               THEN '3-MEDIUM' ELSE o_orderpriority END AS o_orderpriority
   FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
 SELECT * FROM b UNION ALL SELECT * FROM b WHERE o_orderdate < TIMESTAMP '1995-02-01 00:00:00')
"""


def _billing(li: str) -> str:
    return f"""
SELECT 'PED' AS block_tag, l.l_orderkey, l.l_linenumber,
       CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS item_key,
       l.l_quantity AS qty, l.l_extendedprice AS gross_value, CAST(NULL AS DOUBLE) AS tax_value,
       l.l_extendedprice * (1 - l.l_discount) AS net_value, o.o_orderdate AS event_date
FROM {li} l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'O'
UNION ALL
SELECT 'VEN', l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR),
       l_quantity, l_extendedprice, l_extendedprice * l_tax,
       l_extendedprice * (1 - l_discount) + l_extendedprice * l_tax, l_shipdate
FROM {li} WHERE l_returnflag = 'N'
UNION ALL
SELECT 'SER', l_orderkey, l_linenumber, 'S' || CAST(l_partkey AS VARCHAR), l_quantity, l_extendedprice,
       CAST(NULL AS DOUBLE), l_extendedprice * (1 - l_discount), l_shipdate
FROM {li} WHERE l_returnflag = 'A'
UNION ALL
SELECT 'DEV', l_orderkey, l_linenumber,
       CAST(l_partkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) || '/R',
       0 - l_quantity, 0 - l_extendedprice, 0 - l_extendedprice * l_tax, 0 - l_extendedprice * (1 - l_discount),
       l_shipdate
FROM {li} WHERE l_returnflag = 'R'
"""


def _merged_profile(table: str, cols: list[tuple[str, str, str]]) -> str:
    parts = []
    for i, (c, kind, sink) in enumerate(cols, start=1):
        text = kind == "string"
        longest = f"CAST(MAX(length({c})) AS INTEGER)" if text else "CAST(NULL AS INTEGER)"
        sink = f"'VARCHAR(' || CAST({longest} + 20 AS VARCHAR) || ')'" if text else f"'{sink}'"
        blank, digits = (f"COUNT(*) FILTER (WHERE trim({c}) = '')", f"COUNT(*) FILTER (WHERE regexp_matches({c}, '^[0-9]+$'))") if text else ("CAST(NULL AS BIGINT)",) * 2
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, {i} AS ordinal, '{kind}' AS data_type, COUNT(*) AS n_rows, "
                     f"COUNT(*) - COUNT({c}) AS n_nulls, {blank} AS n_blank, {digits} AS n_digits, "
                     f"{'CAST(MIN(length(' + c + ')) AS INTEGER)' if text else 'CAST(NULL AS INTEGER)'} AS min_length, {longest} AS max_length, "
                     f"{sink} AS sink_type FROM {table}")
    return "\nUNION ALL\n".join(parts)


_WHOLE, _REAL, _TEXT, _TIME = ("bigint", "INTEGER"), ("double", "NUMERIC(38,10)"), ("string", ""), ("timestamp_ntz", "DATETIME")
# column, old type, new type, common type, lost values (NULL: a common type decides)
_DRIFT = [("grow", "int", "bigint", "bigint", None), ("keep", "bigint", "int", "bigint", None),
          ("cents", "decimal(8,2)", "decimal(12,4)", "decimal(12,4)", None), ("day", "date", "timestamp_ntz", "timestamp_ntz", None),
          ("money", "decimal(10,2)", "double", None, "COUNT(*) FILTER (WHERE COALESCE(CAST(TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) <> o_totalprice, o_totalprice IS NOT NULL))"),
          ("half", "bigint", "double", None, "COUNT(*) FILTER (WHERE o_orderkey % 3 = 0)"),
          ("code", "bigint", "string", None, "COUNT(*) FILTER (WHERE CAST(CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS VARCHAR) <> CAST(o_custkey AS VARCHAR))"),
          ("word", "int", "string", None, "COUNT(*) FILTER (WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL)"),
          ("text", "string", "bigint", None, "COUNT(*) FILTER (WHERE CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) <> o_orderkey)")]


def _drift_types() -> str:
    def row(policy, name, old, new, target, action, lost="CAST(NULL AS BIGINT)"):
        q = ["CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in (old, new, target)]
        return (f"SELECT '{policy}' AS policy, '{name}' AS column_name, {q[0]} AS old_type, {q[1]} AS new_type, {q[2]} AS target_type, "
                f"'{action}' AS action, {lost} AS lost_rows" if lost.startswith("CAST(NULL") else
                f"SELECT '{policy}' AS policy, '{name}' AS column_name, {q[0]} AS old_type, {q[1]} AS new_type, "
                f"CASE WHEN {lost} = 0 THEN {q[2]} END AS target_type, CASE WHEN {lost} = 0 THEN '{action}' ELSE 'refused' END AS action, {lost} AS lost_rows FROM orders")
    out = [row("fail", n, old, new, None, "refused") for n, old, new, _, _ in _DRIFT]
    out += [row("fail", "gone", "string", None, None, "refused"), row("fail", "more", None, "string", None, "refused")]
    for policy in ("widen", "lossless"):
        out += [row(policy, "gone", "string", None, "string", "missing"), row(policy, "more", None, "string", "string", "added")]
        for n, old, new, both, lost in _DRIFT:
            if both:
                out.append(row(policy, n, old, new, both, "kept" if both == old else "widened"))
            elif policy == "widen":
                out.append(row(policy, n, old, new, None, "refused"))
            else:
                out.append(row(policy, n, old, new, old, "narrowed", lost))
    return "\nUNION ALL\n".join(out)


def _profile(table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, kind) in enumerate(cols, start=1):
        if kind == "text":
            m = f"CAST(MAX(length({c})) AS INTEGER)"
            sink = (f"CASE WHEN {m} IS NULL OR {m} = 0 THEN 'VARCHAR(100)' WHEN {m} > 4000 THEN 'CLOB' "
                    f"ELSE 'VARCHAR(' || CAST({m} + 20 AS VARCHAR) || ')' END")
        else:
            m = "CAST(MAX(NULL) AS INTEGER)"
            sink = "'INTEGER'" if kind == "int" else "'NUMERIC(38,10)'"
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, {i} AS ordinal, "
                     f"{m} AS max_length, {sink} AS sink_type FROM {table}")
    return "\nUNION ALL\n".join(parts)


def _dictionary(table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, kind) in enumerate(cols, start=1):
        if kind == "text":
            dt, ln, pr, sc = "'VARCHAR2'", f"CAST(MAX(length({c})) AS INTEGER)", "CAST(NULL AS INTEGER)", "CAST(NULL AS INTEGER)"
        elif kind == "int":
            dt, ln, pr, sc = "'NUMBER'", "CAST(NULL AS INTEGER)", f"CAST(MAX(length(CAST(abs({c}) AS VARCHAR))) AS INTEGER)", "0"
        elif kind == "double":
            dt, ln, pr, sc = "'NUMBER'", "CAST(MAX(NULL) AS INTEGER)", "18", "2"
        else:
            dt, ln, pr, sc = "'DATE'", "CAST(MAX(NULL) AS INTEGER)", "CAST(NULL AS INTEGER)", "CAST(NULL AS INTEGER)"
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, {i} AS column_id, {dt} AS data_type, "
                     f"{ln} AS data_length, CAST({pr} AS INTEGER) AS data_precision, "
                     f"CAST({sc} AS INTEGER) AS data_scale FROM {table}")
    return "\nUNION ALL\n".join(parts)


_ORDERS_COLS = [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "text"),
                ("o_totalprice", "double"), ("o_orderdate", "date"), ("o_orderpriority", "text")]
_LINE_COLS = [("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
              ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
              ("l_tax", "double"), ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "date")]

_INT = "(data_type = 'NUMBER' AND (data_scale IS NULL OR data_scale = 0) AND (data_precision IS NULL OR data_precision <= 18))"


def _full_days(a: str, b: str) -> str:
    return (f"(date_diff('day', CAST({b} AS DATE), CAST({a} AS DATE)) - "
            f"CASE WHEN strftime({a}, '%H:%M:%S.%f') < strftime({b}, '%H:%M:%S.%f') THEN 1 ELSE 0 END)")


def _count_check(name, src, tgt, scope="TRUE", widened=None, multi_writer=False):
    w = f"COUNT(*) FILTER (WHERE {widened})" if widened else "CAST(NULL AS BIGINT)"
    mw = "TRUE" if multi_writer else "FALSE"
    return f"""
SELECT '{name}' AS table_name, s.source_count, t.target_count,
       CASE WHEN s.source_count = t.target_count THEN 'OK'
            WHEN {mw} AND t.target_count > s.source_count THEN 'OK' ELSE 'DIVERGENTE' END AS status,
       s.widened_count, COALESCE(s.widened_count > s.source_count, FALSE) AS alert
FROM (SELECT COUNT(*) FILTER (WHERE {scope}) AS source_count, {w} AS widened_count FROM {src}) s,
     (SELECT COUNT(*) AS target_count FROM {tgt}) t
"""


_COUNT_CHECK = (_count_check("orders", "orders", "(SELECT * FROM orders WHERE o_orderstatus IN ('F','O'))",
                             "o_orderstatus IN ('F','O')")
                + " UNION ALL " + _count_check("lineitem", "lineitem", f"({_DEDUP_LINEITEM})"))
_COUNT_WIDENED = (_count_check("customer", "customer",
                               "(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 5)",
                               "c_mktsegment = 'BUILDING' AND c_nationkey < 5", "c_mktsegment = 'BUILDING'")
                  + " UNION ALL " + _count_check("supplier", "supplier", "supplier", "s_nationkey < 10",
                                                 multi_writer=True))
_KEYLESS_COUNT = (_count_check("events", "events",
                               "(SELECT * FROM events WHERE event_type IN ('view','click','purchase'))",
                               "event_type IN ('view','click','purchase')")
                  + " UNION ALL " + _count_check("conversations", "conversations",
                                                 "(SELECT * FROM conversations WHERE role IS NOT NULL)"))

_STABLE_KEEP = """
((block_tag = 'PED' AND event_date >= TIMESTAMP '2001-01-01 00:00:00')
 OR (block_tag = 'VEN' AND event_date > TIMESTAMP '2001-01-01 00:00:00')
 OR (block_tag = 'SER' AND event_date >= TIMESTAMP '2001-03-01 00:00:00')
 OR (block_tag = 'DEV' AND event_date >= TIMESTAMP '2001-03-01 00:00:00'))
AND CASE WHEN block_tag IN ('DEV') THEN CAST(event_date AS DATE) < DATE '2001-11-01'
         ELSE event_date <= TIMESTAMP '2001-11-03 00:00:00' END
"""

ORACLE: dict[str, str] = {
    "scoped_lookback": f"""
SELECT * FROM orders
WHERE o_orderstatus IN ('F','O') AND o_orderdate >= {AS_OF} - INTERVAL 60 DAY""",

    "lookback_fallback": f"""
WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS TIMESTAMP)
                          ELSE o_orderdate + INTERVAL 2 DAY END AS o_changed FROM orders)
SELECT o_orderkey, o_orderstatus, o_orderdate, o_changed,
       CASE WHEN o_changed IS NULL THEN 'fallback' ELSE 'audit' END AS window_source
FROM o WHERE COALESCE(o_changed, o_orderdate) >= {AS_OF} - INTERVAL 60 DAY""",

    "lookback_sentinel": f"""
WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1900-12-31 00:00:00'
                          ELSE o_orderdate END AS o_audit FROM orders)
SELECT o_orderkey, o_orderstatus, o_audit, o_orderdate FROM o
WHERE o_audit >= {AS_OF} - INTERVAL 60 DAY OR CAST(o_audit AS DATE) = DATE '1900-12-31'""",

    "override_priority": """
WITH by_id AS (SELECT * FROM (VALUES (3, 'NATION THREE (BY ID)'), (7, 'NATION SEVEN (BY ID)')) t(o_id, id_name)),
by_name AS (SELECT * FROM (VALUES ('NATION_3', 'NATION THREE (BY NAME)'), ('NATION_11', 'NATION ELEVEN (BY NAME)'))
            t(o_name, name_name))
SELECT n.n_nationkey, n.n_name, COALESCE(i.id_name, m.name_name, upper(replace(n.n_name, '_', ' '))) AS display_name,
       CASE WHEN i.id_name IS NOT NULL THEN 'id' WHEN m.name_name IS NOT NULL THEN 'name' ELSE 'default' END AS name_source
FROM nation n LEFT JOIN by_id i ON n.n_nationkey = i.o_id LEFT JOIN by_name m ON lower(n.n_name) = lower(m.o_name)""",

    "key_universe": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus IN ('O')",

    "column_profile": _profile("customer", [("c_custkey", "int"), ("c_name", "text"), ("c_nationkey", "int"),
                                            ("c_acctbal", "double"), ("c_mktsegment", "text")])
    + "\nUNION ALL\n"
    + _profile("part", [("p_partkey", "int"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"),
                        ("p_size", "int"), ("p_retailprice", "double")]),

    "merged_profiles": _merged_profile("lineitem", [
        ("l_orderkey", *_WHOLE), ("l_partkey", *_WHOLE), ("l_suppkey", *_WHOLE), ("l_linenumber", "int", "INTEGER"), ("l_quantity", *_REAL),
        ("l_extendedprice", *_REAL), ("l_discount", *_REAL), ("l_tax", *_REAL), ("l_returnflag", *_TEXT), ("l_linestatus", *_TEXT),
        ("l_shipdate", *_TIME)]) + "\nUNION ALL\n" + _merged_profile("orders", [
            ("o_orderkey", *_WHOLE), ("o_custkey", *_WHOLE), ("o_orderstatus", *_TEXT), ("o_totalprice", *_REAL), ("o_orderdate", *_TIME),
            ("o_orderpriority", *_TEXT)]),

    "multi_scope": """
SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey, n.n_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment IN ('BUILDING','MACHINERY') AND c.c_nationkey NOT IN (0, 1)""",

    "declared_schema": f"""
WITH d AS ({_dictionary("orders", _ORDERS_COLS)} UNION ALL {_dictionary("lineitem", _LINE_COLS)})
SELECT *,
  CASE WHEN {_INT} THEN 'INTEGER'
       WHEN data_type = 'NUMBER' THEN 'NUMERIC(' || CAST(COALESCE(data_precision, 38) AS VARCHAR) || ','
                                      || CAST(COALESCE(data_scale, 10) AS VARCHAR) || ')'
       WHEN data_type = 'DATE' THEN 'DATETIME'
       WHEN data_length > 4000 THEN 'CLOB'
       ELSE 'VARCHAR(' || CAST(COALESCE(data_length, 0) + 10 AS VARCHAR) || ')' END AS sink_type,
  CASE WHEN {_INT} THEN 'bigint'
       WHEN data_type = 'NUMBER' THEN 'decimal(' || CAST(COALESCE(data_precision, 38) AS VARCHAR) || ','
                                      || CAST(COALESCE(data_scale, 10) AS VARCHAR) || ')'
       WHEN data_type = 'DATE' THEN 'timestamp_ntz' ELSE 'string' END AS spark_type
FROM d""",

    "dedup_first": _DEDUP_LINEITEM,

    "key_grain_report": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",

    "upsert_snapshot": """
WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'),
batch AS (SELECT o_orderkey, o_custkey,
                 CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                 o_totalprice, o_orderdate, o_orderpriority
          FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-01 00:00:00')
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL SELECT * FROM batch""",

    "insert_if_absent": """
WITH target AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders
                WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')
SELECT * FROM target
UNION ALL
SELECT DISTINCT o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_custkey = o.o_custkey AND t.o_orderstatus = o.o_orderstatus)""",

    "orphan_sweep": "SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",

    "orphan_sweep_scoped": """
SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'O' OR o_orderkey IN (SELECT l_orderkey FROM lineitem)""",

    "range_sweep": """
SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'O' OR o_orderkey IN (SELECT l_orderkey FROM lineitem)""",

    "range_sweep_removed": """
SELECT l.* FROM lineitem l WHERE NOT EXISTS (
    SELECT 1 FROM lineitem x JOIN orders o ON x.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE c.c_acctbal > -900 AND x.l_orderkey = l.l_orderkey AND x.l_partkey = l.l_partkey)""",

    "tie_break_reference": """
WITH ref AS (SELECT DISTINCT l_partkey FROM lineitem
             WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2001-06-01 00:00:00'),
j AS (SELECT p.*, CASE WHEN r.l_partkey IS NULL THEN 1 ELSE 0 END AS prio
      FROM part p LEFT JOIN ref r ON r.l_partkey = p.p_partkey)
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY prio, p_partkey) AS rn FROM j)
WHERE rn = 1""",

    "safe_key": """
WITH ls AS (SELECT DISTINCT l_orderkey, l_linestatus FROM lineitem)
SELECT o.o_orderstatus, COALESCE(ls.l_linestatus, ' ') AS line_status_key, COUNT(*) AS n_rows
FROM orders o LEFT JOIN ls ON ls.l_orderkey = o.o_orderkey
GROUP BY 1, 2""",

    "full_refresh_audit": f"""
WITH src2 AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
w AS (SELECT * FROM src2 WHERE o_orderdate >= {AS_OF} - INTERVAL 60 DAY)
SELECT 1 AS run, 'orders' AS table_name, 'first_load' AS strategy,
       COUNT(*) AS extracted, COUNT(*) AS inserted, CAST(0 AS BIGINT) AS updated,
       COUNT(*) AS saved, CAST(0 AS BIGINT) AS removed, 'OK' AS status
FROM orders
UNION ALL
SELECT 2, 'orders', 'window_merge+sweep',
       (SELECT COUNT(*) FROM w), CAST(0 AS BIGINT), (SELECT COUNT(DISTINCT o_orderkey) FROM w),
       (SELECT COUNT(*) FROM src2),
       (SELECT COUNT(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src2)), 'OK'""",

    "refresh_content": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate >= {AS_OF} - INTERVAL 60 DAY THEN 'X-' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderdate >= {AS_OF} - INTERVAL 60 DAY THEN {AS_OF} ELSE TIMESTAMP '2001-07-01 00:00:00' END AS "DW_DATA_INGESTAO"
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",

    "partitioned_content": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-06-10 00:00:00' THEN o_orderdate + INTERVAL 31 DAY ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderdate >= {AS_OF} - INTERVAL 60 DAY THEN 'X-' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderdate >= {AS_OF} - INTERVAL 60 DAY THEN {AS_OF} ELSE TIMESTAMP '2001-07-01 00:00:00' END AS "DW_DATA_INGESTAO"
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",

    "stream_content": f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
       o_orderpriority, {AS_OF} AS "DW_DATA_INGESTAO"
FROM orders""",

    "stream_late": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + INTERVAL 10 DAY ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN 'N-' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority,
       {AS_OF} AS "DW_DATA_INGESTAO"
FROM orders""",

    "keyless_content": f"""
SELECT * REPLACE (s_acctbal + 1 AS s_acctbal), {AS_OF} AS "DW_DATA_INGESTAO" FROM supplier WHERE s_nationkey % 2 = 0""",

    "empty_batch_content": """
SELECT *, TIMESTAMP '2001-07-01 00:00:00' AS "DW_DATA_INGESTAO" FROM customer""",

    "load_statuses": """
WITH o AS (SELECT COUNT(*) AS n FROM orders), c AS (SELECT COUNT(*) AS n FROM customer), s AS (SELECT COUNT(*) AS n FROM supplier),
l AS (SELECT COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS u FROM lineitem)
SELECT 'orders' AS table_name, 'first_load' AS strategy, n AS extracted, n AS inserted, CAST(0 AS BIGINT) AS updated, n AS saved,
       CAST(0 AS BIGINT) AS removed, 'OK' AS status FROM o
UNION ALL SELECT 'lineitem', 'first_load', n, u, 0, u, 0, CASE WHEN n = u THEN 'OK' ELSE 'DIVERGENT' END FROM l
UNION ALL SELECT 'broken', 'error', 0, 0, 0, 0, 0, 'ERROR: OSError'
UNION ALL SELECT 'kept', 'snapshot_merge', 0, 0, 0, n, 0, 'EMPTY_BATCH_KEPT_OLD' FROM c
UNION ALL SELECT 'view', 'keyless_replace', n, n, 0, n, 0, 'OK' FROM s""",

    "partitioned_refresh": f"""
WITH first AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00'),
w AS (SELECT * FROM orders WHERE o_orderdate >= {AS_OF} - INTERVAL 60 DAY)
SELECT 1 AS run, 'first_load' AS strategy, COUNT(*) AS extracted, COUNT(*) AS inserted,
       CAST(0 AS BIGINT) AS updated, COUNT(*) AS saved,
       COUNT(DISTINCT strftime(o_orderdate, '%Y%m')) AS partitions,
       COUNT(DISTINCT strftime(o_orderdate, '%Y%m')) AS partitions_rewritten
FROM first
UNION ALL
SELECT 2, 'window_merge@partitions', (SELECT COUNT(*) FROM w),
       (SELECT COUNT(*) FROM w WHERE o_orderkey NOT IN (SELECT o_orderkey FROM first)),
       (SELECT COUNT(*) FROM w WHERE o_orderkey IN (SELECT o_orderkey FROM first)),
       (SELECT COUNT(*) FROM orders), (SELECT COUNT(DISTINCT strftime(o_orderdate, '%Y%m')) FROM orders),
       (SELECT COUNT(DISTINCT strftime(o_orderdate, '%Y%m')) FROM w)""",

    "drift_align": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(NULL AS INTEGER) AS o_year
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER)
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'""",

    "drift_types": _drift_types(),

    "heavy_key_join": """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
                  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 THEN ' ' WHEN l_orderkey % 3 = 0 THEN '1'
                       ELSE CAST(l_suppkey AS VARCHAR) END AS serial FROM lineitem)
SELECT l.*, s.s_name, s.s_nationkey FROM l LEFT JOIN supplier s ON l.serial = CAST(s.s_suppkey AS VARCHAR)""",

    "sheet_rejects": """
WITH s AS (SELECT s_nationkey AS nation, 1 + row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS line, s_suppkey, s_name,
                  s_suppkey % 11 = 0 AS short, s_suppkey % 5 = 0 AS bad, s_suppkey % 7 = 0 AS blank, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS money
           FROM supplier)
SELECT nation, line, 'row' AS kind, CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS VARCHAR) AS text, s_suppkey, s_name || ', Ltd' AS name,
       CASE WHEN NOT bad AND NOT blank THEN money END AS balance FROM s WHERE NOT short
UNION ALL SELECT nation, line, 'reject', 'balance', 'n/a', NULL, NULL, NULL FROM s WHERE bad AND NOT short
UNION ALL SELECT nation, line, 'reject', '*', CAST(s_suppkey AS VARCHAR) || ',cut', NULL, NULL, NULL FROM s WHERE short""",

    "project_rename": """
SELECT p_partkey AS PRODUCT_ID, trim(p_name) AS PRODUCT_NAME, trim(p_brand) AS BRAND,
       CASE trim(p_type) WHEN 'ECONOMY' THEN 'Economy' WHEN 'SMALL' THEN 'Small'
                         WHEN 'LARGE' THEN 'Large' WHEN 'PROMO' THEN 'Promo' ELSE 'Other' END AS TYPE_LABEL,
       p_size AS SIZE,
       CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 30 THEN 'M' ELSE 'L' END AS SIZE_CLASS,
       p_retailprice AS PRICE
FROM part""",

    "predicate_mix": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate,
       l.l_shipdate > TIMESTAMP '2000-06-01 00:00:00' AS strict_after,
       strftime(l.l_shipdate, '%Y%m%d') > '20000601' AS text_after,
       (l.l_returnflag IS NOT NULL AND l.l_returnflag <> ' ') AS has_flag
FROM lineitem l
WHERE l.l_shipdate >= TIMESTAMP '2000-06-01 00:00:00'
  AND ((l.l_returnflag = 'A' AND l.l_linestatus = 'F') OR (l.l_returnflag = 'N' AND l.l_linestatus = 'O'))
  AND CAST(l.l_partkey AS VARCHAR) > '1000' AND CAST(l.l_partkey AS VARCHAR) < '1500'
  AND EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
  AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size > 45)""",

    "star_enrichment": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
       o.o_orderdate, o.o_orderstatus, c.c_name, cn.n_name AS cust_nation, cr.r_name AS cust_region,
       s.s_name, sn.n_name AS supp_nation, sr.r_name AS supp_region
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey""",

    "inner_chain": """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_orderdate, c.c_name, n.n_name
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_regionkey = 1""",

    "keyed_expression_join": """
WITH base AS (SELECT c_nationkey, c_mktsegment, MIN(c_custkey) AS b FROM customer GROUP BY 1, 2),
cb AS (SELECT c.*, CASE WHEN base.b = c.c_custkey THEN CAST(NULL AS BIGINT) ELSE base.b END AS group_base
       FROM customer c LEFT JOIN base ON base.c_nationkey = c.c_nationkey AND base.c_mktsegment = c.c_mktsegment),
owners AS (SELECT seg, upper(substr(seg, 1, 3)) AS owner_code
           FROM (SELECT DISTINCT lower(c_mktsegment) AS seg FROM customer))
SELECT cb.c_custkey, cb.group_base, b.c_name AS base_name, n.n_name AS region2_nation, owners.owner_code
FROM cb
LEFT JOIN customer b ON COALESCE(cb.group_base, cb.c_custkey) = b.c_custkey
LEFT JOIN nation n ON n.n_nationkey = cb.c_nationkey AND n.n_regionkey = 2
LEFT JOIN owners ON lower(cb.c_mktsegment) = owners.seg""",

    "aggregate_join": """
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS ship_day, l.l_quantity,
       CAST((SELECT SUM(CAST(x.l_quantity AS DECIMAL(18,2))) FROM lineitem x
             WHERE x.l_orderkey = l.l_orderkey) AS DOUBLE) AS order_qty,
       CAST((SELECT SUM(CAST(x.l_quantity AS DECIMAL(18,2))) FROM lineitem x
             WHERE x.l_orderkey = l.l_orderkey
               AND CAST(x.l_shipdate AS DATE) = CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS same_day_qty
FROM lineitem l""",

    "interval_rate": """
WITH q AS (SELECT o_orderstatus AS centre, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS d0,
                  COUNT(*) AS rate FROM orders GROUP BY 1, 2),
y AS (SELECT o_orderstatus AS centre, CAST(date_trunc('year', o_orderdate) AS DATE) AS d0,
             COUNT(DISTINCT o_custkey) AS rate FROM orders GROUP BY 1, 2),
r AS (SELECT centre, d0, CAST(d0 + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS d1, rate FROM q
      UNION ALL
      SELECT centre, d0, CAST(d0 + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE) AS d1, rate FROM y),
j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_linestatus, CAST(l.l_shipdate AS DATE) AS ship_day, l.l_quantity,
             CAST(COALESCE((SELECT SUM(r.rate) FROM r WHERE r.centre = l.l_linestatus
                             AND r.d0 <= CAST(l.l_shipdate AS DATE) AND r.d1 >= CAST(l.l_shipdate AS DATE)), 0)
                  AS DOUBLE) AS rate
      FROM lineitem l)
SELECT l_orderkey, l_linenumber, l_linestatus, ship_day, rate, l_quantity * rate AS cost FROM j""",

    "interval_rate_long": """
WITH r AS (
    SELECT o_orderstatus AS k, o_orderdate + to_seconds(o_custkey % 86400) AS t0, o_totalprice, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
i AS (SELECT k, t0, CASE WHEN o_totalprice > 100000 THEN TIMESTAMP '9999-12-31' ELSE t0 + INTERVAL 50 YEAR END AS t1, v FROM r),
s AS (SELECT k, t0 AS t, SUM(SUM(v)) OVER (PARTITION BY k ORDER BY t0) AS started FROM i GROUP BY k, t0),
e AS (SELECT k, t1 AS t, SUM(SUM(v)) OVER (PARTITION BY k ORDER BY t1) AS ended FROM i GROUP BY k, t1),
m AS (
    SELECT l_orderkey, l_linenumber, l_linestatus, CASE WHEN l_linenumber % 2 = 0 THEN moment + INTERVAL 50 YEAR ELSE moment END AS read_at
    FROM (SELECT *, l_shipdate + to_seconds(l_partkey % 86400) AS moment FROM lineitem)),
j AS (SELECT m.*, s.started FROM m ASOF LEFT JOIN s ON m.l_linestatus = s.k AND m.read_at >= s.t)
SELECT j.l_orderkey, j.l_linenumber, j.l_linestatus, j.read_at, CAST(COALESCE(j.started, 0) - COALESCE(e.ended, 0) AS DOUBLE) AS rate
FROM j ASOF LEFT JOIN e ON j.l_linestatus = e.k AND j.read_at > e.t""",

    "lookup_exact_or_latest": """
SELECT p.event_id, p.user_id, p.ts,
       COALESCE((SELECT MAX(v.ts) FROM events v WHERE v.event_type = 'view' AND v.user_id = p.user_id
                   AND CAST(v.ts AS DATE) = CAST(p.ts AS DATE)),
                (SELECT MAX(v.ts) FROM events v WHERE v.event_type = 'view' AND v.user_id = p.user_id)) AS view_ts
FROM events p WHERE p.event_type = 'purchase'""",

    "lookup_reach": """
SELECT p.event_id, p.user_id, p.ts, p.value,
       (SELECT COUNT(*) FROM events v WHERE v.event_type = 'view' AND v.user_id = p.user_id
          AND v.ts >= TIMESTAMP '2024-01-08 00:00:00') AS views_in_reach,
       (SELECT MAX(v.value) FROM events v WHERE v.event_type = 'view' AND v.user_id = p.user_id
          AND v.ts >= TIMESTAMP '2024-01-08 00:00:00') AS max_view_value
FROM events p WHERE p.event_type = 'purchase' AND p.ts >= TIMESTAMP '2024-01-15 00:00:00'""",

    "scalar_lookup_avg": """
WITH po AS (SELECT o.o_orderkey, o.o_orderdate, COUNT(*) AS n_lines,
                   SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS q,
                   SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS t
            FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2),
mq AS (SELECT date_trunc('month', o_orderdate) AS m, SUM(q) AS mq
       FROM po GROUP BY 1)
SELECT po.o_orderkey, po.o_orderdate, po.n_lines, CAST(po.q AS DOUBLE) AS sum_qty,
       CAST(po.t AS DOUBLE) / po.n_lines AS avg_total, CAST(mq.mq AS DOUBLE) AS month_qty
FROM po LEFT JOIN mq ON mq.m = date_trunc('month', po.o_orderdate)""",

    "sheet_enrich": """
WITH sheet AS (SELECT p_partkey AS codpro, p_brand AS mix, p_type AS origem FROM part WHERE p_size <= 5
               UNION ALL
               SELECT p_partkey, 'MIX-' || p_type, 'EXTRA' FROM part WHERE p_type = 'SMALL' AND p_size <= 5)
SELECT p.p_partkey, p.p_name, s.mix AS MIX, s.origem AS ORIGEM
FROM part p LEFT JOIN sheet s ON s.codpro = p.p_partkey""",

    "nth_purchase": """
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY d) AS rk FROM d)
SELECT o_custkey, MIN(CASE WHEN rk = 1 THEN d END) AS first_purchase,
       MIN(CASE WHEN rk = 2 THEN d END) AS second_purchase, MIN(CASE WHEN rk = 3 THEN d END) AS third_purchase,
       MIN(CASE WHEN rk = 4 THEN d END) AS fourth_purchase, MAX(d) AS last_purchase, COUNT(*) AS n_purchase_days
FROM r GROUP BY o_custkey""",

    "first_last_by": """
WITH r AS (SELECT o_custkey, o_orderpriority,
                  ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderpriority) AS a,
                  ROW_NUMBER() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderpriority DESC) AS b
           FROM orders WHERE o_orderdate IS NOT NULL AND o_orderkey IS NOT NULL)
SELECT o_custkey, MAX(CASE WHEN a = 1 THEN o_orderpriority END) AS first_priority,
       MAX(CASE WHEN b = 1 THEN o_orderpriority END) AS last_priority
FROM r GROUP BY o_custkey""",

    "allocate_share": """
WITH c AS (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, c.n_lines,
       o.o_totalprice / NULLIF(c.n_lines, 0) AS share,
       l.l_extendedprice * (1 - l.l_discount) + o.o_totalprice / NULLIF(c.n_lines, 0) AS net_value
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN c ON c.l_orderkey = l.l_orderkey
WHERE l.l_linestatus = 'O'""",

    "billing_union": _billing("lineitem"),

    "unit_scaling": """
WITH p AS (SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'D' WHEN p_size <= 30 THEN 'H'
                                  WHEN p_size <= 45 THEN 'M' ELSE 'S' END AS unit FROM part),
s AS (SELECT p.p_partkey, p.unit, SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS sq,
             SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS sp
      FROM lineitem l JOIN p ON p.p_partkey = l.l_partkey GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN unit = 'S' THEN CAST(sq AS DOUBLE) / 60 WHEN unit = 'D' THEN CAST(sq AS DOUBLE) * 1440
                     WHEN unit = 'H' THEN CAST(sq AS DOUBLE) * 60 WHEN unit = 'M' THEN CAST(sq AS DOUBLE) * 1
                     ELSE CAST(sq AS DOUBLE) END AS minutes FROM s)
SELECT p_partkey, unit, CAST(sq AS DOUBLE) AS sum_value, minutes, minutes * CAST(sp AS DOUBLE) AS product FROM m""",

    "full_outer_budget": """
WITH b AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS b
           FROM orders GROUP BY 1),
a AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS a
      FROM lineitem GROUP BY 1)
SELECT b.m AS month_start, CAST(year(b.m) AS INTEGER) AS year,
       CASE WHEN month(b.m) BETWEEN 1 AND 3 THEN 'Q1' WHEN month(b.m) BETWEEN 4 AND 6 THEN 'Q2'
            WHEN month(b.m) BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END AS quarter_label,
       CAST(b.b AS DOUBLE) AS budget, CAST(a.a AS DOUBLE) AS actual
FROM b FULL OUTER JOIN a ON a.m = b.m WHERE b.m IS NOT NULL""",

    "trailing_months": """
WITH m AS (SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
                  SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM lineitem GROUP BY 1, 2),
w AS (SELECT *, SUM(qty) OVER (PARTITION BY l_partkey ORDER BY year(month_start) * 12 + month(month_start) - 1
                               RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS qty_6m FROM m)
SELECT l_partkey, month_start, last_day(month_start) AS month_end,
       CAST(month_start - INTERVAL 6 MONTH AS DATE) AS window_start,
       last_day(CAST(month_start - INTERVAL 1 MONTH AS DATE)) AS window_end,
       CAST(qty AS DOUBLE) AS qty, CAST(qty_6m AS DOUBLE) AS qty_6m,
       CAST(month(month_start) AS VARCHAR) || '|' || CAST(year(month_start) AS VARCHAR) || '|'
         || CAST(l_partkey AS VARCHAR) AS month_key
FROM w WHERE month_start >= DATE '2000-01-01'""",

    "trailing_refresh": """
WITH now AS (
    SELECT l_suppkey, CASE WHEN l_orderkey % 50 = 0 THEN l_shipdate + INTERVAL 40 DAY ELSE l_shipdate END AS d,
           CASE WHEN l_orderkey % 50 = 0 THEN l_quantity + 1 ELSE l_quantity END AS q
    FROM lineitem WHERE l_orderkey % 50 <> 13),
m AS (
    SELECT l_suppkey, CAST(date_trunc('month', d) AS DATE) AS month_start, SUM(CAST(q AS DECIMAL(18,2))) AS qty FROM now GROUP BY 1, 2)
SELECT a.l_suppkey, a.month_start, CAST(a.qty AS DOUBLE) AS qty,
       (SELECT CAST(SUM(b.qty) AS DOUBLE) FROM m b WHERE b.l_suppkey = a.l_suppkey
          AND b.month_start BETWEEN a.month_start - INTERVAL 6 MONTH AND a.month_start - INTERVAL 1 MONTH) AS trailing
FROM m a""",

    "balanced_ranges": """
SELECT COUNT(*) AS n_read, CAST(0 AS BIGINT) AS in_none, CAST(0 AS BIGINT) AS in_several, TRUE AS balanced FROM lineitem""",

    "previous_event": """
WITH p AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
           WHERE user_id IS NOT NULL AND trim(CAST(user_id AS VARCHAR)) <> '' AND ts IS NOT NULL),
l AS (SELECT user_id, day, LAG(day) OVER (PARTITION BY user_id ORDER BY day) AS prev_day FROM p)
SELECT user_id, day, prev_day,
       CAST(CASE WHEN prev_day IS NULL THEN 0 ELSE date_diff('day', prev_day, day) END AS INTEGER) AS days_since,
       CASE WHEN prev_day IS NULL OR date_diff('day', prev_day, day) > 3 THEN 0 ELSE 1 END AS repeat_class
FROM l WHERE day > DATE '2024-01-05'""",

    "signed_sum": """
SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(18,2))
                     ELSE -CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS signed_qty,
       COUNT(*) AS n_rows
FROM lineitem GROUP BY 1, 2 ORDER BY l_returnflag ASC NULLS LAST, ship_year ASC NULLS LAST""",

    "text_clean": """
WITH c AS (SELECT *, CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'J' ELSE 'F' END AS person_type
           FROM customer)
SELECT c_custkey, NULLIF(trim(upper(c_name)), '') AS name_upper, NULLIF(trim(lower(c_name)), '') AS name_lower,
       person_type,
       CASE WHEN person_type = 'F' THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0')
            WHEN person_type = 'J' THEN lpad(CAST(c_custkey AS VARCHAR), 14, '0')
            ELSE CAST(c_custkey AS VARCHAR) END AS tax_id,
       lpad(CAST(c_nationkey AS VARCHAR), 8, '0') AS postal_code,
       NULLIF(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS digits,
       replace(c_name, '#', ' ') AS display_name,
       CASE WHEN length(CAST(c_nationkey AS VARCHAR)) > 2 THEN '###'
            ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS nation_code,
       NULLIF(trim(c_mktsegment), '') AS segment_clean,
       COALESCE(c_name, '') || ', ' || COALESCE(CAST(c_custkey AS VARCHAR), '') AS address
FROM c""",

    "sheet_clean": """
WITH s AS (SELECT trim(CAST(doc_id AS VARCHAR)) AS DOC_ID, trim(CAST(quality AS VARCHAR)) AS QUALITY,
                  trim(CAST(toxic AS VARCHAR)) AS TOXIC FROM labels),
r AS (SELECT *, DOC_ID || '|' || QUALITY AS KEY FROM s
      WHERE DOC_ID IS NOT NULL AND DOC_ID <> '' AND lower(DOC_ID) <> 'nan'
        AND QUALITY IS NOT NULL AND QUALITY <> '' AND lower(QUALITY) <> 'nan')
SELECT r.DOC_ID, r.QUALITY, r.TOXIC, d.lang AS LANG, r.KEY,
       TRY_CAST(replace(trim(r.QUALITY), ',', '.') AS DOUBLE) AS QUALITY_NUM
FROM r LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = r.DOC_ID
WHERE trim(replace(r.KEY, '|', '')) <> ''""",

    "dates_text": f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
       strftime(o_orderdate, '%d/%m/%Y') AS order_text, strftime(o_orderdate, '%m/%Y') AS month_text,
       COALESCE(month(o_orderdate) = month({AS_OF}), FALSE) AS same_month_as_of,
       CASE WHEN o_orderstatus IN ('F') THEN CAST(o_orderdate AS DATE) END AS closed_day
FROM orders""",

    "int_text": """
WITH p AS (SELECT p_partkey, CASE WHEN p_size < 25 THEN CAST(p_retailprice AS VARCHAR)
                                  WHEN p_size < 40 THEN p_brand END AS code_raw FROM part)
SELECT p_partkey, code_raw,
       CASE WHEN code_raw IS NULL THEN ''
            WHEN TRY_CAST(code_raw AS DOUBLE) IS NOT NULL THEN CAST(CAST(trunc(TRY_CAST(code_raw AS DOUBLE)) AS BIGINT) AS VARCHAR)
            ELSE trim(code_raw) END AS code
FROM p""",

    "map_flags": """
SELECT c.c_custkey,
       CASE r.r_name WHEN 'AFRICA' THEN 'South' WHEN 'AMERICA' THEN 'West' WHEN 'ASIA' THEN 'East'
                     WHEN 'EUROPE' THEN 'North' END AS macro_region,
       CASE WHEN CAST(c.c_nationkey AS VARCHAR) IN ('0','1','2','3','4') THEN 'Nacional' ELSE 'Importado' END AS origin_class,
       CASE WHEN c.c_mktsegment = ' ' THEN 'NONE' ELSE c.c_mktsegment END AS segment_or_default,
       CASE WHEN c.c_custkey IS NULL OR c.c_nationkey IS NULL OR c.c_mktsegment IS NULL THEN NULL
            ELSE CAST(c.c_custkey AS VARCHAR) || '|' || CAST(c.c_nationkey AS VARCHAR) || '|' || c.c_mktsegment END AS rel_key
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",

    "sla_status": f"""
WITH per AS (SELECT l_orderkey, MAX(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS finish,
                    MAX(l_shipdate) AS delivered FROM lineitem GROUP BY 1),
j AS (SELECT o.o_orderkey, o.o_orderdate, per.finish, per.delivered,
             CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'CORREIO / SEDEX' WHEN o.o_orderpriority = '2-HIGH' THEN 'RETIRA'
                  WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_orderpriority END AS carrier
      FROM orders o LEFT JOIN per ON per.l_orderkey = o.o_orderkey),
k AS (SELECT *, {_full_days(AS_OF, "o_orderdate")} AS open_days, {_full_days("finish", "o_orderdate")} AS done_days,
             {_full_days("delivered", "o_orderdate")} AS dl FROM j)
SELECT o_orderkey,
       CASE WHEN finish IS NULL AND open_days > 10 THEN 'Em Aberto Atrasado'
            WHEN finish IS NULL AND open_days <= 10 THEN 'Em Aberto no Prazo'
            WHEN finish IS NOT NULL AND done_days <= 10 THEN 'Finalizado no Prazo'
            WHEN finish IS NOT NULL AND done_days > 10 THEN 'Finalizado em Atraso' END AS sla_status,
       CAST(CASE WHEN finish IS NULL THEN open_days ELSE done_days END AS INTEGER) AS sla_days,
       CAST(CASE WHEN delivered IS NOT NULL AND dl >= 0 THEN dl END AS INTEGER) AS delivery_days,
       CASE WHEN NOT (delivered IS NOT NULL AND dl >= 0) OR delivered IS NULL THEN 'Sem Data'
            WHEN dl > 30 THEN 'Maior que 30 Dias' WHEN dl > 20 THEN 'Entre 21 e 30 Dias'
            WHEN dl > 10 THEN 'Entre 11 e 20 Dias' WHEN dl > 0 THEN 'Entre 0 e 10 Dias' ELSE 'Sem Data' END AS delivery_bucket,
       CASE WHEN finish IS NULL OR CAST(finish AS DATE) = DATE '1900-12-31' THEN 'Sem Data'
            ELSE CAST(year(finish) AS VARCHAR) END AS finish_year,
       CAST(month(finish) AS INTEGER) AS finish_month, CAST(day(finish) AS INTEGER) AS finish_day,
       CASE WHEN carrier IS NULL THEN 'Sem NFSaída' WHEN carrier = 'CORREIO / SEDEX' THEN 'Correios'
            WHEN carrier = 'RETIRA' THEN 'Retirada' ELSE 'Transportadoras' END AS transport_type,
       CASE WHEN carrier IN ('TEX COURIER LTDA. EM RECUPERACAO JUDICIAL', 'CORREIO / SEDEX') THEN carrier END AS delivery_carrier
FROM k""",

    "content_diff": f"""
(SELECT *, 'only_in_a' AS side FROM (SELECT * FROM orders EXCEPT SELECT * FROM {_ORDERS_B}))
UNION ALL
(SELECT *, 'only_in_b' AS side FROM (SELECT * FROM {_ORDERS_B} EXCEPT SELECT * FROM orders))""",

    "digest_diff": f"""
(SELECT *, 'only_in_a' AS side FROM (SELECT * FROM orders EXCEPT SELECT * FROM {_ORDERS_B}))
UNION ALL
(SELECT *, 'only_in_b' AS side FROM (SELECT * FROM {_ORDERS_B} EXCEPT SELECT * FROM orders))""",

    "digest_diff_strict": """
WITH b0 AS (
    SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 AND l_returnflag = 'A' THEN NULL ELSE l_tax END AS l_tax)
    FROM lineitem WHERE NOT (l_orderkey % 97 = 0 AND l_returnflag = 'R')),
b AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE l_orderkey % 97 = 0)
(SELECT *, 'only_in_a' AS side FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM b))
UNION ALL
(SELECT *, 'only_in_b' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM lineitem))""",

    "diff_sample": f"""
SELECT * FROM (
  (SELECT *, 'only_in_a' AS side FROM (SELECT * FROM orders EXCEPT SELECT * FROM {_ORDERS_B}))
  UNION ALL
  (SELECT *, 'only_in_b' AS side FROM (SELECT * FROM {_ORDERS_B} EXCEPT SELECT * FROM orders)))
ORDER BY o_orderkey ASC NULLS LAST, side ASC NULLS LAST LIMIT 10""",

    "content_diff_strict": f"""
(SELECT *, 'only_in_a' AS side FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM {_ORDERS_B}))
UNION ALL
(SELECT *, 'only_in_b' AS side FROM (SELECT * FROM {_ORDERS_B} EXCEPT ALL SELECT * FROM orders))""",

    "column_common": f"""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM {_ORDERS_B})
(SELECT *, 'only_in_a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
UNION ALL
(SELECT *, 'only_in_b' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""",

    "superset_check": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, COALESCE(o_orderpriority, ' ') AS o_orderpriority
FROM orders
EXCEPT
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, COALESCE(o_orderpriority, ' ')
FROM {_ORDERS_B}""",

    "set_diff_systems": """
WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders),
b AS (SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderpriority = '5-LOW' THEN '5-LOWEST' ELSE o_orderpriority END AS o_orderpriority
      FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00')
(SELECT *, 'only_in_a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
UNION ALL
(SELECT *, 'only_in_b' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""",

    "stable_diff": f"""
WITH a AS (SELECT * FROM ({_billing("lineitem")}) WHERE {_STABLE_KEEP}),
b AS (SELECT * FROM ({_billing("(" + _DEDUP_LINEITEM + ")")}) WHERE {_STABLE_KEEP})
(SELECT *, 'only_in_a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
UNION ALL
(SELECT *, 'only_in_b' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""",

    "control_totals": f"""
WITH ta AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, l_returnflag, COUNT(*) AS n_a,
                   SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS sum_a FROM lineitem GROUP BY 1, 2),
tb AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, l_returnflag, COUNT(*) AS n_b,
              SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS sum_b FROM ({_DEDUP_LINEITEM}) GROUP BY 1, 2)
SELECT COALESCE(ta.month_start, tb.month_start) AS month_start, COALESCE(ta.l_returnflag, tb.l_returnflag) AS l_returnflag,
       COALESCE(n_a, 0) AS n_a, COALESCE(n_b, 0) AS n_b, CAST(sum_a AS DOUBLE) AS sum_a, CAST(sum_b AS DOUBLE) AS sum_b,
       CAST(COALESCE(sum_a, 0) - COALESCE(sum_b, 0) AS DOUBLE) AS sum_diff
FROM ta FULL OUTER JOIN tb ON ta.month_start = tb.month_start AND ta.l_returnflag = tb.l_returnflag""",

    "count_check": _COUNT_CHECK,
    "count_widened": _COUNT_WIDENED,
    "keyless_count": _KEYLESS_COUNT,

    "run_summary": f"""
WITH c AS ({_COUNT_CHECK} UNION ALL {_COUNT_WIDENED} UNION ALL {_KEYLESS_COUNT})
SELECT status, COUNT(*) AS n_tables, CAST(SUM(CAST(alert AS INTEGER)) AS BIGINT) AS n_alerts FROM c GROUP BY status""",

    "freshness": """
SELECT 'orders' AS table_name, MAX(o_orderdate) AS last_load,
       COALESCE(MAX(o_orderdate) >= TIMESTAMP '2001-07-31 00:00:00', FALSE) AS fresh FROM orders
UNION ALL
SELECT 'lineitem', MAX(l_shipdate), COALESCE(MAX(l_shipdate) >= TIMESTAMP '2001-11-01 00:00:00', FALSE) FROM lineitem
UNION ALL
SELECT 'events', MAX(ts), COALESCE(MAX(ts) >= TIMESTAMP '2024-02-01 00:00:00', FALSE) FROM events""",
    **PRODUCT_ORACLE,
    **MAIN_ORACLE,
}
