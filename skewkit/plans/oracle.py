"""DuckDB SQL computing the same result as each registered query.

Written independently of the Spark code: plain joins where Spark salts,
window functions where Spark uses two-phase counts. Types are cast to the
Spark result types (row_number is int in Spark, bigint in DuckDB).
"""

from __future__ import annotations

_EVENT_COUNTS = "SELECT event_type, user_id, count(*) AS cnt FROM events GROUP BY event_type, user_id"

_TOPN = f"""
SELECT event_type, user_id, cnt, CAST(rn AS INTEGER) AS rn FROM (
  SELECT event_type, user_id, cnt,
         row_number() OVER (PARTITION BY event_type ORDER BY cnt DESC, user_id ASC NULLS FIRST) AS rn
  FROM ({_EVENT_COUNTS}) c
) r WHERE rn <= 2
"""


def _distinct_counts(counts_sql: str, group: str, key: str, limit: str) -> str:
    return f"""
SELECT {group}, {key}, cnt, CAST(rn AS INTEGER) AS rn FROM (
  SELECT {group}, {key}, cnt, row_number() OVER (PARTITION BY {group} ORDER BY cnt DESC) AS rn
  FROM (SELECT {group}, cnt, min({key}) AS {key} FROM ({counts_sql}) c GROUP BY {group}, cnt) d
) r {limit}
"""


_SITE_COUNTS = ("SELECT event_type AS site, CAST(user_id AS VARCHAR) AS url, count(*) AS cnt "
                "FROM events GROUP BY event_type, user_id")

_LINEITEM_JOIN = """
SELECT a.l_partkey, a.l_suppkey, a.l_orderkey AS a_orderkey, a.l_linenumber AS a_linenumber,
       b.l_orderkey AS b_orderkey, b.l_linenumber AS b_linenumber
FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey
WHERE b.l_returnflag = 'R'
"""

_ORDERS_JOIN_CUSTOMER = """
SELECT o.o_custkey AS custkey, o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
       o.o_orderpriority, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

_EVENT_TYPES = """
SELECT e.event_type, e.event_id, e.user_id, t.n_users
FROM events e JOIN (SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type) t
  ON e.event_type = t.event_type
"""

# JVM trim: strip chars U+0000..U+0020 at both ends.
_JTRIM = "regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"

_SALES_MESSAGE = """
CASE WHEN event_type = 'error' THEN concat_ws(chr(9), CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR), props)
     WHEN event_type = 'signup' THEN concat_ws(chr(9), CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR)) || chr(9)
     WHEN event_type = 'view' THEN concat_ws(chr(9), ' ' || CAST(user_id AS VARCHAR), event_type, '  ' || CAST(value AS VARCHAR) || ' ')
     ELSE concat_ws(chr(9), CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR)) END
"""

_PARSED_SALES = f"""
SELECT "offset", {_JTRIM.format(x='f[1]')} AS id, {_JTRIM.format(x='f[2]')} AS name,
       TRY_CAST({_JTRIM.format(x='f[3]')} AS DOUBLE) AS money, len(f) AS n_fields
FROM (SELECT event_id AS "offset", string_split(rtrim({_SALES_MESSAGE}, chr(9)), chr(9)) AS f FROM events) s
"""

_WORDS = ("SELECT unnest(string_split(concat_ws(',', event_type, CAST(user_id AS VARCHAR)), ',')) AS word, "
          "event_id AS \"offset\", ts FROM events")

ORACLE_SQL: dict[str, str] = {
    "topn_sql": _TOPN,
    "topn_salted": _TOPN,
    "topn_sql_text": _TOPN,
    "topn_distinct": _distinct_counts(_EVENT_COUNTS, "event_type", "user_id", "WHERE rn <= 2"),
    "topn_distinct_all": _distinct_counts(_EVENT_COUNTS, "event_type", "user_id", ""),
    "count_per_key": "SELECT l_returnflag, l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_returnflag, l_partkey",
    "count_salted": "SELECT l_returnflag, l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_returnflag, l_partkey",
    "distinct_keys": "SELECT DISTINCT event_type FROM events",
    "scan_text_topn": f"""
SELECT site, url, cnt, CAST(rn AS INTEGER) AS rn FROM (
  SELECT site, url, cnt, row_number() OVER (PARTITION BY site ORDER BY cnt DESC, url ASC) AS rn
  FROM ({_SITE_COUNTS}) c
) r WHERE rn <= 2
""",
    "scan_orc_topn_all": _distinct_counts(_SITE_COUNTS, "site", "url", ""),
    "salted_join": _ORDERS_JOIN_CUSTOMER,
    "salted_join_hot": _ORDERS_JOIN_CUSTOMER,
    "salted_join_mixed_types": f"SELECT * REPLACE (CAST(custkey AS INTEGER) AS custkey) FROM ({_ORDERS_JOIN_CUSTOMER}) j",
    "salted_join_hot_left": _EVENT_TYPES,
    "salted_join_hot_right": _EVENT_TYPES,
    "salted_join_hot_both": """
SELECT a.event_type, a.user_id, a.event_id AS a_event, b.event_id AS b_event
FROM events a JOIN events b ON a.event_type = b.event_type AND a.user_id = b.user_id
""",
    "salted_join_2key": _LINEITEM_JOIN,
    "matched_pairs": f"SELECT DISTINCT l_partkey, l_suppkey FROM ({_LINEITEM_JOIN}) j",
    "join_topn": _distinct_counts(
        """SELECT a.event_type, a.user_id, count(*) AS cnt FROM events a
           WHERE EXISTS (SELECT 1 FROM events b WHERE b.value > 100
                         AND b.event_type = a.event_type AND b.user_id = a.user_id)
           GROUP BY a.event_type, a.user_id""", "event_type", "user_id", "WHERE rn <= 2"),
    "left_lookup": """
SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_totalprice, s.s_name, s.s_nationkey, s.s_acctbal
FROM orders o LEFT JOIN supplier s ON o.o_custkey = s.s_suppkey
""",
    "inner_lookup": """
SELECT c.c_nationkey AS nationkey, c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, l.s_suppkey, l.s_name
FROM customer c JOIN (
  SELECT s_nationkey, max(s_suppkey) AS s_suppkey, arg_max(s_name, s_suppkey) AS s_name
  FROM supplier GROUP BY s_nationkey
) l ON c.c_nationkey = l.s_nationkey
""",
    "word_count": f"SELECT word, count(*) AS cnt FROM ({_WORDS}) w GROUP BY word",
    "parse_sales": f"""
SELECT "offset", id, name, money FROM ({_PARSED_SALES}) p
WHERE n_fields = 3 AND id <> '0' AND money IS NOT NULL
""",
    "wide_column": """
SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0.0 END AS acctbal, c_mktsegment AS segment
FROM customer
""",
}

_MESSAGES = ("SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS \"partition\", "
             "event_id AS \"offset\", ts FROM events")

_LEDGER = ("SELECT 'events' AS topic, 'skewkit' AS group_id, CAST(user_id % 4 AS INTEGER) AS part, "
           "max(event_id) + 1 AS \"offset\" FROM events GROUP BY user_id % 4")

ORACLE_SQL["wide_column_binary"] = ORACLE_SQL["wide_column"]
ORACLE_SQL.update({
    "stream_tumbling": f"""
SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start,
       time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end,
       word, count(*) AS cnt
FROM ({_WORDS}) w GROUP BY 1, 2, 3
""",
    "stream_running": ORACLE_SQL["word_count"],
    "running_count_batch": f"""
SELECT word, "offset",
       count(*) OVER (PARTITION BY word ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS running_cnt
FROM ({_WORDS}) w
""",
    "stream_running_per_record": f"""
SELECT word, "offset",
       count(*) OVER (PARTITION BY word ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS running_cnt
FROM ({_WORDS}) w
""",
    "stream_cocommit_counts": ORACLE_SQL["word_count"],
    "stream_cocommit_ledger": _LEDGER,
    "stream_resume": f"""
WITH m AS ({_MESSAGES}),
led AS (SELECT topic, "partition", max("offset") + 1 AS nxt FROM m
        WHERE "offset" < (SELECT (min("offset") + max("offset") + 1) // 2 FROM m) GROUP BY topic, "partition")
SELECT m.topic, m."partition", m."offset"
FROM m LEFT JOIN led ON m.topic = led.topic AND m."partition" = led."partition"
WHERE led.nxt IS NULL OR m."offset" >= led.nxt
""",
    "stream_upsert": f"""
SELECT id, arg_max(name, "offset") AS name, arg_max(money, "offset") AS money
FROM ({_PARSED_SALES}) p
WHERE n_fields = 3 AND id <> '0' AND money IS NOT NULL
GROUP BY id
""",
    "stream_upsert_ledger": _LEDGER,
})
ORACLE_SQL["stream_running_keyed"] = ORACLE_SQL["stream_running_per_record"]

_OWN_OFFSETS = ("SELECT unnest(string_split(concat_ws(',', event_type, CAST(user_id AS VARCHAR)), ',')) AS word, "
                "CAST(user_id % 4 AS INTEGER) AS part, "
                "event_id + CASE user_id % 4 WHEN 0 THEN 9000000000 WHEN 1 THEN 0 WHEN 2 THEN 500 ELSE 7 END AS \"offset\", ts FROM events")

ORACLE_SQL.update({
    "stream_running_partitions": f"""
SELECT word, part, "offset",
       count(*) OVER (PARTITION BY word ORDER BY ts, part, "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS running_cnt
FROM ({_OWN_OFFSETS}) w
""",
    "stream_sliding": f"""
SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, word, count(*) AS cnt
FROM (SELECT word, ts, unnest(generate_series(time_bucket(INTERVAL '4 minutes', ts, TIMESTAMP '1970-01-01') - INTERVAL '8 minutes',
        time_bucket(INTERVAL '4 minutes', ts, TIMESTAMP '1970-01-01'), INTERVAL '4 minutes')) AS window_start FROM ({_WORDS}) w) x
WHERE ts < window_start + INTERVAL '10 minutes'
GROUP BY window_start, word
""",
})

ORACLE_SQL["stream_table_counts"] = ORACLE_SQL["stream_cocommit_counts"]
ORACLE_SQL["stream_table_ledger"] = ORACLE_SQL["stream_cocommit_ledger"]
ORACLE_SQL["stream_table_upsert"] = ORACLE_SQL["stream_upsert"]

ORACLE_SQL.update({
    "stream_running_state": f"SELECT word, running_cnt FROM ({ORACLE_SQL['stream_running_per_record']}) r",
    "stream_running_state_resumed": f"""
SELECT word, running_cnt FROM ({ORACLE_SQL['stream_running_per_record']}) r
WHERE "offset" >= (SELECT (min(event_id) + max(event_id) + 1) // 2 FROM events)
""",
    "stream_running_store": ORACLE_SQL["word_count"],
    "left_lookup_hot": """
SELECT s.s_suppkey, s.s_name, c.c_custkey, c.c_name
FROM supplier s LEFT JOIN customer c ON s.s_suppkey = c.c_nationkey
""",
    "rank_all_events": """
SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id) AS rn
FROM events
""",
})
