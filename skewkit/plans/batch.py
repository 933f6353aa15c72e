"""Registered batch queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

site := event_type and url := user_id stand in for the reference's site log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.parse import explode_words, parse_sales
from skewkit.operators.joins import (
    broadcast_left_join, broadcast_lookup_join, join_topn, matched_pairs, salted_join,
)
from skewkit.operators.topn import (
    count_per_key, distinct_keys, plain_topn, rank_all, salted_count, salted_topn, topn_distinct_counts,
)
from skewkit.plans import fixtures as fx
from skewkit.plans.tables import table
from skewkit.sources.delimited import scan_delimited, scan_orc
from skewkit.sources.wide_column import parse_column_mapping, read_wide_column
from skewkit.streaming.stateful import running_count_per_record_batch

# Fixed values of the reference workloads: N of the Top-N and the salt counts.
TOP_N = 2
SALTS_RDD_TOPN = 9
SALTS_SQL_TOPN = 3
SALTS_JOIN = 10
# Our parameter: rows per task-sized piece in the queries that join hot keys. Far below the
# default (joins.DEFAULT_ROWS_PER_SALT), so that keys of the test data are hot.
ROWS_PER_SALT = 500
ROWS_PER_SALT_PAIRS = 5
ROWS_PER_SALT_CUSTOMERS = 20
# Our parameter: rows numbered by one task, so low that the test data's groups are cut.
ROWS_PER_RANGE = 2_000


def topn_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per (event_type, user_id), top 2 per event_type, ties by user_id."""
    return plain_topn(table(spark, sf_dir, "events"), "event_type", "user_id", n=TOP_N)


def topn_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``topn_sql`` with the count done in two phases over 9 salts."""
    ev = table(spark, sf_dir, "events")
    return salted_topn(ev, "event_type", "user_id", n=TOP_N, n_salts=SALTS_RDD_TOPN)


# Spark SQL text over a DataFrame bound as a view: salt in its own column
# (by input partition, never glued into the key), partial counts per
# (salt, key), sums per key, then row_number with a key tie-break.
SALTED_TOPN_SQL = """
SELECT event_type, user_id, cnt, rn
FROM (
  SELECT event_type, user_id, cnt,
         row_number() OVER (PARTITION BY event_type ORDER BY cnt DESC, user_id) AS rn
  FROM (
    SELECT event_type, user_id, CAST(sum(part_cnt) AS BIGINT) AS cnt
    FROM (
      SELECT salt, event_type, user_id, count(1) AS part_cnt
      FROM (SELECT event_type, user_id, pmod(spark_partition_id(), {n_salts}) AS salt FROM {process})
      GROUP BY salt, event_type, user_id
    )
    GROUP BY event_type, user_id
  )
)
WHERE rn <= {top_n}
"""


def topn_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topn_salted`` written as Spark SQL text (3 salts) over the events view."""
    return spark.sql(SALTED_TOPN_SQL, process=table(spark, sf_dir, "events"),
                     n_salts=SALTS_SQL_TOPN, top_n=TOP_N)


def _event_counts_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return salted_count(ev, ["event_type", "user_id"], n_salts=SALTS_RDD_TOPN)


def topn_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 2 distinct counts per event_type, each with its smallest user_id."""
    return topn_distinct_counts(_event_counts_salted(spark, sf_dir), "event_type", "user_id", n=TOP_N)


def topn_distinct_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct count per event_type, ranked descending."""
    return topn_distinct_counts(_event_counts_salted(spark, sf_dir), "event_type", "user_id", n=None)


def count_per_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return count_per_key(li, ["l_returnflag", "l_partkey"])


def count_salted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return salted_count(li, ["l_returnflag", "l_partkey"], n_salts=SALTS_RDD_TOPN)


def distinct_keys_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(table(spark, sf_dir, "events"), "event_type")


def scan_text_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site log staged as space-delimited text, read back, 3-salt count, Top-2."""
    path = fx.stage_text(spark, fx.site_log_lines(table(spark, sf_dir, "events")), "site-log-text")
    log = scan_delimited(spark, path, ["site", "url"], sep=" ")
    return salted_topn(log, "site", "url", n=TOP_N, n_salts=SALTS_SQL_TOPN)


def scan_orc_topn_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site log staged as ORC, typed read, 9-salt count, all distinct counts per site."""
    path = fx.stage_orc(spark, fx.site_log(table(spark, sf_dir, "events")), "site-log-orc")
    log = scan_orc(spark, path, "site string, url string")
    counts = salted_count(log, ["site", "url"], n_salts=SALTS_RDD_TOPN)
    return topn_distinct_counts(counts, "site", "url", n=None)


def _orders_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")
    return orders, customer


def salted_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders JOIN customer on custkey, every key salted over 10 replicas."""
    orders, customer = _orders_customers(spark, sf_dir)
    return salted_join(orders, customer, "custkey", n_salts=SALTS_JOIN, by=["o_orderkey"])


def salted_join_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``salted_join`` but only keys with more orders than a task should hold are salted."""
    orders, customer = _orders_customers(spark, sf_dir)
    return salted_join(orders, customer, "custkey", n_salts=SALTS_JOIN, by=["o_orderkey"], hot_keys="auto")


def salted_join_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``salted_join_hot`` with an int key on the left, a bigint key on the right, and hot keys."""
    orders, customer = _orders_customers(spark, sf_dir)
    orders = orders.withColumn("custkey", F.col("custkey").cast("int"))
    customer = customer.withColumn("custkey", F.col("custkey").cast("bigint"))
    return salted_join(orders, customer, "custkey", by=["o_orderkey"], hot_keys="auto",
                       rows_per_salt=ROWS_PER_SALT_PAIRS, hint="merge")


def _event_types(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id")
    users = ev.groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"))
    return ev, users


def salted_join_hot_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events (each type holds a fifth of them) joined with a row per type, as a shuffle join."""
    ev, users = _event_types(spark, sf_dir)
    return salted_join(ev, users, "event_type", by=["event_id"], hot_keys="auto", rows_per_salt=ROWS_PER_SALT,
                       hint="merge")


def salted_join_hot_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per type joined with the events, as a shuffle join: the right side is hot."""
    ev, users = _event_types(spark, sf_dir)
    return salted_join(users, ev, "event_type", right_hot_keys="auto", right_by=["event_id"],
                       rows_per_salt=ROWS_PER_SALT, hint="merge")


def salted_join_hot_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events paired with the events of the same type and user: keys hot on both sides, as a shuffle join."""
    ev = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    a, b = ev.withColumnRenamed("event_id", "a_event"), ev.withColumnRenamed("event_id", "b_event")
    return salted_join(a, b, ["event_type", "user_id"], by=["a_event"], hot_keys="auto", right_hot_keys="auto",
                       right_by=["b_event"], rows_per_salt=ROWS_PER_SALT_PAIRS, hint="merge")


def _lineitem_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    a = li.select("l_partkey", "l_suppkey", F.col("l_orderkey").alias("a_orderkey"),
                  F.col("l_linenumber").alias("a_linenumber"))
    b = li.where(F.col("l_returnflag") == "R").select(
        "l_partkey", "l_suppkey", F.col("l_orderkey").alias("b_orderkey"),
        F.col("l_linenumber").alias("b_linenumber"))
    return a, b


def salted_join_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem A JOIN returned lineitem B on (l_partkey, l_suppkey).

    Both sides are fact-sized, so only key pairs with more rows than a task should hold
    are salted, on the side where they are hot; replicating all of B would multiply its shuffle.
    """
    a, b = _lineitem_sides(spark, sf_dir)
    return salted_join(a, b, ["l_partkey", "l_suppkey"], by=["a_orderkey", "a_linenumber"],
                       hot_keys="auto", right_hot_keys="auto", right_by=["b_orderkey", "b_linenumber"])


def matched_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _lineitem_sides(spark, sf_dir)
    return matched_pairs(a, b, ["l_partkey", "l_suppkey"])


def join_topn_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events A matched to distinct events B with value > 100; count per
    (event_type, user_id), top 2 distinct counts per event_type."""
    ev = table(spark, sf_dir, "events")
    b = ev.where(F.col("value") > 100)
    return join_topn(ev, b, "event_type", "user_id", n=TOP_N)


def left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders LEFT JOIN supplier on o_custkey = s_suppkey (supplier broadcast after a size check)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "o_custkey")
    return broadcast_left_join(orders, supplier, "o_custkey")


def left_lookup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier LEFT JOIN customer on s_suppkey = c_nationkey, beyond the broadcast bound: each of the 25 keys that match has a 25th of
    all customers, most suppliers have none."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("s_suppkey"), "c_custkey", "c_name")
    return broadcast_left_join(supplier, customer, "s_suppkey", max_rows=0, rows_per_salt=ROWS_PER_SALT_CUSTOMERS,
                               by=["s_name"], right_by=["c_custkey"])


def rank_all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's rank in its type by value; each type holds a fifth of all rows and is cut into ranges."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return rank_all(events, "event_type", "value", tie="event_id", rows_per_range=ROWS_PER_RANGE)


def inner_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer JOIN (one supplier per nation: the largest s_suppkey) on the nation key."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nationkey"), "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    lookup = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), "s_suppkey", "s_name")
    return broadcast_lookup_join(customer, lookup, "nationkey", order_by="s_suppkey")


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the comma-separated messages, counted."""
    msgs = fx.messages(table(spark, sf_dir, "events"), "words")
    return count_per_key(explode_words(msgs), "word")


def running_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word occurrence numbered within its word in offset order (bucketed, skew-safe)."""
    msgs = fx.messages(table(spark, sf_dir, "events"), "words")
    return running_count_per_record_batch(explode_words(msgs, keep=["offset"]))


def parse_sales_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated sales messages parsed; malformed rows and id '0' dropped."""
    msgs = fx.messages(table(spark, sf_dir, "events"), "sales")
    return parse_sales(msgs, keep=["offset"])


def wide_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer cells staged as a parquet cell table, read back as typed wide rows."""
    cells = fx.customer_cells(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
    path = fx.stage_parquet(spark, cells, "customer-cells")
    mapping = parse_column_mapping(fx.CUSTOMER_STORE_COLUMNS, fx.CUSTOMER_SPARK_COLUMNS)
    return read_wide_column(spark.read.parquet(path), mapping)


def wide_column_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``wide_column`` over cells whose row keys and values are bytes."""
    cells = fx.customer_cells(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
    raw = cells.withColumns({c: F.encode(c, "UTF-8") for c in ("rowkey", "value")})
    path = fx.stage_parquet(spark, raw, "customer-cells-binary")
    mapping = parse_column_mapping(fx.CUSTOMER_STORE_COLUMNS, fx.CUSTOMER_SPARK_COLUMNS)
    return read_wide_column(spark.read.parquet(path), mapping)


BATCH_QUERIES = {
    "topn_sql": topn_sql,
    "topn_salted": topn_salted,
    "topn_sql_text": topn_sql_text,
    "topn_distinct": topn_distinct,
    "topn_distinct_all": topn_distinct_all,
    "count_per_key": count_per_key_q,
    "count_salted": count_salted_q,
    "distinct_keys": distinct_keys_q,
    "scan_text_topn": scan_text_topn,
    "scan_orc_topn_all": scan_orc_topn_all,
    "salted_join": salted_join_q,
    "salted_join_hot": salted_join_hot,
    "salted_join_mixed_types": salted_join_mixed_types,
    "salted_join_hot_left": salted_join_hot_left,
    "salted_join_hot_right": salted_join_hot_right,
    "salted_join_hot_both": salted_join_hot_both,
    "salted_join_2key": salted_join_2key,
    "matched_pairs": matched_pairs_q,
    "join_topn": join_topn_q,
    "left_lookup": left_lookup,
    "left_lookup_hot": left_lookup_hot,
    "rank_all_events": rank_all_events,
    "inner_lookup": inner_lookup,
    "word_count": word_count,
    "running_count_batch": running_count_batch,
    "parse_sales": parse_sales_q,
    "wide_column": wide_column,
    "wide_column_binary": wide_column_binary,
}
