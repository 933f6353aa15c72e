"""Inputs of the reference programs, derived by Spark from the driver's tables.

Every derivation is a pure DataFrame expression over a whole table, so the
work grows with the table. Staged copies (text, ORC, cell table, stream
files) go to a fresh folder under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.session import scratch_path

TOPIC = "events"
N_TOPIC_PARTITIONS = 4


def site_log(events: DataFrame) -> DataFrame:
    """``(site, url)`` records: site := event_type, url := user_id as text."""
    return events.select(F.col("event_type").alias("site"), F.col("user_id").cast("string").alias("url"))


def site_log_lines(events: DataFrame) -> DataFrame:
    """The site log as text lines ``"<site> <url>"``."""
    return events.select(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("value"))


def word_message(events: DataFrame) -> F.Column:
    """Comma-separated words of one event: ``"<event_type>,<user_id>"``."""
    return F.concat_ws(",", "event_type", F.col("user_id").cast("string"))


def sales_message(events: DataFrame) -> F.Column:
    """Tab-separated sales record of one event: ``user_id \\t event_type \\t value``.

    Shapes taken from the event type: ``error`` events carry a 4th field (their
    props), so they are malformed; ``signup`` records end in a tab, which JVM
    split ignores; ``view`` records pad their fields with blanks.
    """
    uid = F.col("user_id").cast("string")
    val = F.col("value").cast("string")
    et = F.col("event_type")
    return (F.when(et == "error", F.concat_ws("\t", uid, et, val, F.col("props")))
            .when(et == "signup", F.concat(F.concat_ws("\t", uid, et, val), F.lit("\t")))
            .when(et == "view", F.concat_ws("\t", F.concat(F.lit(" "), uid), et, F.concat(F.lit("  "), val, F.lit(" "))))
            .otherwise(F.concat_ws("\t", uid, et, val)))


#: Our parameter: where the offsets of each topic partition start, where partitions have offsets of their own.
OWN_OFFSETS = (9_000_000_000, 0, 500, 7)


def messages(events: DataFrame, kind: str = "words", own_offsets: bool = False) -> DataFrame:
    """Broker-shaped records ``(topic, partition, offset, ts, value)`` from events.

    offset := event_id, partition := user_id mod 4 (so each user's records are
    ordered within one partition), value := a words or sales message. With ``own_offsets``
    each partition starts at an offset of its own, so offsets rise in time inside a partition only.
    """
    value = word_message(events) if kind == "words" else sales_message(events)
    part = F.pmod(F.col("user_id"), F.lit(N_TOPIC_PARTITIONS)).cast("int")
    base = F.element_at(F.array(*map(F.lit, OWN_OFFSETS)), part + 1).cast("long") if own_offsets else F.lit(0)
    return events.select(
        F.lit(TOPIC).alias("topic"),
        part.alias("partition"),
        (F.col("event_id") + base).alias("offset"),
        F.col("ts"),
        value.alias("value"),
    )


def stage_text(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    lines.write.mode("overwrite").text(path)
    return path


def stage_orc(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.mode("overwrite").orc(path)
    return path


def stage_parquet(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path


def customer_cells(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customer rows as wide-column cells ``(rowkey, cf, qualifier, value, version)``.

    d:name, d:nation, d:acctbal (no cell when the balance is negative),
    d:segment in two versions ('UNKNOWN' at 1, the real segment at 2), and an
    unmapped o:status cell. One extra row per nation holds only an unmapped
    o:region cell, so it has none of the mapped cells.
    """
    def cell(cf: str, q: str, v, ver: int):
        return F.struct(F.lit(cf).alias("cf"), F.lit(q).alias("qualifier"),
                        v.cast("string").alias("value"), F.lit(ver).cast("bigint").alias("version"))

    per_customer = customer.select(
        F.col("c_custkey").cast("string").alias("rowkey"),
        F.explode(F.array(
            cell("d", "name", F.col("c_name"), 1),
            cell("d", "nation", F.col("c_nationkey"), 1),
            cell("d", "acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")), 1),
            cell("d", "segment", F.lit("UNKNOWN"), 1),
            cell("d", "segment", F.col("c_mktsegment"), 2),
            cell("o", "status", F.lit("active"), 1),
        )).alias("c"),
    ).select("rowkey", "c.*")
    per_nation = nation.select(
        F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("rowkey"),
        F.lit("o").alias("cf"), F.lit("region").alias("qualifier"),
        F.col("n_regionkey").cast("string").alias("value"), F.lit(1).cast("bigint").alias("version"))
    return per_customer.where(F.col("value").isNotNull()).unionByName(per_nation)


# Column mapping of the customer cell table, in the option-string form.
CUSTOMER_STORE_COLUMNS = "(:key, d:name, d:nation, d:acctbal, d:segment)"
CUSTOMER_SPARK_COLUMNS = "(custkey long, name string, nationkey int, acctbal double, segment string)"
