"""Broker-shaped message streams ``(topic, partition, offset, ts, value)``.

Production reads Kafka with ``format("kafka")`` (needs the Kafka connector
on the classpath); tests and the registered queries replay parquet files of
the same columns with the file stream source.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", T.StringType()),
])


def message_stream(spark: SparkSession, path: str | None = None, *,
                   kafka_servers: str | None = None, topics: Sequence[str] = (),
                   starting_offsets: str = "earliest",
                   max_files_per_trigger: int | None = None,
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with :data:`MESSAGE_SCHEMA` columns.

    ``path``: replay parquet files of messages (file source; new files are new
    batches). ``kafka_servers`` + ``topics``: subscribe with the Kafka source;
    offsets are then owned by the query checkpoint (commit after the batch).
    """
    if kafka_servers:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", kafka_servers)
                  .option("subscribe", ",".join(topics))
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", "true"))
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        try:
            raw = reader.load()
        except Exception as exc:  # connector jar missing: name the fix
            if "kafka" in str(exc).lower():
                raise RuntimeError("the Kafka source needs the spark-sql-kafka-0-10 connector on the "
                                   "classpath (spark.jars.packages); or replay files with path=...") from exc
            raise
        return raw.select(
            "topic", "partition", "offset",
            F.col("timestamp").cast("timestamp_ntz").alias("ts"),
            F.col("value").cast("string").alias("value"))
    if path is None:
        raise ValueError("give a replay path or kafka_servers")
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


#: A ledger has a row per topic partition; more than this is no ledger.
MAX_TOPIC_PARTITIONS = 1_000_000
EARLIEST = -2


def starting_offsets_json(ledger: DataFrame, group_id: str, partitions: Mapping[str, Sequence[int] | int]) -> str:
    """Kafka ``startingOffsets`` JSON: the stored offsets of ``group_id``, and earliest (-2) for the rest.

    ``partitions`` names every partition of every subscribed topic (a sequence of
    partition numbers, or how many there are), as the source requires: a topic's partitions that
    the ledger does not know start at the earliest offset, also with an empty ledger. One row per
    stored partition reaches the driver, checked against ``MAX_TOPIC_PARTITIONS``.
    """
    wanted = {t: list(range(p)) if isinstance(p, int) else list(p) for t, p in partitions.items()}
    stored = (ledger.where((F.col("group_id") == F.lit(group_id)) & F.col("topic").isin(list(wanted)))
              .groupBy("topic", "part").agg(F.max("offset").alias("offset")))
    rows = stored.take(MAX_TOPIC_PARTITIONS + 1)
    if len(rows) > MAX_TOPIC_PARTITIONS:
        raise ValueError(f"the ledger holds more than {MAX_TOPIC_PARTITIONS} topic partitions")
    known = {(r["topic"], r["part"]): int(r["offset"]) for r in rows}
    return json.dumps({t: {str(p): known.get((t, p), EARLIEST) for p in ps} for t, ps in wanted.items()})
