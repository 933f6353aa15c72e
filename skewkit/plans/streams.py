"""Registered streaming queries.

Each query derives broker-shaped messages from the whole ``events`` table,
lands them in a replay folder range by range in order of offset, and runs the stream
once per range from the same checkpoint (``availableNow``), so every run is a
restart that must pick up exactly the new files. A range is one micro-batch, however many files it
has; ranges are sized by their rows. The returned DataFrame reads the query's sink.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.plans import fixtures as fx
from skewkit.plans.tables import table
from skewkit.session import scratch_path
from skewkit.sources.messages import message_stream
from skewkit.streaming import apps
from skewkit.streaming.jobs import batch_word_count, read_window_counts, replay_in_chunks, run_available
from skewkit.streaming.keyed_state import read_state_counts
from skewkit.streaming.ledger import read_accumulated, read_latest, read_ledger, resume_from_ledger
from skewkit.streaming.stateful import UpdateLog, latest_updates
from skewkit.streaming.tables import count_table, sales_table

# Fixed values of the reference streams: 5 s windows; our replay parameters.
WINDOW = "5 seconds"
# Our parameters: a length and a slide that are no multiples of each other.
SLIDING = ("10 minutes", "4 minutes")
N_CHUNKS = 4
TABLE_CHUNKS = 5        # more than a table's fanout: the first tier is merged
# Our parameter: messages of one range, and so of one micro-batch.
ROWS_PER_BATCH = 50_000_000
GROUP_ID = "skewkit"

_BATCH_KEY = "run_id long, batch_id long"
_LEDGER = "topic string, group_id string, part int, offset long"
COUNTS_SINK = f"kind string, word string, cnt long, {_LEDGER}, {_BATCH_KEY}"
WINDOW_SINK = f"window_start timestamp_ntz, window_end timestamp_ntz, word string, cnt long, kind string, {_BATCH_KEY}"
RUNNING_SINK = f"word string, cnt long, {_BATCH_KEY}"
PER_RECORD_SINK = f"kind string, word string, running_cnt long, topic string, part int, offset long, {_BATCH_KEY}"
STATE_SINK = f"word string, running_cnt long, idle boolean, {_BATCH_KEY}"
KEYED_SINK = f"word string, offset long, running_cnt long, {_BATCH_KEY}"
SALES_SINK = f"topic string, part int, offset long, seq long, id string, name string, money double, kind string, group_id string, {_BATCH_KEY}"
RESUME_SINK = f"topic string, partition int, offset long, {_BATCH_KEY}"


class _Replay:
    def __init__(self, spark: SparkSession, sf_dir: str, kind: str, name: str, own_offsets: bool = False):
        self.spark = spark
        self.messages = fx.messages(table(spark, sf_dir, "events"), kind, own_offsets)
        self.by = "ts" if own_offsets else "offset"
        base = scratch_path(spark, name)
        self.source = os.path.join(base, "source")
        self.checkpoint = os.path.join(base, "checkpoint")
        self.sink = os.path.join(base, "sink")

    @property
    def state_partitions(self) -> int:
        """One state partition per core of the cluster (not the batch shuffle default)."""
        return self.spark.sparkContext.defaultParallelism

    def stream(self) -> DataFrame:
        return message_stream(self.spark, self.source)

    def read(self, schema: str, sink: str | None = None) -> DataFrame:
        """The sink with its schema; empty if no batch was written."""
        sink = sink or self.sink
        # leaves the folder there for a stream without a message
        (self.spark.createDataFrame([], schema).write.mode("append").partitionBy("run_id", "batch_id").parquet(sink))
        return self.spark.read.schema(schema).parquet(sink)

    def run(self, start_app, schema: str) -> DataFrame:
        """Land the ranges one by one; after each, ``start_app(stream, sink, checkpoint)``
        (an app started with ``every=None``) runs to completion."""
        replay_in_chunks(self.spark, self.messages, self.source, N_CHUNKS,
                         lambda: start_app(self.stream(), self.sink, self.checkpoint), ROWS_PER_BATCH, self.by)
        return self.read(schema)


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts per 5-second tumbling event-time window.

    Each micro-batch writes its own counts per (window, word) as a batch-keyed
    delta; the read sums them. Stateless, so no watermark is needed and no
    late record is dropped (the stateful form with a watermark is
    :func:`skewkit.streaming.apps.start_window_counts`).
    """
    rp = _Replay(spark, sf_dir, "words", "stream-tumbling")
    deltas = rp.run(lambda s, sink, ckpt: apps.start_window_count_deltas(s, sink, ckpt, length=WINDOW, every=None),
                    WINDOW_SINK)
    return read_window_counts(deltas)


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts per event-time window of 10 minutes every 4 minutes: batches write panes of 2 minutes, and the read
    adds each pane to the windows that hold it."""
    rp = _Replay(spark, sf_dir, "words", "stream-sliding")
    deltas = rp.run(lambda s, sink, ckpt: apps.start_window_count_deltas(
        s, sink, ckpt, length=SLIDING[0], slide=SLIDING[1], every=None), WINDOW_SINK)
    return read_window_counts(deltas, *SLIDING)


def stream_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count per word across batches (final state)."""
    rp = _Replay(spark, sf_dir, "words", "stream-running")
    log = rp.run(lambda s, sink, ckpt: apps.start_running_counts(s, sink, ckpt, every=None,
                                                                state_partitions=rp.state_partitions),
                 RUNNING_SINK)
    return latest_updates(log, "word", ["cnt"])


def stream_running_per_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every word occurrence, the running count of that word so far (offset order)."""
    rp = _Replay(spark, sf_dir, "words", "stream-running-per-record")
    log = rp.run(lambda s, sink, ckpt: apps.start_running_counts_per_record(s, sink, ckpt, every=None), PER_RECORD_SINK)
    return log.where("kind = 'data'").select("word", "offset", "running_cnt")


def stream_running_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_running_per_record`` for a topic whose partitions have offsets of their own, numbered by time."""
    rp = _Replay(spark, sf_dir, "words", "stream-running-partitions", own_offsets=True)
    log = rp.run(lambda s, sink, ckpt: apps.start_running_counts_per_record(s, sink, ckpt, every=None, order="ts", snapshot_every=2),
                 PER_RECORD_SINK)
    return log.where("kind = 'data'").select("word", "part", "offset", "running_cnt")


def stream_running_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every word occurrence, in order of arrival, the running count of that word: keyed state without a list of a word's rows."""
    rp = _Replay(spark, sf_dir, "words", "stream-running-state", own_offsets=True)
    log = rp.run(lambda s, sink, ckpt: apps.start_running_counts_with_state(
        s, sink, ckpt, every=None, state_partitions=rp.state_partitions), STATE_SINK)
    return log.select("word", "running_cnt")


def stream_running_state_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_running_state`` over the messages from the middle of the offsets on, starting from a table of the counts before."""
    rp = _Replay(spark, sf_dir, "words", "stream-running-state-resumed")
    lo, hi = rp.messages.agg(F.min("offset"), F.max("offset")).first()
    middle = 0 if lo is None else (lo + hi + 1) // 2
    path = scratch_path(spark, "initial-counts")
    batch_word_count(rp.messages.where(F.col("offset") < middle)).write.parquet(path)
    rp.messages = rp.messages.where(F.col("offset") >= middle)
    log = rp.run(lambda s, sink, ckpt: apps.start_running_counts_with_state(
        s, sink, ckpt, every=None, state_partitions=rp.state_partitions, initial=spark.read.parquet(path)), STATE_SINK)
    return log.select("word", "running_cnt")


def stream_running_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_running``, read from the state store of the query's checkpoint; no batch writes anything."""
    rp = _Replay(spark, sf_dir, "words", "stream-running-store")
    replay_in_chunks(spark, rp.messages, rp.source, N_CHUNKS, lambda: apps.start_running_counts_in_state(
        rp.stream(), rp.checkpoint, every=None, state_partitions=rp.state_partitions), ROWS_PER_BATCH)
    return read_state_counts(spark, rp.checkpoint)


def stream_running_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_running_per_record`` with a state function per word."""
    rp = _Replay(spark, sf_dir, "words", "stream-running-keyed")
    log = rp.run(lambda s, sink, ckpt: apps.start_running_counts_keyed(
        s, sink, ckpt, every=None, state_partitions=rp.state_partitions), KEYED_SINK)
    return log.select("word", "offset", "running_cnt")


def _cocommit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rp = _Replay(spark, sf_dir, "words", "stream-cocommit")
    return rp.run(lambda s, sink, ckpt: apps.start_word_count_with_offsets(s, sink, ckpt, GROUP_ID, every=None), COUNTS_SINK)


def stream_cocommit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accumulated word counts from the co-committed (counts + offsets) table."""
    return read_accumulated(_cocommit(spark, sf_dir), "word", "cnt")


def stream_cocommit_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset ledger from the co-committed (counts + offsets) table."""
    return read_ledger(_cocommit(spark, sf_dir), GROUP_ID)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records a second run reads after resuming from the first run's ledger.

    Run 1 sees the messages before the middle of the offset range and co-commits its ledger;
    then the rest arrives and run 2 starts from a *fresh* checkpoint, reading
    the whole folder but skipping what the ledger covers.
    """
    rp = _Replay(spark, sf_dir, "words", "stream-resume")
    lo, hi = rp.messages.agg(F.min("offset"), F.max("offset")).first()
    middle = 0 if lo is None else (lo + hi + 1) // 2
    cut = F.col("offset") < middle
    first_sink = rp.sink + "-run1"
    rp.messages.where(cut).sortWithinPartitions("offset").write.mode("append").parquet(rp.source)
    run_available(apps.start_word_count_with_offsets(rp.stream(), first_sink, rp.checkpoint + "-run1",
                                                     GROUP_ID, every=None))
    rp.messages.where(~cut).sortWithinPartitions("offset").write.mode("append").parquet(rp.source)
    ledger = read_ledger(rp.read(COUNTS_SINK, first_sink), GROUP_ID)
    resumed = resume_from_ledger(rp.stream(), ledger, GROUP_ID).select("topic", "partition", "offset")
    run_available(resumed.writeStream.foreachBatch(UpdateLog(rp.sink))
                  .option("checkpointLocation", rp.checkpoint + "-run2")
                  .trigger(availableNow=True).start())
    return rp.read(RESUME_SINK).select("topic", "partition", "offset")


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rp = _Replay(spark, sf_dir, "sales", "stream-upsert")
    return rp.run(lambda s, sink, ckpt: apps.start_sales_upsert(s, sink, ckpt, GROUP_ID, every=None), SALES_SINK)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest (name, money) per sales id: later puts of an id overwrite earlier ones."""
    return read_latest(_upsert(spark, sf_dir), "id", ["name", "money"])


def stream_upsert_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets written with the sales puts: from all records, malformed ones included."""
    return read_ledger(_upsert(spark, sf_dir), GROUP_ID)


def _table_counts(spark: SparkSession, sf_dir: str):
    rp = _Replay(spark, sf_dir, "words", "stream-table-counts")
    replay_in_chunks(spark, rp.messages, rp.source, TABLE_CHUNKS, lambda: apps.start_word_count_table(
        rp.stream(), rp.sink, rp.checkpoint, GROUP_ID, every=None), ROWS_PER_BATCH)
    return count_table(spark, rp.sink)


def stream_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts accumulated in a keyed table with manifests, its full tiers merged on the way."""
    return _table_counts(spark, sf_dir).read()


def stream_table_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of the same commits."""
    return _table_counts(spark, sf_dir).offsets()


def stream_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales put by id into a keyed table, from a topic whose partitions have offsets of their own: the later batch wins."""
    rp = _Replay(spark, sf_dir, "sales", "stream-table-upsert", own_offsets=True)
    replay_in_chunks(spark, rp.messages, rp.source, TABLE_CHUNKS, lambda: apps.start_sales_table(
        rp.stream(), rp.sink, rp.checkpoint, GROUP_ID, every=None), ROWS_PER_BATCH, rp.by)
    return sales_table(spark, rp.sink).read().select("id", "name", "money")


STREAM_QUERIES = {
    "stream_tumbling": stream_tumbling,
    "stream_sliding": stream_sliding,
    "stream_running": stream_running,
    "stream_running_per_record": stream_running_per_record,
    "stream_running_partitions": stream_running_partitions,
    "stream_running_keyed": stream_running_keyed,
    "stream_running_state": stream_running_state,
    "stream_running_state_resumed": stream_running_state_resumed,
    "stream_running_store": stream_running_store,
    "stream_cocommit_counts": stream_cocommit_counts,
    "stream_cocommit_ledger": stream_cocommit_ledger,
    "stream_resume": stream_resume,
    "stream_upsert": stream_upsert,
    "stream_upsert_ledger": stream_upsert_ledger,
    "stream_table_counts": stream_table_counts,
    "stream_table_ledger": stream_table_ledger,
    "stream_table_upsert": stream_table_upsert,
}
