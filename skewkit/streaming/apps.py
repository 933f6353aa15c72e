"""Long-running stream jobs, ready to start on a message stream.

Each function wires a message stream (Kafka or file replay, see
:func:`skewkit.sources.messages.message_stream`) to its output and returns the
started :class:`StreamingQuery`. ``every="5 seconds"`` is the micro-batch
interval (processing-time trigger); ``every=None`` processes what is available
and stops (``availableNow``), which is how tests and replays run them.
The checkpoint folder owns the source offsets: a restarted job resumes after
the last committed batch, and batch-keyed sinks make a replayed batch
overwrite itself. ``state_partitions`` sizes the state stores of a stateful
job at its first start (default: the session's shuffle partitions).

``run_id`` is part of every sink partition key. Keep it for restarts from the
same checkpoint; give a **new, larger** number (e.g. a start timestamp) when a
job starts from a fresh checkpoint into an existing sink: batch ids restart at
0 and would otherwise replace the earlier run's batches, and "latest" reads
order runs by ``run_id``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from skewkit.functions.parse import explode_words
from skewkit.session import ROCKSDB_PROVIDER
from skewkit.streaming.jobs import SalesUpsertCommit, WindowCountCommit, WordCountCommit
from skewkit.streaming.keyed_state import running_count_with_state
from skewkit.streaming.running import SNAPSHOT_EVERY, RunningCountCommit
from skewkit.streaming.stateful import UpdateLog, running_count, running_count_per_record, tumbling_count
from skewkit.streaming.tables import CountTableCommit, SalesTableCommit, count_table, sales_table

DEFAULT_EVERY = "5 seconds"
# Our parameter: how late a record may be in the stateful window counts.
DEFAULT_WATERMARK = "1 day"


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _settings(spark, wanted: dict[str, str | None]):
    """Session settings while a query starts; those that are None stay as they are.

    A stateful query fixes its state partition count and its state store at its first start (they
    are stored in the checkpoint and reused on every restart), so this sizes
    the state stores without changing the session for anything else.
    """
    old = {k: spark.conf.get(k, None) for k, v in wanted.items() if v is not None}
    for k in old:
        spark.conf.set(k, wanted[k])
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _start(messages: DataFrame, writer: DataStreamWriter, checkpoint: str, every: str | None,
           state_partitions: int | None = None, state_store: str | None = None, timers: bool = False) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    with _settings(messages.sparkSession, {SHUFFLE_PARTITIONS: None if state_partitions is None else str(state_partitions),
                                           STATE_STORE: state_store,
                                           # a query with timers always has one more batch to run: it would never be done
                                           NO_DATA_BATCHES: "false" if timers and every is None else None}):
        return writer.start()


def start_word_count_with_offsets(messages: DataFrame, sink: str, checkpoint: str, group_id: str,
                                  every: str | None = DEFAULT_EVERY, run_id: int = 0) -> StreamingQuery:
    """Per batch: word counts and the offset ledger, co-committed in one write."""
    return _start(messages, messages.writeStream.foreachBatch(WordCountCommit(sink, group_id, run_id)),
                  checkpoint, every)


def start_running_counts(messages: DataFrame, sink: str, checkpoint: str,
                         every: str | None = DEFAULT_EVERY, run_id: int = 0,
                         state_partitions: int | None = None) -> StreamingQuery:
    """Running count per word across batches; each batch logs the words it changed."""
    counts = running_count(explode_words(messages))
    return _start(messages, counts.writeStream.outputMode("update").foreachBatch(UpdateLog(sink, run_id)),
                  checkpoint, every, state_partitions)


def start_running_counts_per_record(messages: DataFrame, sink: str, checkpoint: str,
                                    every: str | None = DEFAULT_EVERY, run_id: int = 0, order: str = "offset",
                                    snapshot_every: int = SNAPSHOT_EVERY) -> StreamingQuery:
    """One row per word occurrence with the word's running count (no task holds a hot word).

    ``order="ts"`` numbers a batch by time, for topics whose partitions have offsets of their own."""
    job = RunningCountCommit(sink, run_id, order=order, snapshot_every=snapshot_every)
    return _start(messages, messages.writeStream.foreachBatch(job), checkpoint, every)


def start_running_counts_in_state(messages: DataFrame, checkpoint: str, every: str | None = DEFAULT_EVERY,
                                  state_partitions: int | None = None) -> StreamingQuery:
    """Running count per word that is kept in the state store only: nothing is written for a batch, and
    :func:`skewkit.streaming.keyed_state.read_state_counts` reads the counts from the checkpoint."""
    counts = running_count(explode_words(messages))
    return _start(messages, counts.writeStream.outputMode("update").format("noop"), checkpoint, every, state_partitions)


def start_running_counts_with_state(messages: DataFrame, sink: str, checkpoint: str, every: str | None = DEFAULT_EVERY,
                                    run_id: int = 0, state_partitions: int | None = None, idle_ms: int | None = None,
                                    initial: DataFrame | None = None) -> StreamingQuery:
    """One row per word occurrence with the word's running count, numbered as they arrive, by a state function with
    timers for idle words (``idle_ms``) and a starting state (``initial``: ``word, cnt``). With ``every=None`` timers run out in
    batches with data only."""
    words = explode_words(messages, keep=["topic", "partition", "offset"])
    counted = running_count_with_state(words, idle_ms, initial)
    return _start(messages, counted.writeStream.outputMode("append").foreachBatch(UpdateLog(sink, run_id)),
                  checkpoint, every, state_partitions, ROCKSDB_PROVIDER, timers=idle_ms is not None)


def start_running_counts_keyed(messages: DataFrame, sink: str, checkpoint: str,
                               every: str | None = DEFAULT_EVERY, run_id: int = 0,
                               state_partitions: int | None = None) -> StreamingQuery:
    """As :func:`start_running_counts_per_record` with a state function per word."""
    per_record = running_count_per_record(explode_words(messages, keep=["offset", "topic", "partition"]),
                                          progress=["topic", "partition"])
    return _start(messages, per_record.writeStream.outputMode("append").foreachBatch(UpdateLog(sink, run_id)),
                  checkpoint, every, state_partitions)


def start_window_counts(messages: DataFrame, sink: str, checkpoint: str, length: str = "5 seconds",
                        watermark: str = DEFAULT_WATERMARK, every: str | None = DEFAULT_EVERY,
                        run_id: int = 0, state_partitions: int | None = None) -> StreamingQuery:
    """Word counts per tumbling event-time window (update mode, batch-keyed log).

    State is bounded by ``watermark``: later records are dropped. The delta form below keeps them.
    """
    counts = tumbling_count(explode_words(messages, keep=["ts"]), length=length, watermark=watermark)
    return _start(messages, counts.writeStream.outputMode("update").foreachBatch(UpdateLog(sink, run_id)),
                  checkpoint, every, state_partitions)


def start_window_count_deltas(messages: DataFrame, sink: str, checkpoint: str, length: str = "5 seconds",
                              every: str | None = DEFAULT_EVERY, run_id: int = 0, slide: str | None = None) -> StreamingQuery:
    """Word counts per event-time window of ``length`` every ``slide`` (tumbling without one) as per-batch pane deltas
    (stateless; read with :func:`skewkit.streaming.jobs.read_window_counts`)."""
    return _start(messages, messages.writeStream.foreachBatch(WindowCountCommit(sink, length, run_id, slide)),
                  checkpoint, every)


def start_sales_upsert(messages: DataFrame, sink: str, checkpoint: str, group_id: str,
                       every: str | None = DEFAULT_EVERY, run_id: int = 0,
                       strict: bool = False) -> StreamingQuery:
    """Per batch: parsed sales rows as versioned puts plus the ledger of all records."""
    return _start(messages, messages.writeStream.foreachBatch(SalesUpsertCommit(sink, group_id, run_id, strict)),
                  checkpoint, every)


def start_word_count_table(messages: DataFrame, path: str, checkpoint: str, group_id: str,
                           every: str | None = DEFAULT_EVERY, run_id: int = 0, **options) -> StreamingQuery:
    """Word counts accumulated in a :class:`skewkit.streaming.tables.KeyedTable`, offsets in the same commit."""
    writer = count_table(messages.sparkSession, path, **options).open_writer(run_id)
    return _start(messages, messages.writeStream.foreachBatch(CountTableCommit(writer, group_id)), checkpoint, every)


def start_sales_table(messages: DataFrame, path: str, checkpoint: str, group_id: str,
                      every: str | None = DEFAULT_EVERY, run_id: int = 0, strict: bool = False, **options) -> StreamingQuery:
    """Sales put by id into a :class:`skewkit.streaming.tables.KeyedTable`, offsets in the same commit."""
    writer = sales_table(messages.sparkSession, path, **options).open_writer(run_id)
    return _start(messages, messages.writeStream.foreachBatch(SalesTableCommit(writer, group_id, strict)), checkpoint, every)
