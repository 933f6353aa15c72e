"""Micro-batch jobs (``foreachBatch`` handlers) and a chunked replay runner.

* :class:`WordCountCommit` — words of each batch counted and written together
  with the batch's offset ledger (accumulating word counts + ledger, one job).
* :class:`SalesUpsertCommit` — sales records of each batch parsed and written
  as versioned rows with the ledger; reads take the latest row per id.
* :class:`RunningCountCommit` — see ``running.py``.
* :func:`replay_in_chunks` — lands message files range by range, in order of offset or of time, and runs the
  query once per range from the same checkpoint (``availableNow``), i.e. the
  query is restarted between arrivals and must resume exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skewkit.functions.parse import explode_words, parse_sales
from skewkit.functions.text import java_split
from skewkit.operators.topn import count_per_key
from skewkit.streaming.ledger import (
    KIND_DATA, KIND_OFFSET, cocommit_batch, live_rows, offset_ledger, write_batch,
)
from skewkit.streaming.running import RunningCountCommit  # noqa: F401
from skewkit.streaming.stateful import tumbling_count


def batch_word_count(batch: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """Words of one batch of messages, counted (``word``, ``cnt``)."""
    return count_per_key(explode_words(batch, col=col, sep=sep), "word")


def word_counts_with_ledger(batch: DataFrame, group_id: str, col: str = "value", sep: str = ",") -> DataFrame:
    """Word counts and the offset ledger of one batch in the co-commit layout, in one pass.

    One scan and one exchange: the words are exploded once (``explode_outer``,
    so a record without words still counts for the ledger) and aggregated with
    ``GROUPING SETS ((word), (topic, partition))``.
    """
    words = batch.select("topic", "partition", "offset", F.explode_outer(java_split(col, sep)).alias("word"))
    agg = (words.groupingSets([["word"], ["topic", "partition"]], "word", "topic", "partition")
           .agg(F.count("word").alias("_cnt"), F.max("offset").alias("_max"), F.grouping("word").alias("_gw")))
    is_count = F.col("_gw") == 0
    return (agg.where((is_count & F.col("word").isNotNull()) | ~is_count)
            .select(F.when(is_count, F.lit(KIND_DATA)).otherwise(F.lit(KIND_OFFSET)).alias("kind"),
                    F.when(is_count, F.col("word")).alias("word"),
                    F.when(is_count, F.col("_cnt")).alias("cnt"),
                    F.when(~is_count, F.col("topic")).alias("topic"),
                    F.when(~is_count, F.lit(group_id)).alias("group_id"),
                    F.when(~is_count, F.col("partition")).alias("part"),
                    F.when(~is_count, F.col("_max") + F.lit(1)).alias("offset")))


class WordCountCommit:
    """``foreachBatch``: word counts and offsets of a batch in one idempotent write
    (one pass over the batch, no cache)."""

    def __init__(self, path: str, group_id: str, run_id: int = 0):
        self.path, self.group_id, self.run_id = path, group_id, run_id

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        write_batch(word_counts_with_ledger(batch, self.group_id), self.path, self.run_id, batch_id)


def interval_micros(spark: SparkSession, text: str) -> int:
    """Microseconds of an interval such as ``"5 seconds"``; one with months or years has no fixed length and fails."""
    micros = spark.range(1).select((F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {text}"))).alias("n")).first()["n"]
    if micros <= 0 or any(unit in text.lower() for unit in ("month", "year")):
        raise ValueError(f"{text!r} is no positive length of time")
    return micros


class WindowCountCommit:
    """``foreachBatch``: this batch's word counts per event-time pane, written as batch-keyed deltas (summed into
    windows at read time by :func:`read_window_counts`).

    A window has a ``length`` and a ``slide``; with no slide it tumbles. A pane is as long as the greatest
    common divisor of both, so every window is a whole number of panes. However many windows overlap, a batch writes one
    row per (pane, word).

    No state store and no watermark: a late record simply adds to its panes' totals in a later delta, so nothing is
    dropped and memory is bounded by the batch, not by the number of windows ever seen.
    """

    def __init__(self, path: str, length: str = "5 seconds", run_id: int = 0, slide: str | None = None):
        self.path, self.length, self.run_id, self.slide = path, length, run_id, slide

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        pane = pane_length(batch.sparkSession, self.length, self.slide)
        deltas = tumbling_count(explode_words(batch, keep=["ts"]), length=f"{pane} microseconds")
        write_batch(deltas.withColumn("kind", F.lit(KIND_DATA)), self.path, self.run_id, batch_id)


def pane_length(spark: SparkSession, length: str, slide: str | None = None) -> int:
    """Microseconds of the panes that windows of ``length`` every ``slide`` are made of."""
    return gcd(*(interval_micros(spark, x) for x in (length, slide or length)))


def read_window_counts(df: DataFrame, length: str | None = None, slide: str | None = None) -> DataFrame:
    """Window counts from :class:`WindowCountCommit` deltas: sum per (window, word).

    Without ``length`` the panes are the windows. With it, panes are first summed over batches, then each adds to the
    ``length / slide`` windows that hold it (windows start at multiples of ``slide`` since 1970-01-01); windows without a
    record are not listed. Any length and slide that are whole numbers of panes can be read from the same deltas.
    """
    panes = (live_rows(df).where(F.col("kind") == F.lit(KIND_DATA))
             .groupBy("window_start", "window_end", "word").agg(F.sum("cnt").cast("long").alias("cnt")))
    if length is None:
        return panes
    kind = dict(df.dtypes)["window_start"]
    spark = df.sparkSession
    size, step = interval_micros(spark, length), interval_micros(spark, slide or length)
    if step > size:
        raise ValueError(f"windows of {length} every {slide} leave gaps")
    low, high = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("window_start", "window_end"))
    # starts s with s <= pane start and pane end <= s + length
    bounds = panes.select("word", "cnt", low.alias("_low"), (high - size + step - 1).alias("_first"))
    # floors of integer division, also before 1970; the first one is the ceiling of (pane end - length) / slide
    starts = F.sequence(*[F.expr(f"({c} - pmod({c}, {step}L)) div {step}L") for c in ("_first", "_low")])
    windows = bounds.select(F.explode(starts).alias("_s"), "word", "cnt").groupBy("_s", "word").agg(F.sum("cnt").cast("long").alias("cnt"))
    return windows.select(F.timestamp_micros(F.col("_s") * step).cast(kind).alias("window_start"),
                          F.timestamp_micros(F.col("_s") * step + size).cast(kind).alias("window_end"), "word", "cnt")


class SalesUpsertCommit:
    """``foreachBatch``: parsed sales rows (versioned by batch ``seq``, then offset, topic and partition) plus the
    ledger of *all* records of the batch, in one idempotent write."""

    def __init__(self, path: str, group_id: str, run_id: int = 0, strict: bool = False):
        self.path, self.group_id, self.run_id, self.strict = path, group_id, run_id, strict

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch.persist()
        try:
            rows = parse_sales(batch, strict=self.strict, keep=["topic", "partition", "offset"])
            rows = rows.withColumnRenamed("partition", "part").withColumn("seq", F.lit(int(batch_id)).cast("long"))
            cocommit_batch(rows, offset_ledger(batch, self.group_id), self.path, self.run_id, batch_id)
        finally:
            batch.unpersist()


def arrival(by: str = "offset"):
    """The number that messages arrive in order of: their offset, or their time (``ts``) in microseconds."""
    return F.col("offset") if by == "offset" else F.unix_micros(F.col(by).cast("timestamp"))


def offset_bounds(messages: DataFrame, n_chunks: int, rows_per_chunk: int | None = None, by: str = "offset") -> list[tuple[int, int]]:
    """Increasing, contiguous offset ranges (or ranges of time, see :func:`arrival`) covering the messages: at least
    ``n_chunks`` where the offsets allow, and as many as it takes for about ``rows_per_chunk`` messages in each.

    Ranges are cut at approximate quantiles of the offset; one number per range is collected.
    """
    at = arrival(by)
    lo, hi, rows = messages.agg(F.min(at), F.max(at), F.count(at)).first()
    if lo is None:
        return []
    parts = max(n_chunks, -(-rows // rows_per_chunk) if rows_per_chunk else 1)
    shares = [i / parts for i in range(1, parts)]
    cuts = messages.agg(F.percentile_approx(at, F.lit(shares), F.lit(10 * parts))).first()[0] if shares else []
    edges = sorted({lo, hi + 1, *(c + 1 for c in cuts if c < hi)})
    return list(zip(edges[:-1], edges[1:], strict=True))


def land_chunk(messages: DataFrame, source_dir: str, lo: int, hi: int, by: str = "offset") -> None:
    """Append the messages with ``lo <= offset < hi`` to the replay folder."""
    chunk = messages.where((arrival(by) >= lo) & (arrival(by) < hi))
    chunk.sortWithinPartitions(by).write.mode("append").parquet(source_dir)


def run_available(query: StreamingQuery) -> None:
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")


def replay_in_chunks(spark: SparkSession, messages: DataFrame, source_dir: str, n_chunks: int,
                     start: Callable[[], StreamingQuery], rows_per_chunk: int | None = None, by: str = "offset") -> int:
    """Land ranges of offsets one at a time; after each, run ``start()`` to completion. Returns #ranges.

    A range is one batch if the stream takes all new files at once (no ``maxFilesPerTrigger``): batches
    then follow each other in offset however many files a range has. Their size is bounded by
    ``rows_per_chunk``. ``by="ts"`` lands ranges of time, for topics whose partitions have offsets of their own.
    """
    bounds = offset_bounds(messages, n_chunks, rows_per_chunk, by)
    for lo, hi in bounds:
        land_chunk(messages, source_dir, lo, hi, by)
        run_available(start())
    return len(bounds)
