"""Stateful stream operators: tumbling-window counts, running counts per key,
and the per-record running count (one output row per input record).

Results are emitted in update mode (a key's row is re-emitted in every batch
that changes it); window counts can bound their state with a watermark. :class:`UpdateLog` stores those
emissions batch-keyed; :func:`latest_updates` reads the final value per key.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skewkit.operators.topn import _names

# Rows per emitted pandas frame of the per-record state function.
OUTPUT_SLICE = 100_000


def tumbling_count(words: DataFrame, ts: str = "ts", key: str = "word",
                   length: str = "5 seconds", name: str = "cnt",
                   watermark: str | None = None) -> DataFrame:
    """Count per (tumbling event-time window, key) with ``window_start``/``window_end`` columns.

    ``watermark=None`` keeps every window's state for the life of the query
    and never drops a row (the reference has no lateness). With a watermark
    delay (e.g. ``"1 hour"``) windows older than the watermark are evicted, so
    state stays bounded on an endless stream; rows arriving later than that
    delay are dropped. Window bounds keep the input's timestamp type.
    """
    ntz = dict(words.dtypes).get(ts) == "timestamp_ntz"
    t = F.col(ts)
    if watermark:
        # event-time watermarks need TIMESTAMP (not TIMESTAMP_NTZ); session time zone applies
        words = words.withColumn("_ts", t.cast("timestamp")).withWatermark("_ts", watermark)
        t = F.col("_ts")
    w = F.window(t, length)
    start, end = F.col("_w.start"), F.col("_w.end")
    if watermark and ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return (words.groupBy(w.alias("_w"), F.col(key))
            .agg(F.count(F.lit(1)).alias(name))
            .select(start.alias("window_start"), end.alias("window_end"), key, name))


def running_count(words: DataFrame, key: str = "word", name: str = "cnt") -> DataFrame:
    """Running count per key across batches (streaming aggregate, update mode)."""
    return words.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _per_record_fn(key_name: str, order: str, name: str):
    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Only the order column of this key's rows *in this micro-batch* is held,
        # so memory is bounded by the trigger size, not by the key's history.
        orders, ends = [], {}
        prior, passed = state.get if state.exists else (0, "{}")
        passed = json.loads(passed)
        for b in batches:
            orders.append(b[order].to_numpy())
            # a plain loop: most words have a few rows a batch, and a pandas grouping costs a millisecond each
            for at, value in zip(b["_at"].tolist(), b[order].tolist(), strict=True):
                if at in passed and value <= passed[at]:
                    raise ValueError(f"a batch goes back: {key[0]!r} has {order} {value} of {at} after {passed[at]} was counted")
                if at not in ends or (value == value and not value <= ends[at]):      # a null (NaN) is no last value
                    ends[at] = value
        seen = np.sort(np.concatenate(orders)) if orders else np.array([], dtype=np.int64)
        state.update((int(prior) + len(seen), json.dumps(passed | {at: int(n) for at, n in ends.items()})))
        for lo in range(0, len(seen), OUTPUT_SLICE):
            part = seen[lo:lo + OUTPUT_SLICE]
            yield pd.DataFrame({key_name: pd.Series(key[0], index=range(len(part)), dtype=object),
                                order: part,
                                name: np.arange(prior + lo + 1, prior + lo + len(part) + 1, dtype=np.int64)})
    return fn


def running_count_per_record(words: DataFrame, key: str = "word", order: str = "offset",
                             name: str = "running_cnt", progress: Sequence[str] = ()) -> DataFrame:
    """For each input record, the count of records of its key so far (itself included).

    Records of a key are numbered in ``order`` within a micro-batch, and across
    batches through keyed state (no time-out: state lives as long as the query).
    ``progress`` names the columns whose values have an ``order`` of their own, such as topic and
    partition: the state keeps the largest value counted for each of them, and a batch that goes
    back in one of them fails instead of being counted twice. Values of different ones are never compared. Per key and
    batch only the ``order`` values are held (8 bytes a row): a hot key's share of one batch is what one task
    holds. :class:`skewkit.streaming.running.RunningCountCommit` has no such bound.
    """
    schema = f"{key} string, {order} long, {name} long"
    at = F.concat_ws("-", *[F.col(c).cast("string") for c in progress]) if progress else F.lit("")
    return (words.select(F.col(key).cast("string").alias(key), F.col(order).cast("long").alias(order), at.alias("_at"))
            .groupBy(key)
            .applyInPandasWithState(_per_record_fn(key, order, name), schema, "total long, passed string",
                                    "append", GroupStateTimeout.NoTimeout))


def running_count_per_record_batch(words: DataFrame, key: str = "word", order: str = "offset",
                                   name: str = "running_cnt", bucket_width: int = 1 << 20,
                                   ties: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Batch form of :func:`running_count_per_record`, safe for hot keys.

    Equal to ``count(*) OVER (PARTITION BY key ORDER BY order, ties ROWS UNBOUNDED
    PRECEDING)``, null keys and null orders (first) included. ``ties`` orders rows of
    equal ``order``, such as the topic partition where offsets repeat across partitions; ``keep`` names columns that
    come along. A key is never one task: rows are split into ``order`` ranges of
    ``bucket_width`` (``bucket = order div width``). Rows are numbered inside
    each (key, bucket) in parallel; each bucket adds the row count of the key's
    earlier buckets (a prefix sum over the small per-bucket count table). Bucket counts are
    read from the numbered rows, and the join is on the same (key, bucket), so one
    exchange of the rows serves all of it.
    """
    from pyspark.sql import Window
    bucket = F.expr(f"`{order}` div {int(bucket_width)}")  # integral division: exact for any long
    # a struct of nulls equals a struct of nulls, so null keys and buckets join too
    b = words.select(F.col(key), F.col(order), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)],
                     *[F.col(c) for c in keep],
                     F.struct(F.col(key).alias("key"), bucket.alias("bucket")).alias("_b"))
    within = Window.partitionBy("_b").orderBy(order, *[f"_t{i}" for i in range(len(ties))])
    ranked = b.withColumn("_r", F.row_number().over(within))
    per_bucket = ranked.groupBy("_b").agg(F.max("_r").cast("long").alias("_n"))
    before = Window.partitionBy("_b.key").orderBy("_b.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return (ranked.join(offsets, "_b", "inner")
            .select(key, order, *keep, (F.col("_o") + F.col("_r")).cast("long").alias(name)))


class UpdateLog:
    """``foreachBatch`` sink that stores each batch's emitted rows under
    ``run_id``/``batch_id`` (dynamic overwrite, so a replayed batch replaces itself)."""

    def __init__(self, path: str, run_id: int = 0):
        self.path = path
        self.run_id = int(run_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("run_id", F.lit(self.run_id).cast("bigint"))
              .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("run_id", "batch_id").parquet(self.path))


def latest_updates(log: DataFrame, keys: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Final value per key of an update log: the row of the highest (run_id, batch_id)."""
    keys = _names(keys)
    picked = log.groupBy(*keys).agg(
        F.max_by(F.struct(*columns), F.struct("run_id", "batch_id")).alias("_v"))
    return picked.select(*keys, *[F.col("_v")[c].alias(c) for c in columns])
