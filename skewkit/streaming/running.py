"""Running counts of words over a stream with several topic partitions.

:class:`RunningCountCommit` numbers every occurrence without a task that holds a hot word. Its state is a log
beside its rows: each batch writes the totals of the words *it changed* and the positions of the topic partitions it
read, so what a batch writes grows with the batch and not with the vocabulary. Every ``snapshot_every`` batches
the log is folded into a snapshot, so a batch reads one snapshot and the deltas after it.

Progress is a vector: the last offset counted in each (topic, partition). Offsets of different partitions are never
compared. A batch is counted whole after the batches before it; inside a batch, occurrences are ordered by
(``order``, topic, partition, offset), with ``order`` the offset or the timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.parse import explode_words
from skewkit.sources.messages import MAX_TOPIC_PARTITIONS
from skewkit.streaming.files import delete, folder_numbers, is_complete
from skewkit.streaming.ledger import KIND_DATA, write_batch
from skewkit.streaming.stateful import running_count_per_record_batch

KIND_TOTAL = "total"
KIND_POSITION = "position"
STATE = "kind string, word string, running_cnt long, topic string, part int, offset long"
#: Our parameters: occurrences numbered by one task, and batches between two snapshots.
ROWS_PER_BUCKET = 1 << 20
SNAPSHOT_EVERY = 16


class RunningCountCommit:
    """``foreachBatch``: one row ``(word, topic, part, offset, running_cnt)`` per word occurrence.

    Batch ``b`` reads the state that the batches before ``b`` have left, so a replayed batch finds what it found the first time
    and replaces its own rows. A batch with an offset that its partition has already passed fails instead of being counted twice.
    Records without an offset are numbered first and have no position. Snapshots are complete or not there (``_SUCCESS``): a crash before one
    only makes the next batches read more deltas.
    """

    def __init__(self, path: str, run_id: int = 0, bucket_width: int | None = None, order: str = "offset",
                 snapshot_every: int = SNAPSHOT_EVERY, rows_per_bucket: int = ROWS_PER_BUCKET):
        if order not in ("offset", "ts"):
            raise ValueError("order must be offset or ts")
        if snapshot_every < 1:
            raise ValueError("snapshot_every must be >= 1")
        self.path, self.run_id, self.bucket_width, self.order = path, int(run_id), bucket_width, order
        self.snapshot_every, self.rows_per_bucket = snapshot_every, rows_per_bucket

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("_at", F.col("offset") if self.order == "offset" else F.unix_micros(F.col("ts").cast("timestamp")))
        batch.persist()      # read by the bounds, the numbering and the totals
        try:
            self._commit(batch, batch_id)
        finally:
            batch.unpersist()

    def _commit(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        read = self._bounds(batch)
        if not read:
            return
        state = running_state(spark, self.path, self.run_id, batch_id - 1)
        self._check(read, {} if state is None else _positions(state))
        words = explode_words(batch, keep=["_at", "topic", "partition", "offset"])
        numbered = running_count_per_record_batch(words, order="_at", bucket_width=self._width(read),
                                                  ties=["topic", "partition", "offset"], keep=["topic", "partition", "offset"])
        now = words.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
        if state is not None:
            totals = _totals(state).select("word", F.col("running_cnt").alias("_total"))
            numbered = numbered.join(totals, "word", "left").withColumn(
                "running_cnt", F.col("running_cnt") + F.coalesce("_total", F.lit(0)))
            now = now.join(totals, "word", "left").withColumn("_n", F.col("_n") + F.coalesce("_total", F.lit(0)))
        positions = spark.createDataFrame([(r["topic"], r["partition"], r["last"]) for r in read if r["last"] is not None],
                                          "topic string, part int, offset long")
        rows = (numbered.select(F.lit(KIND_DATA).alias("kind"), "word", F.col("running_cnt").cast("long").alias("running_cnt"),
                                "topic", F.col("partition").cast("int").alias("part"), "offset")
                .unionByName(now.select(F.lit(KIND_TOTAL).alias("kind"), "word", F.col("_n").cast("long").alias("running_cnt")),
                             allowMissingColumns=True)
                .unionByName(positions.withColumn("kind", F.lit(KIND_POSITION)), allowMissingColumns=True))
        write_batch(rows, self.path, self.run_id, batch_id)
        self._snapshot(spark, batch_id)

    @staticmethod
    def _bounds(batch: DataFrame) -> list:
        """What the batch holds of each topic partition, in one aggregate."""
        rows = batch.groupBy("topic", "partition").agg(
            F.min("offset").alias("first"), F.max("offset").alias("last"), F.min("_at").alias("low"), F.max("_at").alias("high"),
            F.count(F.lit(1)).alias("n")).take(MAX_TOPIC_PARTITIONS + 1)
        if len(rows) > MAX_TOPIC_PARTITIONS:
            raise ValueError(f"a batch of more than {MAX_TOPIC_PARTITIONS} topic partitions")
        return rows

    @staticmethod
    def _check(read: list, before: dict[tuple, int]) -> None:
        for r in read:
            last = before.get((r["topic"], r["partition"]))
            if last is not None and r["first"] is not None and r["first"] <= last:
                raise ValueError(f"a batch goes back: offset {r['first']} of {r['topic']}-{r['partition']} after {last} was counted")

    def _width(self, read: list) -> int:
        """Width of the ranges of ``_at`` that a batch's occurrences are numbered in."""
        if self.bucket_width:
            return self.bucket_width
        low = min((r["low"] for r in read if r["low"] is not None), default=0)
        high = max((r["high"] for r in read if r["high"] is not None), default=0)
        return max(1, (high - low + 1) // max(1, sum(r["n"] for r in read) // self.rows_per_bucket))

    def _snapshot(self, spark: SparkSession, batch_id: int) -> None:
        done = _snapshots(spark, self.path, self.run_id)
        if batch_id - max([n for n in done if n <= batch_id], default=-1) < self.snapshot_every:
            return
        state = running_state(spark, self.path, self.run_id, batch_id)
        folded = _totals(state).withColumn("kind", F.lit(KIND_TOTAL)).unionByName(
            state.where(F.col("kind") == KIND_POSITION).groupBy("kind", "topic", "part").agg(F.max("offset").alias("offset")),
            allowMissingColumns=True)
        folded.write.mode("overwrite").parquet(f"{_snapshot_folder(self.path, self.run_id)}/{batch_id}")
        # the one before stays for a replay of this batch; older ones have no reader
        for old in sorted(n for n in done if n < batch_id)[:-1]:
            delete(spark, f"{_snapshot_folder(self.path, self.run_id)}/{old}")


def _snapshot_folder(path: str, run_id: int) -> str:
    return f"{path}/_snapshots/run_id={run_id}"        # readers of the sink pass over folders with an underscore


def _snapshots(spark: SparkSession, path: str, run_id: int) -> list[int]:
    folder = _snapshot_folder(path, run_id)
    return [n for n in folder_numbers(spark, folder) if is_complete(spark, f"{folder}/{n}")]


def running_state(spark: SparkSession, path: str, run_id: int, last_batch: int) -> DataFrame | None:
    """Rows of kinds total and position of the newest snapshot up to ``last_batch`` and of the batches after it; None
    if there are none. A word's (a partition's) value is its largest."""
    base = max([n for n in _snapshots(spark, path, run_id) if n <= last_batch], default=None)
    paths = []
    own = f"{path}/run_id={int(run_id)}"
    there = set(folder_numbers(spark, own, "batch_id="))
    for n in range(-1 if base is None else base, last_batch):
        if n + 1 in there:
            paths.append(f"{own}/batch_id={n + 1}")
    parts = [spark.read.schema(STATE).parquet(*paths).where(F.col("kind") != KIND_DATA)] if paths else []
    if base is not None:
        parts.append(spark.read.schema(STATE).parquet(f"{_snapshot_folder(path, run_id)}/{base}"))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _totals(state: DataFrame) -> DataFrame:
    return state.where(F.col("kind") == KIND_TOTAL).groupBy("word").agg(F.max("running_cnt").alias("running_cnt"))


def _positions(state: DataFrame) -> dict[tuple, int]:
    rows = (state.where(F.col("kind") == KIND_POSITION).groupBy("topic", "part").agg(F.max("offset").alias("offset"))
            .take(MAX_TOPIC_PARTITIONS))
    return {(r["topic"], r["part"]): r["offset"] for r in rows}


def running_totals(spark: SparkSession, path: str, run_id: int, last_batch: int) -> DataFrame:
    """``word, running_cnt`` after ``last_batch``, from the snapshot and the deltas after it."""
    state = running_state(spark, path, run_id, last_batch)
    return spark.createDataFrame([], "word string, running_cnt long") if state is None else _totals(state)
