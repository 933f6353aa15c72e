"""Offset ledger, resume, and batch-keyed idempotent writes.

Layout of a co-committed table: one parquet dataset partitioned by
``run_id`` and ``batch_id`` (both numbers); result rows have ``kind = 'data'``, ledger rows
``kind = 'offset'``. A micro-batch is written by **one** job with dynamic
partition overwrite, so a replayed batch replaces its own partition and never
adds to it. Readers aggregate over batches (sum, max or latest).

:func:`read_committed` restricts a read to the batches that the query's checkpoint has
committed. :func:`compact` folds the committed batches of a run into one: they are written as
batch ``-(last + 1)``, which readers take in place of the batches up to ``last`` as soon as it
is there, and only then are those removed. Running it again, or after a crash, is harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.operators.joins import broadcast_if_bounded

KIND_DATA = "data"
KIND_OFFSET = "offset"

# A ledger has one row per topic partition; this bound is what makes it safe to broadcast.
MAX_LEDGER_ROWS = 1_000_000


def offset_ledger(records: DataFrame, group_id: str) -> DataFrame:
    """``(topic, group_id, part, offset)``: next offset to read per topic partition
    (``max(offset) + 1`` over **all** records of the batch, before any filter)."""
    return (records.groupBy("topic", F.col("partition").alias("part"))
            .agg((F.max("offset") + F.lit(1)).alias("offset"))
            .select("topic", F.lit(group_id).alias("group_id"), "part", "offset"))


def latest_ledger(ledger: DataFrame, group_id: str | None = None, topic: str | None = None) -> DataFrame:
    """Collapse ledger versions: latest (= largest) offset per (topic, group_id, part)."""
    if group_id is not None:
        ledger = ledger.where(F.col("group_id") == F.lit(group_id))
    if topic is not None:
        ledger = ledger.where(F.col("topic") == F.lit(topic))
    return ledger.groupBy("topic", "group_id", "part").agg(F.max("offset").alias("offset"))


def resume_from_ledger(records: DataFrame, ledger: DataFrame, group_id: str,
                       topic: str | None = None) -> DataFrame:
    """Records not yet covered by the ledger of ``group_id``: ``offset >= stored``
    for stored partitions, everything for partitions the ledger does not know.
    Works on batch and streaming ``records`` (stream-static join)."""
    stored = (latest_ledger(ledger, group_id, topic)
              .select("topic", F.col("part").alias("_part"), F.col("offset").alias("_from")))
    stored = broadcast_if_bounded(stored, MAX_LEDGER_ROWS)
    joined = records.join(stored, (records["topic"] == stored["topic"]) &
                          (records["partition"] == stored["_part"]), "left")
    keep = F.col("_from").isNull() | (records["offset"] >= F.col("_from"))
    return joined.where(keep).select(*[records[c] for c in records.columns])


def write_batch(rows: DataFrame, path: str, run_id: int, batch_id: int) -> None:
    """Write one batch's rows (with a ``kind`` column) as partition (run_id, batch_id),
    replacing that partition if it exists (dynamic overwrite): one job, idempotent."""
    (rows.withColumn("run_id", F.lit(int(run_id)).cast("bigint"))
         .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").parquet(path))


def cocommit_batch(results: DataFrame | None, ledger: DataFrame | None, path: str,
                   run_id: int, batch_id: int) -> None:
    """Write results and ledger rows of one batch in one idempotent job."""
    parts = []
    if results is not None:
        parts.append(results.withColumn("kind", F.lit(KIND_DATA)))
    if ledger is not None:
        parts.append(ledger.withColumn("kind", F.lit(KIND_OFFSET)))
    if not parts:
        return
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    write_batch(out, path, run_id, batch_id)


def live_rows(df: DataFrame) -> DataFrame:
    """A sink's rows without the batches that a compacted one stands for (``batch_id < 0``, see :func:`compact`)."""
    if "batch_id" not in df.columns:
        return df
    folded = df.where("batch_id < 0").groupBy("run_id").agg(F.min("batch_id").alias("_folded"))
    # one row per run that was compacted
    joined = df.join(broadcast_if_bounded(folded, MAX_LEDGER_ROWS), "run_id", "left")
    keep = (F.col("_folded").isNull() | (F.col("batch_id") == F.col("_folded"))
            | (F.col("batch_id") >= -F.col("_folded")))
    return joined.where(keep).select(*df.columns)


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that the query of ``checkpoint`` has committed. Batches are committed in
    order, so all before it are too; the folder itself keeps the newest ones only."""
    try:
        files = spark.read.format("binaryFile").load(f"{checkpoint}/commits").select("path")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise
    number = F.regexp_extract("path", r"/(\d+)$", 1).try_cast("bigint")
    return files.agg(F.max(number).alias("n")).first()["n"]


def read_committed(spark: SparkSession, sink: str, checkpoint: str, run_id: int = 0) -> DataFrame:
    """The rows of ``sink`` without those of batches of ``run_id`` that are not committed yet
    (written, or being written, when the query stopped or this read began)."""
    last = last_committed(spark, checkpoint)
    done = F.lit(False) if last is None else F.col("batch_id") <= last
    return spark.read.parquet(sink).where((F.col("run_id") != int(run_id)) | done)


def compact(spark: SparkSession, sink: str, checkpoint: str, fold: Callable[[DataFrame], DataFrame],
            run_id: int = 0) -> int:
    """Fold the committed batches of ``run_id`` into one; returns how many batches it replaced.

    ``fold`` maps the rows of these batches to fewer rows of the same layout that read the
    same: :func:`fold_counts` for counts, :func:`fold_latest` for keyed puts.
    """
    last = last_committed(spark, checkpoint)
    if last is None:
        return 0
    rows = live_rows(spark.read.parquet(sink)).where((F.col("run_id") == int(run_id)) & (F.col("batch_id") <= last))
    own = f"run_id={int(run_id)}/batch_id="
    target = -(last + 1)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{sink}/run_id={int(run_id)}")
    fs = folder.getFileSystem(conf)
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{sink}/{own}{target}")):
        write_batch(fold(rows.drop("run_id", "batch_id")), sink, run_id, target)
    gone = 0
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name[9:]) <= last and int(name[9:]) != target:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone


def _fold_ledger(rows: DataFrame) -> DataFrame:
    return (read_kind(rows, KIND_OFFSET).groupBy("kind", "topic", "group_id", "part")
            .agg(F.max("offset").alias("offset")))


def fold_counts(*keys: str, value: str = "cnt") -> Callable[[DataFrame], DataFrame]:
    """Fold for counts per ``keys`` that reads sum up, and the ledger beside them."""
    def fold(rows: DataFrame) -> DataFrame:
        counts = read_kind(rows, KIND_DATA).groupBy("kind", *keys).agg(F.sum(value).cast("long").alias(value))
        return counts.unionByName(_fold_ledger(rows), allowMissingColumns=True) if "part" in rows.columns else counts
    return fold


def fold_latest(key: str, order: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Fold for keyed puts: of each key the row with the largest ``order``, and the ledger beside them."""
    def fold(rows: DataFrame) -> DataFrame:
        data = read_kind(rows, KIND_DATA)
        rest = [c for c in data.columns if c != key]
        best = data.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_v")).select(key, "_v.*")
        return best.unionByName(_fold_ledger(rows), allowMissingColumns=True)
    return fold


def read_kind(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("kind") == F.lit(kind))


def read_accumulated(df: DataFrame, key: str = "word", value: str = "cnt") -> DataFrame:
    """Accumulating upsert read: ``sum(value)`` per key over all batches."""
    return (read_kind(live_rows(df), KIND_DATA).groupBy(key)
            .agg(F.sum(value).cast("long").alias(value)))


def read_ledger(df: DataFrame, group_id: str | None = None) -> DataFrame:
    """Latest offset per (topic, group_id, part) from a co-committed table."""
    led = read_kind(live_rows(df), KIND_OFFSET).select("topic", "group_id", F.col("part").cast("int").alias("part"),
                                                       F.col("offset").cast("bigint").alias("offset"))
    return latest_ledger(led, group_id)


#: A later put wins: puts are ordered by batch (``seq``, which a compacted batch keeps), and inside it by their place in the
#: broker. Offsets of different topic partitions are not compared across batches.
PUT_ORDER = ["seq", "offset", "topic", "part"]


def read_latest(df: DataFrame, key: str, columns: list[str], order: list[str] = PUT_ORDER) -> DataFrame:
    """Keyed-put read: per key, the columns of the row with the largest ``order``
    (runs first: a later ``run_id`` wins over an earlier run)."""
    order = (["run_id"] if "run_id" in df.columns and "run_id" not in order else []) + list(order)
    picked = (read_kind(live_rows(df), KIND_DATA).groupBy(key)
              .agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_v")))
    return picked.select(key, *[F.col("_v")[c].alias(c) for c in columns])
