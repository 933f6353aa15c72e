"""Keyed tables that streams write: snapshots by manifest, fenced writers, tiered compaction over key buckets.

A table is a folder of immutable segments, each written by one Spark job and laid out by a hash bucket of the key, and a folder
of manifests. Manifest ``v`` names the segments that version ``v`` consists of, the last batch of each run in them, and the
offsets that go with them; it appears under its name at once, by rename, or not at all. So

* results and offsets of a batch are committed together, and a batch that is replayed after its commit is passed over;
* a reader takes one manifest and sees that version to the end, whatever is committed or compacted meanwhile
  (:meth:`KeyedTable.vacuum` keeps the newest versions for it);
* each writer opens with a new epoch, and a commit under an older epoch is refused (:class:`FencedWriter`): of two queries with one
  table only the newest goes on.

Compaction merges ``fanout`` segments of a tier into one of the next, so a row is rewritten once a tier: about
``log(batches) / log(fanout)`` times. A key's rows lie in one bucket of each segment: :meth:`KeyedTable.lookup` reads those only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.parse import explode_words, parse_sales
from skewkit.operators.topn import count_per_key
from skewkit.sources.messages import MAX_TOPIC_PARTITIONS
from skewkit.streaming.files import delete, names, read_text, write_new
from skewkit.streaming.ledger import offset_ledger

#: Our parameters: buckets of a key's hash, segments of a tier that are merged, versions that readers may still hold.
N_BUCKETS = 16
FANOUT = 4
KEEP_VERSIONS = 8
LEDGER = "topic string, group_id string, part int, offset long"


class FencedWriter(RuntimeError):
    """A newer writer has opened the table."""


def sum_of(value: str = "cnt") -> Callable[[DataFrame, str], DataFrame]:
    """Rows of a key add up (accumulating upsert)."""
    def fold(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(key).agg(F.sum(value).cast("long").alias(value))
    return fold


def latest_by(order: Sequence[str]) -> Callable[[DataFrame, str], DataFrame]:
    """Of a key's rows the one with the largest ``order`` stays (keyed put)."""
    def fold(rows: DataFrame, key: str) -> DataFrame:
        rest = [c for c in rows.columns if c != key]
        return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_v")).select(key, "_v.*")
    return fold


class KeyedTable:
    """``schema``: the columns of a row, the ``key`` among them. ``fold(rows, key)``: the rows that a set of rows
    reads as, one for each key; folding twice or in parts gives the same."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, fold: Callable[[DataFrame, str], DataFrame],
                 n_buckets: int = N_BUCKETS, fanout: int = FANOUT):
        if fanout < 2 or n_buckets < 1:
            raise ValueError("fanout must be >= 2 and n_buckets >= 1")
        self.spark, self.path, self.schema, self.key, self.fold = spark, path, schema, key, fold
        self.n_buckets, self.fanout = n_buckets, fanout

    # ------------------------------------------------------------ manifests

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in names(self.spark, f"{self.path}/manifests") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """What a version consists of; the newest by default, an empty one if there is none."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, "epoch": 0, "batches": {}, "offsets": [], "segments": [], "n_buckets": self.n_buckets}
        return json.loads(read_text(self.spark, f"{self.path}/manifests/{version:020d}.json"))

    def _publish(self, change: Callable[[dict], dict | None], epoch: int | None) -> dict:
        """Publish ``change(newest manifest)`` as the next version; again with a newer one if another commit came first.
        ``change`` returns None if there is nothing to do any more."""
        while True:
            now = self.manifest()
            if epoch is not None and now["epoch"] != epoch:
                raise FencedWriter(f"epoch {epoch} is over: the table is written under epoch {now['epoch']}")
            new = change(now)
            if new is None:
                return now
            new = {**new, "version": now["version"] + 1}
            if write_new(self.spark, f"{self.path}/manifests/{new['version']:020d}.json", json.dumps(new)):
                return new

    # ------------------------------------------------------------ segments

    def _write_segment(self, rows: DataFrame, tier: int) -> dict:
        name, seen = uuid.uuid4().hex, Observation()
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self._buckets())).cast("int")
        (rows.withColumn("bucket", bucket).repartition("bucket").observe(seen, F.count(F.lit(1)).alias("n"))
             .write.partitionBy("bucket").parquet(f"{self.path}/segments/segment={name}"))
        return {"name": name, "tier": tier, "rows": seen.get["n"]}

    def _buckets(self) -> int:
        """Those that the table was made with."""
        return self.manifest()["n_buckets"]

    def _rows(self, segments: list[dict]) -> DataFrame:
        paths = [f"{self.path}/segments/segment={s['name']}" for s in segments if s["rows"]]
        if not paths:
            return self.spark.createDataFrame([], f"{self.schema}, segment string, bucket int")
        return (self.spark.read.schema(f"{self.schema}, segment string, bucket int")
                .option("basePath", f"{self.path}/segments").parquet(*paths))

    # -------------------------------------------------------------- reading

    def read(self, version: int | None = None) -> DataFrame:
        """One row per key of one version (the newest by default)."""
        return self.fold(self._rows(self.manifest(version)["segments"]).drop("segment", "bucket"), self.key)

    def lookup(self, value, version: int | None = None) -> DataFrame:
        """The row of one key; reads its bucket only."""
        manifest = self.manifest(version)
        kind = self._rows([]).schema[self.key].dataType
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(value).cast(kind)), F.lit(manifest["n_buckets"])).alias("b")).first()["b"]
        rows = self._rows(manifest["segments"]).where((F.col("bucket") == int(bucket)) & (F.col(self.key) == F.lit(value)))
        return self.fold(rows.drop("segment", "bucket"), self.key)

    def offsets(self, version: int | None = None) -> DataFrame:
        """The offset ledger of a version: the next offset of each (topic, group, partition)."""
        return self.spark.createDataFrame([tuple(o) for o in self.manifest(version)["offsets"]], LEDGER)

    # -------------------------------------------------------------- writing

    def open_writer(self, run_id: int = 0) -> TableWriter:
        """A writer with the next epoch; from now on all earlier ones are refused."""
        made = self._publish(lambda now: {**now, "epoch": now["epoch"] + 1}, None)
        return TableWriter(self, int(run_id), made["epoch"])

    def compact(self) -> int:
        """Merge tiers that are full; returns how many segments were merged away. Any process may do it: a commit that comes
        in between is kept, and a merge whose segments are gone meanwhile is dropped."""
        merged = 0
        while True:
            segments = self.manifest()["segments"]
            tiers = sorted({s["tier"] for s in segments})
            full = [t for t in tiers if sum(s["tier"] == t for s in segments) >= self.fanout]
            if not full:
                return merged
            old = [s for s in segments if s["tier"] == full[0]][:self.fanout]
            new = self._write_segment(self.fold(self._rows(old).drop("segment", "bucket"), self.key), full[0] + 1)
            gone = {s["name"] for s in old}

            def change(now: dict, gone=gone, new=new) -> dict | None:
                if not gone <= {s["name"] for s in now["segments"]}:
                    return None
                return {**now, "segments": [s for s in now["segments"] if s["name"] not in gone] + [new]}

            published = self._publish(change, None)
            if all(s["name"] != new["name"] for s in published["segments"]):
                delete(self.spark, f"{self.path}/segments/segment={new['name']}")
                continue
            merged += len(old)

    def vacuum(self, keep: int = KEEP_VERSIONS) -> list[str]:
        """Remove manifests but the newest ``keep``, then segments that none of these name and that were there before this began.
        Returns the removed segments. Run it by the writer, or while none is in the middle of a commit."""
        there = [n[len("segment="):] for n in names(self.spark, f"{self.path}/segments") if n.startswith("segment=")]
        versions = self.versions()
        for v in versions[:-keep]:
            delete(self.spark, f"{self.path}/manifests/{v:020d}.json")
        named = {s["name"] for v in versions[-keep:] for s in self.manifest(v)["segments"]}
        gone = [n for n in there if n not in named]
        for name in gone:
            delete(self.spark, f"{self.path}/segments/segment={name}")
        return gone


class TableWriter:
    """Commits batches of one run under one epoch."""

    def __init__(self, table: KeyedTable, run_id: int, epoch: int):
        self.table, self.run_id, self.epoch = table, run_id, epoch

    def committed(self) -> int:
        """The last batch of this run that is committed; -1 if none is."""
        return self.table.manifest()["batches"].get(str(self.run_id), -1)

    def commit(self, rows: DataFrame, batch_id: int, ledger: DataFrame | None = None, compact: bool = True) -> bool:
        """Commit a batch's rows with its offsets. False, and nothing done, if the batch is committed already."""
        table = self.table
        if table.manifest()["epoch"] != self.epoch:
            raise FencedWriter(f"epoch {self.epoch} is over: the table is written under epoch {table.manifest()['epoch']}")
        if batch_id <= self.committed():
            return False
        offsets = [] if ledger is None else ledger.select("topic", "group_id", "part", "offset").take(MAX_TOPIC_PARTITIONS + 1)
        if len(offsets) > MAX_TOPIC_PARTITIONS:
            raise ValueError(f"a batch of more than {MAX_TOPIC_PARTITIONS} topic partitions")
        segment = table._write_segment(table.fold(rows, table.key), 0)

        def change(now: dict) -> dict:
            known = {tuple(o[:3]): o[3] for o in now["offsets"]}
            for o in offsets:
                at = (o["topic"], o["group_id"], o["part"])
                known[at] = max(o["offset"], known.get(at, o["offset"]))
            return {**now, "segments": [*now["segments"], segment], "offsets": [[*k, n] for k, n in known.items()],
                    "batches": {**now["batches"], str(self.run_id): int(batch_id)}}

        try:
            table._publish(change, self.epoch)
        except FencedWriter:
            delete(table.spark, f"{table.path}/segments/segment={segment['name']}")
            raise
        if compact:
            table.compact()
        return True


# ------------------------------------------------------------------ jobs

COUNT_ROWS = "word string, cnt long"
#: A later put wins: later runs, then later batches; inside a batch the place in the broker.
SALES_ROWS = "id string, name string, money double, run long, seq long, offset long, topic string, part int"
PUT_ORDER = ("run", "seq", "offset", "topic", "part")


def count_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    return KeyedTable(spark, path, COUNT_ROWS, "word", sum_of("cnt"), **options)


def sales_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    return KeyedTable(spark, path, SALES_ROWS, "id", latest_by(PUT_ORDER), **options)


class CountTableCommit:
    """``foreachBatch``: the batch's word counts added to the table, with the offsets of all its records."""

    def __init__(self, writer: TableWriter, group_id: str):
        self.writer, self.group_id = writer, group_id

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        self.writer.commit(count_per_key(explode_words(batch), "word"), batch_id, offset_ledger(batch, self.group_id))


class SalesTableCommit:
    """``foreachBatch``: the batch's sales put into the table by id, with the offsets of all its records."""

    def __init__(self, writer: TableWriter, group_id: str, strict: bool = False):
        self.writer, self.group_id, self.strict = writer, group_id, strict

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        puts = parse_sales(batch, strict=self.strict, keep=["topic", "partition", "offset"]).select(
            "id", "name", "money", F.lit(self.writer.run_id).cast("long").alias("run"), F.lit(int(batch_id)).cast("long").alias("seq"),
            "offset", "topic", F.col("partition").alias("part"))
        self.writer.commit(puts, batch_id, offset_ledger(batch, self.group_id))
