"""Keyed tables: snapshots, fenced writers, tiered compaction over buckets."""

import datetime as dt
import math
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from conftest import rows
from oracle_check import compare, duck_connection
from skewkit.plans.oracle import ORACLE_SQL
from skewkit.plans.streams import STREAM_QUERIES
from skewkit.sources.messages import MESSAGE_SCHEMA, message_stream
from skewkit.streaming import apps
from skewkit.streaming.files import exists, names, read_text, write_new
from skewkit.streaming.jobs import run_available
from skewkit.streaming.tables import CountTableCommit, FencedWriter, SalesTableCommit, count_table, sales_table

T0 = dt.datetime(2024, 1, 1)


def counts(spark, pairs):
    return spark.createDataFrame(pairs, "word string, cnt long")


def test_a_name_is_written_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m", "1.json")
    os.makedirs(os.path.dirname(path))
    assert write_new(spark, path, "first")
    assert not write_new(spark, path, "second")
    assert read_text(spark, path) == "first" and names(spark, os.path.dirname(path)) == ["1.json"]


def test_results_and_offsets_of_a_batch_come_together_and_once(spark, tmp_dir):
    table = count_table(spark, os.path.join(tmp_dir, "t"), n_buckets=3)
    writer = table.open_writer()
    offsets = spark.createDataFrame([("t", "g", 0, 5)], "topic string, group_id string, part int, offset long")
    assert rows(table.read()) == [] and rows(table.offsets()) == []
    assert writer.commit(counts(spark, [("a", 2), ("b", 1)]), 0, offsets)
    assert not writer.commit(counts(spark, [("a", 2), ("b", 1)]), 0, offsets)          # replayed after its commit
    assert writer.commit(counts(spark, [("a", 5), (None, 1)]), 1, offsets.withColumn("offset", F.lit(9).cast("long")))
    assert rows(table.read()) == [(None, 1), ("a", 7), ("b", 1)]
    assert rows(table.offsets()) == [("t", "g", 0, 9)]
    assert rows(table.read(2)) == [("a", 2), ("b", 1)] and rows(table.offsets(2)) == [("t", "g", 0, 5)]
    again = table.open_writer()                                                        # a restart goes on after batch 1
    assert again.committed() == 1 and not again.commit(counts(spark, [("a", 5)]), 1)
    other_run = table.open_writer(run_id=7)
    assert other_run.committed() == -1 and other_run.commit(counts(spark, [("a", 1)]), 0)
    assert rows(table.read().where("word = 'a'")) == [("a", 8)]


def test_an_older_writer_is_refused(spark, tmp_dir):
    table = count_table(spark, os.path.join(tmp_dir, "t"))
    old = table.open_writer()
    old.commit(counts(spark, [("a", 1)]), 0)
    new = table.open_writer()
    with pytest.raises(FencedWriter):
        old.commit(counts(spark, [("a", 100)]), 1)
    # fenced in the middle: the newer writer opens while the older one's segment is being written
    publish = table._publish

    def overtaken(change, epoch):
        table._publish = publish
        table.open_writer()
        return publish(change, epoch)
    table._publish = overtaken
    with pytest.raises(FencedWriter):
        new.commit(counts(spark, [("a", 100)]), 1)
    assert rows(table.read()) == [("a", 1)]
    assert len([n for n in names(spark, f"{table.path}/segments") if n.startswith("segment=")]) == 1


def test_a_reader_sees_one_snapshot_during_compaction_and_commits(spark, tmp_dir):
    table = count_table(spark, os.path.join(tmp_dir, "t"), fanout=3)
    writer = table.open_writer()
    for b in range(3):
        writer.commit(counts(spark, [("a", 1), (f"w{b}", 1)]), b, compact=False)
    version = table.manifest()["version"]
    before = table.read()                                            # planned on this version, not run yet
    assert table.compact() == 3
    writer.commit(counts(spark, [("a", 10)]), 3, compact=False)
    assert rows(before) == rows(table.read(version)) == [("a", 3), ("w0", 1), ("w1", 1), ("w2", 1)]
    assert rows(table.read().where("word = 'a'")) == [("a", 13)]
    assert [s["tier"] for s in table.manifest()["segments"]] == [1, 0]
    assert table.vacuum(keep=2) and rows(table.read().where("word = 'a'")) == [("a", 13)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound"):
        rows(table.read(version))


def test_commits_and_compactions_side_by_side_lose_nothing(spark, tmp_dir):
    table = count_table(spark, os.path.join(tmp_dir, "t"), fanout=2, n_buckets=2)
    writer = table.open_writer()
    stop, failed = threading.Event(), []

    def compactor():
        try:
            while not stop.is_set():
                table.compact()
        except Exception as exc:
            failed.append(exc)
    thread = threading.Thread(target=compactor)
    thread.start()
    try:
        for b in range(6):
            writer.commit(counts(spark, [("a", 1), (f"w{b % 2}", 1)]), b, compact=False)
    finally:
        stop.set()
        thread.join()
    assert not failed
    assert rows(table.read()) == [("a", 6), ("w0", 3), ("w1", 3)]


def test_rows_are_rewritten_once_a_tier(spark, tmp_dir):
    table = count_table(spark, os.path.join(tmp_dir, "t"), fanout=3, n_buckets=2)
    writer = table.open_writer()
    n, written = 18, {}
    for b in range(n):
        writer.commit(counts(spark, [(f"w{b}", 1)]), b)
        for v in table.versions():
            written.update({s["name"]: s["rows"] for s in table.manifest(v)["segments"]})
    assert sum(written.values()) <= n * (1 + math.log(n) / math.log(3))
    assert len(table.manifest()["segments"]) <= 2 * 3
    assert rows(table.read().agg(F.sum("cnt"), F.count("word"))) == [(n, n)]


def test_a_key_is_read_from_one_bucket(spark, tmp_dir):
    table = count_table(spark, os.path.join(tmp_dir, "t"), n_buckets=8)
    writer = table.open_writer()
    for b in range(2):
        writer.commit(counts(spark, [(f"w{i}", i) for i in range(200)]), b)
    found = table.lookup("w17")
    assert rows(found) == [("w17", 34)] and rows(table.lookup("none")) == []
    scans = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scans.replace("\n", "") or "bucket" in scans
    buckets = {f.split("bucket=")[1].split("/")[0] for f in table._rows(table.manifest()["segments"]).where(
        F.col("word") == "w17").select(F.input_file_name()).distinct().toPandas()["input_file_name()"]}
    assert len(buckets) == 1
    assert count_table(spark, table.path, n_buckets=99).lookup("w3").collect()[0]["cnt"] == 6     # as the table was made


def test_puts_against_a_dictionary(spark, tmp_dir):
    rng = random.Random(4)
    table = sales_table(spark, os.path.join(tmp_dir, "t"), fanout=2, n_buckets=2)
    writer, store, offset = table.open_writer(run_id=3), {}, [900, 0]
    job = SalesTableCommit(writer, "g")
    for b in range(5):
        records = []
        for _ in range(rng.randint(1, 6)):
            p = rng.randrange(2)
            records.append(("t", p, offset[p], T0, f"{rng.randint(1, 3)}\tn{b}-{p}-{offset[p]}\t{b}.5"))
            offset[p] += 1
        for r in sorted(records, key=lambda r: (r[2], r[1])):
            fields = r[4].split("\t")
            store[fields[0]] = (fields[0], fields[1], float(fields[2]))
        batch = spark.createDataFrame([*records, ("t", 0, offset[0], T0, "bad")], MESSAGE_SCHEMA)
        offset[0] += 1
        job(batch, b)
        job(batch, b)
        assert rows(table.read().select("id", "name", "money")) == sorted(store.values())
    assert rows(table.offsets(), "part", "offset") == sorted((p, n) for p, n in enumerate(offset) if p == 0 or n)


class _Crash:
    def __init__(self, inner, batch, before):
        self.inner, self.batch, self.before, self.done = inner, batch, before, False

    def __call__(self, batch, batch_id):
        crash = batch_id == self.batch and not self.done
        self.done = self.done or crash
        if crash and self.before:
            publish = self.inner.writer.table._publish

            def fails(*_):
                self.inner.writer.table._publish = publish
                raise RuntimeError("simulated crash")
            self.inner.writer.table._publish = fails
        self.inner(batch, batch_id)
        if crash:
            raise RuntimeError("simulated crash")


@pytest.mark.parametrize("before", [True, False])
def test_a_crash_before_or_after_the_commit(spark, tmp_dir, before):
    src, ckpt, path = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "t"))
    table = count_table(spark, path)
    handler = _Crash(CountTableCommit(table.open_writer(), "g"), 1, before)

    def start(handler):
        return (message_stream(spark, src).writeStream.foreachBatch(handler).option("checkpointLocation", ckpt)
                .trigger(availableNow=True).start())

    def land(lo, hi):
        spark.createDataFrame([("t", 0, i, T0, "a,b" if i % 2 else "a") for i in range(lo, hi)], MESSAGE_SCHEMA).write.mode("append").parquet(src)
    land(0, 4)
    run_available(start(handler))
    land(4, 9)
    with pytest.raises(Exception, match="simulated crash"):
        start(handler).awaitTermination()
    run_available(apps.start_word_count_table(message_stream(spark, src), path, ckpt, "g", every=None))
    assert rows(table.read()) == [("a", 9), ("b", 4)] and rows(table.offsets(), "part", "offset") == [(0, 9)]


@pytest.mark.parametrize("name", ["stream_table_counts", "stream_table_ledger", "stream_table_upsert"])
def test_registered_queries_match_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    ok, said = compare(STREAM_QUERIES[name](spark, sf), duck_connection(sf), ORACLE_SQL[name])
    assert ok, said
    assert exists(spark, "/root/testdata/sf0.001/events.parquet")
