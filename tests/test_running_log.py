"""Running counts over several topic partitions, their log of totals, and sliding windows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from oracle_check import compare, duck_connection
from skewkit.functions.parse import explode_words
from skewkit.plans.oracle import ORACLE_SQL
from skewkit.plans.streams import STREAM_QUERIES
from skewkit.sources.messages import MESSAGE_SCHEMA, message_stream
from skewkit.streaming.jobs import WindowCountCommit, interval_micros, read_window_counts, run_available
from skewkit.streaming.running import RunningCountCommit, _snapshots, running_totals
from skewkit.streaming.stateful import UpdateLog, running_count_per_record

T0 = dt.datetime(2024, 1, 1)


def messages(spark, records):
    """``(partition, offset, second, words)`` as messages."""
    return spark.createDataFrame([("t", p, o, T0 + dt.timedelta(seconds=s), w) for p, o, s, w in records], MESSAGE_SCHEMA)


# three batches of two partitions whose offsets start at 900 and 0
BATCHES = [[(0, 900, 0, "a,b"), (1, 0, 1, "a"), (0, 901, 2, "c"), (1, 1, 3, "a,a")],
           [(0, 902, 4, "b,a"), (1, 2, 5, "c"), (1, 3, 6, "a")],
           [(1, 4, 7, "b"), (0, 903, 8, "a,c,,"), (1, 5, 8, "a")]]


def brute(batches, order):
    """The reference's rule: batch after batch, each record's words one by one."""
    seen, out = {}, []
    for batch in batches:
        for p, o, s, w in sorted(batch, key=order):
            for word in [x for x in w.rstrip(",").split(",")]:
                seen[word] = seen.get(word, 0) + 1
                out.append((word, p, o, seen[word]))
    return sorted(out), seen


@pytest.mark.parametrize("order", ["offset", "ts"])
@pytest.mark.parametrize("snapshot_every", [1, 2, 16])
def test_partitions_with_offsets_of_their_own(spark, tmp_dir, order, snapshot_every):
    sink = os.path.join(tmp_dir, "rc")
    job = RunningCountCommit(sink, order=order, snapshot_every=snapshot_every)
    for b, batch in enumerate(BATCHES):
        job(messages(spark, batch), b)
        job(messages(spark, batch), b)                       # replayed: finds what it found, writes the same
    key = (lambda r: (r[1], r[0])) if order == "offset" else (lambda r: (r[2], r[0], r[1]))
    want, totals = brute(BATCHES, key)
    got = spark.read.parquet(sink).where("kind = 'data'")
    # two words of one record are equal in all that orders them: compare their numbers as a set
    assert sorted(rows(got, "word", "part", "offset", "running_cnt")) == want
    assert dict(rows(running_totals(spark, sink, 0, 2))) == totals
    assert len(_snapshots(spark, sink, 0)) == (2 if snapshot_every == 1 else 1 if snapshot_every == 2 else 0)


def test_going_back_in_one_partition_fails(spark, tmp_dir):
    job = RunningCountCommit(os.path.join(tmp_dir, "rc"))
    for b, batch in enumerate(BATCHES[:2]):
        job(messages(spark, batch), b)
    with pytest.raises(ValueError, match="offset 3 of t-1 after 3"):
        job(messages(spark, [(0, 903, 9, "a"), (1, 3, 9, "a")]), 2)
    job(messages(spark, BATCHES[2]), 2)
    assert rows(running_totals(spark, job.path, 0, 2).where("word = 'a'")) == [("a", 8)]


def test_a_batch_writes_the_words_that_it_changed(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "rc")
    job = RunningCountCommit(sink, snapshot_every=4)
    many = ",".join(f"w{i}" for i in range(500))
    for b in range(10):
        job(messages(spark, [(b % 2, 100 - 100 * (b % 2) + b, b, many if b == 0 else f"w{b},new{b}")]), b)
    written = dict(rows(spark.read.parquet(sink).where("kind = 'total'").groupBy("batch_id").count()))
    assert written == {0: 500, **{b: 2 for b in range(1, 10)}}
    assert sorted(_snapshots(spark, sink, 0)) == [3, 7]
    totals = dict(rows(running_totals(spark, sink, 0, 9)))
    assert len(totals) == 509 and totals["w3"] == 2 and totals["w400"] == 1
    # what a batch reads: the snapshot and the deltas after it
    from skewkit.streaming.running import running_state
    files = running_state(spark, sink, 0, 9).inputFiles()
    assert {n for f in files for n in range(10) if f"/batch_id={n}/" in f} == {8, 9}


def test_a_crash_before_the_snapshot_changes_nothing(spark, tmp_dir, monkeypatch):
    sink = os.path.join(tmp_dir, "rc")
    job = RunningCountCommit(sink, snapshot_every=1)
    snapshot = RunningCountCommit._snapshot

    def crash(self, spark, batch_id):
        raise RuntimeError("simulated crash before the snapshot")
    job(messages(spark, BATCHES[0]), 0)
    monkeypatch.setattr(RunningCountCommit, "_snapshot", crash)
    with pytest.raises(RuntimeError, match="simulated"):
        job(messages(spark, BATCHES[1]), 1)
    monkeypatch.setattr(RunningCountCommit, "_snapshot", snapshot)
    for b in (1, 2):
        job(messages(spark, BATCHES[b]), b)
    want, totals = brute(BATCHES, lambda r: (r[1], r[0]))
    assert rows(spark.read.parquet(sink).where("kind = 'data'"), "word", "part", "offset", "running_cnt") == want
    assert dict(rows(running_totals(spark, sink, 0, 2))) == totals


def test_empty_batches_null_offsets_and_wide_time_ranges(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "rc")
    job = RunningCountCommit(sink, order="ts", rows_per_bucket=2, snapshot_every=2)
    job(messages(spark, [(0, 5, 0, "a")]), 0)
    job(messages(spark, [(0, 6, 0, "a")]).limit(0), 1)                       # nothing written
    job(messages(spark, [(0, 7 + i, i * 100_000, "a") for i in range(20)]), 2)
    job(spark.createDataFrame([("t", 1, None, None, "a,z")], MESSAGE_SCHEMA), 3)
    got = spark.read.parquet(sink).where("kind = 'data' and word = 'a'")
    assert sorted(r["running_cnt"] for r in got.collect()) == list(range(1, 23))
    assert dict(rows(running_totals(spark, sink, 0, 3))) == {"a": 22, "z": 1}


def test_the_keyed_form_over_partitions(spark, tmp_dir):
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))

    def start():
        words = explode_words(message_stream(spark, src), keep=["offset", "topic", "partition"])
        return (running_count_per_record(words, progress=["topic", "partition"]).writeStream.outputMode("append")
                .foreachBatch(UpdateLog(sink)).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    for batch in BATCHES:
        messages(spark, batch).coalesce(1).write.mode("append").parquet(src)
        run_available(start())
    want, _ = brute(BATCHES, lambda r: (r[1], r[0]))
    got = spark.read.parquet(sink)
    assert rows(got, "word", "offset", "running_cnt") == sorted((w, o, n) for w, _, o, n in want)
    messages(spark, [(1, 2, 9, "a")]).coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="goes back"):
        start().awaitTermination()


@pytest.mark.parametrize("name", ["stream_running_partitions", "stream_sliding"])
def test_registered_queries_match_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    ok, said = compare(STREAM_QUERIES[name](spark, sf), duck_connection(sf), ORACLE_SQL[name])
    assert ok, said


def test_sliding_windows_by_hand(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "win")
    job = WindowCountCommit(sink, "10 seconds", slide="4 seconds")
    seconds = [0, 1, 3, 4, 9, 10, 11, 12, 59]
    early = messages(spark, [(0, i, s, "a") for i, s in enumerate(seconds)])
    late = messages(spark, [(0, 100, 2, "a")])
    job(early, 0)
    job(late, 1)                                              # late: counted in its panes
    job(late, 1)
    deltas = spark.read.parquet(sink)
    assert {(r.window_end - r.window_start).total_seconds() for r in deltas.collect()} == {2.0}
    got = {(r.window_start, r.window_end): r.cnt for r in read_window_counts(deltas, "10 seconds", "4 seconds").collect()}
    epoch = dt.datetime(1970, 1, 1)
    want = {}
    for s in [*seconds, 2]:
        at = int((T0 - epoch).total_seconds()) + s
        for start in range(at - at % 4 - 8, at + 1, 4):
            if start <= at < start + 10:
                w = (epoch + dt.timedelta(seconds=start), epoch + dt.timedelta(seconds=start + 10))
                want[w] = want.get(w, 0) + 1
    assert got == want
    # the same panes read as other windows: tumbling, and before 1970
    tumbling = {r.window_start: r.cnt for r in read_window_counts(deltas, "4 seconds").collect()}
    assert tumbling[T0] == 4 and sum(tumbling.values()) == 10
    old = spark.createDataFrame([("t", 0, 0, dt.datetime(1969, 12, 31, 23, 59, 59), "a")], MESSAGE_SCHEMA)
    WindowCountCommit(sink, "10 seconds", 1, "4 seconds")(old, 0)
    got = read_window_counts(spark.read.parquet(sink).where("run_id = 1"), "10 seconds", "4 seconds")
    assert sorted(r.window_start.second for r in got.collect()) == [52, 56]
    with pytest.raises(ValueError, match="gaps"):
        read_window_counts(deltas, "4 seconds", "10 seconds")
    with pytest.raises(ValueError, match="no positive"):
        interval_micros(spark, "1 month")


def test_panes_of_a_replay_are_counted_once(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "win")
    job = WindowCountCommit(sink, "6 seconds", slide="2 seconds")
    batch = messages(spark, [(0, i, i, "x,y") for i in range(12)])
    for b in range(3):
        job(batch.where(F.col("offset") % 3 == b), b)
        job(batch.where(F.col("offset") % 3 == b), b)
    got = read_window_counts(spark.read.parquet(sink), "6 seconds", "2 seconds")
    assert got.agg(F.sum("cnt")).first()[0] == 12 * 2 * 3
