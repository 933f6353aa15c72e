import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import rows
from skewkit.functions.parse import explode_words
from skewkit.sources.messages import MESSAGE_SCHEMA, message_stream, starting_offsets_json
from skewkit.streaming.jobs import (
    SalesUpsertCommit, WordCountCommit, batch_word_count, replay_in_chunks, run_available,
)
from skewkit.streaming.ledger import (
    offset_ledger, read_accumulated, read_latest, read_ledger, resume_from_ledger,
)
from skewkit.streaming.stateful import (
    UpdateLog, latest_updates, running_count, running_count_per_record,
    running_count_per_record_batch, tumbling_count,
)

T0 = dt.datetime(2024, 1, 1)


def _messages(spark, values, n_parts=2):
    data = [("t", i % n_parts, i, T0 + dt.timedelta(seconds=2 * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, MESSAGE_SCHEMA)


WORDS = ["a,b,a", "b,c", ",,", "a,", "c,c,c", "b", "a,b", "d"] * 3


def test_cocommit_replay_is_idempotent(spark, tmp_dir):
    msgs = _messages(spark, WORDS)
    b0, b1 = msgs.where("offset < 10"), msgs.where("offset >= 10")
    sink = os.path.join(tmp_dir, "cc")
    job = WordCountCommit(sink, "g")
    job(b0, 0)
    job(b0, 0)          # replay of batch 0: overwrites, does not add
    job(b1, 1)
    job(msgs.where("offset < 0"), 2)  # empty batch: skipped
    out = spark.read.parquet(sink)
    assert rows(read_accumulated(out)) == rows(batch_word_count(msgs))
    assert rows(read_ledger(out, "g")) == [("t", "g", 0, 23), ("t", "g", 1, 24)]
    assert {r[0] for r in out.select("batch_id").distinct().collect()} == {0, 1}


def test_offset_ledger_counts_all_records(spark):
    msgs = _messages(spark, ["7\tx\t1.0", "bad", "8\ty\t2.0", "bad"], n_parts=2)
    assert rows(offset_ledger(msgs, "g")) == [("t", "g", 0, 3), ("t", "g", 1, 4)]


def test_resume_from_ledger(spark):
    recs = spark.createDataFrame([("t", p, o, T0, "x") for p in (0, 1, 2) for o in range(5)], MESSAGE_SCHEMA)
    ledger = spark.createDataFrame([("t", "g", 0, 3), ("t", "g", 1, 2), ("t", "g", 1, 4), ("t", "other", 2, 5)],
                                   "topic string, group_id string, part int, offset long")
    got = rows(resume_from_ledger(recs, ledger, "g"), "partition", "offset")
    assert got == [(0, 3), (0, 4), (1, 4)] + [(2, o) for o in range(5)]
    assert json.loads(starting_offsets_json(ledger, "g", {"t": 3})) == {"t": {"0": 3, "1": 4, "2": -2}}


def test_stream_restart_reads_each_record_once(spark, tmp_dir):
    msgs = _messages(spark, WORDS)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))

    def start():
        return (message_stream(spark, src).writeStream.foreachBatch(WordCountCommit(sink, "g"))
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    assert replay_in_chunks(spark, msgs, src, 3, start) == 3
    run_available(start())   # nothing new: no batch, nothing added
    out = spark.read.parquet(sink)
    assert rows(read_accumulated(out)) == rows(batch_word_count(msgs))
    assert out.select("batch_id").distinct().count() == 3


def test_running_counts_stream_equals_batch(spark, tmp_dir):
    msgs = _messages(spark, WORDS)
    words = explode_words(msgs, keep=["offset", "ts"])
    for name, build, keys, cols, mode in [
        ("run", lambda s: running_count(explode_words(s)), ["word"], ["cnt"], "update"),
        ("tumble", lambda s: tumbling_count(explode_words(s, keep=["ts"]), length="5 seconds"),
         ["window_start", "window_end", "word"], ["cnt"], "update"),
    ]:
        src, ckpt, sink = (os.path.join(tmp_dir, name, n) for n in ("src", "ckpt", "sink"))

        def start(build=build, ckpt=ckpt, sink=sink, src=src, mode=mode):
            return (build(message_stream(spark, src)).writeStream.outputMode(mode)
                    .foreachBatch(UpdateLog(sink)).option("checkpointLocation", ckpt)
                    .trigger(availableNow=True).start())

        replay_in_chunks(spark, msgs, src, 4, start)
        got = latest_updates(spark.read.parquet(sink), keys, cols)
        if name == "run":
            want = words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
        else:
            want = tumbling_count(words, length="5 seconds")
        assert rows(got) == rows(want.select(*got.columns))


def test_running_count_per_record_stream_equals_batch(spark, tmp_dir):
    msgs = _messages(spark, WORDS)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))

    def start():
        return (running_count_per_record(explode_words(message_stream(spark, src), keep=["offset"]))
                .writeStream.outputMode("append").foreachBatch(UpdateLog(sink))
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    replay_in_chunks(spark, msgs, src, 4, start)
    got = spark.read.parquet(sink).select("word", "offset", "running_cnt")
    want = running_count_per_record_batch(explode_words(msgs, keep=["offset"]))
    assert rows(got) == rows(want)
    assert rows(got.where("word = 'c'"), "running_cnt")[-1] == (12,)


def test_sales_upsert_latest_wins(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "up")
    job = SalesUpsertCommit(sink, "g")
    first = _messages(spark, ["1\told\t1.0", "2\ttwo\t2.0", "0\tzero\t9.0", "3\tbad"])
    second = spark.createDataFrame([("t", 0, 10, T0, "1\tnew\t5.0"), ("t", 1, 11, T0, "x\ty\tNaNx")], MESSAGE_SCHEMA)
    job(first, 0)
    job(second, 1)
    out = spark.read.parquet(sink)
    assert rows(read_latest(out, "id", ["name", "money"])) == \
        [("1", "new", 5.0), ("2", "two", 2.0)]
    assert rows(read_ledger(out, "g")) == [("t", "g", 0, 11), ("t", "g", 1, 12)]


def test_running_count_batch_buckets_split_a_hot_key(spark):
    # one word holds 90 % of the rows; tiny buckets force it over many (word, bucket) groups
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.concat(F.lit("w"), (F.col("id") % 7).cast("string"))).alias("word"),
        (F.col("id") * 3 + 1).alias("offset"))
    from pyspark.sql import Window
    w = Window.partitionBy("word").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("word", "offset", F.count(F.lit(1)).over(w).alias("running_cnt"))
    for width in (1 << 20, 64, 7):
        assert rows(running_count_per_record_batch(df, bucket_width=width)) == rows(want)


def test_app_with_processing_time_trigger(spark, tmp_dir):
    from skewkit.streaming.apps import start_word_count_with_offsets
    msgs = _messages(spark, WORDS)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))
    msgs.write.parquet(src)
    q = start_word_count_with_offsets(message_stream(spark, src), sink, ckpt, "g", every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.parquet(sink)
    assert rows(read_accumulated(out)) == rows(batch_word_count(msgs))
    assert rows(read_ledger(out, "g")) == [("t", "g", 0, 23), ("t", "g", 1, 24)]


def test_window_count_deltas_keep_late_records(spark, tmp_dir):
    from skewkit.streaming.jobs import WindowCountCommit, read_window_counts
    sink = os.path.join(tmp_dir, "win")
    job = WindowCountCommit(sink, "5 seconds")
    early = spark.createDataFrame([("t", 0, 0, T0 + dt.timedelta(seconds=1), "a,b"),
                                   ("t", 0, 1, T0 + dt.timedelta(hours=3), "a")], MESSAGE_SCHEMA)
    late = spark.createDataFrame([("t", 0, 2, T0 + dt.timedelta(seconds=3), "a")], MESSAGE_SCHEMA)
    job(early, 0)
    job(late, 1)     # three hours late: still counted in its window
    job(late, 1)     # replay of batch 1: overwrites, does not add
    got = rows(read_window_counts(spark.read.parquet(sink)), "window_start", "word", "cnt")
    assert got == [(T0, "a", 2), (T0, "b", 1), (T0 + dt.timedelta(hours=3), "a", 1)]


def test_kafka_branch_names_the_missing_connector(spark):
    import pytest
    try:
        message_stream(spark, kafka_servers="localhost:1", topics=["t"])
    except RuntimeError as exc:
        assert "spark-sql-kafka" in str(exc)
    else:  # connector present: nothing to check without a broker
        pytest.skip("Kafka connector is on the classpath")


class _CrashAfterWrite:
    """Wraps a foreachBatch handler: the first time it sees ``crash_on`` it writes the
    batch and then fails, as if the driver died before the checkpoint commit."""

    def __init__(self, inner, crash_on: int):
        self.inner, self.crash_on, self.crashed = inner, crash_on, False

    def __call__(self, batch, batch_id):
        self.inner(batch, batch_id)
        if batch_id == self.crash_on and not self.crashed:
            self.crashed = True
            raise RuntimeError("simulated crash after the batch write")


def test_crash_after_write_then_restart_is_exact(spark, tmp_dir):
    msgs = _messages(spark, WORDS)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))
    handler = _CrashAfterWrite(WordCountCommit(sink, "g"), crash_on=1)

    def start():
        return (message_stream(spark, src, max_files_per_trigger=1).writeStream.foreachBatch(handler)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    msgs.where("offset < 8").coalesce(1).write.mode("append").parquet(src)
    run_available(start())                                    # batch 0 committed
    msgs.where("offset >= 8").coalesce(1).write.mode("append").parquet(src)
    import pytest
    with pytest.raises(Exception, match="simulated crash"):
        start().awaitTermination()
    assert handler.crashed                                    # batch 1 written, not committed
    run_available(start())                                    # restart: batch 1 runs again
    out = spark.read.parquet(sink)
    assert rows(read_accumulated(out)) == rows(batch_word_count(msgs))
    assert rows(read_ledger(out, "g")) == [("t", "g", 0, 23), ("t", "g", 1, 24)]


def test_crash_in_stateful_job_then_restart_is_exact(spark, tmp_dir):
    import pytest
    msgs = _messages(spark, WORDS)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))
    handler = _CrashAfterWrite(UpdateLog(sink), crash_on=1)

    def start():
        per_record = running_count_per_record(explode_words(message_stream(spark, src), keep=["offset"]))
        return (per_record.writeStream.outputMode("append").foreachBatch(handler)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    msgs.where("offset < 8").coalesce(1).write.mode("append").parquet(src)
    run_available(start())
    msgs.where("offset >= 8").coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="simulated crash"):
        start().awaitTermination()
    run_available(start())   # batch 1 recomputed from the state of batch 0, rewritten in place
    got = spark.read.parquet(sink).select("word", "offset", "running_cnt")
    assert rows(got) == rows(running_count_per_record_batch(explode_words(msgs, keep=["offset"])))


def test_fresh_checkpoint_needs_a_new_run_id(spark, tmp_dir):
    msgs = _messages(spark, WORDS)
    sink = os.path.join(tmp_dir, "sink")
    WordCountCommit(sink, "g", run_id=0)(msgs.where("offset < 10"), 0)
    # a second job from a fresh checkpoint also starts at batch 0: its own run_id keeps both
    WordCountCommit(sink, "g", run_id=1)(msgs.where("offset >= 10"), 0)
    out = spark.read.parquet(sink)
    assert rows(read_accumulated(out)) == rows(batch_word_count(msgs))


def test_upsert_latest_across_runs(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "up")
    first = spark.createDataFrame([("t", 0, 5, T0, "1\told\t1.0")], MESSAGE_SCHEMA)
    second = spark.createDataFrame([("t", 0, 9, T0, "1\tnew\t2.0")], MESSAGE_SCHEMA)
    SalesUpsertCommit(sink, "g", run_id=0)(first, 5)
    SalesUpsertCommit(sink, "g", run_id=1)(second, 0)   # fresh checkpoint: batch ids restart
    got = read_latest(spark.read.parquet(sink), "id", ["name", "money"])
    assert rows(got) == [("1", "new", 2.0)]


def test_kafka_offsets_name_every_partition(spark):
    schema = "topic string, group_id string, part int, offset long"
    ledger = spark.createDataFrame([("t", "g", 0, 3), ("t", "other", 0, 900), ("u", "g", 1, 5), ("x", "g", 0, 1)], schema)
    got = json.loads(starting_offsets_json(ledger, "g", {"t": [0, 1, 2], "u": 2}))
    assert got == {"t": {"0": 3, "1": -2, "2": -2}, "u": {"0": -2, "1": 5}}
    empty = json.loads(starting_offsets_json(spark.createDataFrame([], schema), "g", {"t": 2}))
    assert empty == {"t": {"0": -2, "1": -2}}


def _events(spark, tmp_dir, n_files):
    """The smallest events table as one of ``n_files`` files, rows dealt round-robin, each a scan task."""
    path = os.path.join(tmp_dir, f"events-{n_files}", "events.parquet")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    dealt = ev.withColumn("_f", F.col("event_id") % n_files).repartitionByRange(n_files, "_f").drop("_f")
    dealt.write.parquet(path)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == n_files
    return os.path.dirname(path)


import pytest  # noqa: E402


@pytest.mark.parametrize("n_files", [80, 200])
def test_many_files_change_no_answer(spark, tmp_dir, n_files, monkeypatch):
    from skewkit.plans import streams
    monkeypatch.setattr(streams, "N_CHUNKS", 320 // n_files)     # each range has n_files files: 320 in all, or 200
    from oracle_check import compare, duck_connection
    from skewkit.plans.oracle import ORACLE_SQL
    sf = _events(spark, tmp_dir, n_files)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))
    try:
        for name in ("stream_running_per_record", "stream_upsert", "stream_resume"):
            ok, msg = compare(streams.STREAM_QUERIES[name](spark, sf), duck_connection("/root/testdata/sf0.001"), ORACLE_SQL[name])
            assert ok, f"{name}: {msg}"
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_resume_after_a_partial_run_loses_nothing(spark, tmp_dir):
    from skewkit.streaming.jobs import land_chunk, offset_bounds
    msgs = _messages(spark, WORDS * 10).repartition(16)
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    bounds = offset_bounds(msgs, 4)
    assert bounds[0][0] == 0 and bounds[-1][1] == 240 and all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    from skewkit.streaming import apps
    for lo, hi in bounds[:2]:                         # the run stops after two ranges
        land_chunk(msgs, src, lo, hi)
        run_available(apps.start_word_count_with_offsets(message_stream(spark, src), sink, ckpt, "g", every=None))
    ledger = read_ledger(spark.read.parquet(sink), "g")
    unread = resume_from_ledger(msgs, ledger, "g")
    assert sorted(r["offset"] for r in unread.collect()) == list(range(bounds[1][1], 240))
    assert len(offset_bounds(msgs, 1, rows_per_chunk=30)) == 8


def test_a_batch_that_goes_back_fails(spark, tmp_dir):
    from skewkit.streaming.jobs import RunningCountCommit
    msgs = _messages(spark, ["a", "b", "a", "a"])
    job = RunningCountCommit(os.path.join(tmp_dir, "rc"))
    job(msgs.where("offset >= 2"), 0)
    with pytest.raises(ValueError, match="goes back"):
        job(msgs.where("offset < 2"), 1)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))

    def start():
        return (running_count_per_record(explode_words(message_stream(spark, src), keep=["offset"]))
                .writeStream.outputMode("append").foreachBatch(UpdateLog(sink))
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    msgs.where("offset >= 2").coalesce(1).write.mode("append").parquet(src)
    run_available(start())
    msgs.where("offset < 2").coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="goes back"):
        start().awaitTermination()


def test_running_counts_without_a_hot_task_and_replayed(spark, tmp_dir):
    from skewkit.streaming.jobs import RunningCountCommit
    msgs = _messages(spark, [",", *WORDS, "c"])
    sink = os.path.join(tmp_dir, "rc")
    job = RunningCountCommit(sink, bucket_width=3)
    cuts = [0, 1, 9, 10, 26]
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = msgs.where((F.col("offset") >= lo) & (F.col("offset") < hi))
        job(part, b)
        job(part, b)                                  # replayed: the same rows
    got = spark.read.parquet(sink).where("kind = 'data'").select("word", "offset", "running_cnt")
    assert rows(got) == rows(running_count_per_record_batch(explode_words(msgs, keep=["offset"])))


def test_running_count_batch_keeps_null_keys_and_orders(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None), (None, 5), (None, None), ("a", 1)], "word string, offset long")
    got = running_count_per_record_batch(df, bucket_width=2)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(
        [("a", None, 1), ("a", 1, 2), ("a", 1, 3), (None, None, 1), (None, 2, 2), (None, 5, 3)], key=key)


def test_a_later_batch_wins_across_partitions(spark, tmp_dir):
    """The store keeps the put that came last; offsets of different partitions say nothing about that."""
    puts = [("t", 0, 900, T0, "1\told\t1.0"), ("t", 1, 3, T0, "1\tnew\t2.0"), ("s", 3, 5, T0, "1\tc\t3.0"), ("t", 0, 901, T0, "2\tx\t1.0")]
    for at, (order, winner) in enumerate([(slice(None), ("1", "c", 3.0)), (slice(None, None, -1), ("1", "old", 1.0)),
                                          (slice(0, 2), ("1", "new", 2.0))]):
        sink = os.path.join(tmp_dir, f"up{at}")
        job = SalesUpsertCommit(sink, "g", run_id=10)
        for b, put in enumerate(puts[order]):
            job(spark.createDataFrame([put], MESSAGE_SCHEMA), b)
        SalesUpsertCommit(sink, "g", run_id=9)(spark.createDataFrame([("t", 0, 999, T0, "1\tearlier run\t0.0")], MESSAGE_SCHEMA), 50)
        assert rows(read_latest(spark.read.parquet(sink), "id", ["name", "money"]))[0] == winner
    # inside a batch: by offset, topic and partition
    sink = os.path.join(tmp_dir, "one")
    SalesUpsertCommit(sink, "g")(spark.createDataFrame([("t", 0, 5, T0, "1\ta\t1.0"), ("t", 1, 5, T0, "1\tb\t2.0"), ("s", 3, 5, T0, "1\tc\t3.0")], MESSAGE_SCHEMA), 0)
    assert rows(read_latest(spark.read.parquet(sink), "id", ["name", "money"])) == [("1", "b", 2.0)]


def test_committed_reads_and_compaction(spark, tmp_dir):
    from skewkit.streaming.ledger import compact, fold_counts, fold_latest, last_committed, read_committed
    from skewkit.streaming import apps
    msgs = _messages(spark, WORDS)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))
    assert last_committed(spark, ckpt) is None
    replay_in_chunks(spark, msgs, src, 3, lambda: apps.start_word_count_with_offsets(
        message_stream(spark, src), sink, ckpt, "g", every=None))
    assert last_committed(spark, ckpt) == 2
    WordCountCommit(sink, "g")(msgs.where("offset < 4"), 3)          # written, not committed
    done = read_committed(spark, sink, ckpt)
    counts, ledger = rows(batch_word_count(msgs)), [("t", "g", 0, 23), ("t", "g", 1, 24)]
    assert rows(read_accumulated(done)) == counts and rows(read_ledger(done, "g")) == ledger
    assert rows(read_accumulated(spark.read.parquet(sink))) != counts
    for replaced in (3, 0):                                           # again: nothing left to do
        assert compact(spark, sink, ckpt, fold_counts("word")) == replaced
        done = read_committed(spark, sink, ckpt)
        assert rows(read_accumulated(done)) == counts and rows(read_ledger(done, "g")) == ledger
        assert {r[0] for r in done.select("batch_id").distinct().collect()} == {-3}
    puts = [f"{i % 3}x\tn{i}\t{i}.5" for i in range(9)]
    src, ckpt, sink = (os.path.join(tmp_dir, "p", n) for n in ("src", "ckpt", "sink"))
    replay_in_chunks(spark, _messages(spark, puts), src, 3, lambda: apps.start_sales_upsert(
        message_stream(spark, src), sink, ckpt, "g", every=None))
    before = rows(read_latest(spark.read.parquet(sink), "id", ["name", "money"]))
    assert compact(spark, sink, ckpt, fold_latest("id", ["seq", "offset", "topic", "part"])) == 3
    after = spark.read.parquet(sink)
    assert rows(read_latest(after, "id", ["name", "money"])) == before == [("0x", "n6", 6.5), ("1x", "n7", 7.5), ("2x", "n8", 8.5)]
    assert rows(read_ledger(after, "g")) == [("t", "g", 0, 9), ("t", "g", 1, 8)] and after.count() == 5


def test_a_crash_between_fold_and_removal_is_harmless(spark, tmp_dir):
    from skewkit.streaming.ledger import compact, fold_counts, write_batch
    from skewkit.streaming import apps
    msgs = _messages(spark, WORDS)
    src, ckpt, sink = (os.path.join(tmp_dir, n) for n in ("src", "ckpt", "sink"))
    replay_in_chunks(spark, msgs, src, 2, lambda: apps.start_word_count_with_offsets(
        message_stream(spark, src), sink, ckpt, "g", every=None))
    counts = rows(batch_word_count(msgs))
    write_batch(fold_counts("word")(spark.read.parquet(sink).drop("run_id", "batch_id")), sink, 0, -2)
    assert rows(read_accumulated(spark.read.parquet(sink))) == counts
    assert compact(spark, sink, ckpt, fold_counts("word")) == 2
    assert rows(read_accumulated(spark.read.parquet(sink))) == counts


def test_streams_of_an_empty_table(spark, tmp_dir):
    from skewkit.plans.streams import STREAM_QUERIES
    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema
    spark.createDataFrame([], schema).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    for name, query in STREAM_QUERIES.items():
        assert query(spark, tmp_dir).collect() == [], name


def test_cli_streams(spark, tmp_dir):
    from skewkit import cli
    msgs = _messages(spark, WORDS)
    src = os.path.join(tmp_dir, "src")
    msgs.write.parquet(src)
    for program in ("word-counts", "running-counts", "per-record", "window-counts", "sales", "word-table", "sales-table"):
        sink, ckpt = os.path.join(tmp_dir, program, "sink"), os.path.join(tmp_dir, program, "ckpt")
        cli.main(["stream", program, "--source", src, "--sink", sink, "--checkpoint", ckpt, "--once"])
        assert os.path.isdir(sink)
    assert rows(read_accumulated(spark.read.parquet(os.path.join(tmp_dir, "word-counts", "sink")))) == rows(batch_word_count(msgs))
    from skewkit.streaming.tables import count_table
    assert rows(count_table(spark, os.path.join(tmp_dir, "word-table", "sink")).read()) == rows(batch_word_count(msgs))
    sink, ckpt = os.path.join(tmp_dir, "slide", "sink"), os.path.join(tmp_dir, "slide", "ckpt")
    cli.main(["stream", "window-counts", "--source", src, "--sink", sink, "--checkpoint", ckpt, "--once", "--length", "10 seconds", "--slide", "4 seconds"])
    assert spark.read.parquet(sink).selectExpr("max(window_end - window_start) AS n").first()["n"].total_seconds() == 2
