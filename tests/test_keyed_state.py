"""Running counts in keyed state: arrival order, starting state, idle words, and reads of the state store."""

import datetime as dt
import os
import time
from collections import Counter

import pytest

from conftest import rows
from oracle_check import compare, duck_connection
from skewkit.plans.oracle import ORACLE_SQL
from skewkit.plans.registry import all_queries
from skewkit.sources.messages import MESSAGE_SCHEMA, message_stream
from skewkit.streaming import apps
from skewkit.streaming.jobs import run_available
from skewkit.streaming.keyed_state import read_state_counts

T0 = dt.datetime(2024, 1, 1)
BATCHES = [[(0, 900, "a,b"), (1, 0, "a"), (0, 901, "c")], [(0, 902, "b,a"), (1, 1, "c")], [(1, 2, "b"), (0, 903, "a,c,,")]]


class Replay:
    def __init__(self, spark, folder, **options):
        self.spark, self.options = spark, options
        self.src, self.ckpt, self.sink = (os.path.join(folder, n) for n in ("src", "ckpt", "sink"))

    def land(self, records):
        frame = self.spark.createDataFrame([("t", p, o, T0, w) for p, o, w in records], MESSAGE_SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(self.src)

    def start(self):
        return apps.start_running_counts_with_state(message_stream(self.spark, self.src), self.sink, self.ckpt, every=None,
                                                    state_partitions=2, **self.options)

    def run(self, records):
        self.land(records)
        run_available(self.start())

    def rows(self):
        return rows(self.spark.read.parquet(self.sink).select("word", "running_cnt", "idle"))


def numbered(batches, start=()):
    seen, out = Counter(dict(start)), []
    for batch in batches:
        for _, _, words in batch:
            for w in words.rstrip(",").split(","):
                seen[w] += 1
                out.append((w, seen[w], False))
    return sorted(out)


def test_numbers_go_on_over_restarts(spark, tmp_dir):
    initial = [("a", 10), ("z", 4), ("c", 1)]
    table = spark.createDataFrame(initial, "word string, cnt long")
    rp = Replay(spark, tmp_dir, initial=table)
    for batch in BATCHES:
        rp.run(batch)                                     # each run is a restart; the state goes on
    assert rp.rows() == numbered(BATCHES, initial)
    rp.land([(1, 1, "c")])                                # that offset of that partition was counted
    with pytest.raises(Exception, match="goes back"):
        rp.start().awaitTermination()


def test_idle_words_are_timed_out(spark, tmp_dir):
    rp = Replay(spark, tmp_dir, idle_ms=6_000)
    rp.run([(0, 0, "a,a,b")])
    time.sleep(7)
    rp.run([(0, 1, "c,b")])                               # a and b were away for longer
    got = rp.rows()
    assert ("a", 2, True) in got and got.count(("a", 2, True)) == 1
    # b occurs in the very batch that finds its timer run out: counted on, renewed or timed out, its numbers never repeat
    assert [r for r in got if r[0] == "b" and not r[2]] in ([("b", 1, False), ("b", 2, False)], [("b", 1, False), ("b", 1, False)])
    rp.run([(0, 2, "a,c")])
    got = rp.rows()
    assert got.count(("a", 1, False)) == 2 and ("a", 3, False) not in got       # a starts again
    assert [r for r in got if r[0] == "c" and not r[2]] [:1] == [("c", 1, False)]


def test_a_words_batch_comes_in_frames(spark, tmp_dir):
    """More rows of a word than a frame holds: numbered without gaps."""
    rp = Replay(spark, tmp_dir)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rp.run([(i % 3, i, "hot") for i in range(400)])
        rp.run([(i % 3, 400 + i, "hot,cold") for i in range(100)])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [n for w, n, _ in rp.rows() if w == "hot"] == list(range(1, 501))


def test_counts_read_from_the_state_store(spark, tmp_dir):
    rp = Replay(spark, tmp_dir)
    assert read_state_counts(spark, rp.ckpt).collect() == []
    want = Counter()
    for batch in BATCHES:
        rp.land(batch)
        run_available(apps.start_running_counts_in_state(message_stream(spark, rp.src), rp.ckpt, every=None, state_partitions=2))
        want.update(w for _, _, words in batch for w in words.rstrip(",").split(","))
        assert dict(rows(read_state_counts(spark, rp.ckpt))) == want
    assert not os.path.exists(rp.sink)


@pytest.mark.parametrize("name", ["stream_running_state_resumed", "stream_running_store", "left_lookup_hot", "rank_all_events"])
def test_registered_queries_match_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    ok, said = compare(all_queries()[name](spark, sf), duck_connection(sf), ORACLE_SQL[name])
    assert ok, said
