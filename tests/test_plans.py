"""Plan-shape checks: the physical plans we rely on for scale."""

from skewkit.plans import batch

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_topn_has_partial_group_limit_before_exchange(spark):
    plan = _plan(batch.topn_salted(spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(batch.topn_sql(spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_lookup_joins_broadcast_small_side(spark):
    assert "BroadcastHashJoin" in _plan(batch.left_lookup(spark, SF))
    assert "BroadcastHashJoin" in _plan(batch.inner_lookup(spark, SF))


def test_salted_join_replicates_with_one_scan(spark):
    plan = _plan(batch.salted_join_q(spark, SF))
    assert "Generate explode" in plan
    assert plan.count("customer.parquet") == 1


def test_wide_column_filter_reaches_scan(spark):
    plan = _plan(batch.wide_column(spark, SF))
    assert "PushedFilters: [" in plan and "EqualTo(cf,d)" in plan


def test_matched_pairs_is_semi_join(spark):
    assert "LeftSemi" in _plan(batch.matched_pairs_q(spark, SF))


def test_running_count_batch_shuffles_by_word_and_bucket(spark):
    import re
    plan = _plan(batch.running_count_batch(spark, SF))
    row_exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert any(e.startswith("_b#") for e in row_exchanges)      # (word, offset range)
    assert "ReusedExchange" in plan or plan.count("events.parquet") <= 2
    assert "Window [row_number()" in plan


def test_hot_joins_shuffle_on_key_and_pieces(spark):
    # at sf0.01 each event type has more rows than a piece holds; at sf0.001 none has, and the join is a plain one
    small = "/root/testdata/sf0.001"
    for q in (batch.salted_join_hot_left, batch.salted_join_hot_right):
        assert "explode" not in _plan(q(spark, small)) and "SortMergeJoin" in _plan(q(spark, small))
    for q in (batch.salted_join_hot_left, batch.salted_join_hot_right, batch.salted_join_hot_both):
        plan = _plan(q(spark, "/root/testdata/sf0.01"))
        assert "SortMergeJoin" in plan and ("_left#" in plan or "_right#" in plan) and "Generate explode" in plan


def test_join_topn_shuffles_counts_not_rows(spark):
    plan = _plan(batch.join_topn_q(spark, SF))
    assert "LeftSemi" not in plan and "partial_count(1)" in plan[plan.index("Inner"):]


def test_salted_count_combines_like_the_plain_one(spark):
    from skewkit.operators.topn import count_per_key, salted_count
    df = spark.read.parquet(f"{SF}/lineitem.parquet").repartition(6).cache()

    def partials(counts):
        from pyspark.sql import functions as F
        # rows that the map side emits: one per key (and salt) of a partition
        return counts(df.withColumn("task", F.spark_partition_id())).count()
    plain = partials(lambda d: count_per_key(d, ["task", "l_returnflag", "l_partkey"]))
    salted = partials(lambda d: d.selectExpr("task", "pmod(xxhash64(0, task), 9) AS salt", "l_returnflag", "l_partkey").distinct())
    assert salted == plain
    assert "l_orderkey" not in _plan(batch.count_salted_q(spark, SF))
    assert sorted(salted_count(df, ["l_returnflag"]).collect()) == sorted(count_per_key(df, ["l_returnflag"]).collect())
