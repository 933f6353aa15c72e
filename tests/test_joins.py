import pytest
from pyspark.sql import functions as F

from conftest import rows
from skewkit.operators.joins import (
    broadcast_left_join, broadcast_lookup_join, fits_broadcast, heavy_keys, join_topn, matched_pairs,
    replicate, salted_join,
)
from skewkit.operators.topn import count_per_key


def test_salted_join_golden_multiplicity(site_log):
    # A = B = site log: plain join multiplicity 1+4+1+1 + 9+1+4 = 21
    j = salted_join(site_log, site_log, ["site", "url"], n_salts=10)
    assert j.count() == 21
    assert rows(j) == rows(site_log.join(site_log, ["site", "url"]))


def test_matched_pairs_golden(site_log):
    assert matched_pairs(site_log, site_log, ["site", "url"]).count() == 7


def test_join_topn_equals_counts(site_log):
    got = rows(join_topn(site_log, site_log, "site", "url", n=None), "site", "url", "cnt")
    counts = count_per_key(site_log, ["site", "url"])
    from skewkit.operators.topn import topn_distinct_counts
    assert got == rows(topn_distinct_counts(counts, "site", "url", n=None), "site", "url", "cnt")


def test_join_topn_right_duplicates_do_not_multiply(spark):
    a = spark.createDataFrame([("s", "u")] * 3 + [("s", "v")], "site string, url string")
    b = spark.createDataFrame([("s", "u")] * 5 + [("t", "v")], "site string, url string")
    assert rows(join_topn(a, b, "site", "url"), "url", "cnt") == [("u", 3)]


def test_left_lookup_golden(spark):
    people = spark.createDataFrame([("110", "zs"), ("220", "ls")], "id string, course string")
    schools = spark.createDataFrame([("110", "school1", 1), ("111", "school2", 2)],
                                    "id string, schoolname string, num int")
    got = broadcast_left_join(schools, people, "id")
    assert got.columns == ["id", "schoolname", "num", "course"]
    assert rows(got) == [("110", "school1", 1, "zs"), ("111", "school2", 2, None)]


def test_inner_lookup_golden_and_duplicate_keys(spark):
    people = spark.createDataFrame([("110", "zs", 1), ("220", "ls", 2), ("110", "ww", 3)],
                                   "id string, course string, seq int")
    schools = spark.createDataFrame([("110", "school1", 1), ("111", "school2", 2)],
                                    "id string, schoolname string, num int")
    got = broadcast_lookup_join(schools, people, "id", order_by="seq")
    # duplicate key 110 on the small side: the largest seq wins, deterministically
    assert rows(got, "id", "course", "schoolname") == [("110", "ww", "school1")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_with_nulls_and_hot_key(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7))
        .otherwise(F.col("id") % 50).cast("long").alias("k"), F.col("id").alias("lid"))
    right = spark.range(120).select((F.col("id") % 60).cast("long").alias("k"), F.col("id").alias("rid"))
    right = right.unionByName(spark.createDataFrame([(None, 999)], "k long, rid long"))
    plain = left.join(right, "k", how)
    assert rows(salted_join(left, right, "k", how=how, n_salts=5, by=["lid"])) == rows(plain)
    hot = heavy_keys(left, "k", rows=600)
    assert rows(hot, "k") == [(7,)]
    assert rows(salted_join(left, right, "k", how=how, n_salts=5, by=["lid"], hot_keys=hot)) == rows(plain)


@pytest.mark.parametrize("how", ["right", "full", "outer", "cross"])
def test_salted_join_rejects_types_that_would_duplicate(site_log, how):
    with pytest.raises(ValueError):
        salted_join(site_log, site_log, "site", how=how)


def test_replicate_equals_union_form(site_log):
    rep = replicate(site_log, 10, "i")
    union = None
    for i in range(10):
        part = site_log.withColumn("i", F.lit(i))
        union = part if union is None else union.unionByName(part)
    assert rows(rep) == rows(union)


def test_heavy_keys_bound(spark):
    df = spark.range(10_000).select((F.col("id") % 5).alias("k"))
    assert heavy_keys(df, "k", rows=2000).count() == 0
    assert heavy_keys(df, "k", rows=1999).count() == 5


def test_broadcast_only_within_bound(spark):
    big = spark.range(1000).select((F.col("id") % 10).alias("id"), F.col("id").alias("v"))
    small = spark.range(10).select("id", (F.col("id") * 2).alias("w"))
    assert fits_broadcast(small, 10) and not fits_broadcast(small, 9)
    plan_in = broadcast_left_join(big, small, "id", max_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan_in
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan_out = broadcast_left_join(big, small, "id", max_rows=5)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan_out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_size_counts_rows_and_bytes(spark):
    from skewkit.operators.joins import broadcast_size
    df = spark.createDataFrame([(1, "abc", [1, 2]), (2, None, None)], "k long, s string, a array<int>")
    n, b = broadcast_size(df)
    assert n == 2
    assert b == (16 + 8 + 8 + 3 + 8 + len('{"a":[1,2]}')) + (16 + 8 + 8 + 8 + len("{}"))
    assert fits_broadcast(df, max_rows=2, max_bytes=b) and not fits_broadcast(df, max_rows=2, max_bytes=b - 1)


def test_salted_join_right_hot_keys(spark):
    # key 1 is hot on the left, key 2 hot on the right, key 3 hot on both
    left = spark.range(2000).select(
        F.when(F.col("id") % 4 == 0, 1).when(F.col("id") % 4 == 1, 3).otherwise(F.col("id") % 40).cast("long").alias("k"),
        F.col("id").alias("lid"))
    right = spark.range(2000).select(
        F.when(F.col("id") % 4 == 0, 2).when(F.col("id") % 4 == 1, 3).otherwise(F.col("id") % 40).cast("long").alias("k"),
        F.col("id").alias("rid"))
    plain = rows(left.join(right, "k"))
    got = salted_join(left, right, "k", n_salts=4, by=["lid"], hot_keys="auto", rows_per_salt=150,
                      right_hot_keys="auto", right_by=["rid"])
    assert rows(got) == plain
    only_right = salted_join(left, right, "k", n_salts=4, right_hot_keys="auto", rows_per_salt=150, right_by=["rid"])
    assert rows(only_right) == plain
    for how in ("left", "left_semi", "left_anti"):
        got = salted_join(left, right, "k", how=how, by=["lid"], hot_keys="auto", right_hot_keys="auto", right_by=["rid"], rows_per_salt=150)
        assert rows(got) == rows(left.join(right, "k", how))


def test_hot_key_salting_engages_on_skewed_lineitem(spark):
    # a third of lineitem rows moved onto one partkey: the key is found and salted
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    skewed = li.select(F.when(F.col("l_linenumber") == 1, F.lit(-1)).otherwise(F.col("l_partkey")).alias("k"),
                       "l_orderkey", "l_linenumber")
    right = skewed.select("k").distinct().withColumn("tag", F.col("k") % 7)
    hot = heavy_keys(skewed, "k", rows=600)
    assert rows(hot, "k") == [(-1,)]
    joined = salted_join(skewed, right, "k", n_salts=8, by=["l_orderkey", "l_linenumber"], hot_keys=hot, rows_per_salt=500)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(0, l_orderkey" in plan
    assert rows(joined) == rows(skewed.join(right, "k"))


def test_salts_grow_with_the_hot_key(spark):
    from skewkit.operators.joins import _hot_table
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, 2).otherwise(F.col("id") % 50 + 10)
        .cast("long").alias("k"), F.col("id").alias("lid"))
    right = spark.range(200).select((F.col("id") % 60).cast("long").alias("k"), F.col("id").alias("rid"))
    hot = heavy_keys(left, "k", rows=100)
    assert rows(hot) == [(1, 1000), (2, 200)]
    assert rows(_hot_table(hot, ["k"], 2, 100, "n")) == [(1, 10), (2, 2)]
    assert rows(_hot_table(hot.drop("_n"), ["k"], 7, 100, "n")) == [(1, 7), (2, 7)]
    got = salted_join(left, right, "k", by=["lid"], hot_keys=hot, rows_per_salt=100)
    assert rows(got) == rows(left.join(right, "k"))


MIXED = [("int", "bigint"), ("bigint", "int"), ("float", "double"), ("decimal(5,1)", "decimal(12,3)"),
         ("date", "timestamp"), ("int", "double"), ("string", "int")]


@pytest.mark.parametrize("types", MIXED, ids="-".join)
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_mixed_key_types_equal_the_plain_join(spark, types, how):
    def key(kind):
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("k").cast("int"))
        return (day if kind in ("date", "timestamp") else F.col("k")).cast(kind)
    base = spark.range(400).select(F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 2 == 0, 7)
                                   .otherwise(F.col("id") % 30).alias("k"), F.col("id").alias("lid"))
    left = base.select(key(types[0]).alias("k"), "lid")
    right = spark.range(20).select(F.col("id").alias("k"), F.col("id").alias("rid")).select(key(types[1]).alias("k"), "rid")
    plain = left.join(right, "k", how)
    for keys in (None, "auto"):
        got = salted_join(left, right, "k", how=how, n_salts=3, hot_keys=keys, rows_per_salt=20)
        assert got.dtypes == plain.dtypes and rows(got) == rows(plain)


def test_keys_hot_on_both_sides_meet_once(spark):
    left = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(200).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("b"))
    got = salted_join(left, right, "k", by=["a"], hot_keys="auto", right_hot_keys="auto", right_by=["b"], rows_per_salt=50)
    assert got.count() == 60_000 == got.distinct().count()


def test_null_keys_are_spread_and_kept(spark):
    left = spark.range(5000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("lid"))
    right = spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("rid"))
    for how, n in (("inner", 0), ("left", 5000), ("left_anti", 5000), ("left_semi", 0)):
        assert salted_join(left, right, "k", how=how, hot_keys="auto").count() == n
    left = left.unionByName(spark.range(9).select(F.col("id").alias("k"), F.col("id").alias("lid")))
    joined = salted_join(left, right, "k", how="left", hot_keys="auto", hint="merge")
    assert "1000" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_bounds_reach_the_size_check(spark):
    big = spark.range(100).select((F.col("id") % 10).alias("id"))
    small = spark.range(10).select("id", F.col("id").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bytes_, found in ((10**6, True), (10, False)):
            for joined in (broadcast_left_join(big, small, "id", max_bytes=bytes_),
                           broadcast_lookup_join(big, small, "id", "w", max_bytes=bytes_)):
                assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) == found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _skewed(spark, n, shares):
    """``n`` rows: key ``i`` has ``shares[i]`` of them, the rest are distinct."""
    spread, start = F.col("id") * 7919 % n, 0            # a permutation: hot rows lie all over the partitions
    key = F.col("id") + 1_000_000
    for k, share in enumerate(shares):
        key = F.when((spread >= start) & (spread < start + share), F.lit(k)).otherwise(key)
        start += share
    return spark.range(n).repartition(12).select(key.cast("long").alias("k"), F.col("id").alias("row"))


@pytest.mark.parametrize("shares", [[], [4000], [900, 899, 901, 2500, 10], [30] * 100], ids=["flat", "one", "near the bound", "many small"])
def test_sketched_search_equals_the_exact_one(spark, shares):
    df = _skewed(spark, 20_011, shares)
    for tracked in (256, 1 << 15):
        for bound in (900, 200):
            from skewkit.operators.joins import sketched_bound
            exact = rows(heavy_keys(df, "k", rows=bound, tracked=None))
            sketched = rows(heavy_keys(df, "k", rows=bound, tracked=tracked))
            sure = sketched_bound(bound, 20_011, tracked)
            assert set(sketched) <= set(exact) and {r for r in exact if r[1] > sure} <= set(sketched)
            if sure == bound:
                assert sketched == exact


def test_every_key_above_the_bound_is_a_candidate(spark):
    from skewkit.operators.joins import heavy_candidates, sketched_bound
    df = _skewed(spark, 60_013, [600 + 40 * i for i in range(30)])
    tracked = 512                                         # fewer than the distinct keys of a task: the sketch has to forget
    sure = sketched_bound(1, 60_013, tracked)
    hashes, total = heavy_candidates(df, "k", 1, tracked)
    assert total == 60_013 and len(hashes) <= tracked
    want = {r["h"] for r in df.groupBy("k").count().where(F.col("count") > sure).select(F.xxhash64("k").alias("h")).collect()}
    assert len(want) > 5 and want <= set(hashes)


def test_the_search_exchanges_no_distinct_keys(spark):
    df = _skewed(spark, 20_011, [4000])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = heavy_keys(df, "k", rows=900)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the only exchange of keys comes after the candidates' rows were picked
    assert plan.index("Exchange hashpartitioning(k") < plan.index("LeftSemi")
    assert heavy_keys(df.limit(0), "k").count() == 0
    assert rows(heavy_keys(df.withColumn("k", F.when(F.col("k") > 0, F.col("k"))), "k", rows=900)) == []


def test_a_join_with_nothing_hot_is_the_plain_join(spark):
    left, right = _skewed(spark, 3001, []), _skewed(spark, 301, [])
    got = salted_join(left, right.withColumnRenamed("row", "r"), "k", hot_keys="auto", right_hot_keys="auto", rows_per_salt=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "explode" not in plan
    assert rows(got) == rows(left.join(right.withColumnRenamed("row", "r"), "k"))


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_keys", [None, "auto"])
def test_left_joins_with_keys_hot_on_the_right(spark, how, hot_keys):
    left = spark.range(600).select(F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 == 0, 1).when(F.col("id") % 5 == 0, 999)
                                   .otherwise(F.col("id") % 40).cast("int").alias("k"), F.col("id").alias("v"))
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, 2).when(F.col("id") % 11 == 0, None)
                                    .otherwise(F.col("id") % 60).cast("long").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = salted_join(left, right, "k", how=how, by=["v"], hot_keys=hot_keys, right_hot_keys="auto", right_by=["v"], rows_per_salt=50)
        plain = left.join(right, "k", how)
        assert got.columns == plain.columns and got.dtypes == plain.dtypes
        key = lambda r: tuple((x is not None, x) for x in r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
        if how == "left":
            beyond = broadcast_left_join(left, right, "k", max_rows=5, rows_per_salt=50, by=["v"], right_by=["v"])
            assert sorted(map(tuple, beyond.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
            assert "explode" in beyond._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
