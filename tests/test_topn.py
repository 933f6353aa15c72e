import pytest
from pyspark.sql import functions as F

from conftest import rows
from skewkit.operators.topn import (
    add_salt, count_per_key, distinct_keys, plain_topn, salted_count, salted_topn,
    topn_distinct_counts, topn_per_group,
)

B, G = "www.baidu.com", "www.google.com"


def test_counts_golden(site_log):
    got = rows(count_per_key(site_log, ["site", "url"]))
    assert got == [(B, "url1", 1), (B, "url2", 2), (B, "url3", 1), (B, "url4", 1),
                   (G, "url1", 3), (G, "url2", 1), (G, "url3", 2)]


def test_topn_per_group_golden_ties_by_url(site_log):
    got = rows(plain_topn(site_log, "site", "url", n=2), "site", "url", "cnt", "rn")
    assert got == [(B, "url1", 1, 2), (B, "url2", 2, 1), (G, "url1", 3, 1), (G, "url3", 2, 2)]


@pytest.mark.parametrize("n_salts", [1, 3, 9, 10])
def test_salted_equals_plain(site_log, n_salts):
    assert rows(salted_topn(site_log, "site", "url", n=2, n_salts=n_salts)) == \
        rows(plain_topn(site_log, "site", "url", n=2))
    assert rows(salted_count(site_log, ["site", "url"], n_salts=n_salts)) == \
        rows(count_per_key(site_log, ["site", "url"]))


def test_topn_distinct_counts_golden(site_log):
    counts = count_per_key(site_log, ["site", "url"])
    got = rows(topn_distinct_counts(counts, "site", "url", n=2), "site", "url", "cnt")
    assert got == [(B, "url1", 1), (B, "url2", 2), (G, "url1", 3), (G, "url3", 2)]
    every = rows(topn_distinct_counts(counts, "site", "url", n=None), "site", "url", "cnt", "rn")
    assert every == [(B, "url1", 1, 2), (B, "url2", 2, 1),
                     (G, "url1", 3, 1), (G, "url2", 1, 3), (G, "url3", 2, 2)]


def test_site_with_underscore_is_not_cut(spark):
    df = spark.createDataFrame([("a_b", "u"), ("a_b", "u"), ("a", "u"), ("a_c", "v")], "site string, url string")
    got = rows(salted_count(df, ["site", "url"], n_salts=3))
    assert got == [("a", "u", 1), ("a_b", "u", 2), ("a_c", "v", 1)]


def test_null_keys_and_empty_input(spark):
    df = spark.createDataFrame([(None, "u"), (None, "u"), ("s", None)], "site string, url string")
    got = rows(salted_count(df, ["site", "url"], n_salts=4), "site", "url", "cnt")
    assert got == [(None, "u", 2), ("s", None, 1)]
    empty = df.where(F.lit(False))
    assert salted_topn(empty, "site", "url").count() == 0
    assert topn_distinct_counts(count_per_key(empty, ["site", "url"]), "site", "url").count() == 0


def test_one_site_only_and_all_ties(spark):
    df = spark.createDataFrame([("s", f"u{i}") for i in range(5)], "site string, url string")
    got = rows(plain_topn(df, "site", "url", n=2), "url", "rn")
    assert got == [("u0", 1), ("u1", 2)]
    assert rows(topn_distinct_counts(count_per_key(df, ["site", "url"]), "site", "url"), "url", "cnt") == [("u0", 1)]


def test_hot_key_salted_spreads_and_matches(spark):
    # 90 % of the rows on one (site, url): the salted count must still be exact
    df = spark.range(10_000).select(
        F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("site"),
        F.when(F.col("id") % 10 < 9, F.lit("u")).otherwise((F.col("id") % 13).cast("string")).alias("url"),
        F.col("id"))
    salted = salted_count(df, ["site", "url"], n_salts=9, by=["id"])
    assert rows(salted) == rows(count_per_key(df, ["site", "url"]))
    spread = add_salt(df.where(F.col("site") == "hot"), 9, by=["id"]).groupBy("salt").count()
    counts = [r["count"] for r in spread.collect()]
    assert len(counts) == 9 and min(counts) > 800


def test_salt_is_deterministic(spark):
    df = spark.range(1000).withColumn("k", F.lit("a"))
    a = rows(add_salt(df, 10, by=["id"]))
    b = rows(add_salt(df, 10, by=["id"]))
    assert a == b
    assert {r[2] for r in a} == set(range(10))


def test_distinct_keys(site_log):
    assert rows(distinct_keys(site_log, "site")) == [(B,), (G,)]


def test_topn_per_group_n_none_ranks_all(site_log):
    counts = count_per_key(site_log, ["site", "url"])
    assert topn_per_group(counts, "site", "cnt", n=None, tie="url").count() == 7


@pytest.mark.parametrize("rows_per_range", [7, 100, 10_000])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_of_all_rows_equals_the_window(spark, rows_per_range, descending):
    from skewkit.operators.topn import rank_all
    # one group holds most rows, some groups are small, one is null; orders tie and are null at times
    df = spark.range(1500).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, None).otherwise(F.concat(F.lit("g"), (F.col("id") % 25).cast("string"))).alias("g"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") * 37 % 91).alias("v"), F.col("id").alias("tie")).repartition(5)
    want = topn_per_group(df, "g", "v", n=None, tie="tie", descending=descending)
    got = rank_all(df, "g", "v", tie="tie", descending=descending, rows_per_range=rows_per_range)
    assert got.columns == want.columns
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_no_range_holds_a_hot_group(spark):
    from skewkit.operators.topn import rank_all
    df = spark.range(4000).select(F.lit("hot").alias("g"), (F.col("id") * 7 % 4000).alias("v"))
    got = rank_all(df, "g", "v", rows_per_range=400)
    assert sorted(r["rn"] for r in got.collect()) == list(range(1, 4001))
    assert got.where("rn = 1").first()["v"] == 3999
    from skewkit.session import staged_paths
    numbered = spark.read.parquet(sorted(p for p in staged_paths(spark) if "ranked" in p)[-1])
    sizes = [r["count"] for p in staged_paths(spark) if "ranked" in p and spark.read.parquet(p).count() == 4000
             for r in spark.read.parquet(p).groupBy("_range").count().collect()]
    assert numbered is not None and len(sizes) >= 8 and max(sizes) < 1200


def test_ranks_of_an_empty_table(spark):
    from skewkit.operators.topn import rank_all
    assert rank_all(spark.createDataFrame([], "g string, v long"), "g", "v").collect() == []
