"""Property tests: JVM split semantics, and salted forms equal plain forms."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from skewkit.functions.text import java_split
from skewkit.operators.joins import salted_join
from skewkit.operators.topn import count_per_key, plain_topn, salted_count, salted_topn

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def jvm_split(s: str, sep: str) -> list[str]:
    """Model of java.lang.String.split(sep) for a literal separator (limit 0)."""
    if s == "":
        return [""]
    parts = re.split(re.escape(sep), s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab,\t \n\r\x0b\x85\u2028\u2029", max_size=8), min_size=1, max_size=40),
       st.sampled_from([",", "\t", " "]))
def test_java_split_matches_jvm_model(spark, values, sep):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r["i"]: list(r["f"]) for r in df.select("i", java_split("v", sep).alias("f")).collect()}
    assert [got[i] for i in range(len(values))] == [jvm_split(v, sep) for v in values]


keys = st.one_of(st.none(), st.sampled_from(["a", "b", "a_b", "", "hot"]))
records = st.lists(st.tuples(keys, st.sampled_from(["u1", "u2", "u3", None])), max_size=60)


@SETTINGS
@given(records, st.integers(min_value=1, max_value=10))
def test_salted_count_and_topn_equal_plain(spark, recs, n_salts):
    df = spark.createDataFrame(recs, "site string, url string")
    assert rows(salted_count(df, ["site", "url"], n_salts=n_salts)) == rows(count_per_key(df, ["site", "url"]))
    assert rows(salted_topn(df, "site", "url", n=2, n_salts=n_salts)) == rows(plain_topn(df, "site", "url", n=2))


@SETTINGS
@given(records, records, st.integers(min_value=1, max_value=6),
       st.sampled_from(["inner", "left", "left_semi", "left_anti"]))
def test_salted_join_equals_plain(spark, left, right, n_salts, how):
    lhs = spark.createDataFrame([(i, s, u) for i, (s, u) in enumerate(left)], "lid int, site string, url string")
    rhs = spark.createDataFrame([(i, s, u) for i, (s, u) in enumerate(right)], "rid int, site string, url string")
    plain = rows(lhs.join(rhs, ["site", "url"], how))
    assert rows(salted_join(lhs, rhs, ["site", "url"], how=how, n_salts=n_salts, by=["lid"])) == plain
    hot = lhs.where(F.col("site") == "hot").select("site", "url")
    assert rows(salted_join(lhs, rhs, ["site", "url"], how=how, n_salts=n_salts, by=["lid"], hot_keys=hot)) == plain
