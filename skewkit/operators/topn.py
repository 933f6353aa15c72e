"""Counting and Top-N per group, in plain and two-phase salted form.

All operators are DataFrame in -> DataFrame out and stay in built-in
expressions, so they compile to hash aggregates with map-side combine and to
``WindowGroupLimit`` for ``row_number() <= n`` (Spark inserts a partial limit
before the exchange, so a hot group ships at most ``n`` rows per map task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewkit.session import scratch_path


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def salt_column(n_salts: int, by: Sequence[str | Column] | None = None, seed: int = 0) -> Column:
    """Integer salt in ``[0, n_salts)`` as a pure function of its inputs.

    ``by`` names columns that vary inside a hot key (a row id is ideal). With
    ``by=None`` the salt hashes the input partition id, so rows of one hot key
    that come from different input splits spread over the salts. Either way
    the value does not depend on row order or on a random generator, so a
    re-run task after an executor loss draws the same salts.
    """
    if n_salts < 1:
        raise ValueError("n_salts must be >= 1")
    if n_salts == 1:
        return F.lit(0)
    return F.pmod(F.xxhash64(F.lit(seed), *_salt_inputs(by)), F.lit(n_salts)).cast("int")


def _salt_inputs(by: Sequence[str | Column] | None) -> list[Column]:
    """Columns a salt is hashed from: ``by``, else the input partition id."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (by or [])]
    return parts or [F.spark_partition_id()]


def add_salt(df: DataFrame, n_salts: int, by: Sequence[str] | None = None,
             seed: int = 0, name: str = "salt") -> DataFrame:
    """Append the salt as its own integer column (never glued into the key)."""
    return df.withColumn(name, salt_column(n_salts, by, seed))


def count_per_key(df: DataFrame, keys: str | Sequence[str], name: str = "cnt") -> DataFrame:
    """``count(*)`` per key; Spark combines map-side before the exchange."""
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias(name))


def salted_count(df: DataFrame, keys: str | Sequence[str], n_salts: int = 9,
                 by: Sequence[str] | None = None, seed: int = 0, name: str = "cnt") -> DataFrame:
    """Two-phase count: partial counts per (salt, key), then sum per key.

    Equal to :func:`count_per_key` for every ``n_salts``. The first exchange is
    on (salt, key), so a single hot key's partial counts are spread over ``n_salts``
    reducers. By default the salt is drawn by the input partition: a map task then
    emits one partial row per key, as many as the plain count, and reads no
    other column. ``by`` draws it by row instead, at up to ``n_salts`` partial rows per
    key and task.
    """
    keys = _names(keys)
    salted = df.select(*keys, salt_column(n_salts, by, seed).alias("_salt"))
    partial = salted.groupBy("_salt", *keys).agg(F.count(F.lit(1)).alias("_part"))
    return partial.groupBy(*keys).agg(F.sum("_part").cast("long").alias(name))


def distinct_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Distinct key values, left distributed (never collected to the driver)."""
    return df.select(*_names(keys)).distinct()


def topn_per_group(df: DataFrame, group: str | Sequence[str], order: str,
                   n: int | None = 2, tie: str | Sequence[str] = (),
                   name: str = "rn", descending: bool = True) -> DataFrame:
    """Keep the first ``n`` rows per group by ``order`` (desc), ties broken by ``tie`` asc.

    The rank is returned as column ``name`` (1-based, int). ``n=None`` keeps all
    rows, ranked.
    """
    order_col = F.col(order).desc() if descending else F.col(order).asc()
    w = Window.partitionBy(*_names(group)).orderBy(order_col, *[F.col(t).asc() for t in _names(tie)])
    ranked = df.withColumn(name, F.row_number().over(w))
    return ranked if n is None else ranked.where(F.col(name) <= n)


# Our parameter: rows that one task of :func:`rank_all` numbers.
ROWS_PER_RANGE = 2_000_000


def rank_all(df: DataFrame, group: str | Sequence[str], order: str, tie: str | Sequence[str] = (),
             name: str = "rn", descending: bool = True, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``row_number()`` of every row in its group, by ``order`` and then ``tie``, without a task that holds a group.

    Equal to :func:`topn_per_group` with ``n=None``, but as a long. Rows are dealt into ranges of (group, order, tie), so a hot group is many
    ranges and a small one shares its range. Rows are numbered inside (group, range), and each adds the
    rows of its group's earlier ranges. Only groups that lie in several ranges have any: at most two for each range, a table
    that is always small. The numbered rows are written once: ranges are cut by a sample, and both readers must see the same.
    """
    if rows_per_range < 1:
        raise ValueError("rows_per_range must be >= 1")
    groups, ties = _names(group), _names(tie)
    by = [F.col(order).desc() if descending else F.col(order).asc(), *[F.col(t).asc() for t in ties]]
    spark, rows = df.sparkSession, df.count()
    parts = max(1, -(-rows // rows_per_range))
    # a range's rows come together, and stay apart from those of the same group in other ranges
    dealt = df.repartitionByRange(parts, *[F.col(g).asc() for g in groups], *by).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy(*groups, "_range").orderBy(*by)
    numbered = dealt.withColumn("_r", F.row_number().over(inside).cast("long"))
    path = scratch_path(spark, "ranked")
    numbered.write.mode("overwrite").parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    # a struct of nulls equals a struct of nulls, so groups with null keys join too
    key = F.struct(*[F.col(g) for g in groups])
    sizes = numbered.groupBy(key.alias("_g"), "_range").agg(F.max("_r").alias("_n"))
    spread = sizes.groupBy("_g").agg(F.collect_list(F.struct("_range", "_n")).alias("_parts")).where(F.size("_parts") > 1)
    before = spread.select("_g", F.explode(F.expr(
        "transform(_parts, p -> struct(p._range as _range, "
        "aggregate(filter(_parts, q -> q._range < p._range), 0L, (s, q) -> s + q._n) as _before))")).alias("_p")).select("_g", "_p.*")
    joined = numbered.withColumn("_g", key).join(F.broadcast(before), ["_g", "_range"], "left")
    return joined.withColumn(name, F.col("_r") + F.coalesce("_before", F.lit(0))).select(*df.columns, name)


def topn_distinct_counts(counts: DataFrame, group: str | Sequence[str], key: str,
                         cnt: str = "cnt", n: int | None = 2, name: str = "rn") -> DataFrame:
    """Top ``n`` *distinct* count values per group, one row per value.

    Each count value is represented by its smallest key. ``n=None`` returns
    every distinct count per group, ranked descending.
    """
    group = _names(group)
    rep = counts.groupBy(*group, cnt).agg(F.min(key).alias(key))
    return topn_per_group(rep, group, cnt, n=n, name=name).select(*group, key, cnt, name)


def salted_topn(df: DataFrame, group: str, key: str, n: int = 2, n_salts: int = 9,
                by: Sequence[str] | None = None, seed: int = 0,
                cnt: str = "cnt", name: str = "rn") -> DataFrame:
    """Counts of (group, key) by the two-phase salted count, then tie-safe Top-N."""
    counts = salted_count(df, [group, key], n_salts=n_salts, by=by, seed=seed, name=cnt)
    return topn_per_group(counts, group, cnt, n=n, tie=key, name=name)


def plain_topn(df: DataFrame, group: str, key: str, n: int = 2,
               cnt: str = "cnt", name: str = "rn") -> DataFrame:
    """Counts of (group, key) by one aggregate, then tie-safe Top-N."""
    counts = count_per_key(df, [group, key], name=cnt)
    return topn_per_group(counts, group, cnt, n=n, tie=key, name=name)
