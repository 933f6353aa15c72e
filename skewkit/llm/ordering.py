"""Order-dependent results over a whole table without one task seeing it all.

Rows are dealt into ranges of an id by splits read from approximate
quantiles. Within a range a window or a sorted partition does the work; only
one number per range is added up across ranges.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def range_splits(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` increasing values that cut ``column`` into ranges of similar counts."""
    if parts < 2:
        return []
    probabilities = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(column, F.lit(probabilities), F.lit(20 * parts)).alias("s")).first()["s"]
    return sorted(set(found or []))


def range_index(column: str, splits: list[int]):
    """Index of a row's range: 0 up to ``len(splits)``. A null value is in range 0."""
    edges = np.asarray(splits, dtype=np.int64)

    @F.pandas_udf("int")
    def index(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(edges, ids.fillna(np.iinfo(np.int64).min).to_numpy(np.int64), side="right")
        return pd.Series(at.astype(np.int32))

    return index(F.coalesce(F.col(column).cast("long"), F.lit(-(2 ** 63)).cast("long")))


def default_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def prefix_sums(df: DataFrame, order: list[str], value: str, out: str, splits: list[int]) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one, by ``order``.

    ``order[0]`` is the integer column that ``splits`` cut. Nulls come first. ``df`` is read
    twice, so it should be a staged or cheap table.
    """
    return prefix_sums_by_range(df.withColumn("_range", range_index(order[0], splits)), order, value, out).drop("_range")


def prefix_sums_by_range(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """As ``prefix_sums``, for rows whose column ``_range`` already tells the range. One total per range is
    summed up on the driver."""
    totals = {r["_range"]: r["s"] or 0 for r in df.groupBy("_range").agg(F.sum(value).alias("s")).collect()}
    before, rows = 0, []
    for part in sorted(totals):
        rows.append((part, before))
        before += totals[part]
    base = df.sparkSession.createDataFrame(rows, "_range int, _before long")
    running = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in order]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_inside", F.coalesce(F.sum(value).over(running), F.lit(0)))
            .join(F.broadcast(base), "_range")
            .withColumn(out, F.col("_before") + F.col("_inside"))
            .drop("_before", "_inside"))
