"""Salted, broadcast and lookup equi-joins.

Design notes for scale:

* The salt is its own integer column; keys are never rewritten.
* Hot keys are those with more rows than one task should hold (``rows_per_salt``).
  A mergeable frequent-items sketch names the candidates: one state of bounded size per task is
  shuffled, no distinct key. Only the candidates are then counted exactly. Hot keys form a small table
  ``(key, salts)`` that is joined to both sides; a broadcast where it
  fits, a shuffle join where not. Where nothing is hot the join is a plain one.
* A side is broadcast only after its rows and estimated bytes were checked
  against bounds (:func:`fits_broadcast`, one aggregate job); beyond them the
  join stays a shuffle join, where AQE's skew-join splitting still applies.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewkit.operators.topn import _names, _salt_inputs, count_per_key, salt_column, topn_distinct_counts
from skewkit.session import scratch_path

# Join types for which a replicated right side cannot duplicate output rows:
# each left row meets exactly one replica, and unmatched right rows are never emitted.
SALTABLE_HOW = {"inner", "left", "leftouter", "left_outer", "semi", "leftsemi", "left_semi",
                "anti", "leftanti", "left_anti"}

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _row_bytes(df: DataFrame):
    """Upper estimate of a row's in-memory size: 8 bytes per fixed-width value,
    8 + octet length per string/binary, 8 + JSON length for nested values."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _FIXED_WIDTH):
            parts.append(F.lit(8))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.lit(8) + F.coalesce(F.octet_length(c), F.lit(0)))
        else:
            parts.append(F.lit(8) + F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)))
    return reduce(lambda a, b: a + b, parts, F.lit(16)).cast("long")


def broadcast_size(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of ``df`` in one aggregate job (map-side combined)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Size check of a broadcast candidate: rows and estimated bytes under both bounds."""
    rows, size = broadcast_size(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                         max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` fits both bounds, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def replicate(df: DataFrame, n: int, name: str = "salt") -> DataFrame:
    """``n`` copies of ``df`` tagged ``0..n-1`` in column ``name`` (one scan)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


# Our parameter: rows one salt of a hot key should hold (about one task's worth).
DEFAULT_ROWS_PER_SALT = 2_000_000
# Our parameter: pieces for left rows whose key is null. They match nothing, so no
# right row is replicated for them.
NULL_KEY_SALTS = 1_000

INNER_HOW = {"inner"}
LEFT_HOW = {"left", "leftouter", "left_outer"}


# Our parameter: items that a frequent-items sketch tracks (16 bytes each). The sketch's error is at most
# 3.5 / (4/3 * items) of the rows, and an item is listed for sure above twice that.
TRACKED_ITEMS = 1 << 15
SKETCH_SHARE = 2 * 3.5 * 0.75


def sketched_bound(rows: int, total: int, tracked: int = TRACKED_ITEMS) -> int:
    """Every key with more rows than this, of ``total``, is a candidate of :func:`heavy_candidates`."""
    return max(rows, int(SKETCH_SHARE * total / tracked))


def heavy_candidates(df: DataFrame, on: str | Sequence[str], rows: int = DEFAULT_ROWS_PER_SALT,
                     tracked: int = TRACKED_ITEMS) -> tuple[list[int], int]:
    """Hashes (``xxhash64``) of the keys that may have more than ``rows`` rows, and the number of rows with a key.

    One pass over the key columns. Each task folds its keys into a frequent-items sketch; states
    (at most ``tracked`` items each) are merged in two steps, first in as many groups as keep both steps small, then
    into one. Every key above :func:`sketched_bound` is among the candidates, and at most ``tracked`` are.
    """
    on = _names(on)
    keyed = df.select(*on).dropna(how="any", subset=on).select(F.xxhash64(*on).alias("_h"), F.spark_partition_id().alias("_p"))
    groups = max(1, int(keyed.sparkSession.sparkContext.defaultParallelism))
    states = (keyed.groupBy(F.pmod("_p", F.lit(groups)).alias("_g"))
              .agg(F.expr(f"approx_top_k_accumulate(_h, {tracked})").alias("_s"), F.count(F.lit(1)).alias("_n")))
    # grouped, so that an empty table gives no row: there is no state to combine
    found = (states.groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"), F.sum("_n").alias("_n"))
             .select(F.expr(f"approx_top_k_estimate(_s, {tracked})").alias("items"), "_n").first())
    if found is None:
        return [], 0
    total = int(found["_n"])
    # an estimate is a count's upper bound, so a key with more than ``rows`` rows has a larger one
    return [i["item"] for i in found["items"] if i["item"] is not None and i["count"] > rows], total


def heavy_keys(df: DataFrame, on: str | Sequence[str], rows: int = DEFAULT_ROWS_PER_SALT,
               tracked: int | None = TRACKED_ITEMS) -> DataFrame:
    """Keys with more than ``rows`` rows, with their exact row count in column ``_n``.

    With ``tracked`` (see :func:`heavy_candidates`) the rows of candidate keys only are counted, by a broadcast of
    at most ``tracked`` hashes: no exchange holds the distinct keys. Keys up to :func:`sketched_bound` may be left out where that is above
    ``rows``: with the default, keys of less than a 6,000th of all rows. ``tracked=None`` counts every key
    (combined map-side, so a hot key ships one row per task). Null keys never match and are left out.
    """
    if rows < 1:
        raise ValueError("rows must be >= 1")
    on = _names(on)
    keyed = df.select(*on).dropna(how="any", subset=on)
    if tracked is None:
        return count_per_key(keyed, on, name="_n").where(F.col("_n") > rows)
    return recount(df, on, rows, heavy_candidates(df, on, rows, tracked)[0])


def recount(df: DataFrame, on: str | Sequence[str], rows: int, hashes: list[int]) -> DataFrame:
    """Keys with more than ``rows`` rows among those with the given hashes, counted exactly."""
    on = _names(on)
    few = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hashes], "_h long"))
    keyed = df.select(*on).dropna(how="any", subset=on).join(few, F.xxhash64(*on) == F.col("_h"), "left_semi")
    return count_per_key(keyed, on, name="_n").where(F.col("_n") > rows)


def _searched(df: DataFrame, on: Sequence[str], rows: int | None) -> DataFrame | None:
    """Hot keys of a side; None where the sketch finds no candidate."""
    rows = rows or DEFAULT_ROWS_PER_SALT
    hashes, _ = heavy_candidates(df, on, rows)
    return recount(df, on, rows, hashes) if hashes else None


def _common_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[T.DataType] | None:
    """The types both sides' keys are compared in; None where text meets another type
    (whose comparison is not an equality of widened values)."""
    out = []
    for k in on:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if a != b and isinstance(a, T.StringType) != isinstance(b, T.StringType):
            return None
        out.append(a if a == b else left.select(k).limit(0).union(right.select(k).limit(0)).schema[k].dataType)
    return out


def _salt_by(df: DataFrame, by: Sequence[str] | None):
    """What a row's salt is drawn from: ``by``, else the row's columns and its input partition."""
    if by:
        return _salt_inputs(by)
    return [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)] + _salt_inputs(None)


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, (T.MapType, T.VariantType))


def _hot_table(keys: DataFrame, names: Sequence[str], n_salts: int, rows_per_salt: int | None, salts: str) -> DataFrame | None:
    """``(key, salts)``, one row per hot key, written once to the shared scratch folder; None if there is none."""
    if "_n" in keys.columns and rows_per_salt:
        n = F.greatest(F.ceil(F.col("_n") / F.lit(rows_per_salt)), F.lit(2)).cast("int")
    else:
        n = F.lit(n_salts)
    table = keys.select(*names, n.alias(salts)).dropna(how="any", subset=list(names))
    table = table.groupBy(*names).agg(F.max(salts).alias(salts))
    path = scratch_path(keys.sparkSession, "hot-keys")
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return keys.sparkSession.read.schema(table.schema).parquet(path) if seen.get["n"] else None


def salted_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
                n_salts: int = 10, by: Sequence[str] | None = None, seed: int = 0,
                hot_keys: DataFrame | str | None = None,
                right_hot_keys: DataFrame | str | None = None,
                right_by: Sequence[str] | None = None,
                rows_per_salt: int | None = DEFAULT_ROWS_PER_SALT, hint: str | None = None) -> DataFrame:
    """Equi-join with hot keys salted on one side and replicated on the other.

    Returns the same rows as ``left.join(right, on, how)``; ``how`` must be
    inner, left outer, left semi or left anti. Keys of different types are compared in
    their common type, as the plain join does (text against another type is joined plainly).

    With neither ``hot_keys`` nor ``right_hot_keys``, every key of the left side
    is salted and the right side replicated ``n_salts`` times (the reference
    form). ``hot_keys`` as a DataFrame of key values, or ``"auto"`` (keys with more than
    ``rows_per_salt`` left rows, see :func:`heavy_keys`), does
    that only for those keys; all other rows join plainly. A hot key whose row
    count is known gets ``ceil(count / rows_per_salt)`` salts (at least 2), others ``n_salts``,
    so a key holding a third of a huge table is cut into task-sized pieces.

    ``right_hot_keys`` (DataFrame or ``"auto"``) handles keys that are hot on the
    right: their right rows are salted (by ``right_by``) and their left rows replicated. A key that is
    hot on both sides gets a grid: left piece ``i`` meets right piece ``j`` in a group of its own. Replicated left rows must not
    come out more than once, so a left join is then the inner grid join and, beside it, the left rows whose key the right side's
    distinct keys do not hold; semi and anti joins only need these distinct keys.

    Left rows with a null key (left and anti joins keep them) are spread over ``NULL_KEY_SALTS``
    groups. ``by`` names the columns a row's piece is drawn from, best a row id; without it, all columns and the input
    partition. ``hint`` is a join hint for the right side, such as ``"merge"``.
    """
    on = _names(on)
    if how.lower() not in SALTABLE_HOW:
        raise ValueError(f"salted_join supports inner/left/left_semi/left_anti, not {how!r}: "
                         "a replicated right side would repeat unmatched right rows")
    for keys in (hot_keys, right_hot_keys):
        if isinstance(keys, str) and keys != "auto":
            raise ValueError("hot keys must be None, 'auto' or a DataFrame")
    types = _common_types(left, right, on)
    if types is None:
        return left.join(right if hint is None else right.hint(hint), on, how)
    if right_hot_keys is not None and how.lower() not in INNER_HOW:
        return _outer_with_right_hot(left, right, on, how.lower(), dict(
            n_salts=n_salts, by=by, seed=seed, hot_keys=hot_keys, rows_per_salt=rows_per_salt, hint=hint),
            right_hot_keys, right_by)
    keyed = [f"_k{i}" for i in range(len(on))]

    def with_keys(df: DataFrame) -> DataFrame:
        return df.withColumns({k: F.col(c).cast(t) for k, c, t in zip(keyed, on, types, strict=True)})

    lhs = with_keys(left.select(*on, *[F.col(f"`{c}`") for c in left.columns if c not in on]))
    rhs = with_keys(right)
    if hot_keys is None and right_hot_keys is None:   # the reference form: every key salted
        lhs = lhs.withColumn("_left", salt_column(n_salts, by, seed))
        rhs = replicate(rhs.drop(*on), n_salts, "_left")
        salts = ["_left"]
    else:
        salts = ["_left", "_right"]
        lhs = lhs.withColumn("_draw", F.xxhash64(F.lit(seed), *_salt_by(left, by)))
        rhs = rhs.withColumn("_draw", F.xxhash64(F.lit(seed + 1), *_salt_by(right, right_by))).drop(*on)
        hot = []
        for keys, side, name in ((hot_keys, lhs, "_nl"), (right_hot_keys, rhs, "_nr")):
            if isinstance(keys, str):
                keys = _searched(side, keyed, rows_per_salt)
            elif keys is not None:
                keys = keys.select(*[F.col(c).cast(t).alias(k) for k, c, t in zip(keyed, on, types, strict=True)],
                                   *(["_n"] if "_n" in keys.columns else []))
            hot.append(None if keys is None else _hot_table(keys, keyed, n_salts, rows_per_salt, name))
        if hot == [None, None] and how.lower() in INNER_HOW:      # nothing hot, and null keys come to nothing
            return left.join(right if hint is None else right.hint(hint), on, how)
        lhs, rhs = _grid(lhs, rhs, keyed, hot)
    if hint is not None:
        rhs = rhs.hint(hint)
    return lhs.join(rhs, keyed + salts, how).drop(*keyed, *salts)


def _outer_with_right_hot(left: DataFrame, right: DataFrame, on: list[str], how: str, options: dict,
                          right_hot_keys: DataFrame | str, right_by: Sequence[str] | None) -> DataFrame:
    """Left, semi and anti joins whose right side has hot keys (see :func:`salted_join`)."""
    keys = right.select(*on).distinct()
    if how not in LEFT_HOW:
        return salted_join(left, keys, on, how, **options)
    if isinstance(options["hot_keys"], str):                       # searched once for both parts
        hot = _searched(left, on, options["rows_per_salt"])
        if hot is not None:
            path = scratch_path(left.sparkSession, "hot-keys")
            hot.write.mode("overwrite").parquet(path)
            hot = left.sparkSession.read.schema(hot.schema).parquet(path)
        options = {**options, "hot_keys": hot}
    matched = salted_join(left, right, on, "inner", right_hot_keys=right_hot_keys, right_by=right_by, **options)
    if options["hot_keys"] is None:          # an empty list of hot keys: rows with a null key are still spread
        options["hot_keys"] = right.select(*on).limit(0)
    alone = salted_join(left, keys, on, "left_anti", **options)
    # by position: the sides may have columns of one name besides the key
    kinds = [f.dataType for f in matched.schema.fields]
    alone = alone.toDF(*[f"_a{i}" for i in range(len(alone.columns))])
    n = len(alone.columns)
    return matched.union(alone.select(*[F.col(c).cast(t) for c, t in zip(alone.columns, kinds, strict=False)],
                                      *[F.lit(None).cast(t).alias(f"_n{i}") for i, t in enumerate(kinds[n:])]))


def _grid(lhs: DataFrame, rhs: DataFrame, keyed: list[str],
          hot: list[DataFrame | None]) -> tuple[DataFrame, DataFrame]:
    """Both sides (with ``_draw``, the hash that a row's piece is drawn from) with ``_left`` and ``_right``: own piece of the side's hot keys, all pieces of the other side's."""
    sides = []
    for df, own in ((lhs, 0), (rhs, 1)):
        for table in hot:
            if table is not None:
                df = df.join(broadcast_if_bounded(table), keyed, "left")
        piece, count = ("_left", "_nl") if own == 0 else ("_right", "_nr")
        other, others = ("_right", "_nr") if own == 0 else ("_left", "_nl")
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keyed])
        n = F.coalesce(F.col(count), F.lit(1)) if hot[own] is not None else F.lit(1)
        if own == 0:
            n = F.when(null_key, F.lit(NULL_KEY_SALTS)).otherwise(n)
        df = df.withColumn(piece, F.pmod(F.col("_draw"), n).cast("int"))
        if hot[1 - own] is not None:
            df = df.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(others), F.lit(1)) - 1)))
        else:
            df = df.withColumn(other, F.lit(0))
        sides.append(df.drop("_nl", "_nr", "_draw"))
    return sides[0], sides[1]


def matched_pairs(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct key tuples of ``left`` that have a partner in ``right``.

    Same rows as ``select distinct keys from left join right`` but computed as a
    semi-join of the distinct keys, so a hot key never multiplies.
    """
    on = _names(on)
    return left.select(*on).distinct().join(right.select(*on).distinct(), on, "left_semi")


def join_topn(left: DataFrame, right: DataFrame, group: str, key: str, n: int | None = 2,
              cnt: str = "cnt", name: str = "rn") -> DataFrame:
    """Per ``group``, the top ``n`` distinct counts of matched left rows per (group, key).

    ``cnt`` counts the left rows that have at least one partner in ``right``
    (right duplicates do not multiply it). The join key is the grouping key, so left
    rows are counted first (combined map-side, one row per key is shuffled) and
    the counts are kept whose key the right side has: a hot key is one row in the join.
    """
    on = [group, key]
    counts = count_per_key(left.select(*on), on, name=cnt)
    # inner with distinct keys: a semi-join would be pushed below the count, to the raw rows
    matched = counts.join(right.select(*on).distinct(), on)
    return topn_distinct_counts(matched, group, key, cnt=cnt, n=n, name=name)


def broadcast_left_join(big: DataFrame, small: DataFrame, on: str | Sequence[str],
                        max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                        rows_per_salt: int = DEFAULT_ROWS_PER_SALT, by: Sequence[str] | None = None,
                        right_by: Sequence[str] | None = None) -> DataFrame:
    """``big LEFT JOIN small`` with ``small`` broadcast when it fits both bounds, else by shuffle with the hot keys of either side cut
    into pieces of ``rows_per_salt`` rows (:func:`salted_join`)."""
    if fits_broadcast(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), _names(on), "left")
    return salted_join(big, small, on, "left", hot_keys="auto", right_hot_keys="auto", rows_per_salt=rows_per_salt, by=by, right_by=right_by)


def latest_per_key(df: DataFrame, on: str | Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the one with the largest ``order_by`` (ties by the row's values)."""
    on = _names(on)
    rest = [c for c in df.columns if c not in on]
    if not rest:
        return df.select(*on).distinct()
    picked = df.groupBy(*on).agg(
        F.max_by(F.struct(*rest), F.struct(F.col(order_by), *[F.col(c) for c in rest])).alias("_v"))
    return picked.select(*on, *[F.col("_v")[c].alias(c) for c in rest])


def broadcast_lookup_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], order_by: str,
                          max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Inner lookup join: ``small`` reduced to one row per key (largest ``order_by``
    wins), then broadcast when it fits both bounds; rows of ``big`` without a key
    in ``small`` are dropped. The reduced table is written once to the scratch folder, so the
    size check and the join do not compute it twice."""
    lookup = latest_per_key(small, on, order_by)
    path = scratch_path(small.sparkSession, "lookup")
    lookup.write.mode("overwrite").parquet(path)
    lookup = small.sparkSession.read.schema(lookup.schema).parquet(path)
    return big.join(broadcast_if_bounded(lookup, max_rows, max_bytes), _names(on), "inner")
