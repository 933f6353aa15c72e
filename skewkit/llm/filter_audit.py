"""Audit of how text filters interact, over every order in which they could be applied.

Each document fails or passes five filters on its whole text. Spark reduces the table to contingency
counts: per part (``source``) the documents, good documents and toxic documents in each of the 32
combinations of fails. Those counts are a 2x2x2x2x2 tensor, one axis for each filter, and every figure of
every step is a contraction of it: along each axis a selector takes the passes, the fails, or
all. ``np.einsum`` contracts a part's tensors with the selectors of all 600 (order, step) pairs at once.

Filters (fail condition): A fewer than 200 words; B distinct words under half of the words; C more than
2 % of the code points in ``[A-Z]``; D any of ``#$%&*|``; E the text is that of a smaller doc_id, anywhere in
the table. Words are maximal runs without ASCII white space, case-sensitive.

Defined results: a null text is an empty one (fails A, and E after the first such id). A null doc_id is
smaller than none and has none smaller: it never fails E and has no labels. Rows that repeat an id are documents of their
own; with equal text they all stay. Several label rows of an id: it is good (toxic) if any says so; null labels say nothing. A
null source is the part ``''``. An empty table has no parts, so no rows. Extra columns are not read.

Skew: documents are rows of an id, a text hash and flags before any shuffle; equal ones are combined on the map side. The first
id of a text is found by a map-side-combined minimum, and rows meet it by (text hash, id), so a text that a third of
all documents share is no hot join key.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import staged

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ("docs", "good", "toxic")
AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")

_ALL, _PASS, _FAIL = (1, 1), (1, 0), (0, 1)


def fail_flags(text: Column) -> dict[str, Column]:
    """The fail conditions that a text decides by itself."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {"A": n < 200, "B": 100 * distinct < 50 * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def contingency(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell, docs, good, toxic``: counts of each part's documents by fails; bit i of ``cell`` is filter i's fail."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.col("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    flags = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fail_flags(F.col("text")).values())]
    # written once, and small: the texts are read a single time
    rows = staged(docs.sparkSession, own.select(
        "doc_id", "part", F.sha2("text", 256).alias("digest"), sum(flags, F.lit(0)).alias("cell"))
        .groupBy("doc_id", "part", "digest", "cell").agg(F.count("*").alias("n")), "filter-fails")
    first = (rows.filter(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("is_first", F.lit(True)))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (rows.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .withColumn("cell", F.col("cell") + F.when(copy, 16).otherwise(0))
            .groupBy("part", "cell").agg(
                F.sum("n").alias("docs"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
                F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")))


def selectors(choose) -> list[np.ndarray]:
    """One (order and step) x 2 matrix for each axis; ``choose(place, step)`` selects along the axis of the filter that
    stands at ``place`` of an order."""
    table = np.array([[choose(order.index(f), step) for order in ORDERS for step in range(len(FILTERS))] for f in FILTERS])
    return list(table.astype(np.int64))


def contract(tensors: np.ndarray, chosen: list[np.ndarray]) -> np.ndarray:
    """Each (order, step)'s sum of each tensor over the cells that its selectors take."""
    return np.einsum("mabcde,ra,rb,rc,rd,re->rm", tensors, *chosen, optimize="greedy")


_own_filter = np.array([FILTERS.index(order[step]) for order in ORDERS for step in range(len(FILTERS))])
_removed = selectors(lambda place, step: _PASS if place < step else _FAIL if place == step else _ALL)
_kept = selectors(lambda place, step: _PASS if place <= step else _ALL)
_failing = selectors(lambda place, step: _FAIL if place == step else _ALL)
_alone = selectors(lambda place, step: _FAIL if place == step else _PASS)


def audit_tensors(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """Figures of all 600 (order, step) pairs; ``tensors``: documents, good and toxic ones, each 2x2x2x2x2."""
    removed = contract(tensors, _removed)
    by_filter = np.array([removed[_own_filter == f, 0].sum() for f in range(len(FILTERS))])
    return {"kept": contract(tensors[:1], _kept)[:, 0], "removed": removed[:, 0],
            "redundant": contract(tensors[:1], _failing)[:, 0] - removed[:, 0],
            "unique_fails": contract(tensors[:1], _alone)[:, 0],
            "good_lost": removed[:, 1], "toxic_lost": removed[:, 2], "shapley": by_filter[_own_filter]}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step (see ``AUDIT``); a part's 32 cells are its whole group."""
    steps = len(FILTERS)

    def of_part(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        tensors = np.zeros((len(MEASURES), 1 << steps), np.int64)
        tensors[:, cells["cell"].to_numpy()] = cells[list(MEASURES)].to_numpy(np.int64).T
        # bit 0 of a cell is filter A: the first axis after reversing
        tensors = tensors.reshape(len(MEASURES), *[2] * steps).transpose(0, *range(steps, 0, -1))
        return pd.DataFrame({"part": key[0], "filter_order": np.repeat(ORDERS, steps),
                             "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(ORDERS)), **audit_tensors(tensors)})

    return contingency(docs, labels).groupBy("part").applyInPandas(of_part, AUDIT)
