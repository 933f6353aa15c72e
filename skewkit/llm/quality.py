"""Quality classifier: naive Bayes support vectors (NBSVM).

A text's n-grams are set indicators: byte 1- to 3-grams (digits folded) and, so that
repetition is visible, the equality patterns of 2 to 4 neighbouring words (``AAAA``,
``ABAB`` ...), all hashed to ``DIMENSIONS``. Each indicator is scaled by the log ratio
of its smoothed frequency in the two classes. A linear model of hinge loss is
fitted to the scaled, length-normalised rows by dual coordinate descent, and
its margins are mapped to probabilities by a logistic fit (Platt's).

Training: all labelled rows whose ``crc32(doc_id as text) mod 5`` is not 0. Frequencies count every one of them.
For the fit they are dealt by a hash into blocks of about ``BLOCK_DOCS`` rows (one, if there are no more); each block is
fitted by itself and the weights are the mean of the blocks', every row counting alike. The logistic fit reads the margins of all
rows under that mean, from counts and means of cells of ``1 / MARGIN_CELLS``. So a task holds one block, and the
driver vectors of ``DIMENSIONS`` only. Neither labels, lang, source nor doc_id enter a score.
A whole text is read, however long; its set of n-grams is bounded by ``DIMENSIONS``.

Results: a null text scores as an empty one (the model's constant). With no
labelled rows, or labels of one class only, every score is that class's share
(0.5 without labels). Several labels of one id count as so many rows; null
labels are left out. Extra columns never clash: only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import annotate, arrow_map, fold_bucket, map_slices, restored, staged, utf8, word_hashes

DIMENSIONS = 1 << 18
#: Rows that one task fits together, about.
BLOCK_DOCS = 6000
MARGIN_CELLS = 1 << 14
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
ACCEPT = 0.3

#: Numbers of a vector that are added in one place.
_CHUNK = 1 << 12

_digits = np.arange(256, dtype=np.uint8)
_digits[48:58] = 48


def _hash(values: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (values.astype(np.uint32) + np.uint32(kind * 0x01000193)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
    return (h >> np.uint32(14)).astype(np.int32)


def row_features(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each row its indicator indices, each once, in no particular order."""
    n = len(data)
    b = _digits[data].astype(np.uint32)
    one = _hash(b, 1)
    two = _hash(b[:-1] * np.uint32(256) + b[1:], 2) if n > 1 else np.zeros(0, np.int32)
    three = (_hash((b[:-2] * np.uint32(256) + b[1:-1]) * np.uint32(256) + b[2:], 3)
             if n > 2 else np.zeros(0, np.int32))
    words, first = word_hashes(data, offsets)
    same = [words[j:] == words[:-j] if len(words) > j else np.zeros(0, bool) for j in (1, 2, 3)]
    last = np.zeros(DIMENSIONS, np.int32)
    for i in range(len(offsets) - 1):
        a, e = int(offsets[i]), int(offsets[i + 1])
        w, v = int(first[i]), int(first[i + 1])
        got = [one[a:e], two[a:max(e - 1, a)], three[a:max(e - 2, a)]]
        for size in (2, 3, 4):
            count = v - w - size + 1
            if count > 0:
                got.append(_hash(_pattern(same, w, count, size), 10 + size))
        idx = np.concatenate(got)
        # the last position that writes to a slot stands for its n-gram
        at = np.arange(len(idx), dtype=np.int32)
        last[idx] = at
        yield idx[last[idx] == at]


def _pattern(same: list[np.ndarray], w: int, count: int, size: int) -> np.ndarray:
    code = np.zeros(count, np.uint32)
    bit = 0
    for gap in range(1, size):
        for start in range(size - gap):
            code |= same[gap - 1][w + start:w + start + count].astype(np.uint32) << np.uint32(bit)
            bit += 1
    return code


class Model:
    """``weights`` of scaled indicators (ratio squared away: weight times ratio), and the logistic fit."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, slope: float, shift: float):
        self.ratio, self.weights, self.slope, self.shift = ratio, weights, slope, shift
        self.scaled, self.norms = ratio * weights[:-1], ratio * ratio

    def margin(self, idx: np.ndarray) -> float:
        norm = float(np.sqrt(self.norms[idx].sum()))
        return float(self.scaled[idx].sum()) / norm + self.weights[-1] if norm > 0 else float(self.weights[-1])

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """NBSVM on indicator rows and labels 0 and 1, in the given order."""
    positive = labels == 1
    if not len(labels) or positive.all() or not positive.any():
        return _constant(int(positive.sum()), len(labels))
    ratio = log_ratios(*_class_counts(rows, positive), int(positive.sum()), int((~positive).sum()))
    w = _descend(rows, positive, ratio, float(positive.mean()))
    margins = np.array([w[idx] @ x + w[-1] for idx, x in zip(rows, _scaled(rows, ratio), strict=True)])
    ones = np.ones(len(rows))
    return Model(ratio, w, *_logistic(margins, np.where(positive, ones, 0.0), np.where(positive, 0.0, ones)))


def _constant(n1: int, n: int) -> Model:
    """Every text scores as the share of label 1 (0.5 without labels)."""
    p = min(max(n1 / n if n else 0.5, 1e-3), 1 - 1e-3)
    return Model(np.zeros(DIMENSIONS), np.zeros(DIMENSIONS + 1), 0.0, float(np.log(p / (1 - p))))


def _class_counts(rows: list[np.ndarray], positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many rows of label 1 and of label 0 have each indicator."""
    none = np.zeros(0, np.int32)
    return tuple(np.bincount(np.concatenate([none, *(idx for idx, y in zip(rows, positive, strict=True) if y == label)]),
                             minlength=DIMENSIONS).astype(np.float64) for label in (True, False))


def log_ratios(up: np.ndarray, down: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Log ratio of each indicator's smoothed frequencies among the ``n1`` and the ``n0`` rows of the classes."""
    ratio = np.log((up + SMOOTHING) / (n1 + 2 * SMOOTHING)) - np.log((down + SMOOTHING) / (n0 + 2 * SMOOTHING))
    ratio[(up == 0) & (down == 0)] = 0.0
    return ratio


def _scaled(rows: list[np.ndarray], ratio: np.ndarray) -> Iterator[np.ndarray]:
    for idx in rows:
        x = ratio[idx]
        norm = np.sqrt((x * x).sum())
        yield x / norm if norm > 0 else x


def _descend(rows: list[np.ndarray], positive: np.ndarray, ratio: np.ndarray, share: float) -> np.ndarray:
    """Weights (the constant last) of least hinge loss on scaled rows; ``share``: of label 1 in all training rows."""
    sign = np.where(positive, 1.0, -1.0)
    # both classes weigh the same in the loss
    bound = np.where(positive, COST * 0.5 / share, COST * 0.5 / (1 - share))
    w, alpha = np.zeros(DIMENSIONS + 1), np.zeros(len(rows))
    # scaled rows are made again for each step: they are twice the size of the indices
    norms = np.array([np.sqrt((ratio[idx] * ratio[idx]).sum()) or 1.0 for idx in rows])
    square = np.array([float((x * x).sum()) + 1.0 for x in _scaled(rows, ratio)])
    draw = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in draw.permutation(len(rows)):
            x = ratio[rows[i]] / norms[i]
            gradient = sign[i] * (w[rows[i]] @ x + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), bound[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * x
                w[-1] += step
    return w


def _logistic(margins: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt's fit, by Newton steps on its smoothed targets; ``ones`` and ``zeros``: rows of each label at a margin."""
    n1, n0, n = ones.sum(), zeros.sum(), ones + zeros
    target = (ones * ((n1 + 1) / (n1 + 2)) + zeros * (1 / (n0 + 2))) / n
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        g = np.array([(n * (p - target) * margins).sum() + 1e-3 * (a - 1), (n * (p - target)).sum()])
        s = n * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * margins * margins).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum()]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        size = np.abs(step).max()
        a, b = a - step[0] * min(1, 5 / max(size, 1e-12)), b - step[1] * min(1, 5 / max(size, 1e-12))
        if size < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def _packed(idx: np.ndarray) -> bytes:
    """A set of indices as planes of the bytes of its sorted gaps: the high ones are nearly all 0 and take no room on disk."""
    return np.diff(np.sort(idx), prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel(), dtype=np.int32)


def _training_rows(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    return [_unpacked(x) for x in batch.column("idx").to_pylist()], batch.column("y").to_numpy() == 1


def _added(df: DataFrame, vector_of: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum of the vectors that the tasks of ``df`` make, added in the order of the tasks, a chunk of it in one place."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, task = vector_of(batches), TaskContext.get().partitionId()
        for chunk, start in enumerate(range(0, size, _CHUNK)):
            values = vector[start:start + _CHUNK]
            if values.any():
                yield pa.record_batch({"chunk": pa.array([chunk], pa.int32()), "task": pa.array([task], pa.int32()),
                                       "vals": pa.array([values.tobytes()], pa.binary())})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, vals in zip(batch.column("chunk").to_pylist(), batch.column("vals").to_pylist(), strict=True):
                sums[chunk] = sums.get(chunk, 0.0) + np.frombuffer(vals)
        yield pa.record_batch({"chunk": pa.array(list(sums), pa.int32()), "vals": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    rows = arrow_map(df, parts, "chunk int, task int, vals binary").repartition("chunk").sortWithinPartitions("chunk", "task")
    out = np.zeros(size)
    for r in arrow_map(rows, total, "chunk int, vals binary").collect():
        vals = np.frombuffer(r["vals"])
        out[r["chunk"] * _CHUNK:r["chunk"] * _CHUNK + len(vals)] = vals
    return out


def train(docs: DataFrame, labels: DataFrame, block_docs: int = BLOCK_DOCS) -> Model:
    """Fit the model to all labelled rows, in blocks of about ``block_docs``."""
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("quality").cast("int").alias("_y")).filter(
        F.col("_y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold_bucket("doc_id", 5) != 0))
    # by hash: the labels are the side that is held, the texts run past them unsorted
    labelled = docs.select("doc_id", "text").filter(fold_bucket("doc_id", 5) != 0).join(known.hint("shuffle_hash"), "doc_id")

    def features(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = [_packed(x) for x in row_features(*utf8(part.column("text")))]
        return pa.record_batch({"doc_id": part.column("doc_id"), "y": part.column("_y"), "idx": pa.array(sets, pa.binary())})

    # written once: frequencies, fit and margins read it
    rows = staged(spark, map_slices(labelled, features, "doc_id long, y int, idx binary"), "quality-rows")

    def counts(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(2 * DIMENSIONS + 2)
        for batch in batches:
            sets, positive = _training_rows(batch)
            out += np.concatenate([*_class_counts(sets, positive), [positive.sum(), (~positive).sum()]])
        return out

    found = _added(rows.select("y", "idx"), counts, 2 * DIMENSIONS + 2)
    n1, n0 = int(found[-2]), int(found[-1])
    if not n1 or not n0:
        return _constant(n1, n1 + n0)
    share = n1 / (n1 + n0)
    ratio = log_ratios(found[:DIMENSIONS], found[DIMENSIONS:-2], n1, n0)
    shared = spark.sparkContext.broadcast(ratio)

    def weights(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(DIMENSIONS + 1)
        sets, labels, last = [], [], None

        def block() -> None:
            nonlocal out
            if sets:
                out += len(sets) / (n1 + n0) * _descend(sets, np.array(labels), shared.value, share)
        for batch in batches:
            own, positive = _training_rows(batch)
            for number, idx, y in zip(batch.column("block").to_pylist(), own, positive.tolist(), strict=True):
                if number != last or len(sets) == 2 * block_docs:      # copies of one row all lie in one block
                    block()
                    sets, labels, last = [], [], number
                sets.append(idx)
                labels.append(y)
        block()
        return out

    blocks = -(-(n1 + n0) // block_docs)
    # rows of one doc_id may lie in several blocks, by their text and label
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "y", "idx"), F.lit(blocks))).repartition("block")
    w = _added(dealt.sortWithinPartitions("block", "doc_id", "y", "idx"), weights, DIMENSIONS + 1)
    shared.destroy()
    model = Model(ratio, w, 1.0, 0.0)
    fitted = spark.sparkContext.broadcast(model)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, _ = _training_rows(batch)
            yield pa.record_batch({"y": batch.column("y"), "margin": pa.array([fitted.value.margin(idx) for idx in sets], pa.float64())})

    cells = (arrow_map(rows.select("y", "idx"), margins, "y int, margin double")
             .groupBy(F.floor(F.col("margin") * MARGIN_CELLS).alias("cell"), "y")
             .agg(F.avg("margin").alias("margin"), F.count("*").cast("double").alias("n")).collect())
    fitted.destroy()
    cells.sort(key=lambda r: (r["cell"], r["y"]))
    at, y, n = (np.array([r[c] for r in cells]) for c in ("margin", "y", "n"))
    return Model(ratio, w, *_logistic(at, np.where(y == 1, n, 0.0), np.where(y == 1, 0.0, n)))


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(text: pa.Array) -> list[pa.Array]:
        m = shared.value
        margins = np.array([m.margin(idx) for idx in row_features(*utf8(text))])
        return [pa.array(m.score(margins), pa.float64())]

    return annotate(docs, score, "score double")


def score_quality(docs: DataFrame, labels: DataFrame, block_docs: int = BLOCK_DOCS, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``."""
    scored = _scored(docs.select("doc_id", "text"), train(docs, labels, block_docs)).withColumnRenamed("_c0", "doc_id")
    return scored.select("doc_id", (F.coalesce(fold_bucket("doc_id", 5), F.lit(1)) == 0).alias("held_out"),
                         "score", (F.col("score") >= accept).cast("int").alias("predicted"))


def accepted_documents(docs: DataFrame, labels: DataFrame, block_docs: int = BLOCK_DOCS,
                       accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least ``accept``."""
    scored = _scored(docs, train(docs, labels, block_docs))
    return restored(scored.filter(F.col("score") >= accept), docs.columns)
