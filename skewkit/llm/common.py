"""Arrow, numpy and staging helpers shared by the corpus operators.

Texts are handled as the UTF-8 buffer of an Arrow column: one byte array and
the offsets of its rows. Work on a batch is cut into slices of bounded bytes,
so that temporary arrays stay small however long the texts of a batch are.
A null text counts as an empty one wherever a docstring does not say otherwise.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.session import scratch_path

SLICE_BYTES = 1 << 20   # texts of one numpy slice; a longer single text is a slice of its own
BATCH_ROWS = 1_000      # rows of an Arrow batch, where the session keeps Spark's default
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BASE = 0x9E3779B97F4A7C15   # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: lineage ends here."""
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_bucket(column: str, modulus: int):
    """``crc32`` of the id as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(column).cast("string")) % modulus


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the ``n + 1`` offsets of the rows in them; null rows are empty."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = arr.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` whose texts have at most ``limit`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


_in_worker: dict = {}


def kept_in_worker(kind: str, key, make: Callable):
    """``make()`` once for ``key`` in each Python worker. A worker keeps one such value, the last: an operator's
    tables and caches go when the worker turns to another one."""
    if _in_worker.get("key") != (kind, key):
        _in_worker.clear()
        _in_worker.update(key=(kind, key), value=make())
    return _in_worker["value"]


def _drop_others(kind: str | None) -> None:
    if _in_worker and _in_worker["key"][0] != kind:
        _in_worker.clear()


def _release() -> None:
    """Give freed memory back to the system: the worker lives on, and the next operator shares its executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
              keeps: str | None = None) -> DataFrame:
    """``mapInArrow`` with batches of bounded rows, in a worker that holds no other operator's tables than ``keeps``."""
    conf = df.sparkSession.conf
    if conf.get(_ROWS_CONF) == "10000":        # Spark's default: ten times the longest texts is too much for a worker
        conf.set(_ROWS_CONF, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _drop_others(keeps)
        yield from fn(batches)
        _release()
    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
               column: str = "text", limit: int = SLICE_BYTES, keeps: str | None = None) -> DataFrame:
    """``fn`` on each slice of each Arrow batch; it returns a batch of ``schema``, or None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
    return arrow_map(df, run, schema, keeps)


def annotate(df: DataFrame, fn: Callable[[pa.Array], list[pa.Array]], fields: str, keeps: str | None = None,
             limit: int = SLICE_BYTES) -> DataFrame:
    """All columns of ``df`` by position (``_c0``, ``_c1`` ...) and the columns ``fields`` that ``fn``
    makes from each slice of its ``text``. Names of ``df`` may clash with anything; see ``restored``."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    text = names[df.columns.index("text")]
    types = [f.dataType.simpleString() for f in df.schema.fields]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        made = fn(part.column(text))
        return pa.record_batch([*part.columns, *made], [*names, *[f"_m{i}" for i in range(len(made))]])

    made = [x.strip().split(" ") for x in fields.split(",")]
    schema = ", ".join([f"{n} {t}" for n, t in zip(names, types, strict=True)] +
                       [f"_m{i} {t}" for i, (_, t) in enumerate(made)])
    out = map_slices(df.toDF(*names), run, schema, column=text, limit=limit, keeps=keeps)
    return out.withColumnsRenamed({f"_m{i}": name for i, (name, _) in enumerate(made)})


def restored(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``annotate`` has carried along, under their own names again."""
    return df.select(*[f"_c{i}" for i in range(len(columns))]).toDF(*columns)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. n-1`` modulo 2**64, kept between calls."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        grown = np.full(max(n, SLICE_BYTES), base, np.uint64)
        grown[0] = 1
        with np.errstate(over="ignore"):
            table = _tables[base] = np.cumprod(grown, dtype=np.uint64)
    return table[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the content of each byte span ``[start, end)``, with no loop over spans.

    A polynomial in the bytes modulo 2**64, read from prefix sums and moved to the span's
    start by the base's inverse, then finalised with the length.
    """
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n + 1)[:n], dtype=np.uint64, out=sums[1:])
        value = (sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts]
        return mix64(value + mix64((ends - starts).astype(np.uint64)))


#: Bytes that end a word: ASCII white space.
WORD_GAPS = (9, 10, 11, 12, 13, 32)
_is_gap = np.zeros(256, bool)
_is_gap[list(WORD_GAPS)] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space): their starts, ends, and the first word of each row
    (``n + 1`` values). A row's end also ends its last word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_is_gap[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    opens[rows] |= inside[rows]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] |= inside[last]
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (ASCII letters in lower case) and the first word of each row."""
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(_lower[data], starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside a row, and the first shingle of each row.

    A row of 1 to ``k - 1`` words has one shingle of all its words; an empty row has none.
    """
    counts = np.diff(first)
    per_row = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(per_row)])
    total = int(begin[-1])
    if not total:
        return np.zeros(0, np.uint64), begin
    row = np.repeat(np.arange(len(counts)), per_row)
    at = np.arange(total) - begin[row] + first[row]
    size = np.minimum(counts[row], k)
    h = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            word = words[np.minimum(at + j, len(words) - 1)]
            h = np.where(j < size, mix64(h * np.uint64(0xD6E8FEB86659FD93) + word), h)
    return h, begin
