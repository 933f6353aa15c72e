"""Token-id files: documents as ids, in order of doc_id, in blocks of a context-mixing range coder.

Documents are dealt into ranges of doc_id, one partition each. A range's ids (each document's, then its
end id) are one stream that is cut into blocks of ``BLOCK_IDS``; a block is coded on its own and
carries checksums, see ``rangecoder``. Files hold one block per row: its range, its number there, its
``documents`` (number in the range, doc_id, first id, ids of it here, all its ids) and the coded
``payload``. Spark writes them, so a lost executor's tasks are simply run again, and
the folder may be on any file system that it reads. A block is at most a few tens of KB,
however long a document; readers need no neighbouring block.

Results: a null or empty text is its end id alone. Rows of one doc_id stay separate documents, by
text; a null doc_id sorts first. An empty table gives files without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.llm.common import arrow_map, slices, staged
from skewkit.llm.ordering import default_parts, prefix_sums_by_range
from skewkit.llm.rangecoder import LANES, LONGEST, decode_blocks, encode_blocks
from skewkit.llm.tokens import KIND, encoder

BLOCK_IDS = LONGEST
#: Texts that are encoded at a time.
TEXT_BYTES = 8 << 20
_PIECE = "struct<at:long,doc_id:long,first:long,here:long,all:long>"
FILE_SCHEMA = f"range int, block long, n_ids long, documents array<{_PIECE}>, payload binary"
_pieces = pa.list_(pa.struct([(n, pa.int64()) for n in ("at", "doc_id", "first", "here", "all")]))


class _Blocks:
    """Collects a range's documents into blocks; hands out batches to code."""

    def __init__(self, part: int):
        self.ready: list[tuple] = []
        self.range, self.block, self.at = part, 0, 0
        self.ids, self.documents, self.room = [], [], BLOCK_IDS

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        first = 0
        while first < len(ids):
            here = min(self.room, len(ids) - first)
            self.ids.append(ids[first:first + here])
            self.documents.append({"at": self.at, "doc_id": doc_id, "first": first, "here": here, "all": len(ids)})
            first += here
            self.room -= here
            if not self.room:
                self._close()
        self.at += 1

    def _close(self) -> None:
        self.ready.append((self.range, self.block, self.documents, np.concatenate(self.ids)))
        self.block += 1
        self.ids, self.documents, self.room = [], [], BLOCK_IDS

    def end(self) -> None:
        if self.ids:
            self._close()

    def coded(self) -> pa.RecordBatch:
        part, block, documents, ids = zip(*self.ready, strict=True)
        self.ready = []
        return pa.record_batch({
            "range": pa.array(part, pa.int32()), "block": pa.array(block, pa.int64()),
            "n_ids": pa.array([len(i) for i in ids], pa.int64()), "documents": pa.array(documents, _pieces),
            "payload": pa.array(encode_blocks(list(ids)), pa.binary())})


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, special_tokens: bool = False) -> None:
    """Write the ids of every document of ``docs`` to ``path``; ``special_tokens``: see ``tokens``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # partition i holds the i-th range of doc_id
    key = F.col("doc_id").asc_nulls_first()
    dealt = rows.repartitionByRange(default_parts(docs.sparkSession), key).sortWithinPartitions(key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(TaskContext.get().partitionId())
        tokens = encoder(vocabulary, special_tokens)
        for part in _gathered((p for batch in batches for p in slices(batch, limit=TEXT_BYTES // 4)), TEXT_BYTES):
            ids = tokens.encode(part.column("text"))
            for doc_id, own in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                blocks.add(doc_id, np.append(own, np.uint32(end_id)))
            if len(blocks.ready) >= LANES:
                yield blocks.coded()
        blocks.end()
        if blocks.ready:
            yield blocks.coded()

    arrow_map(dealt, run, FILE_SCHEMA, KIND).write.mode("overwrite").parquet(path)


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode the blocks: a row per document and block, ``range, at, doc_id, first, here, all, crc`` (and ``ids``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered((b.slice(i, LANES) for b in batches for i in range(0, b.num_rows, LANES))):
            documents = batch.column("documents")
            pieces = documents.flatten()
            here = pieces.field("here").to_numpy()
            block = np.concatenate([np.zeros(0, np.uint32), *decode_blocks(batch.column("payload").to_pylist())])
            ends = np.cumsum(here).tolist()
            ids = [block[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            arrays = {"range": batch.column("range").take(pc.list_parent_indices(documents)),
                      **{n: pieces.field(n) for n in ("at", "doc_id", "first", "here", "all")},
                      "crc": pa.array([zlib.crc32(own.astype("<u4", copy=False)) for own in ids], pa.int64())}
            if with_ids:
                arrays["ids"] = pa.array([own.astype(np.int32) for own in ids], pa.list_(pa.int32()))
            yield pa.record_batch(arrays)

    schema = "range int, at long, doc_id long, first long, here long, all long, crc long"
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path).select("range", "documents", "payload")
    return arrow_map(blocks, run, schema + (", ids array<int>" if with_ids else ""))


def _gathered(parts: Iterator[pa.RecordBatch], text_bytes: int | None = None) -> Iterator[pa.RecordBatch]:
    """Larger batches, of ``LANES`` blocks or of texts of ``text_bytes``: many are coded, or encoded, fastest together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        held.append(part)
        size += part.num_rows if text_bytes is None else part.nbytes
        if size >= (text_bytes or LANES):
            yield _together(held)
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield _together(held)


def _together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _zero_operators(n: int) -> np.ndarray:
    """``[k, i]``: what bit ``i`` of a CRC-32 register becomes after ``2 ** k`` zero bytes."""
    def squared(rows: np.ndarray) -> np.ndarray:
        return _applied(rows, rows)
    one_bit = np.array([0xEDB88320, *(1 << i for i in range(31))], np.uint32)
    out = [squared(squared(squared(one_bit)))]
    while len(out) < n:
        out.append(squared(out[-1]))
    return np.stack(out)


def _applied(rows: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    out = np.zeros_like(crcs)
    for i in range(32):
        out ^= np.where((crcs >> np.uint32(i)) & np.uint32(1), rows[i], np.uint32(0))
    return out


_zeros = _zero_operators(48)


def combined_crcs(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of pairs of byte strings after each other, from their CRCs and the second ones' lengths."""
    out = first.astype(np.uint32)
    for k in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero((lengths >> k) & 1)
        out[at] = _applied(_zeros[k], out[at])
    return out ^ second.astype(np.uint32)


def joined_crcs(crcs: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each list of byte strings (``sizes`` of them in a row): neighbours are joined in pairs until one is left."""
    crcs, lengths, sizes = crcs.astype(np.uint32), lengths.astype(np.int64), sizes.astype(np.int64)
    while len(crcs) > len(sizes):
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        rank = np.arange(len(crcs)) - np.repeat(starts, sizes)
        left = np.flatnonzero((rank % 2 == 0) & (rank + 1 < np.repeat(sizes, sizes)))
        crcs[left] = combined_crcs(crcs[left], crcs[left + 1], lengths[left + 1])
        lengths[left] += lengths[left + 1]
        keep = rank % 2 == 0
        crcs, lengths, sizes = crcs[keep], lengths[keep], (sizes + 1) // 2
    return crcs


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the files, ``start`` counting all ids before it."""
    pieces = staged(spark, read_pieces(spark, path), "pieces")
    whole = pieces.filter("here = all").select("range", "at", "doc_id", F.col("all").alias("n_tokens"), "crc")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            flat = parts.flatten()
            crcs = joined_crcs(flat.field("crc").to_numpy(), 4 * flat.field("here").to_numpy(),
                               np.diff(parts.offsets.to_numpy()))
            yield pa.record_batch([*(batch.column(c) for c in ("range", "at", "doc_id", "n_tokens")), pa.array(crcs.astype(np.int64))],
                                  ["range", "at", "doc_id", "n_tokens", "crc"])

    # a document over several blocks: one small struct for each of them
    cut = arrow_map(pieces.filter("here < all").groupBy("range", "at").agg(
        F.first("doc_id").alias("doc_id"), F.first("all").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first", "here", "crc"))).alias("parts"))
        .select("range", "at", "doc_id", "n_tokens", "parts"), joined, "range int, at long, doc_id long, n_tokens long, crc long")
    documents = staged(spark, whole.unionByName(cut).withColumnRenamed("range", "_range"), "digests")
    return prefix_sums_by_range(documents, ["at"], "n_tokens", "start").select(
        "doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))
