"""Sequence packing by power-of-two decomposition.

A document's ids (with its end id) are cut into pieces of binary lengths: as many
of the full context as fit, then one for each set bit of the rest, longest
first. Each piece is a sequence of its own in the bucket of its length, so a
sequence never holds ids of two documents and needs no padding at all. Batches
are drawn from one bucket at a time, with equal lengths.

A document's cut depends on its own length only: a hot source, copies and very
long documents are so many more rows, spread like any. Sequence ids number the
pieces by doc_id and start; they come from prefix sums over ranges of doc_id.

Results: a null or empty text is its end id alone, one piece of length 1. Rows of the
same doc_id (and a null doc_id, which sorts first) stay separate documents, in the
order of their piece counts and checksums. An empty table gives no row. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import map_slices, staged
from skewkit.llm.ordering import default_parts, prefix_sums, range_splits
from skewkit.llm.tokens import KIND, encoder

CONTEXT = 2048


def binary_lengths(n: int, context: int = CONTEXT) -> list[int]:
    """Lengths of the pieces of ``n`` ids: full contexts, then the powers of two in the rest, descending."""
    full, rest = divmod(n, context)
    return [context] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def decompose(docs: DataFrame, vocabulary: str, end_id: int, context: int = CONTEXT,
              with_ids: bool = False, special_tokens: bool = False) -> DataFrame:
    """A row per document: ``doc_id, doc_tokens, lengths, starts, crcs, crc`` and, if asked for, ``ids`` of each piece."""
    if context < 1 or context & (context - 1):
        raise ValueError("the context length must be a power of two")
    schema = "doc_id long, doc_tokens long, lengths array<long>, starts array<long>, crcs array<long>, crc long"
    if with_ids:
        schema += ", ids array<array<int>>"

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        found = encoder(vocabulary, special_tokens).encode(part.column("text"))
        lengths, starts, crcs, whole, pieces = [], [], [], [], []
        for ids in found:
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            sizes = binary_lengths(len(ids), context)
            ends = np.cumsum(sizes)
            cuts = [ids[e - n:e] for e, n in zip(ends, sizes, strict=True)]
            lengths.append(sizes)
            starts.append((ends - sizes).tolist())
            crcs.append([zlib.crc32(c.tobytes()) for c in cuts])
            whole.append(zlib.crc32(ids.tobytes()))
            pieces.append([c.astype(np.int32) for c in cuts])
        cols = {"doc_id": part.column("doc_id").cast(pa.int64()),
                "doc_tokens": pa.array([sum(x) for x in lengths], pa.int64()),
                "lengths": pa.array(lengths, pa.list_(pa.int64())),
                "starts": pa.array(starts, pa.list_(pa.int64())), "crcs": pa.array(crcs, pa.list_(pa.int64())),
                "crc": pa.array(whole, pa.int64())}
        if with_ids:
            cols["ids"] = pa.array(pieces, pa.list_(pa.list_(pa.int32())))
        return pa.record_batch(cols)

    return map_slices(docs.select("doc_id", "text"), cut, schema, keeps=KIND)


def pack(docs: DataFrame, vocabulary: str, end_id: int, context: int = CONTEXT, with_ids: bool = False,
         special_tokens: bool = False) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket`` (and ``ids``).

    ``bucket`` is the exponent of the length. ``sequence_id`` numbers all pieces from 0.
    ``special_tokens``: see ``tokens``.
    """
    spark = docs.sparkSession
    cut = staged(spark, decompose(docs, vocabulary, end_id, context, with_ids, special_tokens).withColumn(
        "n_pieces", F.size("lengths").cast("long")), "packing")
    splits = range_splits(cut, "doc_id", default_parts(spark))
    numbered = prefix_sums(cut, ["doc_id", "doc_tokens", "crc"], "n_pieces", "first_sequence", splits)
    piece = F.arrays_zip("starts", "lengths", "crcs", *(["ids"] if with_ids else []))
    rows = numbered.select("doc_id", "doc_tokens", "first_sequence", F.posexplode(piece).alias("at", "p"))
    return rows.select(
        "doc_id", F.col("p.starts").alias("start"), F.col("p.lengths").alias("length"),
        F.col("p.crcs").alias("ids_crc32"), "doc_tokens", (F.col("first_sequence") + F.col("at")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.log2(F.col("p.lengths")).cast("int").alias("bucket"),
        *([F.col("p.ids").alias("ids")] if with_ids else []))
