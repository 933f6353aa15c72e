"""Language identification by prediction by partial matching (PPM).

One variable-order byte context tree per language: contexts of 0 to ``MAX_ORDER``
preceding bytes, each with the counts of the bytes that followed. A byte's code
length is read from the longest context that the tree has; when the byte was
never seen there, an escape (method C: distinct symbols over total plus
distinct) is paid and the next shorter context is asked, down to a uniform
choice among 256. The statistics are frozen after training, so a text's exact
code length is a sum over its positions and each language needs one table.

Bytes are folded (ASCII letters to lower case, digits to ``0``) and ranked; the
``ALPHABET - 1`` most frequent ones have a code of their own and all others share
code 0, which costs 8 more bits for the byte itself. Contexts start afresh at
each text, with code 0 before its first byte.

Training reads all rows with a text, a letter and a language whose
``crc32(doc_id as text) mod 3`` is not 1, for the ``MAX_LANGUAGES`` most frequent labels (a caller may ask for
a hash sample instead, see ``train_docs``).
Counting is a Spark aggregation; the driver gets the frozen counts only, at
most ``ALPHABET ** (MAX_ORDER + 1)`` per language.

Results: null texts and texts without a letter are ``und`` with score 0, whatever
the model (a letter: Unicode category L). If nothing can be learned from (no labelled rows), every text is ``und``.
Equal code lengths go to the language that sorts first. Repeated rows are scored
one by one; extra columns of the input are kept only by ``accepted_documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import annotate, arrow_map, fold_bucket, kept_in_worker, restored, slices, staged, utf8

MAX_ORDER = 3
ALPHABET = 64          # symbols after a context are the bits of one number
#: Languages a model may have, the most frequent labels first.
MAX_LANGUAGES = 1_000
UNDETERMINED = "und"
#: A text's typical bits a byte: the median over windows of so many bytes, which quotes in another script don't move.
WINDOW = 16
#: A text is in none of the languages if its typical bits lie beyond those of held-out texts by SPREADS spreads and SLACK bits.
SPREADS = 4.0
SLACK = 0.5
#: Bits that one window alone (a name, an address) may cost besides; a text of n windows, the nth part.
LONE_WINDOW = 4.0
#: Held-out texts of a language for that, at least, and the cells of a bit in which their bits are counted.
LEAST_BOUND_DOCS = 5
BIT_CELLS = 4096
#: Distinct grams that a task counts before it hands them on.
_HELD_GRAMS = 1 << 18
#: Bytes of text whose grams are looked up together: every byte takes about 80 of temporary arrays.
_SLICE = 1 << 18

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
_fold[48:58] = 48


def has_letter(column: str = "text"):
    return F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))


def _frequent(rows: DataFrame) -> DataFrame:
    """``_lang, _n`` of the ``MAX_LANGUAGES`` most frequent labels."""
    counts = rows.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n"))
    return counts.orderBy(F.desc("_n"), "_lang").limit(MAX_LANGUAGES)


def training_rows(docs: DataFrame, train_docs: int | None = None) -> DataFrame:
    """The labelled rows to learn from, or a hash sample of about ``train_docs`` of each language: ``text, lang``."""
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & (F.coalesce(fold_bucket("doc_id", 3), F.lit(0)) != 1))
    languages = _frequent(rows.filter(F.col("text").isNotNull()))
    out = rows.filter(has_letter()).join(F.broadcast(languages), F.col("lang") == F.col("_lang"))
    if train_docs is not None:
        draw = (F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / F.lit(float(1 << 30)))
        out = out.filter(draw < F.lit(float(train_docs)) / F.col("_n"))
    return out.select("text", "lang")


def _codes(data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return rank[_fold[data]].astype(np.int64)


def _grams(codes: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each position the key of its ``order`` preceding codes and its own."""
    key = codes.copy()
    shifted = codes
    heads = offsets[:-1][offsets[:-1] < len(codes)]
    for j in range(1, order + 1):
        shifted = np.concatenate([np.zeros(1, np.int64), shifted[:-1]])
        # positions closer than j to their text's start see code 0 there
        key += np.where(_near(heads, j, len(codes)), 0, shifted) * (ALPHABET ** j)
    return key


def _near(heads: np.ndarray, j: int, n: int) -> np.ndarray:
    near = np.zeros(n, bool)
    for d in range(j):
        at = heads + d
        near[at[at < n]] = True
    return near


class Model:
    """Frozen code lengths: ``bits(data, offsets)`` gives each text's bits in each language."""

    def __init__(self, languages: list[str], rank: np.ndarray, counts: list[dict]):
        """``counts[l][k]``: (keys, counts) of the ``k + 1``-grams of language ``l``."""
        self.languages, self.rank = languages, rank
        lower = np.full((1, len(languages)), 8.0)            # order -1
        seen_rows = np.unique(np.concatenate([c[MAX_ORDER][0] for c in counts]) if counts else np.zeros(0, np.int64))
        tables = []
        for order in range(MAX_ORDER):
            width = ALPHABET ** (order + 1)
            table = np.empty((width, len(languages)), np.float64)
            base = np.broadcast_to(lower if order == 0 else lower[np.arange(width) % (width // ALPHABET)],
                                   (width, len(languages)))
            for at, c in enumerate(counts):
                table[:, at] = self._code_lengths(c[order], base[:, at], np.arange(width))
            tables.append(table)
            lower = table
        self.short = lower.astype(np.float32)                # by the last MAX_ORDER codes
        # the longest grams that any language has seen have a row of their own
        full = np.empty((len(seen_rows), len(languages)), np.float64)
        base = lower[seen_rows % ALPHABET ** MAX_ORDER]
        for at, c in enumerate(counts):
            full[:, at] = self._code_lengths(c[MAX_ORDER], base[:, at], seen_rows)
        self.full = full.astype(np.float32)
        self.seen_rows = seen_rows                           # indexed in the workers only: see ``unpack``
        # a gram unseen by all still pays the escape where a language knows its context
        contexts = ALPHABET ** MAX_ORDER
        self.escape = np.zeros((contexts, len(languages)), np.float32)
        for at, c in enumerate(counts):
            total, distinct = self._context_sums(c[MAX_ORDER], contexts)
            known = total > 0
            self.escape[known, at] = np.log2((total[known] + distinct[known]) / distinct[known])

    #: Of each context the symbols that were seen after it, a bit each, and the row of the first of them in ``full``.
    after: np.ndarray | None = None
    base: np.ndarray | None = None

    def _index(self, seen_rows: np.ndarray) -> None:
        self.seen_rows = seen_rows
        context = _context_of(seen_rows)
        self.after = np.zeros(ALPHABET ** MAX_ORDER, np.uint64)
        np.bitwise_or.at(self.after, context, np.uint64(1) << (seen_rows % ALPHABET).astype(np.uint64))
        self.base = np.searchsorted(context, np.arange(len(self.after))).astype(np.int32)

    def _rows(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each gram's row in ``full``, and whether it has one."""
        context, symbol = _context_of(grams), np.uint64(1) << (grams % ALPHABET).astype(np.uint64)
        after = self.after[context]
        seen = (after & symbol) != 0
        return np.where(seen, self.base[context] + np.bitwise_count(after & (symbol - np.uint64(1))), 0), seen

    def packed(self) -> tuple:
        return self.languages, self.rank, self.short, self.full, self.escape, self.seen_rows

    @classmethod
    def unpack(cls, packed: tuple) -> Model:
        m = cls.__new__(cls)
        m.languages, m.rank, m.short, m.full, m.escape, seen_rows = packed
        m._index(seen_rows)
        return m

    @staticmethod
    def _context_sums(gram_counts: tuple, contexts: int) -> tuple[np.ndarray, np.ndarray]:
        keys, n = gram_counts
        ctx = _context_of(keys)
        return np.bincount(ctx, n, contexts), np.bincount(ctx, None, contexts).astype(np.float64)

    def _code_lengths(self, gram_counts: tuple, base: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Bits of each gram's last symbol; ``base``: its bits one order lower."""
        seen, n = gram_counts
        if not len(seen):
            return np.array(base)
        contexts = int(max(seen.max(), keys.max() if len(keys) else 0)) // ALPHABET + 1
        total, distinct = self._context_sums(gram_counts, contexts)
        ctx = _context_of(keys)
        at = np.searchsorted(seen, keys)
        hit = (at < len(seen)) & (seen[np.minimum(at, len(seen) - 1)] == keys)
        t, d = total[ctx], distinct[ctx]
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.log2((t + d) / np.where(hit, n[np.minimum(at, len(seen) - 1)], 1))
            escaped = base + np.where(t > 0, np.log2((t + d) / np.maximum(d, 1)), 0.0)
        return np.where(hit, own, escaped)

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.bits_and_typical(data, offsets)[0]

    def bits_and_typical(self, data: np.ndarray, offsets: np.ndarray, typical: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Each text's bits in each language and, if asked for, in its best language the median and the
        spread (median absolute deviation as a standard deviation) of the bits a byte over its windows."""
        sums, medians = np.zeros((len(offsets) - 1, len(self.languages))), np.zeros((len(offsets) - 1, 2))
        if not len(data):
            return sums, medians
        if self.after is None:
            self._index(self.seen_rows)
        codes = _codes(data, self.rank)
        grams = _grams(codes, offsets, MAX_ORDER)
        row, seen = self._rows(grams)
        costs = self.full[row]
        miss = np.flatnonzero(~seen)
        if len(miss):
            costs[miss] = self.short[grams[miss] % ALPHABET ** MAX_ORDER] + self.escape[_context_of(grams[miss])]
        costs[codes == 0] += np.float32(8.0)
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            if b > a:
                sums[i] = costs[a:b].sum(axis=0, dtype=np.float64)
                if typical:
                    own = costs[a:b, sums[i].argmin()].astype(np.float64)
                    whole = len(own) // WINDOW * WINDOW
                    means = own[:whole].reshape(-1, WINDOW).mean(axis=1) if whole else own.mean(keepdims=True)
                    middle = np.median(means)
                    medians[i] = middle, 1.4826 * np.median(np.abs(means - middle))
        return sums, medians


def _context_of(keys: np.ndarray) -> np.ndarray:
    """Keys are ``c0 + c1*A + c2*A**2 ...`` with the own symbol lowest: the rest is the context."""
    return keys // ALPHABET


def _merged(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, in order, and the sums of their counts."""
    if len(counts) == 1:
        return counts[0]
    keys, n = (np.concatenate(x) for x in zip(*counts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[order], first)


def _all_orders(keys: np.ndarray, n: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By order its grams and their counts, from those of the longest grams: a shorter gram is the end of a longer one."""
    out = {MAX_ORDER: (keys, n)}
    for order in range(MAX_ORDER - 1, -1, -1):
        keys, n = out[order] = _merged([(keys % ALPHABET ** (order + 1), n), (keys[:0], n[:0])])
    return out


def train(docs: DataFrame, train_docs: int | None = None) -> Model | None:
    """Fit the context trees of every language in the training rows; None if there are none."""
    rows = training_rows(docs, train_docs)

    def byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(256, np.int64)
        for batch in batches:
            data, _ = utf8(batch.column("text"))
            n += np.bincount(_fold[data], minlength=256)
        yield pa.record_batch({"byte": pa.array(np.arange(256), pa.int32()), "n": pa.array(n, pa.int64())})

    totals = (arrow_map(rows.select("text"), byte_counts, "byte int, n long")
              .groupBy("byte").agg(F.sum("n").alias("n")).filter("n > 0").collect())
    if not totals:
        return None
    ranked = sorted(totals, key=lambda r: (-r["n"], r["byte"]))[:ALPHABET - 1]
    rank = np.zeros(256, np.uint8)
    for code, r in enumerate(ranked, 1):
        rank[r["byte"]] = code

    def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, some in held.items():
                keys, n = _merged(some)
                yield pa.record_batch({"lang": pa.array([lang] * len(keys)), "gram": pa.array(keys, pa.int64()), "n": pa.array(n)})
            held.clear()

        for batch in batches:
            for part in slices(batch, limit=_SLICE):
                langs = np.array(part.column("lang").to_pylist())
                for lang in sorted(set(langs.tolist())):
                    data, offsets = utf8(part.filter(pa.array(langs == lang)).column("text"))
                    if len(data):
                        keys, n = np.unique(_grams(_codes(data, rank), offsets, MAX_ORDER).astype(np.int32), return_counts=True)
                        held.setdefault(lang, []).append((keys, n.astype(np.int64)))
                if sum(len(k) for some in held.values() for k, _ in some) > _HELD_GRAMS:
                    held.update({lang: [_merged(some)] for lang, some in held.items()})
                    if sum(len(some[0][0]) for some in held.values()) > _HELD_GRAMS // 2:
                        yield from counted()
        yield from counted()

    frozen = (arrow_map(rows, gram_counts, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    names = frozen.column("lang").combine_chunks().dictionary_encode()
    at, grams, n = (x.to_numpy() for x in (names.indices, frozen.column("gram"), frozen.column("n")))
    found: dict[str, dict] = {}
    for i, lang in enumerate(names.dictionary.to_pylist()):
        order = np.flatnonzero(at == i)
        order = order[np.argsort(grams[order])]
        found[lang] = _all_orders(grams[order], n[order].astype(np.float64))
    languages = sorted(lang for lang in found if MAX_ORDER in found[lang])
    return Model(languages, rank, [found[lang] for lang in languages]) if languages else None


def _scored(docs: DataFrame, model: Model | None, typical: bool = False) -> DataFrame:
    """``docs`` by position with lang_pred, score and bits a byte (null for ``und``), see ``annotate``.
    ``typical`` adds the median and the spread of the bits a byte over windows."""
    fields = "lang_pred string, score double, bits double" + (", middle double, spread double" if typical else "")
    shared = docs.sparkSession.sparkContext.broadcast(model and (uuid.uuid4().hex, model.packed()))

    def score(text: pa.Array) -> list[pa.Array]:
        letter = np.array([bool(_letter(t)) if t else False for t in text.to_pylist()], bool)
        if shared.value is None:
            n = len(text)
            return [pa.array([UNDETERMINED] * n, pa.string()), pa.array(np.zeros(n)),
                    *[pa.nulls(n, pa.float64())] * (3 if typical else 1)]
        m = kept_in_worker(KIND, shared.value[0], lambda: Model.unpack(shared.value[1]))
        data, offsets = utf8(text)
        bits, medians = m.bits_and_typical(data, offsets, typical)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(bits)), best]
        posterior = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
        size = np.maximum(np.diff(offsets), 1)
        return [pa.array([m.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letter, strict=True)],
                         pa.string()),
                pa.array(np.where(letter, posterior, 0.0)), pa.array(least / size, pa.float64(), mask=~letter),
                *([pa.array(c.copy(), pa.float64(), mask=~letter) for c in medians.T] if typical else [])]

    return annotate(docs, score, fields, keeps=KIND, limit=_SLICE)


_letter = regex.compile(r"\p{L}").search
KIND = "language models"


def identify(docs: DataFrame, train_docs: int | None = None, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits`` of each row; trained on ``docs`` unless a model is given."""
    scored = (_scored(docs.select("doc_id", "text"), model or train(docs, train_docs))
              .withColumnRenamed("_c0", "doc_id"))
    return scored.select("doc_id", (F.coalesce(fold_bucket("doc_id", 3), F.lit(0)) == 1).alias("held_out"),
                         "lang_pred", "score", "bits")


def accepted_documents(docs: DataFrame, train_docs: int | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in one of the learned languages.

    Rejected: ``und`` texts, and texts whose typical bits a byte in their best language lie beyond
    what held-out texts of the language cost, by a margin that is wider for short texts (``_bounds``).
    """
    model = train(docs, train_docs)
    scored = _scored(docs, model, typical=True)
    text = F.col(f"_c{docs.columns.index('text')}")
    windows = F.greatest(F.floor(F.octet_length(text) / WINDOW), F.lit(1))
    bounds = F.broadcast(_bounds(docs, model).withColumnsRenamed({c: "_b_" + c for c in ("lang", "typical", "among", "within")}))
    joined = scored.join(bounds, scored["lang_pred"] == bounds["_b_lang"], "left")
    margin = SLACK + LONE_WINDOW / windows + SPREADS * F.sqrt(F.col("_b_among") ** 2 + F.col("_b_within") ** 2 / windows)
    beyond = F.coalesce(F.col("middle") > F.col("_b_typical") + margin, F.lit(False))
    return restored(joined.filter((F.col("lang_pred") != UNDETERMINED) & ~beyond), docs.columns)


def _bounds(docs: DataFrame, model: Model | None) -> DataFrame:
    """``lang, typical, among, within``: of held-out texts of each language the median of their typical bits a
    byte, its spread among texts, and the spread of the median of one window, from all such texts. Training rows cost less than unseen
    ones, so only held-out rows count; a language with fewer than ``LEAST_BOUND_DOCS`` has no bound."""
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & (F.coalesce(fold_bucket("doc_id", 3), F.lit(0)) == 1) & has_letter())
    known = rows.join(F.broadcast(_frequent(rows)), F.col("lang") == F.col("_lang")).select("text", "lang")
    # written once: two aggregates read it, and none scores beside the documents' own job
    # in cells, so that a language's distinct values are few however many its texts
    cells = [(F.round(F.col(c) * BIT_CELLS) / BIT_CELLS).alias(c) for c in ("middle", "spread")]
    scored = staged(docs.sparkSession, _scored(known, model, typical=True).filter(F.col("_c1") == F.col("lang_pred"))
                    .select("_c1", *cells), "language-bounds")
    middles = scored.groupBy(F.col("_c1").alias("lang")).agg(
        F.percentile("middle", 0.5).alias("typical"), F.percentile("spread", 0.5).alias("spread"), F.count("*").alias("n"))
    apart = (scored.join(F.broadcast(middles.select(F.col("lang").alias("_lang"), "typical")), F.col("_c1") == F.col("_lang"))
             .groupBy("_lang").agg((1.4826 * F.percentile(F.abs(F.col("middle") - F.col("typical")), 0.5)).alias("among")))
    return (middles.filter(F.col("n") >= LEAST_BOUND_DOCS).join(F.broadcast(apart), F.col("lang") == F.col("_lang"))
            .select("lang", "typical", "among", (1.2533 * F.col("spread")).alias("within")))
