"""Language-model scores of whole texts under a trigram model of the corpus itself.

The model is an n-gram trie (``ngram_trie``) in shards. A shard holds a range of n-grams in the order of (first, second,
third) word, so that a context's children, a word's count and a bigram's context lie together. Every token of every text is
sent once, as the n-gram that starts there, to the shard of its range; a shard builds its part of the trie
from the training texts' n-grams and answers all of them:

- training texts: their n-grams are all in the trie, so the shard adds up log probabilities for each text;
- held-out texts: it returns for each n-gram the word's count, the probabilities and the back-off weights on its
  path. An unseen trigram (u, v, w) falls back on the bigram (v, w), which is the path of the text's next n-gram, and
  that on w's count, from the one after; so the texts' slices put the answers together.

Probabilities: absolute discounting with back-off. p(w | u v) = (c(uvw) - D) / c(uv) if seen, else weight(uv) * p(w | v);
p(w | v) likewise over p(w) = (c + 0.1) / (N + 0.1 (V + 1)), the base; weight = D * distinct followers / count.
A text starts after a begin mark, and ends with an end token; they sum up to one at most. Weights and probabilities are
quantised by the trie.

Ranges come from a hash sample of n-grams (``SAMPLES`` for each shard). A word, bigram or trigram that would fill a shard alone is
cut inside: by its next word, and a trigram by slice. Counts and distinct followers of such hot nodes (at most three for each
shard) are added up by Spark beforehand. So no shard depends on one key, and what is sent grows with the tokens.

Words are compared by 64-bit hashes; followers of one context by the upper 32 bits of these, so that of n followers of a
context about n**2 / 2**33 fall together. Counts of words, and with them ``n_known`` and ``base_score``, use all 64.

Defined results: a null text is empty, a text without words has its end token alone. A null id counts as training (its
fold is not 0). Rows that repeat an id or a text are documents of their own, each counted. An empty table gives no rows; with no training
rows N and V are 0 and all is left to the base. Extra columns are not read. The input is read twice or three times and must read
alike, as files do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.llm.common import arrow_map, fold_bucket, mix64, slices, staged, utf8, word_hashes
from skewkit.llm.ngram_trie import EliasFano, Trie

#: Text bytes whose n-grams a shard holds, about, and whose n-grams a slice sends at once.
SHARD_BYTES = 8 << 20
SLICE_BYTES = 4 << 20
#: Sampled n-grams for each shard.
SAMPLES = 100
DISCOUNT = 0.75
NONE, END, BEGIN = 0, 1 << 32, 2 << 32
FIGURES, ANSWERS, TOTALS = 0, 1, 2
ROWS = "slice long, shard int, kind int, payload binary"
PARTS = ("kind int, doc_id long, held_out boolean, n_tokens long, n_known long, base_logs double, score_logs double, "
         "n_single long")
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, with their types and lengths before them."""
    head = np.array([len(arrays), *[x for a in arrays for x in (np.dtype(a.dtype).num, len(a))]], np.int64)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


_types = {np.dtype(t).num: np.dtype(t) for t in "bBhHiIlLqQfd?"}


def unpacked(payload: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    head = np.frombuffer(payload, np.int64, 2 * n, 8)
    out, at = [], 8 + 16 * n
    for kind, size in zip(head[::2].tolist(), head[1::2].tolist(), strict=True):
        out.append(np.frombuffer(payload, _types[kind], size, at))
        at += size * _types[kind].itemsize
    return out


class Texts:
    """The n-grams of a slice of texts: ``u`` (64 bits), ``v`` and ``w`` (32) of each, in text order. Text ``i`` has
    ``tokens[i] + 1`` of them: one starts at the begin mark, one at each token."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = utf8(batch.column("text"))
        words, first = word_hashes(data, offsets)
        words = np.where(words >> np.uint64(32) < 3, words + np.uint64(3 << 32), words)
        n = np.diff(first)
        self.tokens = n + 1
        starts = np.concatenate([[0], np.cumsum(n + 2)])
        self.starts = starts
        ids = np.zeros(int(starts[-1]) + 2, np.uint64)
        row = np.repeat(np.arange(len(n)), n)
        ids[np.arange(len(words)) + 2 * row + 1] = words
        ids[starts[:-1]] = BEGIN
        ends = starts[1:] - 1
        ids[ends] = END
        self.u = ids[:-2]
        upper = (ids >> np.uint64(32)).astype(np.uint32)
        self.v, self.w = upper[1:-1].copy(), upper[2:].copy()
        self.v[ends] = NONE
        self.w[ends] = NONE
        self.w[ends - 1] = NONE
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        self.held = held
        self.doc = np.repeat(np.arange(len(n)), n + 2)

    def is_held(self) -> np.ndarray:
        return self.held[self.doc]


def _text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a partition's texts with names that a run of the task again gives alike."""
    task = TaskContext.get().partitionId()

    def joined() -> Iterator[list[pa.RecordBatch]]:
        some, size = [], 0
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                n = pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0
                if some and size + n > SLICE_BYTES:
                    yield some
                    some, size = [], 0
                some.append(part)
                size += n
        if some:
            yield some

    for made, some in enumerate(joined()):
        yield (task << 32) + made, some[0] if len(some) == 1 else pa.Table.from_batches(some).combine_chunks().to_batches()[0]


# ---------------------------------------------------------------- ranges

class Ranges:
    """Cuts of the n-grams' order into shards. A cut is (u, v, w, share of slices), as short as it tells it from the cut before
    it; what follows a prefix is 0. Nodes that a cut goes through are hot: their statistics come from all shards."""

    def __init__(self, sample: np.ndarray, shards: int):
        """``sample``: n-grams (rows of u, v, w), in any order."""
        sample = sample[np.lexsort((sample[:, 2], sample[:, 1], sample[:, 0]))]
        picked = [tuple(int(x) for x in sample[len(sample) * i // shards]) for i in range(1, shards)] if len(sample) else []
        cuts, before = [], (0, 0, 0)
        for at, (u, v, w) in enumerate(picked):
            if u != before[0]:
                cuts.append((u, 0, 0, 0))
            elif v != before[1]:
                cuts.append((u, v, 0, 0))
            elif w != before[2]:
                cuts.append((u, v, w, 0))
            else:
                same = [i for i, p in enumerate(picked) if p == (u, v, w)]
                cuts.append((u, v, w, (1 << 32) * (at - same[0]) // len(same)))
            before = (u, v, w)
        cuts = sorted(set(cuts))
        self.cuts = cuts
        self.shards = len(cuts) + 1
        self.hot = ({c[0] for c in cuts if any(c[1:])}, {c[:2] for c in cuts if any(c[2:])}, {c[:3] for c in cuts if c[3]})

    def order(self, t: Texts) -> np.ndarray:
        """Order of a slice's n-grams in which every shard's are together: by u, within hot words by v and w."""
        order = np.argsort(t.u)
        if self.hot[0]:
            u = t.u[order]
            for word in self.hot[0]:
                a, b = np.searchsorted(u, np.uint64(word), "left"), np.searchsorted(u, np.uint64(word), "right")
                inside = order[a:b]
                order[a:b] = inside[np.lexsort((t.w[inside], t.v[inside]))]
        return order

    def places(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, name: int) -> np.ndarray:
        """First n-gram of each shard in arrays that ``order`` has put in order."""
        share = int(mix64(np.array([name], np.uint64))[0] >> np.uint64(32))
        out = [0]
        for cut in self.cuts:
            a, b = 0, len(u)
            for column, value in ((u, np.uint64(cut[0])), (v, np.uint32(cut[1])), (w, np.uint32(cut[2]))):
                part = column[a:b]
                a, b = a + np.searchsorted(part, value, "left"), a + np.searchsorted(part, value, "right")
                if not any(cut[1:]) or (not any(cut[2:]) and column is v) or a == b:
                    b = a                                    # a cut at the start of a node
                    break
            else:
                if share < cut[3]:
                    a = b
            out.append(int(a))
        return np.array([*out, len(u)])


def _sample(docs: DataFrame, shards: int, total_bytes: int) -> np.ndarray:
    """Hash sample of about ``SAMPLES * shards`` n-grams; each text's n-grams are drawn by their text's hash and position."""
    rate = min(1.0, 6.0 * SAMPLES * shards / max(total_bytes, 1))
    step = max(1, int(16 * min(1.0, 1.0 / (rate * 16))))     # of the drawn documents' n-grams, one in ``step``
    share = min(1.0, rate * step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, part in _text_slices(batches):
            t = Texts(part)
            drawn = mix64(np.arange(len(t.u), dtype=np.uint64) + (mix64(np.array([name], np.uint64)) << np.uint64(20)))
            at = np.flatnonzero(drawn % np.uint64(step) == 0)
            yield pa.record_batch([pa.array([packed(t.u[at], t.v[at], t.w[at])], pa.binary())], ["payload"])

    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    parts = [unpacked(r["payload"]) for r in arrow_map(docs.filter(draw), run, "payload binary").collect()]
    return np.concatenate([np.zeros((0, 3), np.uint64), *[np.stack([x.astype(np.uint64) for x in p], axis=1) for p in parts]])


# ------------------------------------------------------------- hot nodes

HOT = "size int, u long, v long, w long"


def _runs_of(keys: list[np.ndarray]) -> np.ndarray:
    """First place of each run of equal rows in ordered columns."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _hot_statistics(docs: DataFrame, ranges: Ranges) -> dict[tuple, tuple[int, int]]:
    """Count and distinct followers in the training texts of every hot node ``(u,)``, ``(u, v)`` or ``(u, v, w)``."""
    if not any(ranges.hot):
        return {}
    hot = ranges.hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in _text_slices(batches):
            t = Texts(part)
            own = ~t.is_held() & np.isin(t.u, np.array(sorted({x[0] for level in hot[1:] for x in level} | hot[0]), np.uint64))
            u, v, w = t.u[own], t.v[own], t.w[own]
            order = np.lexsort((w, v, u))
            u, v, w = u[order], v[order], w[order]
            found, counts = ([], [], [], [], []), []
            for size in (1, 2, 3):
                for node in hot[size - 1]:
                    key = (node,) if size == 1 else node
                    a, b = 0, len(u)
                    for column, value in zip((u, v, w), key, strict=False):         # ordered by u, v and w
                        part = column[a:b]
                        value = column.dtype.type(value)
                        a, b = a + int(np.searchsorted(part, value, "left")), a + int(np.searchsorted(part, value, "right"))
                    follower = (v, w, np.zeros(len(w), np.uint32))[size - 1][a:b]
                    first = _runs_of([follower])
                    if len(first):
                        n = np.diff(np.concatenate([first, [b - a]]))
                        words = [np.uint64(key[0]).astype(np.int64), *key[1:], *[0] * (3 - size)]
                        for column, values in zip(found, (size, *words, follower[first]), strict=True):
                            column.append(np.broadcast_to(np.asarray(values, np.int64), len(first)))
                        counts.append(n)
            columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in (*found, counts)]
            yield pa.record_batch([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(columns)],
                                  ["size", "u", "v", "w", "follower", "n"])

    node = ["size", "u", "v", "w"]
    pairs = arrow_map(docs, run, HOT + ", follower long, n long").groupBy(*node, "follower").agg(F.sum("n").alias("n"))
    found = pairs.groupBy(*node).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("follower") != NONE, 1).otherwise(0)).alias("d"))
    return {(r["u"] % (1 << 64), r["v"], r["w"])[:r["size"]]: (r["n"], r["d"]) for r in found.collect()}


# ---------------------------------------------------------------- shards

def _send(docs: DataFrame, ranges: Ranges) -> DataFrame:
    """Each slice's n-grams by shard, and its figures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, part in _text_slices(batches):
            t = Texts(part)
            order = ranges.order(t)
            held = t.is_held()
            position = np.cumsum(held) - 1                     # of the held-out texts' n-grams
            label = np.where(held, position, t.doc).astype(np.uint32)
            small = np.uint16 if len(t.tokens) < 1 << 16 else np.uint32
            u, v, w, held, label = t.u[order], t.v[order], t.w[order], held[order], label[order]
            places = ranges.places(u, v, w, name)
            ids = part.column("doc_id")
            rows = [(name, name % ranges.shards, FIGURES, packed(
                ids.fill_null(0).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False), t.tokens, t.held))]
            for s in np.flatnonzero(np.diff(places)):
                a, b = places[s], places[s + 1]
                sent = []
                for mine, kind in ((~held[a:b], small), (held[a:b], np.uint32)):
                    own = u[a:b][mine]
                    first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
                    sent += [np.frombuffer(EliasFano.encode(own[first]), np.uint8), np.packbits(first), v[a:b][mine], w[a:b][mine],
                             label[a:b][mine].astype(kind)]
                rows.append((name, int(s), ANSWERS, packed(*sent)))
            yield _batch(rows)
    return arrow_map(docs, run, ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                           ["slice", "shard", "kind", "payload"])


def _read_block(payload: bytes) -> list[tuple[np.ndarray, ...]]:
    a = unpacked(payload)
    out = []
    for u, first, v, w, label in (a[:5], a[5:]):
        at = np.cumsum(np.unpackbits(first, count=len(v)), dtype=np.int32) - 1
        out.append((EliasFano(u.tobytes()).values()[at], v, w, label))
    return out


class Shard:
    """The trie of one range, and its answers."""

    def __init__(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, held: np.ndarray, hot: dict, discount: float):
        order = np.argsort((v.astype(np.uint64) << np.uint64(32)) | w).astype(np.int32)
        order = order[np.argsort(u[order], kind="stable").astype(np.int32)]
        u, v, w, trained = u[order], v[order], w[order], ~held[order]
        firsts = [_runs_of([u]), _runs_of([u, v]), _runs_of([u, v, w])]
        #: distinct n-grams of each size: their words, and for each the one that it starts with
        self.words, self.second, self.third = u[firsts[0]], v[firsts[1]], w[firsts[2]]
        above = [None, np.searchsorted(firsts[0], firsts[1], "right") - 1, np.searchsorted(firsts[1], firsts[2], "right") - 1]
        added = np.concatenate([[0], np.cumsum(trained)])
        counts = [np.diff(added[np.append(f, len(u))]) for f in firsts]
        # an end has no follower: its place is not a node of the trie
        counts[1] = np.where(self.second == NONE, 0, counts[1])
        counts[2] = np.where(self.third == NONE, 0, counts[2])
        followers = [np.bincount(above[k + 1], counts[k + 1] > 0, len(counts[k])) for k in (0, 1)]
        self._merge(hot, counts, followers, above)
        own_hot = np.isin(self.words, np.array(sorted(k[0] for k in hot if len(k) == 1), np.uint64))
        real = (counts[0] > 0) & ~own_hot & (self.words != np.uint64(BEGIN))
        self.tokens, self.distinct = int(counts[0][real].sum()), int(real.sum())
        self._build(counts, followers, above, discount)
        self._ask(above)
        #: of each n-gram as it came: its places among the distinct ones
        self.node = []
        for f in firsts:
            mark = np.zeros(len(u), np.int8)
            mark[f] = 1
            place = np.empty(len(u), np.int32)
            place[order] = np.cumsum(mark, dtype=np.int32) - 1
            self.node.append(place)

    def _merge(self, hot: dict, counts, followers, above) -> None:
        for node, (n, d) in hot.items():
            at = np.flatnonzero(self.words == np.uint64(node[0]))
            for level, word in enumerate(node[1:], 1):
                parents, names = above[level], (None, self.second, self.third)[level]
                at = np.flatnonzero(np.isin(parents, at) & (names == np.uint32(word))) if len(at) else at
            if len(at):
                level = len(node) - 1
                counts[level][at] = n if node[-1] != NONE or level == 0 else 0
                if level < 2:
                    followers[level][at] = d

    def _build(self, counts, followers, above, discount: float) -> None:
        kept = [np.flatnonzero(c > 0) for c in counts]
        levels, probabilities, backoffs = [], [], []
        for k in (0, 1):
            n = counts[k][kept[k]]
            with np.errstate(divide="ignore"):
                weight = np.log10(discount * followers[k][kept[k]] / n)
            backoffs.append(np.where(followers[k][kept[k]] > 0, weight, 0.0))
            parent = above[k + 1][kept[k + 1]]
            names = (self.second, self.third)[k][kept[k + 1]]
            levels.append((np.searchsorted(kept[k], parent), names))
            probabilities.append(np.log10((counts[k + 1][kept[k + 1]] - discount) / counts[k][parent]))
        self.trie = Trie.mapped(Trie.encode(self.words[kept[0]], counts[0][kept[0]], levels, probabilities, backoffs))

    def _ask(self, above) -> None:
        t = self.trie
        word = t.word(self.words)
        second = t.lookup(1, word[above[1]], self.second)
        third = t.lookup(2, second[above[2]], self.third)
        self.count = t.count(word)
        self.log_count = np.log10(self.count + 0.1)
        self.backoff = [t.backoff(0, word), t.backoff(1, second)]
        self.log_p = [t.probability(1, second), t.probability(2, third)]

    def training(self, at: slice, doc: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
        """Documents among n-grams ``at``, with the sums of their logarithms of count + 0.1 and of probability."""
        begin = u == np.uint64(BEGIN)
        nodes = [n[at] for n in self.node]
        base = np.where(begin, 0.0, self.log_count[nodes[0]])
        third = self.log_p[1][nodes[2]]
        score = np.where(np.isnan(third), 0.0, third) + np.where(begin, self.log_p[0][nodes[1]], 0.0)
        documents = np.flatnonzero(np.bincount(doc))
        # of the scores, a single float's error is far below that of the trie's codes; base sums are exact
        return (documents.astype(doc.dtype), np.bincount(doc, base)[documents], np.bincount(doc, score)[documents].astype(np.float32))

    def heldout(self, at: slice, position: np.ndarray) -> tuple[np.ndarray, ...]:
        """Positions, counts of their first words, and by bigram and trigram one value: the log probability (below 0) if it is
        seen, else minus the log of its context's weight (0 or more)."""
        word, second, third = (n[at] for n in self.node)
        count = self.count[word]
        values = [np.where(np.isnan(p), -weight, p).astype(np.float32) for p, weight in (
            (self.log_p[0][second], self.backoff[0][word]), (self.log_p[1][third], self.backoff[1][second]))]
        return (position, count.astype(np.uint32) if not len(count) or count.max() < 1 << 32 else count, *values)


def _answer(sent: DataFrame, ranges: Ranges, hot: dict, discount: float) -> DataFrame:
    """Each shard's answers to its blocks, one shard a task, and the slices' figures passed on."""
    shared = sent.sparkSession.sparkContext.broadcast(hot)

    def answers(rows: list[tuple[int, int, bytes]], shard: int) -> Iterator[pa.RecordBatch]:
        blocks = [(name, *_read_block(x)) for name, kind, x in rows if kind == ANSWERS]
        rows.clear()
        if not blocks:
            return
        sizes = [(len(t[1]), len(h[1])) for _, t, h in blocks]
        u, v, w = (np.concatenate([x for _, t, h in blocks for x in (t[i], h[i])]) for i in range(3))
        held = np.repeat(np.tile([False, True], len(blocks)), np.array(sizes).ravel())
        labels = [(name, t[3], h[3]) for name, t, h in blocks]
        blocks.clear()
        s = Shard(u, v, w, held, shared.value, discount)
        at = 0
        for (name, doc, position), (n_t, n_h) in zip(labels, sizes, strict=True):
            trained, kept = slice(at, at + n_t), slice(at + n_t, at + n_t + n_h)
            at += n_t + n_h
            yield _batch([(name, shard, ANSWERS, packed(*s.training(trained, doc, u[trained]), *s.heldout(kept, position)))])
        yield _batch([(-1, shard, TOTALS, packed(np.array([s.tokens, s.distinct])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            payloads = [x.as_buffer() for x in batch.column(3)]            # not copied
            for name, shard, kind, x in zip(*(batch.column(i).to_pylist() for i in range(3)), payloads, strict=True):
                if shard != now:
                    yield from answers(rows, now)
                    now, rows = shard, []
                if kind == FIGURES:
                    yield _batch([(name, -1, FIGURES, x.to_pybytes())])
                else:
                    rows.append((name, kind, x))
        yield from answers(rows, now)

    return arrow_map(sent.repartitionById(ranges.shards, "shard").sortWithinPartitions("shard", "slice"), run, ROWS)


# --------------------------------------------------------------- results

def _finish(answered: DataFrame, shards: int) -> DataFrame:
    """Each document's figures but for the size of the training texts, which is in rows of their own (kind ``TOTALS``): sums of
    logarithms, and how many times ``score_logs`` has a word's own probability (``n_single``)."""
    columns = [c.split(" ")[0] for c in PARTS.split(", ")]

    def of_slice(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        ids, null, tokens, held = unpacked(next(x for kind, x in rows if kind == FIGURES))
        n = len(ids)
        base, score, known, singles = np.zeros(n), np.zeros(n), np.where(held, 0, tokens), np.zeros(n, np.int64)
        starts = np.concatenate([[0], np.cumsum(np.where(held, tokens + 1, 0))])
        total = int(starts[-1])
        count, second, third = np.zeros(total + 2, np.int64), np.zeros(total + 2), np.zeros(total + 2)
        for kind, x in rows:
            if kind == ANSWERS:
                doc, b, s, at, *values = unpacked(x)
                base[doc] += b
                score[doc] += s
                for column, value in zip((count, second, third), values, strict=True):
                    column[at] = value
        if total:
            doc = np.repeat(np.arange(n), np.where(held, tokens + 1, 0))
            place = np.arange(total) - starts[doc]
            single = np.log10(count + 0.1)
            backed = second[:-1] >= 0                                     # the bigram is not there
            pair = np.where(backed, single[1:] - second[:-1], second[:-1])                     # of the word after each
            further = third[:-2] >= 0
            triple = np.where(further, pair[1:] - third[:-2], third[:-2])                      # of the one after that
            own, inner = place > 0, place < tokens[doc] - 1
            np.add.at(base, doc[own], single[:total][own])
            np.add.at(known, doc[own], (count[:total][own] > 0).astype(known.dtype))
            np.add.at(score, doc[~own], pair[:total][~own])
            np.add.at(singles, doc[~own], backed[:total][~own].astype(np.int64))
            np.add.at(score, doc[inner], triple[:total][inner])
            np.add.at(singles, doc[inner], (further & backed[1:])[:total][inner].astype(np.int64))
        return pa.record_batch([pa.array(np.full(n, FIGURES, np.int32)), pa.array(ids, mask=null.astype(bool)), pa.array(held.astype(bool)),
                                pa.array(tokens), pa.array(known), pa.array(base), pa.array(score), pa.array(singles)], columns)

    def of_totals(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        tokens, distinct = np.sum([unpacked(x)[0] for _, x in rows], axis=0).tolist()
        return pa.record_batch([pa.array([x], t) for x, t in zip((TOTALS, None, None, tokens, distinct, None, None, None), (
            pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()), strict=True)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for name, kind, x in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if name != now and rows:
                    yield of_totals(rows) if now < 0 else of_slice(rows)
                    rows = []
                now = name
                rows.append((kind, x))
        if rows:
            yield of_totals(rows) if now < 0 else of_slice(rows)

    return arrow_map(answered.repartition(shards, "slice").sortWithinPartitions("slice"), run, PARTS)


def score_texts(docs: DataFrame, discount: float = DISCOUNT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each document, see ``RESULT``. ``score``: the model's log10 probability of the text; ``base_score``: that of
    its tokens under counts alone."""
    spark = docs.sparkSession
    held = F.coalesce(fold_bucket("doc_id", 10) == 0, F.lit(False))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), held.alias("held_out"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(2 * spark.sparkContext.defaultParallelism, -(-size // shard_bytes))
    ranges = Ranges(_sample(own, shards, size), shards)
    hot = _hot_statistics(own, ranges)
    # a few numbers a document: what is gathered and sent back passes through two shuffles and is not kept
    parts = staged(spark, _finish(_answer(_send(own, ranges), ranges, hot, discount), ranges.shards), "scores")
    totals = parts.filter(F.col("kind") == TOTALS).agg(F.sum("n_tokens").alias("n"), F.sum("n_known").alias("v")).first()
    words = {k[0]: n for k, (n, _) in hot.items() if len(k) == 1 and k[0] != BEGIN and n}
    train_tokens, distinct = (totals["n"] or 0) + sum(words.values()), (totals["v"] or 0) + len(words)
    whole = F.lit(float(np.log10(train_tokens + 0.1 * (distinct + 1))))
    return parts.filter(F.col("kind") == FIGURES).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_logs") - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("score_logs") - F.col("n_single") * whole).alias("score"))
