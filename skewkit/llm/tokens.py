"""Token ids of whole texts, with the words that were seen before read from a cache.

A byte-level or word BPE never merges across the start of a white-space run that
follows a non-space character, nor between a letter and the punctuation after it, so a text can be cut
there and its pieces encoded on their own. Words repeat, so the tokenizer sees each distinct piece
once for as long as the worker's cache holds it: pieces have numbers, and a batch's ids are gathered by them from one
array. A batch's distinct pieces are found by Arrow, and a piece of Latin letters with punctuation after it is looked up
without that, and in small letters if capitals are the same to the vocabulary. The cache is bounded: when it is full, the pieces that were met most often stay. The ids are those of
the whole text's encoding.

Strings of special tokens in a text are ordinary text, or with ``special_tokens`` their own ids, as the
library encodes by default; they are cut out of the text first, so pieces hold them whole (none has a space).
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skewkit.llm.common import kept_in_worker

#: Pieces in the cache before a batch, and ids of them for each.
CACHE_PIECES = 700_000
IDS_PER_PIECE = 16
#: Pieces that are encoded as one text.
RUN_PIECES = 200
_TRAILING = ".,!?;:"
_LATIN_TRAILING = ".,!?;:#$%&*"

_cut = re.compile(r"(?<=\S)(?= )")
_odd_gap = re.compile(r"\s ")
_space = re.compile(r"\s")
_any_cut = re.compile(r"(?<=\S)(?=[ \n])")


def runs(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``start .. start + size - 1`` of every run, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def pieces(text: str) -> list[str]:
    """The text, cut at each space that follows a non-space character; the space itself is left out.
    All pieces but the first follow such a space."""
    if _odd_gap.search(text):
        first, *rest = _cut.split(text)
        return [first, *[p[1:] for p in rest]]
    return text.split(" ")


def _keys(text: str) -> list[str]:
    """The text, cut at each space or line feed that follows a non-space character, as cache keys: see ``_spelled``."""
    first, *rest = _any_cut.split(text)
    return [first, *[p[1:] if p[0] == " " and p[1:2] not in (" ", "\n") else p for p in rest]]


def _spelled(key: str) -> str:
    """What a key stands for: itself if it begins with a space or line feed, else the key with a space before it."""
    return key if key[:1] in (" ", "\n") and key else " " + key


class _Codes(dict):
    """Numbers pieces as they are first asked for; ``fresh`` collects the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = code = len(self)
        self.fresh.append(piece)
        return code


class CachedEncoder:
    """``encode(texts)``: the ids of each text, as uint32 arrays."""

    def __init__(self, vocabulary: str, cache_pieces: int = CACHE_PIECES, special_tokens: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = not special_tokens
        # words of a line feed and letters: a line feed is a word of its own, or dropped
        self.line_words = self.tokenizer.encode("\na", add_special_tokens=False).word_ids[-1] + 1
        # whether capitals are small letters to this vocabulary
        self.small = self.tokenizer.encode("A É", add_special_tokens=False).ids == self.tokenizer.encode("a é", add_special_tokens=False).ids
        self.limit = cache_pieces
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()                            # keys of all pieces but a text's first
        self.ids = np.zeros(1 << 16, np.uint32)          # of all pieces, one after the other
        self.used = 0
        self.start, self.size, self.hits = (np.zeros(1 << 14, np.int64) for _ in range(3))      # by code
        self.inside_gap = np.zeros(1 << 14, bool)        # by code: the cut after this key lies inside white space
        self.heads: dict[str, bytes] = {}                # ids of pieces that no space precedes

    def _make_room(self) -> None:
        """Keep the pieces that were met most often, half of what fits at most."""
        held = len(self.codes)
        often = np.flatnonzero(self.hits[:held] > 1)
        room = min(self.limit, self.used // IDS_PER_PIECE) // 2
        if len(often) > room:
            often = np.sort(often[np.argsort(-self.hits[often], kind="stable")[:room]])
        names, old = list(self.codes), (self.ids, self.start[often], self.size[often], self.hits[often])
        gaps = self.inside_gap[often]
        self._forget()
        for i in often.tolist():
            self.codes[names[i]] = len(self.codes)
        if len(often):
            ids, start, size, hits = old
            self._store(np.arange(len(often)), size)
            self.ids[:self.used] = ids[runs(size, start)]
            self.hits[:len(often)], self.inside_gap[:len(often)] = hits >> 1, gaps

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if self.used > IDS_PER_PIECE * self.limit or len(self.codes) > self.limit or len(self.heads) > self.limit // 4:
            self._make_room()
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        found = cut.flatten().dictionary_encode()
        edges = cut.offsets.to_numpy().astype(np.int64)
        at, first = found.indices.to_numpy(), edges[:-1] - edges[0]
        counts = np.diff(edges) - 1
        heads = _strings(found.dictionary.take(pa.array(at[first])))
        out, odd = self._bodies(found.dictionary, np.delete(at, first), counts)
        # a cut inside white space, before the last piece or after the first one: those texts are cut with care
        again = sorted({*odd, *(i for i, h in enumerate(heads) if counts[i] and h[-1:].isspace())})
        if again:
            rest = []
            for i in again:
                heads[i], *keys = _keys(texts[i].as_py())
                counts[i] = len(keys)
                rest += keys
            found = pa.array(rest, pa.large_string()).dictionary_encode()
            for i, body in zip(again, self._bodies(found.dictionary, found.indices.to_numpy(), counts[again])[0], strict=True):
                out[i] = body
        self._learn_heads(set(heads))
        return [np.concatenate([np.frombuffer(self.heads[h], np.uint32), body]) if h else body for h, body in zip(heads, out, strict=True)]

    def _bodies(self, names: pa.Array, at: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
        """Ids of texts of ``counts`` pieces each, the pieces being ``names[at]``; and which texts are cut inside white space."""
        used = np.flatnonzero(np.bincount(at, minlength=len(names)))
        place = np.zeros(len(names), np.int64)
        place[used] = np.arange(len(used))
        at = place[at]
        cores, tails, kind = self._split(names.take(pa.array(used)))
        codes = np.fromiter(map(self.codes.__getitem__, _strings(cores.dictionary)), np.int64, len(cores.dictionary))
        if self.codes.fresh:
            self._learn()
        codes = codes[cores.indices.to_numpy()]
        self.hits[:len(self.codes)] += np.bincount(codes, np.bincount(at, minlength=len(used)), len(self.codes)).astype(np.int64)
        # ids of the distinct pieces, one after the other, then those of all
        tail_size = np.array([len(x) for x in tails], np.int64)
        n, m = self.size[codes], tail_size[kind]
        size = n + m
        begin = np.cumsum(size) - size
        ids = np.empty(int(size.sum()), np.uint32)
        ids[runs(n, begin)] = self.ids[runs(n, self.start[codes])]
        ids[runs(m, begin + n)] = np.concatenate(tails)[runs(m, (np.cumsum(tail_size) - tail_size)[kind])]
        sizes = size[at]
        all_ids = ids[runs(sizes, begin[at])]
        ends = np.cumsum(counts)
        odd = self.inside_gap[codes]
        if odd.any():
            odd = odd[at]
            odd[ends[counts > 0] - 1] = False
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])].tolist()
        return ([all_ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)],
                np.unique(np.searchsorted(ends, np.flatnonzero(odd), side="right")).tolist())

    def _split(self, names: pa.Array) -> tuple[pa.DictionaryArray, list[np.ndarray], np.ndarray]:
        """The keys of pieces; the ids of kinds of punctuation, and the kind that each piece has after its key."""
        bare = pc.utf8_rtrim(names, _LATIN_TRAILING)
        length = pc.binary_length(names).to_numpy() - pc.binary_length(bare).to_numpy()
        latin = _latin_word(bare) & (length <= 8)
        keys = pc.if_else(latin, pc.utf8_lower(bare) if self.small else bare, names)
        tailed = np.flatnonzero(latin & (length > 0))
        text, edges = _bytes(names)
        length, end = length[tailed], edges[1:][tailed]
        spelled = np.zeros((len(tailed), 8), np.uint8)
        for j in range(int(length.max(initial=0))):
            spelled[:, j] = np.where(j < length, text[np.minimum(end - length + j, len(text) - 1)], 0)
        kinds, which = np.unique(spelled.view("<u8").ravel(), return_inverse=True)
        kind = np.zeros(len(names), np.int64)
        kind[tailed] = which + 1
        tails = ["", *(int(k).to_bytes(8, "little").rstrip(b"\0").decode() for k in kinds)]
        self._learn_heads(set(tails))
        return keys.dictionary_encode(), [np.frombuffer(self.heads[t], np.uint32) for t in tails], kind

    def _store(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Room for the ids of pieces; where each of them begins."""
        top = int(codes.max()) + 1
        while top > len(self.start):
            self.start, self.size, self.hits, self.inside_gap = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size, self.hits, self.inside_gap))
        total = int(sizes.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        begin = self.used + np.cumsum(sizes) - sizes
        self.start[codes], self.size[codes] = begin, sizes
        self.used += total
        return begin

    def _learn(self) -> None:
        """Encode the pieces that were asked for and have no ids yet."""
        codes = self.codes
        wanted, codes.fresh = codes.fresh, []
        # a word with punctuation after it: the word may be known without
        cores = {p: core for p in wanted if (core := p.rstrip(_TRAILING)) != p and _ends_in_letter(core)}
        inner = [codes[core] for core in cores.values()]
        plain = [p for p in wanted if p not in cores] + codes.fresh
        codes.fresh = []
        gaps = [codes[p] for p in plain if not p or p[-1].isspace()]
        for keys, sizes, ids in self._words(plain):
            at = np.fromiter(map(codes.__getitem__, keys), np.int64, len(keys))
            self._store(at, sizes)
            self.ids[self.used - len(ids):self.used] = ids
        self.inside_gap[gaps] = True
        if not cores:
            return
        tails = [p[len(core):] for p, core in cores.items()]
        kinds = sorted(set(tails))
        self._learn_heads(set(kinds))
        kind = np.fromiter(map({t: i for i, t in enumerate(kinds)}.__getitem__, tails), np.int64, len(tails))
        tail_ids = [np.frombuffer(self.heads[t], np.uint32) for t in kinds]
        tail_size = np.array([len(x) for x in tail_ids])
        tail_start = np.cumsum(tail_size) - tail_size
        inner = np.array(inner, np.int64)
        n, m = self.size[inner], tail_size[kind]
        at = np.fromiter(map(codes.__getitem__, cores), np.int64, len(cores))
        begin = self._store(at, n + m)
        self.ids[runs(n, begin)] = self.ids[runs(n, self.start[inner])]
        self.ids[runs(m, begin + n)] = np.concatenate(tail_ids)[runs(m, tail_start[kind])]

    def _plain(self, texts: list[str]) -> list[bytes]:
        out = []
        for start in range(0, len(texts), 20_000):
            some = self.tokenizer.encode_batch(texts[start:start + 20_000], add_special_tokens=False)
            out.extend([array("I", e.ids).tobytes() for e in some])
        return out

    def _words(self, new: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Keys, their numbers of ids and all their ids. Letters alone are one word to the tokenizer whatever stands beside
        them, so many keys are encoded as one text and its ids are cut where a word begins. So are keys in ASCII, by the
        place where an id begins."""
        letters, lines, solid, alone = [], [], [], []
        for p in new:
            (letters if p.isalpha() else lines if p[:1] == "\n" and p[1:].isalpha() else solid if _solid(p) else alone).append(p)
        for keys, words in ((letters, 1), (lines, self.line_words)):
            for some in _batches(keys):
                coded = self.tokenizer.encode_batch(["".join(map(_spelled, r)) for r in some], add_special_tokens=False)
                for run, e in zip(some, coded, strict=True):
                    word = np.array(e.word_ids, np.int64)
                    if len(word) and word[-1] + 1 == words * len(run):
                        yield run, np.diff(np.searchsorted(word, words * np.arange(len(run) + 1))), np.array(e.ids, np.uint32)
                    else:           # a letter has split a word, in lower case say
                        alone += run
        for some in _batches(solid):
            spelled = [list(map(_spelled, r)) for r in some]
            coded = self.tokenizer.encode_batch(list(map("".join, spelled)), add_special_tokens=False)
            for run, texts, e in zip(some, spelled, coded, strict=True):
                begin = np.fromiter((a for a, _ in e.offsets), np.int64, len(e))
                ends = np.cumsum([0, *map(len, texts)])
                yield run, np.diff(np.searchsorted(begin, ends)), np.array(e.ids, np.uint32)
        if alone:
            found = self._plain(list(map(_spelled, alone)))
            yield alone, np.fromiter(map(len, found), np.int64, len(found)) // 4, np.frombuffer(b"".join(found), np.uint32)

    def _learn_heads(self, wanted: set[str]) -> None:
        new = [p for p in wanted if p not in self.heads]
        self.heads.update(zip(new, self._plain(new), strict=True))


def _batches(keys: list[str]) -> Iterator[list[list[str]]]:
    """Runs of keys that are encoded as one text each, 100 at a time."""
    parts = [keys[i:i + RUN_PIECES] for i in range(0, len(keys), RUN_PIECES)]
    return (parts[i:i + 100] for i in range(0, len(parts), 100))


def _solid(key: str) -> bool:
    """ASCII without white space but a line feed before it, no special token, nothing long."""
    body = key[1:] if key[:1] == "\n" else key
    return 0 < len(body) <= 64 and body.isascii() and "<|" not in body and not _space.search(body)


def _ends_in_letter(text: str) -> bool:
    # also in lower case, where a letter may end in a mark of its own
    return text != "" and text[-1].isalpha() and text[-1].lower()[-1].isalpha()


def _strings(names: pa.Array) -> list[str]:
    return names.to_numpy(zero_copy_only=False).tolist()     # several times as fast as to_pylist


def _bytes(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, a zero after them, and where each string begins and the last ends."""
    _, offsets, data = names.buffers()
    edges = np.frombuffer(offsets, np.int64)[names.offset:names.offset + len(names) + 1] if len(names) else np.zeros(1, np.int64)
    text = np.zeros(int(edges[-1]) + 1, np.uint8)
    if len(text) > 1:
        text[:-1] = np.frombuffer(data, np.uint8)[:len(text) - 1]
    return text, edges


def _latin_word(names: pa.Array) -> np.ndarray:
    """Which strings have only characters below U+0180 and a letter at their end, each letter with one small letter
    wherever it stands (so no dotted capital I), and cannot hold a special token."""
    text, edges = _bytes(names)
    end = text[np.maximum(edges[1:] - 1, 0)]
    lead = text[np.maximum(edges[1:] - 2, 0)]
    small = end | np.uint8(32)
    letter = (small >= 97) & (small <= 122) & (end < 128)
    letter |= (end >= 128) & ((lead == 0xC4) | (lead == 0xC5) | ((lead == 0xC3) & (end != 0x97) & (end != 0xB7)))
    other = (text > 0xC5) | (text == ord("<"))
    other[:-1] |= (text[:-1] == 0xC4) & (text[1:] == 0xB0)
    before = np.concatenate([[0], np.cumsum(other)])
    return letter & (edges[1:] > edges[:-1]) & (before[edges[1:]] == before[edges[:-1]])


KIND = "tokens"


def encoder(vocabulary: str, special_tokens: bool = False) -> CachedEncoder:
    """This worker's encoder of a vocabulary file."""
    return kept_in_worker(KIND, (vocabulary, special_tokens), lambda: CachedEncoder(vocabulary, special_tokens=special_tokens))
