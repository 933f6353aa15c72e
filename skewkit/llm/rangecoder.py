"""Adaptive context-mixing range coder for token ids, many blocks in step.

A block is a run of ids that is coded on its own: its model starts afresh and its bytes
carry checksums, so blocks can be decoded in any order and a damaged one is noticed.
A block begins with the list of its distinct ids (Elias-Fano), so the model deals with ranks in that list.

For each id the model has three predictions. Order 2 and order 1 predict the id that
last followed the two preceding ids (found by a hash of them) or the preceding one. Order 0 is a
distribution over the listed ids, by their counts so far. First comes one of three outcomes: order 2 is right,
order 1 is right, or neither. Its probabilities are mixed from three experts: the
last outcome alone, how often the order-1 slot was right lately (and whether both agree), and how
often the order-2 slot was. Expert weights move towards those that gave the
outcome more than the others did. After "neither" the id itself is coded by order 0.

The slots change with each id. Order 0, the experts' chances and their weights are set up anew after as many ids again (128 to 1024),
from the counts so far; between those the chances of all states of the slots are one table.

The writer knows all ids, so it finds what every slot held by sorting a block's positions by slot: whole
blocks are arrays, a few at a time, and only the interval goes step by step. The reader steps through the positions,
numpy through the blocks: position ``t`` of all blocks of a batch is decoded at once.

An outcome and the id after "neither" are one interval of 2**25. The coder keeps ``low`` and ``range`` as
integers below 2**64 and puts out 32-bit words with carries. The same file comes out on any machine.

Block layout (little endian): ``b"CMR3"``, ids (u32), distinct ids (u32), words (u32), CRC-32 of the ids as
u32 values, CRC-32 of all other bytes, the list of ids, the words (u32).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMR3"
_HEADER = struct.Struct("<4sIIIII")
_SLOT_BITS = 11            # of a hash of two ids
#: Order 0 and the experts are set up anew after a share of the ids so far, or so many.
_GROWTH, _FIRST_STEPS, _SETUP_STEPS = 1, 128, 1024
_ROOM_BITS, _FULL_BITS = 13, 12
_ROOM = 1 << _ROOM_BITS    # shares that an order-0 distribution deals out
_FULL = 1 << _FULL_BITS    # shares of the three outcomes
_WHOLE_BITS = np.uint64(_ROOM_BITS + _FULL_BITS)
_LOW, _WORD_BITS = np.uint64(1 << 32), np.uint64(32)
#: Counts of an expert's row are halved beyond this.
_MOST = 400
#: Blocks that are coded in step. A block may have LONGEST ids at most, so that order 0 has a share for each.
LANES = 2048
LONGEST = 4096
#: Ids (and places of a table of all ids) that the writer's model holds at a time.
_AT_ONCE = 1 << 18


def _segments(steps: int) -> list[tuple[int, int]]:
    """Positions between which order 0 stays as it is."""
    edges = [0]
    while edges[-1] < steps:
        edges.append(min(steps, edges[-1] + min(max(_FIRST_STEPS, edges[-1] // _GROWTH // 32 * 32), _SETUP_STEPS)))
    return list(zip(edges[:-1], edges[1:], strict=True))


def _hashed(before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Slot of the two preceding ranks, uint16 arrays."""
    return (before * np.uint16(0x9E35) ^ earlier * np.uint16(0x6A6D)) >> np.uint16(16 - _SLOT_BITS)


class _OrderZero:
    """Counts of the listed ids of all lanes, a lane's cells together, and their shares of ``_ROOM``."""

    def __init__(self, distinct: np.ndarray):
        self.lanes = len(distinct)
        self.distinct = distinct
        self.first = np.cumsum(distinct) - distinct
        self.counts = np.zeros(int(distinct.sum()), np.int64)
        self.rank = np.arange(len(self.counts)) - np.repeat(self.first, distinct)
        self.total = np.zeros(self.lanes, np.int64)
        self.set_up()

    def add(self, cells: np.ndarray, came: np.ndarray) -> None:
        """``cells`` of the ids that came, ``came`` of them for each lane."""
        self.counts += np.bincount(cells, minlength=len(self.counts))
        self.total += came
        self.set_up()

    def set_up(self) -> None:
        # a share for each, the others by the counts; before the first id all are alike
        sums = np.cumsum(self.counts) if self.total.any() else np.arange(1, len(self.counts) + 1)
        ends = sums[self.first + self.distinct - 1]
        before = np.concatenate([[0], ends[:-1]])
        sums -= np.repeat(before, self.distinct)
        sums *= np.repeat(_ROOM - self.distinct, self.distinct)
        sums //= np.repeat(np.maximum(ends - before, 1), self.distinct)
        sums += self.rank
        sums += 1
        self.start = np.empty(len(sums), np.uint32)
        self.start[1:] = sums[:-1]
        self.start[self.first] = 0
        self.size = sums.astype(np.uint32) - self.start

    def by_share(self) -> np.ndarray:
        """For each lane and share the rank of the id."""
        return np.repeat(self.rank.astype(np.uint16), self.size)


class _Outcomes:
    """Chances of the three outcomes in the 96 states of all lanes; the last axis of every table runs over lanes."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        # experts: outcomes counted, by last outcome (3 rows), order-1 slot (8), order-2 slot (4)
        self.counts = [np.zeros((n, 3, lanes), np.int64) for n in (3, 8, 4)]
        self.weights = np.full((3, lanes), 20, np.int64)
        self._set_up()

    def _set_up(self) -> None:
        """Chances (of ``_FULL``) in all 96 states, mixed: ``none`` and ``known``, where the shares of outcome 1 and 2 begin."""
        self.chances = []
        for c in self.counts:
            some = (2 * c[:, 1:] + 1) * _FULL // (2 * (c[:, :1] + c[:, 1:2] + c[:, 2:]) + 8)
            self.chances.append(np.concatenate([_FULL - some[:, :1] - some[:, 1:], some], axis=1).astype(np.int32))
        divisor = (self.weights.sum(axis=0) * _FULL).astype(np.float64)
        weighted = [w * c for w, c in zip(self.weights.astype(np.int32), self.chances, strict=True)]
        one, two = (np.floor((a + b + c) * (_FULL - 3.0) / divisor) + 1 for a, b, c in (self._by_state(weighted, o) for o in (1, 2)))
        self.none, self.known = (_FULL - one - two).astype(np.uint32).ravel(), (_FULL - two).astype(np.uint32).ravel()

    @staticmethod
    def _by_state(rows: list[np.ndarray], outcome: int) -> list[np.ndarray]:
        last, one, two = (r[:, outcome] for r in rows)
        return [last[:, None, None], one[None, :, None], two[None, None, :]]

    def adapt(self, found: np.ndarray) -> None:
        """Count what has come (each as outcome times 96 plus state, times lanes, plus lane) and set up the chances anew."""
        came = np.bincount(found, minlength=288 * self.lanes).astype(np.int32).reshape(3, 3, 8, 4, self.lanes)
        better = np.zeros((3, self.lanes), np.int64)
        for o in range(3):
            given = self._by_state(self.chances, o)
            total = given[0] + given[1] + given[2]
            for e, by in enumerate(given):
                better[e] += (came[o] * (3 * by > total)).reshape(96, -1).sum(axis=0)
        by_last, by_one, by_two = (came.sum(axis=axes) for axes in ((2, 3), (1, 3), (1, 2)))
        self.weights = np.clip(self.weights + ((2 * better - by_last.sum(axis=(0, 1))) >> 2), 1, 60)
        for c, new in zip(self.counts, (by_last, by_one, by_two), strict=True):
            c += new.swapaxes(0, 1)
            c >>= (c.sum(axis=1, keepdims=True) > _MOST)
        self._set_up()


def _states(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which of the 32 states two slots are in: rank + 1 (0: none), in the last two bits how sure each is."""
    three = np.uint16(3)
    return (((one ^ two) < 4) * np.uint16(16)) | ((one & three) << np.uint16(2)) | (two & three)


def _slots_seen(slots: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """What the slot of each position held before it: blocks by positions."""
    at = np.argsort(slots, axis=1, kind="stable")
    at += np.arange(len(slots))[:, None] * slots.shape[1]
    at = at.ravel()
    slot, wanted = slots.ravel().take(at), ranks.ravel().take(at)
    # in order of block, slot and position
    again = np.empty(slots.shape, bool)
    again.ravel()[1:] = slot[1:] == slot[:-1]
    again[:, 0] = False
    again = again.ravel()
    right = again.copy()
    right[1:] &= wanted[1:] == wanted[:-1]
    held = np.zeros(len(at), np.uint16)
    held[1:] = (wanted[:-1] + np.uint16(1)) << np.uint16(2)
    held[1:] += np.uint16(1) + right[:-1]
    held[2:] += right[1:-1] & right[:-2]
    held *= again
    seen = np.empty(len(at), np.uint16)
    seen[at] = held
    return seen.reshape(slots.shape)


def _modelled(ids: np.ndarray, places: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Blocks of one length (blocks by positions; ids below ``places``): their lists of ids, start and size of each interval."""
    lanes, steps = ids.shape
    keys = ids + np.arange(lanes)[:, None] * places
    there = np.zeros(lanes * places, bool)
    there[keys] = True
    listed = np.flatnonzero(there)
    edges = np.searchsorted(listed, np.arange(lanes + 1) * places)
    zero, mixed = _OrderZero(np.diff(edges)), _Outcomes(lanes)
    ranks = np.empty(lanes * places, np.uint16)
    ranks[listed] = zero.rank
    ranks = ranks.take(keys)
    past = np.concatenate([np.zeros((lanes, 2), np.uint16), ranks], axis=1)
    one = _slots_seen(past[:, 1:-1], ranks)
    two = _slots_seen(_hashed(past[:, 1:-1], past[:, :-2]), ranks)
    wanted = ranks + np.uint16(1)
    by_two = two >> np.uint16(2) == wanted
    outcomes = np.where(by_two, np.uint16(1), (one >> np.uint16(2) == wanted) * np.uint16(2))
    states = _states(one, two)
    states[:, 1:] |= outcomes[:, :-1] << np.uint16(5)
    starts, sizes = np.empty((2, steps, lanes), np.uint32)
    lane = np.arange(lanes)[:, None]
    for begin, end in _segments(steps):
        state = states[:, begin:end] * np.int64(lanes) + lane
        outcome = outcomes[:, begin:end]
        none, known = mixed.none.take(state), mixed.known.take(state)
        cells = ranks[:, begin:end] + zero.first[:, None]
        start, size = zero.start.take(cells), zero.size.take(cells)
        start *= none
        size *= none
        hits = np.flatnonzero(outcome)
        first = outcome.ravel().take(hits) == 1
        none, known = none.ravel().take(hits), known.ravel().take(hits)
        start.ravel()[hits] = np.where(first, none, known) << np.uint32(_ROOM_BITS)
        size.ravel()[hits] = np.where(first, known - none, np.uint32(_FULL) - known) << np.uint32(_ROOM_BITS)
        starts[begin:end], sizes[begin:end] = start.T, size.T
        if end < steps:
            state += outcome * np.int64(96 * lanes)
            mixed.adapt(state.ravel())
            zero.add(cells.ravel(), np.full(lanes, end - begin))
    listed -= np.repeat(np.arange(lanes) * places, zero.distinct)
    return np.split(listed, edges[1:-1]), starts, sizes


def _encode_batch(blocks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """List of ids and words of each block; ``blocks`` in order of falling length, none empty."""
    lanes, steps = len(blocks), len(blocks[0])
    lengths = np.array([len(b) for b in blocks])
    starts, sizes = np.empty((2, steps, lanes), np.uint32)
    lists: list[np.ndarray] = []
    places = 1 + max(int(b.max()) for b in blocks)
    while len(lists) < lanes:
        begin, length = len(lists), int(lengths[len(lists)])
        same = int(np.searchsorted(-lengths, -length, side="right"))
        end = min(same, begin + max(1, min(_AT_ONCE // length, 16 * _AT_ONCE // places)))
        found, starts[:length, begin:end], sizes[:length, begin:end] = _modelled(np.stack(blocks[begin:end]).astype(np.int64), places)
        lists += found
    width = steps * int(_WHOLE_BITS) // 32 + 3
    words = np.zeros(lanes * width, np.uint32)
    origin = np.arange(lanes) * width
    at = origin.copy()
    all_low, all_rng = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))

    def carried(to: np.ndarray) -> None:
        while len(to):
            to = to - 1
            words[to] += np.uint32(1)
            to = to[words[to] == 0]

    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    for t, k in enumerate(active.tolist()):
        low, rng = all_low[:k], all_rng[:k]
        unit = rng >> _WHOLE_BITS
        moved = unit * starts[t, :k]
        low += moved
        np.multiply(unit, sizes[t, :k], out=rng)
        over = np.flatnonzero(low < moved)
        if len(over):
            carried(at[over])
        short = np.flatnonzero(rng < _LOW)
        if len(short):
            part, to = low.take(short), at.take(short)
            words[to] = part >> _WORD_BITS
            at[short] = to + 1
            low[short] = part << _WORD_BITS
            rng[short] = rng.take(short) << _WORD_BITS
    # the first multiple of 2**32 that is not below low; readers take zeros beyond the words
    last = all_low + (_LOW - np.uint64(1))
    carried(at[last < all_low])
    words[at] = last >> _WORD_BITS
    return [(ids, words[a:b]) for ids, a, b in zip(lists, origin.tolist(), (at + 1).tolist(), strict=True)]


def _decode_batch(lists: list[np.ndarray], words: list[np.ndarray], lengths: np.ndarray) -> list[np.ndarray]:
    """Ids of each block; blocks in order of falling length, none empty."""
    lanes, steps = len(words), int(lengths[0])
    zero, mixed = _OrderZero(np.array([len(x) for x in lists])), _Outcomes(lanes)
    width = max(map(len, words)) + 2
    stream = np.zeros((lanes, width), np.uint32)
    for i, w in enumerate(words):
        stream[i, :len(w)] = w
    all_code = stream[:, 0].astype(np.uint64) << _WORD_BITS | stream[:, 1]
    stream = stream.ravel()
    at = np.arange(lanes) * width + 2          # where the next word is; the checksum tells of damage
    all_rng = np.full(lanes, ~np.uint64(0))
    # slots of the order-1 contexts of all lanes, one for each cell, then those of order 2
    cells_of_all = len(zero.counts)
    slots = np.zeros(cells_of_all + (lanes << _SLOT_BITS), np.uint16)
    lane, base_two = np.arange(lanes), cells_of_all + (np.arange(lanes) << _SLOT_BITS)
    base_share = np.arange(lanes) << _ROOM_BITS
    ranks = np.zeros((steps + 2, lanes), np.uint16)     # two ranks before the first
    last = np.zeros(lanes, np.uint16)
    one_sure, two_bits, three = np.uint16(1), np.uint16(2), np.uint16(3)
    room_bits, low_half, half = np.uint32(_ROOM_BITS), np.uint32(0xFFFF), np.uint32(16)
    at_slots = np.empty((2, lanes), np.int64)
    cell = zero.first
    came = np.empty((min(_SETUP_STEPS, steps), lanes), np.uint16)     # states and outcomes
    for begin, end in _segments(steps):
        shares = zero.by_share()
        pairs = zero.start | zero.size << half
        active = np.searchsorted(-lengths, -np.arange(begin, end), side="left")
        for t, k in enumerate(active.tolist(), begin):
            where = at_slots if k == lanes else np.empty((2, k), np.int64)
            where[0] = cell[:k]
            np.add(_hashed(ranks[t + 1, :k], ranks[t, :k]), base_two[:k], out=where[1])
            held = slots.take(where)
            state = _states(held[0], held[1])
            state |= last[:k] << np.uint16(5)
            came[t - begin, :k] = state
            state = state * np.int64(lanes)
            state += lane[:k]
            none = mixed.none.take(state, mode="clip")
            code, rng = all_code[:k], all_rng[:k]
            unit = rng >> _WHOLE_BITS
            value = (code // unit).astype(np.uint32)
            hits = np.flatnonzero(value >= none << room_bits)
            # all as if coded by order 0, then the others
            share = (value / none).astype(np.int64)
            share += base_share[:k]
            rank = shares.take(share, mode="clip")
            cell = rank + zero.first[:k]
            pair = pairs.take(cell, mode="clip")
            start, size = pair & low_half, pair >> half
            start *= none
            size *= none
            outcome = np.zeros(k, np.uint16)
            if len(hits):
                known, low = mixed.known.take(state.take(hits)), none.take(hits)
                second = value.take(hits) >= known << room_bits
                outcome[hits] = second + one_sure
                start[hits] = np.where(second, known, low) << room_bits
                size[hits] = np.where(second, np.uint32(_FULL) - known, known - low) << room_bits
                own = (np.where(second, held[0].take(hits), held[1].take(hits)) >> two_bits) - one_sure
                rank[hits] = own
                cell[hits] = zero.first.take(hits) + own
            code -= unit * start
            np.multiply(unit, size, out=rng)
            short = np.flatnonzero(rng < _LOW)
            if len(short):
                to = at.take(short)
                code[short] = code.take(short) << _WORD_BITS | stream.take(to, mode="clip")
                rng[short] = rng.take(short) << _WORD_BITS
                at[short] = to + 1
            wanted = ((rank + one_sure) << two_bits) | one_sure
            surer = np.minimum(held + one_sure, held | three)
            slots[where] = np.where((held ^ wanted) < 4, surer, wanted)
            ranks[t + 2, :k] = rank
            last = outcome
            came[t - begin, :k] += outcome * np.uint16(96)
        if end < steps:
            there = slice(None) if active[-1] == lanes else lane < active[:, None]
            mixed.adapt((came[:end - begin] * np.int64(lanes) + lane)[there].ravel())
            zero.add((ranks[begin + 2:end + 2] + zero.first)[there].ravel(), np.clip(lengths - begin, 0, end - begin))
    ranks = np.ascontiguousarray(ranks[2:].T)
    return [x.take(ranks[i, :n], mode="clip") for i, (x, n) in enumerate(zip(lists, lengths.tolist(), strict=True))]


def _pack_list(ids: np.ndarray) -> bytes:
    """Rising ids by Elias and Fano: the number of their low bits, those, and the others as ones at rising places."""
    low_bits = max(0, int(ids[-1]).bit_length() - len(ids).bit_length())
    high = np.zeros((int(ids[-1]) >> low_bits) + len(ids), np.uint8)
    high[(ids >> low_bits) + np.arange(len(ids))] = 1
    low = (ids[:, None] >> np.arange(low_bits) & 1).astype(np.uint8)
    return bytes([low_bits]) + np.packbits(low).tobytes() + np.packbits(high).tobytes()


def _unpack_list(packed: bytes, n: int) -> np.ndarray:
    low_bits = packed[0]
    end = 1 + (n * low_bits + 7) // 8
    low = np.unpackbits(np.frombuffer(packed[1:end], np.uint8), count=n * low_bits).reshape(n, low_bits)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(packed[end:], np.uint8))) - np.arange(n)
    return (high << low_bits | low @ (1 << np.arange(low_bits))).astype(np.uint32)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The coded form of each block of at most ``LONGEST`` ids, integers from 0 to 2**20 - 1."""
    blocks = [np.asarray(b, np.uint32) for b in blocks]
    if any(len(b) > LONGEST or (len(b) and b.max() >> 20) for b in blocks):
        raise ValueError(f"a block holds at most {LONGEST} ids below 2**20")

    def packed(ids: np.ndarray, listed: int, words: int, body: bytes) -> bytes:
        head = _HEADER.pack(MAGIC, len(ids), listed, words, zlib.crc32(np.ascontiguousarray(ids, "<u4")), 0)[:-4]
        return head + struct.pack("<I", zlib.crc32(body, zlib.crc32(head))) + body

    out = [packed(b, 0, 0, b"") for b in blocks]
    order = sorted((i for i, b in enumerate(blocks) if len(b)), key=lambda i: -len(blocks[i]))
    for begin in range(0, len(order), LANES):
        batch = order[begin:begin + LANES]
        for i, (listed, words) in zip(batch, _encode_batch([blocks[i] for i in batch]), strict=True):
            out[i] = packed(blocks[i], len(listed), len(words), _pack_list(listed) + words.astype("<u4").tobytes())
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; ValueError for a damaged one."""
    heads = []
    for b in coded:
        if len(b) < _HEADER.size or b[:4] != MAGIC:
            raise ValueError("not a block of coded ids")
        head = _HEADER.unpack_from(b)
        if zlib.crc32(b[_HEADER.size:], zlib.crc32(b[:_HEADER.size - 4])) != head[5] or head[1] > LONGEST:
            raise ValueError("a block's bytes don't match its header")
        heads.append(head)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(coded)
    order = sorted((i for i, h in enumerate(heads) if h[1]), key=lambda i: -heads[i][1])
    for begin in range(0, len(order), LANES):
        batch = order[begin:begin + LANES]
        ends = [len(coded[i]) - 4 * heads[i][3] for i in batch]
        words = [np.frombuffer(coded[i], "<u4", offset=end) for i, end in zip(batch, ends, strict=True)]
        lists = [_unpack_list(coded[i][_HEADER.size:end], heads[i][2]) for i, end in zip(batch, ends, strict=True)]
        try:
            decoded = _decode_batch(lists, words, np.array([heads[i][1] for i in batch]))
        except IndexError as e:       # a rank beyond the list
            raise ValueError("a block's words don't match its ids") from e
        for i, ids in zip(batch, decoded, strict=True):
            out[i] = ids
    for ids, head in zip(out, heads, strict=True):
        if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != head[4]:
            raise ValueError("a block's ids don't match their checksum")
    return out
