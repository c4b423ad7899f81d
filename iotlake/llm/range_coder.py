"""Token-id files: ids of all documents in ascending doc_id order, range-coded in independent blocks.

A block holds up to `block` ids, may begin and end inside a document, and can be decoded alone: its model starts fresh. An id
is coded as one symbol. Three adaptive distributions are looked up, by nothing (order 0), by the id before (order 1), and by the two ids
before (order 2), and mixed by weights that follow how well each has done in the block at its present confidence; the mixed
distribution drives a range coder. Order 0 and the weights follow the block at given positions, orders 1 and 2 at every id. All of it is
integer arithmetic, so a block decodes alike on every machine. Blocks are coded in step, one numpy lane each.

A block is the bytes

    "IDB2", crc32 of all that follows, n_ids, crc32 of the ids (4 bytes each, little-endian), n_pieces, payload size, slots   4 bytes each
    index of the first id within its part, number of the first piece's document within the part                        8 bytes each
    per piece (the ids of one document in this block): doc_id (8 bytes), n (4), flags (1: goes on from the block before, 2: null doc_id)
    payload

and a file set is a Parquet table (part, seq, block), which Spark's writer commits as a whole: parts ascend by doc_id, blocks by seq.

Defined results: a null or empty text is the end id alone; rows that repeat a doc_id are documents of their own, ordered by text;
rows without doc_id come first; an empty table gives no block; texts of any length are encoded whole, over several blocks. Ids are below
65536, others are refused when they are written. Other columns are ignored.
"""

from __future__ import annotations

import os
import struct
from dataclasses import dataclass
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iotlake.llm.tables import give_back, plain, stored, prepare

MAGIC = b"IDB2"
_HEAD = struct.Struct("<4s6I2Q")
#: Texts' parts kept at hand with their ids.
MEMO = 600_000


@dataclass(frozen=True)
class Shape:
    #: Ids of a block.
    block: int = 4_096
    #: Blocks coded in step; a quarter more at the end of a part, as a few take almost as long.
    lanes: int = 1_536
    #: Contexts of order 1, and of order 2, a power of two.
    slots: int = 1 << 11


# Model

#: Masses are parts of _ALL, of which every id held by order 0 has one at least.
_SHARE = 24
_ALL = 1 << _SHARE
_SPLIT = _ALL - (1 << 16)
#: Bits of an id in `Mixer.known`, which holds each id with the two before. Nothing comes after _NEVER.
_FIELD = 20
_LOW = (1 << _FIELD) - 1
_PLACE = np.uint32(0xFFFF)
_NEVER = (_LOW << 2 * _FIELD) | (_LOW << _FIELD)
#: What orders 2 and 1 know (0: nothing, else 1 and the hits in a row, three at most) and whether both say the same: 10 * two + 2 * one + same.
_KINDS = 50
_TWO, _ONE = np.arange(_KINDS) // 10, np.arange(_KINDS) // 2 % 5
_SAME = np.arange(_KINDS) % 2 == 1


def _first_counts() -> np.ndarray:
    """By kind, in 64ths: how often of two trials the id comes from order 0, 1, 2, or is new, before anything is known."""
    hits = np.array([0, 16, 36, 48, 60])
    two = np.where(_SAME, np.maximum(hits[_TWO], hits[_ONE]), hits[_TWO])
    one = np.where(_SAME, 0, np.where(_TWO > 0, (64 - two) * hits[_ONE] // 128, hits[_ONE]))
    new = 64 - two - one
    return np.stack([new, 2 * one, 2 * two, new], axis=1)


def _new_ids() -> np.ndarray:
    """Cumulative masses of new ids: vocabularies are in order of merges, so the smaller the likelier."""
    sizes = (1 << 34) // (np.arange(1 << 16, dtype=np.int64) + 700)
    sizes = sizes * (_ALL - (1 << 16)) // sizes.sum() + 1
    sizes[0] += _ALL - sizes.sum()
    return np.concatenate([[0], np.cumsum(sizes)])


_FIRST, _NEW = _first_counts(), _new_ids()


def _looks(longest: int) -> list[int]:
    """Positions at which the model looks back on the block so far."""
    found, at = [0], 8
    while at < min(longest, 1 << 16):
        found.append(at)
        at += max(at // 2, 8)
    return found


class Mixer:
    """The mixed distribution of each lane's next id.

    Order 0 is the ids up to the last look back, each as often as it was there. Orders 1 and 2 say the id that last followed the same one or two
    ids. Their masses are those shares of right answers that the block had so far, up to the last look back, where as much was known.
    The mass of _ALL lies thus: the ids of order 0 ascending, before each what another order adds to it, then ids that none of them holds.
    """

    def __init__(self, lanes: int, longest: int, slots: int, said: np.ndarray | None = None):
        self.slots, self.row, self.looks = slots, longest + 1, _looks(longest)
        self.wide = self.looks[-1] + 1
        lane = np.arange(lanes, dtype=np.int64)
        self.lane, self.rows, self.kinds, self.bases, self.places = lane, lane * self.row, lane * _KINDS, lane * slots, lane * self.wide
        self.known = np.full(lanes * self.row, _NEVER, np.int64)
        #: First and end place of each known id in order 0, 16 bits each; that of what is never known is empty.
        self.spans = np.zeros(lanes * self.row, np.uint32)
        self.said = np.zeros((longest, lanes), np.uint16) if said is None else said
        self.held = np.zeros((lanes, self.wide), np.uint16)
        self.held_spans = np.zeros((lanes, self.wide), np.uint32)
        self.last = [np.zeros(lanes * slots, np.int64) for _ in range(2)]
        self.notes = np.zeros((longest, lanes), np.uint8)
        self.counts = np.zeros((lanes, 4 * _KINDS), np.int64)
        self.masses = np.zeros((3, lanes * _KINDS), np.uint32)
        self.before = np.zeros(lanes, np.int64)  # the id before, and above it the one before that
        self.size = 0
        self.numbers = np.arange(self.wide, dtype=np.uint32)
        self.table = np.zeros(1 << 16, np.uint32)

    def look_back(self, n: int, at: int) -> None:
        """Takes what the first n lanes had up to position `at`."""
        some = max(1, (1 << 15) // max(at, 1))
        for k in range(0, n if at else 0, some):
            group = slice(k, min(k + some, n))
            m = group.stop - k
            notes = self.notes[self.size:at, group] + self.lane[:m] * (4 * _KINDS)
            self.counts[group] += np.bincount(notes.ravel(), minlength=m * 4 * _KINDS).reshape(m, -1)
            order = self.said[:at, group].T.astype(np.uint32, order="C")
            order <<= 16
            order |= self.numbers[:at]
            order.sort(axis=1)
            ids = (order >> 16).astype(np.uint16)
            first = np.ones((m, at), bool)
            np.not_equal(ids[:, 1:], ids[:, :-1], out=first[:, 1:])
            starts = np.flatnonzero(first)
            sizes = np.diff(starts, append=m * at)
            starts %= at
            spans = np.repeat((starts | starts + sizes << 16).astype(np.uint32), sizes).reshape(m, at)
            self.held[group, :at], self.held_spans[group, :at] = ids, spans
            order &= 0xFFFF
            self.spans[order + (self.rows[group, None] + 1)] = spans
        self.size = at
        counts = self.counts[:n].reshape(n, _KINDS, 4)
        counts = counts * 64 + _FIRST
        total = counts.sum(axis=2) + 64
        one, two, new = (_SPLIT * counts[:, :, i] // total for i in (1, 2, 3))
        each = np.maximum((_ALL - one - two - new) // max(at, 1), 1)
        for i, mass in enumerate((np.where(_SAME | (_ONE == 0), 0, one), np.where(_TWO == 0, 0, two), each)):
            self.masses[i, :n * _KINDS] = mass.ravel()

    def look_up(self, k: int, ids: np.ndarray) -> np.ndarray:
        """Spans of ids in lane k's order 0."""
        self.table.fill(self.size * 0x10001)
        self.table[self.held[k, :self.size]] = self.held_spans[k, :self.size]
        return self.table.take(ids)

    def distribution(self, n: int) -> None:
        """What is known of the next id of the first n lanes."""
        row, base, before = self.rows[:n], self.bases[:n], self.before[:n]
        prior = before & _LOW
        slot1 = prior * 0x9E3779B1
        slot1 >>= 13
        slot1 &= self.slots - 1
        slot1 += base
        slot2 = before >> 13
        slot2 ^= before
        slot2 &= 0xFFFFFFFF
        slot2 *= 0x45EBCA6B
        slot2 >>= 17
        slot2 &= self.slots - 1
        slot2 += base
        last1, last2 = self.last[0].take(slot1), self.last[1].take(slot2)
        at1, at2 = last1 >> 2, last2 >> 2
        then1, then2 = self.known.take(row + at1), self.known.take(row + at2)
        id1, id2 = then1 & _LOW, then2 & _LOW
        then1 >>= _FIELD
        then2 >>= _FIELD
        then1 &= _LOW
        ok1, ok2 = then1 == prior, then2 == before
        same = id1 == id2
        same &= ok1
        same &= ok2
        last1 &= 3
        last2 &= 3
        last1 += 1
        last2 += 1
        last1 *= ok1
        last2 *= ok2
        kind = last2 * 10 + last1 * 2 + same
        w1, w2, each = self.masses.take(self.kinds[:n] + kind, axis=1)
        at1 *= ok1 > same
        at2 *= ok2
        span1, span2 = self.spans.take(row + at1), self.spans.take(row + at2)
        a1, a2 = span1 & _PLACE, span2 & _PLACE
        self.x1, self.x2 = a1 * each, a2 * each
        self.x1 += w2 * (a2 < a1)
        self.x2 += w1 * (a1 <= a2)
        self.s1, self.s2 = span1 >> 16, span2 >> 16
        for s, a, w in ((self.s1, a1, w1), (self.s2, a2, w2)):
            s -= a
            s *= each
            s += w
        self.edge = each * np.uint32(self.size) + w1 + w2
        self.w1, self.w2, self.each, self.a1, self.a2, self.id1, self.id2 = w1, w2, each, a1, a2, id1, id2
        self.at = slot1, slot2, last1, last2, kind, span1, span2

    def find(self, ids: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and size of the mass of each lane's id."""
        self.is1, self.is2 = (self.s1 > 0) & (self.id1 == ids), (self.s2 > 0) & (self.id2 == ids)
        a = span & _PLACE
        size = span >> 16
        size -= a
        size *= self.each
        first = a * self.each
        first += self.w1 * (self.a1 < a)
        first += self.w2 * (self.a2 < a)
        first, size = self._told(first, size)
        self.new = size == 0
        return self._or_new(first, size)

    def _told(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for hit, x, s in ((self.is1, self.x1, self.s1), (self.is2, self.x2, self.s2)):
            np.copyto(first, x, where=hit)
            np.copyto(size, s, where=hit)
        return first, size

    def _or_new(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        np.copyto(first, self.edge, where=self.new)
        np.copyto(size, np.uint32(_ALL) - self.edge, where=self.new)
        return first, size

    def at_mass(self, value: np.ndarray) -> tuple[np.ndarray, ...]:
        """The id at a mass (any, where it is new), its span, and first and size of its mass."""
        n = len(value)
        past1, past2 = value >= self.x1, value >= self.x2
        self.is1, self.is2 = past1 & (value < self.x1 + self.s1), past2 & (value < self.x2 + self.s2)
        self.new = value >= self.edge
        self.new &= ~(self.is1 | self.is2)
        more = self.w1 * past1
        more += self.w2 * past2
        place = value - more  # meaningless where another order has the id, as the span is then
        place //= self.each
        np.minimum(place, np.uint32(self.size), out=place)
        at = self.places[:n] + place
        ids, span = self.held.ravel().take(at).astype(np.int64), self.held_spans.ravel().take(at)
        a = span & _PLACE
        first = a * self.each
        first += more
        size = span >> 16
        size -= a
        size *= self.each
        first, size = self._or_new(*self._told(first, size))
        for hit, i, s in ((self.is1, self.id1, self.at[5]), (self.is2, self.id2, self.at[6])):
            np.copyto(ids, i, where=hit)
            np.copyto(span, s, where=hit)
        np.copyto(span, np.uint32(self.size * 0x10001), where=self.new)
        return ids, span, first, size

    def update(self, t: int, ids: np.ndarray) -> None:
        n = len(ids)
        slot1, slot2, state1, state2, kind, _, _ = self.at
        for last, slot, state, said in ((self.last[0], slot1, state1, self.id1), (self.last[1], slot2, state2, self.id2)):
            now = np.minimum(state, 3)
            now *= said == ids
            now += 4 * (t + 1)
            last[slot] = now
        note = kind * 4
        note += np.where(self.is2, 2, np.where(self.is1, 1, self.new * 3))
        self.notes[t, :n] = note
        before = self.before[:n]
        before <<= _FIELD
        before |= ids
        self.known[self.rows[:n] + (t + 1)] = before
        before &= (1 << 2 * _FIELD) - 1


# Range coder

_WORD, _ROOM, _UNITS = np.uint64(32), np.uint64(1 << 32), np.uint64(_SHARE)


def _laid_out(sizes: list[int]) -> tuple[list[int], np.ndarray, int, int]:
    """The lanes' blocks, longest first, their sizes, number and greatest size."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    ordered = np.array([sizes[i] for i in order], np.int64)
    return order, ordered, len(order), int(ordered[0]) if len(order) else 0


def _active(sizes: np.ndarray, longest: int) -> list[int]:
    """The number of lanes that go on at each position."""
    return np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()


def encode_blocks(blocks: list[np.ndarray], slots: int) -> list[bytes]:
    """Payload of each block of ids (below 65536; others are refused)."""
    wide = [int(b.max()) for b in blocks if len(b) and (b.max() >> 16 or b.min() < 0)]
    if wide:
        raise ValueError(f"ids have 16 bits, not {max(wide)}")
    order, sizes, lanes, longest = _laid_out([len(b) for b in blocks])
    steps = np.zeros((longest, lanes), np.uint16)
    for at in range(0, lanes, 64):  # by columns of some blocks, as memory is in rows
        some = np.zeros((min(64, lanes - at), longest), np.uint16)
        for row, i in zip(some, order[at:at + 64], strict=True):
            row[: len(blocks[i])] = blocks[i]
        steps[:, at:at + 64] = some.T
    mixer = Mixer(lanes, longest, slots, steps)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    # Words of 32 bits; what is beyond is carried to the one before at the end.
    out, put = np.zeros((lanes, longest // 3 + 8), np.uint64), np.zeros(lanes, np.int64)
    lane = mixer.lane

    def code(some, first, size):
        nonlocal out
        step = width[some] >> _UNITS
        was = low[some]
        now = was + step * first.astype(np.uint64)
        over = np.flatnonzero(now < was)
        if len(over):
            over = lane[some][over]
            out[over, put[over] - 1] += np.uint64(1)
        low[some] = now
        step *= size.astype(np.uint64)
        width[some] = step
        go = np.flatnonzero(step < _ROOM)
        if len(go):
            go = lane[some][go]
            if put[go].max() + 3 >= out.shape[1]:
                out = np.concatenate([out, np.zeros((lanes, out.shape[1]), np.uint64)], axis=1)
            out[go, put[go]] += low[go] >> _WORD
            put[go] += 1
            low[go] <<= _WORD
            width[go] <<= _WORD

    looks = {at: end for at, end in zip(mixer.looks, [*mixer.looks[1:], longest], strict=True)}
    spans = mixer.spans.reshape(lanes, longest + 1)
    for t, n in enumerate(_active(sizes, longest)):
        if t in looks:
            mixer.look_back(n, t)
            for at in range(0, n, 64):
                some = np.ascontiguousarray(steps[t: looks[t], at:min(at + 64, n)].T)
                for k, row in enumerate(some, at):
                    spans[k, t + 1: looks[t] + 1] = mixer.look_up(k, row)
        now = steps[t, :n].astype(np.int64)
        mixer.distribution(n)
        first, size = mixer.find(now, spans[:n, t + 1])
        code(slice(0, n), first, size)
        new = np.flatnonzero(mixer.new)
        if len(new):
            which = now[new]
            code(new, _NEW[which], _NEW[which + 1] - _NEW[which])
        mixer.update(t, now)
    for _ in range(2):
        out[lane, put] += low >> _WORD
        put += 1
        low <<= _WORD
    while (out >> _WORD).any():
        over = out[:, 1:] >> _WORD
        out &= _ROOM - np.uint64(1)
        out[:, :-1] += over
    found: list[bytes] = [b""] * lanes
    for k, i in enumerate(order):
        found[i] = out[k, : put[k]].astype(">u4").tobytes()
    return found


def decode_blocks(payloads: list[bytes], counts: list[int], slots: int) -> list[np.ndarray]:
    """The ids of each block."""
    order, sizes, lanes, longest = _laid_out(counts)
    data = np.zeros((lanes, max(map(len, payloads), default=0) // 4 + 4), np.uint32)
    for k, i in enumerate(order):
        words = np.frombuffer(payloads[i], ">u4", len(payloads[i]) // 4)
        data[k, : len(words)] = words
    mixer = Mixer(lanes, longest, slots)
    width, got = np.full(lanes, ~np.uint64(0)), np.full(lanes, 2)
    code = data[:, 0].astype(np.uint64) << _WORD | data[:, 1]
    lane, looks = mixer.lane, set(mixer.looks)

    def values(some):
        step = width[some] >> _UNITS
        return step, (code[some] // step).astype(np.uint32)

    def take(some, step, first, size):
        code[some] -= step * first.astype(np.uint64)
        step = step * size.astype(np.uint64)
        width[some] = step
        go = np.flatnonzero(step < _ROOM)
        if len(go):
            go = lane[some][go]
            code[go] = code[go] << _WORD | data[go, got[go]]
            got[go] += 1
            width[go] <<= _WORD

    spans = mixer.spans.reshape(lanes, longest + 1)
    for t, n in enumerate(_active(sizes, longest)):
        if t in looks:
            mixer.look_back(n, t)
        mixer.distribution(n)
        some = slice(0, n)
        step, value = values(some)
        ids, span, first, size = mixer.at_mass(value)
        take(some, step, first, size)
        new = np.flatnonzero(mixer.new)
        if len(new):
            step, value = values(new)
            which = np.searchsorted(_NEW, value, side="right") - 1
            take(new, step, _NEW[which], _NEW[which + 1] - _NEW[which])
            ids[new] = which
        spans[:n, t + 1] = span
        mixer.said[t, :n] = ids
        mixer.update(t, ids)
    said = np.ascontiguousarray(mixer.said.T)
    found: list[np.ndarray] = [np.zeros(0, np.uint32)] * lanes
    for k, i in enumerate(order):
        found[i] = said[k, : sizes[k]].astype(np.uint32)
    return found


# Blocks

@dataclass
class Piece:
    """Some of a document's ids, within one block."""

    doc_id: int | None
    n: int
    goes_on: bool


def pack(ids: np.ndarray, payload: bytes, pieces: list[Piece], first: int, number: int, slots: int) -> bytes:
    rest = b"".join((
        np.array([p.doc_id or 0 for p in pieces], "<i8").tobytes(), np.array([p.n for p in pieces], "<u4").tobytes(),
        np.array([p.goes_on + 2 * (p.doc_id is None) for p in pieces], np.uint8).tobytes(), payload))
    head = _HEAD.pack(MAGIC, 0, len(ids), crc32(ids.astype("<u4").tobytes()), len(pieces), len(payload), slots, first, number)
    return MAGIC + struct.pack("<I", crc32(head[8:] + rest)) + head[8:] + rest


def unpack(block: bytes) -> tuple[bytes, int, int, list[Piece], int, int, int]:
    """Payload, n_ids, the ids' crc32, pieces, slots, first index and first document number. ValueError for a damaged block."""
    if len(block) < _HEAD.size or block[:4] != MAGIC:
        raise ValueError("not a block of ids")
    _, check, n_ids, ids_crc, n, size, slots, first, number = _HEAD.unpack_from(block)
    if crc32(block[8:]) != check:
        raise ValueError("damaged block of ids")
    at = _HEAD.size
    names = np.frombuffer(block, "<i8", n, at)
    counts = np.frombuffer(block, "<u4", n, at + 8 * n)
    flags = np.frombuffer(block, np.uint8, n, at + 12 * n)
    pieces = [Piece(None if f & 2 else int(d), int(c), bool(f & 1)) for d, c, f in zip(names, counts, flags, strict=True)]
    return block[at + 13 * n: at + 13 * n + size], n_ids, ids_crc, pieces, slots, first, number


class BlockWriter:
    """Cuts the documents of a part into blocks and codes them many at a time."""

    def __init__(self, shape: Shape):
        self.shape = shape
        self.ids: list[np.ndarray] = []
        self.held, self.pieces, self.first, self.docs, self.seq = 0, [], 0, 0, 0
        self.number = 0
        self.waiting: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray):
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.shape.block - self.held)
            if not self.pieces:
                self.number = self.docs
            self.ids.append(ids[at:at + n])
            self.pieces.append(Piece(doc_id, n, at > 0))
            self.held += n
            at += n
            if self.held == self.shape.block:
                self._close()
                if 4 * len(self.waiting) > 5 * self.shape.lanes:
                    yield from self.flush(self.shape.lanes)
        self.docs += 1

    def _close(self) -> None:
        if self.held:
            self.waiting.append((np.concatenate(self.ids), self.pieces, self.first, self.number))
            self.first += self.held
            self.ids, self.held, self.pieces = [], 0, []

    def flush(self, n: int):
        """(seq, block) of the first n that wait."""
        some, self.waiting = self.waiting[:n], self.waiting[n:]
        payloads = encode_blocks([w[0] for w in some], self.shape.slots)
        for (ids, pieces, first, number), payload in zip(some, payloads, strict=True):
            yield self.seq, pack(ids, payload, pieces, first, number, self.shape.slots)
            self.seq += 1

    def end(self):
        self._close()
        if self.waiting:
            yield from self.flush(len(self.waiting))


# Tokens

#: How byte-level tokenizers split a text before they merge.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: By BYTE_LEVEL a part begins where one of _OTHER follows an ASCII letter, where white space follows another ASCII character, behind a
#: line's end alone between these, and at a space that what is surely no white space follows (which is known by its first byte), so that
#: texts may be cut there.
_LETTER, _OTHER, _SOLID, _BLANK = (np.zeros(256, bool) for _ in range(4))
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_OTHER[:0x80] = ~_LETTER[:0x80]
_SOLID[0x21:0x7F] = True
_SOLID[[b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3)]] = True
#: Bytes of a cut kept at hand.
_SHORT = 64


def _lengthened(values: np.ndarray, more: np.ndarray, size: int) -> np.ndarray:
    """`more` behind the first `size` of values, in an array that has room to grow."""
    if size + len(more) > len(values):
        values = np.concatenate([values[:size], np.zeros(size + 2 * len(more) + 1024, values.dtype)])
    values[size:size + len(more)] = more
    return values


class Tokens:
    """Ids of texts by the tokenizers library. What the tokenizer treats alone is cut out, encoded once and kept."""

    def __init__(self, path: str, pattern: str | None):
        import regex
        from tokenizers import Tokenizer

        # As the library encodes: the string of a special token in a text is that token.
        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        added = sorted((t.content for t in tokens), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.parts = regex.compile(pattern) if pattern else None
        self.whole = [t.content.encode() for t in tokens]
        self.bytewise = pattern == BYTE_LEVEL and not any(t.lstrip or t.rstrip or t.single_word for t in tokens)
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids, self.starts, self.n = np.zeros(1024, np.int32), np.zeros(1024, np.int64), 0

    def of(self, texts: list[str]) -> list[np.ndarray]:
        return self.of_column(pa.array(texts, pa.string()))

    def of_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column."""
        if not self.parts:
            return [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        if self.bytewise:
            pieces, firsts = _cut(texts, self.whole)
        else:
            split = [self._split(t) for t in texts.to_pylist()]
            pieces = pa.array([p for parts in split for p in parts], pa.string())
            firsts = np.cumsum([0, *map(len, split)])
        found = pieces.dictionary_encode()
        ids, starts = self._known(found.dictionary.to_pylist())
        which = found.indices.to_numpy()
        begins, sizes = starts[0].take(which), starts[1].take(which)
        ends = np.cumsum(sizes)
        begins -= ends - sizes
        out = ids.take(np.repeat(begins, sizes) + np.arange(len(which) and ends[-1]))
        bounds = np.concatenate([[0], ends]).take(firsts)
        return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _known(self, pieces: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """An array of ids, and where in it each piece's begin and how many there are."""
        memo = self.memo
        rows = [memo.get(p, -1) for p in pieces]
        new = [k for k, r in enumerate(rows) if r < 0]
        if len(memo) >= MEMO and 2 * len(new) > len(pieces):  # other texts than those it was filled from
            self.forget()
            return self._known(pieces)
        long = []
        for at in range(0, len(new), 4096):
            some = new[at:at + 4096]
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[k] for k in some], add_special_tokens=False)]
            short = [j for j, k in enumerate(some) if len(pieces[k]) <= _SHORT] if len(memo) < MEMO else []
            once = set(range(len(some))) - set(short)
            long += [(some[j], encoded[j]) for j in sorted(once)]
            sizes = np.array([len(encoded[j]) for j in short], np.int64)
            self.ids = _lengthened(self.ids, np.array([i for j in short for i in encoded[j]], np.int32), self.n)
            self.starts = _lengthened(self.starts, np.append(self.n + np.cumsum(sizes) - sizes, self.n + sizes.sum()), len(memo))
            self.n += int(sizes.sum())
            for j in short:
                rows[some[j]] = memo[pieces[some[j]]] = len(memo)
        where = np.array(rows, np.int64)
        begins = self.starts.take(np.maximum(where, 0))
        sizes = self.starts.take(np.maximum(where, 0) + 1) - begins
        if not long:
            return self.ids, (begins, sizes)
        lengths = np.array([len(i) for _, i in long], np.int64)
        which = [k for k, _ in long]
        begins[which], sizes[which] = self.n + np.cumsum(lengths) - lengths, lengths
        return np.concatenate([self.ids[:self.n], *(np.array(i, np.int32) for _, i in long)]), (begins, sizes)

    def _split(self, text: str) -> list[str]:
        if not self.special or not self.special.search(text):
            return self.parts.findall(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += self.parts.findall(text[at:found.start()])
            out.append(found[0])
            at = found.end()
        return out + self.parts.findall(text[at:])


def _cut(texts: pa.Array, whole: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The texts cut where BYTE_LEVEL surely begins a part, but not within the strings of `whole`, and the number of each text's first
    piece (and of all pieces).
    """
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, width)[texts.offset: texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, width)
    begin, end = int(bounds[0]), int(bounds[-1])
    held = np.frombuffer(data, np.uint8)[begin:end] if end > begin else np.zeros(0, np.uint8)
    cut = np.zeros(len(held) + 1, bool)
    cut[:-2] = held[:-1] == 0x20
    cut[:-2] &= _SOLID[held[1:]]
    cut[1:-1] |= _LETTER[held[:-1]] & _OTHER[held[1:]]
    blank = _BLANK[held[1:]]
    blank &= _SOLID[held[:-1]] & (held[:-1] < 0x80)
    cut[1:-1] |= blank
    if len(held) > 2:  # behind a line's end alone
        cut[2:-1] |= blank[:-1] & (held[1:-1] == 0x0A) & _SOLID[held[2:]] & (held[2:] < 0x80)
    raw = held.tobytes() if whole else b""
    for string in whole:
        at = raw.find(string)
        while at >= 0:
            cut[at + 1: at + len(string)] = False
            at = raw.find(string, at + 1)
    own = bounds - begin
    cut[own] = False  # those of texts are put in by themselves, as often as texts begin there
    cuts = np.flatnonzero(cut)
    at = np.searchsorted(cuts, own)
    offsets = np.insert(cuts, at, own).astype(width)
    firsts = at + np.arange(len(own))
    return pa.Array.from_buffers(texts.type, len(offsets) - 1, [None, pa.py_buffer(offsets + width(begin)), data]), firsts


@cache
def tokens(path: str, pattern: str | None) -> Tokens:
    return Tokens(path, pattern)


def write_ids(
    docs: DataFrame, path: str, end_id: int, pattern: str | None = None, partitions: int | None = None, shape: Shape = Shape(),
) -> DataFrame:
    """Writes the ids of `docs` (doc_id, text) and returns the file set: part, seq, block.

    `path` names the tokenizer file on every machine. `pattern`, if given, is its own splitting pattern, by which texts are cut before
    the tokenizer sees them.
    """
    prepare(docs.sparkSession)
    rows = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(*([partitions] if partitions else []), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks keep the cores busy
        made = tokens(path, pattern)
        writer, part = BlockWriter(shape), None

        def rows_of(found):
            found = list(found)
            for at in range(0, len(found), 64):
                some = found[at:at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(some), pa.int32()), pa.array([s for s, _ in some], pa.int64()),
                     pa.array([b for _, b in some], pa.binary())], names=["part", "seq", "block"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                part = some.column(2)[0].as_py()
                for doc_id, ids in zip(some.column(0).to_pylist(), made.of_column(some.column(1)), strict=True):
                    yield from rows_of(writer.add(doc_id, np.append(ids, ids.dtype.type(end_id))))
        if part is not None:
            yield from rows_of(writer.end())
        give_back()

    return stored(ordered.mapInArrow(run, "part int, seq long, block binary"), "token-ids")


# Reading

@cache
def _zeros(power: int) -> tuple[int, ...]:
    """What 2^power zero bytes do to each bit of a crc32."""
    if power == 0:
        one = [0xEDB88320, *(1 << i for i in range(31))]
        for _ in range(3):
            one = [_apply(one, x) for x in one]
        return tuple(one)
    half = _zeros(power - 1)
    return tuple(_apply(half, x) for x in half)


def _apply(matrix, x: int) -> int:
    out, i = 0, 0
    while x:
        if x & 1:
            out ^= matrix[i]
        x >>= 1
        i += 1
    return out


def joined_crc(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings one after the other, from that of each and the second's size."""
    power = 0
    while size:
        if size & 1:
            first = _apply(_zeros(power), first)
        size >>= 1
        power += 1
    return first ^ second


def read_pieces(files: DataFrame, lanes: int = Shape.lanes) -> DataFrame:
    """part, number, seq, doc_id, first, n and crc of every piece, from decoded and checked blocks. ids are in `ids`."""
    prepare(files.sparkSession)
    names = ["part", "number", "seq", "doc_id", "first", "n", "crc", "ids"]

    def run(batches):
        waiting = []

        def flush(n):
            some, waiting[:] = waiting[:n], waiting[n:]
            heads = [unpack(b) for _, _, b in some]
            decoded: list = [None] * len(heads)
            for slots in {h[4] for h in heads}:
                alike = [i for i, h in enumerate(heads) if h[4] == slots]
                for i, ids in zip(alike, decode_blocks([heads[i][0] for i in alike], [heads[i][1] for i in alike], slots), strict=True):
                    decoded[i] = ids
            for (part, seq, _), (_, n_ids, ids_crc, pieces, _, first, number), ids in zip(some, heads, decoded, strict=True):
                data = ids.astype("<u4").tobytes()
                if len(ids) != n_ids or crc32(data) != ids_crc:
                    raise ValueError("block of ids decoded to something else")
                out, at = [], 0
                for k, p in enumerate(pieces):
                    own = data[4 * at: 4 * (at + p.n)]
                    out.append((part, number + k, seq, p.doc_id, first + at, p.n, crc32(own), own))
                    at += p.n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append(row)
                if 4 * len(waiting) > 5 * lanes:
                    yield from flush(lanes)
        if waiting:
            yield from flush(len(waiting))
        give_back()

    return files.select("part", "seq", "block").mapInArrow(
        run, "part int, number long, seq long, doc_id long, first long, n long, crc long, ids binary")


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a file set, in its order of ids."""
    pieces = stored(read_pieces(files).drop("ids"), "token-pieces")
    # A number per part reaches the driver.
    sizes = pieces.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r.part, total))
        total += r.n
    shift = files.sparkSession.createDataFrame(starts, "part int, shift long")
    docs = pieces.groupBy("part", "number").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("seq", "n", "crc"))).alias("pieces"))
    return docs.join(F.broadcast(shift), "part").select(
        "doc_id", (F.col("first") + F.col("shift")).alias("start"), "n_tokens",
        F.when(F.size("pieces") == 1, F.col("pieces")[0]["crc"]).otherwise(_whole_crc(
            F.when(F.size("pieces") > 1, F.col("pieces")))).alias("ids_crc32"))


def _whole_crc(pieces: Column) -> Column:
    @F.udf("long", useArrow=True)
    def join(rows):
        if not rows:
            return None
        total = rows[0]["crc"]
        for r in rows[1:]:
            total = joined_crc(total, r["crc"], 4 * r["n"])
        return total

    return join(pieces)
