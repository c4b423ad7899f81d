"""SentencePiece encoding as a max-plus scan, and decoding.

A text is encoded as the best-scoring sequence of the vocabulary's pieces (unigram segmentation over the model file's
scores, ties to the longer last piece). A code point that no piece is becomes its UTF-8 byte pieces. Spaces are
written as U+2581, one is put in front, and a U+2581 of the text itself is written as bytes, so that decoding gives
every text back exactly.

A text of more than `chunk` code points is cut into chunks, which Spark spreads over the cluster. Pieces are at most
L code points long, so a chunk can be entered at offsets 0 to L - 1 and left 0 to L - 1 beyond its end.

1. Each chunk yields its transfer matrix: the best score from each entry to each exit, in the (max, +) algebra.
2. An associative scan of the matrices gives each chunk the best score of reaching each of its entries.
3. From these each chunk finds, for each exit, the pieces and the entry that lead there: a map from exits to entries.
4. A scan of the maps from the end of the text tells each chunk its exit, and its pieces follow on their own.

Both scans go in blocks of `block` chunks, then of `block` blocks, and so on: no task holds a whole document's chunks.
Scores are integers, and a chunk's ties are decided from the true scores of its entries, so the result is that of one
pass over the whole text, whatever the chunk size.

Where no piece crosses from a non-space to a space, which holds for the usual vocabularies and is checked, words (and runs of
punctuation, if no piece mixes the two) are encoded once per task and kept in a bounded table, and a matrix is the outer sum of the ways to the first such
place, the words between, and the ways from the last one.

The model in use was trained for merges and not as a unigram model: its scores are merge ranks, so the ids
are a valid encoding of the text by its pieces, but not the one that its merges give.

Defined results: a null or empty text has no ids and decodes to empty; repeated rows are encoded each; a null
doc_id is kept; an empty table has no rows; texts of any length are encoded whole. Other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iotlake.llm.tables import give_back, kept, list_array, map_texts, plain, stored

SPACE = "\u2581"
#: Stands for a U+2581 of the text while it is encoded; no text has a lone surrogate.
OWN = "\ud800"
#: Below any sum of scores.
LOW = -(1 << 60)
MEMO = 150_000
#: Stands between stretches that are looked through together; no piece has it.
PART = "\0"
#: Code points that are looked through together.
LOOK = 1 << 16
#: Ids that are decoded together; a row of more is decoded on its own.
DECODED = 1 << 18
#: Texts whose chunks one group of a scan takes.
KEYS = 64


@dataclass(frozen=True)
class Shape:
    #: Code points of a chunk; at least the longest piece.
    chunk: int = 16_384
    #: Chunks, or blocks, that one step of a scan takes together.
    block: int = 64


class Vocabulary:
    """Pieces and integer scores of a SentencePiece model file."""

    def __init__(self, path: str, scale: int = 1):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.bytes = [0] * 256
        self.ids, self.scores = {}, {}
        #: What each id decodes to.
        self.content = _contents(model)
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.bytes[int(name[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[name], self.scores[name] = i, round(model.get_score(i) * scale)
        #: Score of each piece, None of what only begins one.
        self.tree: dict[str, int | None] = {}
        for name in self.ids:
            for k in range(1, len(name)):
                self.tree.setdefault(name[:k])
            self.tree[name] = self.scores[name]
        self.longest = max(map(len, self.ids))
        self.unknown = min(self.scores.values()) - 10 * scale
        #: Whether every place before a run of spaces, and after anything else, is one that no piece crosses.
        self.cuttable = not any(re.search(f"[^{SPACE}]{SPACE}", name) for name in self.ids)
        self.classes = self._classes()
        self.lengths, self.gains = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for name, i in self.ids.items():
            self.lengths[i], self.gains[i] = len(name), self.scores[name]
        #: A code point's bytes score once, by the first of them.
        self.gains[[i for b, i in enumerate(self.bytes) if not 0x80 <= b < 0xC0]] = self.unknown
        self._nodes()
        self.single = {name for name in self.ids if len(name) == 1}
        #: What no piece holds, if every code point of a piece is one itself: stretches may be cut there.
        self.foreign = re.compile("([^" + "".join(map(re.escape, sorted(self.single))) + "])") \
            if self.single.issuperset(chain.from_iterable(self.ids)) else None
        #: Ids of stretches, as bytes of four an id.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _nodes(self) -> None:
        """What begins a piece as numbered nodes: `edges`, sorted, are a node's number times the number of code points plus a code point's, and
        lead to `nodes`; the root's are kept apart. `held` is a node's piece, or -1."""
        chars = sorted(set(chain.from_iterable(self.tree)))
        #: A code point's number, from 1; 0 for all that are in no piece.
        self.number = np.zeros(0x110000, np.uint16 if len(chars) < 1 << 16 else np.uint32)
        self.number[list(map(ord, chars))] = np.arange(1, len(chars) + 1)
        self.many = len(chars) + 1
        node = {"": 0} | {name: i for i, name in enumerate(self.tree, 1)}
        self.held = np.full(len(node), -1, np.int64)
        self.roots = np.zeros(self.many, np.int64)
        edges = []
        for name, i in node.items():
            if name in self.ids:
                self.held[i] = self.ids[name]
            if len(name) == 1:
                self.roots[self.number[ord(name)]] = i
            elif name:
                edges.append((node[name[:-1]] * self.many + int(self.number[ord(name[-1])]), i))
        edges.sort()
        #: Greater than any edge, so that every place looked up is one.
        edges.append((np.iinfo(np.int64).max, 0))
        self.edges, self.nodes = np.array(edges, np.int64).T.copy()

    def _pieces(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and id of all pieces in a text, a length at a time."""
        number = self.number[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)
        node = self.roots[number]
        at = np.flatnonzero(node)
        node, found = node[at], []
        for size in range(1, self.longest + 1):
            piece = self.held[node]
            some = np.flatnonzero(piece >= 0)
            found.append((at[some], np.full(len(some), size, np.int64), piece[some]))
            inside = at + size < len(number)
            at, node = at[inside], node[inside]
            edge = node * self.many + number[at + size]
            place = np.searchsorted(self.edges, edge)
            there = np.flatnonzero(self.edges[place] == edge)
            if not len(there):
                break
            at, node = at[there], self.nodes[place[there]]
        return tuple(map(np.concatenate, zip(*found)))

    def _classes(self) -> np.ndarray:
        """By code point: 0 for the space, 1 for those that pieces never mix with letters and the like, 2 for all others."""
        loose = {c for name in self.ids for c in name if not c.isalnum() and c != SPACE}
        while True:
            mixed = {c for name in self.ids if not loose.issuperset(name.replace(SPACE, "")) for c in name}
            if not mixed & loose:
                break
            loose -= mixed
        out = np.full(0x110000, 2, np.uint8)
        out[list(map(ord, loose))] = 1
        out[ord(SPACE)] = 0
        return out

    def ways(self, text: str, at: int):
        """(length, ids, score) of the pieces that start at `at`."""
        found = False
        for k in range(1, min(self.longest, len(text) - at) + 1):
            name = text[at:at + k]
            score = self.tree.get(name, OWN)
            if score is OWN:
                break
            if score is not None:
                found |= k == 1
                yield k, (self.ids[name],), score
        if not found:
            yield 1, self.byte_ids(text[at]), self.unknown

    def byte_ids(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in (SPACE if char == OWN else char).encode())

    def forward(self, text: str, entry: list[int], end: int) -> tuple[list[int], list]:
        """Best scores of reaching each place up to end + longest - 1, and the step that does.

        entry[i]: score at which place i is entered from outside, LOW if it can't be. Steps start before `end`.
        """
        size = end + self.longest
        best, step = [LOW] * size, [None] * size
        best[: len(entry)] = entry
        for at in range(end):
            here = best[at]
            if here == LOW:
                continue
            for k, ids, score in self.ways(text, at):
                # Places are gone through in order, so an equal score found earlier has the longer last piece.
                if here + score > best[at + k]:
                    best[at + k], step[at + k] = here + score, (at, ids)
        return best, step

    def back(self, step: list, at: int) -> tuple[list[tuple[int, ...]], int]:
        """The steps to `at` in order, and the entry that they start from."""
        out = []
        while step[at] is not None:
            at, ids = step[at]
            out.append(ids)
        return out[::-1], at

    def word(self, text: str) -> bytes:
        """Ids of a stretch that is entered at its start and left at its end."""
        got = self.memo.get(text)
        if got is None:
            got = self.older.get(text) or self._best(text)
            if len(text) <= 64:
                if len(self.memo) >= MEMO:
                    self.memo, self.older = {}, self.memo
                self.memo[text] = got
        return got

    def _best(self, text: str) -> bytes:
        """What `forward` and `back` give for a stretch of its own."""
        size = len(text)
        if not self.single.issuperset(text):
            _, step = self.forward(text, [0], size)
            steps, _ = self.back(step, size)
            return _packed(i for ids in steps for i in ids)
        return self._best_of([text])[0]

    def _best_of(self, texts: list[str]) -> list[bytes]:
        """What `forward` and `back` give for stretches whose code points are all pieces; all stretches go place by place together."""
        sizes = np.array(list(map(len, texts)), np.int64)
        # Places of each stretch, its end among them, stand where its code points and what parts it from the next one stand.
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        start, length, piece = self._pieces(PART.join(texts))
        to, gain = start + length, self.gains[piece]
        place = to - np.repeat(begin, sizes + 1)[start]
        # Numbers of a byte are sorted by counting.
        order = np.argsort(place.astype(np.uint8) if sizes.max() < 256 else place, kind="stable")
        bounds = np.searchsorted(place[order], np.arange(1, sizes.max() + 2))
        # The best score, then the longest last piece: one number to compare.
        low = max(len(self.lengths).bit_length(), 1)
        shift = low + int(self.longest).bit_length()
        tag = length << low | piece
        total = int(sizes.sum()) + len(sizes)
        best, key = np.zeros(total, np.int64), np.full(total, np.iinfo(np.int64).min)
        for at, end in zip(bounds[:-1], bounds[1:]):
            rows = order[at:end]
            there = to[rows]
            np.maximum.at(key, there, best[start[rows]] + gain[rows] << shift | tag[rows])
            best[there] = key[there] >> shift
        here, live = begin + sizes, np.arange(len(sizes))
        pieces, owners = [], []
        while len(live):
            got = key[here[live]]
            pieces.append(got & (1 << low) - 1)
            owners.append(live)
            here[live] -= (got >> low) & (1 << shift - low) - 1
            live = live[here[live] > begin[live]]
        owner = np.concatenate(owners[::-1])
        flat = np.concatenate(pieces[::-1])[np.argsort(owner, kind="stable")].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(sizes)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, parts: Iterable[str]) -> None:
        """Puts the stretches that aren't kept yet with those that are, all at once."""
        if len(self.memo) >= MEMO:
            self.memo, self.older = {}, self.memo
        memo, older, new, mixed = self.memo, self.older, set(), {}
        for part in set(parts).difference(memo):
            got = older.get(part)
            if got is not None:
                memo[part] = got
            elif len(part) > 64:
                continue
            elif self.single.issuperset(part):
                new.add(part)
            elif self.foreign:
                mixed[part] = self.foreign.split(part)
        # Every other one is foreign.
        new.update(x for cut in mixed.values() for x in cut[::2] if x and x not in memo)
        some, at = list(new), 0
        while at < len(some):
            end, held = at, 0
            while end < len(some) and held < LOOK:
                held += len(some[end])
                end += 1
            memo.update(zip(some[at:end], self._best_of(some[at:end])))
            at = end
        for part, cut in mixed.items():
            memo[part] = b"".join(memo[x] if i % 2 == 0 else _packed(self.byte_ids(x)) for i, x in enumerate(cut) if x)

    def words(self, text: str) -> list[str]:
        """Stretches between places that no piece crosses: spaces with what follows them, as long as it is of one class."""
        if not self.cuttable or not text:
            return [text] if text else []
        kind = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        before = kind[:-1]
        ends = (np.flatnonzero((kind[1:] != before) & (before != 0)) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts."""
        return [ids.tolist() for ids in self.arrays([self.words(prepared(" " + t)) if t else [] for t in texts])]

    def arrays(self, cut: list[list[str]]) -> list[np.ndarray]:
        """Ids of the stretches of each text."""
        self.learn(chain.from_iterable(cut))
        return [self.ids_of(parts) for parts in cut]

    def ids_of(self, parts: list[str]) -> np.ndarray:
        found = list(map(self.memo.get, parts))
        if None in found:
            found = [ids or self.word(part) for ids, part in zip(found, parts)]
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.content.__getitem__, ids)).decode()[1:]

    def transfer(self, text: str, n: int) -> np.ndarray:
        """Scores from entries 0 to L - 1 (rows) to exits 0 to L - 1 beyond n (columns).

        `text`: the chunk's n code points and the L - 1 after them, or as many as there are.
        """
        cuts = self.cuts(text, n)
        if not cuts:
            return self.transfer_ends(text, None, n, 0)
        first, last = cuts
        between = int(self.gains[self.ids_of(self.words(text[first:last]))].sum())
        return self.transfer_ends(text[:first], text[last:], n - last, between)

    def transfer_ends(self, head: str, tail: str | None, n: int, between: int) -> np.ndarray:
        """The same of a chunk's two ends and the score of what stands between; n is counted from the tail's start, or the head's without one."""
        size = self.longest
        out = np.full((size, size), LOW, np.int64)
        whole = n if tail is None else len(head)
        for i in range(min(size, whole)):
            best, _ = self.forward(head, [LOW] * i + [0], whole)
            if tail is None:
                out[i] = best[n:n + size]
            else:
                out[i, 0] = best[whole]
        for i in range(whole, size):  # entered at or beyond its end
            out[i, i - whole] = 0
        if tail is not None:
            best, _ = self.forward(tail, [0], n)
            exits = np.array(best[n:n + size], np.int64)
            out = np.where((out[:, :1] == LOW) | (exits == LOW), LOW, out[:, :1] + between + exits)
        return out

    def cuts(self, text: str, n: int) -> list[int]:
        """The first place from L - 1 on, and the last up to n, that no piece crosses; none if there isn't one."""
        if not self.cuttable or n <= self.longest:
            return []
        first = _CUT.search(text, self.longest - 1, n)
        if not first:
            return []
        at = text.rfind(SPACE, first.start() + 1, n)
        while at > first.start() + 1 and text[at - 1] == SPACE:
            at -= 1
        return [first.start() + 1, max(at, first.start() + 1)]

    def trace(self, text: str, n: int, entry: list[int]) -> list[tuple[int, list[int]]]:
        """For each exit, the entry and the ids that lead there; entry -1 where nothing does."""
        cuts = self.cuts(text, n)
        if not cuts:
            return [(i, head) for i, head, _ in self.trace_ends(text, None, n, entry)]
        first, last = cuts
        middle = self.ids_of(self.words(text[first:last])).tolist()
        return [(i, head + middle + tail if i >= 0 else [])
                for i, head, tail in self.trace_ends(text[:first], text[last:], n - last, entry)]

    def trace_ends(self, head: str, tail: str | None, n: int, entry: list[int], exits: Iterable[int] | None = None) -> list[tuple[int, list[int], list[int]]]:
        """For each exit, the entry, the ids of the head and those of the tail; n as for `transfer_ends`."""
        flat = lambda steps: [x for ids in steps for x in ids]
        exits = range(self.longest) if exits is None else exits
        if tail is None:
            best, step = self.forward(head, entry, n)
            found = [(j, *self.back(step, n + j)) for j in exits if best[n + j] != LOW]
            at = {j: (i, flat(steps), []) for j, steps, i in found}
        else:
            _, step = self.forward(head, entry, len(head))
            steps, i = self.back(step, len(head))
            start = flat(steps)
            best, step = self.forward(tail, [0], n)
            at = {j: (i, start, flat(self.back(step, n + j)[0])) for j in exits if best[n + j] != LOW}
        return [at.get(j, (-1, [], [])) for j in exits]


#: A non-space before a space.
_CUT = re.compile(f"[^{SPACE}](?={SPACE})")


def vocabulary(path: str) -> Vocabulary:
    """One per task process, until that serves another operator."""
    return kept(("pieces", path), lambda: Vocabulary(path))


_CONTENT: dict[str, pa.Array] = {}


def contents(path: str) -> pa.Array:
    """What each id decodes to; one per task process, which needs no more of the vocabulary to decode."""
    if path not in _CONTENT:
        from sentencepiece import SentencePieceProcessor

        _CONTENT[path] = pa.array(_contents(SentencePieceProcessor(model_file=path)), pa.large_binary())
    return _CONTENT[path]


def _contents(model) -> list[bytes]:
    out = [b""] * model.get_piece_size()
    for i in range(len(out)):
        if model.is_byte(i):
            out[i] = bytes([int(model.id_to_piece(i)[1:-1], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            out[i] = model.id_to_piece(i).replace(SPACE, " ").encode()
    return out


def _packed(ids: Iterable[int]) -> bytes:
    """Four bytes an id."""
    return array("i", ids).tobytes()


def prepared(text: str) -> str:
    """Code point for code point, what is matched with pieces."""
    return text.replace(SPACE, OWN).replace(" ", SPACE)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two matrices; anything below half of LOW is LOW."""
    out = (a[:, :, None] + b[None]).max(axis=1)
    return np.where(out < LOW // 2, LOW, out)


def after(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exit-to-entry maps, going from the end of a text: first a, then b, which stands before a."""
    return np.where(a < 0, -1, b[np.maximum(a, 0)])


def exclusive_scan(items: DataFrame, combine, identity: np.ndarray, block: int) -> DataFrame:
    """(key, idx, payload): for each item of (key, idx, payload) the items of its key with a smaller idx, combined.

    `combine` is associative, over arrays of `identity`'s shape; idx runs from 0. Blocks of `block` items are combined, their
    results scanned likewise, and each block's items combined from there on. Blocks of one number of `KEYS` neighbouring keys go together,
    as most texts have few items.
    """
    kind, form = identity.dtype, identity.shape
    unit = identity.tobytes()

    def runs(rows):
        rows = rows.sort_values(["key", "idx"])
        return [one for _, one in rows.groupby("key", sort=False)]

    def whole(keys, rows):
        out = []
        for one in runs(rows):
            total = identity
            for payload in one["payload"]:
                total = combine(total, np.frombuffer(payload, kind).reshape(form))
            out.append((one["key"].iloc[0], keys[1], total.tobytes()))
        return pd.DataFrame(out, columns=["key", "idx", "payload"])

    def within(keys, rows):
        found = []
        for one in runs(rows):
            out, total = [], np.frombuffer(one["before"].iloc[0], kind).reshape(form)
            for payload in one["payload"]:
                out.append(total.tobytes())
                total = combine(total, np.frombuffer(payload, kind).reshape(form))
            found.append(pd.DataFrame({"key": one["key"], "idx": one["idx"], "payload": out}))
        return pd.concat(found)

    schema = "key long, idx long, payload binary"
    items = items.select("key", "idx", "payload", F.floor(F.col("idx") / block).alias("block"),
                         F.floor(F.col("key") / KEYS).alias("some"))
    last = items.agg(F.max("idx")).first()[0]
    if last is None or last < block:
        started = items.withColumn("before", F.lit(bytearray(unit)))
    else:
        blocks = stored(items.groupBy("some", "block").applyInPandas(whole, schema), "scan-blocks")
        before = exclusive_scan(blocks, combine, identity, block)
        started = items.join(before.select("key", F.col("idx").alias("block"), F.col("payload").alias("before")), ["key", "block"])
    return stored(started.groupBy("some", "block").applyInPandas(within, schema), "scan")


def _ids_array(found: list[np.ndarray]) -> pa.Array:
    """The ids of each row as a list column."""
    return list_array(np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(f) for f in found], np.int64), pa.int32())


def _cut(named: DataFrame, chunk: int, ahead: int) -> DataFrame:
    """key, idx, n, body: a chunk's n code points and `ahead` more. The text has a space put in front."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text = " " + batch.column(1)[i].as_py()
                starts = range(0, len(text), chunk)
                for at in range(0, len(starts), 64):
                    part = starts[at:at + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[i].as_py()] * len(part), pa.int64()),
                        pa.array([s // chunk for s in part], pa.int64()),
                        pa.array([min(chunk, len(text) - s) for s in part], pa.int64()),
                        pa.array([text[s:s + chunk + ahead] for s in part], pa.string())],
                        names=["key", "idx", "n", "body"])

    return named.select("key", "text").mapInArrow(run, "key long, idx long, n long, body string")


def _encode_long(docs: DataFrame, path: str, shape: Shape) -> DataFrame:
    """doc_id, ids of texts that are cut into chunks; equal rows are encoded once."""
    size = vocabulary(path).longest
    named = stored(docs.groupBy("doc_id", "text").agg(F.count("*").cast("int").alias("copies")).withColumn(
        "key", F.monotonically_increasing_id()), "long-texts")
    chunks = stored(_cut(named, max(shape.chunk, size), size - 1).repartition("key", "idx"), "long-chunks")

    def matrices(keys, bodies):
        v, cut = vocabulary(path), []
        for k, b in zip(keys, bodies, strict=True):
            text = prepared(b)
            cuts = v.cuts(text, k["n"])
            cut.append((b, None, k["n"], []) if not cuts else (
                b[:cuts[0]], b[cuts[1]:], k["n"] - cuts[1], v.words(text[cuts[0]:cuts[1]])))
        middle = v.arrays([parts for *_, parts in cut])
        payloads = [v.transfer_ends(prepared(head), None if tail is None else prepared(tail), n, int(v.gains[between].sum())).tobytes()
                    for (head, tail, n, _), between in zip(cut, middle)]
        return {"key": [k["key"] for k in keys], "idx": [k["idx"] for k in keys], "payload": payloads, "head": [c[0] for c in cut],
                "tail": [c[1] for c in cut], "n": [c[2] for c in cut], "middle": _ids_array(middle)}

    # What lies between a chunk's first and last cut is encoded here, once; the later steps need the two ends alone.
    payload = "key long, idx long, payload binary"
    found = stored(map_texts(
        chunks.select(F.struct("key", "idx", "n").alias("k"), "body"), matrices,
        payload + ", head string, tail string, n long, middle array<int>", key="k", text="body"), "long-matrices")
    unit = np.full((size, size), LOW, np.int64)
    np.fill_diagonal(unit, 0)
    before = exclusive_scan(found.select("key", "idx", "payload"), product, unit, shape.block).withColumnRenamed("payload", "before")
    entered = stored(found.select("key", "idx", "head", "tail", "n").join(before, ["key", "idx"]), "long-entered")

    def traced(keys, heads, exits=None):
        v = vocabulary(path)
        for k, head in zip(keys, heads, strict=True):
            # A text is entered at its start: the first row. It is left at its end: exit 0 of its last chunk.
            entry = np.frombuffer(k["before"], np.int64)[:size].tolist()
            at = None if exits is None else [int(np.frombuffer(k["exits"], np.int64)[0])]
            yield v.trace_ends(prepared(head), None if k["tail"] is None else prepared(k["tail"]), k["n"], entry, at)

    def maps(keys, heads):
        entries = [np.array([i for i, _, _ in found], np.int64).tobytes() for found in traced(keys, heads)]
        return {"key": [k["key"] for k in keys], "idx": [k["idx"] for k in keys], "payload": entries}

    turned = map_texts(entered.select(F.struct("key", "idx", "n", "tail", "before").alias("k"), "head"), maps, payload, key="k", text="head")
    ends = found.groupBy("key").agg(F.max("idx").alias("last"))
    turned = stored(turned.join(ends, "key").select("key", (F.col("last") - F.col("idx")).alias("idx"), "payload"), "long-maps")
    exits = exclusive_scan(turned, after, np.arange(size, dtype=np.int64), shape.block)
    exits = exits.join(ends, "key").select("key", (F.col("last") - F.col("idx")).alias("idx"), F.col("payload").alias("exits"))

    def ids(keys, heads):
        rows = [found[0] for found in traced(keys, heads, exits=True)]
        return {"key": [k["key"] for k in keys], "idx": [k["idx"] for k in keys], "start": [r[1] for r in rows], "end": [r[2] for r in rows]}

    parts = map_texts(entered.join(exits, ["key", "idx"]).select(F.struct("key", "idx", "n", "tail", "before", "exits").alias("k"), "head"),
                      ids, "key long, idx long, start array<int>, end array<int>", key="k", text="head")
    # The ends' ids and those between them meet in one grouping, so that ids are shuffled once.
    sides = F.array(F.struct(F.lit(0).alias("place"), F.col("start").alias("ids")), F.struct(F.lit(2).alias("place"), F.col("end").alias("ids")))
    parts = parts.select("key", "idx", F.inline(sides)).unionByName(
        found.select("key", "idx", F.lit(1).alias("place"), F.col("middle").alias("ids")))
    whole = parts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("idx", "place", "ids"))).alias("parts"))
    return whole.join(named.select("key", "doc_id", "copies"), "key").select(
        "doc_id", F.flatten(F.col("parts")["ids"]).alias("ids"), F.explode(F.array_repeat(F.lit(0), F.col("copies")))
        ).select("doc_id", "ids")


def encode(docs: DataFrame, path: str, shape: Shape = Shape(), decoded: bool = False) -> DataFrame:
    """doc_id, ids of every row of `docs` (doc_id, text); `path` names the model file on every machine.

    With `decoded` also the `text` that `decode` gives for the ids, which spares ids of short texts the way to another process.
    """
    docs = plain(docs, "doc_id", "text")

    def rows(keys, values):
        v = vocabulary(path)
        ids = _ids_array(v.arrays([v.words(prepared(" " + t)) if t else [] for t in values]))
        return {"doc_id": keys, "ids": ids} | ({"text": _texts(ids, contents(path))} if decoded else {})

    short = map_texts(docs.where(F.coalesce(F.length("text"), F.lit(0)) <= shape.chunk), rows,
                      "doc_id long, ids array<int>" + (", text string" if decoded else ""))
    long = _encode_long(docs.where(F.length("text") > shape.chunk), path, shape)
    return short.unionByName(decode(long, path) if decoded else long)


def _texts(ids: pa.Array, content: pa.Array) -> pa.Array:
    """What each row's ids decode to."""
    sizes = np.asarray(pc.list_value_length(ids).fill_null(0))
    bytes_ = content.take(ids.flatten())
    if not len(bytes_):
        return pa.array([""] * len(sizes), pa.string())
    # The texts stand one after another in the pieces' bytes.
    offsets = np.frombuffer(bytes_.buffers()[1], np.int64)[bytes_.offset:]
    texts = pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(offsets[np.concatenate([[0], np.cumsum(sizes)])].copy()), bytes_.buffers()[2])
    # Without the space that is put in front.
    return pc.utf8_slice_codeunits(texts, 1).cast(pa.string())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of `encoded` (doc_id, ids) with their text; null or no ids give an empty text."""
    def run(batches):
        content = contents(path)
        for batch in batches:
            whole = np.asarray(pc.list_value_length(batch.column(1)).fill_null(0))
            upto, at = np.cumsum(whole, dtype=np.int64), 0
            while at < len(whole):
                # As many rows as have so many ids together, one at least.
                end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + DECODED, side="right")))
                part, at = batch.slice(at, end - at), end
                yield pa.RecordBatch.from_arrays([*part.columns, _texts(part.column(1), content)], names=["doc_id", "ids", "text"])
        give_back()

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
