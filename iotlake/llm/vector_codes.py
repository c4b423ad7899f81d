"""Vector compression: each of a vector's equal parts is coded by the nearest entry of that part's codebook.

Rounds of assignment and update, as in k-means, in whole numbers throughout. Assignments are exact; norm-of-sum bounds
(Newling and Fleuret, 2016) spare most of the distances after the first round:

* Every part of every vector keeps, for each group of entries, a lower bound of its distance to the group's entries other than its own,
  and the stamp of the round in which that bound was measured.
* All codebooks of earlier rounds are kept. A bound of round r is loosened by the net way that the group's entries have gone since:
  by |now - then|, which is at most the sum of the ways of each round.
* A group whose loosened bound is above the distance to the own entry can't hold a nearer one. The other groups are scanned
  exactly, and their bounds are measured anew. Ties go to the lower index: a bound that only equals is scanned.

Bounds are rounded down and ways up, so rounding can't hide a nearer entry. Each round's state is a table in the shared folder; tasks
add up their parts, so that a round shuffles a row for each task, part and entry, and only sums reach the driver.

Defined results: a vector that is null or holds a null or non-finite component is left out; so is one whose length is not the
most frequent one among lengths that can be cut in equal parts (the longest of equally frequent ones). Components beyond
2**18 in size count as that, so that sums of squares stay exact. Entries start from the rows in order of (vec_id, nulls last; vector);
repeated rows each count. With fewer rows than entries there are as many entries as rows. An empty table has no rows
and no entries. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iotlake.llm.tables import give_back, list_array, plain, prepare, stored

#: Whole numbers stand for 1/SCALE, and reach LIMIT at most.
SCALE, LIMIT = 256, 1 << 26
#: Relative error that square roots and 32-bit bounds stay within.
SLACK = 1e-6


@dataclass(frozen=True)
class Shape:
    parts: int = 16
    entries: int = 64
    #: Groups of neighbouring entries; each has a bound.
    groups: int = 8
    rounds: int = 2


def whole(vector: Column) -> Column:
    """floor(SCALE * x) of each component."""
    return F.transform(vector, lambda x: F.greatest(F.least(
        F.floor(x.cast("double") * SCALE), F.lit(LIMIT).cast("long")), F.lit(-LIMIT).cast("long")).cast("int"))


def finite(vector: Column) -> Column:
    """Whether the vector has only finite components, and no null."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def kept(vectors: DataFrame, shape: Shape) -> DataFrame:
    """vec_id, label and whole numbers x of the vectors that are coded."""
    rows = stored(plain(vectors, "vec_id", "label", "embedding").where(finite(F.col("embedding"))).select(
        "vec_id", "label", whole(F.col("embedding")).alias("x")), "whole-vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).count().where((F.col("d") % shape.parts == 0) & (F.col("d") > 0))
    usual = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (usual.d if usual else -1))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, rows by entries, exact."""
    apart = x[:, None, :] - entries[None]
    return np.einsum("ijk,ijk->ij", apart, apart)


def starts_of(entries: int, groups: int) -> np.ndarray:
    """The first entry of each group."""
    return np.unique(np.arange(groups) * entries // groups)


def _low(squared: np.ndarray) -> np.ndarray:
    return (np.sqrt(squared) * (1 - SLACK)).astype(np.float32)


def _others_least(d: np.ndarray, code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per group the least distance to an entry other than the row's own."""
    d = d.astype(np.float64)
    d[np.arange(len(d)), code] = np.inf
    return _low(np.minimum.reduceat(d, starts, axis=1))


def first_codes(x: np.ndarray, entries: np.ndarray, starts: np.ndarray):
    """Codes, squared distances, and each group's bound, by exact distances to all entries."""
    d = distances(x, entries)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(d)), code], _others_least(d, code, starts)


def net_ways(books: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """[round, own entry, group]: the farthest net way since that round of a group's entries other than the own one."""
    ways = np.sqrt(((books[:-1] - books[-1]) ** 2).sum(axis=2)) * (1 + SLACK)
    own = np.eye(books.shape[1], dtype=bool)
    return np.maximum.reduceat(np.where(own, 0.0, ways[:, None, :]), starts, axis=2)


def next_codes(x, code, low, stamp, books: np.ndarray, starts: np.ndarray, ways: np.ndarray):
    """Codes, squared distances, bounds, stamps and the number of scanned groups after the last of `books`; ways as by net_ways."""
    now, round_ = books[-1], len(books) - 1
    n, k = len(x), len(now)
    ends = np.append(starts[1:], k)
    own = ((x - now[code]) ** 2).sum(axis=1)
    bound = low - ways[stamp, code[:, None], np.arange(len(starts))]
    scanned = bound <= np.sqrt(own)[:, None] * (1 + SLACK)
    best, to = own.copy(), code.copy()
    found = []
    for g in range(len(starts)):
        rows = np.flatnonzero(scanned[:, g])
        d = distances(x[rows], now[starts[g]:ends[g]])
        found.append((rows, d))
        if len(rows):
            at = d.argmin(axis=1)
            least, entry = d[np.arange(len(rows)), at], starts[g] + at
            nearer = (least < best[rows]) | ((least == best[rows]) & (entry < to[rows]))
            best[rows[nearer]], to[rows[nearer]] = least[nearer], entry[nearer]
    low, stamp = low.copy(), stamp.copy()
    # An entry that was a row's own until now is one more of its group, if that wasn't scanned.
    left = np.searchsorted(starts, code, side="right") - 1
    moved = np.flatnonzero((to != code) & ~scanned[np.arange(n), left])
    low[moved, left[moved]] = np.minimum(bound[moved, left[moved]], _low(own[moved]))
    stamp[moved, left[moved]] = round_
    for g, (rows, d) in enumerate(found):
        if len(rows):
            d = d.astype(np.float64)
            inside = np.flatnonzero((to[rows] >= starts[g]) & (to[rows] < ends[g]))
            d[inside, to[rows[inside]] - starts[g]] = np.inf
            low[rows, g], stamp[rows, g] = _low(d.min(axis=1)), round_
    return to, best, low, stamp, scanned.sum()


def _grid(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def assign(state: DataFrame, history: list[np.ndarray], shape: Shape) -> DataFrame:
    """The state after one more assignment, to the last codebooks of the history."""
    prepare(state.sparkSession)
    entries, width = history[-1].shape[1:]
    starts = starts_of(entries, shape.groups)
    books = [np.stack([h[p] for h in history]) for p in range(shape.parts)]
    ways = [net_ways(b, starts) for b in books] if len(history) > 1 else []
    schema = state.select("vec_id", "label", "x").schema.simpleString()[7:-1]
    out = f"{schema},codes array<smallint>,error bigint,low array<float>,stamp array<tinyint>,scanned bigint"

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _grid(batch.column("x"), n).astype(np.int64).reshape(n, shape.parts, width)
            codes, error = np.zeros((n, shape.parts), np.int16), np.zeros(n, np.int64)
            low = np.zeros((n, shape.parts, len(starts)), np.float32)
            stamp, scanned = np.zeros(low.shape, np.int8), 0
            if ways:
                before = _grid(batch.column("codes"), n).astype(np.int64)
                lows, stamps = (_grid(batch.column(c), n).reshape(low.shape) for c in ("low", "stamp"))
            for p in range(shape.parts):
                if ways:
                    codes[:, p], d, low[:, p], stamp[:, p], more = next_codes(
                        x[:, p], before[:, p], lows[:, p], stamps[:, p], books[p], starts, ways[p])
                    scanned += more
                else:
                    codes[:, p], d, low[:, p] = first_codes(x[:, p], books[p][-1], starts)
                error += d
            flat = [list_array(v.ravel(), np.full(n, v[0].size), kind)
                    for v, kind in ((codes, pa.int16()), (low, pa.float32()), (stamp, pa.int8()))]
            counted = np.zeros(n, np.int64)
            counted[0] = scanned
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column("x"), flat[0], pa.array(error), flat[1], flat[2], pa.array(counted)],
                names=["vec_id", "label", "x", "codes", "error", "low", "stamp", "scanned"])
        give_back()

    return state.mapInArrow(run, out)


def updated(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry the floored mean of its parts; an unused one stays."""
    parts, entries, width = books.shape
    names = [f"s{i}" for i in range(width)]

    def run(batches):
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            if batch.num_rows:
                at = (_grid(batch.column(0), batch.num_rows).astype(np.int64) + np.arange(parts) * entries).ravel()
                np.add.at(total, at, _grid(batch.column(1), batch.num_rows).reshape(-1, width))
                n += np.bincount(at, minlength=len(n))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (used.astype(np.int32), n[used], *np.ascontiguousarray(total[used].T))], names=["entry", "n", *names])

    sums = state.select("codes", "x").mapInArrow(run, "entry int, n long, " + ", ".join(f"{c} long" for c in names))
    out = books.reshape(-1, width).copy()
    for row in sums.groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():
        out[row[0]] = np.array(row[2:], np.int64) // row[1]
    return out.reshape(books.shape)


def compress(vectors: DataFrame, shape: Shape = Shape()) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error) of each coded vector, and the codebooks [part, entry, component]."""
    state = kept(vectors, shape)
    seeds = [r.x for r in state.orderBy(F.asc_nulls_last("vec_id"), "x").limit(shape.entries).select("x").collect()]
    if not seeds:
        empty = state.select("vec_id", "label", F.lit(None).cast("array<smallint>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((shape.parts, 0, 0), np.int64)
    first = np.array(seeds, np.int64).reshape(len(seeds), shape.parts, -1).transpose(1, 0, 2)
    history = [np.ascontiguousarray(first)]
    for _ in range(shape.rounds):
        state = stored(assign(state, history, shape), "vector-codes")
        history.append(updated(state, history[-1]))
    return stored(assign(state, history, shape), "vector-codes").select("vec_id", "label", "codes", "error"), history[-1]


def decoded(codes: Column, books: np.ndarray) -> Column:
    """The whole numbers that the codes stand for."""
    entries = F.array(*[F.array(*[F.lit(e.tolist()) for e in part]) for part in books])
    parts = [F.get(F.get(entries, F.lit(p)), F.get(codes, F.lit(p)).cast("int")) for p in range(len(books))]
    return reduce(F.concat, parts)
