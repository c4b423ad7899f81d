"""Vector codes: plain loops, bounds, odd rows."""

from hashlib import sha256

import numpy as np
import pytest

from iotlake.llm import vector_codes as vc
from iotlake.llm.queries import op11_vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, shape):
    """(codes, error) per row and the codebooks, by loops over whole numbers."""
    width = len(rows[0]) // shape.parts
    cut = [[r[p * width:(p + 1) * width] for p in range(shape.parts)] for r in rows]
    books = [[c[p] for c in cut[:shape.entries]] for p in range(shape.parts)]

    def nearest(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return min(range(len(book)), key=lambda i: (far[i], i)), min(far)

    for step in range(shape.rounds + 1):
        found = [[nearest(c[p], books[p]) for p in range(shape.parts)] for c in cut]
        if step == shape.rounds:
            return [([f[0] for f in r], sum(f[1] for f in r)) for r in found], books
        for p in range(shape.parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][0] == e]
                if mine:
                    books[p][e] = [sum(v) // len(mine) for v in zip(*mine)]


def table(spark, vectors, parts=3):
    return spark.createDataFrame(
        [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed,spread", [(0, 1.0), (1, 0.02), (2, 30.0)])
def test_equals_plain_loops(spark, seed, spread):
    rng = np.random.default_rng(seed)
    shape = vc.Shape(parts=4, entries=12, groups=5, rounds=4)
    vectors = (rng.normal(size=(150, 8)) * spread).astype(np.float32)
    whole = np.floor(vectors.astype(float) * 256).astype(int).tolist()
    expected, books = plain_codes(whole, shape)
    found, got = vc.compress(table(spark, vectors), shape)
    assert got.tolist() == books
    assert [(r.codes, r.error) for r in found.orderBy("vec_id").collect()] == expected


def test_bounds_spare_scans_and_net_ways_are_tighter():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 3, (400, 4)) for c in range(0, 4000, 200)]).astype(np.int64)
    starts = vc.starts_of(20, 5)
    books = [x[::400].copy()]
    code, _, low = vc.first_codes(x, books[0], starts)
    stamp = np.zeros(low.shape, np.int8)
    scans = 0
    for t in range(1, 5):
        # To and fro: the net way of two rounds is nothing.
        books.append(books[0] + (1 if t % 2 else 0))
        history = np.stack(books)
        ways = vc.net_ways(history, starts)
        code, d, low, stamp, scanned = vc.next_codes(x, code, low, stamp, history, starts, ways)
        exact = vc.distances(x, books[-1])
        assert (code == exact.argmin(axis=1)).all() and (d == exact.min(axis=1)).all()
        others = np.where(np.arange(20) == code[:, None], np.inf, exact)
        true = np.sqrt(np.minimum.reduceat(others, starts, axis=1))
        now = np.concatenate([ways, np.zeros((1, *ways.shape[1:]))])
        assert (low - now[stamp, code[:, None], np.arange(5)] <= true + 1e-6).all()
        scans += scanned
    assert scans < 4 * len(x) * 5 / 4
    assert (vc.net_ways(np.stack(books), starts)[0] < 1e-9).all()


def test_ties_go_to_the_lower_index(spark):
    vectors = [[0.0, 0.0], [0.5, 0.5], [0.25, 0.25], [0.25, 0.25]]
    shape = vc.Shape(parts=2, entries=2, groups=2, rounds=0)
    found, _ = vc.compress(table(spark, vectors), shape)
    assert [r.codes for r in found.orderBy("vec_id").collect()] == [[0, 0], [1, 1], [0, 0], [0, 0]]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (None, [2.0, -3e38], None), (2, None, 1), (3, [nan, 0.0], 1), (4, [inf, 0.0], 1),
            (5, [None, 0.0], 1), (6, [], 2), (7, [1.0], 2), (8, [1.0, 2.0, 3.0, 4.0], 2), (9, [0.5, 0.5], None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", codes string, error int")
    found, books = vc.compress(frame, vc.Shape(parts=2, rounds=1))
    got = sorted(((r.vec_id, r.label, r.codes, r.error) for r in found.collect()), key=str)
    assert [g[:2] for g in got] == [(1, 1), (1, 1), (9, None), (None, None)]
    assert books.shape == (2, 4, 1) and books.min() == -vc.LIMIT
    assert all(g[3] == 0 for g in got)


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)]):
        found, books = vc.compress(spark.createDataFrame(rows, SCHEMA))
        assert found.count() == 0 and books.size == 0


def test_decoded(spark):
    vectors = np.arange(40).reshape(10, 4) / 256
    found, books = vc.compress(table(spark, vectors), vc.Shape(parts=2, rounds=0))
    back = found.orderBy("vec_id").select(vc.decoded(found.codes, books).alias("x")).collect()
    assert [r.x for r in back] == np.arange(40).reshape(10, 4).tolist()


def test_query_columns(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(90, 32)).astype(np.float32)
    table(spark, vectors).write.parquet(f"{tmp_path}/embeddings.parquet")
    expected, books = plain_codes(np.floor(vectors.astype(float) * 256).astype(int).tolist(), vc.Shape())
    named = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    sums = {k: sum(e for i, (_, e) in enumerate(expected) if i % 3 == k) for k in range(3)}
    for r in op11_vector_codes(spark, str(tmp_path)).collect():
        codes, error = expected[r.vec_id]
        assert r.code == "".join(f"{c:02x}" for c in codes)
        assert (r.error, r.label_error, r.codebooks_sha256) == (error, sums[r.vec_id % 3], named)
