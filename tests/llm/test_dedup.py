"""Documents and vectors against brute force; sketches; components."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from iotlake.llm import odd_sketch_dedup as o
from iotlake.llm import projection_dedup as p
from iotlake.llm.components import components


def groups(ids, pairs):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def near_texts():
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    texts = []
    for k in range(60):  # near copies: every pair differs in up to two places
        words = list(base)
        words[10 + 2 * k] = f"v{k}"
        texts.append(" ".join(words))
    for k in range(20):  # half of the text is shared
        texts.append(" ".join(base[:75] + [f"u{k}_{i}" for i in range(75)]))
    return texts


def test_documents_equal_brute_force(spark):
    texts = near_texts()
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, " \t\n"), (103, "a b"), (104, "A  B"), (105, "a b c d e"),
                                     (106, texts[0].upper()), (107, "é x"), (107, "é x"), (108, "É x")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(None, "a b", 2)], "doc_id long, text string, component_id int")
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    expected = groups(sets, links)
    assert len(set(expected.values())) > 20 and len(links) > 60
    found = o.near_duplicates(docs).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (
                len(sets[r.doc_id]), expected[r.doc_id], expected[r.doc_id] == r.doc_id)


def test_tiles_find_what_one_group_finds(spark):
    shape = o.Shape()
    docs = spark.createDataFrame(list(enumerate(near_texts())), "doc_id long, text string")
    heads = o.sketched(docs, shape).select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "odd")
    members = heads.select(F.lit(1).cast("long").alias("key"), "rep", F.col("rep").alias("component"), "n", "odd")
    whole, cut = (components(o.close(members, docs, shape, tile), "a", "b").orderBy("node").collect() for tile in (512, 7))
    assert whole == cut and len(whole) > 50


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert o.near_duplicates(docs).collect() == []


def test_sketches_estimate_similarity():
    shape = o.Shape()
    sketcher = o.Sketcher(shape)
    rng = np.random.default_rng(1)
    for s in (0.85, 0.95, 0.5):
        shared = rng.integers(0, 1 << 63, 2000, np.int64).astype(np.uint64)
        own = round(2000 * (1 - s) / (1 + s))
        x, y = shared.copy(), shared.copy()
        x[:own] = rng.integers(0, 1 << 63, own, np.int64).astype(np.uint64)
        odd = sketcher.odd(sketcher.minima([np.sort(o._mix(x)), np.sort(o._mix(y))])).view(np.uint64)
        count = int(np.bitwise_count(odd[0] ^ odd[1]).sum())
        s = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        estimate = 1 + shape.bits * np.log(max(1 - 2 * count / shape.bits, 1e-9)) / (4 * sketcher.samples)
        assert abs(estimate - s) < 0.15
        assert (count <= sketcher.most_bits()) == (s > 0.6)


def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        center = rng.normal(size=16)
        rows += [center + rng.normal(size=16) * 0.28 for _ in range(12)]
    rows = [r.tolist() for r in rows]
    return rows + [rows[0], rows[0], [x * 2 for x in rows[0]], None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15,
                   [float("inf")] + [1.0] * 15, [1.0, 0.0], [2.0, 0.0], [1e-200] * 16, [1e200] * 16]


@pytest.mark.parametrize("shape", [p.Shape(), p.Shape(window=4, block=8)])
def test_vectors_equal_brute_force(spark, shape):
    rows = list(enumerate(vectors()))
    ok = {i: np.array(v) / np.max(np.abs(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in ok.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    expected = groups([i for i, _ in rows], links)
    frame = spark.createDataFrame([(i, v, 3) for i, v in rows] + [(None, [1.0, 0.0], 3)], "vec_id long, embedding array<double>, rep int")
    found = p.near_duplicates(frame, shape).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            n = sum(r.vec_id in pair for pair in links)
            assert (r.n_links, r.component_id, r.kept) == (n, expected[r.vec_id], expected[r.vec_id] == r.vec_id)


def test_large_component_is_counted_in_tiles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (np.ones(8) + rng.normal(size=8) * 0.05).tolist()) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    members = p.usable(frame).select(F.col("vec_id").alias("rep"), "packed", F.lit(1).cast("long").alias("copies"),
                                     F.lit(0).cast("long").alias("component"))
    assert {r.n_other for r in p.count_links(members, p.Shape(), tile=30).collect()} == {199}
    assert {r.n_links for r in p.near_duplicates(frame, p.Shape(window=3)).collect()} == {199}


def test_rounding_of_the_passes_stays_within_its_bound():
    rng = np.random.default_rng(6)
    for width in (1, 2, 64, 2_000):
        rows = rng.normal(size=(200, width)) * rng.choice([1e-6, 1.0, 5.0], size=(200, width))
        unit = p._unit([r.tobytes() for r in np.concatenate([rows, rows + rng.normal(size=rows.shape) * 0.01])])
        rounded, slack = p._rounded(p._coarse(unit))
        assert np.abs(rounded @ rounded.T - unit @ unit.T).max() <= slack < 2e-3


def test_pairs_within_the_rounding_of_the_threshold_are_settled_exactly(spark):
    rng = np.random.default_rng(7)
    rows, links = [], {}
    for k in range(60):  # cosines from 0.9 - 3e-5 to 0.9 + 3e-5, in planes far from each other
        x, y = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
        cosine = 0.9 + (k - 29.5) * 1e-6
        rows += [x * 3, (cosine * x + (1 - cosine ** 2) ** 0.5 * y) * 7]
        links[2 * k], links[2 * k + 1] = 2 * k, 2 * k + (k < 30)
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    found = p.near_duplicates(frame).collect()
    assert {r.vec_id: r.component_id for r in found} == links
    assert all(r.n_links == (r.vec_id // 2 >= 30) for r in found)


def test_empty_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert p.near_duplicates(frame).collect() == []


def test_components_of_a_path_and_of_nothing(spark):
    path = spark.range(40).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    path = path.unionAll(spark.sql("select 7L, 7L union all select null, 3L union all select 100L, 90L"))
    found = {r.node: r.component for r in components(path, "x", "y").collect()}
    assert found == {i: 0 for i in range(41)} | {90: 90, 100: 90}
    assert components(path.where("x < 0"), "x", "y").collect() == []


def test_pairs_in_a_dense_unlinked_cone_are_found(spark):
    rng = np.random.default_rng(4)

    def units(n):
        x = rng.normal(size=(n, 64))
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    axis = units(1)[0]
    cone = 0.8 ** 0.5 * axis + 0.2 ** 0.5 * units(1_500)
    cone /= np.linalg.norm(cone, axis=1, keepdims=True)
    side = units(100)
    side -= (side * cone[:100]).sum(axis=1, keepdims=True) * cone[:100]
    partner = 0.905 * cone[:100] + (1 - 0.905 ** 2) ** 0.5 * side / np.linalg.norm(side, axis=1, keepdims=True)
    all_rows = np.concatenate([cone, partner, units(500)])
    frame = spark.createDataFrame(list(enumerate(all_rows.tolist())), "vec_id long, embedding array<double>")
    shape = p.Shape(window=8, least_passes=4)
    near = all_rows @ all_rows.T >= 0.9
    expected = groups(range(len(all_rows)), [(int(a), int(b)) for a, b in np.argwhere(np.triu(near, 1))])
    assert {r.vec_id: r.component_id for r in p.near_duplicates(frame, shape).collect()} == expected


def test_a_very_long_text_and_its_near_copy(spark):
    words = [f"w{i % 7919}x{i}" for i in range(60_000)]
    near = words[:59_000] + [f"y{i}" for i in range(1_000)]
    docs = spark.createDataFrame([(5, " ".join(words)), (9, " ".join(near)), (3, " ".join(words[:200]))], "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in o.near_duplicates(docs).collect()}
    assert found == {5: (59_996, 5, True), 9: (59_996, 5, False), 3: (196, 3, True)}
