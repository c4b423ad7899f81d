"""Quality and toxicity: held-out accuracy, the risk's correction, odd rows."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from iotlake.llm import quality, toxicity
from iotlake.llm.queries import op1_toxicity, op9_quality
from iotlake.llm.tables import kept, split_of

SF = "/root/testdata/sf0.01"
ODD = [(None, "x y"), (1, None), (2, ""), (3, "same text"), (3, "same text"), (4, "word " * 50_000)]
FEW = quality.Shape(buckets=512, width=8, fit_rows=50, epochs=2)


@pytest.mark.parametrize("query,label,least", [(op9_quality, "quality", 0.95), (op1_toxicity, "toxic", 0.93)])
def test_held_out_accuracy(spark, query, label, least):
    graded = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label), "doc_id").where("held_out")
    right, n = graded.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert n > 50 and right >= least


def test_split_is_by_crc32_of_the_id_as_text(spark):
    from zlib import crc32

    rows = spark.range(200).select("id", split_of("id", 4, 2).alias("held")).collect()
    assert [r.held for r in rows] == [crc32(str(r.id).encode()) % 4 == 2 for r in rows]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("labelled", [[], [(3, 1, 1)], [(1, 1, 1), (2, 0, 0), (3, None, None), (None, 1, 1), (4, 5, 5)]])
def test_odd_rows_and_few_labels(spark, labelled):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in ODD], "doc_id long, text string, score double")
    for found in (quality.score(docs, quality.fit(docs, labels(spark, labelled), FEW)),
                  toxicity.score(docs, toxicity.fit(docs, labels(spark, labelled)))):
        rows = found.collect()
        assert sorted([r.doc_id for r in rows], key=str) == sorted([i for i, _ in ODD], key=str)
        assert all(0 <= r.score <= 1 for r in rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.score(docs, quality.fit(docs, labels(spark, []), FEW)).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels(spark, []))).count() == 0


def test_context_sums_equal_a_plain_loop(spark):
    shape = quality.Shape(buckets=64, width=8)
    texts = ["a b c, a", "", "b b b b"]
    index, units = quality.index_vectors(np.arange(64), shape).astype(int), quality.Units(shape.buckets)
    expected = np.zeros((64, 8), int)
    for ids in map(units.of, texts):
        for i, u in enumerate(ids):
            for j in range(max(0, i - 2), min(len(ids), i + 3)):
                if j != i:
                    expected[u] += index[ids[j]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = np.zeros((64, 8), int)
    for row in quality.context_sums(frame, shape).collect():
        found[row[0]] = row[1:]
    assert (found == expected).all()


def test_partial_sums_are_small(spark):
    """What is shuffled takes well under the 264 bytes of a bucket's sums as longs; counts beyond a byte are kept."""
    rng, shape = np.random.default_rng(1), quality.Shape()
    text = " ".join(f"w{n}" for n in rng.integers(0, 20_000, 60_000)) + " often" * 3000
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = quality.partial_sums(frame, shape).collect()
    buckets = sum(len(r.places) // 2 for r in rows)
    assert {r["size"] for r in rows} == {1, 4} and buckets > 15_000
    assert sum(len(r.places) + len(r.sums) for r in rows) < 40 * buckets
    ids = quality.Units(shape.buckets).of(text)
    often = quality.Units(shape.buckets).of("often")[0]
    sums = {r.bucket: r[1:] for r in quality.context_sums(frame, shape).collect()}
    index = quality.index_vectors(np.array(ids), shape).astype(int)
    expected = sum(index[j] for i, u in enumerate(ids) if u == often for j in range(max(0, i - 2), min(len(ids), i + 3)) if j != i)
    assert len(sums) == buckets and (np.array(sums[often]) == expected).all()


def test_nn_risk_gradient_and_correction():
    rng = np.random.default_rng(0)
    positive = np.arange(12) < 5
    z = rng.normal(size=12)
    for prior in (0.1, 0.9):
        risk, grad, corrected = toxicity.nn_risk(z, positive, prior)
        p = 1 / (1 + np.exp(-z))
        negatives = p[~positive].mean() - prior * p[positive].mean()
        assert corrected == (negatives < 0)
        assert risk == pytest.approx(prior * (1 - p[positive]).mean() + max(0, negatives))
        if corrected:
            continue
        for i in range(12):
            step = np.where(np.arange(12) == i, 1e-6, 0)
            slope = (toxicity.nn_risk(z + step, positive, prior)[0] - toxicity.nn_risk(z - step, positive, prior)[0]) / 2e-6
            assert grad[i] == pytest.approx(slope, abs=1e-6)
    # Positives scored high and the unlabelled low: the negatives' risk falls below zero.
    assert toxicity.nn_risk(np.where(positive, 5.0, -5.0), positive, 0.5)[2]


def test_words_that_differ_after_the_third_letter_differ(spark):
    texts = ["information station mother", "infantile stagnant motorway"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vectors = quality.word_vectors(docs, quality.Shape())
    one, two = quality.features(texts, vectors, quality.Units(len(vectors)))
    assert np.abs(one - two)[:vectors.shape[1]].max() > 0.1
    assert np.abs(np.linalg.norm(vectors[1:] / 127, axis=1) - 1).max() < 0.05


def test_sums_of_a_run_hold_no_wide_copy():
    rng = np.random.default_rng(3)
    ids, vectors = rng.integers(0, 50, 1 << 17), rng.integers(-4, 5, (1 << 17, 32)).astype(np.int8)
    tracemalloc.start()
    used, total = quality._sums(ids, vectors)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # In the wide type the vectors take 32 MB.
    assert most < 16 << 20
    for i, row in zip(used, total, strict=True):
        assert (row == vectors[ids == i].sum(axis=0, dtype=int)).all()


def test_a_process_keeps_what_one_operator_needs():
    one = kept("one", list)
    assert kept("one", list) is one
    two = kept("two", list)
    assert kept("two", list) is two and kept("one", list) is not one


def test_word_vectors_are_sent_once(spark, monkeypatch):
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or send(self, value))
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], "doc_id long, text string")
    model = quality.fit(docs, labels(spark, [(i, i % 2, 0) for i in range(20)]), FEW)
    assert quality.score(docs, model).count() == 20 and len(quality.score(docs, model).collect()) == 20
    assert [x.shape for x in sent if isinstance(x, np.ndarray)] == [(FEW.buckets, FEW.width)] and len(sent) == 1
