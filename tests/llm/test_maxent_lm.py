"""The maximum-entropy language model: counts, normalisation, scores by plain Python, held-out gain, odd rows."""

import re
from collections import Counter
from math import log10
from time import process_time
from zlib import crc32

import numpy as np
import pytest

from iotlake.llm import maxent_lm as lm
from iotlake.llm.queries import op13_maxent_lm

SF = "/root/testdata/sf0.001"
SMALL = lm.Shape(head=2, width=4, tail=3, class_bits=6, word_bits=6, known=12, batch=64)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def read(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1.0, "z") for i, t in rows], "doc_id long, text string, score double, word string").repartition(3)


TEXTS = ["the cat sat on the mat . The end", "a cat and a dog\tand the bird", "", None, "one two three four five six seven eight nine ten eleven",
         "the the the the", "Ünder ÄÖ über den Ü", "b\x0bc\x0cd e", "ä ä b c", "solo"]


def plain_score(model, counts, text):
    """log10 probability, one token after another with scalars."""
    shape = model.shape
    heads = shape.head * shape.width
    tokens = [w.encode() for w in read(text)] + [None]
    out = 0.0
    for i, w in enumerate(tokens):
        one = crc32(tokens[i - 1]) if i > 0 else 0
        two = crc32(tokens[i - 2]) if i > 1 else 0
        one, two = np.array([one], np.uint32), np.array([two], np.uint32)
        number = -2 if w is None else (model.words.index(w) if w in model.words else -1)
        tail = 0 if w is None else crc32(w[-2:]) % shape.tail
        kind = 0 if w is None else 1 + number // shape.width if 0 <= number < heads else 1 + shape.head + tail
        z = model.class_bias + sum(model.class_weights[b[0]] for b in lm.context(one, two, shape.class_bits))
        out += float(z[kind] - np.log(np.exp((z - z.max()).astype(float)).sum()) - z.max()) / np.log(10)
        if w is not None and 0 <= number < heads:
            more = np.array([kind], np.uint32) * np.uint32(0x01000193)
            z = model.word_bias[kind - 1] + sum(model.word_weights[b[0]] for b in lm.context(one, two, shape.word_bits, more))
            out += float(z[number % shape.width] - np.log(np.exp((z - z.max()).astype(float)).sum()) - z.max()) / np.log(10)
        elif w is not None:
            c = counts.get(w.decode(), 0)
            out += log10((c - model.tail_discount[tail]) / model.tail_total[tail]) if c else model.tail_unseen[tail]
    return out


def test_scores_equal_plain_python(spark):
    rows = list(enumerate(TEXTS)) + [(3, "a cat"), (None, "the cat flew"), (20, "the mat " * 400)]
    training, asked = rows[:8] + rows[12:], rows
    model, counts = lm.fit(docs(spark, training), SMALL)
    plain = Counter(w for _, t in training for w in read(t))
    assert {r.word: r.c for r in counts.collect()} == plain
    assert model.tokens == sum(plain.values()) + len(training) and model.distinct == len(plain) + 1
    assert model.class_weights.any() and model.word_weights.any()
    expected = []
    for i, t in asked:
        c = [plain[w] for w in read(t)] + [len(training)]
        base = sum(log10((x + 0.5) / (model.tokens + 0.5 * (model.distinct + 1))) for x in c)
        expected.append((str(i), len(c), sum(x > 0 for x in c), base, plain_score(model, plain, t)))
    found = [(str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in lm.score(docs(spark, asked), model, counts).collect()]
    for got, want in zip(sorted(found), sorted(expected), strict=True):
        assert got[:3] == want[:3] and got[3:] == pytest.approx(want[3:], rel=1e-4, abs=1e-4)


def test_probabilities_sum_to_one(spark):
    model, counts = lm.fit(docs(spark, enumerate(TEXTS)), SMALL)
    plain = {r.word: r.c for r in counts.collect()}
    shape, heads = SMALL, SMALL.head * SMALL.width
    inside = np.zeros(shape.tail)
    for w, c in plain.items():
        if w.encode() not in model.words[:heads]:
            k = crc32(w.encode()[-2:]) % shape.tail
            inside[k] += (c - model.tail_discount[k]) / model.tail_total[k]
    tail = [[c for w, c in plain.items() if w.encode() not in model.words[:heads] and crc32(w.encode()[-2:]) % shape.tail == k] for k in range(shape.tail)]
    for k, cs in enumerate(tail):
        n1, n2 = cs.count(1), cs.count(2)
        missing = max(1.0, n1 * n1 / (2 * n2) if n2 else n1 * (n1 - 1) / 2)
        assert inside[k] + missing * 10 ** model.tail_unseen[k] == pytest.approx(1)
    for one, two in ((0, 0), (crc32(b"the"), crc32(b"on"))):
        buckets = lm.context(np.array([one], np.uint32), np.array([two], np.uint32), shape.class_bits)
        assert lm._softmax(model.class_bias, model.class_weights, buckets).sum() == pytest.approx(1, abs=1e-5)


def test_gradient_step_lowers_the_loss():
    texts = ["a b c d"] * 50 + ["d c b a"] * 50
    counts = Counter(w.encode() for t in texts for w in t.split())
    top = sorted(counts, key=lambda w: (-counts[w], w))
    shape = lm.Shape(head=1, width=4, tail=2, class_bits=6, word_bits=6, batch=32)
    sizes = np.array([[counts[w] for w in top]], float)
    model = lm.Model(shape, top, np.array([counts[w] for w in top]), 500, 5, 100, np.ones(2), np.full(2, 0.5), np.zeros(2),
                     np.log(np.array([100, 400, 0.5, 0.5]) / 501).astype(np.float32), np.log(sizes / 400).astype(np.float32),
                     np.zeros((64, shape.classes), np.float32), np.zeros((64, 4), np.float32))
    before = lm.logs(model, lm.Reader(model).read(texts)).sum()
    lm.learn(model, [texts])
    assert lm.logs(model, lm.Reader(model).read(texts)).sum() > 0.5 * before


def test_held_out_texts_are_likelier_than_by_their_words_alone(spark):
    rows = op13_maxent_lm(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    tokens = sum(r.n_tokens for r in held)
    assert len(held) > 100 and sum(r.score - r.base_score for r in held) > 0.05 * tokens
    assert all(r.score < 0 for r in rows)


def test_no_training_texts_and_empty_tables(spark):
    none = docs(spark, [(1, "x")]).where("doc_id < 0")
    model, counts = lm.fit(none, SMALL)
    found = lm.score(docs(spark, [(1, "a b"), (2, None)]), model, counts).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known) for r in found] == [(3, 0), (1, 0)]
    assert all(np.isfinite([r.score, r.base_score]).all() for r in found)
    assert lm.score(none, model, counts).count() == 0


def test_most_frequent(spark):
    rows = [(f"w{i:03}", 1 + i % 17) for i in range(300)]
    counts = spark.createDataFrame(rows, "word string, c long")
    for n in (0, 1, 40, 500):
        assert [(r.word, r.c) for r in lm.most_frequent(counts, n)] == sorted(rows, key=lambda r: (-r[1], r[0]))[:n]


def test_gradients_are_summed_by_row_faster_than_by_column():
    rng = np.random.default_rng(5)
    rows, grad = (rng.zipf(1.4, 1 << 14) % (1 << 14)).astype(np.uint16), rng.normal(size=(1 << 14, 32)).astype(np.float32)
    columns = np.ascontiguousarray(grad.T, np.float64)

    def by_column():
        return np.stack([np.bincount(rows, c, 1 << 14) for c in columns], axis=1)

    def seconds(run):
        found = []
        for _ in range(7):
            began = process_time()
            run()
            found.append(process_time() - began)
        return min(found)

    used, total = lm._row_sums(rows, grad)
    assert sorted(used.tolist()) == np.unique(rows).tolist()
    assert total == pytest.approx(by_column()[used], abs=1e-3)
    assert seconds(lambda: lm._row_sums(rows, grad)) < seconds(by_column)


def test_softmax_holds_for_logits_beyond_float32():
    weights = np.array([[0, 0, 0], [5000, 4999, 0], [-5000, -5001, -9000], [200, -200, 0]], np.float32)
    none, rows = np.zeros(3, np.float32), [np.arange(4, dtype=np.uint16)]
    z = weights.astype(np.float64)
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    assert lm._softmax(none, weights, rows) == pytest.approx(p, abs=1e-6)
    logs = (z[:, 1] - z.max(axis=1) - np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1))) / np.log(10)
    assert lm._log_share(none, weights, rows, np.ones(4, int)) == pytest.approx(logs, rel=1e-6)
