"""The chunked scan against one pass over the text, and round trips."""

import random
import sys

import numpy as np
import pytest

from iotlake.llm import piece_scan
from iotlake.llm.piece_scan import LOW, Shape, Vocabulary, after, prepared, product

PATH = "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = ["", " ", "a", "the quick  brown fox\n\tjumps", "▁ own ▁▁", "日本語のテキスト😀 é", "x" * 300,
         "   " * 40, "no_space_" * 50, "<s> </s> <0x0A>"]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def one_pass(v, text):
    """The definition: best sum of scores over the whole text, ties to the longer last piece."""
    t = prepared(" " + text)
    best, step = [0] + [LOW] * len(t), [None] * (len(t) + 1)
    for end in range(1, len(t) + 1):
        for size in range(min(v.longest, end), 0, -1):
            name = t[end - size:end]
            score, ids = v.scores.get(name), (v.ids.get(name),)
            if score is None and size == 1:
                score, ids = v.unknown, v.byte_ids(name)
            if score is not None and best[end - size] + score > best[end]:
                best[end], step[end] = best[end - size] + score, (end - size, ids)
    out, at = [], len(t)
    while at:
        at, ids = step[at]
        out = [*ids, *out]
    return out


def noise(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice("the and a in▁ \n  éß日b.e") for _ in range(n))


@pytest.mark.parametrize("text", TEXTS + [noise(1, 400)])
def test_words_equal_one_pass_and_decode(vocabulary, text):
    ids = vocabulary.encode(text)
    assert ids == (one_pass(vocabulary, text) if text else [])
    assert vocabulary.decode(ids) == text


@pytest.mark.parametrize("chunk", [16, 17, 23, 64, 200])
@pytest.mark.parametrize("cuttable", [True, False])
@pytest.mark.parametrize("text", [noise(2, 500), "x" * 333, "thethethe" * 40, " " * 100 + "a"])
def test_chunks_equal_one_pass(chunk, cuttable, text):
    v = Vocabulary(PATH)
    v.cuttable = v.cuttable and cuttable
    t, size = prepared(" " + text), v.longest
    parts = [(t[s:s + chunk + size - 1], min(chunk, len(t) - s)) for s in range(0, len(t), chunk)]
    matrices = [v.transfer(b, n) for b, n in parts]
    unit = np.full((size, size), LOW, np.int64)
    np.fill_diagonal(unit, 0)
    before = [unit]
    for m in matrices:
        before.append(product(before[-1], m))
    traced = [v.trace(b, n, p[0].tolist()) for (b, n), p in zip(parts, before, strict=False)]
    at, out = 0, []
    for one in reversed(traced):
        out = one[at][1] + out
        at = one[at][0]
    assert at == 0 and out == one_pass(v, text)


def test_product_and_maps_are_associative():
    rng = np.random.default_rng(3)
    a, b, c = (rng.integers(-99, 0, (4, 4)) for _ in range(3))
    assert (product(product(a, b), c) == product(a, product(b, c))).all()
    x, y, z = (rng.integers(-1, 4, 4) for _ in range(3))
    assert (after(after(x, y), z) == after(x, after(y, z))).all()


def test_operator(spark):
    long = noise(4, 900)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (51, long), (51, long), (None, "null id"), (52, "x" * 700)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string")
    v = Vocabulary(PATH)
    found = piece_scan.decode(piece_scan.encode(docs, PATH, Shape(chunk=40, block=3)), PATH).collect()
    expected = sorted(((i, one_pass(v, t) if t else [], t or "") for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.ids, r.text) for r in found), key=repr) == expected


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert piece_scan.encode(docs, PATH).collect() == []


def test_memory_of_new_stretches_is_bounded(vocabulary, monkeypatch):
    """New stretches are looked through in runs, and a kept one takes four bytes an id."""
    v, looked, best = Vocabulary(PATH), [], Vocabulary._best_of
    monkeypatch.setattr(Vocabulary, "_best_of", lambda self, texts: looked.append(sum(map(len, texts))) or best(self, texts))
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefgh", k=8)) for _ in range(20_000))
    assert v.decode(v.encode(text)) == text
    assert sum(looked) > 150_000 and max(looked) < 70_000
    assert all(sys.getsizeof(ids) <= 40 + 4 * len(part) for part, ids in v.memo.items())


def test_scan_takes_many_keys_together(spark):
    """Each key's items are combined on their own, also where blocks of many keys make one group."""
    items = [(k, i, np.array([k * 7 + i], np.int64)) for k in [*range(70), 1 << 33] for i in range(k % 9)]
    frame = spark.createDataFrame([(k, i, bytearray(x.tobytes())) for k, i, x in items], "key long, idx long, payload binary")
    found = {(r.key, r.idx): int(np.frombuffer(r.payload, np.int64)[0])
             for r in piece_scan.exclusive_scan(frame, lambda a, b: a * 3 + b, np.zeros(1, np.int64), 100).collect()}
    expected, total = {}, {}
    for k, i, x in items:
        expected[k, i] = total.get(k, 0)
        total[k] = expected[k, i] * 3 + int(x[0])
    assert found == expected


@pytest.mark.parametrize("seed", range(4))
def test_stretches_are_spaces_and_a_run_of_one_class(vocabulary, seed):
    text = prepared(noise(seed, 3000) + "".join(TEXTS))
    kind = {c: int(vocabulary.classes[ord(c)]) for c in text}
    expected, last = [], None
    for c in text:
        if last is None or (last != 0 and kind[c] != last):
            expected.append("")
        expected[-1] += c
        last = kind[c]
    assert vocabulary.words(text) == expected and vocabulary.words("") == []
    assert {0, 1, 2} <= set(kind.values())


def test_texts_are_decoded_where_they_are_encoded(spark):
    """Ids of short texts don't go to a second Python process; rows are those of `decode`."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, noise(5, 700)])] + [(None, None)], "doc_id long, text string")
    shape = Shape(chunk=300)
    found = piece_scan.encode(docs, PATH, shape, decoded=True)
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    rows = found.collect()
    assert order(rows) == order(piece_scan.decode(piece_scan.encode(docs, PATH, shape), PATH).collect())
    assert order((r.doc_id, r.text) for r in rows) == order((r.doc_id, r.text or "") for r in docs.collect())
    short = piece_scan.encode(docs.where("length(text) < 300"), PATH, shape, decoded=True)._jdf.queryExecution().executedPlan().toString()
    assert short.split("Union")[-1].split("Exchange")[0].count("MapInArrow") == 1
