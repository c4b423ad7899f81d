"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

The outcomes are the words of the training texts, the end of a text, and words never seen. A word belongs to one class: the
most frequent words to `Shape.head` classes of `Shape.width` words each, by rank; the end to a class of its own; all others to
`Shape.tail` classes by the hash of their last two bytes. The probability of a word after its context h is

    P(class | h) * P(word | class, h)

Both are softmaxes of summed weights of hashed features: the word before, the two words before together, and the word
before that alone (a skip feature), beside the logarithm of the training share. Inside a tail class words are not told apart by
context: a word seen c times has (c - D) / T, and what the discount D takes away is shared evenly by the estimated number of
unseen words of that class (Chao, 1984). So the probabilities after any context sum to one over the known and the estimated unseen words.

Counts cover all training texts. Weights are trained on all training texts too: each task makes AdaGrad steps over
its own texts from the shared weights, and the changes, in whole units of 2**-20, are averaged by Spark; a round starts from the average of the
round before. Scores come from batches of numpy over the touched rows of the weights. What a task holds is bounded by `Shape`: the
weights and the `known` most frequent words with their counts. Rarer words of a text are looked up by a join.

Defined results: a null text is empty; an empty text is its end alone; repeated rows are scored each; a null
doc_id is a row like any other; without training texts the vocabulary is empty, the end and the classes of unseen words
are equally likely, and a class holds one unseen word; an empty table stays empty; texts of any length are read whole, and further
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace
from itertools import repeat
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iotlake.llm.tables import BATCH_BYTES, give_back, list_array, map_texts, plain, prepare, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Weights travel in whole units of this, so that their sums don't depend on an order.
UNIT = 2.0 ** -20
#: Weights in a row of what the tasks send.
BLOCK = 16
#: A row of weights that so many tokens of a batch touch is summed on its own.
OFTEN = 16


@dataclass(frozen=True)
class Shape:
    head: int = 16
    width: int = 32
    tail: int = 15
    #: Rows of the class weights and of the word weights, as powers of two (16 at most).
    class_bits: int = 14
    word_bits: int = 14
    #: Words held with their counts in every task.
    known: int = 1 << 16
    rounds: int = 1
    batch: int = 16384
    rate: float = 1.0

    @property
    def classes(self) -> int:
        """The end, the head classes and the tail classes, in that order."""
        return 1 + self.head + self.tail


def words(texts: DataFrame) -> DataFrame:
    """The words of all texts, A-Z lowered, a row each."""
    # One kind of white space, so that no pattern is needed to split.
    plain_text = F.translate("text", UPPER + "\t\n\x0b\f\r", LOWER + " " * 5)
    return texts.select(F.explode(F.split(plain_text, " ")).alias("word")).where("word <> ''")


def tail_class(word: Column, shape: Shape) -> Column:
    """A tail class's number, from 0, of a word."""
    return F.crc32(F.substring(word.cast("binary"), -2, 2)) % shape.tail


def vocabulary(texts: DataFrame) -> DataFrame:
    """word and c, its number in all texts. Counts are added up in each task before they are shuffled."""
    return words(texts).groupBy("word").agg(F.count("*").alias("c"))


def most_frequent(counts: DataFrame, n: int) -> list:
    """The n most frequent words; ties by the word. Counts are cut first where a histogram of them shows that n remain."""
    bins = counts.groupBy(F.floor(8 * F.log2("c")).alias("bin")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    held, least = 0, 0
    for r in sorted(bins, key=lambda r: -r.bin):
        if held >= n:
            break
        held, least = held + r.n, r.least
    return counts.where(F.col("c") >= least).orderBy(F.desc("c"), "word").limit(n).collect()


@dataclass
class Model:
    shape: Shape
    #: The known words, most frequent first, their counts, and each one's number.
    words: list[bytes]
    counts: np.ndarray
    #: All training tokens, distinct ones, and training texts.
    tokens: int
    distinct: int
    texts: int
    #: Per tail class: total count, discount, log10 of an unseen word's share.
    tail_total: np.ndarray
    tail_discount: np.ndarray
    tail_unseen: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    class_weights: np.ndarray
    word_weights: np.ndarray

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the add-half unigram share of a token seen c times."""
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def statistics(counts: DataFrame, texts: int, shape: Shape) -> Model:
    """The untrained model of a vocabulary (word, c): all that comes from counts."""
    top = most_frequent(counts, shape.known)
    n, tokens = counts.agg(F.count("*"), F.sum("c")).first()
    head = [r.word for r in top[:shape.head * shape.width]]
    tail = counts.where(~F.col("word").isin(head)) if head else counts
    total, discount = np.zeros(shape.tail), np.full(shape.tail, 0.5)
    unseen = np.zeros(shape.tail)
    seen = {r.k: r for r in tail.groupBy(tail_class(F.col("word"), shape).alias("k")).agg(
        F.count("*").alias("v"), F.sum("c").alias("t"), F.count_if(F.col("c") == 1).alias("n1"),
        F.count_if(F.col("c") == 2).alias("n2")).collect()}
    for k in range(shape.tail):
        r = seen.get(k)
        if r is None:
            continue
        total[k] = r.t
        discount[k] = min(max(r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.5, 0.1), 0.95)
        missing = max(1.0, r.n1 * r.n1 / (2 * r.n2) if r.n2 else r.n1 * (r.n1 - 1) / 2)
        unseen[k] = log10(discount[k] * r.v / r.t / missing)
    sizes = np.zeros(shape.head * shape.width)
    sizes[:len(head)] = [r.c for r in top[:len(head)]]
    sizes = sizes.reshape(shape.head, shape.width)
    mass = np.concatenate([[texts], sizes.sum(axis=1), total + 0.5])
    # A class without a word can't be met; a slot without a word neither.
    empty = np.concatenate([[False], sizes.sum(axis=1) == 0, np.zeros(shape.tail, bool)])
    with np.errstate(divide="ignore"):
        bias = np.where(empty, -1e4, np.log(np.maximum(mass, 0.5) / np.maximum(mass, 0.5).sum()))
        slots = np.where(sizes > 0, np.log(np.maximum(sizes, 1) / np.maximum(sizes.sum(axis=1, keepdims=True), 1)), -1e4)
    return Model(
        shape, [r.word.encode() for r in top], np.array([r.c for r in top], np.int64), (tokens or 0) + texts,
        n + (texts > 0), texts, total, discount, unseen, bias.astype(np.float32), slots.astype(np.float32),
        np.zeros((1 << shape.class_bits, shape.classes), np.float32), np.zeros((1 << shape.word_bits, shape.width), np.float32))


def _mixed(x: np.ndarray, by: int, bits: int) -> np.ndarray:
    """uint32 hashes spread over so many bits."""
    x = (x ^ (x >> np.uint32(15))) * np.uint32(by)
    return ((x ^ (x >> np.uint32(13))) * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)).astype(np.uint16)


@dataclass
class Tokens:
    """The tokens of some texts, one text after another, each with its end."""

    #: A known word's number; -1 for another word, -2 for an end.
    number: np.ndarray
    kind: np.ndarray
    #: Hashes of the word before and of the one before that; 0 where there is none.
    one: np.ndarray
    two: np.ndarray
    #: Tokens of each text.
    sizes: np.ndarray
    #: Where the other words are, and they themselves.
    others: np.ndarray
    words: list[bytes]


class Reader:
    """Texts as arrays of tokens; holds what a task needs to read words."""

    def __init__(self, model: Model):
        self.shape = model.shape
        self.number = {w: i for i, w in enumerate(model.words)}
        heads = model.shape.head * model.shape.width
        rest = [1 + model.shape.head + crc32(w[-2:]) % model.shape.tail for w in model.words[heads:]]
        self.class_of = np.concatenate([
            1 + np.arange(min(heads, len(model.words))) // model.shape.width, np.array(rest, np.int64), [0, 0]]).astype(np.int16)
        self.hash_of = np.array([*map(crc32, model.words), 0, 0], np.uint32)

    def read(self, texts: list[str]) -> Tokens:
        found = [t.encode().translate(_FOLD).split() for t in texts]
        sizes = np.array([len(t) + 1 for t in found], np.int64)
        ends = np.cumsum(sizes) - 1
        flat = [w for t in found for w in (*t, b"")]
        number = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int32, len(flat))
        number[ends] = -2
        kind, own = self.class_of[number], self.hash_of[number]
        others = np.flatnonzero(number == -1)
        words = [flat[i] for i in others.tolist()]
        kind[others] = 1 + self.shape.head + np.array([crc32(w[-2:]) for w in words], np.int64) % self.shape.tail
        own[others] = np.fromiter(map(crc32, words), np.uint32, len(words))
        one, two = np.zeros(len(flat), np.uint32), np.zeros(len(flat), np.uint32)
        one[1:], two[2:] = own[:-1], own[:-2]
        starts = ends + 1 - sizes
        one[starts] = two[starts] = 0
        two[starts[sizes > 1] + 1] = 0
        return Tokens(number, kind, one, two, sizes, others, words)


def context(one: np.ndarray, two: np.ndarray, bits: int, more: np.ndarray | None = None) -> list[np.ndarray]:
    """Buckets of the features; `more` is mixed into each."""
    both = one * np.uint32(0x85EBCA6B) ^ (two * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F))
    found = [one, both, two + np.uint32(0x165667B1)]
    if more is not None:
        found = [x ^ more for x in found]
    return [_mixed(x, by, bits) for x, by in zip(found, (0x2C1B3C6D, 0x297A2D39, 0x7FEB352D))]


def _logits(bias: np.ndarray, weights: np.ndarray, buckets: list[np.ndarray]) -> np.ndarray:
    z = weights.take(buckets[0], axis=0, mode="clip")
    for b in buckets[1:]:
        z += weights.take(b, axis=0, mode="clip")
    z += bias
    return z


def _exponents(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What was taken off each row of the logits, exp of the rest, and its sums. Only rows whose sum float32 can't hold well need their
    largest logit taken off, which costs as much as all else."""
    off, ones = np.zeros(len(z), np.float32), np.ones(z.shape[1], np.float32)
    with np.errstate(over="ignore"):
        e = np.exp(z)
        total = e @ ones
    far = np.flatnonzero(~((total > 1e-20) & (total < 1e20)))
    if len(far):
        off[far] = z[far].max(axis=1)
        e[far] = np.exp(z[far] - off[far, None])
        total[far] = e[far] @ ones
    return off, e, total


def _softmax(bias: np.ndarray, weights: np.ndarray, buckets: list[np.ndarray]) -> np.ndarray:
    _, e, total = _exponents(_logits(bias, weights, buckets))
    e /= total[:, None]
    return e


def _log_share(bias: np.ndarray, weights: np.ndarray, buckets: list[np.ndarray], of: np.ndarray) -> np.ndarray:
    """log10 of the softmax at one place of each row."""
    z = _logits(bias, weights, buckets)
    off, _, total = _exponents(z)
    own = z[np.arange(len(z)), of].astype(np.float64) - off
    return (own - np.log(total, dtype=np.float64)) / np.log(10)


def _row_sums(rows: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that occur, and the sums of each one's gradients."""
    order = np.argsort(rows, kind="stable")
    rows, grad = rows[order], grad.take(order, axis=0, mode="clip")
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    sizes = np.diff(np.append(starts, len(rows)))
    by = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by], sizes[by]
    total = grad.take(starts, axis=0, mode="clip")
    often = int(np.searchsorted(-sizes, -OFTEN, side="right"))
    for i in range(often):
        total[i] = grad[starts[i]:starts[i] + sizes[i]].sum(axis=0, dtype=np.float64)
    # Of all others together the second gradient, then the third, and so on.
    for k in range(1, OFTEN):
        end = int(np.searchsorted(-sizes, -k))
        if end <= often:
            break
        total[often:end] += grad.take(starts[often:end] + k, axis=0, mode="clip")
    return rows[starts], total


def _step(weights: np.ndarray, history: np.ndarray, buckets: list[np.ndarray], grad: np.ndarray, rate: float) -> None:
    """An AdaGrad step of the touched rows; `history` has a number for each row."""
    for b in buckets:
        used, total = _row_sums(b, grad)
        history[used] += np.einsum("ij,ij->i", total, total)
        total *= (rate / np.sqrt(history[used] + 1.0))[:, None]
        weights[used] = weights.take(used, axis=0, mode="clip") - total


def _runs(model: Model, t: Tokens):
    """Runs of tokens: where they are, class buckets, which are head words, and those's word buckets and classes."""
    shape = model.shape
    for start in range(0, len(t.number), shape.batch):
        at = slice(start, start + shape.batch)
        number, one, two = t.number[at], t.one[at], t.two[at]
        heads = np.flatnonzero((number >= 0) & (number < shape.head * shape.width))
        k = t.kind[at][heads]
        yield (at, context(one, two, shape.class_bits), heads, number[heads] % shape.width, k - 1,
               context(one[heads], two[heads], shape.word_bits, k.astype(np.uint32) * np.uint32(0x01000193)))


def learn(model: Model, runs) -> None:
    """AdaGrad steps over runs of texts, changing the model's weights in place."""
    shape, reader = model.shape, Reader(model)
    class_history, word_history = np.zeros(len(model.class_weights), np.float32), np.zeros(len(model.word_weights), np.float32)
    for texts in runs:
        t = reader.read(texts)
        for at, buckets, heads, slot, k, word_buckets in _runs(model, t):
            p = _softmax(model.class_bias, model.class_weights, buckets)
            p[np.arange(len(p)), t.kind[at]] -= 1
            _step(model.class_weights, class_history, buckets, p, shape.rate)
            if len(heads):
                p = _softmax(model.word_bias[k], model.word_weights, word_buckets)
                p[np.arange(len(p)), slot] -= 1
                _step(model.word_weights, word_history, word_buckets, p, shape.rate)


def logs(model: Model, t: Tokens) -> np.ndarray:
    """log10 of each token's class share, times a head word's share of its class."""
    out = np.zeros(len(t.number))
    for at, buckets, heads, slot, k, word_buckets in _runs(model, t):
        out[at] = _log_share(model.class_bias, model.class_weights, buckets, t.kind[at])
        if len(heads):
            out[at.start + heads] += _log_share(model.word_bias[k], model.word_weights, word_buckets, slot)
    return out


def _flat(model: Model) -> np.ndarray:
    """All weights one after another, padded to whole blocks."""
    flat = np.concatenate([model.class_weights.ravel(), model.word_weights.ravel()])
    return np.concatenate([flat, np.zeros(-len(flat) % BLOCK, np.float32)])


def train(model: Model, texts: DataFrame) -> Model:
    """Rounds of AdaGrad in the tasks over all texts; a block of weights becomes the mean over the tasks that changed it."""
    spark = texts.sparkSession
    prepare(spark)
    names = [f"v{i}" for i in range(BLOCK)]
    rows = texts.select(F.coalesce(F.col("text"), F.lit("")).alias("t")).where("t <> ''")
    for _ in range(model.shape.rounds):
        sent = spark.sparkContext.broadcast(model)

        def run(batches):
            own = replace(sent.value, class_weights=sent.value.class_weights.copy(), word_weights=sent.value.word_weights.copy())
            learn(own, _held(batches))
            moved = np.rint((_flat(own) - _flat(sent.value)) / UNIT).astype(np.int64).reshape(-1, BLOCK)
            used = np.flatnonzero(moved.any(axis=1)).astype(np.int32)
            columns = np.ascontiguousarray(moved[used].T)
            for at in range(0, len(used), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[at:at + 4096]) for x in (used, *columns)], names=["block", *names])
            give_back()

        summed = rows.mapInArrow(run, "block int, " + ", ".join(f"{n} long" for n in names)).groupBy("block").agg(
            F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names])
        flat = _flat(model).reshape(-1, BLOCK)
        for r in summed.collect():
            flat[r[0]] += np.array(r[2:]) * (UNIT / r[1])
        cut = model.class_weights.size
        flat = flat.ravel()
        model = replace(model, class_weights=flat[:cut].reshape(model.class_weights.shape),
                        word_weights=flat[cut:cut + model.word_weights.size].reshape(model.word_weights.shape))
        sent.unpersist()
    return model


def _held(batches):
    """Runs of texts, of so many bytes."""
    run, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            run.append(text.as_py())
            size += len(run[-1])
            if size > BATCH_BYTES:
                yield run
                run, size = [], 0
    if run:
        yield run


def fit(texts: DataFrame, shape: Shape = Shape()) -> tuple[Model, DataFrame]:
    """The trained model, and the counts (word, c) of all its words, from the texts (column text)."""
    texts = plain(texts, "text")
    counts = stored(vocabulary(texts), "vocabulary")
    return train(statistics(counts, texts.count(), shape), texts), counts


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row; scores are log10."""
    spark, shape = docs.sparkSession, model.shape
    sent, readers = spark.sparkContext.broadcast(model), []
    rows = plain(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())

    def run(keys, texts):
        model = sent.value
        if not readers:
            readers.append(Reader(model))
        t = readers[0].read(texts)
        found, starts = logs(model, t), np.cumsum(t.sizes) - t.sizes
        c = np.append(model.counts, [model.texts, 0])[t.number]
        tail = np.flatnonzero(t.number >= shape.head * shape.width)
        k = t.kind[tail] - 1 - shape.head
        found[tail] += np.log10((c[tail] - model.tail_discount[k]) / model.tail_total[k])
        base = model.base(c)
        base[t.others] = 0
        known = (c > 0).astype(np.int64)
        known[t.others] = 0
        of = np.searchsorted(np.cumsum(t.sizes), t.others, side="right")
        words: list[Counter] = [Counter() for _ in texts]
        for i, w in zip(of.tolist(), t.words):
            words[i][w] += 1
        return {
            "row": [x["row"] for x in keys], "doc_id": [x["doc_id"] for x in keys], "n_tokens": t.sizes,
            "n_known": np.add.reduceat(known, starts), "base_score": np.add.reduceat(base, starts),
            "score": np.add.reduceat(found, starts),
            "words": list_array([w for x in words for w in x], np.array([len(x) for x in words]), pa.binary()).cast(pa.list_(pa.string())),
            "times": list_array(np.array([n for x in words for n in x.values()], np.int64), np.array([len(x) for x in words]), pa.int64())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    first = stored(map_texts(
        rows.select(F.struct("row", "doc_id").alias("key"), "text"), run,
        f"row long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double, words array<string>, times array<long>",
        key="key"), "scored")
    # Words that a task doesn't hold: no frequent word among them, so no word has a large share of the rows.
    rare = first.select("row", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("n"))))

    def of(values):
        return F.element_at(F.array(*[F.lit(float(x)) for x in values]), (tail_class(F.col("word"), shape) + 1).cast("int"))

    c = F.coalesce("c", F.lit(0))
    share = F.when(c > 0, F.log10((c - of(model.tail_discount)) / of(model.tail_total))).otherwise(of(model.tail_unseen))
    base = F.log10((c + 0.5) / F.lit(model.tokens + 0.5 * (model.distinct + 1)))
    more = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"), F.sum(base * F.col("n")).alias("more_base"),
        F.sum(share * F.col("n")).alias("more_score"))
    none = F.lit(0)
    return first.drop("words", "times").join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", none)).alias("n_known"),
        (F.col("base_score") + F.coalesce("more_base", none)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", none)).alias("score"))
