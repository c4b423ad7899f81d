"""Toxicity from confirmed toxic texts and unlabelled ones: non-negative positive-unlabelled learning.

The classifier is linear over which words and word stems a text holds, once, twice or more. Its risk is

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the sigmoid loss, which is bounded so that a few far-off texts can't decide it: the second part is the risk of the negatives, got from the unlabelled texts by taking
out the positives' share; it can't be below zero, so where a step makes it negative that step goes back
along its gradient instead (the non-negative correction). Texts labelled not toxic are not used as negatives;
the labels only name the positives and, by their share, the class prior.

Defined results: a null or empty text holds no words and gets the score of the bias alone; repeated rows are
scored each; null or unknown labels are not learned; without any positive every score is 0; an empty table has no
scores; texts of any length are read whole. Other columns of the tables are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.llm.quality import labelled_sample
from iotlake.llm.tables import hash_sample, list_array, map_texts, plain, stored, text_column

WORD = re.compile(r"\w+")
MEMO = 200_000
#: A word's parts: itself, and its beginnings of so many code points, as many languages build words onto a stem.
STEMS = (4, 6)
#: A part counts once for each number of occurrences that a text reaches, up to this.
LEVELS = 3


@dataclass(frozen=True)
class Shape:
    #: Texts that the classifier is fitted on at most, taken by the hash of their id.
    positives: int = 3_000
    unlabelled: int = 9_000
    #: A feature's share among positives is at least so many standard errors from that among the unlabelled.
    deviations: float = 5.0
    features: int = 2_048
    steps: int = 400
    rate: float = 0.05
    decay: float = 1e-4


def word_parts(word: str) -> list[int]:
    """Hashes of the word and of its stems."""
    return [crc32(word.encode()), *(crc32((word[:n] + "~").encode()) for n in STEMS if len(word) > n)]


def text_features(text: str, memo: dict) -> list[int]:
    """(part, level) pairs that the text reaches, each as one number."""
    counts: Counter[int] = Counter()
    for word, n in Counter(WORD.findall(text.lower())).items():
        parts = memo.get(word)
        if parts is None:
            if len(memo) >= MEMO:
                memo.clear()
            parts = memo[word] = word_parts(word)
        for part in parts:
            counts[part] += n
    return [part << 2 | level for part, n in counts.items() for level in range(1, min(n, LEVELS) + 1)]


@dataclass
class ToxicityModel:
    weights: dict[int, float]
    bias: float

    def __post_init__(self):
        self.parts = {feature >> 2 for feature in self.weights}

    def logit(self, text: str, memo: dict) -> float:
        counts: dict[int, int] = {}
        for word in WORD.findall(text.lower()):
            parts = memo.get(word)
            if parts is None:
                if len(memo) >= MEMO:
                    memo.clear()
                parts = memo[word] = tuple(p for p in word_parts(word) if p in self.parts)
            for part in parts:
                counts[part] = counts.get(part, 0) + 1
        return self.bias + sum(self.weights.get(part << 2 | level, 0.0)
                               for part, n in counts.items() for level in range(1, min(n, LEVELS) + 1))


def nn_risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray, bool]:
    """Risk, its gradient by z, and whether the correction was at work.

    z: logits; positive: which rows are confirmed positives, the others being unlabelled.
    """
    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    slope = p * (1 - p)
    n_pos, n_un = max(positive.sum(), 1), max((~positive).sum(), 1)
    of_pos = prior * (1 - p[positive]).sum() / n_pos
    of_neg = p[~positive].sum() / n_un - prior * p[positive].sum() / n_pos
    neg_grad = slope * np.where(positive, -prior / n_pos, 1 / n_un)
    if of_neg < 0:
        return of_pos, -neg_grad, True
    return of_pos + of_neg, np.where(positive, -prior * slope / n_pos, 0) + neg_grad, False


def fit_linear(
    rows: list[np.ndarray], positive: np.ndarray, features: np.ndarray, prior: float, shape: Shape,
) -> ToxicityModel:
    """rows: which of the sorted `features` each text has."""
    if not positive.any() or positive.all():
        return ToxicityModel({}, -40.0)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.searchsorted(features, np.concatenate(rows))
    n = len(features)
    weights, bias = np.zeros(n), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, shape.steps + 1):
        z = bias + np.bincount(owner, weights=weights[cols], minlength=len(rows))
        _, by_z, corrected = nn_risk(z, positive, prior)
        grad = np.bincount(cols, weights=by_z[owner], minlength=n) + (0 if corrected else shape.decay * weights)
        by_bias = by_z.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        mb, vb = 0.9 * mb + 0.1 * by_bias, 0.999 * vb + 0.001 * by_bias ** 2
        first, second = 1 - 0.9 ** step, 1 - 0.999 ** step
        weights = weights - shape.rate * (m / first) / (np.sqrt(v / second) + 1e-8)
        bias -= shape.rate * (mb / first) / (np.sqrt(vb / second) + 1e-8)
    return ToxicityModel(dict(zip(features.tolist(), weights.tolist(), strict=True)), float(bias))


def choose_features(sample: DataFrame, shape: Shape) -> np.ndarray:
    """The features that tell positives from unlabelled texts most, at most shape.features."""
    def count(keys, values):
        memo: dict = {}
        of_pos, of_un = Counter(), Counter()
        for key, value in zip(keys, values, strict=True):
            (of_pos if key else of_un).update(text_features(value, memo))
        names = list(of_pos.keys() | of_un.keys())
        return {"feature": names, "pos": [of_pos[x] for x in names], "un": [of_un[x] for x in names]}

    totals = sample.agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("un")).first()
    n_pos, n_un = totals.pos or 0, totals.un or 0
    if not n_pos or not n_un:
        return np.zeros(0, np.int64)
    counted = map_texts(sample, count, "feature long, pos long, un long", key="y").groupBy("feature").agg(
        F.sum("pos").alias("pos"), F.sum("un").alias("un"))
    both = (F.col("pos") + F.col("un") + 1) / (n_pos + n_un + 2)
    apart = F.abs(F.col("pos") / n_pos - F.col("un") / n_un) / F.sqrt(both * (1 - both) * (1 / n_pos + 1 / n_un))
    best = counted.withColumn("apart", apart).where(F.col("apart") >= shape.deviations).orderBy(
        F.desc("apart"), "feature").limit(shape.features).select("feature").collect()
    return np.sort(np.array([r.feature for r in best], np.int64))


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, shape: Shape = Shape()) -> ToxicityModel:
    """From `labels` (doc_id, toxic = 1 named) and the texts of `docs`.

    `prior` is the share of toxic texts; by default that among all given labels.
    """
    docs = plain(docs, "doc_id", "text")
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    if prior is None:
        share = known.agg(F.avg("toxic")).first()[0]
        prior = min(max(share or 0.0, 1e-3), 0.999)
    toxic = labelled_sample(known.where("toxic = 1"), "toxic", shape.positives)
    drawn = hash_sample(docs.select(F.col("doc_id").alias("id")), "id", shape.unlabelled, 1).select("id", F.lit(0).alias("y"))
    # At most shape.positives + shape.unlabelled pairs of numbers, so the broadcast is bounded.
    chosen = F.broadcast(toxic.unionByName(drawn))
    sample = stored(docs.join(chosen, docs.doc_id == chosen.id).select("doc_id", "y", "text"), "toxicity-sample")
    features = choose_features(sample, shape)

    def rows(keys, values):
        memo: dict = {}
        found = [np.intersect1d(np.array(text_features(v, memo), np.int64), features) for v in values]
        return {"doc_id": [k["doc_id"] for k in keys], "y": [k["y"] for k in keys],
                "found": list_array(np.concatenate(found), np.array([len(f) for f in found]), pa.int64())}

    table = map_texts(sample.select(F.struct("doc_id", "y").alias("key"), "text"), rows,
                      "doc_id long, y int, found array<long>", key="key").toArrow()
    y = np.asarray(table.column("y"))
    order = np.lexsort((np.asarray(table.column("doc_id")), y))
    found = table.column("found").combine_chunks()
    values, offsets = np.asarray(found.values), np.asarray(found.offsets)
    picked = [values[offsets[i]:offsets[i + 1]] for i in order]
    return fit_linear(picked, y[order] == 1, features, prior, shape)


def score_column(spark: SparkSession, model: ToxicityModel) -> Column:
    """The score (0 to 1, higher: toxic likelier) of the column `text`."""
    sent = spark.sparkContext.broadcast(model)
    memo: dict = {}

    def run(texts):
        z = np.array([sent.value.logit(t, memo) for t in texts])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    return text_column(run)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row."""
    return plain(docs, "doc_id", "text").select("doc_id", score_column(docs.sparkSession, model).alias("score"))
