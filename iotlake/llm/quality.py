"""Quality classifier: random-indexing word vectors, pooled per document, into a small numpy network.

Random indexing: every unit (a whole word, or a whole run of symbols) has a fixed sparse ternary index vector. Its
word vector is the sum of the index vectors of the units within two places of it, over all documents. Units are hashed
into `Shape.buckets` (a million), so the vectors take buckets * width bytes however large the corpus is, and of more distinct
words some share a vector. Tasks sum runs of tokens, the sums of a range of buckets travel together, of a byte a number where that is enough, to the task that
adds them up, and unit vectors in 1/127 reach the driver.

A document's features are the mean of its unit vectors, that mean's length and the mean likeness of
neighbouring units. A two-layer network gives a logit, whose
temperature is fitted on labelled rows that the network was not trained on.

Defined results: a null or empty text has all-zero features and is scored like any other; repeated rows are
scored each; a null or unknown label is not learned; without labels of both kinds every score is the share of
label 1 (0.5 without any label); an empty table has no scores; texts of any length are read whole. Other columns of the tables are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.llm.tables import give_back, hash_sample, kept, list_array, map_texts, plain, text_column

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Unit vectors kept at hand per task.
MEMO = 50_000
#: Tokens that a task sums at once.
RUN = 1 << 18
#: Vectors that are summed at once.
ROWS = 1 << 14
#: Buckets whose sums travel together.
RANGE = 1 << 12


@dataclass(frozen=True)
class Shape:
    buckets: int = 1 << 20
    width: int = 32
    nonzero: int = 4
    reach: int = 2
    hidden: int = 16
    #: Labelled rows that the network is fitted on at most, taken by the hash of their id.
    fit_rows: int = 20_000
    epochs: int = 60
    seed: int = 7


class Units:
    """Maps tokens to buckets, 1 to buckets - 1; bucket 0 is the gap between documents."""

    def __init__(self, buckets: int):
        self.buckets, self.memo = buckets, {}

    def of(self, text: str) -> list[int]:
        memo, out = self.memo, []
        for unit in TOKEN.findall(text):
            bucket = memo.get(unit)
            if bucket is None:
                if len(memo) >= MEMO:
                    memo.clear()
                bucket = memo[unit] = 1 + crc32(unit.encode()) % (self.buckets - 1)
            out.append(bucket)
        return out


def index_vectors(ids: np.ndarray, shape: Shape) -> np.ndarray:
    """ids x width, -1, 0 or 1: what the ids' hashes say, so that no table of them is held; that of id 0 is zero."""
    out = np.zeros((len(ids), shape.width), np.int8)
    rows = np.arange(len(ids))
    for k in range(shape.nonzero):
        h = ids.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32((shape.seed * 1_000_003 + k * 0x85EBCA6B) & 0xFFFFFFFF)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x7FEB352D)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x846CA68B)
        h ^= h >> np.uint32(16)
        out[rows, (h >> np.uint32(1)) % np.uint32(shape.width)] = (h & np.uint32(1)).astype(np.int8) * 2 - 1
    out[ids == 0] = 0
    return out


def _sums(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, ascending, and the sums of each one's vectors."""
    order = np.argsort(ids, kind="stable")
    used, starts = np.unique(ids[order], return_index=True)
    total = np.zeros((len(used), vectors.shape[1]), np.int64)
    # Some rows at a time, as numpy copies what it adds up in the wider type.
    for at in range(0, len(ids), ROWS):
        end = min(at + ROWS, len(ids))
        first, last = np.searchsorted(starts, at, side="right") - 1, np.searchsorted(starts, end)
        total[first:last] += np.add.reduceat(vectors[order[at:end]], np.maximum(starts[first:last], at) - at, axis=0, dtype=np.int64)
    return used, total


def partial_sums(frame: DataFrame, shape: Shape) -> DataFrame:
    """Sums of the neighbours' index vectors over runs of tokens: of each range of buckets the buckets met, as places in the range, and their
    sums one after another, in numbers of `size` bytes."""
    texts = frame.select(F.coalesce(F.col("text"), F.lit("")).alias("t"))

    def run(batches):
        units = kept(("quality units", shape.buckets), lambda: Units(shape.buckets))
        gap, held = [0] * shape.reach, []

        def sums():
            ids = np.array(gap + held, np.int64)
            near = np.zeros((len(ids), shape.width), np.int8)
            vectors = index_vectors(ids, shape)
            for step in range(1, shape.reach + 1):
                near[step:] += vectors[:-step]
                near[:-step] += vectors[step:]
            used, total = _sums(ids, near)
            del vectors, near
            keep = (used > 0) & total.any(axis=1)
            used, total = used[keep], total[keep]
            wide = np.abs(total).max(axis=1, initial=0) > 127
            for kind, some in ((np.int8, ~wide), (np.int32, wide)):
                own, values = used[some], total[some].astype(kind)
                part = own // RANGE
                cuts = np.flatnonzero(np.diff(part)) + 1
                rows = [(a, b) for a, b in zip([0, *cuts], [*cuts, len(own)]) if a < b]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part[a] for a, _ in rows], pa.int32()), pa.array([values.itemsize] * len(rows), pa.int32()),
                    pa.array([(own[a:b] % RANGE).astype(np.uint16).tobytes() for a, b in rows], pa.binary()),
                    # Mostly zeros and small numbers.
                    pa.array([zlib.compress(values[a:b].tobytes(), 1) for a, b in rows], pa.binary())], names=["part", "size", "places", "sums"])

        for batch in batches:
            for text in batch.column(0):
                held += units.of(text.as_py())
                held += gap
                if len(held) > RUN:
                    yield from sums()
                    held = []
        if held:
            yield from sums()
        give_back()

    return texts.mapInArrow(run, "part int, size int, places binary, sums binary")


def context_sums(frame: DataFrame, shape: Shape, then: Callable | None = None, schema: str | None = None) -> DataFrame:
    """Per bucket the sum of its neighbours' index vectors over all texts: bucket, v0, v1, ...

    `then` makes batches of `schema` of them in the same process.
    """
    names = [f"v{i}" for i in range(shape.width)]

    def sums(batches):
        # The sums of the ranges that came to this task: bounded by the buckets, whatever the number of rows.
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, size, places, sums in zip(*(c.to_pylist() for c in batch.columns)):
                total = held.get(part)
                if total is None:
                    total = held[part] = np.zeros((RANGE, shape.width), np.int64)
                values = np.frombuffer(zlib.decompress(sums), np.int8 if size == 1 else np.int32)
                total[np.frombuffer(places, np.uint16)] += values.reshape(-1, shape.width)
        for part, total in held.items():
            met = np.flatnonzero(total.any(axis=1))
            columns = np.ascontiguousarray(total[met].T)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in ((met + part * RANGE).astype(np.int32), *columns)], names=["bucket", *names])

    def run(batches):
        yield from then(sums(batches)) if then else sums(batches)
        give_back()

    return partial_sums(frame, shape).repartition("part").mapInArrow(run, schema or "bucket int, " + ", ".join(f"{n} long" for n in names))


def word_vectors(frame: DataFrame, shape: Shape) -> np.ndarray:
    """buckets x width unit-length vectors in 1/127, of a byte a number; at most shape.buckets rows of bytes reach the driver."""
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            sums = np.stack([np.asarray(c, np.float32) for c in batch.columns[1:]], axis=1)
            found = _mixed(sums, index_vectors(ids, shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids.astype(np.int32).tobytes()], pa.binary()), pa.array([found.tobytes()], pa.binary())], names=["ids", "vectors"])

    out = np.zeros((shape.buckets, shape.width), np.int8)
    for at in range(0, shape.buckets, 1 << 16):
        own = index_vectors(np.arange(at, min(at + (1 << 16), shape.buckets)), shape)
        out[at:at + len(own)] = _mixed(np.zeros(own.shape, np.float32), own)
    # A run at a time, so that the driver holds the vectors once.
    for row in context_sums(frame, shape, run, "ids binary, vectors binary").toLocalIterator(prefetchPartitions=True):
        out[np.frombuffer(row.ids, np.int32)] = np.frombuffer(row.vectors, np.int8).reshape(-1, shape.width)
    return out


def _mixed(sums: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The unit-length mixture of context sums and index vectors, in 1/127."""
    def unit(x):
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    return np.rint(127 * unit(unit(sums) + 0.5 * unit(index.astype(np.float32)))).astype(np.int8)


def features(texts: list[str], vectors: np.ndarray, units: Units) -> np.ndarray:
    """A row per text: pooled vector, its length, likeness of neighbours, and whether there is any word."""
    rows = [units.of(t) for t in texts]
    sizes = np.array([len(r) for r in rows], np.int64)
    width = vectors.shape[1]
    out = np.zeros((len(texts), width + 3))
    full = np.flatnonzero(sizes)
    if len(full):
        ids = np.concatenate([np.asarray(rows[i], np.int64) for i in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        flat = vectors[ids].astype(np.float32) / np.float32(127)
        pooled = np.add.reduceat(flat, starts, axis=0) / sizes[full, None]
        like = np.zeros(len(ids), np.float32)
        like[1:] = np.einsum("ij,ij->i", flat[1:], flat[:-1])
        like[starts] = 0
        out[full, :width] = pooled
        out[full, width] = np.linalg.norm(pooled, axis=1)
        out[full, width + 1] = np.add.reduceat(like, starts) / np.maximum(sizes[full] - 1, 1)
        out[full, width + 2] = 1
    return out


@dataclass
class Network:
    """features -> tanh layer -> logit / temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, shape: Shape) -> Network:
    """Adam on the logistic loss; one row in five only chooses the temperature."""
    width = x.shape[1]
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
                       float(np.log(share / (1 - share))))
    rng = np.random.default_rng(shape.seed)
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5:]
    mean, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
    net = Network(mean, scale, rng.normal(0, width ** -0.5, (width, shape.hidden)), np.zeros(shape.hidden),
                  rng.normal(0, shape.hidden ** -0.5, shape.hidden), 0.0)
    z = np.clip((x - mean) / scale, -8, 8)
    parts = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    size = 64
    epochs = max(shape.epochs, -(-4000 * size // max(len(used), 1)) if len(used) < 4000 else shape.epochs)
    for _ in range(epochs):
        mixed = rng.permutation(used)
        for at in range(0, len(mixed), size):
            rows = mixed[at:at + size]
            hidden = np.tanh(z[rows] @ parts[0] + parts[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ parts[2] + parts[3][0], -40, 40)))
            d = (p - y[rows]) / len(rows)
            back = np.outer(d, parts[2]) * (1 - hidden ** 2)
            grads = [z[rows].T @ back + 1e-4 * parts[0], back.sum(axis=0), hidden.T @ d + 1e-4 * parts[2],
                     np.array([d.sum()])]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                parts[i] = parts[i] - 0.003 * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = parts[0], parts[1], parts[2], float(parts[3][0])
    if len(held):
        logit = net.logit(x[held])
        grid = np.geomspace(0.5, 8, 60)
        loss = [np.mean(np.logaddexp(0, np.where(y[held] == 1, -logit, logit) / t)) for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network
    #: The vectors as `fit` has sent them to the tasks, for scoring to use the same copy.
    sent: Broadcast | None = None


def labelled_sample(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """doc_id and y of at most `rows` rows labelled 0 or 1, taken by the hash of their id."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(f"`{column}`").cast("int").alias("y"))
    known = known.where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    return hash_sample(known, "id", rows)


def fit(docs: DataFrame, labels: DataFrame, shape: Shape = Shape()) -> QualityModel:
    """Vectors from all `docs`, the network from at most shape.fit_rows labelled ones (doc_id, quality)."""
    docs = plain(docs, "doc_id", "text")
    vectors = word_vectors(docs, shape)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)
    # At most shape.fit_rows pairs of numbers, so the broadcast is bounded.
    sample = F.broadcast(labelled_sample(labels, "quality", shape.fit_rows))
    texts = docs.join(sample, docs.doc_id == sample.id).select(
        F.struct("doc_id", "y").alias("key"), "text")

    def rows(keys, values):
        x = features(values, sent.value, kept(("quality units", shape.buckets), lambda: Units(shape.buckets)))
        return {"doc_id": [k["doc_id"] for k in keys], "y": [k["y"] for k in keys],
                "x": list_array(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())}

    found = map_texts(texts, rows, "doc_id long, y int, x array<double>", key="key").orderBy("doc_id").collect()
    x = np.array([r.x for r in found]) if found else np.zeros((0, vectors.shape[1] + 3))
    return QualityModel(vectors, fit_network(x, np.array([r.y for r in found], float), shape), sent)


def score_column(spark: SparkSession, model: QualityModel) -> Column:
    """The score (0 to 1, higher: label 1 likelier) of the column `text`."""
    sent, network, buckets = model.sent or spark.sparkContext.broadcast(model.vectors), model.network, len(model.vectors)

    def run(texts):
        return network.probability(features(texts, sent.value, kept(("quality units", buckets), lambda: Units(buckets))))

    return text_column(run)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every row."""
    return plain(docs, "doc_id", "text").select("doc_id", score_column(docs.sparkSession, model).alias("score"))
