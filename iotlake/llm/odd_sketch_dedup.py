"""Near-duplicate documents by MinHash bands, odd sketches and full sets of word shingles.

1. A document's set holds the hashes (64 bits) of its distinct shingles of five words. Documents with equal
   sets collapse into a class, named by the smallest doc_id, before anything is paired.
2. Each class has `bands * rows` MinHash values. Each band's values hash into a key; classes that share a key
   may be near duplicates. All samples are folded into an odd sketch: a bitmap in which every sample flips
   one bit, so that the set bits of two sketches' XOR count the samples in which they differ, precisely where
   the sets are much alike (Mitzenmacher, Pagh and Pham, 2014).
3. Within a key every class is paired with the smallest one only. Pairs whose sizes or sketches rule out the
   threshold go; the others are confirmed on the full sets, which gives components.
4. In a key that still holds several components every class is compared with those of the other components: a key's
   classes are cut into tiles, each pair of tiles is a task's group, sketches and sizes choose the pairs, and full sets
   decide. A group reports only links that join something. So each pair that shares a key is in one component
   already or compared: no cap, and no table of a large group's pairs.

Recall: a pair at similarity s shares no key with probability (1 - s^rows)^bands: 6e-5 at 0.80, 3e-7 at 0.85. The sketch
estimate keeps a pair unless it falls `margin` short, 4.2 standard deviations at 0.80 and 4.9 at 0.85.

Defined results: doc_id is taken to name one text. A null, empty or blank text has no shingles, is linked with nothing and is kept; a text of
fewer words is one shingle; repeated rows of one doc_id share its component; a row whose doc_id is null has a null
component and is kept; an empty table has no rows; texts of any length are read whole, by one task each. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iotlake.llm.components import components
from iotlake.llm.tables import BROADCAST_IDS, give_back, list_array, map_texts, plain, small, stored


@dataclass(frozen=True)
class Shape:
    words: int = 5
    bands: int = 32
    rows: int = 6
    #: Bits of a sketch, a multiple of 64.
    bits: int = 512
    #: Similarity in hundredths from which documents are linked.
    hundredths: int = 80
    #: By how much an estimate may fall short of the threshold.
    margin: float = 0.15
    seed: int = 11


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of many texts at once."""

    def __init__(self, words: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.words = words
        self.bytes = rng.integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.places = np.ones(1, np.uint64)
        self.orders = rng.integers(0, 1 << 63, words, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def _powers(self, n: int) -> np.ndarray:
        while len(self.places) < n:
            step = np.uint64(pow(0x9E3779B97F4A7C15, len(self.places), 1 << 64))
            self.places = np.concatenate([self.places, self.places * step])
        return self.places

    def word_hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word of UTF-8 bytes."""
        inside = ~_SPACE[data]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        sizes = ends - starts
        place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) \
            if not starts[0] else None
        if place is None:
            place = np.zeros(len(data), np.int64)
            place[starts[0]:] = np.arange(starts[0], len(data)) - np.repeat(
                starts, np.diff(np.append(starts, len(data))))
        longest = int(sizes.max())
        powers = self._powers(longest + 1)
        value = np.where(inside, self.bytes[data] * powers[np.minimum(place, longest)], np.uint64(0))
        return _mix(np.add.reduceat(value, starts)), starts

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """A sorted array of distinct hashes per text; texts are lower-cased A-Z."""
        data = np.frombuffer(b" ".join(texts).lower(), np.uint8)
        hashes, starts = self.word_hashes(data)
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.concatenate([[0], np.searchsorted(starts, ends)])
        out = []
        for i in range(len(texts)):
            words = hashes[cuts[i]:cuts[i + 1]]
            if not len(words):
                out.append(words)
                continue
            # A shorter text is one shingle, told from longer ones by its length.
            n = max(len(words) - self.words + 1, 1)
            size = min(self.words, len(words))
            total = np.full(n, np.uint64(size))
            for k in range(size):
                total += _mix(words[k:k + n] + self.orders[k]) * self.orders[k]
            out.append(np.unique(_mix(total)))
        return out


class Sketcher:
    """MinHash bands and odd sketches of shingle sets."""

    def __init__(self, shape: Shape):
        rng = np.random.default_rng(shape.seed + 1)
        self.shape, self.samples = shape, shape.bands * shape.rows
        self.factors = rng.integers(0, 1 << 31, self.samples, np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = rng.integers(0, 1 << 32, self.samples, np.int64).astype(np.uint32)
        self.salts = rng.integers(0, 1 << 63, self.samples, np.int64).astype(np.uint64)

    def minima(self, sets: list[np.ndarray]) -> np.ndarray:
        """texts x samples; the sets have a member each."""
        out = np.empty((len(sets), self.samples), np.uint32)
        at = 0
        while at < len(sets):
            # A run of sets that fits a processor's cache.
            end, size = at, 0
            while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 15):
                size += len(sets[end])
                end += 1
            x = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
            starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:end]])[:-1]])
            for j in range(self.samples):
                out[at:end, j] = np.minimum.reduceat(x * self.factors[j] + self.shifts[j], starts)
            at = end
        return out

    def bands(self, minima: np.ndarray) -> np.ndarray:
        """A key per text and band; keys of different bands differ."""
        parts = minima.reshape(len(minima), self.shape.bands, self.shape.rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(self.shape.bands, dtype=np.uint64), parts.shape[:2]).copy()
        for k in range(self.shape.rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
        return key.view(np.int64)

    def odd(self, minima: np.ndarray) -> np.ndarray:
        """texts x bits / 64: every sample flips one bit."""
        bits = self.shape.bits
        place = (_mix(minima.astype(np.uint64) + self.salts) % np.uint64(bits)).astype(np.int64)
        flat = np.bincount((place + np.arange(len(minima))[:, None] * bits).ravel(), minlength=len(minima) * bits)
        odd = (flat.reshape(len(minima), bits // 64, 64) & 1).astype(np.uint64)
        return (odd << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)

    def most_bits(self) -> int:
        """The XOR count beyond which the estimate falls short of the threshold by more than the margin.

        Of n samples, n(1 - s) differ, which makes 2n(1 - s) flips over the two sketches; a bit is odd after m flips with
        probability (1 - (1 - 2/bits)^m) / 2.
        """
        flips = 2 * self.samples * (1 - self.shape.hundredths / 100 + self.shape.margin)
        return int(np.ceil(self.shape.bits * (1 - (1 - 2 / self.shape.bits) ** flips) / 2))


def sketched(docs: DataFrame, shape: Shape) -> DataFrame:
    """doc_id, n_shingles, the set's two-part name (null when empty), bands and sketch of every row."""
    def rows(keys, values):
        shingler, sketcher = Shingler(shape.words, shape.seed), Sketcher(shape)
        sets = shingler(values)
        sizes = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        names = np.zeros((2, len(sets)), np.uint64)
        for i in full:
            names[0, i] = sets[i].sum(dtype=np.uint64)
            names[1, i] = _mix(sets[i] + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
        bands = np.zeros((len(full), shape.bands), np.int64)
        odd = np.zeros((len(full), shape.bits // 64), np.int64)
        if len(full):
            minima = sketcher.minima([sets[i] for i in full])
            bands, odd = sketcher.bands(minima), sketcher.odd(minima)
        empty = sizes == 0
        names = names.view(np.int64)
        return {
            "doc_id": keys, "n_shingles": sizes,
            "name_a": pa.array(names[0], mask=empty), "name_b": pa.array(names[1], mask=empty),
            "bands": list_array(bands.ravel(), np.where(empty, 0, shape.bands), pa.int64()),
            "odd": list_array(odd.ravel(), np.where(empty, 0, shape.bits // 64), pa.int64()),
        }

    return map_texts(docs, rows, "doc_id long, n_shingles long, name_a long, name_b long, "
                     "bands array<long>, odd array<long>", binary=True)


def _sizes_allow(hundredths: int, x: str, y: str):
    """Whether sets of these sizes can be so alike."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * hundredths


def _sketches_allow(most: int, words: int, x: str, y: str):
    """Whether the two sketches' XOR has few enough bits."""
    count = None
    for i in range(words):
        one = F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i]))
        count = one if count is None else count + one
    return count <= most


def full_sets(ids: DataFrame, docs: DataFrame, shape: Shape) -> DataFrame:
    """id and members (the set's sorted hashes, as bytes) of the documents that `ids` (id) names; their texts are read again."""
    named = small(stored(ids.distinct(), "near-named"), BROADCAST_IDS)
    texts = docs.join(named, docs.doc_id == named.id, "left_semi").dropDuplicates(["doc_id"])

    def rows(keys, values):
        return {"id": keys, "members": [s.tobytes() for s in Shingler(shape.words, shape.seed)(values)]}

    return stored(map_texts(texts, rows, "id long, members binary", binary=True), "near-sets")


def alike(x: np.ndarray, y: np.ndarray, hundredths: int) -> bool:
    """Whether two sorted sets are alike enough."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return False
    place = np.searchsorted(y, x)
    shared = int((y[np.minimum(place, len(y) - 1)] == x).sum())
    return 100 * shared >= hundredths * (len(x) + len(y) - shared)


def confirm(pairs: DataFrame, docs: DataFrame, shape: Shape) -> DataFrame:
    """Those of the pairs (a, b: doc_ids) whose full sets are alike enough."""
    sets = full_sets(pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))), docs, shape)
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")

    def compare(batches):
        for batch in batches:
            keep = [i for i in range(batch.num_rows) if alike(
                np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64),
                np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64), shape.hundredths)]
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])
        give_back()

    return both.mapInArrow(compare, "a long, b long")


def open_members(keyed: DataFrame, found: DataFrame, heads: DataFrame) -> DataFrame:
    """key, rep, component, n, odd of the classes of each key that holds classes of several components."""
    marked = keyed.join(found, keyed.rep == found.node, "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    several = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return stored(marked.join(several.select("key"), "key").join(heads.select("rep", "n", "odd"), "rep"), "near-open")


def _tiled(members: DataFrame, columns: list[str], tile: int) -> DataFrame:
    """The members with their group: a key's classes fall into tiles, and every pair of its tiles is a group.

    Keys of one tile share groups, of some `tile` rows.
    """
    counts = members.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    shared = max(members.count() // tile, 1)
    cut = members.join(counts, "key").withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return cut.select(
        "key", "tile", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), *columns,
        F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("key"), F.lit(shared))).otherwise(
            F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other"))).alias("bin"))


def _near_pairs(part: pd.DataFrame, lo: int, hi: int, most: int, hundredths: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows x, y of different components whose sizes and sketches allow the threshold, and their XOR counts."""
    tiles, n, component = part["tile"].to_numpy(), part["n"].to_numpy(), part["component"].to_numpy()
    odd = np.array(part["odd"].tolist(), np.int64).view(np.uint8)
    bits = np.unpackbits(odd, axis=1).astype(np.float32) * 2 - 1
    first, second = np.flatnonzero(tiles == lo), np.flatnonzero(tiles == hi)
    apart = (bits.shape[1] - bits[first] @ bits[second].T) / 2
    fit = np.minimum(n[first][:, None], n[second]) * 100 >= np.maximum(n[first][:, None], n[second]) * hundredths
    fit &= (apart <= most) & (component[first][:, None] != component[second])
    if lo == hi:
        fit &= first[:, None] < second
    i, j = np.nonzero(fit)
    return first[i], second[j], apart[i, j]


def active_members(members: DataFrame, shape: Shape, tile: int = 512) -> DataFrame:
    """Those of the open members that a class of another component may be alike to, within their key."""
    most = Sketcher(shape).most_bits()

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (key, lo, hi), part in rows.groupby(["key", "lo", "hi"], sort=False):
            x, y, _ = _near_pairs(part, lo, hi, most, shape.hundredths)
            reps = part["rep"].to_numpy()[np.unique(np.concatenate([x, y]))]
            out.append(pd.DataFrame({"key": np.full(len(reps), key), "rep": reps}))
        return pd.concat(out)

    found = _tiled(members, ["rep", "component", "n", "odd"], tile).groupBy("bin").applyInPandas(compare, "key long, rep long")
    return stored(members.join(found.distinct(), ["key", "rep"]), "near-active")


def close(members: DataFrame, docs: DataFrame, shape: Shape, tile: int = 512) -> DataFrame:
    """Links (a, b) that join all of the members (key, rep, component, n, odd) of a key that are joined by pairs alike enough.

    Within a group pairs are taken by their estimate, and a pair that others have joined already isn't compared. So a group
    gives fewer links than it has members.
    """
    most = Sketcher(shape).most_bits()
    sets = full_sets(members.select(F.col("rep").alias("id")), docs, shape).withColumnRenamed("id", "rep")
    tiled = _tiled(members, ["rep", "component", "n", "odd"], tile).join(sets, "rep")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        links = []
        for (_, lo, hi), part in rows.groupby(["key", "lo", "hi"], sort=False):
            x, y, apart = _near_pairs(part, lo, hi, most, shape.hundredths)
            reps, component = part["rep"].tolist(), part["component"].tolist()
            sets = [np.frombuffer(m, np.uint64) for m in part["members"]]
            parent = {c: c for c in component}

            def root(c):
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            for k in np.argsort(apart, kind="stable"):
                i, j = x[k], y[k]
                one, two = root(component[i]), root(component[j])
                if one != two and alike(sets[i], sets[j], shape.hundredths):
                    parent[max(one, two)] = min(one, two)
                    links.append((reps[i], reps[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return tiled.groupBy("bin").applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs` (doc_id, text)."""
    docs = plain(docs, "doc_id", "text")
    most, longs = Sketcher(shape).most_bits(), shape.bits // 64
    rows = stored(sketched(docs, shape), "near-sketches")

    classes = rows.where("name_a is not null and doc_id is not null").groupBy("name_a", "name_b").agg(
        F.min("doc_id").alias("rep"))
    classes = stored(classes, "near-classes")
    # One row of each class; rows repeated with their doc_id count once.
    heads = rows.join(classes.select("rep", F.col("name_a").alias("na"), F.col("name_b").alias("nb")),
                      (F.col("doc_id") == F.col("rep")) & (F.col("name_a") == F.col("na"))
                      & (F.col("name_b") == F.col("nb")))
    heads = heads.select("rep", F.col("n_shingles").alias("n"), "bands", "odd")
    heads = stored(heads.dropDuplicates(["rep"]), "near-heads")

    keyed = heads.select("rep", F.explode("bands").alias("key"))
    shared = stored(keyed.groupBy("key").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1").select(
        "key", "first"), "near-keys")
    keyed = stored(keyed.join(shared, "key").select("key", "rep", "first"), "near-members")

    sketches = heads.select("rep", "n", "odd")
    stars = keyed.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    stars = stars.join(sketches.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("odd").alias("odd_a")), "a")
    stars = stars.join(sketches.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("odd").alias("odd_b")), "b")
    stars = stored(stars.where(_sizes_allow(shape.hundredths, "n_a", "n_b") & _sketches_allow(
        most, longs, "odd_a", "odd_b")).select("a", "b"), "near-stars")
    links = stored(confirm(stars, docs, shape), "near-links")
    found = stored(components(links, "a", "b"), "near-components")

    # First each open class in its largest key, which joins most of a large group, then whatever is left in every key.
    active = active_members(open_members(keyed, found, heads), shape)
    sizes = active.groupBy("key").agg(F.count("*").alias("size"))
    largest = active.join(sizes, "key").groupBy("rep").agg(F.max(F.struct("size", "key")).alias("k")).select(
        "rep", F.col("k.key").alias("key"))
    links = stored(links.unionAll(close(stored(active.join(largest, ["rep", "key"]), "near-first"), docs, shape)), "near-links")
    found = stored(components(links, "a", "b"), "near-components")
    active = active_members(open_members(keyed, found, heads), shape)
    found = components(links.unionAll(close(active, docs, shape)), "a", "b")

    named = rows.where("name_a is not null and doc_id is not null").select(
        "doc_id", "n_shingles", "name_a", "name_b").join(classes, ["name_a", "name_b"]).join(
        found, F.col("rep") == found.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    # An empty set, or a row without doc_id, stands for itself.
    alone = rows.where("name_a is null or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionAll(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
