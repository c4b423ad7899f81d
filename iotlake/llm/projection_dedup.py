"""Near-duplicate vectors by sorted projection passes.

1. Equal vectors collapse into a class, named by the smallest vec_id and counted.
2. In each pass a class gets a 62-bit number whose bits say on which side of 62 random directions it lies
   (directions of a pass are orthogonal in runs, which lowers the variance of the angle). All passes are sorted at once, by
   (pass, number, id), and every class is compared with the `window` classes before and after it. Vectors at a small angle
   agree in long runs of leading bits, so they stand close together in some pass.
3. The passes carry unit vectors rounded to 16 bits a component. That settles all pairs but those within the rounding's bound of the
   threshold. A block of the sorted order unites the pairs that are sure and reports each class's link to
   its component within the block, so that gives no more rows than it has; of the pairs in question it reports those that would join two
   of its components, and these are verified in double precision.
4. Within each component all classes are compared, in blocks of classes against blocks. That counts every link of a
   group, however large it is and however far apart the passes put its members: the window is no cap on partners.

Recall: two vectors at the threshold's angle a agree in m leading bits with probability p^m, p = 1 - a / pi. Of n classes some
n / 2^m share m bits if they lie evenly, and so many passes are made first, with m = log2(n / window). Where vectors crowd, more share
them: every class therefore measures how many bits it shares with the classes at its window's two edges, beyond which a partner is seen.
Classes that would miss a partner with a probability above `miss`, by what they measured, go through further passes among themselves
(a partner that is not crowded has seen them already), or are all compared in tiles where that costs less.

Defined results: a null or zero vector, or one with null or non-finite components, is linked with nothing and kept; vectors
of different lengths are never linked; rows that repeat a vec_id count as copies; a row without vec_id has a null component and
is kept; an empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iotlake.llm.components import components
from iotlake.llm.tables import plain, stored, prepare


@dataclass(frozen=True)
class Shape:
    cosine: float = 0.9
    window: int = 96
    #: Rows of the sorted order that one task's step takes, besides the window after them.
    block: int = 2_048
    miss: float = 1e-3
    least_passes: int = 12
    bits: int = 62
    seed: int = 5


def passes_for(n: int, shape: Shape) -> int:
    """How many passes miss a pair at the threshold with probability shape.miss at most."""
    agree = (1 - acos(shape.cosine) / pi) ** max(log2(max(n, 2) / shape.window), 1)
    return max(shape.least_passes, ceil(log(shape.miss) / log(1 - agree)))


def directions(width: int, one: int, shape: Shape) -> np.ndarray:
    """bits x width random directions of a pass, orthogonal within runs of `width`."""
    rng = np.random.default_rng([shape.seed, one])
    out = []
    while len(out) < shape.bits:
        out += list(np.linalg.qr(rng.normal(size=(width, width)))[0].T)
    return np.array(out[: shape.bits])


def _unit(packed: list, kind=np.float64) -> np.ndarray:
    """Unit-length rows of vectors given as bytes of doubles, all of one length."""
    rows = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    # Scaled by the largest component first, so that no square overflows or vanishes.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(kind)


#: What a component of 1 is rounded to in a pass.
ONE = 32_767


def _coarse(unit: np.ndarray) -> list[bytes]:
    """Unit vectors with their components rounded to 16 bits."""
    return [row.tobytes() for row in np.rint(unit * ONE).astype(np.int16)]


def _rounded(coarse: list) -> tuple[np.ndarray, float]:
    """The vectors behind such bytes, all of one length, and a bound of what two of them miss of their cosine.

    Rounding moves a vector by half a step in each component at most, so by sqrt(width) of those; the rest is for sums in single precision.
    """
    rows = np.frombuffer(b"".join(coarse), np.int16).reshape(len(coarse), -1).astype(np.float32) / np.float32(ONE)
    width = rows.shape[1]
    moved = width ** 0.5 / (2 * ONE)
    return rows, moved * (2 + moved) + (width + 8) * 2.0 ** -23


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and packed: the components as bytes of doubles; null where the vector can't be compared."""
    def run(batches):
        for batch in batches:
            column = batch.column(1)
            ends = np.cumsum(np.asarray(pc.list_value_length(column).fill_null(0)), dtype=np.int64)
            starts = np.concatenate([[0], ends])[:-1]
            # A null component comes as no number. -0.0 + 0.0 is 0.0: equal vectors have equal bytes.
            values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0
            bad, other = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(values), values != 0))
            known = (bad[ends] == bad[starts]) & (other[ends] > other[starts])
            packed = [values[i:j].tobytes() if ok else None for i, j, ok in zip(starts, ends, known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["vec_id", "packed"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, packed binary")


def _sorted_passes(classes: DataFrame, first: int, n_passes: int, shape: Shape) -> DataFrame:
    """rep, coarse, number and position (pass, rank) of every class in every pass from the first on."""
    def run(batches):
        known: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                reps, packed = part.column(0).to_pylist(), part.column(1).to_pylist()
                sizes = np.array([len(x) for x in packed])
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    unit = _unit([packed[i] for i in rows])
                    coarse = pa.array(_coarse(unit), pa.binary())
                    for one in range(first, first + n_passes):
                        if (size, one) not in known:
                            known[size, one] = directions(unit.shape[1], one, shape)
                        side = (unit @ known[size, one].T > 0).astype(np.int64)
                        number = (side << np.arange(shape.bits - 1, -1, -1)).sum(axis=1)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([one] * len(rows), pa.int32()), pa.array(number), pa.array([reps[i] for i in rows], pa.int64()), coarse],
                            names=["pass", "number", "rep", "coarse"])

    hashed = classes.select("rep", "packed").mapInArrow(run, "pass int, number long, rep long, coarse binary")
    ordered = hashed.repartitionByRange("pass", "number", "rep").sortWithinPartitions("pass", "number", "rep").select(
        "rep", "pass", "number", "coarse", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    ordered = stored(ordered, "passes-sorted")
    # A number per partition reaches the driver.
    counts = {r.part: (r.n, r.low) for r in ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("row").alias("low")).collect()}
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total - counts[part][1]))
        total += counts[part][0]
    if not offsets:
        return ordered.select("rep", "pass", "number", "coarse", F.lit(0).cast("long").alias("rank"))
    shift = ordered.sparkSession.createDataFrame(offsets, "part int, shift long")
    return ordered.join(F.broadcast(shift), "part").select("rep", "pass", "number", "coarse", (F.col("row") + F.col("shift")).alias("rank"))


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest index that each of n is linked with, directly or not."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[x], root[y])
        after = root.copy()
        np.minimum.at(after, x, least)
        np.minimum.at(after, y, least)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _shared_bits(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """How many leading bits two numbers share."""
    apart = x ^ y
    # In halves, as a double holds 53 bits.
    high, low = apart >> 31, apart & ((1 << 31) - 1)
    return bits - np.where(high > 0, 31 + np.frexp(high.astype(float))[1], np.frexp(low.astype(float))[1])


def _log_missed(number: np.ndarray, kind: np.ndarray, shape: Shape) -> np.ndarray:
    """For each of the sorted numbers the logarithm of the chance that its window misses a partner at the threshold.

    A partner that first differs at bit m stands before or after by the number's own bit m; it is within the window if the number
    shares fewer than m bits with the edge on that side. Numbers of another `kind` (pass) are no edge.
    """
    bits, w, n = shape.bits, shape.window, len(number)
    before, after = np.full(n, -1), np.full(n, -1)
    if n > w:
        same = kind[w:] == kind[:-w]
        shared = np.where(same, _shared_bits(number[w:], number[:-w], bits), -1)
        before[w:], after[:-w] = shared, shared
    p = 1 - acos(shape.cosine) / pi
    m = np.arange(bits)
    side = (number[:, None] >> (bits - 1 - m)) & 1
    seen = m > np.where(side == 1, before[:, None], after[:, None])
    found = seen @ (p ** m * (1 - p)) + p ** bits * (np.maximum(before, after) < bits)
    return np.log1p(-np.minimum(found, 1 - 1e-12))


def found_links(classes: DataFrame, first: int, n_passes: int, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that join the classes within each block of each sorted order; rep and log_missed of every class over the passes."""
    block, window, cosine = shape.block, shape.window, shape.cosine
    ordered = _sorted_passes(classes, first, n_passes, shape)
    # Every row is in its own block, and in those before and after if their windows reach it.
    own = F.floor(F.col("rank") / block)
    placed = ordered.withColumn("block", F.explode(F.array_compact(F.array(
        own, F.when((F.col("rank") % block < window) & (own > 0), own - 1), F.when(F.col("rank") % block >= block - window, own + 1)))))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        sizes = rows["coarse"].map(len).to_numpy()
        missed = _log_missed(rows["number"].to_numpy(), rows["pass"].to_numpy(), shape)
        mine = (rows["rank"] // block == rows["block"]).to_numpy()
        out = [pd.DataFrame({"a": rows["rep"][mine], "b": None, "log_missed": missed[mine]})]
        for (_, _), part in rows.groupby([rows["pass"], sizes], sort=False):
            unit, slack = _rounded(part["coarse"].tolist())
            rank, reps = part["rank"].to_numpy(), part["rep"].to_numpy()
            xs, ys, known = [], [], []
            for at in range(0, len(part), 256):
                near = unit[at:at + 256] @ unit[at:at + 256 + window].T
                i, j = np.nonzero(near >= cosine - slack)
                keep = (j > i) & (rank[at + j] - rank[at + i] <= window)
                i, j = i[keep], j[keep]
                xs.append(at + i)
                ys.append(at + j)
                known.append(near[i, j] >= cosine + slack)
            x, y, sure = np.concatenate(xs), np.concatenate(ys), np.concatenate(known)
            order = np.argsort(reps)
            place = np.empty(len(reps), np.int64)
            place[order] = np.arange(len(reps))
            x, y = place[x], place[y]
            root = _roots(len(reps), x[sure], y[sure])
            linked = np.flatnonzero(root != np.arange(len(root)))
            out.append(pd.DataFrame({"a": reps[order][root[linked]], "b": reps[order][linked], "sure": True}))
            x, y = x[root[x] != root[y]], y[root[x] != root[y]]
            out.append(pd.DataFrame({"a": reps[order][np.minimum(x, y)], "b": reps[order][np.maximum(x, y)], "sure": False}))
        return pd.concat([x.reindex(columns=["a", "b", "log_missed", "sure"]).astype(
            {"b": "Int64", "log_missed": "Float64", "sure": "boolean"}) for x in out])

    found = stored(placed.groupBy("block").applyInPandas(compare, "a long, b long, log_missed double, sure boolean"), "passes-found")
    pairs = found.where("b is not null").groupBy("a", "b").agg(F.bool_or("sure").alias("sure"))
    links = pairs.where("sure").select("a", "b").unionAll(verified(pairs.where("not sure").select("a", "b"), classes, cosine))
    return (stored(links, "passes-links"),
            found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("log_missed").alias("log_missed")))


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) of classes whose vectors have at least this cosine in double precision."""
    vectors = classes.select("rep", "packed")
    both = pairs.join(vectors.select(F.col("rep").alias("a"), F.col("packed").alias("x")), "a").join(
        vectors.select(F.col("rep").alias("b"), F.col("packed").alias("y")), "b")

    def run(batches):
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            sizes, near = np.array([len(v) for v in x]), np.zeros(len(x), bool)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                near[rows] = (_unit([x[i] for i in rows]) * _unit([y[i] for i in rows])).sum(axis=1) >= cosine
            yield batch.select([0, 1]).filter(pa.array(near))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def all_links(classes: DataFrame, shape: Shape, tile: int = 4_096) -> DataFrame:
    """Pairs (a, b) that join all classes at the threshold, from all pairs of tiles."""
    cosine, tiles = shape.cosine, max(-(-classes.count() // tile), 1)
    cut = classes.select("rep", "packed", F.pmod(F.xxhash64("rep"), F.lit(tiles)).alias("tile"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long")))).select(
        "rep", "packed", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": []}, dtype="int64")]
        for _, part in rows.sort_values("rep").groupby(rows["packed"].map(len), sort=False):
            unit, reps = _unit(part["packed"].tolist()), part["rep"].to_numpy()
            root, every = np.arange(len(reps)), np.arange(len(reps))
            for at in range(0, len(reps), 256):
                i, j = np.nonzero(unit[at:at + 256] @ unit[at:].T >= cosine)
                root = _roots(len(reps), np.concatenate([every, at + i]), np.concatenate([root, at + j]))
            linked = np.flatnonzero(root != every)
            out.append(pd.DataFrame({"a": reps[root[linked]], "b": reps[linked]}))
        return pd.concat(out)

    return cut.groupBy("lo", "hi").applyInPandas(compare, "a long, b long").distinct()


def joining_links(classes: DataFrame, shape: Shape) -> DataFrame:
    """Pairs (a, b) from passes over all classes, then from passes or all pairs of those that crowd."""
    n_passes, first = passes_for(classes.count(), shape), 0
    rest, links = classes.select("rep", "packed", F.lit(log(shape.miss)).alias("left")), None
    while True:
        found, missed = found_links(rest, first, n_passes, shape)
        links = found if links is None else links.unionAll(found)
        first += n_passes
        rest = stored(rest.join(missed, "rep").withColumn("left", F.col("left") - F.col("log_missed")).where("left < 0"), "vectors-crowded")
        more = F.when(F.col("log_missed") < 0, F.ceil(F.col("left") * n_passes / F.col("log_missed"))).otherwise(1e9)
        n, n_passes = rest.agg(F.count("*"), F.percentile_approx(more, 0.9)).first()
        if not n:
            return links.distinct()
        # A pass takes some four windows of comparisons a class, with its sorting.
        if n_passes * 4 * shape.window * 2 >= n:
            return links.unionAll(all_links(rest, shape)).distinct()
        n_passes, rest = int(n_passes), rest.select("rep", "packed", "left")


def count_links(members: DataFrame, shape: Shape, tile: int = 1_024) -> DataFrame:
    """rep and n_other, the vectors of other classes at the threshold, over all pairs of each component.

    `members`: rep, packed, copies and component. Components are cut into tiles of about `tile` classes, and every pair of tiles is a
    group of its own; only counts leave a group.
    """
    cosine = shape.cosine
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    cut = members.join(sizes, "component").withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    # Small components share a group, some `tile` classes of them; a tile of a large one meets every tile of it.
    bins = max(members.count() // tile, 64)
    pairs = cut.withColumn("other", F.explode(every)).select(
        "component", "rep", "packed", "copies",
        F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile")
    pairs = pairs.withColumn("bin", F.when(F.col("hi") == 0, F.pmod(F.xxhash64("component"), F.lit(bins))).otherwise(
        F.xxhash64("component", "lo", "hi")))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, lo, hi), part in rows.groupby(["component", "lo", "hi"], sort=False):
            lengths = part["packed"].map(len)
            for _, same in part.groupby(lengths, sort=False):
                unit, copies = _unit(same["packed"].tolist()), same["copies"].to_numpy()
                tiles = same["tile"].to_numpy()
                first, second = np.flatnonzero(tiles == lo), np.flatnonzero(tiles == hi)
                near = unit[first] @ unit[second].T >= cosine
                if lo == hi:
                    np.fill_diagonal(near, False)
                    out.append((same["rep"].to_numpy()[first], near @ copies[second]))
                else:
                    out.append((same["rep"].to_numpy()[first], near @ copies[second]))
                    out.append((same["rep"].to_numpy()[second], near.T @ copies[first]))
        return pd.DataFrame({"rep": np.concatenate([r for r, _ in out]), "n": np.concatenate([n for _, n in out])})

    counted = pairs.groupBy("bin").applyInPandas(compare, "rep long, n long")
    return counted.groupBy("rep").agg(F.sum("n").alias("n_other"))


def near_duplicates(vectors: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding)."""
    prepare(vectors.sparkSession)
    rows = stored(usable(plain(vectors, "vec_id", "embedding")), "vectors")
    known = rows.where("packed is not null and vec_id is not null")
    classes = stored(known.groupBy("packed").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    links = joining_links(classes, shape)
    found = stored(components(links, "a", "b"), "vector-components")
    members = stored(classes.join(found, classes.rep == found.node).select("rep", "packed", "copies", "component"), "vector-members")
    counted = count_links(members, shape)
    named = classes.join(members.select("rep", "component"), "rep", "left").join(counted, "rep", "left").select(
        "packed", "rep", "copies", F.coalesce("component", "rep").alias("component_id"), F.coalesce("n_other", F.lit(0)).alias("n_other"))
    out = known.join(named, "packed").select(
        "vec_id", (F.col("copies") - 1 + F.col("n_other")).alias("n_links"), "component_id")
    alone = rows.where("packed is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
