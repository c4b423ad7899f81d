"""Conversation structure repair: the cheapest edits that make a conversation's roles legal, by the auction shortest-path algorithm.

Roles are read by their first letter; a legal conversation is empty, or a system row at most, then user and assistant rows in
turn, ending with the assistant. A path through the lattice of (row, state) is a list of edits: Keep (0), Rerole to user or
assistant (2), Delete (3; a must for blank and repeated rows), Insert an empty user or assistant row (2); a truncated row
that stays costs 1 more.

The auction (Bertsekas, 1991) keeps a price for each node and a path. At the path's last node it takes the least of arc cost plus the
next node's price: if that is more than the node's price, the price rises to it and the path contracts by one node; else the path
extends along the first arc, in ASCII order of the edits' initials, that attains it. Origins are taken from the end of the lattice to its start with
all prices kept, and a path ends where it meets a node whose price has converged, as a distance has. Arcs whose cost is the difference of
converged prices are tight; the trace from the start takes the first tight arc at each node, which gives the ASCII-least of
the cheapest lists.

A conversation of any length is spread over tasks. Rows are sorted over the whole table and cut into chunks of at most 1024 rows of one conversation.
Auctions to each exit state give a chunk's matrix of costs from entry state to exit state; min-plus products of the matrices, over runs of 1024 and runs
of runs, give the price of each state at each boundary, and so the exit prices of each chunk. What state the trace enters a
chunk in comes from the chunks' maps in the same way, and each chunk is then traced on its own.

Defined results: a null role or text is one space; rows are in order of (turn, nulls first; role; text, by its first 64 characters and its MD5).
A null conv_id is a conversation like any other; a null turn is no turn for the gaps. Repeated rows are duplicates, but for the first.
Roles that start with another letter, or are empty, are never legal as they are. An empty table has no conversations. Further columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from iotlake.llm.tables import plain, prepare, stored

#: Rows of a chunk, and chunks of a run, as a power of two.
SHIFT = 10
FAR = 1 << 40
SPACES = " \t\n\x0b\f\r"

#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The state after a user or assistant row that an edit may choose.
FOLLOWS = (USER, USER, ASSISTANT, USER)
#: States that a conversation may end in, as costs.
ENDS = [0, FAR, FAR, 0]
#: The state after a kept row, by its initial and the state before.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
CHOSEN = {USER: "user", ASSISTANT: "assistant"}


class Auction:
    """Prices of the lattice of one chunk.

    initials: a letter a row. faults: a letter a row: b blank, d duplicate, t truncated, k none. exits: the price of each
    state after the last row. last: whether rows may be inserted there too; else the next chunk does.
    """

    def __init__(self, initials: str, faults: str, exits: list[int], last: bool):
        self.initials, self.faults, self.exits, self.last = initials, faults, exits, last
        self.n = len(initials)
        self.end = (self.n + 1) * STATES
        # States lead to themselves and later ones, a user row's and an assistant row's to each other.
        ways = [min(exits), min(exits[SYSTEM:]), min(exits[USER:]), min(exits[USER:])]
        self.price, done = [0] * (self.end + 1), [False] * self.end + [True]
        for i in range(self.n, -1, -1):
            at = i * STATES
            # No arc leads below the least price of the next row: prices that keep every arc's cost.
            least = 0 if i == self.n else min(self.price[at + STATES:at + 2 * STATES])
            for state in range(STATES):
                done[at + state] = ways[state] >= FAR
                self.price[at + state] = FAR if done[at + state] else least
            for state in reversed(range(STATES)):
                self._settle(at + state, done)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """(edit, cost, next node) in ASCII order of the edits."""
        i, state = divmod(node, STATES)
        if i == self.n:
            out = [("", self.exits[state], self.end)]
            return out + [("I", 2, i * STATES + FOLLOWS[state])] if self.last else out
        below, fault = (i + 1) * STATES, self.faults[i]
        out = [("D", 3, below + state), ("I", 2, i * STATES + FOLLOWS[state])]
        if fault in "kt":
            stays = int(fault == "t")
            kept = KEPT.get(self.initials[i], {}).get(state)
            if kept is not None:
                out.append(("K", stays, below + kept))
            out.append(("R", 2 + stays, below + FOLLOWS[state]))
        return out

    def _settle(self, origin: int, done: list[bool]) -> None:
        """One auction: makes the origin's price its distance to the end."""
        price, path = self.price, [origin]
        while not done[path[-1]]:
            node = path[-1]
            least, to = FAR, -1
            for _, cost, there in self.arcs(node):
                if cost + price[there] < least:
                    least, to = cost + price[there], there
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            elif to < 0:
                # No way to the end: as far as can be.
                break
            else:
                path.append(to)
        for node in path:
            done[node] = True

    def trace(self, state: int) -> tuple[str, int, int]:
        """(edits, cost without what lies behind the exit, exit state) of the first tight arcs from the chunk's start."""
        node, edits, cost = state, [], 0
        while node < self.n * STATES or self.last:
            edit, c, node_ = next(a for a in self.arcs(node) if a[1] + self.price[a[2]] == self.price[node])
            if node_ == self.end:
                break
            edits.append(edit)
            cost, node = cost + c, node_
        return "".join(edits), cost, node % STATES


def chunk_matrix(initials: str, faults: str, last: bool) -> list[int]:
    """Costs from each entry state to each exit state, row by row."""
    columns = [Auction(initials, faults, [0 if q == e else FAR for q in range(STATES)], last).price[:STATES] for e in range(STATES)]
    return [columns[e][q] for q in range(STATES) for e in range(STATES)]


def chunk_map(initials: str, faults: str, exits: list[int], last: bool) -> list[int]:
    """The matrix that is 0 from each entry state to the exit state of its trace, and FAR elsewhere."""
    found = Auction(initials, faults, exits, last)
    out = [FAR] * STATES ** 2
    for q in range(STATES):
        if found.price[q] < FAR:
            out[q * STATES + found.trace(q)[2]] = 0
    return out


def product(a, b) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), FAR)


def _square(m) -> np.ndarray:
    return np.asarray(m, np.int64).reshape(STATES, STATES)


def boundaries(items: DataFrame, outer: list[int], forward: bool) -> DataFrame:
    """(k, at, v): the vector at each item's boundary: `outer` times all matrices of the conversation before it (forward) or behind it.

    items: k, at (order), m. Runs of 2**SHIFT numbers of `at` are one group at most; if a conversation has more, products of runs go through the same.
    """
    items = items.select("k", "at", "m", F.expr(f"shiftright(at, {SHIFT})").alias("run"))
    if (items.groupBy("k").count().agg(F.max("count")).first()[0] or 0) <= 1 << SHIFT:
        runs = items.withColumns({"run": F.lit(0).cast("long"), "outer": F.lit(outer).cast("array<long>")})
    else:
        def multiplied(rows: pd.DataFrame) -> pd.DataFrame:
            total = None
            for m in rows.sort_values("at").m:
                total = _square(m) if total is None else product(total, _square(m))
            return pd.DataFrame({"k": [rows.k.iloc[0]], "at": [rows.run.iloc[0]], "m": [total.ravel()]})

        above = stored(items.groupBy("k", "run").applyInPandas(multiplied, "k string, at long, m array<long>"), "turn-runs")
        found = boundaries(above, outer, forward)
        runs = items.join(found.select("k", F.col("at").alias("run"), F.col("v").alias("outer")), ["k", "run"])

    def scanned(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", ascending=forward)
        v, out = np.asarray(rows.outer.iloc[0], np.int64), []
        for m in rows.m:
            out.append(v)
            v = (v[:, None] + _square(m)).min(axis=0) if forward else (_square(m) + v[None]).min(axis=1)
            v = np.minimum(v, FAR)
        return pd.DataFrame({"k": rows.k, "at": rows["at"], "v": out})

    return stored(runs.groupBy("k", "run").applyInPandas(scanned, "k string, at long, v array<long>"), "turn-bounds")


def ordered(rows: DataFrame) -> DataFrame:
    """k, conv_id, turn, role, text, digest and pos: numbers in the order of the rows, without a gap inside a task's share."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    keyed = plain(rows, "conv_id", "turn", "role", "text").select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("k"), "conv_id", "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.md5(text).alias("digest"))
    # The last key deals copies of one row out too; copies may stand in any order.
    order = ["k", F.asc_nulls_first("turn"), "role", "head", "digest", "copy"]
    spread = keyed.withColumns({"head": F.substring("text", 1, 64), "copy": F.monotonically_increasing_id()})
    sorted_ = spread.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_.drop("head", "copy").withColumn("pos", F.monotonically_increasing_id()), "turns")


def with_faults(turns: DataFrame) -> DataFrame:
    """k, conv_id, turn, pos, initial and fault of each row."""
    shown = F.rtrim(F.col("text"), F.lit(SPACES))
    own = turns.select(
        "k", "conv_id", "turn", "pos", "role", "digest", F.substring("role", 1, 1).alias("initial"),
        (F.length(shown) == 0).alias("blank"), (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # Only texts that a conversation repeats; one row each, so Spark may split the rows that meet it.
    first = own.where("not blank").groupBy("k", "role", "digest").agg(
        F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return own.join(first, ["k", "role", "digest"], "left").select(
        "k", "conv_id", "turn", "pos", F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-").alias("initial"),
        F.when(F.col("blank"), "b").when(F.col("pos") > F.col("first"), "d").when(F.col("cut"), "t").otherwise("k").alias("fault"))


def _letters(rows: Column, name: str) -> Column:
    return F.array_join(F.transform(rows, lambda r: r[name]), "")


def _each(function, kind: str, *columns: str) -> Column:
    """A column of function(values of a row)."""
    @F.pandas_udf(kind)
    def run(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([function(*r) for r in rows.itertuples(index=False, name=None)], dtype=object)

    return run(F.struct(*columns))


def _traced(initials: str, faults: str, first: int, exits, entry: int, last: bool) -> tuple:
    """(edits, cost, neighbours that may not follow each other, places of the rows that stay or None, their new roles or None)."""
    edits, cost, _ = Auction(initials, faults, list(exits), last).trace(entry)
    state, at, places, roles = entry, first, [], []
    for edit in edits:
        if edit == "D":
            at += 1
            continue
        state = KEPT[initials[at - first]][state] if edit == "K" else FOLLOWS[state]
        places.append(None if edit == "I" else at)
        roles.append(None if edit == "K" else CHOSEN[state])
        at += edit != "I"
    bad = sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
    return edits, cost, bad, places, roles


def solved(chunks: DataFrame) -> DataFrame:
    """The chunks (k, chunk, first, initials, faults) with the edits of each, and what they keep."""
    prepare(chunks.sparkSession)
    several = chunks.groupBy("k").agg(F.count("*").alias("n"), F.max("chunk").alias("newest")).where("n > 1").drop("n")
    several = stored(several, "long-conversations")
    one = F.lit(ENDS).cast("array<long>").alias("exits")
    alone = chunks.join(several, "k", "left_anti").select("*", one, F.lit(START).cast("long").alias("entry"), F.lit(True).alias("last"))
    if several.isEmpty():
        ready = alone
    else:
        long = stored(chunks.join(several, "k").withColumn("last", F.col("chunk") == F.col("newest")).drop("newest"), "long-chunks")
        matrices = stored(long.select("k", F.col("chunk").alias("at"), _each(
            chunk_matrix, "array<long>", "initials", "faults", "last").alias("m")), "chunk-matrices")
        bound = lambda found, name: found.select("k", F.col("at").alias("chunk"), F.col("v").alias(name))
        long = stored(long.join(bound(boundaries(matrices, ENDS, forward=False), "exits"), ["k", "chunk"]), "chunk-exits")
        maps = stored(long.select("k", F.col("chunk").alias("at"), _each(
            chunk_map, "array<long>", "initials", "faults", "exits", "last").alias("m")), "chunk-maps")
        starts = bound(boundaries(maps, [0 if q == START else FAR for q in range(STATES)], forward=True), "v")
        entered = starts.select("k", "chunk", (F.array_position("v", F.lit(0).cast("long")) - 1).alias("entry"))
        ready = alone.unionByName(long.join(entered, ["k", "chunk"]))

    @F.pandas_udf("edits string, cost long, bad long, places array<long>, roles array<string>")
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = [_traced(*r) for r in rows.itertuples(index=False, name=None)]
        return pd.DataFrame(found, columns=["edits", "cost", "bad", "places", "roles"])

    edited = ready.withColumn("e", run(F.struct("initials", "faults", "first", "exits", "entry", "last")))
    return stored(edited.select("k", "chunk", "initials", "e.*"), "turn-edits")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (conv_id, turn, role, text): the repaired rows, and a row per conversation.

    Repaired rows: conv_id, chunk and place (their order), role, text. Conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit (the edits' initials in order).
    """
    turns = ordered(rows)
    marked = stored(with_faults(turns), "turn-faults")
    chunks = stored(marked.groupBy("k", F.expr(f"shiftright(pos, {SHIFT})").alias("chunk")).agg(
        F.min("pos").alias("first"), F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows")).select(
        "k", "chunk", "first", _letters(F.col("rows"), "initial").alias("initials"), _letters(F.col("rows"), "fault").alias("faults")), "turn-chunks")
    edits = solved(chunks)

    counted = [F.count_if(F.col("fault") == f).alias(name) for f, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    of_rows = marked.groupBy("k", "conv_id").agg(gaps.alias("gaps"), *counted)
    # A row per chunk, so even a long conversation has few.
    before = F.lag(F.right("initials", F.lit(1))).over(Window.partitionBy("k").orderBy("chunk"))
    seam = F.concat(before, F.left("initials", F.lit(1)))
    seamed = edits.select("k", "chunk", "cost", "edits", F.when(seam.isNotNull() & ~seam.isin("su", "ua", "au"), F.col("bad") + 1).otherwise(F.col("bad")).alias("bad"))
    of_chunks = seamed.groupBy("k").agg(
        F.sum("bad").alias("illegal"), F.sum("cost").alias("cost"),
        _letters(F.sort_array(F.collect_list(F.struct("chunk", "edits"))), "edits").alias("audit"))
    conversations = of_rows.join(of_chunks, "k").drop("k")

    ids = marked.select("k", "conv_id").distinct()
    left = edits.select("k", "chunk", F.posexplode(F.arrays_zip("places", "roles")).alias("place", "r")).select(
        "k", "chunk", "place", F.col("r.places").alias("pos"), F.col("r.roles").alias("new"))
    kept = turns.select("pos", "conv_id", "role", "text").join(left.where("pos is not null"), "pos")
    added = left.where("pos is null").join(ids, "k")
    repaired = kept.select("conv_id", "chunk", "place", F.coalesce("new", "role").alias("role"), "text").unionByName(
        added.select("conv_id", "chunk", "place", F.col("new").alias("role"), F.lit("").alias("text")))
    return repaired, conversations


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and sha256 (lowercase hex) of the repaired rows as `role:text`, joined by newlines.

    A digest has to see a conversation in order: rows are sorted and read as a stream, so that no more than a batch is held.
    """
    prepare(repaired.sparkSession)
    rows = repaired.select("conv_id", "chunk", "place", F.concat_ws(":", "role", "text").alias("line"))
    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "place")
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches):
        now, found = None, None
        for batch in batches:
            ids, out = batch.column("conv_id").to_pylist(), ([], [])
            for i, line in zip(ids, batch.column("line")):
                if found is None or i != now:
                    if found is not None:
                        out[0].append(now)
                        out[1].append(found.hexdigest())
                    now, found = i, sha256(line.as_py().encode())
                else:
                    found.update(b"\n" + line.as_py().encode())
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field("conv_id").type), pa.array(out[1])], names=["conv_id", "sha"])
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field("conv_id").type), pa.array([found.hexdigest()])], names=["conv_id", "sha"])

    return sorted_.mapInArrow(run, f"conv_id {kind}, sha string")
