"""Reading, storing and batching the text tables."""

from __future__ import annotations

import ctypes
import ctypes.util
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.scratch import shared_dir

#: Text bytes that a Python step holds at once; a longer text is a batch of its own.
BATCH_BYTES = 1 << 18


#: Rows that a task hands to Python at once: texts can be long.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Settings of the session that Python steps need.

    Puts this library's folder on the Python path of tasks, for a session started from elsewhere (a cluster that gets the library by
    `--py-files` doesn't need it; a folder that isn't there is ignored), and bounds the rows of an Arrow batch.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def plain(frame: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that a caller's further columns can't clash with an operator's own."""
    return frame.select(*[F.col(f"`{c}`") for c in columns])


def crc32_text(column: str) -> Column:
    """crc32 of the column as text; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def hash_sample(frame: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """At most `rows` rows of the frame, those of the smallest hashes of `key`; null keys are left out.

    Rows above a share that holds half as many again drop out where they are read, so that few are ordered.
    """
    known = frame.where(F.col(key).isNotNull())
    n = known.count()
    order = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40))
    share = min(1.0, (1.5 * rows + 1000) / max(n, 1))
    return known.withColumn("_order", order).where(F.col("_order") < int(share * (1 << 40))).orderBy(
        "_order", key).limit(rows).drop("_order")


def split_of(column: str, parts: int, remainder: int) -> Column:
    """Whether a row is held out: crc32(id as text) mod parts is the remainder. A null id is not."""
    return F.coalesce(crc32_text(column) % parts == remainder, F.lit(False))


def map_texts(
    frame: DataFrame,
    function: Callable[[list, list], dict],
    schema: str,
    key: str = "doc_id",
    text: str = "text",
    binary: bool = False,
) -> DataFrame:
    """`function(keys, texts)` over runs of rows, giving columns of `schema` as lists or arrays.

    A null text comes as empty. With `binary` texts are UTF-8 bytes.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = frame.select(F.col(f"`{key}`").alias("k"), (content.cast("binary") if binary else content).alias("t"))
    prepare(frame.sparkSession)
    arrow = _arrow_schema(frame.sparkSession, schema)

    def run(batches):
        for batch in batches:
            # A slice at a time, so that a batch of very long texts is never held twice as Python objects.
            sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(1)), np.int64)) \
                if batch.num_rows else np.zeros(0, np.int64)
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, before + BATCH_BYTES, side="right")))
                part = batch.slice(at, end - at)
                got = function(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [x.cast(field.type) if isinstance(x, pa.Array) else pa.array(x, field.type)
                     for field, x in ((f, got[f.name]) for f in arrow)], schema=arrow)
                at = end
        give_back()

    return rows.mapInArrow(run, schema)


_KEPT: dict = {}


def kept(key, make: Callable):
    """What `make` gives, kept in this process from task to task until a task asks for something else.

    Python workers serve one operator after another, and what each has learned would add up.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Returns freed memory to the machine at the end of a task, as Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim:
        trim(0)


def text_column(function: Callable[[list[str]], np.ndarray], text: str = "text") -> Column:
    """A double for each text by `function`, which gets runs of texts; a null text comes as empty."""
    @F.pandas_udf("double")
    def run(runs: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in runs:
            values, out, at = texts.tolist(), [], 0
            while at < len(values):
                end, held = at, 0
                while end < len(values) and (end == at or held + len(values[end]) <= BATCH_BYTES):
                    held += len(values[end])
                    end += 1
                out.append(np.asarray(function(values[at:end]), float))
                at = end
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))
        give_back()

    return run(F.coalesce(F.col(f"`{text}`"), F.lit("")))


#: Rows of what is broadcast: a few numbers or words each, or one id each. Some 20 MB at most.
BROADCAST_ROWS = 200_000
BROADCAST_IDS = 1_000_000


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The stored frame, marked to be broadcast if a count shows at most so many rows; else its join is shuffled."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its concatenated values and the size of each row."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
