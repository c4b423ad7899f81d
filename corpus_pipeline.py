"""The corpus pipeline: quality, toxicity, near duplicates, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return
the columns of documents. `run` writes each stage's rows as Parquet to the shared folder and reads them again.

Defined results: a row with a null or empty text is scored like any other and has no near duplicate and no benchmark
passage; rows that repeat a doc_id are one document, of which the near-duplicate stage keeps one row, the least as JSON text; rows without
doc_id are no near duplicate and no match of anything; an empty table stays empty. Further columns are kept up to the last
stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.llm import odd_sketch_dedup, phrase_index, piece_scan, quality, toxicity
from iotlake.llm.queries import THRESHOLD, TOKENIZERS
from iotlake.llm.tables import small, split_of, stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for label 1."""
    labels = table(spark, sf_dir, "labels").where(~split_of("doc_id", 5, 0))
    model = quality.fit(docs, labels)
    # Written, so that the word vectors needn't stay in executors and driver for the stages behind.
    out = stored(docs.where(quality.score_column(spark, model) >= THRESHOLD), "quality-docs")
    model.sent.destroy()
    return out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't take for label 1."""
    seen = ~split_of("doc_id", 4, 2)
    model = toxicity.fit(docs.where(seen), table(spark, sf_dir, "labels").where(seen))
    return docs.where(toxicity.score_column(spark, model) < THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: that of the smallest doc_id."""
    found = stored(odd_sketch_dedup.near_duplicates(docs), "near-found").where("doc_id is not null")
    out = docs.join(small(stored(found.where("not kept").select("doc_id").distinct(), "near-dropped")), "doc_id", "left_anti")
    repeated = stored(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "near-repeated")
    if repeated.isEmpty():
        return out.select(docs.columns)
    repeated = small(repeated)
    whole = F.struct(*docs.columns)
    once = out.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(whole, F.to_json(whole)).alias("row")).select("row.*")
    return out.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = phrase_index.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = stored(found.where("n_hit > 0").select("doc_id").distinct(), "contaminated-docs")
    return docs.join(small(hit), "doc_id", "left_anti").select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number, and the digest of the text that they decode to."""
    path = TOKENIZERS + "/piece_bpe_32k.model"
    return piece_scan.encode(docs, path, decoded=True).select(
        "doc_id", "ids", F.size("ids").alias("n_ids"), F.md5("text").alias("text_md5"))


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

#: The classifiers and the encoding can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
