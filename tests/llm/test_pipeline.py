"""The pipeline: columns, decisions and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from iotlake.llm import odd_sketch_dedup, phrase_index
from iotlake.llm.tables import stored, table

SF = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "test-stage")
        if name != "pieces":
            assert after.columns == docs.columns
            assert after.join(docs, docs.columns, "left_anti").count() == 0
        if name == "near duplicates":
            kept = odd_sketch_dedup.near_duplicates(docs).where("kept").select("doc_id")
            assert after.select("doc_id").exceptAll(kept).count() == kept.exceptAll(after.select("doc_id")).count() == 0
        if name == "decontamination":
            hit = phrase_index.contamination(docs, table(spark, SF, "benchmark")).where("n_hit > 0").count()
            assert after.count() == docs.count() - hit
        if name == "pieces":
            both = after.join(docs.select("doc_id", F.md5("text").alias("md5")), "doc_id")
            assert both.where("text_md5 = md5 and n_ids = size(ids)").count() == docs.count() == after.count()
        docs = after


def test_run_has_the_last_stages_rows(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "ids", "n_ids", "text_md5"] and found.count() > 100


@pytest.mark.parametrize("rows", [[], [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a b c", None), (3, "word " * 30_000, "x"),
                                       (4, "one two three four five six", "x"), (4, "one two three four five six", "x")]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame([(*r, 5, 0.5) for r in rows], "doc_id long, text string, lang string, n_chars int, score double")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-odd")
        if name == "near duplicates":
            assert docs.where("doc_id = 4").count() <= 1 and docs.where("doc_id = 2").count() <= 1
    assert docs.columns[0] == "doc_id"


def test_pairs_from_080_on_are_near_duplicates(spark):
    rng = random.Random(3)
    texts = []
    # A text of 200 words and one whose last words differ: similarity (196 - changed) / (196 + changed).
    for changed in (10, 14, 17, 19, 20, 21, 22, 25):
        for _ in range(8):
            words = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
            texts += [words, words[:200 - changed] + [f"v{rng.randrange(10 ** 6)}" for _ in range(changed)]]
    sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]
    near = [100 * len(x & y) / len(x | y) for x, y in zip(sets[::2], sets[1::2])]
    assert sum(80 <= s < 85 for s in near) >= 16 and any(s < 80 for s in near)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert kept == {2 * i for i in range(len(near))} | {2 * i + 1 for i, s in enumerate(near) if s < 80}
