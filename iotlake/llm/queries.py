"""The registered queries; each applies its operator to the whole of its table."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iotlake.llm import chat_format, html_region, maxent_lm, odd_sketch_dedup, phrase_index, piece_scan, projection_dedup
from iotlake.llm import quality, range_coder, toxicity, turn_repair, vector_codes, warc_revisit
from iotlake.llm.tables import plain, small, split_of, stored, table

#: The folder of the public vocabulary files, on every machine.
TOKENIZERS = "/opt/tokenizers"
#: A score from this on counts as label 1.
THRESHOLD = 0.3


def _graded(scored: DataFrame, parts: int, remainder: int) -> DataFrame:
    return scored.select(
        "doc_id", split_of("doc_id", parts, remainder).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seen = ~split_of("doc_id", 4, 2)
    model = toxicity.fit(docs.where(seen), table(spark, sf_dir, "labels").where(seen))
    return _graded(toxicity.score(docs, model), 4, 2)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from the formatted text. Conversation -7 holds other templates' control strings."""
    text = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    rows = table(spark, sf_dir, "conversations").select(*more.columns).unionByName(more)
    chats = chat_format.format_chats(rows.select(
        "conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts")))
    turns = chat_format.read_turns(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_format.masked_text(F.col("formatted"), F.col("loss_spans"))
    read = chats.select("conv_id", "formatted", F.size(turns).cast("long").alias("n_turns"), said.alias("said"), loss.alias("loss"))
    return read.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op3_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what they decode to."""
    found = piece_scan.encode(table(spark, sf_dir, "documents"), TOKENIZERS + "/piece_bpe_32k.model", decoded=True)
    return found.select("doc_id", "ids", F.md5("text").alias("text_md5"))


def op4_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked from 0.85, which is this query's own threshold."""
    return odd_sketch_dedup.near_duplicates(table(spark, sf_dir, "documents"), odd_sketch_dedup.Shape(hundredths=85))


def op5_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Fixed value: how the byte-level tokenizers split a text before they merge.
BYTE_LEVEL = range_coder.BYTE_LEVEL


def op6_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from the files."""
    files = range_coder.write_ids(table(spark, sf_dir, "documents"), TOKENIZERS + "/byte_bpe_50k.json", 2, BYTE_LEVEL)
    return range_coder.read_documents(files)


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of the pages: a response of each and a second one of every other, and three revisits of each.

    The first revisit writes the URL differently and repeats the entity tag, the second repeats it, has another one, only a date or
    nothing, by the page's id, and the third comes before any response.
    """
    start = F.lit(1_704_067_200) + F.col("page_id") * 3600
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    host = F.regexp_extract("url", "^([^:]*://[^/?#]*)", 1)
    odd_url = F.concat(F.upper(host), F.when(F.col("url").startswith("https"), ":443").otherwise(":80"),
                       F.expr("substring(url, length(regexp_extract(url, '^([^:]*://[^/?#]*)', 1)) + 1)"), F.lit("#again"))

    def record(number, url, hours, kind, *headers):
        pairs = [x for name, value in headers for x in (F.lit(name), value)]
        return F.struct(
            (F.col("page_id") * 10 + number).alias("record_id"), url.alias("url"), F.timestamp_seconds(start + hours * 3600).alias("date"),
            F.lit(kind).alias("kind"), F.lit(200 if kind == "response" else 304).alias("status"),
            F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("headers"),
            (F.coalesce("html", F.lit("")) if kind == "response" else F.lit(None).cast("string")).alias("payload"))

    day, text = F.concat(F.lit("day "), F.col("page_id").cast("string")), F.lit("text/html")
    case = F.col("page_id") % 4
    second = F.concat(F.lit("W/"), F.when(F.col("page_id") % 2 == 0, F.lit('"second"')).otherwise(tag))
    rows = F.array(
        record(0, F.col("url"), 0, "response", ("ETag", tag), ("Last-Modified", day), ("Content-Type", text), ("Cache-Control", F.lit("max-age=1"))),
        record(1, odd_url, 24, "revisit", ("etag", F.concat(F.lit("W/"), tag)), ("Content-Type", F.lit("text/plain")), ("cache-control", F.lit("max-age=2"))),
        record(2, F.col("url"), 48, "revisit", ("ETag", F.when(case == 0, second).when(case == 1, F.lit('"other"'))),
               ("Last-Modified", F.when(case == 2, day)), ("Date", F.lit("now"))),
        record(3, F.col("url"), -24, "revisit", ("ETag", tag)),
        record(4, F.col("url"), 36, "response", ("ETag", second), ("Last-Modified", day), ("Content-Type", text)))
    rows = F.filter(rows, lambda r: (r["record_id"] % 10 != 4) | (F.col("page_id") % 2 == 0))
    return pages.select(F.explode(rows).alias("r")).select("r.*")


def op7_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisit.resolve(captures(table(spark, sf_dir, "pages")))
    return found.select(
        "record_id", "url_key", "state", "ref_id", warc_revisit.header_text(F.col("headers")).alias("headers"),
        F.length("payload").cast("long").alias("n_chars"))


def op8_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~split_of("doc_id", 5, 0)))
    return _graded(quality.score(docs, model), 5, 0)


def op10_html_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_region.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    named = sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    labels = small(stored(found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors"))
    return found.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(named).alias("codebooks_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (nulls: one space) with a fault in some, by the crc32 of their id and turn."""
    space = F.lit(" ")
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    case, role, text = F.crc32(named.cast("binary")) % 20, F.coalesce("role", space), F.coalesce("text", space)
    return plain(conversations, "conv_id", "turn", "role", "text").where(case != 0).select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    repaired, found = turn_repair.repair(damaged(chats))
    digests = turn_repair.digests(repaired)
    out = chats.select("conv_id").distinct()
    for right in (found, digests):
        right = right.withColumnRenamed("conv_id", "of")
        out = out.join(right, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    none = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(c, none).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = split_of("doc_id", 5, 1)
    model, counts = maxent_lm.fit(docs.where(~held))
    return maxent_lm.score(docs, model, counts).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


QUERIES = (op1_toxicity, op2_chat_format, op3_piece_scan, op4_odd_sketch_dedup, op5_projection_dedup, op6_range_coder, op7_warc_revisit,
           op8_phrase_index, op9_quality, op10_html_region, op11_vector_codes, op12_turn_repair, op13_maxent_lm)
