"""Benchmark decontamination over a distributed positional inverted index; DataFrame functions only.

`build_index` stores a posting (doc_id, pos, term) for each occurrence of a query term in the training texts.
A phrase is matched from its rarest term: each posting of that term proposes a start, pos minus the term's offset;
the second rarest term's list, adjusted by its own offset, is intersected with the proposals, and what is left
is intersected with the lists of all further terms. `proximity_matches` does the same with every term
allowed a distance from its place.

Every join is on (document, position, term) or on the term, so neither a common term nor a passage that many
documents share gathers in one task. Query terms, and the documents still in question before the last
intersection, are broadcast when a count shows that there are at most `tables.BROADCAST_ROWS` of them; otherwise those
joins are shuffled.

Defined results: null, empty and punctuation-only texts have no words and no matches; an item of fewer words than
a window is one window; repeated items and windows count once; rows repeated with their doc_id get the same counts;
doc_id is taken to name one text, and a row whose doc_id is null has no matches. Items without words and null
item_ids never match; without items no document has matches, and without documents there are no rows; texts of any
length are read whole. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iotlake.llm.tables import plain, small, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of digits, letters and all non-ASCII characters, A-Z lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def windows(items: DataFrame, size: int) -> DataFrame:
    """item_id, phrase_id, terms: every run of `size` words, or all words of a shorter item."""
    listed = items.where("item_id is not null").select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    runs = listed.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("terms"))
    return runs.select("item_id", F.md5(F.concat_ws(" ", "terms")).alias("phrase_id"), "terms").distinct()


def build_index(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Stored postings (doc_id, pos, term) of the terms that `phrases` (terms) name. Terms are kept as 64-bit hashes."""
    vocabulary = small(stored(phrases.select(F.explode("terms").alias("word")).distinct().select(
        "word", F.xxhash64("word").alias("term")), "phrase-terms"))
    listed = docs.where("doc_id is not null").select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return stored(listed.join(vocabulary, "word").select("doc_id", "pos", "term"), "postings")


def _ranked(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase_id, n_terms and its terms (n, k, term), the rarest first; phrases with a term of no posting go."""
    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    terms = phrases.select("phrase_id", "terms").distinct().select(
        "phrase_id", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("k", "word"))
    terms = terms.select("phrase_id", "n_terms", "k", F.xxhash64("word").alias("term")).join(counts, "term")
    ranked = terms.groupBy("phrase_id", "n_terms").agg(F.array_sort(F.collect_list(F.struct("n", "k", "term"))).alias("by_n"))
    return stored(ranked.where(F.size("by_n") == F.col("n_terms")), "phrase-ranks")


def _of_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of these terms."""
    return postings.join(small(stored(terms.distinct(), "phrase-some")), "term", "left_semi")


def _proposed(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """phrase_id, doc_id, start: each posting of a phrase's rarest term, adjusted by the term's offset."""
    first = ranked.select("phrase_id", F.col("by_n")[0]["term"].alias("term"), F.col("by_n")[0]["k"].alias("k"))
    return postings.join(small(stored(first, "phrase-first")), "term").select(
        "phrase_id", "doc_id", (F.col("pos") - F.col("k")).alias("start")).where("start >= 0")


def phrase_matches(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase_id, doc_id, start, n_terms: where the terms of a phrase (phrase_id, terms) stand in a row."""
    ranked = _ranked(postings, phrases)
    longer = ranked.where("n_terms > 1")
    second = longer.select("phrase_id", F.col("by_n")[1]["term"].alias("term"), F.col("by_n")[1]["k"].alias("k"))
    proposed = _proposed(postings, longer).join(small(stored(second, "phrase-second")), "phrase_id").select(
        "phrase_id", "doc_id", "start", (F.col("start") + F.col("k")).alias("pos"), "term")
    left = stored(proposed.join(_of_terms(postings, second.select("term")), ["doc_id", "pos", "term"], "left_semi").select(
        "phrase_id", "doc_id", "start").distinct(), "phrase-pairs")

    documents = small(stored(left.select("doc_id").distinct(), "phrase-docs"))
    rest = left.join(small(ranked), "phrase_id").select(
        "phrase_id", "doc_id", "start", "n_terms",
        F.explode_outer(F.slice("by_n", 3, F.greatest(F.col("n_terms") - 2, F.lit(0)))).alias("t"))
    rest = rest.select("phrase_id", "doc_id", "start", "n_terms", F.col("t")["k"].alias("k"), F.col("t")["term"].alias("term"),
                       (F.col("start") + F.col("t")["k"]).alias("pos"))
    held = postings.join(documents, "doc_id", "left_semi")
    whole = rest.where("k is null").select("phrase_id", "doc_id", "start", "n_terms")
    found = rest.where("k is not null").join(held, ["doc_id", "pos", "term"], "left_semi").groupBy(
        "phrase_id", "doc_id", "start", "n_terms").agg(F.count_distinct("k").alias("m")).where("m = n_terms - 2")
    single = _proposed(postings, ranked.where("n_terms = 1")).distinct().withColumn("n_terms", F.lit(1))
    return found.drop("m").unionByName(whole).unionByName(single)


def proximity_matches(postings: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """As phrase_matches, with every term at most `slop` places from where the rarest term's posting puts it.

    Positions are joined by runs of slop + 1 of them, each proposal looking into the runs around its own.
    """
    ranked = _ranked(postings, phrases)
    run = slop + 1
    first = ranked.select("phrase_id", F.col("by_n")[0]["term"].alias("term"), F.col("by_n")[0]["k"].alias("k"))
    starts = postings.join(small(stored(first, "phrase-first")), "term").select(
        "phrase_id", "doc_id", (F.col("pos") - F.col("k")).alias("start")).distinct()
    terms = starts.join(small(ranked), "phrase_id").select(
        "phrase_id", "doc_id", "start", "n_terms", F.explode("by_n").alias("t"))
    wanted = terms.select("phrase_id", "doc_id", "start", "n_terms", F.col("t")["k"].alias("k"), F.col("t")["term"].alias("term"),
                          (F.col("start") + F.col("t")["k"]).alias("place"))
    here = F.floor(F.col("place") / run)
    wanted = wanted.withColumn("run", F.explode(F.array(here - 1, here, here + 1)))
    listed = postings.select("doc_id", "term", "pos", F.floor(F.col("pos") / run).alias("run"))
    near = wanted.join(listed, ["doc_id", "term", "run"]).where(F.abs(F.col("pos") - F.col("place")) <= slop)
    return near.groupBy("phrase_id", "doc_id", "start", "n_terms").agg(F.count_distinct("k").alias("m")).where(
        "m = n_terms").drop("m")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """Per row of `docs` (doc_id, text): n_words, n_hit and items, the sorted item_ids (as text) found in it.

    `items` has item_id and text. A word inside any occurrence of a window is hit.
    """
    docs = plain(docs, "doc_id", "text")
    owners = stored(windows(plain(items, "item_id", "text"), size), "windows")
    postings = build_index(docs, owners)
    found = stored(phrase_matches(postings, owners), "phrase-matches")

    places = found.select("doc_id", "start", "n_terms").distinct().select(
        "doc_id", F.explode(F.sequence("start", F.col("start") + F.col("n_terms") - 1)).alias("pos"))
    hit = places.distinct().groupBy("doc_id").agg(F.count("*").alias("n_hit"))
    named = found.select("doc_id", "phrase_id").join(
        small(owners.select("phrase_id", F.col("item_id").cast("string").alias("item"))), "phrase_id")
    named = named.select("doc_id", "item").distinct().groupBy("doc_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    counts = docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return counts.join(stored(hit.join(named, "doc_id"), "contaminated"), "doc_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
