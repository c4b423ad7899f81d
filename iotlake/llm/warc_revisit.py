"""Resolution of not-modified revisit records against earlier full responses.

A crawl archive stores a page that the server reports as unchanged (status 304) as a revisit record with headers and no
payload. `resolve` finds, for each revisit, the latest earlier full response (status 200) of the same canonical URL, checks that
their validators agree, and merges the headers that a 304 may update into that response's.

The as-of join works on ids, instants and validators only: within runs of `hours` of a URL by a window over earlier rows, and
from run to run by the run's last response. A URL with very many captures is thereby spread over its runs; the payload is
joined by URL, instant and record_id at the end, for resolved revisits alone.

States: `matched`; `mismatched`, when the entity tags (weak comparison) differ or, without a pair of tags, the
Last-Modified values; `unchecked`, when there is no pair of either; `orphan`, without an earlier response. Only matched revisits
get headers and payload.

Defined results: responses at the very instant of a revisit aren't earlier; of several at the latest instant the largest
record_id counts; a null URL, date or record_id resolves to nothing (`orphan`) and serves nothing; an empty payload is a
payload, a null one is none; repeated rows of a revisit are resolved each; of rows with one URL, instant and record_id the one with the greatest
validators serves, then that with the greatest MD5 of its payload, and a record_id may belong to several URLs; header names are compared
in lower case; an empty table has no rows; payloads of any length are passed on whole; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from iotlake.llm.tables import stored

# What a 304 response may update, as RFC 9110 (15.4.5) and RFC 9111 (3.2, 4.3.4) have it.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

_URL = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no user, default port or fragment, `/` for no path, query parameters sorted.

    Text that is no such URL stays as it is, without surrounding blanks and fragment.
    """
    scheme = F.lower(F.regexp_extract(url, _URL, 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 2)), r"^[^@]*@", "")
    host = F.when(scheme == "http", F.regexp_replace(host, ":80?$", "")).when(
        scheme == "https", F.regexp_replace(host, ":(443)?$", "")).otherwise(host)
    host = F.regexp_replace(host, ":$", "")
    path = F.regexp_extract(url, _URL, 3)
    query = F.array_join(F.array_sort(F.split(F.regexp_extract(url, _URL, 4), "&")), "&")
    whole = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path),
                     F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(scheme != "", whole).otherwise(F.trim(F.regexp_replace(url, "#.*$", "")))


def _lower_names(headers: Column) -> Column:
    """Header map with lower-case names; of names that then are equal the last value stays."""
    names = F.transform(F.map_keys(headers), lambda k: F.lower(k))
    pairs = F.arrays_zip(names.alias("k"), F.map_values(headers).alias("v"))
    kept = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), p["k"]))
    return F.coalesce(F.map_from_entries(kept), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def _tag(headers: Column) -> Column:
    """Entity tag for weak comparison."""
    return F.regexp_replace(F.trim(F.element_at(headers, "etag")), "^W/", "")


def merged_headers(kept: Column, update: Column) -> Column:
    """The stored headers, with the permitted ones of the update in their place."""
    allowed = F.map_filter(update, lambda k, _: k.isin(*PERMITTED))
    rest = F.map_filter(kept, lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(rest, allowed)


def resolve(records: DataFrame, hours: int = 1) -> DataFrame:
    """record_id, url_key, state, ref_id, headers and payload of every revisit in `records`.

    `records` has record_id, url, date (timestamp), kind (`response` or `revisit`), status, headers (map) and payload.
    """
    # Instants and headers before anything is shuffled; no payload.
    base = records.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.unix_micros("date").alias("at"),
        ((F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull()).alias("full"),
        (F.col("kind") == "revisit").alias("revisit"), _lower_names(F.col("headers")).alias("headers"))
    base = base.where("full or revisit").select(
        "*", _tag(F.col("headers")).alias("tag"), F.element_at("headers", "last-modified").alias("modified"))
    # Read four times below, the records only here and for the payloads.
    base = stored(base, "revisit-records")
    known = "url_key is not null and at is not null and record_id is not null"
    served = F.struct("at", F.col("record_id").alias("ref_id"), "tag", "modified")
    rows = base.where(known).select(
        "record_id", "url_key", "at", "revisit", "tag", "modified", F.when(F.col("revisit"), F.col("headers")).alias("headers"),
        F.when(F.col("full"), served).alias("response"), F.floor(F.col("at") / (hours * 3_600_000_000)).alias("run"))
    earlier = W.partitionBy("url_key", "run").orderBy("at").rangeBetween(W.unboundedPreceding, -1)
    near = rows.withColumn("near", F.max("response").over(earlier)).where("revisit").drop("response", "revisit")
    # The last response of each run, seen from the next run on.
    runs = rows.groupBy("url_key", "run").agg(F.max("response").alias("last"))
    runs = runs.select("url_key", "run", F.max("last").over(
        W.partitionBy("url_key").orderBy("run").rowsBetween(W.unboundedPreceding, -1)).alias("before"))
    found = near.join(runs, ["url_key", "run"]).withColumn("r", F.coalesce("near", "before"))
    agree = F.coalesce(F.col("tag") == F.col("r.tag"), F.col("modified") == F.col("r.modified"))
    found = found.select(
        "record_id", "url_key", "headers", F.col("r.ref_id").alias("ref_id"), F.col("r.at").alias("ref_at"),
        F.when(F.col("r").isNull(), "orphan").when(agree.isNull(), "unchecked").when(agree, "matched").otherwise("mismatched").alias("state"))
    loose = base.where(f"revisit and not ({known})").select(
        "record_id", "url_key", "headers", F.lit(None).cast(base.schema["record_id"].dataType).alias("ref_id"),
        F.lit(None).cast("long").alias("ref_at"), F.lit("orphan").alias("state"))
    found = stored(found.unionByName(loose), "revisit-states")
    # A response is that of its URL, instant and id: ids may repeat.
    one = ["url_key", "ref_at", "ref_id"]
    full = records.where("kind = 'response' and status = 200 and payload is not null").select(
        canonical_url(F.col("url")).alias("url_key"), F.unix_micros("date").alias("ref_at"), F.col("record_id").alias("ref_id"),
        _lower_names(F.col("headers")).alias("of_response"), "payload")
    matched = found.where("state = 'matched'")
    # Rows that repeat a response serve once: that of the greatest validators, as the state was decided by; then by digests.
    rank = F.struct(
        _tag(F.col("of_response")).alias("tag"), F.element_at("of_response", "last-modified").alias("modified"), F.md5("payload").alias("payload"),
        header_text(F.col("of_response")).alias("headers"))
    full = full.join(matched.select(*one).distinct(), one, "left_semi").groupBy(*one).agg(
        F.max_by(F.struct("of_response", "payload"), rank).alias("full"))
    done = matched.join(full, one).select(
        "record_id", "url_key", "state", "ref_id", merged_headers(F.col("full.of_response"), F.col("headers")).alias("headers"),
        F.col("full.payload").alias("payload"))
    none = found.where("state <> 'matched'").select(
        "record_id", "url_key", "state", "ref_id", F.lit(None).cast("map<string,string>").alias("headers"), F.lit(None).cast("string").alias("payload"))
    return done.unionByName(none)


def header_text(headers: Column) -> Column:
    """`name: value` lines in order of name."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
