"""Resolving not-modified revisit records of web archives.

A revisit record says that a page had not changed since an earlier capture and holds no body. It is
joined, as of its time, to the latest earlier full response of the same canonical URL. Its
validators are checked against that response; if they agree the response's headers are updated by
those of the revisit, but for the headers that describe the stored body.

No URL meets in one task: records are cut by URL and range of time, each range passes on its latest
full response, and only a range of a URL is sorted. Bodies are never moved.

Defined cases: a missing URL never resolves; a revisit without validators resolves to any response;
of two validators both must agree where both sides have them, and if the entity tags can be compared
dates are not looked at; weak and strong forms of a tag are the same; responses at the very time of
the revisit are not earlier; of responses at the same time the one with the larger id counts; a
missing id or time counts as the least; repeated rows are records of their own; an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import table
from tallyframe.session import materialize

#: Ranges of time records are cut into; a URL's largest piece shrinks with it.
TIME_RANGES = 256

# Headers of a not-modified answer that must not replace those stored with the body.
BODY_HEADERS = ("content-encoding", "content-length", "content-md5", "content-range", "content-type", "trailer", "transfer-encoding")
# Query parameters that only track visitors.
TRACKING = "^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid|jsessionid)(=|$)"


def canonical_url(url: str) -> Column:
    """Scheme, leading www, default port, fragment, tracking parameters and closing slash dropped, host in lower case, parameters in order."""
    bare = F.regexp_replace(F.trim(F.col(url)), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]*\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    asked = F.filter(F.split(F.regexp_extract(bare, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))
    return F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(asked), "&"))).otherwise(F.lit("")))


def bare_tag(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def merged_headers(stored: Column, fresh: Column) -> Column:
    allowed = F.map_filter(F.coalesce(fresh, F.create_map().cast("map<string,string>")), lambda k, _: ~F.lower(k).isin(*BODY_HEADERS))
    kept = F.map_filter(F.coalesce(stored, F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(allowed, k))
    return F.map_concat(kept, allowed)


def time_ranges(records: DataFrame) -> list[float]:
    """At most TIME_RANGES - 1 times that cut the records evenly."""
    at = records.select(F.col("at").cast("double").alias("at")).where(F.col("at").isNotNull())
    return sorted(set(at.approxQuantile("at", [i / TIME_RANGES for i in range(1, TIME_RANGES)], 1 / (4 * TIME_RANGES))))


def latest_earlier(records: DataFrame) -> DataFrame:
    """The revisits among ``records`` (row, id, at, canonical_url, revisit), with ``found``: at, id and row of the latest earlier full response."""
    cuts = time_ranges(records)
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("at").cast("double"))) if cuts else F.lit(0)
    cut = records.withColumn("_range", F.when(F.col("at").isNull(), F.lit(0)).otherwise(place))
    response = F.when(~F.col("revisit"), F.struct("at", "id", "row"))
    latest = cut.groupBy("canonical_url", "_range").agg(F.max(response).alias("_latest"))
    before = W.partitionBy("canonical_url").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = latest.select("canonical_url", "_range", F.max("_latest").over(before).alias("_carried"))
    # Revisits stand before responses of the same time, which are not earlier.
    inside = W.partitionBy("canonical_url", "_range").orderBy(F.col("at").asc_nulls_first(), F.desc("revisit")).rowsBetween(W.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.max(response).over(inside)).where("revisit")
    return cut.join(carried, ["canonical_url", "_range"]).withColumn("found", F.coalesce("_inside", "_carried")).drop("_range", "_inside", "_carried")


def validators_agree(etag: str, stored_etag: str, modified: str, stored_modified: str) -> Column:
    tags = bare_tag(F.col(etag)) == bare_tag(F.col(stored_etag))
    return F.coalesce(tags, F.col(modified) == F.col(stored_modified), F.lit(True))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Resolves the revisits among ``captures`` (id, url, at, revisit, etag, last_modified, headers map, digest).

    Gives of each revisit id, canonical_url, at, outcome (resolved, validator mismatch, no earlier
    response), refers_to, and if it is resolved the digest of the body it stands for and the merged headers.
    """
    records = captures.select(
        F.monotonically_increasing_id().alias("row"), "id", canonical_url("url").alias("canonical_url"), "at",
        F.coalesce("revisit", F.lit(False)).alias("revisit"), "etag", "last_modified", "headers", "digest",
    )
    records = materialize(records, "captures")  # fixes the row numbers
    revisits = records.where("revisit").drop("revisit", "digest")
    placed = records.where(F.col("canonical_url").isNotNull()).select("row", "id", "at", "canonical_url", "revisit")
    found = latest_earlier(placed).select("row", F.col("found.row").alias("_row"), F.col("found.id").alias("_id"))
    stored = records.where(~F.col("revisit")).select(
        F.col("row").alias("_row"), F.col("etag").alias("_etag"), F.col("last_modified").alias("_modified"), F.col("headers").alias("_headers"), "digest",
    )
    joined = revisits.join(found, "row", "left").join(stored, "_row", "left")
    outcome = (
        F.when(F.col("_row").isNull(), "no earlier response")
        .when(validators_agree("etag", "_etag", "last_modified", "_modified"), "resolved")
        .otherwise("validator mismatch")
    )
    good = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "id", "canonical_url", "at", "outcome", F.col("_id").alias("refers_to"),
        F.when(good, F.col("digest")).alias("digest"), F.when(good, merged_headers(F.col("_headers"), F.col("headers"))).alias("headers"),
    )


def header_text(headers: str) -> Column:
    """Headers as lines in order of their names."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(F.array_sort(lines), "\n")


def page_captures(pages: DataFrame) -> DataFrame:
    """Two captures of each page, since the table of pages has no crawl times or headers: the full
    response at second 10 * page_id, and a revisit some time after it. Every tenth revisit carries
    the tag of a changed page, every third page has no tag and is checked by its date."""
    key, size = F.col("page_id"), F.octet_length(F.coalesce("html", F.lit("")))
    digest = F.md5(F.coalesce(F.col("html"), F.lit("")))
    tag = F.when(key % 3 != 0, F.concat(F.lit('"'), digest, F.lit('"')))
    response = pages.select(
        key.alias("id"), "url", (key * 10).alias("at"), F.lit(False).alias("revisit"), tag.alias("etag"), (key * 10 - 5).cast("string").alias("last_modified"),
        F.create_map(F.lit("content-length"), size.cast("string"), F.lit("content-type"), F.lit("text/html"), F.lit("date"), (key * 10).cast("string"), F.lit("server"), F.lit("origin")).alias("headers"),
        digest.alias("digest"),
    )
    later = key * 10 + 5 + F.pmod(key, F.lit(7)) * 40_000
    revisit = pages.select(
        key.alias("id"), "url", later.alias("at"), F.lit(True).alias("revisit"),
        F.when(key % 10 == 9, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag)).alias("etag"), (key * 10 - 5).cast("string").alias("last_modified"),
        F.create_map(F.lit("cache-control"), F.concat(F.lit("max-age="), F.pmod(key, F.lit(60)).cast("string")), F.lit("content-length"), F.lit("0"), F.lit("date"), later.cast("string")).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return response.unionByName(revisit)


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    return out.select(F.col("id").alias("page_id"), "canonical_url", "at", "outcome", "refers_to", "digest", header_text("headers").alias("headers"))


OP5_SQL = r"""
WITH parts AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
named AS (
  SELECT page_id, md5(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS size,
         regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^www[0-9]*\.', ''), ':(80|443)$', '')
         || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
         list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid|jsessionid)(=|$)'))) AS asked
  FROM parts),
pages2 AS (
  SELECT page_id, digest, size, place || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS canonical_url,
         CASE WHEN page_id % 3 <> 0 THEN digest END AS tag, page_id * 10 + 5 + (page_id % 7) * 40000 AS later FROM named),
events2 AS (
  SELECT page_id, canonical_url, page_id * 10 AS t, FALSE AS revisit FROM pages2
  UNION ALL SELECT page_id, canonical_url, later, TRUE FROM pages2),
seen AS (
  SELECT *, max(CASE WHEN NOT revisit THEN t END) OVER (
    PARTITION BY canonical_url ORDER BY t, revisit DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS found_at
  FROM events2)
SELECT s.page_id, s.canonical_url, s.t AS "at",
       CASE WHEN f.page_id IS NULL THEN 'no earlier response' WHEN ok THEN 'resolved' ELSE 'validator mismatch' END AS outcome,
       f.page_id AS refers_to, CASE WHEN ok THEN f.digest END AS digest,
       CASE WHEN ok THEN 'cache-control: max-age=' || s.page_id % 60 || chr(10) || 'content-length: ' || f.size || chr(10)
         || 'content-type: text/html' || chr(10) || 'date: ' || s.t || chr(10) || 'server: origin' END AS headers
FROM seen s JOIN pages2 own ON own.page_id = s.page_id
LEFT JOIN pages2 f ON f.canonical_url = s.canonical_url AND f.page_id * 10 = s.found_at
LEFT JOIN LATERAL (SELECT coalesce(CASE WHEN s.page_id % 10 = 9 THEN 'changed' ELSE own.tag END = f.tag, s.page_id = f.page_id) AS ok) ON TRUE
WHERE s.revisit
"""
