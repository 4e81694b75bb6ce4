"""Resolution of "not modified" revisit records in web archives.

A revisit (status 304, no body) stands for the latest earlier full response (status 200) of the same canonical URL,
if the validators agree. This is an as-of join. It is done without gathering a URL in one task: all captures are
range-partitioned by URL and time, a window inside each partition finds the latest full response before a revisit, and
a revisit whose partition holds none takes the last one of the partitions before, from a summary of one row per URL
and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import lower_ascii, stored

# Fields that a 304 response may carry and that replace the stored ones (RFC 9110, 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that name a visit, not a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, `www.` and default port; path without a closing slash; query parameters
    sorted and without tracking ones; no fragment. A missing URL stays missing."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(bare, r"^([^?]*)", 1)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.regexp_replace(F.regexp_replace(lower_ascii(F.regexp_extract(place, "^([^/]*)", 1)), "^www[.]", ""),
                            ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, "^[^/]*(/.*)$", 1), "/+$", "")
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def latest_before(captures: DataFrame, key: str, time: str, tie: str, payload: Column, is_full: Column,
                  name: str) -> DataFrame:
    """Add `name`: `payload` of the latest row with `is_full` strictly earlier in `time` within `key` (null if none).

    `time` is a whole number. Among full rows of the same time the one with the largest `tie` counts. Rows without
    key or time find nothing and are found by none.
    """
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = F.coalesce(is_full, F.lit(False)) & F.col(time).isNotNull() & F.col(key).isNotNull()
    marked = captures.withColumns({"_at": F.when(full, F.struct(F.col(time), F.col(tie))), "_payload": F.when(full, payload)})
    # Equal (key, time) share a partition, so whatever an earlier partition holds of the key is strictly earlier.
    placed = stored(marked.repartitionByRange(parts, key, time).withColumn("_part", F.spark_partition_id()), "captures")
    earlier = Window.partitionBy("_part", key).orderBy(time).rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tails = placed.filter(F.col(key).isNotNull()).groupBy("_part", key).agg(
        F.max("_at").alias("_last"), F.max_by("_payload", "_at").alias("_tail"))
    carried = tails.select("_part", key, F.last(F.when(F.col("_last").isNotNull(), F.struct("_tail")), True).over(
        before).alias("_carried"))
    found = placed.withColumn("_own", F.max_by(F.struct("_payload"), "_at").over(earlier))
    result = F.coalesce("_own._payload", "_carried._tail")
    return found.join(carried, ["_part", key], "left").withColumn(
        name, F.when(F.col(time).isNotNull() & F.col(key).isNotNull(), result)).select(*captures.columns, name)


def resolve(captures: DataFrame) -> DataFrame:
    """Add canonical, outcome, refers_to and merged_headers to captures (record_id, url, time, status, headers).

    `headers` is a map with names in lower case; a missing map is empty. `outcome` is `full` for status 200, `resolved`
    for a 304 whose entity tag (compared weakly) or else modification time equals that of the latest earlier full
    response, `mismatch` if it differs, `unverified` if the two share no validator, `orphan` if there is no earlier
    full response, and `other` for any other or missing status. A resolved revisit gets the stored headers with the
    permitted ones of its own put over them; a full response keeps its own; the rest get none. Other columns pass
    through; columns with the four names are replaced. Repeated rows are resolved one by one.
    """
    names = ["canonical", "outcome", "refers_to", "merged_headers"]
    rest = [c for c in captures.columns if c not in names]
    rows = captures.select(F.struct(*rest).alias("_row")).select(
        "_row", canonical_url(F.col("_row.url")).alias("canonical"), F.col("_row.time").cast("bigint").alias("_time"),
        F.col("_row.record_id").alias("_record"), F.col("_row.status").alias("_status")).withColumn(
        "_headers", F.coalesce("_row.headers", F.expr("cast(map() as map<string,string>)")))
    payload = F.struct(F.col("_record").alias("record_id"), F.col("_headers").alias("headers"))
    joined = latest_before(rows, "canonical", "_time", "_record", payload, F.col("_status") == 200, "_base")
    stored_headers, own = F.col("_base.headers"), F.col("_headers")
    tags = _weak(own["etag"]) == _weak(stored_headers["etag"])
    times = own["last-modified"] == stored_headers["last-modified"]
    agree = F.coalesce(tags, times)
    outcome = (
        F.when(F.col("_status") == 200, "full")
        .when(F.coalesce(F.col("_status") != 304, F.lit(True)), "other")
        .when(F.col("_base").isNull(), "orphan")
        .when(agree.isNull(), "unverified")
        .when(agree, "resolved").otherwise("mismatch"))
    update = F.map_filter(own, lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(stored_headers, lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)
    return joined.withColumn("outcome", outcome).select(
        "_row.*", "canonical", "outcome", F.when(F.col("outcome") == "resolved", F.col("_base.record_id")).alias("refers_to"),
        F.when(F.col("outcome") == "resolved", merged).when(F.col("outcome") == "full", own).alias("merged_headers"))


def with_bodies(resolved: DataFrame, body: str = "body") -> DataFrame:
    """Give resolved revisits the body of the record they refer to, by a join on record ids."""
    bodies = resolved.filter(F.col("outcome") == "full").select(
        F.col("record_id").alias("refers_to"), F.col(body).alias("_stored")).dropDuplicates(["refers_to"])
    return resolved.join(bodies, "refers_to", "left").withColumn(
        body, F.coalesce(body, "_stored")).select(*resolved.columns)


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl history derived from pages: a full response, revisits with other spellings of the URL, every third page
    changed in between, some with other, missing or weak validators. Four records per page."""
    kind, page = F.col("kind"), F.col("page_id")
    time = 1_700_000_000 + page * 100 + kind * 10
    full = (kind == 0) | ((kind == 2) & (page % 3 == 0))
    digest = F.md5(F.coalesce("html", F.lit("")))
    changed = F.md5(F.concat(digest, F.lit("changed")))
    etag = (
        F.when(kind == 0, digest).when(kind == 1, F.concat(F.lit("W/"), digest)).when(full, changed)
        .when((kind == 3) & (page % 11 != 0) & (page % 7 != 0), digest)
        .when((kind == 3) & (page % 7 == 0), F.lit("stale")))
    modified = F.when(kind == 0, time).when((kind == 2) & ~full, time - 20 + F.when(page % 5 == 0, 1).otherwise(0)).when(full, time)
    url = (
        F.when(kind == 0, F.col("url")).when(kind == 1, F.regexp_replace("url", "^http", "HTTP"))
        .when(kind == 2, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#part")))
        .otherwise(F.concat(F.regexp_replace("url", "#.*$", ""),
                            F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_campaign=x"))))
    headers = {
        "cache-control": F.concat(F.lit("max-age="), kind.cast("string")), "content-length": F.when(
            full, F.octet_length(F.coalesce("html", F.lit("")))).otherwise(0).cast("string"),
        "content-type": F.when(full, "text/html"), "date": time.cast("string"), "etag": etag,
        "last-modified": modified.cast("string"), "x-cache": F.when(~full, "hit")}
    pairs = [x for k, v in headers.items() for x in (F.lit(k), v)]
    return pages.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in range(4)]))).select(
        F.concat_ws("-", page.cast("string"), kind.cast("string")).alias("record_id"), url.alias("url"),
        time.cast("bigint").alias("time"), F.when(full, 200).otherwise(304).alias("status"),
        F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).alias("headers"))


def report(pages: DataFrame) -> DataFrame:
    lines = F.array_sort(F.transform(F.map_entries("merged_headers"), lambda e: F.concat(e["key"], F.lit(":"), e["value"])))
    return resolve(captures_of(pages)).select(
        "record_id", "canonical", "outcome", "refers_to",
        F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("headers_sha256"))


ORACLE = r"""
WITH k AS (SELECT *, unnest([0, 1, 2, 3]) AS kind FROM pages),
c AS (SELECT concat_ws('-', CAST(page_id AS VARCHAR), CAST(kind AS VARCHAR)) AS record_id,
  1700000000 + page_id * 100 + kind * 10 AS t,
  coalesce(kind = 0 OR (kind = 2 AND page_id % 3 = 0), false) AS is_full, kind, page_id,
  md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n,
  CASE kind WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^http', 'HTTP')
    WHEN 2 THEN regexp_replace(url, '#.*$', '') || '#part'
    ELSE regexp_replace(url, '#.*$', '') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_campaign=x' END AS url
  FROM k),
h AS (SELECT record_id, t, is_full, n, kind, url,
  CASE WHEN kind = 0 THEN digest WHEN kind = 1 THEN 'W/' || digest WHEN is_full THEN md5(digest || 'changed')
    WHEN kind = 3 AND page_id % 11 <> 0 AND page_id % 7 <> 0 THEN digest
    WHEN kind = 3 AND page_id % 7 = 0 THEN 'stale' END AS etag,
  CASE WHEN kind = 0 THEN t WHEN kind = 2 AND NOT is_full THEN t - 20 + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END
    WHEN is_full THEN t END AS modified,
  regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM c),
u AS (SELECT *, regexp_extract(bare, '^([^?]*)', 1) AS place,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
    lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&') AS kept FROM h),
r AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(place, '^([^/]*)', 1)), '^www[.]', ''), ':(80|443)$', '')
  || regexp_replace(regexp_extract(place, '^[^/]*(/.*)$', 1), '/+$', '')
  || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical FROM u),
b AS (SELECT r.*, f.record_id AS base, f.etag AS base_etag, f.modified AS base_modified, f.n AS base_n,
    row_number() OVER (PARTITION BY r.record_id ORDER BY f.t DESC, f.record_id DESC) AS place_no
  FROM r LEFT JOIN r f ON f.is_full AND f.canonical = r.canonical AND f.t < r.t),
o AS (SELECT *, CASE WHEN is_full THEN 'full' WHEN base IS NULL THEN 'orphan'
    WHEN etag IS NOT NULL AND base_etag IS NOT NULL THEN
      CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(base_etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL AND base_modified IS NOT NULL THEN
      CASE WHEN modified = base_modified THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS outcome FROM b WHERE place_no = 1)
SELECT record_id, canonical, outcome, CASE WHEN outcome = 'resolved' THEN base END AS refers_to,
  CASE outcome WHEN 'full' THEN sha256(concat_ws(chr(10), 'cache-control:max-age=' || kind, 'content-length:' || n,
      'content-type:text/html', 'date:' || t, 'etag:' || etag, 'last-modified:' || modified))
    WHEN 'resolved' THEN sha256(concat_ws(chr(10), 'cache-control:max-age=' || kind, 'content-length:' || base_n,
      'content-type:text/html', 'date:' || t, 'etag:' || coalesce(etag, base_etag),
      'last-modified:' || coalesce(modified, base_modified))) END AS headers_sha256
FROM o
"""
