"""Not-modified revisits of web captures.

A revisit record says that a page was unchanged and carries no payload.  It is
resolved to the latest earlier full response for its canonical URL, if that
response's validators agree; headers that a not-modified answer may update
replace the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Header fields that a not-modified answer may update (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

_REST = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a last slash, sorted
    parameters without ``utm_*``; no scheme and no fragment.  A text that is no URL stays as it is, trimmed."""
    u = F.trim(url)
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, _REST + r"([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(p, F.lit("utm_")))), "&")
    made = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    return F.when(u.rlike(_REST), made).otherwise(u)


def _same_tag(a: Column, b: Column) -> Column:
    """Weak comparison of entity tags."""
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


def sliced(placed: DataFrame, slice_seconds: int, most: int) -> DataFrame:
    """``placed`` with ``slice``, a pair that grows with time: the fixed slice, and a part of it.

    Slices of over ``most`` records are cut after full seconds, by counts per second, so that a part holds
    about ``most`` records, or those of one second.  The list of cuts has a row for each second of such slices.
    """
    fixed = F.floor(F.col("ts") / slice_seconds)
    counts = placed.where("url is not null and ts is not null").groupBy("url", "ts").agg(F.count("*").alias("n"))
    own = Window.partitionBy("url", "fixed")
    until = own.orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (counts.withColumn("fixed", fixed).withColumns({"all": F.sum("n").over(own), "before": F.coalesce(F.sum("n").over(until), F.lit(0))})
            .where(F.col("all") > most).select("url", "ts", F.floor(F.col("before") / most).alias("part")))
    return placed.join(cuts.hint("merge"), ["url", "ts"], "left").withColumn(
        "slice", F.struct(fixed.alias("fixed"), F.coalesce("part", F.lit(0).cast("long")).alias("part"))).drop("part")


def resolve_revisits(records: DataFrame, slice_seconds: int = 6 * 3600, most: int = 100_000) -> DataFrame:
    """Each revisit with the response that answers it.

    records: record_id long, url, ts (seconds), kind ('response' or 'revisit'),
    etag, last_modified, headers map, payload_sha256.  Returned: record_id,
    url (canonical), ts, response_id, outcome, headers, payload_sha256.

    outcome: ``resolved``, the validators that both records have agree (the
    tag first, else the date); ``unvalidated``, they share none; ``mismatch``,
    they differ; ``orphan``, no earlier response.  Headers are merged and the
    payload is given for the first two only.  Earlier is by ts, then by record_id; null ids come
    first.  Records without url, ts or kind can be neither placed nor found: revisits among them are
    orphans.  Equal ids stay separate records.

    The search runs within time slices of a URL and carries the last response of each slice
    forward, so a URL with many captures is spread over its slices, and a slice of over
    ``most`` records over parts of it; slices are pre-aggregated before they move.
    """
    placed = sliced(records.select(
        "record_id", canonical_url(F.col("url")).alias("url"), "ts", "kind",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
        "etag", "last_modified", "payload_sha256"), slice_seconds, most)
    good = F.col("url").isNotNull() & F.col("ts").isNotNull()
    full = F.struct("ts", "record_id", "etag", "last_modified", "headers", "payload_sha256")
    responses = placed.where(good & (F.col("kind") == "response"))
    # the last response of each slice: ids point to it, so only ids and times are aggregated
    order = F.struct("ts", F.col("record_id").isNotNull().alias("known"), "record_id")
    last = responses.groupBy("url", "slice").agg(F.max_by(full, order).alias("last"))
    before = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    asked = placed.where(good & (F.col("kind") == "revisit"))
    slices = last.join(asked.select("url", "slice").distinct(), ["url", "slice"], "full")
    carried = slices.select("url", "slice", F.last("last", True).over(before).alias("carried"))
    own = Window.partitionBy("url", "slice").orderBy("ts", F.col("record_id").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    met = (placed.where(good & F.col("kind").isin("response", "revisit"))
           .withColumn("near", F.last(F.when(F.col("kind") == "response", full), True).over(own))
           .where(F.col("kind") == "revisit").join(carried, ["url", "slice"], "left")
           .withColumn("r", F.coalesce("near", "carried")))
    lost = placed.where(~good & (F.col("kind") == "revisit")).withColumn("r", F.lit(None).cast(met.schema["r"].dataType))
    met = met.select("record_id", "url", "ts", "etag", "last_modified", "headers", "r").unionByName(
        lost.select("record_id", "url", "ts", "etag", "last_modified", "headers", "r"))
    r = F.col("r")
    outcome = (F.when(r.isNull(), "orphan")
               .when(F.col("etag").isNotNull() & r["etag"].isNotNull(),
                     F.when(_same_tag(F.col("etag"), r["etag"]), "resolved").otherwise("mismatch"))
               .when(F.col("last_modified").isNotNull() & r["last_modified"].isNotNull(),
                     F.when(F.col("last_modified") == r["last_modified"], "resolved").otherwise("mismatch"))
               .otherwise("unvalidated"))
    update = F.map_filter("headers", lambda k, _: F.lower(k).isin(*PERMITTED))
    names = F.transform(F.map_keys(update), F.lower)
    stored = F.map_filter(r["headers"], lambda k, _: ~F.array_contains(names, F.lower(k)))
    fine = F.col("outcome").isin("resolved", "unvalidated")
    return met.withColumn("outcome", outcome).select(
        "record_id", "url", "ts", r["record_id"].alias("response_id"), "outcome",
        F.when(fine, F.map_concat(stored, update)).alias("headers"),
        F.when(fine, r["payload_sha256"]).alias("payload_sha256"))


#: The same captures in Spark SQL and DuckDB: every page is fetched four times, six hours and some minutes apart; a
#: third of the pages changes before the third visit, some first visits are missing, and some validators
#: are weak, absent or out of date.
_VISITS = """
SELECT page_id * 4 + v AS record_id, url, html,
       1600000000 + (page_id * 7919) % 86400 + v * 21900 AS ts, v, page_id,
       CASE WHEN v = 0 OR (v = 2 AND page_id % 3 = 0) THEN 'response' ELSE 'revisit' END AS kind,
       CASE WHEN v >= 2 AND page_id % 3 = 0 THEN md5(html || '#2') ELSE md5(html) END AS tag
FROM {visits}
WHERE NOT (v = 0 AND page_id % 11 = 5)
"""
_RECORDS = """
SELECT record_id, url, ts, kind,
       CASE WHEN kind = 'response' THEN tag
            WHEN page_id % 7 = 0 AND v = 1 THEN 'stale'
            WHEN page_id % 7 = 1 THEN NULL
            WHEN page_id % 7 = 2 THEN 'W/' || tag
            ELSE tag END AS etag,
       CASE WHEN page_id % 13 = 0 THEN NULL
            WHEN v >= 2 AND page_id % 3 = 0 THEN CAST(ts - (v - 2) * 21900 AS {text})
            ELSE CAST(ts - v * 21900 AS {text}) END AS last_modified,
       CASE WHEN kind = 'response'
            THEN {map1}
            ELSE {map2} END AS headers,
       CASE WHEN kind = 'response' THEN tag END AS payload_sha256
FROM ({visited}) AS visited
"""


def derived_records(pages: DataFrame) -> DataFrame:
    """The capture log that the query resolves, derived from whole ``pages``."""
    spark = pages.sparkSession
    visits = pages.select("page_id", "url", "html", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("v"))
    sql = _RECORDS.format(
        text="STRING", visited=_VISITS.format(visits="{visits}"),
        map1="map('Content-Type', 'text/html', 'Cache-Control', 'max-age=60', 'X-Cache', 'MISS', 'Date', CAST(ts AS STRING))",
        map2="map('cache-control', 'max-age=120', 'date', CAST(ts AS STRING), 'Connection', 'close', 'X-Cache', 'HIT')")
    return spark.sql(sql, visits=visits)


#: DuckDB twin of the query over ``pages``.
ORACLE = """
WITH visits AS (SELECT page_id, url, html, v FROM pages, (SELECT unnest([0, 1, 2, 3]) AS v)),
records AS (""" + _RECORDS.format(
    text="VARCHAR", visited=_VISITS.format(visits="visits"),
    map1="map {'Content-Type': 'text/html', 'Cache-Control': 'max-age=60', 'X-Cache': 'MISS', 'Date': CAST(ts AS VARCHAR)}",
    map2="map {'cache-control': 'max-age=120', 'date': CAST(ts AS VARCHAR), 'Connection': 'close', 'X-Cache': 'HIT'}") + """),
parts AS (
  SELECT *, trim(url) AS u,
         regexp_replace(regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(url), '^[^?#]*\\?([^#]*)', 1), '&'),
                                               lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS query
  FROM records),
placed AS (
  SELECT * EXCLUDE (url), CASE WHEN regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*')
         THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END ELSE u END AS url FROM parts),
found AS (
  SELECT a.*, b.record_id AS response_id, b.etag AS r_etag, b.last_modified AS r_modified, b.headers AS r_headers,
         b.payload_sha256 AS r_payload
  FROM (SELECT * FROM placed WHERE kind = 'revisit') AS a
  ASOF LEFT JOIN (SELECT *, ts * 1048576 * 16 + record_id AS at FROM placed WHERE kind = 'response') AS b
    ON a.url = b.url AND a.ts * 1048576 * 16 + a.record_id > b.at),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'orphan'
                 WHEN etag IS NOT NULL AND r_etag IS NOT NULL
                 THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(r_etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
                 WHEN last_modified IS NOT NULL AND r_modified IS NOT NULL
                 THEN CASE WHEN last_modified = r_modified THEN 'resolved' ELSE 'mismatch' END
                 ELSE 'unvalidated' END AS outcome,
         list_filter(map_entries(headers), lambda e: lower(e.key) IN ('cache-control', 'content-location', 'date', 'etag', 'expires', 'vary')) AS new
  FROM found)
SELECT record_id, url, CAST(ts AS BIGINT) AS ts, response_id, outcome,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN array_to_string(list_sort(list_transform(
         list_concat(list_filter(map_entries(r_headers), lambda e: NOT list_contains(list_transform(new, lambda n: lower(n.key)), lower(e.key))), new),
         lambda e: e.key || ': ' || e.value)), chr(10)) END AS headers,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN r_payload END AS payload_sha256
FROM judged
"""
