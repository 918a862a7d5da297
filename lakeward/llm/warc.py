"""Resolution of not-modified revisits in web archives.

A revisit record (status 304) has no payload: it says that the resource was
what an earlier capture holds.  It resolves to the latest full response
(status 200) captured earlier under the same canonical URL, if the
validators agree: the entity tag where the revisit has one, else the date of
the last modification; a revisit without either is taken on trust.  The
resolved record has the earlier payload, and the earlier headers updated by
the revisit's own, except those that a 304 may not change.

The as-of join sorts all records by URL and time into ranges, so a URL with a
third of all records is spread over as many ranges as it fills.  Within a
range a running maximum finds the latest earlier response; across ranges
a URL's best response of the ranges before is carried over, one row for each
range that the URL reaches.

Defined results: records without a URL or a time never resolve and resolve
nothing; of full responses to one URL at the same instant the largest id
counts, and a revisit at that very instant is not later than it; repeated
records give a row each; headers may be NULL; names of headers compare
without case, the last of equal names counts; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import stage

FULL, NOT_MODIFIED = 200, 304
#: Query parameters that do not name a resource.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
#: Headers of a 304 that describe its own message or connection, not the stored response.
NOT_PERMITTED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer", "transfer-encoding",
    "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default ports, path without a trailing slash, other parameters sorted.

    Scheme, fragment and tracking parameters do not count.
    """
    u = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z]+://", "")
    host = F.lower(F.regexp_extract(u, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(F.regexp_extract(u, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(u, "\\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _header_list(headers: Column) -> Column:
    """Headers (array of name, value) with names in lower case, sorted, the last of equal names only."""
    low = F.transform(F.coalesce(headers, F.array().cast("array<struct<name:string,value:string>>")),
                      lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value")))
    return F.array_sort(F.filter(low, lambda h, i: ~F.exists(
        F.slice(low, i + 2, F.greatest(F.size(low) - i - 1, F.lit(0))), lambda x: x["name"] == h["name"])))


def header(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: h["name"] == name), 0)["value"]


def merged_headers(stored: Column, own: Column) -> Column:
    """``stored`` updated by what ``own`` may change."""
    banned = F.array(*[F.lit(x) for x in NOT_PERMITTED])
    news = F.filter(own, lambda h: ~F.array_contains(banned, h["name"]))
    rest = F.filter(stored, lambda h: ~F.exists(news, lambda x: x["name"] == h["name"]))
    return F.array_sort(F.concat(rest, news))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per record: record_id, url_key, outcome, source_id, payload_digest, headers.

    ``records``: record_id (orderable), url, ts (timestamp), status, headers
    (array of struct name, value) and payload_digest.  Payloads stay where they are; ``source_id``
    names the record that holds the payload.  ``outcome`` is 'full', 'resolved', 'trusted' (no validator),
    'mismatch', 'no_earlier' or 'other' (any other status).
    """
    r = records.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.col("status").cast("int").alias("status"), _header_list(F.col("headers")).alias("headers"), "payload_digest",
    )
    ranged = stage(
        r.repartitionByRange("url_key", "at").withColumn("range", F.spark_partition_id()), "ranged")
    full = F.when(
        (F.col("status") == FULL) & F.col("url_key").isNotNull() & F.col("at").isNotNull(),
        F.struct("at", "record_id", "payload_digest", "headers"))
    # equal instants of a URL share a range, so all that is carried over is strictly earlier
    carried = stage(
        ranged.groupBy("url_key", "range").agg(F.max(full).alias("best"))
        .withColumn("carried", F.max("best").over(
            Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
        .where("carried is not null").select("url_key", "range", "carried"),
        "carried",
    )
    earlier = Window.partitionBy("range", "url_key").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("near", F.max(full).over(earlier)).join(carried, ["url_key", "range"], "left")
    found = found.withColumn("source", F.when(
        (F.col("status") == NOT_MODIFIED) & F.col("at").isNotNull(), F.coalesce("near", "carried")))
    # a 304 is validated by weak comparison: W/"a" and "a" are the same
    opaque = lambda headers: F.regexp_replace(header(headers, "etag"), "^W/", "")
    tag, date = opaque(F.col("headers")), header(F.col("headers"), "last-modified")
    outcome = (
        F.when(F.col("status") == FULL, "full").when(~F.col("status").eqNullSafe(F.lit(NOT_MODIFIED)), "other")
        .when(F.col("source").isNull(), "no_earlier")
        .when(tag.isNotNull(), F.when(tag.eqNullSafe(opaque(F.col("source.headers"))), "resolved").otherwise("mismatch"))
        .when(date.isNotNull(), F.when(
            date.eqNullSafe(header(F.col("source.headers"), "last-modified")), "resolved").otherwise("mismatch"))
        .otherwise("trusted")
    )
    found = found.withColumn("outcome", outcome)
    taken = F.col("outcome").isin("resolved", "trusted")
    own = F.col("outcome") == "full"
    return found.select(
        "record_id", "url_key", "outcome",
        F.when(taken, F.col("source.record_id")).when(own, F.col("record_id")).alias("source_id"),
        F.when(taken, F.col("source.payload_digest")).when(own, F.col("payload_digest")).alias("payload_digest"),
        F.when(taken, merged_headers(F.col("source.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )


def with_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """``resolved`` with the payload of its source; ``payloads`` are (source_id, payload), each id once."""
    return resolved.join(payloads, "source_id", "left")
