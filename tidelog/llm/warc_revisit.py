"""Resolution of not-modified revisits in web archives.

A revisit record stores no body: it says that a resource had not changed. It is resolved
against the latest earlier full response of the same canonical URL (an as-of join): if
its validators agree with that response, the stored headers are updated with those that
a 304 answer may change, and the stored body counts for the revisit.

The join is a scan in order of (URL, time) over ranges of that order. Within a range the
last response so far is carried on; across ranges only the last response of each range
is passed on, one row a range. A URL with a third of all captures is so many ranges, not
one task. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, range_buckets, ranges_of

#: Headers that a 304 answer may bring up to date in a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified")

#: Query parameters that don't change a resource.
TRACKING = "utm_[a-z]+|gclid|fbclid|sessionid|phpsessid|ref"


def canonical_url(url: Column) -> Column:
    """One spelling per resource: no scheme, ``www.``, user, default port, fragment, tracking parameter or last slash."""
    out = F.regexp_replace(F.trim(url), "#.*", "")
    out = F.regexp_replace(out, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(out, "^([^/?]*)", 1))
    rest = F.regexp_replace(out, "^[^/?]*", "")
    host = F.regexp_replace(host, "^[^@]*@", "")
    host = F.regexp_replace(host, ":(80|443)$", "")
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    rest = F.regexp_replace(rest, rf"([?&])(({TRACKING})=[^&]*&?)+", "$1")
    rest = F.regexp_replace(rest, "[?&]+$", "")
    rest = F.regexp_replace(rest, "/+$", "")
    return F.concat(host, rest)


def weak_etag(tag: Column) -> Column:
    """The opaque part of an entity tag, for the weak comparison that a 304 asks for."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def validators(revisit_etag: Column, revisit_modified: Column, stored_etag: Column, stored_modified: Column) -> Column:
    """``etag``, ``last-modified`` or ``none`` if that agrees (none: nothing to compare), else ``mismatch``."""
    tags = revisit_etag.isNotNull() & stored_etag.isNotNull()
    dates = revisit_modified.isNotNull() & stored_modified.isNotNull()
    return (
        F.when(tags, F.when(weak_etag(revisit_etag) == weak_etag(stored_etag), F.lit("etag")).otherwise(F.lit("mismatch")))
        .when(dates, F.when(revisit_modified == stored_modified, F.lit("last-modified")).otherwise(F.lit("mismatch")))
        .otherwise(F.lit("none"))
    )


def merge_headers(stored: Column, revisit: Column) -> Column:
    """Stored headers, with the permitted ones of the 304 answer in place of theirs."""
    fresh = F.map_filter(revisit, lambda k, _: k.isin(*PERMITTED))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.map_contains_key(fresh, k)), fresh)


def resolve_revisits(captures: DataFrame, *, unchecked: bool = True) -> DataFrame:
    """Resolve every revisit of ``captures``.

    Columns read: ``record_id`` long, ``url`` string, ``captured`` timestamp or number,
    ``is_revisit`` boolean, ``headers`` map with lower-case names (null: none). Returns a
    row per revisit: ``record_id, url_key, captured, response_id, validator, resolved,
    headers``. ``resolved`` is false, with the revisit's own headers, if there is no
    earlier response (``validator`` null) or its validators don't agree. A pair that has no
    validator in common can't be checked (``validator`` is "none"): with ``unchecked``, the
    server's word that nothing was modified stands and it is resolved, without it is not.

    Earlier means a smaller ``captured``; of responses at one time the largest record id
    counts, and a response at the time of the revisit is not earlier. Rows without URL or
    time can't be placed: such revisits come back unresolved, such responses serve none.
    ``is_revisit`` null counts as false. Repeated rows are kept. Other columns aren't read.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = captures.select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url(F.col("url").cast("string")).alias("url_key"),
        "captured",
        F.coalesce(F.col("is_revisit"), F.lit(False)).alias("is_revisit"),
        F.coalesce("headers", none).alias("headers"),
    )
    lost = rows.where(F.col("url_key").isNull() | F.col("captured").isNull())
    rows = rows.where(F.col("url_key").isNotNull() & F.col("captured").isNotNull())
    # A revisit sorts before a response of its own time.
    keys = ["url_key", "captured", F.when(F.col("is_revisit"), 0).otherwise(1).alias("kind"), "record_id"]
    rows = rows.withColumn("kind", keys[2])
    keys = [F.col("url_key"), F.col("captured"), F.col("kind"), F.col("record_id")]
    rows = materialize(rows, "captures")  # ranges are drawn from a sample of the rows, which aren't made twice for it
    size = F.octet_length("url_key") + F.aggregate(F.map_values("headers"), F.lit(64), lambda n, v: n + F.coalesce(F.octet_length(v), F.lit(0)))
    ranged = range_buckets(rows, keys, "ranges", ranges=ranges_of(rows, size))
    discard(rows)
    stored = F.when(~F.col("is_revisit"), F.struct("url_key", "record_id", "headers"))
    # The last row of each range, and the last response of its URL in the ranges up to it.
    order = F.struct("url_key", "captured", "kind", "record_id")
    ends = ranged.groupBy("bucket").agg(F.max("url_key").alias("last_url"), F.max_by(stored, F.when(~F.col("is_revisit"), order)).alias("last_response"))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("bucket", F.last("last_response", ignorenulls=True).over(ahead).alias("carried"))
    inside = Window.partitionBy("bucket", "url_key").orderBy("captured", "kind", "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranged.withColumn("seen", F.last(stored, ignorenulls=True).over(inside)).where("is_revisit")
    joined = seen.join(carried, "bucket", "left")
    earlier = F.coalesce("seen", F.when(F.col("carried.url_key") == F.col("url_key"), F.col("carried")))
    found = joined.select("record_id", "url_key", "captured", "headers", earlier.alias("stored"))
    get = lambda column, name: F.try_element_at(column, F.lit(name))
    check = validators(get(F.col("headers"), "etag"), get(F.col("headers"), "last-modified"), get(F.col("stored.headers"), "etag"), get(F.col("stored.headers"), "last-modified"))
    found = found.withColumn("validator", F.when(F.col("stored").isNotNull(), check))
    resolved = F.coalesce(~F.col("validator").isin("mismatch", *([] if unchecked else ["none"])), F.lit(False))
    out = found.select(
        "record_id",
        "url_key",
        "captured",
        F.col("stored.record_id").alias("response_id"),
        "validator",
        resolved.alias("resolved"),
        F.when(resolved, merge_headers(F.col("stored.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )
    unplaced = lost.where("is_revisit").select("record_id", "url_key", "captured", F.lit(None).cast("long").alias("response_id"), F.lit(None).cast("string").alias("validator"), F.lit(False).alias("resolved"), "headers")
    return out.unionByName(unplaced)
