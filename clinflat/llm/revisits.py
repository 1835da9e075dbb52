"""Not-modified revisits of web captures, resolved to the response they repeat.

A revisit record says that a page had not changed; its content is that of the latest
earlier full response of the same canonical URL. The as-of join runs on captures sorted by
(URL, time) over ranges, so one URL with very many captures spans several partitions;
only the last full response of each URL and partition is carried over to later ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.texts import ascii_lower
from clinflat.session import stage

# Header fields of a 304 response that don't update the stored response.
# They describe the message or the connection and not the content.
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range",
    "content-type", "keep-alive", "proxy-authenticate", "proxy-authentication-info",
    "proxy-authorization", "proxy-connection", "set-cookie", "te", "trailer",
    "transfer-encoding", "upgrade",
)
TRACKING = "utm_"
ROW_BITS = 33
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """``host[:port]/path[?query]``: without scheme, user, leading ``www.``, default port,
    fragment and tracking parameters; host in lower case, parameters sorted. Null without
    a scheme or host."""
    parts = lambda k: F.regexp_extract(
        url, r"^\s*(?:([A-Za-z][A-Za-z0-9+.-]*)://)(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?", k
    )
    host = F.regexp_replace(ascii_lower(parts(2)), r"^www\.", "")
    port = F.when(ascii_lower(parts(1)) == "https", ":443$").otherwise(":80$")
    host = F.regexp_replace(host, port, F.lit(""))
    path = F.when(parts(3) == "", F.lit("/")).otherwise(parts(3))
    kept = F.filter(F.split(parts(4), "&"), lambda p: (p != "") & ~p.startswith(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    full = F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(host != "", full)


def _clean(headers: Column) -> Column:
    """Header fields with lower-case names; those without a name or value are left out."""
    named = F.filter(headers, lambda h: h["name"].isNotNull() & h["value"].isNotNull())
    fields = F.transform(
        named,
        lambda h: F.struct(
            ascii_lower(F.trim(h["name"])).alias("name"), F.trim(h["value"]).alias("value")
        ),
    )
    return F.coalesce(fields, F.array().cast(HEADERS))


def _field(headers: Column, name: str) -> Column:
    """The first value of a field, or null."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), 0)["value"]


def merged(stored: Column, update: Column) -> Column:
    """Stored fields, replaced by the update's where those are permitted."""
    new = F.filter(update, lambda h: ~h["name"].isin(*NOT_MERGED))
    old = F.filter(stored, lambda s: ~F.exists(new, lambda h: h["name"] == s["name"]))
    return F.concat(old, new)


def _verdict(found: Column, headers: Column) -> Column:
    """What the validators of a revisit say about the response that was found."""
    weak = lambda tag: F.regexp_replace(tag, "^W/", "")
    tag, stored_tag = (_field(h, "etag") for h in (headers, found["headers"]))
    date, stored_date = (_field(h, "last-modified") for h in (headers, found["headers"]))
    return (
        F.when(found.isNull(), "no_earlier_response")
        .when(
            tag.isNotNull() & stored_tag.isNotNull(),
            F.when(weak(tag) == weak(stored_tag), "resolved").otherwise("changed"),
        )
        .when(
            date.isNotNull() & stored_date.isNotNull(),
            F.when(date == stored_date, "resolved").otherwise("changed"),
        )
        .otherwise("no_validator")
    )


def resolve(
    records: DataFrame, id_col: str = "record_id", url_col: str = "url", time_col: str = "ts",
    status_col: str = "status", headers_col: str = "headers",
) -> DataFrame:
    """``record_id, canonical_url, ts, state, refers_to, headers``, a row for each record.

    A record of status 200 is a full response (state ``full``), of 304 a revisit, any other
    status or null is ``other``. A revisit refers to the latest full response of its
    canonical URL at a strictly earlier time (of several at that time, the one with the
    largest id). Entity tags are compared without regard to weakness, else the
    last-modified dates; state is ``resolved``, ``changed`` (they differ), ``no_validator``
    (nothing to compare) or ``no_earlier_response``. Records without a URL or time can
    neither be found nor find. Only a resolved revisit refers to a response; its headers
    are that response's with the permitted ones updated. Repeated records are resolved
    alike. ``headers`` is an array of (name, value); other columns are not read.
    """
    time = records[time_col].cast("timestamp")
    slim = records.select(
        records[id_col].alias("record_id"), canonical_url(records[url_col]).alias("url"),
        F.unix_micros(time).alias("micros"), records[status_col].cast("int").alias("status"),
        _clean(records[headers_col]).alias("headers"),
    )
    placed = F.col("url").isNotNull() & F.col("micros").isNotNull()
    slim = slim.withColumn("placed", placed)
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usable = slim.where("placed").repartitionByRange(parts, "url", "micros")
    sorted_ = stage(usable.withColumn("mid", F.monotonically_increasing_id()), "captures")
    sorted_ = sorted_.withColumn("part", F.shiftright("mid", ROW_BITS))
    full = F.when(F.col("status") == 200, F.struct("micros", "record_id", "headers"))
    sums = sorted_.groupBy("url", "part").agg(F.max(full).alias("last"))
    before = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("url", "part", F.last("last", ignorenulls=True).over(before).alias("old"))
    earlier = (
        Window.partitionBy("url", "part")
        .orderBy("micros")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    found = (
        sorted_.withColumn("near", F.max(full).over(earlier))
        .join(carried, ["url", "part"])
        .withColumn("found", F.coalesce("near", "old"))
    )
    names = "record_id", "url", "micros", "status", "headers", "found"
    none = F.lit(None).cast(found.schema["found"].dataType).alias("found")
    rest = slim.where("not placed").withColumn("found", none)
    together = found.select(*names).unionByName(rest.select(*names))
    state = (
        F.when(F.col("status") == 200, "full")
        .when(F.col("status") == 304, _verdict(F.col("found"), F.col("headers")))
        .otherwise("other")
    )
    resolved = F.col("state") == "resolved"
    both = merged(F.col("found")["headers"], F.col("headers"))
    return together.withColumn("state", state).select(
        "record_id", F.col("url").alias("canonical_url"),
        F.timestamp_micros("micros").alias("ts"), "state",
        F.when(resolved, F.col("found")["record_id"]).alias("refers_to"),
        F.when(resolved, both).otherwise(F.col("headers")).alias("headers"),
    )


def with_payload(
    resolved: DataFrame, records: DataFrame, payload_col: str = "payload",
    id_col: str = "record_id",
) -> DataFrame:
    """Resolved records with the payload of the response they refer to, else their own.

    Ids of ``records`` must be unique among those that are referred to.
    """
    own = records.select(records[id_col].alias("source"), records[payload_col].alias("payload"))
    source = F.coalesce(resolved["refers_to"], resolved["record_id"])
    return resolved.withColumn("source", source).join(own, "source", "left").drop("source")
