"""Not-modified revisits resolved against earlier captures.

A revisit (a 304 answer) has no body: it stands for the latest earlier full response of the
same canonical URL. Whether it really does is checked by its validators, and the headers
that a 304 may renew are merged into that response's headers.

The as-of join works on distinct (URL, second) points in time blocks: inside a block a
window finds the latest response, and a second window over one row per (URL, block) carries
it across blocks. A block holds no more points than it has seconds, and a URL no more rows
at the second level than there are blocks, however many records a hot URL has; its records
meet their answers in an equi-join that can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import ascii_lower

BLOCK_SECONDS = 3_600
# The header fields that a 304 answer may renew.
RENEWABLE = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that name a visit, not a document.
TRACKING = r"^(utm_[^=]*|ref)(=.*)?$"


def canonical_url(url: Column) -> Column:
    """Key of a URL: no scheme, fragment, leading ``www.``, default port, trailing slashes or
    tracking parameters; A-Z lower-cased in the host; parameters sorted. Null counts as empty."""
    u = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)#.*$", "")
    host = ascii_lower(F.regexp_extract(u, r"(?s)^.*?://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"(?s)^.*?://[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.split(F.regexp_extract(u, r"(?s)^[^?]*\?(.*)$", 1), "&")
    kept = F.array_join(F.sort_array(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def lower_names(headers: Column) -> Column:
    """Header map with lower-case names; of names that then are equal the last entry counts. Null: no headers."""
    pairs = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    names = F.array_distinct(F.transform(pairs, lambda e: ascii_lower(e["key"])))
    last = lambda n: F.element_at(F.filter(pairs, lambda e: ascii_lower(e["key"]) == n), -1)["value"]
    return F.map_from_arrays(names, F.transform(names, last))


def merge_headers(response: Column, revisit: Column) -> Column:
    """The response's headers with those renewed that a 304 may renew. Names are lower-case on both sides."""
    new = F.map_filter(revisit, lambda k, _: k.isin(*RENEWABLE))
    return F.map_concat(F.map_filter(response, lambda k, _: ~F.map_contains_key(new, k)), new)


def latest_earlier(points: DataFrame, responses: DataFrame, block: int = BLOCK_SECONDS) -> DataFrame:
    """(url, ts, found): for every distinct (url, ts) of ``points`` the response of greatest time before ts.

    ``responses``: (url, ts, record) with one row per (url, ts). Times are whole seconds.
    """
    record = responses.schema["record"].dataType.simpleString()
    kind = f"struct<ts:bigint,record:{record}>"
    slot = F.floor(F.col("ts") / block).alias("block")
    asks = points.select("url", "ts", slot, F.lit(0).alias("what"), F.lit(None).cast(kind).alias("r"))
    gives = responses.select("url", "ts", slot, F.lit(1).alias("what"), F.struct("ts", "record").cast(kind).alias("r"))
    # At equal times the question comes before the response: strictly earlier ones answer it.
    inside = Window.partitionBy("url", "block").orderBy("ts", "what").rowsBetween(Window.unboundedPreceding, 0)
    near = asks.union(gives).withColumn("near", F.last("r", ignorenulls=True).over(inside)).where("what = 0")
    ends = asks.union(gives).groupBy("url", "block").agg(F.max_by("r", F.when(F.col("what") == 1, F.col("ts"))).alias("end"))
    before = Window.partitionBy("url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    far = ends.select("url", "block", F.last("end", ignorenulls=True).over(before).alias("far"))
    return near.join(far, ["url", "block"]).select("url", "ts", F.coalesce("near", "far").alias("found"))


def resolve_revisits(revisits: DataFrame, responses: DataFrame, block: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit: record_id, url (canonical), ts, response_id, response_ts, outcome, headers.

    Both inputs: record_id, url, ts (whole seconds), headers (map). Outcomes: ``resolved``;
    ``no_earlier`` (no earlier response; a null time likewise); ``etag_mismatch`` and
    ``date_mismatch`` (a validator that the revisit names differs from the response's or is
    missing there; the entity tag is looked at first); ``unverified`` (the revisit names
    neither). Only resolved rows have merged headers; the others keep their own. Of responses
    of one URL and second the greatest record_id counts, nulls last. Null URLs share the empty
    key; null times never answer; repeated revisits keep their rows; empty tables are fine;
    other columns are not read.
    """
    asked = revisits.select(
        "record_id", canonical_url(F.col("url")).alias("url"), F.col("ts").cast("long").alias("ts"),
        lower_names(F.col("headers")).alias("own"),
    )
    given = responses.where("ts IS NOT NULL").select(
        canonical_url(F.col("url")).alias("url"), F.col("ts").cast("long").alias("ts"), "record_id",
        F.map_entries(lower_names(F.col("headers"))).alias("h"),
    )
    # Maps do not compare, so entries are carried; one response for each URL and second.
    one = given.groupBy("url", "ts").agg(F.max(F.struct("record_id", "h")).alias("record"))
    points = asked.select("url", "ts").where("ts IS NOT NULL").distinct()
    answers = latest_earlier(points, one, block)
    rows = asked.join(answers, ["url", "ts"], "left")
    theirs = F.map_from_entries(F.col("found.record.h"))
    etag, date = F.col("own")["etag"], F.col("own")["last-modified"]
    outcome = (
        F.when(F.col("found").isNull(), "no_earlier")
        .when(etag.isNotNull() & ~etag.eqNullSafe(theirs["etag"]), "etag_mismatch")
        .when(etag.isNull() & date.isNotNull() & ~date.eqNullSafe(theirs["last-modified"]), "date_mismatch")
        .when(etag.isNull() & date.isNull(), "unverified")
        .otherwise("resolved")
    )
    rows = rows.withColumn("outcome", outcome)
    return rows.select(
        "record_id",
        "url",
        "ts",
        F.col("found.record.record_id").alias("response_id"),
        F.col("found.ts").alias("response_ts"),
        "outcome",
        F.when(F.col("outcome") == "resolved", merge_headers(theirs, F.col("own"))).otherwise(F.col("own")).alias("headers"),
    )


def page_captures(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(revisits, responses) of a crawl derived from a table of pages.

    Every page is captured once, a minute after the page before it, and visited again at a
    time that its URL's digest sets (for some before, or in the second of, the capture). The
    digest also sets which validators the second answer names: a stale or a right entity tag,
    the date of the capture, or none.
    """
    at = F.col("page_id") * 60
    digest = F.md5(F.coalesce("url", F.lit("")).cast("binary"))
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    pick = F.substring(digest, 2, 1)
    full = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("Cache-Control"), F.lit("max-age=60"),
        F.lit("ETag"), tag, F.lit("Last-Modified"), at.cast("string"),
    )
    later = at + (F.ascii(F.substring(digest, 1, 1)) - 50) * 1800
    common = (F.lit("Date"), later.cast("string"), F.lit("Server"), F.lit("second"), F.lit("Cache-Control"), F.lit("max-age=600"))
    answer = (
        F.when(pick.isin("0", "1"), F.create_map(*common, F.lit("ETag"), F.lit('"stale"')))
        .when(pick.isin("2", "3"), F.create_map(*common, F.lit("Last-Modified"), at.cast("string")))
        .when(pick == "4", F.create_map(*common))
        .otherwise(F.create_map(*common, F.lit("ETag"), tag))
    )
    responses = pages.select(F.col("page_id").alias("record_id"), "url", at.alias("ts"), full.alias("headers"))
    revisits = pages.select(F.col("page_id").alias("record_id"), "url", later.cast("long").alias("ts"), answer.alias("headers"))
    return revisits, responses
