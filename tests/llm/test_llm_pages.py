"""Page operators and the pipeline."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tradewatch.llm import url_filter as U
from tradewatch.llm import warc as W


# ------------------------------------------------------------------ URL filters
def brute_scores(good, bad, edges, rounds):
    hosts = set(good) | {h for e in edges for h in e[:2]}
    out, inn = {}, {}
    for s, d, n in edges:
        out[s] = out.get(s, 0) + n
        inn[d] = inn.get(d, 0) + n
    t, d = {h: good.get(h, 0) for h in hosts}, {h: bad.get(h, 0) for h in hosts}
    keep, m = U.KEEP, U.MILLION
    for _ in range(rounds):
        nt = {h: good.get(h, 0) * (m - keep) // m + (0 if h in out else t[h] * keep // m) for h in hosts}
        nd = {h: bad.get(h, 0) * (m - keep) // m + (0 if h in inn else d[h] * keep // m) for h in hosts}
        for a, b, n in edges:
            nt[b] += t[a] * keep // m * n // out[a]
            nd[a] += d[b] * keep // m * n // inn[b]
        t, d = nt, nd
    return {h: (t[h], d[h]) for h in hosts}


def page(i, url, *links):
    return (i, url, "".join(f"<a href='{x}'>x</a>" for x in links))


def test_propagation(spark):
    pages = [
        page(1, "https://a.com/x", "https://b.org/1", "//c.org/2", "/own"),
        page(2, "http://b.org/y", "HTTPS://C.ORG/z", "https://bad.net/q"),
        page(3, "http://spam.org/", "https://bad.net/es/1", "http://spam.org/self"),
        page(4, "https://bad.net/es/1"),
        page(5, "https://bad.net/fr/1", "https://spam.org/"),
        page(6, "https://bad.net/en/1"),
        page(7, None),
        page(8, "no scheme", "https://a.com"),
        (9, "http://A.COM", None),
        page(9, "http://A.COM:80/en/?x#y"),
        page(10, "http://x.example.com/en/2"),
        page(11, "https://www.example.com/en/2"),
        page(12, "https://www.example.com?u=://z/"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("trust", F.lit("clash"))
    rows = U.judge_urls(frame).collect()
    assert len(rows) == len(pages)
    by = {(r.page_id, r.path): r for r in rows}
    assert [by[k].rule for k in ((1, "/x"), (4, "/es/1"), (6, "/en/1"), (10, "/en/2"), (11, "/en/2"), (12, ""), (9, ""))] == [
        "com/", "net/es/", None, "example.com/en/", "www.example.com/en/", None, None]
    assert by[9, "/en/"].host == "a.com:80" and by[9, "/en/"].rule is None
    assert by[7, ""].host == by[8, ""].host == ""
    assert by[11, "/en/2"].verdict == "allow" and by[10, "/en/2"].verdict == "block"
    edges = [("a.com", "b.org", 1), ("a.com", "c.org", 1), ("b.org", "c.org", 1), ("b.org", "bad.net", 1), ("spam.org", "bad.net", 1), ("bad.net", "spam.org", 1)]
    assert {(r.src, r.dst, r.n) for r in U.host_edges(frame).collect()} == set(edges)
    m = U.MILLION
    good = {"a.com": m // 2, "www.example.com": m // 2, "b.org": 0, "": 0, "a.com:80": 0, "spam.org": 0, "bad.net": 0, "x.example.com": 0}
    bad = {"bad.net": 2 * m // 3, "x.example.com": m}
    want = brute_scores(good, bad, edges, U.ROUNDS)
    for r in rows:
        assert (r.trust, r.distrust) == want[r.host], r.host
        if r.rule is None:
            t, d = max(r.trust, good.get(r.host, 0)), max(r.distrust, bad.get(r.host, 0))
            unknown = not good.get(r.host) and not bad.get(r.host)
            assert r.verdict == ("block" if d - t >= U.MARGIN or unknown and d >= max(U.LINKED, U.TIMES * t) else "allow"), r.host
    assert by[6, "/en/1"].verdict == "block" and by[12, ""].verdict == "allow"
    assert U.judge_urls(frame.limit(0)).count() == 0


@pytest.mark.parametrize("linkers", [0, 1, 2, 5, 40])
def test_links_do_not_clear_a_blocked_host(spark, linkers):
    pages = [page(i, f"https://bad.net/es/{i}") for i in range(19)] + [page(19, "https://bad.net/en/1")]
    pages += [page(100 + i, f"https://l{i}.org/", "https://bad.net/en/1") for i in range(linkers)]
    pages += [page(500, "https://shop.com/"), page(501, "https://friend.org/")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    by = {r.page_id: r for r in U.judge_urls(frame).collect()}
    assert by[19].rule is None and by[19].verdict == "block"
    assert (by[500].verdict, by[501].verdict) == ("allow", "allow")
    if 0 < linkers <= 5:  # the host's mass is shared out: beyond that a linker gets too little to be blamed
        assert {by[100 + i].verdict for i in range(linkers)} == {"block"}
    if linkers == 40:
        assert {by[100 + i].verdict for i in range(linkers)} == {"allow"}


def test_masses_of_a_large_crawl(spark):
    """10^13 of mass and hosts of 10^8 linked pages: no overflow, equal to whole-number arithmetic of any size."""
    big = 20_000_000 * U.MILLION
    seeds = [("hub.com", big, 0), ("bad.net", 0, big), ("a.org", 0, 0), ("b.org", 0, 0)]
    edges = [("hub.com", "a.org", 10**8), ("hub.com", "b.org", 3), ("a.org", "bad.net", 10**8), ("b.org", "bad.net", 7), ("bad.net", "hub.com", 1)]
    got = U.propagate(spark.createDataFrame(seeds, "host string, good long, bad long"), spark.createDataFrame(edges, "src string, dst string, n long"))
    want = brute_scores({h: g for h, g, _ in seeds}, {h: b for h, _, b in seeds}, edges, U.ROUNDS)
    assert {r.host: (r.trust, r.distrust) for r in got.collect()} == want


# ------------------------------------------------------------------ revisits
def record(i, url, ts, **headers):
    return (i, url, ts, {k.replace("_", "-"): v for k, v in headers.items()})


def test_revisits(spark):
    schema = "record_id long, url string, ts long, headers map<string,string>"
    responses = [
        record(1, "http://www.A.org/x/?b=1&a=2&utm_source=q#f", 100, ETag='"1"', Server="old", Content_Type="text/html"),
        record(2, "https://a.org/x?a=2&b=1", 20_000, ETag='"2"', Last_Modified="d2"),
        record(3, "https://a.org/x?a=2&b=1", 20_000, ETag='"3"', Last_Modified="d3"),  # the same second: the greater id counts
        record(4, None, 5, ETag='"n"'),
        (5, "https://z.org", None, None),
        (6, "https://z.org", 50, None),
    ]
    revisits = [
        record(10, "https://a.org:443/x/?a=2&b=1", 100, ETag='"1"'),  # not earlier
        record(11, "https://a.org/x?a=2&b=1", 101, etag='"1"', Server="new", Date="now", cache_control="no"),
        record(12, "https://a.org/x?a=2&b=1", 19_999, ETag='"9"'),
        record(13, "https://a.org/x?a=2&b=1", 900_000, ETag='"3"'),  # many blocks later
        record(13, "https://a.org/x?a=2&b=1", 900_000, ETag='"3"'),
        record(14, "https://a.org/x?a=2&b=1", 30_000, Last_Modified="d3"),
        record(15, "https://a.org/x?a=2&b=1", 30_000, Last_Modified="d2"),
        record(16, "https://a.org/x?a=2&b=1", 30_000),
        record(17, "", 6, ETag='"n"'),
        (18, "https://z.org/", 60, {"ETag": "q"}),
        (19, "https://z.org/", None, None),
        (20, "https://unknown.org/", 60, None),
    ]
    frames = [spark.createDataFrame(x, schema).withColumn("outcome", F.lit(1)) for x in (revisits, responses)]
    got = W.resolve_revisits(*frames).collect()
    assert len(got) == len(revisits)
    by = {r.record_id: r for r in got}
    assert {i: (r.response_id, r.outcome) for i, r in by.items()} == {
        10: (None, "no_earlier"), 11: (1, "resolved"), 12: (1, "etag_mismatch"), 13: (3, "resolved"), 14: (3, "resolved"),
        15: (3, "date_mismatch"), 16: (3, "unverified"), 17: (4, "resolved"), 18: (6, "etag_mismatch"), 19: (None, "no_earlier"), 20: (None, "no_earlier")}
    assert by[11].headers == {"etag": '"1"', "server": "old", "content-type": "text/html", "date": "now", "cache-control": "no"}
    assert W.resolve_revisits(frames[0], frames[1].limit(0)).where("outcome <> 'no_earlier'").count() == 0
    assert W.resolve_revisits(frames[0].limit(0), frames[1]).count() == 0


# ------------------------------------------------------------------ pipeline
def test_pipeline(spark):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as P
    from tradewatch.llm import decontam, quality, secrets, simhash
    from tradewatch.llm.common import cut, table

    docs = table(spark, SF001, "documents")
    wide = docs.withColumn("key", F.lit("clash")).union(docs.limit(3).withColumn("key", F.lit("clash")))
    assert [n for n, _ in P.STAGES][0] == "quality_rules" and len(P.STAGES) == 5
    at, kept = wide, []
    for name, stage in P.STAGES[:-1]:
        at = cut(stage(spark, at, SF001))
        assert at.columns == wide.columns
        kept.append(at.count())
    assert kept[0] > kept[1] >= kept[2] == kept[3] > 0
    first = cut(P.STAGES[0][1](spark, docs, SF001))
    judged = quality.judge_documents(docs, table(spark, SF001, "labels"))
    assert first.count() == judged.where("quality.kept").count()
    second = cut(P.STAGES[1][1](spark, first, SF001))
    assert second.count() == simhash.near_duplicates(first).select("component_id").distinct().count()
    third = cut(P.STAGES[2][1](spark, second, SF001))
    assert decontam.contaminated(third, table(spark, SF001, "benchmark")).count() == 0
    fourth = cut(P.STAGES[3][1](spark, third, SF001))
    assert secrets.find_secrets(fourth).where("size(secrets) > 0").count() == 0
    assert P.run(spark, SF001).count() == fourth.count() == third.count()
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF001)
    assert empty.count() == 0
