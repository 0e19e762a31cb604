"""URL filters: path rules first, link-graph propagation for the rest.

A rule names a host (with all its subdomains) and a path prefix; the longest rule that fits
a URL decides. Where none fits, the host decides: trust flows from hosts with allowed pages
along links, distrust from hosts with blocked pages against them (who links to blocked
hosts earns distrust). Both are personalised PageRank over the host graph, in whole
millionths: every sum is exact, so the outcome does not depend on order or partitioning.

A host's seed is the share of its pages that the rules allow (or block). The walk restarts
at the seeds with probability 0.15; a host without links to other hosts keeps its own mass.

Links share a host's mass out among its neighbours, which says nothing against the host's own
pages, so its scores count as its seeds at least. A host is blocked if its distrust then exceeds
its trust by ``MARGIN``. A host of which the rules say nothing has only what links bring, the less
the more hosts share it: it is blocked if that is at least ``LINKED`` and ``TIMES`` its trust.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import ascii_lower, cut, discard, settle

ROUNDS = 20
MILLION = 1_000_000
KEEP = 850_000  # of a million: what a step passes on
MARGIN = 500_000
LINKED = 100_000
TIMES = 3
MOST_RULES = 1_000  # rules are a policy list, written into the expression
# An absolute or scheme-relative link; links without a host stay on their own host.
LINK = r"(?i)href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


class UrlRule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, null if none fits; of equally long ones the first by text."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path and ``fit``."""
    d = settle(pages, host=host_of(pages["url"]), path=path_of(pages["url"]))
    return settle(d, fit=fitting_rule(F.col("host"), F.col("path"), rules))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): between different hosts, n the pages of src that link to dst."""
    to = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), ascii_lower))
    links = pages.select(host_of(pages["url"]).alias("src"), F.explode(to).alias("dst"))
    return links.where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def _passed(mass: str, links: str | None = None) -> Column:
    """What a step passes on of a mass, or a link's share of it. Products are decimals, as a mass of 10^13 times
    ``KEEP``, or times the pages of a large host, is more than a long holds; the quotients are not."""
    part = f"cast({mass} as decimal(38,0)) * {KEEP} div {MILLION}"
    return F.expr(part if links is None else f"cast({part} as decimal(38,0)) * n div {links}")


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, good, bad, trust, distrust) in millionths from seeds (host, good, bad) and edges (src, dst, n).

    Each round is one equi-join of the edges with the hosts' state and one pre-aggregated sum,
    written to the shared folder. It ends early only when a round changes nothing, as then no
    later round would.
    """
    edges = cut(edges)  # read five times and in every round
    ends = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    nodes = seeds.join(ends, "host", "full").select(
        "host", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "bad")]
    )
    out_n = edges.groupBy(F.col("src").alias("host")).agg(F.sum("n").alias("out_n"))
    in_n = edges.groupBy(F.col("dst").alias("host")).agg(F.sum("n").alias("in_n"))
    nodes = cut(nodes.join(out_n, "host", "left").join(in_n, "host", "left"))
    state = cut(nodes.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust")))
    for _ in range(rounds):
        full = nodes.join(state, "host")
        none = F.lit(0).cast("long")
        own = full.select(
            "host",
            # Without a link out (or in) the mass stays.
            F.when(F.col("out_n").isNull(), _passed("trust")).otherwise(none).alias("t"),
            F.when(F.col("in_n").isNull(), _passed("distrust")).otherwise(none).alias("d"),
        )
        along = edges.join(full.withColumnRenamed("host", "src"), "src").select(
            F.col("dst").alias("host"), _passed("trust", "out_n").alias("t"), none.alias("d")
        )
        against = edges.join(full.withColumnRenamed("host", "dst"), "dst").select(
            F.col("src").alias("host"), none.alias("t"), _passed("distrust", "in_n").alias("d")
        )
        got = own.union(along).union(against).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        restart = lambda c: F.expr(f"{c} * {MILLION - KEEP} div {MILLION}")
        new = full.join(got, "host").select(
            "host",
            (restart("good") + F.col("t")).alias("trust"),
            (restart("bad") + F.col("d")).alias("distrust"),
            ((restart("good") + F.col("t") != F.col("trust")) | (restart("bad") + F.col("d") != F.col("distrust"))).alias("moved"),
        )
        new = cut(new)
        discard(state)
        state = new
        if state.where("moved").isEmpty():
            break
    return state.join(nodes, "host").select("host", "good", "bad", "trust", "distrust")


def judge_urls(pages: DataFrame, rules=RULES, margin: int = MARGIN, rounds: int = ROUNDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust): one row per row of ``pages``.

    A null URL or one without ``://`` has an empty host and path, fits no rule and is judged
    as the host "" (no links lead there). Null html has no links. Repeated rows keep their
    rows; an empty table gives an empty result; other columns are not read.
    """
    urls = pages.select("page_id", "url")
    shares = parsed(urls, rules).groupBy("host").agg(
        *[
            F.expr(f"count_if(fit.verdict = '{v}') * {MILLION} div count(*)").alias(c)
            for v, c in (("allow", "good"), ("block", "bad"))
        ]
    )
    scores = propagate(cut(shares), host_edges(pages.select("url", "html")), rounds)
    for_it, against = F.greatest("trust", "good"), F.greatest("distrust", "bad")
    by_links = (F.col("good") == 0) & (F.col("bad") == 0) & (against >= LINKED) & (against >= TIMES * for_it)
    verdict = F.when((against - for_it >= margin) | by_links, "block").otherwise("allow")
    return (
        parsed(urls, rules)
        .join(scores, "host")
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce(F.col("fit.verdict"), verdict).alias("verdict"),
            "trust",
            "distrust",
        )
    )
