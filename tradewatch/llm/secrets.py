"""Secret scans behind a trigram inverted index (native).

Each rule is a regular expression. From its syntax follows which strings every match must
hold, and from those a Boolean query over trigrams: alternatives of sets that must all
occur. The index has a posting (trigram, text) for every trigram of some query that a text
contains, on the lower-cased text. A rule's candidates are the texts whose postings cover
one of its sets; only these are matched against the expression. A rule whose expression
demands no trigram (a bare run of hex digits) is matched against every text.

Texts are told apart by their XXH64: copies share their postings, and a collision merely
adds a candidate, as matching decides.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product
from re import _constants as C  # the standard library's own syntax tree of an expression
from re import _parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import ascii_lower, cut, numbered, restored, settle


class Rule(NamedTuple):
    kind: str
    pattern: str  # means the same in Java and Python
    group: int = 0  # the group whose length counts
    least: int = 1  # its characters; shorter matches are dropped after matching


# Kinds, expressions and lengths of the base rules; their order breaks ties.
BASE_RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = (*BASE_RULES, *MORE_RULES)
MASK = "[SECRET]"
# What is masked after the first line of a private key: up to its last line, the next key or the end of the text.
KEY_REST = r"(?s)^.*?(?:-----END [A-Z ]{0,40}PRIVATE KEY-----|(?=-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)|\z)"
MOST_STRINGS = 64  # longer lists of possible strings are closed and begun anew

Need = frozenset  # trigrams that must all occur
_ANYTHING: list[Need] = [frozenset()]


def _trigrams(s: str) -> Need:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _any_of(needs: Iterable[Need]) -> list[Need]:
    """Alternatives without those that another one implies."""
    out: list[Need] = []
    for n in sorted(set(needs), key=lambda x: (len(x), sorted(x))):
        if not any(o <= n for o in out):
            out.append(n)
    return out


def _all_of(a: list[Need], b: list[Need]) -> list[Need]:
    both = _any_of(x | y for x, y in product(a, b))
    return both if len(both) <= MOST_STRINGS else min(a, b, key=len)  # either alone is needed too


def _strings(op, arg) -> set[str] | None:
    """The strings an element can stand for, lower-cased; None if they are many."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN:
        found: set[str] = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                found.add(chr(x).lower())
            elif kind is C.RANGE and x[1] - x[0] < 8:
                found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is C.SUBPATTERN:
        return _of_sequence(arg[-1])
    if op is C.BRANCH:
        parts = [_of_sequence(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] is not C.MAXREPEAT and arg[1] <= 4:
        one = _of_sequence(arg[2])
        if one is not None:
            found = {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)}
            return found if len(found) <= MOST_STRINGS else None
    return None


def _of_sequence(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        s = _strings(op, arg)
        if s is None or len(out) * len(s) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _needs(items) -> list[Need]:
    query, run = _ANYTHING, {""}

    def close() -> None:
        nonlocal query, run
        query, run = _all_of(query, _any_of(map(_trigrams, run))), {""}

    for op, arg in items:
        s = _strings(op, arg)
        if s is not None and len(s) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        close()
        if s is not None:
            run = s
        elif op is C.SUBPATTERN:
            query = _all_of(query, _needs(arg[-1]))
        elif op is C.BRANCH:
            query = _all_of(query, _any_of(n for x in arg[1] for n in _needs(x)))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] > 0:
            query = _all_of(query, _needs(arg[2]))
    close()
    return query


def trigram_query(pattern: str) -> list[Need]:
    """Alternatives of trigram sets: every match's lower-cased text holds all of one set.
    An empty list means that nothing is demanded and every text has to be scanned."""
    q = _needs(_parser.parse(pattern))
    return [] if any(not n for n in q) else q


def queries_frame(spark, rules=RULES) -> DataFrame:
    """(trigram, kind, alt, bit, full): one row per rule, alternative and trigram; ``full`` is the mask of the set."""
    rows = []
    for r in rules:
        for alt, need in enumerate(trigram_query(r.pattern)):
            if len(need) > 62:
                need = frozenset(sorted(need)[:62])  # part of a need is a weaker, still right need
            rows += [(t, r.kind, alt, 1 << i, (1 << len(need)) - 1) for i, t in enumerate(sorted(need))]
    schema = "trigram string, kind string, alt int, bit bigint, full bigint"
    lits = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, ("trigram", "kind", "alt", "bit", "full"))]) for row in rows]
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*lits)))


def postings(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """(trigram, text_key): the inverted index over the trigrams that some rule asks for."""
    terms = sorted({t for r in rules for n in trigram_query(r.pattern) for t in n})
    low = settle(docs.select(F.col(text_col).alias("t")).where("t IS NOT NULL"), key=F.xxhash64("t"), low=ascii_lower(F.col("t")))
    found = F.filter(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in terms]), lambda x: x.isNotNull())
    if not terms:
        found = F.array().cast("array<string>")
    return low.select(F.explode(found).alias("trigram"), F.col("key").alias("text_key"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(text_key, kinds): the intersected postings. The queries' frame has a few rows per rule."""
    q = F.broadcast(queries_frame(index.sparkSession, rules))
    hit = index.join(q, "trigram").groupBy("text_key", "kind", "alt").agg(
        F.bit_or("bit").alias("have"), F.max("full").alias("full")
    )
    return hit.where("have = full").groupBy("text_key").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule) -> tuple[Column, Column, Column]:
    """What lies between matches, the matches, and the groups whose length counts."""
    return (
        F.split(text, rule.pattern, -1),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)),
    )


def _placed(rule: Rule, order: int, between: Column, whole: Column, part: Column) -> Column:
    """Spans (start, order, end, kind) in code points. A match starts after all that lies before it."""
    empty = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    step = F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("b"), whole.alias("w"), part.alias("p"))

    def merge(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["b"])
        end = start + F.length(x["w"])
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        good = F.length(x["p"]) >= rule.least
        return F.struct(end.alias("at"), F.when(good, F.concat(a["found"], F.array(span))).otherwise(a["found"]).alias("found"))

    return F.aggregate(step, F.struct(F.lit(0).alias("at"), empty.alias("found")), merge, lambda a: a["found"])


def find_secrets(docs: DataFrame, rules=RULES, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with its columns as they are and ``out``, an array of (start, order, end, kind).

    Per rule the matches are leftmost and do not overlap; too short ones are dropped after
    matching. Places are in code points, the end exclusive; the array is in order of start,
    then of the rules. Null and empty texts have none; repeated rows have equal arrays; an
    empty table gives an empty result. A column named ``out`` is replaced, no other.
    """
    scan = [r.kind for r in rules if not trigram_query(r.pattern)]
    found = cut(candidates(postings(docs, rules, text_col), rules))
    docs, own = numbered(docs.drop(out))
    text_col = own[text_col]
    keyed = docs.withColumn("__key", F.xxhash64(docs[text_col]))
    hits = found.select(F.col("text_key").alias("__key"), F.col("kinds").alias("__kinds"))
    rows = keyed.join(hits, "__key", "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = {}
    for i, r in enumerate(rules):
        look = F.lit(True) if r.kind in scan else F.coalesce(F.array_contains("__kinds", r.kind), F.lit(False))
        # A quick look first: most texts have no match to take apart.
        look = look & text.rlike(r.pattern)
        parts[f"__r{i}"] = F.when(look, F.struct(*[c.alias(n) for n, c in zip("bwp", _spans(text, r))]))
    rows = settle(rows, **parts)
    spans = []
    for i, r in enumerate(rules):
        p = F.col(f"__r{i}")
        none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
        spans.append(F.when(p.isNull(), none).otherwise(_placed(r, i, p["b"], p["w"], p["p"])))
    rows = settle(rows, __all=F.sort_array(F.concat(*spans)))
    return rows.select(*restored(rows, own), F.col("__all").alias(out))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``MASK`` and ``n_chars`` counted anew.

    Of a private key all is masked: its first line, which is what the rule finds, the body and
    the last line; a key without a last line goes on to the next key or the end of the text.
    Spans that overlap or touch become one. Texts without a secret stay as they are, nulls included;
    so do all other columns, whatever their names.
    """
    docs, own = numbered(docs)
    text = own["text"]
    d = find_secrets(docs, rules, text, "__found")

    def whole(s: Column) -> Column:
        rest = F.regexp_extract(F.substring(F.col(text), s["end"] + 1, F.length(text)), KEY_REST, 0)
        end = F.when(s["kind"] == "private_key", s["end"] + F.length(rest)).otherwise(s["end"])
        return F.struct(s["start"].alias("start"), end.alias("end"))

    d = settle(d, __found=F.transform("__found", whole))
    spans = F.col("__found")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = (s["start"] > a["at"]) | (a["at"] == 0)
        gap = F.substring(F.col(text), a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        out = F.when(fresh, F.concat(a["out"], gap, F.lit(MASK))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    masked = F.aggregate(
        spans, start, step, lambda a: F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, F.length(text)))
    )
    d = settle(d, __masked=F.when(F.size(spans) > 0, masked))
    new = {"text": F.coalesce("__masked", text)}
    if "n_chars" in own:
        new["n_chars"] = F.when(F.col("__masked").isNotNull(), F.length("__masked").cast("long")).otherwise(F.col(own["n_chars"]))
    return d.select(*[new.get(c, F.col(n)).alias(c) for c, n in own.items()])
