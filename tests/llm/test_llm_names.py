"""Columns of the user's that are called like an operator's own: values, names and order stay."""

import pytest
from pyspark.sql import functions as F

from tradewatch.llm import components as CO
from tradewatch.llm import decontam as D
from tradewatch.llm import quality as Q
from tradewatch.llm import secrets as S
from tradewatch.llm import simhash as SH

INTERNAL = (
    "__key __id __first __bad __kinds __r0 __r1 __all __found __masked __m __w __h __p __lines __llr __good __quality "
    "c0 c1 c2 key h fp low part ident quality secrets kinds text_key dotted.name"
).split()
PLAIN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
LEAK = "password: hunter22hunter22 and then some more words that nobody would look at twice today"


def frame(spark):
    rows = [(1, PLAIN), (2, PLAIN), (3, LEAK), (4, ""), (5, None), (None, LEAK + " more"), (7, " ".join(f"w{i}" for i in range(80)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    mine = [F.concat(F.lit(f"{c}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in INTERNAL]
    half = len(mine) // 2
    return docs.select(*mine[:half], "doc_id", "text", *mine[half:])


def untouched(got, docs):
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = got.collect()
    for r in rows:
        own = "-" if r.doc_id is None else str(r.doc_id)
        for c in INTERNAL:
            assert r[c] == f"{c}|{own}", c
    return rows


STAGES = {
    "keep_one": lambda spark, d: SH.keep_one(d),
    "drop_contaminated": lambda spark, d: D.drop_contaminated(d, spark.createDataFrame([(1, PLAIN)], "item_id long, text string")),
    "redact": lambda spark, d: S.redact(d),
    "keep_good": lambda spark, d: Q.keep_good(d, spark.createDataFrame([(7, 1)], "doc_id long, quality int")),
}
LEFT = {
    "keep_one": {1, 3, 4, None, 7},
    "drop_contaminated": {3, 4, 5, None, 7},
    "redact": {1, 2, 3, 4, 5, None, 7},
    "keep_good": {7},
}


@pytest.mark.parametrize("stage", sorted(STAGES))
def test_columns_stay(spark, stage):
    docs = frame(spark)
    got = STAGES[stage](spark, docs)
    assert got.columns == docs.columns
    rows = untouched(got, docs)
    assert {r.doc_id for r in rows} == LEFT[stage]
    bare = STAGES[stage](spark, docs.select("doc_id", "text")).collect()
    assert sorted(map(str, bare)) == sorted(str(type(r)(doc_id=r.doc_id, text=r.text)) for r in rows)


def test_added_columns(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(7, 1)], "doc_id long, quality int")
    rows = untouched(S.find_secrets(docs, out="spans"), docs)
    assert {r.doc_id for r in rows if r.spans} == {3, None}
    rows = untouched(Q.judge_documents(docs, labels, out="verdict"), docs)
    assert {r.doc_id for r in rows if r.verdict.kept} == {7}


def test_components_of_hub_and_chain(spark):
    hub = [(0, i) for i in range(1, 400)]
    chain = [(1000 + i, 1001 + i) for i in range(37)]
    odd = [(5, 5), (None, 3), (3, None), (2, 0), (0, 2)]
    got = CO.components(spark.createDataFrame(hub + chain + odd, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(400)}, **{1000 + i: 1000 for i in range(38)}}
    assert len(got) == 438
