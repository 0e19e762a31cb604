"""The whole pipeline against plain Python: every stage by brute force, the tokenizer by its own library."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SF001
from pyspark.sql import functions as F
from test_llm_documents import brute_contaminated, brute_fingerprint, brute_measures, words

from tradewatch.llm import quality as Q
from tradewatch.llm import secrets as X
from tradewatch.llm.common import table


def kept_by_quality(docs, good):
    def grams(text):
        w = words(text)
        h = lambda s, seed=42: xxhash.xxh64_intdigest(s, seed=seed)
        both = [h(x) for x in w] + [h(b, h(a)) for a, b in zip(w, w[1:])]
        return [(g - 2**64 if g >= 2**63 else g) % Q.BUCKETS for g in both]

    of = {i: grams(t) for i, t in docs}
    raw, trusted = Counter(b for g in of.values() for b in g), Counter(b for i in of if i in good for b in of[i])
    share = sum(trusted.values()) / sum(raw.values())
    ratio = {b: round(Q.MILLION * float(np.log((trusted[b] + Q.PRIOR * share) / ((n + Q.PRIOR) * share)))) for b, n in raw.items()}
    out = []
    for i, t in docs:
        n, _, _, _, repeated = brute_measures(t)
        margin = sum(ratio[b] for b in of[i]) - round(Q.THRESHOLD * Q.MILLION) * len(of[i])
        assert abs(margin) > len(of[i]) or not n  # no verdict hangs on the last digit of a logarithm
        if n >= 50 and 100 * repeated <= 50 * n and margin >= 0:
            out.append((i, t))
    return out


def one_of_each_group(docs):
    fps = [brute_fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    first = {}
    for g, (i, _) in zip(group, docs):
        first[g] = min(first.get(g, i), i)
    return [(i, t) for g, (i, t) in zip(group, docs) if first[g] == i]


def without_benchmark(docs, items):
    def shingles(t, k):
        w = words((t or "").lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    out = []
    for i, t in docs:
        near = []  # items without a common shingle are nothing like any window
        for n, item in items:
            k = min(5, len(words((item or "").lower())))
            if k and shingles(t, k) & shingles(item, k):
                near.append((n, item))
        if not brute_contaminated([(i, t)], near):
            out.append((i, t))
    return out


def masked(text):
    spans = []
    for r in X.RULES:
        for m in re.finditer(r.pattern, text):
            if len(m.group(r.group)) >= r.least:
                rest = re.search(X.KEY_REST, text[m.end() :]) if r.kind == "private_key" else None
                spans.append((m.start(), m.end() + (len(rest.group(0)) if rest else 0)))
    out, at, hidden = [], 0, -1
    for i, c in enumerate(text):
        if any(s <= i < e for s, e in spans):
            if hidden < at:  # first character of a run of secrets
                out.append(X.MASK)
            hidden = i + 1
            at = i + 1
        else:
            out.append(c)
            hidden = -1
            at = i + 1
    return "".join(out)


def test_masking_by_characters():
    assert masked("a AKIA" + "X" * 20 + " b") == f"a {X.MASK} b" and masked("") == "" and masked("plain") == "plain"
    two = "0123456789abcdef01234567 0123456789abcdef01234567"
    assert masked(two) == f"{X.MASK} {X.MASK}"


def test_pipeline_against_brute_force(spark, tmpdir_run):
    tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    import corpus_pipeline as P

    # The given tables, with a secret or two in one text of seven.
    secret = F.concat(F.lit(" password = 'hunter2hunter2' then AKIA"), F.lit("Q7Z" * 6), F.lit(" end"))
    given = table(spark, SF001, "documents")
    given.withColumn("text", F.when(F.col("doc_id") % 7 == 3, F.concat("text", secret)).otherwise(F.col("text"))).write.parquet(
        f"{tmpdir_run}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF001, name).write.parquet(f"{tmpdir_run}/{name}.parquet")
    docs = [(r.doc_id, r.text) for r in table(spark, tmpdir_run, "documents").collect()]
    good = {r.doc_id for r in table(spark, tmpdir_run, "labels").where("quality = 1").collect()}
    items = [(r.item_id, r.text) for r in table(spark, tmpdir_run, "benchmark").collect()]
    assert len({i for i, _ in docs}) == len(docs) and all(t is not None for _, t in docs)
    steps = [kept_by_quality(docs, good)]
    steps.append(one_of_each_group(steps[-1]))
    steps.append(without_benchmark(steps[-1], items))
    steps.append([(i, masked(t)) for i, t in steps[-1]])
    assert len(docs) > len(steps[0]) > len(steps[1]) > len(steps[2]) > 50
    assert any(X.MASK in t for _, t in steps[3])
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))
    want = set()
    for i, t in steps[3]:
        ids = sp.encode(t, add_bos=True, add_eos=True)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        want.add((i, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(sp.decode(ids).encode())))
    got = P.run(spark, tmpdir_run).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)
