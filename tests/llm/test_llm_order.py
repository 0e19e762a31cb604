"""Importance resampling, periodic runs, suffix arrays and their removal of repeats, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tradewatch.llm import importance as I
from tradewatch.llm import periodic_runs as PR
from tradewatch.llm import queries as Q
from tradewatch.llm import suffix_dedup as SD
from tradewatch.llm.suffix_array import suffix_array

LONG = " ".join(f"w{i * i % 977}" for i in range(30_000))
# Nulls, empty and blank texts, a very long one, repeated rows and ids, and columns that clash with internal names.
ODD = [(None, None, 1), (901, None, 2), (902, "", 3), (903, " \t\n", 4), (904, LONG, 5), (905, "one two", 6), (905, "one two", 6),
       (None, "x y z " * 40, 7), (None, "x y z " * 40, 8), (906, "a b c " * 40, 9), (906, "é Ж " * 300, 10)]
ODD_SCHEMA = "doc_id long, text string, rank int"
CLASHING = ("id", "row", "score", "segment", "rank", "weight", "runs", "collapsed", "n_words", "gram", "digest", "text_key", "first", "starts", "at", "spans", "kept")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, odd):
    return spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))


def clashing(df):
    return df.withColumns({c: F.lit("own") for c in CLASHING if c not in df.columns})


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


# ------------------------------------------------------------------ importance resampling
FEATURE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, ngram=1):
    w = FEATURE.findall((text or "").translate(LOWER))
    return [" ".join(w[i : i + k]) for k in range(1, ngram + 1) for i in range(len(w) - k + 1)], len(w)


def ranked(pairs, target, percent=10, least=20, ngram=1, k=10_000, seed=2024):
    bucket = lambda t: [zlib.crc32(f.encode()) % k for f in features(t, ngram)[0]]
    s, t = Counter(b for _, x in pairs for b in bucket(x)), Counter(b for x in target for b in bucket(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (big_s + k) / ((s[i] + 1) * (big_t + k)))) for i in range(k)]
    out = []
    for i, x in pairs:
        weight = sum(gain[b] for b in bucket(x))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, features(x)[1], len(bucket(x)), weight, score))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    return out, able, percent * len(able) // 100


@pytest.mark.parametrize("ngram", [1, 2])
def test_ranks_against_brute_force(spark, docs, ngram):
    target = spark.read.parquet(f"{SF001}/benchmark.parquet")
    pairs = [tuple(r) for r in docs.collect()]
    want, able, top = ranked(pairs, [r.text for r in target.collect()], ngram=ngram)
    got = I.importance_ranks(docs.repartition(5), target, ngram=ngram).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    drawn = sorted((r for r in got if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in drawn] == list(range(1, top + 1))
    assert [tuple(r)[:5] for r in drawn] == able[:top]


def test_exact_ranks_of_ties_in_many_runs(spark):
    # Few scores, repeated ids: splitters fall between rows of one score and of one id.
    rng = random.Random(1)
    data = [(rng.choice([None, *range(5)]), rng.randrange(3), rng.randrange(2), i) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, score long, n_features long, row long").repartition(13)
    want = sorted(data, key=lambda r: (-r[1], r[0] is None, r[0] or 0, r[2], r[3]))
    for top in (None, 0, 1, 700, 3000):
        got = I.exact_ranks(df, "id", top).collect()
        assert len(got) == 3000
        drawn = sorted((r for r in got if r.rank), key=lambda r: r.rank)
        assert [tuple(r)[:4] for r in drawn] == want[: 3000 if top is None else top]
    assert I.exact_ranks(df.limit(0), "id", 5).count() == 0


def test_regular_samples_stand_for_all_rows():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, a + n), pa.int64())], names=["x"]) for a, n in ((0, 7), (7, 0), (7, 1000), (1007, 333))]
    out = [r for b in I._samples(iter(batches)) for r in b.to_pylist()]
    step = out[0]["stands_for"]
    assert [r["x"] for r in out] == list(range(0, 1340, step)) and I.SAMPLES <= len(out) <= 2 * I.SAMPLES
    assert list(I._samples(iter([]))) == []


def test_odd_rows_of_importance(spark, odd):
    target = spark.createDataFrame([("one two",), (None,), ("",)], "text string")
    plain = I.importance_ranks(odd, target)
    assert plain.count() == len(ODD)
    assert Counter(rows(I.importance_ranks(clashing(odd), target))) == Counter(rows(plain))
    assert all((r.n_features, r.weight) == (0, 0) for r in plain.where("doc_id in (901, 902, 903)").collect())
    assert I.importance_ranks(odd.limit(0), target).count() == 0
    assert I.importance_ranks(odd, target.limit(0)).count() == len(ODD)
    drawn = I.resample(clashing(odd), target, percent=60)
    ids = {r.doc_id for r in I.importance_ranks(odd, target, percent=60).where("rank is not null").collect()}
    assert drawn.columns == clashing(odd).columns and {r.doc_id for r in drawn.collect()} == ids - {None}
    with pytest.raises(ValueError, match="ids"):
        I.importance_ranks(odd.withColumn("doc_id", F.lit(1.5)), target)


# ------------------------------------------------------------------ periodic runs
def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def all_runs(w, least=24, exponent=3):
    n, out = len(w), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, exponent * q):
                s = w[i : i + size]
                if not any(s[d:] == s[:-d] for d in range(1, q)):
                    out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _sequence(rng):
    parts = []
    for _ in range(rng.randint(0, 4)):
        k = rng.choice([1, 2, 3, 8, 50])
        unit = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 11, 12, 13, 16, 17, 23, 24, 25, 31, 33, 47, 64]))]
        if rng.random() < 0.3:  # a short period inside a long one
            unit = [0] * len(unit) + unit[:3]
        parts += (unit * 8)[: rng.randint(0, 6 * len(unit) + 30)]
        parts += [rng.randrange(k + 1) for _ in range(rng.randint(0, 30))]
    return parts


def test_runs_against_all_lags():
    rng, n = random.Random(11), 0
    for _ in range(60):
        texts = [_sequence(rng) for _ in range(12)]
        text, runs = PR.find_runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]))
        for i, t in enumerate(texts):
            want = all_runs(t)
            n += len(want)
            assert [tuple(map(int, r)) for r in runs[text == i]] == want, t
    assert n > 500


def test_other_lengths_and_exponents():
    rng = random.Random(12)
    for least, exponent in ((24, 4), (60, 3), (100, 5)):
        for _ in range(10):
            t = _sequence(rng) + _sequence(rng)
            runs = PR.find_runs(np.array(t, np.int64), np.array([len(t)]), least, exponent)[1]
            assert [tuple(map(int, r)) for r in runs] == all_runs(t, least, exponent)
    for bad in ((24, 2), (23, 3)):
        with pytest.raises(ValueError):
            PR.find_runs(np.zeros(3, np.int64), np.array([3]), *bad)


def test_words_are_split_at_ascii_blanks_only():
    got, sizes = PR.split_words(pa.array(["  a b\x0bc\x1cd \n", None, "", " ", " x  y\r\n\tz"]))
    assert got.to_pylist() == ["a", "b", "c\x1cd", " x ", "y", "z"] and sizes.tolist() == [3, 0, 0, 0, 3]


def test_query_of_runs_against_brute_force(spark, docs, tmpdir_run):
    docs.write.parquet(f"{tmpdir_run}/documents.parquet")
    got = Q.op12_periodic_runs(spark, tmpdir_run).collect()
    want, n = Counter(), 0
    for i, text in [tuple(r) for r in docs.collect()]:
        w = words(text)
        if i is not None and w and zlib.crc32(str(i).encode()) % 10 == 0:
            g = zlib.crc32(str(i).encode()) // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(len(w))]
        if len(w) > 3000:
            want[i] += 1  # only counted: every lag is too slow here
            continue
        runs = all_runs(w)
        n += len(runs)
        gone = {j for s, size, q in runs for j in range(s + q, s + size)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        lines = digest("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        want[i, len(runs), *best, milli, lines, digest(" ".join(x for j, x in enumerate(w) if j not in gone))] += 1
    long = {k for k in want if not isinstance(k, tuple)}
    assert Counter(tuple(r) if r.doc_id not in long else r.doc_id for r in got) == want and n > 20


def test_long_periods(spark):
    """A very long text with long periods, some inside each other, by what it was made of."""
    rng = random.Random(3)
    noise = lambda n: [f"n{rng.randrange(10**9)}" for _ in range(n)]
    head, unit, small, tail = noise(500), noise(5000), noise(37), noise(500)
    text = " ".join(head + unit * 3 + unit[:123] + small * 9 + tail)
    got = PR.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(500, 15123, 5000), (15623, 333, 37)]
    assert got.collapsed == " ".join(head + unit + small + tail) and got.n_words == 500 + 15123 + 333 + 500


def test_odd_rows_of_runs(spark, odd):
    got = PR.periodic_runs(clashing(odd))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"] and Counter(rows(got)) == Counter(rows(PR.periodic_runs(odd)))
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert by[901] == by[902] == by[903] == [(0, [], "")] and by[905] == [(2, [], "one two")] * 2
    assert by[906][0] == (120, [(0, 120, 3)], "a b c") and by[None].count((120, [(0, 120, 3)], "x y z")) == 2
    assert by[904][0][0] == 30_000
    assert PR.periodic_runs(odd.limit(0)).count() == 0


# ------------------------------------------------------------------ suffix arrays
def test_suffix_array_against_sorting():
    rng = random.Random(7)
    for _ in range(3000):
        s = [rng.randrange(rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            s = ((s[: rng.randint(1, 5)] or [0]) * 20)[: len(s) + 5]
        assert suffix_array(np.array(s, np.int64)) == sorted(range(len(s)), key=lambda i: s[i:])
    words = [[0], [0, 1]]
    for _ in range(14):
        words.append(words[-1] + words[-2])  # as many groups and as deep pointers as can be
    for s in (words[-1], [0] * 500, list(range(500)), list(range(500))[::-1]):
        assert suffix_array(np.array(s)) == sorted(range(len(s)), key=lambda i: s[i:])


def removed(texts, length=400):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone, spans = np.zeros(len(b), bool), []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append((len(b), tuple(map(tuple, spans)), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def _planted(rng, n, length=400):
    """Texts that share passages around the limit, whole copies, periodic texts and many bytes to a character."""
    letters = "abcdefgh é漢\0"
    noise = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [noise(k) for k in (length - 1, length, length + 1, length + 37, 3 * length)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.15 and out:
            out.append(rng.choice(out))
        elif kind < 0.25:
            out.append(noise(rng.randint(1, 30)) * rng.randint(1, 80))
        else:
            parts = [noise(rng.randint(0, 300))]
            for _ in range(rng.randint(0, 3)):
                p = rng.choice(passages)
                a, z = rng.randint(0, 40), rng.randint(0, 40)
                parts += [p[a : len(p) - z] if rng.random() < 0.5 else p, noise(rng.choice([0, 1, 2, 200]))]
            out.append("".join(parts))
    return out


@pytest.mark.parametrize("most", [1, 5, 400])
def test_removal_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(SD, "MOST", most)  # every gram too hot, some, none
    rng = random.Random(most)
    for length, gram in ((60, 20), (400, 128)):
        texts = [None, "", "x", *_planted(rng, 60, length)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        got = SD.remove_repeats(df, length, gram).orderBy("doc_id").collect()
        assert [(r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in got] == removed(texts, length)


def test_removal_of_repeated_and_odd_rows(spark, odd):
    got = SD.remove_repeats(clashing(odd))
    assert got.columns == ["doc_id", "n_bytes", "spans", "kept"] and Counter(rows(got)) == Counter(rows(SD.remove_repeats(odd)))
    want = Counter(zip([r[0] for r in ODD], removed([r[1] for r in ODD])))
    assert Counter((r.doc_id, (r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept))) for r in got.collect()) == want
    assert SD.remove_repeats(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        SD.remove_repeats(odd, length=100, gram=90)


def test_a_passage_in_very_many_texts(spark):
    """More different stretches under one gram than a task holds, with edges that agree for some bytes."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(700))
    texts = [f"{i:05d} {'xyz'[i % 3]}{passage}{'uvw'[i % 3]}{'pq'[i % 2]} {i * 7919:07d}" for i in range(900)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = SD.remove_repeats(df).orderBy("doc_id").collect()
    assert [(r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in got] == removed(texts)
