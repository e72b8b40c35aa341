import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitaspan.llm import periodic_runs as pr

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words, min_length=24, min_exponent=3):
    """All maximal stretches of every period, kept if no shorter period holds for the stretch."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            if length >= max(min_length, min_exponent * q) and (start, length) not in found:
                found[start, length] = q
            i = j + 1
    return sorted(((s, l, q) for (s, l), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(text, doc_id):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def digest(words):
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + l for s, l, q in runs)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *tail, sha("".join(f"{s},{l},{q}\n" for s, l, q in runs)), sha(" ".join(kept))


def numbers(texts):
    return np.array([x for t in texts for x in t], dtype=np.int64), [len(t) for t in texts]


blocks = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 8)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=4), st.sampled_from([(24, 3), (6, 2), (3, 3), (4, 2), (12, 4)]))
def test_runs_match_brute_force(texts, limits):
    texts = [[x for block, times in t for x in block * times] for t in texts]
    assert pr.find_runs(*numbers(texts), *limits) == [brute(t, *limits) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90))
def test_two_letters(text):
    assert pr.find_runs(*numbers([text]), 2, 2) == [brute(text, 2, 2)]
    assert pr.find_runs(*numbers([text]), 24, 3) == [brute(text)]


def test_words_of_fibonacci():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert pr.find_runs(*numbers([b, b]), 6, 2) == [brute(b, 6, 2)] * 2


def test_equal_texts_do_not_meet():
    text = list(range(40))
    assert pr.find_runs(*numbers([text, text, text]), 24, 3) == [[], [], []]


def test_long_texts():
    """One word over and over, a long period, and many equal runs parted by other words."""
    n = 200_000
    assert pr.find_runs(*numbers([[7] * n]), 24, 3) == [[(0, n, 1)]]
    assert pr.find_runs(*numbers([list(range(1000)) * 50]), 24, 3) == [[(0, 50_000, 1000)]]
    parted = [x for k in range(500) for x in [0, 1] * 20 + [k + 2]]
    got = pr.find_runs(*numbers([parted]), 24, 3)[0]
    assert got == [(41 * k, 40, 2) for k in range(500)]


def test_table(spark):
    rng = np.random.default_rng(3)
    loop = " ".join(["alpha", "beta", "gamma"] * 12)
    texts = [None, "", " \n ", "one", "one " * 23, "one " * 24, loop, f"x {loop} y {loop} z", "é 漢\x0b" * 20, "word " * 100_000]
    texts += [" ".join(rng.choice(["a", "b"], 120)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, loop)] * 2 + [(None, loop)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(0)).withColumn("n_words", F.lit("clash"))
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.detect(df).collect()), key=str)
    want = []
    for i, t in rows:
        words = WORD.findall(t or "")
        runs = brute(words) if len(words) < 1000 else [(0, len(words), 1)]
        kept = words[:1] if len(words) >= 1000 else [w for k, w in enumerate(words) if not any(s + q <= k < s + l for s, l, q in runs)]
        want.append((i, len(words), runs, " ".join(kept)))
    assert got == sorted(want, key=str)
    assert pr.detect(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pr.detect(df, 24, 1)


def test_strongest_run_and_list(spark):
    kind = "doc_id long, runs array<struct<start: long, length: long, period: long>>"
    rows = [(0, []), (1, [(0, 30, 10), (2, 33, 11), (5, 24, 2), (9, 48, 4)]), (2, [(0, 30, 10), (0, 33, 11)]), (3, [(0, 2_000_000, 3), (1, 2_000_001, 3)])]
    df = spark.createDataFrame(rows, kind)
    got = {r[0]: (r[1] and tuple(r[1]), r[2]) for r in df.select("doc_id", pr.strongest(F.col("runs")), pr.listed(F.col("runs"))).collect()}
    assert got == {0: (None, ""), 1: ((5, 24, 2), "0,30,10\n2,33,11\n5,24,2\n9,48,4\n"), 2: ((0, 30, 10), "0,30,10\n0,33,11\n"),
                   3: ((1, 2_000_001, 3), "0,2000000,3\n1,2000001,3\n")}


def test_query(spark):
    from vitaspan.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, folder).collect()}
    assert got == {i: digest(planted(t, i)) for i, t in docs.items()}
    assert any(r[0] for r in got.values()) and any(r[0] == 0 for r in got.values())
