import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vitaspan.llm import simhash
from vitaspan.llm.components import components


def brute_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """pairs: (doc_id, fp)"""
    up = {i: i for i, _ in pairs}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(pairs):
        for b, y in pairs[:i]:
            if (x ^ y).bit_count() <= 4:
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return {i: find(i) for i, _ in pairs}


def test_fingerprint_matches_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "one", "One two", "a b c d", "A b\x0bc d e", "x " * 50, "ÄÖ Über ß　e f g h i"]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 300))) for _ in range(40)]
    texts.append(" ".join(f"w{i}" for i in range(70_000)))
    for t in texts[:-1]:
        assert simhash.fingerprint_of(t) == brute_fingerprint(t)
    assert simhash.fingerprint_of(texts[-1]) == brute_fingerprint(texts[-1])


def near(rng, base, bits):
    for _ in range(bits):
        base ^= 1 << rng.randrange(64)
    return base


@pytest.mark.parametrize("node_rows", [8192, 16, 3])
def test_links_match_brute_force(spark, node_rows, monkeypatch):
    rng = random.Random(node_rows)
    values = {rng.getrandbits(64) for _ in range(150)}
    hot = rng.getrandbits(64)
    values |= {near(rng, hot, rng.randint(0, 7)) for _ in range(120)}
    for v in list(values)[:60]:
        values.add(near(rng, v, rng.randint(1, 5)))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.node_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), node_rows=node_rows)
    rows = [(e["a"], e["b"]) for e in edges.collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 64 for a, b in rows)
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    want = brute_components(list(zip(range(len(values)), values)))
    classes = {}
    for i, v in enumerate(signed):
        classes.setdefault(want[i], set()).add(got.get(v, v))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_walk_in_small_blocks():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
    code = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 3, dtype=np.uint64)[i % 3]) for i in range(3)]
                                    + [base ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 2, dtype=np.uint64)) for _ in range(400)]))
    fp = code.view(np.int64)
    zero, n = np.array([0]), np.array([len(code)])
    links = [p for a, b in simhash.forest(code, fp, (zero, n, zero, n), 4, leaf=4, width=7) for p in zip(a, b)]
    got = brute_link(fp.tolist(), links)
    want = brute_components(list(zip(fp.tolist(), code.tolist())))
    assert len(set(got.values())) == len(set(want.values()))


def brute_link(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_documents(spark, rows):
    text = " ".join(f"word{i}" for i in range(200))
    docs = [(5, text), (3, text), (9, text + " more"), (3, text), (7, None), (8, ""), (2, "quite another"), (None, text), (1, "single")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("fingerprint", F.lit("x")).withColumn("fp", F.lit(1))
    got = rows(simhash.near_duplicates(df))
    pairs = [(i if i is not None else 10**6, brute_fingerprint(t)) for i, t in docs]
    want = brute_components(sorted(set(pairs)))
    assert got == sorted([(i, format(brute_fingerprint(t), "016x"), want[i if i is not None else 10**6]) for i, t in docs],
                         key=lambda r: tuple((x is None, str(x)) for x in r))
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values()) - {10**6})


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_first(df).collect() == []


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}
