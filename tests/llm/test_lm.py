import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitaspan.llm import lm
from vitaspan.llm.elias_fano import EliasFano, Trie, dequantise

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (1000, 1 << 64), (1000, 2000), (20_000, 10**9), (300, 301)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    coded = EliasFano.encode(values, universe)
    assert (coded.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe, 300, dtype=np.uint64), np.array([0, universe - 1], dtype=np.uint64)])
    assert (coded.search(asked) == np.searchsorted(values, asked)).all()
    assert ((coded.find(asked) >= 0) == np.isin(asked, values)).all()


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 40, 100_000, dtype=np.uint64))
    coded = EliasFano.encode(values, 1 << 40)
    assert (coded.low.nbytes + coded.high.nbytes) * 8 / 100_000 < 2 + 40 - math.log2(100_000) + 1.5


def test_trie():
    rng = np.random.default_rng(1)
    contexts, words = rng.integers(0, 1 << 64, 200, dtype=np.uint64), rng.integers(0, 1 << 64, 900, dtype=np.uint64)
    pairs = np.unique(np.stack([rng.choice(contexts, 9000), rng.choice(words, 9000)], axis=1), axis=0)
    p = rng.random(len(pairs)) ** 3
    trie = Trie(pairs[:, 0], pairs[:, 1], p)
    assert np.allclose(dequantise(trie.lookup(pairs[:, 0], pairs[:, 1])), p, rtol=1e-3)
    a, b = rng.choice(contexts, 3000), rng.choice(words, 3000)
    known = set(map(tuple, pairs.tolist()))
    assert ((trie.lookup(a, b) > 0) == np.array([x in known for x in zip(a.tolist(), b.tolist())])).all()
    keys, counts = np.unique(pairs[:, 0], return_counts=True)
    assert (trie.fan_out(keys) == counts).all() and (trie.fan_out(np.array([1, 2], dtype=np.uint64)) == 0).all()


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low) + [None]


def brute(docs):
    train = [tokens_of(t) for i, t in docs if zlib.crc32((str(i) if i is not None else "").encode()) % 5 != 1]
    c = Counter(w for d in train for w in d)
    n, v = sum(c.values()), len(c)
    pairs, of, fan = Counter(), Counter(), defaultdict(set)
    for d in train:
        for a, b in zip(["<begin>", *d], d):
            pairs[a, b] += 1
            of[a] += 1
            fan[a].add(b)
    out = []
    for i, text in docs:
        d = tokens_of(text)
        base = score = 0.0
        for a, b in zip(["<begin>", *d], d):
            p = (c[b] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            score += math.log10(max(pairs[a, b] - 0.75, 0) / of[a] + 0.75 * len(fan[a]) / of[a] * p if of[a] else p)
        out.append((i, zlib.crc32((str(i) if i is not None else "").encode()) % 5 == 1, len(d), sum(c[w] > 0 for w in d), n, base, score))
    return out


@pytest.mark.parametrize("shard_tokens, batch_tokens", [(2_000_000, 4_000_000), (300, 150)])
def test_scores_match_brute_force(spark, shard_tokens, batch_tokens):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["The", "the", "É", "é"]
    docs = [(i, " ".join(rng.choice(vocabulary[: rng.choice([3, 40, 304])]) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    docs += [(7, docs[7][1]), (None, "The the"), (900, None), (901, " \n"), (902, "a\x0bB\x0cc\xa0d"), (903, "the of " * 3_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("batch", F.lit(1))
    got = lm.score(df, shard_tokens=shard_tokens, batch_tokens=batch_tokens)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    for have, want in zip(sorted((tuple(r) for r in got.collect()), key=order), sorted(brute(docs), key=order), strict=True):
        assert have[:5] == want[:5]
        assert have[5] == pytest.approx(want[5], rel=1e-9)
        assert have[6] == pytest.approx(want[6], rel=1e-3)


def brute_of_order(docs, order):
    held_out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    train = [tokens_of(t) for i, t in docs if not held_out(i)]
    c = Counter(w for d in train for w in d)
    n, v = sum(c.values()), len(c)
    after = defaultdict(Counter)
    contexts = lambda d: [(w, [tuple(["<begin>", *d][k + 1 - m:k + 1]) for m in range(1, min(order - 1, k + 1) + 1)])
                          for k, w in enumerate(d)]
    for d in train:
        for w, before in contexts(d):
            for x in before:
                after[x][w] += 1
    out = {}
    for i, text in docs:
        score = 0.0
        for w, before in contexts(tokens_of(text)):
            p = (c[w] + 0.5) / (n + 0.5 * (v + 1))
            for x in before:
                if x in after:
                    whole = sum(after[x].values())
                    p = max(after[x][w] - 0.75, 0) / whole + 0.75 * len(after[x]) / whole * p
            score += math.log10(p)
        out[i] = score
    return out


@pytest.mark.parametrize("order, shard_tokens, batch_tokens, hot", [(2, 300, 150, 4096), (3, 2_000_000, 2_000_000, 4096), (3, 300, 150, 20), (5, 900, 700, 50)])
def test_longer_contexts_match_brute_force(spark, monkeypatch, order, shard_tokens, batch_tokens, hot):
    monkeypatch.setattr(lm, "HOT", hot)
    rng = random.Random(4)
    passage = [f"p{i}" for i in rng.choices(range(40), k=60)]
    docs = []
    for i in range(100):
        at = rng.randrange(50)
        docs.append((i, " ".join([f"w{rng.randrange(rng.choice([3, 30]))}" for _ in range(rng.randint(0, 30))] + passage[at:at + rng.randint(0, 20)])))
    docs += [(900, None), (901, "of the sea " * 500), (902, "p1")]
    got = lm.score(spark.createDataFrame(docs, "doc_id long, text string"), shard_tokens=shard_tokens, batch_tokens=batch_tokens, order=order)
    want = brute_of_order(docs, order)
    have = {r["doc_id"]: r for r in got.collect()}
    assert have.keys() == want.keys()
    # half a step of a quantised logarithm per token at most
    assert all(abs(r["score"] - want[i]) <= 1.25e-4 * r["n_tokens"] for i, r in have.items())
    assert order == 2 or want != pytest.approx(brute_of_order(docs, 2), rel=1e-2)


def test_query_looks_at_more_than_one_word_before(spark, tmp_path):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 != 1]
    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    docs = [*zip(ids, ["a b c", "d b e"] * 10), (out[0], "a b c"), (out[1], "a b e")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    from vitaspan.llm.queries import op7_language_model
    from vitaspan.llm.registry import QUERIES

    got = {r["doc_id"]: r["score"] for r in QUERIES["op7_language_model"](spark, str(tmp_path)).collect()}
    assert got[out[0]] > got[out[1]] + 1 and op7_language_model


def test_probabilities_of_a_context_add_up(spark):
    """All known words, the end and one unknown word after ``a`` have probability 1 together."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 != 1]
    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    train = list(zip(ids, ["a b a c a b d", "a a b", "c d a b"]))
    # "zz yy": a context never seen gives p(a), p(end); the pair (a, w) is what differs
    nexts = ["a", "b", "c", "d", "new"]
    probes = list(zip(out, ["zz a"] + [f"zz a {w}" for w in nexts] + [f"zz {w}" for w in nexts]))
    scores = {t: s for t, s in zip([t for _, t in sorted(probes)], [r["score"] for r in sorted(
        lm.score(spark.createDataFrame(train + probes, "doc_id long, text string")).where("held_out").collect(), key=lambda r: r["doc_id"])])}
    c = Counter(w for _, t in train for w in tokens_of(t))
    p = lambda w: (c[w] + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1))
    first = {w: p("zz") * p(w) if w == "new" else 0 for w in nexts}
    begin = 10 ** scores["zz a"]
    ends = {w: 10 ** scores[f"zz {w}"] / p(w) for w in nexts}  # p(zz | begin) p(end | w)
    follow = {w: 10 ** scores[f"zz a {w}"] / ends[w] for w in nexts}  # p(a) p(w | a)
    head = 10 ** scores["zz new"] / p("new") / p(None)  # p(zz | begin)
    total = sum(follow.values()) / p("a") + begin / head / p("a")
    assert total == pytest.approx(1.0, abs=2e-3) and first["new"] > 0


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("n, universe", [(1, 1), (1000, 1 << 64), (20_000, 10**9), (20_000, 30_000), (5_000, 5_000)])
def test_few_and_many_questions_get_the_same_places(monkeypatch, n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    coded = EliasFano.encode(values, universe)
    asked = np.concatenate([rng.choice(values, 40), rng.integers(0, universe, 40, dtype=np.uint64), np.array([0, universe - 1], dtype=np.uint64)])
    many = coded.search(asked), coded.find(asked), coded.find_each(asked), coded.get(np.arange(n))
    from vitaspan.llm import elias_fano

    for each in (8, 0):  # 0: every question probes the list
        monkeypatch.setattr(elias_fano, "MANY", each)
        assert (coded.search(asked) == np.searchsorted(values, asked)).all()
        assert ((coded.find(asked) >= 0) == np.isin(asked, values)).all()
        assert all((a == b).all() for a, b in zip(many, (coded.search(asked), coded.find(asked), coded.find_each(asked), coded.get(np.arange(n)))))


def sizes_of(spark, docs, **options):
    """Bytes that a run froze, and its rows."""
    import os

    from vitaspan.session import owning

    with owning() as owner:
        rows = lm.score(docs, **options).collect()
        frozen = sum(os.path.getsize(os.path.join(at, f)) for p in owner.paths for at, _, names in os.walk(p.removeprefix("file:")) for f in names)
        owner.drop(spark)
    return frozen, rows


def zipf_documents(n, length):
    rng = np.random.default_rng(5)
    p = 1 / np.arange(1, 20_001)
    return [(i, " ".join(f"w{w}" for w in rng.choice(20_000, length, p=p / p.sum()))) for i in range(n)]


def test_answers_take_few_bytes_a_token(spark):
    docs = zipf_documents(400, 500)
    frozen, rows = sizes_of(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(2), order=3, shard_tokens=50_000)
    tokens = sum(r["n_tokens"] for r in rows)
    assert tokens == 400 * 501 and frozen < 4 * tokens


def test_questions_take_few_bytes_a_token():
    """A word's hash goes to a shard once, not with every n-gram that holds it."""
    import pyarrow as pa

    held = lm.Batch()
    docs = zipf_documents(400, 500)
    held.add(pa.array([str(i) for i, _ in docs]), pa.array([t for _, t in docs]), pa.array([i % 5 == 1 for i, _ in docs]))
    a = held.arrays()
    asked = lm.Questions(a["hashes"], a["tokens"], a["lengths"], np.zeros(0, dtype=np.uint64), 4, 3)
    counts = np.bincount(asked.levels[-1].rows[np.repeat(a["train"], a["lengths"])], minlength=len(asked.levels[-1].words))
    sent = list(asked.messages(counts))
    assert [s for s, _ in sent] == [0, 1, 2, 3] and sum(len(raw) for _, raw in sent) < 8 * held.size
    # every n-gram of three words is in one message, with its count
    assert sum(int(lm._unpack(raw)[-1].sum()) for _, raw in sent) == int(a["lengths"][a["train"]].sum())


def test_packed_numbers_come_back():
    rng = np.random.default_rng(2)
    arrays = [np.zeros(0, dtype=np.int64), np.zeros(9, dtype=np.int64), np.arange(300), rng.integers(0, 1 << 64, 70, dtype=np.uint64), np.array([1 << 40])]
    got = lm._unpack(lm._pack(*arrays))
    assert len(got) == len(arrays) and all((a == b).all() and len(a) == len(b) for a, b in zip(got, arrays))


def test_blanks_and_empty_texts_between_others(spark):
    docs = [(i, t) for i, t in enumerate([" a b", "a b ", "\n", "", None, "a\tb", "\x0b\x0ca\r", "a\x1cb a b \x85"] * 8)]
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), order=2).collect()}
    for i, _, n_tokens, n_known, train_tokens, base, score in brute(docs):
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (n_tokens, n_known, train_tokens)
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9) and got[i]["score"] == pytest.approx(score, abs=1.25e-4 * n_tokens)
