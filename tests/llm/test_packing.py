import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitaspan.llm import packing

TOKENIZER = Tokenizer.from_file(packing.default_tokenizer())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_equal_those_of_whole_texts():
    tokens = packing.Tokens(packing.default_tokenizer(), most=5)
    rng = random.Random(0)
    letters = "aBcé́ß'’.,;:!?-#<|>12\x01¤ \t漢😀ΣİK"
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(600)]
    for text in mixed + ["<|ENDOFTEXT|> <|endoftext|>.", "", "Hello, World's  end", "a\xa0b\x1cc d", "ΑΣ Σ. İ ﬁ é ́x", "<|endoftext|> x<|startoftext|>y", "12ab'll ''s",
                 "漢字 😀👍 \r\n\tx\x0b\x0cy", "don't DON'T"]:
        assert np.frombuffer(tokens(text), dtype="<u4").tolist() == ids_of(text)[:-1], text
    whole = packing.Tokens(packing.default_tokenizer())
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in whole.of(mixed)] == [ids_of(t)[:-1] for t in mixed]


def check(rows, docs, size, slack):
    """Pieces are a partition of the ids, offsets gapless, and few sequences."""
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["piece"]), []).append(r)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= size
    want = []
    for i, text in docs:
        ids = ids_of(text)
        for k in range(0, len(ids), size):
            part = ids[k:k + size]
            want.append((i, k // size, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows], key=key) == sorted(want, key=key)
    assert len(by_seq) <= math.ceil(sum(w[3] for w in want) / size) * slack + 1


def test_documents(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["river", "sea", "boathouse", "x1"]) for _ in range(int(rng.lognormvariate(2.5, 1))))) for i in range(400)]
    docs += [(3, docs[3][1])] * 5 + [(None, None), (901, None), (902, ""), (903, "river " * 5_000), (904, "sea " * 63), (905, "sea " * 127)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("pid", F.lit("x")).withColumn("length", F.lit(-1))
    check(packing.pack(df, size=64, block=100).collect(), docs, 64, 1.02)


def test_evolution_beats_or_equals_best_fit():
    for seed in range(6):
        rng = random.Random(seed)
        lengths = [rng.randint(300, 900) for _ in range(90)]
        bins, fills = [], []
        packing.best_fit(list(range(90)), lengths, bins, fills, 2048)
        numbers = packing.evolve(lengths, [], 2048, seed, crossovers=60)
        assert len(set(numbers)) <= len(bins) and len(numbers) == 90
        used = {}
        for n, k in zip(lengths, numbers):
            used[k] = used.get(k, 0) + n
        assert max(used.values()) <= 2048
        assert len(set(packing.evolve(lengths, [numbers], 2048, seed))) <= len(set(numbers))


def test_crossover_keeps_every_item_once():
    rng = random.Random(1)
    lengths = [rng.randint(1, 60) for _ in range(50)]
    make = lambda s: packing.evolve(lengths, [], 100, s, crossovers=0)

    def solution(numbers):
        bins = [[i for i, k in enumerate(numbers) if k == b] for b in sorted(set(numbers))]
        return packing.Solution(bins, [sum(lengths[i] for i in b) for b in bins], 100)

    for s in range(20):
        child = packing.cross(solution(make(s)), solution(make(s + 1)), lengths, 100, random.Random(s))
        assert sorted(i for b in child.bins for i in b) == list(range(50))
        assert all(sum(lengths[i] for i in b) == f <= 100 for b, f in zip(child.bins, child.fills))


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
