import random

from pyspark.sql import functions as F

from vitaspan.llm import decontaminate
from vitaspan.llm.decontaminate import MASKS, MIN_SCORE, MIN_SHARE


def words(text):
    text = (text or "").lower()
    for mark in decontaminate.PUNCTUATION:
        text = text.replace(mark, " ")
    return text.split()


def brute(docs, items):
    found = {}
    for i, text in docs:
        d = words(text)
        for j, item in items:
            b = words(item)
            if i is None or j is None or len(b) < len(MASKS[0]):
                continue
            shifts = set()
            for mask in MASKS:
                care = [k for k, m in enumerate(mask) if m == "1"]
                seeds = {}
                for q in range(len(b) - len(mask) + 1):
                    seeds.setdefault(tuple(b[q + k] for k in care), []).append(q)
                for p in range(len(d) - len(mask) + 1):
                    shifts.update(p - q for q in seeds.get(tuple(d[p + k] for k in care), ()))
            for s in shifts:
                lo, hi = max(0, s), min(len(d), s + len(b))
                agree = [d[p] == b[p - s] for p in range(lo, hi)]
                best = None  # highest score, then the first end, then the shortest
                for start in range(len(agree)):
                    run = 0
                    for stop in range(start, len(agree)):
                        run += 1 if agree[stop] else -1
                        if best is None or (-run, stop, -start) < best:
                            best = (-run, stop, -start)
                run, stop, start = -best[0], best[1], -best[2]
                matched = sum(agree[start:stop + 1])
                key = (-run, lo + start, lo + start - s, matched, stop + 1 - start - matched)
                if run >= min(MIN_SCORE, MIN_SHARE * len(b)) and key < found.get((i, j), (1,)):
                    found[i, j] = key
    return {(i, j): -k[0] for (i, j), k in found.items()}, {(i, j): k[3] for (i, j), k in found.items()}


def test_masks_are_made_of_pairs():
    assert all(len(decontaminate._starts(m)) == 3 and m.count("1") == 6 for m in MASKS)


def test_overlaps_match_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "straße", "x1"]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(j, " ".join(make(rng.randint(8, 40)))) for j in range(12)] + [(50, "too short"), (51, None), (None, "w1 " * 20), (3, None)]
    docs = []
    for i in range(60):
        d = make(rng.randint(0, 80))
        if i % 2:
            part = items[rng.randrange(12)][1].split()
            part = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.1, 0.3]) else w.upper() + rng.choice(["", ",", " .", "!?"]) for w in part]
            cut = rng.randint(0, len(part) // 2) if i % 3 == 0 else 0
            at = rng.randint(0, len(d))
            d[at:at] = part[cut:]
        docs.append((i, " ".join(d)))
    docs += [(1, docs[1][1]), (None, items[0][1]), (900, None), (901, ""), (902, items[0][1]), (903, "w1 " * 30_000 + items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("h", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = decontaminate.overlaps(df, bench).collect()
    scores, matched = brute([d for d in docs if d[0] != 903], [x for x in items if x[1]])
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got if r["doc_id"] != 903} == scores
    assert {(r["doc_id"], r["item_id"]): r["n_matched"] for r in got if r["doc_id"] != 903} == matched
    assert (903, 1) in {(r["doc_id"], r["item_id"]) for r in got} and len(scores) > 15
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    flagged = {r["doc_id"] for r in got}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(i for i, _ in docs if i is not None and i not in flagged)


def test_every_seventh_word_replaced(spark):
    item = [f"t{i}" for i in range(35)]
    text = " ".join("other" if i % 7 == 3 else w for i, w in enumerate(item))
    got = decontaminate.overlaps(spark.createDataFrame([(1, "lead in " + text)], "doc_id long, text string"),
                                 spark.createDataFrame([(2, " ".join(item))], "item_id long, text string")).collect()
    assert [(r["score"], r["n_matched"], r["n_differing"], r["doc_word"], r["item_word"]) for r in got] == [(25, 30, 5, 2, 0)]


def test_shuffled_partners_give_the_same(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"v{(i * k) % 17}" for k in range(40))) for i in range(1, 30)], "doc_id long, text string")
    bench = spark.createDataFrame([(j, " ".join(f"v{(j * k) % 17}" for k in range(25))) for j in range(1, 9)], "item_id long, text string")
    want = rows(decontaminate.overlaps(docs, bench))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert rows(decontaminate.overlaps(docs, bench)) == want and want


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(docs, bench).collect() == [] and decontaminate.drop_contaminated(docs, bench).count() == 1
    assert decontaminate.overlaps(docs.limit(0), bench).collect() == []


def replaced(n, *at):
    return " ".join("other" if i in at else f"t{i}" for i in range(n))


def test_short_items(spark, monkeypatch):
    """Copies of 1, 5 and 7 words; 8, 9, 15 and 16 words with replacements."""
    item_of = {5: 5, 7: 7, 8: 8, 9: 9, 15: 15, 16: 16}
    bench = spark.createDataFrame([*((j, replaced(n)) for j, n in item_of.items()), (1, "東京は日本の首都です"), (2, "q0"), (60, "zz t2")], "item_id long, text string")
    docs = [(5, "in q0, T0 t1. t2 t3 t4 out t0 t1 t2 t3 t4", {5, 2}), (50, replaced(5, 2), set()), (51, "t0 t1 t2 t3", set()), (7, replaced(7), {5, 7}),
            (8, "lead " + replaced(8, 2), {8}), (9, replaced(9, 2), {8, 9}), (15, "x " + replaced(15, 3, 10), {15, 16}),
            (16, replaced(16, 0, 7, 14), {15, 16}), (1, "東京は日本の首都です", {1}), (3, "", set()), (4, None, set())]
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    got = decontaminate.overlaps(df, bench).collect()
    for i, _, want in docs:
        assert want <= {r["item_id"] for r in got if r["doc_id"] == i}, i
        assert want or not any(r["doc_id"] == i for r in got), i
    first = next(r for r in got if (r["doc_id"], r["item_id"]) == (5, 5))
    assert (first["score"], first["n_matched"], first["n_differing"], first["doc_word"], first["item_word"]) == (5, 5, 0, 2, 0)
    assert len({(r["doc_id"], r["item_id"]) for r in got}) == len(got)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, decontaminate.overlaps(df, bench).collect())) == sorted(map(tuple, got))


def test_item_with_a_short_and_a_long_text_is_one_row(spark):
    bench = spark.createDataFrame([(1, replaced(12)), (1, "t0 t1")], "item_id long, text string")
    got = decontaminate.overlaps(spark.createDataFrame([(1, replaced(12)), (2, "t0 t1")], "doc_id long, text string"), bench).collect()
    assert sorted((r["doc_id"], r["score"]) for r in got) == [(1, 12), (2, 2)]
