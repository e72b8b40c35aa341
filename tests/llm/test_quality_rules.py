import random
import re

import pytest
from pyspark.sql import functions as F

from vitaspan.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    inside = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            n < 10 or 100 * len(inside) > 20 * n)


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t\x0b\x0c\r ", "one", "a b c d e a b c d e", "a a a a a a", "x\ny\nx\n\n \n x\nx", "##|<>&%$*# é ß　x",
           "tab\tsep\x0bvt\x0cff\rcr\nlf", "é" * 30 + " " + "ß " * 12, " lead and trail ", "a\xa0b c\x85d \x1c e"]
    for size in (3, 6, 20):
        for _ in range(15):
            out.append("".join(rng.choice("abcde"[:size]) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(1, 200))))
    phrase = " ".join(f"w{i}" for i in range(40))
    out += [phrase + " tail " + phrase, " ".join(f"u{i}" for i in range(60_000)), phrase * 800]
    return out


def test_counts_match_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string").withColumn("w", F.lit(1)).withColumn("h1", F.lit("x"))
    judged = quality_rules.apply_rules(docs, [0.0] * 64)
    got = judged.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept").collect()
    assert len(got) == len(rows) + 3
    for r in got:
        assert tuple(r)[1:7] == brute(rows[r["doc_id"]][1]), r["doc_id"]
        assert r["llr"] == 0 and r["kept"] == (not r["base_failed"])


def test_likelihood_ratio(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice(["the", "river", "runs", "down", "to", "sea", "and", "home"]) for _ in range(60)) for _ in range(200)]
    bad = [" ".join(f"zq{rng.randint(0, 400)}" for _ in range(60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(None, good[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("trusted", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(i, 0, 0) for i in range(200, 230)] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    weights = quality_rules.trusted_weights(docs, labels)
    judged = {r["doc"]["doc_id"]: r for r in quality_rules.apply_rules(docs, weights).collect()}
    assert all(judged[i]["kept"] for i in range(200)) and not any(judged[i]["kept"] for i in range(200, 260))
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 201
    # the mean of the weights of all words and pairs, by hand
    hashes = spark.createDataFrame([(w, n) for w, n in zip(good[3].split(), good[3].split()[1:] + [None])], "a string, b string")
    places = hashes.select(F.pmod(F.xxhash64("a"), F.lit(len(weights))).alias("x"),
                           F.pmod(F.xxhash64(F.xxhash64("a"), F.when(F.col("b").isNotNull(), F.xxhash64("b"))), F.lit(len(weights))).alias("y")).collect()
    assert judged[3]["llr"] == pytest.approx(sum(weights[p["x"]] + weights[p["y"]] for p in places) / 120, abs=1e-8)


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = quality_rules.trusted_weights(docs, labels)
    assert set(weights) == {0.0} and quality_rules.apply_rules(docs, weights).collect() == []
