import random
import zlib

import pytest
from pyspark.sql import functions as F

from vitaspan.llm import toxicity
from vitaspan.llm.toxicity import Lexicon, fold, learn, score_documents


def corpus(n=600, seed=0):
    rng = random.Random(seed)
    common = [f"word{i}" for i in range(50)]
    rows = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(5, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["grubble", "snorkface", "snorkheads"]))
        elif i % 70 == 1:
            words[2:2] = ["grubble", "machine"]
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_fold():
    assert fold("Ѕtup1d  ÉTÉ zero​width pa$$ d!sc") == " stupid ete zerowidth pass disc "
    assert fold("1l|i") == fold("iiii") and fold(" \n") == " "


def test_exception_phrases_and_obfuscation():
    rows = corpus()
    model = learn([t for _, t, _ in rows], [y for *_, y in rows])
    assert any(k.strip().startswith("snork") for k in model.weights)
    assert " grubbie machine " in model.exceptions
    assert model.matches(fold("a grubble machine")) == [] and model.matches(fold("a gru8ble engine"))
    assert model.score("word1 " * 20 + "gгubble snorkfасе 5norkf4ce") > 0.5 > model.score("word1 " * 20 + "grubble machine")


def test_score_is_normalised_by_length():
    model = Lexicon({" bad ": 5.0}, [], (-3.0, 3.0, 0.0))
    assert model.score("bad one") > model.score("bad one " + "fine " * 3000)


def test_copies_of_one_toxic_text_do_not_enter_the_lexicon():
    rows = corpus() + [(10_000 + i, "grubble snorkface raretail rarebody rarehead " + "word1 " * 9, 1) for i in range(60)]
    model = learn([t for _, t, _ in rows], [y for *_, y in rows])
    assert not any("rare" in k for k in model.weights)


def test_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(7, rows[7][1]), (None, "x"), (9_001, None), (9_002, "")],
                                 "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("toxic", F.lit(9))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    got = score_documents(docs, model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows) + 4
    by_id = {r["doc_id"]: r for r in found}
    for i, t, y in rows:
        assert by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert by_id[i]["score"] == pytest.approx(model.score(t))
    held = [(by_id[i]["predicted"], y) for i, _, y in rows if by_id[i]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert by_id[9_001]["score"] == by_id[9_002]["score"] < 0.5
    kept = toxicity.keep_harmless(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in found)


def test_held_out_labels_are_not_used(spark):
    rows = [(i, t, y) for i, t, y in corpus() if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(docs, labels).weights == {}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert score_documents(docs, model).collect() == [] and model.score("anything") < 0.5


def test_learning_keeps_no_terms_of_harmless_texts():
    """Memory follows the texts and the terms of toxic ones, not all terms of all texts."""
    import tracemalloc

    plain = [" ".join(f"word{i}x{k}" for k in range(400)) for i in range(300)]
    toxic = [f"some grubble text number {i}" for i in range(12)]
    texts, labels = plain + toxic, [0] * len(plain) + [1] * len(toxic)
    tracemalloc.start()
    model = learn(texts, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights and model.score(toxic[0]) > model.score(plain[0])
    assert peak < 20_000_000
