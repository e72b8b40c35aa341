"""Each stage of the pipeline against brute force on what its predecessor kept."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_overlaps
from test_packing import check as check_packing
from test_packing import ids_of
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline as pipeline
from vitaspan.llm import quality_rules, toxicity

TOXIC = ["grumbleflak", "snorfwit", "blatherscum"]


def tables(spark, folder, docs, labels, items, extra=True):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        df = df.withColumn("kept", F.lit("clash")).withColumn("component_id", F.lit(1))
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean, toxic, poor and copied documents, benchmark passages, repeated and missing ids."""
    r = random.Random(12)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ren", "sto", "ta", "vu") for b in ("la", "der", "sum", "nik", "po", "rast", "en", "go")]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    clean = [prose(r.randint(60, 220)) for _ in range(160)]
    docs = [(i, t, "en", "web", len(t)) for i, t in enumerate(clean)]
    labels = [(i, 1, 0) for i in range(0, 160, 2)]
    for k in range(40):
        words = prose(80).split()
        for place in range(5, 80, 12):
            words[place] = TOXIC[(place + k) % 3]
        docs.append((200 + k, " ".join(words), "en", "web", 1))
        labels.append((200 + k, 0, 1))
    docs += [(300 + k, "buy now " * 30, "en", "spam", 1) for k in range(4)] + [(310, None, None, None, None), (311, "", "en", "web", 0), (312, "too few words", "en", "web", 1)]
    # exact and near copies, some with ids before their source; one id with two texts; no id at all
    docs += [(400 + k, clean[k], "en", "web", 1) for k in range(5)] + [(-5, clean[9], "en", "copy", 1)]
    docs += [(7, prose(90), "en", "other", 1), (7, clean[7], "en", "web", 1), (None, prose(70), "en", "web", 1), (None, clean[20], "en", "web", 1),
             (None, prose(75), "en", "web", 1)]
    items = [(j, prose(30)) for j in range(6)] + [(6, None), (7, "")]
    docs += [(500 + j, prose(40) + " " + items[j][1] + " " + prose(40), "en", "leak", 1) for j in range(5)]
    docs.append((None, prose(30) + " " + items[5][1], "en", "leak", 1))
    docs.append((600, prose(3000), "en", "long", 1))
    folder = tables(spark, tmp_path_factory.mktemp("planted") / "t", docs, labels, items)
    return folder, docs, items


@pytest.fixture(scope="module")
def stages(spark, planted, tmp_path_factory):
    """What every stage gives, written and read again as the pipeline does."""
    folder, root = planted[0], tmp_path_factory.mktemp("stages")
    df, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        stage(spark, df, folder).write.parquet(f"{root}/{name}")
        df = spark.read.parquet(f"{root}/{name}")
        out.append(df)
    return out


def keys(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


def test_toxicity_stage(spark, planted, stages):
    folder, docs, _ = planted
    start = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit_toxicity(start, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = start.withColumn("s", toxicity.toxicity_score(model)(F.col("text"))).collect()
    assert keys(stages[0]) == sorted(((r["doc_id"], r["text"]) for r in rows if r["s"] < 0.5), key=str)
    kept = {i for i, _ in keys(stages[0])}
    assert not kept & set(range(200, 240)) and set(range(160)) <= kept and stages[0].columns == start.columns


def test_quality_stage(spark, planted, stages):
    judged = quality_rules.apply_rules(stages[0], quality_rules.trusted_weights(stages[0], spark.read.parquet(f"{planted[0]}/labels.parquet")))
    assert keys(stages[1]) == sorted(((r["doc_id"], r["text"]) for r in judged.where("kept").select("doc.doc_id", "doc.text").collect()), key=str)
    kept = {i for i, _ in keys(stages[1])}
    assert not kept & {300, 301, 302, 303, 310, 311, 312} and len(kept & set(range(160))) > 150


def test_near_duplicate_stage(stages):
    before = keys(stages[1])
    pairs = [(n, brute_fingerprint(t)) for n, (_, t) in enumerate(before)]
    groups = {}
    for n, root in brute_components(pairs).items():
        groups.setdefault(root, set()).add(before[n])
    order = lambda k: (k[0] is None, k[0] or 0, hashlib.sha256(k[1].encode()).hexdigest())
    assert keys(stages[2]) == sorted((min(g, key=order) for g in groups.values()), key=str)
    kept = keys(stages[2])
    assert sum(i is None for i, _ in kept) == 3 and sum(i == 7 for i, _ in kept) == 2 and not {400, 401, 402, 403, 404} & {i for i, _ in kept}
    assert [i for i, t in kept if t == dict(before)[-5]] == [-5]


def test_decontamination_stage(planted, stages):
    before = keys(stages[2])
    found, _ = brute_overlaps(list(enumerate(t for _, t in before)), planted[2])
    hit = {n for n, _ in found}
    assert keys(stages[3]) == [k for n, k in enumerate(before) if n not in hit] and len(hit) == 6


def test_packing_stage(stages):
    docs = keys(stages[3])
    rows = [r.asDict() for r in stages[4].collect()]
    repeated = {i for i, _ in docs if sum(j == i for j, _ in docs) > 1}
    assert repeated == {7, None}
    lengths = {}
    for row in rows:
        lengths[row["sequence_id"]] = lengths.get(row["sequence_id"], 0) + row["length"]
    assert max(lengths.values()) <= 2048
    want = []
    for i, t in docs:
        all_ids = ids_of(t)
        want += [(i, k // 2048, k, len(all_ids[k:k + 2048]), zlib.crc32(np.array(all_ids[k:k + 2048], dtype="<u4").tobytes())) for k in range(0, len(all_ids), 2048)]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == sorted(want, key=str)
    assert len(docs) > 140 and len(lengths) <= sum(w[3] for w in want) / 2048 * 1.05 + 1


def test_run_gives_the_last_stage(spark, planted, stages):
    got, want = pipeline.run(spark, planted[0]), stages[4]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert got.columns == want.columns
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(map(tuple, want.select(columns).collect()), key=str)


def test_empty_tables(spark, tmp_path):
    folder = tables(spark, tmp_path / "empty", [], [], [])
    assert pipeline.run(spark, folder).collect() == []
    r = random.Random(1)
    docs = [(i, " ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]) + str(r.randrange(50)) for _ in range(80)), "en", "x", 1) for i in range(5)]
    folder = tables(spark, tmp_path / "unlabelled", docs, [], [], extra=False)
    rows = [x.asDict() for x in pipeline.run(spark, folder).collect()]
    check_packing(rows, [(i, t) for i, t, *_ in docs], 2048, 2)
