import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitaspan.llm import fill_in_middle as fim

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def brute(text, doc_id):
    """Form, sizes and output by a pattern over code points."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab <>PSM\t\n\x0b\x0c\r\x08\x0e\x1f!\x7f\x85\xa0é 漢😀", max_size=60), st.integers(-5, 10**12))
def test_arrange_matches_brute_force(text, doc_id):
    n, form, prefix, middle, output = fim.arrange(text.encode(), doc_id)
    assert (n, form, prefix, middle, output.decode()) == brute(text, doc_id)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\té漢😀", max_size=80))
def test_unit_ends_and_code_points(text):
    units, at = fim.Units(text.encode()), 0
    found = UNIT.findall(text)
    assert len(units) == len(found)
    for k, u in enumerate([""] + found):
        at += len(u.encode())
        assert units.end(k) == at
        assert units.chars(0, at) == len("".join(found[:k]))


def test_white_marks_every_byte_value():
    raw = bytes(range(256))
    marks = fim._white(np.frombuffer(raw, dtype="<u8")).view(np.uint8) >> 7
    assert [b for b in range(256) if marks[b]] == [9, 10, 11, 12, 13, 32]


def test_table(spark):
    rng = np.random.default_rng(5)
    texts = [None, "", " ", "\n\t ", "one", " one", "one ", "a <P> mark", "<S>", "<", "<P", "P>", "x" * 300_000, "wörter 漢 " * 60_000]
    texts += ["".join(rng.choice(list("ab <PSM>\né😀"), 40)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5])] * 2 + [(None, "without an id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash")).withColumn("output", F.lit(1))
    made = fim.transform(df).withColumn("restored", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made), key=str)
    assert got == sorted(((i, *brute(t, i)) for i, t in rows), key=str)
    text_of = dict(rows[:len(texts)])
    assert all(r["restored"] == (text_of[r["doc_id"]] or "") for r in made if r["doc_id"] is not None)
    assert {r["form"] for r in made} == {"plain", "spm", "psm"}
    assert fim.transform(df.limit(0)).collect() == []


def test_rates(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some words to cut").alias("text"))
    count = {r["form"]: r["count"] for r in fim.transform(df, rate=100, spm=30).groupBy("form").count().collect()}
    assert count.keys() == {"spm", "psm"} and 1100 < count["spm"] < 1300
    assert fim.transform(df, seed=7).where("form = 'plain'").count() != fim.transform(df).where("form = 'plain'").count()


def test_query(spark):
    from vitaspan.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op11_fill_in_middle(spark, folder).collect()
    sha = lambda s: hashlib.sha256((s or "").encode()).hexdigest()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, prefix, middle, output = brute(docs[r["doc_id"]], r["doc_id"])
        assert tuple(r)[:7] == (r["doc_id"], n, form, prefix, middle, sha(output), sha(docs[r["doc_id"]]))
