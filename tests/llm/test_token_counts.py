import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitaspan.llm.token_counts import Encoder, attribute, count_sections, default_vocabulary, line_ends

ENCODER = Encoder(default_vocabulary())


def brute(text):
    """Tokens to lines byte by byte: most bytes win, the earlier line of equals."""
    line_of, line = [], 0
    for b in (text or "").encode():
        line_of.append(line)
        line += b == 10
    n = (max(line_of) + 1) if line_of else 1
    counts, at = [0] * n, 0
    for t in ENCODER.encode(text or ""):
        part = line_of[at:at + ENCODER.sizes[t]]
        counts[max(sorted(set(part)), key=lambda k: (part.count(k), -k))] += 1
        at += ENCODER.sizes[t]
    assert at == len(line_of)
    return counts


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\n\tée漢.😀", max_size=60))
def test_counts_match_brute_force(text):
    raw = text.encode()
    if raw:
        got = np.bincount(attribute(ENCODER.sizes[np.array(ENCODER.encode(text))], line_ends(raw)), minlength=len(line_ends(raw)))
        assert got.tolist() == brute(text)


def test_tokens_over_several_lines():
    assert attribute(np.array([4, 5, 1]), np.array([1, 2, 4, 9, 10])).tolist() == [2, 3, 4]
    assert attribute(np.array([2, 2]), np.array([1, 4])).tolist() == [0, 1]


def test_table(spark):
    texts = [None, "", "one", "two lines\nhere\n", "\n\n\n", "x" * 50_000 + "\n" + "y z " * 40_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "a\nb")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = {}
    for r in count_sections(df).collect():
        got.setdefault(r["doc_id"], []).append((r["section"], r["n_tokens"], r["start_byte"], r["end_byte"]))
    for i, t in enumerate(texts):
        want = brute(t)
        have = sorted(got[i])
        if i == 3:
            assert have[::2] == have[1::2]
            have = have[::2]
        assert [x[1] for x in have] == want and sum(want) == len(ENCODER.encode(t or ""))
        assert have[0][2] == 0 and have[-1][3] == len((t or "").encode())
    assert len(got[None]) == 2 and count_sections(df.limit(0)).collect() == []
