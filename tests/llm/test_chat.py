import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitaspan.llm import chat
from vitaspan.llm.chat import Lines, decode, format_chats, render, role_of, table_of


def all_paths(rows):
    """The best path by trying all."""
    steps = [s for r in rows for s in r.steps()]
    best = None
    for path in itertools.product(range(4), repeat=len(steps)):
        score = chat.START[path[0]] + steps[0][1][path[0]]
        for k in range(1, len(path)):
            score += steps[k][0][path[k - 1], path[k]] + steps[k][1][path[k]]
        if best is None or score > best[0] + 1e-12:
            best = (score, path)
    return best


def some_rows(rng, n):
    texts = ["Hello there", "User: what is it?", "### Assistant: fine", "A: yes\nQ: why?", "- a list\n- of two", "You are a helper."]
    return [Lines(rng.choice(texts), rng.choice([None, "user", "bot", "tool", "??"])) for _ in range(n)]


def test_viterbi_matches_all_paths():
    for seed in range(12):
        rows = some_rows(random.Random(seed), 3)
        score, path = all_paths(rows)
        got = np.concatenate(decode(rows, None, None))
        steps = [s for r in rows for s in r.steps()]
        again = chat.START[got[0]] + steps[0][1][got[0]] + sum(steps[k][0][got[k - 1], got[k]] + steps[k][1][got[k]] for k in range(1, len(got)))
        assert again == pytest.approx(score)
        assert table_of(rows, True)[0].max() == pytest.approx(score)


def test_pieces_agree_with_the_whole():
    rows = some_rows(random.Random(5), 30)
    whole = np.concatenate(decode(rows, None, None))
    cut = np.cumsum([len(r.texts) for r in rows])
    for k in (1, 7, 29):
        a, b = decode(rows[:k], None, int(whole[cut[k - 1] - 1])), decode(rows[k:], int(whole[cut[k - 1] - 1]), None)
        assert np.concatenate(a + b).tolist() == whole.tolist()


def test_markers_and_roles(spark):
    text = "System: You are a helper.\nHuman: Hi, can you help?\nAI: Sure.\n- one\n- two\n<|im_start|>user\nThanks<|im_end|>\n**Assistant:** Bye <|x|>"
    got = format_chats(spark.createDataFrame([(1, 0, None, text)], "conv_id long, turn long, role string, text string")).orderBy("part").collect()
    assert [(r["role"], r["text"]) for r in got] == [
        ("system", "You are a helper."), ("user", "Hi, can you help?"), ("assistant", "Sure.\n- one\n- two"), ("user", "Thanks"), ("assistant", "Bye <|x|>")]
    assert got[-1]["rendered"] == "<|assistant|>\nBye <\\|x|>\n<|end|>\n" and got[0]["rendered"] == render("system", "You are a helper.")
    assert role_of(" Human ") == 1 and role_of("nobody") == role_of(None) == -1


def test_a_missing_role_follows_from_its_neighbours(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("user", "Hi?"), (None, "Hello."), ("user", "More?"), ("", "Yes."), ("user", "Thanks")])]
    got = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("turn").collect()
    assert [r["role"] for r in got] == ["user", "assistant"] * 2 + ["user"]


@pytest.mark.parametrize("piece_rows", [20_000, 7])
def test_table(spark, rows, piece_rows):
    rng = random.Random(2)
    data = []
    for c in range(12):
        for t in range(80 if c == 3 else rng.randint(1, 6)):
            data.append((c, t, rng.choice(["user", "assistant", None, "junk"]), rng.choice(["Hi?", "Bot: yes\nUser: no", "", None, "text\nmore", "Q: x"])))
    data += [(5, 0, "user", "same")] * 4 + [(None, 1, "user", "alone"), (None, 1, "assistant", "alone"), (6, None, "system", "no turn"), (7, 2, None, "x " * 60_000)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash")).withColumn("piece", F.lit(3))
    out = format_chats(df, piece_rows=piece_rows)
    assert out.columns == ["conv_id", "turn", "part", "role", "text", "rendered"]
    got = rows(out)
    assert len(got) >= len(data)
    want = []
    by_conv = {}
    for conv, turn, role, text in data:
        by_conv.setdefault(conv if conv is not None else object(), []).append((turn, role, text, conv))
    ties = {(r["role"], r["text"]): r["tie"] for r in df.select("role", "text", F.xxhash64("role", "text").alias("tie")).collect()}
    for members in by_conv.values():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, ties[m[1], m[2]]))
        own = [Lines(t, r) for _, r, t, _ in members]
        for (turn, _, _, conv), lines, states in zip(members, own, decode(own, None, None)):
            for part, (role, text) in enumerate(chat.turns_of(lines, states)):
                want.append((conv, turn, part, role, text, render(role, text)))
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_empty_table(spark):
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
