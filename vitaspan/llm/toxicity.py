"""Toxicity by a weighted lexicon, matched with Aho-Corasick on text whose look-alike characters are folded.

The lexicon, its weights, the exception phrases and the calibration are learned from a bounded sample of labelled
rows. Whole texts are scored: the matched weight, normalised by the number of words, goes through a logistic curve.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import bounded_sample, by_value, text_fold

#: Characters of other scripts that look like Latin letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "ԝ": "w", "α": "a", "β": "b", "ε": "e",
    "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g",
}
#: Digits and signs used in place of letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}

_WORD = re.compile(r"\w+")
_INNER_SIGN = re.compile(r"(?<=\w)[!|](?=\w)")


def _fold_table() -> dict[int, str]:
    out = {}
    for low, high in ((0xC0, 0x250), (0x1E00, 0x1F00)):
        for code in range(low, high):
            base = unicodedata.normalize("NFD", chr(code).lower())[0]
            if base.isascii() and base.isalpha():
                out[code] = base
    out |= {ord(a): b for a, b in (HOMOGLYPHS | SUBSTITUTES).items()}
    # i, l, 1, ! and | stand for each other, so they share one class
    out[ord("l")] = "i"
    return out | dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)], "")


_FOLD = _fold_table()


def fold(text: str) -> str:
    """Words of ``text`` in folded form, each between single spaces; a text without words gives one space."""
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKC", low)
    if "!" in low or "|" in low:
        low = _INNER_SIGN.sub("i", low)
    return " " + "".join(w + " " for w in _WORD.findall(low.translate(_FOLD)))


class Lexicon:
    """Entries (`` word `` or `` stem`` with their spaces), weights, exception phrases and calibration."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], curve: tuple[float, float, float]):
        self.weights, self.exceptions, self.curve, self._machine = weights, sorted(exceptions), curve, None

    def to_json(self) -> str:
        return json.dumps([self.weights, self.exceptions, self.curve])

    @classmethod
    def from_json(cls, text: str) -> Lexicon:
        weights, exceptions, curve = json.loads(text)
        return cls(weights, exceptions, tuple(curve))

    def machine(self):
        if self._machine is None:
            import ahocorasick

            machine = ahocorasick.Automaton()
            for key, weight in self.weights.items():
                machine.add_word(key, (len(key), weight))
            for phrase in self.exceptions:
                machine.add_word(phrase, (len(phrase), None))
            machine.make_automaton()
            self._machine = machine
        return self._machine

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the matches that no exception phrase covers; one per start, the heaviest."""
        if not self.weights:
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.machine().iter(folded):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif start not in best or weight > best[start][1]:
                best[start] = (end, weight)
        if spared:
            best = {s: m for s, m in best.items() if not any(a <= s and m[0] <= b for a, b in spared)}
        return [(s, e, w) for s, (e, w) in best.items()]

    def features(self, text: str | None) -> tuple[float, float]:
        """Matched weight per word and matched weight, both on a log scale."""
        return self.folded_features(fold(text or ""))

    def folded_features(self, folded: str) -> tuple[float, float]:
        total = sum(w for _, _, w in self.matches(folded))
        return math.log1p(100 * total / (folded.count(" ") - 1 + 50)), math.log1p(total)

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def _terms(folded: str, stems: tuple[int, ...]) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if len(w) >= 3:
            out.add(f" {w} ")
            out.update(f" {w[:k]}" for k in stems if len(w) >= k)
    return out


def learn(texts: list[str], labels: list[int], stems: tuple[int, ...] = (4, 5, 6), least_weight: float = 3.0) -> Lexicon:
    """Learn a lexicon: terms many times likelier in toxic texts, chosen until toxic texts are covered twice.

    The greedy cover takes the term that explains most uncovered texts, so rare words that copies of one toxic text
    share are not taken for lexicon entries.
    """
    folded = [fold(t) for t in texts]
    n_pos, n_neg = sum(labels), len(labels) - sum(labels)
    if not n_pos or not n_neg:
        return Lexicon({}, [], (math.log((n_pos + 0.5) / (n_neg + 0.5)) if labels else -5.0, 0.0, 0.0))
    # the terms of one text at a time; only those that enough toxic texts have are counted in the others and kept
    pos, neg = Counter(), Counter()
    for f, y in zip(folded, labels):
        if y:
            pos.update(_terms(f, stems))
    least = max(3, math.ceil(0.01 * n_pos)) if n_pos >= 6 else 2
    pos = {t: c for t, c in pos.items() if c >= least}
    for f, y in zip(folded, labels):
        if not y:
            neg.update(pos.keys() & _terms(f, stems))
    weight = {t: math.log((c + 0.5) / (n_pos + 1)) - math.log((neg[t] + 0.5) / (n_neg + 1))
              for t, c in pos.items()}
    weight = {t: w for t, w in weight.items() if w >= least_weight}
    holders = defaultdict(list)
    for i, f in enumerate(f for f, y in zip(folded, labels) if y):
        for t in weight.keys() & _terms(f, stems):
            holders[t].append(i)
    need, chosen = [2] * n_pos, {}
    gain = {t: len(h) for t, h in holders.items()}
    while gain:
        # among equal gains a stem before a whole word, then the longer one
        t = max(gain, key=lambda k: (gain[k] * weight[k], k[-1] != " ", len(k), k))
        now = sum(need[i] > 0 for i in holders[t])
        if now < gain[t]:
            gain[t] = now
            if now < least:
                del gain[t]
            continue
        if now < least:
            break
        del gain[t]
        # a stem and the words that begin with it are one entry
        if any(t.startswith(c) or c.startswith(t.rstrip()) for c in chosen):
            continue
        chosen[t] = weight[t]
        for i in holders[t]:
            need[i] -= need[i] > 0
    plain = Lexicon(chosen, [], (0.0, 0.0, 0.0))
    spared = _exceptions(plain, folded, labels)
    model = Lexicon(chosen, spared, (0.0, 0.0, 0.0))
    x = np.array([(1.0, *model.folded_features(f)) for f in folded])
    model.curve = _logistic(x, np.array(labels, dtype=float))
    return model


def _exceptions(model: Lexicon, folded: list[str], labels: list[int]) -> list[str]:
    """Two-word phrases around a match that are found in harmless texts mostly."""
    pos, neg = Counter(), Counter()
    for f, y in zip(folded, labels):
        found = set()
        for start, end, _ in model.matches(f):
            stop = f.find(" ", max(end, start + 1))
            before, after = f.rfind(" ", 0, start), f.find(" ", stop + 1)
            if before >= 0:
                found.add(f[before:stop + 1])
            if after > 0:
                found.add(f[start:after + 1])
        (pos if y else neg).update(found)
    return [p for p, c in neg.items() if c >= 3 and c > 3 * pos[p]]


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[float, float, float]:
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 8_000) -> Lexicon:
    """Learn from labelled documents whose fold (crc32 of doc_id mod 5) is not 0.

    ``max_rows`` bounds the sample in expectation; one task learns from it. Rows without text or label are left out,
    and a document is taken once. No labelled rows: an empty lexicon that rejects nothing.
    """
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (text_fold(F.col("doc_id")) != 0))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = bounded_sample(known, "doc_id", max_rows)
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(chosen, "doc_id")

    def one(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["doc_id", "text"]).drop_duplicates("doc_id")
        return pd.DataFrame({"model": [learn(sample["text"].tolist(), sample["toxic"].tolist()).to_json()]})

    found = rows.groupBy(F.lit(0).alias("all")).applyInPandas(one, "model string").collect()
    return Lexicon.from_json(found[0]["model"]) if found else learn([], [])


def toxicity_score(model: Lexicon):
    """Column function ``text -> score`` between 0 and 1; NULL text scores like an empty one."""
    packed = model.to_json()
    state: dict[str, Lexicon] = {}

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if "model" not in state:
            state["model"] = Lexicon.from_json(packed)
        return pd.Series([state["model"].score(t) for t in texts], dtype="float64")

    return score


def score_documents(docs: DataFrame, model: Lexicon, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; repeated rows are scored each, other columns are ignored."""
    return (docs.select("doc_id", (text_fold(F.col("doc_id")) == 0).alias("held_out"),
                        toxicity_score(model)("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_harmless(docs: DataFrame, model: Lexicon, threshold: float = 0.5) -> DataFrame:
    """Documents that score below ``threshold``, with all their columns."""
    return docs.where(toxicity_score(model)(F.col("text")) < threshold)


by_value(__name__)
