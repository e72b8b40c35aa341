"""Runs of words that repeat with a period, found by uniting suffix classes in order of falling common prefix.

Suffixes of a text are sorted by doubling, the common prefix of neighbours in that order is an edge between two positions,
and edges are taken from the longest to the shortest. At length l the classes are the sets of positions whose next l words
are the same; a class keeps its positions in order. When an edge joins two classes, positions i < j that become neighbours
share exactly l words. If j - i is small enough against l, the words from i to j + l have period j - i, and it is their
smallest one: a shorter one would have put a position between i and j. Where the word before i differs from the one
before j, the run starts at i. Every run is met this way, at its first word and the one a period later.

A run of at least ``min_length`` words and ``min_exponent`` periods needs ``min_length * (1 - 1 / min_exponent)`` common
words, so suffixes that share fewer with every other one are left out before any class is made.

Rows: NULL texts count as empty, texts without words have no run; repeated rows give repeated results; an empty table gives
an empty one; further columns, whatever their names, are ignored. Each text is handled whole.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import by_value

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Words of the texts that are sorted together; a longer text is sorted on its own.
GROUP_WORDS = 200_000


def suffix_order(first: np.ndarray) -> np.ndarray:
    """Suffixes in order; every text in ``first`` ends with a number of its own.

    A place is the first one of all suffixes that agree so far; each round doubles the length and sorts only those that
    still agree with another.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    place = np.empty(n, dtype=np.int64)
    ordered = first[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(starts, n))
    place[order] = np.repeat(starts, sizes)
    open_at = np.flatnonzero(np.repeat(sizes > 1, sizes))
    length = 1
    while len(open_at):
        some = order[open_at]
        high, low = place[some], place[some + length]
        by = np.lexsort((low, high))
        some, high, low = some[by], high[by], low[by]
        order[open_at] = some
        new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
        starts = np.flatnonzero(new)
        place[some] = open_at[starts][np.cumsum(new) - 1]
        sizes = np.diff(np.append(starts, len(some)))
        open_at = open_at[np.repeat(sizes > 1, sizes)]
        length *= 2
    return order


def deep_edges(first: np.ndarray, least: int) -> tuple[list[int], list[int], list[int]]:
    """Neighbours in suffix order with at least ``least`` common numbers, longest first, as (left, right, length)."""
    n = len(first)
    order = suffix_order(first)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(before >= 0)
    at = at[(at + least <= n) & (before[at] + least <= n)]
    for k in range(least):
        at = at[first[at + k] == first[before[at] + k]]
    words, left = memoryview(first), before[at].tolist()
    lefts, rights, lengths = [], [], []
    last, l = -2, 0
    for i, j in zip(at.tolist(), left):
        # the common prefix falls by at most one from a position to the next
        l = max(least, l - 1) if i == last + 1 else least
        while words[i + l] == words[j + l]:
            l += 1
        last = i
        lefts.append(j)
        rights.append(i)
        lengths.append(l)
    by = np.argsort(-np.array(lengths, dtype=np.int64), kind="stable").tolist()
    return [lefts[x] for x in by], [rights[x] for x in by], [lengths[x] for x in by]


class Classes:
    """Union-find over positions; every class keeps its positions in order."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.members: dict[int, list[int]] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        if x not in parent:
            parent[x] = x
            self.members[x] = [x]
            return x
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def unite(self, x: int, y: int) -> list[tuple[int, int]]:
        """Join the classes of ``x`` and ``y``; returns the positions that become neighbours."""
        a, b = self.root(x), self.root(y)
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        large, small = self.members[a], self.members.pop(b)
        self.parent[b] = a
        pairs = []
        for k, z in enumerate(small):
            at = bisect_left(large, z)
            if at and not (k and small[k - 1] > large[at - 1]):
                pairs.append((large[at - 1], z))
            if at < len(large) and not (k + 1 < len(small) and small[k + 1] < large[at]):
                pairs.append((z, large[at]))
        if 8 * len(small) < len(large):
            for z in small:
                insort(large, z)
        else:
            large += small
            large.sort()
        return pairs


def find_runs(numbers: np.ndarray, sizes: list[int], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period; texts lie one after the other."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    least = -(-min_length * (min_exponent - 1) // min_exponent)
    if max(sizes, default=0) <= least:
        return found
    # numbers of different texts never agree, and each text ends with a number of its own
    text = np.repeat(np.arange(len(sizes)), np.array(sizes) + 1)
    starts = np.cumsum(np.array(sizes) + 1) - np.array(sizes) - 1
    ends = starts + np.array(sizes)
    kinds = int(numbers.max(initial=0)) + 2
    first = np.zeros(len(text), dtype=np.int64)
    inner = np.ones(len(text), dtype=bool)
    inner[ends] = False
    first[inner] = numbers + 1
    first = text * kinds + first
    # no common prefix reaches the end of a text, so a word can be compared with the one behind any prefix
    classes, words, bounds = Classes(), memoryview(first), starts.tolist()
    for x, y, l in zip(*deep_edges(first, least)):
        for i, j in classes.unite(x, y):
            period = j - i
            length = period + l
            if length < min_exponent * period or length < min_length:
                continue
            of = int(text[i])
            if i == bounds[of] or words[i - 1] != words[j - 1]:
                found[of].append((i - bounds[of], length, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds behind its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()])


def detect(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period) and collapsed text of every row of ``docs``."""
    if min_exponent < 2 or min_length < min_exponent:
        raise ValueError("a run has at least two periods and as many words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("raw")
            low = 0
            while low < len(batch):
                split: list[list[bytes]] = []
                held = 0
                while low + len(split) < len(batch) and held < GROUP_WORDS:
                    words = (texts[low + len(split)].as_py() or b"").split()
                    if split and held + len(words) > GROUP_WORDS:
                        break
                    held += len(words)
                    split.append(words)
                yield _rows(ids.slice(low, len(split)), split)
                low += len(split)

    def _rows(ids: pa.Array, split: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        numbers = np.array([number.setdefault(w, len(number)) for words in split for w in words], dtype=np.int64)
        sizes = [len(words) for words in split]
        found = find_runs(numbers, sizes, min_length, min_exponent)
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
        runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found], kind)
        texts = pa.array([collapse(w, rs) for w, rs in zip(split, found)], pa.binary())
        return pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), runs, texts], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", F.col("text").cast("binary").alias("raw")).mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return made.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equals; NULL without runs. Runs are in order.

    Fractions are compared by multiplying across, so equal ones are equal.
    """
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, nothing, better)


def listed(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
                              F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


by_value(__name__)
