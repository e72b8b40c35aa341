"""Packing of tokenized documents into sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut; whole sequences are finished at once. The other pieces are dealt by a hash
into blocks of bounded size. Several islands evolve each block: a crossover injects well-filled bins of one parent into
the other, removes what is now double, and best-fits the displaced pieces. Between epochs the best solution of each
island migrates to the next one. Bins that stay badly filled are opened and their pieces are packed again together.
"""

from __future__ import annotations

import bisect
import math
import random
import re
import zlib
from array import array
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitaspan.llm.common import by_value, worker_state
from vitaspan.session import freeze

SIZE = 2048
BLOCK = 1024
ISLANDS = 2
EPOCHS = 2
CROSSOVERS = 24
#: Bins with more free tokens than this share of a sequence are packed again.
LOOSE = 1 / 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for themselves, others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(printable)))
    return [letters[b] for b in range(256)]


class Recent(dict):
    """What ``make`` gives for a key, kept for the last ``most`` to ``2 * most`` keys that were asked for.

    What is not asked for in a whole generation is dropped.
    """

    def __init__(self, most: int, make):
        self.most, self.make, self.older = most, make, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def turn(self) -> None:
        """Begin a new generation if this one is full."""
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class Tokens:
    """Ids of whole texts as little-endian bytes. Words between ASCII white space never share a token, so the ids of
    a word are kept and used again.

    A new word of Latin letters, digits and signs is folded and split here as the tokenizer's own pattern does, and only its
    pieces go through the merges of the model, also kept. Any other word goes through the whole tokenizer.
    """

    #: Words handled here: no mark that normalization could join, no capital whose small letter depends on its place.
    PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]+")
    # fixed values: the vocabulary's own pattern over small letters of that range
    SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿĀ-ſ]+|[0-9²³¹¼-¾]|[^a-zªµºß-öø-ÿĀ-ſ0-9²³¹¼-¾]+")

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, dict(enumerate(_byte_letters()))
        self.words, self.pieces = Recent(most, self._word), Recent(most, self._piece)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if b"<|" in word or not self.PLAIN.fullmatch(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        parts = self.SPLIT.findall(text.lower())
        return self.pieces[parts[0]] if len(parts) == 1 else b"".join(map(self.pieces.__getitem__, parts))

    def of(self, texts: list[str | None]) -> list[bytes]:
        """The ids of several texts."""
        self.words.turn()
        self.pieces.turn()
        get = self.words.__getitem__
        return [b"".join(map(get, (t or "").encode("utf-8", "surrogatepass").split())) for t in texts]

    def __call__(self, text: str | None) -> bytes:
        return self.of([text])[0]


def pieces(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every row's ids and an end id 0, cut every ``size`` tokens. NULL text: empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer or default_tokenizer()
        tokens, step = worker_state(f"tokens of {path}", lambda: Tokens(path)), 4 * size
        for batch in batches:
            of, rows = [], []
            texts = batch.column("text").to_pylist()
            for low in range(0, len(texts), 64):
                for k, ids in enumerate(tokens.of(texts[low:low + 64]), low):
                    raw = ids + b"\0\0\0\0"
                    for i in range(0, len(raw), step):
                        part = raw[i:i + step]
                        of.append(k)
                        rows.append((i // step, i // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows) if rows else ((), (), (), ())
            data = [batch.column("doc_id").take(pa.array(of, pa.int64()))]
            data += [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(data, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Solution:
    """Bins (lists of item numbers) and their fills."""

    def __init__(self, bins: list[list[int]], fills: list[int], size: int):
        self.bins, self.fills = bins, fills
        self.fitness = sum((f / size) ** 2 for f in fills) / max(1, len(fills))

    def better(self, other: Solution | None) -> bool:
        return other is None or (len(self.bins), -self.fitness) < (len(other.bins), -other.fitness)


def best_fit(items: list[int], lengths: list[int], bins: list[list[int]], fills: list[int], size: int) -> None:
    """Put items, longest first, each into the fullest bin that takes it, else into a new one."""
    free = sorted((size - f, k) for k, f in enumerate(fills))
    for i in sorted(items, key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        at = bisect.bisect_left(free, (need, -1))
        if at == len(free):
            k, room = len(bins), size
            bins.append([])
            fills.append(0)
        else:
            room, k = free.pop(at)
        bins[k].append(i)
        fills[k] += need
        bisect.insort(free, (room - need, k))


def cross(a: Solution, b: Solution, lengths: list[int], size: int, rng: random.Random) -> Solution:
    """A child of ``a`` with about a third of ``b``'s better-filled bins."""
    good = sorted(range(len(b.bins)), key=lambda k: -b.fills[k])[:max(1, len(b.bins) * 2 // 3)]
    chosen = rng.sample(good, max(1, len(good) // 2))
    taken = {i for k in chosen for i in b.bins[k]}
    bins, fills = [list(b.bins[k]) for k in chosen], [b.fills[k] for k in chosen]
    loose = []
    for k, items in enumerate(a.bins):
        if taken.isdisjoint(items):
            bins.append(list(items))
            fills.append(a.fills[k])
        else:
            loose += [i for i in items if i not in taken]
    # mutation: the emptiest bins are opened too
    for k in sorted(range(len(bins)), key=lambda k: fills[k])[:rng.randint(0, 3)][::-1]:
        if fills[k] < size:
            loose += bins[k]
            bins[k] = None
    fills = [f for f, x in zip(fills, bins) if x is not None]
    bins = [x for x in bins if x is not None]
    best_fit(loose, lengths, bins, fills, size)
    return Solution(bins, fills, size)


def evolve(lengths: list[int], given: list[list[int]], size: int, seed: int, crossovers: int = CROSSOVERS,
           population: int = 4) -> list[int]:
    """The bin of every item after some crossovers, starting from ``given`` solutions (bin numbers) and random ones."""
    rng, n = random.Random(seed), len(lengths)
    pool = []
    for numbers in given:
        bins: dict[int, list[int]] = {}
        for i, k in enumerate(numbers):
            bins.setdefault(k, []).append(i)
        pool.append(Solution(list(bins.values()), [sum(lengths[i] for i in x) for x in bins.values()], size))
    least = math.ceil(sum(lengths) / size)
    while len(pool) < population:
        bins, fills = [], []
        order = list(range(n))
        if pool:
            # some pieces are placed at random first
            rng.shuffle(order)
            for i in order[:rng.randint(0, n // 4)]:
                if fills and fills[-1] + lengths[i] <= size:
                    bins[-1].append(i)
                    fills[-1] += lengths[i]
                else:
                    bins.append([i])
                    fills.append(lengths[i])
            placed = {i for x in bins for i in x}
            order = [i for i in order if i not in placed]
        best_fit(order, lengths, bins, fills, size)
        pool.append(Solution(bins, fills, size))
        if len(pool[-1].bins) == least:
            break
    best = min(pool, key=lambda s: (len(s.bins), -s.fitness))
    for _ in range(crossovers):
        if len(best.bins) <= least or len(pool) < 2:
            break
        a, b = rng.sample(pool, 2)
        child = cross(a, b, lengths, size, rng)
        worst = max(range(len(pool)), key=lambda k: (len(pool[k].bins), -pool[k].fitness))
        if child.better(pool[worst]):
            pool[worst] = child
        if child.better(best):
            best = child
    numbers = [0] * n
    for k, items in enumerate(best.bins):
        for i in items:
            numbers[i] = k
    return numbers


def _islands(rows: DataFrame, epoch: int, size: int) -> DataFrame:
    """One epoch: rows (block, island, pids, lengths, numbers) of one island become its best solution."""
    def run(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        lengths = [int(x) for x in first["lengths"]]
        given = [[int(x) for x in numbers] for numbers in group["numbers"] if numbers is not None and len(numbers)]
        given.sort()
        numbers = evolve(lengths, given, size, seed=hash((int(key[0]), int(key[1]), epoch)))
        used: dict[int, int] = {}
        for length, k in zip(lengths, numbers):
            used[k] = used.get(k, 0) + length
        fitness = sum((f / size) ** 2 for f in used.values()) / max(1, len(used))
        return pd.DataFrame({"block": [key[0]], "island": [key[1]], "pids": [first["pids"]], "lengths": [lengths],
                             "numbers": [numbers], "n_bins": [len(used)], "fitness": [fitness]})

    return rows.groupBy("block", "island").applyInPandas(
        run, "block long, island int, pids array<long>, lengths array<long>, numbers array<int>, n_bins int, fitness double")


def _pack(items: DataFrame, size: int, block: int, islands: int, epochs: int) -> DataFrame:
    """``pid, length, bin, fill``: items (pid, length) in bins; a bin is named by the smallest pid in it."""
    n = items.count()
    blocks = max(1, -(-n // block))
    dealt = (items.withColumn("block", F.pmod(F.xxhash64("pid"), F.lit(blocks)))
             .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pid", "length"))).alias("x"))
             .select("block", F.col("x.pid").alias("pids"), F.col("x.length").alias("lengths"),
                     F.lit(None).cast("array<int>").alias("numbers"))
             .withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)]))))
    state = freeze(_islands(dealt, 0, size))
    for epoch in range(1, epochs):
        migrants = state.withColumn("island", ((F.col("island") + 1) % islands).cast("int"))
        state = freeze(_islands(state.unionByName(migrants).select("block", "island", "pids", "lengths", "numbers"), epoch, size))
    best = state.groupBy("block").agg(F.min(F.struct("n_bins", (-F.col("fitness")).alias("f"), "island", "pids", "lengths", "numbers")).alias("s"))
    placed = best.select("block", F.explode(F.arrays_zip("s.pids", "s.lengths", "s.numbers")).alias("x")).select(
        "block", F.col("x.pids").alias("pid"), F.col("x.lengths").alias("length"), F.col("x.numbers").alias("k"))
    bins = (placed.groupBy("block", "k").agg(F.sort_array(F.collect_list(F.struct("pid", "length"))).alias("x"), F.sum("length").alias("fill")))
    return bins.select(F.col("x")[0]["pid"].alias("bin"), "fill", F.explode("x").alias("x")).select(
        "x.pid", "x.length", "bin", "fill")


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, block: int = BLOCK, islands: int = ISLANDS,
         epochs: int = EPOCHS) -> DataFrame:
    """Pieces of all rows with ``sequence_id`` and ``offset``; offsets of a sequence run from 0 without gaps.

    Every row is packed, also repeated ones and those without text or id; other columns are ignored. Blocks are dealt
    by a hash of the row's own number, so copies of one document spread over all blocks.
    """
    if size < 1:
        raise ValueError("size must be positive")
    cut = freeze(pieces(docs, size, tokenizer).withColumn("pid", F.monotonically_increasing_id()))
    whole = cut.where(F.col("length") == size).select("*", (2 * F.col("pid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = freeze(_pack(cut.where(F.col("length") < size).select("pid", "length"), size, block, islands, epochs))
    tight = F.col("fill") >= size * (1 - LOOSE)
    second = _pack(first.where(~tight).select("pid", "length"), size, block, islands, epochs)
    done = first.where(tight).unionByName(second)
    inside = Window.partitionBy("bin").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    places = done.select("pid", (2 * F.col("bin") + 1).alias("sequence_id"),
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
    rest = cut.where(F.col("length") < size).join(places, "pid")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return whole.select(columns).unionByName(rest.select(columns))


by_value(__name__)
