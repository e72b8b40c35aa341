"""Language-model scores from an Elias-Fano trie of n-grams of any order that is cut into shards by first words.

Model: words with add-half smoothing below, n-grams of each order up to ``order`` with absolute discounting above,
interpolated from one order to the next: p(w | v) = max(c(v, w) - D, 0) / c(v) + D * fan_out(v) / c(v) * p(w | v'), where
v' is v without its first word; after a context never seen, p(w | v'). A document begins with one pseudo word, so its
first words have shorter contexts. The trie holds (c(v, w) - D) / tokens, quantised; word and context counts are exact.

Tasks read documents in batches. A batch is a trie of the ``order`` words that start at each place: its prefixes are the
n-grams of every shorter order, and a context's count is the count of the n-gram that it is. Every shard gets the
branches of its first words with training counts, as numbers into one list of word hashes. A shard sums the counts,
builds its trie, a level per order, and answers each batch in the order of its questions; the answers meet the batch's
documents again. No task, and no broadcast, holds the whole model. Branches below prefixes of more than 1 / HOT of all
tokens are spread over all shards by their next word; there are at most 2 * HOT such prefixes of each length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import by_value
from vitaspan.llm.elias_fano import Trie, dequantise, quantise
from vitaspan.session import freeze

DISCOUNT = 0.75
HOT = 4096
#: Tokens of a batch, and tokens of the corpus per shard; both bound a task's memory.
BATCH_TOKENS = 2_000_000
SHARD_TOKENS = 2_000_000
#: Pseudo words: no word is empty or holds a space. PAD follows the end where a branch needs more words.
END, BEGIN, PAD = b"", b" ", b"  "


def _hashes(words: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words.cast(pa.large_binary()).to_pylist(), repeat(42)), dtype=np.uint64, count=len(words))


class Batch:
    """Documents of one task as numbers of distinct words."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.held_out: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: pa.Array, held_out: pa.Array) -> None:
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words = pieces.flatten()
        # a text that begins or ends with a blank, or is empty, has an empty piece there
        full = pc.not_equal(pc.binary_length(words), 0)
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = np.add.reduceat(full.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(sizes) - sizes)
        self.words.append(words.filter(full).cast(pa.large_string()))
        self.lengths.append(lengths + 1)
        self.ids.append(ids)
        self.held_out.append(held_out.to_numpy(zero_copy_only=False))
        self.size += int(lengths.sum()) + len(lengths)

    def tokens(self) -> dict:
        """The words' numbers, ``words`` by number after the pseudo words, and each document's tokens and fold."""
        lengths = np.concatenate(self.lengths)
        coded = pa.concat_arrays(self.words).dictionary_encode()
        self.words.clear()
        tokens = np.zeros(lengths.sum(), dtype=np.int32)
        place = np.ones(len(tokens), dtype=bool)
        place[np.cumsum(lengths) - 1] = False
        tokens[place] = coded.indices.to_numpy(zero_copy_only=False) + np.int32(3)
        return {"words": pa.concat_arrays([pa.array([END, BEGIN, PAD], pa.large_binary()).cast(pa.large_string()), coded.dictionary]),
                "tokens": tokens, "lengths": lengths, "train": ~np.concatenate(self.held_out).astype(bool)}

    def arrays(self) -> dict:
        a = self.tokens()
        return a | {"hashes": _hashes(a["words"])}


def _contexts(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of the word before each token; BEGIN before the first of a document."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.cumsum(lengths) - lengths] = 1
    return out


def _longer(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of prefixes that have one more word behind; the key of one word is its hash."""
    out = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def _columns(tokens: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For every token the word before it, the token, and the words that follow in the document, ``order`` in all."""
    out, ends = [_contexts(tokens, lengths), tokens], np.cumsum(lengths)
    for m in range(1, order - 1):
        # what follows a document's last word is padding, as is what follows that
        column = np.empty_like(tokens)
        column[:-1], column[-1] = out[-1][1:], 2
        column[ends - 1] = 2
        out.append(column)
    return out


class Level(NamedTuple):
    """Distinct prefixes of one length, in the order of their words' numbers; places have 32 bits."""

    words: np.ndarray  #: last words
    parents: np.ndarray  #: places of the prefixes one word shorter
    keys: np.ndarray
    rows: np.ndarray  #: each row's prefix


def _next(before: Level, rows: np.ndarray, column: np.ndarray, hashes: np.ndarray) -> Level:
    """Prefixes with one more word: ``rows`` are prefixes of ``before``, ``column`` the word behind each."""
    nodes, rows = np.unique(rows.astype(np.int64) * len(hashes) + column, return_inverse=True)
    parents, words = (x.astype(np.int32) for x in np.divmod(nodes, len(hashes)))
    return Level(words, parents, _longer(before.keys[parents], hashes[words]), rows.astype(np.int32))


def _levels(columns: list[np.ndarray], hashes: np.ndarray) -> list[Level]:
    there = np.zeros(len(hashes), dtype=bool)
    there[columns[0]] = True
    words = np.flatnonzero(there).astype(np.int32)
    out = [Level(words, np.zeros(len(words), dtype=np.int32), hashes[words], (np.cumsum(there, dtype=np.int32) - 1)[columns[0]])]
    for column in columns[1:]:
        out.append(_next(out[-1], out[-1].rows, column, hashes))
    return out


def _find(ordered: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of x in a sorted list, or -1."""
    if not len(ordered):
        return np.full(len(x), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return np.where(ordered[at] == x, at, -1)


class Questions:
    """What a batch asks: its trie, dealt to shards; a prefix whose branches are spread stands in the message of each."""

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, hot: np.ndarray, shards: int, order: int):
        by_hash = np.argsort(hashes)
        rank = np.empty(len(hashes), dtype=np.int32)
        rank[by_hash] = np.arange(len(hashes), dtype=np.int32)
        self.hashes, self.rank = hashes[by_hash], rank
        self.columns = [rank[c] for c in _columns(tokens, lengths, order)]
        self.levels = _levels(self.columns, self.hashes)
        # a branch belongs to the shard of its shortest prefix that is not hot
        first = self.levels[0]
        self.hot = [_find(hot, first.keys)]
        home = first.keys
        for level in self.levels[1:]:
            spread = self.hot[-1][level.parents] >= 0
            home = np.where(spread, level.keys, home[level.parents])
            self.hot.append(np.where(spread, _find(hot, level.keys), -1))
        home = (home % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
        self.levels = [level._replace(keys=level.keys[:0]) for level in self.levels]
        nodes = np.argsort(home, kind="stable").astype(np.int32)
        shard = home[nodes]
        #: per level: prefixes as the messages list them, where each message begins, and how many prefixes follow below each
        self.nodes, self.bounds, self.children = [nodes], [np.searchsorted(shard, np.arange(shards + 1))], []
        for level in self.levels[:0:-1]:
            above = level.parents[nodes]
            starts = np.flatnonzero(np.append(True, (above[1:] != above[:-1]) | (shard[1:] != shard[:-1])))
            self.children.insert(0, np.diff(np.append(starts, len(nodes))))
            nodes, shard = above[starts], shard[starts]
            self.nodes.insert(0, nodes)
            self.bounds.insert(0, np.searchsorted(shard, np.arange(shards + 1)))

    def messages(self, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Shard and message; ``counts``: of each longest prefix, in training."""
        for s in range(len(self.bounds[0]) - 1):
            parts = [slice(b[s], b[s + 1]) for b in self.bounds]
            if parts[0].start == parts[0].stop:
                continue
            words = [level.words[n[p]] for level, n, p in zip(self.levels, self.nodes, parts)]
            used, number = np.unique(np.concatenate(words), return_inverse=True)
            numbers = np.split(number, np.cumsum([len(w) for w in words])[:-1])
            yield s, _pack(np.diff(self.hashes[used], prepend=np.uint64(0)), *(c[p] for c, p in zip(self.children, parts)), *numbers,
                           counts[self.nodes[-1][parts[-1]]])


def _pack(*arrays: np.ndarray) -> bytes:
    """Numbers from 0 up; the bytes of an array's numbers are compressed place by place."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, dtype="<u8")
        width = -(-int(a.max()).bit_length() // 8) if len(a) else 0
        raw = a.view(np.uint8).reshape(-1, 8)
        planes = [pa.compress(np.ascontiguousarray(raw[:, i]), codec="zstd", asbytes=True) for i in range(width)]
        out += [np.array([len(a), width, *map(len, planes)], dtype="<u4").tobytes(), *planes]
    return b"".join(out)


def _unpack(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        n, width = np.frombuffer(raw, "<u4", 2, at).tolist()
        sizes = np.frombuffer(raw, "<u4", width, at + 8).tolist()
        at += 8 + 4 * width
        wide = 1 << max(0, width - 1).bit_length()
        numbers = np.zeros((n, wide), dtype=np.uint8)
        for i, size in enumerate(sizes):
            numbers[:, i] = np.frombuffer(pa.decompress(raw[at:at + size], decompressed_size=n, codec="zstd"), dtype=np.uint8)
            at += size
        out.append(numbers.view(f"<u{wide}").ravel())
    return out


def _batches(docs: DataFrame, parts: int, fold: int, emit, schema: str, batch_tokens: int) -> DataFrame:
    """``emit(batch number, Batch)`` for every batch; numbers follow the input's partitions and order, so reruns agree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, read, piece = TaskContext.get().partitionId() << 32, Batch(), 0, 0
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            # documents of about as many bytes as a batch has tokens are split at once; a batch ends between two such pieces
            pieces = (read + np.cumsum(size) - size) // batch_tokens
            read += int(size.sum())
            starts = np.flatnonzero(np.append(True, pieces[1:] != pieces[:-1])) if len(size) else []
            for start, stop in zip(starts, [*starts[1:], len(size)]):
                if pieces[start] != piece and held.size >= batch_tokens:
                    yield from emit(number, held)
                    number, held = number + 1, Batch()
                    pa.default_memory_pool().release_unused()
                piece = pieces[start]
                held.add(*(batch.column(i).slice(start, stop - start) for i in range(3)))
        if held.size:
            yield from emit(number, held)

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("string"), "text", (F.crc32(key) % parts == fold).alias("held_out")).mapInArrow(run, schema)


def score(docs: DataFrame, parts: int = 5, fold: int = 1, discount: float = DISCOUNT, shard_tokens: int = SHARD_TOKENS,
          batch_tokens: int = BATCH_TOKENS, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    The model has n-grams of up to ``order`` words (2 or more) and learns from rows whose crc32(doc_id as text) mod
    ``parts`` is not ``fold``. ``docs`` must give the same rows in the same order when read again (a table does). NULL
    texts count as empty, NULL ids as empty text; repeated rows are learned and scored each; other columns are ignored.
    """
    if order < 2:
        raise ValueError("order is 2 or more")
    spark = docs.sparkSession
    # a batch holds a level per order
    batch_tokens = max(1, batch_tokens // (order - 1))
    begin, pad = _hashes(pa.array([BEGIN, PAD], pa.binary()))

    def count(number: int, held: Batch) -> Iterator[pa.RecordBatch]:
        a = held.tokens()
        size = len(a["tokens"])
        keys, above = [np.zeros(2, dtype=np.uint64)], [np.zeros(2, dtype=np.uint64)]
        length, seen = [np.array([0, -1])], [np.array([size, a["lengths"][a["train"]].sum()])]
        # only rows of prefixes that come often are followed to the next word
        rows, nodes, before = np.arange(size), np.zeros(size, dtype=np.int64), None
        for m, column in enumerate(_columns(a["tokens"], a["lengths"], order)[:order - 1], 1):
            found, nodes, n = np.unique(nodes * len(a["words"]) + column[rows], return_inverse=True, return_counts=True)
            # what has 1 / HOT of all tokens has half of that in batches where it has 1 / (2 * HOT)
            much = n * (2 * HOT) >= size
            parents, words = np.divmod(found[much], len(a["words"]))
            hashes = _hashes(a["words"].take(pa.array(words)))
            now = hashes if before is None else _longer(before[parents], hashes)
            keys.append(now)
            above.append(now if before is None else before[parents])
            length.append(np.full(len(now), m))
            seen.append(n[much])
            kept = much[nodes]
            rows, nodes, before = rows[kept], (np.cumsum(much) - 1)[nodes[kept]], now
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(above).view(np.int64)),
                                          pa.array(np.concatenate(length)), pa.array(np.concatenate(seen))],
                                         names=["prefix", "above", "length", "seen"])

    table = freeze(_batches(docs, parts, fold, count, "prefix long, above long, length long, seen long", batch_tokens)
                   .groupBy("prefix", "above", "length").agg(F.sum("seen").alias("seen")))
    sums = {r["length"]: r["seen"] for r in table.where("length <= 0").collect()}
    n_all, n_train = int(sums.get(0, 0)), int(sums.get(-1, 0))
    shards = max(1, -(-n_all // shard_tokens))
    # at most 2 * HOT prefixes of each length reach this share; below one that does not, none is needed
    much = sorted((r["length"], r["prefix"], r["above"]) for r in
                  table.where((F.col("length") > 0) & (F.col("seen") * (2 * HOT) >= n_all)).collect())
    above_hot: dict[int, int] = {}
    for m, prefix, above in much:
        if m == 1 or above in above_hot:
            above_hot[prefix] = above
    hot = np.sort(np.array(list(above_hot), dtype=np.int64).view(np.uint64))
    one_word = np.array([above_hot[k] == k for k in hot.view(np.int64).tolist()], dtype=bool)
    hot_above = _find(hot, np.array([above_hot[k] for k in hot.view(np.int64).tolist()], dtype=np.int64).view(np.uint64))

    def ask(number: int, held: Batch) -> Iterator[pa.RecordBatch]:
        a = held.arrays()
        asked = Questions(a["hashes"], a["tokens"], a["lengths"], hot, shards, order)
        last = asked.levels[-1]
        counts = np.bincount(last.rows[np.repeat(a["train"], a["lengths"])], minlength=len(last.words))
        for s, raw in asked.messages(counts):
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([s], pa.int64()), pa.array([raw], pa.binary())],
                                             names=["batch", "shard", "raw"])

    def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        numbers = group.column("batch").to_pylist()
        # per message: word hashes, numbers of branches by level, words by level, counts
        asked = [_unpack(r.as_py()) for r in group.column("raw")]
        words, number = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked]), return_inverse=True)
        number, starts = number.astype(np.int32), np.cumsum([0, *(len(a[0]) for a in asked)])
        levels: list[Level] = []
        for m in range(order):
            columns = [a[order + m] for a in asked]
            column = np.concatenate([number[i:j][c] for i, j, c in zip(starts, starts[1:], columns)])
            if not m:
                levels = _levels([column], words)
                continue
            above = np.repeat(levels[-1].rows, np.concatenate([a[m] for a in asked]).astype(np.int64))
            levels.append(_next(levels[-1], above, column, words))
        counts = [np.bincount(levels[-1].rows, np.concatenate([a[-1] for a in asked]), len(levels[-1].keys)).astype(np.int64)]
        for above, level in zip(levels[-2::-1], levels[:0:-1]):
            counts.insert(0, np.bincount(level.parents, counts[0], len(above.keys)).astype(np.int64))
        at_hot = [_find(hot, level.keys) for level in levels[:-1]] + [np.full(len(levels[-1].keys), -1)]
        codes, fans = [], []
        sums = np.zeros((2, len(hot)), dtype=np.int64)
        for m in range(1, order):
            level, c, above = levels[m], counts[m], levels[m - 1]
            known = np.flatnonzero((c > 0) & (words[level.words] != pad))
            parents, last = level.parents[known].astype(np.uint64), level.words[known].astype(np.uint64)
            trie = Trie(parents, last, np.maximum(c[known] - discount, 1e-300) / max(1, n_train))
            # every distinct question is looked up once
            codes.append(trie.lookup(level.parents.astype(np.uint64), level.words.astype(np.uint64)))
            fans.append(trie.fan_out(np.arange(len(above.keys), dtype=np.uint64)))
            # a hot prefix is in many shards: it is no branch of the prefix before it here, and is added to that at the end
            apart = known[at_hot[m][known] >= 0]
            mine = np.flatnonzero(at_hot[m - 1] >= 0)
            np.add.at(sums[0], at_hot[m - 1][mine], counts[m - 1][mine])
            np.add.at(sums[1], at_hot[m - 1][mine], (fans[-1] - np.bincount(level.parents[apart], minlength=len(above.keys)))[mine])
        of_level = [[counts[m], fans[m]] + ([codes[m - 1]] if m else []) for m in range(order - 1)] + [[codes[-1]]]
        ends = [np.cumsum([0, *(len(a[order + m]) for a in asked)]) for m in range(order)]
        out = [_pack(*(x[levels[m].rows[ends[m][k]:ends[m][k + 1]]] for m in range(order) for x in of_level[m])) for k in range(len(asked))]
        shard, mine = int(key[0].as_py()), np.flatnonzero(sums[0])
        n_known = int(((counts[0] > 0) & (at_hot[0] < 0) & (levels[0].keys != begin)).sum())
        return pa.table({"batch": pa.array([*numbers, -1], pa.int64()), "shard": pa.array([shard] * (len(out) + 1), pa.int64()),
                         "raw": pa.array([*out, _pack(np.array([n_known]), mine, *sums[:, mine])], pa.binary())})

    message = "batch long, shard long, raw binary"
    answers = freeze(_batches(docs, parts, fold, ask, message, batch_tokens).groupBy("shard").applyInArrow(answer, message))
    n_words, of_hot = int(n_train > 0), np.zeros((2, len(hot)), dtype=np.int64)
    for r in answers.where("batch < 0").select("raw").toLocalIterator():
        known, at, whole, fan = (x.astype(np.int64) for x in _unpack(bytes(r["raw"])))
        n_words += int(known[0])
        of_hot[:, at] += np.stack([whole, fan])
    n_words += int((one_word & (of_hot[0] > 0) & (hot != begin)).sum())
    np.add.at(of_hot[1], hot_above[~one_word], of_hot[0][~one_word] > 0)

    def encode(number: int, held: Batch) -> Iterator[pa.RecordBatch]:
        a = held.arrays()
        ids = pa.concat_arrays(held.ids).cast(pa.string())
        packed = pa.ipc.new_stream(sink := pa.BufferOutputStream(), pa.schema([("id", pa.string())]))
        packed.write_batch(pa.RecordBatch.from_arrays([ids], names=["id"]))
        packed.close()
        raw = _pack(a["hashes"], a["tokens"], a["lengths"], a["train"], np.frombuffer(sink.getvalue(), dtype=np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([-1], pa.int64()), pa.array([raw], pa.binary())],
                                         names=["batch", "shard", "raw"])

    def finish(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows = dict(zip(group.column("shard").to_pylist(), group.column("raw")))
        hashes, tokens, lengths, train, ids = _unpack(rows.pop(-1).as_py())
        tokens, lengths = tokens.astype(np.int32), lengths.astype(np.int64)
        asked = Questions(hashes, tokens, lengths, hot, shards, order)
        got = [_unpack(rows[s].as_py()) for s in sorted(rows)]
        wholes, fans, codes = [], [], [None]
        for m, (level, nodes, at) in enumerate(zip(asked.levels, asked.nodes, asked.hot)):
            k = max(0, 3 * m - 1)
            spread = np.flatnonzero(at >= 0)
            for i, values in enumerate((wholes, fans, codes) if 0 < m < order - 1 else (codes,) if m else (wholes, fans)):
                values.append(np.empty(len(level.words), dtype=np.int64))
                values[-1][nodes] = np.concatenate([g[k + i] for g in got])
            if m < order - 1:
                wholes[-1][spread], fans[-1][spread] = of_hot[:, at[spread]]
                if m:
                    c = wholes[-1][spread]
                    codes[-1][spread] = np.where(c > 0, quantise(np.maximum(c - discount, 1e-300) / max(1, n_train)), 0)
        # a word is a context wherever it stands; the end is none, and there is one for each beginning
        counts = np.zeros(len(hashes))
        counts[asked.levels[0].words] = wholes[0]
        counts[asked.rank[0]] = counts[asked.rank[1]]
        tokens = asked.columns[1]
        p = (counts + 0.5) / (n_train + 0.5 * (n_words + 1))
        after = p[tokens]
        for m in range(1, order):
            level = asked.levels[m]
            whole = wholes[m - 1]
            part = dequantise(codes[m]) * n_train / np.maximum(whole, 1)[level.parents]
            back_off = np.where(whole > 0, discount * fans[m - 1] / np.maximum(whole, 1), 1.0)[level.parents]
            there = np.flatnonzero(asked.columns[m] != asked.rank[2])
            gram, places = level.rows[there], there + (m - 1)
            after[places] = part[gram] + back_off[gram] * after[places]
        starts = np.cumsum(lengths) - lengths
        held = pa.ipc.open_stream(pa.py_buffer(ids.astype(np.uint8).tobytes())).read_all().column("id")
        n = len(lengths)
        return pa.table({
            "doc_id": held, "held_out": pa.array(train == 0), "n_tokens": pa.array(lengths),
            "n_known": pa.array(np.add.reduceat((counts[tokens] > 0).astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(n, n_train, dtype=np.int64)),
            "base_score": pa.array(np.add.reduceat(np.log10(p)[tokens], starts)),
            "score": pa.array(np.add.reduceat(np.log10(after), starts))})

    again = _batches(docs, parts, fold, encode, message, batch_tokens)
    kind = docs.schema["doc_id"].dataType
    scored = again.unionByName(answers.where("batch >= 0")).groupBy("batch").applyInArrow(
        finish, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("doc_id", F.col("doc_id").cast(kind))


by_value(__name__)
