"""SimHash near-duplicates: fingerprints joined by walking pairs of nodes of a binary trie.

A pair of fingerprints within ``max_bits`` agrees in at least one of ``max_bits + 1`` bit blocks, so the trie is rooted
once at each block (its bits rotated to the top) and only pairs below one node of that block meet. Below it, pairs of
nodes are walked together; a pair is dropped as soon as its differing bits exceed the budget. Node pairs that are too
large for one task are opened further by Spark, level by level, before any task compares leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import by_value
from vitaspan.llm.components import components
from vitaspan.session import freeze

SHINGLE = 4
MAX_BITS = 4
#: A task compares node pairs of at most so many fingerprints each.
NODE_ROWS = 8192
_STEP = 3


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text as an unsigned number; a text without words gives 0."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    line, stops = b" ".join(words), (ends - 1).tolist()
    digest = xxhash.xxh64_digest
    # digests are big-endian: bit 0 of the unpacked array is the highest one
    raw = b"".join([digest(line[a:b], 42) for a, b in zip(starts, stops[shingle - 1:])])
    n, counts = len(raw) // 8, np.zeros(64, dtype=np.int64)
    table = np.frombuffer(raw, dtype=np.uint8).reshape(n, 8)
    for low in range(0, n, 1 << 16):
        counts += np.unpackbits(table[low:low + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint_of(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(start from the top, width) of each block."""
    n = max_bits + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(n)]


def _rotate(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def node_pairs(fps: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """``a, b``: links that connect every two fingerprints of ``fps(fp)`` (distinct) within ``max_bits``, as forests.

    Not every close pair is listed: each task gives the edges of a spanning forest of its close pairs, which has the
    same components and at most one edge per fingerprint.
    """
    blocks = _blocks(max_bits)
    codes = freeze(fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), _rotate(F.col("fp"), start).alias("code")) for i, (start, _) in enumerate(blocks)
    ])).alias("x")).select("fp", "x.block", "x.code"))
    widths = F.element_at(F.array(*[F.lit(w) for _, w in blocks]), F.col("block") + 1)
    rooted = codes.withColumn("key", F.expr(
        "CASE block " + " ".join(f"WHEN {i} THEN shiftrightunsigned(code, {64 - w})" for i, (_, w) in enumerate(blocks)) + " END"))
    sizes = rooted.groupBy("block", "key").agg(F.count("*").alias("n"))
    large = freeze(sizes.where(F.col("n") > node_rows).select("block", "key", "n"))
    small_rows = rooted.select("block", F.col("key").alias("node_a"), F.col("key").alias("node_b"), F.lit(0).alias("depth"),
                               F.lit(0).alias("side"), "fp", "code")
    if large.isEmpty():
        return _walk(small_rows, max_bits)
    small_rows = small_rows.join(large.select("block", F.col("key").alias("node_a")), ["block", "node_a"], "left_anti")
    parts = [small_rows.select("block", "node_a", "node_b", "depth", "side", "fp", "code")]
    hot = freeze(rooted.join(large.select("block", "key"), ["block", "key"], "left_semi").select("block", "fp", "code"))
    # the frontier: pairs of nodes, as prefixes of ``at`` bits
    front, at = large.select("block", F.col("key").alias("a"), F.col("key").alias("b"), F.lit(0).alias("err")), widths
    while not front.isEmpty():
        deep = F.least(at + _STEP, F.lit(64))
        met = _open(front, hot, at, deep, max_bits, node_rows)
        done, front, at = met.where("small"), met.where("NOT small").drop("small"), deep
        parts += [_deal(done, hot, deep, side) for side in (0, 1)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _walk(rows, max_bits)


def _open(front: DataFrame, hot: DataFrame, at: Column, deep: Column, max_bits: int, node_rows: int) -> DataFrame:
    """Open node pairs from depth ``at`` to ``deep``: the children in budget, marked ``small`` if one task can walk them."""
    counts = freeze(hot.withColumn("deep", deep).withColumn("at", at)
                    .withColumn("node", F.expr("shiftrightunsigned(code, 64 - deep)"))
                    .groupBy("block", "at", "deep", "node").agg(F.count("*").alias("n"))
                    .withColumn("up", F.expr("shiftrightunsigned(node, deep - at)")))
    a = counts.select("block", F.col("up").alias("a"), F.col("node").alias("na"), F.col("n").alias("n_a"), "deep")
    b = counts.select("block", F.col("up").alias("b"), F.col("node").alias("nb"), F.col("n").alias("n_b"))
    return freeze(
        front.join(a, ["block", "a"]).join(b, ["block", "b"])
        .where((F.col("a") != F.col("b")) | (F.col("na") <= F.col("nb")))
        .withColumn("err", (F.col("err") + F.bit_count(F.col("na").bitwiseXOR(F.col("nb")))
                            - F.bit_count(F.col("a").bitwiseXOR(F.col("b")))).cast("int"))
        .where(F.col("err") <= max_bits)
        .select("block", F.col("na").alias("a"), F.col("nb").alias("b"), "err",
                ((F.col("n_a") <= node_rows) & (F.col("n_b") <= node_rows) | (F.col("deep") >= 64)).alias("small")))


def _deal(done: DataFrame, hot: DataFrame, deep: Column, side: int) -> DataFrame:
    """Fingerprints of the nodes on one side of finished node pairs; a pair of a node with itself gets them once."""
    end = ("a", "b")[side]
    nodes = done if side == 0 else done.where("a <> b")
    rows = hot.withColumn("depth", deep).withColumn(end, F.expr("shiftrightunsigned(code, 64 - depth)"))
    return rows.join(nodes, ["block", end]).select(
        "block", F.col("a").alias("node_a"), F.col("b").alias("node_b"), "depth", F.lit(side).alias("side"), "fp", "code")


def _walk(rows: DataFrame, max_bits: int, most: int = 1 << 20) -> DataFrame:
    """Walk the node pairs of a partition, about ``most`` rows at a time; rows of one node pair are neighbours there."""
    names = ("block", "depth", "node_a", "node_b", "side", "fp", "code")

    def walk(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        got = {c: pa.concat_tables(parts).column(c).to_numpy() for c in names}
        code = got["code"].view(np.uint64)
        order = np.lexsort((code, *(got[c] for c in reversed(names[:5]))))
        pairs = _runs([got[c][order] for c in names[:4]], got["side"][order])
        for a, b in forest(code[order], got["fp"][order], pairs, max_bits):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch]).select(names)
            held.append(part)
            n += part.num_rows
            if n >= most:
                whole = pa.concat_tables(held)
                keys = [whole.column(c).to_numpy() for c in names[:4]]
                # the last node pair may go on in the next batch
                cut = int(np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))[-1:].sum() + 1)
                if any((k[0] != k[-1]) for k in keys):
                    yield from walk([whole.slice(0, cut)])
                    held, n = [whole.slice(cut)], whole.num_rows - cut
        if held:
            yield from walk(held)

    keys = ("block", "depth", "node_a", "node_b")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def _runs(keys: list[np.ndarray], side: np.ndarray) -> tuple[np.ndarray, ...]:
    """Node pairs as ranges of the sorted rows: (a from, a to, b from, b to); b is a where a node meets itself."""
    n = len(side)
    new = np.ones(n, dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], n)
    cum = np.concatenate(([0], np.cumsum(side)))
    middle = stops - (cum[stops] - cum[starts])
    two = keys[2][starts] != keys[3][starts]
    found = ~two | ((middle > starts) & (middle < stops))
    return tuple(x[found] for x in (starts, np.where(two, middle, stops), np.where(two, middle, starts), stops))


def forest(code: np.ndarray, fp: np.ndarray, pairs: tuple[np.ndarray, ...], max_bits: int,
           leaf: int = 256, width: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that span the close pairs among the node pairs. ``code`` is sorted inside each range.

    The walk keeps a stack of blocks of node pairs, so memory is bounded by ``width`` pairs a level. A node pair whose
    leaves are already linked with each other is not opened.
    """
    n = len(code)
    label = np.arange(n)
    # differing bits are counted from the top again, also those above the nodes
    stack = [(0, (*(np.asarray(p, dtype=np.int64) for p in pairs), np.zeros(len(pairs[0]), dtype=np.int64)))]
    zeros: dict[int, np.ndarray] = {}
    while stack:
        bit, (a0, a1, b0, b1, err) = stack.pop()
        if len(a0) > width:
            half = len(a0) // 2
            stack += [(bit, tuple(x[half:] for x in (a0, a1, b0, b1, err))), (bit, tuple(x[:half] for x in (a0, a1, b0, b1, err)))]
            continue
        area = (a1 - a0) * (b1 - b0)
        small = (area <= leaf) | (bit >= 64)
        if small.any():
            _leaves(code, label, *(x[small] for x in (a0, a1, b0, b1)), max_bits)
        big = ~small
        if big.any():
            a0, a1, b0, b1, err = (x[big] for x in (a0, a1, b0, b1, err))
            keep = ~_linked(label, a0, a1, b0, b1)
            a0, a1, b0, b1, err = (x[keep] for x in (a0, a1, b0, b1, err))
        if not big.any() or not len(a0):
            continue
        if bit not in zeros:
            zeros[bit] = np.concatenate(([0], np.cumsum(((code >> np.uint64(63 - bit)) & np.uint64(1)) == 0)))
        z = zeros[bit]
        am, bm = a0 + z[a1] - z[a0], b0 + z[b1] - z[b0]
        same = a0 == b0
        children = [(a0, am, b0, bm, err), (am, a1, bm, b1, err), (a0, am, bm, b1, err + 1),
                    tuple(x[~same] for x in (am, a1, b0, bm, err + 1))]
        joined = tuple(np.concatenate(x) for x in zip(*children))
        alive = (joined[1] > joined[0]) & (joined[3] > joined[2]) & (joined[4] <= max_bits)
        if alive.any():
            stack.append((bit + 1, tuple(x[alive] for x in joined)))
    moved = np.flatnonzero(fp[label] != fp)
    if len(moved):
        yield fp[moved], fp[label[moved]]


def _linked(label: np.ndarray, a0, a1, b0, b1) -> np.ndarray:
    """Whether all leaves of both nodes have one label."""
    change = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
    flat = lambda lo, hi: change[hi - 1] == change[lo]
    return flat(a0, a1) & flat(b0, b1) & (label[a0] == label[b0])


def _leaves(code, label, a0, a1, b0, b1, max_bits: int, most: int = 1 << 20) -> None:
    """Compare the leaves of small node pairs and merge the labels of close ones, ``most`` comparisons at a time."""
    area = (a1 - a0) * (b1 - b0)
    ends = np.cumsum(area)
    low = 0
    while low < len(area):
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + most, side="right")))
        part = slice(low, high)
        of = np.repeat(np.arange(low, high), area[part])
        k = np.arange(len(of)) - np.repeat(ends[part] - area[part] - base, area[part])
        wide = (b1 - b0)[of]
        x, y = a0[of] + k // wide, b0[of] + k % wide
        close = (x != y) & (label[x] != label[y])
        x, y = x[close], y[close]
        close = np.bitwise_count(code[x] ^ code[y]) <= max_bits
        _merge(label, x[close], y[close])
        low = high


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give every connected set of rows its smallest label; labels point at roots before and after."""
    while len(x):
        lx, ly = label[x], label[y]
        apart = lx != ly
        if not apart.any():
            return
        x, y, lx, ly = x[apart], y[apart], lx[apart], ly[apart]
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``max_bits`` differing bits. NULL and empty
    texts share fingerprint 0; repeated rows are repeated; a NULL doc_id keeps its row and gets its class's id (NULL
    where the class has no other). Other columns are ignored.
    """
    marked = freeze(fingerprints(docs, shingle))
    classes = freeze(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    edges = freeze(node_pairs(classes.select("fp"), max_bits, node_rows))
    found = components(edges)
    linked = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    linked = freeze(linked)
    lowest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = linked.join(lowest, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all columns: the one with the smallest doc_id, then the smallest SHA-256 of its text.

    Rows are told apart by doc_id and text. Those that share a doc_id but not their text are judged each by its own text;
    rows without a doc_id come after all others; of rows with one doc_id and one text a single one stays.
    """
    text = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    own = docs.withColumn("__text", text)
    # in the order of the fields; a NULL doc_id sorts behind
    ident = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col("__text").alias("text"))
    found = near_duplicates(own.select(ident.alias("doc_id"), "text"), shingle, max_bits)
    first = found.where("doc_id = component_id").select("doc_id.*").distinct()
    same = own["doc_id"].eqNullSafe(first["id"]) & (own["__text"] == first["text"])
    return own.join(first, same, "left_semi").dropDuplicates(["doc_id", "__text"]).drop("__text")


by_value(__name__)
