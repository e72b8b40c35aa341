"""Fill-in-the-middle: whole texts are cut into prefix, middle and suffix at unit ends and reordered.

A unit is a word with the white space in front of it; white space at the end of a text is a unit of its own. Texts are
handled as UTF-8, eight bytes to an unsigned word: arithmetic on a word marks the bytes that end a unit, the running
counts of marks are searched for the word that holds the k-th one, and its place inside that word is read off the marks'
prefix sums. No text is decoded or split.

Every document draws four numbers from SHA-256 of ``seed:doc_id``, so a result depends on nothing but id, text and
parameters. Rows: NULL texts count as empty, a NULL id as empty text in the draw; repeated rows give repeated results; an
empty table gives an empty one; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import by_value

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_U = np.uint64
_EACH = 0x0101010101010101
_LOW, _HIGH = _U(_EACH * 0x7F), _U(_EACH * 0x80)
_ONES, _SPACES = _U(_EACH), _U(_EACH * 0x20)
_TOP = _U(56)


def _white(w: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a blank or one of the bytes 9 to 13. No sum carries into the next byte."""
    low = w & _LOW
    control = (low + _U(_EACH * (0x80 - 9))) & ~(low + _U(_EACH * (0x80 - 14)))
    other = w ^ _SPACES
    blank = ~(((other & _LOW) + _LOW) | other)
    return ((control & ~w) | blank) & _HIGH


class Units:
    """Unit ends and code points of one text."""

    def __init__(self, raw: bytes):
        self.size = len(raw)
        words = np.frombuffer(raw + b" " * (8 - len(raw) % 8), dtype="<u8")
        white = _white(words)
        behind = white >> _U(8)
        behind[:-1] |= white[1:] << _TOP
        behind[-1] |= _U(0x80) << _TOP
        ends = ~white & behind
        if raw and white[(self.size - 1) // 8] >> _U(8 * ((self.size - 1) % 8)) & _U(0x80):
            ends[(self.size - 1) // 8] |= _U(0x80) << _U(8 * ((self.size - 1) % 8))
        self.ends = ends
        self.before = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
        #: bytes that begin a code point: all but 10xxxxxx
        self.starts = (~words | (words << _U(1))) & _HIGH

    def __len__(self) -> int:
        return int(self.before[-1])

    def end(self, k: int) -> int:
        """Byte at which the first ``k`` units end."""
        if k == 0:
            return 0
        at = int(np.searchsorted(self.before, k))
        rank = k - (int(self.before[at - 1]) if at else 0)
        with np.errstate(over="ignore"):
            sums = (self.ends[at] >> _U(7)) * _ONES
            reached = ((sums | _HIGH) - _U(rank) * _ONES) & _HIGH
        return 8 * at + 9 - int(np.bitwise_count(reached))

    def chars(self, start: int, stop: int) -> int:
        """Code points that begin in the bytes ``start`` to ``stop``."""
        return self._chars_before(stop) - self._chars_before(start)

    def _chars_before(self, stop: int) -> int:
        whole, rest = divmod(stop, 8)
        n = int(np.bitwise_count(self.starts[:whole]).sum(dtype=np.int64))
        return n + (int(np.bitwise_count(self.starts[whole] & _U((1 << 8 * rest) - 1))) if rest else 0)


def draws(doc_id, seed: int) -> list[int]:
    """The first four 8-digit groups of SHA-256 of ``seed:doc_id`` as numbers."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def arrange(raw: bytes, doc_id, seed: int = 42, rate: int = 50, spm: int = 80) -> tuple:
    """(units, form, code points of prefix and middle, output) of one text."""
    units = Units(raw)
    n = len(units)
    a, b, form, order = draws(doc_id, seed)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not raw or form % 100 >= rate or any(m in raw for m in marks):
        return n, "plain", None, None, raw
    first, second = (units.end(k) for k in sorted((a % (n + 1), b % (n + 1))))
    prefix, middle, suffix = (m + part for m, part in zip((marks[0], marks[2], marks[1]), (raw[:first], raw[first:second], raw[second:])))
    sizes = units.chars(0, first), units.chars(first, second)
    if order % 100 < spm:
        return n, "spm", *sizes, suffix + prefix + middle
    return n, "psm", *sizes, prefix + suffix + middle


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output of every row of ``docs``.

    ``rate`` percent of the texts are cut, ``spm`` percent of those put the suffix first; the others, empty texts and
    texts that hold a mark already stay ``plain``, with NULL for the two sizes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("raw")
            # a few texts at a time, so that long ones do not pile up
            for low in range(0, len(batch), 256):
                some = ids.slice(low, 256)
                made = [arrange(t or b"", i, seed, rate, spm) for i, t in zip(some.to_pylist(), texts.slice(low, 256).to_pylist())]
                yield pa.RecordBatch.from_arrays([some, *[pa.array(c, t) for c, t in zip(zip(*made), types)]],
                                                 names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", F.col("text").cast("binary").alias("raw")).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. A cut text held no mark, and none can arise where two parts meet."""
    def between(start: str, stop: str | None) -> Column:
        rest = F.substring_index(output, start, -1)
        return rest if stop is None else F.substring_index(rest, stop, 1)

    middle = between(MIDDLE, None)
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))).otherwise(output))


by_value(__name__)
