"""Token counts of sections: whole texts are encoded once and tokens are given to sections by their spans.

A section is a line of the text with the line feed that ends it. A token that crosses a boundary belongs to the
section that holds most of its bytes, the earlier one of equals. So the counts of a text's sections add up to the
count of its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitaspan.llm.common import by_value


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Byte-level BPE with the byte length of every id."""

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)


def line_ends(raw: bytes) -> np.ndarray:
    """Where the lines of a text end (after their line feeds); the last end is the text's."""
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    return ends if len(ends) and ends[-1] == len(raw) or not raw else np.append(ends, len(raw))


def attribute(sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Section of every token, from the tokens' sizes and the sections' ends: an interval join of two sorted lists."""
    stops = np.cumsum(sizes)
    starts = stops - sizes
    first = np.searchsorted(ends, starts, side="right")
    last = np.searchsorted(ends, stops, side="left")
    best, most = first.copy(), np.minimum(stops, ends[first]) - starts
    # most tokens lie in one section; the loop runs as often as the widest token crosses boundaries
    at = first
    while (more := np.flatnonzero(at < last)).size:
        at = np.minimum(at + 1, last)
        share = np.minimum(stops[more], ends[at[more]]) - ends[at[more] - 1]
        better = share > most[more]
        best[more[better]], most[more[better]] = at[more[better]], share[better]
    return best


def count_sections(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, section (from 0), start_byte, end_byte, n_tokens per section of every row of ``docs``.

    NULL and empty texts have one section without tokens. Repeated rows are repeated; other columns are ignored.
    """
    given = vocabulary
    state: dict[str, Encoder] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "encoder" not in state:
            state["encoder"] = Encoder(given or default_vocabulary())
        encoder = state["encoder"]
        for batch in batches:
            rows, sections, starts, stops, counts, held = [], [], [], [], [], 0
            ids = batch.column("doc_id")
            for k, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                tokens = np.array(encoder.encode(text), dtype=np.int64)
                ends = line_ends(text.encode()) if text else np.zeros(1, dtype=np.int64)
                of = attribute(encoder.sizes[tokens], ends) if len(tokens) else tokens
                rows.append(np.full(len(ends), k))
                sections.append(np.arange(len(ends)))
                starts.append(np.append(0, ends[:-1]))
                stops.append(ends)
                counts.append(np.bincount(of, minlength=len(ends)))
                held += len(ends)
                if held > 100_000:
                    yield _rows(ids, rows, sections, starts, stops, counts)
                    rows, sections, starts, stops, counts, held = [], [], [], [], [], 0
            if rows:
                yield _rows(ids, rows, sections, starts, stops, counts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, section long, start_byte long, end_byte long, n_tokens long")


def _rows(ids: pa.Array, rows, *columns) -> pa.RecordBatch:
    data = [ids.take(pa.array(np.concatenate(rows)))] + [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(data, names=["doc_id", "section", "start_byte", "end_byte", "n_tokens"])


by_value(__name__)
