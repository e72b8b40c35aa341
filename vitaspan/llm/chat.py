"""Chat formatting: speakers of transcripts by a hidden Markov model, then canonical turns.

Every line of a conversation is an observation: a speaker marker at its start, the role its row names, and features
of its text. States are the roles. Viterbi finds the likeliest path over all lines of a conversation, markers are cut
off, and the lines between two changes are rendered as one turn.

A conversation of any length is decoded in pieces: each piece gives the best score from every state at its start to
every state at its end; chaining those tables fixes the states at the cuts, and each piece is then decoded between
them. Only the tables of conversations that cross a cut meet in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import by_value
from vitaspan.session import freeze

ROLES = ("system", "user", "assistant", "tool")
#: Names of speakers in markers and role columns.
NAMES = {
    "system": "system", "sys": "system", "developer": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user", "prompt": "user", "prompter": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "chatbot": "assistant", "model": "assistant",
    "gpt": "assistant", "answer": "assistant", "a": "assistant", "agent": "assistant", "response": "assistant",
    "tool": "tool", "function": "tool", "observation": "tool", "ipython": "tool",
}
_ALTERNATIVES = "|".join(sorted(NAMES, key=lambda n: (-len(n), n)))
_MARKER = re.compile(rf"\s*(?:<\|(?:im_start\|>|start_header_id\|>)?\s*({_ALTERNATIVES})\s*(?:<?\|(?:end_header_id\|)?>)?"
                     rf"|[#>*\[(\s]*({_ALTERNATIVES})[\])*\s]*:[*]*(?=\s|$)|\[({_ALTERNATIVES})\]|#{{2,}}\s*({_ALTERNATIVES})\s*$)[ \t]*", re.I)
_ENDING = re.compile(r"\s*<\|(?:im_end|eot_id|end|endoftext)\|>\s*$")

#: Natural logs of the model, for the roles in order. Start of a conversation; change at the start of a row; change
#: inside a row, at a line with and without a marker.
START = np.log([0.30, 0.60, 0.08, 0.02])
AT_ROW = np.log([[0.10, 0.80, 0.09, 0.01], [0.01, 0.10, 0.85, 0.04], [0.01, 0.80, 0.12, 0.07], [0.01, 0.14, 0.80, 0.05]])
AT_MARKER = AT_ROW
INSIDE = np.log(np.full((4, 4), 0.002) + np.eye(4) * 0.992)
#: What a marker or the row's role says when another role speaks.
MARKER_RIGHT, MARKER_WRONG = np.log(0.985), np.log(0.005)
NAMED_RIGHT, NAMED_WRONG = np.log(0.94), np.log(0.02)
#: Log ratios of line features: ends with a question mark, is a list item or code, is an imperative preamble.
QUESTION = np.array([-0.3, 0.5, -0.3, -0.5])
LISTED = np.array([0.0, -0.4, 0.5, 0.2])
PREAMBLE = np.array([1.2, -0.4, -0.6, -0.8])
_LISTED = re.compile(r"\s*(?:[-*•]|\d+[.)])\s|\s*```|\s{4,}\S")
_PREAMBLE = re.compile(r"\s*you are (?:a|an|the)\b", re.I)


def role_of(name: str | None) -> int:
    """Number of the role a name stands for, or -1."""
    known = NAMES.get((name or "").strip().lower())
    return ROLES.index(known) if known else -1


class Lines:
    """Lines of one row: emissions, transition kinds (0 inside, 1 marker) and texts without markers."""

    def __init__(self, text: str | None, role: str | None):
        named = role_of(role)
        scores, kinds, texts = [], [], []
        for k, line in enumerate((text or "").split("\n")):
            score = np.zeros(4)
            match = _MARKER.match(line)
            if match:
                said = role_of(next(g for g in match.groups() if g))
                score += MARKER_WRONG
                score[said] += MARKER_RIGHT - MARKER_WRONG
                line = line[match.end():]
            if k == 0 and named >= 0:
                score += NAMED_WRONG
                score[named] += NAMED_RIGHT - NAMED_WRONG
            line = _ENDING.sub("", line)
            if line.rstrip().endswith("?"):
                score += QUESTION
            if _LISTED.match(line):
                score += LISTED
            if _PREAMBLE.match(line):
                score += PREAMBLE
            scores.append(score)
            kinds.append(1 if match else 0)
            texts.append(line)
        self.scores, self.kinds, self.texts = np.array(scores), kinds, texts

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(transition, emission) of each line; the first line of a row is a row start."""
        for k, score in enumerate(self.scores):
            yield (AT_ROW if k == 0 else AT_MARKER if self.kinds[k] else INSIDE), score


def table_of(rows: list[Lines], first: bool) -> np.ndarray:
    """Best score from the state before the rows (rows of the table) to the state at their end.

    ``first``: the rows begin a conversation, so all states before count alike and START takes the first change's place.
    """
    best = np.zeros((4, 4)) if first else np.where(np.eye(4) > 0, 0.0, -np.inf)
    for i, row in enumerate(rows):
        for k, (change, score) in enumerate(row.steps()):
            if first and i == k == 0:
                best = np.tile(START + score, (4, 1))
            else:
                best = (best[:, :, None] + change[None]).max(axis=1) + score
    return best


def decode(rows: list[Lines], before: int | None, after: int | None) -> list[np.ndarray]:
    """Likeliest states of every row's lines, given the state before (None: a conversation begins) and at the end."""
    if not rows:
        return []
    best, back = None, []
    for row in rows:
        for change, score in row.steps():
            if best is None:
                best = (START if before is None else change[before]) + score
                back.append(np.zeros(4, dtype=np.int64))
            else:
                reach = best[:, None] + change
                back.append(reach.argmax(axis=0))
                best = reach.max(axis=0) + score
    state = int(best.argmax()) if after is None else after
    path = [state]
    for step in reversed(back[1:]):
        state = int(step[state])
        path.append(state)
    path = np.array(path[::-1])
    cuts = np.cumsum([len(r.texts) for r in rows])
    return np.split(path, cuts[:-1])


def render(role: str, text: str) -> str:
    """The canonical form of a turn; its own control signs are escaped in the text."""
    return f"<|{role}|>\n" + text.replace("<|", "<\\|") + "\n<|end|>\n"


def turns_of(lines: Lines, states: np.ndarray) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns within one row: a change of role or a marker begins a turn."""
    start = 0
    for k in range(1, len(states) + 1):
        if k == len(states) or states[k] != states[k - 1] or lines.kinds[k]:
            text = "\n".join(lines.texts[start:k]).strip()
            if text or k - start == len(states):
                yield ROLES[states[start]], text
            start = k


def format_chats(conversations: DataFrame, piece_rows: int = 20_000) -> DataFrame:
    """conv_id, turn, part, role, text, rendered: the turns of every row, numbered by ``part`` inside the row.

    Rows of a conversation follow ``turn`` (NULL first); rows with equal turns follow a hash of role and text. Rows
    without conv_id are conversations of their own. NULL and empty texts give one turn without text. Other columns
    are ignored. Rendered turns in the order of (turn, part) make up the transcript.
    """
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"), "text")
    n = max(1, -(-rows.count() // piece_rows))
    # the row's own number only deals out repeated rows
    rows = rows.withColumn("tie", F.xxhash64("role", "text")).withColumn("row", F.monotonically_increasing_id())
    dealt = freeze(rows.repartitionByRange(n, "conv_id", "turn", "tie", "row").withColumn("piece", F.spark_partition_id()))
    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def ordered(group: pa.Table) -> pa.Table:
        return group.sort_by([(c, "ascending") for c in ("conv_id", "turn", "tie", "row")]) if group.num_rows else group

    def runs(group: pa.Table) -> Iterator[tuple[object, int, int]]:
        """(conversation, from, to) in order; a row without conversation is one of its own."""
        ids = group.column("conv_id").to_pylist()
        start = 0
        for k in range(1, len(ids) + 1):
            if k == len(ids) or ids[k] is None or ids[k] != ids[k - 1]:
                yield ids[start], start, k
                start = k

    def lines_of(group: pa.Table, start: int, stop: int) -> list[Lines]:
        part = group.slice(start, stop - start)
        return [Lines(t, r) for t, r in zip(part.column("text").to_pylist(), part.column("role").to_pylist())]

    def ends(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """Tables of the first and the last conversation of a piece, which may go on in its neighbours."""
        group = _nulls_first(ordered(group))
        found = list(runs(group))
        out = [found[0]] + ([found[-1]] if len(found) > 1 else [])
        out = [x for x in out if x[0] is not None]
        tables = [[table_of(rows, True).ravel().tolist(), table_of(rows, False).ravel().tolist()]
                  for rows in (lines_of(group, a, b) for _, a, b in out)]
        return pa.table({"conv_id": pa.array([x[0] for x in out], group.schema.field("conv_id").type),
                         "piece": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "begin": pa.array([t[0] for t in tables], pa.list_(pa.float64())),
                         "go_on": pa.array([t[1] for t in tables], pa.list_(pa.float64()))})

    def chain(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """States before and at the end of each part of a conversation that lies in several pieces."""
        group = group.sort_by("piece")
        begin, go_on = (np.array(group.column(c).to_pylist()).reshape(-1, 4, 4) for c in ("begin", "go_on"))
        k = group.num_rows
        best, back = [begin[0][0]], []
        for t in go_on[1:]:
            reach = best[-1][:, None] + t
            back.append(reach.argmax(axis=0))
            best.append(reach.max(axis=0))
        after = [int(best[-1].argmax())]
        for step in reversed(back):
            after.append(int(step[after[-1]]))
        after = after[::-1]
        return pa.table({"conv_id": group.column("conv_id"), "piece": group.column("piece"),
                         "before": pa.array([None, *after[:-1]][:k], pa.int32()), "after": pa.array(after, pa.int32())})

    def finish(key: tuple[pa.Scalar, ...], group: pa.Table, bounds: pa.Table) -> pa.Table:
        group = _nulls_first(ordered(group))
        given = {c: (p, q) for c, p, q in zip(*(bounds.column(x).to_pylist() for x in ("conv_id", "before", "after")))}
        turn = group.column("turn").to_pylist()
        out = {c: [] for c in ("conv_id", "turn", "part", "role", "text", "rendered")}
        for conv, a, b in runs(group):
            own = lines_of(group, a, b)
            before, after = given.get(conv, (None, None)) if conv is not None else (None, None)
            for k, (lines, states) in enumerate(zip(own, decode(own, before, after))):
                for part, (role, text) in enumerate(turns_of(lines, states)):
                    for c, x in zip(out, (conv, turn[a + k], part, role, text, render(role, text))):
                        out[c].append(x)
        types = (group.schema.field("conv_id").type, group.schema.field("turn").type, pa.int32(), pa.string(), pa.string(), pa.string())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    cut = dealt.groupBy("piece").applyInArrow(ends, f"conv_id {kinds['conv_id']}, piece int, begin array<double>, go_on array<double>")
    bounds = cut.groupBy("conv_id").applyInArrow(chain, f"conv_id {kinds['conv_id']}, piece int, before int, after int")
    return dealt.groupBy("piece").cogroup(bounds.groupBy("piece")).applyInArrow(
        finish, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, part int, role string, text string, rendered string")


def _nulls_first(group: pa.Table) -> pa.Table:
    """Rows without a turn before the others of their conversation (a sort puts them last)."""
    turn, conv = group.column("turn"), group.column("conv_id")
    if not turn.null_count:
        return group
    flags = pa.compute.is_valid(turn).to_numpy()
    ids = conv.to_pylist()
    starts, order = 0, []
    for k in range(1, len(ids) + 1):
        if k == len(ids) or ids[k] != ids[k - 1]:
            span = np.arange(starts, k)
            order.append(np.concatenate([span[~flags[starts:k]], span[flags[starts:k]]]))
            starts = k
    return group.take(pa.array(np.concatenate(order)))


by_value(__name__)
