"""Tail probabilities. The inputs are finished test statistics (a handful of rows per table), so these
are Arrow-batched pandas UDFs around small closed-form helpers; no data row passes through them."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# the helpers travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chi_square_tail(x: float, df: int) -> float:
    """P(X >= x) for a chi-square variable with integer degrees of freedom, by its finite sum."""
    if x is None or df is None or math.isnan(x) or df < 1:
        return float("nan")
    if x <= 0:
        return 1.0
    half = x / 2.0
    if df % 2 == 0:
        term, total = math.exp(-half), 0.0
        for i in range(df // 2):
            total += term
            term *= half / (i + 1)
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range((df - 1) // 2):
        total += term
        term *= half / (i + 1.5)
    return min(1.0, total)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def fisher_two_by_two(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact test of a 2x2 table: total probability of tables no likelier than the given one."""
    row, rest, column = a + b, c + d, a + c
    low, high = max(0, column - rest), min(row, column)
    # ratios between neighbouring tables give every probability relative to the first one
    k = np.arange(low, high, dtype=float)
    steps = np.log((row - k) * (column - k)) - np.log((k + 1) * (rest - column + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    logs -= logs.max()
    weight = np.exp(logs)
    seen = weight[a - low]
    return float(min(1.0, weight[weight <= seen * (1 + 1e-7)].sum() / weight.sum()))


#: Largest number whose log-factorials are tabulated.
_TABULATED = 1_000_000


def _log_factorial(n: int):
    """Log-factorial of numbers up to ``n``."""
    if n > _TABULATED:
        each = np.frompyfunc(lambda x: math.lgamma(x + 1), 1, 1)
        return lambda x: np.asarray(each(x), dtype=np.float64)
    table = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    return lambda x: table[x]


def _splits(total: int, room: tuple[int, ...], most: int) -> np.ndarray | None:
    """All ways to deal ``total`` over cells that hold at most ``room``, one per row; None if they are more than ``most``."""
    dealt = np.zeros((1, 0), dtype=np.int64)
    left = np.array([total])
    behind = sum(room)
    for r in room:
        behind -= r
        low, high = np.maximum(0, left - behind), np.minimum(r, left)
        n = high - low + 1
        if n.sum() > most:
            return None
        at = np.repeat(np.arange(len(left)), n)
        x = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[at]
        dealt, left = np.column_stack([dealt[at], x]), left[at] - x
    return dealt


def fisher_exact(table: list[list[int]], most: int = 50_000_000) -> float | None:
    """Two-sided exact test of a table of any shape: total probability of the tables with its margins that are no likelier.

    The tables are walked column by column. A stage's nodes are what is left of the row margins, in order of size, as rows can
    change places; a node keeps the different products of the paths that lead to it, with the number of those paths. A
    path leaves the walk as soon as its best completion is unlikely enough (then all its completions count, and their sum is
    known) or its worst one is too likely. NULL when a stage has more than ``most`` products; the walk has no end then.
    """
    cells = np.array([r for r in table if sum(r)], dtype=np.int64)
    cells = cells[:, cells.sum(axis=0) > 0] if len(cells) else cells.reshape(0, 0)
    if min(cells.shape) < 2:
        return 1.0
    if cells.shape[0] > cells.shape[1]:
        cells = cells.T
    if cells.shape == (2, 2):
        return fisher_two_by_two(*cells.ravel().tolist())
    cells = cells[:, np.argsort(-cells.sum(axis=0), kind="stable")]
    rows, columns = cells.sum(axis=1), cells.sum(axis=0).tolist()
    log = _log_factorial(int(cells.sum()))
    even = lambda n, k: -(n % k) * float(log(n // k + 1 if n % k else 0)) - (k - n % k) * float(log(n // k))
    total = float(log(int(cells.sum())))
    given = -log(cells).sum() + max(1e-7, 1e-14 * total)
    scale = log(rows).sum() + log(np.array(columns)).sum() - total
    nodes = {tuple(sorted(rows.tolist())): (np.zeros(1), np.ones(1))}
    chance, work = 0.0, 0
    for j, column in enumerate(columns):
        rest = columns[j + 1:]
        ahead: dict[tuple[int, ...], list[tuple[np.ndarray, np.ndarray]]] = {}
        for room, (values, paths) in nodes.items():
            dealt = _splits(column, room, most // 10)
            if dealt is None:
                return None
            left = np.sort(np.array(room) - dealt, axis=1)
            steps = -log(dealt).sum(axis=1)
            # ways with the same step to the same node are taken together
            kinds, which, ways = np.unique(np.column_stack([left, np.round(steps * 1e9).astype(np.int64)]), axis=0, return_index=True, return_counts=True)
            # a row of the table of steps costs about as much as a hundred products
            work += len(kinds) * (100 + len(values)) + len(dealt)
            if work > most:
                return None
            for kind, at, n in zip(kinds[:, :-1].tolist(), which.tolist(), ways.tolist()):
                ahead.setdefault(tuple(kind), []).append((values + steps[at], paths * n))
        nodes = {}
        for room, parts in ahead.items():
            values, paths = (np.concatenate(x) for x in zip(*parts))
            key, at, back = np.unique(np.round(values * 1e9).astype(np.int64), return_index=True, return_inverse=True)
            values, paths = values[at], np.bincount(back, paths)
            every = best = worst = 0.0
            if rest:
                by_row, by_column = log(np.array(room)).sum(), log(np.array(rest)).sum()
                every = float(log(sum(room))) - by_row - by_column
                best = min(sum(even(c, len(room)) for c in rest), sum(even(r, len(rest)) for r in room))
                worst = max(-by_row, -by_column)
            done = values + best <= given
            chance += float((paths[done] * np.exp(values[done] + every + scale)).sum())
            open_ = ~done & (values + worst <= given)
            if open_.any():
                nodes[room] = values[open_], paths[open_]
    return min(1.0, chance)


def rank_sum_exact(u: float, m: int, n: int) -> float:
    """Two-sided exact tail of the two-sample rank statistic ``U`` without ties."""
    ways = np.zeros(m * n + 1)
    ways[0] = 1.0
    for i in range(1, m + 1):
        # multiply by (1 - q^(n+i)) / (1 - q^i): Gaussian binomial coefficient, one factor per step
        up = ways.copy()
        if n + i <= m * n:
            up[n + i:] -= ways[: m * n + 1 - (n + i)]
        for start in range(i):
            up[start::i] = np.cumsum(up[start::i])
        ways = up
    share = ways / ways.sum()
    if u > m * n / 2:
        tail = share[int(math.ceil(u - 1e-9)):].sum()
    else:
        tail = share[: int(math.floor(u + 1e-9)) + 1].sum()
    return float(min(1.0, 2 * tail))


@F.pandas_udf(DoubleType())
def _chi(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) or b < 1 else chi_square_tail(float(a), int(b))
                      for a, b in zip(x, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def _fisher(tables: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else fisher_exact([list(map(int, r)) for r in t]) for t in tables], dtype="float64")


@F.pandas_udf(DoubleType())
def _normal(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else normal_two_sided(float(v))).astype("float64")


@F.pandas_udf(DoubleType())
def _exact_ranks(u: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) or pd.isna(c) else rank_sum_exact(float(a), int(b), int(c))
                      for a, b, c in zip(u, m, n)], dtype="float64")


def chi_square_p(x: Column, df: Column) -> Column:
    return _chi(x.cast("double"), df.cast("int"))


def fisher_p(table: Column) -> Column:
    """Exact p-value of a table given as an array of rows; NULL for no table, or one too large for the exact test."""
    return _fisher(table)


def normal_p(z: Column) -> Column:
    return _normal(z.cast("double"))


def rank_sum_exact_p(u: Column, m: Column, n: Column) -> Column:
    return _exact_ranks(u.cast("double"), m.cast("int"), n.cast("int"))


@F.pandas_udf(DoubleType())
def quadratic_form(size: pd.Series, diff: pd.Series, var: pd.Series) -> pd.Series:
    """(O-E)' V^-1 (O-E) over all present groups but the last; one small solve per slice."""
    out = []
    for s, z, v in zip(size, diff, var):
        s, z = np.asarray(s, float), np.asarray(z, float)
        use = np.flatnonzero(s > 0)[:-1]
        v = np.asarray(v, float).reshape(len(s), len(s))[np.ix_(use, use)]
        out.append(float(z[use] @ np.linalg.pinv(v) @ z[use]) if len(use) else None)
    return pd.Series(out, dtype="float64")
