"""Proportional-hazards regression by Newton steps over a frozen layout in order of time.

The rows are collapsed once to ``(slice, time, event, covariates) -> n`` and frozen in time ranges, as many as they have
rows for. Nothing of that layout moves again: every model (univariable ones, slices of a cohort) reads the same
ranges, a task builds the design columns of a model from a range's covariates, and only sums of a range leave the task.

A step is two passes. The first sums the weights of each range, and those of its first and last time apart, as such a time may
go on in the next range. Added up from the end they are what each range's risk sets hold of later ranges. The second
pass adds what lies inside the range to that and sums up gradient and information. The driver holds some
(coefficients + 1)^2 numbers for each range, model and slice.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaspan.functions.pvalues import normal_two_sided
from vitaspan.functions.scalars import col
from vitaspan.functions.ties import tied_sums
from vitaspan.operators.survival import Z95
from vitaspan.session import freeze, freeze_ranges

# the helpers travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOLERANCE = 1e-9
#: Collapsed rows of a time range, which one task holds at once.
RANGE_ROWS = 250_000


# --- design ----------------------------------------------------------------------------------------

@dataclass
class _Slot:
    """One design column: a number, or the indicator of one level."""

    term: str
    level: object = None


@dataclass
class _Fit:
    """State of one (slice, model) on the driver; everything has the size of its coefficients."""

    slots: list[_Slot]
    mean: np.ndarray
    count: np.ndarray
    events: np.ndarray
    n: int
    n_event: int
    active: list[int] = field(default_factory=list)
    beta: np.ndarray | None = None
    trial: np.ndarray | None = None
    loglik: float | None = None
    null_loglik: float | None = None
    score: float | None = None
    information: np.ndarray | None = None
    steps: int = 0
    done: bool = False
    converged: bool = False


def _slots(df: DataFrame, terms: Sequence[str], levels: Mapping[str, Sequence] | None,
           categorical: Sequence[str]) -> dict[str, list[_Slot]]:
    types = dict(df.dtypes)
    given = levels or {}
    read = [t for t in terms if t not in given and (t in categorical or types[t] in ("string", "boolean"))]
    # the levels of all terms in one job
    seen = df.agg(*[F.array_sort(F.collect_set(col(t))).alias(f"l{i}") for i, t in enumerate(read)]).first() if read else ()
    found = {**{t: list(v) for t, v in given.items()}, **dict(zip(read, seen))}
    out = {}
    for t in terms:
        if t in found:
            out[t] = [_Slot(t, v) for v in found[t]]
        else:
            out[t] = [_Slot(t)]
    return out


def _layout(df: DataFrame, time: str, event: str, slots: Mapping[str, list[_Slot]], slice: Sequence[str],
            range_rows: int) -> tuple[DataFrame, list[tuple]]:
    """Frozen rows ``sid, time, event, c0.., n, piece`` in order of time, and the slices that ``sid`` numbers.

    A categorical covariate is the place of its level among the known ones; NULL stands for any other value.
    """
    names = [f"slice{i}" for i in range(len(slice))]
    covariates = []
    for i, (t, levels) in enumerate(slots.items()):
        value = col(t).cast("double")
        if levels[0].level is not None:
            place = F.when(col(t) == F.lit(levels[0].level), F.lit(0.0))
            for j, s in enumerate(levels[1:], 1):
                place = place.when(col(t) == F.lit(s.level), F.lit(float(j)))
            value = place
        covariates.append(value.alias(f"c{i}"))
    base = df.select(*[col(s).cast("string").alias(n) for s, n in zip(slice, names)], col(time).cast("double").alias("time"),
                     col(event).cast("int").alias("event"), *covariates).dropna(subset=[*names, "time", "event"])
    rows = freeze(base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("n")))
    slices = [()]
    if slice:
        slices = sorted(tuple(r) for r in rows.select(*names).distinct().collect())
        known = df.sparkSession.createDataFrame([(*s, i) for i, s in enumerate(slices)], T.StructType(
            [T.StructField(n, T.StringType()) for n in names] + [T.StructField("sid", T.IntegerType())]))
        rows = rows.join(known, names).drop(*names)
    else:
        rows = rows.withColumn("sid", F.lit(0))
    # a time with many rows may fill several ranges, so the other columns take part in the order
    order = [F.col("time"), F.xxhash64(*rows.columns)]
    return freeze_ranges(rows, order, "piece", max(1, -(-rows.count() // range_rows))), slices


# --- inside a range --------------------------------------------------------------------------------
#
# With weights w = n exp(eta), per event time s let S0, S1 be the sums of w and w z over the risk set, D0, D1
# those over the d tied events, and A, B, C, E, G the sums of 1/a, u/a, 1/a^2, u/a^2, u^2/a^2 with
# a = S0 - u D0 over the ties (A = d/S0, C = d/S0^2, the others 0 without Efron's correction). Then
#   gradient    = sum of z over events - sum over s of (A S1 - B D1)
#   information = sum over s of (A S2 - B D2) - (C S1 S1' - E (S1 D1' + D1 S1') + G D1 D1')
# The sums with A and B are taken over rows instead, where a row counts A of all times up to its own; so no second
# moments per time are needed, and what earlier ranges add to A comes in when the ranges are put together.

@dataclass
class _Range:
    """Rows of one range in order of time."""

    piece: int
    sid: np.ndarray
    time: np.ndarray
    event: np.ndarray
    n: np.ndarray
    covariates: np.ndarray

    def parts(self, designs: list[list[tuple[int, int | None]]], wanted: set[tuple[int, int]] | None = None):
        """(sid, model, places of the complete rows, design) of every slice and model in the range."""
        for sid in np.unique(self.sid).tolist():
            mine = np.flatnonzero(self.sid == sid)
            for m, design in enumerate(designs):
                if wanted is not None and (sid, m) not in wanted:
                    continue
                used = sorted({c for c, _ in design})
                at = mine[~np.isnan(self.covariates[np.ix_(mine, used)]).any(axis=1)]
                if len(at):
                    yield sid, m, at, np.stack([self.covariates[at, c] if level is None else (self.covariates[at, c] == level) * 1.0
                                                for c, level in design], axis=1)


def _ranges(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[_Range]:
    """A file is a range and has one row group, so its rows reach one task, one after the other."""
    held: list[pa.RecordBatch] = []

    def whole() -> _Range:
        t = pa.Table.from_batches(held)
        get = lambda c: t.column(c).to_numpy()
        x = np.stack([get(f"c{i}").astype(np.float64) for i in range(width)], axis=1)
        order = np.argsort(get("time"), kind="stable")
        return _Range(int(get("piece")[0]), get("sid")[order], get("time")[order], get("event")[order], get("n")[order].astype(np.float64), x[order])

    for batch in batches:
        while len(batch):
            piece = batch.column("piece").to_numpy()
            if held and held[0].column("piece")[0].as_py() != piece[0]:
                yield whole()
                held = []
            same = int(np.searchsorted(piece != piece[0], True))
            held.append(batch.slice(0, same))
            batch = batch.slice(same)
    if held:
        yield whole()


def _over_ranges(frozen: DataFrame, width: int, work, columns: dict[str, T.DataType]) -> list[dict]:
    """Rows that ``work`` gives for each range, with the range's number; no row of the layout is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _ranges(batches, width):
            rows = [{"piece": r.piece, **line} for line in work(r)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    fields = {"piece": T.IntegerType(), **columns}
    kinds = {T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.ArrayType: pa.list_(pa.float64())}
    schema = pa.schema([(n, kinds[type(k)]) for n, k in fields.items()])
    out = frozen.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in fields.items()])).toArrow().to_pylist()
    if len({(r["piece"], r["sid"], r["model"]) for r in out}) < len(out):
        raise RuntimeError("a range was read by more than one task")
    return out


_CELLS = T.ArrayType(T.DoubleType())


def _first_look(frozen: DataFrame, designs, width: int) -> list[dict]:
    """Per range, slice and model: first and last time, rows, events, and sums of the design over both."""
    def work(r: _Range):
        for sid, m, at, x in r.parts(designs):
            n, e = r.n[at], r.n[at] * r.event[at]
            yield {"sid": sid, "model": m, "first": r.time[0], "last": r.time[-1], "n": n.sum(), "n_event": e.sum(),
                   "total": n @ x, "events": e @ x}

    return _over_ranges(frozen, width, work, {"sid": T.IntegerType(), "model": T.IntegerType(), **{
        c: T.DoubleType() for c in ("first", "last", "n", "n_event")}, "total": _CELLS, "events": _CELLS})


def _weights(r: _Range, at: np.ndarray, x: np.ndarray, fit: dict):
    """Centred active columns, linear predictor and weight of the rows."""
    z = x[:, fit["active"]] - fit["mean"]
    eta = z @ fit["beta"]
    return z, eta, r.n[at] * np.exp(eta)


def _range_totals(frozen: DataFrame, designs, width: int, fits: dict) -> list[dict]:
    """First pass: weights and weighted columns of the range, and of its first and last time with their events."""
    def work(r: _Range):
        for sid, m, at, x in r.parts(designs, set(fits)):
            with np.errstate(all="ignore"):
                z, eta, w = _weights(r, at, x, fits[sid, m])
                both = np.column_stack([w, w[:, None] * z])
                line = {"sid": sid, "model": m, "total": both.sum(axis=0)}
                for side, t in (("first", r.time[0]), ("last", r.time[-1])):
                    here = r.time[at] == t
                    died = here & (r.event[at] == 1)
                    n = r.n[at][died]
                    line[side] = np.concatenate([both[here].sum(axis=0), both[died].sum(axis=0), [n.sum(), n @ eta[died]]])
                yield line

    return _over_ranges(frozen, width, work, {"sid": T.IntegerType(), "model": T.IntegerType(), "total": _CELLS, "first": _CELLS, "last": _CELLS})


def _range_moments(frozen: DataFrame, designs, width: int, fits: dict, later: dict, efron: bool) -> list[dict]:
    """Second pass. ``later``: per range, slice and model the weights of later ranges and (A, B) of its first and last time."""
    def work(r: _Range):
        for sid, m, at, x in r.parts(designs, set(fits)):
            with np.errstate(all="ignore"):
                z, eta, w = _weights(r, at, x, fits[sid, m])
                carry, edges = later[r.piece, sid, m]
                time, event = r.time[at], r.event[at] == 1
                starts = np.flatnonzero(np.append(True, time[1:] != time[:-1]))
                times, of = time[starts], np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(time))))
                both = np.column_stack([w, w[:, None] * z])
                n = r.n[at] * event
                risk = np.cumsum(np.add.reduceat(both, starts)[::-1], axis=0)[::-1] + carry
                died = np.add.reduceat(both * event[:, None], starts)
                d, predicted = np.add.reduceat(n, starts), np.add.reduceat(n * np.where(event, eta, 0.0), starts)
                inside = (d > 0) & (times > r.time[0]) & (times < r.time[-1])
                sums = np.zeros((len(times), 6))
                sums[inside] = tied_sums(risk[inside, 0], died[inside, 0], d[inside].astype(np.int64), efron)
                loglik = (predicted[inside] - sums[inside, 0]).sum()
                whole, b = sums[:, 1].sum(), sums[:, 2].copy()
                # every row of the range counts its first time, whether or not the fit has rows at it here
                so_far = edges[r.time[0]][0] + np.cumsum(sums[:, 1])
                if r.time[-1] > r.time[0]:
                    so_far[times == r.time[-1]] += edges[r.time[-1]][0]
                for t, (_, second) in edges.items():
                    b[times == t] = second
                share = w * (so_far[of] - event * b[of])
                one = np.column_stack([np.ones(len(z)), z])
                yield {"sid": sid, "model": m, "inside": whole, "loglik": loglik, "local": ((one * share[:, None]).T @ one).ravel(),
                       "all": ((one * w[:, None]).T @ one).ravel(),
                       "tied": _tied_part(risk[inside, 1:], died[inside, 1:], sums[inside]).ravel()}

    return _over_ranges(frozen, width, work, {"sid": T.IntegerType(), "model": T.IntegerType(), "inside": T.DoubleType(), "loglik": T.DoubleType(),
                                              "local": _CELLS, "all": _CELLS, "tied": _CELLS})


def _tied_part(s1: np.ndarray, d1: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Sum over times of C S1 S1' - E (S1 D1' + D1 S1') + G D1 D1'."""
    c, e, g = (sums[:, [i]] for i in (3, 4, 5))
    mixed = (e * s1).T @ d1
    return (c * s1).T @ s1 - mixed - mixed.T + (g * d1).T @ d1


def _start(look: list[dict], slots: list[list[_Slot]]) -> dict[tuple[int, int], _Fit]:
    """Fits before the first step, from the sums of all ranges."""
    sums: dict[tuple[int, int], list] = {}
    for r in look:
        own = sums.setdefault((r["sid"], r["model"]), [0.0, 0.0, 0.0, 0.0])
        for i, c in enumerate(("n", "n_event", "total", "events")):
            own[i] = own[i] + np.array(r[c])
    fits = {}
    for (sid, m), (n, n_event, total, events) in sums.items():
        fit = _Fit(slots[m], total / n, total, events, int(n), int(n_event))
        reference_seen = set()
        for j, s in enumerate(fit.slots):
            if s.level is None:
                fit.active.append(j)
            elif total[j] > 0:
                # the first level that occurs in this slice is the reference
                if s.term in reference_seen:
                    fit.active.append(j)
                reference_seen.add(s.term)
        fit.beta, fit.trial = np.zeros(len(total)), np.zeros(len(total))
        fit.done = n_event == 0 or not fit.active
        fits[sid, m] = fit
    return fits


# --- one step --------------------------------------------------------------------------------------

def _step(frozen: DataFrame, designs, width: int, fits: dict[tuple[int, int], _Fit], spans: dict[int, tuple[float, float]],
          efron: bool) -> dict[tuple[int, int], dict]:
    """Log-likelihood, gradient and information of every unfinished fit at its trial coefficients."""
    todo = {k: f for k, f in fits.items() if not f.done}
    point = {k: {"active": f.active, "mean": f.mean[f.active], "beta": f.trial[f.active]} for k, f in todo.items()}
    totals = {(r["piece"], r["sid"], r["model"]): r for r in _range_totals(frozen, designs, width, point)}
    pieces = sorted(spans)
    later, edge_sums = {}, {}
    with np.errstate(all="ignore"):
        for k, f in todo.items():
            later_of, edge_sums[k] = _edges([(i, totals.get((i, *k))) for i in pieces], spans, len(f.active) + 1, efron)
            later |= {(i, *k): v for i, v in later_of.items()}
        moments: dict[tuple[int, int], list[dict]] = {k: [] for k in todo}
        for r in sorted(_range_moments(frozen, designs, width, point, later, efron), key=lambda r: r["piece"]):
            moments[r["sid"], r["model"]].append(r)
        return {k: _put_together(f, moments[k], edge_sums[k], spans) for k, f in todo.items()}


def _edges(totals: list[tuple[int, dict | None]], spans: dict[int, tuple[float, float]], width: int, efron: bool):
    """From the first pass of one fit: what each range is given, and per edge time (A, log-likelihood, S1, D1, sums)."""
    nothing = np.zeros(width)
    sums = {i: nothing if t is None else np.array(t["total"]) for i, t in totals}
    carry, held = {}, nothing
    for i, _ in reversed(totals):
        carry[i], held = held, held + sums[i]
    parts: dict[float, np.ndarray] = {}
    risk: dict[float, np.ndarray] = {}
    for i, t in totals:
        for side, time in zip(("first", "last"), spans[i]):
            if side == "last" and spans[i][0] == spans[i][1]:
                continue
            own = np.zeros(2 * width + 2) if t is None else np.array(t[side])
            # the risk set of a time begins in the first range that holds it
            risk.setdefault(time, carry[i] + (sums[i] if side == "first" else own[:width]))
            parts[time] = parts.get(time, 0) + own
    times = sorted(parts)
    dead = np.stack([parts[t] for t in times])
    at_risk = np.stack([risk[t] for t in times])
    d = dead[:, -2].round().astype(np.int64)
    found = np.zeros((len(times), 6))
    found[d > 0] = tied_sums(at_risk[d > 0, 0], dead[d > 0, width], d[d > 0], efron)
    given = {t: (found[j, 1], found[j, 2]) for j, t in enumerate(times)}
    return ({i: (carry[i], {t: given[t] for t in spans[i]}) for i, _ in totals},
            {"times": np.array(times), "sums": found, "loglik": float((dead[:, -1] - found[:, 0]).sum()),
             "tied": _tied_part(at_risk[:, 1:], dead[:, width + 1:2 * width], found)})


def _put_together(f: _Fit, moments: list[dict], edges: dict, spans: dict[int, tuple[float, float]]) -> dict:
    p = len(f.active)
    total, tied, loglik, inside = np.zeros((p + 1, p + 1)), edges["tied"].copy(), edges["loglik"], 0.0
    for r in moments:
        # A of all times before the range: those inside earlier ranges, and edges
        before = inside + edges["sums"][edges["times"] < spans[r["piece"]][0], 1].sum()
        total += (np.array(r["local"]) + before * np.array(r["all"])).reshape(p + 1, p + 1)
        tied += np.array(r["tied"]).reshape(p, p)
        loglik += r["loglik"]
        inside += r["inside"]
    observed = (f.events - f.n_event * f.mean)[f.active]
    return {"loglik": float(loglik), "gradient": observed - total[0, 1:], "information": total[1:, 1:] - tied}


def _advance(fit: _Fit, at: dict, max_steps: int) -> None:
    """Accept or halve the trial step, and propose the next one."""
    a = fit.active
    value = at["loglik"]
    fit.steps += 1
    if fit.loglik is not None and not (math.isfinite(value) and value >= fit.loglik - 1e-12 * abs(fit.loglik)):
        fit.trial = (fit.trial + fit.beta) / 2
        fit.done = fit.steps > max_steps
        return
    info, gradient = at["information"], at["gradient"]
    before, fit.loglik = fit.loglik, value
    fit.beta, fit.information = fit.trial.copy(), info
    if before is None:
        fit.null_loglik = value
        fit.score = float(gradient @ np.linalg.pinv(info) @ gradient)
    elif abs(value - before) <= TOLERANCE * abs(value):
        fit.done = fit.converged = True
        step = np.linalg.pinv(info, rcond=1e-11, hermitian=True) @ gradient
        if float(gradient @ step) < 1e-6:
            # within a thousandth of a standard error: the last step needs no look at the rows
            fit.beta[a] += step
    elif fit.steps > max_steps:
        fit.done = True
    if not fit.done:
        fit.trial = fit.beta.copy()
        fit.trial[a] += np.linalg.pinv(info, rcond=1e-11, hermitian=True) @ gradient


# --- public ----------------------------------------------------------------------------------------

def cox_models(df: DataFrame, time: str, event: str, models: Mapping[str, Sequence[str]], slice: Sequence[str] = (),
               ties: str = "efron", levels: Mapping[str, Sequence] | None = None, categorical: Sequence[str] = (),
               alpha: float = 0.05, max_steps: int = 50, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fit named models, all slices at once.

    A model converges when a step changes its log-likelihood by a relative 1e-9 at most; after ``max_steps`` it is
    given as it is, with ``converged`` false.

    Each model uses the rows that are complete for its own terms. Text terms are categorical; their first
    level (in ``levels`` or in sorted order) that occurs in the slice is the reference and has a row without
    a ratio. Long result: ``<slice>, model, term, level, n, n_event, log_hr, se, hr, lo, hi, z, p_value,
    significant, separable, converged, steps, score, loglik, null_loglik``.
    """
    if ties not in ("efron", "breslow"):
        raise ValueError("ties is 'efron' or 'breslow'")
    spark = df.sparkSession
    terms = list(dict.fromkeys(t for ts in models.values() for t in ts))
    slots = _slots(df, terms, levels, categorical)
    slots = {t: slots[t] for t in terms}
    frozen, slices = _layout(df, time, event, slots, slice, range_rows)
    designs = [[(terms.index(t), None if s.level is None else j) for t in ts for j, s in enumerate(slots[t])] for ts in models.values()]
    look = _first_look(frozen, designs, len(terms))
    spans = {r["piece"]: (r["first"], r["last"]) for r in look}
    fits = _start(look, [[s for t in ts for s in slots[t]] for ts in models.values()])
    while any(not f.done for f in fits.values()):
        for k, at in _step(frozen, designs, len(terms), fits, spans, ties == "efron").items():
            _advance(fits[k], at, max_steps)
    names = list(models)
    rows = [(*slices[sid], names[m], *line) for (sid, m), f in sorted(fits.items()) for line in _lines(f, alpha)]
    schema = T.StructType([T.StructField(s, T.StringType()) for s in slice] + [
        T.StructField(n, t) for n, t in _RESULT])
    return spark.createDataFrame(rows, schema)


_RESULT = [("model", T.StringType()), ("term", T.StringType()), ("level", T.StringType()), ("n", T.LongType()),
           ("n_event", T.LongType()), *[(c, T.DoubleType()) for c in ("log_hr", "se", "hr", "lo", "hi", "z", "p_value")],
           ("significant", T.BooleanType()), ("separable", T.BooleanType()), ("converged", T.BooleanType()),
           ("steps", T.IntegerType()), *[(c, T.DoubleType()) for c in ("score", "loglik", "null_loglik")]]


def _lines(f: _Fit, alpha: float) -> list[tuple]:
    where = {j: i for i, j in enumerate(f.active)}
    variance = np.linalg.pinv(f.information, hermitian=True) if f.information is not None else None
    out = []
    for j, s in enumerate(f.slots):
        n, events = (f.n, f.n_event) if s.level is None else (int(round(f.count[j])), int(round(f.events[j])))
        if s.level is not None and n == 0:
            continue
        values = [None] * 7
        separable = bool(s.level is not None and events == 0)
        if j in where and variance is not None:
            i = where[j]
            beta, se = float(f.beta[j]), math.sqrt(max(0.0, float(variance[i, i])))
            if se > 0:
                z = beta / se
                values = [beta, se, _exp(beta), _exp(beta - Z95 * se), _exp(beta + Z95 * se), z, normal_two_sided(z)]
                separable = separable or abs(beta) > 15
        p = values[-1]
        out.append((s.term, None if s.level is None else str(s.level), n, events, *values,
                    None if p is None else p < alpha, separable, f.converged, f.steps, f.score, f.loglik, f.null_loglik))
    return out


def _exp(x: float) -> float:
    return math.exp(x) if x < 700 else math.inf


def cox(df: DataFrame, time: str, event: str, terms: Sequence[str], slice: Sequence[str] = (), ties: str = "efron",
        levels: Mapping[str, Sequence] | None = None, categorical: Sequence[str] = ()) -> DataFrame:
    """One model with all terms."""
    return cox_models(df, time, event, {"multivariable": list(terms)}, slice, ties, levels, categorical)


def cox_univariable(df: DataFrame, time: str, event: str, terms: Sequence[str], slice: Sequence[str] = (),
                    ties: str = "efron", levels: Mapping[str, Sequence] | None = None,
                    categorical: Sequence[str] = ()) -> DataFrame:
    """One model per term, fitted in the same passes."""
    return cox_models(df, time, event, {t: [t] for t in terms}, slice, ties, levels, categorical)


def level_counts(df: DataFrame, event: str, variables: Sequence[str], slice: Sequence[str] = ()) -> DataFrame:
    """Rows and events per (slice, variable, level); rows without an event status are not counted."""
    cells = [F.struct(F.lit(v).alias("variable"), col(v).cast("string").alias("level")) for v in variables]
    rows = df.where(col(event).isNotNull()).select(
        *[col(s) for s in slice], col(event).cast("long").alias("__e"), F.explode(F.array(*cells)).alias("__c"))
    return rows.where(F.col("__c.level").isNotNull()).groupBy(
        *[col(s) for s in slice], F.col("__c.variable").alias("variable"), F.col("__c.level").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__e").alias("n_event"))
