"""Sums over the tied events of one time, for Efron's likelihood."""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark import cloudpickle

# the helpers travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Steps of the recurrence below which the asymptotic series are good to the last digits.
_STEPS = 32
# fixed values: coefficients of the midpoint series, by odd derivatives of the summand
_MIDPOINT = (-1 / 24, 7 / 5760, -31 / 967680)
# fixed values: Bernoulli numbers
_BERNOULLI = (1, -1 / 2, 1 / 6, 0, -1 / 30, 0, 1 / 42, 0, -1 / 30, 0, 5 / 66, 0)
#: Share of the ties in the risk set up to which the series holds with so many terms.
_SMALL, _TERMS = 1 / 64, 9


def gamma_differences(x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over t = x, x-1, ..., x-d+1 of log t, 1/t and 1/t^2, for ``x >= d``.

    They are the differences of log-gamma, digamma and trigamma at x+1 and x-d+1, and are worked out as
    those functions are: the recurrence climbs from the small end, and the asymptotic series give the rest as differences,
    so that nothing cancels where x is far above d.
    """
    low = np.minimum(d, _STEPS)
    steps = np.arange(int(low.max(initial=0)))
    t = (x - d)[:, None] + 1 + steps
    t = np.where(steps < low[:, None], t, np.nan)
    logs, first, second = (np.nansum(f, axis=1) for f in (np.log(t), 1 / t, 1 / t**2))
    # the rest runs from x - rest + 1 to x; there is none where the recurrence took every step
    rest = (d - low).astype(np.float64)
    a, b = x - rest + 0.5, x + 0.5
    wide = np.log1p(rest / a)
    logs = logs + rest * np.log(a) + b * wide - rest
    first = first + wide
    second = second + rest / (a * b)
    # derivatives 1, 3, 5 of log t, 1/t, 1/t^2 as coefficient and power
    for c, (l, p), (f, q), (s, r) in zip(_MIDPOINT, ((1, 1), (2, 3), (24, 5)), ((-1, 2), (-6, 4), (-120, 6)), ((-2, 3), (-24, 5), (-720, 7))):
        logs = logs + c * l * (b**-p - a**-p)
        first = first + c * f * (b**-q - a**-q)
        second = second + c * s * (b**-r - a**-r)
    return logs, first, second


def power_sums(d: np.ndarray, most: int) -> np.ndarray:
    """Sums of u^j over u = 0, 1/d, ..., (d-1)/d for j = 0 to ``most``, by Faulhaber's formula."""
    n = np.asarray(d, dtype=np.float64)
    out = [n]
    for j in range(1, most + 1):
        out.append(sum(math.comb(j + 1, i) * b * n ** (1 - i) for i, b in enumerate(_BERNOULLI[:j + 1])) / (j + 1))
    return np.stack(out)


def tied_sums(s: np.ndarray, e: np.ndarray, d: np.ndarray, efron: bool = True) -> np.ndarray:
    """Per row sums over u = 0, 1/d, ..., (d-1)/d of log a, 1/a, u/a, 1/a^2, u/a^2, u^2/a^2 with a = s - u e.

    ``s`` is the weight of the risk set, ``e <= s`` that of the d tied events. Without ``efron`` a is s, and the sums with u
    are 0 (Breslow). In closed form: gamma differences where e is a good part of s, and a series in e / s where it is small and
    those differences would cancel. Both are good to some twelve digits.
    """
    s, e, d = np.asarray(s, dtype=np.float64), np.asarray(e, dtype=np.float64), np.asarray(d, dtype=np.int64)
    out = np.zeros((len(s), 6))
    if not efron:
        out[:, 0], out[:, 1], out[:, 3] = d * np.log(s), d / s, d / s**2
        return out
    small = e <= _SMALL * s
    out[small] = _by_series(s[small], e[small] / s[small], d[small])
    out[~small] = _by_gamma(s[~small], e[~small], d[~small])
    return out


def _by_series(s: np.ndarray, r: np.ndarray, d: np.ndarray) -> np.ndarray:
    """With a = s (1 - u r): powers of r times sums of powers of u."""
    p = power_sums(d, _TERMS + 2)
    powers = r ** np.arange(_TERMS + 1)[:, None]
    logs = d * np.log(s) - sum(powers[j] * p[j] / j for j in range(1, _TERMS + 1))
    inverse = [(powers * p[i:i + _TERMS + 1]).sum(axis=0) / s for i in (0, 1)]
    squared = [(np.arange(1, _TERMS + 2)[:, None] * powers * p[i:i + _TERMS + 1]).sum(axis=0) / s**2 for i in (0, 1, 2)]
    return np.stack([logs, *inverse, *squared], axis=1)


def _by_gamma(s: np.ndarray, e: np.ndarray, d: np.ndarray) -> np.ndarray:
    # in units of e / d the values of a are x, x - 1, ..., x - d + 1
    n = d.astype(np.float64)
    unit = e / n
    x = np.maximum(s / unit, n)
    logs, first, second = gamma_differences(x, d)
    return np.stack([n * np.log(unit) + logs, first / unit, (x * first - n) / e, second / unit**2, (x * second - first) / (e * unit),
                     (x * (x * second - 2 * first) + n) / e**2], axis=1)
