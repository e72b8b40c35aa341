"""Running totals and exact quantiles over collapsed ``(key, value)`` counts.

The values of a key are run through in one task. A key with too many different values for that, found by a count, is cut
into ranges of its values that hold about as many each (by a sample of the values themselves), every range is run
through on its own, and the totals of the earlier ranges, one row per key and range, are added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col
from vitaspan.operators.ordered import _PIECE, _attach, _by, _pieces, _split
from vitaspan.session import PIECE_ROWS


def running(df: DataFrame, keys: Sequence[str], by: str, sums: Mapping[str, Column] | None = None,
            products: Mapping[str, Column] | None = None, reverse: bool = False, totals: Mapping[str, Column] | None = None,
            piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Add inclusive running sums and products over ``by`` within ``keys``; ``reverse`` runs downwards.

    ``(keys, by)`` is unique in ``df``; NULL keys form a group. ``totals`` adds sums over the whole key.
    """
    sums, products, totals = dict(sums or {}), dict(products or {}), dict(totals or {})
    parts = {**{n: (F.sum, e) for n, e in sums.items()}, **{n: (F.product, e) for n, e in products.items()}}
    order = [col(by).desc() if reverse else col(by).asc()]
    few, many, n_rows = _split(df, keys, piece_rows)
    kept = [c for c in df.columns if c not in parts and c not in totals]
    group = W.partitionBy(*_by(keys))
    upto = group.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    done = few.select(*_by(kept), *[f(e).over(upto).alias(n) for n, (f, e) in parts.items()],
                      *[F.sum(e).over(group).alias(n) for n, e in totals.items()])
    if many is None:
        return done
    pieces = _pieces(many, keys, order, n_rows, piece_rows)
    piece = [*keys, _PIECE]
    ends = pieces.groupBy(*_by(piece)).agg(*[f(e).alias(f"__t_{n}") for n, (f, e) in parts.items()],
                                           *[F.sum(e).alias(f"__a_{n}") for n, e in totals.items()])
    before = group.orderBy(_PIECE).rowsBetween(W.unboundedPreceding, -1)
    handed = {f"__c_{n}": f(f"__t_{n}").over(before) for n, (f, _) in parts.items()}
    handed |= {n: F.sum(f"__a_{n}").over(group) for n in totals}
    carry = ends.select(*_by(piece), *[e.alias(n) for n, e in handed.items()])
    inside = W.partitionBy(*_by(piece)).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = pieces.select(*_by([*kept, _PIECE]), *[f(e).over(inside).alias(f"__w_{n}") for n, (f, e) in parts.items()])
    both = _attach(local, piece, carry, list(handed))
    whole = {n: F.col(f"__w_{n}") + F.coalesce(F.col(f"__c_{n}"), F.lit(0)) for n in sums}
    whole |= {n: F.col(f"__w_{n}") * F.coalesce(F.col(f"__c_{n}"), F.lit(1.0)) for n in products}
    return done.unionByName(both.select(*_by(kept), *[e.alias(n) for n, e in whole.items()], *_by(list(totals))))


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], value: str, n: str, probs: Mapping[str, float],
                        piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Exact quantiles (linear interpolation between order statistics) of values with multiplicities.

    ``counts`` has one row per (keys, value); values are not NULL, NULL keys form a group. The result also has ``__n``, the
    number of values per key.
    """
    rows = running(counts, keys, value, {"__hi": col(n)}, totals={"__n": col(n)}, piece_rows=piece_rows)
    low = F.col("__hi") - col(n)
    picks = [F.max("__n").alias("__n")]
    for name, p in probs.items():
        at = (F.col("__n") - 1) * F.lit(float(p))
        for side, place in (("a", F.floor(at)), ("b", F.ceil(at))):
            here = (low <= place) & (place < F.col("__hi"))
            picks.append(F.max(F.when(here, col(value))).alias(f"__{side}_{name}"))
    found = rows.groupBy(*_by(keys)).agg(*picks)
    out = []
    for name, p in probs.items():
        at = (F.col("__n") - 1) * F.lit(float(p))
        a, b = F.col(f"__a_{name}"), F.col(f"__b_{name}")
        out.append((a + (at - F.floor(at)) * (b - a)).alias(name))
    return found.select(*_by(keys), "__n", *out)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
              piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Exact quantiles of a column per key; NULL values are left out, NULL keys form a group."""
    counts = (df.where(col(value).isNotNull()).groupBy(*[col(k) for k in keys], col(value).cast("double").alias("__v"))
              .agg(F.count(F.lit(1)).alias("__m")))
    return quantiles_of_counts(counts, keys, "__v", "__m", probs, piece_rows).drop("__n")
