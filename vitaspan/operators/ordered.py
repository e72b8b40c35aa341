"""Operators whose result depends on the order of records within a key.

Order is always explicit: a list of column names, ``"-name"`` for descending, NULLs last either way.
The remaining columns break ties, so results do not depend on file or partition order.

No operator sorts an unbounded group in one task:

* top-1 / top-n per key is a ranked filter, for which Spark limits every key on the map side
  (``WindowGroupLimit Partial``) before the shuffle;
* a value per key, numbering, ranking and filling are windows on the key, so a chain of them shares one shuffle;
* a key with too many rows for one task is found by a count. Its values are aggregated (map-side combine) and joined
  back, and for the rest its rows are cut into frozen ranges of (key, order), as many as it has rows for, which a small
  table links.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col, level_index
from vitaspan.session import PIECE_ROWS, freeze, freeze_ranges, shared

_PIECE = "__piece"
_RANK = "__rank"


def order_by(order: Sequence[str | Column]) -> list[Column]:
    """Sort expressions for an order list, NULLs last in both directions."""
    out = []
    for item in order:
        if isinstance(item, Column):
            out.append(item)
        elif item.startswith("-"):
            out.append(col(item[1:]).desc_nulls_last())
        else:
            out.append(col(item).asc_nulls_last())
    return out


def _ties(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
          ties: Sequence[str | Column] | None) -> Sequence[str | Column]:
    if ties is not None:
        return ties
    used = set(keys) | {o.lstrip("-") for o in order if isinstance(o, str)}
    return [c for c, kind in df.dtypes if c not in used and "map<" not in kind]


def _total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 ties: Sequence[str | Column] | None) -> list[Column]:
    return order_by([*order, *_ties(df, keys, order, ties)])


def _by(keys: Sequence[str]) -> list[Column]:
    return [col(k) for k in keys]


def _attach(df: DataFrame, keys: Sequence[str], small: DataFrame, values: Sequence[str]) -> DataFrame:
    """Left-join per-key ``values`` to the rows; NULL keys match NULL keys."""
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    small = small.withColumnsRenamed(names)
    test = F.lit(True)
    for k, renamed in names.items():
        test = test & df[f"`{k}`"].eqNullSafe(small[renamed])
    kept = [df[f"`{c}`"] for c in df.columns if c not in values]
    return df.join(small, test, "left").select(*kept, *[small[f"`{v}`"] for v in values])


def sort(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Sort for a sink or for display."""
    return df.orderBy(*order_by(order))


# --- top-n per key ---------------------------------------------------------------------------------

def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1,
                ties: Sequence[str | Column] | None = None, out: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key; ``out`` keeps their position."""
    name = out or _RANK
    w = W.partitionBy(*_by(keys)).orderBy(*_total_order(df, keys, order, ties))
    top = df.withColumn(name, F.row_number().over(w)).where(col(name) <= n)
    return top if out else top.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  ties: Sequence[str | Column] | None = None) -> DataFrame:
    """Whole first row of every key."""
    return top_per_key(df, keys, order, 1, ties)


def last_per_key(df: DataFrame, keys: Sequence[str], time: str,
                 ties: Sequence[str | Column] | None = None) -> DataFrame:
    """Whole latest row of every key; rows without a time come last."""
    return top_per_key(df, keys, [f"-{time}"], 1, ties)


def strongest_per_key(df: DataFrame, keys: Sequence[str], flag: str,
                      ranking: Sequence[str] | None = None) -> DataFrame:
    """Strongest answer per key: the largest text ("Yes" before "No"), or the first in ``ranking``."""
    if ranking is None:
        return df.groupBy(*_by(keys)).agg(F.max(col(flag)).alias(flag))
    place = F.coalesce(level_index(flag, ranking), F.lit(len(ranking) + 1))
    return df.groupBy(*_by(keys)).agg(F.min_by(col(flag), place).alias(flag))


def closest_per_key(df: DataFrame, anchor: DataFrame, keys: Sequence[str], time: str, anchor_time: str,
                    order: Sequence[str] = (), gap: str | None = None) -> DataFrame:
    """Per key the record nearest in time to the key's anchor.

    ``anchor`` has one row per key. Keys without an anchor, or records without a time, have no gap; such
    records are taken only if the key has nothing better.
    """
    name = gap or "__gap"
    point = anchor.select(*_by(keys), col(anchor_time).alias("__anchor"))
    joined = df.join(point, list(keys), "left").withColumn(name, F.abs(col(time) - col("__anchor"))).drop("__anchor")
    nearest = first_per_key(joined, keys, [name, *order, time])
    return nearest if gap else nearest.drop(name)


# --- one value per key, attached to its rows -------------------------------------------------------

def group_values(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Attach aggregates of the key (plain aggregate functions) to each of its rows.

    A chain of them on one key shares one shuffle. A key with more than ``piece_rows`` rows is aggregated with a map-side
    combine and joined back, where the join splits it.
    """
    few, many, _ = _split(df, keys, piece_rows)
    done = few.withColumns({n: a.over(W.partitionBy(*_by(keys))) for n, a in aggregates.items()})
    if many is None:
        return done
    small = many.groupBy(*_by(keys)).agg(*[a.alias(n) for n, a in aggregates.items()])
    return done.unionByName(_attach(many, keys, small, list(aggregates)).select(*_by(done.columns)))


def group_min(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Smallest non-NULL value of the key; NULL when there is none."""
    return group_values(df, keys, {out: F.min(col(value))})


def group_size(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    return group_values(df, keys, {out: F.count(F.lit(1))})


def group_any(df: DataFrame, keys: Sequence[str], flag: str | Column, out: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Three-valued "any" of the key: true, else NULL if some flag is NULL, else false."""
    x = col(flag)
    parts = group_values(df, keys, {"__any": F.bool_or(x), "__unknown": F.bool_or(x.isNull())}, piece_rows)
    value = F.when(F.col("__any"), F.lit(True)).when(~F.col("__unknown"), F.lit(False))
    return parts.withColumn(out, value).drop("__any", "__unknown")


def group_first(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str | Column], out: str,
                ties: Sequence[str | Column] | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Value of the key's first row in ``order``; that value may be NULL."""
    few, many, _ = _split(df, keys, piece_rows)
    in_order = W.partitionBy(*_by(keys)).orderBy(*_total_order(df, keys, order, ties)).rowsBetween(W.unboundedPreceding, 0)
    done = few.withColumn(out, F.first(col(value)).over(in_order))
    if many is None:
        return done
    first = first_per_key(many, keys, order, ties).select(*_by(keys), col(value).alias(out))
    return done.unionByName(_attach(many, keys, first, [out]).select(*_by(done.columns)))


def spread_flag(df: DataFrame, keys: Sequence[str], cols: Sequence[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Copy a flag that some rows of the key carry to all its rows (the value is unique per key)."""
    names = {c: f"__all_{c}" for c in cols}
    wide = group_values(df, keys, {n: F.max(col(c)) for c, n in names.items()}, piece_rows)
    return wide.withColumns({c: F.col(n) for c, n in names.items()}).drop(*names.values())


# --- numbering, ranking, filling -------------------------------------------------------------------

def _same_key(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for i, k in enumerate(keys):
        test = test & df[f"`{k}`"].eqNullSafe(small[f"__key{i}"])
    return test


def _split(df: DataFrame, keys: Sequence[str], most: int) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of the keys that one task can sort, those of the others (None if there are none), and how many the latter are.

    One count over the key columns finds the keys with more than ``most`` rows, if there are so many rows at all; a chain of
    scans over one table counts without the windows of the earlier ones, which give no key.
    """
    df = shared(df, "Window")
    if df.count() <= most:
        return df, None, 0
    named = [col(k).alias(f"__key{i}") for i, k in enumerate(keys)]
    large = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > most)
    n = large.agg(F.sum("__rows")).first()[0]
    if n is None:
        return df, None, 0
    df = shared(df)
    if not keys:
        return df.where(F.lit(False)), df, n
    large = freeze(large.drop("__rows"))
    test = _same_key(df, large, keys)
    return df.join(large, test, "left_anti"), df.join(large, test, "left_semi"), n


def _pieces(df: DataFrame, keys: Sequence[str], order: list[Column], n: int, most: int) -> DataFrame:
    """Rows in ranges of (key, order), as many as the rows need; those of a lower piece come before those of a higher one.

    Rows that ``order`` does not tell apart are told apart by a hash, so that they fit into ranges too.
    """
    told = F.xxhash64(*[col(c) for c, kind in df.dtypes if "map<" not in kind])
    return freeze_ranges(df, [*[col(k).asc_nulls_last() for k in keys], *order, told], _PIECE, max(2, -(-n // most)))


def sequence_no(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str,
                ties: Sequence[str | Column] | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Number the rows of every key from 1."""
    return scan(df, keys, order, number=out, ties=ties, piece_rows=piece_rows)


def fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
         direction: str = "updown", ties: Sequence[str] | None = None,
         piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Fill NULLs within the key: ``updown`` takes the next value, else the previous; ``downup`` reversed."""
    return scan(df, keys, order, fills=cols, direction=direction, ties=ties, piece_rows=piece_rows)


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], number: str | None = None, size: str | None = None,
         fills: Sequence[str] = (), direction: str = "updown", ties: Sequence[str | Column] | None = None,
         piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Go through the rows of every key in order: number them, count them, fill NULLs of some columns, all in one layout.

    The rows of a key are sorted in one task, unless they are more than ``piece_rows``: then they are cut into ranges, each is
    scanned on its own, and what the ranges hand on to each other (rows so far, last and first known values) is
    added from a table with a row per key and range.
    """
    if direction not in ("updown", "downup"):
        raise ValueError("direction is 'updown' or 'downup'")
    full = _total_order(df, keys, order, ties)
    back = _reversed(df, keys, order, ties) if fills else []
    few, many, n = _split(df, keys, piece_rows)
    done = _scan_keys(few, keys, full, back, number, size, fills, direction)
    if many is None:
        return done
    pieces = _pieces(many, keys, full, n, piece_rows)
    return done.unionByName(_scan_pieces(pieces, keys, full, back, number, size, fills, direction).select(*_by(done.columns)))


def _scan_keys(df: DataFrame, keys: Sequence[str], order: list[Column], back: list[Column], number: str | None, size: str | None,
               fills: Sequence[str], direction: str) -> DataFrame:
    forward, backward = (W.partitionBy(*_by(keys)).orderBy(*o) for o in (order, back))
    new = {}
    if number:
        new[number] = F.row_number().over(forward)
    if size:
        new[size] = F.count(F.lit(1)).over(W.partitionBy(*_by(keys)))
    for c in fills:
        down, up = _last_known(c, forward), _last_known(c, backward)
        new[c] = F.coalesce(up, down) if direction == "updown" else F.coalesce(down, up)
    return df.withColumns(new)


def _scan_pieces(rows: DataFrame, keys: Sequence[str], order: list[Column], back: list[Column], number: str | None,
                 size: str | None, fills: Sequence[str], direction: str) -> DataFrame:
    """The same over frozen ranges."""
    piece = [*keys, _PIECE]
    # what a range holds: its rows, and the first and last known value of each column
    ends = rows.groupBy(*_by(piece)).agg(F.count(F.lit(1)).alias("__size"))
    for c in fills:
        for side, rank in (("head", order), ("tail", back)):
            one = (rows.where(col(c).isNotNull())
                   .withColumn(_RANK, F.row_number().over(W.partitionBy(*_by(piece)).orderBy(*rank)))
                   .where(col(_RANK) == 1)
                   .select(*_by(piece), col(c).alias(f"__{side}_{c}")))
            ends = _attach(ends, piece, one, [f"__{side}_{c}"])
    earlier = W.partitionBy(*_by(keys)).orderBy(_PIECE).rowsBetween(W.unboundedPreceding, -1)
    later = W.partitionBy(*_by(keys)).orderBy(F.col(_PIECE).desc()).rowsBetween(W.unboundedPreceding, -1)
    handed = {"__start": F.coalesce(F.sum("__size").over(earlier), F.lit(0)), "__all": F.sum("__size").over(W.partitionBy(*_by(keys)))}
    for c in fills:
        handed |= {f"__prev_{c}": F.last(f"__tail_{c}", True).over(earlier), f"__next_{c}": F.last(f"__head_{c}", True).over(later)}
    carried = ends.select(*_by(piece), *[e.alias(name) for name, e in handed.items()])
    forward, backward = (W.partitionBy(*_by(piece)).orderBy(*o) for o in (order, back))
    local = {"__no": F.row_number().over(forward)} if number else {}
    for c in fills:
        local |= {f"__dn_{c}": _last_known(c, forward), f"__up_{c}": _last_known(c, backward)}
    joined = _attach(rows.withColumns(local) if local else rows, piece, carried, list(handed))
    new = {}
    if number:
        new[number] = (col("__no") + col("__start")).cast("int")
    if size:
        new[size] = col("__all")
    for c in fills:
        down, up = (F.coalesce(col(f"__{a}_{c}"), col(f"__{b}_{c}")) for a, b in (("dn", "prev"), ("up", "next")))
        new[c] = F.coalesce(up, down) if direction == "updown" else F.coalesce(down, up)
    return joined.withColumns(new)


def dense_rank_nulls_out(df: DataFrame, keys: Sequence[str], by: Sequence[str], out: str,
                         piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Dense rank of ``by`` (most significant column first) within the key.

    A row with NULL in any of ``by`` has no rank and takes no number. In a key with more than ``piece_rows`` rows only the
    different values are numbered, and the numbers joined back.
    """
    known = F.lit(True)
    for b in by:
        known = known & col(b).isNotNull()
    few, many, _ = _split(df, keys, piece_rows)
    rank = F.dense_rank().over(W.partitionBy(*_by(keys), known).orderBy(*order_by(by)))
    done = few.withColumn(out, F.when(known, rank))
    if many is None:
        return done
    values = many.where(known).select(*_by(keys), *_by(by)).distinct()
    ranks = sequence_no(values, keys, by, out, ties=[], piece_rows=piece_rows)
    return done.unionByName(_attach(many, [*keys, *by], ranks, [out]).select(*_by(done.columns)))


def _last_known(c: str, w) -> Column:
    return F.last(col(c), True).over(w.rowsBetween(W.unboundedPreceding, 0))


def _reversed(df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] | None) -> list[Column]:
    """Exact reverse of the total order of the same arguments; all of them names."""
    out = []
    for item in [*order, *_ties(df, keys, order, ties)]:
        out.append(col(item[1:]).asc_nulls_first() if item.startswith("-") else col(item).desc_nulls_first())
    return out
