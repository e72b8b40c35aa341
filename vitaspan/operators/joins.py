"""Joins in which NULL keys may match, N-way assembly, tiered unions and key checks.

No join here is hinted: sides are broadcast only when their estimated or measured size is below Spark's
threshold, and skewed shuffle partitions are split at run time (see ``session.prepare``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col
from vitaspan.operators.ordered import first_per_key
from vitaspan.session import shared


def join_ns(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str], how: str = "left",
            nulls_match: bool = True, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join whose NULL keys match by default. ``how``: left, inner, full.

    ``on`` lists shared key names or maps left names to right names. The result has the left key names
    (coalesced for ``full``); other shared columns get the suffixes.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    right_names = {c: f"__r{i}" for i, c in enumerate(right.columns)}
    r = right.withColumnsRenamed(right_names)
    test = None
    for lk, rk in pairs.items():
        a, b = left[f"`{lk}`"], r[right_names[rk]]
        one = a.eqNullSafe(b) if nulls_match else a == b
        test = one if test is None else test & one
    others = [c for c in right.columns if c not in pairs.values()]
    shared = {c for c in left.columns if c not in pairs} & set(others)
    out = []
    for c in left.columns:
        if c in pairs and how == "full":
            out.append(F.coalesce(left[f"`{c}`"], r[right_names[pairs[c]]]).alias(c))
        else:
            out.append(left[f"`{c}`"].alias(c + suffixes[0] if c in shared else c))
    out += [r[right_names[c]].alias(c + suffixes[1] if c in shared else c) for c in others]
    return left.join(r, test, how).select(*out)


def semi_by_list(df: DataFrame, key: str, keys_df: DataFrame, keys_col: str | None = None,
                 mode: str = "exact") -> DataFrame:
    """Rows whose key is in a list of keys.

    ``mode='substring'`` also keeps rows whose key merely contains a listed key (the empty one counts for nothing). The
    short pieces of every distinct key meet the heads of the listed ones, at most ``HEAD`` characters long, in an
    equi-join; only where a head is found are pieces of the listed lengths cut out and looked up.
    """
    name = keys_col or key
    wanted = keys_df.select(col(name).alias("__want")).where(F.col("__want").isNotNull())
    if mode == "exact":
        return df.join(wanted, df[f"`{key}`"] == wanted["__want"], "left_semi")
    if mode != "substring":
        raise ValueError("mode is 'exact' or 'substring'")
    length = F.length("__want")
    head = F.when(length >= HEAD, F.lit(HEAD))
    for size in _head_sizes()[1:]:
        head = head.when(length >= size, F.lit(size))
    heads = wanted.where(length > 0).select(F.substring(F.col("__want"), F.lit(1), head).alias("__head"), length.alias("__length")).distinct()
    text = df.select(col(key).alias("__have")).where(F.col("__have").isNotNull()).distinct().withColumn("__id", F.sha2("__have", 256))
    pieces = F.flatten(F.array(*[_pieces_of("__have", n) for n in _head_sizes()]))
    met = text.select("__id", F.explode(pieces).alias("__p")).select("__id", "__p.*").join(heads, "__head")
    cuts = (met.select("__id", "__at", "__length").distinct().join(text, "__id")
            .select("__have", F.substring(F.col("__have"), F.col("__at"), F.col("__length")).alias("__cut")).distinct())
    found = cuts.join(wanted, F.col("__cut") == F.col("__want"), "left_semi").select("__have").distinct()
    return df.join(found, df[f"`{key}`"] == found["__have"], "left_semi")


#: Longest head of a listed key that pieces are compared with.
HEAD = 16


def _head_sizes() -> list[int]:
    return [HEAD >> i for i in range(HEAD.bit_length())]


def _pieces_of(name: str, n: int) -> Column:
    """Pieces of ``n`` characters with their places from 1; a shorter text has none."""
    text = F.col(name)
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("__at"), F.substring(text, i, F.lit(n)).alias("__head")))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself; raises if a key occurs twice."""
    sample = duplicates(df, keys).head(1)
    if sample:
        raise ValueError(f"key {list(keys)} is not unique, e.g. {sample[0].asDict()}")
    return df


def member_update(df: DataFrame, key: str, members: DataFrame, members_key: str, column: str, value) -> DataFrame:
    """Set ``column`` to ``value`` on rows whose key is a member; other rows keep theirs."""
    listed = members.select(col(members_key).alias("__member")).where(F.col("__member").isNotNull()).distinct()
    hit = F.when(listed["__member"].isNotNull(), F.lit(value)).otherwise(df[f"`{column}`"])
    return df.join(listed, df[f"`{key}`"] == listed["__member"], "left").select(
        *[hit.alias(c) if c == column else df[f"`{c}`"] for c in df.columns])


def union_fill(*frames: DataFrame) -> DataFrame:
    """Union of frames with different columns; missing ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union of named frames, with the name in a column."""
    return union_fill(*[df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def assemble(tables: Sequence[DataFrame], key: str, how: str = "left", key_nullable: bool = True) -> DataFrame:
    """Join many tables on one key.

    ``left`` keeps the keys of the first table. ``full`` keeps the keys of all: instead of a chain of full
    outer joins it left-joins every table to the distinct union of the keys, which needs n+1 shuffles, not
    2(n-1). NULL keys match NULL keys. ``key_nullable=False`` promises that no table has a NULL key; then
    plain equality is used, which keeps the partitioning the tables already have after a reduction by key,
    and the promise is checked while the keys are read.
    """
    seen: set[str] = set()
    for t in tables:
        clash = seen & {c for c in t.columns if c != key}
        if clash:
            raise ValueError(f"column in two tables: {sorted(clash)}")
        seen |= {c for c in t.columns if c != key}
    if how == "left":
        base, rest = tables[0], list(tables[1:])
    elif how == "full":
        # read for their keys and for their rows
        tables = [shared(t) for t in tables]
        base = reduce(lambda a, b: a.union(b), [t.select(col(key)) for t in tables]).distinct()
        if not key_nullable:
            failed = F.raise_error(F.lit(f"NULL in key {key}"))
            base = base.where(col(key).isNotNull() | failed.cast("boolean"))
        rest = list(tables)
    else:
        raise ValueError("how is 'left' or 'full'")
    if key_nullable:
        return reduce(lambda a, b: join_ns(a, b, [key], "left"), rest, base)
    # a table goes through the joins as one column, so that none of them copies the columns of all tables before it
    packed = {f"__t{i}": t.select(col(key), F.struct(*[col(c) for c in t.columns if c != key]).alias(f"__t{i}"))
              for i, t in enumerate(rest) if len(t.columns) > 1}
    joined = reduce(lambda a, b: a.join(b, key, "left"), [packed.get(f"__t{i}", t) for i, t in enumerate(rest)], base)
    return joined.select(col(key), *[col(c) for c in base.columns if c != key], *[f"{t}.*" for t in packed])


def tiered_union_first(df: DataFrame, match: DataFrame, on: Mapping[str, str], fallback: Column,
                       keys: Sequence[str], order: Sequence[str | Column],
                       ties: Sequence[str | Column] | None = None, unique_by: Sequence[str] = ()) -> DataFrame:
    """First record per key, where records that match come before records that satisfy ``fallback``.

    ``on`` maps columns of ``df`` to columns of ``match`` (NULLs match). Records of neither tier are not
    eligible. One ranked filter replaces two reductions, a union and a third reduction.
    """
    tiers = tier_of(df, match, on, fallback, unique_by)
    return first_per_key(tiers, keys, ["__tier", *order], ties).drop("__tier")


def tier_of(df: DataFrame, match: DataFrame, on: Mapping[str, str], fallback: Column,
            unique_by: Sequence[str] = (), out: str = "__tier") -> DataFrame:
    """Rows of both tiers, numbered 0 (match) and 1 (fallback).

    A row that satisfies both appears once per tier, as it does when the tiers are unioned. ``unique_by``
    names columns of ``on`` that are never NULL and of which ``match`` has one row each: then only those are
    joined, which leaves the rows partitioned by them for the reduction that follows.
    """
    names = {d: f"__m{i}" for i, d in enumerate(on)}
    flags = match.select(*[col(m).alias(names[d]) for d, m in on.items()])
    flags = (flags if unique_by else flags.distinct()).withColumn("__hit", F.lit(True))
    rows = df.withColumn("__fall", F.coalesce(fallback, F.lit(False)))
    hit = F.col("__hit")
    if unique_by:
        joined = rows.join(flags.withColumnsRenamed({names[d]: d for d in unique_by}), list(unique_by), "left")
        for d in on:
            if d not in unique_by:
                hit = hit & col(d).eqNullSafe(F.col(names[d]))
    else:
        test = F.lit(True)
        for d in on:
            test = test & rows[f"`{d}`"].eqNullSafe(flags[names[d]])
        joined = rows.join(flags, test, "left")
    tiers = F.array_compact(F.array(F.when(hit, F.lit(0)), F.when(F.col("__fall"), F.lit(1))))
    return joined.select(*[col(c) for c in df.columns], F.explode(tiers).alias(out))


def pair_lookup(pairs: DataFrame, left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str,
                nulls_match: bool = True) -> DataFrame:
    """Attributes of listed (left, right) pairs, as if all pairs of a key had been formed and looked up.

    ``left`` and ``right`` hold records of two roles per key; pairing them all is quadratic in the size of a
    key. A listed pair exists if both of its records exist, or one exists, the other id is NULL and the key
    has no record of that role at all. Only the listed pairs are looked up, by two equi-joins.
    """
    looked = [c for c in left.columns if c not in (key, left_id)] + [c for c in right.columns if c not in (key, right_id)]
    if len({*looked, *pairs.columns}) < len(looked) + len(pairs.columns):
        raise ValueError("the three tables must share no column but their keys")
    both = [key]
    lrows = left.withColumn("__l", F.lit(True))
    rrows = right.withColumn("__r", F.lit(True))
    out = join_ns(pairs, lrows, [key, left_id], "left", nulls_match)
    out = join_ns(out, rrows, [key, right_id], "left", nulls_match)
    lkeys = left.select(col(key)).distinct().withColumn("__anyl", F.lit(True))
    rkeys = right.select(col(key)).distinct().withColumn("__anyr", F.lit(True))
    out = join_ns(join_ns(out, lkeys, both, "left", nulls_match), rkeys, both, "left", nulls_match)
    found = ((F.col("__l") & F.col("__r"))
             | (F.col("__l") & F.col("__anyr").isNull() & col(right_id).isNull())
             | (F.col("__r") & F.col("__anyl").isNull() & col(left_id).isNull()))
    return out.select(*[col(c) for c in pairs.columns],
                      *[F.when(F.coalesce(found, F.lit(False)), col(c)).alias(c) for c in looked])
