"""Whole-frame helpers: column selectors, positions, bulk expressions and labels."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col, null_if


def cols_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in frame order, both included."""
    i, j = df.columns.index(first), df.columns.index(last)
    return df.columns[i:j + 1] if i <= j else df.columns[j:i + 1][::-1]


def cols_like(df: DataFrame, prefix: str | None = None, contains: str | None = None,
              dtype: str | None = None) -> list[str]:
    """Names that satisfy every given test; an empty list when none does."""
    return [name for name, kind in df.dtypes
            if (prefix is None or name.startswith(prefix))
            and (contains is None or contains in name)
            and (dtype is None or kind == dtype)]


def relocate(df: DataFrame, names: str | Sequence[str], after: str | None = None) -> DataFrame:
    """Move columns behind ``after`` (to the front when it is not given)."""
    moved = [names] if isinstance(names, str) else list(names)
    rest = [c for c in df.columns if c not in moved]
    at = 0 if after is None else rest.index(after) + 1
    return df.select(*[col(c) for c in rest[:at] + moved + rest[at:]])


def add_after(df: DataFrame, name: str, value: Column, after: str) -> DataFrame:
    """Add or replace a column and place it behind ``after``."""
    return relocate(df.withColumn(name, value), name, after)


def across(df: DataFrame, cols: Sequence[str], f: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to each listed column."""
    return df.withColumns({c: f(col(c)) for c in cols}) if cols else df


def null_if_all_strings(df: DataFrame, value: str) -> DataFrame:
    """Turn ``value`` into NULL in every text column."""
    return across(df, cols_like(df, dtype="string"), lambda c: null_if(c, value))


def rename(df: DataFrame, new_by_old: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(new_by_old))


def label(df: DataFrame, texts: Mapping[str, str]) -> DataFrame:
    """Attach display labels as column metadata; other metadata of the column is kept."""
    for name, text in texts.items():
        if name in df.columns:
            df = df.withMetadata(name, {**df.schema[name].metadata, "label": text})
    return df


def labels_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["label"] for f in df.schema.fields if "label" in f.metadata}


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations for inspection, in order, NULLs last."""
    return df.select(*[col(c) for c in cols]).distinct().orderBy(*[col(c).asc_nulls_last() for c in cols])
