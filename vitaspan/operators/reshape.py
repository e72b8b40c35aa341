"""Long to wide, wide to long, and ordered text aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col, number_text
from vitaspan.operators.joins import join_ns
from vitaspan.operators.ordered import sequence_no, top_per_key
from vitaspan.session import PIECE_ROWS, shared


def pivot_wide(df: DataFrame, id_cols: Sequence[str], names_from: str, values_from: str,
               values: Sequence[str] | None = None, on_duplicate: str = "error", others: str = "error") -> DataFrame:
    """One column per value of ``names_from``; a NULL name becomes the column ``NA``.

    Without ``values`` the names are read first, in one job, and sorted. With them a name outside is an error,
    unless ``others`` is ``drop``; its id still gets a row. Two rows for one cell are an error,
    unless ``on_duplicate`` is ``list`` (cells are arrays) or ``max``.
    """
    name = F.coalesce(col(names_from).cast("string"), F.lit("NA"))
    if values is None:
        values = [r[0] for r in df.select(name.alias("v")).distinct().orderBy("v").collect()]
    elif others == "error":
        unknown = F.raise_error(F.concat(F.lit(f"{names_from} has a name that was not given: "), name)).cast("string")
        name = F.when(name.isin(list(values)), name).otherwise(unknown)
    elif others != "drop":
        raise ValueError("others is 'error' or 'drop'")
    v = col(values_from)
    named = df.withColumn("__name", name)

    def cell(n: str) -> Column:
        hit = F.col("__name") == n
        if on_duplicate == "list":
            return F.collect_list(F.when(hit, v))
        if on_duplicate == "max":
            return F.max(F.when(hit, v))
        failed = F.raise_error(F.lit(f"several rows for one cell of {names_from}")).cast(dict(df.dtypes)[values_from])
        return F.when(F.count_if(hit) > 1, failed).otherwise(F.max(F.when(hit, v)))

    if on_duplicate not in ("error", "list", "max"):
        raise ValueError("on_duplicate is 'error', 'list' or 'max'")
    return named.groupBy(*[col(c) for c in id_cols]).agg(*[cell(n).alias(n) for n in values])


#: Ordinals that get columns of their own where no number is asked for.
WIDTH = 100


def pivot_ordinal(df: DataFrame, id_cols: Sequence[str], key: str, order: Sequence[str | Column],
                  value_cols: Sequence[str], max_n: int | None = None,
                  ties: Sequence[str | Column] | None = None, width: int = WIDTH) -> DataFrame:
    """Number the records of ``key`` and spread the values over ``a_1..a_n, b_1..b_n``.

    Records are numbered over the key even if ``id_cols`` are finer. ``max_n`` keeps the first ordinals
    (every combination of ``id_cols`` stays, if need be without values). Without it all are kept: the longest key sets the
    number of columns, which takes one counting job, up to ``width`` of each; the values of later records follow in order in
    arrays ``a_more, b_more``. ``pivot_blocks`` gives tables of fixed width for keys of any length.
    """
    # read two or three times below
    df = shared(df)
    longest = 0
    if max_n is None:
        longest = int(df.groupBy(col(key)).count().agg(F.max("count")).head()[0] or 0)
    n = min(longest, width) if max_n is None else max_n
    ids = [col(c) for c in id_cols]
    numbered = sequence_no(df, [key], order, "__no", ties) if longest > n else top_per_key(df, [key], order, n, ties, out="__no")
    cells = [F.max(F.when(F.col("__no") == i, col(v))).alias(f"{v}_{i}") for v in value_cols for i in range(1, n + 1)]
    if longest > n:
        later = F.array_sort(F.collect_list(F.when(F.col("__no") > n, F.struct("__no", *[col(v).alias(f"v{i}") for i, v in enumerate(value_cols)]))))
        cells.append(later.alias("__later"))
    wide = numbered.groupBy(*ids).agg(*cells)
    if longest > n:
        wide = wide.withColumns({f"{v}_more": F.col(f"__later.v{i}") for i, v in enumerate(value_cols)}).drop("__later")
    if list(id_cols) == [key]:
        return wide
    return join_ns(df.select(*ids).distinct(), wide, list(id_cols), "left")


def pivot_blocks(df: DataFrame, id_cols: Sequence[str], key: str, order: Sequence[str | Column], value_cols: Sequence[str],
                 width: int = WIDTH, ties: Sequence[str | Column] | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Like ``pivot_ordinal`` in blocks of ``width`` ordinals: a row per ``id_cols`` and ``block`` (from 0).

    A block holds the ordinals ``block * width + 1`` onwards. The schema depends on no data, and no row or task on the number
    of records of a key.
    """
    numbered = sequence_no(df, [key], order, "__no", ties, piece_rows).withColumn("block", F.floor((F.col("__no") - 1) / width).cast("int"))
    slot = (F.col("__no") - 1) % width + 1
    cells = [F.max(F.when(slot == i, col(v))).alias(f"{v}_{i}") for v in value_cols for i in range(1, width + 1)]
    return numbered.groupBy(*[col(c) for c in id_cols], "block").agg(*cells)


def concat_ordered(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str],
                   sep: str = "; ", nulls: str = "poison") -> DataFrame:
    """Join the values of every key into one text per column, in ``order`` (NULLs last), ties by value.

    ``nulls='poison'``: one NULL makes the text NULL; ``'skip'``: NULLs are left out. The values of a key
    become one cell, so a key must fit into a row; that is what the operator returns.
    """
    arrays, places = _ordered_arrays(df, keys, cols, order)
    out = [F.col(f"__key{i}").alias(k) for i, k in enumerate(keys)]
    for i, c in enumerate(cols):
        items = _values(places[i])
        text = F.array_join(items, sep)
        if nulls == "poison":
            text = F.when(~F.exists(items, lambda x: x.isNull()), text)
        out.append(text.alias(c))
    return arrays.select(*out)


def collect_ordered(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Like ``concat_ordered``, but each column is an array (NULLs kept)."""
    arrays, places = _ordered_arrays(df, keys, cols, order)
    out = [F.col(f"__key{i}").alias(k) for i, k in enumerate(keys)]
    out += [_values(places[i]).alias(c) for i, c in enumerate(cols)]
    return arrays.select(*out)


def _values(place: str) -> Column:
    return F.transform(F.col("__rows"), lambda r: r[place])


def _ordered_arrays(df, keys, cols, order):
    """Rows of a key as sorted structs, and the field of each of ``cols``; a text that is sorted by is held once."""
    kinds = dict(df.dtypes)
    fields, places = [], []
    for i, o in enumerate(order):
        fields += [col(o).isNull().alias(f"n{i}"), col(o).alias(f"o{i}")]
    for i, c in enumerate(cols):
        if c in order and kinds[c] == "string":
            places.append(f"o{list(order).index(c)}")
            continue
        text = number_text(c) if kinds[c] in ("double", "float") else col(c).cast("string")
        if c not in order:
            fields.append(col(c).isNull().alias(f"vn{i}"))
        fields.append(text.alias(f"v{i}"))
        places.append(f"v{i}")
    grouped = df.groupBy(*[col(k).alias(f"__key{i}") for i, k in enumerate(keys)])
    return grouped.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("__rows")), places


def unpivot_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], variable: str = "variable",
                 value: str = "value", as_text: bool = True) -> DataFrame:
    """One row per (row, column) pair, NULL values included."""
    kinds = dict(df.dtypes)
    picked = [(number_text(c) if kinds[c] in ("double", "float") else col(c).cast("string")).alias(c)
              if as_text else col(c) for c in cols]
    narrow = df.select(*[col(c) for c in ids], *picked)
    return narrow.unpivot([col(c) for c in ids], [col(c) for c in cols], variable, value)


def any_flag_by_sample(df: DataFrame, sample: str, flag: str, out: str = "flag") -> DataFrame:
    """Per sample whether any variant carries the flag (long form of a column-wise "any" of a mask)."""
    return df.groupBy(col(sample)).agg(F.coalesce(F.bool_or(col(flag)), F.lit(False)).alias(out))
