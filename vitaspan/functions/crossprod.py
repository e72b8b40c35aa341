"""Sums of weighted outer products per key.

Each task adds up its own rows with numpy and hands on one small matrix per key; Spark sums those.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

# the helpers travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def partial_products(df: DataFrame, keys: Sequence[str],
                     parts: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Per task and key the flattened matrix ``sum over rows and parts of weight * left' right``.

    ``parts`` lists (weight column, left columns, right columns) of equal widths; keys are text. A sum over
    the rows of a key gives the matrix of the key.
    """
    keys = list(keys)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, sort=False).indices.items():
                some = batch.take(rows)
                total = sum((some[list(left)].to_numpy() * some[[weight]].to_numpy()).T @ some[list(right)].to_numpy()
                            for weight, left, right in parts)
                name = key if isinstance(key, tuple) else (key,)
                totals[name] = totals[name] + total if name in totals else total
        if totals:
            yield pd.DataFrame([(*k, m.ravel().tolist()) for k, m in totals.items()], columns=[*keys, "cells"])

    schema = StructType([StructField(k, StringType()) for k in keys] + [StructField("cells", ArrayType(DoubleType()))])
    columns = list(dict.fromkeys([*keys, *[c for w, left, right in parts for c in (w, *left, *right)]]))
    return df.select(*columns).mapInPandas(add_up, schema)


def sum_cells(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the arrays of equal keys: ``keys, cell, value``."""
    return partial.select(*keys, F.posexplode("cells").alias("cell", "value")).groupBy(*keys, "cell").agg(
        F.sum("value").alias("value"))
