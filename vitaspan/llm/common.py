"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def by_value(module: str) -> None:
    """Functions of ``module`` travel to the executors with the job, so they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def worker_state(name: str, make):
    """What ``make`` gives, made once in a Python worker and found again by its later tasks.

    Code that travels by value has globals of its own in every task, so the state is held by a module of the worker.
    """
    held = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def words(text: Column) -> Column:
    """Words of a text as an array; NULL text: no words. Splitting at one plain character needs no regular expression."""
    plain = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (an array column used inside a lambda is else built per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_fold(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows (all, if there are fewer), chosen by a hash of ``key``; the bound is in expectation."""
    n = rows.count()
    if n <= most:
        return rows
    limit = int(most / n * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < limit)


by_value(__name__)
