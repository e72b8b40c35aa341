"""Sinks. The run date is an argument, so a rerun writes to the same place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dated_path(path: str, run_date: str | None) -> str:
    """``name_2024-07-15.ext`` for ``name.ext``; the path itself without a date."""
    if run_date is None:
        return path
    folder, _, name = path.rpartition("/")
    stem, dot, ext = name.rpartition(".")
    dated = f"{stem}_{run_date}.{ext}" if dot else f"{name}_{run_date}"
    return f"{folder}/{dated}" if folder else dated


def write_table(df: DataFrame, path: str, fmt: str = "parquet", run_date: str | None = None,
                columns: Sequence[str] | None = None, mode: str = "errorifexists",
                partition_by: Sequence[str] = ()) -> str:
    """Write chosen columns as Parquet, or as CSV with a header and NULL as ``NA``; returns the path."""
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    target = dated_path(path, run_date)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(target)
    elif fmt == "csv":
        writer.option("header", True).option("nullValue", "NA").option("escape", '"').csv(target)
    else:
        raise ValueError("fmt is 'parquet' or 'csv'")
    return target
