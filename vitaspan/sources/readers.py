"""Readers with declared schemas. Columns that may hold a sentinel are read as text and decoded later."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delim(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", quote: str | None = '"',
               null_values: str = "", comment: str | None = None) -> DataFrame:
    """Delimited text with a header line. ``quote=None`` takes quotes as ordinary characters.

    ``null_values`` is the text that stands for NULL; the empty text always does.
    """
    reader = (spark.read.schema(schema).option("header", True).option("sep", sep)
              .option("quote", "" if quote is None else quote).option("nullValue", null_values)
              .option("enforceSchema", False).option("mode", "FAILFAST"))
    if quote is not None:
        reader = reader.option("escape", quote)
    if comment is not None:
        reader = reader.option("comment", comment)
    df = reader.csv(path)
    if null_values == "":
        return df
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c, t in df.dtypes if t == "string"})


def read_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Tab-separated text without quoting."""
    return read_delim(spark, path, schema, sep="\t", quote=None)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A saved table (Parquet)."""
    return spark.read.parquet(path)


def family_names(spark: SparkSession, pattern: str, name_regex: str) -> dict[str, str]:
    """Table name -> path for the files under a glob; the name is the regex's first group."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    names: dict[str, str] = {}
    for status in found:
        hit = re.search(name_regex, status.getPath().getName())
        if hit:
            if hit.group(1) in names:
                raise ValueError(f"two files for table {hit.group(1)}")
            names[hit.group(1)] = status.getPath().toString()
    return names


def read_family(spark: SparkSession, pattern: str, name_regex: str,
                schemas: Mapping[str, StructType | str]) -> dict[str, DataFrame]:
    """Load a family of CSV files, each as the table its file name names; files without a schema are left."""
    return {name: read_delim(spark, path, schemas[name])
            for name, path in sorted(family_names(spark, pattern, name_regex).items()) if name in schemas}


def read_folder(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """A set of saved tables ``<folder>/<name>.parquet``."""
    return {n: read_table(spark, f"{folder}/{n}.parquet") for n in names}
