"""Session helpers: recommended settings and frozen intermediate tables."""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a key that one task sorts; a key with more is cut into ranges of about that many rows.
PIECE_ROWS = 1_000_000


class Owner:
    """The frozen tables of one query; ``drop`` deletes them and leaves those of other owners alone."""

    def __init__(self):
        self.paths: list[str] = []

    def drop(self, spark: SparkSession) -> int:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        done = 0
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            done += bool(path.getFileSystem(conf).delete(path, True))
        return done


_everyone = Owner()
_owner: contextvars.ContextVar[Owner] = contextvars.ContextVar("owner", default=_everyone)


@contextmanager
def owning() -> Iterator[Owner]:
    """Tables frozen inside the block belong to the owner it yields."""
    owner = Owner()
    token = _owner.set(owner)
    try:
        yield owner
    finally:
        _owner.reset(token)


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on the runtime re-planning the operators rely on for skewed keys.

    A join that feeds a window on the same key would otherwise keep a hot key in one task, because
    splitting it costs one more shuffle; ``forceOptimizeSkewedJoin`` accepts that shuffle.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by the session in ``spark.checkpoint.dir``.

    With a local master and no such setting it lies in the session's warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_frozen"


def own_path(spark: SparkSession, prefix: str) -> str:
    """A new path in the shared folder that the current owner drops."""
    path = f"{checkpoint_root(spark)}/{prefix}-{uuid.uuid4().hex}"
    _owner.get().paths.append(path)
    return path


def freeze(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it.

    Cuts lineage (a lost executor costs no recomputation of the input), lets several jobs read one
    result, and keeps column pruning and filter pushdown for those readers.
    """
    path = own_path(df.sparkSession, "frozen")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Plan nodes that do no more than read rows and compute columns of them.
_NARROW = {"LogicalRelation", "Relation", "LocalRelation", "LogicalRDD", "Range", "Project", "Filter", "SubqueryAlias", "View"}


def _nodes(plan) -> Iterator[str]:
    yield plan.nodeName()
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def shared(df: DataFrame, *cheap: str) -> DataFrame:
    """``df`` for several readers: frozen if computing it takes more than a scan, whatever its size.

    ``cheap`` names further plan nodes that the readers do not mind.
    """
    known = _NARROW.union(cheap)
    return df if all(n.split(" ")[0] in known for n in _nodes(df._jdf.queryExecution().analyzed())) else freeze(df)


def freeze_ranges(df: DataFrame, order: list, piece: str, ranges: int) -> DataFrame:
    """``df`` in ``ranges`` pieces that follow each other in ``order``; the column ``piece`` numbers them.

    Frozen, because the bounds come from a sample. A piece is one file of one row group, which no scan splits.
    """
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return freeze(placed.withColumn(piece, F.spark_partition_id()), **{"parquet.block.size": 1 << 30})


def drop_frozen(spark: SparkSession) -> int:
    """Delete the frozen tables that belong to no query of their own; returns how many."""
    return _everyone.drop(spark)
