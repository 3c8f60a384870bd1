"""Helpers shared by the text operators: stage tables, connected components, hashes."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.session import scratch

ROW_GROUP_BYTES = 4 << 20
#: Spark's setting that a query's shuffle files are removed when it ends, not when the driver next happens to collect its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again.

    Cuts the lineage, so what follows does not compute ``df`` again, and survives lost executors. Row groups are small: a reader holds a
    whole column of one, outside of the heap.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written in this block leaves no shuffle files: stage tables made one after another never hold more than one's shuffles on disk."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: a value of its own for each row, the same each time it is read; ids may be null or repeat.

    Of a table read as it is in files this is the place in its file; anything else is written as a stage table with numbers.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    # nothing but the relation: after a join or a union, a place would no longer be of one row
    if "_metadata" not in docs.columns and docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            return docs.withColumn(name, F.struct("_metadata.file_path", "_metadata.row_index")), name
        except AnalysisException:  # a source without places
            pass
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for an application: functions that run there import it."""
    root = Path(__file__).resolve().parents[1]
    files = {str(p.relative_to(root.parent)): p.read_bytes() for p in sorted(root.rglob("*.py"))}
    mark = hashlib.sha256(repr(files).encode()).hexdigest()[:16]
    if (spark.sparkContext.applicationId, mark) not in _shipped:
        path = Path(tempfile.mkdtemp(prefix="code-"), f"{root.name}-{mark}.zip")  # on the driver, which serves it
        with zipfile.ZipFile(path, "w") as archive:
            for name, data in files.items():
                archive.writestr(name, data)
        spark.sparkContext.addPyFile(str(path))
        _shipped.add((spark.sparkContext.applicationId, mark))


_kept: dict[tuple, object] = {}


def kept(key: tuple, make):
    """In a task: the object of a key, which later tasks of the same worker process find again. One is kept at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """In a task that needs no kept object: free what another operator has left in this worker process."""
    _kept.clear()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, *by: str, into: str) -> DataFrame:
    """Rows in sorted order with a distinct integer each. ``df`` should be distinct on ``by``, so that no range is hot."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(into, F.monotonically_increasing_id())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: rows (``node``, ``root``), root the smallest node, for every node with a link.

    Alternates large-star and small-star steps (each node meets the smallest neighbour) until nothing changes; each round is written as a
    stage table. Neighbours are never gathered: a round is a combined minimum and a join, so hubs are spread by the join's skew handling.
    """
    now = stage(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct(), "edges"
    )
    seen = None
    while True:
        # every neighbour above a node meets the smallest of the node and its neighbours
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stage(
            both.filter("v > u").join(least.repartitionByRange("u"), "u").select("v", F.col("m").alias("u")).distinct(), "large-star"
        )
        # every node and its smaller neighbours meet the smallest of these
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least.repartitionByRange("v"), "v").select(
            F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u")))).alias("e")
        )
        now = stage(small.select("e.v", "e.u").filter("v != u").distinct(), "small-star")
        # a count and two sums of hashes tell whether the links are the ones of the round before
        digest = F.xxhash64("u", "v")
        mark = now.agg(
            F.count("*"), F.sum(F.shiftright(digest, 20)), F.sum(digest.bitwiseAND(F.lit((1 << 40) - 1)))
        ).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )
