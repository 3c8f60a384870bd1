"""Sinks and stage outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridtide.sources.readers import CORRUPT, CSV, bad_lines, exists, good_lines, parse_observations, read_lookup_json


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a stage has finished writing: its success marker is there."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_stage(
    df: DataFrame | Callable[[], DataFrame],
    path: str,
    force: bool = False,
    partition_by: Sequence[str] = (),
    spark: SparkSession | None = None,
) -> bool:
    """Write a stage output unless a complete one exists; returns whether work was done.

    Pass a function to skip also the planning (and any measuring jobs) of a stage that is already there.
    """
    session = spark or (df.sparkSession if isinstance(df, DataFrame) else SparkSession.getActiveSession())
    if not force and is_complete(session, path):
        return False
    table = df if isinstance(df, DataFrame) else df()
    table.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return True


def write_splits(df: DataFrame, path: str, by: Sequence[str] = ("measure", "split"), force: bool = True) -> bool:
    """One output per measure and side of the split, in one job. Readers that filter on these skip the other files."""
    return write_stage(df, path, force=force, partition_by=by)


def land_raw(
    spark: SparkSession,
    src_dir: str,
    dst: str,
    schemas: Mapping[str, str],
    lookup: str | None = None,
    force: bool = False,
    multi_line: bool = False,
) -> list[str]:
    """Land a drop directory: every CSV file becomes a typed parquet table of the same name, and so does the lookup file.

    ``schemas`` gives the columns per file name (without ``.csv``); a file without an entry is landed with all its columns as text.
    Lines that do not fit their schema go to ``<name>_rejects``, if there are any. ``multi_line``: quoted fields may hold line breaks. Returns
    the names of the tables written now.
    """
    src, dst = src_dir.rstrip("/"), dst.rstrip("/")
    written = []
    for name in sorted(_csv_names(spark, src)):
        source, target = f"{src}/{name}.csv", f"{dst}/{name}"
        ddl = schemas.get(name)
        if ddl is None:
            build = partial(lambda at: spark.read.options(**CSV, multiLine=multi_line).csv(at), source)
            done = write_stage(build, target, force, spark=spark)
        else:
            done = _land_typed(spark, source, target, ddl, force, multi_line)
        written += [name] if done else []
    if lookup is not None:
        name = lookup.rsplit("/", 1)[-1].removesuffix(".json")
        build = partial(read_lookup_json, spark, f"{src}/{lookup}")
        if write_stage(build, f"{dst}/{name}", force, spark=spark):
            written.append(name)
    return written


def _land_typed(spark: SparkSession, source: str, target: str, ddl: str, force: bool, multi_line: bool) -> bool:
    """Bad lines are counted while the good ones are written; the file is read again only if there are some."""
    seen = Observation()
    parsed = parse_observations(spark, source, ddl, multi_line)

    def build() -> DataFrame:
        return good_lines(parsed.observe(seen, F.count(CORRUPT).alias("bad")))

    done = write_stage(build, target, force, spark=spark)
    if done and seen.get["bad"]:
        write_table(bad_lines(parsed), f"{target}_rejects")
    return done


def _csv_names(spark: SparkSession, src: str) -> list[str]:
    """Names in one directory that end in ``.csv``, without it. A name may be a file or a directory of part files."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{src}/*.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [f.getPath().getName().removesuffix(".csv") for f in found or ()]
