"""Mixing sources to target weights by systematic sampling.

Each source gets a target: its share of the total by weight, at most a multiple of its own size, the excess shared again among the others. A row
of a source is expected ``target / size`` times; the expected copies are summed along the source in order of row size, one random offset is
added, and a row is emitted once for each whole number that its part of the sum passes. Along rows sorted by size neighbours are alike, so what is
taken comes near the target in words as well as in rows.

Rows are numbered without gathering a source in one task: they are cut into even ranges of (source, size, id), ranges are counted, and numbers
within a range are added to the count of the ranges before. Sums are kept in whole numbers, so they do not depend on the order of adding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import keyed, partitions, stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 42
#: expected copies are whole multiples of 2**-24
BITS = 24


def n_words(text: str = "text"):
    """Number of runs of other characters than the six of ASCII white space; 0 of null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, sid, target) from (source, source_size), one row for each source.

    Sources are in order of code points, null last, and take the weights in turn. A level is found such that min(most * size, level * weight)
    adds up to the total of all sizes: with the sources in order of cap by weight, the level if those before are at their cap rises until the
    first source that is not, and falls from there on.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("sid", F.row_number().over(order))
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1))
    rows = rows.withColumn("cap", (F.col("source_size") * most).cast("double"))
    everything = Window.partitionBy(F.lit(1))
    before = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.sum(F.col("source_size").cast("double")).over(everything).alias("total"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
    )
    level = (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before"))
    rows = rows.withColumn("level", F.max(level).over(everything))
    return rows.select("source", "source_size", "sid", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken): one row for each row of ``docs``; ``taken`` is ``copies`` times ``size``.

    Nulls: a null text has no words, null is a source of its own, a null id comes before all others. Sources without words have target 0 and
    are not taken. Rows that are repeated count each for itself; rows of one source, size and id share what falls to them. An empty table gives
    no rows. ``most`` bounds the copies of each row. The same rows give the same result, in whatever order they come. Other columns are not
    looked at.
    """
    rows = stage(
        docs.select(F.col(id_col).alias("id"), n_words(text_col).alias("size"), F.col(source_col).alias("source")), "sizes"
    )
    wanted = stage(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    # the offset: the first 24 bits of a digest of seed and source
    named = F.coalesce(F.concat(F.lit(f"{seed}:"), "source"), F.lit(f"{seed}"))
    wanted = wanted.select(
        F.col("source").alias("of"), "source_size", "sid", "target",
        F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * (1 << BITS))).otherwise(0).cast("long").alias("step"),
        F.conv(F.substring(F.md5(named), 1, BITS // 4), 16, 10).cast("long").alias("offset"),
    )
    rows = rows.join(wanted, F.col("source").eqNullSafe(F.col("of"))).drop("source", "of")
    rows = stage(
        rows.repartitionByRange(partitions(docs.sparkSession), "sid", "size", "id").withColumn("range", F.spark_partition_id()), "ranges"
    )
    counted = rows.groupBy("sid", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = stage(counted.select("sid", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "range-counts")
    place = F.row_number().over(Window.partitionBy("sid", "range").orderBy("size", "id"))
    rows = rows.withColumn("place", place).join(counted, ["sid", "range"])
    last = F.col("offset") + (F.col("before") + F.col("place")) * F.col("step")
    return rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.shiftright(last, BITS) - F.shiftright(last - F.col("step"), BITS)).alias("copies"),
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs`` with each row as often as it is taken. Ids may be null or repeat: each row is taken for itself."""
    rows, row = keyed(docs)
    # in the same order as by id, and rows with the same id by their number
    named = rows.withColumn(id_col, F.struct(F.col(id_col).alias("id"), F.col(row).alias("row")))
    n = "_n"
    while n in rows.columns:
        n += "_"
    times = copies(named, id_col, **settings).filter("copies > 0").select(F.col("doc_id.row").alias(row), F.col("copies").cast("int").alias(n))
    return rows.join(times, row).withColumn(n, F.explode(F.sequence(F.lit(1), n))).drop(row, n)


SQL = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid, CAST(source_size * {MOST} AS DOUBLE) AS cap FROM sums
), shares AS (
    SELECT *, CAST(CASE (sid - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS DOUBLE) AS weight FROM weighed
), levels AS (
    SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
    FROM shares WINDOW w AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), wanted AS (
    SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target,
           CAST('0x' || substr(md5(coalesce('{SEED}:' || source, '{SEED}')), 1, 6) AS BIGINT) AS start
    FROM levels
), steps AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target / source_size * {1 << BITS}) AS BIGINT) ELSE 0 END AS step FROM wanted
), placed AS (
    SELECT doc_id, size, source_size, target, step,
           start + step * row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) AS last
    FROM sized s JOIN steps t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((last >> {BITS}) - ((last - step) >> {BITS})) AS copies,
       ((last >> {BITS}) - ((last - step) >> {BITS})) * size AS taken
FROM placed
"""
