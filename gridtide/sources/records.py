"""CSV records that may hold line breaks in quotes, read by as many tasks as a file has ranges.

A line alone does not say whether it begins a record: that depends on whether the lines before it leave a quote open. But each line is a function from
"a quote is open" before it to the same after it, and there are four of these: it can set either state, keep it, or turn it over. Functions compose, so
the state before each line is a running value: the last state that was set, turned over as often as lines have done so since. Lines of a record
meet within their range, where the running values have them already; only what is at the end of a range, or goes on from one before, meets once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.operators.layout import _BUCKET, running
from gridtide.session import stage

# a range is the piece of the running values
_FILE, _RANGE, _AT = "_gt_file", _BUCKET, "_gt_at"
_PAIR = '""'


def _open_after(text: Column) -> Column:
    """Whether a quote is open at the end of a text that starts outside of quotes and has no doubled quotes.

    A quote opens a field only at its start, and the next one closes it; what follows up to the delimiter, and quotes in fields that
    have not started with one, stand for themselves.
    """
    return F.regexp_replace(text, '(^|,)"[^"]*"', "$1_").rlike('(^|,)"[^"]*$')


def _functions(value: Column) -> tuple[Column, Column]:
    """Whether a quote is open after a line, if none was before it and if one was."""
    # doubled quotes, from the left, are text or an empty field
    single = F.replace(value, F.lit(_PAIR), F.lit(""))
    first = F.instr(single, '"')
    # the first quote closes the open field; its rest is text up to the delimiter
    rest = F.concat(F.lit("_"), F.substring(single, first + 1, F.length(single)))
    return _open_after(single), F.when(first == 0, F.lit(True)).otherwise(_open_after(rest))


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, range, place, value, empty, turned, set): the lines of text files in ranges of bytes, each range read by a task.

    ``turned`` tells whether a line turns the state over, ``set`` which one it sets. Written, so that places hold and lines are looked at once.
    """
    rows = spark.read.option("lineSep", "\n").text(path)
    rows = rows.select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_RANGE),
        F.monotonically_increasing_id().alias(_AT),
        F.rtrim(F.col("value"), F.lit("\r")).alias("value"),
    )
    if_closed, if_open = _functions(F.col("value"))
    rows = rows.withColumns({"_empty": F.col("value") == "", "_closed": if_closed, "_open": if_open})
    # turned over: open if it was closed, closed if it was open; set: the same either way
    rows = rows.withColumns(
        {
            "_turned": (F.col("_closed") & ~F.col("_open")).cast("bigint"),
            "_set": F.when(F.col("_closed") == F.col("_open"), F.col("_closed").cast("bigint")),
        }
    ).drop("_closed", "_open")
    return stage(rows, "lines")


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(record, first): the records of CSV files with their line breaks, ``first`` marking the first one of a file; empty lines are no records.

    Line ends are ``\\n`` or ``\\r\\n``, also within quotes, where they come back as ``\\n``. A quote that is never closed takes the rest of its file
    into one record, as in a read by one task.
    """
    rows = lines(spark, path)
    part, order, place = [_FILE], [_RANGE, _AT], F.col(_RANGE)
    rows = running(rows, part, order, {"_turns": ("sum", "_turned")}, place, depth=1)
    # a state that was set, as it would have been at the start of the file
    rows = rows.withColumn("_base", (F.col("_set") + F.col("_turns")) % 2)
    rows = running(rows, part, order, {"_last": ("last", "_base")}, place, inclusive=False, depth=1)
    before = (F.coalesce("_last", F.lit(0)) + F.col("_turns") - F.col("_turned")) % 2
    starts = F.when(before == 0, F.struct(F.col(_RANGE).alias("r"), F.col(_AT).alias("a")))
    rows = rows.withColumn("_start", starts).select(_FILE, _RANGE, _AT, "value", "_empty", "_start")
    rows = running(rows, part, order, {"_record": ("last", "_start")}, place, depth=1)
    # an empty line outside of quotes is nothing
    rows = rows.filter(~F.col("_empty") | F.col("_start").isNull())
    ends = stage(rows.groupBy(_FILE, _RANGE).agg(F.min("_record").alias("_first"), F.max("_record").alias("_last")), "range-ends")
    firsts = ends.groupBy(_FILE).agg(F.min("_first").alias("_first"))
    # no shuffle: the lines of a range are together
    parts = rows.groupBy(_FILE, _RANGE, "_record").agg(_joined(_AT, "value"))
    parts = parts.join(ends.select(_FILE, _RANGE, "_last"), [_FILE, _RANGE])
    whole = (F.col("_record.r") == F.col(_RANGE)) & (F.col("_record") < F.col("_last"))
    cut = parts.filter(~whole).groupBy(_FILE, "_record").agg(_joined(_RANGE, "value"))
    found = parts.filter(whole).select(_FILE, "_record", "value").union(cut)
    return found.join(firsts, _FILE).select(F.col("value").alias("record"), (F.col("_record") == F.col("_first")).alias("first"))


def _joined(place: str, text: str) -> Column:
    """Texts in the order of their places, with line breaks between them."""
    return F.array_join(F.array_sort(F.collect_list(F.struct(place, text)))[text], "\n").alias(text)
