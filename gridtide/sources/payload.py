"""Split-JSON requests: ``{"dataframe_split": {"columns": [...], "data": [[...], ...]}}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BAD = "_bad"
_REQUEST = (
    f"struct<dataframe_split: struct<columns: array<string>, data: array<array<double>>>, {_BAD}: string>"
)


def to_split_json(
    df: DataFrame, cols: Sequence[str], rows_per_msg: int, order: str, out: str = "payload"
) -> DataFrame:
    """Rows → one request per ``rows_per_msg`` values of the whole-number column ``order``: (``request``, ``payload``).

    Request r holds the rows with ``order`` in [r·rows_per_msg, (r+1)·rows_per_msg), in that order.
    """
    cells = F.array(*[F.col(c).cast("double") for c in cols])
    request = F.floor(F.col(order) / rows_per_msg).alias("request")
    item = F.struct(F.col(order).alias("at"), cells.alias("row"))
    rows = df.groupBy(request).agg(F.array_sort(F.collect_list(item)).alias("rows"))
    body = F.struct(
        F.array(*[F.lit(c) for c in cols]).alias("columns"), F.transform("rows", lambda r: r["row"]).alias("data")
    )
    text = F.to_json(F.struct(body.alias("dataframe_split")), {"ignoreNullFields": "false"})
    return rows.select("request", text.alias(out))


def _problem(body: Column, names: Column, data: Column, expected: Sequence[str]) -> Column:
    """Why a request cannot be scored; null if it can."""
    missing = F.array_except(F.array(*[F.lit(c) for c in expected]), names)
    ragged = F.exists(data, lambda row: row.isNull() | (F.size(row) != F.size(names)))
    return (
        F.when(body.isNull() | names.isNull() | data.isNull(), F.lit("malformed request"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.concat_ws(", ", missing)))
        .when(F.size(F.array_distinct(names)) != F.size(names), F.lit("repeated column"))
        .when(ragged, F.lit("row length differs from the number of columns"))
        .when(F.size(data) == 0, F.lit("no rows"))
    )


def checked_requests(df: DataFrame, col: str, expected: Sequence[str]) -> DataFrame:
    """Add ``names``, ``data`` (null unless usable) and ``error`` (null if usable) to a table of requests."""
    # a damaged text can still parse in part; the parser then keeps it in the column for bad records
    parsed = F.from_json(F.col(col), _REQUEST, {"columnNameOfCorruptRecord": _BAD})
    body = F.col("_gt_body")
    names, data = body["dataframe_split"]["columns"], body["dataframe_split"]["data"]
    out = df.withColumn("_gt_body", parsed)
    error = F.when(body[_BAD].isNotNull(), F.lit("malformed request")).otherwise(_problem(body, names, data, expected))
    out = out.withColumn("error", error)
    usable = F.col("error").isNull()
    return out.withColumns({"names": F.when(usable, names), "data": F.when(usable, data)}).drop("_gt_body")


def from_split_json(df: DataFrame, col: str, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Requests → rows: (keep…, ``row``, expected…, ``error``).

    Values go to columns by the names in the request; other names are ignored. A request that cannot be used gives one row with
    its error.
    """
    asked = checked_requests(df, col, expected)
    # one error row, or a row per data row
    items = F.when(F.col("error").isNull(), F.col("data")).otherwise(F.array(F.lit(None).cast("array<double>")))
    rows = asked.select(*keep, "names", "error", F.posexplode(items).alias("row", "_gt_cells"))
    cells = [
        F.get(F.col("_gt_cells"), (F.array_position("names", c) - 1).cast("int")).alias(c) for c in expected
    ]
    return rows.select(*keep, F.when(F.col("error").isNull(), F.col("row")).alias("row"), *cells, "error")
