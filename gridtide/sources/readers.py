"""Sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.sources.records import records

CORRUPT = "_corrupt"
#: files as most programs write them: a header, and doubled quotes
CSV = {"header": True, "quote": '"', "escape": '"'}

# fixed values: columns of the raw observation file, in file order
OBSERVATIONS = (
    "county INT, is_business INT, product_type INT, target DOUBLE, is_consumption INT, datetime TIMESTAMP_NTZ, "
    "data_block_id BIGINT, row_id BIGINT, prediction_unit_id INT"
)


def _as_schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def parse_observations(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType = OBSERVATIONS, multi_line: bool = False
) -> DataFrame:
    """All lines of headed CSV files: the declared columns, and the text of a line that does not fit them in ``_corrupt``.

    A quote inside a quoted field is doubled. With ``multi_line`` quoted fields may hold line breaks (see
    :func:`~gridtide.sources.records.records`); a file is read by many tasks either way.
    """
    declared = _as_schema(schema)
    if multi_line:
        return _parse_records(records(spark, path), declared)
    return (
        spark.read.schema(T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())]))
        .options(**CSV, multiLine=multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        # a line is good or bad as a whole, whichever columns the query goes on to use
        .option("columnPruning", False)
        .csv(path)
    )


def _parse_records(found: DataFrame, declared: T.StructType) -> DataFrame:
    """Records as the declared columns; the first of each file must hold their names."""
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(declared) + 1)])
    options = {k: str(v) for k, v in CSV.items() if k != "header"}
    header = F.from_csv("record", names.simpleString()[len("struct<") : -1].replace(":", " "), options)
    wanted = [f.name.lower() for f in declared]
    same = F.lower(F.concat_ws("\n", *[header[f"c{i}"] for i in range(len(declared) + 1)])) == F.lit("\n".join(wanted))
    other = F.raise_error(F.concat(F.lit("other columns than declared: "), "record"))
    # within the text that is parsed: a condition beside it could be passed over
    data = F.when(~F.col("first"), F.col("record")).when(F.coalesce(same, F.lit(False)), F.lit(None)).otherwise(other)
    full = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    parsed = F.from_csv(data, ddl, {**options, "columnNameOfCorruptRecord": CORRUPT})
    return found.select(parsed.alias("p")).filter(F.col("p").isNotNull()).select("p.*")


def _reads_data(parsed: DataFrame) -> Column:
    """Always true, but uses every declared column: Spark tells a bad line by the columns that it reads only."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in parsed.columns if c != CORRUPT]) >= F.lit(-(1 << 63))


def good_lines(parsed: DataFrame) -> DataFrame:
    """Typed rows of :func:`parse_observations`; NaN is read as null."""
    floats = [f.name for f in parsed.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    rows = parsed.filter(_reads_data(parsed) & F.col(CORRUPT).isNull()).drop(CORRUPT)
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(_reads_data(parsed) & F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_observations(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType = OBSERVATIONS,
    rejects: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Typed rows of headed CSV files, checked against the declared schema. NaN is read as null.

    A line that does not fit is left out here and returned, as text in ``_corrupt``, by ``rejects=True``. ``multi_line`` as in
    :func:`parse_observations`.
    """
    parsed = parse_observations(spark, path, schema, multi_line)
    return bad_lines(parsed) if rejects else good_lines(parsed)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_lookup_json(spark: SparkSession, path: str, key: str = "id", value: str = "name") -> DataFrame:
    """A JSON file that holds one flat object, as a two-column table."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def list_stage(spark: SparkSession, path: str) -> DataFrame:
    """Files under a location: path, length, modification time. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", "modificationTime")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
