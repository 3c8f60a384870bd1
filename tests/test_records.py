"""CSV records across ranges of a file: the same as a read by one task, whatever the cuts."""

import random

import pytest
from pyspark.sql import functions as F

from gridtide.operators.layout import _BUCKET
from gridtide.sources import readers
from gridtide.sources.records import records

DDL = "id BIGINT, text STRING, v DOUBLE"


def one_task(spark, path, ddl=DDL):
    schema = readers._as_schema(f"{ddl}, {readers.CORRUPT} STRING")
    return (
        spark.read.schema(schema).options(**readers.CSV, multiLine=True).option("columnNameOfCorruptRecord", readers.CORRUPT)
        .option("enforceSchema", False).option("columnPruning", False).csv(path)
    )


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize("seed", range(3))
def test_quoted_line_breaks_equal_one_task(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    pieces = ["word", '""', "\n", ",", "\n\n", " ", '"",""', ",\n", '""\n', "é", '\n"",']
    for file in range(3):
        out = ["id,text,v"]
        for i in range(60):
            quoted = '"' + "".join(rng.choice(pieces) for _ in range(rng.randrange(12))) + '"'
            plain = rng.choice(["plain", 'in"ch', 'a""b', "x y", "", 'end"', 'm"i"d'])
            out.append(f"{i},{rng.choice([quoted, quoted, plain])},{rng.choice(['1.5', 'NaN', '', 'bad', '2'])}")
            if rng.random() < 0.1:
                out.append("")
        (tmp_path / f"f{file}.csv").write_text("\n".join(out) + "\n")
    path = str(tmp_path)
    parsed = readers.parse_observations(spark, path, DDL, multi_line=True)
    want = one_task(spark, path)
    good = [c for c in want.columns if c != readers.CORRUPT]
    assert rows(parsed.select(*good)) == rows(want.select(*good)) and want.count() == 180
    assert rows(readers.bad_lines(parsed)) == rows(readers.bad_lines(want))


def test_bad_quotes_equal_one_task(spark, tmp_path, small_ranges):
    texts = ['"a"b', '"a" ', '"a"b"', '"a""b"c', '""x', '"" ', '"""x"', 'a"', '"x, y"z']
    body = "".join(f"{i},{t},{i}\n" for i, t in enumerate(texts)) + '77,"never closed,1\n78,b,2\n"79",c,3\n'
    (tmp_path / "bad.csv").write_text("id,text,v\n" + body)
    parsed, want = readers.parse_observations(spark, str(tmp_path), DDL, multi_line=True), one_task(spark, str(tmp_path))
    assert rows(parsed.select("id", "text", "v")) == rows(want.select("id", "text", "v"))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("id,text,v\r\n" + "".join(f'{i},"line\r\nline {i}",0.5\r\n' for i in range(200)))
    found = records(spark, str(tmp_path))
    got = readers.read_observations(spark, str(tmp_path), DDL, multi_line=True)
    assert rows(got) == sorted(str(r) for r in spark.range(200).select("id", F.concat(F.lit("line\nline "), "id").alias("text"), F.lit(0.5).alias("v")).collect())
    assert found.filter("first").count() == 1 and found.count() == 201
    ranges = spark.read.text(str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert ranges > 8


def test_header_is_checked_and_empty_files_are_read(spark, tmp_path):
    (tmp_path / "other.csv").write_text("id,words,v\n1,a,2\n")
    with pytest.raises(Exception, match="other columns than declared"):
        readers.read_observations(spark, str(tmp_path), DDL, multi_line=True).collect()
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "e.csv").write_text("")
    assert readers.read_observations(spark, str(empty), DDL, multi_line=True).count() == 0


def test_lines_of_a_range_meet_without_another_shuffle(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("id,text,v\n" + "".join(f'{i},"a\nb",1\n' for i in range(40)))
    plan = records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    texts = [line for line in plan.splitlines() if "collect_list" in line]
    # first by file, range and record; by file and record only what is cut by a range's end
    assert any("_gt_at" in line for line in texts) and all("_gt_at" not in line or _BUCKET in line.split("collect_list")[0] for line in texts), texts
    got = records(spark, str(tmp_path)).collect()
    assert sorted(r.record for r in got) == sorted(["id,text,v"] + [f'{i},"a\nb",1' for i in range(40)])
