"""Exact duplicates by deterministic naming of blocks: equal names if and only if equal texts, with DataFrame operations only.

A text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted and take integers as names; then the names of adjacent blocks
are paired and the distinct pairs sorted and named in turn, until one name is left. The name, with the number of rounds it took, identifies the
text: no hash decides equality.

The text is written once, in blocks, as a stage table, and shuffled once, to sort it. Blocks that many rows share would meet in one task:
those with more than a quarter of a partition's rows (there are at most four for each partition) are reduced to distinct ones before the
shuffle and joined back, where adaptive execution splits what is skewed. The hash of a block only says where it is sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import keyed, numbered, partitions, stage

BLOCK_BYTES = 4096
#: stands for the missing partner of a last, odd name
NOTHING = -(1 << 62)


def _blocks(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(row, doc, sha, n, pos, block, h): the whole text of each row in blocks; an empty text is one empty block."""
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("t"))
    return (
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc",
            F.sha2("t", 256).alias("sha"),
            F.expr(
                f"transform(sequence(0, greatest(cast(ceil(octet_length(t) / {size}) as int) - 1, 0)), i -> substring(t, i * {size} + 1, {size}))"
            ).alias("blocks"),
        )
        .select("row", "doc", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block"))
        .withColumn("h", F.xxhash64("block"))
    )


def _name_blocks(blocks: DataFrame) -> DataFrame:
    """(row, pos, n, name): equal names for equal blocks."""
    parts = partitions(blocks.sparkSession)
    most = max(blocks.count() // (4 * parts), 64)
    # at most four for each partition
    hot = [row.h for row in blocks.groupBy("h").count().filter(F.col("count") > most).select("h").collect()]
    is_hot = F.col("h").isin(hot) if hot else F.lit(False)
    cold = blocks.filter(~is_hot).withColumn("bucket", F.pmod("h", F.lit(64 * parts)))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("block"))
    cold = cold.select("row", "pos", "n", (F.col("bucket") * F.lit(1 << 32) + rank).alias("name"))
    if not hot:
        return cold
    shared = stage(blocks.filter(is_hot).select("row", "pos", "n", "block"), "shared-blocks")
    named = stage(numbered(shared.select("block").distinct(), "block", into="name"), "block-names")
    return cold.union(shared.join(named, "block").select("row", "pos", "n", (-1 - F.col("name")).alias("name")))


def _name_pairs(names: DataFrame) -> DataFrame:
    """One round: names of adjacent names."""
    even = F.col("pos") % 2 == 0
    pairs = names.groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
        F.max(F.when(even, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NOTHING)).alias("b"),
        F.max(F.expr("(n + 1) div 2").cast("int")).alias("n"),
    )
    pairs = stage(pairs, "pairs")
    named = stage(numbered(pairs.select("a", "b").distinct(), "a", "b", into="name"), "pair-names")
    return pairs.join(named, ["a", "b"]).select("row", "pos", "n", "name")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, doc, sha, rounds, name) for each row: (rounds, name) is equal for two rows if and only if their texts are."""
    blocks = stage(_blocks(docs, id_col, text_col, block_bytes), "blocks")
    longest = blocks.agg(F.max("n")).first()[0] or 0
    names = stage(_name_blocks(blocks), "names-0")
    whole, rounds = [names.filter("n = 1").select("row", "name", F.lit(0).alias("rounds"))], 0
    while longest > 1:
        longest, rounds = (longest + 1) // 2, rounds + 1
        names = stage(_name_pairs(names.filter("n > 1")), f"names-{rounds}")
        whole.append(names.filter("n = 1").select("row", "name", F.lit(rounds).alias("rounds")))
    rows = blocks.filter("pos = 0").select("row", "doc", "sha")
    return rows.join(reduce(DataFrame.union, whole), "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of ``docs``, dropped ones too.

    Of rows with equal text the one with the largest id stays (a null id is below all others); of rows that are repeated with their id, one.
    A null text counts as empty. Empty texts are equal to each other. An empty table gives no rows. Other columns are not looked at.
    """
    rows = stage(identities(docs, id_col, text_col, block_bytes), "identities")
    # written, so that both sides of the join are shuffled for it and a hot group can be split
    groups = stage(
        rows.groupBy("rounds", "name").agg(F.count("*").alias("group_size"), F.max(F.struct("doc", "row")).alias("keep")), "groups"
    )
    return rows.join(groups, ["rounds", "name"]).select(
        F.col("doc").alias("doc_id"),
        F.col("keep.doc").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` drops.

    Ids may be null or repeat. Of rows with equal text and equal id any one stays, whatever their other columns say.
    """
    rows, row = keyed(docs)
    named = rows.select(F.struct(F.col(id_col).alias("id"), F.col(row).alias("row")).alias("doc"), F.col(text_col).alias("text"))
    kept = exact_duplicates(named, "doc", "text").filter("kept").select(F.col("doc_id.row").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
