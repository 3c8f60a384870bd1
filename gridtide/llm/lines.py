"""Repeated lines by two Bloom filters.

One pass over the texts puts the hash of each line's key into a filter of keys seen once and, if it is there already, into one of keys seen twice.
Only lines whose key passes the second filter are shuffled, as a digest of the key with the places in their document; documents are counted for each
key exactly, and lines of keys with enough documents go. So a filter that is too small for its table costs a larger shuffle and no line.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm import bloom
from gridtide.llm.bpe import sliced
from gridtide.llm.common import keyed, ship, stage

#: what a line is stripped of
WHITE = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
MIN_CHARS = 1
#: lines of a document, as a guess for the size of the filters
LINES = 16
KEEP = ("none", "first")
#: texts of a batch of rows, in bytes
BATCH_BYTES = 8 << 20


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def keys_of(text: bytes) -> list[bytes]:
    """The key of each line: stripped of ASCII white space, A-Z lower-cased."""
    return [line.strip(WHITE) for line in text.lower().split(b"\n")]


def _name(key: bytes) -> bytes:
    """A short key as it is, a longer one as its SHA-256, which is longer than any short one."""
    return key if len(key) < 32 else hashlib.sha256(key).digest()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").to_pylist()]


def _suspects(rows: DataFrame, row: str, text_col: str, min_chars: int, bits: int | None) -> DataFrame:
    """(row, key, lines): the lines whose key may be in two documents, by the filter of keys seen twice."""
    spark = rows.sparkSession
    bits = bits or bloom.bits_for(rows.count() * LINES)

    def see(batches):
        seen = bloom.Seen(bits)
        for whole in batches:
            for batch in sliced(whole, "text", BATCH_BYTES):
                # a document's keys once each
                hashes = [xxhash.xxh3_64_intdigest(k) for t in _texts(batch) for k in set(keys_of(t)) if _long_enough(k, min_chars)]
                seen.meet(np.array(hashes, np.uint64))
        yield from seen.parts()

    texts = rows.select(F.col(row).alias("row"), F.col(text_col).cast("string").cast("binary").alias("text"))
    _, twice = bloom.merged(texts.select("text").mapInArrow(see, bloom.SCHEMA), bits)
    filter_ = spark.sparkContext.broadcast(twice.tobytes())

    def suspect(batches):
        twice = np.frombuffer(filter_.value, np.uint8)
        for whole in batches:
            for batch in sliced(whole, "text", BATCH_BYTES):
                at, keys, lines = [], [], []
                for i, text in enumerate(_texts(batch)):
                    places: dict[bytes, list[int]] = {}
                    for place, key in enumerate(keys_of(text)):
                        if _long_enough(key, min_chars):
                            places.setdefault(key, []).append(place)
                    at += [i] * len(places)
                    keys += places.keys()
                    lines += places.values()
                found = np.flatnonzero(bloom.has(twice, np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64))).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(pa.array([at[i] for i in found], pa.int64())),
                        pa.array([_name(keys[i]) for i in found], pa.binary()),
                        pa.array([lines[i] for i in found], pa.list_(pa.int32())),
                    ],
                    ["row", "key", "lines"],
                )

    kind = T.StructType([texts.schema["row"], T.StructField("key", T.BinaryType()), T.StructField("lines", T.ArrayType(T.IntegerType()))])
    return stage(texts.mapInArrow(suspect, kind), "suspects")


def without_repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep: str = "none",
    bits: int | None = None,
) -> DataFrame:
    """``docs`` with the text less its repeated lines, and ``n_lines`` (before) and ``n_dropped``, long.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of ``min_chars`` code points or more that are in
    ``min_docs`` (two at least) or more rows lose all their lines; with ``keep="first"`` the first line of the first row in order of id stays (a null
    id comes first, rows of one id in any order). Other lines stay as they are, joined by newlines.

    Nulls: a null text is one empty line and comes back empty. Rows that are repeated count each for itself. Bytes that are not UTF-8 are kept and
    compared as they are, and returned as U+FFFD. Very long texts are taken whole, by one task each. An empty table gives no rows.
    Columns ``n_lines`` and ``n_dropped`` of ``docs`` are replaced. ``bits`` is the size of a filter, a power of two; by default it follows the number of
    rows up to ``bloom.MOST_BITS``. It decides how much is shuffled, not what is returned.
    """
    if min_docs < 2 or keep not in KEEP:
        raise ValueError(f"min_docs must be at least 2 and keep one of {KEEP}: {min_docs}, {keep!r}")
    ship(docs.sparkSession)
    rows, row = keyed(docs.drop("n_lines", "n_dropped"))
    suspects = _suspects(rows, row, text_col, max(min_chars, 1), bits)
    if keep == "first":
        ids = rows.select(F.col(row).alias("row"), F.col(id_col).alias("id"))
        suspects = stage(suspects.join(ids, "row"), "suspects-with-ids")
        first = F.min(F.struct("id", "row")).alias("first")
    else:
        first = F.lit(None).alias("first")
    # written, so that both sides of the join are shuffled if it is large, and a hot key can be split
    repeated = stage(suspects.groupBy("key").agg(F.count("*").alias("n"), first).filter(F.col("n") >= min_docs).drop("n"), "repeated")
    lines = F.col("lines")
    if keep == "first":
        lines = F.when(F.col("first.row") == F.col("row"), F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1)))).otherwise(lines)
    drops = suspects.join(repeated, "key").groupBy(F.col("row").alias(row)).agg(F.flatten(F.collect_list(lines)).alias("_drops"))
    drop_col, text = "_drops", "_text"
    while {drop_col, text} & set(rows.columns):
        drop_col, text = drop_col + "_", text + "_"
    drops = stage(drops.withColumnRenamed("_drops", drop_col), "drops")
    # the same join at every size: one shuffle of the texts. They travel as bytes, as Arrow takes no string that is not UTF-8
    whole = rows.join(drops.hint("merge"), row, "left").select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", text_col)],
        F.col(text_col).cast("string").cast("binary").alias(text),
        drop_col,
    )
    others = [f for f in whole.schema if f.name not in (text, drop_col)]

    def cut(batches):
        for full in batches:
            for batch in sliced(full, text, BATCH_BYTES):
                texts, n_lines, n_dropped = [], [], []
                for t, drop in zip(batch.column(text).to_pylist(), batch.column(drop_col).to_pylist(), strict=True):
                    lines = (t or b"").split(b"\n")
                    n_lines.append(len(lines))
                    n_dropped.append(len(drop or ()))
                    if drop:
                        gone = set(drop)
                        lines = [line for i, line in enumerate(lines) if i not in gone]
                    texts.append(b"\n".join(lines).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(f.name) for f in others], pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    [*[f.name for f in others], text, "n_lines", "n_dropped"],
                )

    made = [T.StructField(text, T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    out = whole.mapInArrow(cut, T.StructType([*others, *made]))
    return out.select(*[F.col(text if c == text_col else f"`{c}`").alias(c) for c in [*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped"]])


SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), named AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key FROM named WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), marked AS (
    SELECT doc_id, pos, line, key IN (SELECT key FROM repeated) AS gone FROM named
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
