"""Near duplicates by SimHash: fingerprints within a few bits meet through the binary Golay code and are linked.

The 64 bits of a fingerprint are cut into three segments of at most 23 bits. The (23, 12) Golay code is perfect: each segment lies within three
bits of exactly one codeword. A segment at distance one or two or less has that codeword as its only key; one at distance three also has the five
codewords at distance four. Two segments that differ in at most two bits then have a key in common (either both decode to one codeword, or the
positions that differ, with the errors, lie in a block of the Steiner system of weight-seven words). Of three segments with four differing bits
in all, at most one differs in more than two; so two fingerprints within four bits share a key in two segments, and meet under a pair of keys of
24 bits. What meets is verified on all 64 bits.

Rows with one fingerprint are one node. Fingerprints that meet are linked by a spanning tree for each key (a search that compares a reached
fingerprint with those not reached yet), never by all pairs; a component of the union of these trees is a component of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import components, keyed, release, ship, stage

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: the generator polynomial of the code, of degree 11
GENERATOR = 0b110001110101
#: bits of the three segments
SEGMENTS = (22, 21, 21)
#: groups up to this size are compared by shifting, larger ones by search
SMALL = 8
#: shingles hashed at a time
PIECE = 1 << 16


# fingerprints


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the whole text: a bit is 1 if it is set in over half of the hashes of the word shingles; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and the six white-space characters of ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    starts, ends = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    hashed, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        piece = zip(starts[at : at + PIECE], ends[at : at + PIECE], strict=True)
        h = np.array([hashed(joined[s:e], SEED) for s, e in piece], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc, fp): the fingerprint of each row as a signed long."""

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc", "fp"])

    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc {texts.schema['doc'].dataType.simpleString()}, fp long")


# keys


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """(remainder of each 23-bit word by bytes, key offsets by remainder).

    The upper 12 bits of a codeword name it. ``offsets[r]`` are what to xor to a word's upper 12 bits to name its codewords: one, or six.
    """
    by_byte = np.array([[_remainder(byte << shift & 0x7FFFFF) for byte in range(256)] for shift in (0, 8, 16)], np.int32)
    sevens = {}  # of three positions, the codewords of weight seven that hold them
    for message in range(1 << 12):
        word = message << 11 | _remainder(message << 11)
        if word.bit_count() == 7:
            ones = [i for i in range(23) if word >> i & 1]
            for three in combinations(ones, 3):
                sevens.setdefault(three, []).append(word)
    offsets = np.full((1 << 11, 6), -1, np.int32)
    for weight in range(4):
        for error in combinations(range(23), weight):
            pattern = sum(1 << i for i in error)
            near = [pattern] + ([pattern ^ w for w in sevens[error]] if weight == 3 else [])
            offsets[_remainder(pattern), : len(near)] = [x >> 11 for x in near]
    return by_byte, offsets


def segment_keys(segments: np.ndarray) -> np.ndarray:
    """Names of the codewords of each segment: rows of six, filled with -1."""
    by_byte, offsets = golay()
    rest = by_byte[0][segments & 255] ^ by_byte[1][segments >> 8 & 255] ^ by_byte[2][segments >> 16]
    near = offsets[rest]
    return np.where(near < 0, -1, (segments >> 11)[:, None] ^ near)


def pair_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of its fingerprint): for each two segments, each pair of their codewords."""
    keys, shift, out = [], 0, ([], [])
    for bits in SEGMENTS:
        keys.append(segment_keys((fps >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int32)))
        shift += bits
    for number, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        a, b = keys[i][:, :, None], keys[j][:, None, :]
        at, x, y = np.nonzero((a >= 0) & (b >= 0))
        out[0].append(np.int64(number) << 24 | keys[i][at, x].astype(np.int64) << 12 | keys[j][at, y])
        out[1].append(at)
    return np.concatenate(out[0]), np.concatenate(out[1])


# links


def spanning_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the graph that has a link for any two within ``max_bits``."""
    rest, a, b, reached = fps, [], [], []
    while len(rest) or reached:
        if not reached:
            reached, rest = [rest[:1]], rest[1:]
        head = reached.pop()
        for fp in head:
            near = np.bitwise_count(rest ^ fp) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                a.append(np.repeat(fp, len(found)))
                b.append(found)
                reached.append(found)
            if not len(rest):
                reached.clear()
                break
    none = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _group_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups of equal keys; ``keys`` is sorted."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    a, b = [], []
    big = sizes > SMALL
    small = np.repeat(~big, sizes)
    k, f = keys[small], fps[small]
    for step in range(1, int(sizes[~big].max(initial=1))):
        near = (k[step:] == k[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= max_bits)
        a.append(f[:-step][near])
        b.append(f[step:][near])
    for s, n in zip(starts[big], sizes[big], strict=True):
        x, y = spanning_links(fps[s : s + n], max_bits)
        a.append(x)
        b.append(y)
    if not a:
        return fps[:0], fps[:0]
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): fingerprints within ``max_bits`` bits, enough of them to connect all that are. ``distinct`` has a column fp, each value once."""
    if max_bits > 5:
        raise ValueError("keys are sure to meet up to five bits only")
    ship(distinct.sparkSession)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                keys, rows = pair_keys(part.view(np.uint64))
                yield pa.record_batch([pa.array(keys.astype(np.int32)), pa.array(part[rows])], ["key", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        keys, fps = np.empty(0, np.int32), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last group may go on
            if whole:
                yield out(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield out(keys, fps)

    def out(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = _group_links(keys, fps, max_bits)
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return (
        distinct.select("fp")
        .mapInArrow(key, "key int, fp long")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(meet, "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits. ``component_id`` is the smallest id that can be reached over links of at most ``max_bits``
    differing bits, the row itself included. A null text counts as empty; texts without words have fingerprint zero and are linked like any
    others. A null id gets a fingerprint and its component, and is not chosen as one unless no other id is there. Repeated rows are
    returned as often as they come. An empty table gives no rows. Other columns are not looked at.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc").alias("first")), "distinct-fingerprints")
    roots = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    nodes = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("first").alias("component"))
    named = stage(nodes.join(least.repartitionByRange("root"), "root").select("fp", "component"), "components")
    return prints.join(named, "fp").select(
        F.col("doc").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Ids may be null, which is above all others, or repeat; of rows of a component with the same id any one stays.
    """
    rows, row = keyed(docs)
    name = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    named = rows.select(name.alias("doc"), F.col(text_col).alias("text"))
    kept = near_duplicates(named, "doc", "text").filter("doc_id.row = component_id.row").select(F.col("doc_id.row").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)
