"""Fingerprints by context-triggered piecewise hashing.

A hash of the last seven bytes ends a piece wherever its low bits are all ones, so a change moves the ends of pieces only near itself. The
number of bits, and with it the expected length of a piece (the block size, a power of two), follows from the length of the text: about 64
pieces, fewer bits where the text gives too few ends. Each piece, over all its bytes, becomes a symbol of twelve bits. A fingerprint holds
the symbols at its block size and at twice that; two fingerprints are compared by the edit distance of symbols at a block size that both have.

Bytes are handled a segment at a time; what is kept of a text is its triggers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import partitions, ship

WINDOW = 7
#: pieces that are aimed at; ends there should be at least; a repetitive text may have at most
PIECES, FEWEST, MOST = 64, 24, 512
SEGMENT = 1 << 20
#: ranges of ids for each partition
RANGES = 16
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_PAIRS = [x + y for x in ALPHABET for y in ALPHABET]
_MULTIPLIER, _BASE = np.uint32(0x2C1B3C6D), 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.empty(SEGMENT + 1, np.uint64)
    out[0] = 1
    out[1:] = base
    return np.cumprod(out, dtype=np.uint64)


_tables: list[np.ndarray] = []


def _tables_of_powers() -> list[np.ndarray]:
    if not _tables:
        _tables.extend((_powers(_BASE), _powers(_INVERSE)))
    return _tables


def _ones(data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For each byte, the number of low ones of the hash of the window that ends there; ``before``: bytes that came earlier."""
    a = np.concatenate([before, data]).astype(np.uint32)
    r = a.copy()
    for back in range(1, WINDOW):
        r[back:] += a[:-back] * np.uint32(pow(33, back, 1 << 32)) if back < len(a) else 0
    r = r[len(before) :]
    r ^= r >> np.uint32(15)
    r *= _MULTIPLIER
    r ^= r >> np.uint32(13)
    return np.bitwise_count((r ^ (r + np.uint32(1))) >> np.uint32(1))


def _segments(data: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(whole), SEGMENT):
        yield at, whole[at : at + SEGMENT], _ones(whole[at : at + SEGMENT], whole[max(at - WINDOW + 1, 0) : at])


def fingerprint(data: bytes) -> str:
    """Block size, symbols at that size, symbols at twice that, with colons between; each symbol is two characters."""
    if not data:
        return "1::"
    kept = list(_segments(data)) if len(data) <= SEGMENT else None
    counts = np.zeros(33, np.int64)
    for _, _, ones in kept or _segments(data):
        counts += np.bincount(ones, minlength=33)
    ends = counts[::-1].cumsum()[::-1]  # by number of bits
    bits = max(0, math.ceil(math.log2(len(data) / PIECES)))
    while bits and ends[bits] < FEWEST:
        bits -= 1
    if ends[bits] > MOST:  # one step makes hundreds of ends of none: a repetitive text
        bits += 1
    powers, inverses = _tables_of_powers()
    at_ends, sums, strong = [], [], []
    total = np.uint64(0)
    for at, part, ones in kept or _segments(data):
        found = np.flatnonzero(ones >= bits)
        run = np.cumsum(part * powers[: len(part)], dtype=np.uint64)
        # the sum over a segment counts powers from its start: bring it to the start of the text
        shift = np.uint64(pow(_BASE, at, 1 << 64))
        at_ends.append(found + at)
        sums.append(run[found] * shift + total)
        strong.append(ones[found] > bits)
        total = np.add(total, np.multiply(run[-1:], shift))[0]
    at_ends, sums, strong = np.concatenate(at_ends), np.concatenate(sums), np.concatenate(strong)

    def symbols(chosen: np.ndarray) -> str:
        stops, upto = at_ends[chosen] + 1, sums[chosen]
        if not len(stops) or stops[-1] < len(data):
            stops, upto = np.append(stops, len(data)), np.append(upto, total)
        starts = np.concatenate([[0], stops[:-1]])
        pieces = upto - np.concatenate([np.zeros(1, np.uint64), upto[:-1]])
        if len(data) <= SEGMENT:
            pieces = pieces * inverses[starts]
        else:
            pieces = pieces * np.array([pow(_INVERSE, int(s), 1 << 64) for s in starts], np.uint64)
        pieces ^= pieces >> np.uint64(29)
        return "".join([_PAIRS[s] for s in ((pieces * np.uint64(_BASE)) >> np.uint64(52)).tolist()])

    with np.errstate(over="ignore"):
        return f"{1 << bits}:{symbols(np.full(len(at_ends), True))}:{symbols(strong)}"


def distance(a: list[str] | str, b: list[str] | str) -> int:
    """Edit distance (insert, delete, replace), a column of the table as the bits of two whole numbers."""
    size = min(len(a), len(b))
    same = 0
    while same < size and a[same] == b[same]:
        same += 1
    a, b = a[same:], b[same:]
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, out = mask, 0, len(a)
    for x in b:
        hit = places.get(x, 0)
        level = hit | down
        cross = (((hit & up) + up) ^ up) | hit
        more, less = down | ~(cross | up) & mask, up & cross
        out += bool(more & top) - bool(less & top)
        more, less = (more << 1 | 1) & mask, less << 1 & mask
        up, down = (less | ~(level | more)) & mask, more & level
    return out


def likeness(a: str, b: str) -> float:
    """0 to 1: one less the edit distance by the longer side, at a block size that both fingerprints have; 0 without one."""
    if a == b:
        return 1.0
    (size_a, *of_a), (size_b, *of_b) = a.split(":"), b.split(":")
    sides = {int(size_a) * (i + 1): s for i, s in enumerate(of_a)}
    others = {int(size_b) * (i + 1): s for i, s in enumerate(of_b)}
    best = 0.0
    for size in sides.keys() & others.keys():
        x, y = ([s[i : i + 2] for i in range(0, len(s), 2)] for s in (sides[size], others[size]))
        if x and y:
            best = max(best, 1 - distance(x, y) / max(len(x), len(y)))
    return best


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint): one row for each row of ``docs``; a null text counts as empty."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            prints = [fingerprint(t.encode()) for t in texts]
            yield pa.record_batch(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def edited(text: str, after: str) -> str:
    """A text whose last half (rounded down) is replaced by as many of the first characters of the next one, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _places(docs: DataFrame, ranges: int) -> tuple[np.ndarray, dict[int, int | None], int]:
    """(cuts between ranges of ids, largest id of each range that has rows, range of null ids). All are bounded by the number of ranges."""
    ids = docs.select("id")
    cuts = ids.filter("id IS NOT NULL").approxQuantile("id", [i / ranges for i in range(1, ranges)], 1 / (8 * ranges))
    cuts = np.unique(np.array(cuts, float))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(_range(batch.column(0), cuts))], ["id", "range"])

    tops = ids.mapInArrow(place, "id long, range int").groupBy("range").agg(F.max("id").alias("id")).collect()
    return cuts, {r["range"]: r.id for r in sorted(tops, key=lambda r: r["range"])}, len(cuts) + 1


def _range(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """Ranges count from the largest ids down; null ids come last."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(float)
    return np.where(known, len(cuts) - np.searchsorted(cuts, values, "right"), len(cuts) + 1).astype(np.int32)


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): one row for each row of ``docs``.

    The next document is the one after in descending order of whole-number ids; null ids come last, rows of one id in order of their texts;
    after the last comes the first (a single row is its own next one). A null text counts as empty. Repeated rows are returned as often as
    they come. An empty table gives no rows. Other columns are not looked at.

    Ids are cut into even ranges, a fixed number for each partition; a range gets its rows, and a copy of the first row of the next range.
    So texts are shuffled once, and a task holds two at a time.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    cuts, tops, _ = _places(rows, RANGES * partitions(docs.sparkSession))
    order = list(tops)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first range follows the last

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = _range(batch.column(0), cuts)
            prints = pa.array([fingerprint(t.as_py().encode()) for t in batch.column(1)], pa.string())
            ids = batch.column(0).to_pylist()
            again = [i for i, r in enumerate(ranges.tolist()) if ids[i] == tops[r]]
            all_ranges = np.concatenate([ranges, [before[r] for r in ranges[again].tolist()]]).astype(np.int32)
            out = pa.record_batch([batch.column(0), batch.column(1), prints], ["id", "t", "f"])
            out = pa.concat_batches([out, out.take(pa.array(again, pa.int64()))])
            copy = np.arange(len(all_ranges)) >= len(ranges)
            yield pa.record_batch([*out.columns, pa.array(all_ranges), pa.array(copy)], ["id", "t", "f", "range", "copy"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            out = []
            for i, t, f, r, copy in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r == at and held:
                    own, changed = held, edited(held[1], t).encode()
                    print_changed = fingerprint(changed)
                    out.append(
                        (own[0], len(own[1]), hashlib.sha256(changed).hexdigest(), own[2], print_changed, likeness(own[2], print_changed),
                         likeness(own[2], f))
                    )
                held, at = None if copy else (i, t, f), r
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return (
        rows.mapInArrow(first, "id long, t string, f string, range int, copy boolean")
        .repartition("range")
        .sortWithinPartitions("range", "copy", F.col("id").desc_nulls_last(), "t")
        .mapInArrow(
            second,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
        )
    )
