"""Runs of words that repeat with a period: found from occurrences of dyadic blocks in the windows beside them.

A run of period q that holds four periods holds a block of b = 2^k words, q <= b < 2q, that starts at a multiple of b, and has a period to spare on one
side of it. There the block occurs again at distance q, and nearer nowhere: in a stretch of period q, occurrences of a block as long as the period
are an arithmetic progression with difference q. So the nearest occurrences after and before each block, if at a distance over b/2 and up to b,
give every period there is. They are found over the suffix array: equal blocks are an interval of it, and a wavelet matrix on its
positions answers the first position after (or before) a place within an interval. Neighbouring blocks with the same distance are put together
and extended word by word to where the period ends, which also tells whether they are a run.

Blocks with a word that does not recur within b words on either side are in no run of such a period and are not asked; texts without any block left
need no suffix array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm.bpe import sliced
from gridtide.llm.common import ship

#: periods that a run has at least, and its fewest words
PERIODS = 4
FEWEST = 6
#: bytes of a batch of rows, and of texts that share a suffix array
BATCH_BYTES = 8 << 20
TOGETHER = 1 << 20


class WaveletMatrix:
    """The bits of whole numbers, the highest first, each level sorted stably by the bit above: counts and selections within intervals."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, int(values.max(initial=0)).bit_length())
        self.zeros, self.before = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            # zeros before each place
            self.before.append(np.concatenate([[0], np.cumsum(~bit, dtype=np.int32)]))
            self.zeros.append(int(self.before[-1][-1]))
            values = np.concatenate([values[~bit], values[bit]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers in places lo to hi (exclusive) are less than x."""
        found = np.where(x >> self.levels > 0, hi - lo, 0)
        inside = x >> self.levels == 0
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            lo0, hi0 = self.before[i][lo], self.before[i][hi]
            one = (x >> level & 1).astype(bool)
            found = found + np.where(one & inside, hi0 - lo0, 0)
            lo, hi = np.where(one, self.zeros[i] + lo - lo0, lo0), np.where(one, self.zeros[i] + hi - hi0, hi0)
        return found

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest number (from 0) in places lo to hi; k must be in the interval."""
        value = np.zeros(len(k), np.int64)
        for i in range(self.levels):
            lo0, hi0 = self.before[i][lo], self.before[i][hi]
            one = k >= hi0 - lo0
            k = np.where(one, k - (hi0 - lo0), k)
            value = value << 1 | one
            lo, hi = np.where(one, self.zeros[i] + lo - lo0, lo0), np.where(one, self.zeros[i] + hi - hi0, hi0)
        return value

    def neighbours(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range predecessor and successor of x, which is in the interval itself; -1 where there is none."""
        at = self.below(lo, hi, x)
        before, after = np.full(len(x), -1, np.int64), np.full(len(x), -1, np.int64)
        some = at > 0
        before[some] = self.nth(lo[some], hi[some], at[some] - 1)
        some = at + 1 < hi - lo
        after[some] = self.nth(lo[some], hi[some], at[some] + 1)
        return before, after


def _classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first, count): for each place in order, where its class of equal keys begins and how many it has."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(begin, len(keys)))
    return order, np.repeat(begin, count), np.repeat(count, count)


def _suffix_array(words: np.ndarray, blocks: dict[int, np.ndarray]) -> tuple[np.ndarray, dict[int, tuple]]:
    """The suffix array by doubling, and for each level k the interval (lo, hi) of the suffixes that begin with the same 2^k words as each block.

    The rank of a suffix is the number of those that are smaller by their first 2^k words; what has a rank of its own is not sorted again.
    """
    n = len(words)
    rank, count = np.empty(n, np.int64), np.empty(n, np.int64)
    order, first, size = _classes(words)
    rank[order], count[order] = first, size
    intervals, k = {}, 0
    while True:
        if k in blocks:
            intervals[k] = rank[blocks[k]], rank[blocks[k]] + count[blocks[k]]
        open_ = np.flatnonzero(count > 1)
        if not len(open_):
            suffixes = np.empty(n, np.int64)
            suffixes[rank] = np.arange(n)
            return suffixes, intervals
        ahead = open_ + (1 << k)
        key = rank[open_] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order, first, size = _classes(key)
        old = rank[open_[order]]
        # a class keeps its places: what was before it in its class of the level before still is
        begin = np.searchsorted(old, old, "left")
        place = open_[order]
        rank[place], count[place] = old + first - begin, size
        k += 1


def _recurrence(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words to the nearest equal one in the same text, either way."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    far = np.full(n, n + 1, np.int64)
    same = np.flatnonzero(words[order[:-1]] == words[order[1:]])
    a, b = order[same], order[same + 1]
    within = ends[a] == ends[b]
    a, b = a[within], b[within]
    gap = b - a
    far[a] = gap
    far[b] = np.minimum(far[b], gap)
    return far


def _candidates(starts: np.ndarray, ends: np.ndarray, far: np.ndarray) -> dict[int, np.ndarray]:
    """By level, the starts of blocks of 2^k words, at multiples of 2^k from the start of their text, whose words all recur near enough."""
    blocks, k = {}, 0
    at = np.arange(len(far), dtype=np.int64)
    worst = far
    # at: starts of blocks; worst: the largest distance in each
    while len(at):
        b = 1 << k
        chosen = at[worst <= b]
        if len(chosen):
            # such a run is a stretch of words that all recur near enough
            limits = np.concatenate([[-1], np.flatnonzero(far > b), [len(far)]])
            behind = np.searchsorted(limits, chosen)
            room = np.minimum(limits[behind], ends[chosen]) - np.maximum(limits[behind - 1] + 1, starts[chosen])
            chosen = chosen[room >= max(FEWEST, PERIODS * (b // 2 + 1))]
        if len(chosen):
            blocks[k] = chosen
        # two blocks, the first at an even multiple, are one of the next level
        pair = np.flatnonzero((at[:-1] - starts[at[:-1]]) % (2 * b) == 0)
        pair = pair[(at[pair + 1] == at[pair] + b) & (starts[at[pair + 1]] == starts[at[pair]])]
        at, worst = at[pair], np.maximum(worst[pair], worst[pair + 1])
        k += 1
        # texts too short for four periods over b / 2
        wide = ends[at] - starts[at] >= max(FEWEST, PERIODS * (b + 1))
        at, worst = at[wide], worst[wide]
    return blocks


def _stretch(words: np.ndarray, u: int, v: int, d: int, start: int, end: int) -> tuple[int, int]:
    """The largest [u, v) around the given one in which each word equals the one d later, within a text."""
    step = max(16, d)
    while u > start:
        back = max(start, u - step)
        differ = np.flatnonzero(words[back:u] != words[back + d : u + d])
        if len(differ):
            u = back + int(differ[-1]) + 1
            break
        u, step = back, step * 2
    step = max(16, d)
    while v < end - d:
        ahead = min(end - d, v + step)
        differ = np.flatnonzero(words[v:ahead] != words[v + d : ahead + d])
        if len(differ):
            v += int(differ[0])
            break
        v, step = ahead, step * 2
    return u, v


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each text, given as numbers of its words, its runs (start, length, period) by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return found
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    words = np.concatenate(texts).astype(np.int64)
    starts, ends = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    left = _candidates(starts, ends, _recurrence(words, ends))
    if not left:
        return found
    # only texts with a block left; a word of its own ends each
    of = np.repeat(np.arange(len(texts)), sizes)
    used = np.unique(np.concatenate([of[b] for b in left.values()]))
    shift = np.zeros(len(texts), np.int64)
    new_start = np.concatenate([[0], np.cumsum(sizes[used] + 1)])
    shift[used] = new_start[:-1] - bounds[used]
    ends_of_texts = -1 - np.arange(len(used))
    words = np.concatenate([part for i, e in zip(used, ends_of_texts, strict=True) for part in (words[bounds[i] : bounds[i + 1]], [e])])
    blocks = {k: at + shift[of[at]] for k, at in left.items()}
    suffixes, intervals = _suffix_array(words, blocks)
    matrix = WaveletMatrix(suffixes)
    number = np.repeat(np.arange(len(used)), sizes[used] + 1)
    for k, (lo, hi) in intervals.items():
        b, at = 1 << k, blocks[k]
        again = hi - lo > 1
        at, lo, hi = at[again], lo[again], hi[again]
        if not len(at):
            continue
        before, after = matrix.neighbours(lo, hi, at)
        # (first place, distance): b words from there equal those a distance later
        ahead = (after >= 0) & (after - at <= b) & (2 * (after - at) > b)
        back = (before >= 0) & (at - before <= b) & (2 * (at - before) > b)
        u = np.concatenate([at[ahead], before[back]])
        d = np.concatenate([after[ahead] - at[ahead], at[back] - before[back]])
        order = np.lexsort((u, d, number[u]))
        u, d = u[order], d[order]
        if not len(u):
            continue
        text = number[u]
        # what touches, of one distance and text, is one stretch
        apart = np.concatenate([[True], (text[1:] != text[:-1]) | (d[1:] != d[:-1]) | (u[1:] > u[:-1] + b)])
        first = np.flatnonzero(apart)
        last = np.append(first[1:], len(u)) - 1
        done: tuple[int, int, int] | None = None
        for i, j in zip(first.tolist(), last.tolist(), strict=True):
            t, q = int(text[i]), int(d[i])
            if done is not None and done[:2] == (t, q) and int(u[i]) < done[2]:
                continue  # within the stretch before
            begin, end = int(new_start[t]), int(new_start[t + 1]) - 1
            left_end, right_end = _stretch(words, int(u[i]), int(u[j]) + b, q, begin, end)
            done = t, q, right_end
            length = right_end - left_end + q
            if length >= max(FEWEST, PERIODS * q):
                found[int(used[t])].append((left_end - begin, length, q))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _searched(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    words = [t.split() for t in texts]
    numbers = _Numbers()
    coded = [np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)) for ws in words]
    for ws, runs in zip(words, find_runs(coded), strict=True):
        yield runs, b" ".join(_collapsed(ws, runs)).decode("utf-8", "replace")


def with_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) by start, then period, and ``collapsed``, the text without what runs repeat.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words with smallest period q (words q apart are the same) and length at
    least ``max(FEWEST, PERIODS * q)`` that no word beside it extends with the same period; runs of different periods may overlap. ``collapsed`` are the
    words that are in no run after its first q words, joined by blanks.

    A null text has no words: no runs, and collapsed it is empty. Ids are not looked at, rows that are repeated are searched each for itself, and equal
    texts get equal runs. Bytes that are not UTF-8 are compared as they are and returned as U+FFFD. Texts are searched whole, a long one by one task, in
    memory of some hundred bytes for each of its words. An empty table gives no rows. Columns of ``docs`` named ``runs`` or ``collapsed`` are replaced.
    """
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text_col, "runs", "collapsed")]
    # the text travels as bytes: Arrow takes no string that is not UTF-8
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(text_col).cast("string").cast("binary").alias(text_col))
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    made = [T.StructField(text_col, T.StringType()), T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def search(batches):
        for full in batches:
            for batch in sliced(full, text_col, BATCH_BYTES):
                texts, found = batch.column(text_col).to_pylist(), []
                held, size = [], 0
                for text in texts:
                    held.append(text or b"")
                    size += len(held[-1])
                    if size >= TOGETHER:
                        found += _searched(held)
                        held, size = [], 0
                found += _searched(held)
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs, _ in found]
                whole = [None if t is None else t.decode("utf-8", "replace") for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in others], pa.array(whole, pa.string()), pa.array(runs, kind), pa.array([c for _, c in found], pa.string())],
                    [*others, text_col, "runs", "collapsed"],
                )

    found = rows.mapInArrow(search, T.StructType([*[f for f in rows.schema if f.name != text_col], *made]))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("runs", "collapsed")], "runs", "collapsed")


def with_planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids and texts of ``docs``, one text in ten, chosen by its id, made periodic from some word on; the others, and rows without id, as they are.

    With h the CRC-32 of the id and g = h div 10, texts of n > 0 words with h divisible by ten have at each word i >= a, a = g mod n, the word
    a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    made = F.expr(
        "transform(_w, (w, i) -> if(i < _a, w, element_at(_w, cast(_a + (i - _a) % (1 + (size(_w) - _a) div (3 + _g % 8)) as int) + 1)))"
    )
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        F.call_function("div", h, F.lit(10)).alias("_g"),
        F.when(h % 10 == 0, words).alias("_w"),
    ).withColumn("_a", F.col("_g") % F.nullif(F.size("_w"), F.lit(0)))
    text = F.when(F.size("_w") > 0, F.array_join(made, " ")).otherwise(F.col("_text"))
    return rows.select(F.col("_id").alias(id_col), text.alias(text_col))


def digests(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of rows of ``with_runs``; the run is the longest,
    then the first, then the one with the smallest period, and null without runs."""
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length as size, r.start as start, r.period as period, r.length as length)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return rows.select(id_col, "runs", "collapsed", longest.alias("_best")).select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
