"""Frequent phrases and how firmly their words belong together, by a sample and its negative border.

A sample of the documents proposes phrases at a lowered threshold. One pass over all documents then counts exactly: all words, and every longer
phrase whose two shorter parts (without its last and without its first word) were proposed. These are the proposed phrases and their negative
border, the smallest phrases that were not proposed. If one of the border is frequent, a longer phrase may have been missed: the border is expanded by
all phrases that may be frequent by what is known of their parts, each part being found frequent or not counted yet. That set holds the extensions
of its own members too, so one more pass over all documents closes it, whatever the sample was. Every number is a count over all documents.

Tasks know the proposed phrases as a Bloom filter of bounded size. What passes it without reason is counted without need, and exactly.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm import bloom
from gridtide.llm.bpe import sliced
from gridtide.llm.common import ship, stage

MIN_COUNT = 10
LONGEST = 3
#: a phrase is dropped if a longer one has this share of its occurrences, in hundredths
COVERED = 50
TOP = 2000
#: one document in so many is in the sample
SAMPLE = 8
UNKNOWN = "und"
#: words counted together in a task, and bytes of a text taken at once
CHUNK = 1 << 19
SEGMENT = 8 << 20
#: distinct words known at a time; their numbers have 21 bits, so three make a whole number
WORDS = 1 << 18
_WORD_BITS = 21
#: ends a piece; no byte of a text
_END = b"\xff"


def _table() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in b".,;:!?\x0a\x0b\x0c\x0d":
        table[c] = _END[0]
    return bytes(table)


_TABLE = _table()


def _segments(text: bytes, size: int = SEGMENT) -> Iterator[list[bytes]]:
    """The words of a text, with ``_END`` between pieces; a long text in segments that end with a piece."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = text.find(_END, at + size) if len(text) - at > size else -1
        end = len(text) if end < 0 else end
        # of ASCII white space only blanks and tabs are left
        yield text[at:end].replace(_END, b" \xff ").split()
        at = end


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of what comes first and of the last word."""
    return bloom.mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang + b"\0" + word)


class _Known:
    """Words of a chunk by number, with the number of their language, hash and length; number 0 ends pieces."""

    def __init__(self):
        self.words, self.of, self.hashes, self.lengths = [b""], array("i", [0]), array("Q", [0]), array("q", [0])
        self.bytes = 0


class _Words(dict):
    """Numbers of the words of one language within a chunk."""

    def __init__(self, known: _Known, lang: bytes, number: int):
        super().__init__({_END: 0})
        self.known, self.lang, self.number = known, lang, number

    def __missing__(self, word: bytes) -> int:
        known = self.known
        self[word] = at = len(known.words)
        known.words.append(word)
        known.of.append(self.number)
        known.hashes.append(_word_hash(self.lang, word))
        known.lengths.append(len(word))
        known.bytes += len(word)
        return at


class Chunk:
    """Words of some documents, to be counted together."""

    def __init__(self):
        self.known, self.langs, self.by_lang, self.ids, self.n = _Known(), [], {}, array("i", [0]), np.zeros(0, np.int64)

    def add(self, lang: bytes, words: list[bytes]) -> None:
        numbers = self.by_lang.get(lang)
        if numbers is None:
            numbers = self.by_lang[lang] = _Words(self.known, lang, len(self.langs))
            self.langs.append(lang)
        self.ids.extend(map(numbers.__getitem__, words))
        self.ids.append(0)

    def full(self) -> bool:
        return len(self.ids) >= CHUNK or self.many()

    def many(self) -> bool:
        """Whether it knows so many words that it should be replaced."""
        return len(self.known.words) >= WORDS or self.known.bytes >= 4 * SEGMENT

    def words(self) -> Iterator[pa.RecordBatch]:
        """(key, n) of all words so far, and of the number of words of each language as a phrase without words."""
        named, n = self._named(), self.n
        yield from _rows(named, [np.flatnonzero(n[1:]) + 1], n[1:][n[1:] > 0])
        totals = np.bincount(named[2][1:], weights=n[1:], minlength=len(self.langs)).astype(np.int64)
        yield _batch(named[1], totals)

    def _named(self) -> tuple:
        known, ends = self.known, [b"\t" + lang for lang in self.langs]
        return pa.array(known.words, pa.binary()), pa.array(ends, pa.binary()), np.array(known.of, np.int64), np.array(known.lengths, np.int64)

    def counts(self, filters: list[np.ndarray], longest: int) -> Iterator[pa.RecordBatch]:
        """(key, n) of the phrases of two words and more that a pass counts.

        Without filters: all. With a filter of proposed phrases: those whose two shorter parts are in it. With a second one, of phrases found to
        be frequent since: those that were not counted with the first, and may be frequent by all that is known of their parts.
        """
        ids, word_hashes, named = np.array(self.ids, np.int32), np.array(self.known.hashes, np.uint64), self._named()
        self.ids = array("i", [0])
        n = np.bincount(ids, minlength=len(word_hashes))
        n[: len(self.n)] += self.n
        self.n = n
        spoken = ids > 0
        hashes = word_hashes[ids] if filters else word_hashes[:0]
        # which phrases of the size before are in each filter, at their first word
        passed = [bloom.has(f, word_hashes)[ids] & spoken for f in filters]
        for size in range(2, longest + 1):
            asked = np.logical_and.reduce([spoken[i : len(ids) - size + 1 + i] for i in range(size)])
            parts = [p[:-1] & p[1:] for p in passed]
            if len(parts) == 1:
                asked &= parts[0]
            elif parts:
                asked &= parts[1] & ~parts[0]
            at = np.flatnonzero(asked)
            code = np.zeros(len(at), np.int64)
            for i in range(size):
                code <<= _WORD_BITS
                code |= ids[at + i]
            code.sort()
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else at
            n, code = np.diff(np.append(first, len(code))), code[first]
            yield from _rows(named, [code >> (_WORD_BITS * (size - 1 - i)) & ((1 << _WORD_BITS) - 1) for i in range(size)], n)
            if filters and size < longest:
                hashes = _join(hashes[:-1], word_hashes[ids[size - 1 :]])
                if len(parts) == 2:
                    # what has been counted must be frequent to go on; what is counted only now may be
                    counted = parts[0] & parts[1]
                    parts[1][counted] = bloom.has(filters[1], hashes[counted])
                parts[0][parts[0]] = bloom.has(filters[0], hashes[parts[0]])
                passed = parts


def _rows(named: tuple, parts: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases, each given by the numbers of its words, with their counts."""
    words, langs, of, lengths = named
    ends = np.cumsum(sum((lengths[p] for p in parts), np.zeros(len(n), np.int64)))
    at = 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SEGMENT, "right")))
        texts = [words.take(pa.array(p[at:end])) for p in parts]
        phrase = pc.binary_join_element_wise(*texts, b" ") if len(texts) > 1 else texts[0]
        yield _batch(pc.binary_join_element_wise(phrase, langs.take(pa.array(of[parts[0][at:end]])), b""), n[at:end])
        at = end


def _batch(keys: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(n.astype(np.int64))], ["key", "n"])


def _valid(column: pa.Array) -> pa.Array:
    """Bytes of texts; those that are not UTF-8 with U+FFFD for what is wrong."""
    try:
        column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if b is None else b.decode("utf-8", "replace").encode() for b in column.to_pylist()], pa.binary())
    return column


def _counted(rows: DataFrame, filters: list, longest: int, least: int) -> DataFrame:
    """(lang, size, phrase, n) with ``n >= least`` or size 0, over all ``rows``, by one pass. ``filters`` are broadcast; words are counted as long as
    there is at most one. In a task a phrase and its language are one text, with a tab, which is in no phrase, between them."""

    def run(batches):
        passed, chunk = [np.frombuffer(f.value, np.uint8) for f in filters], Chunk()
        for whole in batches:
            for batch in sliced(whole, "text", SEGMENT):
                langs = _valid(batch.column("lang")).to_pylist()
                for text, lang in zip(_valid(batch.column("text")), langs, strict=True):
                    lang = UNKNOWN.encode() if lang is None else lang
                    for words in _segments(text.as_py() or b""):
                        chunk.add(lang, words)
                        if chunk.full():
                            yield from chunk.counts(passed, longest)
                            if chunk.many():
                                if len(passed) < 2:
                                    yield from chunk.words()
                                chunk = Chunk()
        yield from chunk.counts(passed, longest)
        if len(passed) < 2:
            yield from chunk.words()

    found = rows.select("text", "lang").mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\t", 1)
    size = F.when(phrase == "", F.lit(0)).otherwise(F.size(F.split(phrase, " ")))
    named = found.select(F.expr("substring(key, instr(key, '\t') + 1)").alias("lang"), size.alias("size"), phrase.alias("phrase"), "n")
    return named.filter((F.col("n") >= least) | (F.col("size") == 0))


def _filter(phrases: DataFrame):
    """The (lang, phrase) of a table as a broadcast Bloom filter."""
    bits = bloom.bits_for(phrases.count())

    def run(batches):
        seen = bloom.Seen(bits)
        for batch in batches:
            hashes: dict[int, list] = {}
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                words = [_word_hash(lang.encode(), w) for w in phrase.encode().split(b" ")]
                hashes.setdefault(len(words), []).append(words)
            for words in hashes.values():
                columns = np.array(words, np.uint64).T
                h = columns[0]
                for more in columns[1:]:
                    h = _join(h, more)
                bloom.add(seen.once, h)
        yield from seen.parts()

    once, _ = bloom.merged(phrases.select("lang", "phrase").mapInArrow(run, bloom.SCHEMA), bits)
    return phrases.sparkSession.sparkContext.broadcast(once.tobytes())


def frequent(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    sample: int = SAMPLE,
) -> DataFrame:
    """(lang, size, phrase, n): every phrase of 1 to ``longest`` (at most 3) words with ``n >= min_count`` occurrences within pieces, overlaps included,
    and for each language the number of all its words as a phrase of size 0.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at blanks and tabs. A null text is empty, a
    null language ``UNKNOWN``; ids only choose the sample and may be null or repeat; rows that are repeated count each for itself. Bytes
    that are not UTF-8 count as U+FFFD. Long texts are counted in segments that end with a piece. An empty table gives no rows. Other
    columns are not looked at.
    """
    if not 2 <= longest <= 3 or min_count < 1 or sample < 1:
        raise ValueError(f"longest must be 2 or 3, min_count and sample positive: {longest}, {min_count}, {sample}")
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.col(lang_col).cast("string").cast("binary").alias("lang")
    )
    # half of what a phrase at the threshold has in the sample on average, but no single occurrences
    lowered = min(min_count, max(2, min_count // (2 * sample)))
    chosen = F.pmod(F.xxhash64("id"), F.lit(sample)) == 0
    # the longest phrases are not proposed: they are counted if both of their parts are
    proposed = stage(_counted(rows.filter(chosen), [], longest - 1, lowered).filter("size > 0"), "proposed")
    filters = [_filter(proposed)]
    part = F.col("size").between(1, longest - 1)
    filters = [_filter(proposed)]
    known = stage(_counted(rows, filters, longest, min_count), "phrases")
    missed = known.filter(part).join(proposed, ["lang", "phrase"], "left_anti")
    if not missed.isEmpty():
        filters.append(_filter(known.filter(part)))
        known = known.unionByName(stage(_counted(rows, filters, longest, min_count), "more-phrases"))
    return known


def _top(rows: DataFrame, n: int, spread: int = 64) -> DataFrame:
    """The first ``n`` of each language with their rank; a language's rows meet only after each of ``spread`` groups is down to ``n``."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(spread))
    inner, outer = Window.partitionBy("lang", "_group").orderBy(*order), Window.partitionBy("lang").orderBy(*order)
    few = rows.withColumn("_group", group).withColumn("rank", F.row_number().over(inner)).filter(F.col("rank") <= n)
    return few.withColumn("rank", F.row_number().over(outer).cast("long")).filter(F.col("rank") <= n).drop("_group")


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    covered: int = COVERED,
    top: int = TOP,
    sample: int = SAMPLE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of two to ``longest`` words with ``a >= min_count`` occurrences.

    ``l`` and ``r`` count the parts before and after a cut, ``score`` is floor(1000000 a a / (l r)), exact; of a phrase's cuts the one with the lowest
    score counts, then the first. ``n`` counts the words of the language. A phrase that is part of a longer one of the list with at least ``covered``
    hundredths of its occurrences is left out. Ties are in order of occurrences, then of the phrase's bytes. For nulls, odd rows and empty
    tables see ``frequent``.
    """
    known = stage(frequent(docs, id_col, text_col, lang_col, min_count, longest, sample), "phrases")
    candidates = known.filter("size > 1").withColumnRenamed("n", "a")
    inside = candidates.filter("size > 2").select(
        "lang",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
                " i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
            )
        ).alias("phrase"),
        "a",
    )
    longer = stage(inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer")), "longer")
    left = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
    )
    words = F.split("phrase", " ")
    cuts = left.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    parts = known.filter(F.col("size").between(1, longest - 1))
    for part, n in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(part), F.col("n").alias(n)), ["lang", part])
    # numbers below 10 ** 16: a * a * 1000000 has 38 digits
    exact = "cast({0} as decimal(16, 0))"
    score = F.expr(f"({exact.format('a')} * {exact.format('a')} * 1000000BD) div ({exact.format('l')} * {exact.format('r')})")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    ranked = _top(best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), top)
    totals = known.filter("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), f AS (
    SELECT lang, size, phrase, count(*) AS n FROM (
        SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
        UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
        UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
    ) GROUP BY ALL
), cand AS (
    SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= {MIN_COUNT}
), longer AS (
    SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM cand WHERE size = 3
    ) GROUP BY ALL
), kept AS (
    SELECT c.* FROM cand c LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {COVERED} * a
), cuts AS (
    SELECT lang, phrase, a, 1 AS k, w[1] AS first, array_to_string(w[2:], ' ') AS rest FROM kept
    UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE size = 3
), scored AS (
    SELECT c.lang, c.phrase, a, k, x.n AS l, y.n AS r, (a::HUGEINT * a * 1000000) // (x.n::HUGEINT * y.n) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
), totals AS (
    SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
