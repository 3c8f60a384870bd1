import random
import re
from collections import Counter, defaultdict

import pytest

from gridtide.llm import phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def counts(rows, longest=3):
    out = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, longest + 1):
                out["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return out


def brute(rows, min_count, longest=3, covered=50, top=2000):
    out = []
    for lang, f in counts(rows, longest).items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {q for p, a in cand.items() for m in range(2, len(p)) for q in (p[i : i + m] for i in range(len(p) - m + 1)) if 100 * a >= covered * f[q]}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n, -s))
    return sorted(out)


def got(df, **settings):
    return sorted(tuple(r) for r in phrases.collocations(df, **settings).collect())


@pytest.fixture()
def spoken(spark):
    rng = random.Random(5)
    few = ["of", "The", "new", "york", "été", "x", "y z", "Ä"]
    make = lambda: "".join(rng.choice(few + [f"w{rng.randrange(60)}"]) + rng.choice([" ", " ", " \t", " ", ", ", ".\n", "  "]) for _ in range(rng.randrange(80)))
    rows = [(i, make(), rng.choice(["en", "en", "en", "de", None, ""])) for i in range(300)]
    rows += [(None, None, "en"), (7, "", None), (7, "a a a a a a a a a a a a a a", "rep"), (8, "only here only here " * 10, "zz")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


@pytest.mark.parametrize("settings", [{}, {"min_count": 4, "top": 7}, {"min_count": 2, "covered": 90}, {"longest": 2, "min_count": 3}, {"sample": 1}])
def test_equals_counting_all_phrases(spoken, settings):
    rows, df = spoken
    want = brute([r[1:] for r in rows], **{"min_count": 10} | {k: v for k, v in settings.items() if k != "sample"})
    assert got(df, **settings) == want


def test_what_the_sample_missed_is_found(spoken, monkeypatch):
    """A sample that proposes nothing: the first pass finds words, the second all longer phrases, and each number is the same."""
    rows, df = spoken
    passes, counted = [], phrases._counted

    def counting(docs, filters, *settings):
        passes.append(len(filters))
        return counted(docs if filters else docs.limit(0), filters, *settings)

    monkeypatch.setattr(phrases, "_counted", counting)
    known = {(r.lang, r.phrase): r.n for r in phrases.frequent(df, min_count=5).filter("size > 0").collect()}
    assert passes == [0, 1, 2]
    assert known == {(lang, " ".join(p)): n for lang, f in counts([r[1:] for r in rows]).items() for p, n in f.items() if n >= 5}


def test_small_chunks_and_segments_count_alike(spoken, monkeypatch):
    rows, _ = spoken
    want = counts([(t, "en") for _, t, _ in rows])["en"]
    monkeypatch.setattr(phrases, "CHUNK", 50)
    monkeypatch.setattr(phrases, "WORDS", 40)
    found, chunk = Counter(), phrases.Chunk()

    def take(batches):
        for b in batches:
            for r in b.to_pylist():
                found[r["key"]] += r["n"]

    for _, text, _ in rows:
        for words in phrases._segments((text or "").encode(), 40):
            chunk.add(b"en", words)
            if chunk.full():
                take(chunk.counts([], 3))
                if chunk.many():
                    take(chunk.words())
                    chunk = phrases.Chunk()
    take(chunk.counts([], 3))
    take(chunk.words())
    assert found.pop("\ten") == sum(n for p, n in want.items() if len(p) == 1)
    assert found == Counter({" ".join(p) + "\ten": n for p, n in want.items()})


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    assert got(odd_docs, min_count=3) == brute(rows, 3)
    assert got(no_docs) == []
    broken = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF2062' AS STRING) AS text, 'en' AS lang FROM range(12)")
    assert got(broken) == [("en", 1, "a� b", 12, 12, 12, 24, 1000000)]
    with pytest.raises(ValueError):
        phrases.frequent(odd_docs, longest=4)
