import random
import zlib

import numpy as np
import pytest

from gridtide.llm import periodic


def slow_runs(x):
    """Runs by comparing each word with the one q words later, for every q."""
    out = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(x[i : j + q - p] == x[i + p : j + q] for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_planted(doc_id, text):
    words, h = (text or "").split(" "), zlib.crc32(str(doc_id).encode())
    words = [w for w in (text or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if doc_id is None or h % 10 or not words:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_comparing_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(250):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            kinds = rng.choice([1, 2, 2, 3, 8])
            x = [rng.randrange(kinds) for _ in range(rng.randrange(90))]
            for _ in range(rng.randrange(3)):
                if len(x) > 8:
                    a, p = rng.randrange(len(x)), rng.randrange(1, len(x) // 4 + 1)
                    for i in range(a, rng.randrange(a, len(x))):
                        x[i] = x[a + (i - a) % p]
            texts.append(x)
        assert periodic.find_runs([np.array(x, np.int64) for x in texts]) == [slow_runs(x) for x in texts]


def test_long_periods_and_nested_runs():
    rng = random.Random(9)
    unit = [rng.randrange(1000) for _ in range(700)]
    inner = unit + [5] * 9 + unit[:50]
    text = [1, 2, 3] + inner * 5 + [7] + unit * 4
    assert periodic.find_runs([np.array(text), np.array([], np.int64), np.array(text[::-1])]) == [slow_runs(text), [], slow_runs(text[::-1])]


def test_wavelet_matrix_answers_as_a_scan():
    rng = np.random.default_rng(2)
    values = rng.permutation(300)
    matrix = periodic.WaveletMatrix(values)
    lo = rng.integers(0, 299, 400)
    hi = lo + 1 + rng.integers(0, 300 - lo)
    x = values[rng.integers(lo, hi)]
    before, after = matrix.neighbours(lo, hi, x)
    for i in range(400):
        part = sorted(values[lo[i] : hi[i]])
        at = part.index(x[i])
        assert before[i] == (part[at - 1] if at else -1) and after[i] == (part[at + 1] if at + 1 < len(part) else -1)


def test_odd_rows(spark, odd_docs, no_docs):
    out = periodic.with_runs(odd_docs).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        words = (r.text or "").split()
        runs = [tuple(x) for x in r.runs]
        # long texts of one repeated word are quadratic for the slow way
        assert runs == (slow_runs(words) if len(words) < 1000 else [(0, 5000, 1)] if r.text.startswith("日本") else [])
        assert r.collapsed == collapsed(words, runs)
    assert periodic.with_runs(no_docs).count() == 0
    assert {f.name for f in periodic.with_runs(odd_docs).schema} == {*odd_docs.columns, "runs", "collapsed"}
    broken = spark.sql("SELECT CAST(concat(repeat('a ', 7), CAST(X'FF' AS STRING)) AS STRING) AS text, 5 AS runs")
    row = periodic.with_runs(broken).first()
    assert [tuple(x) for x in row.runs] == [(0, 7, 1)] and row.collapsed == "a �"


def test_planted_texts(odd_docs):
    want = sorted((str(r.doc_id), slow_planted(r.doc_id, r.text)) for r in odd_docs.collect())
    got = sorted((str(r.doc_id), (r.text or "").split()) for r in periodic.with_planted(odd_docs).collect())
    assert got == want and any(zlib.crc32(i.encode()) % 10 == 0 for i, _ in want if i != "None")
