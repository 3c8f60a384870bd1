import hashlib
import random

import numpy as np

from gridtide.llm import piecewise as cp


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_distance():
    rng = random.Random(1)
    for _ in range(800):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(0, 90))) for _ in range(2))
        assert cp.distance(a, b) == plain_distance(a, b)


def test_segments_do_not_change_a_fingerprint(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 110, n).astype(np.uint8).tobytes() for n in (1, 5, 100, 4000, 30_000)] + [b"abc " * 5000, b"x" * 9000]
    want = [cp.fingerprint(t) for t in texts]
    monkeypatch.setattr(cp, "SEGMENT", 777)
    assert [cp.fingerprint(t) for t in texts] == want


def test_every_byte_counts():
    rng = random.Random(3)
    data = bytearray(rng.choice(b"abcdefg ") for _ in range(3000))
    base = cp.fingerprint(bytes(data))
    for at in [0, 1, 1500, 2998, 2999]:
        changed = data.copy()
        changed[at] = 65
        assert cp.fingerprint(bytes(changed)) != base
        assert cp.likeness(base, cp.fingerprint(bytes(changed))) > 0.9


def test_likeness():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)).encode() for n in (3000, 3100)]
    a, b = map(cp.fingerprint, texts)
    assert cp.likeness(a, a) == 1 and cp.likeness(a, b) < 0.1
    half = cp.fingerprint(texts[0][:1500] + texts[1][:1500])
    assert 0.35 < cp.likeness(a, half) < 0.65
    assert cp.likeness("1::", "1::") == 1 and cp.likeness("1::", a) == 0


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        f, g, n = (cp.fingerprint(x.encode()) for x in (t, changed, after))
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), f, g, cp.likeness(f, g), cp.likeness(f, n)))
    return sorted(out, key=str)


def test_operator_equals_brute_force(odd_docs, spark):
    got = sorted((tuple(r) for r in cp.with_edited(odd_docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    prints = {(r.doc_id, r.n_chars, r.fingerprint) for r in cp.fingerprints(odd_docs).collect()}
    assert prints == {(r[0], r[1], r[3]) for r in got}
    rng = random.Random(5)
    rows = [(rng.randrange(-(10**15), 10**15), "".join(rng.choice("ab c") for _ in range(rng.randrange(60)))) for _ in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted((tuple(r) for r in cp.with_edited(df).collect()), key=str) == brute(rows)


def test_few_rows(spark, no_docs):
    assert cp.with_edited(no_docs).count() == 0
    for rows in ([(5, "abc")], [(None, "abc")], [(5, "abc"), (5, "abc")], [(5, "abc"), (9, None)]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted((tuple(r) for r in cp.with_edited(df).collect()), key=str) == brute(rows)
