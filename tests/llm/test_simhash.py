import random

import numpy as np
import xxhash

from gridtide.llm import simhash


def slow_fingerprint(text, shingle=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=4):
    """Smallest position reachable."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    arr = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_code_is_perfect():
    by_byte, offsets = simhash.golay()
    assert (offsets[:, 0] >= 0).all() and ((offsets >= 0).sum(axis=1) == np.where((offsets >= 0).sum(axis=1) > 1, 6, 1)).all()
    assert ((offsets >= 0).sum(axis=1) == 6).sum() == 1771


def test_segments_within_two_bits_share_a_key():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 20_000).astype(np.int32)
    for flips in (0, 1, 2):
        y = x.copy()
        for row in range(len(x)):
            for bit in rng.choice(23, flips, replace=False):
                y[row] ^= 1 << int(bit)
        a, b = simhash.segment_keys(x), simhash.segment_keys(y)
        assert ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2)).all()


def test_fingerprints_within_four_bits_share_a_pair():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for bit in rng.choice(64, 4, replace=False):
            y ^= 1 << int(bit)
        assert set(simhash.pair_keys(np.array([x], np.uint64))[0]) & set(simhash.pair_keys(np.array([y], np.uint64))[0])


def test_fingerprint_by_hand(odd_docs):
    for r in odd_docs.collect():
        assert simhash.fingerprint((r.text or "").encode()) == slow_fingerprint(r.text or "")
    assert simhash.fingerprint("İ A b\u0085C d e f".encode()) == slow_fingerprint("İ A b\u0085C d e f")


def test_operator_equals_brute_force(odd_docs):
    rows = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    fps = [slow_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    want = sorted(((i, f"{f:016x}", rows[c][0]) for (i, _), f, c in zip(rows, fps, roots, strict=True)), key=str)
    assert sorted((tuple(r) for r in simhash.near_duplicates(odd_docs).collect()), key=str) == want


def test_chains_and_large_groups(spark):
    """Fingerprints planted near each other: chains, a cloud around one centre, and noise; links must connect what brute force connects."""
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(800)}
    for _ in range(20):  # chains
        x = rng.getrandbits(64)
        for _ in range(6):
            for bit in rng.sample(range(64), 4):
                x ^= 1 << bit
            fps.add(x)
    centre = rng.getrandbits(64)
    for _ in range(700):  # a cloud
        x = centre
        for bit in rng.sample(range(64), rng.randrange(1, 4)):
            x ^= 1 << bit
        fps.add(x)
    fps = sorted(fps)
    rng.shuffle(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.links(nodes)
    found = {(r.a, r.b) for r in links.collect()}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in found)
    assert len(found) < 60_000
    got = {r.node: r.root for r in simhash.components(links).collect()}
    want = brute_components(fps)
    seen = {}
    for f, c in zip(signed, want, strict=True):
        assert seen.setdefault(c, got.get(f, f)) == got.get(f, f)
    assert len(set(seen.values())) == len(seen)


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one(spark, words):
    text = " ".join(words * 20)
    df = spark.createDataFrame([(1, text, "a"), (2, text + " tail", "b"), (3, "other words here", "c")], "doc_id long, text string, fp string")
    kept = sorted(r.doc_id for r in simhash.keep_one(df).collect())
    assert kept in ([1, 3], [1, 2, 3])
