import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridtide.llm import mixing


def reshared(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = [s for s in free if level * w[s] > most * sizes[s]]
        if not full:
            out |= {s: level * w[s] for s in free}
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def words(text):
    return len("".join(" " if "\t" <= c <= "\r" else c for c in text or "").split(" ")) - sum(
        not w for w in "".join(" " if "\t" <= c <= "\r" else c for c in text or "").split(" ")
    )


def brute(rows, seed=42):
    by, out = defaultdict(list), []
    for i, t, s in rows:
        by[s].append((words(t), i is not None, i or 0, i))
    sizes = {s: sum(r[0] for r in rs) for s, rs in by.items()}
    goal = reshared(sizes)
    for s, rs in by.items():
        step = round(goal[s] / sizes[s] * 2**24) if sizes[s] else 0
        at = int(hashlib.md5((f"{seed}" if s is None else f"{seed}:{s}").encode()).hexdigest()[:6], 16)
        for size, _, _, i in sorted(rs, key=lambda r: r[:3]):
            n, at = ((at + step) >> 24) - (at >> 24), at + step
            out.append((i, size, sizes[s], round(goal[s], 6), n, n * size))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.copies, r.taken) for r in df.collect()), key=str)


def test_equals_brute_force(odd_docs):
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    got = result(mixing.copies(odd_docs))
    assert got == brute(rows)
    assert all(r[4] <= 3 for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_hot_source(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(3000):
        s = rng.choice(["hot"] * 9 + [f"s{k}" for k in range(7)] + [None, "z\U0001f600", "é"])
        rows.append((i, "w " * (int(rng.expovariate(0.02)) if s != "s3" else 0), s))
    got = mixing.copies(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5))
    assert result(got) == brute(rows)
    sums = got.groupBy("target", "source_size").agg(F.sum("taken").alias("taken"), F.max("size").alias("largest")).collect()
    assert all(abs(r.taken - r.target) <= 3 * r.largest for r in sums)
    assert result(mixing.copies(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string"))) == brute(rows)


def test_mixed_rows(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 4}", i, "x") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, copies string")
    want = {r.doc_id: r.copies for r in mixing.copies(df).collect() if r.copies}
    got = mixing.mixed(df)
    assert got.columns == df.columns
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == want


def test_empty_table(no_docs):
    assert mixing.copies(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0


def test_a_column_of_the_operators_own_name(odd_docs):
    df = odd_docs.withColumnRenamed("n", "_n")
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.count() == mixing.mixed(odd_docs).count()
