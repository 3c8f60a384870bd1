from collections import Counter

import pytest

from gridtide.llm import bloom, lines

WHITE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, min_chars=1, keep="none"):
    """(id, kept text, lines, dropped) of rows (id, text)."""
    split = [[(x, x.strip(WHITE).translate(LOWER)) for x in (t or "").split("\n")] for _, t in rows]
    n = Counter(k for ls in split for k in {k for _, k in ls if len(k) >= min_chars})
    first = {}
    for i, (_, ls) in sorted(enumerate(zip(rows, split, strict=True)), key=lambda x: (x[1][0][0] is not None, x[1][0][0] or 0)):
        for _, k in ls:
            first.setdefault(k, i)
    out = []
    for i, ((d, _), ls) in enumerate(zip(rows, split, strict=True)):
        kept, seen = [], set()
        for x, k in ls:
            if n[k] < min_docs or keep == "first" and first[k] == i and k not in seen:
                kept.append(x)
            seen.add(k)
        out.append((d, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=str)


def got(df, **settings):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.without_repeated(df, **settings).collect()), key=str)


@pytest.fixture()
def lined(spark, words):
    rows = [(i, f"own line {i}\n\t{words[i % 5].upper()} stock \n{words[i % 7]}\n" + "many times\n" * (i % 3) + "  \nend é") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "ALPHA STOCK"), (103, "É\nÉ"), (104, "x " * 40_000 + "\nbeta stock"), (105, "end é\r")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("settings", [{}, {"min_docs": 2}, {"min_docs": 2, "min_chars": 5}, {"keep": "first"}, {"min_docs": 2, "keep": "first"}])
def test_equals_counting_all_lines(lined, settings):
    rows, df = lined
    assert got(df, **settings) == brute(rows, **({"min_docs": 10} | settings))


def test_a_filter_that_is_far_too_small_costs_no_line(lined):
    rows, df = lined
    assert got(df, min_docs=3, bits=bloom.SLICES * 64) == brute(rows, 3)


def test_odd_rows(spark, odd_docs, no_docs):
    # "n_lines" and a clashing name of the operator's own
    df = odd_docs.withColumnRenamed("row", "_drops").withColumnRenamed("size", "n_lines")
    out = lines.without_repeated(df, min_docs=2)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str) == brute([(r.doc_id, r.text) for r in df.collect()], 2)
    assert set(out.columns) == {*df.columns, "n_lines", "n_dropped"}
    assert lines.without_repeated(no_docs).count() == 0
    broken = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF620A63' AS STRING) AS text UNION ALL SELECT 2L, CAST(X'61FF62' AS STRING)")
    assert got(broken, min_docs=2) == [(1, "c", 2, 1), (2, "", 1, 1)]
    for bad in ({"min_docs": 1}, {"keep": "last"}):
        with pytest.raises(ValueError):
            lines.without_repeated(df, **bad)


def test_filters_miss_no_hash_seen_twice(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    once, twice = rng.integers(0, 1 << 63, 4000).astype(np.uint64), rng.integers(0, 1 << 63, 500).astype(np.uint64)
    parts = [bloom.Seen(1 << 16) for _ in range(4)]
    for i, part in enumerate(parts):
        part.meet(np.concatenate([once[i::4], twice[: 250 * (i % 2)], twice[250:] if i == 3 else twice[:0]]))
        part.meet(twice[250:] if i == 3 else twice[:0])
    rows = [(r["slice"], r["once"], r["twice"]) for p in parts for b in p.parts() for r in b.to_pylist()]
    seen, again = bloom.merged(spark.createDataFrame(rows, bloom.SCHEMA).repartition(3), 1 << 16)
    assert bloom.has(seen, np.concatenate([once, twice])).all() and bloom.has(again, twice).all()
    assert bloom.has(again, once).mean() < 0.05
