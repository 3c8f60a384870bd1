import hashlib
from collections import defaultdict

import pytest

from gridtide.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [7, 64, 4096])
def test_equals_grouping_by_text(odd_docs, size):
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    got = exact_dedup.exact_duplicates(odd_docs, block_bytes=size).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_empty_table(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0


def test_shared_blocks_by_both_ways(spark):
    # more rows of one block than a quarter of a partition, next to single ones
    rows = [(i, "common " * 20 + (str(i) if i % 3 == 0 else "")) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = exact_dedup.exact_duplicates(df, block_bytes=16).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want


def test_only_dataframe_operators(odd_docs):
    plan = exact_dedup.exact_duplicates(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_keep_one(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (3, "b", 7)], "doc_id long, text string, name long")
    assert sorted(tuple(r) for r in exact_dedup.keep_one(df).collect()) == [(2, "a", 6), (3, "b", 7)]
