"""Each stage of the pipeline against a plain version on its own input, and the run as a whole."""

import os
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as cp
from gridtide.llm import bpe, mixing, quality
from gridtide.llm.common import stage
from test_mixing import brute
from test_simhash import brute_components, slow_fingerprint

DATA = os.environ.get("GRIDTIDE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables not present")


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, step in cp.STAGES:
        out.append(stage(step(spark, out[-1], DATA), name.replace(" ", "-")))
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources", "byte-level BPE"]
    assert all(s.columns == cp.COLUMNS for s in stages[1:-1])


def test_quality(spark, stages):
    net = quality.train(stages[0], spark.read.parquet(f"{DATA}/labels.parquet"))
    want = {r.doc_id for r in quality.scored(stages[0], net).filter("predicted = 1").collect()}
    assert set(texts(stages[1])) == want and 0 < len(want) < stages[0].count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q]
    assert sum(d in want for d in good) > 0.95 * len(good)


def test_exact_dedup(stages):
    last = {}
    for d, t in sorted(texts(stages[1]).items()):
        last[t] = d
    assert set(texts(stages[2])) == set(last.values())


def test_near_dedup(stages):
    docs = sorted(texts(stages[2]).items())
    roots = brute_components([slow_fingerprint(t) for _, t in docs])
    assert set(texts(stages[3])) == {docs[r][0] for r in roots}


def test_mixing(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[3].collect()]
    want = Counter({r[0]: r[4] for r in brute(rows) if r[4]})
    assert Counter(r.doc_id for r in stages[4].collect()) == want
    assert mixing.MOST == 3


def test_tokens(stages):
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = texts(stages[4])
    got = stages[5].collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in stages[4].collect())
    assert all(r.ids == library.encode_ordinary(docs[r.doc_id]) and r.n_tokens == len(r.ids) for r in got)


def test_run(spark, stages):
    assert sorted(r.ids_sha256 for r in cp.run(spark, DATA).collect()) == sorted(r.ids_sha256 for r in stages[5].collect())


@pytest.mark.parametrize("written", [False, True])
def test_rows_without_id_and_repeated_rows(spark, odd_docs, written):
    """The odd rows as they are: nobody's text is lost with a null id, repeated rows leave one, and copies stay within the bound."""
    docs = odd_docs.select(*cp.COLUMNS).union(spark.createDataFrame([(None, "text of its own " * 9, "en", "src0", None)], odd_docs.select(*cp.COLUMNS).schema))
    docs = stage(docs, "odd") if written else docs
    rows = [tuple(r) for r in docs.collect()]
    once = stage(cp.distinct(spark, docs, DATA), "odd-distinct")
    got = [tuple(r) for r in once.collect()]
    assert sorted(r[1] or "" for r in got) == sorted({r[1] or "" for r in rows})
    for r in got:
        ids = [x[0] for x in rows if (x[1] or "") == (r[1] or "")]
        assert r[0] == max((i for i in ids if i is not None), default=None) and r in rows
    apart = stage(cp.dissimilar(spark, once, DATA), "odd-dissimilar")
    table = sorted(((r[0] is None, r[0] or 0, r[1] or "") for r in got))
    roots = brute_components([slow_fingerprint(t) for _, _, t in table])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in apart.collect()) == [table[r] for r in sorted(set(roots))]
    for stage_in in (apart, docs):
        taken = Counter(tuple(r) for r in cp.mixed(spark, stage_in, DATA).collect())
        have = Counter(tuple(r) for r in stage_in.collect())
        sizes = Counter((r.doc_id, r.size) for r in mixing.copies(stage_in).collect() for _ in range(r.copies))
        assert sum(taken.values()) == sum(sizes.values()) and all(n <= mixing.MOST * have[r] for r, n in taken.items())
        assert Counter(r[0] for r in taken.elements()) == Counter(i for i, _ in sizes.elements())


def test_a_row_without_id_is_mixed_in(spark):
    docs = spark.createDataFrame([(None, "a b c", "s"), (1, "d e f", "s"), (1, "d e f", "s")], "doc_id long, text string, source string")
    assert Counter(r.doc_id for r in mixing.mixed(docs).collect()) == {None: 1, 1: 2}


@pytest.mark.parametrize("case", ["empty", "odd"])
def test_odd_input(spark, case, odd_docs, no_docs, tmp_path):
    """Empty tables, and documents with nulls, empty and long texts, ties and more columns, pass through all stages."""
    docs = no_docs if case == "empty" else odd_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    docs.select("*", *[] if case == "empty" else [F.lit(1).alias("ids")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = cp.run(spark, str(tmp_path)).collect()
    assert not got if case == "empty" else got
