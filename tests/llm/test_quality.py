import random
import zlib

import numpy as np
import pytest

from gridtide.llm import quality


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(700):
        good = rng.random() < 0.8
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(20, 120))]
        text = " ".join(words) if good else rng.choice(["%%% ", "!! ", " | "]).join(words)
        rows.append((i, text, "en", 1.0))
        labels.append((i, int(good), 0))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    net = quality.train(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs, net).collect()}
    want = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    test = [i for i, r in got.items() if r.held_out]
    assert np.mean([got[i].predicted == want[i] for i in test]) > 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    kept = {r.doc_id for r in quality.keep_good(docs, net).collect()}
    assert kept == {i for i, r in got.items() if r.predicted}


def test_held_out_labels_are_not_learned_from(corpus):
    from pyspark.sql import functions as F

    docs, labels = corpus
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(a.filters, b.filters) and a.bias == b.bias


def test_chunks_cover_the_text_and_pool_alike():
    rng = np.random.default_rng(1)
    net = quality.Network(
        rng.normal(0, 1, (256, quality.DEPTH)).astype(np.float32),
        rng.normal(0, 1, (quality.WIDTH * quality.DEPTH, quality.FILTERS)).astype(np.float32),
        rng.normal(0, 1, quality.FILTERS).astype(np.float32), rng.normal(0, 1, 2 * quality.FILTERS).astype(np.float32), 0.1,
    )
    for n in (0, 1, 7, 8, 9, 11, 12, 13, 503, 504, 515, 516, 517, 1020, 5000, 70_001):
        data = rng.integers(1, 256, n).astype(np.uint8).tobytes()
        parts = quality.chunks(data)
        at, rebuilt = 0, b""
        for i, part in enumerate(parts):
            rebuilt = rebuilt[: i * quality.CHUNK_STEP] + part
        assert rebuilt.startswith(data) and not rebuilt[len(data) :].strip(b"\0")
        by_chunk = [np.maximum(net.responses(np.frombuffer(p, np.uint8)).max(axis=0), 0) for p in parts]
        assert np.allclose(net.pooled(data), by_chunk, atol=1e-4), n


def test_gradient_lowers_the_loss():
    docs = [[b"aaaa bbbb cccc dddd"] if i % 2 else [b"%%%% !!!! ++++ ####"] for i in range(64)]
    y = np.array([i % 2 for i in range(64)], np.float32)
    net = quality.fit(docs, y, np.ones(64), epochs=40)
    assert net.score(b"aaaa bbbb cccc dddd") > 0.9 and net.score(b"%%%% !!!! ++++ ####") < 0.1


def test_odd_rows(odd_docs, spark):
    net = quality.constant(0.75)
    got = quality.scored(odd_docs, net).collect()
    assert len(got) == odd_docs.count() and all(abs(r.score - 0.75) < 1e-6 for r in got)
    assert not [r for r in got if r.doc_id is None and r.held_out]
    kept = quality.keep_good(odd_docs, net)
    assert kept.count() == odd_docs.count() and kept.columns == odd_docs.columns


def test_without_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(odd_docs, none).score(b"x") == pytest.approx(0.5)
    ones = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (7, 1, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.train(odd_docs, ones).score(b"x") > 0.5
    assert quality.scored(no_docs, quality.constant(0.5)).count() == 0


def test_repeated_ids_are_collected_within_the_bound(spark, monkeypatch):
    rows = [(i, f"text {n} of many {'!' * i}") for i in (1, 2) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda chunks, y, w: seen.append((len(chunks), y.tolist())) or fit(chunks, y, w, epochs=1))
    quality.train(docs, labels, per_class=5)
    assert seen == [(10, seen[0][1])] and sorted(seen[0][1]) == [0.0] * 5 + [1.0] * 5


def test_the_unit_is_fitted_to_whole_texts():
    """Where the maximum over many chunks misleads a unit that has seen few of them, fitting it to all of them mends that."""
    rng = np.random.default_rng(4)
    net = quality.fit([[b"aaaa bbbb cccc dddd"] if i % 2 else [b"%%%% !!!! ++++ ####"] for i in range(64)], np.arange(64, dtype=np.float32) % 2, np.ones(64), epochs=20)
    texts = [bytes(rng.choice(list(b"abcd %!+"), 40_000)) + (b"" if i % 2 else b" %%%% !!!! ++++" * 2000) for i in range(40)]
    y = np.arange(40, dtype=np.float32) % 2
    features = np.array([net.features(t) for t in texts], np.float32)

    def loss(n):
        p = np.clip([n.score(t) for t in texts], 1e-9, 1 - 1e-9)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    new = quality.refit(net, features, y, np.ones(40))
    assert loss(new) < loss(net) and loss(new) < 0.2
    assert np.mean([(new.score(t) > 0.5) == label for t, label in zip(texts, y, strict=True)]) == 1


def test_broken_utf8(spark):
    rows = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert quality.keep_good(rows, quality.constant(0.75)).count() == quality.scored(rows, quality.constant(0.75)).count() == 1
