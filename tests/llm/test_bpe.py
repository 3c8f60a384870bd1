import base64
import gc
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from gridtide.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), "<i4").tolist()


def test_texts_as_the_library_would(ranks, reference):
    encoder, rng = bpe.Encoder(ranks, P.PATTERN), random.Random(1)
    letters = [*"abcdefghiklmnoprstuvzéüß  \n\t\u3000\x1c\x85\xa0\u2029'’0123456789.,;!?-_(){}=日本語😀́ẍ", "  ", "\r\n", "'s", "'ll", " the", "ing"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert ids_of(encoder, text) == reference.encode_ordinary(text), text
    for text in ("a" * 3000, " " * 500, "ab" * 900, "<|endoftext|>", "x \n y", "x  'y", ""):
        assert ids_of(encoder, text) == reference.encode_ordinary(text)


def test_bytes_as_the_library_would(ranks, reference):
    transducer, rng, tokens = bpe.Transducer(ranks, kept_states=300), random.Random(2), list(ranks)
    for _ in range(2000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 9)))
        ids = np.frombuffer(transducer.encode(piece), "<i4").tolist()
        assert ids == reference._core_bpe.encode_single_piece(piece)


def test_small_tables_do_not_change_ids(ranks, monkeypatch):
    text = " ".join(f"word{i % 37} thing{i}" for i in range(600))
    want = ids_of(bpe.Encoder(ranks, P.PATTERN), text)
    for name in ("KEPT_PIECES", "KEPT_PAIRS", "SLICE"):
        monkeypatch.setattr(bpe, name, 5)
    assert ids_of(bpe.Encoder(ranks, P.PATTERN), text) == want


def test_utf8_stream_equals_decoding_at_once():
    rng = random.Random(3)
    for _ in range(3000):
        data = bytes(rng.choice([*range(256), 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xC3, 0xA9, 0x41]) for _ in range(rng.randrange(12)))
        if rng.random() < 0.5:
            data = "aé€😀".encode() + data
        stream, out, at = bpe.Utf8Stream(), "", 0
        while at < len(data):
            n = rng.randrange(1, 4)
            out, at = out + stream.feed(data[at : at + n]), at + n
        assert out + stream.end() == data.decode("utf-8", "replace")


def test_operator(odd_docs, ranks, reference):
    got = bpe.decode(bpe.encode(odd_docs, ranks, P.PATTERN), ranks)
    assert got.columns == [*odd_docs.columns, "ids", "decoded"]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    at_once = bpe.encode(odd_docs, ranks, P.PATTERN, decoded="decoded")
    assert at_once.columns == got.columns and sorted(map(str, at_once.collect())) == sorted(map(str, rows))
    for r in rows:
        assert r.ids == reference.encode_ordinary(r.text or "") and r.decoded == (r.text or "")
    for r in bpe.digests(got.filter("doc_id = 7")).collect():
        text = next(x.text for x in rows if x.doc_id == 7)
        ids = reference.encode_ordinary(text)
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(text.encode()).hexdigest())
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_null_ids_and_broken_bytes(spark, ranks):
    euro = [ranks[bytes([b])] for b in "€".encode()]
    df = spark.createDataFrame([(1, None), (2, []), (3, euro), (4, euro[:2]), (5, euro[1:])], "i int, ids array<int>")
    assert [r.decoded for r in bpe.decode(df, ranks).orderBy("i").collect()] == ["", "", "€", "\ufffd", "\ufffd\ufffd"]


def test_empty_table_and_clashing_column(no_docs, ranks):
    assert bpe.encode(no_docs, ranks, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(no_docs, ranks, P.PATTERN, into="lang")


def test_ranks_file():
    with open(PATH, "rb") as f:
        token, rank = f.readline().split()
    assert bpe.read_ranks(PATH)[base64.b64decode(token)] == int(rank)


def test_long_pieces_are_not_kept(ranks, reference):
    encoder = bpe.Encoder(ranks, P.PATTERN)
    text = "short words and " + "x" * (bpe.KEPT_CHARS + 1) + " " + "y" * 5000
    assert ids_of(encoder, text) == ids_of(encoder, text) == reference.encode_ordinary(text)
    assert max(map(len, encoder.pieces)) <= bpe.KEPT_CHARS


def test_broken_utf8(spark, ranks, reference):
    rows = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    (r,) = bpe.encode(rows, ranks, P.PATTERN, decoded="decoded").select("ids", "decoded").collect()
    assert r.ids == reference.encode_ordinary("a\ufffdb") and r.decoded == "a\ufffdb"


def test_many_texts_at_once(ranks, reference, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aeiounrst  é.\n") for _ in range(rng.randrange(90))) for _ in range(400)] + ["", "x" * 9000, "ends"]
    want = [reference.encode_ordinary(t) for t in texts]
    for kept, size in ((10**6, 1 << 20), (40, 1000), (10**6, 1)):
        monkeypatch.setattr(bpe, "SLICE", size)
        encoder = bpe.Encoder(ranks, P.PATTERN)
        encoder.transducer.kept = kept
        assert [np.frombuffer(ids, "<i4").tolist() for ids in encoder.encode_all(texts)] == want


def test_tables_are_not_followed_for_garbage(ranks):
    encoder = bpe.Encoder(ranks, P.PATTERN)
    encoder.encode("some inventive wordlings that are no tokens")
    for table in (encoder.transducer.moves, encoder.transducer.numbers, encoder.transducer.settled, encoder.pieces):
        assert table and not any(map(gc.is_tracked, table.values()))


def test_batches_of_results_are_small(ranks):
    (batch,) = pa.Table.from_pydict({"t": ["x" * 100_000] * 40}).to_batches()
    assert max(part.num_rows for part in bpe.sliced(batch, 0)) * 100_000 <= 2 << 20
