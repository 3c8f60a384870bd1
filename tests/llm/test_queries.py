"""The registered queries on the smallest sample tables, against SQL or plain versions of what they are to return."""

import hashlib
import os
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from gridtide.llm import bpe, licenses, piecewise, pseudonyms, simhash, substrings
from gridtide.llm.queries import ORACLES, QUERIES, SAMPLE_KEY

for _place in (Path(__file__).resolve().parent, Path(__file__).resolve().parents[1]):
    sys.path.insert(0, str(_place))

from oracle_check import compare, connect  # noqa: E402
from test_periodic import collapsed, slow_planted, slow_runs  # noqa: E402
from test_simhash import brute_components, slow_fingerprint  # noqa: E402

DATA = os.environ.get("GRIDTIDE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample tables not present")


@pytest.fixture(scope="module")
def con():
    con = connect(DATA)
    yield con
    con.close()


@pytest.fixture(scope="module")
def documents(con):
    return con.sql("SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return QUERIES[name](spark, DATA).collect()


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, con, name):
    frame = QUERIES[name](spark, DATA)
    assert compare(frame.toPandas(), con.sql(ORACLES[name]).df()) is None


def test_near_duplicates(spark, documents):
    fps = [slow_fingerprint(t) for _, t, _, _ in documents]
    roots = brute_components(fps)
    want = {d[0]: (f"{f:016x}", documents[r][0]) for d, f, r in zip(documents, fps, roots, strict=True)}
    got = rows(spark, "op1_simhash_near_dedup")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(want)
    assert simhash.SHINGLE == simhash.MAX_BITS == 4


def test_license_scan(spark, documents):
    words = [set(licenses.tokens(t)) for _, t, _, _ in documents]
    vocabulary = {w for _, t in licenses.TEMPLATES for w in licenses.tokens(t)}
    having = {w: sum(w in x for x in words) for w in vocabulary}
    matcher = licenses.Matcher(licenses.TEMPLATES, len(documents), having, licenses.THRESHOLD)
    want = {d: matcher.best(t)[0] for d, t, _, _ in documents}
    got = rows(spark, "op2_license_scan")
    assert {r.doc_id: r.licence if r.how == "stated" else None for r in got} == want
    notices = {d for d, t, _, _ in documents if re.search(r"licensed under|MIT License|CC BY", t)}
    assert notices <= {d for d, name in want.items() if name}


def test_shared_passages(spark, documents):
    """Every document that shares 60 words in a row with an earlier one is found; what is found is alike."""
    first, want = {}, set()
    for d, t, _, _ in documents:
        words = t.lower().split()
        for i in range(len(words) - 59):
            if first.setdefault(" ".join(words[i : i + 60]), d) != d and len(set(words[i : i + 60])) > 10:
                want.add(d)
    got = rows(spark, "op3_substring_dedup")
    assert want <= {r.doc_id for r in got}
    texts = {d: t.encode() for d, t, _, _ in documents}
    for r in got:
        a, b = (substrings.word_hashes(texts[d]).tolist() for d in (r.doc_id, r.of_doc_id))
        a, b = a[r.start_word : r.end_word], b[r.of_start : r.of_end]
        assert piecewise.distance(a, b) <= r.errors <= 0.2 * max(len(a), len(b)) and min(len(a), len(b)) >= 50


def test_fingerprints_and_edits(spark, documents):
    down = documents[::-1]
    got = {r.doc_id: r for r in rows(spark, "op5_document_fingerprints")}
    assert len(got) == len(documents)
    for k, (d, t, _, _) in enumerate(down):
        after = down[(k + 1) % len(down)][1]
        changed = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == tuple(piecewise.fingerprint(x.encode()) for x in (t, changed))
    long = [r for r in got.values() if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.mean([r.near_next for r in long]) < 0.1


def test_pseudonyms(spark, documents):
    keyed = pseudonyms.Keyed(SAMPLE_KEY)
    got = {r.doc_id: r for r in rows(spark, "op6_pii_pseudonyms")}
    assert {d: r.text for d, r in got.items()} == {d: pseudonyms.pseudonymise(t, keyed)[0] for d, t, _, _ in documents}
    private = re.compile(r"[a-z]+\.\d\d@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b|AKIA[A-Z0-9]{16}")
    for d, t, _, _ in documents:
        found = {m[0] for m in private.finditer(t) if not m[0].isdigit() or pseudonyms.luhn(m[0]) % 10 == 0}
        assert not [x for x in found if x in got[d].text] and bool(found) <= bool(got[d].n_values)


def test_mixing_comes_near_its_targets(spark):
    got = rows(spark, "op7_source_mixing")
    by = {}
    for r in got:
        taken, target, largest = by.get(r.source_size, (0, r.target, 0))
        by[r.source_size] = taken + r.taken, r.target, max(largest, r.size)
        assert r.taken <= 3 * r.size
    assert all(abs(taken - target) <= 3 * largest for taken, target, largest in by.values())


def test_quality(spark, con):
    got = {r.doc_id: r for r in rows(spark, "op8_quality_classifier")}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    labels = dict(con.sql("SELECT doc_id, quality FROM labels").fetchall())
    right = [got[d].predicted == q for d, q in labels.items() if got[d].held_out]
    assert np.mean(right) > 0.8


def test_main_text(spark, con):
    got = {r.page_id: r for r in rows(spark, "op9_html_main_text")}
    for page, url, html in con.sql("SELECT page_id, url, html FROM pages").fetchall():
        r, words = got[page], re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*)</article>", html, re.S)[1])
        assert r.url == url and r.n_chars == len(r.text)
        assert "".join(r.text.split()) == "".join(__import__("html").unescape(re.sub(r"\s+", "", words)).split())


def test_tokens(spark, documents):
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in rows(spark, "op10_byte_bpe")}
    for d, t, _, _ in documents:
        ids = library.encode_ordinary(t)
        want = len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == want


def test_periodic_runs(spark, documents):
    got = {r.doc_id: r for r in rows(spark, "op13_periodic_runs")}
    assert len(got) == len(documents)
    for d, t, _, _ in documents:
        words = slow_planted(d, t)
        runs, r = slow_runs(words), got[d]
        best = min(((-n, s, q, n) for s, n, q in runs), default=None)
        want = (len(runs), *((best[1], best[3], best[2], 1000 * best[3] // best[2]) if best else (None,) * 4))
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
