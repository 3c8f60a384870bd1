import random

import pytest

from gridtide.llm import licenses as li


def matcher(files=1000, having=None, threshold=li.THRESHOLD):
    return li.Matcher(li.TEMPLATES, files, having or {"the": 900, "this": 700, "license": 12, "licensed": 12, "under": 300, "is": 800}, threshold)


@pytest.mark.parametrize("name,text", li.TEMPLATES)
def test_templates_find_themselves(name, text):
    filler = "words of prose that have no licence to give here. " * 30
    for whole in (text, f"{filler}\n{text}.\n{filler}", f"{filler} {text.upper()}"):
        found = matcher().best(whole)
        assert found[0] == name and found[1] > 0.99
        assert whole.lower()[found[2] : found[3]] == text.lower().rstrip(".")


def test_small_changes_and_plain_text():
    assert matcher().best("It is licenced, and licensed under the Apache-License version 2.0, see there")[0] == "Apache-2.0"
    assert matcher().best("the license of the driver is under the seat, this is the version")[0] is None
    assert matcher().best("")[0] is None


LONG = [(n, t) for n, t in li.TEMPLATES if len(li.tokens(t)) >= 12]


@pytest.mark.parametrize("name,text", LONG)
def test_any_one_word_may_lack_or_differ(name, text):
    """Whichever word is the rarest: a notice is found without it if its cosine reaches the bound."""
    words, filler = text.split(), "words of prose that have no licence to give here. " * 5
    for rare in range(len(words)):
        m = matcher(100_000, {w: 900 for _, t in li.TEMPLATES for w in li.tokens(t)} | {w: 40 for w in li.tokens(words[rare])})
        for changed in (words[:rare] + words[rare + 1 :], [*words[:rare], "changed", *words[rare + 1 :]]):
            whole = f"{filler}{' '.join(changed)}. {filler}"
            found, want = m.best(whole), plain_scan(m, whole)
            assert (found[0], round(found[1], 9)) == want and (want[0] or want[1] == 0)
            if len(words) > 15:
                assert found[0] == name


def plain_scan(m, text):
    """All windows of all templates, without any bound."""
    place, out = li.tokens(text), (None, 0.0)
    for (name, t), (_, vector, norm, length, _) in zip(li.TEMPLATES, m.templates, strict=True):
        named = set(li.tokens(t.partition(":")[2])) if t.startswith("SPDX") else set()
        for start in range(len(place)):
            part = li.Counter(place[start : start + length])
            dot = sum(n * m.idf[w] * vector[w] for w, n in part.items() if w in vector)
            cosine = min(dot / li.math.sqrt(sum((n * m.idf.get(w, m.other)) ** 2 for w, n in part.items())) / norm, 1.0)
            if named <= part.keys() and cosine >= li.THRESHOLD and cosine > out[1] + 1e-9:
                out = (name, cosine)
    return out[0], round(out[1], 9)


def test_equals_a_scan_of_all_windows():
    rng, vocabulary = random.Random(5), sorted({w for _, t in li.TEMPLATES for w in li.tokens(t)})
    hits = 0
    for _ in range(300):
        words = rng.choice(li.TEMPLATES)[1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice([*vocabulary, "other", ""])
        text = " ".join([*rng.choices(vocabulary, k=8), *words, *rng.choices(vocabulary, k=rng.randrange(8))])
        m = matcher(5000, {w: rng.choice([3, 60, 900]) for w in vocabulary})
        found = m.best(text)
        assert (found[0], round(found[1], 9)) == plain_scan(m, text)
        hits += found[0] is not None
    assert 100 < hits


def test_an_spdx_line_names_its_licence():
    assert matcher().best("SPDX-License-Identifier: Zlib")[0] is None and matcher().best("// SPDX-License-Identifier: MIT")[0] == "MIT"


def brute(rows):
    """rows: (id, path, text)."""
    words = [set(li.tokens(t or "")) for _, _, t in rows]
    vocabulary = {w for _, t in li.TEMPLATES for w in li.tokens(t)}
    m = li.Matcher(li.TEMPLATES, len(rows), {w: sum(w in x for x in words) for w in vocabulary}, li.THRESHOLD)
    own = [(i, p, m.best(t or "")) for i, p, t in rows]
    files = {}
    for _, p, (name, score, *_) in own:
        if p is not None and name and __import__("re").match(li.LICENCE_FILE, p.rpartition("/")[2]):
            d = p.rpartition("/")[0]
            files[d] = min(files.get(d, (0, "~")), (-score, name))
    out = []
    for i, p, (name, score, _, _) in own:
        how, at = ("stated" if name else "none"), None
        if not name and p is not None:
            d = p.rpartition("/")[0]
            while True:
                if d in files:
                    name, how, at = files[d][1], "inherited", d
                    break
                if not d:
                    break
                d = d.rpartition("/")[0]
        out.append((i, p, name, how, round(score, 9), at))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.path, r.licence, r.how, round(r.score, 9), r.from_dir) for r in df.collect()), key=str)


def test_scan_equals_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        path = "/".join(rng.choice("abc") for _ in range(rng.randrange(0, 5)))
        text = " ".join(rng.choice(["the", "of", "version", "public", "alpha", "beta"]) for _ in range(30))
        if rng.random() < 0.2:
            text += "\n" + rng.choice(li.TEMPLATES)[1] + ".\nmore text"
        name = rng.choice([f"f{i}.py", "LICENSE", "copying.txt", "license_reader.py"]) if rng.random() < 0.3 else f"f{i}.c"
        rows.append((i, f"{path}/{name}" if path else name, text))
    rows += [(900, None, "x"), (None, "a/b/x", None), (901, "", ""), (902, "a/b/c/", li.TEMPLATES[0][1]), rows[0], (903, "//x", "y"), (904, "a/x", "the " * 50_000)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, path string, text string, dir string, score int")
    got = result(li.scan(df.repartition(4)))
    assert got == brute(rows) and {"stated", "inherited", "none"} == {r[3] for r in got}


def test_odd_documents(odd_docs, no_docs):
    got = li.scan(li.shelved(odd_docs))
    assert got.count() == odd_docs.count() and {r.how for r in got.collect()} == {"none"}
    assert li.scan(li.shelved(no_docs)).count() == 0
