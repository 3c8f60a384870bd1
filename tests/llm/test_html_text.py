import random
import re
from html import unescape

import pytest

from gridtide.llm import html_text as h


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 8))) for _ in range(n))


def page(rng, marked=True):
    """(html, main text) of an article among boilerplate."""
    blocks = [words(rng, rng.randrange(5, 60)) for _ in range(rng.randrange(1, 8))]
    title = words(rng, 6)
    body = f"<h1>{title}</h1>" + "".join(f"<p>{'<b>' if rng.random() < 0.2 else ''}{b} &amp; x{'<br>' if rng.random() < 0.3 else '</p>'}" for b in blocks)
    inner = '<aside class="promo"><p>' + words(rng, 20) + "</p></aside>" if rng.random() < 0.5 else ""
    comments = '<section class="comments"><p>' + words(rng, 40) + "</p></section>"
    kind = "article" if marked else "div"
    out = f"""<!DOCTYPE html><html><head><title>{words(rng, 5)}</title><style>p{{x:y}}</style><script>var a="</p>";if(a<b)x();</script></head>
    <body><header><p>{words(rng, 9)}</p></header><nav><ul>{"".join(f'<li><a href="/{i}">{words(rng, 2)}</a></li>' for i in range(6))}</ul></nav>
    <!-- <p>no</p> --><div class="ad">{words(rng, 30)}</div><{kind}>{body}{inner}<form><input value="a>b"><p>{words(rng, 8)}</p></form>{comments}</{kind}>
    <div id="cookie-notice"><p>{words(rng, 25)}</p></div><footer>&copy; {words(rng, 5)}</footer></body></html>"""
    return out, " ".join([title, *(b + " & x" for b in blocks)])


@pytest.fixture(scope="module")
def table():
    rng, counts = random.Random(1), h.Counter()
    for _ in range(60):
        counts.update(h.count(h.items(page(rng)[0])))
    return h.weights(counts)


@pytest.mark.parametrize("marked", [True, False])
def test_article_among_boilerplate(table, marked):
    rng = random.Random(2)
    for _ in range(60):
        html, text = page(rng, marked)
        assert h.extract(html, table) == text


WRAPPERS = [
    ('<div class="content has-sidebar">', "</div>"), ('<form action="/">', "</form>"), ('<div class="layout sidebar-right">', "</div>"),
    ('<section id="share-of-profit">', "</section>"), ('<div id="page" class="widget"><form class="signup">', "</form></div>"),
]


@pytest.mark.parametrize("marked", [True, False])
@pytest.mark.parametrize("before,after", WRAPPERS)
def test_names_do_not_overrule_the_region(table, marked, before, after):
    """Elements with names of boilerplate around the article or the page; what is boilerplate within still goes."""
    rng = random.Random(7)
    for _ in range(20):
        html, text = page(rng, marked)
        kind = "article" if marked else "div"
        assert h.extract(html.replace("<body>", f"<body>{before}").replace("</body>", f"{after}</body>"), table) == text
        around = html.replace(f"<{kind}><h1>", f"{before}<{kind}><h1>").replace(f"</section></{kind}>", f"</section></{kind}>{after}")
        assert h.extract(around, table) == text
        assert h.extract(html.replace("<article>", '<article class="post comments-open category-social">'), table) == text


@pytest.mark.parametrize("before,after", [*WRAPPERS, ('<article class="post comments-open">', "</article>")])
def test_small_pages_with_names(before, after):
    assert h.extract(f"<body>{before}<p>The story has some words.</p><p>And more of them.</p>{after}</body>", {}) == "The story has some words. And more of them."


def test_comments_longer_than_the_article():
    html = '<div><h1>Title here</h1><p>A short story.</p><div class="comments"><p>' + "what a comment " * 4 + "</p></div></div>"
    assert h.extract(html, {}) == "Title here A short story."


def test_words_are_positive_and_tags_negative(table):
    assert all(w < 0 for k, w in table.items() if k.startswith("t "))
    assert table["w p"] > 0 and table["w h1"] > 0 and table["w li a x"] < 0


def test_region_is_the_best_one():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.randrange(-5, 5) for _ in range(rng.randrange(0, 12))]
        a, b = h.region(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[a:b]) == max([0, *sums])


@pytest.mark.parametrize(
    "html,text",
    [
        ("", ""), ("<p>", ""), ("   ", ""), ("plain words", "plain words"), ("<p>a &lt; b &#233;&nbsp;c&copy d", "a < b é c© d"),
        ("<p>a<b>b</b>c <i>d</i></p><p>e", "abc d e"), ("<p>a<br>b\n\t c</p>", "a b c"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p>x<!-- never closed <p>y</p>", "x"), ("<p>x</p><script>y()", "x"), ("<p title='a>b'>x</p>", "x"), ("<P>Up</P><SCRIPT>z</SCRIPT>", "Up"),
        ("<article>only</article>", "only"), ("<nav>menu</nav>", ""), ("</p></div>stray", "stray"), ("<p>a</p", "a"),
    ],
)
def test_small_pages(html, text):
    assert h.extract(html, {}) == text


def test_operator(spark, table):
    rng = random.Random(4)
    rows = [(i, f"u{i}", *page(rng)) for i in range(40)]
    rows += [(100, None, None, ""), (101, "u", "", ""), (None, "u", "<p>x</p>", "x"), (0, *rows[0][1:]), (102, "u", "<p>" + "w " * 50_000, ("w " * 50_000).strip())]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, want string, text string, n_chars int")
    got = sorted((tuple(r) for r in h.main_text(df.repartition(3)).collect()), key=str)
    assert got == sorted(((i, u, w, len(w)) for i, u, _, w in rows), key=str)


def test_broken_utf8(spark):
    rows = spark.sql("SELECT 1L AS page_id, 'u' AS url, CAST(X'3C703E61FF62' AS STRING) AS html")
    assert [(r.text, r.n_chars) for r in h.main_text(rows).collect()] == [("a\ufffdb", 3)]


def test_empty_table(spark):
    assert h.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_broken_pages_take_linear_time():
    for part in ("<p>a", "<!--", "<a href='", "<", "&amp", "<script>", "</p>", '<p x="', "<b"):
        h.extract(part * 20_000, {})


def test_sample_pages(spark):
    """On the sample tables, whose pages mark their article: what stands between its tags."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    counts = h.Counter()
    for r in rows:
        counts.update(h.count(h.items(r.html or "")))
    table = h.weights(counts)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner)
        want = " ".join(t for t in (" ".join(unescape(re.sub(r"<[^>]*>", lambda m: "\n" if m[0] == "<br>" else "", p)).split()) for p in parts) if t)
        assert h.extract(r.html, table) == want
        assert h.extract(r.html.replace("<article>", "<div>").replace("</article>", "</div>"), table) == want
