from itertools import product

import numpy as np
import pytest

from astrolode.llm import html_crf as crf
from astrolode.llm.dom import blocks

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{a:b}</style><script>var t="</p>";</script>
</head><body><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy &amp; save now.</div><article><h1>Title &lt;1&gt;</h1><p>First  para,&nbsp;with <b>bold
<br>text.<p>Second &eacute; para<p>Third one is a little longer, and it ends here.</article>
<div id="comments"><p>I do not agree with this at all, said a reader.</p></div>
<footer>&copy; someone</footer></body>"""


@pytest.fixture(scope="module")
def model():
    return crf.train(crf.labelled([PAGE] * 3))


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.1/pages.parquet")


def test_blocks():
    assert [b.text for b in blocks(PAGE)] == [
        "One", "Two", "Buy & save now.", "Title <1>", "First para, with bold text.", "Second é para",
        "Third one is a little longer, and it ends here.",
        "I do not agree with this at all, said a reader.", "© someone"]
    first = blocks(PAGE)[0]
    assert [t for t, _ in first.ancestors] == ["html", "body", "nav", "ul", "li"]
    assert first.link_chars == 3


@pytest.mark.parametrize("html,want", [
    ("", []), ("  \n ", []), ("plain", ["plain"]), ("a < b", ["a < b"]), ("<p", ["<p"]),
    ("<p>a<script>x", ["a"]), ("<!-- open <p>a</p>", []), ("</p></div>a", ["a"]),
    ("<p title='a>b'>c</p>", ["c"]), ("<p title='a>c</p>", ["c"]), ("a<br/>b<hr>c", ["a b", "c"]),
    ("<div style='display: none'>x<p>y</div>z", ["z"]), ("<noscript><p>x</noscript>y", ["y"]),
    ("<svg><text>x</text></svg>y", ["y"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<textarea><p>x</textarea>y", ["y"]), ("<dl><dt>a<dd>b</dl>", ["a", "b"]), ("&#x41;&bogus;", ["A&bogus;"]),
    ("<a " * 3000, ["<a " * 2999 + "<a"]),
])
def test_odd_markup(html, want):
    assert [b.text for b in blocks(html)] == want


def test_viterbi_is_the_best_of_all_labellings(model):
    rng = np.random.default_rng(5)
    for _ in range(20):
        held = model.weights | {f"words {i}": float(rng.normal()) for i in range(8)}
        random_ = crf.Model(held, tuple(map(tuple, rng.normal(size=(2, 2)))), tuple(rng.normal(size=2)))
        page = blocks(PAGE)
        score = [sum(held.get(n, 0.0) for n in f) for f in crf.features(page)]

        def total(y):
            moves = sum(random_.moves[a][b] for a, b in zip(y, y[1:], strict=False))
            return random_.start[y[0]] + moves + sum(s for s, v in zip(score, y, strict=True) if v)

        best = max(product((0, 1), repeat=len(page)), key=total)
        assert crf.decode(page, random_) == list(best)


def test_given_pages_are_read_whole(given):
    found = crf.extract(given, crf.learn(given)).toPandas().set_index("page_id")
    exact = 0
    for row in given.collect():
        want = "\n".join(b.text for b in blocks(row["html"]) if any(t == "article" for t, _ in b.ancestors))
        got = found.loc[row["page_id"]]
        assert got["n_chars"] == len(got["text"]) and got["url"] == row["url"]
        exact += got["text"] == want
    assert exact >= 0.99 * len(found)


def test_held_out_layouts(given):
    pages = [r["html"] for r in given.orderBy("page_id").limit(260).collect()]
    made = crf.train(crf.labelled(pages[:150]))
    hits = said = true = 0
    for page, label in crf.labelled(pages[150:], seed=77):
        got = crf.decode(page, made)
        hits += sum(a and b for a, b in zip(got, label, strict=True))
        said, true = said + sum(got), true + sum(label)
    assert hits / said > 0.97 and hits / true > 0.97


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", PAGE, "x", "y"), (1, "u", PAGE, "x", "y"), (None, None, None, None, None),
            (2, None, "", None, None), (3, "v", "<p>" + "word " * 200_000, None, None)]
    pages = spark.createDataFrame(rows, schema)
    got = crf.extract(pages, crf.learn(pages)).collect()
    by_id = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 5 and by_id[None] == "" and by_id[2] == ""
    assert by_id[1].startswith("Title <1>\nFirst para")
    none = spark.createDataFrame([], schema)
    assert crf.extract(none, crf.learn(none)).collect() == []


@pytest.mark.parametrize("html, want", [
    ('<p title="a hidden gem">one</p><p data-hidden="false">two</p><p class=hidden>three</p>',
     ["one", "two", "three"]),
    ('<p title="x style=\'display:none\'">one</p><p alt=hidden>two</p><p data-style="display:none">x', ["one", "two", "x"]),
    ('<div aria-hidden="true"><p>one</p></div><p aria-hidden=true>two', ["one", "two"]),
    ('<p>a <math><mi>x</mi></math> b</p><object data="f"><p>instead</p></object>', ["a x b", "instead"]),
    ("<p>one<xmp><b>two</b> &amp; 3</xmp>four", ["one", "<b>two</b> &amp; 3", "four"]),
    ("<xmp hidden>no</xmp><xmp>to the end <p>", ["to the end <p>"]),
    ('<p hidden>no</p><p HIDDEN="">no</p><p title="x"hidden>no</p><div style="color:red; display : none">no</div>yes', ["yes"]),
    ('<p style="display:none !important">no</p><p style="x-display:none">yes', ["yes"]),
])
def test_only_what_is_not_shown_is_left_out(html, want):
    assert [b.text for b in blocks(html)] == want
