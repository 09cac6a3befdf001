"""Block reader, recurrent labeller and extraction of pages."""

import html
import re

import numpy as np
import pytest

from demand_engine.llm import bilstm, html_extract
from demand_engine.llm.htmlblocks import blocks
from demand_engine.llm.pagemaker import PageMaker


def _texts(page):
    return [text for _, text, _ in blocks(page)]


@pytest.mark.parametrize(("page", "want"), [
    ("", []), ("plain  text\n here", ["plain text here"]), ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]), ("<p>a &amp; b&nbsp;&#65;&eacute; &am x</p>", ["a & b Aé &am x"]),
    ("<p>one<br>two <b>bo<i>ld</b></p>", ["one two bold"]), ('<script>var t="</p><p>no</p>";</script><p>yes</p><style>p{}</style>', ["yes"]), ("<!-- <p>no</p> --><p>yes<!--", ["yes"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ('<p title="a > b">x</p>', ["x"]),
    ("<p>a < b</p>", ["a < b"]), ("<SCRIPT>x</script\n><P>y", ["y"]), ("<script>never closed <p>x</p>", []), ("</p></div>x</b>", ["x"]), ('<p class="a>x', ["x"]), ("<p>a<", ["a<"]),
])
def test_blocks_of_broken_and_plain_pages(page, want):
    assert _texts(page) == want


def test_blocks_carry_their_elements_and_links():
    got = blocks('<body><div class="postBody main-text" id=x1 role=main><p>see <a href="#">there</a></p></div><ul><li>a<li><a>b</a></ul>')
    assert got[0][0] == ["body", "div", ".post", ".body", ".main", ".text", ".x", ".1", ".main", "p"]
    assert got[0][2] == pytest.approx(5 / 9) and got[1][0] == ["body", "ul", "li"] and got[2][2] == 1.0


def test_gradients_of_the_network():
    rnd = np.random.default_rng(4)
    w = bilstm.new_weights((7, 9), 3, 2, 4, 1)
    lengths = np.array([3, 1, 5])
    bag = lambda rows: (rnd.integers(0, rows, 20), np.array([0, 2, 2, 5, 6, 9, 12, 14, 17, 20]))
    bags, numbers, y = [bag(7), bag(9)], rnd.normal(size=(9, 2)), np.array([1, 0, -1, 1, 0, 0, 1, -1, 1])
    _, grads = bilstm.gradients(w, bags, numbers, lengths, y)
    for k, g in grads.items():
        for at in list(np.ndindex(*g.shape))[:: max(1, g.size // 12)]:
            old, sides = w[k][at], []
            for d in (1e-5, -1e-5):
                w[k][at] = old + d
                sides.append(bilstm.gradients(w, bags, numbers, lengths, y)[0])
            w[k][at] = old
            assert g[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-7), k


def test_sequences_are_labelled_alike_alone_and_together():
    rnd = np.random.default_rng(2)
    w = bilstm.new_weights((5,), 3, 0, 4, 3)
    lengths = [4, 1, 6]
    x = rnd.normal(size=(11, 3))
    alone = np.concatenate([bilstm.logits(w, part, np.array([len(part)])) for part in np.split(x, np.cumsum(lengths)[:-1])])
    assert np.allclose(alone, bilstm.logits(w, x, np.array(lengths)))
    long = (rnd.integers(0, 5, 700_000), np.array([0, 3, 3, 600_000, 700_000]))
    want = [w["table0"][long[0][a:b]].mean(0) if b > a else np.zeros(3) for a, b in zip(long[1], long[1][1:], strict=False)]
    assert np.allclose(bilstm.bag_means(w["table0"], long), want)


def _article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(x for x in parts if x)


@pytest.fixture(scope="module")
def labeller(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/../sf0.01/pages.parquet")
    return html_extract.fit(html_extract.sample_pages(pages.where("page_id % 2 = 0"), "page_id", "html"))


def test_pages_with_other_layouts_held_out(spark, sf_small, labeller):
    real = [blocks(r["html"]) for r in spark.read.parquet(f"{sf_small}/../sf0.01/pages.parquet").where("page_id % 2 = 1").collect()]
    pick = lambda y: [t for page in real for p, t, _ in page if html_extract.own_label(p) == y]
    maker = PageMaker(pick(1), pick(0), 1234)
    made = [x for x in (html_extract._marked(maker.page()) for _ in range(400)) if x[0]]
    got = np.concatenate(html_extract.label(labeller, [b for b, _ in made], html_extract.Reader()))
    want = np.concatenate([y for _, y in made])
    assert (got == want).mean() > 0.985


def test_pages_without_telling_tags(labeller):
    page = '<div class="top"><a href="/">Home</a> <a href="/a">About us</a></div><div class="post-body"><h2>A title</h2>' + "".join(
        f"<p>This is paragraph {i} of the text that the page is about, and it goes on for some words more.</p>" for i in range(4)
    ) + '</div><div id="sidebar"><h3>Related</h3><a href="x">Another story</a></div><div class="user-comments"><p>Ann</p><p>I did not like this at all, it was a waste of time to read.</p></div><div class="footer">© 2020 us</div>'
    found = blocks(page)
    good = html_extract.label(labeller, [found], html_extract.Reader())[0]
    assert [t for (_, t, _), y in zip(found, good, strict=True) if y] == ["A title", *(f"This is paragraph {i} of the text that the page is about, and it goes on for some words more." for i in range(4))]


def test_extraction_of_a_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    rows = {r["page_id"]: r for r in pages.collect()}
    odd = [(10_001, None, None), (10_002, "u", ""), (10_003, "u", "<nav><a href=x>Home</a></nav>"), (10_003, "u", "<nav><a href=x>Home</a></nav>"), (None, "u", rows[0]["html"]), (10_004, "u", "<article>" + "<p>" + "long text " * 200_000 + "</article>")]
    more = spark.createDataFrame(odd, "page_id long, url string, html string")
    df = pages.select("page_id", "url", "html").union(more).withColumn("text", html_extract.F.lit("clash"))
    got = html_extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len(rows) + len(odd)
    for i, url, text, n in out:
        assert n == len(text)
        if i in rows:
            assert (url, text) == (rows[i]["url"], _article(rows[i]["html"]))
    by = {i: text for i, _, text, _ in out}
    assert by[10_001] == by[10_002] == by[10_003] == "" and by[None] == _article(rows[0]["html"])
    assert len(by[10_004]) == 10 * 200_000 - 1
    assert html_extract.extract(df.limit(0)).collect() == []
