import itertools
import random
from math import exp

import pytest

from cuenca.llm import html_extract as X

PAGE = ('<!DOCTYPE html><html lang="en"><head><title>No</title><style>p{}</style><script>var t="</p>";x(1);</script></head><body><nav><ul><li><a href="/a">A</a></li>'
        '<li><a href="/b">B</a></li></ul></nav><!-- ad --><div class="ad">Buy this. Now.</div><article><h1>Fish &amp; chips</h1><p><b>A  story of\n fish&nbsp;and chips.<br><p>It was eaten at the'
        ' port, as people do, and it was good.</p><p>Then &quot;more&quot; came &amp came late. &#233;&#x4e2d;</p></article><footer>&copy; Nobody. All rights.</footer></body></html>')
TEXT = 'Fish & chips\nA story of fish and chips.\nIt was eaten at the port, as people do, and it was good.\nThen "more" came & came late. é中'


@pytest.fixture(scope="module")
def model():
    return X.learn()


def test_page_and_cut_pages(model):
    assert X.main_text(PAGE, model) == TEXT
    assert X.main_text(PAGE[:PAGE.index("</article>")], model) == TEXT
    cut = X.main_text(PAGE[:PAGE.index("came &amp") + 8], model)
    assert cut.endswith('Then "more" came &am')
    for k in range(0, len(PAGE), 7):        # cut anywhere
        X.main_text(PAGE[:k], model)


def test_labelled_pages_are_recovered():
    """A model of the composed pages alone finds the content of the others."""
    other = X.learn(X.composed())
    right = total = 0
    for page in X.LABELLED:
        nodes = X.ordered(X.parse(page))
        X.measure(nodes)
        state = {}
        for node in nodes:
            state[id(node)] = node.label if node.label is not None else state[id(node.parent)] if node.parent else 0
        for node, p in zip(nodes, X.marginals(nodes, other)):
            right += node.own * ((p >= 0.5) == (state[id(node)] == 1))
            total += node.own
    assert right / total > 0.9


def test_marginals_equal_the_sum_over_all_states(model):
    rng = random.Random(1)
    for _ in range(20):
        html = "".join(rng.choice(["<div>", "</div>", "<p class=comment>", "text. ", "<a href=x>link</a>", "<ul><li>", "words and words"]) for _ in range(9))
        nodes = X.ordered(X.parse(html))
        X.measure(nodes)
        if len(nodes) > 9:
            continue
        at = {id(n): k for k, n in enumerate(nodes)}
        weight, one = 0.0, [0.0] * len(nodes)
        for ys in itertools.product((0, 1), repeat=len(nodes)):
            w = model["root"][ys[0]]
            for k, n in enumerate(nodes):
                w += sum(model[f][ys[k]] for f in X.features(n) if f in model)
                if k:
                    w += model["pair"][ys[at[id(n.parent)]]][ys[k]]
            weight += exp(w)
            for k, y in enumerate(ys):
                one[k] += y * exp(w)
        assert X.marginals(nodes, model) == pytest.approx([x / weight for x in one], rel=1e-9)


def test_furniture_is_left_out(model):
    page = ('<body><header class="masthead"><p>The Sun. Since 1900.</p></header><div id="main-menu"><a href=a>x</a> <a href=b>y</a></div><main><h1>Title of it</h1>'
            '<p>The first part of the story is told here, in some words.</p><form><label>Name</label><input></form><p>The second part follows it, and then it ends.</p>'
            '<section class="comments"><h3>Comments</h3><p>Nice one, I liked it. Thanks.</p></section></main><aside class="sidebar"><p>Most read today.</p></aside>'
            '<div class="cookie-banner">We use cookies here. OK?</div></body>')
    text = X.main_text(page, model)
    assert "first part" in text and "second part" in text and "Title" in text
    for word in ("Since", "Name", "Nice", "Most read", "cookies", "x y"):
        assert word not in text


def test_nulls_deep_pages_empty_tables(spark, model):
    deep = "<div>" * 3000 + "<p>deep down, a story is told. It is long enough.</p>"
    rows = [(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE), (3, "u", deep), (4, "u", "no tags at all"), (5, "u", "<<>>&<p")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    out = X.extract(df).collect()
    assert len(out) == 7 and [r.text for r in out if r.page_id == 2] == [TEXT, TEXT]
    assert all(r.n_chars == len(r.text) for r in out) and [r.text for r in out if r.page_id in (1, None)] == ["", ""]
    assert X.extract(df.limit(0)).count() == 0


def test_attribute_values_of_real_pages_are_no_labels(spark):
    page = '<div data-y="12.5" my-data-y="x" data-class="nav"><article><p>%s</p></article></div>' % ("The text of an article, with sentences. " * 5)
    rows = [(k, "u", page.replace("12.5", v)) for k, v in enumerate(["12.5", "0", "1", "", "abc"])]
    got = {r["text"] for r in X.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {("The text of an article, with sentences. " * 5).strip()}


def test_formulas_and_listings_stay():
    model = X.learn()
    long = "This is the text of the article, which is long enough to be one. It has sentences."
    assert X.main_text(f"<article><p>If <math><mi>x</mi></math> then {long}</p><p>{long} <xmp>a < b &amp; c</xmp></p></article>", model) == \
        f"If x then {long}\n{long} a < b &amp; c"


def test_unclosed_and_needless_tags_take_linear_time():
    import time
    model = X.learn()
    for page in ("<article><p>" + "<b>w " * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>w " * 50_000 + "</i>" * 50_000,
                 "<article>" + "<li>w " * 50_000 + "</p>" * 50_000):
        t = time.time()
        X.main_text(page, model)
        assert time.time() - t < 30


def test_closing_rules():
    def shape(node):
        return [node.tag, *(x if isinstance(x, str) else shape(x) for x in node.items)]
    assert shape(X.parse("<p>a<b>c<p>d</b>e")) == ["html", ["p", "a", ["b", "c"]], ["p", "d", "e"]]
    assert shape(X.parse("<ul><li>a<ul><li>b</ul><li>c</ul>d")) == ["html", ["ul", ["li", "a", ["ul", ["li", "b"]]], ["li", "c"]], "d"]
    assert shape(X.parse("<table><tr><td>a<td>b<tr><th>c</table>")) == ["html", ["table", ["tr", ["td", "a"], ["td", "b"]], ["tr", ["th", "c"]]]]
    assert shape(X.parse("<i>a<div>b</i>c</div>d</i>e")) == ["html", ["i", "a", ["div", "b", "c"], "d"], "e"]
    assert shape(X.parse("<dl><dt>a<dd>b<dt>c</dl></dl>")) == ["html", ["dl", ["dt", "a"], ["dd", "b"], ["dt", "c"]]]
