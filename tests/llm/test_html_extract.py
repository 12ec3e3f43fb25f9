"""Main text of pages: a plain reading of the given pages, and hand-made ones."""

import html
import re

import pytest
from stratamart.llm import html_extract as H


def plain(page):
    """Main text of the given tables' pages, read by their fixed template."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@pytest.fixture(scope="module")
def weights(pages):
    return H.learn_weights(pages)


def text(page, weights):
    return "\n".join(b[0] for b in H.Page(page).main_blocks(weights)[0])


def test_given_pages(pages):
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    got = H.main_text(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_scan_without_declared_container(pages, weights):
    rows = [r["html"] for r in pages.collect()]
    bare = [re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", x).replace('class="ad"', 'class="x"') for x in rows]
    right = sum(text(b, weights) == plain(x) for b, x in zip(bare, rows))
    assert right >= 0.95 * len(rows)


def test_weights_are_learned(weights):
    assert weights["word", "p"] > 0.99 > 0.01 > weights["word", "li/a"]
    assert weights["tag", "li"] > 1 > weights["tag", "p"] > 0


@pytest.mark.parametrize("page, want", [
    ("", ""), ("just words", "just words"), ("a &lt;b&gt; &amp;amp; c", "a <b> &amp; c"),
    ("<article><p>a <!-- x > y --> b<script>var t='</p>';</script> c</p></article>", "a b c"),
    ("<p>one\n  two&nbsp;three<br>four<p><b>five</b> <i>s</i>ix", "one two three four\nfive six"),
    ("<nav><ul><li>menu<article><h1>T</h1><p>text here</p></article>", "T\ntext here"),
    ("<article><p>a b c</p><div class='ad-slot'>buy</div><aside>s</aside><form>f</form><p>d e</p></article><footer>f", "a b c\nd e"),
    ("<main><p>a b c d</p></main><div id=comments><p>first first first first first</p></div>", "a b c d"),
    ("<div class='cookie-notice'><p>we use many many many cookies</p></div><div class='has-sidebar'><p>x y</p></div>", "x y"),
    ("<article><p>long text of it</p><article class='comment'><p>nice nice nice</p></article></article>", "long text of it"),
    ("<article><p title='a>b'>in</p><ul><li>point</li></ul></article>", "in\npoint"),
    ("<div><p>side</p></div><div id=c><h1>T</h1><p>a b c d e f g</p><p>h i</p><ul><li>point one</li><li><a href=x>more</a></li></ul></div><div>z</div>",
     "T\na b c d e f g\nh i\npoint one"),
    ("<p>a b c</p><ul><li><a href=x>l</a></li></ul>", "a b c"),
    ("<div class='menu-wrap'><article><p>a b c</p></article></div>", "a b c"),
    ("x < y and y > z", "x < y and y > z"),
    ("<article></article><nav><a>n</a></nav>", ""), ("<style>p{}</style><script>", ""), ("<p", ""), ("&amp", "&")])
def test_hand_made(weights, page, want):
    assert text(page, weights) == want


def test_deep_and_long_pages(weights):
    deep = "<div>" * 50_000 + "<p>word</p>"
    assert H.Page(deep).blocks[0][0] == "word"
    assert text("<article>" + "<p>some words here</p>" * 20_000 + "</article>", weights).count("\n") == 19_999
    assert H.Page("<a href='" * 20_000 + "<p>" * 1000 + "'\"" * 1000).main_blocks(weights)[0] is not None


def test_scan_is_the_best_region():
    import itertools
    import random
    rnd = random.Random(3)
    for _ in range(200):
        page = "".join(rnd.choice(("<p>a b</p>", "<div>c</div>", "<li><a>d</a></li>", "<h2>e f g</h2>", "<hr>")) for _ in range(8))
        w = {("word", "p"): 1.0, ("word", "div"): 0.3, ("word", "li/a"): 0.1, ("word", "h2"): 0.7, ("tag", "p"): 0.2, ("tag", "a"): 0.1,
             ("tag", "div"): 0.4, ("tag", "li"): 0.9, ("tag", "h2"): 0.3, ("tag", "hr"): 0.5}
        p = H.Page(page)
        score = [-w[("tag", s)] if b is None else x * w[("word", s)] for s, b, x in p.sequence]
        best = max((sum(score[i:j]) for i, j in itertools.combinations(range(len(score) + 1), 2)), default=0)
        assert abs(p.region(w)[2] - max(0, best)) < 1e-9


def test_nulls_repeats_empties_and_clashing_columns(spark):
    rows = [(1, "u", "<p>a b", "x", 1.0), (1, "u", "<p>a b", "x", 1.0), (None, None, None, None, None), (2, "v", "", "x", 2.0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, score double")
    got = sorted((tuple(r[:4]) for r in H.main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert H.main_text(df.filter("page_id = 9")).count() == 0
