"""The recurrent block labeller."""

import html
import re
import time

import numpy as np
import pytest

from tallyline.llm.html_text import Labeller, Pages, blocks, extract, hinted, learnt, main_text, sample_blocks, train


@pytest.fixture(scope="module")
def labeller():
    import duckdb
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet' ORDER BY page_id").fetchall()
    return train([learnt(r[0]) for r in rows])


def reference(page):
    """The text of the given pages, which all mark their article."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = [html.unescape(re.sub(r"<[^>]*>", " ", x)) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(y for y in (" ".join(x.split()) for x in parts) if y)


def test_blocks():
    page = ('<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="pageTop"><p>One &amp; two<b>three</b>\n four<br>five'
            "<p id='x'>six<!-- no <p> --> seven<script>var t='</p>';</script><ul><li>a<li><a href='1>2'>b</a></ul>&lt;p&gt; <img alt=\"x>y\"> tail</div>end")
    found = blocks(page)
    assert [b.text for b in found] == ["One & twothree four five", "six seven", "a", "b", "<p> tail", "end"]
    assert ".page" in found[0].names and ".top" in found[0].names and found[3].linked == 1
    assert blocks("") == [] and [b.text for b in blocks("only text <")] == ["only text <"]
    assert [b.text for b in blocks("<p>" * 3000 + "x" + "</div>" * 3000)] == ["x"]


@pytest.mark.parametrize("page, n", [
    ("<a " * 700_000, 1), ("<a " * 700_000 + ">x", 1), ("<b>x" * 500_000, 1), ("<div>x" * 350_000, 350_000), ('<a href="x' * 200_000, 1),
    ("<" * 2_000_000, 1), ("x<!--" * 400_000, 1), ("<svg>x" * 350_000, 1), ("</div>x" * 300_000, 300_000)])
def test_long_and_broken_pages_are_read_in_one_pass(page, n):
    start = time.perf_counter()
    assert len(blocks(page, hints=False)) == n
    assert time.perf_counter() - start < 60  # a quadratic reader takes hours


def test_comments_left_open_hide_the_rest():
    assert [b.text for b in blocks("<p>a</p>b<!-- c <p>d</p>")] == ["a", "b"]
    assert [b.text for b in blocks("<p>a</p>b<!-- c")] == ["a", "b"]
    assert [b.text for b in blocks("a<!-- x -->b > c")] == ["ab > c"]


def test_nesting_has_a_bottom():
    deep = blocks("".join(f"<div class=c{k}>" for k in range(1000)) + "x" + "</div>" * 999 + "y</div>z")
    assert [b.text for b in deep] == ["x", "y", "z"] and len(deep[0].path) < 300


def test_pages_of_any_size_are_learnt_from(spark):
    """Where all pages are long, the labeller still learns from them: from their beginning and end."""
    page = "<nav><p>Menu</p></nav><article>" + "<p>word " * 30_000 + "</article><footer><p>{}</p></footer>"
    assert len(page) > 3 * 64 << 10
    df = spark.createDataFrame([(k, "u", page.format(k)) for k in range(6)] * 2 + [(9, "u", None), (8, "u", "")], "page_id long, url string, html string")
    found = sample_blocks(df, 4)
    assert len(found) == 4
    for sequence in found:
        assert sequence[0].text == "Menu" and sequence[-1].text.isdigit() and any(hinted(b.names) for b in sequence)
        assert 60_000 < sum(len(b.text) for b in sequence) <= (64 << 10) + 10
    whole = learnt(page[:1000])
    assert whole == blocks(page[:1000])


def test_hints():
    inside = [hinted(b.names) for b in blocks("<article><h1>t</h1><p>x</p><div class='ad'>y</div></article><nav><p>z</p></nav><p>w</p>")]
    assert inside == [True, True, False, False, False]


def test_held_out_pages(labeller, table):
    rows = [r.html for r in table("pages", "/root/testdata/sf0.01").collect()]
    got = main_text(labeller, rows)
    assert sum(g == reference(r) for g, r in zip(got, rows)) / len(rows) > 0.99


def test_pages_of_another_make(labeller):
    page = ('<html><body><div id="header"><a href="/">Site name</a></div><div class="menu"><ul><li><a>Home</a><li><a>News</a></ul></div>'
            '<div class="cookie-notice">We use cookies</div><div class="content"><h1>Head &amp; line</h1><p>First paragraph of the story.'
            '<p>Second &lt;one&gt; here<br>line two.<div class="ad">Buy now</div><p>Third paragraph of it.</p><form><label>Name</label>'
            '<button>Send</button></form></div><div class="sidebar"><p>More stories</p></div><section id="comments"><h2>Comments</h2>'
            '<div class="comment"><p>I liked this.</p></div></section><footer><p>Copyright</p></footer></body></html>')
    assert main_text(labeller, [page]) == ["Head & line\nFirst paragraph of the story.\nSecond <one> here line two.\nThird paragraph of it."]


def test_edge_rows(spark, labeller):
    long = "<article>" + "<p>word word</p>" * 3000 + "<p>" + "w " * 50000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<nav><a>Home</a></nav>"), (4, "u", long), (4, "u", long), (5, "u", "<<<>>> &bogus; &#x41;")]
    out = extract(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string"), labeller)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == texts[None] == "" and texts[4].count("word word") > 2900 and len(texts[4]) > 100_000
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(empty).collect() == []


def test_query_trains_on_its_own_pages(table):
    pages = table("pages")
    want = {r.page_id: reference(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in extract(pages).collect()} == want


def test_gradients():
    """Back-propagation against differences of the loss."""
    rng = np.random.default_rng(1)
    model = Labeller(3)
    pages = [blocks("<article><p>a b</p><p>c</p></article><nav><li>d</li></nav>"), blocks("<p>e</p>")]
    p = Pages(pages)
    y = np.array([1, 1, 0, 1], float)
    for k in model.w:
        model.w[k] = model.w[k].astype(np.float64)

    def loss():
        c = np.clip(np.array(chances(model, p)), 1e-9, 1 - 1e-9)
        return -(y * np.log(c) + (1 - y) * np.log(1 - c)).mean()

    def chances(m, q):
        x, mask, t, b = m._pad(m.inputs(q), q.sizes)
        h = np.concatenate([m._run("f", x.astype(float), mask), m._run("b", x.astype(float), mask)], 2)
        return (1 / (1 + np.exp(-(h @ m.w["out"] + m.w["bias"]))))[t, b]

    x, mask, t, b = model._pad(model.inputs(p), p.sizes)
    kept = []
    h = np.concatenate([model._run("f", x, mask, kept), model._run("b", x, mask)], 2)
    d = np.zeros(mask.shape)
    d[t, b] = (chances(model, p) - y) / len(y)
    g = {k: np.zeros_like(v) for k, v in model.w.items()}
    model._back("f", x, kept, (d[:, :, None] * model.w["out"])[:, :, :h.shape[2] // 2], g)
    for name in ("fx", "fh", "f0"):
        flat = model.w[name].reshape(-1)
        for i in rng.integers(len(flat), size=6):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - g[name].reshape(-1)[i]) < 2e-3


@pytest.mark.parametrize("page", [
    "<html><head><title>t</title><style>s</style><meta charset=x><body><p>one</p><p>two</p></body></html>",  # no </head>
    "<html><head><title>t</title><script>s</script><p>one</p><p>two</p>",  # no </head>, no body
    "<head><title>t</title></head><p>one</p><svg viewBox='0 0 1 1' /><p>two</p>",
    "<p>one</p><svg/><p>two</p><svg><text>s</text></svg>",
    "<p>one</p><object data='a>b' hidden/><iframe src=\"x\" /><math /><p>two</p>",
    "<p>one</p><iframe src=http://x/>s</iframe><p>two</p>",  # the slash belongs to the address
    "<p>one</p><svg><p>two</p>", "<p>one</p><object><p>two</p>", "<p>one</p><template><noscript><p>two</p>",  # never closed
    "<p>one</p><SVG><text>s</text></svg ><p>two</p><script>s <p>s</p>",
])
def test_what_is_left_open_hides_nothing_else(page):
    assert [b.text for b in blocks(page)] == ["one", "two"]


def test_an_open_head_is_on_no_way():
    closed, left_open = (blocks(f"<html><head><title>t</title>{end}<body><p>x</p>") for end in ("</head>", ""))
    assert closed == left_open


def test_many_tags_without_end_take_no_long():
    assert len(blocks("<svg><p>x</p>" * 20000)) == 20000
