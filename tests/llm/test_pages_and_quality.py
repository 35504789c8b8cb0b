"""HTML extraction and the quality model."""

from __future__ import annotations

import itertools
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from roomtrace.llm import html_cut as H, quality_gam as G

SF = "/root/testdata/sf0.001"
START = np.array(list(H.START.values()))


def article(page):
    """The blocks of the one article of a page as these tables have it."""
    import html

    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = re.split(r"</?p>|<br>|</?h1>", inside)
    clean = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x))).strip() for x in parts]
    return " ".join(x for x in clean if x)


def test_pages_query(answer):
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in answer("op5_html_cut")}
    assert len(got) == len(pages)
    for i, url, page in pages:
        assert (got[i]["url"], got[i]["text"]) == (url, article(page))
        assert got[i]["n_chars"] == len(got[i]["text"])


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="post">
<header><a href=x>Site</a> name of the site</header><div class="cookie-notice">We use cookies. Accept them now please.</div>
%s<h1>The title</h1><p>First para with an &amp; and <a href=y>a link</a>, more&nbsp;text
 here.</p><p>Second <i>para</i>.</p><ul><li>one item<li>two item</ul><div class="ad">Buy now! The best thing.</div><p>Short.</p>%s
<aside>Related stories. Read them all.</aside><form>Name <input> Submit</form><script>"</p>"</script>
<section class="comments"><h2>Comments</h2><article class="comment"><p>Nice article, I like it very much. Thanks!</p></article></section>
<footer>(c) me</footer></body></html>"""
WANT = "The title First para with an & and a link, more text here. Second para. one item two item Short."


@pytest.mark.parametrize("around", [("<article>", "</article>"), ('<div id="main-content">', "</div>"), ("<div class='x'>", "</div>"), ('<div class="with-sidebar"><main>', "</main></div>")])
def test_boilerplate_goes(around):
    assert H.main_text(PAGE % around, START) == WANT


def test_odd_pages(spark):
    deep = "<div>" * 20_000 + "deep text of some words." + "</div>" * 20_000
    long = "<article>" + "<p>words of one paragraph, and more.</p><div class=ad>buy</div>" * 3000 + "</article>"
    pages = [(1, None), (2, ""), (3, "plain text"), (4, "<p>open <b>tags"), (5, deep), (6, long), (7, "<!-- x"), (8, "<a href='x"), (3, "plain text"), (None, "<p>null id</p>")]
    df = spark.createDataFrame([(i, f"u{i}", h, 1) for i, h in pages], "page_id bigint, url string, html string, text int")
    got = sorted((str(r.page_id), r.text) for r in H.extract(df).collect())
    words = "words of one paragraph, and more."
    want = [(1, ""), (2, ""), (3, "plain text"), (3, "plain text"), (4, "open tags"), (5, "deep text of some words."), (6, " ".join([words] * 3000)), (7, ""), (8, ""), (None, "null id")]
    assert got == sorted((str(i), t) for i, t in want)
    assert H.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("start", [
    "<html><head><title>x</title><body>", "<html><head><title>x</title>", "<head><title>x</title></head>", "<title>x</title>",
    "<html><head><title>x</title></head>", "<!-- c --><head>\n<meta charset=utf-8><link rel=x><style>p{}</style><script>a</script>\n<body>",
    "<head><noscript><style>p{}</style></noscript><title>x</title><body class=x>", "<head><noscript><link rel=x><body>", "<head><bgsound src=x><title>x</title>",
])
@pytest.mark.parametrize("inner", ["<article><h1>Top</h1><p>Some words, here.</p></article>", "<img src=x><main>Top<p>Some words, here.</main>"])
def test_head_without_end(start, inner):
    assert H.main_text(start + inner, START) == "Top Some words, here."
    assert H.main_text(start + inner + "</body></html>", START) == "Top Some words, here."


def test_text_ends_head():
    assert H.main_text("<html><head><title>x</title>\n Some words, and more.", START) == "Some words, and more."


@pytest.mark.parametrize("tag", [
    '<a href="x"">', "<p title=don't>", "<p title=5\">", "<p ' class=x>", '<p "a">', "<p title = don't class='x'>", '<p title="a"\'>', "<a href=/x?q=\"a>",
    "<p =\" x>", "<p title=>", "<p/title='a>b'/>", '<p title\n=\n"a>b" id=\'c>"d\'>', "<p title=a/b'c/>", "<p title='it is \"'>",
])
def test_quotes_in_tags(tag):
    rest = """Some words, here.</p><p>It's the "end", of it.</p><div class="ad">Buy now! It's good.</div><p>Last 'words', too.</p>"""
    for end in ("</article>", ""):
        got = H.main_text(f"<article><p>First words, here.</p>{tag}{rest}{end}", START)
        assert got == """First words, here. Some words, here. It's the "end", of it. Last 'words', too."""


def test_values_of_odd_tags():
    assert H.main_text("<article><p>Some words, here.</p><div title=don't class=ad>Buy now! It's good.</div></article>", START) == "Some words, here."
    assert H.main_text("<p>" + "<a " * 50_000 + "b " * 50_000 + "=" * 50_000 + " " * 50_000, START) == ""


@pytest.mark.parametrize("opened", ["<div>", "<b>", "<div><b>"])
def test_deep_pages_are_read_like_others(opened):
    deep = opened * 60_000
    inner = (PAGE % ("<article>", "</article>")).partition("<body")[2].partition(">")[2]
    assert H.main_text(deep + inner, START) == WANT
    # End tags of deep elements close nothing further out.
    page = "<div class=ad>" + deep + "<div>in</div>" * 3 + "<span></div></x>Buy. It is good.</span></div><article><p>Some words, here.</p></article>"
    assert H.main_text(page, START) == "Some words, here."


def test_many_stray_tags_in_deep_pages():
    deep = "<b>" * 60_000 + "</x><br><li>a<tr><p>" * 60_000
    assert len(H.blocks_of(deep)) == 60_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("<div> </div> <p> </p> <b> </b> <ul> <li> </ul> <table> <tr> <td> </table> <br> <form> </form> <article> </article> a b".split() + [" "]), max_size=40))
def test_distance_is_that_of_a_walk(parts):
    def above(node):
        return [node, *above(node.parent)] if node else []

    blocks = H.blocks_of("".join(parts))
    for a, b in zip(blocks, blocks[1:]):
        up, other = above(a.node), above(b.node)
        common = next(i for i, n in enumerate(up) if any(n is m for m in other))
        assert H.tree_distance(a, b) == common + next(i for i, n in enumerate(other) if n is up[common])


@pytest.mark.parametrize("around", [
    ("<article>", "</article>"), ('<div id="main-content">', "</div>"), ("<div class='x'>", "</div>"), ("<main>", "</main>"), ("<form><article>", "</article></form>"),
])
def test_forms_around_pages(around):
    page = (PAGE % around).replace('<body class="post">', '<body class="post"><form id="aspnetForm"><input type=hidden><label>Find</label>')
    page = page.replace("<form>Name <input> Submit</form>", "<select><option>One.</select><button>Go. Now.</button>").replace("</body>", "</form></body>")
    assert H.main_text(page, START) == WANT


def test_forms_in_pages():
    form = "<form><h4>Letter</h4><p>Subscribe to our letter. It's free.</p><fieldset><label>Name: <input></label></fieldset></form>"
    for inner in ("<p>Some words, here, and more of them.</p>%s<p>Last words, too.</p>", "Some words, here, and more of them.%s<div>Last words, too.</div>"):
        for around in ("<article>%s</article>", "<div>%s</div>", "<form><main>%s</main></form>", "<form><div>%s</div></form>"):
            got = H.main_text(around % (inner % form), START)
            assert got == "Some words, here, and more of them. Last words, too."
    assert H.main_text("<form>Name <input> <p><label>Subscribe. Now.</label></p></form>", START) == ""


@pytest.mark.parametrize("tag", ["math", "noscript", "object", "label", "fieldset", "map"])
def test_other_elements_of_articles(tag):
    assert H.main_text(f"<article><p>Some words, <{tag}>held</{tag}> here.</p></article>", START).split() == "Some words, held here.".split()
    assert H.main_text("<noscript>Please turn on scripts. Now.</noscript><article><p>Some words.</p></article>", START) == "Some words."


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_least_cut(data):
    n = data.draw(st.integers(1, 7))
    amount = st.integers(-6, 6)
    odds = np.array(data.draw(st.lists(amount, min_size=n, max_size=n)), float)
    edges = [(a, b, float(c)) for a, b in itertools.combinations(range(n), 2) if (c := data.draw(st.integers(0, 4)))]

    def cost(side):
        return sum(max(0, -o) if s else max(0, o) for o, s in zip(odds, side)) + sum(c for a, b, c in edges if side[a] != side[b])

    assert cost(H.minimum_cut(odds, edges)) == min(map(cost, itertools.product([False, True], repeat=n)))


# --- quality -------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    from roomtrace.llm.catalog import QUERIES

    got = {r.doc_id: r for r in QUERIES["op4_quality_gam"](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(got[i].predicted, q) for i, q in labels if i in got and got[i].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) >= 0.97


def test_tables_learn_steps_and_pairs():
    rnd = np.random.default_rng(3)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = G.fit(x, y)
    assert {(0, 1)} <= {(a, b) for a, b, _ in model.pairs}
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    z = (x[:, 2] > 0.3).astype(float)
    assert ((G.fit(x, z).score(x) >= 0.5) == z).mean() > 0.97


def test_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one = spark.createDataFrame([(4, 1), (4, 1), (3, 0), (3, 1), (None, 0)], "doc_id bigint, quality int")
    for labels in (none, one):
        got = G.with_score(odd, G.train(odd, labels), "p").collect()
        assert len(got) == odd.count() and all(r.p >= 0.5 for r in got)
        assert G.keep(odd, labels).columns == odd.columns
    assert G.keep(empty, one).count() == 0


def test_learned_rows_only(spark):
    # Held-out ids carry the opposite labels; they must not be learned.
    texts = [("fine words of a sentence, it goes on. " * 3, 1), ("### $$$ %%% &&&" * 5, 0)]
    rows = [(i, *texts[i % 2]) for i in range(300)]
    out = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - q if i in out else q) for i, _, q in rows], "doc_id bigint, quality int")
    got = {r.doc_id: r.p for r in G.with_score(docs, G.train(docs, labels), "p").collect()}
    assert all((got[i] >= 0.5) == (q == 1) for i, _, q in rows)


def test_repeated_id_counts_once(spark, monkeypatch):
    fine, junk = "fine words of a sentence, it goes on. " * 3, "### $$$ %%% &&&" * 5
    rows = [(i, (fine, junk)[i % 2], i % 2) for i in range(60)]
    often = next(i for i, _, q in rows if q == 0 and zlib.crc32(str(i).encode()) % 3 != 1)
    labels = spark.createDataFrame([(i, 1 - q) for i, _, q in rows], "doc_id bigint, quality int")
    once = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    # A third of all rows has one id: copies, other texts and nulls.
    more = once.unionByName(spark.createDataFrame([(often, t) for t in [fine, junk, None] * 10], "doc_id bigint, text string"))
    seen = []
    monkeypatch.setattr(G, "fit", lambda x, y, weight=None: seen.append((x.tolist(), y.tolist(), weight.tolist())))
    for docs in (once, more, more.repartition(5)):
        G.train(docs, labels)
    ids = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, *_ in rows)
    assert [len(y) for _, y, _ in seen] == [ids] * 3 and seen[1] == seen[2]
    assert seen[0][1:] == seen[1][1:]
    G.train(more, labels, rows=10)
    assert len(seen[3][1]) == 10



def loop_scores(x, y, rounds, bins, coarse_bins, most_pairs):
    """Boosted tables by plain loops over rows, bins and every possible cut: scores of the rows."""
    import math

    rows, width = range(len(y)), len(x[0])

    def edges(values, n):
        ordered = sorted(values)
        marks = sorted({ordered[round(q * (len(ordered) - 1) / n)] for q in range(n + 1)})
        return [(a + b) / 2 for a, b in zip(marks, marks[1:])]

    def bin_of(value, cuts):
        return sum(value >= c for c in cuts)

    def gain(g, h):
        return g * g / (h + G.SHRINK)

    def best_cut(cells):
        """cells: (g, h) per bin.  The gain of the best cut and where it is; 0 for none."""
        whole, found = gain(sum(g for g, _ in cells), sum(h for _, h in cells)), (1e-9, 0)
        for cut in range(1, len(cells)):
            parts = cells[:cut], cells[cut:]
            more = sum(gain(sum(g for g, _ in p), sum(h for _, h in p)) for p in parts) - whole
            if more > found[0] + 1e-12:
                found = (more, cut)
        return found

    def leaf(cells):
        return sum(g for g, _ in cells) / (sum(h for _, h in cells) + G.SHRINK)

    def ranges(n, cut):
        return [r for r in ((0, cut), (cut, n)) if r[1] > r[0]]

    def shallow(cells):
        out = [0.0] * len(cells)
        for a, b in ranges(len(cells), best_cut(cells)[1]):
            for c, d in ranges(b - a, best_cut(cells[a:b])[1]):
                out[a + c : a + d] = [leaf(cells[a + c : a + d])] * (d - c)
        return out

    def pairwise(cells):
        """cells[i][j]: (g, h).  The best gain and a value per cell."""
        flat = [c for row in cells for c in row]
        best = (0.0, [[0.0] * len(cells[0]) for _ in cells])
        for cut in range(1, len(cells)):
            out, more = [[0.0] * len(cells[0]) for _ in cells], -gain(sum(g for g, _ in flat), sum(h for _, h in flat))
            for a, b in ranges(len(cells), cut):
                columns = [(sum(cells[i][j][0] for i in range(a, b)), sum(cells[i][j][1] for i in range(a, b))) for j in range(len(cells[0]))]
                for c, d in ranges(len(columns), best_cut(columns)[1]):
                    more += gain(sum(g for g, _ in columns[c:d]), sum(h for _, h in columns[c:d]))
                    for i in range(a, b):
                        out[i][c:d] = [leaf(columns[c:d])] * (d - c)
            if more > best[0]:
                best = more, out
        return best

    share = sum(y) / len(y)
    total = [math.log(share / (1 - share))] * len(y)
    fine = [[bin_of(x[r][j], edges([row[j] for row in x], bins)) for r in rows] for j in range(width)]
    far = [[bin_of(x[r][j], edges([row[j] for row in x], coarse_bins)) for r in rows] for j in range(width)]
    sizes = [len(edges([row[j] for row in x], coarse_bins)) + 1 for j in range(width)]

    def slope(r):
        p = 1 / (1 + math.exp(-total[r]))
        return y[r] - p, p * (1 - p)

    def summed(places, n):
        slopes = [slope(r) for r in rows]
        return [(sum(s[0] for s, at in zip(slopes, places) if at == b), sum(s[1] for s, at in zip(slopes, places) if at == b)) for b in range(n)]

    def grid(a, b):
        places = [(far[a][r], far[b][r]) for r in rows]
        slopes = [slope(r) for r in rows]
        return [
            [tuple(sum(s[k] for s, at in zip(slopes, places) if at == (i, j)) for k in (0, 1)) for j in range(sizes[b])] for i in range(sizes[a])
        ]

    for _ in range(rounds):
        for j in range(width):
            table = shallow(summed(fine[j], max(fine[j]) + 1))
            for r in rows:
                total[r] += G.STEP * table[fine[j][r]]
    gains = sorted(((pairwise(grid(a, b))[0], a, b) for a in range(width) for b in range(a + 1, width)), reverse=True)
    chosen = [(a, b) for found, a, b in gains[:most_pairs] if found > 0]
    for _ in range(rounds // 5):
        for a, b in chosen:
            table = pairwise(grid(a, b))[1]
            for r in rows:
                total[r] += G.STEP * table[far[a][r]][far[b][r]]
    return [1 / (1 + math.exp(-t)) for t in total]


# Two pairs of which no cut of the second feature gains anything are equal, so pairs are compared one at a time.
@pytest.mark.parametrize("width, pairs", [(3, 0), (2, 1)])
@pytest.mark.parametrize("seed", range(4))
def test_model_against_plain_loops(monkeypatch, seed, width, pairs):
    import random

    for name, value in {"ROUNDS": 15, "BINS": 5, "PAIR_BINS": 3, "PAIRS": pairs}.items():
        monkeypatch.setattr(G, name, value)
    rnd = random.Random(seed)
    # The number of rows lets quantiles fall on rows.
    x = [[rnd.random(), rnd.random() ** 2, rnd.choice([0.0, 1.0, 2.0])][:width] for _ in range(61)]
    y = [float((r[0] > 0.5) != (r[1] > 0.3) or rnd.random() > 0.8) for r in x]
    model = G.fit(np.array(x), np.array(y))
    assert model.score(np.array(x)) == pytest.approx(loop_scores(x, y, 15, 5, 3, pairs), abs=1e-9)
    assert len(model.pairs) == pairs


LEAD = "This is the first paragraph of the story, long enough to be read as running text."
REST = "And this is the second one, which goes on about the same matter for a while."
OUTER = '<div class="site-header">Home News Sport</div><ul class="main-nav"><li><a href="/">Home</a></li></ul>'
END = '<div class="related-posts"><a href="/1">Another story</a></div><div class="site-footer">All rights reserved, imprint</div>'
WORDY = [
    f'<main class="page header-fixed"><h1>Title</h1><p>{LEAD}</p><p>{REST}</p></main>',
    f'<div class="content with-sidebar"><article><h1>Title</h1><p>{LEAD}</p><p>{REST}</p></article></div>',
    f'<div class="story no-comments"><article><h1>Title</h1><p>{LEAD}</p><p>{REST}</p></article></div>',
    f'<article><div class="body ad-free"><h1>Title</h1><p>{LEAD}</p><p>{REST}</p></div></article>',
    f'<article><header class="entry-header"><h1>Title</h1></header><p>{LEAD}</p><p>{REST}</p></article>',
    f'<article><div class="article-header"><h1>Title</h1><p>{LEAD}</p></div><p>{REST}</p></article>',
    f'<article><div class="hero-banner"><h1>Title</h1></div><p>{LEAD}</p><p>{REST}</p></article>',
    f'<article><h1>Title</h1><p>{LEAD}</p><p class="legal">{REST}</p></article>',
    f'<article><h1>Title</h1><p>{LEAD}</p><section class="related-work"><p>{REST}</p></section></article>',
]


@pytest.mark.parametrize("page", WORDY)
def test_words_in_class_names_do_not_cost_main_text(spark, page):
    weights = H.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    whole = f"<html><body>{OUTER}{page}{END}</body></html>"
    assert H.main_text(whole, weights) == f"Title {LEAD} {REST}"
