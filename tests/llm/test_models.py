"""HTML extraction, language identification, exact search, the pipeline and its registration."""

import html
import itertools
import math
import random
import re
import time

import corpus_pipeline
from dockyard.llm import queries
from dockyard.llm.html_text import extract, main_text, min_cut
from dockyard.llm.langid import drop_rejected, fit, held_out, identify
from dockyard.llm.topk import top_k
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.tables import SCHEMA, odd_documents
from tests.oracle_check import _key, duck, rows_of_duck, rows_of_spark


def test_sql_oracles(spark):
    con = duck(SF_SMALL)
    for name, sql in queries.ORACLE_SQL.items():
        cols, rows = rows_of_spark(queries.QUERIES[name](spark, SF_SMALL))
        assert (cols, sorted(rows, key=_key)) == (lambda c, r: (c, sorted(r, key=_key)))(*rows_of_duck(con, sql))


def test_min_cut_is_a_minimum():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(1, 8)
        terminal = [rng.uniform(-3, 3) for _ in range(n)]
        edges = {(i, j): rng.uniform(0, 2) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(side):
            return (sum(max(0, t) for t, s in zip(terminal, side) if not s) + sum(max(0, -t) for t, s in zip(terminal, side) if s)
                    + sum(c for (i, j), c in edges.items() if side[i] != side[j]))

        best = min(cost(s) for s in itertools.product([False, True], repeat=n))
        assert abs(cost(min_cut(terminal, edges)) - best) < 1e-6


def test_min_cut_of_many_undecided_nodes():
    rng = random.Random(4)
    n = 64000
    terminal = [rng.choice((-0.4, -0.1, 0.0, 0.1, 0.3)) for _ in range(n)]
    edges = {(i - 1, i): 0.5 for i in range(1, n)}
    start = time.monotonic()
    side = min_cut(terminal, edges)
    assert time.monotonic() - start < 10
    # the least cost of a chain, node by node
    content, boiler = 0, 0
    for i, t in enumerate(terminal):
        t = round(1e6 * t)
        link = 500000 if i else 0
        content, boiler = (min(content, boiler + link) + max(0, -t), min(boiler, content + link) + max(0, t))
    cost = sum(max(0, -round(1e6 * t)) if s else max(0, round(1e6 * t)) for t, s in zip(terminal, side))
    assert cost + 500000 * sum(side[i - 1] != side[i] for i in range(1, n)) == min(content, boiler)


def test_page_of_many_links():
    rows = "".join(f"<li><a href='/{i}'>entry {i}</a> of the list {'and more words ' * (i % 3)}</li>" for i in range(64000))
    page = f"<html><body><ul>{rows}</ul><article><p>{'The article itself is here. ' * 20}</p></article></body></html>"
    start = time.monotonic()
    text = main_text(page)
    assert time.monotonic() - start < 20 and text.endswith("The article itself is here.")



def test_op2_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in queries.op2_html_extract(spark, SF_SMALL).collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        article = re.search(r"<article>(.*?)</article>", page or "", re.S)[1]
        want = "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split())
                                     for p in re.split(r"</?(?:p|h1)>", article)) if x)
        assert got[i] == (want, len(want))


PAGE = """<html><body class="has-sidebar nav-open"><header class="site-header"><h1>Site</h1><a href=/>home</a></header>
<div class="cookie-notice">We use cookies to improve the site and you agree when you read on and on.</div>
<div id="wrap"><div class="sidebar"><p>Some side text that is quite long and goes on for a while with words.</p></div>
<div class="post-content"><h2>Title &amp; more</h2><p>First para<br>graph  here.</p><p>Short.</p><div class="ad">Buy now</div>
<ul><li>point one</li><li>point two with a <a href=x>link</a></li></ul><p>Last one.</p></div>
<section id="comments"><h3>Comments</h3><p>I think that this very long reader comment says many things about the article.</p></section></div>
<form><label>Email</label></form><footer><p>Copyright</p></footer><script>if (a<b) {}</script></body></html>"""


def test_page_without_article_tag():
    assert main_text(PAGE).split("\n") == ["Title & more", "First para graph here.", "Short.", "point one", "point two with a link", "Last one."]


LONG = "This paragraph of the article has more than enough words to be told from the links and buttons around it by anyone who reads on."
WRAPPED = """<html><body><header><h1>Site</h1></header><nav><a href=/>home</a></nav>
<div {}><{}><h2>Title</h2><p>%s</p><p>Short one.</p></{}>
<div class="related"><h4>Related</h4><p>%s</p></div></div>
<div class="sidebar"><p>Some side text that is quite long and goes on for a while with words.</p></div>
<div id="comments"><div class="comment"><div class="text"><p>%s</p></div></div></div><footer><p>Legal</p></footer></body></html>""" % (LONG, LONG, LONG)


def test_layout_words_on_the_wrapper():
    for names in ('class="content has-sidebar"', 'id="page" class="no-sidebar"', 'class="wrap with-nav"', 'class="hasSidebar"',
                  'class="sidebar-left"', 'class="layout menu-open"', 'id="share-root"', 'class="search-enabled related"'):
        for tag in ("article", "main", 'div role="main"'):
            assert main_text(WRAPPED.format(names, tag, tag.split()[0])).split("\n") == ["Title", LONG, "Short one."], (names, tag)
    for names in ('class="content has-sidebar"', 'id="page" class="no-sidebar"'):
        assert LONG in main_text(WRAPPED.format(names, "div", "div"))
    # without an article in it, only long blocks outweigh the name of the wrapper
    assert main_text(f"<body><div class='content sidebar-right'><p>{LONG} {LONG}</p></div></body>") == f"{LONG} {LONG}"


def test_named_parts_inside_an_article_stay_out():
    for name in ("comments", "share", "related posts", "newsletter-signup", "sidebar", "ad", "comment-list has-avatars"):
        page = f"<body><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><div class='{name}'><p>{LONG}</p><p>{LONG}</p></div></article></body>"
        assert main_text(page).split("\n") == ["Title", LONG, LONG], name
    comments = f"<ol class='comment-list'><li><article class='comment-body'><p>{LONG}</p></article></li></ol>"
    assert main_text(f"<body><article><p>{LONG}</p></article>{comments}</body>") == LONG


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (1, None, "", "x"), (None, "u", "<p>a < b &amp; c", "x"), (3, "u", "<div><a href=\"x", "x")],
                               "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in extract(df).collect()) == [(0, "a < b & c"), (1, ""), (1, ""), (3, "")]
    assert extract(df.limit(0)).count() == 0


def test_op9_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = [r for r in queries.op9_language_id(spark, SF_SMALL).collect()]
    assert {r.doc_id for r in rows} == set(lang)
    out = [r for r in rows if r.held_out]
    assert out and sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = fit(docs.filter(~held_out()))
    df = odd_documents(spark)
    rows = identify(df, model).collect()
    assert len(rows) == df.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.score == 0 and r.rejected))
    none = fit(spark.createDataFrame([], SCHEMA))
    assert {r.lang_pred for r in identify(df, none).collect()} == {"und"}
    assert drop_rejected(df).columns == df.columns
    assert drop_rejected(spark.createDataFrame([], SCHEMA)).count() == 0


def test_top_k_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.003]) for _ in range(rng.choice([3, 4]))]) for i in range(120)]
    rows += [(200, None), (201, [None, 1.0]), (202, [float("nan")]), (203, [float("inf"), 1.0]), (None, [1.0]), (204, []), (3, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, qv in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q)[:5]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    got = {tuple(r) for r in top_k(df, df.filter("vec_id % 50 = 0"), shard_rows=16, block_queries=2).collect()}
    # 0.003 is not exact in 32 bits, but its floor is
    assert got == want
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_repeated_query_ids(spark):
    kind = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 0.25])], kind)
    bad = [None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    for first in bad:
        rows = [(9, first), (9, [1.0, 0.0]), (9, [0.0, 1.0]), *((9, v) for v in bad)]
        for some in (rows, rows[::-1]):
            asked = spark.createDataFrame(some, kind).coalesce(1)
            assert sorted((r["rank"], r.vec_id, r.score) for r in top_k(df, asked, k=2).collect()) == [(1, 2, 65536), (2, 3, 16384)]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(spark, docs, SF_SMALL)
        after = [(r.doc_id, r.text) for r in docs.collect()]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        kept[name] = before, after
    before, after = kept["language_id"]
    assert {i for i, t in before if any(c.isalpha() for c in t or "")} == {i for i, _ in after}
    before, after = kept["exact_dedup"]
    last = {brute.lower(t or ""): i for i, t in sorted(before)}
    assert {i for i, _ in after} == set(last.values())
    before, after = kept["near_dedup"]
    assert {i for i, _ in after} == {i for i, (_, c) in brute.near_components(before, 5, 80).items() if i == c}
    before, after = kept["suffix_dedup"]
    assert dict(after) == {i: k.decode("utf-8", "ignore") for i, (_, _, _, k) in brute.repeated_bytes(before).items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in after}


def test_pipeline_of_odd_documents(spark):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() > 0


def test_registered(spark):
    import __spark_entry__ as e
    assert set(queries.QUERIES) | {"pipeline"} <= set(e.queries())


def test_other_languages_are_rejected_beside_letterless_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(~held_out()).select("doc_id", "text", "lang")
    langs = [r.lang for r in docs.select("lang").distinct().collect()]
    junk = [(-i, t, lang) for i, (t, lang) in enumerate(itertools.product(["", "2024 1234 !!", " – €", None], langs), 1)]
    plain, model = fit(docs), fit(docs.unionByName(spark.createDataFrame(junk, docs.schema)))
    assert sorted(set(model.langs)) == sorted(langs) and (model.floors > 0.1).all()
    assert (model.floors == plain.floors).all()
    strange = ["Это совсем другой язык, которого модель никогда не видела", "これは学習していない言語の文章です",
               "Tämä on aivan toinen kieli jota malli ei ole koskaan nähnyt", "U2FsdGVkX1+vupppZksvRf5pq5g5XjFRIipRkwB0K1Y="]
    assert model.predict(strange)[2].all()
