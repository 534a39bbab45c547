import html
import random
import re

import duckdb
import pyarrow as pa

from starloom.llm import decontaminate, html_extract, queries

SF = "/root/testdata/sf0.01"


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(w):
    size = min(5, max(len(w), 1))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()


def test_leaks_are_those_that_hold_an_items_shingles(spark):
    con = duckdb.connect()
    docs = con.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = {i: shingles(tokens(t)) for i, t in con.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()}
    expected = {(d, i) for d, t in docs for own in [shingles(tokens(t))] for i, s in items.items() if len(s & own) >= 0.8 * len(s)}
    got = queries.QUERIES["op5_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(expected) > 10
    texts = dict(docs)
    for r in got:
        w = tokens(texts[r.doc_id])[r.first_word : r.first_word + r.n_words]
        assert len(shingles(w) & items[r.item_id]) >= 0.8 * len(items[r.item_id]) and r.similarity >= 0.8


def test_planted_passages_with_edits_and_clean_texts(spark):
    random.seed(9)
    vocabulary = [f"v{k}" for k in range(500)]
    items = [(k, " ".join(random.choices(vocabulary, k=random.randint(12, 60)))) for k in range(40)] + [(90, "too short"), (91, None), (92, "")]
    docs, planted = [], set()
    for d in range(120):
        w = random.choices(vocabulary, k=random.randint(0, 200))
        if d % 2:
            i, text = items[d % 40]
            part = text.upper().split()
            if d % 3 == 0:
                part[len(part) // 2] = part[len(part) // 2] + ","
            at = random.randint(0, len(w))
            w[at:at] = part
            planted.add((d, i))
        docs.append((d, " ".join(w)))
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted
    parts = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), items=15)
    assert {(r.doc_id, r.item_id, r.similarity) for r in parts.collect()} == {(r.doc_id, r.item_id, r.similarity) for r in found.collect()}


def test_cut_and_edited_items_are_found_as_by_brute_force():
    random.seed(11)
    vocabulary = [f"v{k}" for k in range(3_000)]
    for length in (5, 12, 24, 48, 60, 100, 200):
        items = [random.choices(vocabulary, k=length) for _ in range(40)]
        texts = []
        for k, item in enumerate(items):
            part = list(item)
            if k % 3 == 0:
                part = part[: round(0.86 * length)]
            elif k % 3 == 1:
                part = part[length - round(0.84 * length) :]
            else:
                for at in random.sample(range(length), max(1, length // 29)):
                    part[at] = "edited"
            around = random.choices(vocabulary, k=150)
            texts.append(around[:70] + part + around[70:])
        found = decontaminate.hits(pa.array([" ".join(t) for t in texts], pa.large_string()), decontaminate.build(list(range(40)), [" ".join(x) for x in items]), 0.8)
        weighted = [decontaminate.build([0], [" ".join(x)]) for x in items]
        assert all(len(x.rungs) == 1 and x.rungs[0].length == length for x in weighted)
        expected = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) for s in [shingles(x)] if len(s & shingles(t)) >= 0.8 * len(s)}
        assert {(r, i) for r, i, *_ in found} == expected and (len(expected) > 5 or length < 24)


def test_odd_documents_and_benchmarks(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(1, "ALPHA beta, gamma delta epsilon zeta eta theta"), (1, "alpha beta"), (2, None)], "item_id int, text string")
    rows = decontaminate.find_leaks(odd_docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1)} and len(rows) == 2
    left = decontaminate.without_leaks(odd_docs, benchmark)
    assert left.columns == odd_docs.columns and left.count() == 8 and left.where("doc_id = 1").first().text.startswith("another")
    assert decontaminate.find_leaks(no_docs, benchmark).count() == 0
    assert decontaminate.without_leaks(odd_docs, benchmark.where("false")).count() == 10


def test_articles_of_all_pages(spark):
    pages = {i: h for i, h in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()}
    got = queries.QUERIES["op8_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_page_with_everything_around_the_article():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><a href=/>Home</a></header>
    <div class="cookie-notice">We use cookies to improve your experience on this site. <button>OK</button></div>
    <div id=menu><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>
    <div class="content"><h2>Head &eacute; &amp;&#32;more</h2><p>First paragraph with <b>bold</b>
     text and a <a href='x>y'>link</a>, long enough to be content for sure.<script>var t="</p>";</script><p>1 < 2.
    <ul><li>Item one of the list in the text<li>Item two</ul><div class="ad">Buy now</div><blockquote>Quoted text here</blockquote><form>Sign up <input type=text> here</form></div>
    <aside>Related things that are long enough to look like an article paragraph with many words in it</aside>
    <div id="comments"><p>Nice article, I really liked reading this long text and will come back again soon!</p></div><footer>&copy; 2024</footer>"""
    assert html_extract.main_text(page) == (
        "Head é & more\nFirst paragraph with bold text and a link, long enough to be content for sure.\n1 < 2.\nItem one of the list in the text\nItem two\nQuoted text here"
    )


def test_elements_left_open_take_nothing_with_them():
    text = "A paragraph of the article that is long enough to be told as content by anyone."
    page = f"<article><p>{text}<p>{text}</article>"
    for before in ("<html><head><title>T</title><body>", "<html><head><meta charset=utf-8><style>p{}</style><title>T</title>", "<head><link rel=x><script>1</script>"):
        assert html_extract.main_text(before + page) == f"{text}\n{text}"
    for tag in ("select", "svg", "object", "math"):
        assert html_extract.main_text(f"<body><{tag}>" + page) == f"{text}\n{text}"
        assert html_extract.main_text(f"<article><p>{text}<{tag}></p><p>{text}</p></article>") == f"{text}\n{text}"
    shut = f"<article><p>{text} <svg><g><text>Label</text></g></svg></p><object data=x>Get the plugin</object><select><option>One<option>Two</select><p>{text}</p></article>"
    assert html_extract.main_text(shut) == f"{text}\n{text}"
    formula = f"<article><p>{text} So <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding=tex>x = 2</annotation></semantics></math> holds.</p></article>"
    assert html_extract.main_text(formula) == f"{text} So x=2 holds."


def test_names_are_scored_for_the_block_they_delimit():
    text = "A paragraph of the article that is long enough to be told as content by anyone."
    article = f'<article class="post has-comments"><header class="entry-header"><h1 class="entry-header">Title</h1></header><div class="entry-header"><h2>Second title</h2></div><p>{text}</p><p>{text}</p><div class="share">Share this</div></article>'
    whole = f"Title\nSecond title\n{text}\n{text}"
    comments = '<div id="comments"><article class="comment"><p>Nice article, I really liked reading it!</p></article></div><div class="related"><article><p>Another long story that is somewhere else</p></article></div>'
    for body in ('<body class="single has-sidebar">', '<body class="sidebar">', "<body id=main class='no-sidebar'>"):
        for wrapper in ('<div class="wrap">', '<div class="sidebar-left widget">', '<div class="entry comments-open">', '<div class="subscribe"><main>'):
            assert html_extract.main_text(f"{body}{wrapper}{article}</main></div>{comments}") == whole
    for wrapper in ("entry comments-open", "content ad-free", "wrap has-sidebar", "menu-open page"):
        assert html_extract.main_text(f'<body><div class="{wrapper}"><p>{text}</p><p>{text}</p></div><div class="main-menu"><p>{text}</p></div>') == f"{text}\n{text}"
    for away in ("ad", "post-ad", "cookie-notice", "entry comment", "site-header"):
        assert html_extract.main_text(f'<body><article><p>{text}</p><div class="{away}">Words that are none of the article</div></article>') == text


def test_cut_is_the_cheapest_labelling():
    random.seed(10)
    for _ in range(60):
        n = random.randint(1, 7)
        scores = [random.choice([-2.0, -0.5, 0.0, 0.4, 1.5]) for _ in range(n)]
        edges = [(a, b, random.choice([0.2, 0.7, 1.1])) for a in range(n) for b in range(a) if random.random() < 0.5]

        def cost(keep):
            own = sum(max(0, s) if not k else max(0, -s) for s, k in zip(scores, keep))
            return own + sum(w for a, b, w in edges if keep[a] != keep[b])

        found = html_extract.content_side(scores, edges, n)
        least = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(2**n))
        assert abs(cost(found) - least) < 1e-6


def test_odd_pages(spark):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "<p>" * 3_000 + "deep", "x"), (4, "u", "just text", "x"), (4, "u", "just text", "x"), (5, "u", "<nav>menu</nav><!-- open", "x"), (None, "u", '<a href="', "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(pages).collect()
    assert len(got) == 7 and [r.text for r in got if r.page_id in (1, 2, 5)] == ["", "", ""]
    assert {r.text for r in got if r.page_id == 4} == {"just text"} and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(pages.where("false")).count() == 0
    assert html_extract.main_text("<div><p>" + "word " * 200_000 + "</div>").count(" ") == 199_999
