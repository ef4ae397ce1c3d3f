import html
import re

import duckdb

from varloom.llm.pages import main_text
from varloom.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def texts(df):
    return {r.page_id: r.text for r in main_text(df).collect()}


def test_templates_of_a_host_go_and_articles_stay(spark):
    box = "<div><p>Follow &amp; like us</p><span>everywhere</span></div>"
    rows = [(i, f"http://A.example/{i}", f"<body>{box}<div><p>Story {i}</p><p>Same words</p></div>{box}") for i in range(8)]
    rows += [(20 + i, f"http://b.example/{i}", f"{box}<p>Own {i}</p>") for i in range(2)]
    rows += [(30 + i, f"http://c.example/{i}", f"{box}<article><h1>T</h1><p>Same words</p></article>") for i in range(8)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[i] == f"Story {i}" for i in range(8))
    assert got[20] == "Follow & like us\neverywhere\nOwn 0"
    assert all(got[30 + i] == "T\nSame words" for i in range(8))


def test_mirrored_pages_are_no_template(spark):
    page = "<body><div><h1>Head</h1><p>One</p></div><div><p>Two</p></div></body>"
    rows = [(i, "http://a.example/1", page) for i in range(5)] + [(10 + i, f"http://b.example/{i}", page) for i in range(9)]
    rows += [(30 + i, f"http://c.example/{i}", page.replace("<p>", f'<p data-at="{i}">')) for i in range(9)]
    rows += [(50 + i, f"http://c.example/own{i}", f"<div><p>Own {i}</p></div>") for i in range(4)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[i] == "Head\nOne\nTwo" for i in got if i < 50) and got[50] == "Own 0"


def test_template_is_a_share_of_a_host(spark):
    box, rare = "<div>Follow us</div>", "<p>Thank you.</p>"
    rows = [(i, f"http://a.example/{i}", f"{box}<div><p>Own {i}</p>{rare if i < 8 else ''}</div>") for i in range(400)]
    rows += [(1000 + i, f"http://b.example/{i}", f"{box}<div><p>Own {i}</p>{rare if i < 8 else ''}</div>") for i in range(40)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[i] == (f"Own {i}\nThank you." if i < 8 else f"Own {i}") for i in range(400))
    assert all(got[1000 + i] == f"Own {i}" for i in range(40))


def test_template_inside_articles_goes_and_quotations_stay(spark):
    box, quoted, some = '<div class="x7"><p>Sign up</p>now</div>', "<p>Quoted words</p>", "<div><p>On some</p></div>"
    rows = [
        (i, f"http://a.example/{i}", f"<{t}><h1>T</h1>{box}<p>Own {i}</p>{quoted}{some if i < 6 else ''}{box}</{t}>")
        for i in range(30) for t in [("article", "main")[i % 2]]
    ]
    rows += [(100 + i, f"http://b.example/{i}", f"<article>{box}<p>Own {i}</p></article>") for i in range(4)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[i] == f"T\nOwn {i}\nQuoted words" + ("\nOn some" if i < 6 else "") for i in range(30))
    assert got[100] == "Sign up\nnow\nOwn 0"


def test_what_is_never_main_text(spark):
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="ad">
    <header><h1>Site</h1></header><nav><a>Home</a></nav><!-- <p>x</p> --><div class="cookie-notice">ok?</div>
    <main><article><header><h1>Head&nbsp;line</h1></header><p title="a>b">One  two <b>three</b>
    <p>R&amp;D &lt;b&gt; &am 1 < 2<br>after<script>var t="</p>";</script><ul><li>x<li>y</ul>
    <aside>side</aside><form><p>mail</p></form><section id="comments"><p>nice</p></section>
    <article class="comment">me too</article><footer>by</footer></article></main>
    <div class="sidebar">s</div><footer>f</footer>"""
    got = texts(spark.createDataFrame([(1, "https://x/1", page)], SCHEMA))
    assert got[1] == "Head line\nOne two three\nR&D <b> &am 1 < 2\nafter\nx\ny"


def test_odd_rows_have_defined_results(spark):
    rows = [(1, None, None), (2, "", ""), (3, "x", "plain & simple"), (4, "http://h", "<article></article><p>out</p>")]
    rows += [(5, "http://h", "<p>" * 3000 + "deep"), (5, "http://h", "<p>" * 3000 + "deep"), (None, "http://h", "</p><article><p>a")]
    rows += [(6, "http://h", "<div>" + "word " * 200_000)]
    df = spark.createDataFrame([(*r, 3, 4) for r in rows], SCHEMA + ", text int, key int")
    out = main_text(df)
    assert out.columns == ["page_id", "url", "key", "text", "n_chars"]
    got = {r.page_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {
        1: ("", 0), 2: ("", 0), 3: ("plain & simple", 14), 4: ("", 0), 5: ("deep", 4), None: ("a", 1),
        6: (("word " * 200_000).strip(), 999_999),
    }
    assert not main_text(df.limit(0)).count()


def test_query_gives_the_articles(spark):
    d = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in QUERIES["op5_main_text"](spark, d).collect()}
    for page_id, source in duckdb.sql(f"SELECT page_id, html FROM '{d}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert got[page_id] == "\n".join(b for b in blocks if b)


def test_names_of_wrappers_do_not_empty_a_page(spark):
    story = "<p>A story of some length that is the text of this page.</p>"
    pages = [
        f'<div id="page" class="hfeed right-sidebar"><div class="menu">Home</div><article><h1>T</h1>{story}</article></div>',
        f'<article class="post sharing-enabled"><h1>T</h1>{story}</article>',
        f'<article><h1>T</h1><div class="body has-comments">{story}</div><div class="comments"><p>{"Nice! " * 50}</p></div></article>',
        f'<div class="hfeed right-sidebar"><h1>T</h1>{story}<div class="widget">Latest</div></div>',
        f'<div class="social"><main><h1>T</h1>{story}<div class="cookie-notice">ok?</div></main></div>',
    ]
    rows = [(i, f"http://h{i}.example/", p) for i, p in enumerate(pages)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(got[i] == "T\nA story of some length that is the text of this page." for i in range(len(pages)))


def test_stray_end_tags_cost_no_walk():
    import time

    from varloom.llm.pages import _Page

    begin = time.process_time()
    _Page("<span>" * 40_000 + "</b></i><div></div>" * 20_000, frozenset()).text()
    assert time.process_time() - begin < 20


def test_subtree_counts_match_counting_page_by_page(spark):
    """The hashes that each host's pages hold, counted by Spark's side of the operator and in Python."""
    from collections import Counter, defaultdict

    from varloom.llm.pages import TEMPLATE_PAGES, TEMPLATE_PERCENT, _Page, host_of

    box = "<div><p>Follow us</p></div>"
    rows = [(i, f"http://h{i % 3}.example/{i}", f"{box if i % 4 else ''}<div><p>Own {i // 2}</p><p>Also</p></div>") for i in range(60)]
    seen, pages = defaultdict(set), {}
    for i, url, source in rows:
        page = _Page(source, frozenset())
        pages[i] = (host_of(url), page)
        seen[host_of(url)].add((page.text(), frozenset(page.hashes)))
    template = {}
    for host, different in seen.items():
        count = Counter(h for _, hashes in different for h in hashes)
        total = len({text for text, _ in different})
        template[host] = {h for h, n in count.items() if n >= TEMPLATE_PAGES and n * 100 >= total * TEMPLATE_PERCENT}
    got = texts(spark.createDataFrame(rows, SCHEMA))
    for i, url, source in rows:
        assert got[i] == _Page(source, frozenset(template[host_of(url)])).text()
    assert all(got[i] == f"Own {i // 2}" for i in got)
