"""Main text extraction on small pages."""

import math
import random
import re
import time
from html import unescape

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from ledgerline.llm import html_text
from ledgerline.llm.html_text import main_text

P1 = "The first paragraph of the article has quite a few words in it, and more."
P2 = "The second paragraph goes on for a while, as articles of this kind do."

CASES = {
    "plain": (f"<body><article><h1>T</h1><p>{P1}</p><p>{P2}</p></article></body>", ["T", P1, P2]),
    "boilerplate": (
        f"""<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
        <ul class="menu"><li><a href=a>A</a><li><a href=b>B</a></ul><div class="content"><p>{P1}</p><p>Short.</p><p>{P2}</p>
        <form><p>Sign up for all of our many letters</p></form><div class="ad">Buy this thing now, it is good</div></div>
        <div class="sidebar"><p>Other things that are on this site</p></div>
        <section id="comments"><article class="comment"><p>{P2} I do not agree with any of this at all.</p></article></section>
        <footer>(c)</footer></body></html>""",
        [P1, "Short.", P2],
    ),
    "unclosed": (f"<article><h2>T</h2><p><b>{P1}<br><p>{P2}<footer>(c) x</footer>", ["T", P1, P2]),
    "references": ("<p>a &amp; b&nbsp;&lt;c&gt; &#233; &amp</p>" + f"<p>{P1}</p>", ["a & b <c> é &", P1]),
    "white space": (f"<article><p>  a\n\tb  <i> c</i>d </p>{P1}</article>", ["a b cd", P1]),
    "script": (f'<script>var x = "</p><p>no"; if (a < b) {{}}</script><style>p {{}}</style><p>{P1}</p>', [P1]),
    "ad that holds the article": (f'<div class="ad"><article><p>{P1}</p></article></div>', [P1]),
    "no text": ("<html><body><nav>a</nav></body></html>", []),
    "no markup": (P1, [P1]),
    "empty": ("", []),
    "null": (None, []),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    html, expected = CASES[name]
    assert main_text(html) == "\n\n".join(expected)


def test_sibling_articles_are_all_kept():
    parts = [f"<article><h2>Part {i}</h2><p>{P1}</p><p>{P2}</p></article>" for i in "abc"]
    expected = "\n\n".join(f"Part {i}\n\n{P1}\n\n{P2}" for i in "abc")
    for wrap in ("{}", "<div>{}</div>", "<main>{}</main>", "<div><p><a href=x>More</a></p>{}</div>"):
        assert main_text("<body>" + wrap.format("".join(parts)) + "</body>") == expected
    longer = parts[0].replace(P2, P2 + " It says more.")
    text = main_text(f"<body><div>{longer}{parts[1]}</div></body>")
    assert text == f"Part a\n\n{P1}\n\n{P2} It says more.\n\nPart b\n\n{P1}\n\n{P2}"


def test_density_chooses_before_the_article_tag():
    links = "".join(f"<li><a href=x{i}>A link with some words</a></li>" for i in range(9))
    page = f"<body><article><ul>{links}</ul></article><div><p>{P1}</p><p>{P2}</p></div></body>"
    assert main_text(page) == f"{P1}\n\n{P2}"


@pytest.mark.parametrize(
    "wrap",
    [
        '<div class="content has-sidebar">{}</div>',
        '<div id="page-header-wrap">{}</div>',
        '<div class="social-page"><div class="with-comments post">{}</div></div>',
        '<div class="el-widget">{}</div><div class="el-widget"><p>' + P1 + "</p></div>",
    ],
)
def test_a_wrapper_is_not_pruned_by_its_name(wrap):
    side = '<div class="sidebar"><p>Other things on this site</p></div><div class="comments"><p>No, I say.</p></div>'
    page = f'<body><div class="menu"><a href=a>A</a></div>{wrap.format(f"<p>{P1}</p><p>{P2}</p>" + side)}</body>'
    assert main_text(page) == "\n\n".join([P1, P2] + [P1] * ("el-widget" in wrap))


def test_long_comments_do_not_replace_the_text():
    comments = '<div id="comments">' + f"<p>{P2} I do not agree.</p>" * 5 + "</div>"
    assert main_text(f'<body><div class="page has-sidebar"><p>{P1}</p></div>{comments}</body>') == P1


def test_long_and_deep_pages():
    assert len(main_text("<div>" * 3000 + "<p>" + "word " * 200_000 + "</p>")) == 1_000_000 - 1


@pytest.mark.parametrize(
    "page",
    [
        "<div>{}" * 40_000,
        "<p>{}<button>" + "<div>" * 40_000,
        "<div class=ad id=menu>{}" * 40_000,
        "<article>{}" * 20_000 + "</article>" * 20_000,
        "<p>{}</i>" * 20_000 + "<b><div>" * 20_000 + "</b>" * 20_000,
        "<ul><li>{}" * 20_000,
    ],
)
def test_time_is_linear_in_depth(page):
    start = time.process_time()
    main_text(page.replace("{}", "a few words here "))
    assert time.process_time() - start < 20


@pytest.mark.parametrize(
    "part",
    [
        f'<p class="related-work">{P2}</p>',
        f'<div id="search-methods"><p>{P2}</p></div>',
        '<p class="byline">By Jane Doe</p>',
        f'<h2 id="comments">{P2}</h2>',
        f'<section class="notice"><p>{(P2 + " ") * 40}</p></section>',
        '<p id="share">' + (P2 + " ") * 20 + "</p>",
    ],
)
def test_a_name_alone_removes_no_prose_of_the_article(part):
    text = " ".join(re.sub("<[^>]+>", " ", part).split())
    for tag in ("article", 'div class="post"'):
        page = f"<body><{tag}><h1>T</h1><p>{P1}</p>{part}<p>{P1}</p></{tag.split()[0]}><footer>(c)</footer></body>"
        assert main_text(page) == "\n\n".join(["T", P1, text, P1])


@pytest.mark.parametrize("name", ["ad", "comments", "sidebar", "cookie-notice", "menu", "newsletter-box", "adBanner"])
def test_marked_short_parts_go_inside_of_the_article_too(name):
    page = f'<body><div id="c"><p>{P1}</p><div class="{name}"><p>Buy it now, all of it.</p></div><p>{P2}</p></div></body>'
    assert main_text(page) == f"{P1}\n\n{P2}"


def test_the_headline_above_the_content_is_kept():
    body = f'<div class="body"><p>{P1}</p><p>{P2}</p></div>'
    for head in ("<div><h1>Headline</h1></div>", "<div><div><h1>Headline</h1></div><p>3 May</p></div>", "<h1>Headline</h1>"):
        page = f"<body><header><h1>Site</h1></header><div><h1><a href=/>Site</a></h1></div>{head}{body}<h1>After</h1></body>"
        assert main_text(page) in (f"Headline\n\n{P1}\n\n{P2}", f"Headline\n\n3 May\n\n{P1}\n\n{P2}")


def test_densities_against_the_definition():
    """Counts by walking every subtree anew, on random pages."""
    rnd = random.Random(8)

    def page(depth):
        out = []
        for _ in range(rnd.randint(1, 4)):
            out.append("word " * rnd.randint(0, 9))
            if depth and rnd.random() < 0.8:
                tag = rnd.choice(["div", "a", "section", "span", "div class=sidebar", "div id=ad"])
                out.append(f"<{tag}>{page(depth - 1)}</{tag.split()[0]}>")
        return "".join(out)

    def below(n):
        return [d for k in n.kids() for d in (k, *below(k))]

    def chars(n):
        return sum(len(re.sub(r"\s", "", c)) if isinstance(c, str) else chars(c) for c in n.children)

    def link_chars(n):
        return chars(n) if n.tag == "a" else sum(link_chars(k) for k in n.kids())

    def density(n, root):
        c, t = chars(n), max(len(below(n)), 1)
        lc, lt = max(link_chars(n), 1), max(sum(d.tag == "a" for d in below(n)), 1)
        ratio = link_chars(root) / chars(root)
        base = math.log(c / max(c - link_chars(n), 1) * lc + ratio * c + math.e)
        return n.weight * c / t * math.log(max(c / lc * t / lt, 1)) / math.log(base) if c else 0.0

    for _ in range(30):
        root = html_text.parse(page(5) + "x")
        html_text.prune(root)
        html_text.content_nodes(root)
        nodes = [root, *below(root)]
        for n in nodes:
            assert n.density == pytest.approx(density(n, root))
            assert n.total == pytest.approx(sum(density(k, root) for k in n.kids()))
            assert n.best.total == pytest.approx(max(d.total for d in (n, *below(n))))


def test_nulls_repeated_rows_and_clashing_columns(spark, tmp_path):
    import pyarrow as pa

    rows = [{"page_id": i, "url": f"u{i}", "html": h, "text": "x", "n_chars": "y", "a.b": "z"}
            for i, h in enumerate([None, "", f"<p>{P1}</p>", "<p>  </p>"])]
    rows += [rows[2], dict(rows[2], page_id=None, url=None)]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "pages.parquet")
    got = E.queries()["op3_html_text"](spark, str(tmp_path)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == sorted(
        [("0", "", 0), ("1", "", 0), ("2", P1, len(P1)), ("2", P1, len(P1)), ("3", "", 0), ("None", P1, len(P1))])


def test_query_returns_the_articles(spark):
    rows = pq.read_table(f"{E.SMOKE_DIR}/pages.parquet").to_pylist()
    got = {r["page_id"]: r for r in E.queries()["op3_html_text"](spark, E.SMOKE_DIR).collect()}
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        parts = (" ".join(unescape(re.sub(r"<(br|/?b)>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        text = "\n\n".join(x for x in parts if x)
        g = got[r["page_id"]]
        assert (g["text"], g["n_chars"], g["url"]) == (text, len(text), r["url"])
