import html
import random
import re
import time

import pytest

from litscreen.llm import density

LONG = "This is a sentence of the article that goes on for a while, with words enough."
PAGES = {
    "": "", "   ": "", "plain text only": "plain text only", "<p>": "", "a &lt;b&gt; &amp;amp; &eacute;&#233;": "a <b> &amp; éé",
    f"<body><div id=content><h2>A</h2><p>{LONG}<p>x &lt; y<br>z</div><div class='comments'><p>{LONG}</p><p>{LONG}</p></div></body>": f"A\n\n{LONG}\n\nx < y z",
    f"<body><article><header><h1>T</h1></header><section><p>{LONG}</p><p>{LONG}</p></section><section><p>S  \n s</p></section>"
    f"<aside>{LONG * 9}</aside></article><section id=comments><p>{LONG * 20}</p></section>": f"T\n\n{LONG}\n\n{LONG}\n\nS s",
    f"<header><h1>Site</h1></header><main><ul><li>a<li>b<ul><li>c</ul></ul><p>{LONG}</p><form><p>{LONG}</p></form></main><footer>f</footer>": f"a\n\nb\n\nc\n\n{LONG}",
    f"<div><div><p>{LONG}</p><p>{LONG}</p></div><div class=x><a href=1>A link</a><a href=2>Some other</a></div></div><script>'<p>no</p>'</script>":
    f"{LONG}\n\n{LONG}",
    f"<article><p>{LONG}<div class='ad-slot'>buy</div><p>end</p><!-- <p>no</p> --><style>p{{}}</style></article>": f"{LONG}\n\nend",
    f"<article><p>one</b></i></div> two<p>{LONG}": f"one two\n\n{LONG}",
    "<title>t</title><body>a<script>b": "a", "<body hidden>x</body>": "x", "<p>a < b and 5 <6": "a < b and 5 <6",
    f"<div role=navigation>menu</div><table><tr><td>one<td>two<tr><td>{LONG}</table>": f"one\n\ntwo\n\n{LONG}",
}


@pytest.mark.parametrize("page", PAGES)
def test_pages(page):
    assert density.main_text(page) == PAGES[page]


def test_long_and_deep_pages_are_linear():
    start = time.time()
    assert len(density.main_text("<div>" * 20_000 + "x" * 1000 + "</div>" * 20_000)) == 1000
    assert density.main_text("<article>" + "<p>a b" * 20_000).count("\n\n") == 19_999
    assert density.main_text("<b " * 5_000) is not None and density.main_text("<" * 50_000 + "&" * 50_000) is not None
    assert time.time() - start < 60


def article(page):
    """The main text of the pages of the table, by their plain form."""
    body = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", page, re.S)[1]).replace("<br>", " ")
    found = [" ".join(html.unescape(x).split()) for x in re.split(r"</?p>|</?h1>", body)]
    return "\n\n".join(filter(None, found))


def test_query_on_whole_table(spark, data):
    from litscreen.llm.queries import op5_html_density

    pages = {r.page_id: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = op5_html_density(spark, data).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_nulls(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (None, "u", "<p>a</p>", 1), (1, "u", "", 1)], "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in density.extract(pages).collect()) == [(0, "a", 1), (1, "", 0), (1, "", 0)]
    assert density.extract(pages.limit(0)).count() == 0


def test_what_is_around_the_article_is_left_out():
    outside = ["<nav>N</nav>", "<header>H</header>", "<footer>F</footer>", "<aside>A</aside>", "<form>F<input></form>", "<script>S</script>",
               "<style>S</style>", "<noscript>N</noscript>", "<!-- C -->", "<div class='cookie-banner'>C</div>", "<div id=sidebar>S</div>",
               "<section class='user-comments'><article class='comment'><p>C</p></article></section>", "<div class='ad'>A</div>",
               "<ul class='breadcrumb'><li>B</li></ul>", "<div role='complementary'>C</div>", "<div class='site_notice'>N</div>"]
    for place in ("before", "inside", "after"):
        put = lambda here: "".join(outside) if place == here else ""
        page = f"<body>{put('before')}<article><h1>T</h1><p>{LONG}</p>{put('inside') if place == 'inside' else ''}<p>end</p></article>{put('after')}</body>"
        expected = f"T\n\n{LONG}\n\nend"
        assert density.main_text(page.replace("<header>H</header>", "") if place == "inside" else page) == expected


def test_sections_beside_each_other_stay():
    """An article without a name in several boxes below the body, or in a box each."""
    parts = [f"{LONG} {i}" for i in range(15)]
    sections = ["".join(f"<p>{p}</p>" for p in parts[i:i + 5]) for i in (0, 5, 10)]
    menu = "<div><a href=1>One</a><a href=2>Two</a><a href=3>Three</a></div>"
    for begin, end in (("<section>", "</section>"), ("<div><div>", "</div></div>")):
        page = f"<body><nav>N</nav>{menu}<h1>Title</h1>" + "".join(begin + x + end for x in sections) + f"<p>end</p>{menu}</body>"
        assert density.main_text(page) == "\n\n".join(["Title", *parts, "end"])


@pytest.mark.parametrize("name", ["class='site no-sidebar'", "class='right-sidebar'", "class=has-footer", "class='content-with-comments'",
                                  "class=ad-free", "class=has-banner", "id=page-header-fixed"])
def test_names_of_wrappers_do_not_drop_what_they_hold(name):
    for inner in (f"<article><h1>T</h1><p>{LONG}</p></article>", f"<h1>T</h1><p>{LONG}</p>"):
        page = f"<body><div {name}><div class='sidebar'>S</div>{inner}<div class=comments><article class=comment>C</article></div></div></body>"
        assert density.main_text(page) == f"T\n\n{LONG}"
    assert density.main_text(f"<body><div class='related'><article>Other</article></div><div><p>{LONG}</p></div></body>") == LONG


def test_articles_beside_each_other_stay():
    parts = [f"<article><h{i}>T{i}</h{i}><p>{LONG} {i}</p></article>" for i in (1, 2)]
    assert density.main_text(f"<body>{''.join(parts)}</body>") == f"T1\n\n{LONG} 1\n\nT2\n\n{LONG} 2"
    links = "<article><a href=1>More</a><a href=2>Even more</a><a href=3>Last one</a></article>"
    assert density.main_text(f"<body><div>{parts[0]}</div>{links}<div>{parts[1]}</div></body>") == f"T1\n\n{LONG} 1\n\nT2\n\n{LONG} 2"


@pytest.mark.parametrize("name", ["related-work", "market share", "side-effects", "search", "menu", "alert", "reply", "hidden", "social"])
def test_topics_inside_an_article_are_text_where_they_are_dense(name):
    page = f"<body><article><p>{LONG}</p><section class='{name}'><p>{LONG} too</p></section></article></body>"
    assert density.main_text(page) == f"{LONG}\n\n{LONG} too"
    sparse = f"<ul class='{name}'><li><a href=1>A</a></li><li><a href=2>B</a></li><li><a href=3>C</a></li></ul>"
    assert density.main_text(f"<body><article><p>{LONG}</p>{sparse}<p>{LONG}</p></article></body>") == f"{LONG}\n\n{LONG}"


MENU = "<div>" + "".join(f"<div><a href={i}>Entry {i}</a></div>" for i in range(8)) + "</div>"
PLAIN = [
    f"<body>{MENU}<div>{''.join(f'<p>{LONG} {i}</p>' for i in range(6))}</div><div><a href=1>Terms</a><a href=2>Contact</a></div></body>",
    f"<body><div>{MENU}<div><h1>T</h1>{''.join(f'<p>{LONG} {i}</p>' for i in range(6))}</div></div>{MENU}</body>",
    f"<body><table><tr><td>{MENU}</td><td>{''.join(f'<p>{LONG} {i}</p>' for i in range(9))}</td></tr></table></body>",
]
TEXTS = ["\n\n".join(f"{LONG} {i}" for i in range(6)), "T\n\n" + "\n\n".join(f"{LONG} {i}" for i in range(6)),
         "\n\n".join(f"{LONG} {i}" for i in range(9))]


def test_menus_and_footers_without_names_are_told_by_density(monkeypatch):
    assert [density.main_text(p) for p in PLAIN] == TEXTS
    rng = random.Random(1)
    monkeypatch.setattr(density, "density", lambda *_: rng.random())
    wrong = sum(density.main_text(p) != t for p, t in zip(PLAIN * 5, TEXTS * 5))
    assert wrong > 5
