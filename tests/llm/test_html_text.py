import html
import random
import re

from cladeframe.llm.html_text import main_text, parsed
from cladeframe.llm.queries import op7_html_text
from tests.conftest import SF

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h2>Site name</h2></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-banner">We use cookies</div>
<article><header><h1>Big &amp; bold</h1></header><p>First  <b>bold</b>\n text.<p>Second&nbsp;&eacute; one<br>more.
<ul><li>point a<li>point b</ul><script>var x = "<p>no</p>";</script><!-- <p>no</p> -->
<div class="ad">buy</div><form>name <input></form><blockquote>said</blockquote>
<section class="comments"><p>nice post</p></section></article>
<aside>more</aside><footer>&copy; me</footer></body></html>"""


def text_of(page):
    _, blocks, wanted, _ = parsed(page)
    return "\n".join(b for b, w in zip(blocks, wanted) if w)


def test_parse():
    assert text_of(PAGE) == "Big & bold\nFirst bold text.\nSecond é one more.\npoint a\npoint b\nsaid"
    assert text_of(None) == text_of("") == text_of("<p>") == ""
    assert text_of("plain <b>text") == "plain text"
    assert text_of("<main><p>in</main><p>out") == "in"
    assert text_of("<div>" * 5000 + "deep") == "deep"
    assert text_of("<table><tr><td>a<td>b<tr><td>c</table>") == "a b\nc"


def test_wrappers_keep_the_article():
    body = "<article><p>the story</p><div class='ad'>buy</div></article>"
    for page in (
        f'<body class="has-sidebar comments-open">{body}</body>', f'<div class="layout with-sidebar">{body}</div>', f"<form>{body}</form>", f'<div class="widget">{body}</div><p>c</p>',
        '<body class="sidebar"><p>the story</p><div class="cookie-banner">ok</div></body>', "<form><p>the story</p><nav>menu</nav></form>",
    ):
        assert text_of(page) == "the story", page
    assert text_of("<p>the story</p><aside><article>a teaser that is longer than the story</article></aside>") == "the story"


def test_inline_furniture_goes():
    assert text_of('<p>text <span class="ad">Buy now</span></p>') == "text"
    assert text_of('<p>a <span hidden>x <b>y</b></span>b</p>') == "a b"
    assert text_of('<div>text <span class="ad">x<div>y</div></span> end</div>') == "text\nend"


def test_template_removal(spark):
    page = lambda i: f"<body><div>Every page of this site says this same sentence</div><div><p>story number {i} is told here</p><p>Yes.</p></div></body>"
    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(8)] + [(100 + i, "http://a.org/x", page(99)) for i in range(30)] + [(200, "https://b.org", page(1)), (200, None, page(2)), (200, None, page(2)), (None, "u", None)]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, k1 int, host string")
    out = main_text(docs)
    assert out.count() == len(rows)
    by = {}
    for r in out.collect():
        by.setdefault((r.page_id, r.url), r.text)
    assert by[3, "http://a.org/3"] == "story number 3 is told here\nYes."
    assert by[101, "http://a.org/x"] == "story number 99 is told here\nYes."
    assert by[200, "https://b.org"].startswith("Every page")
    assert by[None, "u"] == ""


def test_empty(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query(spark):
    """On the given pages the article is all that counts: as by a plain cut of the markup."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in op7_html_text(spark, SF).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in parts if x)
        assert r.n_chars == len(r.text)


def test_class_names_that_only_hold_a_word_of_furniture(spark):
    """Longer names are no furniture because one of their parts is; compounds of such words are."""
    keep = ["elementor-widget-container", "share-price", "related-work", "notice-period", "modal-verbs", "rail-transport", "ad-hoc", "commentary", "popup-book", "pager_duty"]
    drop = ["cookie-banner", "ad-slot", "site-footer", "main-nav", "comment-list", "sidebar_left", "share-buttons", "related-posts", "newsletter", "social-links"]
    rows = [(1, f"<body><article><p>First.</p>{''.join(f'<div class={chr(34)}{c}{chr(34)}><p>In {c}.</p></div>' for c in keep + drop)}</article></body>"), (2, '<body><div class="elementor-widget-container"><p>Whole page.</p></div><div class="site-footer">Foot.</div></body>')]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame([(i, f"http://h{i}/", h) for i, h in rows], "page_id long, url string, html string")).collect()}
    assert got[1].split("\n") == ["First.", *[f"In {c}." for c in keep]] and got[2] == "Whole page."


def test_templates_that_only_counting_finds(spark):
    """Pages without an article, whose furniture has neither telling tags nor names."""
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice("amber birch cedar delta ember fjord grove heath inlet juniper".split()) + str(rng.randrange(999)) for _ in range(n))
    head, foot = "<div><p>The Example Gazette brings you stories from all over town every single day.</p></div>", "<div><span>Printed on recycled paper by the river mill since the year nineteen hundred.</span></div>"
    own = [(say(40), say(30)) for _ in range(60)]
    pages = [(i, f"http://gazette.example/{i}", f"<body>{head}<div><p>{a}</p><p>{b}</p></div>{foot}</body>") for i, (a, b) in enumerate(own)]
    pages += [(100, "http://other.example/1", f"<body>{head}<div><p>Alone.</p></div></body>")]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"{a}\n{b}" for i, (a, b) in enumerate(own))
    assert got[100] == "The Example Gazette brings you stories from all over town every single day.\nAlone."
