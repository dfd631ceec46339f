import html as references
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from larkspur.llm import html_extraction as he
from larkspur.llm.queries import QUERIES, SQL
from tests.compare import compare, duck
from tests.llm.frames import SF_DIR

BODY = "html/body/article"


def plain(page):
    """The article element of the given pages, cut at tags of paragraphs and headings."""
    article = re.search(r"(?s)<article>(.*?)</article>", page).group(1).replace("<b>", "").replace("<br>", " ")
    blocks = (" ".join(references.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(x for x in blocks if x)


def test_query_against_the_article_element(spark):
    want = {r["page_id"]: (r["url"], plain(r["html"])) for r in pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()}
    rows = QUERIES["op12_html_extraction"](spark, SF_DIR).collect()
    assert len(rows) == len(want)
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_query_against_sql(spark):
    name = "op12_html_extraction"
    ok, message = compare(spark, duck(SF_DIR), name, QUERIES[name], SQL[name], SF_DIR)
    assert ok, message


PAGE = """<!doctype html><HTML><head><title>T &amp; t</title><style>p > a {}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><div id="cookie-notice"><p>We use cookies, a great many of them, more than there is text.</p></div>
<nav><ul><li><a href="/">Home</a><li><a href="/a>b">About</a></ul></nav>
<div class="wrap"><div class="post-12 main-text"><h2>Head   line</h2>
<p>One &amp; two<br>three&nbsp;four <b>bold <i>text</b></i><p title="a > b">Next <a href="x">link</a> here, with some more words to fill the line.
<script>var x = "</p><p>no";</script><form><label>Name</label><input><button>Send</button></form><!-- no <p>comment</p> --!>
<ul><li>first<li>second</ul><table><tr><td>1<td>2<tr><td>3</table>
<blockquote>Quoted &#8212; text &notit; &lt;p&gt;</blockquote><aside>By the way</aside></div>
<section class="Comments"><article class="comment"><p>A reader says something at length, and more of it than the post.</p></article></section></div>
<div class="ad-box"><p>Buy</p></div><div style="display: none">unseen</div><div hidden>unseen</div><footer>&copy; me</footer>"""
TEXT = """Head line
One & two three four bold text
Next link here, with some more words to fill the line.
first
second
1
2
3
Quoted — text ¬it; <p>"""


def test_a_page_of_many_parts():
    path, score = he.vote(PAGE)
    assert path == "html/body.has-sidebar/div.wrap/div.main-text.post-#" and score > 100
    assert he.main_text(PAGE, path) == TEXT
    assert he.main_text(PAGE, "html/body/none") == TEXT  # no such path: its own candidate
    assert he.main_text(PAGE, "") == TEXT  # the whole page, without what is left out


@pytest.mark.parametrize("page, text", [
    ("", ""), ("   ", ""), ("just text", "just text"), ("a < b and c<d", "a < b and c"), ("<p>a</p><p>b", "a\nb"), ("<p>x</p><a href='", "x"),
    ("<script>x", ""), ("<!-- x", ""), ("a<!>b<?x?>c</>d", "abcd"), ("<nav>x</nav>", ""), ("<title>a</title>b", "b"), ("<P CLASS=x>a</P >b", "a\nb"),
    ("&amp &am &#65;&#x42; &amp;lt;", "& &am AB &lt;"), ("<textarea><p>x</textarea>y", "y"), ("<p>a<b>b</p>c", "ab\nc"), ("</div></p>x</body>y", "xy"),
    ("a<br/>b<hr>c", "a b\nc"), ("<li>a<li>b", "a\nb"), ("<div><div><div>deep</div></div></div>", "deep"), ("x  y z", "x y z"),
])
def test_odd_pages(page, text):
    assert he.main_text(page, None) == text


@pytest.mark.parametrize("unit", [
    "<a ", '<a "', "<div>", "<a '\"", "<", "</", "<!--", "&amp", "<p>", '<div class="a', "<script>", '"<a', "<li>", "<td>", "<p><table>", "<p><button><div>",
])
def test_long_runs_take_linear_time(unit):
    start = time.perf_counter()
    page = unit * (400_000 // len(unit))
    he.vote(page)
    he.main_text("<p><button>" + page, "html/body")
    assert time.perf_counter() - start < 20


def test_random_markup_never_fails():
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<div class='c1'>", "</div>", "<", ">", "'", '"', "text ", "&amp;", "&", "<table>", "<td>", "<li>", "</ul>", "<a href=", "<!--", "-->", "<nav>", "</nav>", "<br>"]
    for _ in range(3000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        found = he.vote(page)
        text = he.main_text(page, found and found[0])
        assert text == "\n".join(" ".join(x.split()) for x in text.split("\n"))


SCHEMA = "page_id bigint, url string, html string, host string, path string, text string, row int, n_chars int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "p", "t", 1, 2) for r in rows], SCHEMA).repartition(3)


def test_hosts_agree(spark):
    long, short = "many words of a long article " * 9, "brief"
    article = "<body><div class='c{}'><p>{}</p></div><div class=x><p>{}</p></div></body>"
    rows = [(i, f"http://A.com/{i}", article.format(i, long, short)) for i in range(5)]
    rows += [(10, "http://a.com/odd", article.format(1, short, long)), (11, "http://a.com/other", "<main>elsewhere</main>")]  # outvoted; not there
    rows += [(12, "http://a.com/none", "<body><div class=c7></div><div class=x><p>stray</p></div>")]
    rows += [(13, None, article.format(1, short, long)), (14, "no host", article.format(1, short, long)), (15, "http://b.com", None), (16, "http://b.com", "")]
    rows += [(None, "http://b.com", "<p>x"), (17, "http://c.com", "<p>é𝒳"), (17, "http://c.com", "<p>é𝒳")]
    found = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in he.extract(frame(spark, rows)).collect()), key=repr)
    want = [(i, long.strip(), len(long) - 1) for i in range(5)]
    want += [(10, "brief", 5), (11, "elsewhere", 9), (12, "", 0), (13, long.strip(), len(long) - 1), (14, long.strip(), len(long) - 1)]
    want += [(15, "", 0), (16, "", 0), (None, "x", 1), (17, "é𝒳", 2), (17, "é𝒳", 2)]
    assert found == sorted(want, key=repr)
    paths = {r["host"]: (r["path"], r["pages"]) for r in he.host_paths(frame(spark, rows)).collect()}
    assert paths["a.com"] == ("body/div.c#", 5) and set(paths) == {"a.com", "b.com", "c.com"}


def test_empty_table(spark):
    assert he.extract(frame(spark, [])).collect() == []
