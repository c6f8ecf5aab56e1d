import html
import re
from collections import Counter

from chronostar.llm import html_text, queries
from chronostar.llm.html_text import Weights, learn, main_text

from .brute import table
from .conftest import SF


def article(page):
    """The lines of the test pages' article element, which has headings and paragraphs only."""
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    blocks = (html.unescape(re.sub(r"<[^>]*>?", "", b)).split() for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(" ".join(b) for b in blocks if b)


def test_query(spark):
    rows = table(SF, "pages")
    got = {r.page_id: r for r in queries.op10_main_text(spark, SF).collect()}
    assert got.keys() == {r["page_id"] for r in rows}
    for r in rows:
        own = got[r["page_id"]]
        assert (own.url, own.text, own.n_chars) == (r["url"], article(r["html"]), len(article(r["html"])))


PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script><style>p {}</style></head><body>
<header><h1>Site name</h1></header><nav class=menu><a>Home</a> <a>About</a></nav>
<div id="cookie-notice">We use cookies and this notice has many words in it</div><!-- <p>comment</p> -->
<main><article><header><h1>Title &amp; more</h1></header><p>One  two<br>three &lt;four&gt;</p><aside><p>Side bar</p></aside>
<div class="ad"><div>buy</div> now</div><p>Five</p><ul><li>six <b>se</b>ven</li><li>&#8364;</li></ul></article>
<section class="comments"><p>I like it very much indeed and write a long comment</p></section></main>
<form>Subscribe <input> now</form><footer>&copy; somebody</footer></body></html>"""


def test_page_with_all_kinds_of_parts():
    expected = "Title & more\nOne two three <four>\nFive\nsix seven\n€"
    assert main_text(PAGE, Weights()) == expected
    assert main_text(PAGE, learn([PAGE])) == expected


def test_region_without_content_element():
    body = "<p>" + "words of the text " * 20 + "</p>"
    page = f"<div><a>x</a><a>y</a></div><ul><li><a>z</a></li></ul><div>{body}{body}</div><table><tr><td><a>q</a></td></tr></table>"
    weights = learn([PAGE.replace("<article>", "<article><p>" + "plain words " * 200 + "</p>")])
    line = " ".join(("words of the text " * 20).split())
    assert main_text(page, weights) == f"{line}\n{line}"


def test_marked_wrappers_keep_their_text():
    text = "words of the text " * 20
    line = text.strip()
    for name in ("layout has-sidebar", "content no-comments", "entry with-share", "share", "notice"):
        page = f"<body><div class='{name}'><p>{text}</p><div class='ad'>buy now</div></div></body>"
        assert main_text(page, Weights()) == line
        page = f"<body><nav>a b</nav><article><div class='{name}'><p>{text}</p></div></article></body>"
        assert main_text(page, Weights()) == line
    page = f"<article><p>{text}</p></article><section class='comments'><p>{text}</p><p>{text}</p></section>"
    assert main_text(page, Weights()) == line


def test_missing_end_tags():
    weights = Weights(other=-0.001)
    assert main_text("<p class='notice'>a<p>b</p><p>c d e</p>", weights) == "b\nc d e"
    assert main_text("<ul><li class='ad'>a<li>b<li>c d</ul><p>e", weights) == "b\nc d\ne"
    assert main_text("<dl><dt class='ad'>a<dd>b c</dl><table><tr><td class='ad'>d<td>e<tr><td>f</table>", weights) == "b c\ne\nf"


def test_pages_without_content_elements():
    """The scan alone: the test pages, their article element made a div, against the article's words."""
    rows = table(SF, "pages")
    weights = learn(r["html"] for r in rows)
    both = got = wanted = 0
    for r in rows:
        own = main_text(re.sub(r"<(/?)(?:article|main)\b", r"<\1div", r["html"]), weights).split()
        true = article(r["html"]).split()
        both += sum((Counter(own) & Counter(true)).values())
        got, wanted = got + len(own), wanted + len(true)
    print("precision", both / got, "recall", both / wanted)
    assert both >= 0.9 * got and both >= 0.9 * wanted


def test_broken_pages():
    weights = Weights()
    assert main_text("", weights) == ""
    assert main_text("plain text only", weights) == "plain text only"
    assert main_text("<p>a b c d <b", weights) == "a b c d"
    assert main_text("<article><p>open <i>to the end", weights) == "open to the end"
    assert main_text("<p>a</p><script>never closed <p>b</p>", weights) == "a"
    assert main_text("<p>before<!-- never closed", weights) == "before"
    assert main_text("<article><p>1 < 2 and 3 > 2</p></article>", weights) == "1 < 2 and 3 > 2"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", weights) == "deep"


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>a</p>"), (2, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS `key`")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [(0, "v", "a", 1), (1, "u", "", 0), (2, "", "", 0), (2, "", "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_deep_pages_take_linear_time():
    # Minutes each if every element walked those around it.
    deep = "<article>y y y y " * 20_000
    assert main_text(deep, Weights()).count("y") == 80_000
    main_text("<div class=sidebar>x " * 20_000, Weights())
    main_text("<li><td><p>z" * 20_000, Weights())
