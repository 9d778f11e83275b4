import html
import re

from medistar.llm import html_extract as H

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<!-- ad <p>no</p> --><div class="ad">Buy</div><div id="cookie-notice">We use cookies</div>
<div class="wrap"><%s class="post-7"><h1>Title &amp; more</h1><p><b>First &#8212; para<br>line
 two</b> with <a href="y">link</a>.<p>Second&nbsp; para &lt;ok&gt;<ul><li>one<li>two</ul><form><input>Subscribe</form>
<aside>Related</aside></%s><section id="comments"><p>%s</p></section></div><div class="sidebar"><p>Side</p></div>
<footer>&copy; site</footer></body></html>"""
WANT = "Title & more\n\nFirst — para line two with link.\n\nSecond para <ok>\n\none\n\ntwo"


def test_blocks_without_boilerplate():
    for tag in ("article", "div", "main"):
        assert H.extract(PAGE % (tag, tag, "A reader comment that is long. " * 9), []) == WANT


def test_broken_html():
    assert H.extract(None, []) == H.extract("", []) == ""
    assert H.extract("plain text &amp; more", []) == "plain text & more"
    assert H.extract("<p>open <b>tags <p>everywhere <div>x", []) == "open tags\n\neverywhere\n\nx"
    assert H.extract("</div></p>a<br/>b<script>never closed", []) == "a b"
    assert H.extract("a < b and <3 \"quote' <p title=\"unclosed>t</p>", []).startswith("a < b and <3")
    assert H.extract("<p>" + "word " * 100_000 + "</p>", []) == ("word " * 100_000).strip()
    assert H.extract("<div>" * 3000 + "deep" + "</div>" * 3000, []) == "deep"
    assert H.extract("<article>" + "<" * 3000 + "</article>", []).count("<") >= 2999


def test_votes_decide(spark):
    """Pages of a host agree on a path; a page whose own best container differs follows them."""
    page = lambda i, body, box: f'<body><div class="c{i}"><p>{body}</p></div><div class="box"><p>{box}</p></div></body>'
    rows = [(i, f"https://www.one.org/{i}", page(i, f"main text {i} " * 30, "box " * 5)) for i in range(8)]
    rows.append((90, "http://one.org:80/odd", page(1, "short main " * 20, "a box that is longer than the main text " * 9)))
    rows += [(91, None, page(1, "no host " * 9, "b")), (92, "not a url", None), (93, "https://two.org/", ""), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS host", "'z' AS text", "1 AS paths")
    got = {r.page_id: r.text for r in H.extract_pages(pages).collect()}
    assert H.extract_pages(pages).count() == len(rows)
    assert got[3] == ("main text 3 " * 30).strip() and got[91] == ("no host " * 9).strip()
    assert got[90] == ("short main " * 20).strip()
    assert got[92] == got[93] == ""
    assert H.extract_pages(pages.limit(0)).count() == 0


def test_all_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in H.extract_pages(pages).collect()}
    for r in pages.collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n\n".join(x for x in blocks if x)
