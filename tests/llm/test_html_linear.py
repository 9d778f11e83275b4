import time

import pytest

from medistar.llm import html_extract as H

MB = 1 << 20


@pytest.mark.parametrize("piece", [
    "<a<", "<a '", "<a \"'>", "<a \"\'\'>", "&amp;<b ", "<", "<!", "<!-", "</", "<a x=", "<div>", "<i>", "</b>", "<p>", "<td>", "<li><b>",
    "<i><ul></ul>", "<option>", "<b><div><i>", "a ", "&", "<script>", "<br/>", "<a\t"])
def test_linear_on_hostile_patterns(piece):
    def run(n):
        page = "<b><div>" + piece * (n // len(piece)) + "</i></b>" * 100
        t = time.process_time()
        H.extract(page, [1, 2], whole=[3], minor=[4])
        return time.process_time() - t
    a, b = run(MB // 8), run(MB // 2)
    assert b < max(1.0, 8 * a) and b < 15  # four times the length; a quadratic parser takes 16 times


def test_half_a_megabyte_of_end_tags():
    page = "<div>" + "<i>" * 60_000 + "x" + "</b>" * 60_000 + "<ul></ul>" * 60_000
    t = time.process_time()
    assert H.extract(page, []) == "x"
    assert time.process_time() - t < 15


ARTICLE = "".join(f"<p>paragraph {i} of the main text</p>" for i in range(9))
TEXT = "\n\n".join(f"paragraph {i} of the main text" for i in range(9))


@pytest.mark.parametrize("page", [
    "<body><form id='aspnetForm'>{}<label>Name</label><input><button>Go</button></form></body>",
    "<div class='sidebar-layout'><article>{}</article></div>",
    "<body><div class='page widget-page'><main>{}</main></div></body>",
    "<main class='story-alert'>{}</main>",
    "<body><div role='dialog'><div class='modal overlay'>{}</div></div><div class='ad'>Buy</div></body>",
    "<header><div>{}</div></header>",
])
def test_main_text_is_not_cut(page):
    assert H.extract(page.format(ARTICLE), []) == TEXT


@pytest.mark.parametrize("beside", [
    "<div class='related'>{}</div>", "<form class='subscribe'><p>{}</p></form>", "<section class='comments'><article>{}</article></section>",
    "<div class='widget'><p>{}</p></div>", "<div id='cookie-notice'><p>{}</p></div>"])
def test_long_parts_beside_an_article_go(beside):
    long = "beside the main text " * 60
    for body in ("<article>{}</article>", "<div class='entry-content'>{}</div>"):
        page = "<body>" + body.format(ARTICLE) + beside.format(long) + "</body>"
        assert H.extract(page, []) == TEXT


def test_many_layouts_of_one_host(spark):
    """Every layout of a host is voted on, however many there are; held against the page's own text."""
    rows = []
    for i in range(400):
        layout = f"lay{chr(97 + i % 40 // 26)}{chr(97 + i % 40 % 26)}"
        rows.append((i, "https://many.org/x", f"<body><div class='{layout}'><p>{f'main text {i} ' * 40}</p></div>"
                     f"<div class='box'><p>{'box text ' * 3}</p></div></body>"))
    # one page of each layout has a box longer than its main text: the host's votes decide
    rows += [(1000 + k, "https://many.org/x", rows[k][2].replace("main text", "short").replace("box text " * 3, "box text " * 60))
             for k in range(40)]
    got = {r.page_id: r.text for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == " ".join([f"main text {i}"] * 40) for i in range(400))
    assert all(got[1000 + k] == " ".join([f"short {k}"] * 40) for k in range(40))
