from medistar.llm import html_extract as H


def test_parts_under_different_paths(spark):
    one = lambda i: f'<body><div class="x"><p>{f"whole article {i} " * 30}</p></div></body>'
    two = lambda i, k=55: (f'<body><div class="p"><p>{f"first part {i} " * k}</p></div>'  # noqa: E731
                           f'<div class="q"><p>{f"second part {i} " * (100 - k)}</p></div></body>')
    ten = "<body>" + "".join(f'<div class="s{chr(97 + k)}"><p>{f"part {k} of ten " * 20}</p></div>' for k in range(10)) + "</body>"
    pages = {**{i: one(i) for i in range(7)}, **{i: two(i) for i in range(7, 10)}, 10: two(10, 35), 11: ten, 12: ten, 13: ten}
    rows = [(i, "https://one.org/", page) for i, page in pages.items()] + [(50, "https://alone.org/", two(50)), (51, "https://ten.org/", ten)]
    got = {r.page_id: r.text for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, page in rows:
        assert got[i] == "\n\n".join(t for _, t, _ in H.parse(page))


def test_without_a_host():
    page = ('<body><div class="p"><p>' + "one " * 55 + '</p></div><div class="q"><p>' + "two " * 45
            + '</p></div><div class="r"><p><a href="x">' + "link " * 30 + "</a></p></div></body>")
    assert H.extract(page, []) == ("one " * 55).strip() + "\n\n" + ("two " * 45).strip()
