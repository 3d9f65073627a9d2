import pytest

from tidemark.llm.html_text import extract_pages, host_templates, main_text, parse, subtree_hashes


def text(html):
    return main_text(parse(html))


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a\n  b<p>c&nbsp;d", "a b\nc d"),
        ("<article><h1>T</h1><p><b>one<br>two<p>three</article><footer>f</footer>", "T\none two\nthree"),
        ('<script>var t="</p>";</script><style>p{}</style><p>x</p><!-- y --><p>z', "x\nz"),
        ('<div class="ad">a</div><div class="site-Sidebar">s</div><div class="cookie-notice">n</div><p>x</p>', "x"),
        ('<div class="with-sidebar"><article>body</article></div>', "body"),
        ('<article>x<div class="comments"><article class="comment">c</article></div></article>', "x"),
        ("<main><p>x</p><form>f<input></form><nav>n</nav></main>outside", "x"),
        ('<ul><li><a href="/a">a</a><li><a href="/b">b</a></ul><p>x</p>', "x"),
        ("<article><ul><li>one<li>two</ul></article>", "one\ntwo"),
        ("<p>a < b <!-- never closed", "a < b"),
        ("<p title='a>b'>x</p></div></p>y", "x\ny"),
        ('<p title="open>x</p>', "x"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<p>x&#8364;&lt;b&gt;&bogus;</p>", "x€<b>&bogus;"),
        ("<p>in<i>li</i>ne</p>", "inline"),
    ],
)
def test_main_text(html, want):
    assert text(html) == want


def test_long_page_is_read_in_one_go():
    html = "<article>" + "".join(f"<p>para {i} " + "x" * 50 for i in range(20000)) + "</article>"
    assert text(html).count("\n") == 19999
    assert text("<div>" * 5000 + "deep") == "deep"


def page(k, host, extra="share this page with friends"):
    return (k, f"https://{host}/{k}", f"<body><p>{extra}</p><article><p>story {k}</p><p>{extra}</p></article></body>")


def test_template_of_a_host_is_removed(spark):
    rows = [page(k, "a.example") for k in range(6)] + [page(9, "b.example")]
    # Copies of one page do not make its text a template.
    rows += [(20 + k, "http://c.example/x", "<article><p>copied text</p></article>") for k in range(8)]
    rows += [(40, None, "<p>no host</p>"), (41, "http://d.example", None), (None, "http://d.example", "<p>x"), (40, None, "<p>no host</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'z' as text", "1 as host")
    found = {(r.page_id, r.text) for r in extract_pages(pages).collect()}
    assert found == (
        {(k, f"story {k}") for k in range(6)}
        | {(9, "story 9\nshare this page with friends")}
        | {(20 + k, "copied text") for k in range(8)}
        | {(40, "no host"), (41, ""), (None, "x")}
    )
    assert extract_pages(pages).count() == len(rows)
    assert [r.host for r in host_templates(pages).collect()] == ["a.example"]
    assert extract_pages(pages.limit(0)).count() == 0


def test_whole_test_table_against_brute_force(spark):
    """Templates counted in plain Python give the same texts."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    by_host = {}
    for r in rows:
        root = parse(r.html)
        by_host.setdefault(r.url.split("//")[1].split("/")[0].lower(), {})[root.hash] = subtree_hashes(root)
    template = {}
    for host, pages in by_host.items():
        every = [h for hashes in pages.values() for h in hashes]
        template[host] = frozenset(h for h in set(every) if every.count(h) >= max(5, 0.5 * len(pages)))
    want = {r.page_id: main_text(parse(r.html), template[r.url.split("//")[1].split("/")[0].lower()]) for r in rows}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert {r.page_id: r.text for r in extract_pages(pages).collect()} == want
    assert all(want.values())


def test_unmarked_template_on_few_pages_of_a_host(spark):
    top = "<div><p>Acme Daily</p><p>All the news</p></div>"
    foot = "<div>Imprint of Acme</div>"
    share = "<div>Send to a friend</div><div>Print this page</div>"
    rows = []
    for k in range(40):
        lead = "<h2>Weather report</h2>" if k % 5 == 0 else f"<h2>Report {k}</h2>"
        body = f"<div>{lead}<p>story number {k} begins</p><p>and {k} ends here</p>{share if k % 4 == 0 else ''}</div>"
        html = f"<body>{top if k % 5 == 1 else ''}{body}{foot if k % 6 == 2 else ''}</body>"
        rows.append((k, f"https://a.example/{k}", html))
    rows.append((50, "https://a.example/50", f"<body>{top}{foot}</body>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in extract_pages(pages).collect()}
    want = {k: f"{'Weather report' if k % 5 == 0 else f'Report {k}'}\nstory number {k} begins\nand {k} ends here" for k in range(40)}
    assert found == want | {50: "Acme Daily\nAll the news\nImprint of Acme"}
