from chanwh.llm.html_extract import content_blocks, extract_main_text, match_trees, read_page


def text(html):
    return [t for _, t in content_blocks(read_page(html)[1])]


def test_blocks_and_characters():
    assert text("<p>a&nbsp;b\n  c<p>d<b>e</b>f<br>g") == ["a b c", "def g"]
    assert text("&lt;b&gt; &amp;amp; &#233;&#x1F642; &copy &notit;") == ["<b> &amp; é🙂 © ¬it;"]
    assert text("<div>one<div>two</div>three</div>") == ["one", "two", "three"]
    assert text("<ul><li>x<li>y</ul><table><tr><td>1<td>2</table>") == ["x", "y", "1", "2"]
    assert text("a < b <3 c") == ["a < b <3 c"]
    assert text("") == [] and text(" \n ") == [] and text("<p></p>") == []


def test_what_is_never_content():
    page = """<!DOCTYPE html><head><title>T</title><style>p{}</style></head><body><header>top</header><nav><ul><li>m</ul></nav>
    <div class="ad">buy</div><div id="side-bar" class="sidebar left">s</div><main><article><h1>H</h1><p>body</p><script>"</p>"</script>
    <form>f<input></form><aside>a</aside><p hidden>no</p><div class="comments"><article>reader</article></div><p>end</p></article></main>
    <div role="complementary">r</div><div class="cookie-notice">c</div><footer>foot</footer>"""
    assert text(page) == ["H", "body", "end"]
    assert text("<!-- <p>x</p> --><p>y<!-- open") == ["y"]
    assert text("<p>y<script>never closed") == ["y"]
    assert text('<p title="a > b">q</p><p class=x/>r') == ["q", "r"]


def test_marks_do_not_take_the_article_away():
    story = "<div class='story'><p>A long first part of the story</p><p>and a long second part</p></div>"
    want = ["A long first part of the story", "and a long second part"]
    assert text(f"<h1 class='main-title'>Title</h1>{story}") == ["Title", *want]
    assert text(f"<h1 class='main'>Title</h1>{story}") == ["Title", *want]
    assert text(f"{story}<article>card 1</article><article>card 2</article>") == [*want, "card 1", "card 2"]
    for box in ("article class='post no-sidebar'", "section id='related-work'", "h2 id='search'", "h2 id='sharing-data'", "p class='notice-period'",
                "div class='social-policy'", "main class='search'", "article id='comment'"):
        assert text(f"<p>one</p><{box}>words</{box.split()[0]}>") in (["one", "words"], ["words"]), box
    # around the page's only article, whatever it is called; not around others than that
    assert text(f"<div class='widget'><form><article>{story}a <b>bold</b> end</article></form><div class='ad'>buy</div></div>") == [*want, "a bold end"]
    assert text(f"<article>{story}</article><div class='comments'><article>reader</article></div>") == want
    assert text("<div hidden><article>no</article></div><p>yes</p>") == ["yes"]
    assert text(f"{story}<div id='side_bar'>s</div><div class='cookie-notice'>c</div>") == want


def test_deep_and_long_pages():
    assert text("<div>" * 20_000 + "x" + "</div>" * 20_000) == ["x"]
    assert text("<p>" + "word " * 200_000)[0].count(" ") == 199_999
    assert len(text("<a \"" * 3_000)) <= 1


def test_simple_tree_matching():
    a = "(#(body(nav)(div.main(h1)(p)(ul(li)))(footer)))"
    b = "(#(body(div.main(h1)(ul(li))(p))(footer)))"
    at = match_trees(a, b)
    # root, body, div, h1, one of p and ul (the larger: ul with li), footer
    assert at == [0, 1, -1, 2, 3, -1, 4, 5, 7]
    assert match_trees(a, a) == list(range(9))
    assert match_trees("(x)", "(y)") == [-1] and match_trees("", "") == []


def site(n, host="news.example.org"):
    return [(k, f"http://{host}/{k}", f"<body><div class=line>Subscribe to our paper</div><div class=story><p>Story {k} begins</p><p>and ends {k * k}</p></div>"
             + ("<div class=extra>bonus</div>" if k % 3 == 0 else "") + "<div class=end>All rights reserved</div></body>") for k in range(n)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, nodes int")


def test_constant_nodes_are_template(spark):
    got = {r.page_id: r for r in extract_main_text(pages(spark, site(12))).collect()}
    for k in range(12):
        # the extra block is not on most pages, so it stays
        want = f"Story {k} begins\nand ends {k * k}" + ("\nbonus" if k % 3 == 0 else "")
        assert got[k].text == want and got[k].n_chars == len(want) and got[k].template_blocks == 2


def test_template_over_varied_skeletons_and_odd_pages(spark):
    """Every page has a skeleton of its own, and two of forty another footer."""
    kinds = ["<h2>head {k}</h2>", "<p>text {k}</p>", "<ul><li>item {k}</ul>", "<table><tr><td>cell {k}</table>"]
    rows, want = [], {}
    for k in range(40):
        body = [kinds[k // 4 ** j % 4].format(k=f"{k}-{j}") for j in range(3)]
        end = "A note of this page" if k in (7, 23) else "All rights reserved"
        rows.append((k, f"http://v.example.org/{k}", f"<div class=line>Welcome to our paper</div><div class=story>{''.join(body)}</div><div class=end>{end}</div>"))
        want[k] = [f"{['head', 'text', 'item', 'cell'][k // 4 ** j % 4]} {k}-{j}" for j in range(3)] + (["A note of this page"] if k in (7, 23) else [])
    got = {r.page_id: r for r in extract_main_text(pages(spark, rows)).collect()}
    assert {k: r.text.split("\n") for k, r in got.items()} == want
    assert all(r.template_blocks == (1 if k in (7, 23) else 2) for k, r in got.items())


def test_article_marks_are_judged_after_the_template(spark):
    """The article has most of the text only without the template; teaser cards do not."""
    line = "Our paper has a long line that stands above and below every one of its pages, whatever they are about"
    rows = [(k, f"http://m.example.org/{k}", f"<div class=line>{line}</div><main><p>Short story {k}</p></main><div class=by>of {k}</div>") for k in range(10)]
    rows += [(100 + k, f"http://t.example.org/{k}", f"<div class=story><p>The whole story number {k}</p></div><article>card {k}</article>") for k in range(10)]
    got = {r.page_id: r.text for r in extract_main_text(pages(spark, rows)).collect()}
    assert got == {k: f"Short story {k}" for k in range(10)} | {100 + k: f"The whole story number {k}\ncard {k}" for k in range(10)}


def test_few_or_equal_pages_have_no_template(spark):
    few = [(100 + k, f"http://b.org/{k}", h) for k, _, h in site(3)]
    copies = [(200 + k, f"http://c.org/{k}", site(2)[1][2]) for k in range(20)]
    odd = [(300, None, "<p>x</p>"), (301, "http://d.org/", None), (302, "http://d.org/", ""), (None, "http://d.org/", "🙂"), (None, "http://d.org/", "🙂")]
    got = extract_main_text(pages(spark, few + copies + odd)).collect()
    assert len(got) == 28
    for r in got:
        assert r.template_blocks == 0
        if r.page_id and 100 <= r.page_id < 300:
            assert r.text.startswith("Subscribe") and r.text.endswith("reserved")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got if not r.page_id or r.page_id >= 300) == [
        ("300", "x", 1), ("301", "", 0), ("302", "", 0), ("None", "🙂", 1), ("None", "🙂", 1)]


def test_no_pages(spark):
    assert extract_main_text(pages(spark, [])).columns == ["page_id", "url", "text", "n_chars", "template_blocks"]
    assert extract_main_text(pages(spark, [])).count() == 0
