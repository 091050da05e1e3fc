from fareflow.llm import html_main as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header class="site">Site</header><nav><ul><li><a>Menu</a></li></ul></nav><div class="ad">Buy</div>
<!-- c --><article><h1>Head &amp; line</h1><p><b>One
 two&nbsp;three.<br><p>Four &lt;x&gt; <i>fi</i>ve</p><form>Name</form><aside>side</aside>
<div id="comments"><p>nice post</p></div><script>x</script></article>
<div class="cookie-notice">We use</div><footer>&copy; foot</footer></body></html>"""


def run(spark, rows):
    df = spark.createDataFrame([(*r, "t", 1) for r in rows],
                               "page_id long, url string, html string, text string, h int")
    return {r.page_id: r for r in H.main_text(df).collect()}


def test_article_only(spark):
    got = run(spark, [(1, "http://a.b/1", PAGE)])[1]
    assert got.text == "Head & line\nOne two three.\nFour <x> five"
    assert got.n_chars == len(got.text)


def test_defined_cases(spark):
    got = run(spark, [(1, None, None), (2, "x", ""), (3, "http://h/", "plain &amp; text"),
                      (4, "http://h/", "<p>a<p>b</div></p>c<script>never closed"),
                      (5, "http://h/", "<table><tr><td>a<td>b</table><ul><li>x<li>y</ul>"),
                      (6, "http://h/", "<div>" * 3000 + "deep" + "</div>" * 3000),
                      (7, "http://h/", "a < b <3 &#x41;&bogus; <!-- open")])
    assert got[1].text == "" and got[2].text == ""
    assert got[3].text == "plain & text"
    assert got[4].text == "a\nb\nc"
    assert got[5].text == "a\nb\nx\ny"
    assert got[6].text == "deep"
    assert got[7].text == "a < b <3 A&bogus;"


def test_template_without_marked_main(spark):
    rows = [(i, "http://s.t/%d" % i, f"<div><b>Our site</b></div><div><p>story {i} words</p></div>"
             "<div>Call us</div>") for i in range(8)]
    rows += [(100, "http://other/1", "<div>Call us</div><p>own</p>")]
    got = run(spark, rows)
    assert all(got[i].text == f"story {i} words" and got[i].n_template == 2 for i in range(8))
    assert got[100].text == "Call us\nown"


def test_copied_articles_are_no_template(spark):
    page = "<nav>m</nav><article><h1>t</h1><p>same words</p></article>"
    rows = [(i, "http://s.t/%d" % i, page) for i in range(20)]
    rows += [(100 + i, "http://s.t/x", f"<nav>m</nav><article><p>n {i}</p><div><a>more</a></div>"
              "<p>Released under the MIT License.</p></article>") for i in range(20)]
    got = run(spark, rows)
    assert all(got[i].text == "t\nsame words" for i in range(20))
    assert got[105].text == "n 5\nReleased under the MIT License."


def test_copies_do_not_raise_the_share(spark):
    page = "<div><b>Our site</b></div><div><p>story %d words</p></div><div>Call us</div>"
    rows = [(i, f"http://s.t/{i}", page % i) for i in range(10)]
    rows += [(100 + i, "http://s.t/c", page % 0) for i in range(6000)]
    got = run(spark, rows)
    assert got[3].text == "story 3 words" and got[5000].text == "story 0 words"


def test_a_fixed_page_count_decides_on_large_hosts(spark):
    rows = [(i, f"http://s.t/{i}", f"<div><p>story {i} words</p></div>"
             + ("<div>Section menu</div>" if i < 120 else "")) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in H.main_text(df, min_share=0.5).collect()}
    assert got[3].text == "story 3 words" and got[3].n_template == 1


def test_recurring_prose_containers_inside_an_article_go(spark):
    more = "<section class='x'><h2>More</h2><p>Read our other stories.</p></section>"
    long = "long story of many words that goes on and on for a while, number"
    rows = [(i, f"http://s.t/{i}", f"<main><h1>t{i}</h1><p>{long} {i}.</p>{more}</main>")
            for i in range(8)]
    # The same body under different titles, links and notices is an article, no template.
    rows += [(100 + i, f"http://b.c/{i}", f"<article><h1>title {i}</h1><div><p>{long} same.</p></div>"
              f"<div><a>link {i}</a></div><div><p>advert {i}</p></div></article>") for i in range(8)]
    got = run(spark, rows)
    assert all(got[i].text == f"t{i}\n{long} {i}." for i in range(8))
    assert all(f"{long} same." in got[100 + i].text for i in range(8))


def test_article_nested_in_main(spark):
    long = "long story of many words that goes on and on for a while."
    got = run(spark, [
        (1, "http://a/1", f"<main><p>Beside it.</p><article><h1>t</h1><p>{long}</p></article></main>"),
        (2, "http://a/2", f"<main><p>{long}</p><article><p>Teaser.</p></article></main>")])
    assert got[1].text == f"t\n{long}"
    assert got[2].text == f"{long}\nTeaser."


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_few_pages_are_held_at_once(spark):
    import pyarrow as pa
    n = 3 * H.PAGES_PER_STEP + 1
    html = [f"<main><p>t {i}</p><div><p>x</p></div></main>" for i in range(n)]
    keys = pa.array(range(n), pa.int64())
    texts = pa.array(["u"] * n)
    parsed = [b.num_rows for b in H._parse_pages(iter([pa.RecordBatch.from_arrays(
        [keys, texts, keys, pa.array(html)], names=["page_id", "url", "row_key", "html"])]))]
    marked = [b.num_rows for b in H._mark_pages(iter([pa.RecordBatch.from_arrays(
        [texts, keys, pa.array(html)], names=["host", "row_key", "html"])]))]
    assert parsed == marked == [H.PAGES_PER_STEP] * 3 + [1]


def test_texts_are_parsed_once(spark, capsys):
    df = spark.createDataFrame([(1, "http://a/1", "<p>x</p>")], "page_id long, url string, html string")
    H.main_text(df).explain()
    # Beside the hashes' own pass, which is kept, one pass over the pages.
    assert capsys.readouterr().out.count("_parse_pages") == 1
