"""Main text: the shapes of the given pages, hostile markup, and site furniture."""

import re
from html import unescape

from pyspark.sql import functions as F

import lociframe.llm.style_tree as S
from lociframe.llm.style_tree import decisions, extract, extract_pages, importance

SF = "/root/testdata/sf0.01"


def article_only(page):
    """The given pages' text by their own simple rule: the article's blocks."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br)>", inner.replace("<b>", "").replace("</b>", ""))
    return " ".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)


def test_query_gives_the_articles(spark):
    import __spark_entry__ as E
    got = {r.page_id: r for r in E.queries()["op7_html"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        r = got[p.page_id]
        assert r.text == article_only(p.html) and r.url == p.url and r.n_chars == len(r.text)


class Everywhere(dict):
    """One importance for every doubtful branch."""

    def __init__(self, value):
        super().__init__({"": value})
        self.value = value

    def __contains__(self, path):
        return True

    def __getitem__(self, path):
        return self.value


def test_the_tree_decides_on_the_given_pages(spark):
    """Without the tree's decisions the adverts come back."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    told = {r.site: r for r in decisions(pages).collect()}
    assert any(r.doubt for r in told.values())
    without = [(p.html, extract(p.html)) for p in pages.collect()]
    changed = [t for h, t in without if t != article_only(h)]
    assert len(changed) > len(without) // 4


def test_markup():
    unknown = Everywhere(S.UNKNOWN)
    e = lambda h: extract(h, doubt=unknown)
    assert e("") == "" and e("plain &amp; simple") == "plain & simple"
    assert e("<p>a<b>b</b>c<p>d<br>e") == "abc d e"
    assert e("<script>var t='<p>no</p>';</script><p>yes</p><style>p{}") == "yes"
    assert e("<!-- <p>no</p> --><p>x &lt;b&gt; &#233;&nbsp;y</p><!-- open <p>no") == "x <b> é y"
    assert e("<div class='comments'><p>no</p></div><form><p>no</p></form><aside>no</aside><main>yes</main><footer>no</footer>") == "yes"
    assert e("<div class=\"cookie-notice\">no</div><article><header><h1>T</h1></header><p>x</p><div id=comment-list>no</div></article>") == "T x"
    assert e("<header>no</header><nav>no<ul><li>no</nav><p>a > b < c</p>") == "a > b < c"
    assert e("<p hidden>no</p><div style='display: none'>no</div><div title='a > b'>yes</div>") == "yes"
    assert e("<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>") == "one two 1 2 3"
    assert e("<title>no</title><textarea><p>no</textarea>x</bad></p>y") == "x y" or e("x</bad>y") == "xy"


def test_deep_and_long_pages():
    assert extract("<div>" * 5000 + "x" + "</div>" * 5000, ()) == "x"
    assert len(extract("<p>word</p>" * 50_000, ())) == 5 * 50_000 - 1
    assert extract("<" * 20_000, ()) == "<" * 20_000
    deep = "<span>" * 450 + "<article>Main text here.</article><nav>MENU</nav><form>FORM</form><div class=\"comments\">reader</div>"
    assert extract(deep, doubt=Everywhere(S.UNKNOWN)) == "Main text here."
    deep = "<div>" * 3000 + "<article>Main.</article><nav>MENU</nav><aside>no</aside>" + "</div>" * 2999 + "<p>end</p><footer>no</footer>"
    assert extract(deep) == "Main. end"


def test_a_class_word_alone_drops_nothing(spark):
    pages = [(i, f"http://a.example/{i}", f"<body><p>Line {i} of {i * 7}.</p><div class=related><p>Tale {i * 13}.</p></div></body>") for i in range(30)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[4] == "Line 4 of 28. Tale 52."       # as diverse as the text beside it
    pages = [(i, u, h.replace(f"Tale {i * 13}", "Tale")) for i, u, h in pages]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[4] == "Line 4 of 28."


def test_clashing_columns(spark):
    df = site(spark)
    more = df.withColumns({c: F.lit("clash") for c in ("host", "site", "cut", "doubt", "repeated", "path", "a.b")})
    assert sorted(map(tuple, extract_pages(more).collect())) == sorted(map(tuple, extract_pages(df).collect()))


def site(spark, n=30):
    page = "<body><div><div class='top x1'>Welcome to our site {k}</div><div class=story>{text}</div><div class=end>All rights</div></div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(k=i % 2, text=f"Story {i} tells something {i * 7}.")) for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_site_furniture_is_cut(spark):
    df = site(spark)
    got = {r.page_id: r.text for r in extract_pages(df.withColumn("text", F.lit("clash"))).collect()}
    assert got == {i: f"Story {i} tells something {i * 7}." for i in range(30)}
    tree = {r.path.split(">")[-1]: r.importance for r in importance(df).collect()}
    assert tree["div.end"] == 0 and tree["div.top.x0"] < 0.3 and tree["div.story"] == 1


def test_copies_of_one_page_are_not_furniture(spark):
    one = site(spark, 1)
    df = one
    for i in range(1, 8):
        df = df.unionByName(one.withColumn("page_id", F.lit(i).cast("long")))
    assert {r.text for r in extract_pages(df).collect()} == {"Welcome to our site 0 Story 0 tells something 0. All rights"}


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (None, "x", "<p>a</p>")], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in extract_pages(df).collect()) == [(0, "a", 1), (1, "", 0), (1, "", 0)]
    assert extract_pages(df.limit(0)).count() == 0


def test_article_furniture_and_doubtful_branches(spark):
    menu = "<ul><li>Home</li><li>Sports</li></ul>"
    article = "<body><article>{menu}<p>Please read our terms.</p><p>Story {i} tells of {k}.</p><p>Then {k} ended.</p></article><div class=ad>Buy {k}</div></body>"
    wrapped = "<body><div class=related-wrap><p>Please read our terms.</p><p>Tale {i} of {k}.</p></div><div class=sidebar><p>Links</p></div></body>"
    holding = "<body><div class=widget-area><main><p>Note {i} of {k}.</p></main></div></body>"
    crowded = "<body><div>" + "".join(f"<p>Rule {c}</p>" for c in "abcdefghij") + "<p>Unique {i} of {k}.</p></div></body>"
    rows = [(100 * j + i, f"http://{j}.example/{i}", page.format(menu=menu, i=i, k=i * 7))
            for j, page in enumerate([article, wrapped, holding, crowded]) for i in range(30)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(30):
        assert got[i] == f"Story {i} tells of {i * 7}. Then {i * 7} ended."
        assert got[100 + i] == f"Tale {i} of {i * 7}."
        assert got[200 + i] == f"Note {i} of {i * 7}."
        assert got[300 + i] == f"Unique {i} of {i * 7}."


def test_repeated_prose_in_few_articles_stays(spark):
    rows = [(i, f"http://a.example/{i}", f"<article><h2>{'Summary' if i < 4 else f'Part {i}'}</h2><p>{'Quote.' if i < 3 else f'Text {i}.'}</p></article>"
             + "<p>x</p>" * (i % 2)) for i in range(30)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0].startswith("Summary Quote.") and got[20] == "Part 20 Text 20."


def test_doubtful_inline_text_stays_in_its_block():
    page = "<p>See <span class=related>other</span> things</p>"
    assert extract(page) == "See other things"
    assert extract(page, doubt={">p>span.related!": 0.5}) == "See things"
    assert extract(page, doubt={">p>span.related!": 0.9}) == "See other things"


def test_few_pages_are_held_at_a_time():
    import pyarrow as pa

    pages = [f"<html><body><div class=x{i % 7}><p>text {i}</p><p>of page {i}</p></div></body></html>" for i in range(1500)]
    hosts = [f"h{i % 3}" for i in range(len(pages))]
    made = list(S.feature_rows([pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(pages)], names=["host", "html"])]))
    rows = {tuple(r.values()) for b in made for r in b.to_pylist()}
    assert len({r[1] for r in rows}) == len(pages)
    assert max(len(set(b.column("page").to_pylist())) for b in made) <= S.PAGES

    n, cut = len(pages), pa.array([["no path"]] * len(pages), pa.list_(pa.string()))
    doubt = pa.nulls(n, pa.list_(pa.struct([("path", pa.string()), ("value", pa.float64())])))
    repeated = pa.array([[S.hashed(f"{x}\nof page {i}") for x in [">html>body>div.x0>p"]] if h == "h1" else None for i, h in enumerate(hosts)],
                        pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(hosts), pa.array(pages), pa.array(hosts), cut, doubt, repeated],
                                       names=["page_id", "url", "html", "host", "cut", "doubt", "repeated"])
    out = list(S.main_texts([batch]))
    assert max(b.num_rows for b in out) <= S.PAGES
    got = [(r["page_id"], r["text"], r["n_chars"]) for b in out for r in b.to_pylist()]
    # a site's decisions are those of its first row in the batch: h1 repeats the second block of page 1
    want = [f"text {i}" if i == 1 else f"text {i} of page {i}" for i in range(n)]
    assert got == [(i, t, len(t)) for i, t in enumerate(want)]
