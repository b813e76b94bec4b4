from pyspark.sql import functions as F

from articlemill.functions import html as H
from articlemill.operators.selectors import PageTree, articles_by_rules, select_elements, steps_of
from articlemill.plans.articles import articles_from_pages

FULL = """<html><head><title>A &amp; B</title><script>var t="</p><h1>no</h1>";</script></head>
<body><!-- <h1>hidden</h1> --><dl><dt><a href="/one" class='x internal-link'>1</a></dt>
<dd><a class="internal-link" accesskey=2 href='/two'>2</a></dd></dl><a name="top">no target</a>
<h1 class="documentFirstHeading">The <b>head</b>line</h1>
<span id="parent-fieldname-releaseDate">11/11/15</span>
<div class="field-item even"><p>Direct<div><p>Nested</p></div></div>
<article id="a1"><p>One<b>bold</b><p>Two&nbsp;&lt;x&gt; &#8217;q&#8217;<br>Three</article>
<img src="a.png"><img src="b.jpg"></body></html>"""
BARE = "<p>nothing here"


def value(spark, column, html=FULL):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("v")).head()["v"]


def clean():
    return H.strip_noise(F.col("html"))


def test_parts(spark):
    assert value(spark, H.document_title(clean())) == "A & B"
    assert value(spark, H.element_text(clean(), "h1")) == "The headline"
    assert value(spark, H.element_text(clean(), "h1", "class", "documentFirstHeading")) == "The headline"
    time = H.element_text(clean(), "span", "id", "parent-fieldname-releaseDate")
    assert value(spark, time) == "11/11/15"
    assert value(spark, time, BARE) == ""
    assert value(spark, H.has_element(clean(), "h1"), BARE) is False


def test_text_and_entities(spark):
    text = value(spark, H.element_text(clean(), "article"))
    assert text == "Onebold Two <x> ’q’ Three"
    assert value(spark, H.decode_entities(F.lit("&amp;lt; &#38;amp; &#0;"))) == "&lt; &amp; �"
    assert value(spark, H.decode_entities(F.lit("&#x27;a&#X2019; &#xD800; &lt b&amp"))) == "'a’ � < b&"
    assert value(spark, H.decode_entities(F.lit("&amp;#39; &#128512;"))) == "&#39; 😀"


def test_paragraphs_left_open(spark):
    inner = H.paragraphs(H.inner_html(clean(), "article"))
    texts = value(spark, F.transform(inner, H.markup_text))
    assert texts == ["Onebold", "Two <x> ’q’ Three"]


def test_links_and_attributes(spark):
    assert value(spark, H.link_targets(clean())) == ["/one", "/two"]
    assert value(spark, H.link_targets(clean()), BARE) == []
    assert value(spark, H.link_targets(clean()), "<a href='/x?a=1&amp;b=2'>") == ["/x?a=1&b=2"]
    attrs = value(spark, F.transform(H.tags(clean(), "a"), H.attributes))
    assert attrs[1] == {"class": "internal-link", "accesskey": "2", "href": "/two"}
    assert value(spark, H.attributes(F.lit(' a="1" A=2 b=3'))) == {"a": "1", "b": "3"}
    assert value(spark, H.attributes(F.lit(' hidden a="x>1" data-q=\'"\' checked'))) == {"hidden": "", "a": "x>1", "data-q": '"', "checked": ""}
    assert value(spark, H.attribute(F.lit(' title="href=no"'), "href")) is None
    assert value(spark, H.attribute(F.lit(' data-href="x"'), "href")) is None
    assert value(spark, H.outer_html(clean(), "h1")).startswith("<h1 class=")


def test_articles_need_a_body(spark):
    pages = spark.createDataFrame([("/full", FULL), ("/bare", BARE)], "url string, html string")
    rows = articles_from_pages(pages, F.lit("now")).collect()
    assert [(r["url"], r["title"], r["time"], r["label"]) for r in rows] == [
        ("/full", "The headline", "11/11/15", "corruption")
    ]


def select(spark, selector, html=FULL):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = select_elements(pages, ["page_id"], "html", [("f", selector)]).orderBy("pos").collect()
    return rows


def test_selectors(spark):
    assert [r["attrs"]["href"] for r in select(spark, "dl a")] == ["/one", "/two"]
    assert [r["attrs"]["href"] for r in select(spark, "a[class$=internal-link]")] == ["/one", "/two"]
    assert [r["attrs"]["href"] for r in select(spark, "[accesskey=2]")] == ["/two"]
    assert len(select(spark, "a[href]")) == 2
    assert len(select(spark, "img[src$=.png]")) == 1
    assert [r["text"] for r in select(spark, "div[class^=field-item] > p")] == ["Direct"]
    assert [r["text"] for r in select(spark, "#a1 p")] == ["Onebold", "Two\u00a0<x> ’q’ Three"]
    assert [r["text"] for r in select(spark, "article p b")] == ["bold"]
    assert [r["tag"] for r in select(spark, "h1.documentFirstHeading")] == ["h1"]
    assert select(spark, "h1", BARE) == []
    assert select(spark, "title")[0]["text"] == "A & B"
    assert select(spark, "h1")[0]["markup"] == '<h1 class="documentFirstHeading">The <b>head</b>line</h1>'


def test_steps():
    assert steps_of("div[class^=a b] > p  b") == ["div[class^=a b]", ">", "p", "b"]


def test_broken_pages_are_read():
    for html in ["", "<", "<p", "</p></div>", "<b><p>x<table><tr><td>1<td>2", "a < b & c"]:
        PageTree(html)


def test_articles_by_rules(spark):
    pages = spark.createDataFrame(
        [(1, "/u", FULL), (2, "/u", FULL), (3, "/bare", BARE)], "page_id int, url string, html string"
    )
    rules = {"title": "h1", "time": "span[id=none]", "content": "article"}
    rows = articles_by_rules(pages, ["page_id", "url"], "html", rules).orderBy("page_id").collect()
    assert [(r["page_id"], r["title"], r["time"]) for r in rows] == [
        (1, "The headline", ""), (2, "The headline", ""),
    ]


# Both routes to the same text and links: markup inside an article, its text, its link targets.
BOTH_ROUTES = [
    ('<a title="a>b" href="/x">one</a>', "one", ["/x"]),
    ("<a title='say \"hi\" > there' href='/y?a=1&amp;b=2'>two</a>", "two", ["/y?a=1&b=2"]),
    ("caf&eacute; &pound;5 &hellip; &Auml;&ouml; &frac12;", "café £5 … Äö ½", []),
    ("&amp;lt; &amp;amp; &lt;b&gt; &AMP; &copy 2015 &notit; &nosuchname; &", "&lt; &amp; <b> & © 2015 ¬it; &nosuchname; &", []),
    ("&#65;&#x42;&#128;&#xD800; &#0;", "AB€\ufffd \ufffd", []),
    ("a\u00a0\u00a0b \t\n c&nbsp; d", "a\u00a0\u00a0b c\u00a0 d", []),
    ('<a href>none</a> <a href="">empty</a> <a HREF=/z>bare</a>', "none empty bare", ["", "", "/z"]),
    ("<p>One<p>Two<br/>Three <b>bo</b>ld", "One Two Three bold", []),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2", []),
]


def test_both_routes_agree(spark):
    rows = [(i, f"<html><body><article>{m}</article></body></html>") for i, (m, _, _) in enumerate(BOTH_ROUTES)]
    pages = spark.createDataFrame(rows, "page_id int, html string")
    native = pages.select(
        "page_id", H.element_text(clean(), "article").alias("text"), H.link_targets(H.inner_html(clean(), "article")).alias("links")
    ).orderBy("page_id").collect()
    texts = select_elements(pages, ["page_id"], "html", [("t", "article")], ["text"])
    by_selector = {r["page_id"]: r["text"] for r in texts.collect()}
    links = select_elements(pages, ["page_id"], "html", [("a", "article a[href]")], ["attrs"]).orderBy("page_id", "pos").collect()
    for r in native:
        _, text, targets = BOTH_ROUTES[r["page_id"]]
        assert (r["text"], r["links"]) == (text, targets)
        assert by_selector[r["page_id"]] == text
        assert [x["attrs"]["href"] for x in links if x["page_id"] == r["page_id"]] == targets


def test_rule_values_are_literal(spark):
    html = '<div id="axb">no</div><div id="a.b">yes</div>'
    assert value(spark, H.element_text(F.col("html"), "div", "id", "a.b"), html) == "yes"


def test_rule_articles_are_not_shuffled_after_parsing(spark):
    pages = spark.createDataFrame([(1, FULL)], "page_id int, html string")
    plan = articles_by_rules(pages, ["page_id"], "html", {"content": "article"})._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "Exchange" not in plan
