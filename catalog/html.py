"""Extraction from the table of crawled pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from articlemill.functions import html as H
from articlemill.functions import text as X
from articlemill.operators.selectors import articles_by_rules, select_elements
from articlemill.plans.articles import articles_from_pages as build_articles
from articlemill.schemas import DEFAULT_LABEL
from articlemill.sources.articles import article_json
from articlemill.sources.docstore import render_header
from articlemill.sources.tables import read_table, spread

FETCH_TIME = "Wed Nov 11 00:00:00 UTC 2015"
SELECTORS = [
    ("body", "article"),
    ("heading", "article > h1"),
    ("ad", "div[class^=ad]"),
    ("footer", "body footer"),
]


def pages(spark, sf):
    """Pages with the markup that cannot mislead a pattern taken out."""
    table = spread(read_table(spark, sf, "pages"), "page_id")
    return table.withColumn("clean", H.strip_noise(F.col("html")))


def page_title(spark, sf):
    clean = F.col("clean")
    return pages(spark, sf).select(
        "page_id",
        H.document_title(clean).alias("title"),
        H.element_text(clean, "h1").alias("heading"),
    )


def page_body_text(spark, sf):
    body = pages(spark, sf).filter(H.has_element(F.col("clean"), "article"))
    return body.select("page_id", H.element_text(F.col("clean"), "article").alias("body"))


def release_time(spark, sf):
    time = H.element_text(F.col("clean"), "span", "id", "parent-fieldname-releaseDate")
    return pages(spark, sf).select("page_id", time.alias("time"))


def links(spark, sf, markup):
    targets = F.posexplode(H.link_targets(markup)).alias("pos", "href")
    return pages(spark, sf).select("page_id", targets)


def page_links(spark, sf):
    return links(spark, sf, H.inner_html(F.col("clean"), "nav"))


def page_link_stats(spark, sf):
    targets = pages(spark, sf).select("page_id", H.link_targets(F.col("clean")).alias("t"))
    return targets.select(
        "page_id", F.size("t").alias("n_links"), F.get("t", F.lit(0)).alias("first_href")
    )


def links_by_suffix(spark, sf):
    return links(spark, sf, F.col("clean")).filter(F.col("href").endswith("e"))


def links_by_attr(spark, sf):
    divs = F.posexplode(H.tags(F.col("clean"), "div")).alias("pos", "tag")
    attrs = pages(spark, sf).select("page_id", divs).withColumn("attrs", H.attributes(F.col("tag")))
    return attrs.filter(F.col("attrs")["class"] == "ad").select(
        "page_id", "pos", F.size("attrs").alias("n_attrs")
    )


def page_paragraphs(spark, sf):
    body = H.paragraphs(H.inner_html(F.col("clean"), "article"))
    found = pages(spark, sf).select("page_id", F.posexplode(body).alias("pos", "markup"))
    return found.select("page_id", "pos", H.markup_text(F.col("markup")).alias("text"))


def page_body_markup(spark, sf):
    clean = F.col("clean")
    attrs = H.attributes(F.regexp_extract(clean, H.element_pattern("div"), 1))
    return pages(spark, sf).select(
        "page_id",
        H.outer_html(clean, "article").alias("outer_html"),
        H.inner_html(clean, "article").alias("inner_html"),
        attrs["class"].alias("div_class"),
    )


def body_edges(spark, sf):
    body = page_body_text(spark, sf)
    return body.select(
        "page_id",
        F.length("body").cast("bigint").alias("n"),
        X.first_chars(F.col("body"), 10).alias("first_chars"),
        X.last_chars_reversed(F.col("body"), 5).alias("last_chars"),
    )


def articles_from_pages(spark, sf):
    table = spread(read_table(spark, sf, "pages").select("page_id", "url", "html"), "page_id")
    return build_articles(table, F.lit(FETCH_TIME))


def render_title(spark, sf):
    articles = articles_from_pages(spark, sf)
    return articles.select("url", render_header(F.col("title")).alias("header"))


def article_to_json(spark, sf):
    return articles_from_pages(spark, sf).select("url", article_json().alias("json"))


def selected_elements(spark, sf):
    table = spread(read_table(spark, sf, "pages"), "page_id")
    found = select_elements(table, ["page_id"], "html", SELECTORS)
    return found.select("page_id", "field", "pos", "tag", "text")


def rule_articles(spark, sf):
    table = spread(read_table(spark, sf, "pages"), "page_id")
    rules = {
        "time": "span[id=parent-fieldname-releaseDate]",
        "title": "article h1",
        "content": "article",
    }
    return articles_by_rules(table, ["page_id", "url"], "html", rules).drop("page_id")


QUERIES = {
    f.__name__: f
    for f in [
        page_title, page_body_text, release_time, page_links, page_link_stats, links_by_suffix,
        links_by_attr, page_paragraphs, page_body_markup, body_edges, articles_from_pages,
        render_title, article_to_json, selected_elements, rule_articles,
    ]
}


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def visible(markup: str) -> str:
    flat = f"regexp_replace({markup}, {quoted(INLINE)}, '', 'g')"
    flat = f"regexp_replace({flat}, {quoted(TAGS)}, ' ', 'g')"
    return f"trim(regexp_replace({decoded(flat)}, '[ \\t\\r\\n]+', ' ', 'g'), ' ')"


#: The references that the test pages hold, the ampersand last.
REFERENCES = [
    ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&apos;", "'"), ("&nbsp;?", "\u00a0"), ("&copy;?", "©"), ("&middot;?", "·"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&rsquo;", "’"), ("&hellip;", "…"), ("&#39;", "'"), ("&amp;?", "&"),
]
TAGS = "</?[A-Za-z!][^>]*>"
INLINE = "(?i)</?(a|abbr|b|cite|code|em|font|i|mark|q|s|small|span|strong|sub|sup|u)( [^>]*)?>"
COMMENTS = "(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"


def element(tag: str) -> str:
    return f"(?is)<{tag}( [^>]*)?>(.*?)</{tag}>"


def decoded(text: str) -> str:
    for pattern, char in REFERENCES:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(char)}, 'g')"
    return text


def inside(tag: str, group: int = 2) -> str:
    return f"regexp_extract(clean, {quoted(element(tag))}, {group})"


def targets(markup: str) -> str:
    opening = "(?is)<a((?:[ \\t\\r\\n][^>]*)?)>"
    href = "(?is)(?:^|[ \\t\\r\\n])href[ \\t\\r\\n]*=[ \\t\\r\\n]*(\"[^\"]*\"|'[^']*'|[^ \\t\\r\\n\"'>]+)"
    value = f"regexp_extract(t, {quoted(href)}, 1)"
    bare = f"""regexp_replace({value}, '^["'']|["'']$', '', 'g')"""
    return f"""[{decoded(bare)}
        FOR t IN regexp_extract_all({markup}, {quoted(opening)}, 1) IF {value} <> '']"""


def oracles() -> dict[str, str]:
    cleaned = f"""(SELECT page_id, url, html,
        regexp_replace(html, {quoted(COMMENTS)}, '', 'g') AS clean FROM pages)"""
    has_body = f"regexp_matches(clean, {quoted(element('article'))})"

    def links_sql(markup):
        return f"""SELECT page_id, CAST(unnest(range(len(a))) AS INTEGER) AS pos, unnest(a) AS href
            FROM (SELECT page_id, {targets(markup)} AS a FROM {cleaned}) AS found"""

    body = f"SELECT page_id, {visible(inside('article'))} AS body FROM {cleaned} WHERE {has_body}"
    articles = f"""SELECT url, '{FETCH_TIME}' AS "fetchTime", '' AS time,
        {visible(inside('h1'))} AS title, {visible(inside('article'))} AS content,
        '{DEFAULT_LABEL}' AS label FROM {cleaned} WHERE {has_body}"""
    span = '(?is)<span( [^>]*)?id="parent-fieldname-releaseDate"[^>]*>(.*?)</span>'
    time = f"regexp_extract(clean, {quoted(span)}, 2)"
    opened = "(?i)<p(?:[ \\t\\r\\n][^>]*)?>"
    closed = "(?is)</p[ \\t\\r\\n]*>.*"
    fields = {"body": "article", "heading": "h1", "ad": "div", "footer": "footer"}
    return {
        "page_title": f"""SELECT page_id, {visible(inside('title'))} AS title,
            {visible(inside('h1'))} AS heading FROM {cleaned}""",
        "page_body_text": body,
        "release_time": f"SELECT page_id, {visible(time)} AS time FROM {cleaned}",
        "page_links": links_sql(inside("nav")),
        "page_link_stats": f"""SELECT page_id, CAST(len(a) AS INTEGER) AS n_links, a[1] AS first_href
            FROM (SELECT page_id, {targets('clean')} AS a FROM {cleaned}) AS found""",
        "links_by_suffix": f"SELECT * FROM ({links_sql('clean')}) WHERE suffix(href, 'e')",
        "links_by_attr": f"""SELECT page_id, pos,
            CAST(len(regexp_extract_all(tag, '[a-z-]+="')) AS INTEGER) AS n_attrs FROM (
            SELECT page_id, CAST(unnest(range(len(a))) AS INTEGER) AS pos, unnest(a) AS tag
            FROM (SELECT page_id, regexp_extract_all(clean, '<div([^>]*)>', 1) AS a
                  FROM {cleaned}) AS t1) AS t2
            WHERE tag = ' class="ad"'""",
        "page_paragraphs": f"""SELECT page_id, pos, {visible('markup')} AS text FROM (
            SELECT page_id, CAST(unnest(range(len(a))) AS INTEGER) AS pos,
              regexp_replace(unnest(a), '{closed}', '') AS markup
            FROM (SELECT page_id, string_split_regex({inside('article')}, '{opened}')[2:] AS a
                  FROM {cleaned}) AS t1) AS t2""",
        "page_body_markup": f"""SELECT page_id, {inside('article', 0)} AS outer_html,
            {inside('article')} AS inner_html,
            nullif(regexp_extract(clean, '<div class="([^"]*)"', 1), '') AS div_class
            FROM {cleaned}""",
        "body_edges": f"""SELECT page_id, length(body) AS n, left(body, 10) AS first_chars,
            reverse(right(body, 5)) AS last_chars FROM ({body})""",
        "articles_from_pages": articles,
        "render_title": f"SELECT url, '<h1>' || title || '</h1>' AS header FROM ({articles})",
        "article_to_json": f"""SELECT url, CAST(to_json(struct_pack(url := url,
            "fetchTime" := "fetchTime", time := time, title := title, content := content,
            label := label)) AS VARCHAR) AS json FROM ({articles})""",
        "selected_elements": " UNION ALL ".join(
            f"""SELECT page_id, '{field}' AS field, CAST(0 AS INTEGER) AS pos, '{tag}' AS tag,
            {visible(inside(tag))} AS text FROM {cleaned}"""
            for field, tag in fields.items()
        ),
        "rule_articles": f"SELECT url, time, title, content FROM ({articles})",
    }
