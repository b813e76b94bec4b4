"""From crawled pages to article records, and from articles to a topic dictionary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlemill.functions import html as H
from articlemill.functions.text import raw_tokens
from articlemill.operators.counts import top_words
from articlemill.operators.selectors import articles_by_rules, select_elements
from articlemill.schemas import DEFAULT_LABEL
from articlemill.sources.articles import article_record, decode_tolerant, good_articles
from articlemill.sources.tables import spread

# Where the parts of an article are in a page: (tag, attribute, value).
BODY = ("article", None, None)
TITLE = ("h1", None, None)
TIME = ("span", "id", "parent-fieldname-releaseDate")

# Selectors of the press-release site, and of its index pages' article links.
PRESS_RELEASE = {
    "time": "span[id=parent-fieldname-releaseDate]",
    "title": "h1[class=documentFirstHeading]",
    "content": "#parent-fieldname-text",
}
INDEX_LINKS = "dl a"


def articles_from_pages(
    pages: DataFrame,
    fetch_time: Column,
    body: tuple = BODY,
    title: tuple = TITLE,
    time: tuple = TIME,
    label: str = DEFAULT_LABEL,
) -> DataFrame:
    """Article records of pages `(url, html)`, all parts taken in one pass over a page.

    A page without a body element is no article and is left out; a missing title or
    time is an empty string.
    """
    # A generator stands between, so that page and body are cut out once, not again in the filter.
    once = F.explode(F.array(H.strip_noise(F.col("html")))).alias("_clean")
    clean = pages.select("*", once)
    found = clean.select("*", F.explode(F.array(H.outer_html(F.col("_clean"), *body))).alias("_body"))
    parts = found.filter(F.col("_body") != "").select(
        "url",
        fetch_time.alias("fetchTime"),
        H.element_text(F.col("_clean"), *time).alias("time"),
        H.element_text(F.col("_clean"), *title).alias("title"),
        H.element_text(F.col("_body"), *body).alias("content"),
        F.lit(label).alias("label"),
    )
    return parts.select(*article_record())


def articles_by_selectors(
    pages: DataFrame,
    keys: list[str],
    fetch_time: Column,
    rules: dict[str, str] | None = None,
    label: str = DEFAULT_LABEL,
) -> DataFrame:
    """Article records of pages `(keys, url, html)` whose parts only selectors can name."""
    found = articles_by_rules(pages, [*keys, "url"], "html", rules or PRESS_RELEASE)
    record = found.withColumn("fetchTime", fetch_time).withColumn("label", F.lit(label))
    return record.select(*article_record())


def index_links(pages: DataFrame, keys: list[str], selector: str = INDEX_LINKS) -> DataFrame:
    """Rows `(keys, pos, href)`: the article links of index pages, in order, not resolved."""
    links = select_elements(pages, keys, "html", [("link", selector)], ["attrs"])
    return links.select(*keys, "pos", F.coalesce(F.col("attrs")["href"], F.lit("")).alias("href"))


def topic_dictionary(
    files: DataFrame, n: int, stopwords: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """Top `n` words of article files `(path, value)`; files that do not decode are left out."""
    readable = files.filter(F.length("value") > 0)
    articles = good_articles(decode_tolerant(readable))
    return top_words(articles, raw_tokens(F.col("content")), n, stopwords)


def topic_dictionary_of_texts(
    docs: DataFrame,
    key: str,
    text: str,
    n: int,
    stopwords: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """The same for texts that are columns of a table."""
    texts = spread(docs.select(key, text), key).filter(F.length(text) > 0)
    return top_words(texts, raw_tokens(F.col(text)), n, stopwords)
