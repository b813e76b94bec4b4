"""From index pages to a dictionary file, through article files, as one run."""

from pyspark.sql import functions as F

from articlemill.functions.stopwords import SHORT_STOPWORDS
from articlemill.plans.articles import (
    articles_by_selectors, index_links, topic_dictionary, topic_dictionary_of_texts,
)
from articlemill.sources.articles import read_article_files, write_articles_json
from articlemill.sources.textfiles import read_dictionary, write_dictionary

INDEX = '<a href="/home">Home</a><dl><dt><a href="/1">1</a></dt><dd><a href="/2">2</a></dd></dl>'
ARTICLE = """<h1 class="documentFirstHeading">Mayor {0}</h1>
<span id="parent-fieldname-releaseDate">11/1{0}/15</span>
<div id="parent-fieldname-text"><div><p>The bribe {0}.</p><p>A bribe and fraud</p></div></div>"""


def test_crawled_pages_to_dictionary(spark, tmp_path):
    index = spark.createDataFrame([(0, INDEX)], "page_id int, html string")
    links = index_links(index, ["page_id"]).orderBy("pos").collect()
    assert [(r["pos"], r["href"]) for r in links] == [(0, "/1"), (1, "/2")]

    rows = [(i, f"/{i}", ARTICLE.format(i)) for i in (1, 2)] + [(3, "/3", "<p>gone</p>")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    articles = articles_by_selectors(pages, ["page_id"], F.lit("now"))
    assert sorted(tuple(r) for r in articles.collect()) == [
        (f"/{i}", "now", f"11/1{i}/15", f"Mayor {i}", f"The bribe {i}. A bribe and fraud", "corruption")
        for i in (1, 2)
    ]

    write_articles_json(articles, str(tmp_path / "articles"), one_per_file=True)
    files = read_article_files(spark, str(tmp_path / "articles"))
    dictionary = topic_dictionary(files, 10, SHORT_STOPWORDS)
    write_dictionary(dictionary, str(tmp_path / "dictionary"), 1000)
    back = read_dictionary(spark, str(tmp_path / "dictionary")).orderBy(F.desc("cnt"), "word")
    assert [tuple(r) for r in back.collect()] == [("bribe", 4), ("fraud", 2)]

    same = topic_dictionary_of_texts(articles, "url", "content", 10, SHORT_STOPWORDS)
    assert sorted(same.collect()) == sorted(back.collect())
