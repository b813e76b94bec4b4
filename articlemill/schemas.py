"""Schemas of the records that articlemill reads and writes."""

from pyspark.sql import types as T

# The two labels, and the fields of an article.
DEFAULT_LABEL = "corruption"
NEGATIVE_LABEL = "noncorruption"

ARTICLE_FIELDS = ["url", "fetchTime", "time", "title", "content", "label"]

ARTICLE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ARTICLE_FIELDS])

CORRUPT_COLUMN = "_corrupt"

SELECTED_SCHEMA = "field string, pos int, tag string, text string, markup string, attrs map<string,string>"
