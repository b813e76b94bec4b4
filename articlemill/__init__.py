"""articlemill: mining web articles with Spark DataFrames."""

__version__ = "0.1.0"
