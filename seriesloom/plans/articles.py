"""Stored search pages and articles to new rows of the article table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.text import strip_illegal_control
from seriesloom.operators import pages
from seriesloom.operators.relational import fixed_index
from seriesloom.session import materialise
from seriesloom.sources import store

COLUMNS = ["date", "url", "press", "title", "section"]


def articles(listings: DataFrame, stored: DataFrame, publishers: Sequence[str] = pages.PUBLISHERS, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per listed article that has a body.

    The results of the search pages are looked up among the stored pages by address; the articles of
    the second publisher are read on the page their own page names as alternate. Articles of unknown
    publishers, without a stored page or without a body are left out. ``key`` is unique in ``stored``.
    """
    listed = fixed_index(pages.news_items(listings, [key], html), publishers, "press", "press_index")
    listed = materialise(listed.where("press_index is not null").withColumn("item", F.monotonically_increasing_id()).drop(key))
    fetched = materialise(pages.with_page(listed, "item", "url", stored, "html", key, url, html))
    alternate = fetched.where(F.col("press_index") == pages.ALTERNATE_PUBLISHER)
    followed = pages.follow_links(alternate, stored, "item", "html", key, url, html).select(*fetched.columns[:-1], F.col("alternate_html").alias("html"))
    chosen = materialise(fetched.where(F.col("press_index") != pages.ALTERNATE_PUBLISHER).unionByName(followed))
    bodies = pages.article_bodies(chosen, "html", pages.BODY_RULES, F.col("press_index"))
    # Stored before the filter, which would otherwise repeat every rule.
    bodies = materialise(bodies.withColumn("section", strip_illegal_control(F.col("section"))).select(*COLUMNS))
    return pages.with_body(bodies)


def collect_articles(spark: SparkSession, listings: DataFrame, stored: DataFrame, path: str, **options) -> None:
    """Append the articles that the table at ``path`` does not hold yet, by address."""
    store.append_new(spark, materialise(articles(listings, stored, **options)), path, "url")
