"""Raw API-style records to the columns of the posts and comments tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.dates import from_epoch


def _author(name: str, null_as: str | None) -> Column:
    author = F.col(name).cast("string")
    return (author if null_as is None else F.coalesce(author, F.lit(null_as))).alias("author")


def project_posts(raw: DataFrame, author_null_as: str | None = None) -> DataFrame:
    """Ten columns of a post; ``created_utc`` comes as epoch seconds, the body as
    ``selftext``. A deleted author stays NULL unless a stand-in is given."""
    return raw.select(
        F.col("id").cast("string").alias("id"), "title", F.col("selftext").alias("text"),
        F.col("score").cast("long").alias("score"),
        from_epoch(F.col("created_utc")).alias("created_utc"), _author("author", author_null_as),
        F.col("num_comments").cast("long").alias("num_comments"), "url",
        F.col("subreddit").cast("string").alias("subreddit"),
        F.col("upvote_ratio").cast("double").alias("upvote_ratio"))


def is_root(parent_id: Column) -> Column:
    return parent_id.startswith("t3_")


def project_comments(raw: DataFrame, author_null_as: str | None = None) -> DataFrame:
    """Eight columns of a comment; the body comes as ``body``."""
    return raw.select(
        F.col("id").cast("string").alias("id"), F.col("body").alias("text"),
        F.col("score").cast("long").alias("score"),
        from_epoch(F.col("created_utc")).alias("created_utc"), _author("author", author_null_as),
        F.col("submission_id").cast("string").alias("submission_id"), "parent_id",
        is_root(F.col("parent_id")).alias("is_root"))
