"""Search, then store the posts found and their first comments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.search import DEFAULT_LIMIT, DEFAULT_SORT, DEFAULT_TIME_FILTER, keyword_search
from threadlens.operators.threads import top_comments_per_post
from threadlens.scale import cut_lineage
from threadlens.schemas import COMMENTS_RAW, POSTS_RAW
from threadlens.sources.upsert import StoreResult, store_batch


@dataclass(frozen=True)
class IngestResult:
    """``posts`` and ``comments`` merge the rows found into the stored tables when asked for."""

    stored_posts: StoreResult
    stored_comments: StoreResult | None
    comments_before: DataFrame
    counts: DataFrame

    @property
    def posts(self) -> DataFrame:
        return self.stored_posts.table

    @property
    def comments(self) -> DataFrame:
        return self.stored_comments.table if self.stored_comments else self.comments_before


def ingest(source_posts: DataFrame, source_comments: DataFrame, stored_posts: DataFrame,
           stored_comments: DataFrame, keywords: str | Sequence[str],
           groups: str | Sequence[str] | None, limit: int | None = DEFAULT_LIMIT,
           time_filter: str | None = DEFAULT_TIME_FILTER, include_comments: bool = True,
           comment_limit: int | None = None, as_of=None, run_ts=None,
           sort: str = DEFAULT_SORT) -> IngestResult:
    """New versions of both stored tables, and how many rows were stored.

    What is found is computed once and kept; the counts read only that.
    """
    found = keyword_search(source_posts, keywords, groups, time_filter=time_filter, limit=limit,
                           sort=sort, as_of=as_of)
    found = cut_lineage(found.select(*POSTS_RAW.fieldNames()))
    posts = store_batch(stored_posts, found, "submission", run_ts=run_ts)
    counts = posts.counts.select(F.col("success").alias("submissions_stored"))
    if not include_comments:
        return IngestResult(posts, None, stored_comments,
                            counts.withColumn("comments_stored", F.lit(0).cast("long")))
    replies = top_comments_per_post(source_comments, found, comment_limit)
    replies = cut_lineage(replies.select(*COMMENTS_RAW.fieldNames()))
    comments = store_batch(stored_comments, replies, "comment", posts=found, run_ts=run_ts)
    stored = comments.counts.select(F.col("success").alias("comments_stored"))
    both = counts.select("submissions_stored", F.lit(None).cast("long").alias("comments_stored"))
    both = both.unionByName(stored.select(F.lit(None).cast("long").alias("submissions_stored"),
                                          "comments_stored"))
    return IngestResult(posts, comments, stored_comments,
                        both.agg(F.max("submissions_stored").alias("submissions_stored"),
                                 F.max("comments_stored").alias("comments_stored")))
