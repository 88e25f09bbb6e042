"""Analysis of a topic: search, clean, normalise, score twice, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.cleaning import CleanOptions
from threadlens.functions.dates import run_stamp
from threadlens.functions.keywords import as_list
from threadlens.operators.clean import clean_batch
from threadlens.operators.compare import agreement_summary, compare_scored, disagreements
from threadlens.operators.model import ScorerFactory, score_model_batch
from threadlens.operators.normalize import normalize_batch
from threadlens.operators.rules import score_rules_batch
from threadlens.operators.search import DEFAULT_LIMIT, DEFAULT_SORT, DEFAULT_TIME_FILTER, Keywords, keyword_search
from threadlens.operators.threads import top_comments_per_post
from threadlens.scale import cut_lineage
from threadlens.sources.tables import scores_as_json


def score_items(items: DataFrame, item_type: str, make_scorer: ScorerFactory,
                *, lexicon: Mapping[str, float] | DataFrame,
                clean_options: CleanOptions = CleanOptions(), normalize_options: dict | None = None,
                max_length: int | None = None, batch_size: int = 8, model_name: str = "model",
                run_ts=None) -> DataFrame:
    """Clean, normalise and score rows with both methods in one pass.

    Both results stay in the row they belong to, so nothing is shuffled and the two
    need no join afterwards. The text as collected is kept in ``*_raw`` columns.
    """
    names = ("title", "text") if item_type == "submission" else ("text",)
    kept = items.withColumns({f"{name}_raw": F.col(name) for name in names})
    ready = normalize_batch(clean_batch(kept, item_type, clean_options), item_type,
                            **(normalize_options or {}))
    ruled = score_rules_batch(ready, item_type, lexicon=lexicon, run_ts=run_ts, prefix="rules_")
    return score_model_batch(ruled, item_type, make_scorer, max_length=max_length,
                             batch_size=batch_size, model_name=model_name, run_ts=run_ts,
                             prefix="model_")


def run_metadata(keywords: Sequence[str] | None, groups: Sequence[str], posts: DataFrame,
                 comments: DataFrame | None, run_ts=None) -> DataFrame:
    """One row about a run: what was asked (NULL for a table of phrases), when, and how much was found."""
    kinds = posts.select(F.lit("submission").alias("kind"))
    if comments is not None:
        kinds = kinds.unionAll(comments.select(F.lit("comment").alias("kind")))
    counted = kinds.agg(F.count_if(F.col("kind") == "submission").alias("submission_count"),
                        F.count_if(F.col("kind") == "comment").alias("comment_count"))
    asked = lambda values: (F.lit(None) if values is None else F.array(*[F.lit(v) for v in values])).cast("array<string>")
    nothing = F.when(F.col("submission_count") == 0, F.lit("No submissions found"))
    return counted.select(asked(keywords).alias("keywords"), asked(groups).alias("subreddits"),
                          run_stamp(run_ts).alias("timestamp"), "submission_count",
                          "comment_count", nothing.alias("error"))


@dataclass(frozen=True)
class TopicAnalysis:
    posts: DataFrame
    comments: DataFrame | None
    metadata: DataFrame

    def comparison(self) -> DataFrame:
        both = compare_scored(self.posts, "submission")
        if self.comments is not None:
            both = both.unionByName(compare_scored(self.comments, "comment"))
        return both

    def summary(self) -> DataFrame:
        return agreement_summary(self.comparison())

    def disagreements(self, examples: int | None = 5) -> DataFrame:
        return disagreements(self.comparison(), examples)

    def write(self, path: str) -> None:
        """Results as JSON lines, the comparison as CSV with a header."""
        self.metadata.write.json(f"{path}/metadata")
        self.posts.write.json(f"{path}/submissions")
        if self.comments is not None:
            self.comments.write.json(f"{path}/comments")
        scores_as_json(self.comparison()).write.option("header", True).option("escape", '"').csv(
            f"{path}/comparison")


def analyze_topic(posts: DataFrame, comments: DataFrame | None, keywords: Keywords,
                  groups: str | Sequence[str] | None, make_scorer: ScorerFactory,
                  limit: int | None = DEFAULT_LIMIT, include_comments: bool = True,
                  comment_limit: int | None = 50, time_filter: str | None = DEFAULT_TIME_FILTER,
                  sort: str = DEFAULT_SORT, as_of=None, run_ts=None, search_options: dict | None = None,
                  **scoring) -> TopicAnalysis:
    """Search posts on a topic and score them, and their first comments, both ways.

    ``limit``, ``comment_limit`` and ``time_filter`` are off when None. ``scoring`` goes to
    ``score_items`` and has to bring a ``lexicon``.
    """
    found = keyword_search(posts, keywords, groups, time_filter=time_filter, limit=limit,
                           sort=sort, as_of=as_of, **(search_options or {}))
    if limit is not None:
        found = cut_lineage(found)      # about as many rows as the limit; four results are made of them
    scored = score_items(found, "submission", make_scorer, run_ts=run_ts, **scoring)
    asked = None if isinstance(keywords, DataFrame) else as_list(keywords)
    replies = None
    scored_replies = None
    if include_comments and comments is not None:
        replies = top_comments_per_post(comments, found, comment_limit)
        scored_replies = score_items(replies, "comment", make_scorer, run_ts=run_ts, **scoring)
    return TopicAnalysis(scored, scored_replies,
                         run_metadata(asked, as_list(groups), found, replies, run_ts))
