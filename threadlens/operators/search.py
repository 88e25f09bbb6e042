"""Keyword search over posts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions import dates
from threadlens.functions.keywords import as_list, matches, occurrences
from threadlens.operators.phrases import MATCHED, match_phrases, occurrences_of
from threadlens.operators.quota import allocate_budget, initial_limits, quota_table
from threadlens.scale import cut_lineage, top_n_per_group

Keywords = str | Sequence[str] | DataFrame

DEFAULT_TIME_FILTER = "week"
DEFAULT_LIMIT = 100
DEFAULT_SORT = "relevance"
SORT_MODES = ("relevance", "hot", "top", "new", "comments")


# A stored column with the group in lower case; a filter on it reaches the scan.
GROUP_KEY = "group_key"


def with_group_key(posts: DataFrame, group_col: str = "subreddit") -> DataFrame:
    """Add the column that group filters push down; write posts sorted or partitioned by it."""
    return posts.withColumn(GROUP_KEY, F.lower(group_col))


def folded(groups: str | Sequence[str]) -> list[str]:
    """Group names in lower case, each once."""
    return list(dict.fromkeys(group.lower() for group in as_list(groups)))


def in_groups(posts: DataFrame, groups: str | Sequence[str] | None,
              group_col: str = "subreddit") -> DataFrame:
    """Posts of the named groups, whatever their case. None means all groups; an empty
    list names none and finds nothing."""
    if groups is None:
        return posts
    named = sorted(folded(groups))
    group = F.col(GROUP_KEY) if GROUP_KEY in posts.columns else F.lower(group_col)
    return posts.filter(group.isin(named)) if named else posts.filter(F.lit(False))


def in_window(posts: DataFrame, time_filter: str, as_of: datetime | str | None = None) -> DataFrame:
    kind = posts.schema["created_utc"].dataType
    end = F.current_timestamp() if as_of is None else F.lit(as_of)
    return posts.filter(dates.within(F.col("created_utc"), time_filter, end.cast(kind)))


def sort_key(sort: str, keywords: Keywords = ()) -> Column:
    """What a sort mode orders by, largest first."""
    if sort == "relevance" and isinstance(keywords, DataFrame):
        return occurrences_of(F.col(MATCHED))
    if sort == "relevance":
        return occurrences(keywords, F.col("title"), F.col("text"))
    if sort == "hot":
        score = F.col("score").cast("double")
        age = F.unix_timestamp(F.col("created_utc").cast("timestamp")).cast("double")
        return F.signum(score) * F.log10(F.greatest(F.abs(score), F.lit(1.0))) + age / 45000.0
    if sort == "top":
        return F.col("score")
    if sort == "new":
        return F.col("created_utc")
    if sort == "comments":
        return F.col("num_comments")
    raise ValueError(f"sort must be one of {SORT_MODES}")


def _ranked(key: str = "sort_key") -> list[Column]:
    return [F.col(key).desc_nulls_last(), F.col("id").asc()]


def sort_posts(posts: DataFrame, sort: str, limit: int | None = None, keywords: Keywords = ()) -> DataFrame:
    """Posts in the order of a sort mode, ties by id. With a limit, Spark keeps
    only the first rows of each partition instead of sorting everything."""
    ordered = posts.withColumn("sort_key", sort_key(sort, keywords)).orderBy(*_ranked())
    return ordered if limit is None else ordered.limit(limit)


def found_posts(posts: DataFrame, keywords: Keywords,
                groups: str | Sequence[str] | None = None, time_filter: str | None = "all",
                as_of: datetime | str | None = None, group_col: str = "subreddit") -> DataFrame:
    """All matching posts, without order or limit. Time, and groups where the table has
    a ``group_key``, reach the scan; the text match cannot. No time filter means all.
    Keywords may be a table ``(phrase)`` of any length; hits then keep ``matched_phrases``."""
    scoped = in_groups(posts, groups, group_col)
    if time_filter is not None:
        scoped = in_window(scoped, time_filter, as_of)
    if isinstance(keywords, DataFrame):
        return match_phrases(scoped, ["title", "text"], keywords).filter(F.size(MATCHED) > 0)
    return scoped.filter(matches(keywords, F.col("title"), F.col("text")))


def keyword_search(posts: DataFrame, keywords: Keywords,
                   groups: str | Sequence[str] | None = None, search_all: bool = False,
                   time_filter: str | None = DEFAULT_TIME_FILTER, limit: int | None = DEFAULT_LIMIT,
                   sort: str = DEFAULT_SORT, weights: Mapping[str, float] | None = None,
                   limits: Mapping[str, Mapping[str, int | None]] | None = None,
                   as_of: datetime | str | None = None, group_col: str = "subreddit",
                   strict: bool = False) -> DataFrame:
    """Search one group, several with a weighted budget, or everything.

    ``keywords`` are phrases, or a table ``(phrase)`` of any length, whose hits come with
    ``matched_phrases``.
    ``time_filter=None`` means any time, ``limit=None`` all matches; those come without
    order and, with groups, with NULL in ``rank`` and ``phase``, and take no limits of
    groups. Names, weights and limits of groups count in any case; of two spellings the
    last one's weight and limits hold. Without groups, or with ``search_all``, the best ``limit`` posts come back. With
    groups, ``limit`` is their common budget; ``phase`` tells minimum rows (0) from
    weighted ones (1) and ``rank`` is the place within the group. ``strict`` cuts
    the result at ``limit`` where minimums or rounding exceed it.

    The matching posts are ranked and cut per group in one pass over the table. What
    is left is at most about ``limit`` rows; it is checkpointed, so counting it for
    the budget does not read the table again.
    """
    if sort not in SORT_MODES:
        raise ValueError(f"sort must be one of {SORT_MODES}")
    if search_all or groups is None:
        hits = found_posts(posts, keywords, None, time_filter, as_of, group_col)
        return hits if limit is None else sort_posts(hits, sort, limit, keywords).drop("sort_key")

    named = folded(groups)
    hits = found_posts(posts, keywords, named, time_filter, as_of, group_col)
    weights = None if weights is None else {group.lower(): w for group, w in weights.items()}
    limits = None if limits is None else {group.lower(): bounds for group, bounds in limits.items()}
    if limit is None:
        if limits:
            raise ValueError("limits of groups need a common limit")
        none = F.lit(None).cast("int")
        return hits.withColumns({"rank": none, "phase": none})
    quotas = initial_limits(quota_table(posts.sparkSession, named, weights, limits, limit), limit)
    bounds = quotas.select("grp", "initial")
    widest = max(bounds.agg(F.max("initial")).first()[0] or 0, 0)
    keyed = (hits.withColumn("grp", F.lower(group_col))
             .withColumn("sort_key", sort_key(sort, keywords)))
    best = (top_n_per_group(keyed, ["grp"], _ranked(), widest)
            .join(F.broadcast(bounds), "grp")
            .filter(F.col("rank") <= F.col("initial"))
            .drop("initial", "sort_key"))
    best = cut_lineage(best)
    shares = allocate_budget(best.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), quotas, limit)
    taken = (best.join(F.broadcast(shares.select("grp", "base", "take")), "grp")
             .filter(F.col("rank") <= F.col("take"))
             .withColumn("phase", (F.col("rank") > F.col("base")).cast("int")))
    if strict:
        taken = taken.orderBy("phase", "grp", "rank").limit(limit)
    return taken.drop("grp", "base", "take")
