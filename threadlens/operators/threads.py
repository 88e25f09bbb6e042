"""Comment trees: depth, the comments of a post, the first comments of many posts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from threadlens.scale import broadcast_if_small, cut_lineage, settled_side, top_n_per_group

def breadth_first() -> list[Column]:
    """Level by level, older comments first; comments off the tree come last."""
    return [F.col("depth").asc_nulls_last(), F.col("created_utc").asc(), F.col("id").asc()]


# Up to this many open comments are settled by pointer jumping, more are contracted first.
JUMP_MAX_ROWS = 1_000_000


def _kept(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The rows kept by a checkpoint, and what was counted while they were written."""
    seen = Observation("rows")
    kept = cut_lineage(df.observe(seen, *[F.count_if(test).alias(name) for name, test in counts.items()]))
    return kept, seen.get


def comment_depth(comments: DataFrame, carry: Sequence[str] = (), jump_max_rows: int = JUMP_MAX_ROWS) -> DataFrame:
    """``(id, depth)`` of every comment; top-level comments have depth 0.

    Comments whose ancestors are missing, or that answer each other in a circle, get a
    NULL depth. The source is read once: ids, pointers and the columns to ``carry`` are
    checkpointed. Only ids and pointers take part in what follows. Large tables are
    contracted: each round settles or sets aside the comments without answers and every
    fourth of the others, whose answers go on to the next ancestor, so the rows of all
    rounds together stay within a multiple of the table, however deep its trees are. What is
    left jumps pointers, a number of joins that grows with the logarithm of the depth.
    """
    top_level = F.col("parent_id").startswith("t3_")
    edges, seen = _kept(comments.select(
        "id", *carry, F.when(~top_level, F.expr("substring(parent_id, 4)")).alias("up"),
        F.when(top_level, 0).otherwise(1).cast("long").alias("hops")), rows=F.lit(True), open=F.col("up").isNotNull())
    if seen["open"] <= jump_max_rows:
        return _jumped(edges, seen["open"], seen["rows"], carry).select("id", *carry, _depth())
    known = _contracted(edges.select("id", "up", "hops"), seen["open"], seen["rows"], jump_max_rows)
    found = edges.join(known.withColumnRenamed("depth", "below"), "id", "left")
    return found.select("id", *carry, F.when(F.col("up").isNull(), F.col("hops")).otherwise(F.col("below")).cast("int").alias("depth"))


def _depth() -> Column:
    return F.when(F.col("up").isNull(), F.col("hops")).cast("int").alias("depth")


def _jumped(nodes: DataFrame, open_rows: int, total: int, carry: Sequence[str] = ()) -> DataFrame:
    """Rows settled by pointer jumping: every open pointer goes on to where its target points.

    An open pointer can only come to what open pointers point to now, so a round hands
    on those rows alone; a settled row that none points to is done. A pointer that has
    jumped over as many comments as there are is in a circle. The left side of a join
    holds the hot keys (a comment with very many answers): adaptive execution may split it.
    """
    done = [nodes.filter("up is null")]
    state = nodes.withColumn("new", F.lit(True))
    while open_rows:
        active = state.filter("up is not null")
        wanted = active.select(F.col("up").alias("id")).distinct()
        reachable = state.join(wanted, "id", "left_semi")
        targets = (reachable.groupBy("id").agg(F.first(F.struct("up", "hops")).alias("at"))
                   .select(F.col("id").alias("up"), F.col("at.up").alias("next"), F.col("at.hops").alias("more")))
        moved = active.join(targets, "up", "left").select(
            "id", *carry, F.col("next").alias("up"), (F.col("hops") + F.col("more")).alias("hops"))
        circle = F.col("up").isNotNull() & ((F.col("up") == F.col("id")) | (F.col("hops") >= total))
        moved = moved.withColumns({"up": F.when(~circle, F.col("up")), "hops": F.when(~circle, F.col("hops")), "new": F.lit(True)})
        state, seen = _kept(moved.unionByName(reachable.filter("up is null").withColumn("new", F.lit(False)).select(*moved.columns)),
                            open=F.col("up").isNotNull())
        done.append(state.filter("new and up is null").drop("new"))
        open_rows = seen["open"]
    return reduce(DataFrame.unionByName, [part.select("id", *carry, "up", "hops") for part in done])


def _contracted(nodes: DataFrame, open_rows: int, total: int, jump_max_rows: int) -> DataFrame:
    """Depths by rake and compress.

    A round drops the leaves (comments that no open pointer reaches) and splices out inner
    comments whose coin shows heads while their parent's shows tails; the answers to a spliced
    comment point to its parent, with the hops added up. A comment whose pointer has come
    to a top-level comment is settled, and so are then its answers. What was set aside is
    settled in reverse order, each round from the rows that outlived it.
    """
    def coin(name: str, number: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(number), name), F.lit(2)) == 1

    settled, aside, number = [], [], 0
    now, seen = nodes, {"open": open_rows}
    while seen["open"] > jump_max_rows:
        parents = now.filter("up is not null").select(F.col("up").alias("id")).distinct().withColumn("inner", F.lit(True))
        # Both coins are known without a join, so no parent and child are spliced in one round.
        splice = F.col("inner").isNotNull() & F.col("up").isNotNull() & (F.col("up") != F.col("id")) & coin("id", number) & ~coin("up", number)
        marked = cut_lineage(now.dropDuplicates(["id"]).join(parents, "id", "left").select("id", "up", "hops", F.col("inner").isNotNull().alias("inner"),
                                                                                        F.coalesce(splice, F.lit(False)).alias("splice")))
        donors = (marked.filter("splice or (inner and up is null)")
                  .select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("hops").alias("more"), F.lit(True).alias("given")))
        stay = marked.filter("not splice").join(donors, "up", "left").select(
            "id", F.when(F.col("given"), F.col("next")).otherwise(F.col("up")).alias("up"),
            (F.col("hops") + F.when(F.col("given"), F.col("more")).otherwise(F.lit(0))).alias("hops"), "inner")
        # What points to itself is in a circle.
        stay = stay.select("id", F.when(F.col("up") != F.col("id"), F.col("up")).alias("up"),
                           F.when(F.coalesce(F.col("up") != F.col("id"), F.lit(True)), F.col("hops")).alias("hops"), "inner")
        stay, seen = _kept(stay, open=F.col("inner") & F.col("up").isNotNull())
        settled.append(stay.filter("not inner and up is null").select("id", "up", "hops"))
        aside.append(stay.filter("not inner and up is not null").select("id", "up", "hops")
                     .unionByName(marked.filter("splice").select("id", "up", "hops")))
        now, number = stay.filter("inner").select("id", "up", "hops"), number + 1
    known = cut_lineage(_jumped(now, seen["open"], total).select("id", _depth()))
    for own, waiting in zip(reversed(settled), reversed(aside)):
        found = waiting.join(known.withColumnRenamed("id", "up").withColumnRenamed("depth", "base"), "up", "left").select(
            "id", (F.col("base") + F.col("hops")).cast("int").alias("depth"))
        known = known.unionByName(cut_lineage(found)).unionByName(own.select("id", _depth()))
    return known


def depth_table(comments: DataFrame) -> DataFrame:
    """``(id, parent_id, depth)``: what to store so that late comments need no second run."""
    return comment_depth(comments, carry=("parent_id",))


def with_late_comments(stored: DataFrame, late: DataFrame) -> DataFrame:
    """A depth table with late comments in it; equal to that of all comments together.

    Only the late comments, and stored ones without a depth so far, whose ancestors may
    have come now, are resolved. Of the other stored rows those are looked up that one of
    these answers: a semi join with their ids, which are broadcast where they are measured to be small,
    so the table is read where it lies. Ids of late comments are new.
    """
    top_level = F.col("parent_id").startswith("t3_")
    open_rows = (late.select("id", "parent_id").unionByName(stored.filter("depth is null").select("id", "parent_id"))
                 .select("id", "parent_id", F.when(~top_level, F.expr("substring(parent_id, 4)")).alias("up"),
                         F.when(top_level, 0).otherwise(1).cast("long").alias("hops")))
    open_rows, seen = _kept(open_rows, open=F.col("up").isNotNull())
    wanted, _ = settled_side(open_rows.filter("up is not null").select(F.col("up").alias("id")).distinct())
    placed = stored.filter("depth is not null")
    base, _ = _kept(placed.select("id", "depth").join(wanted, "id", "left_semi").select(
        "id", F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("string").alias("up"), F.col("depth").cast("long").alias("hops")),
        rows=F.lit(True))
    # No path is longer than the deepest stored comment it hangs on and all open ones together.
    deepest = base.agg(F.coalesce(F.max("hops"), F.lit(0))).first()[0]
    resolved = _jumped(open_rows.withColumn("late", F.lit(True)).unionByName(base.withColumn("late", F.lit(False))),
                       seen["open"], open_rows.count() + deepest + 1, ("parent_id", "late"))
    return placed.select("id", "parent_id", "depth").unionByName(resolved.filter("late").select("id", "parent_id", _depth()))


def comments_of_post(comments: DataFrame, post_id: str, limit: int | None = None) -> DataFrame:
    """Comments of one post, breadth first; ``limit=None`` gives all of them."""
    own = comments.filter(F.col("submission_id") == post_id)
    ordered = own.join(comment_depth(own), "id").orderBy(*breadth_first())
    return ordered if limit is None else ordered.limit(limit)


def stored_comments(comments: DataFrame, post_id: str, limit: int | None = None) -> DataFrame:
    """Comments of one post as stored, oldest first; no limit or 0 gives all."""
    own = comments.filter(F.col("submission_id") == post_id).orderBy("created_utc", "id")
    return own.limit(limit) if limit else own


def top_comments_per_post(comments: DataFrame, posts: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` comments of each post, breadth first, with ``depth`` and
    ``rank``; all comments of the posts, without rank, for ``n=None``.

    Ranking sees ids only; texts join the winners at the end, by broadcast where
    the winners' measured size allows it.
    """
    wanted = broadcast_if_small(posts.select(F.col("id").alias("submission_id")))
    own = comments.join(wanted, "submission_id", "left_semi")
    placed = comment_depth(own, carry=("submission_id", "created_utc"))
    if n is None:
        return own.join(placed.select("id", "depth"), "id")
    best = top_n_per_group(placed, ["submission_id"], breadth_first(), n)
    winners = cut_lineage(best.select("id", "depth", "rank"))
    return own.join(broadcast_if_small(winners), "id")


def with_posts(posts: DataFrame, comments: DataFrame, how: str = "inner") -> DataFrame:
    """Posts joined with their comments; columns of a comment start with ``comment_``.

    ``how="left"`` adds the posts without comments by an anti join. A single outer
    join could not split the comments of a very popular post over several tasks, as
    they are its optional side; an inner join can.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    replies = comments.select(*[F.col(c).alias(c if c == "submission_id" else f"comment_{c}")
                                for c in comments.columns])
    both = posts.join(replies, posts["id"] == replies["submission_id"]).drop("submission_id")
    if how == "inner":
        return both
    answered = comments.select(F.col("submission_id").alias("id")).distinct()
    return both.unionByName(posts.join(answered, "id", "left_anti"), allowMissingColumns=True)
