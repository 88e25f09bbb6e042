"""Keyed upserts with partial columns, last-wins batches and referential checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.dates import parse_iso, run_stamp
from threadlens.scale import (BROADCAST_MAX_BYTES, PART, ROW, broadcast_if_small, cut_lineage, joined_in_place, laid_out,
                              settled_side)
from threadlens.schemas import DEFAULTS, check_item_type

STRATEGIES = ("auto", "broadcast", "shuffle")


def last_wins(incoming: DataFrame, key: str = "id", seq: str | None = None) -> DataFrame:
    """One row per key, so keys stay unique.

    The row with the highest ``seq`` wins. Rows of a table have no order of their own:
    without ``seq``, and where it ties, the greatest row wins, compared column by column
    with NULL as the least. The maximum is taken in each task before the shuffle, so a
    key that fills a batch stays cheap.
    """
    kept = [c for c in incoming.columns if c not in (key, seq)]
    order = F.struct(*([F.col(seq).alias("_seq")] if seq else []), F.struct(*kept).alias("_kept"))
    return (incoming.groupBy(key).agg(F.max(order).alias("_row"))
            .select(key, *[F.col(f"_row._kept.{c}").alias(c) for c in kept]))


def _default(name: str, base: DataFrame) -> Column:
    return F.lit(DEFAULTS.get(name)).cast(base.schema[name].dataType)


def _merged(name: str, key: str, incoming: set[str], base: DataFrame) -> Column:
    """Columns of the incoming batch overwrite, NULLs included; others stay. New rows
    take the default of a column that the batch does not have."""
    if name == key:
        return F.coalesce(F.col(f"base.{key}"), F.col(f"inc.{key}")).alias(key)
    if name in incoming:
        return F.when(F.col("inc._hit"), F.col(f"inc.{name}")).otherwise(F.col(f"base.{name}")).alias(name)
    return F.when(F.col(f"base.{key}").isNull(), _default(name, base)).otherwise(F.col(f"base.{name}")).alias(name)


def upsert(base: DataFrame, incoming: DataFrame, key: str = "id", seq: str | None = None,
           strategy: str = "auto", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """The base table with the incoming rows updated or added, as a new DataFrame.

    The batch is computed once, reduced to one row per key (see ``last_wins``) and kept
    by a checkpoint, where it is measured. A small one is broadcast: the base table is
    then read once, unshuffled, plus its key column. Larger batches take one full outer
    join; ``strategy="broadcast"`` refuses them. Write the result to a new path, never
    over the files of ``base``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    unknown = [c for c in incoming.columns if c not in base.columns and c != seq]
    if unknown:
        raise ValueError(f"Columns not in the table: {unknown}")
    batch = last_wins(incoming.filter(F.col(key).isNotNull()), key, seq)
    for name in batch.columns:
        if name != key:
            batch = batch.withColumn(name, F.col(name).cast(base.schema[name].dataType))
    columns = set(batch.columns)
    batch = cut_lineage(batch)
    marked = batch.withColumn("_hit", F.lit(True))
    hinted = marked if strategy == "shuffle" else broadcast_if_small(marked, max_bytes)
    if strategy == "broadcast" and hinted is marked:
        raise ValueError("the batch is too large to be broadcast")
    select = [_merged(name, key, columns, base) for name in base.columns]
    if hinted is marked:
        return (base.alias("base").join(marked.alias("inc"), F.col(f"base.{key}") == F.col(f"inc.{key}"),
                                        "full_outer").select(*select))
    kept = (base.alias("base").join(hinted.alias("inc"), F.col(f"base.{key}") == F.col(f"inc.{key}"), "left")
            .select(*select))
    # Distinct keys of the measured batch, so no more of them than it has rows.
    known = base.select(key).join(F.broadcast(batch.select(key)), key, "left_semi").distinct()
    added = batch.join(F.broadcast(known), key, "left_anti")
    missing = {n: _default(n, base) for n in base.columns if n not in columns}
    return kept.unionByName(added.withColumns(missing).select(*base.columns))


def _with_parent(items: DataFrame, parents: DataFrame, column: str, parent_key: str) -> DataFrame:
    """The items with ``__known``: their parent exists.

    The parents' keys are computed once. Small, they are broadcast. Large, only the
    items' places and parent keys meet them, behind Spark's own Bloom filter where it sees fit, and
    the verdicts go back to the items, which are laid out once and stay where they are.
    """
    key = F.col(parent_key).alias(column)
    known, small = settled_side(parents.select(key).filter(F.col(parent_key).isNotNull()).distinct().withColumn("__known", F.lit(True)))
    if small:
        return items.join(known, column, "left")
    rows = laid_out(items)
    return joined_in_place(rows, rows.select(PART, ROW, column).join(known, column).drop(column)).drop(PART, ROW)


def check_reference(items: DataFrame, parents: DataFrame, column: str = "submission_id",
                    parent_key: str = "id") -> DataFrame:
    """Add ``accepted``: the row has an id and its parent exists. One join serves
    both the accepted and the rejected rows."""
    return (_with_parent(items, parents, column, parent_key)
            .withColumn("accepted", F.coalesce("__known", F.lit(False)) & F.col("id").isNotNull())
            .drop("__known"))


def accepted_comments(comments: DataFrame, posts: DataFrame) -> DataFrame:
    return _with_parent(comments, posts, "submission_id", "id").filter("__known").drop("__known").select(*comments.columns)


def rejected_comments(comments: DataFrame, posts: DataFrame) -> DataFrame:
    return _with_parent(comments, posts, "submission_id", "id").filter("__known is null").drop("__known").select(*comments.columns)


def outcome_counts(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count_if(F.col("accepted")).alias("success"),
                       F.count_if(~F.col("accepted")).alias("failure"))


@dataclass(frozen=True)
class StoreResult:
    """The counts need no merge; the new table is built when it is asked for."""

    build: Callable[[], DataFrame]
    rejected: DataFrame
    counts: DataFrame

    @cached_property
    def table(self) -> DataFrame:
        return self.build()


def stamped(items: DataFrame, run_ts=None) -> DataFrame:
    """Mark rows as processed at the time of the run; parse times given as text."""
    if "created_utc" in items.columns and items.schema["created_utc"].dataType.typeName() == "string":
        items = items.withColumn("created_utc", parse_iso(F.col("created_utc")))
    return items.withColumns({"processed": F.lit(True), "processed_at": run_stamp(run_ts)})


def store_batch(base: DataFrame, items: DataFrame, item_type: str = "submission",
                posts: DataFrame | None = None, seq: str | None = None, run_ts=None,
                strategy: str = "auto") -> StoreResult:
    """Upsert a batch of posts or comments and count what was stored.

    Rows without an id fail; comments fail too when their post is not in ``posts``.
    Failures do not stop the rest of the batch.
    """
    if check_item_type(item_type) == "comment" and posts is not None:
        checked = check_reference(items, posts)
    else:
        checked = items.withColumn("accepted", F.col("id").isNotNull())
    accepted = stamped(checked.filter("accepted").drop("accepted"), run_ts)
    return StoreResult(build=lambda: upsert(base, accepted, seq=seq, strategy=strategy),
                       rejected=checked.filter("not accepted").drop("accepted"),
                       counts=outcome_counts(checked))
