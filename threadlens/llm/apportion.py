"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix has as many words as the corpus. Sources are apportioned in rounds of their
like: a round holds the sources whose targets lie within a factor of 16, and the sum of
its targets is cut into equal blocks, at least 256 to a target (or one word). The blocks
of a round go one by one to the source with the highest quotient target / (2k + 1),
where k is what it has already, so a source misses its target by about a block, 0.4 % of
it, whatever the size of the others. Quotients in descending order are dealt to the
output shards in runs, so each shard has an integer quota for each source and any run of
shards is in proportion. The words of a quota are walked through the source's texts in
seeded order, round and round, three times at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import WORD, n_words, settle, sized_side

# A target has at least this many blocks where blocks have several words, and less than
# 2 ** ROUND_BITS times as many; bounds the quotients.
LEAST_BLOCKS = 256
ROUND_BITS = 4
SHARDS = 16
MOST_REPEATS = 3
# Slices of a source's seeded order; each is summed by itself.
SLICES = 1024
# Slices of the quotients' order.
QUOTIENT_SLICES = 512


def sized(docs: DataFrame, seed: int, id_column: str = "doc_id") -> DataFrame:
    """doc_id, source, size and the place in the seeded order (28 bits of an MD5)."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"))
    return docs.select(F.col(id_column).alias("doc_id"), "source", n_words(F.col("text")).alias("size"),
                       F.conv(F.substring(key, 1, 7), 16, 10).cast("long").alias("place"))


def targets(sizes: DataFrame) -> DataFrame:
    """One row for each source: weight, size and target words.

    Water filling in closed form: sources in ascending order of limit / weight reach
    their limit first; the level of the others is what is left over their weights.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("weight", F.pmod(F.row_number().over(by_name) - 1, F.lit(3)).cast("long") + 1)
            .withColumn("_limit", F.col("source_size") * MOST_REPEATS)
            .withColumn("_total", F.sum("source_size").over(whole))
            .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_limit").over(before), F.lit(0))).cast("double")
                        / F.sum("weight").over(after)))
    # The first source that does not reach its limit sets the level for all after it.
    open_ = F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.col("_level"))
    return (rows.withColumn("_open", F.first(open_, ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .select("source", "weight", "source_size", "_total",
                    F.when(F.col("_open").isNull(), F.col("_limit").cast("double"))
                    .otherwise(F.least(F.col("_open") * F.col("weight"), F.col("_limit").cast("double"))).alias("target")))


def quotas(goal: DataFrame, shards: int = SHARDS, least_blocks: int = LEAST_BLOCKS) -> DataFrame:
    """Blocks of each source in each shard: ``source, shard, quota`` and ``block_words``.

    A source can win at most target * (M + n/2) / sum + 1/2 of the M blocks of a round of
    n sources, so at most some 16 * LEAST_BLOCKS quotients are made for a source, however
    large the corpus is.
    """
    per_round = Window.partitionBy("block_words")
    # Powers of two, so that comparing them with a target is exact.
    steps = F.sequence(F.lit(1), F.lit(52 // ROUND_BITS))
    rounds = F.size(F.filter(steps, lambda k: F.col("target") >= least_blocks * F.pow(F.lit(2.0 ** ROUND_BITS), k)))
    base = (goal.filter(F.col("target") > 0)
            .withColumn("block_words", F.pow(F.lit(2.0 ** ROUND_BITS), rounds).cast("long"))
            .withColumn("_n", F.count(F.lit(1)).over(per_round))
            # Exact decimals, so that the sum does not depend on its order.
            .withColumn("_sum", F.sum(F.round("target", 3).cast("decimal(30,3)")).over(per_round).cast("double"))
            .withColumn("_seats", F.greatest(F.lit(1), F.round(F.col("_sum") / F.col("block_words"))).cast("long")))
    most = F.ceil(F.col("target") * (F.col("_seats") + F.col("_n") / 2) / F.col("_sum") + 0.5).cast("long")
    seats = (base.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), most)))
             .withColumn("_cost", (2 * F.col("_k") + 1) / F.col("target"))
             # Quotients are evenly dense in their reciprocal, so equal slices hold about as many each.
             .withColumn("_slice", F.least(F.lit(QUOTIENT_SLICES * 2), F.floor(
                 F.col("_cost") * F.col("_sum") * QUOTIENT_SLICES / (2 * F.col("_seats")))).cast("int")))
    earlier = (seats.groupBy("block_words", "_slice").agg(F.count(F.lit(1)).alias("_c"))
               .withColumn("_before", F.coalesce(F.sum("_c").over(
                   Window.partitionBy("block_words").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select("block_words", "_slice", "_before"))
    rank = F.row_number().over(Window.partitionBy("block_words", "_slice").orderBy("_cost", F.col("source").asc_nulls_last()))
    return (seats.join(F.broadcast(earlier), ["block_words", "_slice"])     # at most 14 rounds of 2 * QUOTIENT_SLICES + 1 rows
            .withColumn("_rank", rank + F.col("_before") - 1)
            .filter(F.col("_rank") < F.col("_seats"))
            .withColumn("shard", F.expr(f"cast(_rank * {shards} div _seats as int)"))
            .groupBy("source", "shard", "block_words").agg(F.count(F.lit(1)).alias("quota")))


def mix(docs: DataFrame, seed: int = 7, shards: int = SHARDS, id_column: str = "doc_id") -> DataFrame:
    """Words that the mix takes of every text: ``doc_id, source, size, source_size, target, taken``.

    Sources are a table of one row each; everything about texts is summed in slices of
    their source, so a source of any size is spread over the tasks. A null source is one
    source, the last. A null or empty text has size 0 and gives nothing. Rows that
    repeat are separate texts; ties in the seeded order go by id, then size. An empty
    table gives no rows. Columns other than id, text and source are not read.
    """
    return shared_out(settle(sized(docs, seed, id_column)), shards)     # narrow: texts are read once


def shared_out(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``mix`` for a table of ids, sources, sizes and places."""
    goal = settle(targets(rows))
    quota = quotas(goal, shards).groupBy(F.col("source").alias("_named")).agg(F.sum(F.col("quota") * F.col("block_words")).alias("_words"))
    sliced = rows.withColumn("_slice", F.expr(f"cast(place div {(1 << 28) // SLICES} as int)"))
    slices = (sliced.groupBy(F.col("source").alias("_of"), F.col("_slice").alias("_in")).agg(F.sum("size").alias("_sum"))
              .withColumn("_start", F.coalesce(F.sum("_sum").over(
                  Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    per_source = goal.join(quota, F.col("source").eqNullSafe(F.col("_named")), "left").select(
        F.col("source").alias("_source"), "source_size", "target",
        F.least(F.coalesce("_words", F.lit(0)), F.col("source_size") * MOST_REPEATS).alias("_words"))
    starts = slices.join(per_source, F.col("_of").eqNullSafe(F.col("_source"))).select(
        "_of", "_in", "_start", "source_size", "target",
        F.expr("_words div greatest(source_size, 1)").alias("_passes"), F.expr("_words % greatest(source_size, 1)").alias("_reach"))
    inside = Window.partitionBy("source", "_slice").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (placed.join(starts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_slice") == F.col("_in")))
            .withColumn("_at", F.col("_start") + F.col("_within"))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("_passes") * F.col("size")
                     + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_reach") - F.col("_at")))).cast("long").alias("taken")))


def mixed(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each text as often as it is taken, and at
    most one text of a source cut to the words that are left for it.

    Texts that the mix does not take, and texts without words, are not in it. Rows alike in
    id, source and size are taken alike. Columns may have any names but those that begin
    with two underscores.
    """
    taken = (mix(docs, seed).filter("taken > 0").groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__of"), F.col("size").alias("__size"))
             .agg(F.max("taken").alias("__taken")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__of")) & (n_words(F.col("text")) == F.col("__size"))
    times = F.expr("sequence(1L, (__taken + __size - 1) div __size)")
    rest = F.expr("__taken - (__copy - 1) * __size")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("__rest").cast("int")), " ")
    out = (docs.join(sized_side(taken), same).withColumn("__copy", F.explode(times)).withColumn("__rest", rest)
           .withColumn("text", F.when(F.col("__rest") < F.col("__size"), cut).otherwise(F.col("text"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)
