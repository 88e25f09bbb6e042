"""Helpers that keep plans safe at cluster scale: size-checked broadcasts, salted
top-n, dictionary lookups without a shuffle, and lineage cuts in shared storage."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from math import isfinite

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

# Largest side that is broadcast on our own decision.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
BROADCAST_MAX_ROWS = 1_000_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def map_columns(df: DataFrame, columns: Mapping[str, str], body: Callable[[Column], Column]) -> DataFrame:
    """Add ``{output: input}`` columns by one expression applied to all inputs. The
    expression is in the plan once, however many columns it serves."""
    if len(columns) == 1:
        (out, name), = columns.items()
        return df.withColumn(out, body(F.col(name)))
    df = df.withColumn("_mapped", F.transform(F.array(*map(F.col, columns.values())), body))
    return df.withColumns({out: F.get("_mapped", F.lit(i)) for i, out in enumerate(columns)}).drop("_mapped")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where an input has fewer partitions than there are cores (small
    files, single row groups). Larger inputs are left as they are, unshuffled. Meant
    for plain scans: asking a plan with joins for its partitions would run them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: ``spark.checkpoint.dir``, or the folder given to
    ``setCheckpointDir``. Without either there is none; a folder of the driver's own
    machine would be another one on every executor."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("no shared folder: set spark.checkpoint.dir to one that the driver and all executors see")
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local one."""
    folder = shared_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


# Texts that a Python worker gets at a time, in bytes.
BATCH_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Have Python workers get batches of bounded bytes: rows alone say nothing about how long their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_FIXED_BYTES = 16


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: the lengths of its texts and some for each other value."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    nested = [F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)) for f in df.schema
              if f.dataType.typeName() in ("array", "map", "struct", "variant")]
    return (sum(texts + nested, F.lit(0)) + _FIXED_BYTES * len(df.columns)).cast("long")


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                       max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast when the measured size allows it; else leave the join
    strategy to the optimizer.

    Needed where Spark has no size estimate, as after a checkpoint. One plain aggregate
    counts rows and bytes, two numbers a task.
    """
    rows, measured = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and measured <= max_bytes else df


def settled_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                 max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """The side of a join, computed once and kept by a checkpoint, and whether it is small
    enough to be broadcast. It is measured while it is written."""
    seen = Observation("side")
    kept = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")))
    measured = seen.get
    small = measured["rows"] <= max_rows and measured["bytes"] <= max_bytes
    return (F.broadcast(kept) if small else kept), small


# Where rows lie: the bucket of a layout, and the row in it.
PART, ROW = "__part", "__row"
# A join on both columns may then rely on a layout that is bucketed by the first.
IN_PLACE_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def _bucket_labels(spark: SparkSession, buckets: int) -> list[int]:
    """A number of each bucket, so that tasks numbered by them fill the buckets evenly."""
    tried = spark.range(40 * buckets).select(F.col("id").cast("int").alias("n"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets)).alias("bucket"))
    return sorted(row["n"] for row in tried.groupBy("bucket").agg(F.min("n").alias("n")).collect())


def laid_out(df: DataFrame, buckets: int | None = None) -> DataFrame:
    """The rows with the columns ``PART`` and ``ROW``, written once where they are.

    Each task writes one file, no row moves. The files are bucketed by ``PART``, which deals
    them evenly to the buckets (tasks beyond the number of buckets share a ``PART``), so
    what is computed a row can be grouped and joined back by both columns without an
    Exchange of the rows; for joins the session needs ``IN_PLACE_SETTINGS`` (without them the result is
    the same, but the join shuffles).
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"laid_out_{uuid.uuid4().hex}"
    labels = _bucket_labels(spark, buckets)
    part = F.get(F.array(*[F.lit(n) for n in labels]), F.spark_partition_id() % len(labels))
    numbered = df.withColumns({PART: part, ROW: F.monotonically_increasing_id()})
    (numbered.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, name))
     .bucketBy(buckets, PART).saveAsTable(name))
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")     # the name only; the files have a path of their own
    return rows


def joined_in_place(rows: DataFrame, values: DataFrame) -> DataFrame:
    """The rows of a layout with ``values``, at most one row each, joined by ``PART`` and ``ROW``."""
    return rows.join(values, [PART, ROW], "left")


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank: str = "rank", salt_on: str | None = "id", salts: int = 64) -> DataFrame:
    """First ``n`` rows of each group with their rank.

    A hot group is first cut down inside ``salts`` slices of itself, so no task
    sorts it whole; the final window sees at most ``salts * n`` rows a group.
    Both filters compare a row number with a constant, which lets Spark prune
    rows before each shuffle as well.
    """
    if salt_on is not None:
        slice_of = F.pmod(F.xxhash64(F.col(salt_on)), F.lit(salts)).alias("_slice")
        within = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = (df.select("*", slice_of)
                .withColumn("_pos", F.row_number().over(within))
                .filter(F.col("_pos") <= n)
                .drop("_slice", "_pos"))
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


# Up to so many entries of a short word list are also tested as a set.
MOST_TESTED = 4096


def inline_lookup(entries: Mapping[str, object], value_type: str) -> Callable[[Column], Column]:
    """Lookup function for a short word list held in the plan as a constant.

    Spark scans a map entry by entry, so the entries are spread over many small
    maps by CRC-32 of the key; a probe then touches one or two entries only.
    """
    size = 1
    while size < len(entries):
        size *= 2
    slots: list[dict[str, object]] = [{} for _ in range(size)]
    for key, value in entries.items():
        slots[zlib.crc32(key.encode()) % size][key] = value
    table = F.from_json(F.lit(json.dumps(slots)), f"array<map<string,{value_type}>>")
    probe = lambda key: F.try_element_at(F.get(table, (F.crc32(key) % size).cast("int")), key)
    if len(entries) > MOST_TESTED:
        return probe
    # Most words are no entries: Spark's hashed set of constants says so at less cost.
    return lambda key: F.when(key.isin(list(entries)), probe(key))


# Tables of so many entries and bytes at most may travel with the plan.
MOST_INLINE, MOST_INLINE_BYTES = 20_000, 1 << 20


def few_entries(side: DataFrame) -> dict[str, object] | None:
    """The values of a settled table ``(__k, __v)`` by key, or None where it is too large to travel with a plan."""
    rows, measured = side.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(side)), F.lit(0))).first()
    return {row["__k"]: row["__v"] for row in side.collect()} if rows <= MOST_INLINE and measured <= MOST_INLINE_BYTES else None


def all_finite(values: Sequence[float]) -> bool:
    """Whether a constant of the plan, which is JSON, can hold the values."""
    return all(map(isfinite, values))


def settled_entries(entries: Mapping[str, object]) -> dict[str, object]:
    """Entries of a mapping by lower-case key. Of several spellings of a key the greatest
    value counts, as it does in a table."""
    result: dict[str, object] = {}
    for key, value in entries.items():
        key = key.lower()
        result[key] = max(result[key], value) if key in result else value
    return result


HITS = "__hits"
PHRASE_HITS = "__phrase_hits"
IN_PLACE_COLUMNS = (PART, ROW, HITS, PHRASE_HITS)


# Spark looks a map's keys through one by one, so the hits of a row lie in as many small maps.
SLOTS = 64


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def _found(rows: DataFrame, words: Column, entries: DataFrame) -> DataFrame:
    """``(PART, ROW, __k, __v)``: those of a row's words that have an entry, each once."""
    distinct = rows.select(PART, ROW, F.explode(F.array_distinct(words)).alias("__k"))
    return distinct.join(entries, "__k")


def word_hits(rows: DataFrame, words: Column, entries: DataFrame, out: str) -> DataFrame:
    """The rows of a layout with ``out``: those of a row's words that have an entry, with its
    value, for ``hit``. Only distinct words and hits move, or nothing where the entries are broadcast."""
    held = lambda key, value: F.map_from_entries(F.collect_list(F.struct(key, value)))
    hits = (_found(rows, words, entries).groupBy(PART, ROW, _slot(F.col("__k")).alias("__slot")).agg(held("__k", "__v").alias("__own"))
            .groupBy(PART, ROW).agg(held("__slot", "__own").alias(out)))
    return joined_in_place(rows, hits)


def hit(out: str, word: Column) -> Column:
    """Value of a word in what ``word_hits`` added, or NULL."""
    return F.try_element_at(F.try_element_at(F.col(out), _slot(word)), word)


def values_of(hits: Column, words: Column, kind: DataType) -> Column:
    """Values of a row's words, in their order, from its hits ``(__k, __v)``; NULL for words without one.
    Arrow looks up the words of a whole batch at once: a word has one value, whatever row it is in."""
    def looked_up(hits: pa.Array, words: pa.Array) -> pa.Array:
        known, flat = hits.flatten(), words.flatten()
        values = known.field(1).take(pa.compute.index_in(flat, value_set=known.field(0)))
        sizes = pa.compute.fill_null(words.value_lengths(), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
        return pa.ListArray.from_arrays(offsets, values, mask=words.is_null())

    return F.arrow_udf(looked_up, ArrayType(kind))(hits, words)


@dataclass(frozen=True)
class Found:
    """Lookup in the hits of a row: of one word, or quicker of all words of an array, outside of lambdas."""

    kind: DataType

    def __call__(self, word: Column) -> Column:
        return F.try_element_at(F.filter(F.col(HITS), lambda found: found["__k"] == word), F.lit(1))["__v"]

    def all(self, words: Column) -> Column:
        return values_of(F.col(HITS), words, self.kind)


def dictionary_of(table: DataFrame, key: str, value: str) -> DataFrame:
    """``(__k, __v)``: of several values of a key the greatest."""
    return (table.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
            .groupBy(F.col(key).alias("__k")).agg(F.max(value).alias("__v")))


def attach_dictionary(df: DataFrame, tokens: Callable[[DataFrame], Sequence[Column]], table: DataFrame, key: str, value: str,
                      max_bytes: int = BROADCAST_MAX_BYTES,
                      max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, Found]:
    """``df`` and a lookup function for a dictionary of any size held in a table of lower-case keys.

    Of several values of a key the greatest counts. The rows are laid out once and stay
    where they are; only their distinct words move. A dictionary that is measured to be
    small is broadcast to the words, and then nothing moves at all; a larger one meets
    them by a shuffle of words, and the hits go back to their rows by a shuffle of hits.
    Use the lookup on the returned table, then drop ``IN_PLACE_COLUMNS``.
    """
    entries, _ = settled_side(dictionary_of(table, key, value), max_bytes, max_rows)
    bound_batches(df.sparkSession)
    rows = laid_out(df)
    found = _found(rows, F.flatten(F.array(*tokens(rows))), entries).groupBy(PART, ROW).agg(F.collect_list(F.struct("__k", "__v")).alias(HITS))
    return joined_in_place(rows, found), Found(entries.schema["__v"].dataType)
