"""Sharding by a Hilbert curve over metadata.

Language, source and length become cells of a cube: the named values in order at equal
depth (each cell holds about as many rows), the length on a logarithmic scale. Texts are
sorted by the cube's Hilbert index and cut into runs, so each shard covers a compact box
of all dimensions and readers can skip files by any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import in_batches, settle, sized_side

BITS = 8
SHARDS = 16


def hilbert_index(axes: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Index on the curve through a cube of ``2**bits`` cells a side, by Skilling's transform."""
    x = [np.array(axis, np.int64) for axis in axes]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            out = (out << 1) | (((axis ^ flip) >> bit) & 1)
    return out


def named_cells(rows: DataFrame, column: str) -> DataFrame:
    """Cell of each distinct value: its rows' place in the order of values, at equal depth."""
    before = Window.orderBy(F.col(column).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (rows.groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
            .withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
            .withColumn("_all", F.sum("_c").over(whole))
            .select(F.col(column).alias(f"_{column}_value"), F.expr(
                f"cast(_before * {1 << BITS} div _all as int)").alias(f"_{column}_cell")))


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id") -> DataFrame:
    """Shard and slot of every text; shards differ by one row at most.

    Ties on the curve go by id, checksum and size; rows that tie on all of them are
    alike in the result. A null or empty text has size 1 and checksum 0; null values of
    a dimension form a cell of their own, the first. A hot value only fills its cells:
    the sort splits equal indexes by id. An empty table gives no rows.
    """
    rows = settle(docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_bytes"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("_chars"), "lang", "source"))
    cells = rows
    for column in ("lang", "source"):
        values = sized_side(named_cells(rows, column))
        cells = cells.join(values, cells[column].eqNullSafe(values[f"_{column}_value"])).drop(f"_{column}_value")
    # Eight cells for each doubling of the length; 256 of them reach 2**32.
    length = F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(F.col("_chars") + 1) * 8)).cast("int")
    narrow = cells.select("doc_id", (F.col("_bytes") + 1).alias("size"), "text_crc32",
                          F.col("_lang_cell").alias("a"), F.col("_source_cell").alias("b"), length.alias("c"))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = hilbert_index([batch.column(name).to_numpy() for name in "abc"])
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "size": batch.column("size"),
                                   "text_crc32": batch.column("text_crc32"), "hilbert": index})

    kind = dict(narrow.dtypes)["doc_id"]
    curve = in_batches(narrow, body, f"doc_id {kind}, size long, text_crc32 long, hilbert long")
    order = ("hilbert", "doc_id", "text_crc32", "size")
    ordered = settle(curve.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_id", F.monotonically_increasing_id()))
    # One row for each sorted partition: where it starts in the whole order.
    part = F.shiftright("_id", 33).alias("_part")
    starts = (ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_start", F.coalesce(F.sum("_c").over(
                  Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_all", F.sum("_c").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
              .select("_part", "_start", "_all"))
    return (ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn("_at", F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1))
            .withColumn("shard", F.expr(f"cast(_at * {shards} div _all as int)"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.expr(f"_at - (shard * _all + {shards - 1}) div {shards}").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "hilbert"))
