"""Document fingerprints by consistent weighted sampling.

Terms are runs of five words, weighted by how often they occur, named by 64-bit hashes.
Variates are drawn from the hash itself, so the terms are not folded together. For every sample and term, two gamma variates and one uniform fix at
which point below its weight the term is drawn; the smallest value wins. Two texts
agree on a sample with a chance equal to the generalised Jaccard similarity of their
weights, the sum of minima over the sum of maxima.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import encoded, in_batches, pieces
from threadlens.llm.words import hash_texts, mix, runs

SAMPLES = 64
SEED = 20240501
WIDTH = 5
# Terms whose variates are drawn at a time, and terms of a text that are compared at a time.
BLOCK = 1 << 8
ROWS = 1 << 11
# Terms of texts whose variates are held together; a text with more draws its own as it goes.
HELD_TERMS = 1 << 17


def variates(term: np.ndarray, samples: int, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """r, log c and b of every term and sample, from a counter-based hash: a gamma variate
    of shape 2 is minus the log of a product of two uniforms."""
    def uniforms(number: int) -> tuple[np.ndarray, np.ndarray]:
        steps = np.array([(seed + (3 * sample + number + 1) * 0x9E3779B97F4A7C15) % (1 << 64) for sample in range(samples)], np.uint64)
        half = mix(term[:, None] + steps).view(np.uint32).reshape(len(term), samples, 2)
        return tuple((half[:, :, k].astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -32) for k in (0, 1))

    (r0, r1), (c0, c1), (b, _) = uniforms(0), uniforms(1), uniforms(2)
    least = np.float32(2.0 ** -25)      # rounding may make both uniforms 1
    return np.maximum(-np.log(r0 * r1), least), np.log(np.maximum(-np.log(c0 * c1), least)), np.minimum(b, np.float32(1 - 2.0 ** -24))


def weights(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms of each text in ascending order, with their counts."""
    words, offsets = hash_texts(texts)
    value, owner, _ = runs(words, offsets, WIDTH, short=True)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(cut[:-1], cut[1:]):
        yield np.unique(value[a:b], return_counts=True)


def signature(term: np.ndarray, count: np.ndarray, seed: int = SEED, universe: int | None = None,
              samples: int = SAMPLES) -> np.ndarray:
    """One 32-bit code a sample: the winning term and its level. All zeros without terms.
    ``universe`` has no effect: terms are told apart by their 64 bits."""
    if not len(term):
        return np.zeros(samples, np.uint32)
    term = mix(term.astype(np.uint64))
    best = np.full(samples, np.inf)
    name, steps = np.zeros(samples, np.uint64), np.zeros(samples, np.int64)
    for at in range(0, len(term), BLOCK):
        own, log = term[at:at + BLOCK], np.log(count[at:at + BLOCK]).astype(np.float32)[:, None]
        r, c, b = variates(own, samples, seed)
        level = np.floor(log / r + b)
        value = c - r * (level - b) - r
        won, every = value.argmin(axis=0), np.arange(samples)
        better = value[won, every] < best
        best = np.where(better, value[won, every], best)
        name, steps = np.where(better, own[won], name), np.where(better, level[won, every].astype(np.int64), steps)
    return (mix(name + mix(steps.astype(np.uint64) + np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


def signatures(texts: list[bytes], seed: int = SEED, samples: int = SAMPLES) -> list[np.ndarray]:
    """``signature`` of each text; what texts have in common is drawn once.

    A term that occurs once in a text is drawn at level 0 whatever the text, so its value
    is the same in all of them.
    """
    out: list[np.ndarray | None] = [None] * len(texts)
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    for at, (term, count) in enumerate(weights(texts)):
        if len(term) > HELD_TERMS:
            out[at] = signature(term, count, seed, samples=samples)
        else:
            if held and sum(len(t) for _, t, _ in held) + len(term) > HELD_TERMS:
                _together(held, out, seed, samples)
                held = []
            held.append((at, term, count))
    if held:
        _together(held, out, seed, samples)
    return out


def _together(held: list[tuple[int, np.ndarray, np.ndarray]], out: list[np.ndarray | None], seed: int, samples: int) -> None:
    all_terms, place = np.unique(np.concatenate([term for _, term, _ in held]), return_inverse=True)
    mixed = mix(all_terms.astype(np.uint64))
    once = np.empty((len(mixed), samples), np.float32)
    for at in range(0, len(mixed), BLOCK):
        r, c, b = variates(mixed[at:at + BLOCK], samples, seed)
        once[at:at + BLOCK] = c - r * (np.float32(0) - b) - r
    every, start = np.arange(samples), 0
    for which, term, count in held:
        own, start = place[start:start + len(term)], start + len(term)
        if not len(term):
            out[which] = np.zeros(samples, np.uint32)
            continue
        best = np.full(samples, np.inf)
        name, steps = np.zeros(samples, np.uint64), np.zeros(samples, np.int64)
        for at in range(0, len(term), ROWS):
            rows, times = own[at:at + ROWS], count[at:at + ROWS]
            value = once[rows]
            many = np.flatnonzero(times > 1)
            level = None
            if len(many):
                level = np.zeros(value.shape, np.float32)
                r, c, b = variates(mixed[rows[many]], samples, seed)
                level[many] = np.floor(np.log(times[many]).astype(np.float32)[:, None] / r + b)
                value[many] = c - r * (level[many] - b) - r
            won = value.argmin(axis=0)
            better = value[won, every] < best
            best = np.where(better, value[won, every], best)
            name = np.where(better, mixed[rows[won]], name)
            steps = np.where(better, 0 if level is None else level[won, every].astype(np.int64), steps)
        out[which] = (mix(name + mix(steps.astype(np.uint64) + np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of samples that agree: the estimate of the generalised Jaccard similarity."""
    return float((a == b).mean())


def id_buckets(ids: DataFrame, count: int) -> list[int]:
    """Ascending cut points of the ids, at most ``count`` of them."""
    cuts = ids.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10_000)).first()[0] if count > 1 else None
    return sorted(set(cuts or []))


def bucket_of(column: str, cuts: list[int]) -> F.Column:
    """How many cut points are at or below the value, found in two steps of a root's length."""
    if not cuts:
        return F.lit(0)
    width = max(1, int(len(cuts) ** 0.5))
    coarse = F.array(*[F.lit(c).cast("long") for c in cuts[::width]])
    fine = F.from_json(F.lit(str([cuts[at:at + width] for at in range(0, len(cuts), width)])), "array<array<bigint>>")
    value = F.col(column)
    step = F.size(F.filter(coarse, lambda c: c <= value))
    inner = F.size(F.filter(F.get(fine, step - 1), lambda c: c <= value))
    return F.when(value.isNull() | (step == 0), 0).otherwise((step - 1) * width + inner).cast("int")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likenesses.

    The edited text replaces the last half by the start of the next text in id order
    (after the last: the first). Texts are dealt once to ranges of ids; the first text
    of each range also goes to the range before it, so no other shuffle is needed.
    Null texts are empty; the fingerprint of a text without words is all zeros. Rows
    with equal ids follow one another by text; null ids come first. A single row
    follows itself. An empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = id_buckets(rows, count)
    rows = rows.withColumn("bucket", bucket_of("doc_id", cuts))
    # One id for each range: its first; a driver-side list as long as the number of ranges.
    firsts = rows.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("f")).collect()
    firsts = sorted((row["bucket"], row["f"]["doc_id"]) for row in firsts) if firsts else []
    guests = [(firsts[at][1], firsts[at - 1][0]) for at in range(len(firsts))]
    if not guests:
        return spark.createDataFrame([], f"{id_column} {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double")
    also = F.broadcast(spark.createDataFrame(guests, f"first {kind}, also int"))     # one row a range
    dealt = (rows.join(also, rows["doc_id"].eqNullSafe(also["first"]), "left")
             .select("doc_id", "text", F.explode(F.array_compact(F.array(
                 F.struct("bucket", F.lit(False).alias("guest")),
                 F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("bucket"), F.lit(True).alias("guest")))))).alias("d"))
             .select("doc_id", "text", F.col("d.bucket").alias("bucket"), F.col("d.guest").alias("guest"))
             .repartitionById(count, "bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text"))

    def consecutive(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Lists of (id, text, next text) holding a few MB; a range ends at its first guest."""
        held, out, size = None, [], 0
        for batch in batches:
            for bucket, guest, doc, text in zip(*(batch.column(n).to_pylist() for n in ("bucket", "guest", "doc_id", "text"))):
                if held and held[0] == bucket:
                    out.append((held[1], held[2], text))
                    size += 2 * len(held[2])
                held = None if guest else (bucket, doc, text)
                if size > 1 << 20:
                    yield out
                    out, size = [], 0
        if out:
            yield out

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in consecutive(batches):
            edited = []
            for _, text, after in rows:
                half = len(text) // 2
                edited.append((text[:len(text) - half] + after[:half]).encode())
            # Within a run the next text's signature is the next row's.
            other = [at for at in range(len(rows)) if at + 1 == len(rows) or rows[at + 1][1] is not rows[at][2]]
            made = signatures([part for (_, text, _), new in zip(rows, edited) for part in (text.encode(), new)] + [rows[at][2].encode() for at in other])
            own, changed = made[:2 * len(rows):2], made[1:2 * len(rows):2]
            extra = dict(zip(other, made[2 * len(rows):]))
            after = [extra[at] if at in extra else own[at + 1] for at in range(len(rows))]
            yield pa.record_batch({
                "id": pa.array([row[0] for row in rows]),
                "n_chars": pa.array([len(row[1]) for row in rows], pa.int64()),
                "edited_sha256": [hashlib.sha256(text).hexdigest() for text in edited],
                "fingerprint": [s.astype(">u4").tobytes().hex() for s in own],
                "edited_fingerprint": [s.astype(">u4").tobytes().hex() for s in changed],
                "near_edited": [likeness(a, b) for a, b in zip(own, changed)],
                "near_next": [likeness(a, b) for a, b in zip(own, after)],
            })

    return in_batches(dealt, body, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("id", id_column)
