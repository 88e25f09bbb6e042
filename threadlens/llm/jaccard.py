"""N-gram Jaccard join with adaptive multi-match prefixes.

Each text is the set of its distinct 5-word shingles, ordered from the rarest by an
estimate of how many texts hold each. Two sets with a Jaccard similarity of 0.8 share
at least L of the first ``n - ceil(0.8 n) + L`` shingles of that order, for every L up
to the overlap. A text takes the L for which the estimated cost of its candidates is
least: a longer prefix reads more postings, but asks for L matches before a pair is
verified. What a pair may use of both prefixes is narrowed further by its two sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import encoded, in_batches, pieces, settle, sized_side, written
from threadlens.llm.components import components
from threadlens.llm.words import distinct, hash_texts, mix, runs

WIDTH = 5
# Counters of the frequency sketch, whatever the corpus: what the executors receive.
CELLS = 1 << 22
CHUNK = 1 << 14
# Chunks that a task hands on at a time.
CHUNKS_SENT = 32
MOST_MATCHES = 4
# Cost of verifying one candidate, in postings read.
VERIFY_COST = 20.0
# Postings of shingles that may be in so many texts (and 8 times the average counter)
# are dealt over tasks by their text as well.
HOT = 10_000
SPLITS = 32


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and offsets."""
    words, offsets = hash_texts([text.lower() for text in texts])     # bytes.lower changes A-Z only
    value, owner, _ = runs(words, offsets, WIDTH, short=True)
    return distinct(value, owner, len(texts))


def signatures(value: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (0 for the empty one); equal sets have equal names."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value + np.uint64(0x5851F42D4C957F2D)))])
    name = mix(total[cut[1:]] - total[cut[:-1]] + np.diff(cut).astype(np.uint64))
    return np.where(np.diff(cut) > 0, name, 0).astype(np.uint64)


def cell_of(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(42)).astype(np.int64)


def describe(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, sig, n`` of every text, and the sketch: how often each counter's shingles
    occur over all texts, never less than any of them does."""
    kind = dict(docs.dtypes)["doc_id"]

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        none = None
        for whole in batches:
            none = whole.column("doc_id").type
            for batch in pieces(whole, "text"):
                value, cut = shingle_sets(encoded(batch.column("text")))
                at, times = np.unique(cell_of(value), return_counts=True)      # no second array of all counters
                cells[at] += times.astype(np.uint32)
                size = batch.num_rows
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "sig": signatures(value, cut).view(np.int64),
                                       "n": np.diff(cut), "chunk": pa.nulls(size, pa.int32()), "counts": pa.nulls(size, pa.binary())})
        if none is not None:
            pack = zstandard.ZstdCompressor(level=3).compress
            for first in range(0, CELLS // CHUNK, CHUNKS_SENT):
                chunks = range(first, min(first + CHUNKS_SENT, CELLS // CHUNK))
                blobs = [pack(cells[k * CHUNK:(k + 1) * CHUNK].tobytes()) for k in chunks]
                size = len(blobs)
                yield pa.record_batch({"doc_id": pa.nulls(size, none), "sig": pa.nulls(size, pa.int64()), "n": pa.nulls(size, pa.int64()),
                                       "chunk": pa.array(chunks, pa.int32()), "counts": blobs})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, np.int64)
        for blob in rows["counts"]:
            total += np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint32)
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "counts": [zstandard.ZstdCompressor().compress(total.tobytes())]})

    both = written(in_batches(docs, body, f"doc_id {kind}, sig long, n long, chunk int, counts binary"), "shingles")
    sketch = np.zeros(CELLS, np.int64)
    summed = both.filter("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, counts binary")
    for row in summed.collect():        # CELLS counters in all
        sketch[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row["counts"])), np.int64)
    return both.filter("chunk is null").select("doc_id", "sig", "n"), sketch


def matches_for(cost: np.ndarray, n: int) -> int:
    """The number of matches with the least estimated cost for a set of ``n`` shingles in
    prefix order, given how many postings each of them is estimated to have."""
    overlap = (4 * n + 4) // 5
    read = np.cumsum(cost[:n - overlap + MOST_MATCHES])
    best, least = 1, None
    for matches in range(1, min(MOST_MATCHES, overlap) + 1):
        total = read[n - overlap + matches - 1] * (1 + VERIFY_COST / matches)
        if least is None or total < least:
            best, least = matches, total
    return best


def postings(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``token, sig, n, pos, matches`` of every distinct set's prefix, without the tokens that
    one set alone has. ``pos`` counts from 1 in the order of estimated frequency."""
    level = np.floor(4 * np.log2(np.maximum(sketch, 1))).astype(np.uint8)
    extra = np.maximum(sketch - sketch.mean(), 1).astype(np.float32)
    hot = np.packbits(sketch > HOT + 8 * sketch.mean())
    sent = docs.sparkSession.sparkContext.broadcast((level, np.round(np.log2(extra) * 8).astype(np.uint8), hot))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, cost, hot = sent.value
        hot = np.unpackbits(hot)
        seen: set[int] = set()
        for whole in batches:
            for batch in pieces(whole, "text"):
                value, cut = shingle_sets(encoded(batch.column("text")))
                names = signatures(value, cut).view(np.int64).tolist()
                cells = cell_of(value)
                parts = []
                for at, name in enumerate(names):
                    n = int(cut[at + 1] - cut[at])
                    if not n or name in seen:
                        continue
                    seen.add(name)
                    own, where = value[cut[at]:cut[at + 1]], cells[cut[at]:cut[at + 1]]
                    length = n - (4 * n + 4) // 5 + MOST_MATCHES
                    rank = np.argsort(level[where], kind="stable")[:length]      # hashes ascend already
                    matches = matches_for(np.exp2(cost[where[rank]] / 8.0), n)
                    rank = rank[:n - (4 * n + 4) // 5 + matches]
                    parts.append((own[rank], name, n, matches, hot[where[rank]]))
                if not parts:
                    continue
                size = [len(part[0]) for part in parts]
                name = np.repeat(np.array([part[1] for part in parts], np.int64), size)
                is_hot = np.concatenate([part[4] for part in parts]).astype(bool)
                yield pa.record_batch({
                    "token": np.concatenate([part[0] for part in parts]).view(np.int64), "sig": name,
                    "n": np.repeat(np.array([part[2] for part in parts], np.int32), size),
                    "pos": np.concatenate([np.arange(1, k + 1, dtype=np.int32) for k in size]),
                    "matches": np.repeat(np.array([part[3] for part in parts], np.int32), size),
                    "split": np.where(is_hot, name % SPLITS, -1).astype(np.int32)})

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows in token order: once each set that shares its token, and all of hot tokens."""
        held, told = None, True      # the last row so far, and whether it has been given out
        for batch in batches:
            token, name = batch.column("token").to_numpy(), batch.column("sig").to_numpy()
            before = held.column("token")[0].as_py() if held is not None else None
            same = np.concatenate([[before is not None and token[0] == before], token[1:] == token[:-1]])
            again = same & np.concatenate([[held is not None and name[0] == held.column("sig")[0].as_py()], name[1:] == name[:-1]])
            fresh = np.flatnonzero(~again)
            if not len(fresh):
                continue
            batch, token, same = batch.take(pa.array(fresh)), token[fresh], same[fresh]
            if held is not None and not told and same[0]:
                yield held
            give = same | np.append(same[1:], False) | (batch.column("split").to_numpy() >= 0)
            yield batch.filter(pa.array(give))
            held, told = batch.slice(batch.num_rows - 1), bool(give[-1])

    schema = "token long, sig long, n int, pos int, matches int, split int"
    dealt = in_batches(docs, body, schema).repartition("token", "split").sortWithinPartitions("token", "sig")
    return written(in_batches(dealt, shared, schema).drop("split"), "postings")


def pair_level(a: str, b: str) -> F.Column:
    """The least L whose prefixes, narrowed by both sizes, hold the token in both sets."""
    overlap = f"((4 * ({a}n + {b}n) + 8) div 9)"
    return F.expr(f"greatest({a}pos - ({a}n - {overlap}), {b}pos - ({b}n - {overlap}))")


def matched(shared: DataFrame) -> DataFrame:
    """Pairs that share as many prefix tokens as the lesser of their two demands asks, of rows
    with both sides' columns prefixed ``a_`` and ``b_``."""
    kept = (shared.filter("5 * least(a_n, b_n) >= 4 * greatest(a_n, b_n)")
            .withColumn("level", F.greatest(pair_level("a_", "b_"), F.lit(1)))
            .withColumn("asked", F.least("a_matches", "b_matches"))
            .filter("level <= asked"))
    counts = kept.groupBy("a_sig", "b_sig").agg(
        F.first("asked").alias("asked"), F.count(F.lit(1)).alias("tokens"),
        *[F.count_if(F.col("level") <= k).alias(f"c{k}") for k in range(1, MOST_MATCHES + 1)])
    # What overlaps by m has k of its tokens in the k-prefixes, for every k up to what is asked.
    enough = F.lit(True)
    for k in range(1, MOST_MATCHES + 1):
        enough = enough & ((F.col("asked") < k) | (F.col(f"c{k}") >= k))
    return counts.filter(enough).select("a_sig", "b_sig", "tokens")


def enough(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Of pairs ``a, b`` that share the first token they can, those that share as many prefix
    tokens as asked. Each pair meets the two prefixes in one row."""
    prefix = (kept.groupBy("sig").agg(F.first("n").alias("n"), F.first("matches").alias("matches"),
                                      F.sort_array(F.collect_list(F.struct("token", "pos"))).alias("p"))
              .select("sig", "n", "matches", F.col("p.token").alias("token"), F.col("p.pos").alias("pos")))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = {}
            for name in ("a_token", "a_pos", "b_token", "b_pos"):      # views of the batch, no Python objects
                column = batch.column(name)
                held[name] = column.values.to_numpy(), column.offsets.to_numpy()
            n_a, n_b, m_a, m_b = (batch.column(name).to_numpy() for name in ("a_n", "b_n", "a_matches", "b_matches"))
            overlap = (4 * (n_a + n_b) + 8) // 9
            keep = np.zeros(batch.num_rows, bool)
            for i, asked in enumerate(np.minimum(m_a, m_b)):
                a, i_pos, b, j_pos = (value[at[i]:at[i + 1]] for value, at in held.values())
                _, x, y = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                level = np.sort(np.maximum(i_pos[x] - (n_a[i] - overlap[i]), j_pos[y] - (n_b[i] - overlap[i])))
                keep[i] = len(level) >= asked and (level[:asked] <= np.arange(1, asked + 1)).all()
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def side(name: str) -> DataFrame:
        return prefix.select(F.col("sig").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n", "matches", "token", "pos")])

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return in_batches(both, body, "a long, b long")


def sets_of(docs: DataFrame, described: DataFrame, names: DataFrame) -> DataFrame:
    """``sig, tokens`` (packed hashes) of the named sets, from one text each."""
    # Copies are reduced in their tasks, before they meet.
    one = described.groupBy("sig").agg(F.min("doc_id").alias("_one")).join(names, "sig").select("_one").distinct()
    chosen = docs.join(sized_side(one), F.col("doc_id").eqNullSafe(F.col("_one")), "left_semi")

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                value, cut = shingle_sets(encoded(batch.column("text")))
                yield pa.record_batch({"sig": signatures(value, cut).view(np.int64),
                                       "tokens": pa.array([value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())})

    return written(in_batches(chosen, body, "sig long, tokens binary").dropDuplicates(["sig"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets have 100 * intersection >= 80 * union."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a_tokens").to_pylist(), batch.column("b_tokens").to_pylist()):
                both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= 80 * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = pairs.join(sets.select(F.col("sig").alias("a"), F.col("tokens").alias("a_tokens")), "a")
    both = first.join(sets.select(F.col("sig").alias("b"), F.col("tokens").alias("b_tokens")), "b")
    return in_batches(both.select("a", "b", "a_tokens", "b_tokens"), body, "a long, b long")


def similar_classes(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every text.

    First each set is verified against the most central set among those that share its
    prefix tokens; classes found so need no pairs inside them. Then all pairs between
    different classes that share enough prefix tokens are verified, so no link between
    classes is lost. Equal sets are one node from the start.

    Null and empty texts have no shingles and stand alone; fewer than five words are one
    shingle. Rows that repeat give equal rows; a null id takes the least known id of its
    class, if any. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), "text")
    described, sketch = describe(rows)
    kept = postings(rows, sketch)

    # How much of a set's prefix others share: copies' own edits are in no other set.
    central = kept.groupBy("sig").agg((F.count(F.lit(1)) / F.first("n")).alias("central"))
    weighed = kept.join(central, "sig")
    hub = (weighed.groupBy("token").agg(F.max(F.struct("central", "sig", "n", "pos", "matches")).alias("h"))
           .select("token", *[F.col(f"h.{c}").alias(f"b_{c}") for c in ("sig", "n", "pos", "matches")]))
    side = [F.col(c).alias(f"a_{c}") for c in ("sig", "n", "pos", "matches")]
    stars = (matched(kept.select("token", *side).join(hub, "token").filter("a_sig != b_sig"))
             .groupBy("a_sig").agg(F.max(F.struct("tokens", "b_sig")).alias("t"))
             .select(F.col("a_sig").alias("a"), F.col("t.b_sig").alias("b")))
    stars = settle(stars)
    sets = sets_of(rows, described, stars.select(F.col("a").alias("sig")).union(stars.select("b")).distinct())
    links = settle(verified(stars, sets))
    roots = components(links)

    placed = (kept.join(sized_side(roots), F.col("sig") == F.col("node"), "left")
              .select("token", *side, F.coalesce("root", "sig").alias("root")))
    open_ = (placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .filter("low != high").select("token"))
    across = settle(placed.join(open_, "token"))
    other = across.select("token", *[F.col(f"a_{c}").alias(f"b_{c}") for c in ("sig", "n", "pos", "matches")], F.col("root").alias("b_root"))
    # The first token that two similar sets share is in the 1-prefix of both, as their two
    # sizes narrow it; asking for it in the join keeps classes of near copies from meeting.
    first = ("a_sig < b_sig AND root != b_root AND 5 * least(a_n, b_n) >= 4 * greatest(a_n, b_n)")
    near = (across.join(other, "token").filter(first).filter(pair_level("a_", "b_") <= 1)
            .select(F.col("a_sig").alias("a"), F.col("b_sig").alias("b")).distinct())
    pairs = (enough(near, kept)
             .join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    pairs = settle(pairs)
    more = sets_of(rows, described, pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
                   .join(sets.select("sig"), "sig", "left_anti"))
    links = links.union(verified(pairs, sets.union(more)))
    roots = components(links)

    classes = (described.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("c"))
               .join(sized_side(roots), F.col("sig") == F.col("node"), "left")
               .select("sig", "least", "c", F.coalesce("root", "sig").alias("root")))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("c").alias("members")).filter("members > 1")
    named = classes.join(least, "root").select(F.col("sig").alias("_sig"), "component_id")
    return (described.join(sized_side(named), F.col("sig") == F.col("_sig"), "left")
            .select(F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its class; of rows that repeat, one.

    Rows without an id stay unless their class has an id.
    """
    first = (similar_classes(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .select(F.col("doc_id").alias("__kept")).distinct())
    stay = docs.join(sized_side(first), F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")
    again = settle(docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("__again")))
    if again.isEmpty():
        return stay
    same = F.col("doc_id").eqNullSafe(F.col("__again"))
    side = sized_side(again)
    return stay.join(side, same, "left_anti").union(stay.join(side, same, "left_semi").dropDuplicates(["doc_id", "text"]))
