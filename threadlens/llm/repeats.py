"""Exact substring dedup by merging sorted suffix lists of shards.

Every text's suffixes are sampled where a window of 400 bytes has its least hashed
32-gram, so two equal windows are sampled at the same place. Each task is a shard that
gives its sampled suffixes with the bytes before them (what a Burrows-Wheeler transform
keeps as the preceding symbol). Suffixes that can be in a repeat meet in buckets of an
equal core; there the shards' lists are merged by iterative interleave refinement: the
interleave starts in shard order and each round refines its blocks by the next eight
bytes, moving only what is still undecided. The round at which neighbours part is their
longest common prefix; no suffix is sorted whole. Rounds over the following bytes and
over the preceding bytes give both interval structures, and a window repeats where an
interval of the one and an interval of the other share two suffixes.

Refining the interleave of the whole corpus byte by byte would take 400 passes over
every byte; the sample, the buckets and the eight-byte rounds give the same intervals.

Passages counted in words, which may have fewer than 400 bytes, are sampled alike: a run of
51 words by the least hash of the 16-word runs in it. Runs whose sample another text has as
well are compared by a hash of the whole run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import encoded, in_batches, pieces, settle, sized_side, written
from threadlens.llm.words import bounds, hash_texts, mix, powers, runs

LENGTH = 400
GRAM = 32
# Windows with up to HALF bytes before their sample share the bytes after it, the others
# those before it; either way a core of this many bytes.
HALF = (LENGTH - GRAM) // 2
CORE = HALF + GRAM
# Words that texts may not share in a row, and of the runs that sample them.
SHARED_WORDS = 51
GRAM_WORDS = 16
_STEP = 1 << 19
_MERGE_ROWS = 20_000
_MERGE_BYTES = 24 << 20


def _least(value: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` values in a row."""
    rows = -(-len(value) // span)
    full = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    full[:len(value)] = value
    grid = full.reshape(rows, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(value) - span + 1
    return np.minimum(behind[:windows], ahead[span - 1:span - 1 + windows])


def _samples(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """For one piece: sample place, first and last window it stands for, and the hashes of
    the cores after and before it (0 where no window needs them)."""
    n = len(data)
    up, down = powers(1 << max(16, n.bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    grams = n - GRAM + 1
    value = mix((total[GRAM:] - total[:grams]) * down[:grams])
    bits = np.uint64(21)
    # The least hash of each window; of equal ones the last.
    value = (value >> bits << bits) | (np.uint64((1 << 21) - 1) - np.arange(grams, dtype=np.uint64))
    least = _least(value, LENGTH - GRAM + 1)
    windows = n - LENGTH + 1
    place = ((1 << 21) - 1) - (least & np.uint64((1 << 21) - 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], windows) - 1
    at = place[first]
    after, before = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    near, far = at - last <= HALF, at - first > HALF
    after[near] = mix((total[at[near] + CORE] - total[at[near]]) * down[at[near]] + np.uint64(1))
    before[far] = mix((total[at[far] + GRAM] - total[at[far] - HALF]) * down[at[far] - HALF] + np.uint64(2))
    return at, first, last, after, before


def samples(text: bytes) -> tuple[np.ndarray, ...]:
    """As ``_samples`` for a text of any length: pieces overlap by a window less one byte, so
    each window is in exactly one of them."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    parts = []
    for start in range(0, len(data) - LENGTH + 1, _STEP):
        at, first, last, after, before = _samples(data[start:start + _STEP + LENGTH - 1])
        parts.append((at + start, first + start, last + start, after, before))
    return tuple(np.concatenate(part) for part in zip(*parts))


def refine(symbols: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the rows inside their blocks, and each row's common prefix with the one
    before it in bytes (-1 where a block begins). ``symbols`` has eight bytes a column."""
    n, rounds = symbols.shape
    order = np.arange(n)
    head = np.ones(n + 1, bool)
    head[1:n] = block[1:] != block[:-1]
    common = np.full(n, 8 * rounds)
    common[head[:n]] = -1
    for step in range(rounds):
        open_ = np.flatnonzero(~(head[:n] & head[1:]))
        if not len(open_):
            break
        symbol = symbols[order[open_], step]
        inner = ~head[open_]
        if (symbol[1:] == symbol[:-1])[inner[1:]].all():
            continue
        moved = np.lexsort((symbol, np.cumsum(head[:n])[open_]))
        order[open_] = order[open_[moved]]
        symbol = symbol[moved]
        part = np.flatnonzero(inner & np.append(False, symbol[1:] != symbol[:-1]))
        differ = symbol[part] ^ symbol[part - 1]
        head[open_[part]] = True
        common[open_[part]] = 8 * step + sum((differ < np.uint64(1 << (8 * k))).astype(int) for k in range(1, 8))
    return order, common


def repeated_offsets(contexts: list[bytes], left: np.ndarray, block: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For rows in block order, which windows repeat: a row for each sample, a column for each
    distance 0 … LENGTH - GRAM from the window's start to the sample. A sample has the
    windows at distances ``least`` to ``most``; ``left`` bytes of its context precede it."""
    def grid(parts: list[bytes], width: int) -> np.ndarray:
        return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), ">u8").astype(np.uint64).reshape(len(parts), -1)

    n = len(contexts)
    right_order, right = refine(grid([c[k:] for c, k in zip(contexts, left)], LENGTH), block)
    left_order, before = refine(grid([c[:k][::-1] for c, k in zip(contexts, left)], LENGTH - GRAM), block)
    out = np.zeros((n, LENGTH - GRAM + 1), bool)
    right_id, left_id = np.empty(n, np.int64), np.empty(n, np.int64)
    for distance in range(int(least.min()), int(most.max()) + 1):
        live = np.flatnonzero((least <= distance) & (distance <= most))
        if len(live) < 2:
            continue
        # Intervals whose suffixes agree on all bytes of the window after and before the sample.
        right_id[right_order] = np.cumsum(right < LENGTH - distance)
        left_id[left_order] = np.cumsum(before < distance)
        key = right_id[live] * (n + 1) + left_id[live]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        out[live[order[1:][same]], distance] = True
        out[live[order[:-1][same]], distance] = True
    return out


def _merged(held: list[tuple]) -> Iterator[tuple[list, list, list]]:
    """Texts and removed spans found in a run of whole buckets."""
    unique: dict[tuple, int] = {}
    member = np.array([unique.setdefault((b, l, s, m, c), len(unique)) for b, _, _, l, s, m, c in held])
    rows = list(unique)
    block = np.array([row[0] for row in rows])
    left = [row[1] for row in rows]
    least, most = np.array([row[2] for row in rows]), np.array([row[3] for row in rows])
    found = repeated_offsets([row[4] for row in rows], left, block, least, most)
    # Equal contexts repeat in all their windows.
    times = np.bincount(member)
    for row in np.flatnonzero(times > 1):
        found[row, least[row]:most[row] + 1] = True
    keys, starts, ends = [], [], []
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    runs: dict[int, list] = {}
    for (row, a), b in zip(np.argwhere(edge == 1).tolist(), np.argwhere(edge == -1)[:, 1].tolist()):
        runs.setdefault(row, []).append((a, b - 1))
    for which, (_, key, place, *_) in zip(member.tolist(), held):
        for near, far in runs.get(which, ()):
            keys.append(key)
            starts.append(place - far)
            ends.append(place - near + LENGTH)
    yield keys, starts, ends


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``key, start, end``: bytes to remove from texts, which may overlap.

    ``key`` is the 64-bit hash of the text. Equal texts of 400 bytes or more repeat whole.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    keyed = rows.withColumn("key", F.xxhash64("text"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in (piece for whole in batches for piece in pieces(whole, "text")):
            cores, places = [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                at = after = before = np.empty(0, np.int64)
                if key not in seen:
                    at, _, _, after, before = samples(text.encode())
                    seen.add(key)
                use = [after != 0, before != 0]
                cores.append(np.concatenate([after[use[0]], before[use[1]]]).astype(np.uint64).view(np.int64))
                places.append(np.concatenate([at[use[0]], -at[use[1]] - 1]))
            offset = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in cores])]), pa.int32())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "key": batch.column("key"), "n_bytes": pa.compute.binary_length(batch.column("text")).cast(pa.int64()),
                "cores": pa.ListArray.from_arrays(offset, pa.array(np.concatenate(cores), pa.int64())),
                "places": pa.ListArray.from_arrays(offset, pa.array(np.concatenate(places), pa.int64()))})

    sampled = written(in_batches(keyed, sample, f"doc_id {kind}, key long, n_bytes long, cores array<long>, places array<long>"), "samples")
    places = sampled.select("key", F.explode(F.arrays_zip("cores", "places")).alias("s")).select(F.col("s.cores").alias("core"), "key", F.col("s.places").alias("place"))
    at = F.struct("key", "place")
    # Kept, so that the join deals both sides anew and may split a core that is very common.
    twice = settle(places.groupBy("core").agg(F.min(at).alias("low"), F.max(at).alias("high")).filter("low != high").select("core"))
    wanted = places.join(twice, "core", "left_semi").distinct().groupBy("key").agg(F.collect_list("place").alias("_places"))
    texts = sampled.groupBy("key").agg(F.min("doc_id").alias("_one"), F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"))
    chosen = texts.join(wanted, "key").select("_one", F.col("key").alias("_key"), "_places")
    # One text of each key that has such samples, with their places.
    given = (keyed.join(sized_side(chosen), F.col("doc_id").eqNullSafe(F.col("_one")) & (F.col("key") == F.col("_key")))
             .select("key", "text", "_places"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()      # a repeated row
        for batch in (piece for whole in batches for piece in pieces(whole, "text")):
            out: list[tuple] = []
            for key, text, wanted in zip(*(batch.column(n).to_pylist() for n in ("key", "text", "_places"))):
                if key in seen:
                    continue
                seen.add(key)
                text, wanted = text.encode(), set(wanted)
                for at, first, last, after, before in zip(*(part.tolist() for part in samples(text))):
                    if after and at in wanted:
                        far = min(at - first, HALF)
                        out.append((after, key, at, far, at - last, far, text[at - far:last + LENGTH]))
                    if before and -at - 1 in wanted:
                        near = max(at - last, HALF + 1)
                        out.append((before, key, at, at - first, near, at - first, text[first:at - near + LENGTH]))
            if out:
                core, key, place, left, least, most, context = zip(*out)
                yield pa.record_batch({"core": np.array(core, np.uint64).view(np.int64), "key": pa.array(key, pa.int64()), "place": pa.array(place, pa.int64()),
                                       "left": pa.array(left, pa.int32()), "least": pa.array(least, pa.int32()), "most": pa.array(most, pa.int32()),
                                       "context": pa.array(context, pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            for keys, starts, ends in _merged(held):
                if keys:
                    yield pa.record_batch({"key": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()), "end": pa.array(ends, pa.int64())})

        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and row[0] != held[-1][0] and (len(held) >= _MERGE_ROWS or size >= _MERGE_BYTES):
                    yield from result(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield from result(held)

    schema = "core long, key long, place long, left int, least int, most int, context binary"
    # The shard is the task that made the suffix; within a bucket, shards come one after another.
    buckets = (in_batches(given, contexts, schema).withColumn("_shard", F.spark_partition_id())
               .repartition("core").sortWithinPartitions("core", "_shard").drop("_shard"))
    found = in_batches(buckets, merge, "key long, start long, end long")
    whole = texts.filter(f"copies > 1 AND n_bytes >= {LENGTH}").select("key", F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    return found.union(whole)


def word_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of ``SHARED_WORDS`` words in a text: its hash, the least hash of the
    16-word runs in it, the text and the first word's index."""
    words, offsets = hash_texts(texts)
    span = SHARED_WORDS - GRAM_WORDS
    if len(words) < SHARED_WORDS:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    value, owner, place = runs(words, offsets, GRAM_WORDS, short=False)
    end = np.cumsum(np.bincount(owner, minlength=len(texts)))
    at = np.flatnonzero(np.arange(len(value)) + span < end[owner])
    name = np.full(len(at), SHARED_WORDS, np.uint64)
    for step in [*range(0, span, GRAM_WORDS), span]:
        name = mix(name + value[at + step])
    least = _least(value, span + 1)[at] if len(at) else name
    return name, least, owner[at], place[at]


def shared_spans(docs: DataFrame) -> DataFrame:
    """``key, start, end``: bytes of runs of ``SHARED_WORDS`` words that another row has as
    well, whatever white space is between them; they may overlap. ``key`` as in
    ``repeated_spans``. Equal texts of so many words are shared whole.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    keyed = rows.withColumn("key", F.xxhash64("text"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, "text")):
            _, least, owner, _ = word_runs(encoded(batch.column("text")))
            new = np.append(True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]))[:len(least)]      # a sample stands for runs that follow one another
            offset = np.searchsorted(owner[new], np.arange(batch.num_rows + 1))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "key": batch.column("key"), "n_bytes": pa.compute.binary_length(batch.column("text")).cast(pa.int64()),
                "grams": pa.ListArray.from_arrays(pa.array(offset, pa.int32()), pa.array(least[new].view(np.int64), pa.int64()))})

    sampled = written(in_batches(keyed, sample, f"doc_id {kind}, key long, n_bytes long, grams array<long>"), "grams")
    grams = sampled.select("key", F.explode("grams").alias("gram"))
    # Kept, so that the joins deal both sides anew and may split what is very common.
    twice = settle(grams.groupBy("gram").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low != high").select("gram"))
    wanted = grams.join(twice, "gram", "left_semi").distinct().groupBy("key").agg(F.collect_list("gram").alias("_grams"))
    texts = sampled.filter("size(grams) > 0").groupBy("key").agg(F.min("doc_id").alias("_one"), F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"))
    chosen = texts.join(wanted, "key").select("_one", F.col("key").alias("_key"), "_grams")
    given = (keyed.join(sized_side(chosen), F.col("doc_id").eqNullSafe(F.col("_one")) & (F.col("key") == F.col("_key")))
             .select("key", "text", "_grams"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, "text")):
            texts = encoded(batch.column("text"))
            name, least, owner, place = word_runs(texts)
            cut = np.searchsorted(owner, np.arange(len(texts) + 1))
            out = []
            for text, key, grams, a, b in zip(texts, batch.column("key").to_pylist(), batch.column("_grams"), cut[:-1], cut[1:]):
                pick = np.flatnonzero(np.isin(least[a:b], grams.values.to_numpy().view(np.uint64))) + a
                start, end = bounds(text)
                out.append((name[pick].view(np.int64), np.full(len(pick), key, np.int64), start[place[pick]], end[place[pick] + SHARED_WORDS - 1]))
            if out:
                yield pa.record_batch([np.concatenate(column) for column in zip(*out)], names=["name", "key", "start", "end"])

    placed = written(in_batches(given, places, "name long, key long, start long, end long"), "runs")
    shared = settle(placed.groupBy("name").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low != high").select("name"))
    whole = texts.filter("copies > 1").select("key", F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    return placed.join(shared, "name", "left_semi").select("key", "start", "end").union(whole)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with ``__starts, __ends``, the spans of each text sorted and apart; null where
    nothing is removed."""
    listed = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("s"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = [], []
            for spans in batch.column("s").to_pylist():
                own: list[list[int]] = []
                for span in spans:
                    if own and span["start"] <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], span["end"])
                    else:
                        own.append([span["start"], span["end"]])
                starts.append([a for a, _ in own])
                ends.append([b for _, b in own])
            yield pa.record_batch({"key": batch.column("key"), "starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64()))})

    apart = in_batches(listed, joined, "key long, starts array<long>, ends array<long>")
    apart = apart.select(F.col("key").alias("__key"), F.col("starts").alias("__starts"), F.col("ends").alias("__ends"))
    return docs.join(sized_side(apart), F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__key"), "left").drop("__key")


def kept(text: bytes, starts: list[int] | None, ends: list[int] | None) -> bytes:
    if not starts:
        return text
    return b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)]))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the removed ``starts, ends``;
    ``n_shared`` bytes at ``shared_starts, shared_ends`` lie in passages of over 50 words that
    another row has as well, which are told and not removed: they may be shorter than a window.

    Null and short texts lose nothing. Rows that repeat repeat each other. Windows are
    judged on the input and never cross texts. Texts are named by a 64-bit hash, so two
    different texts are mixed up with a chance of n**2 / 2**65. Very long texts are sampled
    in pieces that overlap by a window; of equal hashes in a window the last is the sample, so
    ties are settled alike everywhere. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), "text")
    told = with_spans(rows, shared_spans(rows)).withColumnsRenamed({"__starts": "__shared_starts", "__ends": "__shared_ends"})
    rows = with_spans(told, repeated_spans(rows))
    kind = dict(rows.dtypes)["doc_id"]

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, "text")):
            texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
            starts, ends = batch.column("__starts").to_pylist(), batch.column("__ends").to_pylist()
            first, last = batch.column("__shared_starts").to_pylist(), batch.column("__shared_ends").to_pylist()
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "n_removed": pa.array([sum(e or ()) - sum(s or ()) for s, e in zip(starts, ends)], pa.int64()),
                "n_spans": pa.array([len(s or ()) for s in starts], pa.int64()),
                "kept_sha256": [hashlib.sha256(kept(*row)).hexdigest() for row in zip(texts, starts, ends)],
                "starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())),
                "n_shared": pa.array([sum(e or ()) - sum(s or ()) for s, e in zip(first, last)], pa.int64()),
                "shared_starts": pa.array(first, pa.list_(pa.int64())), "shared_ends": pa.array(last, pa.list_(pa.int64()))})

    return in_batches(rows, body, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>, "
                                  "n_shared long, shared_starts array<long>, shared_ends array<long>").withColumnRenamed("doc_id", id_column)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes cut from each text, and passages of over 50 words that
    another text has as well; a character that loses a byte goes with it. A text of which nothing is left stays as an empty text, a null text as null. Columns
    may have any names but those that begin with two underscores."""
    columns = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, "text")):
            texts = [text if not starts else kept(text.encode(), starts, ends).decode("utf-8", "ignore") for text, starts, ends in
                     zip(*(batch.column(n).to_pylist() for n in ("text", "__starts", "__ends")))]
            new = {"text": pa.array(texts, batch.schema.field("text").type)}
            if "n_chars" in columns:
                new["n_chars"] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(name, batch.column(name)) for name in columns], names=columns)

    return in_batches(with_spans(docs, repeated_spans(docs).union(shared_spans(docs))), body, schema)
