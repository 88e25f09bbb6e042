"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours.

Rebuilt conversations are sorted by the digests of their turns. The trie is the forest
that joining neighbours in descending order of their common prefix gives: every merge
of components is a branching node, and the first conversation of a component brings the
nodes of its own stretch. Each sorted partition is first contracted to what its
neighbours can see of it, a list of blocks with falling common prefixes; the contracted
forests are merged across the boundaries in two passes over one row a partition; then
every partition joins its own conversations between its two contexts and writes out
the nodes that its conversations bring.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import in_batches, settle, written

DIGEST = 16
HUNDRED = 100
HEADS = 6
# Characters of joined ids that go into one row where a list of ids crosses partitions.
CHUNK_CHARS = 1 << 20
ROWS = 1 << 16
# Contexts of all partitions are broadcast up to this size and joined by a shuffle beyond.
CONTEXT_MAX_BYTES = 32 << 20

_BLOCKS = "array<struct<edge:bigint,n:bigint,least:bigint,leaves:bigint,saved:bigint,children:bigint>>"
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``(conv_id, seq, sizes)``: the digests of the rebuilt turns, end to end, and their code points.

    Turns are ordered by number, null first, and by digest where numbers tie. Rows
    without a conv_id belong to no conversation. One shuffle serves it all: conversations
    of a hundred lie together with the one that gives them their first turns. A
    conversation is one row, with 16 bytes and a number for each turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = (conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.length(text).alias("chars"))
        .withColumn("_base", F.expr(f"conv_id - conv_id % {HUNDRED}")).repartition("_base"))
    whole = turns.groupBy("_base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "chars"))).alias("own"))
    first = F.first(F.when(F.col("conv_id") == F.col("_base"), F.slice("own", 1, HEADS - 1)), ignorenulls=True)
    taken = F.crc32(F.col("conv_id").cast("string")) % HEADS
    both = (whole.withColumn("head", F.coalesce(first.over(Window.partitionBy("_base")), F.slice("own", 1, 0)))
            .withColumn("taken", taken.cast("int"))
            .select("conv_id", F.concat(F.slice("head", F.lit(1), F.col("taken")),
                                        F.slice("own", F.col("taken") + 1, F.size("own"))).alias("turns")))
    return both.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("seq"),
                       F.transform("turns", lambda t: t["chars"].cast("long")).alias("sizes"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many first turns two sequences share, by halving what is not yet known equal."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * DIGEST:mid * DIGEST] == b[low * DIGEST:mid * DIGEST]:
            low = mid
        else:
            high = mid - 1
    return low


@dataclass
class Block:
    """Conversations beyond a boundary that are seen as one: they share ``edge`` turns with
    what is nearer, and more among themselves. ``saved`` sums the code points each
    shares with the one before it, ``children`` counts branches at depth ``edge``."""
    edge: int
    n: int
    least: int
    leaves: int
    saved: int
    children: int

    def absorb(self, other: Block) -> None:
        self.n += other.n
        self.least = min(self.least, other.least)
        self.leaves += other.leaves
        self.saved += other.saved
        if other.edge == self.edge:
            self.children += other.children


def contracted(blocks: Iterator[Block]) -> list[Block]:
    """Blocks with strictly falling edges; a block that shares as much with the one before
    it as that with what is nearer, or more, is a part of it."""
    out: list[Block] = []
    for block in blocks:
        if out and block.edge >= out[-1].edge:
            out[-1].absorb(block)
        else:
            out.append(block)
    return out


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """``(part, conv_id, sequence, code points of the first k turns)`` row by row."""
    for batch in batches:
        sizes, columns = batch.column("sizes"), (batch.column(c).to_pylist() for c in ("part", "conv_id", "seq"))
        sums = np.concatenate([[0], np.cumsum(sizes.flatten().to_numpy(zero_copy_only=False))]).astype(np.int64)
        ends = np.cumsum([0, *sizes.value_lengths().to_pylist()])
        for at, (part, conv, seq) in enumerate(zip(*columns)):
            yield part, conv, seq, sums[ends[at]:ends[at + 1] + 1] - sums[ends[at]]


_SUMMARY = ("part int, first_conv long, first_seq binary, first_sums array<bigint>, last_seq binary, "
            f"`right` {_BLOCKS}, `left` {_BLOCKS}")


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each partition: its outer conversations and what is seen of it from the
    left (``right``) and from the right (``left``). Edges across the boundary, and whether
    the last conversation is a leaf, are not known yet."""
    part = first = last = None
    right: list[Block] = []
    left: list[Block] = []
    for part, conv, seq, sums in _conversations(batches):
        if last is None:
            first = (conv, seq, sums.tolist())
            right, left = [Block(-1, 1, conv, 0, 0, 0)], [Block(-1, 1, conv, 0, 0, 0)]
        else:
            edge, turns = common_turns(last, seq), len(seq) // DIGEST
            right[-1].leaves += edge < len(last) // DIGEST
            own = Block(edge, 1, conv, 0, int(sums[edge]), int(turns > edge))
            if len(right) == 1 or edge < right[-1].edge:
                right.append(own)
            else:
                right[-1].absorb(own)
            left[-1].edge = edge
            while len(left) > 1 and left[-2].edge >= edge:
                left[-1].least = min(left[-1].least, left.pop(-2).least)
            left.append(Block(-1, 1, conv, 0, 0, 0))
        last = seq
    if last is not None:
        yield pa.RecordBatch.from_pylist([{
            "part": part, "first_conv": first[0], "first_seq": first[1], "first_sums": first[2], "last_seq": last,
            "right": [vars(b) for b in right], "left": [vars(b) for b in reversed(left)]}], schema=_summary_type())


def _block_type() -> pa.DataType:
    return pa.list_(pa.struct([(name, pa.int64()) for name in Block.__annotations__]))


def _summary_type() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("first_conv", pa.int64()), ("first_seq", pa.binary()), ("first_sums", pa.list_(pa.int64())),
                      ("last_seq", pa.binary()), ("right", _block_type()), ("left", _block_type())])


_RIGHT = f"part int, ahead {_BLOCKS}, same_ahead boolean"
_LEFT = f"part int, first_conv long, behind {_BLOCKS}"


def seen_ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last partition to the first: what each sees to its right."""
    kept: tuple[bytes, list[int], list[Block]] | None = None
    for batch in batches:
        for row in batch.to_pylist():
            ahead, edge, same = [], -1, False
            if kept:
                seq, sums, blocks = kept
                edge, same = common_turns(row["last_seq"], seq), row["last_seq"] == seq
                blocks[0].edge, blocks[0].saved = edge, blocks[0].saved + sums[edge]
                blocks[0].children = int(len(seq) // DIGEST > edge)
                ahead = contracted(blocks)
            yield pa.RecordBatch.from_pylist([{"part": row["part"], "ahead": [vars(b) for b in ahead], "same_ahead": same}], schema=pa.schema(
                [("part", pa.int32()), ("ahead", _block_type()), ("same_ahead", pa.bool_())]))
            own = [Block(**b) for b in row["right"]]
            own[-1].leaves += edge < len(row["last_seq"]) // DIGEST
            kept = row["first_seq"], row["first_sums"], own + ahead


def seen_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first partition to the last: what each sees to its left."""
    kept: tuple[bytes, list[Block]] | None = None
    for batch in batches:
        for row in batch.to_pylist():
            behind = []
            if kept:
                kept[1][0].edge = common_turns(kept[0], row["first_seq"])
                behind = contracted(kept[1])
            yield pa.RecordBatch.from_pylist(
                [{"part": row["part"], "first_conv": row["first_conv"], "behind": [vars(b) for b in behind]}],
                schema=pa.schema([("part", pa.int32()), ("first_conv", pa.int64()), ("behind", _block_type())]))
            kept = row["last_seq"], [Block(**b) for b in row["left"]] + behind


class Forest:
    """Components of a row of conversations and contexts, joined by union-find."""

    def __init__(self, size: int):
        self.up = list(range(size))
        self.first = list(range(size))
        self.depth, self.n, self.least, self.leaves, self.saved, self.children, self.entry = ([0] * size for _ in range(7))

    def find(self, at: int) -> int:
        up = self.up
        while up[at] != at:
            up[at] = up[up[at]]
            at = up[at]
        return at

    def merge(self, a: int, b: int, depth: int) -> int:
        """Join the component ``b``, right of ``a``, to it at a depth; branches below count."""
        branches = sum(1 if self.depth[x] > depth else self.children[x] for x in (a, b))
        if self.n[a] < self.n[b]:
            a, b, first, second = b, a, a, b
        else:
            first, second = a, b
        start = self.first[first]
        self.saved[a] = self.saved[first] + self.saved[second] + self.entry[self.first[second]]
        self.up[b], self.first[a], self.depth[a], self.children[a] = a, start, depth, branches
        self.n[a] += self.n[b]
        self.leaves[a] += self.leaves[b]
        self.least[a] = min(self.least[a], self.least[b])
        return a


def join_partition(part: int, convs: list[int], lengths: list[int], edges: list[int], sums: list[np.ndarray],
                   behind: list[Block], ahead: list[Block], same_ahead: bool) -> Iterator[pa.RecordBatch]:
    """Nodes that the conversations of one partition bring. ``edges[i]`` are the turns that
    conversation ``i`` shares with the one before it; -1 at the very start."""
    lead, m = len(behind), len(convs)
    forest = Forest(lead + m + len(ahead))
    joins: list[tuple[int, int]] = []       # (depth, right element)
    for at, block in enumerate(reversed(behind)):
        forest.n[at], forest.least[at], forest.depth[at] = block.n, block.least, block.edge
        if at:
            joins.append((behind[lead - at].edge, at))
    after = ahead[0].edge if ahead else -1
    for i in range(m):
        at = lead + i
        forest.n[at], forest.least[at], forest.depth[at] = 1, convs[i], lengths[i]
        forest.leaves[at] = int((edges[i + 1] if i + 1 < m else after) < lengths[i])
        if edges[i] >= 0:
            forest.entry[at] = int(sums[i][edges[i]])
            joins.append((edges[i], at))
    for k, block in enumerate(ahead):
        at = lead + m + k
        forest.n[at], forest.least[at], forest.depth[at] = block.n, block.least, block.edge
        forest.leaves[at], forest.children[at], forest.entry[at] = block.leaves, block.children, block.saved
        joins.append((block.edge, at))

    found: list[list[int | None]] = []      # element, top and bottom depth, n, least, leaves, saved, children, parent

    def stretch(x: int, top: int) -> list[int | None] | None:
        own = forest.first[x] - lead
        if not 0 <= own < m:
            return None
        row = [own, top, forest.depth[x], forest.n[x], forest.least[x], forest.leaves[x], forest.saved[x], forest.children[x], None]
        found.append(row)
        return row

    joins.sort(key=lambda join: -join[0])
    continued = lengths[0] if lead and edges[0] == lengths[0] else None
    run_node, waiting = None, []
    for place, (depth, at) in enumerate(joins):
        a, b = forest.find(at - 1), forest.find(at)
        for x in (a, b):
            if forest.depth[x] > depth:
                row = stretch(x, depth + 1)
                if row:
                    waiting.append((row, at))
        forest.merge(a, b, depth)
        if place + 1 == len(joins) or joins[place + 1][0] < depth:
            for row, member in waiting:
                row[-1] = forest.least[forest.find(member)]
            waiting = []
            if depth == continued:
                run_node = forest.least[forest.find(lead)]
    stretch(forest.find(lead), 0)

    ends: dict[int, str | None] = {}        # digest of the ids that end at a conversation's own node
    crossing: list[tuple[int, int, int]] = []       # conversation that brings the node or -1, first and last of the run
    start = 0
    for i in range(1, m + 1):
        if i < m and edges[i] == lengths[i] == lengths[i - 1]:
            continue
        brings = start > 0 or continued is None
        open_end = i == m and same_ahead
        if brings and not open_end:
            ends[start] = hashlib.sha256(",".join(map(str, convs[start:i])).encode()).hexdigest()
        else:
            if brings:
                ends[start] = None
            crossing.append((start if brings else -1, start, i))
        start = i
    yield from _nodes(found, ends, sums)
    bottoms = {row[0]: row for row in found if row[2] == lengths[row[0]]}
    for owner, a, z in crossing:
        conv = bottoms[owner][4] if owner >= 0 else run_node
        yield from _chunks(conv, lengths[a], part, convs[a:z])


def _node_type() -> pa.Schema:
    return pa.schema([(name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
                     + [("ends_sha256", pa.string()), ("part", pa.int32()), ("place", pa.int32()), ("chunk", pa.string())])


_NOBODY = hashlib.sha256(b"").hexdigest()


def _nodes(found: list[list[int | None]], ends: dict[int, str | None], sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row for each depth of the stretches found, some tens of thousands at a time."""
    columns: list[list] = [[] for _ in range(8)]

    def batch() -> pa.RecordBatch:
        whole = [*columns, *([[None] * len(columns[0])] * 3)]
        return pa.record_batch([pa.array(values, field.type) for values, field in zip(whole, _node_type())], schema=_node_type())

    for own, top, bottom, n, least, leaves, saved, children, parent in found:
        total = sums[own]
        for depth in range(top, bottom + 1):
            ends_here = depth == bottom == len(total) - 1
            values = (least, depth, parent if depth == top else least, n, children if depth == bottom else 1, leaves,
                      saved - (n - 1) * int(total[depth - 1]) if depth else saved, ends.get(own, _NOBODY) if ends_here else _NOBODY)
            for column, value in zip(columns, values):
                column.append(value)
            if len(columns[0]) == ROWS:
                yield batch()
                for column in columns:
                    column.clear()
    if columns[0]:
        yield batch()


def _chunks(conv: int, depth: int, part: int, ids: list[int]) -> Iterator[pa.RecordBatch]:
    step = CHUNK_CHARS // 20
    for place, at in enumerate(range(0, len(ids), step)):
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "depth": depth, "part": part, "place": place,
                                           "chunk": ",".join(map(str, ids[at:at + step]))}], schema=_node_type())


def join_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``join_partition`` for each partition of the sorted table, told apart by ``part``."""
    part, convs, lengths, edges, sums, last = None, [], [], [], [], None
    context: dict[int, tuple[list[Block], list[Block], bool]] = {}

    def contexts() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("behind").is_valid().to_numpy(zero_copy_only=False)
            for at in np.flatnonzero(known).tolist():
                behind, ahead = ([Block(**b) for b in batch.column(side)[at].as_py()] for side in ("behind", "ahead"))
                context[batch.column("part")[at].as_py()] = behind, ahead, batch.column("same_ahead")[at].as_py()
            yield batch

    for own, conv, seq, total in _conversations(contexts()):
        if own != part:
            if convs:
                yield from join_partition(part, convs, lengths, edges, sums, *context.pop(part))
            behind = context[own][0]
            part, convs, lengths, edges, sums = own, [], [], [behind[0].edge if behind else -1], []
        else:
            edges.append(common_turns(last, seq))
        convs.append(conv)
        lengths.append(len(seq) // DIGEST)
        sums.append(total)
        last = seq
    if convs:
        yield from join_partition(part, convs, lengths, edges, sums, *context.pop(part))


def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of ids that cross partitions: a node's row, then its chunks in order."""
    node, state, some = None, None, False

    def done() -> pa.RecordBatch:
        node["ends_sha256"] = state.hexdigest()
        return pa.RecordBatch.from_pylist([node], schema=pa.schema(list(_node_type())[:8]))

    for batch in batches:
        for row in batch.to_pylist():
            chunk, key = row.pop("chunk"), (row.pop("part"), row.pop("place"))
            if key == (None, None):
                if node:
                    yield done()
                node, state, some = row, hashlib.sha256(), False
            else:
                state.update(("," if some else "").encode() + chunk.encode())
                some = True
    if node:
        yield done()


def prefix_trie(conversations: DataFrame, partitions: int | None = None,
                context_max_bytes: int = CONTEXT_MAX_BYTES) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Null roles and texts
    are empty; turns of equal number are ordered by digest, so repeated rows are turns of
    their own; conversations without turns end at the root; an empty table has no
    nodes. Long texts are read as digests only. Equal conversations are sorted by id as
    well, so any number of them is spread over partitions. Other columns are not read.
    """
    keys = ("seq", "conv_id")
    whole = rebuilt(conversations)
    spread = (whole.repartitionByRange(*keys) if partitions is None else whole.repartitionByRange(partitions, *keys)).sortWithinPartitions(*keys)
    parts = settle(spread.withColumn("part", F.spark_partition_id()))
    ends = settle(in_batches(parts, summaries, _SUMMARY))
    ahead = in_batches(ends.select("part", "first_seq", "first_sums", "last_seq", F.col("right"))
                       .repartition(1).sortWithinPartitions(F.desc("part")), seen_ahead, _RIGHT)
    behind = in_batches(ends.select("part", "first_conv", "first_seq", "last_seq", F.col("left"))
                        .repartition(1).sortWithinPartitions("part"), seen_behind, _LEFT)
    contexts = settle(behind.join(ahead, "part").withColumnRenamed("first_conv", "conv_id"))
    size = F.sum((F.size("behind") + F.size("ahead")) * 64 + 64)
    held = contexts.agg(F.coalesce(size, F.lit(0)).alias("bytes")).first()["bytes"]
    if held <= context_max_bytes:
        joined = parts.join(F.broadcast(contexts), ["part", "conv_id"], "left")
    else:
        joined = (parts.join(contexts, ["part", "conv_id"], "left")
                  .repartition("part").sortWithinPartitions("part", "seq", "conv_id"))
    rows = written(in_batches(joined, join_all, _NODE + ", part int, place int, chunk string"), "trie")
    open_ends = (rows.filter("ends_sha256 is null").repartition("conv_id", "depth")
                 .sortWithinPartitions("conv_id", "depth", "part", "place"))
    whole = rows.filter("ends_sha256 is not null").drop("part", "place", "chunk")
    return whole.unionByName(in_batches(open_ends, hash_ends, _NODE))
