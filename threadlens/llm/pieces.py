"""SentencePiece encoding and decoding by a max-plus scan.

The pieces of a model file are read as a unigram lattice: the encoding is the
segmentation with the highest sum of piece scores, which Viterbi finds. A giant text is
cut into chunks. The state at a cut is how far back the last piece boundary lies; a
chunk yields the matrix of best scores from every state at its start to every state at
its end. Matrices combine associatively in the (max, +) algebra, first inside blocks of
chunks, then over the blocks of a text; the states at all cuts follow, and every chunk
is traced back by itself. Scores are integers, so the order of combination cannot
change a sum.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import in_batches, sized_side, written
from threadlens.llm.words import powers

MODEL_PATH = os.environ.get("TOKENIZER_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SPACE = "▁"
# Texts above this many characters are cut into chunks of about so many.
GIANT_CHARS = 32768
CHUNK_CHARS = 8192
# A cut moves back so far at most, to a place that no piece can span.
SEEK = 256
BLOCK = 64
NEVER = -(1 << 60)
# Parts kept with their ids, and the longest that are segmented together.
_CACHE = 200_000
_TOGETHER = 32


class Lattice:
    """Vocabulary of a model file as a unigram lattice with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in range(size)]
        scores = [model.get_score(i) for i in range(size)]
        # Fixed point where the scores are not whole numbers.
        scale = 1 if all(float(scores[i]).is_integer() for i in normal) else 1 << 20
        self.score = {pieces[i]: round(scores[i] * scale) for i in normal}
        self.id = {pieces[i]: i for i in normal}
        self.unknown = min(self.score.values()) - 10 * scale      # the library's penalty
        self.longest = max(map(len, self.score))
        # Every beginning of a piece; those that are no piece themselves have no score.
        self.begins = {piece[:size]: None for piece in self.score for size in range(1, len(piece))} | self.score
        self.byte = {int(pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.bytes = [b"" for _ in range(size)]
        for i in normal:
            self.bytes[i] = pieces[i].replace(SPACE, " ").encode()
        for value, i in self.byte.items():
            self.bytes[i] = bytes([value])
        # No piece spans from another character to a space mark, nor a line end.
        assert not any(SPACE in piece.lstrip(SPACE) for piece in self.score)
        line = "" if any("\n" in piece for piece in self.score) else "\n"
        self.unit = re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+|{line or SPACE}")
        # Neighbours inside pieces; between other neighbours a piece ends.
        self.pairs = {piece[i:i + 2] for piece in self.score for i in range(len(piece) - 1)}
        keyed = sorted((self._key(piece), self.id[piece], score) for piece, score in self.score.items())
        self.keys = np.array([k for k, _, _ in keyed], np.uint64)
        self.key_ids = np.array([i for _, i, _ in keyed], np.int32)
        self.key_scores = np.array([s for _, _, s in keyed], np.int64)
        self.cache: dict[str, tuple[int, bytes]] = {}

    @staticmethod
    def _key(piece: str) -> int:
        codes = np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64)
        return int(((codes + np.uint64(1)) * powers(1 << 16)[0][:len(codes)]).sum() + np.uint64(len(codes)))

    def forced(self, before: str, after: str) -> bool:
        """Whether every segmentation has a boundary between the two characters."""
        return after == SPACE and before != SPACE

    def best(self, text: str, start: dict[int, int], least: int) -> tuple[list[int], list[int]]:
        """Best score of a boundary at each place, and the piece length before it.

        ``start`` gives the boundaries to begin with; pieces from them must end after
        ``least``. Of equal scores the longest last piece wins.
        """
        n = len(text)
        value, back = [NEVER] * (n + 1), [0] * (n + 1)
        for at, score in start.items():
            value[at] = score
        get, unknown = self.begins.get, self.unknown
        for at in range(n):
            here = value[at]
            if here <= NEVER:
                continue
            for end in range(at + 1, n + 1):
                score = get(text[at:end], 1)        # 1: no piece begins so
                if score is None or score == 1:
                    if end == at + 1 and text[at:end] not in self.score:
                        if end > least and here + unknown > value[end]:
                            value[end], back[end] = here + unknown, 1
                    if score == 1:
                        break
                elif end > least and here + score > value[end]:
                    value[end], back[end] = here + score, end - at
        return value, back

    def trace(self, text: str, back: list[int], start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            piece = text[end - back[end]:end]
            found = self.id.get(piece)
            if found is None:
                out.extend(self.byte.get(value, 0) for value in reversed(piece.replace(SPACE, " ").encode("utf-8", "replace")))
            else:
                out.append(found)
            end -= back[end]
        out.reverse()
        return out

    def encode_unit(self, unit: str) -> tuple[int, bytes]:
        """Score and ids of a part that no piece leaves or enters."""
        found = self.cache.get(unit)
        if found is None:
            last = len(unit) - 1
            if last > 0 and unit[last - 1:] not in self.pairs:       # a word and the mark after it
                (one, ids), (other, more) = self.encode_unit(unit[:last]), self.encode_unit(unit[last:])
                found = one + other, ids + more
            else:
                value, back = self.best(unit, {0: 0}, 0)
                found = value[-1], array("i", self.trace(unit, back, 0, len(unit))).tobytes()
            if len(unit) <= 64:
                if len(self.cache) >= _CACHE:
                    self.cache.clear()
                self.cache[unit] = found
        return found

    def encode(self, text: str) -> tuple[int, np.ndarray]:
        """Score and ids of text whose ends are boundaries."""
        parts = [self.cache.get(unit) or self.encode_unit(unit) for unit in self.unit.findall(text)]
        return sum(part[0] for part in parts), np.frombuffer(b"".join([part[1] for part in parts]), np.int32)

    def encode_many(self, texts: list[str]) -> list[tuple[int, np.ndarray]]:
        """As ``encode`` for each text; parts not seen before are segmented together."""
        units = [self.unit.findall(text) for text in texts]
        every = {unit for own in units for unit in own}
        new = every - self.cache.keys()
        if len(self.cache) + len(new) > _CACHE:
            self.cache.clear()
            new = every
        by_length: dict[int, list[str]] = {}
        for unit in new:
            by_length.setdefault(len(unit), []).append(unit)
        for length, own in by_length.items():
            if length <= _TOGETHER and len(own) >= 8:
                self._segment(own, length)
        out = []
        get = self.cache.get
        for own in units:
            parts = [get(unit) or self.encode_unit(unit) for unit in own]
            out.append((sum(part[0] for part in parts), np.frombuffer(b"".join([part[1] for part in parts]), np.int32)))
        return out

    def _segment(self, units: list[str], n: int) -> None:
        """Viterbi over parts of one length at a time, with the rules of ``best``. Parts with a
        character outside the vocabulary are left to ``encode_unit``."""
        rows = len(units)
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(rows, n).astype(np.uint64)
        up, down = powers(1 << 16)
        total = np.zeros((n + 1, rows), np.uint64)
        np.cumsum(((codes + np.uint64(1)) * up[:n]).T, axis=0, out=total[1:])
        value, back = np.full((n + 1, rows), NEVER, np.int64), np.zeros((n + 1, rows), np.int64)
        piece = np.zeros((n + 1, rows), np.int32)
        value[0] = 0
        known = np.ones(rows, bool)
        for at in range(n):
            for end in range(at + 1, min(n, at + self.longest) + 1):
                key = (total[end] - total[at]) * down[at] + np.uint64(end - at)
                found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[found] == key
                if end == at + 1:
                    known &= hit
                score = np.where(hit, value[at] + self.key_scores[found], NEVER)
                better = score > value[end]
                value[end][better], back[end][better], piece[end][better] = score[better], end - at, self.key_ids[found[better]]
        ids, count = np.zeros((rows, n), np.int32), np.zeros(rows, np.int64)
        place, every = np.full(rows, n), np.arange(rows)
        while (live := place > 0).any():
            at = np.where(live, place, 0)
            ids[every[live], n - 1 - count[live]] = piece[at[live], every[live]]
            count += live
            place = place - np.where(live, back[at, every], 0)
            if not known.all():
                place[~known] = 0
        for row, (unit, score, size) in enumerate(zip(units, value[n].tolist(), count.tolist())):
            if known[row]:
                self.cache[unit] = score, ids[row, n - size:].tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes
        return b"".join([table[i] for i in ids.tolist()])

    def transfer(self, text: str, lead: int, free_in: bool, free_out: bool) -> np.ndarray:
        """Best scores between the states of a chunk's ends.

        ``text`` has ``lead`` characters of the chunk before it. A fixed end has the one
        state 0. Inside, places that no piece spans split the work: only what lies
        before the first and after the last of them depends on the states.
        """
        n = len(text)
        places = [at for at in range(lead, n + 1) if at == n and not free_out or at == lead and not free_in
                  or 0 < at < n and self.forced(text[at - 1], text[at])]
        states_in = range(min(self.longest, lead + 1)) if free_in else range(1)
        states_out = range(self.longest) if free_out else range(1)
        out = np.full((len(states_in), len(states_out)), NEVER, np.int64)
        if places:
            first, last = places[0], places[-1]
            middle = self.encode(text[first:last])[0] if last > first else 0
            tail = self.best(text[last:], {0: 0}, 0)[0] if last < n else [0]
            for i in states_in:
                begin = lead - i
                head = 0 if first == begin else self.best(text[begin:first], {0: 0}, i)[0][-1] if first > lead else NEVER
                for j in states_out:
                    at = n - j - last
                    if head > NEVER and at >= 0 and tail[at] > NEVER:
                        out[i, j] = head + middle + tail[at]
        else:
            for i in states_in:
                value = self.best(text[lead - i:], {0: 0}, i)[0]
                for j in states_out:
                    at = len(value) - 1 - j
                    out[i, j] = value[at] if at > i else NEVER
        return out

    def encode_chunk(self, text: str, lead: int, state_in: int, state_out: int) -> tuple[int, np.ndarray]:
        """Score and ids of the pieces from one cut's boundary to the other's."""
        part = text[lead - state_in:len(text) - state_out]
        if not state_in:
            return self.encode(part)
        value, back = self.best(part, {0: 0}, state_in)
        return value[-1], np.array(self.trace(part, back, 0, len(part)), np.int32)


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def escaped(text: str) -> str:
    """Spaces as marks, and one mark in front of a text that is not empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two matrices in the (max, +) algebra."""
    out = (a[:, :, None] + b[None, :, :]).max(axis=1)
    return np.maximum(out, NEVER)


def states(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """States at the ends of consecutive spans on a best path from ``first`` to ``last``."""
    reach = [matrices[0][first]]
    for matrix in matrices[1:]:
        reach.append(np.maximum((reach[-1][:, None] + matrix).max(axis=0), NEVER))
    out = [last]
    for at in range(len(matrices) - 1, 0, -1):
        out.append(int((reach[at - 1] + matrices[at][:, out[-1]]).argmax()))
    return [first, *reversed(out)]


def cuts(text: str, length: int, model: Lattice) -> list[tuple[int, bool]]:
    """Places of the cuts, and whether a piece may span them. Chunks hold ``length``
    characters or up to ``SEEK`` fewer; a rest shorter than that joins the last one."""
    out, at = [], 0
    while len(text) - at > 2 * length:
        end = at + length
        move = next((d for d in range(min(SEEK, length // 2)) if model.forced(text[end - d - 1], text[end - d])), None)
        at = end - (move or 0)
        out.append((at, move is None))
    return out


def encode_texts(docs: DataFrame, model_path: str = MODEL_PATH, id_column: str = "doc_id",
                 giant_chars: int = GIANT_CHARS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Token ids of every text, and the check that they decode to it.

    One row for each text, or for each chunk of a giant text, in ``chunk`` order:
    ``doc_id, chunk, n_tokens, score, ids, n_bytes, decoded_sha256, exact``. ``n_bytes``
    and the checksum are those of what the ids decode to; ``exact`` says that this is the
    text's own part. A null or empty text has one row without ids. Rows that repeat are
    encoded again each. A mark character in a text decodes to a space, as in the
    library. Ids are optimal in score; among segmentations of equal score across a cut
    inside a run without spaces the earlier boundary is taken. An empty table gives no
    rows. Other columns are not read.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = (f"id {kind}, chunk long, n_tokens long, score long, ids array<int>, n_bytes long, "
              "decoded_sha256 string, exact boolean")

    def result(ids: list, chunk: list[int], parts: list[tuple[int, np.ndarray]], texts: list[str], lead: list[bool], kind: pa.DataType) -> pa.RecordBatch:
        model = lattice(model_path)
        decoded = [model.decode(part[1])[1 if first and len(part[1]) else 0:] for part, first in zip(parts, lead)]
        sizes = np.array([len(part[1]) for part in parts], np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        flat = np.concatenate([part[1] for part in parts]) if parts else np.empty(0, np.int32)
        return pa.record_batch({
            "id": pa.array(ids, kind), "chunk": pa.array(chunk, pa.int64()), "n_tokens": sizes,
            "score": pa.array([int(part[0]) for part in parts], pa.int64()), "ids": pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
            "n_bytes": pa.array([len(d) for d in decoded], pa.int64()),
            "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded],
            "exact": pa.array([d == t.encode("utf-8", "replace") for d, t in zip(decoded, texts)], pa.bool_())})

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column("text").to_pylist()
                encoded = model.encode_many([escaped(text) for text in texts])
                yield result(part.column("id").to_pylist(), [0] * len(texts), encoded, texts, [True] * len(texts), part.column("id").type)
        model.cache.clear()      # the worker lives on in tasks that have no use for it

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(model_path)
        for batch in batches:
            for row, id_, text in zip(*(batch.column(n).to_pylist() for n in ("row", "id", "text"))):
                text = escaped(text)
                ends = cuts(text, chunk_chars, model)
                edges = [(0, False), *ends, (len(text), False)]
                for k, ((a, free_in), (b, free_out)) in enumerate(zip(edges, edges[1:])):
                    lead = min(a, model.longest - 1) if free_in else 0
                    yield pa.record_batch({"row": pa.array([row], pa.int64()), "id": pa.array([id_], batch.column("id").type), "chunk": pa.array([k], pa.int64()),
                                           "lead": pa.array([lead], pa.int32()), "free_in": [free_in], "free_out": [free_out], "text": [text[a - lead:b]]})

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(model_path)
        for batch in batches:
            made = [model.transfer(*row) for row in zip(*(batch.column(n).to_pylist() for n in ("text", "lead", "free_in", "free_out")))]
            yield pa.record_batch({"row": batch.column("row"), "chunk": batch.column("chunk"), "block": pa.compute.divide(batch.column("chunk"), BLOCK),
                                   "width": pa.array([m.shape[1] for m in made], pa.int32()), "matrix": pa.array([m.tobytes() for m in made], pa.binary())})
        model.cache.clear()

    def unpack(rows: pd.DataFrame) -> list[np.ndarray]:
        return [np.frombuffer(m, np.int64).reshape(-1, w) for m, w in zip(rows["matrix"], rows["width"])]

    def block_product(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        whole, *rest = unpack(rows)
        for matrix in rest:
            whole = combine(whole, matrix)
        return pd.DataFrame({"row": rows["row"].iloc[:1], "block": rows["block"].iloc[:1], "width": whole.shape[1], "matrix": [whole.tobytes()]})

    def block_states(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        at = states(unpack(rows), 0, 0)
        return pd.DataFrame({"row": rows["row"], "block": rows["block"], "first": at[:-1], "last": at[1:]})

    def chunk_states(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        at = states(unpack(rows), int(rows["first"].iloc[0]), int(rows["last"].iloc[0]))
        return pd.DataFrame({"row": rows["row"], "chunk": rows["chunk"], "state_in": at[:-1], "state_out": at[1:]})

    def large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(model_path)
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("id", "chunk", "text", "lead", "state_in", "state_out")]
            ids, chunk, texts, leads = columns[:4]
            parts = [model.encode_chunk(t, lead, i, o) for t, lead, i, o in zip(*columns[2:])]
            own = [t[lead - i:len(t) - o].replace(SPACE, " ")[1 if not k else 0:] for k, t, lead, i, o in zip(chunk, *columns[2:])]
            yield result(ids, chunk, parts, own, [k == 0 for k in chunk], batch.column("id").type)
        model.cache.clear()

    is_giant = F.char_length("text") > giant_chars
    whole = in_batches(rows.filter(~is_giant), small, schema)
    giants = rows.filter(is_giant).withColumn("row", F.monotonically_increasing_id())
    cut = in_batches(giants, chunks, f"row long, id {kind}, chunk long, lead int, free_in boolean, free_out boolean, text string")
    cut = written(cut.repartition("row", "chunk"), "chunks")
    made = in_batches(cut.select("row", "chunk", "text", "lead", "free_in", "free_out"), matrices, "row long, chunk long, block long, width int, matrix binary")
    made = written(made, "matrices")
    blocks = made.groupBy("row", "block").applyInPandas(block_product, "row long, block long, width int, matrix binary")
    at_blocks = blocks.groupBy("row").applyInPandas(block_states, "row long, block long, first int, last int")
    at_chunks = (made.join(at_blocks, ["row", "block"]).groupBy("row", "block")
                 .applyInPandas(chunk_states, "row long, chunk long, state_in int, state_out int"))
    traced = in_batches(cut.join(sized_side(at_chunks), ["row", "chunk"]).select("id", "chunk", "text", "lead", "state_in", "state_out"), large, schema)
    return whole.unionByName(traced).withColumnRenamed("id", id_column)
