"""Fill-in-the-middle examples, cut by a learned rank index.

A text is a row of units (a run of the letters A to Z in either case, or one other
character). Both cuts are given as ranks among the unit boundaries. A rank finds its
offset through straight segments fitted to all boundaries of the text: the segment
predicts the offset within ``ERROR`` code points and a stored residual of one byte a
boundary makes it exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import in_batches, pieces

# Largest distance of a boundary from its segment; a residual fits one signed byte.
ERROR = 100
# Code points looked at at a time, and boundaries a segment is first tried on.
CHUNK_CHARS = 1 << 20
WINDOW = 1024
MARKS = PREFIX, SUFFIX, MIDDLE = ("<P>", "<S>", "<M>")
SEED = 1
PLAIN_PERCENT = 10
SPM_PERCENT = 20


def unit_starts(text: str, after_letter: bool) -> tuple[np.ndarray, bool]:
    """Places in a piece of text where units start, and whether it ends in a letter.
    ``after_letter`` tells that a letter stands before the piece."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (codes | 32) - np.uint32(97) < 26
    goes_on = letter.copy()
    goes_on[1:] &= letter[:-1]
    goes_on[0] &= after_letter
    return np.flatnonzero(~goes_on), bool(letter[-1])


def fit(offsets: np.ndarray, error: int = ERROR) -> list[tuple[int, float]]:
    """Segments ``(first rank, slope)`` through their first boundary; every boundary lies
    within ``error`` of its segment. Each segment is as long as the cone of slopes
    allows that is still open after the boundaries so far."""
    segments, first, n = [], 0, len(offsets)
    while first < n:
        low, high, end, width = -np.inf, np.inf, first + 1, WINDOW
        while end < n:
            stop = min(n, end + width)
            run = np.arange(end - first, stop - first, dtype=np.float64)
            rise = offsets[end:stop] - offsets[first]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            shut = lows > highs
            took = int(shut.argmax()) if shut.any() else stop - end
            if took:
                low, high = lows[took - 1], highs[took - 1]
            end += took
            if end < stop:
                break
            width *= 2
        segments.append((first, (low + high) / 2 if end > first + 1 else 0.0))
        first = end
    return segments


class RankIndex:
    """Offset of every unit boundary of a text, by rank; rank ``n`` is the end."""

    def __init__(self, text: str, error: int = ERROR, chunk_chars: int = CHUNK_CHARS):
        self.n, self.end = 0, len(text)
        firsts, starts, slopes, rests, after_letter = [], [], [], [], False
        for at in range(0, len(text), chunk_chars):
            places, after_letter = unit_starts(text[at:at + chunk_chars], after_letter)
            if not len(places):
                continue
            segments = fit(places, error)
            first = np.array([s[0] for s in segments], np.int64)
            slope = np.array([s[1] for s in segments])
            lengths = np.diff(np.append(first, len(places)))
            inside = np.arange(len(places)) - np.repeat(first, lengths)
            guess = np.repeat(places[first], lengths) + np.rint(np.repeat(slope, lengths) * inside)
            rests.append((places - guess).astype(np.int8))
            firsts.append(first + self.n)
            starts.append(places[first] + at)
            slopes.append(slope)
            self.n += len(places)
        self.firsts, self.starts, self.slopes, self.rests = (
            np.concatenate(parts) if parts else np.zeros(0) for parts in (firsts, starts, slopes, rests))

    def predicted(self, rank: int) -> int:
        at = int(np.searchsorted(self.firsts, rank, "right")) - 1
        return int(self.starts[at]) + int(np.rint(self.slopes[at] * (rank - int(self.firsts[at]))))

    def offset(self, rank: int) -> int:
        return self.end if rank >= self.n else self.predicted(rank) + int(self.rests[rank])


def draws(name: str, seed: int = SEED) -> list[int]:
    """Four numbers below 2^32 that the id of a document decides."""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[at:at + 8], 16) for at in range(0, 32, 8)]


def rearranged(name: str | None, text: str | None) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, lengths of prefix and middle, and the example."""
    text = text or ""
    index = RankIndex(text)
    first, second, plain, order = draws(name or "")
    if not text or any(mark in text for mark in MARKS) or plain % 100 >= 100 - PLAIN_PERCENT:
        return index.n, "plain", None, None, text
    cuts = sorted((first % (index.n + 1), second % (index.n + 1)))
    a, b = map(index.offset, cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < SPM_PERCENT:
        return index.n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return index.n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the example as ``output``.

    One row for every row of the input, without a shuffle. A null text is empty; an
    empty text, and one that holds a mark, stays plain. A null id draws as an empty one;
    rows of equal id and text give equal rows. Of a long text the boundaries are held
    as one byte each, a mebi code point of it is unpacked at a time. An empty table
    gives an empty one. Other columns of the input are not read.
    """
    kind = dict(docs.dtypes)[id_column]

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                made = [rearranged(name, text) for name, text in
                        zip(batch.column("name").to_pylist(), batch.column("text").to_pylist())]
                n, form, prefix, middle, output = zip(*made)
                yield pa.record_batch({"id": batch.column("id"), "n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()),
                                       "prefix_chars": pa.array(prefix, pa.int64()), "middle_chars": pa.array(middle, pa.int64()),
                                       "output": pa.array(output, pa.string())})

    slim = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{id_column}`").cast("string").alias("name"),
                       F.col(f"`{text_column}`").alias("text"))
    return in_batches(slim, body, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
                      ).withColumnRenamed("id", id_column)


def restored(output: Column, form: Column) -> Column:
    """The text an example was made of. A text with a mark is never cut, so the marks in
    a cut example are those that were put there."""
    parts = F.split(output, "<[PSM]>")
    part = lambda at: F.get(parts, F.lit(at))
    return (F.when(form == "psm", F.concat(part(1), part(3), part(2)))
             .when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output))
