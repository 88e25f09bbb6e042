"""Quality rules by compression bands.

zstandard ratios (compressed over raw bytes) of the whole text and of fixed chunks.
A ratio below its band means repetition, above it noise. The bands depend on the
length, since short texts compress less.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from threadlens.llm.common import encoded, in_batches, pieces
from threadlens.llm.words import hash_texts, runs

# (least bytes, lowest ratio, highest ratio) of whole texts, longest class last.
WHOLE_BANDS = ((0, 0.30, 1.20), (512, 0.25, 0.85), (2048, 0.22, 0.75), (16384, 0.15, 0.70))
CHUNK_BYTES = 4096
# Band of a chunk; the rest at the end of a text counts if it is at least half a chunk.
CHUNK_BAND = (0.10, 0.85)
# A text fails when more than this share of its chunks is outside the band.
CHUNK_SHARE = 0.5
LEVEL = 3
MIN_WORDS = 50


def repeated_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and how many of them lie in 3-word windows found twice."""
    words, offsets = hash_texts(texts)
    value, owner, place = runs(words, offsets, 3, short=False)
    order = np.lexsort((value, owner))
    same = (value[order][1:] == value[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(value), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    first = offsets[owner[twice]] + place[twice]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[first + k] = True
    total = np.concatenate([[0], np.cumsum(covered)])
    return np.diff(offsets), total[offsets[1:]] - total[offsets[:-1]]


def duplicate_lines(text: bytes) -> int:
    seen, count = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            count += line in seen
            seen.add(line)
    return count


def ratios(text: bytes, packer: zstandard.ZstdCompressor, chunk: int) -> tuple[float, list[float]]:
    parts = [text[at:at + chunk] for at in range(0, len(text), chunk)]
    if parts and 2 * len(parts[-1]) < chunk:
        parts.pop()
    return (len(packer.compress(text)) / len(text) if text else 0.0,
            [len(packer.compress(part)) / len(part) for part in parts])


def verdict(size: int, whole: float, chunks: Sequence[float], bands: Sequence[tuple[int, float, float]] = WHOLE_BANDS,
            chunk_band: tuple[float, float] = CHUNK_BAND, share: float = CHUNK_SHARE) -> bool:
    """True when the ratios are inside the bands of this length."""
    _, low, high = [band for band in bands if band[0] <= size][-1]
    outside = sum(not chunk_band[0] <= ratio <= chunk_band[1] for ratio in chunks)
    return low <= whole <= high and outside <= share * len(chunks)


def compression_bands(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Counts, ratios and verdict of every text; no shuffle.

    A null or empty text has no words, fails the base rule and is not kept. Equal rows
    give equal results. Long texts are compressed whole, in one task each. Other
    columns of the input are not read.
    """
    kind = dict(docs.dtypes)[id_column]

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for whole in batches:
            for batch in pieces(whole, "text"):
                texts = encoded(batch.column("text"))
                chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
                n_words, repeat = repeated_words(texts)
                spaces = np.array([len(t) - len(t.translate(None, b" \t\n\x0b\x0c\r")) for t in texts], np.int64)
                failed = (n_words < MIN_WORDS) | (100 * repeat > 50 * n_words)
                measured = [ratios(t, packer, chunk_bytes) for t in texts]
                kept = [not bad and verdict(len(t), *got) for t, bad, got in zip(texts, failed, measured)]
                yield pa.record_batch({
                    "id": batch.column("id"), "n_words": n_words, "word_chars": chars.astype(np.int64) - spaces,
                    "n_symbols": np.array([len(t) - len(t.translate(None, b"#*$%&|<>")) for t in texts], np.int64),
                    "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
                    "n_repeat_words": repeat.astype(np.int64), "base_failed": failed, "kept": np.array(kept, bool),
                    "ratio": np.array([m[0] for m in measured], np.float64),
                    "chunk_min": np.array([min(m[1], default=m[0]) for m in measured], np.float64),
                    "chunk_max": np.array([max(m[1], default=m[0]) for m in measured], np.float64),
                })

    out = in_batches(docs.selectExpr(f"`{id_column}` AS id", f"`{text_column}` AS text"), body,
                     f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                     "n_repeat_words long, base_failed boolean, kept boolean, ratio double, chunk_min double, chunk_max double")
    return out.withColumnRenamed("id", id_column)
