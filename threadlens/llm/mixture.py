"""Language identification as a mixture: each word comes from one of the languages.

Training counts letter trigrams by language over all labelled texts. For a text, every
word has a likelihood under each language, the product over its trigrams;
expectation-maximisation finds the proportions of the languages. Sets of the 1, 2, …
most likely languages are compared by their likelihood less a penalty of half a
logarithm of the words for each further language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import in_batches

UNKNOWN = "und"
# Trigrams are hashed into this many counters a language.
FEATURES = 1 << 15
SMOOTHING = 0.5
ROUNDS = 12
# A language below this share in the full mixture is not tried in a larger set.
LEAST_SHARE = 0.02
PIECE_CHARS = 1 << 20
# Largest model sent to the executors; the label column must not be a free text.
MAX_MODEL_BYTES = 256 << 20


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_likelihood: np.ndarray      # feature x language, float32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter; 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of pieces of a batch; a null is an empty text."""
    start, held, size = 0, [], 0
    for at, text in enumerate(batch.column("text").to_pylist()):
        text = text or ""
        if held and size + len(text) > PIECE_CHARS:
            yield start, held
            start, held, size = at, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram features in order, the first feature of each word, the text of each word."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    at = np.flatnonzero(letter)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none
    padded = np.concatenate([[0], letter, [0]]).astype(np.uint64)
    key = (padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
           + padded[at + 2] * np.uint64(0x165667B19E3779F9))
    key ^= key >> np.uint64(29)
    feature = ((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % FEATURES
    first = np.flatnonzero(padded[at] == 0)
    ends = np.cumsum([len(text) + 1 for text in texts])
    return feature, first, np.searchsorted(ends, at[first], side="right")


def _mixture(like: np.ndarray, start: np.ndarray, words: np.ndarray, share: np.ndarray,
             rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each text after EM from ``share``, and the log-likelihood they give."""
    owner = np.repeat(np.arange(len(start)), words)
    for _ in range(rounds):
        weighted = like * share[owner]
        weighted /= weighted.sum(axis=1, keepdims=True)
        share = np.add.reduceat(weighted, start, axis=0) / words[:, None]
    total = np.log((like * share[owner]).sum(axis=1))
    return share, np.add.reduceat(total, start)


def infer(texts: list[str], model: Model) -> tuple[list[str], list[float], list[int], list[str | None]]:
    """Main language, its share, the number of languages and their list for each text."""
    feature, first, owner = features(texts)
    languages = np.array(model.languages, object)
    names, scores, sizes, sets = [UNKNOWN] * len(texts), [0.0] * len(texts), [0] * len(texts), [None] * len(texts)
    if not len(first) or not len(languages):
        return names, scores, sizes, sets
    word = np.add.reduceat(model.log_likelihood[feature], first, axis=0).astype(np.float64)
    top = word.max(axis=1, keepdims=True)
    like = np.exp(np.maximum(word - top, -60.0))
    rows, start, count = np.unique(owner, return_index=True, return_counts=True)
    k = len(languages)
    share, _ = _mixture(like, start, count, np.full((len(rows), k), 1.0 / k))
    order = np.argsort(-share, axis=1, kind="stable")
    best_share = np.zeros_like(share)
    best_share[np.arange(len(rows)), order[:, 0]] = 1.0
    own = np.repeat(np.arange(len(rows)), count)
    best = np.add.reduceat(np.log(like[np.arange(len(own)), order[own, 0]]), start)
    size = np.ones(len(rows), int)
    sorted_share = np.take_along_axis(share, order, axis=1)
    for m in range(2, k + 1):
        tried = np.flatnonzero(sorted_share[:, m - 1] >= LEAST_SHARE)
        if not len(tried):
            break
        pick = np.isin(own, tried)
        initial = np.where(np.argsort(order[tried], axis=1) < m, share[tried], 0.0)
        initial /= initial.sum(axis=1, keepdims=True)
        begin = np.concatenate([[0], np.cumsum(count[tried])[:-1]])
        part, total = _mixture(like[pick], begin, count[tried], initial)
        value = total - 0.5 * (m - 1) * np.log(count[tried])
        better = value > best[tried]
        best[tried[better]] = value[better]
        best_share[tried[better]] = part[better]
        size[tried[better]] = m
    main = best_share.argmax(axis=1)
    for at, row in enumerate(rows):
        names[row], scores[row], sizes[row] = languages[main[at]], float(min(1.0, best_share[at, main[at]])), int(size[at])
        sets[row] = ",".join(languages[np.flatnonzero(best_share[at] >= LEAST_SHARE)]) or names[row]
    return names, scores, sizes, sets


def train(labelled: DataFrame) -> Model:
    """Counts of every feature by language over all rows of ``text, lang``.

    Tasks count by themselves; what meets is a row for each language and feature.
    """
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, texts in _texts(batch):
                feature, first, owner = features(texts)
                if not len(first):
                    continue
                text_of = np.repeat(owner, np.diff(np.append(first, len(feature))))
                names = sorted(set(langs[start:start + len(texts)]))
                code = np.array([names.index(x) for x in langs[start:start + len(texts)]])
                counted = np.bincount(code[text_of] * FEATURES + feature, minlength=len(names) * FEATURES)
                for name, own in zip(names, counted.reshape(len(names), FEATURES)):
                    total[name] = total.get(name, 0) + own
        for name, own in total.items():
            at = np.flatnonzero(own)
            yield pa.record_batch({"lang": pa.array([name] * len(at)), "feature": pa.array(at, pa.int32()), "n": pa.array(own[at], pa.int64())})

    counted = in_batches(labelled.select("text", "lang"), body, "lang string, feature int, n long")
    summed = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    # One row a language, so what reaches the driver is the model itself.
    packed = (summed.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("feature", "n"))).alias("m"), F.sum("n").alias("total"))
              .select("lang", F.map_keys("m").alias("feature"), F.map_values("m").alias("n")))
    rows = sorted(packed.collect(), key=lambda row: row["lang"])
    if len(rows) * FEATURES * 4 > MAX_MODEL_BYTES:
        raise ValueError(f"{len(rows)} languages: the label column holds something else")
    counts = np.zeros((FEATURES, len(rows)))
    for at, row in enumerate(rows):
        counts[row["feature"], at] = row["n"]
    smoothed = counts + SMOOTHING
    return Model([row["lang"] for row in rows], np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32))


def predict(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and lang_pred, score, n_langs, langs; no shuffle.

    A null text, or one without a letter, is ``und`` with score 0. Without a model
    (nothing to learn from) every text is ``und``. Of languages with equal shares the first by
    name is the main one. Rows are judged by themselves, so repeated rows give equal rows and
    an empty table an empty one; a long text is judged whole, word by word. Only ``text`` is read.
    """
    out = [prefix + name for name in ("lang_pred", "score", "n_langs", "langs")]
    clash = set(out) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already; choose a prefix")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _texts(batch):
                names, scores, sizes, sets = infer(texts, sent.value)
                piece = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(names), pa.array(scores, pa.float64()), pa.array(sizes, pa.int32()), pa.array(sets, pa.string())],
                    [*piece.schema.names, *out])

    return in_batches(docs, body, f"{schema}, {out[0]} string, {out[1]} double, {out[2]} int, {out[3]} string")


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame) -> Model:
    """Model learnt from the labelled rows that are not held out."""
    return train(docs.filter(~held_out() & F.col("lang").isNotNull()))
