"""Model-based scoring with a pluggable batch scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.cleaning import empty_if_null
from threadlens.functions.probability import LABELS, model_score, overall_model
from threadlens.functions.tokens import truncate_tokens
from threadlens.operators.rules import analysis_metadata, source_column
from threadlens.schemas import TEXT_COLUMNS, check_item_type

# Loads a model once per Python worker and returns texts -> logits (one row a text).
ScorerFactory = Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]]

_RESULT = "logits array<array<double>>, errors array<string>"


# Texts that are sorted by length together.
BUFFER_TEXTS = 4096


def mini_batches(texts: Sequence[str], batch_size: int, buffer_texts: int = BUFFER_TEXTS) -> Iterator[list[int]]:
    """Places of the texts of each mini-batch: texts of like length go together, so that a model
    that pads to the longest of a batch pads little. Sorted within buffers of bounded length."""
    for start in range(0, len(texts), buffer_texts):
        order = sorted(range(start, min(start + buffer_texts, len(texts))), key=lambda at: len(texts[at]))
        for at in range(0, len(order), batch_size):
            yield order[at:at + batch_size]


def logits_of(texts: Column, make_scorer: ScorerFactory, batch_size: int = 8) -> Column:
    """Logits and errors for an array of texts, in its order.

    The texts of all rows of an Arrow batch share mini-batches of ``batch_size``, put
    together by length; a mini-batch that fails marks its own texts and no others. The function counts
    as non-deterministic: Spark then runs the model once per row even where a later
    filter reads the scores, instead of once for the filter and once for the result.
    Filter rows before scoring.
    """

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = make_scorer()
        for batch in batches:
            flat = [text for row in batch for text in row]
            logits: list = [None] * len(flat)
            errors: list = [None] * len(flat)
            for places in mini_batches(flat, batch_size):
                try:
                    scored = [[float(x) for x in row] for row in predict([flat[at] for at in places])]
                    if len(scored) != len(places):
                        raise ValueError("the scorer must return one row of logits per text")
                    for at, row in zip(places, scored):
                        logits[at] = row
                except Exception as problem:
                    for at in places:
                        errors[at] = str(problem)
            rows = []
            at = 0
            for row in batch:
                rows.append((logits[at:at + len(row)], errors[at:at + len(row)]))
                at += len(row)
            yield pd.DataFrame(rows, columns=["logits", "errors"])

    return F.pandas_udf(score, _RESULT).asNondeterministic()(texts)


def score_model(df: DataFrame, columns: Mapping[str, str] | Sequence[str],
                make_scorer: ScorerFactory, labels: Sequence[str] = LABELS, batch_size: int = 8,
                max_length: int | None = None) -> DataFrame:
    """Add one score struct per text column (``{output: input}`` or a list, which
    adds ``<input>_sentiment``). Whole texts are
    sent unless the caller names ``max_length``, a limit in words."""
    if not isinstance(columns, Mapping):
        columns = {f"{name}_sentiment": name for name in columns}
    texts = [empty_if_null(F.col(name)) for name in columns.values()]
    if max_length is not None:
        texts = [truncate_tokens(text, max_length) for text in texts]
    df = df.withColumn("_model", logits_of(F.array(*texts), make_scorer, batch_size))
    scores = {out: model_score(F.get("_model.logits", F.lit(i)), F.get("_model.errors", F.lit(i)), labels)
              for i, out in enumerate(columns)}
    return df.withColumns(scores).drop("_model")


def score_model_batch(df: DataFrame, item_type: str, make_scorer: ScorerFactory,
                      use_normalized: bool = True, labels: Sequence[str] = LABELS,
                      batch_size: int = 8, max_length: int | None = None, model_name: str = "model",
                      run_ts=None, prefix: str = "") -> DataFrame:
    """Score posts (title, text and their weighted whole) or comments (text)."""
    names = TEXT_COLUMNS[check_item_type(item_type)]
    if item_type == "submission":
        outputs = {f"{prefix}{n}_sentiment": source_column(df, n, use_normalized) for n in names}
    else:
        outputs = {f"{prefix}sentiment": source_column(df, "text", use_normalized)}
    df = score_model(df, outputs, make_scorer, labels, batch_size, max_length)
    if item_type == "submission":
        whole = overall_model(F.col(f"{prefix}title_sentiment"), F.col(f"{prefix}text_sentiment"))
        df = df.withColumn(f"{prefix}overall_sentiment", whole)
    return df.withColumn(f"{prefix}sentiment_analysis",
                         analysis_metadata("transformer", use_normalized, run_ts, model_name))
