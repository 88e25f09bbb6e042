"""Normalisation of whole tables: tokens, stop words, lemmas, re-joined text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions import tokens as tk
from threadlens.functions.cleaning import empty_if_null
from threadlens.scale import IN_PLACE_COLUMNS, attach_dictionary, inline_lookup, map_columns, settled_entries
from threadlens.schemas import TEXT_COLUMNS, check_item_type

LEMMA_MODES = ("dictionary", "lower", "none")


def normalize(df: DataFrame, columns: Sequence[str], lemma: str = "dictionary",
              lemmas: Mapping[str, str] | DataFrame | None = None,
              stopwords: Iterable[str] | None = None,
              keep_important_stopwords: bool = True, split_contractions: bool = True) -> DataFrame:
    """Add ``<column>_normalized`` and ``<column>_original``.

    ``stopwords=None`` keeps every word. ``lemmas`` is a mapping or a table
    ``(token, lemma[, pos])``; proper nouns in the table stay as written. Case does not
    matter; of several lemmas of a token the greatest counts, and staying as written
    gives way to any. A mapping travels with the plan. A table may have any size: the rows
    are laid out once, their words are joined with it and the lemmas found come back.
    """
    if lemma not in LEMMA_MODES:
        raise ValueError(f"lemma must be one of {LEMMA_MODES}")
    stop = sorted(set(stopwords or ()))
    keep = tk.KEEP_WORDS if keep_important_stopwords else ()
    words_of = lambda text: tk.tokenize(empty_if_null(text), split_contractions)

    entries: Mapping[str, str] | None = {} if lemma != "dictionary" else (
        tk.STARTER_LEMMAS if lemmas is None else lemmas if isinstance(lemmas, Mapping) else None)
    table = None
    if entries is None:
        table = lemmas
        if "pos" in table.columns:
            as_written = F.col("pos").isin("PROPN", "NUM")
            table = table.withColumn("lemma", F.when(as_written, F.lit("")).otherwise(F.col("lemma")))
        numeric = F.col("token").rlike(r"^\p{N}+$")
        table = table.select(F.lower("token").alias("token"), "lemma").filter(
            F.col("lemma").isNotNull() & ~numeric)

    kept_words = lambda text: tk.remove_stopwords(words_of(text), stop, keep) if stop else words_of(text)
    if entries is None:
        # Tokens are taken once, and lie beside the texts until their lemmas are found.
        held = {name: f"__words_{i}" for i, name in enumerate(columns)}
        lowered = lambda words: F.transform(words, F.lower)
        df, lookup = attach_dictionary(df.withColumns({words: kept_words(F.col(name)) for name, words in held.items()}),
                                       lambda rows: [lowered(rows[words]) for words in held.values()], table, "token", "lemma")
        df = df.withColumns({f"{name}_normalized": tk.join_tokens(tk.lemmatize_found(F.col(words), lookup.all(lowered(F.col(words))), stop, keep))
                             for name, words in held.items()}).drop(*held.values(), *IN_PLACE_COLUMNS)
        return df.withColumns({f"{name}_original": F.col(name) for name in columns})
    if entries:
        entries = settled_entries(entries)
        lookup = inline_lookup(entries, "string")
    else:
        lookup = lambda token: F.lit(None).cast("string")

    keeps_some = "" in entries.values()

    def normalized(text: Column) -> Column:
        words = kept_words(text)
        if lemma != "none":
            words = tk.lemmatize(words, lookup, stop, keep, keeps_some)
        return tk.join_tokens(words)

    df = map_columns(df, {f"{name}_normalized": name for name in columns}, normalized)
    return df.withColumns({f"{name}_original": F.col(name) for name in columns})


def normalize_batch(df: DataFrame, item_type: str = "submission", **options) -> DataFrame:
    columns = TEXT_COLUMNS[check_item_type(item_type)]
    return normalize(df, columns, **options).withColumn("normalized", F.lit(True))
