"""Rule-based scoring of whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions import lexicon as lx
from threadlens.functions.cleaning import empty_if_null
from threadlens.functions.dates import run_stamp
from threadlens.scale import (HITS, IN_PLACE_COLUMNS, PHRASE_HITS, all_finite, dictionary_of, few_entries, hit, inline_lookup,
                              laid_out, map_columns, settled_entries, settled_side, word_hits)
from threadlens.schemas import TEXT_COLUMNS, check_item_type


def source_column(df: DataFrame, name: str, use_normalized: bool) -> str:
    """The normalised text where it is wanted and the table has it."""
    normalized = f"{name}_normalized"
    return normalized if use_normalized and normalized in df.columns else name


def analysis_metadata(method: str, used_normalized: bool, run_ts=None,
                      model: str | None = None) -> Column:
    return F.struct(F.lit(method).alias("method"), F.lit(model).cast("string").alias("model"),
                    run_stamp(run_ts).alias("timestamp"),
                    F.lit(used_normalized).alias("used_normalized_text"))


def score_rules(df: DataFrame, columns: Mapping[str, str] | Sequence[str],
                lexicon: Mapping[str, float] | DataFrame,
                threshold: float = lx.THRESHOLD) -> DataFrame:
    """Add one score struct per text column (``{output: input}`` or a list, which
    adds ``<input>_sentiment``).

    ``lexicon`` is a mapping, for a short list, or a table ``(token, valence)`` of any
    size. Case does not matter; of several valences of a token the greatest counts.
    An entry of several words, apart by blanks, counts as one word wherever its words follow one another; of
    entries that overlap the first counts, of those that begin together the longest.
    Scoring by a mapping is a plain projection; for a table the rows are laid out
    once and its entries found among their words come back to them.
    """
    if not isinstance(columns, Mapping):
        columns = {f"{name}_sentiment": name for name in columns}
    if isinstance(lexicon, DataFrame):
        df, lookup, phrases = _table_lexicon(df, list(columns.values()), lexicon)
    else:
        lookup, phrases = _mapping_lexicon(lexicon)
    return map_columns(df, columns, lambda t: lx.rule_score(t, lookup, threshold, phrases)).drop(*IN_PLACE_COLUMNS)


def _mapping_lexicon(lexicon: Mapping[str, float]) -> tuple[lx.Lookup, lx.Phrases | None]:
    entries = settled_entries({" ".join(filter(None, token.split(" "))): float(value) for token, value in lexicon.items()})
    several = {token: value for token, value in entries.items() if " " in token}
    lookup = inline_lookup({token: value for token, value in entries.items() if token not in several}, "double")
    return lookup, _inline_phrases(several)


def _inline_phrases(several: Mapping[str, float]) -> lx.Phrases | None:
    """Entries of several words as constants of the plan."""
    if not several:
        return None
    heads: dict[str, set[int]] = {}
    pairs: dict[str, set[int]] = {}
    for token in several:
        words = token.split(" ")
        heads.setdefault(words[0], set()).add(len(words))
        pairs.setdefault(" ".join(words[:2]), set()).add(len(words))
    lengths, following = (inline_lookup({key: sorted(ns) for key, ns in found.items()}, "array<int>") for found in (heads, pairs))
    return lx.Phrases(lengths, inline_lookup(several, "double"), following)


def _table_lexicon(df: DataFrame, columns: Sequence[str], lexicon: DataFrame) -> tuple[DataFrame, lx.Lookup, lx.Phrases | None]:
    """The rows laid out, with what the lexicon holds of their words. Runs of words are only
    looked up where a word begins an entry of several words. A table that is measured to be
    short travels with the plan, and the rows stay as they are."""
    token = F.array_join(F.filter(F.split(F.lower("token"), " +"), lambda w: w != ""), " ")
    table = lexicon.select(token.alias("token"), F.col("valence").cast("double").alias("valence")).filter("token != '' and valence is not null")
    one_word = ~F.col("token").contains(" ")
    several, few = settled_side(dictionary_of(table.filter(~one_word), "token", "valence"))
    # Words that are entries, and words that begin entries of several words.
    heads, fewer = settled_side(
        table.groupBy(F.substring_index("token", " ", 1).alias("__k")).agg(F.struct(
            F.max(F.when(one_word, F.col("valence"))).alias("valence"),
            F.sort_array(F.collect_set(F.when(~one_word, F.size(F.split("token", " "))))).alias("lengths")).alias("__v")))
    if few and fewer:
        inline = _inlined(heads, several)
        if inline:
            return df, *inline
    words_of = lambda rows: [lx.rule_tokens(empty_if_null(rows[name])) for name in columns]
    rows = laid_out(df)
    rows = word_hits(rows, F.flatten(F.array(*[F.transform(words, F.lower) for words in words_of(rows)])), heads, HITS)
    lookup, lengths = (lambda word: hit(HITS, word)["valence"]), (lambda word: hit(HITS, word)["lengths"])
    if several.isEmpty():
        return rows, lookup, None
    runs = F.flatten(F.array(*[lx.phrase_candidates(words, lengths) for words in words_of(rows)]))
    rows = word_hits(rows, runs, several, PHRASE_HITS)
    return rows, lookup, lx.Phrases(lengths, lambda run: hit(PHRASE_HITS, run))


def _inlined(heads: DataFrame, several: DataFrame) -> tuple[lx.Lookup, lx.Phrases | None] | None:
    """Lookups of a short lexicon table held in the plan as constants, or None."""
    first, runs = few_entries(heads), few_entries(several)
    if first is None or runs is None:
        return None
    valences = {word: entry["valence"] for word, entry in first.items() if entry["valence"] is not None}
    if not all_finite([*valences.values(), *runs.values()]):
        return None
    return inline_lookup(valences, "double"), _inline_phrases(runs)


def score_rules_batch(df: DataFrame, item_type: str = "submission", use_normalized: bool = True,
                      *, lexicon: Mapping[str, float] | DataFrame,
                      threshold: float = lx.THRESHOLD, run_ts=None, prefix: str = "") -> DataFrame:
    """Score posts (title, text and their weighted whole) or comments (text).

    Posts get ``title_sentiment``, ``text_sentiment`` and ``overall_sentiment``,
    comments ``sentiment``; both get ``sentiment_analysis``. ``prefix`` keeps the
    results of several methods apart in one table.
    """
    names = TEXT_COLUMNS[check_item_type(item_type)]
    if item_type == "submission":
        outputs = {f"{prefix}{n}_sentiment": source_column(df, n, use_normalized) for n in names}
    else:
        outputs = {f"{prefix}sentiment": source_column(df, "text", use_normalized)}
    df = score_rules(df, outputs, lexicon, threshold)
    if item_type == "submission":
        whole = lx.overall(F.col(f"{prefix}title_sentiment"), F.col(f"{prefix}text_sentiment"),
                           threshold=threshold)
        df = df.withColumn(f"{prefix}overall_sentiment", whole)
    return df.withColumn(f"{prefix}sentiment_analysis",
                         analysis_metadata("vader", use_normalized, run_ts))
