"""Keyword lists of any length, held in a table: one pass over the texts however many
phrases there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.cleaning import SPACE, WORD, empty_if_null
from threadlens.functions.tokens import PLAIN_TOKEN
from threadlens.scale import PART, ROW, joined_in_place, laid_out, let, settled_side

MATCHED = "matched_phrases"


# A phrase is looked for by its first tokens, so many at most.
KEY_TOKENS = 5


def phrase_index(phrases: DataFrame, column: str = "phrase") -> DataFrame:
    """``(phrase, n, key)``: each phrase once, in lower case with single blanks, and its first
    tokens, their number and a hash of them. Phrases without a token are left out."""
    words = F.filter(F.split(F.lower(F.col(column)), f"{SPACE}+"), lambda w: w != "")
    whole = phrases.select(F.array_join(words, " ").alias("phrase")).filter("phrase != ''").distinct()
    first = whole.select("phrase", F.slice(_tokens(F.col("phrase")), 1, KEY_TOKENS).alias("first"))
    return first.select("phrase", F.size("first").alias("n"), run_key(F.col("first")).alias("key")).filter("n > 0")


def _tokens(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(PLAIN_TOKEN), F.lit(0))


def _pattern(phrase: Column) -> Column:
    """The phrase at word edges. The letters come first, as they are quickly looked for; what stands before them is tried after."""
    escaped = F.regexp_replace(phrase, r"([^\p{L}\p{N}_ ])", r"\\$1")
    return F.concat(escaped, F.lit(f"(?<!{WORD}"), escaped, F.lit(f")(?!{WORD})"))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda token: F.xxhash64(token))


def _longer(key: Column, token: Column) -> Column:
    """Key of a run from that of the run without its last token."""
    return F.xxhash64(key, token)


def run_key(tokens: Column) -> Column:
    """Key of a run of tokens."""
    return let(_hashes(tokens), lambda hashes: F.aggregate(F.slice(hashes, F.lit(2), F.greatest(F.size(hashes) - 1, F.lit(0))),
                                                           F.get(hashes, F.lit(0)), _longer))


def run_keys(text: Column, lengths: Sequence[int]) -> Column:
    """Keys of all runs of so many tokens, each from the key of the run a token shorter."""
    def keys(hashes: Column, level: Column, n: int) -> Column:
        wanted = [level] if n in lengths else []
        if n == max(lengths):
            return level
        following = F.transform(F.slice(level, F.lit(1), F.greatest(F.size(level) - 1, F.lit(0))), lambda key, at: _longer(key, F.get(hashes, at + n)))
        return let(following, lambda longer: F.concat(*wanted, keys(hashes, longer, n + 1)))

    return let(_hashes(_tokens(text)), lambda hashes: keys(hashes, hashes, 1))


def phrase_candidates(rows: DataFrame, texts: Sequence[Column], index: DataFrame) -> DataFrame:
    """``(PART, ROW, phrase)`` for the rows of a layout: phrases whose first tokens follow one
    another in a text, each once a row."""
    lengths = sorted(row["n"] for row in index.select("n").distinct().collect()) or [1]      # KEY_TOKENS at most
    held = F.array_distinct(F.flatten(F.array(*[run_keys(text, lengths) for text in texts])))
    return rows.select(PART, ROW, F.explode(held).alias("key")).join(index.select("key", "phrase"), "key").select(PART, ROW, "phrase")


def match_phrases(df: DataFrame, columns: Sequence[str], phrases: DataFrame, column: str = "phrase",
                  max_rows: int | None = None) -> DataFrame:
    """Add ``matched_phrases``: ``(phrase, n)`` of every phrase of the table that occurs in
    one of the columns, in any case, at word edges, with its number of occurrences.

    A phrase can only occur where its tokens follow one another. The rows are laid out once
    and stay where they are: hashes of their runs of tokens meet those of the first tokens of
    the phrases, candidates, nearly all of them hits, go back to their rows, and only there
    the pattern of a candidate is tried. The list is broadcast where it is measured to be small.
    """
    limits = {} if max_rows is None else {"max_rows": max_rows}
    index, _ = settled_side(phrase_index(phrases, column), **limits)
    rows = laid_out(df)
    texts = [F.lower(empty_if_null(F.col(name))) for name in columns]
    candidates = (phrase_candidates(rows, texts, index).groupBy(PART, ROW)
                  .agg(F.sort_array(F.collect_list("phrase")).alias("__candidates")))
    none = F.array().cast("array<struct<phrase:string,n:bigint>>")

    def tried(flat: Column) -> Column:
        """A phrase can only match where it stands in the text with single blanks; the pattern then sees to the edges."""
        times = lambda phrase: F.aggregate(flat, F.lit(0).cast("long"), lambda n, text: n + F.when(
            text.contains(phrase), F.regexp_count(text, _pattern(phrase))).otherwise(F.lit(0)))
        return F.filter(F.transform("__candidates", lambda phrase: F.struct(phrase.alias("phrase"), times(phrase).alias("n"))), lambda hit: hit["n"] > 0)

    flat = F.array(*[F.regexp_replace(text, f"{SPACE}+", " ") for text in texts])
    found = F.when(F.col("__candidates").isNull(), none).otherwise(let(flat, tried))
    return joined_in_place(rows, candidates).withColumn(MATCHED, found).drop(PART, ROW, "__candidates")


def occurrences_of(matched: Column) -> Column:
    """How often the phrases of a list occur, all together."""
    return F.aggregate(matched, F.lit(0).cast("long"), lambda acc, hit: acc + hit["n"])
