"""Keyword queries as Column predicates."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.cleaning import SPACE, WORD
from threadlens.scale import let


def as_list(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def _phrases(keywords: str | Sequence[str]) -> list[list[str]]:
    phrases = [k.lower().split() for k in as_list(keywords)]
    return [words for words in phrases if words]


def keyword_pattern(keywords: str | Sequence[str]) -> str | None:
    """One pattern for all keywords, for lower-cased text: phrases at word edges."""
    phrases = [rf"{SPACE}+".join(map(re.escape, words)) for words in _phrases(keywords)]
    return rf"(?<!{WORD})(?:{'|'.join(phrases)})(?!{WORD})" if phrases else None


def matches(keywords: str | Sequence[str], *texts: Column) -> Column:
    """True where any keyword occurs, in any case, in any of the texts; no keywords
    match nothing. A text without the longest word of a keyword is passed over by a
    plain substring search before the pattern is tried."""
    pattern = keyword_pattern(keywords)
    if pattern is None:
        return F.lit(False)
    longest = sorted({max(words, key=len) for words in _phrases(keywords)})

    def hit(lowered: Column) -> Column:
        possible = F.lit(False)
        for word in longest:
            possible = possible | lowered.contains(word)
        return possible & lowered.rlike(pattern)

    found = F.lit(False)
    for text in texts:
        found = found | F.coalesce(let(F.lower(text), hit), F.lit(False))
    return found


def occurrences(keywords: str | Sequence[str], *texts: Column) -> Column:
    pattern = keyword_pattern(keywords)
    count = F.lit(0)
    if pattern is not None:
        for text in texts:
            count = count + F.coalesce(F.regexp_count(F.lower(text), F.lit(pattern)), F.lit(0))
    return count


def query_string(keywords: str | Sequence[str]) -> str:
    return " OR ".join(f'"{k}"' for k in as_list(keywords))


def extract_keywords(query: Column) -> Column:
    """Keywords of a query string: split at OR, without quotes and outer blanks."""
    return F.transform(F.split(F.replace(query, F.lit('"')), " OR "), lambda k: F.trim(k))
