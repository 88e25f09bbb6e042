"""Tokens, stop words and dictionary lemmas as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.cleaning import FAST_SPACE, SPACE, WORD
from threadlens.scale import let

# Stop words that carry sentiment and are kept.
KEEP_WORDS = ("no", "not", "very", "never", "none", "nothing", "few", "more", "most",
              "always", "too", "only", "just", "any", "all", "but")

_SYMBOL = r"[^\p{L}\p{N}_" + SPACE[1:]
PLAIN_TOKEN = rf"{WORD}+|{_SYMBOL}"
_EDGE = rf"(?!{WORD})"
_NEGATED = rf"(?i:n['’]t){_EDGE}"
_CLITIC = rf"['’](?i:s|m|re|ve|ll|d){_EDGE}"
# Only a word before an apostrophe may have to be split.
SPLIT_TOKEN = rf"{WORD}++(?!['’])|{WORD}+?(?={_NEGATED})|{_NEGATED}|{_CLITIC}|{PLAIN_TOKEN}"

# A small starter dictionary of irregular forms; pass a larger one for real use.
STARTER_LEMMAS = {
    "am": "be", "is": "be", "are": "be", "was": "be", "were": "be", "been": "be",
    "being": "be", "'m": "be", "'re": "be", "has": "have", "had": "have",
    "having": "have", "'ve": "have", "does": "do", "did": "do", "done": "do",
    "doing": "do", "n't": "not", "'ll": "will", "ca": "can", "wo": "will",
    "goes": "go", "went": "go", "gone": "go", "going": "go", "said": "say",
    "says": "say", "made": "make", "makes": "make", "making": "make", "took": "take",
    "taken": "take", "takes": "take", "taking": "take", "got": "get", "gets": "get",
    "getting": "get", "saw": "see", "seen": "see", "sees": "see", "seeing": "see",
    "came": "come", "comes": "come", "coming": "come", "knew": "know", "known": "know",
    "knows": "know", "thought": "think", "thinks": "think", "thinking": "think",
    "found": "find", "finds": "find", "gave": "give", "given": "give", "gives": "give",
    "told": "tell", "tells": "tell", "felt": "feel", "feels": "feel", "left": "leave",
    "kept": "keep", "keeps": "keep", "began": "begin", "begun": "begin",
    "wrote": "write", "written": "write", "writes": "write", "ran": "run",
    "runs": "run", "running": "run", "bought": "buy", "brought": "bring",
    "tries": "try", "tried": "try", "trying": "try", "uses": "use", "used": "use",
    "using": "use", "better": "good", "best": "good", "worse": "bad", "worst": "bad",
    "men": "man", "women": "woman", "children": "child", "people": "person",
    "feet": "foot", "teeth": "tooth", "mice": "mouse", "lives": "life", "wives": "wife",
    "cats": "cat", "dogs": "dog", "barking": "bark", "barked": "bark",
}


def tokenize(text: Column, split_contractions: bool = True) -> Column:
    """Words and single symbols; contractions split before the clitic."""
    extract = lambda t, pattern: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    if not split_contractions:
        return extract(text, PLAIN_TOKEN)
    return let(text, lambda t: F.when(t.contains("'") | t.contains("’"), extract(t, SPLIT_TOKEN))
               .otherwise(extract(t, PLAIN_TOKEN)))


def remove_stopwords(tokens: Column, stopwords: Iterable[str],
                     keep: Iterable[str] = KEEP_WORDS) -> Column:
    dropped = sorted({w.lower() for w in stopwords} - set(keep))
    return F.filter(tokens, lambda t: ~F.lower(t).isin(dropped)) if dropped else tokens


def lemmatize(tokens: Column, lookup: Callable[[Column], Column],
              stopwords: Iterable[str] = (), keep: Iterable[str] = KEEP_WORDS,
              keeps_some: bool = False) -> Column:
    """Lemma of each token; unknown words are lower-cased, numbers have no case and
    no entry. With a stop list, the kept words of it stay as they are. Where the
    dictionary ``keeps_some`` tokens as written, their lemma is empty."""
    verbatim = sorted({w.lower() for w in stopwords} & set(keep))
    lowered = F.transform(tokens, F.lower)
    if not verbatim and not keeps_some:
        return F.transform(lowered, lambda low: F.coalesce(lookup(low), low))

    def one(token: Column, low: Column) -> Column:
        lemma = F.coalesce(F.when(lookup(low) == "", token).otherwise(lookup(low)), low)
        return F.when(low.isin(verbatim), token).otherwise(lemma) if verbatim else lemma

    return let(tokens, lambda words: F.zip_with(words, F.transform(words, F.lower), one))


def lemmatize_found(tokens: Column, lemmas: Column, stopwords: Iterable[str] = (), keep: Iterable[str] = KEEP_WORDS) -> Column:
    """``lemmatize`` with the lemmas of all tokens, in their order, looked up before: NULL
    for an unknown word, empty for one kept as written."""
    verbatim = sorted({w.lower() for w in stopwords} & set(keep))

    def one(token: Column, lemma: Column) -> Column:
        known = F.when(lemma.isNull(), F.lower(token)).when(lemma == "", token).otherwise(lemma)
        return F.when(F.lower(token).isin(verbatim), token).otherwise(known) if verbatim else known

    return F.zip_with(tokens, lemmas, one)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def truncate_tokens(text: Column, max_length: int) -> Column:
    """The first ``max_length`` white-space tokens, as the model's input limit."""
    words = F.filter(F.split(text, FAST_SPACE + "+"), lambda t: t != "")
    return F.array_join(F.slice(words, 1, max_length), " ")
