"""Rule-based polarity of a text as one Column expression.

Follows the published rule model of Hutto and Gilbert (ICWSM 2014): word valences
from a lexicon, changed by capitals, degree words and negations among the three
preceding words, by contrast ("but") and by punctuation. Everything happens inside
the row, so scoring needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.cleaning import FAST_SPACE
from threadlens.scale import inline_lookup, let

Lookup = Callable[[Column], Column]

# Constants of the published model.
BOOST = 0.293
CAPS = 0.733
NEGATE = -0.74
NEVER = 1.25
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION = 0.292
QUESTION = 0.18
QUESTION_MAX = 0.96
ALPHA = 15.0
BEFORE_BUT = 0.5
AFTER_BUT = 1.5
THRESHOLD = 0.05
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Degree words that strengthen, that weaken, and negations.
STRONGER = (
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly",
    "deeply", "enormously", "entirely", "especially", "exceptionally", "extremely",
    "fabulously", "fully", "greatly", "hella", "highly", "hugely", "incredibly",
    "intensely", "majorly", "more", "most", "particularly", "purely", "quite", "really",
    "remarkably", "so", "substantially", "thoroughly", "totally", "tremendously", "uber",
    "unbelievably", "unusually", "utterly", "very",
)
WEAKER = (
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally",
    "occasionally", "partly", "scarcely", "slightly", "somewhat", "sorta",
)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "despite", "didnt",
    "doesnt", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt",
    "neither", "neednt", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "oughtnt", "rarely", "seldom", "shant", "shouldnt", "uhuh", "uh-uh", "wasnt",
    "werent", "without", "wont", "wouldnt",
)


def rule_tokens(text: Column) -> Column:
    """White-space words without outer punctuation; a word that would be left with
    two characters or fewer keeps it, so emoticons survive."""
    words = F.filter(F.split(text, FAST_SPACE + "+"), lambda w: w != "")
    bare = lambda ws: F.transform(ws, lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    return let(words, lambda ws: F.zip_with(
        ws, bare(ws), lambda w, b: F.when(F.length(b) <= 2, w).otherwise(b)))


def is_upper(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def mixed_case(words: Column) -> Column:
    """Some words, but not all, are in capitals. The second look at the words is
    taken only where the first one found any."""
    return F.exists(words, is_upper) & ~F.forall(words, is_upper)


@lru_cache(maxsize=1)
def _word_roles() -> dict[str, Lookup]:
    return {"boost": inline_lookup({**dict.fromkeys(STRONGER, BOOST), **dict.fromkeys(WEAKER, -BOOST)},
                                   "double"),
            "negation": inline_lookup(dict.fromkeys(NEGATIONS, True), "boolean")}


def boost_of(word: Column) -> Column:
    """Degree of a word that strengthens (+) or weakens (-), else NULL."""
    return _word_roles()["boost"](word)


def is_negation(word: Column) -> Column:
    return F.coalesce(_word_roles()["negation"](word), word.contains("n't"))


# Words that may change the valence of a lexicon word near them, or their own.
_CHANGING = sorted({*STRONGER, *WEAKER, *NEGATIONS, "no", "least", "kind"})


def may_change(word: Column) -> Column:
    """Whether the valence at this lower-case word or after it needs a closer look."""
    return word.isin(_CHANGING) | word.contains("n't")


def token_context(tokens: Column) -> Column:
    """Each token with the three before it, read off the array."""
    return let(tokens, lambda ts: F.transform(ts, lambda token, i: F.struct(
        i.alias("pos"), token.alias("token"), F.get(ts, i - 1).alias("prev1"),
        F.get(ts, i - 2).alias("prev2"), F.get(ts, i - 3).alias("prev3"))))


def negation_factor(lower: Column, i: Column, distance: Column) -> Column:
    """What the word ``distance`` before position ``i`` does to the valence there."""
    word = F.get(lower, i - distance)
    between = F.slice(lower, i - distance + 2, distance - 1)
    return (F.when((word == "never") & F.exists(between, lambda t: t.isin("so", "this")), F.lit(NEVER))
             .when((word == "without") & F.exists(between, lambda t: t == "doubt"), F.lit(1.0))
             .when(is_negation(word), F.lit(NEGATE))
             .otherwise(F.lit(1.0)))


def word_valences(words: Column, lookup: Lookup, lowered: Column | None = None) -> Column:
    """``(pos, valence)`` of the lexicon words of a text, each in its context.
    ``lowered`` are the words in lower case, where the caller has them."""
    valences = lambda lower: let(F.transform(lower, lookup), lambda known: _valences(words, lower, known))
    return valences(lowered) if lowered is not None else let(F.transform(words, F.lower), valences)


def _valences(words: Column, lower: Column, known: Column) -> Column:
    damping = F.array(*[F.lit(x) for x in DISTANCE_DAMPING])

    def with_caps(value: Column, shouted: Column, amount: float) -> Column:
        signed = F.when(value > 0, F.lit(amount)).otherwise(F.lit(-amount))
        return value + F.when(shouted, signed).otherwise(F.lit(0.0))

    def shouted(i: Column, caps: Column) -> Column:
        word = F.get(words, i)
        return caps & (F.get(lower, i) != word) & (F.upper(word) == word)

    def at(i: Column, caps: Column, marks: Column) -> Column:
        loud = with_caps(F.get(known, i), shouted(i, caps), CAPS)
        quiet = F.get(marks, i - 1).isNull() & F.get(marks, i - 2).isNull() & F.get(marks, i - 3).isNull() & F.get(marks, i).isNull()
        return F.struct(i.alias("pos"), F.when(quiet, loud).otherwise(changed(i, caps)).alias("valence"))

    def changed(i: Column, caps: Column) -> Column:
        token, value = F.get(lower, i), F.get(known, i)
        first, second, third = (F.get(lower, i - d) for d in (1, 2, 3))
        denied = ((first == "no") | (second == "no")
                  | ((third == "no") & first.isin("or", "nor")))
        start = (F.when(denied, value * NEGATE)
                  .when((token == "no") & F.get(known, i + 1).isNotNull(), F.lit(0.0))
                  .otherwise(value))

        def look_back(total: Column, distance: Column) -> Column:
            j = i - distance
            boost = boost_of(F.get(lower, j))
            signed = F.when(total < 0, -boost).otherwise(boost)
            loud = F.when(total > 0, F.lit(CAPS)).otherwise(F.lit(-CAPS))
            degree = signed + F.when(shouted(j, caps), loud).otherwise(F.lit(0.0))
            boosted = total + F.coalesce(degree * F.get(damping, distance - 1), F.lit(0.0))
            return (F.when((j < 0) | F.get(known, j).isNotNull(), total)
                     .otherwise(boosted * negation_factor(lower, i, distance)))

        looked = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)),
                             with_caps(start, shouted(i, caps), CAPS), look_back)
        least = ((first == "least") & F.get(known, i - 1).isNull()
                 & ~F.coalesce(second.isin("at", "very"), F.lit(False)))
        final = looked * F.when(least, F.lit(NEGATE)).otherwise(F.lit(1.0))
        degree_word = boost_of(token).isNotNull() | (
            (token == "kind") & (F.get(lower, i + 1) == "of"))
        return F.when(degree_word, F.lit(0.0)).otherwise(final)

    places = F.transform(known, lambda v, i: F.when(v.isNotNull(), i))
    hits = F.filter(places, lambda i: i.isNotNull())
    marks = F.transform(lower, lambda word: F.when(may_change(word), True))
    # Asked only where a word is in capitals, so some are; that others are not is soon seen.
    return let(~F.forall(words, is_upper), lambda caps: let(marks, lambda marked: F.transform(hits, lambda i: at(i, caps, marked))))


def contrast(hits: Column, words: Column, lowered: Column | None = None) -> Column:
    """Halve what precedes the first "but", raise what follows it by half.
    ``lowered`` are the words in lower case, where the caller has them."""
    first = F.array_position(F.transform(words, F.lower) if lowered is None else lowered, "but").cast("int") - 1

    def weighed(hit: Column, at: Column) -> Column:
        factor = (F.when(at < 0, F.lit(1.0)).when(hit["pos"] < at, F.lit(BEFORE_BUT))
                   .when(hit["pos"] > at, F.lit(AFTER_BUT)).otherwise(F.lit(1.0)))
        return F.struct(hit["pos"].alias("pos"), (hit["valence"] * factor).alias("valence"))

    return let(first, lambda at: F.transform(hits, lambda hit: weighed(hit, at)))


def exclamation_emphasis(text: Column) -> Column:
    count = F.least(F.length(text) - F.length(F.replace(text, F.lit("!"))), F.lit(4))
    return count * F.lit(EXCLAMATION)


def question_emphasis(text: Column) -> Column:
    found = F.length(text) - F.length(F.replace(text, F.lit("?")))
    return let(found, lambda count: F.when(count <= 1, F.lit(0.0)).when(count <= 3, count * F.lit(QUESTION))
               .otherwise(F.lit(QUESTION_MAX)))


def classify(compound: Column, threshold: float = THRESHOLD) -> Column:
    return (F.when(compound >= threshold, F.lit("positive"))
             .when(compound <= -threshold, F.lit("negative"))
             .otherwise(F.lit("neutral")))


def neutral_score(error: Column | None = None) -> Column:
    return score_struct(F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit("neutral"), error)


def score_struct(neg: Column, neu: Column, pos: Column, compound: Column, sentiment: Column,
                 error: Column | None = None) -> Column:
    error = F.lit(None).cast("string") if error is None else error
    return F.struct(neg.alias("neg"), neu.alias("neu"), pos.alias("pos"),
                    compound.alias("compound"), sentiment.alias("sentiment"), error.alias("error"))


def summarize(hits: Column, n_words: Column, emphasis: Column,
              threshold: float = THRESHOLD) -> Column:
    """Compound score, shares and class of one text from its word valences."""
    def totals(values: Column) -> Column:
        add = lambda part: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + part(x))
        return F.struct(
            add(lambda x: F.when(x > 0, x + 1.0).otherwise(F.lit(0.0))).alias("pos"),
            add(lambda x: F.when(x < 0, 1.0 - x).otherwise(F.lit(0.0))).alias("neg"),
            F.size(F.filter(values, lambda x: x != 0)).alias("n"),
            add(lambda x: x).alias("sum"))

    def finish(acc: Column) -> Column:
        raw = acc["sum"] + F.signum(acc["sum"]) * emphasis
        compound = F.bround(raw / F.sqrt(raw * raw + ALPHA), 4)
        pos = acc["pos"] + F.when(acc["pos"] > acc["neg"], emphasis).otherwise(F.lit(0.0))
        neg = acc["neg"] + F.when(acc["pos"] < acc["neg"], emphasis).otherwise(F.lit(0.0))
        neu = (n_words - acc["n"]).cast("double")
        total = pos + neg + neu
        share = lambda part: F.coalesce(F.bround(F.try_divide(part, total), 3), F.lit(0.0))
        return let(compound, lambda c: score_struct(share(neg), share(neu), share(pos), c,
                                                    classify(c, threshold)))

    return let(let(F.transform(hits, lambda hit: hit["valence"]), totals), finish)


@dataclass(frozen=True)
class Phrases:
    """Lexicon entries of several words: ``lengths`` gives how many words the entries have that
    a word begins (NULL for none), ``lookup`` the valence of words joined by blanks. ``pairs``,
    where there is one, gives the lengths of the entries that two words begin: a common word
    begins entries wherever it stands, two words that do seldom follow one another."""

    lengths: Lookup
    lookup: Lookup
    pairs: Lookup | None = None


def _heads(lower: Column, lengths: Lookup, pairs: Lookup | None = None) -> Column:
    """``(pos, ns)`` of the words that begin entries, with the lengths there is room for. Each
    word is looked up once."""
    known = F.transform(lower, lengths) if pairs is None else F.transform(
        lower, lambda w, i: F.when(lengths(w).isNotNull(), pairs(F.concat(w, F.lit(" "), F.get(lower, i + 1)))))
    places = F.transform(known, lambda ns, i: F.when(ns.isNotNull(), F.struct(
        i.alias("pos"), F.filter(ns, lambda n: n <= F.size(lower) - i).alias("ns"))))
    return F.filter(places, lambda head: F.size(head["ns"]) > 0)


def _runs_at(lower: Column, head: Column) -> Column:
    # Word by word, as a slice of an array has Spark copy all of it.
    run = lambda n: F.array_join(F.transform(F.sequence(head["pos"], head["pos"] + n - 1), lambda at: F.get(lower, at)), " ")
    return F.transform(head["ns"], lambda n: F.struct(n.alias("n"), run(n).alias("run")))


def phrase_candidates(words: Column, lengths: Lookup) -> Column:
    """Runs of words in lower case, joined by blanks, that may be entries."""
    return let(F.transform(words, F.lower), lambda lower: F.flatten(F.transform(
        _heads(lower, lengths), lambda head: F.transform(_runs_at(lower, head), lambda r: r["run"]))))


def merge_phrases(words: Column, phrases: Phrases) -> Column:
    """Words with each entry of several words made one, joined by a blank.

    From left to right, and of the entries that begin at a word the longest: what it
    covers begins no other. An entry counts as one word from then on.
    """
    return let(words, lambda ws: let(F.transform(ws, F.lower), lambda lower: _merged(ws, lower, phrases, lambda merged, _: merged)))


def _merged(words: Column, lowered: Column, phrases: Phrases, result: Callable[[Column, Column], Column]) -> Column:
    """``result`` of the merged words and these in lower case; ``lowered`` are the words in lower case."""
    def longest_at(lower: Column) -> Column:
        known = lambda head: F.array_max(F.transform(F.filter(
            _runs_at(lower, head), lambda r: phrases.lookup(r["run"]).isNotNull()), lambda r: r["n"]))
        places = F.transform(_heads(lower, phrases.lengths, phrases.pairs), lambda head: F.struct(head["pos"].alias("pos"), known(head).alias("n")))
        return F.filter(places, lambda m: m["n"].isNotNull())

    def taken(found: Column) -> Column:
        none = F.array().cast("array<struct<pos:int,n:int>>")
        return F.aggregate(found, F.struct(F.lit(0).alias("stop"), none.alias("taken")), lambda acc, m: F.when(
            m["pos"] >= acc["stop"], F.struct((m["pos"] + m["n"]).alias("stop"), F.array_append(acc["taken"], m).alias("taken")))
            .otherwise(acc), lambda acc: acc["taken"])

    def rebuilt(ws: Column, runs: Column) -> Column:
        after = lambda run, k: F.coalesce(F.get(runs, k + 1)["pos"], F.size(ws))
        parts = F.transform(runs, lambda run, k: F.concat(
            F.array(F.array_join(F.slice(ws, run["pos"] + 1, run["n"]), " ")),
            F.slice(ws, run["pos"] + run["n"] + 1, after(run, k) - run["pos"] - run["n"])))
        return F.concat(F.slice(ws, F.lit(1), F.get(runs, F.lit(0))["pos"]), F.flatten(parts))

    return let(longest_at(lowered), lambda found: F.when(F.size(found) == 0, result(words, lowered)).otherwise(
        let(let(taken(found), lambda runs: rebuilt(words, runs)), lambda merged: result(merged, F.transform(merged, F.lower)))))


def rule_score(text: Column, lookup: Lookup, threshold: float = THRESHOLD, phrases: Phrases | None = None) -> Column:
    """Polarity struct of a text; empty and NULL texts are neutral. Entries of several words
    count as one word."""
    value_of = lookup
    # Words, and words in lower case.
    both_of = lambda words, lower: F.struct(words.alias("words"), lower.alias("lower"))
    split = lambda t: let(rule_tokens(t), lambda words: both_of(words, F.transform(words, F.lower)))
    if phrases is not None:
        value_of = lambda w: F.when(w.contains(" "), phrases.lookup(w)).otherwise(lookup(w))
        plain = split
        split = lambda t: let(plain(t), lambda both: _merged(both["words"], both["lower"], phrases, both_of))

    def score(t: Column) -> Column:
        # Looked for once: the summary reads it several times.
        scored = let(exclamation_emphasis(t) + question_emphasis(t), lambda emphasis: let(split(t), lambda both: let(both["words"], lambda words: let(
            both["lower"], lambda lower: summarize(
                contrast(word_valences(words, value_of, lower), words, lower), F.size(words), emphasis, threshold)))))
        return F.when(t == "", neutral_score()).otherwise(scored)

    return let(F.coalesce(text, F.lit("")), score)


def overall(title: Column, text: Column, title_weight: float = 0.3,
            threshold: float = THRESHOLD) -> Column:
    """Weighted mean of title and text scores, classed by the threshold."""
    mix = lambda pair, name: (pair["title"][name] * title_weight
                              + pair["text"][name] * (1 - title_weight))
    return let(F.struct(title.alias("title"), text.alias("text")), lambda pair: score_struct(
        mix(pair, "neg"), mix(pair, "neu"), mix(pair, "pos"), mix(pair, "compound"),
        classify(mix(pair, "compound"), threshold)))
