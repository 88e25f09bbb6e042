import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import exchanged_columns
from threadlens import scale
from threadlens.functions import lexicon as lx
from threadlens.operators.rules import _mapping_lexicon, score_rules, score_rules_batch

LEXICON = {"good": 1.9, "bad": -2.5, "great": 3.1, "no": -1.2, ":)": 2.0, "like": 1.5}


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


@pytest.mark.parametrize("text, total", [
    ("a good day", 1.9),
    ("good, bad.", 1.9 - 2.5),
    ("very good", 1.9 + 0.293),
    ("very very good", 1.9 + 0.293 + 0.293 * 0.95),
    ("slightly bad", -2.5 + 0.293),
    ("it is not good", 1.9 * -0.74),
    ("isn't a good", 1.9 * -0.74),
    ("never so good", (1.9 + 0.293) * 1.25),
    ("without doubt good", 1.9),
    ("without any good", 1.9 * -0.74),
    ("the least good", 1.9 * -0.74),
    ("at least good", 1.9),
    ("a GOOD day", 1.9 + 0.733),
    ("GOOD DAY", 1.9),
    ("VERY good", 1.9 + 0.293 + 0.733),
    ("no good", 1.9 * -0.74),
    ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("good!!", 1.9 + 2 * 0.292),
    ("bad!!!!!!", -2.5 - 4 * 0.292),
    ("good??", 1.9 + 0.36),
    ("good?????", 1.9 + 0.96),
    ("fine :)", 2.0),
    ("kind of good", 1.9),
    ("nothing of note", 0.0),
])
def test_compound(spark, text, total):
    df = spark.createDataFrame([("1", text)], "id string, text string")
    score = score_rules(df, {"s": "text"}, LEXICON).first().s
    assert score.compound == pytest.approx(compound(total), abs=1.1e-4)
    assert score.sentiment == ("positive" if total > 0.2 else "negative" if total < -0.2 else "neutral")


def test_shares(spark):
    df = spark.createDataFrame([("1", "a good bad day")], "id string, text string")
    s = score_rules(df, {"s": "text"}, LEXICON).first().s
    total = 2.9 + 3.5 + 2
    assert (s.pos, s.neg, s.neu) == (round(2.9 / total, 3), round(3.5 / total, 3), round(2 / total, 3))


def test_empty_null_and_blank(spark):
    df = spark.createDataFrame([("1", ""), ("2", None), ("3", "  ")], "id string, text string")
    rows = [tuple(r.s) for r in score_rules(df, {"s": "text"}, LEXICON).orderBy("id").collect()]
    neutral = (0.0, 1.0, 0.0, 0.0, "neutral", None)
    assert rows == [neutral, neutral, (0.0, 0.0, 0.0, 0.0, "neutral", None)]


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,)], "c double")
    assert [r[0] for r in df.select(lx.classify(F.col("c"))).collect()] == ["positive", "negative", "neutral"]


def test_posts_weigh_title_and_text(spark):
    df = spark.createDataFrame([("1", "good", "bad")], "id string, title string, text string")
    row = score_rules_batch(df, "submission", lexicon=LEXICON, run_ts="2024-01-01 00:00:00").first()
    expected = 0.3 * compound(1.9) + 0.7 * compound(-2.5)
    assert row.overall_sentiment.compound == pytest.approx(expected)
    assert row.overall_sentiment.sentiment == "negative"
    assert row.sentiment_analysis.method == "vader"


def test_normalised_text_is_preferred_where_present(spark):
    df = spark.createDataFrame([("1", "good", "bad")], "id string, text string, text_normalized string")
    assert score_rules_batch(df, "comment", True, lexicon=LEXICON).first().sentiment.sentiment == "negative"
    assert score_rules_batch(df, "comment", False, lexicon=LEXICON).first().sentiment.sentiment == "positive"
    assert score_rules_batch(df.drop("text_normalized"), "comment", True, lexicon=LEXICON).first().sentiment.sentiment == "positive"
    with pytest.raises(ValueError):
        score_rules_batch(df, "post", lexicon=LEXICON)


SPELLED = [*LEXICON.items(), ("Good", 0.1), ("GREAT", -3.0), ("bad", -9.0), ("kiss of death", -3.0), ("Kiss  of", 1.0), ("of death row", 2.5), ("bad good", 0.7)]


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_one_result_whatever_the_dictionary_size(spark, monkeypatch, max_rows):
    table = spark.createDataFrame([*SPELLED, (None, 1.0), ("nothing", None), (" ", 5.0)], "token string, valence double")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["Not a GOOD day, but great!", "bad bad", "none here", None, "no good or no bad", "a kiss of death row", "KISS OF DEATH", "bad good kiss"] * 2)]
        + [(None, "good"), (None, "bad")], "k int, text string")
    rows = lambda d: sorted(map(str, d.collect()))
    mapping = rows(score_rules(df, {"s": "text"}, {**dict(SPELLED), "bad": LEXICON["bad"]}))
    monkeypatch.setattr("threadlens.operators.rules.settled_side", lambda d: scale.settled_side(d, max_rows=max_rows))
    scored = score_rules(df, {"s": "text"}, table)
    assert mapping == rows(scored) and not set(scale.IN_PLACE_COLUMNS) & set(scored.columns)
    assert rows(score_rules(df, {"s": "text"}, table.limit(0))) == rows(score_rules(df, {"s": "text"}, {}))
    moved, _ = exchanged_columns(scored)
    assert all("text" not in columns for columns in moved)


def test_a_short_lexicon_table_leaves_the_rows_where_they_are(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["Not a GOOD day, but great!", "none here", None, "a kiss of death row", "KISS OF DEATH", "bad good kiss", "kiss of"])], "k int, text string")
    table = spark.createDataFrame([*SPELLED, (None, 1.0), ("nothing", None), (" ", 5.0)], "token string, valence double")
    rows = lambda d: sorted(map(str, d.collect()))
    monkeypatch.setattr(scale, "MOST_INLINE", 0)
    laid = rows(score_rules(df, {"s": "text"}, table))
    endless = rows(score_rules(df, {"s": "text"}, table.union(spark.createDataFrame([("day", math.inf)], table.schema))))
    monkeypatch.undo()
    assert endless == rows(score_rules(df, {"s": "text"}, table.union(spark.createDataFrame([("day", math.inf)], table.schema))))
    monkeypatch.setattr("threadlens.operators.rules.laid_out", lambda *a: pytest.fail("a layout was written"))
    assert laid == rows(score_rules(df, {"s": "text"}, table))


def plain_merge(words, entries):
    out, i = [], 0
    while i < len(words):
        n = max((n for n in range(2, len(words) - i + 1) if " ".join(words[i:i + n]).lower() in entries), default=1)
        out.append(" ".join(words[i:i + n]))
        i += n
    return out


def test_phrases_are_merged_from_the_left_the_longest_first(spark):
    draw = random.Random(8)
    entries = {" ".join(draw.choice("abc") for _ in range(draw.randint(2, 5))): 1.0 for _ in range(25)}
    texts = [[draw.choice("abcABCx") for _ in range(draw.choice([0, 1, 2, 5, 40]))] for _ in range(120)]
    _, phrases = _mapping_lexicon(entries)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, words array<string>")
    merged = df.select("id", "words", lx.merge_phrases(F.col("words"), phrases).alias("m"), lx.phrase_candidates(F.col("words"), phrases.lengths).alias("c"))
    for r in merged.collect():
        assert r["m"] == plain_merge(texts[r["id"]], entries)
        assert {w.lower() for w in r["m"] if " " in w} <= set(r["c"])


def test_only_words_that_begin_an_entry_together_are_joined(spark):
    entries = {"a b": 1.0, "a b c": 2.0, "b a a": 1.0}
    _, phrases = _mapping_lexicon(entries)
    texts = [["a", "c", "a", "b", "c"], ["b", "a", "b", "a"], ["a"], [], ["A", "A", "B"], ["b", "a", "a", "b", "c", "a"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, words array<string>")
    lower = F.transform("words", F.lower)
    got = df.select("id", lx._heads(lower, phrases.lengths, phrases.pairs).alias("few"), lx._heads(lower, phrases.lengths).alias("all"),
                    lx.merge_phrases(F.col("words"), phrases).alias("m"),
                    lx.merge_phrases(F.col("words"), lx.Phrases(phrases.lengths, phrases.lookup)).alias("n")).orderBy("id").collect()
    assert [[h["pos"] for h in r["few"]] for r in got] == [[2], [0, 1], [], [], [1], [0, 2]]
    assert all(r["m"] == r["n"] == plain_merge(texts[r["id"]], entries) and len(r["few"]) <= len(r["all"]) for r in got)


@pytest.mark.parametrize("text, total", [("a kiss of death", -3.0), ("very kiss of death", -3.0 - 0.293), ("not kiss of death!", 3.0 * 0.74 + 0.292),
                                         ("KISS OF DEATH here", -3.0 - 0.733), ("kiss of deaths", 1.0), ("a kiss of death row", -3.0), ("kiss of kiss of death", -2.0)])
def test_an_entry_of_several_words_counts_as_one(spark, text, total):
    df = spark.createDataFrame([(text,)], "text string")
    assert score_rules(df, {"s": "text"}, dict(SPELLED)).first().s.compound == pytest.approx(compound(total), abs=1e-4)


def test_scoring_needs_no_shuffle(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit("good").alias("text"))
    plan = score_rules(df, {"s": "text"}, LEXICON)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_emphasis_is_looked_for_once(spark):
    text = F.col("id").cast("string")
    scored = spark.range(3).select(lx.rule_score(text, _mapping_lexicon(LEXICON)[0]).alias("s"))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(") == 2      # one for "!", one for "?"


def test_words_without_a_changing_one_near_need_no_closer_look(spark, monkeypatch):
    words = ["good", "bad", "GOOD", "Bad", "no", "or", "like", "very", "VERY", "hardly", "not", "isn't", "Never", "so",
             "without", "doubt", "least", "at", "kind", "of", "but", "a", "day", ":)", "STREET", "road,", "house"]
    draw = random.Random(7)
    texts = [(n, " ".join(draw.choices(words, k=draw.randrange(12)))) for n in range(600)]
    df = spark.createDataFrame(texts, "id int, text string")
    scores = lambda: [tuple(r.s) for r in score_rules(df, {"s": "text"}, LEXICON).orderBy("id").collect()]
    short = scores()
    monkeypatch.setattr(lx, "may_change", lambda word: F.lit(True))
    assert short == scores()


def test_short_word_list_tests_for_entries_before_it_looks_them_up(spark):
    lookup = scale.inline_lookup({f"w{n}": float(n) for n in range(20)}, "double")
    rows = spark.range(25).select("id", F.concat(F.lit("w"), F.col("id").cast("string")).alias("w")).select("id", lookup(F.col("w")).alias("v"))
    assert "INSET" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {r.id: r.v for r in rows.collect()} == {n: float(n) if n < 20 else None for n in range(25)}
