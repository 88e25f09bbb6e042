import pytest
from pyspark.sql import functions as F

from tests.conftest import exchanged_columns
from threadlens.functions.keywords import matches, occurrences
from threadlens.operators.phrases import MATCHED, match_phrases, phrase_candidates, phrase_index
from threadlens.operators.search import found_posts, keyword_search
from threadlens.scale import laid_out

TEXTS = ["The quick  Brown fox", "quick-brown fox; the fox", "a fox's tail (c++ and c#)", None, "", "AN AN AN an", "x\n\ty z x y z", "über-STRASSE 100% sure?",
         "C++ c++", "dog. Dog! hotdog", "-a b- -a", "\U0001f680 to the moon \U0001f680\U0001f680"]
PHRASES = ["quick brown", "FOX", " the  fox ", "c++", "C#", "an an", "x y z", "über-strasse", "100%", "dog", "-a", "b-", "\U0001f680", "to the moon", "", "   ", None,
           "nowhere at all", "fox", "(c++ and", "sure?", "Strasse 100%"]


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(str(i), t, TEXTS[-1 - i]) for i, t in enumerate(TEXTS)] * 2 + [(None, "fox", "dog")]
    return spark.createDataFrame(rows, "id string, title string, text string").withColumns({"token": F.lit("clash"), "phrase": F.lit("clash")})


@pytest.mark.parametrize("max_rows", [None, 0])
def test_phrase_table_equals_one_phrase_after_the_other(spark, posts, max_rows):
    table = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    out = match_phrases(posts, ["title", "text"], table, max_rows=max_rows)
    alone = sorted({" ".join(p.lower().split()) for p in PHRASES if p} - {""})
    want = posts.select("id", *[occurrences(p, F.col("title"), F.col("text")).alias(f"p{i}") for i, p in enumerate(alone)])
    expected = sorted(repr((r["id"], [(p, r[f"p{i}"]) for i, p in enumerate(alone) if r[f"p{i}"]])) for r in want.collect())
    assert sorted(repr((r["id"], [(m["phrase"], m["n"]) for m in r[MATCHED]])) for r in out.collect()) == expected
    assert out.columns == [*posts.columns, MATCHED]
    moved, _ = exchanged_columns(out)
    assert all(not columns & {"title", "text"} for columns in moved)


def test_a_common_word_is_no_way_to_look_for_a_phrase(spark):
    posts = spark.createDataFrame([(str(i), "t", f"the word w{i}") for i in range(300)], "id string, title string, text string")
    table = spark.createDataFrame([(f"the word w{i}",) for i in range(0, 900, 3)], "phrase string")
    out = match_phrases(posts, ["text"], table).filter(F.size(MATCHED) > 0)
    assert sorted(int(r["id"]) for r in out.collect()) == list(range(0, 300, 3))


def test_search_by_a_table_of_phrases(spark, posts):
    table = spark.createDataFrame([("fox",), ("dog",)], "phrase string")
    found = sorted(str(r["id"]) for r in found_posts(posts, table, time_filter=None).collect())
    assert found == sorted(str(r["id"]) for r in posts.filter(matches(["fox", "dog"], F.col("title"), F.col("text"))).collect())
    timed = posts.withColumns({"created_utc": F.lit("2024-01-01").cast("timestamp"), "subreddit": F.lit("s"), "score": F.lit(1)})
    best = keyword_search(timed, table, search_all=True, limit=3, as_of="2024-01-02").collect()
    assert [sum(m["n"] for m in r[MATCHED]) for r in best] == [3, 3, 3]
    assert found_posts(posts, table.limit(0), time_filter=None).count() == 0 and found_posts(posts.limit(0), table, time_filter=None).count() == 0


def test_words_that_do_not_follow_one_another_bring_no_candidates(spark):
    words = [f"w{i}" for i in range(40)]
    rows = laid_out(spark.createDataFrame([(" ".join(words),), (" ".join(words[::-1]),)], "text string"))
    pairs = spark.createDataFrame([(f"{a} {b}",) for a in words for b in words if a != b], "phrase string")
    assert phrase_candidates(rows, [F.col("text")], phrase_index(pairs)).count() == 2 * 39
    both = match_phrases(rows.select("text"), ["text"], pairs)
    assert [len(r[MATCHED]) for r in both.collect()] == [39, 39]


def test_phrases_longer_than_their_key(spark):
    posts = spark.createDataFrame([("a b c d e f g! a b c d e f gh",), ("a b c d e x g",)], "text string")
    table = spark.createDataFrame([("a b c d e f g",), ("A B  c d e",), ("x g",)], "phrase string")
    assert [[tuple(m) for m in r[MATCHED]] for r in match_phrases(posts, ["text"], table).orderBy("text").collect()] == [
        [("a b c d e", 2), ("a b c d e f g", 1)], [("a b c d e", 1), ("x g", 1)]]
