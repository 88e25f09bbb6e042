import pytest
from pyspark.sql import functions as F

from threadlens import scale
from threadlens.functions import tokens as tk
from threadlens.operators.normalize import normalize, normalize_batch


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "text string").select(expression(F.col("text"))).first()[0]


def test_contractions(spark):
    text = "I'm sure they don't; we CAN'T, it’s Bob's n'table"
    assert one(spark, text, tk.tokenize) == [
        "I", "'m", "sure", "they", "do", "n't", ";", "we", "CA", "N'T", ",", "it", "’s", "Bob", "'s", "n", "'", "table"]
    assert one(spark, "don't", lambda c: tk.tokenize(c, False)) == ["don", "'", "t"]


def test_stopwords_keep_duplicates_and_important_words(spark):
    text = "not The cat, the cat but the dog"
    words = lambda c: tk.tokenize(c)
    assert one(spark, text, lambda c: tk.remove_stopwords(words(c), ["the", "not", "but"])) == [
        "not", "cat", ",", "cat", "but", "dog"]
    assert one(spark, text, lambda c: tk.remove_stopwords(words(c), ["the", "not", "but"], keep=())) == [
        "cat", ",", "cat", "dog"]


def test_normalise_modes(spark):
    df = spark.createDataFrame([("1", "The cats were RUNNING 42 times", None)], "id string, title string, text string")
    row = normalize_batch(df, "submission").first()
    assert row.title_normalized == "the cat be run 42 times"
    assert (row.text_normalized, row.normalized, row.title_original) == ("", True, "The cats were RUNNING 42 times")
    assert normalize(df, ["title"], lemma="lower").first().title_normalized == "the cats were running 42 times"
    assert normalize(df, ["title"], lemma="none").first().title_normalized == "The cats were RUNNING 42 times"
    with pytest.raises(ValueError):
        normalize(df, ["title"], lemma="stem")


def test_kept_stopwords_are_not_lemmatised(spark):
    df = spark.createDataFrame([("1", "NOT the cats")], "id string, text string")
    row = normalize(df, ["text"], stopwords=["not", "the"]).first()
    assert row.text_normalized == "NOT cat"


def test_one_result_whatever_the_lemma_table_size(spark, monkeypatch):
    lemmas = spark.createDataFrame([("cats", "cat", "NOUN"), ("Cats", "CAT", "NOUN"), ("paris", "pari", "PROPN"), ("7", "seven", "NUM")],
                                   "token string, lemma string, pos string")
    df = spark.createDataFrame([("1", "Cats in Paris 7"), ("2", "nothing here"), (None, None), (None, "cats")], "k string, text string")
    rows = lambda d: sorted(r.text_normalized for r in d.collect())
    want = ["", "cat", "cat in Paris 7", "nothing here"]
    assert rows(normalize(df, ["text"], lemmas=lemmas)) == want
    plain = scale.attach_dictionary
    monkeypatch.setattr("threadlens.operators.normalize.attach_dictionary", lambda *a: plain(*a, max_rows=1))
    joined = normalize(df, ["text"], lemmas=lemmas)
    assert not set(scale.IN_PLACE_COLUMNS) & set(joined.columns) and rows(joined) == want


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_lemmas_of_a_table_are_looked_up_for_whole_batches(spark, monkeypatch, max_rows):
    """Several columns, repeated and missing words, stop words kept as written, and no look at a single word."""
    entries = {f"w{i}": f"l{i}" for i in range(0, 60, 2)} | {"paris": "", "not": "never", "can": "be able"}
    lemmas = spark.createDataFrame(list(entries.items()), "token string, lemma string")
    texts = [(i, " ".join(f"W{(i * k) % 61}" for k in range(i % 9)) + " NOT in Paris", None if i % 4 == 0 else f"we CAN'T w{i}") for i in range(80)]
    df = spark.createDataFrame([*texts, (None, None, None), (3, "", "")], "k int, a string, b string").repartition(3)
    plain = scale.attach_dictionary
    monkeypatch.setattr("threadlens.operators.normalize.attach_dictionary", lambda *a: plain(*a, max_rows=max_rows))
    monkeypatch.setattr(scale.Found, "__call__", lambda *a: pytest.fail("one word at a time"))
    options = dict(stopwords=["not", "in"])
    rows = lambda d: sorted(map(repr, d.select("k", "a_normalized", "b_normalized", "a_original", "b_original").collect()))
    got = rows(normalize(df, ["a", "b"], lemmas=lemmas, **options))
    assert got == rows(normalize(df, ["a", "b"], lemmas=entries, **options))
    assert rows(normalize(df.limit(0), ["a", "b"], lemmas=lemmas)) == [] and len(rows(normalize(df, ["a"], lemmas=lemmas.limit(0)).withColumns(
        {"b_normalized": F.lit(""), "b_original": F.lit("")}))) == 82


def test_words_before_an_apostrophe_are_split_as_before(spark):
    """The quick way for other words takes the same tokens."""
    from itertools import product
    texts = [("".join(p),) for n in range(1, 6) for p in product("nt'a ’", repeat=n)]
    df = spark.createDataFrame(texts, "t string")
    slow = tk.SPLIT_TOKEN.split("|", 1)[1]
    both = df.select(F.regexp_extract_all("t", F.lit(slow), F.lit(0)).alias("a"), F.regexp_extract_all("t", F.lit(tk.SPLIT_TOKEN), F.lit(0)).alias("b"))
    assert slow.startswith(tk.WORD + "+?") and both.filter("a != b").count() == 0
