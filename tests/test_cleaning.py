import re
import sys
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadlens.functions import cleaning as cl
from threadlens.operators.clean import clean, clean_batch


def run(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    return [r.x for r in df.select("i", expression(F.col("text")).alias("x")).orderBy("i").collect()]


def cleaned(spark, texts, options=cl.CleanOptions()):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    return [r.text for r in clean(df, ["text"], options).orderBy("i").collect()]


@pytest.mark.parametrize("html, text", [
    ("a <b>bold</b>move", "a boldmove"),
    ("x<script>var a='<p>';</script>y<style>p{}</style>z", "xyz"),
    ("x<script>never closed", "x"),
    ("<!-- note > here -->kept<!DOCTYPE html><?pi?>", "kept"),
    ('<a title="a > b" href=\'c\'>link</a>', "link"),
    ("1 < 2 and 3 > 2, I <3 you", "1 < 2 and 3 > 2, I <3 you"),
    ("&lt;b&gt; &amp;amp; &copy;&nbsp;&#65;&#x42;&#128;&#8364;", "<b> &amp; ©\xa0AB€€"),
    ("AT&T; &unknown; R&D &", "AT&T &unknown R&D &"),
    ("&#xD800;&#1114112;&#99999999999;", "���"),
    ("&notin; &NotEqualTilde;", "∉ ≂̸"),
    ("x&amp<b>Y</b>&amp;lt;", "x&Y&lt;"),
    ("<scripty>s</scripty>", "s"),
])
def test_strip_html(spark, html, text):
    assert run(spark, [html], cl.strip_html) == [text]


def test_urls_stop_at_characters_outside_the_set(spark):
    texts = ["see https://ex.org/a?b=1#frag now", "http://a.b/~me x", "HTTPS://A.B", "ftp://a.b"]
    assert run(spark, texts, cl.remove_urls) == ["see #frag now", "~me x", "HTTPS://A.B", "ftp://a.b"]


def test_zero_padded_references(spark):
    texts = ["&#0000000065;", "&#x000000041;", "&#X0041;b", "&#0;", "&#x110000;", "&#99999999999999999999;", "&#xfffffffffffffffff;", "&#0000000000000000000000000008364;"]
    assert run(spark, texts, cl.strip_html) == ["A", "A", "Ab", "\0", "\ufffd", "\ufffd", "\ufffd", "€"]


def test_emoji_sequences(spark):
    texts = ["a❤️b", "x👩‍👩‍👧y", "🇩🇪!", "1️⃣2", "👍🏽ok", "🏴󠁧󠁢󠁥󠁮󠁧󠁿z", "é ü 你好 “q” —", "©®™", "5 # *"]
    assert run(spark, texts, cl.remove_emojis) == [
        "ab", "xy", "!", "2", "ok", "z", "é ü 你好 “q” —", "", "5 # *"]


def test_whole_chain(spark):
    text = "Die <i>Reise</i>\u00a0begann &amp; endete hier: http://weg.example/karte?x=1 \t#Berge_2 mit @anna 🏔️ um ½ Ｕhr"
    assert cleaned(spark, [text, None, ""]) == ["die reise begann & endete hier: mit um 1⁄2 uhr", "", ""]


def test_switches_turn_stages_off(spark):
    keep = cl.CleanOptions(False, False, False, False, False, False, False)
    text = "<b>A</b>  https://a.b @u #t 🚀 Ａ"
    assert cleaned(spark, [text], keep) == ["<b>A</b>  https://a.b @u #t 🚀 A"]


def test_batch_flags_rows_and_rejects_unknown_types(spark):
    df = spark.createDataFrame([("1", "A <i>b</i>", None)], "id string, title string, text string")
    row = clean_batch(df, "submission").first()
    assert (row.title, row.text, row.cleaned) == ("a b", "", True)
    with pytest.raises(ValueError):
        clean_batch(df, "page")


WHITE = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and re.match(r"\s", chr(c))]
ALPHABET = st.one_of(
    st.sampled_from(list("ab Z9#@_-'.é́ŁßÄㄱ가ﬁ①½…“‍ 　ＡᅡᆨİΣς") + WHITE),
    st.characters(exclude_categories=["Cs", "Co", "Cn"], max_codepoint=0x2FFF))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(ALPHABET, max_size=30), min_size=20, max_size=40))
def test_against_standard_library(spark, texts):
    texts = [t.replace("\0", "") for t in texts]
    no_markup = cl.CleanOptions(remove_html=False, remove_emojis=False, lowercase=False)

    def expected(text):
        text = re.sub(r"@\w+", "", re.sub(r"#\w+", "", text))
        return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text)).strip()

    assert cleaned(spark, texts, no_markup) == [expected(t) for t in texts]


def test_only_sensitive_characters_change_under_nfkc(spark):
    rows = spark.range(0xA0, 0x110000).filter("id < 55296 or id > 57343").select(
        "id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    calm = {r.id for r in rows.filter(~F.col("c").rlike(cl.nfkc_sensitive())).select("id").collect()}
    assert not [c for c in calm if not unicodedata.is_normalized("NFKC", chr(c)) or unicodedata.combining(chr(c))]
    assert {0xE9, 0x4E00, 0xAC00, 0x430} <= calm


def test_ascii_rows_do_not_reach_python(spark):
    df = spark.createDataFrame([("plain",), ("é",), ("ﬁ",)], "text string").coalesce(1)
    exposed = df.select(cl.nfkc_exposed(F.array("text")).alias("x")).collect()
    assert [r.x for r in exposed] == [None, None, ["ﬁ"]]


def test_filter_on_cleaned_text_keeps_the_plan_small(spark):
    df = spark.createDataFrame([("1", "a <b>"), ("2", "")], "id string, text string")
    assert clean(df, ["text"]).filter("text != ''").count() == 1


def test_python_gets_long_texts_in_batches_of_bounded_bytes(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    spark.conf.unset(limit)
    try:
        long = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("é"), 5000).alias("text"))
        assert clean(long, ["text"]).filter(F.length("text") == 5000).count() == 2000
        rows = F.pandas_udf(lambda batch: batch.map(lambda _: len(batch)), "long")
        assert long.select(rows("text").alias("n")).agg(F.max("n")).first()[0] < 500
    finally:
        spark.conf.set(limit, before)
