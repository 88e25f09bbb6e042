"""The driver's tables as posts and comments, and the fixed inputs of the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.scale import IN_PLACE_SETTINGS, spread

START = "2024-01-01 00:00:00"
RUN_TS = "2024-02-01 00:00:00"
POSTS_AS_OF = "2024-01-08 01:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"

# The texts are invented words, so the queries bring a lexicon of frequent ones.
LEXICON = {
    "the": 0.43, "of": -0.87, "and": 0.61, "in": -0.29, "is": 1.13, "that": -1.37,
    "der": 0.71, "die": -0.53, "und": 0.37, "le": 0.47, "de": -0.67, "la": 0.59,
    "en": -0.31, "el": 0.83, "que": -0.41, "worthless": -2.13, "good": 1.91, "bad": -2.47,
    "great": 3.07, "joy": 2.83, "no": -1.19, "like": 1.53, "only": 0.73,
}
STOPWORDS = ("the", "of", "and", "a", "in", "to", "no", "not", "only", "le", "der", "una")

NOISE_HEAD = "See https://ex.org/a?b=1#frag "
NOISE_TAIL = " #Tag_é @user1 ❤️ 🚀 Ａ"
TONE = " It is NOT the very GOOD but never so bad! without doubt great, no joy?? I kinda like it :)"
FORMS = " ﬁne ½ ① ＺＡ"
CONTRACTIONS = " I don't know, it's what they'll say: we CAN'T."


def settings(spark: SparkSession) -> None:
    """What the queries ask of the session."""
    for name, value in {"spark.sql.session.timeZone": "UTC", **IN_PLACE_SETTINGS}.items():
        spark.conf.set(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts are worked on: small inputs are spread over the cores."""
    return spread(table(spark, sf_dir, name))


def minutes_after_start(minutes: str) -> Column:
    return F.expr(f"cast(timestamp_seconds(unix_timestamp(timestamp'{START}') + 60L * ({minutes})) as timestamp_ntz)")


def posts(spark: SparkSession, sf_dir: str, source=table, replies: bool = False) -> DataFrame:
    """``num_comments`` is counted with ``replies`` only, as that takes a join; else it is zero."""
    documents = source(spark, sf_dir, "documents")
    if replies:
        counted = (table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id"))
                   .agg(F.count(F.lit(1)).alias("n")))
        documents = documents.join(counted, "doc_id", "left")
    else:
        documents = documents.withColumn("n", F.lit(None).cast("long"))
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("The great post "), F.expr("doc_id % 7").cast("string"), F.lit(" of "), "source", F.lit(" in "), "lang").alias("title"),
        "text", F.expr("doc_id * 37 % 1001").cast("long").alias("score"),
        minutes_after_start("doc_id").alias("created_utc"),
        F.concat(F.lit("u"), F.expr("doc_id % 97").cast("string")).alias("author"),
        F.coalesce("n", F.lit(0)).cast("long").alias("num_comments"),
        F.concat(F.lit("https://ex.org/p/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("subreddit"),
        F.round(F.expr("doc_id % 101") / F.lit(100.0), 2).alias("upvote_ratio"), "lang")


def comments(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    turns = source(spark, sf_dir, "conversations")
    thread = F.col("conv_id").cast("string")
    parent = F.floor((F.col("turn") - 1) / 2).cast("string")
    return turns.select(
        F.concat(thread, F.lit("_"), F.col("turn").cast("string")).alias("id"),
        thread.alias("submission_id"), "text",
        (F.length("text") % 50).cast("long").alias("score"),
        minutes_after_start("conv_id * 60 + turn").alias("created_utc"),
        F.col("role").alias("author"),
        F.when(F.col("turn") == 0, F.concat(F.lit("t3_"), thread))
         .otherwise(F.concat(F.lit("t1_"), thread, F.lit("_"), parent)).alias("parent_id"),
        (F.col("turn") == 0).alias("is_root"))


def _letters():
    """A deterministic stand-in for a model: logits from letter shares. Local
    functions travel to the workers by value."""

    def make_scorer():
        def predict(texts):
            return [[10.0 * text.count(letter) / max(len(text), 1) for letter in "ane"] for text in texts]
        return predict

    return make_scorer


letter_scorer = _letters()
