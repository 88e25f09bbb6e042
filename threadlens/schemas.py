"""Table and struct types shared by all operators."""

from pyspark.sql import types as T

SCORE = T.StructType([
    T.StructField("neg", T.DoubleType()),
    T.StructField("neu", T.DoubleType()),
    T.StructField("pos", T.DoubleType()),
    T.StructField("compound", T.DoubleType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("error", T.StringType()),
])

POSTS_RAW = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_utc", T.TimestampType()),
    T.StructField("author", T.StringType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("upvote_ratio", T.DoubleType()),
])

COMMENTS_RAW = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("text", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_utc", T.TimestampType()),
    T.StructField("author", T.StringType()),
    T.StructField("submission_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("is_root", T.BooleanType()),
])

_RESULT_FIELDS = [
    T.StructField("vader_sentiment", SCORE),
    T.StructField("vader_compound", T.DoubleType()),
    T.StructField("transformer_sentiment", SCORE),
    T.StructField("transformer_compound", T.DoubleType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("processed_at", T.TimestampType()),
]

POSTS = T.StructType(POSTS_RAW.fields + [
    T.StructField("title_cleaned", T.StringType()),
    T.StructField("text_cleaned", T.StringType()),
    T.StructField("title_normalized", T.StringType()),
    T.StructField("text_normalized", T.StringType()),
    T.StructField("cleaned", T.BooleanType()),
] + _RESULT_FIELDS)

COMMENTS = T.StructType(COMMENTS_RAW.fields + [
    T.StructField("text_cleaned", T.StringType()),
    T.StructField("text_normalized", T.StringType()),
] + _RESULT_FIELDS)

QUOTAS = T.StructType([
    T.StructField("grp", T.StringType(), False),
    T.StructField("weight", T.LongType(), False),
    T.StructField("min", T.LongType(), False),
    T.StructField("max", T.LongType()),
])

# What a new row holds in a column that its batch does not have.
DEFAULTS = {"cleaned": False, "processed": False}

ITEM_TYPES = ("submission", "comment")

TEXT_COLUMNS = {"submission": ("title", "text"), "comment": ("text",)}


def check_item_type(item_type: str) -> str:
    if item_type not in ITEM_TYPES:
        raise ValueError(f"unknown item type {item_type!r}, known are {ITEM_TYPES}")
    return item_type
