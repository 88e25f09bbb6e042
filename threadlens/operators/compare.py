"""Side-by-side comparison of the two scoring methods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.schemas import check_item_type


def _comparison(item_type: str, text: Column, rules: Column, model: Column) -> list[Column]:
    return [
        F.lit(item_type).alias("content_type"), F.col("id"), text.alias("text"),
        rules["sentiment"].alias("vader_sentiment"), rules["compound"].alias("vader_compound"),
        model["sentiment"].alias("transformer_sentiment"),
        model["compound"].alias("transformer_compound"),
        (rules["sentiment"] == model["sentiment"]).alias("agreement"),
    ]


def _text_of(item_type: str) -> Column:
    body = F.coalesce(F.col("text"), F.lit(""))
    if item_type == "submission":
        return F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit(" "), body)
    return body


def compare_scored(df: DataFrame, item_type: str, rules_prefix: str = "rules_",
                   model_prefix: str = "model_") -> DataFrame:
    """Comparison of rows that carry both results: a projection, no join."""
    result = "overall_sentiment" if check_item_type(item_type) == "submission" else "sentiment"
    return df.select(*_comparison(item_type, _text_of(item_type),
                                  F.col(rules_prefix + result), F.col(model_prefix + result)))


def compare(rules: DataFrame, model: DataFrame, item_type: str) -> DataFrame:
    """Comparison of two separately scored tables, matched by id."""
    result = "overall_sentiment" if check_item_type(item_type) == "submission" else "sentiment"
    other = model.select("id", F.col(result).alias("_model_result"))
    return rules.join(other, "id").select(*_comparison(
        item_type, _text_of(item_type), F.col(result), F.col("_model_result")))


def agreement_summary(comparison: DataFrame) -> DataFrame:
    """Number of items and agreement in percent with one decimal."""
    share = F.avg(F.col("agreement").cast("double")) * 100
    return comparison.agg(F.count(F.lit(1)).alias("items"), F.round(share, 1).alias("agreement_rate"))


def disagreements(comparison: DataFrame, examples: int | None = None) -> DataFrame:
    """Items the methods class differently; with ``examples``, a short report of
    the first ones."""
    differing = comparison.filter(~F.col("agreement"))
    if examples is None:
        return differing
    two_digits = lambda name: F.format_string("%.2f", F.col(name)).alias(name)
    return (differing.orderBy("content_type", "id").limit(examples)
            .select("content_type", "id", F.substring("text", 1, 100).alias("text"),
                    "vader_sentiment", two_digits("vader_compound"),
                    "transformer_sentiment", two_digits("transformer_compound")))
