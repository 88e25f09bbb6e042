"""Stored tables: create, read, look up, and the projection into storage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.schemas import COMMENTS, POSTS, check_item_type


def table_schema(item_type: str) -> T.StructType:
    return POSTS if check_item_type(item_type) == "submission" else COMMENTS


def empty_table(spark: SparkSession, item_type: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(item_type))


def read_table(spark: SparkSession, path: str, item_type: str) -> DataFrame:
    return spark.read.schema(table_schema(item_type)).parquet(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Collected records as JSON lines, without schema inference."""
    return spark.read.schema(schema).json(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated lexicon file: token, mean valence, further columns ignored."""
    return (spark.read.option("sep", "\t").option("quote", "")
            .schema("token string, valence double").csv(path))


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a table to a new directory; an existing one is never replaced, as the
    rows may still be read from it."""
    df.write.mode("errorifexists").parquet(path)


def by_id(table: DataFrame, item_id: str) -> DataFrame:
    """The row with this key; the comparison reaches the parquet scan."""
    return table.filter(F.col("id") == item_id)


def to_storage(df: DataFrame, item_type: str,
               rules_prefix: str = "rules_", model_prefix: str = "model_") -> DataFrame:
    """Columns of an analysed table under their storage names.

    The analysis keeps cleaned text in ``title`` and ``text``; storage keeps it in
    ``*_cleaned`` and the text as collected in ``title`` and ``text``, taken from
    ``*_raw`` columns where the analysis carries them.
    """
    names = ("title", "text") if check_item_type(item_type) == "submission" else ("text",)
    result = "overall_sentiment" if item_type == "submission" else "sentiment"
    renamed = {}
    for name in names:
        renamed[f"{name}_cleaned"] = F.col(name)
        if f"{name}_raw" in df.columns:
            renamed[name] = F.col(f"{name}_raw")
    renamed["vader_sentiment"] = F.col(rules_prefix + result)
    renamed["vader_compound"] = F.col(rules_prefix + result)["compound"]
    renamed["transformer_sentiment"] = F.col(model_prefix + result)
    renamed["transformer_compound"] = F.col(model_prefix + result)["compound"]
    columns = table_schema(item_type).fieldNames()
    present = [c for c in columns if c in renamed or c in df.columns]
    return df.select(*[renamed[c].alias(c) if c in renamed else F.col(c) for c in present])


def scores_as_json(df: DataFrame) -> DataFrame:
    """Score structs as JSON text, for sinks without nested types."""
    structs = [f.name for f in df.schema if isinstance(f.dataType, T.StructType)]
    return df.withColumns({name: F.to_json(name) for name in structs})
