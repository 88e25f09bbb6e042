"""Cleaning of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.cleaning import (CleanOptions, collapse_whitespace, nfkc_exposed, nfkc_of,
                                           strip_all)
from threadlens.scale import bound_batches
from threadlens.schemas import TEXT_COLUMNS, check_item_type


def clean(df: DataFrame, columns: Sequence[str], options: CleanOptions = CleanOptions(),
          suffix: str = "") -> DataFrame:
    """Clean ``columns`` into ``<column><suffix>``; no shuffle.

    All columns share one expression and one Python call for the Unicode forms,
    which gets only the texts that those may change, a few megabytes at a time.
    """
    bound_batches(df.sparkSession)
    texts = F.array(*[F.col(name) for name in columns])
    df = df.withColumn("_texts", F.transform(texts, lambda t: strip_all(t, options)))
    df = df.withColumn("_forms", nfkc_of(nfkc_exposed(F.col("_texts"))))
    finish = collapse_whitespace if options.normalize_whitespace else (lambda t: t)
    final = {f"{name}{suffix}": finish(F.coalesce(F.get("_forms", F.lit(i)), F.get("_texts", F.lit(i))))
             for i, name in enumerate(columns)}
    return df.withColumns(final).drop("_texts", "_forms")


def clean_batch(df: DataFrame, item_type: str = "submission",
                options: CleanOptions = CleanOptions()) -> DataFrame:
    """Clean the text columns of posts or comments in place and flag the rows."""
    columns = TEXT_COLUMNS[check_item_type(item_type)]
    return clean(df, columns, options).withColumn("cleaned", F.lit(True))
