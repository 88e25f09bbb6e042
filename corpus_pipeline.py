"""From raw documents to token ids: five stages, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import apportion, jaccard, mixture, pieces, repeats
from threadlens.llm.common import shared_dir, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no known language: null and empty texts and texts without a letter.

    Where no row has a label to learn from, every text with a letter stays. A very long
    text is judged whole; of languages that tie the first by name counts; repeated rows
    are judged alike; an empty table stays empty.
    """
    model = mixture.fit(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    guessed = mixture.predict(docs, model, prefix="__")
    return guessed.filter(guessed["__lang_pred"] != mixture.UNKNOWN).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each class of similar texts, that of the least id.

    Null and empty texts are like nothing and stay; of repeated rows one stays; long texts
    are compared whole; an empty table stays empty.
    """
    return jaccard.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts bytes that lie in strings of 400 bytes found elsewhere as well, and passages of
    over 50 words that another text has as well.

    Null and short texts stay as they are, repeated rows lose the same bytes, a text that
    repeats whole is left empty; long texts are cut whole; an empty table stays empty.
    """
    return repeats.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share of words, repeating texts where the share asks for it.

    A null source is a source; null texts and texts without words give nothing; ties in
    the seeded order go by id and size; a long text may be cut where its source's share
    ends; repeated rows are taken alike; an empty table stays empty.
    """
    return apportion.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left.

    Null and empty texts have no ids; a very long text gives a row for each chunk; of
    segmentations with equal scores one rule picks; repeated rows are encoded alike; an
    empty table gives an empty one.
    """
    return pieces.encode_texts(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]
# Mixtures, similarity classes, repeats in bytes and lattices are beyond SQL; the tests
# hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark).rstrip('/')}/stage-{number}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
