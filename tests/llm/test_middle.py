"""Fill-in-the-middle against a plain cut of the list of units."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import middle

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def plain_example(doc, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return len(units), "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


ODD_TEXTS = [None, "", "a", "é", "a<P>b c", "x <S", "<P <M", "<M>", "ab" * 5000, "\U0001f680 z\n\nZ" * 700, "a b " * 3000 + "c" * 9000 + " d" * 4000,
             "<" * 50 + "S" * 40, "é" * 4000 + "word " * 4000]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, text, "out", "f") for i, text in enumerate(ODD_TEXTS * 12)]
    rows += [(None, "no id here", "o", "f"), (None, None, "o", "f"), (7, "repeated row", "o", "f"), (7, "repeated row", "o", "f"), (-3, "below zero", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, output string, form string")


def test_examples_equal_plain_cuts(table):
    want = sorted(((r["doc_id"], *plain_example(r["doc_id"], r["text"])) for r in table.collect()), key=repr)
    made = middle.fill_in_middle(table)
    assert sorted((tuple(r) for r in made.collect()), key=repr) == want
    assert {row[2] for row in want} == {"plain", "psm", "spm"}


def test_examples_give_the_text_back(docs, table):
    for df in (docs, table):
        back = middle.fill_in_middle(df).withColumn("back", middle.restored(F.col("output"), F.col("form")))
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["back"]) for r in back.collect())
        assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect())


def test_empty_table_and_ids_of_any_type(spark, empty):
    assert middle.fill_in_middle(empty).count() == 0
    named = spark.createDataFrame([("d-1", "some text, here")], "name string, body string")
    (row,) = middle.fill_in_middle(named, "name", "body").collect()
    assert tuple(row) == ("d-1", *plain_example("d-1", "some text, here"))


@pytest.mark.parametrize("error, chunk", [(1, 7), (3, 100), (100, 1 << 20)])
def test_index_is_exact_and_its_error_bounded(error, chunk):
    draw = random.Random(error)
    for _ in range(60):
        text = "".join(draw.choice(["a", "bcd" * draw.randint(1, 60), " ", "é", "\n", "Z"]) for _ in range(draw.randint(1, 900)))
        index = middle.RankIndex(text, error, chunk)
        offsets = [m.start() for m in UNIT.finditer(text)] + [len(text)]
        assert [index.offset(r) for r in range(index.n + 1)] == offsets
        assert all(abs(index.predicted(r) - offsets[r]) <= error + 1 for r in range(index.n))
    assert np.abs(index.rests).max() <= error + 1


def test_segments_are_few_on_even_texts():
    assert len(middle.RankIndex("word " * 20000).firsts) == 1
