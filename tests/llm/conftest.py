import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, key string, "
          "bucket int, sig string, id string, seed double")
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def words_of(text):
    return WORD.findall((text or "").translate(_LOWER))


def corpus(seed=1):
    """Invented texts with copies, near copies, shared passages, nulls, empties and a long one."""
    draw = random.Random(seed)
    vocabulary = {lang: ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(400)]
                  for lang, parts in (("xx", ("ka", "lo", "mi", "tu", "ne")), ("yy", ("schr", "öd", "ung", "keit", "zw")), ("zz", ("éau", "ille", "çon", "rê", "oi")))}

    def prose(lang, n):
        return " ".join(draw.choice(vocabulary[lang]) + draw.choice(["", "", "", ",", ".\n"]) for _ in range(n))

    rows = []
    passage = prose("xx", 90)
    for i in range(40):
        lang = draw.choice(["xx", "yy", "zz"])
        text = prose(lang, draw.choice([8, 60, 150, 300]))
        if i % 9 == 0:
            text = text + " " + passage + " " + prose(lang, 30)
        rows.append((text, lang, f"s{draw.randint(0, 3)}"))
    base = prose("yy", 200).split(" ")
    for edits in (0, 1, 2, 3, 6, 12, 25):
        copy = list(base)
        for at in draw.sample(range(len(copy)), edits):
            copy[at] = draw.choice(vocabulary["yy"]) + "q"
        rows.append((" ".join(copy), "yy", "hot"))
    rows += [(rows[3][0], "xx", "hot")] * 4
    rows += [(None, None, None), ("", "xx", None), ("  \n\t ", "xx", "s1"), ("one", "yy", "s1"), ("a b c d", None, "s2"), ("A B C D", "zz", "s2"),
             ("12 34 !!", "xx", "s0"), ("▁x y \U0001f680", "xx", "s0"), (prose("xx", 9000), "xx", "hot"), ("ab" * 30000, "xx", "hot")]
    return [(i * 3, text, lang, source, None if text is None else len(text), -1, "k", 1, "s", "i", 0.5) for i, (text, lang, source) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The corpus, its last rows with repeated and missing ids, in several files."""
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def odd(spark, rows):
    """Rows that repeat whole, one id with two texts, and rows without an id."""
    extra = [rows[5], rows[5], rows[45], (rows[5][0], rows[6][1], *rows[5][2:]), (None, rows[7][1], *rows[7][2:]), (None, None, *rows[7][2:])]
    return spark.createDataFrame(rows[:12] + rows[40:46] + extra, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
