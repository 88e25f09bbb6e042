"""The prefix trie against a plain one of nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from threadlens.llm import trie


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {conv: [t[3:] for t in sorted(turns)] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        out[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    return out


def plain_trie(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    return sorted((own[0], len(node), members[node[:-1]][0] if node else None, len(own), children[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()) for node, own in members.items())


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1], r[7]))


def talks(seed, n, words="abc", longest=7):
    draw = random.Random(seed)
    return [(draw.randrange(n) * draw.choice([1, 1, 100]), turn, draw.choice(["user", "bot", None]), draw.choice([*words, "é\U0001f680", "", None]))
            for _ in range(n) for turn in range(draw.randint(1, longest))]


def copies(seed):
    """A third of all conversations are the same one, another is its beginning, one is very long."""
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(100, 700, 3) for turn in range(4)]
    rows += [(conv, turn, "user", f"t{turn}") for conv in (100, 200, 300, 400, 500, 600) for turn in range(4, 6)]
    rows += [(conv, turn, "user", f"t{turn}") for conv in range(101, 160, 3) for turn in range(2)]
    return rows + talks(seed, 150) + [(5000, turn, "bot", "x" * (turn % 5)) for turn in range(700)] + [(5001, turn, "bot", "x" * (turn % 5)) for turn in range(650)]


ODD = [(None, 1, "user", "no id"), (7, None, None, None), (7, None, "user", "first"), (7, 1, "user", "b"), (7, 1, "user", "a"), (7, 1, "user", "a"),
       (8, 0, "ab", "c"), (9, 0, "a", "bc"), (100, 0, "", ""), (-5, 0, "user", "below zero"), (-250, 3, "user", "x"), (10 ** 12, 0, "user", "y" * 100_000)]
TABLES = {"talks": talks(1, 300), "few letters": talks(2, 500, "a", 4), "copies": copies(3), "odd": ODD, "one": [(300, 0, "user", "x")],
          "turnless": [(conv, 0, "user", "x") for conv in range(1, 60)], "same first turn": [(conv, t, "u", "hi" if not t else str(conv % 7)) for conv in range(0, 9000, 100) for t in range(3)]}
SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("partitions", [1, 5, 40])
@pytest.mark.parametrize("name", TABLES)
def test_trie_equals_plain_trie(spark, name, partitions):
    rows = TABLES[name]
    want = plain_trie(rows) if name != "odd" else None
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'z' AS seq", "2 AS depth", "3 AS n_convs")
    got = collected(trie.prefix_trie(df, partitions))
    if want is None:        # ids below zero: the remainder keeps their sign, unlike Python's
        positive = [row for row in rows if row[0] is None or row[0] >= 0]
        assert collected(trie.prefix_trie(spark.createDataFrame(positive, SCHEMA), partitions)) == plain_trie(positive)
        assert sum(r[1] == 0 for r in got) == 1 and got[0][0] == -250
    else:
        assert got == want


def test_contexts_joined_by_a_shuffle(spark):
    df = spark.createDataFrame(TABLES["copies"], SCHEMA)
    assert collected(trie.prefix_trie(df, 12, context_max_bytes=0)) == plain_trie(TABLES["copies"])


def test_lists_of_ids_in_chunks(spark, monkeypatch):
    rows = [(conv, 0, "u", "same") for conv in range(100, 100_000, 100)]
    assert collected(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), 6)) == plain_trie(rows)
    chunks = [b.to_pylist() for b in trie._chunks(1, 2, 3, list(range(120_000)))]
    assert len(chunks) == 3 and ",".join(c[0]["chunk"] for c in chunks) == ",".join(map(str, range(120_000)))


def test_empty_table(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_common_turns():
    draw = random.Random(4)
    for _ in range(300):
        a, b = (bytes(x for _ in range(draw.randint(0, 9)) for x in [draw.randint(0, 1)] * trie.DIGEST) for _ in range(2))
        want = 0
        while (want + 1) * 16 <= min(len(a), len(b)) and a[want * 16:want * 16 + 16] == b[want * 16:want * 16 + 16]:
            want += 1
        assert trie.common_turns(a, b) == want
