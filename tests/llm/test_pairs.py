"""Jaccard join, repeats, chains, components and the pipeline against brute force."""

import hashlib
import random
import tracemalloc
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import SCHEMA, WORD, words_of
from threadlens.llm import chaining, common, jaccard, pieces, repeats, words
from threadlens.llm.components import components


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def classes(texts):
    """Least id reachable by links, by comparing all pairs."""
    sets, parent = {d: shingles(t) for d, t in texts}, {d: d for d, _ in texts}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            a, b = sorted((top(a), top(b)))
            parent[b] = a
    return {d: (len(sets[d]), top(d)) for d in sets}


def repeated(texts, length):
    """Removed byte flags of each text, by a table of all windows."""
    seen = defaultdict(int)
    for text in texts:
        for i in range(len(text) - length + 1):
            seen[text[i:i + length]] += 1
    out = []
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if seen[text[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


# ---- words

def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = [b"", b" a  b\tc\n", "é ü".encode(), b"word " * 500, b"x" * 3000]
    whole, offsets = words.hash_texts(texts)
    assert np.diff(offsets).tolist() == [len(t.split()) for t in texts]
    monkeypatch.setattr(words, "_STEP", 64)
    again, _ = words.hash_texts(texts)
    assert (whole == again).all() and len(set(whole.tolist())) == len({w for t in texts for w in t.split()})


# ---- components

@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(-50, 50), draw.randrange(-50, 50)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent) if find(x) != x}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- Jaccard join

def test_classes_match_all_pairs(docs, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_classes(docs).collect()}
    want = classes([(row[0], row[1]) for row in rows])
    assert got == want and len({c for _, c in want.values()}) < len(want) - 6


def test_chains_of_near_copies(spark):
    """Texts that are linked only through others, with sizes that differ."""
    draw = random.Random(9)
    base, texts = [f"w{draw.randrange(10 ** 6)}" for _ in range(120)], []
    for i in range(60):
        copy = list(base)
        for at in draw.sample(range(120), draw.choice([0, 1, 2, 3, 5, 8, 14])):
            copy[at] = f"v{draw.randrange(10 ** 6)}"
        texts.append((i, " ".join(copy[:draw.choice([120, 110, 100])])))
        base = copy if i % 10 == 9 else base
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == classes(texts)


def test_prefixes_lose_no_pair():
    """Pairs of similar sets share enough tokens of their prefixes, for every number of matches."""
    draw = random.Random(2)
    for _ in range(300):
        n = draw.randint(1, 40)
        a = set(draw.sample(range(1000), n))
        b = set(list(a)[draw.randint(0, n // 6):]) | set(draw.sample(range(1000, 1100), draw.randint(0, n // 8)))
        common = len(a & b)
        if not b or 100 * common < 80 * len(a | b):
            continue
        need = (4 * (len(a) + len(b)) + 8) // 9
        for k in range(1, min(4, common) + 1):
            assert len(set(sorted(a)[:len(a) - need + k]) & set(sorted(b)[:len(b) - need + k])) >= k
        cost = np.ones(n)
        assert 1 <= jaccard.matches_for(cost, n) <= min(4, (4 * n + 4) // 5)


def test_jaccard_of_odd_tables(odd, empty):
    got = jaccard.similar_classes(odd).collect()
    assert len(got) == odd.count() and jaccard.similar_classes(empty).count() == 0
    stay = jaccard.one_of_each(odd)
    assert stay.columns == odd.columns
    pairs = [(r["doc_id"], r["text"]) for r in stay.collect()]
    assert len(pairs) == len(set(pairs)) and jaccard.one_of_each(empty).count() == 0


# ---- repeats

def test_removed_bytes_match_all_windows(docs, rows):
    got = {r["doc_id"]: r for r in repeats.remove_repeats(docs).collect()}
    texts = [(row[1] or "").encode() for row in rows]
    flags = repeated(texts, repeats.LENGTH)
    assert sum(f.any() for f in flags) > 10
    for row, text, gone in zip(rows, texts, flags):
        r = got[row[0]]
        rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(text), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(rest).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_repeats_in_small_alphabets(spark, seed):
    draw = random.Random(seed)
    block = ["".join(draw.choice("ab") for _ in range(draw.choice([150, 210, 399, 400, 401, 800]))) for _ in range(6)]
    texts = [(i, "".join(draw.choice([b, b, "x" * 7, "é", "\0" * 30]) for b in draw.sample(block, 4) for _ in range(2))) for i in range(30)]
    texts.append((99, "q" * 2500))
    got = {r["doc_id"]: r["n_removed"] for r in repeats.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {d: int(f.sum()) for (d, _), f in zip(texts, repeated([t.encode() for _, t in texts], repeats.LENGTH))}


def test_pieces_of_long_texts_agree(monkeypatch):
    draw = random.Random(4)
    text = "".join(draw.choice("abcd ") for _ in range(20000)).encode()
    windows = lambda: {(a, b): at for at, a, b, *_ in zip(*(p.tolist() for p in repeats.samples(text)))}
    place = lambda runs: {w: at for (a, b), at in runs.items() for w in range(a, b + 1)}
    whole = place(windows())
    monkeypatch.setattr(repeats, "_STEP", 1000)
    assert place(windows()) == whole and sorted(whole) == list(range(len(text) - repeats.LENGTH + 1))


def test_interleave_is_sorted_with_common_prefixes():
    draw = random.Random(6)
    parts = sorted((draw.randint(0, 3), bytes(draw.choice(b"ab") for _ in range(24))) for _ in range(200))
    draw.shuffle(parts)
    parts.sort(key=lambda p: p[0])
    symbols = np.frombuffer(b"".join(p[1] for p in parts), ">u8").astype(np.uint64).reshape(-1, 3)
    order, common = repeats.refine(symbols, np.array([p[0] for p in parts]))
    merged = [parts[i] for i in order]
    assert merged == sorted(parts)
    for i in range(1, len(merged)):
        (a, x), (b, y) = merged[i - 1], merged[i]
        assert common[i] == (-1 if a != b else next((k for k in range(24) if x[k] != y[k]), 24))


def test_repeats_of_odd_tables(odd, empty):
    assert repeats.remove_repeats(odd).count() == odd.count() and repeats.remove_repeats(empty).count() == 0
    left = repeats.without_repeats(odd)
    assert left.columns == odd.columns and left.count() == odd.count() and repeats.without_repeats(empty).count() == 0
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in left.collect())


def test_stage_cuts_shared_passages_of_over_50_words(spark):
    """Passages of fewer than 400 bytes; one of 50 words stays, and so does one that only its own text repeats."""
    draw = random.Random(15)
    prose = lambda n: [f"w{draw.randrange(10 ** 3)}" for _ in range(n)]
    rows, want = [], {}
    for case in range(12):
        n = 51 + case % 3 if case % 4 else 50
        passage = prose(n)
        assert len(" ".join(passage)) < repeats.LENGTH
        for copy in range(2 + case % 2):
            before, after, doc = prose(draw.randint(0, 40)), prose(draw.randint(0, 60)), 10 * case + copy
            rows.append((doc, (" \n" if copy else " ").join([*before, f"a{copy}", *passage, "é" * copy, *after])))
            want[doc] = [*before, f"a{copy}", *(passage if n == 50 else []), "é" * copy, *after]
    own = prose(55)
    rows += [(500, " ".join([*own, "x", *own])), (501, None), (502, ""), (503, "few words"), (504, " ".join(prose(51))), (505, " ".join(prose(20000)))]
    rows += [(506, rows[-2][1]), (507, " ".join(rows[-1][1].split()[9000:9051]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    assert {doc: got[doc].split() for doc in want} == {doc: [w for w in words if w] for doc, words in want.items()}
    assert [got[d] for d in (500, 501, 502, 503, 504, 506, 507)] == [rows[-8][1], None, "", "few words", "", "", ""]
    long = rows[-3][1].split()
    assert got[505].split() == long[:9000] + long[9051:]


def test_repeats_tell_shared_passages_of_over_50_words(spark):
    """They may have fewer than 400 bytes and are not removed then."""
    draw = random.Random(16)
    prose = lambda n: [f"w{draw.randrange(10 ** 3)}" for _ in range(n)]
    passage, fifty, own = prose(52), prose(50), prose(55)
    texts = {1: prose(10) + ["a"] + passage, 2: passage + ["é", "b"] + prose(9) + fifty, 3: ["c"] + fifty + prose(3), 4: own + ["x"] + own, 6: [], 7: ["few"], 8: prose(51)}
    rows = [(k, " ".join(w)) for k, w in texts.items()] + [(5, None), (9, " ".join(texts[8]))]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    size = len(" ".join(passage))
    assert size < repeats.LENGTH and len(got) == len(rows) and all(r["n_removed"] == 0 for r in got.values())
    assert {k: r["n_shared"] for k, r in got.items()} == {1: size, 2: size, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: got[8]["n_bytes"], 9: got[8]["n_bytes"]}
    for k in (1, 2):
        text = dict(rows)[k].encode()
        assert [text[a:b].decode() for a, b in zip(got[k]["shared_starts"], got[k]["shared_ends"])] == [" ".join(passage)]


# ---- chains

def test_fenwick_chain_is_the_best_chain():
    draw = random.Random(8)
    for _ in range(30):
        points = sorted({(draw.randrange(60), draw.randrange(60)) for _ in range(25)})
        x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points])
        best = [chaining.GAIN] * len(points)
        for i, (a, b) in enumerate(points):
            for j, (c, d) in enumerate(points[:i]):
                if c < a and d < b:
                    best[i] = max(best[i], best[j] + chaining.GAIN - chaining.GAP * (a - c + b - d))
        first = chaining.chains(x, y)[0]
        value = sum(chaining.GAIN for _ in first) - sum(chaining.GAP * (x[j] - x[i] + y[j] - y[i]) for i, j in zip(first, first[1:]))
        assert value == pytest.approx(max(best)) and sorted(i for c in chaining.chains(x, y) for i in c) == list(range(len(points)))


def test_every_long_passage_is_found(docs, rows):
    texts = {row[0]: words_of(row[1]) for row in rows}
    holders = defaultdict(set)
    for doc, w in texts.items():
        for i in range(len(w) - 50):
            holders[tuple(w[i:i + 51])].add(doc)
    want = {doc for docs_ in holders.values() if len(docs_) > 1 for doc in docs_}
    found = chaining.passages(docs).collect()
    got = {doc for r in found for doc in (r["doc_id"], r["other_id"])}
    assert want and want <= got
    for r in found:
        a, b = texts[r["doc_id"]][r["start"]:r["end"]], texts[r["other_id"]][r["other_start"]:r["other_end"]]
        row = [0] * (len(b) + 1)
        for word in a:      # words in common, in order
            last = 0
            for k, other in enumerate(b):
                last, row[k + 1] = row[k + 1], max(row[k], row[k + 1], last + 1 if word == other else 0)
        assert r["other_id"] < r["doc_id"] and min(len(a), len(b)) >= 50
        assert 0.8 * r["n_words"] <= r["n_common"] <= row[-1] and r["n_words"] == max(len(a), len(b))
    clean = set(texts) - want
    assert sum(doc in got for doc in clean) <= 4      # fuzzy copies without 51 equal words in a row


def test_chains_of_odd_tables(odd, empty):
    assert all(r["doc_id"] is not None for r in chaining.passages(odd).collect()) and chaining.passages(empty).count() == 0


def test_passages_that_lower_texts_hold_in_parts(spark):
    draw = random.Random(12)
    prose = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    rows, want = [], set()
    for case in range(25):
        passage, base = prose(60), 10 * case
        tiles = [prose(40) + passage[:30] + prose(40), prose(40) + passage[30:] + prose(40)]
        if case % 2:        # one home that has it in parts, with foreign words between
            tiles = [prose(20) + passage[:30] + prose(40) + passage[30:] + prose(20), prose(80)]
        texts = [*tiles, prose(35) + passage + prose(45), prose(25) + passage + prose(55)]
        rows += [(base + i, " ".join(t)) for i, t in enumerate(texts)]
        want.add((base + 3, base + 2))
    found = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in found} == want
    assert all((r["end"] - r["start"], r["n_common"]) == (60, 60) for r in found)


def test_the_first_of_equal_texts_is_searched_for_all(spark, monkeypatch):
    draw = random.Random(21)
    prose = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    passage, other = prose(60), prose(70)
    text, loose, short = " ".join(prose(20) + passage + prose(30) + other), " ".join(other + prose(25)), " ".join(prose(49))
    rows = [(7, text), (3, " ".join(passage + prose(40))), (5, text), (9, text), (9, text), (8, loose), (11, short), (12, short), (None, text), (13, None), (14, None)]
    sown, keep = [], chaining.in_batches

    def noted(df, body, schema):
        out = keep(df, body, schema)
        if schema.startswith("seed "):
            sown.extend(r["doc"] for r in out.select("doc").distinct().collect())
        return out

    monkeypatch.setattr(chaining, "in_batches", noted)
    found = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(sown) == [3, 5, 8]
    assert sorted((r["doc_id"], r["other_id"], r["start"], r["end"], r["other_start"], r["other_end"]) for r in found) == [
        (5, 3, 20, 80, 0, 60), (7, 3, 20, 80, 0, 60), (7, 5, 0, 180, 0, 180), (8, 5, 0, 70, 110, 180), (9, 3, 20, 80, 0, 60), (9, 5, 0, 180, 0, 180)]
    assert all(r["n_words"] == r["n_common"] == r["end"] - r["start"] and r["identity"] == 1 for r in found)


def test_an_exact_passage_is_not_lost_among_loose_words():
    """Fifty equal words whose chain or stretched ends are less alike than asked for."""
    draw = np.random.default_rng(3)
    a, b = draw.integers(1 << 32, size=300, dtype=np.uint32), draw.integers(1 << 32, size=300, dtype=np.uint32)
    b[100:150] = a[100:150]
    b[174:179] = a[174:179]
    got = chaining.align(a, b, [100, 110, 120, 130, 140, 145, 174], [100, 110, 120, 130, 140, 145, 174])
    assert got == [(100, 150, 100, 150, 50)]


def test_what_one_text_repeats_by_itself_does_not_move(spark, monkeypatch):
    """Only seeds that another text may have leave their task, and the sketch travels packed."""
    draw = random.Random(31)
    prose = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    line, passage = prose(60), prose(60)
    rows = [(1, " ".join(line + prose(5) + line)), (2, " ".join(prose(30) + passage)), (3, " ".join(passage + prose(20))), (4, " ".join(prose(3000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    sown, keep = [], chaining.in_batches

    def noted(df, body, schema):
        out = keep(df, body, schema)
        if schema.startswith("seed "):
            sown.extend(r["doc"] for r in out.select("doc").collect())
        return out

    monkeypatch.setattr(chaining, "in_batches", noted)
    found = chaining.passages(docs).collect()
    assert [(r["doc_id"], r["other_id"], r["n_common"]) for r in found] == [(3, 2, 60)]
    assert sown.count(1) < 30 and sown.count(2) >= 56 + 11      # a cell of the sketch may be shared by chance
    width, chunks = chaining.sketch(docs)
    assert sum(map(len, chunks.values())) < width // 8
    bitmap = chaining.bitmap_of(width, chunks)
    assert np.array_equal(chaining.unpacked(chaining.packed(bitmap), width), bitmap)
    for odd in (np.zeros(64, np.uint8), np.arange(64, dtype=np.uint8)):
        assert np.array_equal(chaining.unpacked(chaining.packed(odd), 64), odd)


def test_stretches_of_many_places_are_those_of_each(monkeypatch):
    monkeypatch.setattr(chaining, "MOST_PLACES", 64)
    draw = np.random.default_rng(7)
    a = draw.integers(3, size=900, dtype=np.uint32)
    b = np.where(draw.random(900) < 0.1, 9, a).astype(np.uint32)
    x = draw.integers(0, 896, size=300)
    y = np.where(draw.random(300) < 0.7, x, draw.integers(0, 896, size=300))
    before, same = chaining.stretches(a, x - 1, b, y - 1, np.minimum(x, y), -1)
    after, also = chaining.stretches(a, x + 5, b, y + 5, np.minimum(900 - x, 900 - y) - 5, 1)
    for i in range(300):
        one, two = chaining._stretch(a[:x[i]][::-1], b[:y[i]][::-1]), chaining._stretch(a[x[i] + 5:], b[y[i] + 5:])
        assert before[i] == -1 or (before[i], same[i]) == one
        assert after[i] == -1 or (after[i], also[i]) == two
    assert (before >= 0).sum() > 100 and (before < 0).any()
    fits, left, right, total = chaining.alone(before, same, after, also, 50, 0.8)
    for i in np.flatnonzero((before >= 0) & (after >= 0)):
        want = [(x[i] - left[i], x[i] + 5 + right[i], y[i] - left[i], y[i] + 5 + right[i], total[i])] if fits[i] else []
        assert chaining.align(a, b, [int(x[i])], [int(y[i])]) == want


def test_passages_with_evenly_replaced_words(spark):
    draw = random.Random(4)
    prose = lambda n: [f"w{draw.randrange(10 ** 6)}" for _ in range(n)]
    rows = []
    for case in range(40):      # seven of fifty words differ: no seven equal words in a row
        passage = prose(50)
        other = [f"x{draw.randrange(10 ** 6)}" if i % 7 == 3 else word for i, word in enumerate(passage)]
        rows += [(2 * case, " ".join(prose(30) + passage + prose(40))), (2 * case + 1, " ".join(prose(45) + other + prose(20)))]
    found = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in found} == {(2 * case + 1, 2 * case) for case in range(40)}
    assert all(r["n_words"] >= 50 and r["n_common"] >= 43 for r in found)


# ---- pipeline

def test_counters_of_shingles_are_held_once(spark, monkeypatch):
    """A task needs room for one array of counters, and hands it on in parts."""
    bodies = []
    monkeypatch.setattr(jaccard, "in_batches", lambda df, body, schema: bodies.append(body) or (_ for _ in ()).throw(InterruptedError))
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    with pytest.raises(InterruptedError):
        jaccard.describe(docs)
    batch = pa.record_batch({"doc_id": pa.array([1, 2]), "text": ["a b c d e f", "a b c d e g " * 50]})
    tracemalloc.start()
    try:
        out = list(bodies[0](iter([batch, batch])))
        assert tracemalloc.get_traced_memory()[1] < 6 * jaccard.CELLS
    finally:
        tracemalloc.stop()
    assert len(out) > 4
    chunks = {k: np.frombuffer(zstandard.ZstdDecompressor().decompress(c), np.uint32) for part in out for k, c in
              zip(part.column("chunk").to_pylist(), part.column("counts").to_pylist()) if c is not None}
    cells = np.concatenate([chunks[k] for k in range(jaccard.CELLS // jaccard.CHUNK)])
    value, _ = jaccard.shingle_sets([b"a b c d e f", b"a b c d e g " * 50])
    assert np.array_equal(cells, 2 * np.bincount(jaccard.cell_of(value), minlength=jaccard.CELLS))


def test_workers_keep_no_segmented_parts(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i} zyx{i}") for i in range(200)], "doc_id long, text string").repartition(8)
    pieces.encode_texts(docs).collect()

    def held(batches):
        for batch in batches:
            yield pa.record_batch({"n": [len(pieces.lattice(pieces.MODEL_PATH).cache)]})

    kept = common.in_batches(spark.range(0, 64, 1, 16), held, "n long").collect()
    assert kept and not any(r["n"] for r in kept)


def test_stages_against_brute_force(spark, docs, rows, tmp_path):
    kept = {row[0]: row[1] for row in rows if row[1] and any(map(str.isalpha, row[1]))}
    stages = dict(corpus_pipeline.STAGES)
    names = [name for name, _ in corpus_pipeline.STAGES]
    now = docs
    for number, name in enumerate(names):
        before = now
        stages[name](spark, now, "").write.parquet(str(tmp_path / str(number)))
        now = spark.read.parquet(str(tmp_path / str(number)))
        assert number == 4 or now.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in now.collect()] if number < 4 else None
        if number == 0:
            assert dict(got) == kept and len(got) == len(kept)
        elif number == 1:
            kept = {d: kept[d] for d, (_, top) in classes(list(kept.items())).items() if d == top}
            assert dict(got) == kept and len(got) == len(kept)
        elif number == 2:
            data = {d: t.encode() for d, t in kept.items()}
            flags = repeated(list(data.values()), repeats.LENGTH)
            kept = {d: np.frombuffer(t, np.uint8)[~f].tobytes().decode("utf-8", "ignore") for (d, t), f in zip(data.items(), flags)}
            assert dict(got) == kept and len(got) == len(kept)
        elif number == 3:
            total = sum(len(WORD.findall(t)) for t in kept.values())
            assert abs(sum(len(WORD.findall(t)) for _, t in got) - total) <= 3 * len({r["source"] for r in before.collect()}) + 3
            assert all(t == kept[d] or kept[d].split()[:len(t.split())] == t.split() for d, t in got)
            texts, got_before = sorted(t for _, t in got), got
        else:
            out = now.collect()
            assert {r["doc_id"] for r in out if not r["exact"]} <= {d for d, t in got_before if "▁" in t}      # a mark decodes to a space
            whole = sorted(hashlib.sha256(t.replace("▁", " ").encode()).hexdigest() for t in texts if len(t) <= 32768)
            assert set(whole) <= {r["decoded_sha256"] for r in out}


def test_pipeline_runs_on_an_empty_table(spark, empty, tmp_path):
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


CLASHING = ("_kept", "_again", "_starts", "_ends", "_key", "_lang_pred", "_copy", "_rest", "_taken", "lang_pred", "score", "key", "sig", "taken", "component_id", "n_words")


def test_stages_carry_columns_that_sound_like_their_own(spark, odd):
    df = odd.select("doc_id", "text", "lang", "source", "n_chars", *[F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name)
                                                                      for name in CLASHING])
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, df, "")
        assert out.columns == df.columns
        rows = out.collect()
        assert rows and all(r[name] == f"{name} of {'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for name in CLASHING)


def test_without_labels_texts_with_letters_stay(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    stay = corpus_pipeline.identify_language(spark, unlabelled, "")
    want = sorted(r["doc_id"] for r in docs.collect() if r["text"] and any(map(str.isalpha, r["text"])))
    assert stay.columns == docs.columns and sorted(r["doc_id"] for r in stay.collect()) == want
