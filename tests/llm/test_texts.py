"""Style tree, compression bands, language mixture, fingerprints, shards, mix, pieces."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from threadlens.llm import apportion, compression, hilbert, mixture, pieces, sampling, styletree
from tests.llm.conftest import WORD


# ---- style tree

def test_main_text_drops_what_is_no_article():
    page = ('<html><head><title>t</title></head><body><nav><a>m</a></nav><div class="ad">buy</div><article><h1>A &amp; B</h1>'
            '<p>one <b>tw</b>o<br>three<script>var x="</p>"</script><p>four<!-- no --></article><aside>n</aside>'
            '<div id="comments">c</div><footer>f</footer>')
    assert styletree.extract(page, set()) == "A & B one two three four"


def test_page_without_article_keeps_plain_blocks():
    assert styletree.extract("<div>x<ul><li>a<li>b</ul></div><form>f</form>&lt;tail", set()) == "x a b <tail"


@pytest.mark.parametrize("opening", ['<div style="overflow:hidden">', '<p><a href="/hidden-gems">', '<p data-id="comment-3">', '<p><a href="/p?id=ad-7">',
                                     '<div class="layout has-sidebar">', '<div class="no-comments"><article>', '<article>teaser</article><div>'])
def test_rules_do_not_reach_article_text(opening):
    assert styletree.extract(f"<body>{opening}a long text of the page", set()).endswith("a long text of the page")


def test_names_still_rule_out_what_is_beside_the_article():
    page = '<div class="has-sidebar"><article>the text</article><div class="sidebar">s</div><div id="comments"><article>a far longer comment</article></div></div>'
    assert styletree.extract(page, set()) == "the text" and styletree.extract('<p hidden>x</p><p aria-hidden="true">y</p>z', set()) == "z"


@pytest.mark.parametrize("page", ["", "<", "a < b", "<p", "</div></p>", "<div class='a\">x", "<![CDATA[x]]>y", "<script>never ends", "<p>" * 3000 + "deep"])
def test_broken_markup_does_not_fail(page):
    assert isinstance(styletree.extract(page, set()), str)
    styletree.features(page)


def test_style_tree_learns_repeated_branches(spark):
    pages = [(i, f"http://h.org/{i}", f"<body><div class=box><p>same words on every page</p></div><div class=body><p>text number {i} {'w' * i}</p></div></body>") for i in range(20)]
    pages += [(90, None, None), (91, "http://h.org/x", ""), (92, "//other.org/y", "<div class=box><p>same words on every page</p></div>")]
    df = spark.createDataFrame(pages * 1, "page_id int, url string, html string").selectExpr("*", "'z' AS host", "1 AS text", "2 AS paths")
    got = {r["page_id"]: r for r in styletree.main_text(df).collect()}
    assert got[3]["text"] == "text number 3 www" and got[3]["n_chars"] == 17
    assert got[90]["text"] == got[91]["text"] == ""
    assert got[92]["text"] == "same words on every page"      # one page of its host tells nothing
    assert len(got) == 23
    tree = {(r["host"], r["path"]): r for r in styletree.style_tree(df).collect()}
    assert tree["h.org", "/body/div.box"]["content"] < 1e-9 and tree["h.org", "/body/div.body"]["content"] > 0.99
    assert styletree.main_text(df.limit(0)).count() == 0


# ---- fingerprints drawn together

def test_signatures_drawn_together_equal_those_drawn_alone(rows, monkeypatch):
    texts = [(row[1] or "").encode() for row in rows] + [b"a b c d e f g " * 500, b"one two", b""]
    alone = [sampling.signature(*w) for w in sampling.weights(texts)]
    assert all((a == b).all() for a, b in zip(alone, sampling.signatures(texts)))
    monkeypatch.setattr(sampling, "HELD_TERMS", 300)
    monkeypatch.setattr(sampling, "ROWS", 7)
    assert all((a == b).all() for a, b in zip(alone, sampling.signatures(texts)))


# ---- compression bands

def test_base_counts(docs, rows):
    got = {r["doc_id"]: r for r in compression.compression_bands(docs).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        text, r = text or "", got[doc]
        words = WORD.findall(text)
        lines, seen = 0, set()
        for line in text.split("\n"):
            if WORD.search(line):
                lines += line in seen
                seen.add(line)
        windows = list(zip(words, words[1:], words[2:]))
        count, covered = Counter(windows), set()
        for i, window in enumerate(windows):
            if count[window] > 1:
                covered |= {i, i + 1, i + 2}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_bands():
    assert compression.verdict(5000, 0.45, [0.5, 0.5])
    assert not compression.verdict(5000, 0.05, [0.05])
    assert not compression.verdict(5000, 0.99, [0.99])
    assert not compression.verdict(50000, 0.3, [0.02] * 8 + [0.6] * 4)
    assert compression.verdict(100, 1.1, [])


def test_bands_of_odd_tables(odd, empty):
    assert compression.compression_bands(odd).count() == odd.count()
    assert compression.compression_bands(empty).count() == 0


# ---- language mixture

def test_held_out_accuracy(docs, rows):
    model = mixture.fit(docs)
    assert model.languages == ["xx", "yy", "zz"]
    got = {r["doc_id"]: r for r in mixture.predict(docs.withColumn("held", mixture.held_out()), model).collect()}
    right = wrong = 0
    for doc, text, lang, *_ in rows:
        r = got[doc]
        assert r["held"] == (zlib.crc32(str(doc).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if text is None or not any(map(str.isalpha, text)):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif r["held"] and lang and len(text) > 40:
            right, wrong = right + (r["lang_pred"] == lang), wrong + (r["lang_pred"] != lang)
    assert right and not wrong


def test_mixture_finds_both_languages(docs, rows):
    model = mixture.fit(docs)
    pure = [row for at, row in enumerate(rows[:40]) if at % 9]      # the others hold the shared passage
    one = " ".join(r[1] for r in pure if r[2] == "yy")[:3000]
    two = " ".join(r[1] for r in pure if r[2] == "zz")[:1000]
    names, scores, sizes, sets = mixture.infer([one + " " + two, one, ""], model)
    assert names == ["yy", "yy", "und"] and sizes == [2, 1, 0] and sets == ["yy,zz", "yy", None]
    assert 0.5 < scores[0] < 0.95 and scores[1] > 0.99


def test_em_matches_plain_loop():
    draw = np.random.default_rng(3)
    like = draw.random((50, 3))
    share, total = mixture._mixture(like, np.array([0, 20]), np.array([20, 30]), np.full((2, 3), 1 / 3), 5)
    for part, got, value in ((like[:20], share[0], total[0]), (like[20:], share[1], total[1])):
        p = np.full(3, 1 / 3)
        for _ in range(5):
            p = np.mean([row * p / (row @ p) for row in part], axis=0)
        assert np.allclose(p, got) and np.isclose(sum(np.log(row @ p) for row in part), value)


def test_mixture_odd_tables(odd, empty):
    model = mixture.fit(odd)
    assert mixture.predict(odd, model).count() == odd.count()
    nothing = mixture.fit(empty)
    assert nothing.languages == [] and {r[0] for r in mixture.predict(odd, nothing).select("lang_pred").collect()} == {"und"}
    with pytest.raises(ValueError):
        mixture.predict(odd.withColumnRenamed("key", "score"), model)


# ---- fingerprints

def test_edited_texts(docs, rows):
    got = {r["doc_id"]: r for r in sampling.fingerprints(docs, buckets=7).collect()}
    texts = [(doc, text or "") for doc, text, *_ in rows]
    prints = {}
    for (doc, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        r, half = got[doc], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if text == after:
            assert r["near_next"] == 1
    assert len(set(prints.values())) > 40


def test_collision_rate_is_generalised_jaccard():
    draw = np.random.default_rng(5)
    for _ in range(3):
        a, b = draw.integers(0, 6, 200), draw.integers(0, 6, 200)
        expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        sign = lambda w: sampling.signature(np.flatnonzero(w), w[w > 0], universe=256, samples=4000)
        assert abs(sampling.likeness(sign(a), sign(b)) - expected) < 0.04


def test_long_texts_without_a_common_term_are_not_alike():
    a, b = (" ".join(f"{side}{i}" for i in range(100_000)).encode() for side in "ab")
    (x, m), (y, n) = sampling.weights([a, b])
    assert sampling.likeness(sampling.signature(x, m), sampling.signature(y, n)) == 0


def test_fingerprints_of_odd_tables(odd, empty, spark):
    assert sampling.fingerprints(odd, buckets=4).count() == odd.count()
    assert sampling.fingerprints(empty).count() == 0
    one = sampling.fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).first()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest()


# ---- Hilbert shards

def test_curve_steps_to_neighbours():
    grid = np.array(np.meshgrid(*[np.arange(8)] * 3)).reshape(3, -1)
    index = hilbert.hilbert_index(list(grid), 3)
    assert sorted(index) == list(range(512))
    path = grid[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def test_shards(docs, rows):
    got = {r["doc_id"]: r for r in hilbert.hilbert_shards(docs).collect()}
    slots = defaultdict(list)
    for doc, text, *_ in rows:
        data = (text or "").encode()
        assert got[doc]["size"] == len(data) + 1 and got[doc]["text_crc32"] == zlib.crc32(data) and got[doc]["grown_shard"] is None
        slots[got[doc]["shard"]].append(got[doc]["slot"])
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    order = sorted(got.values(), key=lambda r: (r["shard"], r["slot"]))
    assert [r["hilbert"] for r in order] == sorted(r["hilbert"] for r in order)


def test_shards_of_odd_tables(odd, empty):
    rows = hilbert.hilbert_shards(odd).collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows) == odd.count()
    assert hilbert.hilbert_shards(empty).count() == 0


# ---- mix

def plain_targets(sizes):
    names = sorted(sizes, key=lambda n: (n is None, (n or "").encode()))
    weight, fixed, total = {n: i % 3 + 1 for i, n in enumerate(names)}, {}, sum(sizes.values())
    while True:
        free = [n for n in names if n not in fixed]
        rest = total - sum(fixed.values())
        goal = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if goal[n] > 3 * sizes[n]]
        if not over:
            return fixed | goal
        fixed |= {n: 3 * sizes[n] for n in over}


def test_mix(docs, rows):
    got = {r["doc_id"]: r for r in apportion.mix(docs).collect()}
    sizes, taken = Counter(), Counter()
    for doc, text, _, source, *_ in rows:
        n = len(WORD.findall(text or ""))
        assert got[doc]["size"] == n and 0 <= got[doc]["taken"] <= 3 * n
        sizes[source] += n
        taken[source] += got[doc]["taken"]
    goal = plain_targets(sizes)
    for doc, _, _, source, *_ in rows:
        assert got[doc]["source_size"] == sizes[source] and got[doc]["target"] == pytest.approx(goal[source])
    assert all(abs(taken[s] - goal[s]) <= 4 for s in sizes)


def test_quotas_are_highest_quotients(spark):
    goal = spark.createDataFrame([("a", 1, 100, 900, 530.0), ("b", 2, 500, 900, 240.0), (None, 3, 300, 900, 130.0), ("big", 1, 60_000, 900, 60_000.0),
                                  ("half", 1, 45_000, 900, 45_000.5)], "source string, weight long, source_size long, _total long, target double")
    got, blocks = Counter(), {}
    for r in apportion.quotas(goal, shards=4).collect():
        got[r["source"]] += r["quota"]
        blocks[r["source"]] = r["block_words"]
    assert blocks == {"a": 1, "b": 1, None: 1, "big": 16, "half": 16}
    best = sorted((-t / (2 * k + 1), s) for s, t in (("a", 530), ("b", 240), ("z", 130)) for k in range(900))[:900]
    large = sorted((-t / (2 * k + 1), s) for s, t in (("big", 60_000), ("half", 45_000.5)) for k in range(9000))[:6563]
    assert got == Counter(None if s == "z" else s for _, s in best + large)


@pytest.mark.parametrize("scale", [1, 1000])
def test_small_sources_come_near_their_targets(spark, scale):
    """Ten large sources and small ones: every source within 1 % or three words of its target."""
    sizes = {f"large{i}": 1_000_000 * scale for i in range(10)} | {f"small{i}": n for i, n in enumerate((20, 40, 60, 90, 160, 200, 300, 1000, 7777, 65_537))}
    texts = [(source, part) for source, n in sizes.items() for part in [n // 7] * 6 + [n - 6 * (n // 7)]]
    sized = spark.createDataFrame([(i, source, size, i * 7919 % (1 << 28)) for i, (source, size) in enumerate(texts)], "doc_id long, source string, size long, place long")
    taken, goal = Counter(), {}
    for r in apportion.shared_out(sized).collect():
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert sum(sizes.values()) > 65_536 and set(goal) == set(sizes)
    assert all(abs(taken[s] - goal[s]) <= max(3, 0.01 * goal[s]) for s in sizes)


def test_mix_keeps_columns_that_sound_like_its_own(spark):
    df = spark.createDataFrame([(i, f"some words {i}", "s", 5, 6, "t") for i in range(9)], "doc_id long, text string, source string, _copy int, _taken int, _size string")
    out = apportion.mixed(df)
    assert out.columns == df.columns and {tuple(r)[3:] for r in out.collect()} == {(5, 6, "t")}


def test_mixed_texts_follow_the_plan(docs, odd, empty):
    plan = {r["doc_id"]: r["taken"] for r in apportion.mix(docs).collect()}
    words = Counter()
    out = apportion.mixed(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert words == Counter({doc: n for doc, n in plan.items() if n})
    assert apportion.mix(odd).count() == odd.count() and apportion.mix(empty).count() == 0 and apportion.mixed(empty).count() == 0


def test_mix_runs_no_python(docs):
    assert "Python" not in apportion.mix(docs)._jdf.queryExecution().executedPlan().toString()


# ---- pieces

MODEL = pytest.importorskip("os").path.exists(pieces.MODEL_PATH)
needs_model = pytest.mark.skipif(not MODEL, reason="no model file")


@needs_model
def test_same_as_library_on_single_words():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto
    model = proto.ModelProto()
    with open(pieces.MODEL_PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1       # the same pieces as a unigram model
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    lattice = pieces.lattice(pieces.MODEL_PATH)
    for text in ("hello", "straightforward", "ununderstandable", "x", "Kraftfahrzeug", "été", "notes"):
        score, ids = lattice.encode(pieces.escaped(text))
        assert score == sum(library.get_score(i) for i in library.encode(text)) and lattice.decode(ids) == b" " + text.encode()


@needs_model
def test_chunks_give_the_whole_text(docs, rows):
    lattice = pieces.lattice(pieces.MODEL_PATH)
    parts = defaultdict(dict)
    for r in pieces.encode_texts(docs, giant_chars=1000, chunk_chars=300).collect():
        assert r["n_tokens"] == len(r["ids"])
        parts[r["doc_id"]][r["chunk"]] = r
    assert max(map(len, parts.values())) > 100 and set(parts) == {row[0] for row in rows}
    for doc, text, *_ in rows:
        own = [parts[doc][k] for k in sorted(parts[doc])]
        assert all(r["exact"] != ("▁" in (text or "")) for r in own)      # a mark decodes to a space
        ids = np.array([i for r in own for i in r["ids"]], int)
        score, whole = lattice.encode(pieces.escaped(text or ""))
        assert sum(r["score"] for r in own) == score
        assert lattice.decode(ids) == (b" " + text.replace("▁", " ").encode() if text else b"")
        if " " in (text or ""):
            assert ids.tolist() == whole.tolist()


@needs_model
def test_transfer_matrices_are_associative():
    lattice = pieces.lattice(pieces.MODEL_PATH)
    text = pieces.escaped("abcabcabbacabacabbabcabcabcaabbccabcabcacbabcabcbabc" * 3)
    ends = [(0, False), (40, True), (77, True), (120, True), (len(text), False)]
    made = []
    for (a, free_in), (b, free_out) in zip(ends, ends[1:]):
        lead = min(a, lattice.longest - 1) if free_in else 0
        made.append(lattice.transfer(text[a - lead:b], lead, free_in, free_out))
    left = pieces.combine(pieces.combine(pieces.combine(made[0], made[1]), made[2]), made[3])
    right = pieces.combine(made[0], pieces.combine(made[1], pieces.combine(made[2], made[3])))
    assert left.tolist() == right.tolist() == [[lattice.encode(text)[0]]]


@needs_model
def test_pieces_of_odd_tables(odd, empty):
    assert pieces.encode_texts(odd).count() == odd.count()
    assert pieces.encode_texts(empty).count() == 0
