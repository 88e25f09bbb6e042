import random
from collections import defaultdict

import pytest

from threadlens.operators import threads as th

SCHEMA = "id string, submission_id string, parent_id string, created_utc timestamp, text string"


def forest(seed=3, posts=6, comments=250):
    import datetime as dt
    rng = random.Random(seed)
    rows, depth, of_post = [], {}, defaultdict(list)
    for k in range(comments):
        post = "p0" if rng.random() < 0.4 else f"p{rng.randrange(posts)}"
        own = of_post[post]
        if not own or rng.random() < 0.2:
            parent, d = f"t3_{post}", 0
        else:
            above = own[-1] if rng.random() < 0.5 else rng.choice(own)
            parent, d = f"t1_{above}", depth[above] + 1
        cid = f"c{k:03d}"
        depth[cid] = d
        own.append(cid)
        rows.append((cid, post, parent, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(50)), f"text {k}"))
    return rows, depth


@pytest.fixture(scope="module")
def data(spark):
    rows, depth = forest()
    return spark.createDataFrame(rows, SCHEMA), rows, depth


def test_depth_of_every_comment(spark, data):
    comments, rows, depth = data
    assert {r.id: r.depth for r in th.comment_depth(comments).collect()} == depth
    assert max(depth.values()) > 8


def shapes():
    """``(id, parent_id)`` of trees of many shapes, and their depths."""
    chain = [(f"c{i}", f"t1_c{i - 1}" if i else "t3_p") for i in range(600)]
    star = [("s", "t3_p")] + [(f"s{i}", "t1_s") for i in range(600)]
    comb = [(f"k{i}", f"t1_k{i - 1}" if i else "t3_p") for i in range(300)] + [(f"l{i}", f"t1_k{i}") for i in range(300)]
    binary = [(f"b{i}", f"t1_b{(i - 1) // 2}" if i else "t3_p") for i in range(600)]
    tops = [(f"t{i}", "t3_p") for i in range(600)]
    circles = [(f"x{i}", f"t1_x{(i + 1) % 7}") for i in range(7)] + [("y", "t1_x0"), ("self", "t1_self"), ("z", "t1_self"), ("zz", "t1_z"), ("o", "t1_gone"), ("oo", "t1_o")]
    return {"chain": chain, "star": star, "comb": comb, "binary": binary, "tops": tops, "circles": circles + chain[:40], "repeated": star[:50] * 2 + chain[:30] * 3}


def plain_depths(rows):
    up, depth = dict(rows), {}
    for start in up:
        at, hops, seen = start, 0, set()
        while at in up and at not in seen and not up[at].startswith("t3_"):
            seen.add(at)
            at, hops = up[at][3:], hops + 1
        depth[start] = hops if at in up and up[at].startswith("t3_") else None
    return depth


@pytest.mark.parametrize("jump_max_rows", [1_000_000, 20])
@pytest.mark.parametrize("shape", shapes())
def test_depths_and_rows_of_all_rounds(spark, monkeypatch, shape, jump_max_rows):
    rows = shapes()[shape]
    written = []

    def counted(df):
        kept = plain(df)
        written.append(kept.count())
        return kept

    plain = th.cut_lineage
    monkeypatch.setattr(th, "cut_lineage", counted)
    df = spark.createDataFrame([(a, "p", b) for a, b in rows], "id string, submission_id string, parent_id string")
    got = [(r.id, r.depth) for r in th.comment_depth(df, jump_max_rows=jump_max_rows).collect()]
    want = plain_depths(rows)
    assert sorted(got, key=str) == sorted(((a, want[a]) for a, _ in rows), key=str)
    if jump_max_rows == 20 or shape != "chain":
        assert sum(written) <= 14 * len(rows)      # each is read a fixed number of times


@pytest.mark.parametrize("shape", ["chain", "comb", "binary", "circles", "star"])
def test_late_comments_give_the_table_of_all(spark, shape):
    rows = shapes()[shape]
    draw = random.Random(6)
    late = [draw.random() < 0.3 for _ in rows]
    frame = lambda some: spark.createDataFrame([(a, "p", b) for a, b in some], "id string, submission_id string, parent_id string")
    stored = spark.createDataFrame(th.depth_table(frame([r for r, l in zip(rows, late) if not l])).collect(), "id string, parent_id string, depth int")
    got = th.with_late_comments(stored, frame([r for r, l in zip(rows, late) if l]))
    want, up_of = plain_depths(rows), dict(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((a, up_of[a], d) for a, d in want.items()), key=str)
    assert th.with_late_comments(stored, frame(rows).limit(0)).count() == stored.count()


def test_orphans_and_cycles_have_no_depth(spark):
    rows = [("a", "p", "t3_p"), ("b", "p", "t1_gone"), ("c", "p", "t1_b"), ("x", "p", "t1_y"), ("y", "p", "t1_x")]
    df = spark.createDataFrame(rows, "id string, submission_id string, parent_id string")
    assert {r.id: r.depth for r in th.comment_depth(df).collect()} == {
        "a": 0, "b": None, "c": None, "x": None, "y": None}


@pytest.mark.parametrize("length", [2, 3, 5, 8])
def test_circles_end(spark, length):
    rows = [(f"x{i}", "p", f"t1_x{(i + 1) % length}") for i in range(length)] + [
        ("y", "p", "t1_x0"), ("a", "p", "t3_p"), *((f"b{i}", "p", f"t1_b{i - 1}" if i else "t1_a") for i in range(20))]
    df = spark.createDataFrame(rows, "id string, submission_id string, parent_id string")
    got = {r.id: r.depth for r in th.comment_depth(df).collect()}
    assert got == {**{f"x{i}": None for i in range(length)}, "y": None, "a": 0, **{f"b{i}": i + 1 for i in range(20)}}


def test_the_source_is_read_once(spark, data, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = data[0].select("id", "submission_id", "parent_id").coalesce(1).mapInPandas(look, "id string, submission_id string, parent_id string")
    assert th.comment_depth(df).count() == reads.value == len(data[1])


def test_first_comments_per_post(spark, data):
    comments, rows, depth = data
    posts = spark.createDataFrame([("p0",), ("p1",), ("p9",)], "id string")
    got = defaultdict(list)
    for r in sorted(th.top_comments_per_post(comments, posts, 4).collect(), key=lambda r: r["rank"]):
        got[r.submission_id].append(r.id)
    order = lambda post: [r[0] for r in sorted((r for r in rows if r[1] == post), key=lambda r: (depth[r[0]], r[3], r[0]))]
    assert dict(got) == {"p0": order("p0")[:4], "p1": order("p1")[:4]}
    everything = th.top_comments_per_post(comments, posts, None)
    assert everything.count() == len(order("p0")) + len(order("p1"))
    assert [r.id for r in th.comments_of_post(comments, "p0", 7).collect()] == order("p0")[:7]
    assert th.comments_of_post(comments, "p0", 0).count() == 0
    assert th.comments_of_post(comments, "p0").count() == len(order("p0"))


def test_stored_comments(spark, data):
    comments, rows, _ = data
    want = [r[0] for r in sorted((r for r in rows if r[1] == "p2"), key=lambda r: (r[3], r[0]))]
    assert [r.id for r in th.stored_comments(comments, "p2", 3).collect()] == want[:3]
    assert [r.id for r in th.stored_comments(comments, "p2", 0).collect()] == want


def test_posts_with_comments(spark, data):
    comments, rows, _ = data
    posts = spark.createDataFrame([("p1", "t"), ("p9", "t")], "id string, title string")
    inner = th.with_posts(posts, comments)
    assert inner.count() == sum(r[1] == "p1" for r in rows) and "comment_text" in inner.columns
    assert th.with_posts(posts, comments, "left").filter("comment_id is null").count() == 1
