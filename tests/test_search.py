import pytest
from pyspark.sql import functions as F

from threadlens.functions import keywords as kw
from threadlens.operators import search as se

SCHEMA = "id string, title string, text string, score long, created_utc timestamp, num_comments long, subreddit string"


@pytest.fixture(scope="module")
def posts(spark):
    rows = spark.range(300).select(
        F.format_string("p%03d", "id").alias("id"),
        F.when(F.col("id") % 2 == 0, "Climate Change now").otherwise("other").alias("title"),
        F.when(F.col("id") % 3 == 0, "about climate   change, climate change").otherwise("nothing").alias("text"),
        (F.col("id") * 7 % 101).alias("score"),
        (F.timestamp_seconds(F.lit(1706659200)) - F.make_dt_interval(hours=F.col("id").cast("int"))).alias("created_utc"),
        (F.col("id") % 11).alias("num_comments"),
        F.when(F.col("id") % 10 < 7, "Science").when(F.col("id") % 10 < 9, "Tech").otherwise("Art").alias("subreddit"))
    return rows.select([F.col(c) for c in "id title text score created_utc num_comments subreddit".split()])


AS_OF = "2024-01-31 00:00:00"


def local(posts):
    return [r for r in posts.collect() if "limate" in r.title or "limate" in r.text]


def test_phrases_at_word_edges(spark):
    df = spark.createDataFrame([("the AI age",), ("said",), ("a.i",), ("ai_x",), ("über-AI!",), (None,)], "t string")
    assert [r[0] for r in df.select(kw.matches("ai", F.col("t"))).collect()] == [True, False, False, False, True, False]
    assert df.select(F.sum(kw.occurrences(["ai"], F.col("t")))).first()[0] == 2
    assert df.filter(kw.matches([], F.col("t"))).count() == 0
    assert df.filter(kw.matches("  ", F.col("t"))).count() == 0
    special = spark.createDataFrame([("I use C++ daily",), ("C sharp",)], "t string")
    assert special.filter(kw.matches("c++", F.col("t"))).count() == 1


def test_query_string_round_trip(spark):
    q = kw.query_string(["a b", "c"])
    assert q == '"a b" OR "c"'
    assert spark.createDataFrame([(q,)], "q string").select(kw.extract_keywords(F.col("q"))).first()[0] == ["a b", "c"]


def test_search_everything(posts):
    found = se.keyword_search(posts, "climate change", time_filter="all", sort="top", limit=20, as_of=AS_OF).collect()
    want = sorted(local(posts), key=lambda r: (-r.score, r.id))[:20]
    assert [r.id for r in found] == [r.id for r in want]


def test_defaults_are_week_hundred_relevance(posts):
    found = se.keyword_search(posts, "climate change", as_of=AS_OF).collect()
    recent = [r for r in local(posts) if int(r.id[1:]) <= 168]
    hits = lambda r: ("Climate" in r.title) + r.text.count("climate")
    want = sorted(recent, key=lambda r: (-hits(r), r.id))[:100]
    assert [r.id for r in found] == [r.id for r in want]


def test_no_limit_means_all(posts):
    every = se.keyword_search(posts, "climate change", time_filter=None, limit=None)
    assert every.count() == len(local(posts)) > 100
    own = se.keyword_search(posts, "climate change", ["tech", "ART"], time_filter=None, limit=None)
    assert {r.id for r in own.collect()} == {r.id for r in local(posts) if r.subreddit in ("Tech", "Art")}
    with pytest.raises(ValueError):
        se.keyword_search(posts, "x", ["tech"], limit=None, limits={"tech": {"max": 3}})


def test_two_spellings_are_one_group(posts):
    args = dict(time_filter="all", sort="new", limit=20, as_of=AS_OF)
    once = se.keyword_search(posts, "climate change", ["science"], weights={"Science": 2}, **args)
    twice = se.keyword_search(posts, "climate change", ["SCIENCE", "science", "Science"], weights={"SCIENCE": 2}, **args)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert se.keyword_search(posts, "climate change", [], **args).count() == 0


def test_group_key_reaches_the_scan(spark, posts, tmp_path):
    se.with_group_key(posts).write.parquet(str(tmp_path / "p"))
    plan = se.in_groups(spark.read.parquet(str(tmp_path / "p")), ["TECH", "art"])._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "In(group_key, [art,tech" in pushed


def test_spaces_inside_phrases(spark):
    df = spark.createDataFrame([("climate\u00a0change",), ("climate \u2003 change",), ("climatechange",)], "t string")
    assert [r[0] for r in df.select(kw.matches("climate change", F.col("t"))).collect()] == [True, True, False]


def test_budget_over_groups(posts):
    args = dict(time_filter="all", sort="new", limit=30, as_of=AS_OF)
    rows = se.keyword_search(posts, "climate change", ["science", "tech", "art"],
                             weights={"science": 4, "tech": 1, "art": 1}, **args).collect()
    per = {}
    for r in rows:
        per.setdefault(r.subreddit, []).append(r)
    assert {g: len(v) for g, v in per.items()} == {"Science": 19, "Tech": 5, "Art": 5}
    for group, got in per.items():
        want = sorted((r for r in local(posts) if r.subreddit == group), key=lambda r: -r.created_utc.timestamp())
        assert [r.id for r in sorted(got, key=lambda r: r.rank)] == [r.id for r in want[:len(got)]]
        assert [r.phase for r in sorted(got, key=lambda r: r.rank)] == [0] + [1] * (len(got) - 1)


def test_minimums_may_exceed_the_budget_unless_strict(posts):
    limits = {g: {"min": 4} for g in ("science", "tech", "art")}
    args = dict(time_filter="all", sort="top", limit=6, limits=limits, as_of=AS_OF)
    groups = ["science", "tech", "art"]
    assert se.keyword_search(posts, "climate change", groups, **args).count() == 12
    assert se.keyword_search(posts, "climate change", groups, strict=True, **args).count() == 6


def test_edge_cases_find_nothing(posts):
    assert se.keyword_search(posts, [], ["science"], time_filter="all", as_of=AS_OF).count() == 0
    assert se.keyword_search(posts, "climate change", "no_such_group", time_filter="all", as_of=AS_OF).count() == 0
    with pytest.raises(ValueError):
        se.keyword_search(posts, "x", sort="best")
    with pytest.raises(ValueError):
        se.keyword_search(posts, "x", time_filter="decade")


def test_only_first_rows_reach_the_shuffle(posts):
    from threadlens.scale import top_n_per_group
    plan = top_n_per_group(posts, ["subreddit"], [F.col("score").desc()], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_salted_top_n_is_exact_for_a_hot_group(spark):
    from threadlens.scale import top_n_per_group
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(
        F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"), (F.col("id") * 7919 % 4999).alias("v"))
    got = {(r.g, r.id) for r in top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 7).collect()}
    rows = df.collect()
    want = set()
    for g in {r.g for r in rows}:
        want |= {(g, r.id) for r in sorted((r for r in rows if r.g == g), key=lambda r: (-r.v, r.id))[:7]}
    assert got == want


def test_time_and_columns_reach_the_scan(spark, posts, tmp_path):
    posts.write.parquet(str(tmp_path / "posts"))
    table = spark.read.parquet(str(tmp_path / "posts"))
    found = se.keyword_search(table, "climate change", search_all=True, sort="top", as_of=AS_OF).select("id", "score")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_utc" in plan and "TakeOrderedAndProject" in plan
    assert "num_comments" not in plan and "subreddit" not in plan
