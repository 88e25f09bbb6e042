import pytest
from pyspark.sql import functions as F

from catalog import views
from threadlens.operators.compare import agreement_summary, compare, disagreements
from threadlens.plans.ingest import ingest
from threadlens.plans.topic import analyze_topic
from threadlens.sources import records, tables
from threadlens.sources.upsert import check_reference

SF = "/root/testdata/sf0.001"
ASK = dict(keywords=["the", "le"], groups=["src0", "src1", "SRC2"], limit=12, time_filter="month", sort="top",
           as_of="2024-01-08 00:00:00")


@pytest.fixture(scope="module")
def source(spark):
    return views.posts(spark, SF), views.comments(spark, SF)


@pytest.fixture(scope="module")
def analysis(source):
    return analyze_topic(*source, make_scorer=views.letter_scorer, comment_limit=2, lexicon=views.LEXICON,
                         run_ts="2024-02-01T00:00:00", max_length=None, **ASK)


def test_topic(analysis, tmp_path):
    meta = analysis.metadata.first()
    rows = analysis.comparison().collect()
    assert meta.submission_count == sum(r.content_type == "submission" for r in rows) > 0
    assert meta.comment_count == sum(r.content_type == "comment" for r in rows)
    assert meta.keywords == ["the", "le"] and meta.error is None
    summary = analysis.summary().first()
    assert summary["items"] == len(rows)
    assert summary.agreement_rate == round(100 * sum(r.agreement for r in rows) / len(rows), 1)
    examples = analysis.disagreements().collect()
    assert len(examples) <= 5 and all(len(r.text) <= 100 for r in examples)
    analysis.write(str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"metadata", "submissions", "comments", "comparison"}


def test_storage_columns(analysis, source):
    rows = tables.to_storage(analysis.posts, "submission")
    assert set(rows.columns) <= set(tables.table_schema("submission").fieldNames())
    stored = rows.first()
    raw = source[0].filter(F.col("id") == stored.id).first()
    assert stored.text == raw.text and stored.text_cleaned == analysis.posts.filter(F.col("id") == stored.id).first().text
    assert "cleaned" not in tables.to_storage(analysis.comments, "comment").columns


def test_nothing_found(source):
    empty = analyze_topic(*source, keywords=[], groups=["src0"], make_scorer=views.letter_scorer, lexicon=views.LEXICON)
    assert empty.metadata.first().error == "No submissions found" and empty.comparison().count() == 0


def test_comparison_by_id_equals_the_one_in_the_row(analysis):
    side = lambda prefix: analysis.posts.select("id", "title", "text", F.col(f"{prefix}overall_sentiment").alias("overall_sentiment"))
    joined = compare(side("rules_"), side("model_"), "submission")
    own = analysis.comparison().filter("content_type = 'submission'")
    assert sorted(map(str, joined.collect())) == sorted(map(str, own.collect()))


def test_summary_and_disagreements(spark):
    df = spark.createDataFrame([("comment", str(i), "x" * 150, "positive", 0.126, "negative", -0.5, i % 3 == 0) for i in range(9)],
                               "content_type string, id string, text string, vader_sentiment string, vader_compound double, "
                               "transformer_sentiment string, transformer_compound double, agreement boolean")
    assert tuple(agreement_summary(df).first()) == (9, 33.3)
    assert disagreements(df).count() == 6
    top = disagreements(df, 5).collect()
    assert [r.id for r in top] == ["1", "2", "4", "5", "7"] and top[0].vader_compound == "0.13" and len(top[0].text) == 100


def test_ingest_and_read_back(spark, source, tmp_path):
    posts, comments = source
    ask = {**ASK, "sort": "comments"}
    result = ingest(posts, comments, tables.empty_table(spark, "submission"), tables.empty_table(spark, "comment"),
                    comment_limit=3, run_ts="2024-02-01T00:00:00", **ask)
    counts = result.counts.first()
    tables.write_snapshot(result.posts, str(tmp_path / "posts"))
    tables.write_snapshot(result.comments, str(tmp_path / "comments"))
    stored = tables.read_table(spark, str(tmp_path / "posts"), "submission")
    replies = tables.read_table(spark, str(tmp_path / "comments"), "comment")
    assert stored.count() == counts.submissions_stored >= 1
    assert replies.count() == counts.comments_stored >= 1
    assert stored.filter("processed and processed_at is not null").count() == counts.submissions_stored
    assert check_reference(replies, stored).filter("not accepted").count() == 0
    again = ingest(posts, comments, stored, replies, comment_limit=3, run_ts="2024-02-01T00:00:00", **ask)
    assert again.posts.count() == counts.submissions_stored and again.comments.count() == counts.comments_stored
    none = ingest(posts, comments, stored, replies, **{**ask, "keywords": []})
    assert tuple(none.counts.first()) == (0, 0)
    nobody = ingest(posts, comments, stored, replies, **{**ask, "groups": ["this_is_no_group"]})
    assert tuple(nobody.counts.first()) == (0, 0)
    bare = ingest(posts, comments, stored, replies, include_comments=False, **ask)
    assert bare.counts.first().comments_stored == 0


def test_record_projection(spark):
    raw = spark.createDataFrame([("1", "t", "b", 3, 1704067200, None, 2, "u", "s", 0.5)],
                                "id string, title string, selftext string, score int, created_utc long, author string, "
                                "num_comments int, url string, subreddit string, upvote_ratio float")
    assert records.project_posts(raw).first().author is None
    row = records.project_posts(raw, "None").select("author", F.unix_timestamp("created_utc").alias("t")).first()
    assert (row.author, row.t) == ("None", 1704067200)
    c = spark.createDataFrame([("1", "b", 1, 0, "a", "p", "t1_x")],
                              "id string, body string, score int, created_utc long, author string, submission_id string, parent_id string")
    assert records.project_comments(c).first().is_root is False


def test_expressions_run_on_a_stream(spark, tmp_path):
    from threadlens.operators.clean import clean
    from threadlens.operators.rules import score_rules
    stream = spark.readStream.schema("doc_id long, text string").parquet(SF + "/documents.parquet*")
    scored = score_rules(clean(stream, ["text"]), {"score": "text"}, views.LEXICON)
    q = scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("scored").count() == 200
