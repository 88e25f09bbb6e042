import math
import random

import pytest
from pyspark.sql import functions as F

from threadlens.functions.probability import model_score, overall_model
from threadlens.operators import model as om
from threadlens.operators.model import score_model, score_model_batch


def _factory():
    def make():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("no model")
            return [[0.0, 1.0, float(len(t))] for t in texts]
        return predict
    return make


by_length = _factory()


def softmax(xs):
    e = [math.exp(x - max(xs)) for x in xs]
    return [x / sum(e) for x in e]


def test_softmax_and_label(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.5],), ([3.0, 3.0, 1.0],)], "l array<double>")
    first, tie = [r[0] for r in df.select(model_score(F.col("l"))).collect()]
    p = softmax([1.0, 2.0, 0.5])
    assert [first.neg, first.neu, first.pos] == pytest.approx(p)
    assert first.compound == pytest.approx(p[2] - p[0]) and first.sentiment == "neutral"
    assert tie.sentiment == "negative"


def test_other_labels_have_no_compound(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "l array<double>")
    score = df.select(model_score(F.col("l"), labels=("LABEL_0", "LABEL_1"))).first()[0]
    assert score.sentiment == "LABEL_1" and score.compound == 0.0 and score.neg is None


def test_failed_batches_mark_their_own_texts(spark):
    rows = [(str(i), "boom" if i == 4 else "x" * i) for i in range(12)]
    df = spark.createDataFrame(rows, "id string, text string").coalesce(1)
    out = {r.id: r.s for r in score_model(df, {"s": "text"}, by_length, batch_size=3).collect()}
    failed = {i for i, s in out.items() if s.error}
    assert failed == {"3", "4", "5"}
    assert out["4"].sentiment == "neutral" and out["4"].compound == 0.0 and out["4"].neg is None
    assert out["7"].pos == pytest.approx(softmax([0.0, 1.0, 7.0])[2])


def test_truncation_is_an_option(spark):
    df = spark.createDataFrame([("1", "aa bb cc")], "id string, text string")
    short = score_model(df, {"s": "text"}, by_length, max_length=1).first().s.pos
    whole = score_model(df, {"s": "text"}, by_length, max_length=None).first().s.pos
    assert short == pytest.approx(softmax([0, 1, 2.0])[2]) and whole == pytest.approx(softmax([0, 1, 8.0])[2])


def test_posts_and_overall(spark):
    df = spark.createDataFrame([("1", "", "xxxx"), ("2", "boom", "xxxxx")], "id string, title string, text string").coalesce(1)
    good, bad = score_model_batch(df, "submission", by_length, batch_size=2, model_name="m",
                                  run_ts="2024-01-01").orderBy("id").collect()
    t, x = softmax([0, 1, 0.0]), softmax([0, 1, 4.0])
    assert good.overall_sentiment.pos == pytest.approx(0.3 * t[2] + 0.7 * x[2])
    assert good.overall_sentiment.sentiment == "positive" and good.sentiment_analysis.model == "m"
    assert bad.overall_sentiment.sentiment == "neutral" and bad.overall_sentiment.error == "no model"


def test_overall_label_is_the_highest_class(spark):
    score = "struct<neg:double,neu:double,pos:double,compound:double,sentiment:string,error:string>"
    df = spark.createDataFrame([((0.5, 0.1, 0.4, -0.1, "negative", None), (0.35, 0.3, 0.35, 0.0, "negative", None))],
                               f"t {score}, x {score}")
    assert df.select(overall_model(F.col("t"), F.col("x"))).first()[0].sentiment == "negative"


def test_scores_are_computed_once_under_a_filter(spark):
    df = spark.createDataFrame([("1", "x")], "id string, text string")
    plan = score_model(df, {"s": "text"}, by_length).filter("s.sentiment = 'neutral'")
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_batches_by_length_pad_little_and_keep_the_order(spark):
    draw = random.Random(2)
    texts = ["x" * draw.choice([1, 3, 10, 40, 200, 900]) + str(i) for i in range(1000)]
    padding = lambda batches: sum(len(b) * max(len(texts[at]) for at in b) - sum(len(texts[at]) for at in b) for b in batches)
    plain = [list(range(at, min(at + 8, 1000))) for at in range(0, 1000, 8)]
    sorted_ = list(om.mini_batches(texts, 8))
    assert sorted(at for b in sorted_ for at in b) == list(range(1000)) and padding(sorted_) < 0.02 * padding(plain)
    assert all(len({at // 100 for at in b}) == 1 for b in om.mini_batches(texts, 8, 100))

    def make_scorer():
        return lambda batch: [[float(len(text)), 0.0, float(text.lstrip("x"))] for text in batch]

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    logits = df.select("id", "text", om.logits_of(F.array("text", F.lit("x7")), make_scorer)["logits"].alias("l")).collect()
    assert all(r["l"] == [[float(len(r["text"])), 0.0, float(r["id"])], [2.0, 0.0, 7.0]] for r in logits)
