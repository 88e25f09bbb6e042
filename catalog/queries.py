"""One Spark query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import views as v
from threadlens.functions import cleaning as cl
from threadlens.functions import dates, keywords
from threadlens.functions import lexicon as lx
from threadlens.functions import probability as pb
from threadlens.functions import tokens as tk
from threadlens.operators import clean as oc
from threadlens.operators import compare as cmp
from threadlens.operators import model as om
from threadlens.operators import normalize as on
from threadlens.operators import phrases as ph
from threadlens.operators import quota as oq
from threadlens.operators import rules as orl
from threadlens.operators import search as se
from threadlens.operators import threads as th
from threadlens.plans.ingest import ingest
from threadlens.plans.topic import analyze_topic, run_metadata, score_items
from threadlens.scale import inline_lookup, scratch_path
from threadlens.schemas import POSTS_RAW
from threadlens.sources import csvstore, records, tables, upsert as up

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEYWORDS = ["the", "of the", "worthless"]
RELEVANCE_WORDS = ["the", "le", "worthless"]
GROUPS = ["src0", "SRC1", "src2", "src3", "src4", "src5"]
WEIGHTS = {"src0": 0.5, "SRC1": 0.3, "src2": 0.2, "src3": 0.2, "src4": 0.1, "src5": 0.1}
LIMITS = {"src0": {"min": 3, "max": 12}, "SRC1": {"min": 2, "max": 40}, "src4": {"min": 0}}
BUDGET = 60
SCORE_COLUMNS = ("neg", "neu", "pos", "compound")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(struct: str) -> list:
    return [F.round(F.col(struct)[c], 6).alias(c) for c in SCORE_COLUMNS] + [
        F.col(struct)["sentiment"].alias("sentiment")]


def noisy(column: str):
    return F.concat(F.lit(v.NOISE_HEAD), F.col(column), F.lit(v.NOISE_TAIL))


def toned(spark, d, name="documents", key="doc_id"):
    df = v.texts(spark, d, name)
    return df.select(F.col(key).cast("string").alias("id"), F.concat("text", F.lit(v.TONE)).alias("text"))


# --- search -----------------------------------------------------------------

@query
def keyword_match(spark, d):
    p = v.posts(spark, d, v.texts)
    return p.select("id", keywords.matches(KEYWORDS, F.col("title"), F.col("text")).alias("matched"))


def _benchmark_phrases(spark, d):
    """Every two to five consecutive words of the benchmark texts, thousands of phrases."""
    words = v.table(spark, d, "benchmark").select(F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w"))
    starts = words.select("w", F.posexplode("w").alias("at", "first"))
    windows = starts.select(F.explode(F.array(*[F.when(F.col("at") + n <= F.size("w"), F.array_join(F.slice("w", F.col("at") + 1, F.lit(n)), " "))
                                                for n in (2, 3, 4, 5)])).alias("phrase"))
    return windows.filter("phrase is not null").distinct()


@query
def keyword_match_table(spark, d):
    """Which of thousands of phrases each post holds."""
    p = ph.match_phrases(v.posts(spark, d, v.texts), ["title", "text"], _benchmark_phrases(spark, d))
    found = F.transform(ph.MATCHED, lambda hit: hit["phrase"])
    return p.select("id", F.size(ph.MATCHED).cast("long").alias("n_phrases"), F.md5(F.array_join(found, "|")).alias("phrases_md5"))


@query
def keyword_search_table(spark, d):
    """The thirty posts of the last week that hold phrases of the list most often."""
    found = se.keyword_search(v.posts(spark, d, v.texts), _benchmark_phrases(spark, d), search_all=True, limit=30, as_of=v.POSTS_AS_OF)
    return found.select("id", "subreddit", ph.occurrences_of(F.col(ph.MATCHED)).alias("occurrences"))


@query
def extract_keywords(spark, d):
    docs = v.table(spark, d, "documents")
    built = F.concat(F.lit('"'), F.col("source"), F.lit('" OR "'), F.col("lang"), F.lit(' x" OR solo'))
    return docs.select("doc_id", F.array_join(keywords.extract_keywords(built), "|").alias("keywords"))


@query
def group_scope(spark, d):
    p = se.in_groups(v.posts(spark, d), GROUPS)
    return p.select("id", "subreddit")


@query
def time_filter_week(spark, d):
    e = v.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("subreddit"),
        F.col("ts").alias("created_utc"))
    return se.in_window(e, "week", v.EVENTS_AS_OF)


def _sorted(sort):
    def run(spark, d):
        p = se.sort_posts(v.posts(spark, d, replies=sort == "comments"), sort, 100, RELEVANCE_WORDS)
        w = Window.orderBy(F.col("sort_key").desc_nulls_last(), "id")
        key = F.round(F.col("sort_key"), 6).alias("sort_key") if sort == "hot" else F.col("sort_key")
        return p.withColumn("place", F.row_number().over(w)).select("place", "id", key)
    run.__name__ = f"sort_{sort}"
    return query(run)


for _mode in se.SORT_MODES:
    _sorted(_mode)


@query
def keyword_search_all(spark, d):
    found = se.keyword_search(v.posts(spark, d, v.texts), KEYWORDS, search_all=True, time_filter="week",
                              sort="top", limit=50, as_of=v.POSTS_AS_OF)
    return found.select("id", "title", "score", "subreddit", "created_utc")


@query
def search_defaults(spark, d):
    """No options: the last week's hundred most relevant posts."""
    found = se.keyword_search(v.posts(spark, d, v.texts), RELEVANCE_WORDS, as_of=v.POSTS_AS_OF)
    return found.select("id", "subreddit", "created_utc")


@query
def keyword_search_every_match(spark, d):
    """No limit, no time window: all matches in the named groups."""
    found = se.keyword_search(v.posts(spark, d, v.texts), KEYWORDS, ["src0", "SRC0", "src3"], time_filter=None, limit=None)
    return found.select("id", "subreddit")


@query
def keyword_search_quota(spark, d):
    found = se.keyword_search(v.posts(spark, d, v.texts), KEYWORDS, GROUPS, time_filter="week", sort="top",
                              limit=BUDGET, weights=WEIGHTS, limits=LIMITS, as_of=v.POSTS_AS_OF)
    return found.select("id", "subreddit", "score", F.col("rank").cast("long").alias("rank"),
                        F.col("phase").cast("long").alias("phase"))


# --- budgets ----------------------------------------------------------------

def event_counts(spark, d):
    e = v.table(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("grp")).agg(F.count(F.lit(1)).alias("n"))


def event_quotas(spark, d):
    """A quota row per event type, derived from the events themselves."""
    e = v.table(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("grp")).agg(
        F.count_if(F.col("value") > 20).alias("weight"),
        F.count_if(F.col("value") < 1).alias("min"),
        F.when(F.max(F.length("event_type")) > 5, F.count_if(F.col("value") > 10)).alias("max"))


@query
def group_counts(spark, d):
    """Rows there are and rows a budget takes, for each named group."""
    counts = v.posts(spark, d).groupBy(F.lower("subreddit").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    named = se.folded(GROUPS)
    low = lambda given: {group.lower(): value for group, value in given.items()}
    quotas = oq.quota_table(spark, named, low(WEIGHTS), low(LIMITS), BUDGET)
    return oq.allocate_budget(counts, quotas, BUDGET).select(
        F.col("grp").alias("subreddit"), F.col("n").alias("available"), F.col("take").alias("taken"))


@query
def normalize_weights(spark, d):
    return oq.normalize_weights(event_quotas(spark, d)).select("grp", F.round("share", 6).alias("share"))


@query
def validate_limits(spark, d):
    return oq.validate_limits(event_quotas(spark, d), 2000).select("grp", "min", "max")


@query
def initial_limits(spark, d):
    q = oq.validate_limits(event_quotas(spark, d), 2000)
    return oq.initial_limits(q, 2000).select("grp", "initial")


@query
def quota_allocation(spark, d):
    q = oq.validate_limits(event_quotas(spark, d), 2000)
    return oq.allocate_budget(event_counts(spark, d), q, 2000).select("grp", "n", "base", "extra", "take")


# --- threads ----------------------------------------------------------------

@query
def comments_of_post(spark, d):
    found = th.comments_of_post(v.comments(spark, d), "7", 5)
    return found.select("id", "depth", "text")


@query
def stored_comments_of_post(spark, d):
    return th.stored_comments(v.comments(spark, d), "7", 6)


@query
def comment_depth(spark, d):
    return th.comment_depth(v.comments(spark, d))


@query
def comment_depth_delta(spark, d):
    """Depths of all comments from a stored table without every third of them, and these as late ones."""
    c = v.comments(spark, d)
    stored = th.depth_table(c.filter("score % 3 <> 0")).select("id", "parent_id", "depth")
    return th.with_late_comments(stored, c.filter("score % 3 = 0")).select("id", "depth")


@query
def comments_topn_per_post(spark, d):
    p = v.posts(spark, d, replies=True).filter(F.col("num_comments") > 0)
    best = th.top_comments_per_post(v.comments(spark, d), p, 3)
    return best.select("submission_id", F.col("rank").cast("long").alias("rank"), "id", "depth", "text")


@query
def post_comment_join(spark, d):
    p = v.posts(spark, d).select("id", "subreddit", "score")
    both = th.with_posts(p, v.comments(spark, d).select("id", "submission_id", "author"), "left")
    return both.select("id", "subreddit", "score", "comment_id", "comment_author")


# --- records and cleaning ---------------------------------------------------

@query
def project_posts(spark, d):
    raw = v.posts(spark, d, replies=True).select(
        "id", "title", F.col("text").alias("selftext"), "score",
        (F.lit(1704067200) + F.col("id").cast("long") * 60).alias("created_utc"),
        F.when(F.col("author") != "u5", F.col("author")).alias("author"),
        "num_comments", "url", "subreddit", "upvote_ratio")
    return records.project_posts(raw).withColumn("created_utc", dates.format_iso(F.col("created_utc")))


@query
def project_comments(spark, d):
    raw = v.comments(spark, d).select(
        "id", F.col("text").alias("body"), "score",
        (F.lit(1704067200) + F.col("score") * 61).alias("created_utc"), "author", "submission_id", "parent_id")
    return records.project_comments(raw).withColumn("created_utc", dates.format_iso(F.col("created_utc")))


@query
def strip_html(spark, d):
    pages = v.texts(spark, d, "pages")
    return pages.select("page_id", cl.strip_html(F.col("html")).alias("text"))


def _text_step(name, fn):
    def run(spark, d):
        docs = v.texts(spark, d, "documents")
        return docs.select("doc_id", fn(noisy("text")).alias("text"))
    run.__name__ = name
    return query(run)


_text_step("remove_urls", cl.remove_urls)
_text_step("remove_emojis", cl.remove_emojis)
_text_step("remove_hashtags", cl.remove_hashtags)
_text_step("remove_mentions", cl.remove_mentions)
_text_step("lowercase_text", F.lower)
_text_step("collapse_whitespace", cl.collapse_whitespace)


@query
def nfkc_fullwidth(spark, d):
    """The chain's own step, over full-width letters, ligatures, fractions and circled digits."""
    docs = v.texts(spark, d, "documents")
    texts = F.array(F.concat(noisy("text"), F.lit(v.FORMS)))
    forms = docs.select("doc_id", texts.alias("t"), cl.nfkc_of(cl.nfkc_exposed(texts)).alias("n"))
    return forms.select("doc_id", F.coalesce(F.get("n", F.lit(0)), F.get("t", F.lit(0))).alias("text"))


@query
def clean_text_full(spark, d):
    docs = v.texts(spark, d, "documents").select("doc_id", noisy("text").alias("text"))
    return oc.clean(docs, ["text"])


@query
def clean_posts(spark, d):
    p = v.posts(spark, d, v.texts).select("id", "title", noisy("text").alias("text"))
    return oc.clean_batch(p, "submission")


@query
def clean_comments(spark, d):
    c = v.comments(spark, d, v.texts).select("id", noisy("text").alias("text"))
    return oc.clean_batch(c, "comment")


@query
def empty_text_guard(spark, d):
    docs = v.texts(spark, d, "documents")
    text = F.when(F.col("lang") == "en", F.col("text")).when(F.col("lang") == "de", F.lit(""))
    df = oc.clean(docs.select(F.col("doc_id").cast("string").alias("id"), text.alias("text")), ["text"])
    scored = orl.score_rules(df, {"score": "text"}, v.LEXICON)
    return scored.select("id", "text", *rounded("score"))


# --- normalisation ----------------------------------------------------------

def _with_contractions(spark, d):
    docs = v.texts(spark, d, "documents")
    return docs.select("doc_id", F.concat("text", F.lit(v.CONTRACTIONS)).alias("text"))


@query
def tokenize(spark, d):
    t = tk.tokenize(F.col("text"))
    return _with_contractions(spark, d).select(
        "doc_id", F.size(t).cast("long").alias("n_tokens"), tk.join_tokens(t).alias("tokens"))


@query
def remove_stopwords(spark, d):
    t = tk.remove_stopwords(tk.tokenize(F.col("text")), v.STOPWORDS, keep=())
    return _with_contractions(spark, d).select("doc_id", tk.join_tokens(t).alias("tokens"))


@query
def keep_important_stopwords(spark, d):
    t = tk.remove_stopwords(tk.tokenize(F.col("text")), v.STOPWORDS)
    return _with_contractions(spark, d).select("doc_id", tk.join_tokens(t).alias("tokens"))


@query
def lemmatize_tokens(spark, d):
    lookup = inline_lookup(tk.STARTER_LEMMAS, "string")
    t = tk.lemmatize(tk.tokenize(F.col("text")), lookup)
    return _with_contractions(spark, d).select("doc_id", tk.join_tokens(t).alias("lemmas"))


def _words(spark, d):
    """Words of all documents as they are written, so many occur in two spellings."""
    w = v.texts(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("w"))
    return w.filter(F.length("w") >= 2).distinct()


@query
def lemmatize_table(spark, d):
    """Lemmas from a table with an entry for every second word of the documents."""
    w = _words(spark, d).filter((F.ascii("w") + F.length("w")) % 2 == 0)
    lemmas = w.select(F.col("w").alias("token"), F.concat(F.substring("w", 1, 3), F.length("w").cast("string")).alias("lemma"))
    return on.normalize(_with_contractions(spark, d), ["text"], lemmas=lemmas).select("doc_id", F.col("text_normalized").alias("lemmas"))


@query
def normalize_nolemma(spark, d):
    df = _with_contractions(spark, d)
    return on.normalize(df, ["text"], lemma="none").select("doc_id", "text_normalized")


@query
def normalize_posts(spark, d):
    p = v.posts(spark, d, v.texts).select("id", "title", "text")
    return on.normalize_batch(p, "submission")


@query
def normalize_comments(spark, d):
    c = v.comments(spark, d, v.texts).select("id", "text")
    return on.normalize_batch(c, "comment")


# --- rule scores ------------------------------------------------------------

@query
def lexicon_score(spark, d):
    scored = orl.score_rules(toned(spark, d), {"score": "text"}, v.LEXICON)
    return scored.select("id", *rounded("score"))


@query
def lexicon_score_table(spark, d):
    """Scores by a lexicon table with an entry for every second word of the documents."""
    w = _words(spark, d).filter((F.ascii("w") + F.length("w")) % 2 == 1)
    valence = ((F.ascii("w") * 7 + F.length("w")) % 9 - 4).cast("double") / 2
    scored = orl.score_rules(toned(spark, d), {"score": "text"}, w.select(F.col("w").alias("token"), valence.alias("valence")))
    return scored.select("id", *rounded("score"))


@query
def lexicon_score_phrases(spark, d):
    """Scores by a lexicon table that holds the two to four words from every third word of the benchmark texts on."""
    words = v.table(spark, d, "benchmark").select(F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w"))
    starts = words.select("w", F.posexplode("w").alias("at", "first")).filter("at % 3 = 0")
    runs = starts.select(F.explode(F.array(*[F.array_join(F.slice("w", F.col("at") + 1, F.lit(n)), " ") for n in (2, 3, 4)])).alias("token"))
    several = runs.select("token", ((F.length("token") * 7 % 9 - 4).cast("double") / 2).alias("valence")).filter("token like '% %'")
    table = several.unionByName(spark.createDataFrame(list(v.LEXICON.items()), "token string, valence double"))
    return orl.score_rules(toned(spark, d), {"score": "text"}, table).select("id", *rounded("score"))


@query
def token_context(spark, d):
    c = v.comments(spark, d, v.texts)
    return (c.select("id", F.explode(lx.token_context(lx.rule_tokens(F.col("text")))).alias("t"))
            .select("id", F.col("t.pos").cast("long").alias("pos"), "t.token", "t.prev1", "t.prev2", "t.prev3"))


@query
def negation_flip(spark, d):
    """What the three words before each lexicon word do to its sign."""
    c = toned(spark, d).select("id", F.transform(lx.rule_tokens(F.col("text")), F.lower).alias("w"))
    lookup = inline_lookup(v.LEXICON, "double")
    factor = F.lit(1.0)
    for k in (1, 2, 3):
        one = F.when(F.col("pos") >= k, lx.negation_factor(F.col("w"), F.col("pos"), F.lit(k)))
        factor = factor * F.coalesce(one, F.lit(1.0))
    hits = c.select("id", "w", F.posexplode("w").alias("pos", "token")).filter(lookup(F.col("token")).isNotNull())
    return (hits.select("id", factor.alias("factor")).groupBy("id")
            .agg(F.count(F.lit(1)).alias("hits"), F.count_if(F.col("factor") < 0).alias("flipped"),
                 F.round(F.sum("factor"), 6).alias("factors")))


@query
def but_reweight(spark, d):
    t = toned(spark, d).select("id", lx.rule_tokens(F.col("text")).alias("w"))
    lookup = inline_lookup(v.LEXICON, "double")
    known = F.transform("w", lambda x, i: F.struct(i.alias("pos"), lookup(F.lower(x)).alias("valence")))
    hits = F.filter(known, lambda hit: hit["valence"].isNotNull())
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, hit: acc + hit["valence"])
    return t.select("id", F.round(add(hits), 6).alias("plain"),
                    F.round(add(lx.contrast(hits, F.col("w"))), 6).alias("weighed"))


@query
def emphasis_features(spark, d):
    t = toned(spark, d).withColumn("w", lx.rule_tokens(F.col("text")))
    return t.select("id", F.round(lx.exclamation_emphasis(F.col("text")), 6).alias("exclamation"),
                    F.round(lx.question_emphasis(F.col("text")), 6).alias("question"),
                    F.size(F.filter("w", lx.is_upper)).cast("long").alias("capitals"),
                    lx.mixed_case(F.col("w")).alias("mixed"))


@query
def classify_compound(spark, d):
    e = v.table(spark, d, "events")
    compound = F.round(F.col("value") / 100 - 0.15, 6)
    return e.select("event_id", compound.alias("compound"), lx.classify(compound).alias("sentiment"))


def _scored_posts(spark, d):
    return orl.score_rules_batch(v.posts(spark, d, v.texts), "submission", lexicon=v.LEXICON, run_ts=v.RUN_TS)


@query
def score_posts_rules(spark, d):
    s = _scored_posts(spark, d)
    return s.select("id", F.round("title_sentiment.compound", 6).alias("title_compound"),
                    F.round("text_sentiment.compound", 6).alias("text_compound"),
                    *rounded("overall_sentiment"))


@query
def overall_sentiment(spark, d):
    return _scored_posts(spark, d).select("id", *rounded("overall_sentiment"))


@query
def score_comments_rules(spark, d):
    s = orl.score_rules_batch(v.comments(spark, d, v.texts), "comment", lexicon=v.LEXICON, run_ts=v.RUN_TS)
    return s.select("id", *rounded("sentiment"))


@query
def score_raw_vs_normalized(spark, d):
    n = on.normalize_batch(toned(spark, d), "comment")
    both = orl.score_rules(n, {"raw": orl.source_column(n, "text", False),
                               "norm": orl.source_column(n, "text", True)}, v.LEXICON)
    return both.select("id", F.round("raw.compound", 6).alias("raw_compound"),
                       F.round("norm.compound", 6).alias("normalized_compound"))


@query
def analysis_metadata(spark, d):
    s = _scored_posts(spark, d)
    m = "sentiment_analysis"
    return s.select("id", F.col(f"{m}.method").alias("method"), F.col(f"{m}.model").alias("model"),
                    dates.format_iso(F.col(f"{m}.timestamp")).alias("analyzed_at"),
                    F.col(f"{m}.used_normalized_text").alias("used_normalized_text"))


@query
def score_json(spark, d):
    s = orl.score_rules_batch(v.comments(spark, d, v.texts), "comment", lexicon=v.LEXICON, run_ts=v.RUN_TS)
    back = F.from_json(F.to_json("sentiment"), s.schema["sentiment"].dataType)
    return (s.select("id", back.alias("back"), F.get_json_object(F.to_json("sentiment"), "$.sentiment").alias("label"))
            .select("id", "label", F.round("back.compound", 6).alias("compound")))


# --- model scores -----------------------------------------------------------

def _logits(spark, d):
    e = v.table(spark, d, "embeddings")
    part = lambda start, size: F.round(F.aggregate(
        F.slice("embedding", start, size), F.lit(0.0), lambda acc, x: acc + x.cast("double")), 6)
    return e.select(F.col("vec_id"), F.array(part(1, 21), part(22, 21), part(43, 22)).alias("logits"))


@query
def softmax_scores(spark, d):
    s = _logits(spark, d).withColumn("score", pb.model_score(F.col("logits")))
    return s.select("vec_id", *rounded("score"))


@query
def truncate_tokens(spark, d):
    docs = v.texts(spark, d, "documents")
    return docs.select("doc_id", tk.truncate_tokens(F.col("text"), 512).alias("text"))


@query
def score_model_batch(spark, d):
    docs = v.texts(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    s = om.score_model(docs, {"score": "text"}, v.letter_scorer, batch_size=64, max_length=None)
    return s.select("id", *rounded("score"))


def _modelled_posts(spark, d):
    return om.score_model_batch(v.posts(spark, d, v.texts), "submission", v.letter_scorer, batch_size=64,
                                max_length=None, model_name="letters", run_ts=v.RUN_TS)


@query
def score_posts_model(spark, d):
    s = _modelled_posts(spark, d)
    return s.select("id", F.round("title_sentiment.compound", 6).alias("title_compound"),
                    F.round("text_sentiment.compound", 6).alias("text_compound"),
                    *rounded("overall_sentiment"))


@query
def overall_sentiment_model(spark, d):
    return _modelled_posts(spark, d).select("id", *rounded("overall_sentiment"))


@query
def score_comments_model(spark, d):
    s = om.score_model_batch(v.comments(spark, d, v.texts), "comment", v.letter_scorer, batch_size=64,
                             max_length=None, model_name="letters", run_ts=v.RUN_TS)
    return s.select("id", *rounded("sentiment"))


# --- comparison -------------------------------------------------------------

def _comparison(spark, d):
    rules_p = _scored_posts(spark, d)
    model_p = _modelled_posts(spark, d)
    rules_c = orl.score_rules_batch(v.comments(spark, d, v.texts), "comment", lexicon=v.LEXICON, run_ts=v.RUN_TS)
    model_c = om.score_model_batch(v.comments(spark, d, v.texts), "comment", v.letter_scorer, batch_size=64,
                                   max_length=None, model_name="letters", run_ts=v.RUN_TS)
    return cmp.compare(rules_p, model_p, "submission").unionByName(cmp.compare(rules_c, model_c, "comment"))


@query
def compare_models(spark, d):
    return _comparison(spark, d).withColumns({
        "vader_compound": F.round("vader_compound", 6),
        "transformer_compound": F.round("transformer_compound", 6)})


@query
def disagreements(spark, d):
    return cmp.disagreements(_scored_twice(spark, d)).select(
        "content_type", "id", "vader_sentiment", "transformer_sentiment")


@query
def disagreements_top5(spark, d):
    return cmp.disagreements(_scored_twice(spark, d), 5)


def _scored_twice(spark, d):
    """Both results in one row, no join."""
    opts = dict(lexicon=v.LEXICON, max_length=None, batch_size=64, run_ts=v.RUN_TS)
    p = score_items(v.posts(spark, d, v.texts), "submission", v.letter_scorer, **opts)
    c = score_items(v.comments(spark, d, v.texts), "comment", v.letter_scorer, **opts)
    return cmp.compare_scored(p, "submission").unionByName(cmp.compare_scored(c, "comment"))


@query
def agreement_rate(spark, d):
    """Rule scores of the cleaned texts against the human quality labels."""
    docs = v.texts(spark, d, "documents").select("doc_id", F.concat("text", F.lit(v.NOISE_TAIL)).alias("text"))
    labels = v.table(spark, d, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("label"))
    cleaned = oc.clean(docs.join(labels, "doc_id"), ["text"])
    scored = orl.score_rules(cleaned, {"score": "text"}, v.LEXICON)
    return cmp.agreement_summary(scored.select((F.col("score.sentiment") == F.col("label")).alias("agreement")))


@query
def run_metadata_counts(spark, d):
    m = run_metadata(KEYWORDS, GROUPS, v.posts(spark, d), v.comments(spark, d), v.RUN_TS)
    return m.select(F.array_join("keywords", "|").alias("keywords"), F.array_join("subreddits", "|").alias("subreddits"),
                    dates.format_iso(F.col("timestamp")).alias("run_at"), "submission_count", "comment_count")


REGISTRY["run_metadata"] = REGISTRY.pop("run_metadata_counts")


@query
def analyze_topic_comparison(spark, d):
    """The flagship: search with a budget, first comments, both scores, comparison."""
    return topic(spark, d).comparison().withColumns({
        "vader_compound": F.round("vader_compound", 6),
        "transformer_compound": F.round("transformer_compound", 6)})


def topic(spark, d):
    return analyze_topic(
        v.posts(spark, d, v.texts), v.comments(spark, d, v.texts), KEYWORDS, GROUPS, v.letter_scorer, limit=BUDGET,
        comment_limit=4, time_filter="week", sort="top", as_of=v.POSTS_AS_OF, run_ts=v.RUN_TS,
        search_options={"weights": WEIGHTS, "limits": LIMITS}, lexicon=v.LEXICON, max_length=None,
        batch_size=64)


REGISTRY["analyze_topic"] = REGISTRY.pop("analyze_topic_comparison")


# --- dates ------------------------------------------------------------------

@query
def parse_iso(spark, d):
    e = v.table(spark, d, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (F.when(F.col("event_type") == "click", F.concat(iso, F.lit("Z")))
             .when(F.col("event_type") == "view", F.concat(iso, F.lit("+02:00")))
             .when(F.col("event_type") == "error", F.lit("not a time")).otherwise(iso))
    return e.select("event_id", F.unix_timestamp(dates.parse_iso(text)).alias("epoch"))


@query
def format_iso(spark, d):
    e = v.table(spark, d, "events")
    return e.select("event_id", dates.format_iso(F.col("ts").cast("timestamp")).alias("iso"))


@query
def batch_id_format(spark, d):
    e = v.table(spark, d, "events")
    return e.select("event_id", dates.batch_id(F.col("ts")).alias("batch_id"))


# --- storage ----------------------------------------------------------------

@query
def post_by_id(spark, d):
    return tables.by_id(v.posts(spark, d, replies=True), "7").select(*POSTS_RAW.fieldNames())


def _label_changes(spark, d):
    """Partial rows: new scores for labelled posts, an unknown one where toxic, and
    one new post per conversation."""
    labels = v.table(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("toxic") == 0, F.col("quality") * 1000).cast("long").alias("score"))
    threads = v.comments(spark, d).filter("is_root").select(
        F.concat(F.lit("c"), "submission_id").alias("id"), "score")
    return labels.unionByName(threads)


@query
def upsert_posts(spark, d):
    base = v.posts(spark, d, replies=True).drop("lang")
    changed = up.upsert(base, _label_changes(spark, d), strategy="shuffle")
    return changed


@query
def upsert_partial_columns(spark, d):
    base = v.posts(spark, d).drop("lang")
    return up.upsert(base, _label_changes(spark, d)).select("id", "title", "score", "author", "subreddit")


@query
def upsert_last_wins(spark, d):
    base = v.posts(spark, d).select("id", "text", "author")
    turns = v.table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), "text", F.col("role").alias("author"), "turn")
    return up.upsert(base, turns, seq="turn")


@query
def upsert_duplicates(spark, d):
    """A batch with many rows a key and no sequence: the greatest row is kept."""
    base = v.posts(spark, d).select("id", "text", "author")
    turns = v.table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), "text", F.col("role").alias("author"))
    return up.upsert(base, turns)


@query
def upsert_defaults(spark, d):
    """New rows take the defaults of the columns that the batch lacks."""
    done = F.col("lang") == "en"
    base = v.posts(spark, d).select("id", "score", done.alias("cleaned"), (~done).alias("processed"))
    return up.upsert(base, _label_changes(spark, d))


def _comment_edits(spark, d):
    return v.comments(spark, d).filter(F.col("author") == "assistant").select(
        "id", F.concat("text", F.lit(" [edited]")).alias("text"), "submission_id",
        (F.col("score") + 1).alias("score"))


@query
def upsert_comments(spark, d):
    english = v.posts(spark, d).filter(F.col("lang") == "en")
    edits = up.accepted_comments(_comment_edits(spark, d), english)
    return up.upsert(v.comments(spark, d), edits)


@query
def fk_accept(spark, d):
    english = v.posts(spark, d).filter(F.col("lang") == "en").select("id")
    return up.accepted_comments(v.comments(spark, d), english).select("id", "submission_id")


@query
def fk_reject(spark, d):
    english = v.posts(spark, d).filter(F.col("lang") == "en").select("id")
    return up.rejected_comments(v.comments(spark, d), english).select("id", "submission_id")


@query
def store_batch_counts(spark, d):
    english = v.posts(spark, d).filter(F.col("lang") == "en").select("id")
    items = v.comments(spark, d).withColumn(
        "id", F.when(F.col("score") != 7, F.col("id")))
    return up.outcome_counts(up.check_reference(items, english))


@query
def ingest_counts(spark, d):
    p, c = v.posts(spark, d, v.texts, replies=True), v.comments(spark, d, v.texts)
    raw = p.select(*POSTS_RAW.fieldNames())
    stored_p = raw.withColumns({"processed": F.lit(False), "processed_at": F.lit(None).cast("timestamp")})
    stored_c = c.withColumns({"processed": F.lit(False), "processed_at": F.lit(None).cast("timestamp")})
    return ingest(raw, c, stored_p, stored_c, KEYWORDS, ["src0", "src1", "src2"], limit=40,
                  time_filter="month", comment_limit=3, as_of=v.POSTS_AS_OF, sort="comments").counts


@query
def storage_rows(spark, d):
    opts = dict(lexicon=v.LEXICON, max_length=None, batch_size=64, run_ts=v.RUN_TS)
    p = v.posts(spark, d, v.texts).withColumn("text", noisy("text"))
    s = tables.to_storage(score_items(p, "submission", v.letter_scorer, **opts), "submission")
    return s.select("id", "title", "text", "title_cleaned", "text_cleaned", "title_normalized", "text_normalized",
                    "cleaned", F.round("vader_compound", 6).alias("vader_compound"),
                    F.col("vader_sentiment.sentiment").alias("vader_label"),
                    F.round("transformer_compound", 6).alias("transformer_compound"),
                    F.col("transformer_sentiment.sentiment").alias("transformer_label"))


@query
def shard_key(spark, d):
    c = v.comments(spark, d)
    return c.withColumns(csvstore.shard_columns(F.col("id"))).select("id", "s1", "s2")


def _csv_posts(spark, d):
    quoted = F.concat(F.lit('He said "hi",\r\n'), F.col("text"), F.lit(' , \\" end '))
    return v.posts(spark, d).select("id", "title", quoted.alias("text"), "score", "created_utc", "upvote_ratio",
                                    F.when(F.col("lang") == "en", F.col("author")).alias("author"))


@query
def csv_roundtrip(spark, d):
    p = _csv_posts(spark, d)
    store = csvstore.CsvStore(spark, scratch_path(spark, "csv"))
    done = store.store_batch(p, "submission", "batch_1")
    return store.retrieve_batch(done["path"], p.schema)


@query
def csv_latest_items(spark, d):
    """Two versions of some items; the later one is read."""
    c = v.comments(spark, d).select("id", "text", "score")
    store = csvstore.CsvStore(spark, scratch_path(spark, "versions"))
    store.store_items(c, "comment", "2024-02-01T00:00:00")
    store.store_items(c.filter("score < 25").withColumn("score", F.col("score") + 100), "comment", "2024-02-02T00:00:00")
    return store.latest_items("comment", c.schema).select("id", "text", "score")


@query
def csv_compacted(spark, d):
    """Two versions of some items, compacted, and a third one of a few after that."""
    c = v.comments(spark, d).select("id", "text", "score")
    store = csvstore.CsvStore(spark, scratch_path(spark, "compacted"))
    store.store_items(c, "comment", "2024-02-01T00:00:00")
    store.store_items(c.filter("score < 25").withColumn("score", F.col("score") + 100), "comment", "2024-02-02T00:00:00")
    store.compact("comment", c.schema)
    store.store_items(c.filter("score < 5").withColumn("score", F.col("score") + 200), "comment", "2024-02-03T00:00:00")
    stored = store.read_items("comment", c.schema).groupBy("id").agg(F.count(F.lit(1)).alias("versions"))
    return store.latest_items("comment", c.schema).select("id", "text", "score").join(stored, "id")


@query
def topic_files(spark, d):
    """The topic analysis written as JSON lines and CSV, and read from there."""
    path = scratch_path(spark, "topic")
    topic(spark, d).write(path)
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{path}/comparison")
    posts = spark.read.json(f"{path}/submissions").select(F.lit("submission").alias("content_type"), "id", "subreddit")
    return (rows.select("content_type", "id", "vader_sentiment", "transformer_sentiment", F.col("agreement").cast("boolean").alias("agreement"))
            .join(posts, ["content_type", "id"], "left"))


@query
def csv_item_lookup(spark, d):
    c = v.comments(spark, d)
    store = csvstore.CsvStore(spark, scratch_path(spark, "items"))
    store.store_items(c, "comment", v.RUN_TS)
    found = store.retrieve_item("10_1", "comment", c.schema)
    return found.select("id", "submission_id", "text", "score", "created_utc", "parent_id", "is_root", "item_type")
