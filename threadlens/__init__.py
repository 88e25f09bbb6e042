"""threadlens: discussion analytics (posts and threaded comments) on Spark DataFrames."""

from threadlens.functions.cleaning import CleanOptions
from threadlens.operators.clean import clean, clean_batch
from threadlens.operators.compare import agreement_summary, compare, compare_scored, disagreements
from threadlens.operators.model import score_model, score_model_batch
from threadlens.operators.normalize import normalize, normalize_batch
from threadlens.operators.quota import allocate_budget
from threadlens.operators.rules import score_rules, score_rules_batch
from threadlens.operators.search import keyword_search
from threadlens.operators.threads import comment_depth, comments_of_post, top_comments_per_post
from threadlens.plans.ingest import ingest
from threadlens.plans.topic import analyze_topic
from threadlens.sources.csvstore import CsvStore
from threadlens.sources.upsert import store_batch, upsert

__all__ = [
    "CleanOptions", "CsvStore", "agreement_summary", "allocate_budget", "analyze_topic",
    "clean", "clean_batch", "comment_depth", "comments_of_post", "compare",
    "compare_scored", "disagreements", "ingest", "keyword_search", "normalize",
    "normalize_batch", "score_model", "score_model_batch", "score_rules",
    "score_rules_batch", "store_batch", "top_comments_per_post", "upsert",
]
