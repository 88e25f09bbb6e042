"""DuckDB SQL for every query that SQL can express."""

from __future__ import annotations

from catalog import queries as sq
from catalog import sql as s
from catalog import views as v
from threadlens.functions import lexicon as lx
from threadlens.functions.tokens import PLAIN_TOKEN

P, C = s.POSTS, s.COMMENTS
ALL_POST_COLUMNS = "id, title, text, score, created_utc, author, num_comments, url, subreddit, upvote_ratio"


def _phrases(words) -> str:
    body = "|".join(r"\s+".join(w.split()) for w in words)
    return s.q(rf"(?i)(^|{s.EDGE})(?:{body})($|{s.EDGE})")


def _matched(words) -> str:
    p = _phrases(words)
    return f"(regexp_matches(title, {p}) OR regexp_matches(text, {p}))"


def _hits(words) -> str:
    one = lambda c: (f"len(list_filter(regexp_extract_all(lower({c}), {s.q(PLAIN_TOKEN)}), "
                     f"lambda t: t IN {s.listed(words)}))")
    return f"CAST({one('title')} + {one('text')} AS INTEGER)"


# Phrases of the benchmark texts met with all windows of as many tokens (blanks are tokens as
# well, so two words are three); of finds that overlap the first counts.
_MOST = 20
_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"
_sides = ", ".join(f"lead(t, {k}) OVER w AS t{k}" for k in range(1, _MOST + 1))
_windows = "\n  UNION ALL ".join(f"SELECT id, side, i, {m} AS m, before, concat({', '.join(f't{k}' for k in range(m))}) AS phrase, t{m} AS after "
                                 f"FROM starts WHERE t{m} IS NOT NULL" for m in range(3, _MOST + 1))
PHRASES = rf"""phrases AS (
  SELECT DISTINCT lower(array_to_string(w[i:i + n - 1], ' ')) AS phrase
  FROM (SELECT list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM benchmark),
       (SELECT unnest(range(1, 400)) AS i), (SELECT unnest([2, 3, 4, 5]) AS n) WHERE i + n - 1 <= len(w)),
toks AS (
  SELECT id, side, unnest(w) AS t, unnest(range(len(w))) AS i FROM (
    SELECT id, side, regexp_extract_all(concat(' ', lower(regexp_replace(t, '\s+', ' ', 'g')), ' '), '{_TOKEN}') AS w
    FROM (SELECT id, 0 AS side, title AS t FROM posts UNION ALL SELECT id, 1, text FROM posts))),
starts AS MATERIALIZED (
  SELECT * FROM (SELECT id, side, i, lag(t) OVER w AS before, t AS t0, {_sides} FROM toks WINDOW w AS (PARTITION BY id, side ORDER BY i))
  WHERE concat(t0, t1, t2) IN (SELECT array_to_string(regexp_extract_all(phrase, '{_TOKEN}')[1:3], '') FROM phrases)),
finds AS (
  SELECT id, side, phrase, i, m FROM ({_windows}) JOIN phrases USING (phrase)
  WHERE NOT regexp_matches(concat(right(before, 1), left(phrase, 1)), '^[\p{{L}}\p{{N}}_][^\p{{L}}\p{{N}}_]')
    AND NOT regexp_matches(concat(right(phrase, 1), left(after, 1)), '^[^\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_]')),
hits AS (
  SELECT id, phrase, sum(n) AS n FROM (
    SELECT id, side, phrase, list_reduce(list_prepend({{'n': 0, 'stop': 0, 'at': 0}}, list({{'n': 0, 'stop': 0, 'at': CAST(i AS INTEGER)}} ORDER BY i)),
             lambda a, x: CASE WHEN x.at >= a.stop THEN {{'n': a.n + 1, 'stop': CAST(x.at + m AS INTEGER), 'at': 0}} ELSE a END).n AS n
    FROM finds GROUP BY id, side, phrase, m) GROUP BY id, phrase)"""


def _week(as_of: str, span: str = "7 days") -> str:
    return f"created_utc >= TIMESTAMP '{as_of}' - INTERVAL '{span}'"


def _sort(key: str, shown: str | None = None) -> str:
    return (f"WITH {P} SELECT row_number() OVER (ORDER BY k DESC NULLS LAST, id) AS place, id, "
            f"{shown or 'k'} AS sort_key FROM (SELECT id, {key} AS k FROM posts ORDER BY k DESC NULLS LAST, id LIMIT 100)")


def _quotas() -> str:
    shares = {"src0": 5, "src1": 3, "src2": 2, "src3": 2, "src4": 1, "src5": 1}
    limits = {"src0": (3, 12), "src1": (2, 40), "src4": (0, sq.BUDGET)}
    rows = ", ".join(f"('{g}', {w}, {limits.get(g, (1, sq.BUDGET))[0]}, {limits.get(g, (1, sq.BUDGET))[1]})"
                     for g, w in shares.items())
    return f"quotas(grp, weight, mn, mx) AS (VALUES {rows})"


def _allocation(total: int, available: str = "available") -> str:
    """Base, extra and take per group from ``available(grp, n)`` and ``quotas``."""
    return f"""alloc1 AS (
  SELECT grp, n, weight, mn, mx, least(mn, n) AS base FROM {available} JOIN quotas USING (grp)),
alloc2 AS (
  SELECT *, {total} - (SELECT sum(base) FROM alloc1) AS rest,
         (SELECT sum(weight) FROM alloc1 WHERE n > base) AS weights FROM alloc1),
alloc AS (
  SELECT grp, n, base, CASE WHEN rest > 0 AND n > base THEN greatest(0, least(
           CASE WHEN coalesce(mx, 0) <> 0 THEN mx - base ELSE n END,
           CAST(round_even(CAST(rest * weight AS DOUBLE) / weights, 0) AS BIGINT), n - base)) ELSE 0 END AS extra
  FROM alloc2)"""


def _search(groups, quotas: str, total: int, order: str, window: str) -> str:
    return f"""{quotas},
hits AS (
  SELECT p.*, lower(subreddit) AS grp, row_number() OVER (PARTITION BY lower(subreddit) ORDER BY {order} DESC, id) AS rank
  FROM posts p WHERE lower(subreddit) IN {s.listed(groups)} AND {window} AND {_matched(sq.KEYWORDS)}),
best AS (
  SELECT h.* FROM hits h JOIN (
    SELECT grp, least(mx, greatest(mn, 1, CAST(round_even(CAST({total} * weight AS DOUBLE)
             / (SELECT sum(weight) FROM quotas), 0) AS BIGINT))) AS initial FROM quotas) i USING (grp)
  WHERE h.rank <= i.initial),
available AS (SELECT grp, count(*) AS n FROM best GROUP BY grp),
{_allocation(total)},
found AS (
  SELECT b.*, CAST(b.rank > a.base AS BIGINT) AS phase FROM best b JOIN alloc a USING (grp)
  WHERE b.rank <= a.base + a.extra)"""


SEARCH = _search(["src0", "src1", "src2", "src3", "src4", "src5"], _quotas(), sq.BUDGET, "score",
                 _week(v.POSTS_AS_OF))

EVENT_QUOTAS = """quotas AS (
  SELECT event_type AS grp, count(*) FILTER (value > 20) AS weight, count(*) FILTER (value < 1) AS mn0,
         CASE WHEN length(event_type) > 5 THEN count(*) FILTER (value > 10) END AS mx0,
         count(*) FILTER (value < 1) AS mn, least(coalesce(CASE WHEN length(event_type) > 5
           THEN count(*) FILTER (value > 10) END, 2000), 2000) AS mx
  FROM events GROUP BY event_type)"""

TONED = f"docs AS (SELECT CAST(doc_id AS VARCHAR) AS id, concat(text, {s.q(v.TONE)}) AS text FROM documents)"
CONTRACTED = f"docs AS (SELECT doc_id, concat(text, {s.q(v.CONTRACTIONS)}) AS text FROM documents)"


def _step(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS text FROM documents"


def _ranked_comments(n: int, scope: str) -> str:
    return f"""{s.DEPTH},
ranked AS (
  SELECT c.*, d.depth, row_number() OVER (PARTITION BY c.submission_id ORDER BY d.depth, c.created_utc, c.id) AS rank
  FROM comments c JOIN depths d USING (id) WHERE c.submission_id IN ({scope})),
replies AS (SELECT * FROM ranked WHERE rank <= {n})"""


def _posts_rules(source: str, title: str = "title", text: str = "text") -> str:
    return ",\n".join([s.rule_scores("rt", source, title), s.rule_scores("rx", source, text),
                       s.overall("ro", "rt", "rx", True)])


def _posts_model(source: str, title: str = "title", text: str = "text") -> str:
    return ",\n".join([s.model_scores("mt", source, s.letters(title)), s.model_scores("mx", source, s.letters(text)),
                       s.overall("mo", "mt", "mx", False)])


def _compared(posts: str, comments: str) -> str:
    """Comparison rows from rule results ro/rc and model results mo/mc."""
    side = ("v.sentiment AS vader_sentiment, v.compound AS vader_compound, m.sentiment AS transformer_sentiment, "
            "m.compound AS transformer_compound, v.sentiment = m.sentiment AS agreement")
    return f"""compared AS (
  SELECT 'submission' AS content_type, i.id, concat(i.title, ' ', i.text) AS text, {side}
  FROM {posts} i JOIN ro v USING (id) JOIN mo m USING (id)
  UNION ALL
  SELECT 'comment', i.id, i.text, {side} FROM {comments} i JOIN rc v USING (id) JOIN mc m USING (id))"""


COMPARED_COLUMNS = ("content_type, id, text, vader_sentiment, round(vader_compound, 6) AS vader_compound, "
                    "transformer_sentiment, round(transformer_compound, 6) AS transformer_compound, agreement")


def _flow(posts: str, comments: str, text: str = "text") -> str:
    """Clean, normalise and score both tables as the analysis does."""
    return ",\n".join([
        f"""cp AS MATERIALIZED (SELECT id, title, text, {s.normalized('title')} AS tn, {s.normalized('text')} AS xn
  FROM (SELECT id, {s.cleaned('title')} AS title, {s.cleaned(text)} AS text FROM {posts}))""",
        f"""cc AS MATERIALIZED (SELECT id, text, {s.normalized('text')} AS xn
  FROM (SELECT id, {s.cleaned('text')} AS text FROM {comments}))""",
        _posts_rules("cp", "tn", "xn"), s.rule_scores("rc", "cc", "xn"),
        _posts_model("cp", "tn", "xn"), s.model_scores("mc", "cc", s.letters("xn"))])


def _score_select(source: str) -> str:
    return f"SELECT id, {s.rounded()}, sentiment FROM {source}"


def _pages_text() -> str:
    c = "regexp_replace(html, '(&#?[a-zA-Z0-9][-.a-zA-Z0-9]*)<', '\\1;<', 'g')"
    for tag in ("script", "style", "template"):
        c = s.replaced(c, rf"(?is)<{tag}(?:[\s/][^>]*)?>.*?(?:</{tag}\s*>|\z)")
    c = s.replaced(c, r"(?s)<!--.*?(?:-->|\z)")
    c = s.replaced(c, r"<[!?][^>]*>")
    c = s.replaced(c, r"</?[a-zA-Z][^>]*>")
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", " ")):
        c = f"replace({c}, '&{name};', {s.q(char)})"
    unknown = f"regexp_replace(replace({c}, '&amp;', chr(1)), '(&[a-zA-Z][-.a-zA-Z0-9]*);', '\\1', 'g')"
    return f"replace({unknown}, chr(1), '&')"


def statements() -> dict[str, str]:
    dropped = lambda keep: s.joined(s.without_stopwords(s.tokens("text"), keep))
    neg = " * ".join(f"({s.factor(k)})" for k in (1, 2, 3))
    before = f"TIMESTAMP '{v.EVENTS_AS_OF}' - INTERVAL '7 days'"
    changes = """changes AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, CAST(CASE WHEN toxic = 0 THEN quality * 1000 END AS BIGINT) AS score FROM labels
  UNION ALL SELECT concat('c', submission_id), score FROM comments WHERE is_root)"""
    others = [c.strip() for c in ALL_POST_COLUMNS.split(",") if c.strip() not in ("id", "score")]
    upserted = f"""upserted AS (
  SELECT coalesce(b.id, i.id) AS id, CASE WHEN i.id IS NOT NULL THEN i.score ELSE b.score END AS score,
         {', '.join('b.' + c for c in others)}
  FROM posts b FULL OUTER JOIN changes i ON b.id = i.id)"""
    english = "(SELECT id FROM posts WHERE lang = 'en')"
    out: dict[str, str] = {}

    out["keyword_match"] = f"WITH {P} SELECT id, {_matched(sq.KEYWORDS)} AS matched FROM posts"
    out["keyword_match_table"] = f"""WITH {P}, {PHRASES}
      SELECT p.id, count(phrase) AS n_phrases, md5(coalesce(string_agg(phrase, '|' ORDER BY phrase), '')) AS phrases_md5
      FROM posts p LEFT JOIN hits USING (id) GROUP BY p.id"""
    out["keyword_search_table"] = f"""WITH {P}, {PHRASES}
      SELECT id, any_value(subreddit) AS subreddit, CAST(sum(n) AS BIGINT) AS occurrences FROM posts JOIN hits USING (id)
      WHERE {_week(v.POSTS_AS_OF)} GROUP BY id ORDER BY occurrences DESC, id LIMIT 30"""
    out["extract_keywords"] = "SELECT doc_id, concat(source, '|', lang, ' x|solo') AS keywords FROM documents"
    out["group_scope"] = (f"WITH {P} SELECT id, subreddit FROM posts WHERE subreddit IN "
                          "('src0','src1','src2','src3','src4','src5')")
    out["time_filter_week"] = (f"SELECT CAST(event_id AS VARCHAR) AS id, event_type AS subreddit, ts AS created_utc "
                               f"FROM events WHERE ts >= {before}")
    out["sort_relevance"] = _sort(_hits(sq.RELEVANCE_WORDS))
    out["sort_hot"] = _sort("CAST(sign(score) AS DOUBLE) * log10(CAST(greatest(abs(score), 1) AS DOUBLE)) "
                            "+ epoch(created_utc) / 45000.0::DOUBLE", "round(k, 6)")
    out["sort_top"] = _sort("score")
    out["sort_new"] = _sort("created_utc")
    out["sort_comments"] = _sort("num_comments")
    out["keyword_search_all"] = (
        f"WITH {P} SELECT id, title, score, subreddit, created_utc FROM posts WHERE {_week(v.POSTS_AS_OF)} "
        f"AND {_matched(sq.KEYWORDS)} ORDER BY score DESC, id LIMIT 50")
    out["keyword_search_quota"] = f"WITH {P}, {SEARCH} SELECT id, subreddit, score, rank, phase FROM found"

    out["search_defaults"] = (
        f"WITH {P} SELECT id, subreddit, created_utc FROM posts WHERE {_week(v.POSTS_AS_OF)} AND {_matched(sq.RELEVANCE_WORDS)} "
        f"ORDER BY {_hits(sq.RELEVANCE_WORDS)} DESC, id LIMIT 100")
    out["keyword_search_every_match"] = (
        f"WITH {P} SELECT id, subreddit FROM posts WHERE subreddit IN ('src0', 'src3') AND {_matched(sq.KEYWORDS)}")
    out["group_counts"] = (
        f"WITH {P}, {_quotas()}, available AS (SELECT lower(subreddit) AS grp, count(*) AS n FROM posts GROUP BY 1), "
        f"{_allocation(sq.BUDGET)} SELECT grp AS subreddit, n AS available, base + extra AS taken FROM alloc")
    out["normalize_weights"] = (f"WITH {EVENT_QUOTAS} SELECT grp, round(CAST(weight AS DOUBLE) / "
                                "(SELECT sum(weight) FROM quotas), 6) AS share FROM quotas")
    out["validate_limits"] = f'WITH {EVENT_QUOTAS} SELECT grp, mn AS "min", mx AS "max" FROM quotas'
    out["initial_limits"] = (
        f"WITH {EVENT_QUOTAS} SELECT grp, least(mx, greatest(mn, 1, CAST(round_even(CAST(2000 * weight AS DOUBLE) / "
        "(SELECT sum(weight) FROM quotas), 0) AS BIGINT))) AS initial FROM quotas")
    out["quota_allocation"] = (
        f"WITH {EVENT_QUOTAS}, available AS (SELECT event_type AS grp, count(*) AS n FROM events GROUP BY 1), "
        f"{_allocation(2000)} SELECT grp, n, base, extra, base + extra AS take FROM alloc")

    out["comments_of_post"] = s.with_(C, s.DEPTH) + (
        "SELECT c.id, d.depth, c.text FROM comments c JOIN depths d USING (id) WHERE submission_id = '7' "
        "ORDER BY d.depth, c.created_utc, c.id LIMIT 5")
    out["stored_comments_of_post"] = (f"WITH {C} SELECT id, submission_id, text, score, created_utc, author, parent_id, "
                                      "is_root FROM comments WHERE submission_id = '7' ORDER BY created_utc, id LIMIT 6")
    out["comment_depth"] = s.with_(C, s.DEPTH) + "SELECT id, depth FROM depths"
    out["comment_depth_delta"] = out["comment_depth"]
    out["comments_topn_per_post"] = s.with_(P, C, _ranked_comments(3, "SELECT id FROM posts WHERE num_comments > 0")) + (
        "SELECT submission_id, rank, id, depth, text FROM replies")
    out["post_comment_join"] = (f"WITH {P}, {C} SELECT p.id, p.subreddit, p.score, c.id AS comment_id, "
                                "c.author AS comment_author FROM posts p LEFT JOIN comments c ON c.submission_id = p.id")

    iso = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"
    out["project_posts"] = (
        f"WITH {P} SELECT id, title, text, score, " + iso.format("created_utc") + " AS created_utc, "
        "CASE WHEN author <> 'u5' THEN author END AS author, num_comments, url, subreddit, upvote_ratio FROM posts")
    out["project_comments"] = (
        f"WITH {C} SELECT id, text, score, " + iso.format("make_timestamp((1704067200 + score * 61) * 1000000)")
        + " AS created_utc, author, submission_id, parent_id, is_root FROM comments")
    out["strip_html"] = f"SELECT page_id, {_pages_text()} AS text FROM pages"
    noisy = s.noisy("text")
    out["remove_urls"] = _step(s.replaced(noisy, s.URL))
    out["remove_emojis"] = _step(s.emojis(noisy))
    out["remove_hashtags"] = _step(s.replaced(noisy, s.HASHTAG))
    out["remove_mentions"] = _step(s.replaced(noisy, s.MENTION))
    out["lowercase_text"] = _step(f"lower({noisy})")
    forms = f"concat({noisy}, {s.q(v.FORMS)})"
    for form, plain in (("ﬁ", "fi"), ("½", "1⁄2"), ("①", "1")):
        forms = f"replace({forms}, '{form}', '{plain}')"
    out["nfkc_fullwidth"] = _step(s.fold(forms))
    out["collapse_whitespace"] = _step(s.collapse(noisy))
    out["clean_text_full"] = _step(s.cleaned(noisy))
    out["clean_posts"] = (f"WITH {P} SELECT id, {s.cleaned('title')} AS title, {s.cleaned(noisy)} AS text, "
                          "true AS cleaned FROM posts")
    out["clean_comments"] = f"WITH {C} SELECT id, {s.cleaned(noisy)} AS text, true AS cleaned FROM comments"
    out["empty_text_guard"] = s.with_(
        s.LEX, "src AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang = 'en' THEN "
        f"{s.cleaned('text')} ELSE '' END AS text FROM documents)", s.rule_scores("r", "src", "text")) + (
        f"SELECT src.id, src.text, {s.rounded('r.')}, r.sentiment FROM src JOIN r USING (id)")

    out["tokenize"] = (f"WITH {CONTRACTED} SELECT doc_id, len({s.tokens('text')}) AS n_tokens, "
                       f"{s.joined(s.tokens('text'))} AS tokens FROM docs")
    out["remove_stopwords"] = f"WITH {CONTRACTED} SELECT doc_id, {dropped(())} AS tokens FROM docs"
    out["keep_important_stopwords"] = f"WITH {CONTRACTED} SELECT doc_id, {dropped(s.KEEP_WORDS)} AS tokens FROM docs"
    out["lemmatize_tokens"] = f"WITH {CONTRACTED} SELECT doc_id, {s.normalized('text')} AS lemmas FROM docs"
    out["normalize_nolemma"] = (f"WITH {CONTRACTED} SELECT doc_id, {s.joined(s.tokens('text'))} AS text_normalized "
                                "FROM docs")
    out["normalize_posts"] = (
        f"WITH {P} SELECT id, title, text, {s.normalized('title')} AS title_normalized, {s.normalized('text')} "
        "AS text_normalized, title AS title_original, text AS text_original, true AS normalized FROM posts")
    out["normalize_comments"] = (
        f"WITH {C} SELECT id, text, {s.normalized('text')} AS text_normalized, text AS text_original, "
        "true AS normalized FROM comments")

    words = "words AS (SELECT DISTINCT w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE length(w) >= 2)"
    out["lemmatize_table"] = f"""WITH {CONTRACTED}, {words}, lem AS (
      SELECT lower(w) AS k, max(concat(substr(w, 1, 3), CAST(length(w) AS VARCHAR))) AS m FROM words
      WHERE (unicode(w) + length(w)) % 2 = 0 AND NOT regexp_matches(w, '^\\p{{N}}+$') GROUP BY 1),
    toks AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT doc_id, {s.tokens('text')} AS t FROM docs))
    SELECT doc_id, string_agg(coalesce(m, lower(token)), ' ' ORDER BY pos) AS lemmas
    FROM toks LEFT JOIN lem ON k = lower(token) GROUP BY doc_id"""
    table = f"""{words}, lex(token, valence) AS (
      SELECT lower(w), max(CAST((unicode(w) * 7 + length(w)) % 9 - 4 AS DOUBLE) / 2) FROM words
      WHERE (unicode(w) + length(w)) % 2 = 1 GROUP BY 1)"""
    out["lexicon_score_table"] = s.with_(table, TONED, s.rule_scores("r", "docs", "text")) + _score_select("r")
    runs = r"""lex(token, valence) AS (
      SELECT token, max(valence) FROM (
        SELECT lower(t) AS token, CAST(length(t) * 7 % 9 - 4 AS DOUBLE) / 2 AS valence FROM (
          SELECT array_to_string(w[i:i + n - 1], ' ') AS t
          FROM (SELECT list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM benchmark),
               (SELECT unnest(range(1, 400, 3)) AS i), (SELECT unnest([2, 3, 4]) AS n) WHERE i <= len(w)) WHERE contains(t, ' ')
        UNION ALL SELECT * FROM (VALUES """ + s.values(v.LEXICON) + ")) GROUP BY token)"
    out["lexicon_score_phrases"] = s.with_(runs, TONED, s.rule_scores("r", "docs", "text", 4)) + _score_select("r")
    out["lexicon_score"] = s.with_(s.LEX, TONED, s.rule_scores("r", "docs", "text")) + _score_select("r")
    out["token_context"] = s.with_(s.LEX, C, s.rule_words("r", "comments", "text")) + (
        "SELECT id, pos - 1 AS pos, w AS token, lag(w, 1) OVER x AS prev1, lag(w, 2) OVER x AS prev2, "
        "lag(w, 3) OVER x AS prev3 FROM r_l WINDOW x AS (PARTITION BY id ORDER BY pos)")
    out["negation_flip"] = s.with_(s.LEX, TONED, s.rule_words("r", "docs", "text")) + (
        f"SELECT id, count(*) AS hits, count(*) FILTER (f < 0) AS flipped, round(sum(f), 6) AS factors FROM ("
        f"SELECT id, {neg} AS f FROM r_ctx WHERE v IS NOT NULL) GROUP BY id")
    out["but_reweight"] = s.with_(s.LEX, TONED, s.rule_words("r", "docs", "text")) + (
        "SELECT id, round(sum(coalesce(v, 0)), 6) AS plain, round(sum(coalesce(v, 0) * CASE WHEN but IS NULL OR pos = but "
        f"THEN 1.0::DOUBLE WHEN pos < but THEN {lx.BEFORE_BUT}::DOUBLE ELSE {lx.AFTER_BUT}::DOUBLE END), 6) AS weighed "
        "FROM r_ctx GROUP BY id")
    out["emphasis_features"] = s.with_(s.LEX, TONED, s.rule_words("r", "docs", "text")) + (
        f"""SELECT d.id, round(least(length(text) - length(replace(text, '!', '')), 4) * {lx.EXCLAMATION}::DOUBLE, 6)
        AS exclamation, round(CASE WHEN qn <= 1 THEN 0.0::DOUBLE WHEN qn <= 3 THEN qn * {lx.QUESTION}::DOUBLE
        ELSE {lx.QUESTION_MAX}::DOUBLE END, 6) AS question, u.capitals, u.mixed
        FROM (SELECT id, text, length(text) - length(replace(text, '?', '')) AS qn FROM docs) d
        JOIN (SELECT id, count(*) FILTER (up) AS capitals, bool_or(caps) AS mixed FROM r_ctx GROUP BY id) u USING (id)""")
    c = "round(value / 100 - 0.15::DOUBLE, 6)"
    out["classify_compound"] = (
        f"SELECT event_id, compound, CASE WHEN compound >= {lx.THRESHOLD} THEN 'positive' WHEN compound <= "
        f"-{lx.THRESHOLD} THEN 'negative' ELSE 'neutral' END AS sentiment FROM (SELECT event_id, {c} AS compound FROM events)")
    rules = s.with_(s.LEX, P, _posts_rules("posts"))
    out["score_posts_rules"] = rules + (
        f"SELECT ro.id, round(rt.compound, 6) AS title_compound, round(rx.compound, 6) AS text_compound, "
        f"{s.rounded('ro.')}, ro.sentiment FROM ro JOIN rt USING (id) JOIN rx USING (id)")
    out["overall_sentiment"] = rules + _score_select("ro")
    out["score_comments_rules"] = s.with_(s.LEX, C, s.rule_scores("rc", "comments", "text")) + _score_select("rc")
    out["score_raw_vs_normalized"] = s.with_(
        s.LEX, TONED, f"norm AS (SELECT id, {s.normalized('text')} AS text FROM docs)",
        s.rule_scores("a", "docs", "text"), s.rule_scores("b", "norm", "text")) + (
        "SELECT id, round(a.compound, 6) AS raw_compound, round(b.compound, 6) AS normalized_compound "
        "FROM a JOIN b USING (id)")
    out["analysis_metadata"] = (
        f"WITH {P} SELECT id, 'vader' AS method, CAST(NULL AS VARCHAR) AS model, '2024-02-01T00:00:00.000000Z' "
        "AS analyzed_at, true AS used_normalized_text FROM posts")
    out["score_json"] = s.with_(s.LEX, C, s.rule_scores("rc", "comments", "text")) + (
        "SELECT id, sentiment AS label, round(compound, 6) AS compound FROM rc")

    part = lambda a, b: f"round(list_sum(list_transform(embedding[{a}:{b}], lambda x: CAST(x AS DOUBLE))), 6)"
    out["softmax_scores"] = s.with_(
        f"src AS (SELECT vec_id AS id, [{part(1, 21)}, {part(22, 42)}, {part(43, 64)}] AS lg0 FROM embeddings)",
        s.model_scores("m", "src", "lg0")) + f"SELECT id AS vec_id, {s.rounded()}, sentiment FROM m"
    words = f"list_filter(regexp_split_to_array(text, {s.q(s.SPACE + '+')}), lambda x: x <> '')"
    out["truncate_tokens"] = f"SELECT doc_id, {s.joined(words + '[1:512]')} AS text FROM documents"
    out["score_model_batch"] = s.with_(
        "src AS (SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents)",
        s.model_scores("m", "src", s.letters("text"))) + _score_select("m")
    modelled = s.with_(P, _posts_model("posts"))
    out["score_posts_model"] = modelled + (
        f"SELECT mo.id, round(mt.compound, 6) AS title_compound, round(mx.compound, 6) AS text_compound, "
        f"{s.rounded('mo.')}, mo.sentiment FROM mo JOIN mt USING (id) JOIN mx USING (id)")
    out["overall_sentiment_model"] = modelled + _score_select("mo")
    out["score_comments_model"] = s.with_(C, s.model_scores("mc", "comments", s.letters("text"))) + _score_select("mc")

    raw_scores = (_posts_rules("posts"), s.rule_scores("rc", "comments", "text"), _posts_model("posts"),
                  s.model_scores("mc", "comments", s.letters("text")))
    out["compare_models"] = s.with_(s.LEX, P, C, *raw_scores, _compared("posts", "comments")) + (
        f"SELECT {COMPARED_COLUMNS} FROM compared")
    flow = s.with_(s.LEX, P, C, _flow("posts", "comments"), _compared("cp", "cc"))
    out["disagreements"] = flow + ("SELECT content_type, id, vader_sentiment, transformer_sentiment FROM compared "
                                   "WHERE NOT agreement")
    two = lambda x: f"printf('%.2f', {x})"
    out["disagreements_top5"] = flow + (
        f"SELECT content_type, id, left(text, 100) AS text, vader_sentiment, {two('vader_compound')} AS vader_compound, "
        f"transformer_sentiment, {two('transformer_compound')} AS transformer_compound FROM compared WHERE NOT agreement "
        "ORDER BY content_type, id LIMIT 5")
    labelled = f"concat(text, {s.q(v.NOISE_TAIL)})"
    out["agreement_rate"] = s.with_(
        s.LEX, f"src AS (SELECT doc_id AS id, {s.cleaned(labelled)} AS text FROM documents "
        "WHERE doc_id IN (SELECT doc_id FROM labels))", s.rule_scores("r", "src", "text")) + (
        "SELECT count(*) AS items, round(avg(CASE WHEN r.sentiment = CASE WHEN l.quality = 1 THEN 'positive' "
        "ELSE 'negative' END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 1) AS agreement_rate "
        "FROM r JOIN labels l ON l.doc_id = r.id")
    out["run_metadata"] = (
        f"WITH {P}, {C} SELECT {s.q('|'.join(sq.KEYWORDS))} AS keywords, {s.q('|'.join(sq.GROUPS))} AS subreddits, "
        "'2024-02-01T00:00:00.000000Z' AS run_at, (SELECT count(*) FROM posts) AS submission_count, "
        "(SELECT count(*) FROM comments) AS comment_count")
    out["analyze_topic"] = s.with_(s.LEX, P, C, SEARCH, _ranked_comments(4, "SELECT id FROM found"),
                                   _flow("found", "replies"), _compared("cp", "cc")) + (
        f"SELECT {COMPARED_COLUMNS} FROM compared")

    out["parse_iso"] = (
        "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) - "
        "CASE WHEN event_type = 'view' THEN 7200 ELSE 0 END END AS epoch FROM events")
    out["format_iso"] = "SELECT event_id, " + iso.format("ts") + " AS iso FROM events"
    out["batch_id_format"] = "SELECT event_id, strftime(ts, 'batch_%Y%m%d_%H%M%S') AS batch_id FROM events"

    out["post_by_id"] = f"WITH {P} SELECT {ALL_POST_COLUMNS} FROM posts WHERE id = '7'"
    out["upsert_posts"] = f"WITH {P}, {C}, {changes}, {upserted} SELECT * FROM upserted"
    out["upsert_partial_columns"] = (f"WITH {P}, {C}, {changes}, {upserted} SELECT id, title, score, author, subreddit "
                                     "FROM upserted")
    out["upsert_last_wins"] = f"""WITH {P}, last AS (
        SELECT CAST(conv_id AS VARCHAR) AS id, text, role AS author FROM conversations c WHERE turn = (
          SELECT max(turn) FROM conversations x WHERE x.conv_id = c.conv_id))
      SELECT coalesce(b.id, l.id) AS id, CASE WHEN l.id IS NOT NULL THEN l.text ELSE b.text END AS text,
             CASE WHEN l.id IS NOT NULL THEN l.author ELSE b.author END AS author
      FROM posts b FULL OUTER JOIN last l ON b.id = l.id"""
    out["upsert_duplicates"] = f"""WITH {P}, last AS (
        SELECT * FROM (SELECT CAST(conv_id AS VARCHAR) AS id, text, role AS author, row_number() OVER (
          PARTITION BY conv_id ORDER BY text DESC NULLS LAST, role DESC NULLS LAST) AS n FROM conversations) WHERE n = 1)
      SELECT coalesce(b.id, l.id) AS id, CASE WHEN l.id IS NOT NULL THEN l.text ELSE b.text END AS text,
             CASE WHEN l.id IS NOT NULL THEN l.author ELSE b.author END AS author
      FROM posts b FULL OUTER JOIN last l ON b.id = l.id"""
    out["upsert_defaults"] = f"""WITH {P}, {C}, {changes}
      SELECT coalesce(b.id, c.id) AS id, CASE WHEN c.id IS NOT NULL THEN c.score ELSE b.score END AS score,
             CASE WHEN b.id IS NULL THEN false ELSE lang = 'en' END AS cleaned,
             CASE WHEN b.id IS NULL THEN false ELSE lang <> 'en' END AS processed
      FROM posts b FULL OUTER JOIN changes c ON b.id = c.id"""
    out["csv_latest_items"] = (f"WITH {C} SELECT id, text, CASE WHEN score < 25 THEN score + 100 ELSE score END AS score FROM comments")
    out["csv_compacted"] = (f"WITH {C} SELECT id, text, score + CASE WHEN score < 5 THEN 200 WHEN score < 25 THEN 100 ELSE 0 END AS score, "
                            "CASE WHEN score < 5 THEN 2 ELSE 1 END AS versions FROM comments")
    out["topic_files"] = (f"SELECT content_type, c.id, vader_sentiment, transformer_sentiment, agreement, p.source AS subreddit "
                          f"FROM ({out['analyze_topic']}) c LEFT JOIN documents p "
                          "ON content_type = 'submission' AND CAST(p.doc_id AS VARCHAR) = c.id")
    out["upsert_comments"] = f"""WITH {P}, {C} SELECT c.id, submission_id,
      CASE WHEN author = 'assistant' AND submission_id IN {english} THEN concat(text, ' [edited]') ELSE text END AS text,
      score + CAST(author = 'assistant' AND submission_id IN {english} AS BIGINT) AS score,
      created_utc, author, parent_id, is_root FROM comments c"""
    out["fk_accept"] = f"WITH {P}, {C} SELECT id, submission_id FROM comments WHERE submission_id IN {english}"
    out["fk_reject"] = f"WITH {P}, {C} SELECT id, submission_id FROM comments WHERE submission_id NOT IN {english}"
    out["store_batch_counts"] = (
        f"WITH {P}, {C}, x AS (SELECT score <> 7 AND submission_id IN {english} AS ok FROM comments) "
        "SELECT count(*) FILTER (ok) AS success, count(*) FILTER (NOT ok) AS failure FROM x")
    equal = "quotas(grp, weight, mn, mx) AS (VALUES ('src0', 1, 1, 40), ('src1', 1, 1, 40), ('src2', 1, 1, 40))"
    out["ingest_counts"] = s.with_(
        P, C, _search(["src0", "src1", "src2"], equal, 40, "num_comments", _week(v.POSTS_AS_OF, "1 month")),
        _ranked_comments(3, "SELECT id FROM found")) + (
        "SELECT (SELECT count(*) FROM found) AS submissions_stored, (SELECT count(*) FROM replies) AS comments_stored")
    out["storage_rows"] = s.with_(
        s.LEX, P, f"raw AS (SELECT id, title, {noisy} AS text FROM posts)",
        f"""cp AS MATERIALIZED (SELECT *, {s.normalized('tc')} AS tn, {s.normalized('xc')} AS xn FROM (
          SELECT id, title, text, {s.cleaned('title')} AS tc, {s.cleaned('text')} AS xc FROM raw))""",
        _posts_rules("cp", "tn", "xn"), _posts_model("cp", "tn", "xn")) + (
        "SELECT cp.id, title, text, tc AS title_cleaned, xc AS text_cleaned, tn AS title_normalized, xn AS text_normalized, "
        "true AS cleaned, round(ro.compound, 6) AS vader_compound, ro.sentiment AS vader_label, "
        "round(mo.compound, 6) AS transformer_compound, mo.sentiment AS transformer_label "
        "FROM cp JOIN ro USING (id) JOIN mo USING (id)")
    out["shard_key"] = (
        f"WITH {C} SELECT id, CASE WHEN length(id) >= 4 THEN substr(id, 1, 2) ELSE 'root' END AS s1, "
        "CASE WHEN length(id) >= 4 THEN substr(id, 3, 2) ELSE 'root' END AS s2 FROM comments")
    out["csv_roundtrip"] = (
        f"WITH {P} SELECT id, title, concat('He said \"hi\",', chr(13), chr(10), text, ' , \\\" end ') AS text, score, created_utc, "
        "upvote_ratio, CASE WHEN lang = 'en' THEN author END AS author FROM posts")
    out["csv_item_lookup"] = (f"WITH {C} SELECT id, submission_id, text, score, created_utc, parent_id, is_root, "
                              "'comment' AS item_type FROM comments WHERE id = '10_1'")
    return out
