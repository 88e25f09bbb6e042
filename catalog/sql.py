"""Building blocks of the DuckDB counterparts: an independent formulation of each
operator with unnested tokens and window functions."""

from __future__ import annotations

from catalog import views
from threadlens.functions import lexicon as lx
from threadlens.functions.cleaning import (EMOJI, HASHTAG, KEYCAP, MENTION, SPACE, URL, WORD,
                                          emoji_pattern)
from threadlens.functions.tokens import KEEP_WORDS, PLAIN_TOKEN, STARTER_LEMMAS

EDGE = r"[^\p{L}\p{N}_]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def values(mapping) -> str:
    return ", ".join(f"({q(k)}, CAST({v} AS DOUBLE))" for k, v in mapping.items())


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c for c in ctes if c) + "\n"


POSTS = f"""posts AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, concat('The great post ', CAST(d.doc_id % 7 AS VARCHAR), ' of ', d.source, ' in ', d.lang) AS title, d.text AS text,
         CAST(d.doc_id * 37 % 1001 AS BIGINT) AS score,
         TIMESTAMP '{views.START}' + d.doc_id * INTERVAL '1' MINUTE AS created_utc,
         concat('u', CAST(d.doc_id % 97 AS VARCHAR)) AS author,
         CAST(coalesce(c.n, 0) AS BIGINT) AS num_comments,
         concat('https://ex.org/p/', CAST(d.doc_id AS VARCHAR)) AS url, d.source AS subreddit,
         round((d.doc_id % 101) / CAST(100 AS DOUBLE), 2) AS upvote_ratio, d.lang AS lang
  FROM documents d
  LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) c
    ON c.conv_id = d.doc_id)"""

COMMENTS = f"""comments AS (
  SELECT concat(CAST(conv_id AS VARCHAR), '_', CAST(turn AS VARCHAR)) AS id,
         CAST(conv_id AS VARCHAR) AS submission_id, text,
         CAST(length(text) % 50 AS BIGINT) AS score,
         TIMESTAMP '{views.START}' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE AS created_utc,
         role AS author,
         CASE WHEN turn = 0 THEN concat('t3_', CAST(conv_id AS VARCHAR))
              ELSE concat('t1_', CAST(conv_id AS VARCHAR), '_',
                          CAST(CAST(floor((turn - 1) / 2) AS INTEGER) AS VARCHAR)) END AS parent_id,
         turn = 0 AS is_root
  FROM conversations)"""

DEPTH = """depths AS (
  SELECT id, 0 AS depth FROM comments WHERE is_root
  UNION ALL
  SELECT c.id, d.depth + 1 FROM comments c JOIN depths d ON c.parent_id = concat('t1_', d.id))"""

LEX = f"lex(token, valence) AS (VALUES {values(views.LEXICON)})"


def noisy(column: str) -> str:
    return f"concat({q(views.NOISE_HEAD)}, {column}, {q(views.NOISE_TAIL)})"


def collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, {q(SPACE + '+')}, ' ', 'g'))"


def replaced(c: str, pattern: str) -> str:
    return f"regexp_replace({c}, {q(pattern)}, '', 'g')"


FULLWIDTH = ("".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F))))


def fold(c: str) -> str:
    return f"translate({c}, {q(FULLWIDTH[0])}, {q(FULLWIDTH[1])})"


def emojis(c: str) -> str:
    return replaced(replaced(c, KEYCAP), emoji_pattern(f"[{EMOJI}]"))


def cleaned(c: str) -> str:
    """The chain without HTML, which the texts do not hold."""
    c = replaced(c, URL)
    c = replaced(replaced(emojis(c), HASHTAG), MENTION)
    return collapse(fold(f"lower({c})"))


def tokens(c: str, contractions: bool = True) -> str:
    if not contractions:
        return f"regexp_extract_all({c}, {q(PLAIN_TOKEN)})"
    negated = rf"({WORD})([nN]['’][tT])($|{EDGE})"
    split = f"regexp_replace({c}, {q(negated)}, '\\1 \\2\\3', 'g')"
    pattern = rf"(?:[nN]['’][tT])\b|['’](?:[sSmMdD]|[rR][eE]|[vV][eE]|[lL][lL])\b|{PLAIN_TOKEN}"
    return f"regexp_extract_all({split}, {q(pattern)})"


def lemma_map() -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in STARTER_LEMMAS.items()) + "}"


def lemmas(list_expr: str) -> str:
    return (f"list_transform({list_expr}, lambda t: CASE WHEN regexp_matches(t, '^\\p{{N}}+$') THEN t "
            f"ELSE coalesce(map_extract_value({lemma_map()}, lower(t)), lower(t)) END)")


def joined(list_expr: str) -> str:
    return f"coalesce(array_to_string({list_expr}, ' '), '')"


def normalized(c: str) -> str:
    return joined(lemmas(tokens(c)))


def without_stopwords(list_expr: str, keep=KEEP_WORDS) -> str:
    dropped = [w for w in views.STOPWORDS if w not in keep]
    return f"list_filter({list_expr}, lambda t: lower(t) NOT IN {listed(dropped)})"


def boost(word: str) -> str:
    return (f"CASE WHEN {word} IN {listed(lx.STRONGER)} THEN {lx.BOOST}::DOUBLE "
            f"WHEN {word} IN {listed(lx.WEAKER)} THEN {-lx.BOOST}::DOUBLE END")


def negation(word: str) -> str:
    return f"({word} IN {listed(lx.NEGATIONS)} OR contains({word}, 'n''t'))"


def factor(distance: int) -> str:
    word = f"p{distance}"
    between = [f"p{k}" for k in range(1, distance)]
    never = " OR ".join(f"coalesce({b} IN ('so', 'this'), false)" for b in between) or "false"
    doubt = " OR ".join(f"coalesce({b} = 'doubt', false)" for b in between) or "false"
    return (f"CASE WHEN {word} = 'never' AND ({never}) THEN {lx.NEVER}::DOUBLE "
            f"WHEN {word} = 'without' AND ({doubt}) THEN 1.0::DOUBLE "
            f"WHEN {negation(word)} THEN {lx.NEGATE}::DOUBLE ELSE 1.0::DOUBLE END")


def merged_words(name: str, most: int) -> str:
    """``{name}_w`` from ``{name}_one``: runs of up to ``most`` words that are in ``lex`` made one word."""
    leads = ", ".join(f"lead(w, {k}) OVER x AS w{k}" for k in range(1, most))
    run = lambda n: "concat_ws(' ', w, " + ", ".join(f"w{k}" for k in range(1, n)) + ")"
    runs = " UNION ALL ".join(f"SELECT id, pos, {n} AS n, {run(n)} AS w FROM {name}_ahead WHERE w{n - 1} IS NOT NULL" for n in range(2, most + 1))
    return f"""{name}_ahead AS (SELECT *, {leads} FROM {name}_one WINDOW x AS (PARTITION BY id ORDER BY pos)),
{name}_runs AS (SELECT id, pos, max(n) AS n, arg_max(r.w, n) AS w FROM ({runs}) r JOIN lex ON token = lower(r.w) GROUP BY id, pos),
{name}_kept AS (
  SELECT id, unnest(kept) AS pos FROM (
    SELECT id, list_reduce(list_prepend({{'at': 0, 'stop': 0, 'kept': CAST([] AS INTEGER[])}},
                 list({{'at': CAST(pos AS INTEGER), 'stop': CAST(pos + n AS INTEGER), 'kept': CAST([] AS INTEGER[])}} ORDER BY pos)),
             lambda a, x: CASE WHEN x.at >= a.stop THEN {{'at': 0, 'stop': x.stop, 'kept': list_append(a.kept, x.at)}} ELSE a END).kept AS kept
    FROM {name}_runs GROUP BY id)),
{name}_w AS (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) AS pos, w FROM (
    SELECT id, pos, w FROM {name}_runs SEMI JOIN {name}_kept USING (id, pos)
    UNION ALL SELECT id, pos, w FROM {name}_one ANTI JOIN (
      SELECT id, unnest(range(pos, pos + n)) AS pos FROM {name}_runs SEMI JOIN {name}_kept USING (id, pos)) USING (id, pos)))"""


def rule_words(name: str, source: str, text: str, most: int = 1) -> str:
    """Words of a text with their three predecessors: ``{name}_ctx``."""
    p = q(lx.PUNCTUATION)
    lags = ", ".join(
        f"lag(l, {k}) OVER w AS p{k}, lag(v, {k}) OVER w AS v{k}, lag(up, {k}) OVER w AS u{k}"
        for k in (1, 2, 3))
    return f"""{name}_raw AS (
  SELECT id, unnest(ws) AS raw, generate_subscripts(ws, 1) AS pos FROM (
    SELECT id, list_filter(regexp_split_to_array({text}, {q(SPACE + '+')}), lambda x: x <> '') AS ws
    FROM {source})),
{name}_{'w' if most == 1 else 'one'} AS (
  SELECT id, pos, CASE WHEN length(trim(raw, {p})) <= 2 THEN raw ELSE trim(raw, {p}) END AS w
  FROM {name}_raw),{chr(10) + merged_words(name, most) + ',' if most > 1 else ''}
{name}_l AS (
  SELECT t.id, t.pos, t.w, lower(t.w) AS l, upper(t.w) = t.w AND lower(t.w) <> t.w AS up, x.valence AS v
  FROM {name}_w t LEFT JOIN lex x ON x.token = lower(t.w)),
{name}_ctx AS (
  SELECT *, {lags}, lead(v, 1) OVER w AS vnext, lead(l, 1) OVER w AS lnext,
         bool_or(up) OVER (PARTITION BY id) AND NOT bool_and(up) OVER (PARTITION BY id) AS caps,
         min(CASE WHEN l = 'but' THEN pos END) OVER (PARTITION BY id) AS but
  FROM {name}_l WINDOW w AS (PARTITION BY id ORDER BY pos))"""


def rule_scores(name: str, source: str, text: str, most: int = 1) -> str:
    """Score columns per id: ``{name}`` (id, neg, neu, pos, compound, sentiment)."""
    def caps(x, flag):
        return (f"{x} + CASE WHEN {flag} THEN CASE WHEN {x} > 0 THEN {lx.CAPS}::DOUBLE "
                f"ELSE {-lx.CAPS}::DOUBLE END ELSE 0.0::DOUBLE END")

    stages = []
    previous = f"{name}_s0"
    for d, damping in zip((1, 2, 3), lx.DISTANCE_DAMPING):
        b = boost(f"p{d}")
        signed = f"CASE WHEN s < 0 THEN -({b}) ELSE ({b}) END"
        loud = (f"CASE WHEN caps AND u{d} THEN CASE WHEN s > 0 THEN {lx.CAPS}::DOUBLE "
                f"ELSE {-lx.CAPS}::DOUBLE END ELSE 0.0::DOUBLE END")
        stages.append(f"""{name}_s{d} AS (
  SELECT * EXCLUDE (s), CASE WHEN p{d} IS NULL OR v{d} IS NOT NULL THEN s
    ELSE (s + coalesce(({signed} + {loud}) * {damping}::DOUBLE, 0.0::DOUBLE)) * {factor(d)} END AS s
  FROM {previous})""")
        previous = f"{name}_s{d}"
    stage_sql = ",\n".join(stages)
    denied = "(p1 = 'no' OR p2 = 'no' OR (p3 = 'no' AND p1 IN ('or', 'nor')))"
    excl = f"least(length({text}) - length(replace({text}, '!', '')), 4) * {lx.EXCLAMATION}::DOUBLE"
    ques = f"length({text}) - length(replace({text}, '?', ''))"
    emphasis = (f"{excl} + CASE WHEN {ques} <= 1 THEN 0.0::DOUBLE WHEN {ques} <= 3 "
                f"THEN ({ques}) * {lx.QUESTION}::DOUBLE ELSE {lx.QUESTION_MAX}::DOUBLE END")
    share = lambda part: f"coalesce(round_even({part} / nullif(p + n + u, 0), 3), 0.0::DOUBLE)"
    t = lx.THRESHOLD
    return f"""{rule_words(name, source, text, most)},
{name}_s0 AS (
  SELECT *, {caps('b', 'caps AND up')} AS s FROM (
    SELECT *, CASE WHEN coalesce({denied}, false) THEN v * {lx.NEGATE}::DOUBLE
                   WHEN l = 'no' AND vnext IS NOT NULL THEN 0.0::DOUBLE ELSE v END AS b
    FROM {name}_ctx)),
{stage_sql},
{name}_val AS (
  SELECT id, pos, CASE WHEN but IS NULL OR pos = but THEN x WHEN pos < but THEN x * {lx.BEFORE_BUT}::DOUBLE
                       ELSE x * {lx.AFTER_BUT}::DOUBLE END AS x
  FROM (SELECT id, pos, but, CASE WHEN v IS NULL OR ({boost('l')}) IS NOT NULL
                 OR coalesce(l = 'kind' AND lnext = 'of', false) THEN 0.0::DOUBLE
               ELSE s * CASE WHEN coalesce(p1 = 'least' AND v1 IS NULL
                                  AND NOT coalesce(p2 IN ('at', 'very'), false), false)
                        THEN {lx.NEGATE}::DOUBLE ELSE 1.0::DOUBLE END END AS x
        FROM {previous})),
{name}_sum AS (
  SELECT id, coalesce(sum(x ORDER BY pos), 0) AS s, coalesce(sum(x + 1 ORDER BY pos) FILTER (x > 0), 0) AS p,
         coalesce(sum(1 - x ORDER BY pos) FILTER (x < 0), 0) AS n,
         CAST(count(*) FILTER (x = 0) AS DOUBLE) AS u
  FROM {name}_val GROUP BY id),
{name}_emp AS (
  SELECT src.id, src.empty, e, coalesce(s, 0) + sign(coalesce(s, 0)) * e AS raw,
         coalesce(p, 0) + CASE WHEN p > n THEN e ELSE 0.0::DOUBLE END AS p,
         coalesce(n, 0) + CASE WHEN p < n THEN e ELSE 0.0::DOUBLE END AS n, coalesce(u, 0) AS u
  FROM (SELECT id, coalesce({text}, '') = '' AS empty, {emphasis} AS e FROM {source}) src
  LEFT JOIN {name}_sum USING (id)),
{name} AS (
  SELECT id, neg, neu, pos, compound, CASE WHEN compound >= {t} THEN 'positive'
         WHEN compound <= -{t} THEN 'negative' ELSE 'neutral' END AS sentiment
  FROM (SELECT id, CASE WHEN empty THEN 0.0::DOUBLE ELSE {share('n')} END AS neg,
               CASE WHEN empty THEN 1.0::DOUBLE ELSE {share('u')} END AS neu,
               CASE WHEN empty THEN 0.0::DOUBLE ELSE {share('p')} END AS pos,
               CASE WHEN empty THEN 0.0::DOUBLE
                    ELSE round_even(raw / sqrt(raw * raw + {lx.ALPHA}::DOUBLE), 4) END AS compound
        FROM {name}_emp))"""


def letters(text: str) -> str:
    """Logits of the letter scorer as a list."""
    one = lambda c: (f"10.0::DOUBLE * (length({text}) - length(replace({text}, '{c}', ''))) "
                     f"/ greatest(length({text}), 1)")
    return f"[{one('a')}, {one('n')}, {one('e')}]"


def model_scores(name: str, source: str, logits: str) -> str:
    """Score columns per id from a list of logits: ``{name}``."""
    return f"""{name}_p AS (
  SELECT id, list_transform(ex, lambda x: x / list_sum(ex)) AS p FROM (
    SELECT id, list_transform(lg, lambda x: exp(x - list_max(lg))) AS ex FROM (
      SELECT id, {logits} AS lg FROM {source}))),
{name} AS (
  SELECT id, p[1] AS neg, p[2] AS neu, p[3] AS pos, p[3] - p[1] AS compound,
         (['negative', 'neutral', 'positive'])[list_position(p, list_max(p))] AS sentiment
  FROM {name}_p)"""


def overall(name: str, title: str, text: str, by_threshold: bool) -> str:
    mix = lambda c: f"(a.{c} * 0.3::DOUBLE + b.{c} * (1 - 0.3::DOUBLE))"
    label = (f"CASE WHEN {mix('compound')} >= {lx.THRESHOLD} THEN 'positive' WHEN {mix('compound')} <= "
             f"-{lx.THRESHOLD} THEN 'negative' ELSE 'neutral' END" if by_threshold else
             f"CASE WHEN {mix('neg')} >= {mix('neu')} AND {mix('neg')} >= {mix('pos')} THEN 'negative' "
             f"WHEN {mix('neu')} >= {mix('pos')} THEN 'neutral' ELSE 'positive' END")
    return f"""{name} AS (
  SELECT a.id, {mix('neg')} AS neg, {mix('neu')} AS neu, {mix('pos')} AS pos,
         {mix('compound')} AS compound, {label} AS sentiment
  FROM {title} a JOIN {text} b USING (id))"""


def rounded(prefix: str = "", columns=("neg", "neu", "pos", "compound")) -> str:
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in columns)
