"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

# The mix, without slices: one window over each source, one over all quotients.
SAINTE_LAGUE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(concat('7:', CAST(doc_id AS VARCHAR))), 1, 7) AS BIGINT) AS place
  FROM documents),
w AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         CAST(sum(source_size) OVER () AS BIGINT) AS total, 3 * source_size AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
r AS (SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST) AS place FROM w),
l AS (
  SELECT *, CAST(total - coalesce((SELECT sum(cap) FROM r b WHERE b.place < a.place), 0) AS DOUBLE)
            / (SELECT CAST(sum(weight) AS BIGINT) FROM r b WHERE b.place >= a.place) AS level
  FROM r a),
f AS (SELECT min(place) AS first_open FROM l WHERE level * weight <= cap),
t AS (
  SELECT source, source_size, total, CASE WHEN first_open IS NULL OR place < first_open THEN CAST(cap AS DOUBLE)
         ELSE least((SELECT level FROM l WHERE place = first_open) * weight, CAST(cap AS DOUBLE)) END AS target
  FROM l, f),
b AS (
  SELECT *, CAST(pow(16, (SELECT count(*) FROM range(1, 14) x(i) WHERE target >= 256 * pow(16.0::DOUBLE, i))) AS BIGINT) AS block FROM t WHERE target > 0),
s AS (
  SELECT *, CAST(greatest(1, round(whole / block)) AS BIGINT) AS seats FROM (
    SELECT *, count(*) OVER (PARTITION BY block) AS n, CAST(sum(CAST(round(target, 3) AS DECIMAL(30, 3))) OVER (PARTITION BY block) AS DOUBLE) AS whole FROM b)),
k AS (
  SELECT source, block, row_number() OVER (PARTITION BY block ORDER BY CAST(2 * k + 1 AS DOUBLE) / target, source NULLS LAST) AS place, seats
  FROM (SELECT *, unnest(range(CAST(ceil(target * (seats + n / 2) / whole + 0.5) AS BIGINT) + 1)) AS k FROM s)),
q AS (SELECT source, count(*) * any_value(block) AS words FROM k WHERE place <= seats GROUP BY source),
g AS (
  SELECT t.source, source_size, target, least(coalesce(words, 0), cap) AS words, greatest(source_size, 1) AS own
  FROM (SELECT *, 3 * source_size AS cap FROM t) t LEFT JOIN q ON t.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(words // own * size + greatest(0, least(size, words % own - start)) AS BIGINT) AS taken
FROM (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d) x
JOIN g ON x.source IS NOT DISTINCT FROM g.source"""

# Cuts by the units themselves: the length of the first units is the offset.
RANK_INDEX = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
h AS (
  SELECT *, len(units) AS n,
         CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(units) + 1) AS r1,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(units) + 1) AS r2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT *, array_to_string(list_slice(units, 1, least(r1, r2)), '') AS prefix,
         array_to_string(list_slice(units, least(r1, r2) + 1, greatest(r1, r2)), '') AS middle,
         array_to_string(list_slice(units, greatest(r1, r2) + 1, n), '') AS suffix
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c"""

_either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
_ASSIGN = (f"(?:{_either('password')}|{_either('passwd')}|{_either('secret')}|{_either('token')}|{_either('api')}_?{_either('key')})"
           r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
# (kind, pattern, group whose length counts, its least length)
_SECRETS = (("assign", _ASSIGN, 1, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16))
_RUN = "[A-Za-z0-9+/_-]"


def _found(text: str, pattern: str, group: int, rank: int, kind: str, table: str) -> str:
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, whole, length(value) AS value_chars,
         sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
  FROM (SELECT doc_id, unnest(range(len(w))) AS i, unnest(g[:len(w)]) AS gap, unnest(w) AS whole, unnest(v) AS value FROM (
    SELECT doc_id, string_split_regex({text}, '{pattern}') AS g, regexp_extract_all({text}, '{pattern}', 0) AS w,
           regexp_extract_all({text}, '{pattern}', {group}) AS v FROM {table}))"""


def _blanked(text: str, pattern: str, group: int, least: int) -> str:
    return (f"array_to_string(list_transform(list_zip(string_split_regex({text}, '{pattern}'), regexp_extract_all({text}, '{pattern}', 0), "
            f"regexp_extract_all({text}, '{pattern}', {group})), lambda x: x[1] || CASE WHEN length(x[3]) >= {least} "
            "THEN repeat(' ', length(x[2])) ELSE coalesce(x[2], '') END), '')")


def _secrets() -> str:
    base = "\n  UNION ALL ".join(f"SELECT * FROM ({_found('text', pattern, group, rank, kind, 'd')}) WHERE value_chars >= {least}"
                                 for rank, (kind, pattern, group, least) in enumerate(_SECRETS))
    steps, text = [], "text"
    for kind, pattern, group, least in _SECRETS:
        steps.append(f"r_{kind} AS (SELECT doc_id, {_blanked(text, pattern, group, least)} AS rest FROM {'d' if text == 'text' else steps[-1].split()[0]})")
        text = "rest"
    rests = ",\n".join(steps)
    kept = " OR ".join(f"kind = '{kind}' AND length(sample) >= {least}" for kind, _, _, least in _SECRETS)
    labelled = "\n  UNION ALL ".join(
        f"SELECT '{kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}', {group})) AS sample FROM d" for kind, pattern, group, _ in _SECRETS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({base}),
{rests},
runs AS (
  SELECT true AS random, unnest(regexp_extract_all(sample, '{_RUN}{{2,}}')) AS run FROM ({labelled}) WHERE {kept}
  UNION ALL SELECT false, unnest(regexp_extract_all(rest, '{_RUN}{{2,}}')) FROM r_hex),
pairs AS (
  SELECT random, run[i:i+1] AS pair, count(*) AS n
  FROM (SELECT random, run, unnest(range(1, length(run))) AS i FROM runs) GROUP BY ALL),
letters AS (SELECT unnest(string_split('+ - / 0 1 2 3 4 5 6 7 8 9 A B C D E F G H I J K L M N O P Q R S T U V W X Y Z _ '
                                       || 'a b c d e f g h i j k l m n o p q r s t u v w x y z', ' ')) AS c),
grid AS (
  SELECT x.c AS a, x.c || y.c AS pair, coalesce(p.n, 0) AS random, coalesce(q.n, 0) AS ordinary
  FROM letters x, letters y LEFT JOIN pairs p ON p.pair = x.c || y.c AND p.random
  LEFT JOIN pairs q ON q.pair = x.c || y.c AND NOT q.random),
weights AS (
  SELECT pair, CAST(round(1000 * (ln(0.5 * CASE WHEN drawn > 0 THEN random / drawn ELSE CAST(1 AS DOUBLE) / 66 END + CAST(0.5 AS DOUBLE) / 66)
                                  - ln((ordinary + 1) / (used + 66)))) AS BIGINT) AS w
  FROM (SELECT *, sum(random) OVER (PARTITION BY a) AS drawn, sum(ordinary) OVER (PARTITION BY a) AS used FROM grid)),
long AS (SELECT row_number() OVER () AS id, * FROM ({_found('rest', _RUN + '{16,}', 0, 3, 'random', 'r_hex')})),
judged AS (
  SELECT id, sum(w) AS ratio FROM (SELECT id, whole[i:i+1] AS pair FROM (SELECT id, whole, unnest(range(1, length(whole))) AS i FROM long))
  JOIN weights USING (pair) GROUP BY id),
spans AS (
  SELECT * FROM base UNION ALL SELECT long.* EXCLUDE (id) FROM long JOIN judged USING (id)
  WHERE ratio >= greatest(12000, 1200 * (length(whole) - 1))),
listed AS (
  SELECT doc_id, rank, kind, stop - length(whole) AS start, kind || ':' || (stop - length(whole)) || ':' || stop AS span FROM spans)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (kind <> 'random'), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN listed ON d.doc_id = listed.doc_id GROUP BY d.doc_id"""


# CRC-32 of a conv_id's digits, bit by bit; prefixes as joined digests; a subtree by the prefixes of its members.
PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, chars) - 1 AS pos FROM turns),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                         lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))),
             4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)),
built AS (
  SELECT c.conv_id, 0 AS own, pos, digest, chars FROM convs c JOIN placed p ON p.conv_id = c.base WHERE pos < h
  UNION ALL SELECT c.conv_id, 1, pos, digest, chars FROM convs c JOIN placed p ON p.conv_id = c.conv_id WHERE pos >= h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, chars, string_agg(digest, '') OVER w AS prefix
  FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT prefix, any_value(depth) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY prefix),
branches AS (SELECT substr(prefix, 1, length(prefix) - 32) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN branches USING (prefix)),
under AS (
  SELECT p.prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w.chars) AS saved_tokens
  FROM whole w JOIN paths p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.prefix)
SELECT w.conv_id, w.depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN under USING (prefix) LEFT JOIN nodes up ON w.depth > 0 AND up.prefix = substr(w.prefix, 1, length(w.prefix) - 32)"""

STATEMENTS: dict[str, str] = {"op4_sainte_lague": SAINTE_LAGUE, "op11_prefix_trie": PREFIX_TRIE, "op12_rank_index": RANK_INDEX, "op13_markov_secrets": _secrets()}
