"""DuckDB SQL of the queries that SQL can express. Constants are written out."""

_WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS k
        FROM d, unnest(range(1, len(w) - 48)) AS t(i) WHERE len(w) >= 50),
early AS (SELECT k, min(doc_id) AS low FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, p FROM win JOIN early USING (k), unnest(range(i, i + 50)) AS t(p) WHERE doc_id > low),
stay AS (SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS kept, count(*) AS n
         FROM (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)) a
         ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.p = g.p GROUP BY a.doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN stay ON stay.doc_id = d.doc_id
"""

def _passes(table: str) -> str:
    """One pass over the units not taken yet: a prefix by hash of those that fit."""
    return f"""
  SELECT it + 1, source, h, size, n, gap - sum(took * size) OVER (PARTITION BY source), took FROM (
    SELECT *, CASE WHEN s <= gap THEN n WHEN h = nh THEN floor((gap - filled) / size)::BIGINT ELSE 0 END AS took FROM (
      SELECT *, coalesce(max(CASE WHEN s <= gap THEN s END) OVER (PARTITION BY source), 0) AS filled,
             min(CASE WHEN s > gap THEN h END) OVER (PARTITION BY source) AS nh FROM (
        SELECT it, source, h, size, n, gap, sum(size * n) OVER (PARTITION BY source ORDER BY h) AS s
        FROM {table} WHERE took = 0 AND size <= gap)))"""


OP4 = rf"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY source, h) AS nth FROM (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
           md5(concat_ws('|', '17', md5(coalesce('=' || CAST(doc_id AS VARCHAR), 'null')), md5(coalesce('=' || text, 'null')),
               md5(coalesce('=' || lang, 'null')), md5(coalesce('=' || source, 'null')),
               md5(coalesce('=' || CAST(n_chars AS VARCHAR), 'null')))) AS h FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS words,
             [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
fill AS (SELECT 0.0::DOUBLE AS level UNION
         SELECT (sum(words) - sum(CASE WHEN w * level > 3 * words THEN 3 * words ELSE 0 END))::BIGINT::DOUBLE
                / sum(CASE WHEN w * level > 3 * words THEN 0 ELSE w END)::BIGINT::DOUBLE
         FROM fill, s GROUP BY level),
t AS (SELECT source, words, CASE WHEN w * level > 3 * words THEN (3 * words)::DOUBLE ELSE w * level END AS target
      FROM s, (SELECT max(level) AS level FROM fill)),
g AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words)::BIGINT ELSE 0 END AS whole FROM t),
u AS (SELECT source, h, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
w1 AS (SELECT 0 AS it, u.source, h, size, n, target - whole * words AS gap, 0::BIGINT AS took
       FROM u JOIN g ON u.source IS NOT DISTINCT FROM g.source
  UNION ALL{_passes("w1")}),
k1 AS (SELECT source, h, size, n, sum(took)::BIGINT AS k FROM w1 GROUP BY ALL),
short AS (SELECT source, min(gap) AS short FROM w1 GROUP BY source),
over AS (SELECT k1.source, short, min({{'size': size, 'h': h}}) AS best FROM k1
         JOIN short ON short.source IS NOT DISTINCT FROM k1.source WHERE k < n GROUP BY ALL),
w2 AS (SELECT 0 AS it, k1.source, h, size, n, best.size - short AS gap, 0::BIGINT AS took
       FROM k1 JOIN over ON k1.source IS NOT DISTINCT FROM over.source WHERE k = n
  UNION ALL{_passes("w2")}),
better AS (SELECT over.source, best.h AS h FROM over
           LEFT JOIN (SELECT source, min(gap) AS gap FROM w2 GROUP BY source) b ON b.source IS NOT DISTINCT FROM over.source
           WHERE coalesce(gap, best.size - short) < short),
given AS (SELECT source, h, sum(took)::BIGINT AS k FROM w2 GROUP BY ALL),
k2 AS (SELECT k1.source, k1.h, CASE WHEN better.h IS NULL THEN k1.k WHEN better.h = k1.h THEN k1.k + 1
                                    ELSE k1.k - coalesce(given.k, 0) END AS k
       FROM k1 LEFT JOIN better ON better.source IS NOT DISTINCT FROM k1.source
       LEFT JOIN given ON given.source IS NOT DISTINCT FROM k1.source AND given.h = k1.h)
SELECT d.doc_id, d.size, g.words AS source_size, g.target,
       (d.size * CASE WHEN g.words > 0 THEN g.whole + CASE WHEN nth <= k2.k THEN 1 ELSE 0 END ELSE 0 END)::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN k2 ON d.source IS NOT DISTINCT FROM k2.source AND d.h = k2.h
"""

OP6 = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
           FROM documents),
tri AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS k
        FROM d, unnest(range(1, len(w) - 1)) AS t(i) WHERE len(w) >= 3),
again AS (SELECT doc_id, k FROM tri GROUP BY doc_id, k HAVING count(*) > 1),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM tri JOIN again USING (doc_id, k), unnest([i, i + 1, i + 2]) AS t(p)
          GROUP BY doc_id),
c AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN cover ON cover.doc_id = d.doc_id),
r AS (SELECT *, CASE WHEN word_chars > 0 THEN least(n_symbols * 1000 // word_chars, 1000) ELSE 0 END AS symbols,
             CASE WHEN n_lines > 0 THEN least(n_dup_lines * 1000 // n_lines, 1000) ELSE 0 END AS dup_lines,
             CASE WHEN n_words > 0 THEN least(n_repeat_words * 1000 // n_words, 1000) ELSE 0 END AS repeats FROM c),
e AS (SELECT lang, source, 'symbols' AS kind, symbols AS bin, 0.85 AS p FROM r UNION ALL
      SELECT lang, source, 'dup_lines', dup_lines, 0.98 FROM r UNION ALL
      SELECT lang, source, 'repeats', repeats, 0.95 FROM r),
m AS (SELECT GROUPING(source) AS any_source, GROUPING(lang) AS any_lang, lang, source, kind, count(*) AS docs,
             3 * quantile_disc(bin, 0.85) FILTER (p = 0.85) AS s, 3 * quantile_disc(bin, 0.98) FILTER (p = 0.98) AS dl,
             3 * quantile_disc(bin, 0.95) FILTER (p = 0.95) AS rp
      FROM e GROUP BY GROUPING SETS ((lang, source, kind), (lang, kind), (kind))),
b AS (SELECT o.lang, o.source, o.kind, CASE WHEN o.docs >= 100 THEN coalesce(o.s, o.dl, o.rp)
             WHEN l.docs >= 100 THEN coalesce(l.s, l.dl, l.rp) ELSE coalesce(a.s, a.dl, a.rp) END AS most
      FROM m o JOIN m l ON l.any_source = 1 AND l.any_lang = 0 AND l.kind = o.kind AND l.lang IS NOT DISTINCT FROM o.lang
      JOIN m a ON a.any_lang = 1 AND a.kind = o.kind WHERE o.any_source = 0),
x AS (SELECT lang, source, max(CASE WHEN kind = 'symbols' THEN most END) AS s, max(CASE WHEN kind = 'dup_lines' THEN most END) AS dl,
             max(CASE WHEN kind = 'repeats' THEN most END) AS rp FROM b GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND symbols <= s AND dup_lines <= dl AND repeats <= rp AS kept
FROM r JOIN x ON r.lang IS NOT DISTINCT FROM x.lang AND r.source IS NOT DISTINCT FROM x.source
"""

OP7 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(?:s>|INST\]))', '\1\\\2', 'g')) AS n,
             length(regexp_replace(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '\', '\\'),
                                   '([<\[])(/?(?:s>|INST\]))', '\1\\\2', 'g')) AS r FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' THEN 7 + n ELSE 16 + r + n END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII letters and U+00C0 to U+00FF, in UTF-8."""
    octets = (f"flatten(list_transform(split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] "
              "ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))")
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    return (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda a, b: "
            f"list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: {step})))")


OP11 = f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
             translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
      FROM r GROUP BY ALL),
h AS (SELECT w, n, {_crc32("id || ':' || w")} AS h FROM d),
t AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n
      FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM t WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
c AS (SELECT word, n, length(word) AS len, i, substr(word, 1, i) || substr(word, i + 2) AS key
      FROM v, unnest(range(length(word))) AS u(i)),
near AS (SELECT a.word, b.word AS other, b.n FROM c a JOIN c b ON a.key = b.key AND a.i = b.i AND a.len = b.len
           AND a.word <> b.word
         UNION SELECT v.word, c.word, c.n FROM c JOIN v ON c.key = v.word
         UNION SELECT c.word, v.word, v.n FROM c JOIN v ON c.key = v.word),
best AS (SELECT word, count(*) AS n_near, min({{'n': -n, 'w': other}}) AS b FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 2 * v.n THEN b.w END AS form,
             CASE WHEN -b.n >= 2 * v.n THEN -b.n END AS form_n
      FROM v LEFT JOIN best ON best.word = v.word),
walk AS (SELECT word, word AS at FROM f
         UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN walk ON walk.word = f.word JOIN f AS e ON e.word = walk.at AND e.form IS NULL
"""

OP12 = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT c, c - c % 100 AS d, {_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM t),
given AS (SELECT c.c, pos, role, text FROM c JOIN t ON t.c = c.d AND pos <= h),
taken AS (SELECT c.c, c.h, count(given.c) AS n FROM c LEFT JOIN given ON given.c = c.c GROUP BY ALL),
b AS (SELECT * FROM given UNION ALL
      SELECT t.c, pos - h + n, role, text FROM t JOIN taken ON taken.c = t.c WHERE pos > h),
p AS (SELECT c, pos AS depth, length(text) AS chars,
             string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY pos)
               OVER (PARTITION BY c ORDER BY pos) AS k FROM b
      UNION ALL SELECT c, 0, 0, '' FROM c),
n AS (SELECT md5(k) AS k, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY ALL),
q AS (SELECT c, depth, md5(k) AS k FROM p),
up AS (SELECT DISTINCT a.k, a.depth, b.k AS pk, b.depth AS pdepth FROM q a JOIN q b ON b.c = a.c AND b.depth = a.depth - 1),
kids AS (SELECT pk AS k, pdepth AS depth, count(*) AS n_children FROM up GROUP BY ALL),
under AS (SELECT DISTINCT a.k, a.depth, b.k AS bk, b.depth AS bdepth FROM q a JOIN q b ON b.c = a.c AND b.depth >= a.depth),
s AS (SELECT under.k, under.depth, sum((n.n_convs - 1) * n.chars)::BIGINT AS saved_tokens,
             count(*) FILTER (n_children IS NULL) AS n_leaves
      FROM under JOIN n ON n.k = bk AND n.depth = bdepth LEFT JOIN kids ON kids.k = bk AND kids.depth = bdepth GROUP BY ALL),
last AS (SELECT c, max(depth) AS depth FROM q GROUP BY c),
e AS (SELECT k, depth, string_agg(c, ',' ORDER BY c) AS ends FROM q JOIN last USING (c, depth) GROUP BY ALL)
SELECT n.conv_id, n.depth, parent.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM n JOIN s USING (k, depth) LEFT JOIN kids USING (k, depth) LEFT JOIN e USING (k, depth)
LEFT JOIN up USING (k, depth) LEFT JOIN n AS parent ON parent.k = up.pk AND parent.depth = up.pdepth
"""

OP13 = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
ok AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0
       AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT r AS a, r AS b FROM e UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
c AS (SELECT reach.a AS r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY reach.a),
n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN c USING (r) LEFT JOIN n USING (r)
"""
