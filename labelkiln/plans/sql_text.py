"""DuckDB oracle SQL for the reader, feature and head queries."""

from __future__ import annotations

from labelkiln.plans.sql_common import COMMENTS, H52, with_
from labelkiln.sources.tasks import TASKS

CLEAN = "regexp_replace({x}, '[\\t\\r\\n]', ' ', 'g')"

PAIRS = f"""pairs AS (
  SELECT u.conv_id, u.turn, u.conv_id * 1000000 + u.turn AS pair_id, u.text AS raw_a, a.text AS raw_b,
         {CLEAN.format(x='u.text')} AS text_a, {CLEAN.format(x='a.text')} AS text_b,
         CASE WHEN {H52.format(x="'split:' || u.conv_id || ':' || u.turn")} % 10 < 8 THEN 'train' ELSE 'dev' END AS part
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

DOCS = """docs AS (SELECT *, CASE WHEN split = 'train' THEN 'train' ELSE 'dev' END AS part FROM comments)"""


def _lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def q_read_task(task: str) -> str:
    spec = TASKS[task]
    set_expr = f"CASE part WHEN 'train' THEN 'train' ELSE '{spec.dev_set}' END"
    ex = "SELECT set_type, row_idx, set_type || '-' || {tail} AS guid, {a} AS text_a, {b} AS text_b, {lab} AS label"
    if task in ("cola", "sst-2"):
        # cola has no header: line number = rank - 1; sst-2: line 0 is the header
        ln = "row_number() OVER (PARTITION BY part ORDER BY doc_id)" + (" - 1" if task == "cola" else "")
        body = ex.format(tail="row_idx", a=CLEAN.format(x="comment_text"), b="NULL::VARCHAR", lab="toxic::VARCHAR")
        return with_(COMMENTS, DOCS) + f"{body} FROM (SELECT *, {set_expr} AS set_type, {ln} AS row_idx FROM docs) t"
    if task == "abuse":
        text = "CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN 'NA' ELSE comment_text END"
        from labelkiln.sources.readers import PANDAS_NA
        na = ", ".join("'" + v.replace("'", "''") + "'" for v in PANDAS_NA)
        body = ex.format(tail="row_idx", a="t", b="NULL::VARCHAR", lab="IsAbuse::VARCHAR")
        return with_(COMMENTS, DOCS) + f"""{body}
FROM (SELECT *, {set_expr} AS set_type, {text} AS t,
             row_number() OVER (PARTITION BY part ORDER BY doc_id) - 1 AS row_idx FROM docs) x
WHERE t IS NOT NULL AND t NOT IN ({na})"""
    rn = "row_number() OVER (PARTITION BY part ORDER BY pair_id)"
    k2, k3 = "conv_id % 2", "conv_id % 3"
    where = ""
    a, b = "text_a", "text_b"
    if task == "mrpc":
        tail, lab = "row_idx", f"({k2})::VARCHAR"
    elif task in ("mnli", "mnli-mm"):
        tail, lab = "pair_id", f"({_lst(spec.labels)})[{k3} + 1]"
    elif task == "sts-b":
        tail, lab = "pair_id", "((turn % 6)::DOUBLE)::VARCHAR"
    elif task == "qqp":
        tail, lab, where = "pair_id", f"({k2})::VARCHAR", "WHERE conv_id % 7 <> 0"
    elif task == "qnli":
        tail, lab = "pair_id", f"CASE WHEN conv_id % 17 = 0 THEN 'not_sure' ELSE ({_lst(spec.labels)})[{k2} + 1] END"
    elif task == "rte":
        tail, lab = "pair_id", f"({_lst(spec.labels)})[{k2} + 1]"
    elif task == "wnli":
        tail, lab = "pair_id", f"({k2})::VARCHAR"
    elif task == "boolq":
        # JSONL: no header, line 0 is still skipped; texts are not cleaned
        rn = rn + " - 1"
        tail, lab, where, a, b = "pair_id", f"CASE WHEN {k2} = 1 THEN 'True' ELSE 'False' END", \
            "WHERE row_idx >= 1", "raw_a", "raw_b"
    else:
        raise KeyError(task)
    body = ex.format(tail=tail, a=a, b=b, lab=lab)
    return with_(PAIRS) + f"{body} FROM (SELECT *, {set_expr} AS set_type, {rn} AS row_idx FROM pairs) t {where}"


NAMED_TASKS = ("mrpc", "mnli", "cola", "sst-2", "sts-b", "qqp", "qnli", "rte", "wnli", "boolq", "abuse")


def q_named_record_examples() -> str:
    parts = []
    for task in NAMED_TASKS:
        spec = TASKS[task]
        if task in ("cola", "sst-2", "abuse"):
            parts.append(f"""SELECT '{task}' AS task, 'train' AS set_type, doc_id AS row_idx, doc_id::VARCHAR AS guid,
       comment_text AS text_a, NULL::VARCHAR AS text_b, ({_lst(spec.labels)})[toxic + 1] AS label FROM comments""")
        else:
            if spec.labels:
                lab = f"({_lst(spec.labels)})[conv_id % {len(spec.labels)} + 1]"
            else:
                lab = "((turn % 6)::DOUBLE)::VARCHAR"
            parts.append(f"""SELECT '{task}' AS task, 'train' AS set_type, pair_id AS row_idx, pair_id::VARCHAR AS guid,
       raw_a AS text_a, raw_b AS text_b, {lab} AS label FROM pairs""")
    return with_(COMMENTS, PAIRS) + "\nUNION ALL\n".join(parts)


def q_split_union() -> str:
    return with_(COMMENTS) + """
SELECT comment_text, threat, insult, toxic, IsAbuse, split,
       row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS row_idx FROM comments"""


def _all_examples() -> str:
    """Every task's examples from the files (union), tagged with the task."""
    parts = []
    for task in TASKS:
        q = q_read_task(task)
        # each task query is self-contained; wrap it as a derived table
        parts.append(f"SELECT '{task}' AS task, * FROM ({q}) t_{task.replace('-', '_')}")
    return "\nUNION ALL\n".join(parts)


def q_label_ids(quarantine_only: bool = False) -> str:
    cases = []
    for task, spec in TASKS.items():
        if spec.labels:
            cases.append(f"WHEN task = '{task}' THEN list_position({_lst(spec.labels)}, label) - 1")
    lid = "CASE " + " ".join(cases) + " END"
    reg = "CASE WHEN task = 'sts-b' THEN label::DOUBLE END"
    sql = f"""SELECT task, guid, label, ({lid})::BIGINT AS label_id, {reg} AS label_value
FROM ({_all_examples()}) e"""
    if quarantine_only:
        return f"SELECT task, guid, label FROM ({sql}) q WHERE label_id IS NULL AND task <> 'sts-b'"
    return sql


# ------------------------------------------------------------- features --
WORDS = "list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"

VOCAB = f"""dwords AS (SELECT unnest({WORDS.format(x='text')}) AS word FROM documents),
wc AS (SELECT word, count(*) AS cnt FROM dwords GROUP BY word),
letters AS (SELECT DISTINCT unnest(string_split(word, '')) AS ch FROM wc),
top_w AS (SELECT word, cnt FROM wc ORDER BY cnt DESC, word LIMIT 500),
sufs AS (SELECT s AS suf, sum(cnt) AS cnt FROM (
           SELECT CASE WHEN length(word) > 2 THEN right(word, 2) END AS s, cnt FROM wc
           UNION ALL SELECT CASE WHEN length(word) > 3 THEN right(word, 3) END, cnt FROM wc) x
         WHERE s IS NOT NULL GROUP BY s),
top_s AS (SELECT suf, cnt FROM sufs ORDER BY cnt DESC, suf LIMIT 100),
cand AS (SELECT * FROM (VALUES (0, 0, '[PAD]'), (0, 1, '[UNK]'), (0, 2, '[CLS]'), (0, 3, '[SEP]')) s(grp, rk, piece)
         UNION ALL SELECT 1, 0, ch FROM letters WHERE ch <> ''
         UNION ALL SELECT 2, 0, '##' || ch FROM letters WHERE ch <> ''
         UNION ALL SELECT 3, -cnt, word FROM top_w
         UNION ALL SELECT 4, -cnt, '##' || suf FROM top_s),
firsts AS (SELECT DISTINCT ON (piece) piece, grp, rk FROM cand ORDER BY piece, grp, rk),
vocab AS (SELECT piece, (row_number() OVER (ORDER BY grp, rk, piece) - 1)::INTEGER AS piece_id FROM firsts)"""


def wordpiece(words_cte: str) -> str:
    """``wp(word, ids)`` for the distinct words of ``words_cte(word)``."""
    return f"""wp AS (
  WITH RECURSIVE w(word, pos, ids, ok) AS (
    SELECT word, 0, []::INTEGER[], length(word) <= 100 FROM (SELECT DISTINCT word FROM {words_cte}) d
    UNION ALL
    SELECT w.word, m.e, list_append(w.ids, m.id), true
    FROM w, LATERAL (SELECT r.e, v.piece_id AS id FROM range(w.pos + 1, length(w.word) + 1) r(e)
                     JOIN vocab v ON v.piece = (CASE WHEN w.pos = 0 THEN '' ELSE '##' END)
                                              || substr(w.word, w.pos + 1, r.e - w.pos)
                     ORDER BY r.e DESC LIMIT 1) m
    WHERE w.ok AND w.pos < length(w.word))
  SELECT word, CASE WHEN max(pos) = length(word) THEN arg_max(ids, pos) ELSE [1] END AS ids FROM w GROUP BY word)"""


def q_tokens() -> str:
    return f"""SELECT doc_id, {WORDS.format(x='text')} AS words, len({WORDS.format(x='text')})::INTEGER AS n_words
FROM documents"""


def q_vocab_ids() -> str:
    return with_(VOCAB) + "SELECT piece, piece_id FROM vocab"


def q_wordpiece_words() -> str:
    return with_(VOCAB, wordpiece("dwords")) + "SELECT word, ids FROM wp"


def _zeros(n: str, v: int = 0) -> str:
    return f"list_transform(range({n}), lambda x: {v})"


def _segments(src: str, key: str, texts: list[str], budget: int) -> str:
    """``seg_<i>`` CTEs: per key, the piece ids of the first ``budget`` words."""
    ctes = []
    for i, t in enumerate(texts):
        ctes.append(f"""ex_{i} AS (SELECT {key}, unnest(range(len(ws))) AS pos, unnest(ws) AS word
          FROM (SELECT {key}, list_slice({WORDS.format(x=t)}, 1, {budget}) AS ws FROM {src}) s)""")
    ctes.append("allw AS (" + " UNION ALL ".join(f"SELECT word FROM ex_{i}" for i in range(len(texts))) + ")")
    ctes.append(wordpiece("allw"))
    for i in range(len(texts)):
        ctes.append(f"""seg_{i} AS (SELECT {key}, flatten(list(wp.ids ORDER BY pos)) AS ids
          FROM ex_{i} JOIN wp USING (word) GROUP BY {key})""")
    return ",\n".join(ctes)


def _pack(a: str, b: str | None, L: int, left: bool = False, pad_seg: int = 0, mask_zero: bool = True) -> str:
    ids = f"[2] || {a} || [3]" + (f" || {b} || [3]" if b else "")
    types = f"{_zeros(f'len({a}) + 2', 0)}" + (f" || {_zeros(f'len({b}) + 1', 1)}" if b else "")
    real, padv = (1, 0) if mask_zero else (0, 1)
    n = f"len({ids})"
    pad = f"{L} - {n}"
    cols = [(ids, _zeros(pad, 0)), (_zeros(n, real), _zeros(pad, padv)), (types, _zeros(pad, pad_seg))]
    out = []
    for name, (body, p) in zip(("input_ids", "attention_mask", "token_type_ids"), cols):
        expr = f"{p} || {body}" if left else f"{body} || {p}"
        out.append(f"({expr})::INTEGER[] AS {name}")
    return ", ".join(out)


def q_encode_single(L: int = 128, mask_zero: bool = True) -> str:
    budget = L - 2
    return with_(VOCAB, "docs_t AS (SELECT doc_id, text FROM documents)",
                 _segments("docs_t", "doc_id", ["text"], budget)) + f"""
SELECT d.doc_id, {_pack(f"list_slice(coalesce(s.ids, []::INTEGER[]), 1, {budget})", None, L, mask_zero=mask_zero)}
FROM docs_t d LEFT JOIN seg_0 s USING (doc_id)"""


def q_encode_pair(L: int = 128, left: bool = False, pad_seg: int = 0) -> str:
    B = L - 3
    half = (B + 1) // 2
    return with_(VOCAB, PAIRS, _segments("pairs", "pair_id", ["raw_a", "raw_b"], B)) + f"""
, lens AS (
  SELECT p.pair_id, coalesce(a.ids, []::INTEGER[]) AS ia, coalesce(b.ids, []::INTEGER[]) AS ib,
         least(len(coalesce(a.ids, [])), {B}) AS na, least(len(coalesce(b.ids, [])), {B}) AS nb
  FROM pairs p LEFT JOIN seg_0 a USING (pair_id) LEFT JOIN seg_1 b USING (pair_id)),
cut AS (
  SELECT pair_id, ia, ib,
         CASE WHEN na + nb <= {B} THEN na ELSE least(na, greatest({B} - nb, {half})) END AS ka,
         CASE WHEN na + nb <= {B} THEN nb ELSE {B} - least(na, greatest({B} - nb, {half})) END AS kb
  FROM lens)
SELECT pair_id, {_pack('list_slice(ia, 1, ka)', 'list_slice(ib, 1, kb)', L, left=left, pad_seg=pad_seg)}
FROM cut"""


def q_features_repeated_guid(L: int = 128) -> str:
    pairs = q_encode_pair(L)
    return f"""
SELECT 'train' AS set_type, pair_id AS row_idx,
       CASE WHEN pair_id % 5 = 0 THEN NULL ELSE 'train-' || (pair_id % 3) END AS guid,
       input_ids, attention_mask, token_type_ids, ((pair_id // 1000000) % 2)::BIGINT AS label_id, NULL::DOUBLE AS label_value
FROM ({pairs}) e"""


def q_encode_windows(L: int = 128) -> str:
    budget = L - 2
    return with_(VOCAB, "docs_t AS (SELECT doc_id, text FROM documents)",
                 _segments("docs_t", "doc_id", ["text"], 1_000_000_000)) + f"""
, w AS (SELECT d.doc_id, coalesce(s.ids, []::INTEGER[]) AS ids,
               unnest(range(greatest(1, (len(coalesce(s.ids, []::INTEGER[])) + {budget - 1}) // {budget}))) AS k
        FROM docs_t d LEFT JOIN seg_0 s USING (doc_id))
SELECT doc_id, k::INTEGER AS "window",
       {_pack(f"list_slice(ids, k * {budget} + 1, k * {budget} + {budget})", None, L)}
FROM w"""


def q_feature_length_check(L: int = 128) -> str:
    return f"""
SELECT count(*) AS n_rows,
       count_if(len(input_ids) <> {L} OR len(attention_mask) <> {L} OR len(token_type_ids) <> {L}) AS n_bad
FROM ({q_encode_single(L)}) f"""


def q_pad_count(L: int = 128) -> str:
    return f"""
SELECT doc_id, greatest(1, len(list_filter(input_ids, lambda x: x = 0)))::INTEGER AS pad_count
FROM ({q_encode_single(L)}) f"""


def q_preview_first_5(L: int = 128) -> str:
    """Features of the first five mrpc train examples (pair encode)."""
    B = L - 3
    half = (B + 1) // 2
    ex = q_read_task("mrpc")
    return with_(VOCAB, f"ex AS (SELECT * FROM ({ex}) e WHERE set_type = 'train' ORDER BY row_idx LIMIT 5)",
                 _segments("ex", "guid", ["text_a", "text_b"], B)) + f"""
, lens AS (
  SELECT e.guid, e.row_idx, e.label, coalesce(a.ids, []::INTEGER[]) AS ia, coalesce(b.ids, []::INTEGER[]) AS ib,
         least(len(coalesce(a.ids, [])), {B}) AS na, least(len(coalesce(b.ids, [])), {B}) AS nb
  FROM ex e LEFT JOIN seg_0 a USING (guid) LEFT JOIN seg_1 b USING (guid)),
cut AS (
  SELECT *, CASE WHEN na + nb <= {B} THEN na ELSE least(na, greatest({B} - nb, {half})) END AS ka,
            CASE WHEN na + nb <= {B} THEN nb ELSE {B} - least(na, greatest({B} - nb, {half})) END AS kb
  FROM lens)
SELECT guid, row_idx, {_pack('list_slice(ia, 1, ka)', 'list_slice(ib, 1, kb)', L)},
       list_position(['0', '1'], label)::BIGINT - 1 AS label_id
FROM cut"""


# ------------------------------------------------------------------ heads --
def dot(vec: str, j, d: int = 64) -> str:
    return f"list_sum(list_transform(range({d}), lambda i: {vec}[i + 1]::DOUBLE * sin({j} * {d} + i + 1)))"


def q_dense_head_scores() -> str:
    hidden = ", ".join(f"1.0 / (1.0 + exp(-{dot('embedding', j)}))" for j in range(64))
    return f"""
SELECT vec_id, label, round(1.0 / (1.0 + exp(-{dot('h', 0)})), 6) AS p
FROM (SELECT vec_id, label, [{hidden}] AS h FROM embeddings) t"""


def q_argmax_class() -> str:
    return f"""
SELECT vec_id, CASE WHEN z1 > z0 THEN 1 ELSE 0 END AS pred_class, round(z0, 6) AS z0, round(z1, 6) AS z1
FROM (SELECT vec_id, greatest(0.0, {dot('embedding', 0)}) AS z0, greatest(0.0, {dot('embedding', 1)}) AS z1
      FROM embeddings) t"""


def q_feature_sink(L: int = 128) -> str:
    return f"""SELECT f.*, l.toxic::BIGINT AS label FROM ({q_encode_single(L)}) f LEFT JOIN labels l ON l.doc_id = f.doc_id"""


def q_mean_pool(divisor: str, L: int = 128) -> str:
    """Sum of a document's token vectors (embedding row = token id) over all its windows,
    divided by their pad count ('pad') or their real-token count."""
    test = "=" if divisor == "pad" else "<>"
    return f"""
WITH f AS ({q_encode_windows(L)}),
n AS (SELECT doc_id, greatest(1, sum(len(list_filter(input_ids, lambda x: x {test} 0)))) AS dv FROM f GROUP BY doc_id),
cnt AS (SELECT doc_id, tok, count(*) AS c FROM (SELECT doc_id, unnest(input_ids) AS tok FROM f) GROUP BY doc_id, tok),
dims AS (SELECT c.doc_id, u.i, sum(c.c * u.x::DOUBLE) AS s
         FROM cnt c JOIN (SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM embeddings) u
           ON u.vec_id = c.tok % (SELECT count(*) FROM embeddings)
         GROUP BY c.doc_id, u.i)
SELECT d.doc_id, list(round(d.s / n.dv, 6) + 0.0 ORDER BY d.i) AS pooled FROM dims d JOIN n USING (doc_id) GROUP BY d.doc_id"""


def q_mean_pool_windows(divisor: str, L: int = 128) -> str:
    """Mean over a document's windows of their mean-pooled token vectors."""
    test = "=" if divisor == "pad" else "<>"
    return f"""
WITH f AS ({q_encode_windows(L)}),
pos AS (SELECT doc_id, "window", unnest(input_ids) AS tok, greatest(1, len(list_filter(input_ids, lambda x: x {test} 0))) AS dv
        FROM f),
cnt AS (SELECT doc_id, tok, sum(1.0::DOUBLE / dv) AS c FROM pos GROUP BY doc_id, tok),
nw AS (SELECT doc_id, count(*) AS n FROM f GROUP BY doc_id),
dims AS (SELECT c.doc_id, u.i, sum(c.c * u.x::DOUBLE) AS s
         FROM cnt c JOIN (SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM embeddings) u
           ON u.vec_id = c.tok % (SELECT count(*) FROM embeddings)
         GROUP BY c.doc_id, u.i)
SELECT d.doc_id, list(round(d.s / nw.n, 6) + 0.0 ORDER BY d.i) AS pooled FROM dims d JOIN nw USING (doc_id) GROUP BY d.doc_id"""


def q_stream_scores() -> str:
    hidden = ", ".join(f"1.0 / (1.0 + exp(-{dot('embedding', j)}))" for j in range(64))
    return f"""
SELECT vec_id, label, round(p, 6) AS p, CASE WHEN p >= 0.48::DOUBLE THEN 1 ELSE 0 END AS pred
FROM (SELECT vec_id, label, 1.0 / (1.0 + exp(-{dot('h', 0)})) AS p
      FROM (SELECT vec_id, label, [{hidden}] AS h FROM embeddings) t) s"""


def q_task_features(task: str, L: int = 128) -> str:
    """All examples of a task's files converted to features (single or pair
    encoding by the task, label id from the label list or the regression value)."""
    spec = TASKS[task]
    ex = q_read_task(task)
    if spec.labels:
        lab = f"(list_position({_lst(spec.labels)}, label) - 1)::BIGINT AS label_id, NULL::DOUBLE AS label_value"
    else:
        lab = "NULL::BIGINT AS label_id, label::DOUBLE AS label_value"
    if spec.text_b is None:
        B = L - 2
        return with_(VOCAB, f"ex AS (SELECT * FROM ({ex}) e)", _segments("ex", "guid", ["text_a"], B)) + f"""
SELECT e.set_type, e.row_idx, e.guid,
       {_pack(f"list_slice(coalesce(a.ids, []::INTEGER[]), 1, {B})", None, L)}, {lab}
FROM ex e LEFT JOIN seg_0 a USING (guid)"""
    B = L - 3
    half = (B + 1) // 2
    return with_(VOCAB, f"ex AS (SELECT * FROM ({ex}) e)", _segments("ex", "guid", ["text_a", "text_b"], B)) + f"""
, lens AS (
  SELECT e.set_type, e.guid, e.row_idx, e.label, coalesce(a.ids, []::INTEGER[]) AS ia,
         coalesce(b.ids, []::INTEGER[]) AS ib,
         least(len(coalesce(a.ids, [])), {B}) AS na, least(len(coalesce(b.ids, [])), {B}) AS nb
  FROM ex e LEFT JOIN seg_0 a USING (guid) LEFT JOIN seg_1 b USING (guid)),
cut AS (
  SELECT *, CASE WHEN na + nb <= {B} THEN na ELSE least(na, greatest({B} - nb, {half})) END AS ka,
            CASE WHEN na + nb <= {B} THEN nb ELSE {B} - least(na, greatest({B} - nb, {half})) END AS kb
  FROM lens)
SELECT set_type, row_idx, guid, {_pack('list_slice(ia, 1, ka)', 'list_slice(ib, 1, kb)', L)}, {lab}
FROM cut"""


def q_example_counts() -> str:
    return f"SELECT task, set_type, count(*) AS n_examples FROM ({_all_examples()}) e GROUP BY task, set_type"
