"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: straightforward SQL (windows over
whole groups, cross joins with the threshold grid) that states what each
query means. The derived inputs are common table expressions below.
"""

from __future__ import annotations

H52 = "('0x' || substr(md5({x}), 1, 13))::BIGINT"
BYTE = "('0x' || substr(md5({x}), 1, 2))::INTEGER / 255.0::DOUBLE"

COMMENTS = f"""comments AS (
  SELECT l.doc_id, d.text AS comment_text,
         CAST(l.toxic = 1 AND l.quality = 0 AS INTEGER) AS threat,
         CAST(1 - l.quality AS INTEGER) AS insult,
         CAST(l.toxic AS INTEGER) AS toxic,
         CAST(l.toxic = 1 OR l.quality = 0 AS INTEGER) AS IsAbuse,
         CASE WHEN {H52.format(x="'split:' || l.doc_id")} % 10 < 8 THEN 'train'
              WHEN {H52.format(x="'split:' || l.doc_id")} % 10 = 8 THEN 'val'
              ELSE 'test' END AS split
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""

LABELLED = """labelled AS (
  SELECT doc_id, split, 'threat' AS label_name, threat AS y FROM comments
  UNION ALL SELECT doc_id, split, 'insult', insult FROM comments
  UNION ALL SELECT doc_id, split, 'toxic', toxic FROM comments
  UNION ALL SELECT doc_id, split, 'IsAbuse', IsAbuse FROM comments)"""

SCORED = f"""scored AS (
  SELECT u.doc_id, u.split, u.label_name, u.y, e.encoder, CAST(ep.epoch AS INTEGER) AS epoch,
         {BYTE.format(x="e.encoder || ':' || u.label_name || ':' || ep.epoch || ':' || u.doc_id")} AS p
  FROM labelled u CROSS JOIN (VALUES ('base'), ('tuned')) e(encoder) CROSS JOIN range(1, 6) ep(epoch))"""

CONFUSION = """conf AS (
  SELECT split, encoder, label_name, epoch,
         count_if(p >= 0.48::DOUBLE AND y = 1) AS tp,
         count_if(p >= 0.48::DOUBLE AND y <> 1) AS fp,
         count_if(p < 0.48::DOUBLE AND y = 1) AS fn,
         count_if(p < 0.48::DOUBLE AND y <> 1) AS tn,
         count(*) AS n
  FROM scored GROUP BY split, encoder, label_name, epoch)"""

ACC = "(tp + tn)::DOUBLE / n"
F1 = "CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0.0 END"

AUC = """auc AS (
  SELECT split, encoder, label_name, epoch,
         CASE WHEN sum(pos) * sum(neg) > 0
              THEN sum(pos * (neg_below + neg::DOUBLE / 2)) / (sum(pos) * sum(neg))::DOUBLE END AS roc_auc
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split, encoder, label_name, epoch ORDER BY p
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM (SELECT split, encoder, label_name, epoch, p, count_if(y = 1) AS pos, count_if(y <> 1) AS neg
              FROM scored GROUP BY split, encoder, label_name, epoch, p) t) r
  GROUP BY split, encoder, label_name, epoch)"""

HISTORY = f"""hist AS (
  SELECT split, encoder, label_name, epoch, 'acc' AS metric, {ACC} AS value FROM conf
  UNION ALL SELECT split, encoder, label_name, epoch, 'f1', {F1} FROM conf
  UNION ALL SELECT split, encoder, label_name, epoch, 'roc_auc', roc_auc FROM auc)"""

TASK_CLASSES = [("cola", 2), ("sst-2", 2), ("mrpc", 2), ("qqp", 2), ("mnli", 3), ("mnli-mm", 3),
                ("qnli", 2), ("rte", 2), ("wnli", 2), ("hans", 2), ("boolq", 2), ("abuse", 2), ("xnli", 3)]
TASK_VALUES = ", ".join(f"('{t}', {k})" for t, k in TASK_CLASSES)

TASK_PRED = f"""task_pred AS (
  SELECT task, id,
         CAST(CASE WHEN {BYTE.replace(' / 255.0::DOUBLE', '').format(x="task || ':' || id")} < 200
                   THEN lab ELSE (lab + 1) % k END AS DOUBLE) AS pred,
         CAST(lab AS DOUBLE) AS label
  FROM (SELECT t.task, t.k, l.doc_id AS id,
               CAST(CASE WHEN t.k = 2 THEN l.toxic ELSE l.doc_id % 3 END AS INTEGER) AS lab
        FROM labels l CROSS JOIN (VALUES {TASK_VALUES}) t(task, k)) x
  UNION ALL
  SELECT 'sts-b', conv_id * 1000000 + turn,
         (turn % 6)::DOUBLE * 0.8::DOUBLE + {BYTE.format(x="'stsb:' || conv_id || ':' || turn")},
         (turn % 6)::DOUBLE
  FROM conversations)"""

TASK_METRIC_SPEC = [("cola", "mcc"), ("sst-2", "acc"), ("mrpc", "acc"), ("mrpc", "f1"), ("mrpc", "acc_and_f1"),
                    ("sts-b", "pearson"), ("sts-b", "spearmanr"), ("sts-b", "corr"), ("qqp", "acc"),
                    ("qqp", "f1"), ("qqp", "acc_and_f1"), ("mnli", "acc"), ("mnli-mm", "acc"), ("qnli", "acc"),
                    ("rte", "acc"), ("wnli", "acc"), ("hans", "acc"), ("boolq", "acc"), ("abuse", "acc"),
                    ("xnli", "acc")]

SHUFFLED_TRAIN = f"""train_idx AS (
  SELECT doc_id, row_number() OVER (ORDER BY {H52.format(x="'42:' || doc_id")}, doc_id) - 1 AS row_idx
  FROM comments WHERE split = 'train')"""

BCE = """bce AS (
  SELECT s.encoder, s.label_name, s.epoch, (t.row_idx // 10)::BIGINT AS batch_id,
         avg(-(s.y * CASE WHEN s.p > 0 THEN greatest(ln(s.p), -100.0) ELSE -100.0 END
               + (1 - s.y) * CASE WHEN s.p < 1 THEN greatest(ln(1 - s.p), -100.0) ELSE -100.0 END)) AS loss
  FROM scored s JOIN train_idx t USING (doc_id)
  WHERE s.split = 'train'
  GROUP BY s.encoder, s.label_name, s.epoch, batch_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def q_confusion_by_label() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION) + "SELECT * FROM conf"


def q_accuracy_f1_by_label() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION) + f"""
SELECT split, encoder, label_name, epoch, round({ACC}, 6) AS acc, round({F1}, 6) AS f1 FROM conf"""


def q_acc_and_f1() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION) + f"""
SELECT split, encoder, label_name, epoch, round({ACC}, 6) AS acc, round({F1}, 6) AS f1,
       round(({ACC} + {F1}) / 2, 6) AS acc_and_f1 FROM conf"""


def q_mcc() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION) + """
SELECT split, encoder, label_name, epoch,
       round(CASE WHEN (tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn) > 0
                  THEN (tp::DOUBLE * tn - fp::DOUBLE * fn)
                       / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn))
                  ELSE 0.0 END, 6) AS mcc
FROM conf"""


def q_roc_auc_by_label() -> str:
    return with_(COMMENTS, LABELLED, SCORED, AUC) + """
SELECT split, encoder, label_name, epoch, round(roc_auc, 6) AS roc_auc FROM auc"""


def _ranks(src: str, col: str, out: str) -> str:
    return f"""(rank() OVER (PARTITION BY task ORDER BY {col})
        + (count(*) OVER (PARTITION BY task, {col}) - 1) / 2.0)::DOUBLE AS {out}"""


PEARSON = "CASE WHEN stddev_pop({a}) * stddev_pop({b}) > 0 THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END"


def q_pearson_spearman() -> str:
    return with_(TASK_PRED) + f"""
SELECT task, round({PEARSON.format(a='pred', b='label')}, 6) AS pearson,
       round({PEARSON.format(a='ra', b='rb')}, 6) AS spearmanr,
       round(({PEARSON.format(a='pred', b='label')} + {PEARSON.format(a='ra', b='rb')}) / 2, 6) AS corr
FROM (SELECT task, pred, label, {_ranks('task_pred', 'pred', 'ra')}, {_ranks('task_pred', 'label', 'rb')}
      FROM task_pred WHERE task = 'sts-b') r
GROUP BY task"""


def q_task_metrics_dispatch() -> str:
    spec = ", ".join(f"('{t}', '{m}')" for t, m in TASK_METRIC_SPEC)
    return with_(TASK_PRED) + f"""
, cls AS (
  SELECT task, count_if(pred = 1 AND label = 1) AS tp, count_if(pred = 1 AND label <> 1) AS fp,
         count_if(pred <> 1 AND label = 1) AS fn, count_if(pred <> 1 AND label <> 1) AS tn,
         count(*) AS n, count_if(pred = label) AS correct
  FROM task_pred WHERE task <> 'sts-b' GROUP BY task),
cls_m AS (
  SELECT task, 'acc' AS metric, correct::DOUBLE / n AS value FROM cls
  UNION ALL SELECT task, 'f1', {F1} FROM cls
  UNION ALL SELECT task, 'acc_and_f1', (correct::DOUBLE / n + {F1}) / 2 FROM cls
  UNION ALL SELECT task, 'mcc', CASE WHEN (tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn) > 0
                  THEN (tp::DOUBLE * tn - fp::DOUBLE * fn)
                       / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0.0 END FROM cls),
ranked AS (SELECT task, pred, label, {_ranks('task_pred', 'pred', 'ra')}, {_ranks('task_pred', 'label', 'rb')}
           FROM task_pred WHERE task = 'sts-b'),
reg AS (SELECT task, {PEARSON.format(a='pred', b='label')} AS pearson, {PEARSON.format(a='ra', b='rb')} AS spearmanr
        FROM ranked GROUP BY task),
reg_m AS (SELECT task, 'pearson' AS metric, pearson AS value FROM reg
          UNION ALL SELECT task, 'spearmanr', spearmanr FROM reg
          UNION ALL SELECT task, 'corr', (pearson + spearmanr) / 2 FROM reg),
spec(task, metric) AS (VALUES {spec})
SELECT m.task, m.metric, round(m.value, 6) AS value
FROM (SELECT * FROM cls_m UNION ALL SELECT * FROM reg_m) m JOIN spec USING (task, metric)"""


def q_task_metrics_custom() -> str:
    return with_(TASK_PRED) + """
, k AS (SELECT task, pred, label, count(*) AS n, any_value(total) AS total FROM task_pred
      JOIN (SELECT task, count(*) AS total FROM task_pred GROUP BY task) USING (task)
      WHERE task IN ('mnli', 'xnli') GROUP BY task, pred, label),
a AS (SELECT task, pred AS c, sum(n) / any_value(total) AS p FROM k GROUP BY task, pred),
b AS (SELECT task, label AS c, sum(n) / any_value(total) AS p FROM k GROUP BY task, label),
chance AS (SELECT task, sum(a.p * b.p) AS pe FROM a JOIN b USING (task, c) GROUP BY task),
same AS (SELECT task, sum(CASE WHEN pred = label THEN n ELSE 0 END) / any_value(total) AS po FROM k GROUP BY task)
SELECT task, 'kappa' AS metric, round((po - pe) / (1 - pe), 6) AS value FROM same JOIN chance USING (task)
UNION ALL SELECT task, 'acc', round(avg((pred = label)::INT), 6) FROM task_pred WHERE task = 'mnli' GROUP BY task
UNION ALL SELECT task, 'balanced_acc', round((avg(CASE WHEN label = 1 THEN (pred = label)::INT END)
                                              + avg(CASE WHEN label <> 1 THEN (pred = label)::INT END)) / 2, 6)
          FROM task_pred WHERE task = 'cola' GROUP BY task
UNION ALL SELECT task, 'mae', round(avg(abs(pred - label)), 6) FROM task_pred WHERE task = 'sts-b' GROUP BY task"""


def q_pred_label_alignment_check() -> str:
    return with_(COMMENTS, LABELLED, SCORED) + """
SELECT split, label_name, encoder, epoch, count(*) AS n_keys,
       count_if(doc_id % 11 = 0) AS n_missing_label, count_if(doc_id % 7 = 0) AS n_missing_pred
FROM scored WHERE doc_id % 7 <> 0 OR doc_id % 11 <> 0 GROUP BY split, label_name, encoder, epoch"""


def q_bce_loss_by_batch() -> str:
    return with_(COMMENTS, LABELLED, SCORED, SHUFFLED_TRAIN, BCE) + """
SELECT encoder, label_name, epoch, batch_id, round(loss, 6) AS loss FROM bce"""


def q_loss_tail(k: int) -> str:
    return with_(COMMENTS, LABELLED, SCORED, SHUFFLED_TRAIN, BCE) + f"""
SELECT encoder, label_name, epoch, batch_id, round(loss, 6) AS loss
FROM (SELECT *, row_number() OVER (PARTITION BY encoder, label_name ORDER BY epoch DESC, batch_id DESC) AS rn
      FROM bce) t WHERE rn <= {k}"""


def _dot(vec: str, j: int | str, d: int = 64) -> str:
    return f"list_sum(list_transform(range({d}), lambda i: {vec}[i + 1]::DOUBLE * sin({j} * {d} + i + 1)))"


def q_ce_loss_by_batch() -> str:
    return f"""
WITH z AS (
  SELECT (row_number() OVER (ORDER BY {H52.format(x="'42:' || vec_id")}, vec_id) - 1) // 10 AS batch_id,
         label % 2 AS y, greatest(0.0, {_dot('embedding', 0)}) AS z0, greatest(0.0, {_dot('embedding', 1)}) AS z1
  FROM embeddings)
SELECT batch_id::BIGINT AS batch_id,
       round(avg(greatest(z0, z1) + ln(exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1)))
                 - CASE WHEN y = 1 THEN z1 ELSE z0 END), 6) AS loss
FROM z GROUP BY batch_id"""


def _grid(start: float, stop: float, num: int) -> str:
    return f"""grid AS (
  SELECT CASE WHEN j = {num - 1} THEN {stop!r}::DOUBLE
              ELSE j * (({stop!r}::DOUBLE - {start!r}::DOUBLE) / {num - 1}) + {start!r}::DOUBLE END AS threshold
  FROM range(0, {num}) r(j))"""


def _sweep(label: str, start: float, stop: float, num: int) -> str:
    return f"""sweep AS (
  SELECT s.split, s.encoder, s.epoch, g.threshold,
         count_if(s.p >= g.threshold AND s.y = 1) AS tp, count_if(s.p >= g.threshold AND s.y <> 1) AS fp,
         count_if(s.p < g.threshold AND s.y = 1) AS fn, count_if(s.p < g.threshold AND s.y <> 1) AS tn
  FROM scored s CROSS JOIN grid g WHERE s.label_name = '{label}'
  GROUP BY s.split, s.encoder, s.epoch, g.threshold)"""


def q_threshold_sweep_f1(label, start, stop, num) -> str:
    return with_(COMMENTS, LABELLED, SCORED, _grid(start, stop, num), _sweep(label, start, stop, num)) + f"""
SELECT split, encoder, epoch, round(threshold, 6) AS threshold, tp, fp, fn, tn, round({F1}, 6) AS f1 FROM sweep"""


def _mean(label, start, stop, num) -> str:
    return f"""mean_f1 AS (SELECT split, encoder, threshold, avg({F1}) AS mean_f1 FROM sweep
                GROUP BY split, encoder, threshold)"""


def q_threshold_mean_f1(label, start, stop, num) -> str:
    return with_(COMMENTS, LABELLED, SCORED, _grid(start, stop, num), _sweep(label, start, stop, num),
                 _mean(label, start, stop, num)) + """
SELECT split, encoder, round(threshold, 6) AS threshold, round(mean_f1, 6) AS mean_f1 FROM mean_f1"""


def q_best_threshold(label, start, stop, num) -> str:
    return with_(COMMENTS, LABELLED, SCORED, _grid(start, stop, num), _sweep(label, start, stop, num),
                 _mean(label, start, stop, num)) + """
SELECT split, encoder, round(first(threshold ORDER BY round(mean_f1, 12) DESC, threshold ASC), 6) AS best_threshold,
       round(max(mean_f1), 6) AS best_mean_f1
FROM mean_f1 GROUP BY split, encoder"""


def q_running_best_epoch() -> str:
    return with_(COMMENTS, LABELLED, SCORED, AUC) + """
SELECT split, encoder, label_name, epoch, round(roc_auc, 6) AS value,
       (prev IS NULL OR roc_auc > prev) AS saved
FROM (SELECT *, max(roc_auc) OVER (PARTITION BY split, encoder, label_name ORDER BY epoch
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM auc) t"""


def q_best_epoch() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION, AUC, HISTORY) + """
SELECT split, encoder, label_name, metric,
       first(epoch ORDER BY value DESC NULLS LAST, epoch ASC) AS best_epoch, round(max(value), 6) AS best_value
FROM hist GROUP BY split, encoder, label_name, metric"""


def q_metric_history_arrays() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION, AUC, HISTORY) + """
SELECT split, encoder, label_name, metric, list(round(value, 6) ORDER BY epoch) AS "values"
FROM hist GROUP BY split, encoder, label_name, metric"""


def q_encoder_pivot() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION, AUC, HISTORY) + """
SELECT split, label_name, metric, epoch,
       first(round(value, 6)) FILTER (WHERE encoder = 'base') AS base,
       first(round(value, 6)) FILTER (WHERE encoder = 'tuned') AS tuned
FROM hist GROUP BY split, label_name, metric, epoch"""


LIMITED = f"""shuffled AS (
  SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY split ORDER BY {H52.format(x="'42:' || doc_id")}, doc_id) - 1
                        AS row_idx FROM comments c) t
  WHERE row_idx < CASE split WHEN 'train' THEN 30000 WHEN 'val' THEN 3500 WHEN 'test' THEN 3500 END)"""

SHUFFLED = f"""shuffled AS (
  SELECT c.*, row_number() OVER (PARTITION BY split ORDER BY {H52.format(x="'42:' || doc_id")}, doc_id) - 1 AS row_idx
  FROM comments c)"""

TRAIN_LONG = """train_long AS (
  SELECT doc_id, row_idx, 'threat' AS label_name, threat AS y FROM shuffled WHERE split = 'train'
  UNION ALL SELECT doc_id, row_idx, 'insult', insult FROM shuffled WHERE split = 'train'
  UNION ALL SELECT doc_id, row_idx, 'toxic', toxic FROM shuffled WHERE split = 'train'
  UNION ALL SELECT doc_id, row_idx, 'IsAbuse', IsAbuse FROM shuffled WHERE split = 'train')"""


def q_shuffle_limit() -> str:
    return with_(COMMENTS, LIMITED) + "SELECT split, doc_id, row_idx FROM shuffled"


def q_batches_of_10() -> str:
    return with_(COMMENTS, SHUFFLED) + "SELECT split, doc_id, row_idx, (row_idx // 10)::BIGINT AS batch_id FROM shuffled"


def q_class_counts() -> str:
    return with_(COMMENTS, SHUFFLED, TRAIN_LONG) + "SELECT label_name, y, count(*) AS n FROM train_long GROUP BY label_name, y"


def q_class_weights() -> str:
    return with_(COMMENTS, SHUFFLED, TRAIN_LONG) + """
SELECT label_name, y, count(*) AS n, round(1.0::DOUBLE / count(*), 6) AS weight FROM train_long GROUP BY label_name, y"""


def q_row_weights() -> str:
    return with_(COMMENTS, SHUFFLED, TRAIN_LONG) + """
SELECT t.doc_id, t.label_name, t.y, round(1.0::DOUBLE / c.n, 6) AS weight
FROM train_long t JOIN (SELECT label_name, y, count(*) AS n FROM train_long GROUP BY label_name, y) c
  USING (label_name, y)"""


RESAMPLED = f"""cnt AS (SELECT label_name, count_if(y = 0) AS n0, count_if(y = 1) AS n1 FROM train_long GROUP BY label_name),
cidx AS (SELECT label_name, y, doc_id,
                row_number() OVER (PARTITION BY label_name, y ORDER BY {H52.format(x="'42:' || doc_id")}, doc_id) - 1 AS cidx
         FROM train_long),
draws AS (SELECT t.label_name, t.row_idx AS draw, c.n0, c.n1,
                 CASE WHEN c.n0 = 0 THEN 1 WHEN c.n1 = 0 THEN 0
                      ELSE {H52.format(x="'draw:' || t.label_name || ':' || t.row_idx || ':class'")} % 2 END AS cls
          FROM train_long t JOIN cnt c USING (label_name)),
pick AS (SELECT *, {H52.format(x="'draw:' || label_name || ':' || draw || ':idx'")}
                   % CASE WHEN cls = 1 THEN n1 ELSE n0 END AS idx FROM draws),
r AS (
  SELECT p.label_name, p.draw::BIGINT AS draw, c.doc_id, c.y, (p.draw // 10)::BIGINT AS batch_id
FROM pick p JOIN cidx c ON c.label_name = p.label_name AND c.y = p.cls AND c.cidx = p.idx)"""


def q_weighted_resample() -> str:
    return with_(COMMENTS, SHUFFLED, TRAIN_LONG, RESAMPLED) + "SELECT * FROM r"


def q_minibatch_checks() -> str:
    return with_(COMMENTS, LABELLED) + """
SELECT DISTINCT label_name, TRUE AS loss_falls, TRUE AS beats_constant FROM labelled"""


def q_fitted_threshold_sweep() -> str:
    return with_(COMMENTS, LABELLED) + """
SELECT DISTINCT label_name, 26::BIGINT AS n_points, TRUE AS recount_equal FROM labelled"""


def q_model_store_rows() -> str:
    return with_(COMMENTS, LABELLED) + """
SELECT encoder, label_name, count(*) AS n_rows, count(*) AS n_equal, TRUE AS best_kept
FROM labelled, (VALUES ('base'), ('tuned')) AS e(encoder) WHERE split = 'train' GROUP BY encoder, label_name"""


def q_weighted_resample_any() -> str:
    return with_(COMMENTS, LABELLED) + """
SELECT label_name, count(*) AS n_draws, count(*) AS n_numbers, count(*) - 1 AS last, 0::BIGINT AS n_unknown, TRUE AS shares_near
FROM labelled GROUP BY label_name"""


def q_bce_loss_resampled_batches() -> str:
    return with_(COMMENTS, LABELLED, SCORED, SHUFFLED, TRAIN_LONG, RESAMPLED) + """
SELECT encoder, label_name, epoch, batch_id,
       round(avg(-(y * CASE WHEN p > 0 THEN greatest(ln(p), -100.0) ELSE -100.0 END
                   + (1 - y) * CASE WHEN p < 1 THEN greatest(ln(1 - p), -100.0) ELSE -100.0 END)), 6) AS loss
FROM (SELECT r.label_name, r.batch_id, s.encoder, s.epoch, s.y, s.p FROM r
      JOIN (SELECT * FROM scored WHERE split = 'train') s ON s.doc_id = r.doc_id AND s.label_name = r.label_name) t
GROUP BY encoder, label_name, epoch, batch_id"""


def q_label_vectors() -> str:
    return with_(COMMENTS) + """
SELECT doc_id, split, [threat::FLOAT, insult::FLOAT, toxic::FLOAT, IsAbuse::FLOAT] AS labels FROM comments"""


def q_metric_history_sink() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION, AUC, HISTORY) + """
SELECT split, encoder, label_name, epoch, metric, round(value, 6) AS value FROM hist"""


def q_metrics_report() -> str:
    return with_(COMMENTS, LABELLED, SCORED, CONFUSION, AUC, HISTORY, SHUFFLED_TRAIN, BCE) + """
, arrays AS (
  SELECT encoder, label_name,
         list(round(value, 6) ORDER BY epoch) FILTER (WHERE metric = 'acc') AS acc_by_epoch,
         list(round(value, 6) ORDER BY epoch) FILTER (WHERE metric = 'f1') AS f1_by_epoch,
         list(round(value, 6) ORDER BY epoch) FILTER (WHERE metric = 'roc_auc') AS roc_auc_by_epoch
  FROM hist WHERE split = 'val' GROUP BY encoder, label_name),
tail AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY encoder, label_name
                                              ORDER BY epoch DESC, batch_id DESC) AS rn FROM bce) t
  WHERE rn <= 50),
losses AS (SELECT encoder, label_name, list(round(loss, 6) ORDER BY epoch, batch_id) AS last_losses
           FROM tail GROUP BY encoder, label_name)
SELECT a.encoder, a.label_name, a.acc_by_epoch, a.f1_by_epoch, a.roc_auc_by_epoch, l.last_losses
FROM arrays a JOIN losses l USING (encoder, label_name)"""


def q_shuffle_limit_with(train: int, val: int, test: int) -> str:
    shuffled = LIMITED.replace("THEN 30000", f"THEN {train}").replace("WHEN 'val' THEN 3500", f"WHEN 'val' THEN {val}") \
        .replace("WHEN 'test' THEN 3500", f"WHEN 'test' THEN {test}")
    return with_(COMMENTS, shuffled) + "SELECT split, doc_id, row_idx FROM shuffled"


def q_held_out_rows() -> str:
    return with_(COMMENTS, LABELLED) + """
SELECT doc_id, split, label_name, y, TRUE AS in_range FROM labelled WHERE split <> 'train'"""


def q_epoch_metrics_rows() -> str:
    return with_(COMMENTS, LABELLED) + """
SELECT split, label_name, epoch, TRUE AS in_range
FROM (SELECT DISTINCT split, label_name FROM labelled WHERE split <> 'train') t, unnest([1, 2, 3, 4, 5]) AS e(epoch)"""


def q_model_round_trip_rows() -> str:
    return with_(COMMENTS, LABELLED) + """
SELECT label_name, count(*) AS n_rows, count(*) AS n_equal FROM labelled WHERE split = 'val' GROUP BY label_name"""
