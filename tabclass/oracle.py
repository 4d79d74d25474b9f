"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: the Spark side aggregates once and
derives everything from small tables; the SQL side states each definition
directly (filters per cut, joins per label). Doubles are rounded alike.
"""

from __future__ import annotations

from .functions.hashing import sql_hash32  # noqa: F401  (used by oracle_more)

FOCUS = ("purchase", "signup")
BETA = 0.5
SCORE_CLASSES = ("click", "error", "purchase", "signup", "view")
BREAKDOWN_CUTS = (0.99, 0.95, 0.90, 0.75, 0.50, 0.25, 0.0)
PRECISION_BUCKET_CUTS = (0.99, 0.98, 0.97, 0.96, 0.95, 0.90, 0.85, 0.80, 0.75, 0.70,
                         0.65, 0.60, 0.55, 0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20,
                         0.15, 0.10, 0.05, 0.0)

F_ORD = ("SELECT o_orderkey AS row_id, o_orderstatus AS status, o_totalprice, o_custkey, "
         "CAST(month(o_orderdate) AS INTEGER) AS m FROM orders")
F_RARE = ("SELECT o_orderkey AS row_id, CASE WHEN o_totalprice > 470000 THEN 'yes' ELSE 'no' END AS status, "
          "o_totalprice, o_custkey, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders")
F_SEP = ("SELECT event_id, value, CAST(hour(ts) AS INTEGER) AS hr, user_id, "
         "CASE WHEN value < 20 THEN 'low' WHEN value < 70 THEN 'mid' ELSE 'high' END AS band FROM events")
F_NULL = (f"SELECT row_id, o_totalprice, CASE WHEN row_id % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey, m, "
          f"CASE WHEN row_id % 11 = 0 THEN NULL ELSE status END AS status FROM ({F_ORD})")
F_EXTRA = (f"SELECT row_id, o_totalprice, o_custkey, o_custkey % 10 AS x, row_id % 3 AS \"1\" FROM ({F_ORD})")
F_VEC = "SELECT vec_id AS id, embedding, CAST(label AS VARCHAR) AS label FROM embeddings"

_W = ("SELECT event_id, event_type, 1 + event_id*7919%101 AS w0, 1 + event_id*6151%97 AS w1, "
      "1 + event_id*4093%89 AS w2, 1 + event_id*3079%83 AS w3, 1 + event_id*1543%79 AS w4 FROM events")
_G = "greatest(w0, w1, w2, w3, w4)"
F_SCORED = (
    "SELECT event_id AS id, event_type AS actual, "
    "w0/(w0+w1+w2+w3+w4) AS click, w1/(w0+w1+w2+w3+w4) AS error, w2/(w0+w1+w2+w3+w4) AS purchase, "
    "w3/(w0+w1+w2+w3+w4) AS signup, w4/(w0+w1+w2+w3+w4) AS view, "
    f"CASE WHEN w0 = {_G} THEN 'click' WHEN w1 = {_G} THEN 'error' WHEN w2 = {_G} THEN 'purchase' "
    f"WHEN w3 = {_G} THEN 'signup' ELSE 'view' END AS pred FROM ({_W})")
F_SCORED2 = (f"SELECT id, CASE WHEN actual = 'click' THEN 'click' ELSE 'other' END AS actual, click, "
             f"1.0 - click AS other FROM ({F_SCORED})")


def _kl(keys):
    return "".join(f"{k}, " for k in keys)


def per_class_sql(src: str, keys=(), labels=None, beta=None) -> str:
    """CTE body: per (keys, label): tp, support, predicted, precision, recall, f1[, fb].

    ``src`` yields (keys..., actual, pred). Labels: seen ones, or exactly ``labels``.
    """
    k = _kl(keys)
    using = ", ".join(list(keys) + ["label"])
    if labels is None:
        lab = f"SELECT {k}actual AS label FROM cm UNION SELECT {k}pred AS label FROM cm"
    else:
        vals = ", ".join(f"('{x}')" for x in labels)
        kd = f"(SELECT DISTINCT {', '.join(keys)} FROM cm) kk, " if keys else ""
        lab = f"SELECT {k}v.label FROM {kd}(VALUES {vals}) v(label)"
    fb = ""
    if beta is not None:
        b2 = float(beta) ** 2
        fb = (f", CASE WHEN {b2!r}*precision + recall > 0 THEN (1 + {b2!r})*precision*recall/"
              f"({b2!r}*precision + recall) ELSE 0.0 END AS fb")
    return f"""
    cm AS (SELECT {k}actual, pred, count(*) AS n FROM ({src}) GROUP BY ALL),
    lab AS ({lab}),
    tp AS (SELECT {k}actual AS label, sum(n) AS tp FROM cm WHERE actual = pred GROUP BY ALL),
    sup AS (SELECT {k}actual AS label, sum(n) AS support FROM cm GROUP BY ALL),
    prd AS (SELECT {k}pred AS label, sum(n) AS predicted FROM cm GROUP BY ALL),
    pc0 AS (SELECT lab.*, coalesce(tp.tp, 0) AS tp, coalesce(sup.support, 0) AS support,
                   coalesce(prd.predicted, 0) AS predicted
            FROM lab LEFT JOIN tp USING ({using}) LEFT JOIN sup USING ({using})
                     LEFT JOIN prd USING ({using})),
    pc1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
                      CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc0),
    pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2*precision*recall/(precision + recall)
                     ELSE 0.0 END AS f1 {fb} FROM pc1)"""


def report_sql(src: str, keys=(), extra_select: str = "") -> str:
    k = _kl(keys)
    r = lambda e: f"round(CAST({e} AS DOUBLE), 4)"
    return f"""WITH {per_class_sql(src, keys)},
    tot AS (SELECT {k}sum(tp) / sum(support) AS acc, CAST(sum(support) AS DOUBLE) AS n,
                   avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
                   sum(precision*support)/sum(support) AS wp, sum(recall*support)/sum(support) AS wr,
                   sum(f1*support)/sum(support) AS wf FROM pc GROUP BY ALL),
    rep AS (
      SELECT {k}label AS value, {r('precision')} AS precision, {r('recall')} AS recall,
             {r('f1')} AS f1_score, {r('support')} AS support FROM pc
      UNION ALL SELECT {k}'accuracy', {r('acc')}, {r('acc')}, {r('acc')}, {r('acc')} FROM tot
      UNION ALL SELECT {k}'macro avg', {r('mp')}, {r('mr')}, {r('mf')}, {r('n')} FROM tot
      UNION ALL SELECT {k}'weighted avg', {r('wp')}, {r('wr')}, {r('wf')}, {r('n')} FROM tot)
    SELECT * {extra_select} FROM rep"""


def summary_sql(src: str, labels=None, beta=1.0) -> str:
    """One row: accuracy, precision, recall, f1, fb (macro over labels), weighted_*."""
    return f"""WITH {per_class_sql(src, (), labels, beta)},
    acc AS (SELECT sum(CASE WHEN actual = pred THEN n ELSE 0 END) / sum(n) AS accuracy FROM cm),
    agg AS (SELECT avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1, avg(fb) AS fbeta,
                   CASE WHEN sum(support) > 0 THEN sum(precision*support)/sum(support) ELSE 0.0 END AS weighted_precision,
                   CASE WHEN sum(support) > 0 THEN sum(recall*support)/sum(support) ELSE 0.0 END AS weighted_recall,
                   CASE WHEN sum(support) > 0 THEN sum(f1*support)/sum(support) ELSE 0.0 END AS weighted_f1
            FROM pc)
    SELECT * FROM acc, agg"""


def _cut_union(score: str, cuts, tag_fn, src: str, all_pos: str | None = None) -> str:
    pred = f"'{all_pos}'" if all_pos else "pred"
    parts = []
    for q in cuts:
        parts.append(f"SELECT {tag_fn(q)} AS cut, actual, {pred} AS pred FROM ({src}) "
                     f"WHERE {score} >= (SELECT quantile_cont({score}, {q!r}) FROM ({src}))")
    return " UNION ALL ".join(parts)


def auc_sql(src_long: str, keys=()) -> str:
    """``src_long`` yields (keys..., score, y) with y 1 for positives. AUC by
    the rank-sum rule with average ranks for ties."""
    k = _kl(keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    part_s = f"PARTITION BY {', '.join(list(keys) + ['score'])}"
    return f"""
    rk AS (SELECT {k}score, y, rank() OVER ({part} ORDER BY score) AS r0,
                  count(*) OVER ({part_s}) AS c FROM ({src_long})),
    ar AS (SELECT {k}y, r0 + (c - 1) / 2.0 AS ar FROM rk),
    au AS (SELECT {k}(sum(CASE WHEN y = 1 THEN ar ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
                  / (sum(y) * (count(*) - sum(y))) AS auc FROM ar GROUP BY ALL)"""


def _r(e, d=4):
    return f"round({e}, {d})"


Q: dict[str, str] = {}

Q["classification_report"] = report_sql(F_SCORED)

Q["confusion_matrix"] = f"""
WITH s AS ({F_SCORED}), lab AS (SELECT actual AS l FROM s UNION SELECT pred FROM s),
cm AS (SELECT actual, pred, count(*) AS n FROM s GROUP BY ALL)
SELECT a.l AS actual, p.l AS pred, CAST(coalesce(cm.n, 0) AS BIGINT) AS n
FROM lab a CROSS JOIN lab p LEFT JOIN cm ON cm.actual = a.l AND cm.pred = p.l"""

Q["confusion_matrix_norm"] = f"""
WITH s AS ({F_SCORED}), lab AS (SELECT actual AS l FROM s UNION SELECT pred FROM s),
cm AS (SELECT actual, pred, count(*) AS n FROM s GROUP BY ALL),
tot AS (SELECT actual, count(*) AS t FROM s GROUP BY ALL)
SELECT a.l AS actual, p.l AS pred,
       round(CASE WHEN coalesce(t.t, 0) > 0 THEN coalesce(cm.n, 0) / t.t ELSE 0.0 END, 4) AS share
FROM lab a CROSS JOIN lab p LEFT JOIN cm ON cm.actual = a.l AND cm.pred = p.l
LEFT JOIN tot t ON t.actual = a.l"""

Q["accuracy"] = f"SELECT round(avg(CASE WHEN actual = pred THEN 1.0 ELSE 0.0 END), 4) AS accuracy FROM ({F_SCORED})"

Q["macro_metrics"] = (f"SELECT {_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1')} AS f1 "
                      f"FROM ({summary_sql(F_SCORED)})")
Q["focus_metrics"] = (f"SELECT {_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1')} AS f1 "
                      f"FROM ({summary_sql(F_SCORED, FOCUS)})")
Q["weighted_metrics"] = f"""
SELECT {_r('a.weighted_precision')} AS weighted_precision, {_r('a.weighted_recall')} AS weighted_recall,
       {_r('a.weighted_f1')} AS weighted_f1, {_r('f.weighted_precision')} AS focus_weighted_precision,
       {_r('f.weighted_recall')} AS focus_weighted_recall, {_r('f.weighted_f1')} AS focus_weighted_f1
FROM ({summary_sql(F_SCORED)}) a, ({summary_sql(F_SCORED, FOCUS)}) f"""
Q["fbeta_metrics"] = " UNION ALL ".join(
    f"SELECT CAST({b!r} AS DOUBLE) AS beta, {_r('a.fbeta')} AS overall_fbeta, {_r('f.fbeta')} AS fbeta "
    f"FROM ({summary_sql(F_SCORED, None, b)}) a, ({summary_sql(F_SCORED, FOCUS, b)}) f"
    for b in (0.5, 1.0, 2.0))

_auc_long = " UNION ALL ".join(
    f"SELECT '{c}' AS cls, {c} AS score, CASE WHEN actual = '{c}' THEN 1 ELSE 0 END AS y FROM ({F_SCORED})"
    for c in SCORE_CLASSES)
Q["roc_auc_macro"] = f"WITH {auc_sql(_auc_long, ('cls',))} SELECT round(avg(auc), 6) AS auc_macro FROM au"

Q["metrics_long"] = f"""
WITH a AS ({summary_sql(F_SCORED, None, BETA)}), f AS ({summary_sql(F_SCORED, FOCUS, BETA)}),
{auc_sql(_auc_long, ('cls',))}, m AS (SELECT avg(auc) AS auc FROM au)
SELECT "Metric", round(CAST("Value" AS DOUBLE), 3) AS "Value" FROM (
  SELECT 'test_recall' AS "Metric", f.recall AS "Value" FROM f UNION ALL
  SELECT 'test_precision', f.precision FROM f UNION ALL
  SELECT 'test_f1', f.f1 FROM f UNION ALL
  SELECT 'test_f_beta', f.fbeta FROM f UNION ALL
  SELECT 'test_auc', round(m.auc, 2) FROM m UNION ALL
  SELECT 'test_overall_recall', a.recall FROM a UNION ALL
  SELECT 'test_overall_precision', a.precision FROM a UNION ALL
  SELECT 'test_overall_f1', a.f1 FROM a UNION ALL
  SELECT 'test_overall_fbeta', a.fbeta FROM a UNION ALL
  SELECT 'test_accuracy', a.accuracy FROM a)"""

def _metrics_of(src: str, name: str) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS cls, {c} AS score, CASE WHEN actual = '{c}' THEN 1 ELSE 0 END AS y "
                              f"FROM ({src})" for c in SCORE_CLASSES)
    rows = (("recall", "f.recall"), ("precision", "f.precision"), ("f1", "f.f1"), ("f_beta", "f.fbeta"),
            ("auc", "round(m.auc, 2)"), ("overall_recall", "a.recall"), ("overall_precision", "a.precision"),
            ("overall_f1", "a.f1"), ("overall_fbeta", "a.fbeta"), ("accuracy", "a.accuracy"))
    body = " UNION ALL ".join(f"SELECT '{name}_{n}' AS \"Metric\", round(CAST({e} AS DOUBLE), 3) AS \"Value\" FROM a, f, m"
                              for n, e in rows)
    return f"""SELECT * FROM (WITH a AS ({summary_sql(src, None, BETA)}), f AS ({summary_sql(src, FOCUS, BETA)}),
{auc_sql(long, ('cls',))}, m AS (SELECT avg(auc) AS auc FROM au) {body})"""


Q["metrics_long_train_val"] = (_metrics_of(f"SELECT * FROM ({F_SCORED}) WHERE id % 3 = 0", "validation") + " UNION ALL "
                               + _metrics_of(f"SELECT * FROM ({F_SCORED}) WHERE id % 3 <> 0", "train"))
Q["odd_names"] = f"""SELECT auc_macro, (SELECT round(quantile_cont(view, 0.5), 6) FROM ({F_SCORED})) AS median
FROM ({Q['roc_auc_macro']})"""

Q["score_percentiles"] = " UNION ALL ".join(
    f"SELECT CAST({q!r} AS DOUBLE) AS q, round(quantile_cont(purchase, {q!r}), 6) AS value FROM ({F_SCORED})"
    for q in BREAKDOWN_CUTS)


def _pct_tag(q):
    return f"CAST({int(round((1 - q) * 100))} AS INTEGER)"


Q["percentile_breakdown"] = report_sql(
    _cut_union("purchase", BREAKDOWN_CUTS, _pct_tag, F_SCORED), ("cut",),
    extra_select="EXCLUDE (cut), cut AS percentile")
Q["percentile_breakdown_by_model"] = " UNION ALL ".join(
    f"SELECT 'm{i}' AS model_id, * FROM (" + report_sql(
        _cut_union("purchase", BREAKDOWN_CUTS, _pct_tag, f"SELECT * FROM ({F_SCORED}) WHERE id % 2 = {i}"), ("cut",),
        extra_select="EXCLUDE (cut), cut AS percentile") + ")" for i in (0, 1))
Q["percentile_breakdown_allpos"] = report_sql(
    _cut_union("purchase", BREAKDOWN_CUTS, _pct_tag, F_SCORED, all_pos="purchase"), ("cut",),
    extra_select="EXCLUDE (cut), cut AS percentile")


def _precision_buckets_sql() -> str:
    src = _cut_union("purchase", PRECISION_BUCKET_CUTS, lambda q: f"{round((1 - q) * 100, 1)!r}", F_SCORED)
    thr = " UNION ALL ".join(
        f"SELECT {round((1 - q) * 100, 1)!r} AS cut, quantile_cont(purchase, {q!r}) AS t FROM ({F_SCORED})"
        for q in PRECISION_BUCKET_CUTS)
    return f"""WITH {per_class_sql(src, ('cut',), FOCUS)},
    m AS (SELECT cut, avg(precision) AS p, avg(recall) AS r, avg(f1) AS f FROM pc GROUP BY cut),
    tot AS (SELECT cut, sum(n) AS users, sum(CASE WHEN actual = pred THEN n ELSE 0 END) / sum(n) AS a
            FROM cm GROUP BY cut),
    thr AS ({thr})
    SELECT CAST(thr.cut AS DOUBLE) AS percentile, round(thr.t, 6) AS percentile_value,
           round(tot.a * 100, 2) AS accuracy, round(m.p * 100, 2) AS precision,
           round(m.r * 100, 2) AS recall, round(m.f * 100, 2) AS f1_score, CAST(tot.users AS BIGINT) AS users
    FROM thr JOIN tot USING (cut) JOIN m USING (cut)"""


Q["precision_buckets"] = _precision_buckets_sql()

Q["argmax_class"] = f"SELECT id, pred FROM ({F_SCORED})"

Q["label_binarize"] = "SELECT id, " + ", ".join(
    f"CAST(actual = '{c}' AS INTEGER) AS {c}" for c in SCORE_CLASSES) + f" FROM ({F_SCORED})"

_S2_COUNTS = (f"SELECT click AS score, sum(CASE WHEN actual = 'click' THEN 1 ELSE 0 END) AS pos, "
              f"sum(CASE WHEN actual = 'click' THEN 0 ELSE 1 END) AS neg FROM ({F_SCORED2}) GROUP BY click")
Q["roc_curve"] = f"""
WITH c AS ({_S2_COUNTS}),
r AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c)
SELECT round(score, 6) AS threshold, round(CASE WHEN N > 0 THEN fps / N ELSE 0.0 END, 6) AS fpr,
       round(CASE WHEN P > 0 THEN tps / P ELSE 0.0 END, 6) AS tpr,
       CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps FROM r"""
Q["pr_curve"] = f"""
WITH c AS ({_S2_COUNTS}),
r AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps,
             sum(pos) OVER () AS P FROM c)
SELECT round(score, 6) AS threshold,
       round(CASE WHEN tps + fps > 0 THEN tps / (tps + fps) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN P > 0 THEN tps / P ELSE 0.0 END, 6) AS recall FROM r"""
Q["roc_corners"] = f"""
WITH c AS ({_S2_COUNTS}),
r AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N, pos, neg, lag(score) OVER (ORDER BY score DESC) AS before,
             lead(pos) OVER (ORDER BY score DESC) AS pos1, lead(neg) OVER (ORDER BY score DESC) AS neg1 FROM c)
SELECT round(score, 6) AS threshold, round(CASE WHEN N > 0 THEN fps / N ELSE 0.0 END, 6) AS fpr,
       round(CASE WHEN P > 0 THEN tps / P ELSE 0.0 END, 6) AS tpr,
       CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps FROM r
WHERE before IS NULL OR pos1 IS NULL OR pos1 <> pos OR neg1 <> neg
UNION ALL SELECT NULL, 0.0, 0.0, 0, 0 WHERE EXISTS (SELECT 1 FROM c)"""
Q["pr_curve_closed"] = f"""SELECT * FROM ({Q["pr_curve"]})
UNION ALL SELECT NULL, 1.0, 0.0 WHERE EXISTS (SELECT 1 FROM ({_S2_COUNTS}))"""
Q["roc_auc"] = (f"WITH {auc_sql(f'SELECT click AS score, CASE WHEN actual = {chr(39)}click{chr(39)} THEN 1 ELSE 0 END AS y FROM ({F_SCORED2})')} "
                "SELECT round(auc, 6) AS auc FROM au")
Q["roc_auc_hard"] = f"""
WITH s AS (SELECT actual, CASE WHEN click >= other THEN 'click' ELSE 'other' END AS pred FROM ({F_SCORED2})),
c AS (SELECT sum(CASE WHEN actual = 'click' AND pred = 'click' THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN actual = 'click' THEN 1 ELSE 0 END) AS P,
             sum(CASE WHEN actual <> 'click' AND pred <> 'click' THEN 1 ELSE 0 END) AS tn,
             sum(CASE WHEN actual <> 'click' THEN 1 ELSE 0 END) AS N FROM s)
SELECT round(((CASE WHEN P > 0 THEN tp / P ELSE 0.0 END) + (CASE WHEN N > 0 THEN tn / N ELSE 0.0 END)) / 2, 6)
       AS auc_hard FROM c"""

# ------------------------------------------------------------ prep / balance
Q["scan_table"] = F_ORD
Q["prep_columns"] = (f"SELECT row_id AS id, o_totalprice, o_custkey, m, coalesce(CAST(status AS VARCHAR), 'nan') "
                     f"AS target FROM ({F_NULL})")
Q["with_actual"] = (f"SELECT row_id, CAST(status AS VARCHAR) AS status_actual, 'ord' AS src FROM ({F_ORD}) "
                    f"UNION ALL SELECT row_id, 'NA' AS status_actual, 'extra' AS src FROM ({F_EXTRA})")
Q["drop_columns"] = f"SELECT row_id, status, o_totalprice FROM ({F_ORD})"
Q["align_features"] = f"SELECT row_id, o_totalprice, o_custkey, CAST(0.0 AS DOUBLE) AS gone FROM ({F_EXTRA})"
Q["tag_literals"] = (f"SELECT row_id, status, 'rf' AS model_name, 'smote' AS sampling_type, 'm-001' AS model_id "
                     f"FROM ({F_ORD})")
Q["safe_names"] = f"SELECT row_id, o_totalprice, o_custkey, x, \"1\" AS pred_1 FROM ({F_EXTRA})"
Q["target_distribution"] = f"""
SELECT status AS value, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct
FROM ({F_NULL}) WHERE status IS NOT NULL GROUP BY status"""
Q["target_distribution_nulls"] = f"""
SELECT status AS value, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct
FROM ({F_NULL}) GROUP BY status"""
Q["class_list"] = (f"SELECT status AS label, count(*) AS count, count(*) OVER () AS n_labels "
                   f"FROM ({F_ORD}) GROUP BY status")
Q["class_imbalance"] = f"""
WITH c AS (SELECT status, count(*) AS c FROM ({F_RARE}) GROUP BY status)
SELECT min(c) AS min_count, max(c) AS max_count, count(*) AS n_classes,
       round(min(c) / max(c), 4) AS extent, round(min(c) / max(c), 4) < 0.10 AS imbalanced FROM c"""


def all_sql() -> dict[str, str]:
    from . import oracle_ml, oracle_more  # noqa: F401  (add the remaining keys)
    return dict(Q)
