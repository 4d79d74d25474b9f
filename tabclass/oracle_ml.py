"""DuckDB oracles, third part: Gaussian naive Bayes fits, NB cross-validation
and the search bookkeeping built on it (summary, best per combo, best combo,
leaderboard, registry row)."""

from __future__ import annotations

from .functions.hashing import sql_hash32
from .oracle import BREAKDOWN_CUTS, F_NULL, F_SEP, Q, _cut_union, _pct_tag, per_class_sql, report_sql, summary_sql
from .oracle_more import kfold_sql, split_sql

X = ("value", "hr", "user_id")
SEP = (f"SELECT event_id AS id, CAST(value AS DOUBLE) AS value, CAST(hr AS DOUBLE) AS hr, "
       f"CAST(user_id AS DOUBLE) AS user_id, coalesce(CAST(band AS VARCHAR), 'nan') AS target FROM ({F_SEP})")
SEP_SPLIT = split_sql(SEP)
TRAIN = f"SELECT * EXCLUDE (split) FROM ({SEP_SPLIT}) WHERE split = 'train'"
VAL = f"SELECT * EXCLUDE (split) FROM ({SEP_SPLIT}) WHERE split = 'validation'"
SAMPLINGS = ("NA", "us", "os")
FOCUS = ("high", "low")
BETA = 2.0


def nb_ctes(fit: str, rows: str, keys=()) -> str:
    """CTEs nbs, nbt, nbm, nbl, nbp. ``fit`` (keys..., target, X...), ``rows``
    (keys..., id, X...). nbp = (keys..., id, pred): argmax of
    log prior - 0.5 * sum((x - mean)^2 / var) - 0.5 * sum(log var), var =
    population variance + 1e-9 * largest feature variance; ties -> smallest label."""
    k = "".join(f"{c}, " for c in keys)
    on = f"USING ({', '.join(keys)})" if keys else "ON true"
    stats = ", ".join(f"avg({x}) AS m_{x}, sum({x} * {x}) / count(*) - avg({x}) * avg({x}) AS v_{x}" for x in X)
    eps = "1e-9 * greatest(" + ", ".join(f"var_pop({x})" for x in X) + ")"
    quad = " + ".join(f"(r.{x} - m.m_{x})^2 / m.s_{x}" for x in X)
    logv = " + ".join(f"ln(m.s_{x})" for x in X)
    part = ", ".join(list(keys) + ["id"])
    return f"""
    nbs AS (SELECT {k}target, count(*) AS nc, {stats} FROM ({fit}) GROUP BY ALL),
    nbt AS (SELECT {k}count(*) AS n, {eps} AS eps FROM ({fit}) GROUP BY ALL),
    nbm AS (SELECT nbs.*, ln(nc) - ln(n) AS pi, {', '.join(f'v_{x} + eps AS s_{x}' for x in X)}
            FROM nbs JOIN nbt {on}),
    nbl AS (SELECT {k}r.id, m.target, m.pi - 0.5 * ({quad}) - 0.5 * ({logv}) AS ll
            FROM ({rows}) r JOIN nbm m {on}),
    nbp AS (SELECT {k}id, target AS pred FROM (
              SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY ll DESC, target) AS rr FROM nbl)
            WHERE rr = 1)"""


def sampled_sql(src: str, keys=()) -> str:
    """(s, keys..., id, X..., target): the NA, us and os versions of ``src``,
    each sampler ranking rows inside (keys, class) by its own md5 draw."""
    k = "".join(f"{c}, " for c in keys)
    pk = f"PARTITION BY {', '.join(keys)}" if keys else ""
    pkt = f"PARTITION BY {', '.join(list(keys) + ['target'])}"
    cols = ", ".join(["id", *X, "target"])

    def ranked(seed):
        return f"""SELECT *, min(__n) OVER ({pk}) AS __min, max(__n) OVER ({pk}) AS __max FROM (
          SELECT *, row_number() OVER ({pkt} ORDER BY __h, id) AS __rank, count(*) OVER ({pkt}) AS __n
          FROM (SELECT *, {sql_hash32(seed, 'id')} AS __h FROM ({src})))"""
    us = f"SELECT 'us' AS s, {k}{cols} FROM ({ranked('us1')}) WHERE __rank <= __min"
    os_ = f"""SELECT 'os' AS s, {k}{cols} FROM (
        SELECT *, unnest(generate_series(0, CAST(CASE WHEN __rank <= __max - __n
               THEN floor((__max - __n - __rank) / __n) + 1 ELSE 0 END AS BIGINT))) AS __c FROM ({ranked('os1')}))"""
    na = f"SELECT 'NA' AS s, {k}{cols} FROM ({src})"
    return f"{na} UNION ALL {us} UNION ALL {os_}"


Q["fit_nb"] = f"WITH {nb_ctes(TRAIN, VAL)} SELECT id, pred FROM nbp"

_FOLDS = kfold_sql(TRAIN, 3)
_FIT = f"SELECT f.f, d.* EXCLUDE (fold) FROM ({_FOLDS}) d, (VALUES (0), (1), (2)) f(f) WHERE d.fold <> f.f"
_ROWS = (f"SELECT s.s, d.fold AS f, d.id, {', '.join(X)} FROM ({_FOLDS}) d, "
         f"(VALUES ('NA'), ('us'), ('os')) s(s)")
_ACT = f"SELECT s.s, d.fold AS f, d.id, d.target AS actual FROM ({_FOLDS}) d, (VALUES ('NA'), ('us'), ('os')) s(s)"
CV = f"""WITH {nb_ctes(sampled_sql(_FIT, ('f',)), _ROWS, ('s', 'f'))},
{per_class_sql(f'SELECT a.s, a.f, a.actual, p.pred FROM ({_ACT}) a JOIN nbp p USING (s, f, id)', ('s', 'f'))}
SELECT CAST(CASE s WHEN 'NA' THEN 1 WHEN 'us' THEN 2 ELSE 3 END AS INTEGER) AS replication_id,
       'nb' AS model_name, s AS sampling_type, avg(f1) AS cv_score, '{{}}' AS hyper_parameters
FROM pc GROUP BY s, f"""
Q["cv_scores"] = f"SELECT * EXCLUDE (cv_score), round(cv_score, 6) AS cv_score FROM ({CV})"
SUMMARY = f"""SELECT replication_id, model_name, sampling_type, hyper_parameters,
       avg(cv_score) AS cv_score_mean, stddev_samp(cv_score) AS cv_score_std
FROM ({CV}) GROUP BY ALL"""
Q["cv_summary"] = (f"SELECT replication_id, model_name, sampling_type, hyper_parameters, "
                   f"round(cv_score_mean, 6) AS cv_score_mean, round(cv_score_std, 6) AS cv_score_std FROM ({SUMMARY})")
BEST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name, sampling_type
       ORDER BY cv_score_mean DESC, replication_id) AS rr FROM ({SUMMARY})) WHERE rr = 1"""
Q["best_per_combo"] = (f"SELECT model_name, sampling_type, replication_id, round(cv_score_mean, 6) AS cv_score_mean "
                       f"FROM ({BEST})")
BEST_COMBO = (f"SELECT model_name || '_' || sampling_type AS best_model, cv_score_mean FROM ({BEST}) "
              f"ORDER BY cv_score_mean DESC, replication_id LIMIT 1")
Q["best_combo"] = f"SELECT best_model, round(cv_score_mean, 6) AS cv_score_mean FROM ({BEST_COMBO})"


def _summary_keyed(src: str, labels, beta) -> str:
    b2 = float(beta) ** 2
    return f"""WITH {per_class_sql(src, ('s',), labels)},
    acc AS (SELECT s, sum(CASE WHEN actual = pred THEN n ELSE 0 END) / sum(n) AS accuracy FROM cm GROUP BY s),
    agg AS (SELECT s, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1,
                   avg(CASE WHEN {b2!r} * precision + recall > 0 THEN (1 + {b2!r}) * precision * recall /
                       ({b2!r} * precision + recall) ELSE 0.0 END) AS fbeta FROM pc GROUP BY s)
    SELECT * FROM acc JOIN agg USING (s)"""


_LB_ROWS = f"SELECT s.s, d.id, {', '.join(X)} FROM ({VAL}) d, (VALUES ('NA'), ('us'), ('os')) s(s)"
_LB_SRC = f"""WITH {nb_ctes(sampled_sql(TRAIN), _LB_ROWS, ('s',))}
SELECT p.s, v.target AS actual, p.pred FROM nbp p JOIN ({VAL}) v USING (id)"""
LEADER = f"""SELECT 'nb_' || a.s AS model_name, f.recall, f.precision, f.f1, f.fbeta AS f_beta,
       a.recall AS overall_recall, a.precision AS overall_precision, a.f1 AS overall_f1,
       a.fbeta AS overall_fbeta, a.accuracy
FROM ({_summary_keyed(_LB_SRC, None, BETA)}) a JOIN ({_summary_keyed(_LB_SRC, FOCUS, BETA)}) f USING (s)"""
_MET = ("recall", "precision", "f1", "f_beta", "overall_recall", "overall_precision", "overall_f1",
        "overall_fbeta", "accuracy")
Q["leaderboard"] = f"SELECT model_name, {', '.join(f'round({c}, 4) AS {c}' for c in _MET)} FROM ({LEADER})"
Q["registry_row"] = f"""
SELECT 'm-sep-01' AS "model_ID", l.model_name, '{{}}' AS hyper_parameters, 'events' AS historic_table_name,
       'events' AS prediction_table_name, false AS is_gridsearch, 'band' AS target_name,
       '["high", "low"]' AS target_focus, '' AS preferred_model, {', '.join(f'round(l.{c}, 4) AS {c}' for c in _MET)}
FROM ({LEADER}) l JOIN ({BEST_COMBO}) b ON b.best_model = l.model_name"""
Q["best_params"] = (f"SELECT hyper_parameters, round(cv_score_mean, 6) AS cv_score_mean FROM ({SUMMARY}) "
                    f"WHERE model_name = 'nb' AND sampling_type = 'us'")


def _probs(rows_sql: str) -> str:
    """nbl -> (id, pred, high, low, mid): softmax of the class log-likelihoods."""
    return f"""WITH {nb_ctes(TRAIN, rows_sql)},
    mx AS (SELECT id, max(ll) AS m FROM nbl GROUP BY id),
    ex AS (SELECT nbl.id, nbl.target, exp(nbl.ll - mx.m) AS e FROM nbl JOIN mx USING (id)),
    pr AS (SELECT id, target, e / sum(e) OVER (PARTITION BY id) AS p FROM ex)
    SELECT nbp.id, nbp.pred,
           round(max(CASE WHEN pr.target = 'high' THEN p END), 6) AS high,
           round(max(CASE WHEN pr.target = 'low' THEN p END), 6) AS low,
           round(max(CASE WHEN pr.target = 'mid' THEN p END), 6) AS mid
    FROM nbp JOIN pr USING (id) GROUP BY nbp.id, nbp.pred"""


Q["score"] = _probs(VAL)
_ALL = (f"SELECT event_id AS id, CAST(value AS DOUBLE) AS value, CAST(hr AS DOUBLE) AS hr, "
        f"CAST(user_id AS DOUBLE) AS user_id FROM ({F_SEP})")
def _stored(model: str) -> str:
    return f"""
SELECT s.id, f.value, f.hr, f.user_id, s.pred AS band, s.high, s.low, s.mid, CAST(f.band AS VARCHAR) AS band_actual,
  '{model}' AS model_id FROM ({_probs(_ALL)}) s JOIN ({F_SEP}) f ON f.event_id = s.id"""


Q["score_stored"] = _stored("m-sep-01")
Q["rescore_replaces"] = f"SELECT id, value, band, band_actual, model_id FROM ({_stored('m-sep-03')}) WHERE id % 2 = 0"

_VAL_PRED = f"SELECT v.target AS actual, p.pred FROM nbp p JOIN ({VAL}) v USING (id)"
_ALL_PRED = f"SELECT CAST(f.band AS VARCHAR) AS actual, p.pred FROM nbp p JOIN ({F_SEP}) f ON f.event_id = p.id"
_VAL_REP = report_sql(f"WITH {nb_ctes(TRAIN, VAL)} {_VAL_PRED}")
_ALL_REP = report_sql(f"WITH {nb_ctes(TRAIN, _ALL)} {_ALL_PRED}")
Q["job_report"] = f"SELECT 'validation' AS \"set\", * FROM ({_VAL_REP}) UNION ALL SELECT 'test', * FROM ({_ALL_REP})"


def _best(rows: str, pred: str) -> str:
    """max of overall recall and accuracy, rounded as in the metric table"""
    return f"SELECT greatest(round(recall, 3), round(accuracy, 3)) FROM ({summary_sql(f'WITH {nb_ctes(TRAIN, rows)} {pred}')})"


Q["job_run_log"] = f"""SELECT 'train' AS "set", CAST(10 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS best UNION ALL
SELECT 'validation', 10, NULL UNION ALL SELECT 'test', 10, ({_best(_ALL, _ALL_PRED)})"""

# ---------------------------------------------------- step function, re-sampling
F_STEP = ("SELECT event_id, CAST(hour(ts) AS INTEGER) AS hr, event_id % 5 AS noise, CASE WHEN hour(ts) < 8 THEN 'night' "
          "WHEN hour(ts) < 16 THEN 'day' ELSE 'eve' END AS part FROM events")
_STEP_VAL = ("SELECT id, target FROM (" + split_sql(f"SELECT event_id AS id, part AS target FROM ({F_STEP})")
             + ") WHERE split = 'validation'")
for _k in ("fit_rf", "fit_dt", "fit_gbt"):
    Q[_k] = f"SELECT id, target AS pred, CAST(1.0 AS DOUBLE) AS prob_sum FROM ({_STEP_VAL})"
Q["feature_importance"] = """SELECT * FROM (VALUES ('hr', 1, true), ('noise', 2, false))
t(variable_name, importance_rank, leads)"""
Q["model_roundtrip"] = f"SELECT id, target AS pred_fitted, target AS pred_loaded, true AS same FROM ({_STEP_VAL})"
Q["train_and_score"] = (f"SELECT event_id AS id, hr, noise, part, part AS part_actual, 'm-step-01' AS model_id "
                        f"FROM ({F_STEP})")

_OS = f"SELECT * FROM ({sampled_sql(TRAIN)}) WHERE s = 'os'"
Q["ovr_os"] = f"""
WITH tr AS ({_OS}), te AS ({VAL}),
nn AS (SELECT * FROM (SELECT te.id, tr.target AS nl, row_number() OVER (PARTITION BY te.id ORDER BY
    (te.hr - tr.hr) ^ 2 + (te.user_id - tr.user_id) ^ 2, tr.id) AS r FROM te, tr) WHERE r <= 3),
v AS (SELECT id, nl, count(*) AS n FROM nn GROUP BY id, nl),
b AS (SELECT id, nl AS pred FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, nl) AS r FROM v) WHERE r = 1)
SELECT b.id, b.pred, {', '.join(f"round(coalesce(max(CASE WHEN nl = '{c}' THEN n END), 0) / 3.0, 6) AS {c}" for c in ('high', 'low', 'mid'))}
FROM b JOIN v USING (id) GROUP BY b.id, b.pred"""
Q["smote_nulls"] = f"""
WITH c AS (SELECT status AS target, count(*) AS n FROM ({F_NULL}) WHERE status IS NOT NULL GROUP BY status)
SELECT target, (SELECT max(n) FROM c) AS n FROM c"""

# ------------------------------------------------------ boosting, loss by round
BOOST = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "gamma": 0.05, "reg_alpha": 0.1, "reg_lambda": 2,
         "min_child_weight": 3}


def boost_sql(cells: str, features, n_classes: int, p: dict) -> str:
    """Log-loss after each round of soft-max boosting over ``cells``: (set, features..., y, n), where n rows
    share features and label y. Each round grows a tree per class: node 0 is split level by level."""
    unit, f = "16777216.0", ", ".join(features)
    on = " AND ".join(f"a.{x} = b.{x}" for x in features)
    ctes = [f"cells AS MATERIALIZED ({cells})",
            f"m0 AS MATERIALIZED (SELECT {f}, k, 0.0::DOUBLE AS margin FROM (SELECT DISTINCT {f} FROM cells), range({n_classes}) t(k))"]

    def soft(m):
        return (f"SELECT {f}, k, e / sum(e) OVER (PARTITION BY {f}) AS p FROM (SELECT *, exp(margin - max(margin) OVER "
                f"(PARTITION BY {f})) AS e FROM {m})")

    def score(g, h):
        return f"greatest(abs({g}) - {p['reg_alpha']}, 0) ^ 2 / ({h} + {p['reg_lambda']})"

    losses = []
    for r in range(p["n_estimators"]):
        # sums of whole-number gradients by features and class; every row is in node 0, open
        ctes.append(f"""g{r} AS MATERIALIZED (SELECT {', '.join(f'b.{x}' for x in features)}, b.k,
            coalesce(sum(n * round((p - CASE WHEN y = k THEN 1 ELSE 0 END) * {unit})), 0)::HUGEINT AS g,
            coalesce(sum(n * round(greatest(2 * p * (1 - p), 1e-16) * {unit})), 0)::HUGEINT AS h
            FROM ({soft(f'm{r}')}) b LEFT JOIN (SELECT * FROM cells WHERE "set" = 'train') a ON {on} GROUP BY ALL)""")
        ctes.append(f"n{r}_0 AS MATERIALIZED (SELECT *, 0 AS node, true AS open FROM g{r})")
        for d in range(p["max_depth"]):
            at = f"{r}_{d}"
            hist = " UNION ALL ".join(f"SELECT k, node, {i} AS feature, {x} AS v, sum(g) AS g, sum(h) AS h FROM n{at} "
                                      f"WHERE open AND h > 0 GROUP BY ALL" for i, x in enumerate(features))
            w = "PARTITION BY k, node, feature"
            ctes.append(f"""s{at} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, node ORDER BY gain DESC, feature, v) AS i
                FROM (SELECT *, {score('lg', 'lh')} + {score('ag - lg', '(ah - lh)')} - {score('ag', 'ah')} AS gain FROM (
                  SELECT k, node, feature, v, sum(g) OVER ({w} ORDER BY v)::DOUBLE / {unit} AS lg, sum(h) OVER ({w} ORDER BY v)::DOUBLE / {unit} AS lh,
                         sum(g) OVER ({w})::DOUBLE / {unit} AS ag, sum(h) OVER ({w})::DOUBLE / {unit} AS ah FROM ({hist})))
                WHERE ah - lh > 0 AND lh >= {p['min_child_weight']} AND ah - lh >= {p['min_child_weight']})
                WHERE i = 1 AND gain > 1e-6 AND gain >= {p['gamma']})""")
            x = "CASE s.feature " + " ".join(f"WHEN {i} THEN n.{c}" for i, c in enumerate(features)) + " END"
            ctes.append(f"""n{r}_{d + 1} AS MATERIALIZED (SELECT {', '.join(f'n.{c}' for c in features)}, n.k, n.g, n.h,
                CASE WHEN s.k IS NULL THEN n.node WHEN {x} <= s.v THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node,
                s.k IS NOT NULL AS open FROM n{at} n LEFT JOIN s{at} s ON s.k = n.k AND s.node = n.node AND n.open)""")
        ctes.append(f"""v{r} AS MATERIALIZED (SELECT k, node, -sign(sum(g)) * greatest(abs(sum(g)::DOUBLE / {unit}) - {p['reg_alpha']}, 0)
            / (sum(h)::DOUBLE / {unit} + {p['reg_lambda']}) * {p['learning_rate']} AS value FROM n{r}_{p['max_depth']} GROUP BY k, node)""")
        ctes.append(f"""m{r + 1} AS MATERIALIZED (SELECT {', '.join(f'a.{x}' for x in features)}, a.k, a.margin + v.value AS margin FROM m{r} a
            JOIN n{r}_{p['max_depth']} b ON {on} AND a.k = b.k JOIN v{r} v ON v.k = b.k AND v.node = b.node)""")
        losses.append(f"""SELECT {r + 1} AS n_trees, a."set", -sum(n * ln(greatest(p, 1e-16))) / sum(n) AS loss
            FROM cells a JOIN ({soft(f'm{r + 1}')}) b ON {on} AND a.y = b.k GROUP BY a."set\"""")
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(losses)}"


def _cells(src: str, features) -> str:
    """Labels numbered in order; equal rows counted. ``src``: id, features, target."""
    f = ", ".join(features)
    return (f'SELECT split AS "set", {f}, y, count(*) AS n FROM (SELECT *, dense_rank() OVER (ORDER BY target) - 1 AS y '
            f"FROM ({split_sql(src)})) GROUP BY ALL")


STEP_SRC = f"SELECT event_id AS id, hr, noise, part AS target FROM ({F_STEP})"
RARE_SRC = ("SELECT o_orderkey AS id, month(o_orderdate) AS m, o_custkey % 7 AS c, "
            "CASE WHEN o_totalprice > 470000 THEN 'yes' ELSE 'no' END AS target FROM orders")
Q["loss_curve"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS fixture, n_trees, round(max(CASE WHEN "set" = 'train' THEN loss END), 6) AS train_loss,
    round(max(CASE WHEN "set" = 'validation' THEN loss END), 6) AS validation_loss FROM ({boost_sql(_cells(src, x), x, k, BOOST)})
    GROUP BY n_trees""" for name, src, x, k in (("rare", RARE_SRC, ("m", "c"), 2), ("step", STEP_SRC, ("hr", "noise"), 3)))
Q["fit_xg"] = Q["fit_gbt"]
Q["cross_validator"] = f"SELECT replication_id, sampling_type, round(cv_score_mean, 6) AS cv_score_mean FROM ({SUMMARY})"


# ------------------------------------------- the job's own tables, several models, groups
def _hard(rows: str, pred: str) -> str:
    c = "count(*) FILTER (WHERE {})"
    a, p = "actual = 'high'", "pred = 'high'"
    return (f"SELECT round(({c.format(f'{a} AND {p}')} / {c.format(a)} + {c.format(f'NOT {a} AND NOT {p}')} / "
            f"{c.format(f'NOT ({a})')}) / 2, 6) AS auc_hard FROM (WITH {nb_ctes(TRAIN, rows)} {pred})")


Q["job_auc_hard"] = (f"SELECT 'validation' AS \"set\", auc_hard FROM ({_hard(VAL, _VAL_PRED)}) UNION ALL "
                     f"SELECT 'test', auc_hard FROM ({_hard(_ALL, _ALL_PRED)})")
_STEP_SCORED = ("SELECT target AS actual, target AS pred, CASE WHEN target = 'night' THEN 1.0 ELSE 0.0 END::DOUBLE AS night "
                f"FROM ({_STEP_VAL})")
Q["job_allpos"] = report_sql(_cut_union("night", BREAKDOWN_CUTS, _pct_tag, _STEP_SCORED, all_pos="night"), ("cut",),
                             extra_select="EXCLUDE (cut), cut AS percentile")
Q["job_run_kinds"] = f"""SELECT 'run-7' AS run_id, 'param' AS kind, unnest(['model_id', 'best_model', 'cv_kfold', 'target']) AS name,
unnest(['"m-sep-04"', '"nb_NA"', '3', '"band"']) AS value
UNION ALL SELECT 'run-7', 'distribution', 'test actual ' || band, count(*)::VARCHAR FROM ({F_SEP}) GROUP BY band
UNION ALL SELECT 'run-7', 'metric', 'rows', '30'"""
Q["replace_key_by_nothing"] = "SELECT o_orderkey AS row_id, o_totalprice, o_orderstatus AS model_id FROM orders WHERE o_orderstatus <> 'F'"
Q["snapshot_replace"] = """SELECT o_orderkey AS row_id, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
o_orderstatus AS model_id FROM orders WHERE o_orderstatus <> 'F'"""
Q["ensemble_models"] = f"""WITH {nb_ctes(sampled_sql(TRAIN), _LB_ROWS, ('s',))},
ex AS (SELECT s, id, target, exp(ll - max(ll) OVER (PARTITION BY s, id)) AS e FROM nbl),
pr AS (SELECT s, id, target, e / sum(e) OVER (PARTITION BY s, id) AS p FROM ex),
mean AS (SELECT id, target, sum(p) / 3 AS p FROM pr GROUP BY id, target),
top AS (SELECT id, max(pred) AS ens_pred FROM nbp GROUP BY id)
SELECT id, any_value(ens_pred) AS ens_pred, {', '.join(f"round(max(CASE WHEN target = '{c}' THEN p END), 6) AS {c}" for c in ('high', 'low', 'mid'))}
FROM mean JOIN top USING (id) GROUP BY id"""
Q["grouped_linear"] = """SELECT event_type, count(*) AS n_rows, round(regr_slope(value, hour(ts)), 6) AS slope,
round(regr_intercept(value, hour(ts)), 6) AS intercept FROM events GROUP BY event_type"""
Q["smote_lsh"] = """WITH c AS (SELECT CASE WHEN o_totalprice > 470000 THEN 'yes' ELSE 'no' END AS target, count(*) AS k FROM orders GROUP BY 1)
SELECT target, (SELECT max(k) FROM c) AS n, (SELECT max(k) FROM c) - k AS n_new, 0::BIGINT AS n_wrong FROM c"""
