"""DuckDB oracles, second part (split, samplers, neighbours, bookkeeping,
functions, joins, describe)."""

from __future__ import annotations

from .functions.hashing import sql_hash32, sql_hash_unit
from .oracle import F_NULL, F_ORD, F_RARE, F_SCORED, F_VEC, Q

K = 5
RARE_FEATURES = ("o_totalprice", "o_custkey", "m")
CLASSES = ("click", "error", "purchase", "signup", "view")

ORD = f"SELECT row_id AS id, o_totalprice, o_custkey, m, coalesce(CAST(status AS VARCHAR), 'nan') AS target FROM ({F_ORD})"
RARE = f"SELECT row_id AS id, o_totalprice, o_custkey, m, coalesce(CAST(status AS VARCHAR), 'nan') AS target FROM ({F_RARE})"


def split_sql(src: str, seed=1, share=0.33) -> str:
    """All columns of ``src`` plus ``split``."""
    return f"""SELECT * EXCLUDE (__h, __r, __n),
       CASE WHEN __r <= floor(__n * CAST({share!r} AS DOUBLE) + 0.5) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY __h, id) AS __r,
             count(*) OVER (PARTITION BY target) AS __n
      FROM (SELECT *, {sql_hash32(seed, 'id')} AS __h FROM ({src})))"""


def hash_rank_sql(src: str, seed: str) -> str:
    """``src`` plus __rank (in class by md5 draw), __n (class size), __min, __max."""
    return f"""SELECT *, min(__n) OVER () AS __min, max(__n) OVER () AS __max FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY __h, id) AS __rank,
         count(*) OVER (PARTITION BY target) AS __n
  FROM (SELECT *, {sql_hash32(seed, 'id')} AS __h FROM ({src})))"""


def kfold_sql(src: str, k: int = K) -> str:
    def cnt(x: str, f: int) -> str:
        return f"(CASE WHEN {x} > 0 THEN ({x} - {f} + {k} - 1) // {k} ELSE 0 END)"
    cq = []
    for f in range(k):
        terms = " + ".join(f"({cnt('st + n', g)} - {cnt('st', g)})" for g in range(f + 1))
        cq.append(f"{terms} AS cq{f}")
    fold = " + ".join(f"CAST(cq{f} < r AS INTEGER)" for f in range(k))
    return f"""WITH d AS ({src}),
cls AS (SELECT target, count(*) AS n, min(id) AS first FROM d GROUP BY target),
st AS (SELECT target, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM cls),
q AS (SELECT target, {', '.join(cq)} FROM st),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY id) AS r FROM d)
SELECT r.* EXCLUDE (r), {fold} AS fold FROM r JOIN q USING (target)"""


ORD_SPLIT = split_sql(ORD)
Q["stratified_split"] = f"SELECT id, target, split FROM ({ORD_SPLIT})"
Q["stratified_kfold"] = (f"SELECT id, target, fold FROM ({kfold_sql(f'SELECT * EXCLUDE (split) FROM ({ORD_SPLIT}) WHERE split = {chr(39)}train{chr(39)}')})")
Q["split_shapes"] = f"SELECT split, count(*) AS rows, CAST(4 AS BIGINT) AS columns FROM ({ORD_SPLIT}) GROUP BY split"
Q["label_encode"] = f"""
WITH lab AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT CAST(status AS VARCHAR) AS label FROM ({F_ORD}))),
n AS (SELECT CAST(count(*) AS INTEGER) AS n FROM lab),
d AS (SELECT row_id AS id, coalesce(CAST(status AS VARCHAR), 'nan') AS target FROM ({F_NULL}))
SELECT d.id, d.target, coalesce(lab.code, n.n) AS label FROM d LEFT JOIN lab ON d.target = lab.label CROSS JOIN n"""

Q["under_sample"] = f"SELECT id, target FROM ({hash_rank_sql(RARE, 'us1')}) WHERE __rank <= __min"
_OS = f"""SELECT id, target, CAST(CASE WHEN __rank <= __max - __n THEN floor((__max - __n - __rank) / __n) + 1 ELSE 0 END AS INTEGER) AS c
FROM ({hash_rank_sql(RARE, 'os1')})"""
Q["over_sample"] = (f"SELECT id, target, CAST(x AS BIGINT) AS copy_no FROM "
                    f"(SELECT id, target, unnest(generate_series(0, c)) AS x FROM ({_OS}))")


def _smote_sql() -> str:
    f = RARE_FEATURES
    dist = " + ".join(f"(CAST(a.{c} AS DOUBLE) - CAST(b.{c} AS DOUBLE))^2" for c in f)
    rank = hash_rank_sql(RARE, "sm1")
    return f"""
WITH base AS ({RARE}),
rk AS (SELECT *, CAST(CASE WHEN __rank <= __max - __n THEN floor((__max - __n - __rank) / __n) + 1 ELSE 0 END AS INTEGER) AS c
       FROM ({rank})),
need AS (SELECT id, target, CAST(x AS BIGINT) AS copy_no FROM (SELECT id, target, unnest(generate_series(1, c)) AS x FROM rk WHERE c > 0)),
seeds AS (SELECT DISTINCT id, target FROM need),
nn AS (SELECT qid, cid, nn_rank FROM (
        SELECT a.id AS qid, b.id AS cid,
               row_number() OVER (PARTITION BY a.id ORDER BY sqrt({dist}), b.id) AS nn_rank
        FROM seeds s JOIN base a ON a.id = s.id JOIN base b ON b.target = a.target AND b.id <> a.id)
       WHERE nn_rank <= 5),
syn AS (SELECT need.id, need.target, need.copy_no,
               CAST({sql_hash32('1:nb', 'need.id', 'need.copy_no')} % 5 + 1 AS INTEGER) AS pick,
               {sql_hash_unit('1:u', 'need.id', 'need.copy_no')} AS u FROM need)
SELECT syn.id, syn.target, true AS synthetic, syn.copy_no, nn.cid AS nb_id, round(syn.u, 6) AS u,
       {', '.join(f'round(CAST(a.{c} AS DOUBLE) + syn.u * (CAST(b.{c} AS DOUBLE) - CAST(a.{c} AS DOUBLE)), 4) AS {c}' for c in f)}
FROM syn JOIN nn ON nn.qid = syn.id AND nn.nn_rank = syn.pick
JOIN base a ON a.id = syn.id JOIN base b ON b.id = nn.cid
UNION ALL
SELECT id, target, false, 0, NULL, NULL, {', '.join(f'round(CAST({c} AS DOUBLE), 4)' for c in f)} FROM base"""


Q["smote"] = _smote_sql()

RARE_SPLIT = split_sql(RARE)
PLAN = f"""
WITH h AS (SELECT min(c) / max(c) AS extent FROM (SELECT target, count(*) AS c FROM ({RARE}) GROUP BY target)),
t AS (SELECT count(*) * min(c) AS us_rows FROM (SELECT target, count(*) AS c FROM ({RARE_SPLIT}) WHERE split = 'train' GROUP BY target)),
f AS (SELECT round(extent, 4) < 0.10 AS imb, us_rows FROM h, t)
SELECT 'NA' AS sampling_type, 0 AS ord FROM f
UNION ALL SELECT 'us', 1 FROM f WHERE imb AND us_rows > 10000
UNION ALL SELECT 'smote', 2 FROM f WHERE imb
UNION ALL SELECT 'os', 3 FROM f WHERE imb"""
Q["sampling_plan"] = PLAN
COMBOS = f"""SELECT m.model_name, p.sampling_type, m.mi * 100 + p.ord AS ord, m.model_name || '_' || p.sampling_type AS combo
FROM ({PLAN}) p CROSS JOIN (VALUES ('rf', 0), ('xg', 1)) m(model_name, mi)"""
Q["model_combos"] = COMBOS
Q["split_combo"] = (f"SELECT combo, split_part(combo, '_', 1) AS model, split_part(combo, '_', 2) AS sampling, "
                    f"[lower(trim(split_part(combo, '_', 1))), lower(trim(split_part(combo, '_', 2)))] AS parts "
                    f"FROM ({COMBOS})")


def _draw(h: str, values) -> str:
    arr = "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
    return f"{arr}[CAST({h} % {len(values)} AS INTEGER) + 1]"


def _json_sql(model: str) -> str:
    rid = "replication_id"
    if model == "rf":
        items = [
            ("n_estimators", f"CAST(100 + {sql_hash32(1, rid, chr(39) + 'n_estimators' + chr(39))} % 301 AS VARCHAR)"),
            ("max_depth", f"CAST(2 + {sql_hash32(1, rid, chr(39) + 'max_depth' + chr(39))} % 10 AS VARCHAR)"),
            ("min_samples_leaf", f"CAST(5 + {sql_hash32(1, rid, chr(39) + 'min_samples_leaf' + chr(39))} % 10 AS VARCHAR)"),
            ("min_samples_split", f"CAST(5 + {sql_hash32(1, rid, chr(39) + 'min_samples_split' + chr(39))} % 10 AS VARCHAR)"),
            ("max_features", _draw(sql_hash32(1, rid, "'max_features'"), ('"log2"', '"sqrt"'))),
            ("criterion", _draw(sql_hash32(1, rid, "'criterion'"), ('"gini"', '"entropy"'))),
        ]
    else:
        space = (("learning_rate", ("0.001", "0.01")), ("n_estimators", ("100", "300", "500")),
                 ("max_depth", ("3", "5", "7")), ("gamma", ("0", "0.01", "0.05", "0.1", "0.2", "0.3")),
                 ("colsample_bytree", ("0.3", "0.5", "0.7")), ("reg_alpha", ("0", "0.01", "0.1", "0.5")),
                 ("reg_lambda", ("0.1", "1", "5", "10", "100")), ("min_child_weight", ("1", "3", "5", "10", "15")),
                 ("subsample", ("0.5", "0.7")))
        items = [(n, _draw(sql_hash32(1, rid, f"'{n}'"), vals)) for n, vals in space]
    parts = []
    for i, (n, e) in enumerate(items):
        parts.append(("'{' || " if i == 0 else "', ' || ") + f"'\"{n}\": ' || {e}")
    return " || ".join(parts) + " || '}'"


TRIALS = f"""
WITH c AS (SELECT *, CASE model_name WHEN 'xg' THEN 40 WHEN 'rf' THEN 20 ELSE 1 END AS n FROM ({COMBOS})),
s AS (SELECT *, 1 + coalesce(sum(n) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM c),
t AS (SELECT model_name, sampling_type, CAST(unnest(generate_series(CAST(start AS BIGINT), CAST(start + n - 1 AS BIGINT))) AS INTEGER) AS replication_id FROM s)
SELECT replication_id, model_name, sampling_type,
       CASE model_name WHEN 'xg' THEN {_json_sql('xg')} WHEN 'rf' THEN {_json_sql('rf')} ELSE '{{}}' END AS hyper_parameters
FROM t"""
Q["hp_trials"] = TRIALS
_ONE = (f"SELECT CAST(row_number() OVER (ORDER BY min(replication_id)) AS INTEGER) AS replication_id, model_name, "
        f"sampling_type FROM ({TRIALS}) GROUP BY model_name, sampling_type")
Q["hp_trials_stored"] = (f"SELECT *, '{{}}' AS hyper_parameters, 'empty' AS stored FROM ({_ONE}) UNION ALL "
                         f"SELECT *, '{{\"max_depth\": 4}}', 'depth' FROM ({_ONE})")
Q["trial_grid"] = (f"SELECT replication_id, model_name, sampling_type, CAST(unnest(generate_series(0, {K - 1})) AS INTEGER) AS fold "
                   f"FROM ({TRIALS})")

# --------------------------------------------------------------- neighbours
_VEC_SPLIT = split_sql(f"SELECT id, CAST(embedding AS DOUBLE[]) AS features, label AS target FROM ({F_VEC})")
Q["knn_classify"] = f"""
WITH s AS ({_VEC_SPLIT}),
tr AS (SELECT * FROM s WHERE split = 'train'), te AS (SELECT * FROM s WHERE split = 'validation'),
nn AS (SELECT * FROM (SELECT te.id AS qid, tr.target AS nl,
          row_number() OVER (PARTITION BY te.id ORDER BY list_distance(te.features, tr.features), tr.id) AS r
       FROM te, tr) WHERE r <= 3),
v AS (SELECT qid, nl, count(*) AS v FROM nn GROUP BY qid, nl)
SELECT qid AS id, pred FROM (SELECT qid, nl AS pred, row_number() OVER (PARTITION BY qid ORDER BY v DESC, nl) AS r FROM v)
WHERE r = 1"""

# ----------------------------------------------------------- scalar functions
Q["parse_feature_list"] = ("SELECT o_orderkey, '[''' || o_orderstatus || ''', ''' || o_orderpriority || ''']' AS list_text, "
                           "o_orderstatus AS first, o_orderpriority AS second FROM orders")
Q["parse_params"] = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"
Q["format_ts"] = "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS ts_text FROM orders"


def _enc(e: str) -> str:
    return "CASE " + " ".join(f"WHEN {e} = '{c}' THEN {i}" for i, c in enumerate(CLASSES)) + " END"


_P3 = ("CASE WHEN click >= greatest(error, purchase, signup) THEN 'click' "
       "WHEN error >= greatest(purchase, signup) THEN 'error' WHEN purchase >= signup THEN 'purchase' ELSE 'signup' END")
_PREDS = f"SELECT id, {_enc('pred')} AS p1, {_enc('actual')} AS p2, {_enc(_P3)} AS p3 FROM ({F_SCORED})"
Q["ensemble_max"] = f"SELECT id, CAST(greatest(p1, p2, p3) AS INTEGER) AS ens_max FROM ({_PREDS})"
Q["ensemble_vote"] = (f"SELECT id, CAST(CASE WHEN p1 = p2 OR p1 = p3 THEN p1 WHEN p2 = p3 THEN p2 "
                      f"ELSE least(p1, p2, p3) END AS INTEGER) AS vote FROM ({_PREDS})")

# ------------------------------------------------------------ joins / unions
Q["union_all"] = (f"SELECT row_id, status, 'ord' AS src FROM ({F_ORD}) "
                  f"UNION ALL SELECT row_id, status, 'rare' FROM ({F_RARE})")
Q["join_actuals"] = (f"SELECT s.id, s.pred, e.event_type AS actual FROM ({F_SCORED}) s "
                     f"JOIN events e ON e.event_id = s.id")
Q["attach_scores"] = f"SELECT id, pred, {', '.join(CLASSES)} FROM ({F_SCORED})"
Q["history_fallback"] = F_ORD
Q["registry_lookup"] = """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r = 1"""

# ------------------------------------------------------- modes and describe
Q["mode_values"] = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, v AS mode, c AS count FROM (
  SELECT CAST({c} AS DOUBLE) AS v, count(*) AS c FROM ({F_NULL}) WHERE {c} IS NOT NULL GROUP BY 1
  ORDER BY c DESC, v LIMIT 1)""" for c in ("o_custkey", "m"))
Q["impute_mode"] = f"""
WITH m AS (SELECT CAST(o_custkey AS DOUBLE) AS v FROM ({F_NULL}) WHERE o_custkey IS NOT NULL
           GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT row_id, coalesce(CAST(o_custkey AS DOUBLE), m.v) AS o_custkey FROM ({F_NULL}) CROSS JOIN m"""


def _describe_sql(src: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    stats = (("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"),
             ("min", "CAST(min({c}) AS DOUBLE)"), ("25%", "quantile_cont({c}, 0.25)"),
             ("50%", "quantile_cont({c}, 0.5)"), ("75%", "quantile_cont({c}, 0.75)"),
             ("max", "CAST(max({c}) AS DOUBLE)"))
    parts = []
    for name, tmpl in stats:
        cols = ", ".join(f"round({tmpl.format(c=c)}, 4) AS {c}" for c in RARE_FEATURES)
        parts.append(f"SELECT {g}'{name}' AS statistic, {cols} FROM ({src})" + (f" GROUP BY {by}" if by else ""))
    return " UNION ALL ".join(parts)


Q["describe_features"] = _describe_sql(F_ORD, None)
Q["describe_by_split"] = _describe_sql(ORD_SPLIT, "split")
Q["distribution_compare"] = f"""
SELECT split, target AS label, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
FROM ({ORD_SPLIT}) GROUP BY split, target"""

# -------------------------------------------------------------------- sinks
Q["keyed_upsert"] = (f"SELECT row_id, status, CASE WHEN status = 'P' THEN o_totalprice * 2 ELSE o_totalprice END "
                     f"AS o_totalprice FROM ({F_ORD})")
Q["replace_by_key"] = ("SELECT o_orderkey AS row_id, CASE WHEN o_orderpriority = '1-URGENT' THEN lower(o_orderstatus) "
                       "ELSE o_orderstatus END AS status, o_orderpriority AS model_id FROM orders")
Q["csv_roundtrip"] = Q["classification_report"]
Q["run_log"] = (f"SELECT 'run-1' AS run_id, 'm-001' AS model_id, 'test' AS run_name, 'metric' AS kind, "
                f"\"Metric\" AS name, \"Value\" AS value FROM ({Q['metrics_long']})")
Q["write_results"] = f"SELECT row_id, status FROM ({F_RARE})"

Q["registry_lookup_key"] = """SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1"""
