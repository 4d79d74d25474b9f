"""Registered queries, second part: split and folds, samplers, neighbours,
search bookkeeping, scalar functions, joins, describe tables, registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import lists, rowwise
from .operators import balance, encode, impute, knn, prep, sampling, search, smote, split
from .plans import describe
from .queries import register
from .sources import fixtures as fx
from .sources import tables

RARE_FEATURES = ("o_totalprice", "o_custkey", "m")
KFOLD = 5


def _ord(spark, sf_dir):
    return prep.prep_columns(fx.f_ord(spark, sf_dir), "row_id", "status")


def _rare(spark, sf_dir):
    return prep.prep_columns(fx.f_rare(spark, sf_dir), "row_id", "status")


def _ord_split(spark, sf_dir):
    return split.stratified_split(_ord(spark, sf_dir))


# ------------------------------------------------------------ split / folds
@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return _ord_split(spark, sf_dir).select("id", "target", "split")


@register("stratified_kfold")
def q_stratified_kfold(spark, sf_dir):
    train = _ord_split(spark, sf_dir).where(F.col("split") == "train").drop("split")
    return split.stratified_kfold(train, KFOLD).select("id", "target", "fold")


@register("split_shapes")
def q_split_shapes(spark, sf_dir):
    return balance.split_shapes(_ord_split(spark, sf_dir))


@register("label_encode")
def q_label_encode(spark, sf_dir):
    enc = encode.fit_label_encoder(_ord(spark, sf_dir))
    d = prep.prep_columns(fx.f_null(spark, sf_dir), "row_id", "status")
    return enc.transform(d).select("id", "target", F.col("label").cast("int").alias("label"))


# ------------------------------------------------------------------ samplers
@register("under_sample")
def q_under_sample(spark, sf_dir):
    return sampling.under_sample(_rare(spark, sf_dir)).select("id", "target")


@register("over_sample")
def q_over_sample(spark, sf_dir):
    return sampling.over_sample(_rare(spark, sf_dir)).select("id", "target", "copy_no")


@register("smote")
def q_smote(spark, sf_dir):
    s = smote.smote(_rare(spark, sf_dir), RARE_FEATURES)
    return s.select("id", "target", "synthetic", "copy_no", "nb_id", F.round("u", 6).alias("u"),
                    *[F.round(c, 4).alias(c) for c in RARE_FEATURES])


def _plan(spark, sf_dir):
    hist = _rare(spark, sf_dir)
    train = split.stratified_split(hist).where(F.col("split") == "train")
    return sampling.sampling_plan(hist, train)


@register("sampling_plan")
def q_sampling_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@register("model_combos")
def q_model_combos(spark, sf_dir):
    return sampling.model_combos(_plan(spark, sf_dir))


@register("hp_trials")
def q_hp_trials(spark, sf_dir):
    return search.hp_trials(sampling.model_combos(_plan(spark, sf_dir)))


@register("hp_trials_stored")
def q_hp_trials_stored(spark, sf_dir):
    """Stored parameters win over draws, also when they are empty."""
    combos = sampling.model_combos(_plan(spark, sf_dir))
    empty = search.hp_trials(combos, stored_params={}).withColumn("stored", F.lit("empty"))
    return empty.unionByName(search.hp_trials(combos, stored_params={"max_depth": 4}).withColumn("stored", F.lit("depth")))


@register("trial_grid")
def q_trial_grid(spark, sf_dir):
    t = search.hp_trials(sampling.model_combos(_plan(spark, sf_dir)))
    return search.trial_grid(t, KFOLD).select("replication_id", "model_name", "sampling_type", "fold")


@register("split_combo")
def q_split_combo(spark, sf_dir):
    c = sampling.model_combos(_plan(spark, sf_dir)).select("combo")
    return c.select("combo", lists.combo_model(F.col("combo")).alias("model"),
                    lists.combo_sampling(F.col("combo")).alias("sampling"),
                    lists.split_list(F.regexp_replace("combo", "_", " , ")).alias("parts"))


# --------------------------------------------------------------- neighbours
@register("knn_classify")
def q_knn_classify(spark, sf_dir):
    v = fx.f_vec(spark, sf_dir).select("id", F.col("embedding").cast("array<double>").alias("features"),
                                       F.col("label").alias("target"))
    s = split.stratified_split(v)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "validation")
    return knn.knn_classify(train, test, k=3)


# ----------------------------------------------------------- scalar functions
@register("parse_feature_list")
def q_parse_feature_list(spark, sf_dir):
    o = tables.read_table(spark, "orders", sf_dir)
    t = o.select("o_orderkey", lists.format_feature_list(F.array("o_orderstatus", "o_orderpriority"))
                 .alias("list_text"))
    arr = lists.parse_feature_list(F.col("list_text"))
    return t.select("o_orderkey", "list_text", arr[0].alias("first"), arr[1].alias("second"))


@register("parse_params")
def q_parse_params(spark, sf_dir):
    e = tables.read_table(spark, "events", sf_dir)
    return e.select("event_id", lists.parse_params(F.col("props"))["k"].alias("k"))


@register("format_ts")
def q_format_ts(spark, sf_dir):
    o = tables.read_table(spark, "orders", sf_dir)
    return o.select("o_orderkey", lists.format_ts(F.col("o_orderdate")).alias("ts_text"))


def _encoded_preds(spark, sf_dir):
    s = fx.f_scored(spark, sf_dir)
    arr = F.array(*[F.lit(c) for c in fx.SCORE_CLASSES])
    enc = lambda c: (F.array_position(arr, c) - 1).cast("int")
    four = rowwise.argmax_class(fx.SCORE_CLASSES[:4])
    return s.select("id", enc(F.col("pred")).alias("p1"), enc(F.col("actual")).alias("p2"),
                    enc(four).alias("p3"))


@register("ensemble_max")
def q_ensemble_max(spark, sf_dir):
    return _encoded_preds(spark, sf_dir).select("id", rowwise.ensemble_max(["p1", "p2", "p3"]).alias("ens_max"))


@register("ensemble_vote")
def q_ensemble_vote(spark, sf_dir):
    return rowwise.ensemble_vote(_encoded_preds(spark, sf_dir), "id", ["p1", "p2", "p3"]).select("id", "vote")


# ------------------------------------------------------------ joins / unions
@register("union_all")
def q_union_all(spark, sf_dir):
    a = fx.f_ord(spark, sf_dir).select("row_id", "status").withColumn("src", F.lit("ord"))
    b = fx.f_rare(spark, sf_dir).select("row_id", "status").withColumn("src", F.lit("rare"))
    return a.unionByName(b)


@register("join_actuals")
def q_join_actuals(spark, sf_dir):
    s = fx.f_scored(spark, sf_dir).select("id", "pred")
    ev = tables.read_table(spark, "events", sf_dir).select(F.col("event_id").alias("id"),
                                                           F.col("event_type").alias("actual"))
    return s.join(ev, "id", "inner")


@register("attach_scores")
def q_attach_scores(spark, sf_dir):
    """Prediction and class scores in one row; both are columns of the
    scored frame, so they are projected, not joined."""
    return fx.f_scored(spark, sf_dir).select("id", "pred", *fx.SCORE_CLASSES)


@register("history_fallback")
def q_history_fallback(spark, sf_dir):
    raw = tables.read_table(spark, "orders", sf_dir)
    hist = tables.read_or_empty(spark, "orders", raw, sf_dir)
    missing = tables.read_or_empty(spark, "orders_archive_absent", raw, sf_dir)  # -> empty
    both = hist.unionByName(missing)
    return both.select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("status"),
                       "o_totalprice", "o_custkey", F.month("o_orderdate").alias("m"))


@register("registry_lookup")
def q_registry_lookup(spark, sf_dir):
    o = tables.read_table(spark, "orders", sf_dir).select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return tables.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@register("registry_lookup_key")
def q_registry_lookup_key(spark, sf_dir):
    """S4 / F1 by key: newest row of one key, the equality filter in the scan."""
    o = tables.read_table(spark, "orders", sf_dir).select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return tables.lookup(o, "o_custkey", 7, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


# ------------------------------------------------------- modes and describe
@register("mode_values")
def q_mode_values(spark, sf_dir):
    return impute.mode_values(fx.f_null(spark, sf_dir), ["o_custkey", "m"])


@register("impute_mode")
def q_impute_mode(spark, sf_dir):
    d = fx.f_null(spark, sf_dir)
    modes = impute.fit_modes(d, ["o_custkey"])
    return impute.impute_mode(d, modes).select("row_id", "o_custkey")


def _r4(df, cols):
    return df.select(*[F.round(F.col(f"`{c}`"), 4).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


@register("describe_features")
def q_describe_features(spark, sf_dir):
    return _r4(describe.describe(fx.f_ord(spark, sf_dir), RARE_FEATURES), RARE_FEATURES)


@register("describe_by_split")
def q_describe_by_split(spark, sf_dir):
    d = split.stratified_split(_ord(spark, sf_dir))
    return _r4(describe.describe(d, RARE_FEATURES, by="split"), RARE_FEATURES)


@register("distribution_compare")
def q_distribution_compare(spark, sf_dir):
    d = describe.distribution_compare(_ord_split(spark, sf_dir), "split", "target")
    return d.select("split", "label", "count", F.round("share", 6).alias("share"))


# -------------------------------------------------------------------- sinks
def _scratch(spark, name):
    from .session import scratch_path
    return scratch_path(spark, name)


@register("keyed_upsert")
def q_keyed_upsert(spark, sf_dir):
    """Store F_ORD, then upsert the 'P' orders with doubled prices; read back."""
    from .sources import sinks
    path = _scratch(spark, "upsert")
    base = fx.f_ord(spark, sf_dir).select("row_id", "status", "o_totalprice")
    sinks.persist_data(base, path, ["row_id"])
    new = base.where(F.col("status") == "P").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return sinks.persist_data(new, path, ["row_id"])


@register("replace_by_key")
def q_replace_by_key(spark, sf_dir):
    """A table partitioned by model id (here the order priority); one
    model's rows are replaced, the others stay."""
    from .sources import sinks
    path = _scratch(spark, "registry")
    o = tables.read_table(spark, "orders", sf_dir)
    first = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("status"),
                     F.col("o_orderpriority").alias("model_id"))
    sinks.replace_by_key(first, path, "model_id")
    again = first.where(F.col("model_id") == "1-URGENT").withColumn("status", F.lower("status"))
    return sinks.replace_by_key(again, path, "model_id").select("row_id", "status", "model_id")


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Classification report exported as CSV and read back with its schema."""
    from .plans import metrics
    from .sources import sinks
    path = _scratch(spark, "csv")
    rep = metrics.classification_report(metrics.confusion_counts(fx.f_scored(spark, sf_dir)))
    sinks.export_csv(rep, path)
    return sinks.read_csv(spark, path, "value string, precision double, recall double, "
                                       "f1_score double, support double")


@register("run_log")
def q_run_log(spark, sf_dir):
    """The long test-metric table appended to a run log and read back."""
    from .queries import q_metrics_long
    from .sources import sinks
    path = _scratch(spark, "runs")
    log = sinks.log_run(q_metrics_long(spark, sf_dir), path, run_id="run-1", model_id="m-001",
                        run_name="test", kind="metric")
    return log.select("run_id", "model_id", "run_name", "kind", "name", F.col("value").cast("double").alias("value"))


@register("write_results")
def q_write_results(spark, sf_dir):
    """A result table replaced through the staging area (twice: the second
    write replaces the first) and read back."""
    from .sources import sinks
    path = _scratch(spark, "results")
    first = fx.f_ord(spark, sf_dir).select("row_id", "status")
    sinks.write_results(first, path)
    second = fx.f_rare(spark, sf_dir).select("row_id", "status")
    return sinks.write_results(second, path)
