"""Learners (T4-T8), resampled fitting, scoring (T12) and the model store.

Every fit is a Spark ML job over a distributed DataFrame. A model is a
``PipelineModel``: mode imputer (fitted on train, Q9) -> VectorAssembler ->
StringIndexer (labels sorted, unseen -> n) -> classifier. Re-sampling is done
on the training frame just before ``fit`` (:mod:`.estimators` has it as an ML
Estimator), so it never touches validation folds or scoring. Over-sampling is a
weight per row: no row is copied, but for nearest neighbours.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import HistBoostClassifier
from .knn import knn
from .sampling import emit_copies, over_sample, over_sample_weights, under_sample
from .smote import smote

# Reference parameter name -> MLlib parameter (None = no MLlib
# counterpart; recorded as ignored).
RF_PARAMS = {"n_estimators": "numTrees", "max_depth": "maxDepth", "max_features": "featureSubsetStrategy",
             "criterion": "impurity", "min_samples_leaf": "minInstancesPerNode", "min_samples_split": None}
DT_PARAMS = {"max_depth": "maxDepth", "criterion": "impurity", "min_samples_leaf": "minInstancesPerNode",
             "max_features": None, "min_samples_split": None}
MAX_DEPTH = 30  # limit of Spark ML trees
BAG_BYTES = 64 << 20  # of a forest's draws in one partition


def _convert(mllib: str, value):
    if mllib in ("numTrees", "maxDepth", "minInstancesPerNode"):
        v = int(value)
        if mllib == "maxDepth" and v > MAX_DEPTH:
            raise ValueError(f"max_depth {v} is above the {MAX_DEPTH} levels that Spark ML trees may have")
        return v
    if mllib == "featureSubsetStrategy":
        return str(value) if isinstance(value, str) else repr(float(value))
    return value


def map_params(model_name: str, params: dict) -> tuple[dict, list[str]]:
    table = {"rf": RF_PARAMS, "dt": DT_PARAMS}.get(model_name, {})
    out, ignored = {}, []
    for k, v in params.items():
        m = table.get(k)
        if m is None:
            ignored.append(k)
        else:
            out[m] = _convert(m, v)
    return out, ignored


def build_classifier(model_name: str, params: dict | None, n_classes: int, seed: int = 1,
                     weight_col: str | None = None, total_weight: float | None = None):
    """A classifier for a model family and reference-named params. With weights the
    least rows of a leaf count copies, so they become a share of ``total_weight``."""
    kw, _ = map_params(model_name, params or {})
    common = dict(featuresCol="features", labelCol="label")
    if weight_col:
        common["weightCol"] = weight_col
        least = kw.pop("minInstancesPerNode", 1)
        if least > 1 and total_weight:
            kw["minWeightFractionPerNode"] = min((least - 0.5) / total_weight, 0.49)
    tree = dict(maxMemoryInMB=512)  # more nodes per pass over the data; same model definition
    if model_name == "rf":
        return RandomForestClassifier(seed=seed, **common, **tree, **kw)
    if model_name == "dt":
        return DecisionTreeClassifier(seed=seed, **common, **tree, **kw)
    if model_name == "xg":
        return HistBoostClassifier(boostParams=json.dumps(params or {}), numClasses=n_classes, seed=seed, idCol="id", **common)
    if model_name == "nb":
        return NaiveBayes(modelType="gaussian", **common)
    raise ValueError(f"no estimator for model family {model_name!r} (use 'ovr' via knn)")


@dataclass
class FittedModel:
    """A fitted combo: the pipeline (or kNN reference set) and its labels."""
    model_name: str
    sampling_type: str
    features: list[str]
    labels: list[str]
    pipeline: PipelineModel | None = None
    knn_train: DataFrame | None = None
    params: dict = field(default_factory=dict)


def _raw(features: Sequence[str]) -> list:
    """The features as doubles under internal names (any name is allowed)."""
    return [F.col(f"`{c}`").cast("double").alias(f"__f{i}") for i, c in enumerate(features)]


def _prep_stages(n: int):
    imp = Imputer(inputCols=[f"__f{i}" for i in range(n)], outputCols=[f"__imp{i}" for i in range(n)], strategy="mode")
    asm = VectorAssembler(inputCols=imp.getOutputCols(), outputCol="features", handleInvalid="keep")
    idx = StringIndexer(inputCol="target", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep")
    return imp, asm, idx


def resample(train: DataFrame, sampling_type: str, features: Sequence[str], seed: int = 1) -> DataFrame:
    """Apply a sampler to a training frame (id, features..., target)."""
    if sampling_type == "us":
        return under_sample(train, seed=seed)
    if sampling_type == "os":
        return over_sample(train, seed=seed).drop("copy_no")
    if sampling_type == "smote":
        s = smote(train, features, seed=seed)
        return s.select("id", *features, "target")
    return train


@dataclass
class Prepared:
    """A resampled, imputed, assembled and label-indexed training frame (cached)
    plus the fitted preparation stages; shared by every trial of one
    (fold, sampling) so a search refits only the classifier."""
    frame: DataFrame
    stages: list
    labels: list[str]
    features: list[str]
    sampling_type: str
    weight: str | None = None  # column of copy counts

    def release(self) -> None:
        self.frame.unpersist()

    def total_weight(self) -> float | None:
        return self.frame.agg(F.sum(self.weight)).first()[0] if self.weight else None


def fit_stages(train: DataFrame, features: Sequence[str]) -> list:
    """The fitted preparation (imputer, assembler, indexer) of a training frame. No sampler adds or
    drops a class, so it serves every sampling of these rows."""
    imp, asm, idx = _prep_stages(len(features))
    return [imp.fit(train.select(*_raw(features))), asm, idx.fit(train.select("target"))]


def prepare(train: DataFrame, features: Sequence[str], sampling_type: str = "NA", seed: int = 1,
            cache: bool = True, stages: list | None = None) -> Prepared:
    """Imputes with the modes of the train rows, then re-samples, assembles and
    indexes (a sampler never sees a null, and copies do not shift the modes).
    ``stages`` are those of the same rows, when :func:`fit_stages` has run."""
    feats = list(features)
    d = train.select("id", *_raw(feats), "target")
    imp, asm, idx = stages or fit_stages(train, feats)
    d = imp.transform(d).select("id", *imp.getOutputCols(), "target")
    weight = "weight" if sampling_type == "os" else None
    d = over_sample_weights(d, seed=seed, weight_col=weight) if weight else resample(d, sampling_type, imp.getOutputCols(), seed)
    labels = list(idx.labels)  # sorted class list from the indexer (bounded)
    frame = idx.transform(asm.transform(d)).select("id", "features", "label", "target", *([weight] if weight else []))
    if cache:
        frame = frame.persist()
    return Prepared(frame, [imp, asm, idx], labels, feats, sampling_type, weight)


def fit_prepared(prep_: Prepared, model_name: str, params: dict | None = None, seed: int = 1) -> FittedModel:
    """Fit one classifier on a prepared frame; the model carries the shared stages."""
    return fit_many(prep_, model_name, [params or {}], seed)[0]


def forest_parts(rows: int, trees: int) -> int:
    """Partitions of about ``BAG_BYTES``: a forest keeps a row's number of draws for every tree, four bytes each."""
    return -(-rows * trees * 4 // BAG_BYTES)


def spread(frame: DataFrame, trees: int) -> DataFrame:
    """The frame in partitions that one task can read with the draws of that many trees."""
    parts = forest_parts(frame.count(), trees)
    return frame.repartition(parts, "id") if parts > frame.sparkSession.sparkContext.defaultParallelism else frame


def fit_many(prep_: Prepared, model_name: str, params: Sequence[dict], seed: int = 1) -> list[FittedModel]:
    """A model of one family for each parameter set; boosted ones are grown together,
    so that one pass over the rows serves them all."""
    if model_name == "ovr":
        ref = prep_.frame
        if prep_.weight:  # neighbours are rows: here the copies are needed
            ref = emit_copies(ref.withColumn("__c", (F.col(prep_.weight) - 1).cast("long")), "id", "__c", "copy_no", 0)
        ref = ref.select("id", vector_to_array("features").alias("features"), "target")
        return [FittedModel(model_name, prep_.sampling_type, prep_.features, prep_.labels,
                            pipeline=PipelineModel(stages=prep_.stages[:2]), knn_train=ref, params=p) for p in params]
    if model_name == "xg":
        clf = build_classifier("xg", {}, len(prep_.labels), seed, prep_.weight)
        fitted = clf.fit_many(prep_.frame, params)
    else:
        total = prep_.total_weight()
        clfs = [build_classifier(model_name, p, len(prep_.labels), seed, prep_.weight, total) for p in params]
        fitted = [c.fit(spread(prep_.frame, c.getNumTrees()) if model_name == "rf" else prep_.frame) for c in clfs]
    return [FittedModel(model_name, prep_.sampling_type, prep_.features, prep_.labels,
                        pipeline=PipelineModel(stages=prep_.stages + [m]), params=p)
            for m, p in zip(fitted, params, strict=True)]


def fit_model(train: DataFrame, features: Sequence[str], model_name: str, sampling_type: str = "NA",
              params: dict | None = None, seed: int = 1) -> FittedModel:
    """T9 / ResampledClassifier: resample the train frame, then fit the pipeline."""
    p = prepare(train, features, sampling_type, seed, cache=False)
    return fit_prepared(p, model_name, params, seed)


def predict(fm: FittedModel, df: DataFrame, keep: Sequence[str] = ("id",),
            with_probability: bool = True, k: int = 3) -> DataFrame:
    """(keep..., pred, one probability column per class)."""
    labels = fm.labels
    keep = [c for c in keep if c in df.columns]
    if fm.model_name == "ovr":
        d = df.select("id", *_raw(fm.features))
        q = fm.pipeline.transform(d).select("id", vector_to_array("features").alias("features"))
        nn = knn(q, fm.knn_train, k, carry=["target"])  # the label comes with the neighbour: ids may repeat
        votes = nn.groupBy("qid").pivot("target", labels).count().na.fill(0)
        arr = F.array(*[F.col(f"`{c}`") for c in labels])
        pred = F.element_at(F.array(*[F.lit(c) for c in labels]),
                            F.array_position(arr, F.array_max(arr)).cast("int"))
        probs = [(F.col(f"`{c}`") / F.lit(float(k))).alias(c) for c in labels] if with_probability else []
        out = votes.select(F.col("qid").alias("id"), pred.alias("pred"), *probs)
        return df.select(*[F.col(f"`{c}`") for c in keep]).join(out, "id")
    d = df.select(*[F.col(f"`{c}`") for c in keep], *_raw(fm.features))
    t = PipelineModel([s for s in fm.pipeline.stages if not isinstance(s, StringIndexerModel)]).transform(d)
    p = vector_to_array("probability")
    probs = [p[i].alias(c) for i, c in enumerate(labels)]
    lab_arr = F.array(*[F.lit(c) for c in labels])
    pred = F.element_at(lab_arr, (F.col("prediction").cast("int") + 1))
    cols = [*[F.col(f"`{c}`") for c in keep], F.coalesce(pred, F.lit("<unknown>")).alias("pred")]
    if with_probability:
        cols += probs
    return t.select(*cols)


def ensemble(fitted: dict[str, FittedModel], df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Every fitted combo over one scan of ``df``: (keep..., ``ens_pred``: the largest
    encoded prediction, the mean probability of each class). The transforms are chained
    under private column names: no join on the id."""
    labels = sorted({c for fm in fitted.values() for c in fm.labels})
    if any(fm.model_name == "ovr" for fm in fitted.values()):
        raise ValueError("nearest neighbours need a join; they are not part of an ensemble")
    d, names = df, list(df.columns)
    preds, probs = [], {c: [] for c in labels}
    for i, fm in enumerate(fitted.values()):
        mine = [f"__e{i}_pred", *(f"__e{i}_{j}" for j in range(len(fm.labels)))]
        d = predict(fm, d, keep=names).toDF(*names, *mine)  # by position: a feature may be named like a class
        names += mine
        preds.append(mine[0])
        for c, n in zip(fm.labels, mine[1:], strict=True):
            probs[c].append(F.col(n))
    code = F.greatest(*[F.array_position(F.array(*[F.lit(c) for c in labels]), F.col(n)) for n in preds], F.lit(0))
    mean = [(sum(p, F.lit(0.0)) / float(len(fitted))).alias(c) for c, p in probs.items()]
    return d.select(*[F.col(f"`{c}`") for c in keep],
                    F.element_at(F.array(*[F.lit(c) for c in labels]), code.cast("int")).alias("ens_pred"), *mean)


def feature_importance(fm: FittedModel) -> list[tuple[str, float]]:
    """(feature, importance) from trees."""
    m = fm.pipeline.stages[-1]
    if not hasattr(m, "featureImportances"):
        return []
    return sorted(zip(fm.features, map(float, m.featureImportances.toArray())), key=lambda t: -t[1])


def loss_curve(fm: FittedModel, sets: dict[str, DataFrame]) -> DataFrame:
    """``set, n_trees, loss``: multi-class log-loss of a boosted model after each round, over
    all sets in one pass."""
    head = PipelineModel(list(fm.pipeline.stages[:-1]))
    out = None
    for name, d in sets.items():
        t = d.select("id", *_raw(fm.features), "target").withColumn("set", F.lit(name))
        out = t if out is None else out.unionByName(t)
    return fm.pipeline.stages[-1].evaluate_each_round(head.transform(out))


def save_model(fm: FittedModel, root: str, model_id: str) -> str:
    """Pipeline + metadata under ``<root>/<model_id>``."""
    path = f"{root.rstrip('/')}/{model_id.strip()}"
    fm.pipeline.write().overwrite().save(f"{path}/pipeline")
    meta = {"model_name": fm.model_name, "sampling_type": fm.sampling_type, "features": fm.features,
            "labels": fm.labels, "params": fm.params}
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    s.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    if fm.knn_train is not None:
        fm.knn_train.write.mode("overwrite").parquet(f"{path}/knn_train")
    return path


def load_model(spark, root: str, model_id: str) -> FittedModel:
    path = f"{root.rstrip('/')}/{model_id.strip()}"
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    pm = PipelineModel.load(f"{path}/pipeline")
    knn_train = spark.read.parquet(f"{path}/knn_train") if meta["model_name"] == "ovr" else None
    return FittedModel(meta["model_name"], meta["sampling_type"], meta["features"], meta["labels"],
                       pipeline=pm, knn_train=knn_train, params=meta.get("params", {}))
