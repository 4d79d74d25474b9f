"""Spark ML classes of the search (T2, T3): an Estimator that re-samples before it fits, its
model, and the macro F-beta Evaluator; for ``CrossValidator(foldCol=...)`` and pipelines.

``ResampledClassifier._fit`` re-samples the rows it is given and ``transform`` never
does, so a validation fold is never re-sampled. All three can be written and read.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import models


class ResampledClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A model family and a sampling over frames with ``id``, ``target`` and the feature columns."""

    modelName = Param(Params._dummy(), "modelName", "model family: rf, dt, xg, nb or ovr", TypeConverters.toString)
    samplingType = Param(Params._dummy(), "samplingType", "NA, us, os or smote", TypeConverters.toString)
    features = Param(Params._dummy(), "features", "feature columns", TypeConverters.toListString)
    hyperParameters = Param(Params._dummy(), "hyperParameters", "parameters as JSON", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of sampler and learner", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, modelName="nb", samplingType="NA", features=(), hyperParameters="{}", seed=1):
        super().__init__()
        self._setDefault(modelName="nb", samplingType="NA", features=[], hyperParameters="{}", seed=1)
        self._set(**{k: list(v) if k == "features" else v for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> ResampledModel:
        get = self.getOrDefault
        prepared = models.prepare(dataset, get(self.features), get(self.samplingType), get(self.seed))
        try:
            fm = models.fit_prepared(prepared, get(self.modelName), json.loads(get(self.hyperParameters)), get(self.seed))
        finally:
            if get(self.modelName) != "ovr":  # its model is the frame
                prepared.release()
        return ResampledModel(fm)


class ResampledModel(Model, MLReadable, MLWritable):
    """The fitted model: ``transform`` adds ``pred`` and a probability column per class."""

    def __init__(self, fitted: models.FittedModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return models.predict(self.fitted, dataset, keep=dataset.columns)

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        models.save_model(self.instance.fitted, path, "fitted")


class _Reader(MLReader):
    def load(self, path):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        m = ResampledModel(models.load_model(self.sparkSession, path, "fitted"))
        m._resetUid(meta["uid"])
        return m


class MacroFBetaEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Macro F-beta (or accuracy) of ``predictionCol`` against ``labelCol``, from
    one count per pair of labels."""

    beta = Param(Params._dummy(), "beta", "weight of recall", TypeConverters.toFloat)
    accuracy = Param(Params._dummy(), "accuracy", "accuracy instead", TypeConverters.toBoolean)
    labelCol = Param(Params._dummy(), "labelCol", "true label", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "predicted label", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, beta=1.0, accuracy=False, labelCol="target", predictionCol="pred"):
        super().__init__()
        self._setDefault(beta=1.0, accuracy=False, labelCol="target", predictionCol="pred")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        from ..plans.metrics import score_from_counts
        cols = [F.col(f"`{self.getOrDefault(p)}`").cast("string") for p in (self.labelCol, self.predictionCol)]
        rows = dataset.groupBy(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).count().collect()  # labels^2 rows
        return float(score_from_counts([tuple(r) for r in rows], self.getOrDefault(self.beta), self.getOrDefault(self.accuracy)))

    def isLargerBetter(self) -> bool:
        return True
