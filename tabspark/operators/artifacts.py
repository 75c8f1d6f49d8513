"""Stored preparation and models, and scoring from them.

Everything a score needs is a ``pyspark.ml`` stage with a writer and a reader of
its own: ``PreparationModel`` (fitted F1-F9 transforms; its level dictionary is a
Parquet table beside the metadata), ``ScaledTargetModel`` (target transform and
scaler around any regression model) and ``DenseNetModel``.  A scorer is a
``PipelineModel`` of such stages, so the metadata of the stored stages say which
class reads them.

A store is a folder: ``single`` and ``ensemble/member=<name>`` hold one pipeline
each and ``metadata`` one JSON row.  Members that begin with the same fitted
preparation share it when they score: rows are prepared once and each member adds
a column, so no join is made and the plan runs on a stream as it is.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, fields

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsReadable, DefaultParamsWriter, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import FeatureSpec
from ..functions.stats import not_finite
from ..functions.target import floor_prediction, forward_target, inverse_target
from ..sources.io import path_exists
from . import prep as P
from .design import FittedPreprocessor, PreprocessConfig, fit_preprocessor
from .models import dense_forward

DICTIONARY = "feature string, level string, slot int, rare boolean"


# ------------------------------------------------------------------ preparation

def _pairs(params: P.Params | None) -> list | None:
    """Rows of a parameter table: one per column and statistic."""
    return None if params is None else sorted([f, s, v] for (f, s), v in params.values().items())


def _params(spark: SparkSession, rows: list | None) -> P.Params | None:
    return None if rows is None else P.Params(spark.createDataFrame([tuple(r) for r in rows], P.PARAM_SCHEMA))


def preparation_state(fitted: FittedPreprocessor) -> str:
    """Everything but the level dictionary, as JSON."""
    n = fitted.numeric
    return json.dumps({
        "config": asdict(fitted.config), "spec": asdict(fitted.spec), "key": fitted.key, "nominal": fitted.nominal,
        "numeric": {"cols": n.cols, "indicators": n.indicators, "winsor": _pairs(n.winsor), "impute": _pairs(n.impute), "scale": _pairs(n.scale)},
        "ordinal_levels": {c: list(v) for c, v in fitted.ordinal_levels.items()}, "ordinal": _pairs(fitted.ordinal)}, sort_keys=True)


def preparation_from_state(spark: SparkSession, state: str, dictionary: DataFrame | None) -> FittedPreprocessor:
    x = json.loads(state)
    n = x["numeric"]
    numeric = P.NumericModel(n["cols"], _params(spark, n["winsor"]), _params(spark, n["impute"]), _params(spark, n["scale"]), n["indicators"])
    spec = FeatureSpec(**{f.name: {k: tuple(v) if isinstance(v, list) else v for k, v in x["spec"][f.name].items()}
                          if isinstance(x["spec"][f.name], dict) else tuple(x["spec"][f.name]) for f in fields(FeatureSpec)})
    return FittedPreprocessor(PreprocessConfig(**x["config"]), spec, x["key"], numeric, x["ordinal_levels"],
                              _params(spark, x["ordinal"]), dictionary, x["nominal"])


class _PreparationWriter(MLWriter):
    def __init__(self, instance: PreparationModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        dictionary = self.instance.fitted().dictionary
        if dictionary is not None:
            dictionary.select("feature", "level", "slot", "rare").write.parquet(f"{path}/dictionary")


class _PreparationReader(MLReader):
    def load(self, path: str) -> PreparationModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = PreparationModel()
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        table = f"{path}/dictionary"
        out.dictionary = self.sparkSession.read.schema(DICTIONARY).parquet(table) if path_exists(table) else None
        return out


class PreparationModel(Model, MLWritable, MLReadable):
    """Fitted transforms as a stage: the input's columns plus a vector column."""

    state = Param(Params._dummy(), "state", "fitted parameters as JSON", TypeConverters.toString)
    vectorCol = Param(Params._dummy(), "vectorCol", "name of the vector column", TypeConverters.toString)

    def __init__(self, fitted: FittedPreprocessor | None = None, vector: str = "features"):
        super().__init__()
        self._fitted, self.dictionary = fitted, None if fitted is None else fitted.dictionary
        self._set(vectorCol=vector, **({} if fitted is None else {"state": preparation_state(fitted)}))

    def fitted(self) -> FittedPreprocessor:
        if self._fitted is None:
            self._fitted = preparation_from_state(SparkSession.getActiveSession(), self.getOrDefault(self.state), self.dictionary)
        return self._fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector = self.getOrDefault(self.vectorCol)
        # the input travels as one column, so that transforms that replace a column leave it as it is
        own = dataset.withColumn("__input", F.struct(*[F.col(f"`{c}`") for c in dataset.columns]))
        out, _ = self.fitted().transform(own, vector, keep=["__input"])
        return out.select("__input.*", vector)

    def write(self) -> MLWriter:
        return _PreparationWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _PreparationReader()


class Preparation(Estimator):
    """Fits the column router (F9) on the rows given."""

    def __init__(self, key: str, target: str | None, spec: FeatureSpec = FeatureSpec(), config: PreprocessConfig = PreprocessConfig(),
                 ordinal_levels: Mapping[str, Sequence[str]] | None = None, exclude: Sequence[str] = ()):
        super().__init__()
        self.args = key, target, spec, config, ordinal_levels
        self.exclude = list(exclude)

    def _fit(self, dataset: DataFrame) -> PreparationModel:
        return PreparationModel(fit_preprocessor(dataset.drop(*self.exclude), *self.args))


# ------------------------------------------------------------------ target

class _TargetWriter(MLWriter):
    def __init__(self, instance: ScaledTargetModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.model.write().save(f"{path}/model")


class _TargetReader(MLReader):
    def load(self, path: str) -> ScaledTargetModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = ScaledTargetModel(DefaultParamsReader.loadParamsInstance(f"{path}/model", self.sparkSession))
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out


class ScaledTargetModel(Model, MLWritable, MLReadable):
    """A regression model of the scaled, transformed target; adds ``predictionCol`` in target units."""

    center = Param(Params._dummy(), "center", "mean of the transformed target", TypeConverters.toFloat)
    scale = Param(Params._dummy(), "scale", "standard deviation of the transformed target", TypeConverters.toFloat)
    mode = Param(Params._dummy(), "mode", "raw, log or power", TypeConverters.toString)
    power = Param(Params._dummy(), "power", "exponent of mode power", TypeConverters.toFloat)
    predictionCol = Param(Params._dummy(), "predictionCol", "name of the prediction", TypeConverters.toString)

    def __init__(self, model=None, prediction: str = "pred", **params):
        super().__init__()
        self.model = model
        self._set(predictionCol=prediction, **params)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        raw = self.model.transform(dataset)
        value = F.col(self.model.getPredictionCol()) * get(self.scale) + get(self.center)
        power = get(self.power) if self.isDefined(self.power) else None
        return raw.withColumn("__value", inverse_target(value, get(self.mode), power)).select(
            *[F.col(f"`{c}`") for c in dataset.columns], F.col("__value").alias(get(self.predictionCol)))

    def write(self) -> MLWriter:
        return _TargetWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TargetReader()


class ScaledTarget(Estimator):
    """Fits the target's mean and deviation (F10, P17), then ``regressor`` on the scaled target."""

    def __init__(self, regressor, target: str, mode: str = "raw", power: float | None = None, prediction: str = "pred"):
        super().__init__()
        self.regressor, self.target, self.mode, self.power, self.prediction = regressor, target, mode, power, prediction

    def _fit(self, dataset: DataFrame) -> ScaledTargetModel:
        t = forward_target(self.target, self.mode, self.power)
        center, scale = dataset.agg(F.avg(t), F.stddev_pop(t)).first()
        if center is None:
            raise ValueError(f"no row has a target {self.target!r}")
        scale = scale or 1.0
        rows = dataset.withColumn(self.regressor.getLabelCol(), (t - center) / scale)
        return ScaledTargetModel(self.regressor.fit(rows), self.prediction, center=center, scale=scale, mode=self.mode,
                                 **({} if self.power is None else {"power": float(self.power)}))


# ------------------------------------------------------------------ dense net

class DenseNetModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """M8: forward pass of a dense net over a vector column; the weights are a parameter."""

    weights = Param(Params._dummy(), "weights", "matrices and biases by layer, as JSON", TypeConverters.toString)
    activation = Param(Params._dummy(), "activation", "name of the activation", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "name of the vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "name of the prediction", TypeConverters.toString)

    def __init__(self, weights: Sequence[np.ndarray] | None = None, activation: str = "relu", features: str = "features"):
        super().__init__()
        given = {} if weights is None else {"weights": json.dumps([np.asarray(w).tolist() for w in weights])}
        self._set(activation=activation, featuresCol=features, predictionCol="prediction", **given)

    def getPredictionCol(self) -> str:
        return self.getOrDefault(self.predictionCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ws = [np.array(w, float) for w in json.loads(self.getOrDefault(self.weights))]
        activation = self.getOrDefault(self.activation)

        @F.pandas_udf("double")
        def forward(x: pd.Series) -> pd.Series:
            return pd.Series(dense_forward(np.stack(x.to_numpy()), ws, activation) if len(x) else [])

        return dataset.withColumn(self.getPredictionCol(), forward(vector_to_array(F.col(self.getOrDefault(self.featuresCol)))))


class DenseNet(Estimator):
    """M9: a dense net fitted by gradient sums over the rows (see ``oof.dense_fit`` for the parameters)."""

    def __init__(self, features: str = "features", label: str = "label", **params):
        super().__init__()
        self.features, self.label, self.params_ = features, label, params
        self.history: list[dict] = []

    def getLabelCol(self) -> str:
        return self.label

    def _fit(self, dataset: DataFrame) -> DenseNetModel:
        from .oof import dense_fit
        first = dataset.select(F.size(vector_to_array(self.features)).alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit")
        x = vector_to_array(F.col(self.features))
        names = [f"x{i}" for i in range(first.n)]
        rows = dataset.select(*[x[i].alias(c) for i, c in enumerate(names)], self.label)
        ws, self.history, _ = dense_fit(rows, names, self.label, **self.params_)
        return DenseNetModel(ws, self.params_.get("activation", "relu"), self.features)


# ------------------------------------------------------------------ store

def save_scorers(root: str, single: PipelineModel, members: Mapping[str, PipelineModel] | None = None,
                 metadata: Mapping | None = None) -> None:
    """Pipelines and metadata below ``root``, the metadata last, so a store that has them is whole."""
    spark, root = SparkSession.getActiveSession(), root.rstrip("/")
    single.write().overwrite().save(f"{root}/single")
    for name, model in (members or {}).items():
        model.write().overwrite().save(f"{root}/ensemble/member={name}")
    record = json.dumps({**(metadata or {}), "members": [str(m) for m in members or {}]}, sort_keys=True)
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/metadata")


def load_scorers(spark: SparkSession, root: str, mode: str = "single") -> tuple[list[PipelineModel], dict]:
    """The pipelines of a mode, in the order of the metadata, and the metadata."""
    root = root.rstrip("/")
    if mode not in ("single", "ensemble"):
        raise ValueError(f"mode must be single or ensemble, not {mode!r}")
    metadata = json.loads(spark.read.text(f"{root}/metadata").first().value)
    if mode == "single":
        return [PipelineModel.load(f"{root}/single")], metadata
    if not metadata["members"]:
        raise FileNotFoundError(f"{root} has no ensemble")
    paths = [f"{root}/ensemble/member={m}" for m in metadata["members"]]
    if missing := [p for p in paths if not path_exists(p)]:
        raise FileNotFoundError(f"members that the metadata names are missing: {missing}")
    return [PipelineModel.load(p) for p in paths], metadata


def score_with(models: Sequence[PipelineModel], df: DataFrame, out: str = "Prediction", pred: str = "pred") -> DataFrame:
    """``df`` plus the mean of the models' predictions (A20), floored at 0.

    Models whose first stage is the same fitted preparation share its output.  A mean
    that is not finite raises an error where it is computed (A23), in batches and streams."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    prepared, shared = df, None
    if len(models) > 1 and len({m.stages[0].uid for m in models}) == 1:
        shared = models[0].stages[0]
        prepared = shared.transform(df)
    cur, names = prepared, []
    for i, model in enumerate(models):
        rest = PipelineModel(model.stages[1:]) if shared is not None else model
        cur = rest.transform(cur).withColumnRenamed(pred, f"__m{i}")
        names.append(f"__m{i}")
        # a member's own columns go, but for its prediction
        cur = cur.select(*[F.col(f"`{c}`") for c in prepared.columns], *names)
    mean = sum(F.col(n) for n in names) / float(len(names))
    sound = F.when(not_finite(mean), F.raise_error(F.lit("a prediction is not finite")).cast("double")).otherwise(mean)
    return cur.select(*keep, floor_prediction(sound).alias(out))


def predict_from_store(spark: SparkSession, root: str, df: DataFrame, mode: str = "single", out: str = "Prediction") -> DataFrame:
    """Score the rows of ``df`` (a table or a stream) from the store."""
    return score_with(load_scorers(spark, root, mode)[0], df, out)
