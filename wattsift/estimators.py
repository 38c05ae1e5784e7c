"""Preparation and isolation forest as stages of a ``pyspark.ml`` pipeline, with writers and readers.

    model = Pipeline(stages=[Preparation(), ForestDetector(trees=200)]).fit(clean)
    model.write().save(path)
    PipelineModel.load(path).transform(rows)

Fitted state is what the functions of ``prep`` and ``forest`` return, so values are those of ``predict``.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsift.operators.forest import Forest, fit_forest, load_forest, save_forest, score_forest, with_decision
from wattsift.operators.prep import Preprocessor, feature_vectors, fit_preprocessor, load_preprocessor, save_preprocessor
from wattsift.profile import ENERGY, Profile
from wattsift.session import materialise

_ROW = "__row"


def profile_text(profile: Profile) -> str:
    return json.dumps(asdict(profile), sort_keys=True)


def profile_from_text(text: str) -> Profile:
    return Profile(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})


class _StateWriter(MLWriter):
    """Parameters as metadata, and the tables the stage keeps beside them."""

    def __init__(self, stage: _Fitted):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage._save_state(f"{path}/state")


class _StateReader(MLReader):
    def __init__(self, kind: type[_Fitted]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _Fitted:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind(self.kind._load_state(self.sparkSession, f"{path}/state"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _Fitted(Model, MLWritable, MLReadable):
    """A stage whose state is a few tables."""

    def __init__(self, state=None):
        super().__init__()
        self.state = state

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


class _PreparationParams(Params):
    profile = Param(Params._dummy(), "profile", "roles of the columns, as JSON", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(profile=profile_text(ENERGY))

    def get_profile(self) -> Profile:
        return profile_from_text(self.getOrDefault(self.profile))


class PreparationModel(_Fitted, _PreparationParams):
    """Adds ``features``, the prepared row as array<double>; all columns of the table stay as they are."""

    state: Preprocessor

    def _transform(self, dataset: DataFrame) -> DataFrame:
        profile = self.get_profile()
        whole = F.struct(*[F.col(f"`{c}`") for c in dataset.columns]).alias(_ROW)
        return feature_vectors(dataset.select(whole, *profile.features), self.state, (_ROW,), profile).select(f"{_ROW}.*", "features")

    def _save_state(self, path: str) -> None:
        save_preprocessor(self.state, path)

    @staticmethod
    def _load_state(spark: SparkSession, path: str) -> Preprocessor:
        return load_preprocessor(spark, path)


class Preparation(Estimator, _PreparationParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute, encode and scale the feature columns of a profile."""

    @keyword_only
    def __init__(self, *, profile=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PreparationModel:
        return self._copyValues(PreparationModel(fit_preprocessor(dataset, self.get_profile())))


class _ForestParams(Params):
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    maxSamples = Param(Params._dummy(), "maxSamples", "rows per tree", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "share of rows to flag", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of all draws", TypeConverters.toInt)
    rowIdCol = Param(Params._dummy(), "rowIdCol", "column with the rows' ids, read by the fit only", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(trees=200, maxSamples=256, contamination=0.05, seed=42, rowIdCol=ENERGY.row_id)


class ForestModel(_Fitted, _ForestParams):
    """Adds ``anomaly_score`` (lower is more anomalous) and ``is_anomaly`` in the place of ``features``; row-local, so it
    serves streams as well.  The table must not have columns of these names."""

    state: Forest

    def _transform(self, dataset: DataFrame) -> DataFrame:
        taken = {"anomaly_score", "is_anomaly", "score_samples", "decision"} & set(dataset.columns)
        if taken:
            raise ValueError(f"The table has columns that the forest writes: {sorted(taken)}")
        scored = with_decision(score_forest(dataset, self.state), self.state)
        return scored.withColumnRenamed("score_samples", "anomaly_score").drop("decision")

    def _save_state(self, path: str) -> None:
        save_forest(self.state, path)

    @staticmethod
    def _load_state(spark: SparkSession, path: str) -> Forest:
        return load_forest(spark, path)


class ForestDetector(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Isolation forest over ``features``."""

    @keyword_only
    def __init__(self, *, trees=None, maxSamples=None, contamination=None, seed=None, rowIdCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ForestModel:
        get, row_id = self.getOrDefault, self.getOrDefault(self.rowIdCol)
        rows = materialise(dataset.select(row_id, "features"), "vectors")  # read several times by the fit
        forest = fit_forest(rows, get(self.trees), get(self.maxSamples), get(self.contamination), get(self.seed), row_id)
        return self._copyValues(ForestModel(forest))
