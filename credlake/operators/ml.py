"""Risk models of boosted trees.

* M3 binary risk model: boosted trees on the five application features.
* M2 three-class model: one binary model per class (one-vs-rest), grown side
  by side, and the three P(class) are normalised to sum to 1.
* Hyper-parameters follow the reference notebook: depth 4, step 0.1, row
  and column sample 0.8, seed 42, 200 rounds.
* Models are fitted once, saved, and loaded by whatever scores with them
  (``fitted``, ``jobs.score_to_documents``, ``streaming.scoring``).

Training is distributed (``operators.boosting``: sums by node, feature and bin
per partition); scoring is a narrow projection.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.functions import labels as L
from credlake.operators import boosting

# The notebook's boosting parameters.
DEPTH, STEP, SUBSAMPLE, COLSAMPLE, SEED, ROUNDS = 4, 0.1, 0.8, 0.8, 42, 200


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """M1: dense feature vector (only as model input)."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


def _params(rounds: int) -> boosting.Params:
    return boosting.Params(rounds, DEPTH, STEP, SUBSAMPLE, COLSAMPLE, SEED)


def _write(path: str, about: dict) -> None:
    SparkSession.active().createDataFrame([(json.dumps(about),)], "v string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/about")


def _read(path: str) -> dict:
    return json.loads(SparkSession.active().read.text(f"{path}/about").first()[0])


@dataclass
class RiskModel:
    trees: boosting.Trees
    features: list[str]


def fit_risk_model(df: DataFrame, features: list[str], label: str, rounds: int = ROUNDS) -> RiskModel:
    """Binary boosted trees on ``features`` -> ``label`` (0/1)."""
    rest = F.col(label).cast("double") != 1  # NULL stays NULL and is refused
    return RiskModel(boosting.fit(df, features, rest.cast("int"), 1, _params(rounds)), list(features))


def score_risk(model: RiskModel, df: DataFrame, out: str = "p_riesgo") -> DataFrame:
    """M3: P(class 1) as a double column."""
    return df.withColumn(out, model.trees.probabilities(model.features)[0])


@dataclass
class MultiClassModel:
    classes: list[int]
    trees: boosting.Trees
    features: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        """M4: per-class probability ``p_<k>`` (normalised), ``prediction``."""
        out = df.withColumn("_raw", self.trees.probabilities(self.features))
        raw = {k: F.col("_raw")[i] for i, k in enumerate(self.classes)}
        total = sum(raw.values(), F.lit(0.0))
        out = out.withColumns({f"p_{k}": raw[k] / total for k in self.classes})
        best = F.greatest(*[F.col(f"p_{k}") for k in self.classes])
        pred = None
        for k in reversed(self.classes):  # first class wins ties
            pred = F.when(F.col(f"p_{k}") == best, F.lit(k)) if pred is None else \
                F.when(F.col(f"p_{k}") == best, F.lit(k)).otherwise(pred)
        return out.withColumn("prediction", pred).drop("_raw")

    def importances(self, spark: SparkSession) -> DataFrame:
        """M4 / T4: mean feature importance over the class models, ascending."""
        mean = self.trees.importances().mean(axis=0)
        rows = [(f, float(a)) for f, a in zip(self.features, mean)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy("importance", "feature")

    def save(self, path: str) -> None:
        _write(path, {"classes": self.classes, "features": self.features, "trees": self.trees.to_dict()})

    @classmethod
    def load(cls, path: str) -> MultiClassModel:
        about = _read(path)
        return cls(about["classes"], boosting.Trees.from_dict(about["trees"]), about["features"])


def save_risk_model(model: RiskModel, path: str) -> None:
    _write(path, {"features": model.features, "trees": model.trees.to_dict()})


def load_risk_model(path: str) -> RiskModel:
    """The stored risk model that L2 and X2 score with."""
    about = _read(path)
    return RiskModel(boosting.Trees.from_dict(about["trees"]), about["features"])


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def fitted(spark: SparkSession, path: str, fit: Callable, save: Callable, load: Callable, done: str):
    """The model stored at ``path``; fitted and saved first where ``done``, written last, is not there."""
    if not exists(spark, f"{path}/{done}"):
        save(fit(), path)
    return load(path)


def fit_multiclass(df: DataFrame, features: list[str], label: str, classes: list[int],
                   rounds: int = ROUNDS) -> MultiClassModel:
    """M2: one-vs-rest boosted trees, one binary model per class, all grown in the same passes."""
    index = F.when(F.col(label).isNotNull(), F.lit(len(classes)))
    for i, k in reversed(list(enumerate(classes))):
        index = F.when(F.col(label) == k, F.lit(i)).otherwise(index)
    return MultiClassModel(list(classes), boosting.fit(df, features, index, len(classes), _params(rounds)), list(features))


def label_clients(pred: DataFrame) -> DataFrame:
    """F13 on the three normalised probabilities (classes 0, 1, 2)."""
    lab = L.client_label(F.col("p_0"), F.col("p_2"))
    return pred.withColumns({
        "etiqueta": lab,
        "p_confiable": L.round_half_even(F.col("p_0"), 4),
        "p_variable": L.round_half_even(F.col("p_1"), 4),
        "p_moroso": L.round_half_even(F.col("p_2"), 4),
        "recomendacion": L.recommendation(lab),
    })
