"""Registered model queries (M1-M4, F13, W2 -> A13).  No SQL oracle: the
driver records a row-count check; tests check invariants instead
(probabilities sum to 1, split shares, AUC above chance)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.functions import labels as L
from credlake.operators import ml, p0, stats
from credlake.operators.sampling import stratified_split
from credlake.plans.registry import query
from credlake.session import ensure_checkpoint_dir
from credlake.sources import views

FEATURES = views.FEATURES
CLASSES = [0, 1, 2]


def _path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where this application keeps the model of a data folder."""
    about = hashlib.sha256(f"{spark.sparkContext.applicationId} {sf_dir}".encode()).hexdigest()[:20]
    return f"{ensure_checkpoint_dir(spark)}/models/{about}/{name}"


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid applications with ``es_fraude`` and a 3-class label
    (0 consolidated, 1 undefined, 2 bad prospect) and an 80/20 split."""
    valid, _ = p0.split_valid(views.applications(spark, sf_dir))
    lab = p0.label_applications(valid)
    cls = (F.when(F.col("decision_preliminar") == L.CONSOLIDATED_PROSPECT, 0)
           .when(F.col("decision_preliminar") == L.UNDEFINED_PROSPECT, 1).otherwise(2))
    t = lab.select("id", *FEATURES, "es_fraude", cls.alias("label"))
    return stratified_split(t, "label", 0.2, 42, key="id")


def _on_cached(table: DataFrame, fit):
    """Fit on the training side, cached while its bins and cells are read."""
    train = table.where(~F.col("is_test")).persist()
    try:
        return fit(train)
    finally:
        train.unpersist()


@query("ml_fraud_risk")
def ml_fraud_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + F8 + F9: boosted-tree fraud probability for held-out applications."""
    t = training_table(spark, sf_dir)
    model = ml.fitted(spark, _path(spark, sf_dir, "risk"), lambda: _on_cached(t, lambda c: ml.fit_risk_model(c, FEATURES, "es_fraude")),
                      ml.save_risk_model, ml.load_risk_model, "about/_SUCCESS")
    scored = ml.score_risk(model, t.where("is_test"), "p_fraude")
    return scored.select("id", F.round("p_fraude", 4).alias("p_fraude"),
                         L.risk_pct_text(F.col("p_fraude")).alias("prediccion_xgboost"),
                         L.approval(L.risk_pct_text(F.col("p_fraude"))).alias("resultado_final"))


def _multiclass(spark: SparkSession, sf_dir: str):
    t = training_table(spark, sf_dir)
    model = ml.fitted(spark, _path(spark, sf_dir, "classes"), lambda: _on_cached(t, lambda c: ml.fit_multiclass(c, FEATURES, "label", CLASSES)),
                      ml.MultiClassModel.save, ml.MultiClassModel.load, "about/_SUCCESS")
    return t, model


@query("ml_client_labels")
def ml_client_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + F13: three-class probabilities and the threshold label per client."""
    t, model = _multiclass(spark, sf_dir)
    pred = ml.label_clients(model.predict(t.where("is_test")))
    return pred.select("id", "label", "prediction", "p_confiable", "p_variable", "p_moroso", "etiqueta",
                       "recomendacion")


@query("ml_feature_importances")
def ml_feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 / T4: feature importances, ascending."""
    _, model = _multiclass(spark, sf_dir)
    return model.importances(spark)


@query("ml_confusion")
def ml_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 on the three-class model's test predictions."""
    t, model = _multiclass(spark, sf_dir)
    pred = model.predict(t.where("is_test"))
    return stats.confusion_matrix(pred, "label", "prediction", CLASSES)
