"""Model invariants (rows-only queries in the driver's check)."""

from pyspark.sql import functions as F

from credlake.plans import ml_queries
from tests.conftest import SF_CHECK


def test_three_class_probabilities_sum_to_one(spark):
    from credlake.operators import ml
    t = ml_queries.training_table(spark, SF_CHECK).cache()
    model = ml.fit_multiclass(t.where(~F.col("is_test")), ml_queries.FEATURES, "label", ml_queries.CLASSES, 8)
    pred = model.predict(t.where("is_test"))
    bad = pred.where(F.abs(F.col("p_0") + F.col("p_1") + F.col("p_2") - 1.0) > 1e-9).count()
    assert bad == 0
    acc = pred.where(F.col("prediction") == F.col("label")).count() / pred.count()
    assert acc > 0.6


def test_fraud_model_beats_chance(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from credlake.operators import ml
    t = ml_queries.training_table(spark, SF_CHECK).cache()
    model = ml.fit_risk_model(t.where(~F.col("is_test")), ml_queries.FEATURES, "es_fraude", 10)
    scored = ml.score_risk(model, t.where("is_test"), "p").withColumn("y", F.col("es_fraude").cast("double"))
    auc = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y").evaluate(scored)
    assert auc > 0.5


def test_stored_model_scores_batches_and_streams(spark, tmp_path):
    from credlake.operators import ml, p0
    from credlake.plans import jobs
    from credlake.sources import views
    from credlake.streaming import scoring
    from tests.conftest import SF_SMALL
    t = ml_queries.training_table(spark, SF_SMALL).cache()
    path = str(tmp_path / "model")
    ml.save_risk_model(ml.fit_risk_model(t, ml_queries.FEATURES, "es_fraude", 3), path)
    apps = views.applications(spark, SF_SMALL)
    want, _ = p0.bulk_score(ml.score_risk(ml.load_risk_model(path), apps, "p_riesgo"))
    n = jobs.score_to_documents(spark, apps, str(tmp_path / "scored"), model_path=path)
    assert n == want.count()
    scored, invalid = scoring.stream_p0_scores(spark, scoring.application_stream(spark, SF_SMALL), str(tmp_path / "out"), model_path=path)
    columns = ["id", "pct_riesgo", "prediccion_xgboost", "resultado_final"]
    assert scored.select(columns).exceptAll(want.select(columns)).count() == 0 and scored.count() == n
    assert invalid.count() == apps.count() - n


def test_models_are_fitted_once(spark, tmp_path):
    from credlake.operators import ml
    fits = []

    def fit():
        fits.append(1)
        t = ml_queries.training_table(spark, SF_CHECK).limit(300).cache()
        return ml.fit_multiclass(t, ml_queries.FEATURES, "label", [0, 1], 2)
    path = str(tmp_path / "m")
    one, two = (ml.fitted(spark, path, fit, ml.MultiClassModel.save, ml.MultiClassModel.load, "about/_SUCCESS") for _ in range(2))
    assert len(fits) == 1 and one.features == two.features == ml_queries.FEATURES
    df = ml_queries.training_table(spark, SF_CHECK).limit(20)
    assert one.predict(df).select("id", "p_0").collect() == two.predict(df).select("id", "p_0").collect()
