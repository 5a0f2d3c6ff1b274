"""The expected values FIXTURES.md lists for sf 0.01, computed by the Spark side."""

import pytest
from pyspark.sql import functions as F

from credlake.operators import flows, generic, p0
from credlake.plans import QUERIES
from credlake.plans.flow_queries import nested_requests
from credlake.sources import views
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def apps(spark):
    return views.applications(spark, SF_CHECK).cache()


def test_applications_counts(spark, apps):
    assert apps.count() == 15000
    assert apps.where("es_fraude = 1").count() == 1177
    valid, _ = p0.split_valid(apps)
    assert valid.count() == 11595
    st = {r[0]: r[1] for r in p0.label_applications(valid).groupBy("score_estabilidad_financiera").count().collect()}
    assert (st["Consolidado"], st["Estable"], st["Vulnerable"], st["Critico"]) == (3225, 1790, 204, 6376)


def test_risk_counts(spark):
    valid, _ = p0.split_valid(views.risk_input(spark, SF_CHECK))
    assert valid.where(F.col("p_riesgo") >= 0.395).count() == 8344
    assert valid.where(F.col("p_riesgo") == 1.0).count() == 207


def test_signatures_and_top_bucket(spark):
    assert QUERIES["lsh_bucket_stats"](spark, SF_CHECK).count() == 1299
    top = QUERIES["lsh_top_risk_buckets"](spark, SF_CHECK).first()
    assert (top.firma_lsh, top.total_solicitudes, top.fraudes_detectados) == ("1000010000110000", 4, 4)


def test_p0_flow_outcomes(spark):
    s = flows.decision_summary(flows.apply_flow(nested_requests(spark, SF_CHECK), flows.load_flows()["p0"]))
    codes = {r[0]: r[1] for r in s.groupBy("blocking_rule_codes").count().collect()}
    approved = codes.pop("")
    bureau_only = sum(n for c, n in codes.items() if c and set(c.split(",")) == {"RL_DICOM_HARD"})
    bureau_rent = sum(n for c, n in codes.items() if "RL_DICOM_HARD" in c and "RL_RENTA_INSUFICIENTE" in c)
    assert (approved, bureau_only, bureau_rent, codes["RL_RENTA_INSUFICIENTE"], codes["RL_NO_TITULAR"],
            codes["RL_SIN_INGRESOS"]) == (4362, 1116, 593, 2191, 3624, 3114)


def test_requests_with_several_titulars(spark):
    a = views.applicants(spark, SF_CHECK)
    n = a.where("role = 'TITULAR'").groupBy("request_id").count().where("count > 1").count()
    assert n == 5592


def test_permissions_and_confusion(spark):
    allowed = generic.check_permissions(views.access_requests(spark, SF_CHECK), views.user_roles(spark, SF_CHECK),
                                        views.role_permissions(spark, SF_CHECK)).where("allowed").count()
    assert allowed == 2732
    cm = {(r.y, r.yhat): r.n for r in QUERIES["confusion_matrix"](spark, SF_CHECK).collect()}
    assert (cm[(0, 0)], cm[(0, 1)], cm[(1, 0)], cm[(1, 1)]) == (3, 55, 27, 314)
