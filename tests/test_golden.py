"""Golden rows of the reference."""

from pyspark.sql import functions as F

from credlake.functions import labels as L
from credlake.functions.lsh import LshModel, projection_matrix
from credlake.functions.parsing import parse_decimal, parse_pct
from credlake.operators import lsh
from credlake.sources.views import FEATURES

# The published model's scaler statistics.
MEAN = [1498.5132352828512, 649.7205495978675, 3012.268143994029, 35.967896000000074, 1003.8923836202415]
SCALE = [500.32056791695646, 100.39472261507142, 1546.1997627921546, 6.108645565813649, 809.7342031262654]
CLIENT = dict(ingreso_mensual=779.1237243732694, monto_solicitado=14674.103725124027,
              antiguedad_laboral_meses=0, deuda_actual=5040.248954327027)
GOLDEN = [(381.75590408337064, "0111111000011100"), (500.75590408337064, "0111111000011100"),
          (700.7559040833706, "0111111000001100"), (1000.7559040833706, "0110111000001100")]


def test_lsh_signatures(spark):
    model = LshModel(FEATURES, MEAN, SCALE, projection_matrix(16, 5, 42))
    rows = [(CLIENT["ingreso_mensual"], s, CLIENT["monto_solicitado"], CLIENT["antiguedad_laboral_meses"],
             CLIENT["deuda_actual"]) for s, _ in GOLDEN]
    df = spark.createDataFrame(rows, "ingreso_mensual double, score_crediticio double, monto_solicitado double, "
                                     "antiguedad_laboral_meses int, deuda_actual double")
    got = [r.firma_lsh for r in model.transform(df).collect()]
    assert got == [sig for _, sig in GOLDEN]


def test_lsh_decision_tiers(spark):
    rows = [(None, False), (0.0, True), (1.99, True), (2.0, True), (42.69, True), (50.0, True)]
    df = spark.createDataFrame(rows, "pct double, found boolean")
    got = [r.d for r in df.select(lsh.lsh_decision(F.col("pct"), F.col("found")).alias("d")).collect()]
    assert got == ["REVISION", "APROBADA", "APROBADA", "REVISION_EXHAUSTIVA", "REVISION_EXHAUSTIVA", "RECHAZADA"]


def test_lsh_reason_text(spark):
    df = spark.createDataFrame([(42.69, True)], "pct double, found boolean")
    r = df.select(lsh.lsh_reason(F.col("pct"), F.col("found")).alias("r"), lsh.pct_text(F.col("pct")).alias("p")).first()
    assert r.r == "Riesgo moderado de fraude detectado (42.69%)."
    assert r.p == "42.69%"


def test_labels_golden_client(spark):
    df = spark.createDataFrame([(CLIENT["ingreso_mensual"], 500.75590408337064, CLIENT["monto_solicitado"], 0,
                                 CLIENT["deuda_actual"])], ", ".join(
        f"{c} {'int' if c == 'antiguedad_laboral_meses' else 'double'}" for c in FEATURES))
    r = df.withColumns(L.label_columns()).first()
    assert r.ratio_endeudamiento_actual == 6.47
    assert (r.capacidad_pago, r.estabilidad_laboral, r.score_estabilidad_financiera, r.decision_preliminar) == (
        "Sobreendeudado", "Inestable", "Critico", "Mal prospecto")


def test_label_edges(spark):
    df = spark.createDataFrame([(0.30, 6), (0.45, 12), (0.46, 5)], "ratio double, months int")
    got = df.select(L.payment_capacity(F.col("ratio")).alias("c"), L.job_stability(F.col("months")).alias("s")).collect()
    assert [(r.c, r.s) for r in got] == [("Saludable", "Media"), ("Ajustada", "Alta"), ("Sobreendeudado", "Inestable")]


def test_approval_texts(spark):
    df = spark.createDataFrame([("100%",), ("39%",), ("40%",), (" 35 %",), ("Alto_Potencial (Prob: 1.0)",), (None,)],
                               "t string")
    got = [r.a for r in df.select(L.approval(F.col("t")).alias("a")).collect()]
    assert got[:4] == ["RECHAZADO", "APROBADO", "RECHAZADO", "APROBADO"]
    assert got[4].startswith("ERROR_EVALUACION: ") and got[5].startswith("ERROR_EVALUACION: ")


def test_risk_pct_half_even(spark):
    df = spark.createDataFrame([(0.355,), (0.025,), (0.015,), (1.0,)], "p double")
    got = [r.t for r in df.select(L.risk_pct_text(F.col("p")).alias("t")).collect()]
    assert got[3] == "100%" and got[1] == "2%"


def test_text_parsers(spark):
    df = spark.createDataFrame([("35%",), (" 40 %",), ("abc",), (None,), ("1,5",), ("1,5,2",), ("",), ("-3",)], "t string")
    r = df.select(parse_pct(F.col("t")).alias("p"), parse_decimal(F.col("t")).alias("d")).collect()
    assert [x.p for x in r] == [35.0, 40.0, None, 0.0, 1.0, 1.0, None, -3.0]
    assert [x.d for x in r] == [None, None, None, None, 1.5, None, 0.0, -3.0]


def test_null_flag_counts_differ_between_a1_and_a2(spark):
    df = spark.createDataFrame([("b", 1), ("b", 0), ("b", None)], "firma_lsh string, es_fraude int")
    a1 = lsh.bucket_stats(df).first()
    a2 = lsh.bucket_history(df).first()
    assert (a1.total_solicitudes, a1.fraudes_detectados) == (2, 1)    # count(flag): non-null only
    assert (a2.total_balde, a2.fraudes_balde) == (3, 1)               # rows
    assert a2.pct_fraude == (1 / 3) * 100                            # (frauds / total) * 100


def test_pct_text_rounds_like_python(spark):
    import random
    rnd = random.Random(1)
    vals = [42.693661971830984, 0.125, 2.675, 12.345, 99.995, 0.0, 0.005, 1.005, 0.015, 100.0, 33.333333333333336]
    vals += [rnd.randint(0, 10000) / 100 + 0.005 for _ in range(3000)] + [rnd.uniform(0, 100) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r.t for r in df.select(lsh.pct_text(F.col("p")).alias("t")).collect()]
    assert got[0] == "42.69%"
    assert got == [f"{v:.2f}%" for v in vals]
