"""Insight panels on a small hand-made table (brute-force expectations)."""

from decimal import Decimal

from credlake.operators import insights, p0

ROWS = [
    # income, score, amount, capacity, stability, fin, prelim, pct, approved
    (400000.0, 385.0, 1000.0, "Saludable", "Alta", "Consolidado", "Prospecto consolidado", 10.0, True),
    (2500000.0, 600.0, 2000.0, "Sobreendeudado", "Inestable", "Critico", "Mal prospecto", 100.0, False),
    (3500000.0, 850.0, 3000.0, "Ajustada", "Media", "Estable", "Prospecto indefinido", 45.0, False),
    (-5.0, 300.0, 4000.0, "Saludable", "Alta", "Consolidado", "Prospecto consolidado", 39.0, False),
    (999999.99, 851.0, 500.0, "Saludable", "Alta", "Consolidado", "Mal prospecto", None, True),
]
SCHEMA = ("ingreso_mensual double, score_crediticio double, monto_solicitado double, capacidad_pago string, "
          "estabilidad_laboral string, score_estabilidad_financiera string, decision_preliminar string, "
          "pct_riesgo double, is_aprobado boolean")


def _flat(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_kpis(spark):
    k = insights.kpis(_flat(spark)).first()
    assert (k.n_solicitudes, k.n_aprobadas, k.n_rechazadas) == (5, 2, 3)
    assert k.tasa_aprobacion == 40.0
    assert k.riesgo_prom_aprobadas == 10.0            # a NULL risk is not averaged
    assert k.riesgo_prom_rechazadas == (100.0 + 45.0 + 39.0) / 3
    assert k.monto_aprobado == Decimal("1500.000000")
    assert k.monto_evitado == Decimal("2000") + Decimal("1350") + Decimal("1560")


def test_bands_are_zero_filled_and_half_open(spark):
    inc = {r.rango: (r.aprobadas, r.rechazadas) for r in insights.segment_distribution(_flat(spark), "ingreso").collect()}
    assert inc == {"< $500K": (1, 0), "$500K–1M": (1, 0), "$1M–2M": (0, 0), "$2M–3M": (0, 1), "> $3M": (0, 1)}
    sc = {r.rango: (r.aprobadas, r.rechazadas) for r in insights.segment_distribution(_flat(spark), "score").collect()}
    # 300 and 851 fall in no band; 850 is in the last one.
    assert sc["380–499"] == (1, 0) and sc["790–850"] == (0, 1) and sum(a + b for a, b in sc.values()) == 3


def test_histogram_loses_100_percent(spark):
    h = {r.lo: r.cantidad for r in insights.risk_histogram(_flat(spark)).collect()}
    assert len(h) == 10 and h[10] == 1 and h[40] == 1 and h[30] == 1 and sum(h.values()) == 3


def test_heatmap_null_rate_for_empty_cells(spark):
    cells = {(r.estabilidad_laboral, r.capacidad_pago): (r.n, r.tasa_rechazo, r.nivel)
             for r in insights.rejection_heatmap(_flat(spark)).collect()}
    assert len(cells) == 9
    assert cells[("Alta", "Saludable")] == (3, (1 / 3) * 100.0, "medio")   # (rejected / n) * 100
    assert cells[("Media", "Ajustada")] == (1, 100.0, "alto")
    assert cells[("Alta", "Ajustada")] == (0, None, None)


def test_preliminary_discrepancies_and_avoided_loss(spark):
    pv = {r.decision: (r.aprobadas, r.rechazadas) for r in insights.preliminary_vs_final(_flat(spark)).collect()}
    assert pv == {"Prospecto consolidado": (1, 1), "Prospecto indefinido": (0, 1), "Mal prospecto": (1, 1)}
    assert insights.discrepancies(_flat(spark)).first().discrepancias == 2
    al = {r.categoria: (r.evitado, r.n) for r in insights.avoided_loss_by_stability(_flat(spark)).collect()}
    assert al["Critico"] == (Decimal("2000.000000"), 1) and al["Vulnerable"] == (Decimal("0E-6"), 0)


def test_flatten_defaults_and_wrapper(spark):
    docs = spark.createDataFrame(
        [({"solicitud": {"ingreso_mensual": 10.0}, "etiquetas": {"prediccion_xgboost": "35%"},
           "resultado_final": "aprobado", "_id": "in"}, None),
         (None, "out")],
        "documento struct<solicitud: struct<ingreso_mensual: double>, etiquetas: struct<prediccion_xgboost: string>, "
        "resultado_final: string, _id: string>, _id string")
    got = {r.id: r for r in p0.flatten_scored(docs).collect()}
    assert got["in"].is_aprobado and got["in"].pct_riesgo == 35.0 and got["in"].ingreso_mensual == 10.0
    assert got["in"].capacidad_pago == "Sin dato" and got["in"].monto_solicitado == 0.0
    assert got["out"].is_aprobado is False and got["out"].pct_riesgo == 0.0
