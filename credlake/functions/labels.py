"""Rule labels of the P0 scoring path and the model labelling.

All labels are ``CASE WHEN`` column expressions: no Python runs per row.
Thresholds compare the *unrounded* ratio; only the reported ratio is rounded
to 2 decimals exactly as Python's ``round`` does (``rounding.python_round``).
``bround`` would round the shortest decimal text instead (0.575 -> 0.58 where
Python gives 0.57).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from credlake.functions.rounding import python_round

# Label texts and thresholds of the reference rules.
OVERINDEBTED, TIGHT, HEALTHY = "Sobreendeudado", "Ajustada", "Saludable"
HIGH, MEDIUM, UNSTABLE = "Alta", "Media", "Inestable"
CONSOLIDATED, STABLE, CRITICAL, VULNERABLE = "Consolidado", "Estable", "Critico", "Vulnerable"
BAD_PROSPECT, CONSOLIDATED_PROSPECT, UNDEFINED_PROSPECT = "Mal prospecto", "Prospecto consolidado", "Prospecto indefinido"
RATIO_OVER, RATIO_TIGHT = 0.45, 0.30
MONTHS_HIGH, MONTHS_MEDIUM = 12, 6
APPROVED, REJECTED, ERROR_PREFIX = "APROBADO", "RECHAZADO", "ERROR_EVALUACION: "
REJECT_FROM_PCT = 40
LABEL_NAMES = {0: "Confiable", 1: "Comportamiento crediticio variable", 2: "Moroso"}
RECOMMENDATIONS = {
    "Confiable": "Aprobar solicitud. Cliente de bajo riesgo.",
    "Moroso": "Rechazar solicitud. Alto riesgo de no pago.",
    "Comportamiento crediticio variable": "Revisar manualmente. Considerar garantías adicionales.",
}
P_CONFIDENT = 0.70
P_DEFAULTER = 0.70
DECISION_LABELS = {"APROBADO": "Aprobada", "RECHAZADO": "Rechazada", "ERROR_EVALUACION": "Error de evaluación"}
DECISION_LABEL_DEFAULT = "Pendiente"
MODEL_LABEL_BY_CODE = {"APROBADO": "Confiable", "RECHAZADO": "Moroso"}
MODEL_LABEL_DEFAULT = "Comportamiento crediticio variable"


def debt_ratio(debt: Column, income: Column) -> Column:
    """debt / income, 0 when income <= 0 (unrounded)."""
    return F.when(income > 0, debt / income).otherwise(F.lit(0.0))


def payment_capacity(ratio: Column) -> Column:
    """F4."""
    return F.when(ratio > RATIO_OVER, OVERINDEBTED).when(ratio > RATIO_TIGHT, TIGHT).otherwise(HEALTHY)


def job_stability(months: Column) -> Column:
    """F5."""
    return F.when(months >= MONTHS_HIGH, HIGH).when(months >= MONTHS_MEDIUM, MEDIUM).otherwise(UNSTABLE)


def financial_stability(stability: Column, capacity: Column) -> Column:
    """F6, first match wins."""
    return (
        F.when((stability == HIGH) & (capacity == HEALTHY), CONSOLIDATED)
        .when(stability.isin(HIGH, MEDIUM) & (capacity != OVERINDEBTED), STABLE)
        .when(capacity == OVERINDEBTED, CRITICAL)
        .otherwise(VULNERABLE)
    )


def preliminary_decision(fin: Column) -> Column:
    """F7."""
    return (F.when(fin == CRITICAL, BAD_PROSPECT)
            .when(fin == CONSOLIDATED, CONSOLIDATED_PROSPECT)
            .otherwise(UNDEFINED_PROSPECT))


def label_columns(income: str = "ingreso_mensual", debt: str = "deuda_actual",
                  months: str = "antiguedad_laboral_meses") -> dict[str, Column]:
    """F3-F7 as a dict for one ``withColumns`` (no deep ``withColumn`` chain)."""
    ratio = debt_ratio(F.col(debt), F.col(income))
    cap = payment_capacity(ratio)
    stab = job_stability(F.col(months))
    fin = financial_stability(stab, cap)
    return {
        "ratio_endeudamiento_actual": python_round(ratio, 2),
        "capacidad_pago": cap,
        "estabilidad_laboral": stab,
        "score_estabilidad_financiera": fin,
        "decision_preliminar": preliminary_decision(fin),
    }


def round_half_even(x: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def risk_pct(p: Column) -> Column:
    """F8 numeric part: probability -> whole percent, halves to even."""
    return F.rint(p * 100.0).cast("int")


def risk_pct_text(p: Column) -> Column:
    """F8: ``"<n>%"``."""
    return F.concat(risk_pct(p).cast("string"), F.lit("%"))


# What Python's strip() takes off.
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"


def approval(pct_text: Column) -> Column:
    """strip ``%``, trim, parse an integer; >= 40 rejected, else approved.

    Text that is not an integer gives ``ERROR_EVALUACION: <message>`` with
    the message the reference's parser prints.
    """
    stripped = F.regexp_replace(F.regexp_replace(pct_text, "%", ""), f"^{BLANKS}|{BLANKS}$", "")
    is_int = stripped.rlike(r"^[+-]?[0-9]+$")
    n = F.when(is_int, (stripped).try_cast("bigint"))
    err = F.when(pct_text.isNull(), F.lit("'NoneType' object has no attribute 'replace'")).otherwise(
        F.concat(F.lit("invalid literal for int() with base 10: '"), stripped, F.lit("'")))
    return (F.when(n >= REJECT_FROM_PCT, F.lit(REJECTED))
            .when(n.isNotNull(), F.lit(APPROVED))
            .otherwise(F.concat(F.lit(ERROR_PREFIX), err)))


def label_name(label: Column) -> Column:
    """0/1/2 -> label names."""
    expr = F.when(label == 0, LABEL_NAMES[0])
    for k in (1, 2):
        expr = expr.when(label == k, LABEL_NAMES[k])
    return expr


def client_label(p0: Column, p2: Column) -> Column:
    """P(reliable) >= 0.70 first, then P(defaulter) >= 0.70, else variable."""
    return (F.when(p0 >= P_CONFIDENT, LABEL_NAMES[0])
            .when(p2 >= P_DEFAULTER, LABEL_NAMES[2])
            .otherwise(LABEL_NAMES[1]))


def recommendation(label: Column) -> Column:
    expr = None
    for k, v in RECOMMENDATIONS.items():
        expr = F.when(label == k, v) if expr is None else expr.when(label == k, v)
    return expr


def decision_label(code: Column) -> Column:
    """decision code -> display label (exact match, else Pendiente)."""
    expr = None
    for k, v in DECISION_LABELS.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr.otherwise(DECISION_LABEL_DEFAULT)


def model_label(code: Column) -> Column:
    """model label shown for a decision code."""
    expr = None
    for k, v in MODEL_LABEL_BY_CODE.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr.otherwise(MODEL_LABEL_DEFAULT)
