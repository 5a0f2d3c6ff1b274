"""Randomised equivalence with plain-Python models of the documented semantics.

Each test evaluates a few thousand generated inputs in one DataFrame and
compares every row with a small Python model written from SURVEY §2.
"""

import math
import random
import re

from pyspark.sql import functions as F

from credlake.functions import labels as L
from credlake.functions.parsing import parse_decimal, parse_pct

ALPHABET = "0123456789 %+-.,ae"
N = 3000


def _strings(seed: int, max_len: int = 8) -> list[str | None]:
    rnd = random.Random(seed)
    out: list[str | None] = [None, "", " ", "%", "40%", " 39 %", "1,5", "1,5,2", "-3", ".5", "5.", "1e3"]
    while len(out) < N:
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, max_len))))
    return out


def _py_int(text: str) -> int | None:
    """int(text) for the generated alphabet: optional sign, digits, no blanks inside."""
    return int(text) if re.fullmatch(r"[+-]?[0-9]+", text) else None


def model_approval(text: str | None) -> str:
    if text is None:
        return "ERROR"
    n = _py_int(text.replace("%", "").strip(" "))
    if n is None:
        return "ERROR"
    return "RECHAZADO" if n >= 40 else "APROBADO"


_JS_NUM = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")


def model_number(text: str) -> float | None:
    """Browser Number(text) restricted to the alphabet; NaN -> None."""
    t = text.strip(" ")
    if t == "":
        return 0.0
    return float(t) if _JS_NUM.fullmatch(t) else None


def model_parse_decimal(text: str | None) -> float | None:
    return None if text is None else model_number(text.replace(",", ".", 1))


def model_parse_pct(text: str | None) -> float | None:
    """parseFloat(text.replace('%', '')) (first '%'); NULL input -> 0."""
    if text is None:
        return 0.0
    m = re.match(r"\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)", text.replace("%", "", 1))
    return float(m.group(1)) if m else None


def _same(a, b) -> bool:
    if a is None or b is None:
        return a is b
    return a == b or (math.isinf(a) and math.isinf(b))


def test_text_functions_match_models(spark):
    texts = _strings(7)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", L.approval(F.col("t")).alias("a"), parse_decimal(F.col("t")).alias("d"),
                     parse_pct(F.col("t")).alias("p")).collect()
    bad = []
    for r in rows:
        t = texts[r.i]
        a = "ERROR" if r.a.startswith("ERROR_EVALUACION: ") else r.a
        if a != model_approval(t) or not _same(r.d, model_parse_decimal(t)) or not _same(r.p, model_parse_pct(t)):
            bad.append((t, r.a, r.d, r.p, model_approval(t), model_parse_decimal(t), model_parse_pct(t)))
    assert not bad, bad[:10]


def model_labels(income: float, debt: float, months: int) -> tuple:
    ratio = debt / income if income > 0 else 0.0
    cap = "Sobreendeudado" if ratio > 0.45 else ("Ajustada" if ratio > 0.30 else "Saludable")
    stab = "Alta" if months >= 12 else ("Media" if months >= 6 else "Inestable")
    if stab == "Alta" and cap == "Saludable":
        fin = "Consolidado"
    elif stab in ("Alta", "Media") and cap != "Sobreendeudado":
        fin = "Estable"
    elif cap == "Sobreendeudado":
        fin = "Critico"
    else:
        fin = "Vulnerable"
    pre = {"Critico": "Mal prospecto", "Consolidado": "Prospecto consolidado"}.get(fin, "Prospecto indefinido")
    return cap, stab, fin, pre


def test_label_chain_matches_model(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(N):
        income = rnd.choice([0.0, -5.0, 1000.0, rnd.uniform(-100, 5000)])
        debt = rnd.choice([0.0, 300.0, 450.0, 450.0000001, rnd.uniform(0, 3000)])
        months = rnd.choice([0, 5, 6, 11, 12, rnd.randint(0, 150)])
        rows.append((i, income, debt, months))
    df = spark.createDataFrame(rows, "i int, ingreso_mensual double, deuda_actual double, antiguedad_laboral_meses int")
    got = df.withColumns(L.label_columns()).collect()
    bad = [(r.i, r.capacidad_pago, r.estabilidad_laboral, r.score_estabilidad_financiera, r.decision_preliminar)
           for r in got
           if (r.capacidad_pago, r.estabilidad_laboral, r.score_estabilidad_financiera, r.decision_preliminar)
           != model_labels(rows[r.i][1], rows[r.i][2], rows[r.i][3])]
    assert not bad, bad[:10]


def test_risk_pct_is_round_half_even(spark):
    rnd = random.Random(3)
    ps = [rnd.random() for _ in range(N)] + [0.005, 0.015, 0.025, 0.355, 0.365, 0.995, 1.0, 0.0]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "i int, p double")
    got = {r.i: r.t for r in df.select("i", L.risk_pct_text(F.col("p")).alias("t")).collect()}
    bad = [(p, got[i]) for i, p in enumerate(ps) if got[i] != f"{round(p * 100)}%"]
    assert not bad, bad[:10]


def test_python_round_matches_python(spark):
    from credlake.functions.rounding import python_fixed, python_round
    rnd = random.Random(21)
    vals = [rnd.randint(0, 10**6) / 1000 + 0.005 for _ in range(N)] + [rnd.uniform(-50, 50) for _ in range(N)]
    vals += [0.575, 2.675, 1.005, 0.125, -0.125, -2.675, 0.0, -0.0, -0.001, -0.005, -0.0051]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r.i: (r.r, r.t) for r in df.select("i", python_round(F.col("x"), 2).alias("r"),
                                              python_fixed(F.col("x"), 2).alias("t")).collect()}
    bad = [(v, got[i]) for i, v in enumerate(vals)
           if got[i][0] != round(v, 2) or got[i][1] != f"{v:.2f}"]
    assert not bad, bad[:5]
