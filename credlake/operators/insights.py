"""Portfolio insights over flat scored rows.

Every panel is one global aggregate of conditional counts/sums, turned into
rows with ``inline``: one scan, partial aggregation in every task, a single
tiny shuffle, and every band/category present (zero-filled) in a fixed order
without a spine join.  Money sums are exact (DECIMAL) so they do not depend
on the order in which tasks finish.

Input columns (see ``credlake.operators.p0.flatten_scored``): ``ingreso_mensual``,
``score_crediticio``, ``monto_solicitado``, ``capacidad_pago``,
``estabilidad_laboral``, ``score_estabilidad_financiera``,
``decision_preliminar``, ``pct_riesgo`` (double) and ``is_aprobado``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.functions.scoring import avoided_loss

# Band edges, bin widths and category orders of the dashboard.
INCOME_BANDS = [
    ("< $500K", 0.0, 500000.0),
    ("$500K–1M", 500000.0, 1000000.0),
    ("$1M–2M", 1000000.0, 2000000.0),
    ("$2M–3M", 2000000.0, 3000000.0),
    ("> $3M", 3000000.0, float("inf")),
]
SCORE_BANDS = [
    ("380–499", 380.0, 500.0),
    ("500–579", 500.0, 580.0),
    ("580–649", 580.0, 650.0),
    ("650–719", 650.0, 720.0),
    ("720–789", 720.0, 790.0),
    ("790–850", 790.0, 851.0),
]
RISK_BIN_WIDTH = 10
RISK_BINS = 10
CAPACITY_ORDER = ["Saludable", "Ajustada", "Sobreendeudado"]
JOB_ORDER = ["Alta", "Media", "Inestable"]
FIN_ORDER = ["Consolidado", "Estable", "Vulnerable", "Critico"]
PRELIM_ORDER = ["Prospecto consolidado", "Prospecto indefinido", "Mal prospecto"]
HEAT_HIGH, HEAT_MID = 66.0, 33.0

MONEY = "decimal(38,6)"


def exact_sum(c: Column) -> Column:
    """Order-independent sum of a double column: DECIMAL(38,6) accumulation
    and result, so no engine-specific double rounding enters the total.
    Values are rounded to 6 decimals; a NaN makes the sum NULL (a DECIMAL
    has none), it is never left out."""
    value = c.cast("double")
    total = F.coalesce(F.sum(F.when(~F.isnan(value), c).cast(MONEY)), F.lit(0).cast(MONEY))
    return F.when(~F.coalesce(F.bool_or(F.isnan(value)), F.lit(False)), total)


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _rows(df: DataFrame, structs: list[Column]) -> DataFrame:
    return df.agg(F.array(*structs).alias("_r")).select(F.inline("_r"))


def in_band(v: Column, lo: float, hi: float) -> Column:
    """Half-open band ``lo <= v < hi``."""
    cond = v >= F.lit(lo)
    if hi != float("inf"):
        cond = cond & (v < F.lit(hi))
    return cond


def kpis(flat: DataFrame) -> DataFrame:
    """A3: counts, approval rate, mean risk per side, amounts, avoided loss."""
    ok = F.col("is_aprobado")
    amt, risk = F.col("monto_solicitado"), F.col("pct_riesgo")
    n = F.count(F.lit(1))
    n_ok = _count_if(ok)
    n_ko = _count_if(~ok)
    return flat.agg(
        n.alias("n_solicitudes"),
        n_ok.alias("n_aprobadas"),
        n_ko.alias("n_rechazadas"),
        F.when(n > 0, n_ok / n * 100.0).otherwise(F.lit(0.0)).alias("tasa_aprobacion"),
        F.coalesce(F.avg(F.when(ok, risk)), F.lit(0.0)).alias("riesgo_prom_aprobadas"),
        F.coalesce(F.avg(F.when(~ok, risk)), F.lit(0.0)).alias("riesgo_prom_rechazadas"),
        exact_sum(F.when(ok, amt)).alias("monto_aprobado"),
        exact_sum(F.when(~ok, amt)).alias("monto_rechazado"),
        exact_sum(F.when(~ok, avoided_loss(amt, risk))).alias("monto_evitado"),
    )


def segment_distribution(flat: DataFrame, by: str = "ingreso") -> DataFrame:
    """A4: approved / rejected per income band or per score band."""
    bands, col = (INCOME_BANDS, "ingreso_mensual") if by == "ingreso" else (SCORE_BANDS, "score_crediticio")
    v, ok = F.col(col), F.col("is_aprobado")
    structs = [
        F.struct(F.lit(i).alias("orden"), F.lit(label).alias("rango"),
                 _count_if(in_band(v, lo, hi) & ok).alias("aprobadas"),
                 _count_if(in_band(v, lo, hi) & ~ok).alias("rechazadas"))
        for i, (label, lo, hi) in enumerate(bands)
    ]
    return _rows(flat, structs)


def risk_histogram(flat: DataFrame) -> DataFrame:
    """A5: 10 bins ``[lo, lo+10)``; a risk of exactly 100 falls in no bin."""
    r = F.col("pct_riesgo")
    structs = []
    for i in range(RISK_BINS):
        lo, hi = i * RISK_BIN_WIDTH, (i + 1) * RISK_BIN_WIDTH
        structs.append(F.struct(F.lit(lo).alias("lo"), F.lit(f"{lo}-{hi}%").alias("rango"),
                                _count_if(in_band(r, lo, hi)).alias("cantidad")))
    return _rows(flat, structs)


def heat_class(rate: Column) -> Column:
    return F.when(rate.isNull(), F.lit(None)).when(rate >= HEAT_HIGH, "alto").when(rate >= HEAT_MID, "medio").otherwise("bajo")


def rejection_heatmap(flat: DataFrame) -> DataFrame:
    """Job stability x payment capacity: n and rejection %, NULL when n = 0."""
    est, cap, ok = F.col("estabilidad_laboral"), F.col("capacidad_pago"), F.col("is_aprobado")
    structs = []
    for e in JOB_ORDER:
        for c in CAPACITY_ORDER:
            cell = (est == e) & (cap == c)
            structs.append(F.struct(F.lit(e).alias("estabilidad_laboral"), F.lit(c).alias("capacidad_pago"),
                                    _count_if(cell).alias("n"), _count_if(cell & ~ok).alias("rechazadas")))
    rows = _rows(flat, structs)
    rate = F.when(F.col("n") > 0, F.col("rechazadas") / F.col("n") * 100.0)
    return rows.select("estabilidad_laboral", "capacidad_pago", "n", rate.alias("tasa_rechazo"),
                       heat_class(rate).alias("nivel"))


def preliminary_vs_final(flat: DataFrame) -> DataFrame:
    """Approved / rejected per preliminary verdict."""
    d, ok = F.col("decision_preliminar"), F.col("is_aprobado")
    structs = [F.struct(F.lit(i).alias("orden"), F.lit(x).alias("decision"),
                        _count_if((d == x) & ok).alias("aprobadas"),
                        _count_if((d == x) & ~ok).alias("rechazadas"))
               for i, x in enumerate(PRELIM_ORDER)]
    return _rows(flat, structs)


def discrepancies(flat: DataFrame) -> DataFrame:
    """Consolidated-but-rejected plus bad-prospect-but-approved."""
    d, ok = F.col("decision_preliminar"), F.col("is_aprobado")
    return flat.agg(_count_if(((d == PRELIM_ORDER[0]) & ~ok) | ((d == PRELIM_ORDER[2]) & ok)).alias("discrepancias"))


def avoided_loss_by_stability(flat: DataFrame) -> DataFrame:
    """Over rejected rows, per financial-stability class: avoided loss and n."""
    s, ok = F.col("score_estabilidad_financiera"), F.col("is_aprobado")
    loss = avoided_loss(F.col("monto_solicitado"), F.col("pct_riesgo"))
    structs = [F.struct(F.lit(i).alias("orden"), F.lit(x).alias("categoria"),
                        exact_sum(F.when((s == x) & ~ok, loss)).alias("evitado"),
                        _count_if((s == x) & ~ok).alias("n"))
               for i, x in enumerate(FIN_ORDER)]
    return _rows(flat, structs)


def report(flat: DataFrame) -> dict[str, DataFrame]:
    """L3: every panel; cache ``flat`` first when running them all."""
    return {
        "kpis": kpis(flat),
        "por_ingreso": segment_distribution(flat, "ingreso"),
        "por_score": segment_distribution(flat, "score"),
        "histograma": risk_histogram(flat),
        "heatmap": rejection_heatmap(flat),
        "preliminar_vs_final": preliminary_vs_final(flat),
        "discrepancias": discrepancies(flat),
        "evitado_por_estabilidad": avoided_loss_by_stability(flat),
    }
