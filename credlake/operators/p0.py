"""P0 scoring of applications (part C): validate -> labels -> risk -> decision.

``score_applications`` is one narrow projection over the input: no shuffle,
no Python; it runs identically in batch and inside ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlake.functions import labels as L
from credlake.functions.parsing import parse_pct
from credlake.functions.scoring import content_id
from credlake.operators.validate import split_valid

FEATURES = ["ingreso_mensual", "score_crediticio", "monto_solicitado", "antiguedad_laboral_meses", "deuda_actual"]
LABELS = ["ratio_endeudamiento_actual", "capacidad_pago", "estabilidad_laboral",
          "score_estabilidad_financiera", "decision_preliminar"]
# Fixed value: flow state written on every scored document.
FLOW_STATE = "p0_completado"
NO_DATA = "Sin dato"


def label_applications(df: DataFrame) -> DataFrame:
    """F3-F7 in one ``withColumns``."""
    return df.withColumns(L.label_columns())


def score_applications(valid: DataFrame, probability: str | Column = "p_riesgo") -> DataFrame:
    """F3-F9 on valid rows; ``probability`` is the model output column (M3)."""
    p = F.col(probability) if isinstance(probability, str) else probability
    labelled = label_applications(valid)
    return labelled.withColumns({
        "prediccion_xgboost": L.risk_pct_text(p),
        "pct_riesgo": L.risk_pct(p),
    }).withColumns({
        "resultado_final": L.approval(F.col("prediccion_xgboost")),
        "flujo_estado": F.lit(FLOW_STATE),
    })


def bulk_score(df: DataFrame, probability: str | Column = "p_riesgo") -> tuple[DataFrame, DataFrame]:
    """L2: (scored valid rows, invalid rows with reasons)."""
    valid, invalid = split_valid(df)
    return score_applications(valid, probability), invalid


def to_documents(scored: DataFrame) -> DataFrame:
    """Nested scored documents (solicitud / etiquetas / resultado_final / ...)."""
    return scored.select(
        F.struct(*[F.col(c) for c in FEATURES]).alias("solicitud"),
        F.struct(*[F.col(c) for c in LABELS], F.col("prediccion_xgboost")).alias("etiquetas"),
        F.col("resultado_final"),
        F.col("flujo_estado"),
        F.col("id").cast("string").alias("_id"),
    )


def flatten_scored(docs: DataFrame) -> DataFrame:
    """Nested document (bare, or wrapped as ``documento``) -> flat row.

    Numbers default to 0, labels to ``"Sin dato"``; the id is the inner
    ``_id``, else the outer ``_id``, else one made from the document itself
    (``content_id``); a row is approved iff ``upper(resultado_final) =
    'APROBADO'`` (errors count as rejected).  A number is read by the type that
    the schema gives it at either depth; only texts are parsed.
    """
    names = set(docs.columns)
    wrapped = "documento" in names

    def kind(path: str) -> T.DataType | None:
        t: T.DataType = docs.schema
        for part in path.split("."):
            if not isinstance(t, T.StructType) or part not in t.fieldNames():
                return None
            t = t[part].dataType
        return t

    def field(path: str, read: Callable[[Column, T.DataType], Column] = lambda c, t: c) -> Column:
        # Stored documents drift: any field may be missing, or of another type, at any depth.
        at = lambda p: read(F.col(p), kind(p)) if kind(p) else F.lit(None)
        bare = at(path)
        return F.when(F.col("documento").isNotNull(), at(f"documento.{path}")).otherwise(bare) if wrapped else bare

    def number(c: Column, t: T.DataType) -> Column:
        return c.cast("double") if isinstance(t, T.NumericType) else c.cast("string").try_cast("double")

    def num(path: str) -> Column:
        return F.coalesce(field(path, number), F.lit(0.0))

    def label(path: str) -> Column:
        return F.coalesce(field(path), F.lit(NO_DATA))

    outer_id = F.col("_id") if "_id" in names else F.lit(None)
    pred = field("etiquetas.prediccion_xgboost")
    out = [F.coalesce(field("_id"), outer_id, content_id(F.to_json(F.struct(*docs.columns)))).alias("id")]
    out += [num(f"solicitud.{c}").alias(c) for c in FEATURES]
    out.append(num("etiquetas.ratio_endeudamiento_actual").alias("ratio_endeudamiento_actual"))
    out += [label(f"etiquetas.{c}").alias(c) for c in LABELS[1:]]
    out.append(parse_pct(pred.cast("string")).alias("pct_riesgo"))
    out.append((F.upper(F.coalesce(field("resultado_final"), F.lit(""))) == "APROBADO").alias("is_aprobado"))
    return docs.select(*out)


def flatten_json(docs: DataFrame, column: str = "value") -> DataFrame:
    """P3 over documents as JSON texts whose fields differ in type from row to row.

    Each text is parsed once into a VARIANT, whose fields carry their own types:
    a number may be a number in one document and a text in the next, the risk a
    percentage text (F10) or a number, the whole wrapped as ``documento`` or
    bare.  Texts that are no JSON object are left out; ``unreadable_json`` lists
    them.  Without an ``_id`` the id is ``content_id`` of the text.
    """
    # A Generate node: a filter on the parsed text is not pushed below it, where the parsing (and whatever made the text) would be repeated.
    once = F.inline(F.array(F.struct(F.col(column).alias("text"), F.try_parse_json(column).alias("raw"))))
    parsed = docs.select(once).where(_is_object("raw"))
    inner = F.try_variant_get("raw", "$.documento", "variant")
    wrapped = inner.isNotNull() & ~F.is_variant_null(inner)
    doc = parsed.select("text", "raw", F.when(wrapped, inner).otherwise(F.col("raw")).alias("doc"))

    def num(path: str) -> Column:
        return F.coalesce(F.try_variant_get("doc", path, "double"), F.lit(0.0)).alias(path.rsplit(".", 1)[1])

    def label(name: str) -> Column:
        return F.coalesce(F.try_variant_get("doc", f"$.etiquetas.{name}", "string"), F.lit(NO_DATA)).alias(name)

    risk = F.try_variant_get("doc", "$.etiquetas.prediccion_xgboost", "variant")
    text = F.try_variant_get("doc", "$.etiquetas.prediccion_xgboost", "string")
    pct = F.when(F.schema_of_variant(risk) == "STRING", parse_pct(text)).otherwise(F.coalesce(text.try_cast("double"), F.lit(0.0)))
    made = F.coalesce(F.try_variant_get("doc", "$._id", "string"), F.try_variant_get("raw", "$._id", "string"), content_id(F.col("text")))
    result = F.upper(F.coalesce(F.try_variant_get("doc", "$.resultado_final", "string"), F.lit("")))
    return doc.select(made.alias("id"), *[num(f"$.solicitud.{c}") for c in FEATURES], num("$.etiquetas.ratio_endeudamiento_actual"),
                      *[label(c) for c in LABELS[1:]], pct.alias("pct_riesgo"), (result == "APROBADO").alias("is_aprobado"))


def _is_object(column: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.col(column)).startswith("OBJECT"), F.lit(False))


def unreadable_json(docs: DataFrame, column: str = "value") -> DataFrame:
    """The rows of ``docs`` whose text is no JSON object."""
    return docs.where(~F.coalesce(F.schema_of_variant(F.try_parse_json(column)).startswith("OBJECT"), F.lit(False)))


def latest(df: DataFrame, n: int = 10000, key: str = "id") -> DataFrame:
    """Newest documents first (key descending, NULL keys last), at most ``n``.

    A plain ``orderBy().limit(n)`` is a TakeOrderedAndProject whose final
    merge receives ``n`` rows from every partition in one task (``n`` x
    partitions).  The n-th largest key is found first by exact rank selection
    (distributed histogram passes); rows below it, and NULL keys where there
    are ``n`` others, are left out before the sort."""
    from credlake.operators.stats import value_at_rank
    total = df.where(F.col(key).isNotNull()).count()
    if total > n:
        df = df.where(F.col(key) >= F.lit(value_at_rank(df, key, total - n)))
    return df.orderBy(F.col(key).desc_nulls_last()).limit(n)


def latest_with_count(df: DataFrame, n: int = 10000, key: str = "id") -> tuple[DataFrame, int]:
    """T2 as the listing returns it: the rows and how many they are."""
    rows = latest(df, n, key)
    return rows, rows.count()
