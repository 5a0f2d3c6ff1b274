"""Stores that take a key once, tables that change in one step, documents of drifting types."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from credlake.operators import p0
from credlake.sinks import versioned, writers
from credlake.sources import files
from credlake.streaming import scoring

APP = "id long, ingreso_mensual double, score_crediticio double, monto_solicitado double, antiguedad_laboral_meses int, deuda_actual double, p_riesgo double"


def app(i, amount=1000.0):
    return (i, 5000.0, 700.0, amount, 24, 100.0, 0.25)


def run(spark, source, out, checkpoint="checkpoint"):
    stream = spark.readStream.schema(APP).option("maxFilesPerTrigger", 1).parquet(source)
    return scoring.stream_p0_scores(spark, stream, out, key="id", buckets=4, checkpoint=checkpoint)


def test_a_key_is_stored_once_whatever_the_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda rows: spark.createDataFrame(rows, APP).coalesce(1).write.mode("append").parquet(source)
    put([app(1), app(2), app(-1, -5.0)])
    put([app(2), app(3), app(3), app(-1, -5.0)])
    scored, invalid = run(spark, source, out)
    assert sorted(r.id for r in scored.collect()) == [1, 2, 3] and [r.id for r in invalid.collect()] == [-1]
    put([app(1), app(4)])
    scored, _ = run(spark, source, out)
    assert sorted(r.id for r in scored.collect()) == [1, 2, 3, 4]
    # Every file again, as after a restart from a lost checkpoint, with other batches than before.
    put([app(5)])
    scored, invalid = run(spark, source, out, "another")
    assert sorted(r.id for r in scored.collect()) == [1, 2, 3, 4, 5] and invalid.count() == 1


def test_the_same_row_of_a_key_stays_every_time(spark):
    rows = [(1, "a"), (1, "b"), (1, "c"), (2, "x"), (None, "n"), (None, "n")]
    kept = [sorted(map(str, writers.one_per_key(spark.createDataFrame(rows[::d], "k int, v string").repartition(p), "k").collect())) for d in (1, -1) for p in (1, 4)]
    assert all(k == kept[0] for k in kept) and len(kept[0]) == 4


def test_a_change_that_fails_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, root)
    assert versioned.append(spark.range(10), root) == 10 and versioned.append(spark.range(10, 12), root) == 2
    ids = lambda: sorted(r.id for r in versioned.read(spark, root).collect())
    broken = versioned.read(spark, root).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    for change in (lambda: versioned.replace(broken, root), lambda: versioned.append(broken, root), lambda: versioned.delete(spark, root, broken)):
        with pytest.raises(PySparkException):
            change()
        assert ids() == list(range(12))
    earlier = versioned.read(spark, root)
    assert versioned.delete(spark, root, spark.range(5)) == 5 and versioned.delete(spark, root, spark.range(5)) == 0
    assert ids() == list(range(5, 12)) and earlier.count() == 12  # a reader that began before still has its rows
    assert versioned.vacuum(spark, root) > 0 and ids() == list(range(5, 12))


def test_json_documents_of_drifting_types(spark):
    docs = [{"_id": "a", "solicitud": {"ingreso_mensual": "12.5", "score_crediticio": 700, "deuda_actual": "x"}, "etiquetas": {"prediccion_xgboost": "23%", "capacidad_pago": "Alta"},
             "resultado_final": "Aprobado"},
            {"_id": "out", "documento": {"solicitud": {"ingreso_mensual": 3}, "etiquetas": {"prediccion_xgboost": 17.5}}},
            {"documento": None, "solicitud": None, "etiquetas": {"prediccion_xgboost": "Alto (Prob: 1.0)"}, "resultado_final": None}]
    texts = [json.dumps(d) for d in docs] + ["{broken", "[1]", "3", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.id: r for r in p0.flatten_json(df).collect()}
    assert len(got) == 3 and p0.unreadable_json(df).count() == 5
    a, b = got["a"], got["out"]
    assert (a.ingreso_mensual, a.score_crediticio, a.deuda_actual, a.pct_riesgo, a.is_aprobado, a.capacidad_pago) == (12.5, 700.0, 0.0, 23.0, True, "Alta")
    assert (b.ingreso_mensual, b.pct_riesgo, b.is_aprobado, b.estabilidad_laboral) == (3.0, 17.5, False, "Sin dato")
    made = next(k for k in got if k not in ("a", "out"))
    assert got[made].pct_riesgo is None and [len(x) for x in made.split("-")] == [8, 4, 4, 4, 12]
    assert made in {r.id for r in p0.flatten_json(df.repartition(3)).collect()}  # a recomputed task makes the same id


def test_requests_per_line(spark, tmp_path):
    good = {"id": 7, "context": {"property_id": "p", "monthly_rent": 5.0, "currency": "CLP"}, "applicants": [{"id": "a", "role": "TITULAR", "income_source": {"type": "X"}}]}
    lines = [json.dumps(good), json.dumps({"solicitud": {**good, "id": "8"}}), "{\"id\": 3, ", "", json.dumps({"id": "9"}), "null"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "batch.jsonl").write_text("\n".join(lines))
    requests, bad = files.read_requests(spark, str(tmp_path / "in"), lines=True)
    assert sorted(r.id for r in requests.collect()) == ["7", "8"]
    assert sorted((r._file, r._corrupt) for r in bad.collect()) == [("batch.jsonl", "missing required field"), ("batch.jsonl", "null"), ("batch.jsonl", '{"id": 3, ')]
