"""One case for every fault that the last review found outside the fixtures."""

import json
import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlake.functions import labels
from credlake.functions.conditions import condition_column
from credlake.functions.text import python_float
from credlake.operators import flows, generic, p0, rules, sampling, validate
from credlake.operators.insights import exact_sum
from credlake.sinks import writers

NAN = float("nan")


def test_nan_is_not_a_valid_application(spark):
    cols = "ingreso_mensual double, score_crediticio double, monto_solicitado double, antiguedad_laboral_meses double, deuda_actual double"
    good = (1000.0, 700.0, 500.0, 12.0, 0.0)
    rows = [good] + [tuple(NAN if j == i else x for j, x in enumerate(good)) for i in range(5)]
    out = validate.validate_applications(spark.createDataFrame(rows, cols)).collect()
    assert [r.es_valida for r in out] == [True] + [False] * 5 and all(len(r.motivos) == 1 for r in out[1:])


@pytest.mark.parametrize("text,want", [("decision != 'B'", [True, False, True]), ("decision == None", [True, False, False]), ("decision != None", [False, True, True]),
                                       ("decision not in ['B']", [True, False, True]), ("decision in ['B', None]", [True, True, False]), ("0", [False] * 3),
                                       ("''", [False] * 3), ("2.5", [True] * 3), ("not 0", [True] * 3), ("decision > 'A'", [False, True, True])])
def test_conditions_follow_python_on_none_and_constants(spark, text, want):
    df = spark.createDataFrame([(0, None), (1, "B"), (2, "C")], "id int, decision string")
    got = df.withColumn("c", condition_column(text, {"decision": T.StringType()})).orderBy("id").collect()
    assert [r.c for r in got] == want


def test_numbers_print_as_in_python(spark):
    rng = random.Random(6)
    xs = [0.0, -0.0, 1.0, 12345678.9, 1e7, 9999999.0, 1e15, 1e16, 1.5e16, 123456789012345680.0, 1e22, 1e100, 1.7e308, 1e-300, 1e-3, 1e-4, 1.25e-4, 1e-5, 1.5e-7,
          -2.5e9, 0.1 + 0.2, math.inf, -math.inf, NAN] + [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 15) for _ in range(400)]
    got = spark.createDataFrame(list(enumerate(xs)), "i int, x double").select("i", python_float(F.col("x")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [repr(x) for x in xs]


def test_json_text_is_json(spark):
    texts = ['a "b" \\ c', "line\nfeed\ttab\x01", "é €", ""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(rules.json_text(F.col("t")).alias("j")).collect()
    assert [json.loads(r.j) for r in got] == texts


def test_repeated_permission_requests_all_stay(spark):
    req = spark.createDataFrame([("u", "doc", "read")] * 2 + [("v", "doc", "read"), (None, "doc", "read")], "user_id string, resource string, action string")
    roles = spark.createDataFrame([("u", "r1"), ("u", "r2"), ("v", "r3")], "user_id string, role string")
    perms = spark.createDataFrame([("r1", "doc:read"), ("r2", "doc:read"), ("r2", "doc:read")], "role string, permission string")
    out = generic.check_permissions(req, roles, perms).collect()
    assert sorted((str(r.user_id), r.allowed) for r in out) == [("None", False), ("u", True), ("u", True), ("v", False)]


def test_null_is_a_class_of_the_split(spark):
    df = spark.range(50).select("id", F.when(F.col("id") >= 10, (F.col("id") % 2).cast("string")).alias("y"))
    out = sampling.stratified_split(df, "y", 0.2).collect()
    assert all(r.is_test is not None for r in out)
    sizes = {c: sum(r.is_test for r in out if r.y == c) for c in (None, "0", "1")}
    assert sizes == {None: 2, "0": 4, "1": 4}


def test_a_text_for_a_number_does_not_stop_the_batch(spark):
    kind = "_id string, solicitud struct<ingreso_mensual: string, score_crediticio: string>, resultado_final string"
    out = p0.flatten_scored(spark.createDataFrame([("a", ("abc", "700"), "Aprobado"), ("b", ("1.5E7", None), "x")], kind)).orderBy("id").collect()
    assert [(r.ingreso_mensual, r.score_crediticio) for r in out] == [(0.0, 700.0), (1.5e7, 0.0)]


def test_approval_strips_all_white_space(spark):
    texts = ["\t35%\n", " 40 % ", " 39% ", "x%"]
    out = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(labels.approval(F.col("t"))).collect()]
    assert out[:3] == [labels.APPROVED, labels.REJECTED, labels.APPROVED] and out[3].startswith(labels.ERROR_PREFIX)


def test_nan_is_never_left_out_of_a_sum(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(10)] + [(NAN, 1.0)], "a double, b double")
    r = generic.aggregate_data(df, {"a": "sum", "b": "sum"}).first()
    assert r.a is None and float(r.b) == 46.0
    assert df.agg(exact_sum(F.col("a")).alias("s")).first().s is None and float(df.agg(exact_sum(F.col("b")).alias("s")).first().s) == 46.0


def test_keyed_append(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, v string")
    assert writers.append_scored(df, path, "id") == 2 and writers.append_scored(df, path, "id") == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception) as e:
        writers.append_scored(df, str(tmp_path / "broken"), "id")
    assert not (isinstance(e.value, AnalysisException) and e.value.getCondition() == "PATH_NOT_FOUND")


def test_unknown_flow_codes_are_errors(spark):
    known = next(iter(flows.CODE_TO_FLOW))
    df = spark.createDataFrame([("1", known), ("2", "nope"), ("3", None)], "id string, code string")
    assert sorted((r.id, r.message) for r in flows.unknown_flow_codes(df, "code").collect()) == [
        ("2", "Flow name not found for code 'nope'"), ("3", "Flow name not found for code 'None'")]
    assert flows.flow_code_for(flows.CODE_TO_FLOW[known]) == known and flows.flow_code_for("nothing") is None


def test_walk_tables():
    spec = {"nodes": [{"id": "a", "type": "decision"}, {"id": "b", "type": "function"}, {"id": "c", "type": "note"}],
            "edges": [{"source": "a", "target": "b"}, {"source": "a", "target": "c", "sourceHandle": "false"}, {"source": "a", "target": "a2", "sourceHandle": "false"},
                      {"source": "b", "target": "c"}, {"source": "b", "target": "a"}]}
    g = flows._graph(spec)
    assert g.entry == "a" and g.moves == {"a": [("b", "true"), ("c", "false")], "b": [("c", None)], "c": []}
    assert flows._graph({"nodes": [], "edges": []}).entry is None
    assert flows._graph({**spec, "entryNodeId": "b"}).entry == "b"
    loop = {"nodes": [{"id": "x", "type": "function"}], "edges": [{"source": "x", "target": "x"}]}
    assert flows._graph(loop).entry == "x"
    with pytest.raises(flows.CyclicFlow):
        flows.plan_flow(loop)
