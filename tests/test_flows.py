"""Rule flow: the two golden documents, spec walking rules, trail."""

import json

import pytest
from pyspark.sql import functions as F

from credlake.operators import flows
from credlake.plans import jobs
from credlake.sources import files


def _applicant(app_id, payslips, hard=False):
    return {
        "id": app_id, "role": "TITULAR",
        "identity": {"full_name": "Test Person", "document_type": "RUT"},
        "income_source": {"type": "DEPENDENT", "dependent": {
            "contract": {"type": "INDEFINIDO"},  # unknown key: dropped by the schema
            "payslips": [{"month_index": i + 1, "period": f"2023-{12 - i:02d}", "gross_income": p * 1.1,
                          "net_income": p} for i, p in enumerate(payslips)]}},
        "commercial_data": {"dicom": {"score": 200 if hard else 800, "is_hard_debt": hard},
                            "estimated_monthly_debt_payment": 0},
        "qualitative_data": {"family_size": 1, "has_pets": 0, "references_count": 0},
        "calculated_metrics": {}, "evaluation_results": {},
    }


APPROVE = {"solicitud": {"id": "SOL-A", "schema_version": "1.0.0",
                         "context": {"property_id": "P-1", "monthly_rent": 600000, "currency": "CLP"},
                         "observations": [], "applicants": [_applicant("APP-1", [2500000, 2500000, 2500000])],
                         "fn_history": [], "decision": {"final_decision_code": "PENDING", "blocking_rule_codes": [],
                                                        "required_action_codes": []},
                         "audit": {"evaluated_at": ""}}}
REJECT = {"solicitud": {"id": "SOL-B",
                        "context": {"property_id": "P-2", "monthly_rent": 400000, "currency": "CLP"},
                        "applicants": [_applicant("APP-2", [1800000, 1800000], hard=True)]}}


@pytest.fixture(scope="module")
def decided(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("requests")
    for name, doc in (("approve.json", APPROVE), ("reject.json", REJECT)):
        (d / name).write_text(json.dumps(doc, indent=2), encoding="utf-8")
    (d / "broken.json").write_text("{not json", encoding="utf-8")
    req, bad = files.read_requests(spark, str(d))
    out = flows.apply_flow(req, flows.load_flows()["p0"])
    return {r.id: r for r in out.collect()}, bad.collect()


def test_approve_case(decided):
    rows, _ = decided
    r = rows["SOL-A"]
    assert r.decision.final_decision_code == "APPROVED"
    assert r.decision.blocking_rule_codes == []
    assert r.applicants[0].evaluation_results.income.evaluation_code == "APPROVED"
    assert r.applicants[0].calculated_metrics.income.avg_6m == 2500000.0
    assert len(r.observations) == 1 and r.observations[0].fn_name == "fn_calc_renta"
    assert [h.fn_name for h in r.fn_history] == ["fn_calcular_promedio_renta", "rl_check_dicom", "rl_renta_minima"]
    assert [h.execution_id for h in r.fn_history] == ["exec-1", "exec-2", "exec-3"]


def test_bureau_reject_case(decided):
    rows, _ = decided
    r = rows["SOL-B"]
    assert r.decision.final_decision_code == "REJECTED"
    assert r.decision.blocking_rule_codes == ["RL_DICOM_HARD"]
    assert r.applicants[0].evaluation_results.income.evaluation_code == "APPROVED"
    assert [o.message for o in r.observations] == ["Promedio calculado App APP-2", "Rechazo Automático: RL_DICOM_HARD"]
    assert json.loads(r.observations[1].value) == "Aplicante APP-2 tiene antecedentes comerciales bloqueantes."
    h = r.fn_history
    assert [x.fn_name for x in h] == ["fn_calcular_promedio_renta", "rl_check_dicom", "rl_renta_minima"]
    assert [o.path for o in h[0].outputs] == ["applicants[0].calculated_metrics"]
    metrics = json.loads(h[0].outputs[0].value)
    assert metrics["income"]["avg_6m"] == 1800000.0 and metrics["income"]["avg_12m"] == 0
    assert [o.path for o in h[1].outputs] == ["decision"]
    assert json.loads(h[1].outputs[0].value)["blocking_rule_codes"] == ["RL_DICOM_HARD"]
    assert [o.path for o in h[2].outputs] == ["applicants[0].evaluation_results"]
    assert h[0].inputs[0].value == "SolicitudMotor(id=SOL-B, applicants=1)"


def test_bad_file_is_reported(decided):
    _, bad = decided
    assert [b._file for b in bad] == ["broken.json"]


def test_flow_code_and_unknowns():
    assert flows.flow_name_for("FLOW_P0") == "p0"
    with pytest.raises(ValueError):
        flows.flow_name_for("NOPE")
    with pytest.raises(ValueError):
        flows.get_step("fn_missing")


def test_cycle_is_rejected():
    spec = {"nodes": [{"id": "a", "type": "function", "data": {"functionName": "rl_check_dicom"}},
                      {"id": "b", "type": "function", "data": {"functionName": "rl_sin_ingresos"}}],
            "edges": [{"source": "a", "target": "b"}, {"source": "b", "target": "a"}], "entryNodeId": "a"}
    with pytest.raises(ValueError):
        flows.plan_flow(spec)


def test_cyclic_flow_runs_with_the_step_cap(spark, tmp_path):
    # a -> b -> a ...: 2 nodes, so at most 4 steps: a, b, a, b.
    spec = {"flow_name": "loop", "entryNodeId": "a",
            "nodes": [{"id": "a", "type": "function", "data": {"functionName": "fn_calcular_promedio_renta"}},
                      {"id": "b", "type": "function", "data": {"functionName": "rl_check_dicom"}}],
            "edges": [{"source": "a", "target": "b"}, {"source": "b", "target": "a"}]}
    d = tmp_path / "in"
    d.mkdir()
    (d / "r.json").write_text(json.dumps(REJECT), encoding="utf-8")
    req, _ = files.read_requests(spark, str(d))
    r = flows.apply_flow(req, spec).first()
    assert [h.fn_name for h in r.fn_history] == ["fn_calcular_promedio_renta", "rl_check_dicom"] * 2
    assert [h.execution_id for h in r.fn_history] == ["exec-1", "exec-2", "exec-3", "exec-4"]
    assert r.decision.blocking_rule_codes == ["RL_DICOM_HARD", "RL_DICOM_HARD"]
    assert len(r.observations) == 4
    # The second average leaves the metrics unchanged, so its trail entry has no output.
    assert [len(h.outputs) for h in r.fn_history] == [1, 1, 0, 1]


def test_walk_rules():
    # Root = first node without incoming edge; function nodes follow only the first edge;
    # a decision without matching handle takes its first edge; unknown types stop.
    spec = {"nodes": [{"id": "x", "type": "note"},
                      {"id": "s", "type": "function", "data": {"functionName": "fn_calcular_promedio_renta"}},
                      {"id": "d", "type": "decision", "data": {"condition": "true"}},
                      {"id": "t", "type": "function", "data": {"functionName": "rl_check_dicom"}},
                      {"id": "u", "type": "function", "data": {"functionName": "rl_sin_ingresos"}}],
            "edges": [{"source": "x", "target": "s"}, {"source": "s", "target": "d"}, {"source": "s", "target": "u"},
                      {"source": "d", "target": "t"}]}
    plan = flows.plan_flow(spec)
    assert plan.order == ["x"]  # the note node is the root and stops the walk
    spec["entryNodeId"] = "s"
    plan = flows.plan_flow(spec)
    assert plan.order == ["s", "d", "t"]
    assert sorted(plan.incoming["t"]) == [("d", "false"), ("d", "true")]


def test_request_batch_job(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps(APPROVE), encoding="utf-8")
    (src / "b.json").write_text(json.dumps(REJECT["solicitud"]), encoding="utf-8")  # bare document (P4)
    (src / "c.json").write_text("{broken", encoding="utf-8")
    summary = jobs.request_batch_job(spark, str(src), str(tmp_path / "out"), flow_code="FLOW_P0",
                                     errors_dir=str(tmp_path / "errors"))
    assert {r.decision: r.n for r in summary.collect()} == {"APPROVED": 1, "REJECTED": 1, "ERROR": 1}
    assert [r.file for r in spark.read.json(str(tmp_path / "errors")).collect()] == ["c.json"]
    docs = spark.read.json(str(tmp_path / "out"))
    assert sorted(r.result_name for r in docs.collect()) == ["result_a.json", "result_b.json"]
    doc = json.loads(docs.where(F.col("id") == "SOL-B").first().document)
    assert doc["decision"]["final_decision_code"] == "REJECTED"


def test_python_and_sql_conditions_agree(decided, spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.json").write_text(json.dumps(APPROVE), encoding="utf-8")
    (d / "b.json").write_text(json.dumps(REJECT), encoding="utf-8")
    req, _ = files.read_requests(spark, str(d))
    sql_spec = flows.load_flows()["p0"]
    py_spec = json.loads(json.dumps(sql_spec))
    for n in py_spec["nodes"]:
        if n["type"] == "decision":
            n["data"]["condition"] = "titular and titular.calculated_metrics.income.avg_6m > 0"
    a = {r.id: (r.decision.final_decision_code, r.decision.blocking_rule_codes, len(r.fn_history))
         for r in flows.apply_flow(req, sql_spec).collect()}
    b = {r.id: (r.decision.final_decision_code, r.decision.blocking_rule_codes, len(r.fn_history))
         for r in flows.apply_flow(req, py_spec).collect()}
    assert a == b == {"SOL-A": ("APPROVED", [], 3), "SOL-B": ("REJECTED", ["RL_DICOM_HARD"], 3)}


def test_condition_subset(spark):
    from credlake.functions.conditions import condition_column
    df = spark.createDataFrame([(1, "A", [1]), (0, "", []), (None, None, None)],
                               "n int, s string, xs array<int>").withColumnRenamed("n", "decision")
    schema = {f.name: f.dataType for f in df.schema.fields}
    # Truthiness of a number (NULL is falsy) and a comparison with NULL (false).
    got = df.select(condition_column("decision and not decision < 0", schema).alias("c")).collect()
    assert [r.c for r in got] == [True, False, False]


def test_invoke_single_step(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "b.json").write_text(json.dumps(REJECT), encoding="utf-8")
    req, _ = files.read_requests(spark, str(d))
    assert "rl_check_dicom" in flows.list_steps()
    r = flows.invoke(req, "rl_check_dicom").first()
    assert r.decision.blocking_rule_codes == ["RL_DICOM_HARD"] and r.fn_history[0].execution_id == "exec-1"


def test_registry_and_spec_files(tmp_path):
    names = [f["name"] for f in flows.list_functions()]
    assert names == sorted(["fn_calcular_promedio_renta", "motor.finalize_decision", "rl_check_dicom",
                            "rl_renta_minima", "rl_sin_ingresos"])
    assert {f["category"] for f in flows.list_functions()} == {"calculations", "rulesets", "engine"}
    store = tmp_path / "flows.json"
    store.write_text(json.dumps({"flows": {"flow-x": {"nodes": [], "edges": []}}}), encoding="utf-8")
    assert set(flows.load_flows(store)) == {"flow-x", "p0"}      # p0 is always available
    with pytest.raises(ValueError):
        flows.load_flow("nope", store)
    codes = tmp_path / "codes.json"
    codes.write_text(json.dumps({"code_to_flow": {"FLOW_X": "flow-x"}}), encoding="utf-8")
    assert flows.flow_name_for("FLOW_X", flows.load_flow_codes(codes)) == "flow-x"


def test_missing_required_fields_are_reported(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    doc = json.loads(json.dumps(REJECT))
    del doc["solicitud"]["applicants"][0]["role"]
    (d / "norole.json").write_text(json.dumps(doc), encoding="utf-8")
    (d / "ok.json").write_text(json.dumps(APPROVE), encoding="utf-8")
    req, bad = files.read_requests(spark, str(d))
    assert [r.id for r in req.collect()] == ["SOL-A"]
    assert [(b._file, b._corrupt) for b in bad.collect()] == [("norole.json", "missing required field")]


def test_input_state_survives(spark, tmp_path):
    doc = json.loads(json.dumps(APPROVE))
    sol = doc["solicitud"]
    sol["decision"]["blocking_rule_codes"] = ["RL_PREVIA"]
    sol["fn_history"] = [{"execution_id": "exec-1", "fn_name": "fn_previa", "executed_at": "2024-01-01T00:00:00",
                          "inputs": [], "outputs": []}]
    sol["observations"] = [{"fn_name": "manual", "message": "nota", "value": "\"x\""}]
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.json").write_text(json.dumps(doc), encoding="utf-8")
    req, _ = files.read_requests(spark, str(d))
    r = flows.apply_flow(req, flows.load_flows()["p0"]).first()
    assert r.decision.final_decision_code == "REJECTED"              # the code already present counts
    assert r.decision.blocking_rule_codes == ["RL_PREVIA"]
    assert [h.execution_id for h in r.fn_history] == ["exec-1", "exec-2", "exec-3", "exec-4"]
    assert r.observations[0].message == "nota" and len(r.observations) == 2
