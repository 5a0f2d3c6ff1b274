"""The batch job keeps nothing but its compressed files, and parses a text once per read."""

import json
import os

from pyspark.sql import functions as F

from credlake.operators import flows
from credlake.plans import io_queries, jobs
from credlake.sources import files
from tests.conftest import SF_SMALL


def _request(i, **changed):
    return {"id": f"R{i}", "context": {"property_id": "P", "monthly_rent": 10.0, "currency": "CLP"}, "applicants": [
        {"id": "a", "role": "TITULAR", "income_source": {"type": "DEPENDENT", "dependent": {"payslips": [{"month_index": 1, "net_income": 90.0}]}}}], **changed}


def test_a_text_is_parsed_once_per_read(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(_request(1)), encoding="utf-8")
    for frame in files.read_requests(spark, str(tmp_path)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_request_batch_keeps_only_compressed_files(spark, monkeypatch):
    out, folder = [], io_queries.folder
    monkeypatch.setattr(io_queries, "folder", lambda *a: out.append(folder(*a)) or out[-1])
    persisted = []
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: persisted.append(self) or self)
    got = io_queries.io_request_batch(spark, SF_SMALL)
    names = {x for d in ("plain", "results", "errors") for x in os.listdir(f"{out[0]}/{d}") if x.startswith("part-")}
    assert names and all(x.endswith(".gz") for x in names) and not persisted
    done = spark.read.json(f"{out[0]}/results")
    assert got.where("error is null").count() == done.count() > 0
    size = sum(os.path.getsize(f"{out[0]}/results/{x}") for x in os.listdir(f"{out[0]}/results"))
    assert size * 5 < done.agg(F.sum(F.length("document"))).first()[0]


def test_summary_counts_codes_that_no_rule_sets(spark, tmp_path, monkeypatch):
    src = tmp_path / "in"
    src.mkdir()
    lines = [_request(i, decision={"final_decision_code": c}) for i, c in enumerate(["CUSTOM", "CUSTOM", "PENDING", "otra \"ñ\""])]
    (src / "all.txt").write_text("\n".join([*map(json.dumps, lines), "{broken", json.dumps({"id": "x"})]), encoding="utf-8")
    spec = {"nodes": [{"id": "n", "type": "function", "data": {"functionName": "fn_calcular_promedio_renta"}}], "edges": []}
    monkeypatch.setattr(flows, "load_flow", lambda name: spec)
    for errors in (str(tmp_path / "errors"), None):
        summary = jobs.request_batch_job(spark, str(src), str(tmp_path / "out"), errors_dir=errors, lines=True)
        assert {r.decision: r.n for r in summary.collect()} == {"CUSTOM": 2, "PENDING": 1, "otra \"ñ\"": 1, "ERROR": 2}
    bad = spark.read.json(str(tmp_path / "errors"))
    assert sorted(r.error for r in bad.collect()) == ["missing required field", "{broken"]
