"""The p0 flow three ways on random requests: nested runner, flat path and
a plain-Python model of the rules must agree request by request."""

import random


from credlake.operators import flat_rules, flows
from credlake.operators.requests import build_requests


def _random_requests(seed: int, n: int = 400):
    rnd = random.Random(seed)
    reqs, apps, pays = [], [], []
    for rid in range(1, n + 1):
        rent = rnd.choice([0.0, 100.0, 1000.0, rnd.uniform(1, 5000)])
        reqs.append((rid, f"P{rid}", rent, "CLP"))
        for pos in range(1, rnd.randint(0, 6) + 1):
            role = rnd.choice(["TITULAR", "AVAL", "AVAL"])
            itype = rnd.choice(["DEPENDENT", "DEPENDENT", "INDEPENDENT"])
            hard = rnd.random() < 0.2
            apps.append((rid, pos, role, itype, hard))
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                pays.append((rid, pos, rnd.choice([0.0, rnd.uniform(1, 20000)])))
    return reqs, apps, pays


def model_p0(rent, applicants, payslips):
    """applicants: [(pos, role, type, hard)] in position order; payslips: {pos: [income]}."""
    obs, avgs = 0, []
    for pos, _role, itype, _hard in applicants:
        incomes = payslips.get(pos, [])
        if itype == "DEPENDENT" and incomes:
            avgs.append(sum(sorted(incomes)) / len(incomes))
            obs += 1
        else:
            avgs.append(0.0)
    t = next((i for i, a in enumerate(applicants) if a[1] == "TITULAR"), None)
    codes, tit_code = [], (None if t is None else "PENDING")
    if t is not None and avgs[t] > 0:
        for a in applicants:
            if a[3]:
                codes.append("RL_DICOM_HARD")
                obs += 1
        if avgs[t] < rent * 3.0:
            codes.append("RL_RENTA_INSUFICIENTE")
            obs += 1
        else:
            tit_code = "APPROVED"
        trail = 3
    else:
        codes.append("RL_NO_TITULAR" if t is None else "RL_SIN_INGRESOS")
        obs += 1
        trail = 2
    return ("REJECTED" if codes else "APPROVED", ",".join(codes), tit_code, obs, trail)


def test_nested_flat_and_model_agree(spark):
    reqs, apps, pays = _random_requests(5)
    r = spark.createDataFrame(reqs, "id long, property_id string, monthly_rent double, currency string")
    a = spark.createDataFrame(apps, "request_id long, pos int, role string, income_type string, is_hard_debt boolean")
    p = spark.createDataFrame(pays, "request_id long, pos int, net_income double")
    cols = ["final_decision_code", "blocking_rule_codes", "titular_income_code", "n_observations", "n_trail"]
    nested = {row.id: tuple(row[c] for c in cols) for row in
              flows.decision_summary(flows.apply_flow(build_requests(r, a, p), flows.load_flows()["p0"])).collect()}
    flat = {row.id: tuple(row[c] for c in cols) for row in
            flat_rules.p0_flat(r, flat_rules.payslip_totals(a, p)).collect()}
    by_req_apps: dict = {}
    for rid, pos, role, itype, hard in sorted(apps):
        by_req_apps.setdefault(rid, []).append((pos, role, itype, hard))
    by_req_pays: dict = {}
    for rid, pos, inc in pays:
        by_req_pays.setdefault(rid, {}).setdefault(pos, []).append(inc)
    model = {str(rid): model_p0(rent, by_req_apps.get(rid, []), by_req_pays.get(rid, {}))
             for rid, _, rent, _ in reqs}
    assert set(nested) == set(flat) == set(model)
    bad = [(k, nested[k], flat[k], model[k]) for k in model if not (nested[k] == flat[k] == model[k])]
    assert not bad, bad[:5]


def test_audit_paths_nested_equals_flat(spark, monkeypatch):
    monkeypatch.setattr(flat_rules, "POS_BLOCK", 2)   # force ranks across blocks
    reqs, apps, pays = _random_requests(9, 300)
    r = spark.createDataFrame(reqs, "id long, property_id string, monthly_rent double, currency string")
    a = spark.createDataFrame(apps, "request_id long, pos int, role string, income_type string, is_hard_debt boolean")
    p = spark.createDataFrame(pays, "request_id long, pos int, net_income double")
    cols = ["id", "step", "execution_id", "fn_name", "path", "value_type"]
    nested = flows.audit_paths(flows.apply_flow(build_requests(r, a, p), flows.load_flows()["p0"])).select(cols)
    flat = flat_rules.p0_audit_paths(r, flat_rules.payslip_totals(a, p)).select(cols)
    assert nested.count() == flat.count() > 0
    assert nested.exceptAll(flat).count() == 0 and flat.exceptAll(nested).count() == 0
