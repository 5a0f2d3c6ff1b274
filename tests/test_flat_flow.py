"""Flow specs compiled to flat state columns decide and explain as the nested runner does."""

import pytest

from credlake.operators import flat_flow, flows
from credlake.plans.flow_queries import comparable, nested_requests
from credlake.sources import views
from tests.conftest import SF_SMALL


def spec(*nodes, edges=None):
    """Nodes given as function names or ``?condition``; a chain unless edges are given as (from, to[, branch])."""
    listed = [{"id": f"n{i}", "type": "decision", "data": {"condition": n[1:]}} if n.startswith("?") else
              {"id": f"n{i}", "type": "function", "data": {"functionName": n}} for i, n in enumerate(nodes)]
    chain = edges or [(i, i + 1) for i in range(len(nodes) - 1)]
    return {"nodes": listed, "edges": [{"source": f"n{e[0]}", "target": f"n{e[1]}", "sourceHandle": e[2] if len(e) > 2 else None} for e in chain]}


AVG, DICOM, RENT, POOR, END = "fn_calcular_promedio_renta", "rl_check_dicom", "rl_renta_minima", "rl_sin_ingresos", "motor.finalize_decision"
SPECS = {
    "rules before the average": spec(RENT, DICOM, AVG, POOR, END),
    "average and rules twice": spec(AVG, RENT, AVG, RENT, DICOM, DICOM, END),
    "no finalize": spec(AVG, POOR),
    "decision on the decision": spec(AVG, RENT, "?decision.final_decision_code == 'REJECTED'", DICOM, END, edges=[(0, 1), (1, 2), (2, 3, "true"), (2, 4, "false"), (3, 4)]),
    "average on one branch, paths that meet": spec("?titular and titular.commercial_data.dicom.is_hard_debt", AVG, DICOM, "?len(applicants) > 2 and context.monthly_rent > 5000",
                                                  RENT, POOR, END, edges=[(0, 2, "true"), (0, 1, "false"), (1, 3), (2, 3), (3, 4, "true"), (3, 5, "false"), (4, 6), (5, 6)]),
    "condition on the titular's result": spec(AVG, RENT, "?titular.evaluation_results.income.evaluation_code == 'APPROVED'", POOR, END,
                                              edges=[(0, 1), (1, 2), (2, 4, "true"), (2, 3, "false"), (3, 4)]),
}


@pytest.mark.parametrize("name", SPECS)
def test_flat_equals_nested(spark, name):
    requests, pay = views.requests(spark, SF_SMALL), views.applicant_income(spark, SF_SMALL)
    nested = flows.apply_flow(nested_requests(spark, SF_SMALL), SPECS[name])
    want, got = flows.decision_summary(nested), flat_flow.decide(requests, pay, SPECS[name])
    order = sorted(want.columns)
    rows = lambda df, cols: sorted(map(str, df.select(cols).collect()))
    assert rows(got, order) == rows(want, order)
    want, got = comparable(flows.audit_paths(nested)), comparable(flat_flow.audit(requests, pay, SPECS[name]))
    assert rows(got, sorted(want.columns)) == rows(want, sorted(want.columns))


@pytest.mark.parametrize("bad", [spec("?size(filter(applicants, a -> a.role = 'AVAL')) > 0", END), spec("?titular.identity.full_name = 'x'", END),
                                 spec("rl_unknown", END), spec(AVG, END, edges=[(0, 1), (1, 0)])])
def test_what_flat_tables_cannot_decide_is_said_when_planning(spark, bad):
    if bad["nodes"][0].get("data", {}).get("functionName") == "rl_unknown":
        flows.register("rl_unknown", lambda state: state)
    try:
        with pytest.raises(flat_flow.NotFlat):
            flat_flow.decide(views.requests(spark, SF_SMALL), views.applicant_income(spark, SF_SMALL), bad)
    finally:
        flows._REGISTRY.pop("rl_unknown", None)
        flows._META.pop("rl_unknown", None)


def test_a_number_as_text_stays_small(spark):
    """The text of a number is bound once, not written out for every use."""
    from pyspark.sql import functions as F

    from credlake.functions.text import python_float
    assert len(python_float(F.col("x"))._jc.toString()) < 4000
