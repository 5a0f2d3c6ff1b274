"""SQL text of the adapter views, for the DuckDB oracle.

Fixed values: these formulas define the credit-shaped fixtures over the
driver's tables (FIXTURES.md, part 3).  ``credlake.sources.views`` builds the
same tables with the DataFrame API.  Doubles are written ``...e0`` so both
engines read them as DOUBLE, never DECIMAL.
"""

from __future__ import annotations

from credlake.functions.lsh import projection_matrix

VIEW_SQL: dict[str, str] = {
    "applications": """
select o_orderkey as id, c_acctbal*400e0 as ingreso_mensual,
  cast(250 + (o_orderkey*7919 + o_custkey*31) % 650 as double) as score_crediticio,
  o_totalprice*20e0 as monto_solicitado,
  cast((o_custkey*13 + o_orderkey) % 151 as int) as antiguedad_laboral_meses,
  abs(c_acctbal)*400e0*(((o_orderkey*104729) % 1000)/1000e0) as deuda_actual,
  case when (o_orderkey*104729) % 1000 >= 800
        and 250 + (o_orderkey*7919 + o_custkey*31) % 650 < 500 then 1 else 0 end as es_fraude
from orders join customer on o_custkey = c_custkey""",
    "risk_input": """
select *, least(1e0, greatest(0e0, case when ingreso_mensual > 0 then 0.7e0*deuda_actual/ingreso_mensual else 0e0 end
                                  + 0.4e0*(850e0-score_crediticio)/550e0)) as p_riesgo from applications""",
    "requests": """
select o_orderkey as id, concat('PROP-', cast(o_custkey as varchar(20))) as property_id,
  o_totalprice*0.05e0 as monthly_rent, 'CLP' as currency from orders""",
    "applicants": """
select l_orderkey as request_id, l_linenumber as pos,
  case when l_linenumber <= 3 and l_orderkey % 13 <> 0 then 'TITULAR' else 'AVAL' end as role,
  case when l_linenumber % 4 = 3 or l_orderkey % 17 = 0 then 'INDEPENDENT' else 'DEPENDENT' end as income_type,
  max(case when l_returnflag = 'R' and l_discount >= 0.09e0 then 1 else 0 end) = 1 as is_hard_debt
from lineitem group by l_orderkey, l_linenumber""",
    "payslips": """
select l_orderkey as request_id, l_linenumber as pos, l_extendedprice as net_income
from lineitem where l_partkey % 11 <> 0""",
    "products": """
select p_brand as product_id, cast(p_partkey as varchar(20)) as flow_id, p_name as flow_name,
  case when p_size < 20 then 'active' when p_size < 40 then 'draft' else 'archived' end as flow_status from part""",
    "available_names": """
select cast(p_partkey as varchar(20)) as name from part where p_partkey % 97 = 0 union all select 'small ring'""",
    "predictions": """
select d.doc_id as id, l.quality as y, case when d.n_chars > 400 then 1 else 0 end as yhat, d.lang, d.n_chars
from documents d join labels l on d.doc_id = l.doc_id""",
    "user_roles": """
select c_custkey as user_id, c_mktsegment as role from customer""",
    "role_permissions": """
select distinct c_mktsegment as role, concat(n_name, ':', case when length(c_mktsegment) > 9 then 'write' else 'read' end) as permission
from customer join nation on c_nationkey = n_nationkey where n_nationkey % 3 = 0""",
    "access_requests": """
select o_orderkey as id, o_custkey as user_id, concat('NATION_', cast(o_orderkey % 25 as varchar(3))) as resource,
  case when o_orderkey % 2 = 0 then 'read' else 'write' end as action from orders""",
}

# Views that other views read.
_DEPENDS = {"risk_input": ["applications"]}


def with_views(names: list[str], body: str, extra: str = "") -> str:
    """``WITH view AS (...), ...[, extra ctes] body`` including dependencies, in order."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({VIEW_SQL[n]}\n)" for n in order)
    if extra.strip():
        ctes += ",\n" + extra.strip().lstrip(",")
    return f"with {ctes}\n{body}"


def dbl(x: float) -> str:
    """A double literal both engines read as DOUBLE."""
    s = repr(float(x))
    return s if ("e" in s or "E" in s) else s + "e0"


def signature_sql(z_exprs: list[str], R: list[list[float]]) -> str:
    """SQL text of F2 over already-standardised expressions."""
    bits = []
    for row in R:
        dot = " + ".join(f"{z}*{dbl(w)}" for z, w in zip(z_exprs, row))
        bits.append(f"case when {dot} >= 0 then '1' else '0' end")
    return "concat(" + ", ".join(bits) + ")"


def default_R(dims: int = 5, bits: int = 16) -> list[list[float]]:
    return projection_matrix(bits, dims)
