"""Flow conditions (R11) as Column expressions.

Conditions are Spark SQL text.  Specs saved by the flow designer use the
Python expression syntax instead (``titular and
titular.calculated_metrics.income.avg_6m > 0``); that small subset is turned
into the same Column expressions with Python's own ``ast`` module:
``and``/``or``/``not`` on truthiness, comparisons, attribute access into the
request columns, literals, ``len(x)`` and ``x in [...]``.  Anything outside
the subset is read as SQL.  NULL (Python's None) is falsy; it equals only
itself, so ``!=`` and ``not in`` hold for it, and an order comparison with it
is false.
"""

from __future__ import annotations

import ast

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOTS = ("titular", "context", "applicants", "decision")


class _Unsupported(Exception):
    pass


def _truthy(c: Column, dtype: T.DataType | None) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c != 0, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.length(c) > 0, F.lit(False))
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def _field_type(schema: dict[str, T.DataType], path: list[str]) -> T.DataType | None:
    t = schema.get(path[0])
    for p in path[1:]:
        if not isinstance(t, T.StructType) or p not in t.fieldNames():
            return None
        t = t[p].dataType
    return t


def _translate(node: ast.AST, schema: dict[str, T.DataType]) -> tuple[Column, T.DataType | None]:
    if isinstance(node, ast.Expression):
        return _translate(node.body, schema)
    if isinstance(node, ast.BoolOp):
        parts = [_truthy(*_translate(v, schema)) for v in node.values]
        out = parts[0]
        for p in parts[1:]:
            out = (out & p) if isinstance(node.op, ast.And) else (out | p)
        return out, T.BooleanType()
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
        return ~_truthy(*_translate(node.operand, schema)), T.BooleanType()
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
        c, t = _translate(node.operand, schema)
        return -c, t
    if isinstance(node, ast.Compare):
        left, _ = _translate(node.left, schema)
        out = None
        for op, comp in zip(node.ops, node.comparators):
            if isinstance(op, (ast.In, ast.NotIn)) and isinstance(comp, (ast.List, ast.Tuple)):
                vals = [_literal(e) for e in comp.elts]
                cond = F.coalesce(left.isin([v for v in vals if v is not None]), F.lit(False))
                cond = (cond | left.isNull()) if None in vals else cond
                cond = ~cond if isinstance(op, ast.NotIn) else cond
            else:
                right, _ = _translate(comp, schema)
                ops = {ast.Gt: left > right, ast.GtE: left >= right, ast.Lt: left < right,
                       ast.LtE: left <= right, ast.Eq: left.eqNullSafe(right), ast.NotEq: ~left.eqNullSafe(right)}
                if type(op) in (ast.Is, ast.IsNot) and isinstance(comp, ast.Constant) and comp.value is None:
                    cond = left.isNull() if isinstance(op, ast.Is) else left.isNotNull()
                elif type(op) in ops:
                    cond = ops[type(op)]
                else:
                    raise _Unsupported(type(op).__name__)
                left = right
            cond = F.coalesce(cond, F.lit(False))
            out = cond if out is None else out & cond
        return out, T.BooleanType()
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id == "len" and len(node.args) == 1:
        c, _ = _translate(node.args[0], schema)
        return F.size(c), T.IntegerType()
    if isinstance(node, ast.Constant):
        v = node.value
        kinds = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType()}
        return F.lit(v), kinds.get(type(v))
    path = _attribute_path(node)
    if path is not None:
        if path[0] == "motor":
            path = path[1:]
        if not path or path[0] not in ROOTS:
            raise _Unsupported(".".join(path))
        return F.col(".".join(path)), _field_type(schema, path)
    raise _Unsupported(type(node).__name__)


def _literal(node: ast.AST):
    if isinstance(node, ast.Constant):
        return node.value
    raise _Unsupported("non-literal in list")


def _attribute_path(node: ast.AST) -> list[str] | None:
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    if isinstance(node, ast.Name):
        return [node.id] + parts[::-1]
    return None


def condition_column(text: str, schema: dict[str, T.DataType]) -> Column:
    """Boolean Column for a flow condition (Python subset, else Spark SQL)."""
    try:
        tree = ast.parse(text, mode="eval")
        col, dtype = _translate(tree, schema)
        return _truthy(col, dtype)
    except (SyntaxError, _Unsupported):
        return F.coalesce(F.expr(text).cast("boolean"), F.lit(False))
