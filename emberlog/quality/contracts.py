"""Contracts of tables, checked as aggregations: one row per check, with its number of violations."""

from __future__ import annotations

import ast
import hashlib
import json
import operator
import re
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.quality.declared import ENUMS, EXPRESSIONS, FIELDS, KEYS, VERSION, VERSIONS, Field


class Contract(NamedTuple):
    name: str
    version: str
    fields: Mapping[str, Field]
    key: tuple[str, ...] = ()
    enums: Mapping[str, tuple] = {}
    expressions: Mapping[str, str] = {}

    def project(self, columns: Iterable[str]) -> Contract:
        """The part of the contract a projection can be held to."""
        kept = set(columns) & set(self.fields)
        return self._replace(
            fields={n: f for n, f in self.fields.items() if n in kept}, key=self.key if set(self.key) <= kept else (),
            enums={n: v for n, v in self.enums.items() if n in kept},
            expressions={n: e for n, e in self.expressions.items() if names_in(e) <= kept})


_WORDS = {"and", "or", "not", "is", "None", "True", "False", "max", "min", "abs"}

def names_in(expression: str) -> set[str]:
    """Field names an expression reads."""
    bare = re.sub(r"'[^']*'|\"[^\"]*\"", " ", expression)
    return set(re.findall(r"[A-Za-z_]\w*", bare)) - _WORDS


_COMPARE = {ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge}
_COMPUTE = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv,
            ast.Mod: lambda a, b: a - b * F.floor(a / b)}  # takes the sign of the divisor
_CALLS = {"max": F.greatest, "min": F.least, "abs": F.abs}


def row_condition(expression: str, stands_for: Mapping[str, str] | None = None) -> Column:
    """A row rule (and, or, not, comparisons, arithmetic, max, min, abs) as a column, built from its syntax tree.

    ``stands_for`` names other columns to read in place of some fields.
    """
    tree = ast.parse(expression, mode="eval").body
    for node in ast.walk(tree):
        if isinstance(node, ast.Name):
            node.id = (stands_for or {}).get(node.id, node.id)
    return _column(tree)


def _column(node: ast.expr) -> Column:
    match node:
        case ast.Name(id=name):
            return F.col(name)
        case ast.Constant(value=value):
            return F.lit(value)
        case ast.BoolOp(op=op, values=values):
            return reduce(operator.and_ if isinstance(op, ast.And) else operator.or_, map(_column, values))
        case ast.UnaryOp(op=ast.Not(), operand=inner):
            return ~_column(inner)
        case ast.UnaryOp(op=ast.USub(), operand=inner):
            return -_column(inner)
        case ast.BinOp(left=left, op=op, right=right) if type(op) in _COMPUTE:
            return _COMPUTE[type(op)](_column(left), _column(right))
        case ast.Compare(left=left, ops=ops, comparators=others):
            return reduce(operator.and_, [_compared(op, a, b) for op, a, b in zip(ops, [left, *others], others)])
        case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if name in _CALLS:
            columns = [_column(a) for a in args]
            return columns[0] if name in ("max", "min") and len(columns) == 1 else _CALLS[name](*columns)
        case ast.Call(func=called):
            raise ValueError(f"Unsupported function in contract rule: {ast.unparse(called)}")
    raise ValueError(f"Unsupported part of a contract rule: {ast.unparse(node)}")


def _compared(op: ast.cmpop, left: ast.expr, right: ast.expr) -> Column:
    for side, other in ((left, right), (right, left)):
        if isinstance(side, ast.Constant) and side.value is None:
            null = _column(other).isNull()
            return ~null if isinstance(op, (ast.NotEq, ast.IsNot)) else null
    if type(op) not in _COMPARE:
        raise ValueError(f"Unsupported comparison in contract rule: {type(op).__name__}")
    return _COMPARE[type(op)](_column(left), _column(right))


_KINDS = {
    "string": (T.StringType,), "text": (T.StringType,),
    "integer": (T.IntegralType,), "int": (T.IntegralType,), "long": (T.IntegralType,),
    "number": (T.NumericType,), "float": (T.NumericType,), "double": (T.NumericType,), "decimal": (T.NumericType,),
    "boolean": (T.BooleanType,), "bool": (T.BooleanType,), "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "timestamp": (T.DateType, T.TimestampType, T.TimestampNTZType), "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "array": (T.ArrayType,),
}
# How text may still hold a typed value, as published data is text.
_PARSED = {"integer": "bigint", "int": "bigint", "long": "bigint", "number": "double", "float": "double", "double": "double",
           "decimal": "double", "boolean": "boolean", "bool": "boolean"}


def _wrong_type(name: str, field: Field, actual: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(actual, _KINDS.get(field.type, (T.DataType,))):
        return F.lit(False)
    if isinstance(actual, T.StringType):
        if field.type in ("date", "timestamp", "datetime"):
            return F.trim(value) == ""
        if field.type in _PARSED:
            return value.try_cast(_PARSED[field.type]).isNull()
    return value.isNotNull()


def schema_violations(df: DataFrame, contract: Contract) -> list[tuple[str, str]]:
    """Missing columns; known from the plan, no job."""
    return [("missing_column", n) for n in contract.fields if n not in df.columns]


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Every check of the contract with its violations.

    Field and row rules share one aggregation; the key takes one more. Nothing is collected.
    """
    absent = set(n for _, n in schema_violations(df, contract))
    checks: dict[tuple[str, str], Column] = {("missing_column", n): F.lit(1 if n in absent else 0).cast("bigint") for n in contract.fields}
    present = {n: f for n, f in contract.fields.items() if n not in absent}
    for name, field in present.items():
        value, is_text = F.col(name), isinstance(df.schema[name].dataType, T.StringType)
        blank = (value == "") if is_text else F.lit(False)
        if not field.nullable:
            checks["null", name] = F.count_if(value.isNull())
        if is_text and not field.allow_empty:
            checks["empty", name] = F.count_if(blank)
        checks["type", name] = F.count_if(value.isNotNull() & ~blank & _wrong_type(name, field, df.schema[name].dataType))
    for name, allowed in contract.enums.items():
        if name in present:
            passes = F.col(name).isin(list(allowed))
            if present[name].allow_empty:
                passes = passes | (F.col(name) == "")
            checks["enum", name] = F.count_if(F.col(name).isNotNull() & ~passes)
    # numbers kept as text are read as numbers by the rules; text that is none breaks them, and does not end the run
    texts = {n: f"_typed_{n}" for n, f in present.items() if f.type in _PARSED and isinstance(df.schema[n].dataType, T.StringType)}
    for name, expression in contract.expressions.items():
        if not names_in(expression) & absent:
            checks["rule", name] = F.count_if(~F.coalesce(row_condition(expression, texts), F.lit(False)))
    order = {pair: f"c{i}" for i, pair in enumerate(checks)}
    typed = df.withColumns({t: F.col(n).try_cast(_PARSED[present[n].type]) for n, t in texts.items()}) if texts else df
    counted = typed.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(order[p]) for p, c in checks.items()])
    entries = F.array(*[F.struct(F.lit(k).alias("check"), F.lit(n).alias("subject"), F.col(a).alias("violations")) for (k, n), a in order.items()])
    report = counted.select(F.explode(entries).alias("e")).select("e.*")
    if contract.key and not set(contract.key) & absent:
        report = report.unionByName(key_violations(df, contract.key))
    return report.select(F.lit(contract.name).alias("table_name"), "check", "subject", "violations")


def key_violations(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows with a null key part, and keys that occur more than once."""
    subject = ",".join(key)
    bad = F.lit(False)
    for part in key:
        bad = bad | F.col(part).isNull()
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    counted = per_key.agg(F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0).cast("bigint")).alias("null_key"),
                          F.count_if(F.col("_n") > 1).alias("duplicate_key"))
    entries = F.array(*[F.struct(F.lit(c).alias("check"), F.lit(subject).alias("subject"), F.col(c).alias("violations")) for c in ("null_key", "duplicate_key")])
    return counted.select(F.explode(entries).alias("e")).select("e.*")


def failed(report: DataFrame) -> DataFrame:
    return report.filter("violations > 0")


def declared(table: str) -> Contract:
    """Contract of a published table with its fields as declared, so that a frame can lack one or have another type."""
    return Contract(table, VERSIONS.get(table, VERSION), FIELDS[table], KEYS[table], ENUMS.get(table, {}), EXPRESSIONS.get(table, {}))


def contract_id(contract: Contract) -> str:
    """A name for exactly these checks: it changes when a field, key or rule does."""
    return hashlib.sha256(json.dumps(contract, sort_keys=True).encode()).hexdigest()[:16]
