"""Check engine (C1-C11): a rule is a boolean aggregate plus a detail expression.

All rules over one DataFrame evaluate in a single aggregation and come back as
``(check_name, passed, detail)`` rows; ``assert_checks`` is the gate that
raises (listing the failed rows) before anything is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    passed: Column          # boolean aggregate expression
    detail: Column | None = None  # string-valued aggregate expression


def run_checks(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate every rule in one pass: (check_name, passed, detail)."""
    structs = [F.struct(F.lit(r.name).alias("check_name"),
                        F.coalesce(r.passed, F.lit(False)).alias("passed"),
                        (r.detail if r.detail is not None else F.lit("")).cast("string").alias("detail"))
               for r in rules]
    return df.agg(F.array(*structs).alias("_c")).select(F.inline("_c"))


def union_checks(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


class ChecksFailed(AssertionError):
    pass


def assert_checks(checks: DataFrame) -> DataFrame:
    """C11 gate: raise listing failed checks; returns the (small) checks table otherwise."""
    rows = checks.collect()  # one row per rule: bounded by the rule list
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise ChecksFailed("failed checks: " + "; ".join(f"{r['check_name']} ({r['detail']})" for r in failed))
    return checks


def close(a: Column, b: Column, tol: float = 1e-5) -> Column:
    """Anchor comparison: both NULL, or equal within ``tol``."""
    return (a.isNull() & b.isNull()) | (F.abs(a - b) <= F.lit(tol))
