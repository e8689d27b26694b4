"""Schema validation (V1-V7): metadata predicates plus one small aggregation.

Validators raise ``ValueError`` / ``TypeError`` like the reference; the schema
tables are small DataFrames built from the spec and ``df.dtypes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.spec import PanelSpec

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def require_columns(df: DataFrame, cols) -> None:
    """V1: raise listing the missing and the available columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Required column(s) missing: {missing}; available: {df.columns}")


def require_numeric(df: DataFrame, cols) -> None:
    """V3 / V4: listed columns must be numeric (TypeError otherwise)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    bad = [c for c in cols if not isinstance(types[c], NUMERIC)]
    if bad:
        raise TypeError(f"Column(s) not numeric: {bad}")


def require_unique_names(df: DataFrame) -> None:
    seen, dup = set(), set()
    for c in df.columns:
        (dup if c in seen else seen).add(c)
    if dup:
        raise ValueError(f"Duplicated column(s): {sorted(dup)}")


def validate_panel(df: DataFrame, spec: PanelSpec, channels: list[str], expected_rows: int | None = None,
                   forbidden: tuple[str, ...] = (), numeric: bool = True) -> None:
    """V2 / V3 / V4 / V5: columns present (and numeric), forbidden absent, binary target, row count.

    One aggregation gives the row count and the target's value range.
    """
    require_columns(df, [spec.target])
    cols = [c for ch in channels for c in spec.columns(ch)]
    require_columns(df, cols)
    require_unique_names(df)
    if numeric:
        require_numeric(df, cols)
    present = [c for c in forbidden if c in df.columns]
    if present:
        raise ValueError(f"Column(s) expected to be absent are present: {present}")
    t = F.col(spec.target)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"),
               F.count_distinct(t).alias("k"), F.count(t).alias("nn")).first()
    if expected_rows is not None and r["n"] != expected_rows:
        raise ValueError(f"the table has {r['n']} rows instead of {expected_rows}")
    if not (r["k"] == 2 and r["lo"] == spec.negative and r["hi"] == spec.positive and r["nn"] == r["n"]):
        raise ValueError(f"Expected binary target {{{spec.negative}, {spec.positive}}}, got min={r['lo']} max={r['hi']} "
                         f"distinct={r['k']} nulls={r['n'] - r['nn']}")


def schema_table(df: DataFrame, spec: PanelSpec, channels: list[str], forbidden: tuple[str, ...] = ()) -> DataFrame:
    """V6: (chronological_index from 1, period, channel, raw_column, expected_present, actual_present,
    dtype, documentation_note); forbidden columns are listed with expected_present = false."""
    spark = df.sparkSession
    types = dict(df.dtypes)
    rows = []
    for ch in channels:
        for i, (p, c) in enumerate(zip(spec.periods, spec.columns(ch)), start=1):
            rows.append((i, p, ch, c, True, c in types, types.get(c, "N/A"), "channel column of this period"))
    for j, c in enumerate(forbidden, start=len(spec.periods) + 1):
        rows.append((j, "N/A", None, c, False, c in types, types.get(c, "N/A"), "must not be in the table"))
    return spark.createDataFrame(rows, "chronological_index int, period string, channel string, raw_column string, "
                                       "expected_present boolean, actual_present boolean, dtype string, "
                                       "documentation_note string")


def require_exact_columns(df: DataFrame, expected: tuple[str, ...]) -> None:
    """V7: column list equality, in order."""
    if tuple(df.columns) != tuple(expected):
        raise ValueError(f"Expected columns {list(expected)}, got {df.columns}")
