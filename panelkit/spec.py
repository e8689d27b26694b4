"""Specs that replace the reference's hard-coded column names and constants.

A *panel* is a wide table: one row per entity, a binary target and a few
channels (status, bill, payment, ...) observed over a fixed run of periods.
``PanelSpec`` names those columns in chronological order; operators unpivot
them narrowly (a ``Generate`` node, no shuffle) when they need long form.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.exprs import known

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------
POSITIVE_CLASS = 1
NEGATIVE_CLASS = 0
SMALL_N = 200
# Full status domain (dense re-index) and the documented subset.
KNOWN_STATUS_CODES = (-2, -1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9)
DOCUMENTED_STATUS_CODES = (-1, 1, 2, 3, 4, 5, 6, 7, 8, 9)
DOCUMENTED = "documented"
UNDOCUMENTED = "not_explicitly_defined_in_uci_docs"
SIGN_CATEGORIES = ("negative", "zero", "positive")
RELATIONSHIP_CATEGORIES = (
    "bill_nonpositive_payment_zero",
    "bill_nonpositive_payment_positive",
    "bill_positive_payment_zero",
    "bill_positive_payment_positive",
)
SPLITS = ("train", "validation", "test")
STATIC_FENCE_K = 3.0
PANEL_FENCE_K = 1.5
# Threshold grid: 181 points 0.05 .. 0.95 built exactly like numpy.arange(0.050, 0.955, 0.005)
GRID_START = 0.05
GRID_STEP = 0.005
GRID_SIZE = 181
FIXED_THRESHOLD = 0.5
EARLY_STOP_MIN_DELTA = 1e-4
EARLY_STOP_PATIENCE = 7


@dataclass(frozen=True)
class PanelSpec:
    """Column layout of a wide panel.

    ``channels`` maps a channel name to its wide columns, oldest period first.
    """

    id_col: str
    target: str
    periods: tuple[str, ...]
    channels: Mapping[str, tuple[str, ...]]
    positive: int = POSITIVE_CLASS
    negative: int = NEGATIVE_CLASS
    small_n: int = SMALL_N

    def __post_init__(self):
        for name, cols in self.channels.items():
            if len(cols) != len(self.periods):
                raise ValueError(f"channel {name!r} has {len(cols)} columns for {len(self.periods)} periods")

    @property
    def n_periods(self) -> int:
        return len(self.periods)

    def columns(self, channel: str) -> tuple[str, ...]:
        try:
            return tuple(self.channels[channel])
        except KeyError as exc:
            raise ValueError(f"unknown channel {channel!r}; have {sorted(self.channels)}") from exc

    @staticmethod
    def _known(df: DataFrame, column: str) -> Column:
        return known(column, df.schema[column].dataType)

    def with_known(self, df: DataFrame, channels: list[str] | tuple[str, ...]) -> DataFrame:
        """``df`` with NaN as NULL in the channels' columns, for operators over the wide form."""
        cols = [c for ch in channels for c in self.columns(ch) if df.schema[c].dataType.typeName() in ("double", "float")]
        return df.withColumns({c: self._known(df, c) for c in cols}) if cols else df

    def to_long(self, df: DataFrame, channels: list[str] | tuple[str, ...], keep: list[str] | None = None) -> DataFrame:
        """Unpivot the given channels to ``(id, target, t, period, <channels>)``.

        ``t`` is 1-based and chronological; NaN becomes NULL.  Implemented with ``inline`` over an
        array of structs: a narrow Generate, one output row per (row, period).
        """
        keep = list(keep or [])
        structs = []
        for i, label in enumerate(self.periods):
            fields = [F.lit(i + 1).alias("t"), F.lit(label).alias("period")]
            fields += [self._known(df, self.columns(ch)[i]).alias(ch) for ch in channels]
            structs.append(F.struct(*fields))
        return df.select(F.col(self.id_col), F.col(self.target), *[F.col(c) for c in keep],
                         F.inline(F.array(*structs)))

    def pairs_long(self, df: DataFrame, channel: str) -> DataFrame:
        """Adjacent period pairs ``(id, target, pair_index, source_period, destination_period, src, dst)``."""
        cols = self.columns(channel)
        structs = []
        for i in range(self.n_periods - 1):
            structs.append(F.struct(
                F.lit(i + 1).alias("pair_index"),
                F.lit(self.periods[i]).alias("source_period"),
                F.lit(self.periods[i + 1]).alias("destination_period"),
                self._known(df, cols[i]).alias("src"),
                self._known(df, cols[i + 1]).alias("dst"),
            ))
        return df.select(F.col(self.id_col), F.col(self.target), F.inline(F.array(*structs)))

    def period_frame(self, spark: SparkSession) -> DataFrame:
        """Tiny ``(t, period)`` domain frame for dense re-indexing."""
        return spark.createDataFrame([(i + 1, p) for i, p in enumerate(self.periods)], "t int, period string")


@dataclass(frozen=True)
class CodeBook:
    """Documented codes per categorical feature (the reference's documented-values dict)."""

    documented: Mapping[str, tuple[int, ...]] = field(default_factory=dict)

    def codes(self, feature: str) -> tuple[int, ...]:
        return tuple(self.documented.get(feature, ()))

    def is_documented(self, feature: str, value: Column) -> Column:
        codes = self.codes(feature)
        if not codes:
            return F.lit(False)
        return value.isin(*codes)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(f, int(c)) for f, cs in self.documented.items() for c in cs]
        schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("code", T.LongType())])
        return spark.createDataFrame(rows, schema)


@dataclass(frozen=True)
class AmountPolicy:
    """Null/flag rules that differ between the two amount channels of the reference.

    bill:    NULL sign falls through to "zero"; monthly count = non-null; by-target
             skips empty classes; caution = n < small_n; change % over all rows.
    payment: NULL sign excluded; monthly count = all rows; by-target keeps empty
             classes; caution = 0 < n < small_n; change % over non-null diffs.
    """

    name: str
    null_sign_is_zero: bool
    count_all_rows: bool
    skip_empty_class: bool
    caution_requires_observed: bool
    change_over_all_rows: bool
    quartile_suffix: str  # change-table column names: "" -> q1/q3, "_change" -> q1_change/q3_change

    def caution(self, n: Column, small_n: int) -> Column:
        if self.caution_requires_observed:
            return (n > 0) & (n < small_n)
        return n < small_n


BILL_POLICY = AmountPolicy("bill", True, False, True, False, True, "")
PAYMENT_POLICY = AmountPolicy("payment", False, True, False, True, False, "_change")
