"""Findings facts (N1): the numbers quoted in the reports as one long table.

``(section, subject, metric, value)`` rows are projections of operator outputs
stacked with ``unionByName``; every input is already a small aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import amounts as M
from panelkit.operators import relationship as REL
from panelkit.spec import BILL_POLICY, AmountPolicy, PanelSpec

#: metrics that each section quotes, by the table they come from
SUMMARY_METRICS = ["mean", "p25", "median", "p75", "iqr", "total_potential_extreme_count"]
CLASS_METRICS = ["count", "median"]
SIGN_METRICS = ["total_count", "default_rate"]
CHANGE_METRICS = ["median_change"]
RANGE_METRICS = ["global_low_percentile", "global_high_percentile", "total_count", "outside_range_count", "outside_range_percentage"]
PAIR_METRICS = ["pearson_correlation", "zero_payment_count"]
RATIO_METRICS = ["eligible_count", "eligible_percentage", "ratio_median", "ratio_iqr"]
CATEGORY_METRICS = ["total_count", "default_rate", "caution_flag"]


def fact_rows(df: DataFrame, section: str, subject, metrics: list[str]) -> DataFrame:
    """Unpivot ``metrics`` of ``df`` into (section, subject, metric, value double)."""
    subj = F.col(subject).cast("string") if isinstance(subject, str) else subject
    return df.select(F.lit(section).alias("section"), subj.alias("subject"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))


def facts(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _names(*columns: str) -> F.Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in columns])


def amount_facts(df: DataFrame, spec: PanelSpec, channel: str, section: str, policy: AmountPolicy = BILL_POLICY) -> DataFrame:
    """One amount channel: spread and extremes of each period, classes, signs with their default rates, changes
    between adjacent periods, correlations of different periods, and what lies outside the display range."""
    corr = M.correlation_matrix(df, spec, channel).where(F.col("row_index") < F.col("column_index"))
    by_class = M.adjacent_change_by_target(df, spec, channel, policy)
    return facts([
        fact_rows(M.panel_summary(df, spec, channel, policy), section, "period", SUMMARY_METRICS),
        fact_rows(M.panel_summary_by_target(df, spec, channel, policy), section, _names("period", "target"), CLASS_METRICS),
        fact_rows(M.sign_summary(df, spec, channel, policy), section, _names("period", "sign_category"), SIGN_METRICS),
        fact_rows(M.adjacent_change(df, spec, channel, policy), section, _names("source_period", "destination_period"), CHANGE_METRICS),
        fact_rows(by_class, section, _names("source_period", "destination_period", "target"), CHANGE_METRICS),
        fact_rows(corr, section, _names("row_period", "column_period"), ["correlation"]),
        fact_rows(M.display_range(df, spec, channel), section, "period", RANGE_METRICS),
    ])


def relationship_facts(df: DataFrame, spec: PanelSpec, bill: str = "bill", pay: str = "pay", section: str = "relationship") -> DataFrame:
    """Paired channels: correlation and zero payments of each period, guarded ratios with their spread, overall
    and by class, and the four categories with default rates and the flag of small cells."""
    return facts([
        fact_rows(REL.relationship_summary(df, spec, bill, pay), section, "period", PAIR_METRICS),
        fact_rows(REL.ratio_summary(df, spec, bill, pay), section, "period", RATIO_METRICS),
        fact_rows(REL.ratio_by_target(df, spec, bill, pay), section, _names("period", "target"), ["ratio_median", "ratio_iqr"]),
        fact_rows(REL.relationship_categories(df, spec, bill, pay), section, _names("period", "category"), CATEGORY_METRICS),
    ])
