"""Facts of the amount and relationship sections (N1) on the customer-year panel."""

from __future__ import annotations

from panelkit.operators import facts as N
from panelkit.plans import q_relationship  # noqa: F401 - registers the statements used below
from panelkit.plans.catalog import ORACLE, register
from panelkit.plans.q_amounts import _by_target_sql, _change_sql, _corr_sql, _sign_sql, _summary_sql, display_range_sql
from panelkit.sources.testdata import PANEL_SPEC, customer_panel
from panelkit.spec import BILL_POLICY, PAYMENT_POLICY


def _facts_sql(section: str, parts: list[tuple[str, str, list[str]]]) -> str:
    """``parts``: statement, subject expression, metrics; each statement is evaluated once."""
    ctes = ", ".join(f"f{k} AS MATERIALIZED ({sql.strip()})" for k, (sql, _, _) in enumerate(parts))
    rows = [f"SELECT '{section}' AS section, CAST({subject} AS VARCHAR) AS subject, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM f{k}"
            for k, (_, subject, metrics) in enumerate(parts) for m in metrics]
    return f"WITH {ctes}\n" + "\nUNION ALL ".join(rows)


def _names(*columns: str) -> str:
    return "concat_ws(':', " + ", ".join(columns) + ")"


def _amount_sql(ch: str, section: str, policy) -> str:
    return _facts_sql(section, [
        (_summary_sql(ch, policy), "period", N.SUMMARY_METRICS),
        (_by_target_sql(ch, policy), _names("period", "target"), N.CLASS_METRICS),
        (_sign_sql(ch, policy), _names("period", "sign_category"), N.SIGN_METRICS),
        (_change_sql(ch, policy, False), _names("source_period", "destination_period"), N.CHANGE_METRICS),
        (_change_sql(ch, policy, True), _names("source_period", "destination_period", "target"), N.CHANGE_METRICS),
        (f"SELECT * FROM ({_corr_sql(ch)}) WHERE row_index < column_index", _names("row_period", "column_period"), ["correlation"]),
        (display_range_sql(ch), "period", N.RANGE_METRICS),
    ])


@register("facts_bill", _amount_sql("net", "bill", BILL_POLICY))
def q_facts_bill(spark, sf_dir):
    return N.amount_facts(customer_panel(spark, sf_dir), PANEL_SPEC, "net", "bill", BILL_POLICY)


@register("facts_payment", _amount_sql("paid", "payment", PAYMENT_POLICY))
def q_facts_payment(spark, sf_dir):
    return N.amount_facts(customer_panel(spark, sf_dir), PANEL_SPEC, "paid", "payment", PAYMENT_POLICY)


@register("facts_relationship", _facts_sql("relationship", [
    (ORACLE["relationship_summary"], "period", N.PAIR_METRICS),
    (ORACLE["ratio_summary"], "period", N.RATIO_METRICS),
    (ORACLE["ratio_by_target"], _names("period", "target"), ["ratio_median", "ratio_iqr"]),
    (ORACLE["relationship_categories"], _names("period", "category"), N.CATEGORY_METRICS),
]))
def q_facts_relationship(spark, sf_dir):
    return N.relationship_facts(customer_panel(spark, sf_dir), PANEL_SPEC)
