"""Queries of operators that keep wide or ordered state distributed: category dictionaries, curves, hash trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.exprs import hex_bucket, sql_hex_bucket
from panelkit.operators import categories as CAT
from panelkit.operators import evaluate as E
from panelkit.operators import features as FT
from panelkit.operators import hashtree as H
from panelkit.plans.catalog import register
from panelkit.plans.q_evaluate import VAL, _val, ranking_cte
from panelkit.plans.sql import sql_rnd
from panelkit.sources.tables import read_table

ORDER_CAT = ["o_custkey", "o_orderpriority", "o_orderstatus"]
ORDER_CONT = ["o_totalprice"]
TREE_FAN = 64


def _orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", *ORDER_CAT, *ORDER_CONT)
    return o.withColumn("train", hex_bucket(F.concat(F.lit("42|"), F.col("o_orderkey").cast("string")), 25) >= 9)


_ORDERS = f"""o AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice,
  {sql_hex_bucket("'42|' || CAST(o_orderkey AS VARCHAR)", 25)} >= 9 AS train FROM orders),
cats AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST(v AS VARCHAR) AS value, row_number() OVER (ORDER BY v) - 1 AS rank FROM (SELECT DISTINCT {c} AS v FROM o WHERE train AND {c} IS NOT NULL)"
    for c in ORDER_CAT) + """),
widths AS (SELECT """ + ", ".join(f"(SELECT count(*) FROM cats WHERE col = '{c}') AS w{k}" for k, c in enumerate(ORDER_CAT)) + """),
idx AS (SELECT col, value, rank + CASE col """ + " ".join(
    f"WHEN '{c}' THEN " + (" + ".join(f"w{j}" for j in range(k)) or "0") for k, c in enumerate(ORDER_CAT)) + """ END AS index FROM cats, widths),
hits AS (""" + " UNION ALL ".join(f"SELECT o_orderkey, '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM o" for c in ORDER_CAT) + """),
hot AS (SELECT o_orderkey, coalesce(list(index ORDER BY index) FILTER (WHERE index IS NOT NULL), []) AS indices FROM hits LEFT JOIN idx USING (col, value) GROUP BY o_orderkey)"""


@register("one_hot_wide", f"WITH {_ORDERS} SELECT o_orderkey, list_transform(indices, lambda x: CAST(x AS BIGINT)) AS indices FROM hot")
def q_one_hot_wide(spark, sf_dir):
    """F5 with a distributed dictionary: customer keys, priorities and states of all orders, fitted on train orders."""
    o = _orders(spark, sf_dir)
    return CAT.one_hot_indices(o, ["o_orderkey"], CAT.fit_dictionary(o.where("train"), ORDER_CAT))


_PRICE = "(SELECT quantile_cont(o_totalprice, 0.5) AS c, CASE WHEN quantile_cont(o_totalprice, 0.75) = quantile_cont(o_totalprice, 0.25) THEN 1.0 ELSE quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) END AS s FROM o WHERE train)"


@register("tabular_sparse", f"""WITH {_ORDERS}
SELECT o_orderkey, CAST(1 + w0 + w1 + w2 AS BIGINT) AS size, [CAST(0 AS BIGINT)] || list_transform(indices, lambda x: CAST(x + 1 AS BIGINT)) AS indices,
  [CAST({sql_rnd('(o_totalprice - p.c) / p.s', 6)} AS FLOAT)] || list_transform(indices, lambda x: CAST(1.0 AS FLOAT)) AS values
FROM o JOIN hot USING (o_orderkey), {_PRICE} p, widths""")
def q_tabular_sparse(spark, sf_dir):
    """F6 / F7 at any width: scaled price and one-hot blocks as sparse vectors."""
    o = _orders(spark, sf_dir)
    train = o.where("train")
    return CAT.sparse_representation(o, ["o_orderkey"], ORDER_CONT, FT.fit_robust(train, ORDER_CONT), CAT.fit_dictionary(train, ORDER_CAT))


@register("dictionary_lineage", f"""WITH {_ORDERS}
SELECT 'orders' AS representation, CAST(0 AS BIGINT) AS output_index, 'o_totalprice' AS source_column, 'robust_scaler' AS transformation, 'train' AS fitted_on,
  'o_totalprice' AS output_feature_name
UNION ALL SELECT 'orders', CAST(index + 1 AS BIGINT), col, 'one_hot', 'train', col || '_' || value FROM idx""")
def q_dictionary_lineage(spark, sf_dir):
    """F10 from the dictionary table."""
    return CAT.dictionary_lineage(CAT.fit_dictionary(_orders(spark, sf_dir).where("train"), ORDER_CAT), ORDER_CONT, "orders")


@register("roc_curve", f"""{VAL}, {ranking_cte('v')},
seen AS (SELECT *, lag(pos) OVER w AS lower_pos, lag(neg) OVER w AS lower_neg, lead(s) OVER w AS higher FROM run WINDOW w AS (PARTITION BY model_name ORDER BY s))
SELECT model_name, s AS threshold, CAST(N - neg_before AS BIGINT) AS fp, CAST(P - pos_before AS BIGINT) AS tp,
  CAST(N - neg_before AS DOUBLE) / CAST(NULLIF(N, 0) AS DOUBLE) AS fpr, CAST(P - pos_before AS DOUBLE) / CAST(NULLIF(P, 0) AS DOUBLE) AS tpr
FROM seen WHERE lower_pos IS NULL OR higher IS NULL OR lower_pos <> pos OR lower_neg <> neg
UNION ALL SELECT DISTINCT model_name, CAST('inf' AS DOUBLE), 0, 0, 0.0 / NULLIF(N, 0), 0.0 / NULLIF(P, 0) FROM run""")
def q_roc_curve(spark, sf_dir):
    """ROC points without collinear ones, with the end point at (0, 0)."""
    return E.roc_curve(_val(spark, sf_dir))


@register("pr_curve", f"""{VAL}, {ranking_cte('v')}
SELECT model_name, s AS threshold, COALESCE(CAST(P - pos_before AS DOUBLE) / CAST(NULLIF(P - pos_before + N - neg_before, 0) AS DOUBLE), 0.0) AS precision,
  COALESCE(CAST(P - pos_before AS DOUBLE) / CAST(NULLIF(P, 0) AS DOUBLE), 1.0) AS recall FROM run
UNION ALL SELECT DISTINCT model_name, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM run""")
def q_pr_curve(spark, sf_dir):
    """Precision-recall points with the end point (1, 0)."""
    return E.pr_curve(_val(spark, sf_dir))


@register("id_hash_tree", f"WITH {H.tree_sql('orders', ['o_orderkey'], ['o_custkey'], TREE_FAN, 4)}")
def q_id_hash_tree(spark, sf_dir):
    """The hash tree over all orders' keys with their customers."""
    return H.hash_tree(read_table(spark, sf_dir, "orders"), ["o_orderkey"], ["o_custkey"], TREE_FAN)
