"""Column expressions and distributed building blocks shared by the operators."""

from panelkit.functions.exprs import (count_if, dbl, group_id, hex_bucket, hist_bin, hist_edge, pct, pct0,
                                      ratio, rnd, sign_label, sign_order, sql_hist_bin, sql_rnd)
from panelkit.functions.ordered import ordered_prefix
from panelkit.functions.quantiles import group_quantiles, quantiles_from_counts, value_counts

__all__ = ["count_if", "dbl", "group_id", "hex_bucket", "hist_bin", "hist_edge", "pct", "pct0", "ratio", "rnd",
           "sign_label", "sign_order", "sql_hist_bin", "sql_rnd", "ordered_prefix", "group_quantiles",
           "quantiles_from_counts", "value_counts"]
