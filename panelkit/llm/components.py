"""Connected components of a link table, by alternating stars with joins and minima only.

Every step is a grouped minimum and a join; no group is ever gathered, and each step's table is
written to the shared folder, so lineage stays short and lost executors cost one step at most.  The
joined tables are read back from there, which lets adaptive execution split a hot node on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` has two long columns a, b.  Returns (node, label): the least node of each node's
    component; labels themselves and nodes without a link have no row.  Nulls and loops are ignored."""
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.selectExpr("a as u", "b as v").unionAll(edges.selectExpr("b as u", "a as v"))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m"), "least")
        edges = materialise(both.where("v > u").join(least, "u").selectExpr("v as a", "m as b").distinct(), "edges")
        least = materialise(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
        edges = materialise(edges.join(least, "a").selectExpr("b as a", "m as b").where("a <> b")
                            .unionAll(least.selectExpr("a", "m as b")).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.selectExpr("a as node", "b as label")
