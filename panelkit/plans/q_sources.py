"""Source / sink queries (A*): file integrity and the per-split smoke subset."""

from __future__ import annotations

from panelkit.plans.catalog import register
from panelkit.plans.q_features import SP, split_panel
from panelkit.sources.tables import smoke_subset, table_integrity


@register("file_integrity")
def q_file_integrity(spark, sf_dir):
    """A2: file name, size, sha256 (hashed on the executors), rows and columns of lineitem."""
    return table_integrity(spark, sf_dir, "lineitem")


@register("smoke_subset", f"""WITH {SP},
r AS (SELECT c_custkey, split, target, ROW_NUMBER() OVER (PARTITION BY split ORDER BY c_custkey) AS rn FROM sp)
SELECT c_custkey, split, target FROM r WHERE rn <= 100""")
def q_smoke_subset(spark, sf_dir):
    """A10: the first 100 ids of every split (the reference's smoke-run subset)."""
    return smoke_subset(split_panel(spark, sf_dir).select("c_custkey", "split", "target"), "c_custkey", 100)

