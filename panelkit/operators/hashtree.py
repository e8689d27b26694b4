"""Exact population fingerprints by a hash tree over sorted rows.

Distinct rows are ranked in their own order by distributed prefix counts; ``fan``
consecutive ranks make a leaf, ``fan`` consecutive nodes a node of the next level, until one root is
left.  A node depends on ranks only, so the tree is the same whatever the partitioning, and two
populations that differ can be compared node by node instead of row by row.  No task holds
more than ``fan`` texts of a node; only the number of rows comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import text_of
from panelkit.functions.ordered import ordered_prefix
from panelkit.session import track

FAN = 1024


def hash_tree(df: DataFrame, id_cols: list[str], value_cols: list[str] | None = None, fan: int = FAN) -> DataFrame:
    """(level, node, n, digest): sha256 nodes, level 0 over the rows, the highest level has one node.

    A row reads ``id|value...*count``; rows are ordered by their id columns (nulls first), then by their values.  An empty table has no node.
    """
    cols = [*id_cols, *(value_cols or [])]
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    ordered = rows.select(F.lit(0).alias("_g"), F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(cols)]).alias("_order"), "_n", F.lit(1).cast("long").alias("_one"))
    ranked = ordered_prefix(ordered, ["_g"], "_order", ["_one"])
    # made after the ranking: only the columns are sorted and stored, not their text as well
    text = F.concat(F.concat_ws("|", *[text_of(F.col(f"_order._{i}")) for i in range(len(cols))]), F.lit("*"), F.col("_n").cast("string"))

    def nodes(frame: DataFrame, at, item, size, level: int) -> DataFrame:
        run = F.array_sort(F.collect_list(F.struct(at.alias("at"), item.alias("item"))))  # ``fan`` items at most
        return (frame.groupBy(F.floor(at / fan).cast("long").alias("node"))
                .agg(F.sum(size).cast("long").alias("n"), F.sha2(F.encode(F.array_join(F.transform(run, lambda x: x["item"]), "\n"), "UTF-8"), 256).alias("digest"))
                .select(F.lit(level).cast("long").alias("level"), "node", "n", "digest"))

    level = track(nodes(ranked, F.col("_one_before"), text, F.lit(1), 0))
    out, count, depth = level, level.count(), 0
    while count > 1:
        depth, count = depth + 1, -(-count // fan)
        level = nodes(level, F.col("node"), F.col("digest"), F.col("n"), depth)
        out = out.unionByName(level)
    return out


def root(tree: DataFrame) -> str | None:
    """The digest of the highest node."""
    row = tree.orderBy(F.desc("level")).first()
    return row["digest"] if row else None


def differing_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """Leaves (node, digest_a, digest_b) in which two trees differ; null where one has no such leaf."""
    left = a.where("level = 0").select("node", F.col("digest").alias("digest_a"))
    right = b.where("level = 0").select("node", F.col("digest").alias("digest_b"))
    return left.join(right, "node", "full_outer").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def tree_sql(source: str, id_cols: list[str], value_cols: list[str], fan: int, levels: int = 6) -> str:
    """DuckDB SQL of :func:`hash_tree` over a table or CTE, up to ``fan ** levels`` rows."""
    cols = ", ".join([*id_cols, *value_cols])
    text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in [*id_cols, *value_cols]) + ") || '*' || CAST(n AS VARCHAR)"
    order = ", ".join(f"{c} NULLS FIRST" for c in [*id_cols, *value_cols])
    sql = f"""ranked AS (SELECT {text} AS item, row_number() OVER (ORDER BY {order}) - 1 AS place FROM (SELECT {cols}, count(*) AS n FROM {source} GROUP BY {cols})),
l0 AS (SELECT place // {fan} AS node, count(*) AS n, sha256(string_agg(item, chr(10) ORDER BY place)) AS digest FROM ranked GROUP BY 1)"""
    for k in range(1, levels + 1):
        sql += f""",
l{k} AS (SELECT node // {fan} AS node, sum(n) AS n, sha256(string_agg(digest, chr(10) ORDER BY node)) AS digest FROM l{k - 1} WHERE (SELECT count(*) FROM l{k - 1}) > 1 GROUP BY 1)"""
    rows = " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS level, CAST(node AS BIGINT) AS node, CAST(n AS BIGINT) AS n, digest FROM l{k}" for k in range(levels + 1))
    return f"{sql} {rows}"
