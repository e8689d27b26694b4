"""One-hot encoding by a distributed category dictionary (F5-F7 for any number of categories).

The dictionary is a table ``(column, value, rank)``: the distinct train values of every
column, ranked in order (integers by number, all else as text) by distributed prefix counts.
Only its widths, one number a column, come to the driver.  Rows are encoded by a
join on (column, value) and an aggregation back to the row, as sparse vectors: ascending
indices of the features that are not zero, and their values.  A hot category is one row
of the dictionary, so AQE can split its side of the join; an unknown or null value has no index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import broadcast_small, rnd
from panelkit.functions.ordered import ordered_prefix
from panelkit.operators.features import ScalerParams

_INTEGERS = ("tinyint", "smallint", "int", "bigint")


@dataclass
class Dictionary:
    """``table`` (column, value, rank) and the number of categories of each column, in order of the blocks."""
    table: DataFrame
    widths: dict[str, int]

    @property
    def width(self) -> int:
        return sum(self.widths.values())

    def offsets(self) -> dict[str, int]:
        out, at = {}, 0
        for c, n in self.widths.items():
            out[c], at = at, at + n
        return out


def _stacked(df: DataFrame, cols: list[str], *keep: str) -> DataFrame:
    """(keep..., column, value as text): one narrow row for every non-null category of a row."""
    return df.select(*keep, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])))


def fit_dictionary(train: DataFrame, cols: list[str]) -> Dictionary:
    """sorted distinct train categories of every column as a ranked table."""
    types = dict(train.dtypes)
    numeric = [c for c in cols if types[c] in _INTEGERS]
    found = _stacked(train, cols).where(F.col("value").isNotNull()).distinct()
    number = F.when(F.col("column").isin(numeric), F.col("value").try_cast("decimal(20,0)")) if numeric else F.lit(None).cast("decimal(20,0)")
    ordered = found.select("column", "value", F.struct(number.alias("number"), F.col("value").alias("text")).alias("_order"), F.lit(1).cast("long").alias("rank"))
    table = ordered_prefix(ordered, ["column"], "_order", ["rank"]).select("column", "value", F.col("rank_before").cast("long").alias("rank"))
    counts = {r["column"]: r["n"] for r in found.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a column
    return Dictionary(table, {c: counts.get(c, 0) for c in cols})


def save_dictionary(d: Dictionary, path: str) -> None:
    """The ranked table as Parquet; its widths follow from it."""
    d.table.write.mode("overwrite").parquet(path)


def load_dictionary(spark, path: str, cols: list[str]) -> Dictionary:
    table = spark.read.parquet(path)
    counts = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Dictionary(table, {c: counts.get(c, 0) for c in cols})


def one_hot_indices(df: DataFrame, ids: list[str], d: Dictionary, start: int = 0) -> DataFrame:
    """(ids..., indices array<long>): ascending places of a row's categories among all features, the first block at ``start``.

    ``ids`` must tell rows apart; rows that share them share one vector.
    """
    offset = F.create_map(*[x for c, at in d.offsets().items() for x in (F.lit(c), F.lit(at + start).cast("long"))])
    table = d.table.select("column", "value", (offset[F.col("column")] + F.col("rank")).alias("index"))
    hit = _stacked(df, list(d.widths), *ids).join(broadcast_small(table), ["column", "value"], "left")
    return hit.groupBy(*ids).agg(F.sort_array(F.collect_set("index")).alias("indices"))  # one entry a column at most


def sparse_representation(df: DataFrame, ids: list[str], cont: list[str], params: ScalerParams, d: Dictionary) -> DataFrame:
    """F6 / F7 at any width: (ids..., size, indices, values): scaled continuous columns, then the one-hot blocks."""
    scaled = df.select(*ids, *[rnd(params.apply(c, F.col(c)), 6).cast("float").alias(f"_x{i}") for i, c in enumerate(cont)])
    one = F.lit(1.0).cast("float")
    joined = one_hot_indices(df, ids, d, len(cont)).join(scaled, ids)
    first = F.array(*[F.lit(i).cast("long") for i in range(len(cont))]).cast("array<long>")
    return joined.select(*ids, F.lit(len(cont) + d.width).cast("long").alias("size"), F.concat(first, F.col("indices")).alias("indices"),
                         F.concat(F.array(*[F.col(f"_x{i}") for i in range(len(cont))]).cast("array<float>"), F.transform("indices", lambda _: one)).alias("values"))


def dense(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector as an array, for small widths."""
    known = F.map_from_arrays(indices, values)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(known, i.cast("long")), F.lit(0.0).cast("float")))


def dictionary_lineage(d: Dictionary, cont: list[str], representation: str, fitted_on: str = "train") -> DataFrame:
    """one row for every output feature, from the dictionary itself: nothing is built on the driver but the continuous columns."""
    spark = d.table.sparkSession
    offset = F.create_map(*[x for c, at in d.offsets().items() for x in (F.lit(c), F.lit(at + len(cont)).cast("long"))])
    wide = d.table.select(F.lit(representation).alias("representation"), (offset[F.col("column")] + F.col("rank")).alias("output_index"),
                          F.col("column").alias("source_column"), F.lit("one_hot").alias("transformation"), F.lit(fitted_on).alias("fitted_on"),
                          F.concat_ws("_", "column", "value").alias("output_feature_name"))
    own = spark.createDataFrame([(representation, i, c, "robust_scaler", fitted_on, c) for i, c in enumerate(cont)],
                                "representation string, output_index long, source_column string, transformation string, fitted_on string, output_feature_name string")
    return own.unionByName(wide)


