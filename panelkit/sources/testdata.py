"""Derived inputs over the driver's test tables (the SURVEY §7.3 mapping).

* ``customer_panel``: one row per customer, periods = order years 1995..2001 (all of the tables),
  channels status / bill / pay / net / paid, target = negative account balance.
* ``lineitem_rows``: row-level table with target ``l_returnflag = 'R'``.
* ``prediction_table``: three deterministic score columns over lineitem in long
  form, restricted to the validation / test splits of a hash group split.
* ``part_groups``: a table with repeated predictor groups.

Every derivation is lazy (the panel's row counts apart), reads only the columns it needs and is sized for
large inputs: lineitem is collapsed to one row per order and year *before* the join,
so the only lineitem shuffle is the narrow one on the order key
and the join with orders reuses that partitioning.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.exprs import hex_bucket
from panelkit.sources.tables import read_table
from panelkit.spec import CodeBook, PanelSpec

# Fixed parameters of the test-table mapping.
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
MONEY = "decimal(18,2)"
SPLIT_BUCKETS = 25
SPLIT_SEED = "42"
ROWS_PER_TASK = 500_000
GRID_MODELS = ("model_a", "model_b", "model_c")

PANEL_SPEC = PanelSpec(
    id_col="c_custkey",
    target="target",
    periods=tuple(str(y) for y in YEARS),
    channels={
        ch: tuple(f"{ch}_{i}" for i in range(1, len(YEARS) + 1)) for ch in ("status", "bill", "pay", "net", "paid")
    },
)

# Documented codes of the test tables' categorical columns (the code book).
PANEL_CODEBOOK = CodeBook({"c_nationkey": tuple(range(0, 20))})
LINEITEM_CODEBOOK = CodeBook({"l_linenumber": (1, 2, 3, 4, 5)})

_cache: dict[tuple[int, str, str], DataFrame] = {}


def _cached(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _cache.get(key)
    if df is None:
        df = build().cache()
        _cache[key] = df
    return df


def _status(n) -> F.Column:
    """Orders in the year -> status code: 0 -> -2, 1 -> -1, n >= 2 -> min(n - 2, 9)."""
    return (F.when(n == 0, F.lit(-2)).when(n == 1, F.lit(-1))
             .otherwise(F.least(n - 2, F.lit(9)))).cast("int")


def _parts(spark: SparkSession, n_rows: int) -> int:
    """Partitions for so many rows: a task's share stays the same at every size."""
    return max(min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-n_rows // ROWS_PER_TASK))


def _cents(column: str) -> F.Column:
    """The amount to the cent as a whole number: these are shipped and summed several times faster than decimals."""
    return (F.col(column).cast(MONEY) * 100).cast("long")


def _money(cents: str) -> F.Column:
    return F.col(cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def build_customer_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and orders meet by order key, then go to their customers as narrow rows (customer, year, amounts).

    Only these narrow rows are shuffled; the wide sums are made where all rows of a customer are.  The number of
    partitions follows the row counts (read from the files' footers), so no task holds more at larger tables.
    """
    li, orders = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    n_orders, n_lines = orders.count(), li.count()
    by_order, by_customer = _parts(spark, n_lines), _parts(spark, 2 * n_orders)
    per_order = li.select("l_orderkey", F.year("l_shipdate").alias("y"), _cents("l_extendedprice").alias("price")) \
        .repartition(by_order, "l_orderkey").groupBy("l_orderkey", "y").agg(F.sum("price").alias("pay"), F.count(F.lit(1)).alias("lines"))
    owner = orders.select("o_orderkey", "o_custkey").repartition(by_order, "o_orderkey")
    pays = owner.join(per_order, owner.o_orderkey == per_order.l_orderkey).select(
        "o_custkey", "y", F.lit(None).cast("long").alias("tp"), F.lit(0).alias("one"), "pay", "lines")
    bills = orders.select("o_custkey", F.year("o_orderdate").alias("y"), _cents("o_totalprice").alias("tp"), F.lit(1).alias("one"),
                          F.lit(None).cast("long").alias("pay"), F.lit(None).cast("long").alias("lines"))
    per_cust = bills.unionByName(pays).repartition(by_customer, "o_custkey").groupBy("o_custkey").agg(
        *[F.sum(F.when(F.col("y") == y, F.col("tp"))).alias(f"b_{i}") for i, y in enumerate(YEARS, 1)],
        *[F.sum(F.when(F.col("y") == y, F.col("one"))).alias(f"n_{i}") for i, y in enumerate(YEARS, 1)],
        *[F.sum(F.when(F.col("y") == y, F.col("pay"))).alias(f"p_{i}") for i, y in enumerate(YEARS, 1)],
        F.sum("one").alias("n_orders"), F.sum("lines").alias("n_lines"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal").repartition(by_customer, "c_custkey")
    p = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    p = p.withColumns({f"{x}_{i}": _money(f"{x}_{i}") for x in "bp" for i in range(1, len(YEARS) + 1)})
    zero = F.lit(0).cast(MONEY)
    cols = [F.col("c_custkey"), (F.col("c_acctbal") < 0).cast("int").alias("target"),
            F.col("c_nationkey").cast("long").alias("c_nationkey"), F.col("c_mktsegment"),
            F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("n_orders_total"),
            F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("n_lines_total")]
    for i in range(1, len(YEARS) + 1):
        cols.append(_status(F.coalesce(F.col(f"n_{i}"), F.lit(0))).alias(f"status_{i}"))
    for i in range(1, len(YEARS) + 1):
        cols.append(F.coalesce(F.col(f"b_{i}"), zero).cast(MONEY).alias(f"bill_{i}"))
    for i in range(1, len(YEARS) + 1):
        cols.append(F.coalesce(F.col(f"p_{i}"), zero).cast(MONEY).alias(f"pay_{i}"))
    for i in range(1, len(YEARS) + 1):
        net = F.coalesce(F.col(f"p_{i}"), zero) - F.coalesce(F.col(f"b_{i}"), zero)
        cols.append(net.cast(MONEY).alias(f"net_{i}"))
    # payments that may be missing: null or NaN, by the customer's key, in years without a shipped line
    missing = F.when(F.col("c_custkey") % 2 == 0, F.lit(float("nan")))
    for i in range(1, len(YEARS) + 1):
        cols.append(F.coalesce(F.col(f"p_{i}").cast("double"), missing).alias(f"paid_{i}"))
    return p.select(*cols)


def customer_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide panel ``P`` (cached per session and folder)."""
    return _cached(spark, sf_dir, "panel", lambda: build_customer_panel(spark, sf_dir))


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level table: lineitem + ``target`` = returned line."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.withColumn("target", (F.col("l_returnflag") == "R").cast("int"))


def lineitem_split(df: DataFrame) -> F.Column:
    """Hash group split on ``l_orderkey`` (G3 hash mode): 0-4 test, 5-8 validation, rest train."""
    b = hex_bucket(F.concat(F.lit(SPLIT_SEED + "|"), F.col("l_orderkey").cast("string")), SPLIT_BUCKETS)
    names = F.array(*[F.lit("test" if k < 5 else "validation" if k < 9 else "train") for k in range(SPLIT_BUCKETS)])
    return F.coalesce(F.get(names, b), F.lit("train"))  # a look-up: a CASE would take the md5 again for every branch


def prediction_table(spark: SparkSession, sf_dir: str, splits=("validation", "test")) -> DataFrame:
    """Long prediction table ``(model_name, split, ID, y_true, probability_default)``.

    Scores are fixed functions of lineitem columns, so every engine computes the
    same doubles: a = quantity / 50, b = extendedprice / 105000, c = discount * 10.
    """
    li = lineitem_rows(spark, sf_dir)
    base = li.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("ID"),
        lineitem_split(li).alias("split"),
        F.col("target").cast("long").alias("y_true"),
        (F.col("l_quantity") / F.lit(50.0)).alias("p_a"),
        (F.col("l_extendedprice") / F.lit(105000.0)).alias("p_b"),
        (F.col("l_discount") * F.lit(10.0)).alias("p_c"),
    ).where(F.col("split").isin(*splits))
    return base.select("split", "ID", "y_true", F.inline(F.array(
        F.struct(F.lit("model_a").alias("model_name"), F.col("p_a").alias("probability_default")),
        F.struct(F.lit("model_b").alias("model_name"), F.col("p_b").alias("probability_default")),
        F.struct(F.lit("model_c").alias("model_name"), F.col("p_c").alias("probability_default")),
    ))).select("model_name", "split", "ID", "y_true", "probability_default")


def part_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` with ID, target and three predictors that repeat across rows."""
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ID"), (F.col("p_retailprice") > 950).cast("int").alias("target"),
                    "p_brand", "p_type", "p_size")


PART_PREDICTORS = ("p_brand", "p_size", "p_type")
