"""What a task holds and what is shuffled must not follow the size of the tables."""

from __future__ import annotations

import datetime as dt
import decimal
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.functions import quantiles as QU
from panelkit.sources import testdata as TD


def _tables(spark, tmp_path):
    day = lambda y: dt.datetime(y, 5, 1)
    tables = {
        "customer": ([(1, 3, "A", -5.0), (2, None, "B", 7.5), (3, 4, None, None), (3, 4, "C", 1.0), (None, 5, "D", 2.0)],
                     "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "orders": ([(10, 1, 100.25, day(1995)), (11, 1, 50.5, day(1995)), (11, 2, 7.0, day(1996)), (12, None, 9.0, day(1997)),
                    (None, 2, 11.0, day(1998)), (13, 3, None, day(2001)), (14, 2, 3.0, day(2010)), (15, 2, 4.0, None)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
        "lineitem": ([(10, 1.25, day(1995)), (10, 2.5, day(1995)), (10, 4.0, day(1996)), (11, 8.0, day(1996)), (11, None, day(1997)), (12, 16.0, day(1997)),
                      (None, 32.0, day(1998)), (13, 64.0, day(2001)), (13, 5.0, day(2010)), (99, 1.0, day(1999))],
                     "l_orderkey long, l_extendedprice double, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_panel_rows_with_missing_and_repeated_keys(spark, tmp_path):
    rows = TD.build_customer_panel(spark, _tables(spark, tmp_path)).collect()
    assert len(rows) == 5
    one = next(r for r in rows if r.c_custkey == 1)
    assert (one.n_orders_total, one.n_lines_total, float(one.bill_1), float(one.pay_1), float(one.pay_2), one.status_1) == (2, 5, 150.75, 3.75, 12.0, 0)
    assert one.paid_3 is None and one.target == 1  # a line without a price is a line, not a payment
    two = next(r for r in rows if r.c_custkey == 2)
    assert (two.n_orders_total, two.n_lines_total, float(two.bill_2), float(two.bill_4), float(two.pay_2), two.status_3) == (4, 2, 7.0, 11.0, 8.0, -2)
    three = [r for r in rows if r.c_custkey == 3]
    assert [(r.n_orders_total, r.n_lines_total, float(r.bill_7), float(r.pay_7), r.status_7) for r in three] == [(1, 2, 0.0, 64.0, -1)] * 2
    assert [r.n_orders_total for r in rows if r.c_custkey is None] == [0]


def test_panel_amounts_are_exact(spark, tmp_path):
    """Sums to the cent, beyond what a double holds."""
    day = dt.datetime(1995, 5, 1)
    large, small = 45_000_000_000_000.03, 0.005
    spark.createDataFrame([(1, 1, "A", 1.0)], "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(k, 1, x, day) for k, x in enumerate([large, -small, None, 0.29])], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(k % 4, large if k < 150 else 0.29, day) for k in range(151)], "l_orderkey long, l_extendedprice double, l_shipdate timestamp") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    panel = TD.build_customer_panel(spark, str(tmp_path))
    row, of = panel.first(), decimal.Decimal
    assert {panel.schema[c].dataType.simpleString() for c in ("bill_1", "pay_1", "net_1")} == {"decimal(18,2)"}
    assert (row.bill_1, row.pay_1, row.bill_2) == (of("45000000000000.31"), of("6750000000000004.79"), of("0.00"))
    assert (row.net_1, row.paid_1) == (row.pay_1 - row.bill_1, float(of("6750000000000004.79")))


def test_panel_tasks_keep_their_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TD, "ROWS_PER_TASK", 40)
    n = 1000
    spark.range(n).selectExpr("id as c_custkey", "1 as c_nationkey", "'A' as c_mktsegment", "1.0D as c_acctbal").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(n).selectExpr("id as o_orderkey", "id as o_custkey", "1.0D as o_totalprice", "timestamp'1995-02-01' as o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(n).selectExpr("id as l_orderkey", "1.0D as l_extendedprice", "timestamp'1995-02-01' as l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    sizes = TD.build_customer_panel(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 30 and max(r["count"] for r in sizes) < 80


def test_small_panel_has_few_partitions(spark, tmp_path):
    """A boosted tree runs some jobs over all partitions of its rows, so 200 of them for a few rows cost minutes."""
    at = _tables(spark, tmp_path)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        panel = TD.customer_panel(spark, at)
        assert panel.count() == 5 and panel.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_anchor_search_counts_an_interval_once(spark):
    from panelkit.operators.anchors import refined_quantiles
    values = [((k * 7919) % 100_003) / 100 for k in range(2_000)]
    panel = spark.createDataFrame([(v,) for v in values], "x double")
    asked, real = [], spark.sql

    class Session:
        def sql(self, text, **kw):
            asked.append(text.count("CASE WHEN"))
            return real(text, panel=panel)

    class Panel:
        sparkSession = Session()

    got = refined_quantiles(Panel(), {"q1": ("x", 0.25), "median": ("x", 0.5), "q3": ("x", 0.75)})
    assert asked[1] == 1  # six ranks in one interval
    assert [got[n] for n in ("q1", "median", "q3")] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]).tolist())


def test_anchors_leave_the_cache(spark):
    """A view of a cached frame takes its cache away when it goes: every scan after that would build the panel anew."""
    from panelkit.operators import anchors as AN
    from panelkit.spec import PanelSpec
    panel = spark.range(200).selectExpr("id AS ID", "0 AS target", "CAST(id / 4 AS DECIMAL(18,2)) AS a", "CAST(id % 7 AS DECIMAL(18,2)) AS b").cache()
    built = lambda df: "InMemoryTableScan" not in df._jdf.queryExecution().executedPlan().toString()
    assert not built(panel.select("a"))
    values = {r.anchor_name: r.value for r in AN.direct_amounts(panel, PanelSpec("ID", "target", ("p1", "p2"), {"pay": ("a", "b")}), "pay").collect()}
    assert not built(panel.select("a"))
    panel.unpersist()
    a, b = np.arange(200) / 4, np.arange(200) % 7
    assert values["p1_p25"] == pytest.approx(np.quantile(a, 0.25)) and values["last_median_change"] == pytest.approx(np.quantile(b - a, 0.5))
    assert [values["global_low_percentile"], values["global_high_percentile"]] == pytest.approx(np.quantile(np.concatenate((a, b)), [0.01, 0.99]).tolist())


def test_anchor_search_over_several_columns(spark):
    from panelkit.operators.anchors import refined_quantiles
    rows = [(k * 7919 % 1009 - 500, None if k % 3 else k, None) for k in range(300)]
    panel = spark.createDataFrame(rows, "x long, y long, z long")
    got = refined_quantiles(panel, {"both": (("x", "y", "z"), 0.3), "x": ("x", 0.5), "none": (("z",), 0.5)}, cells=16, whole=True)
    both = [v for r in rows for v in r if v is not None]
    assert got == {"both": pytest.approx(np.quantile(both, 0.3) / 100), "x": pytest.approx(np.quantile([r[0] for r in rows], 0.5) / 100), "none": None}


@pytest.fixture
def distributed(spark, monkeypatch):
    spark.conf.set("panelkit.prefix.inMemoryLimit", "0")
    monkeypatch.setattr(QU, "FEW_VALUES", 50)
    yield
    spark.conf.unset("panelkit.prefix.inMemoryLimit")


PROBS = {"p01": 0.01, "q1": 0.25, "median": 0.5, "p99": 0.99}


def _values(spark):
    rng = random.Random(3)
    rows = [("a", rng.gauss(0, 100)) for _ in range(30_000)] + [("b", float(rng.randrange(3))) for _ in range(9_000)]
    rows += [("c", float(v)) for v in range(7)] + [("d", float("nan")), ("d", None), ("b", -0.0), (None, 5.0), ("a", float("nan")), ("a", None)]
    return rows, spark.createDataFrame(rows, "k string, v double").repartition(5)


def _expected(rows):
    found = {}
    for k, v in rows:
        if k is not None and v is not None and v == v:
            found.setdefault(k, []).append(v)
    return {k: {n: float(np.quantile(v, p)) for n, p in PROBS.items()} for k, v in found.items()}


def _seen(monkeypatch):
    sizes, real = [], QU.ordered_prefix
    monkeypatch.setattr(QU, "ordered_prefix", lambda df, *a, **b: (sizes.append(df.count()), real(df, *a, **b))[1])
    return sizes


def _same(got, want):
    assert set(got) == set(want)
    for k, row in want.items():
        assert [got[k][n] for n in PROBS] == pytest.approx([row[n] for n in PROBS], rel=1e-12, abs=1e-12)


def test_quantiles_sort_values_near_the_ranks_only(spark, distributed, monkeypatch):
    rows, df = _values(spark)
    sizes = _seen(monkeypatch)
    _same({r["k"]: r for r in QU.group_quantiles(df, ["k"], "v", PROBS).collect()}, _expected(rows))
    assert len(sizes) == 1 and sizes[0] < 1_500


def test_quantiles_count_all_values_if_a_rank_is_missed(spark, distributed, monkeypatch):
    rows, df = _values(spark)
    monkeypatch.setattr(QU, "MARGIN", -0.002)  # the stretches miss the ranks
    sizes = _seen(monkeypatch)
    _same({r["k"]: r for r in QU.group_quantiles(df, ["k"], "v", PROBS).collect()}, _expected(rows))
    assert len(sizes) == 2 and sizes[1] > 30_000


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_equal_tables_are_digested_once_and_not_read_again(spark, tmp_path):
    from panelkit.operators import reconcile as R
    spark.range(200).select("id", (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "t"))
    left, right = (spark.read.parquet(str(tmp_path / "t")) for _ in range(2))
    d = R.difference(left, right, ["id"])
    assert "parquet" not in _plan(d) and d.collect() == []
    moved = right.withColumn("v", F.when(F.col("id") == 7, F.col("v") + 1).otherwise(F.col("v")))
    assert [tuple(r) for r in R.difference(left, moved, ["id"]).collect()] == [(7, "value", "v", "14", "15")]


def test_split_filter_takes_one_md5_a_row(spark):
    from panelkit.functions.exprs import hex_bucket
    from panelkit.sources.testdata import SPLIT_BUCKETS, SPLIT_SEED, lineitem_split
    df = spark.createDataFrame([(k,) for k in range(300)] + [(None,)], "l_orderkey long")
    assert _plan(df.where(lineitem_split(df) == "test")).count("md5(") == 1
    b = hex_bucket(F.concat(F.lit(SPLIT_SEED + "|"), F.col("l_orderkey").cast("string")), SPLIT_BUCKETS)
    case = F.when(b < 5, "test").when(b < 9, "validation").otherwise("train")
    assert df.where(~lineitem_split(df).eqNullSafe(case)).count() == 0 and df.select(lineitem_split(df).alias("s")).distinct().count() == 3


def test_final_checks_group_the_stored_predictions_by_id_once(spark):
    from panelkit.operators import hashtree as H
    from panelkit.operators import suites_models as CM
    p = spark.createDataFrame([(m, f"id{k}", k % 2, 0.3, 0, 1) for m in "abc" for k in range(40)],
                              "model_name string, ID string, y_true int, probability_default double, prediction_at_0_5 int, prediction_at_selected_threshold int")
    one = p.where("model_name = 'a'")
    roots = H.root(H.hash_tree(one, ["ID"])), H.root(H.hash_tree(one, ["ID"], ["y_true"]))
    checks = CM.final_checks(p, p, 3, 40, *roots)
    assert checks._jdf.queryExecution().withCachedData().toString().count("InMemoryRelation [ID") >= 1
    assert {r["check_name"] for r in checks.where("NOT passed").collect()} == set()


def test_only_strings_that_may_share_a_window_are_merged():
    from panelkit.llm import bwt_dedup as B
    r = random.Random(5)
    text = lambda n: bytes(r.randrange(97, 123) for _ in range(n))
    common = text(50)
    strings = [text(20) + common + b"#" * 9, common + b"." * 30, *(text(70) for _ in range(20)), common]
    assert np.flatnonzero(B.sharing(strings, 50)).tolist() == [0, 1, 22]
    out = B.resolver(50)(np.ones(len(strings), np.int64), strings, np.arange(len(strings)), np.zeros(len(strings), np.int64), np.array([1] * 5 + [2] + [1] * 17))
    assert [(k, x["first"], x["last"], x["id"]) for k, v in enumerate(out) for x in v] == [(1, 0, 0, 0), (5, 0, 20, 5), (22, 0, 0, 0)]


def test_shuffle_files_go_once_the_answers_are_stored(spark):
    from pathlib import Path

    from panelkit.llm import substrings as S
    from panelkit.llm.bwt_dedup import resolver
    files = lambda: {f for f in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data")}
    old = files()
    docs = spark.range(60).selectExpr("id as doc_id", "concat(repeat(cast(id % 7 as string), 60), ' ', sha2(cast(id as string), 256)) as text")
    found = S.spans(S.source(docs, "doc_id", "text"), S.byte_units, 50, 16, resolver(50), "first_id < id")
    for _ in range(40):
        if not files() - old:
            break
        time.sleep(0.25)
    assert not files() - old and found.count() == 53


def test_scan_in_blocks_gives_the_same_runs_and_digests(monkeypatch):
    import pyarrow as pa

    from panelkit.llm import substrings as S
    r = random.Random(9)
    for n in (0, 49, 50, 51, 3000):
        units = S.byte_units(pa.array(["".join(r.choice("abc") for _ in range(k)) for k in (n, n // 2, n)]))
        found = []
        for size in (7, 64, 1 << 20):
            monkeypatch.setattr(S, "SCAN_UNITS", size)
            first, last, hashes, place = S.runs(units, 50, 16)
            found.append([first, last, hashes, place, S.digests(units, first, last + 50)])
        assert all(np.array_equal(x, y) for other in found[1:] for x, y in zip(found[0], other))
        grams = S.gram_hashes(units.hashes, 16)  # the minimiser of each run's first window, found plainly
        assert [int(np.argmin(grams[a:a + 35] >> np.uint64(32))) + a for a in found[0][0].tolist()] == found[0][3].tolist()
