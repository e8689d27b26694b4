"""Raw files with title rows, category dictionaries, ordered neighbours, curves and hash trees."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.ordered import ordered_prefix
from panelkit.operators import categories as CAT
from panelkit.operators import evaluate as E
from panelkit.operators import features as FT
from panelkit.operators import hashtree as H
from panelkit.sources import tables as A


@pytest.fixture(params=["windows", "ranges"])
def mode(spark, request):
    """Both sides of the size threshold of ordered prefixes."""
    if request.param == "ranges":
        spark.conf.set("panelkit.prefix.inMemoryLimit", "0")
        spark.conf.set("panelkit.broadcast.maxRows", "0")
    yield request.param
    spark.conf.unset("panelkit.prefix.inMemoryLimit")
    spark.conf.unset("panelkit.broadcast.maxRows")


@pytest.mark.parametrize("title", ["Export of clients", "a,b", "a,b,c,d,e,f", '"quoted, title",x', ""])
@pytest.mark.parametrize("schema", [None, "target int, ID long"])
@pytest.mark.parametrize("each", [False, True])
def test_titles_of_any_width(spark, tmp_path, title, schema, each):
    for k, rows in enumerate((["1,500,0", "2,,1"], ['3,"7,5",0', "", "4,9,x,surplus", "5,8"], [])):
        (tmp_path / f"part{k}.csv").write_text("\n".join([title or " ", "ID,LIMIT,target", *rows]) + "\n")
    kinds = T._parse_datatype_string(schema) if schema else None
    df = A.load_titled_csv(spark, str(tmp_path), kinds, each_header=each)
    if schema is None:
        assert df.columns == ["ID", "LIMIT", "target"]
        assert sorted(tuple(r) for r in df.collect()) == [("1", "500", "0"), ("2", None, "1"), ("3", "7,5", "0"), ("4", "9", "x"), ("5", "8", None)]
    else:
        assert df.dtypes == [("target", "int"), ("ID", "bigint")]
        assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, [(0, 1), (1, 2), (0, 3), (None, 4), (None, 5)]))


def test_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title\nID,x\n1,5\nID,y\n")
    (tmp_path / "b.csv").write_text("another,title\ny,ID\n7,2\n")
    df = A.load_titled_csv(spark, str(tmp_path), each_header=True)
    assert sorted(map(str, df.select("ID", "x", "y").collect())) == sorted(map(str, [T.Row(ID="1", x="5", y=None), T.Row(ID="ID", x="y", y=None), T.Row(ID="2", x=None, y="7")]))


def test_raw_files_that_cannot_be_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        A.load_titled_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "bare.csv").write_text("only a title\n")
    with pytest.raises(ValueError, match="no header"):
        A.load_titled_csv(spark, str(tmp_path / "bare.csv"))
    (tmp_path / "short.csv").write_text("t\nID\n1\n")
    with pytest.raises(ValueError, match="LIMIT"):
        A.load_titled_csv(spark, str(tmp_path / "short.csv"), T._parse_datatype_string("LIMIT int"))
    with pytest.raises(ValueError):
        A.load_raw(spark, str(tmp_path / "short.csv"), fmt="csv", junk_header_rows=2)


def test_header_names():
    assert A._header_names('ID,,"a, b",ID,ID', ",") == ["ID", "_c1", "a, b", "ID.1", "ID.2"]


def test_large_file_in_many_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("t,i,t,l,e\nID,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = A.load_titled_csv(spark, str(tmp_path / "big.csv"), T._parse_datatype_string("ID int, v string"))
        assert df.rdd.getNumPartitions() > 5 if hasattr(df, "rdd") else True
        row = df.agg(F.count("ID"), F.sum("ID"), F.count(F.lit(1))).first()
        assert tuple(row) == (20_000, 20_000 * 19_999 // 2, 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_neighbours_and_sums_are_the_same_on_both_sides(spark, mode):
    rng = random.Random(3)
    rows = [(k, v, rng.randrange(9)) for k in ("hot", "b", None) for v in rng.sample(range(5000), 900 if k == "hot" else 40)]
    df = spark.createDataFrame(rows, "k string, v int, n int").repartition(5)
    got = {(r.k, r.v): r for r in ordered_prefix(df, ["k"], "v", ["n"], num_partitions=13, neighbours=["v", "n"]).collect()}
    assert len(got) == len(rows)
    for key in ("hot", "b", None):
        own = sorted((v, n) for k, v, n in rows if k == key)
        total = 0
        for i, (v, n) in enumerate(own):
            r = got[key, v]
            assert r.n_before == total
            assert (tuple(r._prev) if r._prev else None) == (own[i - 1] if i else None)
            assert (tuple(r._next) if r._next else None) == (own[i + 1] if i + 1 < len(own) else None)
            total += n


def single_machine_curves(y, s):
    """(roc, pr) points by cumulative sums over falling scores."""
    order = np.argsort(-s, kind="stable")
    y, s = y[order], s[order]
    last = np.append(np.flatnonzero(np.diff(s)), len(s) - 1)
    tp, fp = np.cumsum(y)[last], np.cumsum(1 - y)[last]
    keep = np.ones(len(last), bool)
    if len(last) > 2:
        keep[1:-1] = (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0)
    P, N = tp[-1], fp[-1]
    rate = lambda a, b: float(a) / float(b) if b else None
    roc = [(float("inf"), 0, 0, rate(0, N), rate(0, P))] + [(s[last[i]], fp[i], tp[i], rate(fp[i], N), rate(tp[i], P)) for i in np.flatnonzero(keep)]
    pr = [(None, 1.0, 0.0)] + [(s[last[i]], tp[i] / (tp[i] + fp[i]), tp[i] / P if P else 1.0) for i in range(len(last))]
    return roc, pr


def test_curves_equal_a_single_machine(spark, mode):
    rng = np.random.default_rng(1)
    models = {"a": (rng.integers(0, 2, 700), rng.integers(0, 90, 700) / 90), "b": (np.zeros(5, int), np.arange(5) / 5), "c": (np.ones(4, int), np.arange(4) / 4),
              "d": (np.array([1, 0] * 30), np.repeat(np.arange(30) / 30, 2)), "e": (np.array([1]), np.array([0.3]))}
    rows = [(m, f"{m}{i}", int(y), float(s)) for m, (ys, ss) in models.items() for i, (y, s) in enumerate(zip(ys, ss))]
    preds = spark.createDataFrame(rows, "model_name string, ID string, y_true long, probability_default double").repartition(7)
    roc, pr = E.roc_curve(preds).collect(), E.pr_curve(preds).collect()
    for m, (ys, ss) in models.items():
        want_roc, want_pr = single_machine_curves(ys, ss)
        assert sorted(repr((r.threshold, r.fp, r.tp, r.fpr, r.tpr)) for r in roc if r.model_name == m) == sorted(repr((float(t), int(a), int(b), c, d)) for t, a, b, c, d in want_roc)
        got = {r.threshold: (r.precision, r.recall) for r in pr if r.model_name == m}
        assert got == {None if t is None else float(t): (float(p), float(q)) for t, p, q in want_pr}
    assert len([r for r in roc if r.model_name == "d"]) == 3  # the ends of one straight line, and (0, 0)


def test_dictionary_of_200000_categories(spark, mode):
    """More categories than any driver-side list is meant for; only two widths are collected."""
    n = 200_000
    train = spark.range(n).select((F.col("id") * 7 % n).alias("key"), (F.col("id") % 3).cast("string").alias("kind"))
    d = CAT.fit_dictionary(train, ["key", "kind"])
    assert d.widths == {"key": n, "kind": 3} and d.width == n + 3
    rows = spark.createDataFrame([(1, 0, "0"), (2, n - 1, "2"), (3, 10, None), (4, -5, "9"), (5, 9, "1")], "id long, key long, kind string")
    got = {r.id: r.indices for r in CAT.one_hot_indices(rows, ["id"], d).collect()}
    assert got == {1: [0, n], 2: [n - 1, n + 2], 3: [10], 4: [], 5: [9, n + 1]}


def test_sparse_vectors_equal_dense_ones(spark):
    df = spark.createDataFrame([(i, float(i * i % 7), ["x", "y", None, "zz"][i % 4], [3, 20, 100][i % 3]) for i in range(24)], "id long, v double, a string, b int")
    train = df.where("id < 18")
    params, d = FT.fit_robust(train, ["v"]), CAT.fit_dictionary(train, ["a", "b"])
    cats = FT.fit_one_hot(train, ["a", "b"])
    want = {r.id: list(r.t) for r in df.select("id", FT.tabular_representation(["v"], params, cats).alias("t")).collect()}
    sparse = CAT.sparse_representation(df, ["id"], ["v"], params, d)
    got = {r.id: list(r.t) for r in sparse.select("id", CAT.dense(1 + d.width, F.col("indices"), F.col("values")).alias("t")).collect()}
    assert got == want and {r.size for r in sparse.collect()} == {1 + d.width}
    names = [r.output_feature_name for r in CAT.dictionary_lineage(d, ["v"], "t").orderBy("output_index").collect()]
    assert names == ["v"] + FT.one_hot_names(cats)


def test_dictionary_survives_storage(spark, tmp_path):
    d = CAT.fit_dictionary(spark.createDataFrame([("b",), ("a",), (None,)], "c string"), ["c"])
    CAT.save_dictionary(d, str(tmp_path / "d"))
    again = CAT.load_dictionary(spark, str(tmp_path / "d"), ["c"])
    assert again.widths == {"c": 2} and sorted(again.table.collect()) == sorted(d.table.collect())


def test_hash_tree_does_not_depend_on_partitions(spark, mode):
    rows = [(i * 3 % 1000, i % 5) for i in range(1000)] + [(4, 2), (4, 2), (None, 1)]
    df = spark.createDataFrame(rows, "id long, y int")
    trees = [sorted(map(str, H.hash_tree(df.repartition(p), ["id"], ["y"], 16).collect())) for p in (1, 7, 200)]
    assert trees[0] == trees[1] == trees[2]
    assert H.root(H.hash_tree(df, ["id"], ["y"], 16)) is not None
    assert H.hash_tree(df.limit(0), ["id"], ["y"], 16).collect() == [] and H.root(H.hash_tree(df.limit(0), ["id"])) is None


def test_hash_tree_shows_where_populations_differ(spark):
    a = spark.range(1000).withColumn("y", F.lit(0))
    b = a.withColumn("y", F.when(F.col("id") == 500, 1).otherwise(0))
    one, two = H.hash_tree(a, ["id"], ["y"], 10), H.hash_tree(b, ["id"], ["y"], 10)
    assert H.root(one) != H.root(two)
    assert [r.node for r in H.differing_leaves(one, two).collect()] == [50]
    assert H.differing_leaves(one, H.hash_tree(a.repartition(9), ["id"], ["y"], 10)).collect() == []
