"""Table differences, anchors, publication, model suites, pipeline stages, the two-block network and sketches."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from panelkit.operators import anchors as AN
from panelkit.operators import categories as CAT
from panelkit.operators import evaluate as E
from panelkit.operators import features as FT
from panelkit.operators import hashtree as H
from panelkit.operators import models as L
from panelkit.operators import network as NET
from panelkit.operators import prepare as PREP
from panelkit.operators import publish as PUB
from panelkit.operators import reconcile as R
from panelkit.operators import sketches as SK
from panelkit.operators import suites_models as CM
from panelkit.operators.checks import ChecksFailed, Rule, run_checks
from panelkit.session import release_intermediates, stored
from panelkit.spec import PAYMENT_POLICY, PanelSpec

# --- E15: differences of two tables ------------------------------------------


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_planted_differences_are_found(spark, buckets):
    nan, inf = float("nan"), float("inf")
    left = [(1, "a", 1.0, 5), (2, "b", 2.0, 5), (3, None, 3.0, 5), (4, "d", None, 5), (5, "e", nan, 5), (6, "f", inf, 5), (None, "g", 7.0, 5), (8, "h", 8.0, 5), (8, "h", 8.0, 5), (9, "i", 9.0, None), (11, "k", 0.0, 5)]
    right = [(1, "a", 1.004, 5), (2, "b", 2.1, 5), (3, "c", 3.0, 5), (4, "d", 4.0, 5), (5, "e", nan, 5), (6, "f", inf, 5), (None, "g", 7.0, 6), (8, "h", 8.0, 5), (9, None, 9.0, 5), (10, "j", 1.0, 5), (11, "k", -0.0, 5)]
    a, b = (spark.createDataFrame(x, "id long, s string, v double, n int").repartition(3) for x in (left, right))
    got = sorted(map(repr, (tuple(r) for r in R.difference(a, b, ["id"], tolerance={"v": 0.005}, buckets=buckets).collect())))
    want = [(2, "value", "v", "2.0", "2.1"), (3, "value", "s", None, "c"), (4, "value", "v", None, "4.0"), (None, "value", "n", "5", "6"), (8, "duplicate_key", None, "2", "1"),
            (9, "value", "s", "i", None), (9, "value", "n", None, "5"), (10, "right_only", None, None, None)]
    assert got == sorted(map(repr, want))
    s = R.summary(a, b, ["id"], tolerance=0.005, buckets=buckets).first()
    assert tuple(s) == (11, 11, 0, 1, 1, 6 - 0) or (s.left_rows, s.right_rows, s.right_only, s.duplicate_key) == (11, 11, 1, 1)


def test_equal_tables_join_nothing(spark):
    a = spark.range(5000).select("id", (F.col("id") * 0.5).alias("v"))
    assert R.differing_buckets(a, a.repartition(7), ["id"], ["v"]).count() == 0
    assert R.difference(a, a.repartition(7), ["id"]).collect() == []
    assert R.differing_buckets(a, a.where("id <> 77"), ["id"], ["v"]).count() == 1
    assert [tuple(r)[:2] for r in R.difference(a, a.where("id <> 77"), ["id"]).collect()] == [(77, "left_only")]
    assert R.difference(a.limit(0), a.limit(0), ["id"]).collect() == []


def test_nulls_are_told_from_values_and_places(spark):
    a = spark.createDataFrame([(1, "x", None)], "id int, p string, q string")
    b = spark.createDataFrame([(1, None, "x")], "id int, p string, q string")
    assert sorted(r.column for r in R.difference(a, b, ["id"]).collect()) == ["p", "q"]


# --- C6: anchors --------------------------------------------------------------

SPEC = PanelSpec("ID", "target", ("p1", "p2", "p3"), {"pay": ("a", "b", "c")})


def panel(spark, n=400):
    random = np.random.default_rng(5)
    rows = [(i, int(random.integers(2)), *(round(float(x), 2) for x in random.normal(10, 30, 3) * (random.random(3) > 0.2))) for i in range(n)]
    return spark.createDataFrame(rows, "ID int, target int, a double, b double, c double").select("ID", "target", *[F.col(c).cast("decimal(18,2)").alias(c) for c in "abc"])


def test_anchors_agree_on_both_ways(spark):
    p = panel(spark)
    direct, pipeline = AN.direct_amounts(p, SPEC, "pay"), AN.pipeline_amounts(p, SPEC, "pay", PAYMENT_POLICY)
    out = AN.compare(direct, direct, pipeline).collect()
    assert len(out) == 31 + 0 or len(out) > 25
    assert all(r.passed for r in out), [r for r in out if not r.passed]
    x = np.array([float(r.a) for r in p.select("a").collect()])
    values = {r.anchor_name: r.direct_value for r in out}
    assert abs(values["p1_p25"] - np.percentile(x, 25)) < 1e-9 and values["p1_zero_count"] == (x == 0).sum()


def test_an_anchor_that_is_off_fails(spark):
    kinds = "anchor_name string, value double"
    expected = [("a_count", 10.0), ("mean", 5.0), ("gone", None), ("nothing", 1.0), ("late", None)]
    direct = [("a_count", 10.0), ("mean", 5.00001), ("gone", None), ("late", None)]
    pipeline = [("a_count", 10.000001), ("mean", 5.1), ("gone", float("nan")), ("nothing", 1.0), ("late", 2.0), ("unasked", 3.0)]
    out = {r.anchor_name: r for r in AN.compare(*(spark.createDataFrame(x, kinds) for x in (expected, direct, pipeline))).collect()}
    assert {k: (r.direct_matches_expected, r.pipeline_matches_expected, r.passed) for k, r in out.items()} == {
        "a_count": (True, False, False), "mean": (True, False, False), "gone": (True, True, True), "nothing": (False, True, False), "late": (True, False, False),
        "unasked": (False, False, False)}


@pytest.mark.parametrize("cells", [2, 5, 4096])
def test_refined_quantiles(spark, cells):
    p = panel(spark, 301).withColumn("none", F.lit(None).cast("decimal(18,2)"))
    got = AN.refined_quantiles(p, {"q": ("a", 0.25), "m": ("b - a", 0.5), "z": ("c", 1.0), "y": ("c", 0.0), "none": ("none", 0.5)}, cells=cells)
    v = np.array([[float(x) for x in r] for r in p.select("a", "b", "c").collect()])
    want = {"q": np.percentile(v[:, 0], 25), "m": np.percentile(v[:, 1] - v[:, 0], 50), "z": v[:, 2].max(), "y": v[:, 2].min()}
    assert got.pop("none") is None and all(abs(got[k] - want[k]) < 1e-9 for k in want)


# --- G5 / G9: publish, reuse or refuse ---------------------------------------


def manifest(spark):
    return spark.createDataFrame([(i, "train" if i % 2 else "test") for i in range(50)], "ID int, split string")


def fifty(df):
    return run_checks(df, [Rule("rows", F.count(F.lit(1)) == 50, F.lit(""))])


def test_published_once_then_reused(spark, tmp_path):
    path, built = str(tmp_path / "m"), []
    build = lambda: built.append(1) or manifest(spark)
    first, again = PUB.reuse_or_create(spark, path, "f1", build, fifty), PUB.reuse_or_create(spark, path, "f1", build, fifty)
    assert (first[1], again[1], len(built)) == (False, True, 1)
    assert sorted(again[0].collect()) == sorted(manifest(spark).collect())
    assert not [x for x in tmp_path.iterdir() if "staging" in x.name]


def test_other_inputs_are_refused(spark, tmp_path):
    PUB.publish(manifest(spark), str(tmp_path / "m"), "f1")
    with pytest.raises(PUB.OtherResult, match="other inputs"):
        PUB.reuse_or_create(spark, str(tmp_path / "m"), "f2", lambda: manifest(spark))
    with pytest.raises(PUB.OtherResult, match="already"):
        PUB.publish(manifest(spark), str(tmp_path / "m"), "f1")


def test_rows_without_a_marker_are_partial(spark, tmp_path):
    manifest(spark).write.parquet(str(tmp_path / "m" / PUB.DATA))
    for call in (lambda: PUB.read_published(spark, str(tmp_path / "m")), lambda: PUB.reuse_or_create(spark, str(tmp_path / "m"), "f1", lambda: manifest(spark))):
        with pytest.raises(PUB.PartialState, match="nothing was published"):
            call()


def test_a_marker_without_rows_or_cut_short_is_partial(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / PUB.MARKER).write_text('{"fingerprint": "f1", "digest": {}}')
    with pytest.raises(PUB.PartialState, match="no rows"):
        PUB.read_published(spark, str(tmp_path / "m"), "f1")
    (tmp_path / "k").mkdir()
    (tmp_path / "k" / PUB.MARKER).write_text('{"fingerprint": ')
    with pytest.raises(PUB.PartialState, match="not whole"):
        PUB.read_published(spark, str(tmp_path / "k"))


def test_rows_changed_after_publication_are_refused(spark, tmp_path):
    path = str(tmp_path / "m")
    PUB.publish(manifest(spark), path, "f1")
    manifest(spark).limit(1).write.mode("append").parquet(f"{path}/{PUB.DATA}")
    with pytest.raises(PUB.OtherResult, match="not those"):
        PUB.read_published(spark, path, "f1")


def test_failed_checks_publish_nothing(spark, tmp_path):
    path = str(tmp_path / "m")
    with pytest.raises(ChecksFailed):
        PUB.publish(manifest(spark).limit(49), path, "f1", fifty)
    with pytest.raises(FileNotFoundError):
        PUB.read_published(spark, path)
    assert [x for x in tmp_path.iterdir() if "staging" in x.name] == []
    assert PUB.reuse_or_create(spark, path, "f1", lambda: manifest(spark), fifty)[1] is False


# --- C8, C9, C10 --------------------------------------------------------------

FAMILIES = {"m1": "baseline", "m2": "baseline", "m3": "cnn"}


def predictions(spark):
    random = np.random.default_rng(2)
    y = random.integers(0, 2, 60)
    rows = [(m, f"id{i}", int(y[i]), float(np.clip(y[i] * 0.3 + random.random() * 0.7, 0, 1)), 0.4) for m in FAMILIES for i in range(60)]
    df = spark.createDataFrame(rows, "model_name string, ID string, y_true long, probability_default double, selected_threshold double")
    return df.withColumn("prediction_at_0_5", E.predict("probability_default", 0.5)).withColumn(
        "prediction_at_selected_threshold", E.predict("probability_default", F.col("selected_threshold")))


def failed(checks):
    rows = checks.collect()
    assert len({r.check_name for r in rows}) == len(rows)
    return {r.check_name for r in rows if not r.passed}


def first_row(value, column, where="ID = 'id3' AND model_name = 'm1'"):
    return lambda p: p.withColumn(column, F.when(F.expr(where), F.lit(value)).otherwise(F.col(column)))


BREAKS = {
    "model_count": lambda p: p.where("model_name <> 'm3'"), "predictions_per_model": lambda p: p.where("NOT (ID = 'id3' AND model_name = 'm1')"),
    "probabilities_valid": first_row(1.5, "probability_default"), "predictions_binary": first_row(2, "prediction_at_0_5")}


@pytest.mark.parametrize("rule", [None, "one_candidate_per_family", "metrics_recomputed", *BREAKS])
def test_experiment_rules(spark, rule):
    p = predictions(spark)
    results = E.threshold_metrics(p).select("model_name", "default_f1")
    candidates = spark.createDataFrame([("m1", "baseline"), ("m3", "cnn")], "model_name string, family string")
    if rule == "one_candidate_per_family":
        candidates = candidates.union(spark.createDataFrame([("m2", "baseline")], candidates.schema))
    if rule == "metrics_recomputed":
        results = results.withColumn("default_f1", F.col("default_f1") + F.when(F.col("model_name") == "m2", 0.01).otherwise(0.0))
    found = failed(CM.experiment_checks(results, BREAKS.get(rule, lambda x: x)(p), FAMILIES, candidates, 60))
    assert found == set() if rule is None else rule in found


@pytest.mark.parametrize("rule", [None, "test_isolated", "total_rows", "two_results_per_model", "confusion_counts_add_up", "model_count", "predictions_per_model", "probabilities_valid"])
def test_evaluation_rules(spark, rule):
    p = predictions(spark)
    selected = spark.createDataFrame([(m, 0.4) for m in FAMILIES], "model_name string, threshold double")
    results = E.final_metrics(p, selected)
    if rule == "two_results_per_model":
        results = results.where("threshold_mode = '0.5'")
    if rule == "confusion_counts_add_up":
        results = results.withColumn("tn", F.col("tn") + 1)
    breaks = {**BREAKS, "total_rows": BREAKS["model_count"]}
    found = failed(CM.evaluation_checks(breaks.get(rule, lambda x: x)(p), results, 3, 60, F.lit(rule != "test_isolated")))
    assert found == set() if rule is None else rule in found


FINAL_BREAKS = {**BREAKS, "total_rows": BREAKS["model_count"], "ids_identical": first_row("other", "ID"), "targets_identical": lambda p: p.withColumn("y_true", F.when(F.expr("ID = 'id3' AND model_name = 'm1'"), 1 - F.col("y_true")).otherwise(F.col("y_true"))),
                "predictions_reconcile": lambda p: p.withColumn("prediction_at_selected_threshold", F.when(F.expr("ID = 'id3' AND model_name = 'm1'"), 1 - F.col("prediction_at_selected_threshold")).otherwise(F.col("prediction_at_selected_threshold"))),
                "id_population_known": lambda p: p.withColumn("ID", F.when(F.col("ID") == "id3", "id3x").otherwise(F.col("ID"))),
                "target_population_known": lambda p: p.withColumn("y_true", F.when(F.col("ID") == "id3", 1 - F.col("y_true")).otherwise(F.col("y_true")))}


@pytest.mark.parametrize("rule", [None, *FINAL_BREAKS])
def test_final_rules(spark, rule):
    p = predictions(spark)
    one = p.where("model_name = 'm1'")
    roots = H.root(H.hash_tree(one, ["ID"])), H.root(H.hash_tree(one, ["ID"], ["y_true"]))
    found = failed(CM.final_checks(FINAL_BREAKS.get(rule, lambda x: x)(p), p, 3, 60, *roots))
    assert found == set() if rule is None else rule in found


def test_no_rule_passes_on_nothing(spark):
    p = predictions(spark).limit(0)
    assert failed(CM.evaluation_checks(p, E.final_metrics(p, spark.createDataFrame([], "model_name string, threshold double")), 3, 60)) >= {
        "total_rows", "probabilities_valid", "model_count", "predictions_per_model", "two_results_per_model", "confusion_counts_add_up"}


# --- A7: stages ---------------------------------------------------------------

STAGE_SPEC = PanelSpec("ID", "target", ("p1", "p2"), {"status": ("s1", "s2"), "bill": ("b1", "b2"), "pay": ("c1", "c2")})


def test_stages_load_in_a_new_session(spark, tmp_path):
    random = np.random.default_rng(3)
    rows = [(i, i % 2, *(int(x) for x in random.integers(-2, 5, 2)), *(float(x) for x in random.normal(50, 20, 4)), float(random.normal()), ["x", "y", "z", None][i % 4], int(i % 7)) for i in range(80)]
    df = spark.createDataFrame(rows, "ID int, target int, s1 int, s2 int, b1 double, b2 double, c1 double, c2 double, age double, kind string, region int")
    train = df.where("ID < 60")
    fitted = Pipeline(stages=[PREP.PanelPreparer.of(STAGE_SPEC, ["age"], ["kind", "region"])]).fit(train)
    want = sorted(map(str, fitted.transform(df).collect()))
    fitted.write().overwrite().save(str(tmp_path / "stages"))
    other = spark.newSession()
    back = PipelineModel.load(str(tmp_path / "stages"))
    again = sorted(map(str, back.transform(other.createDataFrame(rows, df.schema)).collect()))
    assert again == want
    stage = back.stages[0]
    assert {r.name for r in stage.parameter_table(spark).collect()} == {"status", "bill", "pay", "age"}
    dense = {r.ID: list(r.v) for r in back.transform(df).select("ID", CAT.dense(1 + stage.dictionary.width, F.col("static_indices"), F.col("static_values")).alias("v")).collect()}
    params, cats = FT.fit_robust(train, ["age"]), FT.fit_one_hot(train, ["kind", "region"])
    assert dense == {r.ID: list(r.v) for r in df.select("ID", FT.static_representation(df, ["age"], params, cats).alias("v")).collect()}
    unfitted = PREP.PanelPreparer.of(STAGE_SPEC, ["age"], ["kind"])
    unfitted.write().overwrite().save(str(tmp_path / "estimator"))
    assert PREP.PanelPreparer.load(str(tmp_path / "estimator")).wanted() == unfitted.wanted()


# --- L3: the network ----------------------------------------------------------

SHAPE = NET.Shape(4, 2, 3, filters=5, static_units=4, joint_units=6)


def data(n, seed):
    random = np.random.default_rng(seed)
    t, s = random.normal(size=(n, 4, 2)), random.normal(size=(n, 3))
    y = (t[:, :, 0].max(axis=1) + s[:, 1] + random.normal(size=n) * 0.3 > 1).astype(float)
    return t, s, y


def frame(spark, t, s, y, w):
    rows = [(i, [[float(x) for x in p] for p in a], [float(x) for x in b], int(c), float(d)) for i, (a, b, c, d) in enumerate(zip(t, s, y, w))]
    return spark.createDataFrame(rows, "id int, temporal array<array<double>>, static array<double>, label int, weight double")


def test_gradients_equal_finite_differences():
    t, s, y = data(40, 1)
    w = np.random.default_rng(0).random(40)
    flat = NET.initial(SHAPE, 3)
    gradient, loss = NET.gradient_sums(SHAPE, flat, t, s, y, w)
    assert len(gradient) == SHAPE.n_parameters
    for k in np.random.default_rng(1).choice(len(flat), 40, replace=False):
        step = np.zeros(len(flat))
        step[k] = 1e-6
        high, low = (NET.gradient_sums(SHAPE, flat + d, t, s, y, w)[1] for d in (step, -step))
        assert abs((high - low) / 2e-6 - gradient[k]) < 1e-4 * max(1, abs(gradient[k]))


def test_weights_count_like_repeated_rows(spark):
    t, s, y = data(120, 2)
    w = np.random.default_rng(4).integers(1, 4, 120)
    again = np.repeat(np.arange(120), w)
    weighted = NET.fit(frame(spark, t, s, y, w).repartition(3), None, SHAPE, epochs=6)
    repeated = NET.fit(frame(spark, t[again], s[again], y[again], np.ones(len(again))).repartition(5), None, SHAPE, epochs=6)
    plain = NET.fit(frame(spark, t, s, y, np.ones(120)), None, SHAPE, epochs=6)
    assert np.abs(weighted.parameters - repeated.parameters).max() < 1e-8
    assert np.abs(weighted.parameters - plain.parameters).max() > 1e-4


def test_network_learns_from_both_blocks(spark):
    train, held = data(600, 5), data(300, 6)
    val = frame(spark, *held, np.ones(300))
    model = NET.fit(frame(spark, *train, np.ones(600)), val, NET.Shape(4, 2, 3, 16, 8, 16), epochs=60, rate=0.03)
    rows = model.score(val, "id").collect()
    assert len(rows) == 300 and np.mean([(r.probability_default >= 0.5) == r.y_true for r in rows]) > 0.85
    assert all(r.prediction_at_0_5 == int(r.probability_default >= 0.5) for r in rows)
    again = NET.Network.from_json(model.to_json())
    assert (again.parameters == model.parameters).all() and again.history == model.history
    stop = L.early_stop(model.history_frame(spark)).first()
    assert stop.best_epoch == min(h for h in range(len(model.history)) if abs(model.history[h][2] - stop.best_validation_loss) < 1e-12)
    blind = np.zeros_like(held[1])
    flat = NET.log_odds(model.shape, model.parameters, held[0], blind)
    assert np.mean((flat > 0) == (held[2] > 0.5)) < np.mean([(r.probability_default >= 0.5) == r.y_true for r in rows])


# --- P5: sketches --------------------------------------------------------------


def test_sketches_of_two_runs_merge(spark):
    nan = float("nan")
    one = spark.range(60_000).select((F.col("id") % 30_000).alias("k"), F.when(F.col("id") % 3 == 0, nan).otherwise((F.col("id") % 7).cast("double")).alias("v"), F.lit(None).cast("string").alias("z"))
    two = spark.range(40_000).select((F.col("id") + 20_000).alias("k"), F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0).alias("v"), F.lit(None).cast("string").alias("z"))
    runs = [SK.distinct_sketches(x, ["k", "v", "z"]) for x in (one, two)]
    got = {r.column: r for r in SK.estimates(SK.united(*runs)).collect()}
    assert abs(got["k"].distinct_estimate - 60_000) <= 3 * SK.standard_error() * 60_000 and got["k"].n == 100_000
    assert got["v"].distinct_estimate == 7 and got["z"].distinct_estimate == 0 and got["z"].n == 0
    exact = SK.estimates(SK.distinct_sketches(one.unionByName(two), ["k"])).first().distinct_estimate
    assert abs(exact - got["k"].distinct_estimate) <= 3 * SK.standard_error() * 60_000


def test_stored_frames_are_removed_on_release(spark):
    df = stored(spark.range(5), "probe")
    path = df.inputFiles()[0]
    assert df.count() == 5 and release_intermediates(spark) >= 1
    import os
    assert not os.path.exists(path.replace("file://", "").replace("file:", ""))
