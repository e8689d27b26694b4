"""Model experiments on prepared features (L1-L8) with Spark MLlib.

The reference trains sklearn / torch models on one machine; here the same
roles are played by distributed MLlib estimators on cached feature frames:

* L1 weighted logistic regression.  sklearn minimises ½‖w‖² + C·Σ wᵢℓᵢ while
  MLlib minimises Σ wᵢℓᵢ / Σ wᵢ + regParam·½‖w‖², so regParam = 1 / (C·Σ wᵢ).
* L2 gradient-boosted trees (200 trees, step 0.05, depth 3, subsample 0.8).
* L3 sequence family, re-aimed as a multilayer perceptron over the flattened
  temporal tensor plus the static block.
* L5 scoring to the long prediction table; L6 shape guards; L7 the
  early-stopping rule as a DataFrame operator over any training history.
"""

from __future__ import annotations

import time

from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.exprs import count_if
from panelkit.operators.checks import Rule, run_checks
from panelkit.spec import EARLY_STOP_MIN_DELTA, EARLY_STOP_PATIENCE

LABEL = "label"
WEIGHT = "weight"


def with_weights(train: DataFrame, target: str = "target") -> DataFrame:
    """Class weights N / (2 n_c) from the train rows as a column (F1 applied)."""
    counts = {int(r[0]): int(r[1]) for r in train.groupBy(target).count().collect()}  # two rows
    n = sum(counts.values())
    w = {c: n / (2.0 * k) for c, k in counts.items()}
    expr = F.lit(1.0)
    for c, v in w.items():
        expr = F.when(F.col(target) == c, F.lit(v)).otherwise(expr)
    return train.withColumn(WEIGHT, expr)


def to_ml(df: DataFrame, features: str, target: str = "target") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(features))).withColumn(LABEL, F.col(target).cast("double"))


def logistic_regression(train: DataFrame, C: float = 1.0, max_iter: int = 1000):
    """L1: L2-penalised weighted logistic regression, sklearn-equivalent regularisation."""
    total_w = train.agg(F.sum(WEIGHT)).first()[0]
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, maxIter=max_iter,
                            regParam=1.0 / (C * total_w), elasticNetParam=0.0, standardization=False)
    return lr.fit(train)


def gradient_boosting(train: DataFrame, n_trees: int = 200, step: float = 0.05, depth: int = 3,
                      subsample: float = 0.8, seed: int = 42):
    """L2: gradient-boosted trees with sample weights."""
    gbt = GBTClassifier(featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, maxIter=n_trees, stepSize=step,
                        maxDepth=depth, subsamplingRate=subsample, seed=seed)
    return gbt.fit(train)


def sequence_mlp(train: DataFrame, n_features: int, hidden: int = 64, max_iter: int = 50, seed: int = 42):
    """L3 (re-aimed): MLP over concat(flatten(temporal), static)."""
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol=LABEL, layers=[n_features, hidden, 2],
                                         maxIter=max_iter, seed=seed)
    return mlp.fit(train)


def score(model, df: DataFrame, model_name: str, id_col: str) -> DataFrame:
    """Long prediction rows (model_name, ID, y_true, probability_default, prediction_at_0_5)."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.select(F.lit(model_name).alias("model_name"), F.col(id_col).alias("ID"),
                      F.col(LABEL).cast("long").alias("y_true"), p.alias("probability_default"),
                      (p >= 0.5).cast("int").alias("prediction_at_0_5"))


def shape_checks(df: DataFrame, expected: dict[str, int], expected_rows: int | None = None) -> DataFrame:
    """Every row's arrays have the expected length (and the row count, when given)."""
    rules = [Rule(f"{c}_length_{k}", count_if(F.size(c) != k) == 0, F.format_string("%d rows off", count_if(F.size(c) != k)))
             for c, k in expected.items()]
    if expected_rows is not None:
        rules.append(Rule("row_count", F.count(F.lit(1)) == expected_rows, F.format_string("%d rows", F.count(F.lit(1)))))
    return run_checks(df, rules)


def early_stop(history: DataFrame, min_delta: float = EARLY_STOP_MIN_DELTA, patience: int = EARLY_STOP_PATIENCE,
               key: str = "model_name") -> DataFrame:
    """The stopping rule over any history ``(model_name, epoch, validation_loss)``.

    A new best needs loss < best - min_delta; training stops after ``patience``
    epochs without one.  Per model the (bounded) epoch list is folded in order
    with ``aggregate``; returns best epoch, stop epoch and epochs run.
    """
    h = history.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("epoch").cast("long").alias("epoch"),
                                                                    F.col("validation_loss").cast("double").alias("loss")))).alias("h"))
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(-1).cast("long").alias("best_epoch"),
                    F.lit(0).cast("long").alias("wait"), F.lit(-1).cast("long").alias("stop_epoch"))

    def step(acc, x):
        running = acc["stop_epoch"] < 0
        better = running & (x["loss"] < acc["best"] - F.lit(min_delta))
        wait = F.when(~running, acc["wait"]).when(better, F.lit(0).cast("long")).otherwise(acc["wait"] + 1)
        stop = F.when(running & ~better & (wait >= patience), x["epoch"]).otherwise(acc["stop_epoch"])
        return F.struct(F.when(better, x["loss"]).otherwise(acc["best"]).alias("best"),
                        F.when(better, x["epoch"]).otherwise(acc["best_epoch"]).alias("best_epoch"),
                        wait.alias("wait"), stop.alias("stop_epoch"))

    r = h.select(key, F.aggregate("h", init, step).alias("s"), F.size("h").alias("n"))
    return r.select(key, F.col("s.best_epoch").alias("best_epoch"), F.col("s.best").alias("best_validation_loss"),
                    F.when(F.col("s.stop_epoch") >= 0, F.col("s.stop_epoch")).alias("stop_epoch"),
                    F.col("n").cast("long").alias("epochs_available"))


def gbt_history(model, validation: DataFrame, model_name: str) -> DataFrame:
    """Per-iteration validation log-loss of a fitted GBT (one value per tree)."""
    losses = model.evaluateEachIteration(validation)  # the model's own (logistic) loss
    spark = validation.sparkSession
    return spark.createDataFrame([(model_name, i + 1, float(v)) for i, v in enumerate(losses)],
                                 "model_name string, epoch long, validation_loss double")


def run_experiments(train: DataFrame, validation: DataFrame, estimators: dict, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Fit every estimator on the cached train frame, score validation, time both.

    ``estimators`` maps a model name to ``fit(train) -> model``.  Returns the
    long prediction table and a (model_name, train_seconds, score_seconds) table.
    """
    train = train.cache()
    validation = validation.cache()
    preds, times = [], []
    for name, fit in estimators.items():
        t0 = time.time()
        model = fit(train)
        t1 = time.time()
        p = score(model, validation, name, id_col).cache()
        p.count()
        t2 = time.time()
        preds.append(p)
        times.append((name, t1 - t0, t2 - t1))
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out, train.sparkSession.createDataFrame(times, "model_name string, train_seconds double, score_seconds double")
