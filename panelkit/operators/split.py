"""Duplicate predictor groups, leakage-safe group splits and manifest checks.

The reference assigns groups with a sequential greedy fold search on one
machine.  Here the assignment is a pure function of the group id, so it is
row-order independent and fully parallel:

* ``hash`` mode: bucket = first 32 bits of md5(seed | group id) mod 25;
  buckets 0-4 -> test (20 %), 5-8 -> validation (16 %), rest -> train (64 %).
* ``ranked`` mode: groups are stratified by (positives in group, group size);
  inside a stratum they are ranked by md5(seed | group id) and dealt round-robin
  into the 25 buckets, starting at a bucket derived from md5(seed | stratum), which
  balances classes almost exactly and spreads each stratum's remainder.  The rank is a
  distributed prefix count (range partitioned), so a stratum holding most
  groups is still spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.exprs import count_if, group_id, hex_bucket, pct0, ratio, text_of
from panelkit.functions.ordered import ordered_prefix
from panelkit.operators.checks import Rule, run_checks
from panelkit.spec import SPLITS

BUCKETS = 25
TEST_BUCKETS = 5       # 5 / 25 = 20 %
VALIDATION_BUCKETS = 4  # 4 / 25 = 16 %
MANIFEST_COLUMNS = ("ID", "split", "target", "predictor_group_id")


def predictor_columns(df: DataFrame, id_col: str, target: str) -> list[str]:
    """Predictors = every column but the id and the target, alphabetical."""
    return sorted(c for c in df.columns if c not in (id_col, target))


def with_group_id(df: DataFrame, predictors: list[str]) -> DataFrame:
    """G1: ``predictor_group_id`` = md5 of the '|'-joined predictor values (no join needed)."""
    return df.withColumn("predictor_group_id", group_id(predictors))


def duplicate_group_audit(df: DataFrame, gid: str = "predictor_group_id", target: str = "target") -> DataFrame:
    """Totals of repeated and label-conflicting predictor groups (one groupBy + one agg)."""
    g = df.groupBy(gid).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(target).alias("nt"))
    return g.agg(
        F.sum("n").cast("long").alias("total_rows"), F.count(F.lit(1)).cast("long").alias("unique_predictor_groups"),
        count_if(F.col("n") > 1).alias("repeated_predictor_groups"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("rows_in_repeated_predictor_groups"),
        count_if(F.col("nt") > 1).alias("conflicting_target_predictor_groups"),
        F.coalesce(F.sum(F.when(F.col("nt") > 1, F.col("n"))), F.lit(0)).cast("long").alias("rows_in_conflicting_target_groups"),
        F.max("n").cast("long").alias("maximum_predictor_group_size"))


def _split_of(bucket) -> F.Column:
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return (F.when(b < TEST_BUCKETS, F.lit("test"))
             .when(b < TEST_BUCKETS + VALIDATION_BUCKETS, F.lit("validation")).otherwise(F.lit("train")))


def _seeded(gid: str, seed: int) -> F.Column:
    return F.concat(F.lit(f"{seed}|"), F.col(gid))


def with_hash_split(df: DataFrame, gid: str = "predictor_group_id", seed: int = 42) -> DataFrame:
    """The hash split as a column; it depends on the row's group id alone, so no join is needed."""
    return df.withColumn("split", _split_of(hex_bucket(_seeded(gid, seed), BUCKETS)))


def stratified_group_split(df: DataFrame, id_col: str = "ID", target: str = "target",
                           gid: str = "predictor_group_id", seed: int = 42, mode: str = "hash") -> DataFrame:
    """Manifest ``(ID, split, target, predictor_group_id)``; groups never cross splits."""
    if mode == "hash":
        split = _split_of(hex_bucket(_seeded(gid, seed), BUCKETS))
        return df.select(F.col(id_col).alias("ID"), split.alias("split"), F.col(target).alias("target"),
                         F.col(gid).alias("predictor_group_id"))
    if mode != "ranked":
        raise ValueError(f"unknown split mode {mode!r}")
    groups = df.groupBy(gid).agg(F.sum(F.col(target).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_size"))
    groups = groups.withColumn("_h", F.md5(_seeded(gid, seed))).withColumn("_one", F.lit(1).cast("long"))
    # (stratum, _h) is unique as long as md5 does not collide across distinct group ids
    ranked = ordered_prefix(groups.select("_pos", "_size", F.concat("_h", F.lit("|"), F.col(gid)).alias("_hk"), gid, "_one"),
                            ["_pos", "_size"], "_hk", ["_one"])
    # each stratum starts its round-robin at its own bucket, so remainders spread over the splits
    offset = hex_bucket(F.concat_ws("|", F.lit(str(seed)), F.col("_pos").cast("string"), F.col("_size").cast("string")),
                        BUCKETS)
    assign = ranked.select(gid, _split_of(F.pmod(F.col("_one_before") + offset, F.lit(BUCKETS))).alias("split"))
    j = df.join(assign, gid)
    return j.select(F.col(id_col).alias("ID"), "split", F.col(target).alias("target"), F.col(gid).alias("predictor_group_id"))


def split_summary(manifest: DataFrame) -> DataFrame:
    """Per split counts, default rate (0.0 when empty), population %, unique groups; dense over 3 splits."""
    spark = manifest.sparkSession
    g = manifest.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("total_count"),
                                      count_if(F.col("target") == 1).alias("default_count"),
                                      F.countDistinct("predictor_group_id").cast("long").alias("unique_predictor_groups"))
    dom = spark.createDataFrame([(s, i) for i, s in enumerate(SPLITS)], "split string, split_order int")
    out = dom.join(g, "split", "left")
    tot = F.coalesce("total_count", F.lit(0))
    d = F.coalesce("default_count", F.lit(0))
    n = F.sum(tot).over(Window.partitionBy())  # three rows
    return out.select("split", tot.alias("total_count"), (tot - d).alias("non_default_count"), d.alias("default_count"),
                      F.coalesce(ratio(d, tot), F.lit(0.0)).alias("default_rate"),
                      pct0(tot, n).alias("population_percentage"),
                      F.coalesce("unique_predictor_groups", F.lit(0)).alias("unique_predictor_groups"))


def id_fingerprint(df: DataFrame, cols: list[str]) -> DataFrame:
    """G6 / G7 (scalable form): order-independent fingerprint of a population.

    Per row h = first 60 bits of md5(values joined by ','); the population is
    summarised by (count, exact sum of h, xor of h) and their sha256.  Equal
    populations give equal fingerprints whatever the row order or partitioning;
    nothing is collected into one row.
    """
    text = F.concat_ws(",", *[text_of(c) for c in cols])
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    agg = df.agg(F.count(F.lit(1)).cast("long").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("sum_h"),
                 F.bit_xor(h).alias("xor_h"))
    agg = agg.select("n", F.coalesce("sum_h", F.lit(0).cast("decimal(38,0)")).alias("sum_h"),
                     F.coalesce("xor_h", F.lit(0).cast("long")).alias("xor_h"))
    return agg.select("n", "sum_h", "xor_h",
                      F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.col("sum_h").cast("string"),
                                         F.col("xor_h").cast("string")), 256).alias("fingerprint"))


def group_collisions(df: DataFrame, predictors: list[str], gid: str = "predictor_group_id") -> DataFrame:
    """A group id must map to exactly one predictor vector (null-safe distinct on a struct)."""
    vec = F.struct(*[F.col(c) for c in sorted(predictors)])
    g = df.select(gid, vec.alias("_v")).distinct().groupBy(gid).agg(F.count(F.lit(1)).alias("nv"))
    return g.agg(F.count(F.lit(1)).cast("long").alias("groups"), count_if(F.col("nv") > 1).alias("colliding_groups"))


def verify_manifest(manifest: DataFrame, raw: DataFrame, id_col: str, target: str, predictors: list[str]) -> DataFrame:
    """The checks that must all pass before a stored manifest is reused.

    schema (V7), unique IDs, same ID population (J8, full outer join), same
    targets (J2), recomputed group ids equal (J3), valid labels, no group in two
    splits (J9).  Returns the checks table.
    """
    schema_ok = list(manifest.columns) == list(MANIFEST_COLUMNS)
    recomputed = with_group_id(raw, predictors).select(F.col(id_col).alias("ID"), F.col(target).alias("_raw_t"),
                                                        F.col("predictor_group_id").alias("_raw_g"))
    j = manifest.join(recomputed, "ID", "full_outer")
    id_rules = [
        Rule("manifest_schema_exact", F.lit(schema_ok), F.lit(",".join(manifest.columns))),
        Rule("population_equal", count_if(F.col("split").isNull() | F.col("_raw_t").isNull()) == 0,
             F.format_string("%d ids on one side only", count_if(F.col("split").isNull() | F.col("_raw_t").isNull()))),
        Rule("targets_equal", count_if(~F.col("target").eqNullSafe(F.col("_raw_t"))) == 0,
             F.format_string("%d target mismatches", count_if(~F.col("target").eqNullSafe(F.col("_raw_t"))))),
        Rule("group_ids_equal", count_if(~F.col("predictor_group_id").eqNullSafe(F.col("_raw_g"))) == 0,
             F.format_string("%d group id mismatches", count_if(~F.col("predictor_group_id").eqNullSafe(F.col("_raw_g"))))),
        Rule("split_labels_valid", count_if(F.col("split").isNotNull() & ~F.col("split").isin(*SPLITS)) == 0,
             F.format_string("%d unknown labels", count_if(F.col("split").isNotNull() & ~F.col("split").isin(*SPLITS)))),
    ]
    per_id = manifest.groupBy("ID").agg(F.count(F.lit(1)).alias("n"))
    uniq = [Rule("ids_unique", F.max("n") <= 1, F.format_string("max rows per id %d", F.max("n")))]
    per_g = manifest.groupBy("predictor_group_id").agg(F.countDistinct("split").alias("ns"))
    grp = [Rule("groups_disjoint_across_splits", count_if(F.col("ns") > 1) == 0,
                F.format_string("%d groups in several splits", count_if(F.col("ns") > 1)))]
    return run_checks(j, id_rules).unionByName(run_checks(per_id, uniq)).unionByName(run_checks(per_g, grp))


def write_if_passed(checks: DataFrame, write) -> None:
    """Nothing is written until every check passed."""
    from panelkit.operators.checks import assert_checks
    assert_checks(checks)
    write()
