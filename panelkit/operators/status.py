"""Status-sequence profiles (Q1-Q10) for a coded channel of a wide panel.

Every table is one aggregation over a narrow unpivot (or over adjacent pairs /
whole sequences built inside the row), densified by joining a tiny domain frame
(periods x known codes) that is built from the spec, never from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.exprs import count_if, pct, ratio, rnd
from panelkit.spec import (DOCUMENTED, DOCUMENTED_STATUS_CODES, KNOWN_STATUS_CODES, NEGATIVE_CLASS, POSITIVE_CLASS,
                           UNDOCUMENTED, PanelSpec)


def doc_status(code) -> F.Column:
    """Q1: documented iff the code is -1 or 1..9."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c.isin(*DOCUMENTED_STATUS_CODES), F.lit(DOCUMENTED)).otherwise(F.lit(UNDOCUMENTED))


def _periods(spark, spec: PanelSpec, channel: str) -> DataFrame:
    cols = spec.columns(channel)
    return spark.createDataFrame([(i, p, cols[i]) for i, p in enumerate(spec.periods)],
                                 "mi int, period string, raw_column_name string")


def _codes(frame: DataFrame, name: str = "code") -> DataFrame:
    return frame.select("*", F.explode(F.array(*[F.lit(c) for c in KNOWN_STATUS_CODES])).alias(name))


def _long(df: DataFrame, spec: PanelSpec, channel: str) -> DataFrame:
    return spec.to_long(df, [channel]).select((F.col("t") - 1).alias("mi"), F.col(spec.target).alias("y"),
                                              F.col(channel).alias("code"))


def status_by_period(df: DataFrame, spec: PanelSpec, channel: str = "status") -> DataFrame:
    """Q2: per period, dense over known ∪ observed codes: totals, population %, default counts / rate, flags.

    Unobserved codes get NULL % and rate, ``observed_combination`` false and no
    small-sample warning.  The population is the actual row count.
    """
    spark = df.sparkSession
    g = _long(df, spec, channel).groupBy("mi", "code").agg(
        F.count(F.lit(1)).cast("long").alias("total_count"),
        count_if(F.col("y") == spec.positive).alias("default_count"),
        count_if(F.col("y") == spec.negative).alias("non_default_count"))
    dom = _codes(_periods(spark, spec, channel).select("mi"))
    # full outer keeps observed codes outside the known domain
    j = dom.join(g, ["mi", "code"], "full_outer").join(_periods(spark, spec, channel), "mi")
    n = F.sum(F.coalesce("total_count", F.lit(0))).over(Window.partitionBy("mi"))
    tot = F.coalesce("total_count", F.lit(0))
    observed = tot > 0
    return j.select(
        "raw_column_name", "period", F.col("mi").cast("long").alias("chronological_month_index"),
        F.col("code").cast("long").alias("raw_status_value"), tot.alias("total_count"),
        F.when(observed, rnd(pct(tot, n), 6)).alias("population_percentage"),
        F.coalesce("default_count", F.lit(0)).alias("default_count"),
        F.coalesce("non_default_count", F.lit(0)).alias("non_default_count"),
        F.when(observed, rnd(ratio("default_count", tot), 6)).alias("default_rate"),
        observed.alias("observed_combination"), doc_status("code").alias("documentation_status"),
        F.when(observed, tot < spec.small_n).otherwise(F.lit(False)).alias("small_sample_warning"))


def status_by_period_target(df: DataFrame, spec: PanelSpec, channel: str = "status") -> DataFrame:
    """Q4: % of each known code within (period, class); codes outside the known set are dropped."""
    spark = df.sparkSession
    long = _long(df, spec, channel)
    g = long.groupBy("mi", "y", "code").agg(F.count(F.lit(1)).cast("long").alias("cnt"))
    cls = long.groupBy("mi", "y").agg(F.count(F.lit(1)).alias("class_total"))
    per = _periods(spark, spec, channel)
    dom = _codes(per.select("*", F.explode(F.array(F.lit(NEGATIVE_CLASS), F.lit(POSITIVE_CLASS))).alias("y")))
    j = dom.join(g, ["mi", "y", "code"], "left").join(cls, ["mi", "y"], "left")
    cnt = F.coalesce("cnt", F.lit(0))
    return j.select("raw_column_name", "period", F.col("mi").cast("long").alias("chronological_month_index"),
                    F.col("y").cast("long").alias("target_class"), F.col("code").cast("long").alias("raw_status_value"),
                    cnt.alias("status_count"),
                    F.when(cnt > 0, rnd(pct(cnt, F.col("class_total")), 6)).alias("percentage_within_target_class"),
                    (cnt > 0).alias("observed_combination"))


def status_transitions(df: DataFrame, spec: PanelSpec, channel: str = "status") -> DataFrame:
    """Q5: adjacent-period transitions, dense 12 x 12 per pair.

    % within source is NULL only when the source code never occurs; unobserved
    transitions from an observed source get 0.0 (T5).
    """
    spark = df.sparkSession
    pairs = spec.pairs_long(df, channel).select((F.col("pair_index") - 1).alias("pi"), "source_period",
                                                "destination_period", F.col(spec.target).alias("y"), "src", "dst")
    g = pairs.groupBy("pi", "src", "dst").agg(
        F.count(F.lit(1)).cast("long").alias("cnt"),
        count_if(F.col("y") == spec.positive).alias("dc"), count_if(F.col("y") == spec.negative).alias("ndc"))
    src_tot = pairs.groupBy("pi", "src").agg(F.count(F.lit(1)).cast("long").alias("source_status_total"))
    dom = spark.createDataFrame([(i, spec.periods[i], spec.periods[i + 1]) for i in range(spec.n_periods - 1)],
                                "pi int, source_period string, destination_period string")
    dom = _codes(_codes(dom, "src"), "dst")
    j = dom.join(g, ["pi", "src", "dst"], "left").join(src_tot, ["pi", "src"], "left")
    cnt = F.coalesce("cnt", F.lit(0))
    st = F.coalesce("source_status_total", F.lit(0))
    observed = cnt > 0
    return j.select("source_period", "destination_period", F.col("pi").cast("long").alias("chronological_pair_index"),
                    F.col("src").cast("long").alias("source_raw_status"),
                    F.col("dst").cast("long").alias("destination_raw_status"), st.alias("source_status_total"),
                    cnt.alias("transition_count"), rnd(pct(cnt, st), 6).alias("percentage_within_source_status"),
                    F.coalesce("dc", F.lit(0)).alias("default_count"), F.coalesce("ndc", F.lit(0)).alias("non_default_count"),
                    F.when(observed, rnd(ratio("dc", cnt), 6)).alias("default_rate"), observed.alias("observed_combination"),
                    F.when(observed, cnt < spec.small_n).otherwise(F.lit(False)).alias("small_sample_warning"))


def sequence_text(spec: PanelSpec, channel: str = "status") -> F.Column:
    """Whole sequence as '|'-joined codes, oldest first (NULL -> 'nan')."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in spec.columns(channel)])


def sequence_patterns(df: DataFrame, spec: PanelSpec, channel: str = "status") -> DataFrame:
    """Q6: exact whole-sequence patterns with totals, population %, default counts / rate, flags.

    The pattern is built inside each row and aggregated with map-side partial
    counts, so a dominant pattern costs one counter per task.
    """
    g = df.select(sequence_text(spec, channel).alias("sequence_pattern"), F.col(spec.target).alias("y")) \
        .groupBy("sequence_pattern").agg(F.count(F.lit(1)).cast("long").alias("total_count"),
                                         count_if(F.col("y") == spec.positive).alias("default_count"),
                                         count_if(F.col("y") == spec.negative).alias("non_default_count"))
    n = df.select(F.count(F.lit(1))).scalar()
    return g.select("sequence_pattern", "total_count", rnd(pct("total_count", n), 6).alias("population_percentage"),
                    "default_count", "non_default_count", rnd(ratio("default_count", "total_count"), 6).alias("default_rate"),
                    (F.col("total_count") > 0).alias("observed_combination"),
                    (F.col("total_count") < spec.small_n).alias("small_sample_warning"))


def top_sequences(patterns: DataFrame, k: int = 10, by: str = "total_count") -> DataFrame:
    """Q7: top-k patterns by ``by`` (ties: pattern ascending), with an explicit rank.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps k rows.
    """
    order = [F.col(by).desc(), F.col("sequence_pattern").asc()]
    top = patterns.orderBy(*order).limit(k)
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"), "*")


def modal_status(by_target: DataFrame) -> DataFrame:
    """Q8: most common code per (period, class) from the Q4 table (ties: lower code)."""
    w = Window.partitionBy("chronological_month_index", "target_class").orderBy(
        F.col("percentage_within_target_class").desc_nulls_last(), F.col("raw_status_value").asc())
    return by_target.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(
        "period", "chronological_month_index", "target_class", "raw_status_value", "status_count",
        "percentage_within_target_class")


def sequence_coverage(df: DataFrame, spec: PanelSpec, channel: str = "status", k: int = 10) -> DataFrame:
    """Q9: undocumented code totals (0 and -2 over all periods), distinct patterns, top-k coverage."""
    long = _long(df, spec, channel)
    undoc = long.agg(count_if(F.col("code") == 0).alias("code_0_total"),
                     count_if(F.col("code") == -2).alias("code_minus2_total"))
    pats = sequence_patterns(df, spec, channel)
    top = top_sequences(pats, k).agg(F.sum("total_count").cast("long").alias("topk_count"))
    n = df.select(F.count(F.lit(1)).alias("n"))
    n_pat = pats.agg(F.count(F.lit(1)).cast("long").alias("distinct_patterns"))
    tk = top.select("topk_count").scalar()
    return undoc.select("code_0_total", "code_minus2_total",
                        n_pat.select("distinct_patterns").scalar().alias("distinct_patterns"),
                        F.coalesce(tk, F.lit(0)).cast("long").alias("topk_count"),
                        rnd(pct(tk, n.select("n").scalar()), 6).alias("topk_percentage"))


#: the two columns of Q2 that the matrices show
MATRIX_MEASURES = ("population_percentage", "default_rate")


def status_matrix(status_table: DataFrame, spec: PanelSpec, value: str = "population_percentage") -> DataFrame:
    """Q10: code x period matrix of a Q2 column (unobserved stay NULL), one column per period."""
    return status_table.groupBy("raw_status_value").pivot("period", list(spec.periods)).agg(F.first(value))


def transition_matrices(transitions: DataFrame, spec: PanelSpec) -> DataFrame:
    """Q10: source x destination % matrices of every adjacent pair, one below the other."""
    return transitions.groupBy("chronological_pair_index", "source_raw_status").pivot("destination_raw_status", list(KNOWN_STATUS_CODES)) \
        .agg(F.first("percentage_within_source_status"))


def transition_matrix(transitions: DataFrame, spec: PanelSpec, pair_index: int) -> DataFrame:
    """Q10: source x destination % matrix for one adjacent pair."""
    t = transitions.where(F.col("chronological_pair_index") == pair_index)
    return t.groupBy("source_raw_status").pivot("destination_raw_status", list(KNOWN_STATUS_CODES)) \
        .agg(F.first("percentage_within_source_status"))


def last_k_patterns(events: DataFrame, entity: str, order_cols: list[str], value: str, k: int = 4) -> DataFrame:
    """The last ``k`` values per entity as a '|' pattern, oldest first: ``(entity, sequence_pattern)``.

    ``row_number() <= k`` plans as a partial WindowGroupLimit before the shuffle,
    so each map task forwards at most k rows per entity: an entity holding a third
    of all events still reaches its final task as k rows per map task.  The per
    entity list that is then assembled has at most k elements.
    """
    w = Window.partitionBy(entity).orderBy(*[F.col(c).desc() for c in order_cols])
    top = events.select(entity, *order_cols, value).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    seq = top.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct(*order_cols, F.col(value).alias("_x")))).alias("_s"))
    return seq.select(entity, F.concat_ws("|", F.transform("_s", lambda x: x["_x"].cast("string"))).alias("sequence_pattern"))


def pattern_summary(patterns: DataFrame, target: str, small_n: int = 200, positive: int = 1, negative: int = 0) -> DataFrame:
    """Q6 on any (entity, sequence_pattern, target) frame."""
    g = patterns.groupBy("sequence_pattern").agg(F.count(F.lit(1)).cast("long").alias("total_count"),
                                                 count_if(F.col(target) == positive).alias("default_count"),
                                                 count_if(F.col(target) == negative).alias("non_default_count"))
    n = patterns.select(F.count(F.lit(1))).scalar()
    return g.select("sequence_pattern", "total_count", rnd(pct("total_count", n), 6).alias("population_percentage"),
                    "default_count", "non_default_count", rnd(ratio("default_count", "total_count"), 6).alias("default_rate"),
                    (F.col("total_count") > 0).alias("observed_combination"),
                    (F.col("total_count") < small_n).alias("small_sample_warning"))
