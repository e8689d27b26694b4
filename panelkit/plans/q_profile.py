"""Audit and static-profile queries (P*, S*) on lineitem / part / orders."""

from __future__ import annotations

from panelkit.operators import profile as P
from panelkit.plans.catalog import register
from panelkit.plans.sql import s_cnt, s_pct, s_ratio, sql_hist_bin, sql_hist_edge, sql_rnd
from panelkit.sources.tables import read_table
from panelkit.sources.testdata import LINEITEM_CODEBOOK, lineitem_rows, part_groups
from panelkit.spec import DOCUMENTED, UNDOCUMENTED

CAT_COLS = ["l_linestatus", "l_linenumber"]
NUM_COLS = ["l_extendedprice", "l_quantity", "l_discount"]
LI = "li AS (SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS target FROM lineitem)"


def _long_sql(cols, src="li", extra=""):
    return "\n  UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value{extra} FROM {src}" for c in cols)


def _long_num_sql(cols, src="li", extra=""):
    return "\n  UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v{extra} FROM {src}" for c in cols)


def _doc_sql(codebook, col="col", value="value"):
    conds = [f"({col} = '{f}' AND {value} IN ({', '.join(repr(str(c)) for c in codes)}))"
             for f, codes in codebook.documented.items()]
    return "(" + (" OR ".join(conds) if conds else "FALSE") + ")"


# ---------------------------------------------------------------- S5 (flagship)
@register("categorical_default_rates", f"""
WITH {LI}, long AS (
  {_long_sql(CAT_COLS, extra=", target")}
), g AS (
  SELECT col, value, COUNT(*) AS total_count, {s_cnt('target = 1')} AS default_count FROM long GROUP BY col, value
)
SELECT col AS feature, value AS raw_value, CAST(total_count AS BIGINT) AS total_count, default_count,
  CAST(total_count - default_count AS BIGINT) AS non_default_count,
  {sql_rnd(s_ratio('default_count', 'total_count'), 6)} AS default_rate,
  {sql_rnd(s_pct('total_count', 'SUM(total_count) OVER (PARTITION BY col)'), 4)} AS population_percentage,
  CASE WHEN {_doc_sql(LINEITEM_CODEBOOK)} THEN '{DOCUMENTED}' ELSE '{UNDOCUMENTED}' END AS documentation_status,
  total_count < 200 AS small_sample_warning
FROM g""")
def q_categorical_default_rates(spark, sf_dir):
    return P.categorical_default_rates(lineitem_rows(spark, sf_dir), CAT_COLS, "target", LINEITEM_CODEBOOK)


@register("categorical_distribution", f"""
WITH {LI}, long AS ({_long_sql(CAT_COLS)}),
g AS (SELECT col, value, COUNT(*) AS cnt FROM long GROUP BY col, value)
SELECT col AS feature, value AS raw_value, CAST(cnt AS BIGINT) AS count,
  {sql_rnd(s_pct('cnt', 'SUM(cnt) OVER (PARTITION BY col)'), 4)} AS percentage,
  CASE WHEN {_doc_sql(LINEITEM_CODEBOOK)} THEN '{DOCUMENTED}' ELSE '{UNDOCUMENTED}' END AS documentation_status,
  cnt < 200 AS small_sample_warning
FROM g""")
def q_categorical_distribution(spark, sf_dir):
    return P.categorical_distribution(lineitem_rows(spark, sf_dir), CAT_COLS, LINEITEM_CODEBOOK)


@register("target_summary", f"""
WITH {LI}, g AS (SELECT target AS class_value, COUNT(*) AS cnt FROM li GROUP BY target)
SELECT CAST(class_value AS BIGINT) AS class_value,
  CASE WHEN class_value = 1 THEN 'default' ELSE 'no_default' END AS class_label,
  CAST(cnt AS BIGINT) AS count,
  {sql_rnd(s_pct('cnt', 'SUM(cnt) OVER ()'), 4)} AS percentage,
  {sql_rnd(s_ratio('MAX(cnt) OVER ()', 'MIN(cnt) OVER ()'), 4)} AS imbalance_ratio_majority_to_minority,
  CAST(1 AS BIGINT) AS positive_class
FROM g""")
def q_target_summary(spark, sf_dir):
    return P.target_summary(lineitem_rows(spark, sf_dir), "target")


AUDIT_CAT = ["l_returnflag", "l_linestatus", "l_linenumber", "target"]


@register("audit_categorical_values", f"""
WITH {LI}, long AS ({_long_sql(AUDIT_CAT)}),
g AS (SELECT col, value, COUNT(*) AS cnt FROM long GROUP BY col, value)
SELECT col AS "column", value, CAST(cnt AS BIGINT) AS count,
  {sql_rnd(s_pct('cnt', 'SUM(cnt) OVER (PARTITION BY col)'), 4)} AS percentage,
  ({_doc_sql(LINEITEM_CODEBOOK)} OR col = 'target') AS documented
FROM g""")
def q_audit_categorical_values(spark, sf_dir):
    return P.audit_categorical_values(lineitem_rows(spark, sf_dir), AUDIT_CAT, LINEITEM_CODEBOOK, ("target",))


@register("undocumented_values", f"""
WITH {LI}, long AS ({_long_sql(['l_linenumber'])})
SELECT col AS "column", value, CAST(COUNT(*) AS BIGINT) AS count,
  'value is absent from the code book' AS note
FROM long WHERE NOT {_doc_sql(LINEITEM_CODEBOOK)} GROUP BY col, value""")
def q_undocumented_values(spark, sf_dir):
    return P.undocumented_values(lineitem_rows(spark, sf_dir), ["l_linenumber"], LINEITEM_CODEBOOK)


@register("audit_duplicates", """
WITH pg AS (SELECT p_partkey AS ID, CAST(p_retailprice > 950 AS INTEGER) AS target, p_brand, p_type, p_size FROM part),
a AS (SELECT COUNT(*) AS n FROM pg GROUP BY ID, target, p_brand, p_type, p_size),
b AS (SELECT COUNT(*) AS n FROM pg GROUP BY target, p_brand, p_type, p_size)
SELECT 'all_columns_including_ID' AS scope, CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_involved,
  CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows_excl_first FROM a
UNION ALL
SELECT 'all_columns_excluding_ID', CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT),
  CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) FROM b""")
def q_audit_duplicates(spark, sf_dir):
    return P.audit_duplicates(part_groups(spark, sf_dir), "ID")


LI_COLUMNS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
              ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
              ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


def _audit_columns_sql():
    meta = ", ".join(f"('{c}', {i}, '{t}')" for i, (c, t) in enumerate(LI_COLUMNS, 1))
    miss = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS col, {s_cnt(f'{c} IS NULL' + (f' OR isnan({c})' if t == 'double' else ''))} AS missing_count, "
        f"{s_cnt(f'abs({c}) = CAST(' + chr(39) + 'inf' + chr(39) + ' AS DOUBLE)') if t == 'double' else 'CAST(0 AS BIGINT)'} AS infinite_count, "
        f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS unique_count, CAST(COUNT(*) AS BIGINT) AS row_count FROM lineitem"
        for c, t in LI_COLUMNS)
    return f"""
WITH meta(col, ordinal, dtype) AS (VALUES {meta}),
s AS ({miss})
SELECT meta.col AS "column", CAST(ordinal AS BIGINT) AS ordinal, dtype, missing_count, infinite_count, unique_count,
  row_count, unique_count = row_count AS all_unique
FROM meta JOIN s ON meta.col = s.col"""


@register("audit_columns", _audit_columns_sql())
def q_audit_columns(spark, sf_dir):
    return P.audit_columns(read_table(spark, sf_dir, "lineitem"))


@register("key_uniqueness", """
WITH d AS (SELECT o_orderkey, COUNT(*) AS n FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)
SELECT CAST(SUM(n) AS BIGINT) AS non_null_rows, CAST(COUNT(*) AS BIGINT) AS distinct_keys,
  CAST(COALESCE(MAX(n), 0) AS BIGINT) AS max_multiplicity, COALESCE(MAX(n), 0) <= 1 AS is_unique FROM d""")
def q_key_uniqueness(spark, sf_dir):
    return P.key_uniqueness(read_table(spark, sf_dir, "orders"), "o_orderkey")


DESCRIBE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("describe_numeric", f"""
WITH long AS ({_long_num_sql(DESCRIBE_COLS, src='lineitem')})
SELECT col AS "column", CAST(COUNT(v) AS BIGINT) AS count, {sql_rnd('AVG(v)', 6)} AS mean,
  {sql_rnd('STDDEV_SAMP(v)', 6)} AS std, {sql_rnd('MIN(v)', 6)} AS min,
  {sql_rnd('quantile_cont(v, 0.25)', 6)} AS p25, {sql_rnd('quantile_cont(v, 0.5)', 6)} AS p50,
  {sql_rnd('quantile_cont(v, 0.75)', 6)} AS p75, {sql_rnd('MAX(v)', 6)} AS max
FROM long GROUP BY col""")
def q_describe_numeric(spark, sf_dir):
    return P.describe_numeric(read_table(spark, sf_dir, "lineitem"))


def _numeric_sql(by_target: bool) -> str:
    k = "col, target" if by_target else "col"
    extra = ", target" if by_target else ""
    fmt = lambda e: f"printf('%.1f', {sql_rnd(e, 1)})"
    tcols = ("CAST(s.target AS BIGINT) AS target_value, CASE WHEN s.target = 1 THEN 'default' ELSE 'no_default' END "
             "AS target_label, ") if by_target else ""
    join = "s.col = f.col" + (" AND s.target = f.target" if by_target else "")
    return f"""
WITH {LI}, long AS ({_long_num_sql(NUM_COLS, extra=extra)}),
s AS (SELECT {k}, COUNT(v) AS cnt, AVG(v) AS mean, STDDEV_SAMP(v) AS std, MIN(v) AS mn, MAX(v) AS mx,
        quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q75
      FROM long GROUP BY {k}),
f AS (SELECT {k}, q25 - 3.0 * (q75 - q25) AS lf, q75 + 3.0 * (q75 - q25) AS uf FROM s),
e AS (SELECT {', '.join('long.' + x for x in k.split(', '))}, {s_cnt('v < lf OR v > uf')} AS n_ext
      FROM long JOIN f ON {' AND '.join(f'long.{x} = f.{x}' for x in k.split(', '))} GROUP BY {', '.join('long.' + x for x in k.split(', '))})
SELECT s.col AS feature, {tcols}CAST(cnt AS BIGINT) AS count, {sql_rnd('mean', 4)} AS mean, {sql_rnd('std', 4)} AS std,
  {sql_rnd('mn', 4)} AS min, {sql_rnd('q25', 4)} AS q25, {sql_rnd('med', 4)} AS median, {sql_rnd('q75', 4)} AS q75,
  {sql_rnd('mx', 4)} AS max, {sql_rnd('q75 - q25', 4)} AS iqr,
  CAST(n_ext AS VARCHAR) || ' values outside 3×IQR fences [' || {fmt('lf')} || ', ' || {fmt('uf')} || ']; not removed'
    AS potential_extreme_note
FROM s JOIN f ON {join} JOIN e ON {join.replace('f.', 'e.')}"""


@register("numeric_summary", _numeric_sql(False))
def q_numeric_summary(spark, sf_dir):
    return P.numeric_summary(lineitem_rows(spark, sf_dir), NUM_COLS)


@register("numeric_by_target", _numeric_sql(True))
def q_numeric_by_target(spark, sf_dir):
    return P.numeric_by_target(lineitem_rows(spark, sf_dir), NUM_COLS, "target")


@register("class_histogram", f"""
WITH {LI}, r AS (SELECT CASE WHEN MIN(l_extendedprice) = MAX(l_extendedprice) THEN MIN(l_extendedprice) - 0.5
                  ELSE MIN(l_extendedprice) END AS lo,
                CASE WHEN MIN(l_extendedprice) = MAX(l_extendedprice) THEN MAX(l_extendedprice) + 0.5
                  ELSE MAX(l_extendedprice) END AS hi FROM li),
b AS (SELECT target AS cls, {sql_hist_bin('CAST(l_extendedprice AS DOUBLE)', 'r.lo', 'r.hi', 40)} AS bin
      FROM li, r WHERE l_extendedprice IS NOT NULL),
c AS (SELECT cls, bin, COUNT(*) AS n FROM b GROUP BY cls, bin),
t AS (SELECT cls, COUNT(*) AS class_n FROM b GROUP BY cls),
d AS (SELECT r.lo, r.hi, bin, cls FROM r, range(0, 40) AS g(bin), (VALUES (0), (1)) AS k(cls))
SELECT 'l_extendedprice' AS feature, CAST(d.cls AS BIGINT) AS target, CAST(d.bin AS BIGINT) AS bin_index,
  {sql_rnd(sql_hist_edge('d.bin', 'd.lo', 'd.hi', 40), 6)} AS bin_left,
  {sql_rnd(sql_hist_edge('d.bin + 1', 'd.lo', 'd.hi', 40), 6)} AS bin_right,
  CAST(COALESCE(c.n, 0) AS BIGINT) AS count,
  {sql_rnd(f"COALESCE({s_pct('c.n', 't.class_n')}, 0.0)", 6)} AS percentage
FROM d LEFT JOIN c ON d.cls = c.cls AND d.bin = c.bin LEFT JOIN t ON d.cls = t.cls""")
def q_class_histogram(spark, sf_dir):
    return P.class_histogram(lineitem_rows(spark, sf_dir), "l_extendedprice", "target", 40)


BOX_COLS = ["l_extendedprice", "l_quantity"]


@register("box_stats", f"""
WITH {LI}, long AS ({_long_num_sql(BOX_COLS, extra=', target')}),
q AS (SELECT col, target, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM long WHERE v IS NOT NULL GROUP BY col, target),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT long.col AS feature, CAST(long.target AS BIGINT) AS target, CAST(COUNT(v) AS BIGINT) AS count,
  {sql_rnd('MIN(v)', 6)} AS min, {sql_rnd('ANY_VALUE(q1)', 6)} AS q1, {sql_rnd('ANY_VALUE(med)', 6)} AS median,
  {sql_rnd('ANY_VALUE(q3)', 6)} AS q3, {sql_rnd('MAX(v)', 6)} AS max,
  {sql_rnd('MIN(v) FILTER (WHERE v >= lo_f AND v <= hi_f)', 6)} AS whisker_low,
  {sql_rnd('MAX(v) FILTER (WHERE v >= lo_f AND v <= hi_f)', 6)} AS whisker_high,
  {s_cnt('NOT (v >= lo_f AND v <= hi_f)')} AS flier_count
FROM long JOIN f ON long.col = f.col AND long.target = f.target WHERE v IS NOT NULL
GROUP BY long.col, long.target""")
def q_box_stats(spark, sf_dir):
    return P.box_stats(lineitem_rows(spark, sf_dir), BOX_COLS, "target")


@register("overall_default_rate", f"""
WITH {LI} SELECT {sql_rnd(s_ratio(s_cnt('target = 1'), 'COUNT(*)'), 6)} AS overall_default_rate FROM li""")
def q_overall_default_rate(spark, sf_dir):
    return P.overall_default_rate(lineitem_rows(spark, sf_dir), "target")

