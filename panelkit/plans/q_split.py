"""Group-split queries (G*) on ``part`` (repeated predictor groups, target = price > 950)."""

from __future__ import annotations

from panelkit.operators import split as G
from panelkit.plans.catalog import register
from panelkit.plans.sql import s_cnt, s_pct0, s_ratio, sql_hex_bucket
from panelkit.sources.testdata import PART_PREDICTORS, part_groups

GID_SQL = "md5(concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'nan')" for c in sorted(PART_PREDICTORS)) + "))"
PG = f"""pg AS (SELECT p_partkey AS ID, CAST(p_retailprice > 950 AS INTEGER) AS target, p_brand, p_type, p_size,
  {GID_SQL} AS predictor_group_id FROM part)"""


def _split_case(b: str) -> str:
    return (f"CASE WHEN {b} < {G.TEST_BUCKETS} THEN 'test' WHEN {b} < {G.TEST_BUCKETS + G.VALIDATION_BUCKETS} "
            f"THEN 'validation' ELSE 'train' END")


HASH_MANIFEST = f"""mf AS (SELECT ID, {_split_case(sql_hex_bucket("('42|' || predictor_group_id)", G.BUCKETS))} AS split,
  target, predictor_group_id FROM pg)"""


def _groups(spark, sf_dir):
    return G.with_group_id(part_groups(spark, sf_dir), list(PART_PREDICTORS))


@register("group_id", f"WITH {PG} SELECT ID, target, predictor_group_id FROM pg")
def q_group_id(spark, sf_dir):
    return _groups(spark, sf_dir).select("ID", "target", "predictor_group_id")


@register("duplicate_group_audit", f"""WITH {PG},
g AS (SELECT predictor_group_id, COUNT(*) AS n, COUNT(DISTINCT target) AS nt FROM pg GROUP BY 1)
SELECT CAST(SUM(n) AS BIGINT) AS total_rows, CAST(COUNT(*) AS BIGINT) AS unique_predictor_groups,
  {s_cnt('n > 1')} AS repeated_predictor_groups,
  CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_repeated_predictor_groups,
  {s_cnt('nt > 1')} AS conflicting_target_predictor_groups,
  CAST(COALESCE(SUM(n) FILTER (WHERE nt > 1), 0) AS BIGINT) AS rows_in_conflicting_target_groups,
  CAST(MAX(n) AS BIGINT) AS maximum_predictor_group_size FROM g""")
def q_duplicate_group_audit(spark, sf_dir):
    return G.duplicate_group_audit(_groups(spark, sf_dir))


@register("stratified_group_split", f"WITH {PG}, {HASH_MANIFEST} SELECT * FROM mf")
def q_stratified_group_split(spark, sf_dir):
    return G.stratified_group_split(_groups(spark, sf_dir), mode="hash")


RANKED_MANIFEST = f"""grp AS (SELECT predictor_group_id, SUM(CAST(target AS BIGINT)) AS pos, COUNT(*) AS size FROM pg GROUP BY 1),
r AS (SELECT predictor_group_id, pos, size, ROW_NUMBER() OVER (PARTITION BY pos, size
        ORDER BY md5('42|' || predictor_group_id) || '|' || predictor_group_id) - 1 AS rk FROM grp),
mf AS (SELECT ID, {_split_case(f"((rk + {sql_hex_bucket(chr(39) + '42|' + chr(39) + ' || CAST(pos AS VARCHAR) || ' + chr(39) + '|' + chr(39) + ' || CAST(size AS VARCHAR)', G.BUCKETS)}) % {G.BUCKETS})")} AS split,
  target, pg.predictor_group_id FROM pg JOIN r ON pg.predictor_group_id = r.predictor_group_id)"""


@register("stratified_group_split_ranked", f"WITH {PG}, {RANKED_MANIFEST} SELECT * FROM mf")
def q_stratified_group_split_ranked(spark, sf_dir):
    return G.stratified_group_split(_groups(spark, sf_dir), mode="ranked")


def _summary_sql(manifest_cte: str) -> str:
    return f"""WITH {PG}, {manifest_cte},
g AS (SELECT split, COUNT(*) AS total_count, {s_cnt('target = 1')} AS dc, COUNT(DISTINCT predictor_group_id) AS ug
      FROM mf GROUP BY split),
d AS (SELECT * FROM (VALUES ('train'), ('validation'), ('test')) AS s(split)),
j AS (SELECT d.split, COALESCE(total_count, 0) AS tot, COALESCE(dc, 0) AS dc, COALESCE(ug, 0) AS ug
      FROM d LEFT JOIN g ON d.split = g.split)
SELECT split, CAST(tot AS BIGINT) AS total_count, CAST(tot - dc AS BIGINT) AS non_default_count,
  CAST(dc AS BIGINT) AS default_count, COALESCE({s_ratio('dc', 'tot')}, 0.0) AS default_rate,
  {s_pct0('tot', 'SUM(tot) OVER ()')} AS population_percentage, CAST(ug AS BIGINT) AS unique_predictor_groups
FROM j"""


@register("split_summary", _summary_sql(HASH_MANIFEST))
def q_split_summary(spark, sf_dir):
    return G.split_summary(G.stratified_group_split(_groups(spark, sf_dir), mode="hash"))


@register("split_summary_ranked", _summary_sql(RANKED_MANIFEST))
def q_split_summary_ranked(spark, sf_dir):
    return G.split_summary(G.stratified_group_split(_groups(spark, sf_dir), mode="ranked"))


@register("id_fingerprint", f"""WITH {PG}, {HASH_MANIFEST},
h AS (SELECT CAST(('0x' || substr(md5(concat_ws(',', COALESCE(CAST(ID AS VARCHAR), 'nan'),
        COALESCE(CAST(target AS VARCHAR), 'nan'))), 1, 15)) AS BIGINT) AS h FROM mf),
a AS (SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(COALESCE(SUM(CAST(h AS DECIMAL(38,0))), 0) AS DECIMAL(38,0)) AS sum_h,
        CAST(COALESCE(BIT_XOR(h), 0) AS BIGINT) AS xor_h FROM h)
SELECT n, sum_h, xor_h, sha256(concat_ws(':', CAST(n AS VARCHAR), CAST(sum_h AS VARCHAR), CAST(xor_h AS VARCHAR))) AS fingerprint
FROM a""")
def q_id_fingerprint(spark, sf_dir):
    return G.id_fingerprint(G.stratified_group_split(_groups(spark, sf_dir), mode="hash"), ["ID", "target"])


@register("group_collisions", f"""WITH {PG},
g AS (SELECT predictor_group_id, COUNT(*) AS nv FROM (SELECT DISTINCT predictor_group_id, p_brand, p_size, p_type FROM pg)
      GROUP BY 1)
SELECT CAST(COUNT(*) AS BIGINT) AS groups, {s_cnt('nv > 1')} AS colliding_groups FROM g""")
def q_group_collisions(spark, sf_dir):
    return G.group_collisions(_groups(spark, sf_dir), list(PART_PREDICTORS))


def manifest_checks_sql(ctes: str, manifest: str, raw: str) -> str:
    """SQL of ``split.verify_manifest``: ``manifest`` has (ID, split, target, predictor_group_id),
    ``raw`` has (ID, raw_t, raw_g) with recomputed group ids."""
    return f"""WITH {ctes},
mfc AS ({manifest}), raw AS ({raw}),
j AS (SELECT mfc.split, mfc.target, mfc.predictor_group_id, raw.raw_t, raw.raw_g FROM mfc FULL OUTER JOIN raw ON mfc.ID = raw.ID),
a AS (SELECT {s_cnt('split IS NULL OR raw_t IS NULL')} AS one_side,
        {s_cnt('target IS DISTINCT FROM raw_t')} AS tm, {s_cnt('predictor_group_id IS DISTINCT FROM raw_g')} AS gm,
        {s_cnt("split IS NOT NULL AND split NOT IN ('train', 'validation', 'test')")} AS bad_label FROM j),
per_id AS (SELECT ID, COUNT(*) AS n FROM mfc GROUP BY ID),
per_g AS (SELECT predictor_group_id, COUNT(DISTINCT split) AS ns FROM mfc GROUP BY predictor_group_id)
SELECT 'manifest_schema_exact' AS check_name, TRUE AS passed, 'ID,split,target,predictor_group_id' AS detail
UNION ALL SELECT 'population_equal', one_side = 0, printf('%d ids on one side only', one_side) FROM a
UNION ALL SELECT 'targets_equal', tm = 0, printf('%d target mismatches', tm) FROM a
UNION ALL SELECT 'group_ids_equal', gm = 0, printf('%d group id mismatches', gm) FROM a
UNION ALL SELECT 'split_labels_valid', bad_label = 0, printf('%d unknown labels', bad_label) FROM a
UNION ALL SELECT 'ids_unique', COALESCE(MAX(n) <= 1, FALSE), printf('max rows per id %d', MAX(n)) FROM per_id
UNION ALL SELECT 'groups_disjoint_across_splits', {s_cnt('ns > 1')} = 0, printf('%d groups in several splits', {s_cnt('ns > 1')}) FROM per_g"""


MANIFEST_CHECKS_SQL = manifest_checks_sql(f"{PG}, {HASH_MANIFEST}", "SELECT * FROM mf",
                                          "SELECT ID, target AS raw_t, predictor_group_id AS raw_g FROM pg")


@register("manifest_checks", MANIFEST_CHECKS_SQL)
def q_manifest_checks(spark, sf_dir):
    raw = part_groups(spark, sf_dir)
    manifest = G.stratified_group_split(_groups(spark, sf_dir), mode="hash")
    return G.verify_manifest(manifest, raw, "ID", "target", list(PART_PREDICTORS))
