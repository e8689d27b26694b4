"""Status-sequence queries (Q*) on the customer-year panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import status as Q
from panelkit.plans.catalog import register
from panelkit.plans.sql import PANEL_CTE, panel_long, panel_pairs, s_cnt, s_pct, s_ratio, sql_rnd
from panelkit.session import track
from panelkit.sources.testdata import PANEL_SPEC, YEARS, customer_panel
from panelkit.spec import DOCUMENTED, DOCUMENTED_STATUS_CODES, KNOWN_STATUS_CODES, UNDOCUMENTED

R = lambda e: sql_rnd(e, 6)
CODES_SQL = "(VALUES " + ", ".join(f"({c})" for c in KNOWN_STATUS_CODES) + ")"
PER_SQL = "(VALUES " + ", ".join(f"({i}, '{y}', 'status_{i + 1}')" for i, y in enumerate(YEARS)) + \
    ") AS per(mi, period, raw_column_name)"
DOC = f"CASE WHEN code IN ({', '.join(str(c) for c in DOCUMENTED_STATUS_CODES)}) THEN '{DOCUMENTED}' ELSE '{UNDOCUMENTED}' END"
LONG = f"{PANEL_CTE}, long AS (SELECT t - 1 AS mi, target AS y, status AS code FROM ({panel_long(('status',))}))"
SEQ = "concat_ws('|', " + ", ".join(f"COALESCE(CAST(status_{i} AS VARCHAR), 'nan')" for i in range(1, len(YEARS) + 1)) + ")"


STATUS_BY_PERIOD_SQL = f"""
WITH {LONG},
g AS (SELECT mi, code, COUNT(*) AS total_count, {s_cnt('y = 1')} AS dc, {s_cnt('y = 0')} AS ndc FROM long GROUP BY mi, code),
dom AS (SELECT per.mi, c.code FROM {PER_SQL}, {CODES_SQL} AS c(code)),
j AS (SELECT COALESCE(dom.mi, g.mi) AS mi, COALESCE(dom.code, g.code) AS code, total_count, dc, ndc
      FROM dom FULL OUTER JOIN g ON dom.mi = g.mi AND dom.code = g.code),
k AS (SELECT j.*, per.period, per.raw_column_name, COALESCE(total_count, 0) AS tot,
        SUM(COALESCE(total_count, 0)) OVER (PARTITION BY j.mi) AS n FROM j JOIN {PER_SQL} ON j.mi = per.mi)
SELECT raw_column_name, period, CAST(mi AS BIGINT) AS chronological_month_index, CAST(code AS BIGINT) AS raw_status_value,
  CAST(tot AS BIGINT) AS total_count, CASE WHEN tot > 0 THEN {R(s_pct('tot', 'n'))} END AS population_percentage,
  CAST(COALESCE(dc, 0) AS BIGINT) AS default_count, CAST(COALESCE(ndc, 0) AS BIGINT) AS non_default_count,
  CASE WHEN tot > 0 THEN {R(s_ratio('dc', 'tot'))} END AS default_rate, tot > 0 AS observed_combination,
  {DOC} AS documentation_status, CASE WHEN tot > 0 THEN tot < 200 ELSE FALSE END AS small_sample_warning
FROM k"""


@register("status_by_period", STATUS_BY_PERIOD_SQL)
def q_status_by_period(spark, sf_dir):
    return Q.status_by_period(customer_panel(spark, sf_dir), PANEL_SPEC)


BY_TARGET_SQL = f"""
WITH {LONG},
g AS (SELECT mi, y, code, COUNT(*) AS cnt FROM long GROUP BY ALL),
cl AS (SELECT mi, y, COUNT(*) AS class_total FROM long GROUP BY ALL),
dom AS (SELECT per.*, yy.y, c.code FROM {PER_SQL}, (VALUES (0), (1)) AS yy(y), {CODES_SQL} AS c(code))
SELECT raw_column_name, period, CAST(dom.mi AS BIGINT) AS chronological_month_index, CAST(dom.y AS BIGINT) AS target_class,
  CAST(dom.code AS BIGINT) AS raw_status_value, CAST(COALESCE(cnt, 0) AS BIGINT) AS status_count,
  CASE WHEN COALESCE(cnt, 0) > 0 THEN {R(s_pct('cnt', 'class_total'))} END AS percentage_within_target_class,
  COALESCE(cnt, 0) > 0 AS observed_combination
FROM dom LEFT JOIN g ON dom.mi = g.mi AND dom.y = g.y AND dom.code = g.code LEFT JOIN cl ON dom.mi = cl.mi AND dom.y = cl.y"""


@register("status_by_period_target", BY_TARGET_SQL)
def q_status_by_period_target(spark, sf_dir):
    return Q.status_by_period_target(customer_panel(spark, sf_dir), PANEL_SPEC)


PAIRS_DOM = "(VALUES " + ", ".join(f"({i}, '{YEARS[i]}', '{YEARS[i + 1]}')" for i in range(len(YEARS) - 1)) + \
    ") AS pr(pi, source_period, destination_period)"


TRANSITIONS_SQL = f"""
WITH {PANEL_CTE}, pairs AS (SELECT pair_index - 1 AS pi, target AS y, src, dst FROM ({panel_pairs('status')})),
g AS (SELECT pi, src, dst, COUNT(*) AS cnt, {s_cnt('y = 1')} AS dc, {s_cnt('y = 0')} AS ndc FROM pairs GROUP BY ALL),
st AS (SELECT pi, src, COUNT(*) AS source_status_total FROM pairs GROUP BY ALL),
dom AS (SELECT pr.*, s.src, d.dst FROM {PAIRS_DOM}, {CODES_SQL} AS s(src), {CODES_SQL} AS d(dst)),
j AS (SELECT dom.*, COALESCE(cnt, 0) AS c, COALESCE(source_status_total, 0) AS stt, dc, ndc FROM dom
      LEFT JOIN g ON dom.pi = g.pi AND dom.src = g.src AND dom.dst = g.dst
      LEFT JOIN st ON dom.pi = st.pi AND dom.src = st.src)
SELECT source_period, destination_period, CAST(pi AS BIGINT) AS chronological_pair_index,
  CAST(src AS BIGINT) AS source_raw_status, CAST(dst AS BIGINT) AS destination_raw_status,
  CAST(stt AS BIGINT) AS source_status_total, CAST(c AS BIGINT) AS transition_count,
  {R(s_pct('c', 'stt'))} AS percentage_within_source_status, CAST(COALESCE(dc, 0) AS BIGINT) AS default_count,
  CAST(COALESCE(ndc, 0) AS BIGINT) AS non_default_count, CASE WHEN c > 0 THEN {R(s_ratio('dc', 'c'))} END AS default_rate,
  c > 0 AS observed_combination, CASE WHEN c > 0 THEN c < 200 ELSE FALSE END AS small_sample_warning
FROM j"""


@register("status_transitions", TRANSITIONS_SQL)
def q_status_transitions(spark, sf_dir):
    return Q.status_transitions(customer_panel(spark, sf_dir), PANEL_SPEC)


PATTERNS_CTE = f"""{PANEL_CTE},
pt AS (SELECT {SEQ} AS sequence_pattern, COUNT(*) AS total_count, {s_cnt('target = 1')} AS default_count,
         {s_cnt('target = 0')} AS non_default_count FROM panel GROUP BY 1),
pats AS (SELECT sequence_pattern, CAST(total_count AS BIGINT) AS total_count,
  {R(s_pct('total_count', '(SELECT COUNT(*) FROM panel)'))} AS population_percentage, default_count, non_default_count,
  {R(s_ratio('default_count', 'total_count'))} AS default_rate, total_count > 0 AS observed_combination,
  total_count < 200 AS small_sample_warning FROM pt)"""


@register("sequence_patterns", f"WITH {PATTERNS_CTE} SELECT * FROM pats")
def q_sequence_patterns(spark, sf_dir):
    return Q.sequence_patterns(customer_panel(spark, sf_dir), PANEL_SPEC)


def _top_sql(by: str) -> str:
    return f"""WITH {PATTERNS_CTE}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY {by} DESC, sequence_pattern ASC) AS BIGINT) AS rank, *
FROM pats ORDER BY {by} DESC, sequence_pattern ASC LIMIT 10"""


@register("top_sequences", _top_sql("total_count"))
def q_top_sequences(spark, sf_dir):
    return Q.top_sequences(Q.sequence_patterns(customer_panel(spark, sf_dir), PANEL_SPEC), 10, "total_count")


@register("top_sequences_by_default", _top_sql("default_count"))
def q_top_sequences_by_default(spark, sf_dir):
    return Q.top_sequences(Q.sequence_patterns(customer_panel(spark, sf_dir), PANEL_SPEC), 10, "default_count")


ORACLE_MODAL = f"""
WITH q4 AS ({BY_TARGET_SQL.strip()}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY chronological_month_index, target_class
        ORDER BY percentage_within_target_class DESC NULLS LAST, raw_status_value ASC) AS rn FROM q4)
SELECT period, chronological_month_index, target_class, raw_status_value, status_count, percentage_within_target_class
FROM r WHERE rn = 1"""


@register("modal_status", ORACLE_MODAL)
def q_modal_status(spark, sf_dir):
    return Q.modal_status(Q.status_by_period_target(customer_panel(spark, sf_dir), PANEL_SPEC))


@register("sequence_coverage", f"""
WITH {PATTERNS_CTE},
lg AS (SELECT status AS code FROM ({panel_long(('status',))})),
top AS (SELECT total_count FROM pats ORDER BY total_count DESC, sequence_pattern ASC LIMIT 10)
SELECT (SELECT {s_cnt('code = 0')} FROM lg) AS code_0_total, (SELECT {s_cnt('code = -2')} FROM lg) AS code_minus2_total,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM pats) AS distinct_patterns,
  (SELECT CAST(COALESCE(SUM(total_count), 0) AS BIGINT) FROM top) AS topk_count,
  {R(s_pct('(SELECT SUM(total_count) FROM top)', '(SELECT COUNT(*) FROM panel)'))} AS topk_percentage""")
def q_sequence_coverage(spark, sf_dir):
    return Q.sequence_coverage(customer_panel(spark, sf_dir), PANEL_SPEC)


def _matrix_sql() -> str:
    parts = []
    for measure in Q.MATRIX_MEASURES:
        cols = ", ".join(f"MAX(CASE WHEN period = '{y}' THEN {measure} END) AS \"{y}\"" for y in YEARS)
        parts.append(f"SELECT '{measure}' AS measure, raw_status_value, {cols} FROM q2 GROUP BY raw_status_value")
    return f"WITH q2 AS ({STATUS_BY_PERIOD_SQL.strip()}) {' UNION ALL '.join(parts)}"


@register("status_matrix", _matrix_sql())
def q_status_matrix(spark, sf_dir):
    """Q10: status x period, for the population share and for the default rate."""
    q2 = track(Q.status_by_period(customer_panel(spark, sf_dir), PANEL_SPEC))
    parts = [Q.status_matrix(q2, PANEL_SPEC, m).select(F.lit(m).alias("measure"), "*") for m in Q.MATRIX_MEASURES]
    return parts[0].unionByName(parts[1])


@register("status_default_rates", f"""
WITH q2 AS ({STATUS_BY_PERIOD_SQL.strip()})
SELECT period, chronological_month_index, raw_status_value, total_count, default_count, default_rate,
  observed_combination, small_sample_warning FROM q2""")
def q_status_default_rates(spark, sf_dir):
    """Q3: the default-rate projection of the status distribution."""
    return Q.status_by_period(customer_panel(spark, sf_dir), PANEL_SPEC).select(
        "period", "chronological_month_index", "raw_status_value", "total_count", "default_count", "default_rate",
        "observed_combination", "small_sample_warning")


def _transition_matrix_sql() -> str:
    cols = ", ".join(f"MAX(CASE WHEN destination_raw_status = {c} THEN percentage_within_source_status END) AS \"{c}\""
                     for c in KNOWN_STATUS_CODES)
    return (f"WITH q5 AS ({TRANSITIONS_SQL.strip()}) SELECT chronological_pair_index, source_raw_status, {cols} FROM q5 "
            f"GROUP BY 1, 2")


@register("transition_matrix", _transition_matrix_sql())
def q_transition_matrix(spark, sf_dir):
    """Q10: source x destination % matrices of all adjacent pairs."""
    return Q.transition_matrices(Q.status_transitions(customer_panel(spark, sf_dir), PANEL_SPEC), PANEL_SPEC)


@register("event_sequence_patterns", f"""
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
p AS (SELECT user_id, string_agg(event_type, '|' ORDER BY ts, event_id) AS sequence_pattern FROM r WHERE rn <= 4
      GROUP BY user_id),
t AS (SELECT user_id, MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS target FROM events GROUP BY user_id),
g AS (SELECT sequence_pattern, COUNT(*) AS total_count, {s_cnt('target = 1')} AS default_count,
        {s_cnt('target = 0')} AS non_default_count FROM p JOIN t ON p.user_id = t.user_id GROUP BY 1)
SELECT sequence_pattern, CAST(total_count AS BIGINT) AS total_count,
  {R(s_pct('total_count', '(SELECT COUNT(*) FROM p)'))} AS population_percentage, default_count, non_default_count,
  {R(s_ratio('default_count', 'total_count'))} AS default_rate, total_count > 0 AS observed_combination,
  total_count < 200 AS small_sample_warning FROM g""")
def q_event_sequence_patterns(spark, sf_dir):
    """Q6 on event streams: last 4 event types per user (by ts, event_id); target = user ever hit an error."""
    from pyspark.sql import functions as F

    from panelkit.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events")
    pats = Q.last_k_patterns(ev, "user_id", ["ts", "event_id"], "event_type", 4)
    tgt = ev.groupBy("user_id").agg(F.max((F.col("event_type") == "error").cast("int")).alias("target"))
    return Q.pattern_summary(pats.join(tgt, "user_id"), "target")
