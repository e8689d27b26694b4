"""Regression anchors (C6): an expected value, a second algorithm's and the pipeline's, side by side.

The second algorithm of :func:`direct_amounts` shares nothing with the operators: it is SQL text
over the wide panel with Spark's own ``percentile`` and conditional counts, no long form, no value counts, no rank search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators import amounts as M
from panelkit.session import stored
from panelkit.spec import AmountPolicy, PanelSpec

TOLERANCE, RELATIVE = 1e-5, 1e-5
FIELDS = ("count", "mean", "p25", "median", "p75", "iqr", "negative_count", "zero_count", "positive_count", "total_potential_extreme_count")
CHANGES = ("mean_change", "median_change", "negative_change_count", "zero_change_count", "positive_change_count")


def matches(expected: Column, value: Column, kind: Column, tolerance: Column) -> Column:
    """Both null; counts exactly equal; reals within the absolute tolerance and a hundred-thousandth of the value.  NaN is null."""
    a, b = (F.when(~F.isnan(c), c) for c in (expected, value))
    near = F.abs(a - b) <= tolerance + F.lit(RELATIVE) * F.abs(b)
    return (a.isNull() & b.isNull()) | F.coalesce(F.when(kind == "count", a == b).otherwise(near), F.lit(False))


def compare(expected: DataFrame, direct: DataFrame, pipeline: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(anchor_name, value) frames -> one row an anchor with both comparisons.

    ``expected`` may have a ``kind`` column (``count`` or ``real``; by default names that end in ``count`` are counts).
    An anchor that any side lacks does not pass, whatever the others say.
    """
    kind = F.col("kind") if "kind" in expected.columns else F.when(F.col("anchor_name").endswith("count"), "count").otherwise("real")
    e = expected.select("anchor_name", F.col("value").cast("double").alias("expected_value"), kind.alias("kind"), F.lit(True).alias("_e"))
    d = direct.select("anchor_name", F.col("value").cast("double").alias("direct_value"), F.lit(True).alias("_d"))
    p = pipeline.select("anchor_name", F.col("value").cast("double").alias("pipeline_value"), F.lit(True).alias("_p"))
    j = e.join(d, "anchor_name", "full_outer").join(p, "anchor_name", "full_outer")  # one row an anchor
    there = F.col("_e").isNotNull() & F.col("_d").isNotNull() & F.col("_p").isNotNull()
    tol = F.lit(float(tolerance))
    one = F.col("_e").isNotNull() & F.col("_d").isNotNull() & matches(F.col("expected_value"), F.col("direct_value"), F.col("kind"), tol)
    two = F.col("_e").isNotNull() & F.col("_p").isNotNull() & matches(F.col("expected_value"), F.col("pipeline_value"), F.col("kind"), tol)
    j = j.select("anchor_name", "expected_value", "direct_value", "pipeline_value", tol.alias("absolute_tolerance"),
                 one.alias("direct_matches_expected"), two.alias("pipeline_matches_expected"), there.alias("_there"))
    return j.select(*j.columns[:-1], (F.col("_there") & F.col("direct_matches_expected") & F.col("pipeline_matches_expected")).alias("passed"))


def named(df: DataFrame, prefix: Column, columns: tuple[str, ...]) -> DataFrame:
    """One (anchor_name, value) row for each of the columns of a small table."""
    return df.select(F.inline(F.array(*[F.struct(F.concat(prefix, F.lit(f"_{c}")).alias("anchor_name"), F.col(c).cast("double").alias("value")) for c in columns])))


def pipeline_amounts(panel: DataFrame, spec: PanelSpec, channel: str, policy: AmountPolicy) -> DataFrame:
    """The operators' values: first and last period, last change, global display range."""
    ends = [spec.periods[0], spec.periods[-1]]
    s = M.panel_summary(panel, spec, channel, policy).where(F.col("period").isin(ends))
    c = M.adjacent_change(panel, spec, channel, policy).where(F.col("destination_period") == spec.periods[-1])
    d = M.display_range(panel, spec, channel).where("chronological_index = 0").withColumnsRenamed(
        {"global_low_percentile": "low_percentile", "global_high_percentile": "high_percentile"})
    return (named(s, F.col("period"), FIELDS).unionByName(named(c, F.lit("last"), CHANGES))
            .unionByName(named(d, F.lit("global"), ("total_count", "low_percentile", "high_percentile", "below_range_count", "above_range_count", "outside_range_count"))))


def refined_quantiles(panel: DataFrame, wanted: dict[str, tuple[str | tuple[str, ...], float]], scale: int = 100, cells: int = 4096,
                      whole: bool = False) -> dict[str, float | None]:
    """Exact linear quantiles by refining histograms: name -> (SQL expression, probability); several expressions are taken together.

    Values are whole multiples of 1 / ``scale``; with ``whole`` the expressions are BIGINTs, already multiplied.  Each round counts, once for each
    interval that is known to hold ranks looked for, the values in ``cells`` equal cells of it, so a rank's interval shrinks to one value in a few
    scans; each scan is one partial aggregation and brings back at most ranks x cells counts, whatever the number of rows.

    ``panel`` becomes a view for each scan, and with its view goes the cache of a frame: don't hand over one that is to stay cached.
    """
    spark, times = panel.sparkSession, 1 if whole else scale
    wanted = {name: ((x,) if isinstance(x, str) else tuple(x), p) for name, (x, p) in wanted.items()}
    taken = {xs: k for k, xs in enumerate(dict.fromkeys(xs for xs, _ in wanted.values()))}

    def least(what: str, xs: tuple[str, ...]) -> str:
        found = [f"{what}({x})" for x in xs]
        return found[0] if len(found) == 1 else f"{'least' if what == 'min' else 'greatest'}({', '.join(found)})"

    ends = ", ".join(f"{least('min', xs)} AS a{k}, {least('max', xs)} AS b{k}, {' + '.join(f'count({x})' for x in xs)} AS n{k}" for xs, k in taken.items())
    row = spark.sql(f"SELECT {ends} FROM {{panel}}", panel=panel).first()
    size = {name: row[f"n{taken[xs]}"] for name, (xs, _) in wanted.items()}
    search, out = {}, {}
    for name, (xs, p) in wanted.items():
        if not size[name]:
            out[name] = None
            continue
        pos = p * (size[name] - 1)
        for rank in {int(pos // 1), -int(-pos // 1)}:
            search[name, rank] = [xs, int(row[f"a{taken[xs]}"] * times), int(row[f"b{taken[xs]}"] * times), rank]  # rank counts from the interval's start
    while any(low < high for _, low, high, _ in search.values()):
        # ranks that lie in the same interval of the same values share its counts
        todo = {v: j for j, v in enumerate(dict.fromkeys((xs, low, high) for xs, low, high, _ in search.values() if low < high))}
        values = {x: f"v{k}" for k, x in enumerate(dict.fromkeys(x for xs, _, _ in todo for x in xs))}
        parts = []
        for (xs, low, high), j in todo.items():
            width = -(-(high - low + 1) // cells)
            parts += [f"CASE WHEN {values[x]} BETWEEN {low} AND {high} THEN struct({j} AS j, ({values[x]} - {low}) DIV {width} AS cell) END" for x in xs]
        each = ", ".join(f"CAST(({x}) * {times} AS BIGINT) AS {v}" for x, v in values.items())
        counts = spark.sql(f"""SELECT c.j AS j, c.cell AS cell, count(*) AS n FROM (SELECT explode(array({', '.join(parts)})) AS c FROM (SELECT {each} FROM {{panel}}))
                               WHERE c IS NOT NULL GROUP BY c.j, c.cell""", panel=panel).collect()
        found: dict[int, list] = {}
        for r in counts:
            found.setdefault(r["j"], []).append((r["cell"], r["n"]))
        for item in search.values():
            xs, low, high, rank = item
            if low == high:
                continue
            width = -(-(high - low + 1) // cells)
            for cell, n in sorted(found[todo[xs, low, high]]):
                if rank < n:
                    item[1:] = [low + cell * width, min(high, low + (cell + 1) * width - 1), rank]
                    break
                rank -= n
    for name, (_, p) in wanted.items():
        if name in out:
            continue
        pos = p * (size[name] - 1)
        low, high = int(pos // 1), -int(-pos // 1)
        a, b = search[name, low][1] / scale, search[name, high][1] / scale
        out[name] = a + (b - a) * (pos - low)
    return out


def direct_amounts(panel: DataFrame, spec: PanelSpec, channel: str, scale: int = 100) -> DataFrame:
    """The same figures by another way: SQL text over the wide columns, quantiles by refined histograms.

    The columns are stored beside the multiplied values, so the scans build no panel and multiply no decimals, and a cached ``panel`` stays cached.
    """
    cols, spark = spec.columns(channel), panel.sparkSession
    last = f"({cols[-1]} - {cols[-2]})"
    whole = {x: f"_whole_{k}" for k, x in enumerate((*cols, last))}
    panel = stored(panel.selectExpr(*cols, *[f"CAST(({x}) * {scale} AS BIGINT) AS {v}" for x, v in whole.items()]), "anchor-values")
    flat = spark.sql(f"SELECT explode(array({', '.join(cols)})) AS x FROM {{panel}}", panel=panel)
    ends = {spec.periods[0]: cols[0], spec.periods[-1]: cols[-1]}
    wanted = {f"{name}_{q}": (whole[x], p) for name, x in ends.items() for q, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))}
    everywhere = tuple(whole[c] for c in cols)
    q = refined_quantiles(panel, {**wanted, "last_median_change": (whole[last], 0.5), "low": (everywhere, 0.01), "high": (everywhere, 0.99)}, scale, whole=True)

    def number(v: float | None) -> str:
        return "CAST(NULL AS DOUBLE)" if v is None else f"{v!r}D"

    def signs(prefix: str, x: str, suffix: str) -> list[tuple[str, str]]:
        return [(f"{prefix}_{sign}{suffix}_count", f"count_if({x} {op} 0)") for sign, op in (("negative", "<"), ("zero", "="), ("positive", ">"))]

    fields = []
    for name, x in ends.items():
        lo, mid, hi = (q[f"{name}_{k}"] for k in ("p25", "median", "p75"))
        iqr = None if lo is None else hi - lo
        out = "false" if iqr is None else f"CAST({x} AS DOUBLE) < {number(lo - 1.5 * iqr)} OR CAST({x} AS DOUBLE) > {number(hi + 1.5 * iqr)}"
        fields += [(f"{name}_count", f"count({x})"), (f"{name}_mean", f"avg(CAST({x} AS DOUBLE))"), (f"{name}_p25", number(lo)), (f"{name}_median", number(mid)),
                   (f"{name}_p75", number(hi)), (f"{name}_iqr", number(iqr)), *signs(name, x, ""), (f"{name}_total_potential_extreme_count", f"count_if({out})")]
    fields += [("last_mean_change", f"avg(CAST({last} AS DOUBLE))"), ("last_median_change", number(q["last_median_change"])), *signs("last", last, "_change")]
    low, high = (number(q[k]) for k in ("low", "high"))
    world = [("global_total_count", "count(x)"), ("global_low_percentile", low), ("global_high_percentile", high), ("global_below_range_count", f"count_if(CAST(x AS DOUBLE) < {low})"),
             ("global_above_range_count", f"count_if(CAST(x AS DOUBLE) > {high})"), ("global_outside_range_count", f"count_if(CAST(x AS DOUBLE) < {low} OR CAST(x AS DOUBLE) > {high})")]

    def rows(items: list[tuple[str, str]], source: str) -> str:
        structs = ", ".join(f"struct('{n}' AS anchor_name, CAST({v} AS DOUBLE) AS value)" for n, v in items)
        return f"SELECT inline(array({structs})) FROM {source}"

    return spark.sql(f"{rows(fields, '{panel}')} UNION ALL {rows(world, '{flat}')}", panel=panel, flat=flat)
