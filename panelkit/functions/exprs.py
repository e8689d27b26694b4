"""Reusable column expressions (all native, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUND_SCALE = 10


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int) -> Column:
    """Half-up rounding through an exact decimal, identical in Spark and DuckDB.

    Rounding a double directly is engine-specific at exact halves; going through
    DECIMAL(38,10) first makes both engines round the same decimal digits.
    """
    return F.round(col_(c).cast(f"decimal(38,{ROUND_SCALE})"), digits).cast("double")


def sql_rnd(expr: str, digits: int) -> str:
    """SQL text of :func:`rnd` for the oracle queries."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,{ROUND_SCALE})), {digits}) AS DOUBLE)"


def known(c, data_type) -> Column:
    """The value, with NaN as NULL: a missing number is missing however it is written (no-op for other types)."""
    return F.when(~F.isnan(col_(c)), col_(c)) if data_type.typeName() in ("double", "float") else col_(c)


def dbl(c) -> Column:
    return col_(c).cast("double")


def ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(dbl(num), dbl(den))


def pct(num, den) -> Column:
    """100 * num / den; NULL when den is 0."""
    return F.try_divide(dbl(num) * F.lit(100.0), dbl(den))


def pct0(num, den) -> Column:
    """100 * num / den; 0.0 when den is 0 (the reference's ``if n else 0``)."""
    return F.coalesce(pct(num, den), F.lit(0.0))


def count_if(cond: Column) -> Column:
    """Conditional count as BIGINT (NULL conditions count as false)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def sign_label(value, null_is_zero: bool) -> Column:
    """negative / zero / positive.  NULL -> "zero" (bill rule) or NULL (payment rule)."""
    v = col_(value)
    expr = F.when(v < 0, F.lit("negative")).when(v > 0, F.lit("positive"))
    if null_is_zero:
        return expr.otherwise(F.lit("zero"))
    return expr.when(v == 0, F.lit("zero"))


def sign_order(label) -> Column:
    lab = col_(label)
    return F.when(lab == "negative", 0).when(lab == "zero", 1).when(lab == "positive", 2)


def hist_edge(k, lo, hi, n: int) -> Column:
    """numpy.linspace(lo, hi, n+1)[k]: k*step + lo, last edge exactly hi."""
    k = col_(k)
    step = (col_(hi) - col_(lo)) / F.lit(float(n))
    return F.when(k == F.lit(n), col_(hi)).otherwise(k.cast("double") * step + col_(lo))


def hist_bin(value, lo, hi, n: int) -> Column:
    """0-based bin of ``value`` for numpy.histogram edges over [lo, hi]; NULL outside.

    Bins are half-open except the last, which is closed (numpy rule).  A candidate
    from arithmetic is corrected by one step against the exact edges, so it agrees
    with an edge search without a per-row loop.
    """
    v, lo_, hi_ = dbl(value), dbl(lo), dbl(hi)
    step = (hi_ - lo_) / F.lit(float(n))
    raw = F.floor(F.try_divide(v - lo_, step))
    cand = F.least(F.greatest(F.coalesce(raw, F.lit(0)), F.lit(0)), F.lit(n - 1)).cast("int")
    down = v < hist_edge(cand, lo_, hi_, n)
    up = (cand < F.lit(n - 1)) & (v >= hist_edge(cand + 1, lo_, hi_, n))
    fixed = F.when(down, cand - 1).when(up, cand + 1).otherwise(cand)
    return F.when((v >= lo_) & (v <= hi_), fixed)


def sql_hist_edge(k: str, lo: str, hi: str, n: int) -> str:
    return f"(CASE WHEN ({k}) = {n} THEN ({hi}) ELSE CAST(({k}) AS DOUBLE) * ((({hi}) - ({lo})) / {float(n)}) + ({lo}) END)"


def sql_hist_bin(v: str, lo: str, hi: str, n: int) -> str:
    """SQL text of :func:`hist_bin`."""
    step = f"((({hi}) - ({lo})) / {float(n)})"
    raw = f"floor((({v}) - ({lo})) / nullif({step}, 0))"
    cand = f"CAST(least(greatest(coalesce({raw}, 0), 0), {n - 1}) AS INTEGER)"
    return (
        f"(CASE WHEN ({v}) >= ({lo}) AND ({v}) <= ({hi}) THEN "
        f"(CASE WHEN ({v}) < {sql_hist_edge(cand, lo, hi, n)} THEN {cand} - 1 "
        f"WHEN {cand} < {n - 1} AND ({v}) >= {sql_hist_edge(cand + ' + 1', lo, hi, n)} THEN {cand} + 1 "
        f"ELSE {cand} END) END)"
    )


def widen_flat_range(lo, hi) -> tuple[Column, Column]:
    """numpy widens an empty range [x, x] to [x-0.5, x+0.5]."""
    lo_, hi_ = dbl(lo), dbl(hi)
    same = lo_ == hi_
    return F.when(same, lo_ - 0.5).otherwise(lo_), F.when(same, hi_ + 0.5).otherwise(hi_)


def text_of(c) -> Column:
    """Value as text for fingerprints: integral and decimal values keep their digits."""
    return F.coalesce(col_(c).cast("string"), F.lit("nan"))


def group_id(cols: list[str]) -> Column:
    """md5 of the '|'-joined predictor values, columns in alphabetical order (G1)."""
    return F.md5(F.concat_ws("|", *[text_of(c) for c in sorted(cols)]))


def hex_bucket(text: Column, buckets: int) -> Column:
    """Deterministic bucket in [0, buckets) from the first 32 bits of md5(text)."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def sql_hex_bucket(text: str, buckets: int) -> str:
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % {buckets})"


BROADCAST_ROWS = 100_000


def broadcast_small(df, max_rows: int | None = None):
    """Broadcast ``df`` only after proving its size: it is persisted, counted and
    broadcast when it has at most ``max_rows`` rows (default 100k, setting
    ``panelkit.broadcast.maxRows``); otherwise it is returned for a shuffle join."""
    from panelkit.session import track
    limit = max_rows if max_rows is not None else int(
        df.sparkSession.conf.get("panelkit.broadcast.maxRows", str(BROADCAST_ROWS)))
    df = track(df)
    return F.broadcast(df) if df.count() <= limit else df
