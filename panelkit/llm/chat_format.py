"""Chat formatting with cumulative snapshots collapsed.

Logs often hold a conversation again and again as it grows.  Each turn extends a rolling hash of the
turns so far; a conversation whose last hash is an inner hash of another one is a snapshot of a longer
log.  Equal conversations are aggregated first (the least id stays), inner hashes are made distinct
before they are dealt, and an anti-join keeps the maximal conversations, which are then rendered.

Turns are ordered by turn (null first), then role, then text; exact repeats of a turn count once.  A
null role is ``unknown``, a null text empty.  Rows with a null conversation id form one conversation
that orders first.  An empty table gives no rows; other columns are ignored.  Markers inside a role or
text are broken by a zero-width space, so no text can open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import order_key

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(c: Column) -> Column:
    return F.replace(c, F.lit("<|im_"), F.lit("<​|im_"))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text>>) in order."""
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_set(row)).alias("turns"))


def chains(logged: DataFrame) -> DataFrame:
    """(conv_id, hashes): the rolling hash after each turn."""
    def step(have: Column, t: Column) -> Column:
        last = F.coalesce(F.try_element_at(have, F.lit(-1)), F.lit(""))
        text = F.concat(last, F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"])
        return F.concat(have, F.array(F.sha2(F.encode(text, "UTF-8"), 256)))
    return logged.select("conv_id", F.aggregate("turns", F.array().cast("array<string>"), step).alias("hashes"))


def maximal(turns: DataFrame) -> DataFrame:
    """(id, n_logs): the least id of each maximal conversation, and how many equal logs there are."""
    rolled = chains(conversations(turns))
    inner = rolled.select(F.explode(F.slice("hashes", F.lit(1), F.size("hashes") - 1)).alias("hash")).distinct()
    whole = rolled.groupBy(F.element_at("hashes", -1).alias("hash")).agg(F.min(order_key("conv_id")).alias("id"), F.count("*").alias("n_logs"))
    return whole.join(inner, "hash", "left_anti").select("id", "n_logs")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_logs, chat): every maximal conversation as marked-up text."""
    shown = F.transform("turns", lambda t: F.concat(F.lit(OPEN), _plain(t["role"]), F.lit("\n"), _plain(t["text"]), F.lit(CLOSE + "\n")))
    logged = conversations(turns).withColumn("id", order_key("conv_id"))
    return logged.join(maximal(turns), "id").select("conv_id", F.size("turns").alias("n_turns"), "n_logs", F.array_join(shown, "").alias("chat"))


#: DuckDB: conversations compared as whole lists of turns, no hashes
SQL = f"""
WITH rows AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
logged AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns FROM rows GROUP BY conv_id),
whole AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_logs FROM logged GROUP BY turns),
inner_ AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM whole)),
kept AS (SELECT * FROM whole WHERE turns NOT IN (SELECT turns FROM inner_))
SELECT conv_id, CAST(len(turns) AS INTEGER) AS n_turns, n_logs,
       array_to_string(list_transform(turns, lambda t: '{OPEN}' || replace(t.role, '<|im_', '<' || chr(8203) || '|im_') || chr(10)
                                      || replace(t.text, '<|im_', '<' || chr(8203) || '|im_') || '{CLOSE}' || chr(10)), '') AS chat
FROM kept
"""
