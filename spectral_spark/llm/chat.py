"""Chat formatting in DataFrame operations: logged snapshots that begin a longer conversation go, the rest are rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
KEY = ["n", "k1", "k2", "k3", "k4"]


def _turns(chats: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, lone, turn, role, text, ha, hb): lone names a row without an id by its hashes, as it is a conversation of its own; null for others."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    out = chats.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    out = out.withColumn("ha", F.xxhash64(F.lit(1), "role", "text")).withColumn("hb", F.xxhash64(F.lit(2), "text", "role"))
    return out.withColumn("lone", F.when(F.col("conv").isNull(), F.concat_ws(":", F.col("ha").cast("string"), F.col("hb").cast("string"))))


def prefix_keys(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, lone, n, k1..k4, total): for each turn the rolling hash of its conversation up to it, and the number of turns in all.

    The hash is the running sum of two 64-bit hashes of (position, role, text), in 32-bit halves: 128 bits that depend on
    the order, and that a window adds up without gathering a conversation's texts.
    """
    by = Window.partitionBy("conv")
    order = by.orderBy("turn", "ha", "hb")
    turns = _turns(chats, conv, turn, role, text).select("conv", "lone", "turn", "ha", "hb")
    a, b = F.xxhash64("n", "ha"), F.xxhash64("hb", "n")
    halves = {"k1": F.shiftrightunsigned(a, 32), "k2": a.bitwiseAND(F.lit(0xFFFFFFFF)), "k3": F.shiftrightunsigned(b, 32), "k4": b.bitwiseAND(F.lit(0xFFFFFFFF))}
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    named = turns.where("conv is not null").withColumn("n", F.row_number().over(order))
    named = named.select("conv", "lone", "n", *[F.sum(v).over(running).alias(k) for k, v in halves.items()], F.count(F.lit(1)).over(by).alias("total"))
    lone = turns.where("conv is null").withColumn("n", F.lit(1))
    return named.unionByName(lone.select("conv", "lone", "n", *[v.alias(k) for k, v in halves.items()], F.lit(1).cast("long").alias("total")))


def render(turns: Column) -> Column:
    """Text of turns in order; a marker inside a text is broken up so that it cannot open or close a turn."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), F.replace(t["text"], F.lit("<|"), F.lit("< |")), F.lit(CLOSE + "\n"))), "")


def format_chats(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation that begins no longer one: conv_id, n_turns, copies, text.

    Conversations are compared turn by turn, role and text exactly; of equal ones that with the smallest id stays and
    copies counts them. Turns go by number, equal numbers by the hashes of role and text; repeated rows are turns of their own. A null
    role or text counts as empty; a row with a null id belongs to no other and is a conversation of one turn. Other columns
    are ignored; an empty table gives an empty result. Rendering makes one text of a conversation, so a task holds one
    conversation's turns.
    """
    keys = stash(prefix_keys(chats, conv, turn, role, text), "prefixes")
    whole = keys.where("n = total").groupBy(*KEY).agg(F.min("conv").alias("conv"), F.min("lone").alias("lone"), F.count(F.lit(1)).alias("copies"))
    begun = keys.where("n < total").select(*KEY).distinct()
    kept = stash(whole.join(begun, KEY, "left_anti").select(F.col("conv").alias("kept"), F.when(F.col("conv").isNull(), F.col("lone")).alias("kept_lone"), F.col("n").alias("n_turns"), "copies"), "kept")
    all_turns = _turns(chats, conv, turn, role, text)
    named = all_turns.where("conv is not null").join(kept.where("kept is not null"), F.col("conv") == F.col("kept"))
    lone = all_turns.where("conv is null").dropDuplicates(["lone"]).join(kept.where("kept is null"), F.col("lone") == F.col("kept_lone"))
    listed = F.array_sort(F.collect_list(F.struct("turn", "ha", "hb", "role", "text")))
    out = named.unionByName(lone).groupBy("kept", "kept_lone", "n_turns", "copies").agg(listed.alias("turns"))
    return out.select(F.col("kept").alias("conv_id"), F.col("n_turns").cast("long").alias("n_turns"), F.col("copies").cast("long").alias("copies"), render(F.col("turns")).alias("text"))


ORACLE = f"""
WITH c AS (SELECT any_value(conv_id) AS conv_id, list(coalesce(role, '') || chr(31) || coalesce(text, '') ORDER BY turn) AS l,
  string_agg('{OPEN}' || coalesce(role, '') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '{CLOSE}' || chr(10), '' ORDER BY turn) AS t FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM conversations) GROUP BY conv_id, lone),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM c))
SELECT min(conv_id) AS conv_id, len(l)::BIGINT AS n_turns, count(*)::BIGINT AS copies, any_value(t) AS text
FROM c WHERE l NOT IN (SELECT l FROM p) GROUP BY l
"""
