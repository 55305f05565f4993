"""Preference formatting: pairs of conversations with their common start rendered once.

A pair has a chosen and a rejected conversation. Their longest common prefix of turns is the prompt; what follows in
each is its completion, with a mask over what the assistant says. Turns stay rows until they are rendered, so that
counting turns and finding the prefix run over joined rows and not over whole conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the chat format.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
#: Turns that are numbered in one go.
CHUNK = 256


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat format. A null role or text counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def _running(rows: DataFrame, keys: list[str], order: list[str], chunk: Column, value: Column, into: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the earlier rows of their group, ``chunk`` growing with ``order``.

    Each chunk of a group is a window of its own; the sums of earlier chunks come from a small table. A very long
    conversation so runs in many tasks.
    """
    rows = rows.withColumn("_chunk", chunk).withColumn("_value", value.cast("bigint"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_sum"))
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(across), F.lit(0))).drop("_sum")
    own = rows.withColumn("_own", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    joined = own.join(offsets, [*keys, "_chunk"])
    return joined.withColumn(into, F.col("_own") + F.col("_offset")).drop("_chunk", "_value", "_own", "_offset")


def turn_rows(turns: DataFrame, pair: Column, chosen: Column, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns of each side, numbered from zero in their order (turn, then role, then text; null first)."""
    rows = turns.select(
        pair.alias("pair_id"), chosen.alias("chosen"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
    rows = rows.filter(F.col("pair_id").isNotNull() & F.col("chosen").isNotNull()).distinct()
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62)))
    return _running(rows, ["pair_id", "chosen"], ["turn", "role", "text"], chunk, F.lit(1), "at")


def segments(
    turns: DataFrame, pair: Column, chosen: Column, turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The rendered turns of every pair that has both sides, one row per turn.

    ``pair`` names the pair of a turn and ``chosen`` tells its side; rows where either is null belong to no pair, and
    pairs with one side give no rows. Repeated turns of a side count once. The longest common prefix of (role, text),
    nulls equal to nulls, is the ``part`` prompt and comes once; the rest of each side is its completion, ``part`` chosen
    or rejected, which may have no rows. ``line`` is the rendered turn, ``at`` its number in the conversation, ``start``
    its place in the part, counted in characters. ``mask_start`` and ``mask_end`` bound what of a completion is trained
    on: an assistant turn's text and end mark; null for all else.
    """
    rows = turn_rows(turns, pair, chosen, turn, role, text)
    mine = rows.filter("chosen").select("pair_id", "at", "role", "text")
    other = rows.filter("NOT chosen").select("pair_id", "at", F.col("role").alias("r"), F.col("text").alias("t"))
    same = F.col("role").eqNullSafe(F.col("r")) & F.col("text").eqNullSafe(F.col("t"))
    differs = mine.join(other, ["pair_id", "at"]).filter(~same).groupBy("pair_id").agg(F.min("at").alias("differs"))
    sizes = rows.groupBy("pair_id").agg(
        F.count_if(F.col("chosen")).alias("n_chosen"), F.count_if(~F.col("chosen")).alias("n_rejected")
    )
    prefix = sizes.filter("n_chosen > 0 AND n_rejected > 0").join(differs, "pair_id", "left").select(
        "pair_id", F.coalesce("differs", F.least("n_chosen", "n_rejected")).alias("prompt_turns")
    )
    in_prompt = F.col("at") < F.col("prompt_turns")
    part = F.when(in_prompt, "prompt").when(F.col("chosen"), "chosen").otherwise("rejected")
    parts = (
        rows.join(prefix, "pair_id").filter(F.col("chosen") | ~in_prompt).withColumn("part", part)
        .withColumn("line", rendered(F.col("role"), F.col("text")))
    )
    placed = _running(
        parts, ["pair_id", "part"], ["at"], F.floor(F.col("at") / CHUNK), F.length("line"), "start"
    )
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED)
    body = F.col("start") + len(START) + len(TRAINED) + 1
    return placed.select(
        "pair_id", "part", "at", "start", "line", F.when(trained, body).alias("mask_start"),
        F.when(trained, F.col("start") + F.length("line") - 1).alias("mask_end"),
    )


def paired(rows: DataFrame) -> DataFrame:
    """:func:`segments` as one row per pair: ``prompt``, ``chosen``, ``rejected`` and the lists of trained spans.

    For conversations of a size that fits a row; a missing part is the empty text.
    """
    mask = F.when(F.col("mask_start").isNotNull(), F.struct("mask_start", "mask_end"))
    parts = rows.groupBy("pair_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"),
        F.array_sort(F.collect_list(mask)).alias("spans"),
    )
    parts = parts.withColumn("text", F.array_join(F.transform("lines", lambda x: x["line"]), ""))
    one = lambda name, column: F.max(F.when(F.col("part") == name, F.col(column)))
    texts = [F.coalesce(one(n, "text"), F.lit("")).alias(n) for n in ("prompt", "chosen", "rejected")]
    spans = [one(n, "spans").alias(f"{n}_spans") for n in ("chosen", "rejected")]
    return parts.groupBy("pair_id").agg(*texts, *spans)
