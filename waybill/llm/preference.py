"""Preference pairs: a common prompt, rendered once, and two completions with training masks.

The prompt is the longest common prefix of turns of a chosen and a rejected conversation. What follows
it in each is that side's completion. A completion's mask lists the character ranges that are
trained on: the texts of the answering role's turns; headers, end marks and other roles' turns are not.

``pairs_by_opening`` makes pairs of a turn table: conversations that begin with the same turn are
answers to one opening; the smallest id is the chosen one, every other is rejected in turn. Openings are
compared by digest, with partial minima before the shuffle; a very common opening is a skewed join key,
which Spark splits.

``pairs_by_answer`` needs no common opening: a conversation up to its last answer is the chosen one, and
the same with the last answer of the conversation numbered next is rejected.

Defined cases: null roles and texts are empty. Turns with a null ``conv_id`` belong to no conversation.
Turns are ordered by turn number (null first), role and text, and equal rows count once. Pairs whose
conversations are equal express no preference and are left out. Other columns are ignored. Empty
tables give no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waybill.llm.tables import keep

HEAD, TAIL = "<|{role}|>\n", "<|end|>\n"
ANSWERING = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns (role, text) of each conversation in order."""
    rows = turns.filter("conv_id is not null").select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    # a conversation is one training record, so its turns meet in one row
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("t"))
    return gathered.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def pairs_by_opening(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, chosen, rejected) of conversations with the same first turn."""
    first = F.col("turns")[0]
    # the role's length keeps (role, text) apart however they are cut
    opening = F.sha2(F.concat_ws(":", F.length(first["role"]).cast("string"), F.concat(first["role"], first["text"])), 256)
    whole = keep(conversations(turns).withColumn("opening", opening), "conversations")
    firsts = whole.groupBy("opening").agg(F.min("conv_id").alias("chosen_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # both stored, so that the joins are of plain shuffles and a hot opening or chosen conversation can be split
    rejected = whole.join(keep(firsts.drop("n"), "openings"), "opening").filter("conv_id != chosen_id").select(
        "chosen_id", F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    chosen = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    return rejected.join(chosen, "chosen_id").filter(~F.col("chosen").eqNullSafe(F.col("rejected")))


def pairs_by_answer(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, chosen, rejected): each conversation against the next one's last answer."""
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == ANSWERING), True) + 1
    whole = conversations(turns).withColumn("last", last.cast("int")).filter(F.col("last") <= F.size("turns"))
    answers = whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns")[F.col("last") - 1].alias("answer"))
    started = whole.select(F.col("conv_id").alias("chosen_id"), F.slice("turns", 1, F.col("last")).alias("chosen"))
    met = started.join(answers, F.col("rejected_id") == F.col("chosen_id") + 1)
    swapped = F.concat(F.slice("chosen", 1, F.size("chosen") - 1), F.array("answer"))
    return met.select("chosen_id", "rejected_id", "chosen", swapped.alias("rejected")).filter(
        ~F.col("chosen").eqNullSafe(F.col("rejected")))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def _head(turn: Column) -> Column:
    before, after = HEAD.split("{role}")
    return F.concat(F.lit(before), turn["role"], F.lit(after))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(TAIL))), "")


def _mask(turns: Column) -> Column:
    """Character ranges (start, stop) of the answering role's texts in the rendered turns."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_head(turn))
        stop = start + F.length(turn["text"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct((stop + len(TAIL)).alias("at"),
                        F.when(turn["role"] == ANSWERING, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, empty, step, lambda state: state["spans"])


def formatted(pairs: DataFrame) -> DataFrame:
    """Per pair (chosen, rejected: arrays of role and text): ``prompt_turns``, ``prompt``, and each side's
    ``_text`` and ``_mask``; its other columns stay."""
    n = common_turns(F.col("chosen"), F.col("rejected"))
    cut = pairs.withColumn("prompt_turns", n)
    rest = {side: F.slice(side, F.col("prompt_turns") + 1, F.greatest(F.size(side), F.lit(1))) for side in ("chosen", "rejected")}
    return cut.withColumns({
        "prompt": _render(F.slice("chosen", 1, F.col("prompt_turns"))),
        **{f"{side}_text": _render(turns) for side, turns in rest.items()},
        **{f"{side}_mask": _mask(turns) for side, turns in rest.items()},
    }).drop("chosen", "rejected")
