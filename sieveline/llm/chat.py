"""Preference formatting of chosen and rejected conversations.

For each pair, the longest common prefix of turns is rendered once, as the prompt; what follows is
rendered for either side as a completion, with a mask: the spans (code points of the completion)
that are trained on, which are the trained role's texts with their end marks. Turn headers and
other roles' turns stay masked. All of it is array expressions over one row a pair: only turns are
gathered, by conversation, so the largest group is the longest conversation, which is one row of
the result anyway.

Defined results: turns are ordered by their number, then role and text; repeated turns stay; null
numbers come first; a null role or text is empty; rows without a conversation id belong to no
conversation. A null side of a pair is an empty conversation. If one side is a prefix of the other,
its completion is empty. Template marks inside a text are broken up by a blank, so that no text can
forge a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template (fixed values).
OPEN, AFTER_ROLE, CLOSE, AFTER_TURN = "<|im_start|>", "\n", "<|im_end|>", "\n"
ROLE = "assistant"
_TURNS = "array<struct<role:string,text:string>>"


def gather(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, turns): each conversation's turns in order, as structs of role and text."""
    safe = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = turns.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").alias("_id"), F.struct(F.col(f"`{turn}`").alias("turn"), safe(role).alias("role"), safe(text).alias("text")).alias("_turn")
    )
    ordered = rows.groupBy("_id").agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
    return ordered.select(F.col("_id").alias(conv_id), F.transform("_turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))


def swapped_answer_pairs(conversations: DataFrame, pick: Column, conv_id: str = "conv_id", role: str = ROLE) -> DataFrame:
    """Rows (conv_id, chosen, rejected) from gathered conversations: pairs that part at one of their answers.

    Chosen is the whole conversation; rejected the same with one answer replaced by the next one of the conversation (after the
    last the first), or by an empty answer if there is no other. Which answer is ``pick`` (a whole number) modulo their number,
    so pairs part at any depth and what follows the answer is in both completions. Without any answer, both are the
    conversation as it is; a null pick is 0.
    """
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i).role == role)
    rows = conversations.where(F.size("turns") > 0).withColumn("_at", places)
    rows = rows.withColumn("_k", F.when(F.size("_at") > 0, F.pmod(F.coalesce(pick, F.lit(0)), F.size("_at")).cast("int")))
    here, after = (F.element_at("_at", F.pmod(F.col("_k") + d, F.size("_at")).cast("int") + 1) for d in (0, 1))
    text = F.when(F.size("_at") > 1, F.element_at("turns", after).text).otherwise(F.lit(""))
    stale = F.array(F.struct(F.lit(role).alias("role"), text.alias("text")))
    swapped = F.concat(F.slice("turns", F.lit(1), here - 1), stale, F.slice("turns", here + 1, F.size("turns")))
    return rows.select(conv_id, F.col("turns").alias("chosen"), F.when(F.size("_at") > 0, swapped).otherwise(F.col("turns")).cast(_TURNS).alias("rejected"))


def _render(turn: Column) -> Column:
    role, text = (F.replace(x, F.lit("<|im_"), F.lit("<| im_")) for x in (turn.role, turn.text))
    return F.concat(F.lit(OPEN), role, F.lit(AFTER_ROLE), text, F.lit(CLOSE + AFTER_TURN))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _mask(turns: Column, role: str) -> Column:
    """Spans (start, end) of the trained role's texts and end marks in the rendered turns."""
    kind = "struct<at:int,spans:array<struct<start:int,end:int>>>"

    def step(state: Column, turn: Column) -> Column:
        size = F.length(_render(turn))
        start = state.at + len(OPEN) + F.length(F.replace(turn.role, F.lit("<|im_"), F.lit("<| im_"))) + len(AFTER_ROLE)
        span = F.array(F.struct(start.cast("int").alias("start"), (state.at + size - len(AFTER_TURN)).cast("int").alias("end")))
        spans = F.when(turn.role == role, F.concat(state.spans, span)).otherwise(state.spans)
        return F.struct((state.at + size).cast("int").alias("at"), spans.alias("spans")).cast(kind)

    return F.aggregate(turns, F.expr(f"cast(named_struct('at', 0, 'spans', array()) as {kind})"), step, lambda s: s.spans)


def format_preferences(pairs: DataFrame, pair_id: str = "conv_id", chosen: str = "chosen", rejected: str = "rejected", role: str = ROLE, equal: str = "keep") -> DataFrame:
    """One row (pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask) per pair.

    Both sides are arrays of structs of role and text. Pairs whose sides are equal prefer nothing: their
    completions are empty, and ``equal="drop"`` leaves them out.
    """
    if equal not in ("keep", "drop"):
        raise ValueError(f"equal is {equal!r}, not 'keep' or 'drop'")
    side = lambda c: F.transform(
        F.coalesce(F.col(f"`{c}`").cast(_TURNS), F.array().cast(_TURNS)),
        lambda t: F.struct(F.coalesce(t.role, F.lit("")).alias("role"), F.coalesce(t.text, F.lit("")).alias("text")),
    )
    rows = pairs.select(F.col(f"`{pair_id}`").alias("_id"), side(chosen).alias("_c"), side(rejected).alias("_r"))
    same = F.zip_with("_c", "_r", lambda a, b: a.eqNullSafe(b))
    shared = F.when(F.array_position(same, False) > 0, F.array_position(same, False) - 1).otherwise(F.size(same)).cast("int")
    rows = rows.withColumn("_n", shared)
    if equal == "drop":
        rows = rows.where((F.col("_n") < F.size("_c")) | (F.col("_n") < F.size("_r")))
    rest = lambda c: F.slice(c, F.col("_n") + 1, F.greatest(F.size(c) - F.col("_n"), F.lit(0)))
    rows = rows.withColumn("_p", F.slice("_c", F.lit(1), F.col("_n"))).withColumn("_c", rest("_c")).withColumn("_r", rest("_r"))
    return rows.select(
        F.col("_id").alias(pair_id), F.col("_n").cast("long").alias("n_prompt_turns"), _joined(F.col("_p")).alias("prompt"),
        _joined(F.col("_c")).alias("chosen"), _mask(F.col("_c"), role).alias("chosen_mask"),
        _joined(F.col("_r")).alias("rejected"), _mask(F.col("_r"), role).alias("rejected_mask"),
    )


def mask_text(mask: Column) -> Column:
    """A mask as ``start:end,start:end``."""
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s.start, s.end)), ",")
