"""Preference formatting in DataFrame expressions.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (same role, same
text) is rendered once as the prompt; what is left of each side is its completion, with a mask of
one character per character: 1 where a model is to learn (text and end mark of assistant turns), 0
elsewhere (headers, and turns of other roles that come after the fork).

Turns are ordered by number, then role and text; a turn that is repeated exactly counts once. A null
text counts as empty, a null role as ``unknown``, a null turn number comes first. Rows without a
conversation id belong to no conversation and are left out. A side without a conversation gives a
null completion and an empty prompt; identical sides give empty completions. An empty table gives no
rows; other columns are ignored. One shuffle brings the turns of a pair together; a result row
holds a whole pair, so a pair must fit in a row, as its result does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def _rendered(turns: str) -> Column:
    return F.expr(
        f"array_join(transform({turns}, x -> concat('{OPEN}', x.role, '\\n', x.text, '{_sql(CLOSE)}')), '')"
    )


def _mask(turns: str) -> Column:
    """As many characters as ``_rendered`` gives."""
    header = f"length('{OPEN}') + length(x.role) + 1"
    body = f"length(x.text) + length('{_sql(CLOSE)}')"
    learned = f"if(x.role = '{LEARNED_ROLE}', '1', '0')"
    return F.expr(
        f"array_join(transform({turns}, x -> concat(repeat('0', {header}), repeat({learned}, {body}))), '')"
    )


def _sql(text: str) -> str:
    return text.replace("\n", "\\n")


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """One row per pair of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``pair`` names the pair of a turn's conversation and ``chosen`` says which side it is; a side
    is one conversation.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    named = turns.filter(F.col("conv_id").isNotNull()).select(
        pair.alias("__pair"), chosen.alias("__chosen"), F.col("conv_id").alias("__conv"), turn.alias("__turn")
    )
    side = {}
    for name, mine in (("chosen", F.col("__chosen")), ("rejected", ~F.col("__chosen"))):
        side[f"{name}_id"] = F.min(F.when(mine, F.col("__conv")))
        side[f"__{name}"] = F.sort_array(F.collect_set(F.when(mine, F.col("__turn"))))
    pairs = named.groupBy("__pair").agg(*[c.alias(k) for k, c in side.items()])
    same = "zip_with(__chosen, __rejected, (x, y) -> x.role <=> y.role and x.text <=> y.text)"
    forked = pairs.withColumn("__fork", F.expr(f"array_position({same}, false)")).withColumn(
        "prefix_turns",
        F.expr("if(__fork = 0, size(__chosen), cast(__fork - 1 as int))").cast("long"),
    )
    parts = {"prompt": "slice(__chosen, 1, cast(prefix_turns as int))"}
    for name in ("chosen", "rejected"):
        rest = f"slice(__{name}, cast(prefix_turns + 1 as int), size(__{name}))"
        parts[name] = f"if({name}_id is null, null, {rest})"
    return forked.select(
        F.col("__pair").alias("pair_id"),
        "chosen_id",
        "rejected_id",
        "prefix_turns",
        _rendered(parts["prompt"]).alias("prompt"),
        *[
            column
            for name in ("chosen", "rejected")
            for column in (
                _rendered(parts[name]).alias(name),
                _mask(parts[name]).alias(f"{name}_mask"),
            )
        ],
    )


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of conversations with neighbouring numbers: 2k is chosen, 2k + 1 rejected."""
    return preference_pairs(
        turns, F.floor(F.col("conv_id") / 2).cast("long"), F.pmod("conv_id", F.lit(2)) == 0
    )
