"""Preference pairs as a shared prompt and two completions with loss masks.

A pair holds two lists of turns, chosen and rejected. Their longest common prefix of equal
turns is rendered once as the prompt; the turns after it are rendered as the completions.
A mask lists the character ranges ``[start, end)`` of a completion that carry loss: what the
assistant says, with the end mark of its turn. All other characters carry none.

A conversation becomes one row because the training example is one string; repeated rows of
a turn are merged before they move. Turns stand in the order of turn, role, text, nulls
first; a null role or text is an empty one. A turn without an id is a conversation of its
own, equal ones are one, so they gather nowhere. A side that is missing or null has no turns;
equal sides give two empty completions. Texts are rendered whole, however long; an empty table
gives an empty one. Other columns of pairs stay as they are; one with the name of a result is
returned as ``given_<name>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import text as T

#: Fixed marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
RESULTS = ("n_prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask")


def conversations(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``(conv_id, turns)`` with ``turns`` an ordered array of ``(role, text)``."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col("turn").alias("turn"), T.whole("role").alias("role"), T.whole("text").alias("text")
    ).distinct()
    in_order = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    alone = F.when(F.col("conv_id").isNull(), F.struct("turn", "role", "text")).alias("_alone")
    talks = rows.groupBy("conv_id", alone).agg(
        F.transform(in_order, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )
    return talks.drop("_alone")


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many turns both begin with."""
    shorter = F.least(F.size(chosen), F.size(rejected))
    same = F.transform(F.slice(chosen, F.lit(1), shorter), lambda t, i: t == F.get(rejected, i))
    first_other = F.array_position(same, False)
    return F.when(first_other == 0, shorter).otherwise(first_other - 1).cast("int")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END))), "")


def loss_mask(turns: Column) -> Column:
    """``array<struct<start, end>>`` over the rendered turns."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(_head(t))
        end = start + F.char_length(t["text"]) + len(END)
        span = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")))
        spans = F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, begin, step, lambda acc: acc["spans"])


def _given_names(others: list[str]) -> list[str]:
    """The names of the other columns, apart from the results' in any case of letters."""
    taken = {*RESULTS, *(c.lower() for c in others)}
    names = []
    for c in others:
        if c.lower() in RESULTS:
            while c.lower() in taken:
                c = f"given_{c}"
            taken.add(c.lower())
        names.append(c)
    return names


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """The other columns of ``pairs`` and RESULTS."""
    none = F.array().cast("array<struct<role:string,text:string>>")
    others = [c for c in pairs.columns if c not in (chosen, rejected)]
    sides = pairs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"),
        F.coalesce(F.col(chosen), none).alias("_c"),
        F.coalesce(F.col(rejected), none).alias("_r"),
    )
    sides = sides.withColumn("_n", common_turns(F.col("_c"), F.col("_r")))
    rest = lambda side: F.slice(side, F.col("_n") + 1, F.size(side))
    cut = sides.select(
        "_row", "_n", F.slice("_c", F.lit(1), F.col("_n")).alias("_p"), rest(F.col("_c")).alias("_c"), rest(F.col("_r")).alias("_r")
    )
    return cut.select(
        *[F.col("_row").getField(c).alias(name) for c, name in zip(others, _given_names(others))],
        F.col("_n").cast("bigint").alias("n_prompt_turns"),
        rendered(F.col("_p")).alias("prompt"),
        rendered(F.col("_c")).alias("chosen"),
        loss_mask(F.col("_c")).alias("chosen_mask"),
        rendered(F.col("_r")).alias("rejected"),
        loss_mask(F.col("_r")).alias("rejected_mask"),
    )


def last_reply_pairs(talks: DataFrame) -> DataFrame:
    """``(conv_id, chosen, rejected)`` from :func:`conversations`: a conversation up to its
    last reply, and the same with the reply before it given once more (none: empty reply).
    Without a reply both sides are the whole conversation."""
    index = F.sequence(F.lit(0), F.size("turns") - 1)
    replies = F.filter(index, lambda i: F.get("turns", i)["role"] == TRAINED_ROLE)
    placed = talks.select("conv_id", "turns", replies.alias("replies")).withColumn(
        "last", F.get("replies", F.size("replies") - 1)
    )
    before = F.get("turns", F.get("replies", F.size("replies") - 2))["text"]
    worse = F.struct(F.lit(TRAINED_ROLE).alias("role"), F.coalesce(before, F.lit("")).alias("text"))
    upto = F.slice("turns", F.lit(1), F.col("last") + 1)
    return placed.select(
        "conv_id",
        F.when(F.col("last").isNull(), F.col("turns")).otherwise(upto).alias("chosen"),
        F.when(F.col("last").isNull(), F.col("turns")).otherwise(F.concat(F.slice("turns", F.lit(1), F.col("last")), F.array(worse))).alias("rejected"),
    )
