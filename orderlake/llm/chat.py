"""Preference pairs of conversations as one prompt and two masked completions.

For a chosen and a rejected conversation, the longest common prefix of turns (role and text equal)
is rendered once, as the prompt; the turns that follow are the two completions. A completion's mask
lists the spans of code points that are trained on: the text and end mark of each assistant turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks of the rendered form.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"

_SPANS = "array<struct<first:int,last:int>>"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def head(role: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit("\n"))


def body(text: Column) -> Column:
    """A turn's text and end mark. Marks inside a text are broken, so that they end no turn."""
    return F.concat(F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("< |im_")), F.lit(END))


def rendered(turn: Column) -> Column:
    return F.concat(head(turn["role"]), body(turn["text"]), F.lit("\n"))


def conversations(turns: DataFrame, key: str, name: str) -> DataFrame:
    """One row per conversation with its turns in order; equal turn numbers go by role and text."""
    return turns.groupBy(F.col(key).alias("pair_id")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias(name)
    )


def common_turns(a: Column, b: Column) -> Column:
    """How many turns from the first are equal in role and text; null equals null."""
    equal = F.zip_with(
        a,
        b,
        lambda x, y: x.isNotNull()
        & y.isNotNull()
        & x["role"].eqNullSafe(y["role"])
        & x["text"].eqNullSafe(y["text"]),
    )
    first = F.array_position(equal, F.lit(False))
    return F.when(first == 0, F.size(equal)).otherwise((first - 1).cast("int"))


def joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask(turns: Column, role: str = TRAINED_ROLE) -> Column:
    """Spans [first, last) of the rendered `turns` that hold what `role` says."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        first = state["at"] + F.length(head(turn["role"]))
        last = first + F.length(body(turn["text"]))
        span = F.array(F.struct(first.alias("first"), last.alias("last")))
        spans = F.when(turn["role"] == role, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((last + 1).alias("at"), spans.cast(_SPANS).alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def preference_rows(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id", role: str = TRAINED_ROLE) -> DataFrame:
    """Pairs from two tables of turns (`key`, turn, role, text); other columns are not read.

    Gives pair_id, prompt, prompt_turns, chosen, rejected, chosen_mask, rejected_mask and `differ`,
    false for pairs with equal conversations, whose completions are empty. A conversation on one
    side only is compared with one of no turns. Null texts and roles are rendered as empty; a null
    key pairs with the null key. Repeated turns of one number stay, in order of role and text. A
    row holds its whole conversation, as any rendered form does.
    """
    left = conversations(chosen, key, "a").withColumnRenamed("pair_id", "left_id")
    right = conversations(rejected, key, "b").withColumnRenamed("pair_id", "right_id")
    none = F.array().cast(_TURNS)
    pairs = (
        left.join(right, F.col("left_id").eqNullSafe(F.col("right_id")), "full_outer")
        .select(
            F.coalesce("left_id", "right_id").alias("pair_id"),
            F.coalesce(F.col("a").cast(_TURNS), none).alias("a"),
            F.coalesce(F.col("b").cast(_TURNS), none).alias("b"),
        )
        .withColumn("n", common_turns(F.col("a"), F.col("b")))
    )
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c) + 1)
    a, b = rest(F.col("a")), rest(F.col("b"))
    return pairs.select(
        "pair_id",
        joined(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
        F.col("n").cast("long").alias("prompt_turns"),
        joined(a).alias("chosen"),
        joined(b).alias("rejected"),
        mask(a, role).alias("chosen_mask"),
        mask(b, role).alias("rejected_mask"),
        ((F.size(a) > 0) | (F.size(b) > 0)).alias("differ"),
    )


def with_foreign_answer(turns: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from plain conversations, for tables without judged answers.

    Chosen is a conversation with an answer. Rejected is the same up to its last answer (the
    assistant's turn of highest number), in whose place it has the last answer of the conversation with the next
    whole number as id, or, where there is none, of the conversation with the smallest id.

    Conversations without an assistant's turn have nothing to prefer and are in neither frame, nor are
    rows without an id; an answer without a turn number is no last answer. Turns after the last answer
    stay in chosen. A null text of an answer is empty. An empty table gives empty frames; of the columns,
    only the key, turn, role and text are read.
    """
    answers = (
        turns.filter((F.col("role") == TRAINED_ROLE) & F.col(key).isNotNull() & F.col("turn").isNotNull())
        .groupBy(F.col(key).alias("pair_id"))
        .agg(F.max(F.struct("turn", "text")).alias("last"))
        .select("pair_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("answer"))
    )
    first = answers.agg(F.min(F.struct("pair_id", "answer")).alias("first"))
    following = answers.select((F.col("pair_id") - 1).alias("pair_id"), F.struct("answer").alias("following"))
    donors = (
        answers.join(following, "pair_id", "left")
        .join(F.broadcast(first))  # one row
        .select(
            "pair_id",
            "last_turn",
            F.when(F.col("following").isNull(), F.col("first.answer")).otherwise(F.col("following.answer")).alias("other"),
        )
    )
    own = turns.select(F.col(key).alias("pair_id"), "turn", "role", "text")
    chosen = own.join(donors.select("pair_id"), "pair_id", "left_semi")
    kept = own.join(donors.select("pair_id", "last_turn"), "pair_id").filter("turn < last_turn")
    answered = donors.select(
        "pair_id", F.col("last_turn").alias("turn"), F.lit(TRAINED_ROLE).alias("role"), F.col("other").alias("text")
    )
    return chosen, kept.select("pair_id", "turn", "role", "text").unionAll(answered)
