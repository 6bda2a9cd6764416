"""Chat formatting in budgeted windows, with built-in expressions only.

The turns of a conversation are dealt to windows by prefix sums of their
tokens. A window holds whole turns: the system turn, a limited history that is
repeated from the window before, and new turns. The loss mask covers the text
of new assistant turns; what is repeated is masked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# A backslash is set behind a backslash, and behind the first character of what begins a control string of this or
# another template; also behind such a character before a backslash, so that reading back is unambiguous.
CONTROLS = "\\\\|<(?=\\||/?s>|\\\\)|\\[(?=/?INST|\\\\)"
TOKEN = "\\p{L}{1,5}|\\p{N}{1,3}|[^\\s\\p{L}\\p{N}]"
# Turns whose prefix sums one task takes at a time.
BLOCK = 1024


def escape(text: Column) -> Column:
    """Text without control strings; ``unescape`` gives it back."""
    return F.regexp_replace(text, CONTROLS, "$0\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)([\\\\<\\[])\\\\", "$1")


def count_tokens(text: Column) -> Column:
    """Pieces of words, of numbers, and marks."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def format_windows(
    turns: DataFrame,
    budget: int = 512,
    history: int = 128,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Windows of formatted turns: ``conv_id, window, n_context, n_new, n_tokens, text, loss``.

    ``text`` is the formatted window; ``loss`` lists ``(start, length)`` in
    code points under the loss mask. The first ``n_context`` turns are
    repeated: the conversation's first system turn and the last turns before
    the window while their tokens fit ``history``.

    New turns of a window have at most ``budget - history - system`` tokens, so
    a window keeps to the budget unless one turn alone is longer than that; no
    turn is cut. A null role or text is empty. Turns are in order of ``turn``,
    then role, then text; repeated rows are turns of their own. Rows with a null
    conversation form one; an empty table has no windows. Other columns are
    left out.
    """
    role, text = F.coalesce(F.col(role_column), F.lit("")), F.coalesce(F.col(text_column), F.lit(""))
    rows = turns.select(
        F.col(conversation_column).alias("conv_id"), F.col(turn_column).alias("turn"),
        role.alias("role"), text.alias("text"),
    )
    body = escape(F.col("text"))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(MIDDLE))
    rows = rows.select(
        "conv_id", "turn", "role", "text",
        F.floor(F.coalesce("turn", F.lit(0)) / BLOCK).alias("block"),
        head.alias("head"), body.alias("body"),
        (count_tokens(F.concat(head, body, F.lit(END)))).alias("tokens"),
    )
    # Prefix sums in two steps, so that a long conversation is not one task's.
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    in_block = Window.partitionBy("conv_id", "block").orderBy(*order)
    blocks = rows.groupBy("conv_id", "block").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("turns"),
        F.min(F.when(F.col("role") == "system", F.struct("turn", "role", "text", "head", "body", "tokens"))).alias("first_system"),
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv_id")
    blocks = blocks.select(
        F.col("conv_id").alias("of"), F.col("block").alias("of_block"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
        F.min("first_system").over(every).alias("system"),
    )
    placed = rows.join(
        blocks, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))
    )
    running = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = F.greatest(F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(1))
    placed = placed.select(
        "conv_id", "role", "head", "body", "tokens", "system",
        (F.col("turns_before") + F.row_number().over(in_block)).alias("place"),
        (F.col("tokens_before") + F.sum("tokens").over(running)).alias("end"),
        room.alias("room"),
    )
    # A turn that crosses a multiple of the room is a window of its own, so that no window is over it.
    first, last = F.floor((F.col("end") - F.col("tokens")) / F.col("room")), F.floor((F.col("end") - 1) / F.col("room"))
    last = F.greatest(first, last)
    placed = placed.withColumn("window", 2 * first + F.when(last > first, 1).otherwise(0))
    return _assemble(placed, history)


def _assemble(placed: DataFrame, history: int) -> DataFrame:
    entry = F.struct("place", "role", "head", "body", "tokens", "end")
    own = placed.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(entry)).alias("turns"), F.first("system").alias("system"),
        F.min("place").alias("from"),
    )
    # A turn is history of the next window if the tokens from its start to the window's end fit.
    ends = Window.partitionBy("conv_id", "window").orderBy("place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    tail = placed.withColumn("to_end", F.sum("tokens").over(ends)).where(F.col("to_end") <= history)
    tails = tail.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(entry)).alias("past"), (F.max("place") + 1).alias("next")
    )
    tails = tails.select(F.col("conv_id").alias("tail_id"), "next", "past")
    joined = own.join(tails, F.col("conv_id").eqNullSafe(F.col("tail_id")) & (F.col("from") == F.col("next")), "left")
    # The system turn stands in front; it is not repeated where it is new.
    system = F.when(
        F.col("system").isNotNull()
        & ~F.exists("turns", lambda t: (t["role"] == "system") & (t["body"] == F.col("system.body")))
        & ~F.coalesce(F.exists("past", lambda t: (t["role"] == "system") & (t["body"] == F.col("system.body"))), F.lit(False)),
        F.array(F.struct(F.col("system.head").alias("head"), F.col("system.body").alias("body"), F.col("system.tokens").alias("tokens"))),
    )
    plain = "array<struct<head:string,body:string,tokens:bigint>>"
    pick = lambda turns: F.transform(turns, lambda t: F.struct(t["head"].alias("head"), t["body"].alias("body"), t["tokens"].alias("tokens")))
    context = F.concat(F.coalesce(system, F.array().cast(plain)), F.coalesce(pick(F.col("past")), F.array().cast(plain)))
    shown = joined.select(
        "conv_id", "window", "turns", context.alias("context"),
    )
    formatted = lambda t: F.concat(t["head"], t["body"], F.lit(END))
    shown = shown.select(
        "conv_id", "window", "turns",
        F.size("context").cast("long").alias("n_context"),
        F.size("turns").cast("long").alias("n_new"),
        (F.aggregate("context", F.lit(0).cast("long"), lambda n, t: n + t["tokens"])
         + F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"])).alias("n_tokens"),
        F.array_join(F.transform("context", formatted), "").alias("lead"),
        F.array_join(F.transform("turns", formatted), "").alias("tail"),
    )
    # Lengths of the new turns, to place the mask.
    lengths = F.transform(
        "turns",
        lambda t: F.struct(
            F.char_length(t["head"]).alias("head"), F.char_length(t["body"]).alias("body"),
            (t["role"] == "assistant").alias("loss"),
        ),
    )
    span = "array<struct<start:int,length:int>>"
    placed_spans = F.aggregate(
        lengths,
        F.struct(F.char_length("lead").alias("at"), F.array().cast(span).alias("spans")),
        lambda state, t: F.struct(
            (state["at"] + t["head"] + t["body"] + len(END)).alias("at"),
            F.when(
                t["loss"],
                F.concat(state["spans"], F.array(F.struct((state["at"] + t["head"]).alias("start"), t["body"].alias("length")))),
            ).otherwise(state["spans"]).alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return shown.select(
        "conv_id", "window", "n_context", "n_new", "n_tokens",
        F.concat("lead", "tail").alias("text"), placed_spans.alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """``conv_id, window, turns, loss_text, chars``: new turns ``(role, text)`` and text under the mask, read from the formatted text."""
    parts = F.slice(F.split(F.col("text"), "<\\|im_start\\|>"), F.col("n_context").cast("int") + 2, F.col("n_new").cast("int"))
    role = lambda part: unescape(F.substring_index(part, MIDDLE, 1))
    text = lambda part: unescape(F.element_at(F.split(part, "<\\|im_sep\\|>|<\\|im_end\\|>"), 2))
    turns = F.transform(parts, lambda part: F.struct(role(part).alias("role"), text(part).alias("text")))
    loss = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["length"])))
    return windows.select(
        "conv_id", "window", turns.alias("turns"), F.array_join(loss, "").alias("loss_text"),
        F.char_length("text").cast("long").alias("chars"),
    )
