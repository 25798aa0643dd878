"""Operator 12: chat formatting in budgeted, turn-aligned windows with a loss mask.

DataFrame functions only.  A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts every ``<|`` gains a backslash
(``<\\|``, and ``<\\|`` becomes ``<\\\\|``), so no text can hold a mark and the reader takes exactly one backslash back;
roles also write line ends and backslashes as ``\\n`` and ``\\\\``.

Turns are put in order by ranges of (conversation, turn), each range partition sums its tokens, and the totals of the
partitions before give every turn the number of tokens before it in its conversation: no conversation is gathered.
Of a ``budget`` of tokens a quarter is for the system turn, an eighth for history, and the rest for new turns.  A turn of
up to half that rest belongs to the cell of half a rest in which it begins, so the new turns of a window never pass
the rest; a longer turn, always the last to begin in its cell, stands alone.  A window is made of the conversation's leading system turn, whole turns
before its first new turn as far as the history allowance reaches, and its new turns; the first window repeats nothing.
The loss mask covers the texts of new assistant turns, so each is learnt once and repeated ones are masked.  Only a
system turn or a single turn larger than its allowance makes a window larger than the budget (``tokens`` says so).

Tokens are counted by ``tokens``: runs of up to four letters, digits and other marks, and four for a turn's own marks.

Defined results: a null text or role is empty; turns that are null come first; turns of equal number are ordered by role
and XXH64 of the text; rows repeated are turns like any other; rows with a null conversation id form one conversation; a later
system turn is a turn like any other; an empty table gives an empty result.  Other columns are not read, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

START, END = "<|im_start|>", "<|im_end|>\n"  # fixed values of the template
BUDGET = 2048
PIECES = r"[\p{L}\p{M}]{1,4}|\p{N}|[^\p{L}\p{M}\p{N} \t\n\x0B\f\r]"
MARKS = 4  # tokens of a turn's own marks


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # a doubled backslash stands for one; it is set aside while \n is read
    aside = F.replace(unescape(role), F.lit("\\\\"), F.lit("\x00\x00"))
    return F.replace(F.replace(aside, F.lit("\\n"), F.lit("\n")), F.lit("\x00\x00"), F.lit("\\"))


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PIECES)).cast("long") + MARKS


def ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, at, role, text, tokens, before, lead)``: turns in order with the tokens before them in their conversation.

    ``at`` rises with the order over all rows; ``lead`` marks a conversation's leading system turn.
    """
    src = turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                       F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    keys = ["conv", "turn", "role", "hash", "row"]  # the row last, so that repeated rows can be split
    src = src.select("*", tokens(F.col("text")).alias("tokens"), F.xxhash64("text").alias("hash"),
                     F.monotonically_increasing_id().alias("row"))
    rows = cut(src.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .select("conv", "role", "text", "tokens", F.monotonically_increasing_id().alias("at"),
                       F.spark_partition_id().alias("pid")))
    inside = Window.partitionBy("pid", "conv").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # totals of the conversations at the two ends of a partition: two rows per partition
    whole = rows.groupBy("pid", "conv").agg(F.sum("tokens").alias("sum"), F.min("at").alias("first"))
    ends = whole.groupBy("pid").agg(F.min("first").alias("lo"), F.max("first").alias("hi"))
    edge = whole.join(F.broadcast(ends), "pid").where((F.col("first") == F.col("lo")) | (F.col("first") == F.col("hi")))
    earlier = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = edge.select("pid", F.col("conv").alias("c"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("carry"))
    carry = carry.where("carry > 0")
    here = F.sum("tokens").over(inside) - F.col("tokens")
    placed = rows.withColumn("inside", here).join(
        F.broadcast(carry.withColumnRenamed("pid", "p")), (F.col("pid") == F.col("p")) & F.col("conv").eqNullSafe(F.col("c")), "left")
    before = F.col("inside") + F.coalesce("carry", F.lit(0))
    return placed.select("conv", "at", "role", "text", "tokens", before.alias("before"),
                         ((before == 0) & (F.col("role") == "system")).alias("lead"))


def windows(turns: DataFrame, conv: str, turn: str = "turn", role: str = "role", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """``(conv, window, text, loss, repeated, tokens)``.

    ``window`` rises with the order in a conversation; ``text`` is the formatted window; ``loss`` lists the spans
    ``(start, length)`` in code points of escaped assistant texts to learn; ``repeated`` counts the turns at its head
    that an earlier window held.
    """
    history, half = budget // 8, (budget - budget // 4 - budget // 8) // 2
    rows = cut(ordered(turns, conv, turn, role, text).withColumn(
        "window", 2 * F.expr(f"before div {half}") + (F.col("tokens") > half).cast("long")))
    new = rows.where(~F.col("lead"))
    spans = cut(new.groupBy("conv", "window").agg(F.min("before").alias("start"), F.min("at").alias("from")))
    first = spans.groupBy(F.col("conv").alias("c")).agg(F.min("window").alias("first"))
    spans = spans.join(first, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    # whole turns in the allowance before a span: they begin in one of two neighbouring stretches of its length
    look = (spans.where(F.col("window") > F.col("first"))
            .select(F.col("conv").alias("c"), F.col("window").alias("to"), "start",
                    F.explode(F.array(F.expr(f"start div {history} - 1"), F.expr(f"start div {history}"))).alias("stretch")))
    old = new.withColumn("s", F.expr(f"before div {history}")).join(
        look, F.col("conv").eqNullSafe(F.col("c")) & (F.col("s") == F.col("stretch"))
        & (F.col("before") < F.col("start")) & (F.col("before") >= F.col("start") - history))
    lead = rows.where("lead").drop("window").join(
        spans.select(F.col("conv").alias("c"), "window", "first"), F.col("conv").eqNullSafe(F.col("c")), "left")
    turn_of = lambda fresh: F.struct("at", "role", "text", "tokens", fresh.alias("fresh")).alias("t")
    parts = (new.select("conv", "window", turn_of(F.lit(True)))
             .union(old.select("conv", F.col("to").alias("window"), turn_of(F.lit(False))))
             .union(lead.select("conv", F.coalesce("window", F.lit(0)).alias("window"),
                                turn_of(F.coalesce(F.col("window") == F.col("first"), F.lit(True))))))
    parts = parts.groupBy("conv", "window").agg(F.sort_array(F.collect_list("t")).alias("t"))  # a budget's turns
    parts = parts.select("conv", "window", "t.fresh", "t.tokens", F.transform("t", lambda t: F.struct(
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["fresh"] & (t["role"] == "assistant")).alias("learn"))).alias("t"))
    none = F.expr("CAST(array() AS array<struct<start: bigint, length: bigint>>)")
    size = lambda t, c: F.char_length(t[c]).cast("long")

    def mask(done: Column, t: Column) -> Column:
        body = done["pos"] + size(t, "head")
        span = F.array(F.struct(body.alias("start"), size(t, "body").alias("length")))
        return F.struct((body + size(t, "body") + len(END)).alias("pos"),
                        F.when(t["learn"], F.concat(done["loss"], span)).otherwise(done["loss"]).alias("loss"))

    return parts.select(
        "conv", "window", F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        F.aggregate("t", F.struct(F.lit(0).cast("long").alias("pos"), none.alias("loss")), mask)["loss"].alias("loss"),
        F.size(F.filter("fresh", lambda f: ~f)).alias("repeated"),
        F.aggregate("tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv, n_turns, turns, loss, chars)`` of conversations from their windows.

    ``turns`` is role, line end, text, line end of every turn once, ``loss`` all text under the loss mask, unescaped.
    Both are one value per conversation, as their digests need them.
    """
    turns = F.split("text", r"<\|im_end\|>\n")
    turns = F.slice(turns, F.col("repeated") + 1, F.size(turns) - 1 - F.col("repeated"))
    plain = F.transform(turns, lambda t: F.struct(F.substring_index(t, "\n", 1).alias("head"), t.alias("all")))
    plain = F.transform(plain, lambda t: F.concat(
        unescape_role(F.substring(t["head"], len(START) + 1, F.char_length(t["head"]))), F.lit("\n"),
        unescape(F.substring(t["all"], F.char_length(t["head"]) + 2, F.char_length(t["all"]))), F.lit("\n")))
    learnt = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    read = formatted.select("conv", F.struct("window", F.size(turns).alias("n"), F.array_join(plain, "").alias("turns"),
                                             F.array_join(learnt, "").alias("loss")).alias("w"),
                            F.char_length("text").cast("long").alias("chars"))
    whole = read.groupBy("conv").agg(F.sort_array(F.collect_list("w")).alias("w"), F.sum("chars").alias("chars"))
    return whole.select("conv", F.aggregate("w.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_turns"),
                        F.array_join("w.turns", "").alias("turns"), F.array_join("w.loss", "").alias("loss"), "chars")
