r"""Chat formatting in budgeted windows.

A turn is written as ``<s>role[INST]text</s>``.  Inside roles and texts a
backslash is doubled, and a control string (``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) gets a backslash after its first character; dropping every
backslash that precedes a character undoes both.

Prefix sums of turn tokens deal the turns of a conversation into spans: a turn
belongs to the span in whose stretch of ``span_tokens`` tokens it begins.  A
window is the conversation's first system turn, as many whole turns before the
span as fit into ``history_tokens``, and the span.  Only assistant turns of the
span itself are targets: repeated ones are outside the loss mask.

Prefix sums are taken in two steps, inside runs of ``RUN`` turn numbers and over
the runs' totals, so that a conversation with a third of all rows is spread
over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, stored

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"
RUN = 1024
#: Tokens a turn takes besides its words.
MARKS = 3

_CONTROL = r"\\|(?<=<)(?=/?s>)|(?<=\[)(?=/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$0")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    return (F.regexp_count(text, F.lit(WORD)) + MARKS).cast("long")


def _prefixed(turns: DataFrame) -> DataFrame:
    """Turns with ``place`` (0, 1, ...) and ``before`` (tokens of earlier turns) in their conversation."""
    turns = turns.withColumn("run", F.floor(F.coalesce("turn", F.lit(0)) / RUN))
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv_id", "run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        turns.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "run").orderBy(*order)) - 1)
        .withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    )
    runs = (
        turns.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
        .select(F.col("conv_id").alias("c"), F.col("run").alias("r"),
                F.coalesce(F.sum("n").over(earlier.partitionBy("conv_id")), F.lit(0)).alias("n0"),
                F.coalesce(F.sum("t").over(earlier.partitionBy("conv_id")), F.lit(0)).alias("t0"))
    )
    return (
        numbered.join(runs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")))
        .withColumn("place", F.col("place") + F.col("n0")).withColumn("before", F.col("before") + F.col("t0"))
        .drop("run", "c", "r", "n0", "t0")
    )


def format_chats(turns: DataFrame, span_tokens: int = 512, history_tokens: int = 128) -> DataFrame:
    """One row per window: conv_id, window, text, repeated, targets, tokens.

    ``repeated`` is the number of leading turns of the window that another window
    holds as its own; ``targets`` the loss mask, array<struct<start,end>> of code
    points of ``text``.  ``tokens`` is at most ``span_tokens`` plus
    ``history_tokens`` plus the system turn and the span's last turn, as turns
    are never cut.  Null texts and roles count as empty.  Turns of one number are
    ordered by role and text; repeated rows stay.  Null ids are one
    conversation, null turn numbers come first.  ``history_tokens`` must not pass
    ``span_tokens``.
    """
    if not 0 <= history_tokens <= span_tokens:
        raise ValueError("history_tokens must lie between 0 and span_tokens")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", turn_tokens(F.col("text")))
    placed = stored(
        _prefixed(rows).withColumn("span", F.floor(F.col("before") / span_tokens).cast("long")), "chat-turns")
    by_conv = Window.partitionBy("conv_id").orderBy("span")
    system = placed.where(F.col("role") == "system").groupBy("conv_id").agg(
        F.min(F.struct("place", "span", "before", "text", "role", "tokens")).alias("system"))
    spans = placed.groupBy("conv_id", "span").agg(F.min("before").alias("start")).select(
        "conv_id", "span", "start",
        F.lead("span").over(by_conv).alias("next"), F.lead("start").over(by_conv).alias("next_start"))
    spans = stored(spans, "chat-spans")
    key = spans.select(F.col("conv_id").alias("c"), F.col("span").alias("s"), "start", "next", "next_start")
    joined = placed.join(key, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("span") == F.col("s")))
    own = joined.select("conv_id", F.col("span").alias("window"), "place", "role", "text", "tokens", F.lit(False).alias("again"))
    history = joined.where(F.col("next_start") - F.col("before") <= history_tokens).select(
        "conv_id", F.col("next").alias("window"), "place", "role", "text", "tokens", F.lit(True).alias("again"))
    # The first system turn, in each window that has it neither as own nor as history.
    sys = system.select(F.col("conv_id").alias("c"), "system.*")
    ahead = spans.join(sys.select("c", "place", F.col("span").alias("s"), "before", "role", "text", "tokens"),
                       F.col("conv_id").eqNullSafe(F.col("c"))).where(
        (F.col("span") > F.col("s")) & (F.col("start") - F.col("before") > history_tokens)
    ).select("conv_id", F.col("span").alias("window"), "place", "role", "text", "tokens", F.lit(True).alias("again"))
    written = own.unionByName(history).unionByName(ahead).withColumn(
        "head", F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))).withColumn("body", escaped(F.col("text")))
    gathered = written.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("place", "again", "role", "head", "body"))).alias("turns"),
        F.sum("tokens").alias("tokens"), F.sum(F.col("again").cast("int")).alias("repeated"))
    whole = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)
    shape = "array<struct<start:int,end:int>>"

    def step(a: Column, t: Column) -> Column:
        first = a["at"] + F.length(t["head"])
        target = (t["role"] == "assistant") & ~t["again"]
        return F.struct(
            (a["at"] + whole(t)).alias("at"),
            F.when(target, F.concat(a["spans"], F.array(F.struct(
                first.alias("start"), (first + F.length(t["body"])).alias("end"))))).otherwise(a["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("spans"))
    return gathered.select(
        "conv_id", "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("text"),
        "repeated",
        F.aggregate("turns", start, step, lambda a: a["spans"]).alias("targets"),
        "tokens",
    )


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation, from windows alone: turns (role, text), loss_text, formatted_chars.

    Turns that a window repeats are left out, and texts are unescaped.
    """
    pieces = F.split("text", CLOSE, -1)
    count = F.size(pieces) - 1
    mine = F.slice(pieces, F.col("repeated").cast("int") + 1, (count - F.col("repeated")).cast("int"))
    turn = lambda p: F.struct(
        unescaped(F.substring(F.substring_index(p, MIDDLE, 1), len(OPEN) + 1, 1 << 30)).alias("role"),
        unescaped(F.substring(p, F.length(F.substring_index(p, MIDDLE, 1)) + len(MIDDLE) + 1, 1 << 30)).alias("text"))
    loss = F.array_join(F.transform("targets", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))), "")
    per_window = windows.select("conv_id", "window", F.transform(mine, turn).alias("turns"), loss.alias("loss"),
                                F.length("text").cast("long").alias("chars"))
    gathered = per_window.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    return gathered.select(
        "conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss_text"), "formatted_chars")
