"""Chat formatting in budgeted windows, with a loss mask; DataFrame functions only.

A window is what one training example holds: the conversation's system turn, a limited history of turns repeated from
the window before, and the window's own turns. Prefix sums of the turns' tokens choose the windows, so no turn is cut
and no task needs a whole conversation: turn ``t`` belongs to window ``floor(tokens before t / SPAN)``. The loss mask
covers the texts of the assistant turns that are the window's own; repeated ones are masked out, so every target counts once.

Turns look like ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles a backslash is put after the ``<`` of every ``<|`` (and
of every ``<\\|``, ``<\\\\|`` and so on), so a control string in a text never looks like one, and taking one backslash away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.common import ordered_sums

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of a window's own turns, up to the end of the turn that reaches it, and of the history it repeats.
SPAN, HISTORY = 1024, 256
#: Turns in one block of the prefix sums.
BLOCK_TURNS = 512
#: Native stand-in for a vocabulary: pieces of up to six letters or digits, and single other characters.
TOKEN = r"[\p{L}\p{N}]{1,6}|[^\s\p{L}\p{N}]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role stands in one line: its backslashes and line feeds are written as ``\\\\`` and ``\\n``."""
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    pair = F.replace(F.replace(F.replace(role, F.lit("\\\\"), F.lit("\x00")), F.lit("\\n"), F.lit("\n")), F.lit("\x00"), F.lit("\\"))
    return unescaped(pair)


def format_conversations(turns: DataFrame, span: int = SPAN, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id, window, text, loss, n_repeated, n_turns, n_tokens``.

    ``turns`` has ``conv_id, turn, role, text``. ``loss`` is an array of ``start, end`` in code points of ``text``, in order.
    The first ``n_repeated`` of the ``n_turns`` turns are repeated ones: the system turn, if the window isn't the first, and the
    history. Null texts and roles are empty, null ``conv_id`` are one conversation; turns with equal or null numbers go by role and
    text, null numbers first; repeated rows are turns of their own. A turn larger than the span has a window for itself. Other columns are ignored.
    """
    if history > span:
        raise ValueError("history can't be longer than the span")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("body"), F.floor(F.col("turn") / BLOCK_TURNS).alias("_block")
    )
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("head", F.length(head)).withColumn("body", escaped(F.col("body")))
    rows = rows.withColumn("piece", F.concat(head, F.col("body"), F.lit(END + "\n"))).withColumn("tokens", F.regexp_count("piece", F.lit(TOKEN)).cast("long"))
    rows = ordered_sums(rows, ["conv_id"], "_block", ["turn", "role", "body"], "tokens", "_before")
    rows = rows.withColumn("window", F.floor(F.col("_before") / span)).withColumn("system", (F.col("_before") == 0) & (F.col("role") == "system"))
    rows = rows.select("conv_id", "window", "_before", "role", "system", "piece", "tokens", "head", F.length("body").alias("size"))
    windows = rows.groupBy("conv_id", "window").agg(F.min("_before").alias("_begin"))
    order = Window.partitionBy("conv_id").orderBy("window")
    windows = windows.select(
        "conv_id", "window", F.lead("window").over(order).alias("_next"), F.lead("_begin").over(order).alias("_next_begin"), (F.row_number().over(order) > 1).alias("_later")
    )

    def same(a: str, b: str, *columns: str) -> list[Column]:
        return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns]

    placed = rows.alias("r").join(windows.alias("w"), same("r", "w", "conv_id", "window"))
    again = (F.col("w._next_begin") - F.col("r._before") <= history) & ~F.col("r.system")
    both = F.when(again, F.array(F.struct(F.col("r.window").alias("window"), F.lit(False).alias("repeated")), F.struct(F.col("w._next").alias("window"), F.lit(True).alias("repeated"))))
    own = F.array(F.struct(F.col("r.window").alias("window"), F.lit(False).alias("repeated")))
    turns_in = placed.select("r.conv_id", F.inline(F.coalesce(both, own)), *[F.col(f"r.{c}") for c in ("_before", "role", "piece", "tokens", "head", "size")])
    system = rows.where("system").alias("s")
    first = windows.where("_later").alias("w").join(system, same("w", "s", "conv_id"))
    systems = first.select("w.conv_id", "w.window", F.lit(True).alias("repeated"), *[F.col(f"s.{c}") for c in ("_before", "role", "piece", "tokens", "head", "size")])
    members = turns_in.unionByName(systems)
    within = Window.partitionBy("conv_id", "window").orderBy("_before", "repeated")
    start = F.sum(F.length("piece")).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("piece") + F.col("head")
    target = (F.col("role") == "assistant") & ~F.col("repeated")
    span_ = F.when(target, F.struct(start.cast("int").alias("start"), (start + F.col("size")).cast("int").alias("end")))
    members = members.withColumn("_loss", span_)
    # A window's turns are bounded by the span and the history.
    listed = members.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("_before", "piece"))).alias("_pieces"), F.array_sort(F.collect_list("_loss")).alias("loss"),
        F.count_if("repeated").alias("n_repeated"), F.count("*").alias("n_turns"), F.sum("tokens").alias("n_tokens"),
    )
    text = F.array_join(F.col("_pieces.piece"), "")
    return listed.select("conv_id", "window", text.alias("text"), "loss", "n_repeated", "n_turns", "n_tokens")


def read_back(windows: DataFrame) -> DataFrame:
    """One row per window: ``conv_id, window, turns`` (the window's own, as ``role, text``), ``targets`` (texts under the loss mask), ``chars``.

    Only ``text``, ``loss`` and ``n_repeated`` are used.
    """
    pieces = F.split("text", r"<\|im_end\|>\n")
    own = F.slice(pieces, F.col("n_repeated").cast("int") + 1, F.size(pieces) - 1 - F.col("n_repeated").cast("int"))

    def turn(piece: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        return F.struct(
            unescaped_role(F.substring(line, F.lit(len(START) + 1), F.length(line))).alias("role"),
            unescaped(F.substring(piece, F.length(line) + 2, F.length(piece))).alias("text"),
        )

    targets = F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return windows.select("conv_id", "window", F.transform(own, turn).alias("turns"), targets.alias("targets"), F.length("text").alias("chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from what its windows hold: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows``.

    A digest is of one string, so a conversation's windows meet here; formatting does without.
    """
    read = read_back(windows)
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = read.select("conv_id", "window", F.size("turns").alias("n"), joined.alias("told"), F.array_join("targets", "").alias("loss"), "chars")
    whole = each.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "told", "loss"))).alias("_all"),
        F.sum("chars").cast("long").alias("formatted_chars"), F.count("*").alias("n_windows"),
    )
    told, loss = F.array_join(F.col("_all.told"), ""), F.array_join(F.col("_all.loss"), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_windows",
    )
