"""Quotations in conversations: which message answers which, and messages without quotes.

Lines that begin with ``>`` are quoted, as deep as they have such marks. A passage is a line
without its marks; lowered, with everything but letters and digits as one space, and hashed. A
quoted passage comes from the latest earlier message of its conversation that has it as a line
of its own. A message answers the one that most of its passages of depth one come from, the
later one if two have as many. Answers make threads; a thread begins with a message that
answers none.

The latest earlier message of a passage is a maximum over the turns before: taken within
ranges of TURNS turns and from the ranges before, so that a line that a long conversation
repeats is spread over tasks. Threads are found by jumping from answer to answer, twice
as far in each round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.llm.store import Scratch

TURNS = 1000
_MARKS = r"^([ \t]*>)+"


def own_text(text: str | Column) -> Column:
    """The text without its quoted lines, and without blank lines at either end."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(_MARKS))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, depth, hash) of each line that has a letter or digit."""
    line = F.col("line")
    marks = F.regexp_extract(line, _MARKS, 0)
    depth = F.length(F.regexp_replace(marks, "[^>]", ""))
    plain = F.regexp_replace(F.lower(F.expr("substring(line, length(marks) + 1)")),
                             r"[^\p{L}\p{N}]+", " ")
    return (
        messages.where("conv_id is not null and turn is not null")
        .select("conv_id", "turn", F.explode(F.split("text", "\n")).alias("line"))
        .select("conv_id", "turn", "line", marks.alias("marks"))
        .select("conv_id", "turn", depth.alias("depth"), F.trim(plain).alias("plain"))
        .where("plain != ''")
        .select("conv_id", "turn", "depth", F.md5("plain").alias("hash"))
    )


def _origins(found: DataFrame) -> DataFrame:
    """(conv_id, turn, hash, origin): the latest earlier turn that has the passage itself."""
    facts = (
        found.groupBy("conv_id", "hash", "turn")
        .agg(F.min("depth").alias("least"), F.max("depth").alias("most"))
        .withColumn("range", F.floor(F.col("turn") / TURNS))
        .withColumn("own", F.when(F.col("least") == 0, F.col("turn")))
    )
    key = ["conv_id", "hash", "range"]
    ranges = facts.groupBy(*key).agg(F.max("own").alias("own"))
    earlier = Window.partitionBy("conv_id", "hash").orderBy("range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*key, F.max("own").over(earlier).alias("before"))
    within = Window.partitionBy(*key).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    facts = facts.withColumn("near", F.max("own").over(within)).where("most > 0")
    return facts.join(ranges, key).select(
        "conv_id", "turn", "hash", F.coalesce("near", "before").alias("origin")
    )


def _threads(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, thread, level) of all messages that answer one (conv_id, turn, parent)."""
    jumps = parents.select("conv_id", "turn", F.col("parent").alias("up"), F.lit(1).alias("level"))
    jumps = scratch.save(jumps, "jumps")
    while True:
        above = jumps.select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("next"),
            F.col("level").alias("more"),
        )
        further = jumps.join(above, ["conv_id", "up"], "left").select(
            "conv_id",
            "turn",
            F.coalesce("next", "up").alias("up"),
            (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"),
            F.col("next").isNotNull().alias("moved"),
        )
        further = scratch.save(further, "jumps")
        scratch.drop(jumps)
        jumps = further.drop("moved")
        jumps._scratch_path = further._scratch_path
        if further.where("moved").isEmpty():
            return jumps.select("conv_id", "turn", F.col("up").alias("thread"), "level")


def link_quotations(messages: DataFrame) -> DataFrame:
    """Each message (conv_id, turn, role, text) without quotes and with its place in a thread.

    Returns conv_id, turn, role, parent (the turn it answers or null), thread (the turn that
    its thread begins with), level (answers between them), n_quoted and n_linked (quoted
    passages, and those found in an earlier message; each once per depth and line), and text.
    Sorted by conv_id, thread and turn, every answer follows what it answers.

    Rows that share conv_id and turn are one message to link. A message with a null in either
    links with none, and a null text stays null. Quotes of later or no messages stay unlinked;
    they are cut out all the same. Other columns are dropped.
    """
    scratch = Scratch(messages.sparkSession, "quotations")
    rows = messages.select("conv_id", "turn", "role", "text")
    found = scratch.save(passages(rows), "passages")
    quoted = found.where("depth > 0")
    origin = _origins(found)
    votes = quoted.join(origin, ["conv_id", "turn", "hash"])
    per_origin = votes.groupBy("conv_id", "turn", "origin").agg(
        F.count("*").alias("n"), F.sum((F.col("depth") == 1).cast("long")).alias("direct")
    )
    linked = F.col("origin").isNotNull()
    parent = F.max(F.when(linked & (F.col("direct") > 0), F.struct("direct", "origin")))
    answers = scratch.save(
        per_origin.groupBy("conv_id", "turn").agg(
            parent["origin"].alias("parent"),
            F.sum("n").alias("n_quoted"),
            F.sum(F.when(linked, F.col("n")).otherwise(0)).alias("n_linked"),
        ),
        "answers",
    )
    threads = _threads(answers.where("parent is not null"), scratch)
    key = ["conv_id", "turn"]
    return (
        rows.join(answers, key, "left")
        .join(threads, key, "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "parent",
            F.coalesce("thread", "turn").alias("thread"),
            F.coalesce("level", F.lit(0)).cast("int").alias("level"),
            F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            own_text("text").alias("text"),
        )
    )
