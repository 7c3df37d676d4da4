"""Operator 6: conversations linked by their quotations.

Messages may quote earlier ones in lines that start with ``>``, nested by
more marks.  A message's lines are split by quote level; a passage is a line,
normalised (marks and outer blanks dropped, inner blanks to one, lower case)
and hashed.  Every line that a message writes itself (level 0) is an entry of
the index.  The lines that a message quotes at one level are a block; its
original is, of all earlier turns of the own conversation and all messages of
earlier conversations, the one that wrote most lines of the block.  Of several
with most lines, the own conversation goes first, there the latest turn, and
elsewhere the first message.  Equal blocks are looked up once, and of messages
that wrote the same quoted lines only the first, so lines that many share
cost one row for each different set of lines, not one for each message.

Level 1 names the parent; a deeper level names the parent's parent, and links
it where that message quotes nothing itself.
Messages come before what quotes them, so links never form a circle.
Conversations that quote one another become one thread, named by the first.

The result has every message: its text without quotes, its thread, its parent
(null: it follows the turn before it) and how deep its chain of replies is.
Ordered by (conv_id, turn) within a thread, replies follow what they answer.

Defined results: null and empty texts have no lines and quote nothing; a
message of quotes alone has an empty text; blank lines and lines without
letters or digits are no passages; messages with a null conv_id or turn pass
through and neither quote nor are quoted; of repeated rows with the same
(conv_id, turn) each passes through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import stored
from runledger.llm.components import components

# A marker is ">" with blanks around it; up to this level, all deeper the same
MARKS = r"^[\s>]*>"    # one class: the match needs no stack, however long


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(F.regexp_replace(marks, r"[^>]", ""))


def _body(line: Column) -> Column:
    return F.regexp_replace(line, MARKS, "")


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(_body(line), r"\s+", " ")))


def _lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage of every line that is a passage."""
    line = F.explode(F.split(F.coalesce("text", F.lit("")), r"\r?\n"))
    return (messages.filter("conv_id is not null and turn is not null")
            .select("conv_id", "turn", line.alias("line"))
            .select("conv_id", "turn", _level(F.col("line")).alias("level"),
                    normalised(F.col("line")).alias("passage"))
            .filter(F.col("passage").rlike(r"[\p{L}\p{N}]")))


def _set_name(passages: Column) -> Column:
    """Name of a set of passages, which hold no line feeds."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(passages)), "\n")
                  .cast("binary"), 256)


def _originals(lines: DataFrame) -> DataFrame:
    """conv_id, turn, level, o_conv, o_turn: what each block quotes.

    The passage itself stands beside its hash in every join, so passages of
    equal hash are kept apart.
    """
    key = F.xxhash64("passage").alias("hash")
    quoted = stored(lines.filter("level > 0").select(
        "conv_id", "turn", "level", "passage", key).distinct(), "quotes")
    wanted = stored(quoted.select("hash", "passage").distinct(),
                    "quotes-wanted")
    written = stored(lines.filter("level = 0").select(
        "conv_id", "turn", "passage", key).join(
        wanted, ["hash", "passage"]).distinct(), "quotes-index")
    at = ["conv_id", "turn", "level"]
    # Within the conversation: every earlier turn.
    near = (quoted.join(written.select(
        "hash", "passage", "conv_id", F.col("turn").alias("o_turn")),
        ["hash", "passage", "conv_id"]).filter("o_turn < turn")
        .groupBy(*at, "o_turn").agg(F.count(F.lit(1)).alias("n"))
        .select(*at, "n", F.lit(1).alias("own"),
                F.col("conv_id").alias("x"), F.col("o_turn").alias("y")))
    # Elsewhere: the different sets of lines, quoted and written, meet; of
    # the messages with as many lines of a block the first is enough.
    blocks = stored(quoted.groupBy(*at).agg(
        _set_name(F.col("passage")).alias("block")), "quotes-blocks")
    block_lines = stored(quoted.join(blocks, at).select(
        "block", "hash", "passage").distinct(), "quotes-block-lines")
    messages = stored(written.groupBy("conv_id", "turn").agg(
        _set_name(F.col("passage")).alias("wrote")), "quotes-messages")
    first = stored(messages.groupBy("wrote").agg(F.min(F.struct(
        "conv_id", "turn")).alias("o")), "quotes-first")
    wrote_lines = stored(written.join(
        first.select("wrote", "o.*"), ["conv_id", "turn"]).select(
        "wrote", "hash", "passage"), "quotes-wrote-lines")
    shared = (block_lines.join(wrote_lines, ["hash", "passage"])
              .groupBy("block", "wrote").agg(F.count(F.lit(1)).alias("n")))
    firsts = stored(shared.join(first, "wrote").groupBy("block", "n").agg(
        F.min("o").alias("o")), "quotes-candidates")
    far = (blocks.join(firsts.select(
        "block", "n", F.col("o.conv_id").alias("o_conv"),
        F.col("o.turn").alias("o_turn")), "block")
           .filter("o_conv < conv_id")
           .select(*at, "n", F.lit(0).alias("own"),
                   (-F.col("o_conv")).alias("x"),
                   (-F.col("o_turn")).alias("y")))
    best = near.unionByName(far).groupBy(*at).agg(
        F.max(F.struct("n", "own", "x", "y")).alias("b"))
    sign = F.col("b.own") * 2 - 1
    return best.select(*at, (F.col("b.x") * sign).alias("o_conv"),
                       (F.col("b.y") * sign).alias("o_turn"))


def _links(lines: DataFrame) -> DataFrame:
    """conv_id, turn, p_conv, p_turn: one parent for each reply."""
    best = stored(_originals(lines), "quotes-best")
    own = best.filter("level = 1").select(
        "conv_id", "turn", F.col("o_conv").alias("p_conv"),
        F.col("o_turn").alias("p_turn"))
    # A message at level n was answered by the one at level n - 1.
    deeper = best.select(
        F.col("o_conv").alias("p_conv"), F.col("o_turn").alias("p_turn"),
        (F.col("level") - 1).alias("level"), F.col("conv_id").alias("q_conv"),
        F.col("turn").alias("q_turn"))
    above = best.select(
        F.col("conv_id").alias("q_conv"), F.col("turn").alias("q_turn"),
        "level", F.col("o_conv").alias("conv_id"),
        F.col("o_turn").alias("turn"))
    inferred = (above.join(deeper, ["q_conv", "q_turn", "level"])
                .filter("struct(p_conv, p_turn) < struct(conv_id, turn)")
                .groupBy("conv_id", "turn").agg(F.max(F.struct(
                    "p_conv", "p_turn")).alias("p"))
                .select("conv_id", "turn", "p.*")
                .join(own.select("conv_id", "turn"), ["conv_id", "turn"],
                      "left_anti"))
    return stored(own.unionByName(inferred), "quotes-links")


def _depths(links: DataFrame) -> DataFrame:
    """conv_id, turn, depth: number of links up to a message without one.
    Each round doubles the length of the jumps."""
    jumps = links.withColumn("depth", F.lit(1))
    while True:
        far = jumps.select(F.col("conv_id").alias("p_conv"),
                           F.col("turn").alias("p_turn"),
                           F.col("p_conv").alias("f_conv"),
                           F.col("p_turn").alias("f_turn"),
                           F.col("depth").alias("more"))
        new = stored(jumps.join(far, ["p_conv", "p_turn"], "left").select(
            "conv_id", "turn", F.col("f_conv").alias("p_conv"),
            F.col("f_turn").alias("p_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")),
            "quotes-depths")
        if not new.filter("p_conv is not null").limit(1).count():
            return new.select("conv_id", "turn", "depth")
        jumps = new


def without_quotes(text: Column) -> Column:
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), r"\r?\n"),
                    lambda line: _level(line) == 0)
    return F.trim(F.array_join(kept, "\n"))


def conversations(messages: DataFrame) -> DataFrame:
    """Every message with thread_id, parent_conv, parent_turn, depth, and
    its text without quotes."""
    rows = messages.select("conv_id", "turn", "role", "text")
    out = rows.select("conv_id", "turn", "role",
                      without_quotes(F.col("text")).alias("text"))
    links = _links(_lines(rows))
    crossing = stored(links.filter("p_conv <> conv_id").select(
        F.col("conv_id").alias("a"), F.col("p_conv").alias("b")).distinct(),
        "quotes-crossing")
    threads = components(crossing).select(
        F.col("node").alias("conv_id"), F.col("label").alias("thread"))
    replies = stored(links.join(_depths(links), ["conv_id", "turn"]),
                     "quotes-replies")
    return (out.join(threads, "conv_id", "left")
            .join(replies, ["conv_id", "turn"], "left")
            .select(F.coalesce("thread", "conv_id").alias("thread_id"),
                    "conv_id", "turn", "role", "text",
                    F.col("p_conv").alias("parent_conv"),
                    F.col("p_turn").alias("parent_turn"),
                    F.coalesce("depth", F.lit(0)).alias("depth")))
