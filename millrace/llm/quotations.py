"""Reply structure of conversations from the quotations in their messages.

Lines that begin with ``>`` marks are quoted, as deep as they have marks. Quoted paragraphs of
all levels are normalised and hashed, and meet the paragraphs that other messages of the
conversation wrote themselves; a message replies to the message it quotes most at the first
level at which one is found, so a reply that kept only deeper quotations still has a place. Messages
without a linked quotation begin threads. What is returned is each message without its
quotations, with its place in its thread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tools import stored

_MARKS = r"^[ \t]*(?:>[ \t]?)+"
# How mail programs announce a quotation.
_ANNOUNCED = r"(?i)^\s*\S.*\b(?:wrote|writes|said|schrieb|a écrit|escribió|ha scritto)\s*:\s*$"


def _lines(text: Column) -> Column:
    """``level, content`` of each line; -1 for a line that announces the quotation below it."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n")

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.substr(line, F.length(marks) + 1).alias("content"))

    return F.transform(lines, parse)


def _announced(lines: str) -> Column:
    def mark(line: Column, i: Column) -> Column:
        below = F.coalesce(F.get(F.col(lines), i + 1)["level"], F.lit(0))
        announces = (line["level"] == 0) & (below > 0) & F.regexp_like(line["content"], F.lit(_ANNOUNCED))
        return F.struct(F.when(announces, -1).otherwise(line["level"]).alias("level"), line["content"].alias("content"))

    return F.transform(lines, mark)


def _at_level(lines: str, level: Column | int) -> Column:
    """The lines of one level, with an empty line where others stood."""
    return F.array_join(F.transform(lines, lambda line: F.when(line["level"] == level, line["content"]).otherwise("")), "\n")


def _paragraphs(text: Column) -> Column:
    """Hashes of the distinct paragraphs of a text in lower case, runs of white space as one space."""
    plain = F.transform(F.split(text, r"\n[ \t]*(?:\n[ \t]*)+"), lambda p: F.trim(F.regexp_replace(F.lower(p), r"\s+", " ")))
    kept = F.array_distinct(F.filter(plain, lambda p: p != ""))
    return F.transform(kept, lambda p: F.struct(F.xxhash64(p).alias("high"), F.xxhash64(F.lit("second"), p).alias("low")))


def _quoted() -> Column:
    """The paragraphs of every level below the text itself, each with its level."""

    def of_level(level: Column) -> Column:
        return F.transform(_paragraphs(_at_level("lines", level)), lambda p: F.struct(p["high"].alias("high"), p["low"].alias("low"), level.alias("level")))

    levels = F.array_distinct(F.filter(F.transform("lines", lambda line: line["level"]), lambda level: level > 0))
    return F.flatten(F.transform(levels, of_level))


def parsed(messages: DataFrame) -> DataFrame:
    """Distinct messages with ``own`` text, hashes of ``written`` and ``quoted`` paragraphs, and the deepest quotation."""
    rows = messages.select("conv_id", "turn", "role", "text").distinct()
    rows = rows.withColumn("lines", _lines(F.col("text"))).withColumn("lines", _announced("lines"))
    own = F.regexp_replace(F.regexp_replace(_at_level("lines", 0), r"\n[ \t]*(?:\n[ \t]*)+", "\n\n"), r"^\s+|\s+$", "")
    return rows.select(
        "conv_id", "turn", "role", F.xxhash64("role", "text").alias("message"), own.alias("own"),
        _paragraphs(_at_level("lines", 0)).alias("written"), _quoted().alias("quoted"),
        F.greatest(F.array_max(F.transform("lines", lambda line: line["level"])), F.lit(0)).alias("deepest"),
    )


def replies(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, message, reply_to, n_linked`` of messages that quote an earlier turn.

    Of several messages that wrote a quoted paragraph the last before the quotation counts. One
    window per conversation and paragraph that is quoted finds it, without pairs. Paragraphs of a
    deeper level count only for messages of which none of a level above is found.
    """
    def each(name: str, kind: int, level: Column) -> DataFrame:
        exploded = rows.select("conv_id", "turn", "message", F.explode_outer(name).alias("hash")).filter("hash is not null")
        hashed = F.struct("hash.high", "hash.low").alias("hash")
        return exploded.select("conv_id", "turn", "message", level.cast("int").alias("level"), hashed, F.lit(kind).alias("quotes"))

    quoted = each("quoted", 1, F.col("hash.level"))
    wanted = quoted.select("conv_id", "hash").distinct()
    written = each("written", 0, F.lit(0)).join(wanted, ["conv_id", "hash"], "left_semi").select(*quoted.columns)
    order = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    source = F.max(F.when(F.col("quotes") == 0, F.col("turn"))).over(order)
    found = quoted.union(written).withColumn("source", source).filter("quotes = 1 and source is not null")
    counts = found.groupBy("conv_id", "turn", "message", "level", "source").agg(F.count("*").alias("n"))
    levels = counts.groupBy("conv_id", "turn", "message", "level").agg(
        F.max(F.struct("n", "source")).alias("best"), F.sum("n").alias("n_linked")
    )
    first = F.min(F.struct("level", F.col("best.source").alias("source"), "n_linked"))
    return levels.groupBy("conv_id", "turn", "message").agg(first.alias("first")).select(
        "conv_id", "turn", "message", F.col("first.source").alias("reply_to"), F.col("first.n_linked").alias("n_linked")
    )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Messages in threads: ``conv_id, root, depth, turn, role, text, reply_to, quoted, linked, deepest``.

    ``conv_id, root, depth, turn`` give the order to read a conversation in: ``root`` is the turn
    that began the thread, ``depth`` how many replies lie between. ``text`` is without
    quotations; ``quoted`` counts paragraphs quoted at the first level, ``linked`` those found at
    the level that decided.
    Rows that are equal in all four columns are one message; different messages may share a
    turn. Null texts are empty; messages without a conversation or a turn are threads of their own,
    with a null root if the turn is null. Extra columns are ignored.
    """
    rows = stored(parsed(messages), "quotation-messages")
    linked = rows.filter("conv_id is not null and turn is not null")
    found = stored(replies(linked), "quotation-replies")
    # Threads by pointer jumping over the turns that reply: each round doubles the reach.
    jumps = found.groupBy("conv_id", "turn").agg(F.max("reply_to").alias("to")).withColumn("hops", F.lit(1).cast("long"))
    jumps = stored(jumps, "quotation-jumps")
    while True:
        on = jumps.select(F.col("conv_id").alias("of"), F.col("turn").alias("at"), F.col("to").alias("next"), F.col("hops").alias("more"))
        joined = jumps.join(on, (F.col("conv_id") == F.col("of")) & (F.col("to") == F.col("at")), "left")
        moved = joined.select(
            "conv_id", "turn", F.coalesce("next", "to").alias("to"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            F.col("next").isNotNull().alias("moved"),
        )
        moved = stored(moved, "quotation-jumps")
        jumps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            break
    above = jumps.select(F.col("conv_id").alias("j_conv"), F.col("turn").alias("j_turn"), F.col("to").alias("j_root"), F.col("hops").alias("j_hops"))
    found = found.select(F.col("conv_id").alias("r_conv"), F.col("turn").alias("r_turn"), F.col("message").alias("r_message"), "reply_to", "n_linked")
    same = (F.col("conv_id") == F.col("r_conv")) & (F.col("turn") == F.col("r_turn")) & (F.col("message") == F.col("r_message"))
    threaded = rows.join(found, same, "left").join(above, (F.col("conv_id") == F.col("j_conv")) & (F.col("reply_to") == F.col("j_turn")), "left")
    return threaded.select(
        "conv_id",
        F.coalesce("j_root", "reply_to", "turn").alias("root"),
        F.when(F.col("reply_to").isNull(), 0).otherwise(F.coalesce("j_hops", F.lit(0)) + 1).cast("long").alias("depth"),
        "turn", "role", F.col("own").alias("text"), "reply_to", F.size(F.filter("quoted", lambda p: p["level"] == 1)).alias("quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("linked"), "deepest",
    )
