"""Chat formatting by quotation linking.

Lines that begin with ``>`` are quoted; the number of signs is the level. Neighbouring lines of
one level form a passage. Passages, and their lines, are normalised, hashed and joined to the
messages of the same conversation that wrote them first. A message replies to the writer of its
outermost, first linked passage, or else to the message before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store
from .common import bounded_broadcast, present

#: Messages of a conversation are numbered in blocks of so many turns, side by side.
BLOCK_TURNS = 256
#: A block with more messages (many share a turn, or have no conversation) is cut into ranges.
BLOCK_ROWS = 100_000
#: Hashes of quoted passages, and links of messages, are broadcast up to so many rows.
BROADCAST_ROWS = 500_000

_SIGNS = r"^((?:[ \t]*>)+)"
_LINE_QUOTED = r"^[ \t]*>"
_ANY_QUOTED = r"(?m)^[ \t]*>"
_KEY = ["conv", "no_conv", "turn", "role", "text_key"]


def normalised(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def _messages(conversations: DataFrame) -> DataFrame:
    text = present(conversations, "text", "string")
    conv = present(conversations, "conv_id", "bigint")
    # two key columns in place of one that may be null, so that all joins are plain equi-joins
    return conversations.select(
        F.coalesce(conv, F.lit(0).cast("bigint")).alias("conv"), conv.isNull().alias("no_conv"),
        present(conversations, "turn", "bigint").alias("turn"), present(conversations, "role", "string").alias("role"),
        text.alias("text"), F.xxhash64(text).alias("text_key"))


def own_text(text: Column) -> Column:
    """The text without quoted lines and without blanks at its ends."""
    return F.regexp_replace(F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(_LINE_QUOTED)), "\n"),
                            r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """Quoted passages: the message's key, level, at (first line), lines (array), in any order."""
    quoting = messages.where(F.col("text").rlike(_ANY_QUOTED)).dropDuplicates(_KEY)
    lines = quoting.select(*_KEY, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    signs = F.regexp_extract("line", _SIGNS, 1)
    content = F.btrim(F.expr(r"substring(line, length(regexp_extract(line, '^((?:[ \\t]*>)+)', 1)) + 1)"))
    levels = lines.select(*_KEY, "pos", F.length(F.regexp_replace(signs, "[^>]", "")).alias("level"), content.alias("line"))
    quoted = levels.where((F.col("level") > 0) & (F.col("line") != ""))
    # a window holds one message's lines
    run = F.col("pos") - F.row_number().over(Window.partitionBy(*_KEY, "level").orderBy("pos"))
    return (quoted.withColumn("run", run).groupBy(*_KEY, "level", "run")
            .agg(F.min("pos").alias("at"), F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("p"))
            .select(*_KEY, "level", "at", F.transform("p", lambda x: x.line).alias("lines")))


def _wanted(found: DataFrame) -> DataFrame:
    """One row for each hash that may lead a passage to its original: as a whole (0) or by line (1)."""
    whole = F.struct(F.lit(0).alias("by_line"), F.xxhash64(normalised(F.array_join("lines", " "))).alias("hash"))
    single = F.transform("lines", lambda x: F.struct(F.lit(1).alias("by_line"), F.xxhash64(normalised(x)).alias("hash")))
    hashes = F.explode(F.concat(F.array(whole), single)).alias("h")
    return found.select(*_KEY, "level", "at", hashes).select(*_KEY, "level", "at", "h.by_line", "h.hash")


def originals(messages: DataFrame, wanted: DataFrame) -> DataFrame:
    """conv, no_conv, hash, first_turn: who wrote a body, paragraph or line first."""
    own = own_text(F.col("text"))
    parts = messages.select("conv", "no_conv", "turn", own.alias("own")).withColumn(
        "hashes", F.array_distinct(F.transform(
            F.concat(F.array("own"), F.split("own", r"\n[ \t]*\n"), F.split("own", "\n")), lambda x: F.xxhash64(normalised(x)))))
    spoken = parts.select("conv", "no_conv", "turn", F.explode("hashes").alias("hash"))
    asked = bounded_broadcast(wanted.select("conv", "no_conv", "hash").distinct(), BROADCAST_ROWS)
    return (spoken.join(asked, ["conv", "no_conv", "hash"], "left_semi")
            .groupBy("conv", "no_conv", "hash").agg(F.min("turn").alias("first_turn")))


def links(messages: DataFrame) -> DataFrame:
    """The key of each quoting message, n_quotes, n_linked, linked_turn. Stored."""
    wanted = store(_wanted(passages(messages)), "quotes")
    writers = originals(messages, wanted).withColumnRenamed("first_turn", "writer")
    found = wanted.join(writers, ["conv", "no_conv", "hash"], "left").withColumn(
        "writer", F.when(F.col("writer") < F.col("turn"), F.col("writer")))
    # as a whole before by line, outermost first, then the earliest writer
    known = F.col("writer").isNotNull()
    one = found.groupBy(*_KEY, "level", "at").agg(F.min(F.when(known, F.struct("by_line", "writer")))["writer"].alias("writer"))
    return store(one.groupBy(*_KEY).agg(
        F.count("*").alias("n_quotes"), F.count("writer").alias("n_linked"),
        F.min(F.when(known, F.struct("level", "at", "writer")))["writer"].alias("linked_turn")), "links")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, position, turn, role, text, reply_to, n_quotes, n_linked; one row for each message.

    ``text`` is the message's own text, without quotes. ``reply_to`` is the turn it replies to:
    only earlier turns are linked, so that ``position`` (0, 1, 2 … by turn, then role and text)
    puts every message behind the one it replies to. The first message replies to none. Ties of
    turn and role go by text.

    Null ids form one conversation; messages without a turn come first and are never linked.
    Null and empty texts stay as they are. Repeated messages keep their rows. Columns other
    than conv_id, turn, role and text are not looked at. A conversation is never gathered in a
    task: blocks of turns, and ranges of a block with very many messages, are numbered side by side
    and shifted by those before them.
    """
    messages = _messages(conversations)
    linked = bounded_broadcast(links(messages), BROADCAST_ROWS)
    linked = linked.withColumnsRenamed({k: f"l_{k}" for k in _KEY})
    same = F.lit(True)
    for k in _KEY:
        same = same & F.col(k).eqNullSafe(F.col(f"l_{k}"))
    group, order = ["conv", "no_conv"], ["turn", "role", "text", "text_key"]
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 60))).alias("block")

    def with_links(rows: DataFrame, *more: str) -> DataFrame:
        return rows.join(linked, same, "left").select(
            *_KEY, own_text(F.col("text")).alias("text"), "n_quotes", "n_linked", "linked_turn", block, *more)

    # the same key columns without texts: a row for each block
    blocks = messages.select(*group, "turn", block)
    sizes = store(blocks.groupBy(*group, "block").agg(F.count("*").alias("n"), F.max("turn").alias("last")), "blocks")
    known, sizes = with_links(messages).withColumn("range", F.lit(0)), sizes.withColumn("range", F.lit(0))
    crowded = sizes.where(F.col("n") > BLOCK_ROWS).select(*group, "block")
    if crowded.limit(1).count():
        crowded, in_block = bounded_broadcast(crowded, BROADCAST_ROWS), [*group, "block"]
        # the place in the table parts messages that are alike; it is given where they are read
        dealt = with_links(messages.withColumn("place", F.monotonically_increasing_id()), "place").join(crowded, in_block, "left_semi")
        ranges = store(dealt.repartitionByRange(*in_block, *order, "place").withColumn("range", F.spark_partition_id()).drop("place"), "ranges")
        known = known.join(crowded, in_block, "left_anti").unionByName(ranges)
        sizes = sizes.join(crowded, in_block, "left_anti").unionByName(
            ranges.groupBy(*in_block, "range").agg(F.count("*").alias("n"), F.max("turn").alias("last")))
    inside = Window.partitionBy(*group, "block", "range").orderBy(*order)
    numbered = known.withColumns({"k": F.row_number().over(inside) - 1, "before": F.lag("turn").over(inside)})
    ordered = Window.partitionBy(*group).orderBy("block", "range")
    offsets = sizes.select(*group, "block", "range", F.lag("last").over(ordered).alias("last_before"), F.coalesce(
        F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    placed = numbered.join(offsets, [*group, "block", "range"])
    return placed.select(
        F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), (F.col("k") + F.col("offset")).alias("position"), "turn", "role", "text",
        F.coalesce("linked_turn", F.when(F.col("k") > 0, F.col("before")).otherwise(F.col("last_before"))).alias("reply_to"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"))
