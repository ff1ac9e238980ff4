"""Chat formatting by quotation linking, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A line that announces a quotation, when it stands right before one.
ANNOUNCES = r"(?m)^[^\n>]*\b(?:wrote|writes|schrieb|écrit|escribió)\b[^\n>]*:[ \t]*\n(?=>)"
PASSAGE = r"(?m)(^(>+)(?!>)[^\n]*(?:\n\2(?!>)[^\n]*)*)"


def _marked(text: Column) -> Column:
    """The text with quote marks pulled together at the start of each line."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    return F.regexp_replace(text, r"(?m)(?:^[ \t]*|(?<=>)[ \t]+)(?=>)", "")


def _plain(text: Column) -> Column:
    return F.btrim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def _hash(text: Column) -> Column:
    return F.sha2(text, 256)


def _units(text: Column) -> Column:
    """Hashes of a text as a whole and of its lines; empty ones left out."""
    lines = F.filter(F.transform(F.split(text, "\n"), _plain), lambda line: line != "")
    return F.transform(lines, _hash)


def parse_quotes(messages: DataFrame) -> DataFrame:
    """Messages with own (text without quotes) and passages: level and body of each run of lines of one quote level."""
    marked = messages.withColumn("_marked", _marked(F.col("text")))
    passages = F.transform(F.regexp_extract_all("_marked", F.lit(PASSAGE), 1), lambda p: F.struct(
        F.length(F.regexp_extract(p, "^(>+)", 1)).alias("level"), F.regexp_replace(p, "(?m)^>+ ?", "").alias("body")))
    own = F.regexp_replace(F.regexp_replace("_marked", ANNOUNCES, ""), r"(?m)^>[^\n]*(?:\n|$)", "")
    return marked.select(*messages.columns, F.btrim(own, F.lit(" \t\n")).alias("own"), passages.alias("passages"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """Chat messages in reply order: conv_id, turn, role, text without quotes, n_quotes, max_level, reply_to, place, chat.

    A run of lines with equally many quote marks is a quoted passage. Its normalised text (lower case, single blanks),
    or else one of its lines, is looked up by hash among the own texts and lines of the messages of the conversation;
    the first message that holds it is the original. reply_to is the turn of the original quoted at the lowest level (whole
    passages before lines, then the latest); without quotes it is null. place is the turn that a message follows: that
    of its original, or its own; rows sorted by (conv_id, place, turn) put replies to one message side by side, after
    it. chat is the message in the form of a chat template.

    Null text is an empty message; null conv_id or turn is never linked. Repeated rows stay, each with the same
    link. A message never links to itself or to a later turn. Other columns are not read; an empty table gives no row.
    """
    parsed = parse_quotes(messages.select("conv_id", "turn", "role", "text"))
    # The first message of a conversation that holds a text or line; one row per task and hash before the shuffle.
    held = F.array_distinct(F.concat(F.array(_hash(_plain(F.col("own")))), _units(F.col("own"))))
    originals = parsed.where("own <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", F.explode(held).alias("h")).groupBy("conv_id", "h").agg(F.min("turn").alias("origin"))
    quoted = parsed.where(F.size("passages") > 0).select("conv_id", "turn", F.explode("passages").alias("p"))
    keys = F.concat(
        F.array(F.struct(F.lit(0).alias("rank"), _hash(_plain(F.col("p.body"))).alias("h"))),
        F.transform(_units(F.col("p.body")), lambda h: F.struct(F.lit(1).alias("rank"), h.alias("h"))))
    wanted = quoted.select("conv_id", "turn", F.col("p.level").alias("level"), F.explode(keys).alias("k")).select(
        "conv_id", "turn", "level", "k.rank", "k.h").groupBy("conv_id", "turn", "h").agg(F.min(F.struct("level", "rank")).alias("by"))
    found = wanted.join(originals, ["conv_id", "h"]).where("origin < turn").groupBy("conv_id", "turn").agg(
        F.min(F.struct("by", (-F.col("origin")).alias("origin"))).alias("best"))
    links = found.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), (-F.col("best.origin")).alias("reply_to"))
    joined = parsed.join(links, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    chat = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("own"), F.lit("\n<|end|>"))
    levels = F.coalesce(F.array_max(F.transform("passages", lambda p: p["level"])), F.lit(0))
    return joined.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.size("passages").cast("long").alias("n_quotes"),
        levels.cast("long").alias("max_level"), "reply_to", F.coalesce("reply_to", "turn").alias("place"), chat.alias("chat"),
    ).orderBy("conv_id", "place", "turn")
