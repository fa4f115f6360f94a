"""Conversations without quotes, by linking quotations to their originals.

A line's quote level is the number of ``>`` marks before its text. Lines of one
level up to the next blank line or change of level are a passage. Passages are
normalised (lower case, white space as one blank) and hashed. Looked up are single
passages, pairs of neighbouring ones and whole quotations (a run of quoted
passages, or all of one level, that is all that a message wrote itself); each
belongs to the latest message of its conversation before the quoting one that wrote
it itself. Of these messages, a message replies to the one with the longest whole
quotation, then with most pairs, then most passages, then the latest; those quoted
at level 1 come first, and without a quotation that can be placed it is the message
before. Messages are numbered in reply order: turns order replies after what they
answer.

Only hashes and turn numbers are joined; texts do not move. A conversation may
hold a third of all rows: keys of all joins include the passage or the turn, and
positions and latest originals are found in two steps, per range of turns and over
ranges, so that a passage repeated n times costs n rows and no pairs of them.

Defined results: null texts count as empty, have no passages and stay null;
messages without conv_id or turn keep their cleaned text and have no parent and
no position; rows that repeat a turn are numbered side by side and count as one
original; an empty table gives an empty result; other columns pass through
(``clean_text`` and the rest of the results replace columns of these names).
"""

from __future__ import annotations

import re
from itertools import groupby

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1 << 12  # turns that are numbered by one window

_MARKS = re.compile(r"[ \t]*>")
PARTS = "array<struct<level:int,hash:long,kind:int,size:int>>"
ONE, PAIR, WHOLE = 1, 2, 3


def split_level(line: str) -> tuple[int, str]:
    """Quote level of a line and its text after the marks and one blank."""
    level = at = 0
    while m := _MARKS.match(line, at):
        level, at = level + 1, m.end()
    return level, line[at + 1:] if level and line[at:at + 1] == " " else line[at:]


def normalise(passage: str) -> str:
    return " ".join(passage.lower().split())


def parse(text: str | None) -> tuple[str | None, list[tuple[int, int]]]:
    """The text without quoted lines, and (level, hash) of all passages."""
    if text is None:
        return None, []
    own, passages, held, held_level = [], [], [], 0

    def close() -> None:
        words = normalise(" ".join(held))
        if words:
            passages.append((held_level, xxhash.xxh3_64_intdigest(words.encode("utf-8", "surrogatepass")) - (1 << 63)))
        held.clear()

    for line in text.split("\n"):
        level, rest = split_level(line)
        if level != held_level or not rest.strip():
            close()
        held_level = level
        held.append(rest)
        if level == 0:
            own.append(line)
    close()
    return "\n".join(own), passages


def parts(passages: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(level, hash, kind, passages) of all that is looked up: passages, neighbouring
    pairs and whole sequences, which are the runs of a level and all of a level."""
    found = {(level, h, ONE, 1) for level, h in passages}

    def add(level: int, kind: int, hashes: list[int]) -> None:
        data = bytes([kind]) + b"".join(h.to_bytes(8, "little", signed=True) for h in hashes)
        found.add((level, xxhash.xxh3_64_intdigest(data) - (1 << 63), kind, len(hashes)))

    for level in {v for v, _ in passages}:
        hashes = [h for v, h in passages if v == level]
        for pair in zip(hashes, hashes[1:]):
            add(level, PAIR, list(pair))
        add(level, WHOLE, hashes)
    for level, run in groupby(passages, key=lambda p: p[0]):
        if level:  # what a message wrote itself is whole only with all of its runs
            add(level, WHOLE, [h for _, h in run])
    return sorted(found)


def quote(text: Column, level: int = 1) -> Column:
    """A text as a quotation: every line behind ``level`` marks."""
    return F.concat(F.lit("> " * level), F.replace(text, F.lit("\n"), F.lit("\n" + "> " * level)))


def _parsed():
    @F.pandas_udf(f"struct<clean:string,parts:{PARTS}>")
    def run(texts: pd.Series) -> pd.DataFrame:
        both = [parse(t) for t in texts]
        return pd.DataFrame({"clean": pd.Series([c for c, _ in both], dtype=object),
                             "parts": pd.Series([[dict(zip(("level", "hash", "kind", "size"), x)) for x in parts(p)]
                                                 for _, p in both], dtype=object)})
    return run


def positions(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, position, previous): distinct turns of each conversation,
    numbered from 1, and the turn before. Ranges of turns are numbered by
    themselves and shifted by the counts of the ranges before."""
    turns = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    ranged = turns.withColumn("_r", F.floor(F.col("turn") / RANGE))
    within = Window.partitionBy("conv_id", "_r").orderBy("turn")
    before = Window.partitionBy("conv_id").orderBy("_r")
    sizes = ranged.groupBy("conv_id", "_r").agg(F.count(F.lit(1)).alias("_n"), F.max("turn").alias("_last"))
    shifts = sizes.select("conv_id", "_r", F.lag("_last").over(before).alias("_prior"), F.coalesce(
        F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"))
    local = ranged.select("conv_id", "_r", "turn", F.row_number().over(within).alias("_k"),
                          F.lag("turn").over(within).alias("_prev"))
    return local.join(shifts, ["conv_id", "_r"]).select(
        "conv_id", "turn", (F.col("_shift") + F.col("_k")).cast("long").alias("position"),
        F.coalesce("_prev", "_prior").alias("previous"))


def latest_originals(found: DataFrame) -> DataFrame:
    """Quoted parts with ``source``, the latest turn before the quoting one at which
    a message of the conversation wrote the same part itself (level 0); parts without
    one are left out. Ranges of turns are looked through by themselves and get the
    latest of the ranges before."""
    events = found.withColumns({"_own": F.when(F.col("level") == 0, F.col("turn")), "_r": F.floor(F.col("turn") / RANGE)})
    within = Window.partitionBy("conv_id", "hash", "_r").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id", "hash").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = events.groupBy("conv_id", "hash", "_r").agg(F.max("_own").alias("_last")).select(
        "conv_id", "hash", "_r", F.max("_last").over(before).alias("_prior"))
    local = events.withColumn("_near", F.max("_own").over(within)).where("level > 0")
    return (local.join(ranges, ["conv_id", "hash", "_r"]).withColumn("source", F.coalesce("_near", "_prior"))
            .where("source IS NOT NULL").drop("_own", "_near", "_prior", "_r"))


def link_quotations(messages: DataFrame) -> DataFrame:
    """Add clean_text, n_passages (quoted), n_linked (of these, placed),
    parent_turn and position to every message (conv_id, turn, text)."""
    results = ["clean_text", "n_passages", "n_linked", "parent_turn", "position"]
    rows = messages.drop(*results).withColumn("_p", _parsed()("text"))
    found = rows.select("conv_id", "turn", F.explode("_p.parts").alias("p")).where(
        "conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "p.*").distinct()
    placed = latest_originals(found)
    sources = placed.groupBy("conv_id", "turn", "source", (F.col("level") == 1).alias("_first")).agg(
        F.coalesce(F.max(F.when(F.col("kind") == WHOLE, F.col("size"))), F.lit(0)).alias("_whole"),
        F.count_if(F.col("kind") == PAIR).alias("_pairs"), F.count_if(F.col("kind") == ONE).alias("_ones"))
    by_message = sources.groupBy("conv_id", "turn").agg(
        F.max(F.struct("_first", "_whole", "_pairs", "_ones", "source"))["source"].alias("_quoted"),
        F.sum("_ones").alias("_linked"))
    order = positions(messages).join(by_message, ["conv_id", "turn"], "left").select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "position",
        F.coalesce("_quoted", "previous").alias("parent_turn"), F.coalesce("_linked", F.lit(0)).alias("n_linked"))
    n = F.size(F.filter("_p.parts", lambda p: (p["level"] > 0) & (p["kind"] == ONE)))
    return (rows.join(order, (F.col("conv_id") == F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
            .withColumns({"clean_text": F.col("_p.clean"), "n_passages": n.cast("long"),
                          "n_linked": F.coalesce("n_linked", F.lit(0)).cast("long")})
            .drop("_p", "_c", "_t"))


def with_quotations(conversations: DataFrame) -> DataFrame:
    """Messages as mail programs send them: every message quotes the whole
    message before it and, one level deeper, the one before that. Texts are
    found by equality of conversation and turn."""
    keys = conversations.groupBy("conv_id", "turn").agg(F.min("text").alias("_text"))
    back1 = keys.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("_text").alias("_one"))
    back2 = keys.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("_text").alias("_two"))
    joined = conversations.join(back1, ["conv_id", "turn"], "left").join(back2, ["conv_id", "turn"], "left")
    text = F.concat(F.coalesce(F.concat(quote(F.col("_two"), 2), F.lit("\n")), F.lit("")),
                    F.coalesce(F.concat(quote(F.col("_one")), F.lit("\n")), F.lit("")), F.col("text"))
    return joined.withColumn("text", text).drop("_one", "_two")


def op4_sql() -> str:
    """What must come back from the conversations after quoting: the texts that
    were written, in the order of turns, each a reply to the turn before."""
    return """
WITH turns AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position,
         lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS parent_turn
  FROM (SELECT DISTINCT conv_id, turn FROM conversations))
SELECT c.conv_id, c.turn, c.role, t.position, t.parent_turn, sha256(c.text) AS clean_sha256
FROM conversations c LEFT JOIN turns t ON c.conv_id = t.conv_id AND c.turn = t.turn
"""
