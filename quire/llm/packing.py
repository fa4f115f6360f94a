"""Best-fit packing into sequences of several permitted lengths.

Items (documents, in pieces of at most the largest capacity) are packed longest
first. An item goes to the open bin with the least room that still holds it. If
there is none, a bin opens in the size with the least cost per token it can still
be filled with, so the permitted sizes are weighed against each other and against
what is left to pack. At the end every bin shrinks to the smallest permitted size
that holds its contents.

Items are dealt by hash into shards of about ITEMS and each shard is packed by
itself; only lengths travel, not texts. A shard leaves a few badly filled bins at
most, against hundreds of full ones.

Defined results: an item's length is its number of words plus one end mark, so
null and empty texts have length 1. Rows without an id and repeated rows are items
like any other. Ties are taken in order of id and piece. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 32     # cost of a sequence beside its capacity, in tokens
ITEMS = 2_500     # items a shard holds on average


def cost(capacity: int) -> float:
    """Cost of one sequence: its capacity (padding included), a fixed part, and
    a part that grows with the square of the length (attention)."""
    return capacity + OVERHEAD + capacity * capacity / 65_536


def pack(lengths: list[int], capacities=CAPACITIES, cost_of=cost) -> tuple[list[int], list[int], list[int]]:
    """Bins of items that come longest first: (bin, position in it) per item and
    the final capacity per bin."""
    sizes = sorted(capacities)
    by_room: dict[int, list[int]] = {}
    rooms = 0                      # bit r is set if an open bin has room r
    used: list[int] = []
    left = sum(lengths)
    bins, positions, room_of = [], [], []
    for n in lengths:
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            # Costs are compared per token that the bin can still receive.
            size = min((c for c in sizes if c >= n), key=lambda c: (cost_of(c) / min(c, left), c))
            b, room = len(used), size
            used.append(0)
            room_of.append(size)
        bins.append(b)
        positions.append(used[b])
        used[b] += n
        left -= n
        room -= n
        room_of[b] = room
        if room:
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
    return bins, positions, [next(c for c in sizes if c >= u) for u in used]


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    t = F.coalesce(text, F.lit(""))
    return F.size(F.filter(F.split(t, r"[ \t-\r]+"), lambda w: w != "")).cast("long")


def pack_documents(docs: DataFrame, length: Column, capacities=CAPACITIES, items: int = ITEMS) -> DataFrame:
    """Where every piece of every document goes: doc_id, piece (from 0),
    first_token, n_tokens, seq_id, position (of its first token in the
    sequence), capacity (of the sequence)."""
    largest = max(capacities)
    lengths = docs.select("doc_id", length.cast("long").alias("_n"))
    # A document beyond the largest capacity becomes full pieces and a rest.
    pieces = lengths.select("doc_id", "_n", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("_n") - 1) / largest).cast("int"))).alias("piece")).select(
        "doc_id", "piece", (F.col("piece").cast("long") * largest).alias("first_token"),
        F.least(F.lit(largest).cast("long"), F.col("_n") - F.col("piece").cast("long") * largest).alias("n_tokens"))
    total = docs.count()
    shards = max(1, math.ceil(total / items))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, positions, caps = pack(pdf.n_tokens.astype(int).tolist(), capacities)
        shard = int(pdf["shard"].iloc[0])
        return pd.DataFrame({
            "doc_id": pdf.doc_id.astype("Int64"), "piece": pdf.piece, "first_token": pdf.first_token,
            "n_tokens": pdf.n_tokens, "seq_id": [(shard << 32) + b for b in bins], "position": positions,
            "capacity": [caps[b] for b in bins]})

    return dealt.groupBy("shard").applyInPandas(
        place, "doc_id long, piece int, first_token long, n_tokens long, seq_id long, position long, capacity int")


def sequences(layout: DataFrame) -> DataFrame:
    """One row per sequence: capacity, tokens used, its documents in order."""
    return layout.groupBy("seq_id").agg(
        F.first("capacity").alias("capacity"), F.sum("n_tokens").alias("used"),
        F.transform(F.sort_array(F.collect_list(F.struct("position", "doc_id", "piece"))),
                    lambda x: x["doc_id"]).alias("doc_ids"))


def pack_by_words(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, word_count(F.col("text")) + 1)
