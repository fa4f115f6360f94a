"""Spelling variants: words one edit apart, found by blocked Gram matrices.

A word's letter counts are a vector (code points folded to LETTERS places). One
replaced letter changes the squared distance of two such vectors by at most two, one
inserted or deleted letter by one, so near words are among the pairs at squared
distance two or less in the same or the adjacent length block. The distances of a
block come from one matrix product: |x - y|^2 = |x|^2 + |y|^2 - 2 x.y. Each pair
kept is verified letter by letter.

Length blocks are cut further without losing a pair: of two words one edit apart, the
shorter of m letters, either the first m // 2 letters are equal or the last m - m // 2.
A word of length L is therefore in the blocks of its head and of its tail for m = L and
for m = L - 1, four in all. Blocks of more than TILE words are dealt out to tiles by a
hash of the word; every pair of tiles is a block of its own, so that no block that a
task holds grows with the data. Small blocks are multiplied together, SLAB rows at a
time, and pairs across blocks are masked. A pair is kept in one block only: that of
the common head if there is one, else that of the common tail.

Defined results: null texts have no words; a null doc_id counts as ''. Repeated rows are
documents of their own. Words of equal n are ordered by code points. An empty table
gives an empty result; columns beyond doc_id and the text are not read. Words may be
of any length; counts that float32 cannot square exactly are multiplied as float64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged, tasks

LETTERS = 32     # places of a letter-count vector
TILE = 1024      # words of a block that stay together
SLAB = 256       # rows of small blocks multiplied at once

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "[A-Za-zÀ-ÿ]+"


def occurrences(docs: DataFrame, least: int = 7) -> DataFrame:
    """(word) for every run of letters that has at least ``least`` code points after
    its fixed deletion: where 31 divides the crc32 of ``doc_id:run``, the code point at
    crc32 % length goes."""
    runs = F.filter(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({_RUN})")), lambda r: F.char_length(r) >= least)
    low = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run")).select(
        "doc", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = low.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return h.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word")).where(F.char_length("word") >= least)


def one_edit(a: str, b: str) -> bool:
    """Whether ``b``, as long as ``a`` or one longer, differs by exactly one edit."""
    if len(a) > len(b) or len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of LETTERS counts per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32) % LETTERS
    at = np.repeat(np.arange(len(words)) * LETTERS, lengths) + letters
    return np.bincount(at, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)


def close_pairs(words: list[str], block: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of one block at squared distance two or less, i of length m and j of
    length m or m + 1; pairs of equal length once."""
    counts = letter_counts(words)
    exact = np.float32 if (counts.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 1 << 22 else np.float64
    x = counts.astype(exact)
    square = (x * x).sum(axis=1)
    near = (square[:, None] + square[None, :] - 2 * (x @ x.T)) <= 2
    near &= block[:, None] == block[None, :]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    short = lengths == m
    near &= short[:, None]
    near &= np.triu(np.ones_like(near), 1) | ~short[None, :]
    return np.nonzero(near)


def _slabs(g: np.ndarray, size: int):
    """(start, end) of consecutive whole blocks of sorted ``g``, about ``size`` rows each."""
    ends = np.append(np.flatnonzero(g[1:] != g[:-1]) + 1, len(g))
    at = 0
    while at < len(g):
        k = max(np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + size, "right") - 1)
        yield at, int(ends[k])
        at = int(ends[k])


def _near(batches):
    """From rows (g, m, tail, tile, across, word, n), sorted by block ``g``: (word, other,
    other_n) in both directions for every verified pair."""
    held = None
    names = ["g", "m", "tail", "tile", "across", "n"]

    def found(cols, words):
        out = []
        for lo, hi in _slabs(cols["g"], SLAB):
            if hi - lo < 2:
                continue
            some, m = words[lo:hi], cols["m"][lo:hi]
            i, j = close_pairs(some, cols["g"][lo:hi], m)
            apart = ~cols["across"][lo:hi][i] | (cols["tile"][lo:hi][i] != cols["tile"][lo:hi][j])
            for a, b in zip((i[apart] + lo).tolist(), (j[apart] + lo).tolist()):
                x, y, size = words[a], words[b], int(cols["m"][a])
                if size != cols["m"][b] or cols["tail"][a] != cols["tail"][b]:
                    continue  # two blocks of one hash
                half = size // 2
                head = x[:half] == y[:half]
                if head == bool(cols["tail"][a]) or not one_edit(x, y):
                    continue
                out += [(x, y, int(cols["n"][b])), (y, x, int(cols["n"][a]))]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
            (pa.string(), pa.string(), pa.int64()))], ["word", "other", "other_n"])

    for batch in batches:
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        words = batch.column("word").to_pylist()
        if held is not None:
            cols, words = {c: np.concatenate([held[0][c], cols[c]]) for c in names}, held[1] + words
        # The last block may go on in the next batch.
        last = int(np.searchsorted(cols["g"], cols["g"][-1])) if len(words) else 0
        yield found({c: v[:last] for c, v in cols.items()}, words[:last])
        held = {c: v[last:] for c, v in cols.items()}, words[last:]
    if held is not None:
        yield found(*held)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n), in both directions, for every two of the distinct words
    (word, n) that are one edit apart."""
    length = F.char_length("word")

    def part(m: Column, tail: bool) -> Column:
        half = F.floor(m / 2).cast("int")
        return F.substring("word", -(m - half), m - half) if tail else F.substring("word", F.lit(1), half)

    places = F.array(*[F.struct(m.alias("m"), F.lit(tail).alias("tail"), F.xxhash64(m, F.lit(tail), part(m, tail)).alias("key"))
                       for m in (length, length - 1) for tail in (False, True)])
    rows = words.select("word", "n", F.inline(places))
    # Blocks of more than a tile: few, since a block has a tile of words at least.
    large = rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > TILE)
    tiles = F.coalesce(F.ceil(F.col("size") / TILE), F.lit(1)).cast("int")
    placed = rows.join(large, "key", "left").withColumn("tiles", tiles).withColumn(
        "tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with")
    blocks = placed.select("key", "m", "tail", "word", "n", "tile", others).select(
        F.xxhash64("key", F.least("tile", "with"), F.greatest("tile", "with")).alias("g"), F.col("m").cast("long").alias("m"),
        "tail", "tile", (F.col("tile") != F.col("with")).alias("across"), "word", "n")
    dealt = blocks.repartition(tasks(words.sparkSession), "g").sortWithinPartitions("g")
    return dealt.mapInArrow(_near, "word string, other string, other_n long")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms of every word that has a form. A
    form is ten times as frequent, so chains are short; each round doubles the steps."""
    done = staged(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = done.select(F.col("word").alias("root"), F.col("root").alias("up"))
        new = staged(done.join(up, "root", "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        done = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return done


def spelling_variants(docs: DataFrame, least: int = 7, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least ``least`` code points
    with two occurrences or more; a form is ``times`` as frequent at least."""
    words = staged(occurrences(docs, least).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2"), "words")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("down"), "other")).alias("best"))
    fits = -F.col("best.down") >= times * F.col("n")
    formed = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.other")).alias("form"),
        F.when(fits, -F.col("best.down")).alias("form_n")), "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
