"""Near-duplicates by MinHash with tensored banding, confirmed on full sets.

A document's set is its distinct word shingles (64-bit hashes). COLLECTIONS small
collections of ROWS minhashes each are computed; every pair of collections is one
table and the two collection values together are its key. 18 collections of 4
(72 minhashes) so give 153 tables of 8 rows, for which plain banding would need
1,224 minhashes. Two sets of similarity 0.8 share a key with probability 0.999,
0.85 with 0.99996.

Work per group of copies stays linear:
  * equal sets are one class (a pre-aggregated group-by), which goes on as one row;
  * each class is first compared with the smallest class of the buckets it is in,
    and confirmed links are joined to components;
  * in buckets that still hold several components, each member is compared with a
    few hubs of its buckets, twice;
  * members of buckets that then still hold several are joined exactly, by prefixes.
    Their shingles are ordered by the number of components they occur in, rarest first;
    of n shingles the first n - ceil(0.8 n) + 1 are a set's prefix, and two sets of
    similarity 0.8 share a shingle of their prefixes. Shingles of one component only come
    first and can be shared with no other, so a document that is mostly its own has
    no prefix left and a passage that many share comes last and joins nobody. A pair
    is made at the first shingle its prefixes share; pairs that sizes or sketches rule
    out are dropped within the join, and the rest is confirmed too;
  * where a shingle of prefixes still has more than HOT members (many variants of one text
    that are just too different to link), pairs are not laid out at all: members go to
    pairs of tiles, whose intersections are the products of their set matrices, and only
    links leave the task.

Every confirmation compares whole shingle sets. Sets are computed again from the
texts that occur in candidate pairs, so they are never stored for all documents.

Defined results: null texts and texts without words have an empty set and are
linked with nothing; fewer words than a shingle make one shingle of all of them.
Rows without a doc_id have no component (null) and are not kept. Rows of one
doc_id with different texts link as one document (``keep_one`` tells them apart). An
empty table gives an empty result; columns beyond doc_id and the text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import WordHashes, shared_dir, shuffles_removed, staged, tasks, unstaged

COLLECTIONS = 18
ROWS = 4
SKETCH = 64          # minhashes that also give two bits each to a sketch
SKETCH_LEAST = 39    # equal two-bit values of 64; at similarity 0.8 fewer come once in 10 million pairs
BLOOM_BYTES = 64 << 20
STARS = 2            # linear rounds before the exact one
SPOKES = 4           # partners a member gets in a linear round
HOT = 64             # members of a prefix shingle from which on tiles are multiplied
TILE = 256           # members of a tile
COLUMNS = 1 << 14    # shingles of a set matrix at once
BLOCK = 200_000      # characters of texts that are signed at once

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_known = WordHashes(200_000)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words: A-Z lower-cased, split at ASCII white space
    (which is what ``bytes`` methods do)."""
    return _known.of((text or "").encode("utf-8", "surrogatepass").lower().split())


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Of each text, the sorted distinct hashes of the shingles of ``words`` words. Shingles
    are hashed for all texts at once; those that reach into the next text are left out."""
    hashes = [word_hashes(t) for t in texts]
    sizes = [min(words, len(h)) for h in hashes]
    ends = np.cumsum([len(h) for h in hashes])
    out = [h[:0] for h in hashes]
    for n in set(sizes) - {0}:
        # Texts of fewer words have one shingle of all of them.
        every = np.concatenate(hashes)
        acc = np.full(max(0, len(every) - n + 1), n, np.uint64)
        for j in range(n):
            acc = mix(acc * np.uint64(3) + every[j:len(every) - n + 1 + j])
        for i, (h, end) in enumerate(zip(hashes, ends.tolist())):
            if sizes[i] == n:
                s = np.sort(acc[end - len(h):end - n + 1])
                out[i] = s[np.append(True, s[1:] != s[:-1])]
    return out


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``words`` words."""
    return shingle_sets([text], words)[0]


_SALTS = mix(np.arange(1, COLLECTIONS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest values of non-empty sets, a row for each set, under each of
    COLLECTIONS * ROWS hashes."""
    every = np.concatenate(sets)
    starts = np.cumsum([0] + [len(x) for x in sets[:-1]])
    out = np.empty((len(sets), len(_SALTS)), np.uint64)
    x, high = np.empty_like(every), np.empty_like(every)
    for i, salt in enumerate(_SALTS):
        # Multiplying by an odd number, after a xor, orders hashed values anew.
        np.bitwise_xor(every, salt, out=x)
        np.multiply(x, salt | np.uint64(1), out=x)
        np.right_shift(x, np.uint64(32), out=high)
        np.bitwise_xor(x, high, out=x)
        out[:, i] = np.minimum.reduceat(x, starts)
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of non-empty sets: the values of the collections, and sketches of two numbers."""
    low = minhashes(sets)
    # Position-dependent folding of each collection's minhashes to one value.
    values = np.full((len(sets), COLLECTIONS), 7, np.uint64)
    for r in range(ROWS):
        values = mix(values * np.uint64(3) + low[:, r::ROWS])
    two = (mix(low[:, :SKETCH]) & np.uint64(3)) << (np.arange(SKETCH, dtype=np.uint64) % np.uint64(32) * np.uint64(2))
    return values.view(np.int64), np.bitwise_or.reduce(two.reshape(-1, 2, 32), axis=2).view(np.int64)


def text_blocks(texts: list[str | None]):
    """Ranges of consecutive texts of about BLOCK characters, or of one longer text."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > BLOCK:
            yield lo, i
            lo, held = i, 0
        held += len(t or "") + 1
    if texts:
        yield lo, len(texts)


def _sign(batches, words: int):
    """A row for each row of (doc_id, text); what only non-empty sets have is null for others."""
    for batch in batches:
        texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
        for lo, hi in text_blocks(texts):
            sets = shingle_sets(texts[lo:hi], words)
            n = np.array([len(s) for s in sets], np.int64)
            some = n > 0
            whole, sketch = np.zeros((hi - lo, 2), np.int64), np.zeros((hi - lo, 2), np.int64)
            values = np.empty((0, COLLECTIONS), np.int64)
            if some.any():
                full = [s for s in sets if len(s)]
                digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in full]
                whole[some] = np.array([(x >> 64, x & (1 << 64) - 1) for x in digests], np.uint64).view(np.int64)
                values, sketch[some] = signatures(full)
            a, b, s1, s2 = (pa.array(x, pa.int64(), mask=~some) for x in (*whole.T, *sketch.T))
            ends = np.append(0, np.cumsum(some) * COLLECTIONS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(n), a, b, s1, s2,
                 pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~some, False)), pa.array(values.ravel()))],
                ["doc_id", "n", "a", "b", "s1", "s2", "values"])


def _tables(batches):
    """One row per class and table: the key made of the values of two collections,
    ``i`` and ``j``."""
    i, j = np.triu_indices(COLLECTIONS, 1)
    salt = mix((i * COLLECTIONS + j + 1).astype(np.uint64))
    for pdf in batches:
        for lo in range(0, len(pdf), 2000):
            part = pdf.iloc[lo:lo + 2000]
            values = np.stack([np.asarray(v, np.int64) for v in part["values"]]).view(np.uint64)
            with np.errstate(over="ignore"):
                key = mix(values[:, i] * np.uint64(3) + mix(values[:, j] + salt))
            yield pd.DataFrame({"key": key.ravel().view(np.int64), "v": np.repeat(part.v.to_numpy(), len(i))})


def components(edges: DataFrame) -> DataFrame:
    """(v, c): the smallest vertex reachable over ``edges`` (x, y), for every
    vertex that has an edge. Labels spread to neighbours and then to the labels'
    labels, so that long chains take a logarithmic number of rounds."""
    shared_dir(edges.sparkSession)
    both = edges.select("x", "y").union(edges.select("y", "x")).distinct().checkpoint()
    labels = both.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("c")).select(
        "v", F.least("v", "c").alias("c")).checkpoint()
    while True:
        near = (both.join(labels.withColumnRenamed("v", "y"), "y").groupBy(F.col("x").alias("v"))
                .agg(F.min("c").alias("near")))
        spread = labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        up = labels.select(F.col("v").alias("c"), F.col("c").alias("up"))
        new = spread.join(up, "c").select("v", "old", F.least("c", "up").alias("c")).checkpoint()
        changed = new.where(F.col("c") != F.col("old")).limit(1).count()
        labels = new.select("v", "c")
        if not changed:
            return labels


def _bloom(ids: DataFrame, n: int):
    """A Bloom filter of ids as a column test, or None beyond BLOOM_BYTES."""
    bits = max(64, n * 10 // 64 * 64 + 64)
    if bits // 8 > BLOOM_BYTES:
        return None

    def at(x: np.ndarray) -> np.ndarray:
        h = mix(x.view(np.uint64) + np.uint64(1))
        return np.stack([mix(h + np.uint64(k)) % np.uint64(bits) for k in range(1, 7)])

    def words(batches):
        for pdf in batches:
            spots = at(pdf.id.to_numpy(np.int64)).ravel()
            yield pd.DataFrame({"word": (spots >> np.uint64(6)).astype(np.int64),
                                "mask": (np.uint64(1) << (spots & np.uint64(63))).view(np.int64)})

    found = ids.mapInPandas(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    filled = np.zeros(bits // 64, np.uint64)
    filled[found.word.to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def holds(x: pd.Series) -> pd.Series:
        with np.errstate(over="ignore"):
            spots = at(x.to_numpy(np.int64))
        return pd.Series(((shared.value[spots >> np.uint64(6)] >> (spots & np.uint64(63))) & np.uint64(1)).all(axis=0))

    return holds


def whole_sets(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, items) of the documents whose doc_id is in the distinct ``ids`` (id):
    their whole shingle sets, sorted."""
    holds = _bloom(ids, ids.count())
    some = docs.where(F.col("doc_id").isNotNull())
    if holds is not None:
        some = some.where(holds("doc_id"))  # only the ids go to Python

    @F.pandas_udf("binary")
    def whole(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, words).tobytes() for t in texts], dtype=object)

    return staged(some.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
                  .select("doc_id", whole("text").alias("items")), "sets")


def confirm(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (x, y) of class representatives whose whole sets are similar:
    100 * intersection >= percent * union."""
    pairs = staged(pairs, "pairs")
    ids = staged(pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct(), "ids")
    sets = whole_sets(ids, docs, words)

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("doc_id").alias("x"), F.col("items").alias("left"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("items").alias("right"))
    # A representative may be in many pairs: plain joins, whose large partitions Spark splits.
    links = staged(pairs.join(left, "x").join(right, "y").where(similar("left", "right"))
                   .select("x", "y").distinct(), "links")
    unstaged(sets)  # by far the largest table here
    return links


def prefixes(open_: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(v, c, prefix, common) of the members ``open_`` (v, component c, size n) that may be
    similar to one of another component: the shingles of their sets that components
    share (``common``, sorted), and the rarest of them, as far as any partner must share
    one (``prefix``, rarest first)."""
    @F.pandas_udf("array<long>")
    def unpacked(items: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, np.int64) for x in items], dtype=object)

    sets = whole_sets(open_.select(F.col("v").alias("id")), docs, words)
    placed = open_.join(sets.dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "v"), "v").select(
        "v", "c", "n", F.explode(unpacked("items")).alias("s"))
    shared = placed.select("s", "c").distinct().groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    common = placed.join(shared, "s").groupBy("v", "c", "n").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("common"))
    least = F.floor((percent * F.col("n") + 99) / 100)  # shingles that any partner shares
    take = (F.col("n") - least + 1 - (F.col("n") - F.size("common"))).cast("int")
    found = staged(common.where(take > 0).select("v", "c", F.slice("common.s", F.lit(1), take).alias("prefix"),
                                                 F.array_sort("common.s").alias("common")), "common")
    unstaged(sets)
    return found


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets (sorted, distinct), by products
    of their membership matrices, COLUMNS shingles at a time."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1  # a shingle of one set is in no intersection of two
    place = np.cumsum(several) - 1
    use = several[column]
    rows, column = rows[use], place[column[use]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for lo in range(0, int(several.sum()), COLUMNS):
        at, end = np.searchsorted(column, (lo, lo + COLUMNS))
        x = np.zeros((len(sets), COLUMNS), np.float32)
        x[rows[at:end], column[at:end] - lo] = 1
        out += x @ x.T
    return out


def _links(batches, percent: int):
    """From rows (g, tile, across, v, c, n, common), sorted by block ``g``: the pairs (x, y) of
    one block and of different components whose sets are similar."""
    names = ["g", "tile", "across", "v", "c", "n"]

    def block(cols, sets):
        both = intersections(sets)
        n = cols["n"].astype(np.float64)
        near = (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (both > 0)
        near &= cols["c"][:, None] != cols["c"][None, :]
        near &= ~cols["across"][:, None] | (cols["tile"][:, None] != cols["tile"][None, :])
        i, j = np.nonzero(np.triu(near, 1))
        return pa.RecordBatch.from_arrays([pa.array(cols["v"][i], pa.int64()), pa.array(cols["v"][j], pa.int64())], ["x", "y"])

    held = None
    for batch in batches:
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        common = batch.column("common")
        sets = [common[k].values.to_numpy() for k in range(len(common))]
        if held is not None:
            cols, sets = {c: np.concatenate([held[0][c], cols[c]]) for c in names}, held[1] + sets
        ends = np.flatnonzero(cols["g"][1:] != cols["g"][:-1]) + 1
        at = 0
        for end in ends.tolist():
            yield block({c: x[at:end] for c, x in cols.items()}, sets[at:end])
            at = end
        held = {c: x[at:] for c, x in cols.items()}, sets[at:]  # the last block may go on
    if held is not None and len(held[1]):
        yield block(*held)


def tiled_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) among the members (v, c, n, common) of every ``key`` of ``rows``, which
    has ``size`` members: each pair of tiles of a key is a block."""
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    placed = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("v"), "tiles").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with")
    blocks = placed.select("key", "v", "c", "n", "common", "tile", other).select(
        F.xxhash64("key", F.least("tile", "with"), F.greatest("tile", "with")).alias("g"), "tile",
        (F.col("tile") != F.col("with")).alias("across"), "v", "c", "n", "common")
    dealt = blocks.repartition(tasks(rows.sparkSession), "g").sortWithinPartitions("g")
    return dealt.mapInArrow(lambda batches: _links(batches, percent), "x long, y long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``
    (columns doc_id and text)."""
    shared_dir(docs.sparkSession)
    with shuffles_removed(docs.sparkSession):
        return _near_duplicates(docs, words, percent)


def _near_duplicates(docs: DataFrame, words: int, percent: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staged(docs.mapInArrow(
        lambda batches: _sign(batches, words),
        "doc_id long, n long, a long, b long, s1 long, s2 long, values array<long>"), "signatures")
    by_class = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b").agg(
        F.min("doc_id").alias("v"), F.first("n").alias("n"), F.first("values").alias("values"),
        F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    classes = staged(by_class, "classes")

    # Classes are few bytes each but make many table rows: deal them out first.
    table_rows = (classes.select("v", "values").repartition(tasks(docs.sparkSession), "v")
                  .mapInPandas(_tables, "key long, v long"))
    leaders = table_rows.groupBy("key").agg(F.min("v").alias("leader"), F.max("v").alias("last")) \
        .where("leader < last").select("key", "leader")
    members = staged(table_rows.join(leaders, "key").distinct(), "buckets")  # buckets of two and more

    sizes = classes.select("v", "n", "s1", "s2")
    evens = F.lit(0x5555555555555555)

    def equal(p: str, q: str):
        """Equal two-bit values of two halves of a sketch."""
        d = F.col(p).bitwiseXOR(F.col(q))
        return F.bit_count(F.bitwise_not(d.bitwiseOR(F.shiftrightunsigned(d, 1))).bitwiseAND(evens))

    # Sizes and sketches rule most other pairs out.
    may_link = ((100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
                & (equal("x1", "y1") + equal("x2", "y2") >= SKETCH_LEAST))

    def possible(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sizes.toDF("x", "nx", "x1", "x2"), "x").join(sizes.toDF("y", "ny", "y1", "y2"), "y")
                .where(may_link).select("x", "y").distinct())

    def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
        """Labels after components are joined by more links."""
        of, to = labels.toDF("x", "cx"), labels.toDF("y", "cy")
        roots = components(links.join(of, "x").join(to, "y").where("cx <> cy")
                           .select(F.col("cx").alias("x"), F.col("cy").alias("y")).distinct())
        return staged(labels.join(roots.toDF("c", "root"), "c", "left")
                      .select("v", F.coalesce("root", "c").alias("c")), "labels")

    def mixed(labels: DataFrame) -> DataFrame:
        """(key, v, c) of the buckets that hold several components."""
        placed = members.select("key", "v").join(labels, "v")
        several = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
        return placed.join(several.select("key"), "key", "left_semi")

    first = members.where("v <> leader").groupBy(F.col("v").alias("x")).agg(F.min("leader").alias("y"))
    labels = relabel(staged(members.select("v").distinct().withColumn("c", F.col("v")), "labels"),
                     confirm(possible(first), docs, words, percent))
    # Linear rounds: a member against a few members of its buckets that any other
    # member of the bucket is compared with too.
    for seed in range(STARS):
        open_ = mixed(labels)
        turn = F.xxhash64("v", F.lit(seed))
        hubs = open_.groupBy("key").agg(F.min(F.struct(turn.alias("h"), "v", "c")).alias("hub"))
        spokes = (open_.join(hubs, "key").where("c <> hub.c")
                  .select(F.col("v").alias("x"), F.col("hub.v").alias("y"), "hub.h").distinct())
        nearest = Window.partitionBy("x").orderBy("h")
        few = spokes.withColumn("_k", F.row_number().over(nearest)).where(F.col("_k") <= SPOKES).select("x", "y")
        labels = relabel(labels, confirm(possible(few), docs, words, percent))

    # What is left is exact: members of mixed buckets by what their sets share. The
    # smaller component of a shingle is laid out against the larger ones.
    open_ = staged(mixed(labels).select("v", "c").distinct().join(classes.select("v", "n"), "v"), "mixed")
    shared = prefixes(open_, docs, words, percent)
    found = staged(shared.join(classes.select("v", "n", "s1", "s2"), "v"), "prefixes")
    unstaged(shared)
    every = found.select("v", F.explode("prefix").alias("key"))
    hot = every.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > HOT)
    hot = staged(hot, "hot")
    rows = found.select("v", "c", "n", "s1", "s2", "prefix", F.explode("prefix").alias("key")).join(hot, "key", "left_anti").select(
        "v", "c", "n", "s1", "s2", "prefix", "key")
    held = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    other = held.select("key", F.col("c").alias("d"), F.col("m").alias("md"))
    lower = held.join(other, "key").where("c <> d AND (m < md OR (m = md AND c < d))").select("key", "c", "d")
    laid = lower.join(rows.toDF("x", "c", "nx", "x1", "x2", "px", "key"), ["key", "c"]).alias("p")
    against = rows.toDF("y", "d", "ny", "y1", "y2", "py", "key").alias("q")
    # Sharing a hot shingle first, a pair is tested there.
    first_shared = F.get(F.array_intersect("px", "py"), F.lit(0)) == F.col("p.key")
    across = laid.join(against, (F.col("p.key") == F.col("q.key")) & (F.col("p.d") == F.col("q.d")) & may_link & first_shared)
    many = tiled_links(every.join(hot, "key").join(found.select("v", "c", "n", "common"), "v"), percent)
    labels = relabel(labels, confirm(across.select("x", "y"), docs, words, percent).unionByName(many))
    place = classes.select("a", "b", "v").join(labels, "v", "left").select(
        "a", "b", F.coalesce("c", "v").alias("component_id"))
    return signed.select("doc_id", F.col("n").alias("n_shingles"), "a", "b").join(place, ["a", "b"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group stays, with all its columns: the one of the smallest doc_id, of
    several such rows the first. Where doc_ids repeat, rows are told apart by their
    place in a staged copy, so rows that share an id without being similar all stay. Rows
    without a doc_id stay too, since nothing says which document they are."""
    known, rest = docs.where("doc_id IS NOT NULL"), docs.where("doc_id IS NULL")
    again = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not again.limit(1).count():
        first = near_duplicates(known, words, percent).where("kept").select("doc_id")
        return known.join(first, "doc_id", "left_semi").select(*docs.columns).unionByName(rest)
    copy = staged(known.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(copy.select(F.col("_row").alias("doc_id"), "text"), words, percent).select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    first = groups.join(copy.select("_row", "doc_id"), "_row").groupBy("_group").agg(
        F.min(F.struct("doc_id", "_row")).alias("first")).select(F.col("first._row").alias("_row"))
    return copy.join(first, "_row", "left_semi").select(*docs.columns).unionByName(rest)
