"""Source divergence audit: which terms tell a source from its language, and how
far sources are from one another.

The vocabulary comes from iceberg prefix refinement. Level by level (prefixes of
4 bytes, then twice as many, and so on) the distinct documents of every byte
prefix are counted; a prefix below the threshold is discarded with all that it
begins, and only terms whose prefix survived are looked at on the next level. A term
shorter than the level's length is complete; the refinement ends when no incomplete
prefix is left. Counters are held per task and summed by Spark.

Texts are split once. A task writes its documents by blocks of one language: every
distinct term of a block once, then by numbers which documents have it and how often
each source does. Levels and counts read the blocks; numpy and Arrow work on a whole
block at a time.

Survivors reach the next pass as a bit table of fixed size (BITS bits). A false bit
only lets a prefix be counted once more; what is kept is decided by exact counts.

All arithmetic is on whole numbers: p = 1 + floor(10**9 * (count + 2) / (N + 2 V)) and
f = floor((p - q)**2 / (p + q)); p comes from long division in three steps, which
is exact below 9 * 10**15 tokens a group.

Defined results: null text, lang and source count as ''. Documents without terms still
make their (lang, source) group occur. A language without kept terms gives pairs of
value 0 and no terms. Repeated rows are documents of their own; ids are not read, nor
are other columns. Equal values are ranked by the UTF-8 bytes of the item. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import staged, tasks

LEVELS = (4, 8, 16, 32)  # bytes of the first levels' prefixes; further ones double
BITS = 1 << 25       # of the table of survivors
CHUNK = 1 << 23      # bytes of the texts of a language that make a block; a task holds four times that
HELD = 1_000_000     # counters of prefixes a task holds before it passes them on
COUNTS = 4_000_000   # counts of terms by source a task holds likewise
STRIPE = 256         # sources that a row of terms is compared with at once
CELLS = 1 << 21      # cells of the matrices a task holds

# A-Z lower-cased, a-z and all bytes of non-ASCII characters kept, the rest blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def texts(docs: DataFrame) -> DataFrame:
    """lang, source and text (binary) of every document, null as empty."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _fold(batches):
    for batch in batches:
        every = [text.translate(_FOLD) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("source"), pa.array(every, pa.binary())], ["lang", "source", "every"])


def term_lists(docs: DataFrame) -> DataFrame:
    """Of every document: lang, source and all its terms as often as they occur: the text
    itself, folded (every)."""
    return texts(docs).mapInArrow(_fold, "lang string, source string, every binary")


def narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each in as few bytes as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))).newbyteorder("<")).tobytes()


def wide(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``narrow``."""
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def runs(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def added(numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the numbers from each place to the next."""
    return np.add.reduceat(numbers, at) if len(at) else np.zeros(0, np.int64)


BLOCK = ("lang string, sources array<string>, documents long, terms binary, sizes binary, docs binary, "
         "spread binary, which binary, times binary")


def block(lang: str, docs: list[tuple[str, bytes]]) -> dict:
    """A row that holds the documents (source, text) of one language: the distinct ``terms``
    joined by blanks; of each term its number of documents (sizes) and these documents'
    numbers (docs); of each term its number of sources (spread), and of each of these its
    place in ``sources`` (which) and the occurrences there (times)."""
    docs.sort(key=itemgetter(0))
    sources = sorted({source for source, _ in docs})
    place = {source: k for k, source in enumerate(sources)}
    of_doc = np.array([place[source] for source, _ in docs], np.int64)
    whole = (b" " + b" ".join([text for _, text in docs]) + b" ").translate(_FOLD)
    letter = np.frombuffer(whole, np.uint8) != 32
    edges = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    begins = 1 + np.cumsum([0, *(len(text) + 1 for _, text in docs)])
    doc = np.repeat(np.arange(len(docs)), np.diff(np.searchsorted(starts, begins)))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    found = pa.Array.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(offsets), pa.py_buffer(whole.translate(None, b" "))]).dictionary_encode()
    bits = len(docs).bit_length()
    keys = found.indices.to_numpy().astype(np.int64) << bits | doc
    keys.sort()
    at = runs(keys)  # of each term and document
    times, pairs = np.diff(at, append=len(keys)), keys[at]
    term, doc = pairs >> bits, pairs & (1 << bits) - 1
    at = runs(term * len(sources) + of_doc[doc])  # of each term and source
    return {"lang": lang, "sources": sources, "documents": len(docs), "terms": b" ".join(found.dictionary.to_pylist()),
            "sizes": narrow(np.bincount(term)), "docs": narrow(doc), "spread": narrow(np.bincount(term[at])),
            "which": narrow(of_doc[doc[at]]), "times": narrow(added(times, at))}


def _blocks(batches):
    held, size, whole = {}, Counter(), 0
    schema = pa.schema([("lang", pa.string()), ("sources", pa.list_(pa.string())), ("documents", pa.int64()),
                        *((c, pa.binary()) for c in ("terms", "sizes", "docs", "spread", "which", "times"))])

    def row(lang):
        return pa.RecordBatch.from_pylist([block(lang, held.pop(lang))], schema)

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            held.setdefault(lang, []).append((source, text))
            size[lang] += len(text) + 50
            whole += len(text) + 50
            if size[lang] > CHUNK:
                whole -= size.pop(lang)
                yield row(lang)
            elif whole > 4 * CHUNK:
                yield from map(row, [*held])
                size, whole = Counter(), 0
    yield from map(row, [*held])


def blocks(rows: DataFrame) -> DataFrame:
    """The documents (lang, source, text) by blocks of one language, in which every term
    is written once and what follows goes by numbers."""
    return staged(rows.mapInArrow(_blocks, BLOCK), "blocks", "zstd")


class Known(dict):
    """What a task knows of one language on the level of prefixes of ``length`` bytes:
    whether a piece, a prefix of ``before`` bytes (None: a whole term), survived, by the
    table of survivors (None: all did). Worked out once for each piece, of which there are
    far fewer than terms on the first levels; forgotten when it grows."""

    def __init__(self, lang: str, table: bytes | None, length: int | None, before: int | None):
        super().__init__()
        self.salt = zlib.crc32(lang.encode("utf-8", "surrogatepass") + b"\0")
        self.table, self.length, self.before = table, length, before

    def __missing__(self, piece: bytes) -> bool:
        out = self.before in (None, len(piece)) and self.holds(piece)
        if len(self) > HELD:
            self.clear()
        self[piece] = out
        return out

    def holds(self, piece: bytes) -> bool:
        if self.table is None:
            return True
        slot = zlib.crc32(piece, self.salt) & BITS - 1
        return bool(self.table[slot >> 3] >> (slot & 7) & 1)

    def among(self, pieces: pa.Array) -> np.ndarray:
        """Which of the pieces, all of the length ``before``, survived; each is looked up once."""
        if self.table is None:
            return np.ones(len(pieces), bool)
        found = pieces.dictionary_encode()
        slot = np.array([zlib.crc32(x, self.salt) for x in found.dictionary.to_pylist()], np.int64) & BITS - 1
        return (np.frombuffer(self.table, np.uint8)[slot >> 3] >> (slot & 7) & 1).astype(bool)[found.indices.to_numpy()]


def bit_table(pieces: DataFrame) -> bytes:
    """The bit table of the rows (lang, piece); at most BITS / 64 words reach the driver."""
    slot = F.crc32(F.concat(F.col("lang").cast("binary"), F.lit(bytearray(b"\0")), F.col("piece"))).bitwiseAND(F.lit(BITS - 1))
    words = (pieces.select(slot.alias("slot")).select(
        F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("mask"))
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas())
    table = np.zeros(BITS // 64, "<u8")
    table[words.word.to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return table.tobytes()


def prefixes_of(terms: bytes, known: Known) -> set[bytes]:
    """Distinct prefixes that the terms of one document have on the level of ``known``:
    of the terms that were incomplete on the level before and survived there. What
    prefix_counts counts by blocks, for one document."""
    length, before, alive = known.length, known.before, known.__getitem__
    if before is None:
        return {t[:length] for t in terms.split()}
    return {t[:length] for t in terms.split() if alive(t[:before])}


def each_row(batches):
    """The rows of the batches, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def prefix_counts(row: dict, known: Known) -> tuple[pa.Array, np.ndarray]:
    """The prefixes that a block's terms have on the level of ``known`` (see prefixes_of), and
    the number of its documents with each."""
    terms = pa.array(row["terms"].split(), pa.binary())
    sizes = wide(row["sizes"], len(terms))
    docs = wide(row["docs"], int(sizes.sum()))
    mine = np.ones(len(terms), bool)
    if known.before is not None:
        mine = pc.binary_length(terms).to_numpy() >= known.before
        mine[mine] = known.among(pc.binary_slice(terms.filter(pa.array(mine)), 0, known.before))
        terms, docs, sizes = terms.filter(pa.array(mine)), docs[np.repeat(mine, sizes)], sizes[mine]
    found = pc.binary_slice(terms, 0, known.length).dictionary_encode()
    bits = row["documents"].bit_length()
    keys = np.repeat(found.indices.to_numpy().astype(np.int64), sizes) << bits | docs
    keys.sort()
    return found.dictionary, np.bincount(keys[runs(keys)] >> bits, minlength=len(found.dictionary))


class Languages(dict):
    """What a task knows (Known) of each language, of a hundred at most."""

    def __init__(self, *args):
        super().__init__()
        self.args = args

    def __missing__(self, lang: str) -> Known:
        if len(self) > 100:
            self.clear()
        self[lang] = Known(lang, *self.args)
        return self[lang]


def refine(lists: DataFrame, threshold: int = 10) -> DataFrame:
    """(lang, term) with at least ``threshold`` distinct documents of the language."""
    return refined(blocks(lists.withColumnRenamed("every", "text")), threshold)


def refined(rows: DataFrame, threshold: int) -> DataFrame:
    spark = rows.sparkSession
    kept, length, before, shared = [], LEVELS[0], None, None
    while True:
        def count(batches, length=length, before=before, shared=shared):
            known = Languages(shared.value if shared is not None else None, length, before)
            held, size = [], 0

            def passed_on():
                if held:
                    found = pa.concat_tables(held).group_by(["lang", "piece"]).aggregate([("docs", "sum")])
                    yield from found.select(["lang", "piece", "docs_sum"]).rename_columns(["lang", "piece", "docs"]).to_batches(50_000)
                held.clear()

            for row in each_row(batches):
                pieces, docs = prefix_counts(row, known[row["lang"]])
                held.append(pa.table({"lang": pa.array([row["lang"]] * len(docs), pa.string()), "piece": pieces, "docs": docs}))
                size += len(docs)
                if size > HELD or len(held) > 1000:
                    yield from passed_on()
                    size = 0
            yield from passed_on()

        counted = rows.select("lang", "documents", "terms", "sizes", "docs").mapInArrow(count, "lang string, piece binary, docs long")
        level = staged(counted.groupBy("lang", "piece").agg(F.sum("docs").alias("docs"))
                       .where(F.col("docs") >= threshold).select("lang", "piece"), f"prefixes-{length}")
        kept.append(level.where(F.octet_length("piece") < length))
        table = bit_table(level.where(F.octet_length("piece") == length))
        if not any(table):
            break
        shared = spark.sparkContext.broadcast(table)
        length, before = 2 * length, length
    return reduce(DataFrame.unionByName, kept).select("lang", F.col("piece").alias("term"))


class Counts:
    """Occurrences of terms by source, of one language, as numbers: those of several blocks
    are added up when they are asked for."""

    def __init__(self):
        self.place, self.terms, self.parts, self.size = {}, [], [], 0

    def add(self, sources: list[str], terms: pa.Array, spread: np.ndarray, which: np.ndarray, times: np.ndarray) -> None:
        places = np.array([self.place.setdefault(x, len(self.place)) for x in sources], np.int64)
        self.terms.append(terms)
        self.parts.append((spread, places[which], times))
        self.size += len(times) + len(terms)

    def sums(self) -> tuple[list[str], pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Sources and distinct terms; the sources' number of each term, their places and the
        occurrences there, by term."""
        found = pa.concat_arrays(self.terms).dictionary_encode()
        spread, which, times = map(np.concatenate, zip(*self.parts))
        keys = np.repeat(found.indices.to_numpy().astype(np.int64), spread) * len(self.place) + which
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        at = runs(keys)
        term = keys[at] // max(1, len(self.place))
        return ([*self.place], found.dictionary, np.bincount(term, minlength=len(found.dictionary)),
                keys[at] % max(1, len(self.place)), added(times[order], at))


PACK = "lang string, bucket int, sources array<string>, terms binary, spread binary, which binary, times binary"


def _counts_of(row: dict) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    terms = pa.array(row["terms"].split(), pa.binary())
    spread = wide(row["spread"], len(terms))
    n = int(spread.sum())
    return terms, spread, wide(row["which"], n), wide(row["times"], n)


def _added(batches):
    """From packs, all of a bucket being in one task: a row per language and term."""
    held: dict[tuple[str, int], Counts] = {}
    for row in each_row(batches):
        counts = held.setdefault((row["lang"], row["bucket"]), Counts())
        counts.add(row["sources"], *_counts_of(row))
        if counts.size > COUNTS:
            whole = held[row["lang"], row["bucket"]] = Counts()
            whole.add(*counts.sums())
            whole.size = 0
    for (lang, _), counts in held.items():
        sources, terms, spread, which, times = counts.sums()
        found = pa.StructArray.from_arrays(
            [pa.array(sources, pa.string()).take(pa.array(which)), pa.array(times, pa.int64())], ["source", "n"])
        ends = np.concatenate([[0], np.cumsum(spread)]).astype(np.int32)
        rows = pa.table([pa.array([lang] * len(terms), pa.string()), terms, pa.ListArray.from_arrays(ends, found)], ["lang", "term", "found"])
        yield from rows.to_batches(10_000)


def term_counts(lists: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, term, found) of the kept terms, ``found`` being an array of the sources that
    have the term and its occurrences there (source, n)."""
    return block_counts(blocks(lists.withColumnRenamed("every", "text")), kept)


def block_counts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """See term_counts. A task adds up its blocks and sends, by bucket of terms, what it found
    as numbers; a bucket's are added up where they meet. A term that a bit of the table
    lets through by chance is not among the kept and falls when it meets them."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(bit_table(kept.withColumnRenamed("term", "piece")))
    buckets = tasks(spark)

    def count(batches):
        known, held = Languages(shared.value, None, None), {}

        def passed_on():
            for lang, counts in held.items():
                sources, terms, spread, which, times = counts.sums()
                bucket = np.array([zlib.crc32(t) % buckets for t in terms.to_pylist()], np.int64)
                order = np.argsort(bucket, kind="stable")
                begins = np.cumsum(spread) - spread
                for some in np.split(order, runs(bucket[order])[1:]):
                    if len(some):
                        n = spread[some]
                        at = np.repeat(begins[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
                        yield {"lang": lang, "bucket": int(bucket[some[0]]), "sources": sources,
                               "terms": b" ".join(terms.take(pa.array(some)).to_pylist()), "spread": narrow(n),
                               "which": narrow(which[at]), "times": narrow(times[at])}
            held.clear()

        def sent():
            found = [*passed_on()]
            return [pa.RecordBatch.from_pylist(found, schema)] if found else []

        schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("sources", pa.list_(pa.string())),
                            *((c, pa.binary()) for c in ("terms", "spread", "which", "times"))])
        size = 0
        for row in each_row(batches):
            terms, spread, which, times = _counts_of(row)
            ok = known[row["lang"]].among(terms)
            let = np.repeat(ok, spread)
            held.setdefault(row["lang"], Counts()).add(
                row["sources"], terms.filter(pa.array(ok)), spread[ok], which[let], times[let])
            size += int(let.sum()) + len(row["sources"])
            if size > COUNTS:
                yield from sent()
                size = 0
        yield from sent()

    packs = rows.select("lang", "sources", "terms", "spread", "which", "times").mapInArrow(count, PACK)
    return packs.repartition(buckets, "lang", "bucket").mapInArrow(
        _added, "lang string, term binary, found array<struct<source:string,n:long>>").join(kept, ["lang", "term"], "left_semi")


def smoothed(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), exactly."""
    rest, whole = count + 2, total + 2 * terms
    out = np.zeros(np.broadcast(rest, whole).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _compare(batches):
    """From rows (lang, term, stripe, sources, ns, names, totals, v): sums over the terms for the
    pairs of sources, and the value of every term that a source has more of."""
    sums: dict[tuple[str, int], np.ndarray] = {}
    places: dict[str, dict[str, int]] = {}
    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    shape = ["lang", "i", "j", "term", "value"]

    def passed_on():
        for (lang, stripe), m in sums.items():
            i, j = (x.ravel() for x in np.indices(m.shape))
            i = i + stripe * STRIPE
            apart = i != j
            n = int(apart.sum())
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * n, types[0]), pa.array(i[apart], types[1]), pa.array(j[apart], types[2]),
                pa.nulls(n, types[3]), pa.array(m.ravel()[apart], types[4])], shape)
        sums.clear()

    for batch in batches:
        keys = list(zip(batch.column("lang").to_pylist(), batch.column("stripe").to_pylist()))
        sources, ns, names, alls, terms = (batch.column(c) for c in ("sources", "ns", "names", "totals", "term"))
        for key in sorted(set(keys)):
            lang, stripe = key
            same = [k for k, x in enumerate(keys) if x == key]
            totals, v = alls[same[0]].values.to_numpy(), batch.column("v")[same[0]].as_py()
            size, lo = len(totals), stripe * STRIPE
            if lang not in places:
                if len(places) > 100:
                    places.clear()
                places[lang] = {x: k for k, x in enumerate(names[same[0]].as_py())}
            place = places[lang].__getitem__
            if key not in sums:
                if sum(m.size for m in sums.values()) + STRIPE * size > CELLS:
                    yield from passed_on()
                sums[key] = np.zeros((min(STRIPE, size - lo), size), np.int64)
            step = max(1, CELLS // size)
            for at in range(0, len(same), step):
                part = same[at:at + step]
                counts = np.zeros((len(part), size), np.int64)
                for k, r in enumerate(part):
                    counts[k, [*map(place, sources[r].as_py())]] = ns[r].values.to_numpy()
                p = smoothed(counts, totals, v)
                for i in range(len(sums[key])):
                    sums[key][i] += divergence(p[:, lo + i:lo + i + 1], p).sum(axis=0)
                q = smoothed(counts.sum(axis=1, keepdims=True), totals.sum(keepdims=True)[None], v)
                here = slice(lo, lo + STRIPE)
                k, i = np.nonzero((counts[:, here] > 0) & (p[:, here] > q))
                values = divergence(p[k, i + lo], q[k, 0])
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(k), types[0]), pa.array(i + lo, types[1]), pa.nulls(len(k), types[2]),
                    terms.take(pa.array([part[x] for x in k], pa.int64())), pa.array(values, types[4])], shape)
    yield from passed_on()


def source_divergence(docs: DataFrame, threshold: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: each source against
    every other source of its language, and the ``top`` terms it has more of than the
    language as a whole."""
    rows = blocks(texts(docs))
    terms = staged(block_counts(rows, refined(rows, threshold)), "term-counts")
    totals = terms.select("lang", F.inline("found")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_name = Window.partitionBy("lang").orderBy("source")  # sources of a language, of which the result has all pairs
    groups = staged(rows.select("lang", F.explode("sources").alias("source")).distinct().join(totals, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
        (F.row_number().over(by_name) - 1).alias("id")), "groups")
    langs = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("id", "source", "total"))).alias("all")).join(
        terms.groupBy("lang").agg(F.count("*").alias("v")), "lang")
    stripes = F.sequence(F.lit(0), F.floor((F.size("all") - 1) / STRIPE).cast("int"))
    # A language may hold most terms: its row is laid out once for every part of them.
    parts = tasks(docs.sparkSession)
    langs = langs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    salted = terms.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int"))
    laid = salted.join(langs, ["lang", "salt"]).select(
        "lang", "term", F.explode(stripes).alias("stripe"), F.col("found.source").alias("sources"),
        F.col("found.n").alias("ns"), F.col("all.source").alias("names"), F.col("all.total").alias("totals"), "v")
    compared = staged(laid.mapInArrow(_compare, "lang string, i int, j int, term binary, value long"), "compared")

    sums = compared.where("j IS NOT NULL").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    left, right = groups.select("lang", "source", F.col("id").alias("i")), groups.select("lang", F.col("source").alias("item"), F.col("id").alias("j"))
    pair = left.join(right, "lang").where("i <> j").join(sums, ["lang", "i", "j"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    term = compared.where("j IS NULL").withColumn("item", F.col("term").cast("string"))
    best = Window.partitionBy("lang", "i").orderBy(F.desc("value"), "item")
    term = term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).join(left, ["lang", "i"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pair.withColumn("rank", F.row_number().over(ranked)).unionByName(term)


def op12_sql() -> str:
    return r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
occ AS (
  SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
vocab AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cnt GROUP BY ALL),
full_p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * v.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN vocab v USING (lang) LEFT JOIN tot t USING (lang, source)
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM full_p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, r::INTEGER AS "rank" FROM ranked WHERE part = 'pair' OR r <= 10
"""
