"""Language-model scores from a hierarchical Pitman-Yor model.

Restaurants: one for each previous word (by its 64-bit hash; one more for the
start of a document), all with the same parent, the unigram
restaurant, whose base is uniform over the words of the training texts and one
unknown. A training word in a context is a customer there; a customer that opens a
table sends a customer to the parent. Seating is sampled in sweeps, which are not
Gibbs sweeps: all customers of a dish are seated anew from empty, one after the
other, given the totals and the parent's probabilities of the sweep before. Predictive
probabilities are averaged over the sweeps after the first, and a text's score is
the sum of the log10 averages over its words and its end.

How it runs: texts become packed arrays of (word, context, document, count), dealt
into buckets by word and staged; this is the only time that words cross the network.
A bucket holds all there is about its words, so tables of words are drawn where the
words are. Between sweeps only totals travel: for the few words that are split over
buckets because they are frequent, per word through the driver; and per context as
tables: a bucket sends the sums of its contexts, packed by parts of the contexts'
hashes, a part adds them up and sends every bucket the totals of the contexts that
it asked for, and the next sweep joins them to the bucket. No array of all contexts
is held anywhere.
Draws come from hashes of (word, context, sweep, step), so that a repeated task
draws the same, and a sweep is computed again from the totals instead of stored.

Defined results: a null text counts as empty and consists of its end only. Rows
without a doc_id train and are not held out. Repeated rows each train and each
get a row. Without training rows every probability is the base's. An empty table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
import uuid
import zlib
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import WordHashes, setting, shared_dir, shuffles_removed, staged, tasks, unstaged

CONTEXTS = (1 << 64) - 1  # previous words by their whole hash; this number itself is the start of a document
SWEEPS = 3
STRENGTH = 1.0          # concentration of every restaurant
BUCKET_BYTES = 5 << 20  # text bytes that make one bucket
TASK_BUCKETS = 2        # buckets that one task gathers
CHUNK = 1500            # documents packed at once
HOT_SAMPLE = 0.02       # share of the documents that names frequent words; it sets who is split, never a result
HELD = 1 << 20          # documents whose sums a task holds before it sends them
CODED = 65_535          # frequent words that cross the network as two bytes

SUMS = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("x", pa.float64()), ("y", pa.float64()), ("blob", pa.binary())])
SENT = pa.schema([("part", pa.int64()), ("blob", pa.binary())])
SCORES = pa.schema([("row", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("base", pa.float64()), ("model", pa.float64())])
END = np.uint64(0x9AE16A3B2F90404F)
_GOLDEN = 0x9E3779B97F4A7C15
_known = WordHashes(100_000)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the arguments only."""
    with np.errstate(over="ignore"):
        salt = np.uint64((sweep * 1_000_003 + step + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF)
        return (mix(key + salt) >> np.uint64(11)).astype(float) * 2.0 ** -53


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words (A-Z lower-cased, ASCII white space) and of the end."""
    return np.append(_known.of((text or "").encode("utf-8", "surrogatepass").lower().split()), END)


def is_held_out(doc_id, folds: int = 7, fold: int = 2) -> bool:
    return doc_id is not None and not pd.isna(doc_id) and zlib.crc32(str(int(doc_id)).encode()) % folds == fold


def seat(customers: np.ndarray, chance: np.ndarray, discount: float, strength: float, tables: float,
         key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables after all customers of each dish sat down one after the other.

    With n customers at t tables, the next opens a table with weight
    (strength + discount * tables) * chance against n - discount * t. The first
    24 sit down singly; further ones in groups that grow by a sixteenth, whose
    new tables are drawn at once from their expected number."""
    new = np.maximum((strength + discount * tables) * chance, 1e-300)
    n = np.minimum(customers, 1).astype(float)
    t = n.copy()
    step = 0
    open_ = np.flatnonzero(customers > 1)
    while len(open_):
        at, have = n[open_], t[open_]
        group = np.minimum(np.where(at < 24, 1.0, np.floor(at / 16)), customers[open_] - at)
        p = new[open_] / (new[open_] + at - discount * have)
        expected = group * p
        draw = np.floor(expected + uniform(key[open_], sweep, step))
        t[open_] = have + np.minimum(draw, group)
        n[open_] = at + group
        open_ = open_[n[open_] < customers[open_]]
        step += 1
    return t


def narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0, in as few bytes as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def pack_contexts(number: int, keys: np.ndarray | None, values: list[np.ndarray]) -> bytes:
    """A blob of contexts and of several whole numbers for each, most of them small, under
    the number of a bucket; or of the numbers alone, under that of a part."""
    values = [narrow(v) for v in values]
    return _blob([number, len(values[0])], np.array([v.itemsize for v in values], np.uint8),
                 *([] if keys is None else [keys]), *values)


def parse_contexts(blob: bytes, columns: int, keyed: bool = True) -> tuple[int, np.ndarray | None, list[np.ndarray]]:
    """A blob's number, contexts, and values (an array for each of ``columns``)."""
    number, _ = np.frombuffer(blob, np.int64, 2).tolist()
    kinds = [(f"u{width}", 1) for width in np.frombuffer(blob, np.uint8, columns, 16)]
    found = list(_parts(blob, 2, *([(np.uint64, 1)] if keyed else []), *kinds, skip=columns))
    return number, found[0] if keyed else None, found[-columns:]


def by_part(contexts: np.ndarray, parts: int) -> list[np.ndarray]:
    """Places of the sorted ``contexts``, those of one part of the hashes together."""
    return together((contexts >> np.uint64(20)) % np.uint64(parts))


def together(part: np.ndarray) -> list[np.ndarray]:
    """Places of equal numbers, in order."""
    order = np.argsort(part, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(part[order])) + 1)


class BucketContexts:
    """A number for each context of one bucket."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def __getitem__(self, context):
        return self.values[np.searchsorted(self.keys, context)].astype(float)


class StagedContexts:
    """The same, looked up by the driver in the sums of all buckets, of which the last
    column is still to be added up."""

    def __init__(self, sums: DataFrame, column: int, columns: int):
        self.sums, self.column, self.columns = sums, column, columns

    def __getitem__(self, context):
        wanted, at = np.unique(np.asarray(context, np.uint64), return_inverse=True)
        column, columns = self.column, self.columns

        def run(batches):
            for pdf in batches:
                for blob in pdf.blob:
                    _, keys, values = parse_contexts(blob, columns)
                    hit = np.isin(keys, wanted)
                    yield pd.DataFrame({"id": keys[hit].view(np.int64), "x": values[column][hit].astype(float)})

        known = column < columns - 1 and columns > 2
        rows = self.sums.where("kind = 'context'").select("blob").mapInPandas(run, "id long, x double").groupBy("id").agg(
            (F.max("x") if known else F.sum("x")).alias("x")).collect()
        found = {r["id"]: r["x"] for r in rows}
        return np.array([found[k] for k in wanted.view(np.int64).tolist()])[at].reshape(np.shape(context))[()]


@dataclass
class Totals:
    """What all buckets must know; its size does not depend on the corpus but for
    ``split`` (words that are spread over buckets: a few per bucket). Numbers per
    context stay in ``contexts``, per bucket those of its own."""
    context_customers: BucketContexts | StagedContexts | None = None
    context_tables: list = field(default_factory=list)              # one a sweep, the first with a table a dish
    root_customers: list[float] = field(default_factory=list)
    root_tables: list[float] = field(default_factory=list)
    split: list[dict[int, float]] = field(default_factory=list)     # root customers of split words, one a sweep
    split_count: dict[int, int] = field(default_factory=dict)       # their tokens in training
    words: int = 0
    training: int = 0
    discount: float = 0.5
    root_discount: float = 0.5
    parts: int = 1                                                  # of the contexts' hashes
    contexts: DataFrame | None = None                               # (bucket, contexts): customers and tables of every sweep
    sums: DataFrame | None = None                                   # staged, what contexts are read from

    def to_send(self) -> Totals:
        return replace(self, context_customers=None, context_tables=[], contexts=None, sums=None)

    def of_bucket(self, keys: np.ndarray, blobs) -> Totals:
        """With the numbers of one bucket's contexts, as the exchange returned them: a blob
        for every part, in the order in which the bucket sent the part its contexts."""
        columns = 1 + len(self.root_customers)
        found = sorted((parse_contexts(blob, columns, False) for blob in blobs), key=lambda x: x[0])
        place = np.concatenate(by_part(keys, self.parts))
        tables = []
        for k in range(columns):
            sent = np.concatenate([values[k] for _, _, values in found])
            tables.append(BucketContexts(keys, np.empty_like(sent)))
            tables[k].values[place] = sent
        return replace(self, context_customers=tables[0], context_tables=tables[1:])


def coded(hashes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bytes for each hash, its place in the sorted ``codes`` or CODED, and the hashes
    that have no place there, in order."""
    at = np.searchsorted(codes, hashes)
    hit = codes[np.minimum(at, len(codes) - 1)] == hashes if len(codes) else np.zeros(len(hashes), bool)
    return np.where(hit, at, CODED).astype(np.uint16), hashes[~hit]


def decoded(code: np.ndarray, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
    out = np.empty(len(code), np.uint64)
    hit = code < CODED
    out[hit], out[~hit] = codes[code[hit]], rest
    return out


def _parts(blob: bytes, head: int, *kinds, skip: int = 0):
    """The arrays of a blob that begins with ``head`` numbers and ``skip`` bytes; kinds:
    (type, which of those numbers is the array's length)."""
    sizes, at = np.frombuffer(blob, np.int64, head), 8 * head + skip
    for kind, k in kinds:
        yield np.frombuffer(blob, kind, sizes[k], at)
        at += np.dtype(kind).itemsize * int(sizes[k])


def _blob(head: list[int], *arrays: np.ndarray) -> bytes:
    return np.array(head, np.int64).tobytes() + b"".join(x.tobytes() for x in arrays)


def _starts(*sorted_: np.ndarray) -> np.ndarray:
    """Whether each place begins a run of equal values."""
    fresh = np.ones(len(sorted_[0]), bool)
    fresh[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_])
    return fresh


def merge(blobs: list[bytes], codes: np.ndarray) -> tuple[bytes, bytes]:
    """All blobs of a bucket as its sorted dishes and, for scoring only, their postings."""
    rows, word, context, doc, count, train = [], [], [], [], [], []
    for blob in blobs:
        steps, flags, of, of_rest, runs, local, code, rest, times = _parts(
            blob, 5, (np.int64, 0), (np.uint8, 0), (np.uint16, 1), (np.uint64, 2), (np.uint32, 1),
            (np.uint16, 3), (np.uint16, 3), (np.uint64, 4), (np.uint16, 3))
        word.append(np.repeat(decoded(of, of_rest, codes), runs))
        context.append(decoded(code, rest, codes))
        count.append(times)
        doc.append(local.astype(np.uint32) + np.uint32(sum(map(len, rows))))
        train.append(flags[local] == 0)
        rows.append(np.cumsum(steps))
    rows, word, context = np.concatenate(rows), np.concatenate(word), np.concatenate(context)
    order = np.lexsort((context, word))
    word, context = word[order], context[order]
    doc, count, train = (np.concatenate(x)[order] for x in (doc, count, train))
    dish = np.flatnonzero(_starts(word, context))
    customers = narrow(np.add.reduceat(count.astype(np.int64) * train, dish))
    postings = np.diff(np.append(dish, len(word)))
    word, context = word[dish], context[dish]
    runs = np.flatnonzero(_starts(word))
    contexts, context_of = np.unique(context, return_inverse=True)
    by_row = np.argsort(rows)
    place = np.empty(len(rows), np.uint32)
    place[by_row] = np.arange(len(rows), dtype=np.uint32)
    return (_blob([len(dish), len(runs), len(contexts), customers.itemsize], word[runs], np.diff(np.append(runs, len(word))).astype(np.uint32),
                  contexts, context_of.astype(np.uint32), customers),
            _blob([len(rows), len(dish), len(doc)], np.diff(rows[by_row], prepend=0), postings.astype(np.uint32), place[doc], count))


class Postings:
    """Documents of a bucket, and the document, count and dish of every posting."""

    def __init__(self, blob: bytes):
        steps, postings, self.doc, self.count = _parts(
            blob, 3, (np.int64, 0), (np.uint32, 1), (np.uint32, 2), (np.uint16, 2))
        self.doc_ids = np.cumsum(steps)
        self.dish_of = np.repeat(np.arange(len(postings)), postings)


class Bucket:
    """Words and contexts of a bucket, as sorted dishes."""

    def __init__(self, blobs: list[bytes]):
        width = np.frombuffer(blobs[0], np.int64, 4)[3]
        self.words, dishes, self.contexts, self.context_of, customers = _parts(
            blobs[0], 4, (np.uint64, 1), (np.uint32, 1), (np.uint64, 2), (np.uint32, 0), (f"u{width}", 0))
        self.customers = customers.astype(float)
        self.word_of = np.repeat(np.arange(len(self.words)), dishes)  # dish -> word
        self.word, self.context = self.words[self.word_of], self.contexts[self.context_of]
        self.word_count = np.bincount(self.word_of, weights=self.customers, minlength=len(self.words))
        with np.errstate(over="ignore"):
            self.key = mix(self.word * np.uint64(3) + self.context)

    def whole(self, values: np.ndarray, split: dict) -> np.ndarray:
        """Per word: its value here, or over all buckets if it is split."""
        if not split:
            return values
        keys = np.array(sorted(split), np.uint64)
        at = np.minimum(np.searchsorted(keys, self.words), len(keys) - 1)
        hit = keys[at] == self.words
        out = values.astype(float).copy()
        out[hit] = np.array([split[int(k)] for k in keys], float)[at[hit]]
        return out

    def root(self, tables: np.ndarray, totals: Totals, sweep: int) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of every word in the unigram restaurant. The
        tables that a split word has here are all its tables, drawn alike everywhere."""
        own = np.bincount(self.word_of, weights=tables, minlength=len(self.words))
        customers = self.whole(own, totals.split[sweep] if sweep < len(totals.split) else {})
        base = np.full(len(self.words), 1.0 / (totals.words + 1))
        root_tables = seat(customers, base, totals.root_discount, STRENGTH,
                           totals.root_tables[-1] if totals.root_tables else 0.0, self.words, 100 + sweep)
        return customers, root_tables

    def parent(self, customers: np.ndarray, tables: np.ndarray, totals: Totals, sweep: int) -> np.ndarray:
        """Predictive probability of every word in the unigram restaurant."""
        total, opened, d = totals.root_customers[sweep], totals.root_tables[sweep], totals.root_discount
        return (np.maximum(customers - d * tables, 0) + (STRENGTH + d * opened) / (totals.words + 1)) / (STRENGTH + total)

    def sweeps(self, totals: Totals, upto: int):
        """Tables per dish, and the words' customers and tables above, for every
        sweep so far: each needs the totals of the one before."""
        tables = np.minimum(self.customers, 1)
        for sweep in range(upto + 1):
            if sweep:
                chance = self.parent(customers, root_tables, totals, sweep - 1)[self.word_of]
                tables = seat(self.customers, chance, totals.discount, STRENGTH,
                              totals.context_tables[sweep - 1][self.contexts][self.context_of], self.key, sweep)
            seen = Totals(totals.context_customers, words=totals.words, root_discount=totals.root_discount,
                          split=totals.split, root_tables=totals.root_tables[:sweep])
            customers, root_tables = self.root(tables, seen, sweep)
            yield sweep, tables, customers, root_tables


def bucket_of(word: np.ndarray, context: np.ndarray, hot: dict[int, int], buckets: int) -> np.ndarray:
    """Buckets by word; frequent words by word and part of their contexts."""
    salt = np.zeros(len(word), np.uint64)
    if hot:
        keys = np.array(sorted(hot), np.uint64)
        parts = np.array([hot[int(k)] for k in keys], np.uint64)
        at = np.minimum(np.searchsorted(keys, word), len(keys) - 1)
        hit = keys[at] == word
        salt[hit] = context[hit] % parts[at[hit]] + np.uint64(1)
    with np.errstate(over="ignore"):
        return (mix(word + salt * np.uint64(_GOLDEN)) % np.uint64(buckets)).astype(np.int64)


def _pack(pdf: pd.DataFrame, hot: dict[int, int], buckets: int, codes: np.ndarray):
    """Bucket and blob rows of up to 65,536 documents."""
    word, context, doc, flags = [], [], [], np.zeros(len(pdf), np.uint8)
    for i, (doc_id, text) in enumerate(zip(pdf.doc_id, pdf.text)):
        t = tokens(text)
        before = mix(t[:-1]) % np.uint64(CONTEXTS)
        word.append(t)
        context.append(np.concatenate([np.array([CONTEXTS], np.uint64), before]))
        doc.append(np.full(len(t), i, np.uint16))
        flags[i] = is_held_out(doc_id)
    word, context, doc = map(np.concatenate, (word, context, doc))
    bucket = bucket_of(word, context, hot, buckets)
    order = np.lexsort((context, word, narrow(bucket)))  # stable: documents stay in order
    word, context, doc, bucket = word[order], context[order], doc[order], bucket[order]
    fresh = np.ones(len(word), bool)
    fresh[1:] = ((word[1:] != word[:-1]) | (context[1:] != context[:-1]) | (doc[1:] != doc[:-1]))
    starts = np.flatnonzero(fresh)
    count = np.diff(np.append(starts, len(word)))
    word, context, doc, bucket = word[starts], context[starts], doc[starts], bucket[starts]
    while (count > 65_535).any():  # counts are two bytes: a larger one becomes several postings
        big = np.flatnonzero(count > 65_535)
        word, context, doc, bucket = (np.insert(x, big, x[big]) for x in (word, context, doc, bucket))
        spare = count.copy()
        spare[big] -= 65_535
        count = np.insert(spare, big, 65_535)
    rows = pdf.row.to_numpy(np.int64)
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for lo, hi in zip(edges, np.append(edges[1:], len(bucket))):
        used, local = np.unique(doc[lo:hi], return_inverse=True)
        runs = np.flatnonzero(_starts(word[lo:hi]))  # a word's postings lie together
        (of, of_rest), (code, rest) = coded(word[lo:hi][runs], codes), coded(context[lo:hi], codes)
        yield int(bucket[lo]), _blob(
            [len(used), len(runs), len(of_rest), hi - lo, len(rest)], np.diff(rows[used], prepend=0), flags[used], of, of_rest,
            np.diff(np.append(runs, hi - lo)).astype(np.uint32), local.astype(np.uint16), code, rest, count[lo:hi].astype(np.uint16))


def pack_documents(docs: DataFrame, hot: dict[int, int], buckets: int, frequent: list[int] = ()) -> DataFrame:
    """(bucket, blobs, postings, ids) of columns row, doc_id and text; blobs: one, of the
    bucket's dishes. ``frequent``: words that cross the network as two bytes, the contexts
    after them likewise. The rows of a chunk and their doc_ids go along with one of its
    blobs: what is written holds every row's number and doc_id from one and the same
    execution."""
    words = np.array(frequent, np.uint64)
    codes = np.unique(np.concatenate([words, mix(words) % np.uint64(CONTEXTS), np.array([CONTEXTS], np.uint64)])[:CODED])
    shared = docs.sparkSession.sparkContext.broadcast((hot, codes))

    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), CHUNK):
                chunk = pdf.iloc[lo:lo + CHUNK]
                out = [[*packed, None] for packed in _pack(chunk, shared.value[0], buckets, shared.value[1])]
                first = chunk.row.iloc[:1].to_numpy(np.uint64)
                out[int(mix(first)[0] % np.uint64(len(out)))][2] = [
                    {"row": int(row), "doc_id": doc_id} for row, doc_id in zip(chunk.row, chunk.id)]
                yield pd.DataFrame(out, columns=["bucket", "blob", "ids"])

    # doc_id as text beside itself: pandas makes numbers with nulls floating-point
    packed = docs.select("row", "doc_id", "text", F.col("doc_id").cast("string").alias("id")).mapInPandas(
        run, "bucket long, blob binary, ids array<struct<row:long,doc_id:string>>")
    # A bucket is about BUCKET_BYTES of text: one row, so that later passes need no
    # shuffle. The number of tasks follows the buckets, so that few are held at once.
    gathered = packed.repartition(math.ceil(buckets / TASK_BUCKETS), "bucket").groupBy("bucket").agg(
        F.collect_list("blob").alias("blobs"), F.flatten(F.collect_list("ids")).alias("ids"))

    def sort(batches):
        for batch in batches:
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                dishes, postings = merge(batch.column("blobs")[i].as_py(), shared.value[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int64()), pa.array([[dishes]], pa.list_(pa.binary())), pa.array([postings], pa.binary()),
                     batch.column("ids").slice(i, 1)], ["bucket", "blobs", "postings", "ids"])

    return gathered.mapInArrow(sort, "bucket long, blobs array<binary>, postings binary, ids array<struct<row:long,doc_id:string>>")


def frequent_words(docs: DataFrame, buckets: int) -> tuple[dict[int, int], list[int]]:
    """Words that alone would make a quarter of a bucket or more, with the number
    of parts they are split into; at most four a bucket can be that frequent. And the most
    frequent words of all, half as many as there are codes."""
    def count(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), 500):
                words = np.concatenate([tokens(t) for t in pdf.text.iloc[lo:lo + 500]] + [np.empty(0, np.uint64)])
                w, n = np.unique(words, return_counts=True)
                w, n = w[n > 1], n[n > 1]
                often = n >= len(words) / (64 * buckets)
                yield pd.DataFrame({"word": np.append(w.view(np.int64), 0), "every": np.append(n, 0),
                                    "n": np.append(n * often, 0), "total": np.append(np.zeros(len(w), int), len(words))})

    rows = (docs.sample(fraction=HOT_SAMPLE, seed=11).select("text").mapInPandas(count, "word long, every long, n long, total long")
            .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("every", "n", "total")]))
    rows = staged(rows, "frequent")
    total = rows.agg(F.sum("total")).first()[0] or 0
    share = 1 / (4 * buckets)

    def number(r) -> int:
        return int(np.int64(r["word"]).view(np.uint64))

    hot = {number(r): min(CONTEXTS, 1 + int(r["n"] / total / share))
           for r in rows.where(F.col("n") >= F.lit(total * share)).where("n > 0").collect()}
    most = rows.where("every > 0").orderBy(F.desc("every"), "word").select("word").limit(CODED // 2).collect()
    return hot, [number(r) for r in most]


def _each(run, shape: pa.Schema):
    """Apply ``run`` to every bucket: its number, blobs and further columns. Of a batch, one
    bucket's values at a time become Python objects."""
    def batches_of(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_pandas(run(*(c[i].as_py() for c in batch.columns)), schema=shape, preserve_index=False)
    return batches_of


@contextmanager
def one_bucket_batches(spark):
    """A bucket is megabytes: meanwhile one at a time is read and sent to a worker."""
    with (setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"),
          setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "1")):
        yield


def with_contexts(buckets: DataFrame, totals: Totals | None, *more: str) -> DataFrame:
    buckets = buckets.select("bucket", "blobs", *more)
    if totals is None:
        return buckets.withColumn("contexts", F.lit(None).cast("array<binary>"))
    return buckets.join(totals.contexts.hint("shuffle_hash"), "bucket")


def exchange(sums: DataFrame, columns: int, known: int, parts: int) -> DataFrame:
    """(bucket, contexts) of (part, blob): in every bucket's blobs the last
    ``columns - known`` columns become sums over all buckets that have the context. The
    contexts themselves, most of the bytes, are not sent back: a bucket knows what it asked."""
    def run(batches):
        for pdf in batches:
            for number, blobs in zip(pdf.part, pdf.blobs):
                bucket, keys, values = zip(*(parse_contexts(blob, columns) for blob in blobs))
                every, at = np.unique(np.concatenate(keys), return_inverse=True)
                total = [np.bincount(at, weights=np.concatenate([v[c] for v in values]), minlength=len(every))
                         for c in range(known, columns)]
                out, lo = [], 0
                for b, k, v in zip(bucket, keys, values):
                    here = at[lo:lo + len(k)]
                    out.append((b, pack_contexts(number, None, [*v[:known], *(x[here] for x in total)])))
                    lo += len(k)
                yield pd.DataFrame(out, columns=["bucket", "blob"])

    totals = sums.groupBy("part").agg(F.collect_list("blob").alias("blobs")).mapInPandas(run, "bucket long, blob binary")
    return totals.repartition(parts, "bucket").groupBy("bucket").agg(F.collect_list("blob").alias("contexts"))


def _sums(buckets: DataFrame, totals: Totals | None, sweep: int, hot: dict[int, int], parts: int) -> Totals:
    """One pass over all buckets; adds the totals of ``sweep``."""
    spark = buckets.sparkSession
    shared = spark.sparkContext.broadcast((totals and totals.to_send(), hot))
    known = 0 if totals is None else 1 + sweep

    def run(bucket: int, blobs: list[bytes], contexts) -> pd.DataFrame:
        totals, hot = shared.value
        b = Bucket(blobs)
        if totals is None:
            tables = np.minimum(b.customers, 1)
            customers, root_tables = np.bincount(b.word_of, weights=tables, minlength=len(b.words)), None
            values = [np.bincount(b.context_of, weights=b.customers, minlength=len(b.contexts))]
        else:
            totals = totals.of_bucket(b.contexts, contexts)
            for _, tables, customers, root_tables in b.sweeps(totals, sweep):
                pass
            values = [x[b.contexts] for x in (totals.context_customers, *totals.context_tables)]
        split = np.isin(b.words, np.array(sorted(hot), np.uint64)) if hot else np.zeros(len(b.words), bool)
        own = np.bincount(b.word_of, weights=tables, minlength=len(b.words))
        alone = ~split
        once = (b.customers == 1).sum(), (b.customers == 2).sum()
        rooted = root_tables if root_tables is not None else np.minimum(own, 1)
        rows = [("scalar", 0, float(own[alone].sum()), float(rooted[alone].sum()), None),
                ("scalar", 1, float((b.word_count[alone] > 0).sum()), float(b.customers.sum()), None),
                ("scalar", 2, float(once[0]), float(once[1]), None),
                ("scalar", 3, float((own[alone] == 1).sum()), float((own[alone] == 2).sum()), None)]
        rows += [("word", int(np.uint64(w).view(np.int64)), float(t), float(c), None)
                 for w, t, c in zip(b.words[split], own[split], b.word_count[split])]
        values.append(np.bincount(b.context_of, weights=tables, minlength=len(b.contexts)))
        for at in by_part(b.contexts, parts):
            rows.append(("context", int((b.contexts[at[0]] >> np.uint64(20)) % np.uint64(parts)), 0.0, 0.0, pack_contexts(bucket, b.contexts[at], [v[at] for v in values])))
        return pd.DataFrame(rows, columns=["kind", "id", "x", "y", "blob"])

    with one_bucket_batches(spark):
        sums = staged(with_contexts(buckets, totals).mapInArrow(
            _each(run, SUMS), "kind string, id long, x double, y double, blob binary"), "sums", compression="zstd")
    if totals is not None and totals.sums is not None:
        unstaged(totals.sums)  # what it had is among the new ones
    # Five rows and those of split words reach the driver.
    rows = (sums.where("kind <> 'context'").groupBy("kind", "id").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).collect())
    got = {(r["kind"], r["id"]): (r["x"], r["y"]) for r in rows}
    zero = (0.0, 0.0)
    split = {int(np.int64(i).view(np.uint64)): v for (kind, i), v in got.items() if kind == "word"}
    if totals is None:
        totals = Totals(parts=parts)
        totals.split_count = {w: int(y) for w, (_, y) in split.items()}
        once, twice = got.get(("scalar", 2), zero)
        totals.discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
        once, twice = got.get(("scalar", 3), zero)
        totals.root_discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
        totals.words = int(got.get(("scalar", 1), zero)[0]) + sum(1 for _, y in split.values() if y > 0)
        totals.training = int(got.get(("scalar", 1), zero)[1])
    customers, rooted = got.get(("scalar", 0), zero)
    words = np.array(sorted(split), np.uint64)
    of = np.array([split[int(w)][0] for w in words], float)
    above = seat(of, np.full(len(of), 1.0 / (totals.words + 1)), totals.root_discount, STRENGTH,
                 totals.root_tables[-1] if totals.root_tables else 0.0, words, 100 + sweep) if len(of) else of
    columns = sweep + 2
    totals.sums = sums
    totals.contexts = exchange(sums.where("kind = 'context'").select(F.col("id").alias("part"), "blob"),
                               columns, known, parts)
    totals.context_customers, *totals.context_tables = [
        StagedContexts(sums, i, columns) for i in range(columns)]
    totals.split.append({int(w): float(x) for w, x in zip(words, of)})
    totals.root_customers.append(customers + of.sum())
    totals.root_tables.append(rooted + above.sum())
    return totals


def train(buckets: DataFrame, hot: dict[int, int], parts: int | None = None) -> Totals:
    """``parts``: the number of tasks that buckets are dealt to."""
    totals = None
    for sweep in range(SWEEPS + 1):
        totals = _sums(buckets, totals, sweep, hot, parts or tasks(buckets.sparkSession))
    return totals


def staged_buckets(packed: DataFrame, parts: int) -> DataFrame:
    """As ``staged``, and Spark knows that the files are dealt by bucket into
    ``parts``: a join with the buckets' contexts does not move the postings."""
    spark = packed.sparkSession
    name = f"postings_{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        (packed.write.format("parquet").option("compression", "zstd").option("path", f"{shared_dir(spark)}/stage-{name}")
         .bucketBy(parts, "bucket").saveAsTable(name))
    table = spark.table(name)
    table.schema  # resolved: the name is not needed any more, the files stay
    spark.sql(f"DROP TABLE {name}")
    return table


def add_up(batches):
    """The sums per document of (part, blobs): every bucket's sums for the documents of the part."""
    for batch in batches:
        for blobs in batch.column("blobs"):
            found = []
            for blob in blobs.as_py():
                _, *widths = np.frombuffer(blob, np.int64, 3)
                found.append(list(_parts(blob, 3, (np.int64, 0), *((f"u{w}", 0) for w in widths), (float, 0), (float, 0))))
            rows, at = np.unique(np.concatenate([np.cumsum(f[0]) for f in found]), return_inverse=True)
            sums = [np.bincount(at, weights=np.concatenate([f[c] for f in found]), minlength=len(rows)) for c in range(1, 5)]
            yield pa.RecordBatch.from_arrays([pa.array(x).cast(t) for x, t in zip((rows, *sums), SCORES.types)], schema=SCORES)


def score_buckets(buckets: DataFrame, totals: Totals) -> DataFrame:
    """Per document: tokens, known tokens, base and model log10. A bucket has words of most
    documents; its sums for them are packed by parts of the documents, and a part adds
    them up."""
    parts = totals.parts
    shared = buckets.sparkSession.sparkContext.broadcast(totals.to_send())

    def sums_of(_, blobs: list[bytes], postings: bytes, contexts) -> tuple[np.ndarray, list[np.ndarray]]:
        b, p = Bucket(blobs), Postings(postings)
        totals = shared.value.of_bucket(b.contexts, contexts)
        sizes = totals.context_customers[b.contexts][b.context_of]
        known = b.whole(b.word_count, totals.split_count)
        base = np.log10((known + 1) / (totals.training + totals.words + 1))
        total = np.zeros(len(b.word))
        for sweep, tables, customers, root_tables in b.sweeps(totals, SWEEPS):
            if sweep:
                chance = b.parent(customers, root_tables, totals, sweep)[b.word_of]
                opened = totals.context_tables[sweep][b.contexts][b.context_of]
                total += ((np.maximum(b.customers - totals.discount * tables, 0)
                           + (STRENGTH + totals.discount * opened) * chance)
                          / (STRENGTH + sizes))
        model = np.log10(total / SWEEPS)
        word_at = b.word_of[p.dish_of]
        n = len(p.doc_ids)
        sums = [np.bincount(p.doc, weights=p.count * x, minlength=n)
                for x in (1, (known > 0)[word_at], base[word_at], model[p.dish_of])]
        return p.doc_ids, sums

    def packed(rows: np.ndarray, sums: list[np.ndarray]) -> pa.RecordBatch:
        part = (mix(rows.astype(np.uint64) >> np.uint64(8)) % np.uint64(parts)).astype(np.int64)
        out = []
        for at in together(part):
            n, k = narrow(sums[0][at]), narrow(sums[1][at])
            out.append((part[at[0]], _blob([len(at), n.itemsize, k.itemsize], np.diff(rows[at], prepend=0), n, k, sums[2][at], sums[3][at])))
        return pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=SENT.names), schema=SENT, preserve_index=False)

    def run(batches):
        """A task's buckets are added up before their sums are sent, up to HELD documents."""
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                rows, sums = sums_of(*(c[i].as_py() for c in batch.columns))
                if held is not None:
                    rows, at = np.unique(np.concatenate([held[0], rows]), return_inverse=True)
                    sums = [np.bincount(at, weights=np.concatenate([a, b]), minlength=len(rows)) for a, b in zip(held[1], sums)]
                held = rows, sums
                if len(rows) > HELD:
                    yield packed(*held)
                    held = None
        if held is not None:
            yield packed(*held)

    sent = with_contexts(buckets, totals, "postings").mapInArrow(run, "part long, blob binary")
    return sent.groupBy("part").agg(F.collect_list("blob").alias("blobs")).mapInArrow(
        add_up, "row long, n long, k long, base double, model double")


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of
    every row of ``docs`` (columns doc_id and text)."""
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    hot, frequent = frequent_words(docs, buckets) if buckets > 1 else ({}, [])
    # Rows are known by their place in the input, so that repeated ids stay apart. Places
    # depend on the executors of the moment: they are taken once and written with the postings.
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    # Large values: zstd streams them, where snappy holds whole pages outside the heap.
    parts = math.ceil(buckets / TASK_BUCKETS)
    packed = staged_buckets(pack_documents(rows, hot, buckets, frequent), parts)
    totals = train(packed, hot, parts)
    with one_bucket_batches(docs.sparkSession):
        scores = staged(score_buckets(packed, totals), "scores")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    ids = packed.select(F.inline("ids")).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    return ids.join(scores, "row").select(
        "doc_id", held.alias("held_out"), F.col("n").alias("n_tokens"), F.col("k").alias("n_known"),
        F.lit(totals.training).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), F.col("model").alias("score"))
