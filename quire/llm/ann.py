"""Approximate nearest neighbours by cosine with randomly rotated one-bit codes.

Unit vectors are assigned to their nearest centroid. A vector's offset from its
centroid is rotated by a random orthogonal matrix and kept as one bit a
dimension plus two correction scalars: the offset's length and the inner product
of the offset's direction with its code. They give an unbiased estimate of any
inner product and a bound of its error; a candidate is scored exactly (double
precision, original vectors) only if its upper bound reaches the k-th best lower
bound.

Skew: equal vectors form one class that is searched once and carries only its
``k + 1`` smallest ids, which is all that a top-k with ties to the smaller id can
use, so a vector shared by a third of the rows costs one row. Small clusters share
a shard and large ones are split, so that a shard holds about BLOCK classes; the
queries of a shard are dealt into parts of about QUERIES.

The centroids are fitted on at most SAMPLE classes (those with the smallest hash);
every row is indexed. The number of clusters a query probes is the least that
covers RECALL of the true neighbours of at most TRIALS of the queries, which are
found by a scan of all rows; a query probes more where these hold fewer than LEAST
classes. Vectors without cluster structure so get a wide search, others a narrow one.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do vectors of another length than the most frequent
one (the longer, in a tie) or rows without an id. Repeated rows of one id are that
many candidates for others; none of them is a candidate for a query of that id.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import staged

SAMPLE = 20_000   # classes that the centroids are fitted on
BLOCK = 20_000    # classes that one task scans at a time
QUERIES = 2_000   # queries that one task holds at a time
TRIALS = 128      # queries whose true neighbours set the number of probes
RECALL = 0.99
LEAST = 2_000
EPSILON = 1.9     # width of the error bound
MAX_CLUSTERS = 2_048


@dataclass
class Index:
    centroids: np.ndarray  # float64, clusters x dimensions
    rotation: np.ndarray   # orthogonal, dimensions x dimensions

    def encode(self, unit: np.ndarray):
        """Cluster, packed sign bits, offset length and code alignment of rows."""
        cluster = self.nearest(unit, 1)[:, 0]
        offset = unit - self.centroids[cluster]
        length = np.linalg.norm(offset, axis=1)
        turned = (offset / np.where(length > 0, length, 1)[:, None]) @ self.rotation
        align = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
        return cluster, np.packbits(turned > 0, axis=1), length, align

    def nearest(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` clusters with the nearest centroids, nearest first."""
        d = (self.centroids ** 2).sum(axis=1) - 2 * unit @ self.centroids.T
        n = min(n, d.shape[1])
        best = np.argpartition(d, n - 1, axis=1)[:, :n] if n < d.shape[1] else np.tile(np.arange(n), (len(d), 1))
        return np.take_along_axis(best, np.argsort(np.take_along_axis(d, best, 1), axis=1, kind="stable"), 1)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1, without overflow for very large or small components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit(sample: np.ndarray, clusters: int, seed: int = 7, rounds: int = 8) -> Index:
    """Centroids (Lloyd's rounds) and a random rotation."""
    rng = np.random.default_rng(seed)
    clusters = max(1, min(clusters, len(sample)))
    centroids = sample[rng.choice(len(sample), clusters, replace=False)].copy()
    rotation = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))[0]
    for _ in range(rounds):
        own = Index(centroids, rotation).nearest(sample, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        count = np.bincount(own, minlength=clusters)
        centroids[count > 0] = sums[count > 0] / count[count > 0, None]
    return Index(centroids, rotation)


def estimate(index: Index, cluster: np.ndarray, queries: np.ndarray, codes: np.ndarray, length: np.ndarray, align: np.ndarray):
    """Estimated cosines (queries x candidates) and the bound of their error."""
    dims = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dims).astype(np.float32) * 2 - 1
    turned = (queries @ index.rotation).astype(np.float32)
    with_code = (turned @ signs.T).astype(float) / math.sqrt(dims)
    safe = np.maximum(align, 1e-9)
    middle = (queries @ index.centroids.T)[:, cluster]
    bound = length * np.sqrt(np.maximum(0, 1 - safe ** 2)) / safe * EPSILON / math.sqrt(max(1, dims - 1))
    return middle + with_code * (length / safe), bound + 1e-6


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=float) for x in column])


def classes(df: DataFrame, id_col: str, vector_col: str, keep: int) -> tuple[DataFrame, DataFrame]:
    """Valid rows as (vec_id, a, b), the class key being two hashes of the vector,
    and classes as (a, b, vector, ids: the ``keep`` smallest, repeats included)."""
    v = F.col(f"`{vector_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), v.cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0))
    common = (rows.groupBy(F.size("vector").alias("n")).count()
              .orderBy(F.desc("count"), F.desc("n")).limit(1).collect())
    dims = common[0]["n"] if common else 0
    keyed = rows.where(F.size("vector") == dims).select(
        "vec_id", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(3), "vector").alias("b"), "vector")
    # The rank filter is applied before the shuffle too: a task sends at most ``keep`` rows of a class.
    ranked = keyed.withColumn("_k", F.row_number().over(Window.partitionBy("a", "b").orderBy("vec_id")))
    grouped = ranked.where(F.col("_k") <= keep).groupBy("a", "b").agg(
        F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return keyed.drop("vector"), grouped


def probes_for(coded: DataFrame, shared, trial: np.ndarray, k: int) -> int:
    """Clusters to probe: the least number that covers RECALL of the ``k`` true
    neighbours of the trial queries (unit vectors, TRIALS at most)."""
    queries = coded.sparkSession.sparkContext.broadcast(trial)

    def nearest(batches):
        for pdf in batches:
            if len(pdf):
                scores = queries.value @ units(_stack(pdf.vector)).T
                n = min(k + 1, len(pdf))
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                yield pd.DataFrame({"query": np.repeat(np.arange(len(scores)), n), "cluster": pdf.cluster.to_numpy()[best.ravel()],
                                    "score": np.take_along_axis(scores, best, 1).ravel()})

    order = Window.partitionBy("query").orderBy(F.desc("score"))
    true = (coded.select("vector", "cluster").mapInPandas(nearest, "query long, cluster int, score double")
            .withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= k + 1).toPandas())
    places = np.argsort(shared.value.nearest(trial, len(shared.value.centroids)), axis=1)
    needed = np.sort(places[true["query"].to_numpy(), true.cluster.to_numpy()])
    return int(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)) - 1)]) + 1


def shards(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of every cluster."""
    parts = np.maximum(1, -(-size // BLOCK))
    first, at, room = np.zeros(len(size), np.int64), -1, 0
    for c, n in enumerate(size):
        if parts[c] > 1:
            first[c], at, room = at + 1, at + parts[c], 0
        else:
            if n > room or at < 0:
                at, room = at + 1, BLOCK
            first[c], room = at, room - n
    return first, parts


def search(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of ``df`` for every id in ``queries`` (column
    ``query_id``): query_id, rank, vec_id, score."""
    spark = df.sparkSession
    rows, grouped = classes(df, id_col, vector_col, k + 1)
    every = staged(grouped, "classes")
    n = every.count()
    asked = rows.join(queries.select(F.col("query_id").alias("vec_id")).distinct(), "vec_id", "left_semi").distinct()
    wanted = asked.select("a", "b").distinct().join(every.select("a", "b", "vector"), ["a", "b"])
    trial = wanted.orderBy("a", "b").limit(TRIALS).toPandas()
    if n == 0 or not len(trial):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = every.orderBy("a", "b").limit(SAMPLE).select("vector").toPandas()
    index = fit(units(_stack(sample.vector)), min(MAX_CLUSTERS, round(math.sqrt(n))))
    shared = spark.sparkContext.broadcast(index)  # at most MAX_CLUSTERS + dimensions vectors

    def encode(batches):
        for pdf in batches:
            if len(pdf):
                cluster, codes, length, align = shared.value.encode(units(_stack(pdf.vector)))
                yield pdf.assign(cluster=cluster.astype("int32"), code=[c.tobytes() for c in codes],
                                 length=length, align=align)

    coded = staged(every.mapInPandas(
        encode, "a long, b long, vector array<double>, ids array<long>, cluster int, code binary, length double, align double"),
        "codes")
    size = np.zeros(len(index.centroids), np.int64)
    for r in coded.groupBy("cluster").count().collect():  # one row a cluster, MAX_CLUSTERS at most
        size[r["cluster"]] = r["count"]
    probes = probes_for(coded, shared, units(_stack(trial.vector)), k)
    first, parts = shards(size)

    def route(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            order = shared.value.nearest(units(_stack(pdf.vector)), len(size))
            reach = np.maximum(probes, (np.cumsum(size[order], axis=1) < LEAST).sum(axis=1) + 1)
            at, who, where = pdf.reset_index(drop=True), [], []
            for i in range(len(at)):
                to = {int(first[c]) + j for c in order[i, :reach[i]] for j in range(parts[c])}
                where.extend(sorted(to))
                who.extend([i] * len(to))
            yield at.iloc[who].assign(shard=np.array(where, "int32"))

    routed = wanted.mapInPandas(route, "a long, b long, vector array<double>, shard int")
    part_of = routed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts"))
    # The queries of a shard are dealt into parts, and its candidates go to every part.
    left = (routed.join(part_of, "shard")
            .withColumn("part", F.pmod(F.xxhash64("a", "b"), F.col("parts")).cast("int")).drop("parts"))
    place = F.element_at(F.lit([int(x) for x in first]), F.col("cluster") + 1)
    split = F.element_at(F.lit([int(x) for x in parts]), F.col("cluster") + 1)
    right = (coded.withColumn("shard", (place + F.pmod(F.col("a"), split)).cast("int")).join(part_of, "shard")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))

    def scan(asked_pdf: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked_pdf) and len(pdf):
            unit = units(_stack(pdf.vector))
            codes = np.stack([np.frombuffer(c, np.uint8) for c in pdf.code])
            length, align, cluster = pdf.length.to_numpy(), pdf["align"].to_numpy(), pdf.cluster.to_numpy()
            ids, best = pdf.ids.to_numpy(), min(k + 1, len(pdf))
            for lo in range(0, len(asked_pdf), 128):
                some = asked_pdf.iloc[lo:lo + 128]
                q = units(_stack(some.vector))
                guess, bound = estimate(shared.value, cluster, q, codes, length, align)
                floor = -np.partition(bound - guess, best - 1, axis=1)[:, best - 1]
                for i, (a, b) in enumerate(zip(some.a, some.b)):
                    again = np.flatnonzero(guess[i] + bound >= floor[i])
                    # Summed the same way for every pair, so that equal vectors tie exactly.
                    score = (unit[again] * q[i]).sum(axis=1)
                    # Classes that tie with the last place stay: their ids decide.
                    last = np.partition(-score, best - 1)[best - 1]
                    out.extend((a, b, ids[j], min(1.0, max(-1.0, float(s))))
                               for j, s in zip(again[-score <= last], score[-score <= last]))
        return pd.DataFrame(out, columns=["a", "b", "ids", "score"])

    hits = left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(
        scan, "a long, b long, ids array<long>, score double")
    found = hits.select("a", "b", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("a", "b").orderBy(F.desc("score"), "vec_id")
    # Room for the k nearest and for the query's own rows (a class holds k + 1 at most).
    top = found.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= 2 * k + 1).drop("_k")
    answers = asked.withColumnRenamed("vec_id", "query_id").join(top, ["a", "b"]).where(
        F.col("vec_id") != F.col("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search_every(df: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``every``."""
    return search(df, df.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id")), k)
