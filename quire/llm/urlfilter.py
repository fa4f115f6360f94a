"""URL filters by Bloom filter cascades.

A list of keys is encoded against the corpus's whole universe of keys: level 0
holds the listed keys, level 1 the universe keys that level 0 wrongly lets
through, level 2 the listed keys that level 1 wrongly lets through, and so on
until nothing is wrong. For every key of the universe the parity of the first
level that refuses it is then its exact membership, so the corpus is judged in
one scan without a join.

The universe is scanned, never shuffled: only the keys that pass level 0 (about
as many as are listed, by the choice of its false positive rate) are gathered.
Keys are known by two 64-bit hashes; two keys equal in both count as one.

Defined results: null urls and urls without ``://`` have empty host and path,
fit no rule and are allowed; rows are judged one by one (repeated rows, extra
columns and empty tables pass through); among rules of one length the one with
the longer host wins; a url that no rule fits is not listed, hence allowed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules as (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
MAX_BYTES = 256 << 20  # most that the levels of a cascade may take together


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix generator, on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    """Bit positions, one row per key, one column per probe."""
    with np.errstate(over="ignore"):
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        a, b = _mix(h1 ^ salt), _mix(h2 ^ salt) | np.uint64(1)
        return (a[:, None] + np.arange(probes, dtype=np.uint64) * b[:, None]) % np.uint64(bits)


@dataclass(frozen=True)
class Level:
    bits: int
    probes: int
    words: np.ndarray  # uint64

    def holds(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        at = _positions(h1, h2, level, self.bits, self.probes)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def is_listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership of universe keys: the parity of the first level that refuses."""
    out = np.zeros(len(h1), bool)
    open_ = np.arange(len(h1))
    for i, level in enumerate(levels):
        inside = level.holds(h1[open_], h2[open_], i)
        out[open_[~inside]] = i % 2 == 1
        open_ = open_[inside]
    out[open_] = len(levels) % 2 == 1
    return out


def hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)


def _u64(x: pd.Series | np.ndarray) -> np.ndarray:
    return np.asarray(x, dtype=np.int64).view(np.uint64)


def _build_level(keys: DataFrame, level: int, n: int, rate: float, room: int) -> Level:
    """Set the bits of ``keys`` (columns h1, h2) where they lie, join the words
    with bit_or, and fetch the words (bits / 64 rows at most)."""
    probes = max(1, round(math.log2(1 / rate)))
    bits = max(64, math.ceil(n * probes / math.log(2) / 64) * 64)
    if bits // 8 > room:
        raise ValueError(f"level {level} would take {bits // 8} bytes, more than the {room} that are left of max_bytes")

    def words(batches):
        for pdf in batches:
            at = _positions(_u64(pdf.h1), _u64(pdf.h2), level, bits, probes).ravel()
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64),
                                "mask": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    found = (keys.select("h1", "h2").mapInPandas(words, "word long, mask long")
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas())
    out = np.zeros(bits // 64, np.uint64)
    out[found.word.to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return Level(bits, probes, out)


def _passing(keys: DataFrame, levels: list[Level], at: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(levels[at])

    @F.pandas_udf("boolean")
    def holds(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(shared.value.holds(_u64(h1), _u64(h2), at))

    return keys.where(holds("h1", "h2"))


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[Level]:
    """Levels for the keys in ``listed`` over ``universe`` (both with one string
    column ``key``; repeats allowed). The size is checked before a level is
    fetched: beyond ``max_bytes`` the build stops with an error, and
    ``listed_by_join`` is the way to go."""
    h1, h2 = hashes(F.col("key"))
    inner = listed.select("key", h1.alias("h1"), h2.alias("h2")).distinct()
    n = inner.count()
    if n == 0:
        return []
    every = universe.select("key", h1.alias("h1"), h2.alias("h2"))
    total = every.agg(F.approx_count_distinct("h1")).first()[0]
    rate = min(0.5, n * math.sqrt(0.5) / max(1, total))
    levels = [_build_level(inner, 0, n, rate, max_bytes)]
    # What passes level 0 wrongly: few keys, so taking the listed ones out is cheap.
    outer = _passing(every, levels, 0).distinct().join(inner, ["key", "h1", "h2"], "left_anti").checkpoint()
    while (n := outer.count()) > 0:
        room = max_bytes - sum(level.words.nbytes for level in levels)
        levels.append(_build_level(outer, len(levels), n, 0.5, room))
        inner, outer = outer, _passing(inner, levels, len(levels) - 1).checkpoint()
    return levels


def listed_by_join(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Exact membership for lists beyond the size that may be broadcast."""
    marked = listed.select(F.col("key").alias(key)).distinct().withColumn("listed", F.lit(True))
    return df.join(marked, key, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys a rule could have for this url: the last ``labels`` labels of the
    host and the first ``size`` characters of the path, for every shape."""
    names = F.split(host, r"\.", -1)
    out = []
    for labels, size in shapes:
        fits = (F.size(names) >= labels) & (F.char_length(path) >= size) & (host != "")
        key = F.concat(F.array_join(F.slice(names, F.greatest(F.size(names) - labels + 1, F.lit(1)), labels), "."),
                       F.substring(path, 1, size))
        out.append(F.when(fits, key))
    return F.array_compact(F.array(*out))


def judge_urls(pages: DataFrame, rules=RULES, url_col: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Add host, path, rule and verdict to every row."""
    spark = pages.sparkSession
    # Longest rule first, then the longer host: the first candidate listed wins.
    shapes = sorted({(len(h.split(".")), len(p)) for h, p, _ in rules}, reverse=True)
    host, path = url_parts(F.col(f"`{url_col}`"))
    keyed = pages.withColumns({"host": host, "path": path}) \
        .withColumn("_keys", candidates(F.col("host"), F.col("path"), shapes))
    universe = keyed.select(F.explode("_keys").alias("key"))
    cascades = {}
    for verdict in ("allow", "block"):
        listed = spark.createDataFrame([(h + p,) for h, p, v in rules if v == verdict] or [("",)], "key string")
        cascades[verdict] = build_cascade(listed, universe, max_bytes)
    shared = spark.sparkContext.broadcast((cascades["allow"], cascades["block"]))

    @F.pandas_udf("array<int>")
    def verdicts(h1: pd.Series, h2: pd.Series) -> pd.Series:
        """Per candidate: 1 allowed, 2 blocked, 0 no rule."""
        sizes = [len(x) for x in h1]
        a = _u64(np.concatenate([*h1, np.empty(0, np.int64)]))
        b = _u64(np.concatenate([*h2, np.empty(0, np.int64)]))
        allow, block = shared.value
        code = np.where(is_listed(block, a, b), 2, np.where(is_listed(allow, a, b), 1, 0))
        return pd.Series([x.tolist() for x in np.split(code, np.cumsum(sizes)[:-1])] if sizes else [], dtype=object)

    coded = keyed.withColumn("_codes", verdicts(F.transform("_keys", lambda k: hashes(k)[0]),
                                                F.transform("_keys", lambda k: hashes(k)[1])))
    fitting = F.filter(F.arrays_zip(F.col("_keys").alias("key"), F.col("_codes").alias("code")), lambda x: x["code"] > 0)
    best = F.reduce(fitting, F.lit(None).cast("struct<key:string,code:int>"), lambda old, new: F.when(
        old.isNull() | (F.char_length(new["key"]) > F.char_length(old["key"])), new).otherwise(old))
    return coded.withColumn("_best", best).withColumns({
        "rule": F.col("_best.key"),
        "verdict": F.when(F.col("_best.code") == 2, "block").otherwise("allow"),
    }).drop("_keys", "_codes", "_best")


def op7_sql() -> str:
    """The same judgement by string tests against the rule list."""
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
WITH rules(rh, rp, rv) AS (VALUES {listed}),
parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
                       ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
fits AS (
  SELECT page_id, rh || rp AS rule, rv,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM split JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.rv, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND f.k = 1
"""
