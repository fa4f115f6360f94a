"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (line) is hashed to a wide vector; a document's fingerprint is the
sum of its paragraphs' vectors, every lane modulo 2^32. The order of paragraphs
does not matter, and a paragraph is inserted or deleted by adding or
subtracting its vector (``add_lanes``, ``subtract_lanes``).

The vector has three parts:
  * 16 uniform lanes from the hash of the whole paragraph: they decide equality;
  * 64 sign lanes: +-1 per phrase of the paragraph (a sentence, or eight words
    of it), stored as the number of ones. Their difference estimates by how many
    phrases two documents differ, which gives ``likeness``;
  * the number of phrases.

Everything is DataFrame expressions. Defined results: a null text counts as
empty; the empty text is one empty paragraph without phrases; equal texts (also
both empty) have likeness 1. Repeated rows and repeated ids stay separate rows.
Rows without a doc_id have no place in the order: they have no next document,
their tail is replaced by nothing and near_next is 0. If the next id has several
rows, the smallest head and the smallest fingerprint among them count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import shared_dir, staged, tasks

UNIFORM = 16
SIGNS = 64
LANES = UNIFORM + SIGNS + 1
MODULUS = 1 << 32
NO_ID = -(1 << 63)  # stands for a missing id inside the joins
# Up to seven words that do not end a sentence, then one word of any kind.
PHRASE = r"(?:\S*[^\s.!?]\s+){0,7}\S+"


def _paragraph_rows(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per phrase; the first one of a paragraph carries its hash."""
    paragraphs = df.select(*keys, F.explode(F.split(F.col(text), "\n", -1)).alias("_paragraph"))
    return paragraphs.select(
        *keys, F.xxhash64("_paragraph").alias("_whole"), F.xxhash64(F.lit(11), "_paragraph").alias("_whole2"),
        F.posexplode_outer(F.regexp_extract_all("_paragraph", F.lit(PHRASE), F.lit(0))).alias("_at", "_phrase"),
    ).select(
        *keys, (F.coalesce("_at", F.lit(0)) == 0).alias("_first"), "_whole", "_whole2",
        F.when(F.col("_phrase").isNotNull(), F.xxhash64(F.lit(5), "_phrase")).alias("_sign"),
    )


def lanes_by(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` and the lanes (array of LANES longs) of each group's texts."""
    rows = _paragraph_rows(df, text, keys)
    low = F.lit(MODULUS - 1)
    sums = []
    for i in range(UNIFORM):
        lane = F.xxhash64(F.lit(100 + i), "_whole", "_whole2").bitwiseAND(low)
        sums.append(F.sum(F.when(F.col("_first"), lane).otherwise(F.lit(0))).alias(f"_u{i}"))
    pair = F.lit(0x0000000100000001)  # two sign lanes a sum, 32 bits apart
    for i in range(SIGNS // 2):
        bits = F.shiftrightunsigned(F.col("_sign"), i).bitwiseAND(pair)
        sums.append(F.sum(F.coalesce(bits, F.lit(0))).alias(f"_s{i}"))
    sums.append(F.count("_sign").alias("_n"))
    agg = rows.groupBy(*keys).agg(*sums)
    modulus = F.lit(MODULUS)
    lanes = [F.pmod(F.col(f"_u{i}"), modulus) for i in range(UNIFORM)]
    lanes += [F.col(f"_s{i}").bitwiseAND(low) for i in range(SIGNS // 2)]
    lanes += [F.shiftrightunsigned(F.col(f"_s{i}"), 32) for i in range(SIGNS // 2)]
    lanes += [F.pmod(F.col("_n"), modulus)]
    return agg.select(*keys, F.array(*lanes).alias("lanes"))


def add_lanes(a: Column, b: Column) -> Column:
    """Fingerprint lanes of the union of two multisets of paragraphs."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(MODULUS)))


def subtract_lanes(a: Column, b: Column) -> Column:
    """Fingerprint lanes after the paragraphs of ``b`` are taken out of ``a``."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(MODULUS)))


def to_string(lanes: Column) -> Column:
    """Lanes as eight hexadecimal digits each."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _square(lanes: Column) -> Column:
    """Sum of squares of 2 * ones - phrases over the sign lanes, taken as signed
    numbers modulo 2^32."""
    n = F.element_at(lanes, LANES)

    def centred(ones: Column) -> Column:
        x = F.pmod(F.lit(2) * ones - n, F.lit(MODULUS))
        return F.when(x >= MODULUS // 2, x - MODULUS).otherwise(x).cast("double")

    return F.aggregate(F.slice(lanes, UNIFORM + 1, SIGNS), F.lit(0.0), lambda s, ones: s + centred(ones) * centred(ones))


def likeness(a: Column, b: Column) -> Column:
    """1 - |a - b|^2 / (|a|^2 + |b|^2), held to 0..1: the estimated share of
    phrases that two documents have in common. 1 for equal fingerprints."""
    both = _square(a) + _square(b)
    estimate = F.when(both > 0, 1.0 - _square(subtract_lanes(a, b)) / both).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate)))


def next_ids(ids: DataFrame, column: str) -> DataFrame:
    """(id, next_id) of distinct ids in ascending order; the first follows the last.

    Ids are dealt into ranges (fixed by a checkpoint, since the bounds come from
    a sample); each range is ordered by itself and only the first id of every
    range, one row per range, is ordered globally."""
    spark = ids.sparkSession
    shared_dir(spark)
    dealt = (ids.select(column).where(F.col(column).isNotNull()).distinct()
             .repartitionByRange(tasks(spark), column).withColumn("_range", F.spark_partition_id()).checkpoint())
    within = Window.partitionBy("_range").orderBy(column)
    followed = dealt.withColumn("next_id", F.lead(column).over(within))
    firsts = dealt.groupBy("_range").agg(F.min(column).alias("_first"))
    over = Window.orderBy("_range")
    wrapped = firsts.select("_range", F.coalesce(F.lead("_first").over(over), F.first("_first").over(
        over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_wrap"))
    return followed.join(F.broadcast(wrapped), "_range").select(
        column, F.coalesce("next_id", "_wrap").alias("next_id"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text (the last quarter replaced by
    the head of the next document), with the likeness of both pairs.

    The texts cross the network once, dealt by id; the second use of that
    exchange and all per-document sums need no other. Heads are cut to the
    length they are needed for before they move."""
    # Both joins use the same two columns and a key that is never null, so that
    # they read one exchange.
    docs = df.select(F.coalesce(f"`{id_col}`", F.lit(NO_ID)).alias("_key"),
                     F.coalesce(f"`{text_col}`", F.lit("")).alias("_text"))
    own_id = F.when(F.col("_key") != NO_ID, F.col("_key")).alias("doc_id")
    sizes = (docs.groupBy("_key").agg(F.floor(F.max(F.char_length("_text")) / 4).cast("int").alias("_need"))
             .select(own_id, "_need"))
    links = next_ids(sizes, "doc_id").join(sizes, "doc_id")
    heads = (links.select(F.col("doc_id").alias("_for"), "next_id", "_need")
             .join(docs, F.col("next_id") == F.col("_key"))
             .select("_for", "next_id", F.expr("substring(_text, 1, _need)").alias("_head"))
             .groupBy("_for", "next_id").agg(F.min("_head").alias("_head"))
             .withColumnRenamed("_for", "_key"))
    n = F.char_length("_text")
    kept = n - F.floor(n / 4).cast("int")
    edited = (docs.join(heads, "_key", "left")
              .withColumn("_row", F.monotonically_increasing_id())
              .select("_key", "_row", "next_id", n.cast("long").alias("n_chars"), "_text",
                      F.concat(F.substring("_text", F.lit(1), kept),
                               F.substring(F.coalesce("_head", F.lit("")), F.lit(1), n - kept)).alias("_edited")))
    keys = ["_key", "_row", "next_id", "n_chars"]
    numbered = edited.select(
        *keys, F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        F.posexplode(F.array("_text", "_edited")).alias("_version", "_version_text"))
    sums = lanes_by(numbered, "_version_text", [*keys, "edited_sha256", "_version"])
    paired = sums.groupBy(*keys, "edited_sha256").agg(
        F.first(F.when(F.col("_version") == 0, F.col("lanes")), ignorenulls=True).alias("lanes"),
        F.first(F.when(F.col("_version") == 1, F.col("lanes")), ignorenulls=True).alias("edited_lanes"))
    base = staged(paired, "fingerprints")
    following = base.groupBy(F.col("_key").alias("next_id")).agg(F.min("lanes").alias("_next_lanes"))
    return base.join(following, "next_id", "left").select(
        own_id, "n_chars", "edited_sha256", to_string(F.col("lanes")).alias("fingerprint"),
        to_string(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        F.coalesce(likeness(F.col("lanes"), F.col("_next_lanes")), F.lit(0.0)).alias("near_next"))
