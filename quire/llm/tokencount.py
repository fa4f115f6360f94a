"""Token counts: batches encoded in Arrow functions that return lengths only.

A worker takes the texts of an Arrow batch, cuts texts longer than PIECE_CHARS at
safe boundaries and deals the pieces out to batches of about BATCH_BYTES bytes. A batch
is split at all its safe boundaries; the parts whose counts the worker does not
remember are encoded at once, each a single time, and a piece's count is the sum of its
parts'. Ids never leave the worker and no more than one batch of encodings exists at a
time.

A boundary is safe where the pre-tokeniser cuts whatever stands around it, so that
the counts of the pieces add up to the count of the whole text:
  * between a character that is no white space and an ASCII blank, tab or newline
    (no pre-token has white space after anything else);
  * where a long stretch has no such place, between a letter of a long settled
    alphabet and a full stop, comma or the like (letters and marks never share a
    pre-token; the apostrophe, which may, is left out).
No boundary lies inside an added token, since characters of added tokens never count
as the right side of one. Texts are encoded whole if the tokenizer's own settings
do not warrant this (another pre-tokeniser, a normaliser, added tokens that strip
white space), and a stretch without any safe boundary stays whole at any length.

Defined results: a null text counts as empty and has no tokens; strings of special
tokens inside a text count as the library counts them (one token each). Rows are
judged alone: ties, repeated rows and null ids pass through, an empty table gives an
empty result, columns beyond doc_id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 16
BATCH_BYTES = 1 << 18

# Letters and digits that every Unicode version of the last decades has as such.
_SETTLED = "A-Za-z0-9À-ÖØ-öА-яぁ-ゖァ-ヺ一-龥가-힣"
_BLANKS = " \n\t"
_MARKS = ",.;:!?、。，！？"
_SPACE = r"\s\x1c-\x1f\u180e"

CACHE_ENTRIES = 250_000  # parts in each of the two generations a Python worker remembers
CACHE_CHARS = 64         # longer parts are not remembered


def boundary_sides(spec: dict) -> tuple[str, str]:
    """The blanks and the marks that may stand behind a safe boundary of the
    tokenizer described by its JSON form; none if no place is known to be safe."""
    before = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not level or spec.get("normalizer") or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        return "", ""
    used = set("".join(t["content"] for t in added))
    blanks, marks = ("".join(c for c in chars if c not in used) for chars in (_BLANKS, _MARKS))
    return blanks, marks


def safe_boundary(spec: dict) -> re.Pattern | None:
    """Pattern whose matches end one character behind a safe boundary."""
    blanks, marks = boundary_sides(spec)
    ways = []
    if blanks:
        ways.append(rf"[^{_SPACE}][{re.escape(blanks)}]")
    if marks:
        ways.append(f"[{_SETTLED}][{re.escape(marks)}]")
    return re.compile("|".join(ways)) if ways else None


def part_pattern(spec: dict) -> re.Pattern | None:
    """Pattern whose matches are the parts of a text from each safe boundary to the next."""
    blanks, marks = boundary_sides(spec)
    inside = []
    if blanks:
        inside.append(rf"(?<=[{_SPACE}])[{re.escape(blanks)}]")
    if marks:
        inside.append(f"(?<![{_SETTLED}])[{re.escape(marks)}]")
    plain = f"[^{re.escape(blanks + marks)}]*+"
    return re.compile(f"(?s:.){plain}(?:(?:{'|'.join(inside)}){plain})*+") if inside else None


def cut(text: str, boundary: re.Pattern | None, size: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of at least ``size`` characters (but for the last),
    cut at the first safe boundary from there on."""
    if boundary is None or len(text) <= size:
        return [text]
    out, at = [], 0
    while len(text) - at > size and (m := boundary.search(text, at + size - 1)):
        out.append(text[at:m.end() - 1])
        at = m.end() - 1
    return [*out, text[at:]]


def balanced(pieces: list[tuple[int, str]], limit: int = BATCH_BYTES):
    """Batches of consecutive (row, piece) of about ``limit`` bytes each; a piece
    above the limit is a batch of its own."""
    batch, held = [], 0
    for row, piece in pieces:
        n = len(piece) if piece.isascii() else len(piece.encode("utf-8", "surrogatepass"))
        if batch and held + n > limit:
            yield batch
            batch, held = [], 0
        batch.append((row, piece))
        held += n
    if batch:
        yield batch


class Counter:
    """One worker's tokenizer and a bounded memory of the counts of parts.

    The memory has two generations, each of ``CACHE_ENTRIES`` parts and those of one
    batch at most. A part found in the older one is copied to the younger; when the
    younger is full, it becomes the older and what was not used since is forgotten."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.boundary = safe_boundary(json.loads(spec))
        self.part = part_pattern(json.loads(spec))
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def encoded(self, texts: list[str]) -> list[int]:
        """The library's count of each text."""
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _recall(self, parts: set[str]) -> list[str]:
        """Put the counts of all of ``parts`` into the younger generation; returns
        those that are too long to stay there."""
        if len(self.known) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        missing = parts.difference(self.known)
        if self.older:
            again = self.older.keys() & missing
            self.known.update([(p, self.older[p]) for p in again])
            missing -= again
        new = list(missing)
        self.known.update(zip(new, self.encoded(new), strict=True))
        return [p for p in new if len(p) > CACHE_CHARS]

    def by_parts(self, pieces: list[str]) -> list[int]:
        """The same counts as ``encoded``, each distinct part encoded once."""
        if self.part is None:
            return self.encoded(pieces)
        split = [self.part.findall(p) for p in pieces]
        passing = self._recall(set().union(*split))
        out = [sum(map(self.known.__getitem__, parts)) for parts in split]
        for p in passing:
            del self.known[p]
        return out

    def counts(self, texts: list[str | None], size: int = PIECE_CHARS, limit: int = BATCH_BYTES) -> list[int]:
        out = [0] * len(texts)
        pieces = ((i, p) for i, t in enumerate(texts) if t for p in cut(t, self.boundary, size))
        for batch in balanced(pieces, limit):
            for (i, _), n in zip(batch, self.by_parts([p for _, p in batch]), strict=True):
                out[i] += n
        return out


_counters: dict[str, Counter] = {}


class TokenCounter:
    """Column function for the tokenizer of one JSON file. The file (a few MB,
    fixed by the vocabulary) is read where the job is planned and broadcast; a worker
    builds its tokenizer once."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self._shared = spark.sparkContext.broadcast(spec)
        self._key = hashlib.sha256(spec.encode()).hexdigest()

    def count(self, text: Column) -> Column:
        """Number of tokens (long), 0 for null."""
        shared, key = self._shared, self._key

        @F.arrow_udf("long")
        def run(texts: pa.Array) -> pa.Array:
            if key not in _counters:
                _counters.clear()
                _counters[key] = Counter(shared.value)
            return pa.array(_counters[key].counts(texts.to_pylist()), pa.int64())

        return run(text)


def token_counts(df: DataFrame, counter: TokenCounter, limit: int = 1024) -> DataFrame:
    """Per row of ``df``: doc_id, bytes and tokens of the whole text and whether the
    tokens are more than ``limit``."""
    counted = df.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                        counter.count(F.col("text")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
