"""Byte-level BPE through a sentencepiece model written from the vocabulary.

Every token's bytes become printable characters (one per byte), every piece's
score is its negative rank, the normaliser is the identity. sentencepiece then
merges the pair with the best score, leftmost first, which is the rank order.
Texts are split by the pre-token pattern and each pre-token is encoded by
itself; decoding maps ids back to bytes.

Defined results: null and empty texts have no ids and decode to no bytes; rows
are independent (repeated rows, extra columns and empty tables need no care).
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE_ENTRIES = 250_000  # pre-tokens in each of the two generations a Python worker remembers
CACHE_CHARS = 64         # longer pre-tokens are not remembered
CHUNK_CHARS = 1 << 20    # texts are encoded together up to about this many characters
DIGEST_TYPE = "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>"


def byte_alphabet() -> str:
    """Character that stands for each byte: printable Latin-1 characters stand
    for themselves, the others take the characters from U+0100 on."""
    spare = iter(range(0x100, 0x200))
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return "".join(chr(b) if b in plain else chr(next(spare)) for b in range(256))


def load_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order from a rank file (base64 token, rank per line)."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0..n-1 without gaps")
    return [ranks[r] for r in range(len(ranks))]


def _varint(x: int) -> bytes:
    x &= (1 << 64) - 1
    out = bytearray()
    while x > 127:
        out.append(x & 127 | 128)
        x >>= 7
    return bytes([*out, x])


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def _float_field(number: int, value: float) -> bytes:
    return _varint(number << 3 | 5) + struct.pack("<f", value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """sentencepiece ModelProto: pieces (1), trainer spec (2), normaliser (3).
    Piece ids equal ranks; the unknown piece comes last."""
    alphabet = byte_alphabet()
    pieces = [_bytes_field(1, _bytes_field(1, "".join(alphabet[b] for b in token).encode())
                           + _float_field(2, -float(rank))) for rank, token in enumerate(tokens)]
    unknown = _bytes_field(1, _bytes_field(1, b"<unk>") + _float_field(2, 0.0) + _int_field(3, 2))
    trainer = (_int_field(3, 2) + _int_field(4, len(tokens) + 1) + _int_field(40, len(tokens))
               + _int_field(41, -1) + _int_field(42, -1) + _int_field(43, -1))
    identity = _bytes_field(1, b"identity") + _int_field(3, 0) + _int_field(4, 0) + _int_field(5, 0)
    return b"".join(pieces) + unknown + _bytes_field(2, trainer) + _bytes_field(3, identity)


class Codec:
    """One worker's encoder: model, pre-token pattern and a bounded memory.

    The memory has two generations, each of ``CACHE_ENTRIES`` pre-tokens and those
    of one chunk at most. A pre-token found in the older one is copied to the
    younger; when the younger is full, it becomes the older and what was not used
    since is forgotten. Frequent
    pre-tokens therefore stay however many rare ones pass by."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.tokens, self.pattern = tokens, regex.compile(pattern)
        self.exact = {t: struct.pack("<I", i) for i, t in enumerate(tokens)}
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.alphabet = byte_alphabet()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd, self.strict = _unicode_gap(pattern)
        self.ascii = _ascii_form(pattern)

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        if self.odd and not self.odd.isdisjoint(text):
            return self.strict.findall(text)
        return self.pattern.findall(text)

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of pre-tokens: a token of the vocabulary is itself, the
        others go through the model."""
        out, rest, pieces = {}, [], []
        for w in words:
            raw = w.encode("utf-8", "surrogatepass")
            if raw in self.exact:
                out[w] = self.exact[raw]
            else:
                rest.append(w)
                pieces.append(raw.decode("latin-1").translate(self.alphabet))
        if rest:
            for w, ids in zip(rest, self.sp.encode(pieces, num_threads=1), strict=True):
                out[w] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _recall(self, words: set[str]) -> list[str]:
        """Put the packed ids of all of ``words`` into the younger generation;
        returns those that are too long to stay there."""
        if len(self.known) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        missing = words.difference(self.known)
        if self.older:
            again = self.older.keys() & missing
            self.known.update([(w, self.older[w]) for w in again])
            missing -= again
        self.known.update(self._learn(missing))
        return [w for w in missing if len(w) > CACHE_CHARS]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Texts are
        taken together up to CHUNK_CHARS, so that new pre-tokens reach the model
        in few calls."""
        out, chunk, held = [], [], 0
        for text in [*texts, None]:
            if chunk and (text is None or held + len(text) > CHUNK_CHARS):
                split = [self.split(t) for t in chunk]
                passing = self._recall(set().union(*split))
                out += [b"".join(map(self.known.__getitem__, words)) for words in split]
                for w in passing:
                    del self.known[w]
                chunk, held = [], 0
            if text is not None:
                chunk.append(text)
                held += len(text)
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_many([text])[0] if text else b""

    def decode(self, ids: bytes | None) -> bytes:
        if not ids:
            return b""
        return b"".join(map(self.tokens.__getitem__, memoryview(bytes(ids)).cast("I")))


def _ascii_form(pattern: str):
    """The pattern with letters and numbers as the ASCII ones, which is the same
    on ASCII texts and much faster; the pattern itself if it uses other classes."""
    import regex

    out, inside = [], False
    for part in re.findall(r"\\[pP]\{\^?\w+\}|\\.|.", pattern, re.DOTALL):
        inside = part == "[" or inside and part != "]"
        plain = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}.get(part)
        out.append(part if plain is None else plain if inside else f"[{plain}]")
    form = "".join(out)
    if re.search(r"\\[pPwWbBdDX]|\(\?|\[\[|[&|~-]{2}", form.replace("(?!", "")):
        return regex.compile(pattern)
    return re.compile(form, re.ASCII)


def _unicode_gap(pattern: str):
    """Letters and numbers that the pattern library knows and tiktoken's does
    not, or the reverse (their Unicode versions differ), and the pattern with
    exactly tiktoken's classes (None if there are no such characters)."""
    import regex
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    gap, classes = set(), {}
    for name in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(probe.decode(probe.encode_ordinary(every)))
        ours = set(regex.findall(name, every))
        gap |= theirs ^ ours
        less, more = ("".join(map(regex.escape, sorted(x))) for x in (ours - theirs, theirs - ours))
        inner = f"[{name}--[{less}]]" if less else name
        classes[name] = f"[{inner}||[{more}]]" if more else inner
    if not gap:
        return frozenset(), None
    strict = pattern
    for name, exact in classes.items():
        strict = strict.replace(name, exact)
    return frozenset(gap), regex.compile(strict, regex.V1)


_codecs: dict[str, Codec] = {}


def _codec(key: str, shared) -> Codec:
    """This worker's codec: built once per process, not once per task."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(*shared.value)
    return _codecs[key]


class Tokenizer:
    """``encode`` and ``decode`` column functions for one rank file.

    The rank file is read where the job is planned; the token list and the
    model (about 1 MB each for 50,000 tokens, fixed by the vocabulary) are
    broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        tokens = load_ranks(path)
        model = serialise_model(tokens)
        self._shared = spark.sparkContext.broadcast((tokens, model, pattern))
        self._key = hashlib.sha256(model + pattern.encode()).hexdigest()

    def _function(self, apply, result: str):
        """Column function from a codec method over the values of a batch."""
        shared, key = self._shared, self._key

        @F.pandas_udf(result)
        def run(column: pd.Series) -> pd.Series:
            return pd.Series(apply(_codec(key, shared), column), dtype=object)

        return run

    def encode(self, text: Column) -> Column:
        """Ids packed as little-endian unsigned 32-bit integers (binary)."""
        return self._function(lambda c, texts: c.encode_many([t or "" for t in texts]), "binary")(text)

    def decode(self, ids: Column) -> Column:
        """Bytes of packed ids (binary)."""
        return self._function(lambda c, ids: [c.decode(i) for i in ids], "binary")(ids)

    def digest(self, text: Column) -> Column:
        """Number of tokens, digest of the packed ids and digest of the bytes that
        the ids decode to; the ids themselves stay in the worker."""
        shared, key = self._shared, self._key

        @F.pandas_udf(DIGEST_TYPE)
        def run(column: pd.Series) -> pd.DataFrame:
            c = _codec(key, shared)
            ids = c.encode_many([t or "" for t in column])
            return pd.DataFrame({
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(c.decode(i)).hexdigest() for i in ids],
            })

        return run(text)


def encode_documents(df: DataFrame, tokenizer: Tokenizer, text_col: str = "text", out: str = "ids") -> DataFrame:
    return df.withColumn(out, tokenizer.encode(F.col(f"`{text_col}`")))


def bpe_digest(df: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Per document: number of tokens, digest of the ids, digest of the decoded bytes."""
    return df.select("doc_id", tokenizer.digest(F.col("text")).alias("digest")).select(
        "doc_id", F.col("digest.n_tokens").alias("n_tokens"), F.col("digest.ids_sha256").alias("ids_sha256"),
        F.col("digest.decoded_sha256").alias("decoded_sha256"))
