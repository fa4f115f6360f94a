"""Personal data with offset-preserving deobfuscation.

Base patterns run on the source text. A chain of transducers then rewrites
disguises (homoglyphs, zero-width characters, spelled digits, at/dot
spellings) while it records which source characters every output character
came from; the same patterns run on the rewritten text and each match that
touches a rewritten place is mapped back to source offsets.

Defined results: a null text counts as empty and has no spans. Every row is
judged alone, so repeated rows, ties and extra columns pass through untouched;
an empty table gives an empty result. All scans are linear in the text length
(long runs without a match included).
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

SPAN_TYPE = "array<struct<start:int,end:int,kind:string,added:boolean>>"

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
# A run of digits fails or matches as a whole, so later starts inside it need no trial.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str):
    """Leftmost matches: each belongs to one ``@``, so extend left from it."""
    done = 0
    for m in _AT.finditer(text):
        at = m.start()
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain patterns, in order of kind."""
    out = []
    if "@" in text:
        out += [(s, e, "email") for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = re.sub(r"[\x20-]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


# --- transducers -----------------------------------------------------------

# Cyrillic and Greek letters that look like an ASCII letter.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "ο": "o", "ν": "v", "α": "a", "ι": "i", "κ": "k", "ρ": "p", "υ": "u",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-",
}
# Spelled digits.
_SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
            "six": "6", "seven": "7", "eight": "8", "nine": "9", "oh": "0"}


def _homoglyphs() -> dict[int, str]:
    """Look-alikes plus every character whose compatibility form is one ASCII
    letter, digit or mark of an address (full-width, mathematical, ...) and
    every decimal digit of another script."""
    out = {ord(k): v for k, v in _LOOKALIKES.items()}
    for cp in (*range(0x2070, 0x2100), *range(0x2460, 0x2500), *range(0x660, 0x670), *range(0x6F0, 0x6FA),
               *range(0x966, 0x970), *range(0xFE50, 0xFE70), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)):
        ch = chr(cp)
        plain = unicodedata.normalize("NFKC", ch)
        if len(plain) == 1 and not plain.isascii() and unicodedata.decimal(plain, None) is not None:
            plain = str(unicodedata.decimal(plain))
        if len(plain) == 1 and plain.isascii() and (plain.isalnum() or plain in "@.+-_%()"):
            out.setdefault(cp, plain)
    return out


_MAP = _homoglyphs()
# Two searches: a class within the basic plane is one table look-up a character.
_GLYPH = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_MAP) if c < 0x10000) + "]")
_ASTRAL = re.compile(f"[{chr(min(c for c in _MAP if c > 0xFFFF))}-{chr(max(_MAP))}]")
_HIDDEN = re.compile("[­​-‍⁠﻿]")
_WORDS = "|".join(_SPELLED)
# Three or more digits in a row, at least two of them spelled (the others are written by themselves).
_SPELL_ONE = rf"(?:(?:{_WORDS})\b|[0-9](?![0-9]))"
_SPELL_RUN = re.compile(rf"(?i)(?<![0-9])\b{_SPELL_ONE}(?:[ ,-]{{1,2}}{_SPELL_ONE}){{2,}}")
_SPELL_DIGIT = re.compile(rf"(?i)\b(?:{_WORDS})\b|[0-9]")
_SPELL_PART = rf"(?:{_WORDS})(?:\s(?:{_WORDS})){{0,2}}"
_SPELL_IP = re.compile(rf"(?i)\b{_SPELL_PART}(?:\s{{1,3}}dot\s{{1,3}}{_SPELL_PART}){{3}}\b")
_SPELL_WORD = re.compile(rf"(?i)\b(?:{_WORDS})\b")
_PLUS = re.compile(rf"(?i)\bplus\s{{1,3}}(?=[0-9]|(?:{_WORDS})\b)")
_BRACKET = re.compile(r"(?i)\s{0,3}(?:\[\s?(at|dot|@|\.)\s?\]|\(\s?(at|dot|@|\.)\s?\)|\{\s?(at|dot|@|\.)\s?\}|<\s?(at|dot|@|\.)\s?>)\s{0,3}")
_DOT = re.compile(r"(?i)(?<=[A-Za-z0-9])\s{1,3}dot\s{1,3}(?=[A-Za-z0-9])")
# A bare "at" counts before a name whose dot is spelled out; before a dotted name
# only if the word before it is no prose (see ``_addressed``).
_BARE_AT = re.compile(r"(?i)(?<=[a-z0-9])\s{1,3}at\s{1,3}(?=[a-z0-9-]{1,63}(\.[a-z0-9]|\s{1,3}dot\s))")
_INVITED = re.compile(r"(?i)\b(?:e-?mail|mail(?:to)?|contact|write|address)(?:\s+(?:to|is|at))?\s*[:=]?\s*$")
_MARKED = re.compile(r"[A-Za-z0-9][._+-][A-Za-z0-9]")
# Words after an invitation that are no names of mailboxes.
_NO_NAME = frozenset("a an and are at found her here him is it me now or sent stored the them there these this those us you".split())

# What every disguise but a glyph or a hidden character has in it, for lower-cased
# text; each pattern starts with characters that the search can skip to.
_HINTS = tuple(map(re.compile, (
    r"dot(?<!\wdot)(?!\w)", r"plus(?<!\wplus)\s", r"at(?<!\wat)\s{1,3}[a-z0-9-]{1,63}\.[a-z0-9]",
    r"[\[({<]\s?(?:at|@|\.)\s?[\])}>]", rf"(?:{_WORDS})[ ,-]{{1,2}}(?:[0-9]|{_WORDS})")))


def _disguised(text: str) -> bool:
    """Whether a text may hold a disguise (if so, it is rewritten)."""
    low = text.lower()
    if not text.isascii():  # other letters that a case-blind pattern takes for s and i
        low = low.replace("ſ", "s").replace("ı", "i").replace("i̇", "i")
    return any(hint.search(low) for hint in _HINTS)


class Mapped:
    """A rewritten text and, per kept or rewritten piece, where it came from."""

    def __init__(self, text: str):
        self.text = text
        self.starts = [0]            # piece starts in ``text``
        self.origin = [(0, len(text), False)]  # source start, source end, rewritten

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source offsets of text[start:end] and whether a rewritten piece is in it."""
        i, j = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        s, s_end, s_new = self.origin[i]
        lo = s if s_new else s + start - self.starts[i]
        e, e_end, e_new = self.origin[j]
        hi = e_end if e_new else e + end - self.starts[j]
        return lo, hi, any(o[2] for o in self.origin[i:j + 1])

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Apply sorted, disjoint replacements (start, end, new) of ``text``."""
        if not changes:
            return
        parts, starts, origin, at, size = [], [], [], 0, 0

        def keep(lo: int, hi: int) -> None:
            nonlocal size
            i = bisect_right(self.starts, lo) - 1
            while lo < hi:
                stop = min(hi, self.starts[i + 1] if i + 1 < len(self.starts) else len(self.text))
                s, e, new = self.origin[i]
                starts.append(size)
                origin.append((s, e, True) if new else (s + lo - self.starts[i], s + stop - self.starts[i], False))
                size += stop - lo
                lo, i = stop, i + 1

        for lo, hi, new in changes:
            keep(at, lo)
            parts += [self.text[at:lo], new]
            if new:
                s, e, _ = self.source(lo, hi)
                starts.append(size)
                origin.append((s, e, True))
                size += len(new)
            at = hi
        keep(at, len(self.text))
        parts.append(self.text[at:])
        self.text, self.starts, self.origin = "".join(parts), starts or [0], origin or [(0, 0, False)]


def _spelled_ip_changes(text: str) -> list[tuple[int, int, str]]:
    return [(ip.start(), ip.end(), ".".join("".join(_SPELLED[w.lower()] for w in _SPELL_WORD.findall(part))
                                            for part in re.split(r"(?i)\s+dot\s+", ip.group())))
            for ip in _SPELL_IP.finditer(text)]


def _spelled_changes(text: str) -> list[tuple[int, int, str]]:
    out = []
    for run in _SPELL_RUN.finditer(text):
        digits = _SPELL_DIGIT.findall(run.group())
        if sum(len(d) > 1 for d in digits) >= 2:
            out.append((run.start(), run.end(), "".join(_SPELLED.get(d.lower(), d) for d in digits)))
    return out


def _addressed(text: str, lo: int, hi: int) -> bool:
    """Whether text[lo:hi], the word before a bare "at" and a dotted name, is the
    local part of an address: two letters or more and either a mark inside or a
    digit in four characters or more, or any name that follows an invitation
    (``mail john at ...``)."""
    local = text[lo:hi]
    letters = sum(map(str.isalpha, local))
    if letters >= 2 and (_MARKED.search(local) or letters < len(local) >= 4):
        return True
    return letters >= 2 and local.lower() not in _NO_NAME and bool(_INVITED.search(text, max(0, lo - 40), lo))


def _at_changes(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _BARE_AT.finditer(text):
        lo = m.start()
        while lo > 0 and m.start() - lo < 64 and text[lo - 1] in _LOCAL:
            lo -= 1
        if m.group(1)[0] != "." or _addressed(text, lo, m.start()):
            out.append((m.start(), m.end(), "@"))
    return out


def normalise(text: str) -> Mapped | None:
    """The rewritten text with its map, or None where there is no disguise."""
    foreign = not text.isascii()
    glyphs = foreign and (_GLYPH.search(text) or _ASTRAL.search(text))
    hidden = foreign and _HIDDEN.search(text)
    if not (glyphs or hidden or _disguised(text)):
        return None
    m = Mapped(text)
    if hidden:
        m.rewrite([(x.start(), x.end(), "") for x in _HIDDEN.finditer(m.text)])
    if glyphs:
        places = sorted(x.start() for p in (_GLYPH, _ASTRAL) for x in p.finditer(m.text))
        m.rewrite([(i, i + 1, _MAP[ord(m.text[i])]) for i in places if ord(m.text[i]) in _MAP])
    m.rewrite(_spelled_ip_changes(m.text))
    m.rewrite(_spelled_changes(m.text))
    m.rewrite([(x.start(), x.end(), "+") for x in _PLUS.finditer(m.text)])
    m.rewrite([(x.start(), x.end(), "@" if next(filter(None, x.groups())).lower() in ("at", "@") else ".")
               for x in _BRACKET.finditer(m.text)])
    m.rewrite(_at_changes(m.text))
    m.rewrite([(x.start(), x.end(), ".") for x in _DOT.finditer(m.text)])
    return m


def find(text: str | None) -> list[tuple[int, int, str, bool]]:
    """All spans (start, end, kind, added by the method), by start, then kind.

    An added span is one whose normalised form matches, whose source differs
    from that form, and which no base span of the same kind covers."""
    text = text or ""
    base = base_spans(text)
    spans = [(s, e, k, False) for s, e, k in base]
    m = normalise(text)
    if m is not None and m.text != text:
        for s, e, kind in base_spans(m.text):
            lo, hi, _ = m.source(s, e)
            if text[lo:hi] != m.text[s:e] and not any(b <= lo and hi <= f for b, f, k in base if k == kind):
                spans.append((lo, hi, kind, True))
    spans.sort(key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return spans


def redact(text: str | None, spans: list[tuple[int, int, str, bool]]) -> str | None:
    """Replace spans by ``<KIND>``; overlapping spans become one mark."""
    if not text or not spans:
        return text
    out, at = [], 0
    end, mark = -1, ""
    for s, e, kind, _ in spans:
        if s < end:
            end = max(end, e)
            continue
        if end >= 0:
            out.append(mark)
            at = end
        out.append(text[at:s])
        end, mark = e, f"<{kind.upper()}>"
    return "".join(out) + mark + text[end:]


def _find_udf():
    @F.pandas_udf(SPAN_TYPE)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": s, "end": e, "kind": k, "added": a} for s, e, k, a in find(t)] for t in texts],
                         dtype=object)
    return run


def pii_spans(text: Column) -> Column:
    """Column of all spans of a text column: array of (start, end, kind, added)."""
    return _find_udf()(text)


def redact_pii(df: DataFrame, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """Replace every span in ``text_col``; ``count_col``, if given, gets the new
    number of characters. Null texts stay null."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, find(t)) if t is not None else None for t in texts], dtype=object)

    new = {text_col: run(F.col(f"`{text_col}`"))}
    out = df.withColumns(new)
    return out.withColumn(count_col, F.char_length(F.col(f"`{text_col}`")).cast(df.schema[count_col].dataType)) \
        if count_col else out


def pii_digest(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Per document: counts of the base spans by kind, digest of the base spans,
    the list of all spans (base and added) and the counts of added and of all."""
    def line(only_base: bool) -> Column:
        spans = F.filter("pii", lambda s: ~s["added"]) if only_base else F.col("pii")
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: (s["kind"] == kind) & ~s["added"])).cast("long")

    found = df.select("doc_id", pii_spans(F.col(f"`{text_col}`")).alias("pii"))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(line(True).cast("binary"), 256).alias("base_sha256"),
        line(False).alias("spans"),
        F.size(F.filter("pii", lambda s: s["added"])).cast("long").alias("n_added"),
        F.size("pii").cast("long").alias("n_spans"),
    )
