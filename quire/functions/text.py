"""Row-local text functions (Column -> Column).

Everything here is a composition of built-in Spark SQL functions, so it stays
inside whole-stage codegen and works the same on batch and streaming inputs.
The regular-expression texts are written so that the same pattern also runs
in RE2 (DuckDB), which the oracle queries rely on.
"""

from __future__ import annotations

import html.entities
import json
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Character classes
# ---------------------------------------------------------------------------

def _ranges(codes: list[int]) -> str:
    out, start, prev = [], None, None
    for c in codes:
        if start is None:
            start = prev = c
        elif c == prev + 1:
            prev = c
        else:
            out.append((start, prev))
            start = prev = c
    if start is not None:
        out.append((start, prev))
    fmt = lambda c: f"\\x{{{c:x}}}"
    return "".join(fmt(a) if a == b else f"{fmt(a)}-{fmt(b)}" for a, b in out)


def _digit_like_class() -> str:
    """Characters for which Python's str.isdigit() holds: decimal digits
    (\\p{Nd}) plus superscripts, circled digits, ... The extra characters are
    generated from the Unicode database instead of being listed by hand."""
    codes = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit() and not chr(c).isdecimal()]
    return r"[\p{Nd}" + _ranges(codes) + "]"


def _space_codes() -> list[int]:
    return [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]


# Python's str.isspace() set. Java's \s is ASCII only and RE2's \s lacks \x0b,
# so neither engine's \s can be used; the class is spelled out instead.
WS_CHARS = "".join(chr(c) for c in _space_codes())
WS = "[" + _ranges(_space_codes()) + "]"
DIGITLIKE = _digit_like_class()
DIGIT = r"\p{Nd}"  # Python's \d for str patterns (category Nd)
SPACES = " " * len(WS_CHARS)

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Heading words tested by the heading-like predicate (substring, any case).
HEADING_WORDS = ["chapter", "part", "section", "introduction", "conclusion"]

# Heading line rules, in the reference's order; matched on the stripped,
# lower-cased line, anchored at its start, case-insensitive.
HEADING_RULES = [
    ("chapter", rf"^chapter{WS}+{DIGIT}+"),
    ("ch.", rf"^ch\.{WS}*{DIGIT}+"),
    ("n.", rf"^{DIGIT}+\.{WS}+[a-zA-Z]"),
    ("part", rf"^part{WS}+{DIGIT}+"),
    ("section", rf"^section{WS}+{DIGIT}+"),
    ("n word", rf"^{DIGIT}+{WS}+[a-zA-Z][a-zA-Z]+"),
]

# Characters replaced by '_' in export file names.
UNSAFE_FILENAME_CHARS = '<>:"/\\|?*'

# Named character references decoded in HTML text: the standard HTML5 table
# (from the Python standard library), references written with a ';'.
HTML_ENTITIES = {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}
# References resolved without a table lookup (the most frequent in text).
COMMON_ENTITIES = ["amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "middot", "reg", "trade", "mdash",
                   "ndash", "hellip", "lsquo", "rsquo", "ldquo", "rdquo", "laquo", "raquo", "bull", "euro"]

# ---------------------------------------------------------------------------
# Basic string helpers
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    if isinstance(x, str):
        return F.col(x)
    return x if isinstance(x, Column) else F.lit(x)


def once(*named: Column) -> Column:
    """Evaluate expensive expressions once per row. Use in ``select``: the
    generator's outputs are fresh attributes, so later filters on them are
    not pushed below it (which would re-run the expressions)."""
    return F.inline(F.array(F.struct(*named)))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.try_element_at(F.transform(F.array(value), use), F.lit(1))


def strip(col) -> Column:
    """Python ``str.strip()``: trims every Unicode white-space character
    (Spark's ``trim`` only removes spaces)."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def spaces_only(col) -> Column:
    """Map every white-space character to ' ' (a per-character table lookup,
    much cheaper than a long regex character class)."""
    return F.translate(_c(col), WS_CHARS, SPACES)


def word_count(col) -> Column:
    """Number of white-space separated tokens (``len(s.split())``); 0 for
    blank text. White space is mapped to ' ' first, then runs of other
    characters are counted; no array is built."""
    return F.coalesce(F.regexp_count(spaces_only(col), F.lit("[^ ]+")), F.lit(0))


def preview(col, n: int) -> Column:
    """First ``n`` characters plus '...' only when the text is longer."""
    c = _c(col)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def safe_filename(col) -> Column:
    """Unsafe characters to '_', strip, spaces to '_', first 100 chars."""
    c = F.translate(_c(col), UNSAFE_FILENAME_CHARS, "_" * len(UNSAFE_FILENAME_CHARS))
    c = F.replace(strip(c), F.lit(" "), F.lit("_"))
    return F.substring(c, 1, 100)


def thousands(col) -> Column:
    """Integer with thousands separators (Python ``f'{n:,}'``)."""
    return F.format_number(_c(col).cast("long"), 0)


def file_name_of(path) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def file_suffix(path) -> Column:
    """``Path.suffix``: last dot segment of the file name; '' when the name
    starts with its only dot or ends with a dot."""
    return F.regexp_extract(file_name_of(path), r"^.+(\.[^.]+)$", 1)


def file_stem(path) -> Column:
    """``Path.stem``: file name without its suffix."""
    return F.regexp_replace(file_name_of(path), r"^(.+)\.[^.]+$", "$1")


# ---------------------------------------------------------------------------
# Book metadata
# ---------------------------------------------------------------------------


def book_title_spine(titles) -> Column:
    """First DC title, else 'Unknown Title'."""
    t = _c(titles)
    return F.when(F.size(t) > 0, F.try_element_at(t, F.lit(1))).otherwise(F.lit("Unknown Title"))


def book_title_paged(title, path) -> Column:
    """T4: metadata title when non-empty, else the file stem with '_' and '-'
    turned into spaces."""
    return F.coalesce(F.nullif(_c(title), F.lit("")), F.translate(file_stem(path), "_-", "  "))


def book_author(first_author) -> Column:
    """T5: first creator / non-empty author, else 'Unknown Author'."""
    return F.coalesce(F.nullif(_c(first_author), F.lit("")), F.lit("Unknown Author"))


# ---------------------------------------------------------------------------
# HTML (T1, T2)
# ---------------------------------------------------------------------------

_REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)"
# Older names that also count without ';', the longest first.
_BARE = sorted((k for k in html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
_BARE_REFERENCE = "^(?:" + "|".join(_BARE) + ")"
# What the numbers 128 to 159 stand for: Windows-1252, where it has a character.
_LOW_CONTROLS = [bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)]


def _codepoint(n: Column) -> Column:
    # chr(n) wraps at 256, so build the character from its UTF-32 bytes.
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def decode_entities(col) -> Column:
    """Decode character references in one text node, in a single left-to-right
    pass (so '&amp;lt;' becomes '&lt;', as a real HTML parser does)."""
    c = _c(col)
    # One constant map (a JSON literal folded at planning time).
    emap = F.from_json(F.lit(json.dumps(HTML_ENTITIES)), "map<string,string>")

    def split_piece(p: Column, i: Column) -> Column:
        # The reference is extracted once per piece.
        return F.struct(p.alias("p"), i.alias("i"), F.regexp_extract(p, _REFERENCE, 0).alias("ref"))

    def piece(x: Column) -> Column:
        p, i, ref = x["p"], x["i"], x["ref"]
        name = F.rtrim(ref, F.lit(";"))
        # Frequent references are resolved directly; the full table (a
        # linear lookup) is only consulted for the rest.
        common = F.when(name == "amp", F.lit("&"))
        for k in COMMON_ENTITIES[1:]:
            common = common.when(name == k, F.lit(HTML_ENTITIES[k]))
        rest = F.substring(p, F.length(ref) + 1, F.lit(1 << 30))
        num = F.when(
            name.startswith("#x") | name.startswith("#X"),
            F.conv(F.substring(name, 3, 16), 16, 10).try_cast("long"),
        ).when(name.startswith("#"), F.substring(name, 2, 16).try_cast("long"))
        value = F.when(
            name.startswith("#"),
            F.when(num.between(128, 159), F.get(F.array(*[F.lit(c) for c in _LOW_CONTROLS]), (num - 128).cast("int")))
            .when((num > 0) & (num <= 0x10FFFF) & ~num.between(0xD800, 0xDFFF), _codepoint(num))
            .otherwise(F.lit("\ufffd")),
        ).otherwise(common.otherwise(F.try_element_at(emap, name)))
        decoded = F.when((ref != "") & value.isNotNull(), F.concat(value, rest))
        # Older names begin with a letter and matter only where nothing else was decoded.
        bare = F.when(decoded.isNull() & p.rlike("^[A-Za-z]{2}"), F.regexp_extract(p, _BARE_REFERENCE, 0)).otherwise("")
        older = F.when(bare != "", F.concat(F.try_element_at(emap, bare), F.substring(p, F.length(bare) + 1, F.lit(1 << 30))))
        return F.when(i == 0, p).otherwise(F.coalesce(decoded, older, F.concat(F.lit("&"), p)))

    pieces = F.transform(F.split(c, "&", -1), split_piece)
    return F.when(c.contains("&"), F.array_join(F.transform(pieces, piece), "")).otherwise(c)


# One token of HTML. Comments and the elements whose content is no text run to their end
# or, unclosed, to the end of the document; a tag may hold '>' inside quoted attribute
# values; everything up to the next '<' is text. A '<' that begins no tag is text too.
_RAW_ELEMENTS = ("script", "style", "template")
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    + "".join(rf"|<{e}\b{_ATTRIBUTES}>.*?(?:</{e}\s*>|\z)" for e in _RAW_ELEMENTS)
    + rf"|</?[a-z]{_ATTRIBUTES}>|<[a-z/!?][^>]*+>|[^<]++|<[^<]*+"
)
_MARKUP = r"(?is)^<(?:!--|(?:" + "|".join(_RAW_ELEMENTS) + r")\b|[a-z/!?][^>]*+.*>$)"


def html_tokens(col) -> Column:
    """The document as an array of tokens, from left to right, by one scan."""
    return F.regexp_extract_all(_c(col), F.lit(_TOKEN), 0)


def _is_text(token: Column) -> Column:
    return ~token.startswith("<") | ~token.rlike(_MARKUP)


def tokens_text(tokens) -> Column:
    """T1 over tokens: each text token stripped, empty ones dropped, joined by one space."""
    nodes = F.transform(F.filter(_c(tokens), _is_text), lambda n: strip(decode_entities(n)))
    return F.array_join(F.filter(nodes, lambda n: n != ""), " ")


def _inner(tokens: Column, names: Column, tag: str) -> Column:
    """Tokens between the first start tag ``tag`` and the first end tag after it; null
    without such an element."""
    start = F.array_position(names, tag)
    length = F.array_position(F.slice(names, start + 1, F.greatest(F.size(names), F.lit(1))), f"/{tag}") - 1
    return F.when((start > 0) & (length >= 0), F.slice(tokens, start + 1, F.greatest(length, F.lit(0))))


def tokens_title(tokens) -> Column:
    """T2 without the fallback, over tokens: struct(title, source) where source is one of
    title / h1 / h2 / h3 and title is null when none applies. Elements inside comments,
    scripts, styles and templates are no tokens, hence do not count."""
    def of(t: Column) -> Column:
        names = F.transform(t, lambda x: F.when(x.startswith("<"), F.lower(F.regexp_extract(x, r"(?i)^<(/?(?:title|h[123]))\b", 1))).otherwise(""))

        def raw(n: Column) -> Column:
            title = _inner(t, n, "title")
            # <title> counts only when it holds exactly one non-empty string; a
            # white-space-only title is returned as '' (truthy before the strip).
            one = (F.size(title) == 1) & ~F.element_at(title, 1).startswith("<")
            found = [F.when(one, F.struct(F.element_at(title, 1).alias("raw"), F.lit("title").alias("source")))]
            for tag in ("h1", "h2", "h3"):
                # Text nodes stay apart, so that no reference is read across a tag.
                text = F.array_join(F.filter(_inner(t, n, tag), _is_text), "\0")
                found.append(F.when(text.isNotNull(), F.struct(text.alias("raw"), F.lit(tag).alias("source"))))
            return F.array_compact(F.array(*found))

        return let(names, raw)

    decoded = F.transform(let(_c(tokens), of), lambda c: F.struct(
        strip(F.replace(decode_entities(c["raw"]), F.lit("\0"), F.lit(""))).alias("title"), c["source"].alias("source")))
    none = F.struct(F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("source"))
    return F.coalesce(F.try_element_at(F.filter(decoded, lambda c: (c["source"] == "title") | (c["title"] != "")), F.lit(1)), none)


def html_text(col) -> Column:
    """Text nodes of an HTML document, each stripped, empty ones dropped,
    joined by one space (``get_text(strip=True, separator=' ')``)."""
    return tokens_text(html_tokens(col))


def title_parts(col) -> Column:
    """T2 without the fallback (see ``tokens_title``)."""
    return tokens_title(html_tokens(col))


def html_parts(col) -> Column:
    """T1 and T2 from one scan: struct(text, title), the title as in ``tokens_title``."""
    return let(html_tokens(col), lambda t: F.struct(tokens_text(t).alias("text"), tokens_title(t).alias("title")))


def chapter_title(html, number) -> Column:
    """<title> if it holds one non-empty string, else first non-empty
    h1, h2, h3, else 'Chapter {n}'."""
    t = title_parts(html)
    return F.coalesce(t["title"], F.concat(F.lit("Chapter "), _c(number).cast("string")))


# ---------------------------------------------------------------------------
# Lines of paged text
# ---------------------------------------------------------------------------


def clean_line(col) -> Column:
    """L2: runs of spaces to one space, then strip."""
    return strip(F.regexp_replace(_c(col), " +", " "))


def noise_rule(clean) -> Column:
    """L3: first header/footer rule a cleaned line fails, or null if kept."""
    c = _c(clean)
    return (
        F.when(F.length(c) < 5, F.lit("short"))
        .when(c.rlike(f"^{DIGIT}+$"), F.lit("digits"))
        .when(F.lower(c).rlike(f"^page {DIGIT}+"), F.lit("page_number"))
        .when(c.rlike(f"^{DIGITLIKE}+$"), F.lit("digit_like"))
    )


def is_title_case(col) -> Column:
    """Python ``str.istitle()``."""
    c = _c(col)
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]"
    return (
        c.rlike(r"[\p{Lu}\p{Lt}\p{Ll}]")
        & ~c.rlike(r"(?:^|[^\p{Lu}\p{Ll}\p{Lt}])\p{Ll}")
        & ~c.rlike(cased + r"[\p{Lu}\p{Lt}]")
    )


def heading_like(col) -> Column:
    """Heading-like text (expects stripped text)."""
    c = _c(col)
    low = F.lower(c)
    words = None
    for w in HEADING_WORDS:
        words = low.contains(w) if words is None else (words | low.contains(w))
    numbered = c.rlike(f"^{DIGIT}+\\.?{WS}+[A-Z]")
    titled = is_title_case(c) & F.length(c).between(10, 100) & (word_count(c) <= 8)
    return words | numbered | titled


# Every heading rule starts with one of these; lines that do not are skipped
# without running the rules.
HEADING_PREFIX = rf"^(?:ch|part|section|{DIGIT})"


def heading_rule(line) -> Column:
    """Id of the first heading pattern the raw line matches, or null."""
    low = F.lower(strip(_c(line)))
    out = None
    for rule_id, pat in HEADING_RULES:
        out = F.when(low.rlike(pat), F.lit(rule_id)) if out is None else out.when(low.rlike(pat), F.lit(rule_id))
    return F.when(low.rlike(HEADING_PREFIX), out)
