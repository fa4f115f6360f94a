"""Row-local functions for model replies.

A reply is untrusted text that should hold a JSON object ``{"cards": [...]}``.
Parsing uses Spark's VARIANT type; every check is a built-in expression over
one reply row, so a reply never needs a shuffle or a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import WS, let, once, strip

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# First fenced block, with or without a 'json' tag; dot matches newline.
FENCE_PATTERN = r"(?s)```(?:json)?" + WS + r"*\n?(.*?)\n?```"
# Greedy object: from the first '{' to the last '}'.
OBJECT_PATTERN = r"(?s)\{.*\}"
REQUIRED_KEYS = ["front", "back", "card_type"]
# Numbers that lenient JSON readers take and strict ones refuse, standing by themselves.
NON_FINITE = r"(?<![\w.+-])(?:NaN|-?Infinity)(?![\w.+-])"

# Not allowed anywhere in JSON, so they can stand for escapes while a text is split.
BACKSLASH_MARK, QUOTE_MARK = "\x01", "\x02"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reply_text(final_output, items, messages, content) -> Column:
    """Text of a model run. Final output when non-empty; else, when there
    are items, the last item whose first text is non-empty; else the last
    message; else the content. Branches are exclusive; '' counts as none."""
    fo, it, ms, ct = _c(final_output), _c(items), _c(messages), _c(content)
    with_text = F.filter(F.reverse(it), lambda x: (F.size(x) > 0) & (F.try_element_at(x, F.lit(1)) != ""))
    from_items = F.try_element_at(F.try_element_at(with_text, F.lit(1)), F.lit(1))
    out = (
        F.when(fo.isNotNull() & (fo != ""), fo)
        .when(it.isNotNull() & (F.size(it) > 0), from_items)
        .when(ms.isNotNull() & (F.size(ms) > 0), F.try_element_at(ms, F.lit(-1)))
        .otherwise(ct)
    )
    return F.nullif(out, F.lit(""))


def fenced_block(text) -> Column:
    """Stripped content of the first fenced block, null when none."""
    t = _c(text)
    return F.when(t.rlike(FENCE_PATTERN), strip(F.regexp_extract(t, FENCE_PATTERN, 1)))


def finite_numbers(s: Column) -> Column:
    """JSON text with every NaN or Infinity outside strings written as 0.5: like them a number that
    is no integer, no text and no list, so all checks of a card come out the same. Escapes are
    masked first; the pieces between quotes are then inside and outside strings by turns."""
    masked = F.replace(F.replace(s, F.lit("\\\\"), F.lit(BACKSLASH_MARK)), F.lit('\\"'), F.lit(QUOTE_MARK))
    pieces = F.transform(F.split(masked, '"', -1), lambda x, i: F.when(
        i % 2 == 0, F.regexp_replace(x, NON_FINITE, "0.5")).otherwise(x))
    joined = F.array_join(pieces, '"')
    return F.replace(F.replace(joined, F.lit(QUOTE_MARK), F.lit('\\"')), F.lit(BACKSLASH_MARK), F.lit("\\\\"))


def strict_json(s) -> Column:
    """Parse text that must be exactly one JSON value (trailing text is an
    error, as for Python's json.loads, which also reads NaN and Infinity). Wrapping in
    '[...]' turns trailing text into a parse error; exactly one element must come back."""
    odd = lambda x: (x.contains("NaN") | x.contains("Infinity")) & ~x.rlike(f"[{BACKSLASH_MARK}{QUOTE_MARK}]")
    text = let(_c(s), lambda x: F.when(odd(x), finite_numbers(x)).otherwise(x))
    arr = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return let(arr, lambda a: F.when(F.size(a) == 1, F.try_element_at(a, F.lit(1))))


def keep_last_of_repeated_keys(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on reads an object with a repeated key with the last
    value (Spark's own setting; by default such text is an error)."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def parse_ladder(df: DataFrame, text: str) -> DataFrame:
    """C4: add ``stage`` and ``reply``: fenced block -> whole text -> greedy object ->
    none. A candidate that fails to parse falls through to the next. Each candidate
    is a column of its own that is worked out once, and only where those before it
    failed. Sets the session to keep the last of repeated keys."""
    df = keep_last_of_repeated_keys(df)
    t = F.col(text)
    # Without a match the extracted text is empty, which is no JSON value either.
    block = F.when(t.contains("```"), strip(F.regexp_extract(t, FENCE_PATTERN, 1)))
    x = df.select("*", once(strict_json(block).alias("_fenced")))
    x = x.select("*", once(F.when(F.col("_fenced").isNull(), strict_json(t)).alias("_direct")))
    neither = F.col("_fenced").isNull() & F.col("_direct").isNull()
    x = x.select("*", once(F.when(neither, strict_json(F.regexp_extract(t, OBJECT_PATTERN, 0))).alias("_greedy")))
    stage = (
        F.when(F.col("_fenced").isNotNull(), F.lit("fenced")).when(F.col("_direct").isNotNull(), F.lit("direct"))
        .when(F.col("_greedy").isNotNull(), F.lit("greedy")).otherwise(F.lit("none"))
    )
    return x.select(*df.columns, stage.alias("stage"), F.coalesce("_fenced", "_direct", "_greedy").alias("reply"))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def cards_value(reply) -> Column:
    """The value under ``cards`` of an object reply (a variant; null without the key)."""
    return F.try_variant_get(_c(reply), "$.cards", "variant")


def reply_shape(reply, value) -> Column:
    """C5: 'unparsed', 'not_object', 'no_cards_key', 'cards_not_list' or
    'cards_list'; ``value`` is the reply's ``cards_value``. Only an object has one, so
    the reply's own kind matters without it only."""
    r, v = _c(reply), _c(value)
    return (
        F.when(r.isNull(), F.lit("unparsed"))
        .when(v.isNull(), F.when(_kind(r).startswith("OBJECT"), F.lit("no_cards_key")).otherwise(F.lit("not_object")))
        .when(F.try_variant_get(v, "$", "array<variant>").isNull(), F.lit("cards_not_list"))
        .otherwise(F.lit("cards_list"))
    )


def _difficulty(v: Column) -> Column:
    """struct(ok, value) for a present difficulty (pydantic's lax int)."""
    k = _kind(v)
    dec = F.try_variant_get(v, "$", "decimal(38,10)")
    s = strip(F.try_variant_get(v, "$", "string"))
    int_text = s.rlike(r"^[+-]?[0-9]+(\.0+)?$")
    as_long_text = F.regexp_replace(s, r"\.0+$", "").try_cast("long")
    dbl = F.try_variant_get(v, "$", "double")
    ok = (
        F.when(k == "VOID", True)
        .when(k.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), True)
        .when(k.startswith("DECIMAL"), (dec == F.floor(dec)) & dec.between(-(2**63), 2**63 - 1))
        .when(k.isin("DOUBLE", "FLOAT"), (dbl == F.floor(dbl)) & dbl.between(-(2.0**63), 2.0**63 - 1))
        .when(k == "BOOLEAN", True)
        .when(k == "STRING", int_text & as_long_text.isNotNull())
        .otherwise(False)
    )
    value = (
        F.when(k == "VOID", F.lit(None).cast("long"))
        .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("long"))
        .when(k.isin("DOUBLE", "FLOAT"), dbl.try_cast("long"))
        .when(k.startswith("DECIMAL"), dec.try_cast("long"))
        .when(k == "STRING", as_long_text)
        .otherwise(F.try_variant_get(v, "$", "long"))
    )
    return F.struct(ok.alias("ok"), value.alias("value"))


def card_fields(card: Column) -> Column:
    """Stage 1 of the card check: the card's raw fields, each looked up once (all null
    unless the card is an object)."""
    return F.struct(*[F.try_variant_get(card, f"$.{k}", "variant").alias(k) for k in (*REQUIRED_KEYS, "tags", "source", "difficulty")])


def card_values(f: Column) -> Column:
    """Stage 2: typed values of the fields with what the check has to know of each:
    present, and of the right kind."""
    def text(k: str) -> Column:
        return F.struct(f[k].isNotNull().alias("present"), (_kind(f[k]) == "STRING").alias("ok"),
                        F.try_variant_get(f[k], "$", "string").alias("value"))

    tags = F.struct(f["tags"].isNotNull().alias("present"), _kind(f["tags"]).alias("kind"),
                    F.try_variant_get(f["tags"], "$", "array<string>").alias("value"))
    return F.struct(*[text(k).alias(k) for k in (*REQUIRED_KEYS, "source")], tags.alias("tags"),
                    F.when(f["difficulty"].isNotNull(), _difficulty(f["difficulty"])).alias("difficulty"))


def card_check(v: Column, default_source: Column) -> Column:
    """C7 + C8 for one card (given as ``card_values``): struct(status, front,
    back, card_type, tags, source, difficulty) with status 'ok', 'skip' (not
    an object or a required key missing: only this card is dropped) or
    'fatal' (a present value of the wrong type: the whole reply is dropped).
    Missing keys win over types."""
    present, fit = F.lit(True), F.lit(True)
    for k in REQUIRED_KEYS:
        present, fit = present & v[k]["present"], fit & v[k]["ok"]
    tags = v["tags"]
    tags_ok = ~tags["present"] | (
        ((tags["kind"] == "ARRAY<STRING>") & ~F.exists(tags["value"], lambda x: x.isNull()))
        | ((tags["kind"] == "ARRAY<VOID>") & (F.size(tags["value"]) == 0))
    )
    source_ok = ~v["source"]["present"] | v["source"]["ok"]
    diff_ok = v["difficulty"].isNull() | v["difficulty"]["ok"]
    status = (
        F.when(~present, F.lit("skip"))
        .when(fit & tags_ok & source_ok & diff_ok, F.lit("ok"))
        .otherwise(F.lit("fatal"))
    )
    return F.struct(
        status.alias("status"), *[v[k]["value"].alias(k) for k in REQUIRED_KEYS],
        F.coalesce(tags["value"], F.array().cast("array<string>")).alias("tags"),
        F.coalesce(v["source"]["value"], default_source).alias("source"),
        v["difficulty"]["value"].alias("difficulty"),
    )


def checked(cards: Column, default_source: Column) -> Column:
    """The checks of every element of a reply's ``cards`` value (a variant); empty unless
    it is a list."""
    listed = F.coalesce(F.try_variant_get(cards, "$", "array<variant>"), F.array().cast("array<variant>"))
    values = F.transform(F.transform(listed, card_fields), card_values)
    return F.transform(values, lambda v: card_check(v, default_source))
