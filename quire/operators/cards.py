"""Card requests, reply parsing and card reports.

Replies are checked row by row: the cards of one reply live in one row, so
the rule "a card of the wrong type discards the whole reply" is an
``exists`` over that row's array, not a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import replies as R
from quire.functions import text as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Prompt sent for one chapter; {title}, {content} and {n} are filled in.
PROMPT_TEMPLATE = (
    "\nChapter Title: {title}\n\nChapter Content:\n{content}\n\n"
    "Please generate exactly {n} flashcards from this chapter content following the instructions provided.\n"
    "Focus on the most important concepts, definitions, and key points.\n"
)
# Card types and the wanted mix, in basis points.
CARD_TYPE_TARGETS = {"basic": 6000, "cloze": 2000, "definition": 1500, "qa": 500}
CLOZE_MARKER = r"\{\{c1::.+?\}\}"


def card_requests(chapters: DataFrame, n: int = 5) -> DataFrame:
    """One prompt per chapter (apply to suitable chapters)."""
    head, rest = PROMPT_TEMPLATE.split("{title}")
    mid, tail = rest.split("{content}")
    before_n, after_n = tail.split("{n}")
    prompt = F.concat(F.lit(head), F.col("title"), F.lit(mid), F.col("content"),
                      F.lit(before_n + str(n) + after_n))
    return chapters.select("book_id", "chapter_number", prompt.alias("prompt"))


def with_reply_text(replies: DataFrame) -> DataFrame:
    """Replies of a model run (final_output, items, messages, content) with their
    ``response_text``; a table that has it already stays as it is."""
    if "response_text" in replies.columns:
        return replies
    return replies.withColumn("response_text", R.reply_text("final_output", "items", "messages", "content")).drop(
        "final_output", "items", "messages", "content")


def parse_replies(responses: DataFrame, text: str = "response_text") -> DataFrame:
    """Add ``stage``, ``reply`` (VARIANT), its ``cards_value`` and ``shape``."""
    p = R.parse_ladder(responses, text)
    p = p.select("*", T.once(R.cards_value(F.col("reply")).alias("cards_value")))
    return p.withColumn("shape", R.reply_shape("reply", "cards_value"))


def checked_replies(parsed: DataFrame, default_source: str = "chapter_title") -> DataFrame:
    """Each reply with its checked cards ``cs`` (an array) and ``reply_fatal``. The
    checks are made on the reply's own array, once: no shuffle, and replies that share
    an id (or have none) do not meet."""
    kept = [c for c in parsed.columns if c not in ("reply", "cards_value", "response_text")]
    x = parsed.select(*kept, T.once(R.checked(F.col("cards_value"), F.col(default_source)).alias("cs")))
    return x.withColumn("reply_fatal", F.exists("cs", lambda c: c["status"] == "fatal"))


def checked_cards(parsed: DataFrame, default_source: str = "chapter_title") -> DataFrame:
    """One row per element of each reply's cards list (``card_no`` from 1)
    with its check result ``c`` and ``reply_fatal``."""
    return checked_replies(parsed, default_source).select(
        "reply_id", "book_id", "reply_fatal", F.posexplode("cs").alias("pos", "c")).select(
        "reply_id", "book_id", (F.col("pos") + 1).alias("card_no"), "c", "reply_fatal")


def exploded_cards(parsed: DataFrame) -> DataFrame:
    """Every element of the cards list with its position and status."""
    return checked_cards(parsed).select("reply_id", "book_id", "card_no", F.col("c.status").alias("status"),
                                        "reply_fatal")


def valid_cards(parsed: DataFrame) -> DataFrame:
    """C7 + C8: typed cards of replies without a fatal card, order kept."""
    c = checked_cards(parsed).where(~F.col("reply_fatal") & (F.col("c.status") == "ok"))
    return c.select("reply_id", "book_id", "card_no", "c.front", "c.back", "c.card_type", "c.tags", "c.source",
                    "c.difficulty")


COUNTS = ["items", "ok", "skipped", "fatal", "cards"]


def counted_replies(parsed: DataFrame) -> DataFrame:
    """Each reply with the number of its cards by status and of those kept, from
    the reply's own array."""
    def of(status: str) -> Column:
        return F.size(F.filter("cs", lambda c: c["status"] == status))

    x = checked_replies(parsed).withColumns({
        "items": F.size("cs"), "ok": of("ok"), "skipped": of("skip"), "fatal": of("fatal")})
    return x.withColumn("cards", F.when(F.col("reply_fatal"), 0).otherwise(F.col("ok"))).drop("cs", "reply_fatal")


def reply_report(parsed: DataFrame) -> DataFrame:
    """One row per reply: stage, shape, counts per card status and the
    number of cards kept (replies without cards count zeros). Replies of one id
    or without one are counted each by itself."""
    return counted_replies(parsed).select("reply_id", "book_id", "stage", "shape", *COUNTS)


def reconcile(requests: DataFrame, parsed: DataFrame, key: str = "request_id", attempt: str = "attempt") -> DataFrame:
    """C9 from the requests' side: every request and every reply is accounted for.

    One row per key with its ``status``: ``answered`` (the last attempt gave cards),
    ``empty`` (it gave none), ``no_reply``, ``unrequested`` (replies to no request). The
    last attempt decides, as a later reply replaces an earlier one; attempts of one
    number are ordered by a hash of their results. Requests and replies without a key
    have a row each (``no_reply`` and ``unidentified``): nothing says that two of them
    belong together. ``requests`` and ``attempts`` count the rows behind a row.

    Both sides are reduced to one row per key before they meet (map-side first), so a key
    with very many attempts sends one row per task, and rows without a key are not
    shuffled at all."""
    results = ["stage", "shape", *COUNTS]
    replies = counted_replies(parsed)
    tie = F.xxhash64("book_id", *results)
    last = F.struct(attempt, tie.alias("tie"), *results)
    got = replies.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("attempts"), F.max(last).alias("last"))
    asked = requests.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("requests"))
    status = (
        F.when(F.col("requests").isNull(), F.lit("unrequested")).when(F.col("attempts").isNull(), F.lit("no_reply"))
        .when(F.col("last.cards") > 0, F.lit("answered")).otherwise(F.lit("empty"))
    )
    none = F.lit(0).cast("long")
    known = asked.join(got, key, "full_outer").select(
        key, status.alias("status"), F.coalesce("requests", none).alias("requests"), F.coalesce("attempts", none).alias("attempts"),
        F.col(f"last.{attempt}").alias("last_attempt"), *[F.col(f"last.{c}").alias(c) for c in results])
    one = F.lit(1).cast("long")
    stray = replies.where(F.col(key).isNull()).select(
        key, F.lit("unidentified").alias("status"), none.alias("requests"), one.alias("attempts"),
        F.col(attempt).alias("last_attempt"), *results)
    nulls = [F.lit(None).cast(known.schema[c].dataType).alias(c) for c in ("last_attempt", *results)]
    open_ = requests.where(F.col(key).isNull()).select(
        key, F.lit("no_reply").alias("status"), one.alias("requests"), none.alias("attempts"), *nulls)
    return known.unionByName(stray).unionByName(open_)


def reconciliation_summary(reconciled: DataFrame) -> DataFrame:
    """Requests, replies and kept cards per status."""
    return reconciled.groupBy("status").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("requests").alias("requests"), F.sum("attempts").alias("attempts"),
        F.coalesce(F.sum("cards"), F.lit(0)).cast("long").alias("cards"))


def card_audit(cards: DataFrame) -> DataFrame:
    """Rules the instructions state but no code enforces, per book."""
    known = F.col("card_type").isin(*CARD_TYPE_TARGETS)
    d = F.col("difficulty")
    return cards.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("cards"),
        F.count_if(~known).alias("unknown_type"),
        F.count_if(d.isNull()).alias("no_difficulty"),
        F.count_if(d.isNotNull() & ~d.between(1, 5)).alias("difficulty_out_of_range"),
        F.count_if((F.col("card_type") == "cloze") & ~F.col("front").rlike(CLOZE_MARKER)).alias("cloze_without_marker"),
        F.count_if(~F.exists("tags", lambda t: t.contains("::"))).alias("flat_tags"),
    )


def card_mix(cards: DataFrame) -> DataFrame:
    """C11: share of each card type per book against the wanted mix, in basis
    points (integer arithmetic, so results are exact). Every book has a row
    for each wanted type, also for those it has no card of."""
    counted = cards.groupBy("book_id", "card_type").agg(F.count(F.lit(1)).alias("cards"))
    none = counted.select("book_id").distinct().select(
        "book_id", F.explode(F.array(*[F.lit(k) for k in CARD_TYPE_TARGETS])).alias("card_type"),
        F.lit(0).cast("long").alias("cards"))
    per_type = counted.unionByName(none).groupBy("book_id", "card_type").agg(F.sum("cards").alias("cards"))
    totals = counted.groupBy("book_id").agg(F.sum("cards").alias("book_cards"))
    target = None
    for k, v in CARD_TYPE_TARGETS.items():
        target = F.when(F.col("card_type") == k, v) if target is None else target.when(F.col("card_type") == k, v)
    m = per_type.join(totals, "book_id").select(
        "book_id", "card_type", "cards",
        F.expr("(cards * 10000) div book_cards").alias("share_bp"),
        target.alias("target_bp"),
    )
    return m.withColumn("gap_bp", F.col("share_bp") - F.col("target_bp"))


def card_preview(cards: DataFrame, k: int = 3, width: int = 60) -> DataFrame:
    """First ``k`` cards of each book (reply order, then card order) with
    a preview of the front, and how many more the book has. The top-k is a
    window group limit (trimmed before the shuffle); the totals are a plain
    aggregate."""
    w = Window.partitionBy("book_id").orderBy("reply_id", "card_no")
    top = cards.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    totals = cards.groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))
    return top.join(totals, "book_id").select(
        "book_id", "rank", T.preview(F.col("front"), width).alias("preview"),
        F.greatest(F.col("n") - k, F.lit(0)).alias("more"),
    )


# ---------------------------------------------------------------------------
# Extractive card candidates (stands in for the remote model)
# ---------------------------------------------------------------------------

SENTENCE_PATTERN = r"[^.!?]+[.!?]*"
DEFINITION_PATTERN = r"(?s)^([A-Z][A-Za-z]*(?: [A-Za-z]+){0,3}) (?:is|are) (?:a|an|the) (.+)$"
NUMBER_PATTERN = r"[0-9]+"
MIN_SENTENCE_CHARS = 20


def extractive_candidates(content, n: int = 5) -> Column:
    """The first ``n`` card candidates of a text as
    ``array<struct<card_type, front, back>>``: a sentence (at least 20
    characters) with a number becomes a cloze card hiding its first number,
    a sentence 'X is/are a/an/the Y' a definition card."""
    sentences = F.transform(F.regexp_extract_all(content, F.lit(SENTENCE_PATTERN), 0), lambda s: T.strip(s))

    def judged(s: Column) -> Column:
        kind = F.when(F.length(s) < MIN_SENTENCE_CHARS, F.lit(None)).when(s.rlike(NUMBER_PATTERN), F.lit("cloze")).when(
            s.rlike(DEFINITION_PATTERN), F.lit("definition"))
        return F.struct(kind.alias("card_type"), s.alias("s"))

    def candidate(c: Column) -> Column:
        s, is_cloze = c["s"], c["card_type"] == "cloze"
        front = F.when(is_cloze, F.regexp_replace(s, r"(?s)^(.*?)([0-9]+)(.*)$", "$1{{c1::$2}}$3")).otherwise(
            F.concat(F.lit("Define: "), F.regexp_extract(s, DEFINITION_PATTERN, 1)))
        back = F.when(is_cloze, F.regexp_extract(s, NUMBER_PATTERN, 0)).otherwise(s)
        return F.struct(c["card_type"].alias("card_type"), front.alias("front"), back.alias("back"))

    # Fronts and backs are made for the sentences that stay only.
    found = F.filter(F.transform(sentences, judged), lambda c: c["card_type"].isNotNull())
    return F.transform(F.slice(found, 1, n), candidate)


def candidate_cards(found: DataFrame) -> DataFrame:
    """Cards of chapters (book_id, chapter_number, title) that have their ``candidates``."""
    e = found.select("book_id", "chapter_number", "title", F.posexplode("candidates").alias("pos", "c"))
    return e.select(
        "book_id", "chapter_number", (F.col("pos") + 1).alias("card_no"),
        F.col("c.front").alias("front"), F.col("c.back").alias("back"), F.col("c.card_type").alias("card_type"),
        F.array(F.lit("extractive"), F.col("c.card_type")).alias("tags"), F.col("title").alias("source"),
        F.when(F.col("c.card_type") == "cloze", 2).otherwise(1).cast("long").alias("difficulty"),
    )


def extractive_cards(chapters: DataFrame, n: int = 5) -> DataFrame:
    """Extractive card candidates per chapter (stands in for the remote
    model so that the pipeline runs end to end). Row-local: the whole
    chapter is one row, so no window is needed."""
    return candidate_cards(chapters.select("book_id", "chapter_number", "title",
                                           extractive_candidates(F.col("content"), n).alias("candidates")))
