"""Secrets in texts: fixed patterns, and strings that look random to a Markov model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.tables import free_name, numbered, stored, text_or_empty

# Fixed patterns. Each takes what it can; what is too short is dropped afterwards.
ASSIGN = (
    r"""(?:(?i)password|(?i)passwd|(?i)secret|(?i)token|(?i)api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
LEAST_ASSIGNED = 6
KINDS = [*BASE, "markov"]

# What the model looks at: runs of the letters that keys are written in.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ORDINARY = "[A-Za-z0-9_]{6,}"
ALPHABET = 66
SMOOTHING = 0.5
#: Mean log-likelihood ratio of two neighbouring characters from which a string is a secret.
THRESHOLD = 0.5


def _found(kind: str, pattern: str) -> Column:
    """The matches of one kind and the text before each, or null without any."""
    text = F.col("_text")
    return F.when(
        text.rlike(pattern),
        F.struct(
            F.lit(kind).alias("kind"),
            F.split(text, pattern, -1).alias("gap"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        ),
    )


def matches(
    documents: DataFrame, patterns: dict[str, str], row: str | None = None
) -> DataFrame:
    """One row for each match: ``_row, doc_id, kind, start, end, match``, in code points.

    ``row`` names a column that numbers the documents, else they get numbers here. A document without any has one row of nulls. A place is the sum of the lengths of
    all that comes before, so no text leaves the task that reads it.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = documents.select(number.alias("_row"), "doc_id", text_or_empty().alias("_text"))
    kinds = F.array_compact(F.array(*(_found(k, p) for k, p in patterns.items())))
    found = rows.select("_row", "doc_id", F.explode_outer(kinds).alias("_of"))
    parts = found.select(
        "_row",
        "doc_id",
        F.col("_of.kind").alias("kind"),
        F.posexplode_outer(F.arrays_zip("_of.gap", "_of.match")).alias("_at", "_part"),
    ).where("kind is null or _part.match is not null")
    parts = parts.select(
        "_row",
        "doc_id",
        "kind",
        "_at",
        F.col("_part.match").alias("match"),
        F.length("_part.gap").alias("_gap"),
    )
    in_order = Window.partitionBy("_row", "kind").orderBy("_at")
    up_to = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return parts.withColumn(
        "end", F.sum(F.col("_gap") + F.length("match")).over(up_to)
    ).select(
        "_row", "doc_id", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match"
    )


def _pairs(strings: DataFrame, count: str) -> DataFrame:
    """How often each two neighbouring characters come in the column ``string``.

    Equal strings are counted first, so that the characters of each are read once.
    """
    at = F.explode(F.sequence(F.lit(1), F.length("piece") - 1))
    counted = strings.groupBy("string").agg(F.count("*").alias("_times"))
    return (
        _pieces(counted, "_times")
        .select("_times", "piece", at.alias("_at"))
        .groupBy(F.substring("piece", F.col("_at"), F.lit(2)).alias("pair"))
        .agg(F.sum("_times").alias(count))
    )


def _pieces(strings: DataFrame, *columns: str) -> DataFrame:
    """Strings in pieces of at most 64 characters and the one after, so no pair is missed.

    A character is found by counting from the start, so that reading all pairs of a
    long string at once would take the square of its length.
    """
    cut = F.regexp_extract_all("string", F.lit("(?s)(?=(.{1,65})).{1,64}"), F.lit(1))
    pieces = strings.select(*columns, F.explode(cut).alias("piece"))
    return pieces.where("length(piece) > 1")


def train(random: DataFrame, ordinary: DataFrame) -> DataFrame:
    """Log-likelihood ratio of each pair of neighbours, from labelled strings (column ``string``).

    Two Markov chains of characters, one of random strings and one of ordinary
    identifiers, with ``SMOOTHING`` added to each count. Columns ``pair, ratio``; the
    row with an empty second character is the ratio of all unseen pairs of a first
    one. At most the square of the characters seen, and no rows without samples.
    """
    counted = _pairs(random, "_r").join(_pairs(ordinary, "_o"), "pair", "full")
    counted = counted.select(
        "pair",
        F.substring("pair", 1, 1).alias("_first"),
        F.coalesce("_r", F.lit(0)).alias("_r"),
        F.coalesce("_o", F.lit(0)).alias("_o"),
    )
    # Read twice below, and the texts should be read once.
    counted = stored(counted, "pairs")
    firsts = counted.groupBy("_first").agg(F.sum("_r").alias("_all_r"), F.sum("_o").alias("_all_o"))
    none = F.lit(0).cast("long")
    unseen = firsts.select(
        F.col("_first").alias("pair"), "_first", none.alias("_r"), none.alias("_o")
    )

    def chance(seen: str, every: str) -> Column:
        return F.log((F.col(seen) + SMOOTHING) / (F.col(every) + SMOOTHING * ALPHABET))

    return (
        counted.unionByName(unseen)
        .join(firsts, "_first")
        .select("pair", (chance("_r", "_all_r") - chance("_o", "_all_o")).alias("ratio"))
    )


def scores(strings: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """Mean ratio of the pairs of each string; a pair whose first character is new counts 0."""
    at = F.explode(F.sequence(F.lit(1), F.length("piece") - 1))
    pairs = _pieces(strings, *keys).select(*keys, "piece", at.alias("_at")).select(
        *keys,
        F.substring("piece", F.col("_at"), F.lit(2)).alias("pair"),
        F.substring("piece", F.col("_at"), F.lit(1)).alias("_first"),
    )
    # The model has a row for each pair of the alphabet's characters at most.
    seen = F.broadcast(model.where("length(pair) = 2"))
    unseen = F.broadcast(
        model.where("length(pair) = 1").select(
            F.col("pair").alias("_first"), F.col("ratio").alias("_unseen")
        )
    )
    return (
        pairs.join(seen, "pair", "left")
        .join(unseen, "_first", "left")
        .groupBy(*keys)
        .agg(F.avg(F.coalesce("ratio", "_unseen", F.lit(0.0))).alias("score"))
    )


def ordinary_identifiers(documents: DataFrame) -> DataFrame:
    """Identifiers of ordinary text: those of all documents without a base match."""
    text = text_or_empty()
    words = F.explode(F.regexp_extract_all(text, F.lit(ORDINARY), F.lit(0)))
    plain = F.lit(True)
    for pattern in BASE.values():
        plain = plain & ~text.rlike(pattern)
    return documents.where(plain).select(words.alias("string"))


def secret_spans(
    documents: DataFrame, threshold: float = THRESHOLD, row: str | None = None
) -> DataFrame:
    """All spans of all documents: ``_row, doc_id, kind, start, end, secret``; nulls where none.

    Base spans come from the fixed patterns. The model's labelled samples are the
    secrets in them and ordinary identifiers; it adds runs of key characters that it
    takes for random and that no base span touches. Without a base span anywhere
    there is nothing to learn from and nothing is added. A null text is empty;
    repeated rows are scanned each; other columns are not read, but for ``row`` if it
    names the column that numbers the documents.
    """
    found = stored(matches(documents, BASE | {"markov": CANDIDATE}, row), "matches")
    # Before short assignments go: a document may have nothing else.
    rows = found.select("_row", "doc_id").distinct()
    assigned = F.regexp_extract("match", ASSIGN, 1)
    secret = F.when(F.col("kind") == "assign", assigned).otherwise(F.col("match"))
    found = found.withColumn("secret", secret).where(
        f"kind is null or kind <> 'assign' or length(secret) >= {LEAST_ASSIGNED}"
    )
    is_base = F.col("kind").isin(*BASE)
    model = stored(
        train(
            found.where(is_base).select(F.col("secret").alias("string")),
            ordinary_identifiers(documents),
        ),
        "model",
    )
    # A run touches a base span if one that starts before it, or at it, ends later
    # than it starts, or if one starts within it.
    in_order = Window.partitionBy("_row").orderBy("start")
    before = in_order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = in_order.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    base_end, base_start = (F.when(is_base, F.col(c)) for c in ("end", "start"))
    touched = (
        F.coalesce(F.max(base_end).over(before) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(base_start).over(after) < F.col("end"), F.lit(False))
    )
    found = found.withColumn("_touched", touched)
    free = found.where("kind = 'markov' and not _touched").select(
        "_row", "start", F.col("secret").alias("string")
    )
    random = scores(free, model, ["_row", "start"]).where(F.col("score") >= threshold)
    added = found.where("kind = 'markov'").join(
        random.select("_row", "start"), ["_row", "start"], "left_semi"
    )
    kept = found.where("kind is null or kind <> 'markov'").unionByName(added)
    spans = kept.where("kind is not null").drop("doc_id")
    return rows.join(spans, "_row", "left").select(
        "_row", "doc_id", "kind", "start", "end", "secret"
    )


def document_secrets(documents: DataFrame) -> DataFrame:
    """Spans for each document as counts and digests: the columns of the query."""
    spans = secret_spans(documents)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(
        "start", place.alias("place"), F.concat_ws(":", "kind", "start", "end").alias("text")
    )

    def joined(chosen: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.when(chosen, span)))
        return F.concat_ws(",", listed["text"])

    counts = [
        F.sum((F.col("kind") == kind).cast("long")).alias(f"n_{kind}") for kind in BASE
    ]
    found = spans.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        *counts,
        joined(F.col("kind").isin(*BASE)).alias("_base"),
        joined(F.col("kind").isNotNull()).alias("spans"),
    )
    return found.select(
        "doc_id",
        *(F.coalesce(f"n_{kind}", F.lit(0).cast("long")).alias(f"n_{kind}") for kind in BASE),
        F.sha2(F.col("_base").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def without_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """Documents with each secret replaced by a mark; all rows and columns stay.

    Spans that overlap become one mark, of an assignment only the value goes. A text
    without spans, null or not, stays as it is. Column ``n_chars``, if there, is that
    of the new text.
    """
    names = docs.columns
    row = free_name(docs, "_row")
    rows = numbered(docs, row)
    spans = secret_spans(rows, row=row).where("kind is not null")
    spans = spans.withColumn("start", F.col("end") - F.length("secret"))
    # Overlapping spans form one: a new one starts where all before have ended.
    in_order = Window.partitionBy("_row").orderBy("start", "end")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True))
    spans = spans.select("_row", "start", "end", fresh.cast("int").alias("_fresh"))
    spans = spans.withColumn("_number", F.sum("_fresh").over(in_order))
    spans = spans.groupBy("_row", "_number").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    )
    # The text from the end of each span to the start of the next.
    next_start = F.lead("start").over(Window.partitionBy("_row").orderBy("start"))
    spans = spans.withColumn("_until", next_start)
    marked = spans.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "_until"))).alias("_spans")
    )
    pieces = F.transform(
        "_spans",
        lambda s: F.concat(
            F.lit(mark),
            F.substring(
                F.col("text"), (s["end"] + 1).cast("int"),
                (F.coalesce(s["_until"], F.length("text")) - s["end"]).cast("int"),
            ),
        ),
    )
    head = F.left(F.col("text"), F.col("_spans")[0]["start"].cast("int"))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(
        F.concat(head, F.concat_ws("", pieces))
    )
    marked = stored(marked.withColumnRenamed("_row", row), "marked")
    changed = rows.join(marked, row, "left").withColumn("text", text)
    if "n_chars" in names:
        own = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn(
            "n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(own)
        )
    return changed.select(*names)
