"""Secret scans: patterns of known shapes, and the entropy of a window that slides over candidates.

All of it is column expressions. A pattern's matches and what lies between them give the places of
the matches in code points. The window keeps one number, the sum of ``c log2 c`` over the counts
``c`` of its characters; a step changes the counts of the entering and the leaving character only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import nested, restored, text_of

# The kinds of spans in the order they are listed, and the base patterns. A match of
# ``assign`` counts if its second group has six characters; shorter ones still take up their text.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# What every match of ``assign`` holds, in lower case.
ASSIGN_WORDS = ("passw", "secret", "token", "api")

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}"
# The same strings, found without trying every character of a shorter run.
CANDIDATE_RUN = rf"(?<![A-Za-z0-9+/_-]){CANDIDATE}+"
#: Character classes of candidates, the first that matches counts, and the least entropy of a
#: window in bits. The SQL has the first three. Every candidate is of a class: the fewer kinds of
#: characters a secret has, the more it looks like words, and the closer to random it must be.
CLASSES = (
    (r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.03),
    (r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9]+$", 3.63),
    (r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z]).+$", 3.83),
    (r"^[0-9]+$", 3.2),
    (r"^(?:[a-z]+|[A-Z]+)$", 3.83),
    (r"^[A-Za-z]+$", 3.9),
    (r"^[A-Za-z0-9]+$", 3.63),
    (r"[0-9]", 3.83),
    (r"", 4.0),
)
#: What the SQL leaves out as a whole: UUIDs, examples and placeholders, alphabets, paths of words.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|xxxxxx",
    r"(?i)abcdefgh|0123456789|987654321",
    r"^/?([a-zA-Z_-]+/)+[a-zA-Z0-9_-]*$",
)
# Of these a UUID is no secret. Windows with an example, a placeholder or an alphabet do not count,
# those beside it do. In a path each segment counts for itself, if all are words: the last may have
# numbers before or after its words, and any may where there are no capital letters.
UUID = ALLOWED[0]
ALLOWED_PART = r"(?i)example|placeholder|changeme|x{6,}|abcdefgh|0123456789|987654321"
NUMBERED = r"(?:(?:{0}*[0-9]*|[0-9]+{0}+)(?:[_-]|$|(?=/)))*+"
PATHS = (
    rf"^/?(?:[a-zA-Z_-]++/)++{NUMBERED.format('[a-zA-Z]')}$",
    rf"^/?(?:(?=[a-z0-9_-]){NUMBERED.format('[a-z]')}/)++{NUMBERED.format('[a-z]')}$",
)
BLOCK = 1000  # windows of a long run are looked at in blocks, as places in a text are counted from its start
SCALE = 1_000_000  # the sum is kept in whole millionths, so that no order of steps shows


def entropy_reaches(candidate: Column, least: Column) -> Column:
    """Whether some window of ``WINDOW`` characters has that entropy.

    For a candidate of at least that many characters. One step for each character, two counts for
    each step.
    """
    terms = [round(SCALE * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]
    table = F.array(*[F.lit(t) for t in terms])

    def term(count: Column) -> Column:
        return F.element_at(table, count.cast("int") + 1)

    def count(window: Column, character: Column) -> Column:
        return F.length(window) - F.length(F.replace(window, character, F.lit("")))

    def step(state: Column, at: Column) -> Column:
        window = F.substring(candidate, F.greatest(at - WINDOW, F.lit(1)), F.least(at - 1, F.lit(WINDOW)))
        enters = F.substring(candidate, at, F.lit(1))
        leaves = F.when(at > WINDOW, F.substring(candidate, at - WINDOW, F.lit(1))).otherwise("")
        gone = F.when(at > WINDOW, count(window, leaves)).otherwise(1)
        there = count(window, enters) - (enters == leaves).cast("int")
        total = state["sum"] - term(gone) + term(gone - 1) - term(there) + term(there + 1)
        lowest = F.when(at >= WINDOW, F.least(state["lowest"], total)).otherwise(state["lowest"])
        return F.struct(total.cast("bigint").alias("sum"), lowest.cast("bigint").alias("lowest"))

    nothing = F.struct(
        F.lit(0).cast("bigint").alias("sum"), F.lit(1 << 60).cast("bigint").alias("lowest")
    )
    steps = F.sequence(F.lit(1), F.length(candidate))
    lowest = F.aggregate(steps, nothing, step)["lowest"]
    return lowest <= F.round((F.lit(math.log2(WINDOW)) - least) * WINDOW * SCALE)


def least_entropy(part: Column) -> Column:
    """The least entropy for the class of a part."""
    least = F.lit(None).cast("double")
    for pattern, bits in reversed(CLASSES):
        least = F.when(part.rlike(pattern), bits).otherwise(least)
    return least


def is_secret(candidate: Column) -> Column:
    """Whether some window of a candidate that is in no allowed part has the entropy of its class."""

    def blocks(part: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(part) - WINDOW + 1, F.lit(BLOCK))
        return F.transform(starts, lambda at: F.substring(part, at, F.lit(BLOCK + WINDOW - 1)))

    def reaches(part: Column) -> Column:
        some = lambda least: F.exists(blocks(part), lambda b: entropy_reaches(b, least))
        return F.exists(F.array(least_entropy(part)), some)

    is_path = candidate.rlike(PATHS[0]) | candidate.rlike(PATHS[1])
    ends = F.when(is_path, F.lit(f"{ALLOWED_PART}|/")).otherwise(F.lit(ALLOWED_PART))
    parts = F.filter(F.split(candidate, ends), lambda part: F.length(part) >= WINDOW)
    return ~candidate.rlike(UUID) & F.exists(parts, reaches)


SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, kind: int, pattern: str, likely: Column, keep) -> Column:
    """Places of the matches of a pattern, leftmost and without overlaps, in order.

    ``likely`` spares texts the search that cannot match; ``keep`` takes a match and the text of
    its second group, if there is one, and tells whether it counts.
    """
    matches = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if pattern == ASSIGN else 0)).alias("value"),
    )

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["before"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        counts = x["match"].isNotNull() & keep(x["match"], x["value"])
        spans = F.when(counts, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.cast(SPANS).alias("spans"))

    none = F.array().cast(SPANS)
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(likely, F.aggregate(matches, state, step)["spans"]).otherwise(none)


def _scanned(df: DataFrame, text_col: str) -> DataFrame:
    """Rows as ``(row, text, base, spans)``; spans are in order of start and kind."""
    rows = nested(df, df.columns, text=text_of(text_col))
    text, always = F.col("text"), lambda match, value: F.lit(True)
    lowered = F.lower(text)
    assigns = lowered.contains(ASSIGN_WORDS[0])
    for word in ASSIGN_WORDS[1:]:
        assigns = assigns | lowered.contains(word)
    long_enough = lambda match, value: F.length(value) >= ASSIGN_LEAST
    base = F.concat(
        _spans(text, 0, ASSIGN, assigns, long_enough),
        _spans(text, 1, ACCESS, text.contains("AKIA"), always),
        _spans(text, 2, HEX, text.rlike(HEX), always),
    )
    found = _spans(
        text, 3, CANDIDATE_RUN, text.rlike(CANDIDATE_RUN), lambda match, value: is_secret(match)
    )
    rows = rows.select("row", "text", F.array_sort(base).alias("base"), found.alias("found"))

    def is_new(span: Column) -> Column:
        covers = lambda b: (b["start"] <= span["start"]) & (b["end"] >= span["end"])
        return ~F.exists("base", covers)

    added = F.when(F.size("found") > 0, F.filter("found", is_new)).otherwise(F.col("found"))
    return rows.select("row", "text", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, separated by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def find_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row with ``n_assign``, ``n_access``, ``n_hex``, ``n_entropy``, ``base_sha256``
    and ``spans``.

    Spans are places in code points, the end exclusive, ordered by start and then by kind as in
    ``KINDS``. The first three kinds are the base patterns and stay whatever the fourth finds:
    candidates with a window of high entropy that is in no allowed part, and not inside a base span.
    ``base_sha256`` is the digest of the base spans as listed, of the empty text where there are
    none. A null text counts as empty and has no spans. Rows are independent of each other,
    repeated rows included; an input column with the name of a result column gives way; an empty
    table gives an empty table.
    """

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return restored(
        _scanned(df, text_col),
        df.columns,
        n_assign=number(0),
        n_access=number(1),
        n_hex=number(2),
        n_entropy=number(3),
        base_sha256=F.sha2(_listed(F.col("base")), 256),
        spans=_listed(F.col("spans")),
    )


def redact_secrets(
    df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", chars_col: str | None = None
) -> DataFrame:
    """The input with every span of the text replaced by a mark, overlapping spans by one.

    Texts without spans, null ones included, are as they were. ``chars_col`` names a column of the
    number of characters, which is set anew for a changed text. Columns and rows stay.
    """
    rows = _scanned(df, text_col)

    def step(state: Column, span: Column) -> Column:
        before = F.substring("text", state["at"] + 1, span["start"] - state["at"])
        text = F.when(
            span["start"] >= state["at"], F.concat(state["text"], before, F.lit(mark))
        ).otherwise(state["text"])
        return F.struct(
            F.greatest(state["at"], span["end"]).cast("int").alias("at"), text.alias("text")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    ended = F.aggregate("spans", start, step)
    rest = F.expr("substring(text, ended.at + 1)")
    rows = rows.withColumn("ended", F.when(F.size("spans") > 0, ended))
    old, new = F.col("row").getField(text_col), F.concat("ended.text", rest)
    changed = {text_col: F.when(F.col("ended").isNull(), old).otherwise(new)}
    if chars_col:
        chars = F.length(changed[text_col]).cast(df.schema[chars_col].dataType)
        chars_before = F.col("row").getField(chars_col)
        changed[chars_col] = F.when(F.col("ended").isNull(), chars_before).otherwise(chars)
    fields = {c: changed.get(c, F.col("row").getField(c)) for c in df.columns}
    return rows.select(*[value.alias(c) for c, value in fields.items()])
