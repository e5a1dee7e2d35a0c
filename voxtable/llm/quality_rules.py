"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample.

A document passes if it passes every rule, so the order changes the cost and never the verdict. A
rule sees only the documents that no rule before it has rejected.
"""

from __future__ import annotations

import operator
import re
import string
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import WORD_BREAKS, text_of, with_results
from voxtable.ship import ship_package

SYMBOLS = "#*$%&|<>"
# Letters of scripts written without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, Kana, Han.
UNSPACED_RANGES = (
    "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    "\U00020000-\U0003ffff"
)
UNSPACED = re.compile(f"[{UNSPACED_RANGES}]+")
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Document:
    """A text with what rules ask of it, each worked out once and only when asked for."""

    def __init__(self, text: str):
        self.text = text
        self._known: dict[str, object] = {}

    def __getattr__(self, name: str):
        known = self.__dict__["_known"]
        if name not in known:
            known[name] = MEASURES[name](self)
        return known[name]


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of that many words which the text holds twice or more.

    Windows are numbered by pairs: equal numbers for two halves and the word after them mean
    equal windows, so this is exact.
    """
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left[: len(right)] * (int(right.max()) + 1) + right
        return np.unique(pairs, return_inverse=True)[1]

    grams, length = ids, 1
    while 2 * length <= window:
        grams, length = joined(grams, grams[length:]), 2 * length
    while length < window:
        grams, length = joined(grams, ids[length:]), length + 1
    again = np.bincount(grams)[grams] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(again), 1)
    np.add.at(covered, np.flatnonzero(again) + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def _dup_lines(document: Document) -> int:
    lines = [line for line in document.text.split("\n") if line.strip(WORD_BREAKS)]
    return len(lines) - len(set(lines))


def _among(text: str, letters: str) -> int:
    data = text.encode()
    return len(data) - len(data.translate(None, letters.encode()))


#: What rules can ask of a document.
MEASURES: dict[str, Callable[[Document], object]] = {
    # ``bytes.split`` splits at exactly the word breaks, ``str.split`` at others as well.
    "words": lambda d: d.text.encode().split(),
    "n_words": lambda d: len(d.words),
    "word_chars": lambda d: len(d.text) - sum(d.text.count(c) for c in WORD_BREAKS),
    "n_symbols": lambda d: sum(d.text.count(c) for c in SYMBOLS),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda d: sum(1 for x in d.text.split("\n") if x.strip(WORD_BREAKS)),
    "n_repeat_words": lambda d: repeat_words(d.words),
    "n_capitals": lambda d: _among(d.text, string.ascii_uppercase),
    "n_letters": lambda d: _among(d.text, string.ascii_letters),
    "n_stutters": lambda d: sum(map(operator.eq, d.words, d.words[1:])),
    "n_distinct": lambda d: len(set(d.words)),
    "n_unspaced": lambda d: 0 if d.text.isascii() else sum(map(len, UNSPACED.findall(d.text))),
}


@dataclass(frozen=True)
class Rule:
    """A name and the test of the documents that it rejects."""

    name: str
    rejects: Callable[[Document], bool]


#: The two base rules, in integers as they are stated.
BASE = (
    Rule("too_few_words", lambda d: d.n_words < 10),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 20 * d.n_words),
)
#: The rules of the method. All thresholds are far from running prose.
RULES = (
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("short_words", lambda d: d.word_chars < 2 * d.n_words),
    # Between white space of scripts written without spaces lie sentences, not words.
    Rule("long_words", lambda d: d.word_chars > 20 * d.n_words and 2 * d.n_unspaced <= d.word_chars),
    Rule("duplicate_lines", lambda d: 2 * d.n_dup_lines > d.n_lines),
    Rule("capitals", lambda d: 2 * d.n_capitals > d.n_letters),
    Rule("stutter", lambda d: 5 * d.n_stutters > d.n_words),
    Rule("few_distinct_words", lambda d: d.n_distinct**2 < d.n_words),
)


def cascade_order(texts: list[str], rules: tuple[Rule, ...]) -> list[Rule]:
    """Rules by rejections per second on a sample, the best first.

    Each rule is timed on documents of its own, so that none profits from what another has worked
    out. One rejection and a microsecond are added, so that every rule has a finite rate.
    """
    rates = {}
    for rule in rules:
        began = time.perf_counter()
        rejected = sum(rule.rejects(Document(text)) for text in texts)
        rates[rule.name] = (rejected + 1) / (time.perf_counter() - began + 1e-6)
    return sorted(rules, key=lambda rule: -rates[rule.name])


def sampled_texts(df: DataFrame, text_col: str, rows: int, chars: int) -> list[str]:
    """Texts to measure costs on: about ``rows`` rows drawn from all, each cut to ``chars`` characters.

    Every row is as likely to be drawn, so no task hands over more than its share of them. The
    sample steers the order of the rules and no verdict.
    """
    share = rows / max(1, df.count())
    drawn = df.where(F.rand(seed=7) < share).select(F.substring(text_of(text_col), 1, chars))
    return [row[0] for row in drawn.collect()]


def passes(document: Document, ordered: list[Rule]) -> bool:
    """Whether no rule rejects a document; the first that does ends the cascade."""
    return not any(rule.rejects(document) for rule in ordered)


def filter_documents(
    df: DataFrame, text_col: str = "text", sample_rows: int = 200, sample_chars: int = 20_000
) -> DataFrame:
    """The rows whose text passes all rules, base rules among them, with the input's columns.

    A null text counts as empty and goes, for lack of words, as do all texts of fewer than ten
    words. Verdicts depend on the text alone, so repeated rows share theirs. An empty table gives
    an empty table.
    """
    ship_package(df.sparkSession)
    rules = BASE + RULES
    order = [
        rules.index(r)
        for r in cascade_order(sampled_texts(df, text_col, sample_rows, sample_chars), rules)
    ]

    @F.arrow_udf("boolean")
    def passing(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ordered = [(BASE + RULES)[i] for i in order]
        for batch in batches:
            yield pa.array([passes(Document(t.as_py()), ordered) for t in batch], pa.bool_())

    return df.where(passing(text_of(text_col)))


def judge_documents(
    df: DataFrame, text_col: str = "text", sample_rows: int = 200, sample_chars: int = 20_000
) -> DataFrame:
    """Every row with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed`` and ``kept``.

    Here all base counts are wanted of every document; the rules of the method still run as a
    cascade, on the documents that the base rules leave. Null and empty texts have counts of 0 and
    fail the base. An input column with the name of a result column gives way.
    """
    ship_package(df.sparkSession)
    sample = sampled_texts(df, text_col, sample_rows, sample_chars)
    order = [RULES.index(r) for r in cascade_order(sample, RULES)]
    schema = ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean"
    names = [*COUNTS, "base_failed", "kept"]

    @F.arrow_udf(schema)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ordered = [RULES[i] for i in order]
        for batch in batches:
            rows = []
            for text in batch:
                document = Document(text.as_py())
                failed = any(rule.rejects(document) for rule in BASE)
                kept = not failed and passes(document, ordered)
                rows.append((*(getattr(document, c) for c in COUNTS), failed, kept))
            columns = list(zip(*rows)) or [()] * len(names)
            types = [pa.int64()] * len(COUNTS) + [pa.bool_()] * 2
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.StructArray.from_arrays(arrays, names)

    return with_results(df, judged(text_of(text_col)), names)
