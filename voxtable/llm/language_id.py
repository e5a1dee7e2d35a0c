"""Language identification by cross-parsing: how few phrases of a language make up a text.

Each language has the suffix automaton of passages that are known to be in it. A text is parsed from
left to right into the longest phrases that occur in those passages: from the start state arcs are
followed while there are any, and where there is none a new phrase starts. A phrase costs the
logarithm of the size of the passages, which is what a pointer to it takes (Ziv and Merhav's
cross-parsing). The language with the lowest cost wins.

The next state and whether a phrase starts are functions of state and byte alone, so they are one
table, and many texts are parsed side by side, byte after byte. A long text is cut into chunks. Each
starts in the state that the bytes before it lead to, and where that is not the state in which the
chunk before ended, it is parsed again from there: the phrases are those of the whole text.
"""

from __future__ import annotations

import functools
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import column, text_of, with_results
from voxtable.ship import ship_package

UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
LETTERS_ONLY = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
PASSAGE = 512  # characters of a training passage
CHUNK, BEFORE = 1024, 48  # bytes parsed in one go, and those that lead into a chunk
SIDE_BY_SIDE = 4_000_000  # bytes parsed at a time, but for a longer text

#: A language and the passages it was learned from.
Passages = tuple[tuple[str, tuple[str, ...]], ...]


class SuffixAutomaton:
    """The smallest automaton that reads all substrings of a sequence of symbols.

    ``arcs[state * symbols + symbol]`` is the next state, -1 for none; state 0 is the start.
    """

    def __init__(self, sequence: list[int], symbols: int):
        nowhere = array("i", [-1] * symbols)
        self.arcs, self.symbols = array("i", nowhere), symbols
        arcs, link, length, last = self.arcs, [-1], [0], 0
        for symbol in sequence:
            state, at = len(link), last
            arcs.extend(nowhere)
            link.append(0)
            length.append(length[last] + 1)
            while at >= 0 and arcs[at * symbols + symbol] < 0:
                arcs[at * symbols + symbol] = state
                at = link[at]
            if at >= 0:
                following = arcs[at * symbols + symbol]
                if length[following] == length[at] + 1:
                    link[state] = following
                else:
                    copy = len(link)
                    arcs.extend(arcs[following * symbols : (following + 1) * symbols])
                    link.append(link[following])
                    length.append(length[at] + 1)
                    while at >= 0 and arcs[at * symbols + symbol] == following:
                        arcs[at * symbols + symbol] = copy
                        at = link[at]
                    link[following] = link[state] = copy
            last = state
        self.states = len(link)


def normalised(text: str) -> bytes:
    """Lower case in UTF-8, where one space stands for ASCII characters that are no letters."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS_ONLY).split())


class CrossParser:
    """Parses texts by the automata of all languages at once."""

    def __init__(self, passages: Passages):
        self.languages = [language for language, _ in passages]
        known = [[normalised(t) for t in texts] for _, texts in passages]
        letters = sorted(set().union(*map(set, (t for texts in known for t in texts))))
        other = len(letters)  # a byte that no passage has, and what stands between passages
        self._symbols = np.full(256, other, np.uint8 if other < 256 else np.uint16)
        self._symbols[letters] = np.arange(other)
        width, first, tables, starts = other + 1, 0, [], []
        for texts in known:
            sequence = [s for t in texts for s in (*self._symbols[list(t)].tolist(), other)]
            own = SuffixAutomaton(sequence, width)
            arcs = np.frombuffer(own.arcs, np.int32).reshape(own.states, width).copy()
            arcs[:, other] = -1
            known_at_start = arcs[0] >= 0
            # Without an arc a phrase ends, unless none has begun; a byte that no phrase can start
            # with is one of its own.
            ended = (np.arange(own.states) > 0).astype(int)[:, None] + (~known_at_start)[None, :]
            phrases = np.where(arcs >= 0, 0, ended)
            target = np.where(arcs >= 0, arcs, np.where(known_at_start, arcs[0], 0))
            tables.append((((target + first) * width) << 2 | phrases).astype(np.int32).ravel())
            starts.append(first * width)
            first += own.states
        self._table = np.concatenate([np.empty(0, np.int32), *tables])
        self._starts = np.array(starts, np.int32)
        self._bits = np.array([math.log2(1 + sum(map(len, texts))) for texts in known])

    def _parse(self, data, starts, lengths, states) -> tuple[np.ndarray, np.ndarray]:
        """Last state and phrases begun before it, for each language and stretch of the data."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        states = np.ascontiguousarray(states[:, order])
        phrases = np.zeros(states.shape, np.int32)
        longest = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(longest), "left")
        for step, n in enumerate(active.tolist()):
            found = self._table.take(states[:, :n] + data[starts[:n] + step])
            phrases[:, :n] += found & 3
            np.right_shift(found, 2, out=states[:, :n])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return states[:, back], phrases[:, back]

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of phrases of every text, a row for each language."""
        sizes = np.array([len(t) for t in texts], np.int64)
        data = self._symbols[np.frombuffer(b"".join(texts), np.uint8)].astype(np.int32)
        ends = np.cumsum(sizes)
        chunks = -(-sizes // CHUNK)
        text = np.repeat(np.arange(len(texts)), chunks)
        number = np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        starts = (ends - sizes)[text] + number * CHUNK
        lengths = np.minimum(CHUNK, ends[text] - starts)
        states = np.repeat(self._starts[:, None], len(text), axis=1)
        later = np.flatnonzero(number > 0)
        led = np.full(len(later), BEFORE)
        states[:, later], _ = self._parse(data, starts[later] - BEFORE, led, states[:, later])
        last, counts = self._parse(data, starts, lengths, states)
        while True:
            wrong = later[(states[:, later] != last[:, later - 1]).any(axis=0)]
            if not len(wrong):
                break
            states[:, wrong] = last[:, wrong - 1]
            last[:, wrong], counts[:, wrong] = self._parse(
                data, starts[wrong], lengths[wrong], states[:, wrong]
            )
        total = np.zeros((len(self.languages), len(texts)), np.int64)
        for row, own in zip(total, counts):
            np.add.at(row, text, own)
        final = np.cumsum(chunks)[sizes > 0] - 1
        total[:, sizes > 0] += last[:, final] != self._starts[:, None]
        return total

    def languages_of(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of every text."""
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        bits = self.phrases([normalised(t) for t in texts]) * self._bits[:, None]
        best = np.argmin(bits, axis=0)  # of equal ones the first by name
        shares = np.exp2(np.maximum(bits.min(axis=0, keepdims=True) - bits, -1000.0))
        scores = 1.0 / shares.sum(axis=0)
        return [
            (self.languages[i], score) if LETTER.search(t) else (UNDETERMINED, 0.0)
            for t, i, score in zip(texts, best.tolist(), scores.tolist())
        ]


@functools.lru_cache(maxsize=1)
def parser(passages: Passages) -> CrossParser:
    """One parser for each Python worker."""
    return CrossParser(passages)


def learn_languages(
    df: DataFrame,
    is_training: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_chars: int = 200_000,
    max_languages: int = 64,
) -> Passages:
    """Passages of every language, drawn by hash from the whole texts of all training rows.

    A bounded sample of the labelled rows: ``sample_chars`` characters in all, shared out evenly
    among the languages, of which the ``max_languages`` with the most text count. All passages of
    a language are as likely to be drawn, whatever the row, the source or the place in the text they
    come from; a passage that many rows hold is drawn once. Rows without text or language teach
    nothing.
    """
    text, lang = text_of(text_col), column(lang_col).cast("string")
    labelled = df.where(is_training & lang.isNotNull() & (F.length(text) > 0)).select(
        lang.alias("lang"), text.alias("text")
    )
    labelled = labelled.withColumn("n", F.ceil(F.length("text") / PASSAGE).cast("int"))
    sizes = labelled.groupBy("lang").agg(F.sum("n").alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    if not sizes:
        return ()
    wanted = max(1, sample_chars // (PASSAGE * len(sizes)))
    drawn = wanted + 4 * math.isqrt(wanted) + 8  # so that seldom fewer than wanted are drawn
    buckets = 1 << 40
    bound = F.create_map(
        *[x for r in sizes for x in (F.lit(r.lang), F.lit(min(buckets, buckets * drawn // r.n)))]
    )

    def place(i: Column) -> Column:
        return F.pmod(F.xxhash64("own", i), F.lit(buckets))

    chosen = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: place(i) < F.col("bound"))
    passages = F.transform(
        chosen,
        lambda i: F.struct(
            place(i).alias("place"),
            F.substr("text", i * PASSAGE + 1, F.lit(PASSAGE)).alias("passage"),
        ),
    )
    drawn_rows = (
        labelled.withColumn("bound", F.try_element_at(bound, F.col("lang")))
        .where(F.col("bound").isNotNull())
        .withColumn("own", F.xxhash64("text"))
        .select("lang", F.inline(passages))
        .groupBy("lang", "passage")
        .agg(F.min("place").alias("place"))
    )
    found: dict[str, list[tuple[int, str]]] = {}
    for row in drawn_rows.collect():
        found.setdefault(row.lang, []).append((row.place, row.passage))
    return tuple(
        (lang, tuple(p for _, p in sorted(rows)[:wanted])) for lang, rows in sorted(found.items())
    )


def predict_languages(
    df: DataFrame,
    is_training: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_chars: int = 200_000,
    max_languages: int = 64,
) -> DataFrame:
    """Every row with ``held_out``, ``lang_pred`` and ``score``.

    Learned from the rows for which ``is_training`` holds, see ``learn_languages`` for the bounds of
    the sample; all others are ``held_out``, those for which it is null included. ``lang_pred`` is a
    learned language, of equally cheap ones the first by name, or ``und`` with score 0.0 where the
    text is null or has no letter, or nothing was learned. ``score`` is the probability that the
    costs in bits give to it against the others. Whole texts are parsed. Repeated rows get the same
    result; an input column with the name of a result column gives way; an empty table gives an
    empty table.
    """
    ship_package(df.sparkSession)
    learned = learn_languages(df, is_training, text_col, lang_col, sample_chars, max_languages)

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = parser(learned)
        for batch in batches:
            rows: list[tuple[str, float]] = []
            waiting, size = [], 0
            for text in batch:
                waiting.append(text.as_py())
                size += len(waiting[-1])
                if size >= SIDE_BY_SIDE:
                    rows += own.languages_of(waiting)
                    waiting, size = [], 0
            if waiting:
                rows += own.languages_of(waiting)
            arrays = [pa.array([r[0] for r in rows], pa.string())]
            arrays.append(pa.array([r[1] for r in rows], pa.float64()))
            yield pa.StructArray.from_arrays(arrays, ["lang_pred", "score"])

    held_out = ~F.coalesce(is_training, F.lit(False))
    marked = df.select("*", F.struct(held_out.alias("held_out")).alias("\0held"))
    result = predicted(text_of(text_col))
    both = F.struct(
        column("\0held").getField("held_out").alias("held_out"),
        result.getField("lang_pred").alias("lang_pred"),
        result.getField("score").alias("score"),
    )
    return with_results(marked, both, ["held_out", "lang_pred", "score"]).drop(column("\0held"))
