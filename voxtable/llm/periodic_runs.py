"""Periodic runs of words, found by catching squares at completed blocks as words are appended.

A stream keeps catchers over its completed blocks of 8, 16, 32, ... words. The catcher of a block of
``b`` words waits for the block to come again ``b`` to ``2 b - 1`` words further on (that of the
smallest blocks also for nearer copies): with every appended word, the ``b`` words that end there
are compared with the two blocks that can be that far behind, by a hash that is known for every
stretch of the stream. A block that came again is a piece of a stretch that equals itself ``q``
words further on. Extended to both sides it is a square as soon as it is ``q`` words long, and
squares of one period that overlap merge into a run.

This is Leung, Peng and Ting's way to watch a growing string ("An efficient algorithm for online
square detection") for runs of three periods or more: a run of period ``q`` with ``b <= q < 2 b``
equals itself over ``2 q`` words or more, and any ``2 b - 1`` words hold a whole aligned block of
``b``. So no run is missed. Hashes only say where to look; a run counts after its words were compared.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import text_of, with_results
from voxtable.ship import ship_package

WORD = re.compile("[^\x20\x09-\x0d]+")
RUN = "struct<start: bigint, length: bigint, period: bigint>"
FIELDS = {
    "n_words": "bigint",
    "n_runs": "bigint",
    "start": "bigint",
    "length": "bigint",
    "period": "bigint",
    "exponent_milli": "bigint",
    "runs": f"array<{RUN}>",
    "collapsed": "string",
}
# Documents share a stream up to this number of words; longer ones have one of their own and are
# appended in pieces of as many words. A bound on memory, not on what is compared.
STREAM_WORDS = 1 << 17
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Powers:
    """Powers of the hash's base and of its inverse, as many as the longest stream needed."""

    def __init__(self):
        self._grow(1 << 12)

    def _grow(self, size: int) -> None:
        self.up, self.down = (
            np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, x, np.uint64))])
            for x in (BASE, INVERSE)
        )

    def upto(self, size: int) -> Powers:
        if size >= len(self.up):
            self._grow(max(size, 2 * len(self.up)))
        return self


_POWERS = Powers()


def scattered(ids: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every number (splitmix64)."""
    x = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SquareCatcher:
    """Runs of a growing stream of numbered words.

    ``append`` returns the squares caught with the new words or extended by them, as (start, end,
    period) rows, and ``runs`` all runs so far; a square that is no part of a run may go unseen. A run is a stretch with smallest period ``q`` of at least
    ``least`` words and ``exponent`` periods that no neighbouring word extends.
    """

    def __init__(
        self, capacity: int, least: int = 24, exponent: int = 3, longest: int | None = None
    ):
        if exponent < 3 or least < 1:
            raise ValueError("a run has at least three periods and one word")
        self.least, self.exponent = least, exponent
        self.longest = capacity if longest is None else longest  # no run is longer than that
        self.words = np.empty(capacity, np.int64)
        self._prefix = np.zeros(capacity + 1, np.uint64)
        self._powers = _POWERS.upto(capacity)
        self.size = 0
        # The smallest blocks must fit into every stretch that equals itself up to 2 b - 1 words on.
        self._smallest = 1 << max(0, ((least + 2) // 3).bit_length() - 1)
        self._ends: dict[tuple[int, int], int] = {}  # (start, period) of a run: its end
        self._open = np.empty((0, 2), np.int64)  # (place, period) of stretches that reach the end

    def _hashes(self, starts: np.ndarray, length) -> np.ndarray:
        """Hash of the ``length`` words from each start, the same wherever they stand."""
        there = self._prefix[starts + length] - self._prefix[starts]
        return there * self._powers.down[starts]

    def append(self, words: np.ndarray) -> np.ndarray:
        old, new = self.size, self.size + len(words)
        self.words[old:new] = words
        terms = scattered(words) * self._powers.up[old:new]
        self._prefix[old + 1 : new + 1] = self._prefix[old] + np.cumsum(terms, dtype=np.uint64)
        self.size = new
        reached, self._open = self._open, self._open[:0]
        squares = [self._extended(reached)]
        block = self._smallest
        while block == self._smallest or self.exponent * block <= min(new, self.longest):
            places = self._caught(block, old, new)
            squares.append(self._extended(places[~self._covered(places, block)]))
            block *= 2
        caught = np.unique(np.concatenate(squares), axis=0)
        return caught[caught[:, 1] > old]

    def _caught(self, block: int, old: int, new: int) -> np.ndarray:
        """(place, period) of the blocks that came again with a word from ``old`` on."""
        first = max(0, (old - block + 1) // block - 1) * block
        count = new - block + 1 - first
        if count <= 0:
            return np.empty((0, 2), np.int64)
        rows = -(-count // block)
        windows = np.zeros(rows * block, np.uint64)
        windows[:count] = (
            self._prefix[first + block : new + 1] - self._prefix[first : new + 1 - block]
        ) * self._powers.down[first : new + 1 - block]
        windows = windows.reshape(rows, block)
        again = windows[1:] == windows[:-1, :1]
        row, shift = np.nonzero(again)
        places, periods = first + row * block, shift + block
        if block == self._smallest and block > 1:
            row, shift = np.nonzero(windows[:, 1:] == windows[:, :1])
            places = np.concatenate([places, first + row * block])
            periods = np.concatenate([periods, shift + 1])
        inside = places + periods + block <= new  # the rest of the last row is no words
        recent = places + periods + block > old  # what older words hold was caught with them
        chosen = inside & recent
        order = np.argsort(periods[chosen], kind="stable")
        return np.stack([places[chosen][order], periods[chosen][order]], axis=1)

    def _covered(self, places: np.ndarray, block: int) -> np.ndarray:
        """Whether block and copy lie in a known run whose period is the block's size at most.

        Then that period divides the distance, and the stretch is that run.
        """
        if not len(places):
            return np.zeros(0, bool)
        known = sorted((s, e) for (s, q), e in self._ends.items() if q <= block)
        if not known:
            return np.zeros(len(places), bool)
        starts, ends = np.array(known, np.int64).T
        at = np.searchsorted(starts, places[:, 0], "right") - 1
        reach = np.maximum.accumulate(ends)[at]
        return (at >= 0) & (reach >= places[:, 0] + places[:, 1] + block)

    def _extended(self, places: np.ndarray) -> np.ndarray:
        """Squares around places that equal those a period further on; runs are kept."""
        if not len(places):
            return np.empty((0, 3), np.int64)
        start, period = places[:, 0], places[:, 1]
        right = start + self._alike(start, start + period, self.size)
        left = start - self._alike(start, start + period, None)
        ends = right + period
        grow = np.stack([left, period], axis=1)[ends == self.size]  # they may with the next words
        self._open = np.unique(np.concatenate([self._open, grow]), axis=0)
        squares = np.unique(np.stack([left, ends, period], axis=1), axis=0)
        squares = squares[squares[:, 1] - squares[:, 0] >= 2 * squares[:, 2]]
        for start, end, period in squares.tolist():
            if end - start >= max(self.least, self.exponent * period):
                self._keep(start, end, period)
        return squares

    def _alike(self, left: np.ndarray, right: np.ndarray, end: int | None) -> np.ndarray:
        """How many words from two places on are alike, or before them where ``end`` is None."""
        found = np.zeros(len(left), np.int64)
        for bit in range(max(1, self.size.bit_length()), -1, -1):
            step = 1 << bit
            if end is None:
                fits = np.flatnonzero(found + step <= left)
                a, b = (x[fits] - found[fits] - step for x in (left, right))
            else:
                fits = np.flatnonzero(right + found + step <= end)
                a, b = (x[fits] + found[fits] for x in (left, right))
            same = self._hashes(a, step) == self._hashes(b, step)
            found[fits[same]] += step
        return found

    def _keep(self, start: int, end: int, period: int) -> None:
        """Keep a run after its words were compared; should hashes have lied, what is true of it."""
        same = self.words[start : end - period] == self.words[start + period : end]
        if same.all():
            self._ends[start, period] = end
            return
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        for first, last in edges.reshape(-1, 2).tolist():
            if last - first + period >= max(self.least, self.exponent * period):
                self._ends[start + first, period] = start + last + period

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, end, smallest period) of every run, by start, then period."""
        smallest: dict[tuple[int, int], int] = {}
        for (start, period), end in sorted(self._ends.items(), key=lambda x: x[0][1]):
            smallest.setdefault((start, end), period)
        return sorted((s, e, q) for (s, e), q in smallest.items())


def split_words(text: str) -> list[str]:
    return WORD.findall(text)


def runs_of_texts(
    texts: list[list[str]], least: int = 24, exponent: int = 3
) -> list[list[tuple[int, int, int]]]:
    """(start, end, period) of the runs of every list of words.

    All of them are one stream, in which a number that occurs once ends each document.
    """
    starts = np.concatenate([[0], np.cumsum([len(words) + 1 for words in texts])])
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    stream = np.empty(int(starts[-1]), np.int64)
    for i, words in enumerate(texts):
        at, end = int(starts[i]), int(starts[i + 1]) - 1
        stream[at:end] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        stream[end] = -1 - i
    catcher = SquareCatcher(len(stream), least, exponent, max(map(len, texts), default=0))
    for at in range(0, len(stream), STREAM_WORDS):
        catcher.append(stream[at : at + STREAM_WORDS])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in catcher.runs():
        i = int(np.searchsorted(starts, start, "right")) - 1
        base = int(starts[i])
        found[i].append((start - base, end - base, period))
    return found


def collapsed_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words but for those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, end, period in runs:
        change[start + period] += 1
        change[end] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def _result(words: list[str], runs: list[tuple[int, int, int]]) -> tuple:
    best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    shown = (None,) * 4
    if best is not None:
        start, end, period = best
        shown = (start, end - start, period, 1000 * (end - start) // period)
    listed = [{"start": s, "length": e - s, "period": q} for s, e, q in runs]
    return len(words), len(runs), *shown, listed, " ".join(collapsed_words(words, runs))


def find_runs(
    df: DataFrame, text_col: str = "text", least: int = 24, exponent: int = 3
) -> DataFrame:
    """Every row with its runs of repeated words and its text without the repetition.

    ``runs`` lists (start, length, period) by start, then period, in words numbered from 0;
    ``n_runs`` counts them. ``start``, ``length``, ``period`` and ``exponent_milli`` (1000 times
    length by period, rounded down) are those of the run with the most periods, of equal ones the
    first, null without a run. ``collapsed`` joins the words with one space, without those that any
    run holds after its first period.

    Words are what is between white space (space and 0x09 to 0x0D). A null or empty text has no
    words, no run and an empty ``collapsed``. Rows are independent of each other, repeated rows
    included; an input column with the name of a result column gives way; an empty table gives an
    empty table. Texts of any length are searched whole.
    """
    ship_package(df.sparkSession)
    schema = ", ".join(f"{name} {kind}" for name, kind in FIELDS.items())
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    types = [*[pa.int64()] * 6, pa.list_(run_type), pa.string()]

    @F.arrow_udf(schema)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows: list[tuple] = []
            waiting: list[list[str]] = []
            size = 0

            def search() -> None:
                for words, runs in zip(waiting, runs_of_texts(waiting, least, exponent)):
                    rows.append(_result(words, runs))
                waiting.clear()

            for text in batch:
                words = split_words(text.as_py())
                if size + len(words) > STREAM_WORDS and waiting:
                    search()
                    size = 0
                waiting.append(words)
                size += len(words)
            search()
            columns = list(zip(*rows)) or [()] * len(FIELDS)
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.StructArray.from_arrays(arrays, list(FIELDS))

    return with_results(df, found(text_of(text_col)), list(FIELDS))
