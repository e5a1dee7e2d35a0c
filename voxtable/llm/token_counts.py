"""Token counts of every prefix of a text, by dynamic programming over BPE tokens.

Within a word the count of a prefix is the count of a shorter prefix plus one, where the shorter
prefix is the one that BPE leaves before its last token. Over words the counts add up. From the
counts stored for every prefix of a word and after every word of a text, truncation and budget
questions are answered without encoding again.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from itertools import accumulate, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.llm.bpe import (
    REMEMBERED,
    SEPARATORS,
    WORDS,
    Remembered,
    Vocabulary,
    read_vocabulary,
)
from voxtable.llm.frames import text_of, with_results
from voxtable.ship import ship_package

RESULT = "n_bytes bigint, n_tokens bigint, over_limit boolean, chars_in_limit bigint"


class PrefixCounts:
    """Counts for one text: of every prefix that ends with a word, and within any word."""

    def __init__(self, counter: Counter, text: str):
        self._counter = counter
        self.words: list[str] = []
        self._starts: list[tuple[int, int, str]] = []  # first word, characters before, part
        at = 0
        counts: list[int] = []
        for special, part in counter.vocabulary.parts(text):
            normalized = part if special is not None else counter.vocabulary.normalized(part)
            self._starts.append((len(self.words), at, normalized))
            at += len(normalized)
            words = [part] if special is not None else counter.vocabulary.words(normalized)
            self.words += words
            counts += [1] if special is not None else [c[-1] for c in map(counter.of_word.__getitem__, words)]
        self.chars = at
        #: Tokens of the first k words, for every k.
        self.after_words = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])

    @property
    def total(self) -> int:
        return int(self.after_words[-1])

    def chars_within(self, budget: int) -> int:
        """Characters of the longest prefix of the normalized text with ``budget`` tokens at most.

        Normalized is composed and in lower case, which seldom changes a length. White space has
        no tokens. A special token counts as a whole or not at all.
        """
        whole = int(np.searchsorted(self.after_words, budget, "right")) - 1
        if whole >= len(self.words):
            return self.chars
        left = budget - int(self.after_words[whole])
        index = max(i for i, (first, _, _) in enumerate(self._starts) if first <= whole)
        first, before, part = self._starts[index]
        word = self.words[whole]
        at = before + _word_start(part, whole - first)
        if word in self._counter.vocabulary.special:
            return at
        within = self._counter.of_word[word]
        return at + max((i for i, n in enumerate(within, 1) if n <= left), default=0)


def _word_start(part: str, k: int) -> int:
    """Where the k-th word of a text starts."""
    if SEPARATORS.search(part):
        return next(islice(WORDS.finditer(part), k, None)).start()
    return len(part) - len(part.split(None, k)[k])


class Counter:
    """Counts tokens with a bounded memory of words, each with the counts of all its prefixes."""

    def __init__(self, text: str, remembered: int = REMEMBERED):
        self.vocabulary = Vocabulary(text)
        automaton = self.vocabulary.automaton
        self._lexicon = ahocorasick.Automaton()
        for word in automaton.inner.keys() | automaton.final.keys():
            both = (len(word), automaton.inner.get(word, -1), automaton.final.get(word, -1))
            self._lexicon.add_word(word.decode("latin-1"), both)
        self._lexicon.make_automaton()
        self.of_word = Remembered(self._of_new_word, remembered)

    def _counts(self, piece: bytes) -> list[int]:
        """Tokens of ``piece[:at]`` as a word of its own, for every ``at`` from 1.

        Two counts for each prefix, in one pass: as the start of a longer word and as a whole word.
        Each is that of a shorter prefix as a start and one more, namely of the prefix that BPE
        leaves before the last token.
        """
        size = len(piece) + 1
        last, inner, whole = [-1] * size, [0] * size, [0] * size
        follows = self.vocabulary.automaton.follows
        for end, (length, token, final) in self._lexicon.iter(piece.decode("latin-1")):
            at = end + 1
            before = at - length
            left = last[before]
            if token >= 0 and last[at] < 0 and (not before or follows(left, token)):
                last[at], inner[at] = token, inner[before] + 1
            if final >= 0 and not whole[at] and (not before or follows(left, final)):
                whole[at] = inner[before] + 1
        return whole[1:]

    def _of_new_word(self, word: str) -> bytes | array:
        """Tokens of every prefix of a word, from one character to all of them.

        A prefix is split like the word, but for its last piece, which is cut. A cut contraction
        is no contraction: its apostrophe and its letters are pieces of their own. A word of several
        pieces adds up what is remembered of these as words.
        """
        pieces, counts = self.vocabulary.pieces(word), []
        if len(pieces) > 1:
            for piece in pieces:
                before = counts[-1] if counts else 0
                counts += [before + n for n in self.of_word[piece]]
        elif pieces:
            ends = accumulate(map(utf8_length, word)) if not word.isascii() else range(1, len(word) + 1)
            found = self._counts(word.encode())
            counts = [found[e - 1] for e in ends]
            if len(word) > 1 and word[0] == "'" and word[1].isalpha():
                mark, letters = self.of_word["'"][-1], self.of_word[word[1:]]
                counts = [mark, *[mark + n for n in letters[:-1]], counts[-1]]
        return bytes(counts) if max(counts, default=0) < 256 else array("I", counts)


def utf8_length(character: str) -> int:
    return len(character.encode())


@functools.lru_cache(maxsize=2)
def counter(text: str) -> Counter:
    """One counter for each Python worker."""
    return Counter(text)


def count_tokens(
    df: DataFrame, vocabulary_path: str, text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """Every row with ``n_bytes``, ``n_tokens``, ``over_limit`` and ``chars_in_limit``.

    ``n_tokens`` is the count of the tokenizers library for the whole text, without added special
    tokens, but with the strings of special tokens in a text as those tokens, as is its default.
    ``over_limit`` says whether it is more than ``limit``, ``chars_in_limit`` how many characters
    of the normalized text fit into the limit. A null text counts as empty: 0 bytes, 0 tokens. Rows
    are independent of each other, repeated rows included; an input column with the name of a
    result column gives way; an empty table gives an empty table.
    """
    ship_package(df.sparkSession)
    vocabulary = read_vocabulary(vocabulary_path)
    names = ["n_bytes", "n_tokens", "over_limit", "chars_in_limit"]

    @F.arrow_udf(RESULT)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(vocabulary)
        for batch in batches:
            rows = []
            for text in (scalar.as_py() for scalar in batch):  # one text's counts at a time
                prefixes = PrefixCounts(own, text)
                total, fit = prefixes.total, prefixes.chars_within(limit)
                rows.append((len(text.encode()), total, total > limit, fit))
            columns = list(zip(*rows)) or [()] * len(names)
            types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.StructArray.from_arrays(arrays, names)

    return with_results(df, counted(text_of(text_col)), names)
