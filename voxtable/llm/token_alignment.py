"""Alignment of two tokenizers over the bytes of a text.

Byte offsets at which a token of both ends cut the tokens into groups; within a group every token of
one is linked with the tokens of the other whose bytes overlap its own.

A stretch of a text is a fragment: the tokens up to its first common end (open prefix), the groups
between common ends (closed), and the tokens after the last one (open suffix). Fragments of
neighbouring stretches compose to that of both, whatever the stretches are: the suffix of the left
and the prefix of the right make up one group. This is associative with the empty fragment as unit,
so a very long text is cut at any byte, its stretches are aligned in tasks of their own, and a tree
of compositions puts them together.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, compress
from operator import eq

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from voxtable.llm.bpe import byte_letters
from voxtable.llm.frames import ROW, join_counted, nested, restored, text_of
from voxtable.ship import ship_package
from voxtable.sources.tables import materialize

SPACE = "▁"  # stands for a space in the pieces
# Where both tokenizers start afresh whatever lies before: at a single space before a letter or digit.
CUT = re.compile(r"(?<=\S) (?=[^\W_])")
# Units remembered; then all are forgotten but for some that came again, the most frequent ones.
UNITS, KEPT = 260_000, 65_000
LEARNED = 4096  # new units given to the tokenizers at a time
TOGETHER = 500_000  # characters aligned at a time
FAN_IN = 8  # fragments composed by one group of a round
TEXT_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
PAIRS = "pairs array<bigint>, times array<int>"
NOTHING = (0, 0, 0, 0, "", "", (), ())  # the row of a text without tokens
ALIGNED = ", ".join(f"{c} bigint" for c in TEXT_COUNTS) + ", groups_sha256 string, groups string, " + PAIRS


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and how a text goes to each."""

    def __init__(self, byte_level: str, pieces: bytes):
        self._a = Tokenizer.from_str(byte_level)
        self._a.encode_special_tokens = True
        letters = byte_letters()
        labels = json.loads(byte_level)["model"]["vocab"]
        self.a_size = 1 + max(labels.values())
        self._a_bytes = [b""] * max(self.a_size, self._a.get_vocab_size())
        for label, i in labels.items():
            self._a_bytes[i] = bytes(letters[c] for c in label)
        self._b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.b_size = self._b.get_piece_size()
        names = [self._b.id_to_piece(i) for i in range(self.b_size)]
        self._b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        self._a_lengths = np.array([len(b) for b in self._a_bytes], np.int64)
        self._b_lengths = np.array([len(b) for b in self._b_bytes], np.int64)
        #: Whether no piece goes on after a space, so that texts can be cut at spaces.
        self.starts_at_spaces = not any(SPACE in p.lstrip(SPACE) for p in names)

    def encode(self, spaced: list[str]) -> tuple[np.ndarray, list[list[int]], list[list[int]]]:
        """Which texts both give back, and the ids of those by both.

        Each starts with the space that the second adds itself.
        """
        same, all_a, all_b = [], [], []
        for at in range(0, len(spaced), LEARNED):
            some = spaced[at : at + LEARNED]
            a = [e.ids for e in self._a.encode_batch_fast(some, add_special_tokens=False)]
            b = self._b.encode([s[1:] for s in some], num_threads=1)
            data = list(map(str.encode, some))
            alike = self._spell(a, self._a_bytes, data) & self._spell(b, self._b_bytes, data)
            same.append(alike)
            all_a += compress(a, alike)
            all_b += compress(b, alike)
        return np.concatenate([np.empty(0, bool), *same]), all_a, all_b

    @staticmethod
    def _spell(ids: list[list[int]], tokens: list[bytes], data: list[bytes]) -> np.ndarray:
        """Whether each list of ids spells its text."""
        spelled = [b"".join(map(tokens.__getitem__, x)) for x in ids]
        return np.fromiter(map(eq, spelled, data), bool, len(data))

    def ended(self, a: np.ndarray, b: np.ndarray) -> Tokens:
        """Tokens with the offsets at which they end."""
        return Tokens(a, np.cumsum(self._a_lengths[a]), b, np.cumsum(self._b_lengths[b]))


@dataclass
class Tokens:
    """Ids of both tokenizers with the byte offsets at which the tokens end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def between(self, low: int, high: int) -> Tokens:
        """The tokens that end after ``low`` and at ``high`` at the latest."""
        a = slice(*np.searchsorted(self.a_ends, [low, high], "right"))
        b = slice(*np.searchsorted(self.b_ends, [low, high], "right"))
        return Tokens(self.a[a], self.a_ends[a], self.b[b], self.b_ends[b])

    def moved(self, by: int) -> Tokens:
        return Tokens(self.a, self.a_ends + by, self.b, self.b_ends + by)

    @staticmethod
    def joined(parts: list[Tokens]) -> Tokens:
        columns = ([p.a for p in parts], [p.a_ends for p in parts], [p.b for p in parts], [p.b_ends for p in parts])
        return Tokens(*[np.concatenate(c) if c else np.empty(0, np.int64) for c in columns])


NO_TOKENS = Tokens(*[np.empty(0, np.int64)] * 4)


@dataclass
class Alignment:
    """Groups and links of tokens that start and end at common offsets, text by text.

    ``links`` are (place of the A token, place of the B token); ``a_group`` and ``b_group`` number
    the groups from 0.
    """

    tokens: Tokens
    a_shared: np.ndarray = field(init=False)
    a_group: np.ndarray = field(init=False)
    b_group: np.ndarray = field(init=False)
    links: tuple[np.ndarray, np.ndarray] = field(init=False)

    def __post_init__(self):
        t = self.tokens
        b_of_a = np.searchsorted(t.b_ends, t.a_ends)  # the B token that holds the last byte of each
        a_of_b = np.searchsorted(t.a_ends, t.b_ends)
        self.a_shared = t.b_ends[b_of_a] == t.a_ends
        b_shared = t.a_ends[a_of_b] == t.b_ends
        self.a_group = np.cumsum(self.a_shared) - self.a_shared
        self.b_group = np.cumsum(b_shared) - b_shared
        # Two tokens overlap in one stretch, which ends where one of them ends.
        alone = np.flatnonzero(~b_shared)
        self.links = (
            np.concatenate([np.arange(len(t.a)), a_of_b[alone]]),
            np.concatenate([b_of_a, alone]),
        )


class Writer:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a_size: int, b_size: int):
        self._a_size = a_size
        top = max(a_size, b_size)
        digits = [str(i) for i in range(top)]
        self._size = top
        self._words = [d + end for end in (",", "|", ";") for d in digits]

    def write(self, alignment: Alignment) -> tuple[list[str], np.ndarray]:
        """The pieces of text in order, and the number of pieces up to the end of each A token's
        group and its B tokens."""
        t = alignment.tokens
        n_a, n_b = len(t.a), len(t.b)
        groups = int(alignment.a_group[-1]) + 1 if n_a else 0
        a_in, b_in = (np.bincount(g, minlength=groups) for g in (alignment.a_group, alignment.b_group))
        b_before = np.cumsum(b_in) - b_in
        a_upto = np.cumsum(a_in)
        order = np.empty(n_a + n_b, np.int64)
        a_last = np.zeros(n_a, bool)
        b_last = np.zeros(n_b, bool)
        a_last[a_upto - 1] = True
        b_last[np.cumsum(b_in) - 1] = True
        order[np.arange(n_a) + b_before[alignment.a_group]] = t.a + self._size * a_last
        order[np.arange(n_b) + a_upto[alignment.b_group]] = t.b + 2 * self._size * b_last
        return list(map(self._words.__getitem__, order.tolist())), a_upto + np.cumsum(b_in)


@dataclass
class Fragment:
    """What a stretch of a text tells about its alignment.

    Without a common end in the stretch (``shared`` is false) all its tokens are in ``prefix``.
    """

    shared: bool = False
    prefix: Tokens = field(default_factory=lambda: NO_TOKENS)
    suffix: Tokens = field(default_factory=lambda: NO_TOKENS)
    closed: str = ""  # groups, each with a semicolon behind
    n_groups: int = 0
    n_links: int = 0
    pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    n_a: int = 0
    n_b: int = 0
    valid: bool = True


class Ragged:
    """Lists of numbers of different lengths, one behind the other."""

    def __init__(self, dtype=np.int32):
        self._values, self._starts = np.empty(1 << 16, dtype), np.zeros(1 << 16, np.int64)
        self._rows = 0

    def extend(self, values: np.ndarray, counts) -> None:
        used, rows = int(self._starts[self._rows]), self._rows + len(counts)
        while used + len(values) > len(self._values):
            self._values = np.concatenate([self._values, np.empty(len(self._values) // 2, self._values.dtype)])
        while rows >= len(self._starts):
            self._starts = np.concatenate([self._starts, np.empty(len(self._starts) // 2, np.int64)])
        self._values[used : used + len(values)] = values
        self._starts[self._rows + 1 : rows + 1] = used + np.cumsum(counts)
        self._rows = rows

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of some rows, and how many each has."""
        starts = self._starts[rows]
        counts = self._starts[rows + 1] - starts
        places = np.repeat(starts - (np.cumsum(counts) - counts), counts)
        return self._values[places + np.arange(len(places))].astype(np.int64), counts

    def only(self, rows: np.ndarray) -> Ragged:
        """These rows alone."""
        kept = Ragged(self._values.dtype)
        kept.extend(*self.take(rows))
        return kept


class Units:
    """Alignments of the units that texts consist of, between places to cut at.

    A unit is a small fragment without open parts, so those of a text are put side by side. Words
    come again and again, and each is aligned once.
    """

    def __init__(self, top: int):
        self.number: dict[str, int] = {}
        self.groups: list[str | None] = []  # None for a unit that has no tokens
        codes = Ragged(np.uint32 if top <= 1 << 32 else np.int64)  # of pairs, below ``top``
        self.a, self.b, self.codes, self.times = Ragged(), Ragged(), codes, Ragged()
        self.counts = Ragged()  # tokens of both, groups, links
        self._uses = np.zeros(0, np.int32)  # in how many calls

    def used(self, numbers: np.ndarray) -> None:
        if len(self._uses) < len(self.number):
            more = max(len(self.number) - len(self._uses), len(self._uses) // 2)
            self._uses = np.concatenate([self._uses, np.zeros(more, np.int32)])
        self._uses[numbers] += 1  # once, however often a number is there

    def forget(self, most: int) -> None:
        """Keep what was used more than once, and of that the ``most`` most used units."""
        uses = self._uses[: len(self.number)]
        kept = np.argsort(-uses, kind="stable")[:most]
        kept = np.sort(kept[uses[kept] > 1])
        names = list(self.number)  # in the order of their numbers
        self.number = {names[i]: n for n, i in enumerate(kept.tolist())}
        self.groups = [self.groups[i] for i in kept.tolist()]
        for name in ("a", "b", "codes", "times", "counts"):
            setattr(self, name, getattr(self, name).only(kept))
        self._uses = np.zeros(len(kept), np.int32)  # what is used no more goes next time


class Aligner:
    """Aligns texts and stretches of texts."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizers = Tokenizers(byte_level, pieces)
        self.writer = Writer(self.tokenizers.a_size, self.tokenizers.b_size)
        self._units = Units(self.tokenizers.a_size * self.tokenizers.b_size)

    def code(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One number for a pair of ids."""
        return a * self.tokenizers.b_size + b

    def _parts(self, text: str) -> list[str]:
        """The units of a text; each is read behind a space."""
        if not text:
            return []
        return CUT.split(text) if self.tokenizers.starts_at_spaces else [text]

    def _numbers(self, parts: list[str]) -> np.ndarray:
        """Numbers of units; new ones are aligned together."""
        if len(self._units.number) > UNITS:
            self._units.forget(KEPT)
        known = self._units.number
        new = [u for u in dict.fromkeys(parts) if u not in known]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
        self._units.used(numbers)
        return numbers

    def _learn(self, new: list[str]) -> None:
        units = self._units
        first = len(units.number)
        units.number.update(zip(new, range(first, first + len(new))))
        same, a, b = self.tokenizers.encode([" " + u for u in new])
        n_a, n_b = list(map(len, a)), list(map(len, b))
        tokens = self.tokenizers.ended(
            *[np.fromiter(chain.from_iterable(x), np.int64, sum(n)) for x, n in ((a, n_a), (b, n_b))]
        )
        all_a, all_b, counts = (np.zeros(len(new), np.int64) for _ in range(3))
        all_a[same], all_b[same] = n_a, n_b
        units.a.extend(tokens.a, all_a)
        units.b.extend(tokens.b, all_b)
        shown: list[str | None] = [None] * len(new)
        numbers = np.zeros((len(new), 4), np.int64)
        codes = times = np.empty(0, np.int64)
        if n_a:
            alignment = Alignment(tokens)
            words, word_ends = self.writer.write(alignment)
            a_ends = np.cumsum(n_a)
            upto = np.cumsum(alignment.a_shared)[a_ends - 1]
            at = 0
            for i, end in zip(np.flatnonzero(same).tolist(), word_ends[upto - 1].tolist()):
                shown[i] = "".join(words[at:end])
                at = end
            a_place, b_place = alignment.links
            owner = np.searchsorted(a_ends, a_place, "right")
            size = self.tokenizers.a_size * self.tokenizers.b_size
            keys = owner * size + self.code(tokens.a[a_place], tokens.b[b_place])
            keys, times = np.unique(keys, return_counts=True)
            codes = keys % size
            counts[same] = np.bincount(keys // size, minlength=len(n_a))
            links = np.bincount(owner, minlength=len(n_a))
            numbers[same] = np.stack([n_a, n_b, np.diff(upto, prepend=0), links], axis=1)
        units.groups += shown
        units.codes.extend(codes, counts)
        units.times.extend(times, counts)
        units.counts.extend(numbers.ravel(), np.full(len(new), 4))

    def texts(self, texts: list[str], with_groups: bool) -> list[tuple]:
        """Rows as in ``ALIGNED`` for whole texts, aligned together."""
        parts = list(map(self._parts, texts))
        flat = self._numbers(list(chain.from_iterable(parts)))
        units = self._units
        sizes = np.array(list(map(len, parts)), np.int64)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)
        shown = [units.groups[i] for i in flat.tolist()]
        each = units.counts.take(flat)[0].reshape(-1, 4)
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(each, axis=0)])
        sums = sums[ends] - sums[ends - sizes]
        # A unit several times in a text counts its pairs as often.
        top = len(units.number)
        held, often = np.unique(owner * top + flat, return_counts=True)
        codes, counts = units.codes.take(held % top)
        times = units.times.take(held % top)[0] * np.repeat(often, counts)
        size = self.tokenizers.a_size * self.tokenizers.b_size
        keys, place = np.unique(np.repeat(held // top, counts) * size + codes, return_inverse=True)
        totals = np.bincount(place, weights=times, minlength=len(keys)).astype(np.int64)
        key_ends = np.searchsorted(keys, np.arange(1, len(texts) + 1) * size).tolist()
        pairs = keys % size
        rows, at, key_at = [], 0, 0
        for numbers, end, key_end in zip(sums.tolist(), ends.tolist(), key_ends):
            own = shown[at:end]
            if own and None not in own:
                groups = "".join(own)[:-1]
                digest = hashlib.sha256(groups.encode()).hexdigest()
                listed = (pairs[key_at:key_end], totals[key_at:key_end])
                rows.append((*numbers, digest, groups if with_groups else None, *listed))
            else:
                rows.append(NOTHING)
            at, key_at = end, key_end
        return rows

    def tokens(self, spaced: str) -> Tokens | None:
        """Tokens of a text that starts with the space which the second tokenizer adds itself.

        None where the bytes of either are not those of the text.
        """
        flat = self._numbers(self._parts(spaced[1:]))
        if any(self._units.groups[i] is None for i in flat.tolist()):
            return None
        return self.tokenizers.ended(self._units.a.take(flat)[0], self._units.b.take(flat)[0])

    def fragment(self, window: str, offset: int, low: int, high: int) -> Fragment:
        """The fragment of the bytes from ``low`` to ``high`` of a text that starts with a space.

        ``window`` is the text around them, from ``offset`` on, between two places to cut at.
        """
        tokens = self.tokens(window)
        if tokens is None:
            return Fragment(valid=False)
        return self.of_tokens(tokens.moved(offset).between(low, high))

    def of_tokens(self, tokens: Tokens) -> Fragment:
        shared = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
        sizes = {"n_a": len(tokens.a), "n_b": len(tokens.b)}
        if not len(shared):
            return Fragment(prefix=tokens, **sizes)
        first, last = int(shared[0]), int(shared[-1])
        inner = self._closed(tokens.between(first, last))
        return Fragment(
            True, tokens.between(-1, first), tokens.between(last, 1 << 62), *inner, **sizes
        )

    def _closed(self, tokens: Tokens) -> tuple:
        """Text, number of groups, number of links, pairs and times of complete groups."""
        if not len(tokens.a):
            return "", 0, 0, np.empty(0, np.int64), np.empty(0, np.int64)
        alignment = Alignment(tokens)
        words, _ = self.writer.write(alignment)
        a_place, b_place = alignment.links
        codes = self.code(tokens.a[a_place], tokens.b[b_place])
        groups = int(alignment.a_group[-1]) + 1
        return "".join(words), groups, len(codes), *np.unique(codes, return_counts=True)

    def compose(self, left: Fragment, right: Fragment) -> Fragment:
        """The fragment of two stretches that follow each other."""
        sums = {
            "n_a": left.n_a + right.n_a,
            "n_b": left.n_b + right.n_b,
            "valid": left.valid and right.valid,
        }
        if not left.shared:
            prefix = Tokens.joined([left.prefix, right.prefix])
            return _copied(right, prefix=prefix, **sums)
        if not right.shared:
            return _copied(left, suffix=Tokens.joined([left.suffix, right.prefix]), **sums)
        text, groups, links, pairs, times = self._closed(Tokens.joined([left.suffix, right.prefix]))
        parts = [(left.pairs, left.times), (pairs, times), (right.pairs, right.times)]
        return Fragment(
            True,
            left.prefix,
            right.suffix,
            left.closed + text + right.closed,
            left.n_groups + groups + right.n_groups,
            left.n_links + links + right.n_links,
            *_added_up(parts),
            **sums,
        )

    def whole(self, fragment: Fragment, with_groups: bool) -> tuple:
        """The row, as in ``ALIGNED``, of a fragment that is a whole text."""
        if not fragment.valid or not fragment.n_a:
            return NOTHING
        start = Fragment(True)  # both tokenizations start at the first byte
        done = self.compose(start, fragment)
        groups = done.closed[:-1]
        return (
            done.n_a,
            done.n_b,
            done.n_groups,
            done.n_links,
            hashlib.sha256(groups.encode()).hexdigest(),
            groups if with_groups else None,
            done.pairs,
            done.times,
        )


def _copied(fragment: Fragment, **changes) -> Fragment:
    return Fragment(**{**fragment.__dict__, **changes})


def _added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    times = np.zeros(len(pairs), np.int64)
    np.add.at(times, place, np.concatenate([t for _, t in parts]))
    return pairs, times


def stretches(text: str, size: int) -> Iterator[tuple[int, int, int, int, str]]:
    """Cut a text with its space into stretches: (number, low, high, offset, window) in bytes.

    A stretch has ``size`` characters and ends anywhere; only where no place to cut at follows
    within that size does it go on to the next one. Its window reaches from the last place to cut
    at before it to the first one after it, so no character is in more than three windows.
    """
    spaced = " " + text
    start, number, start_bytes = 0, 0, 0
    while start < len(spaced):
        end = start + size
        if end >= len(spaced):
            end = after = len(spaced)
        else:
            cut = CUT.search(spaced, end)
            after = cut.start() if cut else len(spaced)
            if after - end > size:
                end = after
        before = _cut_before(spaced, start)
        offset = start_bytes - len(spaced[before:start].encode())
        end_bytes = start_bytes + len(spaced[start:end].encode())
        yield number, start_bytes, end_bytes, offset, spaced[before:after]
        start, start_bytes, number = end, end_bytes, number + 1


def _cut_before(spaced: str, at: int) -> int:
    """The last place to cut at that is not after ``at``; the start of the text is one."""
    while at > 0:
        at = spaced.rfind(" ", 0, at + 1)
        if at <= 0 or CUT.match(spaced, at):
            return max(at, 0)
        at -= 1
    return 0


@functools.lru_cache(maxsize=1)
def aligner(byte_level: str, pieces: bytes) -> Aligner:
    """One aligner for each Python worker."""
    return Aligner(byte_level, pieces)


def _aligned_batch(keys: pa.Array, rows: list[tuple], key: str) -> pa.RecordBatch:
    """Result rows beside the column that they belong to."""
    columns = list(zip(*rows))
    lists = []
    for values, kind in zip(columns[6:], (np.int64, np.int32)):
        offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
        flat = np.concatenate([np.asarray(v, kind) for v in values])
        lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
    arrays = [keys, *[pa.array(c, pa.int64()) for c in columns[:4]]]
    arrays += [pa.array(c, pa.string()) for c in columns[4:6]]
    names = [key, *[f.split(" ")[0] for f in ALIGNED.split(", ")]]
    return pa.RecordBatch.from_arrays([*arrays, *lists], names)


def _align_short(docs: DataFrame, sources: tuple[str, bytes], with_groups: bool) -> DataFrame:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*sources)
        for batch in batches:
            lengths = np.cumsum(batch.column(2).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                done = int(lengths[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(lengths, done + TOGETHER)))
                texts = batch.column(1).slice(at, end - at).to_pylist()
                rows = own.texts(texts, with_groups)
                yield _aligned_batch(batch.column(0).slice(at, end - at), rows, ROW)
                at = end

    read = docs.select(ROW, "text", F.length("text").alias("size"))
    fields = T.StructType.fromDDL(ALIGNED).fields
    return read.mapInArrow(align, T.StructType([docs.schema[ROW], *fields]))


def _align_long(docs: DataFrame, sources: tuple[str, bytes], with_groups: bool, size: int) -> DataFrame:
    """Stretches in tasks of their own, composed by a tree; one row for each text again."""
    stored = materialize(docs.withColumn("text_id", F.monotonically_increasing_id()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text_id", "number", "low", "high", "offset", "window"]
        for batch in batches:
            for text_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in stretches(text.as_py(), size):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, (text_id, *part)))])

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*sources)
        for batch in batches:
            for row in batch.to_pylist():
                found = own.fragment(row["window"], row["offset"], row["low"], row["high"])
                yield _fragment_batch(row["text_id"], row["number"], found)

    def compose(table):
        own = aligner(*sources)
        ordered = table.sort_by("number")
        total = Fragment()
        for data in ordered.column("fragment"):
            total = own.compose(total, pickle.loads(data.as_py()))
        row = ordered.slice(0, 1).to_pylist()[0]
        return pa.Table.from_batches([_fragment_batch(row["text_id"], row["number"] // FAN_IN, total)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*sources)
        for batch in batches:
            for text_id, data in zip(batch.column(0).to_pylist(), batch.column(2)):
                row = own.whole(pickle.loads(data.as_py()), with_groups)
                yield _aligned_batch(pa.array([text_id], pa.int64()), [row], "text_id")

    columns = "text_id bigint, number bigint, low bigint, high bigint, offset bigint, window string"
    parts = stored.select("text_id", "text").mapInArrow(cut, columns).repartition("text_id", "number")
    found = parts.mapInArrow(fragments, FRAGMENT)
    longest = stored.agg(F.max(F.length("text"))).first()[0] or 0
    left = -(-(longest + 1) // size)
    while left > 1:
        group = F.expr(f"number div {FAN_IN}").alias("group")
        found = found.groupBy("text_id", group).applyInArrow(compose, FRAGMENT)
        left = -(-left // FAN_IN)
    whole = found.mapInArrow(finish, "text_id bigint, " + ALIGNED)
    return stored.select(ROW, "text_id").join(whole, "text_id").drop("text_id")


FRAGMENT = "text_id bigint, number bigint, fragment binary"


def _fragment_batch(text_id: int, number: int, fragment: Fragment) -> pa.RecordBatch:
    columns = [pa.array([text_id], pa.int64()), pa.array([number], pa.int64())]
    columns.append(pa.array([pickle.dumps(fragment)], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["text_id", "number", "fragment"])


def align_tokens(
    df: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    text_col: str = "text",
    carry: list[str] | None = None,
    with_groups: bool = False,
    stretch: int = 32_768,
    broadcast_pairs: int = 4_000_000,
) -> DataFrame:
    """Every row (``carry`` of its columns, all unless given) with its alignment.

    ``n_a`` and ``n_b`` count the tokens, ``n_groups`` the groups, ``n_links`` the links,
    ``groups_sha256`` is the digest of the groups as ``a1,a2|b1;a3|b2,b3``, which ``with_groups``
    adds as ``groups``. The count of a pair of ids is the number of rows that link it;
    ``count_sum`` adds it up over a row's links, ``n_best`` counts the links whose pair has the
    highest count of all with that A id, ties included.

    The first tokenizer gets a space and the text, the second the text, to which it adds the space;
    the strings of special tokens are ordinary text. A text that is null or empty, or whose bytes
    either does not give back, has no tokens: zeros and an empty digest. Repeated rows count as rows.
    An input column with the name of a result column gives way; an empty table gives an empty table.

    Texts of more than ``stretch`` characters are cut and put together again by composition. The
    counts go to the tasks while there are at most ``broadcast_pairs`` different pairs (16 bytes
    each), and are joined by pair beyond that, the commonest pairs apart.
    """
    spark = df.sparkSession
    ship_package(spark)
    columns = df.columns if carry is None else carry
    with open(byte_level_path, encoding="utf-8") as a, open(pieces_path, "rb") as b:
        sources = (a.read(), b.read())
    docs = nested(df, columns, text=text_of(text_col))
    is_long = F.length("text") > stretch
    if Aligner(*sources).tokenizers.starts_at_spaces:
        short = _align_short(docs.where(~is_long), sources, with_groups)
        long = _align_long(docs.where(is_long), sources, with_groups, stretch)
        aligned = short.unionByName(long)
    else:
        aligned = _align_short(docs, sources, with_groups)
    stored = materialize(aligned.withColumn("row_id", F.monotonically_increasing_id()))

    b_size = Tokenizers(*sources).b_size
    counts = stored.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    same_a = Window.partitionBy(F.expr(f"pair div {b_size}"))  # no more rows than B has ids
    judged = counts.withColumn("best", F.col("n") == F.max("n").over(same_a))
    judged = materialize(judged)
    if judged.count() <= broadcast_pairs:
        counted = _looked_up(stored, judged)
    else:
        counted = _joined(stored, judged)
    results = [*TEXT_COUNTS, "n_best", "count_sum", "groups_sha256"]
    results += ["groups"] if with_groups else []
    return restored(counted, columns, **{c: F.col(c) for c in results})


def _looked_up(stored: DataFrame, judged: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` from a sorted table that every task has."""
    table = judged.orderBy("pair").toArrow()
    sent = stored.sparkSession.sparkContext.broadcast(
        tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            ends = np.cumsum(pairs.value_lengths().to_numpy(zero_copy_only=False))
            at = np.searchsorted(known, pairs.flatten().to_numpy())
            times = times.flatten().to_numpy().astype(np.int64)
            batch = batch.drop_columns(["pairs", "times"])
            for name, values in (("n_best", times * best[at]), ("count_sum", times * n[at])):
                upto = np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])]
                batch = batch.append_column(name, pa.array(np.diff(upto), pa.int64()))
            yield batch

    kept = [f for f in stored.schema if f.name not in ("pairs", "times")]
    more = T.StructType.fromDDL("n_best bigint, count_sum bigint").fields
    return stored.mapInArrow(look_up, T.StructType([*kept, *more]))


def _joined(stored: DataFrame, judged: DataFrame) -> DataFrame:
    """The same by a join on the pair; the commonest pairs are joined apart."""
    each = F.inline(F.arrays_zip("pairs", "times"))
    links = materialize(stored.select("row_id", each).withColumnRenamed("pairs", "pair"))
    total = links.count()
    found = join_counted(links, judged, "pair", "n", total)
    sums = found.groupBy("row_id").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    kept = stored.drop("pairs", "times").join(sums, "row_id", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("n_best", "count_sum")}
    return kept.withColumns(zero)
