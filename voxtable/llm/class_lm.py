"""Scoring by a class-based bigram model in the manner of Brown et al., clustered by exchange.

``P(text)`` is the product of ``P(class | class before) * P(word | class)``. Words are exchanged among
classes as long as that raises the likelihood of the training text, in three steps that take in all
of them. The most frequent words are exchanged one after another on the driver, by their bigram
counts. Then all words with more than a fixed share of the tokens, whose number is bounded whatever
the size of the corpus, are exchanged at once, in rounds: tasks count for each word the classes
beside it, and a word moves to the class that gains most. Then every rarer word joins the class that
gains most by it, from the classes beside it in the whole training text; these words and their
classes are a Spark table. A word for which no class gains stays in the class of rare words, as do
words that training has not seen.

Texts are encoded in blocks, each with a list of the different rare words in it. So a word is
joined once for each block, not for each place, and a block's classes come back as one row.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtable.llm.frames import column, nested, restored, text_of
from voxtable.ship import ship_package
from voxtable.sources.tables import materialize

END, RARE = 0, 1  # codes of the end and of all rare words, and the classes of the end and the unseen
FIXED = 2
END_WORD = ""  # no word is empty


def words_of(text: str) -> list[bytes]:
    """Words in lower case; bytes know A-Z and the ASCII white space only."""
    return text.encode().lower().split()


def word_counts(texts: DataFrame, held: int = 200_000) -> DataFrame:
    """``(word, n)`` over all texts, the end of each text as an empty word.

    A task counts before it shuffles, and hands over what it has at ``held`` different words.
    """

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts.keys()), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [words, pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts[END_WORD.encode()] += batch.num_rows
            for text in batch.column(0):
                counts.update(words_of(text.as_py()))
                if len(counts) >= held:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    counted = texts.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


#: What a block of texts is stored with, in the row of its first text.
PAYLOAD = (
    "words array<string>, lengths array<int>, trained array<boolean>, codes binary, rare binary"
)
# A block ends with the text that reaches this number of tokens, or with a batch of rows. The larger
# it is, the fewer times a word is joined; a worker holds some 30 bytes a token of one block.
BLOCK_TOKENS = 2_000_000
# What a worker works on at a time, beside what it keeps of a block. Arrays of these sizes stay with it
# after they are freed.
PART_TOKENS, ASSIGNED = 250_000, 500
# Snappy takes buffers of the size of a value outside the heap, of which each task leaves some behind.
STORED = {"compression": "zstd"}


def encode_blocks(rows: DataFrame, frequent: Broadcast, dtype: str) -> DataFrame:
    """``(row, is_training, block, at)`` of each text of ``rows``, and ``PAYLOAD`` in one of a block.

    ``words`` are the different rare words of the block, ``codes`` those of all tokens, text after
    text, ``rare`` the places in ``words`` of the tokens of code ``RARE``; ``lengths`` and
    ``trained`` have an entry for each text.
    """
    fields = T.StructType.fromDDL("block bigint, at int, " + PAYLOAD).fields
    schema = T.StructType([rows.schema[c] for c in ("row", "is_training")] + fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {word.encode(): i + FIXED for i, word in enumerate(frequent.value)}
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            start, texts = 0, batch.column(2)
            while start < batch.num_rows:
                local: defaultdict[bytes, int] = defaultdict()
                local.default_factory = local.__len__
                codes, rare, lengths, end = [], [], [], start
                size = 0
                while end < batch.num_rows and size < BLOCK_TOKENS:
                    words = words_of(texts[end].as_py())
                    found = [code.get(w, RARE) for w in words]
                    rare.append(np.array([local[w] for w, c in zip(words, found) if c == RARE], "<u4"))
                    codes.append(np.array([*found, END], dtype))
                    lengths.append(len(found) + 1)
                    size += lengths[-1]
                    end += 1
                count = end - start
                rest = [None] * (count - 1)
                flags = batch.column(1).slice(start, count).to_pylist()
                own_words = pa.array(list(local), pa.binary()).cast(pa.string())
                nulls = pa.nulls(count - 1, pa.list_(pa.string()))
                first = pa.ListArray.from_arrays(pa.array([0, len(own_words)], pa.int32()), own_words)
                payload = [
                    pa.concat_arrays([first, nulls]),
                    pa.array([lengths, *rest], pa.list_(pa.int32())),
                    pa.array([flags, *rest], pa.list_(pa.bool_())),
                    pa.array([np.concatenate(codes).tobytes(), *rest], pa.binary()),
                    pa.array([np.concatenate(rare).tobytes(), *rest], pa.binary()),
                ]
                own = [batch.column(0).slice(start, count), batch.column(1).slice(start, count)]
                own += [pa.array([block] * count), pa.array(range(count), pa.int32())]
                yield pa.RecordBatch.from_arrays([*own, *payload], schema.names)
                start, block = end, block + 1

    return rows.select("row", "is_training", "text").mapInArrow(encode, schema)


class Block:
    """Tokens of some texts of a block: codes, and what the rare ones are."""

    def __init__(self, codes: np.ndarray, rare: np.ndarray, lengths: np.ndarray, trained: np.ndarray):
        self.codes, self.lengths = codes.astype(np.int64), lengths
        self.trained = np.repeat(trained, lengths)
        self.rare_at = np.flatnonzero(self.codes == RARE)
        self.rare = rare.astype(np.int64)

    def pairs(
        self, kinds: np.ndarray, of_rare: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The kind of every token with the kind before it; an end stands before a text.

        ``kinds`` maps codes to kinds, ``of_rare`` the block's rare words.
        """
        now = kinds[self.codes]
        if of_rare is not None:
            now[self.rare_at] = of_rare[self.rare]
        return np.concatenate([kinds[[END]], now[:-1]]), now  # texts end with END


def _blocks(
    batches: Iterator[pa.RecordBatch], dtype: str, part_tokens: int = PART_TOKENS
) -> Iterator[tuple[pa.RecordBatch, int, Block]]:
    """Row of a block, number of its first text, and tokens of some of its texts after another."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            codes = np.frombuffer(row.column("codes")[0].as_buffer(), dtype)
            rare = np.frombuffer(row.column("rare")[0].as_buffer(), "<u4")
            lengths = row.column("lengths")[0].values.to_numpy().astype(np.int64)
            trained = row.column("trained")[0].values.to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            first = at = rare_at = 0
            while first < len(lengths):
                last = max(first + 1, int(np.searchsorted(ends, at + part_tokens, "right")))
                own = codes[at : ends[last - 1]]
                rare_end = rare_at + int(np.count_nonzero(own == RARE))
                texts = slice(first, last)
                yield row, first, Block(own, rare[rare_at:rare_end], lengths[texts], trained[texts])
                first, at, rare_at = last, int(ends[last - 1]), rare_end


class Found:
    """Class and count of the rare words of a block, by their places in its list."""

    def __init__(self):
        self._block, self._known = None, (np.empty(0, np.int64),) * 2

    def of(self, row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        block = row.column("block")[0].as_py()
        if block != self._block:
            size = row.column("n_rare")[0].as_py()
            classes, counts = np.full(size, RARE, np.int64), np.zeros(size, np.int64)
            known = row.column("found")[0].values
            if known is not None:
                place = known.field("place").to_numpy()
                classes[place] = known.field("class").to_numpy()
                counts[place] = known.field("n").to_numpy()
            self._block, self._known = block, (classes, counts)
        return self._known


def _counted(cells: DataFrame, size: int) -> np.ndarray:
    """A table of ``size`` cells from (cell, n) rows, each task's own."""
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # ``size`` at most
    total = np.zeros(size, np.int64)
    total[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return total


TOKENS = ["lengths", "trained", "codes", "rare"]


def bigram_counts(blocks: DataFrame, dtype: str, kinds: np.ndarray) -> np.ndarray:
    """How often one kind follows another in training, where ``kinds`` maps codes to a few kinds.

    Blocks with ``found``, what is known of their rare words, count these by their classes.
    """
    size = int(kinds.max()) + 1
    joined = "found" in blocks.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        found = Found()
        for row, _, block in _blocks(batches, dtype):
            before, now = block.pairs(kinds, found.of(row)[0] if joined else None)
            pairs = (before * size + now)[block.trained]
            total += np.bincount(pairs, minlength=size * size)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    columns = [*TOKENS, "block", "n_rare", "found"] if joined else TOKENS
    cells = blocks.select(columns).mapInArrow(count, "cell bigint, n bigint")
    return _counted(cells, size * size).reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_gains(
    table: np.ndarray, right: np.ndarray, left: np.ndarray, itself: np.ndarray, own: np.ndarray
) -> np.ndarray:
    """Gain in log likelihood of some words in each class, once taken out of their own.

    ``table`` counts classes after classes. Row ``i`` of ``right`` and ``left`` counts the classes
    after and before word ``i``, other than itself; ``itself`` counts it after itself, and ``own``
    is its class, or -1 for one that is in none.
    """
    words, classes = right.shape
    rest = np.repeat(table[None].astype(np.float64), words, axis=0)
    inside = np.flatnonzero(own >= 0)
    rest[inside, own[inside], :] -= right[inside]
    rest[inside, :, own[inside]] -= left[inside]
    rest[inside, own[inside], own[inside]] -= itself[inside]
    rest = np.maximum(rest, 0)
    f = _xlogx
    each = np.arange(classes)
    same, after, before = rest[:, each, each], right[:, None, :], left[:, None, :]
    columns = rest.transpose(0, 2, 1)
    gain = (f(rest + after) - f(rest)).sum(axis=2) + (f(columns + before) - f(columns)).sum(axis=2)
    gain -= f(same + right) + f(same + left) - 2 * f(same)
    gain += f(same + right + left + itself[:, None]) - f(same)
    # Whichever class a word is in, it stays behind and before what it was behind and before.
    out, into = rest.sum(axis=2) + left, rest.sum(axis=1) + right
    n_out, n_in = (right.sum(axis=1) + itself)[:, None], (left.sum(axis=1) + itself)[:, None]
    return gain - (f(out + n_out) - f(out)) - (f(into + n_in) - f(into))


def exchange_seeds(counts: np.ndarray, classes: int, passes: int) -> np.ndarray:
    """Classes of the most frequent words from their bigram counts, one move after another.

    ``counts`` is over ``END``, all other words, and then the seeds by frequency. Stops early when
    a pass moves nothing.
    """
    total = classes + FIXED
    of = np.array([END, RARE, *(FIXED + i % classes for i in range(len(counts) - FIXED))])
    table = np.zeros((total, total))
    np.add.at(table, (of[:, None], of[None, :]), counts)
    for _ in range(passes):
        moved = 0
        for word in range(FIXED, len(counts)):
            own, itself = of[word], counts[word, word]
            right = np.bincount(of, counts[word], total)
            left = np.bincount(of, counts[:, word], total)
            right[own] -= itself
            left[own] -= itself
            gains = exchange_gains(
                table, right[None], left[None], np.array([itself]), np.array([own])
            )[0]
            best = FIXED + int(gains[FIXED:].argmax())
            if best != own and gains[best] > gains[own] + 1e-9:
                for place, sign in ((own, -1), (best, 1)):
                    table[place, :] += sign * right
                    table[:, place] += sign * left
                    table[place, place] += sign * itself
                of[word], moved = best, moved + 1
        if not moved:
            break
    return of


def log_likelihood(table: np.ndarray) -> float:
    """What the classes add to the log likelihood of the training text."""
    f = _xlogx
    return float(f(table).sum() - f(table.sum(axis=0)).sum() - f(table.sum(axis=1)).sum())


def exchange_round(
    blocks: DataFrame, dtype: str, of: np.ndarray, table: np.ndarray
) -> np.ndarray:
    """Move every frequent word to its best class, all at once; the classes after that.

    ``of`` maps codes to classes and ``table`` counts these after each other. The counts of
    classes beside a word are summed up in each task first. An empty class takes no word: it would
    look best to all of them at once.
    """
    total, codes, usable = len(table), len(of), usable_classes(table)
    names = [f"{side}{c}" for side in ("after", "before") for c in range(total)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = np.zeros((2, codes * total), np.int64)
        for _, _, block in _blocks(batches, dtype):
            before, code = (x[block.trained] for x in block.pairs(np.arange(codes)))
            beside[0] += np.bincount(before * total + of[code], minlength=codes * total)
            beside[1] += np.bincount(code * total + of[before], minlength=codes * total)
        found = np.concatenate(beside.reshape(2, codes, total), axis=1)
        seen = FIXED + np.flatnonzero(found[FIXED:].any(axis=1))
        for part in np.array_split(seen, max(1, len(seen) // 10_000)):
            columns = [pa.array(part), *(pa.array(found[part, k]) for k in range(2 * total))]
            yield pa.RecordBatch.from_arrays(columns, ["code", *names])

    schema = ", ".join(f"{c} bigint" for c in ["code", *names])
    sums = (
        blocks.select(TOKENS)
        .mapInArrow(count, schema)
        .groupBy("code")
        .agg(*[F.sum(c).alias(c) for c in names])
    )

    def move(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in (frame[i : i + 500] for i in range(0, len(frame), 500)):
                code = part["code"].to_numpy(np.int64)
                beside = part[names].to_numpy(np.float64)
                right, left = beside[:, :total], beside[:, total:]
                gains = exchange_gains(table, right, left, np.zeros(len(code)), of[code])
                best = np.where(usable, gains, -np.inf).argmax(axis=1)
                yield pd.DataFrame({"code": code, "best": best})

    moved = sums.mapInPandas(move, "code bigint, best bigint").toPandas()  # the frequent words
    found = of.copy()
    found[moved["code"].to_numpy(np.int64)] = moved["best"].to_numpy(np.int64)
    return found


def usable_classes(table: np.ndarray) -> np.ndarray:
    """Classes that words can join; an empty one would look best to all of them at once."""
    usable = (table.sum(axis=1) > 0) & (np.arange(len(table)) >= FIXED)
    return usable if usable.any() else np.arange(len(table)) >= FIXED


def class_counts(blocks: DataFrame, dtype: str, of: np.ndarray, total: int) -> np.ndarray:
    """How often one class follows another, over all ``total`` classes."""
    kinds = np.concatenate([of, [total - 1]])  # the last is no code and makes the table whole
    return bigram_counts(blocks, dtype, kinds).astype(np.float64)


def joining_gains(
    table: np.ndarray, starts: np.ndarray, cell: np.ndarray, n: np.ndarray
) -> np.ndarray:
    """Gain in log likelihood of rare words in each class, once taken out of the rare one.

    The words' neighbours are listed word after word, from ``starts``: ``n`` of class ``cell`` after
    the word, or of class ``cell - len(table)`` before it.
    """
    f, total = _xlogx, len(table)
    after, k = cell < total, cell % total
    there = np.where(after[:, None], table[:, k].T, table[k, :]).astype(np.float64)
    there[:, RARE] -= n
    there = np.maximum(there, 0)
    gained = f(there + n[:, None]) - f(there)
    gained[np.arange(len(k)), k] = 0  # beside a word of its own class: both sides are one cell
    gain = np.add.reduceat(gained, starts, axis=0)
    both = np.zeros((len(starts), total))
    np.add.at(both, (np.repeat(np.arange(len(starts)), np.diff([*starts, len(k)])), k), n)
    same = np.repeat(np.diag(table)[None].astype(np.float64), len(starts), axis=0)
    same[:, RARE] = np.maximum(same[:, RARE] - both[:, RARE], 0)
    gain += f(same + both) - f(same)
    for side, sums in ((after, table.sum(axis=1)), (~after, table.sum(axis=0))):
        own = np.add.reduceat(np.where(side, n, 0), starts)[:, None]
        whole = np.repeat(sums[None].astype(np.float64), len(starts), axis=0)
        whole[:, [RARE]] -= own
        whole = np.maximum(whole, 0)
        gain -= f(whole + own) - f(whole)
    return gain


def beside_rare(block: Block, kinds: np.ndarray, total: int) -> np.ndarray:
    """``2 * total`` times the word, and the class after it or ``total`` and the class before it, of
    the rare words of training texts, one number for each neighbour."""
    inside = block.trained[block.rare_at]
    at, word = block.rare_at[inside], block.rare[inside] * (2 * total)
    ends = np.concatenate([[END], block.codes])  # one stands before a text
    # A text does not end with a rare word.
    return np.concatenate([word + kinds[block.codes[at + 1]], word + (total + kinds[ends[at]])])


def assigned_words(blocks: DataFrame, dtype: str, of: np.ndarray, table: np.ndarray) -> DataFrame:
    """``(word, n, class)`` of all rare words of the training text.

    A task counts a block's neighbours by word and class before it shuffles; a word has two numbers
    for each class at most, whatever its number of places.
    """
    total, usable = len(table), usable_classes(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = of.astype(np.int32)
        for _, parts in groupby(_blocks(batches, dtype), key=lambda part: id(part[0])):
            found = []
            for row, _, block in parts:
                found.append(beside_rare(block, kinds, total))
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            del found
            words, starts = np.unique(keys // (2 * total), return_index=True)
            offsets = pa.array(np.append(starts, len(keys)).astype(np.int32))
            beside = [
                pa.ListArray.from_arrays(offsets, pa.array((keys % (2 * total)).astype(np.int16))),
                pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))),
            ]
            words = row.column("words")[0].values.take(pa.array(words))
            yield pa.RecordBatch.from_arrays([words, *beside], ["word", "cell", "n"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ASSIGNED):
                part = batch.slice(at, ASSIGNED)
                beside, counts = part.column(1), part.column(1).value_lengths().to_numpy()
                flat = beside.flatten()
                cell = flat.field("cell").to_numpy().astype(np.int64)
                n = flat.field("n").to_numpy().astype(np.float64)
                starts = np.cumsum(counts) - counts
                gains = joining_gains(table, starts, cell, n)
                best = np.where(usable, gains, -np.inf).argmax(axis=1)
                rows = np.arange(len(best))
                best = np.where(gains[rows, best] > gains[:, RARE] + 1e-9, best, RARE)
                own = np.add.reduceat(np.where(cell < total, n, 0), starts).astype(np.int64)
                found = [part.column(0), pa.array(own), pa.array(best.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(found, ["word", "n", "class"])

    # One exchange, by word: none has more than one in so many tokens, so none is hot.
    counted = blocks.select("words", *TOKENS).mapInArrow(
        count, "word string, cell array<smallint>, n array<int>"
    )
    beside = (
        counted.repartition("word")
        .select("word", F.inline(F.arrays_zip("cell", "n")))
        .groupBy("word", "cell")
        .agg(F.sum("n").alias("n"))
        .groupBy("word")
        .agg(F.collect_list(F.struct(F.col("cell").cast("int").alias("cell"), "n")).alias("beside"))
    )
    return beside.mapInArrow(assign, "word string, n bigint, class int")


def with_classes(blocks: DataFrame, assigned: DataFrame) -> DataFrame:
    """Blocks with ``found``: place, class and count of those of their ``n_rare`` rare words that
    training has seen.

    A word is one row for each block that has it, so none is a key of many rows.
    """
    one = blocks.select("block", F.posexplode("words").alias("place", "word"))
    looked_up = one.join(assigned, "word")
    found = F.collect_list(F.struct("place", "class", "n")).alias("found")
    counted = blocks.withColumn("n_rare", F.size("words")).drop("words")
    return counted.join(looked_up.groupBy("block").agg(found), "block", "left")


@dataclass
class ClassModel:
    """Logarithms to the base 10 by code and class, and what rare words need beside them."""

    of: np.ndarray  # class of each code
    transitions: np.ndarray
    emissions: np.ndarray  # of each code; 0 for END, and for RARE, whose words differ
    base: np.ndarray  # of each code; 0 for RARE
    counts: np.ndarray  # of each code
    of_class: np.ndarray  # tokens of each class
    rare_mass: float  # tokens and words of the rare class, and one for the unseen
    tokens: int
    words: int

    def rare_emissions(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of rare words: their share of their class, where in the rare class every word counts
        once more than it occurs."""
        rare = classes == RARE
        whole = np.where(rare, self.rare_mass, np.maximum(self.of_class[classes], 1))
        return np.log10((counts + rare) / whole)

    def rare_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.words + 1))


def class_model(
    of: np.ndarray,
    table: np.ndarray,
    counts: np.ndarray,
    tokens: int,
    words: int,
    rare: tuple[np.ndarray, np.ndarray] | None = None,
) -> ClassModel:
    """Smoothed probabilities from the counts of classes and frequent words.

    Transitions are mixed with class frequencies, as if there were one more of each class behind
    every class. ``rare`` holds the tokens and the words that rare words add to each class; without
    it all of them are in the rare class. In that class every word counts once more than it occurs,
    and so does one that stands for the unseen.
    """
    classes = len(table)
    alone = (table.sum(axis=0) + 1) / (table.sum() + classes)
    transitions = (table + classes * alone) / (table.sum(axis=1, keepdims=True) + classes)
    if rare is None:
        kinds = words - int(np.count_nonzero(counts)) + int(counts[RARE] > 0)
        rare = (np.bincount([RARE], [counts[RARE]], classes), np.bincount([RARE], [kinds], classes))
    frequent = np.delete(np.arange(len(of)), RARE)
    of_class = np.bincount(of[frequent], counts[frequent], classes) + rare[0]
    emissions = np.zeros(len(of))
    emissions[FIXED:] = np.log10(counts[FIXED:] / of_class[of[FIXED:]])
    base = np.log10((counts + 1) / (tokens + words + 1))
    base[RARE] = 0
    stayed = (of == RARE) & (np.arange(len(of)) >= FIXED)  # frequent words that no class took
    mass = float(rare[0][RARE] + rare[1][RARE]) + 1 + float((counts[stayed] + 1).sum())
    emissions[stayed] = np.log10((counts[stayed] + 1) / mass)
    logs = np.log10(transitions)
    return ClassModel(of, logs, emissions, base, counts, of_class, mass, tokens, words)


def scored_texts(blocks: DataFrame, dtype: str, model: ClassModel) -> DataFrame:
    """``(block, at, n_tokens, n_known, base, score)`` of each text."""
    schema = "block bigint, at int, n_tokens bigint, n_known bigint, base double, score double"
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_of = Found()
        for row, first, block in _blocks(batches, dtype):
            classes, counts = known_of.of(row)
            before, now = block.pairs(model.of, classes)
            of_word, base = model.emissions[block.codes], model.base[block.codes]
            known = model.counts[block.codes] > 0
            of_word[block.rare_at] = model.rare_emissions(classes, counts)[block.rare]
            base[block.rare_at] = model.rare_base(counts)[block.rare]
            known[block.rare_at] = (counts > 0)[block.rare]
            steps = model.transitions[before, now] + of_word
            starts = np.cumsum(block.lengths) - block.lengths
            sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), base, steps)]
            size = len(starts)
            found = [pa.array(np.repeat(row.column("block").to_numpy(), size))]
            found.append(pa.array(np.arange(first, first + size, dtype=np.int32)))
            found += [pa.array(block.lengths), *(pa.array(x) for x in sums)]
            yield pa.RecordBatch.from_arrays(found, names)

    return blocks.mapInArrow(run, schema)


def score_texts(
    df: DataFrame,
    is_training: Column,
    text_col: str = "text",
    carry: list[str] | None = None,
    classes: int = 32,
    passes: int = 10,
    rounds: int = 2,
    seed_share: int = 2048,
    frequent_share: int = 1 << 18,
) -> DataFrame:
    """Every row with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``perplexity``.

    Tokens are the words of the lower-cased text (A-Z, split at ASCII white space) and one end. The
    model learns from the rows for which ``is_training`` holds; null is no. ``base_score`` is the
    add-one unigram model's, ``score`` the class model's logarithm of the text's probability to the
    base 10. A null or empty text is one end. Repeated rows count and are scored like any other.
    Without training rows no token is known and the base score is 0. An empty table gives an empty
    table. Returns the columns of ``carry`` (all by default) before the results; an input column
    with the name of a result gives way.

    All words have a place among ``classes`` classes: those with more than one in ``frequent_share``
    tokens by exchange, those with more than one in ``seed_share`` first, and all others by what is
    beside them. As shares of the whole these numbers bound what the driver and a task hold; they
    steer how a word's class is found, not whether it has one.
    """
    ship_package(df.sparkSession)
    columns = df.columns if carry is None else carry
    training = F.coalesce(is_training, F.lit(False))
    counts = materialize(word_counts(df.where(training).select(text_of(text_col).alias("text"))))
    tokens, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    is_frequent = (F.col("n") * frequent_share > F.lit(tokens)) & (F.col("word") != END_WORD)
    known = counts.where(is_frequent).toPandas()  # fewer than frequent_share words
    known = known.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    n_end = counts.where(F.col("word") == END_WORD).agg(F.sum("n")).first()[0] or 0
    of_code = np.array([n_end, tokens - n_end - known["n"].sum(), *known["n"]], np.float64)
    dtype = "<u2" if len(of_code) < 1 << 16 else "<u4"

    shared = df.sparkSession.sparkContext.broadcast(known["word"].tolist())
    rows = nested(df, columns, is_training=training, text=text_of(text_col))
    encoded = materialize(encode_blocks(rows, shared, dtype), **STORED)
    blocks = encoded.where("codes IS NOT NULL").drop("row", "is_training", "at")
    codes = np.arange(len(of_code))
    seeds = FIXED + int((known["n"] * seed_share > tokens).sum())
    of = np.full(len(of_code), RARE)
    seeded = bigram_counts(blocks, dtype, np.where(codes < seeds, codes, RARE))
    of[:seeds] = exchange_seeds(seeded, classes, passes)[:seeds]
    table = class_counts(blocks, dtype, of, classes + FIXED)
    for _ in range(rounds if len(known) else 0):
        moved = exchange_round(blocks, dtype, of, table)
        after = class_counts(blocks, dtype, moved, classes + FIXED)
        if log_likelihood(after) <= log_likelihood(table):
            break  # words that moved at the same time got in each other's way
        of, table = moved, after

    assigned = materialize(assigned_words(blocks, dtype, of, table), **STORED)
    joined = materialize(with_classes(blocks, assigned), **STORED)
    table = class_counts(joined, dtype, of, classes + FIXED)
    added = assigned.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    rare = np.zeros((2, classes + FIXED))
    for r in added:
        rare[:, r["class"]] = r["n"], r["words"]
    model = class_model(of, table, of_code, tokens, words, (rare[0], rare[1]))
    kept = encoded.select("row", "is_training", "block", "at")
    return restored(
        kept.join(scored_texts(joined, dtype, model), ["block", "at"]),
        columns,
        held_out=~F.col("is_training"),
        n_tokens=F.col("n_tokens"),
        n_known=F.col("n_known"),
        train_tokens=F.lit(tokens).cast("bigint"),
        base_score=F.col("base"),
        score=F.col("score"),
        perplexity=F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")),
    )
