"""Packing documents into training sequences of several lengths.

Each tier is a context size. A document goes to the smallest tier that holds it; longer ones are cut
into windows of the largest size first. Each tier is packed on its own, from the longest to the
shortest, and the gaps of a window are filled from the shorter tiers. A gap that no whole document
fits is filled with a piece of one.

A task packs the rows it reads and shuffles nothing, so no group of rows has to come together; what
a task cannot fill is one window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from voxtable.llm.bpe import REMEMBERED, encoder, read_vocabulary
from voxtable.llm.frames import column, text_of
from voxtable.ship import ship_package

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, window int, step_group bigint, ids binary"
)
# Documents that wait to be packed, in tokens; a bound on the memory of a task.
WAITING = 4_000_000


class Packer:
    """Packs documents into sequences whose lengths are tiers."""

    def __init__(self, tiers: tuple[int, ...], first_id: int, group_tokens: int):
        self.tiers = sorted(tiers)
        self._waiting: dict[int, list[list]] = {t: [] for t in self.tiers}  # [document, start, end]
        self.waiting_tokens = 0
        self._next = first_id
        self._group_tokens = group_tokens
        self._group, self._in_group = first_id, 0

    def add(self, document: tuple, tokens: int) -> Iterator[list[tuple]]:
        """Route a document; whole windows of the largest size are sequences at once."""
        largest, start = self.tiers[-1], 0
        while tokens - start >= largest:
            yield self._sequence([(document, start, start + largest)], largest)
            start += largest
        if start < tokens:
            self._wait(document, start, tokens)

    def _wait(self, document: tuple, start: int, end: int) -> None:
        self._waiting[self._tier(end - start)].append([document, start, end])
        self.waiting_tokens += end - start

    def _tier(self, length: int) -> int:
        return next(t for t in self.tiers if length <= t)

    def drain(self, all_of_it: bool) -> Iterator[list[tuple]]:
        """Pack what waits, the longest tier first; the last short window only at the end."""
        for tier in reversed(self.tiers):
            while self._waiting[tier] and (all_of_it or self.waiting_tokens >= tier):
                yield self._window(tier)

    def _window(self, tier: int) -> list[tuple]:
        """One window of a tier: its longest waiting piece, then what fills the gap.

        A window that cannot be filled is closed at the tier that its content fills, and what is
        over waits in a shorter tier.
        """
        size = min(tier, self._reach())
        content, free = [], size
        while free:
            document, start, end = self._take(free)
            if end - start > free:
                self._wait(document, start + free, end)
                end = start + free
            content.append((document, start, end))
            free -= end - start
        return self._sequence(content, size)

    def _reach(self) -> int:
        """The largest tier that all waiting pieces together fill, or what there is of them."""
        full = [t for t in self.tiers if t <= self.waiting_tokens]
        return full[-1] if full else self.waiting_tokens

    def _take(self, free: int) -> list:
        """A waiting piece for a gap: one from the longest tier within it, else the next longer."""
        within = [t for t in reversed(self.tiers) if t <= free and self._waiting[t]]
        longer = [t for t in self.tiers if t > free and self._waiting[t]]
        piece = self._waiting[(within or longer)[0]].pop()
        self.waiting_tokens -= piece[2] - piece[1]
        return piece

    def _sequence(self, content: list[tuple], size: int) -> list[tuple]:
        """Rows of one sequence. Sequences fill a step group up to its tokens, so that the steps
        of a training run have equal work whatever the tiers."""
        sequence, offset, rows = self._next, 0, []
        self._next += 1
        if self._in_group + size > self._group_tokens:
            self._group, self._in_group = sequence, 0
        self._in_group += size
        for document, start, end in content:
            rows.append((document, start, end, sequence, offset, size, self._group))
            offset += end - start
        return rows


def pack_documents(
    df: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    tiers: tuple[int, ...] = (256, 512, 1024, 2048),
    group_tokens: int = 16_384,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row for each piece of a document in a sequence, and each token in exactly one piece.

    A document is its ids by the tokenizers library followed by ``end_id``; a null or empty text
    is ``end_id`` alone. ``start`` and ``length`` place the piece in its document, ``sequence_id``
    and ``offset`` in a sequence; offsets are gapless from 0. All sequences have the length of a
    tier (``window``), but for the last ones of a task, which hold what it has left. Sequences of
    one ``step_group`` have ``group_tokens`` tokens in all, or as many as whole sequences allow.
    ``ids`` holds the ids of a piece on request. A Python worker keeps up to twice ``remembered`` bytes
    of words whose ids it knows, which has no part in the result.

    Rows are packed as they come, repeated ids and null ids included (``doc_id`` is null then);
    other columns of the input are left out, whatever their names. An empty table gives an empty
    table. Tasks pack their own rows, so results depend on how the input is partitioned, as the
    order of training data may; each task names its sequences from its partition's number.
    """
    if any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers have to be powers of two")
    ship_package(df.sparkSession)
    vocabulary, end = read_vocabulary(vocabulary_path), np.array([end_id], "<u4").tobytes()
    names = [field.split(" ")[0] for field in PIECES.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary, remembered)
        packer = Packer(tiers, TaskContext.get().partitionId() << 40, group_tokens)
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = own.encode(text.as_py()) + end
                for sequence in packer.add((doc_id, ids), len(ids) // 4):
                    rows += sequence
                if packer.waiting_tokens >= WAITING:
                    rows += [row for sequence in packer.drain(False) for row in sequence]
                if len(rows) >= 5000:
                    yield _batch(rows, names, with_ids)
                    rows = []
        rows += [row for sequence in packer.drain(True) for row in sequence]
        yield _batch(rows, names, with_ids)

    # One pass without a shuffle: the columns that the packing reads go to Python and no others.
    read = df.select(column(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    packed = read.mapInArrow(pack, PIECES)
    return packed if with_ids else packed.drop("ids")


def _batch(rows: list[tuple], names: list[str], with_ids: bool) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in names]
    for (doc_id, ids), start, end, sequence, offset, size, group in rows:
        piece = ids[4 * start : 4 * end]
        values = (
            doc_id,
            start,
            end - start,
            zlib.crc32(piece),
            len(ids) // 4,
            sequence,
            offset,
            size,
            group,
            piece if with_ids else None,
        )
        for values_of, value in zip(columns, values):
            values_of.append(value)
    types = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
