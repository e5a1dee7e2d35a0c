"""Quality classifier: a convolutional network over bytes, trained and run in numpy.

Filters see every byte of a document. Their outputs are pooled by maximum over chunks that overlap
by half, a small dense layer judges each chunk, and the mean of the judgements is the document's.
"""

from __future__ import annotations

import dataclasses
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import column, text_of, with_results
from voxtable.ship import ship_package

WIDTH = 6  # bytes that a filter sees
HOP = 256  # chunks are two hops long and start at every hop
FILTERS = 32
HIDDEN = 24


@dataclass
class Network:
    """``taps[k, byte]`` is what a byte at offset ``k`` adds to each filter: a byte embedding and
    the filters' weights on it, multiplied out."""

    taps: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return Network(
            normal(WIDTH, 256, FILTERS, scale=0.3),
            np.zeros(FILTERS, np.float32),
            normal(FILTERS, HIDDEN, scale=FILTERS**-0.5),
            np.zeros(HIDDEN, np.float32),
            normal(HIDDEN, scale=HIDDEN**-0.5),
            np.zeros(1, np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in dataclasses.fields(self)]

    def filtered(self, data: np.ndarray) -> np.ndarray:
        """Outputs of all filters at every byte; the end sees zero bytes beyond it."""
        padded = np.concatenate([data, np.zeros(WIDTH - 1, np.uint8)])
        total = np.take(self.taps[0], padded[: len(data)], axis=0)
        for k in range(1, WIDTH):
            total += np.take(self.taps[k], padded[k : k + len(data)], axis=0)
        return total

    def chunk_maxima(self, data: np.ndarray, block: int = 32) -> np.ndarray:
        """Maximum of every filter in every chunk, a few hops at a time."""
        hops = []
        for begin in range(0, len(data), block * HOP):
            total = self.filtered(data[begin : begin + block * HOP + WIDTH - 1])[: block * HOP]
            hops.append(np.maximum.reduceat(total, range(0, len(total), HOP)))
        hops = np.concatenate(hops)
        return hops if len(hops) == 1 else np.maximum(hops[:-1], hops[1:])

    def judged(self, maxima: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pooled features, hidden layer and logit of each chunk."""
        pooled = np.maximum(maxima + self.bias, 0)
        hidden = np.maximum(pooled @ self.dense + self.dense_bias, 0)
        return pooled, hidden, hidden @ self.out + self.out_bias[0]

    def score(self, text: bytes) -> float:
        """Probability of label 1; an empty text is one zero byte."""
        data = np.frombuffer(text or b"\0", np.uint8)
        logit = float(self.judged(self.chunk_maxima(data))[2].mean(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def chunks_of(text: bytes, most: int) -> list[bytes]:
    """Up to ``most`` chunks in random order, drawn from the whole text, the same for equal texts."""
    starts = np.arange(0, max(1, len(text) - HOP), HOP)
    drawn = np.random.default_rng(zlib.crc32(text)).permutation(starts)[:most]
    return [text[s : s + 2 * HOP] for s in drawn.tolist()]


def _turn(chunks: list[bytes], epoch: int, size: int) -> list[bytes]:
    """The chunks that an epoch learns from: the next ones, from the start again after the last."""
    if len(chunks) <= size:
        return chunks
    return [chunks[i % len(chunks)] for i in range(epoch * size, (epoch + 1) * size)]


def train(
    documents: list[tuple[list[bytes], int, float]], epochs: int, chunks: int = 6, seed: int = 5
) -> Network:
    """Fit a network to (chunks, label, weight) by Adam on batches of documents.

    An epoch takes ``chunks`` chunks of each document, the next one others.
    """
    rng = np.random.default_rng(seed)
    network = Network.fresh(rng)
    params = network.arrays()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    size, step = 32, 0
    steps = epochs * -(-len(documents) // size)
    for epoch in range(epochs):
        order = rng.permutation(len(documents))
        for begin in range(0, len(order), size):
            drawn = [documents[i] for i in order[begin : begin + size]]
            batch = [(_turn(parts, epoch, chunks), label, weight) for parts, label, weight in drawn]
            step += 1
            rate = 0.01 * (1 - step / (steps + 1))
            for p, g, m, v in zip(params, _gradients(network, batch), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                scale = np.sqrt(v / (1 - 0.99**step)) + 1e-8
                p -= rate * (m / (1 - 0.9**step)) / scale
    return network


def _gradients(network: Network, batch: list[tuple[list[bytes], int, float]]) -> list[np.ndarray]:
    """Gradients of the weighted log loss; only the place of each maximum carries one back."""
    chunks = [c for parts, _, _ in batch for c in parts]
    counts = np.array([len(parts) for parts, _, _ in batch])
    owner = np.repeat(np.arange(len(batch)), counts)
    x = np.zeros((len(chunks), 2 * HOP + WIDTH - 1), np.uint8)
    inside = np.zeros((len(chunks), 2 * HOP, 1), bool)
    for i, chunk in enumerate(chunks):
        x[i, : len(chunk)] = np.frombuffer(chunk, np.uint8)
        inside[i, : max(1, len(chunk))] = True
    total = np.take(network.taps[0], x[:, : 2 * HOP], axis=0)
    for k in range(1, WIDTH):
        total += np.take(network.taps[k], x[:, k : k + 2 * HOP], axis=0)
    total = np.where(inside, total, -np.inf)
    at = total.argmax(axis=1)
    pooled, hidden, logits = network.judged(np.take_along_axis(total, at[:, None], 1)[:, 0])
    logit = np.bincount(owner, logits, len(batch)) / counts
    labels = np.array([label for _, label, _ in batch])
    weights = np.array([weight for _, _, weight in batch])
    slope = weights * (1 / (1 + np.exp(-logit)) - labels) / len(batch)
    of_chunk = (slope / counts)[owner].astype(np.float32)
    of_hidden = np.outer(of_chunk, network.out) * (hidden > 0)
    of_pooled = (of_hidden @ network.dense.T) * (pooled > 0)
    taps = np.zeros_like(network.taps)
    rows, filters = np.arange(len(chunks))[:, None], np.arange(FILTERS)[None, :]
    for k in range(WIDTH):
        np.add.at(taps[k], (x[rows, at + k], filters), of_pooled)
    return [
        taps,
        of_pooled.sum(axis=0),
        pooled.T @ of_hidden,
        of_hidden.sum(axis=0),
        hidden.T @ of_chunk,
        np.array([of_chunk.sum()], np.float32),
    ]


def labelled_sample(
    df: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    per_label: int,
    chunks: int,
) -> list[tuple[list[bytes], int, float]]:
    """``per_label`` documents of each label at most, by the hash of their id, with ``chunks`` chunks
    of each, all of them where a text has no more.

    Weighted by how often a label occurs, so that scores are probabilities. Null labels and labels
    other than 0 and 1 are left out; of rows with the same id and label one is used.
    """

    ship_package(df.sparkSession)

    @F.arrow_udf("array<binary>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [chunks_of(text.as_py().encode(), chunks) for text in batch]
            yield pa.array(rows, pa.list_(pa.binary()))

    known = labels.select(column(id_col).alias("id"), column(label_col).alias("label"))
    known = known.where("id IS NOT NULL AND label IN (0, 1)")
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    drawn = [
        # Twice as many by their hash, so that no task hands over more however many there are.
        known.where((F.col("label") == label) & (F.pmod(F.xxhash64("id"), F.lit(n)) < 2 * per_label))
        .orderBy(F.xxhash64(F.lit("order"), "id"), "id")
        .limit(per_label)
        for label, n in sorted(total.items())
    ]
    if not drawn:
        return []
    texts = df.select(column(id_col).alias("id"), text_of(text_col).alias("text"))
    found = texts.join(F.broadcast(reduce(DataFrame.union, drawn).distinct()), "id")
    cuts = found.select("id", "label", cut("text").alias("chunks"))
    rows = cuts.groupBy("id", "label").agg(F.min("chunks").alias("chunks")).collect()
    used = {label: sum(r["label"] == label for r in rows) for label in total}
    share = {k: n / sum(total.values()) * len(rows) / max(1, used[k]) for k, n in total.items()}
    rows.sort(key=lambda r: (r["label"], str(r["id"]), r["chunks"]))
    return [([bytes(c) for c in r["chunks"]], r["label"], share[r["label"]]) for r in rows]


def score_documents(df: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """Every row with ``score``, from the whole text alone; a null text counts as empty."""
    ship_package(df.sparkSession)
    weights = network.arrays()

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Network(*weights)
        for batch in batches:
            yield pa.array([own.score(text.as_py().encode()) for text in batch], pa.float64())

    return with_results(df, F.struct(scored(text_of(text_col)).alias("score")), ["score"])


def classify(
    df: DataFrame,
    labels: DataFrame,
    is_training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
    per_label: int = 1500,
    chunks: int = 6,
    epochs: int = 12,
) -> DataFrame:
    """Every row with ``held_out``, ``score`` and ``predicted``.

    The network learns from rows of ``labels`` for which ``is_training`` holds (a condition on the
    id), ``per_label`` of each label at most and ``chunks`` chunks of each: these bound the sample
    that the driver trains on. Scores come from whole texts and nothing else. Rows with a null id
    are held out; repeated rows share their score; without labelled rows every score is that of an
    untrained network. An input column with the name of a result column gives way.
    """
    sample = labelled_sample(
        df, labels.where(is_training), id_col, text_col, label_col, per_label, chunks * epochs
    )
    network = train(sample, epochs, chunks)
    named = df.select(
        F.struct(*[column(c).alias(c) for c in df.columns]).alias("document"),
        text_of(text_col).alias("body"),
        (~F.coalesce(is_training, F.lit(False))).alias("held_out"),
    )
    scored = score_documents(named, network, "body")
    results = {
        "held_out": F.col("held_out"),
        "score": F.col("score"),
        "predicted": (F.col("score") >= threshold).cast("int"),
    }
    kept = [c for c in df.columns if c.lower() not in results]
    return scored.select(
        *[F.col("document").getField(c).alias(c) for c in kept],
        *[value.alias(name) for name, value in results.items()],
    )
