"""The quality network and the class model: held-out accuracy, brute force and invariants."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers
from voxtable.llm import class_lm, quality_model, queries
from voxtable.sources import tables

LARGE = "/root/testdata/sf0.1"


def _held_out(doc_id, divisor, remainder):
    return zlib.crc32(str(doc_id).encode()) % divisor == remainder


def _is_training():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0


def test_quality_on_held_out_documents(spark):
    rows = queries.queries()["op2_quality_model"](spark, LARGE).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    assert len(rows) == 10_000
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == _held_out(r.doc_id, 5, 0) for r in rows)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    positive = np.array([s for s, _, q in held if q])
    negative = np.array([s for s, _, q in held if not q])
    area = np.mean(positive[:, None] > negative[None, :])
    assert area > 0.97
    assert np.mean([p == q for _, p, q in held]) > 0.95
    assert np.mean([p for _, p, q in held if q]) > 0.98


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = helpers.documents(spark)
    labels = spark.read.parquet(f"{helpers.SF_DIR}/labels.parquet")
    flipped = labels.withColumn(
        "quality", F.when(_is_training(), F.col("quality")).otherwise(1 - F.col("quality"))
    )
    small = {"per_label": 40, "epochs": 2}
    one = quality_model.classify(docs, labels, _is_training(), **small)
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "n_chars": F.lit(0)})
    two = quality_model.classify(other, flipped, _is_training(), **small)
    scores = [{r.doc_id: r.score for r in df.select("doc_id", "score").collect()} for df in (one, two)]
    assert scores[0] == scores[1]


def test_a_score_covers_the_whole_text():
    network = quality_model.Network.fresh(np.random.default_rng(1))
    data = np.random.default_rng(2).integers(1, 255, 5000).astype(np.uint8)
    maxima = network.chunk_maxima(data, block=3)
    every = network.filtered(data)
    assert len(maxima) == math.ceil(len(data) / quality_model.HOP) - 1
    for i, chunk in enumerate(maxima):
        start = i * quality_model.HOP
        assert np.allclose(chunk, every[start : start + 2 * quality_model.HOP].max(axis=0))
    text = data.tobytes()
    changed = text[:-9] + bytes(b ^ 85 for b in text[-9:])
    assert network.score(text) != network.score(changed)
    assert 0 < network.score(b"") < 1 and 0 < network.score(b"a") < 1


@pytest.mark.parametrize("size", [0, 1, 5, 256, 257, 512, 513, 1500])
def test_score_by_a_plain_forward_pass(size):
    """Every chunk, filter and byte by itself: what a document's score is made of."""
    rng = np.random.default_rng(size)
    network = quality_model.Network.fresh(rng)
    network.bias[:], network.dense_bias[:], network.out_bias[:] = (
        rng.normal(0, 0.5, x.shape) for x in (network.bias, network.dense_bias, network.out_bias)
    )
    text = rng.integers(32, 127, size).astype(np.uint8).tobytes()
    data = text or b"\0"
    hops = -(-len(data) // 256)
    logits = []
    for chunk in range(max(1, hops - 1)):
        tops = np.full(quality_model.FILTERS, -np.inf)
        for i in range(256 * chunk, min(len(data), 256 * chunk + 512)):
            seen = [data[i + k] if i + k < len(data) else 0 for k in range(quality_model.WIDTH)]
            tops = np.maximum(tops, sum(network.taps[k, byte] for k, byte in enumerate(seen)))
        pooled = [max(0.0, float(t + b)) for t, b in zip(tops, network.bias)]
        hidden = [
            max(0.0, sum(p * w for p, w in zip(pooled, network.dense[:, j])) + network.dense_bias[j])
            for j in range(quality_model.HIDDEN)
        ]
        logits.append(sum(h * w for h, w in zip(hidden, network.out)) + network.out_bias[0])
    expected = 1 / (1 + math.exp(-sum(logits) / len(logits)))
    assert network.score(text) == pytest.approx(expected, rel=1e-4)


def test_epochs_learn_from_all_parts_of_a_text():
    text = bytes(range(256)) * 40
    drawn = quality_model.chunks_of(text, 72)
    assert len(drawn) == 39 and drawn == quality_model.chunks_of(text, 72)
    assert sorted(drawn) == sorted(text[s : s + 512] for s in range(0, len(text) - 256, 256))
    turns = [quality_model._turn(drawn, epoch, 6) for epoch in range(12)]
    assert all(len(t) == 6 for t in turns)
    long = bytes(np.random.default_rng(1).integers(0, 256, 1_000_000, dtype=np.uint8))
    parts = [long.find(c) for c in quality_model.chunks_of(long, 72)]
    assert len(set(parts)) == 72 and min(parts) < 100_000 and max(parts) > 900_000
    assert quality_model.chunks_of(b"", 72) == [b""] and quality_model._turn([b"x"], 3, 6) == [b"x"]


def test_gradients():
    rng = np.random.default_rng(3)
    network = quality_model.Network.fresh(rng)
    batch = [([rng.integers(1, 255, n).astype(np.uint8).tobytes() for n in (512, 90)], 1, 0.7),
             ([b"abc def" * 9], 0, 1.3)]

    def loss():
        total = 0.0
        for chunks, label, weight in batch:
            logits = []
            for chunk in chunks:
                top = network.filtered(np.frombuffer(chunk, np.uint8)).max(axis=0)
                logits.append(float(network.judged(top[None])[2][0]))
            logit = np.mean(logits)
            total += weight * (math.log1p(math.exp(logit)) - label * logit)
        return total / len(batch)

    for array, gradient in zip(network.arrays(), quality_model._gradients(network, batch)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = array[at], 1e-2
        array[at] = kept + step
        above = loss()
        array[at] = kept - step
        slope = (above - loss()) / (2 * step)
        array[at] = kept
        assert slope == pytest.approx(float(gradient[at]), rel=0.15, abs=1e-4)


def test_base_scores_of_all_documents(spark):
    rows = queries.queries()["op9_class_lm"](spark, helpers.SF_DIR).collect()
    tokens = {
        d.doc_id: [*helpers.WORD.findall(helpers.ascii_lower(d.text)), None]
        for d in helpers.documents(spark).collect()
    }
    training = [i for i in tokens if not _held_out(i, 7, 2)]
    counts = Counter(t for i in training for t in tokens[i])
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(tokens)
    for row in rows:
        own = tokens[row.doc_id]
        assert row.held_out == _held_out(row.doc_id, 7, 2)
        assert (row.n_tokens, row.train_tokens) == (len(own), n)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.perplexity == pytest.approx(10 ** (-row.score / row.n_tokens))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def _model(counts, of, classes, tokens, words):
    table = np.random.default_rng(4).integers(0, 50, (classes, classes)).astype(float)
    return class_lm.class_model(of, table, counts, tokens, words)


def test_probabilities_add_up_to_one():
    counts = np.array([10.0, 33.0, 50, 40, 30, 20])
    of = np.array([0, 1, 2, 3, 2, 3])
    words = 3 + 2 + 20  # 20 rare words among the 33 rare tokens
    model = _model(counts, of, 4, counts.sum(), 5 + 20)
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    for c in (2, 3):
        assert (10 ** model.emissions[of == c]).sum() == pytest.approx(1)
    assert model.rare_mass == 33 + 20 + 1
    assert words == 25


def test_exchange_finds_classes_and_gains():
    rng = np.random.default_rng(9)
    size, groups = 24, 3
    truth = np.arange(size) % groups
    chain = np.zeros((size + 2, size + 2))
    word = 0
    for _ in range(30_000):
        after = (truth[word] + 1) % groups if rng.random() < 0.9 else rng.integers(groups)
        following = rng.choice(np.flatnonzero(truth == after))
        chain[word + 2, following + 2] += 1
        word = following
    order = rng.permutation(size) + 2
    mixed = chain[np.ix_([0, 1, *order], [0, 1, *order])]
    of = class_lm.exchange_seeds(mixed, groups, 20)[2:]
    found = {(truth[o - 2], c) for o, c in zip(order, of)}
    assert len(found) == groups  # each true group is one class


def test_a_gain_is_the_change_of_the_likelihood():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 30, (9, 9)).astype(float)
    of = np.array([0, 1, 2, 3, 4, 2, 3, 4, 2])

    def table_of(classes):
        table = np.zeros((5, 5))
        np.add.at(table, (classes[:, None], classes[None, :]), counts)
        return table

    def likelihood(classes):
        t, f = table_of(classes), class_lm._xlogx
        return f(t).sum() - f(t.sum(axis=0)).sum() - f(t.sum(axis=1)).sum()

    word, own = 6, of[6]
    right, left = (np.bincount(of, c, 5) for c in (counts[word], counts[:, word]))
    right[own] -= counts[word, word]
    left[own] -= counts[word, word]
    gains = class_lm.exchange_gains(
        table_of(of), right[None], left[None], counts[[word], [word]], np.array([own])
    )[0]
    for best in (2, 4):
        moved = of.copy()
        moved[word] = best
        assert gains[best] - gains[own] == pytest.approx(likelihood(moved) - likelihood(of))


def test_rounds_of_exchange_raise_the_likelihood(spark):
    docs = helpers.documents(spark)
    few = class_lm.score_texts(docs, F.lit(True), carry=["doc_id"], classes=1, rounds=1)
    many = class_lm.score_texts(docs, F.lit(True), carry=["doc_id"], classes=16, rounds=2)
    total = [df.agg(F.sum("score")).first()[0] for df in (few, many)]
    assert total[1] > total[0]


def test_joining_is_exchange_out_of_the_rare_class():
    """The gains of a rare word are those of exchange where no neighbour is rare as well."""
    rng = np.random.default_rng(8)
    table = rng.integers(20, 90, (6, 6)).astype(float)
    for _ in range(20):
        right, left = (rng.integers(0, 4, 6) * (np.arange(6) != class_lm.RARE) for _ in range(2))
        right[0] += 1
        left[0] += 1
        expected = class_lm.exchange_gains(
            table, right[None].astype(float), left[None].astype(float), np.zeros(1), np.array([class_lm.RARE])
        )[0]
        cell = np.concatenate([np.flatnonzero(right), 6 + np.flatnonzero(left)])
        n = np.concatenate([right[right > 0], left[left > 0]]).astype(float)
        found = class_lm.joining_gains(table, np.array([0]), cell, n)[0]
        assert np.allclose(found - found[class_lm.RARE], expected - expected[class_lm.RARE])


def test_scores_by_plain_loops(spark, monkeypatch):
    """Classes, transitions and emissions recounted word by word from the classes the words got."""
    seen = {}
    assign, model = class_lm.assigned_words, class_lm.class_model

    def assigned_words(*args):
        seen["assigned"] = assign(*args)
        return seen["assigned"]

    def class_model(of, *args):
        seen["of"] = of
        return model(of, *args)

    monkeypatch.setattr(class_lm, "assigned_words", assigned_words)
    monkeypatch.setattr(class_lm, "class_model", class_model)
    monkeypatch.setattr(class_lm, "BLOCK_TOKENS", 700)
    docs = helpers.documents(spark).where("doc_id < 150").repartition(3)
    in_training = F.col("doc_id") % 3 > 0
    options = {"classes": 5, "seed_share": 60, "frequent_share": 300}
    rows = class_lm.score_texts(docs, in_training, carry=["doc_id"], **options).collect()
    tokens = {d.doc_id: helpers.WORD.findall(helpers.ascii_lower(d.text)) for d in docs.collect()}
    counts = Counter(w for i in tokens if i % 3 for w in [*tokens[i], None])
    n, total = sum(counts.values()), 5 + class_lm.FIXED
    frequent = sorted((w for w in counts if w and counts[w] * 300 > n), key=lambda w: (-counts[w], w))
    of = {w: int(c) for w, c in zip(frequent, seen["of"][class_lm.FIXED :])} | {None: class_lm.END}
    joined = {r.word: (r["class"], r.n) for r in seen["assigned"].collect()}
    assert joined.keys() == {w for w in counts if w is not None} - set(frequent)
    assert all(counts[w] == c for w, (_, c) in joined.items())
    assert sum(c != class_lm.RARE for c, _ in joined.values()) > 500
    of |= {w: c for w, (c, _) in joined.items()}
    table = np.zeros((total, total))
    for i in tokens:
        before = class_lm.END
        for w in [*tokens[i], None] if i % 3 else []:
            table[before, of[w]] += 1
            before = of[w]
    alone = (table.sum(axis=0) + 1) / (table.sum() + total)
    steps = (table + total * alone) / (table.sum(axis=1, keepdims=True) + total)
    size = Counter()
    for w, c in counts.items():
        size[of[w]] += c
    rare = [w for w in counts if of[w] == class_lm.RARE]
    mass = sum(counts[w] for w in rare) + len(rare) + 1
    assert len(rows) == len(tokens)
    for row in rows:
        score, before = 0.0, class_lm.END
        for w in [*tokens[row.doc_id], None]:
            c = of.get(w, class_lm.RARE)
            emitted = (counts[w] + 1) / mass if c == class_lm.RARE else counts[w] / size[c] if w else 1
            score += math.log10(steps[before, c]) + math.log10(emitted)
            before = c
        assert row.score == pytest.approx(score, rel=1e-9)


def test_more_text_does_not_take_a_class_away(spark):
    """A word with the same neighbours has its class however much other text there is."""
    rare = [f"x{i} the {w} of a" for i, w in enumerate(["cat", "cat", "dog", "dog"])]
    small = rare + ["the man of a house", "the house of a man"] * 20
    large = small + [f"q{i} r{i} s{i}" for i in range(3000)]
    for texts in (small, large):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        blocks = {}
        original = class_lm.assigned_words

        def kept(*args):
            blocks["found"] = original(*args)
            return blocks["found"]

        class_lm.assigned_words = kept
        try:
            class_lm.score_texts(df, F.lit(True), carry=["doc_id"], frequent_share=30, classes=4).collect()
        finally:
            class_lm.assigned_words = original
        classes = {r.word: r["class"] for r in blocks["found"].collect()}
        assert classes["cat"] == classes["dog"] != class_lm.RARE


def test_parts_of_a_block_are_its_texts():
    """However a block is cut, its texts have the same tokens before and behind each other."""
    draw = np.random.default_rng(3)
    lengths = draw.integers(1, 9, 40)
    codes = np.concatenate([[*draw.integers(1, 5, n - 1), class_lm.END] for n in lengths]).astype("<u2")
    rare = draw.integers(0, 7, np.count_nonzero(codes == class_lm.RARE)).astype("<u4")
    batch = pa.RecordBatch.from_pylist(
        [{"codes": codes.tobytes(), "rare": rare.tobytes(), "lengths": lengths.tolist(), "trained": (lengths > 3).tolist()}]
    )
    kinds, of_rare = np.arange(5) * 10, np.arange(7) + 100
    whole = [b for _, _, b in class_lm._blocks([batch], "<u2")]
    assert len(whole) == 1
    expected = np.stack([*whole[0].pairs(kinds, of_rare), whole[0].trained])
    for size in (1, 5, 17, 60):
        parts = list(class_lm._blocks([batch], "<u2", size))
        assert len(parts) > 1 and [f for _, f, _ in parts] == np.cumsum([0, *(len(b.lengths) for _, _, b in parts)])[:-1].tolist()
        joined = np.concatenate([np.stack([*b.pairs(kinds, of_rare), b.trained]) for _, _, b in parts], axis=1)
        assert np.array_equal(joined, expected)


def test_neighbours_of_rare_words_by_parts():
    """The parts of a block count as many neighbours of each rare training word as the whole."""
    draw, total = np.random.default_rng(5), 4
    lengths = draw.integers(1, 9, 60)
    codes = np.concatenate([[*draw.integers(1, 5, n - 1), class_lm.END] for n in lengths]).astype("<u2")
    rare = draw.integers(0, 7, np.count_nonzero(codes == class_lm.RARE)).astype("<u4")
    trained = lengths > 3
    batch = pa.RecordBatch.from_pylist(
        [{"codes": codes.tobytes(), "rare": rare.tobytes(), "lengths": lengths.tolist(), "trained": trained.tolist()}]
    )
    kinds, words, expected = np.array([0, 1, 2, 3, 2]), iter(rare.tolist()), Counter()
    padded, inside = [class_lm.END, *codes.tolist()], np.repeat(trained, lengths)
    for at, code in enumerate(codes):
        if code == class_lm.RARE:
            word = next(words)
            if inside[at]:
                expected[word * 2 * total + kinds[codes[at + 1]]] += 1
                expected[word * 2 * total + total + kinds[padded[at]]] += 1
    for size in (5, 17, 1000):
        found = [class_lm.beside_rare(b, kinds, total) for _, _, b in class_lm._blocks([batch], "<u2", size)]
        assert Counter(np.concatenate(found).tolist()) == expected


def test_blocks_are_stored_without_buffers_of_their_size(spark, monkeypatch):
    """Snappy would take memory of the size of a block's largest value outside the heap."""
    folders, work_folder = [], tables.work_folder

    def folder(session):
        folders.append(work_folder(session))
        return folders[-1]

    monkeypatch.setattr(tables, "work_folder", folder)
    texts = [(i, f"the cat {i % 7} of a house x{i}") for i in range(50)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert class_lm.score_texts(df, F.lit(True), carry=["doc_id"], classes=4).count() == 50
    codecs = Counter()
    for path in folders:
        for part in pq.ParquetDataset(path.removeprefix("file://").removeprefix("file:")).fragments:
            for group in range(part.metadata.num_row_groups):
                columns = part.metadata.row_group(group)
                for i in range(columns.num_columns):
                    if columns.column(i).path_in_schema in ("codes", "rare"):
                        codecs[columns.column(i).compression] += 1
    assert set(codecs) == {"ZSTD"}
