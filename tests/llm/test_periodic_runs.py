"""Periodic runs against a scan of every period, and the query against its contract in plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.llm import helpers
from voxtable.llm import periodic_runs
from voxtable.llm.periodic_runs import SquareCatcher, find_runs, runs_of_texts


def every_run(words, least=24, exponent=3):
    """(start, end, smallest period), by comparing the words with themselves at every distance."""
    found = {}
    for period in range(1, len(words) // exponent + 1):
        start = 0
        while start < len(words) - period:
            end = start
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            if end + period - start >= max(least, exponent * period):
                found.setdefault((start, end + period), period)
            start = end + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def texts_with_runs(random_, count):
    for _ in range(count):
        kinds = random_.choice([1, 2, 3, 30])
        words = [str(random_.randrange(kinds)) for _ in range(random_.choice([0, 1, 5, 30, 200]))]
        for _ in range(random_.randint(0, 3)):
            unit = [str(random_.randrange(kinds)) for _ in range(random_.randint(1, 25))]
            at, size = random_.randint(0, len(words)), random_.randint(1, 8 * len(unit))
            words[at:at] = (unit * 30)[:size]
        yield words


@pytest.mark.parametrize("appended", [7, 50, 1 << 17])
@pytest.mark.parametrize("least, exponent", [(24, 3), (5, 3), (1, 3), (40, 4)])
def test_runs_are_those_of_a_scan_of_every_period(monkeypatch, appended, least, exponent):
    monkeypatch.setattr(periodic_runs, "STREAM_WORDS", appended)
    texts = list(texts_with_runs(random.Random(appended + least), 150))
    for at in range(0, len(texts), 5):
        some = texts[at : at + 5]
        assert runs_of_texts(some, least, exponent) == [every_run(w, least, exponent) for w in some]


def test_words_that_deceive_the_hash():
    """Sequences whose stretches have equal polynomial hashes without being equal."""
    words = ["a"]
    while len(words) < 4096:
        words += ["b" if w == "a" else "a" for w in words]
    assert runs_of_texts([words]) == [every_run(words)] == [[]]
    words = words + words + words
    assert runs_of_texts([words]) == [every_run(words)] == [[(0, 3 * 4096, 4096)]]


def test_squares_are_reported_as_words_are_appended():
    catcher = SquareCatcher(64, least=4, exponent=3)
    seen = [catcher.append(np.array([w])).tolist() for w in [7, 1, 2, 1, 2, 1, 2, 8]]
    assert seen == [[], [], [], [], [], [[1, 6, 2]], [[1, 7, 2]], []]
    assert catcher.runs() == [(1, 7, 2)]
    with pytest.raises(ValueError):
        SquareCatcher(64, exponent=2)


@pytest.mark.parametrize(
    "words, runs",
    [
        (["a"] * 300_000, [(0, 300_000, 1)]),
        ((["a", "b"] * 8 + ["x"]) * 10_000, [(0, 170_000, 17)]),
        ([str(i) for i in range(200_000)], []),
        ([str(i) for i in range(70_000)] * 3, [(0, 210_000, 70_000)]),
    ],
)
def test_very_long_texts(words, runs):
    assert runs_of_texts([["x"], words, ["y"]]) == [[], runs, []]


def test_collapsed_text_and_strongest_run(spark):
    texts = ["one two " * 12 + "end " + "a " * 24, "no run here", None, "", "w " * 23]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = helpers.by_id(find_runs(df))
    first = rows[0]
    assert [tuple(r) for r in first.runs] == [(0, 24, 2), (25, 24, 1)]
    assert (first.n_words, first.n_runs, first.collapsed) == (49, 2, "one two end a")
    assert (first.start, first.length, first.period, first.exponent_milli) == (25, 24, 1, 24000)
    for i, text in enumerate(texts[1:], 1):
        row = rows[i]
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (0, *[None] * 4)
        assert row.runs == [] and row.collapsed == " ".join((text or "").split())


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_matches_its_contract(spark):
    rows = helpers.by_id(entry.queries()["op13_periodic_runs"](spark, helpers.SF_DIR))
    documents = helpers.documents(spark).select("doc_id", "text").collect()
    assert len(rows) == len(documents)
    with_runs = 0
    for doc_id, text in documents:
        words = planted(doc_id, helpers.WORD.findall(text or ""))
        runs = every_run(words) if len(words) < 700 else runs_of_texts([words])[0]
        row, best = rows[doc_id], (None,) * 4
        if runs:
            s, e, q = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
            best = (s, e - s, q, 1000 * (e - s) // q)
            with_runs += 1
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (len(runs), *best)
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        dropped = {i for s, e, q in runs for i in range(s + q, e)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert with_runs > 50
