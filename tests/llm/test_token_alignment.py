"""Token alignment against plain loops over bytes, and fragments composed in every order."""

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm import helpers
from voxtable.llm import token_alignment
from voxtable.llm.token_alignment import Aligner, Fragment, align_tokens, stretches

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def own():
    return Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())


@pytest.fixture(scope="module")
def plain():
    """(ids, bytes of each token) of both tokenizers for a text."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = {c: i for i, c in _letters()}

    def tokens(text):
        found = a.encode(" " + text, add_special_tokens=False)
        ids = b.encode(text)
        pieces = [b.id_to_piece(i) for i in ids]
        spelled = [
            bytes([int(p[3:5], 16)]) if p.startswith("<0x") and b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(ids, pieces)
        ]
        return found.ids, [bytes(letters[c] for c in t) for t in found.tokens], ids, spelled

    return tokens


def _letters():
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return [(b, chr(b)) for b in plain] + [(b, chr(256 + i)) for i, b in enumerate(rest)]


def aligned(tokens, text):
    """Groups, and links as pairs of ids, byte by byte; None without tokens."""
    a, a_bytes, b, b_bytes = tokens(text)
    data = (" " + text).encode()
    if not text or b"".join(a_bytes) != data or b"".join(b_bytes) != data:
        return None
    a_of = [i for i, t in enumerate(a_bytes) for _ in t]
    b_of = [i for i, t in enumerate(b_bytes) for _ in t]
    links = [(a[i], b[j]) for i, j in sorted(set(zip(a_of, b_of)))]
    groups, start = [], 0
    for at in range(1, len(data) + 1):
        if at == len(data) or (a_of[at] != a_of[at - 1] and b_of[at] != b_of[at - 1]):
            members = [sorted({x[i] for i in range(start, at)}) for x in (a_of, b_of)]
            groups.append([[ids[i] for i in m] for ids, m in zip((a, b), members)])
            start = at
    return len(a), len(b), groups, links


def text_of_groups(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


TEXTS = [
    "Hello, world! Tokenizers disagree; <s> and <|endoftext|> are plain text here.",
    "naïve café ﬁancée  two  spaces\n\n\tand\ttabs   ",
    "中文字 日本語のテキスト 😀😀 áé",
    " leading and trailing ",
    "x",
    "▁ is no space",
    "a\x00b \x1c\x7f",
    "don't 12345 67,890.12 ((())) ----- =====",
    "word " * 50,
]


@pytest.mark.parametrize("text", TEXTS)
def test_groups_and_links_byte_by_byte(own, plain, text):
    expected = aligned(plain, text)
    (row,) = own.texts([text], True)
    if expected is None:
        assert row == (0, 0, 0, 0, "", "", (), ())
        return
    n_a, n_b, groups, links = expected
    shown = text_of_groups(groups)
    assert row[:6] == (n_a, n_b, len(groups), len(links), hashlib.sha256(shown.encode()).hexdigest(), shown)
    codes = Counter(a * own.tokenizers.b_size + b for a, b in links)
    assert dict(zip(row[6].tolist(), row[7].tolist())) == codes


def test_texts_together_are_as_alone(own):
    together = own.texts([*TEXTS, "", *TEXTS], True)
    for text, row in zip([*TEXTS, "", *TEXTS], together):
        (alone,) = own.texts([text], True)
        assert row[:6] == alone[:6] and list(row[6]) == list(alone[6]) and list(row[7]) == list(alone[7])


def _same(left: Fragment, right: Fragment) -> bool:
    return all(
        np.array_equal(x, y)
        for name, value in left.__dict__.items()
        for x, y in (
            zip(value.__dict__.values(), getattr(right, name).__dict__.values())
            if hasattr(value, "__dict__")
            else [(value, getattr(right, name))]
        )
    )


def test_fragments_are_a_monoid(own):
    draw = random.Random(1)
    text = " " + "Unbelievable internationalisation of naïve tokenizers, 123456 times! " * 4
    tokens = own.tokens(text)
    size, whole = len(text.encode()), own.of_tokens(tokens)
    for _ in range(40):
        cuts = sorted(draw.sample(range(1, size), draw.randint(0, 30)))
        bounds = list(zip([0, *cuts], [*cuts, size]))
        parts = [own.of_tokens(tokens.between(low, high)) for low, high in bounds]
        left = reduce(own.compose, parts, Fragment())
        while len(parts) > 1:  # any tree
            at = draw.randrange(len(parts) - 1)
            parts[at : at + 2] = [own.compose(parts[at], parts[at + 1])]
        assert _same(left, whole) and _same(parts[0], whole)
        assert _same(own.compose(parts[0], Fragment()), whole)
        assert own.whole(whole, True)[:6] == own.texts([text[1:]], True)[0][:6]


@pytest.mark.parametrize("size", [1, 7, 64])
def test_stretches_cover_a_text_once(own, size):
    for text in [*TEXTS, "a" * 500 + " b" * 100 + "ü" * 300, "no.cuts" * 100]:
        end = 0
        windows = 0
        total = Fragment()
        for number, (n, low, high, offset, window) in enumerate(stretches(text, size)):
            assert (n, low) == (number, end) and offset <= low < high
            assert (" " + text).encode()[offset : offset + len(window.encode())].decode() == window
            end, windows = high, windows + len(window)
            total = own.compose(total, own.fragment(window, offset, low, high))
        assert end == len((" " + text).encode())
        row, (expected,) = own.whole(total, True), own.texts([text], True)
        assert row[:6] == expected[:6]
        assert list(row[6]) == list(expected[6]) and list(row[7]) == list(expected[7])


def test_windows_stay_linear():
    for text in ["ab " * 20_000, "-" * 60_000, "x" * 60_000, "ab " * 9000 + "-" * 9000 + " cd" * 9000, " " * 50_000]:
        assert sum(len(w) for *_, w in stretches(text, 1000)) <= 4 * len(text) + 10_000


def expected_rows(plain, documents):
    found = {i: aligned(plain, text or "") for i, text in documents}
    count = Counter(p for f in found.values() if f for p in set(f[3]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    rows = {}
    for i, f in found.items():
        if f is None:
            rows[i] = (0,) * 6 + ("",)
            continue
        n_a, n_b, groups, links = f
        sha = hashlib.sha256(text_of_groups(groups).encode()).hexdigest()
        n_best = sum(count[p] == best[p[0]] for p in links)
        rows[i] = (n_a, n_b, len(groups), len(links), n_best, sum(count[p] for p in links), sha)
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_against_plain_loops(spark, plain):
    rows = entry.queries()["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()
    documents = helpers.documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect()
    expected = expected_rows(plain, documents)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == expected


@pytest.mark.parametrize("options", [{"stretch": 100}, {"broadcast_pairs": 0}, {"stretch": 64, "with_groups": True}])
def test_every_way_gives_the_same(spark, plain, options):
    texts = [*TEXTS, "", None, "again " * 400, "again " * 400, "same words in another order " * 90]
    documents = list(enumerate(texts))
    df = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(3)
    rows = align_tokens(df, *PATHS, **options).collect()
    expected = expected_rows(plain, documents)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == expected
    if "with_groups" in options:
        for r in rows:
            assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 or not r.groups


def test_a_piece_across_words_keeps_texts_whole(spark, plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "SPACE", "e")  # pieces then seem to go on after a space
    assert not Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read()).tokenizers.starts_at_spaces


def test_units_in_use_stay_known(own, monkeypatch):
    """Units that come again are learned once, however many others come between; rows stay the same."""
    calls = [
        [f"this is the common part w{n}x{i} of text" for i in range(20)] + ["\x00 the " + "a" * n]
        for n in range(30)
    ]
    expected = [own.texts(texts, True) for texts in calls]
    monkeypatch.setattr(token_alignment, "UNITS", 60)
    monkeypatch.setattr(token_alignment, "KEPT", 20)
    small = Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())
    learned, learn = Counter(), small._learn

    def counted(new):
        learned.update(new)
        learn(new)

    small._learn = counted
    for texts, rows in zip(calls, expected):
        found = small.texts(texts, True)
        assert len(small._units.number) <= 60 + 50
        for row, other in zip(found, rows):
            assert row[:6] == other[:6]
            assert np.array_equal(row[6], other[6]) and np.array_equal(row[7], other[7])
    assert len(learned) > 300 and learned["common"] == learned["part"] == 1
