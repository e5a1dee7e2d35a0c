"""Automaton, counts and packing against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import helpers
from voxtable.llm import bpe, packing, queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcdeést'<|>endoftext 0129½²\n\x1c\x85\xa0ΣσςİIßÉé中😀𝔘!!'reveAd‍­"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.read_vocabulary(PATH), remembered=500)


def _texts():
    rng = random.Random(4)
    for _ in range(1500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30)))
        yield text + "<|endoftext|>" * (rng.random() < 0.1) + text[:3]
    yield from (helpers.text_of(t) for _, t in helpers.TEXTS)
    yield "ha" * 300


def test_ids_and_labels(library, own):
    for text in _texts():
        ids = library.encode(text, add_special_tokens=False).ids
        encoded = own.encode(text)
        assert np.frombuffer(encoded, "<u4").tolist() == ids
        assert own.decode(encoded) == library.decode(ids, skip_special_tokens=False)


def test_gadgets_of_a_small_automaton():
    letters = {c: i for i, c in enumerate([*bpe.byte_letters()])}
    tokens = letters | {c + "#": 256 + i for c, i in letters.items()}
    tokens |= {"ab": 600, "aa": 601, "aab": 602, "ab#": 603, "aaa": 604}
    merges = [("a", "b"), ("a", "a"), ("a", "ab"), ("a", "b#"), ("aa", "a")]
    automaton = bpe.TokenAutomaton(tokens, merges, "#")
    a, aa, ab = tokens["a"], 601, 600
    assert not automaton.follows(a, a) and not automaton.follows(a, tokens["b"])
    assert not automaton.follows(aa, a)  # the last merge joins them
    assert automaton.follows(ab, a) and automaton.follows(aa, aa)
    assert not automaton.follows(a, ab)
    assert automaton.encode(b"abab") == [ab, tokens["ab#"]]


def test_digests_of_all_documents(spark, library):
    texts = {r.doc_id: r.text for r in helpers.documents(spark).collect()}
    rows = queries.queries()["op5_bpe"](spark, helpers.SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_ids_and_text_as_columns(spark, library):
    docs = spark.createDataFrame([(1, "Hello there"), (2, None)], "doc_id int, text string")
    rows = {r.doc_id: r for r in bpe.encode_texts(docs, PATH).collect()}
    ids = library.encode("Hello there", add_special_tokens=False).ids
    assert np.frombuffer(rows[1].ids, "<u4").tolist() == ids
    assert rows[1].decoded == library.decode(ids) and rows[2].decoded == ""


def test_counts_of_all_documents(spark, library):
    texts = {r.doc_id: r.text for r in helpers.documents(spark).collect()}
    rows = queries.queries()["op4_token_counts"](spark, helpers.SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        count = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), count)
        assert row.over_limit == (count > 2048)


def test_counts_of_every_prefix(library):
    counter = token_counts.Counter(bpe.read_vocabulary(PATH))
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("abcdest''vrelm  !é\x1c\n9.\xa0") for _ in range(rng.randint(0, 20)))
        text = counter.vocabulary.normalized(text)
        counts = [
            len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)
        ]
        prefixes = token_counts.PrefixCounts(counter, text)
        assert prefixes.total == counts[-1]
        for budget in range(6):
            longest = max(i for i, n in enumerate(counts) if n <= budget)
            assert prefixes.chars_within(budget) == longest


def _check_pieces(pieces, ids_of, tiers):
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        documents[p.doc_id].append(p)
    padding = 0
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 2048 and {p.window for p in parts} == {at}
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    for doc_id, parts in documents.items():
        ids, at = ids_of(doc_id), 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            piece = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(piece)
            at += p.length
        assert at == len(ids)
    groups = defaultdict(int)
    for parts in sequences.values():
        groups[parts[0].step_group] += parts[0].window
    assert max(groups.values()) <= 16_384
    return padding, sum(p.length for p in pieces), {parts[0].window for parts in sequences.values()}


def test_sequences_of_all_documents(spark, library):
    texts = {r.doc_id: r.text for r in helpers.documents(spark).collect()}
    pieces = queries.queries()["op10_packing"](spark, helpers.SF_DIR).collect()
    assert {p.doc_id for p in pieces} == set(texts)

    def ids_of(doc_id):
        return [*library.encode(texts[doc_id], add_special_tokens=False).ids, 1]

    padding, tokens, windows = _check_pieces(pieces, ids_of, (256, 512, 1024, 2048))
    assert padding < 2048 * helpers.documents(spark).rdd.getNumPartitions()
    assert padding < 0.01 * tokens and 2048 in windows


def test_remembered_words_change_no_piece(spark, monkeypatch):
    """Words known to a worker only save time, and the query alone may remember more of them."""
    docs = helpers.odd_documents(spark).coalesce(1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    few, many = (
        packing.pack_documents(docs, PATH, remembered=n).select(columns).collect() for n in (500, 1 << 20)
    )
    assert few == many and len(few) >= len(helpers.TEXTS)
    given, pack = {}, packing.pack_documents
    monkeypatch.setattr(packing, "pack_documents", lambda *args, **more: given.update(more) or pack(*args))
    queries.queries()["op10_packing"](spark, helpers.SF_DIR)
    assert given["remembered"] > bpe.REMEMBERED


def test_short_documents_fill_long_windows():
    packer = packing.Packer((256, 512, 1024, 2048), 0, 16_384)
    for i, n in enumerate([1500, 300, 200, 100, 2048 * 2 + 5]):
        for rows in packer.add((i, b""), n):
            assert rows[0][0][0] == 4 and rows[0][5] == 2048
    first = next(packer.drain(True))
    assert first[0][0][0] == 0 and sum(end - start for _, start, end, *_ in first) == 2048
    assert len(first) > 1


def test_waiting_documents_are_bounded():
    packer, packed = packing.Packer((256, 512, 1024, 2048), 0, 16_384), 0
    for i in range(2000):
        list(packer.add((i, b""), 700))
        if packer.waiting_tokens >= 100_000:
            packed += sum(r[2] - r[1] for rows in packer.drain(False) for r in rows)
            assert packer.waiting_tokens < 2048
    packed += sum(r[2] - r[1] for rows in packer.drain(True) for r in rows)
    assert packed == 2000 * 700


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError, match="only lower-case"):
        bpe.Vocabulary(bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    with pytest.raises(ValueError, match="powers of two"):
        packing.pack_documents(None, PATH, tiers=(100,))
