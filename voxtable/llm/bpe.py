"""BPE by automaton: merges compiled to a deterministic token automaton, words encoded by its arcs.

The automaton reads tokens, and accepts exactly the token sequences that BPE can produce. It is
built by successive merge gadgets (Berglund, Martens and van der Merwe, "Constructing a BPE
Tokenization DFA"): it starts with one state and a loop for each base symbol; the merge of ``u``
and ``v`` copies the state that ``u`` leads to, takes the arc ``v`` out of the copy, lets ``u`` lead
to the copy, and adds an arc ``uv`` wherever there is an arc ``u``, to where ``v`` led before.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import text_of, with_results
from voxtable.ship import ship_package

NEVER = 1 << 30
END = "\u0100"  # what is read at the end of a word; no byte is read as it
ARCS = 300_000  # arcs known at a time, some 35 MB
AHEAD, GUESSES = 5, 200_000  # letters that an arc is guessed by, and guesses known at a time
REMEMBERED = 40 << 20  # bytes of words remembered by a Python worker, in each of two generations
# How the supported vocabularies split words, and the normalizers they name.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Characters that Python takes for white space and Unicode does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORDS = re.compile("(?:\\S|[\x1c-\x1f])+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 letters
    stand for themselves, the other bytes for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class TokenAutomaton:
    """States and arcs of the automaton over tokens.

    All arcs of a token lead to one state, so a state goes by the token before it. It differs from
    its origin only by the arcs that gadgets have taken out, and a merge has one step only, so the
    arcs need not be listed: ``_behind[u]`` holds the tokens whose gadgets made the state after
    ``u``, each with the step up to which they count, ``_before[v]`` the tokens from which the arc
    ``v`` was made, with the step until which it stood for them.
    """

    def __init__(self, tokens: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        letters, end = byte_letters(), len(suffix)
        self.labels = {i: t for t, i in tokens.items()}
        self._step: dict[int, int] = {}
        self._behind: dict[int, tuple[tuple[int, int], ...]] = {}
        self._before: dict[int, tuple[tuple[int, int], ...]] = {}
        self._arcs: dict[int, bool] = {}
        for letter in letters:
            for symbol in (letter, letter + suffix):
                token = tokens[symbol]
                self._behind[token] = self._before[token] = ((token, NEVER),)
        for step, (left, right) in enumerate(merges):
            self._merge(step, tokens[left], tokens[right], tokens[left + right])
        self._arcs.clear()  # so far they were those of an unfinished automaton
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token in self._before:  # those that some arc carries
            label = self.labels[token]
            last = label.endswith(suffix) and len(label) > end
            spelled = bytes(letters[c] for c in (label[:-end] if last else label))
            (self.final if last else self.inner)[spelled] = token
        # What a token is read as: its bytes, and a mark behind the last one of a word.
        read = {t: w.decode("latin-1") for w, t in self.inner.items()}
        read |= {t: w.decode("latin-1") + END for w, t in self.final.items()}
        self.lengths = {t: len(w) for t, w in read.items()}
        self._arc_named = {w: t for t, w in read.items()}
        # The longest arc that starts with one or two letters.
        self._reach: dict[str, int] = {}
        self._guesses: dict[str, int] = {}
        for spelled in self._arc_named:
            start = spelled[:2]
            self._reach[start] = max(len(spelled), self._reach.get(start, 0))

    def _merge(self, step: int, u: int, v: int, uv: int) -> None:
        """One gadget. A merge that no earlier result leaves room for adds nothing."""
        if u not in self._before or v not in self._before or not self._open(u, v):
            return
        self._behind[uv] = ((uv, NEVER), *((t, min(s, step)) for t, s in self._behind[v]))
        self._before[uv] = ((uv, NEVER), *((t, min(s, step)) for t, s in self._before[u]))
        self._step[u << 20 | v] = step

    def _open(self, u: int, v: int) -> bool:
        for a, until in self._behind[u]:
            for b, to in self._before[v]:
                step = self._step.get(a << 20 | b, NEVER)
                if step < until and step <= to:
                    return False
        return True

    def follows(self, u: int, v: int) -> bool:
        """Whether the state after ``u`` has an arc ``v``; the table is filled as it is asked."""
        key = u << 20 | v
        known = self._arcs.get(key)
        if known is None:
            if len(self._arcs) > ARCS:
                self._arcs.clear()
            known = self._arcs[key] = self._open(u, v)
        return known

    def encode(self, word: bytes) -> list[int]:
        """Tokens of one pre-split word: the labels along its accepted path.

        From each state the arc is tried that the same next letters took last, then all that spell
        what comes next, the longest first. Every prefix of a word has one accepted path, so a
        place from which the end was not reached is no place of the word's path, however one gets
        there, and is not tried again; nor does the order of trying change the path.
        """
        whole = self.final.get(word)
        if whole is not None:
            return [whole]
        spelled = word.decode("latin-1") + END
        named, known, guesses = self._arc_named.get, self._arcs.get, self._guesses
        path, places, dead, size = [], [0], set(), len(spelled)
        at, last = 0, -1
        while at < size:
            ahead = spelled[at : at + AHEAD]
            length = guesses.get(ahead)
            if length:
                token = named(spelled[at : at + length])
                if token is not None and at + length not in dead:
                    arc = last < 0 or known(last << 20 | token)
                    if arc or arc is None and self.follows(last, token):
                        path.append(token)
                        at, last = at + length, token
                        places.append(at)
                        continue
            length = min(self._reach.get(ahead[:2], 1), size - at)
            while length:
                token = named(spelled[at : at + length])
                if token is not None and at + length not in dead:
                    if last < 0 or self.follows(last, token):
                        break
                length -= 1
            if length:
                if len(guesses) > GUESSES:
                    guesses.clear()
                guesses[ahead] = length
                path.append(token)
                at, last = at + length, token
                places.append(at)
            elif path:
                dead.add(at)
                path.pop()
                places.pop()
                at, last = places[-1], path[-1] if path else -1
            else:
                raise ValueError(f"no path for {word!r}")
        return path


class Remembered(dict):
    """A dictionary filled by a function, of two generations of ``limit`` bytes each at most.

    When full it becomes the older generation, from which entries in use come back. So frequent
    words stay and rare ones go.
    """

    # Bytes of an entry beside what its key and value spell, about.
    ENTRY = 120

    def __init__(self, function: Callable, limit: int):
        super().__init__()
        self._function, self._limit, self._older, self._size = function, limit, {}, 0

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._function(key)
        size = self.ENTRY + len(key) + len(value)
        if self._size + size > self._limit:
            self._older, self._size = dict(self), 0
            self.clear()
        if size <= self._limit:
            self._size += size
            self[key] = value
        return value


class Vocabulary:
    """A vocabulary file of the tokenizers library: byte-level BPE with word ends, lower case."""

    def __init__(self, text: str):
        content = json.loads(text)
        model = content["model"]
        steps = [n["type"] for n in (content["normalizer"] or {}).get("normalizers", [])]
        splits = (content["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if steps != NORMALIZERS or splits.get("pattern") != {"Regex": SPLIT} or content["decoder"]:
            raise ValueError("only lower-case byte-level BPE with word ends is supported")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.labels = self.automaton.labels | {i: t for t, i in self.special.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._pieces = regex.compile(SPLIT.replace(r"\s", ""))  # a word has no white space

    def parts(self, text: str) -> Iterator[tuple[int | None, str]]:
        """Text between special tokens as (None, text), and those as (id, their text)."""
        if "<" not in text:
            yield None, text
            return
        for i, part in enumerate(self._special.split(text)):
            if part:
                yield (self.special[part] if i % 2 else None), part

    def normalized(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def words(self, normalized: str) -> list[str]:
        """What white space separates."""
        return WORDS.findall(normalized) if SEPARATORS.search(normalized) else normalized.split()

    def pieces(self, word: str) -> list[str]:
        return [word] if word.isalpha() else self._pieces.findall(word)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Texts to ids and back, with a bounded memory of words."""

    def __init__(self, text: str, remembered: int = REMEMBERED):
        self.vocabulary = Vocabulary(text)
        self._of_word = Remembered(self._encode_word, remembered)

    def _encode_word(self, word: str) -> bytes:
        """A word of several pieces is made of these, which are remembered as words themselves."""
        pieces = self.vocabulary.pieces(word)
        if len(pieces) > 1:
            return b"".join([self._of_word[p] for p in pieces])
        if not pieces:
            return b""
        return packed(self.vocabulary.automaton.encode(pieces[0].encode()))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        found = []
        for special, part in self.vocabulary.parts(text):
            if special is not None:
                found.append(packed([special]))
                continue
            words = self.vocabulary.words(self.vocabulary.normalized(part))
            found.append(b"".join(map(self._of_word.__getitem__, words)))
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, separated by spaces as the library does without a decoder."""
        labels = self.vocabulary.labels
        return " ".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()])


@functools.lru_cache(maxsize=2)
def encoder(text: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(text, remembered)


def read_vocabulary(path: str) -> str:
    """The content of a vocabulary file, for the driver to send to the workers (some 2 MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


ENCODED = "n_tokens bigint, ids binary, decoded string"
DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _encoded(text: Column, vocabulary: str, schema: str, result: Callable) -> Column:
    @F.arrow_udf(schema)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(vocabulary)
        names = [field.split(" ")[0] for field in schema.split(", ")]
        kinds = [pa.binary(), pa.string()] if schema == ENCODED else [pa.string(), pa.string()]
        for batch in batches:
            rows = [result(own, own.encode(text.as_py())) for text in batch]
            columns = list(zip(*rows)) or [()] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64(), *kinds])]
            yield pa.StructArray.from_arrays(arrays, names)

    return encoded(text)


def encode_texts(df: DataFrame, vocabulary_path: str, text_col: str = "text") -> DataFrame:
    """Every row with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded``.

    Ids are those of the tokenizers library without added special tokens; the strings of special
    tokens inside a text become those tokens, as is the library's default. A null or empty text
    has no ids. Rows are independent of each other, repeated rows included; an input column with
    the name of a result column gives way; an empty table gives an empty table.
    """
    ship_package(df.sparkSession)
    result = _encoded(
        text_of(text_col),
        read_vocabulary(vocabulary_path),
        ENCODED,
        lambda own, ids: (len(ids) // 4, ids, own.decode(ids)),
    )
    return with_results(df, result, ["n_tokens", "ids", "decoded"])


def encode_digests(df: DataFrame, vocabulary_path: str, text_col: str = "text") -> DataFrame:
    """``encode_texts`` with the SHA-256 of ids and decoded text in place of both.

    The digests are taken where the ids are, so that these need not leave the task.
    """
    ship_package(df.sparkSession)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    result = _encoded(
        text_of(text_col),
        read_vocabulary(vocabulary_path),
        DIGESTS,
        lambda own, ids: (len(ids) // 4, sha(ids), sha(own.decode(ids).encode())),
    )
    return with_results(df, result, ["n_tokens", "ids_sha256", "decoded_sha256"])
