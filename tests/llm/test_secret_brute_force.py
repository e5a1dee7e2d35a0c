"""The whole secret scan against plain Python: base patterns, all classes, allowed parts and paths."""

import hashlib
import math
import random
import re
import string

from tests.llm import helpers
from voxtable.llm import secret_scan

# Stated once more, so that a wrong pattern in the library shows.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
CANDIDATE = re.compile("[A-Za-z0-9+/_-]+")
UUID = re.compile("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
PART = "example|placeholder|changeme|x{6,}|abcdefgh|0123456789|987654321"


def least_bits(part):
    lower, upper, digit = (any(c in kind for c in part) for kind in (string.ascii_lowercase, string.ascii_uppercase, string.digits))
    plain = all(c.isalnum() for c in part)
    if all(c in string.hexdigits for c in part) and digit and any(c.isalpha() for c in part):
        return 3.03
    if lower and upper and digit:
        return 3.63 if plain else 3.83
    if digit and not lower and not upper and plain:
        return 3.2
    if plain and not digit:
        return 3.9 if lower and upper else 3.83
    if plain:
        return 3.63
    return 3.83 if digit else 4.0


def entropy(window):
    counts = [window.count(c) for c in set(window)]
    return -sum(n / 20 * math.log2(n / 20) for n in counts)


def is_path(candidate):
    """Words between slashes; numbers only at one end of a word, and only in the last segment where
    there are capital letters."""

    def numbered(segment, letters):
        words = re.split("[_-]", segment)
        return all(re.fullmatch(f"{letters}*[0-9]*|[0-9]+{letters}+", w) for w in words)

    *segments, last = candidate.removeprefix("/").split("/")
    if not segments or not all(segments):
        return False
    if all(re.fullmatch("[a-zA-Z_-]+", s) for s in segments) and numbered(last, "[a-zA-Z]"):
        return True
    return all(re.fullmatch("[a-z0-9_-]+", s) and numbered(s, "[a-z]") for s in segments) and numbered(last, "[a-z]")


def is_secret(candidate):
    if UUID.fullmatch(candidate):
        return False
    ends = PART + "|/" if is_path(candidate) else PART
    for part in re.split(ends, candidate, flags=re.I):
        if len(part) >= 20:
            bits = least_bits(part)
            if any(entropy(part[i : i + 20]) >= bits - 1e-7 for i in range(len(part) - 19)):
                return True
    return False


def spans(text):
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m.group()) >= 24]
    added = [
        (m.start(), 3, m.end())
        for m in CANDIDATE.finditer(text)
        if len(m.group()) >= 20
        and is_secret(m.group())
        and not any(s <= m.start() and e >= m.end() for s, _, e in base)
    ]
    listed = lambda found: ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
    return listed(base), listed(base + added)


def texts():
    draw = random.Random(12)
    kinds = [
        string.digits, "0123456789abcdef", "0123456789ABCDEF", string.ascii_lowercase, string.ascii_uppercase,
        string.ascii_letters, string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits,
        string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/_-", "ab", "abc-", "0123",
        string.ascii_lowercase + "_-", string.ascii_lowercase + "/",
    ]
    words = ["path", "to", "file", "users", "home2", "v2", "Token", "src", "0123456789", "example", "xxxxxxxx", "changeMe", "abcdefgh"]

    def run():
        if draw.random() < 0.25:
            return draw.choice(["", "/"]) + "/".join(draw.choices(words, k=draw.randint(2, 8)))
        made = "".join(draw.choices(draw.choice(kinds), k=draw.choice([5, 19, 20, 21, 30, 45])))
        if draw.random() < 0.3:
            made += draw.choice(words) + "".join(draw.choices(draw.choice(kinds), k=draw.choice([10, 25])))
        return made

    def piece():
        return draw.choice(
            [
                run(),
                draw.choice(["password", "Secret", "api_key", "APIKEY", "token", "passwd"])
                + draw.choice(["=", ": ", '" = "', " :'"]) + run(),
                "AKIA" + "".join(draw.choices(string.ascii_uppercase + string.digits, k=draw.choice([10, 16, 20]))),
                "123e4567-e89b-12d3-a456-426614174000",
                "plain prose, ünd more 中文 😀",
            ]
        )

    return [draw.choice([" ", ", ", "\n", "é"]).join(piece() for _ in range(draw.randint(1, 6))) for _ in range(1500)]


def test_spans_are_those_of_plain_python(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id int, text string")
    found = helpers.by_id(secret_scan.find_secrets(df))
    kinds = set()
    for i, text in rows:
        base, every = spans(text)
        assert found[i].spans == every, text
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        kinds |= {s.split(":")[0] for s in every.split(",")}
    assert set(secret_scan.KINDS) <= kinds


def test_clean_documents(spark):
    """Documents without any secret of the base kinds and without long runs have no added span."""
    for row in secret_scan.find_secrets(helpers.documents(spark).select("doc_id", "text")).collect():
        assert row.spans == spans(row.text or "")[1]
