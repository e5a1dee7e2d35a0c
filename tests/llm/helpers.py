"""Documents with every odd case, and plain versions of what operators compute."""

import re

import numpy as np
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")

# Columns whose names clash with results and with the operators' own names.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, "
    "row int, place int, `Score` string, fingerprint string, spans string, n_tokens string, "
    "`a.b` string"
)
LONG = " ".join(f"word{i % 977} thing{i % 89}." for i in range(20_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (3, " \t\n "),
    (None, "a text whose id is missing, with some words to read in it"),
    (None, "a text whose id is missing, with some words to read in it"),
    (4, "A Text whose id is Missing, with some words to read in it"),
    (5, "Épée ÉPÉE   \x1c x y 中文字 😀 ß ſ İ Σς"),
    (5, "Épée ÉPÉE   \x1c x y 中文字 😀 ß ſ İ Σς"),
    (6, LONG),
    (7, LONG + " end"),
    (8, "<|endoftext|> <|STARTOFTEXT|> x<|startoftext|>"),
    (9, "no secret = here, password: hunter22 and token='" + "0123456789abcdef" * 3 + "'"),
    (10, "x" * 50_000),
]


def odd_documents(spark):
    rows = [(i, t, None, "s", None, "k", 1, None, "?", "f", "s", "n", "ab") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return odd_documents(spark).where("false")


def documents(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(value):
    return "" if value is None else value


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def components(points, within):
    """For every point the position of the first point that links reach, by brute force."""
    root = list(range(len(points)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, point in enumerate(points):
        for j in np.flatnonzero(np.bitwise_count(points ^ point) <= within).tolist():
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(points))]


def by_id(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}


def kept_columns(df, results):
    """Names a result must have: the input's but for those that gave way, then the results."""
    lower = {r.lower() for r in results}
    return [c for c in df.columns if c.lower() not in lower] + list(results)


def count_rows(df):
    return df.agg(F.count("*")).first()[0]
