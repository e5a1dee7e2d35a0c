"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers
from voxtable.llm import (
    bpe,
    class_lm,
    exact_dedup,
    language_id,
    license_scan,
    packing,
    periodic_runs,
    quality_model,
    quality_rules,
    secret_scan,
    simhash,
    token_alignment,
    token_counts,
)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ALIGNED_WITH = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def _training():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2


def _classify(df):
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    return quality_model.classify(df, labels, _training(), per_label=4, epochs=1)


ROW_WISE = {
    "exact": (exact_dedup.mark_duplicates, ["keep_id", "group_size", "kept", "text_sha256"]),
    "quality": (_classify, ["held_out", "score", "predicted"]),
    "secrets": (
        secret_scan.find_secrets,
        ["n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"],
    ),
    "counts": (
        lambda df: token_counts.count_tokens(df, VOCABULARY),
        ["n_bytes", "n_tokens", "over_limit", "chars_in_limit"],
    ),
    "bpe": (
        lambda df: bpe.encode_digests(df, VOCABULARY),
        ["n_tokens", "ids_sha256", "decoded_sha256"],
    ),
    "rules": (
        quality_rules.judge_documents,
        [*quality_rules.COUNTS, "base_failed", "kept"],
    ),
    "licenses": (
        license_scan.scan_licenses,
        ["n_sentences", "sentence_ids", "licenses", "unmatched"],
    ),
    "simhash": (simhash.mark_near_duplicates, ["fingerprint", "component_id", "kept"]),
    "lm": (
        lambda df: class_lm.score_texts(df, _training()),
        ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
    ),
    "language": (
        lambda df: language_id.predict_languages(df, _training()),
        ["held_out", "lang_pred", "score"],
    ),
    "alignment": (
        lambda df: token_alignment.align_tokens(df, *ALIGNED_WITH),
        [*token_alignment.TEXT_COUNTS, "n_best", "count_sum", "groups_sha256"],
    ),
    "runs": (
        periodic_runs.find_runs,
        list(periodic_runs.FIELDS),
    ),
}
MAY_BE_NULL = {"start", "length", "period", "exponent_milli"}  # without a run
FILTERS = {
    "exact": exact_dedup.drop_duplicates,
    "rules": quality_rules.filter_documents,
    "simhash": simhash.drop_near_duplicates,
    "redact": lambda df: secret_scan.redact_secrets(df, chars_col="n_chars"),
}


@pytest.mark.parametrize("name", ROW_WISE)
def test_every_row_gets_one_result(spark, name):
    operator, results = ROW_WISE[name]
    docs = helpers.odd_documents(spark)
    marked = operator(docs)
    assert marked.columns == helpers.kept_columns(docs, results)
    rows = marked.collect()
    key = lambda i: (i is None, i)
    assert sorted([r.doc_id for r in rows], key=key) == sorted([i for i, _ in helpers.TEXTS], key=key)
    assert all(r[c] is not None for r in rows for c in results if not c.endswith("_id") and c not in MAY_BE_NULL)
    assert {r["a.b"] for r in rows} == {"ab"}


@pytest.mark.parametrize("name", ROW_WISE)
def test_empty_table(spark, name):
    operator, results = ROW_WISE[name]
    docs = helpers.no_documents(spark)
    marked = operator(docs)
    assert marked.columns == helpers.kept_columns(docs, results)
    assert marked.collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_the_columns(spark, name):
    docs = helpers.odd_documents(spark)
    kept = FILTERS[name](docs)
    assert kept.dtypes == docs.dtypes
    assert 0 < kept.count() <= len(helpers.TEXTS)
    assert FILTERS[name](helpers.no_documents(spark)).collect() == []


def test_exact_groups(spark):
    rows = exact_dedup.mark_duplicates(helpers.odd_documents(spark)).collect()
    groups = {}
    for row in rows:
        groups.setdefault(row.text_sha256, []).append(row)
    for group in groups.values():
        assert sum(r.kept for r in group) == 1
        assert {r.group_size for r in group} == {len(group)}
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert {r.keep_id for r in group} == {max(ids, default=None)}
    sizes = sorted(len(g) for g in groups.values())
    assert sizes == [1] * 5 + [2, 2, 2, 3]  # null and empty; blanks; accents; the missing ids


def test_near_groups_have_one_row_each(spark):
    rows = simhash.mark_near_duplicates(helpers.odd_documents(spark)).collect()
    groups = {}
    for row in rows:
        groups.setdefault(row.component_id, []).append(row)
    assert all(sum(r.kept for r in g) == 1 for g in groups.values())
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert len({r.component_id for r in rows if (r.text or "").startswith("word0")}) == 1


def test_packing_takes_every_token(spark):
    docs = helpers.odd_documents(spark)
    pieces = packing.pack_documents(docs, VOCABULARY).collect()
    per_text = sum(len(helpers.text_of(t)) > -1 for _, t in helpers.TEXTS)
    assert sum(p.start == 0 for p in pieces) == per_text
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, VOCABULARY).collect()}
    assert all(p.doc_tokens == counted[p.doc_id] + 1 for p in pieces)
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)
    assert packing.pack_documents(helpers.no_documents(spark), VOCABULARY).collect() == []


def test_untrained_models(spark):
    docs = helpers.odd_documents(spark).where("doc_id < 6")
    scored = class_lm.score_texts(docs, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in scored} == {(0, 0, 0.0)}
    assert all(-1e9 < r.score < 0 for r in scored)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = quality_model.classify(docs, labels, _training()).collect()
    assert all(0 <= r.score <= 1 for r in rows)
