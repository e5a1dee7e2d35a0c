"""The pipeline's stages, each against a plain version on what the stage before has kept."""

import numpy as np

import corpus_pipeline
from tests.llm import helpers
from voxtable.llm import quality_rules, simhash
from voxtable.sources.tables import materialize

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    n = len(kept)

    rules = list(quality_rules.BASE + quality_rules.RULES)
    expected = {i for i, t in kept.items() if quality_rules.passes(quality_rules.Document(t), rules)}
    docs, kept = _stage(spark, docs, 0, expected, columns)
    assert len(kept) < n

    last = {helpers.ascii_lower(text): i for i, text in sorted(kept.items())}
    docs, kept = _stage(spark, docs, 1, set(last.values()), columns)

    points = np.array([simhash.fingerprint(t, 4) for t in kept.values()], np.uint64)
    roots, ids = helpers.components(points, 4), list(kept)
    first = {root: min(i for r, i in zip(roots, ids) if r == root) for root in set(roots)}
    docs, kept = _stage(spark, docs, 2, set(first.values()), columns)

    docs, redacted = _stage(spark, docs, 3, set(kept), columns)
    changed = [i for i, text in redacted.items() if text != kept[i]]
    assert all("[SECRET]" in redacted[i] for i in changed)
    assert not any("token = \"" in text for text in redacted.values())
    assert all(r.n_chars == len(r.text) for r in docs.collect() if r.doc_id in changed)

    packed = materialize(corpus_pipeline.STAGES[4][1](spark, docs, SMALL))
    assert {r.doc_id for r in packed.collect()} == set(kept)
    assert sorted(map(tuple, packed.drop("sequence_id", "step_group").collect())) == sorted(
        map(tuple, corpus_pipeline.run(spark, SMALL).drop("sequence_id", "step_group").collect())
    )


def _stage(spark, docs, k, expected, columns):
    out = materialize(corpus_pipeline.STAGES[k][1](spark, docs, SMALL))
    assert out.columns == columns
    rows = {r.doc_id: r.text for r in out.collect()}
    assert set(rows) == expected and out.count() == len(expected)
    return out, dict(sorted(rows.items()))
