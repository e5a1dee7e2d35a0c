"""The registered queries of the operators on documents, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

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

VOCABULARY = "word_bpe_49k.json"
# Packing alone has more memory for words than as a stage of a pipeline.
REMEMBERED = 150 << 20

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def _exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, sf), carry=["doc_id"])


def _token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path(VOCABULARY)).drop("text")


def _bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return bpe.encode_digests(docs, public_tokenizers.path(VOCABULARY)).drop("text")


def _quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return quality_rules.judge_documents(docs).drop("text")


def _simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.mark_near_duplicates(documents(spark, sf), carry=["doc_id"]).drop("kept")


def _secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf).select("doc_id", "text")).drop("text")


def _remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def _quality_model(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return quality_model.classify(docs, labels, _remainder(5) != 0).drop("text")


def _class_lm(spark: SparkSession, sf: str) -> DataFrame:
    return class_lm.score_texts(documents(spark, sf), _remainder(7) != 2, carry=["doc_id"])


def _license_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return license_scan.scan_licenses(docs).drop("text")


def _packing(spark: SparkSession, sf: str) -> DataFrame:
    docs, path = documents(spark, sf), public_tokenizers.path(VOCABULARY)
    return packing.pack_documents(docs, path, remembered=REMEMBERED)


def _language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    return language_id.predict_languages(docs, _remainder(4) != 2).drop("text", "lang")


def _token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.align_tokens(documents(spark, sf), *paths, carry=["doc_id"])


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document by hash repeats some of its words to its end, as the contract says."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    hashed = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    planted = F.expr("h % 10 = 0 AND size(words) > 0")
    placed = hashed.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumns(
        {"n": F.size("words"), "g": F.expr("h div 10")}
    )
    place = placed.withColumns(
        {
            "a": F.when(planted, F.expr("cast(g % n as int)")),
            "p": F.when(planted, F.expr("cast(1 + (n - cast(g % n as int)) div (3 + g % 8) as int)")),
        }
    )
    repeated = F.expr("transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p]))")
    text = F.when(planted, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return place.select("doc_id", text.alias("text"))


def _periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = with_planted_runs(documents(spark, sf).select("doc_id", "text"))
    found = periodic_runs.find_runs(docs)
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    digests = {"runs_sha256": F.array_join(line, ""), "collapsed_sha256": F.col("collapsed")}
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        *[F.sha2(text.cast("binary"), 256).alias(name) for name, text in digests.items()],
    )


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
  SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
         doc_id = max(doc_id) OVER same AS kept, text_sha256
  FROM (SELECT doc_id, sha256({LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
  WINDOW same AS (PARTITION BY text_sha256)"""


# Matches of a pattern with what lies before each, summed up to places.
MATCHES = r"""
    SELECT doc_id, {kind} AS kind, found[i] AS found,
           list_sum(list_transform(before[:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT doc_id, before, found, unnest(range(1, len(found) + 1)) AS i FROM (
      SELECT doc_id, string_split_regex(text, '{pattern}') AS before,
             regexp_extract_all(text, '{pattern}') AS found FROM texts))"""


def _matches(kind: int, pattern: str) -> str:
    return MATCHES.format(kind=kind, pattern=pattern.replace("'", "''"))


CLASSES = (
    ("[0-9A-Fa-f]+", ("[0-9]", "[A-Fa-f]"), 3.03),
    ("[A-Za-z0-9]+", ("[0-9]", "[A-Z]", "[a-z]"), 3.63),
    (".+", ("[0-9]", "[A-Z]", "[a-z]"), 3.83),
)
LEAST_BITS = " ".join(
    f"WHEN regexp_full_match(found, '{whole}') AND "
    + " AND ".join(f"regexp_matches(found, '{part}')" for part in parts)
    + f" THEN {bits}"
    for whole, parts, bits in CLASSES
)
SECRET_SCAN = rf"""
  WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
  base AS (
    SELECT doc_id, kind, CAST(start AS BIGINT) AS start, CAST(start + length(found) AS BIGINT) AS stop
    FROM ({_matches(0, secret_scan.ASSIGN)} UNION ALL
          {_matches(1, secret_scan.ACCESS)} UNION ALL
          {_matches(2, secret_scan.HEX)})
    WHERE kind > 0 OR length(regexp_extract(found, '{secret_scan.ASSIGN.replace("'", "''")}', 2)) >= 6),
  candidates AS (
    SELECT *, CASE {LEAST_BITS} END AS least FROM ({_matches(3, secret_scan.CANDIDATE)})),
  added AS (
    SELECT doc_id, kind, CAST(start AS BIGINT) AS start, CAST(start + length(found) AS BIGINT) AS stop
    FROM candidates
    WHERE NOT ({" OR ".join(f"regexp_matches(found, '{p}')" for p in secret_scan.ALLOWED)})
      AND list_max(list_transform(range(1, length(found) - 18), lambda i:
            list_aggregate(string_split(substr(found, i, 20), ''), 'entropy'))) >= least),
  spans AS (
    SELECT * FROM base UNION ALL
    SELECT * FROM added a WHERE NOT EXISTS (
      SELECT * FROM base b WHERE b.doc_id = a.doc_id AND b.start <= a.start AND b.stop >= a.stop)),
  listed AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign,
           count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
           count(*) FILTER (WHERE kind = 3) AS n_entropy,
           string_agg(place, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
           string_agg(place, ',' ORDER BY start, kind) AS spans
    FROM (SELECT *, concat_ws(':', ['assign', 'access', 'hex', 'entropy'][kind + 1], start, stop) AS place
          FROM spans)
    GROUP BY doc_id)
  SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
         coalesce(n_hex, 0) AS n_hex, coalesce(n_entropy, 0) AS n_entropy,
         sha256(coalesce(base, '')) AS base_sha256, coalesce(listed.spans, '') AS spans
  FROM texts LEFT JOIN listed USING (doc_id)"""

# Words as a list, lines as a list; then the positions of 5-word windows that occur again.
QUALITY_RULES = r"""
  WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
  placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM texts),
  windows AS (
    SELECT doc_id, pos, concat_ws(' ', word, lead(word) OVER d, lead(word, 2) OVER d,
                                  lead(word, 3) OVER d, lead(word, 4) OVER d) AS five,
           lead(word, 4) OVER d IS NOT NULL AS whole
    FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
  repeated AS (
    SELECT doc_id, pos FROM (
      SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows WHERE whole)
    WHERE n > 1),
  repeats AS (
    SELECT doc_id, count(*) AS n_repeat_words FROM (
      SELECT DISTINCT doc_id, pos + unnest(range(5)) AS pos FROM repeated) GROUP BY doc_id),
  counts AS (
    SELECT doc_id, text, words, len(words) AS n_words, len(lines) AS n_lines,
           CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           length(regexp_replace(text, '[^{UNSPACED}]', '', 'g')) AS n_unspaced,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
           length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
           len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutters
    FROM texts LEFT JOIN repeats USING (doc_id))
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
              OR 10 * n_symbols > n_words
              OR word_chars < 2 * n_words OR word_chars > 20 * n_words AND 2 * n_unspaced <= word_chars
              OR 2 * n_dup_lines > n_lines
              OR 2 * n_capitals > n_letters
              OR 5 * n_stutters > n_words
              OR len(list_distinct(words)) * len(list_distinct(words)) < n_words) AS kept
  FROM counts""".replace("{UNSPACED}", quality_rules.UNSPACED_RANGES)


def _license_rules(sequence: str) -> tuple[str, str]:
    """The list of licenses of a sequence, and what is left of it."""
    found, rest = [], sequence
    for name, pattern in license_scan.RULES:
        found.append(f"CASE WHEN regexp_matches({rest}, '{pattern}') THEN '{name}' END")
        rest = f"regexp_replace({rest}, '{pattern}', '|', 'g')"
    return f"list_sort(list_distinct([{', '.join(found)}]))", rest


KNOWN_SENTENCES = ", ".join(f"('{known}', '{i}')" for known, i in license_scan.SENTENCES.items())
FOUND_LICENSES, LICENSES_LEFT = _license_rules("sequence")
LICENSE_SCAN = rf"""
  WITH sentences AS (
    SELECT doc_id, unnest(list) AS sentence, unnest(range(len(list))) AS pos FROM (
      SELECT doc_id, string_split(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(
               coalesce(text, ''), '{license_scan.MARK_ENDS}', chr(1) || '\1', 'g'),
               '{license_scan.LINE_ENDS}', chr(1) || '\1', 'g')),
               '{license_scan.QUOTES.replace("'", "''")}', '', 'g'), '{license_scan.FILLERS}', ' ', 'g'), chr(1)) AS list
      FROM documents)),
  sequences AS (
    SELECT doc_id, count(*) AS n_sentences, string_agg(id, ',' ORDER BY pos) AS sentence_ids,
           string_agg('<' || id || '>', '' ORDER BY pos) AS sequence
    FROM sentences JOIN (VALUES {KNOWN_SENTENCES}) known(sentence, id) ON trim(sentences.sentence) = known.sentence
    GROUP BY doc_id)
  SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids,
         coalesce(array_to_string({FOUND_LICENSES}, ','), '') AS licenses,
         CAST(coalesce(length(regexp_replace({LICENSES_LEFT}, '[^<]', '', 'g')), 0) AS BIGINT) AS unmatched
  FROM documents LEFT JOIN sequences USING (doc_id)"""


def queries() -> dict[str, Query]:
    """One entry for each operator; each takes (spark, sf_dir)."""
    return {
        "op1_exact_dedup": _exact_dedup,
        "op2_quality_model": _quality_model,
        "op3_secret_scan": _secret_scan,
        "op4_token_counts": _token_counts,
        "op5_bpe": _bpe,
        "op6_quality_rules": _quality_rules,
        "op7_license_scan": _license_scan,
        "op8_simhash": _simhash,
        "op9_class_lm": _class_lm,
        "op10_packing": _packing,
        "op11_language_id": _language_id,
        "op12_token_alignment": _token_alignment,
        "op13_periodic_runs": _periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT_DEDUP, "op3_secret_scan": SECRET_SCAN, "op6_quality_rules": QUALITY_RULES, "op7_license_scan": LICENSE_SCAN}
