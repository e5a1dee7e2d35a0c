"""The same results as the registered queries, stated in SQL over the given tables."""

from __future__ import annotations

from itertools import product

# Names are stated here once more, so that a wrong list in the library shows.
MODALITIES = ("flair", "t1", "t1ce", "t2")
INTENSITY_STATS = ("mean", "std", "min", "max", "skewness")
REDUNDANT_COLUMNS = (
    "voxels_ch0", "voxels_ch1", "voxels_ch2", "t2_max", "end_slice", "t1_max", "spread_x",
    "spread_y", "t1_skewness", "tumour_slice_count", "start_slice",
)
FEATURE_COLUMNS = (
    "volume_id", "voxels_ch0", "voxels_ch1", "voxels_ch2", "total_tumour_voxels", "ratio_ch0",
    "ratio_ch1", "ratio_ch2", "tumour_slice_count", "start_slice", "end_slice", "flair_mean",
    "flair_std", "flair_min", "flair_max", "flair_skewness", "t1_mean", "t1_std", "t1_min",
    "t1_max", "t1_skewness", "t1ce_mean", "t1ce_std", "t1ce_min", "t1ce_max", "t1ce_skewness",
    "t2_mean", "t2_std", "t2_min", "t2_max", "t2_skewness", "centroid_x", "centroid_y",
    "centroid_slice", "spread_x", "spread_y", "spread_slice", "subject_id", "grade",
)


def _r(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


SLICE_META = """
  SELECT l_orderkey AS volume_id, l_linenumber AS slice,
         CAST(round(l_discount * 100) AS BIGINT) AS n0, CAST(round(l_tax * 100) AS BIGINT) AS n1,
         CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS BIGINT) AS n2
  FROM lineitem"""

META_FEATURES = f"""
  SELECT volume_id, voxels_ch0, voxels_ch1, voxels_ch2, total AS total_tumour_voxels,
         {", ".join(f"{_r(f'CASE WHEN total = 0 THEN 0.0 ELSE voxels_ch{c} / total END')} AS ratio_ch{c}" for c in range(3))},
         tumour_slice_count, start_slice, end_slice
  FROM (SELECT *, voxels_ch0 + voxels_ch1 + voxels_ch2 AS total FROM (
    SELECT volume_id, CAST(sum(n0) AS BIGINT) AS voxels_ch0, CAST(sum(n1) AS BIGINT) AS voxels_ch1,
           CAST(sum(n2) AS BIGINT) AS voxels_ch2,
           count(*) FILTER (WHERE n0 > 0 OR n1 > 0 OR n2 > 0) AS tumour_slice_count,
           CAST(coalesce(min(slice) FILTER (WHERE n0 > 0 OR n1 > 0 OR n2 > 0), -1) AS BIGINT) AS start_slice,
           CAST(coalesce(max(slice) FILTER (WHERE n0 > 0 OR n1 > 0 OR n2 > 0), -1) AS BIGINT) AS end_slice
    FROM ({SLICE_META}) GROUP BY volume_id))"""

# All pixels of the tensor stand-in, then the active ones.
PIXELS = f"""
  SELECT vec_id // 2 AS volume_id, vec_id AS slice_idx, pos, pos // 4 AS y, pos % 4 AS x,
         {", ".join(f"CAST(embedding[pos * 4 + {m + 1}] AS DOUBLE) AS v{m}" for m in range(4))},
         {", ".join(f"embedding[pos * 4 + {c + 1}] > 0.25 AS a{c}" for c in range(3))}
  FROM embeddings, (SELECT unnest(range(16)) AS pos)"""
ACTIVE = f"SELECT * FROM ({PIXELS}) WHERE a0 OR a1 OR a2"
GRADED = "CASE WHEN v{c} > 0.4::FLOAT THEN '4' WHEN v{c} > 0.3::FLOAT THEN '2' WHEN v{c} > 0.25 THEN '1' ELSE '0' END"
TENSOR_VOLUMES = "SELECT DISTINCT vec_id // 2 AS volume_id FROM embeddings"

INTENSITY = f"""
  SELECT k.volume_id, k.modality,
         {", ".join(f"CASE WHEN s.volume_id IS NULL THEN 0.0 ELSE {_r('s.' + stat)} END AS {stat}" for stat in INTENSITY_STATS)}
  FROM (SELECT volume_id, modality FROM ({TENSOR_VOLUMES}), (SELECT unnest({list(MODALITIES)}) AS modality)) k
  LEFT JOIN (
    SELECT volume_id, modality, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max,
           CASE WHEN sum((v - mu) ** 2) > 0
                THEN sqrt(count(*)) * sum((v - mu) ** 3) / sum((v - mu) ** 2) ** 1.5 END AS skewness
    FROM (SELECT *, avg(v) OVER (PARTITION BY volume_id, modality) AS mu FROM (
      {" UNION ALL ".join(f"SELECT volume_id, '{name}' AS modality, v{m} AS v FROM ({ACTIVE})" for m, name in enumerate(MODALITIES))}))
    GROUP BY volume_id, modality) s
  ON k.volume_id = s.volume_id AND k.modality = s.modality"""

INTENSITY_WIDE = f"""
  SELECT volume_id,
         {", ".join(f"max({s}) FILTER (WHERE modality = '{m}') AS {m}_{s}" for m, s in product(MODALITIES, INTENSITY_STATS))}
  FROM ({INTENSITY}) GROUP BY volume_id"""

SPATIAL = f"""
  SELECT volume_id,
         {", ".join(f"{_r(f'coalesce(avg({c}), 0.0)')} AS centroid_{axis}" for axis, c in (("x", "x"), ("y", "y"), ("slice", "slice_idx")))},
         {", ".join(f"{_r(f'coalesce(stddev_pop({c}), 0.0)')} AS spread_{axis}" for axis, c in (("x", "x"), ("y", "y"), ("slice", "slice_idx")))}
  FROM ({TENSOR_VOLUMES}) LEFT JOIN ({ACTIVE}) USING (volume_id) GROUP BY volume_id"""

EXTENT = f"""
  SELECT volume_id, count(DISTINCT slice_idx) AS tumour_slice_count,
         coalesce(min(slice_idx), -1) AS start_slice, coalesce(max(slice_idx), -1) AS end_slice
  FROM ({TENSOR_VOLUMES}) LEFT JOIN ({ACTIVE}) USING (volume_id) GROUP BY volume_id"""

ALL_FEATURES = f"""
  SELECT volume_id, n_slices, voxels_ch0, voxels_ch1, voxels_ch2, total_tumour_voxels,
         {", ".join(f"{_r(f'CASE WHEN voxels_ch0 + voxels_ch1 + voxels_ch2 = 0 THEN 0.0 ELSE voxels_ch{c} / (voxels_ch0 + voxels_ch1 + voxels_ch2) END')} AS ratio_ch{c}" for c in range(3))},
         e.* EXCLUDE (volume_id), i.* EXCLUDE (volume_id), p.* EXCLUDE (volume_id)
  FROM (SELECT volume_id, count(DISTINCT slice_idx) AS n_slices,
               {", ".join(f"count(*) FILTER (WHERE a{c}) AS voxels_ch{c}" for c in range(3))},
               count(*) FILTER (WHERE a0 OR a1 OR a2) AS total_tumour_voxels
        FROM ({PIXELS}) GROUP BY volume_id) c
  JOIN ({EXTENT}) e USING (volume_id) JOIN ({INTENSITY_WIDE}) i USING (volume_id)
  JOIN ({SPATIAL}) p USING (volume_id)"""

SLICES = "SELECT vec_id // 2 AS volume_id, vec_id AS slice_idx, embedding FROM embeddings"

PAIRS = ((0, 1), (0, 2), (1, 2))

NATION_LABELS = """
  SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS volume_id, n_name AS subject_id, r_name AS grade
  FROM customer LEFT JOIN (
    SELECT CAST(regexp_extract(n_name, '_([0-9]+)$', 1) AS BIGINT) AS id, n_name, r_name
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey < 4) m
  ON c_nationkey = m.id"""

SUBJECTS = """
  SELECT CAST(regexp_extract(c_name, '#([0-9]+)$', 1) AS BIGINT) AS volume_id, c_name AS subject_id,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'HGG' ELSE 'LGG' END AS grade
  FROM customer"""

SURVIVAL = "SELECT c_name AS subject_id, c_acctbal AS age FROM customer WHERE c_mktsegment = 'BUILDING'"

FEATURE_TABLE = f"""
  SELECT {", ".join(FEATURE_COLUMNS)},
         {_r("coalesce(age, median(age) OVER ())")} AS age
  FROM ({META_FEATURES}) JOIN ({INTENSITY_WIDE}) USING (volume_id) JOIN ({SPATIAL}) USING (volume_id)
  LEFT JOIN ({SUBJECTS}) USING (volume_id) LEFT JOIN ({SURVIVAL}) USING (subject_id)"""

FEATURE_TABLE_IDS = f"""
  SELECT volume_id, grade, age
  FROM ({TENSOR_VOLUMES}) SEMI JOIN ({SLICE_META}) USING (volume_id)
  LEFT JOIN ({SUBJECTS}) USING (volume_id) LEFT JOIN ({SURVIVAL}) USING (subject_id)"""

DOCUMENT_LABELS = """
  SELECT d.doc_id, text, lang, source, n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

EXACT_SPLIT = """
  SELECT doc_id, CAST(lang = 'en' AS INTEGER) AS label,
         CASE WHEN CAST('0x' || substr(md5('42:' || doc_id), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split,
         CAST('0x' || substr(md5('42:' || doc_id), 9, 8) AS BIGINT) % 5 AS fold
  FROM documents"""

EDA_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def _digest(seed: str, key: str, part: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), {1 + 8 * part}, 8) AS BIGINT)"


SPLIT = f"""
  SELECT doc_id, CAST(quality AS DOUBLE) AS label,
         CASE WHEN {_digest("42", "doc_id", 0)} % 100 < 80 THEN 'train' ELSE 'test' END AS split,
         CAST({_digest("42", "doc_id", 1)} % 5 AS INTEGER) AS fold
  FROM documents JOIN labels USING (doc_id)"""

SCORED = """
  SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS label, value AS score, model,
         CAST(value > cut AS INTEGER) AS prediction
  FROM events, (VALUES ('value > 100', 100.0), ('value > 50', 50.0)) m(model, cut)"""
ONE_MODEL = f"SELECT * FROM ({SCORED}) WHERE model = 'value > 100'"

CLASS_METRICS = f"""
  SELECT model,
         sum(correct) / sum(actual) AS accuracy,
         sum(actual * CASE WHEN predicted = 0 THEN 0.0 ELSE correct / predicted END) / sum(actual) AS precision,
         sum(actual * correct / actual) / sum(actual) AS recall,
         sum(actual * 2.0 * correct / (actual + predicted)) / sum(actual) AS f1
  FROM (SELECT model, class, count(*) FILTER (WHERE label = class) AS actual,
               count(*) FILTER (WHERE prediction = class) AS predicted,
               count(*) FILTER (WHERE label = class AND prediction = class) AS correct
        FROM ({SCORED}), (VALUES (0), (1)) k(class) GROUP BY model, class)
  WHERE actual > 0 GROUP BY model"""

def _auc(scored: str) -> str:
    return f"""
  SELECT model, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT model, score, CAST(sum(label) AS DOUBLE) AS pos,
                     CAST(sum(1 - label) AS DOUBLE) AS neg
              FROM ({scored}) GROUP BY model, score))
  GROUP BY model"""


AUC = _auc(SCORED)
SCORED_BY_RANGES = """
  SELECT CAST(event_type = 'purchase' AS INTEGER) AS label, model,
         CASE model WHEN 'wide' THEN value WHEN 'narrow' THEN value / 1048576 + 0.5 ELSE -value * 1024 END AS score
  FROM events, (VALUES ('wide'), ('narrow'), ('turned')) m(model)"""

METRICS_LONG = " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, {_r(m)} AS value FROM ({CLASS_METRICS}) JOIN ({AUC}) USING (model)"
    for m in ("accuracy", "auc", "precision", "recall", "f1")
)


def _matrix(columns: list[str], rows: str, digits: int) -> str:
    cells = [
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
        + ("CAST(1.0 AS DOUBLE)" if a == b else f"{_r(f'corr({a}, {b})', digits)}")
        + f" AS corr FROM ({rows})"
        + (" LIMIT 1" if a == b else "")
        for a, b in product(columns, columns)
    ]
    return " UNION ALL ".join(f"({c})" for c in cells)


LABEL_CORR = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_r(f'corr({c}, CASE WHEN l_returnflag = {chr(39)}R{chr(39)} THEN 1.0 ELSE 0.0 END)', 4)} AS corr FROM lineitem"
    for c in EDA_COLUMNS
)

IMPORTANCE = f"""
  SELECT CAST(row_number() OVER (ORDER BY importance DESC, position) AS INTEGER) AS rank, feature, importance
  FROM (SELECT feature, abs(corr) AS importance,
               list_position({list(EDA_COLUMNS)}, feature) AS position FROM ({LABEL_CORR}))"""

META_COLUMNS = [
    "voxels_ch0",
    "voxels_ch1",
    "voxels_ch2",
    "total_tumour_voxels",
    "ratio_ch0",
    "ratio_ch1",
    "ratio_ch2",
    "tumour_slice_count",
    "start_slice",
    "end_slice",
]

ORACLES: dict[str, str] = {
    "slice_meta_features": META_FEATURES,
    "missing_volumes": """
        SELECT o_orderkey AS volume_id FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "volume_slice_stats": """
        SELECT count(*) AS n_volumes, min(n) AS min_slices, max(n) AS max_slices,
               round(avg(n), 1) AS mean_slices
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""",
    "volume_ids": "SELECT DISTINCT l_orderkey AS volume_id FROM lineitem ORDER BY 1",
    "slice_file_ids": f"""
        SELECT path, CAST(regexp_extract(path, 'volume_([0-9]+)_slice_([0-9]+)', 1) AS BIGINT) AS volume_id,
               CAST(regexp_extract(path, 'volume_([0-9]+)_slice_([0-9]+)', 2) AS BIGINT) AS slice_idx
        FROM (SELECT 'data/volume_' || volume_id || '_slice_' || slice || '.h5' AS path FROM ({SLICE_META}))""",
    "slice_listing": "SELECT vec_id // 2 AS volume_id, vec_id AS slice_idx FROM embeddings",
    "clustered_slices": f"""
        SELECT vec_id // 2 AS volume_id, vec_id AS slice_idx, 4 AS h, 4 AS w, 48 AS mask_size,
               {_r("list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE)))")} AS total
        FROM embeddings""",
    "clustered_features": f"""
        SELECT m.*, f.n_slices, f.total_tumour_voxels AS union_voxels, f.flair_mean, f.centroid_x
        FROM ({META_FEATURES}) m JOIN ({ALL_FEATURES}) f USING (volume_id)""",
    "mixed_types": """
        SELECT CASE WHEN vec_id % 3 = 0 THEN 'double' ELSE 'float' END AS image_type,
               CASE WHEN vec_id % 3 = 0 THEN 'int32' ELSE 'int8' END AS mask_type, count(*) AS n_slices
        FROM embeddings GROUP BY ALL""",
    "csv_roundtrip": SLICE_META,
    "intensity_features": INTENSITY,
    "intensity_features_wide": INTENSITY_WIDE,
    "spatial_features": SPATIAL,
    "slice_extent": EXTENT,
    "first_active_slice": f"""
        SELECT volume_id, min(slice_idx) AS first_slice
        FROM ({TENSOR_VOLUMES}) LEFT JOIN ({ACTIVE}) USING (volume_id) GROUP BY volume_id""",
    "all_features": ALL_FEATURES,
    "mask_values_per_slice": f"""
        SELECT volume_id, slice_idx, string_agg(DISTINCT v, ',' ORDER BY v) AS mask_values
        FROM (SELECT volume_id, slice_idx, unnest([{", ".join(GRADED.format(c=c) for c in range(3))}]) AS v FROM ({PIXELS}))
        GROUP BY volume_id, slice_idx""",
    "mask_values_per_channel": " UNION ALL ".join(
        f"""SELECT volume_id, slice_idx, {c} AS channel, string_agg(DISTINCT v, ',' ORDER BY v) AS mask_values
            FROM (SELECT volume_id, slice_idx, {GRADED.format(c=c)} AS v FROM ({PIXELS})) GROUP BY volume_id, slice_idx"""
        for c in range(3)
    ),
    "mask_values_per_volume": f"""
        SELECT volume_id, string_agg(DISTINCT v, ',' ORDER BY v) AS mask_values
        FROM (SELECT volume_id, unnest([{", ".join(GRADED.format(c=c) for c in range(3))}]) AS v FROM ({PIXELS}))
        GROUP BY volume_id""",
    "mask_values_per_volume_channel": " UNION ALL ".join(
        f"""SELECT volume_id, {c} AS channel, string_agg(DISTINCT v, ',' ORDER BY v) AS mask_values
            FROM (SELECT volume_id, {GRADED.format(c=c)} AS v FROM ({PIXELS})) GROUP BY volume_id"""
        for c in range(3)
    ),
    "active_pixels": f"""
        SELECT volume_id, slice_idx, {", ".join(f"count(*) FILTER (WHERE a{c}) AS active_ch{c}" for c in range(3))}
        FROM ({PIXELS}) GROUP BY volume_id, slice_idx""",
    "channel_overlap": " UNION ALL ".join(
        f"SELECT 'ch{a} & ch{b}' AS pair, count(*) FILTER (WHERE a{a} AND a{b}) AS pixels FROM ({PIXELS})"
        for a, b in PAIRS
    ),
    "channel_disjoint": f"""
        SELECT volume_id, union_pixels, sum_pixels, union_pixels = sum_pixels AS disjoint
        FROM (SELECT volume_id, count(*) FILTER (WHERE a0 OR a1 OR a2) AS union_pixels,
                     CAST(sum(CAST(a0 AS INTEGER) + CAST(a1 AS INTEGER) + CAST(a2 AS INTEGER)) AS BIGINT) AS sum_pixels
              FROM ({PIXELS}) GROUP BY volume_id)""",
    "tensor_shape_census": """
        SELECT CASE WHEN vec_id % 3 = 0 THEN 2 ELSE 4 END AS h, 4 AS w,
               CASE WHEN vec_id % 3 = 0 THEN 32 ELSE 64 END AS image_size,
               CASE WHEN vec_id % 3 = 0 THEN 24 ELSE 48 END AS mask_size, count(*) AS n_slices
        FROM embeddings GROUP BY 1, 3, 4""",
    "attach_label": NATION_LABELS,
    "label_coverage": f"""
        SELECT count(grade) AS present, count(*) - count(grade) AS missing, count(*) AS total
        FROM ({NATION_LABELS})""",
    "label_frequencies": f"""
        SELECT grade, count(*) AS n FROM ({NATION_LABELS}) WHERE grade IS NOT NULL GROUP BY grade""",
    "attach_attribute_median": f"""
        SELECT volume_id, subject_id, {_r("coalesce(age, median(age) OVER ())")} AS age
        FROM ({SUBJECTS}) LEFT JOIN ({SURVIVAL}) USING (subject_id)""",
    "attribute_coverage": f"""
        SELECT count(age) AS present, count(*) - count(age) AS missing, count(*) AS total
        FROM ({SUBJECTS}) LEFT JOIN ({SURVIVAL}) USING (subject_id)""",
    "exact_median": f"SELECT {_r('median(l_extendedprice)')} AS median FROM lineitem",
    "feature_table": FEATURE_TABLE,
    "clean_features": f"""
        SELECT * EXCLUDE ({", ".join(REDUNDANT_COLUMNS)}, grade),
               CASE WHEN grade = 'HGG' THEN 1 WHEN grade IS NOT NULL THEN 0 END AS grade
        FROM ({FEATURE_TABLE})""",
    "skipped_volumes": f"""
        SELECT DISTINCT volume_id FROM ({SLICE_META})
        WHERE volume_id NOT IN (SELECT volume_id FROM ({TENSOR_VOLUMES}))""",
    "dataset_shape": """
        SELECT count(*) AS n_rows,
               (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE lineitem)) AS n_columns FROM lineitem""",
    "sample_rows": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_extendedprice LIMIT 5""",
    "describe_numeric": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {_r(f"avg({c})")} AS mean,
                   {_r(f"stddev_samp({c})", 4)} AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
            FROM lineitem"""
        for c in EDA_COLUMNS
    ),
    "missing_counts": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing FROM ({DOCUMENT_LABELS})"""
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "group_frequency": """
        SELECT l_returnflag, count(*) AS "count",
               round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS percent
        FROM lineitem GROUP BY l_returnflag""",
    "group_stats": f"""
        SELECT l_returnflag, {", ".join(
            f"CAST(round({fn}({c}), 2) + 0.0 AS DOUBLE) AS {s}_{c}"
            for (s, fn), c in product(
                (("avg", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min")), EDA_COLUMNS))}
        FROM lineitem GROUP BY l_returnflag""",
    "pearson_matrix": _matrix(list(EDA_COLUMNS), "SELECT * FROM lineitem", 4),
    "pearson_matrix_wide": _matrix(META_COLUMNS, "SELECT * FROM meta", 4),
    "feature_label_corr": f"SELECT feature, corr, abs(corr) AS abs_corr FROM ({LABEL_CORR})",
    "rank_importance": IMPORTANCE,
    "top_k": f"SELECT * FROM ({IMPORTANCE}) ORDER BY rank LIMIT 3",
    "hash_split": SPLIT,
    "class_distribution": f"""
        SELECT split, CASE WHEN label = 1 THEN 'HGG' ELSE 'LGG' END AS grade, count(*) AS "count"
        FROM ({SPLIT}) GROUP BY split, label""",
    "assemble_report": f"""
        SELECT count(*) FILTER (WHERE n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL) AS kept,
               count(*) FILTER (WHERE n_chars IS NULL OR quality IS NULL OR toxic IS NULL) AS dropped,
               count(*) FILTER (WHERE quality IS NULL) AS without_label,
               count(*) FILTER (WHERE quality IS NOT NULL AND (n_chars IS NULL OR toxic IS NULL)) AS without_feature,
               count(*) AS total
        FROM ({DOCUMENT_LABELS})""",
    "pearson_missing": " UNION ALL ".join(
        f"SELECT *, '{method}' AS method FROM ({_matrix(['doc_id', 'n_chars', 'quality', 'toxic'], rows, 4)})"
        for method, rows in (
            ("listwise", f"SELECT * FROM ({DOCUMENT_LABELS}) WHERE quality IS NOT NULL AND toxic IS NOT NULL"),
            ("pairwise", f"SELECT * FROM ({DOCUMENT_LABELS})"),
        )
    ),
    "label_corr_missing": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_r(f'corr({c}, quality)', 4)} AS corr, abs({_r(f'corr({c}, quality)', 4)}) AS abs_corr FROM ({DOCUMENT_LABELS})"
        for c in ("doc_id", "n_chars", "toxic")
    ),
    "describe_by_dtype": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {_r(f"avg({c})")} AS mean,
                   {_r(f"stddev_samp({c})", 4)} AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
            FROM ({DOCUMENT_LABELS})"""
        for c in ("n_chars", "quality", "toxic")
    ),
    "raw_tables": f"""
        SELECT 'slice' AS kind, volume_id || ':' || slice AS key, n0 || ':' || n1 || ':' || n2 AS text,
               CAST(NULL AS DOUBLE) AS number FROM ({SLICE_META})
        UNION ALL SELECT 'name', n_name, r_name, NULL FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey < 4
        UNION ALL SELECT 'age', subject_id, NULL, age FROM ({SURVIVAL})""",
    "single_file_roundtrip": """
        SELECT count(*) AS n_volumes, round(avg(n), 1) AS mean_slices, CAST(1 AS BIGINT) AS n_files
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""",
    "exact_model_predictions": f"""
        SELECT doc_id, CASE WHEN label = 1 THEN 'HGG' ELSE 'LGG' END AS actual_label,
               CASE WHEN label = 1 THEN 'HGG' ELSE 'LGG' END AS predicted_label,
               CAST(1 - label AS DOUBLE) AS "prob_LGG", CAST(label AS DOUBLE) AS "prob_HGG"
        FROM ({EXACT_SPLIT}) WHERE split = 'test'""",
    "exact_model_boosted": " UNION ALL ".join(
        f"""SELECT '{an}' AS actual, '{pn}' AS predicted, count(*) FILTER (WHERE label = {a} AND {a} = {p}) AS "count"
            FROM ({EXACT_SPLIT}) WHERE split = 'test'"""
        for (a, an), (p, pn) in product(enumerate(("LGG", "HGG")), repeat=2)
    ),
    "exact_model_cv": f"""
        SELECT 'exact' AS model, CAST(1.0 AS DOUBLE) AS cv_auc, CAST(count(*) AS INTEGER) AS folds_scored
        FROM (SELECT fold FROM ({EXACT_SPLIT}) WHERE split = 'train' GROUP BY fold HAVING count(DISTINCT label) = 2)""",
    "exact_model_grid": "SELECT * FROM (VALUES (0, 0.5::DOUBLE, false), (1, 1.0::DOUBLE, true)) t(candidate, cv_auc, best)",
    "exact_model_importance": """
        SELECT * FROM (VALUES (0, 'n_chars', 0.0::DOUBLE), (1, 'is_english', 1.0::DOUBLE),
                              (2, 'source_number', 0.0::DOUBLE)) t(position, feature, importance)""",
    "prediction_totals": f"""
        SELECT doc_id, CASE WHEN label = 1 THEN 'HGG' ELSE 'LGG' END AS actual_label, CAST(1.0 AS DOUBLE) AS total
        FROM ({SPLIT}) WHERE split = 'test'""",
    "importance_total": "SELECT CAST(1.0 AS DOUBLE) AS total",
    "best_models": f"""
        SELECT metric, arg_max(model, value + CASE WHEN model = 'value > 100' THEN 1e-12 ELSE 0 END) AS winner, max(value) AS value
        FROM ({METRICS_LONG}) GROUP BY metric""",
    "build_reports": f"""
        WITH known AS (SELECT * FROM ({FEATURE_TABLE_IDS}))
        SELECT 'label' AS report, grade AS what, count(*) AS n FROM known WHERE grade IS NOT NULL GROUP BY grade
        UNION ALL SELECT 'label_coverage', 'present', count(grade) FROM known
        UNION ALL SELECT 'label_coverage', 'missing', count(*) - count(grade) FROM known
        UNION ALL SELECT 'label_coverage', 'total', count(*) FROM known
        UNION ALL SELECT 'attribute_coverage', 'present', count(age) FROM known
        UNION ALL SELECT 'attribute_coverage', 'missing', count(*) - count(age) FROM known
        UNION ALL SELECT 'attribute_coverage', 'total', count(*) FROM known
        UNION ALL SELECT 'rows_without_volume', 'slice_meta', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
        UNION ALL SELECT 'rows_without_volume', 'tensor_slices', count(*) FILTER (WHERE vec_id IS NULL) FROM embeddings
        UNION ALL SELECT 'skipped_volumes', 'total', count(DISTINCT volume_id) FROM ({SLICE_META})
          WHERE volume_id NOT IN (SELECT volume_id FROM ({TENSOR_VOLUMES}))""",
    "confusion_matrix": " UNION ALL ".join(
        f"""SELECT '{an}' AS actual, '{pn}' AS predicted,
                   count(*) FILTER (WHERE label = {a} AND prediction = {p}) AS "count" FROM ({ONE_MODEL})"""
        for (a, an), (p, pn) in product(enumerate(("LGG", "HGG")), repeat=2)
    ),
    "class_metrics": f"""
        SELECT model, {", ".join(f"{_r(m)} AS {m}" for m in ("accuracy", "precision", "recall", "f1"))}
        FROM ({CLASS_METRICS})""",
    "auc_exact": f"SELECT round(auc, 10) AS auc FROM ({AUC}) WHERE model = 'value > 100'",
    "auc_by_model": f"SELECT model, round(auc, 10) AS auc FROM ({_auc(SCORED_BY_RANGES)})",
    "metrics_long": METRICS_LONG,
    "model_winner": f"""
        SELECT metric, first_value, second_value,
               CASE WHEN first_value >= second_value THEN 'value > 100' ELSE 'value > 50' END AS winner
        FROM (SELECT metric, max(value) FILTER (WHERE model = 'value > 100') AS first_value,
                     max(value) FILTER (WHERE model = 'value > 50') AS second_value
              FROM ({METRICS_LONG}) GROUP BY metric)""",
}
ORACLES["clean_roundtrip"] = ORACLES["clean_features"]
ORACLES["pearson_matrix_wide"] = f"WITH meta AS ({META_FEATURES}) {ORACLES['pearson_matrix_wide']}"
