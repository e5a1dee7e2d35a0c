import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtable.functions.scalars import decode_label, encode_label, numeric_columns, safe_ratio
from voxtable.operators import correlate, profile

NAN = float("nan")


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [
        (1, "a", 1.0, 4.0, 5, 2.0),
        (2, "a", 2.0, NAN, 5, 2.0),
        (3, "b", None, 8.0, 5, 1.0),
        (4, None, 4.0, 9.0, 5, 7.0),
        (5, "b", 7.0, 1.0, 5, None),
        (6, "b", 3.0, 2.0, 5, 3.0),
    ]
    return spark.createDataFrame(rows, "id long, grp string, x double, y double, k int, z double")


def test_roles_come_from_the_schema(mixed):
    assert numeric_columns(mixed, exclude=("id",)) == ["x", "y", "k", "z"]


def test_shape_sample_and_missing(mixed):
    assert profile.dataset_shape(mixed).head() == (6, 6)
    assert [r.id for r in profile.sample_rows(mixed.repartition(3), ["id"], ["id"], 2).collect()] == [1, 2]
    missing = {r.column: r.missing for r in profile.missing_counts(mixed).collect()}
    assert missing == {"id": 0, "grp": 1, "x": 1, "y": 1, "k": 0, "z": 1}


def test_describe(mixed):
    rows = {r.column: r for r in profile.describe_numeric(mixed, ["x", "k"]).collect()}
    x = np.array([1.0, 2.0, 4.0, 7.0, 3.0])
    assert rows["x"][1:] == pytest.approx((5, x.mean(), x.std(ddof=1), 1.0, 7.0))
    assert rows["k"][1:] == (6, 5.0, 0.0, 5.0, 5.0)


def test_empty_tables_keep_their_columns(mixed):
    empty = mixed.where("id < 0")
    assert {r.column: r["count"] for r in profile.describe_numeric(empty, ["x", "k"]).collect()} == {"x": 0, "k": 0}
    assert {r.missing for r in profile.missing_counts(empty).collect()} == {0}
    label = encode_label(F.col("grp"), "b")
    assert [r["corr"] for r in correlate.feature_label_corr(empty, ["x", "y"], label).collect()] == [None, None]
    assert cells(correlate.pearson_matrix(empty, ["x", "y"]))["x", "y"] is None


def test_group_profiles_keep_the_missing_group(mixed):
    frequency = profile.group_frequency(mixed, "grp").collect()
    assert [(r.grp, r["count"], r.percent) for r in frequency] == [("b", 3, 50.0), ("a", 2, 33.3), (None, 1, 16.7)]
    stats = {r.grp: r for r in profile.group_stats(mixed, "grp", ["x"]).collect()}
    assert stats["b"].avg_x == 5.0 and stats["b"].std_x == 2.83
    assert stats["a"].max_x == 2.0 and stats[None].min_x == 4.0 and stats[None].std_x is None


def cells(df):
    return {(r.feature_a, r.feature_b): r["corr"] for r in df.collect()}


def test_listwise_matrix(mixed):
    # Rows 2, 3 and 5 have a missing cell.
    x, y, z = np.array([1.0, 4.0, 3.0]), np.array([4.0, 9.0, 2.0]), np.array([2.0, 7.0, 3.0])
    got = cells(correlate.pearson_matrix(mixed, ["x", "y", "k", "z"], digits=None))
    assert len(got) == 16
    assert got["x", "y"] == got["y", "x"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert got["y", "z"] == pytest.approx(np.corrcoef(y, z)[0, 1])
    assert got["x", "k"] is None and got["k", "k"] == 1.0


def test_pairwise_matrix(mixed):
    got = cells(correlate.pearson_matrix(mixed, ["x", "y", "z"], "pairwise", digits=None))
    both = np.array([(1.0, 4.0), (4.0, 9.0), (7.0, 1.0), (3.0, 2.0)]).T
    assert got["x", "y"] == pytest.approx(np.corrcoef(both)[0, 1])


def _frame(spark, data, width):
    names = [f"c{i}" for i in range(width)]
    rows = [tuple(line[i % len(line)] for i in range(width)) for line in data]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)), names


@pytest.mark.parametrize("method", ["listwise", "pairwise"])
@pytest.mark.parametrize("width", [2, 6, 7, 37])
def test_the_number_of_columns_changes_no_cell(spark, width, method):
    """The same two columns over and over, so every cell is known from the first ones."""
    rng = np.random.default_rng(3)
    x = rng.normal(1e3, 1, 60)
    y = x * 0.5 + rng.normal(0, 1, 60)
    inputs = {
        "some": (np.stack([x, y], 1).tolist(), np.corrcoef(x, y)[0, 1]),
        "tiny": (np.stack([x * 1e-13, y * 1e-13], 1).tolist(), np.corrcoef(x, y)[0, 1]),
        "constant": ([(2.5, v) for v in y.tolist()], None),
        "one row": ([(1.0, 2.0)], None),
        "empty": ([], None),
    }
    for name, (data, expected) in inputs.items():
        df, names = _frame(spark, data, width)
        got = cells(correlate.pearson_matrix(df, names, method, digits=None))
        assert len(got) == width * width, name
        assert all(got[c, c] == 1.0 for c in names)
        same = got["c0", "c1"]
        assert same == (None if expected is None else pytest.approx(expected, abs=1e-9)), name
        assert all(
            got[a, b] == (None if same is None else pytest.approx(same, abs=1e-9))
            for i, a in enumerate(names) for j, b in enumerate(names) if i % 2 != j % 2
        )


def test_pairs_that_are_constant_where_both_are_present(spark):
    rows = [(1.0, 5.0, None), (2.0, 5.0, None), (3.0, 6.0, 1.0), (3.0, None, 2.0), (None, 7.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = cells(correlate.pearson_matrix(df, ["a", "b", "c"], "pairwise", digits=None))
    assert got["a", "c"] is None  # a is 3 wherever c is present
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [5, 5, 6])[0, 1])


def test_feature_label_corr_is_pairwise_and_ranked(mixed):
    label = encode_label(F.col("grp"), "b")
    rows = correlate.feature_label_corr(mixed, ["k", "x", "y"], label, digits=None).collect()
    got = {r.feature: r["corr"] for r in rows}
    x = np.corrcoef([1.0, 2.0, 7.0, 3.0], [0, 0, 1, 1])[0, 1]
    y = np.corrcoef([4.0, 8.0, 1.0, 2.0], [0, 1, 1, 1])[0, 1]
    assert got["x"] == pytest.approx(x) and got["y"] == pytest.approx(y) and got["k"] is None
    assert [r.feature for r in rows] == sorted(["x", "y"], key=lambda f: -abs(got[f])) + ["k"]


def test_scalars(spark):
    df = spark.createDataFrame([("HGG", 1.0), ("LGG", 0.0), (None, 2.0)], "grade string, v double")
    encoded = df.select(encode_label(F.col("grade"), "HGG"), encode_label(F.col("grade"), "HGG", "zero"))
    assert [tuple(r) for r in encoded.collect()] == [(1, 1), (0, 0), (None, 0)]
    assert [r[0] for r in df.select(decode_label(F.col("v"), ("LGG", "HGG"))).collect()] == ["HGG", "LGG", None]
    assert [r[0] for r in df.select(safe_ratio(F.lit(3), F.col("v"))).collect()] == [3.0, 0.0, 1.5]


@pytest.mark.parametrize("method", ["listwise", "pairwise"])
@pytest.mark.parametrize("tile", [1, 3, 5])
def test_tiles_change_no_cell(spark, monkeypatch, tile, method):
    rng = np.random.default_rng(tile)
    data = rng.normal(size=(80, 8)) @ rng.normal(size=(8, 8))
    rows = [tuple(None if rng.random() < 0.05 else float(v) for v in line) for line in data]
    names = [f"c{i}" for i in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    expected = cells(correlate.pearson_matrix(df, names, method, digits=None))
    monkeypatch.setattr(correlate, "TILE", tile)
    monkeypatch.setattr(correlate, "VALUES", 20)
    got = cells(correlate.pearson_matrix(df, names, method, digits=None))
    assert got.keys() == expected.keys() and len(got) == 64
    assert all(got[k] == pytest.approx(expected[k], abs=1e-12) for k in got)


def test_many_columns_in_tiles(spark, monkeypatch, tmp_path):
    """Pairs come from a range: the plan holds no list of them."""
    monkeypatch.setattr(correlate, "TILE", 64)
    width = 150
    names = [f"c{i}" for i in range(width)]
    data = np.random.default_rng(2).normal(size=(40, width)).round(3)
    data[:, 7] = 2.5
    spark.createDataFrame(data.tolist(), names).write.parquet(str(tmp_path / "wide"))
    found = correlate.pearson_matrix(spark.read.parquet(str(tmp_path / "wide")), names, digits=None)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (0, 22500" in plan and plan.count("MapInArrow") == 6
    with np.errstate(invalid="ignore"):
        expected = np.corrcoef(data.T)
    got = cells(found)
    assert len(got) == width * width
    for i in range(0, width, 7):
        for j in range(width):
            cell = got[names[i], names[j]]
            if i == j:
                assert cell == 1.0
            elif 7 in (i, j):
                assert cell is None
            else:
                assert cell == pytest.approx(expected[i, j], abs=1e-9)
