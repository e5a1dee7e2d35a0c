"""Tensor features against NumPy, slice by slice."""

import re

import numpy as np
import pytest
from pyspark.errors import PySparkException

from voxtable.operators import tensors
from voxtable.schemas import MODALITIES, TENSOR_SLICES, TensorLayout


def make_slices(spark, slices):
    rows = [
        (v, s, mask.shape[0], mask.shape[1], image.ravel().tolist(), mask.ravel().tolist())
        for v, s, image, mask in slices
    ]
    return spark.createDataFrame(rows, TENSOR_SLICES)


def random_slices(seed=0, modalities=4, channels=3):
    """Five volumes of ragged slices: busy, hot (most slices), sparse, one voxel, empty."""
    rng = np.random.default_rng(seed)
    density = {1: 0.4, 2: 0.1, 3: 0.02, 4: 0.0, 5: 0.0}
    slices = []
    for volume, share in density.items():
        for s in range(40 if volume == 2 else 6):
            h, w = (5, 7) if volume == 1 else (6, 3)
            image = rng.normal(50, 20, (h, w, modalities)).astype("float32")
            mask = (rng.random((h, w, channels)) < share).astype(int) * rng.integers(1, 4)
            if volume == 4 and s == 3:
                mask[2, 1, 1] = 1
            slices.append((volume, s * 10, image, mask))
    return slices


def brute_force(slices):
    result = {}
    for volume in {s[0] for s in slices}:
        own = [(i, im, m > 0) for v, i, im, m in slices if v == volume]
        union = [m.any(axis=-1) for _, _, m in own]
        ys, xs = np.concatenate([np.argwhere(u) for u in union]).reshape(-1, 2).T
        ss = np.concatenate([np.full(u.sum(), i) for (i, _, _), u in zip(own, union)])
        row = {"n_slices": len(own), "total_tumour_voxels": int(sum(u.sum() for u in union))}
        channels = [int(sum(m[..., c].sum() for _, _, m in own)) for c in range(own[0][2].shape[-1])]
        for c, n in enumerate(channels):
            row[f"voxels_ch{c}"] = n
            row[f"ratio_ch{c}"] = n / sum(channels) if sum(channels) else 0.0
        active = [i for (i, _, _), u in zip(own, union) if u.any()]
        row["tumour_slice_count"] = len(active)
        row["start_slice"], row["end_slice"] = (min(active), max(active)) if active else (-1, -1)
        for m, name in enumerate(MODALITIES):
            v = np.concatenate([im[..., m][u] for (_, im, _), u in zip(own, union)]).astype(float)
            if not v.size:
                row |= {f"{name}_{s}": 0.0 for s in ("mean", "std", "min", "max", "skewness")}
                continue
            d = v - v.mean()
            skew = (d**3).mean() / (d**2).mean() ** 1.5 if (d**2).sum() > 0 else None
            row |= {
                f"{name}_mean": v.mean(),
                f"{name}_std": v.std(),
                f"{name}_min": v.min(),
                f"{name}_max": v.max(),
                f"{name}_skewness": skew,
            }
        for axis, v in (("x", xs), ("y", ys), ("slice", ss)):
            row[f"centroid_{axis}"] = v.mean() if v.size else 0.0
            row[f"spread_{axis}"] = v.std() if v.size else 0.0
        result[volume] = row
    return result


def assert_rows(df, expected):
    rows = {r.volume_id: r.asDict() for r in df.collect()}
    assert rows.keys() == expected.keys()
    for volume, row in rows.items():
        for column in set(df.columns) - {"volume_id"}:
            want = expected[volume][column]
            assert row[column] == (None if want is None else pytest.approx(want, abs=1e-9)), column


def test_volume_features_match_numpy(spark):
    slices = random_slices()
    expected = brute_force(slices)
    assert expected[4]["t1_skewness"] is None  # a single voxel
    assert expected[5]["t1_skewness"] == 0.0  # no voxel
    df = make_slices(spark, slices)
    assert_rows(tensors.volume_features(df), expected)
    assert_rows(tensors.intensity_features_wide(df), expected)
    assert_rows(tensors.spatial_features(df), expected)
    assert_rows(tensors.slice_extent(df), expected)


def test_partitioning_does_not_matter(spark):
    slices = random_slices(1)
    df = make_slices(spark, slices)
    expected = brute_force(slices)
    assert_rows(tensors.volume_features(df.repartition(13)), expected)
    assert_rows(tensors.volume_features(df.coalesce(1).orderBy("slice_idx")), expected)


def test_long_and_wide_intensity_agree(spark):
    df = make_slices(spark, random_slices())
    wide = {r.volume_id: r for r in tensors.intensity_features_wide(df).collect()}
    long = tensors.intensity_features(df).collect()
    assert len(long) == 5 * 4
    for r in long:
        assert r["mean"] == pytest.approx(wide[r.volume_id][f"{r.modality}_mean"])


def test_sum_of_channels_as_whole(spark):
    df = make_slices(spark, random_slices())
    for r in tensors.volume_features(df, whole_mask="sum").collect():
        assert r.total_tumour_voxels == r.voxels_ch0 + r.voxels_ch1 + r.voxels_ch2
        assert r.ratio_ch0 + r.ratio_ch1 + r.ratio_ch2 == pytest.approx(
            1.0 if r.total_tumour_voxels else 0.0
        )


def test_further_modalities_get_numbered_names(spark):
    layout = TensorLayout.of_width(5, channels=2)
    assert layout.modalities == (*MODALITIES, "mod4")
    slices = random_slices(modalities=5, channels=2)
    row = tensors.volume_features(make_slices(spark, slices), layout).where("volume_id = 1").head()
    own = [(im[..., 4], (m > 0).any(axis=-1)) for v, _, im, m in slices if v == 1]
    assert row.mod4_mean == pytest.approx(np.concatenate([i[u] for i, u in own]).astype(float).mean())


def test_wrong_mask_size_raises(spark):
    rows = [(1, 0, 2, 2, [0.0] * 16, [1] * 11)]
    with pytest.raises(PySparkException, match="mask size differs"):
        tensors.spatial_features(spark.createDataFrame(rows, TENSOR_SLICES)).collect()


def test_channel_counts_match_numpy(spark):
    slices = random_slices(2)
    df = make_slices(spark, slices)
    rows = {(r.volume_id, r.slice_idx): r for r in tensors.channel_counts(df).collect()}
    assert len(rows) == len(slices)
    for v, s, _, m in slices:
        r, a = rows[v, s], m > 0
        assert [r.active_ch0, r.active_ch1, r.active_ch2] == a.sum(axis=(0, 1)).tolist()
        assert r.overlap_ch0_ch2 == (a[..., 0] & a[..., 2]).sum()
        assert r.union_pixels == a.any(axis=-1).sum()
        assert r.disjoint == (a.any(axis=-1).sum() == a.sum())
    total = tensors.channel_overlap(df).collect()
    assert {r.pair: r.pixels for r in total}["ch1 & ch2"] == sum(
        ((m[..., 1] > 0) & (m[..., 2] > 0)).sum() for *_, m in slices
    )
    assert tensors.active_pixels(df, [0, 10]).count() == 10


def test_mask_values_are_raw_and_sorted(spark):
    mask = np.zeros((2, 2, 3), int)
    mask[0, 0, 0], mask[1, 1, 0], mask[0, 1, 2], mask[1, 0, 2] = 4, 2, 1, -3
    df = make_slices(spark, [(1, 0, np.zeros((2, 2, 4)), mask)])
    assert tensors.mask_values_per_slice(df).head().mask_values == "-3,0,1,2,4"
    by_channel = {r.channel: r.mask_values for r in tensors.mask_values_per_channel(df).collect()}
    assert by_channel == {0: "0,2,4", 1: "0", 2: "-3,0,1"}


def test_first_active_slice_and_shapes(spark):
    df = make_slices(spark, random_slices())
    first = {r.volume_id: r.first_slice for r in tensors.first_active_slice(df).collect()}
    assert first[4] == 30 and first[5] is None
    census = {(r.h, r.w): r.n_slices for r in tensors.tensor_shape_census(df).collect()}
    assert census == {(5, 7): 6, (6, 3): 58}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("slices") / "t")
    make_slices(spark, random_slices()).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spatial_features_do_not_read_the_image(stored):
    plan = plan_of(tensors.spatial_features(stored))
    assert "image" not in re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert plan.count("Exchange hashpartitioning") == 1


def test_all_features_take_one_scan_and_one_shuffle(stored):
    plan = plan_of(tensors.volume_features(stored))
    assert plan.count("FileScan") == plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("image", [None, [1.0] * 20])
def test_images_of_the_wrong_size_are_refused(spark, image):
    rows = [(1, 0, 2, 2, image, [1] * 12)]
    slices = spark.createDataFrame(rows, TENSOR_SLICES)
    with pytest.raises(Exception, match="image size differs"):
        tensors.intensity_features(slices).collect()
    assert tensors.spatial_features(slices).first().centroid_x == 0.5  # does not read the image
    assert tensors.slice_extent(slices).first().tumour_slice_count == 1


def test_slices_without_a_volume_are_left_out(spark):
    rows = [(None, 0, 1, 1, [1.0] * 4, [1] * 3), (7, 0, 1, 1, [1.0] * 4, [2, 0, 4])]
    slices = spark.createDataFrame(rows, TENSOR_SLICES)
    found = tensors.volume_features(slices).collect()
    assert [(r.volume_id, r.total_tumour_voxels, r.voxels_ch0) for r in found] == [(7, 1, 1)]
    values = tensors.mask_values_per_slice(slices).where("volume_id = 7").first().mask_values
    assert values == "0,2,4"


def test_generated_methods_stay_within_the_jit_limit(spark):
    rows = [(1, 0, 2, 2, [1.0] * 16, [1] * 12)]
    slices = spark.createDataFrame(rows, TENSOR_SLICES)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it will run
    try:
        stages = tensors.volume_features(slices)._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert 0 < max(sizes) < 8000  # beyond that the JVM does not compile a method


def test_mask_values_over_rows(spark):
    rng = np.random.default_rng(8)
    domain = np.array([-128, -65, -64, -1, 0, 1, 2, 4, 63, 64, 127])
    rows, expected, by_channel = [], {}, {}
    for volume in range(6):
        for s in range(20 if volume else 3):
            mask = rng.choice(domain[: 2 + 2 * volume], 12) if volume < 5 else np.array([], int)
            rows.append((volume, s, 2, 2, [], mask.tolist()))
            expected.setdefault(volume, set()).update(mask.tolist())
            for c in range(3):
                by_channel.setdefault((volume, c), set()).update(mask[c::3].tolist())
    rows += [(7, 0, 2, 2, [], None), (8, 0, 2, 2, [], [3, None, 3]), (8, 1, 2, 2, [], [-2, 3, 3])]
    expected |= {7: set(), 8: {3, -2}}
    by_channel |= {(7, c): set() for c in range(3)} | {(8, 0): {3, -2}, (8, 1): {3}, (8, 2): {3}}
    df = spark.createDataFrame(rows, TENSOR_SLICES).repartition(5)
    shown = lambda values: ",".join(map(str, sorted(values)))
    got = {r.volume_id: r.mask_values for r in tensors.mask_values(df).collect()}
    assert got == {v: shown(values) for v, values in expected.items()}
    got = {(r.volume_id, r.channel): r.mask_values for r in tensors.mask_values(df, per_channel=True).collect()}
    assert got == {key: shown(values) for key, values in by_channel.items()}
    (whole,) = tensors.mask_values(df, by=()).collect()
    assert whole.mask_values == shown(set().union(*expected.values()))
    assert tensors.mask_values(df.where("false"), by=()).first().mask_values == ""


def test_bitmaps_are_merged_before_the_exchange(spark):
    df = make_slices(spark, random_slices())
    plan = tensors.mask_values(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bit_or") > plan.index("Exchange")  # below it in the plan
    assert "ObjectHashAggregate" not in plan
