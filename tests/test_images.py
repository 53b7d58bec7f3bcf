import os
import time
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from bayesmill.operators import evaluate as EV
from bayesmill.operators import images as IM
from bayesmill.sources import pixels as PX
from tests.png import write_pngs

SHAPE = (3, 4, 4)


@pytest.fixture(scope="module")
def imgs(spark):
    rng = np.random.default_rng(7)
    rows = [(i, int(i % 10), [int(v) for v in rng.integers(0, 256, 48)]) for i in range(40)]
    return spark.createDataFrame(rows, "image_id long, label int, pixels array<int>"), rows


def test_flip_twice_is_identity(spark, imgs):
    df, rows = imgs
    once = IM.hflip(df, SHAPE, prob=1.0)
    twice = IM.hflip(once, SHAPE, prob=1.0)
    assert {r["image_id"]: r["pixels"] for r in twice.collect()} == {r[0]: r[2] for r in rows}
    first = once.where(F.col("image_id") == 0).first()["pixels"]
    a = np.array(rows[0][2]).reshape(SHAPE)
    assert first == a[:, :, ::-1].reshape(-1).tolist()


def test_crop_of_same_size_is_identity(spark, imgs):
    df, rows = imgs
    out = IM.random_crop(df, SHAPE, size=4, padding=0)
    assert {r["image_id"]: r["pixels"] for r in out.collect()} == {r[0]: r[2] for r in rows}


def test_random_crop_pads_with_zero_and_matches_numpy(spark, imgs):
    df, rows = imgs
    out = {r["image_id"]: r for r in IM.random_crop(df.withColumn("x", F.lit(1)), SHAPE, 4, padding=2)
           .collect()}
    for rid, _, px in rows[:10]:
        a = np.pad(np.array(px).reshape(SHAPE), ((0, 0), (2, 2), (2, 2)))
        got = np.array(out[rid]["pixels"]).reshape(3, 4, 4)
        # the crop is one of the windows of the padded image
        assert any((a[:, y:y + 4, x:x + 4] == got).all() for y in range(5) for x in range(5))


def test_center_and_ten_crop(spark, imgs):
    df, rows = imgs
    a = np.array(rows[0][2]).reshape(SHAPE)
    c = IM.center_crop(df.where("image_id = 0"), SHAPE, 3).first()["pixels"]
    assert c == a[:, 1:4, 1:4].reshape(-1).tolist()      # offset ceil((4-3)/2) = 1
    ten = IM.ten_crop(df.where("image_id = 0"), SHAPE, 3).orderBy("crop_no").collect()
    assert len(ten) == 10
    assert ten[1]["pixels"] == a[:, 0:3, 0:3].reshape(-1).tolist()
    assert ten[6]["pixels"] == a[:, :, ::-1][:, 0:3, 0:3].reshape(-1).tolist()


def test_normalize_and_grayscale(spark, imgs):
    df, rows = imgs
    a = np.array(rows[0][2], dtype=float).reshape(SHAPE)
    n = np.array(IM.color_normalize(df.where("image_id = 0"), SHAPE).first()["pixels"]).reshape(SHAPE)
    want = (a - np.array(IM.CHANNEL_MEAN)[:, None, None]) / np.array(IM.CHANNEL_STD)[:, None, None]
    assert np.allclose(n, want)
    g = np.array(IM.grayscale(df.where("image_id = 0"), SHAPE).first()["pixels"]).reshape(SHAPE)
    grey = 0.299 * a[0] + 0.587 * a[1] + 0.114 * a[2]
    assert np.allclose(g, np.stack([grey] * 3))


def test_contrast_keeps_grey_mean(spark, imgs):
    df, rows = imgs
    out = np.array(IM.contrast(df.where("image_id = 0"), SHAPE, 0.4).first()["pixels"]).reshape(SHAPE)
    a = np.array(rows[0][2], dtype=float).reshape(SHAPE)
    g = lambda x: (0.299 * x[0] + 0.587 * x[1] + 0.114 * x[2]).mean()
    assert g(out) == pytest.approx(g(a))


def test_channel_stats_match_numpy(spark, imgs):
    df, rows = imgs
    a = np.array([r[2] for r in rows], dtype=float).reshape(-1, 3, 16)
    got = {r["channel"]: (r["mean"], r["std"]) for r in IM.channel_stats(df, SHAPE).collect()}
    for ch in range(3):
        assert got[ch][0] == pytest.approx(a[:, ch].mean())
        assert got[ch][1] == pytest.approx(a[:, ch].std())


def test_png_round_trip(spark, imgs, tmp_path):
    df, rows = imgs
    write_pngs(str(tmp_path / "png"), {i: np.array(px).reshape(SHAPE) for i, _, px in rows})
    back = PX.read_image_rows(spark, str(tmp_path / "png"), SHAPE, df.select("image_id", "label"))
    assert {r["image_id"]: (r["label"], r["pixels"]) for r in back.collect()} == {r[0]: (r[1], r[2]) for r in rows}
    with pytest.raises(Exception, match="without a label"):
        PX.read_image_rows(spark, str(tmp_path / "png"), SHAPE, df.where("image_id > 3").select("image_id", "label")).collect()


def test_grey_and_four_channels_become_three(spark, tmp_path):
    rng = np.random.default_rng(4)
    a, g = rng.integers(0, 256, (4, 3, 2)), rng.integers(0, 256, (1, 3, 2))
    a[3] = 255
    write_pngs(str(tmp_path / "png"), {1: a, 2: g})
    got = {r["image_id"]: np.array(r["pixels"]).reshape(3, 3, 2).tolist() for r in PX.read_image_rows(spark, str(tmp_path / "png"), (3, 3, 2)).collect()}
    assert got == {1: a[:3].tolist(), 2: np.repeat(g, 3, axis=0).tolist()}


def test_ten_thousand_images_of_real_size(spark):
    n, shape = 10_000, (3, 32, 32)
    data = F.unhex(F.concat(F.lpad(F.hex("id"), 6144, "0")))
    img = spark.range(n).select(F.concat(F.lit("/x/"), "id", F.lit(".png")).alias("origin"), F.lit(32).alias("height"), F.lit(32).alias("width"), F.lit(3).alias("nChannels"), data.alias("data"))
    out = PX.image_rows(img, shape)
    plan = out._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and len(plan) < 20_000
    t = time.time()
    r = out.select(F.size("pixels").alias("n"), F.element_at("pixels", 1024).alias("red"), F.element_at("pixels", 3072).alias("blue"), "image_id").agg(
        F.min("n"), F.max("n"), F.sum("red"), F.sum("blue"), F.sum("image_id")).first()
    assert time.time() - t < 20
    ids = np.arange(n)
    assert tuple(r) == (3072, 3072, int((ids & 255).sum()), int((ids >> 16 & 255).sum()), int(ids.sum()))


def test_pixel_text_and_clean(spark):
    lines = spark.createDataFrame([("6,59,62",), ("3,,7",)], "value string")
    got = [(r["label"], r["pixels"]) for r in PX.parse_pixel_text(lines).collect()]
    assert got == [(6, [59, 62]), (3, [7])]
    dump = spark.createDataFrame([("[\"['6', '59', '62']\\n\"]",)], "value string")
    assert dump.select(PX.clean_list_text("value")).first()[0] == '6, 59, 62"'


def test_topk_with_fewer_classes_than_k(spark):
    df = spark.createDataFrame([(1, 2, [0.1, 0.5, 0.2]), (2, 0, [0.9, 0.0, 0.0])],
                               "id long, target int, scores array<double>")
    r = EV.topk_error(df, 5).first()
    assert r["top5_err"] == 0.0                    # k = min(5, 3)
    assert r["top1_err"] == pytest.approx(50.0)


def test_target_is_best_of_its_ties(spark):
    df = spark.createDataFrame([(1, 1, [0.5, 0.5, 0.1])], "id long, target int, scores array<double>")
    assert df.select(EV.target_rank("scores", "target")).first()[0] == 1


def test_crop_sum(spark):
    df = spark.createDataFrame([(1, 0, 0, [1.0, 2.0]), (1, 1, 0, [3.0, 1.0])],
                               "id long, crop int, target int, scores array<double>")
    assert EV.crop_sum(df).first()["scores"] == [4.0, 3.0]


@pytest.fixture(scope="module")
def real_size(spark):
    rng = np.random.default_rng(11)
    a = rng.integers(0, 256, (400, 3 * 32 * 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "image_id long, pixels array<int>")
    return df.repartition(4).checkpoint(), a.reshape(400, 3, 32, 32)


@pytest.mark.parametrize("name", ["preprocess", "random_crop", "ten_crop", "center_crop"])
def test_real_shape_builds_and_runs_fast(spark, real_size, name):
    df, a = real_size
    shape = (3, 32, 32)
    t = time.time()
    out = {
        "preprocess": lambda: IM.preprocess(df, shape, "train"),
        "random_crop": lambda: IM.random_crop(df, shape, 32, 4),
        "ten_crop": lambda: IM.ten_crop(df, shape, 28),
        "center_crop": lambda: IM.center_crop(IM.color_normalize(df, shape), shape, 28),
    }[name]()
    built = time.time() - t
    t = time.time()
    rows = out.select("image_id", "pixels").collect()
    ran = time.time() - t
    assert built < 1 and ran < 10, (built, ran)
    assert len(rows) == (4000 if name == "ten_crop" else 400)
    if name == "center_crop":
        r = rows[17]
        mean, std = (np.array(x)[:, None, None] for x in (IM.CHANNEL_MEAN, IM.CHANNEL_STD))
        assert np.allclose(r["pixels"], (((a[r["image_id"]] - mean) / std)[:, 2:30, 2:30]).reshape(-1))


def test_grayscale_leaves_the_fourth_channel(spark):
    df = spark.createDataFrame([(1, list(range(16)))], "image_id long, pixels array<int>")
    px = IM.grayscale(df, (4, 2, 2)).first()["pixels"]
    assert len(px) == 16 and px[12:] == [12.0, 13.0, 14.0, 15.0] and px[:4] == px[4:8] == px[8:12]


def test_png_size_and_pixel_order(spark, imgs, tmp_path):
    df, rows = imgs
    path = str(tmp_path / "png")
    write_pngs(path, {i: np.array(px).reshape(SHAPE) for i, _, px in rows})
    turned = {r["image_id"]: r["pixels"] for r in PX.read_image_rows(spark, path, SHAPE, order="xy").collect()}
    for i, _, v in rows:
        assert turned[i] == np.array(v).reshape(SHAPE).transpose(0, 2, 1).reshape(-1).tolist()
    with pytest.raises(Exception, match="another size"):
        PX.read_image_rows(spark, path, (3, 3, 4)).collect()


def test_materialize_once_follows_its_source(spark, tmp_path):
    path = str(tmp_path / "table")

    def table(n, source):
        return PX.materialize_once(spark.range(n), path, source).count()

    assert table(3, "a") == 3
    assert table(5, "a") == 3            # same source: not written again
    assert table(5, "b") == 5            # another source
    assert table(9, "a") == 3


def test_a_writer_that_dies_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "table")
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        PX.materialize_once(broken, path, "a")
    assert not [f for f in os.listdir(path) if f.startswith("table")]
    assert PX.materialize_once(spark.range(7), path, "a").count() == 7


def test_two_writers_never_mix(spark, tmp_path):
    path = str(tmp_path / "table")

    def write(k):
        return PX.materialize_once(spark.range(400, numPartitions=8).select(F.lit(k).alias("writer"), "id"), path, "a").select("writer").distinct().count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(write, range(4))) == [1] * 4
    assert spark.read.parquet(*[os.path.join(path, f) for f in os.listdir(path)]).count() == 400
    assert [f[:6] for f in os.listdir(path)] == ["table-"]


def test_channel_stats_without_cancellation(spark):
    px = [100_000_000 + k % 2 for k in range(12)]
    got = IM.channel_stats(spark.createDataFrame([(px,)] * 5, "pixels array<int>"), (3, 2, 2)).collect()
    assert [r["std"] for r in got] == [pytest.approx(0.5, abs=1e-9)] * 3
    far = [[1e8] * 4 + [1e8 + 1] * 4 + [0.0] * 4, [1e8 + 1] * 4 + [1e8] * 4 + [2.0] * 4]
    got = IM.channel_stats(spark.createDataFrame([(p,) for p in far], "pixels array<double>"), (3, 2, 2)).collect()
    assert [r["std"] for r in got] == [pytest.approx(x, abs=1e-9) for x in (0.5, 0.5, 1.0)]


def test_pixel_numbers(spark):
    lines = spark.createDataFrame([("7,12.0,3,,x,300",), ("7.0,1e2, 5 ,0x1F,-3,1d,NaN,.5,1e400,+4",), ("x,y",), ("",)], "value string")
    got = [(r["label"], r["pixels"]) for r in PX.parse_pixel_text(lines).collect()]
    assert got == [(7, [12, 3, 300]), (7, [100, 5, 31, -3, 0, 4]), (None, []), (None, [])]
