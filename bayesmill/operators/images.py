"""Image-table operators: one row per image, pixels in a flat ``array`` column
in channel-major order (``c x h x w``: all of channel 0 row by row, then
channel 1, ...). The shape is a parameter of each call.

Geometric operators are index maps: the source index of every output pixel is
computed in Python from the shape (one constant array, cast from a string and
folded by the optimizer, so the plan has as many nodes for any shape), and the
row's work is one ``transform`` over it, so no division runs per element.
Per-image random choices (flip, crop offsets, jitter strengths and order,
lighting noise) are seeded draws of ``(seed, epoch, image id, step)``: a
re-run or a retried task gives the same image.

Colour operators with a per-image reference (grey image, grey mean) compute
the reference in an earlier projection, then blend, so nothing is recomputed
per element.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayesmill.functions import draws as D

# Per-channel mean and standard deviation of the training set
# (0..255 scale) used by the colour normalisation, and the grey weights.
CHANNEL_MEAN = (125.3, 123.0, 113.9)
CHANNEL_STD = (63.0, 62.1, 66.7)
GREY_WEIGHTS = (0.299, 0.587, 0.114)

# draw step numbers per operator (keep draws of different operators apart)
STEP_FLIP, STEP_CROP_X, STEP_CROP_Y = 1, 2, 3
STEP_BRIGHT, STEP_CONTRAST, STEP_SAT, STEP_ORDER = 4, 5, 6, 7
STEP_LIGHT = 8


def literal_array(values: Sequence[float], element: str) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{element}>")


def int_array(values: Sequence[int]) -> Column:
    return literal_array([int(v) for v in values], "int")


def _gather(px: Column, src: Sequence[int]) -> Column:
    """``out[i] = px[src[i]]`` (0-based source indexes)."""
    return F.transform(int_array(src), lambda j: F.element_at(px, j + 1))


def _coords(c: int, h: int, w: int):
    return [(ch, y, x) for ch in range(c) for y in range(h) for x in range(w)]


# ---------------------------------------------------------------- geometry

def hflip_expr(px: Column, c: int, h: int, w: int) -> Column:
    return _gather(px, [ch * h * w + y * w + (w - 1 - x) for ch, y, x in _coords(c, h, w)])


def crop_expr(px: Column, c: int, h: int, w: int, x1: int, y1: int, size: int) -> Column:
    return _gather(px, [ch * h * w + (y + y1) * w + (x + x1) for ch, y, x in _coords(c, size, size)])


def hflip(df: DataFrame, shape: tuple[int, int, int], prob: float = 0.5, seed: int = 0, epoch: int = 1,
          id_col: str = "image_id", col: str = "pixels") -> DataFrame:
    """Mirror each image left-right with probability ``prob`` (seeded per image)."""
    c, h, w = shape
    flip = D.uniform(seed, epoch, F.col(id_col), STEP_FLIP) < prob
    return df.withColumn(col, F.when(flip, hflip_expr(F.col(col), c, h, w)).otherwise(F.col(col)))


def center_crop(df: DataFrame, shape: tuple[int, int, int], size: int, col: str = "pixels") -> DataFrame:
    c, h, w = shape
    x1, y1 = math.ceil((w - size) / 2), math.ceil((h - size) / 2)
    return df.withColumn(col, _pinned(col, crop_expr(F.col(col), c, h, w, x1, y1, size)))


def random_crop(df: DataFrame, shape: tuple[int, int, int], size: int, padding: int = 0, seed: int = 0,
                epoch: int = 1, id_col: str = "image_id", col: str = "pixels") -> DataFrame:
    """Zero-pad by ``padding`` then crop ``size x size`` at a seeded offset in [0, w+2p-size].

    An image already of the padded size equal to ``size`` is returned unchanged.
    """
    c, h, w = shape
    hp, wp = h + 2 * padding, w + 2 * padding
    if hp == size and wp == size:
        return df
    x1 = D.randint(0, wp - size, seed, epoch, F.col(id_col), STEP_CROP_X)
    y1 = D.randint(0, hp - size, seed, epoch, F.col(id_col), STEP_CROP_Y)
    staged = df.withColumn("_x1", x1).withColumn("_y1", y1)
    axes = zip(("c", "y", "x"), zip(*_coords(c, size, size), strict=True), strict=True)
    coords = F.arrays_zip(*[int_array(v).alias(name) for name, v in axes])
    zero = F.lit(0).cast(staged.schema[col].dataType.elementType)

    def pick(s):
        sy = s["y"] + F.col("_y1") - padding
        sx = s["x"] + F.col("_x1") - padding
        inside = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
        return F.when(inside, F.element_at(F.col(col), s["c"] * (h * w) + sy * w + sx + 1)).otherwise(zero)

    out = _pinned(col, _pinned("_x1", _pinned("_y1", F.transform(coords, pick))))
    return staged.withColumn(col, out).drop("_x1", "_y1")


def ten_crop(df: DataFrame, shape: tuple[int, int, int], size: int, col: str = "pixels") -> DataFrame:
    """Centre + four corners, of the image and of its mirror: 1 row -> 10 rows with ``crop_no``."""
    c, h, w = shape
    cx, cy = math.ceil((w - size) / 2), math.ceil((h - size) / 2)
    spots = [(cx, cy), (0, 0), (w - size, 0), (0, h - size), (w - size, h - size)]
    maps = []
    for flip in (False, True):
        for x1, y1 in spots:
            src = []
            for ch, y, x in _coords(c, size, size):
                sx = x + x1
                src.append(ch * h * w + (y + y1) * w + ((w - 1 - sx) if flip else sx))
            maps.append(src)
    crops = F.array(*[F.struct(F.lit(k).alias("crop_no"), int_array(m).alias("src"))
                      for k, m in enumerate(maps)])
    e = df.withColumn("_crop", F.explode(crops))
    px = F.transform(F.col("_crop.src"), lambda j: F.element_at(F.col(col), j + 1))
    return e.withColumn("crop_no", F.col("_crop.crop_no")).withColumn(col, _pinned(col, px)).drop("_crop")


# ---------------------------------------------------------------- colour

def color_normalize(df: DataFrame, shape: tuple[int, int, int], mean: Sequence[float] = CHANNEL_MEAN,
                    std: Sequence[float] = CHANNEL_STD, col: str = "pixels") -> DataFrame:
    """``(v - mean[ch]) / std[ch]`` for the first ``len(mean)`` channels; others unchanged."""
    c, h, w = shape
    hw = h * w
    m = [mean[ch] if ch < len(mean) else 0.0 for ch in range(c) for _ in range(hw)]
    s = [std[ch] if ch < len(std) else 1.0 for ch in range(c) for _ in range(hw)]
    return df.withColumn(col, F.zip_with(
        F.col(col), F.arrays_zip(literal_array([float(v) for v in m], "double").alias("m"),
                                 literal_array([float(v) for v in s], "double").alias("s")),
        lambda v, ms: (v.cast("double") - ms["m"]) / ms["s"]))


def _grey_at(px: Column, k: Column, hw: int) -> Column:
    """Grey value of pixel ``k`` (0-based within a channel), read straight from the RGB planes."""
    r, g, b = GREY_WEIGHTS
    return (F.lit(r) * F.element_at(px, k + 1).cast("double") + F.lit(g) * F.element_at(px, k + 1 + hw).cast("double")
            + F.lit(b) * F.element_at(px, k + 1 + 2 * hw).cast("double"))


def _grey_mean(px: Column, hw: int) -> Column:
    """Mean grey value of an image (one reduction per row)."""
    grey = F.transform(F.sequence(F.lit(0), F.lit(hw - 1)), lambda k: _grey_at(px, k, hw))
    return F.aggregate(grey, F.lit(0.0), lambda a, x: a + x) / F.lit(float(hw))


def _pinned(name: str, expr: Column) -> Column:
    """Use column ``name`` (a per-row value computed in an earlier projection) in ``expr``.

    The extra null test references the column a second time, which keeps the
    optimizer from inlining its (costly) defining expression into a lambda,
    where it would be re-evaluated for every element. The value is never null.
    """
    return F.when(F.col(name).isNull(), F.lit(None)).otherwise(expr)


def grayscale(df: DataFrame, shape: tuple[int, int, int], col: str = "pixels") -> DataFrame:
    """Grey value in the first three channels; further channels are unchanged."""
    c, h, w = shape
    hw = h * w
    out = F.transform(int_array([i % hw for i in range(3 * hw)]), lambda k: _grey_at(F.col(col), k, hw))
    if c > 3:
        out = F.concat(out, F.slice(F.col(col), 3 * hw + 1, (c - 3) * hw).cast("array<double>"))
    return df.withColumn(col, out)


def _blend_grey(px: Column, alpha: Column, hw: int, n: int) -> Column:
    """``alpha * img + (1 - alpha) * grey`` (the grey image at index ``i mod hw``)."""
    idx = int_array([i % hw for i in range(n)])
    return F.zip_with(px, idx, lambda v, k: alpha * v.cast("double") + (F.lit(1.0) - alpha) * _grey_at(px, k, hw))


def _blend_scalar(px: Column, alpha: Column, ref: Column) -> Column:
    """``alpha * img + (1 - alpha) * ref`` for a per-image scalar ``ref`` (0 for brightness)."""
    return F.transform(px, lambda v: alpha * v.cast("double") + (F.lit(1.0) - alpha) * ref)


def _alpha(var: float, seed, epoch, id_col, step) -> Column:
    return F.lit(1.0) + D.uniform_range(-var, var, seed, epoch, F.col(id_col), step)


def saturation(df, shape, var, seed=0, epoch=1, id_col="image_id", col="pixels"):
    c, h, w = shape
    staged = df.withColumn("_a", _alpha(var, seed, epoch, id_col, STEP_SAT))
    out = _pinned("_a", _blend_grey(F.col(col), F.col("_a"), h * w, c * h * w))
    return staged.withColumn(col, out).drop("_a")


def brightness(df, shape, var, seed=0, epoch=1, id_col="image_id", col="pixels"):
    staged = df.withColumn("_a", _alpha(var, seed, epoch, id_col, STEP_BRIGHT))
    out = _pinned("_a", _blend_scalar(F.col(col), F.col("_a"), F.lit(0.0)))
    return staged.withColumn(col, out).drop("_a")


def contrast(df, shape, var, seed=0, epoch=1, id_col="image_id", col="pixels"):
    c, h, w = shape
    staged = (df.withColumn("_gmean", _grey_mean(F.col(col), h * w))
              .withColumn("_a", _alpha(var, seed, epoch, id_col, STEP_CONTRAST)))
    out = _pinned("_gmean", _pinned("_a", _blend_scalar(F.col(col), F.col("_a"), F.col("_gmean"))))
    return staged.withColumn(col, out).drop("_gmean", "_a")


def color_jitter(df: DataFrame, shape: tuple[int, int, int], brightness_var: float = 0.0,
                 contrast_var: float = 0.0, saturation_var: float = 0.0, seed: int = 0, epoch: int = 1,
                 id_col: str = "image_id", col: str = "pixels") -> DataFrame:
    """Brightness / contrast / saturation steps with non-zero strength, in a
    seeded random order per image (each step sees the previous step's output)."""
    c, h, w = shape
    hw, n = h * w, c * h * w
    steps = [(k, v) for k, v in (("b", brightness_var), ("c", contrast_var), ("s", saturation_var)) if v]
    if not steps:
        return df
    perms = list(itertools.permutations(range(len(steps))))
    u = D.uniform(seed, epoch, F.col(id_col), STEP_ORDER)
    out = df.withColumn("_perm", F.floor(u * len(perms)).cast("int")).withColumn(col, F.col(col).cast("array<double>"))
    out = (out.withColumn("_ab", _alpha(brightness_var, seed, epoch, id_col, STEP_BRIGHT))
           .withColumn("_ac", _alpha(contrast_var, seed, epoch, id_col, STEP_CONTRAST))
           .withColumn("_as", _alpha(saturation_var, seed, epoch, id_col, STEP_SAT)))
    for stage in range(len(steps)):
        which = F.element_at(F.array(*[F.lit(p[stage]) for p in perms]), F.col("_perm") + 1)
        out = out.withColumn("_gmean", _grey_mean(F.col(col), hw))
        branch = None
        for si, (kind, _) in enumerate(steps):
            if kind == "b":
                e = _blend_scalar(F.col(col), F.col("_ab"), F.lit(0.0))
            elif kind == "c":
                e = _blend_scalar(F.col(col), F.col("_ac"), F.col("_gmean"))
            else:
                e = _blend_grey(F.col(col), F.col("_as"), hw, n)
            branch = F.when(which == si, e) if branch is None else branch.when(which == si, e)
        pinned = _pinned("_gmean", _pinned("_ab", _pinned("_ac", _pinned("_as", branch))))
        out = out.withColumn(col, pinned).drop("_gmean")
    return out.drop("_perm", "_ab", "_ac", "_as")


def lighting(df: DataFrame, shape: tuple[int, int, int], alphastd: float, eigval: Sequence[float],
             eigvec: Sequence[Sequence[float]], seed: int = 0, epoch: int = 1, id_col: str = "image_id",
             col: str = "pixels") -> DataFrame:
    """PCA lighting noise: ``rgb[i] = sum_j eigvec[i][j] * alpha_j * eigval[j]``, alpha ~ N(0, alphastd)."""
    c, h, w = shape
    hw = h * w
    if alphastd == 0:
        return df
    alphas = [D.normal(0.0, alphastd, seed, epoch, F.col(id_col), STEP_LIGHT + 10 * j) for j in range(3)]
    staged = df
    for j in range(3):
        staged = staged.withColumn(f"_a{j}", alphas[j])
    shift = [sum(F.lit(float(eigvec[i][j] * eigval[j])) * F.col(f"_a{j}") for j in range(3)) for i in range(3)]
    staged = staged.withColumn("_rgb", F.array(*shift))
    idx = int_array([min(i // hw, 2) if i // hw < 3 else -1 for i in range(c * hw)])
    out = F.zip_with(F.col(col), idx, lambda v, ch: F.when(ch >= 0, v.cast("double") + F.element_at(F.col("_rgb"), ch + 1))
                     .otherwise(v.cast("double")))
    return staged.withColumn(col, _pinned("_rgb", out)).drop("_a0", "_a1", "_a2", "_rgb")


def preprocess(df: DataFrame, shape: tuple[int, int, int], split: str, crop_size: int | None = None,
               padding: int = 4, mean=CHANNEL_MEAN, std=CHANNEL_STD, seed: int = 0, epoch: int = 1,
               id_col: str = "image_id", col: str = "pixels") -> DataFrame:
    """Train: normalise -> mirror (p=0.5) -> padded random crop. Validation: normalise."""
    c, h, w = shape
    if split == "train":
        out = color_normalize(df, shape, mean, std, col)
        out = hflip(out, shape, 0.5, seed, epoch, id_col, col)
        return random_crop(out, shape, crop_size or w, padding, seed, epoch, id_col, col)
    if split == "val":
        return color_normalize(df, shape, mean, std, col)
    raise ValueError(f"invalid split: {split}")


def channel_stats(df: DataFrame, shape: tuple[int, int, int], col: str = "pixels") -> DataFrame:
    """Per-channel mean and population std over all pixels of all images.

    Moments are merged, never taken as a difference of large sums: each row has
    its channel's mean and the sum of squares around it, and the variance of all
    pixels is the mean variance inside the rows and the variance of the rows'
    means (Spark merges those pairwise). Output ``(channel, mean, std)``.
    """
    c, h, w = shape
    hw = h * w
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x.cast("double")))
    part = [F.slice(F.col(col), ch * hw + 1, hw) for ch in range(c)]
    means = df.select(col, F.array(*[total(p, lambda x: x) / hw for p in part]).alias("_m"))
    rows = means.select("_m", F.array(*[total(p, lambda x, ch=ch: (x - F.get("_m", F.lit(ch))) * (x - F.get("_m", F.lit(ch)))) / hw for ch, p in enumerate(part)]).alias("_v"))
    at = lambda a, ch: F.get(a, F.lit(ch))
    told = rows.agg(*[F.struct(F.lit(ch).cast("long").alias("channel"), F.avg(at("_m", ch)).alias("mean"),
                               F.sqrt(F.avg(at("_v", ch)) + F.var_pop(at("_m", ch))).alias("std")).alias(f"_c{ch}") for ch in range(c)])
    return told.select(F.inline(F.array(*[f"_c{ch}" for ch in range(c)])))
