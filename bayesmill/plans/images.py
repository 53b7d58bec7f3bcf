"""Registered image-table jobs (``embeddings`` as images) with their oracle SQL.

Outputs are long form ``(image_id, idx, value)`` (``crop_no`` added for the
ten-crop), doubles rounded to 6 places in both engines.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayesmill.functions.draws import sql_normal, sql_uniform
from bayesmill.operators import images as IM
from bayesmill.session import scratch_path
from bayesmill.sources import pixels as PX
from bayesmill.sources import tables as T

R = 6
RGB = T.RGB_SHAPE
GREY = T.GREY_SHAPE
SEED, EPOCH = 0, 1
CROP, PAD = 6, 2
CENTER = 5
TEN = 6
VAR = 0.4
# test parameters of the lighting operator (an orthonormal basis and strengths)
LIGHT_STD = 0.1
EIGVAL = (60.0, 10.0, 3.0)
EIGVEC = ((-0.5774, -0.7071, 0.4082), (-0.5774, 0.0, -0.8165), (-0.5774, 0.7071, 0.4082))
PRE_CROP, PRE_PAD = 4, 1


def _long(df: DataFrame, extra=(), double: bool = True) -> DataFrame:
    e = df.select("image_id", *extra, F.posexplode_outer("pixels").alias("idx", "value"))
    v = F.round(F.col("value").cast("double"), R) if double else F.col("value").cast("long")
    return e.select("image_id", *extra, F.col("idx").cast("long").alias("idx"), v.alias("value"))


def img_normalize(spark, sf):
    return _long(IM.color_normalize(T.rgb_images(spark, sf), RGB))


def img_hflip(spark, sf):
    return _long(IM.hflip(T.grey_images(spark, sf), GREY, 0.5, SEED, EPOCH), double=False)


def img_random_crop(spark, sf):
    return _long(IM.random_crop(T.grey_images(spark, sf), GREY, CROP, PAD, SEED, EPOCH), double=False)


def img_center_crop(spark, sf):
    return _long(IM.center_crop(T.grey_images(spark, sf), GREY, CENTER), double=False)


def img_ten_crop(spark, sf):
    t = IM.ten_crop(T.grey_images(spark, sf), GREY, TEN)
    return _long(t.withColumn("crop_no", F.col("crop_no").cast("long")), extra=("crop_no",), double=False)


def img_grayscale(spark, sf):
    return _long(IM.grayscale(T.rgb_images(spark, sf), RGB))


def img_saturation(spark, sf):
    return _long(IM.saturation(T.rgb_images(spark, sf), RGB, VAR, SEED, EPOCH))


def img_brightness(spark, sf):
    return _long(IM.brightness(T.rgb_images(spark, sf), RGB, VAR, SEED, EPOCH))


def img_contrast(spark, sf):
    return _long(IM.contrast(T.rgb_images(spark, sf), RGB, VAR, SEED, EPOCH))


def img_color_jitter(spark, sf):
    return _long(IM.color_jitter(T.rgb_images(spark, sf), RGB, VAR, VAR, VAR, SEED, EPOCH))


def img_lighting(spark, sf):
    return _long(IM.lighting(T.rgb_images(spark, sf), RGB, LIGHT_STD, EIGVAL, EIGVEC, SEED, EPOCH))


def img_preprocess(spark, sf):
    return _long(IM.preprocess(T.rgb_images(spark, sf), RGB, "train", PRE_CROP, PRE_PAD, seed=SEED, epoch=EPOCH))


def channel_stats(spark, sf):
    s = IM.channel_stats(T.rgb_images(spark, sf), RGB)
    return s.select("channel", F.round("mean", R).alias("mean"), F.round("std", R).alias("std"))


def _px_text(df: DataFrame) -> DataFrame:
    return df.select("image_id", "label", F.array_join(F.col("pixels").cast("array<string>"), ",").alias("pixels"))


def pixel_text_write(spark, sf):
    path = scratch_path(spark, "pixel-text")
    PX.write_text(PX.to_pixel_text(T.rgb_images(spark, sf)), path)
    return spark.read.text(path).select("value")


def pixel_text_parse(spark, sf):
    path = scratch_path(spark, "pixel-text")
    PX.write_text(PX.to_pixel_text(T.rgb_images(spark, sf)), path)
    p = PX.parse_pixel_text(spark.read.text(path))
    return p.select(F.col("label").cast("long").alias("label"), F.size("pixels").cast("long").alias("n_pixels"),
                    F.array_join(F.col("pixels").cast("array<string>"), ",").alias("pixels"))


def pixel_text_clean(spark, sf):
    path = scratch_path(spark, "pixel-dump")
    img = T.rgb_images(spark, sf)
    PX.write_text(img.select(PX.list_dump(F.col("label"), F.col("pixels")).alias("value")), path)
    return spark.read.text(path).select(PX.clean_list_text("value").alias("value"))


def materialize_once(spark, sf):
    path = scratch_path(spark, "materialized")
    PX.materialize_once(T.rgb_images(spark, sf), path, sf)
    again = PX.materialize_once(T.rgb_images(spark, sf), path, sf)  # found: read back, not rewritten
    return _px_text(again)


def _image_source(spark, sf) -> DataFrame:
    """The images as Spark's image source gives them: file name, size and rows of B, G, R bytes."""
    c, h, w = RGB
    at = IM.int_array([ch * h * w + y * w + x for y in range(h) for x in range(w) for ch in (2, 1, 0)])
    img = T.rgb_images(spark, sf)
    data = F.unhex(F.array_join(F.transform(at, lambda i: F.lpad(F.hex(F.element_at("pixels", i + 1)), 2, "0")), ""))
    name = F.concat(F.lit("file:/images/"), F.lpad(F.col("image_id").cast("string"), 12, "0"), F.lit(".png"))
    return img.select(name.alias("origin"), F.lit(h).alias("height"), F.lit(w).alias("width"), F.lit(c).alias("nChannels"), data.alias("data"))


def image_rows(spark, sf):
    labels = T.rgb_images(spark, sf).select("image_id", "label")
    return _px_text(PX.image_rows(_image_source(spark, sf), RGB, labels))


def img_preprocess_val(spark, sf):
    return _long(IM.preprocess(T.rgb_images(spark, sf), RGB, "val"))


def pixel_text_numbers(spark, sf):
    """Pixel text whose numbers stand in several forms: decimals, exponents, blanks around them, and pieces that are none."""
    img = T.rgb_images(spark, sf)
    form = lambda v, i: F.concat(F.when(i % 4 == 0, F.concat(v.cast("string"), F.lit(".0"))).when(i % 4 == 1, F.concat(F.lit(" "), v.cast("string"), F.lit("e0 "))).when(
        i % 4 == 2, F.concat(v.cast("string"), F.lit(",,x"))).otherwise(F.concat(F.lit("0x"), F.hex(v))))
    lines = img.select(F.concat_ws(",", F.concat(F.col("label").cast("string"), F.lit(".0")), F.array_join(F.transform("pixels", form), ",")).alias("value"))
    path = scratch_path(spark, "pixel-text")
    PX.write_text(lines, path)
    p = PX.parse_pixel_text(spark.read.text(path))
    return p.select(F.col("label").cast("long").alias("label"), F.size("pixels").cast("long").alias("n_pixels"),
                    F.array_join(F.col("pixels").cast("array<string>"), ",").alias("pixels"))


QUERIES = {
    "pixel_text_write": pixel_text_write,
    "pixel_text_parse": pixel_text_parse,
    "pixel_text_clean": pixel_text_clean,
    "materialize_once": materialize_once,
    "pixel_text_numbers": pixel_text_numbers,
    "image_rows": image_rows,
    "img_preprocess_val": img_preprocess_val,
    "img_normalize": img_normalize,
    "img_hflip": img_hflip,
    "img_random_crop": img_random_crop,
    "img_center_crop": img_center_crop,
    "img_ten_crop": img_ten_crop,
    "img_grayscale": img_grayscale,
    "img_saturation": img_saturation,
    "img_brightness": img_brightness,
    "img_contrast": img_contrast,
    "img_color_jitter": img_color_jitter,
    "img_lighting": img_lighting,
    "img_preprocess": img_preprocess,
    "channel_stats": channel_stats,
}


# ---------------------------------------------------------------- oracle SQL

def _pix(n: int) -> str:
    values = (f"list_transform(embedding, lambda x: CAST(least(255.0, greatest(0.0, "
              f"round((CAST(x AS DOUBLE) + {T.PIXEL_OFFSET!r}) * {T.PIXEL_SCALE!r}))) AS INTEGER))")
    fill = n - T.EMBEDDING_SIZE
    return f"list_concat({values}, {_ilist([0] * fill)}::INTEGER[])" if fill else values


def _img(shape) -> str:
    c, h, w = shape
    return f"SELECT vec_id AS image_id, {_pix(c * h * w)} AS px FROM embeddings"


def _ilist(v) -> str:
    return "[" + ", ".join(str(int(x)) for x in v) + "]"


def _dlist(v) -> str:
    return "([" + ", ".join(repr(float(x)) for x in v) + "]::DOUBLE[])"


def _gather(px: str, src) -> str:
    return f"list_transform({_ilist(src)}, lambda j: {px}[j + 1])"


def _coords(c, h, w):
    return [(ch, y, x) for ch in range(c) for y in range(h) for x in range(w)]


def _out(inner: str, rnd: bool = True, extra: str = "") -> str:
    v = "round(CAST(unnest(o) AS DOUBLE), 6)" if rnd else "CAST(unnest(o) AS BIGINT)"
    return f"SELECT image_id, {extra}CAST(unnest(range(0, len(o))) AS BIGINT) AS idx, {v} AS value FROM ({inner})"


def _u(step) -> str:
    return sql_uniform(SEED, EPOCH, "image_id", step)


def _randint(lo, hi, step) -> str:
    return f"CAST({lo} + floor({_u(step)} * {hi - lo + 1}) AS INTEGER)"


def _alpha(step) -> str:
    return f"(1.0 + ({-VAR!r} + {float(VAR - (-VAR))!r} * {_u(step)}))"


def _grey(px: str, h: int, w: int) -> str:
    hw = h * w
    r, g, b = IM.GREY_WEIGHTS
    return (f"list_transform(range(1, {hw + 1}), lambda k: {r!r} * CAST({px}[k] AS DOUBLE) + "
            f"{g!r} * CAST({px}[k + {hw}] AS DOUBLE) + {b!r} * CAST({px}[k + {2 * hw}] AS DOUBLE))")


def _sum(lst: str) -> str:
    return f"list_reduce({lst}, lambda a, b: a + b)"


def _blend_grey(px, grey, a, hw, n):
    return f"list_transform(range(0, {n}), lambda i: {a} * CAST({px}[i + 1] AS DOUBLE) + (1.0 - {a}) * {grey}[(i % {hw}) + 1])"


def _blend_scalar(px, ref, a):
    return f"list_transform({px}, lambda v: {a} * CAST(v AS DOUBLE) + (1.0 - {a}) * {ref})"


def _normalize(px: str, shape) -> str:
    c, h, w = shape
    hw = h * w
    m = [IM.CHANNEL_MEAN[ch] if ch < 3 else 0.0 for ch in range(c) for _ in range(hw)]
    s = [IM.CHANNEL_STD[ch] if ch < 3 else 1.0 for ch in range(c) for _ in range(hw)]
    return (f"list_transform(range(0, {c * hw}), lambda i: (CAST({px}[i + 1] AS DOUBLE) - {_dlist(m)}[i + 1]) "
            f"/ {_dlist(s)}[i + 1])")


def _hflip(px: str, shape) -> str:
    c, h, w = shape
    src = [ch * h * w + y * w + (w - 1 - x) for ch, y, x in _coords(c, h, w)]
    return f"CASE WHEN {_u(IM.STEP_FLIP)} < 0.5 THEN {_gather(px, src)} ELSE {px} END"


def _random_crop_sql(src_sql: str, shape, size, pad, zero="0") -> str:
    c, h, w = shape
    hp, wp = h + 2 * pad, w + 2 * pad
    inner = (f"SELECT image_id, px, {_randint(0, wp - size, IM.STEP_CROP_X)} AS x1, "
             f"{_randint(0, hp - size, IM.STEP_CROP_Y)} AS y1 FROM ({src_sql})")
    ss = size * size
    pick = (f"list_transform(range(0, {c * ss}), lambda o: CASE WHEN "
            f"(o % {ss}) // {size} + y1 - {pad} BETWEEN 0 AND {h - 1} AND o % {size} + x1 - {pad} BETWEEN 0 AND {w - 1} "
            f"THEN px[(o // {ss}) * {h * w} + ((o % {ss}) // {size} + y1 - {pad}) * {w} + (o % {size} + x1 - {pad}) + 1] "
            f"ELSE {zero} END)")
    return f"SELECT image_id, {pick} AS px FROM ({inner})"


def _ten_crop_sql() -> str:
    c, h, w = GREY
    size = TEN
    cx, cy = math.ceil((w - size) / 2), math.ceil((h - size) / 2)
    spots = [(cx, cy), (0, 0), (w - size, 0), (0, h - size), (w - size, h - size)]
    arms, k = [], 0
    for flip in (False, True):
        for x1, y1 in spots:
            src = [ch * h * w + (y + y1) * w + ((w - 1 - (x + x1)) if flip else (x + x1)) for ch, y, x in _coords(c, size, size)]
            inner = f"SELECT image_id, {_gather('px', src)} AS o FROM ({_img(GREY)})"
            arms.append(_out(inner, rnd=False, extra=f"CAST({k} AS BIGINT) AS crop_no, "))
            k += 1
    return " UNION ALL ".join(arms)


def _jitter_sql() -> str:
    c, h, w = RGB
    hw, n = h * w, c * h * w
    steps = ["b", "c", "s"]
    perms = list(itertools.permutations(range(3)))
    cur = (f"SELECT image_id, CAST(floor({_u(IM.STEP_ORDER)} * {len(perms)}) AS INTEGER) AS perm, "
           f"list_transform(px, lambda v: CAST(v AS DOUBLE)) AS px FROM ({_img(RGB)})")
    alph = {"b": _alpha(IM.STEP_BRIGHT), "c": _alpha(IM.STEP_CONTRAST), "s": _alpha(IM.STEP_SAT)}
    for stage in range(3):
        which = f"{_ilist([p[stage] for p in perms])}[perm + 1]"
        g = f"SELECT image_id, perm, px, {_grey('px', h, w)} AS grey FROM ({cur})"
        g2 = f"SELECT image_id, perm, px, grey, {_sum('grey')} / {float(hw)!r} AS gmean FROM ({g})"
        cases = []
        for si, kind in enumerate(steps):
            a = alph[kind]
            if kind == "b":
                e = _blend_scalar("px", "0.0", a)
            elif kind == "c":
                e = _blend_scalar("px", "gmean", a)
            else:
                e = _blend_grey("px", "grey", a, hw, n)
            cases.append(f"WHEN {which} = {si} THEN {e}")
        cur = f"SELECT image_id, perm, CASE {' '.join(cases)} END AS px FROM ({g2})"
    return _out(f"SELECT image_id, px AS o FROM ({cur})")


def _lighting_sql() -> str:
    c, h, w = RGB
    hw = h * w
    a = [sql_normal(0.0, LIGHT_STD, SEED, EPOCH, "image_id", IM.STEP_LIGHT + 10 * j) for j in range(3)]
    stage = f"SELECT image_id, px, {a[0]} AS a0, {a[1]} AS a1, {a[2]} AS a2 FROM ({_img(RGB)})"
    shift = []
    for i in range(3):
        terms = " + ".join(f"{float(EIGVEC[i][j] * EIGVAL[j])!r} * a{j}" for j in range(3))
        shift.append(f"({terms})")
    stage2 = f"SELECT image_id, px, [{', '.join(shift)}] AS rgb FROM ({stage})"
    o = f"list_transform(range(0, {c * hw}), lambda i: CAST(px[i + 1] AS DOUBLE) + rgb[(i // {hw}) + 1])"
    return _out(f"SELECT image_id, {o} AS o FROM ({stage2})")


def _preprocess_sql() -> str:
    norm = f"SELECT image_id, {_normalize('px', RGB)} AS px FROM ({_img(RGB)})"
    flip = f"SELECT image_id, {_hflip('px', RGB)} AS px FROM ({norm})"
    crop = _random_crop_sql(flip, RGB, PRE_CROP, PRE_PAD, zero="0.0")
    return _out(f"SELECT image_id, px AS o FROM ({crop})")


def _sql() -> dict[str, str]:
    c3, h3, w3 = RGB
    hw3 = h3 * w3
    c1, h1, w1 = GREY
    cx, cy = math.ceil((w1 - CENTER) / 2), math.ceil((h1 - CENTER) / 2)
    center_src = [ch * h1 * w1 + (y + cy) * w1 + (x + cx) for ch, y, x in _coords(c1, CENTER, CENTER)]
    return {
        "img_normalize": _out(f"SELECT image_id, {_normalize('px', RGB)} AS o FROM ({_img(RGB)})"),
        "img_hflip": _out(f"SELECT image_id, {_hflip('px', GREY)} AS o FROM ({_img(GREY)})", rnd=False),
        "img_random_crop": _out(f"SELECT image_id, px AS o FROM ({_random_crop_sql(_img(GREY), GREY, CROP, PAD)})",
                                rnd=False),
        "img_center_crop": _out(f"SELECT image_id, {_gather('px', center_src)} AS o FROM ({_img(GREY)})", rnd=False),
        "img_ten_crop": _ten_crop_sql(),
        "img_grayscale": _out(f"SELECT image_id, list_transform(range(0, {3 * hw3}), lambda i: g[(i % {hw3}) + 1]) AS o "
                              f"FROM (SELECT image_id, {_grey('px', h3, w3)} AS g FROM ({_img(RGB)}))"),
        "img_saturation": _out(f"SELECT image_id, {_blend_grey('px', 'g', _alpha(IM.STEP_SAT), hw3, c3 * hw3)} AS o "
                               f"FROM (SELECT image_id, px, {_grey('px', h3, w3)} AS g FROM ({_img(RGB)}))"),
        "img_brightness": _out(f"SELECT image_id, {_blend_scalar('px', '0.0', _alpha(IM.STEP_BRIGHT))} AS o "
                               f"FROM ({_img(RGB)})"),
        "img_contrast": _out(f"SELECT image_id, {_blend_scalar('px', 'gm', _alpha(IM.STEP_CONTRAST))} AS o FROM "
                             f"(SELECT image_id, px, {_sum(_grey('px', h3, w3))} / {float(hw3)!r} AS gm FROM ({_img(RGB)}))"),
        "img_color_jitter": _jitter_sql(),
        "img_lighting": _lighting_sql(),
        "img_preprocess": _preprocess_sql(),
        "img_preprocess_val": _out(f"SELECT image_id, {_normalize('px', RGB)} AS o FROM ({_img(RGB)})"),
        "channel_stats": f"SELECT CAST(i // {hw3} AS BIGINT) AS channel, round(avg(CAST(v AS DOUBLE)), 6) AS mean, "
                         f"round(stddev_pop(CAST(v AS DOUBLE)), 6) AS std FROM (SELECT unnest(range(0, len(px))) AS i, "
                         f"unnest(px) AS v FROM ({_img(RGB)})) GROUP BY 1",
    }


def _sq(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _clean_sql(v: str) -> str:
    for pattern, repl in PX.CLEAN_STEPS:
        v = f"regexp_replace({v}, {_sq(pattern)}, {_sq(repl)}, 'g')"
    return v


def _pixel_sql() -> dict[str, str]:
    px = f"(SELECT vec_id AS image_id, label, {_pix(math.prod(RGB))} AS px FROM embeddings)"
    txt = f"SELECT image_id, label, array_to_string(px, ',') AS pixels FROM {px}"
    vals = f"array_to_string(list_concat([CAST(label AS VARCHAR)], list_transform(px, lambda v: CAST(v AS VARCHAR))), {_sq(PX.DUMP_SEP)})"
    dump = f"{_sq(PX.DUMP_OPEN)} || {vals} || {_sq(PX.DUMP_CLOSE)}"
    return {
        "pixel_text_write": f"SELECT CAST(label AS VARCHAR) || ',' || array_to_string(px, ',') AS value FROM {px}",
        "pixel_text_parse": f"SELECT CAST(label AS BIGINT) AS label, CAST(len(px) AS BIGINT) AS n_pixels, "
                            f"array_to_string(px, ',') AS pixels FROM {px}",
        "pixel_text_numbers": f"SELECT CAST(label AS BIGINT) AS label, CAST(len(px) AS BIGINT) AS n_pixels, "
                              f"array_to_string(px, ',') AS pixels FROM {px}",
        "pixel_text_clean": f"SELECT {_clean_sql('d')} AS value FROM (SELECT {dump} AS d FROM {px})",
        "materialize_once": txt,
        "image_rows": txt,
    }


SQL = {**_pixel_sql(), **_sql()}
