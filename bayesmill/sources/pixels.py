"""Pixel tables as files: text lines, cleaned list dumps, image directories, and
write-once materialisation.

* ``to_pixel_text`` / ``parse_pixel_text``: ``label,p1,...,pn`` lines.
* ``clean_list_text``: turns list-repr dumps into comma text with the fixed
  chain of deletions the reference applies.
* ``read_image_rows``: a directory of image files -> one row per image
  ``(image_id, label, pixels)``. Decoding is Spark's image source (JVM); its
  ``data`` is row-major BGR, and a batch of images becomes channel-major RGB by
  one turn of its bytes (``decode_images``), whatever the images' size.
* ``materialize_once``: write a table the first time, read it afterwards.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Batches of images are turned in Python workers; this module's code travels
# with the task instead of requiring the package on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the list-dump cleaner, applied in this order: the opening
# quote/bracket prefix is removed, a quote-comma-quote join becomes a comma,
# the characters ] \ ' are removed, every letter n is removed, and every
# backslash is removed.
CLEAN_STEPS = (
    ("\\[\"\\['", ""),
    ("'\", '", ","),
    ("[\\]\\\\'\\]]", ""),
    ("n", ""),
    ("\\\\", ""),
)


def to_pixel_text(df: DataFrame, label_col: str = "label", col: str = "pixels") -> DataFrame:
    """``value = label,p1,...,pn``."""
    return df.select(F.concat_ws(",", F.col(label_col).cast("string"),
                                 F.array_join(F.col(col).cast("array<string>"), ",")).alias("value"))


# What a number reader takes for a number, decimal or hexadecimal.
DECIMAL = r"^[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?$"
HEXADECIMAL = r"^[-+]?0[xX][0-9a-fA-F]+$"


def number(text: Column) -> Column:
    """The whole part of a decimal, exponent or hexadecimal number (blanks around it don't count); null for anything else."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    sign = F.when(t.startswith("-"), -1).otherwise(1)
    from_hex = F.conv(F.regexp_extract(t, "0[xX]([0-9a-fA-F]+)$", 1), 16, 10).try_cast("int") * sign
    return F.when(t.rlike(DECIMAL), t.try_cast("double").try_cast("int")).when(t.rlike(HEXADECIMAL), from_hex)


def parse_pixel_text(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``(label int, pixels array<int>)``: comma split, first value the label.

    Values are read as numbers (``12.0``, ``1e2``, ``0x1F``); what is none, and
    empty pieces, are dropped, as a number reader skipping them would.
    """
    nums = F.filter(F.transform(F.split(F.col(value_col), ","), number), lambda v: v.isNotNull())
    staged = lines.select(nums.alias("_v"))
    return staged.select(F.get("_v", F.lit(0)).alias("label"),
                         F.slice("_v", 2, F.greatest(F.size("_v") - 1, F.lit(0))).alias("pixels"))


def records_from_flat(df: DataFrame, col: str, record_len: int, out_col: str = "record") -> DataFrame:
    """Cut a flat array into consecutive records of ``record_len`` values
    (``record_no``, ``record``); a short tail is kept as a shorter record."""
    n = F.size(col)
    count = F.ceil(n / F.lit(record_len)).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    recs = F.transform(starts, lambda i: F.struct(i.alias("record_no"),
                                                  F.slice(F.col(col), i * record_len + 1, record_len).alias(out_col)))
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.explode(recs).alias("_r")).select(*keep, "_r.record_no", f"_r.{out_col}")


def clean_list_text(value: Column | str) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    for pattern, repl in CLEAN_STEPS:
        c = F.regexp_replace(c, pattern, repl)
    return c


# Fixed values of the list-dump fixture line: ["['v1', 'v2', ...']\n"] with a
# literal backslash-n, as a text dump of a nested list prints it.
DUMP_OPEN = "[\"['"
DUMP_SEP = "', '"
DUMP_CLOSE = "']\\n\"]"


def list_dump(label: Column, pixels: Column) -> Column:
    """A list-repr dump line of one image (the input shape the cleaner expects)."""
    vals = F.array_join(F.concat(F.array(label.cast("string")), pixels.cast("array<string>")), DUMP_SEP)
    return F.concat(F.lit(DUMP_OPEN), vals, F.lit(DUMP_CLOSE))


def write_text(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def materialize_once(df: DataFrame, path: str, source: str) -> DataFrame:
    """Write ``df`` as Parquet below ``path`` unless a finished table of the same ``source`` is there; read it back.

    ``source`` names the input (its folder, a version). A writer fills a folder
    of its own and then renames it to the table's name, which the file system
    does for one writer alone: a table is whole from the moment it has its name,
    two jobs never mix their files, and a job that dies leaves only its own
    folder. The writer that comes second drops its files and reads the first's.
    The store must rename folders in one step, as HDFS and local disks do.
    """
    spark = df.sparkSession
    store = _Store(spark, path)
    table = f"{path.rstrip('/')}/table-{hashlib.sha256(source.encode()).hexdigest()[:32]}"
    if not store.exists(table):
        own = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
        df.write.parquet(own)
        if not store.claim(own, table):
            store.drop(own)
    return spark.read.parquet(table)


class _Store:
    """The file system of a path: existence, a rename that fails where the target is, and removal."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.system = self.path(path).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), conf)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        self.options = spark.sparkContext._gateway.new_array(kind, 1)
        self.options[0] = getattr(kind, "NONE")

    def exists(self, path: str) -> bool:
        return self.system.exists(self.path(path))

    def claim(self, own: str, table: str) -> bool:
        qualified = lambda p: self.system.makeQualified(self.path(p))
        try:
            self.context.rename(qualified(own), qualified(table), self.options)
        except Py4JJavaError:
            if self.exists(table):
                return False
            raise
        return True

    def drop(self, path: str) -> None:
        self.system.delete(self.path(path), True)


# ---------------------------------------------------------------- image files

def _turned(shape: tuple[int, int, int], order: str):
    """Batches of image bytes (rows of B, G, R) as channel-major pixels."""
    c, h, w = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            if _differs(b.column("height"), h) or _differs(b.column("width"), w):
                raise ValueError("image of another size than the shape")
            channels = b.column("nChannels").to_numpy()
            out = np.empty((b.num_rows, c, h, w), np.int32)
            data = b.column("data").to_pylist()
            for n in np.unique(channels).tolist():  # grey, three channels, or four: three of them are kept
                mine = np.flatnonzero(channels == n)
                px = np.frombuffer(b"".join([data[i] for i in mine.tolist()]), np.uint8).reshape(len(mine), h, w, n)
                out[mine] = (px[..., 2::-1] if n >= 3 else px[..., :1]).transpose(0, 3, 1, 2)
            flat = (out if order == "yx" else out.transpose(0, 1, 3, 2)).reshape(-1)
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * (c * h * w)
            yield pa.RecordBatch.from_arrays([b.column("origin"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["origin", "pixels"])

    return run


def _differs(column: pa.Array, value: int) -> bool:
    return bool((column.to_numpy(zero_copy_only=False) != value).any())


def decode_images(images: DataFrame, shape: tuple[int, int, int], order: str = "yx") -> DataFrame:
    """``(origin, pixels array<int>)`` of ``(origin, height, width, nChannels, data)``, as Spark's image source has them."""
    if order not in ("yx", "xy"):
        raise ValueError(f"invalid pixel order: {order}")
    if shape[0] != 3:
        raise ValueError("images become three channels")
    cols = images.select("origin", "height", "width", "nChannels", "data")
    return cols.mapInArrow(_turned(shape, order), "origin string, pixels array<int>")


def image_rows(images: DataFrame, shape: tuple[int, int, int], labels: DataFrame | None = None,
               id_col: str = "image_id", order: str = "yx") -> DataFrame:
    """``(image_id, label, pixels array<int>)`` of decoded images, channel order R, G, B.

    Pixels go row by row, or column by column with ``order='xy'``. An image of
    another height or width than ``shape`` fails the job. The id is the file
    name before the first dot, as a long integer. With
    ``labels`` (``image_id, label``) every image must find its label (the job
    fails otherwise).
    """
    name = F.element_at(F.split("origin", "/"), -1)
    rid = F.split_part(name, F.lit("."), F.lit(1)).cast("long")
    rows = decode_images(images, shape, order).select(rid.alias(id_col), "pixels")
    if labels is None:
        return rows
    lab = labels.select(id_col, "label")
    joined = rows.join(lab, id_col, "left")
    # the check is part of the output value, so column pruning cannot drop it
    ok = F.assert_true(F.col("label").isNotNull(), F.lit("image without a label"))
    return joined.select(id_col, F.when(ok.isNull(), F.col("label")).alias("label"), "pixels")


def read_image_rows(spark: SparkSession, path: str, shape: tuple[int, int, int], labels: DataFrame | None = None,
                    id_col: str = "image_id", order: str = "yx", glob: str = "*.png") -> DataFrame:
    """``image_rows`` of a folder of image files."""
    img = spark.read.format("image").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return image_rows(img.select("image.*"), shape, labels, id_col, order)
