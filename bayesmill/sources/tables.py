"""Parquet table access and the inputs each job family derives from them.

The driver tables stand in for the reference's inputs:

* corpus: ``documents(doc_id, text)``; training documents ``doc_id % 5 <> 0``,
  test documents ``doc_id % 5 = 0`` (every document is used by one side),
* label lines: one comma list of codes per ``labels`` row (allowed codes plus
  noise codes and a repeated code),
* byte files: ``hex(text)`` laid out as a byte dump (address + 2-char codes),
* images / score vectors: ``embeddings(vec_id, embedding, label)``.
"""

from __future__ import annotations

import math
import os
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.functions.labels import label_set

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the test fixture: the three classes derived from `labels`.
CLASSES = ("HIQ", "LOQ", "TOX")
TEST_MODULUS = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def is_test_doc(id_col: str = "doc_id") -> Column:
    return (F.col(id_col) % TEST_MODULUS) == 0


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def train_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).where(~is_test_doc())


def test_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).where(is_test_doc())


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line)``: e.g. ``E11,HIQ,TOX,M11,HIQ`` (noise codes, a repeat)."""
    lab = read_table(spark, sf_dir, "labels")
    q = F.when(F.col("quality") == 1, "HIQ").when(F.col("quality") == 0, "LOQ")
    t = F.when(F.col("toxic") == 1, "TOX")
    rep = F.when(F.col("quality") == 1, "HIQ")
    line = F.concat_ws(",", F.lit("E11"), q, t, F.lit("M11"), rep)
    return lab.select("doc_id", line.alias("line"))


def label_sets(spark: SparkSession, sf_dir: str, allowed=CLASSES) -> DataFrame:
    """``(doc_id, classes array<string>)`` parsed from the label lines."""
    return label_lines(spark, sf_dir).select("doc_id", label_set("line", allowed).alias("classes"))


# ---------------------------------------------------------------- byte dumps

# Fixed values of the byte-dump fixture: 16 codes per line after an
# 8-character address, CRLF line ends, the line-feed byte shown as "??".
BYTE_ADDRESS = "00401000"
BYTES_PER_LINE = 16
BYTE_PATH_PREFIX = "/data/bytes/"


def byte_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, path, text)``: the text that becomes a file's content (``with_byte_content``)."""
    path = F.concat(F.lit(BYTE_PATH_PREFIX), F.md5(F.col("doc_id").cast("string")), F.lit(".bytes"))
    return corpus(spark, sf_dir).select("doc_id", path.alias("path"), "text")


def with_byte_content(files: DataFrame) -> DataFrame:
    """``text`` replaced by ``content``: ``hex(text)`` laid out as a byte dump.

    Whole lines are laid out by one match each, the rest of the last line code by code.
    """
    codes, width = F.col("_hex"), 2 * BYTES_PER_LINE
    rest = F.length(codes) % width
    line = " ".join(f"${k}" for k in range(1, BYTES_PER_LINE + 1))
    whole = F.regexp_replace(F.substring(codes, F.lit(1), F.length(codes) - rest), "(..)" * BYTES_PER_LINE, line + " \r\n" + BYTE_ADDRESS + " ")
    last = F.regexp_replace(F.right(codes, rest), "(..)", "$1 ")
    content = F.replace(F.concat(F.lit(BYTE_ADDRESS + " "), whole, last), F.lit("0A "), F.lit("?? "))
    return files.withColumn("_hex", F.hex("text")).withColumn("content", content).drop("text", "_hex")


_CODES = np.array([list(f"{b:02X} ".replace("0A ", "?? ").encode()) for b in range(256)], np.uint8)
_NEXT_LINE = np.frombuffer(f"\r\n{BYTE_ADDRESS} ".encode(), np.uint8)


def byte_dump(text: bytes) -> bytes:
    """The ``content`` that ``with_byte_content`` gives a text, for tasks that write it: far quicker than by matches."""
    codes = np.take(_CODES, np.frombuffer(text, np.uint8), axis=0)
    n = len(codes) // BYTES_PER_LINE
    lines = np.empty((n, 3 * BYTES_PER_LINE + len(_NEXT_LINE)), np.uint8)
    lines[:, :3 * BYTES_PER_LINE] = codes[:n * BYTES_PER_LINE].reshape(n, 3 * BYTES_PER_LINE)
    lines[:, 3 * BYTES_PER_LINE:] = _NEXT_LINE
    return BYTE_ADDRESS.encode() + b" " + lines.tobytes() + codes[n * BYTES_PER_LINE:].tobytes()


def byte_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, path, content)``: one file per document."""
    return with_byte_content(byte_paths(spark, sf_dir))


def byte_id_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id file: ``(doc_id, id)`` for labelled documents, in doc_id order."""
    lab = read_table(spark, sf_dir, "labels")
    return lab.select("doc_id", F.substring(F.md5(F.col("doc_id").cast("string")), 13, 20).alias("id"))


def byte_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label file: ``(doc_id, label)``, class 1..4 = 1 + 2*quality + toxic, in doc_id order."""
    lab = read_table(spark, sf_dir, "labels")
    return lab.select("doc_id", (F.lit(1) + F.col("quality") * 2 + F.col("toxic")).cast("string").alias("label"))


# ---------------------------------------------------------------- images and scores

# Fixed values of the image fixture: the 64 embedding values and 11 zeros form
# a 3 x 5 x 5 colour image, the 64 values a 1 x 8 x 8 grey image; values are
# mapped to 0..255 by round((x + 0.6) * 212) clipped.
EMBEDDING_SIZE = 64
RGB_SHAPE = (3, 5, 5)
GREY_SHAPE = (1, 8, 8)
PIXEL_OFFSET = 0.6
PIXEL_SCALE = 212.0


def _to_pixel(x: Column) -> Column:
    v = F.round((x.cast("double") + F.lit(PIXEL_OFFSET)) * F.lit(PIXEL_SCALE), 0)
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), v)).cast("int")


def rgb_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(image_id, label, pixels array<int>)``, shape ``RGB_SHAPE``."""
    e = read_table(spark, sf_dir, "embeddings")
    fill = F.array_repeat(F.lit(0), math.prod(RGB_SHAPE) - EMBEDDING_SIZE)
    return e.select(F.col("vec_id").alias("image_id"), "label",
                    F.concat(F.transform("embedding", _to_pixel), fill).alias("pixels"))


def grey_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(image_id, label, pixels array<int>)``, shape ``GREY_SHAPE``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("image_id"), "label", F.transform("embedding", _to_pixel).alias("pixels"))


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, target, scores array<double>)``: dot products of each embedding
    with every label centroid (centroid = mean embedding of the label).

    The centroid table has one row per label (a closed, small set); it is
    folded into a single scalar array, so scoring is a per-row expression with
    no join and no shuffle of the embeddings.
    """
    e = read_table(spark, sf_dir, "embeddings")
    dim = e.select(F.posexplode("embedding").alias("i", "x"), "label")
    cent = dim.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    per_label = cent.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("v"))
    table = per_label.agg(F.array_sort(F.collect_list(F.struct("label", F.col("v.m").alias("m")))).alias("c")).scalar()
    # the scalar is bound to a column first: subqueries cannot sit inside lambdas
    bound = e.select("vec_id", "label", "embedding", table.alias("_cent"))
    scores = F.transform("_cent", lambda cen: F.aggregate(
        F.zip_with(F.col("embedding"), cen["m"], lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x))
    return bound.select(F.col("vec_id").alias("id"), F.col("label").alias("target"), scores.alias("scores"))


N_CROPS = 10


def crop_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, crop, target, scores)``: ten slightly perturbed score vectors per image,
    ``s_k + 0.001 * (((id * 7 + crop * 13 + k * 31) % 17) - 8)``."""
    s = class_scores(spark, sf_dir)
    e = s.select("id", "target", "scores", F.explode(F.sequence(F.lit(0), F.lit(N_CROPS - 1))).alias("crop"))
    pert = F.transform("scores", lambda v, k: v + F.lit(0.001) * (
        ((F.col("id") * 7 + F.col("crop") * 13 + k * 31) % 17) - 8).cast("double"))
    return e.select("id", "crop", "target", pert.alias("scores"))
