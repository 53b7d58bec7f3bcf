"""Line-numbered text and CSV sources (``zipWithIndex`` in file order, distributed).

A line's position is ordered by (file path, start offset of its split, its
position inside the split). The position comes from
``monotonically_increasing_id`` evaluated in the scan stage, where a task reads
a split front to back; each split's running offset comes from one small row
per split, so no task sees all lines. Files are numbered in path order, which for Spark's own output
(``part-00000``, ``part-00001``, ...) is the order the rows were written in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.operators.order import manifest, running_offsets
from bayesmill.session import ensure_checkpoint_dir


def _indexed(df: DataFrame, name: str) -> DataFrame:
    """Number rows by (file, split start, position in the split).

    A split is read front to back by one task, so ``monotonically_increasing_id``
    is consecutive inside it. Each split's size and first id (one small row per
    split) give its running offset. Split bounds depend on the cores that are
    there, so the tagged lines are checkpointed first: counting and numbering
    read the one materialised copy, whatever executors join or leave.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keyed = df.select("*", F.col("_metadata.file_path").alias("_f"),
                      F.col("_metadata.file_block_start").alias("_b"),
                      F.monotonically_increasing_id().alias("_m")).checkpoint(eager=True)
    splits = keyed.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    splits = splits.select(F.struct("_f", "_b").alias("_split"), "_n", "_first")
    offsets = running_offsets(splits, "_split", "_n", ["_first"])      # grows with the files: no forced broadcast
    out = keyed.withColumn("_split", F.struct("_f", "_b")).join(offsets, "_split")
    return (out.withColumn(name, F.col("_off") + (F.col("_m") - F.col("_first")))
            .drop("_f", "_b", "_m", "_split", "_first", "_off"))


def read_lines_indexed(spark: SparkSession, path: str, name: str = "line_no") -> DataFrame:
    """``(line_no, value)`` for every line of the text file(s) at ``path``."""
    return _indexed(spark.read.text(path), name).select(name, "value")


def read_csv_first_column(spark: SparkSession, path: str, name: str = "pos", col: str = "value") -> DataFrame:
    """``(pos, value)``: the first column of each CSV row, numbered in file order."""
    df = spark.read.option("header", False).csv(path)
    return _indexed(df.select(F.col("_c0").alias(col)), name).select(name, col)


def write_lines(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """Write the first column as text lines; with ``order_by`` the part files
    hold the rows in that order (a range-partitioned sort, not one task)."""
    first = df.columns[0]
    out = df.orderBy(order_by) if order_by else df
    out.select(first).write.mode("overwrite").text(path)


def write_manifest(ids: DataFrame, path: str, id_col: str, prefix: str, suffix: str = ".png", width: int | None = 5,
                   pos_col: str = "pos") -> None:
    """One URL a line, in the order of the id file (``pos_col``)."""
    write_lines(manifest(ids, id_col, prefix, suffix, width).select("url", pos_col), path, pos_col)


def read_int_lines(spark: SparkSession, path: str, name: str = "pos", col: str = "value") -> DataFrame:
    """``(pos, value long)``: one integer per line in file order; leading zeros
    drop (``00983`` -> 983); a line that is not a number gives null."""
    lines = read_lines_indexed(spark, path, name)
    return lines.select(name, F.trim("value").try_cast("long").alias(col))
