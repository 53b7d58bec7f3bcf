"""Row identity and order: dense row index, positional zip, seeded batches,
putting predictions back in request order, URL manifests.

``with_row_index`` is a DataFrame form of ``zipWithIndex``: rows are range
partitioned and sorted on the order key and checkpointed, each partition's
size is counted (one small row per partition), offsets are running sums over
those few rows and are broadcast back. No window or sort ever runs over the
data in one task; the partition count is the session's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bayesmill.functions.draws import uniform
from bayesmill.session import ensure_checkpoint_dir


def running_offsets(sizes: DataFrame, key: str, count_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """``(key, *carry, _off)``: for a table with one row per unit (partition, file
    split), the number of rows in all units ordered before it.

    Prefix sums on two levels: the units are range-partitioned by key and
    checkpointed, each part sums up its own units, and one row per part (at most
    the number of shuffle partitions) gives what comes before the part.
    """
    ensure_checkpoint_dir(sizes.sparkSession)
    placed = sizes.repartitionByRange(key).withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.sum(count_col).alias("_rows"))
    starts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("_in", F.coalesce(F.sum(count_col).over(inside), F.lit(0)))
    out = out.join(F.broadcast(starts), "_part")                # one row per shuffle partition: bounded
    return out.select(key, *carry, (F.col("_start") + F.col("_in")).alias("_off"))


def with_row_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_index",
                   num_partitions: int | None = None) -> DataFrame:
    """Add a dense 0-based index following ``order_by`` (which should be unique).

    The range-partitioned, sorted and tagged rows are checkpointed (reliable,
    under ``spark.checkpoint.dir``) before they are counted: range boundaries
    come from sampling, so two computations of the same shuffle may place rows
    differently; counting and numbering the one materialised copy cannot disagree.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ranged = df.repartitionByRange(*([num_partitions] if num_partitions else []), *keys).sortWithinPartitions(*keys)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    ensure_checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = running_offsets(sizes, "_pid", "_n", ["_first"])   # one row per partition: bounded
    out = tagged.join(F.broadcast(offsets), "_pid")
    idx = F.col("_off") + (F.col("_mid") - F.col("_first"))
    return out.withColumn(name, idx).drop("_pid", "_mid", "_first", "_off")


def positional_zip(left: DataFrame, right: DataFrame, left_order: Sequence[str],
                   right_order: Sequence[str]) -> DataFrame:
    """Pair row i of ``left`` with row i of ``right``; the longer side is cut (inner join)."""
    li = with_row_index(left, left_order, "_pos")
    ri = with_row_index(right, right_order, "_pos")
    return li.join(ri, "_pos").withColumnRenamed("_pos", "pos")


def shuffle_batches(df: DataFrame, id_col: str, batch_size: int, n_crops: int = 1,
                    seed: int = 0, epoch: int = 1) -> DataFrame:
    """Seeded random permutation cut into mini-batches.

    Per-batch image count is ``floor(batch_size / n_crops)``; the last batch
    may be short. Adds ``perm_index`` and ``batch``.
    """
    b = batch_size // n_crops
    if b < 1:
        raise ValueError("batch_size must be >= n_crops")
    keyed = df.withColumn("_draw", uniform(seed, epoch, F.col(id_col), 0))
    idx = with_row_index(keyed, ["_draw", id_col], "perm_index")
    return idx.withColumn("batch", F.floor(F.col("perm_index") / b).cast("long")).drop("_draw")


ROUNDS = 6
WALKS = 64


def _mixed(seed, epoch, step: int, value: Column) -> Column:
    """32 bits of the draw of (seed, epoch, value, step)."""
    key = F.concat_ws(":", *[c if isinstance(c, Column) else F.lit(str(c)) for c in (seed, epoch)], value.cast("string"), F.lit(str(step)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def permuted(index: Column, n: int, seed, epoch) -> Column:
    """The place of ``index`` (0 to n - 1) in a keyed permutation of these numbers: a column of the row alone.

    Numbers are pairs (left, right) below (a, b) with a b just above n; rounds
    add a draw of one half to the other, which can be undone, so they permute the
    pairs. A place at n or above walks on through the permutation until it is
    below n (fewer than a pairs are above; a walk of more than WALKS steps is
    possible only by a chance of a^-WALKS, and raises an error).
    """
    if n < 2:
        return index
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)

    def rounds(x: Column) -> Column:
        left, right = F.floor(x / b).cast("long"), x % b
        for r in range(ROUNDS):
            if r % 2 == 0:
                left = (left + _mixed(seed, epoch, r, right)) % a
            else:
                right = (right + _mixed(seed, epoch, r, left)) % b
        return left * b + right

    walks = min(a * b - n, WALKS)
    place = rounds(index.cast("long"))
    if not walks:
        return place
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(walks)), place, lambda x, _: F.when(x >= n, rounds(x)).otherwise(x))
    return F.aggregate(F.array(walked), F.lit(0).cast("long"), lambda _, x: F.when(x < n, x).otherwise(F.raise_error(F.lit("permutation walked too far")).cast("long")))


def epoch_batches(indexed: DataFrame, n: int, batch_size: int, n_crops: int = 1, seed=0, epoch=1, index_col: str = "row_index") -> DataFrame:
    """Adds ``perm_index`` and ``batch`` of an epoch to rows with a dense index.

    The index is made once; each epoch's order is a column, so no epoch sorts,
    shuffles or checkpoints the rows. ``seed`` and ``epoch`` may be columns.
    """
    b = batch_size // n_crops
    if b < 1:
        raise ValueError("batch_size must be >= n_crops")
    placed = indexed.withColumn("perm_index", permuted(F.col(index_col), n, seed, epoch))
    return placed.withColumn("batch", F.floor(F.col("perm_index") / b).cast("long"))


def rows_at(indexed: DataFrame, wanted: DataFrame, index_col: str = "row_index") -> DataFrame:
    """The rows at the indexes of ``wanted (index_col)``; an index asked for twice gives its row twice, one beyond the rows none."""
    return indexed.join(wanted.select(index_col), index_col)


def reorder_predictions(pred: DataFrame, request: DataFrame, id_col: str = "id",
                        pred_col: str = "pred", pos_col: str = "pos") -> DataFrame:
    """Predictions in request order.

    ``pred(pos, id, pred)`` may hold an id several times: the later position
    wins. ``request(pos, id)`` gives the wanted order; every requested id must
    have a prediction (the job fails otherwise).
    """
    last = pred.groupBy(id_col).agg(F.max_by(pred_col, pos_col).alias(pred_col))
    j = request.select(pos_col, id_col).join(last, id_col, "left")
    # the check is part of the output value, so column pruning cannot drop it
    ok = F.assert_true(F.col(pred_col).isNotNull(), F.lit("requested id without a prediction"))
    checked = j.select(pos_col, id_col, F.when(ok.isNull(), F.col(pred_col)).alias(pred_col))
    return checked.orderBy(pos_col)


def manifest(ids: DataFrame, id_col: str, prefix: str, suffix: str = ".png",
             width: int | None = 5) -> DataFrame:
    """``prefix + id + suffix`` per id; ``width`` left-pads shorter ids with zeros (longer ids stay whole)."""
    c = F.col(id_col).cast("string")
    if width:
        c = F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)
    return ids.withColumn("url", F.concat(F.lit(prefix), c, F.lit(suffix)))
