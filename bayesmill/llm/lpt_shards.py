"""Sharding by longest processing time: groups of equal texts, the largest first, go to the least-loaded shard.

The heap works on a bounded list: a group with more than 1 / units of all bytes is an item of its own (at most
``units`` of these can exist), all smaller groups are first gathered by their digest's hash in ``units`` bundles, and
bundles are items like the others. So the driver sees at most 2 * units sums, at any input size, and no bundle can
tilt a shard by more than about 1 / units of the bytes. Documents get shard and slot by joins with bounded tables.

Defined results: a null text has no bytes and belongs with the empty texts; repeated rows each get a slot; an empty
table gives no rows; other columns of the input are not returned.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bayesmill.llm.common import saved

ROW_BYTES = 16  # fixed value: bytes of a row besides its text
UNITS_PER_SHARD = 512
SLOT_PIECES = 4096


def lpt(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Item -> shard: largest first (ties by name), each to the least-loaded shard (ties to the lowest number)."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, s = heap[0]
        out[name] = s
        heapq.heapreplace(heap, (load + size, s))
    return out


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text: str = "text",
                    units_per_shard: int = UNITS_PER_SHARD) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``; slots are gapless from 0 in each shard."""
    spark, units = docs.sparkSession, shards * units_per_shard
    t = F.coalesce(F.col(text), F.lit(""))
    base = saved(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"),
                             F.crc32(t.cast("binary")).alias("text_crc32"), F.md5(t.cast("binary")).alias("digest")), "shard_rows")
    groups = base.groupBy("digest").agg(F.sum("size").alias("bytes"))
    total = base.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    big = groups.where(F.col("bytes") * units > F.lit(total["b"] or 0)).select("digest", F.lit(True).alias("big"))
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("digest"), F.lit(units)).cast("string"))
    named = base.join(F.broadcast(big), "digest", "left").withColumn("unit", F.when(F.col("big"), F.col("digest")).otherwise(bundle)).drop("big", "digest")
    sums = named.groupBy("unit").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()  # 2 * units at most
    place = lpt([(r["unit"], r["bytes"]) for r in sums], shards)
    # a unit's rows are numbered in pieces of at most about 1 / SLOT_PIECES of all rows
    table = [(r["unit"], place[r["unit"]], -(-r["rows"] * SLOT_PIECES // max(1, total["n"]))) for r in sums]
    places = F.broadcast(spark.createDataFrame(table, "unit string, shard int, pieces int"))
    rows = saved(named.join(places, "unit").withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).drop("pieces"), "shard_places")
    counts = rows.groupBy("shard", "unit", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("unit", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("unit", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    number = Window.partitionBy("unit", "piece").orderBy("doc_id", "text_crc32")
    slots = rows.withColumn("number", F.row_number().over(number) - 1).join(starts, ["unit", "piece"])
    return slots.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("number")).cast("long").alias("slot"))
