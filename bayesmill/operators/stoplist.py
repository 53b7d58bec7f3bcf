"""Stop words as a table: lists too long for a literal in the plan.

Rows are dealt over blocks of about BLOCK_WORDS words by id. The distinct words
of each block meet the list, what is on it comes back to the block, and the
words of its rows are looked up there: no row a word occurrence is shuffled,
and no task holds the list. A block is one group, so its rows must fit a task.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from bayesmill.session import scratch_path

BLOCK_WORDS = 1 << 20

# The code travels with its tasks: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _left_over(rows: pa.Table, hits: pa.Table) -> pa.Table:
    """``(id, words)`` of a block without its listed words; rows of one id get the words of all of them, by position."""
    ids, words = (rows.column(k).combine_chunks() for k in (0, 1))
    words = words.cast(pa.list_(pa.string()))
    flat, row = words.flatten(), pc.list_parent_indices(words).to_numpy()
    kept = pc.invert(pc.is_in(flat, value_set=hits.column("_word").combine_chunks().cast(pa.string())))
    at = np.flatnonzero(kept.to_numpy(zero_copy_only=False))
    group = ids.dictionary_encode().indices.to_numpy()
    n = int(group.max()) + 1
    if n < len(ids):
        first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ids)))])
        order = pa.table({"group": group[row[at]], "pos": at - first[row[at]], "word": flat.take(pa.array(at))})
        at = at[pc.sort_indices(order, sort_keys=[(k, "ascending") for k in order.column_names], null_placement="at_start").to_numpy()]
    ends = np.cumsum(np.bincount(group[row[at]], minlength=n))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), flat.take(pa.array(at)))
    return pa.table([ids, lists.take(pa.array(group))], names=rows.column_names[:2])


def without_listed(df: DataFrame, listed: DataFrame, id_col: str = "doc_id", col: str = "tokens", word_col: str = "word") -> DataFrame:
    """``(id, tokens)`` without the words of ``listed``; ids must be unique (rows of one id get the words of all of them, those
    of a null id none), a row keeps an empty array if nothing is left."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "words")
    told = df.select(F.col(id_col), F.col(col))
    told.write.parquet(path)
    saved = spark.read.schema(told.schema).parquet(path)
    known = saved.where(F.col(id_col).isNotNull())
    words = known.agg(F.sum(F.size(col).cast("long"))).first()[0] or 0
    blocks = max(1, -(-words // BLOCK_WORDS))
    rows = known.withColumn("_block", F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int")).repartitionById(blocks, "_block")
    present = rows.select("_block", F.explode_outer(col).alias("_word")).where(F.col("_word").isNotNull()).distinct()
    hits = present.join(listed.select(F.col(word_col).alias("_word")), "_word", "left_semi").select("_word", F.col("_block").alias("_of"))
    schema = StructType([told.schema[id_col], StructField(col, ArrayType(StringType()))])
    kept = rows.groupBy("_block").cogroup(hits.groupBy("_of")).applyInArrow(_left_over, schema)
    none = F.array().cast("array<string>")
    return kept.unionByName(saved.where(F.col(id_col).isNull()).select(id_col, none.alias(col)))
