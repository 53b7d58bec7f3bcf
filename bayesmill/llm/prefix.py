"""Candidate rows by prefix filtering: an exact way to part groups that are too large to be compared as they are.

Members of a scope (a group of documents that may be similar to each other) count each n-gram within the scope and rank
their own by that count, ties by hash. Two sets that reach the similarity share one of the first size - least overlap + 1
of their n-grams in this order, so only documents that meet on such an n-gram need be compared, and only if their sides
differ (documents of one side are linked already). Pages of one template meet nowhere: what is their own comes first.

An n-gram that more than ``most`` documents of a scope hold is cut in tiles: documents of its largest side are dealt into
tiles, the others into tiles of their own, and tiles meet unless both are of the largest side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayesmill.llm.common import saved
from bayesmill.llm.ngrams import WordHashes, parts, shingles

_GRAMS = "doc long, scope long, side long, size int, gram long"


def _grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in parts(batches, 500):
            sets = [shingles(t, hashes, n) for t in b.column("text").cast(pa.binary()).to_pylist()]
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets], np.int32)
            owner = pa.array(np.repeat(np.arange(len(sets)), sizes))
            cols = [b.column(c).take(owner) for c in ("doc", "scope", "side")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(sets).view(np.int64))], names=["doc", "scope", "side", "size", "gram"])

    return run


def prefix_rows(members: DataFrame, texts: DataFrame, percent: int, n: int, most: int) -> DataFrame:
    """``key, doc, side``: documents of one key whose sides differ are the candidates.

    ``members``: ``doc, scope, side``, one row a document; ``texts``: ``doc_id, text``.
    """
    held = saved(members.join(texts.hint("merge"), F.col("doc") == F.col("doc_id")).select("doc", "scope", "side", "text"), "prefix_texts")
    # n-grams are many times larger than what the texts' compressed files let Spark expect: these joins are shuffled
    grams = held.mapInArrow(_grams(n), _GRAMS)
    shared = grams.groupBy("scope", "gram").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > 1)
    ranked = grams.join(shared.hint("merge"), ["scope", "gram"]).groupBy("doc", "scope", "side", "size").agg(F.sort_array(F.collect_list(F.struct("docs", "gram"))).alias("told"))
    # n-grams of this document alone come first and meet nothing
    alone, prefix = F.col("size") - F.size("told"), F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    first = F.slice("told", F.lit(1), F.greatest(F.lit(0), prefix - alone).cast("int"))
    met = saved(ranked.select("doc", "scope", "side", F.explode(first).alias("g")).select("doc", "scope", "side", "g.gram"), "prefix_postings")
    sides = met.groupBy("scope", "gram", "side").agg(F.count(F.lit(1)).alias("docs"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("y"))
    lists = sides.groupBy("scope", "gram").agg(F.sum("docs").alias("docs"), F.max("docs").alias("major"), F.max_by("side", F.struct("docs", "side")).alias("major_side"),
                                               F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    # one n-gram for each set of documents that meet
    mixed = lists.where(F.col("major") < F.col("docs")).groupBy("scope", "x", "y").agg(F.min_by(F.struct("gram", "docs", "major", "major_side"), "gram").alias("g")).select("scope", "g.*")
    rows = met.join(mixed.hint("merge"), ["scope", "gram"])
    small = rows.where(F.col("docs") <= most).select(F.xxhash64("scope", "gram").alias("key"), "doc", "side")

    large = rows.where(F.col("docs") > most)
    tiles = {True: F.ceil(F.col("major") / most).cast("int"), False: F.ceil((F.col("docs") - F.col("major")) / most).cast("int")}
    is_major = F.col("side") == F.col("major_side")
    place = F.when(is_major, F.pmod(F.xxhash64("doc"), tiles[True])).otherwise(F.pmod(F.xxhash64("doc"), tiles[False]))
    upto = lambda c: F.sequence(F.lit(0), c - 1)
    others = F.transform(upto(tiles[False]), lambda i: F.struct(F.lit(False).alias("of_major"), i.alias("i")))
    theirs = F.transform(upto(tiles[True]), lambda i: F.struct(F.lit(True).alias("of_major"), i.alias("i")))
    own = F.struct(is_major.alias("of_major"), F.col("place").cast("int").alias("i"))
    put = large.withColumn("place", place).select("scope", "gram", "doc", "side", own.alias("own"), F.explode(F.when(is_major, others).otherwise(F.concat(others, theirs))).alias("other"))
    return small.unionByName(put.select(F.xxhash64("scope", "gram", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "doc", "side"))
