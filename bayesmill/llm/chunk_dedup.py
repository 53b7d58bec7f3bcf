"""Substring dedup by content-defined chunks: a gear rolling hash cuts texts, equal chunks are found by digest.

The gear hash of a position covers its last GEAR bytes. A text is cut after each position whose hash is the least
within RADIUS bytes to both sides (the first of equals), and at LONGEST bytes where no position qualifies. The rule
looks at no earlier cut, so an insertion moves only the cuts near to it, and a passage is cut alike wherever it stands.

A chunk (128-bit digest) that stands in two or more documents is shared; the document with the least doc_id keeps it.
With ``within``, a chunk that stands at two or more places of one document is shared too; its first place in the document
with the least doc_id keeps it, and all its other places count as removed.
Shared chunks that follow one another in a document are one span; spans of LEAST_SPAN bytes or more are the result.
Texts are read once; what is shuffled is one fixed-size row a chunk, summed before the shuffle, and chunks of very many
documents are kept apart in the join back.

Limit: text that repeats with a period of up to RADIUS bytes (one word over and over) has no cut but those of LONGEST, so
a passage of it alone is found only by chance.

Defined results: null and empty texts have no chunks, rows with a null doc_id share nothing, repeated rows (the same
doc_id) share nothing with each other, an empty table gives no rows, other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bayesmill.llm.common import join_counted, saved

GEAR = 16
RADIUS = 13
LONGEST = 1024
LEAST_SPAN = 96
SEGMENT = 1 << 20


def gear_table(seed: int = 0x9E3779B9) -> np.ndarray:
    """256 scattered 32-bit numbers by a multiply-and-shift rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(seed)) & np.uint64(0xFFFFFFFF)
    for m in (0x85EBCA6B, 0xC2B2AE35):
        x = ((x ^ (x >> np.uint64(15))) * np.uint64(m)) & np.uint64(0xFFFFFFFF)
    return (x ^ (x >> np.uint64(16))).astype(np.uint32)


def gear_hashes(b: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The gear hash of each position: the sum over its last GEAR bytes of table[byte] << distance, by doubling."""
    h, span = table[b], 1
    while span < GEAR:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h, span = longer, 2 * span
    return h


def _least_ahead(h: np.ndarray, n: int) -> np.ndarray:
    """min(h[i : i + n]) for each i; beyond the end everything is larger."""
    m, span = h, 1
    while span < n:
        step = min(span, n - span)
        nearer = m.copy()
        np.minimum(nearer[:-step], m[step:], out=nearer[:-step])
        m, span = nearer, span + step
    return m


def _local_cuts(h: np.ndarray) -> np.ndarray:
    """Positions whose hash is below all of the RADIUS before and not above any of the RADIUS after them."""
    top = np.full(RADIUS, 0xFFFFFFFF, np.uint32)
    padded = np.concatenate((top, h, top))
    least = _least_ahead(padded, RADIUS)
    before, after = least[:len(h)], least[RADIUS + 1:RADIUS + 1 + len(h)]
    return np.flatnonzero((h < before) & (h <= after) & (h != 0xFFFFFFFF))


def cuts(text: bytes, table: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, the last one being its length; long texts go through in overlapping segments."""
    b, margin, found = np.frombuffer(text, np.uint8), GEAR + RADIUS, []
    for s in range(0, len(b), SEGMENT):
        lo, hi = max(0, s - margin), min(len(b), s + SEGMENT + margin)
        at = _local_cuts(gear_hashes(b[lo:hi], table)) + lo
        found.append(at[(at >= s) & (at < s + SEGMENT)] + 1)
    ends = np.concatenate([*found, [len(b)]]) if len(b) else np.empty(0, np.int64)
    return _limited(np.unique(ends))


def _limited(ends: np.ndarray) -> np.ndarray:
    """Adds cuts every LONGEST bytes where ends lie further apart."""
    sizes = np.diff(ends, prepend=0)
    if not len(ends) or sizes.max() <= LONGEST:
        return ends
    more = [np.arange(e - n + LONGEST, e, LONGEST) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True) if n > LONGEST]
    return np.unique(np.concatenate([ends, *more]))


_CHUNKS = "hi long, lo long, doc_id long, start long, size int"


def _chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = gear_table()
    for b in batches:
        for part in range(0, b.num_rows, 500):
            rows = b.slice(part, 500)
            digests, owners, starts, sizes = [], [], [], []
            for i, t in zip(rows.column("doc_id").to_pylist(), rows.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if i is None or not t:
                    continue
                ends = cuts(t, table)
                first = np.concatenate(([0], ends[:-1]))
                digests += [xxhash.xxh3_128_digest(t[s:e]) for s, e in zip(first.tolist(), ends.tolist(), strict=True)]
                owners.append(np.full(len(ends), i, np.int64))
                starts.append(first)
                sizes.append(ends - first)
            if digests:
                names = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                cols = [pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(np.concatenate(owners)), pa.array(np.concatenate(starts).astype(np.int64)),
                        pa.array(np.concatenate(sizes).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["hi", "lo", "doc_id", "start", "size"])


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row a chunk: digest (``hi, lo``), ``doc_id``, ``start`` and ``size`` in UTF-8 bytes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_chunker, _CHUNKS)


def shared_spans(docs: DataFrame, least_span: int = LEAST_SPAN, within: bool = False) -> DataFrame:
    """``doc_id, start, end`` (bytes), ``n_chunks``, ``n_removed`` (chunks that an earlier document keeps, or with
    ``within`` an earlier place), ``keepers`` (sorted ids of the documents that keep the span's chunks)."""
    chunks = saved(chunk_table(docs), "chunks")
    key = F.struct("hi", "lo")
    groups = chunks.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"),
                                             F.min("start").alias("first_start"), F.max("start").alias("last_start"))
    # rows of one doc_id and start are one place, so repeated rows share nothing
    places = (F.col("keeper") < F.col("last")) | (F.lit(within) & (F.col("first_start") < F.col("last_start")))
    shared = saved(groups.where(places).select(key.alias("digest"), "n", "keeper"), "shared_chunks")
    held = join_counted(chunks.select(key.alias("digest"), "doc_id", "start", "size"), shared, "digest", "n").where(F.col("keeper").isNotNull())
    by_place = Window.partitionBy("doc_id").orderBy("start")
    # one shuffle: all that follows is by document
    once = held.select("doc_id", "start", (F.col("start") + F.col("size")).alias("end"), "keeper", "digest").repartition("doc_id").distinct()
    removed = F.col("keeper") < F.col("doc_id")
    if within:
        removed = removed | (F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy("start")) > 1)
    once = once.withColumn("removed", removed).drop("digest")
    opens = F.coalesce(F.lag("end").over(by_place) < F.col("start"), F.lit(True)).cast("long")
    runs = once.withColumn("opens", opens).withColumn("run", F.sum("opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_chunks"),
        F.sum(F.col("removed").cast("long")).alias("n_removed"), F.sort_array(F.collect_set("keeper")).alias("keepers"))
    return spans.where(F.col("end") - F.col("start") >= least_span).drop("run")
