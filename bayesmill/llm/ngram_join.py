"""Jaccard self-join on word n-grams by blocked sparse products of the document by n-gram incidence.

Blocks come first. Two sets that reach the threshold differ in at most K = 30/185 of the larger size (0.85 as
threshold), so if the range of n-gram hashes is cut in more than K parts, the two agree wholly on some part. Each
document signs its parts (level by level of the number of parts, which follows its size); documents that share a
signature are chained, and chains make candidate blocks. No pair is missed, and a passage that thousands of documents
share hardly glues them, because whole parts have to agree, and a document leaves out its weakest parts (few n-grams, or
hot ones) as long as stronger ones must agree as well. Repeats inside a batch meet before the shuffle.

Then each block's incidence rows are multiplied: overlap counts accumulate over the posting lists, pairs below the
bound that their sizes give are dropped, and what remains are links. A block of more than TILE documents is first cut
in parts that share a few leaders, which joins a group of near copies with work in proportion to it; what is not linked
then meets on its rarest n-grams in the component alone (``prefix.py``), so pages of one template, which have own words,
meet nowhere. Copies with the same set are one class from the start. The result is each document's component, so a task
returns a spanning forest of its links.

Defined results: null and wordless texts have an empty set and link with nothing, a null doc_id stays alone (component
null), repeated rows link as copies, an empty table gives no rows, other columns are not returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayesmill.llm.common import forget, join_counted, saved
from bayesmill.llm.components import FOREST_NODES, Forest, components
from bayesmill.llm.ngrams import WordHashes, linked, mix, parts, shingles
from bayesmill.llm.prefix import prefix_rows

N = 4
PERCENT = 85
TILE = 256
SLACK = 1.2  # parts above the least number, so that weak parts are rarely needed
GROWTH = 1.6  # from one number of parts to the next
HOT_SHARE = 2000  # an n-gram is hot that more than one in HOT_SHARE documents of some batch have (and HOT_LEAST or more)
HOT_LEAST = 8
LEADERS = 16


class Signer:
    """Signatures of sets such that any two sets of at least ``percent`` similarity share one."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.parts, self.most = percent, [1], [0]

    def differ(self, size: int) -> int:
        """Most elements in which two similar sets can differ, the larger having ``size``."""
        return 2 * (100 - self.percent) * size // (100 + self.percent)

    def level(self, size: int) -> int:
        """The first number of parts that is large enough for sets of ``size``."""
        k = self.differ(size)
        while self.most[-1] < k:
            p = max(self.parts[-1] + 2, math.ceil(self.parts[-1] * GROWTH))
            self.parts.append(p)
            self.most.append(max(self.most[-1] + 1, int(p / SLACK) - 1))
        return next(j for j, most in enumerate(self.most) if most >= k)

    def sign(self, u: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """The signatures of the strongest parts, at each level that a partner could have.

        A part's strength is its number of n-grams that are not hot (``hot`` says which are), ties go by signature;
        so it follows from the part's content alone. Of P parts, P - K agree at least. Each set leaves out its
        P - K - 1 weakest: some agreeing part is then above the bounds of both sets, and both sign it.
        """
        out, spread, partner = [], mix(u + np.uint64(0x9E3779B97F4A7C15)), 100 * len(u) // self.percent
        differ = (100 - self.percent) * (len(u) + partner) // (100 + self.percent)
        for j in range(self.level(len(u)), self.level(partner) + 1):
            p, tag = self.parts[j], np.uint64(j + 1) << np.uint64(40)
            part = ((u >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            held = part[first]
            signs, strength = mix(mix(tag + np.arange(p, dtype=np.uint64)) + np.uint64(1)), np.zeros(p, np.uint64)
            signs[held] = mix(np.add.reduceat(spread, first) ^ mix(tag + held))
            strength[held] = np.minimum(np.add.reduceat((~hot).astype(np.int64), first), 255).astype(np.uint64)
            rank = (strength << np.uint64(56)) | (signs >> np.uint64(8))
            left_out = p - min(self.most[j], differ) - 1
            out.append(signs[rank >= np.partition(rank, left_out)[left_out]])
        return np.concatenate(out)


SIGNATURE, EDGE, SET = 0, 1, 2
_ROWS = "kind int, a long, b long, digest binary"


def _batch(kind: int, a, b, digest=None) -> pa.RecordBatch:
    n = len(a)
    cols = [pa.array(np.full(n, kind, np.int32)), a if isinstance(a, pa.Array) else pa.array(a, pa.int64()), pa.array(b, pa.int64()),
            pa.nulls(n, pa.binary()) if digest is None else pa.array(digest, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["kind", "a", "b", "digest"])


def _hot_finder(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in parts(batches):
            sets = [shingles(t, hashes, n) for t in b.column("text").cast(pa.binary()).to_pylist()]
            if not sets:
                continue
            grams, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= max(HOT_LEAST, len(sets) / HOT_SHARE)
            yield pa.RecordBatch.from_arrays([pa.array(grams[often].view(np.int64)), pa.array(counts[often].astype(np.int64)), pa.array(np.full(int(often.sum()), len(sets), np.int64))], names=["gram", "n", "docs"])

    return run


def hot_grams(texts: DataFrame, n: int = N) -> np.ndarray:
    """The n-grams that more than one in HOT_SHARE of all documents have, sorted.

    Such an n-gram is as frequent in some batch, so each batch tells those alone that reach the share and HOT_LEAST;
    their sums are least counts. The table chooses signatures, never results: one that is missed costs time alone. At most HOT_SHARE times a document's mean number of
    n-grams can qualify, at any size of the table.
    """
    told = texts.select("text").mapInArrow(_hot_finder(n), "gram long, n long, docs long")
    total = texts.count()
    sums = told.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") * HOT_SHARE > F.lit(total)).select("gram")
    return np.sort(np.array([r["gram"] for r in sums.toLocalIterator()], np.int64).view(np.uint64))


def _among(u: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.searchsorted(table, u)
    at[at == len(table)] = 0
    return table[at] == u if len(table) else np.zeros(len(u), bool)


def _signer(percent: int, n: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = WordHashes(), Signer(percent)
        for b in parts(batches):
            ids = b.column("doc_id").to_pylist()
            sizes, digests, edges, signs, owners, met = [], [], set(), [], [], {}
            for i, t in zip(ids, b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                u = shingles(t, hashes, n)
                sizes.append(len(u))
                digests.append(hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None)
                if i is None or not len(u):
                    continue
                first = met.setdefault(digests[-1], i)
                if first != i:
                    edges.add((i, first))
                    continue
                s = signer.sign(u, _among(u, hot))
                signs.append(s)
                owners.append(np.full(len(s), i, np.int64))
            yield _batch(SET, b.column("doc_id").cast(pa.int64()), sizes, digests)
            if signs:
                sign, owner = np.concatenate(signs), np.concatenate(owners)
                uniq, at, inverse = np.unique(sign, return_index=True, return_inverse=True)
                head = owner[at][inverse]
                edges.update(zip(owner[head != owner].tolist(), head[head != owner].tolist(), strict=True))
                yield _batch(SIGNATURE, uniq.view(np.int64), owner[at])
            if edges:
                yield _batch(EDGE, [e[0] for e in edges], [e[1] for e in edges])

    return run


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours in the order of signatures become edges; sets pass."""
    last_sign = last_owner = None
    forest = Forest()  # a task's edges leave as stars, so parallel edges of many signatures are told once
    for b in batches:
        if len(forest.root) >= FOREST_NODES:
            yield _batch(EDGE, *forest.stars())
        kind = b.column("kind").to_numpy()
        other = np.flatnonzero(kind == SET)
        if len(other):
            yield b.take(pa.array(other))
        told = b.filter(pa.array(kind == EDGE))
        for x, y in zip(told.column("a").to_pylist(), told.column("b").to_pylist(), strict=True):
            forest.join(x, y)
        mine = np.flatnonzero(kind == SIGNATURE)
        if not len(mine):
            continue
        sign, owner = (b.column(c).take(pa.array(mine)).to_numpy() for c in ("a", "b"))
        if last_sign is not None:
            sign, owner = np.concatenate(([last_sign], sign)), np.concatenate(([last_owner], owner))
        last_sign, last_owner = sign[-1], owner[-1]
        same = np.flatnonzero((sign[1:] == sign[:-1]) & (owner[1:] != owner[:-1]))
        if len(same):
            for x, y in zip(owner[same].tolist(), owner[same + 1].tolist(), strict=True):
                forest.join(x, y)
    yield _batch(EDGE, *forest.stars())


def _product(percent: int, n: int):
    def run(block: pa.Table) -> pa.Table:
        hashes = WordHashes()
        sets = [shingles(t, hashes, n) for t in block.column("text").cast(pa.binary()).to_pylist()]
        ids, side = block.column("doc_id").to_pylist(), block.column("side").to_numpy()
        forest = linked(sets, side, percent)
        return pa.table({"a": pa.array([ids[i] for i, _ in forest], pa.int64()), "b": pa.array([ids[j] for _, j in forest], pa.int64())})

    return run


def _with_members(candidates: DataFrame) -> DataFrame:
    many = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    return candidates.join(many, "component")


def small_blocks(sized: DataFrame, tile: int) -> DataFrame:
    """Components of at most ``tile`` documents, whole."""
    return sized.where(F.col("members") <= tile).select("doc_id", F.concat_ws(":", "component").alias("block"), F.lit(0).alias("side"))


def leader_blocks(large: DataFrame, tile: int) -> DataFrame:
    """Large components in blocks of about ``tile`` documents, each with the component's LEADERS added."""
    parts = F.ceil(F.col("members") / tile)
    put = large.withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    leads = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("members")) < LEADERS
    every = F.when(leads, F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("mine"))
    return put.select("doc_id", "component", F.explode(every).alias("part")).select(
        "doc_id", F.concat_ws(":", "component", F.lit("part"), "part").alias("block"), F.lit(0).alias("side"))


def rest_blocks(large: DataFrame, found: DataFrame, texts: DataFrame, percent: int, n: int, tile: int) -> DataFrame:
    """What leader blocks leave open: documents of a component that are not linked yet meet on their rarest n-grams in it."""
    named = large.join(found.withColumnRenamed("component", "group"), F.col("doc_id") == F.col("node"), "left")
    placed = named.select("doc_id", "component", F.coalesce("group", "doc_id").alias("side"))
    several = placed.groupBy("component").agg(F.min("side").alias("low"), F.max("side").alias("high")).where(F.col("low") < F.col("high")).select("component")
    members = placed.join(several, "component").select(F.col("doc_id").alias("doc"), F.col("component").alias("scope"), "side")
    rows = prefix_rows(saved(members, "ngram_open"), texts, percent, n, tile)
    return rows.select(F.col("doc").alias("doc_id"), F.concat_ws(":", F.lit("rest"), "key").alias("block"), F.lit(0).alias("side"))


def ngram_components(docs: DataFrame, percent: int = PERCENT, n: int = N, tile: int = TILE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the least doc_id reachable by links."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hot = hot_grams(texts, n)
    signed = texts.mapInArrow(_signer(percent, n, hot), _ROWS).repartition("a").sortWithinPartitions("kind", "a", "b")
    stream = saved(signed.mapInArrow(_chain, _ROWS), "ngram_stream")
    sets = stream.where(F.col("kind") == SET).select(F.col("a").alias("doc_id"), F.col("b").alias("size"), "digest")
    edges = stream.where(F.col("kind") == EDGE).select("a", "b")

    # copies: one class a set, its least doc_id stands for it; only classes go on
    classes = saved(sets.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.count(F.lit(1)).alias("copies")), "ngram_classes")
    member = saved(join_counted(sets, classes.drop("size"), "digest", "copies").select("doc_id", "size", "digest", "rep"), "ngram_members")
    same = member.where(F.col("rep").isNotNull() & (F.col("rep") != F.col("doc_id"))).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    near = components(edges.unionByName(same))

    # the products, on one document a class
    candidates = classes.select(F.col("rep").alias("doc_id"), "size").join(near, F.col("doc_id") == F.col("node")).select("doc_id", "size", "component")
    sized = saved(_with_members(candidates), "ngram_candidates")
    large = sized.where(F.col("members") > tile)
    # candidates grow with the input, so they are shuffled and not broadcast, at any size; all texts are shuffled once
    theirs = saved(texts.join(sized.select("doc_id").hint("merge"), "doc_id", "left_semi"), "ngram_texts")

    def links(put: DataFrame) -> DataFrame:
        return saved(theirs.join(saved(put, "ngram_blocks").hint("merge"), "doc_id").groupBy("block").applyInArrow(_product(percent, n), "a long, b long"), "ngram_links")

    held = links(small_blocks(sized, tile).unionByName(leader_blocks(large, tile)))
    if large.limit(1).count():
        held = held.unionByName(links(rest_blocks(large, components(held), theirs, percent, n, tile)))
    found = components(held.unionByName(same))
    named = saved(classes.join(found, F.col("rep") == F.col("node"), "left").select("digest", "copies", F.coalesce("component", "rep").alias("component_id")), "ngram_named")
    forget(classes, member, sized, theirs)  # all that is read from here on is in stream and named
    out = join_counted(sets, named, "digest", "copies")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its component (rows of one doc_id are one document)."""
    found = ngram_components(docs, percent, n)
    gone = saved(found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "ngram_gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
