"""MinHash near-duplicates with sequential Bayesian verification, exactly confirmed.

A set of word n-grams is signed by BANDS x ROWS minimum hashes; documents that agree on a whole band are candidates. Two
sets at the least similarity miss each other in all bands with probability (1 - 0.8^5)^40 = 1.2e-7. Signatures of
candidates are compared batch by batch: after n hashes with m matches, the similarity has the posterior beta(m + 1,
n - m + 1) (uniform prior), and a pair is pruned once it reaches the threshold with a probability below MISS. What is
left after all batches is confirmed on the full sets, so every link is exact.

Large groups never become all their pairs. First each document is compared with one head alone, the least document of
most of its buckets; links found so make components. Then only buckets that still hold several components are open, once
for each set of members: up to MOST members compare their signatures inside the bucket, where documents of different
components meet; members of larger open buckets meet on rare n-grams instead, by prefix filtering, which is exact.
In the first BEST_ROUNDS rounds (in tiles of large buckets) each component tries its most similar partner alone, which
joins a dense group in a few rounds of as many pairs as there are components; the last round tries all pairs that are
still open.
Only surviving pairs leave a task, and texts meet them in blocks: a block joins two tiles of documents (a tile: those of
one head, dealt out by MOST), so that a dense group brings its texts once a tile and not once a pair. Copies with the
same set are one class from the start.

Defined results: null and wordless texts have an empty set and link with nothing; a null doc_id stays alone (component
null, kept); rows that share a doc_id are one node of the links; repeated rows link as copies; an empty table gives no
rows; other columns are not returned.
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
from bayesmill.llm.components import components
from bayesmill.llm.ngrams import WordHashes, linked, mix, parts, runs, shingles
from bayesmill.llm.prefix import prefix_rows

N = 4
PERCENT = 80
BANDS, ROWS = 40, 5
BATCH = 40  # hashes compared between two tests
MISS = 1e-5
MOST = 256
BEST_ROUNDS = 2
_DRAW = np.random.Generator(np.random.PCG64(13))
FACTORS, SHIFTS = (_DRAW.integers(0, 1 << 32, BANDS * ROWS, np.uint32) for _ in range(2))


def signature(u: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima of linear bijections of the hashed set, spread and cut to 16 bits."""
    x, low = (u >> np.uint64(32)).astype(np.uint32), np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(low, (x[at:at + 2048, None] * (FACTORS | np.uint32(1)) + SHIFTS).min(axis=0), out=low)
    return (mix(low.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def least_matches(percent: int, miss: float, hashes: int = BANDS * ROWS, batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes, matches) after each batch: with fewer matches, P(similarity >= percent) is below ``miss``.

    The tail of beta(m + 1, n - m + 1) from t on is the chance of at most m successes in n + 1 draws at t.
    """
    t, out = percent / 100, []
    for n in [*range(batch, hashes, batch), hashes]:
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def survivors(signs: np.ndarray, sizes: np.ndarray, side: np.ndarray, percent: int, tests: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows on different sides that no test prunes, and how many hashes agree."""
    order = np.argsort(side, kind="stable")
    above = np.searchsorted(side[order], side, side="right")  # each row meets those of larger sides
    i, at = np.repeat(np.arange(len(side)), len(side) - above), np.repeat(above, len(side) - above)
    j = order[at + np.arange(len(i)) - np.repeat(np.cumsum(len(side) - above) - (len(side) - above), len(side) - above)]
    near = 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
    i, j = i[near], j[near]
    matches, done = np.zeros(len(i), np.int64), 0
    for n, least in tests:
        matches += (signs[i, done:n] == signs[j, done:n]).sum(axis=1)
        alive = matches >= least
        i, j, matches, done = i[alive], j[alive], matches[alive], n
    return i, j, matches


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in parts(batches):
            sizes, digests, signs = [], [], []
            for t in b.column("text").cast(pa.binary()).to_pylist():
                u = shingles(t, hashes, n)
                sizes.append(len(u))
                digests.append(hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None)
                signs.append(signature(u).tobytes() if len(u) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "size", "digest", "signs"])

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts(batches, 5000):
        signs = np.frombuffer(b"".join(b.column("signs").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
        keys = mix(np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), signs.shape[:2]))
        for r in range(ROWS):
            keys = mix(keys + signs[:, :, r])
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), b.column("doc").take(pa.array(np.repeat(np.arange(len(signs)), BANDS)))], names=["key", "doc"])


def buckets(classes: DataFrame) -> DataFrame:
    """``key, doc, head, members`` of the bands that two classes or more share; the head is the least member."""
    bands = classes.select("doc", "signs").mapInArrow(_bands, "key long, doc long")
    heads = bands.groupBy("key").agg(F.min("doc").alias("head"), F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    return bands.join(heads, "key")


PAIRS_AT_ONCE = 20_000


def met_before(key: int, keys: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair of rows shares a key below ``key``; ``keys``: those of each row."""
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    flat = np.concatenate(keys)
    owner, flat = owner[flat < key], flat[flat < key]
    named, place, n = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(n > 1)
    column = np.full(len(named), -1)
    column[shared] = np.arange(len(shared))
    place = column[place]
    held = np.zeros((len(keys), len(shared)), bool)
    held[owner[place >= 0], place[place >= 0]] = True
    bits, out = np.packbits(held, axis=1), np.zeros(len(i), bool)
    for at in range(0, len(i), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        out[part] = (bits[i[part]] & bits[j[part]]).any(axis=1)
    return out


def _members(docs: np.ndarray, tile: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``key, doc, side`` of the blocks that hold the pairs: a key for each two tiles, the greater one being side 1."""
    low, high = np.minimum(tile[i], tile[j]), np.maximum(tile[i], tile[j])
    blocks, first, block = np.unique(mix(low.view(np.uint64) + mix(high.view(np.uint64))), return_index=True, return_inverse=True)
    held = np.unique(np.concatenate([block * len(docs) + i, block * len(docs) + j]))
    block, row = np.divmod(held, len(docs))
    return blocks.view(np.int64)[block], docs[row], (tile[row] != low[first][block]).astype(np.int64)


def _screen(percent: int, miss: float, best: bool):
    tests = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "key"):
            docs, side, sizes, tile = (rows.column(c).to_numpy() for c in ("doc", "side", "size", "tile"))
            if side.min() == side.max():
                continue
            signs = np.frombuffer(b"".join(rows.column("signs").to_pylist()), np.uint16).reshape(len(docs), -1)
            i, j, matches = survivors(signs, sizes, side, percent, tests)
            if len(i):  # a pair is told where it meets first
                keys = [k.values.to_numpy() for k in rows.column("keys").combine_chunks()]
                first = ~met_before(int(rows.column("key")[0].as_py()), keys, i, j) & (docs[i] != docs[j])
                i, j, matches = i[first], j[first], matches[first]
            if not len(i):
                continue
            if best:  # of each side the pair with the most matches
                i, j, matches, of = np.tile(i, 2), np.tile(j, 2), np.tile(matches, 2), np.concatenate([side[i], side[j]])
                order = np.lexsort((docs[j], docs[i], -matches, of))
                top = order[np.concatenate(([True], of[order][1:] != of[order][:-1]))]
                i, j = i[top], j[top]
                cols = {"side": of[top], "matches": matches[top], "a": docs[i], "tile_a": tile[i], "b": docs[j], "tile_b": tile[j]}
            else:
                cols = dict(zip(("key", "doc", "side"), _members(docs, tile, i, j), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols.values()], names=list(cols))

    return run


def screened(rows: DataFrame, classes: DataFrame, tiles: DataFrame, percent: int, miss: float, best: bool = False) -> DataFrame:
    """Blocks ``key, doc, side`` that hold the pairs of ``rows (key, doc, side)``, of one key and different sides, that
    survive all tests; with ``best`` only the pair of most matches for each side."""
    listed = rows.groupBy("doc", "side").agg(F.collect_set("key").alias("keys"))  # as many as bands, or n-grams of the document
    signed = listed.join(tiles, "doc").join(classes.select("doc", "size", "signs"), "doc").select("doc", "side", "tile", "size", "signs", "keys", F.explode("keys").alias("key"))
    met = signed.repartition("key").sortWithinPartitions("key")
    if not best:
        return met.mapInArrow(_screen(percent, miss, False), "key long, doc long, side long").distinct()
    pairs = met.mapInArrow(_screen(percent, miss, True), "side long, matches long, a long, tile_a long, b long, tile_b long")
    top = F.max_by(F.struct("a", "tile_a", "b", "tile_b"), F.struct("matches", -F.least("a", "b"), -F.greatest("a", "b")))
    low, high = F.least("tile_a", "tile_b"), F.greatest("tile_a", "tile_b")
    member = lambda c: F.struct(F.col(c).alias("doc"), (F.col(f"tile_{c}") != low).cast("long").alias("side"))
    each = pairs.groupBy("side").agg(top.alias("p")).select("p.*").select(F.xxhash64(low, high).alias("key"), F.explode(F.array(member("a"), member("b"))).alias("m"))
    return each.select("key", "m.doc", "m.side").distinct()


def _confirm(percent: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows in runs(batches, "key"):
            docs = rows.column("doc").to_numpy()
            sets = [shingles(t, hashes, n) for t in rows.column("text").cast(pa.binary()).combine_chunks().to_pylist()]
            forest = linked(sets, rows.column("side").to_numpy(), percent)
            if forest:
                i, j = (docs[list(x)] for x in zip(*forest, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j)], names=["a", "b"])

    return run


def confirmed(rows: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """Links inside the blocks of ``rows (key, doc, side)``, across their sides if they have two, as spanning forests."""
    met = rows.join(texts.hint("merge"), F.col("doc") == F.col("doc_id")).select("key", "doc", "side", "text")
    return saved(met.repartition("key").sortWithinPartitions("key").mapInArrow(_confirm(percent, n), "a long, b long"), "minhash_links")


def _labelled(rows: DataFrame, links: DataFrame, *kept: str) -> DataFrame:
    """``key, doc, side`` of ``rows (key, doc)``: the side is the document's component."""
    return rows.join(components(links), F.col("doc") == F.col("node"), "left").select("key", "doc", *kept, F.coalesce("component", "doc").alias("side"))


def _open(rows: DataFrame) -> DataFrame:
    """The buckets of ``rows (key, doc, side)`` with several sides, one for each set of members."""
    told = rows.groupBy("key").agg(F.min("side").alias("low"), F.max("side").alias("high"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("y"))
    return told.where(F.col("low") != F.col("high")).groupBy("x", "y").agg(F.min("key").alias("key")).select("key")


def _of_one_id(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of one doc_id, if rows share it."""
    known = sets.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "digest")
    several = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where(F.col("low") != F.col("high")).select("doc_id")
    own = saved(known.join(several, "doc_id").distinct().join(classes.select("digest", "doc"), "digest").select("doc_id", "doc"), "minhash_repeated")
    return own.groupBy("doc_id").agg(F.min("doc").alias("a")).join(own, "doc_id").select("a", F.col("doc").alias("b"))


def minhash_components(docs: DataFrame, percent: int = PERCENT, n: int = N, miss: float = MISS, most: int = MOST) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row: component_id is the least doc_id reachable by links."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, size int, digest binary, signs binary"
    sets = saved(texts.mapInArrow(_sets(n), kind), "minhash_sets")
    classes = saved(sets.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("doc"), F.first("size").alias("size"), F.first("signs").alias("signs"), F.count(F.lit(1)).alias("copies")), "minhash_classes")
    links = _of_one_id(sets, classes)
    held = saved(buckets(classes), "minhash_buckets")
    theirs = saved(texts.join(held.select(F.col("doc").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi"), "minhash_texts")

    # each document's head: the least document of most of its buckets
    shared = held.where(F.col("doc") != F.col("head")).groupBy("doc", "head").agg(F.count(F.lit(1)).alias("bands"))
    headed = saved(shared.groupBy("doc").agg(F.max_by("head", F.struct("bands", -F.col("head"))).alias("head")), "minhash_heads")
    counts = saved(headed.groupBy("head").agg(F.count(F.lit(1)).alias("docs")).withColumn("tiles", F.ceil(F.col("docs") / most)), "minhash_counts")
    dealt = join_counted(headed, counts, "head", "docs")
    stars = saved(dealt.select("doc", "head", F.xxhash64("head", F.pmod(F.xxhash64("doc"), F.col("tiles"))).alias("tile")), "minhash_stars")
    alone = held.select("doc").distinct().join(stars, "doc", "left_anti").select("doc", F.xxhash64("doc").alias("tile"))
    tiles = saved(stars.select("doc", "tile").unionByName(alone), "minhash_tiles")
    rows = stars.select(F.col("tile").alias("key"), "doc", F.lit(1).cast("long").alias("side"))
    rows = rows.unionByName(stars.select(F.col("tile").alias("key"), F.col("head").alias("doc"), F.lit(0).cast("long").alias("side")).distinct())
    links = links.unionByName(confirmed(screened(rows, classes, tiles, percent, miss), theirs, percent, n))

    # members of open buckets that are in different components meet, in tiles of buckets at first
    tiled = held.select(F.xxhash64("key", F.pmod(F.xxhash64("doc"), F.ceil(F.col("members") / most))).alias("key"), "doc")
    for _ in range(BEST_ROUNDS):
        labelled = saved(_labelled(tiled, links), "minhash_labelled")
        opened = labelled.join(_open(labelled), "key")
        links = links.unionByName(confirmed(screened(opened, classes, tiles, percent, miss, best=True), theirs, percent, n))
        forget(labelled)

    # what is open now is tried in full; members of buckets of more than ``most`` meet on rare n-grams
    labelled = saved(_labelled(held, links, "members"), "minhash_labelled")
    opened = saved(labelled.join(_open(labelled), "key"), "minhash_open")
    rows = opened.where(F.col("members") <= most).select("key", "doc", "side")
    wide = opened.where(F.col("members") > most).select("doc", F.lit(0).cast("long").alias("scope"), "side").distinct()
    if wide.limit(1).count():
        rows = rows.unionByName(prefix_rows(saved(wide, "minhash_wide"), theirs, percent, n, most).select("key", "doc", "side"))
    links = links.unionByName(confirmed(screened(rows, classes, tiles, percent, miss), theirs, percent, n))

    found = components(links)
    named = saved(classes.join(found, F.col("doc") == F.col("node"), "left").select("digest", "copies", F.coalesce("component", "doc").alias("component_id")), "minhash_named")
    forget(classes, held, theirs, headed, counts, stars, tiles)  # all that is read from here on is in sets and named
    out = join_counted(sets.drop("signs"), named, "digest", "copies").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
