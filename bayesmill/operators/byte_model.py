"""Classifiers on byte n-gram TF-IDF vectors, held as tables and never as driver vectors.

Features are grams of 1, 2 and 3 codes with tf * idf, idf = ln((N + 1) / (df + 1)) over all training files, as far as a
training file has them. Files come in blocks: a block row holds some files' gram counts and its own list of grams, so a
pass over the data meets the weights once a block and gram, not once a file and gram.

* ``fit_logistic``: multinomial logistic regression with an L2 penalty on weights of features scaled to unit variance
  (the objective of Spark ML's estimator), by L-BFGS. Weights, gradient and the pairs of the last steps are a table
  keyed by gram; a pass joins the weights to the blocks, and partial gradients add up by gram. The driver holds the
  inner products of these vectors (a matrix of a few numbers), never a vector.
* ``fit_tree``: a decision tree by Gini gain. A pass sends the tree so far (at most 2^depth tests) to the blocks, and
  counts of (node, gram, bin, class) add up; bins are powers of two of a gram's count, 0 for a file without it. The best
  split of each node comes from running sums over the bins. Ties: the smaller gram, then the smaller bin.

Both fits may use a bounded sample of the training files (``most_files``, the least hashes of the file ids; None: all),
while document frequencies cover all of them and predictions all files asked for. Ties of classes: the smaller label.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayesmill.functions.codes import codes, count_grams
from bayesmill.operators.tfidf import idf
from bayesmill.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAMS = (1, 2, 3)
BIAS = ""              # the constant feature; no gram is empty
BLOCK_COUNTS = 300_000   # distinct (file, gram) pairs of a block, if it has more than one file
MOST_FILES = 2000
PENALTY = 0.01
STEPS, HISTORY, TOLERANCE = 25, 8, 1e-3


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- blocks

_BLOCK = "block string, files array<string>, labels array<string>, ends array<int>, places array<int>, counts array<int>, grams array<string>"


def _block_of(name: str, files: list[str], labels: list[str], parts: list[np.ndarray]) -> pa.RecordBatch:
    owner, place, count, grams, first = [], [], [], [], 0
    for k in GRAMS:
        for g in count_grams(parts, k):
            keys, at = np.unique(g.key, return_inverse=True)
            owner.append(g.owner)
            place.append(at + first)
            count.append(g.n)
            grams.extend(g.names(keys).to_pylist())
            first += len(keys)
    flat = [np.concatenate([*x, np.empty(0, np.int64)]) for x in (owner, place, count)]
    order = np.argsort(flat[0], kind="stable")
    ends = np.cumsum(np.bincount(flat[0], minlength=len(files)))
    cols = [[name], [files], [labels], [ends.astype(np.int32)], [flat[1][order].astype(np.int32)], [flat[2][order].astype(np.int32)], [grams]]
    kinds = (pa.string(), *(pa.list_(t) for t in (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["block", "files", "labels", "ends", "places", "counts", "grams"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files, labels, parts, held = [], [], [], 0

    def told() -> pa.RecordBatch:
        return _block_of(files[0], list(files), list(labels), list(parts))

    for b in batches:
        for name, label, text in zip(*(b.column(c).to_pylist() for c in ("file_id", "label", "content")), strict=True):
            files.append(name)
            labels.append(label)
            parts.append(codes(text or ""))
            held += len(GRAMS) * len(parts[-1])
            if held >= BLOCK_COUNTS:
                yield told()
                files, labels, parts, held = [], [], [], 0
    if files:
        yield told()


def blocks(files: DataFrame) -> DataFrame:
    """Saved blocks of ``files (file_id, label, content)``; a block is named after its first file (ids are unique)."""
    return _saved(files.select("file_id", "label", "content").mapInArrow(_blocks, _BLOCK), "byte_blocks")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files that hold each gram, summed up over some files at a time."""
    for b in batches:
        parts, held = [], 0
        for i, text in enumerate(b.column("content").to_pylist(), 1):
            parts.append(codes(text or ""))
            held += len(parts[-1])
            if held >= 1 << 20 or i == b.num_rows:
                for k in GRAMS:
                    for g in count_grams(parts, k):
                        keys, n = np.unique(g.key, return_counts=True)
                        yield pa.RecordBatch.from_arrays([g.names(keys), pa.array(n, pa.int64())], names=["term", "n"])
                parts, held = [], 0


def gram_idf(files: DataFrame) -> DataFrame:
    """``(gram, idf)`` of the grams of all ``files``, saved."""
    df = files.select("content").mapInArrow(_frequencies, "term string, n long").groupBy("term").agg(F.sum("n").alias("df"))
    return _saved(idf(df, files.select(F.count(F.lit(1))).scalar()).select(F.col("term").alias("gram"), "idf"), "byte_idf")


def sample(files: DataFrame, most_files: int | None) -> DataFrame:
    if most_files is None:
        return files
    chosen = files.select("file_id").orderBy(F.xxhash64("file_id"), "file_id").limit(most_files)
    return files.join(F.broadcast(chosen), "file_id", "left_semi")  # at most most_files ids


@dataclass
class Block:
    """One block row in arrays."""

    files: list[str]
    labels: list[str]
    owner: np.ndarray
    places: np.ndarray
    counts: np.ndarray
    grams: list[str]

    @staticmethod
    def of(row: dict) -> Block:
        ends = np.array(row["ends"], np.int64)
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        return Block(row["files"], row["labels"], owner, np.array(row["places"], np.int64), np.array(row["counts"], np.int64), row["grams"])


# ---------------------------------------------------------------- logistic regression

def _placed(held: DataFrame, weights: DataFrame) -> DataFrame:
    """``of, place, *weights``: the grams of each block (and its constant) with their row of ``weights (gram, ...)``."""
    listed = held.select(F.col("block").alias("of"), F.posexplode(F.concat("grams", F.array(F.lit(BIAS)))).alias("place", "gram"))
    return listed.join(weights, "gram")


def _dense(block: Block, weights: pa.Table, column: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of the block's matrix whose gram has a row in ``weights`` (the constant included): file, place, value;
    ``weights`` has ``place, scale`` and ``column``."""
    n = len(block.grams) + 1
    scale = np.zeros(n)
    place = weights.column("place").to_numpy()
    scale[place] = weights.column("scale").to_numpy()
    vectors = np.zeros((n, width))
    if len(place):
        vectors[place] = np.array(weights.column(column).to_pylist(), float).reshape(len(place), width)
    files = np.arange(len(block.files))
    owner, places = np.concatenate([block.owner, files]), np.concatenate([block.places, np.full(len(files), n - 1)])
    values = np.concatenate([block.counts, np.ones(len(files))]) * scale[places]
    return owner, places, values, vectors


def _sums(owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``rows`` by owner."""
    return np.stack([np.bincount(owner, rows[:, k], n) for k in range(rows.shape[1])], axis=1)


def _pass(classes: list[str]):
    """Loss and gradient of one block: rows by gram, and one row without gram for the loss."""
    def run(held: pa.Table, weights: pa.Table) -> pa.Table:
        out_gram, out_g = [], []
        for row in held.to_pylist():
            block = Block.of(row)
            owner, places, values, w = _dense(block, weights, "w", len(classes))
            margin = _sums(owner, values[:, None] * w[places], len(block.files))
            top = margin.max(axis=1)
            log_sum = top + np.log(np.exp(margin - top[:, None]).sum(axis=1))
            right = np.array([classes.index(x) for x in block.labels])
            files = np.arange(len(right))
            rest = np.exp(margin - log_sum[:, None])
            rest[files, right] -= 1
            g = _sums(places, values[:, None] * rest[owner], len(block.grams) + 1)
            names = [*block.grams, BIAS]
            known = weights.column("place").to_pylist()
            out_gram += [None, *(names[p] for p in known)]
            loss = float((log_sum - margin[files, right]).sum())
            out_g += [[loss] + [0.0] * (len(classes) - 1), *g[known].tolist()]
        return pa.table({"gram": pa.array(out_gram, pa.string()), "g": pa.array(out_g, pa.list_(pa.float64()))})

    return run


@dataclass
class Logistic:
    """``weights``: saved ``(gram, scale, w)``; a margin is the sum of count * scale * w."""

    classes: list[str]
    weights: DataFrame
    losses: list[float] = field(default_factory=list)


def _scales(held: DataFrame, idfs: DataFrame, n: int) -> DataFrame:
    """``(gram, scale, free)``: tf * idf over its deviation in the training files; the constant is free of penalty."""
    entry = F.explode(F.arrays_zip("places", "counts")).alias("e")
    sums = held.select("grams", entry).select(F.get("grams", F.col("e.places")).alias("gram"), F.col("e.counts").cast("double").alias("c"))
    sums = sums.groupBy("gram").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    x = sums.join(idfs, "gram").withColumn("variance", (F.col("q") - F.col("s") * F.col("s") / n) / max(1, n - 1))
    rows = x.where((F.col("idf") > 0) & (F.col("variance") > 1e-12)).select("gram", (1 / F.sqrt("variance")).alias("scale"), F.lit(False).alias("free"))
    one = held.sparkSession.range(1).select(F.lit(BIAS).alias("gram"), F.lit(1.0).alias("scale"), F.lit(True).alias("free"))
    return _saved(rows.unionByName(one), "byte_scales")


def _products(width: int):
    """Inner products of a state's vectors, over all rows (part 0) and over the penalised ones (part 1), summed up by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = np.array(b.column("vectors").to_pylist(), float).reshape(b.num_rows, -1, width)
            bound = ~np.array(b.column("free").to_pylist(), bool)
            cells = []
            for part, rows in enumerate((v, v[bound])):
                dots = np.einsum("nik,njk->ij", rows, rows)
                cells += [(part, i, j, float(dots[i, j])) for i in range(len(dots)) for j in range(len(dots))]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells, strict=True), kinds, strict=True)], names=["part", "i", "j", "dot"])

    return run


def _direction(dots: np.ndarray, pairs: int) -> np.ndarray:
    """L-BFGS from inner products alone: the coefficients of [w, g, s1, y1, s2, y2, ...] (oldest pair first) in the direction."""
    q = np.zeros(len(dots))
    q[1] = 1.0
    alphas = []
    for k in reversed(range(pairs)):
        s, y = 2 + 2 * k, 3 + 2 * k
        alpha = q @ dots[:, s] / dots[s, y]
        q[y] -= alpha
        alphas.append(alpha)
    if pairs:
        s, y = 2 * pairs, 2 * pairs + 1
        q *= dots[s, y] / dots[y, y]
    for k, alpha in zip(range(pairs), reversed(alphas), strict=True):
        s, y = 2 + 2 * k, 3 + 2 * k
        q[s] += alpha - q @ dots[:, y] / dots[s, y]
    return -q


def _moved(step: np.ndarray, width: int):
    """Trial weights w + the combination ``step`` of the state's vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = np.array(b.column("vectors").to_pylist(), float).reshape(b.num_rows, -1, width)
            w = v[:, 0] + np.einsum("i,nik->nk", step, v)
            yield pa.RecordBatch.from_arrays([b.column("gram"), b.column("scale"), b.column("free"), pa.array(w.tolist(), pa.list_(pa.float64()))], names=["gram", "scale", "free", "w"])

    return run


def _next_state(width: int, pairs: int, n: int, penalty: float):
    """[w, g, pairs...] from the old vectors and the new weights with their summed gradient; a pair more if there was one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            w = np.array(b.column("w").to_pylist(), float).reshape(b.num_rows, width)
            g = np.array(b.column("g").to_pylist(), float).reshape(b.num_rows, width) / n
            bound = ~np.array(b.column("free").to_pylist(), bool)
            g += penalty * w * bound[:, None]
            old = b.column("vectors")
            if old.null_count == b.num_rows:
                v = np.stack([w, g], axis=1)
            else:
                o = np.array(old.to_pylist(), float).reshape(b.num_rows, -1, width)
                kept = o[:, 2:] if pairs < HISTORY else o[:, 4:]
                v = np.concatenate([np.stack([w, g], axis=1), kept, np.stack([w - o[:, 0], g - o[:, 1]], axis=1)], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("gram"), b.column("scale"), b.column("free"), pa.array(v.reshape(b.num_rows, -1).tolist(), pa.list_(pa.float64()))], names=["gram", "scale", "free", "vectors"])

    return run


def fit_logistic(held: DataFrame, idfs: DataFrame, penalty: float = PENALTY, steps: int = STEPS, tolerance: float = TOLERANCE) -> Logistic:
    """Fits on the blocks of the training files."""
    counted = held.select(F.explode("labels").alias("label")).groupBy("label").count().collect()  # a row a class
    classes, n = sorted(r["label"] for r in counted), sum(r["count"] for r in counted)
    width = len(classes)
    if not width:
        return Logistic([], held.sparkSession.createDataFrame([], "gram string, scale double, w array<double>"))
    zero = F.array(*[F.lit(0.0)] * width)
    state_kind = "gram string, scale double, free boolean, vectors array<double>"
    trial = _scales(held, idfs, n).withColumn("w", zero)
    vectors = trial.select("gram", "scale", "free", F.lit(None).cast("array<double>").alias("vectors"))

    def evaluated(trial: DataFrame) -> tuple[float, DataFrame]:
        told = held.groupBy("block").cogroup(_placed(held, trial.select("gram", "scale", "w")).groupBy("of")).applyInArrow(_pass(classes), "gram string, g array<double>")
        sums = _saved(told.groupBy("gram").agg(F.array(*[F.sum(F.get("g", F.lit(k))) for k in range(width)]).alias("g")), "byte_gradient")
        loss = sums.where(F.col("gram").isNull()).first()
        return loss["g"][0] / n, sums.where(F.col("gram").isNotNull())

    def accepted(trial: DataFrame, gradient: DataFrame, state: DataFrame, pairs: int) -> tuple[DataFrame, np.ndarray]:
        joined = trial.join(state.select("gram", "vectors"), "gram").join(gradient, "gram")
        state = _saved(joined.mapInArrow(_next_state(width, pairs, n, penalty), state_kind), "byte_state")
        cells = state.mapInArrow(_products(width), "part int, i int, j int, dot double").groupBy("part", "i", "j").agg(F.sum("dot").alias("dot")).collect()
        size = max(r["i"] for r in cells) + 1
        dots = np.zeros((2, size, size))
        for r in cells:
            dots[r["part"], r["i"], r["j"]] = r["dot"]
        return state, dots

    trial = _saved(trial, "byte_trial")
    objective, gradient = evaluated(trial)
    state, (dots, bound) = accepted(trial, gradient, vectors, 0)
    pairs, losses = 0, [objective]
    for _ in range(steps):
        if np.sqrt(dots[1, 1]) <= tolerance:
            break
        d = _direction(dots, pairs)
        slope = d @ dots[:, 1]
        length = 1.0 if pairs else min(1.0, 1 / np.sqrt(dots[1, 1]))
        for _ in range(20):
            trial = state.mapInArrow(_moved(length * d, width), "gram string, scale double, free boolean, w array<double>")
            loss, gradient = evaluated(trial)
            at = length * d
            at[0] += 1
            loss += penalty / 2 * float(at @ bound @ at)
            if loss <= objective + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        state, (dots, bound) = accepted(trial, gradient, state, pairs)
        pairs, objective = min(HISTORY, pairs + 1), loss
        losses.append(objective)
        if dots[2 * pairs, 2 * pairs + 1] <= 0 or losses[-2] - losses[-1] <= tolerance * 1e-4 * max(1.0, abs(objective)):
            break
    return Logistic(classes, _saved(state.select("gram", "scale", F.slice("vectors", 1, width).alias("w")), "byte_weights"), losses)


def _decided(classes: list[str]):
    def run(held: pa.Table, weights: pa.Table) -> pa.Table:
        files, labels, told = [], [], []
        for row in held.to_pylist():
            block = Block.of(row)
            owner, places, values, w = _dense(block, weights, "w", len(classes))
            margin = _sums(owner, values[:, None] * w[places], len(block.files))
            files += block.files
            labels += block.labels
            told += [classes[k] for k in margin.argmax(axis=1).tolist()]
        return pa.table({"file_id": pa.array(files, pa.string()), "label": pa.array(labels, pa.string()), "predicted": pa.array(told, pa.string())})

    return run


def predict_logistic(model: Logistic, held: DataFrame) -> DataFrame:
    """``(file_id, label, predicted)`` of all files of the blocks."""
    if not model.classes:
        return held.select(F.explode(F.arrays_zip("files", "labels")).alias("f")).select(F.col("f.files").alias("file_id"), F.col("f.labels").alias("label"), F.lit(None).cast("string").alias("predicted"))
    placed = _placed(held, model.weights)
    return held.groupBy("block").cogroup(placed.groupBy("of")).applyInArrow(_decided(model.classes), "file_id string, label string, predicted string")


# ---------------------------------------------------------------- decision tree

DEPTH = 5
BINS = 32


@dataclass
class Tree:
    """A leaf, or a test: files with fewer than 2^(bin - 1) occurrences of ``gram`` go to ``low``. ``place``: its number, the root being 1."""

    place: int
    totals: np.ndarray
    gram: str = ""
    bin: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def leaves(self) -> list[Tree]:
        return [self] if self.low is None else [*self.low.leaves(), *self.high.leaves()]


def bins(counts: np.ndarray) -> np.ndarray:
    """0 for none, else 1 + floor(log2(count))."""
    return np.where(counts > 0, np.frexp(counts.astype(float))[1], 0)


def _leaf_of(tree: Tree, block: Block) -> np.ndarray:
    """The place of each file's leaf."""
    at = np.full(len(block.files), tree.place)
    place = {g: i for i, g in enumerate(block.grams)}
    todo = [tree]
    while todo:
        node = todo.pop()
        if node.low is None:
            continue
        held = np.zeros(len(block.files), np.int64)
        if node.gram in place:
            mine = block.places == place[node.gram]
            held[block.owner[mine]] = block.counts[mine]
        here = at == node.place
        at[here] = np.where(bins(held)[here] < node.bin, node.low.place, node.high.place)
        todo += [node.low, node.high]
    return at


def _histograms(tree: Tree, classes: list[str], open_: set[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block.of(row)
                node, label = _leaf_of(tree, block), np.array([classes.index(x) for x in block.labels], np.int64)
                keep = np.isin(node, list(open_))[block.owner]
                owner, places, counts = block.owner[keep], block.places[keep], block.counts[keep]
                if not len(owner):
                    continue
                key = ((node[owner] * len(block.grams) + places) * BINS + bins(counts)) * len(classes) + label[owner]
                key, n = np.unique(key, return_counts=True)
                key, c = np.divmod(key, len(classes))
                key, at = np.divmod(key, BINS)
                at_node, places = np.divmod(key, len(block.grams))
                cols = [pa.array(at_node, pa.int32()), pa.array(block.grams, pa.string()).take(pa.array(places)), pa.array(at, pa.int32()), pa.array(c, pa.int32()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "gram", "bin", "c", "n"])

    return run


def gain(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """What a split adds to the sum over its sides of (class count)^2 / count, beyond the node's own; the last axis is the class."""
    def purity(x):
        n = x.sum(axis=-1)
        return (x.astype(float) ** 2).sum(axis=-1) / np.maximum(n, 1)

    return purity(low) + purity(high) - purity(low + high)


def _best(totals: dict[int, np.ndarray], width: int):
    """The best split of each gram of each node: from the highest bin down, running sums are the upper side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            told = b.column("told")
            rows = np.repeat(np.arange(b.num_rows), np.diff(told.offsets.to_numpy()))
            flat = told.flatten()
            count = np.zeros((b.num_rows, BINS + 1, width), np.int64)
            np.add.at(count, (rows, flat.field("bin").to_numpy(), flat.field("c").to_numpy()), flat.field("n").to_numpy())
            high = count[:, ::-1].cumsum(axis=1)[:, ::-1]
            total = np.array([totals[x] for x in b.column("node").to_pylist()])[:, None, :]
            gains = gain(total - high, high)
            gains[:, 0] = 0
            gains[(high.sum(axis=2) == 0) | ((total - high).sum(axis=2) == 0)] = 0
            at = gains.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("gram"), pa.array(at, pa.int32()), pa.array(gains[np.arange(len(at)), at]), pa.array(high[np.arange(len(at)), at].tolist(), pa.list_(pa.int64()))],
                                             names=["node", "gram", "bin", "gain", "high"])

    return run


def fit_tree(held: DataFrame, idfs: DataFrame, depth: int = DEPTH) -> tuple[list[str], Tree | None]:
    """``(classes, tree)`` of the blocks of the training files; a gram without idf is no feature, as its TF-IDF is 0 everywhere."""
    counted = {r["label"]: r["count"] for r in held.select(F.explode("labels").alias("label")).groupBy("label").count().collect()}  # a row a class
    classes = sorted(counted)
    if not classes:
        return [], None
    tree = Tree(1, np.array([counted[c] for c in classes], np.int64))
    for _ in range(depth):
        leaves = {x.place: x for x in tree.leaves() if x.place.bit_length() == tree_level(tree) and np.count_nonzero(x.totals) > 1}
        if not leaves:
            break
        sums = held.mapInArrow(_histograms(tree, classes, set(leaves)), "node int, gram string, bin int, c int, n long").groupBy("node", "gram", "bin", "c").agg(F.sum("n").alias("n"))
        listed = sums.join(idfs.where(F.col("idf") > 0), "gram", "left_semi").groupBy("node", "gram").agg(F.collect_list(F.struct("bin", "c", "n")).alias("told"))  # at most BINS x classes
        split = listed.mapInArrow(_best({p: x.totals for p, x in leaves.items()}, len(classes)), "node int, gram string, bin int, gain double, high array<long>")
        best = split.where(F.col("gain") > 1e-9).groupBy("node").agg(F.min_by(F.struct("gram", "bin", "high"), F.struct(-F.col("gain"), "gram", "bin")).alias("b")).collect()  # a row a leaf
        if not best:
            break
        for r in best:
            node, high = leaves[r["node"]], np.array(r["b"]["high"], np.int64)
            node.gram, node.bin = r["b"]["gram"], r["b"]["bin"]
            node.low, node.high = Tree(2 * node.place, node.totals - high), Tree(2 * node.place + 1, high)
    return classes, tree


def tree_level(tree: Tree) -> int:
    """Digits of the places of the deepest leaves."""
    return max(x.place.bit_length() for x in tree.leaves())


def _sorted_by(tree: Tree | None, classes: list[str]):
    winner = {} if tree is None else {x.place: classes[int(x.totals.argmax())] for x in tree.leaves()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block.of(row)
                told = [None] * len(block.files) if tree is None else [winner[p] for p in _leaf_of(tree, block).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (block.files, block.labels, told)], names=["file_id", "label", "predicted"])

    return run


def predict_tree(classes: list[str], tree: Tree | None, held: DataFrame) -> DataFrame:
    """``(file_id, label, predicted)`` of all files of the blocks."""
    return held.mapInArrow(_sorted_by(tree, classes), "file_id string, label string, predicted string")


# ---------------------------------------------------------------- both

def fit_predict(train: DataFrame, test: DataFrame, model: str = "logistic", most_files: int | None = MOST_FILES) -> DataFrame:
    """``(file_id, label, predicted)`` of the test files; both tables have ``file_id, label, content``."""
    held, asked, idfs = blocks(sample(train, most_files)), blocks(test), gram_idf(train)
    if model == "logistic":
        return predict_logistic(fit_logistic(held, idfs), asked)
    return predict_tree(*fit_tree(held, idfs), asked)
