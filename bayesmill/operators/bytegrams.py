"""Byte n-gram features for byte-dump files.

Files -> codes (2-char tokens) -> n-grams for each n in ``grams`` (each n
counted once) -> per-file counts, thresholded (``freq >= min_freq``) before any
join -> joined with labels on file id. Long form ``(file_id, gram, freq)``
throughout; a ``map<string,long>`` per file only at the edge (``as_map``).

Grams are counted where they are read (``functions/codes.py``), so only a row
per distinct gram of a file leaves a scan task; a final sum by (file, gram)
joins what several tasks have of one file. Two sources:

* ``(path, content)`` rows: a file is one row;
* a folder of files (``ngram_freq_splits``): lines are read by file splits, so
  one file is counted by as many tasks as it has splits. A split also tells its
  first and last codes, and the grams that cross a border come from the codes
  before it, by split order.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bayesmill.functions.bytes import TOKEN_LENGTH, byte_tokens, file_id
from bayesmill.functions.codes import codes, count_grams, joined, parted
from bayesmill.operators import tfidf as TF
from bayesmill.session import scratch_path
from bayesmill.sources.files import as_stored, each_folder, read_file_lines, read_whole_files

CHUNK_CODES = 1 << 20    # counted at once in a task
BLOCK_CHUNKS = 16        # of a block of files
BLOCK_GRAMS = 1 << 21    # a block ends that has told as many, chunk by chunk
OUT_ROWS = 100_000       # of a batch
SLICE_ROWS = 1000        # whose texts a task turns into strings at a time
WHOLE_BYTES = 1 << 16    # of a file that is read as one split

# The code travels with its tasks: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tokenized(files: DataFrame, path_col: str = "path", content_col: str = "content",
              partition: bool = False) -> DataFrame:
    """``(file_id, tokens array<string>)``.

    ``partition=True`` hash-partitions the raw files by id first (the raw text
    is smaller than its token arrays), so per-file counts need no exchange.
    """
    f = files.select(file_id(path_col).alias("file_id"), F.col(content_col).alias("_content"))
    if partition:
        f = f.repartition("file_id")
    return f.select("file_id", byte_tokens("_content").alias("tokens"))


def _counted(names: Sequence[str], parts: Sequence[np.ndarray], grams: Sequence[int], sep: str,
             least: int = 1, many: Sequence[bool] | None = None) -> Iterator[pa.RecordBatch]:
    """Counts of each part, those below ``least`` left out where a part is all that its name has (``many`` is not set)."""
    for k in grams:
        counted = list(count_grams(parts, k))
        for g in counted:
            owner, key, n = g.owner, g.key, g.n
            if many is not None and len(counted) == 1:  # else a pair may be in several counts
                kept = np.flatnonzero((n >= least) | np.array(many, bool)[owner])
                owner, key, n = owner[kept], key[kept], n[kept]
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(owner)), g.names(key, sep), pa.array(n, pa.int64())], names=["file_id", "gram", "n"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of SLICE_ROWS rows, so that few texts are Python strings at a time."""
    pa.default_memory_pool().release_unused()  # what earlier tasks of this worker have left
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)


def _row_counter(grams: Sequence[int], sep: str, least: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            names, parts, many, held = [], [], [], 0
            for i, (name, text, again) in enumerate(zip(b.column("file_id").to_pylist(), b.column("content").to_pylist(), b.column("many").to_pylist(), strict=True), 1):
                names.append(name)
                parts.append(codes(text or ""))
                many.append(again)
                held += len(parts[-1])
                if held >= CHUNK_CODES or i == b.num_rows:
                    yield from _counted(names, parts, grams, sep, least, many)
                    names, parts, many, held = [], [], [], 0

    return run


def _repeated(ids: DataFrame) -> DataFrame | None:
    """``(_id, _many)``: the values of ``file_id`` that come more than once, null being one like others; None if there are none."""
    spark, path = ids.sparkSession, scratch_path(ids.sparkSession, "repeated")
    ids.groupBy("file_id").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select(F.col("file_id").alias("_id")).write.parquet(path)
    found = spark.read.schema("_id string").parquet(path)
    return None if found.isEmpty() else found.withColumn("_many", F.lit(True))


def _with_many(files: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """Adds ``many``: whether ``repeated`` has the ``file_id``."""
    if repeated is None:
        return files.withColumn("many", F.lit(False))
    return files.join(repeated, F.col("file_id").eqNullSafe(F.col("_id")), "left").withColumn("many", F.coalesce("_many", F.lit(False))).drop("_id", "_many")


def gram_counts(files: DataFrame, grams: Sequence[int] = (1, 2), sep: str = "",
                path_col: str = "path", content_col: str = "content", least: int = 1) -> DataFrame:
    """``(file_id, gram, freq)``: each distinct gram of a file with its count, if that is ``least`` at least.

    With ``least`` above 1, grams that a file's only row has more rarely leave
    no task; ids with several rows are counted in full and summed up.
    """
    f = files.select(file_id(path_col).alias("file_id"), F.col(content_col).alias("content"))
    f = _with_many(f, _repeated(f) if least > 1 else None)
    part = f.mapInArrow(_row_counter(sorted(set(grams)), sep, least), _COUNTS)
    return part.groupBy("file_id", "gram").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least)


def ngram_freq(files: DataFrame, grams: Sequence[int] = (1, 2), min_freq: int = 200, sep: str = "",
               path_col: str = "path", content_col: str = "content") -> DataFrame:
    """``(file_id, gram, freq)`` with per-file count ``freq >= min_freq``."""
    return gram_counts(files, grams, sep, path_col, content_col, min_freq)


_COUNTS = "file_id string, gram string, n long"
_SPLIT = "path string, gram string, n long, start long, head string, tail string"


def _split_counter(grams: Sequence[int], sep: str):
    """Counts of the lines of each split, read front to back, and one row a split with its first and last codes."""
    edge = grams[-1] - 1

    def told(counted: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in counted:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=["path", "gram", "n", "start", "head", "tail"])

    def count(path: str, before: np.ndarray, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in grams:  # a gram belongs to the chunk that it ends in
            part = np.concatenate([before[len(before) - min(k - 1, len(before)):], found])
            yield from told(_counted([path], [part], [k], sep))

    def last(path: str, start: int, head: np.ndarray, tail: np.ndarray) -> pa.RecordBatch:
        row = [[path], [None], [None], [start], [joined(head)], [joined(tail)]]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names=["path", "gram", "n", "start", "head", "tail"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, none = None, np.empty(0, np.int64)
        head = tail = none
        for b in batches:
            paths, starts = b.column("path").dictionary_encode(), b.column("start").to_numpy()
            of = paths.indices.to_numpy()
            cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                this = (paths.dictionary[int(of[s])].as_py(), int(starts[s]))
                if this != split:
                    if split is not None:
                        yield last(*split, head, tail)
                    split, head, tail = this, none, none
                found = codes("\n".join(x or "" for x in b.column("value").slice(s, e - s).to_pylist()))
                for at in range(0, len(found), CHUNK_CODES):
                    chunk = found[at:at + CHUNK_CODES]
                    yield from count(split[0], tail, chunk)
                    head = head if len(head) >= edge else np.concatenate([head, chunk])[:edge]
                    tail = np.concatenate([tail, chunk])[-edge:] if edge else none
        if split is not None:
            yield last(*split, head, tail)

    return run


def _grams_regex(k: int) -> str:
    """All overlapping k-grams of joined two-character codes: a lookahead
    captures 2k characters and the match consumes one code, so consecutive
    matches start at consecutive codes."""
    return f"(?s)(?=(.{{{k * TOKEN_LENGTH}}})).{{{TOKEN_LENGTH}}}"


def _border_grams(edges: DataFrame, grams: Sequence[int], sep: str) -> DataFrame:
    """``(path, gram, n)`` of the grams that start in one split of a file and end in a later one.

    Splits without codes are left out, so the last k - 1 codes before a split
    lie in at most k - 1 splits.
    """
    order, width = Window.partitionBy("path").orderBy("start"), grams[-1] - 1
    held = edges.where(F.length("head") > 0)
    before = F.right(F.concat(*[F.coalesce(F.lag("tail", k).over(order), F.lit("")) for k in range(width, 0, -1)]), F.lit(width * TOKEN_LENGTH))
    placed = held.select("path", "head", before.alias("before"))
    found = []
    for k in [k for k in grams if k > 1]:
        reach = F.lit((k - 1) * TOKEN_LENGTH)
        g = F.regexp_extract_all(F.concat(F.right("before", reach), F.left("head", reach)), F.lit(_grams_regex(k)), 1)
        if sep:
            g = F.transform(g, lambda x: F.regexp_replace(x, "(?s)(..)(?!$)", "$1" + sep.replace("$", "\\$")))
        found.append(g)
    return placed.select("path", F.explode(F.concat(*found)).alias("gram")).select("path", "gram", F.lit(1).cast("long").alias("n"))


def ngram_freq_splits(spark: SparkSession, path: str | Sequence[str], grams: Sequence[int] = (1, 2), min_freq: int = 200, sep: str = "", glob: str = "*") -> DataFrame:
    """``(file_id, gram, freq)`` of the files below ``path``, read by splits: the lines are never shuffled, and a file of
    any size is counted by many tasks (a single line must fit one).

    Several folders are read a few at a time, so that the driver holds the names of those alone. If ``glob`` names a plain
    ending, a file of at most WHOLE_BYTES is one split and read whole; grams
    that it has more rarely than ``min_freq`` leave no task if no other file has
    its id.
    """
    sizes, folders, plain = sorted(set(grams)), [path] if isinstance(path, str) else list(path), as_stored(glob)
    whole, ids = (scratch_path(spark, x) for x in ("file_grams", "file_ids"))
    splits: dict[int, DataFrame] = {}
    many = plain and min_freq > 1
    tasks = 4 * spark.sparkContext.defaultParallelism

    def name(k: int, folder: str) -> None:
        names = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").format("binaryFile").load(folder)
        names.select(file_id(F.col("_metadata.file_path")).alias("file_id")).coalesce(tasks).write.parquet(f"{ids}/folder={k}")

    def count(k: int, folder: str) -> None:
        lines = read_file_lines(spark, folder, glob, WHOLE_BYTES if plain else None)
        if len(folders) > 1:
            lines = lines.coalesce(tasks)  # else the tasks that read them again grow with the folders
        splits[k] = TF.materialize(lines.mapInArrow(_split_counter(sizes, sep), _SPLIT))
        if plain:
            mark, text = F.lit("\ufeff"), F.col("content")  # lines come without a mark of the byte order too
            files = read_whole_files(spark, folder, glob, WHOLE_BYTES).select(file_id("path").alias("file_id"), F.when(text.startswith(mark), F.ltrim(text, mark)).otherwise(text).alias("content"))
            _with_many(files, repeated).mapInArrow(_row_counter(sizes, sep, min_freq), _COUNTS).write.parquet(f"{whole}/folder={k}")

    each_folder(spark, folders if many else (), name)
    repeated = _repeated(spark.read.schema("file_id string").parquet(ids)) if many else None
    each_folder(spark, folders, count)
    told = functools.reduce(DataFrame.unionByName, [splits[k] for k in sorted(splits)])
    counts = told.where(F.col("gram").isNotNull()).select("path", "gram", "n")
    if sizes[-1] > 1:
        counts = counts.unionByName(_border_grams(told.where(F.col("head").isNotNull()).select("path", "start", "head", "tail"), sizes, sep))
    counts = counts.select(file_id("path").alias("file_id"), "gram", "n")
    if plain:
        counts = counts.unionByName(spark.read.schema(_COUNTS).parquet(whole).drop("folder"))
    return counts.groupBy("file_id", "gram").agg(F.sum("n").alias("freq")).where(F.col("freq") >= min_freq)


def byte_features(files: DataFrame, labels: DataFrame, grams: Sequence[int] = (1, 2),
                  min_freq: int = 200, sep: str = "", id_col: str = "file_id",
                  label_col: str = "label") -> DataFrame:
    """``(file_id, gram, freq, label)``: thresholded counts joined with labels (inner).

    Files without a label are left out before their grams are made.
    """
    lab = labels.select(F.col(id_col).alias("file_id"), F.col(label_col).alias("label"))
    labelled = files.withColumn("file_id", file_id("path")).join(lab.select("file_id"), "file_id", "left_semi")
    return ngram_freq(labelled, grams, min_freq, sep).join(lab, "file_id")


def byte_features_splits(spark: SparkSession, path: str | Sequence[str], labels: DataFrame, grams: Sequence[int] = (1, 2),
                         min_freq: int = 200, sep: str = "", glob: str = "*") -> DataFrame:
    """``byte_features`` of a folder of files, read by splits; ``labels`` has ``file_id, label``."""
    return ngram_freq_splits(spark, path, grams, min_freq, sep, glob).join(labels.select("file_id", "label"), "file_id")


def as_map(features: DataFrame) -> DataFrame:
    """``(file_id, grams map<string,long>, label)``: the per-file dictionary form."""
    return features.groupBy("file_id", "label").agg(
        F.map_from_entries(F.collect_list(F.struct("gram", "freq"))).alias("grams"))


_BLOCKS = "block long, names array<string>, owners array<int>, lengths array<int>, size long, codes binary, gram string, n long"
_BLOCK_TYPES = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.string(), pa.int64())
_BLOCK_NAMES = ["block", "names", "owners", "lengths", "size", "codes", "gram", "n"]


def _chunk_grams(parts: Sequence[np.ndarray], owners: Sequence[int], k: int, sep: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """``owner, place, n, grams`` of a chunk: each distinct (owner, gram) pair once, ``place`` being its gram's place in ``grams``."""
    counted = list(count_grams(parts, k, owners))
    if len(counted) == 1 and len(set(owners)) == len(owners):
        g = counted[0]
        keys, place = np.unique(g.key, return_inverse=True)
        yield g.owner, place, g.n, g.names(keys, sep)
    elif counted:  # a pair is in several counts or parts: their sums
        t = pa.concat_tables([pa.table({"owner": g.owner, "gram": g.names(g.key, sep), "n": g.n}) for g in counted])
        t = t.group_by(["owner", "gram"]).aggregate([("n", "sum")]).combine_chunks()
        gram = t.column("gram").combine_chunks().dictionary_encode()
        yield t.column("owner").to_numpy(), gram.indices.to_numpy(), t.column("n_sum").to_numpy(), gram.dictionary


def _blocks(grams: Sequence[int], sep: str):
    """Files in blocks: rows with the codes of whole files (a chunk each), and one row a distinct gram of the block with
    the number of its files that have it. Rows of one file must follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, found = TaskContext.get().partitionId() << 33, []
        names, owners, parts, held, chunks, most = [], [], [], 0, 0, 0

        def told(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            cols = {"block": [block] * n, **columns}
            return pa.RecordBatch.from_arrays([pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in zip(_BLOCK_NAMES, _BLOCK_TYPES, strict=True)], names=_BLOCK_NAMES)

        def chunk() -> Iterator[pa.RecordBatch]:
            nonlocal names, owners, parts, held, chunks, most
            if held:
                for k in grams:
                    for _, place, _, gram in _chunk_grams(parts, owners, k, sep):
                        found.append(pa.table({"gram": gram, "n": np.bincount(place, minlength=len(gram)).astype(np.int64)}))
                        most += len(gram)
                data = joined(np.concatenate(parts)).encode()
                yield told(names=[names], owners=[owners], lengths=[[len(p) for p in parts]], size=[len(data)], codes=[pa.compress(data, codec="zstd", asbytes=True)])
                chunks += 1
            names, owners, parts, held = [], [], [], 0

        def whole() -> Iterator[pa.RecordBatch]:
            nonlocal block, found, chunks, most
            if found:
                t = pa.concat_tables(found).group_by("gram").aggregate([("n", "sum")]).combine_chunks()
                for b in t.to_batches(max_chunksize=100_000):
                    yield told(gram=b.column("gram"), n=b.column("n_sum"))
            block, found, chunks, most = block + 1, [], 0, 0

        for b in _slices(batches):
            for name, text in zip(b.column("file_id").to_pylist(), b.column("content").to_pylist(), strict=True):
                part = codes(text or "")
                if not len(part):
                    continue
                if not names or name != names[-1]:
                    if held >= CHUNK_CODES:
                        yield from chunk()
                        if chunks >= BLOCK_CHUNKS or most >= BLOCK_GRAMS:
                            yield from whole()
                    names.append(name)
                owners.append(len(names) - 1)
                parts.append(part)
                held += len(part)
        yield from chunk()
        yield from whole()

    return run


def _weigher(grams: Sequence[int], sep: str):
    """Rows ``file_id, term, tf, idf`` of the chunks of each block; the weights of its grams come before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, gram, idf = None, [], None, None
        for b in batches:
            blocks, is_chunk = b.column("block").to_numpy(), b.column("codes").is_valid().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((blocks[1:] != blocks[:-1]) | (is_chunk[1:] != is_chunk[:-1])) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if blocks[s] != block:
                    block, held, gram = blocks[s], [], None
                if not is_chunk[s]:
                    held.append(pa.table({"gram": b.column("gram").slice(s, e - s), "idf": b.column("idf").slice(s, e - s)}))
                    continue
                if gram is None:
                    weights = pa.concat_tables(held)
                    gram, idf, held = weights.column("gram").combine_chunks(), weights.column("idf").to_numpy(), []
                for row in b.slice(s, e - s).select(["names", "owners", "lengths", "size", "codes"]).to_pylist():
                    flat = parted(pa.decompress(row["codes"], row["size"], codec="zstd", asbytes=True).decode())
                    parts, names = np.split(flat, np.cumsum(row["lengths"])[:-1]), pa.array(row["names"], pa.string())
                    for k in grams:
                        for owner, place, n, distinct in _chunk_grams(parts, row["owners"], k, sep):
                            at = pc.index_in(distinct, value_set=gram).to_numpy(zero_copy_only=False)
                            for i in range(0, len(n), OUT_ROWS):
                                to = slice(i, i + OUT_ROWS)
                                yield pa.RecordBatch.from_arrays([names.take(pa.array(owner[to])), distinct.take(pa.array(place[to])), pa.array(n[to], pa.int64()), pa.array(idf[at[place[to]]], pa.float64())], names=["file_id", "term", "tf", "idf"])

    return run


def byte_tfidf(files: DataFrame, grams: Sequence[int] = (1, 2, 3), sep: str = "",
               sqrt: bool = False) -> DataFrame:
    """``(file_id, gram, tf, idf, tfidf)`` over all files, N = number of files.

    Rows of files and grams are never shuffled or saved. Files are saved in
    blocks of at most BLOCK_CHUNKS chunks of about CHUNK_CODES codes, with the
    distinct grams of each block; the weights come back to the blocks by gram
    and the grams are counted again there. Rows of one file id, if
    an id repeats, are brought together first (they must fit a task).
    """
    spark, sizes = files.sparkSession, sorted(set(grams))
    f = files.select(file_id("path").alias("file_id"), F.col("content"))
    if f.groupBy("file_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).limit(1).count():
        f = f.repartition("file_id").sortWithinPartitions("file_id")
    path = scratch_path(spark, "blocks")
    f.mapInArrow(_blocks(sizes, sep), _BLOCKS).write.option("compression", "zstd").parquet(path)
    saved = spark.read.schema(_BLOCKS).parquet(path)
    chunks = saved.where(F.col("codes").isNotNull())
    held = saved.where(F.col("gram").isNotNull()).select("block", "gram", "n")
    tasks = max(1, chunks.select("block").distinct().count())
    # a gram has one row a block, so none is hot
    per_gram = held.repartition(tasks, "gram").withColumn("df", F.sum("n").over(Window.partitionBy("gram")))
    n = files.select(F.count(F.lit(1))).scalar()
    weights = TF.idf(per_gram.select(F.col("gram").alias("term"), "df", "block"), n, "block").select("block", F.col("term").alias("gram"), "idf")
    told = weights.unionByName(chunks.drop("gram", "n"), allowMissingColumns=True)
    dealt = told.repartition(tasks, "block").sortWithinPartitions("block", F.col("codes").isNotNull())
    t = dealt.mapInArrow(_weigher(sizes, sep), "file_id string, term string, tf long, idf double")
    w = F.col("tf") * F.col("idf")
    return t.select("file_id", F.col("term").alias("gram"), "tf", "idf", (F.pow(w, 0.5) if sqrt else w).alias("tfidf"))
