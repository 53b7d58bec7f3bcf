"""Term counts with document frequencies, without a shuffled or saved row of (document, term).

Documents are saved once in blocks of about BLOCK_WORDS words, as numbers of the
block's own word list. A block tells its distinct terms with the documents that
have them, dealt over buckets by a hash of the term; a task adds up a bucket of
all blocks and gives each block the document frequencies of its terms, in the
order it told them. There they meet the saved documents, whose terms are counted
again. Rows of one id must lie in one block, and fit a task.

``stemmed_counts`` saves the same blocks with their words; each distinct word is
normalised once, as a table, and its norm comes back to the blocks that have it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from bayesmill.functions.stem import normalize_terms
from bayesmill.functions.stopwords import default_stop_words
from bayesmill.session import scratch_path

BLOCK_WORDS = 3 << 18
BUCKET_CHARS = 1 << 25   # of text, for each bucket of terms
HASH_TERMS = 100_000     # hashed at once
OUT_ROWS = 100_000       # of a batch
SLICE_ROWS = 1000        # whose words a task parts at a time

# The code travels with its tasks: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _pack(raw: bytes, level: int = 1) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def _unpack(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _parts(strings: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The offsets of ``strings``, from 0, and their bytes."""
    if not len(strings):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return offsets - offsets[0], data


def _pack_strings(strings: pa.StringArray) -> bytes:
    offsets, data = _parts(strings)
    return _pack(len(strings).to_bytes(8, "little") + np.diff(offsets).astype(np.int32).tobytes() + data.tobytes(), 6)


def _unpack_strings(data: bytes) -> pa.StringArray:
    raw = _unpack(data)
    n = int.from_bytes(raw[:8], "little")
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.int32, n, 8))]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw[8 + 4 * n:]))


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Byte by byte of all numbers: their high bytes are alike."""
    return _pack(np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(_unpack(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<i8").ravel()


def _bucket_order(terms: pa.StringArray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``terms`` bucket by bucket, and how many are in each bucket."""
    if buckets == 1:
        return np.arange(len(terms)), np.array([len(terms)])
    hashes = []
    for at in range(0, len(terms), HASH_TERMS):
        offsets, data = _parts(terms.slice(at, HASH_TERMS))
        powers = np.cumprod(np.full(int(np.diff(offsets).max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
        summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place], dtype=np.uint64)])
        h = summed[offsets[1:]] - summed[offsets[:-1]]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        hashes.append(((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64))
    bucket = np.concatenate([*hashes, np.empty(0, np.int64)])
    return np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=buckets)


def _longer(names: pa.StringArray, place: np.ndarray, words: pa.StringArray, follower: np.ndarray, sep: str) -> tuple[pa.StringArray, np.ndarray]:
    """The distinct n-grams of ``names`` and a word more, and the place of each in them."""
    distinct, found = np.unique(place.astype(np.int64) * len(words) + follower, return_inverse=True)
    first, last = np.divmod(distinct, max(1, len(words)))
    return pc.binary_join_element_wise(names.take(pa.array(first)), words.take(pa.array(last)), sep), found.astype(np.int32)


def _count(codes: np.ndarray, lengths: np.ndarray, owners: np.ndarray, words: pa.StringArray, grams: Sequence[int], sep: str) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
    """``terms, owner, place, n``: the distinct n-grams of a block, and each (owner, term) pair once with its count, by
    owner. ``codes`` are places in ``words``, row after row; terms that are written alike are one."""
    row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    names, place, at, told, found = words, codes.astype(np.int32), np.arange(len(codes), dtype=np.int32), [], []
    for k in range(1, grams[-1] + 1):
        if k > 1:  # starts of grams that end in their own row
            inside = np.flatnonzero(at < len(codes) - k + 1)
            inside = inside[row[at[inside]] == row[at[inside] + k - 1]]
            at = at[inside]
            names, place = _longer(names, place[inside], words, codes[at + k - 1], sep)
        if k in grams:
            told.append(names)
            found.append((at, place))
    encoded = pa.concat_arrays(told).dictionary_encode()
    terms, term = encoded.dictionary, encoded.indices.to_numpy()
    del encoded, names, place
    pairs, before = np.empty(sum(len(at) for at, _ in found), np.int64), 0
    done = 0
    for names, (at, place) in zip(told, found, strict=True):
        pairs[done:done + len(at)] = owners[row[at]] * len(terms) + term[place + before]
        done, before = done + len(at), before + len(names)
    del told, found, term, row
    pairs.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1]]))
    n = np.diff(np.append(first, len(pairs)))
    return (terms, *np.divmod(pairs[first], max(1, len(terms))), n)


def _schema(id_type) -> StructType:
    return StructType([
        StructField("block", LongType()), StructField("ids", ArrayType(id_type)), StructField("owners", BinaryType()), StructField("lengths", BinaryType()),
        StructField("words", BinaryType()), StructField("codes", BinaryType()), StructField("bucket", IntegerType()), StructField("terms", BinaryType()), StructField("counts", BinaryType()),
    ])


# As functions.text.clean_text does it, byte by byte: characters beyond ASCII are deleted, and so are their bytes.
_CLEAN = np.zeros(256, np.uint8)
_CLEAN[list(b" \r\n")] = 32
_CLEAN[np.arange(65, 91)] = _CLEAN[np.arange(97, 123)] = np.arange(97, 123)


def _cleaned(text: pa.StringArray) -> pa.StringArray:
    """``clean_text`` of each text, a null being empty."""
    offsets, data = _parts(text.cast(pa.string()).fill_null(""))
    clean = _CLEAN[data]
    kept = clean != 0
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets].astype(np.int32)
    return pa.StringArray.from_buffers(len(text), pa.py_buffer(ends), pa.py_buffer(clean[kept]))


def _words(text: pa.StringArray, stop_words: pa.StringArray) -> pa.ListArray:
    """The words of each cleaned text that are not among ``stop_words``."""
    lists = pc.split_pattern(text, " ")
    flat, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    found = flat.dictionary_encode()
    kept = pc.invert(pc.is_in(found.dictionary, value_set=stop_words)).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(kept[found.indices.to_numpy()]) if len(flat) else np.empty(0, np.int64)
    ends = np.cumsum(np.bincount(row[at], minlength=len(text)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), flat.take(pa.array(at)))


def _numbered(lists: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """``codes, lengths, words`` of rows of words: their places in the sorted ``words``, row after row."""
    rows = pa.concat_arrays(lists)
    flat = rows.flatten().dictionary_encode()
    order = pc.sort_indices(flat.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[flat.indices.to_numpy()], pc.list_value_length(rows).to_numpy().astype(np.int64), flat.dictionary.take(pa.array(order))


def _in_blocks(batches: Iterator[pa.RecordBatch], stop_words: Sequence[str], told) -> Iterator[pa.RecordBatch]:
    """What ``told`` makes of each block's number, ids and words, from rows ``id, text``."""
    pa.default_memory_pool().release_unused()  # what earlier tasks of this worker have left
    block, ids, lists, held, last = TaskContext.get().partitionId() << 33, [], [], 0, None
    listed = pa.array(["", *stop_words], pa.string())
    for b in (x.slice(at, SLICE_ROWS) for x in batches for at in range(0, x.num_rows, SLICE_ROWS)):
        names, words, begun = b.column("id"), _words(_cleaned(b.column("text")), listed), 0
        for i, (name, n) in enumerate(zip(names.to_pylist(), pc.list_value_length(words).to_pylist(), strict=True)):
            if held >= BLOCK_WORDS and name != last:
                yield from told(block, [*ids, names.slice(begun, i - begun)], [*lists, words.slice(begun, i - begun)])
                block, ids, lists, held, begun = block + 1, [], [], 0, i
                pa.default_memory_pool().release_unused()
            held, last = held + n, name
        ids.append(names.slice(begun))
        lists.append(words.slice(begun))
    if held:
        yield from told(block, ids, lists)


def _rows(names: Sequence[str], kinds: Sequence[pa.DataType], n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, kinds, strict=True)], names=names)


def _as_list(ids: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)


def _blocks(grams: Sequence[int], sep: str, buckets: int, stop_words: Sequence[str]):
    """Rows ``id, text`` as blocks: a row with the documents of each, and a row with its distinct terms in a bucket."""

    def told(block: int, ids: list[pa.Array], lists: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        own = pa.concat_arrays(ids).dictionary_encode(null_encoding="encode")
        codes, lengths, words = _numbered(lists)
        owners = own.indices.to_numpy().astype(np.int64)
        terms, place = _count(codes, lengths, owners, words, grams, sep)[::2]
        docs = np.bincount(place, minlength=len(terms))
        del place
        names = ["block", "ids", "owners", "lengths", "words", "codes", "bucket", "terms", "counts"]
        kinds = [pa.int64(), pa.list_(own.dictionary.type), *[pa.binary()] * 4, pa.int32(), pa.binary(), pa.binary()]
        yield _rows(names, kinds, 1, block=[block], ids=_as_list(own.dictionary), owners=[_pack_numbers(owners)], lengths=[_pack_numbers(lengths)], words=[_pack_strings(words)], codes=[_pack_numbers(codes)])
        by_bucket, sizes = _bucket_order(terms, buckets)
        ends = np.cumsum(sizes)
        for bucket in np.flatnonzero(sizes).tolist():
            at = by_bucket[ends[bucket] - sizes[bucket]:ends[bucket]]
            yield _rows(names, kinds, 1, block=[block], bucket=[bucket], terms=[_pack_strings(terms.take(pa.array(at)))], counts=[_pack_numbers(docs[at])])

    return lambda batches: _in_blocks(batches, stop_words, told)


def _summed(terms: pa.Table) -> pa.Table:
    """``block, bucket, counts`` of a bucket: the counts of its terms in all blocks."""
    told = [_unpack_strings(x.as_py()) for x in terms.column("terms")]
    term = pa.concat_arrays(told).dictionary_encode().indices.to_numpy()
    n = np.bincount(term, weights=np.concatenate([_unpack_numbers(x.as_py()) for x in terms.column("counts")])).astype(np.int64)
    found = np.split(n[term], np.cumsum([len(x) for x in told])[:-1])
    return terms.select(["block", "bucket"]).append_column("counts", pa.array([_pack_numbers(x) for x in found], pa.binary()))


def _counter(grams: Sequence[int], sep: str, buckets: int):
    """Rows ``id, term, tf, df`` of each block; the document frequencies of its terms come before its documents, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        held: list[np.ndarray] = []
        for b in batches:
            ids = b.column("ids")
            for i, row in enumerate(b.drop_columns(["ids"]).to_pylist()):
                if row["codes"] is None:
                    held.append(_unpack_numbers(row["counts"]))
                    continue
                words, own = _unpack_strings(row["words"]), ids.slice(i, 1).flatten()
                terms, owner, place, n = _count(*[_unpack_numbers(row[c]) for c in ("codes", "lengths", "owners")], words, grams, sep)
                df = np.empty(len(terms), np.int64)
                df[_bucket_order(terms, buckets)[0]] = np.concatenate(held) if held else []
                held = []
                for at in range(0, len(n), OUT_ROWS):
                    to = slice(at, at + OUT_ROWS)
                    yield pa.RecordBatch.from_arrays([own.take(pa.array(owner[to])), terms.take(pa.array(place[to])), pa.array(n[to], pa.int64()), pa.array(df[place[to]], pa.int64())], names=["id", "term", "tf", "df"])

    return run


def counted(docs: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] | None, grams: Sequence[int], sep: str) -> DataFrame:
    """``(id, term, tf, df)``: each distinct term of an id, its count there, and how many ids have it."""
    listed = default_stop_words() if stop_words is None else tuple(stop_words)
    spark, sizes = docs.sparkSession, sorted(set(grams))
    kind = docs.schema[id_col].dataType
    chars = docs.agg(F.sum(F.length(text_col).cast("long"))).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))
    rows = docs
    if docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).limit(1).count():
        rows = docs.select(id_col, text_col).repartition(id_col).sortWithinPartitions(id_col)
    path = scratch_path(spark, "term_blocks")
    told = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    told.mapInArrow(_blocks(sizes, sep, buckets, listed), _schema(kind)).write.option("compression", "none").parquet(path)
    saved = spark.read.schema(_schema(kind)).parquet(path)
    blocks = saved.where(F.col("codes").isNotNull()).select("block", "ids", "owners", "lengths", "words", "codes")
    terms = saved.where(F.col("terms").isNotNull()).select("block", "bucket", "terms", "counts")
    df = terms.repartitionById(buckets, "bucket").groupBy("bucket").applyInArrow(_summed, "block long, bucket int, counts binary")
    tasks = max(1, blocks.select("block").count())
    dealt = df.unionByName(blocks, allowMissingColumns=True).repartition(tasks, "block").sortWithinPartitions("block", F.col("codes").isNotNull(), "bucket")
    result = StructType([StructField(id_col, kind), StructField("term", StringType()), StructField("tf", LongType()), StructField("df", LongType())])
    return dealt.mapInArrow(_renamed(_counter(sizes, sep, buckets), id_col), result)


def _renamed(run, id_col: str):
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(batches):
            yield b.rename_columns([id_col, "term", "tf", "df"])

    return named


def _word_blocks(stop_words: Sequence[str]):
    """Rows ``id, text`` as blocks: a row with the documents of each, a row an id, and a row for each distinct word."""

    def told(block: int, ids: list[pa.Array], lists: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        own = pa.concat_arrays(ids)
        codes, lengths, words = _numbered(lists)
        names, kinds = ["block", "ids", "lengths", "codes", "term"], [pa.int64(), pa.list_(own.type), pa.binary(), pa.binary(), pa.string()]
        yield _rows(names, kinds, 1, block=[block], ids=_as_list(own), lengths=[_pack_numbers(lengths)], codes=[_pack_numbers(codes)])
        for at in range(0, len(words), OUT_ROWS):
            some = words.slice(at, OUT_ROWS)
            yield _rows(names, kinds, len(some), block=[block] * len(some), term=some)

    return lambda batches: _in_blocks(batches, stop_words, told)


def _norm_counter(grams: Sequence[int], sep: str):
    """Rows ``id, term, tf`` of each block; the norms of its words come before its documents, by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        held: list[pa.Array] = []
        for b in batches:
            documents = np.flatnonzero(b.column("codes").is_valid().to_numpy(zero_copy_only=False)).tolist()
            for begun, i in zip([0, *(x + 1 for x in documents)], [*documents, b.num_rows], strict=True):
                held.append(b.column("norm").slice(begun, i - begun))
                if i == b.num_rows:
                    break
                norms, held = pa.concat_arrays(held).cast(pa.string()).dictionary_encode(), []
                own = b.column("ids").slice(i, 1).flatten()
                codes, lengths = (_unpack_numbers(b.column(c)[i].as_py()) for c in ("codes", "lengths"))
                codes = norms.indices.to_numpy()[codes].astype(np.int64)
                terms, owner, place, n = _count(codes, lengths, np.arange(len(lengths)), norms.dictionary, grams, sep)
                for at in range(0, len(n), OUT_ROWS):
                    to = slice(at, at + OUT_ROWS)
                    yield pa.RecordBatch.from_arrays([own.take(pa.array(owner[to])), terms.take(pa.array(place[to])), pa.array(n[to], pa.int64())], names=["id", "term", "tf"])

    return run


def stemmed_counts(docs: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] | None, grams: Sequence[int], sep: str, keep: Sequence[str], lemmas) -> DataFrame:
    """``(id, *keep, term, tf)`` over lemmas and stems: each distinct term of a row, with its count there (an id is one row)."""
    spark = docs.sparkSession
    listed = default_stop_words() if stop_words is None else tuple(stop_words)
    told = docs.select(F.struct(id_col, *keep).alias("id"), F.col(text_col).alias("text"))
    kind = told.schema["id"].dataType
    schema = StructType([
        StructField("block", LongType()), StructField("ids", ArrayType(kind)), StructField("lengths", BinaryType()), StructField("codes", BinaryType()), StructField("term", StringType()),
    ])
    path = scratch_path(spark, "word_blocks")
    told.mapInArrow(_word_blocks(listed), schema).write.option("compression", "zstd").parquet(path)
    saved = spark.read.schema(schema).parquet(path)
    blocks = saved.where(F.col("codes").isNotNull()).select("block", "ids", "lengths", "codes")
    words = saved.where(F.col("term").isNotNull()).select("block", "term")
    tasks = max(1, blocks.select("block").count())
    norms = normalize_terms(words, lemmas=lemmas).select("term", "norm")
    # a word has one row a block, so none is hot
    dealt = words.join(norms, "term").unionByName(blocks, allowMissingColumns=True).repartition(tasks, "block").sortWithinPartitions("block", F.col("codes").isNotNull(), "term")
    result = StructType([StructField("id", kind), StructField("term", StringType()), StructField("tf", LongType())])
    return dealt.mapInArrow(_norm_counter(sorted(set(grams)), sep), result).select("id.*", "term", "tf")
