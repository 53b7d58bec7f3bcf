"""Lexical retrieval packing: a sharded BM25 index returns unused neighbours for each seed document, which fill its window.

Texts are tokenized once into a saved table (by the distinct words of many texts, as white space always parts tokens;
ids take two bytes). The same tasks count the documents of each token: a table that the vocabulary bounds.
A document's key is KEYS of its tokens, each chosen as the least of hashes that weigh tokens by idf (weighted min-hash):
two documents choose the same one as often as they share tokens by weight. The table is shuffled into ranges of the key,
so a shard (about SHARD_TOKENS ids) holds documents of like words from all over the table, whatever the files' order and
splits; a table of up to SHARD_TOKENS ids is one shard. In a shard, all tokens of a seed query the inverted index; the
best unused documents follow the seed in its window. The one that no longer fits is cut, and its rest is the next seed;
so every window but the shard's last is full. What is left at the end is cut at powers of two, which are not padded.

Limit: a seed is compared with its own shard only, so a neighbour whose key lies in another range is not found (README
has the measured share).

Defined results: a null or empty text is only its end token, repeated rows are packed each, an empty table gives no
rows, documents longer than a window are cut, documents that share no token with a seed follow in the key's order.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bayesmill.llm.alignment import byte_letters
from bayesmill.llm.common import forget, saved, worker_memory

WINDOW = 4096
END = 2
K1, B = 1.2, 0.75
NEIGHBOURS = 24  # of a retrieval; a window that needs more retrieves again
SHARD_TOKENS = 1_500_000
KEYS = 4  # 16-bit ids that fill a long
REMEMBERED_WORDS = 400_000  # where the tokenizer gets each word
SLICE_BYTES = 1 << 25  # of text whose distinct words are told apart at once
PIECES = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

# Latin-1 for which parting at white space and lower-casing agree everywhere: no control characters but tab and line
# breaks, no non-breaking space.
_PLAIN = "\t\n\r -~\xa1-\xff"
_BEYOND = rf"<\||[^{_PLAIN}]"  # a text with a match goes to the tokenizer whole: "<|" may begin a special token

# How the tokenizer parts a lower-case word of these characters (letters, single digits, and marks in a row).
_LETTERS, _DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = f"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+)"
_PIECE_END = "\x01"  # in no plain text: stands for the mark of a piece's end


class WordIds:
    """Texts -> their ids as bytes, by way of the distinct words of many texts.

    A word is parted as the tokenizer parts it. All pieces of all new words go through the same merges in a faster library
    with one call (their characters and a last one for the piece's end), as long as it agrees on a few words, on every
    plain character and on every entry that ends a piece; otherwise the tokenizer gets each word.
    """

    def __init__(self, tokenizer: Tokenizer):
        import tiktoken

        self.tokenizer, self.kept, letters, end = tokenizer, {}, byte_letters(), _PIECE_END.encode()
        special = set(tokenizer.get_added_tokens_decoder())
        ranks, entries = {}, [(t, i) for t, i in tokenizer.get_vocab().items() if i not in special]
        for token, i in entries:
            body = token.removesuffix("</w>")
            ranks[bytes(letters[c] for c in body) + (end if body != token else b"")] = i
        last = {b: i for b, i in ranks.items() if len(b) > 1 and b.endswith(end)}
        self.ends = np.zeros(1 << 16, bool)
        self.ends[list(last.values())] = True
        self.merge = tiktoken.Encoding("pieces", pat_str=f"[^{_PIECE_END}]+{_PIECE_END}", mergeable_ranks=ranks, special_tokens={})
        plain = [chr(c) for c in range(0x21, 0x100) if not 0x7F <= c <= 0xA0]
        # a piece's last byte meets the end before any other merge, so that each piece has one entry that ends it
        ending = [last.get(bytes([b]) + end, 1 << 16) for b in set("".join(plain).encode())]
        longer = [i for b, i in ranks.items() if len(b) > 1 and not (len(b) == 2 and b in last)]
        self.direct = len(ranks) == len(entries) and max(ending) < min(longer, default=1 << 16)
        if self.direct:
            words = ["the", "internationalizing", "straße", "naïvetéñ", "qzxjkv", "ÿþð", "!?", "Isn't", "A1-b22...", *plain]
            self.direct = self._merged(pa.array(words)).to_pylist() == [self._any(w) for w in words] and all(
                self.merge._encode_single_piece(b) == [i] for b, i in last.items())

    def _any(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _remembered(self, word: str) -> bytes:
        v = self.kept.get(word)
        if v is None:
            v = self._any(word)
            if len(self.kept) < REMEMBERED_WORDS:  # frequent words come early, so what is kept stays
                self.kept[word] = v
        return v

    def _merged(self, words: pa.Array) -> pa.Array:
        marked = pc.replace_substring_regex(pc.utf8_lower(words), _PIECE, rf"\1{_PIECE_END}")
        pieces = pc.count_substring(marked, _PIECE_END).to_numpy()
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), marked), "")[0].as_py()
        ids = self.merge.encode_to_numpy(text, disallowed_special=()).astype(np.uint16)
        ends = np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1))
        starts = 2 * ends[np.concatenate(([0], np.cumsum(pieces)))]
        return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(ids)])

    def of(self, texts: pa.Array) -> pa.Array:
        """Ids of whole texts. Texts beyond plain Latin-1, and texts with marks of special tokens, go to the tokenizer whole."""
        beyond = pc.match_substring_regex(texts, _BEYOND)
        words = pc.ascii_split_whitespace(pc.if_else(beyond, "", texts))
        found = words.flatten().dictionary_encode()
        new = found.dictionary
        ids = self._merged(new) if self.direct else pa.array([self._remembered(w.lower()) for w in new.to_pylist()], pa.binary())
        out = pc.binary_join(pa.ListArray.from_arrays(words.offsets, ids.take(found.indices)), b"")
        if beyond.true_count:
            out = pc.replace_with_mask(out, beyond, pa.array([self._any(t) for t in texts.filter(beyond).to_pylist()], pa.binary()))
        return out

    def whole(self, texts: pa.Array) -> pa.Array:
        """Ids of texts for tokenizers that do not part them at white space."""
        return pa.array([self._any(t) for t in texts.to_pylist()], pa.binary())


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about SLICE_BYTES of text."""
    part = np.cumsum(pc.binary_length(b.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
    return (b.slice(s, e - s) for s, e in itertools.pairwise(cuts))


def _tokenizer(model: str, by_word: bool, end: int):
    tail = pa.scalar(array("H", [end]).tobytes(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_memory(f"word ids {zlib.crc32(model.encode())}", lambda: WordIds(Tokenizer.from_str(model)))
        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker have left
        of = words.of if by_word else words.whole
        df, docs, tokens, kind = np.zeros(1 << 16, np.int64), 0, 0, None
        for b in itertools.chain.from_iterable(map(_slices, batches)):
            texts = b.column("text").cast(pa.string()).fill_null("")
            ids = pc.binary_join_element_wise(of(texts), tail, pa.scalar(b"", pa.binary()))
            for x in ids.to_pylist():
                df[np.frombuffer(x, np.uint16)] += 1  # once a document, however often it holds the id
            n = b.num_rows
            docs, tokens, kind = docs + n, tokens + (pc.sum(pc.binary_length(ids)).as_py() or 0) // 2, b.column("doc_id").type
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names=["doc_id", "ids", "term", "n"])
        if docs:
            held = np.flatnonzero(df)
            terms, n = [*held.tolist(), -1, -2], [*df[held].tolist(), docs, tokens]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(n), kind), pa.nulls(len(n), pa.binary()), pa.array(terms, pa.int32()), pa.array(n, pa.int64())], names=["doc_id", "ids", "term", "n"])

    return run


def tokenized(docs: DataFrame, tokenizer_path: str, by_word: bool = True, end: int = END) -> tuple[DataFrame, DataFrame]:
    """``doc_id, ids`` (16-bit ids in the executors' byte order, the end id last), saved, and ``term, n``: how many documents
    hold each id, as tasks counted it (-1: documents, -2: ids). ``by_word``: for tokenizers that lower-case and part every
    text at white space, as word_bpe_49k does."""
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()  # travels to the tasks: executors need no copy of the file
    if Tokenizer.from_str(model).get_vocab_size() > 1 << 16:
        raise ValueError("ids must fit 16 bits")
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    told = saved(texts.mapInArrow(_tokenizer(model, by_word, end), f"doc_id {kind}, ids binary, term int, n long"), "packing_ids")
    ids = told.where(F.col("term").isNull()).select("doc_id", "ids")
    ids.saved_path = told.saved_path
    return ids, told.where(F.col("term").isNotNull()).select("term", "n")


def _ids(b: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in b.column("ids").to_pylist()]


class Index:
    """BM25 over one shard: posting lists by token, with each document's weight for the token."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.idf, self.docs = idf, docs
        self.terms = []
        owners, weights = [], []
        for d, ids in enumerate(docs):
            terms, tf = np.unique(ids, return_counts=True)
            self.terms.append(terms)
            owners.append(np.full(len(terms), d, np.int64))
            weights.append(tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean_length)))
        flat = np.concatenate(self.terms)
        order = np.argsort(flat, kind="stable")
        self.owner, self.weight = np.concatenate(owners)[order], np.concatenate(weights)[order] * idf[flat[order]]
        self.start = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=1 << 16))))

    def drop_used(self, unused: np.ndarray) -> None:
        """Takes used documents out of the posting lists; no query returns them anyway."""
        kept = unused[self.owner]
        self.start = np.concatenate(([0], np.cumsum(kept)))[self.start]
        self.owner, self.weight = self.owner[kept], self.weight[kept]

    def neighbours(self, d: int, unused: np.ndarray) -> list[int]:
        """Unused documents by falling score (ties: in the shard's order), at most NEIGHBOURS of a positive score."""
        t = self.terms[d].astype(np.int64)
        lists = [slice(a, b) for a, b in zip(self.start[t].tolist(), self.start[t + 1].tolist(), strict=True) if a < b]
        if not lists:
            return []
        score = np.bincount(np.concatenate([self.owner[s] for s in lists]), np.concatenate([self.weight[s] for s in lists]), len(self.docs))
        score *= unused
        best = np.argpartition(-score, NEIGHBOURS)[:NEIGHBOURS] if len(score) > NEIGHBOURS else np.arange(len(score))
        best = best[score[best] > 0]
        return best[np.lexsort((best, -score[best]))].tolist()


def pack(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard; sequences are numbered from 0."""
    index, unused = Index(docs, idf, mean_length), np.ones(len(docs), bool)
    pieces, later = [], iter(range(len(docs)))
    sequence = offset = 0
    listed = len(docs)

    def place(d: int, start: int) -> int:
        """Puts as much of the document as fits; returns where its rest starts."""
        nonlocal offset
        n = min(len(docs[d]) - start, window - offset)
        pieces.append((d, start, n, sequence, offset))
        offset += n
        return start + n

    seed, start = 0, 0
    unused[0] = False
    while True:
        n_unused = np.count_nonzero(unused)
        if 4 * n_unused <= 3 * listed:
            index.drop_used(unused)
            listed = n_unused
        start = place(seed, start)
        while start == len(docs[seed]) and offset < window:  # the seed is whole: its neighbours follow
            near = index.neighbours(seed, unused)
            if not near:
                near = [d for d in [next((d for d in later if unused[d]), -1)] if d >= 0]
            if not near:
                break
            for d in near:
                unused[d] = False
                rest = place(d, 0)
                if offset == window:
                    seed, start = d, rest  # what is left of it, if anything, seeds the next window
                    break
        if offset < window and not unused.any():
            break
        sequence, offset = sequence + 1, 0
        if start == len(docs[seed]):
            seed, start = next((d for d in later if unused[d]), -1), 0
            if seed < 0:
                return pieces
            unused[seed] = False
    return _cut_tail(pieces, sequence)


def _cut_tail(pieces: list[tuple[int, int, int, int, int]], last: int) -> list[tuple[int, int, int, int, int]]:
    """Parts the last, unfilled sequence into sequences of falling powers of two."""
    tail = [p for p in pieces if p[3] == last]
    out, total, sequence, at = [p for p in pieces if p[3] != last], sum(p[2] for p in tail), last - 1, 0
    room = 0
    for d, start, n, _, _ in tail:
        while n:
            if not room:
                sequence, at, room = sequence + 1, 0, 1 << (total.bit_length() - 1)
                total -= room
            k = min(n, room)
            out.append((d, start, k, sequence, at))
            start, n, at, room = start + k, n - k, at + k, room - k
    return out


def _hashes(idf: np.ndarray, df: np.ndarray) -> np.ndarray:
    """KEYS rows of an exponential draw a token at the rate of its idf; a token of one document alone comes last."""
    draws = np.random.Generator(np.random.PCG64(7)).exponential(size=(KEYS, len(idf))).astype(np.float32)
    return draws / np.maximum(idf, 1e-6) + np.where(df < 2, np.float32(1e12), np.float32(0))


def _keyer(hashes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.empty((b.num_rows, KEYS), np.uint16)
            for i, ids in enumerate(_ids(b)):
                keys[i] = ids[hashes.take(ids, axis=1).argmin(axis=1)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(keys.astype(">u2").view(">i8").ravel().astype(np.int64))], names=["doc_id", "ids", "key"])

    return run


def _packer(idf: np.ndarray, mean_length: float, window: int, shard_tokens: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        names, docs, held = [], [], 0
        for b in batches:
            for i, ids in zip(b.column("doc_id").to_pylist(), _ids(b), strict=True):
                names.append(i)
                docs.append(ids)
                held += len(ids)
                if held >= shard_tokens:
                    yield names, docs
                    names, docs, held = [], [], 0
        if docs:
            yield names, docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        kind = None
        for names, docs in shards(batches):
            pieces = pack(docs, idf, mean_length, window)
            crc = [zlib.crc32(docs[d][s:s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
            owner, start, length, sequence, offset = (list(c) for c in zip(*pieces, strict=True))
            cols = [pa.array([names[d] for d in owner], kind), *(pa.array(c, pa.int64()) for c in (
                start, length, crc, [len(docs[d]) for d in owner], [first + s for s in sequence], offset))]
            first += sequence[-1] + 1
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    ids, told = tokenized(docs, tokenizer_path)
    counted = told.groupBy("term").agg(F.sum("n").alias("n"))
    table = {r["term"]: r["n"] for r in counted.collect()}  # the vocabulary's size at most
    n, tokens = table.pop(-1, 0), table.pop(-2, 0)
    df = np.zeros(1 << 16)
    df[list(table)] = list(table.values())
    idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = tokens / n if n else 1.0
    kind = ids.schema["doc_id"].dataType.simpleString()
    # saved, as ranges sample the keys before rows are dealt out
    keyed = saved(ids.mapInArrow(_keyer(_hashes(idf, df)), f"doc_id {kind}, ids binary, key long"), "packing_keys")
    forget(ids)
    # doc_id parts the documents of a frequent key; ranges come from a sample, so a shard may be up to twice the mean
    ranges = keyed.repartitionByRange(max(1, -(-tokens // shard_tokens)), "key", "doc_id").sortWithinPartitions("key", "doc_id", "ids")
    return ranges.select("doc_id", "ids").mapInArrow(_packer(idf, mean, window, 2 * shard_tokens), PIECES.format(kind))


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: ``tokens, padded`` (ids that fill up sequences whose length is no power of two)."""
    sums = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.lit(2.0) ** F.floor(F.log2(F.col("n").cast("double")))
    return sums.agg(F.sum("n").alias("tokens"), F.sum(F.when(F.col("n") == power, 0).otherwise(window - F.col("n"))).alias("padded"))
