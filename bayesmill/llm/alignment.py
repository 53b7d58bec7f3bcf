"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, by galloping intersection of their end offsets.

A scan task tokenizes whole texts with both tokenizers and sums the tokens' byte lengths into rising end offsets. The
shorter list of ends drives: each value is sought in the longer list from where an earlier one was found, in steps that
double until they pass it, then by bisection between the last two steps. Many values do so in lock step: first every
STRIDE^k-th one, then those between, each from its predecessor's place. Equal ends are the common indices; they slice
the tokens into groups, and the differences of neighbouring indices are the ranges of A and B tokens that overlap.

The link of a group is its last A token with its last B token. Texts are told in chunks of about CHUNK_TOKENS tokens:
a row a document with its distinct links (places in the chunk's list, and how often), and a row a distinct link of the
chunk. Links add up over the corpus by id pair, come back to the chunks by pair (so a pair is one row a chunk, however
frequent), and meet the chunk's documents again by chunk.

Defined results: null and empty texts, and texts that a tokenizer's tokens don't give back byte by byte, have no tokens
(zeros, groups_sha256 ''); repeated rows count each; a null doc_id passes; an empty table gives no rows; other columns
are not read. A text must fit a task.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bayesmill.llm.common import saved, worker_memory

STRIDE = 32
CHUNK_TOKENS = 400_000

# Bytes of Latin-1 that are parted alike by every version of the character tables: no control characters but tab and
# line breaks, no non-breaking space.
_PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])


# Fixed value: the pattern that parts a text before the byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters are their own byte, the others follow from 256 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(other)}}


class ByteLevelTokenizer:
    """Ids of a byte-level BPE given as the text of its JSON file, and each id's bytes.

    Plain texts go through the same merges in a faster library, if every entry of the vocabulary is one token there
    and here, as both then merge alike; all others to the tokenizer itself.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True
        letters, spec = byte_letters(), json.loads(model)
        special = {t["id"] for t in spec.get("added_tokens", [])}
        vocab = {i: t for t, i in spec["model"]["vocab"].items()}
        self.bytes = [b""] * (max([*vocab, *special]) + 1)
        for i, t in vocab.items():
            self.bytes[i] = t.encode() if i in special else bytes(letters[c] for c in t)
        self.fast = self._fast(vocab, special)

    def _fast(self, vocab: dict[int, str], special: set[int]):
        import tiktoken

        entries = {i: t for i, t in vocab.items() if i not in special}
        merged = self.tokenizer.model.tokenize
        if any([x.id for x in merged(t)] != [i] for i, t in entries.items()):
            return None
        return tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks={self.bytes[i]: i for i in entries}, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        try:
            plain = self.fast is not None and not text.encode("latin-1").translate(None, _PLAIN)
        except UnicodeEncodeError:
            plain = False
        ids = self.fast.encode_ordinary(text) if plain else self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.int64)


class PieceTokenizer:
    """Ids of a sentence-piece model given as its file's bytes, and each id's bytes."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        self.bytes = [self._bytes(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]

    @staticmethod
    def _bytes(piece: str) -> bytes:
        code = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(code[1], 16)]) if code else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


def gallop(values: np.ndarray, into: np.ndarray) -> np.ndarray:
    """For each of the rising ``values`` the first place in the rising ``into`` whose entry is not below it."""
    strides = [1]
    while strides[-1] * STRIDE < len(values):
        strides.append(strides[-1] * STRIDE)
    at = np.zeros(1, np.int64)
    for stride in reversed(strides):
        sought = values[::stride]
        low = np.repeat(at, STRIDE if len(at) < len(sought) else 1)[:len(sought)]
        high, step = low.copy(), 1
        live = np.arange(len(sought))
        while len(live):  # the step that passes the value ends its search
            here = high[live]
            live = live[(here < len(into)) & (into[np.minimum(here, len(into) - 1)] < sought[live])]
            low[live] = high[live] + 1
            high[live] += step
            step *= 2
        np.minimum(high, len(into), out=high)
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) // 2
            below = into[middle] < sought[live]
            low[live[below]], high[live[~below]] = middle[below] + 1, middle[~below]
            live = live[low[live] < high[live]]
        at = low
    return at


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values that two rising arrays share, in each; the shorter one drives."""
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    drive, other = (a, b) if len(a) <= len(b) else (b, a)
    at = gallop(drive, other)
    mine = np.flatnonzero((at < len(other)) & (other[np.minimum(at, len(other) - 1)] == drive))
    return (mine, at[mine]) if len(a) <= len(b) else (at[mine], mine)


class Aligner:
    """Both tokenizers with their tables by id."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.length_a, self.length_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        told = lambda t, marks: np.array([f"{i}{m}".encode() for i in range(len(t.bytes)) for m in marks], object)
        self.told_a, self.told_b = told(a, (",", "|")), told(b, (",", ";", ""))

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B, or none if either does not give the bytes back."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        raw, a, b = (" " + text).encode("utf-8", "surrogatepass"), self.a.ids(" " + text), self.b.ids(text)
        same = all(b"".join(map(t.bytes.__getitem__, ids.tolist())) == raw for t, ids in ((self.a, a), (self.b, b)))
        return (a, b) if same else (none, none)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last A and B token of each group, for the tokens of one text or of several in a row."""
        return common_ends(np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]))

    def written(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
        """The parts of ``a1,a2|b1;a3|b2,b3`` in order; ``text_ends``: tokens of B up to the end of each text."""
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        ends_b[text_ends[text_ends > 0] - 1] = 2
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b > 0) - (ends_b > 0)
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.concatenate(([0], last_b + 1))[group_a]] = self.told_a[2 * a + ends_a]
        out[np.arange(len(b)) + (last_a + 1)[group_b]] = self.told_b[3 * b + ends_b]
        return out


DOC, LINK = 0, 1
_FIELDS = (("kind", pa.int32()), ("chunk", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
           ("places", pa.binary()), ("times", pa.binary()), ("place", pa.int32()), ("pair", pa.int64()), ("n", pa.int64()))
_ROWS = "kind int, chunk long, n_a long, n_b long, n_groups long, groups_sha256 string, places binary, times binary, place int, pair long, n long"


def _rows(kind: int, chunk: int, ids: pa.Array, **given) -> pa.RecordBatch:
    size = len(ids)
    cols = {"kind": np.full(size, kind, np.int32), "chunk": np.full(size, chunk, np.int64), **given}
    arrays = [ids, *(pa.array(cols[k], t) if k in cols else pa.nulls(size, t) for k, t in _FIELDS)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(k for k, _ in _FIELDS)])


def _chunk(aligner: Aligner, chunk: int, ids: pa.Array, tokens: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    n_a, n_b = (np.array([len(t[i]) for t in tokens], np.int64) for i in (0, 1))
    a, b = (np.concatenate([t[i] for t in tokens]) for i in (0, 1))
    ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
    last_a, last_b = aligner.groups(a, b)  # a text's end is common, so no group reaches over it
    owner = np.searchsorted(ends_a, last_a, side="right")
    n_groups = np.bincount(owner, minlength=len(tokens))
    parts = aligner.written(a, b, last_a, last_b, ends_b)
    at = np.concatenate(([0], ends_a + ends_b)).tolist()
    told = [hashlib.sha256(b"".join(parts[s:e].tolist())).hexdigest() if s < e else "" for s, e in zip(at, at[1:], strict=False)]

    pairs, place, n = np.unique(a[last_a] << 32 | b[last_b], return_inverse=True, return_counts=True)
    held, times = np.unique(owner * max(1, len(pairs)) + place, return_counts=True)
    cut = np.searchsorted(held, np.arange(1, len(tokens)) * max(1, len(pairs)))
    places = [x.astype("<u4").tobytes() for x in np.split(held % max(1, len(pairs)), cut)]
    yield _rows(DOC, chunk, ids, n_a=n_a, n_b=n_b, n_groups=n_groups, groups_sha256=told, places=places, times=[x.astype("<u4").tobytes() for x in np.split(times, cut)])
    if len(pairs):
        yield _rows(LINK, chunk, pa.nulls(len(pairs), ids.type), place=np.arange(len(pairs), dtype=np.int32), pair=pairs, n=n)


def _scan(model_a: str, model_b: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_memory(f"aligner {zlib.crc32(model_a.encode())} {zlib.crc32(model_b)}", lambda: Aligner(ByteLevelTokenizer(model_a), PieceTokenizer(model_b)))
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            first, tokens, held = 0, [], 0
            for i, text in enumerate(batch.column("text").to_pylist(), 1):
                tokens.append(aligner.tokens(text))
                held += len(tokens[-1][0]) + len(tokens[-1][1])
                if held >= CHUNK_TOKENS or i == batch.num_rows:
                    yield from _chunk(aligner, chunk, batch.column("doc_id").slice(first, len(tokens)), tokens)
                    first, tokens, held, chunk = i, [], 0, chunk + 1

    return run


RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(docs: pa.Table, links: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums over their links, which ``links`` tells by place."""
    total, best = np.zeros(links.num_rows, np.int64), np.zeros(links.num_rows, np.int64)
    place = links.column("place").to_numpy()
    total[place], best[place] = links.column("total").to_numpy(), links.column("best").to_numpy()
    n_best, count_sum = [], []
    for at, times in zip(docs.column("places").to_pylist(), docs.column("times").to_pylist(), strict=True):
        at, times = np.frombuffer(at, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
        n_best.append(int((best[at] * times).sum()))
        count_sum.append(int((total[at] * times).sum()))
    given = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")}
    return pa.table({**given, "n_links": docs.column("n_groups"), "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()), "groups_sha256": docs.column("groups_sha256")})


def align(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    The files' contents travel to the tasks: executors need no copy.
    """
    with open(byte_level_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        model_a, model_b = f.read(), g.read()
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    told = saved(texts.mapInArrow(_scan(model_a, model_b), f"doc_id {kind}, {_ROWS}"), "alignment")
    links = told.where(F.col("kind") == LINK).select("chunk", "place", "pair", "n")
    totals = links.groupBy("pair").agg(F.sum("n").alias("total"))
    ranked = totals.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))  # as many rows of one b as A has ids, at most
    most = F.max("total").over(Window.partitionBy("b"))
    counted = ranked.select("pair", "total", (F.col("total") == most).cast("int").alias("best"))
    known = links.select("chunk", "place", "pair").join(counted, "pair").select(F.col("chunk").alias("of"), "place", "total", "best")
    rows = told.where(F.col("kind") == DOC).select("doc_id", "chunk", "n_a", "n_b", "n_groups", "groups_sha256", "places", "times")
    return rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_scored, f"doc_id {kind}, {RESULT}")
