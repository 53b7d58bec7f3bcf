"""Benchmark decontamination: a prefix-filtered set join of documents with item-sized windows of benchmark items.

A window is WINDOW consecutive words of an item (the whole item if it has fewer). A document holds a window only if
it holds all of its words, so the necessary prefix of a window is one word: its rarest, by the documents' own counts.
Each document word is looked up among these prefix words; a hit fixes where the window would have to lie (position of
the word in the window), which gives the positional and length bounds; what is left is verified word by word.

Documents are read twice (counts of the benchmark's words, then the join) and never shuffled. Windows are held in
blocks of at most ``block_windows``; a larger benchmark takes a pass over the documents for each block, so memory has
a bound and no window is left out.

Defined results: null or wordless texts have no words and hit nothing, wordless items have no windows, repeated items
and documents each count, empty tables give no hits or no rows, other columns of the documents are dropped by
``contamination`` and returned by ``without_benchmark``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayesmill.llm.common import saved, schema_of

WINDOW = 10
BLOCK_WINDOWS = 500_000

# Fixed value: words are runs of digits, letters and bytes beyond ASCII; A-Z is read as a-z.
_IN_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _IN_WORD else 0x20 for b in range(256))


def words_of(text: str | bytes | None) -> list[bytes]:
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_WORD_BYTES).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    k = min(window, len(words))
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


class PrefixIndex:
    """Windows by their rarest word: word -> {(position in the window, window's length)}, and window -> item ids."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], counts: dict[bytes, int], window: int = WINDOW):
        self.items: dict[tuple[bytes, ...], list[str]] = {}
        self.at: dict[bytes, set[tuple[int, int]]] = {}
        for item, words in items:
            for w in windows_of(words, window):
                owners = self.items.setdefault(w, [])
                if not owners:
                    p = min(range(len(w)), key=lambda i: (counts.get(w[i], 0), w[i]))
                    self.at.setdefault(w[p], set()).add((p, len(w)))
                if not owners or owners[-1] != item:
                    owners.append(item)

    def find(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Starts and ends of the windows that occur, flat, and their items."""
        spans, found, n, at, items = [], set(), len(words), self.at, self.items
        for q in [q for q, w in enumerate(words) if w in at]:
            for p, k in at[words[q]]:
                s = q - p
                if s < 0 or s + k > n:
                    continue
                owners = items.get(tuple(words[s:s + k]))
                if owners:
                    spans += (s, s + k)
                    found.update(owners)
        return spans, found


def covered(spans: list[int]) -> int:
    """Words inside the union of the spans (start, end, start, end, ...)."""
    total, end = 0, -1
    for s, e in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, e - max(s, end))
        end = max(end, e)
    return total


def _counter(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                n.update(vocabulary.intersection(words_of(t)))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    return run


def _joiner(index: PrefixIndex, last: bool, carried: list[str], state: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, spans_out, items_out = [], [], []
            for t, spans, found in zip(b.column("text").cast(pa.binary()).to_pylist(), *(b.column(c).to_pylist() for c in state), strict=True):
                words = words_of(t)
                s, f = index.find(words)
                n_words.append(len(words))
                spans_out.append([*spans, *s] if spans else s)
                items_out.append(sorted({*found, *f}) if found else sorted(f))
            cols = [b.column(c) for c in carried]
            cols.append(pa.array(spans_out, pa.list_(pa.int32())))
            cols.append(pa.array(items_out, pa.list_(pa.string())))
            names = [*carried, *state]
            if last:
                cols += [pa.array(n_words, pa.int64()), pa.array(map(covered, spans_out), pa.int64())]
                names += ["n_words", "n_hit"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _joined(docs: DataFrame, benchmark: DataFrame, carry: DataFrame, state: tuple[str, str], window: int, block_windows: int) -> DataFrame:
    """The columns of ``carry`` (a selection of ``docs``) with the two state columns (spans, items), ``n_words, n_hit``."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.size(F.split(F.col("text"), "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = max(1, -(-size // block_windows))
    kept = docs.withColumns({state[0]: F.array().cast("array<int>"), state[1]: F.array().cast("array<string>")})
    for block in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        listed = [(r["item_id"] or "", words_of(r["text"])) for r in mine.toLocalIterator()]  # about block_windows words
        vocabulary = frozenset(w for _, words in listed for w in words)
        counted = docs.select("text").mapInArrow(_counter(vocabulary), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        counts = {bytes(r["word"]): r["n"] for r in counted.toLocalIterator()}  # the block's own words at most
        last = block == blocks - 1
        out = carry if last else docs
        schema = f"{schema_of(out)}, `{state[0]}` array<int>, `{state[1]}` array<string>" + ", n_words long, n_hit long" * last
        kept = kept.mapInArrow(_joiner(PrefixIndex(listed, counts, window), last, out.columns, state), schema)
        if not last:
            kept = saved(kept, "contamination")
    return kept


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``doc_id, spans, items array<string>, n_words, n_hit``: word spans of the hits (start, end, ...), and the sorted
    ids of the items with windows in the document."""
    texts = docs.select("doc_id", "text")
    return _joined(texts, benchmark, texts.select("doc_id"), ("spans", "items"), window, block_windows)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that no window hits, with their columns."""
    clear = docs.toDF(*[f"c{i}_{c}" if c != "text" else c for i, c in enumerate(docs.columns)])  # no clash with added names
    found = _joined(clear, benchmark, clear, ("spans", "items"), window, BLOCK_WINDOWS)
    return found.where(F.col("n_hit") == 0).select(*clear.columns).toDF(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    """The columns that the query returns."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
