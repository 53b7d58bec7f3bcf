"""Toxicity by a linear-chain conditional random field: tokens are tagged clean (0) or toxic (1), marginals score documents.

Training, on a bounded sample of labelled documents (parameters below): words and word beginnings that stand in toxic
documents far more often than in clean ones (by a binomial tail) label the tokens of toxic
documents; tokens of clean documents are clean. The field has features of each token (the word, its beginnings and its
end) and the four transitions; its likelihood's gradient comes from forward-backward marginals. A logistic curve from
the sum of the marginals' cubes to the documents' labels, fitted on the same sample, gives the score; cubes keep many faint marginals of a long text from adding up.

Scoring reads each whole text once, in its scan task: forward-backward over all tokens, in step over the documents of a
slice. The model is a table of WEIGHTS floats, so what travels to the tasks has a fixed size.

Defined results: null, empty and wordless texts get the score of no toxic token, null labels and labels of unknown
documents are not used, a table without labels of both kinds gives score 0 everywhere, repeated rows score alike,
empty tables give no rows; labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayesmill.llm.common import free_name, schema_of

# Bounds of the training sample: toxic documents (and twice as many clean ones), and bytes of a text that is taken.
# The sample's copies count once; the field itself is fitted on so many of the toxic ones and twice as many clean ones.
SAMPLE_DOCS = 3000
FIELD_DOCS = 800
SAMPLE_BYTES = 32_768
# The token labeller: a word or beginning marks tokens if at least this share of its documents is toxic (both labels
# weighing the same), and if over all candidates this many such finds, or fewer, are expected by chance.
MARK_SHARE = 0.97
MARK_CHANCE = 0.5
WEIGHTS = 1 << 18
STRETCH = 64  # tokens of a training stretch
ROUNDS = 60
SLICE_TOKENS = 400_000
REMEMBERED_WORDS = 200_000
HELD_OUT = 5  # documents whose crc32 of the id is divisible by this are held out

# Fixed value: tokens are runs of ASCII letters, digits and bytes beyond ASCII; A-Z is read as a-z.
_IN_TOKEN = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TOKEN_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _IN_TOKEN else 0x20 for b in range(256))
_TOKEN = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def tokens_of(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(_TOKEN_BYTES).split()


def beginnings(w: bytes) -> list[bytes]:
    return [w[:k] for k in (4, 5, 6) if len(w) > k]


def features(w: bytes) -> list[int]:
    """Places of a token's features in the table of weights; place 0 is the bias."""
    named = [b"w" + w, *[b"b" + p for p in beginnings(w)], b"b3" + w[:3], b"e" + w[-3:], b"l%d" % min(len(w), 12)]
    return [0, *[1 + zlib.crc32(f) % (WEIGHTS - 1) for f in named]]


@dataclass(frozen=True)
class Field:
    """Weights of the features (for tag 1 against tag 0), odds of the moves between tags, and the documents' curve."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float
    shift: float

    def score(self, strength: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(10 * strength) + self.shift, -40, 40)))


class Potentials(dict):
    """Word -> exp of its summed weights."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, w: bytes) -> float:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        v = self[w] = math.exp(min(25.0, max(-25.0, float(self.weights[features(w)].sum()))))
        return v


def marginals(e: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(tag 1) of each token of many sequences laid end to end; ``e``: exp of the token's weight, ``moves``: 2 x 2 odds.

    Only the ratio of tag 1 to tag 0 is carried, forward and backward; all sequences step together, the longest first
    in the array, so that those still running are always its head.
    """
    (a00, a01), (a10, a11) = moves
    order = np.argsort(-sizes, kind="stable")
    start, size = (np.concatenate(([0], np.cumsum(sizes)[:-1])))[order], sizes[order]
    running = len(size) - np.searchsorted(size[::-1], np.arange(1, (size[0] if len(size) else 0) + 1))
    ahead, back = np.empty(len(e)), np.ones(len(e))
    r = np.empty(0)
    for t, n in enumerate(running.tolist()):
        at = start[:n] + t
        r = e[at] if t == 0 else e[at] * (a01 + r[:n] * a11) / (a00 + r[:n] * a10)
        ahead[at] = r
    for t in range(len(running) - 2, -1, -1):
        at = start[:running[t + 1]] + t
        x = e[at + 1] * back[at + 1]
        back[at] = (a10 + a11 * x) / (a00 + a01 * x)
    odds = ahead * back
    return odds / (1 + odds)


def marks(docs: list[tuple[list[bytes], int]]) -> set[bytes]:
    """Words and beginnings (with a trailing ``*``) that mark toxic tokens."""
    n = Counter(label for _, label in docs)
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for words, label in docs:
        kinds = set(words)
        seen[label].update(kinds | {p + b"*" for w in kinds for p in beginnings(w)})
    rate, out = n[1] / (n[0] + n[1]), set()
    tried = math.log(max(1, len(seen[1])))
    for k, t in seen[1].items():
        c = seen[0][k]
        chance = math.lgamma(t + c + 1) - math.lgamma(t + 1) - math.lgamma(c + 1) + t * math.log(rate) + c * math.log(1 - rate)
        if chance + tried < math.log(MARK_CHANCE) and t / (t + c * rate / (1 - rate)) >= MARK_SHARE:
            out.add(k)
    return out


def without_copies(docs: list[tuple[list[bytes], int]], hashes: int = 8, n: int = 3) -> list[tuple[list[bytes], int]]:
    """One document of each group whose members share a min-hash of their word n-grams and the label.

    Copies would make chance words of one toxic document look like marks that many documents share.
    """
    met: set[tuple] = set()
    out = []
    salts = np.arange(1, hashes + 1, dtype=np.uint32) * np.uint32(0x9E3779B1)
    for words, label in docs:
        grams = {zlib.crc32(b" ".join(words[i:i + n])) for i in range(max(1, len(words) - n + 1))}
        x = np.fromiter(grams, np.uint32, len(grams))[:, None] ^ salts
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        least = [(label, k, v) for k, v in enumerate(((x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)).min(0).tolist())]
        if not met.intersection(least):
            out.append((words, label))
        met.update(least)
    return out


def fit(docs: list[tuple[list[bytes], int]], field_docs: int = FIELD_DOCS) -> Field | None:
    """A field from labelled documents (tokens, label); None unless both labels are there."""
    docs = without_copies([(w, y) for w, y in docs if w])
    if len({y for _, y in docs}) < 2:
        return None
    marking = marks(docs)
    docs = [d for y in (0, 1) for d in [d for d in docs if d[1] == y][:field_docs * (2 - y)]]
    kinds = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in docs for w in words))}
    toxic_kind = np.array([w in marking or any(p + b"*" in marking for p in beginnings(w)) for w in kinds])
    rows = [features(w) for w in kinds]
    place, kind_of = np.array([p for r in rows for p in r]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    kind = np.array([kinds[w] for words, _ in docs for w in words])
    sizes = np.array([len(words) for words, _ in docs])
    toxic = np.repeat(np.array([y for _, y in docs]), sizes).astype(bool)
    tag = (toxic_kind[kind] & toxic).astype(float)
    stretches = np.concatenate([np.full(n // STRETCH, STRETCH) if n % STRETCH == 0 else np.append(np.full(n // STRETCH, STRETCH), n % STRETCH) for n in sizes])
    inner = np.ones(len(kind), bool)  # whether a token has a token of its stretch before it
    inner[np.concatenate(([0], np.cumsum(stretches)[:-1]))] = False
    pair = np.flatnonzero(inner)
    told = np.array([[((1 - tag[pair - 1]) * (1 - tag[pair])).sum(), ((1 - tag[pair - 1]) * tag[pair]).sum()],
                     [(tag[pair - 1] * (1 - tag[pair])).sum(), (tag[pair - 1] * tag[pair]).sum()]])
    weights, moves = np.zeros(WEIGHTS), np.zeros((2, 2))
    speed_w, speed_m = np.full(WEIGHTS, 1e-6), np.full((2, 2), 1e-6)
    for _ in range(ROUNDS):
        e = np.exp(np.clip(np.bincount(kind_of, weights[place], len(rows)), -25, 25))[kind]
        odds = np.exp(moves)
        p = marginals(e, stretches, odds)
        g = np.bincount(place, np.bincount(kind, p - tag, len(rows))[kind_of], WEIGHTS) / len(docs) + 1e-4 * weights
        # expected moves, by the product of neighbouring marginals reweighted with the moves' odds
        before, now = p[pair - 1], p[pair]
        joint = np.stack([(1 - before) * (1 - now) * odds[0, 0], (1 - before) * now * odds[0, 1], before * (1 - now) * odds[1, 0], before * now * odds[1, 1]])
        gm = ((joint / joint.sum(0)).sum(1).reshape(2, 2) - told) / len(docs) + 1e-3 * moves
        speed_w += g * g
        speed_m += gm * gm
        weights -= 0.5 * g / np.sqrt(speed_w)
        moves -= 0.1 * gm / np.sqrt(speed_m)
    e = np.exp(np.clip(np.bincount(kind_of, weights[place], len(rows)), -25, 25))[kind]
    strength = np.add.reduceat(marginals(e, sizes, np.exp(moves)) ** 3, np.concatenate(([0], np.cumsum(sizes)[:-1])))
    slope, shift = _curve(np.log1p(10 * strength), np.array([y for _, y in docs], float))
    return Field(weights.astype(np.float32), np.exp(moves), slope, shift)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x by Newton's steps, slightly ridged, both labels weighing the same."""
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + 1e-4 * beta
        beta -= np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2), gradient)
    return float(beta[0]), float(beta[1])


def held_out(doc_id: str = "doc_id"):
    """Whether a document is held out; one without id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field | None:
    """The field, from at most ``sample_docs`` toxic documents and twice as many clean ones; held-out documents' labels are never read."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = [usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs * (2 - y)) for y in (0, 1)]
    picked = F.broadcast(by_hash[0].unionByName(by_hash[1]))  # 3 * sample_docs rows at most
    sample = docs.select("doc_id", "text").join(picked, "doc_id").where(F.octet_length("text") <= SAMPLE_BYTES)
    one_each = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for r in one_each.toLocalIterator())
    return fit([(tokens_of(t.encode("utf-8", "surrogatepass")), y) for _, t, y in rows])


def _slices(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    part, n = [], 0
    for t in texts:
        part.append(tokens_of(t))
        n += len(part[-1])
        if n >= SLICE_TOKENS:
            yield part
            part, n = [], 0
    if part:
        yield part


def toxic_spans(text: str, tags: np.ndarray) -> list[tuple[int, int]]:
    """Start and end (code points) of runs of toxic tokens."""
    spans: list[tuple[int, int]] = []
    for i, m in enumerate(_TOKEN.finditer(text)):
        if tags[i]:
            if spans and i and tags[i - 1]:
                spans[-1] = (spans[-1][0], m.end())
            else:
                spans.append((m.start(), m.end()))
    return spans


def _scorer(field: Field | None, added: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        potentials = Potentials(field.weights) if field else None
        for b in batches:
            raw = b.column("text").cast(pa.binary()).to_pylist()
            scores, expected, spans = [], [], []
            for words in _slices(raw) if field else ():
                sizes = np.array([len(w) for w in words])
                flat = [w for part in words for w in part]
                p = marginals(np.fromiter(map(potentials.__getitem__, flat), float, len(flat)), sizes, field.moves)
                ends = np.cumsum(sizes)
                of_doc = np.repeat(np.arange(len(words)), sizes)
                expected += np.bincount(of_doc, p, len(words)).tolist()
                scores += field.score(np.bincount(of_doc, p ** 3, len(words))).tolist()
                hit = np.zeros(len(words), bool)
                hit[np.searchsorted(ends, np.flatnonzero(p >= 0.5), side="right")] = True
                for k in range(len(words)):
                    text = raw[len(spans)]
                    found = toxic_spans(text.decode("utf-8", "replace"), p[ends[k] - sizes[k]:ends[k]] >= 0.5) if hit[k] else []
                    spans.append([x for s in found for x in s])
            if not field:
                scores, expected, spans = [0.0] * len(raw), [0.0] * len(raw), [[]] * len(raw)
            cols = [pa.array(scores, pa.float64()), pa.array(expected, pa.float64()), pa.array(spans, pa.list_(pa.int32()))]
            kept = [b.column(c) for c in b.schema.names]
            yield pa.RecordBatch.from_arrays([*kept, *cols], names=[*b.schema.names, *added])

    return run


def score(docs: DataFrame, field: Field | None, added: tuple[str, str, str] = ("score", "expected", "spans")) -> DataFrame:
    """``docs`` (which has ``text``) with three more columns: score, expected toxic tokens, and spans (start, end, ...; code points).
    Columns of these names are replaced."""
    docs, (score, expected, spans) = docs.drop(*added), added
    return docs.mapInArrow(_scorer(field, added), f"{schema_of(docs)}, `{score}` double, `{expected}` double, `{spans}` array<int>")


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with their columns."""
    added = tuple(free_name(docs, n) for n in ("toxic_score", "toxic_tokens", "toxic_spans"))
    return score(docs, train(docs, labels), added).where(F.col(added[0]) < limit).select(*docs.columns)
