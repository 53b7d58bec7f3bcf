"""The source divergence audit against brute force and DuckDB."""

import collections
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from bayesmill.llm import divergence


def brute(rows, least=3, top=200):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = set()
    for lang in {x[0] for x in terms}:
        docs, group = collections.Counter(), collections.defaultdict(collections.Counter)
        for one, source, words in terms:
            if one == lang:
                docs.update(set(words))
                group[source].update(words)
        kept = [t for t, n in docs.items() if n >= least]
        every = collections.Counter({t: sum(g[t] for g in group.values()) for t in kept})
        p = {s: {t: 1 + 10**9 * (g[t] + 1) // (sum(g[x] for x in kept) + len(kept)) for t in kept} for s, g in group.items()}
        q = {t: 1 + 10**9 * (every[t] + 1) // (sum(every.values()) + len(kept)) for t in kept}
        for s in group:
            pairs = {h: sum((p[s][t] - p[h][t]) ** 2 // p[h][t] for t in kept) for h in group if h != s}
            single = {t: (p[s][t] - q[t]) ** 2 // q[t] for t in kept if group[s][t] and p[s][t] > q[t]}
            for part, values, most in (("pair", pairs, None), ("term", single, top)):
                ranked = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, v, n) for n, (item, v) in enumerate(ranked, 1)}
    return out


def rows_of(n, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}é" for k in range(100)]
    out = []
    for i in range(n):
        source = f"s{min(int(rng.exponential(2)), 6)}"
        picked = rng.choice(words, rng.integers(0, 40), p=None if i % 3 else np.arange(1, 101) / 5050)
        out.append((["en", "de", None][i % 3], source, "; ".join(picked).title() if i % 5 else " ".join(picked)))
    return [*out, ("xx", "only", "a b c"), ("yy", "s1", None), ("yy", "s2", "-- 12 --"), (None, None, None), ("", "", "wakeé"), ("en", "none", "")]


@pytest.mark.parametrize("cells", [1 << 16, 40])
def test_audit(spark, cells, monkeypatch):
    monkeypatch.setattr(divergence, "SPREAD", 0)
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 4)
    rows = rows_of(300)
    table = spark.createDataFrame([(a, b, c, 1, "z") for a, b, c in rows], "lang string, source string, text string, n int, term string").repartition(5)
    got = {tuple(r) for r in divergence.audit(table, cells=cells, top=20).collect()}
    assert got == brute(rows, top=20)
    assert divergence.audit(table.limit(0)).count() == 0


def test_sql(spark):
    rows = rows_of(200, 4)
    documents = pd.DataFrame(rows, columns=["lang", "source", "text"])  # noqa: F841
    told = {tuple(r) for r in duckdb.sql(divergence.SQL).fetchall()}
    assert told == brute(rows) == {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, "lang string, source string, text string")).collect()}


def test_equal_subtrees_are_one():
    counts = np.zeros((40, 1024), np.int64)
    counts[:, :8] = np.arange(320).reshape(40, 8)
    forest = divergence.Forest(counts)
    assert sum(len(left) for left, _ in forest.levels) < 40 * (4 + 2 + 1 + 7) + 20
    pair, a, b, often = forest.walk(np.array([0]), np.array([1]))
    assert len(pair) == 9 and often.sum() == 1024 and often.max() == 1016 and set(zip(a.tolist(), b.tolist())) == {(0, 0), *((k, k + 8) for k in range(8))}


def test_frequencies_beyond_64_bits():
    big = np.array([0, 10**13], np.int64)
    assert divergence.frequencies(big, np.array([10**14] * 2)).tolist() == [1 + 10**9 // 10**14, 1 + 10**9 * (10**13 + 1) // 10**14]
