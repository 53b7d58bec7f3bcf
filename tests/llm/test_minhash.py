"""MinHash near-duplicates against brute force."""

import re

import numpy as np
import pytest

from bayesmill.llm import minhash, ngrams, prefix

TABLE = "doc_id long, text string, size int, key string"


def sets_of(rows):
    sets = {}
    for i, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        k = min(4, len(w))
        sets.setdefault(i, []).append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    return sets


def brute(rows, percent=80):
    sets = sets_of(rows)
    least = {i: i for i in sets}
    similar = [(a, b) for a in sets for b in sets if a < b and any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b] if x and y)]
    changed = True
    while changed:
        changed = False
        for a, b in similar:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return sorted((i, len(s), least[i], i == least[i]) for i, all_ in sets.items() for s in all_)


def told(found):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect())


def corpus(seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for size in (1, 3, 4, 5, 9, 20, 60, 200):
        for _ in range(6):
            base = list(rng.choice(words, size))
            for copies in range(rng.integers(1, 5)):
                text = list(base)
                for _ in range(rng.integers(0, 1 + max(1, size // 18))):
                    text[rng.integers(0, size)] = f"edit{i}"
                rows.append((i, " ".join(text).title() if copies == 1 else "  ".join(text)))
                i += 1
    page = " ".join(rng.choice(words, 70))  # a template: much in common, no links
    rows += [(5000 + k, page + " " + " ".join(f"own{k}x{j}" for j in range(30))) for k in range(60)]
    base = [f"b{k}" for k in range(100)]  # a chain: neighbours are links, the ends are not
    for k in range(30):
        rows.append((6000 + k, " ".join(base)))
        base[(3 * k) % 100:(3 * k) % 100 + 3] = [f"c{k}a", f"c{k}b", f"c{k}c"]
    return [*rows, (9000, None), (9001, ""), (9002, " \t\n"), (9003, "x"), (9004, "X"), (9005, rows[40][1]), (9005, "x")]


@pytest.mark.parametrize("most, rounds", [(256, 2), (5, 0)])
def test_components(spark, monkeypatch, most, rounds):
    monkeypatch.setattr(minhash, "BEST_ROUNDS", rounds)
    rows = corpus()
    table = spark.createDataFrame([(i, t, 3, "k") for i, t in rows], TABLE).repartition(5)
    assert told(minhash.minhash_components(table, most=most)) == brute(rows)
    assert minhash.minhash_components(table.limit(0)).count() == 0


def test_null_id_stays_alone(spark):
    rows = [(None, "a b c d e"), (1, "a b c d e"), (2, "A b c d e")]
    got = minhash.minhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(None, None, True), (1, 1, True), (2, 1, False)}


def test_tests_prune_at_the_chosen_chance():
    for n, m in minhash.least_matches(80, 1e-5):
        x = np.linspace(0, 1, 20001)
        density = x ** (m - 1) * (1 - x) ** (n - m + 1) if m else np.ones_like(x)
        assert density[x >= 0.8].sum() / density.sum() < 1.05e-5
        density = x ** m * (1 - x) ** (n - m)
        assert density[x >= 0.8].sum() / density.sum() > 0.95e-5


def test_survivors_are_all_similar_pairs():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 300, np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[:300 - 6 * k], rng.integers(0, 1 << 63, 6 * k, np.uint64)])) for k in range(40)]
    signs = np.array([minhash.signature(s) for s in sets])
    i, j, matches = minhash.survivors(signs, np.array([len(s) for s in sets]), np.arange(40) // 2, 80, minhash.least_matches(80, 1e-5))
    got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    similarity = {(a, b): len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a in range(40) for b in range(a) if a // 2 != b // 2}
    assert {(b, a) for (a, b), s in similarity.items() if s >= 0.8} <= got
    assert [int((signs[a] == signs[b]).sum()) for a, b in zip(i, j)] == matches.tolist()
    assert len(got) == len(i) and not any(similarity[b, a] < 0.5 for a, b in got)
    for a in range(5):
        assert abs(np.mean(signs[a] == signs[39]) - len(np.intersect1d(sets[a], sets[39])) / len(np.union1d(sets[a], sets[39]))) < 0.15


def test_pairs_are_told_where_they_meet_first():
    keys = [np.array(k, np.int64) for k in ([5, 1, 9], [9, 5], [9, 1], [-3, 9], [9, -3, 5], [9])]
    i, j = np.triu_indices(6, 1)
    for key in (-3, 1, 5, 9):
        want = [any(k < key for k in set(keys[a].tolist()) & set(keys[b].tolist())) for a, b in zip(i, j)]
        assert minhash.met_before(key, keys, i, j).tolist() == want


def test_blocks_hold_the_pairs():
    docs, tile = np.array([10, 11, 12, 13, 14]), np.array([7, 7, -3, 9, 7])
    i, j = np.array([0, 0, 4, 1]), np.array([1, 2, 2, 3])
    rows = list(zip(*(x.tolist() for x in minhash._members(docs, tile, i, j))))
    blocks = {}
    for k, d, s in rows:
        blocks.setdefault(k, set()).add((d, s))
    assert sorted(map(sorted, blocks.values())) == [[(10, 0), (11, 0)], [(10, 1), (12, 0), (14, 1)], [(11, 0), (13, 1)]] and len(rows) == 7


def test_prefix_rows_hold_every_link_and_no_template(spark):
    rows = corpus(3)
    ids = sorted({i for i, _ in rows if i < 9000})
    members = spark.createDataFrame([(i, 0, i) for i in ids], "doc long, scope long, side long")
    texts = spark.createDataFrame([r for r in rows if r[0] < 9000], "doc_id long, text string")
    for most in (256, 3):
        keys = {}
        for r in prefix.prefix_rows(members, texts, 80, 4, most).collect():
            keys.setdefault(r["key"], set()).add(r["doc"])
        met = {(a, b) for k in keys.values() for a in k for b in k if a < b}
        sets = {i: s[0] for i, s in sets_of(rows).items()}
        assert {(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])} <= met
        assert not any(5000 <= a < 6000 and 5000 <= b < 6000 for a, b in met)
        assert max(map(len, keys.values())) <= 2 * most + 20


def test_runs():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64())], names=["key"]) for x in ([1, 1, 2], [2], [], [2, 3], [4])]
    assert [t.column("key").to_pylist() for t in ngrams.runs(iter(batches), "key")] == [[1, 1], [2, 2, 2], [3], [4]]
