"""Operators against plain re-tellings of their rules, and odd tables for all of them."""

import collections
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bayesmill.llm import alignment, chat_format, chunk_dedup, decontaminate, divergence, host_quality, lpt_shards, minhash, ngram_join, packing, pii_boost, secret_ledger, toxicity
from bayesmill.llm.queries import word_tokenizer

WORD = r"[^\x20\x09-\x0D]+"


def quality_by_hand(rows):
    """doc_id -> the counts, failed and kept of every row."""
    told = []
    for i, text, host in rows:
        t = text or ""
        w = re.findall(WORD, t)
        seen = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        repeats = len({k + j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(5)})
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        symbols = len(re.findall(r"[#*$%&|<>]", t))
        base = len(w) < 10 or 100 * repeats > 20 * len(w)
        told.append((i, host, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), repeats, base, base or symbols > len(w)))
    hosts = {}
    for r in told:
        if r[1] is not None:
            n, bad = hosts.get(r[1], (0, 0))
            hosts[r[1]] = (n + 1, bad + r[-1])
    rates = [bad / n for n, bad in hosts.values()]
    m = min(max(np.mean(rates), 1e-6), 1 - 1e-6)
    s = min(max(m * (1 - m) / max(np.var(rates), 1e-9) - 1, 1), 1e6)
    limit = min(0.5, max(2 * m, m + 4 * (m * (1 - m) / (s + 1)) ** 0.5))
    rate = {h: (bad + m * s) / (n + s) for h, (n, bad) in hosts.items()}
    return {(r[0], *r[2:8], not r[8] and not (r[1] is not None and rate[r[1]] > limit)) for r in told}, {h for h in rate if rate[h] > limit}


def quality_rows():
    rng = np.random.default_rng(21)
    words = [f"w{k}" for k in range(60)] + ["#", "<>|", "é$"]
    rows = []
    for i in range(600):
        host = f"h{i % 12}"
        n = int(rng.integers(0, 40))
        text = "".join(str(x) + str(rng.choice([" ", "\n", "\n\n", "\t"], p=[.8, .1, .05, .05])) for x in rng.choice(words, n))
        if i % 20 == 0:
            text = "a b c d e f g\n" * 4
        if host == "h3":
            text = " ".join(f"w{i}x{k}" for k in range(20)) if i % 48 == 3 else "short text"
        rows.append((i, text, host if i % 50 else None))
    return [*rows, (600, None, "h0"), (601, "", None), (602, "# " * 30, "h1")]


def test_host_quality_by_hand(spark):
    rows = quality_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    want, rejected = quality_by_hand(rows)
    assert rejected == {"h3"}  # a host whose documents mostly fail takes its good ones along
    out = host_quality.host_quality(table)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert {tuple(r) for r in out.select(cols).collect()} == want
    assert {r["source"] for r in out.where("host_rejected").select("source").distinct().collect()} == rejected
    kept = out.where("source = 'h3'").agg(F.sum((~F.col("failed")).cast("int")).alias("good"), F.sum(F.col("kept").cast("int")).alias("kept")).first()
    assert kept["good"] > 0 and kept["kept"] == 0


def test_even_hosts_are_not_rejected(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "short" if rng.random() < 0.12 else " ".join(f"w{i}x{k}" for k in range(20)), f"h{i % 40}") for i in range(4000)]
    out = host_quality.host_quality(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert out.where("host_rejected").count() == 0


def test_host_quality_replaces_clashing_columns(spark):
    rows = quality_rows()[:100]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    odd = plain
    for c in (*host_quality.RESULTS, "_hot", "_w", "n_docs", "__hot", host_quality.WORDS, "Kept2", "a", "b", "most", "host"):
        odd = odd.withColumn(c, F.lit("x"))
    a, b = host_quality.host_quality(plain), host_quality.host_quality(odd)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.select(a.columns).collect()}
    assert {"_hot", "_w", "n_docs", "Kept2", "a", "host"} <= set(b.columns) and {r[0] for r in b.select("_w").collect()} == {"x"}
    with pytest.raises(ValueError):
        host_quality.host_quality(plain.withColumnRenamed("source", "kept"), "kept")


def items_by_hand(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = {}
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            k = min(10, len(v))
            for s in range(len(v) - k + 1 if k else 0):
                for at in range(len(w) - k + 1):
                    if w[at:at + k] == v[s:s + k]:
                        hit.update(range(at, at + k))
                        found.add(item)
        out.setdefault(i, []).append((len(w), len(hit), sorted(found)))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("block", [500_000, 60])
def test_decontaminate_by_hand(spark, block):
    rng = np.random.default_rng(5)
    vocabulary = ["the", "Of", "x1", "été", "b-c", "d.e", "F"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(f"i{k}", text(int(rng.integers(0, 30)))) for k in range(25)] + [("i3", "the"), ("dup", None), (None, "unheard words")]
    rows = [(i if i % 40 else None, text(int(rng.integers(0, 25))) + " " + (items[i % 25][1] if i % 3 else "") + " " + text(5)) for i in range(150)] + [(7, None), (8, "")]
    got = collections.defaultdict(list)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    for r in decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), benchmark, block_windows=block).collect():
        got[r["doc_id"]].append((r["n_words"], r["n_hit"], sorted(r["items"])))
    assert {i: sorted(v) for i, v in got.items()} == items_by_hand(rows, [(i or "", t) for i, t in items])


def test_shards_are_even_and_whole(spark):
    rng = np.random.default_rng(7)
    rows = [(i if i % 90 else None, "x" * int(rng.exponential(300))) for i in range(3000)] + [(5000 + i, "copy of one text " * 20) for i in range(300)] + [(9000, None), (9001, "")]
    out = lpt_shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 8).collect()
    assert collections.Counter(r["doc_id"] for r in out) == collections.Counter(i for i, _ in rows)
    load = collections.Counter()
    for r in out:
        load[r["shard"]] += r["size"]
    total, largest = sum(load.values()), 300 * (len("copy of one text " * 20) + 16)
    assert total == sum(len((t or "").encode()) + 16 for _, t in rows)
    assert max(load.values()) - min(load.values()) <= max(largest, total / 8 * 0.02) and largest < total / 8 * 1.2
    assert len({r["shard"] for r in out if r["doc_id"] and 5000 <= r["doc_id"] < 5300}) == 1
    for s in load:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    crc = {i: zlib.crc32((t or "").encode()) for i, t in rows if i}
    assert all(r["text_crc32"] == crc[r["doc_id"]] for r in out if r["doc_id"])


def cuts_by_hand(text):
    """The ends of the chunks, from the rule's words: each position by itself."""
    table, h = chunk_dedup.gear_table().tolist(), []
    for i in range(len(text)):
        h.append(sum(table[text[i - d]] << d for d in range(min(chunk_dedup.GEAR, i + 1))) & 0xFFFFFFFF)
    ends, r = [], chunk_dedup.RADIUS
    for i, x in enumerate(h):
        if all(x < y for y in h[max(0, i - r):i]) and all(x <= y for y in h[i + 1:i + 1 + r]):
            ends.append(i + 1)
    ends = sorted({*ends, len(text)}) if text else []
    out, last = [], 0
    for e in ends:
        while e - last > chunk_dedup.LONGEST:
            last += chunk_dedup.LONGEST
            out.append(last)
        out.append(e)
        last = e
    return out


@pytest.mark.parametrize("within", [False, True])
def test_chunk_dedup_by_hand(spark, within):
    rng = np.random.default_rng(8)
    some = lambda n: " ".join("".join(rng.choice(list("abcdefé "), rng.integers(1, 9))) for _ in range(n))
    shared = [some(40) for _ in range(5)]
    rows = [(i, " ".join(some(int(rng.integers(0, 60))) + (shared[rng.integers(5)] if rng.random() < 0.5 else "") for _ in range(3))) for i in range(60)]
    rows += [(70, ""), (71, None), (72, "a" * 5000), (73, "a" * 3000), (60, rows[3][1])]
    places = collections.defaultdict(set)
    for i, t in rows:
        raw, at = (t or "").encode(), 0
        for e in cuts_by_hand(raw):
            places[raw[at:e]].add((i, at, e))
            at = e
    spans = collections.defaultdict(list)
    for p in places.values():
        docs = {i for i, _, _ in p}
        if len(docs) > 1 or within and len(p) > 1:
            keeper = min(docs)
            firsts = {i: min(s for j, s, _ in p if j == i) for i in docs}
            for i, s, e in p:
                spans[i].append((s, e, keeper, i > keeper or within and s > firsts[i]))
    want = set()
    for i, parts in spans.items():
        parts.sort()
        runs = [[parts[0]]]
        for x in parts[1:]:
            runs[-1].append(x) if x[0] == runs[-1][-1][1] else runs.append([x])
        want |= {(i, run[0][0], run[-1][1], len(run), sum(x[3] for x in run), tuple(sorted({x[2] for x in run}))) for run in runs if run[-1][1] - run[0][0] >= chunk_dedup.LEAST_SPAN}
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["start"], r["end"], r["n_chunks"], r["n_removed"], tuple(r["keepers"])) for r in chunk_dedup.shared_spans(table, within=within).collect()}
    assert got == want and len(want) > 30


def template(n):
    page = " ".join(f"common{k}" for k in range(70))
    return [(i, page + " " + " ".join(f"own{i}x{k}" for k in range(30))) for i in range(n)]


@pytest.mark.parametrize("percent, find", [(85, ngram_join.ngram_components), (80, minhash.minhash_components)])
def test_template_pages_stay_linear(spark, monkeypatch, percent, find):
    """Pages of one template: no links, and work in proportion to their number."""
    seen = []
    for module in (ngram_join, minhash):
        monkeypatch.setattr(module, "prefix_rows", lambda *a, f=module.prefix_rows: (lambda rows: (seen.append(rows.count()), rows)[1])(f(*a)))
    monkeypatch.setattr(ngram_join, "HOT_SHARE", 1)  # as for a template below the share of hot n-grams
    for n in (400, 800):
        got = find(spark.createDataFrame(template(n), "doc_id long, text string")).collect()
        assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == n
    assert seen and max(seen) == 0


EXTRA = ("score", "expected", "spans", "items", "blob", "bits", "word", "block", "side", "size", "digest", "component", "node", "rep", "key", "kind", "chunk", "unit", "shard", "piece", "n_words", "n_hit", "toxic", "host_rate", "_hot", "Signs", "term", "n", "path", "ids", "c0_doc_id")


def odd_rows():
    base = "the quick brown fox jumps over the lazy dog while it rains in the old town by the sea"
    return [(1, base), (1, base), (2, base + " again"), (None, base), (3, None), (4, ""), (5, " \n\t"), (6, "x"), (7, "secret = abcdef123456 mail a@b.org call +1 (555) 010-9999"), (8, "word " * 9000), (None, None)]


OPERATORS = {
    "host_quality": lambda d, s: host_quality.host_quality(d, "lang").select("doc_id", "n_words", "kept"),
    "personal_data": lambda d, s: pii_boost.digest(pii_boost.personal_data(d)),
    "packing": lambda d, s: packing.pack_documents(d, word_tokenizer()).groupBy("doc_id").agg(F.sum("length").alias("n")),
    "chunk_dedup": lambda d, s: chunk_dedup.shared_spans(d, within=True),
    "decontaminate": lambda d, s: decontaminate.digest(decontaminate.contamination(d, s.createDataFrame([("i", "quick brown fox")], "item_id string, text string"))),
    "without_benchmark": lambda d, s: decontaminate.without_benchmark(d, s.createDataFrame([("i", "quick brown fox")], "item_id string, text string")).select("doc_id", "text"),
    "ngram_join": lambda d, s: ngram_join.ngram_components(d),
    "one_of_each": lambda d, s: ngram_join.one_of_each(d).select("doc_id", "text"),
    "lpt_shards": lambda d, s: lpt_shards.shard_documents(d, 3).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")),
    "secret_ledger": lambda d, s: secret_ledger.scan_paths(d),
    "without_secrets": lambda d, s: secret_ledger.without_secrets(d).select("doc_id", "text"),
    "toxicity": lambda d, s: toxicity.score(d, FIELD).select("doc_id", F.round("score", 9), toxicity.held_out().alias("held_out")),
    "alignment": lambda d, s: alignment.align(d, *(__import__("public_tokenizers").path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))),
    "divergence": lambda d, s: divergence.audit(d.withColumn("source", F.col("lang")), least_docs=1),
    "minhash": lambda d, s: minhash.minhash_components(d),
}
FIELD = toxicity.fit([(toxicity.tokens_of(b"nasty vile words here"), 1), (toxicity.tokens_of(b"plain good words here"), 0)] * 20)


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_tables(spark, name):
    """Null ids and texts, repeated rows and clashing names change nothing; an empty table gives no rows."""
    plain = spark.createDataFrame(odd_rows(), "doc_id long, text string").withColumn("lang", F.lit("en"))
    odd = plain.select("*", *[F.lit("odd").alias(c) for c in EXTRA])
    told = [sorted((tuple(r) for r in OPERATORS[name](d, spark).collect()), key=repr) for d in (plain, odd.repartition(3))]
    assert told[0] == told[1]
    if name not in ("chunk_dedup", "divergence"):
        ids = collections.Counter(r[0] for r in told[0])
        assert set(ids) <= {i for i, _ in odd_rows()}
        if name not in ("packing", "lpt_shards", "without_benchmark", "one_of_each"):
            assert ids == collections.Counter(i for i, _ in odd_rows())
    assert OPERATORS[name](odd.limit(0), spark).count() == 0


def test_chat_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string, formatted string")
    assert chat_format.digests(chat_format.format_chats(none)).count() == 0


def test_neighbours_with_ties():
    same = [np.array([1, 2, 3], np.uint16)] * 6
    index = packing.Index(same, np.ones(1 << 16, np.float32), 3.0)
    assert index.neighbours(0, np.array([False, True, True, True, True, True])) == [1, 2, 3, 4, 5]


def test_all_pairs_of_kinds_are_ordered():
    for a, b in itertools.combinations(secret_ledger.KINDS, 2):
        assert secret_ledger.KINDS.index(a) < secret_ledger.KINDS.index(b)
