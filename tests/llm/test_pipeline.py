"""The pipeline on the smallest driver table, stage by stage against plain re-tellings, and on an empty one."""

import collections
import re
import zlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from bayesmill.llm import secret_ledger, toxicity
from bayesmill.llm.queries import word_tokenizer
from bayesmill.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def one_of_each_group(rows):
    sets = {}
    for i, t in rows.items():
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        k = min(4, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    least, changed = {i: i for i in sets}, True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return {i for i in sets if least[i] == i}


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_run_is_its_stages_by_hand(spark):
    from tokenizers import Tokenizer

    docs = read_table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    field = toxicity.train(docs, read_table(spark, SF, "labels"))
    clean = {r["doc_id"] for r in toxicity.score(docs, field).where("score < 0.5").collect()}
    assert 0.5 * len(texts) < len(clean) < len(texts)
    texts = {i: texts[i] for i in clean}
    texts = {i: texts[i] for i in one_of_each_group(texts)}
    windows = set()
    for r in read_table(spark, SF, "benchmark").collect():
        w = words(r["text"])
        k = min(10, len(w))
        windows |= {tuple(w[s:s + k]) for s in range(len(w) - k + 1)} if k else set()
    sizes = {len(x) for x in windows}

    def hit(t):
        w = words(t)
        return any(tuple(w[s:s + k]) in windows for k in sizes for s in range(len(w) - k + 1))

    texts = {i: t for i, t in texts.items() if not hit(t)}
    tokenizer, want = Tokenizer.from_file(word_tokenizer()), {}
    for i, t in texts.items():
        at, out = 0, ""
        for s, e, kind in secret_ledger.find_secrets(t or ""):
            out += (t[at:s] + f"[{kind}]") if s >= at else ""
            at = max(at, e)
        want[i] = np.array([*tokenizer.encode(out + (t or "")[at:], add_special_tokens=False).ids, 2], "<u4")

    pieces, sequences = collections.defaultdict(dict), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(want[r["doc_id"]])
        pieces[r["doc_id"]][r["start"]] = r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(want)
    for i, parts in pieces.items():
        at = 0
        for s in sorted(parts):
            assert s == at
            at += parts[s]
        assert at == len(want[i])
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096


def test_stages_keep_columns_and_effects(spark):
    docs = read_table(spark, SF, "documents").withColumn("score", F.lit("x")).withColumn("blob", F.lit(1))
    first, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), name)
        assert docs.columns == first and 0 < docs.count() <= n
        n = docs.count()


def test_empty_documents(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
