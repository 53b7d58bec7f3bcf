"""Naive Bayes against an independent brute-force implementation on hand-made documents."""

import math
import re
from collections import Counter

import pytest

from bayesmill.operators import naive_bayes as NB

TRAIN = [
    (1, "apple banana apple", ["A"]),
    (2, "banana cherry", ["A", "B"]),        # two classes: counts once in each
    (3, "cherry durian cherry", ["B"]),
    (4, "eggplant apple", []),               # unlabelled: adds to N, df and V only
    (5, "fig grape fig", ["C"]),
]
TEST = [
    (10, "apple cherry zucchini apple"),     # unknown term drops out, repeats count
    (11, "zucchini"),                        # only unknown terms
    (12, "eggplant"),                        # known, seen in no class: missing value everywhere
]
CLASSES = ["A", "B", "C"]


def _bag(text):
    t = [w.lower() for w in re.sub("[^a-zA-Z ]", "", re.sub("[\r\n]", " ", text)).split()]
    return t + [a + b for a, b in zip(t, t[1:])]


def brute(train, test, classes):
    n = len(train)
    tf = {d: Counter(_bag(x)) for d, x, _ in train}
    df = Counter(t for c in tf.values() for t in c)
    idf = {t: math.log((n + 1) / (v + 1)) for t, v in df.items()}
    vocab = len(df)
    w = {c: sum(len(tf[d]) for d, _, ls in train if c in ls) for c in classes}
    nc = {c: sum(1 for _, _, ls in train if c in ls) for c in classes}
    prior = {c: math.log(nc[c] / sum(nc.values())) for c in classes}
    x = {c: Counter() for c in classes}
    for d, _, ls in train:
        for c in ls:
            for t, k in tf[d].items():
                x[c][t] += k * idf[t]

    def logp(c, t):
        den = w[c] + vocab
        val = x[c][t] if t in x[c] else 1.0 / den
        return math.log((val + 1.0) / den)

    scores = {}
    for d, text in test:
        known = [t for t in _bag(text) if t in df]
        if known:
            scores[d] = {c: prior[c] + sum(logp(c, t) for t in known) for c in classes}
    return scores, {(t, c): logp(c, t) for t in df for c in classes}


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(d, x) for d, x, _ in TRAIN], "doc_id long, text string")
    labels = spark.createDataFrame([(d, ls) for d, _, ls in TRAIN], "doc_id long, classes array<string>")
    return NB.fit(docs, labels, CLASSES, stop_words=())


def _test_docs(spark):
    return spark.createDataFrame(TEST, "doc_id long, text string")


def test_model_matches_brute_force(spark, model):
    _, want = brute(TRAIN, TEST, CLASSES)
    got = {(r["term"], r["class"]): r["logp"] for r in model.long_form().collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12)


def test_class_stats(model):
    assert model.n_docs == 5
    assert model.class_docs == (2, 2, 1)
    # W_c: (doc, distinct unigram + bigram) pairs; doc 2 (3 terms) counts in A and B
    assert model.pair_counts == (4 + 3, 3 + 4, 4)


def test_scores_and_unknown_only_document(spark, model):
    want, _ = brute(TRAIN, TEST, CLASSES)
    got = {}
    for r in NB.score(model, _test_docs(spark)).collect():
        got.setdefault(r["doc_id"], {})[r["class"]] = r["score"]
    assert set(got) == {10, 12}                # doc 11 has no known term: no row
    for d in want:
        for c in CLASSES:
            assert got[d][c] == pytest.approx(want[d][c], rel=1e-12)


def test_prior_option_scores_unknown_document(spark, model):
    rows = {r["doc_id"]: r["label"] for r in NB.predict(model, _test_docs(spark), on_unknown="prior").collect()}
    assert set(rows) == {10, 11, 12}
    assert rows[11] == "A"                     # A and B share the best prior: smallest name


def test_tie_goes_to_smallest_class(spark):
    docs = spark.createDataFrame([(1, "kiwi"), (2, "lime"), (3, "mango")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, ["B"]), (2, ["A"])], "doc_id long, classes array<string>")
    m = NB.fit(docs, labels, ["A", "B"], stop_words=())
    test = spark.createDataFrame([(9, "mango")], "doc_id long, text string")
    assert NB.predict(m, test).first()["label"] == "A"


def test_multilabel_accuracy(spark):
    pred = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "doc_id long, label string")
    truth = spark.createDataFrame([(1, ["A", "B"]), (2, ["A"]), (3, ["C"])], "doc_id long, classes array<string>")
    r = NB.multilabel_accuracy(pred, truth).first()
    assert (r["n"], r["correct"]) == (3, 2)


def test_stemming_option_merges_word_forms(spark):
    docs = spark.createDataFrame([(1, "running runs"), (2, "cats cat")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, ["R"]), (2, ["C"])], "doc_id long, classes array<string>")
    m = NB.fit(docs, labels, ["C", "R"], stop_words=(), stem=True)
    terms = sorted(r["term"] for r in m.terms.collect())
    assert terms == sorted(["run", "runrun", "cat", "catcat"])
    test = spark.createDataFrame([(9, "runner running")], "doc_id long, text string")
    assert NB.predict(m, test).first()["label"] == "R"


def test_fit_on_an_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, classes array<string>")
    model = NB.fit(docs, labels, ["A", "B"])
    assert model.n_docs == 0 and model.terms.count() == 0
    got = {r["class"]: (r["class_docs"], r["prior"]) for r in NB.class_statistics(docs, labels, ["A", "B"]).collect()}
    assert got == {"A": (0, None), "B": (0, None)}


def test_registered_stemmed_job_matches_brute_force(spark, monkeypatch):
    import sys

    from bayesmill.functions.stem import porter_stem
    from bayesmill.functions.stopwords import default_stop_words
    from bayesmill.plans import registry
    from bayesmill.sources import tables as T
    from conftest import SF_SMALL

    stop = set(default_stop_words())

    def stemmed_bag(text):
        t = [w.lower() for w in re.sub("[^a-zA-Z ]", "", re.sub("[\r\n]", " ", text)).split(" ") if w]
        t = [porter_stem(w) for w in t if w not in stop]
        return t + [a + b for a, b in zip(t, t[1:])]

    monkeypatch.setattr(sys.modules[__name__], "_bag", stemmed_bag)
    labels = {r["doc_id"]: r["classes"] for r in T.label_sets(spark, SF_SMALL).collect()}
    train = [(r["doc_id"], r["text"], labels.get(r["doc_id"], [])) for r in T.train_docs(spark, SF_SMALL).collect()]
    test = [(r["doc_id"], r["text"]) for r in T.test_docs(spark, SF_SMALL).collect()]
    scores, _ = brute(train, test, list(T.CLASSES))
    got = {r["doc_id"]: r["label"] for r in registry.queries()["nb_predict_stemmed"](spark, SF_SMALL).collect()}
    assert got.keys() == scores.keys() and got
    for d, label in got.items():
        assert scores[d][label] == pytest.approx(max(scores[d].values()), abs=1e-6)
