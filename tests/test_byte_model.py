"""The table-based classifiers against Spark ML and against brute force."""

import collections
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bayesmill.functions.codes import codes, written
from bayesmill.operators import byte_model as BM
from bayesmill.operators import bytegrams as BG
from bayesmill.plans import bytes as plans
from bayesmill.sources import tables as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split(spark):
    files = plans._labelled_files(spark, SF).checkpoint()
    return files.where(~T.is_test_doc()), files.where(T.is_test_doc())


def bag(text):
    t = written(codes(text))
    return collections.Counter("".join(t[i:i + k]) for k in BM.GRAMS for i in range(len(t) - k + 1))


def test_blocks_hold_what_tfidf_counts(spark, split, monkeypatch):
    monkeypatch.setattr(BM, "BLOCK_COUNTS", 20_000)
    held = BM.blocks(split[0])
    assert held.count() > 3
    got = {}
    for r in held.collect():
        block = BM.Block.of(r.asDict())
        for o, p, n in zip(block.owner.tolist(), block.places.tolist(), block.counts.tolist()):
            got[block.files[o], block.grams[p]] = n
    files = split[0].select(F.concat(F.lit("/x/"), "file_id", F.lit(".bytes")).alias("path"), "content")
    assert got == {(r["file_id"], r["gram"]): r["freq"] for r in BG.gram_counts(files, BM.GRAMS).collect()}


def test_logistic_is_spark_mls(spark, split, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer

    monkeypatch.setattr(BM, "BLOCK_COUNTS", 50_000)
    train, test = split
    held, asked = BM.blocks(train), BM.blocks(test)
    model = BM.fit_logistic(held, BM.gram_idf(train), steps=40, tolerance=1e-4)
    got = {r["file_id"]: r["predicted"] for r in BM.predict_logistic(model, asked).collect()}
    a, b = (spark.createDataFrame([(r["file_id"], r["label"], list(bag(r["content"]).elements())) for r in x.collect()], "file_id string, label string, grams array<string>") for x in split)
    fitted = Pipeline(stages=[StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc"),
                              CountVectorizer(inputCol="grams", outputCol="tf", vocabSize=(1 << 31) - 1), IDF(inputCol="tf", outputCol="x"),
                              LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", regParam=BM.PENALTY, maxIter=300, tol=1e-9)]).fit(a)
    names = fitted.stages[0].labels
    want = {r["file_id"]: names[int(r["prediction"])] for r in fitted.transform(b.drop("label")).collect()}
    assert got == want
    objective = fitted.stages[-1].summary.objectiveHistory[-1]
    assert model.losses[-1] == pytest.approx(objective, abs=1e-3) and all(x >= y for x, y in itertools.pairwise(model.losses))


def dumps(n, seed=1):
    """Files whose label follows from how often some codes occur."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = [rng.choice(["AA", "0B", "??", "10", "7F"]) for _ in range(rng.randint(0, 30))]
        label = "1" if t.count("7F") >= 4 else "2" if "0B0B" in "".join(t) else "3" if rng.random() < 0.9 else "1"
        rows.append((f"f{i:03d}", label, "00401000 " + " ".join(t)))
    return rows


def brute_tree(rows, depth):
    bags = [bag(c) for _, _, c in rows]
    classes = sorted({label for _, label, _ in rows})
    df = collections.Counter(g for b in bags for g in b)
    grams = sorted(g for g in df if df[g] < len(rows))

    def grow(mine, level):
        totals = np.array([sum(rows[i][1] == c for i in mine) for c in classes])
        best = (1e-9,)
        if level and np.count_nonzero(totals) > 1:
            for g in grams:
                for edge in range(1, max(bags[i][g] for i in mine).bit_length() + 1):
                    high = [i for i in mine if bags[i][g].bit_length() >= edge]
                    h = np.array([sum(rows[i][1] == c for i in high) for c in classes])
                    if 0 < len(high) < len(mine) and (x := float(BM.gain(totals - h, h))) > best[0]:
                        best = (x, g, edge, high)
        if len(best) == 1:
            return classes[int(totals.argmax())]
        _, g, edge, high = best
        return g, edge, grow([i for i in mine if i not in set(high)], level - 1), grow(high, level - 1)

    return grow(list(range(len(rows))), depth)


def shape(tree, classes):
    return classes[int(tree.totals.argmax())] if tree.low is None else (tree.gram, tree.bin, shape(tree.low, classes), shape(tree.high, classes))


@pytest.mark.parametrize("block", [40, 300_000])
def test_tree_is_the_brute_force_tree(spark, monkeypatch, block):
    monkeypatch.setattr(BM, "BLOCK_COUNTS", block)
    rows = dumps(120)
    files = spark.createDataFrame(rows, "file_id string, label string, content string").repartition(4)
    held = BM.blocks(files)
    classes, tree = BM.fit_tree(held, BM.gram_idf(files))
    want = brute_tree(rows, BM.DEPTH)
    assert shape(tree, classes) == want and isinstance(want, tuple)
    asked = dumps(60, 2)

    def told(t, b):
        return t if isinstance(t, str) else told(t[3] if b[t[0]].bit_length() >= t[1] else t[2], b)

    got = BM.predict_tree(classes, tree, BM.blocks(spark.createDataFrame(asked, "file_id string, label string, content string"))).collect()
    assert {r["file_id"]: r["predicted"] for r in got} == {f: told(want, bag(c)) for f, _, c in asked}


@pytest.mark.parametrize("model", ["logistic", "tree"])
def test_odd_tables(spark, model):
    kind = "file_id string, label string, content string"
    few = spark.createDataFrame([("a", "1", "00401000 AA BB"), ("b", "2", "00401000 CC"), ("c", "2", None)], kind)
    got = {r["file_id"]: r["predicted"] for r in BM.fit_predict(few, few, model).collect()}
    assert got["a"] == "1" and got["b"] == "2"
    assert BM.fit_predict(few, few.limit(0), model).count() == 0
    assert {r["predicted"] for r in BM.fit_predict(few.limit(0), few, model).collect()} == {None}
    assert {r["predicted"] for r in BM.fit_predict(few.where("label = 2"), few, model).collect()} == {"2"}


def test_sample_is_bounded_and_the_same_each_time(spark):
    files = spark.range(500).select(F.concat(F.lit("f"), "id").alias("file_id"), F.lit("1").alias("label"), F.lit("AA").alias("content"))
    a, b = (sorted(r["file_id"] for r in BM.sample(files.repartition(k), 40).collect()) for k in (2, 7))
    assert a == b and len(a) == 40 and BM.sample(files, None).count() == 500
