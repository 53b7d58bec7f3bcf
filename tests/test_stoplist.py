import random

from pyspark.sql import functions as F

from bayesmill.functions import text as TX
from bayesmill.functions.stopwords import default_stop_words
from bayesmill.operators import stoplist
from bayesmill.operators.stoplist import without_listed

ROWS = [(1, "the state of the art is not here"), (2, "the of"), (3, ""), (4, "x the y the x"), (5, "plain words only")]


def _docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").select("doc_id", TX.tokenize("text").alias("tokens"))


def test_same_rows_as_the_short_list(spark):
    docs = _docs(spark)
    listed = spark.createDataFrame([(w,) for w in default_stop_words()], "word string")
    want = {r["doc_id"]: r["t"] for r in docs.select("doc_id", TX.remove_stop_words("tokens").alias("t")).collect()}
    assert {r["doc_id"]: r["tokens"] for r in without_listed(docs, listed).collect()} == want
    assert {r["doc_id"]: r["tokens"] for r in without_listed(docs, listed.limit(0)).collect()} == {r["doc_id"]: r["tokens"] for r in docs.collect()}


def test_a_million_words_without_a_literal(spark):
    listed = spark.range(1_000_000).select(F.concat(F.lit("w"), "id").alias("word")).union(spark.createDataFrame([("the",), ("the",)], "word string"))
    out = without_listed(_docs(spark), listed)
    assert len(out._jdf.queryExecution().toString()) < 60_000
    got = {r["doc_id"]: r["tokens"] for r in out.collect()}
    assert got[4] == ["x", "y", "x"] and got[3] == [] and got[2] == ["of"] and len(got) == 5


def test_blocks_of_any_size_and_no_row_of_a_word_occurrence(spark, monkeypatch):
    monkeypatch.setattr(stoplist, "BLOCK_WORDS", 4)
    rng, words = random.Random(5), ["a", "b", "the", "of", "é"]
    rows = [(i, [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 9]))]) for i in range(30)] + [(40, None), (41, ["x", None, "the"]), (42, ["the", "b"]), (42, ["a", "c", "of"]), (None, ["a"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    listed = spark.createDataFrame([("the",), ("of",), ("zz",), (None,)], "word string")
    out = without_listed(df, listed)
    assert "posexplode" not in out._jdf.queryExecution().toString()
    want = [(i, [w for w in t or [] if w not in ("the", "of")]) for i, t in rows[:-3]] + [(42, ["a", "b", "c"])] * 2 + [(None, [])]
    key = lambda r: (r[0] is None, r[0] or 0)
    # position 1 of one row and position 2 of the other are listed words
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
