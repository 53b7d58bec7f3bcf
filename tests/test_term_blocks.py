import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bayesmill.functions import text as TX
from bayesmill.operators import term_blocks
from bayesmill.operators import tfidf as TF


def _docs(spark):
    """Terms that are written alike (a + bc, ab + c), repeated and null ids, texts without words."""
    rng, words = random.Random(3), ["a", "ab", "abc", "b", "bc", "c", "the", "Word", "x-y", "café"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 9, 30])))) for i in range(60)]
    rows += [(7, "ab c ab c"), (7, "a bc\nabc"), (None, "a bc"), (None, "ab c ab"), (80, None), (81, " 12 "), (82, "the")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def _want(spark, docs, rows, stop_words, grams, sep):
    tf = Counter()
    for r in TX.with_terms(docs, "text", "bag", stop_words, grams, sep).collect():
        for t in r["bag"] or []:
            tf[r["doc_id"], t] += 1
    df = Counter(t for _, t in tf)
    return {k: (n, df[k[1]]) for k, n in tf.items()}


@pytest.mark.parametrize("stop_words, grams, sep", [(None, (1, 2), ""), ((), (1, 2), ""), (("a", ""), (2, 3), " "), (None, (1,), ""), ((), (3, 1), "$")])
@pytest.mark.parametrize("words, chars", [(1 << 20, 1 << 25), (40, 100), (1, 30)])
def test_counts_of_blocks_and_buckets_of_any_size(spark, monkeypatch, stop_words, grams, sep, words, chars):
    monkeypatch.setattr(term_blocks, "BLOCK_WORDS", words)
    monkeypatch.setattr(term_blocks, "BUCKET_CHARS", chars)
    monkeypatch.setattr(term_blocks, "HASH_TERMS", 7)
    monkeypatch.setattr(term_blocks, "OUT_ROWS", 11)
    monkeypatch.setattr(term_blocks, "SLICE_ROWS", 4)
    rows, docs = _docs(spark)
    got = term_blocks.counted(docs, "doc_id", "text", stop_words, grams, sep).collect()
    assert {(r["doc_id"], r["term"]): (r["tf"], r["df"]) for r in got} == _want(spark, docs, rows, stop_words, grams, sep)
    assert len(got) == len({(r["doc_id"], r["term"]) for r in got})


@pytest.mark.parametrize("sqrt", [False, True])
def test_tfidf_of_blocks_is_that_of_the_joined_tables(spark, sqrt):
    _, docs = _docs(spark)
    docs = docs.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body"))
    got, want = (sorted(map(str, TF.tfidf_table(docs, "key", "body", sqrt=sqrt, checkpoint=c).collect())) for c in (True, False))
    assert got == want and len(got) > 100
    empty = TF.tfidf_table(docs.limit(0), "key", "body", sqrt=sqrt)
    assert empty.count() == 0 and empty.columns == ["key", "term", "tf", "idf", "tfidf"]


def test_no_row_of_document_and_term_is_shuffled_or_saved(spark, tmp_path, monkeypatch):
    """Of 300 documents with the same 200 words, a block tells its terms once."""
    monkeypatch.setattr(term_blocks, "scratch_path", lambda _, name: str(tmp_path / name))
    text = " ".join("w" + "abcdefghij"[i // 100] + "klmnopqrst"[i // 10 % 10] + "uvwxyzabcd"[i % 10] for i in range(200))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).coalesce(2)
    t = TF.tfidf_table(docs)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan and "hashpartitioning(doc_id" not in plan and "Generate" not in plan
    assert t.count() == 300 * 399
    saved = spark.read.parquet(str(tmp_path / "term_blocks"))
    assert saved.count() == 4 and saved.where("terms is not null").count() == 2


def test_texts_are_cleaned_as_by_the_column(spark):
    texts = ["", None, "A-b c\r\nD\te", "É\u212aK \u0130i ß é1 2", "\x00z\x7f[`{@Z", "  x  ", "\U0001f600Q\u00a0r"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = [r["c"] or "" for r in df.select("doc_id", TX.clean_text("text").alias("c")).orderBy("doc_id").collect()]
    assert term_blocks._cleaned(pa.array(["skip", *texts]).slice(1)).to_pylist() == want
    assert term_blocks._cleaned(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize("words", [1 << 20, 20])
@pytest.mark.parametrize("grams, sep, lemmas", [((1, 2), "", None), ((1, 3), " ", {"geese": "big goose", "cats": "", "the": "x"})])
def test_stemmed_counts_of_blocks_are_those_by_position(spark, monkeypatch, words, grams, sep, lemmas):
    monkeypatch.setattr(term_blocks, "BLOCK_WORDS", words)
    monkeypatch.setattr(term_blocks, "OUT_ROWS", 9)
    rng, pool = random.Random(8), ["geese", "cats", "cat", "running", "run", "runs", "The", "the", "x-y", "é", "relational"]
    rows = [(i, i % 2, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 3, 20])))) for i in range(40)] + [(None, 1, "cats run"), (50, 0, None), (51, 1, "")]
    docs = spark.createDataFrame(rows, "key long, flag int, body string").repartition(3)
    args = ("key", "body", ("the",), grams, sep, ["flag"], lemmas)
    want = Counter(map(tuple, TF._stemmed_by_position(docs, *args).select("key", "flag", "term").collect()))
    got = TF.stemmed_freq(docs, "key", "body", ("the",), grams, sep, ["flag"], lemmas).collect()
    assert Counter({tuple(r)[:3]: r["tf"] for r in got}) == want and len(got) == len(want) > 50
    # a repeated id is one text, whose words are read by position
    again = docs.unionByName(docs.where("key = 3 or key is null"))
    want = Counter(map(tuple, TF._stemmed_by_position(again, *args).select("key", "flag", "term").collect()))
    got = TF.stemmed_freq(again, "key", "body", ("the",), grams, sep, ["flag"], lemmas).collect()
    assert Counter({tuple(r)[:3]: r["tf"] for r in got}) == want


def test_no_row_of_a_word_occurrence_is_shuffled_to_be_stemmed(spark):
    docs = spark.createDataFrame([(i, "running runs of geese") for i in range(9)], "doc_id long, text string")
    plan = TF.term_freq(docs, stem=True)._jdf.queryExecution().toString()
    assert "posexplode" not in plan and "Window" not in plan and "hashpartitioning(doc_id" not in plan
