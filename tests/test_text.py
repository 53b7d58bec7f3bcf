import pytest
from pyspark.sql import functions as F

from bayesmill.functions import text as TX
from bayesmill.functions.labels import label_set
from bayesmill.operators import naive_bayes as NB
from bayesmill.operators import tfidf as TF


def _tokens(spark, text, stop=()):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return df.select(TX.remove_stop_words(TX.tokenize("text"), stop).alias("t")).first()["t"]


def test_characters_are_deleted_not_blanked(spark):
    assert _tokens(spark, "cut-rate 5% don't") == ["cutrate", "dont"]


def test_line_breaks_become_spaces_tabs_glue(spark):
    assert _tokens(spark, "Alpha\nBeta\r\ngamma\tdelta") == ["alpha", "beta", "gammadelta"]


def test_short_texts_give_no_bigrams(spark):
    df = spark.createDataFrame([(1, ""), (2, "word"), (3, "   ")], "doc_id long, text string")
    rows = TX.with_terms(df, "text", "bag", stop_words=()).orderBy("doc_id").collect()
    assert [r["bag"] for r in rows] == [[], ["word"], []]


def test_bigrams_are_formed_after_stop_words(spark):
    df = spark.createDataFrame([(1, "state of art")], "doc_id long, text string")
    bag = TX.with_terms(df, "text", "bag").first()["bag"]
    assert sorted(bag) == sorted(["state", "art", "stateart"])


def test_default_separator_merges_bigram_with_unigram(spark):
    df = spark.createDataFrame([(1, "xy z x y")], "doc_id long, text string")
    tf = {r["term"]: r["tf"] for r in TF.term_freq(df, stop_words=()).collect()}
    # unigram "xy" plus bigram "x"+"y" share the key
    assert tf["xy"] == 2
    assert tf["xyz"] == 1


def test_ngrams_three(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a", "b"],)], "t array<string>")
    got = [r["g"] for r in df.select(TX.ngrams(F.col("t"), 3, " ").alias("g")).collect()]
    assert got == [["a b c", "b c d"], []]


def test_term_freq_sums_to_bag_size(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    tf = TF.term_freq(df).agg(F.sum("tf")).first()[0]
    bag = TX.with_terms(df, "text", "bag").agg(F.sum(F.size("bag"))).first()[0]
    assert tf == bag


def test_idf_non_negative(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    t = TF.tfidf_table(df)
    assert t.where(F.col("idf") < 0).count() == 0


def test_label_set_intersects_and_dedupes(spark):
    df = spark.createDataFrame([("E11,ECAT,M11,MCAT,ECAT",), (None,), ("X,Y",)], "line string")
    got = [r["c"] for r in df.select(label_set("line", ["CCAT", "ECAT", "GCAT", "MCAT"]).alias("c")).collect()]
    assert got == [["ECAT", "MCAT"], [], []]


@pytest.mark.parametrize("key", ["doc_freq", "idf", "vocabulary"])
def test_document_frequencies_shuffle_no_text(spark, key):
    from bayesmill.plans import text as P

    plan = P.QUERIES[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" not in plan and "hashpartitioning(doc_id" not in plan
    assert "hashpartitioning(term" in plan


@pytest.mark.parametrize("partitions", ["2", "8"])
def test_tasks_of_term_counts_hold_a_bounded_number_of_characters(spark, monkeypatch, partitions):
    """However few shuffle partitions there are: a task's counts take memory in proportion to its text."""
    rows = [(i, f"word{'abcdefghij'[i % 10]} common {'klmnopqrst'[i % 7]}x", ["A"]) for i in range(2000)] + [(3, "common again", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, classes array<string>")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(TF, "TASK_CHARS", 1000)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        chars = F.sum(F.length("text")).alias("chars")
        dealt = TF.by_document(docs).groupBy(F.spark_partition_id()).agg(chars, F.count_distinct("doc_id").alias("ids")).collect()
        assert len(dealt) > 30 and max(r["chars"] or 0 for r in dealt) < 3000
        tf = TF.term_freq(docs)
        assert tf.select(F.spark_partition_id()).distinct().count() > 30
        assert [r["tf"] for r in tf.where("doc_id = 3 and term = 'common'").collect()] == [2]
        assert TF.by_document(docs.limit(0)).count() == 0
        told = NB.fit(docs.where("doc_id is not null and classes is not null"), docs.where("classes is not null").select("doc_id", "classes"), ["A"])
        assert (told.n_docs, told.class_docs, told.terms.where("term = 'common'").first()["df"]) == (2000, (2000,), 2000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
