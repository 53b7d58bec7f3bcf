from pyspark.sql import functions as F

from bayesmill.operators import tfidf as TF
from bayesmill.operators.skew import hot_keys, salted_lookup_join


def test_hot_keys_follow_their_share(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lookup = spark.createDataFrame([("all", 1000)] + [(f"k{i}", 1) for i in range(1000)], "key string, n long")
    assert [tuple(r) for r in hot_keys(lookup, "key", "n").collect()] == [("all", parts // 2)]
    even = spark.createDataFrame([(f"k{i}", 5) for i in range(100)], "key string, n long")
    assert hot_keys(even, "key", "n").count() == 0
    assert hot_keys(even.limit(0), "key", "n").count() == 0


def test_salted_join_equals_the_plain_join(spark):
    facts = spark.range(3000).select(F.col("id").alias("doc"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"))
    facts = facts.union(spark.createDataFrame([(5000, None), (5001, "unknown")], "doc long, key string"))
    lookup = facts.where("key <> 'unknown'").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    want = sorted(tuple(r) for r in facts.join(lookup, "key").select("doc", "key", "n").collect())
    got = salted_lookup_join(facts, lookup, "key", "n", "doc").select("doc", "key", "n")
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) == 3000


def test_a_term_of_all_documents(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("every w"), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    rows = TF.tfidf_table(docs, stop_words=(), grams=(1,)).where("term = 'every'").collect()
    assert len(rows) == 500 and {r["tfidf"] for r in rows} == {0.0}
