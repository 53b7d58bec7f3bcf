"""Lookup joins that spread hot keys.

``salted_lookup_join(facts, lookup, key, weight)`` is an inner equi-join of a
large fact table with a lookup table holding one row per key (term -> idf,
term -> model weights). ``weight`` says how many fact rows a key has (e.g.
document frequency). A key is hot when it has more rows than an average
shuffle partition: a term in a third of all documents would otherwise send a
third of the fact rows to one task. A hot key gets as many salts as it fills
average partitions; its fact rows are dealt over them by a hash of
``salt_col``, its lookup row is repeated once per salt, and the join runs on
(key, salt). All other keys keep salt 0, so every fact row still meets exactly
its one lookup row and results are exact.

With P shuffle partitions there are fewer than P hot keys and at most 2 P salts
whatever the data, so the hot-key table is broadcast; the two sides stay as
large as they are and Spark picks their join strategy (AQE may still split what
remains skewed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """``(key, _salts int)`` for the keys with more weight than an average shuffle partition."""
    parts = int(lookup.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = lookup.agg(F.sum(weight)).scalar()
    shares = lookup.select(key, (F.col(weight) * parts / total).alias("_share"))
    return shares.where(F.col("_share") > 1).select(key, F.ceil("_share").cast("int").alias("_salts"))


def salted_lookup_join(facts: DataFrame, lookup: DataFrame, key: str, weight: str, salt_col: str) -> DataFrame:
    hot = F.broadcast(hot_keys(lookup, key, weight))       # fewer rows than shuffle partitions
    salt = F.coalesce(F.pmod(F.hash(F.col(salt_col)), F.col("_salts")), F.lit(0))
    f = facts.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    lk = lookup.join(hot, key, "left").withColumn("_salt", F.explode(salts)).drop("_salts")
    return f.join(lk, [key, "_salt"]).drop("_salt")
