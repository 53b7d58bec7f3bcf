"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, contaminated ones go,
secrets are masked, and what is left is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of documents. ``run`` writes each result as Parquet in the shared checkpoint folder and reads it again.

Defined results: an empty table passes all stages and packs to no rows; null texts are kept (they are no copies of each
other) and pack as end tokens; rows of one doc_id are one document; extra columns, also ones named like a stage's own,
pass up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bayesmill.llm import decontaminate, ngram_join, packing, secret_ledger, toxicity
from bayesmill.llm.common import forget, saved
from bayesmill.llm.queries import word_tokenizer
from bayesmill.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_ledger.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secret_ledger", mask_secrets),
    ("packing", pack),
]

# No stage's scores or retrieval can be told in SQL; the tests hold run() against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
        if before is not None:
            forget(before)
        before = docs
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
