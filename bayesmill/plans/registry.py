
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bayesmill.plans import bytes as bytes_jobs
from bayesmill.plans import evaluate
from bayesmill.plans import images
from bayesmill.plans import text


def _modules():
    return [text, bytes_jobs, evaluate, images]


def queries() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _modules():
        out.update(m.sql() if hasattr(m, "sql") else m.SQL)
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.nb_predict(spark, sf_dir)
