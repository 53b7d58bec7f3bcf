"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayesmill.session import ensure_checkpoint_dir

# Fixed value: the ASCII white space that separates words.
WHITESPACE = "[\\x20\\x09-\\x0D]+"

# A key is hot when it has more than one in HOT_PARTS of all rows; so at most
# HOT_PARTS keys are hot, which bounds every broadcast of hot keys.
HOT_PARTS = 1000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def worker_memory(name: str, make: Callable):
    """``make()``, kept under ``name`` for the life of this Python worker: its later tasks start with it."""
    kept = sys.modules.setdefault("bayesmill_worker_memory", types.ModuleType("bayesmill_worker_memory")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def schema_of(df: DataFrame) -> str:
    """The columns of ``df`` as DDL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: its lineage is cut and any executor can read it."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.saved_path = path
    return table


def forget(*tables: DataFrame) -> None:
    """Deletes ``saved`` tables that nothing reads any more: all that came from them must be saved itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.saved_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str) -> DataFrame:
    """Left join of ``left`` (a saved table) with ``right``, which has one row a key and says in ``count`` how many
    rows of ``left`` have that key.

    A key with more than 1 / HOT_PARTS of the rows would fill one task of a shuffled join. At most HOT_PARTS such
    keys can exist: they are broadcast, and only the other rows are shuffled (or broadcast, if Spark finds
    ``right`` small). Null keys match nothing and are not shuffled at all.
    """
    extra = [c for c in right.columns if c not in (key, count)]
    total = right.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_PARTS > F.lit(total)
    mark = free_name(left, "_hot")
    hot = right.where(is_hot).select(key, *extra, F.lit(True).alias(mark))
    cold = right.where(~is_hot).select(key, *extra)
    tagged = left.join(F.broadcast(hot), key, "left")
    done = tagged.where(F.col(mark) | F.col(key).isNull()).drop(mark)
    rest = tagged.where(F.col(mark).isNull() & F.col(key).isNotNull()).drop(mark, *extra)
    return done.unionByName(rest.join(cold, key, "left"))
