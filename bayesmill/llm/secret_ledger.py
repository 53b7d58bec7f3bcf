"""Secret scans with an incremental blob ledger: contents are scanned once per version of the rules, findings join back to all paths.

A blob is a content, named by its SHA-256. Every row is hashed; the blobs that the ledger lacks for this version of the
rules bring their texts, each task passes a blob on once, and a shuffle by blob brings its copies together, so each
unseen blob is scanned once over all tasks. New rows (blob, rule_version, spans) are appended to the ledger, a
Parquet table in a shared folder; findings are then read from the ledger and joined to every path by blob. A blob with
very many paths is kept apart in that join.

``without_secrets`` masks texts in place: a bit table of the blobs with findings (at most WORDS longs, broadcast) tells
which texts can need it, only those meet the findings, and all other texts stay where they are.

Defined results: null texts count as empty, repeated rows each get their findings, empty tables give no rows, other
columns are not returned by ``scan_paths`` and pass unchanged through ``without_secrets``; rows of a ledger that two
jobs appended for one blob count as one.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.llm.common import free_name, join_counted, saved
from bayesmill.session import ensure_checkpoint_dir

RULE_VERSION = "2"
WORDS = 1 << 18  # longs of the bit table; with many findings more texts meet them in vain

# The base rules, their least lengths, and in which order kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")
# Rules that the method adds to the base rules.
ADDED = (
    ("pem", "PRIVATE KEY", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")),
    ("jwt", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("prefixed", "_", re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,})")),
)
KINDS = (*BASE_KINDS, *(kind for kind, _, _ in ADDED))
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_HEX_MAP = bytes(0x68 if b in b"0123456789abcdef" else 0x20 for b in range(256))


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; code points, end exclusive."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if b"h" * 16 in text.encode("utf-8", "surrogatepass").translate(_HEX_MAP):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for kind, hint, rule in ADDED:
        if hint in text:
            found += [(m.start(), m.end(), kind) for m in rule.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = [joined(find_secrets(t)) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("blob"), pa.array(spans, pa.string())], names=["blob", "spans"])


def hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` (null: empty) and its ``blob``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.withColumn("text", text).withColumn("blob", F.unhex(F.sha2("text", 256)))


def scanned_once(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``blob, spans``: a row for each scan, of which every blob of ``rows (blob, text)`` that ``known (blob)`` lacks gets one."""
    texts = rows.select("blob", "text")
    if known is not None:
        unseen = saved(rows.select("blob").distinct().join(known.select("blob"), "blob", "left_anti"), "unseen")
        texts = texts.join(unseen, "blob", "left_semi")  # few new blobs are broadcast by Spark's size check
    return texts.groupBy("blob").agg(F.first("text").alias("text")).mapInArrow(_scan, "blob binary, spans string")


def _known(ledger: DataFrame) -> DataFrame:
    """One row for each blob of this version of the rules."""
    return ledger.where(F.col("rule_version") == RULE_VERSION).groupBy("blob").agg(F.min("spans").alias("spans"))


LEDGER = "blob binary, rule_version string, spans string"


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger at ``path``, if there is one."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_to_ledger(rows: DataFrame, path: str) -> DataFrame:
    """Scans the unseen blobs of ``rows (blob, text)``, appends them to the ledger at ``path``, and returns its rows for
    this version of the rules as ``blob, spans``."""
    spark = rows.sparkSession
    old = read_ledger(spark, path)
    fresh = scanned_once(rows, None if old is None else _known(old))
    fresh.select("blob", F.lit(RULE_VERSION).alias("rule_version"), "spans").write.mode("append").parquet(path)
    return _known(read_ledger(spark, path))


def new_ledger(spark: SparkSession) -> str:
    """A fresh place in the shared folder."""
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "llm", f"ledger-{uuid.uuid4().hex}")


def scan_paths(versions: DataFrame, ledger: str | None = None, path: str = "doc_id", text: str = "text") -> DataFrame:
    """``(path, spans)`` of every row of ``versions``; ``ledger``: the ledger's place, by default a new one.

    Only blobs that it lacks for RULE_VERSION are scanned.
    """
    spark = versions.sparkSession
    rows = hashed(versions.select(F.col(path).alias("path"), F.col(text).alias("text")))
    known = scan_to_ledger(rows, ledger or new_ledger(spark))
    paths = saved(rows.select("path", "blob"), "paths")
    used = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("n"))
    told = saved(known.where(F.col("spans") != "").join(used, "blob"), "findings")
    out = join_counted(paths, told, "blob", "n")
    return out.select(F.col("path").alias(path), F.coalesce("spans", F.lit("")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The columns that the query returns."""
    parts = F.filter(F.split("spans", ","), lambda x: x != "")
    base = F.filter("parts", lambda x: F.substring_index(x, ":", 1).isin(*BASE_KINDS))
    out = found.withColumn("parts", parts).withColumn("base", base)
    kinds = F.transform("base", lambda x: F.substring_index(x, ":", 1))
    counts = {f"n_{k}": (F.size("base") - F.size(F.array_remove(kinds, k))).cast("long") for k in BASE_KINDS}
    return out.withColumns(counts).select("doc_id", *counts, F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), "spans")


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; what overlaps an earlier span only lengthens it."""
    parts = F.transform(F.split(spans, ","), lambda x: F.split(x, ":"))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        start, end = F.get(p, F.lit(1)).cast("int"), F.get(p, F.lit(2)).cast("int")
        more = F.concat(F.substr(text, acc["at"] + 1, start - acc["at"]), F.lit("["), F.get(p, F.lit(0)), F.lit("]"))
        return F.struct(F.greatest(acc["at"], end).alias("at"), F.when(start >= acc["at"], F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, zero, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))


def _place(blob: str) -> tuple[Column, Column]:
    """A blob's long in the bit table, and its bit there."""
    place = F.pmod(F.xxhash64(blob), F.lit(64 * WORDS))
    return F.floor(place / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def without_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` with every finding masked in ``text`` and, if there is one, ``n_chars`` counted anew for these rows.

    The ledger's findings come back to the texts by blob, so that all copies of a content are masked alike.
    """
    spark = docs.sparkSession
    known = scan_to_ledger(hashed(docs.select("text")), ledger or new_ledger(spark))
    blob, spans, word, bits = (free_name(docs, c) for c in ("blob", "spans", "word", "bits"))
    found = saved(known.where(F.col("spans") != "").select(F.col("blob").alias(blob), F.col("spans").alias(spans)), "findings")
    at, bit = _place(blob)
    table = found.select(at.alias(word), bit.alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))  # at most WORDS rows
    tagged = docs.withColumn(blob, F.unhex(F.sha2("text", 256))).withColumn(word, at).join(F.broadcast(table), word, "left")
    maybe = F.coalesce(F.col(bits).bitwiseAND(bit) != 0, F.lit(False))
    out = tagged.where(maybe).drop(word, bits).join(found, blob, "left")
    hit = F.col(spans).isNotNull()
    out = out.withColumn("text", F.when(hit, _masked(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return tagged.where(~maybe).select(*docs.columns).unionByName(out.select(*docs.columns))
