"""Quality rules by host: rule failures of a host's documents, shrunk by a beta prior that all hosts fit, decide for the host.

DataFrame functions only. A document's counts are one pass over its text with array functions (no rows are exploded,
no text is shuffled); hosts are one aggregate with partial sums; verdicts come back by a join that keeps hot hosts apart.

Defined results: a null text counts as empty; a document of a null host is judged by its own rules alone; repeated
rows count each; an empty table gives no rows; other columns of the input pass through ``host_quality``, but for those
named like a result column (RESULTS), which the result replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayesmill.llm.common import WHITESPACE, free_name, join_counted, let, saved

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Parameters of the method: symbols per word that fail a document, and when a host's shrunk failure rate fails the host:
# above the prior's mean by DEVIATIONS of the prior and TIMES as high, as hosts that all do alike must not be parted by
# chance; and always where most of its documents fail.
MAX_SYMBOLS_PER_WORD = 1
DEVIATIONS, TIMES, MOST = 4.0, 2.0, 0.5
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed", "host_rate", "host_rejected", "kept")


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _windows(w: Column) -> Column:
    """A 64-bit hash of each WINDOW consecutive words; ``w`` has that many at least."""
    at = F.sequence(F.lit(0), F.size(w) - WINDOW)
    return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))


def _covered(h: Column) -> Column:
    """Words inside the windows that occur twice or more: equal hashes meet by sorting, then the windows' union is measured."""
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    twice = let(pairs, lambda s: F.sort_array(F.transform(
        F.filter(s, lambda e, j: (F.get(s, j - 1)["x"] == e["x"]) | (F.get(s, j + 1)["x"] == e["x"])), lambda e: e["i"])))
    gains = let(twice, lambda p: F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))))
    return F.aggregate(gains, F.lit(0).cast("long"), lambda acc, g: acc + g)


def repeated_words(w: Column) -> Column:
    none = F.lit(0).cast("long")
    many = let(_windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(_covered(h)))
    return F.when(F.size(w) <= WINDOW, none).otherwise(many)


WORDS = "_words_and_repeats"


def base_counts(text: Column) -> dict[str, Column]:
    """The counts of one text. Words are bound once; their array serves both the count and the windows."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, WHITESPACE), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return {
        WORDS: let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))),
        "word_chars": F.length(_without(t, SPACES)).cast("long"),
        "n_symbols": (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def document_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the counts, ``base_failed`` and ``failed`` (any rule)."""
    counts = base_counts(F.col(text))
    other = [c for c in docs.columns if c != text and c.lower() not in {*RESULTS, WORDS}]
    counted = docs.select(*other, *[c.alias(n) for n, c in counts.items()])
    counted = counted.withColumns({"n_words": F.col(f"{WORDS}.n"), "n_repeat_words": F.col(f"{WORDS}.r")}).drop(WORDS)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counted = counted.withColumn("base_failed", base)
    return counted.withColumn("failed", F.col("base_failed") | (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * F.col("n_words")))


def host_verdicts(rules: DataFrame, host: str) -> DataFrame:
    """One row a host: ``host, n_docs, host_rate, host_rejected``.

    The prior beta(a, b) matches the mean and variance of the hosts' failure rates (method of moments); a host's rate
    is the posterior mean (failures + a) / (documents + a + b), and its limit comes from the prior's mean and deviation.
    The prior is one row, read as scalar subqueries.
    """
    hosts = rules.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    m = F.least(F.greatest(F.avg(rate), F.lit(1e-6)), F.lit(1 - 1e-6))
    v = F.greatest(F.coalesce(F.var_pop(rate), F.lit(0.0)), F.lit(1e-9))
    fitted = hosts.agg(m.alias("m"), v.alias("v")).select("m", F.least(F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(1.0)), F.lit(1e6)).alias("s"))
    deviation = F.sqrt(F.col("m") * (1 - F.col("m")) / (F.col("s") + 1))
    limit = F.least(F.lit(MOST), F.greatest(F.col("m") * TIMES, F.col("m") + DEVIATIONS * deviation))
    prior = fitted.select((F.col("m") * F.col("s")).alias("a"), ((1 - F.col("m")) * F.col("s")).alias("b"), limit.alias("limit"))
    a, b, most = (prior.select(c).scalar() for c in ("a", "b", "limit"))
    shrunk = hosts.withColumn("a", a).withColumn("b", b).withColumn("most", most).withColumn("host_rate", (F.col("n_failed") + F.col("a")) / (F.col("n_docs") + F.col("a") + F.col("b")))
    return shrunk.select(F.col("host").alias(host), "n_docs", "host_rate", (F.col("host_rate") > F.col("most")).alias("host_rejected"))


def host_quality(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` without its text, with counts, rules, ``host_rate``, ``host_rejected`` and ``kept``."""
    if host.lower() in RESULTS or text.lower() in RESULTS:
        raise ValueError("the host and text columns need other names than the results")
    rules = saved(document_rules(docs, text), "host_rules")
    count = free_name(rules, "n_docs")
    verdicts = saved(host_verdicts(rules, host).withColumnRenamed("n_docs", count), "host_verdicts")
    joined = join_counted(rules, verdicts, host, count)
    return joined.withColumn("kept", ~F.col("failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False)))
