"""Multi-label, Laplace-smoothed naive Bayes over n-gram TF-IDF weights.

Model (for a fixed, sorted class list c_1..c_C):

* N   = number of training documents (labelled or not),
* df  = documents containing the term, ``idf = ln((N+1)/(df+1))``,
* x_c = sum over documents of class c of tf * idf, i.e. ``idf * tf_c`` with
  tf_c the term's occurrences in class-c documents (a document with several
  classes counts once in each),
* W_c = number of (document, distinct term) pairs in class c,
* V   = number of distinct terms over all training documents,
* ``logp_c = ln((x_c + 1) / (W_c + V))``; for a term never seen in class c
  the weight x_c is the missing value ``1 / (W_c + V)`` (smoothed again),
* prior_c = ``ln(n_c / sum n)`` over label occurrences.

Score of a test document = prior_c + sum over its known term occurrences of
logp_c; the prediction is the best class (ties: smallest class name).

Plan: the whole fit is one shuffle. Training documents are hash-partitioned by
id once, labels are attached by an id join that keeps that partitioning, the
per-(doc, term) count runs without an exchange, and a single partial + final
aggregate by term yields df and, per class, tf_c and the class document
count. That per-term table is checkpointed; W_c, V, N and the priors are
then single aggregate rows (C + 2 numbers) read like ``count()``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bayesmill.operators.skew import salted_lookup_join
from bayesmill.operators.tfidf import by_document, term_freq
from bayesmill.session import ensure_checkpoint_dir


@dataclass
class NaiveBayesModel:
    classes: tuple[str, ...]
    terms: DataFrame   # (term, df, idf, tf_by_class array<long>, docs_by_class array<long>, logp array<double>)
    n_docs: int
    vocab_size: int
    class_docs: tuple[int, ...]
    pair_counts: tuple[int, ...]
    stop_words: tuple[str, ...] | None
    grams: tuple[int, ...]
    sep: str
    stem: bool = False
    lemmas: DataFrame | dict[str, str] | None = None

    @property
    def prior(self) -> tuple[float | None, ...]:
        total = sum(self.class_docs)
        return tuple(math.log(n / total) if n > 0 and total > 0 else None for n in self.class_docs)

    def denom(self, i: int) -> float:
        return float(self.pair_counts[i] + self.vocab_size)

    def class_table(self) -> DataFrame:
        """``(class, class_docs, prior, pair_count, vocab_size, n_docs, missing, default_logp)``, one row per class."""
        rows = []
        for i, c in enumerate(self.classes):
            d = self.denom(i)
            missing = 1.0 / d if d > 0 else None
            rows.append((c, self.class_docs[i], self.prior[i], self.pair_counts[i], self.vocab_size, self.n_docs,
                         missing, math.log((missing + 1.0) / d) if missing is not None else None))
        schema = ("class string, class_docs long, prior double, pair_count long, vocab_size long, n_docs long, "
                  "missing double, default_logp double")
        return self.terms.sparkSession.createDataFrame(rows, schema)

    def long_form(self) -> DataFrame:
        """``(term, class, logp)`` for every vocabulary term and class (the dense V x C model)."""
        cls = F.array(*[F.lit(c) for c in self.classes])
        z = F.arrays_zip(cls.alias("class"), F.col("logp").alias("logp"))
        return self.terms.select("term", F.explode(z).alias("z")).select(
            "term", F.col("z.class").alias("class"), F.col("z.logp").alias("logp"))


def class_flags(classes_col: Column, classes: Sequence[str]) -> list[Column]:
    """One 0/1 int column per class: does the document carry it."""
    return [F.coalesce(F.array_contains(classes_col, c), F.lit(False)).cast("int").alias(f"_f{i}")
            for i, c in enumerate(classes)]


def class_statistics(docs: DataFrame, labels: DataFrame, classes: Sequence[str], id_col: str = "doc_id",
                     label_col: str = "classes") -> DataFrame:
    """``(class, class_docs, prior)`` from the ids and labels alone; no text is read."""
    classes = tuple(sorted(set(classes)))
    flags = labels.join(docs.select(id_col), id_col).select(*class_flags(F.col(label_col), classes))
    counts = flags.agg(*[F.coalesce(F.sum(f"_f{i}"), F.lit(0)).cast("long").alias(f"_f{i}") for i in range(len(classes))])
    total = sum((F.col(f"_f{i}") for i in range(len(classes))), F.lit(0))
    rows = F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"_f{i}").alias("class_docs")) for i, c in enumerate(classes)])
    e = counts.select(total.alias("total"), F.inline(rows))
    return e.select("class", "class_docs", F.when(F.col("class_docs") > 0, F.ln(F.col("class_docs") / F.col("total"))).alias("prior"))


def fit(docs: DataFrame, labels: DataFrame, classes: Sequence[str], id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "classes",
        stop_words: Iterable[str] | None = None, grams: Sequence[int] = (1, 2),
        sep: str = "", stem: bool = False, lemmas: DataFrame | dict[str, str] | None = None,
        checkpoint: bool = True) -> NaiveBayesModel:
    """Fit on documents ``(id, text)`` and label sets ``(id, classes array<string>)``.

    Unlabelled documents (no row, or an empty set) still count in N, df and V.
    The per-term statistics are checkpointed (reliable storage under
    ``spark.checkpoint.dir``) so the class scalars and every later scoring
    job read them instead of re-tokenising the corpus. ``stem=True`` puts every
    word's lemma (table or dictionary ``form -> lemma``) and Porter stem in its
    place after the stop-word test; each distinct word is stemmed once.
    """
    classes = tuple(sorted(set(classes)))
    C = len(classes)
    sw = None if stop_words is None else tuple(stop_words)
    lab = labels.select(id_col, label_col).where(F.size(label_col) > 0)
    flag_cols = [f"_f{i}" for i in range(C)]

    # one shuffle of the raw text by id; labels joined on id keep that partitioning
    texts = by_document(docs.select(id_col, text_col), id_col, text_col)
    joined = texts.join(lab, id_col, "left").select(id_col, text_col, *class_flags(F.col(label_col), classes))
    tf = term_freq(joined, id_col, text_col, sw, grams, sep, keep=flag_cols, prepartitioned=True, stem=stem,
                   lemmas=lemmas)
    agg = tf.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        *[F.sum(F.col("tf") * F.col(f)).alias(f"_tf{i}") for i, f in enumerate(flag_cols)],
        *[F.sum(F.col(f)).alias(f"_dc{i}") for i, f in enumerate(flag_cols)],
    ).select("term", "df",
             F.array(*[F.col(f"_tf{i}") for i in range(C)]).alias("tf_by_class"),
             F.array(*[F.col(f"_dc{i}") for i in range(C)]).alias("docs_by_class"))
    if checkpoint:
        ensure_checkpoint_dir(docs.sparkSession)
        agg = agg.checkpoint(eager=True)

    # Class scalars: one aggregate row each (like count()); no data rows leave the executors.
    ids = docs.select(id_col).join(lab, id_col, "left").select(*class_flags(F.col(label_col), classes))
    d = ids.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in flag_cols]).first()
    t = agg.agg(F.count(F.lit(1)).alias("v"),
                *[F.sum(F.col("docs_by_class")[i]).alias(f"w{i}") for i in range(C)]).first()
    n_docs = int(d["n"])
    class_docs = tuple(int(d[f] or 0) for f in flag_cols)
    vocab = int(t["v"])
    pairs = tuple(int(t[f"w{i}"] or 0) for i in range(C))

    idf_col = F.ln(F.lit(float(n_docs + 1)) / (F.col("df").cast("double") + 1.0))
    terms = agg.select("term", "df", idf_col.alias("idf"), "tf_by_class", "docs_by_class")
    logps = []
    for i in range(C):
        denom = float(pairs[i] + vocab) or 1.0      # no terms at all: no row uses it
        x = F.when(F.col("docs_by_class")[i] > 0, F.col("tf_by_class")[i] * F.col("idf")).otherwise(1.0 / denom)
        logps.append(F.ln((x + 1.0) / denom))
    terms = terms.withColumn("logp", F.array(*logps))
    return NaiveBayesModel(classes, terms, n_docs, vocab, class_docs, pairs, sw, tuple(grams), sep, stem, lemmas)


def score_arrays(model: NaiveBayesModel, docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", on_unknown: str = "drop") -> DataFrame:
    """``(id, scores array<double>)`` aligned with ``model.classes``.

    Test terms are counted per document first (repeats count each time), then
    joined to the model on term; unknown terms drop out of the inner join.
    ``on_unknown='drop'`` gives no row to a document without any known term;
    ``'prior'`` gives it the prior scores.
    """
    C = len(model.classes)
    tf = term_freq(docs.select(id_col, text_col), id_col, text_col, model.stop_words, model.grams, model.sep,
                   stem=model.stem, lemmas=model.lemmas)
    # the heaviest terms are salted so a term in most documents cannot pile onto one task
    j = salted_lookup_join(tf, model.terms.select("term", "df", "logp"), "term", "df", id_col)
    sums = j.groupBy(id_col).agg(*[F.sum(F.col("tf") * F.col("logp")[i]).alias(f"_s{i}") for i in range(C)])
    if on_unknown == "prior":
        sums = docs.select(id_col).join(sums, id_col, "left").fillna(0.0, subset=[f"_s{i}" for i in range(C)])
    elif on_unknown != "drop":
        raise ValueError("on_unknown must be 'drop' or 'prior'")
    prior = [F.lit(p).cast("double") for p in model.prior]
    return sums.select(id_col, F.array(*[F.col(f"_s{i}") + prior[i] for i in range(C)]).alias("scores"))


def score(model: NaiveBayesModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          on_unknown: str = "drop") -> DataFrame:
    """Long form ``(id, class, score)``."""
    cls = F.array(*[F.lit(c) for c in model.classes])
    s = score_arrays(model, docs, id_col, text_col, on_unknown)
    z = F.arrays_zip(cls.alias("class"), F.col("scores").alias("score"))
    return s.select(id_col, F.explode(z).alias("z")).select(
        id_col, F.col("z.class").alias("class"), F.col("z.score").alias("score"))


def predict(model: NaiveBayesModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            on_unknown: str = "drop") -> DataFrame:
    """``(id, label)``: best class per document, ties to the smallest class name."""
    cls = F.array(*[F.lit(c) for c in model.classes])
    s = score_arrays(model, docs, id_col, text_col, on_unknown)
    best = F.array_position(F.col("scores"), F.array_max("scores"))
    return s.select(id_col, F.element_at(cls, best.cast("int")).alias("label"))


def multilabel_accuracy(pred: DataFrame, truth: DataFrame, id_col: str = "doc_id",
                        label_col: str = "label", truth_col: str = "classes") -> DataFrame:
    """Share of predicted documents whose prediction is any of their true classes.

    One row ``(n, correct, accuracy)``; documents without a truth row are not counted.
    """
    j = pred.join(truth.select(id_col, truth_col), id_col)
    hit = F.coalesce(F.array_contains(truth_col, F.col(label_col)), F.lit(False)).cast("long")
    return j.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("correct")).select(
        "n", F.coalesce("correct", F.lit(0)).alias("correct"),
        (F.col("correct") / F.col("n")).alias("accuracy"))
