"""Registered text and naive Bayes jobs (``queries()`` keys) with their oracle SQL.

Every job reads the whole ``documents`` / ``labels`` tables. Computed columns
carry the same names as in the SQL; doubles are rounded to 6 places in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.functions import text as TX
from bayesmill.functions.stopwords import default_stop_words
from bayesmill.operators import naive_bayes as NB
from bayesmill.operators import tfidf as TF
from bayesmill.operators.stoplist import without_listed
from bayesmill.plans import sqlfrag as S
from bayesmill.session import scratch_path
from bayesmill.sources import tables as T
from bayesmill.sources.lines import read_lines_indexed, write_lines

R = 6  # rounding of doubles for comparison


def _joined(col: str, sep: str = " "):
    return F.array_join(F.col(col), sep)


# ---------------------------------------------------------------- text prep

def clean_tokens(spark: SparkSession, sf: str) -> DataFrame:
    d = T.corpus(spark, sf)
    t = d.select("doc_id", TX.tokenize("text").alias("t"))
    return t.select("doc_id", _joined("t").alias("tokens"), F.size("t").cast("long").alias("n_tokens"))


def stopword_filter(spark: SparkSession, sf: str) -> DataFrame:
    d = T.corpus(spark, sf)
    t = d.select("doc_id", TX.remove_stop_words(TX.tokenize("text")).alias("t"))
    return t.select("doc_id", _joined("t").alias("tokens"), F.size("t").cast("long").alias("n_tokens"))


def stopword_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same filter with the list as a table."""
    d = T.corpus(spark, sf).select("doc_id", TX.tokenize("text").alias("tokens"))
    listed = spark.createDataFrame([(w,) for w in default_stop_words()], "word string")
    t = without_listed(d, listed)
    return t.select("doc_id", _joined("tokens").alias("tokens"), F.size("tokens").cast("long").alias("n_tokens"))


def _filtered_tokens(spark, sf):
    d = T.corpus(spark, sf)
    return d.select("doc_id", TX.remove_stop_words(TX.tokenize("text")).alias("t"))


def bigrams(spark: SparkSession, sf: str) -> DataFrame:
    b = _filtered_tokens(spark, sf).select("doc_id", TX.bigrams(F.col("t")).alias("g"))
    return b.select("doc_id", _joined("g").alias("bigrams"), F.size("g").cast("long").alias("n_bigrams"))


def ngrams(spark: SparkSession, sf: str) -> DataFrame:
    t = _filtered_tokens(spark, sf)
    parts = F.array(*[F.struct(F.lit(n).alias("n"), TX.ngrams(F.col("t"), n, " ").alias("g")) for n in (1, 2, 3)])
    e = t.select("doc_id", F.explode(parts).alias("p"))
    return e.select("doc_id", F.col("p.n").cast("long").alias("n"), _joined("p.g", "|").alias("grams"),
                    F.size("p.g").cast("long").alias("n_grams"))


def term_bag(spark: SparkSession, sf: str) -> DataFrame:
    b = TX.with_terms(T.corpus(spark, sf), "text", "bag")
    return b.select("doc_id", _joined("bag").alias("terms"), F.size("bag").cast("long").alias("n_terms"))


# ---------------------------------------------------------------- labels

def label_sets(spark: SparkSession, sf: str) -> DataFrame:
    ls = T.label_sets(spark, sf)
    return ls.select("doc_id", F.array_join("classes", ",").alias("classes"),
                     F.size("classes").cast("long").alias("n_classes"))


def label_explode(spark: SparkSession, sf: str) -> DataFrame:
    return T.label_sets(spark, sf).select("doc_id", F.explode("classes").alias("class"))


# ---------------------------------------------------------------- tf-idf

def term_freq(spark: SparkSession, sf: str) -> DataFrame:
    return TF.term_freq(T.corpus(spark, sf))


def doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    return TF.corpus_doc_freq(T.corpus(spark, sf))


def idf(spark: SparkSession, sf: str) -> DataFrame:
    docs = T.corpus(spark, sf)
    t = TF.idf(TF.corpus_doc_freq(docs), TF.count_docs(docs))
    return t.select("term", "df", F.round("idf", R).alias("idf"))


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return TF.corpus_doc_freq(T.corpus(spark, sf)).agg(F.count(F.lit(1)).alias("vocab_size"))


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    t = TF.tfidf_table(T.corpus(spark, sf))
    return t.select("doc_id", "term", "tf", F.round("tfidf", R).alias("tfidf"))


def tfidf_sqrt(spark: SparkSession, sf: str) -> DataFrame:
    """The square-root damped variant."""
    t = TF.tfidf_table(T.corpus(spark, sf), sqrt=True)
    return t.select("doc_id", "term", "tf", F.round("tfidf", R).alias("tfidf"))


def tfidf_labeled(spark: SparkSession, sf: str) -> DataFrame:
    """Only labelled documents' terms meet the IDF table; N and df are of all documents."""
    docs = T.corpus(spark, sf)
    lab = T.label_sets(spark, sf).where(F.size("classes") > 0)
    weights = TF.idf(TF.corpus_doc_freq(docs), TF.count_docs(docs))
    tf = TF.term_freq(TF.by_document(docs).join(lab, "doc_id"), keep=["classes"], prepartitioned=True)
    j = TF.tfidf(tf, weights, keep=["classes"])
    return j.select("doc_id", "term", F.explode("classes").alias("class"), F.round("tfidf", R).alias("tfidf"))


# ---------------------------------------------------------------- naive Bayes

def fit_model(spark: SparkSession, sf: str) -> NB.NaiveBayesModel:
    return NB.fit(T.train_docs(spark, sf), T.label_sets(spark, sf), T.CLASSES)


def _class_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return NB.class_statistics(T.train_docs(spark, sf), T.label_sets(spark, sf), T.CLASSES)


def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _class_statistics(spark, sf).select("class", "class_docs")


def class_prior(spark: SparkSession, sf: str) -> DataFrame:
    return _class_statistics(spark, sf).select("class", F.round("prior", R).alias("prior"))


def class_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    return fit_model(spark, sf).class_table().select("class", F.col("pair_count").cast("long").alias("pair_count"))


def class_term_sums(spark: SparkSession, sf: str) -> DataFrame:
    m = fit_model(spark, sf)
    cls = F.array(*[F.lit(c) for c in m.classes])
    z = F.arrays_zip(cls.alias("class"), F.col("tf_by_class").alias("tfc"), F.col("docs_by_class").alias("dc"))
    e = m.terms.select("term", "idf", F.explode(z).alias("z")).where(F.col("z.dc") > 0)
    return e.select(F.col("z.class").alias("class"), "term",
                    F.round(F.col("z.tfc") * F.col("idf"), R).alias("tfidf_sum"))


def nb_model(spark: SparkSession, sf: str) -> DataFrame:
    lf = fit_model(spark, sf).long_form()
    return lf.select("term", "class", F.round("logp", R).alias("logp"))


def nb_scores(spark: SparkSession, sf: str) -> DataFrame:
    s = NB.score(fit_model(spark, sf), T.test_docs(spark, sf))
    return s.select("doc_id", "class", F.round("score", R).alias("score"))


def nb_predict(spark: SparkSession, sf: str) -> DataFrame:
    return NB.predict(fit_model(spark, sf), T.test_docs(spark, sf))


def multilabel_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    pred = NB.predict(fit_model(spark, sf), T.test_docs(spark, sf))
    a = NB.multilabel_accuracy(pred, T.label_sets(spark, sf))
    return a.select("n", "correct", F.round("accuracy", R).alias("accuracy"))


def term_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Lemma + Porter stem of every distinct (stop-filtered) word of the corpus."""
    from bayesmill.functions.stem import normalize_terms

    t = _filtered_tokens(spark, sf).select(F.explode_outer("t").alias("term")).where(F.col("term").isNotNull())
    return normalize_terms(t).select("term", "norm")


def nb_predict_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    """Fit and predict over Porter stems."""
    model = NB.fit(T.train_docs(spark, sf), T.label_sets(spark, sf), T.CLASSES, stem=True)
    return NB.predict(model, T.test_docs(spark, sf))


def nb_predict_file(spark: SparkSession, sf: str) -> DataFrame:
    """One prediction a line, in document order, written and read back with line numbers."""
    path = scratch_path(spark, "predictions")
    write_lines(nb_predict(spark, sf).select("label", "doc_id"), path, "doc_id")
    return read_lines_indexed(spark, path)


QUERIES = {
    "term_normalize": term_normalize,
    "clean_tokens": clean_tokens,
    "stopword_filter": stopword_filter,
    "stopword_table": stopword_table,
    "bigrams": bigrams,
    "ngrams": ngrams,
    "term_bag": term_bag,
    "label_sets": label_sets,
    "label_explode": label_explode,
    "term_freq": term_freq,
    "doc_freq": doc_freq,
    "idf": idf,
    "vocabulary": vocabulary,
    "tfidf": tfidf,
    "tfidf_sqrt": tfidf_sqrt,
    "tfidf_labeled": tfidf_labeled,
    "class_counts": class_counts,
    "class_prior": class_prior,
    "class_pair_counts": class_pair_counts,
    "class_term_sums": class_term_sums,
    "nb_model": nb_model,
    "nb_scores": nb_scores,
    "nb_predict": nb_predict,
    "nb_predict_stemmed": nb_predict_stemmed,
    "nb_predict_file": nb_predict_file,
    "multilabel_accuracy": multilabel_accuracy,
}


# ---------------------------------------------------------------- oracle SQL

def _ngram_sql(filtered: str) -> str:
    arms = []
    for n in (1, 2, 3):
        g = S.ngrams("t", n, " ")
        arms.append(f"SELECT doc_id, {n}::BIGINT AS n, array_to_string({g}, '|') AS grams, "
                    f"len({g})::BIGINT AS n_grams FROM ft")
    return f"WITH ft AS (SELECT doc_id, {filtered} AS t FROM documents) " + " UNION ALL ".join(arms)


def sql() -> dict[str, str]:
    """The oracle statements, built on request (they embed the stop-word list)."""
    tok = S.tokens("text")
    filtered = S.stop_filtered(tok)
    whole = "WITH " + S.text_ctes("TRUE")
    nb = S.nb_ctes()
    return {
        "clean_tokens": f"SELECT doc_id, array_to_string(t, ' ') AS tokens, len(t)::BIGINT AS n_tokens "
                        f"FROM (SELECT doc_id, {tok} AS t FROM documents)",
        "stopword_filter": f"SELECT doc_id, array_to_string(t, ' ') AS tokens, len(t)::BIGINT AS n_tokens "
                           f"FROM (SELECT doc_id, {filtered} AS t FROM documents)",
        "stopword_table": f"SELECT doc_id, array_to_string(t, ' ') AS tokens, len(t)::BIGINT AS n_tokens "
                          f"FROM (SELECT doc_id, {filtered} AS t FROM documents)",
        "bigrams": f"SELECT doc_id, array_to_string(g, ' ') AS bigrams, len(g)::BIGINT AS n_bigrams FROM "
                   f"(SELECT doc_id, {S.ngrams('t', 2)} AS g FROM (SELECT doc_id, {filtered} AS t FROM documents))",
        "ngrams": _ngram_sql(filtered),
        "term_bag": f"SELECT doc_id, array_to_string(b, ' ') AS terms, len(b)::BIGINT AS n_terms FROM "
                    f"(SELECT doc_id, {S.bag('t')} AS b FROM (SELECT doc_id, {filtered} AS t FROM documents))",
        "label_sets": f"SELECT doc_id, array_to_string(classes, ',') AS classes, len(classes)::BIGINT AS n_classes "
                      f"FROM ({S.LABEL_SETS})",
        "label_explode": f"SELECT doc_id, unnest(classes) AS class FROM ({S.LABEL_SETS})",
        "term_freq": whole + " SELECT doc_id, term, tf FROM tf",
        "doc_freq": whole + " SELECT term, count(*) AS df FROM tf GROUP BY term",
        "idf": whole + ", n AS (SELECT count(*) AS n FROM docs) SELECT term, count(*) AS df, "
                        "round(ln((min(n.n) + 1.0) / (count(*) + 1.0)), 6) AS idf FROM tf CROSS JOIN n GROUP BY term",
        "vocabulary": whole + " SELECT count(DISTINCT term) AS vocab_size FROM tf",
        "tfidf": whole + ", n AS (SELECT count(*) AS n FROM docs), dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term) "
                          "SELECT tf.doc_id, tf.term, tf.tf, round(tf.tf * ln((n.n + 1.0) / (dfq.df + 1.0)), 6) AS tfidf "
                          "FROM tf JOIN dfq ON tf.term = dfq.term CROSS JOIN n",
        "tfidf_sqrt": whole + ", n AS (SELECT count(*) AS n FROM docs), dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term) "
                               "SELECT tf.doc_id, tf.term, tf.tf, round(sqrt(tf.tf * ln((n.n + 1.0) / (dfq.df + 1.0))), 6) AS tfidf "
                               "FROM tf JOIN dfq ON tf.term = dfq.term CROSS JOIN n",
        "tfidf_labeled": whole + f", n AS (SELECT count(*) AS n FROM docs), dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term), "
                         f"labs AS ({S.LABEL_SETS}) SELECT tf.doc_id, tf.term, unnest(labs.classes) AS class, "
                         "round(tf.tf * ln((n.n + 1.0) / (dfq.df + 1.0)), 6) AS tfidf "
                         "FROM tf JOIN labs ON tf.doc_id = labs.doc_id JOIN dfq ON tf.term = dfq.term CROSS JOIN n",
        "class_counts": nb + "SELECT class, class_docs::BIGINT AS class_docs FROM cstat",
        "class_prior": nb + "SELECT class, round(prior, 6) AS prior FROM cstat",
        "class_pair_counts": nb + "SELECT class, pair_count::BIGINT AS pair_count FROM wq",
        "class_term_sums": nb + "SELECT class, term, round(x, 6) AS tfidf_sum FROM cts",
        "nb_model": nb + "SELECT term, class, round(logp, 6) AS logp FROM model",
        "nb_scores": nb + "SELECT doc_id, class, round(score, 6) AS score FROM scores",
        "nb_predict": nb + "SELECT doc_id, label FROM pred",
        "nb_predict_file": nb + "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_no, label AS value FROM pred",
        "multilabel_accuracy": nb + ", hits AS (SELECT p.doc_id, CASE WHEN list_contains(l.classes, p.label) "
                               "THEN 1 ELSE 0 END AS hit FROM pred p JOIN labsets l ON p.doc_id = l.doc_id) "
                               "SELECT count(*) AS n, sum(hit)::BIGINT AS correct, round(avg(hit), 6) AS accuracy FROM hits",
    }
