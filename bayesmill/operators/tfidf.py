"""Term frequency, document frequency, IDF and TF-IDF over a document table.

Plan shape (documents ``(doc_id, text)``):

* documents are hash-partitioned by ``doc_id`` once (a shuffle of the raw
  text, far smaller than the exploded term rows), into tasks of a bounded
  number of characters; the per-(doc, term) count then runs inside that
  partitioning with no further exchange,
* document frequency is a partial + final aggregate by ``term`` (hot terms are
  pre-combined map side, so a term in every document costs one row per task),
* ``tfidf`` joins TF with IDF on ``term``; the heaviest terms are salted over
  several tasks (``operators/skew.py``); the join strategy is Spark's: the IDF
  side is broadcast only when its measured size is under the threshold,
  otherwise sort-merge, with AQE splitting what stays skewed,
* the whole chain, ``tfidf_table``, saves blocks of documents and brings the
  document frequencies back to them (``operators/term_blocks.py``); its (doc,
  term) rows are neither shuffled nor saved.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bayesmill.functions.stem import normalize_terms
from bayesmill.functions.text import filtered_tokens, with_terms
from bayesmill.operators import term_blocks
from bayesmill.operators.skew import salted_lookup_join
from bayesmill.session import ensure_checkpoint_dir

TASK_CHARS = 4 << 20     # of text that a task counts by document and term


def explode_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stop_words: Iterable[str] | None = None, grams: Sequence[int] = (1, 2),
                  sep: str = "", keep: Sequence[str] = (), stem: bool = False,
                  lemmas: DataFrame | dict[str, str] | None = None) -> DataFrame:
    """One row per term occurrence: ``(id, *keep, term)``.

    ``explode_outer`` on the computed bag, then a null filter: a plain
    ``explode`` of a computed array lets the optimizer infer a ``size(bag) > 0``
    filter and push a second copy of the whole tokenizer below it.
    """
    if stem:
        counts = stemmed_freq(docs, id_col, text_col, stop_words, grams, sep, keep, lemmas)
        return counts.select(id_col, *keep, F.explode(F.array_repeat("term", F.col("tf").cast("int"))).alias("term"))
    bags = with_terms(docs.select(id_col, *keep, text_col), text_col, "_bag", stop_words, grams, sep)
    return (bags.select(F.col(id_col), *[F.col(k) for k in keep], F.explode_outer("_bag").alias("term"))
            .where(F.col("term").isNotNull()))


def stemmed_freq(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 stop_words: Iterable[str] | None = None, grams: Sequence[int] = (1, 2), sep: str = "",
                 keep: Sequence[str] = (), lemmas: DataFrame | dict[str, str] | None = None) -> DataFrame:
    """``term_freq`` over lemmas and stems.

    Words are normalised as a table: the distinct words are stemmed, each once,
    and meet the documents again by blocks (``term_blocks``), so no row of a
    word occurrence is shuffled. Rows of an id that comes more than once are
    one text, its words by position; for them occurrences are shuffled.
    """
    many = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select(F.col(id_col).alias("_id"))
    if not many.limit(1).count():
        return term_blocks.stemmed_counts(docs, id_col, text_col, stop_words, grams, sep, keep, lemmas)
    many = materialize(many)
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    once = term_blocks.stemmed_counts(docs.join(many, same, "left_anti"), id_col, text_col, stop_words, grams, sep, keep, lemmas)
    rows = _stemmed_by_position(docs.join(many, same, "left_semi"), id_col, text_col, stop_words, grams, sep, keep, lemmas)
    return once.unionByName(rows.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf")))


def _stemmed_by_position(docs: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] | None, grams: Sequence[int],
                         sep: str, keep: Sequence[str], lemmas: DataFrame | dict[str, str] | None) -> DataFrame:
    """One row per term occurrence: n-grams are a word and its followers in the document, read by position."""
    words = docs.select(id_col, *keep, filtered_tokens(text_col, stop_words).alias("_tokens"))
    rows = (words.select(id_col, *keep, F.posexplode_outer("_tokens").alias("_pos", "term"))
            .where(F.col("term").isNotNull()))
    stems = salted_lookup_join(rows, normalize_terms(rows, lemmas=lemmas), "term", "n", "_pos")
    sizes = sorted(set(grams))
    place = Window.partitionBy(id_col).orderBy("_pos")
    run = [F.col("norm"), *[F.lead("norm", k).over(place) for k in range(1, sizes[-1])]]
    runs = stems.select(id_col, *keep, *[w.alias(f"_w{k}") for k, w in enumerate(run)])
    terms = [F.when(F.col(f"_w{n - 1}").isNotNull(), F.concat_ws(sep, *[f"_w{k}" for k in range(n)])) for n in sizes]
    return runs.select(id_col, *keep, F.explode(F.array(*terms)).alias("term")).where(F.col("term").isNotNull())


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` hash-partitioned by id into tasks of about TASK_CHARS characters each, however large the table is.

    A term count holds some thirty bytes a character of its task, so the number
    of tasks has to grow with the text; a fixed number of shuffle partitions
    (or partitions coalesced to a size for plain shuffles) would let it grow.
    """
    chars = docs.agg(F.sum(F.length(text_col).cast("long"))).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(max(tasks, -(-chars // TASK_CHARS)), id_col)


def term_freq(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stop_words: Iterable[str] | None = None, grams: Sequence[int] = (1, 2),
              sep: str = "", keep: Sequence[str] = (), prepartitioned: bool = False,
              stem: bool = False, lemmas: DataFrame | dict[str, str] | None = None) -> DataFrame:
    """Raw count per (document, term): ``(id, *keep, term, tf long)``.

    ``keep`` columns must be functionally dependent on the id (e.g. its labels).
    """
    if stem:
        return stemmed_freq(docs, id_col, text_col, stop_words, grams, sep, keep, lemmas)
    src = docs if prepartitioned else by_document(docs, id_col, text_col)
    rows = explode_terms(src, id_col, text_col, stop_words, grams, sep, keep)
    return rows.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(tf: DataFrame) -> DataFrame:
    """Documents containing each term: ``(term, df long)``; TF rows are distinct per doc."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_doc_freq(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    stop_words: Iterable[str] | None = None, grams: Sequence[int] = (1, 2), sep: str = "") -> DataFrame:
    """``(term, df long)`` straight from the documents (one row each): a document's distinct terms are found in its
    own row, so no text is shuffled and no (document, term) count is made."""
    bags = with_terms(docs.select(id_col, text_col), text_col, "_bag", stop_words, grams, sep)
    rows = bags.select(F.explode_outer(F.array_distinct("_bag")).alias("term")).where(F.col("term").isNotNull())
    return doc_freq(rows)


def idf(df_table: DataFrame, n_docs, *keep: str) -> DataFrame:
    """``idf = ln((N + 1) / (df + 1))`` with N the number of documents (a scalar column or int)."""
    n = n_docs if not isinstance(n_docs, int) else F.lit(n_docs)
    return df_table.select(
        *keep, "term", "df",
        F.ln((n.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0)).alias("idf"),
    )


def count_docs(docs: DataFrame):
    """Number of documents as a scalar-subquery column (evaluated once, never collected by us)."""
    return docs.select(F.count(F.lit(1))).scalar()


def tfidf(tf: DataFrame, idf_table: DataFrame, id_col: str = "doc_id", sqrt: bool = False,
          keep: Sequence[str] = ()) -> DataFrame:
    """``(id, *keep, term, tf, idf, tfidf)``; ``sqrt=True`` gives the square-root damped variant.

    Frequent terms are salted (``salted_lookup_join``), so the rows of a term
    found in most documents are spread over tasks by its share of all rows.
    """
    j = salted_lookup_join(tf, idf_table.select("term", "df", "idf"), "term", "df", id_col).drop("df")
    return _weighted(j, id_col, *keep, sqrt=sqrt)


def _weighted(rows: DataFrame, *keys: str, sqrt: bool) -> DataFrame:
    w = F.col("tf") * F.col("idf")
    if sqrt:
        w = F.pow(w, 0.5)
    return rows.select(*keys, "term", "tf", "idf", w.alias("tfidf"))


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint under ``spark.checkpoint.dir``: computed once, lineage cut.

    Used for tables read by several branches of a plan (TF feeds both the DF
    aggregate and the TF-IDF join), so the tokenizer runs once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tfidf_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stop_words: Iterable[str] | None = None, grams: Sequence[int] = (1, 2),
                sep: str = "", sqrt: bool = False, checkpoint: bool = True) -> DataFrame:
    """Whole chain: documents -> TF -> DF -> IDF -> TF-IDF. Documents are saved in blocks of words (``term_blocks``); with
    ``checkpoint=False`` nothing is saved, and the (doc, term) rows are counted twice and shuffled by term."""
    if not checkpoint:
        tf = term_freq(docs, id_col, text_col, stop_words, grams, sep)
        return tfidf(tf, idf(doc_freq(tf), count_docs(docs)), id_col, sqrt)
    rows = term_blocks.counted(docs, id_col, text_col, stop_words, grams, sep)
    return _weighted(idf(rows, count_docs(docs), id_col, "tf"), id_col, sqrt=sqrt)
