"""Registered byte-feature, source and row-identity jobs with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.functions.bytes import byte_tokens as byte_tokens_expr
from bayesmill.functions.bytes import file_id as file_id_expr
from bayesmill.operators import byte_model
from bayesmill.operators import bytegrams as BG
from bayesmill.operators import order as O
from bayesmill.session import scratch_path
from bayesmill.sources import tables as T
from bayesmill.sources.files import FOLDER_FILES, each_folder, folder_batches, read_whole_files, write_whole_files
from bayesmill.sources.lines import read_csv_first_column, read_lines_indexed, write_lines

R = 6
GRAMS = (1, 2)
MIN_FREQ = 200


def byte_tokens(spark: SparkSession, sf: str) -> DataFrame:
    f = T.byte_files(spark, sf)
    t = f.select(file_id_expr("path").alias("file_id"), byte_tokens_expr("content").alias("t"))
    return t.select("file_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("long").alias("n_tokens"),
                    F.size(F.filter("t", lambda x: x == "??")).cast("long").alias("n_unknown"))


def file_id(spark: SparkSession, sf: str) -> DataFrame:
    f = T.byte_files(spark, sf)
    return f.select("path", file_id_expr("path").alias("file_id"))


def ngram_freq(spark: SparkSession, sf: str) -> DataFrame:
    return BG.ngram_freq(T.byte_files(spark, sf), GRAMS, MIN_FREQ)


def _zipped_labels(spark, sf):
    """The id file and the label file written as CSV (rows in doc_id order),
    read back with file-order line numbers and zipped by position."""
    base = scratch_path(spark, "labels")
    write_lines(T.byte_id_lines(spark, sf).select(F.col("id").alias("v"), "doc_id"), f"{base}/ids", "doc_id")
    write_lines(T.byte_label_lines(spark, sf).select(F.col("label").alias("v"), "doc_id"), f"{base}/labels", "doc_id")
    ids = read_csv_first_column(spark, f"{base}/ids", "pos", "id")
    labs = read_csv_first_column(spark, f"{base}/labels", "pos", "label")
    z = ids.join(labs, "pos")
    return z.select("pos", F.col("id").alias("file_id"), "label")


def positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    return _zipped_labels(spark, sf)


def byte_features(spark: SparkSession, sf: str) -> DataFrame:
    return BG.byte_features(T.byte_files(spark, sf), _zipped_labels(spark, sf), GRAMS, MIN_FREQ)


def byte_features_map(spark: SparkSession, sf: str) -> DataFrame:
    """The per-file map form, written out in the order of its grams."""
    m = BG.as_map(byte_features(spark, sf))
    pairs = F.transform(F.sort_array(F.map_entries("grams")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return m.select("file_id", "label", F.array_join(pairs, ",").alias("grams"))


def byte_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    t = BG.byte_tfidf(T.byte_files(spark, sf), (1, 2, 3))
    return t.select("file_id", "gram", "tf", F.round("tfidf", R).alias("tfidf"))


def row_index(spark: SparkSession, sf: str) -> DataFrame:
    d = T.read_table(spark, sf, "documents").select("doc_id")
    return O.with_row_index(d, ["doc_id"])


def src_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line source: the corpus written one document per line (in doc_id order),
    read back with dense line numbers in file order."""
    path = scratch_path(spark, "lines")
    d = T.corpus(spark, sf).select(F.regexp_replace("text", "[\r\n]", " ").alias("value"), "doc_id")
    write_lines(d.select("value", "doc_id"), path, "doc_id")
    return read_lines_indexed(spark, path)


def src_whole_files(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-file source: one byte-dump file per document, read back whole, its name and id from its real path."""
    path = scratch_path(spark, "whole_files")
    folders = _files_on_disk(spark, sf)

    def read(k: int, folder: str) -> None:
        r = read_whole_files(spark, folder, "*.bytes")
        named = r.select(file_id_expr("path").alias("file_id"), F.substring_index("path", "/", -1).alias("file_name"), F.length("content").cast("long").alias("n_chars"))
        named.write.parquet(f"{path}/{k:05d}")

    each_folder(spark, folders, read)
    return spark.read.schema("file_id string, file_name string, n_chars long").parquet(*[f"{path}/{k:05d}" for k in range(len(folders))])


def _files_on_disk(spark, sf) -> list[str]:
    """Folders of the byte files under their own names."""
    path = scratch_path(spark, "bytes")
    f = T.byte_paths(spark, sf).select(F.substring_index("path", "/", -1).alias("name"), F.col("text").cast("binary").alias("text"))
    folders = max(1, -(-f.count() // FOLDER_FILES))
    write_whole_files(f, path, "name", "text", folders, T.byte_dump).write.format("noop").mode("overwrite").save()
    return folder_batches(path, folders)


def byte_features_files(spark: SparkSession, sf: str) -> DataFrame:
    """Byte features from folders of files, read by splits: path -> id -> grams -> labels."""
    return BG.byte_features_splits(spark, _files_on_disk(spark, sf), _zipped_labels(spark, sf), GRAMS, MIN_FREQ, glob="*.bytes")


def _labelled_files(spark, sf) -> DataFrame:
    """``doc_id, file_id, label, content`` of the labelled files: their text is joined and saved, not its longer byte dump."""
    files = T.byte_paths(spark, sf).withColumn("file_id", file_id_expr("path"))
    path = scratch_path(spark, "labelled")
    files.join(_zipped_labels(spark, sf), "file_id").select("doc_id", "file_id", "label", "text").write.parquet(path)
    return T.with_byte_content(spark.read.parquet(path))


def _classified(spark, sf, model: str) -> DataFrame:
    files = _labelled_files(spark, sf)
    return byte_model.fit_predict(files.where(~T.is_test_doc()), files.where(T.is_test_doc()), model)


def byte_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Multinomial logistic regression on byte n-gram TF-IDF."""
    return _classified(spark, sf, "logistic")


def byte_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Decision tree on byte n-gram TF-IDF."""
    return _classified(spark, sf, "tree")


QUERIES = {
    "byte_tokens": byte_tokens,
    "file_id": file_id,
    "ngram_freq": ngram_freq,
    "positional_zip": positional_zip,
    "byte_features": byte_features,
    "byte_features_files": byte_features_files,
    "byte_features_map": byte_features_map,
    "byte_tfidf": byte_tfidf,
    "row_index": row_index,
    "src_lines": src_lines,
    "src_whole_files": src_whole_files,
    "byte_classifier": byte_classifier,
    "byte_tree": byte_tree,
}


# ---------------------------------------------------------------- oracle SQL

_BF = ("bf AS (SELECT doc_id, '/data/bytes/' || md5(CAST(doc_id AS VARCHAR)) || '.bytes' AS path, "
       "'00401000 ' || regexp_replace(replace(regexp_replace(hex(text), '(..)', '\\1 ', 'g'), '0A ', '?? '), "
       "'((?:\\S\\S ){16})', '\\1' || chr(13) || chr(10) || '00401000 ', 'g') AS content FROM documents)")
_TOKS = ("bt AS (SELECT right(split_part(path, '.', 1), 20) AS file_id, "
         "list_filter(regexp_split_to_array(replace(content, chr(13) || chr(10), ' '), '\\s+'), "
         "lambda x: length(x) = 2) AS t FROM bf)")


def _gram_occ(grams) -> str:
    arms = []
    for n in grams:
        if n == 1:
            arms.append("SELECT file_id, unnest(t) AS gram FROM bt")
        else:
            parts = ", ".join(f"t[i + {k}]" for k in range(n))
            g = (f"CASE WHEN len(t) < {n} THEN []::VARCHAR[] ELSE list_transform(range(1, len(t) - {n} + 2), "
                 f"lambda i: concat_ws('', {parts})) END")
            arms.append(f"SELECT file_id, unnest({g}) AS gram FROM bt")
    return "occ AS (" + " UNION ALL ".join(arms) + ")"


_ZIP = ("ids AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, substr(md5(CAST(doc_id AS VARCHAR)), 13, 20) AS id "
        "FROM labels), labs AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, "
        "CAST(1 + quality * 2 + toxic AS VARCHAR) AS label FROM labels), "
        "z AS (SELECT ids.pos, ids.id AS file_id, labs.label FROM ids JOIN labs ON ids.pos = labs.pos)")

_FREQ = f"WITH {_BF}, {_TOKS}, {_gram_occ(GRAMS)}, freq AS (SELECT file_id, gram, count(*) AS freq FROM occ " \
        f"GROUP BY file_id, gram HAVING count(*) >= {MIN_FREQ})"

SQL = {
    "byte_tokens": f"WITH {_BF}, {_TOKS} SELECT file_id, array_to_string(t, ' ') AS tokens, len(t)::BIGINT AS n_tokens, "
                   "len(list_filter(t, lambda x: x = '??'))::BIGINT AS n_unknown FROM bt",
    "file_id": f"WITH {_BF} SELECT path, right(split_part(path, '.', 1), 20) AS file_id FROM bf",
    "src_whole_files": f"WITH {_BF} SELECT right(split_part(path, '.', 1), 20) AS file_id, split_part(path, '/', -1) AS file_name, "
                       "CAST(length(content) AS BIGINT) AS n_chars FROM bf",
    "ngram_freq": _FREQ + " SELECT file_id, gram, freq FROM freq",
    "positional_zip": f"WITH {_ZIP} SELECT pos, file_id, label FROM z",
    "byte_features": _FREQ + f", {_ZIP} SELECT freq.file_id, freq.gram, freq.freq, z.label FROM freq "
                     "JOIN z ON freq.file_id = z.file_id",
    "byte_tfidf": f"WITH {_BF}, {_TOKS}, {_gram_occ((1, 2, 3))}, tf AS (SELECT file_id, gram, count(*) AS tf FROM occ "
                  "GROUP BY file_id, gram), n AS (SELECT count(*) AS n FROM documents), "
                  "dfq AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram) "
                  "SELECT tf.file_id, tf.gram, tf.tf, round(tf.tf * ln((n.n + 1.0) / (dfq.df + 1.0)), 6) AS tfidf "
                  "FROM tf JOIN dfq ON tf.gram = dfq.gram CROSS JOIN n",
    "byte_features_map": _FREQ + f", {_ZIP} SELECT freq.file_id, z.label, string_agg(freq.gram || '=' || freq.freq, ',' ORDER BY freq.gram) AS grams "
                         "FROM freq JOIN z ON freq.file_id = z.file_id GROUP BY freq.file_id, z.label",
    "byte_features_files": _FREQ + f", {_ZIP} SELECT freq.file_id, freq.gram, freq.freq, z.label FROM freq "
                           "JOIN z ON freq.file_id = z.file_id",
    "row_index": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents",
    "src_lines": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_no, "
                 "regexp_replace(text, '[\\r\\n]', ' ', 'g') AS value FROM documents",
}
