"""Registered evaluation, batching and ordering jobs with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bayesmill.functions.draws import sql_uniform
from bayesmill.operators import evaluate as EV
from bayesmill.operators import order as O
from bayesmill.session import scratch_path
from bayesmill.sources import tables as T
from bayesmill.sources.lines import read_int_lines, read_lines_indexed, write_lines, write_manifest

R = 6
BATCH = 32
SEED, EPOCH = 0, 1
REQUEST_SEED = 1
MANIFEST_PREFIX = "https://data.example.org/images/"


def top1_pred(spark: SparkSession, sf: str) -> DataFrame:
    p = EV.top1_pred(T.class_scores(spark, sf))
    return p.select("id", F.col("target").cast("long").alias("target"), F.col("pred").cast("long").alias("pred"))


def saved_predictions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    EV.save_predictions(T.class_scores(spark, sf), path)
    return spark.read.parquet(path).select("id", F.col("target").cast("long").alias("target"), F.col("pred").cast("long").alias("pred"))


def topk_error(spark: SparkSession, sf: str) -> DataFrame:
    e = EV.topk_error(T.class_scores(spark, sf), 5)
    return e.select("n", F.round("top1_err", R).alias("top1_err"), F.round("top5_err", R).alias("top5_err"))


def crop_sum(spark: SparkSession, sf: str) -> DataFrame:
    s = EV.crop_sum(T.crop_scores(spark, sf))
    return s.select("id", F.posexplode("scores").alias("class", "score")).select(
        "id", F.col("class").cast("long").alias("class"), F.round("score", R).alias("score"))


def shuffle_batches(spark: SparkSession, sf: str) -> DataFrame:
    ids = T.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    return O.shuffle_batches(ids, "id", BATCH, 1, SEED, EPOCH)


EPOCHS = 3


def epoch_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The order of several epochs over one dense index."""
    ids = T.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    indexed = O.with_row_index(ids, ["id"])
    epochs = indexed.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(EPOCHS).cast("long"))))
    out = O.epoch_batches(epochs, ids.count(), BATCH, 1, SEED, F.col("epoch").cast("string"))
    return out.select("id", "epoch", "perm_index", "batch")


def row_by_index(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the corpus by their index (the ids of the labels serve as indexes), with the number of rows."""
    docs = O.with_row_index(T.read_table(spark, sf, "documents").select("doc_id"), ["doc_id"])
    wanted = T.read_table(spark, sf, "labels").select(F.col("doc_id").alias("row_index"))
    size = T.read_table(spark, sf, "documents").select(F.count(F.lit(1))).scalar()
    return O.rows_at(docs, wanted).select("row_index", "doc_id", size.alias("n_rows"))


def weighted_mean(spark: SparkSession, sf: str) -> DataFrame:
    summed = EV.crop_sum(T.crop_scores(spark, sf))
    b = O.shuffle_batches(summed, "id", BATCH, 1, SEED, EPOCH)
    w = EV.weighted_mean(EV.batch_errors(b))
    return w.select("n_batches", F.col("n").cast("long").alias("n"),
                    F.round("top1_err", R).alias("top1_err"), F.round("top5_err", R).alias("top5_err"))


def reorder_predictions(spark: SparkSession, sf: str) -> DataFrame:
    cs = T.crop_scores(spark, sf)
    pred = cs.select((F.col("id") * T.N_CROPS + F.col("crop")).alias("pos"), "id", EV.top1("scores").alias("pred"))
    ids = T.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    req = O.shuffle_batches(ids, "id", BATCH, 1, REQUEST_SEED, EPOCH).select(F.col("perm_index").alias("pos"), "id")
    out = O.reorder_predictions(pred, req, "id", "pred", "pos")
    return out.select("pos", "id", F.col("pred").cast("long").alias("pred"))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    ids = T.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"))
    return O.manifest(ids, "image_id", MANIFEST_PREFIX, ".png", 5)


def manifest_file(spark: SparkSession, sf: str) -> DataFrame:
    """An id file in request order, its manifest written in that order, and read back with line numbers."""
    base = scratch_path(spark, "manifest")
    ids = T.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    request = O.shuffle_batches(ids, "id", BATCH, 1, REQUEST_SEED, EPOCH)
    write_lines(request.select(F.lpad(F.col("id").cast("string"), 12, "0").alias("v"), "perm_index"), f"{base}/ids", "perm_index")
    write_manifest(read_int_lines(spark, f"{base}/ids", "pos", "id"), f"{base}/urls", "id", MANIFEST_PREFIX)
    return read_lines_indexed(spark, f"{base}/urls")


QUERIES = {
    "top1_pred": top1_pred,
    "saved_predictions": saved_predictions,
    "topk_error": topk_error,
    "crop_sum": crop_sum,
    "shuffle_batches": shuffle_batches,
    "epoch_batches": epoch_batches,
    "row_by_index": row_by_index,
    "weighted_mean": weighted_mean,
    "reorder_predictions": reorder_predictions,
    "manifest": manifest,
    "manifest_file": manifest_file,
}


# ---------------------------------------------------------------- oracle SQL

_SC = (
    "cls AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS k FROM (SELECT DISTINCT label FROM embeddings)), "
    "dims AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings), "
    "cent AS (SELECT c.k, d.i, avg(CAST(d.x AS DOUBLE)) AS m FROM dims d JOIN cls c ON d.label = c.label GROUP BY c.k, d.i), "
    "edims AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings), "
    "sc AS (SELECT e.vec_id AS id, ce.k, sum(CAST(e.x AS DOUBLE) * ce.m) AS s FROM edims e JOIN cent ce ON e.i = ce.i "
    "GROUP BY e.vec_id, ce.k), "
    "tgt AS (SELECT vec_id AS id, label AS target FROM embeddings), "
    "nk AS (SELECT count(*) AS nk FROM cls), "
    "crops AS (SELECT sc.id, cr.crop, sc.k, sc.s + 0.001 * CAST((((sc.id * 7 + cr.crop * 13 + sc.k * 31) % 17) - 8) AS DOUBLE) AS s "
    "FROM sc CROSS JOIN (SELECT unnest(range(0, 10)) AS crop) cr), "
    "csum AS (SELECT id, k, sum(s) AS s FROM crops GROUP BY id, k)"
)


def _rank_sql(scores: str) -> str:
    return (f"rk AS (SELECT t.id, 1 + (SELECT count(*) FROM {scores} o WHERE o.id = t.id AND o.s > "
            f"(SELECT s FROM {scores} x WHERE x.id = t.id AND x.k = t.target)) AS rank FROM tgt t)")


def _perm_sql(seed: int, src: str) -> str:
    return (f"perm AS (SELECT id, row_number() OVER (ORDER BY {sql_uniform(seed, EPOCH, 'id', 0)}, id) - 1 AS perm_index "
            f"FROM {src})")


_TOP1 = (f"WITH {_SC} SELECT p.id, CAST(t.target AS BIGINT) AS target, CAST(p.k AS BIGINT) AS pred FROM "
         "(SELECT id, k, row_number() OVER (PARTITION BY id ORDER BY s DESC, k) AS rn FROM sc) p "
         "JOIN tgt t ON p.id = t.id WHERE rn = 1")

def _rounds_sql(x: str) -> str:
    """One pass of the keyed permutation over ``x`` with ``a``, ``b`` and ``epoch`` at hand, round by round in nested selects."""
    draw = lambda value, step: f"CAST(('0x' || substr(md5(concat_ws(':', '{SEED}', CAST(epoch AS VARCHAR), CAST({value} AS VARCHAR), '{step}')), 1, 8)) AS BIGINT)"
    sql = f"SELECT * EXCLUDE (x), x // b AS l, x % b AS r FROM ({x})"
    for step in range(O.ROUNDS):
        sql = (f"SELECT * REPLACE ((l + {draw('r', step)}) % a AS l) FROM ({sql})" if step % 2 == 0
               else f"SELECT * REPLACE ((r + {draw('l', step)}) % b AS r) FROM ({sql})")
    return f"SELECT * EXCLUDE (l, r), l * b + r AS x FROM ({sql})"


_EPOCHS = ("WITH RECURSIVE n AS (SELECT count(*) AS n FROM embeddings), d AS (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM n), "
           "i AS (SELECT vec_id AS id, n, a, (n + a - 1) // a AS b, unnest(range(1, 4)) AS epoch, row_number() OVER (ORDER BY vec_id) - 1 AS x FROM embeddings, d), "
           f"w AS ({_rounds_sql('SELECT * FROM i')} UNION ALL {_rounds_sql('SELECT * FROM w WHERE x >= n')}) "
           f"SELECT id, epoch, x AS perm_index, x // {BATCH} AS batch FROM w WHERE x < n")

SQL = {
    "epoch_batches": _EPOCHS,
    "row_by_index": "WITH i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index, count(*) OVER () AS n_rows FROM documents) "
                    "SELECT i.row_index, i.doc_id, i.n_rows FROM i JOIN labels ON labels.doc_id = i.row_index",
    "top1_pred": _TOP1,
    "saved_predictions": _TOP1,
    "topk_error": f"WITH {_SC}, {_rank_sql('sc')} SELECT count(*) AS n, "
                  "round(100.0 * (1.0 - avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END)), 6) AS top1_err, "
                  "round(100.0 * (1.0 - avg(CASE WHEN rank <= least(5, (SELECT nk FROM nk)) THEN 1.0 ELSE 0.0 END)), 6) "
                  "AS top5_err FROM rk",
    "crop_sum": f"WITH {_SC} SELECT id, CAST(k AS BIGINT) AS class, round(s, 6) AS score FROM csum",
    "shuffle_batches": f"WITH ids AS (SELECT vec_id AS id FROM embeddings), {_perm_sql(SEED, 'ids')} "
                       f"SELECT id, perm_index, CAST(floor(perm_index / {BATCH}) AS BIGINT) AS batch FROM perm",
    "weighted_mean": f"WITH {_SC}, {_rank_sql('csum')}, {_perm_sql(SEED, 'tgt')}, "
                     f"b AS (SELECT CAST(floor(p.perm_index / {BATCH}) AS BIGINT) AS batch, r.rank FROM perm p "
                     "JOIN rk r ON p.id = r.id), "
                     "be AS (SELECT batch, count(*) AS n, "
                     "100.0 * (1.0 - avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END)) AS top1_err, "
                     "100.0 * (1.0 - avg(CASE WHEN rank <= least(5, (SELECT nk FROM nk)) THEN 1.0 ELSE 0.0 END)) AS top5_err "
                     "FROM b GROUP BY batch) "
                     "SELECT count(*) AS n_batches, sum(n)::BIGINT AS n, round(sum(top1_err * n) / sum(n), 6) AS top1_err, "
                     "round(sum(top5_err * n) / sum(n), 6) AS top5_err FROM be",
    "reorder_predictions": f"WITH {_SC}, pc AS (SELECT id, crop, k, row_number() OVER (PARTITION BY id, crop "
                           "ORDER BY s DESC, k) AS rn FROM crops), "
                           "pred AS (SELECT id * 10 + crop AS pos, id, k AS pred FROM pc WHERE rn = 1), "
                           "last AS (SELECT id, arg_max(pred, pos) AS pred FROM pred GROUP BY id), "
                           "ids AS (SELECT vec_id AS id FROM embeddings), "
                           f"{_perm_sql(REQUEST_SEED, 'ids')} "
                           "SELECT p.perm_index AS pos, p.id, CAST(l.pred AS BIGINT) AS pred FROM perm p "
                           "LEFT JOIN last l ON p.id = l.id",
    "manifest_file": f"WITH ids AS (SELECT vec_id AS id FROM embeddings), {_perm_sql(REQUEST_SEED, 'ids')} "
                     f"SELECT perm_index AS line_no, '{MANIFEST_PREFIX}' || CASE WHEN length(CAST(id AS VARCHAR)) < 5 "
                     "THEN lpad(CAST(id AS VARCHAR), 5, '0') ELSE CAST(id AS VARCHAR) END || '.png' AS value FROM perm",
    "manifest": f"SELECT vec_id AS image_id, '{MANIFEST_PREFIX}' || CASE WHEN length(CAST(vec_id AS VARCHAR)) < 5 THEN lpad(CAST(vec_id AS VARCHAR), 5, '0') ELSE CAST(vec_id AS VARCHAR) END || '.png' "
                "AS url FROM embeddings",
}
