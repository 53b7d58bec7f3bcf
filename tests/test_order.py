import pytest
from pyspark.sql import functions as F

from bayesmill.operators import order as O


def test_row_index_dense_in_key_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(13)
    rows = O.with_row_index(df, ["k"], num_partitions=5).collect()
    assert sorted((r["row_index"], r["k"]) for r in rows) == [(i, i) for i in range(1000)]


def test_positional_zip_truncates_to_shorter(spark):
    left = spark.createDataFrame([(i, f"id{i}") for i in range(5)], "a long, id string")
    right = spark.createDataFrame([(i, f"L{i}") for i in range(3)], "b long, label string")
    z = O.positional_zip(left, right, ["a"], ["b"]).orderBy("pos").collect()
    assert [(r["id"], r["label"]) for r in z] == [("id0", "L0"), ("id1", "L1"), ("id2", "L2")]


def test_shuffle_batches_sizes_and_permutation(spark):
    ids = spark.range(0, 103).withColumnRenamed("id", "image_id")
    b = O.shuffle_batches(ids, "image_id", batch_size=20, n_crops=2, seed=3).collect()
    sizes = sorted(sum(1 for r in b if r["batch"] == k) for k in {r["batch"] for r in b})
    assert sizes == [3] + [10] * 10              # floor(20/2) = 10 per batch, the last short
    assert sorted(r["perm_index"] for r in b) == list(range(103))
    again = O.shuffle_batches(ids, "image_id", batch_size=20, n_crops=2, seed=3).collect()
    assert {r["image_id"]: r["perm_index"] for r in b} == {r["image_id"]: r["perm_index"] for r in again}


def test_reorder_later_duplicate_wins(spark):
    pred = spark.createDataFrame([(0, 7, 1), (1, 8, 2), (2, 7, 5)], "pos long, id long, pred long")
    req = spark.createDataFrame([(0, 8), (1, 7)], "pos long, id long")
    out = O.reorder_predictions(pred, req).collect()
    assert [(r["id"], r["pred"]) for r in out] == [(8, 2), (7, 5)]


def test_reorder_missing_id_fails(spark):
    pred = spark.createDataFrame([(0, 7, 1)], "pos long, id long, pred long")
    req = spark.createDataFrame([(0, 9)], "pos long, id long")
    with pytest.raises(Exception):
        O.reorder_predictions(pred, req).collect()


def test_manifest(spark):
    ids = spark.createDataFrame([(983,), (23061,)], "image_id long")
    got = [r["url"] for r in O.manifest(ids, "image_id", "https://h/images/").collect()]
    assert got == ["https://h/images/00983.png", "https://h/images/23061.png"]


def test_lines_numbered_in_file_order_across_files(spark):
    import os
    import tempfile

    from bayesmill.sources.lines import read_csv_first_column, read_lines_indexed, write_lines

    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = spark.range(0, 5000).select(F.format_string("line-%05d", "id").alias("v"), F.col("id"))
    write_lines(rows.repartition(7), os.path.join(base, "t"), "id")   # several part files
    got = read_lines_indexed(spark, os.path.join(base, "t")).collect()
    assert sorted((r["line_no"], r["value"]) for r in got) == [(i, f"line-{i:05d}") for i in range(5000)]
    write_lines(rows.select(F.concat_ws(",", "v", F.lit("x")).alias("c"), "id"), os.path.join(base, "c"), "id")
    got = read_csv_first_column(spark, os.path.join(base, "c")).collect()
    assert sorted((r["pos"], r["value"]) for r in got) == [(i, f"line-{i:05d}") for i in range(5000)]


def test_int_lines_drop_leading_zeros(spark):
    import os
    import tempfile

    from bayesmill.sources.lines import read_int_lines

    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(os.path.join(base, "ids.txt"), "w") as f:
        f.write("23061\n00983\n04470\n")
    got = [(r["pos"], r["value"]) for r in read_int_lines(spark, base).orderBy("pos").collect()]
    assert got == [(0, 23061), (1, 983), (2, 4470)]


def test_records_from_flat(spark):
    from bayesmill.sources.pixels import records_from_flat

    df = spark.createDataFrame([(1, list(range(7)))], "id long, flat array<int>")
    got = [(r["record_no"], r["record"]) for r in records_from_flat(df, "flat", 3).orderBy("record_no").collect()]
    assert got == [(0, [0, 1, 2]), (1, [3, 4, 5]), (2, [6])]


def test_manifest_keeps_long_ids_whole(spark):
    from bayesmill.operators.order import manifest

    df = spark.createDataFrame([(7,), (99999,), (100000,), (100001,)], "id long")
    got = [r["url"] for r in manifest(df, "id", "u/").orderBy("id").collect()]
    assert got == ["u/00007.png", "u/99999.png", "u/100000.png", "u/100001.png"]


def test_running_offsets_of_a_million_units(spark):
    units = spark.range(1_000_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("n"))
    off = O.running_offsets(units, "k", "n")
    week, day = F.floor(F.col("k") / 7), F.col("k") % 7
    wrong = off.where(F.col("_off") != 21 * week + day * (day - 1) / 2)
    assert off.count() == 1_000_000 and wrong.count() == 0


def test_manifest_is_written_in_id_file_order(spark, tmp_path):
    from bayesmill.sources.lines import read_int_lines, read_lines_indexed, write_manifest

    (tmp_path / "ids.txt").write_text("00983\n7\n123456\n7\n")
    write_manifest(read_int_lines(spark, str(tmp_path / "ids.txt"), "pos", "id"), str(tmp_path / "urls"), "id", "p/")
    got = read_lines_indexed(spark, str(tmp_path / "urls")).orderBy("line_no").collect()
    assert [r["value"] for r in got] == ["p/00983.png", "p/00007.png", "p/123456.png", "p/00007.png"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 17, 50, 1000, 4097])
def test_every_epoch_is_a_permutation(spark, n):
    epochs = spark.range(n).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(50))))
    out = O.epoch_batches(epochs, n, 7, 1, 5, F.col("epoch").cast("string"), "id")
    told = out.groupBy("epoch").agg(F.count_distinct("perm_index").alias("d"), F.min("perm_index").alias("low"), F.max("perm_index").alias("high"),
                                    F.sum((F.col("perm_index") == F.col("id")).cast("int")).alias("fixed"), F.count_distinct("batch").alias("b")).collect()
    assert all((r["d"], r["low"], r["high"], r["b"]) == (n, 0, n - 1, -(-n // 7)) for r in told) and len(told) == (50 if n else 0)
    if n >= 1000:
        assert max(r["fixed"] for r in told) < 20


def test_epochs_differ_and_need_no_exchange(spark):
    rows = spark.range(1000)
    one, two = (O.epoch_batches(rows, 1000, 10, 1, 0, e, "id") for e in (1, 2))
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    a, b = ({r["id"]: r["perm_index"] for r in x.collect()} for x in (one, two))
    assert sum(a[i] == b[i] for i in a) < 20 and sum(abs(a[i] - a[i + 1]) < 10 for i in range(999)) < 60
    with pytest.raises(ValueError):
        O.epoch_batches(rows, 1000, 1, 2)


def test_rows_at(spark):
    rows = O.with_row_index(spark.createDataFrame([("b",), ("a",), ("c",)], "v string"), ["v"])
    wanted = spark.createDataFrame([(2,), (0,), (0,), (9,)], "row_index long")
    assert sorted((r["row_index"], r["v"]) for r in O.rows_at(rows, wanted).collect()) == [(0, "a"), (0, "a"), (2, "c")]
