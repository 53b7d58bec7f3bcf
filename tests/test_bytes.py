import gc
import hashlib
import math
import os
import random
import threading
import weakref
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bayesmill.functions.bytes import byte_string, byte_tokens, file_id
from bayesmill.operators import bytegrams as BG
from bayesmill.plans import bytes as P
from bayesmill.sources import files as files_source
from bayesmill.sources import tables as T
from bayesmill.sources.files import read_file_lines, read_whole_files, write_whole_files


def test_tokens_keep_unknown_and_drop_address(spark):
    df = spark.createDataFrame([("00401000 56 8D ?? 24\r\n00401010 0A FF",)], "content string")
    assert df.select(byte_tokens("content").alias("t")).first()["t"] == ["56", "8D", "??", "24", "0A", "FF"]


def test_file_id_last_20_before_first_dot(spark):
    df = spark.createDataFrame([("s3://b/binaries/0A32eTdBKayjCWhZqDOQ.bytes",), ("/x/short.bytes",)], "path string")
    assert [r[0] for r in df.select(file_id("path")).collect()] == ["0A32eTdBKayjCWhZqDOQ", "short"]


def test_threshold_is_inclusive(spark):
    content = "00401000 " + " ".join(["AA"] * 200 + ["BB"] * 199)
    files = spark.createDataFrame([("/d/f1.bytes", content)], "path string, content string")
    got = {r["gram"]: r["freq"] for r in BG.ngram_freq(files, grams=(1,), min_freq=200).collect()}
    assert got == {"AA": 200}


def test_each_gram_size_counted_once(spark):
    files = spark.createDataFrame([("/d/f1.bytes", "00401000 AA BB AA BB")], "path string, content string")
    got = {r["gram"]: r["freq"] for r in BG.ngram_freq(files, grams=(1, 2), min_freq=1).collect()}
    assert got == {"AA": 2, "BB": 2, "AABB": 2, "BBAA": 1}


def test_features_join_labels(spark):
    files = spark.createDataFrame([("/d/f1.bytes", "00401000 AA AA"), ("/d/f2.bytes", "00401000 BB")],
                                  "path string, content string")
    labels = spark.createDataFrame([("f1", "3")], "file_id string, label string")
    rows = BG.byte_features(files, labels, grams=(1,), min_freq=1).collect()
    assert [(r["file_id"], r["gram"], r["freq"], r["label"]) for r in rows] == [("f1", "AA", 2, "3")]
    m = BG.as_map(BG.byte_features(files, labels, grams=(1,), min_freq=1)).first()
    assert m["grams"] == {"AA": 2}


def test_file_id_ignores_dots_of_host_and_folder(spark):
    df = spark.createDataFrame([("hdfs://nn1.example.org/b.d/one.bytes",), ("hdfs://nn1.example.org/b.d/two.bytes",)], "path string")
    assert [r[0] for r in df.select(file_id("path")).collect()] == ["one", "two"]


def test_codes_of_odd_tokens(spark):
    texts = ["", "A", "AB", "ABC", "ABCD EF G ?? \r\n00401000 12  34\tXYZ\n5", " AB ", "AB\u00a0CD \u00e9\u00e9 \U0001f600x \u2028y"]
    df = spark.createDataFrame([(t,) for t in texts], "content string")
    got = df.select(F.array_join(byte_tokens("content"), "").alias("a"), byte_string("content").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]


def test_grams_do_not_depend_on_the_chunks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(f"/d/f{n}.bytes", " ".join(rng.choice(["AA", "0B", "??"]) for _ in range(n))) for n in (0, 1, 2, 3, 4, 5, 8, 9, 41)]
    files = spark.createDataFrame(rows, "path string, content string")

    def counts():
        got = BG.ngram_freq(files, grams=(1, 2, 3), min_freq=1).collect()
        return sorted((r["file_id"], r["gram"], r["freq"]) for r in got)

    want = []
    for path, content in rows:
        t = content.split()
        for k in (1, 2, 3):
            c = Counter("".join(t[i:i + k]) for i in range(len(t) - k + 1))
            want += [(path[3:-6], g, n) for g, n in c.items()]
    assert counts() == sorted(want)
    monkeypatch.setattr(BG, "CHUNK_CODES", 4)
    assert counts() == sorted(want)


def dumps(folder, seed=5):
    """Byte files with lines of odd forms; returns the codes of each."""
    rng = random.Random(seed)
    os.makedirs(folder)
    told = {}
    for n in (0, 1, 2, 3, 7, 40, 900):
        codes = [rng.choice(["AA", "0B", "??", "é1"]) for _ in range(n)]
        lines, at = [], 0
        while at < n:
            k = rng.choice([0, 1, 2, 3, 16])
            lines.append("00401000 " + " ".join(codes[at:at + k]) + rng.choice(["", " X", "\t12345"]))
            at += k
        told[f"f{n}"] = codes
        with open(os.path.join(folder, f"f{n}.bytes"), "w", newline="") as f:
            f.write(rng.choice(["\n", "\r\n"]).join(lines))
    return told


@pytest.mark.parametrize("split", [None, 200, 20])
@pytest.mark.parametrize("sep", ["", "-"])
def test_grams_across_the_borders_of_splits(spark, tmp_path, monkeypatch, split, sep):
    told = dumps(str(tmp_path / "x"))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            monkeypatch.setattr(BG, "CHUNK_CODES", 5)
        splits = read_file_lines(spark, str(tmp_path / "x")).select("path", "start").distinct().count()
        got = BG.ngram_freq_splits(spark, str(tmp_path / "x"), (1, 2, 3, 4), 1, sep).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert splits == 6 if split is None else splits > 20
    want = {(f, g): n for f, t in told.items() for k in (1, 2, 3, 4) for g, n in Counter(sep.join(t[i:i + k]) for i in range(len(t) - k + 1)).items()}
    assert {(r["file_id"], r["gram"]): r["freq"] for r in got} == want and len(got) == len(want)


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    line = "00401000 " + " ".join(f"{k:02X}" for k in range(16)) + "\r\n"
    (tmp_path / "big.bytes").write_text(line * 300_000)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        tasks = read_file_lines(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count()
        got = {r["gram"]: r["freq"] for r in BG.ngram_freq_splits(spark, str(tmp_path), (1, 2), 1).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert tasks >= 17
    assert got == {**{f"{k:02X}": 300_000 for k in range(16)}, **{f"{k:02X}{k + 1:02X}": 300_000 for k in range(15)}, "0F00": 299_999}


def test_whole_files_keep_name_and_content(spark, tmp_path):
    rows = [("a.b.bytes", "00401000 AA\r\n00401010 BB"), ("empty.bytes", "")]
    df = spark.createDataFrame(rows, "name string, content string")
    written = write_whole_files(df, str(tmp_path / "x.y"), "name", "content").collect()
    assert sorted(tuple(r) for r in written) == [("a.b.bytes", 24), ("empty.bytes", 0)]
    got = read_whole_files(spark, str(tmp_path / "x.y")).select(file_id("path"), "content").collect()
    assert ("a", rows[0][1]) in [tuple(r) for r in got]


@pytest.mark.parametrize(("chunk", "blocks"), [(1 << 20, 16), (7, 2), (1, 1)])
@pytest.mark.parametrize("sep", ["", "-"])
def test_tfidf_saves_blocks_of_files_and_no_rows_of_file_and_gram(spark, tmp_path, monkeypatch, chunk, blocks, sep):
    rng = random.Random(3)
    texts = [(f"/d/f{n % 37}.bytes" if n else None, " ".join(rng.choice(["AA", "0B", "é1", "XYZ"]) for _ in range(rng.choice([0, 1, 2, 5, 30])))) for n in range(40)]
    texts += [("/d/f50.bytes", None), ("/d/f51.bytes", "")]
    files = spark.createDataFrame(texts, "path string, content string").repartition(3)
    monkeypatch.setattr(BG, "CHUNK_CODES", chunk)
    monkeypatch.setattr(BG, "BLOCK_CHUNKS", blocks)
    monkeypatch.setattr(BG, "OUT_ROWS", 4)
    monkeypatch.setattr(BG, "scratch_path", lambda *_: str(tmp_path / "kept"))
    got = BG.byte_tfidf(files, (1, 2, 3), sep).collect()
    tf = Counter()
    for path, text in texts:
        t = [x for x in (text or "").split() if len(x) == 2]
        for k in (1, 2, 3):
            tf.update((path and path[3:-6], sep.join(t[i:i + k])) for i in range(len(t) - k + 1))
    df = Counter(g for _, g in tf)
    idf = {g: math.log((len(texts) + 1) / (n + 1)) for g, n in df.items()}
    assert {(r["file_id"], r["gram"]): r["tf"] for r in got} == tf and len(got) == len(tf)
    for r in got:
        assert r["idf"] == pytest.approx(idf[r["gram"]]) and r["tfidf"] == pytest.approx(r["tf"] * idf[r["gram"]])
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert {"codes", "gram"} <= set(kept.columns) and "file_id" not in kept.columns
    if chunk > 1000:
        assert kept.count() < len(got) / 2


def test_texts_become_strings_a_slice_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(BG, "SLICE_ROWS", 3)
    b = pa.RecordBatch.from_pydict({"file_id": list("abcdefgh"), "content": ["AA AA BB"] * 8})
    assert [x.num_rows for x in BG._slices(iter([b, b.slice(0, 0), b.slice(0, 2)]))] == [3, 3, 2, 2]
    files = spark.createDataFrame([(f"/d/{x}.bytes", "AA AA BB") for x in "abcdefgh"], "path string, content string").coalesce(1)
    got = BG.ngram_freq(files, grams=(1, 2), min_freq=1).collect()
    assert sorted(map(tuple, got)) == sorted((x, g, n) for x in "abcdefgh" for g, n in (("AA", 2), ("BB", 1), ("AAAA", 1), ("AABB", 1)))


def test_rare_grams_leave_no_task_and_repeated_ids_are_summed(spark):
    b = pa.RecordBatch.from_pydict({"file_id": ["a", "b"], "content": ["AA AA BB", "AA BB BB"], "many": [False, True]})
    told = [tuple(r.values()) for x in BG._row_counter([1], "", 2)(iter([b])) for r in x.to_pylist()]
    assert sorted(told) == [("a", "AA", 2), ("b", "AA", 1), ("b", "BB", 2)]
    rows = [("/d/a.bytes", "AA AA BB"), ("/d/b.bytes", "AA"), ("/e/b.bytes", "AA BB"), (None, "CC"), (None, "CC DD"), ("/d/c.bytes", None)]
    files = spark.createDataFrame(rows, "path string, content string").repartition(4)
    assert {tuple(r) for r in BG.ngram_freq(files, (1,), 2).collect()} == {("a", "AA", 2), ("b", "AA", 2), (None, "CC", 2)}


def test_byte_content_is_laid_out_by_lines(spark):
    texts = ["", "a", "x" * 15, "y" * 16, "z" * 17, "a\nb\n" * 9, "é€" * 40, None]
    df = T.with_byte_content(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))

    def want(text):
        code = [f"{x:02X} ".replace("0A ", "?? ") for x in text.encode()]
        return "00401000 " + "".join(c + ("\r\n00401000 " if i % 16 == 15 else "") for i, c in enumerate(code))

    assert {r["doc_id"]: r["content"] for r in df.collect()} == {i: None if t is None else want(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("whole", [0, 120, 1 << 16])
def test_folders_of_files_are_read_one_after_another(spark, tmp_path, monkeypatch, whole):
    told, made = {}, []
    for n in range(3):
        made.append(str(tmp_path / f"x{n}"))
        for name, codes in dumps(made[-1]).items():
            told.setdefault(name, []).append(codes)
    (tmp_path / "x0" / "mark.bytes").write_bytes("﻿AA AA AA".encode())
    told["mark"] = [["AA"] * 3]
    monkeypatch.setattr(BG, "WHOLE_BYTES", whole)
    monkeypatch.setattr(BG, "scratch_path", lambda _, name: str(tmp_path / name))
    got = BG.ngram_freq_splits(spark, made, (1, 2, 3), 3, glob="*.bytes").collect()
    want = Counter((f, "".join(t[i:i + k])) for f, ts in told.items() for t in ts for k in (1, 2, 3) for i in range(len(t) - k + 1))
    assert {(r["file_id"], r["gram"]): r["freq"] for r in got} == {x: n for x, n in want.items() if n >= 3} and len(got) == len({(r["file_id"], r["gram"]) for r in got})
    if whole > 1000:
        kept = {(r["file_id"], r["gram"]) for r in spark.read.parquet(str(tmp_path / "file_grams")).collect()}
        assert ("mark", "AA") in kept and ("mark", "AAAA") not in kept


def test_many_files_make_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files_source, "BATCH_FOLDERS", 3)
    rows = [(f"n{i}.bytes", f"00401000 {i:02X}") for i in range(200)]
    df = spark.createDataFrame(rows, "name string, content string").repartition(4)
    write_whole_files(df, str(tmp_path / "x"), "name", "content", 7).write.format("noop").mode("overwrite").save()
    batches = files_source.folder_batches(str(tmp_path / "x"), 7)
    assert len(batches) == 3 and sum(len(x) > 0 for _, _, x in os.walk(tmp_path / "x")) == 7
    kept = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task a file
        read = [read_whole_files(spark, b, "*.bytes") for b in batches]
        assert all(r.rdd.getNumPartitions() <= 16 for r in read)
        got = [(r["path"].rsplit("/", 1)[1], r["content"]) for x in read for r in x.collect()]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", kept)
    assert sorted(got) == sorted(rows)


def test_dumps_written_by_tasks_are_those_of_the_columns(spark):
    texts = [b"", b"a", b"x" * 15, b"y" * 16, b"z" * 17, b"a\nb\n" * 9, "é€\U0001f600".encode() * 40, bytes(range(256)), b"\n" * 32]
    df = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id long, text binary")
    want = T.with_byte_content(df.withColumn("text", F.col("text").cast("string")))
    assert {r["doc_id"]: r["content"] for r in want.collect()} == {i: T.byte_dump(t).decode() for i, t in enumerate(texts)}


def test_whole_files_are_laid_out_by_their_tasks_and_folders_read_beside_each_other(spark, tmp_path, monkeypatch):
    texts = ["", "a", "x" * 16, "a\nb" * 30, "é€" * 40, "z" * 500, "q r", "\n"]
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(P, "FOLDER_FILES", 1)
    monkeypatch.setattr(files_source, "BATCH_FOLDERS", 1)
    monkeypatch.setattr(P, "scratch_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(T, "with_byte_content", None)  # no matches in columns
    both, read = threading.Barrier(2), P.read_whole_files

    def met(*args):
        both.wait(60)
        return read(*args)

    monkeypatch.setattr(P, "read_whole_files", met)
    got = sorted(tuple(r) for r in P.src_whole_files(spark, str(tmp_path)).collect())
    names = [hashlib.md5(str(i).encode()).hexdigest() for i in range(len(texts))]
    assert got == sorted((n[-20:], f"{n}.bytes", 9 + 3 * len(t.encode()) + 11 * (len(t.encode()) // 16)) for n, t in zip(names, texts, strict=True))
    assert any(not files for path, made, files in os.walk(tmp_path / "bytes") if not made)  # also from empty folders


def test_a_folder_that_fails_ends_the_read(spark):
    begun = []

    def job(k, folder):
        begun.append(folder)
        raise ValueError(folder)

    with pytest.raises(ValueError, match="f0"):
        files_source.each_folder(spark, [f"f{k}" for k in range(50)], job)
    files_source.each_folder(spark, [], job)
    assert "f0" in begun


def test_the_driver_keeps_no_listing_of_folders_that_were_read(spark, tmp_path, monkeypatch):
    """Spark would keep up to 250 MB of them; and a folder holds a bounded number of files, whatever the table is."""
    key, kept = "spark.sql.hive.filesourcePartitionFileCacheSize", []
    df = spark.createDataFrame([(f"n{i}.bytes", "00401000 AA AA BB") for i in range(12)], "name string, content string")
    monkeypatch.setattr(files_source, "BATCH_FOLDERS", 2)
    write_whole_files(df, str(tmp_path / "x"), "name", "content", 6).write.format("noop").mode("overwrite").save()
    read = BG.read_whole_files

    def seen(spark, path, *args):
        kept.append(spark.conf.get(key))
        return read(spark, path, *args)

    monkeypatch.setattr(BG, "read_whole_files", seen)
    got = BG.ngram_freq_splits(spark, files_source.folder_batches(str(tmp_path / "x"), 6), (1,), 2, glob="*.bytes").collect()
    assert sorted(map(tuple, got)) == sorted((f"n{i}", "AA", 2) for i in range(12))
    assert kept == ["0"] * 3 and spark.conf.get(key, None) is None
    spark.conf.set(key, "1000")
    try:
        with pytest.raises(ValueError), files_source.listed_once(spark):
            raise ValueError
        assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.unset(key)
    monkeypatch.undo()
    assert files_source.FOLDER_FILES * files_source.BATCH_FOLDERS <= 20_000


def test_what_a_folder_left_in_cycles_goes_with_it(spark):
    """A table in a cycle keeps its listing in the JVM."""
    class Table:
        pass

    left = []

    def job(k, folder):
        x = Table()
        x.me = x
        left.append(weakref.ref(x))

    gc.disable()
    try:
        files_source.each_folder(spark, ["a", "b", "c"], job)
    finally:
        gc.enable()
    assert [x() for x in left] == [None] * 3
