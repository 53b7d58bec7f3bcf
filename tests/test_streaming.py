import os
import tempfile

from bayesmill.operators import naive_bayes as NB
from bayesmill.streaming.predict_stream import predict_stream


def test_stream_predictions_equal_batch(spark):
    docs = spark.createDataFrame([(1, "apple banana"), (2, "cherry durian"), (3, "apple pie")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, ["A"]), (2, ["B"])], "doc_id long, classes array<string>")
    model = NB.fit(docs, labels, ["A", "B"], stop_words=())
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    src = os.path.join(base, "in")
    new_docs = spark.createDataFrame([(10, "apple apple"), (11, "durian"), (12, "zzz")], "doc_id long, text string")
    new_docs.write.parquet(src)
    stream = spark.readStream.schema("doc_id long, text string").parquet(src)
    q = predict_stream(model, stream, os.path.join(base, "out"), os.path.join(base, "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    got = {r["doc_id"]: r["label"] for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    want = {r["doc_id"]: r["label"] for r in NB.predict(model, new_docs).collect()}
    assert got == want == {10: "A", 11: "B"}
