"""Score a stream of documents with a fitted naive Bayes model.

The reference has no streaming operator; this is the batch ``predict`` applied
per micro-batch with Structured Streaming, so new documents landing in a
folder (or any streaming source) get labels without re-fitting. Scoring is
stateless per document: every micro-batch is a normal batch job (term count,
join with the model's term table, per-document sums), and each batch writes to
its own ``batch_id=N`` folder with overwrite, so a retried batch replaces its
own output (exactly-once together with the query checkpoint).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from bayesmill.operators import naive_bayes as NB


def predict_stream(model: NB.NaiveBayesModel, docs: DataFrame, out_path: str, checkpoint_location: str,
                   id_col: str = "doc_id", text_col: str = "text", on_unknown: str = "drop",
                   trigger_once: bool = False) -> StreamingQuery:
    """Start a streaming query writing ``(id, label)`` Parquet under ``out_path/batch_id=N``."""

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        pred = NB.predict(model, batch.select(id_col, text_col), id_col, text_col, on_unknown)
        pred.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))

    writer = docs.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint_location)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
