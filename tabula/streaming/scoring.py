"""Streaming batch scoring (O-102 on a Structured Streaming source).

Scoring is stateless and every fitted value, the coercion switch too, is stored with the
fit, so results do not depend on how rows fall into batches. A micro-batch is scored as a
static DataFrame inside ``foreachBatch``. Every epoch is written to its own
folder with ``overwrite``: a retried epoch replaces its own output, so the sink
is idempotent, and the stream's checkpoint lives in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..plans.preprocess import PrepSpec
from ..plans.scoring import batch_score, batch_score_unfitted


def score_stream(stream: DataFrame, params: dict, spec: PrepSpec, model, experiment: str, out_path: str,
                 checkpoint: str, available_now: bool = True):
    """Start a scoring stream; returns the ``StreamingQuery``."""

    return _start(stream, lambda batch: batch_score(batch, params, spec, model, experiment), out_path, checkpoint, available_now)


def score_stream_unfitted(stream: DataFrame, id_col: str, features: Sequence[str], model, experiment: str, out_path: str,
                          checkpoint: str, available_now: bool = True):
    """As ``score_stream`` without a stored fit: imputation and encoding are fitted on each micro-batch, as scoring
    without a run does for a batch. A row's result therefore depends on the rows of its epoch, and on no others; a
    retried epoch has the same rows and so the same result."""
    return _start(stream, lambda batch: batch_score_unfitted(batch, id_col, features, model, experiment), out_path, checkpoint, available_now)


def _start(stream: DataFrame, score: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str, available_now: bool):
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_scores(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path)
