"""Scoring of a stream of keys, and reports per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallybook.calibration import DEFAULT, Calibration
from tallybook.params import Scenario
from tallybook.plans.portfolio import score_scenarios
from tallybook.sources.snapshots import append_batch, is_snapshot_folder
from tallybook.sources.store import has_partitions, written_by_stream


def score_stream(
    keys: DataFrame, scenarios: Sequence[Scenario] = (Scenario(),), cal: Calibration = DEFAULT
) -> DataFrame:
    """Score a streaming table of ``application_seq``. No state is kept."""
    return score_scenarios(keys, scenarios, cal)


def append_portfolio(
    scored: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append a scored stream to a portfolio, exactly once per checkpoint.

    Each batch is a snapshot with a commit of its own, which names the stream, by its checkpoint, and the batch; one
    that was committed before a crash is not written again. Batch jobs may write the same portfolio.
    """
    spark = scored.sparkSession
    if not is_snapshot_folder(spark, path) and (written_by_stream(spark, path) or has_partitions(spark, path)):
        raise ValueError(f"{path} holds a portfolio that is not written in snapshots")
    stream = checkpoint.rstrip("/")

    def add(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, batch_id, path, stream)

    writer = scored.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def report_batches(
    scored: DataFrame, report: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Call ``report`` with each micro-batch. Its figures are those of the batch alone."""
    return (
        scored.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
