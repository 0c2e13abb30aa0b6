"""Records that arrive as a stream: the batch operators over micro-batches.

The surveyed system has no streaming; this module only lets its linear and its static-stream steps run on Structured Streaming without
another code path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinlink.operators.blocking import BlockingConfig, generate_candidates
from kinlink.operators.features import entities, entity_features


def feature_stream(stream: DataFrame, mode: str = "full") -> DataFrame:
    """Entity features of a stream of source rows: narrow projections, no state."""
    return entity_features(entities(stream), mode)


def link_stream(stream: DataFrame, target: DataFrame, sink: Callable[[DataFrame, int], None], config: BlockingConfig = BlockingConfig(), checkpoint: str | None = None) -> StreamingQuery:
    """Candidates of each arriving batch against fixed target features; sink(batch, epoch) must be idempotent by epoch."""

    def each(batch: DataFrame, epoch: int) -> None:
        sink(generate_candidates(entity_features(entities(batch), config.mode, config.n), target, config), epoch)

    writer = stream.writeStream.foreachBatch(each).trigger(availableNow=True)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
