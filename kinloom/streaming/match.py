"""The matcher over a stream: each micro-batch of source records meets the static master."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import match_master


def match_stream(stream: DataFrame, master: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Matches every micro-batch and hands the results to ``sink(results, batch_id)``. A source record's result depends
    on no other source record, so batches may be cut anywhere; a sink that overwrites by batch id makes reruns safe."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: sink(match_master.match(df, master), n))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
