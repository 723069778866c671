"""Scoring requests as they arrive, with the same contract as batch scoring.

Scoring keeps no state, so nothing but source offsets is checkpointed; a lost
executor only means that its files of the micro-batch are scored again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.models import LinearModel, score
from barlake.streaming.runs import checkpoint_location


def start_scoring(
    requests: DataFrame, model: LinearModel, output: str, name: str = "scoring"
) -> StreamingQuery:
    """Append scored requests to the Parquet table at ``output`` until stopped.

    Requests that cannot be scored are kept with their ``reject_reason``.
    """
    return (
        score(requests, model)
        .writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint_location(requests, name))
        .trigger(availableNow=True)
        .start(output)
    )
