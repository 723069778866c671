"""What the streams share: their checkpoints, and tables that hold one folder a batch.

A batch that is run again after a failure gets the same number and overwrites its own
folder, so nothing is there twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.schemas import DataContractError

BATCH = "batch"
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def checkpoint_location(rows: DataFrame, name: str) -> str:
    """A folder for ``name`` below the shared folder the cluster names."""
    root = rows.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise DataContractError("spark.checkpoint.dir must name a shared folder")
    return f"{root.rstrip('/')}/{name}"


def batch_writer(output: str, *by: str) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch below ``output``, in the folder of its number, partitioned by ``by``."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").partitionBy(*by).parquet(f"{output}/{BATCH}={number}")

    return write


def start_batches(rows: DataFrame, output: str, name: str, mode: str, *by: str, checkpoint: str | None = None) -> StreamingQuery:
    """Write all that is there now in batches below ``output``, then stop."""
    return (
        rows.writeStream.foreachBatch(batch_writer(output, *by))
        .outputMode(mode)
        .queryName(name)
        .option("checkpointLocation", checkpoint or checkpoint_location(rows, name))
        .trigger(availableNow=True)
        .start()
    )


def zoned(time: str | Column) -> Column:
    """A zone-less time as the instant that UTC clocks show it; watermarks need instants."""
    return F.timestamp_micros(micros(time))


def micros(time: str | Column) -> Column:
    """Microseconds since 1970 of a zone-less time or date, whatever the session's time zone."""
    time = F.col(time) if isinstance(time, str) else time
    at = time.cast("timestamp_ntz")
    seconds = F.unix_date(at.cast("date")).cast("long") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


def zoneless(instant: str | Column) -> Column:
    """The inverse of :func:`zoned`."""
    instant = F.col(instant) if isinstance(instant, str) else instant
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(EPOCH))
