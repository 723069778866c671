"""Contract rules on arriving rows: accepted rows and a quarantine, in one write.

Row rules need no state. A batch is written once, both tables together, so either all
of its rows have arrived or none; run again it replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.scalars import nan_to_null
from barlake.operators.contracts import Expectation
from barlake.streaming.runs import start_batches

VERDICT, ACCEPTED, QUARANTINE = "verdict", "accepted", "quarantine"
FAILED = "failed_rules"


def judged(rows: DataFrame, contract: Sequence[Expectation]) -> DataFrame:
    """``rows`` with the names of the row rules each breaks, and the table it belongs to.

    A row rule on a column that the rows lack is broken by every row. Rules over the whole
    table (row count, uniqueness, stored order) do not judge single rows.
    """
    rows = nan_to_null(rows)
    names = []
    for rule in contract:
        if any(c not in rows.columns for c in rule.needs):
            names.append(F.lit(rule.name))
        elif rule.broken() is not None:
            names.append(F.when(rule.broken(), F.lit(rule.name)))
    failed = F.filter(F.array(*names), lambda n: n.isNotNull()) if names else F.array().cast("array<string>")
    marked = rows.withColumn(FAILED, failed)
    return marked.withColumn(VERDICT, F.when(F.size(FAILED) == 0, ACCEPTED).otherwise(QUARANTINE))


def start_gate(
    rows: DataFrame, contract: Sequence[Expectation], output: str, name: str = "gate", checkpoint: str | None = None
) -> StreamingQuery:
    return start_batches(judged(rows, contract), output, name, "append", VERDICT, checkpoint=checkpoint)


def read_side(spark: SparkSession, output: str, side: str) -> DataFrame:
    """The accepted rows or the quarantined ones, with ``batch`` and ``failed_rules``."""
    return spark.read.parquet(output).where(F.col(VERDICT) == side).drop(VERDICT)
