"""Event windows, trajectories and event studies.

Interval and as-of conditions become equi-joins: an event is expanded into the
steps it covers, or located by its position in the series. Events are a short
hand-kept list, so expanding *them* never multiplies the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.scalars import ratio
from barlake.functions.series import DAILY, POSITION, Series, lag

LOOKBACK_STEPS = 10
TRAJECTORY_ROWS = 30
STUDY_ROWS = 20
STUDY_THRESHOLD = -0.1
ZOOM_STEPS = 120

# SQL interval of one step.
STEPS = {"day": "INTERVAL '1' DAY", "hour": "INTERVAL '1' HOUR"}


def event_list(spark: SparkSession, dates: Sequence, symbol: str, kind: str = "date") -> DataFrame:
    """A literal list of events of one series, numbered in list order."""
    rows = [(i, symbol, str(d)) for i, d in enumerate(dates)]
    frame = spark.createDataFrame(rows, "event_id int, symbol string, event_date string")
    return frame.withColumn("event_date", F.col("event_date").cast(kind))


def _covered_steps(events: DataFrame, steps: int, unit: str) -> DataFrame:
    """(event, step) pairs for the whole steps in [event - steps, event); events at any time."""
    one, kind = STEPS[unit], events.schema["event_date"].dataType.simpleString()
    floor = f"CAST(CAST(event_date AS DATE) AS {kind})"
    if unit == "hour":
        floor = f"timestampadd(HOUR, hour(event_date), {floor})"
    edge = f"CASE WHEN {floor} = event_date THEN event_date ELSE {floor} + {one} END"
    covered = F.expr(f"sequence({edge} - {steps} * {one}, {edge} - {one}, {one})")
    return events.withColumn("Date", F.explode(covered))


def pre_event_rows(
    df: DataFrame, events: DataFrame, steps: int = LOOKBACK_STEPS, unit: str = "day"
) -> DataFrame:
    """Rows in the window before each event; a row covered twice appears twice.

    ``Date`` must be a whole step, the event may be at any time.
    """
    return df.join(_covered_steps(events, steps, unit), ["symbol", "Date"])


def rows_outside_events(
    df: DataFrame, events: DataFrame, steps: int = LOOKBACK_STEPS, unit: str = "day"
) -> DataFrame:
    """Rows in no event's window."""
    covered = _covered_steps(events, steps, unit).select("symbol", "Date").distinct()
    return df.join(covered, ["symbol", "Date"], "left_anti")


def event_positions(df: DataFrame, events: DataFrame, series: Series = DAILY) -> DataFrame:
    """Events with ``_at``, the position of the first row at or after the event.

    Events are sorted into the series as extra rows and the rows before each
    one are counted: an as-of join by one window, without pairing rows. In a long
    series the positions of rows and events together are found in stretches, and
    the few earlier events are taken off.
    """
    if series.tie is not None and series.block_rows is not None:
        tie = df.schema[series.tie].dataType
        marks = df.select("symbol", "Date", series.tie).unionByName(
            # A missing tie sorts first: an event stands before the rows of its own time.
            events.select("symbol", F.col("event_date").alias("Date"), F.lit(None).cast(tie).alias(series.tie), F.col("event_id").alias("_event")),
            allowMissingColumns=True,
        )
        placed = series.with_positions(marks).where(F.col("_event").isNotNull())
        same = Window.partitionBy("symbol", "Date")
        before_it = F.rank().over(Window.partitionBy("symbol").orderBy("Date")) - 1
        return placed.select(
            "symbol",
            F.col("_event").alias("event_id"),
            (F.min(POSITION).over(same) - before_it).alias("_at"),
        )
    marks = df.select(
        "symbol", "Date", F.lit(None).cast("int").alias("event_id"), F.lit(1).alias("_row")
    ).unionByName(
        events.select("symbol", F.col("event_date").alias("Date"), "event_id", F.lit(0).alias("_row"))
    )
    before = (
        Window.partitionBy("symbol")
        .orderBy("Date", "_row", "event_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        marks.withColumn("_at", F.sum("_row").over(before))
        .where(F.col("event_id").isNotNull())
        .select("symbol", "event_id", "_at")
    )


def _around(df: DataFrame, events: DataFrame, first: int, last: int, series: Series) -> DataFrame:
    """Rows at offsets first..last from each event, by position."""
    wanted = event_positions(df, events, series).withColumn(
        "offset", F.explode(F.sequence(F.lit(first), F.lit(last)))
    )
    wanted = wanted.withColumn(POSITION, F.col("_at") + F.col("offset"))
    return (
        series.with_positions(df).join(wanted, ["symbol", POSITION]).drop(POSITION, "_at")
    )


def _average(kept: DataFrame, column: str, day: Column) -> DataFrame:
    return kept.groupBy(day.cast("int").alias("day")).agg(
        F.avg(column).alias("mean_value"),
        F.stddev_pop(column).alias("std_value"),
        F.count("*").alias("events"),
    )


def trajectory_before(
    df: DataFrame,
    events: DataFrame,
    column: str,
    rows: int = TRAJECTORY_ROWS,
    at_least: int = 5,
    series: Series = DAILY,
) -> DataFrame:
    """Mean and population deviation over events, by row before the event.

    Events need more than ``at_least`` rows before and after dropping missing
    values; all are cut to their last common number of rows.
    """
    found = _around(df.select("symbol", "Date", column), events, -rows, -1, series)
    per_event = Window.partitionBy("event_id")
    present = F.col(column).isNotNull()
    usable = (
        found.withColumn("_rows", F.count("*").over(per_event))
        .where((F.col("_rows") > at_least) & present)
        .withColumn("_values", F.count("*").over(per_event))
        .where(F.col("_values") > at_least)
        .withColumn("_back", F.row_number().over(per_event.orderBy(F.col("offset").desc())))
    )
    shortest = usable.agg(F.min("_values")).scalar()
    return _average(usable.where(F.col("_back") <= shortest), column, -F.col("_back"))


def trajectory_around(
    df: DataFrame,
    events: DataFrame,
    column: str,
    rows: int = TRAJECTORY_ROWS,
    at_least: int = 10,
    series: Series = DAILY,
) -> DataFrame:
    """As :func:`trajectory_before` with rows on both sides.

    Events need at least ``at_least`` rows; all are cut to their first common
    number of values, and the day axis is centred on half of it.
    """
    found = _around(df.select("symbol", "Date", column), events, -rows, rows - 1, series)
    per_event = Window.partitionBy("event_id")
    usable = (
        found.withColumn("_rows", F.count("*").over(per_event))
        .where((F.col("_rows") >= at_least) & F.col(column).isNotNull())
        .withColumn("_values", F.count("*").over(per_event))
        .withColumn("_place", F.row_number().over(per_event.orderBy("offset")) - 1)
    )
    shortest = usable.agg(F.min("_values")).scalar()
    kept = usable.withColumn("_shortest", shortest).where(F.col("_place") < F.col("_shortest"))
    return _average(kept, column, F.col("_place") + F.floor(-F.col("_shortest") / 2))


def event_study(
    df: DataFrame,
    column: str = "sentiment_anomaly",
    threshold: float = STUDY_THRESHOLD,
    reach: int = STUDY_ROWS,
    series: Series = DAILY,
) -> DataFrame:
    """Mean cumulative log return around rows whose ``column`` is low.

    Each low row looks at the ``reach`` rows on either side; rows too close to
    an end of the series, or with a missing return in reach, do not count.
    Needs ``Close``. The window array holds 2*reach+1 numbers at most and only
    event rows leave it.
    """
    size = 2 * reach + 1

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        step = F.ln(ratio(F.col("Close"), lag(F.col("Close"), 1, w)))
        return rows.withColumn("_return", step).withColumn(
            "_path", F.collect_list("_return").over(w.rowsBetween(-reach, reach))
        )

    low = (F.col(column) < threshold) & (F.size("_path") == size)
    steps = series.apply(df, build, back=reach + 1, forward=reach).where(low)
    path = F.transform(
        F.sequence(F.lit(1), F.lit(size)),
        lambda n: F.aggregate(
            F.slice("_path", F.lit(1), n), F.lit(0.0), lambda total, r: total + r
        ),
    )
    return (
        steps.select("symbol", F.posexplode(path).alias("_place", "cumulative"))
        .groupBy("symbol", (F.col("_place") - reach).alias("offset"))
        .agg(F.avg("cumulative").alias("mean_path"), F.count("*").alias("events"))
    )


def smallest(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n rows with the smallest values over all series, earliest first on ties."""
    return (
        df.where(F.col(column).isNotNull()).orderBy(F.col(column), "Date", "symbol").limit(n)
    )


def smallest_per_series(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n rows with the smallest values of each series, with their rank."""
    order = Window.partitionBy("symbol").orderBy(F.col(column), "Date")
    return (
        df.where(F.col(column).isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
    )


def crash_zoom(df: DataFrame, column: str, n: int = 10, steps: int = ZOOM_STEPS,
               unit: str = "day") -> DataFrame:
    """Rows from ``steps`` before the first to ``steps`` after the last of the n
    smallest values, per series."""
    one = STEPS[unit]
    span = smallest_per_series(df, column, n).groupBy("symbol").agg(
        F.expr(f"min(Date) - {steps} * {one}").alias("_from"),
        F.expr(f"max(Date) + {steps} * {one}").alias("_to"),
    )
    return (
        df.join(span, "symbol")
        .where(F.col("Date").between(F.col("_from"), F.col("_to")))
        .drop("_from", "_to")
    )
