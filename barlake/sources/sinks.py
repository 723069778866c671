"""Named datasets, report files and the versioned feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.scalars import col
from barlake.schemas import (
    BAR_SCHEMA,
    FEATURE_SCHEMA,
    FEATURES,
    PREDICTION_SCHEMA,
    RUN_LOG_SCHEMA,
    TARGET,
)

MONTH = "month"


@dataclass(frozen=True)
class Dataset:
    """Where and how a named table is stored under the data root."""

    format: str
    path: str
    schema: T.StructType | None = None
    partition_by: tuple[str, ...] = ()


# The named tables of a run. Intermediate tables that a plain
# DataFrame lineage replaces are not stored.
DATASETS = {
    "raw_bars": Dataset("csv", "01_raw/bars", BAR_SCHEMA),
    "clean_bars": Dataset("parquet", "02_intermediate/clean_bars", BAR_SCHEMA),
    "features": Dataset("parquet", "04_feature/features", FEATURE_SCHEMA),
    "hybrid_dataset": Dataset("parquet", "05_model_input/hybrid", None, ("symbol",)),
    "baseline_dataset": Dataset("parquet", "05_model_input/baseline", None, ("symbol",)),
    "predictions": Dataset("parquet", "07_model_output/predictions", PREDICTION_SCHEMA),
    "run_log": Dataset("parquet", "08_reporting/run_log", RUN_LOG_SCHEMA, ("run_id",)),
    "raw_contract_report": Dataset("json", "08_reporting/raw_contract"),
    "feature_contract_report": Dataset("json", "08_reporting/feature_contract"),
    "drift_summary": Dataset("json", "08_reporting/drift_summary"),
    "metrics": Dataset("json", "08_reporting/metrics"),
}


def read_dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    spec = DATASETS[name]
    reader = spark.read.format(spec.format)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    if spec.format == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{root}/{spec.path}")


def write_dataset(df: DataFrame, root: str, name: str, mode: str = "overwrite") -> None:
    spec = DATASETS[name]
    writer = df.write.format(spec.format).mode(mode).partitionBy(*spec.partition_by)
    if spec.format == "csv":
        writer = writer.option("header", True)
    writer.save(f"{root}/{spec.path}")


def merge_latest(
    stored: DataFrame, new: DataFrame, keys: Sequence[str], order_col: str
) -> DataFrame:
    """Union of both tables with one row per key: the newest by ``order_col``.

    On equal ``order_col`` the row of ``new`` wins. The group limit that Spark
    derives from ``rank = 1`` keeps one row per key and task before the shuffle.
    """
    both = stored.withColumn("_incoming", F.lit(0)).unionByName(
        new.withColumn("_incoming", F.lit(1)), allowMissingColumns=True
    )
    newest = Window.partitionBy(*[col(k) for k in keys]).orderBy(
        col(order_col).desc(), F.col("_incoming").desc()
    )
    return (
        both.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank", "_incoming")
    )


def _month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` with all its columns, or None if nothing is there yet.

    Any other reason why it cannot be read is an error: rewriting months on top
    of a table that could not be read would lose their rows.
    """
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    fields = [T.StructField(f.name, T.StringType()) if f.name == MONTH else f for f in found.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_in_stored_order(spark: SparkSession, path: str) -> DataFrame:
    """A stored Parquet table with ``row_pos``: file, then row in the file."""
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return spark.read.parquet(path).withColumn("row_pos", place)


def upsert_feature_table(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: Sequence[str] = ("symbol", "Date"),
    order_col: str = "version",
) -> None:
    """Insert or replace rows of the month-partitioned Parquet table at ``path``.

    Only the months that ``new`` touches are read (the semi-join prunes the
    stored partitions at run time) and rewritten; the others keep their files.
    A failed job leaves the table as it was, as files are moved on commit only.
    Stored columns that ``new`` lacks stay in the table, missing in its new rows;
    new columns are missing in the old rows.
    """
    incoming = new.withColumn(MONTH, _month(F.col("Date")))
    stored = _stored(spark, path)
    if stored is None:
        merged = merge_latest(incoming.limit(0), incoming, keys, order_col)
    else:
        touched = incoming.select(MONTH).distinct()
        old = stored.join(touched, MONTH, "left_semi").select(*stored.columns)
        merged = merge_latest(old, incoming, keys, order_col)
    (
        merged.hint("rebalance", MONTH)  # one file set per month, big months split
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def feature_view(features: DataFrame) -> DataFrame:
    """The training projection: features and label, no date."""
    return features.select(*FEATURES, TARGET)


def upload_summary(
    features: DataFrame,
    group: str,
    group_version: int,
    view: str,
    view_version: int,
) -> DataFrame:
    """One row describing an upload to the feature table."""
    return features.agg(F.count("*").alias("rows_uploaded")).select(
        F.lit(group).alias("feature_group_name"),
        F.lit(group_version).alias("feature_group_version"),
        F.lit(view).alias("feature_view_name"),
        F.lit(view_version).alias("feature_view_version"),
        F.lit("Date").alias("primary_key"),
        F.lit("Date").alias("event_time"),
        F.lit(",".join(FEATURES)).alias("feature_columns"),
        F.lit(TARGET).alias("target_column"),
        "rows_uploaded",
        F.lit(True).alias("feature_view_created"),
    )


def run_log_rows(run_id: str, stage: str, kind: str, values: DataFrame) -> DataFrame:
    """Long rows ``(run_id, stage, kind, "<stage>.<name>", value)``.

    ``values`` is a one-row frame whose columns are the logged names.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(f"{stage}.{c}").alias("key"), col(c).cast("string").alias("value"))
            for c in values.columns
        ]
    )
    return values.select(
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
        F.lit(kind).alias("kind"),
        F.inline(pairs),
    )
