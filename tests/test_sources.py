import datetime as dt

import pytest
from pyspark.errors import PySparkException
from conftest import pandas_of, valid_bars, valid_features
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from barlake.schemas import FEATURES, RUN_LOG_SCHEMA, TARGET, DataContractError
from barlake.sources import market, sinks, tables

LINES = """Date,Open,High,Low,Close,Adj Close,Volume
2026-01-02,100,102,99,101.5,101.5,1000000
2026-01-05,101,103,100.5,102.5,102.5,1100000
"""
NEW = (101.0, 103.0, 100.5, 102.5, 102.5, 1_100_000)
OLD = (100.0, 102.0, 99.0, 101.5, 101.5, 1_000_000)
FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]


def wide(spark, name):
    """Two dates, newest first; ``name`` builds a column name from a field."""
    rows = [("2026-01-05", *NEW), ("2026-01-02", *OLD)]
    return spark.createDataFrame(rows, ["Date", *[name(f) for f in FIELDS]])


def test_csv(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text(LINES)
    out = pandas_of(market.read_market_csv(spark, str(path), "T"))
    assert out["Date"].tolist() == [dt.date(2026, 1, 2), dt.date(2026, 1, 5)]
    assert out["Close"].tolist() == [101.5, 102.5] and out["Volume"].tolist() == [1000000, 1100000]
    assert market.read_text_csv(spark, str(path)).dtypes[1] == ("Open", "string")


def test_missing_csv(spark, tmp_path):
    with pytest.raises(AnalysisException):
        market.read_market_csv(spark, str(tmp_path / "absent.csv"), "T")


@pytest.mark.parametrize("name", [lambda f: f"{f}|X", lambda f: f"X|{f}", lambda f: f])
def test_vendor_extract_in_any_nesting(spark, name):
    out = pandas_of(market.normalize_vendor_extract(wide(spark, name), "X"))
    assert out.columns.tolist() == ["symbol", *market.REQUIRED_COLUMNS]
    assert out["symbol"].tolist() == ["X", "X"]
    assert out[FIELDS].values.tolist() == [list(OLD), list(NEW)]


def test_vendor_extract_of_two_tickers(spark):
    both = wide(spark, lambda f: f"{f}|X").join(wide(spark, lambda f: f"{f}|Y"), "Date")
    assert market.normalize_vendor_extract(both).count() == 4
    only = market.normalize_vendor_extract(both, "Y").select("symbol").distinct().collect()
    assert [r[0] for r in only] == ["Y"]
    with pytest.raises(DataContractError, match="not one of"):
        market.normalize_vendor_extract(both, "Z")


def test_absent_ticker_takes_the_only_one(spark):
    out = market.normalize_vendor_extract(wide(spark, lambda f: f"{f}|X"), "Z")
    assert {r["symbol"] for r in out.collect()} == {"Z"}


def test_vendor_extract_datetime_loses_its_zone(spark):
    df = wide(spark, lambda f: f).withColumnRenamed("Date", "Datetime")
    df = df.withColumn("Datetime", F.col("Datetime").cast("timestamp"))
    assert dict(market.normalize_vendor_extract(df, "X").dtypes)["Date"] == "timestamp_ntz"


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.drop("Close"), "missing required columns"),
        (lambda df: df.drop("Date"), "Date column"),
        (lambda df: df.limit(0), "no rows"),
        (lambda df: df.unionByName(df), "duplicate dates.*2026-01-02"),
    ],
)
def test_vendor_extract_errors(spark, change, message):
    with pytest.raises(DataContractError, match=message):
        market.normalize_vendor_extract(change(wide(spark, lambda f: f)), "X")


def test_bars_break_ties_by_price(spark):
    rows = [(1, 10.25, 1.0), (1, 9.75, 2.0), (2, 11.5, 3.0), (2, 12.0, 4.0)]
    trades = spark.createDataFrame(rows, "trade bigint, price double, size double")
    out = tables.to_bars(
        trades, F.col("trade"), F.col("price"), F.col("size"), F.lit("T").alias("symbol")
    ).first()
    assert (out["Open"], out["High"], out["Low"], out["Close"]) == (9.75, 12.0, 9.75, 12.0)
    assert out["Volume"] == 10


def test_upsert_rewrites_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "features")
    table = valid_features(spark).withColumn("version", F.lit(1))
    january = table.withColumn("Date", F.date_sub("Date", 25))
    sinks.upsert_feature_table(spark, path, table.unionByName(january))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "features").glob("month=2026-01/*.parquet")}
    corrected = table.limit(2).withColumn("rsi_14", F.lit(1.0)).withColumn("version", F.lit(2))
    sinks.upsert_feature_table(spark, path, corrected)
    sinks.upsert_feature_table(spark, path, corrected.withColumn("version", F.lit(0)))

    stored = spark.read.parquet(path)
    assert stored.count() == 10
    assert stored.where("version = 2 AND rsi_14 = 1.0").count() == 2
    assert stored.where("version = 0").count() == 0
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "features").glob("month=2026-01/*.parquet")}
    assert before and before == after


def test_merge_prefers_new_rows_on_ties(spark):
    old = valid_features(spark).withColumn("version", F.lit(1))
    new = old.withColumn("rsi_14", F.lit(7.0))
    out = sinks.merge_latest(old, new, ["symbol", "Date"], "version")
    assert out.count() == 5 and out.where("rsi_14 = 7.0").count() == 5


def test_feature_view_and_summary(spark):
    features = valid_features(spark)
    assert sinks.feature_view(features).columns == [*FEATURES, TARGET]
    row = sinks.upload_summary(features, "g", 1, "v", 2).first()
    assert row["rows_uploaded"] == 5 and row["feature_view_version"] == 2


def test_datasets_round_trip(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_dataset(valid_bars(spark), root, "raw_bars")
    assert sinks.read_dataset(spark, root, "raw_bars").count() == 5
    log = sinks.run_log_rows(
        "r1", "train", "metric", spark.createDataFrame([(0.5, 3)], "accuracy double, rows int")
    )
    assert {r["key"]: r["value"] for r in log.collect()} == {
        "train.accuracy": "0.5", "train.rows": "3"
    }
    sinks.write_dataset(log, root, "run_log", "append")
    sinks.write_dataset(log.withColumn("run_id", F.lit("r2")), root, "run_log", "append")
    back = sinks.read_dataset(spark, root, "run_log")
    assert back.count() == 4 and set(back.columns) == set(RUN_LOG_SCHEMA.fieldNames())
    sinks.write_dataset(log.limit(1), root, "metrics")
    assert sinks.read_dataset(spark, root, "metrics").count() == 1


@pytest.mark.parametrize("price", [1.23456789, 0.000012, -37.63, 1e-300, 1.7e308])
def test_bars_keep_any_price(spark, price):
    trades = spark.createDataFrame([(1, price, 1.0), (2, price / 3, 1.0)], "trade bigint, price double, size double")
    columns = F.col("trade"), F.col("price"), F.col("size"), F.lit("T").alias("symbol")
    out = tables.to_bars(trades, *columns).first()
    assert (out["Open"], out["Close"]) == (price, price / 3)
    with pytest.raises(PySparkException, match="negative or no multiple|OVERFLOW"):
        tables.to_bars(trades, *columns, price_steps=100).collect()


def test_a_fractional_total_volume_is_refused(spark):
    trades = spark.createDataFrame([(1, 1.0, 0.4), (2, 1.0, 0.4)], "trade bigint, price double, size double")
    bars = tables.to_bars(trades, F.col("trade"), F.col("price"), F.col("size"), F.lit("T").alias("symbol"))
    with pytest.raises(PySparkException, match="whole number"):
        bars.collect()


def test_upsert_keeps_stored_columns_and_takes_new_ones(spark, tmp_path):
    path = str(tmp_path / "features")
    table = valid_features(spark).withColumn("version", F.lit(1))
    sinks.upsert_feature_table(spark, path, table.withColumn("note", F.lit("kept")))
    newer = table.limit(1).withColumn("version", F.lit(2)).withColumn("extra", F.lit(5))
    sinks.upsert_feature_table(spark, path, newer)
    stored = spark.read.parquet(path)
    assert stored.where("note = 'kept'").count() == 4 and stored.where("extra = 5 AND note IS NULL").count() == 1
    assert stored.count() == 5


def test_upsert_over_something_unreadable_is_an_error(spark, tmp_path):
    folder = tmp_path / "features"
    folder.mkdir()
    (folder / "part-0.parquet").write_text("no table")
    with pytest.raises(Exception):
        sinks.upsert_feature_table(spark, str(folder), valid_features(spark).withColumn("version", F.lit(1)))
    assert (folder / "part-0.parquet").read_text() == "no table"


def test_a_date_without_prices_reaches_the_contract(spark):
    rows = [("2026-01-05", None, None, None, None, None, 5), ("2026-01-02", *OLD)]
    schema = "Date string, " + ", ".join(f"`{f}` double" for f in FIELDS[:-1]) + ", Volume bigint"
    one = spark.createDataFrame([(d, *map(lambda v: None if v is None else float(v), r[:-1]), int(r[-1])) for d, *r in rows], schema)
    assert market.normalize_vendor_extract(one, "X").count() == 2


def test_final_datasets_have_a_place(spark, tmp_path):
    for name in ("hybrid_dataset", "baseline_dataset"):
        sinks.write_dataset(valid_features(spark), str(tmp_path), name)
        assert sinks.read_dataset(spark, str(tmp_path), name).where("symbol = 'T'").count() == 5
