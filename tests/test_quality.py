import datetime as dt

import pytest
from conftest import pandas_of, valid_bars, valid_features, weekdays
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barlake.operators import contracts as C
from barlake.operators import quality as Q
from barlake.schemas import FEATURES, REQUIRED_COLUMNS, TARGET, DataContractError
from barlake.sources.sinks import read_in_stored_order

FIRST = weekdays("2026-01-01", 1)[0]


def text_bars(spark):
    """Newest first, all text, one column too many."""
    rows = [
        ("T", "2026-01-05", "101", "103", "100.5", "102.5", "102.5", "1100000", "x"),
        ("T", "2026-01-02", "100", "102", "99", "101.5", "101.5", "1000000", "y"),
    ]
    return spark.createDataFrame(rows, ["symbol", *REQUIRED_COLUMNS, "Unused Column"])


def test_clean_text_bars(spark):
    out = Q.load_clean(text_bars(spark))
    assert out.columns == ["symbol", *REQUIRED_COLUMNS]
    frame = pandas_of(out)
    assert frame["Date"].tolist() == [dt.date(2026, 1, 2), dt.date(2026, 1, 5)]
    assert frame["Close"].tolist() == [101.5, 102.5]


def test_clean_rejects_text_that_is_no_number(spark):
    with pytest.raises(PySparkException):
        Q.clean_bars(text_bars(spark).withColumn("Close", F.lit("n/a"))).collect()


def test_nan_becomes_missing(spark):
    bars = valid_bars(spark, {(1, "Close"): float("nan"), (2, "Open"): float("inf")})
    out = pandas_of(Q.clean_bars(bars))
    assert out["Close"].isna().sum() == 1 and out["Open"].isna().sum() == 1


def test_valid_bars_pass(spark):
    assert Q.validate_raw_market_data(valid_bars(spark)).count() == 5


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.drop("Close"), "missing required columns: \\['Close'\\]"),
        (lambda df: df.limit(0), "Dataset is empty"),
        (lambda df: df.withColumn("Date", F.lit("not-a-date")), "cannot be parsed"),
        (lambda df: df.withColumn("Close", F.lit(None).cast("double")), "Missing values.*Close"),
        (lambda df: df.withColumn("Close", F.lit(float("nan"))), "Missing values.*Close"),
        (lambda df: df.withColumn("Date", F.lit("2026-01-02")), "Duplicate dates found"),
        (lambda df: df.withColumn("Open", F.lit(0.0)), "positive values: \\['Open'\\]"),
        (lambda df: df.withColumn("Volume", F.lit(-1)), "non-negative"),
    ],
)
def test_first_failing_check_raises(spark, change, message):
    with pytest.raises(DataContractError, match=message):
        Q.validate_raw_market_data(change(valid_bars(spark)))


def test_checks_keep_their_order(spark):
    broken = valid_bars(spark, {(0, "Close"): None, (1, "Open"): -1.0})
    with pytest.raises(DataContractError, match="Missing values"):
        Q.validate_raw_market_data(broken)


def test_coerce(spark):
    df = spark.createDataFrame([("2026-01-02", "1.5"), ("soon", "x")], "d string, n string")
    out = Q.coerce(df, {"d": "date", "n": "double"}).collect()
    assert out[0]["d"] == dt.date(2026, 1, 2) and out[0]["n"] == 1.5
    assert out[1]["d"] is None and out[1]["n"] is None


def failed(results):
    rows = results.where("success = false").collect()
    return {(r["expectation_type"], r["column"]) for r in rows}


def test_contract_sizes():
    assert len(C.raw_contract()) == 19 and len(C.feature_contract()) == 27


def test_valid_tables_satisfy_their_contracts(spark):
    assert not failed(C.evaluate(valid_bars(spark), C.raw_contract()))
    stored = valid_features(spark).withColumn("row_pos", F.unix_date("Date"))
    results = C.evaluate(stored, C.feature_contract())
    assert not failed(results) and results.where("success").count() == 27


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({(0, "Close"): -1.0}, {(C.BETWEEN, "Close"), (C.PAIR, None)}),
        ({(1, "Date"): FIRST}, {(C.UNIQUE, "Date")}),
        ({(1, "Volume"): -5}, {(C.BETWEEN, "Volume")}),
        ({(2, "Open"): None}, {(C.NOT_NULL, "Open"), (C.PAIR, None)}),
        ({(2, "Open"): float("nan")}, {(C.NOT_NULL, "Open"), (C.PAIR, None)}),
    ],
)
def test_broken_bars(spark, changes, expected):
    assert failed(C.evaluate(valid_bars(spark, changes), C.raw_contract())) == expected


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({(0, TARGET): 2}, {(C.IN_SET, TARGET)}),
        ({(0, "rsi_14"): None}, {(C.NOT_NULL, "rsi_14")}),
        ({(0, "rsi_14"): 101.0}, {(C.BETWEEN, "rsi_14")}),
        ({(0, "log_return"): float("-inf")}, {(C.NOT_IN_SET, "log_return")}),
        ({(0, "sma_10"): -1.0}, {(C.BETWEEN, "sma_10")}),
    ],
)
def test_broken_features(spark, changes, expected):
    stored = valid_features(spark, changes).withColumn("row_pos", F.unix_date("Date"))
    assert failed(C.evaluate(stored, C.feature_contract())) == expected


def test_stored_order(spark):
    newest_first = valid_features(spark).withColumn("row_pos", -F.unix_date("Date"))
    assert failed(C.evaluate(newest_first, C.feature_contract())) == {(C.INCREASING, "Date")}
    unknown = C.evaluate(valid_features(spark), C.feature_contract())
    assert [r["expectation_type"] for r in unknown.where("success IS NULL").collect()] == [
        C.INCREASING
    ]


def test_missing_column_fails_its_rules(spark):
    found = failed(C.evaluate(valid_bars(spark).drop("Volume"), C.raw_contract()))
    assert found == {(C.COLUMNS, None), (C.BETWEEN, "Volume")}
    assert (C.ROW_COUNT, None) in failed(C.evaluate(valid_bars(spark).limit(0), C.raw_contract()))


def test_pair_rule_skips_rows_without_both(spark):
    none = {(0, "Open"): None, (0, "Low"): None, (0, "High"): None, (0, "Close"): None}
    assert (C.PAIR, None) not in failed(C.evaluate(valid_bars(spark, none), C.raw_contract()))


def test_report_and_enforcement(spark):
    good = C.report(C.evaluate(valid_bars(spark), C.raw_contract()), "n", "good")
    bad_rows = valid_bars(spark, {(1, "Volume"): -5, (0, "High"): 1.0})
    bad = C.report(C.evaluate(bad_rows, C.raw_contract()), "n", "bad")
    row = bad.first()
    assert not row["success"] and row["total_expectations"] == 19
    assert row["successful_expectations"] == 16 and row["failed_expectations"] == 3
    assert row["failed_expectation_types"] == [C.BETWEEN, C.PAIR, C.PAIR]
    assert row["failed_expectation_details"][0]["column"] == "Volume"
    assert len(bad.columns) == 10 and row["unevaluated_expectations"] == 0
    C.enforce(good)
    with pytest.raises(DataContractError, match=r"(?s)1 of 2 .*bad: .*between on Volume"):
        C.enforce(good, bad)


def test_a_rule_that_was_not_judged_is_no_success(spark):
    results = C.evaluate(valid_features(spark), C.feature_contract())
    row = C.report(results, "n", "t").first()
    assert not row["success"] and row["unevaluated_expectations"] == 1
    assert row["successful_expectations"] == 26 and row["failed_expectations"] == 0
    assert C.report(results, "n", "t", allow_unevaluated=True).first()["success"]
    with pytest.raises(DataContractError, match="1 not judged"):
        C.enforce(C.report(results, "n", "t"))


def test_stored_order_comes_from_the_files(spark, tmp_path):
    rows = valid_features(spark).coalesce(1)
    for name, order, broken in (("old", F.col("Date"), set()), ("new", F.col("Date").desc(), {(C.INCREASING, "Date")})):
        path = str(tmp_path / name)
        rows.sortWithinPartitions(order).write.parquet(path)
        assert failed(C.evaluate(read_in_stored_order(spark, path), C.feature_contract())) == broken


def test_stored_order_across_files(spark, tmp_path):
    rows = valid_features(spark).orderBy("Date").collect()
    for name, halves, broken in (("up", (rows[:2], rows[2:]), set()), ("down", (rows[2:], rows[:2]), {(C.INCREASING, "Date")})):
        for i, part in enumerate(halves):
            spark.createDataFrame(part, valid_features(spark).schema).coalesce(1).write.parquet(str(tmp_path / name / f"f={i}"))
        stored = read_in_stored_order(spark, str(tmp_path / name)).drop("f")
        assert failed(C.evaluate(stored, C.feature_contract())) == broken


def test_missing_dates_are_not_admitted(spark):
    with pytest.raises(DataContractError, match="without Date"):
        C.admit_features(valid_features(spark, {(0, "Date"): None}))


def test_violations(spark):
    bars = valid_bars(spark, {(0, "Close"): -1.0, (2, "Date"): FIRST})
    out = C.violations(bars, C.raw_contract()).collect()
    assert sorted((r["Open"], r["failed_rule"]) for r in out) == sorted(
        [
            (100.0, "expect_column_values_to_be_between(Close)"),
            (100.0, "expect_column_pair_values_a_to_be_greater_than_b(Close,Low)"),
            (100.0, "expect_column_values_to_be_unique(Date)"),
            (102.0, "expect_column_values_to_be_unique(Date)"),
        ]
    )
    assert C.violations(valid_bars(spark), C.raw_contract()).count() == 0


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.limit(0), "empty"),
        (lambda df: df.drop("rsi_14"), "rsi_14"),
        (lambda df: df.unionByName(df), "duplicate dates"),
        (lambda df: df.withColumn(TARGET, F.lit(3)), "only 0 or 1"),
    ],
)
def test_feature_admission(spark, change, message):
    with pytest.raises(DataContractError, match=message):
        C.admit_features(change(valid_features(spark)))


def test_admitted_features_ignore_missing_targets(spark):
    out = C.admit_features(valid_features(spark, {(0, TARGET): None}).withColumn("x", F.lit(1)))
    assert out.columns == ["symbol", "Date", *FEATURES, TARGET] and out.count() == 5
