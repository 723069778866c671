"""Streams against the batch operators on the same rows."""

import datetime as dt

import numpy as np
import pandas as pd
from conftest import bars_of, pandas_of
from pyspark.sql import functions as F

from barlake.functions.scratch import scratch_path
from barlake.operators import contracts
from barlake.operators import features as X
from barlake.schemas import FEATURES, TARGET
from barlake.streaming import bars as B
from barlake.streaming import features as SF
from barlake.streaming import gate, runs

TRADES = "symbol string, ts timestamp_ntz, trade long, price double, volume long"


def at(minute, hour=10):
    return dt.datetime(2024, 1, 1, hour, minute)


def feed(spark, schema, batches, start):
    """Run the stream after each batch of rows has arrived."""
    folder = scratch_path(spark, "feed")
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(folder)
        start(spark.readStream.schema(schema).parquet(folder)).awaitTermination()


def test_bars_of_batches_and_the_rule_for_late_trades(spark):
    batches = [
        [("A", at(5), 1, 10.0, 1), ("A", at(50), 3, 12.0, 2), ("B", at(10), 2, 5.0, 1)],
        # A trade of an open bar in a later batch counts, also if it is the first of its bar.
        [("A", at(1), 0, 9.0, 1), ("A", at(30, 12), 9, 20.0, 1), ("A", None, 8, 1.0, 1)],
        # The watermark stands at 11:30: the bar from 10:00 is closed, that from 11:00 open.
        [("A", at(59), 4, 99.0, 1), ("A", at(10, 11), 5, 15.0, 1)],
    ]
    out, state = scratch_path(spark, "bars"), scratch_path(spark, "bars-state")
    frames = [spark.createDataFrame(b, TRADES) for b in batches]
    feed(spark, frames[0].schema, frames, lambda rows: B.start_bars(B.tumbling_bars(rows), out, "t-bars", state))
    found = {(r["symbol"], r["Date"].hour): tuple(r[c] for c in ("Open", "High", "Low", "Close", "Volume")) for r in B.latest_bars(spark, out).collect()}
    assert found == {
        ("A", 10): (9.0, 12.0, 9.0, 12.0, 4),
        ("B", 10): (5.0, 5.0, 5.0, 5.0, 1),
        ("A", 12): (20.0, 20.0, 20.0, 20.0, 1),
        ("A", 11): (15.0, 15.0, 15.0, 15.0, 1),
    }


def test_times_do_not_depend_on_the_session_time_zone(spark):
    df = spark.createDataFrame([(at(5, 2),), (dt.datetime(1969, 12, 31, 23, 59, 59, 250000),)], "ts timestamp_ntz")
    want = [r["ts"] for r in df.collect()]
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            back = df.select(runs.zoneless(runs.zoned("ts")).alias("ts"), runs.micros("ts").alias("m")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [r["ts"] for r in back] == want and back[1]["m"] == -750_000


def test_features_equal_the_batch_operator_across_restarts(spark):
    rng = np.random.default_rng(4)
    closes = 100 + np.cumsum(rng.normal(0, 1, 90))
    volumes = [int(v) for v in rng.integers(1, 9, 90)]
    volumes[40] = 0
    both = bars_of(spark, closes.tolist(), volumes).unionByName(bars_of(spark, [50.0] * 30 + (closes[:60] + 7).tolist(), volumes, symbol="U"))
    gone = both.withColumn("Close", F.when(F.dayofyear("Date") != 50, F.col("Close")))
    days = sorted(r["Date"] for r in gone.select("Date").distinct().collect())
    cuts = [days[0], days[1], days[30], days[31], days[70], dt.date(2100, 1, 1)]
    batches = [gone.where((F.col("Date") >= a) & (F.col("Date") < b)) for a, b in zip(cuts, cuts[1:])]
    # A bar of a day that has been there already, and one without date, are left out.
    batches[3] = batches[3].unionByName(batches[0]).unionByName(batches[0].withColumn("Date", F.lit(None).cast("date")))
    out, state = scratch_path(spark, "f"), scratch_path(spark, "f-state")
    feed(spark, gone.schema, batches, lambda rows: SF.start_features(rows, out, "t-features", checkpoint=state))
    columns = ["symbol", "Date", *FEATURES, TARGET]
    want, found = pandas_of(X.market_features(gone))[columns], pandas_of(spark.read.parquet(out))[columns]
    assert len(want) > 60
    pd.testing.assert_frame_equal(found, want, check_dtype=False, rtol=1e-9, atol=1e-12)


def test_state_expires_with_the_watermark(spark):
    early = bars_of(spark, list(range(100, 130)), start="2025-01-01")
    other = bars_of(spark, [5.0, 6.0], symbol="U", start="2026-06-01")
    later = bars_of(spark, list(range(130, 140)), start="2026-06-02")
    out, state = scratch_path(spark, "f"), scratch_path(spark, "f-state")
    feed(spark, early.schema, [early, other, later], lambda rows: SF.start_features(rows, out, "t-expiry", 100, state))
    found = pandas_of(spark.read.parquet(out))
    assert set(found["symbol"]) == {"T"} and found["Date"].max() < dt.date(2026, 1, 1) and len(found) == 10


def test_gate_splits_every_batch_once(spark):
    good = bars_of(spark, [10.0, 11.0, 12.0])
    bad = good.withColumn("Close", F.lit(-1.0)).withColumn("Volume", F.when(F.col("Open") > 11, F.col("Volume")))
    rules = contracts.raw_contract()
    out, state = scratch_path(spark, "gate"), scratch_path(spark, "gate-state")
    feed(spark, good.schema, [good, bad], lambda rows: gate.start_gate(rows, rules, out, "t-gate", state))

    def sides():
        return {s: gate.read_side(spark, out, s).count() for s in (gate.ACCEPTED, gate.QUARANTINE)}

    assert sides() == {gate.ACCEPTED: 3, gate.QUARANTINE: 3}
    names = {n for r in gate.read_side(spark, out, gate.QUARANTINE).collect() for n in r[gate.FAILED]}
    assert f"{contracts.BETWEEN}(Close)" in names and f"{contracts.PAIR}(Close,Low)" in names
    # The same batch again, as after a failure between writing and committing.
    runs.batch_writer(out, gate.VERDICT)(gate.judged(bad, rules), 1)
    assert sides() == {gate.ACCEPTED: 3, gate.QUARANTINE: 3}
    together = gate.read_side(spark, out, gate.ACCEPTED).unionByName(gate.read_side(spark, out, gate.QUARANTINE))
    assert together.select(*good.columns).exceptAll(good.unionByName(bad)).count() == 0
    lacking = gate.judged(good.drop("Open"), rules).where(F.col(gate.VERDICT) == gate.ACCEPTED)
    assert lacking.count() == 0
