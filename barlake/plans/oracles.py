"""Reference SQL for the named queries, over the same tables.

Written independently of the DataFrame code: plain windows over whole series,
recursion for exponential averages, self-joins for events and pairs.
"""

from __future__ import annotations

from barlake.plans.queries import (
    CASE_END,
    CASE_START,
    DEEP_DRAWDOWN,
    EVENT_HOURS,
    ODD_EVENTS,
    FIXED_MODEL,
    RANGE_END,
    REFERENCE_NATIONS,
    RANGE_START,
    UPSERT_FROM,
    WINDOW_MINUTES,
)
from barlake.operators.drift import EXACT_CELLS
from barlake.operators.features import WIDE_FEATURES
from barlake.schemas import BASELINE_FEATURES, FEATURES, METRICS, NEWS_FEATURES, PRICE_COLUMNS, TARGET

W = "PARTITION BY symbol ORDER BY Date"
PRICES = 'Open, High, Low, Close, "Adj Close", Volume'


def frame(n: int, over: str = W) -> str:
    return f"({over} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(fn: str, x: str, n: int, over: str = W) -> str:
    window = frame(n, over)
    return f"CASE WHEN count({x}) OVER {window} = {n} THEN {fn}({x}) OVER {window} END"


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def bars(symbol: str) -> str:
    trade = "row(l_orderkey * 10 + l_linenumber, l_extendedprice)"
    return f"""
      SELECT {symbol} AS symbol, CAST(l_shipdate AS DATE) AS Date,
             arg_min(l_extendedprice, {trade}) AS Open, max(l_extendedprice) AS High,
             min(l_extendedprice) AS Low, arg_max(l_extendedprice, {trade}) AS Close,
             arg_max(l_extendedprice, {trade}) AS "Adj Close",
             CAST(sum(l_quantity) AS BIGINT) AS Volume
      FROM lineitem GROUP BY 1, 2"""


LINE_BARS = bars("l_returnflag")
EVENT_BARS = """
      SELECT 'ALL' AS symbol, date_trunc('hour', ts) AS Date,
             arg_min(value, event_id) + 100 AS Open, max(value) + 100 AS High,
             min(value) + 100 AS Low, arg_max(value, event_id) + 100 AS Close,
             arg_max(value, event_id) + 100 AS "Adj Close", count(*) AS Volume
      FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""
NEWS = """
      SELECT 'ALL' AS symbol, date_trunc('hour', ts) AS Date, (value - 50) / 50 AS sentiment_score
      FROM events WHERE event_type <> 'purchase'"""
SENTIMENT = f"""
      SELECT *, sentiment_mean - lag(sentiment_mean) OVER ({W}) AS sentiment_momentum
      FROM (SELECT symbol, Date, avg(sentiment_score) AS sentiment_mean,
                   stddev_samp(sentiment_score) AS sentiment_std,
                   ln(1 + count(*)) AS news_volume
            FROM ({NEWS}) GROUP BY 1, 2)"""
TICKS = """
      SELECT event_type AS symbol, ts AS Date, event_id, value + 100 AS Close FROM events"""
TICK_W = "PARTITION BY symbol ORDER BY Date, event_id"


def rsi(over: str = W) -> str:
    up, down = roll("avg", "greatest(_d, 0)", 14, over), roll("avg", "greatest(-_d, 0)", 14, over)
    # greatest() skips NULL, so the frames below count the change itself.
    up = up.replace("count(greatest(_d, 0))", "count(_d)")
    down = down.replace("count(greatest(-_d, 0))", "count(_d)")
    return f"""CASE WHEN ({down}) = 0 AND ({up}) > 0 THEN 100.0
                    WHEN ({down}) > 0 THEN 100 - 100 / (1 + ({up}) / ({down})) END"""


def features(source: str) -> str:
    """The eight features and the target, complete rows only."""
    return f"""
      SELECT * FROM (
        SELECT *, {rsi()} AS rsi_14, {roll("stddev_samp", "log_return", 10)} AS volatility_10,
               Close / sma_10 - 1 AS sma_ratio_10
        FROM (SELECT *, Close - lag(Close) OVER ({W}) AS _d,
                     Close / lag(Close) OVER ({W}) - 1 AS simple_return,
                     ln(Close / lag(Close) OVER ({W})) AS log_return,
                     {roll("avg", "Close", 10)} AS sma_10, {roll("avg", "Close", 20)} AS sma_20,
                     CASE WHEN lag(Volume) OVER ({W}) > 0
                          THEN Volume / lag(Volume) OVER ({W}) - 1 END AS volume_change,
                     CASE WHEN lead(Close) OVER ({W}) IS NOT NULL
                          THEN CAST(lead(Close) OVER ({W}) > Close AS INTEGER) END AS {TARGET}
              FROM ({source})))
      WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*FEATURES, TARGET])}"""


FEATURE_ROWS = features(LINE_BARS)


def ema_ctes(source: str) -> str:
    """Exponential averages by recursion, row by row; needs WITH RECURSIVE."""

    def step(span: int, x: str, before: str) -> str:
        a = f"(2.0::DOUBLE / {span + 1})"
        return f"{a} * {x} + (1 - {a}) * {before}"

    e12, e26 = step(12, "n.Close", "e.e12"), step(26, "n.Close", "e.e26")
    return f"""
      numbered AS MATERIALIZED (
        SELECT *, row_number() OVER ({W}) AS rn FROM ({source})),
      smooth AS (
        SELECT symbol, Date, rn, Close AS e10, Close AS e20, Close AS e12, Close AS e26,
               0::DOUBLE AS macd_signal
        FROM numbered WHERE rn = 1
        UNION ALL
        SELECT n.symbol, n.Date, n.rn, {step(10, "n.Close", "e.e10")},
               {step(20, "n.Close", "e.e20")}, {e12}, {e26},
               {step(9, f"(({e12}) - ({e26}))", "e.macd_signal")}
        FROM smooth e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1)"""


def drawdowns(source: str, deep: float) -> str:
    return f"""
      SELECT *, {roll("min", "drawdown_20", 20)} AS max_drawdown_20,
             drawdown_20 - lag(drawdown_20) OVER ({W}) AS drawdown_change,
             abs(drawdown_20) AS drawdown_abs,
             CASE WHEN count(*) OVER {frame(10)} = 10
                  THEN CAST(count(*) FILTER (drawdown_20 < {deep}) OVER {frame(10)} AS DOUBLE)
             END AS drawdown_persistence
      FROM (SELECT *, (Close - ({roll("max", "Close", 10)})) / ({roll("max", "Close", 10)})
                        AS drawdown_10,
                   (Close - ({roll("max", "Close", 20)})) / ({roll("max", "Close", 20)})
                        AS drawdown_20
            FROM ({source}))"""


def wide_ctes(source: str) -> str:
    """CTE ``wide``: all 32 derived columns, complete rows; needs WITH RECURSIVE."""
    return f"""{ema_ctes(source)},
      wide_raw AS (
        SELECT *, {rsi()} AS rsi_14,
               {roll("stddev_samp", "log_return", 10)} AS volatility_10,
               {roll("stddev_samp", "log_return", 20)} AS volatility_20,
               {roll("avg", "log_return * log_return", 20)} AS volatility_20_sq,
               {roll("sum", "log_return", 5)} AS ret_5, {roll("sum", "log_return", 10)} AS ret_10,
               Close / sma_10 - 1 AS sma_ratio_10, Close / sma_20 - 1 AS sma_ratio_20,
               Close / ema_10 - 1 AS ema_ratio_10, Close / ema_20 - 1 AS ema_ratio_20,
               macd - macd_signal AS macd_hist, Volume / volume_ma_10 AS volume_ratio_10
        FROM (SELECT d.*, s.e10 AS ema_10, s.e20 AS ema_20, s.e12 - s.e26 AS macd, s.macd_signal,
                     Close - lag(Close) OVER w AS _d, Close / lag(Close) OVER w - 1 AS simple_return,
                     ln(Close / lag(Close) OVER w) AS log_return,
                     Close / lag(Close, 5) OVER w - 1 AS mom_5,
                     Close / lag(Close, 10) OVER w - 1 AS mom_10,
                     (High - Low) / Close AS high_low_range, ln(1 + Volume) AS log_volume,
                     {roll("avg", "Close", 10)} AS sma_10, {roll("avg", "Close", 20)} AS sma_20,
                     {roll("avg", "Volume", 10)} AS volume_ma_10,
                     CASE WHEN lag(Volume) OVER w > 0
                          THEN Volume / lag(Volume) OVER w - 1 END AS volume_change
              FROM ({drawdowns("SELECT * FROM numbered", -0.02)}) d
              JOIN (SELECT symbol AS s_symbol, rn AS s_rn, e10, e20, e12, e26, macd_signal
                    FROM smooth) s ON s_symbol = d.symbol AND s_rn = d.rn
              WINDOW w AS ({W}))),
      wide AS (SELECT * FROM wide_raw
               WHERE {" AND ".join(f"{c} IS NOT NULL" for c in WIDE_FEATURES)})"""


FORWARD = f"""
      CASE WHEN count(log_return) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) = 5
           THEN sum(log_return) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) END
        AS future_return_5d,
      lead(Close, 5) OVER ({W}) / Close - 1 AS future_simple_return_5d"""


def returns(source: str) -> str:
    return f"""SELECT *, Close / lag(Close) OVER ({W}) - 1 AS simple_return,
                      ln(Close / lag(Close) OVER ({W})) AS log_return FROM ({source})"""


LABEL = """CASE WHEN future_return_5d > 0.015 THEN 'bullish'
                WHEN future_return_5d < -0.015 THEN 'bearish' ELSE 'neutral' END"""
LABEL_ORDER = """CASE WHEN future_return_5d > 0.015 THEN 2
                      WHEN future_return_5d < -0.015 THEN 0 ELSE 1 END"""


def joined(source: str) -> str:
    """Market rows with lagged sentiment; 0 where there was no news."""
    lagged = ", ".join(
        f"lag(coalesce({c}, 0)) OVER ({W}) AS {c}"
        for c in ["sentiment_mean", "sentiment_std", "news_volume", "sentiment_momentum"]
    )
    return f"""
      SELECT * EXCLUDE (sentiment_mean, sentiment_std, news_volume, sentiment_momentum), {lagged},
             CAST(news_volume IS NOT NULL AS INTEGER) AS news_available
      FROM ({source}) m LEFT JOIN ({SENTIMENT}) s USING (symbol, Date)"""


def labelled(source: str, names: list[str]) -> str:
    """5-step return and class; the last five rows of a series are dropped."""
    news = [c for c in names if c in NEWS_FEATURES]
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" if c in news else c for c in names)
    present = " AND ".join(f"{c} IS NOT NULL" for c in names if c not in news)
    return f"""
      SELECT symbol, Date, {filled}, future_return_5d, {LABEL} AS target,
             {LABEL_ORDER} AS target_order
      FROM (SELECT *, {FORWARD}, lead(Date, 5) OVER ({W}) AS _later FROM ({source}))
      WHERE _later IS NOT NULL AND future_return_5d IS NOT NULL AND {present}"""


HYBRID_NEWS = [c for c in NEWS_FEATURES if c not in ("sentiment_q25", "sentiment_q75")]
HYBRID = labelled(joined("SELECT * FROM wide"), BASELINE_FEATURES + HYBRID_NEWS)
JOINED = returns(joined(EVENT_BARS))

ANOMALY = f"""
      SELECT *, {roll("avg", "sentiment_anomaly", 30)} AS anomaly_trend
      FROM (SELECT *, sentiment_mean - sentiment_baseline AS sentiment_anomaly
            FROM (SELECT *, {roll("avg", "sentiment_mean", 20)} AS sentiment_smooth,
                         {roll("avg", "sentiment_mean", 60)} AS sentiment_baseline
                  FROM ({JOINED})))"""
ANOMALY_PARTIAL = f"""
      SELECT *, avg(sentiment_anomaly) OVER {frame(30)} AS anomaly_trend
      FROM (SELECT *, sentiment_mean - sentiment_baseline AS sentiment_anomaly
            FROM (SELECT *, avg(sentiment_mean) OVER {frame(30)} AS sentiment_baseline
                  FROM ({JOINED})))"""
PRESSURE = f"""
      SELECT symbol, Date, sentiment_pressure, future_simple_return_5d
      FROM (SELECT *, {roll("sum", "_negative", 5)} AS sentiment_pressure, {FORWARD}
            FROM (SELECT *, CASE WHEN sentiment_anomaly < 0 THEN sentiment_anomaly
                                 WHEN sentiment_anomaly IS NOT NULL THEN 0 END AS _negative
                  FROM ({ANOMALY})))
      WHERE sentiment_pressure IS NOT NULL AND future_simple_return_5d IS NOT NULL"""

EVENTS = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, 'ALL', TIMESTAMP '{hour}')" for i, hour in enumerate(EVENT_HOURS)
) + ") AS e(event_id, symbol, event_date)"

SPLIT = f"""
      SELECT * EXCLUDE (_i, _n),
             CASE WHEN _i < floor(_n * 0.7::DOUBLE) THEN 'train'
                  WHEN _i < floor(_n * 0.7::DOUBLE) + floor(_n * 0.15::DOUBLE) THEN 'validation'
                  ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER ({W}) - 1 AS _i, count(*) OVER (PARTITION BY symbol) AS _n
            FROM ({FEATURE_ROWS}))"""
PERIOD = f"""
      SELECT * EXCLUDE (_i, _n),
             CASE WHEN _i < floor(_n * 0.7::DOUBLE) THEN 'reference' ELSE 'current' END AS period
      FROM (SELECT *, row_number() OVER ({W}) - 1 AS _i, count(*) OVER (PARTITION BY symbol) AS _n
            FROM ({FEATURE_ROWS}))"""

SCALED_CTES = f"""
      split_rows AS MATERIALIZED ({SPLIT}),
      fit AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES)}
              FROM split_rows WHERE split = 'train'),
      scaled AS MATERIALIZED (
        SELECT symbol, Date, {", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in FEATURES)},
               {TARGET}, split
        FROM split_rows, fit)"""
LOGIT = f"{FIXED_MODEL.intercept} + " + " + ".join(
    f"({w}) * {c}" for c, w in zip(FEATURES, FIXED_MODEL.coefficients)
)
PREDICTED = f"""
      SELECT symbol, Date, split, {TARGET} AS actual_target,
             CAST(1 / (1 + exp(-({LOGIT}))) > 0.5 AS INTEGER) AS predicted_target,
             1 / (1 + exp(-({LOGIT}))) AS probability_up
      FROM scaled"""
SHAP_CTES = f"""{SCALED_CTES},
      explained AS (
        SELECT symbol, Date,
               {", ".join(f"({w}) * ({c} - avg({c}) OVER ()) AS {c}"
                          for c, w in zip(FEATURES, FIXED_MODEL.coefficients))}
        FROM scaled WHERE split = 'validation'),
      importance AS (
        SELECT *, row_number() OVER (ORDER BY mean_abs_shap_value DESC, feature) AS rank
        FROM ({" UNION ALL ".join(
            f"SELECT '{c}' AS feature, avg(abs({c})) AS mean_abs_shap_value FROM explained"
            for c in FEATURES)}))"""

SCORED = """
      SELECT m.model, doc_id, quality AS actual_target, CAST(m.p > 0.5 AS INTEGER) AS predicted_target,
             m.p AS probability_up
      FROM labels JOIN documents USING (doc_id),
           LATERAL (VALUES ('champion', round(n_chars / (n_chars + 2000), 2)),
                           ('challenger', round(1 / (1 + doc_id % 7), 2))) AS m(model, p)"""


def rates(source: str, by: str) -> str:
    return f"""
      SELECT {by},
             avg(CAST(actual_target = predicted_target AS DOUBLE)) AS accuracy,
             coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
             coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
             coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score
      FROM (SELECT *, count(*) FILTER (actual_target = 1 AND predicted_target = 1) OVER g AS tp,
                   count(*) FILTER (actual_target = 0 AND predicted_target = 1) OVER g AS fp,
                   count(*) FILTER (actual_target = 1 AND predicted_target = 0) OVER g AS fn
            FROM ({source}) WINDOW g AS (PARTITION BY {by}))
      GROUP BY {by}, tp, fp, fn"""


def auc(source: str, by: str) -> str:
    """By comparing every positive with every negative row."""
    return f"""
      SELECT p.{by}, avg(CASE WHEN p.probability_up > n.probability_up THEN 1.0::DOUBLE
                              WHEN p.probability_up = n.probability_up THEN 0.5::DOUBLE
                              ELSE 0.0::DOUBLE END) AS roc_auc
      FROM ({source}) p JOIN ({source}) n ON p.{by} = n.{by}
      WHERE p.actual_target = 1 AND n.actual_target = 0 GROUP BY 1"""


def evaluation(source: str, by: str) -> str:
    return f"SELECT * FROM ({rates(source, by)}) JOIN ({auc(source, by)}) USING ({by})"


LINE_ROWS = """
      SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS Date, l_extendedprice AS Open,
             l_extendedprice * (1 + l_tax - l_discount) AS High,
             l_extendedprice * (1 - l_discount) AS Low,
             l_extendedprice * (1 - l_discount / 2) AS Close,
             l_extendedprice AS "Adj Close", CAST(l_quantity AS BIGINT) AS Volume
      FROM lineitem"""
PAIRS = [("Open", "Low"), ("High", "Open"), ("Close", "Low"), ("High", "Close")]
EXPECT = "expect_column_values_to_"
PAIR_RULE = "expect_column_pair_values_a_to_be_greater_than_b"


def repeated(source: str) -> str:
    return f"""(SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM ({source})
                GROUP BY symbol, Date HAVING count(*) > 1))"""


def contract(rules: list[tuple[str, str | None, str]]) -> str:
    """(rule, column, unexpected count) rows over the CTE ``rows_in``."""
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{rule}' AS expectation_type,
                   {f"'{column}'" if column else "CAST(NULL AS VARCHAR)"} AS "column",
                   ({count}) = 0 AS success, CAST(({count}) AS BIGINT) AS unexpected"""
        for i, (rule, column, count) in enumerate(rules)
    )


def bad(condition: str) -> str:
    return f"SELECT count(*) FILTER ({condition}) FROM rows_in"


ROWS_IN = "SELECT * FROM rows_in"


def raw_rules() -> list[tuple[str, str | None, str]]:
    rules = [
        ("expect_table_columns_to_match_set", None, "0"),
        ("expect_table_row_count_to_be_between", None,
         "SELECT greatest(1 - count(*), 0) FROM rows_in"),
        (EXPECT + "not_be_null", "Date", bad("Date IS NULL")),
        (EXPECT + "be_unique", "Date", repeated(ROWS_IN)),
    ]
    for price in PRICE_COLUMNS:
        rules.append((EXPECT + "not_be_null", price, bad(f'"{price}" IS NULL')))
        rules.append((EXPECT + "be_between", price, bad(f'"{price}" <= 0')))
    rules.append((EXPECT + "be_between", "Volume", bad("Volume < 0")))
    return rules + [(PAIR_RULE, None, bad(f"{a} < {b}")) for a, b in PAIRS]


def feature_rules() -> list[tuple[str, str | None, str]]:
    rules = [
        ("expect_table_columns_to_match_set", None, "0"),
        ("expect_table_row_count_to_be_between", None,
         "SELECT greatest(1 - count(*), 0) FROM rows_in"),
        (EXPECT + "not_be_null", "Date", bad("Date IS NULL")),
        (EXPECT + "be_unique", "Date", repeated(ROWS_IN)),
        (EXPECT + "be_increasing", "Date",
         f"SELECT count(*) FILTER (Date < b) FROM (SELECT Date, lag(Date) OVER ({W}) AS b FROM rows_in)"),
    ]
    rules += [(EXPECT + "not_be_null", c, bad(f"{c} IS NULL")) for c in [*FEATURES, TARGET]]
    rules += [(EXPECT + "not_be_in_set", c, bad(f"isinf({c})")) for c in FEATURES]
    rules.append((EXPECT + "be_in_set", TARGET, bad(f"{TARGET} NOT IN (0, 1)")))
    rules += [
        (EXPECT + "be_between", c, bad(f"{c} < 0")) for c in ("sma_10", "sma_20", "volatility_10")
    ]
    return rules + [(EXPECT + "be_between", "rsi_14", bad("rsi_14 < 0 OR rsi_14 > 100"))]


def quality_rows() -> str:
    required = ["Date", *PRICE_COLUMNS, "Volume"]
    checks = [("empty", "", "SELECT CAST(count(*) = 0 AS BIGINT) FROM rows_in"),
              ("date_unparsable", "Date", "0")]
    checks += [("missing_value", c, bad(f'"{c}" IS NULL')) for c in required]
    checks += [("duplicate_date", "Date",
                "SELECT count(*) - count(DISTINCT row(symbol, Date)) FROM rows_in")]
    checks += [("non_positive_price", c, bad(f'"{c}" <= 0')) for c in PRICE_COLUMNS]
    checks += [("negative_volume", "Volume", bad("Volume < 0"))]
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{name}' AS check_name, '{column}' AS column_name,
                   CAST(({count}) AS BIGINT) AS violations"""
        for i, (name, column, count) in enumerate(checks)
    )


def drift_ctes() -> str:
    """CTE ``gap``: both distribution functions at every distinct value."""
    return f"""
      long AS MATERIALIZED (
        SELECT period, feature, value
        FROM (UNPIVOT (SELECT period, {", ".join(FEATURES)} FROM ({PERIOD}))
              ON {", ".join(FEATURES)} INTO NAME feature VALUE value)),
      per_value AS (
        SELECT feature, value, count(*) FILTER (period = 'reference') AS r,
               count(*) FILTER (period = 'current') AS c
        FROM long GROUP BY 1, 2),
      gap AS (
        SELECT feature, value, lead(value) OVER v AS next_value,
               abs(sum(r) OVER v / sum(r) OVER (PARTITION BY feature)
                   - sum(c) OVER v / sum(c) OVER (PARTITION BY feature)) AS gap
        FROM per_value WINDOW v AS (PARTITION BY feature ORDER BY value)),
      drift AS (
        SELECT feature, _distance / greatest(_std, 0.001) AS drift_score
        FROM (SELECT feature, sum(gap * (next_value - value)) AS _distance FROM gap GROUP BY 1)
        JOIN (SELECT feature, stddev_pop(value) AS _std FROM long
              WHERE period = 'reference' GROUP BY 1) USING (feature))"""


def pair_correlations(source: str, pairs: list[tuple[str, str]], labels: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {", ".join(f"'{v}' AS {k}" for k, v in zip(labels, pair))},
                   round(corr({pair[0]}, {pair[1] if len(labels) > 1 else "future_return_5d"}), 6)
                     AS correlation FROM {source}"""
        for pair in pairs
    )


def trajectory(column: str, before: str, shortest: str) -> str:
    return f"""
      WITH s AS MATERIALIZED (SELECT * FROM ({SENTIMENT})), e AS ({EVENTS}),
      near AS (
        SELECT event_id, {column} AS x, -row_number() OVER (PARTITION BY event_id ORDER BY s.Date DESC)
                 AS o
        FROM e JOIN s ON s.symbol = e.symbol AND s.Date < e.event_date
        QUALIFY o >= -30
        {before}),
      sized AS (SELECT *, count(*) OVER (PARTITION BY event_id) AS rows_in FROM near),
      {shortest}
      SELECT CAST(day AS INTEGER) AS day, round(avg(x), 6) AS mean_value,
             round(stddev_pop(x), 6) AS std_value, count(*) AS events
      FROM kept GROUP BY day"""


FIRST_ROWS = f"""UNION ALL
        SELECT event_id, sentiment_momentum,
               row_number() OVER (PARTITION BY event_id ORDER BY s.Date) - 1 AS o
        FROM e JOIN s ON s.symbol = e.symbol AND s.Date >= e.event_date
        QUALIFY o < 30"""

ORACLES: dict[str, str] = {
    "scan_bars": f"SELECT symbol, Date, {PRICES} FROM ({LINE_BARS})",
    "scan_single_series": f"SELECT symbol, Date, {PRICES} FROM ({bars(chr(39) + 'ALL' + chr(39))})",
    "scan_event_bars": f"""SELECT symbol, Date, round(Open, 6) AS Open, round(High, 6) AS High,
        round(Low, 6) AS Low, round(Close, 6) AS Close, round("Adj Close", 6) AS "Adj Close", Volume
        FROM ({EVENT_BARS})""",
    "normalize_wide": f"SELECT symbol, Date, {PRICES} FROM ({LINE_BARS})",
    "clean_bars": f"SELECT symbol, Date, {PRICES} FROM ({LINE_BARS})",
    "feature_upsert": f"""
      SELECT symbol, Date, {r6(*[c for c in FEATURES if c != "volume_change"])},
             round(CASE WHEN Date >= DATE '{UPSERT_FROM}' THEN volume_change + 1
                        ELSE volume_change END, 6) AS volume_change, {TARGET},
             CASE WHEN Date >= DATE '{UPSERT_FROM}' THEN 2 ELSE 1 END AS version
      FROM ({FEATURE_ROWS})""",
    "feature_view": f"SELECT {r6(*FEATURES)}, {TARGET} FROM ({FEATURE_ROWS})",
    "feature_upload_summary": f"""
      SELECT 'market_features' AS feature_group_name, 1 AS feature_group_version,
             'market_training' AS feature_view_name, 1 AS feature_view_version,
             'Date' AS primary_key, 'Date' AS event_time, '{",".join(FEATURES)}' AS feature_columns,
             '{TARGET}' AS target_column, count(*) AS rows_uploaded, true AS feature_view_created
      FROM ({FEATURE_ROWS})""",
    "daily_sentiment_export": f"""
      SELECT symbol, Date, round(sentiment_mean, 6) AS sentiment FROM ({SENTIMENT})""",
    "coerce_parse": """
      SELECT l_returnflag AS symbol,
             TRY_CAST(CASE WHEN l_linestatus = 'O' THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
                           ELSE 'not shipped' END AS DATE) AS Date,
             count(*) AS rows,
             count(TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'n/a'
                                 ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE)) AS numbers,
             sum(TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'n/a'
                               ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE)) AS amount
      FROM lineitem GROUP BY 1, 2""",
    "finite_guard": """
      SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS Date,
             round(max(CASE WHEN l_discount > 0 THEN l_quantity / l_discount ELSE 0 END), 6) AS largest,
             count(*) FILTER (NOT l_discount > 0 OR l_quantity = 0) AS zeros
      FROM lineitem GROUP BY 1, 2""",
    "case_study_window": f"""
      SELECT symbol, Date, round(Close, 6) AS Close, round(sentiment_mean, 6) AS sentiment_mean
      FROM ({EVENT_BARS}) JOIN ({SENTIMENT}) USING (symbol, Date)
      WHERE Date BETWEEN TIMESTAMP '{CASE_START}' AND TIMESTAMP '{CASE_END}'""",
    "rows_with_news_month": f"""
      SELECT symbol, Date, round(Open, 6) AS Open, round(High, 6) AS High, round(Low, 6) AS Low,
             round(Close, 6) AS Close, round("Adj Close", 6) AS "Adj Close", Volume,
             {r6("sentiment_mean", "sentiment_std", "news_volume", "sentiment_momentum")},
             news_available, {r6("simple_return", "log_return")}
      FROM ({JOINED}) WHERE year(Date) = 2024 AND month(Date) = 1 AND news_available = 1""",
    "features_in_range": f"""
      SELECT symbol, Date, {PRICES}, {r6(*FEATURES)}, {TARGET} FROM ({FEATURE_ROWS})
      WHERE Date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'""",
    "f_returns": f"""
      SELECT symbol, Date, Close, {r6("simple_return", "log_return")} FROM ({returns(LINE_BARS)})""",
    "f_sma": f"""
      SELECT symbol, Date, Close, {r6("sma_10", "sma_20")},
             round(Close / sma_10 - 1, 6) AS sma_ratio_10, round(Close / sma_20 - 1, 6) AS sma_ratio_20
      FROM (SELECT *, {roll("avg", "Close", 10)} AS sma_10, {roll("avg", "Close", 20)} AS sma_20
            FROM ({LINE_BARS}))""",
    "f_ema": f"""
      WITH RECURSIVE {ema_ctes(LINE_BARS)}
      SELECT symbol, Date, Close, round(e10, 6) AS ema_10, round(e20, 6) AS ema_20,
             round(Close / e10 - 1, 6) AS ema_ratio_10, round(Close / e20 - 1, 6) AS ema_ratio_20
      FROM smooth JOIN numbered USING (symbol, Date, rn)""",
    "f_macd": f"""
      WITH RECURSIVE {ema_ctes(LINE_BARS)}
      SELECT symbol, Date, Close, round(e12 - e26, 6) AS macd, round(macd_signal, 6) AS macd_signal,
             round(e12 - e26 - macd_signal, 6) AS macd_hist
      FROM smooth JOIN numbered USING (symbol, Date, rn)""",
    "f_rsi": f"""
      SELECT symbol, Date, Close, round({rsi()}, 6) AS rsi_14
      FROM (SELECT *, Close - lag(Close) OVER ({W}) AS _d FROM ({LINE_BARS}))""",
    "f_momentum": f"""
      SELECT symbol, Date, Close, round(Close / lag(Close, 5) OVER ({W}) - 1, 6) AS mom_5,
             round(Close / lag(Close, 10) OVER ({W}) - 1, 6) AS mom_10,
             round({roll("sum", "log_return", 5)}, 6) AS ret_5,
             round({roll("sum", "log_return", 10)}, 6) AS ret_10
      FROM ({returns(LINE_BARS)})""",
    "f_volatility": f"""
      SELECT symbol, Date, Close,
             round({roll("stddev_samp", "log_return", 10)}, 6) AS volatility_10,
             round({roll("stddev_samp", "log_return", 20)}, 6) AS volatility_20,
             round({roll("avg", "log_return * log_return", 20)}, 6) AS volatility_20_sq,
             round((High - Low) / Close, 6) AS high_low_range
      FROM ({returns(LINE_BARS)})""",
    "f_drawdown": f"""
      SELECT symbol, Date, Close,
             {r6("drawdown_10", "drawdown_20", "max_drawdown_20", "drawdown_change", "drawdown_abs")},
             drawdown_persistence
      FROM ({drawdowns(LINE_BARS, DEEP_DRAWDOWN)})""",
    "f_volume": f"""
      SELECT symbol, Date, Volume, round(ln(1 + Volume), 6) AS log_volume,
             round(CASE WHEN lag(Volume) OVER ({W}) > 0
                        THEN Volume / lag(Volume) OVER ({W}) - 1 END, 6) AS volume_change,
             round({roll("avg", "Volume", 10)}, 6) AS volume_ma_10,
             round(Volume / ({roll("avg", "Volume", 10)}), 6) AS volume_ratio_10
      FROM ({LINE_BARS})""",
    "f_target": f"""
      SELECT symbol, Date, Close, CAST(lead(Close) OVER ({W}) > Close AS INTEGER) AS {TARGET}
      FROM ({LINE_BARS})""",
    "forward_return": f"""
      SELECT symbol, Date, Close, {r6("future_return_5d", "future_simple_return_5d")}
      FROM (SELECT *, {FORWARD} FROM ({returns(LINE_BARS)}))""",
    "label_3class": f"""
      SELECT symbol, Date, {r6("future_return_5d")}, {LABEL} AS target, {LABEL_ORDER} AS target_order
      FROM (SELECT *, {FORWARD} FROM ({returns(LINE_BARS)})) q WHERE q.future_return_5d IS NOT NULL""",
    "market_features": f"SELECT symbol, Date, {PRICES}, {r6(*FEATURES)}, {TARGET} FROM ({FEATURE_ROWS})",
    "market_features_wide": f"""
      WITH RECURSIVE {wide_ctes(LINE_BARS)}
      SELECT symbol, Date, {PRICES}, {r6(*WIDE_FEATURES)} FROM wide""",
    "market_features_by_supplier": f"""
      SELECT symbol, Date, {PRICES}, {r6(*FEATURES)}, {TARGET}
      FROM ({features(bars("CAST(l_suppkey AS VARCHAR)"))})""",
    "single_series_features": f"""
      SELECT symbol, Date, {PRICES}, {r6(*FEATURES)}, {TARGET} FROM ({features(bars("'ALL'"))})""",
    "tick_sma": f"""
      SELECT symbol, Date, event_id, {r6("sma_10", "sma_20")},
             round(Close / sma_20 - 1, 6) AS sma_ratio_20
      FROM (SELECT *, {roll("avg", "Close", 10, TICK_W)} AS sma_10,
                   {roll("avg", "Close", 20, TICK_W)} AS sma_20 FROM ({TICKS}))""",
    "tick_rsi": f"""
      SELECT symbol, Date, event_id, round({rsi(TICK_W)}, 6) AS rsi_14
      FROM (SELECT *, Close - lag(Close) OVER ({TICK_W}) AS _d FROM ({TICKS}))""",
    "tick_target": f"""
      SELECT symbol, Date, event_id, CAST(lead(Close) OVER ({TICK_W}) > Close AS INTEGER) AS {TARGET}
      FROM ({TICKS})""",
    "tick_split": f"""
      SELECT symbol, Date, event_id,
             CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train'
                  WHEN i < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation'
                  ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER ({TICK_W}) - 1 AS i,
                   count(*) OVER (PARTITION BY symbol) AS n FROM ({TICKS}))""",
    "daily_sentiment": f"""
      SELECT symbol, Date,
             {r6("sentiment_mean", "sentiment_std", "news_volume", "sentiment_momentum")}
      FROM ({SENTIMENT})""",
    "sentiment_in_range": f"""
      SELECT symbol, Date, round(avg(sentiment_score), 6) AS sentiment_mean FROM ({NEWS})
      WHERE Date BETWEEN TIMESTAMP '{CASE_START}' AND TIMESTAMP '{CASE_END}' GROUP BY 1, 2""",
    "hybrid_dataset": f"""
      WITH RECURSIVE {wide_ctes(EVENT_BARS)}
      SELECT symbol, Date, {r6(*BASELINE_FEATURES, *[c for c in HYBRID_NEWS if c != "news_available"])},
             news_available, round(q.future_return_5d, 6) AS future_return_5d, target, target_order
      FROM ({HYBRID}) q""",
    "baseline_dataset": f"""
      WITH RECURSIVE {wide_ctes(LINE_BARS)}
      SELECT symbol, Date, {r6(*BASELINE_FEATURES)},
             round(q.future_return_5d, 6) AS future_return_5d, target, target_order
      FROM ({labelled("SELECT * FROM wide", BASELINE_FEATURES)}) q""",
    "dataset_metadata": f"""
      WITH RECURSIVE {wide_ctes(EVENT_BARS)}
      SELECT 'HYBRID' AS mode, count(*) AS n_rows, {len(BASELINE_FEATURES + HYBRID_NEWS)} AS n_features,
             '{",".join(BASELINE_FEATURES + HYBRID_NEWS)}' AS features
      FROM ({HYBRID})""",
    "sentiment_anomaly": f"""
      SELECT symbol, Date, {r6("sentiment_mean", "sentiment_smooth", "sentiment_baseline",
                               "sentiment_anomaly", "anomaly_trend")}
      FROM ({ANOMALY})""",
    "sentiment_anomaly_partial": f"""
      SELECT symbol, Date, {r6("sentiment_mean", "sentiment_baseline", "sentiment_anomaly",
                               "anomaly_trend")}
      FROM ({ANOMALY_PARTIAL})""",
    "sentiment_pressure": f"""
      SELECT symbol, Date, {r6("sentiment_pressure", "future_simple_return_5d")} FROM ({PRESSURE})""",
    "pressure_buckets": f"""
      WITH pairs AS MATERIALIZED ({PRESSURE}),
      edges AS (SELECT symbol, quantile_cont(sentiment_pressure, 0.25) AS q1,
                       quantile_cont(sentiment_pressure, 0.5) AS q2,
                       quantile_cont(sentiment_pressure, 0.75) AS q3
                FROM pairs WHERE sentiment_pressure < 0 GROUP BY 1)
      SELECT symbol,
             CASE WHEN sentiment_pressure = 0 THEN 'No Negative Sentiment'
                  WHEN sentiment_pressure <= q1 THEN 'Very Negative'
                  WHEN sentiment_pressure <= q2 THEN 'Negative'
                  WHEN sentiment_pressure <= q3 THEN 'Mild Negative'
                  ELSE 'Slight Negative' END AS bucket,
             count(*) AS rows,
             round(avg(future_simple_return_5d) * 100, 6) AS mean_future_return_pct,
             round(avg(CAST(future_simple_return_5d < 0 AS DOUBLE)) * 100, 6) AS drop_share_pct
      FROM pairs LEFT JOIN edges USING (symbol) WHERE sentiment_pressure <= 0 GROUP BY 1, 2""",
    "local_minima": f"""
      SELECT symbol, Date, round(sentiment_anomaly, 6) AS sentiment_anomaly
      FROM (SELECT *, lag(sentiment_anomaly) OVER ({W}) AS b, lead(sentiment_anomaly) OVER ({W}) AS a
            FROM ({ANOMALY})) q
      WHERE q.sentiment_anomaly < -0.1 AND b > q.sentiment_anomaly AND a > q.sentiment_anomaly""",
    "extreme_days": f"""
      WITH a AS MATERIALIZED ({ANOMALY}),
      t AS (SELECT symbol, quantile_cont(anomaly_trend, 0.05) AS threshold FROM a GROUP BY 1)
      SELECT symbol, Date, round(a.anomaly_trend, 6) AS anomaly_trend,
             round(t.threshold, 6) AS threshold
      FROM a JOIN t USING (symbol) WHERE a.anomaly_trend < t.threshold""",
    "return_sentiment": f"""
      SELECT symbol, Date, round(log_return, 6) AS "return", round(sentiment_mean, 6) AS sentiment_mean
      FROM ({returns(EVENT_BARS)}) JOIN ({SENTIMENT}) USING (symbol, Date)
      WHERE log_return IS NOT NULL""",
    "prediction_overlay": f"""
      WITH {SCALED_CTES}
      SELECT p.symbol, p.Date, actual_target, predicted_target,
             round(probability_up, 6) AS probability_up, Close
      FROM ({PREDICTED}) p LEFT JOIN ({LINE_BARS}) b ON b.symbol = p.symbol AND b.Date = p.Date
      WHERE split = 'test'""",
    "pre_event_window": f"""
      SELECT s.symbol, s.Date, event_id, round(sentiment_mean, 6) AS sentiment_mean
      FROM ({SENTIMENT}) s JOIN ({EVENTS}) e ON s.symbol = e.symbol
       AND s.Date >= e.event_date - INTERVAL 10 HOUR AND s.Date < e.event_date""",
    "outside_event_window": f"""
      SELECT symbol, Date, round(sentiment_mean, 6) AS sentiment_mean FROM ({SENTIMENT}) s
      WHERE NOT EXISTS (SELECT 1 FROM ({EVENTS}) e WHERE s.symbol = e.symbol
            AND s.Date >= e.event_date - INTERVAL 10 HOUR AND s.Date < e.event_date)""",
    "trajectory_before": trajectory("sentiment_mean", "", """
      usable AS (SELECT *, count(*) OVER (PARTITION BY event_id) AS n FROM sized
                 WHERE rows_in > 5 AND x IS NOT NULL QUALIFY n > 5),
      ranked AS (SELECT *, -row_number() OVER (PARTITION BY event_id ORDER BY o DESC) AS day FROM usable),
      kept AS (SELECT * FROM ranked WHERE -day <= (SELECT min(n) FROM usable))"""),
    "trajectory_around": trajectory("sentiment_momentum", FIRST_ROWS, """
      usable AS (SELECT *, count(*) OVER (PARTITION BY event_id) AS n FROM sized
                 WHERE rows_in >= 10 AND x IS NOT NULL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY o) - 1 AS i FROM usable),
      kept AS (SELECT *, i + floor(-(SELECT min(n) FROM usable) / 2) AS day FROM ranked
               WHERE i < (SELECT min(n) FROM usable))"""),
    "event_study": f"""
      WITH a AS MATERIALIZED (SELECT symbol, Date, log_return, sentiment_anomaly,
                                     row_number() OVER ({W}) AS rn FROM ({ANOMALY})),
      path AS (SELECT e.symbol, e.rn AS event_rn, p.rn - e.rn AS "offset", p.log_return
               FROM a e JOIN a p ON p.symbol = e.symbol AND p.rn BETWEEN e.rn - 20 AND e.rn + 20
               WHERE e.sentiment_anomaly < -0.1
               QUALIFY count(p.log_return) OVER (PARTITION BY e.symbol, e.rn) = 41)
      SELECT symbol, CAST("offset" AS INTEGER) AS "offset", round(avg(c), 6) AS mean_path,
             count(*) AS events
      FROM (SELECT *, sum(log_return) OVER (PARTITION BY symbol, event_rn ORDER BY "offset") AS c
            FROM path) GROUP BY 1, 2""",
    "top_crashes": f"""
      SELECT symbol, Date, round(q.log_return, 6) AS log_return FROM ({returns(LINE_BARS)}) q
      WHERE Date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}' AND q.log_return IS NOT NULL
      ORDER BY q.log_return, Date, symbol LIMIT 10""",
    "top_crashes_per_symbol": f"""
      SELECT symbol, Date, round(q.log_return, 6) AS log_return,
             CAST(row_number() OVER (PARTITION BY symbol ORDER BY q.log_return, Date) AS INTEGER) AS rank
      FROM ({returns(LINE_BARS)}) q WHERE q.log_return IS NOT NULL QUALIFY rank <= 5""",
    "crash_zoom": f"""
      WITH r AS MATERIALIZED ({returns(LINE_BARS)}),
      worst AS (SELECT symbol, Date FROM r WHERE log_return IS NOT NULL
                QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY log_return, Date) <= 3),
      span AS (SELECT symbol, min(Date) - 120 AS a, max(Date) + 120 AS b FROM worst GROUP BY 1)
      SELECT symbol, Date, Close, round(log_return, 6) AS log_return
      FROM r JOIN span USING (symbol) WHERE Date BETWEEN a AND b""",
    "feature_correlation": f"""
      WITH f AS MATERIALIZED ({FEATURE_ROWS})
      {pair_correlations("f", [(a, b) for a in FEATURES for b in FEATURES], ["feature_a", "feature_b"])}""",
    "target_correlation": f"""
      WITH RECURSIVE {wide_ctes(LINE_BARS)},
      f AS MATERIALIZED ({labelled("SELECT * FROM wide", BASELINE_FEATURES)})
      {pair_correlations("f", [(a,) for a in BASELINE_FEATURES], ["feature"])}""",
    "cross_correlation": f"""
      WITH p AS MATERIALIZED (
        SELECT symbol, log_return AS y, sentiment_mean AS x, row_number() OVER ({W}) AS rn
        FROM ({returns(EVENT_BARS)}) JOIN ({SENTIMENT}) USING (symbol, Date)
        WHERE log_return IS NOT NULL)
      SELECT a.symbol, CAST(k AS INTEGER) AS lag, round(corr(b.x, a.y), 6) AS correlation
      FROM p a, range(-20, 21) AS lags(k) JOIN p b ON b.symbol = a.symbol AND b.rn = a.rn - k
      GROUP BY 1, 2""",
    "confusion_matrix": f"""
      WITH s AS ({SCORED})
      SELECT model, actual, predicted,
             count(*) FILTER (actual_target = actual AND predicted_target = predicted) AS rows
      FROM s, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS c(actual, predicted) GROUP BY 1, 2, 3""",
    "classification_metrics": f"""
      SELECT model, {r6("accuracy", "precision", "recall", "f1_score")} FROM ({rates(SCORED, "model")})""",
    "roc_auc": f"SELECT model, round(roc_auc, 6) AS roc_auc FROM ({auc(SCORED, 'model')})",
    "roc_curve": f"""
      WITH s AS MATERIALIZED ({SCORED}),
      t AS (SELECT DISTINCT model, probability_up AS threshold FROM s
            UNION ALL SELECT DISTINCT model, NULL FROM s)
      SELECT t.model, t.threshold,
             round(count(*) FILTER (actual_target = 0 AND probability_up >= threshold)
                   / count(*) FILTER (actual_target = 0), 6) AS fpr,
             round(count(*) FILTER (actual_target = 1 AND probability_up >= threshold)
                   / count(*) FILTER (actual_target = 1), 6) AS tpr
      FROM t JOIN s ON s.model = t.model GROUP BY 1, 2""",
    "probability_histogram": f"""
      SELECT model, actual_target,
             CAST(least(floor(probability_up * 20 / 1.0::DOUBLE) + 1, 20) AS INTEGER) AS bin,
             count(*) AS rows
      FROM ({SCORED}) GROUP BY 1, 2, 3""",
    "sentiment_histogram": f"""
      WITH n AS MATERIALIZED ({NEWS}),
      span AS (SELECT min(sentiment_score) AS lo, max(sentiment_score) AS hi FROM n)
      SELECT symbol, CAST(least(floor((sentiment_score - lo) * 50 / (hi - lo)), 49) + 1 AS INTEGER)
               AS bin, count(*) AS rows
      FROM n, span GROUP BY 1, 2""",
    "target_distribution": f"""
      WITH f AS ({FEATURE_ROWS})
      SELECT symbol, v AS {TARGET}, count(*) FILTER ({TARGET} = v) AS rows,
             round(count(*) FILTER ({TARGET} = v) / count(*), 6) AS share
      FROM f, (VALUES (0), (1)) AS d(v) GROUP BY 1, 2""",
    "label_distribution": f"""
      WITH f AS (SELECT symbol, {LABEL} AS label
                 FROM (SELECT *, {FORWARD} FROM ({returns(LINE_BARS)}))
                 WHERE future_return_5d IS NOT NULL)
      SELECT symbol, v AS target, count(*) FILTER (label = v) AS rows,
             round(count(*) FILTER (label = v) / count(*), 6) AS share
      FROM f, (VALUES ('bearish'), ('neutral'), ('bullish')) AS d(v) GROUP BY 1, 2""",
    "model_comparison": f"""
      SELECT model, {r6(*METRICS)},
             CAST(rank() OVER (ORDER BY q.roc_auc DESC) AS INTEGER) AS rank
      FROM ({evaluation(SCORED, "model")}) q""",
    "raw_quality": f"WITH rows_in AS MATERIALIZED ({LINE_ROWS}) {quality_rows()}",
    "raw_contract": f"WITH rows_in AS MATERIALIZED ({LINE_BARS}) {contract(raw_rules())}",
    "raw_contract_lines": f"WITH rows_in AS MATERIALIZED ({LINE_ROWS}) {contract(raw_rules())}",
    "feature_contract": f"WITH rows_in AS MATERIALIZED ({FEATURE_ROWS}) {contract(feature_rules())}",
    "contract_report": f"""
      WITH rows_in AS MATERIALIZED ({LINE_ROWS}), results AS ({contract(raw_rules())})
      SELECT 'raw_market_data_contract' AS validation_name, bool_and(success) AS success,
             count(*) AS total_expectations,
             count(*) FILTER (success) AS successful_expectations,
             count(*) FILTER (NOT success) AS failed_expectations,
             coalesce(string_agg(expectation_type, ',' ORDER BY position) FILTER (NOT success), '')
               AS failed_expectation_types,
             coalesce(string_agg(coalesce("column", '-'), ',' ORDER BY position)
                      FILTER (NOT success), '') AS failed_columns,
             'order_lines' AS dataset_name
      FROM results""",
    "contract_violations": f"""
      WITH rows_in AS MATERIALIZED ({LINE_ROWS})
      SELECT symbol, rule, count(*) AS rows FROM ({" UNION ALL ".join(
          f"SELECT symbol, '{rule}' AS rule FROM rows_in WHERE {condition}"
          for rule, condition in (
              [(f"{PAIR_RULE}({a},{b})", f"{a} < {b}") for a, b in PAIRS]
              + [(f"{EXPECT}be_between({c})", f'"{c}" <= 0') for c in PRICE_COLUMNS]
              + [(f"{EXPECT}be_between(Volume)", "Volume < 0")]))})
      GROUP BY 1, 2""",
    "feature_admission": f"""
      WITH rows_in AS MATERIALIZED ({FEATURE_ROWS})
      SELECT 0 AS position, 'not_empty' AS check_name, count(*) > 0 AS passed, count(*) AS found
      FROM rows_in
      UNION ALL SELECT 1, 'date_present', count(*) = 0, count(*) FROM rows_in WHERE Date IS NULL
      UNION ALL SELECT 2, 'date_unique', c = 0, CAST(c AS BIGINT)
      FROM (SELECT {repeated(ROWS_IN)} AS c)
      UNION ALL SELECT 3, 'target_not_a_feature', true, 0
      UNION ALL SELECT 4, 'target_domain', count(*) = 0, count(*) FROM rows_in
      WHERE {TARGET} NOT IN (0, 1)""",
    "duplicate_keys": f"""
      SELECT symbol, Date, count(*) AS rows FROM ({LINE_ROWS}) GROUP BY 1, 2 HAVING count(*) > 1""",
    "chrono_split": f"SELECT symbol, Date, split FROM ({SPLIT})",
    "drift_split": f"SELECT symbol, Date, period FROM ({PERIOD})",
    "split_series": f"SELECT symbol, Date, Close, split FROM ({SPLIT})",
    "split_summary": f"""
      SELECT symbol, split, count(*) AS rows, min(Date) AS first_date, max(Date) AS last_date
      FROM ({SPLIT}) GROUP BY 1, 2""",
    "drift_wasserstein": f"""
      WITH {drift_ctes()}
      SELECT feature, drift_score > 0.1 AS drift_detected, round(drift.drift_score, 6) AS drift_score,
             'Wasserstein distance (normed)' AS method, 0.1::DOUBLE AS threshold FROM drift""",
    "drift_ks": f"""
      WITH {drift_ctes()},
      n AS (SELECT feature, count(*) FILTER (period = 'reference')::DOUBLE AS n,
                   count(*) FILTER (period = 'current')::DOUBLE AS m FROM long GROUP BY 1),
      d AS (SELECT feature, max(gap) AS statistic FROM gap GROUP BY 1),
      t AS (SELECT feature, statistic, sqrt(n * m / (n + m)) * statistic AS t FROM d JOIN n USING (feature))
      SELECT feature, round(any_value(statistic), 6) AS statistic,
             round(CASE WHEN any_value(t) < 0.2 THEN 1 ELSE least(greatest(
               sum(CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0 * k * k * t * t)), 0), 1) END, 6)
               AS p_value
      FROM t, range(1, 101) AS terms(k) GROUP BY 1""",
    "drift_summary": f"""
      WITH {drift_ctes()}
      SELECT (SELECT count(*) FILTER (period = 'reference') FROM ({PERIOD})) AS reference_rows,
             (SELECT count(*) FILTER (period = 'current') FROM ({PERIOD})) AS current_rows,
             string_agg(feature, ',' ORDER BY feature) AS features, count(*) AS number_of_features,
             count(*) FILTER (drift_score > 0.1) / count(*) >= 0.5 AS dataset_drift,
             count(*) FILTER (drift_score > 0.1) AS drifted_columns_count,
             round(count(*) FILTER (drift_score > 0.1) / count(*), 6) AS drifted_columns_share
      FROM drift""",
    "standardize": f"""
      WITH {SCALED_CTES} SELECT symbol, Date, {r6(*FEATURES)}, {TARGET}, split FROM scaled""",
    "score_fixed_coeff": f"""
      WITH {SCALED_CTES}
      SELECT symbol, Date, actual_target, predicted_target, round(probability_up, 6) AS probability_up
      FROM ({PREDICTED}) q WHERE split = 'test'""",
    "evaluate_model": f"""
      WITH {SCALED_CTES}, p AS MATERIALIZED (SELECT * FROM ({PREDICTED}) WHERE split <> 'train')
      SELECT split, {r6(*METRICS)} FROM ({evaluation("SELECT * FROM p", "split")})""",
    "batch_scoring": f"""
      WITH {SCALED_CTES}
      SELECT symbol, Date, CASE WHEN ok THEN predicted_target END AS prediction,
             CASE WHEN ok AND predicted_target = 1 THEN 'up' WHEN ok THEN 'down' END AS prediction_label,
             round(CASE WHEN ok THEN 1 - p.probability_up END, 6) AS probability_down,
             round(CASE WHEN ok THEN p.probability_up END, 6) AS probability_up,
             'fixed_logistic' AS model_name,
             CASE WHEN NOT ok THEN 'volume_change is missing' END AS reject_reason
      FROM ({PREDICTED}) p
      JOIN (SELECT symbol, Date, abs(volume_change) <= 3 AS ok FROM scaled) USING (symbol, Date)
      WHERE split = 'test'""",
    "shap_values": f"WITH {SHAP_CTES} SELECT symbol, Date, {r6(*FEATURES)} FROM explained",
    "shap_importance": f"""
      WITH {SHAP_CTES} SELECT feature, round(mean_abs_shap_value, 6) AS mean_abs_shap_value,
             CAST(rank AS INTEGER) AS rank FROM importance""",
    "shap_summary": f"""
      WITH {SHAP_CTES}
      SELECT 'fixed_logistic' AS model_name, '1' AS model_version, 'linear' AS explainer_type,
             'validation' AS explained_dataset, (SELECT count(*) FROM explained) AS n_observations,
             {len(FEATURES)} AS n_features, 1 AS positive_class,
             string_agg(feature, ',' ORDER BY rank) FILTER (rank <= 5) AS top_features
      FROM importance""",
    "run_log": f"""
      WITH s AS MATERIALIZED (SELECT * FROM ({SCORED}) WHERE model = 'champion')
      SELECT 'run-1' AS run_id, 'baseline_test' AS stage, 'metric' AS kind,
             'baseline_test.rows' AS "key", CAST(count(*) AS VARCHAR) AS value FROM s
      UNION ALL
      SELECT 'run-1', 'baseline_test', 'metric', 'baseline_test.correct',
             CAST(count(*) FILTER (actual_target = predicted_target) AS VARCHAR) FROM s""",
    "predictions_in_range": f"""
      WITH {SCALED_CTES}
      SELECT symbol, Date, actual_target, predicted_target, round(probability_up, 6) AS probability_up
      FROM ({PREDICTED}) q
      WHERE split = 'test' AND Date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'""",
}


_FINE = "l_extendedprice * (1 - l_discount) / 7 * CASE WHEN l_linenumber % 3 = 0 THEN -1.0::DOUBLE ELSE 1 END"
_FINE_TRADE = "row(l_orderkey * 10 + l_linenumber, price)"
_GAPPY = f"""
      SELECT * REPLACE (CASE WHEN dayofyear(Date) % 11 IN (0, 3, 4) OR Date < DATE '1992-02-01'
                             THEN NULL ELSE Close END AS Close) FROM ({LINE_BARS})"""


def _recursive_average(x: str, e: str, w: str, span: int) -> tuple[str, str]:
    """Next value and next weight of an average whose old weight fades while x is missing."""
    a = f"(2.0::DOUBLE / {span + 1})"
    value = f"""CASE WHEN {x} IS NULL THEN {e} WHEN {e} IS NULL THEN {x}
                     ELSE ({w} * (1 - {a}) * {e} + {a} * {x}) / ({w} * (1 - {a}) + {a}) END"""
    weight = f"CASE WHEN {x} IS NULL THEN {w} * (1 - {a}) ELSE 1::DOUBLE END"
    return value, weight


_SPARSE = f"""SELECT * REPLACE (CASE WHEN dayofyear(Date) % 10 = 7 THEN Close END AS Close) FROM ({LINE_BARS})"""


def _gappy_averages(source: str = _GAPPY) -> str:
    """Averages of closes, some missing, by recursion, row by row; needs WITH RECURSIVE."""
    spans = (10, 20, 12, 26)
    steps = {n: _recursive_average("n.Close", f"e.e{n}", f"e.w{n}", n) for n in spans}
    first = ", ".join(f"Close AS e{n}, 1::DOUBLE AS w{n}" for n in spans)
    after = ", ".join(f"{steps[n][0]}, {steps[n][1]}" for n in spans)
    a = "(2.0::DOUBLE / 10)"
    line = f"(({steps[12][0]}) - ({steps[26][0]}))"
    return f"""
      numbered AS MATERIALIZED (SELECT *, row_number() OVER ({W}) AS rn FROM ({source})),
      smooth AS (
        SELECT symbol, Date, rn, {first}, Close - Close AS signal FROM numbered WHERE rn = 1
        UNION ALL
        SELECT n.symbol, n.Date, n.rn, {after},
               CASE WHEN e.signal IS NULL THEN {line} ELSE {a} * {line} + (1 - {a}) * e.signal END
        FROM smooth e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1)"""


_NEWEST_FIRST = f"""SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM rows_in GROUP BY symbol)"""
_ODD = ", ".join(f"({i}, TIMESTAMP '{t}')" for i, t in enumerate(ODD_EVENTS))
_ODD_EVENTS = f"SELECT event_id, 'ALL' AS symbol, event_date FROM (VALUES {_ODD}) AS e(event_id, event_date)"
_TRAINED = [*FEATURES, "intercept"]

ORACLES |= {
    "scan_bars_fine": f"""
      SELECT symbol, Date, arg_min(price, {_FINE_TRADE}) AS Open, max(price) AS High, min(price) AS Low,
             arg_max(price, {_FINE_TRADE}) AS Close, arg_max(price, {_FINE_TRADE}) AS "Adj Close",
             CAST(sum(l_quantity) AS BIGINT) AS Volume
      FROM (SELECT *, l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS Date, {_FINE} AS price FROM lineitem)
      GROUP BY 1, 2""",
    "f_ema_gaps": f"""
      WITH RECURSIVE {_gappy_averages()}
      SELECT symbol, Date, Close, round(e10, 6) AS ema_10, round(e20, 6) AS ema_20
      FROM smooth JOIN numbered USING (symbol, Date, rn)""",
    "f_macd_gaps": f"""
      WITH RECURSIVE {_gappy_averages()}
      SELECT symbol, Date, Close, round(e12 - e26, 6) AS macd, round(signal, 6) AS macd_signal
      FROM smooth JOIN numbered USING (symbol, Date, rn)""",
    "f_ema_sparse": f"""
      WITH RECURSIVE {_gappy_averages(_SPARSE)}
      SELECT symbol, Date, Close, round(e10, 6) AS ema_10, round(e20, 6) AS ema_20
      FROM smooth JOIN numbered USING (symbol, Date, rn)""",
    "f_macd_sparse": f"""
      WITH RECURSIVE {_gappy_averages(_SPARSE)}
      SELECT symbol, Date, Close, round(e12 - e26, 6) AS macd, round(signal, 6) AS macd_signal
      FROM smooth JOIN numbered USING (symbol, Date, rn)""",
    "feature_contract_newest_first": f"""WITH rows_in AS MATERIALIZED ({FEATURE_ROWS}) {contract(
        [(t, c, _NEWEST_FIRST if t.endswith("be_increasing") else q) for t, c, q in feature_rules()])}""",
    "contract_report_unjudged": f"""
      WITH rows_in AS MATERIALIZED ({FEATURE_ROWS}), results AS ({contract(feature_rules())})
      SELECT 'feature_dataset_contract' AS validation_name, false AS success,
             count(*) AS total_expectations,
             count(*) FILTER (success AND expectation_type NOT LIKE '%be_increasing') AS successful_expectations,
             count(*) FILTER (NOT success AND expectation_type NOT LIKE '%be_increasing') AS failed_expectations,
             count(*) FILTER (expectation_type LIKE '%be_increasing') AS unevaluated_expectations
      FROM results""",
    "pre_event_window_any_time": f"""
      SELECT s.symbol, s.Date, event_id, round(sentiment_mean, 6) AS sentiment_mean
      FROM ({SENTIMENT}) s JOIN ({_ODD_EVENTS}) e ON s.symbol = e.symbol
       AND s.Date >= e.event_date - INTERVAL 10 HOUR AND s.Date < e.event_date""",
    "outside_event_window_any_time": f"""
      SELECT symbol, Date, round(sentiment_mean, 6) AS sentiment_mean FROM ({SENTIMENT}) s
      WHERE NOT EXISTS (SELECT 1 FROM ({_ODD_EVENTS}) e WHERE s.symbol = e.symbol
            AND s.Date >= e.event_date - INTERVAL 10 HOUR AND s.Date < e.event_date)""",
    "tick_positions_at_events": f"""
      SELECT 'view' AS symbol, event_id,
             (SELECT count(*) FROM events t WHERE t.event_type = 'view' AND t.ts < e.event_date) AS rows_before
      FROM ({_ODD_EVENTS}) e""",
    "drift_ks_verdict": f"""
      WITH scores AS ({ORACLES["drift_ks"]})
      SELECT feature, p_value < 0.05 AS drift_detected, p_value AS drift_score,
             'K-S p_value' AS method, CAST(0.05 AS DOUBLE) AS threshold FROM scores""",
    "train_lr_facts": f"""
      SELECT feature, true AS stationary,
             (SELECT count(*) FROM ({SPLIT}) WHERE split = 'train') AS train_rows
      FROM (VALUES {", ".join(f"('{f}')" for f in _TRAINED)}) AS f(feature)""",
    "train_rf_facts": f"""
      SELECT split, count(*) AS rows, CAST(300 AS INTEGER) AS trees, true AS depth_in_bounds,
             true AS probabilities_in_range, true AS predictions_follow
      FROM ({SPLIT}) GROUP BY 1""",
}

_GATE_RULES = (
    [(f"{PAIR_RULE}({a},{b})", f"{a} < {b}") for a, b in PAIRS]
    + [(f"{EXPECT}be_between({c})", f'"{c}" <= 0') for c in PRICE_COLUMNS]
    + [(f"{EXPECT}be_between(Volume)", "Volume < 0")]
)

ORACLES |= {
    "stream_event_bars": ORACLES["scan_event_bars"],
    "stream_market_features": f"SELECT symbol, Date, {r6(*FEATURES)}, {TARGET} FROM ({FEATURE_ROWS})",
    "stream_contract_gate": f"""
      WITH rows_in AS MATERIALIZED ({LINE_ROWS})
      SELECT symbol, 'quarantine' AS side, rule, count(*) AS rows FROM ({" UNION ALL ".join(
          f"SELECT symbol, '{rule}' AS rule FROM rows_in WHERE {condition}" for rule, condition in _GATE_RULES)})
      GROUP BY ALL
      UNION ALL
      SELECT symbol, 'accepted', NULL, count(*) FROM rows_in
      WHERE NOT ({" OR ".join(condition for _, condition in _GATE_RULES)}) GROUP BY ALL""",
}

_WINDOWS = f"""
      SELECT s.symbol, event_id AS interval_id, ts - INTERVAL {WINDOW_MINUTES} MINUTE AS t0, ts AS t1
      FROM events, (VALUES ('view'), ('error'), ('click')) AS s(symbol) WHERE event_type = 'purchase'"""
_TICK_ROWS = "SELECT event_type AS symbol, ts AS Date, event_id FROM events"
_COVERED = f"""
      SELECT r.symbol, Date, event_id, interval_id FROM ({_TICK_ROWS}) r LEFT JOIN ({_WINDOWS}) w
      ON r.symbol = w.symbol AND Date >= t0 AND Date < t1"""

ORACLES |= {
    "tick_rows_inside": f"SELECT * FROM ({_COVERED}) WHERE interval_id IS NOT NULL",
    "tick_rows_outside": f"SELECT symbol, Date, event_id FROM ({_COVERED}) WHERE interval_id IS NULL",
    "tick_open_intervals": f"""
      SELECT symbol, Date, event_id, count(interval_id) AS open_intervals FROM ({_COVERED}) GROUP BY ALL""",
    "wide_correlation": f"""
      WITH RECURSIVE {wide_ctes(LINE_BARS)},
      cells AS MATERIALIZED ({" UNION ALL ".join(
          f"SELECT symbol, Date, '{c}' AS f, {c} AS v FROM wide WHERE (dayofyear(Date) + {i}) % 7 <> 0"
          for i, c in enumerate(WIDE_FEATURES))})
      SELECT a.f AS feature_a, b.f AS feature_b,
             round(covar_pop(a.v, b.v) / nullif(sqrt(var_pop(a.v) * var_pop(b.v)), 0), 6) AS correlation
      FROM cells a JOIN cells b USING (symbol, Date) GROUP BY 1, 2""",
    "feature_contract_while_writing": ORACLES["feature_contract"],
    "raw_contract_while_writing": ORACLES["raw_contract_lines"],
    "prediction_overlay_written": ORACLES["prediction_overlay"],
    "roc_corners": f"""
      WITH curve AS ({ORACLES["roc_curve"]}),
      steps AS (
        SELECT *, fpr - lag(fpr) OVER w AS f0, lead(fpr) OVER w - fpr AS f1, tpr - lag(tpr) OVER w AS t0,
               lead(tpr) OVER w - tpr AS t1, lag(threshold) OVER w IS NULL AS first
        FROM curve WINDOW w AS (PARTITION BY model ORDER BY threshold DESC NULLS FIRST))
      SELECT model, threshold, fpr, tpr FROM steps
      WHERE first OR f1 IS NULL OR abs(f0 - f1) > 3e-6 OR abs(t0 - t1) > 3e-6""",
}


NEWTON_STEPS = 9


def solved(system: str, n: int) -> str:
    """The last column of ``system`` (n rows of n + 1 numbers in column m) after elimination."""
    for k in range(1, n + 1):
        system = f"""
          SELECT list_transform(range(1, {n + 1}), lambda i: CASE WHEN i = {k}
                   THEN list_transform(m[{k}], lambda x: x / m[{k}][{k}])
                   ELSE list_transform(range(1, {n + 2}), lambda j: m[i][j] - m[i][{k}] * m[{k}][j] / m[{k}][{k}])
                 END) AS m
          FROM ({system})"""
    return f"SELECT list_transform(m, lambda r: r[{n + 1}]) AS step FROM ({system})"


def newton_ctes() -> str:
    """CTE ``w<NEWTON_STEPS>``: weights of the penalised logistic fit, intercept last."""
    n = len(_TRAINED)
    ctes = [
        f"{SCALED_CTES}",
        f"""fit_rows AS MATERIALIZED (
        SELECT [{", ".join(FEATURES)}, 1.0]::DOUBLE[] AS z, {TARGET}::DOUBLE AS y
        FROM scaled WHERE split = 'train')""",
        f"w0 AS (SELECT [{', '.join(['0.0'] * n)}]::DOUBLE[] AS w)",
    ]
    for step in range(NEWTON_STEPS):
        rows = []
        for i in range(1, n + 1):
            cells = [
                f"sum(p * (1 - p) * z[{i}] * z[{j}])" + (" + 1" if i == j < n else "") for j in range(1, n + 1)
            ]
            penalty = f" - any_value(w[{i}])" if i < n else ""
            rows.append(f"[{', '.join(cells)}, sum((y - p) * z[{i}]){penalty}]")
        ctes.append(f"""
      p{step} AS MATERIALIZED (
        SELECT z, y, w, 1 / (1 + exp(-list_dot_product(z, w))) AS p FROM fit_rows, w{step}),
      m{step} AS MATERIALIZED (SELECT [{", ".join(rows)}] AS m FROM p{step}),
      w{step + 1} AS MATERIALIZED (
        SELECT list_transform(range(1, {n + 1}), lambda i: w[i] + step[i]) AS w
        FROM w{step}, ({solved(f"SELECT m FROM m{step}", n)}))""")
    return ", ".join(ctes)


_SUPPLIERS = f"""
      SELECT CASE WHEN s_nationkey < {REFERENCE_NATIONS} THEN 'r' ELSE 'c' END AS period, feature, value
      FROM (UNPIVOT (SELECT s_nationkey, s_acctbal::DOUBLE AS s_acctbal, s_suppkey::DOUBLE AS s_suppkey FROM supplier)
            ON s_acctbal, s_suppkey INTO NAME feature VALUE value)"""

ORACLES |= {
    "train_lr": f"""
      WITH {newton_ctes()}
      SELECT names[i] AS feature, round(w[i], 6) AS coefficient,
             (SELECT count(*) FROM scaled WHERE split = 'test') AS test_rows,
             (SELECT round(avg(1 / (1 + exp(-list_dot_product([{", ".join(FEATURES)}, 1.0]::DOUBLE[], w)))), 6)
              FROM scaled WHERE split = 'test') AS mean_probability
      FROM w{NEWTON_STEPS}, (SELECT [{", ".join(f"'{f}'" for f in _TRAINED)}] AS names), range(1, {len(_TRAINED) + 1}) AS r(i)""",
    "train_rf_bounds": f"SELECT DISTINCT split, true AS accurate, true AS separates FROM ({SPLIT})",
    "strict_text_bars": ORACLES["clean_bars"],
    "stored_predictions": ORACLES["score_fixed_coeff"],
    "stored_contract_report": ORACLES["contract_report"],
    "first_duplicate_dates": f"{ORACLES['duplicate_keys']} ORDER BY symbol, Date LIMIT 5",
    "bars_head_tail": f"""
      SELECT 'head' AS edge, symbol, Date, {PRICES} FROM (FROM ({LINE_BARS}) ORDER BY Date, symbol LIMIT 5)
      UNION ALL
      SELECT 'tail' AS edge, symbol, Date, {PRICES} FROM (FROM ({LINE_BARS}) ORDER BY Date DESC, symbol DESC LIMIT 5)""",
    "first_predictions": f"{ORACLES['score_fixed_coeff']} ORDER BY Date, symbol LIMIT 20",
    # A path of n steps right and m up for every order of the pooled rows, diagonal by diagonal.
    "drift_ks_suppliers": f"""
      WITH RECURSIVE long AS MATERIALIZED ({_SUPPLIERS}),
      sizes AS (SELECT feature, count(*) FILTER (period = 'r') AS n, count(*) FILTER (period = 'c') AS m
                FROM long GROUP BY 1),
      gaps AS (
        SELECT feature, n, m, max(abs(a * m - b * n)) AS d
        FROM (SELECT feature, value, count(*) FILTER (period = 'r') OVER v AS a,
                     count(*) FILTER (period = 'c') OVER v AS b
              FROM long WINDOW v AS (PARTITION BY feature ORDER BY value)) JOIN sizes USING (feature)
        GROUP BY ALL),
      walk AS (
        SELECT feature, n, m, d, 0 AS s, list_transform(range(0, n + 1), lambda i: (d <= 0)::INT::DOUBLE) AS share
        FROM gaps WHERE n * m <= {EXACT_CELLS}
        UNION ALL
        SELECT feature, n, m, d, s + 1,
               list_transform(range(0, n + 1), lambda i: CASE
                 WHEN i > s + 1 OR s + 1 - i > m THEN 0.0::DOUBLE
                 WHEN abs(i * m - (s + 1 - i) * n) >= d THEN 1.0::DOUBLE
                 ELSE ((CASE WHEN i > 0 THEN share[i] ELSE 0 END) * i + share[i + 1] * (s + 1 - i)) / (s + 1) END)
        FROM walk WHERE s < n + m),
      few AS (SELECT feature, share[n + 1] AS p_value FROM walk WHERE s = n + m),
      many AS (
        SELECT feature, CASE WHEN any_value(t) < 0.2 THEN 1 ELSE least(greatest(
                 sum(CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0 * k * k * t * t)), 0), 1) END AS p_value
        FROM (SELECT feature, d / sqrt(n::DOUBLE * m * (n + m)) AS t FROM gaps WHERE n * m > {EXACT_CELLS}),
             range(1, 101) AS terms(k) GROUP BY 1)
      SELECT feature, round(d / (n * m), 6) AS statistic, round(p_value, 6) AS p_value
      FROM gaps JOIN (SELECT * FROM few UNION ALL SELECT * FROM many) USING (feature)""",
}
