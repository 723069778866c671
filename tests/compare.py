"""Compare a query with its reference SQL, ignoring row order."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# Engines may round a value halfway between two 6-digit numbers either way.
TOLERANCE = 1.5e-6


def _split(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Key columns as text and floating columns as numbers, in a common row order."""
    texts, numbers = {}, {}
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_float_dtype(column) and not _whole(column):
            numbers[name] = column.astype(float)
        else:
            texts[name] = [None if pd.isna(v) else _text(v) for v in column]
    text = pd.DataFrame(texts, index=frame.index, dtype=object).fillna("<null>")
    number = pd.DataFrame(numbers, index=frame.index)
    order = pd.concat([text, number.round(4)], axis=1)
    rows = order.sort_values(list(order.columns)).index
    return text.loc[rows].reset_index(drop=True), number.loc[rows].reset_index(drop=True)


def _whole(column: pd.Series) -> bool:
    present = column.dropna()
    return bool((present == present.round()).all())


def _text(value) -> str:
    if hasattr(value, "isoformat"):
        return str(pd.Timestamp(value))
    if isinstance(value, (int, float, np.number)) and not isinstance(value, (bool, np.bool_)):
        return f"{float(value) + 0.0:.6f}"
    return str(value)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """Empty if equal, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    (text_a, number_a), (text_b, number_b) = _split(spark_frame), _split(sql_frame)
    if list(number_a.columns) != list(number_b.columns):
        return f"number columns {list(number_a.columns)} != {list(number_b.columns)}"
    unequal = (text_a != text_b).any(axis=1)
    close = np.isclose(number_a, number_b, rtol=0, atol=TOLERANCE, equal_nan=True)
    unequal |= ~pd.Series(close.all(axis=1), index=unequal.index)
    if unequal.any():
        i = int(unequal.idxmax())
        a, b = (pd.concat([t, n], axis=1).loc[i].to_dict() for t, n in
                ((text_a, number_a), (text_b, number_b)))
        return f"{int(unequal.sum())} of {len(unequal)} rows, e.g.\n{a}\n{b}"
    return ""
