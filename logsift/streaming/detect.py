"""Anomalies of a metric stream, with a running baseline per key as keyed state.

The state of a key is its moments: number of rows, mean, sum of squared
deviations, first and last time. Every row is judged by the baseline before it
and then added to it, and it comes out with the baseline that holds after it. So
the last row of each key carries the moments of all its rows: replaying the
stored rows against them gives the batch detector's flags.

The rows of a key in one micro-batch are taken in time order (then by the other
columns). A key that is silent for ``timeout`` of processing time is dropped and
starts anew; without a time-out its state is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql import Window

STATE = T.StructType([T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()),
                      T.StructField("first_seen", T.TimestampType()), T.StructField("last_seen", T.TimestampType())])
JUDGED = (T.StructField("timestamp", T.TimestampType()), T.StructField("request_count", T.LongType()), T.StructField("z_score", T.DoubleType()),
          T.StructField("anomaly", T.IntegerType()))


def running(values: np.ndarray, n: int, mean: float, m2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, mean, m2) after each value, from a state before the first (Welford's steps)."""
    out = np.empty((3, len(values)))
    for k, x in enumerate(values):
        n += 1
        apart = x - mean
        mean += apart / n
        m2 += apart * (x - mean)
        out[:, k] = n, mean, m2
    return out[0].astype(np.int64), out[1], out[2]


def stream_z_score(metrics: DataFrame, keys: tuple[str, ...] = ("ip_address", "endpoint"), threshold: float = 3.0,
                   least: int = 2, timeout: str | None = None) -> DataFrame:
    """Metric rows (timestamp, keys..., request_count) -> keys..., timestamp, request_count,
    z_score and anomaly against the baseline of the rows before, and the key's
    moments after the row (n, mean, m2, first_seen, last_seen).

    A key is judged from ``least`` earlier rows on. Rows without a timestamp or a
    count are left out. Write it with output mode 'append'."""
    key_fields = [T.StructField(k, metrics.schema[k].dataType) for k in keys]
    schema = T.StructType([*key_fields, *JUDGED, *STATE.fields])
    names = schema.fieldNames()
    duration = None if timeout is None else _milliseconds(timeout)

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(["timestamp", "request_count"], kind="stable")
        n, mean, m2, first, last = state.get if state.exists else (0, 0.0, 0.0, None, None)
        value = rows["request_count"].to_numpy(np.float64)
        times = rows["timestamp"]
        after = running(value, n, mean, m2)
        before = [np.concatenate([[x], a[:-1]]) for x, a in zip((n, mean, m2), after)]
        with np.errstate(divide="ignore", invalid="ignore"):
            std = np.sqrt(before[2] / (before[0] - 1))
            z = np.where((before[0] >= max(least, 2)) & (std > 1e-9 * np.abs(before[1])), (value - before[1]) / std, np.nan)
        lows = times.cummin() if first is None else times.cummin().clip(upper=pd.Timestamp(first))
        highs = times.cummax() if last is None else times.cummax().clip(lower=pd.Timestamp(last))
        state.update((int(after[0][-1]), float(after[1][-1]), float(after[2][-1]), lows.iloc[-1].to_pydatetime(), highs.iloc[-1].to_pydatetime()))
        if duration is not None:
            state.setTimeoutDuration(duration)
        columns = [*([k] * len(rows) for k in key), times.to_list(), rows["request_count"].to_list(),
                   z, (np.abs(np.nan_to_num(z)) > threshold).astype(int).tolist(),
                   after[0].tolist(), after[1].tolist(), after[2].tolist(), lows.to_list(), highs.to_list()]
        yield pd.DataFrame(dict(zip(names, columns)))

    rows = metrics.filter("timestamp IS NOT NULL AND request_count IS NOT NULL").select(
        *keys, "timestamp", F.col("request_count").cast("long").alias("request_count"))
    kind = GroupStateTimeout.NoTimeout if duration is None else GroupStateTimeout.ProcessingTimeTimeout
    return rows.groupBy(*keys).applyInPandasWithState(judge, schema, STATE, "append", kind)


def _milliseconds(text: str) -> int:
    count, unit = text.split()
    return int(float(count) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")])


def final_moments(judged: DataFrame, keys: tuple[str, ...] = ("ip_address", "endpoint")) -> DataFrame:
    """The last state of every key in the stream's output: moments as ``moments.merge_moments`` gives them."""
    order = Window.partitionBy(*keys).orderBy(F.desc("n"))
    return judged.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").select(*keys, *STATE.fieldNames())
