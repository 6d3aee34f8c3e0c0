"""Windowed statistics with running totals in keyed state.

Rows are summed up in each task before the shuffle, so a key that holds most of a batch sends a few rows. The state of a
key holds its open windows and up to when its windows are closed. A window closes when the key's newest event is
``delay`` past the window's end, and leaves the state; so a key holds no more windows than the delay spans, however long the
stream runs. A row of a closed window is not dropped: it goes to the table of corrections.

There are no timers: with processing-time timers Spark never ends an available-now run, and with event-time
timers it drops late rows before they are seen here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lapframe.streaming import live
from lapframe.workers import send_package

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUMS = ["n", "n_values", "mean", "squares"]

Sums = tuple[int, int, float | None, float | None]


def added(a: Sums, b: Sums) -> Sums:
    """The sums of both parts, around their common mean."""
    if not a[1] or not b[1]:
        own = a if a[1] else b
        return a[0] + b[0], a[1] + b[1], own[2], own[3]
    n = a[1] + b[1]
    gap = b[2] - a[2]
    return a[0] + b[0], n, a[2] + gap * b[1] / n, a[3] + b[3] + gap * gap * a[1] * b[1] / n


def summed(rows: pd.DataFrame, by: Sequence[str]) -> pd.DataFrame:
    """Sums of each window and key of some rows, with the newest event."""
    held = rows.groupby(list(by), dropna=False, sort=False)
    out = held.agg(n=("_time", "size"), n_values=("_value", "count"), mean=("_value", "mean"), latest=("_time", "max"))
    around = rows["_value"] - held["_value"].transform("mean")
    out["squares"] = (around * around).groupby([rows[c] for c in by], dropna=False, sort=False).sum()
    out.loc[out["n_values"] == 0, "squares"] = np.nan
    return out.reset_index()


class WindowTotals(StatefulProcessor):
    """Totals of the open windows of one key."""

    def __init__(self, keys: Sequence[str], window_us: int, delay_us: int):
        self.keys, self.window_us, self.delay_us = list(keys), window_us, delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getMapState("windows", "start long", "n long, n_values long, mean double, squares double")
        self.known = handle.getValueState("known", "newest long, closed long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, closed = self.known.get() if self.known.exists() else (None, None)
        parts: dict[int, Sums] = {}
        for batch in rows:
            values = zip(batch["window_us"], batch["latest_us"], *(batch[c] for c in SUMS))
            for start, latest, n, n_values, mean, squares in values:
                part = int(n), int(n_values), None if pd.isna(mean) else float(mean), None if pd.isna(squares) else float(squares)
                start = int(start)
                parts[start] = added(parts[start], part) if start in parts else part
                newest = int(latest) if newest is None else max(newest, int(latest))
        out = []
        for start, part in parts.items():
            held = self.windows.getValue((start,)) if self.windows.containsKey((start,)) else None
            late = held is None and closed is not None and start < closed
            if not late:
                part = added(tuple(held), part) if held is not None else part
                self.windows.updateValue((start,), part)
            out.append((*key, start, late, *part))
        # The first window that is not over yet, delay included.
        upto = (newest - self.delay_us) // self.window_us * self.window_us
        closed = upto if closed is None else max(closed, upto)
        for (start,) in list(self.windows.keys()):
            if start < closed:
                self.windows.removeKey((start,))
        self.known.update((newest, closed))
        yield pd.DataFrame(out, columns=[*self.keys, "window_us", "late", *SUMS])

    def close(self) -> None:
        pass


class StatsTables:
    """Running totals, the newest of a window wins, and corrections, which add up."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, T.DataType]):
        self.by = ["window_us", *keys]
        self.columns = live.parts_schema({"window_us": T.LongType(), **keys})
        self.totals = live.LatestTable(spark, f"{path}/totals", self.by, ["n"])
        self.corrections = live.PartsTable(spark, f"{path}/corrections", self.by)

    def write(self, batch: DataFrame, batch_id: int, stream: str) -> None:
        own = batch.select("late", *self.columns.names).persist()
        try:
            self.totals.write(own.where(~F.col("late")).drop("late"), batch_id, stream)
            self.corrections.write_unique(own.where("late").drop("late"), batch_id, stream)
        finally:
            own.unpersist()

    def compact(self) -> None:
        self.totals.compact(self.columns)
        self.corrections.compact(self.columns)

    def read(self) -> DataFrame:
        """Mean, sample deviation and count per window and key, corrections included."""
        parts = self.totals.read(self.columns).unionAll(self.corrections.read(self.columns))
        place = F.timestamp_micros("window_us").alias("window_start")
        stats = live.as_stats(live.merged_parts(parts, self.by), self.by)
        return stats.select(place, *self.by[1:], "value_avg", "value_std", "n")


def keep_totals(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    value: str,
    path: str,
    checkpoint: str,
    window: dt.timedelta = dt.timedelta(days=1),
    delay: dt.timedelta = dt.timedelta(days=1),
    compact_every: int = 200,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Statistics per key and event-time window, with state for open windows only.

    Windows begin at multiples of their length since 1970 in UTC. Rows without a time are left out. ``StatsTables`` reads the result.
    """
    spark = stream.sparkSession
    send_package(spark)
    kinds = {k: stream.schema[k].dataType for k in keys}
    tables = StatsTables(spark, path, kinds)
    span = window // dt.timedelta(microseconds=1)
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    rows = stream.where(F.col(time).isNotNull()).select(
        *keys, (micros - F.pmod(micros, F.lit(span))).alias("window_us"), micros.alias("_time"), F.col(value).cast("double").alias("_value")
    )
    by = [*keys, "window_us"]
    fields = [T.StructField(k, t) for k, t in kinds.items()]
    sums = T.StructType.fromDDL("n long, n_values long, mean double, squares double").fields
    before = T.StructType([*fields, T.StructField("window_us", T.LongType()), T.StructField("latest_us", T.LongType()), *sums])
    after = T.StructType([*fields, T.StructField("window_us", T.LongType()), T.StructField("late", T.BooleanType()), *sums])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield summed(batch, by).rename(columns={"latest": "latest_us"})[before.names]

    totals = (
        rows.mapInPandas(run, before)
        .groupBy(*keys)
        .transformWithStateInPandas(
            WindowTotals(keys, span, delay // dt.timedelta(microseconds=1)), after, "Update", "None"
        )
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.write(batch, batch_id, live.stream_id(spark, checkpoint))
        if (batch_id + 1) % compact_every == 0:
            tables.compact()

    given = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (
            totals.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .outputMode("update")
            .trigger(**(trigger or live.ONCE))
            .start()
        )
    finally:
        spark.conf.set(PROVIDER, given)
