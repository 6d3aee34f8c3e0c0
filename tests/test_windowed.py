"""Keyed state for windowed statistics, parts that are merged, and streams that stop and go on."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from lapframe.streaming import live, windowed

START = dt.datetime(2024, 1, 1)
SCHEMA = "driver long, ts timestamp, temp double"


def stats_of(df, time="window_start"):
    return sorted((r.driver if r.driver is not None else -1, r[time], r.value_avg and round(r.value_avg, 9), r.value_std and round(r.value_std, 9), r.n) for r in df.collect())


def batch_stats(rows):
    return rows.groupBy("driver", F.date_trunc("day", "ts").alias("window_start")).agg(
        F.avg("temp").alias("value_avg"), F.stddev_samp("temp").alias("value_std"), F.count("*").alias("n")
    )


def landed(spark, folder, rows, batches):
    for k, part in enumerate(batches):
        rows.where(part).coalesce(1).write.parquet(f"{folder}/{k}")
    return spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(folder)


def test_state_equals_batch_with_rows_days_late(spark, tmp_path):
    r = random.Random(1)
    rows = spark.createDataFrame(
        [(None if i == 5 else i % 3, START + dt.timedelta(hours=i), None if i % 11 == 7 else r.random() * 50) for i in range(200)], SCHEMA
    )
    # Newest days first: nearly all of the second and third landing is late, and windows of one landing meet state.
    stream = landed(spark, str(tmp_path / "in"), rows, ["dayofmonth(ts) > 6", "dayofmonth(ts) between 3 and 6 and hour(ts) < 12", "dayofmonth(ts) < 3", "dayofmonth(ts) between 3 and 6 and hour(ts) >= 12"])
    live.finish(windowed.keep_totals(stream, "ts", ["driver"], "temp", str(tmp_path / "t"), str(tmp_path / "c"), compact_every=3))
    tables = windowed.StatsTables(spark, str(tmp_path / "t"), {"driver": T.LongType()})
    assert stats_of(tables.read()) == stats_of(batch_stats(rows))
    late = tables.corrections.read(tables.columns)
    assert late.count() > 3 and tables.totals.read(tables.columns).count() > 6
    # What a read opens is bounded: a snapshot, and the deltas since.
    assert tables.totals._pointer()[0] == 0


def test_a_closed_window_is_corrected_by_later_runs(spark, tmp_path):
    landings = [
        [(1, START, 4.0), (1, START + dt.timedelta(hours=1), 6.0)],
        [(1, START + dt.timedelta(days=4), 2.0), (2, START, 1.0)],
        [(1, START + dt.timedelta(hours=2), 9.0), (1, None, 3.0), (2, START + dt.timedelta(hours=5), None)],
    ]
    path, check = str(tmp_path / "t"), str(tmp_path / "c")
    for k, rows in enumerate(landings):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
        source = spark.readStream.schema(T._parse_datatype_string(SCHEMA)).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        live.finish(windowed.keep_totals(source, "ts", ["driver"], "temp", path, check))
    tables = windowed.StatsTables(spark, path, {"driver": T.LongType()})
    whole = spark.createDataFrame(sum(landings, []), SCHEMA).where("ts is not null")
    assert stats_of(tables.read()) == stats_of(batch_stats(whole))
    assert [(r.driver, r.n) for r in tables.corrections.read(tables.columns).collect()] == [(1, 1)]


def test_sums_add_up_in_any_order():
    r = random.Random(4)
    values = [None if r.random() < 0.2 else r.random() * 9 for _ in range(60)]
    frame = pd.DataFrame({"k": [i % 2 for i in range(60)], "_time": range(60), "_value": pd.array(values, "Float64").astype("float64")})
    whole = windowed.summed(frame, ["k"])
    for k in (0, 1):
        own = frame[frame.k == k]
        parts = [tuple(windowed.summed(own.iloc[i : i + 7], ["k"])[windowed.SUMS].iloc[0]) for i in range(0, len(own), 7)]
        r.shuffle(parts)
        total = parts[0]
        for p in parts[1:]:
            total = windowed.added(total, p)
        assert total == pytest.approx(tuple(whole[whole.k == k][windowed.SUMS].iloc[0]))


def test_parts_are_merged_and_few_are_opened(spark, tmp_path):
    rows = spark.createDataFrame([(i % 2, START + dt.timedelta(hours=i), float(i)) for i in range(48)], SCHEMA)
    rows.repartition(9).write.parquet(str(tmp_path / "in"))
    stream = live.file_messages(spark, str(tmp_path / "in"), rows.schema, files_per_batch=1)
    live.finish(live.keep_stats(stream, "ts", ["driver"], "temp", str(tmp_path / "t"), str(tmp_path / "c"), compact_every=4))
    assert stats_of(live.read_stats(spark, str(tmp_path / "t"), ["driver"])) == stats_of(batch_stats(rows))
    table = live.PartsTable(spark, str(tmp_path / "t"), ["window_start", "driver"])
    columns = live.parts_schema({"window_start": T.TimestampType(), "driver": T.LongType()})
    version, upto = table._pointer()
    assert version == 1 and list(upto.values()) == [7]
    folders = {f.rsplit("/", 2)[1] for f in table.read(columns).inputFiles()}
    assert "stream_batch=8" in folders and "version=1" in folders and "version=0" not in folders


def test_a_running_stream_stops_between_batches_and_goes_on(spark, tmp_path):
    rows = spark.createDataFrame([(i, START + dt.timedelta(hours=i), float(i)) for i in range(40)], SCHEMA)
    rows.repartition(8).write.parquet(str(tmp_path / "in"))

    def start(trigger):
        stream = live.file_messages(spark, str(tmp_path / "in"), rows.schema, files_per_batch=1)
        return live.append_rows(stream, str(tmp_path / "out"), str(tmp_path / "c"), trigger)

    running = start({"processingTime": "1 second"})
    live.stop(running, after_batches=2)
    assert not running.isActive
    some = spark.read.schema(rows.schema).parquet(str(tmp_path / "out")).count()
    assert 0 < some < 40
    live.finish(start(None))
    assert sorted(r.driver for r in spark.read.schema(rows.schema).parquet(str(tmp_path / "out")).collect()) == list(range(40))
    with pytest.raises(TimeoutError):
        waiting = start({"processingTime": "1 second"})
        try:
            live.stop(waiting, after_batches=99, timeout=1)
        finally:
            waiting.stop()
