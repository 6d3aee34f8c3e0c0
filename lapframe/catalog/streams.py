"""Streaming queries over the events table, read back as a batch table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lapframe import bindings as b
from lapframe.catalog.registry import query, settled, settled_sql
from lapframe.catalog.tables import MESSAGE, MESSAGE_DEFAULTS
from lapframe.session import new_path
from lapframe.streaming import layered, live, windowed


def _events(spark: SparkSession, sf: str) -> DataFrame:
    columns = b.table(spark, sf, "events").schema
    return live.file_messages(spark, sf, columns, "events.parquet")


def _parsed(spark: SparkSession, sf: str, carry: list[str]) -> DataFrame:
    return live.parse(
        _events(spark, sf), "props", MESSAGE, MESSAGE_DEFAULTS, carry, event_time=None
    )


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(0.0 AS DOUBLE) AS z
       FROM events"""
)
def stream_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "parsed")
    stream = _parsed(spark, sf, ["event_id"])
    live.finish(live.append_rows(stream, f"{path}/rows", f"{path}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@query(
    """SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
       arg_max(CAST(json_extract(props, '$.k') AS BIGINT), (ts, event_id)) AS k,
       CAST(0.0 AS DOUBLE) AS z FROM events GROUP BY user_id"""
)
def stream_latest_features(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "latest")
    stream = _parsed(spark, sf, ["user_id", "ts", "event_id"])
    table = live.LatestTable(spark, f"{path}/table", ["user_id"], ["ts", "event_id"])
    live.finish(live.keep_latest(stream, table, f"{path}/checkpoint"))
    return table.read(stream.schema)


_STATS_SQL = f"""SELECT user_id, date_trunc('day', ts) AS window_start, {settled_sql("avg(value)")} AS value_avg,
       {settled_sql("stddev_samp(value)")} AS value_std, CAST(count(*) AS BIGINT) AS n
       FROM events GROUP BY ALL"""


@query(_STATS_SQL)
def stream_sensor_stats(spark: SparkSession, sf: str) -> DataFrame:
    """What each batch adds to a window is written, and parts are merged every few batches."""
    path = new_path(spark, "stats")
    stream = _late_events(spark, sf, path)
    live.finish(live.keep_stats(stream, "ts", ["user_id"], "value", f"{path}/parts", f"{path}/checkpoint", compact_every=3))
    return _shown(live.read_stats(spark, f"{path}/parts", ["user_id"]))


@query(_STATS_SQL)
def stream_window_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed state holds the totals of open windows; rows of closed ones go to the corrections."""
    path = new_path(spark, "totals")
    stream = _late_events(spark, sf, path)
    live.finish(
        windowed.keep_totals(stream, "ts", ["user_id"], "value", f"{path}/tables", f"{path}/checkpoint", delay=dt.timedelta(days=2), compact_every=3)
    )
    tables = windowed.StatsTables(spark, f"{path}/tables", {"user_id": stream.schema["user_id"].dataType})
    return _shown(tables.read())


def _late_events(spark: SparkSession, sf: str, path: str) -> DataFrame:
    """Events land by hour of day, the latest hours first, in several files each, so nearly every window gets rows a day
    or more late."""
    events = b.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    part = (F.lit(3) - F.floor(F.hour("ts") / 6)).cast("int").alias("part")
    shown = events.select("*", part)
    for k in range(4):
        shown.where(F.col("part") == k).drop("part").repartition(2, "event_id").write.mode("append").parquet(f"{path}/in")
    return live.file_messages(spark, f"{path}/in", events.schema, files_per_batch=2)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(0.0 AS DOUBLE) AS z, true AS stopped FROM events")
def stream_stop_and_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A running stream is stopped after some of its batches and goes on later; no event is lost or repeated."""
    path = new_path(spark, "stopped")
    events = b.table(spark, sf, "events").select("event_id", "props")
    events.repartition(6, "event_id").write.parquet(f"{path}/in")

    def start(trigger: dict | None = None):
        source = live.file_messages(spark, f"{path}/in", events.schema, files_per_batch=1)
        parsed = live.parse(source, "props", MESSAGE, MESSAGE_DEFAULTS, ["event_id"], event_time=None)
        return parsed.schema, live.append_rows(parsed, f"{path}/out", f"{path}/checkpoint", trigger)

    columns, running = start({"processingTime": "2 seconds"})
    live.stop(running, after_batches=2)
    before = spark.read.schema(columns).parquet(f"{path}/out").count()
    live.finish(start()[1])
    rows = spark.read.schema(columns).parquet(f"{path}/out")
    return rows.withColumn("stopped", F.lit(0 < before < events.count()))


def _shown(stats: DataFrame) -> DataFrame:
    return stats.select(
        "user_id",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        settled("value_avg").alias("value_avg"),
        settled("value_std").alias("value_std"),
        "n",
    )


@query(
    """SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id"""
)
def stream_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams with their own checkpoints write into one table, one after the other."""
    path = new_path(spark, "runs")
    events = b.table(spark, sf, "events").select("user_id", "ts", "event_id")
    table = live.LatestTable(spark, f"{path}/table", ["user_id"], ["ts", "event_id"])
    for k in range(2):
        events.where(F.col("event_id") % 2 == k).write.parquet(f"{path}/in{k}")
        stream = live.file_messages(spark, f"{path}/in{k}", events.schema, files_per_batch=1)
        live.finish(live.keep_latest(stream, table, f"{path}/checkpoint{k}", compact_every=2))
    return table.read(events.schema)


@query(
    """WITH asked AS (SELECT DISTINCT user_id FROM events ORDER BY user_id LIMIT 10)
    SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
       user_id IN (SELECT user_id FROM asked) AS asked, true AS few_files FROM events GROUP BY user_id"""
)
def stream_levels_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """All users' newest events from a table in levels, and those of a request for ten users, which opens few files."""
    path = new_path(spark, "levels")
    events = b.table(spark, sf, "events").select("user_id", "ts", "event_id")
    events.repartition(9, "event_id").write.parquet(f"{path}/in")
    stream = live.file_messages(spark, f"{path}/in", events.schema, files_per_batch=1)
    table = layered.LayeredTable(spark, f"{path}/table", ["user_id"], ["ts", "event_id"], fan_in=2)
    live.finish(live.keep_latest(stream, table, f"{path}/checkpoint"))
    request = [(r.user_id,) for r in events.select("user_id").distinct().orderBy("user_id").limit(10).collect()]
    found = table.look_up([*request, (-1,)], events.schema)
    runs = table.manifest()["runs"]
    few = layered.opened(found) <= 1 + sum(min(len(request) + 1, 1 << r["bits"]) for r in runs) and len(runs) <= 4
    marked = found.withColumn("asked", F.lit(True)).unionAll(
        table.read(events.schema).where(~F.col("user_id").isin([r[0] for r in request])).withColumn("asked", F.lit(False))
    )
    return marked.withColumn("few_files", F.lit(few))


@query(
    """WITH m AS (SELECT event_id, CASE event_type WHEN 'click' THEN -1
         ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, event_type FROM events)
    SELECT event_id, k, CAST(0.0 AS DOUBLE) AS z, CAST(NULL AS VARCHAR) AS malformed FROM m WHERE event_type <> 'error'
    UNION ALL SELECT event_id, NULL, NULL, 'no message' FROM m WHERE event_type = 'error'"""
)
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with NaN tokens get defaults, and malformed ones are set aside, none is lost."""
    path = new_path(spark, "rejects")
    events = b.table(spark, sf, "events")
    told = F.when(F.col("event_type") == "error", "no message").when(
        F.col("event_type") == "click", F.lit('{"k": -1, "z": NaN}')
    )
    events.select("event_id", F.coalesce(told, "props").alias("value")).write.parquet(f"{path}/in")
    raw = T.StructType.fromDDL("event_id long, value string")
    stream = live.parse(
        live.file_messages(spark, f"{path}/in", raw), "value", MESSAGE, MESSAGE_DEFAULTS, ["event_id"], None, "malformed"
    )
    table = live.LatestTable(spark, f"{path}/table", ["event_id"], ["k"])
    live.finish(live.keep_latest(stream, table, f"{path}/checkpoint", "malformed", f"{path}/rejects"))
    good = table.read(stream.drop("malformed").schema).withColumn("malformed", F.lit(None).cast("string"))
    bad = spark.read.schema(stream.schema).parquet(f"{path}/rejects").select(*good.columns)
    return good.unionByName(bad)
