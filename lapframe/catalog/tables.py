"""Scans, projections, filters, scalars and encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lapframe import bindings as b
from lapframe import config
from lapframe.catalog.registry import query
from lapframe.functions import arrays, geo, messages, text, times
from lapframe.operators import clean, features, geometry
from lapframe.operators.ordered import neighbours
from lapframe.plans import dataset
from lapframe.sources import readers, writers
from lapframe.session import new_path


@query(
    """SELECT * FROM (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)
    UNION ALL BY NAME SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"""
)
def scan_parquet_union(spark: SparkSession, sf: str) -> DataFrame:
    return readers.parquet(spark, [f"{sf}/customer.parquet", f"{sf}/supplier.parquet"])


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, car_part, lap_time
    FROM clean"""
)
def sink_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.clean_laps(b.laps(spark, sf)).select(
        "season", "race_round", "driver_id", "lap_number", "car_part", "lap_time"
    )
    path = new_path(spark, "laps")
    writers.partitioned_parquet(rows, path, ["season", "race_round"])
    return readers.parquet(spark, [path]).select(*rows.columns)


@query(
    """SELECT CAST(l_suppkey AS BIGINT) AS driver_id, l_linenumber AS lap_number,
       l_extendedprice AS lap_time, l_discount AS sector1_time, 2024 AS season,
       'test_grand_prix' AS grand_prix FROM lineitem"""
)
def normalize_laps(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.table(spark, sf, "lineitem").withColumn("l_suppkey", F.col("l_suppkey").cast("string"))
    renames = {
        "l_suppkey": "driver_id",
        "l_linenumber": "lap_number",
        "l_extendedprice": "lap_time",
        "l_discount": "sector1_time",
        "not_there": "sector2_time",
    }
    return clean.normalize(
        raw,
        renames,
        keep=["driver_id", "lap_number", "lap_time", "sector1_time", "season", "grand_prix"],
        int_keys=["driver_id"],
        literals={"season": 2024, "grand_prix": "test_grand_prix"},
    )


@query(
    """SELECT CAST(year(l_shipdate) AS INT) AS season, CAST(month(l_shipdate) AS INT) AS race_round,
       l_suppkey AS driver_id,
       l_orderkey * 10 + l_linenumber AS lap_number, l_extendedprice / 1000 AS lap_time
       FROM lineitem WHERE l_tax > 0 AND l_extendedprice / 1000 BETWEEN 40 AND 300"""
)
def clean_laps(spark: SparkSession, sf: str) -> DataFrame:
    laps = b.laps(spark, sf).withColumn(
        "lap_time", F.when(F.col("humidity") > 0, F.col("lap_time"))
    )
    return clean.clean_laps(laps).select(*config.REQUIRED_COLUMNS)


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, lap_time,
       nullif("PitDuration", 0.05) AS "PitDuration" FROM clean
       WHERE coalesce(nullif("PitDuration", 0.05), 0) <= 0.01"""
)
def clean_laps_no_pit(spark: SparkSession, sf: str) -> DataFrame:
    laps = b.laps(spark, sf).withColumn("PitDuration", F.nullif("PitDuration", F.lit(0.05)))
    return clean.clean_laps(laps, pit_column="PitDuration").select(
        *config.REQUIRED_COLUMNS, "PitDuration"
    )


_YEARS = "concat(year(o_orderdate), '-', year(o_orderdate) + 2)"


@query(
    f"""SELECT o_orderkey, lower(replace(replace(o_orderpriority, '-', '_'), ' ', '_')) AS host,
       {_YEARS} AS years, CAST(year(o_orderdate) AS INT) AS year_start FROM orders
       WHERE o_orderpriority = '4-NOT SPECIFIED' AND year(o_orderdate) BETWEEN 1996 AND 1998"""
)
def track_period_filter(spark: SparkSession, sf: str) -> DataFrame:
    meta = _track_periods(spark, sf)
    return clean.track_period(meta, "4_not_specified", 1996, 1998)


def _track_periods(spark: SparkSession, sf: str) -> DataFrame:
    orders = b.table(spark, sf, "orders")
    year = F.year("o_orderdate")
    return orders.select(
        "o_orderkey",
        text.slug(F.col("o_orderpriority")).alias("host"),
        F.concat_ws("-", year, year + 2).alias("years"),
    ).withColumn("year_start", text.first_int(F.col("years")))


@query(
    """SELECT o_orderkey, CAST(month(o_orderdate) - 3 AS INT) AS "RoundNumber" FROM orders
       WHERE month(o_orderdate) - 3 >= 1"""
)
def valid_rounds(spark: SparkSession, sf: str) -> DataFrame:
    schedule = b.table(spark, sf, "orders").select(
        "o_orderkey", (F.month("o_orderdate") - 3).alias("RoundNumber")
    )
    return clean.valid_rounds(schedule)


@query(
    """SELECT DISTINCT CAST(month(o_orderdate) AS INT) AS race_round FROM orders
       ORDER BY race_round LIMIT 5"""
)
def first_n_rounds(spark: SparkSession, sf: str) -> DataFrame:
    schedule = b.table(spark, sf, "orders").select(F.month("o_orderdate").alias("race_round"))
    return clean.first_rounds(schedule, "race_round", 5)


@query(
    f"""WITH {b.LAPS_SQL} SELECT CASE WHEN season <= 1999 THEN 'train' ELSE 'test' END AS part,
       season, driver_id, lap_number, car_part, lap_time FROM clean WHERE season <= 2000"""
)
def season_holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf))
    train, test = clean.season_split(laps, 1999, 2000)
    named = train.select(F.lit("train").alias("part"), "*").unionByName(
        test.select(F.lit("test").alias("part"), "*")
    )
    return named.select("part", "season", "driver_id", "lap_number", "car_part", "lap_time")


@query(
    """SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       coalesce(nullif(l_quantity, 7), 0) AS l_quantity, l_discount, l_tax,
       CAST(l_quantity > 25 AS DOUBLE) AS "FreshTyre" FROM lineitem"""
)
def numeric_feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "lineitem").withColumns(
        {
            "FreshTyre": F.col("l_quantity") > 25,
            "l_quantity": F.nullif("l_quantity", F.lit(7.0)),
        }
    )
    return clean.numeric_frame(
        rows, drop=["l_extendedprice", "l_partkey", "l_suppkey", "season", "grand_prix"]
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) AS some_values
       FROM lineitem"""
)
def drop_all_null_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif("l_discount", F.lit(0.0)).alias("some_values"),
        F.nullif("l_tax", "l_tax").alias("no_values"),
    )
    return clean.drop_all_null(rows)


@query(
    """SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS DOUBLE) AS deleted,
       o_orderpriority FROM orders"""
)
def coerce_booleans(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = b.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "F", "True").when(status == "O", "FALSE").otherwise(status).alias("deleted"),
        "o_orderpriority",
    )
    return clean.coerce_booleans(rows)


@query(
    """SELECT p_partkey, lower(trim(replace(replace(replace(replace(p_type || ' ' || p_name ||
       ' G.P./' || p_brand || '-x', '.', ''), ' ', '_'), '-', '_'), '/', '_'))) AS slug FROM part"""
)
def slugify(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(
        F.lit("  "), "p_type", F.lit(" "), "p_name", F.lit(" G.P./"), "p_brand", F.lit("-x ")
    )
    return b.table(spark, sf, "part").select("p_partkey", text.slug(name).alias("slug"))


@query(
    f"""SELECT o_orderkey, {_YEARS} AS years, CAST(year(o_orderdate) AS INT) AS year_start
       FROM orders"""
)
def year_start(spark: SparkSession, sf: str) -> DataFrame:
    return _track_periods(spark, sf).select("o_orderkey", "years", "year_start")


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal END AS lat,
       CAST(c_custkey AS DOUBLE) AS lon FROM customer"""
)
def parse_latlon(spark: SparkSession, sf: str) -> DataFrame:
    first = F.when(F.col("c_nationkey") == 3, F.lit("n/a")).otherwise(
        F.col("c_acctbal").cast("string")
    )
    rows = b.table(spark, sf, "customer").select(
        "c_custkey", F.concat_ws(",", first, F.col("c_custkey").cast("string")).alias("coords")
    )
    lat, lon = text.lat_lon(F.col("coords"))
    return rows.select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@query(
    f"""WITH {b.LAPS_SQL} SELECT season || '_' || race_round AS season_race,
       season || '|' || race_round || '|' || driver_id AS driver_race, CAST(count(*) AS BIGINT) AS n
       FROM laps GROUP BY ALL"""
)
def group_key(spark: SparkSession, sf: str) -> DataFrame:
    laps = b.laps(spark, sf)
    season, race, driver = (F.col(c) for c in config.DRIVER_RACE_KEYS)
    counted = laps.groupBy(*config.DRIVER_RACE_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        text.group_key(season, race).alias("season_race"),
        text.group_key(season, race, driver, separator="|").alias("driver_race"),
        "n",
    )


@query(
    """SELECT event_id,
       (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6 AS seconds,
       (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6 AS interval_seconds FROM events"""
)
def durations_seconds(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return b.table(spark, sf, "events").select(
        "event_id",
        times.seconds_between(day, F.col("ts")).alias("seconds"),
        times.interval_seconds(F.col("ts") - day).alias("interval_seconds"),
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS session_date FROM events""")
def session_date(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select(
        "event_id", times.iso_date(F.col("ts")).alias("session_date")
    )


_ANGLE = "(hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts))) * 2 * pi() / 86400"


@query(
    f"""SELECT event_id, CAST(dayofyear(ts) AS INT) AS "LapStartDayOfYear",
       round(sin({_ANGLE}), 9) AS "LapStart_sin", round(cos({_ANGLE}), 9) AS "LapStart_cos"
       FROM events"""
)
def cyclical_time(spark: SparkSession, sf: str) -> DataFrame:
    return features.cyclical_time(b.table(spark, sf, "events"), "ts").select(
        "event_id",
        "LapStartDayOfYear",
        F.round("LapStart_sin", 9).alias("LapStart_sin"),
        F.round("LapStart_cos", 9).alias("LapStart_cos"),
    )


_LINES = f"""{b.VERTICES_SQL.split("xy AS (")[0].rstrip().rstrip(",")}, p AS (
  SELECT track AS vec_id, idx, lag(lon) OVER w AS lon_a, lag(lat) OVER w AS lat_a, lon AS lon_b, lat AS lat_b,
         lead(lon) OVER w AS lon_c, lead(lat) OVER w AS lat_c
  FROM vertices WINDOW w AS (PARTITION BY track ORDER BY idx))"""


def _along(spark: SparkSession, sf: str) -> DataFrame:
    """Every vertex of every line with the one before and the one after it."""
    linked = neighbours(
        b.vertices(spark, sf),
        ["track"],
        ["idx"],
        lags={"lon_a": ("lon", 1), "lat_a": ("lat", 1)},
        leads={"lon_c": ("lon", 1), "lat_c": ("lat", 1)},
        fits=True,
    )
    return linked.withColumnsRenamed({"track": "vec_id", "lon": "lon_b", "lat": "lat_b"})


@query(
    f"""WITH {_LINES},
    h AS (SELECT vec_id, idx, pow(sin(radians(lat_b - lat_a) / 2), 2) + cos(radians(lat_a)) *
          cos(radians(lat_b)) * pow(sin(radians(lon_b - lon_a) / 2), 2) AS a FROM p WHERE lon_a IS NOT NULL)
    SELECT vec_id, idx, round(2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a)), 4) AS distance_m FROM h"""
)
def haversine_distance(spark: SparkSession, sf: str) -> DataFrame:
    d = geo.haversine(*[F.col(c) for c in ("lat_a", "lon_a", "lat_b", "lon_b")])
    rows = _along(spark, sf).where("lon_a IS NOT NULL")
    return rows.select("vec_id", "idx", F.round(d, 4).alias("distance_m"))


@query(
    f"""WITH {_LINES}, m AS (
      SELECT vec_id, idx, lon_a * 1e5 AS ax, lat_a * 1e5 AS ay, lon_b * 1e5 AS bx, lat_b * 1e5 AS by_,
             lon_c * 1e5 AS cx, lat_c * 1e5 AS cy FROM p WHERE lon_a IS NOT NULL AND lon_c IS NOT NULL),
    d AS (SELECT *, ax * (by_ - cy) - ay * (bx - cx) + (bx * cy - cx * by_) AS det,
             ax * ax + ay * ay AS sa, bx * bx + by_ * by_ AS sb, cx * cx + cy * cy AS sc FROM m),
    u AS (SELECT *, (sa * (by_ - cy) - ay * (sb - sc) + (sb * cy - sc * by_)) / (2 * det) AS ux,
             -(sa * (bx - cx) - ax * (sb - sc) + (sb * cx - sc * bx)) / (2 * det) AS uy FROM d),
    r AS (SELECT vec_id, idx, CASE WHEN abs(det) >= 1e-6 THEN sqrt(pow(ux - ax, 2) + pow(uy - ay, 2)) END AS r FROM u)
    SELECT vec_id, idx, round(r, CASE WHEN r < 1e5 THEN 2 ELSE -2 END) AS radius_m FROM r"""
)
def circumradius(spark: SparkSession, sf: str) -> DataFrame:
    """The circle through every three vertices in a row; a nearly straight one is told less exactly."""
    scaled = [F.col(c) * 1e5 for c in ("lon_a", "lat_a", "lon_b", "lat_b", "lon_c", "lat_c")]
    r = geo.circumradius(*scaled)
    rows = _along(spark, sf).where("lon_a IS NOT NULL AND lon_c IS NOT NULL")
    return rows.select("vec_id", "idx", F.when(r < 1e5, F.round(r, 2)).otherwise(F.round(r, -2)).alias("radius_m"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'N' AND l_tax = 0 THEN 'A' ELSE l_returnflag END AS compound,
       l_linestatus AS "TeamText",
       CASE WHEN l_returnflag = 'N' AND l_tax = 0 THEN 'UNKNOWN' ELSE l_returnflag END AS compound_known
       FROM lineitem"""
)
def decode_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.flagged_laps(spark, sf).withColumn(
        "Compound_N",
        F.when(F.col("humidity") == 0, None).otherwise(F.col("Compound_N")),
    )
    decoded = features.with_team(features.with_compound(rows))
    known = features.text_or_flags(rows, [], "Compound_", none_set="UNKNOWN")
    return decoded.select(
        F.floor(F.col("lap_number") / 10).alias("l_orderkey"),
        F.col("position").cast("int").alias("l_linenumber"),
        F.col("car_part").alias("l_partkey"),
        "compound",
        "TeamText",
        known.alias("compound_known"),
    )


@query(
    "SELECT vec_id, "
    + ", ".join(f"CASE WHEN label >= 5 OR {i} <= 40 THEN embedding[{i}] END AS corner_{i}_radius" for i in range(1, 65))
    + " FROM embeddings"
)
def corner_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of 40 and of 64 corners as columns."""
    corners = F.when(F.col("label") < 5, 40).otherwise(64)
    rows = b.table(spark, sf, "embeddings").select(
        "vec_id", F.slice("embedding", F.lit(1), corners).alias("radii")
    )
    names = [f"corner_{i}_radius" for i in range(1, 65)]
    return rows.select("vec_id", *arrays.to_wide(F.col("radii"), names))


@query(
    """SELECT vec_id, 'corner_' || i || '_coords' AS corner, embedding[i] AS coords
       FROM (SELECT vec_id, label, embedding, unnest(range(1, 65)) AS i FROM embeddings)
       WHERE i <> 2 OR label >= 5"""
)
def corner_long(spark: SparkSession, sf: str) -> DataFrame:
    """64 corner columns as rows; the second is missing on some tracks."""
    names = [f"corner_{i}_coords" for i in range(1, 65)]
    values = [F.col("embedding")[i] for i in range(64)]
    values[1] = F.when(F.col("label") >= 5, values[1])
    meta = b.table(spark, sf, "embeddings").select("vec_id", *[v.alias(n) for v, n in zip(values, names)])
    return geometry.corners_long(meta, ["vec_id"], [*names, "corner_65_coords"])


MESSAGE = T.StructType([T.StructField("k", T.LongType()), T.StructField("z", T.DoubleType())])
MESSAGE_DEFAULTS = {"k": 0, "z": 0.0}


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0
       ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CAST(0.0 AS DOUBLE) AS z FROM events"""
)
def json_defaults(spark: SparkSession, sf: str) -> DataFrame:
    body = F.when(F.col("event_type") == "error", F.lit('{"k": null}')).otherwise(F.col("props"))
    return b.table(spark, sf, "events").select(
        "event_id", *messages.decode_with_defaults(body, MESSAGE, MESSAGE_DEFAULTS)
    )


@query(
    """SELECT '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || user_id ||
       CASE WHEN event_type = 'view' THEN '' ELSE ',"event_type":"' || event_type || '"' END ||
       ',"value":' || value || ',"props":"' || replace(props, '"', '\\"') || '"}' AS value FROM events"""
)
def rows_to_json(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows; a null leaves its field out."""
    rows = b.table(spark, sf, "events").withColumn("event_type", F.nullif("event_type", F.lit("view")))
    return messages.encode_rows(rows)


@query(
    """SELECT c_custkey AS driver_id, c_acctbal AS lap_time, c_mktsegment AS compound,
       CAST(NULL AS INT) AS grid_position FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier"""
)
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    first = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("driver_id"),
        F.col("c_acctbal").alias("lap_time"),
        F.col("c_mktsegment").alias("compound"),
    )
    second = b.table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("grid_position"),
        F.col("s_suppkey").alias("driver_id"),
        F.col("s_acctbal").alias("lap_time"),
    )
    return readers.unite([first, second])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(coalesce(nullif(l_returnflag, 'R') = 'A', false) AS DOUBLE) AS "compound_A",
       CAST(coalesce(nullif(l_returnflag, 'R') = 'N', false) AS DOUBLE) AS "compound_N",
       CAST(l_linestatus = 'F' AS DOUBLE) AS "Team_F", CAST(l_linestatus = 'O' AS DOUBLE) AS "Team_O"
       FROM lineitem"""
)
def onehot_wide(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "lineitem").withColumns(
        {"compound": F.nullif("l_returnflag", F.lit("R")), "Team": F.col("l_linestatus")}
    )
    made, _ = features.one_hot(rows, ["compound", "Team", "not_there"])
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[e.alias(n) for n, e in made.items()]
    )


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, car_part, lap_time,
       position, "TyreLife", "PitDuration", humidity,
       coalesce(lag(lap_time, 1) OVER w, 0) AS lap_time_lag1,
       coalesce(lag(lap_time, 2) OVER w, 0) AS lap_time_lag2,
       coalesce(lag(lap_time, 3) OVER w, 0) AS lap_time_lag3,
       coalesce(lag("TyreLife", 1) OVER w, 0) AS "TyreLife_lag1",
       coalesce(lag("TyreLife", 2) OVER w, 0) AS "TyreLife_lag2",
       CAST(compound = 'A' AS DOUBLE) AS "Compound_A", CAST(compound = 'N' AS DOUBLE) AS "Compound_N",
       CAST(compound = 'R' AS DOUBLE) AS "Compound_R",
       CAST(team = 'F' AS DOUBLE) AS "Team_F", CAST(team = 'O' AS DOUBLE) AS "Team_O",
       season || '_' || race_round AS season_race
       FROM clean WINDOW w AS (PARTITION BY season, race_round, driver_id
                               ORDER BY lap_number, car_part, lap_time, "TyreLife")"""
)
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    cfg = config.FeatureConfig(categorical=["compound"], lap_order=b.LAP_ORDER)
    rows = b.flagged_laps(spark, sf).withColumn("pit_lane_length", F.lit(None).cast("double"))
    return dataset.build(rows, cfg, carry=["lap_number", "car_part"]).frame
