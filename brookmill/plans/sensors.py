"""Sensor overview, dashboard datasets and charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmill.functions.dates import since, start_of
from brookmill.functions.types import AIR_QUALITY_ABOVE, AIR_QUALITY_BANDS, air_quality, band_sql, round_to
from brookmill.operators.aggregates import correlations, coverage
from brookmill.operators.filters import non_zero_point
from brookmill.plans.registry import query
from brookmill.plans.views import AS_OF, AS_OF_SQL, SENSORS, sensors


def _avg(c: str, digits: int = 4):
    return round_to(F.avg(c), digits)


@query(
    "q_sensor_overview",
    "AG-02 AG-03",
    f"""
WITH {SENSORS}
SELECT count(*) AS total_records, min(timestamp) AS earliest_record, max(timestamp) AS latest_record,
       count(DISTINCT sensor_id) AS unique_sensors, count(DISTINCT sensor_type) AS sensor_types
FROM sensors""",
)
def sensor_overview(t):
    return sensors(t).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("timestamp").alias("earliest_record"),
        F.max("timestamp").alias("latest_record"),
        F.countDistinct("sensor_id").alias("unique_sensors"),
        F.countDistinct("sensor_type").alias("sensor_types"),
    )


@query(
    "q_sensor_types",
    "AG-05 SL-01",
    f"""
WITH {SENSORS}
SELECT sensor_type, count(*) AS records_count, round_to(avg(temperature), 4) AS avg_temp,
       round_to(avg(humidity), 4) AS avg_humidity, round_to(avg(p2), 4) AS avg_pm25
FROM sensors GROUP BY sensor_type ORDER BY records_count DESC""",
)
def sensor_types(t):
    return (
        sensors(t)
        .groupBy("sensor_type")
        .agg(
            F.count(F.lit(1)).alias("records_count"),
            _avg("temperature").alias("avg_temp"),
            _avg("humidity").alias("avg_humidity"),
            _avg("p2").alias("avg_pm25"),
        )
        .orderBy(F.desc("records_count"))
    )


@query(
    "q_sensor_latest",
    "SL-09",
    f"""
WITH {SENSORS}
SELECT * FROM sensors ORDER BY timestamp DESC, sensor_id LIMIT 10""",
)
def sensor_latest(t):
    return sensors(t).orderBy(F.desc("timestamp"), "sensor_id").limit(10)


_RECENT = {
    "read_at": "timestamp",
    "device": "sensor_id",
    "kind": "sensor_type",
    "place": "location",
    "north": "lat",
    "east": "lon",
    "coarse": "p1",
    "fine": "p2",
    "warmth": "temperature",
    "moisture": "humidity",
    "air_pressure": "pressure",
}


@query(
    "q_ds_recent",
    "PF-01 PF-11",
    f"""
WITH {SENSORS}
SELECT {", ".join(f"{c} AS {name}" for name, c in _RECENT.items())}
FROM sensors WHERE NOT timestamp < {AS_OF_SQL} - INTERVAL 30 DAY""",
)
def ds_recent(t):
    return sensors(t).filter(since("timestamp", AS_OF, days=30)).select(*[F.col(c).alias(name) for name, c in _RECENT.items()])


@query(
    "q_ds_hourly",
    "AG-07 FN-11",
    f"""
WITH {SENSORS}
SELECT date_trunc('hour', timestamp) AS hour, sensor_type, count(*) AS measurements_count,
       round_to(avg(p2), 4) AS avg_pm25, round_to(avg(p1), 4) AS avg_pm10, round_to(avg(temperature), 4) AS avg_temperature,
       round_to(avg(humidity), 4) AS avg_humidity, round_to(avg(pressure), 4) AS avg_pressure
FROM sensors WHERE timestamp >= {AS_OF_SQL} - INTERVAL 7 DAY
GROUP BY ALL ORDER BY hour DESC""",
)
def ds_hourly(t):
    return (
        sensors(t)
        .filter(since("timestamp", AS_OF, days=7))
        .groupBy(start_of("hour", "timestamp").alias("hour"), "sensor_type")
        .agg(
            F.count(F.lit(1)).alias("measurements_count"),
            _avg("p2").alias("avg_pm25"),
            _avg("p1").alias("avg_pm10"),
            _avg("temperature").alias("avg_temperature"),
            _avg("humidity").alias("avg_humidity"),
            _avg("pressure").alias("avg_pressure"),
        )
        .orderBy(F.desc("hour"))
    )


@query(
    "q_ds_geo",
    "AG-32 AG-10 PF-13",
    f"""
WITH {SENSORS}
SELECT lat, lon, sensor_type, sensor_id, location, round_to(avg(p2), 4) AS avg_pm25,
       round_to(avg(temperature), 4) AS avg_temp, count(*) AS measurements_count, max(timestamp) AS last_measurement
FROM sensors
WHERE lat <> 0 AND lon <> 0 AND timestamp >= {AS_OF_SQL} - INTERVAL 480 HOUR
GROUP BY lat, lon, sensor_type, sensor_id, location HAVING count(*) >= 5""",
)
def ds_geo(t):
    return (
        sensors(t)
        .filter(non_zero_point() & since("timestamp", AS_OF, hours=480))
        .groupBy("lat", "lon", "sensor_type", "sensor_id", "location")
        .agg(
            _avg("p2").alias("avg_pm25"),
            _avg("temperature").alias("avg_temp"),
            F.count(F.lit(1)).alias("measurements_count"),
            F.max("timestamp").alias("last_measurement"),
        )
        .filter("measurements_count >= 5")
    )


def _hourly_averages(df, least: int):
    return (
        df.groupBy(start_of("hour", "timestamp").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("temperature").alias("avg_temp"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("p1").alias("avg_pm10"),
            F.avg("p2").alias("avg_pm25"),
            F.avg("pressure").alias("avg_pressure"),
        )
        .filter(F.col("n") >= least)
        .drop("n")
    )


def _complete(df):
    cond = F.lit(True)
    for c in ("temperature", "humidity", "p2", "pressure"):
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


_HOURLY_SQL = """
hourly AS (
  SELECT date_trunc('hour', timestamp) AS hour, avg(temperature) AS avg_temp, avg(humidity) AS avg_humidity,
         avg(p1) AS avg_pm10, avg(p2) AS avg_pm25, avg(pressure) AS avg_pressure
  FROM sensors
  WHERE timestamp >= {as_of} - INTERVAL {days} DAY AND temperature IS NOT NULL AND humidity IS NOT NULL
    AND p2 IS NOT NULL AND pressure IS NOT NULL {more}
  GROUP BY 1 HAVING count(*) >= {least})"""


@query(
    "q_ds_corr",
    "SO-04 PF-09 AG-10",
    f"""
WITH {SENSORS}, {_HOURLY_SQL.format(as_of=AS_OF_SQL, days=14, more="", least=10)}
SELECT hour, round_to(avg_temp, 4) AS avg_temp, round_to(avg_humidity, 4) AS avg_humidity,
       round_to(avg_pm10, 4) AS avg_pm10, round_to(avg_pm25, 4) AS avg_pm25, round_to(avg_pressure, 4) AS avg_pressure
FROM hourly ORDER BY hour""",
)
def ds_corr(t):
    hourly = _hourly_averages(_complete(sensors(t).filter(since("timestamp", AS_OF, days=14))), 10)
    cols = [round_to(c, 4).alias(c) for c in hourly.columns if c != "hour"]
    return hourly.select("hour", *cols).orderBy("hour")


@query(
    "q_viz_timeseries",
    "PF-07 AG-07",
    f"""
WITH {SENSORS}
SELECT date_trunc('hour', timestamp) AS time, round_to(avg(p2), 4) AS avg_pm25, round_to(avg(p1), 4) AS avg_pm10,
       count(*) AS measurements_count
FROM sensors
WHERE timestamp >= {AS_OF_SQL} - INTERVAL 7 DAY AND p2 IS NOT NULL AND p2 BETWEEN 0 AND 200
GROUP BY 1 ORDER BY 1""",
)
def viz_timeseries(t):
    return (
        sensors(t)
        .filter(since("timestamp", AS_OF, days=7) & F.col("p2").isNotNull() & F.col("p2").between(0, 200))
        .groupBy(start_of("hour", "timestamp").alias("time"))
        .agg(_avg("p2").alias("avg_pm25"), _avg("p1").alias("avg_pm10"), F.count(F.lit(1)).alias("measurements_count"))
        .orderBy("time")
    )


@query(
    "q_viz_types",
    "AG-10 SL-01",
    f"""
WITH {SENSORS}, kinds AS (
  SELECT sensor_type AS kind, count(*) AS readings, avg(temperature) AS t, avg(humidity) AS h, avg(p2) AS fine, avg(p1) AS coarse
  FROM sensors WHERE timestamp >= {AS_OF_SQL} - INTERVAL 7 DAY GROUP BY kind)
SELECT kind, readings, round_to(t, 1) AS mean_temperature, round_to(h, 1) AS mean_humidity, round_to(fine, 1) AS mean_fine_dust,
       round_to(coarse, 1) AS mean_coarse_dust
FROM kinds WHERE readings > 9""",
)
def viz_types(t):
    """Kinds of sensors with ten readings or more in a week; the first twenty by name."""
    kinds = (
        sensors(t)
        .filter(since("timestamp", AS_OF, days=7))
        .groupBy(F.col("sensor_type").alias("kind"))
        .agg(
            F.count(F.lit(1)).alias("readings"),
            _avg("temperature", 1).alias("mean_temperature"),
            _avg("humidity", 1).alias("mean_humidity"),
            _avg("p2", 1).alias("mean_fine_dust"),
            _avg("p1", 1).alias("mean_coarse_dust"),
        )
    )
    return kinds.filter("readings >= 10").orderBy("kind", F.desc("mean_temperature")).limit(20)


@query(
    "q_viz_coverage",
    "AG-29",
    f"""
WITH {SENSORS}, filled AS (
  SELECT sensor_type AS kind, count(*) AS n, count(DISTINCT sensor_id) AS devices, count(temperature) / count(*) AS t,
         count(humidity) / count(*) AS h, count(p2) / count(*) AS fine, count(pressure) / count(*) AS p
  FROM sensors WHERE timestamp >= {AS_OF_SQL} - INTERVAL 7 DAY GROUP BY kind)
SELECT kind, n AS readings, devices, round_to(t, 6) AS temperature_share, round_to(h, 6) AS humidity_share,
       round_to(fine, 6) AS pm25_share, round_to(p, 6) AS pressure_share, round_to((t + h + fine) / 3, 6) AS quality_index
FROM filled""",
)
def viz_coverage(t):
    shares = (
        sensors(t)
        .filter(since("timestamp", AS_OF, days=7))
        .groupBy("sensor_type")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.countDistinct("sensor_id").alias("devices"),
            coverage("temperature").alias("a"),
            coverage("humidity").alias("b"),
            coverage("p2").alias("c"),
            coverage("pressure").alias("d"),
        )
    )
    return shares.select(
        F.col("sensor_type").alias("kind"),
        "readings",
        "devices",
        round_to("a", 6).alias("temperature_share"),
        round_to("b", 6).alias("humidity_share"),
        round_to("c", 6).alias("pm25_share"),
        round_to("d", 6).alias("pressure_share"),
        round_to((F.col("a") + F.col("b") + F.col("c")) / 3, 6).alias("quality_index"),
    ).orderBy(F.desc("readings"))


#: Measures in the order in which their pairs are named.
_MEASURES = {"temperature": "avg_temp", "humidity": "avg_humidity", "fine dust": "avg_pm25", "pressure": "avg_pressure"}
# Readings outside are taken for outliers.
PLAUSIBLE = {"temperature": (-50, 60), "humidity": (0, 100), "p2": (0, 500)}
_CLIPPED = "".join(f" AND {c} >= {low} AND {c} <= {high}" for c, (low, high) in PLAUSIBLE.items())


@query(
    "q_viz_corr",
    "AG-16 AG-17 SL-06 SO-04",
    f"""
WITH {SENSORS}, {_HOURLY_SQL.format(as_of=AS_OF_SQL, days=30, more=_CLIPPED, least=5)}, long AS (
  SELECT hour, unnest([{", ".join(f"{{'rank': {i}, 'name': '{n}', 'v': {c}}}" for i, (n, c) in enumerate(_MEASURES.items()))}]) AS m FROM hourly)
SELECT x.m.name AS param_x, y.m.name AS param_y, round_to(nullif(corr(x.m.v, y.m.v), 'nan'::DOUBLE), 6) AS correlation
FROM long x JOIN long y ON x.hour = y.hour AND x.m.rank < y.m.rank GROUP BY 1, 2""",
)
def viz_corr(t):
    clipped = _complete(sensors(t).filter(since("timestamp", AS_OF, days=30)))
    for c, (low, high) in PLAUSIBLE.items():
        clipped = clipped.filter(F.col(c).between(low, high))
    return correlations(_hourly_averages(clipped, 5), _MEASURES, 6)


@query(
    "q_viz_daily_aqi",
    "AG-08 AG-31 PF-08 FN-09",
    f"""
WITH {SENSORS}
SELECT CAST(hour(timestamp) AS INTEGER) AS hour_of_day, sensor_type, round_to(avg(p2), 4) AS avg_pm25,
       round_to(avg(p1), 4) AS avg_pm10, round_to(avg(temperature), 4) AS avg_temperature, count(*) AS measurements_count,
       {band_sql("avg(p2)", AIR_QUALITY_BANDS, AIR_QUALITY_ABOVE)} AS aqi_category
FROM sensors
WHERE timestamp >= {AS_OF_SQL} - INTERVAL 14 DAY AND p2 IS NOT NULL AND p2 BETWEEN 0 AND 300
  AND sensor_type IN ('click', 'view', 'purchase')
GROUP BY 1, 2 HAVING count(*) >= 10 ORDER BY 1, 2""",
)
def viz_daily_aqi(t):
    return (
        sensors(t)
        .filter(
            since("timestamp", AS_OF, days=14)
            & F.col("p2").isNotNull()
            & F.col("p2").between(0, 300)
            & F.col("sensor_type").isin("click", "view", "purchase")
        )
        .groupBy(F.hour("timestamp").alias("hour_of_day"), "sensor_type")
        .agg(
            F.avg("p2").alias("raw"),
            _avg("p1").alias("avg_pm10"),
            _avg("temperature").alias("avg_temperature"),
            F.count(F.lit(1)).alias("measurements_count"),
        )
        .filter("measurements_count >= 10")
        .select(
            "hour_of_day",
            "sensor_type",
            round_to("raw", 4).alias("avg_pm25"),
            "avg_pm10",
            "avg_temperature",
            "measurements_count",
            air_quality("raw").alias("aqi_category"),
        )
        .orderBy("hour_of_day", "sensor_type")
    )
