"""Weather archives matched to declarations."""

from pyspark.sql import functions as F

from aftermath.functions import dates
from aftermath.operators import cleaning, costs, features, matching
from aftermath.session import durable
from aftermath.sources import archives
from queries.bindings import (
    DAILY_SQL,
    DECLARATIONS_SQL,
    PROJECTS_SQL,
    STATES,
    STORM_EVENTS_SQL,
    declarations,
    pick,
    projects,
    readings,
    sql_list,
    stations,
    storm_events,
    table,
    with_ctes,
)

def incident_window(spark, folder):
    windows = matching.with_window(declarations(spark, folder), "incidentbegindate", "incidentenddate")
    return windows.select("id", "window_start", "window_end")


WINDOWS_SQL = """
windows AS (
  SELECT *, incidentbegindate - INTERVAL 3 DAY AS window_start,
         coalesce(incidentenddate, incidentbegindate) + INTERVAL 3 DAY AS window_end
  FROM decl
)"""
INCIDENT_WINDOW = with_ctes(" SELECT id, window_start, window_end FROM windows", DECLARATIONS_SQL, WINDOWS_SQL)


def place_windows(spark, folder):
    spans = declarations(spark, folder).select(
        "disasternumber", "place", "incidentbegindate", "incidentenddate"
    ).distinct()
    return matching.with_window(spans, "incidentbegindate", "incidentenddate").select(
        "disasternumber", "place", "window_start", "window_end"
    )


def storm_match(spark, folder):
    pairs = matching.match_events(place_windows(spark, folder), storm_events(spark, folder))
    return pairs.select("disasternumber", "place", "event_begin", "event_order", "event_line", "magnitude")


STORM_PAIRS = """
  FROM windows JOIN storms ON windows.place = storms.place AND event_begin BETWEEN window_start AND window_end"""
STORM_MATCH = with_ctes(
    " SELECT disasternumber, windows.place AS place, event_begin, event_order, event_line, magnitude" + STORM_PAIRS,
    DECLARATIONS_SQL,
    WINDOWS_SQL,
    STORM_EVENTS_SQL,
)


def storm_overlap(spark, folder):
    """The documented variant: the event's span overlaps the window."""
    lasting = storm_events(spark, folder).withColumn(
        "event_end", F.col("event_begin") + F.make_dt_interval(days=(F.col("event_order") % 50).cast("int"))
    )
    pairs = matching.match_events(
        place_windows(spark, folder), lasting, event_end="event_end", mode="overlap"
    )
    return pairs.groupBy("disasternumber").agg(F.count(F.lit(1)).alias("n"), F.max("magnitude").alias("magnitude"))


STORM_OVERLAP = with_ctes(
    """
SELECT disasternumber, count(*) AS n, max(magnitude) AS magnitude
FROM windows JOIN storms ON windows.place = storms.place AND event_begin <= window_end
     AND event_begin + (event_order % 50) * INTERVAL 1 DAY >= window_start
WHERE window_start <= window_end
GROUP BY 1""",
    DECLARATIONS_SQL,
    WINDOWS_SQL,
    STORM_EVENTS_SQL,
)


def storm_table(spark, folder, incidents=None):
    measures = matching.storm_measures("magnitude_type", "event_type", "magnitude")
    incidents = incidents or declarations(spark, folder)
    return matching.storm_exposure(incidents, storm_events(spark, folder), measures)


def storm_aggregate(spark, folder):
    return storm_table(spark, folder)


STORM_SQL = f"""
storm AS (
  SELECT disasternumber, max(CASE WHEN is_wind THEN magnitude END) AS wind_speed,
         CAST(nullif(count(*) FILTER (WHERE is_flood), 0) AS BIGINT) AS flood_severity,
         count(*) AS storm_event_count {STORM_PAIRS}
  GROUP BY disasternumber
)"""
STORM_CTES = (DECLARATIONS_SQL, WINDOWS_SQL, STORM_EVENTS_SQL, STORM_SQL)
STORM_AGGREGATE = with_ctes(" SELECT * FROM storm", *STORM_CTES)


def daily(spark, folder):
    return matching.daily_maximum(
        cleaning.clean_readings(readings(spark, folder)),
        cleaning.clean_stations(stations(spark, folder)),
        "station",
        "state",
        "day",
        "precip_mm",
    )


def rain_clean(spark, folder):
    return daily(spark, folder)


RAIN_CLEAN = with_ctes(" SELECT state, day, precip_mm FROM daily", DAILY_SQL)


def rain_table(spark, folder, incidents=None):
    return matching.rain_exposure(incidents or declarations(spark, folder), daily(spark, folder))


def rain_match(spark, folder):
    return rain_table(spark, folder)


RAIN_SQL = """
rain AS (
  SELECT disasternumber, max(precip_mm) AS rainfall_intensity
  FROM windows JOIN daily ON windows.state = daily.state
       AND CAST(day AS TIMESTAMP) BETWEEN window_start AND window_end
  GROUP BY disasternumber
)"""
RAIN_MATCH = with_ctes(" SELECT * FROM rain", DECLARATIONS_SQL, WINDOWS_SQL, DAILY_SQL, RAIN_SQL)


def match_rate(spark, folder):
    rate = matching.match_rate(declarations(spark, folder), storm_table(spark, folder))
    return rate.withColumn("match_percent", F.round("match_percent", 6))


MATCH_RATE = with_ctes(
    """
SELECT count(s.disasternumber) AS matched, count(*) AS total,
       round(count(s.disasternumber) * 100.0 / count(*), 6) AS match_percent,
       CAST(count(s.disasternumber) * 100.0 / count(*) < 30 AS INT) AS low
FROM (SELECT DISTINCT disasternumber FROM decl) d LEFT JOIN storm s ON d.disasternumber = s.disasternumber""",
    *STORM_CTES,
)


def training_match_rate(spark, folder):
    """Share of the rows with a cost that have rainfall."""
    cost = costs.cost_by_disaster(cleaning.clean_projects(projects(spark, folder)))
    landed = durable(declarations(spark, folder))
    rows = landed.join(cost.select("disasternumber"), "disasternumber", "left_semi")
    percent = matching.matched_row_percent(rows, rain_table(spark, folder, landed))
    return percent.select(F.round("row_match_percent", 6).alias("row_match_percent"))


TRAINING_MATCH_RATE = with_ctes(
    """
SELECT round(avg(CASE WHEN disasternumber IN (SELECT disasternumber FROM rain) THEN 1.0 ELSE 0.0 END) * 100, 6)
       AS row_match_percent
FROM decl WHERE disasternumber IN (SELECT disasternumber FROM projects)""",
    DECLARATIONS_SQL,
    WINDOWS_SQL,
    DAILY_SQL,
    RAIN_SQL,
    PROJECTS_SQL,
)


def climate(spark, folder, incidents=None):
    """Both exposures; ``incidents`` passes declarations that are already written out."""
    return matching.combine_exposures(
        storm_table(spark, folder, incidents), rain_table(spark, folder, incidents)
    )


def climate_outer(spark, folder):
    return climate(spark, folder)


CLIMATE_SQL = """
climate AS (
  SELECT coalesce(s.disasternumber, r.disasternumber) AS disasternumber, wind_speed, flood_severity,
         storm_event_count, rainfall_intensity
  FROM storm s FULL JOIN rain r ON s.disasternumber = r.disasternumber
)"""
CLIMATE_CTES = (*STORM_CTES, DAILY_SQL, RAIN_SQL, CLIMATE_SQL)
CLIMATE_OUTER = with_ctes(" SELECT * FROM climate", *CLIMATE_CTES)


def climate_features(spark, folder):
    landed = durable(declarations(spark, folder))
    return features.attach_climate(
        landed.select("disasternumber", "state"), climate(spark, folder, landed), "disasternumber"
    )


CLIMATE_FEATURES = with_ctes(
    """
SELECT decl.disasternumber AS disasternumber, state, coalesce(wind_speed, 0.0) AS wind_speed,
       coalesce(flood_severity, 0) AS flood_severity, storm_event_count,
       coalesce(rainfall_intensity, 0.0) AS rainfall_intensity
FROM decl LEFT JOIN climate ON decl.disasternumber = climate.disasternumber""",
    *CLIMATE_CTES,
)


def latest_version(spark, folder):
    """A listing with one archive file name per line item, some of other kinds."""
    name = F.concat(
        F.when(F.col("l_linenumber") == 3, "StormEvents_fatalities-ftp_v1.0_d").otherwise("StormEvents_details-ftp_v1.0_d"),
        F.year("l_shipdate").cast("string"),
        F.lit("_c"),
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.lit(".csv.gz"),
    )
    listing = table(spark, folder, "lineitem").select(name.alias("name"))
    return matching.newest_versions(listing, "name", archives.STORM_FILE, range(1996, 2001))


LATEST_VERSION = """
SELECT year, 'StormEvents_details-ftp_v1.0_d' || year || '_c' || version || '.csv.gz' AS file_name, version
FROM (SELECT CAST(year(l_shipdate) AS INT) AS year, max(strftime(l_shipdate, '%Y%m%d')) AS version
      FROM lineitem WHERE l_linenumber <> 3 AND year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1)"""


def fixed_width(spark, folder):
    """Suppliers written as fixed-width station lines and parsed again."""
    source = table(spark, folder, "supplier")
    line = F.concat(
        F.rpad(F.concat(F.lit("US"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")), 12, " "),
        F.rpad(F.lpad(F.format_string("%.2f", "s_acctbal"), 8, " "), 9, " "),
        F.rpad(F.lit("-101.5000"), 10, " "),
        F.rpad(F.col("s_nationkey").cast("string"), 7, " "),
        F.rpad(pick(STATES, F.col("s_nationkey")), 3, " "),
        F.rpad("s_name", 30, " "),
    )
    parsed = archives.parse_stations(source.select(line.alias("value")))
    return parsed.select("ID", "LATITUDE", "LONGITUDE", "ELEVATION", "STATE", "NAME")


FIXED_WIDTH = f"""
SELECT 'US' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS "ID",
       s_acctbal AS "LATITUDE", -101.5::DOUBLE AS "LONGITUDE",
       CAST(s_nationkey AS DOUBLE) AS "ELEVATION", ({sql_list(STATES)})[s_nationkey + 1] AS "STATE", s_name AS "NAME"
FROM supplier"""


def compact_dates(spark, folder):
    raw = F.when(F.col("l_linenumber") == 4, "19961340").otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    days = table(spark, folder, "lineitem").select(dates.compact_date(raw).alias("day"))
    return days.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


COMPACT_DATES = """
SELECT CASE WHEN l_linenumber <> 4 THEN CAST(l_shipdate AS DATE) END AS day, count(*) AS n FROM lineitem GROUP BY 1"""

QUERIES = {
    "incident_window": (incident_window, INCIDENT_WINDOW),
    "storm_match": (storm_match, STORM_MATCH),
    "storm_overlap": (storm_overlap, STORM_OVERLAP),
    "storm_aggregate": (storm_aggregate, STORM_AGGREGATE),
    "rain_clean": (rain_clean, RAIN_CLEAN),
    "rain_match": (rain_match, RAIN_MATCH),
    "match_rate": (match_rate, MATCH_RATE),
    "training_match_rate": (training_match_rate, TRAINING_MATCH_RATE),
    "climate_outer": (climate_outer, CLIMATE_OUTER),
    "climate_features": (climate_features, CLIMATE_FEATURES),
    "latest_version": (latest_version, LATEST_VERSION),
    "fixed_width": (fixed_width, FIXED_WIDTH),
    "compact_dates": (compact_dates, COMPACT_DATES),
}
