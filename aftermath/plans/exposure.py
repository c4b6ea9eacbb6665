"""The exposure job: weather archives matched to declarations."""

from pyspark.sql import DataFrame

from aftermath.operators import cleaning, matching


def storm_table(declarations: DataFrame, events: DataFrame) -> DataFrame:
    """Wind, floods and event count per disaster from raw declarations and storm events."""
    return matching.storm_exposure(
        cleaning.county_declarations(declarations),
        cleaning.clean_storm_events(events),
        matching.storm_measures("magnitude_type", "event_type", "magnitude"),
    )


def rain_table(declarations: DataFrame, readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Highest daily rainfall per disaster from raw declarations and station readings."""
    daily = matching.daily_maximum(
        cleaning.clean_readings(readings),
        cleaning.clean_stations(stations),
        "station",
        "state",
        "day",
        "precip_mm",
    )
    return matching.rain_exposure(cleaning.state_declarations(declarations), daily)


def climate_table(storm: DataFrame, rain: DataFrame) -> DataFrame:
    return matching.combine_exposures(storm, rain)
