"""Constant lookups: census regions and incident severity."""

from itertools import chain

from pyspark.sql import Column, functions as F

# The four census regions by postal code.
REGION_STATES = {
    "Northeast": "CT ME MA NH RI VT NJ NY PA",
    "Midwest": "IL IN MI OH WI IA KS MN MO NE ND SD",
    "South": "DE FL GA MD NC SC VA DC WV AL KY MS TN AR LA OK TX",
    "West": "AZ CO ID MT NV NM UT WY AK CA HI OR WA",
}
OTHER_REGION = "Other"

# Severity of an incident type on a 1-5 scale.
INCIDENT_SEVERITY = {
    "Hurricane": 5,
    "Flood": 4,
    "Tornado": 4,
    "Severe Storm": 3,
    "Severe Ice Storm": 3,
    "Winter Storm": 3,
    "Earthquake": 5,
    "Typhoon": 5,
    "Fire": 3,
    "Drought": 2,
    "Snowstorm": 2,
    "Landslide": 3,
    "Chemical": 4,
    "Biological": 4,
    "Dam/Levee Break": 5,
    "Coastal Storm": 3,
    "Other": 1,
}

# Suggested severity of the types a scenario may name.
SCENARIO_SEVERITY = {
    "Hurricane": 1.00,
    "Typhoon": 1.00,
    "Flood": 0.75,
    "Tornado": 0.75,
    "Biological": 0.75,
    "Severe Storm": 0.50,
    "Fire": 0.50,
    "Severe Ice Storm": 0.50,
    "Drought": 0.25,
    "Snowstorm": 0.25,
    "Other": 0.00,
}

REGION_OF_STATE = {state: region for region, states in REGION_STATES.items() for state in states.split()}


def unit_scaled(table: dict[str, float]) -> dict[str, float]:
    """Min-max the table by its own range, so the result does not depend on any data."""
    low, high = min(table.values()), max(table.values())
    return {name: (value - low) / (high - low) for name, value in table.items()}


def look_up(value: Column, table: dict, default) -> Column:
    """Value of a small constant table, or the default for unknown and null keys."""
    literal = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items()))
    return F.coalesce(F.try_element_at(literal, value), F.lit(default))


def region_of(state: Column, table: dict[str, str] = REGION_OF_STATE) -> Column:
    return look_up(state, table, OTHER_REGION)


def type_severity(kind: Column, table: dict[str, float] = INCIDENT_SEVERITY) -> Column:
    """Severity of an incident type between 0 and 1; unknown types are 0."""
    return look_up(kind, unit_scaled(table), 0.0)
