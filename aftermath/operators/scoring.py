"""Scenario validation, scoring and budget gaps."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aftermath.functions import dates, lookups
from aftermath.functions.text import numeric, slug
from aftermath.model_inputs import DURATION_FEATURES, TYPE_FLAGS

STANDARD, EARLY = "A", "B"

# Allowed range of each scenario field, the flags' range and default,
# the names the answer carries, and the budget levels shown.
FIELD_RANGES = {
    "region_encoded": (0, 4),
    "incident_duration_days": (0, None),
    "days_to_declaration": (0, None),
    "state_disaster_frequency": (0, None),
    "incident_severity_score": (0, 1),
    "declaration_year": (1950, 2100),
    "declaration_month": (1, 12),
    "declaration_quarter": (1, 4),
}
WHOLE_FIELDS = ("region_encoded", "declaration_year", "declaration_month", "declaration_quarter", *TYPE_FLAGS)
MODEL_TYPES = {STANDARD: "Model A — Standard Forecast", EARLY: "Model B — Early Forecast"}
FORECAST_TYPES = {STANDARD: "Standard Forecast", EARLY: "Early Forecast"}
FORECAST_MODES = {STANDARD: "scenario", EARLY: "early_forecast"}
BUDGET_LEVELS = (0.5, 0.7, 0.9, 1.0, 1.1, 1.3)


def chosen_version(requested: Column, default: str = EARLY) -> Column:
    """The requested model version, trimmed and upper-cased; the default if none is given."""
    return F.coalesce(F.nullif(F.upper(F.trim(requested)), F.lit("")), F.lit(default.strip().upper()))


def validate_scenarios(df: DataFrame, fields: str = "fields", version: str = "version", default: str = EARLY) -> DataFrame:
    """Add the chosen ``model`` and the ``errors`` of each scenario.

    ``fields`` is a map of field name to text as it was sent, so that missing,
    unknown and unreadable fields can be told apart. A scenario without errors
    has an empty list.
    """
    model = chosen_version(F.col(version), default)
    sent = F.col(fields)
    known = F.array(*[F.lit(name) for name in (*FIELD_RANGES, *TYPE_FLAGS)])
    forbidden = F.array(*[F.lit(name) for name in DURATION_FEATURES])
    has_forbidden = F.arrays_overlap(F.map_keys(sent), forbidden)
    problems = [
        F.when(~model.isin(STANDARD, EARLY), F.lit("invalid version")),
        F.when((model == EARLY) & has_forbidden, F.lit("duration not accepted")),
        F.when(F.size(F.array_except(F.array_except(F.map_keys(sent), known), forbidden)) > 0, F.lit("unknown field")),
        F.when(
            (model == STANDARD)
            & F.arrays_overlap(F.map_keys(sent), F.array(*[F.lit(n) for n in DURATION_FEATURES if n not in FIELD_RANGES])),
            F.lit("unknown field"),
        ),
    ]
    for name in (*FIELD_RANGES, *TYPE_FLAGS):
        low, high = FIELD_RANGES.get(name, (0, 1))
        text = F.try_element_at(sent, F.lit(name))
        number = numeric(text)
        bad = number.isNull() | (number < low)
        if high is not None:
            bad = bad | (number > high)
        if name in WHOLE_FIELDS:
            bad = bad | (number != F.floor(number))
        required = name not in TYPE_FLAGS
        applies = (model == STANDARD) if name in DURATION_FEATURES else F.lit(True)
        if required:
            problems.append(F.when(applies & text.isNull(), F.lit(f"missing {name}")))
        problems.append(F.when(applies & text.isNotNull() & bad, F.lit(f"invalid {name}")))
    return df.withColumns({"model": model, "errors": F.array_distinct(F.array_compact(F.array(*problems)))})


def open_scenarios(df: DataFrame, fields: str = "fields") -> DataFrame:
    """Accepted scenarios with one typed column per field; flags not sent are 0."""
    sent = F.col(fields)
    columns = {}
    for name in (*FIELD_RANGES, *TYPE_FLAGS):
        number = numeric(F.try_element_at(sent, F.lit(name)))
        if name in TYPE_FLAGS:
            number = F.coalesce(number, F.lit(0.0))
        columns[name] = number.cast("int") if name in WHOLE_FIELDS else number
    return df.where(F.size("errors") == 0).withColumns(columns)


def derive_inputs(df: DataFrame) -> DataFrame:
    """Cyclic and interaction features from the scenario's fields."""
    severity, frequency = F.col("incident_severity_score"), F.col("state_disaster_frequency")
    duration = F.col("incident_duration_days")
    placed = dates.on_circle(dates.on_circle(df, "declaration_month", 12), "declaration_quarter", 4)
    return placed.withColumns(
        {
            "severity_x_duration": severity * duration,
            "severity_x_frequency": severity * frequency,
            "duration_x_days_to_declaration": duration * F.col("days_to_declaration"),
        }
    )


def scenario_fields(month: Column, kinds: Column) -> dict[str, Column]:
    """Quarter of the month and one 0/1 flag per scenario type from a list of chosen types."""
    labels = [label for label in lookups.SCENARIO_SEVERITY if f"is_{slug(label)}" in TYPE_FLAGS]
    flags = {f"is_{slug(label)}": F.array_contains(kinds, label).cast("int") for label in labels}
    return {"declaration_quarter": F.floor((month - 1) / 3 + 1).cast("int"), **flags}


def suggested_severity(df: DataFrame, kinds: str, name: str = "suggested_severity") -> DataFrame:
    """Mean baseline severity of the chosen types, 0 for none; unknown types count as 0."""
    scores = F.transform(kinds, lambda kind: lookups.look_up(kind, lookups.SCENARIO_SEVERITY, 0.0))
    total = F.aggregate(scores, F.lit(0.0), lambda made, score: made + score)
    return df.withColumn(name, F.coalesce(F.try_divide(total, F.size(kinds)), F.lit(0.0)))


def linear_prediction(coefficients: dict[str, float], intercept: float) -> Column:
    """A linear model's log-cost as a column expression."""
    return sum((F.col(name) * F.lit(weight) for name, weight in coefficients.items()), F.lit(intercept))


def _by_model(labels: dict[str, str]) -> Column:
    return F.when(F.col("model") == STANDARD, labels[STANDARD]).otherwise(labels[EARLY])


def forecast(df: DataFrame, log_prediction: str) -> DataFrame:
    """Answer columns of a scored scenario: cost in dollars and labels of the model used."""
    return df.withColumns(
        {
            "predicted_recovery_cost_usd": F.round(F.expm1(log_prediction), 2),
            "log_prediction": F.round(log_prediction, 4),
            "model_type": _by_model(MODEL_TYPES),
            "forecast_type": _by_model(FORECAST_TYPES),
            "forecast_mode": _by_model(FORECAST_MODES),
        }
    )


def budget_gaps(df: DataFrame, cost: str, levels: Sequence[float] = BUDGET_LEVELS) -> DataFrame:
    """One row per scenario and budget level with the surplus or shortfall."""
    level = F.explode(F.array(*[F.lit(float(x)) for x in levels]))
    return df.withColumn("allocation", level).withColumns(
        {
            "budget_allocation": F.concat(F.round(F.col("allocation") * 100).cast("int").cast("string"), F.lit("%")),
            "gap_usd": F.col(cost) * F.col("allocation") - F.col(cost),
        }
    )
