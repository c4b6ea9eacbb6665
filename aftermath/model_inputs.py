"""Names of the model inputs and the target."""

# The ten incident flags a scenario may set.
TYPE_FLAGS = (
    "is_fire",
    "is_severe_storm",
    "is_flood",
    "is_hurricane",
    "is_tornado",
    "is_snowstorm",
    "is_biological",
    "is_severe_ice_storm",
    "is_typhoon",
    "is_drought",
)

# Model inputs with and without the incident's duration, and the target.
DURATION_FEATURES = ("incident_duration_days", "severity_x_duration", "duration_x_days_to_declaration")
STANDARD_FEATURES = (
    "region_encoded",
    "incident_duration_days",
    "days_to_declaration",
    "state_disaster_frequency",
    "incident_severity_score",
    "declaration_year",
    "declaration_month_sin",
    "declaration_month_cos",
    "declaration_quarter_sin",
    "declaration_quarter_cos",
    "severity_x_duration",
    "severity_x_frequency",
    "duration_x_days_to_declaration",
    *TYPE_FLAGS,
)
EARLY_FEATURES = tuple(name for name in STANDARD_FEATURES if name not in DURATION_FEATURES)
TARGET = "log_total_obligated_amount"
