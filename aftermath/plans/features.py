"""The feature table job: raw tables and exposures in, one row per (disaster, state) out."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from aftermath.functions import dates, lookups
from aftermath.model_inputs import TARGET
from aftermath.operators import cleaning, costs, features
from aftermath.session import durable

KEY = "disasternumber"


def engineer(
    declarations: DataFrame,
    cost: DataFrame,
    summaries: DataFrame,
    climate: DataFrame,
    labels: Sequence[str] | None = None,
    regions: dict[str, str] = lookups.REGION_OF_STATE,
    severity: dict[str, float] = lookups.INCIDENT_SEVERITY,
) -> DataFrame:
    """Features and target from cleaned inputs.

    The exposures are joined before the prior-event count, whose written result
    then serves the scaling bounds, the frequent types and the final table, so
    the joins below it run once.
    """
    timed = features.incident_times(declarations, "declarationdate", "incidentbegindate", "incidentenddate")
    exposed = features.attach_climate(timed, climate, KEY)
    counted = features.prior_events(exposed, "state", "declarationdate", KEY)

    if labels is None:
        labels = [row[0] for row in features.top_labels(counted, "incidenttype", features.TOP_TYPES).collect()]
    measured = [c for c in features.CLIMATE_COLUMNS if c in counted.columns]
    table = dates.calendar_parts(counted, "declarationdate")
    table = table.withColumn("region", lookups.region_of(F.col("state"), regions))
    table = features.blend_severity(
        table,
        lookups.type_severity(F.col("incidenttype"), severity),
        measured,
        features.scaling_bounds(counted, measured) if measured else None,
    )
    table = features.interactions(features.one_hot(table, "incidenttype", labels))

    # Rows without a cost are dropped in the end, so the join is an inner one. The
    # per-disaster costs serve this join and the region codes, hence are written once.
    cost = durable(cost.where(F.col("total_obligated_amount").isNotNull()))
    table = table.join(cost, KEY)
    if "summary_total_obligations" in summaries.columns:
        table = table.join(summaries, KEY, "left")
        table = features.with_discrepancy(table, "total_obligated_amount", "summary_total_obligations")
    table = table.withColumn(TARGET, F.log1p("total_obligated_amount"))
    # Codes count the regions present, as a categorical does; the region table is
    # fixed and the rows are already written, so reading them off the states is cheap.
    present = counted.join(cost.select(KEY), KEY, "left_semi").select(
        lookups.region_of(F.col("state"), regions).alias("region")
    )
    names = present.agg(F.array_sort(F.collect_set("region"))).scalar()
    return table.withColumn("region_encoded", (F.array_position(names, F.col("region")) - 1).cast("int"))


def build(
    declarations: DataFrame,
    projects: DataFrame,
    summaries: DataFrame,
    climate: DataFrame,
    category: str | None = "damagecategorycode",
) -> DataFrame:
    """Clean the raw tables and engineer the features."""
    usable = cleaning.clean_projects(projects)
    if category in usable.columns:
        cost = costs.cost_by_disaster(
            usable, category=category, categories=costs.category_names(usable, category), rest="cat_cost_other"
        )
    else:
        cost = costs.cost_by_disaster(usable)
    return engineer(
        cleaning.clean_declarations(declarations), cost, cleaning.clean_summaries(summaries), climate
    )
