"""Batch scoring of scenario requests with fitted models."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from aftermath.operators import scoring


def score_requests(
    requests: DataFrame, models: dict[str, PipelineModel], fields: str = "fields", version: str = "version"
) -> tuple[DataFrame, DataFrame]:
    """Forecasts of the acceptable requests, and the refused ones with their errors.

    ``models`` maps a version to its fitted pipeline. ``requests`` should be a
    stored table: each check looks into the map of fields again.
    """
    judged = scoring.validate_scenarios(requests, fields, version)
    inputs = scoring.derive_inputs(scoring.open_scenarios(judged, fields))
    answers = None
    for name, model in models.items():
        mine = model.transform(inputs.where(F.col("model") == name))
        scored = scoring.forecast(mine.withColumnRenamed("prediction", "_log"), "_log").drop("_log", "features")
        answers = scored if answers is None else answers.unionByName(scored, allowMissingColumns=True)
    return answers, judged.where(F.size("errors") > 0)
