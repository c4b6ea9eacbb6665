"""Model development: baseline, tuned forests and boosted trees, evaluation, registry rows."""

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from aftermath.model_inputs import DURATION_FEATURES, EARLY_FEATURES, STANDARD_FEATURES, TARGET
from aftermath.operators import cleaning, metrics
from aftermath.operators.scoring import EARLY, STANDARD
from aftermath.plans.boosting import RegularizedBoosting

# The evaluation protocol.
SEED = 42
TEST_PERCENT = 20
SEARCHES = 50
FOLDS = 5
LAST_TRAIN_YEAR = 2022

# The search spaces, in terms of the estimators available here.
FOREST_SPACE = {
    "numTrees": [100, 200, 300, 400, 500],
    "maxDepth": [5, 8, 10, 12, 15],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
}
BOOST_SPACE = {
    "maxIter": [200, 300, 400, 500, 600],
    "maxDepth": [3, 4, 5, 6, 7, 8],
    "stepSize": [0.01, 0.03, 0.05, 0.07, 0.1],
    "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "featureRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "minChildWeight": [1, 3, 5, 7],
    "gamma": [0, 0.1, 0.2, 0.3],
    "regAlpha": [0, 0.01, 0.1, 1],
    "regLambda": [0.5, 1, 1.5, 2],
}
# The configurations used without a search.
TEMPORAL_PARAMS = {
    "maxIter": 500, "maxDepth": 7, "stepSize": 0.01, "subsamplingRate": 0.7, "featureRate": 0.7, "minChildWeight": 3, "regLambda": 0.5
}
REGIME_PARAMS = {"maxIter": 500, "maxDepth": 6, "stepSize": 0.01, "subsamplingRate": 0.6, "gamma": 0.3, "regLambda": 0.5}

RUN_SCHEMA = "run string, model string, params map<string,string>, r2 double, rmse double, mae double, cv_r2 double, tags map<string,string>"


@dataclass
class Trained:
    name: str
    model: PipelineModel
    params: dict
    scores: dict
    cv_r2: float | None = None


def usable_features(df: DataFrame, version: str) -> tuple[list[str], list[str]]:
    """The version's features present in ``df``, and those missing."""
    wanted = STANDARD_FEATURES if version == STANDARD else EARLY_FEATURES
    present = [name for name in wanted if name in df.columns]
    if version == EARLY:
        refuse_duration(present)
    return present, [name for name in wanted if name not in df.columns]


def refuse_duration(features: Sequence[str]) -> None:
    """The early model must not see anything derived from the incident's duration."""
    found = sorted(set(DURATION_FEATURES) & set(features))
    if found:
        raise ValueError(f"duration-dependent features are not allowed: {found}")


def pipeline(features: Sequence[str], estimator: Estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, estimator])


def boosted(params: dict, target: str = TARGET) -> RegularizedBoosting:
    return RegularizedBoosting(featuresCol="features", labelCol=target, seed=SEED, **params)


def evaluate(model: PipelineModel, df: DataFrame, target: str = TARGET) -> dict:
    scored = model.transform(df)
    row = metrics.regression_metrics(scored, target, "prediction").head()
    return {"r2": row.r2, "rmse": row.rmse, "mae": row.mae}


def draw(space: dict[str, list], count: int, seed: int = SEED) -> list[dict]:
    """Distinct random settings from a search space, the same for the same seed."""
    chooser = random.Random(seed)
    total = math.prod(len(values) for values in space.values())
    drawn: list[dict] = []
    while len(drawn) < min(count, total):
        setting = {name: chooser.choice(values) for name, values in space.items()}
        if setting not in drawn:
            drawn.append(setting)
    return drawn


def search(
    name: str,
    estimator: Estimator,
    space: dict[str, list],
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    key: str,
    searches: int = SEARCHES,
    folds: int = FOLDS,
    parallelism: int = 4,
    target: str = TARGET,
) -> Trained:
    """Random search by cross-validated R2; folds depend on the key, not on partitioning."""
    settings = draw(space, searches)
    maps = [
        {estimator.getParam(p): v for p, v in setting.items()} for setting in settings
    ] or ParamGridBuilder().build()
    folded = train.withColumn("fold", metrics.hash_bucket(F.concat(F.col(key).cast("string"), F.lit("#fold")), folds))
    validator = CrossValidator(
        estimator=pipeline(features, estimator),
        estimatorParamMaps=maps,
        evaluator=RegressionEvaluator(labelCol=target, metricName="r2"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    fitted = validator.fit(folded)
    best = max(range(len(maps)), key=lambda i: fitted.avgMetrics[i])
    return Trained(
        name, fitted.bestModel, settings[best], evaluate(fitted.bestModel, test, target), round(float(fitted.avgMetrics[best]), 4)
    )


def develop(
    df: DataFrame,
    key: str,
    version: str = EARLY,
    searches: int = SEARCHES,
    folds: int = FOLDS,
    spaces: dict[str, dict] | None = None,
    target: str = TARGET,
) -> dict[str, Trained]:
    """Train the baseline and both tuned models on one random split."""
    spaces = spaces or {"Random Forest": FOREST_SPACE, "Boosted Trees": BOOST_SPACE}
    features, _ = usable_features(df, version)
    rows = metrics.hash_split(df.dropna(subset=[target]).select(key, target, *features), key, TEST_PERCENT)
    rows = cleaning.complete_cases(rows, features)
    train = rows.where("split = 'train'").persist()
    test = rows.where("split = 'test'").persist()
    try:
        line = pipeline(features, LinearRegression(featuresCol="features", labelCol=target)).fit(train)
        forest = RandomForestRegressor(featuresCol="features", labelCol=target, seed=SEED)
        trained = [Trained("Linear Regression", line, {"fitIntercept": True}, evaluate(line, test, target))]
        estimators = {"Random Forest": forest, "Boosted Trees": boosted({}, target)}
        for name, space in spaces.items():
            trained.append(
                search(name, estimators[name], space, train, test, features, key, searches, folds, target=target)
            )
    finally:
        train.unpersist()
        test.unpersist()
    return {entry.name: entry for entry in trained}


def best(trained: dict[str, Trained]) -> Trained:
    return max(trained.values(), key=lambda entry: entry.scores["r2"])


def registry_rows(spark: SparkSession, trained: dict[str, Trained], version: str) -> DataFrame:
    """One row per trained model for the ``runs`` table."""
    tags = {"model_version": version, "duration_feature": "excluded" if version == EARLY else "included"}
    rows = [
        (
            f"{version}_{entry.name}",
            entry.name,
            {k: str(v) for k, v in entry.params.items()},
            entry.scores["r2"],
            entry.scores["rmse"],
            entry.scores["mae"],
            entry.cv_r2,
            {**tags, "tuning": "none" if entry.cv_r2 is None else "random search"},
        )
        for entry in trained.values()
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def record_runs(runs: DataFrame, path: str) -> None:
    runs.coalesce(1).write.mode("append").parquet(path)


def temporal_evaluation(
    df: DataFrame,
    version: str = EARLY,
    last_train_year: int = LAST_TRAIN_YEAR,
    params: dict | None = None,
    target: str = TARGET,
) -> dict:
    """Fit on the years up to the limit, score the later ones."""
    features, _ = usable_features(df, version)
    rows = metrics.year_split(df, "declaration_year", last_train_year).dropna(subset=[target, *features])
    rows = rows.select("split", "declaration_year", target, *[f for f in features if f != "declaration_year"]).persist()
    try:
        report = {r.split: r.asDict() for r in metrics.split_report(rows, "declaration_year").collect()}
        model = pipeline(features, boosted(params or TEMPORAL_PARAMS, target)).fit(rows.where("split = 'train'"))
        scores = evaluate(model, rows.where("split = 'test'"), target)
    finally:
        rows.unpersist()
    return {"periods": report, "features": features, **scores}


def regime_evaluation(
    df: DataFrame, key: str, kind: str = "incidenttype", excluded: str = "Biological", params: dict | None = None, target: str = TARGET
) -> DataFrame:
    """The same model fitted and tested on all disasters and without one type."""
    features, _ = usable_features(df, STANDARD)
    results = []
    regimes = {"All Disasters": df, f"Non-{excluded} Disasters": cleaning.exclude_kind(df, kind, excluded)}
    for name, regime in regimes.items():
        complete = cleaning.complete_cases(regime.select(key, target, *features), [*features, target])
        rows = metrics.hash_split(complete, key, TEST_PERCENT).persist()
        sizes = {r.split: r.n for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
        model = pipeline(features, boosted(params or REGIME_PARAMS, target)).fit(rows.where("split = 'train'"))
        scores = evaluate(model, rows.where("split = 'test'"), target)
        rows.unpersist()
        train, test = sizes.get("train", 0), sizes.get("test", 0)
        results.append((name, train + test, train, test, scores["r2"], scores["rmse"], scores["mae"]))
    return df.sparkSession.createDataFrame(
        results, "regime string, samples long, train long, test long, r2 double, rmse double, mae double"
    )
