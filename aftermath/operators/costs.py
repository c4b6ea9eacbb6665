"""Cost aggregation per disaster."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def cost_by_disaster(
    projects: DataFrame,
    key: str = "disasternumber",
    amount: str = "obligated_amount",
    category: str | None = None,
    categories: Sequence[str] = (),
    rest: str | None = None,
) -> DataFrame:
    """Sum, count, mean and maximum of the amount, plus one sum per listed category.

    Totals and category sums come from one aggregation, so the projects are
    shuffled once and partly summed before that. A null category counts in the
    totals only. ``rest`` names a column for the sum of all categories not listed.
    """
    measures = [
        F.sum(amount).alias("total_obligated_amount"),
        F.count(amount).alias("project_count"),
        F.avg(amount).alias("avg_project_cost"),
        F.max(amount).alias("max_project_cost"),
    ]
    if category is not None:
        measures += [
            F.sum(F.when(F.col(category) == name, F.col(amount)).otherwise(0.0)).alias(f"cat_cost_{name}")
            for name in categories
        ]
        if rest is not None:
            listed = F.col(category).isin(*categories) if categories else F.col(category).isNull()
            measures.append(F.sum(F.when(~listed, F.col(amount)).otherwise(0.0)).alias(rest))
    return projects.groupBy(key).agg(*measures)


def category_names(projects: DataFrame, category: str, most: int = 1000) -> list[str]:
    """The category labels present, sorted; of more than ``most`` the most frequent, ties by label.

    Sum the others with ``cost_by_disaster(rest=...)``, or take
    ``cost_by_category``, which has no limit.
    """
    counted = projects.where(F.col(category).isNotNull()).groupBy(category).count()
    return sorted(row[0] for row in counted.orderBy(F.desc("count"), F.asc(category)).limit(most).collect())


def cost_by_category(
    projects: DataFrame, key: str = "disasternumber", amount: str = "obligated_amount", category: str = "damagecategorycode"
) -> DataFrame:
    """Sum and count of the amount per disaster and category, in long form; null is a category."""
    return projects.groupBy(key, category).agg(F.sum(amount).alias("obligated_amount"), F.count(amount).alias("project_count"))


def cost_before_join(
    declarations: DataFrame,
    projects: DataFrame,
    key: str,
    amount: str,
    category: str,
) -> DataFrame:
    """Left join of declarations to per-disaster funding totals.

    Aggregating first keeps the declaration grain: the join cannot multiply rows.
    """
    funding = projects.groupBy(key).agg(
        F.sum(amount).alias("total_obligated"),
        F.count(category).alias("project_count"),
        F.count_distinct(category).alias("unique_categories"),
    )
    return declarations.join(funding, key, "left").fillna({"total_obligated": 0.0, "project_count": 0})
