"""Dataset registry and schema conformance."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from aftermath.functions.text import key_number


@dataclass(frozen=True)
class DatasetSpec:
    """Key, cursor and typed columns of one keyed, incrementally refreshed dataset."""

    name: str
    key: str
    cursor: str
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _schema(text: str) -> T.StructType:
    fields = (entry.split() for entry in text.replace("\n", " ").split(","))
    kinds = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType()}
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in fields])


# Column names, keys and cursors of the three public tables.
DECLARATIONS = DatasetSpec(
    "declarations",
    "id",
    "lastRefresh",
    _schema("""
        id string, hash string, disasterNumber long, state string, incidentType string,
        declarationDate string, incidentBeginDate string, incidentEndDate string,
        declarationType string, fipsStateCode string, fipsCountyCode string, lastRefresh string
    """),
)
PUBLIC_ASSISTANCE = DatasetSpec(
    "public_assistance",
    "gmProjectId",
    "lastRefresh",
    _schema("""
        disasterNumber long, declarationDate string, incidentType string, pwNumber string,
        applicationTitle string, applicantId string, damageCategoryCode string,
        damageCategoryDescrip string, projectStatus string, projectProcessStep string,
        projectSize string, county string, countyCode string, stateAbbreviation string,
        stateNumberCode string, projectAmount double, federalShareObligated double,
        totalObligated double, lastObligationDate string, firstObligationDate string,
        mitigationAmount double, gmProjectId long, gmApplicantId string, lastRefresh string,
        hash string
    """),
)
DISASTER_SUMMARIES = DatasetSpec(
    "disaster_summaries",
    "disasterNumber",
    "lastRefresh",
    _schema("""
        disasterNumber long, totalNumberIaApproved long, totalAmountIhpApproved double,
        totalAmountHaApproved double, totalAmountOnaApproved double,
        totalObligatedAmountPa double, totalObligatedAmountCatAb double,
        totalObligatedAmountCatC2g double, totalObligatedAmountHmgp double,
        paLoadDate string, iaLoadDate string, hash string, lastRefresh string, id string
    """),
)

REGISTRY = {spec.name: spec for spec in (DECLARATIONS, PUBLIC_ASSISTANCE, DISASTER_SUMMARIES)}


def dataset(name: str) -> DatasetSpec:
    if name not in REGISTRY:
        raise ValueError(f"unknown dataset '{name}', expected one of {sorted(REGISTRY)}")
    return REGISTRY[name]


def conform(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Project ``df`` onto the dataset's columns and types."""
    return df.select(*conform_columns(df, spec))


def conform_columns(df: DataFrame, spec: DatasetSpec) -> list[Column]:
    """The dataset's columns as expressions over ``df``.

    Columns are found by trimmed, case-insensitive name; absent ones become
    null, values that do not parse become null, and NaN becomes null so that
    aggregates skip it.
    """
    found = {name.strip().lower(): name for name in df.columns}
    columns = []
    for target in spec.schema:
        source = found.get(target.name.lower())
        if source is None:
            column = F.lit(None).cast(target.dataType)
        else:
            column = F.col(f"`{source}`")
            if isinstance(target.dataType, T.LongType) and isinstance(df.schema[source].dataType, T.StringType):
                column = key_number(column)
            else:
                column = column.try_cast(target.dataType)
            if isinstance(target.dataType, T.DoubleType):
                column = F.nanvl(column, F.lit(None).cast("double"))
        columns.append(column.alias(target.name))
    return columns


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lower() for name in df.columns])


def first_present(df: DataFrame, candidates: list[str]) -> str:
    """The first candidate that is a column of ``df``; an error names what is there."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(candidates)} among columns {df.columns}")


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    """Column names grouped as categorical, numeric and date, by data type."""
    kinds: dict[str, list[str]] = {"categorical": [], "numeric": [], "date": []}
    for entry in df.schema:
        if isinstance(entry.dataType, T.NumericType):
            kinds["numeric"].append(entry.name)
        elif isinstance(entry.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kinds["date"].append(entry.name)
        elif isinstance(entry.dataType, T.StringType):
            kinds["categorical"].append(entry.name)
    return kinds
