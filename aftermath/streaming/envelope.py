"""The event envelope around a record: build, parse, validate."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aftermath.spec import REGISTRY, DatasetSpec, conform_columns

# Fixed value: version written into new envelopes.
SCHEMA_VERSION = "3.0"

ENVELOPE_SHAPE = "dataset string, ingested_at string, payload variant, _corrupt_record string"
NOT_AN_OBJECT = "not an object"
MISSING_DATASET = "missing dataset"
UNKNOWN_DATASET = "unknown dataset"
INVALID_PAYLOAD = "payload is not an object"


def wrap(df: DataFrame, dataset: str | Column, columns: Sequence[str], ingested_at: Column | None = None) -> DataFrame:
    """One JSON envelope per row, as column ``value``."""
    name = dataset if isinstance(dataset, Column) else F.lit(dataset)
    moment = ingested_at if ingested_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    return df.select(
        F.to_json(
            F.struct(
                F.lit(SCHEMA_VERSION).alias("schema_version"),
                name.alias("dataset"),
                moment.alias("ingested_at"),
                F.struct(*columns).alias("payload"),
            )
        ).alias("value")
    )


def validate(df: DataFrame, value: str = "value", known: Sequence[str] = tuple(REGISTRY)) -> DataFrame:
    """Add dataset, ingested_at, payload (a variant) and the reason an envelope is refused (null if good).

    Keep the result (persist or write it) when it is filtered more than once:
    a filter on a column computed here parses the text again.
    """
    opened = df.withColumn("_e", F.from_json(value, ENVELOPE_SHAPE))
    # Text that parses and begins with a brace is an object.
    is_object = F.col(value).rlike(r"^\s*\{") & F.col("_e._corrupt_record").isNull()
    reason = (
        F.when(~F.coalesce(is_object, F.lit(False)), NOT_AN_OBJECT)
        .when(F.coalesce("_e.dataset", F.lit("")) == "", MISSING_DATASET)
        .when(~F.col("_e.dataset").isin(*known), UNKNOWN_DATASET)
        .when(~F.coalesce(F.schema_of_variant("_e.payload").startswith("OBJECT"), F.lit(False)), INVALID_PAYLOAD)
    )
    return opened.select(*df.columns, "_e.dataset", "_e.ingested_at", "_e.payload", reason.alias("reason"))


def records(validated: DataFrame, spec: DatasetSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Typed records of one dataset from accepted envelopes.

    Fields are cast leniently: a number sent as text is still a number, and a
    field of another type is null.
    """
    mine = validated.where(F.col("reason").isNull() & (F.col("dataset") == spec.name))
    fields = [
        F.try_variant_get("payload", f"$.{name}", "string").alias(name) for name in spec.columns
    ]
    texts = mine.select(*fields, *extra)
    return texts.select(*conform_columns(texts, spec), *extra)
