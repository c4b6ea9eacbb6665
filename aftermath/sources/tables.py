"""Reading plain Parquet and JSON datasets."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from aftermath.session import durable
from aftermath.spec import DatasetSpec, conform


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def load(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet dataset, or an empty frame of the same schema if it does not exist."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


# Exposure tables are optional inputs; an absent one contributes no rows.
STORM_SCHEMA = "disasternumber long, wind_speed double, flood_severity long, storm_event_count long"
RAIN_SCHEMA = "disasternumber long, rainfall_intensity double"


def load_dataset(spark: SparkSession, folder: str, spec: DatasetSpec) -> DataFrame:
    """A registered dataset from ``<folder>/<name>.parquet`` with its own columns and types."""
    path = f"{folder}/{spec.name}.parquet"
    if not path_exists(spark, path):
        return spark.createDataFrame([], spec.schema)
    return conform(spark.read.parquet(path), spec)


def unwrap_records(df: DataFrame) -> DataFrame:
    """Rows of the first array-of-records field of an API response.

    A response wraps its records in one field beside others that describe it.
    """
    for entry in df.schema:
        kind = entry.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return df.select(F.explode(F.col(f"`{entry.name}`")).alias("_r")).select("_r.*")
    raise ValueError(f"no list of records among fields {df.columns}")


def _records(page: str) -> Column:
    """The first list of objects of a parsed page, by name of its field, each object as a map of texts; null if there is none."""
    fields = f"map_values(try_variant_get({page}, '$', 'map<string,variant>'))"
    lists = f"filter(transform({fields}, f -> try_variant_get(f, '$', 'array<variant>')), l -> l IS NOT NULL)"
    objects = f"transform({lists}, l -> transform(l, r -> try_variant_get(r, '$', 'map<string,string>')))"
    # lists of other values give way to a list of objects, an empty list gives no rows
    return F.expr(f"coalesce(get(filter({objects}, l -> get(l, 0) IS NOT NULL), 0), get(filter({objects}, l -> size(l) = 0), 0))")


def read_landed_json(spark: SparkSession, path: str, spec: DatasetSpec, rejects: str | None = None) -> DataFrame:
    """Landed API responses of a dataset, one page a file, unwrapped and conformed.

    Pages are parsed as variants in one scan: no pass infers a schema, and the
    records of one page need not have the fields of another. Names are found
    trimmed and in any case, and only the dataset's fields are taken. A page
    that is not valid JSON, has no list of records, or has another value among
    them is an error. With ``rejects`` it is left out as a whole and named in
    that JSON folder instead, with what it holds and why; the same scan, run
    when this is called, writes rows and rejects. Pages of empty lists and
    files of no bytes have no rows.
    """
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("page"))
    pages = pages.withColumn("parsed", F.try_parse_json("page")).withColumn("records", _records("parsed"))
    reason = (
        F.when(F.col("parsed").isNull(), "not valid JSON")
        .when(F.col("records").isNull(), "no list of records")
        .when(F.exists("records", lambda r: r.isNull()), "a record is not an object")
    )
    pages = pages.select("path", "page", "records", reason.alias("reason"))
    if rejects is None:
        refused = F.raise_error(F.concat_ws(": ", F.col("path"), F.col("reason"))).cast("array<map<string,string>>")
        rows = pages.select(F.explode(F.when(F.col("reason").isNotNull(), refused).otherwise(F.col("records"))).alias("_r"))
    else:
        good = F.when(F.col("reason").isNull(), F.col("records"))
        page = F.when(F.col("reason").isNotNull(), F.col("page")).alias("page")
        read = durable(pages.select("path", page, "reason", F.explode_outer(good).alias("_r")))
        read.where("reason IS NOT NULL").select("path", "page", "reason").write.mode("append").json(rejects)
        rows = read.where("_r IS NOT NULL").select("_r")
    names = F.transform(F.map_keys("_r"), lambda k: F.lower(F.trim(k)))
    rows = rows.select(names.alias("_names"), F.map_values("_r").alias("_values"))
    found = [F.get("_values", F.array_position("_names", c.lower()).cast("int") - 1).alias(c) for c in spec.columns]
    return conform(rows.select(*found), spec)


def sizes(df: DataFrame) -> DataFrame:
    """Rows, files and megabytes behind a file-based frame, in one aggregation."""
    return (
        df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
        .groupBy("path", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count("path").alias("files"),
            F.round(F.coalesce(F.sum("size"), F.lit(0)) / (1024 * 1024), 2).alias("megabytes"),
        )
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_run(df: DataFrame, path: str, run_date: str) -> None:
    """Snapshot of one run; rerunning a date replaces that date only."""
    stamped = df.withColumn("event_timestamp", F.lit(run_date).cast("timestamp")).withColumn("run_date", F.lit(run_date))
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("run_date")
        .parquet(path)
    )
