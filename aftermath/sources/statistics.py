"""What is known of written rows without opening them: digests, ranges of key and cursor, and key bitmaps."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A key sets one of PARTS * 32,768 bits; a bitmap function holds 32,768 of them.
PARTS, BITS = 8, 32_768


def _plain(kind: T.DataType) -> bool:
    """Whether Spark hashes values of the type; it refuses maps and variants."""
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_plain(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def digest(schema: T.StructType) -> Column:
    """An aggregate that equal rows share in whatever order: their count and two sums of row hashes.

    A null adds nothing to a row's hash, so a column without values does not
    matter, nor does the order of columns. Null if a column cannot be hashed.
    Equal digests of different rows are as rare as a collision of 128 bits.
    """
    if not all(_plain(f.dataType) for f in schema):
        return F.lit(None).cast("string")
    named = []
    for name in sorted(schema.names):
        value = F.col(f"`{name}`")
        named += [F.when(value.isNotNull(), F.lit(name)), value]
    # sums of up to 10^18 rows fit
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *named).cast("decimal(20,0)"))
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), total("one").cast("string"), total("two").cast("string"))


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("bit"), F.col(key)), F.lit(PARTS * BITS)) + 1


def key_bitmaps(rows: DataFrame, key: str, *measures: Column) -> DataFrame:
    """(bucket, part, keys, key_low, key_high, measures) of rows with a ``bucket``: at most ``PARTS`` rows of 4 kB a bucket."""
    return rows.groupBy("bucket", F.bitmap_bucket_number(_bit(key)).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_bit(key))).alias("keys"),
        F.min(key).alias("key_low"),
        F.max(key).alias("key_high"),
        *measures,
    )


def write(rows: DataFrame, path: str, key: str, cursor: str) -> None:
    """Write the statistics of one folder of the store."""
    found = key_bitmaps(rows, key, F.count(F.lit(1)).alias("rows"), F.min(cursor).alias("cursor_low"), F.max(cursor).alias("cursor_high"))
    found.coalesce(1).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, root: str, folders: list[str], layout: T.StructType, key: str, cursor: str) -> DataFrame:
    """The statistics of folders, with the name of the ``folder`` of each row."""
    shape = T.StructType()
    for name, kind in (("bucket", T.IntegerType()), ("part", T.LongType()), ("keys", T.BinaryType())):
        shape.add(name, kind)
    for name, column in (("key", key), ("cursor", cursor)):
        shape.add(f"{name}_low", layout[column].dataType).add(f"{name}_high", layout[column].dataType)
    shape.add("rows", T.LongType())
    rows = spark.read.schema(shape).parquet(*(f"{root}/{folder}" for folder in folders))
    return rows.withColumn("folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def meeting(stored: DataFrame, sought: DataFrame) -> DataFrame:
    """(bucket, folder) of the files that may hold one of the keys of ``sought``, made by ``key_bitmaps``.

    No file with such a key is left out. One without may be named, by equal bits.
    """
    one, other = stored.alias("a"), sought.alias("b")
    near = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.part") == F.col("b.part"))
    near &= (F.col("a.key_low") <= F.col("b.key_high")) & (F.col("b.key_low") <= F.col("a.key_high"))
    both = one.join(other, near).select("a.bucket", "a.folder", "a.part", F.explode(F.array("a.keys", "b.keys")).alias("keys"))
    common = both.groupBy("bucket", "folder", "part").agg(F.bitmap_count(F.bitmap_and_agg("keys")).alias("n"))
    return common.where("n > 0").select("bucket", "folder").distinct()


def reaching(stored: DataFrame, time) -> DataFrame:
    """(bucket, folder) of the files with a cursor of ``time`` or later."""
    return stored.where(F.col("cursor_high") >= F.lit(time)).select("bucket", "folder").distinct()

