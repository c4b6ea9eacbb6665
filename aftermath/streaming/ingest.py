"""The streaming ingest: envelopes in, keyed stores out."""

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aftermath.plans.ingest import store_of
from aftermath.sources.tables import path_exists
from aftermath.spec import REGISTRY
from aftermath.streaming import envelope

OUTCOMES = ("new", "updated", "unchanged", "stale", "duplicates", "without_key")
METRICS = "started_at timestamp, duration_ms long, records long, bad long, " + ", ".join(f"{x} long" for x in OUTCOMES)


def envelopes(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A folder of JSON-lines files, one envelope per line, as a stream."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def kafka_envelopes(spark: SparkSession, servers: str, topic: str, records_per_batch: int = 1_000_000) -> DataFrame:
    """A topic from its earliest record; needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", records_per_batch)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def apply_batch(root: str, buckets: int = 64, stream: str | None = None):
    """The foreachBatch step: validate, set bad envelopes aside, upsert each dataset, write the counts.

    Offsets are committed by Spark after this step returns. A retry repeats the
    step with the same rows: the quarantine folder of the batch is overwritten
    with the same content. ``stream`` names the stream: a dataset then knows the
    batch by its number, leaves the rows alone and gives the counts of the first
    try, so its metrics are those of a run without the failure. Without a name
    the rows of the first try are found unchanged.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        began, reports = time.time(), []
        judged = envelope.validate(batch).persist()
        try:
            counts = {
                (row.dataset if row.reason is None else None): row.n
                for row in judged.groupBy(
                    F.when(F.col("reason").isNull(), F.col("dataset")).alias("dataset"),
                    F.when(F.col("reason").isNotNull(), F.lit("bad")).alias("reason"),
                )
                .agg(F.count(F.lit(1)).alias("n"))
                .collect()
            }
            if None in counts:
                judged.where(F.col("reason").isNotNull()).select("value", "reason").write.mode("overwrite").json(
                    f"{root}/quarantine/batch={batch_id}"
                )
            known = None if stream is None else (stream, batch_id)
            for name, spec in REGISTRY.items():
                if name in counts:
                    rows = envelope.records(judged, spec, ["ingested_at"])
                    reports.append(store_of(spark, root, spec, buckets).upsert(rows, arrival="ingested_at", batch=known))
            told = [sum(report[x] for report in reports) for x in OUTCOMES]
            spent = int((time.time() - began) * 1000)
            row = spark.range(1).select(
                *(
                    F.lit(value).cast(kind.split()[1]).alias(kind.split()[0])
                    for kind, value in zip(METRICS.split(", "), [began, spent, sum(counts.values()), counts.get(None, 0), *told])
                )
            )
            row.write.mode("overwrite").json(f"{root}/metrics/batch={batch_id}")
        finally:
            judged.unpersist()

    return step


def run(stream: DataFrame, root: str, checkpoint: str, buckets: int = 64, until_drained: bool = True) -> StreamingQuery:
    """Start the ingest; by default it stops when the available input is consumed."""
    writer = stream.writeStream.foreachBatch(apply_batch(root, buckets, checkpoint)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_drained else writer).start()


def run_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row for each micro-batch ever finished under ``root``: counts by outcome, bad envelopes, time and rate."""
    if not path_exists(spark, f"{root}/metrics"):
        rows = spark.createDataFrame([], f"{METRICS}, batch long")
    else:
        rows = spark.read.schema(f"{METRICS}, batch long").json(f"{root}/metrics")
    rate = F.try_divide(F.col("records") * 1000.0, F.col("duration_ms"))
    return rows.withColumnRenamed("batch", "batch_id").withColumn("records_per_second", rate)
