"""The streaming ingest: validation, routing, replay and retry."""

import json

import pytest
from pyspark.sql import functions as F

from aftermath.plans.ingest import store_of
from aftermath.spec import DECLARATIONS, DISASTER_SUMMARIES
from aftermath.streaming import envelope, ingest


def sent(dataset, payload, at="2024-01-01T00:00:00Z"):
    return json.dumps({"schema_version": "3.0", "dataset": dataset, "ingested_at": at, "payload": payload})


def summary(number, refresh, amount, at="2024-01-01T00:00:00Z"):
    return sent("disaster_summaries", {"disasterNumber": number, "lastRefresh": refresh, "totalObligatedAmountPa": amount}, at)


GOOD = [
    summary(1, "2024-01-01", 10.0),
    summary("2", "2024-01-01", "20.5"),
    summary(1, "2024-02-01", 11.0),
    summary(1, "2024-01-15", 99.0),
    summary(3, "2024-01-01", 1.0, at="2024-01-02T00:00:00Z"),
    summary(3, "2024-01-01", 2.0, at="2024-01-01T00:00:00Z"),
    sent("declarations", {"id": "a", "disasterNumber": 1, "state": "TX", "lastRefresh": "2024-01-01"}),
]
BAD = ["[1]", "{broken", "7", json.dumps({"payload": {}}), sent("other", {}), sent("declarations", "{text"), sent("declarations", None), sent("", {})]


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.tmp").write_text("\n".join(lines) + "\n")
    (folder / f"{name}.tmp").rename(folder / f"{name}.json")


def drain(spark, source, root, checkpoint):
    query = ingest.run(ingest.envelopes(spark, str(source), files_per_batch=1), str(root), str(checkpoint), buckets=2)
    query.awaitTermination()
    assert query.exception() is None
    return query


def summaries(spark, root):
    rows = store_of(spark, str(root), DISASTER_SUMMARIES).read().collect()
    return {r.disasterNumber: (r.lastRefresh, r.totalObligatedAmountPa) for r in rows}


EXPECTED = {1: ("2024-02-01", 11.0), 2: ("2024-01-01", 20.5), 3: ("2024-01-01", 1.0)}


def test_stream_routes_validates_and_resumes(spark, tmp_path):
    source, root, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    write(source, "a", GOOD[:3] + BAD)
    write(source, "b", GOOD[3:])
    drain(spark, source, root, checkpoint)
    assert summaries(spark, root) == EXPECTED
    assert store_of(spark, str(root), DECLARATIONS).read().count() == 1
    quarantined = spark.read.json(str(root / "quarantine"))
    assert quarantined.count() == len(BAD)
    metrics = ingest.run_metrics(spark, str(root)).agg(F.sum("records").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("m")).head()
    assert (metrics.n, metrics.bad, metrics.m) == (len(GOOD) + len(BAD), len(BAD), 2)

    write(source, "c", [summary(2, "2024-05-01", 7.0)])
    drain(spark, source, root, checkpoint)
    assert summaries(spark, root)[2] == ("2024-05-01", 7.0)

    # A lost checkpoint replays everything: nothing is doubled and nothing regresses.
    before = store_of(spark, str(root), DISASTER_SUMMARIES).log.snapshot().version
    drain(spark, source, root, tmp_path / "fresh")
    assert summaries(spark, root) == {**EXPECTED, 2: ("2024-05-01", 7.0)}
    assert store_of(spark, str(root), DISASTER_SUMMARIES).log.snapshot().version == before


def test_crash_between_store_and_checkpoint_is_repaired_by_the_retry(spark, tmp_path, monkeypatch):
    source, root, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    write(source, "a", GOOD)
    honest = ingest.apply_batch

    def failing(*args):
        step = honest(*args)

        def run(batch, batch_id):
            step(batch, batch_id)
            raise RuntimeError("lost after the write")

        return run

    monkeypatch.setattr(ingest, "apply_batch", failing)
    query = ingest.run(ingest.envelopes(spark, str(source)), str(root), str(checkpoint), buckets=2)
    with pytest.raises(Exception, match="lost after the write"):
        query.awaitTermination()
    monkeypatch.setattr(ingest, "apply_batch", honest)
    first = ingest.run_metrics(spark, str(root)).head()
    drain(spark, source, root, checkpoint)
    assert summaries(spark, root) == EXPECTED
    again = ingest.run_metrics(spark, str(root)).collect()
    assert len(again) == 1 and first.new == 4
    assert all(again[0][name] == first[name] for name in (*ingest.OUTCOMES, "records", "bad"))


def test_batch_and_stream_give_the_same_table(spark, tmp_path):
    text = spark.createDataFrame([(line,) for line in GOOD], "value string")
    rows = envelope.records(envelope.validate(text), DISASTER_SUMMARIES, ["ingested_at"])
    store = store_of(spark, str(tmp_path), DISASTER_SUMMARIES, 2)
    store.upsert(rows, arrival="ingested_at")
    assert summaries(spark, tmp_path) == EXPECTED


def test_reasons(spark):
    judged = envelope.validate(spark.createDataFrame([(line,) for line in BAD + GOOD[:1] + [None]], "value string"))
    assert [r.reason for r in judged.collect()] == [
        "not an object", "not an object", "not an object", "missing dataset", "unknown dataset",
        "payload is not an object", "payload is not an object", "missing dataset", None, "not an object",
    ]


def test_wrap_has_the_four_fields(spark):
    row = envelope.wrap(spark.createDataFrame([(1, None)], "a int, b string"), "declarations", ["a", "b"]).head()
    assert set(json.loads(row.value)) == {"schema_version", "dataset", "ingested_at", "payload"}
