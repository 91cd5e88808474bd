"""A stream takes up new models between its batches, after their age, and names them in its rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadtally.ml.training import save, train
from roadtally.streaming.jobs import replay_files
from roadtally.streaming.scores import NewestModel, start_scores
from tests import micro
from tests.test_ml import data
from tests.test_streaming import messages


@pytest.fixture(scope="module")
def models(spark):
    return [train(*data(spark), seed=seed) for seed in (1, 2)]


def test_a_newer_model_is_taken_up_after_its_age(spark, tmp_path, models):
    now = [0.0]
    newest = NewestModel(spark, f"{tmp_path}/m", max_age=300, clock=lambda: now[0])
    with pytest.raises((PySparkException, FileNotFoundError)):
        newest.current()
    versions = []
    for at, model in ((0, models[0]), (100, models[1]), (250, None), (300, None)):
        if model:
            save(model, f"{tmp_path}/m")
        now[0] = at
        versions.append(newest.current()[1]["version"])
    first, second = (m.metadata.first()["version"] for m in models)
    assert versions == [first, first, first, second]
    same = newest.current()[0]
    now[0] = 900
    assert newest.current()[0] is same  # looked up again, not loaded again


def test_rows_name_their_model(spark, tmp_path, models):
    source = NewestModel(spark, f"{tmp_path}/m", max_age=0)
    for hour, model in enumerate(models):
        save(model, f"{tmp_path}/m")
        sent = messages(micro.vehicles(spark), "vehicles", hour)
        sent.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        start_scores(replay_files(spark, f"{tmp_path}/in"), source, f"{tmp_path}/out", f"{tmp_path}/c", True).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out")
    counted = {r["model_version"]: r["count"] for r in rows.groupBy("model_version").count().collect()}
    n = micro.vehicles(spark).count()
    assert counted == {m.metadata.first()["version"]: n for m in models}
    assert rows.groupBy("batch_id").agg(F.count_distinct("model_version").alias("n")).where("n <> 1").count() == 0
