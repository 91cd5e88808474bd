"""Scoring a stream of vehicles with the newest model, which is taken up between micro-batches."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadtally.ml.frame import FEATURES
from roadtally.ml.scoring import load_version, newest_version, score
from roadtally.schemas import KEY_COLUMN
from roadtally.sources.envelope import decode
from roadtally.streaming.jobs import start

# Fixed value: seconds after which a newer model is looked for.
MODEL_AGE = 300


class NewestModel:
    """The newest complete version below a folder; looked up again once ``max_age`` seconds have passed."""

    def __init__(self, spark: SparkSession, root: str, max_age: float = MODEL_AGE, clock: Callable[[], float] = time.monotonic):
        self.spark = spark
        self.root = root
        self.max_age = max_age
        self.clock = clock
        self._looked_up: float | None = None
        self._model: tuple[PipelineModel, Row] | None = None

    def current(self) -> tuple[PipelineModel, Row]:
        """Pipeline and metadata; files of a model are read only where its version is new. Fails without any model."""
        now = self.clock()
        if self._model is None or now - self._looked_up >= self.max_age:
            newest = newest_version(self.spark, self.root)
            if self._model is None or newest["version"] != self._model[1]["version"]:
                self._model = load_version(self.root, newest["version"]), newest
            self._looked_up = now
        return self._model


def start_scores(
    vehicles: DataFrame, model: NewestModel, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Score the vehicles of a message stream. All rows of a micro-batch have one model, which each row names.

    A micro-batch has a folder of its own; if it is repeated, its rows are replaced as a whole, perhaps by those of a newer model.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        pipeline, metadata = model.current()
        scored = score(batch.select(KEY_COLUMN, *FEATURES), pipeline, metadata)
        scored = scored.withColumn("model_version", F.lit(metadata["version"]))
        scored.write.mode("overwrite").parquet(f"{path.rstrip('/')}/query_id={query_id}/batch_id={batch_id}")

    events = decode(vehicles, "vehicles", (KEY_COLUMN, *FEATURES))
    return start(events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)
