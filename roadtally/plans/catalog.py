"""Named queries over the accident-shaped views of a table folder: one per operator.

Every query reads the whole tables. Results are rendered as the reports show them: ISO text and numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadtally.functions.casts import to_day, to_grid, to_int, to_long
from roadtally.functions.events import event_time_text, hash_bucket, severity_score, severity_weight
from roadtally.ml import frame
from roadtally.ml.report import accuracies, classification_report, confusion
from roadtally.ml.scoring import score
from roadtally.ml.training import encoder_stages, save, train, with_prediction
from roadtally.operators import reports
from roadtally.operators.colocated import ColocatedTables, append_colocated, colocate, open_colocated
from roadtally.operators.joins import salted_join
from roadtally.operators.merge import drop_replays, merge, rows_touched, slice_deltas
from roadtally.operators.numbering import number_rows, total_order
from roadtally.operators.rollups import (
    CONDITIONS,
    DEMOGRAPHIC_KEYS,
    GEO,
    HOTSPOTS,
    PROFILE,
    ROLLUPS,
    STAMP,
    RollupSpec,
    demographics,
)
from roadtally.plans.serving import batch_recompute, serve, snapshot, store, stored
from roadtally.schemas import EXTRACT_SCHEMAS, KEY_COLUMN, MESSAGE_SCHEMA, wire_names
from roadtally.session import checkpointed, release_shuffles, scratch_path
from roadtally.sources import fixtures
from roadtally.sources.envelope import by_key, decode, encode, first_records
from roadtally.sources.files import extract, lower_names, prepare_vehicles, read_csv, read_extract
from roadtally.streaming.joined import DEMOGRAPHICS, StreamedDemographics, start_demographics
from roadtally.streaming.jobs import replay_files, start_extract, start_rollups
from roadtally.streaming.metrics import BatchMetrics
from roadtally.streaming.replays import SeenEvents
from roadtally.streaming.scores import NewestModel, start_scores
from roadtally.streaming.state import RollupTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Micro-batches the tables are cut into where a query shows accumulation, and the time of the first.
SLICES = 4
FIRST_STAMP = "2024-01-01 00:00:00"
CUT_OVER = "1998-07-01"
RECORD_CAP = 500
# Message files that one micro-batch takes at most, and messages that one file holds at most.
FILES_PER_TRIGGER = 64
FILE_MESSAGES = 500_000


def query(build: Query) -> Query:
    """Register a query under its function name, less a trailing underscore; its result is rendered."""
    QUERIES[build.__name__.removesuffix("_")] = lambda spark, sf_dir: reports.render(build(spark, sf_dir))
    return build


def _needs_place(spec: RollupSpec) -> bool:
    return "local_authority_district" in spec.inputs


def _events(spark: SparkSession, sf_dir: str, spec: RollupSpec) -> DataFrame:
    if spec.stream == "vehicles":
        return fixtures.vehicles(spark, sf_dir)
    return fixtures.accidents(spark, sf_dir, place=_needs_place(spec))


def _stamp(hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return F.lit(FIRST_STAMP).cast("timestamp_ntz") + F.make_dt_interval(hours=hours.cast("int"))


def _sliced(spark: SparkSession, sf_dir: str, spec: RollupSpec) -> DataFrame:
    """Deltas of the micro-batches of a stream, one hour apart; rows fall into batches by key hash."""
    events = _events(spark, sf_dir, spec).withColumn("slice", hash_bucket("accident_index", SLICES))
    return slice_deltas(spec, events, "slice", _stamp(F.col("slice")))


def _table(spark: SparkSession, sf_dir: str, spec: RollupSpec) -> DataFrame:
    """A rollup table as accumulated from the micro-batches."""
    return merge(spec, _sliced(spark, sf_dir, spec))


def _demographics(spark: SparkSession, sf_dir: str, day: Column | None = None) -> DataFrame:
    return demographics(
        fixtures.vehicles(spark, sf_dir),
        fixtures.accidents(spark, sf_dir),
        F.lit(FIRST_STAMP[:10]) if day is None else day,
    )


def _kept(spark: SparkSession, table: DataFrame, period: str) -> DataFrame:
    """The table as stored and read back."""
    path = scratch_path(spark, "stored")
    store(table, path, period)
    return stored(spark, path, table.schema)


# --- preparation, envelope, extracts -------------------------------------------------------------------------


@query
def prep_filter_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_vehicles(fixtures.vehicles(spark, sf_dir))


@query
def csv_latin1_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accidents as a Latin-1 CSV file with wire names, of which three columns are read back."""
    path, names = scratch_path(spark, "csv"), wire_names("accidents")
    rows = fixtures.accidents(spark, sf_dir).withColumn("road_type", F.concat("road_type", F.lit(" é")))
    wired = rows.select(*[F.col(c).alias(names[c]) for c in rows.columns])
    wired.write.option("header", True).option("encoding", "ISO-8859-1").option("emptyValue", "").csv(path)
    wanted = ("accident_index", "accident_severity", "road_type")
    return lower_names(read_csv(spark, path, "accidents", wanted, encoding="ISO-8859-1"))


@query
def messages_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per key, and in how many partitions they lie once routed."""
    routed = by_key(_messages(spark, sf_dir, "vehicles")).withColumn("partition", F.spark_partition_id())
    return routed.groupBy("key").agg(F.count_distinct("partition").alias("partitions"), F.count("*").alias("n"))


@query
def record_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records of a numbered stream; the cap is the operator."""
    events = decode(_messages(spark, sf_dir, "vehicles"), "vehicles", ["accident_index"])
    return first_records(events, RECORD_CAP).select("seq", "accident_index")


@query
def event_time_text_(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = event_time_text("date", "time")
    return fixtures.accidents(spark, sf_dir).select("accident_index", text.alias("event_time"))


def _messages(spark: SparkSession, sf_dir: str, stream: str, place: bool = True) -> DataFrame:
    rows = fixtures.accidents(spark, sf_dir, place=place) if stream == "accidents" else fixtures.vehicles(spark, sf_dir)
    return encode(number_rows(rows, ["accident_index"]), stream, F.lit(FIRST_STAMP).cast("timestamp"))


def _numbered_messages(spark: SparkSession, sf_dir: str, stream: str, place: bool = True) -> DataFrame:
    """``_messages`` over rows that are numbered once and stored: the messages, several times as large, are made when read."""
    rows = fixtures.accidents(spark, sf_dir, place=place) if stream == "accidents" else fixtures.vehicles(spark, sf_dir)
    path, numbered = scratch_path(spark, f"numbered-{stream}"), number_rows(rows, ["accident_index"])
    numbered.write.option("compression", "zstd").parquet(path)
    release_shuffles(spark)
    return encode(spark.read.schema(numbered.schema).parquet(path), stream, F.lit(FIRST_STAMP).cast("timestamp"))


def _send(messages: DataFrame, path: str, least: int = SLICES, spread: bool = True) -> None:
    """Append messages as files: at least so many, more where there are more shuffle partitions; unspread ones stay as they lie."""
    spark = messages.sparkSession
    release_shuffles(spark)
    if spread:
        messages = messages.repartition(max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))), "key", "value")
    written = messages.write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", FILE_MESSAGES)
    written.parquet(path)
    release_shuffles(spark)


def _per_trigger(spark: SparkSession, batches: int, least: int = SLICES) -> int:
    """Files per micro-batch, so that the files of a ``_send`` make so many of them, or more where there are many files."""
    files = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(FILES_PER_TRIGGER, -(-files // batches))


def _encoded_fields(messages: DataFrame, *columns: str, stream: str) -> DataFrame:
    names = wire_names(stream)
    return messages.select(
        "key",
        F.get_json_object("value", "$.seq").cast("bigint").alias("seq"),
        F.get_json_object("value", "$.stream").alias("stream"),
        F.get_json_object("value", "$.event_time").alias("event_time"),
        *[F.get_json_object("value", f"$.payload['{names[c]}']").alias(c) for c in columns],
    )


@query
def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("accident_severity", "date", "local_authority_district", "speed_limit")
    return _encoded_fields(_messages(spark, sf_dir, "accidents"), *columns, stream="accidents")


@query
def envelope_encode_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("age_band_of_driver", "sex_of_driver", "vehicle_type", "age_of_vehicle", "year")
    return _encoded_fields(_messages(spark, sf_dir, "vehicles"), *columns, stream="vehicles")


@query
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decode(_messages(spark, sf_dir, "accidents"), "accidents")
    shown = fixtures.accidents(spark, sf_dir, place=True).columns
    return events.select("seq", "stream", "event_time_str", *shown)


@query
def envelope_decode_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decode(_messages(spark, sf_dir, "vehicles"), "vehicles")
    return events.select("seq", "stream", "event_time_str", *fixtures.vehicles(spark, sf_dir).columns)


@query
def extract_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _messages(spark, sf_dir, "accidents", place=False)
    return extract(decode(messages, "accidents", EXTRACT_SCHEMAS["accidents"].names), "accidents")


@query
def extract_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _messages(spark, sf_dir, "vehicles")
    return extract(decode(messages, "vehicles", EXTRACT_SCHEMAS["vehicles"].names), "vehicles")


@query
def union_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract files of several appends, read back as one table."""
    path = scratch_path(spark, "extracts")
    rows = extract(fixtures.vehicles(spark, sf_dir), "vehicles")
    sliced = rows.withColumn("slice", hash_bucket("accident_index", SLICES))
    sliced.write.mode("append").partitionBy("slice").parquet(path)
    return read_extract(spark, path, "vehicles")


# --- projections and predicates ------------------------------------------------------------------------------


@query
def dates_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = fixtures.accidents(spark, sf_dir).select("accident_index", to_day("date").alias("event_date"))
    return dated.where(F.col("event_date").isNotNull())


@query
def geo_grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixtures.accidents(spark, sf_dir).select(
        "accident_index", to_grid("latitude").alias("lat_grid"), to_grid("longitude").alias("lon_grid")
    )
    return cells.dropna(subset=["lat_grid", "lon_grid"])


@query
def severity_score_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.accidents(spark, sf_dir).select("accident_index", severity_score().alias("score"))


@query
def severity_weight_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.accidents(spark, sf_dir).select("accident_index", severity_weight().alias("weight"))


@query
def tolerant_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.accidents(spark, sf_dir).select(
        "accident_index",
        to_int("speed_limit").alias("speed_limit"),
        to_long("number_of_casualties").alias("casualties"),
        to_long("number_of_vehicles").alias("vehicles"),
    )


@query
def null_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that count in no conditions cell, by the key they lack."""
    rejects = CONDITIONS.rejected(fixtures.accidents(spark, sf_dir), by=["accident_index"])
    return rejects.select(
        "accident_index",
        F.col("event_date").isNull().cast("int").alias("no_date"),
        F.col("speed_limit").isNull().cast("int").alias("no_speed"),
    )


# --- rollups and reports -------------------------------------------------------------------------------------


@query
def accident_kpi_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GEO.aggregate(_events(spark, sf_dir, GEO))


@query
def accident_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CONDITIONS.aggregate(_events(spark, sf_dir, CONDITIONS))


@query
def accident_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return HOTSPOTS.aggregate(_events(spark, sf_dir, HOTSPOTS))


@query
def vehicle_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PROFILE.aggregate(_events(spark, sf_dir, PROFILE))


@query
def vehicle_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demographics(spark, sf_dir)


@query
def conditions_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.with_average_severity(CONDITIONS.aggregate(_events(spark, sf_dir, CONDITIONS)))


@query
def vehicle_profile_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.with_average_age(PROFILE.aggregate(_events(spark, sf_dir, PROFILE)))


@query
def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.totals(GEO.aggregate(_events(spark, sf_dir, GEO)))


@query
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {spec.name: _table(spark, sf_dir, spec) for spec in ROLLUPS.values()}
    return reports.table_stats(
        tables[GEO.name],
        tables[CONDITIONS.name],
        tables[HOTSPOTS.name],
        tables[PROFILE.name],
        _kept(spark, _demographics(spark, sf_dir), "processing_date"),
    )


@query
def top_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_weather(CONDITIONS.aggregate(_events(spark, sf_dir, CONDITIONS)))


@query
def top_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_districts(HOTSPOTS.aggregate(_events(spark, sf_dir, HOTSPOTS)))


@query
def drivers_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.drivers_by_age_band(PROFILE.aggregate(_events(spark, sf_dir, PROFILE)))


@query
def district_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.leaderboard(HOTSPOTS.aggregate(_events(spark, sf_dir, HOTSPOTS)))


@query
def latest_kpi_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest(_table(spark, sf_dir, GEO), list(GEO.keys))


@query
def latest_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = reports.latest(_table(spark, sf_dir, CONDITIONS), list(CONDITIONS.keys))
    return reports.with_average_severity(newest)


@query
def latest_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest(_table(spark, sf_dir, HOTSPOTS), list(HOTSPOTS.keys))


@query
def latest_vehicle_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = reports.latest(_table(spark, sf_dir, PROFILE), list(PROFILE.keys))
    return reports.with_average_age(newest)


@query
def latest_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch is joined on a day of its own; the newest days come first."""
    day = F.date_add(F.lit(FIRST_STAMP[:10]).cast("date"), hash_bucket("accident_index", SLICES).cast("int"))
    table = _demographics(spark, sf_dir, day).withColumn(STAMP, F.col("processing_date").cast("timestamp_ntz"))
    return reports.latest(_kept(spark, table, "processing_date"), DEMOGRAPHIC_KEYS)


@query
def stored_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of several days, one of which is first stored wrongly and then replaced."""
    day = F.date_add(F.lit(FIRST_STAMP[:10]).cast("date"), hash_bucket("accident_index", SLICES).cast("int"))
    table, path = _demographics(spark, sf_dir, day), scratch_path(spark, "stored")
    store(table.withColumn("joined_count", -F.col("joined_count")), path, "processing_date")
    store(table, path, "processing_date")
    store(table.where(F.col("processing_date") == F.lit(FIRST_STAMP[:10])), path, "processing_date")
    return stored(spark, path, table.schema)


# --- join, state ---------------------------------------------------------------------------------------------


@query
def accident_vehicle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    vehicles = fixtures.vehicles(spark, sf_dir).select(*EXTRACT_SCHEMAS["vehicles"].names)
    accidents = fixtures.accidents(spark, sf_dir).select(*EXTRACT_SCHEMAS["accidents"].names)
    return salted_join(vehicles, accidents, "accident_index")


def _colocated(spark: SparkSession, sf_dir: str) -> ColocatedTables:
    """Both extracts stored together by key; half of the vehicles come in a second append."""
    root, buckets = scratch_path(spark, "colocated"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    vehicles = fixtures.vehicles(spark, sf_dir).select(*EXTRACT_SCHEMAS["vehicles"].names)
    accidents = fixtures.accidents(spark, sf_dir).select(*EXTRACT_SCHEMAS["accidents"].names)
    later = hash_bucket(KEY_COLUMN, 2) == 1
    colocate(vehicles.where(~later), accidents, KEY_COLUMN, root, buckets)
    append_colocated(root, KEY_COLUMN, buckets, children=vehicles.where(later))
    return open_colocated(spark, root, KEY_COLUMN, vehicles.schema, accidents.schema, buckets)


@query
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of tables that lie together by key: no row is moved."""
    return _colocated(spark, sf_dir).join()


@query
def additive_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, GEO).drop(STAMP)


@query
def merge_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, GEO).select(*GEO.keys, STAMP)


@query
def late_rows_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch per year, and a last batch with the rows that were held up, of any year."""
    events = _events(spark, sf_dir, CONDITIONS)
    late = hash_bucket("accident_index", 5) == 0
    arrival = F.when(late, F.lit(99)).otherwise(F.year(to_day("date")) - 1990)
    deltas = slice_deltas(CONDITIONS, events.withColumn("arrival", arrival), "arrival", _stamp(F.col("arrival")))
    return merge(CONDITIONS, deltas)


@query
def state_rows_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the table after the first batches that the last batch will change."""
    deltas = _sliced(spark, sf_dir, GEO)
    newest = F.col("slice") == SLICES - 1
    return rows_touched(GEO, merge(GEO, deltas.where(~newest)), deltas.where(newest))


def _stored_rollup(spark: SparkSession, sf_dir: str, spec: RollupSpec, batches: int = SLICES) -> RollupTable:
    """The table as stored batch by batch, with a compaction after every second one."""
    table, path = RollupTable(spark, scratch_path(spark, "state"), spec), scratch_path(spark, "deltas")
    _sliced(spark, sf_dir, spec).drop(STAMP).write.partitionBy("slice").parquet(path)
    for batch in range(batches):
        delta = spark.read.parquet(f"{path}/slice={batch}")
        table.add(delta, "slices", batch, _stamp(batch))
        if batch % 2:
            table.compact()
    return table


@query
def stored_latest_kpi_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows of a stored table, from the periods that hold them."""
    return reports.latest(_stored_rollup(spark, sf_dir, GEO).newest(50), list(GEO.keys))


@query
def stored_rows_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored table that the batch to come will change, from the periods that it touches."""
    newest = _sliced(spark, sf_dir, GEO).where(F.col("slice") == SLICES - 1)
    return _stored_rollup(spark, sf_dir, GEO, SLICES - 1).touched(newest)


@query
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole event table delivered twice, counted once."""
    delivered = fixtures.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stream"), F.col("event_id").alias("seq"), "user_id", "value", "props"
    )
    return drop_replays(delivered.unionByName(delivered))


# --- streaming -----------------------------------------------------------------------------------------------


def _replay(spark: SparkSession, sf_dir: str, stream: str, place: bool = False) -> DataFrame:
    """The messages of a stream as files, replayed in about ``SLICES`` micro-batches."""
    path = scratch_path(spark, f"messages-{stream}")
    partitions = max(SLICES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    _messages(spark, sf_dir, stream, place).repartition(partitions, "key", "value").write.parquet(path)
    return replay_files(spark, path, files_per_trigger=-(-partitions // SLICES))


def _streamed(spark: SparkSession, sf_dir: str, spec: RollupSpec) -> DataFrame:
    root, checkpoint = scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    messages = _replay(spark, sf_dir, spec.stream, _needs_place(spec))
    running = start_rollups(messages, [spec], root, checkpoint, available_now=True, stamp=_stamp, compact_every=3)
    running.awaitTermination()
    return RollupTable(spark, root, spec).read().drop(STAMP)


@query
def stream_kpi_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, GEO)


def _replayed(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    """All messages of a stream delivered twice; the second time some of the stamps are hours older."""
    path = scratch_path(spark, "replayed")
    _send(_numbered_messages(spark, sf_dir, stream), path)
    older = F.when(hash_bucket("key", 2) == 0, F.expr("timestamp - interval 5 hours")).otherwise(F.col("timestamp"))
    again = spark.read.schema(MESSAGE_SCHEMA).parquet(path)  # the files of the first time
    _send(again.withColumn("timestamp", older), path, spread=False)
    return replay_files(spark, path, _per_trigger(spark, 2))


@query
def stream_replayed_kpi_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, checkpoint = scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    seen = SeenEvents(spark, scratch_path(spark, "seen"), bucket=10_000)
    messages = _replayed(spark, sf_dir, "accidents")
    start_rollups(messages, [GEO], root, checkpoint, available_now=True, stamp=_stamp, seen=seen).awaitTermination()
    return RollupTable(spark, root, GEO).read().drop(STAMP)


@query
def stream_replayed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, "extract"), scratch_path(spark, "checkpoint")
    seen = SeenEvents(spark, scratch_path(spark, "seen"), bucket=10_000)
    messages = _replayed(spark, sf_dir, "vehicles")
    start_extract(messages, "vehicles", path, checkpoint, available_now=True, seen=seen).awaitTermination()
    return read_extract(spark, path, "vehicles")


@query
def stream_restart_kpi_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream stopped and started again, a batch delivered once more, and compaction before and after."""
    path, root, checkpoint = (scratch_path(spark, n) for n in ("messages", "state", "checkpoint"))
    messages = _messages(spark, sf_dir, "accidents")
    for part in range(2):
        half = messages.where(hash_bucket("key", 2) == part)
        half.repartition(SLICES, "key", "value").write.mode("append").parquet(path)
        running = start_rollups(
            replay_files(spark, path, 1), [GEO], root, checkpoint, available_now=True, stamp=_stamp, compact_every=3
        )
        running.awaitTermination()
        again = RollupTable(spark, root, GEO)
        again.add(GEO.aggregate(decode(half, "accidents", GEO.inputs)), str(running.id), 0, _stamp(0))
        again.compact()
    return RollupTable(spark, root, GEO).read().drop(STAMP)


@query
def stream_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, CONDITIONS)


@query
def stream_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, HOTSPOTS)


@query
def stream_vehicle_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, PROFILE)


def _stream_extract(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, "extract"), scratch_path(spark, "checkpoint")
    start_extract(_replay(spark, sf_dir, stream), stream, path, checkpoint, available_now=True).awaitTermination()
    return read_extract(spark, path, stream)


@query
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vehicles scored as they arrive; between the two halves a newer model is stored, which the stream takes up."""
    paths = [scratch_path(spark, n) for n in ("messages", "models", "scores", "checkpoint")]
    sent = _numbered_messages(spark, sf_dir, "vehicles")
    source = NewestModel(spark, paths[1], max_age=0)
    for part in range(2):
        save(train(fixtures.vehicles(spark, sf_dir), fixtures.accidents(spark, sf_dir), seed=part), paths[1])
        release_shuffles(spark)
        _send(sent.where(hash_bucket("key", 2) == part), paths[0])
        start_scores(replay_files(spark, paths[0], _per_trigger(spark, 2)), source, paths[2], paths[3], True).awaitTermination()
    scored = spark.read.parquet(paths[2])
    models = Window.orderBy("model_trained_at")  # over a row per model
    order = scored.select("model_version", "model_trained_at").distinct().withColumn("model", F.row_number().over(models))
    ranked = F.size("ranked").alias("ranked"), F.round(F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, b: a + b), 9).alias("total")
    return scored.join(F.broadcast(order.drop("model_trained_at")), "model_version").select(KEY_COLUMN, *frame.FEATURES, "model", *ranked)


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that two rollups and the extract of a stream took and rejected, undecodable messages included."""
    paths = [scratch_path(spark, n) for n in ("messages", "state", "extract", "metrics")]
    bad = F.when(hash_bucket("key", 7) == 0, F.lit("{no json")).otherwise(F.col("value").cast("string"))
    sent = _messages(spark, sf_dir, "accidents", place=False).withColumn("value", bad)
    sent.repartition(SLICES, "key", "value").write.parquet(paths[0])
    metrics = BatchMetrics(spark, paths[3])
    messages = replay_files(spark, paths[0], 1)
    started = [
        start_rollups(messages, [GEO, CONDITIONS], paths[1], f"{paths[1]}-checkpoint", True, stamp=_stamp, metrics=metrics),
        start_extract(messages, "accidents", paths[2], f"{paths[2]}-checkpoint", True, metrics=metrics),
    ]
    for running in started:
        running.awaitTermination()
    totals = metrics.read().groupBy("target").agg(F.sum("events").alias("events"), F.sum("rejected").alias("rejected"))
    batches = metrics.read().groupBy("target").agg(F.count("*").alias("batches"))
    return totals.join(batches.where(F.col("batches") == SLICES), "target").select("target", "events", "rejected")


@query
def stream_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles first, their accidents hours later in two parts with a restart between them, and a batch delivered once more."""
    root, checkpoint = scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    paths = {stream: scratch_path(spark, f"messages-{stream}") for stream in ("accidents", "vehicles")}
    sent = {stream: _numbered_messages(spark, sf_dir, stream, place=False) for stream in paths}
    _send(sent["vehicles"], paths["vehicles"])
    late = sent["accidents"].withColumn("timestamp", F.expr("timestamp + interval 7 hours"))
    for part in range(2):
        half = late.where(hash_bucket("key", 2) == part)
        _send(half, paths["accidents"], SLICES // 2)
        streams = [replay_files(spark, paths[s], _per_trigger(spark, n)) for s, n in (("accidents", 1), ("vehicles", 2))]
        running = start_demographics(*streams, root, checkpoint, True, stamp=lambda _: _stamp(0), compact_every=2)
        running.awaitTermination()
        events = {s: decode(rows, s, EXTRACT_SCHEMAS[s].names) for s, rows in {**sent, "accidents": half}.items()}
        StreamedDemographics(spark, root).add(events, str(running.id), 0, _stamp(0))
    return RollupTable(spark, root, DEMOGRAPHICS).read().drop(STAMP)


@query
def stream_extract_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_extract(spark, sf_dir, "accidents")


@query
def stream_extract_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_extract(spark, sf_dir, "vehicles")


# --- classifier ----------------------------------------------------------------------------------------------


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.training_groups(fixtures.vehicles(spark, sf_dir), fixtures.accidents(spark, sf_dir))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.split_groups(fixtures.vehicles(spark, sf_dir), fixtures.accidents(spark, sf_dir))


@query
def clean_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.training_rows(fixtures.vehicles(spark, sf_dir), fixtures.accidents(spark, sf_dir))


@query
def training_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(spark, sf_dir)


@query
def bucketed_training_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups counted over tables that lie together by key."""
    return frame.groups_colocated(_colocated(spark, sf_dir))


@query
def bucketed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups with the number of their rows held out, over tables that lie together by key."""
    return frame.split_colocated(_colocated(spark, sf_dir))


@query
def target_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.target_distribution(_groups(spark, sf_dir))


@query
def feature_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.feature_options(_groups(spark, sf_dir))


@query
def train_test_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.split_sizes(_split(spark, sf_dir))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.class_weights(_split(spark, sf_dir))


@query
def onehot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded vector of every known feature combination, as a text of zeros and ones."""
    combinations = checkpointed(_groups(spark, sf_dir).groupBy(*frame.FEATURES).agg(F.sum("n").alias("n")))
    encoded = Pipeline(stages=encoder_stages()).fit(combinations).transform(combinations)
    bits = F.transform(vector_to_array("features"), lambda x: x.cast("int").cast("string"))
    return encoded.select(*frame.FEATURES, "n", F.array_join(bits, "").alias("slots"))


def _model(spark: SparkSession, sf_dir: str):
    return train(fixtures.vehicles(spark, sf_dir), fixtures.accidents(spark, sf_dir))


@query
def severity_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted weight per class and feature slot, rounded; slot -1 is the intercept."""
    model = _model(spark, sf_dir)
    fitted = model.pipeline.stages[-1]
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    rows = [
        (name, slot, round(float(w), 6) + 0.0)
        for name, intercept, weights in zip(model.classes, intercepts, matrix)
        for slot, w in enumerate([intercept, *weights], start=-1)
    ]
    return spark.createDataFrame(rows, "severity string, slot int, weight double")


@query
def model_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    found = accuracies(with_prediction(model.groups, model.pipeline, model.classes))
    return found.select("part", F.round("accuracy", 9).alias("accuracy"))


@query
def classification_report_(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    report = classification_report(confusion(with_prediction(model.groups, model.pipeline, model.classes), "n_test"))
    return report.select("class", "support", *[F.round(m, 9).alias(m) for m in ("precision", "recall", "f1")])


@query
def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for a fixed rule in place of a model, so its figures can be checked elsewhere."""
    rule = F.when(F.col("sex_of_driver") == "Male", "Slight").when(F.col("age_band_of_driver") < "26", "Serious")
    report = classification_report(confusion(_groups(spark, sf_dir).withColumn("predicted", rule.otherwise("Fatal"))))
    return report.select("class", "support", *[F.round(m, 9).alias(m) for m in ("precision", "recall", "f1")])


@query
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vehicles scored with a model trained on all of them: the best class, and the classes ranked with percentages."""
    model = _model(spark, sf_dir)
    rows = fixtures.vehicles(spark, sf_dir).select("accident_index", *frame.FEATURES)
    scored = score(rows, model.pipeline, model.metadata.first())
    percent = F.transform("ranked", lambda r: F.concat_ws(" ", r["class"], F.round(r["probability"] * 100, 4).cast("decimal(9,4)")))
    return scored.select(
        "accident_index",
        *frame.FEATURES,
        "predicted_severity",
        F.array_join(percent, ", ").alias("ranked"),
        "model_n_samples",
        F.round("model_accuracy_test", 9).alias("model_accuracy_test"),
    )


# --- composite outputs ---------------------------------------------------------------------------------------


@query
def snapshot_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = {spec.name: _sliced(spark, sf_dir, spec) for spec in ROLLUPS.values()}
    return snapshot(merge(GEO, pieces[GEO.name]), pieces, F.lit(FIRST_STAMP).cast("timestamp_ntz"))


def _recomputed(spark: SparkSession, sf_dir: str, spec: RollupSpec) -> DataFrame:
    """A table recomputed from raw events that were all delivered twice."""
    messages = _messages(spark, sf_dir, spec.stream, place=_needs_place(spec))
    events = decode(messages.unionByName(messages), spec.stream, spec.inputs)
    return batch_recompute(events, spec, _stamp(0)).drop(STAMP)


@query
def batch_recompute_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recomputed(spark, sf_dir, GEO)


@query
def batch_recompute_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recomputed(spark, sf_dir, CONDITIONS)


@query
def batch_recompute_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recomputed(spark, sf_dir, HOTSPOTS)


@query
def batch_recompute_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recomputed(spark, sf_dir, PROFILE)


@query
def serve_batch_or_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = GEO.aggregate(_events(spark, sf_dir, GEO)).withColumn(STAMP, _stamp(0))
    layers = [_kept(spark, table, "event_date") for table in (batch, _table(spark, sf_dir, GEO))]
    return serve(*layers, "event_date", F.lit(CUT_OVER).cast("date"))
