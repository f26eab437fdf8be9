"""The steps in order, each reading what the one before wrote."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from departure_risk.operators.clean import clean
from departure_risk.operators.cube import cube_document
from departure_risk.plans import refresh
from departure_risk.plans.features import build_features
from departure_risk.plans.models import BoostedModel, categories_of
from departure_risk.plans.training import Trained, metrics_document, serving_snapshot, test_cube, train
from departure_risk.sources.artifacts import current, new_version, publish
from departure_risk.sources.csv_files import read_raw
from departure_risk.sources.forecasts import add_fetched, airports_to_fetch, parse_payloads, usable_cache
from departure_risk.sources.tables import read_by_month, read_weather, upsert_weather, write_by_month, write_document, write_weather


def clean_step(spark: SparkSession, raw_folder: str, flights_path: str) -> int:
    """Raw files to the flights table; returns the number of operated flights."""
    return counted_clean_step(spark, raw_folder, flights_path)["operated"]


def counted_clean_step(spark: SparkSession, raw_folder: str, flights_path: str) -> dict[str, int]:
    """The same; returns how many rows were read, malformed, kept and operated, all counted by the pass that writes."""
    read, kept = Observation(), Observation()
    flights = clean(read_raw(spark, raw_folder, counts=read)).observe(
        kept, F.count(F.lit(1)).alias("kept"), F.count_if("operated").alias("operated"))
    write_by_month(flights, flights_path, rebalance=False)  # no shuffle, so no row is counted twice
    return read.get | kept.get


def weather_request_step(spark: SparkSession, flights_path: str, coordinates: DataFrame, weather_path: str) -> DataFrame:
    """Airports still to fetch, with the days to ask for. Fetching them is up to the caller."""
    flights = read_by_month(spark, flights_path)
    span = flights.agg(F.min("flight_date").alias("start"), F.max("flight_date").alias("end")).first()
    cached = usable_cache(read_weather(spark, weather_path), span.start, span.end)
    return airports_to_fetch(flights, coordinates, cached).withColumns(
        {"start": F.lit(span.start), "end": F.lit(span.end)})


def weather_step(spark: SparkSession, flights_path: str, payloads: DataFrame | None, weather_path: str) -> int:
    """Add fetched payloads to the usable cache; returns the rows of the table, 0 when there is no weather.

    Airports that the cache holds are not added again, so repeating the step changes nothing. Where the cache holds these
    days alone, only the new airports' files are written.
    """
    flights = read_by_month(spark, flights_path)
    span = flights.agg(F.min("flight_date").alias("start"), F.max("flight_date").alias("end")).first()
    table = read_weather(spark, weather_path)
    cached = usable_cache(table, span.start, span.end)
    fetched = None if payloads is None else parse_payloads(payloads)
    if fetched is None or cached is None or table.where(~F.col("date").between(F.lit(span.start), F.lit(span.end))).head(1):
        return write_weather(spark, add_fetched(cached, fetched), weather_path)
    upsert_weather(spark, add_fetched(None, fetched).join(cached.select("airport").distinct(), "airport", "left_anti"), weather_path)
    return read_weather(spark, weather_path).count()


def features_step(spark: SparkSession, flights_path: str, weather_path: str | None, features_path: str) -> int:
    flights = read_by_month(spark, flights_path)
    return write_by_month(build_features(flights, read_weather(spark, weather_path)), features_path)


def add_months_step(spark: SparkSession, raw_folder: str, flights_path: str, weather_path: str | None, features_path: str) -> list[str]:
    """Take in new or corrected monthly files without building the rest again; returns the feature months written.

    `raw_folder` holds the files of these months only. New flights are numbered after those of the table.
    """
    after = read_by_month(spark, flights_path).agg(F.coalesce(F.max("flight_id"), F.lit(0))).first()[0]
    new = clean(read_raw(spark, raw_folder), flight_id=F.monotonically_increasing_id() + 1 + after)
    return refresh.add_months(spark, new, flights_path, read_weather(spark, weather_path), features_path)


def train_step(spark: SparkSession, features_path: str, artifacts: str, **options) -> Trained:
    """Train (see `training.train` for the options) and publish model, categories, metrics, cube and snapshot as one version."""
    trained = train(read_by_month(spark, features_path, keep_month=True), **options)
    folder = new_version(artifacts)
    trained.model.save(spark, f"{folder}/model")
    categories = list(categories_of(trained.model.matrix).items())
    write_document(spark.createDataFrame(categories, "name string, labels array<string>"), f"{folder}/categories")
    write_document(metrics_document(trained), f"{folder}/metrics")
    test_cube(trained).write.parquet(f"{folder}/cube")
    serving_snapshot(trained).write.parquet(f"{folder}/snapshot")
    publish(spark, artifacts, folder)
    return trained


def report_step(spark: SparkSession, artifacts: str, site: str) -> None:
    """The results page's data: one JSON row of metrics and cube, of the last complete version."""
    folder = current(spark, artifacts)
    cube = cube_document(spark.read.parquet(f"{folder}/cube"))
    metrics = spark.read.json(f"{folder}/metrics")
    page = metrics.select(F.struct("*").alias("metrics"), cube.select(F.struct("*")).scalar().alias("cube"))
    write_document(page, site)


def load_for_scoring(spark: SparkSession, artifacts: str) -> tuple[BoostedModel, DataFrame]:
    """Model and snapshot of the last complete version."""
    folder = current(spark, artifacts)
    return BoostedModel.load(spark, f"{folder}/model"), spark.read.parquet(f"{folder}/snapshot")
