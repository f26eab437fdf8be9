import pytest
from pyspark.sql import functions as F

from departure_risk.operators.clean import clean
from departure_risk.plans.features import build_features
from departure_risk.session import local_session, written_once

# Three hubs, then three outstations. Every aircraft shuttles between its hub and outstations all day.
AIRPORTS = ["BOS", "DEN", "SEA", "TPA", "LAX", "ORD"]
CARRIERS = ["K1", "L2", "M3", "N4"]
DAYS, AIRCRAFT, LEGS = 110, 64, 7


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def draw(n: int, *of):
    """A repeatable whole number below n, the same wherever `of` is the same."""
    return F.pmod(F.xxhash64(*[F.lit(x) if isinstance(x, int) else x for x in of]), F.lit(n)).cast("int")


def one_of(values, place):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def make_raw(spark, days: int = DAYS):
    """A timetable in the raw layout. Delays build up over an aircraft's day, most of all on N4 and on Fridays."""
    plane, leg = F.col("plane"), F.col("leg")
    rows = spark.range(days * AIRCRAFT * LEGS).select(
        "id", (F.col("id") % LEGS).alias("leg"), (F.floor(F.col("id") / LEGS) % AIRCRAFT).alias("plane"),
        F.date_add(F.lit("2025-01-01").cast("date"), F.floor(F.col("id") / (LEGS * AIRCRAFT)).cast("int")).alias("day"))
    there = one_of(AIRPORTS[3:], draw(3, "plane", "day", F.floor(leg / 2), 1))
    hub = one_of(AIRPORTS[:3], plane % 3)
    flown = rows.withColumns({
        "carrier": one_of(CARRIERS, plane % 4), "out": leg % 2 == 0, "hub": hub, "there": there,
        "leaves": 345 + (plane * 37) % 240 + leg * 120, "block": 50 + draw(40, "there", "hub", 2),
        "off": draw(40, "id", 3) == 7, "chance": draw(1000, "id", 4)})
    odds = 50 + 60 * leg + F.when(F.col("carrier") == "N4", 130).otherwise(0) + F.when(F.weekday("day") == 4, 70).otherwise(0)
    delay = F.when(F.col("chance") < odds, 15 + draw(90, "id", 5)).otherwise(draw(20, "id", 6) - 6)

    def clock(minutes):
        return F.concat(F.lpad(F.floor(minutes / 60).cast("string"), 2, "0"), F.lpad((minutes % 60).cast("string"), 2, "0"))

    def number(value):
        return value.cast("double").cast("string")

    return flown.select(
        F.col("day").cast("string").alias("FlightDate"), F.col("carrier").alias("Reporting_Airline"),
        F.when(F.col("out"), F.col("hub")).otherwise(F.col("there")).alias("Origin"),
        F.when(F.col("out"), F.col("there")).otherwise(F.col("hub")).alias("Dest"),
        F.format_string("PH-%03d", plane).alias("Tail_Number"), clock(F.col("leaves")).alias("CRSDepTime"),
        clock((F.col("leaves") + F.col("block")) % 1440).alias("CRSArrTime"), number(F.col("block")).alias("CRSElapsedTime"),
        number(F.col("block") * 9 - 120).alias("Distance"), F.when(~F.col("off"), number(delay)).alias("DepDelay"),
        number(F.col("off").cast("int")).alias("Cancelled"), F.lit("0.0").alias("Diverted"), number(delay + 3).alias("ArrDelay"))


@pytest.fixture(scope="session")
def raw(spark):
    return written_once(make_raw(spark), "test-raw")


@pytest.fixture(scope="session")
def flights(raw):
    return written_once(clean(raw), "test-flights")


@pytest.fixture(scope="session")
def weather(spark):
    """A front that crosses the airports one after the other, every nine days."""
    days = spark.range(DAYS).select(F.col("id").cast("int").alias("n"))
    places = F.posexplode(F.array(*[F.lit(a) for a in AIRPORTS])).alias("place", "airport")
    front = (F.col("n") + F.col("place")) % 9
    table = days.select("n", places).select(
        "airport", F.date_add(F.lit("2025-01-01").cast("date"), F.col("n")).alias("date"),
        (F.greatest(F.lit(0), 4 - front) * 2.5).cast("double").alias("precip_mm"), F.when(front == 0, 1.5).otherwise(0.0).alias("snow_cm"),
        (25 + front * 6).cast("double").alias("gust_kmh"), (F.col("n") / 8 - 3).cast("double").alias("temp_min_c"))
    return written_once(table, "test-weather")


@pytest.fixture(scope="session")
def features(flights, weather):
    return written_once(build_features(flights, weather), "test-features")


@pytest.fixture(scope="session")
def flights_pd(flights):
    return flights.toPandas()


@pytest.fixture(scope="session")
def features_pd(features):
    return features.toPandas()
