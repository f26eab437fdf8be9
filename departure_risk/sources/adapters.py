"""Projections of order-like tables into the layouts this library reads.

They let the whole flow run on tables that hold no flights. Pure column expressions: each adapter keeps
the grain, partitioning and size of the table it reads.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

# Expressions of the raw layout over orders, including blanks, midnight, overnight and cancelled cases.
RAW_FROM_ORDERS = {
    "flight_id": "o_orderkey",
    "FlightDate": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "Reporting_Airline": "concat('C', substr(o_orderpriority, 1, 1))",
    "Origin": "concat('A', CAST(o_custkey % 6 AS STRING))",
    "Dest": "concat('A', CAST((o_custkey + o_orderkey) % 7 AS STRING))",
    "Tail_Number": "CASE WHEN o_orderkey % 40 = 0 THEN '' ELSE concat('N', CAST(o_custkey % 3 AS STRING)) END",
    "CRSDepTime": """CASE WHEN o_orderkey % 333 = 0 THEN '' WHEN o_orderkey % 500 = 1 THEN '2400'
        ELSE lpad(CAST(((o_orderkey * 37) % 1440) div 60 * 100 + ((o_orderkey * 37) % 1440) % 60 AS STRING), 4, '0') END""",
    "CRSArrTime": """lpad(CAST(((o_orderkey * 37 + 30 + o_orderkey % 90) % 1440) div 60 * 100
        + ((o_orderkey * 37 + 30 + o_orderkey % 90) % 1440) % 60 AS STRING), 4, '0')""",
    "CRSElapsedTime": "concat(CAST(30 + o_orderkey % 90 AS STRING), '.0')",
    "Distance": "concat(CAST(200 + o_custkey % 2400 AS STRING), '.0')",
    "DepDelay": """CASE WHEN o_orderkey % 50 = 0 THEN NULL
        ELSE concat(CAST(CAST(floor(o_totalprice) AS BIGINT) % 120 - 85 AS STRING), '.0') END""",
    "Cancelled": "CASE WHEN o_orderkey % 50 = 0 THEN '1.0' ELSE '0.0' END",
    "Diverted": "CASE WHEN o_orderkey % 170 = 0 THEN '1.0' ELSE '0.0' END",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def raw_from_orders(orders: DataFrame) -> DataFrame:
    """Raw text rows plus the natural key as flight_id."""
    return orders.selectExpr(*[f"{e} AS {c}" for c, e in RAW_FROM_ORDERS.items()])


def weather_from_orders(orders: DataFrame) -> DataFrame:
    """Weather of airports A0..A5 on every day that has an order; A6 has none."""
    days = orders.select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    per_airport = days.select("date", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i"),
                              F.datediff("date", F.lit("1995-01-01").cast("date")).alias("t"))
    return per_airport.selectExpr(
        "concat('A', CAST(i AS STRING)) AS airport",
        "date",
        "((t * 7 + i * 13) % 50) / 10.0D AS precip_mm",
        "((t + i) % 4) / 2.0D AS snow_cm",
        "10 + ((t * 3 + i * 17) % 700) / 10.0D AS gust_kmh",
        "((t * 11 + i * 5) % 300) / 10.0D - 5 AS temp_min_c",
    )


def requests_from_orders(orders: DataFrame) -> DataFrame:
    """One scoring request per order: hours 24 and 25 are invalid, origin ZZ has no history."""
    return orders.selectExpr(
        "o_orderkey AS request_id",
        "concat('C', substr(o_orderpriority, 1, 1)) AS carrier",
        "CASE WHEN o_orderkey % 97 = 0 THEN 'ZZ' ELSE concat('A', CAST(o_custkey % 6 AS STRING)) END AS origin",
        "concat('A', CAST((o_custkey + o_orderkey) % 7 AS STRING)) AS dest",
        "CAST(o_orderdate AS DATE) AS flight_date",
        "CAST((o_orderkey * 5) % 26 AS INT) AS dep_hour",
    )


def airports_from_suppliers(supplier: DataFrame) -> DataFrame:
    """An airport table with several rows per code, some of them closed or without a type."""
    return supplier.selectExpr(
        "concat('A', CAST(s_suppkey % 6 AS STRING)) AS iata_code",
        "s_acctbal AS latitude_deg",
        "CAST(s_nationkey AS DOUBLE) AS longitude_deg",
        "CASE WHEN s_suppkey % 4 = 1 THEN 'closed' WHEN s_suppkey % 4 = 2 THEN NULL ELSE 'large_airport' END AS type",
    )


def payloads_from_weather(weather: DataFrame) -> DataFrame:
    """Forecast payloads as a service answers them: two airports and one month per answer.

    A group holds at most 62 days, so collecting it is bounded.
    """
    pair = F.floor(F.substring("airport", 2, 1).cast("int") / 2)
    day = F.struct("date", "precip_mm", "snow_cm", "gust_kmh", "temp_min_c")
    per_airport = weather.groupBy(pair.alias("pair"), F.trunc("date", "month").alias("month"), "airport").agg(
        F.sort_array(F.collect_list(day)).alias("days"))
    daily = F.struct(
        F.transform("days", lambda d: d["date"].cast("string")).alias("time"),
        F.transform("days", lambda d: d["precip_mm"]).alias("precipitation_sum"),
        F.transform("days", lambda d: d["snow_cm"]).alias("snowfall_sum"),
        F.transform("days", lambda d: d["gust_kmh"]).alias("wind_gusts_10m_max"),
        F.transform("days", lambda d: d["temp_min_c"]).alias("temperature_2m_min"),
    )
    answers = per_airport.groupBy("pair", "month").agg(
        F.sort_array(F.collect_list(F.struct("airport", F.struct(daily.alias("daily")).alias("item")))).alias("rows"))
    return answers.select(
        F.transform("rows", lambda r: r["airport"]).alias("airports"),
        F.to_json(F.transform("rows", lambda r: r["item"])).alias("payload"),
    )
