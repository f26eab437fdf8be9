"""Common table expressions for the comparison SQL (DuckDB dialect)."""

import re

# name -> (names it reads, body)
PARTS: dict[str, tuple[list[str], str]] = {}


def part(name: str, needs: list[str], body: str) -> None:
    PARTS[name] = (needs, body)


def with_parts(needs: list[str], sql: str) -> str:
    """The statement behind a WITH of everything it needs, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for below in PARTS[name][0]:
            visit(below)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return sql
    bodies = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name][1]})" for name in ordered)
    return f"WITH {bodies}\n{sql}"


def hhmm(minutes: str) -> str:
    return f"lpad(CAST(({minutes}) // 60 * 100 + ({minutes}) % 60 AS VARCHAR), 4, '0')"


part("raw", [], f"""
    SELECT o_orderkey AS flight_id,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS FlightDate,
        concat('C', substr(o_orderpriority, 1, 1)) AS Reporting_Airline,
        concat('A', CAST(o_custkey % 6 AS VARCHAR)) AS Origin,
        concat('A', CAST((o_custkey + o_orderkey) % 7 AS VARCHAR)) AS Dest,
        CASE WHEN o_orderkey % 40 = 0 THEN '' ELSE concat('N', CAST(o_custkey % 3 AS VARCHAR)) END AS Tail_Number,
        CASE WHEN o_orderkey % 333 = 0 THEN '' WHEN o_orderkey % 500 = 1 THEN '2400'
             ELSE {hhmm('(o_orderkey * 37) % 1440')} END AS CRSDepTime,
        {hhmm('(o_orderkey * 37 + 30 + o_orderkey % 90) % 1440')} AS CRSArrTime,
        concat(CAST(30 + o_orderkey % 90 AS VARCHAR), '.0') AS CRSElapsedTime,
        concat(CAST(200 + o_custkey % 2400 AS VARCHAR), '.0') AS Distance,
        CASE WHEN o_orderkey % 50 = 0 THEN NULL
             ELSE concat(CAST(CAST(floor(o_totalprice) AS BIGINT) % 120 - 85 AS VARCHAR), '.0') END AS DepDelay,
        CASE WHEN o_orderkey % 50 = 0 THEN '1.0' ELSE '0.0' END AS Cancelled,
        CASE WHEN o_orderkey % 170 = 0 THEN '1.0' ELSE '0.0' END AS Diverted
    FROM orders""")

# Times are four digits, hours and minutes; a flight without a departure time is no flight. It was flown if it was
# neither cancelled nor diverted and has a delay.
part("flights", ["raw"], """
    SELECT flight_id, strptime(FlightDate, '%Y-%m-%d')::DATE AS flight_date, Reporting_Airline AS carrier, Origin AS origin,
        Dest AS dest, CASE WHEN Tail_Number SIMILAR TO '.*[^ ].*' THEN trim(Tail_Number) END AS tail,
        CAST(left(CRSDepTime, 2) AS INTEGER) * 60 + CAST(right(CRSDepTime, 2) AS INTEGER) AS dep_min,
        CAST(left(CRSArrTime, 2) AS INTEGER) * 60 + CAST(right(CRSArrTime, 2) AS INTEGER) AS arr_min,
        CASE left(CRSDepTime, 2) WHEN '24' THEN 0 ELSE CAST(left(CRSDepTime, 2) AS INTEGER) END AS dep_hour,
        CAST(CRSElapsedTime AS DOUBLE) AS crs_elapsed, CAST(Distance AS DOUBLE) AS distance,
        (Cancelled, Diverted) = ('0.0', '0.0') AND DepDelay IS NOT NULL AS operated,
        CASE WHEN operated THEN CAST(DepDelay AS DOUBLE) END AS dep_delay,
        CASE WHEN operated THEN (dep_delay > 14.5)::INTEGER END AS delayed
    FROM raw WHERE length(CRSDepTime) = 4""")

part("weather", [], """
    SELECT concat('A', CAST(i AS VARCHAR)) AS airport, d AS date,
        ((t * 7 + i * 13) % 50) / 10.0E0 AS precip_mm, ((t + i) % 4) / 2.0E0 AS snow_cm,
        10 + ((t * 3 + i * 17) % 700) / 10.0E0 AS gust_kmh, ((t * 11 + i * 5) % 300) / 10.0E0 - 5 AS temp_min_c
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS t FROM orders),
        range(0, 6) AS airports(i)""")

HISTORY_KEYS = {
    "origin": (["origin"], 28), "carrier": (["carrier"], 28), "route": (["origin", "dest"], 28),
    "origin_hour": (["origin", "dep_hour"], 28), "origin_7d": (["origin"], 7), "carrier_7d": (["carrier"], 7),
    "nation_7d": ([], 7),
}

# The rate of a day: all labelled flights of the group on the days before it, by a join of days with earlier days.
for _name, (_keys, _days) in HISTORY_KEYS.items():
    _list = "".join(f"now.{k}, " for k in _keys)
    part(f"h_{_name}", ["flights"], f"""
    SELECT {_list}now.flight_date, sum(before.late) / nullif(sum(before.labelled), 0) AS {_name}_rate,
        CAST(coalesce(sum(before.labelled), 0) AS BIGINT) AS {_name}_n
    FROM (SELECT DISTINCT {"".join(f"{k}, " for k in _keys)}flight_date FROM flights) now
    LEFT JOIN (SELECT {"".join(f"{k}, " for k in _keys)}flight_date, count(*) AS labelled, count_if(delayed = 1) AS late
               FROM flights WHERE operated GROUP BY ALL) before
    ON {"".join(f"before.{k} = now.{k} AND " for k in _keys)}date_diff('day', before.flight_date, now.flight_date) BETWEEN 1 AND {_days}
    GROUP BY ALL""")

# A leg's number is one more than the aircraft's legs before it that day; the last of those brought the aircraft.
part("rotation", ["flights"], """
    SELECT f.flight_id, CAST(1 + count(e.flight_id) AS INTEGER) AS leg_number, any_value(all_day.legs) AS legs_that_day,
        max_by({'to': e.dest, 'at': e.arr_min}, (e.dep_min, e.flight_id)) AS brought,
        f.dep_min - brought['at'] AS ground, CASE WHEN brought['to'] = f.origin AND ground >= 0 AND ground <= 12 * 60 THEN ground END AS turnaround_min
    FROM flights f
    JOIN (SELECT tail, flight_date, count(*) AS legs FROM flights GROUP BY ALL) all_day ON all_day.tail = f.tail AND all_day.flight_date = f.flight_date
    LEFT JOIN flights e ON e.tail = f.tail AND e.flight_date = f.flight_date AND (e.dep_min, e.flight_id) < (f.dep_min, f.flight_id)
    GROUP BY f.flight_id, f.origin, f.dep_min""")

part("load", ["flights"], """
    SELECT flight_id, d.n AS origin_day_flights, h.n AS origin_hour_flights
    FROM flights
    JOIN (SELECT origin, flight_date, count(*) AS n FROM flights GROUP BY ALL) d USING (origin, flight_date)
    JOIN (SELECT origin, flight_date, dep_hour, count(*) AS n FROM flights GROUP BY ALL) h USING (origin, flight_date, dep_hour)""")


def _history_joins(names) -> str:
    return "\n".join(
        f"LEFT JOIN h_{n} ON h_{n}.flight_date = f.flight_date"
        + "".join(f" AND h_{n}.{k} = f.{k}" for k in HISTORY_KEYS[n][0]) for n in names)


WEATHER_NAMES = ["precip_mm", "snow_cm", "gust_kmh", "temp_min_c"]

part("features", ["flights", "load", "rotation", "weather", *[f"h_{n}" for n in HISTORY_KEYS]], f"""
    SELECT flight_id, f.flight_date, f.carrier, f.origin, f.dest, f.dep_hour,
        CAST(date_part('isodow', f.flight_date) AS INTEGER) AS day_of_week, CAST(date_part('month', f.flight_date) AS INTEGER) AS month,
        distance, crs_elapsed, origin_day_flights, origin_hour_flights,
        {", ".join(f"{n}_rate, {n}_n" for n in HISTORY_KEYS)}, leg_number, legs_that_day, turnaround_min,
        {", ".join(f"{end}_sky.{c} AS {end}_{c}" for end in ("origin", "dest") for c in WEATHER_NAMES)}, dep_delay, delayed
    FROM (SELECT * FROM flights WHERE operated) f NATURAL JOIN load
    LEFT JOIN (SELECT flight_id, leg_number, legs_that_day, turnaround_min FROM rotation) USING (flight_id)
    {_history_joins(HISTORY_KEYS)}
    {" ".join(f"LEFT JOIN weather {end}_sky ON ({end}_sky.airport, {end}_sky.date) = (f.{end}, f.flight_date)" for end in ("origin", "dest"))}""")

part("split", ["flights"], """
    SELECT first_day + 28 AS start,
        max(d) FILTER (WHERE i = CAST(floor(n * (1 - 0.2E0 - 0.1E0)) AS BIGINT)) AS valid_start,
        max(d) FILTER (WHERE i = CAST(floor(n * (1 - 0.2E0)) AS BIGINT)) AS test_start, max(d) AS last_day
    FROM (SELECT d, first_day, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n
          FROM (SELECT d, first_day FROM (SELECT DISTINCT flight_date AS d,
                    (SELECT min(flight_date) FROM flights WHERE operated) AS first_day FROM flights WHERE operated)
                WHERE d >= first_day + 28))
    GROUP BY first_day""")

part("parts", ["flights", "split"], """
    SELECT flights.*, CASE WHEN flight_date < valid_start THEN 'train' WHEN flight_date < test_start THEN 'valid'
        ELSE 'test' END AS split, test_start, last_day
    FROM flights, split WHERE operated AND flight_date >= start""")

part("forecast", ["parts", "h_route", "h_origin"], """
    SELECT parts.*, coalesce(route_rate, origin_rate,
        (SELECT avg(delayed) FROM parts WHERE split = 'train')) AS p
    FROM parts LEFT JOIN h_route USING (origin, dest, flight_date) LEFT JOIN h_origin USING (origin, flight_date)
    WHERE split <> 'train'""")

part("shifts", ["forecast"], """
    SELECT flight_date, coalesce(CASE WHEN n > 0 THEN ln(seen / (1 - seen)) - ln(said / (1 - said)) END, 0) AS shift
    FROM (SELECT flight_date, n, greatest(least(late / n, 1 - 1E-6), 1E-6) AS seen,
              greatest(least(expected / n, 1 - 1E-6), 1E-6) AS said
          FROM (SELECT flight_date, sum(late) OVER past AS late, sum(expected) OVER past AS expected, sum(n) OVER past AS n
                FROM (SELECT flight_date, sum(delayed) AS late, sum(p) AS expected, count(*) AS n
                      FROM forecast GROUP BY flight_date)
                WINDOW past AS (ORDER BY flight_date
                    RANGE BETWEEN INTERVAL 14 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)))""")

part("recalibrated", ["forecast", "shifts"], """
    SELECT forecast.*, shift,
        1 / (1 + exp(-(ln(greatest(least(p, 1 - 1E-6), 1E-6) / (1 - greatest(least(p, 1 - 1E-6), 1E-6))) + shift)))
            AS p_recalibrated
    FROM forecast JOIN shifts USING (flight_date) WHERE split = 'test'""")

part("test", ["forecast"], "SELECT * FROM forecast WHERE split = 'test'")

part("top_test_origins", ["test"], """
    SELECT origin, count(*) AS flights FROM test GROUP BY origin ORDER BY flights DESC, origin LIMIT 4""")

part("cube", ["test", "top_test_origins"], """
    SELECT strftime(flight_date, '%Y-%m-%d') AS date,
        CASE WHEN origin IN (SELECT origin FROM top_test_origins) THEN origin ELSE 'Other airports' END AS origin,
        carrier,
        CAST(CASE WHEN dep_hour BETWEEN 5 AND 10 THEN 0 WHEN dep_hour BETWEEN 11 AND 15 THEN 1
             WHEN dep_hour BETWEEN 16 AND 20 THEN 2 ELSE 3 END AS INTEGER) AS part,
        count(*) AS n, CAST(sum(delayed) AS BIGINT) AS late, round(sum(p), 2) AS p
    FROM test GROUP BY ALL""")

SNAPSHOT_LAST = [f"{h}_{m}" for h in ("origin", "carrier", "route", "origin_hour") for m in ("rate", "n")] + [
    "origin_7d_rate", "carrier_7d_rate", "nation_7d_rate"]

part("snapshot", ["features"], f"""
    SELECT carrier, origin, dest, dep_hour, median(distance) AS distance, median(crs_elapsed) AS crs_elapsed,
        CAST(median(origin_day_flights) AS DOUBLE) AS origin_day_flights,
        CAST(median(origin_hour_flights) AS DOUBLE) AS origin_hour_flights,
        {", ".join(f"arg_max({c}, flight_date) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in SNAPSHOT_LAST)}
    FROM features WHERE flight_date > (SELECT max(flight_date) FROM features) - 28
    GROUP BY carrier, origin, dest, dep_hour""")

part("requests", [], """
    SELECT o_orderkey AS request_id, concat('C', substr(o_orderpriority, 1, 1)) AS carrier,
        CASE WHEN o_orderkey % 97 = 0 THEN 'ZZ' ELSE concat('A', CAST(o_custkey % 6 AS VARCHAR)) END AS origin,
        concat('A', CAST((o_custkey + o_orderkey) % 7 AS VARCHAR)) AS dest, CAST(o_orderdate AS DATE) AS flight_date,
        CAST((o_orderkey * 5) % 26 AS INTEGER) AS dep_hour
    FROM orders""")

part("matched", ["requests", "snapshot"], """
    SELECT r.*, s.hour AS matched_hour, s.* EXCLUDE (hour, c, o, d),
        CASE WHEN r.dep_hour NOT BETWEEN 0 AND 23 THEN 'invalid_hour' WHEN s.hour IS NULL THEN 'no_history'
             ELSE 'ok' END AS status
    FROM requests r LEFT JOIN (SELECT * RENAME (dep_hour AS hour, carrier AS c, origin AS o, dest AS d) FROM snapshot) s
        ON s.c = r.carrier AND s.o = r.origin AND s.d = r.dest AND r.dep_hour BETWEEN 0 AND 23
    QUALIFY row_number() OVER (PARTITION BY r.request_id ORDER BY abs(s.hour - r.dep_hour), s.hour) = 1""")

part("airports", [], """
    SELECT s_suppkey, concat('A', CAST(s_suppkey % 6 AS VARCHAR)) AS iata_code, s_acctbal AS latitude_deg,
        CAST(s_nationkey AS DOUBLE) AS longitude_deg,
        CASE WHEN s_suppkey % 4 = 1 THEN 'closed' WHEN s_suppkey % 4 = 2 THEN NULL ELSE 'large_airport' END AS type
    FROM supplier""")

part("coordinates", ["airports"], """
    SELECT iata_code AS airport, latitude_deg AS lat, longitude_deg AS lon FROM airports
    WHERE type IS DISTINCT FROM 'closed'
    QUALIFY row_number() OVER (PARTITION BY iata_code ORDER BY s_suppkey) = 1""")

part("categories", ["parts"], """
    SELECT name, value, row_number() OVER (PARTITION BY name ORDER BY value) - 1 AS ix, count(*) OVER (PARTITION BY name) AS unseen
    FROM (SELECT DISTINCT 'carrier' AS name, carrier AS value FROM parts WHERE split = 'train'
        UNION SELECT 'origin', origin FROM parts WHERE split = 'train'
        UNION SELECT 'dest', dest FROM parts WHERE split = 'train') WHERE value IS NOT NULL""")


def tampered(prefix: str, source: str, body: str, results: list[str]) -> None:
    """Define `{prefix}{source}` by `body` and, on top of it, a copy of every part between it and `results`."""
    def reads(name: str) -> bool:
        return name == source or any(reads(below) for below in PARTS[name][0])

    def copy(name: str) -> str:
        if not reads(name):
            return name
        copied = f"{prefix}{name}"
        if copied not in PARTS:
            needs, text = PARTS[name]
            below = [copy(n) for n in needs]
            for old, new in zip(needs, below):
                text = re.sub(rf"\b{old}\b(?!_)", new, text)
            part(copied, below, text)
        return copied

    part(f"{prefix}{source}", [source, "split"], body)
    for name in results:
        copy(name)


AUDIT_DAY = "(SELECT valid_start FROM split)"
_KEPT = "flight_id, flight_date, carrier, origin, dest, tail, dep_min, arr_min, dep_hour, crs_elapsed, distance"

tampered("flipped_", "flights", f"""
    SELECT {_KEPT}, operated, dep_delay,
        CASE WHEN flight_date = {AUDIT_DAY} THEN 1 - delayed ELSE delayed END AS delayed FROM flights""", ["features"])

_CANCEL = f"(operated AND flight_date = {AUDIT_DAY} AND flight_id % 3 = 0)"
tampered("thinned_", "flights", f"""
    SELECT {_KEPT}, operated AND NOT {_CANCEL} AS operated, CASE WHEN NOT {_CANCEL} THEN dep_delay END AS dep_delay,
        CASE WHEN NOT {_CANCEL} THEN delayed END AS delayed FROM flights""", ["features"])

tampered("later_", "forecast", """
    SELECT * REPLACE (CASE WHEN flight_date = (SELECT test_start + 14 FROM split) THEN 1 - delayed ELSE delayed END AS delayed)
    FROM forecast""", ["recalibrated"])
