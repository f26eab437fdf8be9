import pytest
from pyspark.sql import functions as F

from departure_risk.config import FLIGHTS_SCHEMA, RAW_COLUMNS
from departure_risk.functions.columns import text_to_double, text_to_int
from departure_risk.operators.clean import clean
from departure_risk.operators.ids import dense_ids
from departure_risk.plans import full_run
from departure_risk.sources import tables
from departure_risk.sources.csv_files import malformed_rows, read_raw


def test_schedule_is_kept_and_operated_flights_are_labelled(raw, flights, flights_pd):
    assert len(flights_pd) == raw.count()
    assert flights_pd.operated.sum() == raw.filter("Cancelled = '0.0'").count()
    assert flights_pd.loc[~flights_pd.operated, ["delayed", "dep_delay"]].isna().all().all()
    flown = flights_pd[flights_pd.operated]
    assert ((flown.dep_delay >= 15) == (flown.delayed == 1)).all()
    assert flights_pd.dep_hour.between(0, 23).all()
    assert flights_pd.flight_id.is_unique
    assert [(f.name, f.dataType) for f in flights.schema] == [(f.name, f.dataType) for f in FLIGHTS_SCHEMA]


def test_odd_values(spark):
    rows = [
        ("2025-01-01", "K1", "BOS", "LAX", " ", "2400", "0010", "x", "100.0", "20", "0", "0", 1440, 10, 0, 1),
        ("2025-01-01", "K1", "BOS", "LAX", None, "1530.0", "99", "60", "", "14", "0.00", "0", 930, 99, 15, 0),
        ("2025-01-01", None, "BOS", "LAX", "N1", "5", "2575", "60", "", "15", "1.0", "0", 5, 1575, 0, None),
        ("2025-01-01", "K1", "BOS", "LAX", "N1", "5", "5", "60", "", "late", "0", "0", 5, 5, 0, None),
        ("2025-01-01", "K1", "BOS", "LAX", "N1", "5", "5", "60", "", "30", None, "0", 5, 5, 0, None),
    ]
    names = [*RAW_COLUMNS, "dep", "arr", "hour", "label"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in RAW_COLUMNS) + ", dep int, arr int, hour int, label int")
    assert df.columns == names
    out = clean(df.withColumn("id", F.monotonically_increasing_id()), F.col("id")).orderBy("flight_id").collect()
    for got, row in zip(out, rows, strict=True):
        assert (got.dep_min, got.arr_min, got.dep_hour, got.delayed) == row[-4:]
    assert [r.tail for r in out] == [None, None, "N1", "N1", "N1"]


def test_rows_without_time_or_airport_go(spark):
    base = dict.fromkeys(RAW_COLUMNS, "1") | {"FlightDate": "2025-01-01"}
    rows = [base, base | {"CRSDepTime": ""}, base | {"CRSDepTime": "n/a"}, base | {"Origin": None}, base | {"Dest": None}]
    df = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    assert clean(df).count() == 1


def test_a_bad_date_fails(spark):
    row = dict.fromkeys(RAW_COLUMNS, "1") | {"FlightDate": "January"}
    df = spark.createDataFrame([tuple(row[c] for c in RAW_COLUMNS)], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean(df).collect()


def test_number_texts(spark):
    texts = ["15", " 15 ", "15.5", "-2.5", "1e3", "15d", "2.0f", "", None, "abc", "99999999999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", text_to_int(F.col("t")).alias("n"), text_to_double(F.col("t")).alias("x")).orderBy("i").collect()
    assert [r.n for r in out] == [15, 15, 16, -3, 1000, None, None, None, None, None, None]
    assert [r.x for r in out] == [15.0, 15.0, 15.5, -2.5, 1000.0, None, None, None, None, None, 99999999999.0]


def write_csv(folder, name, header, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(header), *lines]) + "\n")


VALUES = {c: f"v{i}" for i, c in enumerate(RAW_COLUMNS)}


def line(header, **changed):
    return ",".join((VALUES | changed).get(c, "extra") for c in header)


def test_files_with_other_column_orders_are_aligned(spark, tmp_path):
    shuffled = [*reversed(RAW_COLUMNS), "ArrDelay"]
    write_csv(tmp_path / "raw", "a.csv", RAW_COLUMNS, line(RAW_COLUMNS, Origin="BOS"))
    write_csv(tmp_path / "raw", "b.csv", shuffled, line(shuffled, Origin="ORD"), line(shuffled, Origin="LAX"))
    rows = read_raw(spark, str(tmp_path / "raw")).collect()
    assert sorted(r.Origin for r in rows) == ["BOS", "LAX", "ORD"]
    assert {r.Dest for r in rows} == {VALUES["Dest"]} and rows[0].asDict().keys() == set(RAW_COLUMNS)


def test_malformed_rows_are_dropped_and_quotes_understood(spark, tmp_path):
    write_csv(tmp_path / "raw", "a.csv", RAW_COLUMNS, line(RAW_COLUMNS), "only,three,fields",
              line(RAW_COLUMNS) + ",one too many", line(RAW_COLUMNS, Tail_Number='""', Origin='"B,OS"'))
    rows = read_raw(spark, str(tmp_path / "raw")).select("Origin", "Tail_Number").collect()
    assert sorted(r.Origin for r in rows) == ["B,OS", VALUES["Origin"]]
    assert None in {r.Tail_Number for r in rows}
    dropped = malformed_rows(spark, str(tmp_path / "raw")).collect()
    assert [r.file.rpartition("/")[2] for r in dropped] == ["a.csv"] and dropped[0].rows == 2


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    given = {"FlightDate": "2025-01-03", "CRSDepTime": "0930", "DepDelay": "20", "Cancelled": "0", "Diverted": "0"}
    write_csv(tmp_path / "raw", "a.csv", RAW_COLUMNS, line(RAW_COLUMNS, **given), "only,three,fields", line(RAW_COLUMNS, **given | {"Cancelled": "1"}))
    turned = RAW_COLUMNS[::-1]
    write_csv(tmp_path / "raw", "b.csv", turned, line(turned, **given), line(turned, **given | {"CRSDepTime": ""}), line(turned) + ",more")
    counts = full_run.counted_clean_step(spark, str(tmp_path / "raw"), str(tmp_path / "flights"))
    assert counts == {"rows_read": 6, "malformed": 2, "kept": 3, "operated": 2}
    assert tables.read_by_month(spark, str(tmp_path / "flights")).count() == 3


def test_missing_columns_are_found_in_any_file(spark, tmp_path):
    short = [c for c in RAW_COLUMNS if c != "Diverted"]
    write_csv(tmp_path / "raw", "a.csv", RAW_COLUMNS, line(RAW_COLUMNS))
    write_csv(tmp_path / "raw", "b.csv", short, line(short))
    with pytest.raises(ValueError, match="b.csv.*Diverted"):
        read_raw(spark, str(tmp_path / "raw"))
    lenient = read_raw(spark, str(tmp_path / "raw"), check_all=False).collect()
    assert sorted(str(r.Diverted) for r in lenient) == ["None", VALUES["Diverted"]]


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, str(tmp_path))


def test_dense_ids_in_scan_order_and_in_key_order(spark):
    rows = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 101).alias("k"), F.col("id").alias("v"))
    scan = dense_ids(rows).orderBy("flight_id").collect()
    assert [r.flight_id for r in scan] == list(range(1, 1001)) and [r.v for r in scan] == list(range(1000))
    keyed = dense_ids(rows, ["k"]).orderBy("flight_id").collect()
    assert [r.flight_id for r in keyed] == list(range(1, 1001))
    assert [r.k for r in keyed] == sorted(r.k for r in scan)
    copies = dense_ids(spark.range(0, 500, 1, 5).select(F.lit(1).alias("k")), ["k"])
    assert sorted(r.flight_id for r in copies.collect()) == list(range(1, 501))
