"""Which months to land, which are there already, and unpacking the archives."""

import io
import json
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from departure_risk.sources.stores import can_open, opened

LANDED = r"ontime_(\d{4})_(\d{2})"
LINES_PER_BATCH = 20_000
LINES = "path string, line_no long, value string"


def months_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """(year, month) of every month from that of `first` to that of `last`; an error if the months are reversed."""
    spine = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))
    reversed_bounds = F.raise_error(F.concat(
        F.lit("no months run from "), F.date_format(first, "yyyy-MM"), F.lit(" to "), F.date_format(last, "yyyy-MM")))
    checked = F.when(F.trunc(first, "month") <= F.trunc(last, "month"), spine).otherwise(reversed_bounds.cast("array<date>"))
    months = bounds.select(F.explode(checked).alias("m"))
    return months.select(F.year("m").alias("year"), F.month("m").alias("month"))


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The same between two 'yyyy-MM' labels."""
    if start > end:
        raise ValueError(f"no months run from {start} to {end}")
    bounds = spark.range(1).select(
        F.to_date(F.lit(f"{start}-01")).alias("first"), F.to_date(F.lit(f"{end}-01")).alias("last"))
    return months_between(bounds, "first", "last")


def month_of(path: Column) -> list[Column]:
    return [F.regexp_extract(path, LANDED, 1).try_cast("int").alias("year"),
            F.regexp_extract(path, LANDED, 2).try_cast("int").alias("month")]


def landed_months(spark: SparkSession, folder: str) -> DataFrame:
    """Months with a landed file, told by name; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(*month_of(F.col("path"))).dropna().distinct()


def months_to_land(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    return wanted.join(landed, ["year", "month"], "left_anti")


class ArchivedLines(DataSource):
    """The text lines of archives, exactly one CSV in each. The option `paths` is a JSON list; each archive is a partition.

    Tasks read the archive's directory and then its member piece by piece, so an archive of any size takes little memory.
    """

    @classmethod
    def name(cls) -> str:
        return "archived_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return ArchivedLinesReader(json.loads(self.options["paths"]))


class ArchivedLinesReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(path) for path in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        with opened(partition.value) as file:
            yield from _lines(partition.value, file)


def unpack(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Archives to text lines (path, line_no, value), one archive a partition.

    Where tasks cannot open the archives themselves, Spark reads each whole into a row (up to 2 GB) first.
    """
    if can_open(paths[0]):
        spark.dataSource.register(ArchivedLines)
        return spark.read.format(ArchivedLines.name()).option("paths", json.dumps(paths)).load()

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.to_pylist():
                yield from _lines(archive["path"], io.BytesIO(archive["content"]))

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(lines, LINES)


def _lines(path: str, archive: BinaryIO) -> Iterator[pa.RecordBatch]:
    with zipfile.ZipFile(archive) as packed:
        names = [n for n in packed.namelist() if n.lower().endswith(".csv")]
        if len(names) != 1:
            raise ValueError(f"{path} should hold a single CSV and holds {len(names)}: {names}")
        with io.TextIOWrapper(packed.open(names[0]), encoding="utf-8") as text:
            yield from _batched(path, text)


def _batched(path: str, text: Iterator[str]) -> Iterator[pa.RecordBatch]:
    start, lines = 0, []
    for line in text:
        lines.append(line.rstrip("\r\n"))
        if len(lines) == LINES_PER_BATCH:
            yield _batch(path, start, lines)
            start, lines = start + len(lines), []
    if lines:
        yield _batch(path, start, lines)


def _batch(path: str, start: int, lines: list[str]) -> pa.RecordBatch:
    numbers = pa.array(range(start, start + len(lines)), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(lines)), numbers, pa.array(lines, pa.string())], names=["path", "line_no", "value"])


def landed_name(archive: Column) -> Column:
    """`..._2025_1.zip` -> `ontime_2025_01`."""
    year, month = (F.regexp_extract(archive, r"(\d{4})_(\d{1,2})\.zip$", i) for i in (1, 2))
    return F.concat(F.lit("ontime_"), year, F.lit("_"), F.lpad(month, 2, "0"))


def land(spark: SparkSession, archive_folder: str, raw_folder: str) -> int:
    """Unpack the archives of months that are not landed yet; returns how many months were added.

    Archives carry `..._YYYY_M.zip` names. Each month becomes `file=ontime_YYYY_MM/` with its lines in
    order, header first. Only the archives still needed are read. An archive without a month in its name, or
    two of one month, are an error before anything is written.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(archive_folder).select("path")
    todo = names.select("path", *month_of(landed_name(F.col("path"))))
    unclear = todo.groupBy("year", "month").agg(F.min("path").alias("path"), F.count("*").alias("archives")).where(
        "year is null or month not between 1 and 12 or archives > 1").orderBy("path").limit(5).collect()
    if unclear:
        raise ValueError("each archive needs a month of its own in its name: " + ", ".join(row.path for row in unclear))
    try:
        todo = months_to_land(todo, landed_months(spark, raw_folder))
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    paths = [row.path for row in todo.collect()]
    if paths:
        lines = unpack(spark, paths).withColumn("file", landed_name(F.col("path")))
        ordered = lines.sortWithinPartitions("file", "line_no").select("file", "value")
        ordered.write.mode("append").partitionBy("file").text(raw_folder)
    return len(paths)
