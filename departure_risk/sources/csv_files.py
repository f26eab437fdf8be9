"""Raw monthly CSV files: listing, header checks and one aligned text table."""

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from departure_risk.config import RAW_COLUMNS
from departure_risk.sources.stores import can_open, first_line

RAW_FILES = "*.{csv,txt}"
HEADER_READERS = 16
#: Files whose first lines one task reads.
FILES_PER_TASK = 64
BROKEN = "_broken"


def list_files(spark: SparkSession, folder: str, pattern: str = RAW_FILES) -> list[str]:
    """Sorted paths of the raw files; only names are read."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(folder).select("path")
    )
    paths = sorted(row.path for row in listing.collect())
    if not paths:
        raise FileNotFoundError(f"no raw files in {folder}; land them first")
    return paths


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of one file; Spark reads its first line only."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and line: the first line of every file, by one job that reads no more than the lines."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [first_line(path) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], names=["path", "line"])

    tasks = -(-len(paths) // FILES_PER_TASK)
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks).mapInArrow(read, "path string, line string")


def headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """The columns of every file. Spark parses one file of each distinct first line.

    Where tasks cannot open the files themselves, Spark reads the header of every file.
    """
    if can_open(paths[0]):
        line_of = dict(first_lines(spark, paths).collect())
    else:
        line_of = {path: path for path in paths}
    example = {line: path for path, line in sorted(line_of.items(), reverse=True)}
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        columns = dict(zip(example, pool.map(lambda p: tuple(header(spark, p)), example.values())))
    return {path: columns[line_of[path]] for path in paths}


def check_columns(by_path: dict[str, tuple[str, ...]], required: list[str] = RAW_COLUMNS) -> None:
    """Every file must name every required column."""
    for path, columns in by_path.items():
        missing = [c for c in required if c not in columns]
        if missing:
            raise ValueError(f"{path} lacks the columns {missing}")


def by_header(by_path: dict[str, tuple[str, ...]]) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, columns in by_path.items():
        groups.setdefault(columns, []).append(path)
    return groups


def _parts(spark: SparkSession, by_path: dict[str, tuple[str, ...]]) -> Iterator[tuple[tuple[str, ...], DataFrame]]:
    """Per distinct header its columns and the rows of its files as text, broken lines in the column BROKEN."""
    for columns, paths in by_header(by_path).items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, BROKEN]])
        yield columns, (spark.read.schema(schema).option("header", True).option("escape", '"').option("columnNameOfCorruptRecord", BROKEN)
                        .option("columnPruning", False).csv(paths))


def malformed_rows(spark: SparkSession, folder: str, pattern: str = RAW_FILES) -> DataFrame:
    """file and rows: how many rows of each file `read_raw` drops for too few or too many fields."""
    united = None
    for columns, rows in _parts(spark, headers(spark, list_files(spark, folder, pattern))):
        # Spark wants another column beside the broken line itself
        broken = F.when(F.col(BROKEN).isNotNull(), F.coalesce(F.col(columns[0]), F.lit("")))
        part = rows.select("_metadata.file_path", broken.alias("broken"))
        united = part if united is None else united.unionAll(part)
    return united.groupBy(F.col("file_path").alias("file")).agg(F.count("broken").alias("rows"))


def read_raw(spark: SparkSession, folder: str, pattern: str = RAW_FILES, check_all: bool = True,
             counts: Observation | None = None) -> DataFrame:
    """All raw files as one table of text columns, aligned by name.

    A single read over files whose headers differ in order would shift values silently, so files are read
    per distinct header and united by name. With `check_all=False` only the first file must be complete;
    a column another file lacks is null there. Rows with too few or too many fields are dropped (`malformed_rows`
    counts them by file), which needs the parser to see whole rows rather than the pruned columns. `counts` gets
    `rows_read` and `malformed` from the first action on the result.
    """
    by_path = headers(spark, list_files(spark, folder, pattern))
    first = next(iter(by_path))
    check_columns(by_path if check_all else {first: by_path[first]})
    raw = None
    for columns, part in _parts(spark, by_path):
        part = part.select(*[c for c in RAW_COLUMNS if c in columns], BROKEN)
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    if counts is not None:
        raw = raw.observe(counts, F.count(F.lit(1)).alias("rows_read"), F.count(BROKEN).alias("malformed"))
    return raw.where(F.col(BROKEN).isNull()).select(*RAW_COLUMNS)
