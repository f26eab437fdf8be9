"""Results that belong together: every version in a folder of its own, and a list of the complete ones.

A version is listed by one small file that is added when all its parts are written, so a reader sees all parts of one run
or those of the run before, whatever happens to a run on its way. Folders that were never listed can be deleted.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

LIST = "number long, folder string"


def new_version(path: str) -> str:
    """A folder for the parts of a new version."""
    return f"{path.rstrip('/')}/versions/{uuid.uuid4().hex}"


def published(spark: SparkSession, path: str) -> DataFrame:
    """number and folder of the complete versions."""
    try:
        return spark.read.schema(LIST).json(f"{path.rstrip('/')}/published")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LIST)


def publish(spark: SparkSession, path: str, folder: str) -> int:
    """List a version as complete; returns its number. A file is added, none is replaced."""
    number = published(spark, path).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    spark.createDataFrame([(number, folder)], LIST).coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/published")
    return number


def current(spark: SparkSession, path: str) -> str:
    """The folder of the last complete version."""
    last = published(spark, path).orderBy(F.desc("number"), "folder").first()
    if last is None:
        raise FileNotFoundError(f"no complete results in {path}")
    return last.folder
