import pytest
from pyspark.sql import functions as F

from departure_risk.session import local_session

WORDS = ("amber birch cedar delta ember frost grove heron inlet jolly knoll larch maple north ocean pearl quiet river "
         "stone trail umber vivid willow xenon yield zephyr").split()


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session


def sentence(rng, n):
    return " ".join(rng.choice(WORDS, n))


def table(spark, rows, schema="doc_id long, text string"):
    """Rows with extra columns whose names the operators could use themselves."""
    out = spark.createDataFrame(rows, schema)
    return out.withColumns({c: F.lit("other") for c in ("id", "label", "task", "words", "size", "copy", "block", "score", "line", "n", "__row")
                            if c not in out.columns})


def values(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows.collect()), key=repr)
