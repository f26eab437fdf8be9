"""Logistic regression and boosted trees, and the matrix of inputs they read."""

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from departure_risk.config import CATEGORICAL, LABEL, NUMERIC
from departure_risk.operators.quantiles import medians
from departure_risk.plans import boosting
from departure_risk.session import shared_dir, written_once

# Below every real value, so that one split can set missing values apart.
MISSING = -9999.0
INPUT = "inputs"


def as_doubles(columns: list[str], missing: str) -> SQLTransformer:
    """Numeric columns as `{c}_in` doubles. A stage of the pipeline, so it is saved with the model."""
    casts = ", ".join(missing.format(f"CAST({c} AS DOUBLE)") + f" AS {c}_in" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__")


def category_indexer(columns: list[str]) -> StringIndexer:
    """Dictionary of the sorted training values; unseen and null share one extra index."""
    return StringIndexer(inputCols=columns, outputCols=[f"{c}_ix" for c in columns],
                         stringOrderType="alphabetAsc", handleInvalid="keep")


def matrix_pipeline(columns: list[str]) -> Pipeline:
    """Model input of the trees: category indexes and doubles with a marker for missing."""
    categories = [c for c in columns if c in CATEGORICAL]
    numbers = [c for c in columns if c in NUMERIC]
    return Pipeline(stages=[
        category_indexer(categories),
        as_doubles(numbers, f"coalesce({{}}, {MISSING}D)"),
        VectorAssembler(inputCols=[f"{c}_ix" for c in categories] + [f"{c}_in" for c in numbers], outputCol=INPUT),
    ])


def categories_of(matrix: PipelineModel) -> dict[str, list[str]]:
    indexer = matrix.stages[0]
    return dict(zip(CATEGORICAL, [list(labels) for labels in indexer.labelsArray]))


@dataclass
class BoostedModel:
    """The matrix of inputs and the trees over it."""

    matrix: PipelineModel
    booster: boosting.Booster

    def probability(self, rows: DataFrame, name: str) -> DataFrame:
        inputs = self.matrix.transform(rows).withColumn(INPUT, vector_to_array(INPUT))
        return inputs.select(*rows.columns, self.booster.probability(rows.sparkSession, F.col(INPUT)).alias(name))

    def save(self, spark: SparkSession, path: str) -> None:
        self.matrix.write().overwrite().save(f"{path}/matrix")
        self.booster.save(spark, f"{path}/trees")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedModel":
        return BoostedModel(PipelineModel.load(f"{path}/matrix"), boosting.Booster.load(spark, f"{path}/trees"))


@dataclass
class Prepared:
    """Training and validation rows in blocks over `columns`, written once for several fits."""

    matrix: PipelineModel
    booster: boosting.Booster
    blocks: DataFrame


def prepare(train: DataFrame, valid: DataFrame, columns: list[str], key: str = "flight_id") -> Prepared:
    """`key` tells rows apart when the rows of a tree are drawn."""
    matrix = matrix_pipeline(columns).fit(train)
    inputs = matrix.stages[-1].getInputCols()
    names = [c.rsplit("_", 1)[0] for c in inputs]
    categories = {c: len(labels) for c, labels in categories_of(matrix).items()}
    booster = boosting.find_cuts(matrix.transform(train), inputs, names, categories, MISSING)
    rate = train.agg(F.avg(F.col(LABEL).cast("double"))).first()[0]
    booster.base = math.log(rate / (1 - rate))
    parts = [boosting.blocks_of(matrix.transform(rows).select(
        vector_to_array(INPUT), F.col(LABEL).cast("long"), F.xxhash64(key)), booster, held_out) for rows, held_out in ((train, False), (valid, True))]
    return Prepared(matrix, booster, written_once(parts[0].unionByName(parts[1]), "boosting-blocks"))


def fit_prepared(prepared: Prepared, columns: list[str], most: int = boosting.MOST_TREES, leaves: int = boosting.LEAVES,
                 patience: int = boosting.PATIENCE) -> tuple[BoostedModel, int]:
    """Boosted trees, as many as the validation period asks for, and that number."""
    booster = boosting.boost(prepared.blocks, prepared.booster, columns, most, leaves, patience)
    return BoostedModel(prepared.matrix, booster), len(booster.trees)


def fit_trees(train: DataFrame, valid: DataFrame, columns: list[str], **options) -> tuple[BoostedModel, int]:
    return fit_prepared(prepare(train, valid, columns), columns, **options)


def fit_together(prepared: Prepared, of_columns: dict[str, list[str]], at_once: int = 3, **options) -> dict[str, tuple[BoostedModel, int]]:
    """Several fits of the same rows, by one job where their blocks fit the memory of the tasks that run at once.

    Else `at_once` at a time, each in a scheduler pool of its own (fair where the session says so). Such a fit is many short jobs, so fits that overlap use the executors that one alone leaves idle. Results do not depend on it.
    """
    if held := boosting.boost_held(prepared.blocks, prepared.booster, of_columns, **options):
        return {name: (BoostedModel(prepared.matrix, booster), len(booster.trees)) for name, booster in held.items()}
    context = prepared.blocks.sparkSession.sparkContext

    def fit(name: str) -> tuple[BoostedModel, int]:
        context.setLocalProperty("spark.scheduler.pool", name)
        return fit_prepared(prepared, of_columns[name], **options)

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(of_columns, pool.map(fit, of_columns)))


def fit_logistic(train: DataFrame, rounds: int = 500) -> PipelineModel:
    """Exact median impute, standardise, logistic regression with a unit L2 penalty on the summed loss.

    Spark averages the loss, so the penalty is divided by the rows. Columns without any value are left out.
    A model just fitted holds its training summary and with it the session, which tasks cannot get once anything was observed
    in it; the model is saved and read back without them.
    """
    middle = medians(train, NUMERIC)
    numbers = [c for c in NUMERIC if c in middle]
    filled = ", ".join(f"coalesce(nanvl(CAST({c} AS DOUBLE), NULL), {middle[c]!r}D) AS {c}_filled" for c in numbers)
    fitted = Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}_filled" for c in numbers], outputCol="filled"),
        StandardScaler(inputCol="filled", outputCol=INPUT, withMean=True, withStd=True),
        LogisticRegression(featuresCol=INPUT, labelCol=LABEL, maxIter=rounds, regParam=1.0 / train.count(),
                           standardization=False),
    ]).fit(train)
    path = f"{shared_dir(train.sparkSession).rstrip('/')}/logistic-{uuid.uuid4().hex}"
    fitted.write().save(path)
    return PipelineModel.load(path)


def probability(model: PipelineModel | BoostedModel, rows: DataFrame, name: str = "p") -> DataFrame:
    """The input columns and the probability of leaving late."""
    if isinstance(model, BoostedModel):
        return model.probability(rows, name)
    return model.transform(rows).select(*rows.columns, vector_to_array("probability")[1].alias(name))


def importance(model: BoostedModel, rows: DataFrame) -> DataFrame:
    """Share of the trees' gain per input column, largest first."""
    gains = model.booster.gains()
    whole = sum(gains.values()) or 1.0
    shares = [(c, gain / whole) for c, gain in gains.items()]
    return rows.sparkSession.createDataFrame(shares, "feature string, share double").select(
        "feature", F.round("share", 4).alias("share")).orderBy(F.desc("share"), "feature")
