"""Queries that train a model. SQL says everything but the learned probabilities: those must lie between 0 and 1."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from checks.catalog import check
from departure_risk.config import CATEGORICAL, MODEL_COLUMNS, NUMERIC
from departure_risk.operators import quantiles
from departure_risk.operators.split import only
from departure_risk.plans import boosting, models, training
from departure_risk.plans.scoring import score_requests
from departure_risk.plans.serving import fresh_snapshot
from departure_risk.session import written_once

# One training run per session and folder, with the library's own settings, serves all of them.
_RUNS: dict[tuple[str, str], training.Trained] = {}


def _parts(d):
    features = written_once(d.features, "features")
    return features, [only(features, d.split, p) for p in ("train", "valid", "test")]


def _trained(d):
    key = (d.spark.sparkContext.applicationId, d.folder)
    if key not in _RUNS:
        _RUNS[key] = training.train(written_once(d.features, "features"))
    return _RUNS[key]


_CODES = "\n".join(f"LEFT JOIN categories k_{c} ON k_{c}.name = '{c}' AND k_{c}.value = f.{c}" for c in CATEGORICAL)
_UNSEEN = "(SELECT max(unseen) FROM categories WHERE name = '{0}')"


@check("p22_model_matrix", ["features", "categories", "split"], f"""
    SELECT flight_id, {", ".join(f"CAST(coalesce(k_{c}.ix, {_UNSEEN.format(c)}) AS DOUBLE) AS {c}_ix" for c in CATEGORICAL)},
        {", ".join(f"round(coalesce(CAST({c} AS DOUBLE), -9999), 6) AS {c}_in" for c in NUMERIC)}
    FROM features f {_CODES} WHERE flight_date >= (SELECT test_start FROM split)""")
def _(d):
    _, (train, _, test) = _parts(d)
    matrix = models.matrix_pipeline(MODEL_COLUMNS).fit(train).transform(test)
    inputs = vector_to_array(models.INPUT)
    names = [f"{c}_ix" for c in CATEGORICAL] + [f"{c}_in" for c in NUMERIC]
    return matrix.select("flight_id", *[F.round(inputs[i], 6).alias(n) for i, n in enumerate(names)])


_TEST_FLIGHTS = "SELECT flight_id, delayed, true AS is_probability FROM parts WHERE split = 'test'"


def _probability():
    return F.col("p").between(0, 1).alias("is_probability")


@check("m3_logistic_regression", ["parts"], _TEST_FLIGHTS)
def _(d):
    _, (train, _, test) = _parts(d)
    return models.probability(models.fit_logistic(train), test).select("flight_id", "delayed", _probability())


@check("m4_boosted_trees", ["parts"], _TEST_FLIGHTS)
def _(d):
    return training.test_forecasts(_trained(d), training.TREES["full"]).select("flight_id", "delayed", _probability())


@check("m5_ablation_scores", ["parts"], """
    SELECT model, true AS in_range, (SELECT count(*) FROM parts WHERE split = 'test') AS flights
    FROM (VALUES ('route_history'), ('logistic_regression'), ('gradient_boosting_base'), ('gradient_boosting_v2'),
        ('gradient_boosting'), ('gradient_boosting_recalibrated')) AS models(model)""")
def _(d):
    trained = _trained(d)
    flights = only(trained.forecasts, trained.split, "test").groupBy("model").agg(F.count("*").alias("flights"))
    in_range = F.greatest("pr_auc", "roc_auc", "brier").between(0, 1) & (F.least("pr_auc", "roc_auc", "brier") > 0)
    return trained.metrics.join(flights, "model").select("model", in_range.alias("in_range"), "flights")


@check("m6_unseen_categories", ["parts"], """
    SELECT p.origin, CAST(coalesce(max(k.ix), (SELECT count(DISTINCT origin) FROM parts WHERE split = 'train' AND origin <> 'A2'))
        AS DOUBLE) AS ix, count(*) AS flights
    FROM parts p LEFT JOIN (SELECT origin, row_number() OVER (ORDER BY origin) - 1 AS ix
        FROM (SELECT DISTINCT origin FROM parts WHERE split = 'train' AND origin <> 'A2')) k USING (origin)
    WHERE split = 'test' GROUP BY p.origin""")
def _(d):
    train, test = only(d.operated, d.split, "train"), only(d.operated, d.split, "test")
    indexer = models.category_indexer(["origin"]).fit(train.filter("origin <> 'A2'"))
    return indexer.transform(test).groupBy("origin").agg(F.max("origin_ix").alias("ix"), F.count("*").alias("flights"))


@check("m10_batch_scores", ["matched"], """
    SELECT request_id, status, round(route_rate, 4) AS route_history_rate, status = 'ok' AS has_probability FROM matched""")
def _(d):
    scored = score_requests(d.requests, fresh_snapshot(d.stored, d.last_operated_day), _trained(d).model)
    return scored.select("request_id", "status", "route_history_rate",
                         F.coalesce(F.col("delay_probability").between(0, 1), F.lit(False)).alias("has_probability"))


@check("a20_importance", ["features"], f"""
    SELECT CAST({len(MODEL_COLUMNS)} AS BIGINT) AS columns, true AS adds_up, true AS in_order, true AS are_gains FROM features LIMIT 1""")
def _(d):
    """Shares in the order given, against the gains of the splits themselves."""
    trained = _trained(d)
    listed = training.metrics_document(trained).select(F.posexplode("importance").alias("place", "entry")).select("place", "entry.*")
    booster = trained.model.booster
    splits = [(booster.columns[c], g) for t in booster.trees for c, left, g in zip(t.column, t.left, t.gain) if left >= 0]
    gains = d.spark.createDataFrame(splits, "feature string, gain double").groupBy("feature").agg(F.sum("gain").alias("gain"))
    whole = max(sum(g for _, g in splits), 1e-300)
    both = listed.join(gains, "feature", "left").withColumns({
        "before": F.lag("share").over(Window.orderBy("place")), "own": F.coalesce(F.col("gain"), F.lit(0.0)) / whole})
    return both.agg(F.count_distinct("feature").alias("columns"), F.sum("share").between(0.99, 1.01).alias("adds_up"),
                    F.bool_and(F.col("before").isNull() | (F.col("before") >= F.col("share"))).alias("in_order"),
                    F.bool_and(F.abs(F.col("own") - F.col("share")) < 0.0001).alias("are_gains"))


_BINS, _UNIT = boosting.BINS, boosting.UNIT
_CANDIDATES = f"""
    t AS (SELECT features.* FROM features, split WHERE flight_date >= start AND flight_date < valid_start),
    rate AS (SELECT 1 / (1 + exp(-ln(r / (1 - r)))) AS p FROM (SELECT avg(delayed) AS r FROM t)),
    unit AS (SELECT round((p - 1) * {_UNIT}) AS late, round(p * {_UNIT}) AS timely, round(p * (1 - p) * {_UNIT}) AS h FROM rate),
    v AS (SELECT * FROM (SELECT delayed, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)} FROM t)
          UNPIVOT INCLUDE NULLS (v FOR feature IN ({", ".join(NUMERIC)}))),
    placed AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS r, count(*) OVER (PARTITION BY feature) AS n
               FROM v WHERE v IS NOT NULL),
    cuts AS (SELECT DISTINCT feature, v FROM placed JOIN range(1, {_BINS}) AS k(k) ON r = (k * n + {_BINS - 1}) // {_BINS}
             UNION SELECT feature, max(v) FROM placed GROUP BY feature),
    running AS (SELECT feature, v, sum(n) OVER o AS n, sum(ones) OVER o AS ones
                FROM (SELECT feature, v, count(*) AS n, sum(delayed) AS ones FROM v WHERE v IS NOT NULL GROUP BY feature, v)
                WINDOW o AS (PARTITION BY feature ORDER BY v)),
    missing AS (SELECT feature, count(*) FILTER (WHERE v IS NULL) AS n, coalesce(sum(delayed) FILTER (WHERE v IS NULL), 0) AS ones,
                       count(*) AS all_n, sum(delayed) AS all_ones FROM v GROUP BY feature),
    numbers AS (SELECT feature, s.n + side * m.n AS n, s.ones + side * m.ones AS ones, all_n, all_ones, 0 AS penalty
                FROM running s JOIN cuts USING (feature, v) JOIN missing m USING (feature), range(0, 2) AS x(side)),
    c AS (SELECT * FROM (SELECT delayed, {", ".join(CATEGORICAL)} FROM t) UNPIVOT INCLUDE NULLS (v FOR feature IN ({", ".join(CATEGORICAL)}))),
    codes AS (SELECT feature, v, count(*) AS n, sum(delayed) AS ones FROM c GROUP BY feature, v),
    named AS (SELECT feature, sum(n) OVER o AS n, sum(ones) OVER o AS ones, sum(n) OVER w AS all_n, sum(ones) OVER w AS all_ones, 10 AS penalty
              FROM codes, unit WINDOW w AS (PARTITION BY feature), o AS (PARTITION BY feature ORDER BY
              (ones * late + (n - ones) * timely) / (n * h + {boosting.CATEGORY_SMOOTHING} * {_UNIT}), v IS NULL, v ROWS UNBOUNDED PRECEDING))"""


def _strength(n: str, ones: str, penalty: str) -> str:
    return f"power(({ones} * late + ({n} - {ones}) * timely) / {_UNIT}, 2) / ({n} * h / {_UNIT} + {penalty})"


@check("m4_root_splits", ["features", "split"], f"""
    SELECT * FROM (WITH {_CANDIDATES}
    SELECT feature, round(max(gain), 6) AS gain FROM (
        SELECT feature, {_strength("n", "ones", "penalty")} + {_strength("(all_n - n)", "(all_ones - ones)", "penalty")}
            - {_strength("all_n", "all_ones", "0")} AS gain
        FROM (SELECT * FROM numbers UNION ALL SELECT * FROM named), unit
        WHERE n >= {boosting.LEAF_ROWS} AND all_n - n >= {boosting.LEAF_ROWS})
    GROUP BY feature HAVING max(gain) > 1e-12)""")
def _(d):
    """The best gain of every column when the first tree opens its root on all training rows."""
    _, (train, valid, _) = _parts(d)
    prepared = models.prepare(train, valid, MODEL_COLUMNS)
    root = boosting.Tree()
    root.add()
    columns = list(range(len(prepared.booster.columns)))
    found, _ = boosting.splits(prepared.blocks, prepared.booster, [], root, [0], columns, 0, 1.0, boosting.LEAF_ROWS, boosting.SEED)
    gains = [(prepared.booster.columns[c], s["gain"]) for (node, c), s in found.items() if node == 0 and s]
    return d.spark.createDataFrame(gains, "feature string, gain double").withColumn("gain", F.round("gain", 6))


@check("m3_medians", ["features", "split"], f"""
    SELECT feature, round(median(v), 6) AS median FROM (
        UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)} FROM features, split
                 WHERE flight_date >= start AND flight_date < valid_start)
        ON {", ".join(NUMERIC)} INTO NAME feature VALUE v) GROUP BY feature""")
def _(d):
    """What the logistic regression puts in place of missing values."""
    _, (train, _, _) = _parts(d)
    found = quantiles.medians(train, NUMERIC)
    return d.spark.createDataFrame(list(found.items()), "feature string, median double").withColumn("median", F.round("median", 6))


@check("m9_metrics_document", ["parts", "features"], """
    SELECT (SELECT CAST(min(flight_date) AS VARCHAR) FROM features) AS first_day, (SELECT CAST(max(flight_date) AS VARCHAR) FROM features) AS last_day,
        count(*) FILTER (WHERE split = 'train') AS train_flights, count(*) FILTER (WHERE split = 'test') AS test_flights,
        round(avg(delayed) FILTER (WHERE split = 'train'), 4) AS train_rate, round(avg(delayed) FILTER (WHERE split = 'test'), 4) AS test_rate,
        count(*) FILTER (WHERE split = 'test') AS calibrated, count(*) FILTER (WHERE split = 'test') AS by_hour FROM parts""")
def _(d):
    page = training.metrics_document(_trained(d))
    flights = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda n, row: n + row["flights"])
    return page.select(
        "data.first_day", "data.last_day", F.col("data.splits")["train"]["flights"].alias("train_flights"),
        F.col("data.splits")["test"]["flights"].alias("test_flights"), F.col("data.train_delay_rate").alias("train_rate"),
        F.col("data.test_delay_rate").alias("test_rate"), flights("calibration").alias("calibrated"), flights("by_hour").alias("by_hour"))
