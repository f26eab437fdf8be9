"""Fit, recalibrate and measure every model on the same time split."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import ABLATIONS, LABEL, RECALIBRATION_DAYS
from departure_risk.operators.cube import prediction_cube
from departure_risk.operators.forecast import base_rate, route_forecast
from departure_risk.operators.metrics import by_hour, calibration_table, ranking_metrics
from departure_risk.operators.recalibrate import recalibrate
from departure_risk.operators.snapshot import snapshot
from departure_risk.operators.split import Split, find_split, only, split_summary
from departure_risk.plans.boosting import LEAVES, MOST_TREES, PATIENCE
from departure_risk.plans.models import BoostedModel, fit_logistic, fit_together, importance, prepare, probability
from departure_risk.session import written_once

# Names of the models in the metrics.
TREES = {"base": "gradient_boosting_base", "v2": "gradient_boosting_v2", "full": "gradient_boosting"}
RECALIBRATED = "gradient_boosting_recalibrated"
FORECAST_COLUMNS = ["flight_id", "flight_date", "carrier", "origin", "dest", "dep_hour", LABEL]


@dataclass
class Trained:
    """Models and the forecasts of the validation and test period they were judged on."""

    split: Split
    base: float
    model: BoostedModel
    rounds: int
    forecasts: DataFrame
    metrics: DataFrame
    features: DataFrame


def train(features: DataFrame, most: int = MOST_TREES, leaves: int = LEAVES, ablations: tuple[str, ...] = ("base", "v2"),
          patience: int = PATIENCE) -> Trained:
    """Baselines, ablations and the full model.

    `features` should be a written table. All tree models grow from the same blocks, side by side. Forecasts of all models are written
    once, so metrics, cube and calibration never score a flight twice.
    """
    split = find_split(features)
    training, validation, test = (only(features, split, part) for part in ("train", "valid", "test"))
    base = base_rate(features, split)
    held_out = validation.unionByName(test)

    scored = [route_forecast(test, base).select(*FORECAST_COLUMNS, "p", F.lit("route_history").alias("model"))]
    logistic = fit_logistic(training)
    scored.append(_named(probability(logistic, test), "logistic_regression"))
    prepared = prepare(training, validation, ABLATIONS["full"])
    fits = fit_together(prepared, {n: ABLATIONS[n] for n in [*ablations, "full"]}, most=most, leaves=leaves, patience=patience)
    for name, (model, _) in fits.items():
        scored.append(_named(probability(model, held_out if name == "full" else test), TREES[name]))
    model, best = fits["full"]
    forecasts = scored[0]
    for more in scored[1:]:
        forecasts = forecasts.unionByName(more)
    forecasts = written_once(forecasts, "forecasts")

    full = forecasts.filter(F.col("model") == TREES["full"])
    adjusted = recalibrate(full, split.test_start).withColumns({
        "p": F.col("p_recalibrated"), "model": F.lit(RECALIBRATED)}).select(*FORECAST_COLUMNS, "p", "model")
    forecasts = forecasts.unionByName(written_once(adjusted, "recalibrated"))
    metrics = ranking_metrics(only(forecasts, split, "test"), ["model"])
    return Trained(split, base, model, best, forecasts, metrics, features)


def _named(scored: DataFrame, name: str) -> DataFrame:
    return scored.select(*FORECAST_COLUMNS, "p", F.lit(name).alias("model"))


def test_forecasts(trained: Trained, model: str = RECALIBRATED) -> DataFrame:
    return only(trained.forecasts, trained.split, "test").filter(F.col("model") == model)


def test_cube(trained: Trained) -> DataFrame:
    return prediction_cube(test_forecasts(trained))


def serving_snapshot(trained: Trained) -> DataFrame:
    return snapshot(trained.features, trained.split.last)


def metrics_document(trained: Trained) -> DataFrame:
    """One nested row: split, scores of every model, calibration, rates by hour, importance.

    Every part is a small aggregate, so the row is bounded by models, bins, hours and columns.
    """
    raw, final = test_forecasts(trained, TREES["full"]), test_forecasts(trained)
    data = trained.features.agg(
        F.min("flight_date").cast("string").alias("first_day"), F.max("flight_date").cast("string").alias("last_day"))
    parts = split_summary(trained.features, trained.split).select(
        "split", F.struct("flights", F.col("first_day").cast("string").alias("from"),
                          F.col("last_day").cast("string").alias("to")).alias("part"))
    rates = final.agg(F.round(F.avg(LABEL), 4).alias("observed"), F.round(F.avg("p"), 4).alias("mean_recalibrated"))
    raw_rate = raw.agg(F.round(F.avg("p"), 4).alias("mean_raw"))

    def listed(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
        cells = F.sort_array(F.collect_list(F.struct(*order, *columns)))
        return rows.agg(F.transform(cells, lambda r: F.struct(*[r[c].alias(c) for c in columns])).alias("rows"))

    calibration = ["predicted", "observed", "flights"]
    share = importance(trained.model, trained.features)
    by_model = trained.metrics.agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("model", F.struct("pr_auc", "roc_auc", "brier"))))).alias("m"))
    by_part = parts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("split", "part")))).alias("m"))
    return data.select(
        F.struct(
            "first_day", "last_day", by_part.scalar().alias("splits"),
            F.lit(round(trained.base, 4)).alias("train_delay_rate"),
            rates.select("observed").scalar().alias("test_delay_rate"),
        ).alias("data"),
        by_model.scalar().alias("test_metrics"),
        F.lit(trained.rounds).alias("best_iteration"),
        listed(calibration_table(final, ["model"]), ["bin"], calibration).scalar().alias("calibration"),
        listed(calibration_table(raw, ["model"]), ["bin"], calibration).scalar().alias("calibration_raw"),
        F.struct(
            F.lit(RECALIBRATION_DAYS).alias("window_days"), raw_rate.scalar().alias("mean_raw"),
            rates.select("mean_recalibrated").scalar().alias("mean_recalibrated"),
            rates.select("observed").scalar().alias("observed"),
        ).alias("recalibration"),
        listed(by_hour(final), [], ["dep_hour", "observed", "predicted", "flights"]).scalar().alias("by_hour"),
        listed(share.withColumn("rank", -F.col("share")), ["rank"], ["feature", "share"]).scalar().alias("importance"),
    )
