"""Forecast quality: ranking metrics, Brier score and calibration, exact and for many models at once."""

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import LABEL
from departure_risk.operators.running import add_running_totals
from departure_risk.session import written_once


def outcomes_by_score(scored: DataFrame, groups: list[str], score: str = "p", label: str = LABEL) -> DataFrame:
    """Late and on-time counts per distinct score. Ties collapse before the shuffle.

    Written once: the cut points, the offsets and the running totals all read it, the forecasts do not
    have to be computed again.
    """
    counts = scored.groupBy(*groups, F.col(score).alias("score")).agg(
        F.sum(label).alias("late"), (F.count("*") - F.sum(label)).alias("on_time"))
    return written_once(counts, "outcomes-by-score")


def ranking_metrics(scored: DataFrame, groups: list[str], score: str = "p", label: str = LABEL,
                    pieces: int | None = None) -> DataFrame:
    """pr_auc (average precision, a step function), roc_auc (half credit for ties) and brier per group."""
    counts = outcomes_by_score(scored, groups, score, label)
    ranked = add_running_totals(counts, groups, "score", ["late", "on_time"], pieces)
    late_above = F.col("late_all") - F.col("late_before") - F.col("late")
    on_time_above = F.col("on_time_all") - F.col("on_time_before") - F.col("on_time")
    hits = late_above + F.col("late")
    flagged = hits + on_time_above + F.col("on_time")
    precision_step = F.col("late") / F.nullif(F.col("late_all"), F.lit(0)) * hits / flagged
    pairs = F.nullif(F.col("late_all").cast("double") * F.col("on_time_all"), F.lit(0.0))
    ordered_pairs = F.col("on_time") * (late_above + F.col("late") / 2) / pairs
    squares = F.col("late") * F.pow(1 - F.col("score"), 2) + F.col("on_time") * F.pow("score", 2)
    return ranked.groupBy(*groups).agg(
        F.sum(precision_step).alias("pr_auc"),
        F.sum(ordered_pairs).alias("roc_auc"),
        (F.sum(squares) / F.sum(F.col("late") + F.col("on_time"))).alias("brier"),
    )


def calibration_table(scored: DataFrame, groups: list[str], bins: int = 10, score: str = "p", label: str = LABEL,
                      pieces: int | None = None) -> DataFrame:
    """Predicted and observed rate in equal-frequency bins of the score.

    Edges are exact interpolated quantiles; equal edges merge, so tied scores never straddle two bins.
    A bin is (lower, upper]; the first one includes the minimum.
    """
    counts = outcomes_by_score(scored, groups, score, label).withColumn("flights", F.col("late") + F.col("on_time"))
    ranked = add_running_totals(counts, groups, "score", ["flights"], pieces)
    edges = F.broadcast(quantile_edges(ranked, groups, bins))
    bin_of = F.greatest(F.size(F.filter("edges", lambda e: e < F.col("score"))), F.lit(1)) - 1
    return (
        counts.join(edges, groups)
        .groupBy(*groups, bin_of.alias("bin"))
        .agg(
            F.round(F.sum(F.col("score") * F.col("flights")) / F.sum("flights"), 4).alias("predicted"),
            F.round(F.sum("late") / F.sum("flights"), 4).alias("observed"),
            F.sum("flights").alias("flights"),
        )
    )


def quantile_edges(ranked: DataFrame, groups: list[str], bins: int) -> DataFrame:
    """One row per group with the distinct edges in order: at most bins+1 values."""
    first, end = F.col("flights_before"), F.col("flights_before") + F.col("flights")

    def step(k):
        position = (F.col("flights_all") - 1) * k
        low, rest = F.floor(position / bins), position % bins
        return F.struct(k.alias("k"), low.alias("low"), (low + (rest > 0).cast("int")).alias("high"), (rest / F.lit(float(bins))).alias("share"))

    def within(rank):
        return (rank >= first) & (rank < end)

    # A score keeps only the steps whose ranks it holds, before anything is exploded.
    steps = F.filter(F.transform(F.sequence(F.lit(0), F.lit(bins)), step), lambda w: within(w["low"]) | within(w["high"]))
    wanted = ranked.select(*groups, "score", first.alias("first"), end.alias("end"), F.explode(steps).alias("w")).select(
        *groups, "score", "first", "end", "w.*")

    def held(rank: str):
        return (F.col(rank) >= F.col("first")) & (F.col(rank) < F.col("end"))

    per_step = wanted.groupBy(*groups, "k").agg(
        F.max(F.when(held("low"), F.col("score"))).alias("below"),
        F.max(F.when(held("high"), F.col("score"))).alias("above"),
        F.max("share").alias("share"),
    )
    edge = F.col("below") + (F.col("above") - F.col("below")) * F.col("share")
    return per_step.groupBy(*groups).agg(F.sort_array(F.collect_set(edge)).alias("edges"))


def by_hour(scored: DataFrame, score: str = "p", label: str = LABEL) -> DataFrame:
    """Observed and predicted rate by scheduled hour."""
    return scored.groupBy("dep_hour").agg(
        F.round(F.avg(label), 4).alias("observed"),
        F.round(F.avg(score), 4).alias("predicted"),
        F.count("*").alias("flights"),
    ).orderBy("dep_hour")
