import numpy as np

from departure_risk.operators import quantiles


def test_order_statistics_against_sorting(spark):
    rng = np.random.default_rng(2)
    columns = {"few": rng.integers(-3, 4, 3001).astype(float), "wide": rng.normal(0, 1e12, 3001) ** 3, "one": np.full(3001, -2.5),
               "gaps": np.where(rng.random(3001) < 0.4, np.nan, rng.random(3001)), "ends": rng.choice([-np.inf, 0.0, -0.0, 5e-324, 1e308, np.inf], 3001)}
    rows = spark.createDataFrame([tuple(None if np.isnan(x) and i % 2 else float(x) for x in r) for i, r in enumerate(zip(*columns.values()))],
                                 ", ".join(f"{c} double" for c in columns)).repartition(5)

    def ranks(n):
        return [0, n // 7, n // 2, n // 2, n - 1]

    got = quantiles.order_statistics(rows, list(columns), ranks)
    for c, values in columns.items():
        kept = np.sort(values[~np.isnan(values)])
        assert got[c] == [kept[r] for r in ranks(len(kept))], c


def test_medians(spark):
    rows = spark.createDataFrame([(1.0, None, 7, None), (2.0, 4.0, 3, None), (10.0, float("nan"), 4, None), (3.0, 4.5, 1, None)],
                                 "a double, b double, c int, d double")
    assert quantiles.medians(rows, ["a", "b", "c", "d"]) == {"a": 2.5, "b": 4.25, "c": 3.5}
    assert quantiles.medians(rows.limit(0), ["a"]) == {} and quantiles.order_statistics(rows, [], len) == {}
