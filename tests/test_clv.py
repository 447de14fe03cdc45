"""Value models: likelihoods, fits and scoring."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from conftest import by_key
from pyspark.sql import functions as F

from patronlens.functions.special import hyp2f1, log_gamma
from patronlens.operators import clv
from patronlens.sources.staging import stage

PURCHASE = {"r": 0.243, "alpha": 30.898, "a": 0.793, "b": 2.426}
VALUE = {"p": 6.25, "q": 3.74, "v": 15.44}


def test_log_gamma_slope_and_curvature():
    points = np.array([10.0 ** (k / 4) for k in range(-30, 40)])
    value, slope, curvature = log_gamma(points)
    for z, found in zip(points, value):
        assert abs(found - math.lgamma(z)) <= 1e-12 * max(1.0, abs(math.lgamma(z)))
    inner = points[(points > 1e-2) & (points < 1e4)]
    step = inner * 1e-5
    above, here, below = (log_gamma(inner + d * step) for d in (1, 0, -1))
    assert np.allclose((above[0] - below[0]) / (2 * step), here[1], rtol=1e-6, atol=1e-6)
    assert np.allclose((above[1] - below[1]) / (2 * step), here[2], rtol=1e-6, atol=1e-6)
    assert [g[0] for g in log_gamma(np.array([1.0]))][1:] == pytest.approx((-0.5772156649015329, math.pi**2 / 6), abs=1e-12)


def test_hypergeometric_series(spark):
    """Closed forms: ln(1+z)-like, a power, and the exponent rule."""
    df = spark.createDataFrame([(z,) for z in (0.0, 0.1, 0.5, 0.9, 0.99)], "z double")
    one, z = F.lit(1.0), F.col("z")
    out = df.select("z", hyp2f1(one, one, F.lit(2.0), z).alias("log"), hyp2f1(F.lit(0.3), one, one, z).alias("pow"))
    for row in out.collect():
        z_value = row["z"]
        expected = 1.0 if z_value == 0 else -math.log(1 - z_value) / z_value
        assert row["log"] == pytest.approx(expected, rel=1e-11)
        assert row["pow"] == pytest.approx((1 - z_value) ** -0.3, rel=1e-11)


def plain_purchases(r, alpha, a, b, days, x, age):
    """The published form, its series summed term by term until nothing is added."""
    z, term, total, n = days / (alpha + age + days), 1.0, 0.0, 0
    top = a + b + x - 1
    while abs(term) > 1e-18 * abs(total) or n < 50:
        total += term
        term *= (a + b - 1 - r + n) * (a - 1 + n) / ((top + n) * (n + 1)) * z
        n += 1
    return top / (a - 1) * (1 - ((alpha + age) / (alpha + age + days)) ** (a - 1) * total)


@pytest.mark.parametrize("alpha", [4.4, 0.1, 0.01, 0.001])
@pytest.mark.parametrize("a, r", [(0.793, 0.243), (1.6, 0.3), (1.243, 0.243), (2.5, 0.4)])
def test_purchases_near_one_and_beyond(spark, alpha, a, r):
    """New customers of a fast-buying population, where z is almost one."""
    params = {"r": r, "alpha": alpha, "a": a, "b": 2.426}
    rows = [(float(x), float(age)) for x in (0, 1, 3, 15, 23, 24, 30, 200) for age in (0, 2, 400)]
    df = spark.createDataFrame(rows, "x double, age double")
    out = df.select("x", "age", clv.purchases_while_active(params, 360.0, F.col("x"), F.col("age")).alias("n"))
    for row in out.collect():
        if alpha + row["age"] < 0.01 and row["x"] < 3:
            continue  # too many terms for the plain sum
        assert row["n"] == pytest.approx(plain_purchases(r, alpha, a, 2.426, 360.0, row["x"], row["age"]), rel=2e-6)


def test_purchases_of_a_new_customer_known_values(spark):
    """Values of the whole series, found with millions of terms."""
    for alpha, expected in ((0.1, 17.4227), (0.01, 33.53), (0.001, 59.93)):
        params = {"r": 0.243, "alpha": alpha, "a": 0.793, "b": 2.426}
        df = spark.createDataFrame([(0.0, 0.0)], "x double, age double")
        found = df.select(clv.purchases_while_active(params, 360.0, F.col("x"), F.col("age"))).first()[0]
        assert found == pytest.approx(expected, rel=3e-4)


def test_an_unfinished_search_raises():
    import numpy as np

    def bowl(p):
        value = float(np.exp(p[0]) - 2 * p[0])
        return clv.Evaluation(value, np.array([np.exp(p[0]) - 2]), np.array([[np.exp(p[0])]]))

    found = clv.minimise(bowl, np.array([3.0]))
    assert found.point[0] == pytest.approx(math.log(2), abs=1e-9) and found.at.slope <= 1e-9 and found.ended == "flat"
    with pytest.raises(clv.NotConverged):
        clv.minimise(bowl, np.array([9.0]), max_evaluations=3)


def mixture_log_likelihood(x, seen, age, r, alpha, a, b):
    """The published likelihood, written with beta functions."""

    def log_beta(u, w):
        return math.lgamma(u) + math.lgamma(w) - math.lgamma(u + w)

    alive = math.exp(log_beta(a, b + x) - log_beta(a, b) + math.lgamma(r + x) - math.lgamma(r)
                     + r * math.log(alpha) - (r + x) * math.log(alpha + age))
    gone = 0.0
    if x > 0:
        gone = math.exp(log_beta(a + 1, b + x - 1) - log_beta(a, b) + math.lgamma(r + x) - math.lgamma(r)
                        + r * math.log(alpha) - (r + x) * math.log(alpha + seen))
    return math.log(alive + gone)


def test_purchase_likelihood_against_the_published_form(spark):
    rows = [(0.0, 0.0, 300.0, 1.0), (1.0, 50.0, 300.0, 1.0), (6.0, 290.0, 300.0, 1.0), (3.0, 3.0, 900.0, 1.0)]
    df = spark.createDataFrame(rows, "x double, seen double, age double, weight double")
    found = [clv.purchase_terms(df.where(F.col("age") == r[2]).where(F.col("x") == r[0]), PURCHASE)
             .first()["t"] for r in rows]
    assert found == pytest.approx([mixture_log_likelihood(*r[:3], **PURCHASE) for r in rows], rel=1e-12)


def histories(spark, customers=3_000, seed=3):
    """Histories drawn from the model with known parameters."""
    rng = np.random.default_rng(seed)
    r, alpha, a, b = 1.2, 40.0, 0.9, 3.0
    rows = []
    for _ in range(customers):
        rate, drop, age = rng.gamma(r, 1 / alpha), rng.beta(a, b), rng.integers(200, 600)
        clock, x, seen = 0.0, 0, 0.0
        while True:
            clock += rng.exponential(1 / rate)
            if clock > age:
                break
            x, seen = x + 1, clock
            if rng.random() < drop:
                break
        rows.append((len(rows), x + 1, int(age - math.floor(seen)), int(age)))
    return spark.createDataFrame(rows, "customer_id long, frequency long, recency long, T long").withColumn(
        "avg_monetary", F.lit(10.0)
    )


def objective_of(rows, names, terms, params):
    evaluate = clv.penalised_objective(rows, names, terms, 0.01)
    return evaluate(np.log([params[n] for n in names]))


def assert_flat(found, fit):
    assert found.value == pytest.approx(fit.objective, abs=1e-9) and np.abs(found.gradient).max() < 1e-4
    return found.value


def test_purchase_fit_recovers_and_is_a_minimum(spark, cfg):
    table = histories(spark).cache()
    fit = clv.fit_purchase_model(table, cfg)
    assert fit.params["r"] == pytest.approx(1.2, rel=0.35)
    assert fit.params["alpha"] == pytest.approx(40.0, rel=0.35)
    assert fit.params["a"] / (fit.params["a"] + fit.params["b"]) == pytest.approx(0.9 / 3.9, rel=0.35)

    scale = 10.0 / table.agg(F.max("T")).first()[0]
    rows = clv.purchase_histories(table).select(
        "x", (F.col("seen") * scale).alias("seen"), (F.col("age") * scale).alias("age"), "weight"
    )
    best = fit.params | {"alpha": fit.params["alpha"] * scale}
    value = assert_flat(objective_of(rows, clv.PURCHASE_PARAMETERS, clv.purchase_terms, best), fit)
    for name in best:
        for factor in (0.95, 1.05):
            near = best | {name: best[name] * factor}
            assert objective_of(rows, clv.PURCHASE_PARAMETERS, clv.purchase_terms, near).value > value


def test_value_fit_is_a_minimum(spark, cfg):
    rng = np.random.default_rng(11)
    rows = []
    for customer in range(3_000):
        x = int(rng.integers(1, 15))
        scale = rng.gamma(4.0, 1 / 20.0)
        rows.append((customer, x + 1, float(rng.gamma(3.0 * x, 1 / (x * scale))), 5, 100))
    table = spark.createDataFrame(rows, "customer_id long, frequency long, avg_monetary double, recency long, T long")
    fit = clv.fit_value_model(table, cfg)
    values = clv.repeat_values(table).cache()
    value = assert_flat(objective_of(values, clv.VALUE_PARAMETERS, clv.value_terms, fit.params), fit)
    for name in fit.params:
        for factor in (0.95, 1.05):
            near = fit.params | {name: fit.params[name] * factor}
            assert objective_of(values, clv.VALUE_PARAMETERS, clv.value_terms, near).value > value


def test_slopes_are_derivatives(spark):
    rows = spark.createDataFrame(
        [(0.0, 0.0, 9.0, 2.0, 1.0), (2.0, 4.0, 9.0, 1.0, 3.0), (5.0, 8.0, 10.0, 3.0, 0.5)],
        "x double, seen double, age double, weight double, mean double",
    )
    for names, terms, data in (
        (clv.PURCHASE_PARAMETERS, clv.purchase_terms, rows),
        (clv.VALUE_PARAMETERS, clv.value_terms, rows.where("x > 0")),
    ):
        evaluate = clv.penalised_objective(data, names, terms, 0.01)
        point = np.linspace(-0.4, 0.7, len(names))
        here = evaluate(point)
        for j in range(len(names)):
            step = np.eye(len(names))[j] * 1e-5
            after, before = evaluate(point + step), evaluate(point - step)
            assert here.gradient[j] == pytest.approx((after.value - before.value) / 2e-5, rel=1e-6, abs=1e-8)
            assert here.hessian[j] == pytest.approx((after.gradient - before.gradient) / 2e-5, rel=1e-6, abs=1e-8)


def test_contradicting_histories_are_refused(spark, cfg):
    schema = "customer_id long, frequency long, recency long, T long, avg_monetary double"
    with pytest.raises(ValueError, match="contradict"):
        clv.fit_purchase_model(spark.createDataFrame([(1, 1, 3, 9, 5.0), (2, 4, 3, 9, 5.0)], schema), cfg)
    with pytest.raises(ValueError, match="zero or less"):
        clv.fit_value_model(spark.createDataFrame([(1, 3, 3, 9, 0.0)], schema), cfg)
    with pytest.raises(ValueError, match="no repeat"):
        clv.fit_value_model(spark.createDataFrame([(1, 1, 9, 9, 2.0)], schema), cfg)


def long_series(x, seen, age, t, r, alpha, a, b, terms=60_000):
    """Expected purchases from the untransformed series."""
    z = t / (alpha + age + t)
    total, term = 0.0, 1.0
    for n in range(terms):
        total += term
        term *= (r + x + n) * (b + x + n) / ((a + b + x - 1 + n) * (n + 1)) * z
    ahead = (a + b + x - 1) / (a - 1) * (1 - total * ((alpha + age) / (alpha + age + t)) ** (r + x))
    gone = a / (b + x - 1) * ((alpha + age) / (alpha + seen)) ** (r + x) if x > 0 else 0.0
    return ahead / (1 + gone)


def predicted(spark, rows, params):
    schema = "id long, repeat_purchases long, age_at_last_purchase long, T long"
    inputs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
    found = by_key(clv.with_expected_purchases(inputs, params, 360), "id")
    return [found[i]["predicted_purchases"] for i in range(len(rows))]


def test_expected_purchases_against_the_long_series(spark):
    rows = [(0, 0, 0), (0, 0, 900), (1, 10, 30), (7, 800, 1000), (24, 2000, 2100), (3, 0, 1)]
    expected = [long_series(x, s, g, 360.0, **PURCHASE) for x, s, g in rows]
    assert predicted(spark, rows, PURCHASE) == pytest.approx(expected, rel=1e-8)


def test_expected_purchases_near_the_poles(spark):
    """Parameters at a pole give the same as parameters next to it, and tiny a its limit."""
    def score(**params):
        return predicted(spark, [(0, 0, 400), (5, 300, 400)], PURCHASE | params)

    assert score(a=1.0) == pytest.approx(score(a=1.0 + 1e-6), rel=1e-4)
    assert score(a=0.4, b=0.6) == pytest.approx(score(a=0.4, b=0.600001), rel=1e-4)
    limit = [(PURCHASE["r"] + x) * 360 / (PURCHASE["alpha"] + 400) for x in (0, 5)]
    assert score(a=1e-9, b=2.0) == pytest.approx(limit, rel=1e-6)


def test_one_time_customers_keep_their_mean(small_orders, orders_of, cfg):
    from patronlens.operators.features import rfm

    table = rfm(small_orders.unionByName(orders_of([(7, 70, 30, 33.0, "email", 0)])), cfg)
    scored = by_key(clv.score_clv(table, PURCHASE, VALUE, cfg))
    assert scored[7]["expected_avg_revenue"] == 33.0
    weight = VALUE["p"] * 3 / (VALUE["p"] * 3 + VALUE["q"] - 1)
    population = VALUE["p"] * VALUE["v"] / (VALUE["q"] - 1)
    assert scored[1001]["expected_avg_revenue"] == pytest.approx((1 - weight) * population + weight * 70.0, rel=1e-12)
    for row in scored.values():
        assert row["clv_12m"] == pytest.approx(row["predicted_purchases"] * row["expected_avg_revenue"], rel=1e-15)


def test_median_is_interpolated(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 1, 9, 2])], "customer_id long, clv_12m double")
    assert tuple(clv.clv_summary(df).first()) == (4.25, 3.5)
    assert clv.clv_summary(df.where("clv_12m > 1")).first()["median_clv_12m"] == 5.0


def test_search_ends_where_rounding_hides_gains():
    """Close to the minimum the objective is constant to the last digit and slopes are noise."""
    calls = []

    def noisy(p):
        calls.append(p[0])
        gradient = p[0] if abs(p[0]) > 1e-7 else 5e-8 * (-1) ** len(calls)
        return clv.Evaluation(1.0 + p[0] ** 2 / 2, np.array([gradient]), np.array([[1.0]]))

    found = clv.minimise(noisy, np.array([1.0]))
    assert found.ended == "gain" and abs(found.point[0]) < 1e-6 and found.at.slope <= clv.STEEPEST


def test_a_steep_end_is_no_fit():
    def cliff(p):
        return clv.Evaluation(abs(p[0]), np.array([1.0 if p[0] >= 0 else -1.0]), np.array([[1e-3]]))

    with pytest.raises(clv.NotConverged):
        clv.minimise(cliff, np.array([0.3]))


def test_standard_errors_against_simulated_values(spark, cfg):
    """Order values drawn from the model: what they were drawn with lies within a few errors."""
    rng = np.random.default_rng(8)
    x = rng.integers(1, 9, 3000).astype(float)
    spend = rng.gamma(5.0 * x, 1.0 / rng.gamma(4.0, 1 / 30.0, 3000)) / x
    frame = spark.createDataFrame([(int(k + 1), float(m)) for k, m in zip(x, spend)], "frequency long, avg_monetary double")
    table = stage(frame.withColumns({"T": F.lit(50), "recency": F.lit(1), "customer_id": F.monotonically_increasing_id()}), "errors_test")
    fit = clv.fit_value_model(table, replace(cfg, penalizer=0.0))
    for name, true in (("p", 5.0), ("q", 4.0), ("v", 30.0)):
        assert fit.errors[name] and abs(fit.params[name] - true) < 4 * fit.errors[name]
    assert fit.errors["p"] < 0.2 * fit.params["p"]


def test_undetermined_parameters_have_no_error():
    at = clv.Evaluation(1.0, np.zeros(2), np.array([[4.0, 1e-9], [1e-9, 1e-8]]), 100.0)
    first, second = clv.standard_errors(at, np.array([3.0, 2.0]))
    assert first == pytest.approx(3.0 * math.sqrt(1 / 400)) and second is None
