"""Lifetime value: purchase-count model, order-value model and scoring.

The purchase model is BG/NBD (Fader, Hardie and Lee 2005), the order-value model
Gamma-Gamma (Fader and Hardie 2013). Both are fitted by penalised maximum
likelihood. The optimiser on the driver only ever sees sums: each evaluation of
the likelihood and its gradient is one Spark aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.config import RunConfig
from patronlens.functions.special import hyp2f1, hyp2f1_near_one, log_gamma
from patronlens.operators.ranking import RankSpec, rank_cuts
from patronlens.schemas import CLV_COLUMNS
from patronlens.sources.staging import stage

PURCHASE_PARAMETERS = ["r", "alpha", "a", "b"]
VALUE_PARAMETERS = ["p", "q", "v"]
# Repeat purchases below which a history is short, and how far whole numbers are stepped off.
SHORT = 24
NUDGE = 3e-8
# Curvature by a parameter's logarithm below which the data do not determine it.
LEAST_CURVATURE = 1e-4
# Slope above which an ended search is no fit, and the share of an objective that is lost to rounding.
STEEPEST = 1e-6
ROUNDING = 1e-14
# The logarithm at which a parameter is as good as zero.
LEAST_LOG = -60.0
# Rows for which a task of a pass is worth its start.
ROWS_A_TASK = 50_000


@dataclass(frozen=True)
class Fit:
    """Fitted parameters, the objective reached, the passes it took, the slope left and what ended the search.

    ``errors`` are standard errors from the inverse of the objective's curvature at the end, None for parameters that the
    data do not determine: those along whose logarithm the objective is all but flat. These are held fixed for the others.
    """

    params: dict[str, float]
    objective: float
    evaluations: int
    slope: float = 0.0
    ended: str = "flat"
    errors: dict[str, float | None] = field(default_factory=dict)


def clv_inputs(rfm_table: DataFrame) -> DataFrame:
    """Repeat purchases and the age at the last purchase, beside the RFM columns."""
    return rfm_table.withColumns(
        {
            "repeat_purchases": F.greatest(F.col("frequency") - F.lit(1), F.lit(0)),
            "age_at_last_purchase": F.col("T") - F.col("recency"),
        }
    )


def _value(x: float) -> Column:
    return F.lit(float(x))


def purchase_terms(rows: DataFrame, params: dict[str, float]) -> DataFrame:
    """Weighted sums of the log-likelihood ``t``, its slopes ``t0`` to ``t3`` by r,
    alpha, a and b, and its curvatures ``t00`` to ``t33``, over ``x, seen, age, weight``.

    Gamma functions depend on ``x`` alone and are evaluated once per distinct one in a batch.
    """
    r, alpha, a, b = (params[n] for n in PURCHASE_PARAMETERS)
    log_alpha = math.log(alpha)

    def terms(x: np.ndarray, seen: np.ndarray, age: np.ndarray) -> dict[str, np.ndarray]:
        counts, which = np.unique(x, return_inverse=True)
        gammas = [log_gamma(z + counts) for z in (r, b, a + b)]
        (lg_r, dg_r, tg_r), (lg_b, dg_b, tg_b), (lg_ab, dg_ab, tg_ab) = [
            [(there - here)[which] for there, here in zip(gamma, log_gamma(np.array([z])))]
            for gamma, z in zip(gammas, (r, b, a + b))
        ]
        log_age, log_seen = np.log(alpha + age), np.log(alpha + seen)
        by_age, by_seen = 1 / (alpha + age), 1 / (alpha + seen)
        by_past = 1 / (b + np.maximum(x, 1) - 1)
        alive = -(r + x) * log_age
        gone = np.where(x > 0, math.log(a) + np.log(by_past) - (r + x) * log_seen, -np.inf)
        top = np.maximum(alive, gone)
        t = top + np.log(np.exp(alive - top) + np.exp(gone - top))
        u = np.exp(gone - t)
        w = 1 - u
        uw = u * w
        # Slopes of the gone branch minus those of the alive branch.
        e0, e1, e2, e3 = log_age - log_seen, (r + x) * (by_age - by_seen), 1 / a, -by_past
        return {
            "t": t + lg_r + lg_b - lg_ab + r * log_alpha,
            "t0": u * e0 - log_age + dg_r + log_alpha,
            "t1": u * e1 - (r + x) * by_age + r / alpha,
            "t2": u * e2 - dg_ab,
            "t3": u * e3 + dg_b - dg_ab,
            "t00": uw * e0 * e0 + tg_r,
            "t01": uw * e0 * e1 - w * by_age - u * by_seen + 1 / alpha,
            "t02": uw * e0 * e2,
            "t03": uw * e0 * e3,
            "t11": uw * e1 * e1 + (r + x) * (w * by_age**2 + u * by_seen**2) - r / alpha**2,
            "t12": uw * e1 * e2,
            "t13": uw * e1 * e3,
            "t22": (uw - u) * e2 * e2 - tg_ab,
            "t23": uw * e2 * e3 - tg_ab,
            "t33": (uw + u) * e3 * e3 + tg_b - tg_ab,
        }

    return summed_terms(rows, ["x", "seen", "age"], terms, len(PURCHASE_PARAMETERS))


def value_terms(rows: DataFrame, params: dict[str, float]) -> DataFrame:
    """Weighted sums of the log-likelihood ``t``, its slopes ``t0`` to ``t2`` by p, q and
    v, and its curvatures ``t00`` to ``t22``, over ``x, mean, weight``."""
    p, q, v = (params[n] for n in VALUE_PARAMETERS)

    def terms(x: np.ndarray, mean: np.ndarray) -> dict[str, np.ndarray]:
        counts, which = np.unique(x, return_inverse=True)
        lg_px, dg_px, tg_px = (g[which] for g in log_gamma(p * counts))
        lg_pxq, dg_pxq, tg_pxq = (g[which] for g in log_gamma(p * counts + q))
        lg_q, dg_q, tg_q = log_gamma(np.array([q]))
        px, log_x, log_mean = p * x, np.log(x), np.log(mean)
        by_total = 1 / (x * mean + v)
        spread = -np.log(by_total)
        return {
            "t": (px - 1) * log_mean - (px + q) * spread + lg_pxq - lg_px + px * log_x + q * math.log(v) - lg_q,
            "t0": x * (log_mean - spread + dg_pxq - dg_px + log_x),
            "t1": -spread + dg_pxq + math.log(v) - dg_q,
            "t2": -(px + q) * by_total + q / v,
            "t00": x * x * (tg_pxq - tg_px),
            "t01": x * tg_pxq,
            "t02": -x * by_total,
            "t11": tg_pxq - tg_q,
            "t12": -by_total + 1 / v,
            "t22": (px + q) * by_total**2 - q / v**2,
        }

    return summed_terms(rows, ["x", "mean"], terms, len(VALUE_PARAMETERS))


def _term_names(size: int) -> list[str]:
    """The likelihood, its slopes, and the upper half of its curvatures."""
    pairs = [f"t{i}{j}" for i in range(size) for j in range(i, size)]
    return ["t", *[f"t{i}" for i in range(size)], *pairs]


def summed_terms(
    rows: DataFrame, columns: list[str], terms: Callable[..., dict[str, np.ndarray]], size: int
) -> DataFrame:
    """One row: the weight of all rows as ``customers``, and the weighted sum of every term.

    Tasks sum their own rows in numpy, so one candidate differs from the next in a few numbers only: no expression is
    analysed or compiled for it.
    """
    names = ["customers", *_term_names(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for batch in batches:
            weight, *values = (batch.column(k).to_numpy() for k in range(batch.num_columns))
            if len(weight):
                found = terms(*values)
                total += [weight.sum(), *(weight @ found[n] for n in names[1:])]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names)

    parts = rows.select("weight", *columns).mapInArrow(run, ", ".join(f"{n} double" for n in names))
    return parts.agg(*[F.sum(n).alias(n) for n in names])


@dataclass(frozen=True)
class Evaluation:
    """Objective, gradient and Hessian at one point, and the customers it is a mean over."""

    value: float
    gradient: np.ndarray
    hessian: np.ndarray
    customers: float = 1.0

    @property
    def slope(self) -> float:
        return float(np.max(np.abs(self.gradient)))


def penalised_objective(
    rows: DataFrame, names: list[str], terms: Callable[[DataFrame, dict[str, float]], DataFrame], penalizer: float
) -> Callable[[np.ndarray], Evaluation]:
    """Objective with its derivatives by the log-parameters.

    The objective is minus the mean log-likelihood plus the penalizer times the
    sum of squared parameters. Each call is one aggregate over the rows.
    """
    size = len(names)

    def evaluate(log_params: np.ndarray) -> Evaluation:
        values = np.exp(log_params)
        row = terms(rows, dict(zip(names, values.tolist()))).first()
        mean = {c: row[c] / row["customers"] for c in _term_names(size)}
        slopes = np.array([-mean[f"t{i}"] for i in range(size)]) + 2.0 * penalizer * values
        bends = 2.0 * penalizer * np.eye(size)
        for i in range(size):
            for j in range(size):
                bends[i, j] -= mean[f"t{min(i, j)}{max(i, j)}"]
        gradient = slopes * values
        hessian = bends * np.outer(values, values) + np.diag(gradient)
        return Evaluation(float(-mean["t"] + penalizer * np.sum(values**2)), gradient, hessian, row["customers"])

    return evaluate


class NotConverged(RuntimeError):
    """A search that ended where the objective is not flat."""


@dataclass(frozen=True)
class Minimum:
    """Where a search ended: the point, the last evaluation, the passes used, and whether the objective is ``flat`` there
    or rounding hides any further ``gain``."""

    point: np.ndarray
    at: Evaluation
    evaluations: int
    ended: str


def minimise(
    evaluate: Callable[[np.ndarray], Evaluation],
    start: np.ndarray,
    tolerance: float = 1e-9,
    max_evaluations: int = 200,
) -> Minimum:
    """Newton descent with a halving line search.

    Directions of negative or no curvature are followed by their absolute
    curvature. The search ends at a flat point. Where gains are lost in rounding,
    steps must lower the slope instead; if none does, the search ends there if
    the slope is at most ``STEEPEST``. Else it raises :class:`NotConverged`, so no
    unfinished point is taken for a fit.
    """
    point, used = start.astype(float), 1
    here = evaluate(point)
    while here.slope > tolerance:
        bends, axes = np.linalg.eigh(here.hessian)
        direction = -axes @ ((axes.T @ here.gradient) / np.maximum(np.abs(bends), 1e-10))
        promised = -(direction @ here.gradient)
        noise = ROUNDING * (1.0 + abs(here.value))
        step = min(1.0, 2.0 / np.max(np.abs(direction)))
        while True:
            if used >= max_evaluations or step < 1e-8:
                if here.slope <= STEEPEST:
                    return Minimum(point, here, used, "gain")
                raise NotConverged(f"slope {here.slope:.3g} left after {used} passes at {point.tolist()}")
            goal = np.maximum(point + step * direction, LEAST_LOG)
            there = evaluate(goal)
            used += 1
            gained = here.value - there.value
            if np.isfinite(there.value) and gained >= 1e-4 * step * promised - noise and (gained > noise or there.slope < here.slope):
                break
            step /= 2.0
        point, here = goal, there
    return Minimum(point, here, used, "flat")


def standard_errors(at: Evaluation, params: np.ndarray) -> list[float | None]:
    """Of the parameters, from curvatures by their logarithms; None where the objective is all but flat."""
    known = np.diag(at.hessian) >= LEAST_CURVATURE
    out: list[float | None] = [None] * len(params)
    if known.any():
        spread = np.diag(np.linalg.inv(at.hessian[np.ix_(known, known)])) / at.customers
        for k, variance in zip(np.nonzero(known)[0], spread):
            out[k] = float(params[k] * math.sqrt(variance)) if variance > 0 else None
    return out


def _fit(
    rows: DataFrame, names: list[str], terms: Callable[[DataFrame, dict[str, float]], DataFrame], penalizer: float
) -> Fit:
    found = minimise(penalised_objective(rows, names, terms, penalizer), np.full(len(names), 0.1))
    params = np.exp(found.point)
    errors = dict(zip(names, standard_errors(found.at, params)))
    return Fit(dict(zip(names, params.tolist())), found.at.value, found.evaluations, found.at.slope, found.ended, errors)


def _in_large_tasks(rows: DataFrame, count: int) -> DataFrame:
    """Stored rows in no more tasks than they are worth: a search passes over them many times."""
    return rows.coalesce(max(1, -(-count // ROWS_A_TASK)))


def purchase_histories(rfm_table: DataFrame) -> DataFrame:
    """Distinct (x, seen, age) histories with the number of customers as weight.

    All three are whole numbers, so the distinct histories are bounded by the
    days on record and not by the number of customers.
    """
    inputs = clv_inputs(rfm_table)
    return inputs.groupBy(
        F.col("repeat_purchases").cast("double").alias("x"),
        F.col("age_at_last_purchase").cast("double").alias("seen"),
        F.col("T").cast("double").alias("age"),
    ).agg(F.count("*").cast("double").alias("weight"))


def fit_purchase_model(rfm_table: DataFrame, cfg: RunConfig) -> Fit:
    """Fit BG/NBD on all customers.

    Time is scaled so that the oldest customer has age 10; alpha is scaled back.
    """
    histories = stage(purchase_histories(rfm_table), "purchase_histories")
    seen, age = F.col("seen"), F.col("age")
    check = histories.agg(
        F.max("age").alias("oldest"),
        F.count_if((seen > age) | ((F.col("x") == 0) & (seen != 0))).alias("invalid"),
        F.count("*").alias("rows"),
    ).first()
    if check["oldest"] is None:
        raise ValueError("no customers to fit")
    if check["invalid"]:
        raise ValueError(f"{check['invalid']} histories contradict themselves, e.g. a later purchase with no repeat")
    scale = 10.0 / check["oldest"] if check["oldest"] > 0 else 1.0
    scaled = histories.select("x", (seen * _value(scale)).alias("seen"), (age * _value(scale)).alias("age"), "weight")
    fit = _fit(_in_large_tasks(scaled, check["rows"]), PURCHASE_PARAMETERS, purchase_terms, cfg.penalizer)
    alpha, error = fit.params["alpha"] / scale, fit.errors["alpha"]
    return replace(fit, params=fit.params | {"alpha": alpha}, errors=fit.errors | {"alpha": None if error is None else error / scale})


def repeat_values(rfm_table: DataFrame) -> DataFrame:
    """Repeat purchases and mean order value of the repeat customers."""
    repeat = clv_inputs(rfm_table).where(F.col("repeat_purchases") > 0)
    x = F.col("repeat_purchases").cast("double")
    return repeat.select(x.alias("x"), F.col("avg_monetary").alias("mean"), F.lit(1.0).alias("weight"))


def fit_value_model(rfm_table: DataFrame, cfg: RunConfig) -> Fit:
    """Fit Gamma-Gamma on customers with at least one repeat purchase."""
    rows = stage(repeat_values(rfm_table), "repeat_values")
    check = rows.agg(F.count("*").alias("rows"), F.count_if(F.col("mean") <= 0).alias("invalid")).first()
    if not check["rows"]:
        raise ValueError("no repeat customers to fit")
    if check["invalid"]:
        raise ValueError(f"{check['invalid']} repeat customers have a mean order value of zero or less")
    return _fit(_in_large_tasks(rows, check["rows"]), VALUE_PARAMETERS, value_terms, cfg.penalizer)


def purchases_while_active(params: dict[str, float], days: float, x: Column, age: Column) -> Column:
    """Expected purchases in the next ``days``, before the odds of having left.

    The published form's hypergeometric term is rewritten with Euler's
    transformation, whose series converges fast for long histories.
    """
    # The formulas divide by a - 1, and near z = 1 by sines of r - a: whole numbers are stepped off.
    a_value, b_value = params["a"], params["b"]
    if abs(a_value - 1.0) < NUDGE:
        a_value += 2 * NUDGE
    if abs(a_value - params["r"] - round(a_value - params["r"])) < NUDGE:
        a_value += 4 * NUDGE
    if abs(a_value + b_value - 1.0) < 1e-9:
        b_value += 2e-9
    r, alpha, a, b = _value(params["r"]), _value(params["alpha"]), _value(a_value), _value(b_value)
    t = _value(days)
    z = t / (alpha + age + t)
    rest = (alpha + age) / (alpha + age + t)
    top = a + b + x - F.lit(1.0)
    one, two = a_value + b_value - 1.0 - params["r"], a_value - 1.0
    # Long histories need few terms at any z, short ones near z = 1 the connection formula.
    near = (z > F.lit(0.9)) & (x < F.lit(float(SHORT)))
    connected = hyp2f1_near_one(one, two, a_value + b_value - 1.0, x, z, rest, SHORT)
    series = F.when(near, connected).otherwise(hyp2f1(_value(one), _value(two), top, z))
    return top / (a - F.lit(1.0)) * (F.lit(1.0) - F.pow(rest, a - F.lit(1.0)) * series)


def odds_gone(params: dict[str, float], x: Column, seen: Column, age: Column) -> Column:
    """Odds that a customer has left; zero without a repeat purchase."""
    r, alpha, a, b = (_value(params[n]) for n in PURCHASE_PARAMETERS)
    since = F.exp((r + x) * F.ln((alpha + age) / (alpha + seen)))
    return F.when(x > 0, a / (b + F.greatest(x, F.lit(1.0)) - F.lit(1.0)) * since).otherwise(F.lit(0.0))


def with_expected_purchases(inputs: DataFrame, params: dict[str, float], days: float) -> DataFrame:
    """Add ``predicted_purchases`` to :func:`clv_inputs`.

    The costly series depends on repeat purchases and age alone, both whole
    numbers. It is evaluated once per distinct pair and joined back; the pairs
    are stored first, so Spark knows their size and broadcasts them only below
    its own threshold. Beyond it the join is an ordinary, skew-handled one.
    """
    pair = ["repeat_purchases", "T"]
    x, seen, age = (F.col(c).cast("double") for c in ("repeat_purchases", "age_at_last_purchase", "T"))
    pairs = inputs.select(*pair).distinct()
    active = stage(pairs.withColumn("while_active", purchases_while_active(params, days, x, age)), "purchase_pairs")
    joined = inputs.join(active, pair, "left")
    predicted = F.col("while_active") / (F.lit(1.0) + odds_gone(params, x, seen, age))
    return joined.withColumn("predicted_purchases", predicted).drop("while_active")


def expected_order_value(params: dict[str, float], x: Column, mean: Column) -> Column:
    """Expected order value of a repeat customer: a weighted mean of the
    population's and the customer's own mean."""
    p, q, v = (_value(params[n]) for n in VALUE_PARAMETERS)
    x = x.cast("double")
    return F.try_divide(p * (v + x * mean), p * x + q - F.lit(1.0))


def score_clv(
    rfm_table: DataFrame, purchase: dict[str, float], value: dict[str, float], cfg: RunConfig
) -> DataFrame:
    """Add predicted purchases, expected order value and their product.

    Customers without a repeat purchase keep their observed mean order value.
    ``rfm_table`` is read twice and should be stored.
    """
    x, mean = F.col("repeat_purchases"), F.col("avg_monetary")
    scored = with_expected_purchases(clv_inputs(rfm_table), purchase, cfg.horizon_days)
    return scored.select(
        *rfm_table.columns,
        "predicted_purchases",
        F.when(x > 0, expected_order_value(value, x, mean)).otherwise(mean).alias("expected_avg_revenue"),
    ).withColumn("clv_12m", F.col("predicted_purchases") * F.col("expected_avg_revenue"))


def clv_summary(scored: DataFrame) -> DataFrame:
    """Mean and exact median lifetime value.

    The median is found with :func:`~patronlens.operators.ranking.rank_cuts`,
    so no task ever holds the table of distinct values.
    """
    def middle(n: int) -> list[int]:
        return [(n + 1) // 2, n // 2 + 1] if n else []

    cuts = rank_cuts(scored, "customer_id", [RankSpec("clv_12m", F.col("clv_12m"), middle)])["clv_12m"].cuts
    median = sum(value for value, _ in cuts) / len(cuts) if cuts else None
    return scored.agg(F.avg("clv_12m").alias("mean_clv_12m"), F.lit(median).cast("double").alias("median_clv_12m"))


def clv_columns(scored: DataFrame) -> DataFrame:
    """The key and the three value columns, for joining to other scores."""
    return scored.select("customer_id", *CLV_COLUMNS)
