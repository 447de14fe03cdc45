"""The same queries in DuckDB SQL, written independently of the operators.

Ranks are plain window functions over the whole table here, gaps are taken row
by row, and gamma terms use the engine's own ``lgamma``.
"""

from __future__ import annotations

from patronlens.plans.catalog import (
    EVENTS,
    LONG_HORIZON,
    LONG_PARAMS,
    PURCHASE_PARAMS,
    STAR,
    TREE_FEATURES,
    TREE_NODES,
    TREE_WEIGHTS,
    VALUE_PARAMS,
)
from patronlens.plans.oracle_fits import newton_ctes
from patronlens.schemas import FEATURES


def rnd(expression: str, digits: int = 6) -> str:
    scale = 10**digits
    return f"(round_even(({expression})::DOUBLE * {scale}.0::DOUBLE, 0) / {scale}.0::DOUBLE + 0.0::DOUBLE)"


# The value of the feature that a row of tests names.
TREE_VALUE = "CASE feature " + " ".join(f"WHEN '{n}' THEN {n}::DOUBLE" for n in TREE_FEATURES) + " END"

STAR_SOURCE = """
src AS (SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS order_date, o_totalprice AS revenue,
               o_orderpriority AS channel, coalesce(r.is_returned, 0) AS is_returned
        FROM orders LEFT JOIN (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS is_returned
                               FROM lineitem GROUP BY l_orderkey) r ON o_orderkey = r.l_orderkey)"""

EVENT_SOURCE = """
src AS (SELECT user_id AS customer_id, event_id AS order_id, ts AS order_date, value AS revenue,
               'event' AS channel, 0 AS is_returned
        FROM events WHERE event_type = 'purchase')"""


def feature_ctes(source: str, cfg) -> str:
    now = f"TIMESTAMP '{cfg.snapshot} 00:00:00'"
    bins = cfg.score_bins

    def quantile(rank: str) -> str:
        return f"(greatest((({rank} - 1) * {bins} + n - 2) // (n - 1), 1) - 1)"

    return f"""{source},
past AS (SELECT * FROM src WHERE order_date <= {now} AND customer_id IS NOT NULL),
base AS (SELECT customer_id, count(DISTINCT order_id) AS frequency, coalesce(sum(revenue), 0.0) AS monetary,
                date_sub('day', max(order_date), {now}) AS recency, date_sub('day', min(order_date), {now}) AS age
         FROM past GROUP BY customer_id),
ranked AS (SELECT *, monetary / frequency AS avg_monetary, count(*) OVER () AS n,
                  row_number() OVER (ORDER BY recency, customer_id) AS rr,
                  row_number() OVER (ORDER BY frequency, customer_id) AS fr,
                  row_number() OVER (ORDER BY monetary, customer_id) AS mr
           FROM base),
scores AS (SELECT *, {bins} - {quantile('rr')} AS R_score, {quantile('fr')} + 1 AS F_score,
                  {quantile('mr')} + 1 AS M_score FROM ranked),
rfm AS (SELECT customer_id, frequency, monetary, recency, age, avg_monetary, R_score, F_score, M_score,
               R_score::VARCHAR || F_score::VARCHAR || M_score::VARCHAR AS rfm_segment FROM scores),
stats AS (SELECT customer_id, avg(revenue) AS avg_order_value, coalesce(stddev_samp(revenue), 0.0) AS std_order_value,
                 avg(is_returned) AS return_rate FROM past GROUP BY customer_id),
gaps AS (SELECT customer_id, date_sub('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date),
                                      order_date) AS gap FROM past),
ipt AS (SELECT customer_id, coalesce(avg(gap), {float(cfg.churn_window_days)}) AS inter_purchase_time_avg
        FROM gaps GROUP BY customer_id),
feat AS (SELECT rfm.*, avg_order_value, std_order_value, return_rate, inter_purchase_time_avg,
                age AS days_since_first_order, 0.0 AS promo_dependency_ratio,
                CASE WHEN recency > {cfg.churn_window_days} THEN 1 ELSE 0 END AS churn_label
         FROM rfm LEFT JOIN stats USING (customer_id) LEFT JOIN ipt USING (customer_id))"""


STAR_FEATURES = feature_ctes(STAR_SOURCE, STAR)
EVENT_FEATURES = feature_ctes(EVENT_SOURCE, EVENTS)

RFM_SELECT = f"""customer_id::BIGINT AS customer_id, frequency::BIGINT AS frequency, {rnd('monetary')} AS monetary,
recency::BIGINT AS recency, age::BIGINT AS "T", {rnd('avg_monetary')} AS avg_monetary,
R_score::BIGINT AS R_score, F_score::BIGINT AS F_score, M_score::BIGINT AS M_score, rfm_segment"""

CHURN_SELECT = f"""{RFM_SELECT}, {rnd('avg_order_value')} AS avg_order_value, {rnd('std_order_value')} AS std_order_value,
{rnd('return_rate')} AS return_rate, {rnd('inter_purchase_time_avg')} AS inter_purchase_time_avg,
days_since_first_order::BIGINT AS days_since_first_order, {rnd('promo_dependency_ratio')} AS promo_dependency_ratio,
churn_label::BIGINT AS churn_label"""


def clv_ctes() -> str:
    r, alpha, a, b = (f"{PURCHASE_PARAMS[k]!r}::DOUBLE" for k in ("r", "alpha", "a", "b"))
    p, q, v = (f"{VALUE_PARAMS[k]!r}::DOUBLE" for k in ("p", "q", "v"))
    t = f"{STAR.horizon_days}.0::DOUBLE"
    first, second, third = f"({a} + {b} - 1 - {r})", f"({a} - 1)", f"({a} + {b} + x - 1)"
    return f"""
hist AS (SELECT customer_id, greatest(frequency - 1, 0)::DOUBLE AS x, (age - recency)::DOUBLE AS tx, age::DOUBLE AS age,
                avg_monetary AS m, {t} / ({alpha} + age + {t}) AS z FROM rfm),
series AS (SELECT customer_id, 1 - sum(exp(lgamma({first} + k) - lgamma({first}) + ln(-{second})
                  + lgamma({second} + k) - lgamma({second} + 1) - lgamma({third} + k) + lgamma({third})
                  - lgamma(k + 1) + k * ln(z))) AS hyp
           FROM hist, range(1, 400) AS terms(k) GROUP BY customer_id),
clv AS (SELECT customer_id,
               {third} / {second} * (1 - pow(1 - z, {second}) * hyp)
               / (1 + CASE WHEN x > 0 THEN {a} / ({b} + greatest(x, 1) - 1) * pow(({alpha} + age) / ({alpha} + tx), {r} + x)
                           ELSE 0 END) AS predicted_purchases,
               CASE WHEN x > 0 THEN {p} * ({v} + x * m) / ({p} * x + {q} - 1) ELSE m END AS expected_avg_revenue
        FROM hist JOIN series USING (customer_id)),
scored AS (SELECT feat.*, predicted_purchases, expected_avg_revenue, predicted_purchases * expected_avg_revenue AS clv_12m,
                  {rnd('recency / (recency + 60.0::DOUBLE + 10 * frequency)')} AS churn_prob
           FROM feat LEFT JOIN clv USING (customer_id))"""


SCORED = f"{STAR_FEATURES},{clv_ctes()}"

BY_SCORE = """
byscore AS (SELECT churn_prob, sum(churn_label) AS pos, sum(1 - churn_label) AS neg FROM scored GROUP BY churn_prob),
cum AS (SELECT *, coalesce(sum(pos) OVER below, 0) AS pos_below, coalesce(sum(neg) OVER below, 0) AS neg_below,
               sum(pos) OVER () AS p, sum(neg) OVER () AS q
        FROM byscore WINDOW below AS (ORDER BY churn_prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rankm AS (SELECT sum(pos::DOUBLE * (neg_below + neg / 2.0)) / (max(p)::DOUBLE * max(q)) AS auroc,
                 max(abs(pos_below::DOUBLE / p - neg_below::DOUBLE / q)) AS ks FROM cum)"""

TOP = """
best AS (SELECT churn_label, row_number() OVER (ORDER BY churn_prob DESC, customer_id) AS place,
                count(*) OVER () AS n FROM scored),
topm AS (SELECT count(*) AS top_rows, avg(churn_label) AS precision FROM best
         WHERE place <= greatest(1, floor(n * 0.1::DOUBLE)))"""

EXPORT = f"""
tiers AS (SELECT customer_id, least((row_number() OVER (ORDER BY clv_12m, customer_id) - 1) * 3
                                    // (count(*) OVER () - 1), 2) AS tier
          FROM scored WHERE clv_12m IS NOT NULL),
exported AS (SELECT scored.customer_id AS "Customer ID", {rnd('churn_prob', 2)} AS "Churn Risk Score",
                    {rnd('clv_12m', 2)} AS "Predicted 12M Revenue", rfm_segment AS "RFM Segment",
                    recency::BIGINT AS "Days Since Last Purchase", frequency::BIGINT AS "Total Orders",
                    {rnd('monetary', 2)} AS "Total Revenue",
                    CASE WHEN churn_prob >= 0.7 THEN 'High' WHEN churn_prob >= 0.4 THEN 'Medium' ELSE 'Low' END
                        AS "Churn Risk Band",
                    CASE tier WHEN 0 THEN 'Low Value' WHEN 1 THEN 'Mid Value' WHEN 2 THEN 'High Value' END AS "CLV Tier"
             FROM scored LEFT JOIN tiers ON scored.customer_id = tiers.customer_id)"""

SPLIT = f"""
sizes AS (SELECT churn_label, count(*) AS size, sum(count(*)) OVER () AS n FROM feat GROUP BY churn_label),
parts AS (SELECT *, n - ceil(n * {STAR.test_share!r}::DOUBLE) AS train FROM sizes),
shares AS (SELECT *, floor(train * size / n) AS dealt, train * size / n - floor(train * size / n) AS rest FROM parts),
counts AS (SELECT churn_label, size - dealt
                  - CASE WHEN row_number() OVER (ORDER BY rest DESC, churn_label) <= train - sum(dealt) OVER ()
                         THEN 1 ELSE 0 END AS wanted FROM shares),
hashed AS (SELECT *, ('0x' || substr(md5(customer_id::VARCHAR || '-{STAR.seed}'), 1, 13))::BIGINT AS h FROM feat),
split AS (SELECT hashed.*, row_number() OVER (PARTITION BY hashed.churn_label ORDER BY h, customer_id) <= wanted AS is_test
          FROM hashed JOIN counts USING (churn_label))"""


def _scaler_stats() -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {rnd(f'avg({n})')} AS mean, {rnd(f'stddev_pop({n})')} AS deviation "
        "FROM split WHERE NOT is_test"
        for n in FEATURES
    )


def _scaled() -> str:
    stats = ", ".join(f"avg({n}) AS m_{n}, stddev_pop({n}) AS d_{n}" for n in FEATURES)
    columns = ", ".join(
        rnd(f"({n} - m_{n}) / CASE WHEN d_{n} = 0 THEN 1 ELSE d_{n} END") + f" AS {n}" for n in FEATURES
    )
    return (
        f"WITH {STAR_FEATURES},{SPLIT}, st AS (SELECT {stats} FROM split WHERE NOT is_test) "
        f"SELECT customer_id, {columns} FROM split, st"
    )


def _summary(columns: list[str], source: str, name: str) -> str:
    return f"WITH {source} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (count(*) - count({c}))::BIGINT AS missing, count(*)::BIGINT AS rows, "
        f"{len(columns)}::BIGINT AS columns FROM {name}"
        for c in columns
    )


def _validation(source: str, cfg) -> str:
    now = f"TIMESTAMP '{cfg.snapshot} 00:00:00'"
    checks = [
        ("no_nulls_in_key_columns", "4 * count(*) - count(customer_id) - count(order_id) - count(order_date) - count(revenue)"),
        ("revenue_always_positive", "count(*) - count(*) FILTER (WHERE revenue > 0)"),
        ("no_orders_after_snapshot_date", f"count(*) - count(*) FILTER (WHERE order_date <= {now})"),
        (
            "no_empty_string_ids",
            "count(*) FILTER (WHERE trim(customer_id::VARCHAR) = '' OR trim(order_id::VARCHAR) = '')",
        ),
        (
            f"at_least_{cfg.min_customers}_distinct_customers",
            f"greatest({cfg.min_customers} - count(DISTINCT customer_id), 0)",
        ),
    ]
    return f"WITH {source} " + " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS position, '{name}' AS check_name, ({violations})::BIGINT AS violations, "
        f"({violations}) = 0 AS passed FROM src"
        for i, (name, violations) in enumerate(checks, start=1)
    )


def _report() -> str:
    return f"""WITH {SCORED},
cell AS (SELECT churn_label AS actual, CASE WHEN churn_prob > 0.5 THEN 1 ELSE 0 END AS predicted FROM scored),
cls AS (SELECT c, count(*) FILTER (WHERE actual = c AND predicted = c) AS hit,
               count(*) FILTER (WHERE actual = c) AS support, count(*) FILTER (WHERE predicted = c) AS called
        FROM cell, (VALUES (0), (1)) AS classes(c) GROUP BY c),
m AS (SELECT c, support, CASE WHEN called = 0 THEN 0 ELSE hit::DOUBLE / called END AS p,
             CASE WHEN support = 0 THEN 0 ELSE hit::DOUBLE / support END AS r,
             2.0::DOUBLE * hit / (called + support) AS f, hit, sum(support) OVER () AS n FROM cls)
SELECT c::VARCHAR AS name, {rnd('p')} AS precision, {rnd('r')} AS recall, {rnd('f')} AS f1, support::BIGINT AS support FROM m
UNION ALL SELECT 'accuracy', {rnd('sum(hit)::DOUBLE / max(n)')}, {rnd('sum(hit)::DOUBLE / max(n)')},
                 {rnd('sum(hit)::DOUBLE / max(n)')}, max(n)::BIGINT FROM m
UNION ALL SELECT 'macro avg', {rnd('avg(p)')}, {rnd('avg(r)')}, {rnd('avg(f)')}, max(n)::BIGINT FROM m
UNION ALL SELECT 'weighted avg', {rnd('sum(p * support) / max(n)')}, {rnd('sum(r * support) / max(n)')},
                 {rnd('sum(f * support) / max(n)')}, max(n)::BIGINT FROM m"""


def _bgnbd_likelihood() -> str:
    r, alpha, a, b = (f"{PURCHASE_PARAMS[k]!r}::DOUBLE" for k in ("r", "alpha", "a", "b"))
    return f"""WITH {SCORED},
parts AS (SELECT x, lgamma({r} + x) - lgamma({r}) + {r} * ln({alpha}) AS a1,
                 lgamma({a} + {b}) + lgamma({b} + x) - lgamma({b}) - lgamma({a} + {b} + x) AS a2,
                 pow({alpha} + age, -({r} + x)) AS e3,
                 CASE WHEN x > 0 THEN {a} / ({b} + x - 1) * pow({alpha} + tx, -({r} + x)) ELSE 0 END AS e4 FROM hist)
SELECT {rnd('sum(a1 + a2 + ln(e3 + e4))', 4)} AS log_likelihood, {rnd('count(*)', 4)} AS rows FROM parts"""


def _gg_likelihood() -> str:
    p, q, v = (f"{VALUE_PARAMS[k]!r}::DOUBLE" for k in ("p", "q", "v"))
    return f"""WITH {SCORED}
SELECT {rnd(f'''sum(lgamma({p} * x + {q}) - lgamma({p} * x) - lgamma({q}) + {q} * ln({v}) + ({p} * x - 1) * ln(m)
              + {p} * x * ln(x) - ({p} * x + {q}) * ln(x * m + {v}))''', 4)} AS log_likelihood,
       {rnd('count(*)', 4)} AS rows FROM hist WHERE x > 0"""


def _shifted(params: dict[str, float], name: str, by: float) -> dict[str, str]:
    return {k: f"{v + (by if k == name else 0.0)!r}::DOUBLE" for k, v in params.items()}


def _slopes(params: dict[str, float], row_term, source: str) -> str:
    """Central differences of a row's log-likelihood, averaged."""
    step = 1e-5
    columns = []
    for name in params:
        up, down = (row_term(_shifted(params, name, d)) for d in (step, -step))
        columns.append(f"{rnd(f'avg(({up} - {down}) / {2 * step!r}::DOUBLE)', 5)} AS by_{name}")
    return f"WITH {SCORED} SELECT {', '.join(columns)} FROM {source}"


def _purchase_row(p: dict[str, str]) -> str:
    r, alpha, a, b = (p[k] for k in ("r", "alpha", "a", "b"))
    return f"""(lgamma({r} + x) - lgamma({r}) + {r} * ln({alpha}) + lgamma({a} + {b}) + lgamma({b} + x) - lgamma({b})
        - lgamma({a} + {b} + x) + ln(pow({alpha} + age, -({r} + x))
        + CASE WHEN x > 0 THEN {a} / ({b} + x - 1) * pow({alpha} + tx, -({r} + x)) ELSE 0 END))"""


def _value_row(params: dict[str, str]) -> str:
    p, q, v = (params[k] for k in ("p", "q", "v"))
    return f"""(lgamma({p} * x + {q}) - lgamma({p} * x) - lgamma({q}) + {q} * ln({v}) + ({p} * x - 1) * ln(m)
        + {p} * x * ln(x) - ({p} * x + {q}) * ln(x * m + {v}))"""


def _long_horizon() -> str:
    """The series of every distinct history, term by term."""
    t = f"{LONG_HORIZON!r}::DOUBLE"
    columns, sums = [], []
    for name, params in LONG_PARAMS.items():
        r, alpha, a, b = (f"{params[k]!r}::DOUBLE" for k in ("r", "alpha", "a", "b"))
        first, second, third = f"({a} + {b} - 1 - {r})", f"({a} - 1)", f"({a} + {b} + x - 1)"
        z = f"({t} / ({alpha} + age + {t}))"
        sums.append(f"""1 + {second} * sum(exp(lgamma({first} + k) - lgamma({first}) + lgamma({second} + k) - lgamma({second} + 1)
            - lgamma({third} + k) + lgamma({third}) - lgamma(k + 1) + k * ln({z}))) AS h_{name}""")
        columns.append(rnd(f"{third} / {second} * (1 - pow(1 - {z}, {second}) * h_{name})", 3) + f" AS {name}")
    return f"""WITH {SCORED},
pairs AS (SELECT DISTINCT x, age FROM hist),
summed AS (SELECT x, age, {', '.join(sums)} FROM pairs, range(1, 6000) AS terms(k) GROUP BY x, age)
SELECT x::BIGINT AS repeat_purchases, age::BIGINT AS T, {', '.join(columns)} FROM summed"""


def _tree_ctes() -> str:
    """Given trees as a table of nodes, and each customer's way down every tree."""
    rows = ", ".join(
        f"({t}, {n}, {'NULL' if f is None else repr(f)}, {cut!r}::DOUBLE, {lo}, {hi}, {v * TREE_WEIGHTS[t]!r}::DOUBLE, {cover!r}::DOUBLE)"
        for t, n, f, cut, lo, hi, v, cover in TREE_NODES
    )
    return f"""{STAR_FEATURES},
nodes(tree, node, feature, cut, lo, hi, value, cover) AS (VALUES {rows}),
walk AS (SELECT customer_id, tree, 0 AS node FROM feat, (SELECT DISTINCT tree FROM nodes)
         UNION ALL
         SELECT w.customer_id, w.tree, CASE WHEN {TREE_VALUE} <= cut THEN lo ELSE hi END
         FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NOT NULL
         JOIN feat f ON f.customer_id = w.customer_id),
margins AS (SELECT w.customer_id, r.tree + 1 AS round, sum(n.value) AS margin
            FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NULL
            JOIN (SELECT DISTINCT tree FROM nodes) r ON r.tree >= w.tree
            GROUP BY w.customer_id, r.tree)"""


def _tree_scores() -> str:
    rounds = [f"max(margin) FILTER (WHERE round = {k + 1})" for k in range(len(TREE_WEIGHTS))]
    each = ", ".join(f"{rnd(r)} AS margin_{k + 1}" for k, r in enumerate(rounds))
    return f"""WITH RECURSIVE {_tree_ctes()}
SELECT customer_id, {each}, {rnd(f"1 / (1 + exp(-2 * {rounds[-1]}))")} AS churn_prob FROM margins GROUP BY customer_id"""


def _tree_areas() -> str:
    """Every pair of a churned and a retained customer, by counts of equal margins."""
    return f"""WITH RECURSIVE {_tree_ctes()},
counts AS (SELECT round, margin, sum(churn_label) AS p, sum(1 - churn_label) AS q
           FROM margins JOIN feat USING (customer_id) GROUP BY round, margin),
cum AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY round ORDER BY margin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS below FROM counts)
SELECT round::BIGINT AS round, {rnd('sum(p::DOUBLE * (below + q / 2.0)) / (sum(p)::DOUBLE * sum(q))')} AS auroc FROM cum GROUP BY round"""


def _tree_contributions() -> str:
    """Shapley values from the value of every set of known features of every path."""
    sums = {n: f"coalesce(sum(part) FILTER (WHERE feature = '{n}'), 0)" for n in TREE_FEATURES}
    columns = ", ".join(f"{rnd(total)} AS {n}" for n, total in sums.items())
    return f"""WITH RECURSIVE {_tree_ctes()},
tests AS (SELECT tree, node AS leaf, node, []::STRUCT(feature VARCHAR, low DOUBLE, high DOUBLE, share DOUBLE)[] AS steps
          FROM nodes WHERE feature IS NULL
          UNION ALL
          SELECT t.tree, t.leaf, n.node, list_append(t.steps, {{'feature': n.feature,
                 'low': CASE WHEN n.hi = t.node THEN n.cut ELSE '-infinity'::DOUBLE END,
                 'high': CASE WHEN n.lo = t.node THEN n.cut ELSE 'infinity'::DOUBLE END, 'share': c.cover / n.cover}})
          FROM tests t JOIN nodes n ON n.tree = t.tree AND n.feature IS NOT NULL AND t.node IN (n.lo, n.hi)
          JOIN nodes c ON c.tree = t.tree AND c.node = t.node),
single AS (SELECT tree, leaf, unnest(steps) AS s FROM tests WHERE node = 0),
steps AS (SELECT tree, leaf, s.feature AS feature, max(s.low) AS low, min(s.high) AS high, product(s.share) AS share
          FROM single GROUP BY tree, leaf, s.feature),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, leaf ORDER BY feature) - 1 AS bit,
                    count(*) OVER (PARTITION BY tree, leaf) AS size FROM steps),
passed AS (SELECT customer_id, n.*, CASE WHEN {TREE_VALUE} > low AND {TREE_VALUE} <= high THEN 1 ELSE 0 END::DOUBLE AS pass
           FROM feat, numbered n),
worth AS (SELECT customer_id, tree, leaf, any_value(size) AS size, mask,
                 product(CASE WHEN (mask >> bit) & 1 = 1 THEN pass ELSE share END) AS worth
          FROM passed, range(0, 16) AS masks(mask) WHERE mask < (1 << size) GROUP BY customer_id, tree, leaf, mask),
parts AS (SELECT w.customer_id, s.feature, n.value * w.worth * CASE WHEN (mask >> s.bit) & 1 = 1
                 THEN gamma(bit_count(mask)::DOUBLE) * gamma((w.size - bit_count(mask) + 1)::DOUBLE)
                 ELSE -gamma((bit_count(mask) + 1)::DOUBLE) * gamma((w.size - bit_count(mask))::DOUBLE) END
                 / gamma((w.size + 1)::DOUBLE) AS part
          FROM worth w JOIN numbered s USING (tree, leaf) JOIN nodes n ON n.tree = w.tree AND n.node = w.leaf),
grand AS (SELECT sum(value * share) AS expected FROM (SELECT tree, leaf, product(share) AS share FROM steps GROUP BY tree, leaf) p
         JOIN nodes n ON n.tree = p.tree AND n.node = p.leaf)
SELECT customer_id, {columns}, {rnd('max(expected)')} AS expected_margin FROM parts, grand GROUP BY customer_id"""


def significant(expression: str) -> str:
    """Four significant digits, three behind the point at most."""
    scale = f"pow(10, 3 - floor(log10(greatest({expression}, 1))))"
    return f"CASE WHEN {expression} IS NOT NULL THEN round_even({expression} * {scale}, 0) / {scale} END"


def _fitted_params(model: str, names: list[str], row, rows: str, units: dict[str, str]) -> str:
    """Parameters and their standard errors, null for those that the data do not determine."""
    p = {n: f"p{i}" for i, n in enumerate(names)}
    each = []
    for i, n in enumerate(names):
        value = f"(exp(t{i}) * {units.get(n, '1')})"
        error = f"sqrt(e{i} / (SELECT sum(w) FROM data))"
        shown = significant(f"({value} * {error})")
        each.append(f"SELECT '{model}' AS model, '{n}' AS name, {significant(value)} AS value, {shown} AS standard_error FROM fitted")
    body = newton_ctes(len(names), row(p), "data", STAR.penalizer)
    return f"WITH RECURSIVE {SCORED}, data AS ({rows}), {body} " + " UNION ALL ".join(each)


def _purchase_params() -> str:
    unit = "((SELECT max(age) FROM hist) / 10)"
    rows = f"SELECT x, tx / {unit} AS tx, age / {unit} AS age, count(*)::DOUBLE AS w FROM hist GROUP BY ALL"
    return _fitted_params("purchases", list(PURCHASE_PARAMS), _purchase_row, rows, {"alpha": unit})


def _value_params() -> str:
    return _fitted_params("values", list(VALUE_PARAMS), _value_row, "SELECT x, m, 1::DOUBLE AS w FROM hist WHERE x > 0", {})


def oracle_sql() -> dict[str, str]:
    """SQL by query name; fitted trees have none."""
    star, events = f"WITH {STAR_FEATURES}", f"WITH {EVENT_FEATURES}"
    scored = f"WITH {SCORED}"
    order_columns = ["customer_id", "order_id", "order_date", "revenue", "channel", "is_returned"]
    clv_select = f"""{rnd('predicted_purchases')} AS predicted_purchases,
        {rnd('expected_avg_revenue', 4)} AS expected_avg_revenue, {rnd('clv_12m', 4)} AS clv_12m"""
    return {
        "orders_until_snapshot": f"""WITH {STAR_SOURCE} SELECT customer_id, order_id, order_date::VARCHAR AS order_date,
            {rnd('revenue')} AS revenue, channel, is_returned::BIGINT AS is_returned
            FROM src WHERE order_date <= TIMESTAMP '{STAR.snapshot} 00:00:00'""",
        "run_metrics": f"""{scored},{BY_SCORE},{TOP}
            SELECT 'clv_model' AS stage, 'param' AS kind, 'horizon_months' AS name, 12.0::DOUBLE AS value
            UNION ALL SELECT 'clv_model', 'metric', 'mean_clv_12m', {rnd('avg(clv_12m)', 4)} FROM scored
            UNION ALL SELECT 'clv_model', 'metric', 'median_clv_12m', {rnd('median(clv_12m)', 4)} FROM scored
            UNION ALL SELECT 'churn_model', 'metric', 'auroc', {rnd('auroc', 4)} FROM rankm
            UNION ALL SELECT 'churn_model', 'metric', 'ks_statistic', {rnd('ks', 4)} FROM rankm
            UNION ALL SELECT 'churn_model', 'metric', 'precision_at_top_decile', {rnd('precision', 4)} FROM topm""",
        "rfm": f"{star} SELECT {RFM_SELECT} FROM rfm",
        "rfm_events": f"{events} SELECT {RFM_SELECT} FROM rfm",
        "rfm_top_segments": f"""{star} SELECT rfm_segment, count(*)::BIGINT AS customers FROM rfm GROUP BY rfm_segment
            ORDER BY customers DESC, rfm_segment LIMIT 5""",
        "order_value_stats": f"""{star} SELECT customer_id, {rnd('avg_order_value')} AS avg_order_value,
            {rnd('std_order_value')} AS std_order_value, {rnd('return_rate')} AS return_rate FROM stats""",
        "inter_purchase_time": f"""{star} SELECT customer_id, {rnd('inter_purchase_time_avg')} AS inter_purchase_time_avg
            FROM ipt""",
        "inter_purchase_time_events": f"""{events} SELECT customer_id,
            {rnd('inter_purchase_time_avg')} AS inter_purchase_time_avg FROM ipt""",
        "churn_features": f"{star} SELECT {CHURN_SELECT} FROM feat",
        "churn_features_events": f"{events} SELECT {CHURN_SELECT} FROM feat",
        "churn_label": f"{star} SELECT customer_id, recency::BIGINT AS recency, churn_label::BIGINT AS churn_label FROM feat",
        "churn_label_counts": f"""{star}, c AS (SELECT sum(churn_label) AS churned, count(*) AS total FROM feat),
            s AS (SELECT 'churned' AS status, churned AS customers, total FROM c
                  UNION ALL SELECT 'retained', total - churned, total FROM c)
            SELECT status, customers::BIGINT AS customers, {rnd('customers / total')} AS share,
                   format('{{:.1f}}%', round_even(customers / total * 100.0 * 10, 0) / 10) AS share_text FROM s""",
        "leakage_invariance": f"{star} SELECT {RFM_SELECT} FROM rfm",
        "validation_report": _validation(STAR_SOURCE, STAR),
        "validation_report_observed": _validation(STAR_SOURCE, STAR),
        "features_from_daily_state": f"""{star} SELECT customer_id::BIGINT AS customer_id, frequency::BIGINT AS frequency,
            {rnd('monetary')} AS monetary, recency::BIGINT AS recency, age::BIGINT AS "T", {rnd('avg_monetary')} AS avg_monetary,
            {rnd('avg_order_value')} AS avg_order_value, {rnd('std_order_value')} AS std_order_value,
            {rnd('return_rate')} AS return_rate FROM feat""",
        "validation_report_events": _validation(EVENT_SOURCE, EVENTS),
        "future_rows": f"""WITH {STAR_SOURCE} SELECT count(*)::BIGINT AS future_rows FROM src
            WHERE order_date > TIMESTAMP '{STAR.snapshot} 00:00:00'""",
        "table_summary": _summary(order_columns, STAR_SOURCE, "src"),
        "orders_profile": f"""WITH {STAR_SOURCE} SELECT count(*)::BIGINT AS rows, min(order_date)::DATE::VARCHAR AS first_day,
            max(order_date)::DATE::VARCHAR AS last_day, count(DISTINCT customer_id)::BIGINT AS customers FROM src""",
        "global_rank": f"""SELECT o_orderkey, {rnd('o_totalprice')} AS o_totalprice,
            row_number() OVER (ORDER BY o_totalprice, o_orderkey)::BIGINT AS price_rank FROM orders""",
        "clv_inputs": f"""{star} SELECT customer_id, greatest(frequency - 1, 0)::BIGINT AS repeat_purchases,
            (age - recency)::BIGINT AS age_at_last_purchase, age::BIGINT AS "T" FROM rfm""",
        "bgnbd_expected_purchases": f"""{scored} SELECT customer_id, {rnd('predicted_purchases')} AS predicted_purchases
            FROM clv""",
        "gg_expected_value": f"""{scored} SELECT customer_id, {rnd('expected_avg_revenue', 4)} AS expected_avg_revenue
            FROM clv""",
        "clv_fixed_params": f"{scored} SELECT {RFM_SELECT}, {clv_select} FROM scored",
        "clv_summary": f"""{scored} SELECT {rnd('avg(clv_12m)', 4)} AS mean_clv_12m,
            {rnd('median(clv_12m)', 4)} AS median_clv_12m FROM scored""",
        "bgnbd_likelihood": _bgnbd_likelihood(),
        "gg_likelihood": _gg_likelihood(),
        "bgnbd_gradient": _slopes(PURCHASE_PARAMS, _purchase_row, "hist"),
        "gg_gradient": _slopes(VALUE_PARAMS, _value_row, "hist WHERE x > 0"),
        "bgnbd_params": _purchase_params(),
        "gg_params": _value_params(),
        "bgnbd_purchases_long_horizon": _long_horizon(),
        "model_rows": f"""{star} SELECT customer_id, recency::BIGINT AS recency, frequency::BIGINT AS frequency,
            {rnd('monetary')} AS monetary, R_score::BIGINT AS R_score, F_score::BIGINT AS F_score,
            M_score::BIGINT AS M_score, days_since_first_order::BIGINT AS days_since_first_order,
            {rnd('avg_order_value')} AS avg_order_value, {rnd('std_order_value')} AS std_order_value,
            {rnd('inter_purchase_time_avg')} AS inter_purchase_time_avg, {rnd('return_rate')} AS return_rate,
            churn_label::BIGINT AS churn_label FROM feat
            WHERE {' AND '.join(f'{n} IS NOT NULL' for n in FEATURES)}""",
        "stratified_split": f"{star},{SPLIT} SELECT customer_id, churn_label::BIGINT AS churn_label, is_test FROM split",
        "time_split": f"""{star} SELECT customer_id, recency::BIGINT AS recency,
            row_number() OVER (ORDER BY recency, customer_id)
            <= greatest(1, floor(count(*) OVER () * {STAR.test_share!r}::DOUBLE)) AS is_time_test FROM feat""",
        "class_weight": f"""{star},{SPLIT} SELECT sum(1 - churn_label)::BIGINT AS negatives,
            sum(churn_label)::BIGINT AS positives,
            {rnd('sum(1 - churn_label) / sum(churn_label)')} AS scale_pos_weight FROM split WHERE NOT is_test""",
        "scaler_stats": f"{star},{SPLIT} {_scaler_stats()}",
        "scaled_features": _scaled(),
        "auroc": f"{scored},{BY_SCORE} SELECT {rnd('auroc')} AS auroc FROM rankm",
        "ks_statistic": f"{scored},{BY_SCORE} SELECT {rnd('ks')} AS ks FROM rankm",
        "precision_top_decile": f"""{scored},{TOP} SELECT top_rows::BIGINT AS top_rows, {rnd('precision')} AS precision
            FROM topm""",
        "classification_report": _report(),
        "fixed_tree_scores": _tree_scores(),
        "fixed_tree_contributions": _tree_contributions(),
        "auroc_by_round": _tree_areas(),
        "scored_customers": f"{scored} SELECT {CHURN_SELECT}, {rnd('churn_prob')} AS churn_prob, {clv_select} FROM scored",
        "export_customers": f"{scored},{EXPORT} SELECT * FROM exported",
        "risk_band_counts": f"""{scored},{EXPORT} SELECT "Churn Risk Band" AS risk_band, count(*)::BIGINT AS customers
            FROM exported GROUP BY 1 UNION ALL SELECT 'Total', count(*)::BIGINT FROM exported""",
        "risk_band_revenue": f"""{scored},{EXPORT}, s AS (SELECT "Churn Risk Band" AS risk_band,
            sum("Predicted 12M Revenue") AS revenue FROM exported GROUP BY 1)
            SELECT risk_band, {rnd('revenue', 2)} AS revenue, '£' || format('{{:,.2f}}', revenue) AS revenue_text FROM s""",
        "clv_tier_counts": f"""{scored},{EXPORT} SELECT "CLV Tier" AS clv_tier, count(*)::BIGINT AS customers
            FROM exported GROUP BY 1""",
    }
