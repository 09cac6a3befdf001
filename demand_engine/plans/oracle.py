"""Reference SQL (DuckDB dialect) for the registered queries.

Each entry is standalone: it declares the common table expressions it
needs, over the pre-registered driver tables. Constants are printed from
the same Python values the Spark side uses, cast to DOUBLE so both engines
do the same IEEE arithmetic.
"""

from __future__ import annotations

import math

from ..config import MAPE_EPS, RIDGE_ALPHA, RIDGE_NAME, STUMP_FEATURES, STUMPS, WEEKS_PER_YEAR, InventoryParams
from ..sources.tables import HOLIDAY_ISO_WEEKS, SIZE_OFFSET, TYPE_LETTERS


def d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


FEATURE_COLS = [
    "Store", "Date", "IsHoliday", "Type", "Size", "Weekly_Sales",
    "year", "month", "week_of_year", "quarter", "is_month_end",
    "week_sin", "week_cos", "month_sin", "month_cos", "trend", "type_code", "size_norm",
    "sales_lag_1", "sales_lag_2", "sales_lag_4", "sales_lag_12", "sales_roll_4", "sales_roll_12",
]
FEATURE_ROUND = {
    **{c: 6 for c in ["week_sin", "week_cos", "month_sin", "month_cos", "size_norm", "sales_roll_4", "sales_roll_12"]},
    **{c: 2 for c in ["Weekly_Sales", "sales_lag_1", "sales_lag_2", "sales_lag_4", "sales_lag_12"]},
}
NAIVE = "Naive (Last Value)"
MA = "Moving Average (4w)"


def rnd(cols, digits: dict[str, int], prefix: str = "") -> str:
    out = []
    for c in cols:
        q = f'{prefix}"{c}"'
        out.append(f'round({q}, {digits[c]}) AS "{c}"' if c in digits else f'{q} AS "{c}"')
    return ", ".join(out)


def _two_pi_over(x: str, period: int) -> str:
    return f"{d(2 * math.pi)} * {x} / {d(period)}"


_P = InventoryParams()
_H = _P.holding_cost_pct * _P.unit_value
_NOT_NULL = " AND ".join(f'"{c}" IS NOT NULL' for c in FEATURE_COLS)

CTES: dict[str, str] = {
    "sales": f"""sales AS (
  SELECT l_suppkey AS Store, CAST(date_trunc('week', l_shipdate) AS DATE) AS Date,
         CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS Weekly_Sales,
         weekofyear(l_shipdate) IN {tuple(HOLIDAY_ISO_WEEKS)} AS IsHoliday
  FROM lineitem)""",
    "stores": f"""stores AS (
  SELECT s_suppkey AS Store, substr('{TYPE_LETTERS}', CAST(s_nationkey % 3 + 1 AS INTEGER), 1) AS Type,
         CAST(CAST(floor(s_acctbal) AS INTEGER) + {SIZE_OFFSET} AS BIGINT) AS Size
  FROM supplier)""",
    "store_weekly": """store_weekly AS (
  SELECT s.Store, s.Date, s.IsHoliday, t.Type, t.Size, sum(s.Weekly_Sales) AS Weekly_Sales
  FROM sales s LEFT JOIN stores t ON s.Store = t.Store
  WHERE s.Weekly_Sales >= 0 AND s.Store IS NOT NULL AND s.Date IS NOT NULL AND s.IsHoliday IS NOT NULL
    AND t.Type IS NOT NULL AND t.Size IS NOT NULL
  GROUP BY s.Store, s.Date, s.IsHoliday, t.Type, t.Size)""",
    "features": f"""features AS (
  SELECT Store, Date, IsHoliday, Type, Size, Weekly_Sales,
    CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month,
    CAST(weekofyear(Date) AS INTEGER) AS week_of_year, CAST(quarter(Date) AS INTEGER) AS quarter,
    CAST(Date = last_day(Date) AS INTEGER) AS is_month_end,
    sin({_two_pi_over('weekofyear(Date)', 52)}) AS week_sin,
    cos({_two_pi_over('weekofyear(Date)', 52)}) AS week_cos,
    sin({_two_pi_over('month(Date)', 12)}) AS month_sin,
    cos({_two_pi_over('month(Date)', 12)}) AS month_cos,
    CAST(floor(datediff('day', (SELECT min(Date) FROM store_weekly), Date) / 7) AS INTEGER) AS trend,
    CAST(CASE Type WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS INTEGER) AS type_code,
    (Size - (SELECT avg(Size) FROM store_weekly)) / nullif((SELECT stddev_samp(Size) FROM store_weekly), 0) AS size_norm,
    lag(Weekly_Sales, 1) OVER w AS sales_lag_1, lag(Weekly_Sales, 2) OVER w AS sales_lag_2,
    lag(Weekly_Sales, 4) OVER w AS sales_lag_4, lag(Weekly_Sales, 12) OVER w AS sales_lag_12,
    avg(Weekly_Sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS sales_roll_4,
    avg(Weekly_Sales) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS sales_roll_12
  FROM store_weekly
  WINDOW w AS (PARTITION BY Store ORDER BY Date, IsHoliday, Type, Size))""",
    "cutoff": """cutoff AS (
  SELECT min(Date) FILTER (WHERE rn <= 12) AS cutoff_date, max(Date) FILTER (WHERE rn = 13) AS last_train_date
  FROM (SELECT Date, row_number() OVER (ORDER BY Date DESC) AS rn FROM (SELECT DISTINCT Date FROM features)))""",
    "train": f"""train AS (
  SELECT f.* FROM features f, cutoff c WHERE f.Date < c.cutoff_date AND {_NOT_NULL})""",
    "holdout": f"""holdout AS (
  SELECT f.* FROM features f, cutoff c WHERE f.Date >= c.cutoff_date AND {_NOT_NULL})""",
    "naive_last": """naive_last AS (
  SELECT Store, Weekly_Sales AS last_value FROM (
    SELECT Store, Weekly_Sales,
           row_number() OVER (PARTITION BY Store ORDER BY Date DESC, IsHoliday DESC, Type DESC, Size DESC) AS rn
    FROM train WHERE Weekly_Sales IS NOT NULL AND NOT isnan(Weekly_Sales)) WHERE rn = 1)""",
    "scored": """scored AS (
  SELECT h.Store, h.Date, h.Weekly_Sales, h.Weekly_Sales AS actual,
         coalesce(n.last_value, 0.0) AS pred_Naive_Last_Value,
         coalesce(h.sales_roll_4, 0.0) AS pred_Moving_Average_4w
  FROM holdout h LEFT JOIN naive_last n ON h.Store = n.Store)""",
    "long_preds": f"""long_preds AS (
  SELECT '{NAIVE}' AS Model, actual, pred_Naive_Last_Value AS predicted FROM scored
  UNION ALL
  SELECT '{MA}' AS Model, actual, pred_Moving_Average_4w AS predicted FROM scored)""",
    "metrics": f"""metrics AS (
  SELECT Model,
    round(avg(abs(actual - predicted)), 2) AS MAE,
    round(sqrt(avg((actual - predicted) * (actual - predicted))), 2) AS RMSE,
    round({d(100)} * avg(CASE WHEN abs(actual) > {d(MAPE_EPS)} THEN abs((actual - predicted) / actual) END), 2) AS MAPE,
    round(CASE WHEN var_pop(actual) * count(actual) > 0
          THEN {d(1)} - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual)) END, 4) AS R2
  FROM long_preds GROUP BY Model)""",
    "ranked": """ranked AS (
  SELECT Model, MAE, RMSE, MAPE, R2,
    CAST(row_number() OVER (ORDER BY RMSE ASC NULLS LAST, Model) AS INTEGER) AS Rank,
    round((max(RMSE) OVER () - RMSE) / max(RMSE) OVER () * 100, 1) AS "RMSE_vs_Naive (%)"
  FROM metrics)""",
    "forecasts": f"""forecasts AS (
  SELECT s.*, CASE b.Model WHEN '{NAIVE}' THEN s.pred_Naive_Last_Value WHEN '{MA}' THEN s.pred_Moving_Average_4w END AS predicted
  FROM scored s, (SELECT Model FROM ranked WHERE Rank = 1) b)""",
    "demand_stats": """demand_stats AS (
  SELECT Store, avg(Weekly_Sales) AS avg_weekly_demand, stddev_samp(Weekly_Sales) AS std_weekly_demand,
         count(Weekly_Sales) AS n_weeks,
         round(stddev_samp(Weekly_Sales) / nullif(avg(Weekly_Sales), 0), 3) AS cv
  FROM train GROUP BY Store)""",
    "fwd": """fwd AS (SELECT Store, avg(predicted) AS forecast_avg_demand FROM forecasts GROUP BY Store)""",
    "plan": f"""plan AS (
  SELECT *, round(demand_used * {d(_P.lead_time_weeks + _P.review_period_weeks)} + safety_stock, 2) AS recommended_order_qty,
         coalesce(forecast_avg_demand > avg_weekly_demand * {d(_P.alert_threshold)}, false) AS replenishment_alert
  FROM (
    SELECT *,
      round({d(_P.z_score)} * std_weekly_demand * {d(math.sqrt(_P.lead_time_weeks))}, 2) AS safety_stock,
      round(demand_used * {d(_P.lead_time_weeks)} + {d(_P.z_score)} * std_weekly_demand * {d(math.sqrt(_P.lead_time_weeks))}, 2) AS reorder_point,
      round(CASE WHEN demand_used * {d(WEEKS_PER_YEAR)} <= 0 THEN {d(0)}
                 ELSE sqrt({d(2)} * (demand_used * {d(WEEKS_PER_YEAR)}) * {d(_P.ordering_cost)} / {d(_H)}) END, 2) AS eoq
    FROM (SELECT ds.Store, ds.avg_weekly_demand, ds.std_weekly_demand, ds.n_weeks, ds.cv, f.forecast_avg_demand,
                 coalesce(f.forecast_avg_demand, ds.avg_weekly_demand) AS demand_used
          FROM demand_stats ds LEFT JOIN fwd f ON ds.Store = f.Store)))""",
    "plan_history": f"""plan_history AS (
  SELECT *, round(demand_used * {d(_P.lead_time_weeks + _P.review_period_weeks)} + safety_stock, 2) AS recommended_order_qty,
         false AS replenishment_alert
  FROM (
    SELECT *,
      round({d(_P.z_score)} * std_weekly_demand * {d(math.sqrt(_P.lead_time_weeks))}, 2) AS safety_stock,
      round(demand_used * {d(_P.lead_time_weeks)} + {d(_P.z_score)} * std_weekly_demand * {d(math.sqrt(_P.lead_time_weeks))}, 2) AS reorder_point,
      round(CASE WHEN demand_used * {d(WEEKS_PER_YEAR)} <= 0 THEN {d(0)}
                 ELSE sqrt({d(2)} * (demand_used * {d(WEEKS_PER_YEAR)}) * {d(_P.ordering_cost)} / {d(_H)}) END, 2) AS eoq
    FROM (SELECT *, avg_weekly_demand AS demand_used FROM demand_stats)))""",
    "first_per_type": """first_per_type AS (
  SELECT Type, min(Store) AS Store FROM store_weekly WHERE Store IS NOT NULL AND Type IS NOT NULL
  GROUP BY Type ORDER BY Type LIMIT 3)""",
}

ORDER = list(CTES)
DEPS = {
    "store_weekly": ["sales", "stores"],
    "features": ["store_weekly"],
    "cutoff": ["features"],
    "train": ["cutoff"],
    "holdout": ["cutoff"],
    "naive_last": ["train"],
    "scored": ["holdout", "naive_last"],
    "long_preds": ["scored"],
    "metrics": ["long_preds"],
    "ranked": ["metrics"],
    "forecasts": ["ranked"],
    "demand_stats": ["train"],
    "fwd": ["forecasts"],
    "plan": ["demand_stats", "fwd"],
    "plan_history": ["demand_stats"],
    "first_per_type": ["store_weekly"],
}


def _closure(names) -> list[str]:
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n not in need:
            need.add(n)
            stack.extend(DEPS.get(n, []))
    return [n for n in ORDER if n in need]


def with_ctes(body: str, *names: str) -> str:
    parts = [CTES[n] for n in _closure(names)]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


PLAN_COLS = ["Store", "avg_weekly_demand", "std_weekly_demand", "n_weeks", "cv", "forecast_avg_demand", "demand_used",
             "safety_stock", "reorder_point", "eoq", "recommended_order_qty", "replenishment_alert"]
PLAN_ROUND = {"avg_weekly_demand": 6, "std_weekly_demand": 6, "forecast_avg_demand": 6, "demand_used": 6}
LINEAR = ["trend", "week_sin", "week_cos", "month_sin", "month_cos", "quarter", "is_month_end", "IsHoliday",
          "type_code", "size_norm"]
TREE = LINEAR + ["sales_lag_1", "sales_lag_2", "sales_lag_4", "sales_lag_12", "sales_roll_4", "sales_roll_12"]


def _fill0(c: str) -> str:
    return f'coalesce(CAST("{c}" AS DOUBLE), 0.0)'


def _metric(name: str, expr: str) -> str:
    return with_ctes(f"SELECT Model, round({expr}, 6) AS {name} FROM long_preds GROUP BY Model", "long_preds")


def _validation_chrono() -> str:
    return with_ctes("""
, need AS (SELECT greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) AS n_val FROM train),
per_date AS (SELECT Date, count(*) AS c FROM train GROUP BY Date),
suffix AS (SELECT Date, c, coalesce(sum(c) OVER (ORDER BY Date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS after
           FROM per_date),
boundary AS (SELECT max(Date) AS b FROM suffix, need WHERE after < n_val AND after + c >= n_val)
SELECT t.Store, t.Date, coalesce(t.Date >= bd.b, false) AS is_validation FROM train t, boundary bd""", "train")


def _validation_tail() -> str:
    return with_ctes("""
, need AS (SELECT greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) AS n_val FROM train),
per_store AS (SELECT Store, count(*) AS c FROM train GROUP BY Store),
offs AS (SELECT Store, coalesce(sum(c) OVER (ORDER BY Store DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS after
         FROM per_store)
SELECT t.Store, t.Date,
       (row_number() OVER (PARTITION BY t.Store ORDER BY t.Date DESC, t.IsHoliday DESC, t.Type DESC, t.Size DESC) + o.after)
         <= n.n_val AS is_validation
FROM train t JOIN offs o ON t.Store = o.Store, need n""", "train")


def _fix_leading_comma(sql: str) -> str:
    # ``with_ctes`` + a body that opens with more CTEs.
    return sql.replace("\n\n, ", ",\n").replace(")\n\n, ", "),\n")


_BOX = """
, points AS (SELECT Store, Date, Type, Weekly_Sales / 1e6 AS v, Weekly_Sales AS raw FROM store_weekly),
quart AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT Type, quantile_cont(raw, 0.25) / 1e6 AS q1, quantile_cont(raw, 0.5) / 1e6 AS median, quantile_cont(raw, 0.75) / 1e6 AS q3 FROM points GROUP BY Type))"""


def _stump_ctes() -> str:
    """Boosting by stumps: ``round_t`` are the training rows with their margin
    after t rounds, ``best_t`` the split that round t + 1 makes of them."""
    p, xs = STUMPS, [f"x{i}" for i in range(len(STUMP_FEATURES))]
    inputs = ", ".join(f"{_fill0(c)} AS {x}" for c, x in zip(STUMP_FEATURES, xs, strict=True))
    flagged = _validation_chrono().replace("SELECT t.Store, t.Date,", "SELECT t.*,")
    out = [f"stump_rows AS MATERIALIZED (SELECT Weekly_Sales AS y, {inputs}, is_validation AS v FROM ({flagged}))",
           "stump_start AS (SELECT avg(y) AS m, count(*) AS n FROM stump_rows WHERE NOT v)",
           "round_0 AS MATERIALIZED (SELECT r.*, m FROM stump_rows r, stump_start)"]
    chosen = "CASE f " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(xs)) + " END"
    for t in range(p.n_estimators):
        long = " UNION ALL ".join(f"SELECT {i} AS f, {x} AS x, y - m AS g FROM round_{t} WHERE NOT v" for i, x in enumerate(xs))
        out += [
            f"sums_{t} AS (SELECT f, x, sum(g) AS s, count(*) AS k FROM ({long}) GROUP BY f, x)",
            f"""cuts_{t} AS (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS nx, sum(s) OVER w AS gl, sum(k) OVER w AS nl,
  sum(s) OVER (PARTITION BY f) AS g, sum(k) OVER (PARTITION BY f) AS n FROM sums_{t} WINDOW w AS (PARTITION BY f ORDER BY x))""",
            f"""best_{t} AS MATERIALIZED (SELECT f, x + (nx - x) / 2 AS c, CAST(nl AS BIGINT) AS nl, CAST(n - nl AS BIGINT) AS nr, {d(p.learning_rate)} * gl / nl AS lv, {d(p.learning_rate)} * (g - gl) / (n - nl) AS rv
  FROM cuts_{t} WHERE nx IS NOT NULL AND nl >= {p.min_child_samples} AND n - nl >= {p.min_child_samples}
  ORDER BY gl * gl / nl + (g - gl) * (g - gl) / (n - nl) - g * g / n DESC, f, c LIMIT 1)""",
            f"round_{t + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (m), m + CASE WHEN {chosen} <= c THEN lv ELSE rv END AS m FROM round_{t} r, best_{t})",
        ]
    losses = " UNION ALL ".join(f"SELECT {t} AS t, avg((y - m) * (y - m)) AS loss FROM round_{t} WHERE v" for t in range(1, p.n_estimators + 1))
    out.append(f"kept AS (SELECT t FROM ({losses}) ORDER BY loss, t LIMIT 1)")
    return "\n, " + ",\n".join(out)


def _ridge_ctes() -> str:
    """Ridge by its normal equations: sums of products of the standardised
    features, solved by Gauss-Jordan steps, one subquery for each step."""
    n = len(LINEAR)
    mom = ", ".join(f"avg({_fill0(c)}) AS m_{i}, stddev_pop({_fill0(c)}) AS s_{i}" for i, c in enumerate(LINEAR))

    def scaled(t: str) -> str:
        return ", ".join(f"({_fill0(c).replace(chr(34) + c, t + '.' + chr(34) + c)} - m_{i}) / CASE WHEN s_{i} > 0 THEN s_{i} ELSE 1.0 END AS z_{i}" for i, c in enumerate(LINEAR))

    entries = [f"sum(z_{i} * z_{j}){f' + {d(RIDGE_ALPHA)}' if i == j else ''} AS a_{i}_{j}" for i in range(n) for j in range(n)]
    entries += [f"sum(z_{i} * (y - mu)) AS a_{i}_{n}" for i in range(n)]
    steps = []
    for k in range(n):
        cells = ", ".join(
            f"a_{i}_{j} / a_{k}_{k} AS a_{i}_{j}" if i == k else f"a_{i}_{j} - a_{i}_{k} / a_{k}_{k} * a_{k}_{j} AS a_{i}_{j}" for i in range(n) for j in range(n + 1)
        )
        steps.append(f"step{k + 1} AS (SELECT {cells} FROM step{k})")
    weights = " + ".join(f"w.a_{i}_{n} * h.z_{i}" for i in range(n))
    return f"""
, mom AS (SELECT {mom}, avg(Weekly_Sales) AS mu FROM train),
z AS (SELECT {scaled("t")}, t.Weekly_Sales AS y, mu FROM train t, mom),
step0 AS (SELECT {", ".join(entries)} FROM z),
{("," + chr(10)).join(steps)},
zh AS (SELECT h.Store, h.Date, h.Weekly_Sales, {scaled("h")}, mu FROM holdout h, mom),
ridge_scored AS (SELECT h.Store, h.Date, h.Weekly_Sales, greatest(mu + {weights}, 0.0) AS pred_Ridge_Regression FROM zh h, step{n} w)"""


def oracle_sql() -> dict[str, str]:
    fr = FEATURE_ROUND
    sq: dict[str, str] = {}
    sq["scan_sales"] = with_ctes("SELECT Store, Date, round(Weekly_Sales, 2) AS Weekly_Sales, IsHoliday FROM sales", "sales")
    sq["scan_stores"] = with_ctes("SELECT Store, Type, Size FROM stores", "stores")
    sw = 'SELECT Store, Date, IsHoliday, Type, Size, round(Weekly_Sales, 2) AS Weekly_Sales FROM store_weekly'
    sq["write_table"] = with_ctes(sw, "store_weekly")
    sq["csv_roundtrip"] = with_ctes(sw, "store_weekly")
    sq["store_weekly"] = with_ctes(sw, "store_weekly")
    sq["dataset_profile"] = with_ctes("""SELECT min(Date) AS first_date, max(Date) AS last_date,
        count(DISTINCT Store) AS n_stores, count(DISTINCT Date) AS n_weeks, count(*) AS n_rows FROM store_weekly""",
                                      "store_weekly")
    sq["raw_profile"] = with_ctes("""SELECT (SELECT count(*) FROM sales) AS n_sales_rows,
        (SELECT count(DISTINCT Store) FROM stores) AS n_stores""", "sales", "stores")
    sq["negative_sales_profile"] = with_ctes("""SELECT n_rows, n_dropped,
        round(100.0 * (CAST(n_dropped AS DOUBLE) / n_rows), 4) AS pct_dropped FROM (
        SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE NOT coalesce(Weekly_Sales >= 0 AND NOT isnan(Weekly_Sales), false)) AS n_dropped
        FROM sales)""", "sales")
    sq["split_profile"] = with_ctes("""SELECT (SELECT count(*) FROM train) AS train_rows,
        (SELECT count(*) FROM holdout) AS holdout_rows, last_train_date, cutoff_date FROM cutoff""", "train", "holdout")
    sq["clean_sales"] = with_ctes("""SELECT Store, Date, round(Weekly_Sales, 2) AS Weekly_Sales, IsHoliday
        FROM sales WHERE Weekly_Sales >= 0 AND NOT isnan(Weekly_Sales)""", "sales")
    sq["drop_incomplete"] = with_ctes(f"SELECT {rnd(FEATURE_COLS, fr)} FROM features WHERE {_NOT_NULL}", "features")
    sq["train_rows"] = with_ctes("""SELECT f.Store, f.Date, round(f.Weekly_Sales, 2) AS Weekly_Sales
        FROM features f, cutoff c WHERE f.Date < c.cutoff_date""", "cutoff")
    sq["holdout_rows"] = with_ctes("""SELECT f.Store, f.Date, round(f.Weekly_Sales, 2) AS Weekly_Sales
        FROM features f, cutoff c WHERE f.Date >= c.cutoff_date""", "cutoff")
    sq["enrich_stores"] = with_ctes("""SELECT s.Store, s.Date, round(s.Weekly_Sales, 2) AS Weekly_Sales, s.IsHoliday,
        t.Type, t.Size FROM sales s LEFT JOIN stores t ON s.Store = t.Store""", "sales", "stores")
    sq["enrich_stores_skewed"] = sq["enrich_stores"]
    sq["type_code_lookup"] = with_ctes("""SELECT Type,
        CAST(CASE Type WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS INTEGER) AS type_code
        FROM (SELECT DISTINCT Type FROM store_weekly)""", "store_weekly")
    sq["first_date"] = with_ctes("SELECT min(Date) AS first_date FROM store_weekly", "store_weekly")
    sq["size_moments"] = with_ctes("""SELECT round(avg(Size), 6) AS size_mean, round(stddev_samp(Size), 6) AS size_std
        FROM store_weekly""", "store_weekly")
    cal = ["year", "month", "week_of_year", "quarter", "is_month_end", "trend"]
    trig = ["week_sin", "week_cos", "month_sin", "month_cos"]
    sq["time_features"] = with_ctes(f"SELECT {rnd(['Store', 'Date'] + cal + trig, fr)} FROM features", "features")
    sq["store_features"] = with_ctes(f"SELECT {rnd(['Store', 'Date', 'Type', 'type_code', 'size_norm'], fr)} FROM features",
                                     "features")
    lags = ["sales_lag_1", "sales_lag_2", "sales_lag_4", "sales_lag_12"]
    sq["lag_features"] = with_ctes(f"SELECT {rnd(['Store', 'Date'] + lags, fr)} FROM features", "features")
    sq["rolling_features"] = with_ctes(f"SELECT {rnd(['Store', 'Date', 'sales_roll_4', 'sales_roll_12'], fr)} FROM features",
                                       "features")
    sq["prepare_features"] = with_ctes(f"SELECT {rnd(FEATURE_COLS, fr)} FROM features", "features")
    sq["cutoff_date"] = with_ctes("SELECT cutoff_date, last_train_date FROM cutoff", "cutoff")
    sq["train_holdout_split"] = with_ctes("""SELECT Store, Date, round(Weekly_Sales, 2) AS Weekly_Sales, 'train' AS split FROM train
        UNION ALL SELECT Store, Date, round(Weekly_Sales, 2) AS Weekly_Sales, 'holdout' AS split FROM holdout""",
                                          "train", "holdout")
    sq["validation_tail"] = _fix_leading_comma(_validation_chrono())
    sq["validation_tail_rows"] = _fix_leading_comma(_validation_tail())
    sq["naive_last"] = with_ctes("SELECT Store, round(last_value, 2) AS last_value FROM naive_last", "naive_last")
    sq["naive_lookup"] = with_ctes("""SELECT Store, Date, round(pred_Naive_Last_Value, 2) AS pred_Naive_Last_Value
        FROM scored""", "scored")
    sq["forecast_naive"] = sq["naive_lookup"]
    sq["forecast_moving_average"] = with_ctes("""SELECT Store, Date, round(pred_Moving_Average_4w, 6) AS pred_Moving_Average_4w
        FROM scored""", "scored")
    fc_round = {"Weekly_Sales": 2, "actual": 2, "pred_Naive_Last_Value": 2, "pred_Moving_Average_4w": 6, "predicted": 6}
    fc_cols = ["Store", "Date", "Weekly_Sales", "actual", "pred_Naive_Last_Value", "pred_Moving_Average_4w", "predicted"]
    sq["forecast_table"] = with_ctes(f"SELECT {rnd(fc_cols, fc_round)} FROM forecasts", "forecasts")
    sq["mae"] = _metric("MAE", "avg(abs(actual - predicted))")
    sq["rmse"] = _metric("RMSE", "sqrt(avg((actual - predicted) * (actual - predicted)))")
    sq["mape"] = _metric("MAPE", f"{d(100)} * avg(CASE WHEN abs(actual) > {d(MAPE_EPS)} THEN abs((actual - predicted) / actual) END)")
    sq["r2"] = _metric("R2", f"""CASE WHEN var_pop(actual) * count(actual) > 0
        THEN {d(1)} - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual)) END""")
    sq["nonzero_actuals"] = with_ctes(f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE abs(actual) > {d(MAPE_EPS)}) AS n_nonzero
        FROM scored""", "scored")
    sq["evaluate_models"] = with_ctes("SELECT Model, MAE, RMSE, MAPE, R2 FROM metrics", "metrics")
    sq["rank_models"] = with_ctes("SELECT Model, RMSE, Rank FROM ranked", "ranked")
    sq["rmse_vs_worst"] = with_ctes('SELECT Model, RMSE, "RMSE_vs_Naive (%)" FROM ranked', "ranked")
    sq["model_comparison"] = with_ctes("SELECT * FROM ranked", "ranked")
    sq["best_model"] = with_ctes("SELECT * FROM ranked WHERE Rank = 1", "ranked")
    sq["demand_stats"] = with_ctes("""SELECT Store, round(avg_weekly_demand, 6) AS avg_weekly_demand,
        round(std_weekly_demand, 6) AS std_weekly_demand, n_weeks, cv FROM demand_stats""", "demand_stats")
    sq["mean_forecast_by_store"] = with_ctes("SELECT Store, round(forecast_avg_demand, 6) AS forecast_avg_demand FROM fwd",
                                             "fwd")
    sq["attach_forecast"] = with_ctes("""SELECT d.Store, round(d.avg_weekly_demand, 6) AS avg_weekly_demand,
        round(f.forecast_avg_demand, 6) AS forecast_avg_demand FROM demand_stats d LEFT JOIN fwd f ON d.Store = f.Store""",
                                      "demand_stats", "fwd")
    hist_cols = [c for c in PLAN_COLS if c != "forecast_avg_demand"]
    sq["inventory_plan_history"] = with_ctes(f"SELECT {rnd(hist_cols, PLAN_ROUND)} FROM plan_history", "plan_history")
    sq["inventory_plan"] = with_ctes(f"SELECT {rnd(PLAN_COLS, PLAN_ROUND)} FROM plan", "plan")
    sq["replenishment_alerts"] = with_ctes("""SELECT Store, round(demand_used, 6) AS demand_used, safety_stock, reorder_point,
        recommended_order_qty FROM plan WHERE replenishment_alert""", "plan")
    sq["plan_summary"] = with_ctes("""SELECT count(*) AS n_stores, count(*) FILTER (WHERE replenishment_alert) AS n_alerts,
        round(avg(safety_stock), 4) AS avg_safety_stock, round(avg(reorder_point), 4) AS avg_reorder_point,
        round(avg(eoq), 4) AS avg_eoq FROM plan""", "plan")
    sq["first_store_per_type"] = with_ctes("SELECT Type, Store FROM first_per_type", "first_per_type")
    sq["store_subset"] = with_ctes("""SELECT Store, Date, IsHoliday, Type, Size, round(Weekly_Sales, 2) AS Weekly_Sales
        FROM store_weekly WHERE Store IN (SELECT Store FROM first_per_type)""", "first_per_type")
    sq["holiday_dates"] = with_ctes("""SELECT DISTINCT Date, CAST(Date + INTERVAL 7 DAY AS DATE) AS band_end
        FROM store_weekly WHERE IsHoliday AND Store IN (SELECT Store FROM first_per_type)""", "first_per_type")
    sq["demand_trend_data"] = with_ctes("""SELECT Store, Type, Date, IsHoliday, round(Weekly_Sales / 1e6, 8) AS sales_musd
        FROM store_weekly WHERE Store IN (SELECT Store FROM first_per_type)""", "first_per_type")
    sq["actual_by_date"] = with_ctes("SELECT Date, round(sum(Weekly_Sales), 2) AS actual_total FROM holdout GROUP BY Date",
                                     "holdout")
    sq["predicted_by_date"] = with_ctes("""SELECT Date, round(sum(pred_Naive_Last_Value), 2) AS pred_Naive_Last_Value,
        round(sum(pred_Moving_Average_4w), 4) AS pred_Moving_Average_4w FROM scored GROUP BY Date""", "scored")
    sq["actual_vs_predicted_data"] = with_ctes("""SELECT Date, round(sum(actual) / 1e6, 11) AS actual_musd,
        round(sum(pred_Naive_Last_Value) / 1e6, 11) AS pred_Naive_Last_Value,
        round(sum(pred_Moving_Average_4w) / 1e6, 11) AS pred_Moving_Average_4w FROM scored GROUP BY Date""", "scored")
    sq["model_comparison_data"] = with_ctes("""SELECT Model, 'MAE' AS metric, MAE AS value FROM ranked
        UNION ALL SELECT Model, 'RMSE', RMSE FROM ranked UNION ALL SELECT Model, 'MAPE', MAPE FROM ranked""", "ranked")
    sq["plan_head"] = with_ctes(f"SELECT {rnd(PLAN_COLS, PLAN_ROUND)} FROM plan ORDER BY Store LIMIT 20", "plan")
    sq["inventory_scatter_data"] = with_ctes("""SELECT Store, round(avg_weekly_demand / 1e6, 9) AS avg_demand_musd,
        round(reorder_point / 1e6, 8) AS reorder_point_musd, replenishment_alert,
        round(CASE WHEN rel < 30 THEN 30.0 ELSE rel END, 6) AS bubble_size
        FROM (SELECT *, safety_stock / nullif(max(safety_stock) OVER (), 0) * 400.0 AS rel
              FROM (SELECT * FROM plan ORDER BY Store LIMIT 20))""", "plan")
    sq["residual_data"] = with_ctes("""SELECT Store, Date, round(predicted / 1e6, 11) AS predicted_musd,
        round((actual - predicted) / 1e6, 11) AS residual_musd FROM forecasts""", "forecasts")
    sq["residual_histogram"] = _fix_leading_comma(with_ctes("""
, res AS (SELECT (actual - predicted) / 1e6 AS x FROM forecasts),
rng AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM res),
guess AS (SELECT x, lo, hi, (hi - lo) / 40.0 AS w, least(CAST(floor((x - lo) / (hi - lo) * 40.0) AS INTEGER), 39) AS g
          FROM res, rng WHERE x IS NOT NULL),
counts AS (SELECT g - CAST(x < lo + g * w AS INTEGER)
                  + CAST(g < 39 AND x >= (CASE WHEN g + 1 = 40 THEN hi ELSE lo + (g + 1) * w END) AS INTEGER) + 1 AS bin, count(*) AS n
           FROM guess GROUP BY 1)
SELECT b.bin, round(lo + (b.bin - 1) * ((hi - lo) / 40.0), 6) AS bin_lo, round(lo + b.bin * ((hi - lo) / 40.0), 6) AS bin_hi,
       coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 41)) b CROSS JOIN rng LEFT JOIN counts c ON b.bin = c.bin""",
                                                            "forecasts"))
    sq["select_linear_features"] = with_ctes(
        "SELECT Store, Date, " + ", ".join(f"round({_fill0(c)}, 6) AS {c}" for c in LINEAR) + " FROM holdout", "holdout")
    sq["select_tree_features"] = with_ctes(
        "SELECT Store, Date, " + ", ".join(f"round({_fill0(c)}, 6) AS {c}" for c in TREE) + " FROM holdout", "holdout")
    mom = ", ".join(f"avg({_fill0(c)}) AS m_{c}, stddev_pop({_fill0(c)}) AS s_{c}" for c in LINEAR)
    scaled = ", ".join(
        f"round(({_fill0(c)} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END, 6) AS {c}" for c in LINEAR)
    sq["standard_scaler"] = with_ctes(f"SELECT Store, Date, {scaled} FROM holdout, (SELECT {mom} FROM train)",
                                      "train", "holdout")
    sq["executive_summary"] = with_ctes("""SELECT p.first_date, p.last_date, p.n_stores, b.best_model, b.rmse_gain_pct,
        i.avg_safety_stock, i.avg_reorder_point, i.avg_eoq, i.n_alerts, 12 AS holdout_weeks
        FROM (SELECT min(Date) AS first_date, max(Date) AS last_date, count(DISTINCT Store) AS n_stores FROM store_weekly) p,
             (SELECT Model AS best_model, "RMSE_vs_Naive (%)" AS rmse_gain_pct FROM ranked WHERE Rank = 1) b,
             (SELECT round(avg(safety_stock), 4) AS avg_safety_stock, round(avg(reorder_point), 4) AS avg_reorder_point,
                     round(avg(eoq), 4) AS avg_eoq, count(*) FILTER (WHERE replenishment_alert) AS n_alerts FROM plan) i""",
                                        "plan", "store_weekly")
    sq["pipeline_baselines"] = sq["inventory_plan"]
    sq["sales_distribution_by_type"] = _fix_leading_comma(with_ctes(_BOX + """
SELECT q.Type, round(q1, 8) AS q1, round(median, 8) AS median, round(q3, 8) AS q3, round(min(v) FILTER (WHERE v >= lo AND v <= hi), 8) AS whisker_lo,
       round(max(v) FILTER (WHERE v >= lo AND v <= hi), 8) AS whisker_hi, count(*) AS n, count(*) FILTER (WHERE NOT (v >= lo AND v <= hi)) AS n_outliers
FROM quart q JOIN points p ON q.Type = p.Type GROUP BY q.Type, q1, median, q3""", "store_weekly"))
    sq["sales_outliers_by_type"] = _fix_leading_comma(with_ctes(_BOX + """
, spans AS (SELECT q.Type, min(v) FILTER (WHERE v >= lo AND v <= hi) AS a, max(v) FILTER (WHERE v >= lo AND v <= hi) AS b
          FROM quart q JOIN points p ON q.Type = p.Type GROUP BY q.Type)
SELECT p.Store, p.Date, p.Type, round(v, 8) AS sales_musd FROM points p JOIN spans s ON p.Type = s.Type WHERE v < a OR v > b""", "store_weekly"))
    ridge = _ridge_ctes()
    sq["forecast_ridge"] = _fix_leading_comma(with_ctes(ridge + """
SELECT Store, Date, round(pred_Ridge_Regression, 2) AS pred_Ridge_Regression FROM ridge_scored""", "train", "holdout"))
    stumps, rounds = _stump_ctes(), range(STUMPS.n_estimators)
    value = " + ".join([f"CASE WHEN {t} < t THEN CASE WHEN (CASE b{t}.f " + " ".join(f"WHEN {i} THEN {_fill0(c)}" for i, c in enumerate(STUMP_FEATURES)) + f" END) <= b{t}.c THEN b{t}.lv ELSE b{t}.rv END ELSE 0.0 END" for t in rounds])
    sq["forecast_stumps"] = _fix_leading_comma(with_ctes(stumps + f"""
SELECT Store, Date, round(greatest(m + {value}, 0.0), 2) AS pred_Gradient_Boosted_Trees FROM holdout, stump_start, kept, {", ".join(f"best_{t} b{t}" for t in rounds)}""", "train", "holdout"))
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(STUMP_FEATURES)) + " END"
    nodes = " UNION ALL ".join(f"""SELECT {t} AS tree, 0 AS node, 1 AS "left", 2 AS "right", {names} AS feature, c AS threshold, nl + nr AS n_rows, NULL AS value, kept.t FROM best_{t}, kept
UNION ALL SELECT {t}, 1, -1, -1, NULL, NULL, nl, round(lv, 3), kept.t FROM best_{t}, kept UNION ALL SELECT {t}, 2, -1, -1, NULL, NULL, nr, round(rv, 3), kept.t FROM best_{t}, kept""" for t in rounds)
    sq["stump_table"] = _fix_leading_comma(with_ctes(stumps + f"""
SELECT tree, node, "left", "right", feature, threshold, n_rows, value FROM ({nodes}) WHERE tree < t""", "train", "holdout"))
    three = ridge + f"""
, long3 AS (SELECT Model, actual, predicted FROM long_preds
          UNION ALL SELECT '{RIDGE_NAME}', Weekly_Sales, pred_Ridge_Regression FROM ridge_scored),
metrics3 AS ({CTES["metrics"].split("AS (", 1)[1].rsplit(")", 1)[0].replace("long_preds", "long3")})"""
    sq["evaluate_models_ridge"] = _fix_leading_comma(with_ctes(three + "\nSELECT Model, MAE, RMSE, MAPE, R2 FROM metrics3", "train", "holdout", "long_preds"))
    ranked3 = CTES["ranked"].split("AS (", 1)[1].rsplit(")", 1)[0].replace("FROM metrics", "FROM metrics3")
    sq["model_comparison_ridge"] = _fix_leading_comma(with_ctes(three + "\n" + ranked3, "train", "holdout", "long_preds"))
    money = lambda x: f"'$' || format('{{:,}}', CAST(round({x}) AS BIGINT))"
    sq["plan_summary_text"] = with_ctes(f"""SELECT CAST(line_no AS INTEGER) AS line_no, value FROM (
        SELECT unnest(range(5)) AS line_no, unnest(['Stores planned: ' || n, 'Stores to replenish: ' || a, 'Mean safety stock: ' || {money("s")},
          'Mean reorder point: ' || {money("r")}, 'Mean economic order: ' || {money("e")}]) AS value
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE replenishment_alert) AS a, avg(safety_stock) AS s, avg(reorder_point) AS r, avg(eoq) AS e FROM plan))""", "plan")
    sq["report_text"] = with_ctes(f"""SELECT CAST(line_no AS INTEGER) AS line_no, value FROM (
        SELECT unnest([0, 1]) AS line_no, unnest(['Sales of ' || n || ' stores from ' || a || ' to ' || b, 'Forecasts are held against the last 12 weeks']) AS value
        FROM (SELECT count(DISTINCT Store) AS n, min(Date) AS a, max(Date) AS b FROM store_weekly)
        UNION ALL SELECT 100 + Rank, Rank || '. ' || Model || ': mean error ' || {money("MAE")} || ', root mean square ' || {money("RMSE")}
          || ', relative ' || printf('%.2f', MAPE) || '%' FROM ranked
        UNION ALL SELECT unnest([1000, 1001, 1002, 1003]), unnest([Model || ' has the least error, ' || printf('%.1f', gain) || '% under the worst',
          'Stock for {_P.lead_time_weeks:g} weeks of delivery at a service level of {_P.service_level:.0%}',
          'Safety stock ' || {money("s")} || ', reorder point ' || {money("r")} || ', economic order ' || {money("e")} || ' (means)',
          al || ' stores should order early'])
        FROM (SELECT Model, "RMSE_vs_Naive (%)" AS gain FROM ranked WHERE Rank = 1),
             (SELECT avg(safety_stock) AS s, avg(reorder_point) AS r, avg(eoq) AS e, count(*) FILTER (WHERE replenishment_alert) AS al FROM plan))""", "plan", "ranked", "store_weekly")
    return sq
