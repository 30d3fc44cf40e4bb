"""The registered queries in plain SQL over the same tables, for DuckDB.

Features are looked up by month distance here, not by window frames, so they check the Spark side
along a second route. Amounts are summed as decimals and rounded on the decimal value on both sides.
"""

from __future__ import annotations


def _round(value: str, places: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(30,10)), {places}) AS DOUBLE)"


def _sum(name: str) -> str:
    return f"CAST(SUM(CAST({name} AS DECIMAL(18,4))) AS DOUBLE)"


def _month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def _number(month: str) -> str:
    return f"(year({month}) * 12 + month({month}))"


_MONEY = "{0} AS total_sales, {1} AS total_profit".format(_round(_sum("sales"), 2), _round(_sum("profit"), 2))
_MARGIN = _round(f"{_sum('profit')} / NULLIF({_sum('sales')}, 0) * 100", 2) + " AS profit_margin_pct"
_ORDERS = "COUNT(DISTINCT order_id) AS order_count"
_CUSTOMERS = "COUNT(DISTINCT customer_id) AS unique_customers"
_DISCOUNT = _round(f"{_sum('discount')} / COUNT(discount)", 4) + " AS avg_discount"
_QUANTITY = "CAST(SUM(quantity) AS BIGINT) AS total_quantity"


def _history(name: str, source: str, keys: tuple[str, ...]) -> str:
    """Each month of `source` with the values of the six months before it."""
    same = "".join(f" AND h.{k} = t.{k}" for k in keys)
    cols = "".join(f"t.{k}, " for k in keys)
    lags = ", ".join(f"MAX(CASE WHEN d = {n} THEN v END) AS lag_{n}" for n in (1, 2, 3))
    means = ", ".join(
        f"CAST(SUM(CASE WHEN d <= {n} THEN CAST(v AS DECIMAL(28,4)) END) AS DOUBLE) / {n} AS rolling_mean_{n}"
        for n in (3, 6)
    )
    keyed = "".join(f"{k}, " for k in keys)
    return f"""
{name}_pairs AS (
  SELECT {cols}t.month AS target_month, t.total_sales AS target_sales, h.total_sales AS v,
         {_number('t.month')} - {_number('h.month')} AS d
  FROM {source} t JOIN {source} h ON {_number('t.month')} - {_number('h.month')} BETWEEN 1 AND 6{same}),
{name} AS (
  SELECT {keyed}target_month, target_sales, {lags},
         CAST(month(target_month) AS INTEGER) AS month_of_year, {means}
  FROM {name}_pairs GROUP BY {keyed}target_month, target_sales HAVING COUNT(v) = 6)"""


def _next(name: str, source: str, keys: tuple[str, ...], last: str = "") -> str:
    """The month after the last one of all series of `source`, for those with all six months of history."""
    keyed = "".join(f"{k}, " for k in keys)
    last = last or f"(SELECT MAX(month) FROM {source})"
    lags = ", ".join(f"MAX(CASE WHEN d = {n} THEN total_sales END) AS lag_{n}" for n in (1, 2, 3))
    means = ", ".join(
        f"CAST(SUM(CASE WHEN d <= {n} THEN CAST(total_sales AS DECIMAL(28,4)) END) AS DOUBLE) / {n} AS rolling_mean_{n}"
        for n in (3, 6)
    )
    return f"""
{name} AS (
  SELECT {keyed}target_month, {lags}, CAST(month(target_month) AS INTEGER) AS month_of_year, {means}
  FROM (SELECT {keyed}total_sales, CAST({last} + INTERVAL 1 MONTH AS DATE) AS target_month,
               {_number(last)} + 1 - {_number('month')} AS d
        FROM {source})
  WHERE d BETWEEN 1 AND 6 GROUP BY {keyed}target_month HAVING COUNT(*) = 6)"""


_KEY_FIELDS = ", ".join(
    f"coalesce({text}, '\\N')"
    for text in (
        *(f"CAST({c} AS VARCHAR)" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
        *(f"CAST(CAST(ROUND({c} * 100) AS BIGINT) AS VARCHAR)" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        *("l_returnflag", "l_linestatus", "strftime(l_shipdate, '%Y-%m-%d')"),
    )
)
_LINE_KEY = f"md5(concat_ws('|', {_KEY_FIELDS}))"

_RELATIONS = f"""
WITH lines AS (
  SELECT {_LINE_KEY} AS row_id, l_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_shipdate AS DATE) AS ship_date, o_orderpriority AS ship_mode, c_custkey AS customer_id,
         c_name AS customer_name, c_mktsegment AS segment, n_name AS country, CAST(NULL AS VARCHAR) AS city,
         n_name AS state, CAST(NULL AS VARCHAR) AS postal_code, r_name AS region, p_partkey AS product_id,
         p_type AS category, p_type || ' / ' || p_brand AS sub_category, p_name AS product_name,
         l_extendedprice AS sales, CAST(l_quantity AS BIGINT) AS quantity, l_discount AS discount,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2))
              * (CAST(0.06 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS profit
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN part ON p_partkey = l_partkey
  WHERE o_orderdate IS NOT NULL AND l_extendedprice IS NOT NULL),
int_monthly AS (
  SELECT {_month('order_date')} AS month, {_sum('sales')} AS total_sales, {_sum('profit')} AS total_profit,
         {_ORDERS}, {_CUSTOMERS}
  FROM lines GROUP BY 1),
monthly AS (
  SELECT month, {_round('total_sales', 2)} AS total_sales, order_count, unique_customers,
         {_round('total_profit', 2)} AS total_profit,
         {_round('total_profit / NULLIF(total_sales, 0)', 4)} AS profit_margin
  FROM int_monthly),
category AS (
  SELECT category, sub_category, {_MONEY}, {_QUANTITY}, {_ORDERS}, {_MARGIN},
         {_round(_sum('sales') + " / NULLIF(SUM(quantity), 0)", 2)} AS avg_unit_price, {_DISCOUNT}
  FROM lines GROUP BY category, sub_category),
region_state AS (
  SELECT region, state, {_MONEY}, {_ORDERS}, {_CUSTOMERS}, {_MARGIN},
         {_round(_sum('sales') + " / NULLIF(COUNT(DISTINCT order_id), 0)", 2)} AS avg_order_value
  FROM lines GROUP BY region, state),
segment_month AS (
  SELECT {_month('order_date')} AS month, segment, {_MONEY}, {_ORDERS}, {_CUSTOMERS}, {_MARGIN}
  FROM lines GROUP BY 1, 2),
product_base AS (
  SELECT product_id, product_name, category, sub_category, {_MONEY}, {_QUANTITY}, {_ORDERS}, {_DISCOUNT}, {_MARGIN}
  FROM lines GROUP BY product_id, product_name, category, sub_category),
product_rank AS (
  SELECT b.*, RANK() OVER (PARTITION BY sub_category ORDER BY total_sales DESC) AS rank_in_subcategory
  FROM product_base b),
category_sum AS (
  SELECT category, CAST(SUM(CAST(total_sales AS DECIMAL(28,4))) AS DOUBLE) AS category_sales
  FROM product_base GROUP BY category),
product AS (
  SELECT r.*, {_round('total_sales / NULLIF(category_sales, 0) * 100', 2)} AS pct_of_category_sales
  FROM product_rank r JOIN category_sum USING (category)),
by_segment AS (
  SELECT segment, {_month('order_date')} AS month, {_sum('sales')} AS total_sales FROM lines GROUP BY 1, 2),
by_sub AS (
  SELECT sub_category, {_month('order_date')} AS month, {_sum('sales')} AS total_sales FROM lines GROUP BY 1, 2),
{_history('training', 'int_monthly', ())},
{_history('training_segment', 'by_segment', ('segment',))},
{_history('training_sub', 'by_sub', ('sub_category',))},
{_next('next_all', 'int_monthly', ())},
{_next('next_segment', 'by_segment', ('segment',))},
{_next('next_sub', 'by_sub', ('sub_category',))},
{_next('next_complete', 'int_monthly', (), "DATE '2001-07-01'")},
holdout AS (
  SELECT t.*, CASE WHEN (SELECT COUNT(*) FROM training n WHERE n.target_month > t.target_month) < 3
                   THEN 'test' ELSE 'train' END AS split
  FROM training t),
segment_test AS (
  SELECT * FROM training_segment
  QUALIFY row_number() OVER (PARTITION BY segment ORDER BY target_month DESC) <= 3),
segment_eval AS (
  SELECT t.segment, t.target_month, t.target_sales AS actual, t.rolling_mean_3, t.rolling_mean_6,
         COALESCE(y.total_sales, p.total_sales) AS baseline
  FROM segment_test t
  LEFT JOIN by_segment y ON y.segment = t.segment AND y.month = t.target_month - INTERVAL 12 MONTH
  LEFT JOIN by_segment p ON p.segment = t.segment AND p.month = t.target_month - INTERVAL 1 MONTH
),
segment_long AS (
  SELECT segment, 'Baseline' AS model, actual AS y, baseline AS p FROM segment_eval
  UNION ALL SELECT segment, 'rolling_mean_3', actual, rolling_mean_3 FROM segment_eval
  UNION ALL SELECT segment, 'rolling_mean_6', actual, rolling_mean_6 FROM segment_eval)"""


def _metrics(places: bool = True) -> str:
    mape = "AVG(ABS((y - p) / NULLIF(y, 0))) * 100"
    smape = "AVG(2 * ABS(p - y) / CASE WHEN ABS(y) + ABS(p) = 0 THEN 1e-8 ELSE ABS(y) + ABS(p) END) * 100"
    pairs = [(mape, "mape", 6), (smape, "smape", 6), ("AVG(ABS(y - p))", "mae", 2), ("SQRT(AVG((y - p) * (y - p)))", "rmse", 2)]
    return ", ".join(f"{_round(e, n) if places else e} AS {name}" for e, name, n in pairs)


def _folds(source: str, count: int, size: int, prefix: str) -> str:
    """Fold bounds over the distinct target months of `source`."""
    return f"""
{prefix}_age AS (
  SELECT target_month, COUNT(*) AS n, row_number() OVER (ORDER BY target_month DESC) AS age
  FROM {source} GROUP BY target_month),
{prefix}_test AS (
  SELECT f AS fold, SUM(n) AS test_rows, MIN(target_month) AS test_start, MAX(target_month) AS test_end
  FROM {prefix}_age, generate_series(1, {count}) g(f)
  WHERE age > ({count} - f) * {size} AND age <= ({count} - f + 1) * {size} GROUP BY f),
{prefix} AS (
  SELECT CAST(fold AS INTEGER) AS fold, CAST(SUM(n) AS BIGINT) AS training_rows, CAST(test_rows AS BIGINT) AS test_rows,
         MIN(target_month) AS train_start, MAX(target_month) AS train_end, test_start, test_end
  FROM {prefix}_test JOIN {prefix}_age ON target_month < test_start
  GROUP BY fold, test_rows, test_start, test_end)"""


_BACKTEST = f"""{_folds('training_segment', 5, 3, 'segment_fold')},
fold_long AS (
  SELECT fold, 'rolling_mean_3' AS feature_set, target_sales AS y, rolling_mean_3 AS p
  FROM training_segment JOIN segment_fold ON target_month BETWEEN test_start AND test_end
  UNION ALL
  SELECT fold, 'rolling_mean_6', target_sales, rolling_mean_6
  FROM training_segment JOIN segment_fold ON target_month BETWEEN test_start AND test_end),
fold_result AS (
  SELECT feature_set, fold, {_metrics(False)} FROM fold_long GROUP BY feature_set, fold)"""


def _checked(name: str) -> str:
    return {
        "stg_orders": "lines",
        "int_monthly_sales": "int_monthly",
        "mart_monthly_sales": "monthly",
        "mart_sales_by_category": "category",
        "mart_sales_by_segment": "segment_month",
        "mart_sales_by_region": "region_state",
        "mart_product_performance": "product",
        "mart_forecast_training": "training",
        "mart_next_month_features": "next_all",
    }[name]


def _check_row(relation: str, kind: str, column: str, source: str, failures: str) -> str:
    return (
        f"SELECT '{relation}' AS relation, '{kind}' AS \"check\", '{column}' AS \"column\", "
        f"(SELECT COUNT(*) FROM {source}) AS \"rows\", CAST(({failures}) AS BIGINT) AS failures"
    )


def _looked_up(training: str, monthly: str, keys: tuple[str, ...]) -> str:
    """Training rows beside the lags of the series, up to six rows back."""
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    cols = "".join(f"{k}, " for k in keys)
    on = " AND ".join(["w.month = t.target_month", *(f"w.{k} = t.{k}" for k in keys)])
    lags = ", ".join(f"LAG(total_sales, {n}) OVER s AS m{n}" for n in range(1, 7))
    return (
        f"(SELECT * FROM {training} t LEFT JOIN (SELECT {cols}month, total_sales AS m0, {lags} "
        f"FROM {monthly} WINDOW s AS ({part}ORDER BY month)) w ON {on})"
    )


def _last_values(features: str, monthly: str) -> str:
    """The feature row beside the last six months as a list, newest first."""
    return (
        f"(SELECT * FROM {features}, (SELECT MAX(month) AS last_month, "
        f"list(total_sales ORDER BY month DESC)[1:6] AS v FROM {monthly}))"
    )


def _apart(a: str, b: str) -> str:
    return f"ABS({a} - {b}) > 1e-6"


_TRAINING_FAULTS = {
    "history": "m0 + m1 + m2 + m3 + m4 + m5 + m6 IS NULL",
    "target_sales": _apart("target_sales", "m0"),
    **{f"lag_{n}": _apart(f"lag_{n}", f"m{n}") for n in (1, 2, 3)},
    "month_of_year": "month_of_year <> month(target_month)",
    "rolling_mean_3": _apart("rolling_mean_3", "(m1 + m2 + m3) / 3"),
    "rolling_mean_6": _apart("rolling_mean_6", "(m1 + m2 + m3 + m4 + m5 + m6) / 6"),
}
_NEXT_FAULTS = {
    "history": "len(v) <> 6",
    "target_month": "target_month <> last_month + INTERVAL 1 MONTH",
    **{f"lag_{n}": _apart(f"lag_{n}", f"v[{n}]") for n in (1, 2, 3)},
    "month_of_year": "month_of_year <> month(last_month) % 12 + 1",
    "rolling_mean_3": _apart("rolling_mean_3", "list_avg(v[1:3])"),
    "rolling_mean_6": _apart("rolling_mean_6", "list_avg(v)"),
}


def _count(source: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {source} WHERE {condition}"


def _values_report(relation: str, source: str, faults: dict[str, str]) -> str:
    rows = (_check_row(relation, "recomputed", c, source, _count(source, fault)) for c, fault in faults.items())
    return _RELATIONS + "\n" + "\nUNION ALL\n".join(rows)


_TRAINING_CHECK = ("mart_forecast_training", _looked_up("training", "int_monthly", ()), _TRAINING_FAULTS)
_PANEL_CHECK = ("mart_forecast_training", _looked_up("training_sub", "by_sub", ("sub_category",)), _TRAINING_FAULTS)
_NEXT_CHECK = ("mart_next_month_features", _last_values("next_all", "int_monthly"), _NEXT_FAULTS)


# The checks, written out apart from the code under test: relation, check, columns.
_FEATURES = ("lag_1", "lag_2", "lag_3", "month_of_year", "rolling_mean_3", "rolling_mean_6")
_CHECKS = (
    ("stg_orders", "unique", ("row_id",)),
    ("stg_orders", "not_null", ("row_id", "order_id", "order_date", "sales", "category", "region")),
    ("stg_orders", "accepted_values", ("category", "region", "segment")),
    ("int_monthly_sales", "unique", ("month",)),
    ("int_monthly_sales", "not_null", ("month", "total_sales", "total_profit", "order_count", "unique_customers")),
    ("mart_monthly_sales", "unique", ("month",)),
    ("mart_monthly_sales", "not_null", ("month", "total_sales")),
    ("mart_sales_by_category", "not_null", ("category", "profit_margin_pct")),
    ("mart_sales_by_category", "accepted_values", ("category",)),
    ("mart_sales_by_segment", "accepted_values", ("segment",)),
    ("mart_sales_by_region", "accepted_values", ("region",)),
    ("mart_product_performance", "not_null", ("product_id",)),
    ("mart_forecast_training", "unique", ("target_month",)),
    ("mart_forecast_training", "not_null", ("target_month", "target_sales", *_FEATURES)),
    ("mart_forecast_training", "accepted_values", ("month_of_year",)),
    ("mart_next_month_features", "unique", ("target_month",)),
    ("mart_next_month_features", "not_null", ("target_month", *_FEATURES)),
    ("mart_next_month_features", "accepted_values", ("month_of_year",)),
)
_ALLOWED = {
    "category": "'ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'",
    "region": "'AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'",
    "segment": "'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'",
    "month_of_year": "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12",
}


def _repeated(column: str, source: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"


def _dq_report() -> str:
    rows = []
    for relation, kind, columns in _CHECKS:
        source = _checked(relation)
        for column in columns:
            failures = {
                "unique": _repeated(column, source),
                "not_null": _count(source, f"{column} IS NULL"),
                "accepted_values": _count(source, f"{column} NOT IN ({_ALLOWED.get(column)})"),
            }[kind]
            rows.append(_check_row(relation, kind, column, source, failures))
    for relation, source, faults in (_TRAINING_CHECK, _NEXT_CHECK):
        failures = " + ".join(f"({_count(source, fault)})" for fault in faults.values())
        rows.append(_check_row(relation, "recomputed", "*", source, f"SELECT {failures}"))
    one = "SELECT CASE WHEN COUNT(*) = 1 THEN 0 ELSE 1 END FROM next_all"
    rows.append(_check_row("mart_next_month_features", "one_row", "*", "next_all", one))
    rows.append(_check_row("orders", "unique", "o_orderkey", "orders", _repeated("o_orderkey", "orders")))
    return _RELATIONS + "\n" + "\nUNION ALL\n".join(rows)


_INSIDE = " AND month > (SELECT MIN(month) FROM int_monthly) AND month < (SELECT MAX(month) FROM int_monthly)"


def _training_report() -> str:
    return f"""{_RELATIONS},{_folds('training', 1, 3, 'split')},
naive AS (
  SELECT t.target_sales AS y, COALESCE(a.total_sales, b.total_sales) AS p
  FROM training t JOIN split ON t.target_month >= test_start
  LEFT JOIN int_monthly a ON a.month = t.target_month - INTERVAL 12 MONTH
  LEFT JOIN int_monthly b ON b.month = t.target_month - INTERVAL 1 MONTH)
SELECT 'seasonal_naive' AS model, 'mart_forecast_training' AS source,
       training_rows + test_rows AS training_rows_total, training_rows AS evaluation_training_rows,
       test_rows AS holdout_rows, 3 AS horizon, train_start AS training_start, test_end AS training_end,
       test_start AS holdout_start, test_end AS holdout_end, mape, smape, mae, rmse
FROM split, (SELECT {_metrics()} FROM naive)"""


def _tree(name: str, source: str, depth: int, smallest: int) -> str:
    """A regression tree over the `fit` rows of `source`, level by level; `name` gives the value of each row's leaf.

    A cut lies halfway between neighbouring values of a feature. The best one parts the sums most; of equal ones the
    first feature's lowest cut is taken. Equal gains may differ in their last digits.
    """
    values = ", ".join(f"CAST({f} AS DOUBLE)" for f in _FEATURES)
    parts = [f"""
{name}_long AS (
  SELECT target_month, fit, unnest(range(1, {len(_FEATURES) + 1})) AS f, unnest([{values}]) AS v FROM {source}),
{name}_cuts AS (
  SELECT f, (v + above) / 2 AS cut
  FROM (SELECT f, v, LEAD(v) OVER (PARTITION BY f ORDER BY v) AS above FROM (SELECT DISTINCT f, v FROM {name}_long WHERE fit))
  WHERE above IS NOT NULL),
{name}_0 AS (SELECT target_month, fit, y, 1 AS node FROM {source})"""]
    for level in range(depth):
        parts.append(f"""
{name}_sums_{level} AS (
  SELECT node, f, cut, SUM(y) AS s, COUNT(*) AS c, SUM(y) FILTER (v <= cut) AS low, COUNT(*) FILTER (v <= cut) AS n
  FROM (SELECT * FROM {name}_{level} WHERE fit) JOIN {name}_long USING (target_month, fit) JOIN {name}_cuts USING (f)
  GROUP BY node, f, cut),
{name}_best_{level} AS (
  SELECT node, f, cut FROM {name}_sums_{level} WHERE n >= {smallest} AND c - n >= {smallest} AND low * c <> s * n
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY ROUND(LN((low * c - s * n) ** 2 / (n * (c - n))), 9) DESC, f, cut) = 1),
{name}_{level + 1} AS (
  SELECT r.target_month, r.fit, r.y, CASE WHEN cut IS NULL THEN node WHEN v <= cut THEN 2 * node ELSE 2 * node + 1 END AS node
  FROM {name}_{level} r LEFT JOIN {name}_best_{level} b USING (node)
  LEFT JOIN {name}_long l ON l.target_month = r.target_month AND l.f = b.f)""")
    parts.append(f"""
{name} AS (
  SELECT target_month, value FROM {name}_{depth} JOIN
  (SELECT node, AVG(y) AS value FROM {name}_{depth} WHERE fit GROUP BY node) USING (node))""")
    return ",".join(parts)


_MONTHS = f"""
months AS (
  SELECT target_month, TRUE AS fit, target_sales AS y, {", ".join(_FEATURES)} FROM training
  UNION ALL SELECT target_month, FALSE, NULL, {", ".join(_FEATURES)} FROM next_all)"""


def _boosted(rounds: int, depth: int, rate: float) -> str:
    """The first tree fits the target, each further one twice what is left, and counts by the rate."""
    parts = [_tree("tree_1", "months", depth, 1), "\nsum_1 AS (SELECT target_month, value AS p FROM tree_1)"]
    for n in range(2, rounds + 1):
        parts.append(f"\nleft_{n} AS (SELECT m.* REPLACE (2 * (y - p) AS y) FROM months m JOIN sum_{n - 1} USING (target_month))")
        parts.append(_tree(f"tree_{n}", f"left_{n}", depth, 1))
        parts.append(
            f"\nsum_{n} AS (SELECT target_month, p + {rate} * value AS p FROM sum_{n - 1} JOIN tree_{n} USING (target_month))"
        )
    return f"{_RELATIONS},{_MONTHS},{','.join(parts)}\nSELECT target_month, {_round('p', 4)} AS prediction FROM sum_{rounds}"


def _penalised_tree(name: str, source: str, depth: int, l2: int) -> str:
    """As `_tree`, but a cut is the largest value on its left, and `l2` is added to each number of rows."""
    values = ", ".join(f"CAST({f} AS DOUBLE)" for f in _FEATURES)
    parts = [f"""
{name}_long AS (
  SELECT target_month, fit, unnest(range(1, {len(_FEATURES) + 1})) AS f, unnest([{values}]) AS v FROM {source}),
{name}_0 AS (SELECT target_month, fit, y, 1 AS node FROM {source})"""]
    for level in range(depth):
        parts.append(f"""
{name}_sums_{level} AS (
  SELECT node, f, cut, SUM(y) AS s, COUNT(*) AS c, SUM(y) FILTER (v <= cut) AS low, COUNT(*) FILTER (v <= cut) AS n
  FROM (SELECT * FROM {name}_{level} WHERE fit) JOIN {name}_long USING (target_month, fit)
  JOIN (SELECT DISTINCT f, v AS cut FROM {name}_long WHERE fit) USING (f)
  GROUP BY node, f, cut),
{name}_best_{level} AS (
  SELECT node, f, cut
  FROM (SELECT *, low ** 2 / (n + {l2}) + (s - low) ** 2 / (c - n + {l2}) - s ** 2 / (c + {l2}) AS gain
        FROM {name}_sums_{level} WHERE n > 0 AND n < c)
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY ROUND(LN(gain), 9) DESC, f, cut) = 1),
{name}_{level + 1} AS (
  SELECT r.target_month, r.fit, r.y, CASE WHEN cut IS NULL THEN node WHEN v <= cut THEN 2 * node ELSE 2 * node + 1 END AS node
  FROM {name}_{level} r LEFT JOIN {name}_best_{level} b USING (node)
  LEFT JOIN {name}_long l ON l.target_month = r.target_month AND l.f = b.f)""")
    parts.append(f"""
{name} AS (
  SELECT target_month, value FROM {name}_{depth} JOIN
  (SELECT node, SUM(y) / (COUNT(*) + {l2}) AS value FROM {name}_{depth} WHERE fit GROUP BY node) USING (node))""")
    return ",".join(parts)


def _penalised(rounds: int, depth: int, rate: float, l2: int) -> str:
    """From the mean on, each tree fits what is left, and counts by the rate."""
    parts = ["\nsum_0 AS (SELECT target_month, (SELECT AVG(y) FROM months) AS p FROM months)"]
    for n in range(1, rounds + 1):
        parts.append(f"\nleft_{n} AS (SELECT m.* REPLACE (y - p AS y) FROM months m JOIN sum_{n - 1} USING (target_month))")
        parts.append(_penalised_tree(f"tree_{n}", f"left_{n}", depth, l2))
        parts.append(
            f"\nsum_{n} AS (SELECT target_month, p + {rate} * value AS p FROM sum_{n - 1} JOIN tree_{n} USING (target_month))"
        )
    return (
        f"{_RELATIONS},{_MONTHS},{','.join(parts)}\n"
        f"SELECT target_month, {_round('p', 2)} AS prediction, TRUE AS same FROM sum_{rounds}"
    )


_TRAINED = f"""{_RELATIONS},{_folds('training', 1, 3, 'split')},
months AS (
  SELECT target_month, target_month < test_start AS fit, target_sales AS y, {", ".join(_FEATURES)} FROM training, split),
{_tree('tree', 'months', 2, 2)},
tested AS (
  SELECT m.target_month, m.y, value AS forecast, COALESCE(a.total_sales, b.total_sales) AS baseline
  FROM months m JOIN tree USING (target_month)
  LEFT JOIN int_monthly a ON a.month = m.target_month - INTERVAL 12 MONTH
  LEFT JOIN int_monthly b ON b.month = m.target_month - INTERVAL 1 MONTH
  WHERE NOT fit)"""


def _trained_report() -> str:
    names = ("mape", "smape", "mae", "rmse")
    measures = ", ".join(f"{_round(f'{of}.{n}', 4)} AS {of}_{n}" for of in ("model", "baseline") for n in names)
    sources = ", ".join(
        f"(SELECT {_metrics(places=False)} FROM (SELECT y, {column} AS p FROM tested)) {of}"
        for of, column in (("model", "forecast"), ("baseline", "baseline"))
    )
    return f"""{_TRAINED}
SELECT 'rf' AS model, 'mart_forecast_training' AS source,
       training_rows + test_rows AS training_rows_total, training_rows AS evaluation_training_rows,
       test_rows AS holdout_rows, 3 AS horizon, train_start AS training_start, test_end AS training_end,
       test_start AS holdout_start, test_end AS holdout_end, '{",".join(_FEATURES)}' AS feature_columns, {measures}
FROM split, {sources}"""


_LAST_COMPLETE = "DATE '2001-07-01'"


def statements() -> dict[str, str]:
    def plain(select: str) -> str:
        return f"{_RELATIONS}\n{select}"

    backtest = f"{_RELATIONS},{_BACKTEST}\n"
    return {
        "sums_of_large_amounts": """
            SELECT l_partkey % 10 AS digit,
              CAST(SUM(CAST(CAST(l_extendedprice * CAST(1000003.0 AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) AS large,
              CAST(SUM(CAST(CAST(l_extendedprice / CAST(7 AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) AS long
            FROM lineitem GROUP BY 1""",
        "stg_orders": plain("SELECT * FROM lines"),
        "int_monthly_sales": plain("SELECT * FROM int_monthly"),
        "mart_monthly_sales": plain("SELECT * FROM monthly"),
        "mart_sales_by_category": plain("SELECT * FROM category"),
        "mart_sales_by_region": plain("SELECT * FROM region_state"),
        "mart_sales_by_segment": plain("SELECT * FROM segment_month"),
        "mart_product_performance": plain("SELECT * FROM product"),
        "mart_forecast_training": plain("SELECT * FROM training"),
        "mart_next_month_features": plain("SELECT * FROM next_all"),
        "panel_training_by_segment": plain("SELECT * FROM training_segment"),
        "panel_training_by_subcategory": plain("SELECT * FROM training_sub"),
        "panel_next_month_by_segment": plain("SELECT * FROM next_segment"),
        "panel_next_month_by_subcategory": plain("SELECT * FROM next_sub"),
        "next_month_features_as_of": plain("SELECT * FROM next_complete"),
        "stale_series": plain(
            "SELECT sub_category, MAX(month) AS last_month, "
            f"CAST({_number(_LAST_COMPLETE)} - {_number('MAX(month)')} AS BIGINT) AS months_behind "
            f"FROM by_sub WHERE month <= {_LAST_COMPLETE} GROUP BY sub_category HAVING MAX(month) < {_LAST_COMPLETE}"
        ),
        "holdout_split_by_subcategory": plain(
            "SELECT t.*, CASE WHEN n <= 3 THEN 'short' WHEN age <= 3 THEN 'test' ELSE 'train' END AS split "
            "FROM training_sub t JOIN (SELECT sub_category, target_month, COUNT(*) OVER (PARTITION BY sub_category) AS n, "
            "row_number() OVER (PARTITION BY sub_category ORDER BY target_month DESC) AS age FROM training_sub) a "
            "USING (sub_category, target_month)"
        ),
        "top10_products_per_subcategory": plain(
            "SELECT category, sub_category, rank_in_subcategory, product_id, product_name, total_sales, total_profit, "
            "profit_margin_pct FROM product_rank WHERE rank_in_subcategory <= 10"
        ),
        "product_totals": plain("SELECT * FROM product_base"),
        "top10_products_of_category": plain(
            "SELECT sub_category, rank_in_subcategory, product_id, total_sales FROM product_rank "
            "WHERE category = 'PROMO' AND rank_in_subcategory <= 10"
        ),
        "executive_kpis": plain(
            f"SELECT {_MONEY}, COUNT(DISTINCT order_id) AS total_orders, {_MARGIN} FROM lines"
        ),
        "eda_kpis": plain(
            f"SELECT {_round(_sum('sales'), 2)} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders, "
            f"{_round(_sum('sales') + ' / COUNT(DISTINCT order_id)', 2)} AS avg_order_value FROM lines"
        ),
        "category_revenue": plain(
            f"SELECT category, {_round(_sum('sales'), 2)} AS total_sales FROM lines GROUP BY category"
        ),
        "region_revenue": plain(
            f"SELECT region, {_round(_sum('sales'), 2)} AS total_sales FROM lines GROUP BY region"
        ),
        "eda_monthly_revenue": plain(f"SELECT month, {_round('total_sales', 2)} AS revenue FROM int_monthly"),
        "price_by_quantity": plain(
            "SELECT quantity, COUNT(*) AS lines, "
            f"{_round(_sum('sales') + ' / NULLIF(SUM(quantity), 0)', 2)} AS avg_unit_price FROM lines GROUP BY quantity"
        ),
        "latest_months": plain("SELECT * FROM monthly ORDER BY month DESC LIMIT 12"),
        "monthly_gaps_by_subcategory": plain(
            "SELECT s.sub_category, CAST(g.m AS DATE) AS missing_month FROM "
            "(SELECT sub_category, MIN(month) AS a, MAX(month) AS b FROM by_sub GROUP BY 1) s, "
            "LATERAL (SELECT unnest(generate_series(s.a, s.b, INTERVAL 1 MONTH)) AS m) g "
            "WHERE NOT EXISTS (SELECT 1 FROM by_sub x WHERE x.sub_category = s.sub_category AND x.month = g.m)"
        ),
        "dq_report": _dq_report(),
        "dq_training_values": _values_report(*_TRAINING_CHECK),
        "dq_panel_training_values": _values_report(*_PANEL_CHECK),
        "dq_next_month_values": _values_report(*_NEXT_CHECK),
        **{
            name: f"""{_RELATIONS}, tested AS (
  SELECT t.target_month, t.target_sales AS "Actual", COALESCE(a.total_sales, b.total_sales) AS "Baseline"
  FROM holdout t
  LEFT JOIN int_monthly a ON a.month = t.target_month - INTERVAL 12 MONTH
  LEFT JOIN int_monthly b ON b.month = t.target_month - INTERVAL 1 MONTH
  WHERE split = 'test')
SELECT *, TRUE AS {flag} FROM tested"""
            for name, flag in (("rf_holdout_rows", "in_range"), ("gbt_holdout_rows", "forecast_present"))
        },
        "feature_set_folds": f"{_RELATIONS},{_folds('training', 5, 3, 'fold')}\n"
        "SELECT m.model, s.feature_set, s.feature_count, fold.*, TRUE AS metrics_present, TRUE AS wins_add_up "
        "FROM fold, (VALUES ('rf'), ('hist')) m(model), (VALUES ('five_features', 5), ('six_features', 6)) s(feature_set, feature_count)",
        "penalised_boosting": _penalised(rounds=4, depth=2, rate=0.05, l2=1),
        "trained_tree_report": _trained_report(),
        "trained_tree_predictions": f"{_TRAINED},{_MONTHS.replace('months AS', 'all_months AS')},{_tree('final', 'all_months', 2, 2)}\n"
        f"SELECT f.target_month, {_round('f.value', 4)} AS prediction, t.y AS \"Actual\", "
        f'{_round("t.forecast", 4)} AS "Forecast", t.baseline AS "Baseline" FROM final f LEFT JOIN tested t USING (target_month)',
        "boosted_predictions": _boosted(rounds=4, depth=2, rate=0.05),
        "forest_nodes_agree": plain(
            "SELECT target_month, TRUE AS same, CAST(600 AS BIGINT) AS trees, TRUE AS whole FROM training"
        ),
        "next_month_forecast": plain(
            "SELECT 'rf' AS model, *, 'mart_next_month_features' AS feature_source, TRUE AS logged, TRUE AS in_range FROM next_all"
        ),
        "latest_forecasts": plain("SELECT CAST(1 AS BIGINT) AS id, 'rf' AS model, 0 AS series_columns, * FROM next_all"),
        "read_region_mart": plain("SELECT * FROM region_state ORDER BY region, state LIMIT 10"),
        "read_training_mart": plain("SELECT * FROM training"),
        "read_next_month_mart": plain("SELECT * FROM next_all"),
        "read_monthly_mart": plain("SELECT month, total_sales FROM int_monthly"),
        "adhoc_sql": plain(
            "SELECT month, total_sales FROM by_segment WHERE segment = 'BUILDING' AND month >= DATE '2000-01-01'"
        ),
        "csv_order_lines": plain(
            "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, "
            "CAST(product_id AS VARCHAR) AS product_id) FROM lines"
        ),
        "csv_coerced_lines": plain(
            "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, "
            "CAST(product_id AS VARCHAR) AS product_id, CASE WHEN product_id % 40 <> 3 THEN quantity END AS quantity) "
            "FROM lines WHERE product_id % 50 <> 7 AND customer_id % 60 <> 5"
        ),
        "csv_rejected_lines": plain(
            "SELECT row_id, concat_ws(',', CASE WHEN product_id % 50 = 7 THEN 'Order Date' END, "
            "CASE WHEN customer_id % 60 = 5 THEN 'Sales' END, CASE WHEN product_id % 40 = 3 THEN 'Quantity' END) AS faults, "
            "CAST(NULL AS VARCHAR) AS record FROM lines "
            "WHERE product_id % 50 = 7 OR customer_id % 60 = 5 OR product_id % 40 = 3"
        ),
        "csv_daily_revenue": plain(
            f"SELECT CASE WHEN day(order_date) <> 13 THEN {_month('order_date')} END AS month, "
            f"{_round(_sum('CASE WHEN day(order_date) <> 17 THEN sales END'), 2)} AS revenue FROM lines GROUP BY 1"
        ),
        "csv_evaluation": plain(
            'SELECT segment, target_month, actual AS "Actual", baseline AS "Baseline" FROM segment_eval'
        ),
        "json_training_report": _training_report(),
        "contract_faults": plain(
            "SELECT 'empty' AS copy, 'empty' AS fault, '*' AS \"column\", CAST(1 AS BIGINT) AS failures\n"
            + "\n".join(
                f"UNION ALL SELECT '{copy}', '{fault}', '{column}', COUNT(*) FROM training "
                f"WHERE month_of_year = {month} HAVING COUNT(*) > 0"
                for copy, fault, column, month in (
                    ("same month as other text", "repeated month", "target_month", 1),
                    ("no date", "target_month", "target_month", 2),
                    ("time of day", "target_month", "target_month", 3),
                    ("month 13", "month_of_year", "month_of_year", 5),
                    ("month and a half", "month_of_year", "month_of_year", 6),
                    ("lag missing", "missing feature", "lag_2", 7),
                    ("lag as text", "text feature", "lag_3", 8),
                    ("sales missing", "target_sales", "target_sales", 9),
                )
            )
        ),
        "prediction_contract_faults": plain(
            "SELECT * FROM (SELECT 'no row' AS copy, 'not one row' AS fault, '*' AS \"column\", CAST(1 AS BIGINT) AS failures"
            " UNION ALL SELECT 'all series as one', 'not one row', '*', 1 FROM next_segment HAVING COUNT(*) <> 1"
            + "".join(
                f" UNION ALL SELECT '{copy}', '{fault}', '{column}', COUNT(*) FROM next_segment WHERE {which}"
                for copy, fault, column, which in (
                    ("rising series twice", "not one row", "*", "lag_2 > lag_3"),
                    ("rising series without lag", "missing feature", "lag_3", "lag_2 > lag_3"),
                    ("falling series with text", "text feature", "lag_2", "lag_2 <= lag_3"),
                    ("month 0", "month_of_year", "month_of_year", "TRUE"),
                )
            )
            + ") WHERE failures > 0"
        ),
        # A month that is no date, or absent, also leaves a gap where it lies inside the series.
        "series_faults": plain(
            "SELECT * FROM ("
            + "\nUNION ALL\n".join(
                f"SELECT '{copy}' AS copy, '{fault}' AS fault, (SELECT COUNT(*) FROM int_monthly "
                f"WHERE month(month) = {month}{inside}) AS failures"
                for copy, fault, month, inside in (
                    ("month as text", "invalid", 2, ""),
                    ("month as text", "gap", 2, _INSIDE),
                    ("no amount", "invalid", 3, ""),
                    ("repeated", "repeated", 1, ""),
                    ("gap", "gap", 6, _INSIDE),
                )
            )
            + ") WHERE failures > 0"
        ),
        "holdout_split": plain("SELECT * FROM holdout"),
        "seasonal_naive_by_segment": plain(
            'SELECT segment, target_month, actual AS "Actual", baseline AS "Baseline" FROM segment_eval'
        ),
        "forecast_metrics_naive": plain(f"SELECT segment, model, {_metrics()} FROM segment_long GROUP BY 1, 2"),
        "training_report": _training_report(),
        "expanding_folds": f"{_RELATIONS},{_folds('training', 5, 3, 'fold')}\nSELECT * FROM fold",
        "backtest_folds": backtest
        + "SELECT 'rolling_mean' AS model, feature_set, 1 AS feature_count, r.fold, training_rows, test_rows, train_start, "
        "train_end, test_start, test_end, "
        + ", ".join(f"{_round(c, n)} AS {c}" for c, n in (("rmse", 2), ("mae", 2), ("mape", 6), ("smape", 6)))
        + " FROM fold_result r JOIN segment_fold USING (fold)",
        "backtest_summary": backtest
        + "SELECT 'rolling_mean' AS model, feature_set, 1 AS feature_count, "
        + ", ".join(
            f"{_round(f'{fn}({c})', n)} AS {c}_{to}"
            for fn, c, to, n in (
                ("AVG", "rmse", "mean", 2),
                ("STDDEV_SAMP", "rmse", "std", 2),
                ("AVG", "mae", "mean", 2),
                ("AVG", "mape", "mean", 6),
                ("AVG", "smape", "mean", 6),
                ("STDDEV_SAMP", "smape", "std", 6),
            )
        )
        + " FROM fold_result GROUP BY feature_set",
        "backtest_fold_wins": backtest
        + "\nUNION ALL\n".join(
            f"SELECT 'rolling_mean' AS model, '{c}' AS metric, COUNT(*) FILTER (six.{c} < five.{c}) AS six_feature_wins, "
            f"COUNT(*) FILTER (five.{c} < six.{c}) AS five_feature_wins, COUNT(*) FILTER (five.{c} = six.{c}) AS ties, "
            "COUNT(*) AS folds FROM fold_result five JOIN fold_result six USING (fold) "
            "WHERE five.feature_set = 'rolling_mean_3' AND six.feature_set = 'rolling_mean_6'"
            for c in ("rmse", "smape")
        ),
    }
