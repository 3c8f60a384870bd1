"""The same results as plain SQL over the sample tables (DuckDB dialect)."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def _rounded(sql: str, *cols: str, digits: int = 6) -> str:
    new = ", ".join(f"round({c} + 1e-10, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({new}) FROM ({sql}) AS _r"


# --- shared inputs --------------------------------------------------------------------------------------------------

_HOURLY = """hourly AS (
  SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY ALL)"""
_DENSE = f"""{_HOURLY},
calendar AS (
  SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hourly GROUP BY event_type),
dense AS (
  SELECT c.event_type, c.ts, h.value FROM calendar c LEFT JOIN hourly h ON c.event_type = h.event_type AND c.ts = h.ts)"""
_FILLED = f"""{_DENSE},
filled AS (
  SELECT event_type, ts, last_value(value IGNORE NULLS) OVER (
    PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM dense)"""
_MONTHLY = """monthly AS (
  SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month, sum(l_quantity) AS quantity
  FROM lineitem GROUP BY ALL)"""
_STEPS = f"""{_MONTHLY},
steps AS (
  SELECT *, datediff('month', lag(month) OVER (PARTITION BY l_suppkey ORDER BY month), month) AS step FROM monthly)"""
_OBSERVED = """observed AS (
  SELECT *, CASE WHEN q >= 40 THEN q END AS target,
    ((year(period) - 1970) * 12 + month(period) - 1) * 1000000000000 + supplier * 2 + is_returned AS row_id
  FROM (SELECT l_suppkey AS supplier, CAST(l_returnflag = 'R' AS INTEGER) AS is_returned,
          CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS period, sum(l_quantity) AS q
        FROM lineitem GROUP BY ALL) AS t),
contiguous AS (
  SELECT * FROM observed WHERE (supplier, is_returned) IN (
    SELECT (supplier, is_returned) FROM (
      SELECT supplier, is_returned,
        datediff('month', lag(period) OVER (PARTITION BY supplier, is_returned ORDER BY period), period) AS step FROM observed) AS s
    GROUP BY supplier, is_returned HAVING max(step) = 1))"""


def _prepared(over: str) -> str:
    return f"""{_OBSERVED},
prepared AS (
  SELECT last_value(target IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS target,
    supplier, is_returned, period, row_id, CASE is_returned WHEN 1 THEN 'consumption' ELSE 'production' END AS measure,
    CASE WHEN period <= TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM contiguous)"""


def _rolling(value: str, part: str, order: str, lag: int, size: int) -> str:
    frame = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {lag + size - 1} PRECEDING AND {lag} PRECEDING)"
    return (
        f"CASE WHEN count({value}) {frame} = {size} THEN avg({value}) {frame} END "
        f"AS rolling_mean_lag{lag}_window_size{size}"
    )


def _features(table: str, part: str, order: str, value: str, lags, transform_lag, windows, expanding=True) -> str:
    cols = [f"lag({value}, {k}) OVER (PARTITION BY {part} ORDER BY {order}) AS lag{k}" for k in lags]
    if expanding:
        cols.append(
            f"avg({value}) OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND "
            f"{transform_lag} PRECEDING) AS expanding_mean_lag{transform_lag}"
        )
    cols += [_rolling(value, part, order, transform_lag, w) for w in windows]
    return f"SELECT *, {', '.join(cols)} FROM {table}"


def _known(sql: str, *cols: str) -> str:
    return f"SELECT * FROM ({sql}) AS _k WHERE {' AND '.join(f'{c} IS NOT NULL' for c in cols)}"


# --- series ---------------------------------------------------------------------------------------------------------

_HOURLY_MADE = [
    "lag24", "lag48", "expanding_mean_lag24", "rolling_mean_lag24_window_size6", "rolling_mean_lag24_window_size12",
]
_made = _known(_features("filled", "event_type", "ts", "value", (24, 48), 24, (6, 12)), *_HOURLY_MADE)
ORACLES["flagship_features"] = f"WITH {_FILLED} " + _rounded(
    f"SELECT *, CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek, "
    f"CAST(hour(ts) AS INTEGER) AS hour FROM ({_made}) AS m",
    "value", *_HOURLY_MADE,
)
ORACLES["flagship_features_chunked"] = ORACLES["flagship_features"]
ORACLES["densify"] = f"WITH {_DENSE} " + _rounded("SELECT * FROM dense", "value")
ORACLES["missing_times"] = f"""WITH {_DENSE}
SELECT event_type, ts FROM calendar c WHERE NOT EXISTS (
  SELECT 1 FROM hourly h WHERE h.event_type = c.event_type AND h.ts = c.ts)"""
ORACLES["duplicate_times"] = (
    "SELECT o_custkey, o_orderdate, count(*) AS n_rows FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1"
)
ORACLES["time_steps"] = f"""WITH {_MONTHLY}
SELECT l_suppkey, month, quantity, lag(month) OVER w AS prev_time, datediff('day', lag(month) OVER w, month) AS step
FROM monthly WINDOW w AS (PARTITION BY l_suppkey ORDER BY month)"""
ORACLES["discontinuous_series"] = f"""WITH {_STEPS}
SELECT l_suppkey, CAST(max(step) AS DOUBLE) AS max_steps FROM steps GROUP BY l_suppkey
HAVING max(step) IS DISTINCT FROM 1"""
ORACLES["discontinuous_series_frame"] = f"""WITH {_MONTHLY}, steps AS (
  SELECT l_suppkey, datediff('month', lag(month) OVER (ORDER BY l_suppkey, month), month) AS step FROM monthly)
SELECT l_suppkey, CAST(max(step) AS DOUBLE) AS max_steps FROM steps GROUP BY l_suppkey
HAVING max(step) IS DISTINCT FROM 1"""
ORACLES["drop_discontinuous"] = f"""WITH {_STEPS}
SELECT * FROM monthly WHERE l_suppkey IN (SELECT l_suppkey FROM steps GROUP BY l_suppkey HAVING max(step) = 1)"""
ORACLES["forward_fill_series"] = f"WITH {_FILLED} " + _rounded("SELECT * FROM filled", "value")
_PURCHASES = "(SELECT event_id, user_id, event_type, ts, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events) AS p"
ORACLES["forward_fill_frame"] = f"""SELECT event_id, ts, last_value(value IGNORE NULLS) OVER (
  ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {_PURCHASES}"""
ORACLES["forward_fill_by_user"] = f"""SELECT event_id, user_id, event_type, ts, last_value(value IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {_PURCHASES}"""
ORACLES["add_lags"] = f"WITH {_MONTHLY} SELECT *, " + ", ".join(
    f"lag(quantity, {k}) OVER (PARTITION BY l_suppkey ORDER BY month) AS quantity_lag_{k}" for k in (1, 2, 3, 12)
) + " FROM monthly"
ORACLES["add_lags_chunked"] = ORACLES["add_lags"]
ORACLES["add_expanding_mean"] = f"WITH {_MONTHLY} " + _rounded(
    """SELECT *, avg(quantity) OVER (PARTITION BY l_suppkey ORDER BY month
    ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS expanding_mean_lag2 FROM monthly""",
    "expanding_mean_lag2",
)
ORACLES["add_rolling_mean"] = f"WITH {_MONTHLY} " + _rounded(
    f"SELECT *, {_rolling('quantity', 'l_suppkey', 'month', 2, 6)} FROM monthly", "rolling_mean_lag2_window_size6"
)
_LAGS = ["lag1", "lag2", "lag12"]
_ROLLED = ["rolling_mean_lag1_window_size3", "rolling_mean_lag1_window_size6"]
_MONTHLY_MADE = [*_LAGS, "expanding_mean_lag1", *_ROLLED]
_MONTHLY_FEATURES = _known(
    _features("monthly", "l_suppkey", "month", "quantity", (1, 2, 12), 1, (3, 6)), *_MONTHLY_MADE
)
ORACLES["make_features"] = f"WITH {_MONTHLY} " + _rounded(_MONTHLY_FEATURES, *_MONTHLY_MADE)
ORACLES["make_features_chunked"] = ORACLES["make_features"]


def _transform(value: str, part: str, order: str, kind: str, lag: int, window: int | None = None, alpha: float | None = None) -> tuple[str, str]:
    """(name, SQL) of a lag transform."""
    start = f"{lag + window - 1} PRECEDING" if window else "UNBOUNDED PRECEDING"
    frame = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {start} AND {lag} PRECEDING)"
    name = f"{kind}_lag{lag}" + (f"_window_size{window}" if window else f"_alpha{alpha}".replace(".", "_") if alpha else "")
    if alpha:
        return name, f"list_reduce(list({value}) {frame}, lambda y, x: (1 - {alpha}) * y + {alpha} * x)"
    made = f"{ {'mean': 'avg', 'std': 'stddev_samp', 'min': 'min', 'max': 'max'}[kind.rsplit('_')[1]] }({value}) {frame}"
    return name, f"CASE WHEN count({value}) {frame} = {window} THEN {made} END" if window else made


_MONTH = ("quantity", "l_suppkey", "month")
_TRANSFORMS = [
    _transform(*_MONTH, "exponentially_weighted_mean", 1, alpha=0.3), _transform(*_MONTH, "rolling_std", 1, 6),
    _transform(*_MONTH, "rolling_min", 2, 3), _transform(*_MONTH, "rolling_max", 1, 12), _transform(*_MONTH, "expanding_std", 1),
    _transform(*_MONTH, "expanding_min", 2), _transform(*_MONTH, "expanding_max", 1),
]
ORACLES["lag_transforms"] = f"WITH {_MONTHLY} " + _rounded(
    f"SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in _TRANSFORMS)} FROM monthly", *[name for name, _ in _TRANSFORMS]
)
ORACLES["lag_transforms_chunked"] = ORACLES["lag_transforms"]
_WEIGHTED = [name for name, _ in _TRANSFORMS[:2]]
ORACLES["make_features_weighted"] = f"WITH {_MONTHLY} " + _rounded(
    _known(
        f"SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in _TRANSFORMS[:2])} FROM "
        f"({_features('monthly', 'l_suppkey', 'month', 'quantity', (1, 2, 12), 1, (3, 6))}) AS m",
        *_MONTHLY_MADE, *_WEIGHTED,
    ),
    *_MONTHLY_MADE, *_WEIGHTED,
)
_HOUR = ("value", "event_type", "ts")
_WEEK = [_transform(*_HOUR, "rolling_mean", 24, 168), _transform(*_HOUR, "rolling_std", 24, 168), _transform(*_HOUR, "rolling_max", 1, 168)]
ORACLES["rolling_week"] = f"WITH {_FILLED} " + _rounded(
    f"SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in _WEEK)} FROM filled", "value", *[name for name, _ in _WEEK]
)
ORACLES["rolling_week_chunked"] = ORACLES["rolling_week"]
ORACLES["features_with_history"] = f"WITH {_MONTHLY} " + _rounded(
    "SELECT * FROM ("
    + _known(_features("monthly", "l_suppkey", "month", "quantity", (1, 2, 12), 1, (3, 6), False), *_LAGS, *_ROLLED)
    + ") AS f WHERE month > TIMESTAMP '2000-01-01'",
    *_ROLLED,
)
ORACLES["series_tail"] = f"""WITH {_MONTHLY}
SELECT l_suppkey, month, quantity FROM monthly
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY month DESC) <= 5"""
_BY_SERIES = "PARTITION BY supplier, is_returned ORDER BY period"
ORACLES["preprocess_stage"] = f"WITH {_prepared(_BY_SERIES)} SELECT * FROM prepared"
ORACLES["preprocess_stage_frame_fill"] = (
    f"WITH {_prepared('PARTITION BY is_returned ORDER BY row_id')} SELECT * FROM prepared"
)
_BY_FRAME = """contiguous AS (
  SELECT * FROM observed WHERE supplier NOT IN (
    SELECT supplier FROM (
      SELECT supplier, is_returned,
        datediff('month', lag(period) OVER (ORDER BY supplier, is_returned, period), period) AS step FROM observed) AS s
    GROUP BY supplier, is_returned HAVING max(step) IS DISTINCT FROM 1))"""
ORACLES["preprocess_stage_frame_steps"] = "WITH {} SELECT * FROM prepared".format(
    _prepared(_BY_SERIES).replace(_OBSERVED[_OBSERVED.index("contiguous AS") :], _BY_FRAME)
)
ORACLES["preprocess_stage_frame_steps_groups"] = ORACLES["preprocess_stage_frame_steps"].replace(
    "SELECT l_suppkey AS supplier", "SELECT CASE WHEN l_suppkey % 50 < 45 THEN l_suppkey % 10 ELSE l_suppkey + 100 END AS supplier"
)
_STAGE_MADE = ["lag1", "lag3", "expanding_mean_lag1", "rolling_mean_lag1_window_size2"]
_stage = _features(
    "(SELECT * FROM prepared WHERE target IS NOT NULL) AS p", "supplier, is_returned, split", "period", "target", (1, 3), 1, (2,)
)
ORACLES["feature_stage"] = f"WITH {_prepared(_BY_SERIES)} " + _rounded(
    f"SELECT * EXCLUDE (period, row_id), CAST(month(period) AS INTEGER) AS month FROM ({_known(_stage, *_STAGE_MADE)}) AS m",
    *_STAGE_MADE,
)
ORACLES["raw_to_features"] = ORACLES["feature_stage"].replace(
    "CASE WHEN q >= 40 THEN q END", "CASE WHEN q >= 40 OR period = min(period) OVER (PARTITION BY supplier, is_returned) THEN q END"
)

# --- dates ----------------------------------------------------------------------------------------------------------

ORACLES["add_date_features"] = """SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek,
  CAST(dayofyear(ts) AS INTEGER) AS dayofyear, CAST(week(ts) AS INTEGER) AS weekofyear FROM events"""
ORACLES["time_difference_and_stamp"] = """SELECT l_orderkey, l_linenumber, l_partkey,
  datediff('day', o_orderdate, l_shipdate) AS days, strftime(l_shipdate, '%Y%m%dT%H%M%SUTC') AS stamp
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# --- profiles -------------------------------------------------------------------------------------------------------

_LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINEITEM_TYPES = ["bigint"] * 3 + ["int"] + ["double"] * 4 + ["string"] * 2 + ["timestamp_ntz"]
ORACLES["shape_and_schema"] = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) AS n_rows, {len(_LINEITEM)} AS n_columns "
    "FROM lineitem"
    for i, (c, t) in enumerate(zip(_LINEITEM, _LINEITEM_TYPES, strict=True))
)
ORACLES["null_profile"] = f"WITH {_DENSE} " + _rounded(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, (count(*) - count({c})) / count(*) AS ratio FROM dense"
        for c in ("event_type", "ts", "value")
    ),
    "ratio",
)
ORACLES["nulls_per_series"] = f"""WITH {_DENSE}
SELECT event_type, count(*) - count(value) AS nulls FROM dense GROUP BY event_type HAVING count(*) > count(value)"""
_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORACLES["distinct_counts"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n FROM orders" for c in _ORDERS
)
ORACLES["distinct_values"] = "SELECT DISTINCT p_brand FROM part"
ORACLES["time_extent"] = """SELECT min(ts) AS start, max(ts) AS "end",
  date_diff('microsecond', min(ts), max(ts)) AS duration FROM events"""
ORACLES["series_extents"] = 'SELECT user_id, min(ts) AS start, max(ts) AS "end" FROM events GROUP BY user_id'
ORACLES["unique_date_ranges"] = f"""WITH {_MONTHLY}
SELECT DISTINCT start, "end" FROM (
  SELECT min(month) AS start, max(month) AS "end" FROM monthly GROUP BY l_suppkey) AS r"""


def _describe(table: str, col: str, by: str = "", where: str = "") -> str:
    keys = f"{by}, " if by else ""
    return (
        f"SELECT {keys}'{col}' AS \"column\", count({col}) AS count, avg({col}) AS mean, stddev_samp({col}) AS std, "
        f"min({col}) AS min, quantile_cont({col}, 0.25) AS p25, quantile_cont({col}, 0.5) AS p50, "
        f"quantile_cont({col}, 0.75) AS p75, max({col}) AS max FROM {table} {where} {f'GROUP BY {by}' if by else ''}"
    )


_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")
ORACLES["describe_columns"] = _rounded(
    " UNION ALL ".join(_describe("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    *_STATS, digits=4,
)
ORACLES["describe_by_group"] = _rounded(_describe("events", "value", "event_type"), *_STATS, digits=4)
ORACLES["describe_by_user"] = _rounded(_describe("events", "value", "user_id"), *_STATS, digits=4)
ORACLES["describe_daylight"] = _rounded(
    _describe("events", "value", where="WHERE hour(ts) >= 8 AND hour(ts) < 20"), *_STATS, digits=4
)
ORACLES["resample_mean"] = ORACLES["densify"]
ORACLES["resample_sum"] = _rounded(
    """SELECT c.user_id, c.ts, coalesce(d.value, 0) AS value FROM (
    SELECT user_id, unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS ts
    FROM events GROUP BY user_id) AS c
  LEFT JOIN (SELECT user_id, date_trunc('day', ts) AS ts, sum(value) AS value FROM events GROUP BY ALL) AS d
  ON c.user_id = d.user_id AND c.ts = d.ts""",
    "value", digits=4,
)
ORACLES["resample_total"] = _rounded(
    """SELECT c.o_orderdate, coalesce(d.o_totalprice, 0) AS o_totalprice FROM (
    SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)), date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY))
      AS o_orderdate FROM orders) AS c
  LEFT JOIN (
    SELECT date_trunc('day', o_orderdate) AS o_orderdate, sum(o_totalprice) AS o_totalprice FROM orders GROUP BY ALL) AS d
  ON c.o_orderdate = d.o_orderdate""",
    "o_totalprice", digits=2,
)
ORACLES["mae"] = f"""WITH {_MONTHLY}
SELECT round(avg(abs(quantity - lag1)) + 1e-10, 6) AS mae FROM (
  SELECT quantity, lag(quantity) OVER (PARTITION BY l_suppkey ORDER BY month) AS lag1 FROM monthly) AS t"""

# --- distributions --------------------------------------------------------------------------------------------------

ORACLES["category_histogram"] = "SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand"


def _histogram(value: str, where: str = "TRUE", bins: int | None = None, by: str = "") -> str:
    n_bins = str(bins) if bins else (
        "ceil((max(x) - min(x)) / least((max(x) - min(x)) / (log2(count(*)) + 1), "
        "2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) * pow(count(*), -1.0 / 3)))"
    )
    keys = f"{by}, " if by else ""
    return f"""WITH x AS (SELECT {keys}{value} AS x FROM events WHERE {where}),
s AS (SELECT min(x) AS lo, max(x) AS hi, CAST({n_bins} AS BIGINT) AS n FROM x),
b AS (SELECT i AS bin, lo + i * ((hi - lo) / n) AS "left",
        CASE WHEN i = n - 1 THEN hi ELSE lo + (i + 1) * ((hi - lo) / n) END AS "right", i = n - 1 AS is_last
      FROM (SELECT unnest(generate_series(0, n - 1)) AS i, lo, hi, n FROM s) AS t),
f AS (SELECT * FROM b{f' CROSS JOIN (SELECT DISTINCT {by} FROM x) AS g' if by else ''})
SELECT {'f.' + by + ', ' if by else ''}bin, round("left" + 1e-10, 6) AS "left", round("right" + 1e-10, 6) AS "right", count(x.x) AS count
FROM f LEFT JOIN x ON x.x >= f."left" AND (x.x < f."right" OR f.is_last){f' AND x.{by} = f.{by}' if by else ''}
GROUP BY ALL"""


ORACLES["histogram"] = _histogram("value")
ORACLES["histogram_log"] = _histogram("log10(value)", "value > 0")
ORACLES["histogram_by"] = _histogram("value", bins=20, by="event_type")
ORACLES["offset_histogram_log"] = _histogram("log10(value + 0.0001)", "value + 0.0001 > 0", bins=10)
ORACLES["dropped_by_log"] = "SELECT count(*) FILTER (value <= 0) AS dropped FROM events"


def _kde(value: str, where: str = "TRUE", by: str = "") -> str:
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""WITH x AS (SELECT {keys}{value} AS x FROM events WHERE {where}),
s AS (SELECT {keys}stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi FROM x {group}),
g AS (SELECT {keys}h, i AS point, lo - 3 * h + i * ((hi + 3 * h) - (lo - 3 * h)) / 199 AS gx
      FROM s, (SELECT unnest(generate_series(0, 199)) AS i) AS t)
SELECT {'g.' + keys if by else ''}point, round(gx + 1e-10, 8) AS x,
  round(sum(exp(-0.5 * pow((gx - x.x) / h, 2))) / ((SELECT count(*) FROM x) * h * sqrt(2 * pi())) + 1e-10, 8) AS density
FROM g, x {f'WHERE g.{by} = x.{by}' if by else ''} GROUP BY {'g.' + keys if by else ''}point, gx, h"""


ORACLES["kde"] = _kde("value")
ORACLES["kde_by"] = _kde("log10(value)", "value > 0", "event_type")

# --- autocorrelation ------------------------------------------------------------------------------------------------


def _acf(nlags: int, adjusted: bool) -> str:
    n = "(a.n - k.lag)" if adjusted else "a.n"
    return f"""WITH {_FILLED},
centred AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS pos,
  value - avg(value) OVER (PARTITION BY event_type) AS x, count(*) OVER (PARTITION BY event_type) AS n FROM filled),
zero AS (SELECT event_type, sum(x * x) / count(*) AS c0 FROM centred GROUP BY event_type),
k AS (SELECT unnest(generate_series(0, {nlags})) AS lag)
SELECT a.event_type, CAST(k.lag AS INTEGER) AS lag, round(sum(a.x * b.x) / any_value({n}) / any_value(c0) + 1e-10, 6) AS acf
FROM centred a CROSS JOIN k JOIN centred b ON a.event_type = b.event_type AND b.pos = a.pos + k.lag
JOIN zero ON zero.event_type = a.event_type GROUP BY a.event_type, k.lag"""


ORACLES["acf"] = _acf(24, False)
ORACLES["acf_adjusted_chunked"] = _acf(24, True)
ORACLES["top_lags"] = f"""SELECT event_type, lag, acf, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_type ORDER BY acf DESC, lag) AS INTEGER) AS rank
  FROM ({_acf(24, False)}) AS a) AS r WHERE rank <= 10"""

# with two lags the partial autocorrelations are 1, r1 and (r2 - r1²) / (1 - r1²)
_R = f"""(SELECT event_type, max(r) FILTER (lag = 1) AS r1, max(r) FILTER (lag = 2) AS r2,
  (SELECT count(*) FROM filled f WHERE f.event_type = c.event_type) AS n
  FROM ({{correlations}}) AS c GROUP BY event_type) AS r"""


def _pacf_two_lags() -> str:
    text = _acf(2, True).replace("+ 1e-10, 6) AS acf", "+ 0, 15) AS r")
    shared, correlations = text.split("\nSELECT a.event_type", 1)
    half = f"{1.959963984540054} / sqrt(n)"
    parts = [("0", "1.0", "0.0"), ("1", "r1", half), ("2", "(r2 - r1 * r1) / (1 - r1 * r1)", half)]
    rows = " UNION ALL ".join(
        f"SELECT event_type, CAST({lag} AS INTEGER) AS lag, CAST({v} AS DOUBLE) AS pacf, {v} - {h} AS lower, {v} + {h} AS upper "
        "FROM r"
        for lag, v, h in parts
    )
    inner = _R.format(correlations="SELECT a.event_type" + correlations).removesuffix(" AS r")
    return f"{shared}, r AS {inner} " + _rounded(rows, "pacf", "lower", "upper")


ORACLES["pacf_two_lags"] = _pacf_two_lags()


def _pacf(nlags: int, adjusted: bool, z: float) -> str:
    """Levinson and Durbin's recursion over lists: ``r`` is a series' autocorrelations from lag 0 on, ``phi`` the coefficients so far."""
    text = _acf(nlags, adjusted).replace("+ 1e-10, 6) AS acf", "+ 0, 15) AS acf")
    shared, correlations = text.split("\nSELECT a.event_type", 1)
    rows = f"""SELECT event_type, CAST(k AS INTEGER) AS lag, pacf, pacf - h AS lower, pacf + h AS upper FROM (
  SELECT event_type, k, pacf, CASE WHEN k = 0 THEN 0 ELSE {z} / sqrt(n) END AS h
  FROM steps JOIN (SELECT event_type, count(*) AS n FROM filled GROUP BY event_type) AS c USING (event_type)) AS p"""
    return f"""{shared.replace("WITH ", "WITH RECURSIVE ", 1)},
given AS (SELECT event_type, list(acf ORDER BY lag) AS r FROM (SELECT a.event_type{correlations}) AS c GROUP BY event_type),
steps AS (
  SELECT event_type, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS err, CAST(1 AS DOUBLE) AS pacf, r FROM given
  UNION ALL
  SELECT event_type, k + 1, list_append([phi[j] - p * phi[k + 1 - j] for j in range(1, k + 1)], p), err * (1 - p * p), p, r FROM (
    SELECT *, (r[k + 2] - coalesce(list_sum([phi[j] * r[k + 2 - j] for j in range(1, k + 1)]), 0)) / err AS p
    FROM steps WHERE k < {nlags}) AS s)
""" + _rounded(rows, "pacf", "lower", "upper")


ORACLES["pacf"] = _pacf(24, False, 2.5758293035489004)
ORACLES["pacf_week"] = _pacf(24 * 7, True, 1.959963984540054)

# --- splits ---------------------------------------------------------------------------------------------------------

_SPLIT = """(SELECT o_orderkey, o_orderdate,
  CASE WHEN o_orderdate <= TIMESTAMP '2000-01-01' THEN 'train' WHEN o_orderdate > TIMESTAMP '2000-01-01' THEN 'test' END AS split
  FROM orders) AS s"""
ORACLES["time_split"] = f"SELECT * FROM {_SPLIT}"
ORACLES["check_split"] = f"""SELECT count(*) AS n_rows, count(*) FILTER (split = 'train') AS n_train,
  count(*) FILTER (split = 'test') AS n_test, count(*) = count(split) AS complete FROM {_SPLIT}"""
ORACLES["split_fractions"] = f"""SELECT split, count(*) AS n_rows,
  round(count(*) / (SELECT count(*) FROM orders) + 1e-10, 6) AS fraction FROM {_SPLIT} GROUP BY split"""
ORACLES["cutoff_at_fraction"] = """SELECT o_orderdate AS cutoff FROM orders
QUALIFY row_number() OVER (ORDER BY o_orderdate) - 1 = CAST(floor(count(*) OVER () * 0.8) AS BIGINT)"""
ORACLES["cutoff_of_events"] = """SELECT ts AS cutoff FROM events
QUALIFY row_number() OVER (ORDER BY ts) - 1 = CAST(floor(count(*) OVER () * 0.65) AS BIGINT)"""
_PLACED = """(SELECT *, row_number() OVER (ORDER BY o_orderdate, md5(CAST(o_orderkey AS VARCHAR))) - 1 AS pos,
  count(*) OVER () AS n, count(*) OVER () // 6 AS m FROM orders) AS p"""
ORACLES["expanding_folds"] = f"""SELECT o_orderkey, o_orderdate,
  CAST(CASE WHEN pos < n - 5 * m THEN 0 ELSE (pos - (n - 5 * m)) // m + 1 END AS INTEGER) AS block FROM {_PLACED}"""
ORACLES["expanding_folds_by_time"] = f"""SELECT o_orderkey, o_orderdate, CAST((
  SELECT count(*) FROM (SELECT o_orderdate AS at FROM {_PLACED} WHERE pos >= n - 5 * m AND (pos - (n - 5 * m)) % m = 0) AS b
  WHERE b.at <= orders.o_orderdate) AS INTEGER) AS block FROM orders"""

# --- rows and columns -----------------------------------------------------------------------------------------------

_EVENTS = "event_id, ts, user_id, event_type, value, props"
ORACLES["target_first"] = "SELECT o_totalprice, * EXCLUDE (o_totalprice) FROM orders"
ORACLES["drop_columns"] = "SELECT * EXCLUDE (l_tax, l_discount, l_linestatus) FROM lineitem"
ORACLES["rename_columns"] = "SELECT event_id, ts, user_id AS segment_id, event_type, value AS consumption, props FROM events"
ORACLES["select_columns"] = "SELECT l_orderkey, l_shipdate, l_quantity FROM lineitem"
ORACLES["split_measure"] = "SELECT * EXCLUDE (quality) FROM labels WHERE quality = 1"
ORACLES["with_measure"] = "SELECT *, CASE toxic WHEN 0 THEN 'clean' WHEN 1 THEN 'toxic' END AS measure FROM labels"
ORACLES["keep_series"] = (
    "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
)
ORACLES["drop_series"] = f"SELECT {_EVENTS} FROM events WHERE event_type NOT IN ('error', 'view') OR event_type IS NULL"
ORACLES["time_between"] = f"""SELECT {_EVENTS} FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00' AND event_type = 'click'"""
ORACLES["hour_of_day_between"] = f"SELECT {_EVENTS} FROM events WHERE hour(ts) >= 8 AND hour(ts) < 20"
ORACLES["null_rows"] = f"WITH {_DENSE} SELECT * FROM dense WHERE value IS NULL"
ORACLES["drop_incomplete"] = f"WITH {_DENSE} " + _rounded("SELECT * FROM dense WHERE value IS NOT NULL", "value")
ORACLES["offset_column"] = "SELECT event_id, round(value + 0.0001 + 1e-10, 6) AS value FROM events"
ORACLES["log_of_positive"] = "SELECT event_id, round(CASE WHEN value > 0 THEN log10(value) END + 1e-10, 6) AS value FROM events"
ORACLES["features_and_label"] = (
    "SELECT l_orderkey, l_extendedprice AS label, l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem"
)
ORACLES["parse_time"] = "SELECT o_orderkey, o_orderdate FROM orders"
_NARROW = "CASE WHEN max({c}) <= 255 THEN 'smallint' WHEN max({c}) <= 65535 THEN 'int' ELSE '{t}' END"
ORACLES["downcast_ints"] = f"""SELECT p_partkey, p_size, CAST(p_size AS SMALLINT) AS small,
  (SELECT {_NARROW.format(c='p_partkey', t='bigint')} || ' ' || {_NARROW.format(c='p_size', t='int')} || ' smallint' FROM part) AS types FROM part"""
ORACLES["downcast_floats"] = """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity, l_extendedprice,
  CAST(l_discount AS FLOAT) AS l_discount FROM lineitem"""
ORACLES["as_category"] = """SELECT event_id, event_type,
  CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS event_type_code FROM events"""
ORACLES["as_category_of_dates"] = """SELECT o_orderkey, o_orderdate,
  CAST(CASE WHEN o_orderdate IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY o_orderdate) - 1 END AS INTEGER) AS code FROM orders"""
ORACLES["as_category_of_names"] = """SELECT c_custkey, c_name,
  CAST(CASE WHEN c_name IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY c_name) - 1 END AS INTEGER) AS code FROM customer"""
ORACLES["categories"] = "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL"
ORACLES["as_bool"] = "SELECT doc_id, CAST(quality AS BOOLEAN) AS quality FROM labels"
ORACLES["sort_by"] = "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey"
ORACLES["top_k"] = "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
ORACLES["best_row"] = "SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1"
ORACLES["union_keys"] = (
    "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION "
    "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"
)
ORACLES["update_from"] = """SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN coalesce(m, c_acctbal) ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS m FROM orders GROUP BY o_custkey) AS o ON o_custkey = c_custkey"""
ORACLES["stack_rows"] = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"
ORACLES["align_columns"] = """SELECT user_id, min(ts) AS first, max(ts) AS last,
  nullif(count(*) FILTER (event_type = 'purchase' AND value > 100), 0) AS n FROM events GROUP BY user_id"""
ORACLES["sample_series"] = """SELECT user_id FROM (SELECT DISTINCT user_id FROM events) AS u
ORDER BY md5('42|' || CAST(user_id AS VARCHAR)), user_id LIMIT 5"""
ORACLES["distinct_rows"] = "SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem"
ORACLES["same_rows"] = "SELECT 'parts' AS \"case\", TRUE AS same UNION ALL SELECT 'short', FALSE"
ORACLES["different_rows"] = """SELECT l_suppkey, l_linenumber, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT l_suppkey, l_linenumber, 1 AS n FROM lineitem WHERE l_quantity > 25 UNION ALL
  SELECT l_suppkey, l_linenumber, -1 AS n FROM lineitem WHERE l_discount > 0.05) AS t
GROUP BY l_suppkey, l_linenumber HAVING sum(n) <> 0"""
ORACLES["dedupe_runs"] = """SELECT *, CAST(datediff('day', DATE '1970-01-01', o_orderdate) AS INTEGER) AS start_time FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) = 1"""

# --- sources and sinks ----------------------------------------------------------------------------------------------

ORACLES["read_observations"] = f"SELECT {_EVENTS} FROM events"
ORACLES["read_documents"] = "SELECT * FROM documents"
ORACLES["read_rejects"] = "SELECT event_id || ',n/a' AS _corrupt FROM events WHERE event_type = 'error'"
ORACLES["read_lookup_json"] = "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation"
ORACLES["list_stage"] = "SELECT TRUE AS found, TRUE AS filled"
ORACLES["land_raw"] = "SELECT * FROM orders"
ORACLES["write_splits"] = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS measure,
  'test' AS split FROM orders WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '2000-01-01'"""
ORACLES["write_stage"] = "SELECT * FROM customer"
ORACLES["write_table_downcast"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS FLOAT) AS l_quantity FROM lineitem"
)
ORACLES["to_split_json"] = """SELECT event_id // 100 AS request,
  '{"dataframe_split":{"columns":["user_id","value"],"data":[' || string_agg(
    '[' || CAST(CAST(user_id AS DOUBLE) AS VARCHAR) || ',' || CAST(value AS VARCHAR) || ']', ',' ORDER BY event_id)
  || ']}}' AS payload FROM events GROUP BY ALL"""
ORACLES["from_split_json"] = """SELECT event_id // 100 AS request,
  CAST(row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS INTEGER) AS "row",
  value, CAST(user_id AS DOUBLE) AS user_id, CAST(NULL AS VARCHAR) AS error FROM events"""

# --- models: what does not depend on the fitted trees ---------------------------------------------------------------

_SCORED = f"""WITH {_MONTHLY}
SELECT l_suppkey AS request, CAST(count(*) AS {{kind}}) AS n_predictions, TRUE AS same, CAST(NULL AS VARCHAR) AS error
FROM ({_MONTHLY_FEATURES}) AS f GROUP BY l_suppkey"""
ORACLES["score_batch"] = _SCORED.format(kind="INTEGER")
ORACLES["score_stream"] = _SCORED.format(kind="BIGINT")

# --- models: facts that hold whatever trees are fitted ----------------------------------------------------------------

ORACLES["predict"] = f"""WITH {_MONTHLY}
SELECT l_suppkey, month, quantity, TRUE AS predicted, TRUE AS beats_mean FROM ({_MONTHLY_FEATURES}) AS f"""
ORACLES["backtest"] = f"""WITH {_MONTHLY}, n AS (SELECT count(*) AS n FROM ({_MONTHLY_FEATURES}) AS f)
SELECT CAST(fold AS INTEGER) AS fold, n // 6 AS n_rows, TRUE AS in_range, TRUE AS adds_up FROM n, range(1, 6) AS r(fold)"""
ORACLES["sweep"] = """SELECT 'monthly' AS study, CAST(i AS INTEGER) AS number, 5 AS n_folds, TRUE AS in_space, TRUE AS is_mean,
  TRUE AS is_best FROM range(3) AS r(i)"""
ORACLES["best_trial"] = "SELECT 'monthly' AS study, TRUE AS is_least"
ORACLES["search_runs"] = """SELECT 'FINISHED' AS status, num_trees, TRUE AS measured FROM (VALUES ('8'), ('2')) AS t(num_trees)"""
ORACLES["validate_model"] = "SELECT TRUE AS valid"
ORACLES["promote_best"] = "SELECT 'monthly' AS experiment_id, TRUE AS is_least"
