"""The same results in plain SQL over the same tables, for checking."""

from demandloom.schemas import HORIZON

_FILL = """COALESCE(
  LAST_VALUE({c} IGNORE NULLS) OVER ({p} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  FIRST_VALUE({c} IGNORE NULLS) OVER ({p} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def _fill(column: str, partition: str = "") -> str:
    return _FILL.format(c=column, p=f"PARTITION BY {partition}" if partition else "")


_BASE = f"""
WITH panel AS (
  SELECT (CAST(l_shipdate AS DATE) - DATE '1990-01-01') * 1000 + s_nationkey * 10
      + CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2
                    WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 WHEN 'STANDARD' THEN 5 ELSE 9 END AS id,
    CAST(l_shipdate AS DATE) AS date, CAST(s_nationkey AS INTEGER) AS store_nbr, p_type AS family,
    SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS sales,
    CAST(SUM(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS onpromotion
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY CAST(l_shipdate AS DATE), s_nationkey, p_type),
due AS (
  SELECT CAST(o_orderdate AS DATE) + 95 AS date, o_totalprice, o_orderpriority, o_orderstatus FROM orders),
oil_raw AS (
  SELECT date, CASE WHEN day(date) IN (10, 20, 30) THEN NULL ELSE MIN(o_totalprice) END AS dcoilwtico
  FROM due WHERE isodow(date) < 6 GROUP BY date),
oil AS (SELECT date, {_fill("dcoilwtico")} AS oil_price FROM oil_raw),
holiday AS (
  SELECT DISTINCT date, 1 AS is_holiday FROM due
  WHERE day(date) IN (1, 15, 25) AND NOT (o_orderstatus = 'F') AND o_orderpriority <> '5-LOW'),
hist AS (SELECT * FROM panel WHERE date <= (SELECT MAX(date) FROM panel) - {HORIZON}),
req AS (SELECT * EXCLUDE (sales) FROM panel WHERE date > (SELECT MAX(date) FROM panel) - {HORIZON}),
daily AS (
  SELECT date, CAST(SUM(sales) AS DOUBLE) AS total_cashflow, CAST(SUM(onpromotion) AS BIGINT) AS onpromotion
  FROM panel GROUP BY date),
hist_daily AS (
  SELECT date, CAST(SUM(sales) AS DOUBLE) AS total_cashflow, CAST(SUM(onpromotion) AS BIGINT) AS onpromotion
  FROM hist GROUP BY date),
feat AS (
  SELECT date, total_cashflow, onpromotion, {_fill("oil_price")} AS oil_price,
    CAST(COALESCE(is_holiday, 0) AS DOUBLE) AS is_holiday, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week
  FROM daily LEFT JOIN oil USING (date) LEFT JOIN holiday USING (date)),
hist_feat AS (
  SELECT date, {_fill("oil_price")} AS oil_price
  FROM hist_daily LEFT JOIN oil USING (date)),
pair_feat AS (
  SELECT id, date, store_nbr, family, CAST(sales AS DOUBLE) AS sales, onpromotion,
    {_fill("oil_price", "store_nbr, family")} AS oil_price,
    CAST(COALESCE(is_holiday, 0) AS DOUBLE) AS is_holiday, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week
  FROM panel LEFT JOIN oil USING (date) LEFT JOIN holiday USING (date)),
req_days AS (
  SELECT date, {_fill("oil_price")} AS oil_price, CAST(COALESCE(is_holiday, 0) AS DOUBLE) AS is_holiday,
    CAST(isodow(date) - 1 AS INTEGER) AS day_of_week
  FROM (SELECT DISTINCT date FROM req) LEFT JOIN oil USING (date) LEFT JOIN holiday USING (date)),
inst AS (
  SELECT id, date, store_nbr, family, onpromotion, oil_price, is_holiday, day_of_week
  FROM req JOIN req_days USING (date)),
recent AS (SELECT * FROM panel WHERE date >= (SELECT MAX(date) FROM panel) - 30),
hist_recent AS (SELECT * FROM hist WHERE date >= (SELECT MAX(date) FROM hist) - 30),
share AS (
  SELECT store_nbr, family, CAST(SUM(sales) AS DOUBLE)
    / (SELECT CAST(SUM(sales) AS DOUBLE) FROM hist_recent) AS proportion
  FROM hist_recent GROUP BY store_nbr, family),
lagged AS (
  SELECT date, k AS step, total_cashflow AS forecast FROM (
    SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM req))
  JOIN (SELECT total_cashflow, ROW_NUMBER() OVER (ORDER BY date) AS rn, COUNT(*) OVER () AS n FROM hist_daily)
    ON rn = n - 7 + ((k - 1) % 7) + 1),
scored AS (
  SELECT i.*, COALESCE(proportion, 0.0::DOUBLE) AS proportion,
    GREATEST(COALESCE(forecast, 0.0::DOUBLE) * COALESCE(proportion, 0.0::DOUBLE), 0.0::DOUBLE) AS sales
  FROM inst i LEFT JOIN lagged USING (date) LEFT JOIN share USING (store_nbr, family)),
tagged AS (
  SELECT store_nbr, family, date, CAST(sales AS DOUBLE) AS sales,
    CASE WHEN date <= MAX(date) OVER (PARTITION BY store_nbr, family) - {HORIZON}
      THEN 'train' ELSE 'val' END AS split FROM panel),
train AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY store_nbr, family ORDER BY date) AS rn,
    COUNT(*) OVER (PARTITION BY store_nbr, family) AS n FROM tagged WHERE split = 'train'),
val AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY store_nbr, family ORDER BY date) AS step
  FROM tagged WHERE split = 'val'),
naive AS (
  SELECT v.store_nbr, v.family, COUNT(*) AS val_rows, AVG(ABS(v.sales - t.sales)) AS mae,
    SQRT(AVG((v.sales - t.sales) * (v.sales - t.sales))) AS rmse,
    COALESCE(AVG(CASE WHEN v.sales <> 0 THEN ABS((v.sales - t.sales) / v.sales) END), 0) * 100 AS mape
  FROM val v JOIN train t ON v.store_nbr = t.store_nbr AND v.family = t.family AND t.rn = t.n
  WHERE v.step <= {HORIZON} GROUP BY v.store_nbr, v.family),
numbered AS (
  SELECT store_nbr, family, CAST(sales AS DOUBLE) AS y, CAST(onpromotion AS DOUBLE) AS x,
    LAG(CAST(sales AS DOUBLE)) OVER (PARTITION BY store_nbr, family ORDER BY date) AS y1,
    ROW_NUMBER() OVER (PARTITION BY store_nbr, family ORDER BY date) AS rn,
    COUNT(*) OVER (PARTITION BY store_nbr, family) AS n FROM panel),
made AS (
  SELECT *, CASE WHEN trial_id = 38 THEN NULL
      WHEN trial_id = 57 OR store_nbr = 24 THEN CAST('NaN' AS DOUBLE)
      WHEN trial_id = 95 THEN CAST('-Infinity' AS DOUBLE) ELSE score END AS aic,
    trial_id <> 38 AS converged,
    CAST(trial_id // 48 AS INTEGER) AS p, CAST(trial_id // 24 % 2 AS INTEGER) AS d,
    CAST(trial_id // 8 % 3 AS INTEGER) AS q, CAST(trial_id // 4 % 2 AS INTEGER) AS seasonal_p,
    CAST(trial_id // 2 % 2 AS INTEGER) AS seasonal_d, CAST(trial_id % 2 AS INTEGER) AS seasonal_q
  FROM (
    SELECT CAST(s_nationkey AS INTEGER) AS store_nbr, p_type AS family, l_linenumber * 19 AS trial_id,
      FLOOR(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 100000) AS score,
      COUNT(*) AS n_obs
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
    GROUP BY s_nationkey, p_type, l_linenumber)),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY store_nbr, family ORDER BY aic, trial_id) AS place
  FROM made WHERE aic IS NOT NULL AND isfinite(aic)),
counts AS (
  SELECT store_nbr, family, COUNT(*) AS total_trials, CAST(COUNT_IF(converged) AS BIGINT) AS successful_trials
  FROM made GROUP BY store_nbr, family),
chosen AS (
  SELECT c.store_nbr, c.family, trial_id, COALESCE(p, 1) AS p, COALESCE(d, 1) AS d, COALESCE(q, 1) AS q,
    COALESCE(seasonal_p, 1) AS seasonal_p, COALESCE(seasonal_d, 1) AS seasonal_d,
    COALESCE(seasonal_q, 1) AS seasonal_q, aic, trial_id IS NOT NULL AS converged,
    total_trials, successful_trials
  FROM counts c LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (store_nbr, family))
"""

_LN2PI = "LN(2 * PI() * sse / m) + 1"
_GRID = " CROSS JOIN ".join(
    f"(SELECT UNNEST({values}) AS {name})"
    for name, values in (
        ("p", [0, 1, 2]), ("d", [0, 1]), ("q", [0, 1, 2]),
        ("seasonal_p", [0, 1]), ("seasonal_d", [0, 1]), ("seasonal_q", [0, 1]),
    )
)
_LABEL = (
    "'p' || p || 'd' || d || 'q' || q || '-P' || seasonal_p || 'D' || seasonal_d || 'Q' || seasonal_q"
)
_SAFE = "CASE WHEN {c} IS NOT NULL AND isfinite({c}) THEN {c} ELSE -1.0::DOUBLE END"

_STUMP = """(WITH points AS (
    SELECT CAST(l_linenumber AS INTEGER) AS number, CAST(ROUND(l_discount * 100) AS INTEGER) AS discount,
      CASE WHEN l_linenumber * 3 + l_quantity > 30 THEN 'large' ELSE 'small' END AS label FROM lineitem),
  cuts AS (
    SELECT 'number' AS f, number AS c FROM points GROUP BY 2 UNION ALL SELECT 'discount', discount FROM points GROUP BY 2),
  tried AS (
    SELECT f, c, COUNT_IF(low) AS a, COUNT_IF(low AND label = 'large') AS al,
      COUNT_IF(NOT low) AS b, COUNT_IF(NOT low AND label = 'large') AS bl
    FROM (SELECT f, c, label, CASE WHEN f = 'number' THEN number ELSE discount END <= c AS low FROM points CROSS JOIN cuts)
    GROUP BY f, c),
  best AS (
    SELECT *, CASE WHEN 2 * al > a THEN 'large' ELSE 'small' END AS inner_label,
      CASE WHEN 2 * bl > b THEN 'large' ELSE 'small' END AS outer_label
    FROM tried WHERE a > 0 AND b > 0 ORDER BY al * (a - al) / a + bl * (b - bl) / b LIMIT 1)
  SELECT p.*, CASE WHEN f = 'number' THEN number ELSE discount END <= c AS inside, inner_label, outer_label
  FROM points p CROSS JOIN best)"""

_LINEAR = """(WITH y AS (SELECT store_nbr, family, date, CAST(sales AS DOUBLE) AS y FROM panel),
  once AS (
    SELECT *, 0 AS seasonal_d, y AS u FROM y
    UNION ALL SELECT *, 1, y - LAG(y, 7) OVER (PARTITION BY store_nbr, family ORDER BY date) FROM y),
  z AS (
    SELECT store_nbr, family, date, seasonal_d, 0 AS d, u AS z FROM once
    UNION ALL SELECT store_nbr, family, date, seasonal_d, 1, u - LAG(u) OVER (PARTITION BY store_nbr, family, seasonal_d ORDER BY date) FROM once),
  lagged AS (
    SELECT *, ROW_NUMBER() OVER w AS spot, LAG(z, 1) OVER w AS l1, LAG(z, 2) OVER w AS l2, LAG(z, 7) OVER w AS l7 FROM z
    WINDOW w AS (PARTITION BY store_nbr, family, d, seasonal_d ORDER BY date)),
  s AS (
    SELECT store_nbr, family, d, seasonal_d, COUNT(z) AS n_obs, SUM(z * z) AS zz, SUM(l1 * z) AS s1, SUM(l1 * l1) AS s11,
      SUM(l2 * z) AS s2, SUM(l2 * l2) AS s22, SUM(l1 * l2) AS s12, SUM(l7 * z) AS s7, SUM(l7 * l7) AS s77
    FROM lagged WHERE spot > 15 GROUP BY store_nbr, family, d, seasonal_d),
  fits AS (
    SELECT store_nbr, family, d, seasonal_d, n_obs, 0 AS p, 0 AS seasonal_p, NULL::DOUBLE AS first, zz AS sse, 1 AS k FROM s
    UNION ALL SELECT store_nbr, family, d, seasonal_d, n_obs, 1, 0, s1 / NULLIF(s11, 0), zz - s1 * s1 / NULLIF(s11, 0), 2 FROM s
    UNION ALL SELECT store_nbr, family, d, seasonal_d, n_obs, 2, 0, (s1 * s22 - s2 * s12) / NULLIF(s11 * s22 - s12 * s12, 0),
      zz - (s1 * s22 - s2 * s12) / NULLIF(s11 * s22 - s12 * s12, 0) * s1 - (s2 * s11 - s1 * s12) / NULLIF(s11 * s22 - s12 * s12, 0) * s2, 3 FROM s
    UNION ALL SELECT store_nbr, family, d, seasonal_d, n_obs, 0, 1, s7 / NULLIF(s77, 0), zz - s7 * s7 / NULLIF(s77, 0), 2 FROM s)
  SELECT *, CASE WHEN n_obs > k AND sse > 0 THEN 2 * k + n_obs * (LN(2 * PI() * sse / n_obs) + 1) END AS aic FROM fits)"""

def _projected(lags: list[str]) -> str:
    """Regressions of z on x1 to x4 and the lags: each column loses what those before it explain, so the
    last coefficient and the sum of squares are plain projections. Null where a column depends on others."""
    group = "PARTITION BY store_nbr, family, d, seasonal_d"
    columns = ["x1", "x2", "x3", "x4", *lags]
    sql, rest = "SELECT *, z AS own FROM lagged", [*columns, "z"]
    for k, c in enumerate(columns):
        rest = rest[1:]
        norm = f"SUM({c} * {c}) OVER ({group})"
        pivot = f"CASE WHEN {norm} > 1e-10 * SUM({c}_raw * {c}_raw) OVER ({group}) THEN {norm} END"
        left = ", ".join(f"{r} - {c} * (SUM({c} * {r}) OVER ({group}) / {pivot}) AS {r}" for r in rest)
        last = f", SUM({c} * z) OVER ({group}) / {pivot} AS last" if k == len(columns) - 1 else ""
        sql = f"SELECT * REPLACE ({left}){last} FROM ({sql})"
    p, seasonal_p = (0, 1) if lags == ["l7"] else (len(lags), 0)
    return f"""SELECT store_nbr, family, {p} AS p, d, {seasonal_p} AS seasonal_p, seasonal_d, COUNT(*) AS n_obs,
      ANY_VALUE(last) AS last, {len(columns) + 1} AS k, SUM(z * z) AS sse FROM ({sql}) GROUP BY store_nbr, family, d, seasonal_d"""


def _exog_trials() -> str:
    names = ["sales", "onpromotion", "oil_price", "is_holiday", "day_of_week"]
    short = ["z", "x1", "x2", "x3", "x4"]
    w, wd = "(PARTITION BY store_nbr, family ORDER BY date)", "(PARTITION BY store_nbr, family, seasonal_d ORDER BY date)"
    first = ", ".join(f"CAST({n} AS DOUBLE) AS {c}" for n, c in zip(names, short))
    seasonal = ", ".join(f"{c} - LAG({c}, 7) OVER {w}" for c in short)
    plain = ", ".join(f"{c} - LAG({c}) OVER {wd}" for c in short)
    raw = ", ".join(f"{c} AS {c}_raw" for c in short[1:])
    parts = " UNION ALL ".join(map(_projected, ([], ["l1"], ["l1", "l2"], ["l7"])))
    return f"""(WITH own AS (SELECT store_nbr, family, date, {first} FROM pair_feat),
  once AS (SELECT *, 0 AS seasonal_d FROM own UNION ALL SELECT store_nbr, family, date, {seasonal}, 1 FROM own),
  twice AS (SELECT *, 0 AS d FROM once UNION ALL SELECT store_nbr, family, date, {plain}, seasonal_d, 1 FROM once),
  lagged AS (
    SELECT *, {raw}, l1 AS l1_raw, l2 AS l2_raw, l7 AS l7_raw FROM (
      SELECT *, ROW_NUMBER() OVER w AS spot, LAG(z, 1) OVER w AS l1, LAG(z, 2) OVER w AS l2, LAG(z, 7) OVER w AS l7 FROM twice
      WINDOW w AS (PARTITION BY store_nbr, family, d, seasonal_d ORDER BY date)) WHERE spot > 15)
  SELECT *, CASE WHEN n_obs > k AND sse > 0 THEN 2 * k + n_obs * (LN(2 * PI() * sse / n_obs) + 1) END AS aic FROM ({parts}))"""


_KPSS = """(WITH z AS (
    SELECT store_nbr, family, 0 AS k, rn AS t, y AS z FROM numbered
    UNION ALL SELECT store_nbr, family, 1, rn - 1, y - y1 FROM numbered WHERE rn > 1),
  e AS (SELECT store_nbr, family, k, t, z - AVG(z) OVER w AS e, COUNT(*) OVER w AS n FROM z WINDOW w AS (PARTITION BY store_nbr, family, k)),
  walked AS (SELECT *, SUM(e) OVER (PARTITION BY store_nbr, family, k ORDER BY t) AS s FROM e),
  sums AS (
    SELECT store_nbr, family, k, n, CAST(FLOOR(3 * SQRT(n) / 13) AS INTEGER) AS lags, SUM(s * s) AS q, SUM(e * e) / n AS own
    FROM walked GROUP BY store_nbr, family, k, n),
  crossed AS (
    SELECT a.store_nbr, a.family, a.k, SUM(2 * (1 - (a.t - b.t) / (lags + 1.0)::DOUBLE) * a.e * b.e) / ANY_VALUE(a.n) AS others
    FROM e a JOIN sums USING (store_nbr, family, k)
      JOIN e b ON a.store_nbr = b.store_nbr AND a.family = b.family AND a.k = b.k AND b.t BETWEEN a.t - lags AND a.t - 1
    GROUP BY a.store_nbr, a.family, a.k)
  SELECT *, q / (n * n) / NULLIF(own + COALESCE(others, 0), 0) AS kpss FROM sums LEFT JOIN crossed USING (store_nbr, family, k))"""

def _without(source: str, own: str, columns: list[str]) -> str:
    """``own`` and what the regressions on each of the columns in turn leave of it and of the later ones."""
    w = "(PARTITION BY store_nbr, family)"
    for i, x in enumerate(columns):
        left = ", ".join(f"{c} - {x} * SUM({c} * {x}) OVER {w} / SUM({x} * {x}) OVER {w} AS {c}" for c in (own, *columns[i + 1 :]))
        # the last column stays, so that its coefficient can be had
        kept = f", {x} AS x_last, {own} AS z_last" if x == columns[-1] else ""
        source = f"SELECT * REPLACE ({left}){kept} FROM ({source})"
    return source


def _two_stage() -> str:
    w = "(PARTITION BY store_nbr, family ORDER BY date)"
    back = ", ".join(f"LAG(z, {k}) OVER {w} AS z{k}" for k in range(1, 9))
    long = _without("SELECT *, z AS e FROM own WHERE spot > 9", "e", [f"z{k}" for k in range(1, 9)])
    shifts = ", ".join(f"LAG({c}, {k}) OVER {w} AS {c}{k}" for c in ("z", "e") for k in (1, 2, 7))
    parts = []
    for p, seasonal_p in ((0, 0), (1, 0), (2, 0), (0, 1)):
        for q in (0, 1, 2):
            for seasonal_q in (0, 1):
                columns = ["z1", "z2"][:p] + ["z7"] * seasonal_p + ["e1", "e2"][:q] + ["e7"] * seasonal_q
                last = "SUM(z_last * x_last) / NULLIF(SUM(x_last * x_last), 0)" if columns else "NULL::DOUBLE"
                parts.append(f"""SELECT store_nbr, family, {p} AS p, {q} AS q, {seasonal_p} AS seasonal_p, {seasonal_q} AS seasonal_q,
                  COUNT(*) AS n_obs, {len(columns) + 1} AS k, SUM(z * z) AS sse, {last} AS last
                  FROM ({_without("SELECT * FROM second", "z", columns)}) GROUP BY store_nbr, family""")
    return f"""(WITH steps AS (
    SELECT store_nbr, family, date, CAST(sales AS DOUBLE) - LAG(CAST(sales AS DOUBLE)) OVER {w} AS z, ROW_NUMBER() OVER {w} AS spot FROM panel),
  own AS (SELECT *, {back} FROM steps),
  residuals AS MATERIALIZED (SELECT store_nbr, family, date, z, e FROM ({long})),
  second AS MATERIALIZED (
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER {w} AS place, {shifts} FROM residuals) WHERE place > 7)
  SELECT * REPLACE (CASE WHEN n_obs > k AND sse > 0 THEN last END AS last),
    CASE WHEN n_obs > k AND sse > 0 THEN 2 * k + n_obs * (LN(2 * PI() * sse / n_obs) + 1) END AS aic FROM ({" UNION ALL ".join(parts)}))"""


_TWO_STAGE = _two_stage()

_SELECTS = {
    "ma_two_stage": f"""SELECT store_nbr, family, p, q, seasonal_p, seasonal_q, n_obs, ROUND(last, 5) AS last, ROUND(aic, 4) AS aic
        FROM {_TWO_STAGE}""",
    "ma_two_stage_best": f"""SELECT store_nbr, family, p, q, seasonal_p, seasonal_q FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY store_nbr, family ORDER BY aic NULLS LAST, p, q, seasonal_p, seasonal_q) AS place FROM {_TWO_STAGE}) WHERE place = 1""",
    "kpss_level": f"""SELECT *, CASE WHEN COALESCE(kpss <= 0.463, TRUE) THEN 0 WHEN COALESCE(kpss_1 <= 0.463, TRUE) THEN 1 ELSE 2 END AS d
        FROM (SELECT store_nbr, family, CAST(a.n AS INTEGER) AS n_obs, ROUND(a.kpss, 6) AS kpss, ROUND(b.kpss, 6) AS kpss_1
          FROM {_KPSS} a LEFT JOIN (SELECT * FROM {_KPSS} WHERE k = 1) b USING (store_nbr, family) WHERE a.k = 0)""",
    "seasonal_strength": """SELECT store_nbr, family, ROUND(strength, 6) AS strength, CASE WHEN strength > 0.64 THEN 1 ELSE 0 END AS seasonal_d
        FROM (SELECT store_nbr, family, CASE WHEN ANY_VALUE(n) >= 21 THEN GREATEST(0.0, 1 - VAR_POP(v - season) / NULLIF(VAR_POP(v), 0)) END AS strength
          FROM (SELECT *, AVG(v) OVER (PARTITION BY store_nbr, family, (rn - 1) % 7) AS season
            FROM (SELECT store_nbr, family, rn, n, CASE WHEN rn > 3 AND rn <= n - 3 THEN y - AVG(y) OVER (
                PARTITION BY store_nbr, family ORDER BY rn ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS v FROM numbered))
          GROUP BY store_nbr, family)""",
    "linear_exog_fit": f"""SELECT store_nbr, family, p, d, seasonal_p, seasonal_d, n_obs, ROUND(last, 5) AS last,
        ROUND(aic, 4) AS aic FROM {_exog_trials()}""",
    "daily_totals": "SELECT date, total_cashflow, onpromotion FROM daily",
    "oil_filled": "SELECT date, oil_price FROM oil",
    "holiday_flags": "SELECT date, is_holiday FROM holiday",
    "features_total": "SELECT * FROM feat",
    "features_calendar": "SELECT * EXCLUDE (day_of_week) FROM feat",
    "features_pair": "SELECT * FROM pair_feat",
    "target_series": "SELECT * FROM pair_feat WHERE store_nbr = 1 AND family = 'PROMO'",
    "holdout_split": f"""SELECT *, CASE WHEN date <= (SELECT MAX(date) FROM feat) - {HORIZON}
        THEN 'train' ELSE 'val' END AS split FROM feat""",
    "holdout_split_pair": "SELECT store_nbr, family, date, sales, split FROM tagged",
    "future_calendar": f"""SELECT date,
        COALESCE(oil_price, (SELECT oil_price FROM hist_feat ORDER BY date DESC LIMIT 1)) AS oil_price,
        CAST(COALESCE(is_holiday, 0) AS DOUBLE) AS is_holiday, CAST(0 AS BIGINT) AS onpromotion
        FROM (SELECT (SELECT MAX(date) FROM hist) + CAST(k AS INTEGER) AS date
              FROM generate_series(1, {HORIZON}) AS g(k))
        LEFT JOIN oil USING (date) LEFT JOIN holiday USING (date)""",
    "differenced_series": """SELECT store_nbr, family, date,
        ROUND(s1 - LAG(s1, 7) OVER (PARTITION BY store_nbr, family ORDER BY date), 4) AS sales
        FROM (SELECT store_nbr, family, date, CAST(sales AS DOUBLE)
          - LAG(CAST(sales AS DOUBLE)) OVER (PARTITION BY store_nbr, family ORDER BY date) AS s1 FROM panel)""",
    "latest_days": "SELECT * FROM feat ORDER BY date DESC LIMIT 15",
    "batch_input": "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM inst",
    "batch_input_pair": f"""SELECT id, date, store_nbr, family, onpromotion,
        {_fill("oil_price", "store_nbr, family")} AS oil_price,
        CAST(COALESCE(is_holiday, 0) AS DOUBLE) AS is_holiday, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week
        FROM req LEFT JOIN oil USING (date) LEFT JOIN holiday USING (date)""",
    "request_daily_exog": """SELECT date, CAST(SUM(onpromotion) AS DOUBLE) AS onpromotion,
        MIN(oil_price) AS oil_price, MIN(is_holiday) AS is_holiday, MIN(day_of_week) AS day_of_week
        FROM inst GROUP BY date""",
    "request_parse": """SELECT id, date, store_nbr, family, CAST(onpromotion AS DOUBLE) AS onpromotion,
        CAST(sales AS DOUBLE) AS oil_price, 0.0::DOUBLE AS is_holiday,
        CAST(isodow(date) - 1 AS INTEGER) AS day_of_week FROM panel""",
    "request_lists": """SELECT store_nbr, family, CAST(date_trunc('month', date) AS DATE) AS month,
        CAST(ROW_NUMBER() OVER (PARTITION BY store_nbr, family, date_trunc('month', date) ORDER BY date)
          AS INTEGER) AS step,
        CAST(onpromotion AS DOUBLE) AS onpromotion, CAST(sales AS DOUBLE) AS oil_price,
        0.0::DOUBLE AS is_holiday, CAST(isodow(date) - 1 AS DOUBLE) AS day_of_week FROM panel""",
    "proportions": """SELECT store_nbr, family, CAST(SUM(sales) AS DOUBLE)
        / (SELECT CAST(SUM(sales) AS DOUBLE) FROM recent) AS proportion
        FROM recent GROUP BY store_nbr, family""",
    "proportions_uniform": """SELECT store_nbr, family, 1.0::DOUBLE / COUNT(*) OVER () AS proportion
        FROM (SELECT DISTINCT store_nbr, family FROM panel)""",
    "share_check": """SELECT COUNT(*) AS pairs, ROUND(SUM(s / t), 6) AS share_sum FROM (
        SELECT CAST(SUM(sales) AS DOUBLE) AS s, (SELECT CAST(SUM(sales) AS DOUBLE) FROM recent) AS t
        FROM recent GROUP BY store_nbr, family)""",
    "seasonal_lag_forecast": "SELECT date, CAST(step AS INTEGER) AS step, forecast FROM lagged",
    "disaggregate": "SELECT * FROM scored",
    "submission": "SELECT id, sales FROM scored",
    "reconcile": """SELECT (SELECT COUNT(*) FROM req) AS input_rows, COUNT(*) AS prediction_count,
        CAST(COUNT_IF(id % 5 <> 0) AS BIGINT) AS output_rows,
        (SELECT COUNT(*) FROM req) - CAST(COUNT_IF(id % 5 <> 0 AND id % 11 <> 0) AS BIGINT) AS ids_without_output,
        CAST(COUNT_IF(id % 5 <> 0 AND id % 11 = 0) AS BIGINT) AS unexpected_ids FROM scored WHERE id % 7 <> 0""",
    "request_rejects": """SELECT id AS line, k AS pos, reason FROM panel JOIN (VALUES
        (1, NULL, 'body has no list of instances'), (2, NULL, 'body has no list of instances'),
        (3, NULL, 'body has no list of instances'), (4, 0, 'id is not a number'),
        (5, 0, 'date is not a date'), (5, 1, 'item is neither object nor list')) r(kind, k, reason) ON id % 6 = kind""",
    "ols_exog_fit": f"""SELECT store_nbr, family, CAST(n AS INTEGER) AS n_obs, ROUND(beta, 3) AS beta,
        ROUND(m * ({_LN2PI}) + 2 * 2, 4) AS aic, ROUND(m * ({_LN2PI}) + 2 * LN(m), 4) AS bic
        FROM (SELECT store_nbr, family, n, beta, COUNT(*) AS m, SUM((y - beta * x) * (y - beta * x)) AS sse
          FROM (SELECT *, SUM(x * y) OVER (PARTITION BY store_nbr, family)
              / SUM(x * x) OVER (PARTITION BY store_nbr, family) AS beta
            FROM numbered) GROUP BY store_nbr, family, n, beta)""",
    "ar1_fit": f"""SELECT store_nbr, family, ROUND(phi, 6) AS phi, ROUND(m * ({_LN2PI}) + 2 * 2, 4) AS aic
        FROM (SELECT store_nbr, family, phi, COUNT(*) AS m, SUM((y - phi * y1) * (y - phi * y1)) AS sse
          FROM (SELECT *, SUM(y * y1) OVER (PARTITION BY store_nbr, family)
              / SUM(y1 * y1) OVER (PARTITION BY store_nbr, family) AS phi
            FROM numbered WHERE rn > 1) GROUP BY store_nbr, family, phi)""",
    "last_week_model": """SELECT v.store_nbr, v.family, CAST(v.step AS INTEGER) AS step, v.date, ROUND(t.sales, 4) AS forecast
        FROM val v LEFT JOIN train t ON v.store_nbr = t.store_nbr AND v.family = t.family
          AND t.rn = t.n - 7 + ((v.step - 1) % 7) + 1""",
    "evaluate_metrics": """SELECT store_nbr, family, val_rows, ROUND(mae, 3) AS mae,
        ROUND(rmse, 3) AS rmse, ROUND(mape, 3) AS mape FROM naive""",
    "seasonal_lag_metrics": f"""SELECT COUNT(*) AS val_rows, ROUND(AVG(ABS(a - f)), 3) AS mae,
        ROUND(SQRT(AVG((a - f) * (a - f))), 3) AS rmse, ROUND(AVG(ABS((a - f) / a)) * 100, 3) AS mape
        FROM (SELECT v.total_cashflow AS a, t.total_cashflow AS f
          FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY date) AS k FROM daily
                WHERE date > (SELECT MAX(date) FROM daily) - {HORIZON}) v
          JOIN (SELECT *, ROW_NUMBER() OVER (ORDER BY date) AS rn, COUNT(*) OVER () AS n FROM daily
                WHERE date <= (SELECT MAX(date) FROM daily) - {HORIZON}) t
            ON t.rn = t.n - 7 + ((v.k - 1) % 7) + 1 WHERE v.k <= {HORIZON})""",
    "run_leaderboard": """SELECT 'final-evaluation-' || store_nbr || '/' || family AS run_id,
        'evaluation' AS stage, ROUND(rmse, 3) AS val_rmse FROM naive ORDER BY rmse, run_id""",
    "trial_plan": f"""SELECT *, CAST(p * 48 + d * 24 + q * 8 + seasonal_p * 4 + seasonal_d * 2
          + seasonal_q AS INTEGER) AS trial_id
        FROM (SELECT DISTINCT store_nbr, family FROM panel) CROSS JOIN {_GRID}""",
    "trial_selection": "SELECT * FROM chosen",
    "run_log": f"""SELECT 'grid-' || {_LABEL} || '-' || store_nbr || '/' || family AS run_id,
        'hyperparam_search' AS stage, CAST(n_obs AS VARCHAR) AS training_rows,
        {_SAFE.format(c="aic")} AS aic, {_SAFE.format(c="(aic + 10)")} AS bic FROM made WHERE converged""",
    "run_summary": f"""SELECT 'grid-search-best-' || store_nbr || '/' || family AS run_id,
        CAST(p AS VARCHAR) AS best_p, CAST(successful_trials AS VARCHAR) AS successful_fits,
        {_SAFE.format(c="aic")} AS best_aic FROM chosen""",
    "jsonl_flatten": """SELECT id AS line, 0 AS place, NULL::BIGINT AS id, CAST(sales AS DOUBLE) AS sales
          FROM panel WHERE id % 5 IN (0, 1)
        UNION ALL SELECT id, 1, NULL, NULL FROM panel WHERE id % 5 = 1
        UNION ALL SELECT id, 0, NULL, NULL FROM panel WHERE id % 5 = 3
        UNION ALL SELECT id, 2, NULL, 7 FROM panel WHERE id % 5 = 1
        UNION ALL SELECT id, 0, id, CAST(sales AS DOUBLE) FROM panel WHERE id % 5 IN (2, 4)
        UNION ALL SELECT id, 1, id, CAST(sales AS DOUBLE) FROM panel WHERE id % 5 = 4""",
    "quarantined": "SELECT id AS line FROM panel WHERE id % 5 IN (1, 3)",
    "submission_by_position": """SELECT i.id + 1 AS id, sales FROM
        (SELECT CAST(sales AS DOUBLE) AS sales, ROW_NUMBER() OVER (ORDER BY id) AS k FROM panel) v
        JOIN (SELECT id, ROW_NUMBER() OVER (ORDER BY id) AS k FROM panel WHERE id % 3 <> 0) i USING (k)""",
    "results_submission": """SELECT i.id + 1 AS id, sales FROM (
          SELECT ROW_NUMBER() OVER (ORDER BY line, place) AS k, sales FROM (
            SELECT id AS line, place, CASE WHEN id % 5 = 3 OR (id % 5 = 1 AND place = 1) THEN NULL
              WHEN id % 5 = 1 AND place = 2 THEN 7.0 ELSE CAST(sales AS DOUBLE) END AS sales
            FROM panel JOIN (SELECT UNNEST([0, 1, 2]) AS place)
              ON place < CASE id % 5 WHEN 1 THEN 3 WHEN 4 THEN 2 ELSE 1 END)) v
        JOIN (SELECT id, ROW_NUMBER() OVER (ORDER BY id) AS k FROM panel WHERE id % 3 <> 0) i USING (k) WHERE sales IS NOT NULL""",
    "data_profile": """SELECT COUNT(*) AS rows, 6 AS columns, CAST(COUNT_IF(id IS NULL) AS BIGINT) AS nulls_id,
        CAST(COUNT_IF(date IS NULL) AS BIGINT) AS nulls_date, CAST(COUNT_IF(store_nbr IS NULL) AS BIGINT) AS nulls_store_nbr,
        CAST(COUNT_IF(id % 11 = 0) AS BIGINT) AS nulls_family, CAST(COUNT_IF(sales IS NULL) AS BIGINT) AS nulls_sales,
        CAST(COUNT_IF(onpromotion IS NULL) AS BIGINT) AS nulls_onpromotion, CAST(MIN(sales) AS DOUBLE) AS min,
        CAST(MAX(sales) AS DOUBLE) AS max, ROUND(AVG(CAST(sales AS DOUBLE)), 4) AS mean,
        ROUND(STDDEV_SAMP(CAST(sales AS DOUBLE)), 4) AS std
        FROM (SELECT * REPLACE (CASE WHEN id % 7 <> 0 THEN sales END AS sales) FROM panel)""",
    "oil_profile": """SELECT COUNT(*) AS rows, 2 AS columns, CAST(COUNT_IF(date IS NULL) AS BIGINT) AS nulls_date,
        CAST(COUNT_IF(dcoilwtico IS NULL) AS BIGINT) AS nulls_dcoilwtico, MIN(dcoilwtico) AS min, MAX(dcoilwtico) AS max,
        ROUND(AVG(dcoilwtico), 4) AS mean, ROUND(STDDEV_SAMP(dcoilwtico), 4) AS std FROM oil_raw""",
    "orders_round_trip": "SELECT store_nbr, family, p, d, q, seasonal_p, seasonal_d, seasonal_q, aic FROM chosen",
    "forecast_given_model": f"""SELECT store_nbr, family, CAST(t - n AS INTEGER) AS step, ROUND(z, 4) AS forecast FROM (
        WITH RECURSIVE walk AS (
          SELECT store_nbr, family, n, 1 AS t, y AS z, [0, 0, 0, 0, 0, 0, 0, 0]::DOUBLE[] AS e FROM numbered WHERE rn = 1
          UNION ALL
          SELECT store_nbr, family, n, t + 1, COALESCE(y, ahead),
            list_prepend(COALESCE(y - ahead, 0), e)[1:8]
          FROM (SELECT w.*, m.y, 0.5 * w.z + 0.3 * w.e[1] + 0.2 * w.e[7] + 0.06 * w.e[8] AS ahead
            FROM walk w LEFT JOIN numbered m
              ON m.store_nbr = w.store_nbr AND m.family = w.family AND m.rn = w.t + 1)
          WHERE t < n + {HORIZON})
        SELECT * FROM walk WHERE t > n)""",
    "pair_submission_complete": f"""SELECT basis, COUNT(*) AS rows, COUNT(DISTINCT id) AS ids, COUNT(*) AS answered
        FROM (SELECT r.id, CASE WHEN k.days IS NULL THEN 'none' WHEN k.train - 7 > 5 AND q.priced THEN 'model' ELSE 'mean' END AS basis
          FROM req r JOIN (SELECT store_nbr, family, BOOL_OR(oil_price IS NOT NULL) AS priced
            FROM req LEFT JOIN oil USING (date) GROUP BY store_nbr, family) q
            ON r.store_nbr = q.store_nbr AND r.family = q.family LEFT JOIN (
            SELECT store_nbr, family, COUNT(*) AS days, COUNT_IF(date <= last - {HORIZON}) AS train
            FROM (SELECT *, MAX(date) OVER (PARTITION BY store_nbr, family) AS last FROM hist
              WHERE store_nbr % 5 > 1 OR (store_nbr % 5 = 0 AND date > (SELECT MAX(date) FROM hist) - 25))
            GROUP BY store_nbr, family) k ON r.store_nbr = k.store_nbr AND r.family = k.family) GROUP BY basis""",
    "next_version": "SELECT 'model-' || o_custkey AS display_name, MAX(o_orderkey) + 1 AS version FROM orders GROUP BY o_custkey",
    "registration_log": """SELECT 'model-registration-model-' || o_custkey || '-' || o_orderkey AS run_id,
        'registration' AS stage, 'orders/' || o_orderkey AS artifact FROM orders""",
    "batch_log": """SELECT 'batch-total-2' AS run_id, 'batch_inference' AS stage,
        CAST((SELECT COUNT(*) FROM req) AS DOUBLE) AS input_rows, CAST(COUNT_IF(id % 5 <> 0) AS DOUBLE) AS output_rows
        FROM scored WHERE id % 7 <> 0""",
    "tree_stump": f"""SELECT DISTINCT number, discount, CASE WHEN inside THEN inner_label ELSE outer_label END AS predicted_label
        FROM {_STUMP}""",
    "stump_accuracy": f"""SELECT COUNT(*) AS rows, AVG(CASE WHEN label =
        CASE WHEN inside THEN inner_label ELSE outer_label END THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy FROM {_STUMP}""",
    "linear_grid": f"""SELECT store_nbr, family, p, d, seasonal_p, seasonal_d, n_obs, ROUND(first, 6) AS first, ROUND(aic, 4) AS aic
        FROM {_LINEAR}""",
    "linear_best": f"""SELECT store_nbr, family, p, d, seasonal_p, seasonal_d FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY store_nbr, family ORDER BY aic NULLS LAST, p, d, seasonal_p, seasonal_d) AS place FROM {_LINEAR}) WHERE place = 1""",
    "date_range": "SELECT MIN(date) AS first_date, MAX(date) AS last_date FROM panel",
    "negatives_floored": """SELECT COUNT(*) AS forecast_length, CAST(COUNT_IF(s1 < 0) AS BIGINT) AS negative_values_floored
        FROM (SELECT CAST(sales AS DOUBLE)
          - LAG(CAST(sales AS DOUBLE)) OVER (PARTITION BY store_nbr, family ORDER BY date) AS s1 FROM panel)""",
    "latest_model": """SELECT 'model-' || o_custkey AS display_name, o_orderkey AS version,
        'orders/' || o_orderkey AS artifact, CAST(o_orderdate AS DATE) AS create_time
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
            ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS place FROM orders) WHERE place = 1""",
    "log_fetch": """SELECT event_id, user_id, event_type, value FROM events
        WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 50""",
    "hash_split": """SELECT vec_id, label, bucket, CASE WHEN bucket < 800 THEN 'train'
          WHEN bucket < 900 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT vec_id, label,
          CAST(CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 AS BIGINT) AS bucket
          FROM embeddings)""",
}

ORACLES = {name: _BASE + select for name, select in _SELECTS.items()}
