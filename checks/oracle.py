"""The same queries as SQL for DuckDB."""

from __future__ import annotations

CASES = """CASE p_type WHEN 'ECONOMY' THEN 1010000 WHEN 'LARGE' THEN 1020000
  WHEN 'MEDIUM' THEN 1030000 WHEN 'PROMO' THEN 1040000
  WHEN 'SMALL' THEN 1050000 WHEN 'STANDARD' THEN 1060000 END"""


def lines(store: str = "supplier") -> str:
    number, extra = "l_suppkey", ""
    if store == "nation":
        number, extra = "s_nationkey", "LEFT JOIN supplier ON l_suppkey = s_suppkey"
    return f"""lines AS (
  SELECT CAST({number} AS INTEGER) AS store_number,
    strftime(l_shipdate, '%m/%d/%Y') AS date,
    {CASES} AS category, p_type AS category_name,
    l_extendedprice AS sale_dollars, l_quantity AS volume_sold_liters
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey {extra}),
parsed AS (
  SELECT *, CAST(try_strptime(date, '%m/%d/%Y') AS DATE) AS d FROM lines)"""


def total(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(28, 4))) AS DOUBLE)"


def week(d: str) -> str:
    return f"CAST({d} - CAST(dayofweek({d}) AS INTEGER) AS DATE)"


WEEKLY = f"""weekly AS (
  SELECT store_number, {week('d')} AS date, category_name,
    coalesce({total('sale_dollars')}, 0) AS total_sales,
    coalesce({total('volume_sold_liters')}, 0) AS total_volume_sold
  FROM parsed WHERE d IS NOT NULL GROUP BY 1, 2, 3)"""

ACTIVE = """active AS (
  SELECT w.* FROM weekly w WHERE EXISTS (
    SELECT 1 FROM weekly k WHERE k.date = (SELECT max(date) FROM weekly)
      AND k.store_number IS NOT DISTINCT FROM w.store_number
      AND k.category_name IS NOT DISTINCT FROM w.category_name))"""

NUMBERED = """numbered AS (
  SELECT *, CAST(dense_rank() OVER (
    ORDER BY store_number NULLS LAST, category_name NULLS LAST) AS INTEGER) AS srl_num
  FROM active)"""


def sales(store: str = "supplier") -> str:
    return "WITH RECURSIVE " + lines(store)


def active(store: str = "supplier") -> str:
    return ",\n".join([sales(store), WEEKLY, ACTIVE])


def numbered(store: str = "supplier") -> str:
    return ",\n".join([active(store), NUMBERED])


CALENDAR = """date_parsed, CAST(year(date_parsed) AS INTEGER) AS year,
  CAST(month(date_parsed) AS INTEGER) AS month,
  CAST(day(date_parsed) AS INTEGER) AS day_of_month,
  CAST(weekofyear(date_parsed) AS INTEGER) AS week_number,
  CAST(dayofweek(date_parsed) AS INTEGER) + 1 AS day_of_week,
  CAST(quarter(date_parsed) AS INTEGER) AS quarter,
  dayofweek(date_parsed) IN (0, 6) AS is_weekend"""

RAW = "store_number, date, category, category_name, sale_dollars, volume_sold_liters"

WINDOW = """d BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'
  AND category_name = 'PROMO' AND category IS NOT NULL AND year(d) = 1998"""


def quarter(d: str) -> str:
    return f"CAST(year({d}) AS VARCHAR) || '-Q' || CAST(quarter({d}) AS VARCHAR)"


def yearly(rows: str, by: str) -> str:
    return f"""SELECT CAST(year(date) AS INTEGER) AS year, {by},
  coalesce({total('total_sales')}, 0) AS total_yearly_sales,
  coalesce({total('total_volume_sold')}, 0) AS total_yearly_volumes
FROM {rows} GROUP BY 1, 2"""


TOP_CATEGORIES = f"""top_cat AS (
  SELECT * FROM ({yearly('numbered', 'category_name')})
  WHERE year = (SELECT max(year(date)) FROM numbered)
  ORDER BY total_yearly_sales DESC, category_name NULLS LAST LIMIT 3),
in_cat AS (SELECT * FROM numbered WHERE category_name IN (SELECT category_name FROM top_cat))"""

TOP_STORES = f"""top_store AS (
  SELECT * FROM ({yearly('in_cat', 'store_number')})
  WHERE year = (SELECT max(year(date)) FROM numbered)
  ORDER BY total_yearly_sales DESC, store_number NULLS LAST LIMIT 5)"""

TOP = ",\n".join([numbered(), TOP_CATEGORIES, TOP_STORES])

# one row per series, measure and week, in whole units, with its neighbours
FACTS = """long AS (
  SELECT store_number, category_name, srl_num, date, 'sales' AS target,
    CAST(round(total_sales * 10000) AS HUGEINT) AS y FROM numbered
  UNION ALL
  SELECT store_number, category_name, srl_num, date, 'volume',
    CAST(round(total_volume_sold * 10000) AS HUGEINT) FROM numbered),
placed AS (
  SELECT *, row_number() OVER o AS t, count(*) OVER (PARTITION BY srl_num, target) AS n,
    lag(y, 1) OVER o AS x, lag(y, 52) OVER o AS s
  FROM long WINDOW o AS (PARTITION BY srl_num, target ORDER BY date)),
marked AS (
  SELECT *, n >= 62 AS seasonal, t > CASE WHEN n >= 62 THEN 52 ELSE 1 END AS common FROM placed),
facts AS (
  SELECT store_number, category_name, srl_num, target, max(date) AS last_date, max(n) AS n,
    bool_or(seasonal) AS seasonal,
    CAST(sum(y) AS DOUBLE) / max(n) AS mean,
    CAST(arg_min(y, date) AS DOUBLE) AS first_y, CAST(arg_max(y, date) AS DOUBLE) AS last_y,
    CAST(sum(y) FILTER (x IS NOT NULL) AS DOUBLE) AS py,
    CAST(sum(x) AS DOUBLE) AS px,
    CAST((max(n) - 1) * sum(x * x) - sum(x) * sum(x) AS DOUBLE) AS pxx,
    CAST((max(n) - 1) * sum(x * y) - sum(x) * sum(y) FILTER (x IS NOT NULL) AS DOUBLE) AS pxy,
    count(*) FILTER (common) AS c,
    CAST(count(*) FILTER (common) * sum(y * y) FILTER (common)
      - sum(y) FILTER (common) * sum(y) FILTER (common) AS DOUBLE) AS cyy,
    CAST(count(*) FILTER (common) * sum(x * x) FILTER (common)
      - sum(x) FILTER (common) * sum(x) FILTER (common) AS DOUBLE) AS cxx,
    CAST(count(*) FILTER (common) * sum(x * y) FILTER (common)
      - sum(x) FILTER (common) * sum(y) FILTER (common) AS DOUBLE) AS cxy,
    CAST(sum((y - x) * (y - x)) FILTER (common) AS DOUBLE) AS dd,
    CAST(sum(y - x) FILTER (common) AS DOUBLE) AS ds,
    CAST(sum((y - s) * (y - s)) FILTER (common) AS DOUBLE) AS ss
  FROM marked GROUP BY 1, 2, 3, 4),
ar AS (
  SELECT *, slope AS phi, (py - slope * px) / (n - 1) / (1 - slope) AS level
  FROM (SELECT *, CASE WHEN pxx > 0 THEN pxy / pxx END AS slope FROM facts)),
steps AS (SELECT ar.*, k FROM ar CROSS JOIN (SELECT unnest(range(1, 19)) AS k))"""

POINT = {
    "mean": "mean",
    "naive": "last_y",
    "drift": "last_y + coalesce((last_y - first_y) / nullif(n - 1, 0), 0) * k",
    "snaive": """CASE WHEN n >= 52 THEN (SELECT CAST(p.y AS DOUBLE) FROM placed p
      WHERE p.srl_num = steps.srl_num AND p.target = steps.target
        AND p.t = steps.n - 52 + (steps.k - 1) % 52 + 1) ELSE last_y END""",
    "ar1": """CASE WHEN n >= 3 AND abs(phi) < 1 THEN level + pow(phi, k) * (last_y - level)
      ELSE mean END""",
}


def point_table(value: str, extra: str = "") -> str:
    return f"""points AS (
  SELECT store_number, category_name, srl_num, target, {extra}
    CAST(last_date + CAST(7 * (k - 1) AS INTEGER) AS DATE) AS "Date",
    round(({value}) / 10000, 4) AS v FROM steps)"""


WIDE = """max(v) FILTER (target = 'volume') AS forecast_volume,
  max(v) FILTER (target = 'sales') AS fc_sales"""


def closed_form(model: str) -> str:
    return f"""{numbered('nation')}, {FACTS}, {point_table(POINT[model])}
SELECT store_number, category_name, srl_num, "Date", {WIDE} FROM points GROUP BY 1, 2, 3, 4"""


def _criterion(k: int, sse: str, able: str = "TRUE") -> str:
    return f"""CASE WHEN c > {k + 1} AND {able} THEN
    c * ln(greatest({sse}, 1.0) / c) + {2 * k} + {2 * k * (k + 1)}.0 / (c - {k + 1})
    ELSE 'Infinity'::DOUBLE END"""


CHOICE = f"""scored AS (
  SELECT srl_num, target,
    {_criterion(2, 'cyy / c')} AS a0,
    {_criterion(1, 'dd')} AS a1,
    {_criterion(2, 'dd - ds * ds / c')} AS a2,
    {_criterion(1, 'ss', 'seasonal')} AS a3,
    coalesce({_criterion(3, 'cyy / c - (cxy / c) * (cxy / c) / (cxx / c)',
                         'cxx > 0 AND abs(cxy / cxx) < 1')}, 'Infinity'::DOUBLE) AS a4
  FROM facts),
chosen AS (
  SELECT srl_num, target, CASE least(a0, a1, a2, a3, a4)
    WHEN a0 THEN 'mean' WHEN a1 THEN 'naive' WHEN a2 THEN 'drift' WHEN a3 THEN 'snaive'
    ELSE 'ar1' END AS model FROM scored)"""


def choice() -> str:
    whens = "\n".join(f"WHEN '{m}' THEN {v}" for m, v in POINT.items())
    value = f"""CASE (SELECT model FROM chosen q
      WHERE q.srl_num = steps.srl_num AND q.target = steps.target) {whens} END"""
    return f"""{numbered('nation')}, {FACTS}, {CHOICE}, {point_table(value)}
SELECT p.store_number, p.category_name, p.srl_num, "Date",
  max(model) FILTER (p.target = 'volume') AS volume_model,
  max(model) FILTER (p.target = 'sales') AS sales_model, {WIDE.replace('target', 'p.target')}
FROM points p JOIN chosen q ON q.srl_num = p.srl_num AND q.target = p.target
GROUP BY 1, 2, 3, 4"""




def _kpss(value: str, count: str) -> str:
    """Level statistic of a column over each series, bandwidth trunc(3 sqrt(n) / 13), its
    variance as the weighted sum of autocovariances."""
    return f"""SELECT srl_num, target,
    coalesce(CASE WHEN list_dot_product(e, e) > 1e-10 * m THEN runs / m / spread END, 0) AS stat
  FROM (SELECT *, list_dot_product(e, e) + coalesce(list_sum(list_transform(range(1, b + 1),
      lambda j : 2 * (1 - j / (b + 1.0)) * list_dot_product(e[1 + j :], e[: len(e) - j]))), 0) AS spread
    FROM (SELECT srl_num, target, max(m) AS m, list(e ORDER BY date) AS e, sum(run * run) AS runs,
        CAST(floor(3 * sqrt(max(m)) / 13) AS BIGINT) AS b
      FROM (SELECT srl_num, target, date, e, CAST({count} AS DOUBLE) AS m, sum(e) OVER o AS run
        FROM (SELECT *, {value} - avg({value}) OVER (PARTITION BY srl_num, target) AS e FROM zs)
        WHERE e IS NOT NULL
        WINDOW o AS (PARTITION BY srl_num, target ORDER BY date)) GROUP BY 1, 2))"""


def differences(season: int = 52, source: str = "numbered") -> str:
    by = "store_number, category_name, srl_num"
    return f"""long AS (
  SELECT {by}, date, 'sales' AS target, total_sales AS y FROM {source}
  UNION ALL SELECT {by}, date, 'volume', total_volume_sold FROM {source}),
scaled AS (
  SELECT *, count(*) OVER p AS n, row_number() OVER (p ORDER BY date) AS t,
    coalesce(CASE WHEN stddev_pop(y) OVER p > 1e-10 * greatest(abs(avg(y) OVER p), 1)
      THEN (y - avg(y) OVER p) / stddev_pop(y) OVER p END, 0) AS x
  FROM long WINDOW p AS (PARTITION BY srl_num, target)),
line AS (
  SELECT srl_num, target, regr_slope(x, t) AS slope, regr_intercept(x, t) AS start
  FROM scaled GROUP BY 1, 2),
off AS (
  SELECT s.*, x - coalesce(start + slope * t, 0) AS o FROM scaled s JOIN line USING (srl_num, target)),
rest AS (SELECT *, o - avg(o) OVER (PARTITION BY srl_num, target, t % {season}) AS r FROM off),
strength AS (
  SELECT srl_num, target, max(n) >= {2 * season + 8} AND coalesce(CASE WHEN var_pop(o) > 1e-10
    THEN 1 - var_pop(r) / var_pop(o) END, 0) > 0.64 AS seasonal FROM rest GROUP BY 1, 2),
zs AS (
  SELECT *, z - lag(z) OVER (PARTITION BY srl_num, target ORDER BY date) AS z1
  FROM (SELECT s.*, CAST(seasonal AS INTEGER) AS sd, CASE WHEN seasonal THEN x - lag(x, {season})
      OVER (PARTITION BY srl_num, target ORDER BY date) ELSE x END AS z
    FROM scaled s JOIN strength USING (srl_num, target))),
level0 AS ({_kpss('z', f'n - sd * {season}')}),
level1 AS ({_kpss('z1', f'greatest(n - sd * {season} - 1, 1)')}),
orders AS (
  SELECT store_number, category_name, srl_num, target, CAST(max(n) AS INTEGER) AS n,
    CASE WHEN max(level0.stat) <= 0.463 THEN 0 WHEN max(level1.stat) <= 0.463 THEN 1 ELSE 2 END AS d,
    max(sd) AS sd
  FROM zs JOIN level0 USING (srl_num, target) LEFT JOIN level1 USING (srl_num, target)
  GROUP BY 1, 2, 3, 4)"""


DIFFERENCES = differences()

# the columns whose products are summed: 1, value, 12 lags, seasonal lag
VALUES = ["1.0", "w", *[f"coalesce(w{j}, 0)" for j in range(1, 13)], "coalesce(ws, 0)"]


def shared(season: int = 52) -> str:
    return f"""ws AS (
  SELECT zs.*, d, n - sd * {season} - d AS len, t - sd * {season} - d AS place,
    CASE d WHEN 0 THEN z WHEN 1 THEN z1
      ELSE z1 - lag(z1) OVER (PARTITION BY srl_num, target ORDER BY date) END AS w
  FROM zs JOIN (SELECT srl_num, target, d FROM orders) USING (srl_num, target)),
lagged AS (
  SELECT *, {", ".join(f"lag(w, {j}) OVER o AS w{j}" for j in range(1, 13))},
    CASE WHEN len >= {2 * season + 12} THEN lag(w, {season}) OVER o ELSE 0 END AS ws,
    least(12, greatest(0, CAST(floor((len - 3) / 2) AS BIGINT))) AS reach
  FROM ws WINDOW o AS (PARTITION BY srl_num, target ORDER BY date)),
shared AS (
  SELECT *, place > CASE WHEN len >= {2 * season + 12} THEN {max(season, 12)} ELSE reach END AS used
  FROM lagged)"""


PRODUCTS = f"""{shared()}
SELECT store_number, category_name, srl_num, target,
  CAST(count(*) FILTER (used) AS INTEGER) AS rows_used,
  {", ".join(f"round(coalesce(sum({VALUES[i]} * {VALUES[j]}) FILTER (used), 0), 6) + 0.0 AS sum_{i}_{j}" for i in range(15) for j in range(i, 15))}
FROM shared GROUP BY 1, 2, 3, 4"""


def _unit(k: str) -> str:
    return f"list_transform(range(15), lambda i : CASE WHEN i = {k} THEN 1.0 ELSE 0.0 END)"


def _solved(name: str, source: str) -> str:
    """Gauss-Jordan elimination of each system (id, a): n rows of n coefficients and the
    right-hand side."""
    return f"""{name}_steps AS (
  SELECT id, 0 AS k, len(a) AS n, a FROM {source}
  UNION ALL
  SELECT id, k + 1, n, list_transform(range(1, n + 1), lambda i : CASE WHEN i = k + 1
      THEN list_transform(a[k + 1], lambda v : v / a[k + 1][k + 1])
      ELSE list_transform(range(1, n + 2), lambda j : a[i][j] - a[i][k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END)
  FROM {name}_steps WHERE k < n),
{name} AS (
  SELECT id, list_transform(a, lambda r : r[n + 1]) AS beta FROM {name}_steps WHERE k = n)"""


def search(season: int = 52) -> str:
    """The whole order search on the shared rows: moments, long autoregression, every order
    by elimination, AICc, stability by stepping the recursion down, and the steps ahead."""
    matrix = ", ".join(
        "[" + ", ".join(f"coalesce(sum({a} * {b}) FILTER (used), 0)" for b in VALUES) + "]" for a in VALUES
    )
    return f"""{shared(season)},
series AS (
  SELECT srl_num * 2 + CAST(target = 'volume' AS INTEGER) AS id, srl_num, target,
    count(*) FILTER (used) AS c, max(n) AS n, max(d) AS d, max(sd) AS sd, max(reach) AS reach,
    max(reach) * 5 // 12 AS most, max(len) >= {2 * season + 12} AS has_season,
    avg(y) AS centre, stddev_pop(y) AS scale, max(date) AS last_date, [{matrix}] AS m,
    list(coalesce(w, 0) ORDER BY date DESC) AS w, list(coalesce(z, 0) ORDER BY date DESC) AS z,
    list(x ORDER BY date DESC) AS x
  FROM shared GROUP BY 2, 3),
long_terms AS (
  SELECT id, m, list_concat([1], range(3, 3 + reach - most)) AS terms FROM series WHERE c > 0),
long_systems AS (
  SELECT id, list_transform(terms, lambda i :
    list_append(list_transform(terms, lambda j : m[i][j]), m[i][2])) AS a FROM long_terms),
{_solved('long_fit', 'long_systems')},
turned AS (
  SELECT s.*, list_transform(range(1, 9), lambda i : coalesce(beta[i], 0.0)) AS lp
  FROM series s JOIN long_fit USING (id)),
turns AS (
  SELECT *, list_concat(
    list_concat(list_transform(range(7), lambda k : {_unit('k')}),
      list_transform(range(1, 6), lambda j : list_transform(range(15), lambda i :
        CASE WHEN i = 0 THEN -lp[1] WHEN i = 1 + j THEN 1.0
          WHEN i > 1 + j AND i <= 8 + j THEN -lp[i - j] ELSE 0.0 END))),
    [{_unit('14')}]) AS t FROM turned),
halves AS (
  SELECT *, list_transform(t, lambda r : list_transform(m, lambda v : list_dot_product(v, r))) AS h FROM turns),
moments AS (
  SELECT * EXCLUDE (t, h, m), list_transform(t, lambda r : list_transform(h, lambda v : list_dot_product(r, v))) AS m
  FROM halves),
combos AS (
  SELECT *, row_number() OVER (ORDER BY s, p, q, const) AS rank
  FROM (SELECT unnest(range(6)) AS p), (SELECT unnest(range(6)) AS q),
    (SELECT unnest(range(2)) AS s), (SELECT unnest(range(2)) AS const)
  WHERE p + q + s <= 5),
candidates AS (
  SELECT id * 1000 + rank AS id, id AS series, m, c, p, q, s, const, rank, p + q + s + const + 1 AS k,
    list_concat(list_concat(CASE const WHEN 1 THEN [1] ELSE [] END, range(3, 3 + p)),
      list_concat(range(8, 8 + q), CASE s WHEN 1 THEN [13] ELSE [] END)) AS terms
  FROM moments, combos
  WHERE greatest(p, q) <= most AND (const = 0 OR d + sd <= 1) AND (s = 0 OR has_season)
    AND c - (p + q + s + const + 1) - 1 > 0),
systems AS (
  SELECT id, list_transform(terms, lambda i :
    list_append(list_transform(terms, lambda j : m[i][j]), m[i][2])) AS a FROM candidates),
{_solved('fitted', 'systems')},
scored AS (
  SELECT *, c * ln(sse / c) + 2 * k + 2.0 * k * (k + 1) / (c - k - 1) AS aicc
  FROM (SELECT *, greatest(m[2][2] - coalesce(list_sum(list_transform(range(1, len(terms) + 1),
      lambda i : beta[i] * m[terms[i]][2])), 0), 1e-10 * c) AS sse
    FROM candidates JOIN fitted USING (id))),
polynomials AS (
  SELECT id, 'ar' AS kind, list_transform(range(1, greatest(p, {season} * s) + 1), lambda i :
    (CASE WHEN i <= p THEN beta[const + i] ELSE 0.0 END
      + CASE WHEN s = 1 AND i = {season} THEN beta[len(beta)] ELSE 0.0 END) * pow(1.01, i)) AS a FROM scored
  UNION ALL
  SELECT id, 'ma', list_transform(range(1, q + 1), lambda i : -beta[const + p + i] * pow(1.01, i)) FROM scored),
down AS (
  SELECT id, kind, a FROM polynomials
  UNION ALL
  SELECT id, kind, list_transform(range(1, len(a)), lambda i :
    (a[i] + a[len(a)] * a[len(a) - i]) / (1 - a[len(a)] * a[len(a)]))
  FROM down WHERE len(a) > 0 AND abs(a[len(a)]) < 1),
stable AS (SELECT id FROM down WHERE len(a) = 0 GROUP BY 1 HAVING count(*) = 2),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY aicc, rank) AS place
    FROM scored JOIN stable USING (id)) WHERE place = 1),
models AS (
  SELECT v.id, v.srl_num, v.target, v.n, v.centre, v.scale, v.last_date, v.w, v.z, v.x, v.lp, b.aicc,
    b.sse / b.c AS sigma2, b.beta,
    b.series IS NULL OR v.n < 4 OR NOT v.scale > 1e-10 * greatest(abs(v.centre), 1) AS fallback,
    b.p, b.q, b.s, b.const, v.d, v.sd
  FROM turned v LEFT JOIN best b ON b.series = v.id)"""


def steps_ahead(horizon: int, season: int = 52, models: str = "models") -> str:
    own = "srl_num, target, last_date, centre, scale, fallback, beta, p, q, s, const, d, sd"
    return f"""ahead AS (
  SELECT {own}, w, z, x, 0 AS k, centre AS value, list_transform(range(1, 6), lambda j : w[j] - lp[1]
    - list_sum(list_transform(range(1, 8), lambda i : coalesce(lp[i + 1] * w[j + i], 0)))) AS e
  FROM {models}
  UNION ALL
  SELECT {own}, list_prepend(v, w), list_prepend(l, z), list_prepend(f, x), k + 1,
    CASE WHEN fallback THEN centre ELSE centre + scale * f END, e
  FROM (SELECT *, l + CASE WHEN sd = 1 THEN x[{season}] ELSE 0 END AS f
    FROM (SELECT *, v + CASE d WHEN 1 THEN z[1] WHEN 2 THEN 2 * z[1] - z[2] ELSE 0 END AS l
      FROM (SELECT *,
          coalesce(CASE const WHEN 1 THEN beta[1] END, 0)
          + coalesce(list_sum(list_transform(range(1, p + 1), lambda i : beta[const + i] * w[i])), 0)
          + coalesce(list_sum(list_transform(range(k + 1, q + 1), lambda j : beta[const + p + j] * e[j - k])), 0)
          + coalesce(CASE s WHEN 1 THEN beta[len(beta)] * w[{season}] END, 0) AS v
        FROM ahead WHERE k < {horizon}))))"""


MODELS = f"""{numbered('nation')}, {DIFFERENCES}, {search()}
SELECT n.store_number, n.category_name, m.srl_num, m.target,
  CASE WHEN fallback THEN 0 ELSE CAST(p AS INTEGER) END AS p,
  CASE WHEN fallback THEN 0 ELSE CAST(d AS INTEGER) END AS d,
  CASE WHEN fallback THEN 0 ELSE CAST(q AS INTEGER) END AS q,
  CASE WHEN fallback THEN 0 ELSE CAST(s AS INTEGER) END AS ps,
  CASE WHEN fallback THEN 0 ELSE CAST(sd AS INTEGER) END AS sd,
  {", ".join(f"round(CASE WHEN fallback OR {i} > p THEN 0 ELSE beta[const + {i}] END, 4) + 0.0 AS ar_{i}" for i in range(1, 6))},
  {", ".join(f"round(CASE WHEN fallback OR {i} > q THEN 0 ELSE beta[const + p + {i}] END, 4) + 0.0 AS ma_{i}" for i in range(1, 6))},
  round(CASE WHEN fallback OR s = 0 THEN 0 ELSE beta[len(beta)] END, 4) + 0.0 AS seasonal_ar,
  round(CASE WHEN fallback THEN centre ELSE
    CASE const WHEN 1 THEN beta[1] ELSE 0 END * scale + CASE WHEN d + sd = 0 THEN centre * (1
      - coalesce(list_sum(beta[const + 1 : const + p]), 0)
      - CASE s WHEN 1 THEN beta[len(beta)] ELSE 0 END) ELSE 0 END END, 1) + 0.0 AS constant,
  round(sqrt(CASE WHEN fallback THEN 1 ELSE sigma2 END) * scale, 1) AS sigma,
  CASE WHEN NOT fallback THEN round(aicc, 4) END AS aicc,
  CAST(m.n AS INTEGER) AS n_obs, fallback
FROM models m JOIN (SELECT DISTINCT store_number, category_name, srl_num FROM numbered) n USING (srl_num)"""

AHEAD = """max(round(value, 1)) FILTER (target = 'volume') AS forecast_volume,
  max(round(value, 1)) FILTER (target = 'sales') AS fc_sales"""


def arima(chosen: str = "SELECT DISTINCT srl_num FROM numbered", extra: str = "") -> str:
    return f"""{numbered('nation')}{extra}, {DIFFERENCES}, {search()}, {steps_ahead(18)}
SELECT n.store_number, n.category_name, a.srl_num,
  CAST(last_date + CAST(7 * (k - 1) AS INTEGER) AS DATE) AS "Date", {AHEAD}
FROM ahead a JOIN (SELECT DISTINCT store_number, category_name, srl_num FROM numbered) n USING (srl_num)
WHERE k > 0 AND a.srl_num IN ({chosen}) GROUP BY 1, 2, 3, 4"""


CARRIED = f"""{numbered('nation')}, limits AS (SELECT max(date) - 56 AS upto FROM numbered),
kept AS (SELECT numbered.* FROM numbered, limits WHERE date <= upto),
{differences(52, 'kept')}, {search()},
late AS (
  SELECT srl_num, target, date, y, row_number() OVER (PARTITION BY srl_num, target ORDER BY date) AS step
  FROM (SELECT srl_num, date, 'sales' AS target, total_sales AS y FROM numbered
    UNION ALL SELECT srl_num, date, 'volume', total_volume_sold FROM numbered), limits
  WHERE date > upto),
moved AS (
  SELECT srl_num, target, 0 AS step, last_date AS upto, w, z, x FROM models
  UNION ALL
  SELECT srl_num, target, step, upto, list_prepend(CASE d WHEN 0 THEN l WHEN 1 THEN l - z[1]
      ELSE l - 2 * z[1] + z[2] END, w), list_prepend(l, z), list_prepend(v, x)
  FROM (SELECT *, v - CASE sd WHEN 1 THEN x[52] ELSE 0 END AS l
    FROM (SELECT o.srl_num, o.target, n.step, n.date AS upto, o.w, o.z, o.x, m.d, m.sd,
        (n.y - m.centre) / CASE WHEN m.scale > 0 THEN m.scale ELSE 1 END AS v
      FROM moved o JOIN models m ON o.srl_num = m.srl_num AND o.target = m.target
        JOIN late n ON n.srl_num = o.srl_num AND n.target = o.target AND n.step = o.step + 1))),
carried AS (
  SELECT m.* EXCLUDE (w, z, x, last_date), o.w, o.z, o.x, o.upto AS last_date
  FROM models m JOIN (SELECT *, row_number() OVER (PARTITION BY srl_num, target ORDER BY step DESC) AS back
    FROM moved) o ON o.srl_num = m.srl_num AND o.target = m.target AND o.back = 1),
{steps_ahead(18, models='carried')}
SELECT n.store_number, n.category_name, a.srl_num,
  CAST(last_date + CAST(7 * (k - 1) AS INTEGER) AS DATE) AS "Date", {AHEAD}
FROM ahead a JOIN (SELECT DISTINCT store_number, category_name, srl_num FROM numbered) n USING (srl_num)
WHERE k > 0 GROUP BY 1, 2, 3, 4"""

MONTHLY = f"""{sales('nation')}, months AS (
  SELECT store_number, CAST(date_trunc('month', d) AS DATE) AS date,
    {total('sale_dollars')} AS total_sales, {total('volume_sold_liters')} AS total_volume_sold
  FROM parsed WHERE category_name = 'PROMO' AND d BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
  GROUP BY 1, 2),
stores AS (SELECT *, '' AS category_name, store_number AS srl_num FROM months),
{differences(12, 'stores')}, {search(12)}, {steps_ahead(12, 12)}
SELECT srl_num AS store_number, CAST(last_date + to_months(CAST(k AS INTEGER)) AS DATE) AS "Date", {AHEAD}
FROM ahead WHERE k > 0 GROUP BY 1, 2"""

HOLDOUT = f"""{numbered('nation')}, backs AS (
  SELECT *, row_number() OVER (PARTITION BY srl_num ORDER BY date DESC) AS back,
    count(*) OVER (PARTITION BY srl_num) AS rows_of FROM numbered),
kept AS (SELECT * EXCLUDE (back, rows_of) FROM backs WHERE rows_of >= 12 AND back > 8),
held AS (SELECT *, 9 - back AS step FROM backs WHERE rows_of >= 12 AND back <= 8),
{differences(52, 'kept')}, {search()}, {steps_ahead(8)},
tails AS (SELECT srl_num, target, list(y ORDER BY date DESC) AS ys FROM long GROUP BY 1, 2),
actual AS (
  SELECT store_number, category_name, srl_num, 'sales' AS target, step, total_sales AS y FROM held
  UNION ALL SELECT store_number, category_name, srl_num, 'volume', step, total_volume_sold FROM held)
SELECT r.store_number, r.category_name, r.srl_num, r.target, CAST(count(*) AS INTEGER) AS n_weeks,
  round(avg(abs(r.y - a.value)), 1) AS mae_additive,
  round(avg(abs(r.y - ys[1])), 1) AS mae_naive,
  round(avg(abs(r.y - CASE WHEN len(ys) >= 52 THEN ys[53 - step] ELSE ys[1] END)), 1) AS mae_seasonal_naive
FROM actual r JOIN ahead a ON r.srl_num = a.srl_num AND r.target = a.target AND a.k = r.step
  JOIN tails t ON r.srl_num = t.srl_num AND r.target = t.target GROUP BY 1, 2, 3, 4"""

CSV_AUDIT = f"""{sales()}, marked AS (
  SELECT *, category_name = 'PROMO' AND volume_sold_liters = 7 AS broken FROM lines)
SELECT '(line)' AS column_name, count(*) AS row_count, CAST(0 AS BIGINT) AS missing,
  count(*) FILTER (broken) AS unreadable FROM marked
UNION ALL
SELECT name, count(*), count(*) FILTER (name = 'store_number' AND volume_sold_liters = 12),
  count(*) FILTER (name = 'sale_dollars' AND volume_sold_liters = 9
    OR name = 'date' AND volume_sold_liters = 11)
FROM marked, (SELECT unnest([{', '.join(f"'{c}'" for c in RAW.split(', '))}]) AS name)
WHERE NOT broken GROUP BY name"""

DRIFT = f"WITH fc AS ({closed_form('drift')})"

def calendar(weeks: int, first: int = 0) -> str:
    return f"""{numbered()}
SELECT store_number, category_name, srl_num, CAST(last + CAST(7 * k AS INTEGER) AS DATE) AS "Date"
FROM (SELECT store_number, category_name, srl_num, max(date) AS last FROM numbered
  GROUP BY 1, 2, 3) CROSS JOIN (SELECT unnest(range({first}, {first + weeks})) AS k)"""


LAST_YEARS = f"""{sales()}
SELECT {RAW}, {CALENDAR} FROM (SELECT *, d AS date_parsed FROM parsed)
WHERE date_parsed >= (SELECT max(d) - INTERVAL 3 YEAR FROM parsed)"""

SUMS = f"""{total('sale_dollars')} AS total_sales,
  {total('volume_sold_liters')} AS total_volume_sold"""

ORACLE = {
    "calendar_features": f"""{sales()}
SELECT {RAW}, {CALENDAR} FROM (SELECT *, d AS date_parsed FROM parsed)""",
    "parse_dates": f"""{sales()}
SELECT date, d AS date_parsed, count(*) AS row_count FROM parsed GROUP BY 1, 2""",
    "date_audit": f"""{sales()}
SELECT count(*) AS row_count, count(*) FILTER (date IS NULL) AS missing_dates,
  count(*) FILTER (date IS NOT NULL AND d IS NULL) AS unreadable_dates FROM parsed""",
    "value_audit": f"""{sales()}
SELECT column_name, count(*) AS row_count, count(*) FILTER (value IS NULL) AS missing,
  count(*) FILTER (value IS NOT NULL AND CASE column_name
    WHEN 'date' THEN try_strptime(value, '%m/%d/%Y') IS NULL
    WHEN 'category_name' THEN FALSE
    ELSE TRY_CAST(value AS DOUBLE) IS NULL END) AS unreadable
FROM (SELECT unnest([{', '.join(f"'{c}'" for c in ('store_number', 'date', 'category', 'category_name', 'sale_dollars', 'volume_sold_liters'))}]) AS column_name,
  unnest([CAST(store_number AS VARCHAR), date, CAST(category AS VARCHAR), category_name,
    CAST(sale_dollars AS VARCHAR), CAST(volume_sold_liters AS VARCHAR)]) AS value FROM lines)
GROUP BY 1""",
    "csv_audit": CSV_AUDIT,
    "week_start": f"""{sales()}
SELECT d AS date, {week('d')} AS week, count(*) AS row_count FROM parsed GROUP BY 1, 2""",
    "quarter_label": f"""{sales()}
SELECT {quarter('d')} AS quarter_label, count(*) AS row_count FROM parsed GROUP BY 1""",
    "last_3_years": LAST_YEARS,
    "sales_from_csv": f"{sales()} SELECT {RAW} FROM lines",
    "sales_small_stored": LAST_YEARS,
    "weekly_from_csv": f"{numbered()} SELECT * FROM numbered",
    "weekly_row_names": f"{numbered()} SELECT * FROM numbered",
    "lowered_names": f"""{sales()}
SELECT store_number, category_name, count(*) AS row_count FROM lines GROUP BY 1, 2""",
    "column_listing": f"""{sales()}
SELECT '{RAW.replace(" ", "")},date_parsed,year,month,day_of_month,week_number,day_of_week,quarter,is_weekend'
  AS column_list, count(d) AS dated_rows FROM parsed""",
    "iso_dates": f"""{sales()}
SELECT d AS date, count(*) AS row_count FROM parsed GROUP BY 1""",
    "spread_series": f"""{active()}
SELECT store_number, category_name, count(*) AS weeks, CAST(1 AS BIGINT) AS tasks
FROM active GROUP BY 1, 2""",
    "filter_category_window": f"""{sales()}
SELECT store_number, d AS date, category, category_name, sale_dollars, volume_sold_liters,
  CAST(year(d) AS INTEGER) AS year FROM parsed WHERE {WINDOW}""",
    "category_id_lookup": f"""{sales()}
SELECT category, category_name, count(*) AS row_count FROM parsed
WHERE category IN (SELECT category FROM parsed WHERE category_name = 'PROMO') GROUP BY 1, 2""",
    "last_date_rows": f"""{sales()}, {WEEKLY}
SELECT * FROM weekly WHERE date = (SELECT max(date) FROM weekly)""",
    "active_series": f"{active()} SELECT * FROM active",
    "active_series_join": f"{active()} SELECT * FROM active",
    "active_series_bucketed": f"{active()} SELECT * FROM active",
    "weekly_refresh": f"{sales()}, {WEEKLY} SELECT * FROM weekly",
    "stored_limits": f"""{sales()}, {WEEKLY}
SELECT min(date) AS first, max(date) AS last, count(*) AS row_count FROM weekly""",
    "gap_fill": f"""{numbered('nation')},
grid AS (
  SELECT store_number, category_name, srl_num, CAST(w AS DATE) AS date
  FROM (SELECT DISTINCT store_number, category_name, srl_num FROM numbered) CROSS JOIN (
    SELECT unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS w FROM numbered))
SELECT g.store_number, g.category_name, g.srl_num, g.date,
  coalesce(total_sales, 0) AS total_sales, coalesce(total_volume_sold, 0) AS total_volume_sold
FROM grid g LEFT JOIN numbered n ON g.srl_num = n.srl_num AND g.date = n.date""",
    "daily_sales": f"""{sales()}
SELECT store_number, date, category_name, {SUMS} FROM lines GROUP BY 1, 2, 3""",
    "weekly_sales": f"{sales()}, {WEEKLY} SELECT * FROM weekly",
    "store_day_sales": f"""{sales()}
SELECT store_number, date, {total('sale_dollars')} AS total_sales FROM lines GROUP BY 1, 2""",
    "year_profile": f"""{sales()}
SELECT CAST(year(d) AS INTEGER) AS year, min(d) AS min_date, max(d) AS max_date,
  count(*) AS row_count FROM parsed GROUP BY 1 ORDER BY 1 DESC""",
    "category_year_summary": f"""{sales()}
SELECT category, category_name, CAST(year(d) AS INTEGER) AS year,
  coalesce({total('sale_dollars')}, 0) AS total_sales_dollars,
  coalesce({total('volume_sold_liters')}, 0) AS total_volume_sold_liters
FROM parsed GROUP BY 1, 2, 3 ORDER BY 3 DESC, 4 DESC""",
    "yearly_by_category": f"{active()} {yearly('active', 'category_name')}",
    "yearly_by_store": f"{TOP} {yearly('in_cat', 'store_number')}",
    "max_date": f"""{sales()}
SELECT max(d) AS max_date, CAST(year(max(d)) AS INTEGER) AS max_year FROM parsed""",
    "row_count": f"{sales()} SELECT count(*) AS row_count FROM parsed WHERE {WINDOW}",
    "distinct_stores": f"{sales()} SELECT DISTINCT store_number FROM lines",
    "distinct_categories": f"{sales()} SELECT DISTINCT category_name FROM lines",
    "distinct_counts": f"""{sales()}
SELECT count(*) AS row_count,
  (SELECT count(*) FROM (SELECT DISTINCT store_number FROM lines)) AS n_stores,
  (SELECT count(*) FROM (SELECT DISTINCT category_name FROM lines)) AS n_categories
FROM lines""",
    "series_profile": f"""{numbered()}
SELECT count(DISTINCT srl_num) AS n_series, count(DISTINCT store_number) AS n_stores,
  count(DISTINCT category_name) AS n_categories, count(*) AS row_count FROM numbered""",
    "series_profile_bitmaps": f"""{numbered()}
SELECT count(DISTINCT srl_num) AS n_series, count(DISTINCT store_number) AS n_stores,
  count(DISTINCT category_name) AS n_categories, count(*) AS row_count FROM numbered""",
    "rows_per_category": f"""{active()}
SELECT category_name, count(*) AS row_count FROM active GROUP BY 1 ORDER BY 2 DESC, 1""",
    "series_number": f"{numbered()} SELECT * FROM numbered",
    "all_series_numbers": f"""{sales()}
SELECT store_number, category_name, CAST(row_number() OVER (
  ORDER BY store_number NULLS LAST, category_name NULLS LAST) AS INTEGER) AS srl_num
FROM (SELECT DISTINCT store_number, category_name FROM lines)""",
    "series_positions": f"""{numbered('nation')}
SELECT store_number, category_name, srl_num, date,
  CAST(row_number() OVER (PARTITION BY srl_num ORDER BY date) AS INTEGER) AS position,
  max(date) OVER (PARTITION BY srl_num) AS last_date FROM numbered""",
    "nested_series": f"""{numbered('nation')}
SELECT store_number, category_name, srl_num, CAST(count(*) AS INTEGER) AS weeks,
  min(date) AS first_date, max(total_sales) AS peak_sales,
  arg_max(total_volume_sold, date) AS last_volume,
  md5(string_agg(strftime(date, '%Y-%m-%d') || ' ' || CAST(CAST(total_sales AS DECIMAL(18, 2)) AS VARCHAR)
    || ' ' || CAST(CAST(total_volume_sold AS DECIMAL(18, 2)) AS VARCHAR), ',' ORDER BY date)) AS rows_md5
FROM numbered GROUP BY 1, 2, 3""",
    "grouped_apply": f"""{active('nation')}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY store_number, category_name ORDER BY date) AS t
  FROM active)
SELECT store_number, category_name, round(regr_slope(total_volume_sold, t), 4) AS slope,
  round(regr_intercept(total_volume_sold, t), 4) AS start
FROM placed GROUP BY 1, 2 HAVING count(*) >= 3""",
    "top_categories": f"{TOP} SELECT * FROM top_cat",
    "top_stores_in_top_categories": f"{TOP} SELECT * FROM top_store",
    "top_slice": f"""{TOP}
SELECT * FROM in_cat WHERE store_number IN (SELECT store_number FROM top_store)""",
    "top_series_by_peak": f"""{numbered()}
SELECT * FROM numbered WHERE srl_num IN (
  SELECT srl_num FROM numbered GROUP BY 1 ORDER BY max(total_sales) DESC, srl_num LIMIT 10)""",
    "head_rows": f"""{sales()}
SELECT store_number, date, {total('sale_dollars')} AS total_sales FROM lines GROUP BY 1, 2
ORDER BY 1, 2 LIMIT 6""",
    "monthly_sales": f"""{sales('nation')}
SELECT store_number, CAST(date_trunc('month', d) AS DATE) AS date,
  {SUMS} FROM parsed WHERE category_name = 'PROMO'
  AND d BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' GROUP BY 1, 2""",
    "forecast_calendar": calendar(18),
    "forecast_calendar_half_year": calendar(26, 1),
    "difference_orders": f"{numbered('nation')}, {DIFFERENCES} SELECT * FROM orders",
    "lag_products": f"{numbered('nation')}, {DIFFERENCES}, {PRODUCTS}",
    "model_table": MODELS,
    "stored_model_table": MODELS,
    "forecast_weekly": arima(),
    "forecast_stored_models": arima(),
    "forecast_carried_additive": CARRIED,
    "holdout_errors": HOLDOUT,
    "forecast_top_slice": arima(
        "SELECT srl_num FROM in_cat WHERE store_number IN (SELECT store_number FROM top_store)",
        f", {TOP_CATEGORIES}, {TOP_STORES}",
    ),
    "forecast_top_series": arima(
        "SELECT srl_num FROM numbered GROUP BY 1 ORDER BY max(total_sales) DESC, srl_num LIMIT 10"
    ),
    "forecast_store_monthly": MONTHLY,
    "forecast_auto_sql": choice(),
    "forecasts_from_csv": f"SELECT * EXCLUDE (srl_num) FROM ({closed_form('naive')})",
    "registered_result": f"SELECT * EXCLUDE (srl_num) FROM ({closed_form('mean')})",
    "dashboard_choices": f"""{DRIFT}
SELECT DISTINCT 'category' AS kind, category_name AS choice FROM fc
UNION ALL SELECT DISTINCT 'quarter', {quarter('"Date"')} FROM fc
UNION ALL SELECT DISTINCT 'store', CAST(store_number AS VARCHAR) FROM fc
UNION ALL SELECT 'quarter', 'Full Forecast' UNION ALL SELECT 'store', 'All Stores'""",
    "dashboard_volume": f"""{DRIFT}
SELECT store_number, "Date", forecast_volume FROM fc
WHERE category_name = 'PROMO' AND {quarter('"Date"')} = '2001-Q4' ORDER BY 2, 1""",
    "dashboard_sales": f"""{DRIFT}
SELECT store_number, "Date", fc_sales FROM fc WHERE category_name = 'PROMO' ORDER BY 2, 1""",
    "dashboard_store": f"""{DRIFT}
SELECT store_number, category_name, "Date", forecast_volume, fc_sales FROM fc
WHERE category_name = 'SMALL' AND store_number = 3 AND {quarter('"Date"')} = '2001-Q4'""",
} | {f"forecast_{m}": closed_form(m) for m in POINT}
