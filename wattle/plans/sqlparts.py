"""DuckDB SQL fragments for the oracle queries (same semantics as the Spark code)."""

from __future__ import annotations

# the quantile's coefficients are shared with the Spark side; tests hold it against another source
from ..functions.numeric import normal_quantile_sql  # noqa: F401


def chi2_sf_even_sql(x: str, df: int) -> str:
    """P(X > x) of a chi-square with even df as a Poisson sum in logarithms."""
    return (f"list_sum(list_transform(range(0, {df // 2}), "
            f"lambda j: exp(j * ln(({x}) / 2.0) - lgamma(j + 1) - ({x}) / 2.0)))")


def t_two_sided_sql(t: str, df: str) -> str:
    """Two-sided p of Student's t for whole df: the finite trigonometric sums."""
    th = f"atan(abs({t}) / sqrt({df}))"
    even = (f"1 - sin({th}) * list_sum(list_transform(range(0, {df} // 2), lambda j: "
            f"exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)) * power(cos({th}), 2 * j)))")
    odd = (f"1 - 2 / pi() * ({th} + sin({th}) * coalesce(list_sum(list_transform(range(0, ({df} - 1) // 2), lambda j: "
           f"sqrt(pi()) / 2 * exp(lgamma(j + 1) - lgamma(j + 1.5)) * power(cos({th}), 2 * j + 1))), 0))")
    return f"(CASE WHEN {df} % 2 = 0 THEN {even} ELSE {odd} END)"


def wmon(d: str) -> str:
    """Monday on or after the day (pandas W-MON label)."""
    return f"({d} + CAST((8 - isodow({d})) % 7 AS INTEGER))"


def ms(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def iso(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def base(d: str, level: str | None = None) -> str:
    lvl = f"'{level}'" if level else "aggregation_level"
    return (f"{iso(d)} AS date, CAST(year({d}) AS BIGINT) AS year, CAST(month({d}) AS BIGINT) AS month, "
            f"CAST(quarter({d}) AS BIGINT) AS quarter, CAST(weekofyear({d}) AS BIGINT) AS week, "
            f"{lvl} AS aggregation_level, monthname({d}) AS month_name")


def step(level_col: str = "aggregation_level") -> str:
    return (f"CASE {level_col} WHEN 'daily' THEN INTERVAL 1 DAY WHEN 'weekly' THEN INTERVAL 7 DAY "
            f"ELSE INTERVAL 1 MONTH END")


def r(x: str, n: int = 4) -> str:
    d = f"CAST({x} AS DOUBLE)"
    return (f"CASE WHEN NOT isnan({d}) THEN coalesce(CAST(round(TRY_CAST({d} AS DECIMAL(38,10)), {n}) AS DOUBLE), "
            f"round({d}, {n})) END")


def bround_long(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


# Stand-in raw sources as CTE bodies (mirror wattle.sources.standins).
ELEC_READINGS = """
  SELECT ts AS timestamp, year(ts) AS source_year,
         CASE WHEN event_type = 'view' AND year(ts) BETWEEN {a_lo} AND {a_hi} THEN value END AS price_exaa_raw,
         CASE WHEN event_type = 'click' AND year(ts) BETWEEN {b_lo} AND {b_hi} THEN value END AS price_mc_raw
  FROM events"""


def electricity_long_sql(a=(2015, 2025), b=(2020, 2025), merge_years=False) -> str:
    """Body of a query returning the electricity long table (stand-in eras)."""
    rd = ELEC_READINGS.format(a_lo=a[0], a_hi=a[1], b_lo=b[0], b_hi=b[1])
    sy = "0 AS source_year" if merge_years else "source_year"
    return f"""
WITH rd AS ({rd}),
d AS (SELECT {sy}, CAST(timestamp AS DATE) AS day, price_exaa_raw AS a, price_mc_raw AS b FROM rd),
binned AS (
  SELECT source_year, 'daily' AS aggregation_level, day AS bin, a, b FROM d
  UNION ALL SELECT source_year, 'weekly', {wmon('day')}, a, b FROM d
  UNION ALL SELECT source_year, 'monthly', {ms('day')}, a, b FROM d),
agg AS (SELECT source_year, aggregation_level, bin, avg(a) AS ma, count(a) AS ca,
               avg(b) AS mb, count(b) AS cb FROM binned GROUP BY ALL),
bounds AS (SELECT source_year, aggregation_level, min(bin) AS lo, max(bin) AS hi FROM agg GROUP BY ALL),
cal AS (SELECT source_year, aggregation_level,
               CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), {step()})) AS DATE) AS bin
        FROM bounds),
full_bins AS (SELECT c.source_year, c.aggregation_level, c.bin, a.ma, coalesce(a.ca, 0) AS ca,
                     a.mb, coalesce(a.cb, 0) AS cb
              FROM cal c LEFT JOIN agg a USING (source_year, aggregation_level, bin))
SELECT {base('bin')},
       {bround_long('ma')} AS price_exaa_mean, {bround_long('mb')} AS price_mc_auction_mean,
       ca AS price_count_exaa, cb AS price_count_mc,
       round_even((ca + cb) / (CASE aggregation_level WHEN 'daily' THEN 96 WHEN 'weekly' THEN 672 ELSE 2976 END) * 100, 1)
         AS data_completeness
FROM full_bins"""


def elec_bins_sql(grains=("daily", "weekly", "monthly"), gap_fill=True, a=(2015, 2025), b=(2020, 2025),
                  ) -> str:
    """Both feeds merged over years: (aggregation_level, date, means, counts)."""
    rd = ELEC_READINGS.format(a_lo=a[0], a_hi=a[1], b_lo=b[0], b_hi=b[1])
    parts = {"daily": "day", "weekly": wmon("day"), "monthly": ms("day")}
    union = "\n  UNION ALL ".join(
        f"SELECT '{g}' AS aggregation_level, {parts[g]} AS bin, a, b FROM d" for g in grains)
    body = f"""
WITH rd AS ({rd}),
d AS (SELECT CAST(timestamp AS DATE) AS day, price_exaa_raw AS a, price_mc_raw AS b FROM rd),
binned AS ({union}),
agg AS (SELECT aggregation_level, bin, avg(a) AS ma, count(a) AS ca, avg(b) AS mb, count(b) AS cb
        FROM binned GROUP BY ALL)"""
    if gap_fill:
        body += f""",
bounds AS (SELECT aggregation_level, min(bin) AS lo, max(bin) AS hi FROM agg GROUP BY ALL),
cal AS (SELECT aggregation_level,
               CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), {step()})) AS DATE) AS bin
        FROM bounds),
res AS (SELECT c.aggregation_level, c.bin, a.ma, coalesce(a.ca, 0) AS ca, a.mb, coalesce(a.cb, 0) AS cb
        FROM cal c LEFT JOIN agg a USING (aggregation_level, bin))"""
    else:
        body += ",\nres AS (SELECT * FROM agg)"
    return body + f"""
SELECT aggregation_level, {iso('bin')} AS date, {r('ma')} AS price_exaa_mean, ca AS price_exaa_count,
       {r('mb')} AS price_mc_mean, cb AS price_mc_count FROM res"""


CARBON_RAW = """
  SELECT CAST(o_orderdate AS DATE) AS d,
         avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 100000 END) AS xr_before,
         avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice / 100000 END) AS xr_after,
         avg(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 1000 END) AS pm_before,
         avg(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice / 1000 END) AS pm_after,
         avg(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice / 1000 END) AS sm_after
  FROM orders GROUP BY 1"""


def carbon_clean_sql(break_date="1998-01-01") -> str:
    return f"""
  SELECT d,
         CASE WHEN d < DATE '{break_date}' THEN xr_before ELSE xr_after END AS carbonprices_exchange_rate_eur_usd,
         CASE WHEN d < DATE '{break_date}' THEN pm_before ELSE pm_after END AS carbonprices_primary_market,
         sm_after AS carbonprices_secondary_market
  FROM ({CARBON_RAW})"""


def carbon_long_ctes(break_date="1998-01-01") -> str:
    """CTEs ending in ``carbon_long`` (same columns as wattle's carbon_long)."""
    fam = ["carbonprices_exchange_rate_eur_usd", "carbonprices_primary_market", "carbonprices_secondary_market"]
    avgs = ", ".join(f"avg({c}) AS {c}" for c in fam)
    sel = ", ".join(f"{c}" for c in fam)
    comp = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in fam)
    return f"""
cclean AS ({carbon_clean_sql(break_date)}),
cbinned AS (SELECT 'weekly' AS aggregation_level, {wmon('d')} AS bin, {sel} FROM cclean
            UNION ALL SELECT 'monthly', {ms('d')}, {sel} FROM cclean),
cagg AS (SELECT aggregation_level, bin, {avgs} FROM cbinned GROUP BY ALL),
cbounds AS (SELECT aggregation_level, min(bin) AS lo, max(bin) AS hi FROM cagg GROUP BY ALL),
ccal AS (SELECT aggregation_level,
                CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), {step()})) AS DATE) AS bin
         FROM cbounds),
cfull AS (SELECT 'daily' AS aggregation_level, d AS bin, {sel} FROM cclean
          UNION ALL
          SELECT c.aggregation_level, c.bin, {', '.join('a.' + f for f in fam)}
          FROM ccal c LEFT JOIN cagg a USING (aggregation_level, bin)),
carbon_long AS (
  SELECT {base('bin')}, carbonprices_exchange_rate_eur_usd,
         {bround_long('carbonprices_primary_market')} AS carbonprices_primary_market,
         {bround_long('carbonprices_secondary_market')} AS carbonprices_secondary_market,
         round_even(({comp}) / CAST(3 AS DOUBLE) * 100, 1) AS data_completeness
  FROM cfull)"""


# Monthly panel: y per series (order priority) and month, two regressors per month.
PANEL_CTES = f"""
py AS (SELECT o_orderpriority AS series_id, {ms('CAST(o_orderdate AS DATE)')} AS month,
              avg(o_totalprice / 1000) AS y FROM orders GROUP BY ALL),
px AS (SELECT {ms('CAST(l_shipdate AS DATE)')} AS month, avg(l_extendedprice / 1000) AS x1,
              avg(l_discount * 100) AS x2, avg(l_tax * 100) AS x3, avg(l_quantity) AS x4 FROM lineitem GROUP BY ALL),
panel AS (SELECT py.series_id, py.month, py.y, px.x1, px.x2, px.x3, px.x4 FROM py LEFT JOIN px USING (month))"""


# --- consolidated table --------------------------------------------------------------
CLIMATE_INDICATORS = ["F", "O", "P"]
CLIMATE_GEOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _norm(name: str, prefix: str) -> str:
    n = name.strip().lower().replace(" ", "_").replace("/", "_").replace("-", "_")
    return prefix + n.replace("(", "").replace(")", "").replace(">", "")


CLIMATE_COLS = [_norm(f"{i}_{g}", "climate_") for g in CLIMATE_GEOS for i in CLIMATE_INDICATORS]
PROD_COLS = ["prod_flag_a", "prod_flag_n", "prod_flag_r", "prod_status_f", "prod_status_o"]
GAS_COLS = ["oegpi_month", "oegpi_quarter", "oegpi_season", "oegpi_year"]
ECON_COLS = ["econ_count_orders", "econ_turnover_total", "econ_count_customers"]
BASE_COLS = ["year", "month", "quarter", "week", "month_name"]
ELEC_COLS = BASE_COLS + ["price_exaa_mean", "price_mc_auction_mean", "price_count_exaa", "price_count_mc",
                         "data_completeness"]
CARBON_COLS = BASE_COLS + ["carbonprices_exchange_rate_eur_usd", "carbonprices_primary_market",
                           "carbonprices_secondary_market", "data_completeness"]
SHARED = ["year", "month", "quarter", "week", "month_name", "data_completeness"]
DOUBLE_COLS = (["data_completeness", "carbonprices_exchange_rate_eur_usd"] + CLIMATE_COLS + GAS_COLS + ECON_COLS)


def climate_wide_cte() -> str:
    cases = ", ".join(
        f"max(CASE WHEN indic = '{i}' AND geo = '{g}' THEN obs END) AS {_norm(f'{i}_{g}', 'climate_')}"
        for g in CLIMATE_GEOS for i in CLIMATE_INDICATORS)
    return f"""
clim AS (SELECT strftime(o_orderdate, '%Y-%m') AS tp, o_orderstatus AS indic, o_orderpriority AS geo,
                avg(o_totalprice / 1000) AS obs FROM orders GROUP BY ALL),
climate_wide AS (SELECT CAST(strptime(tp, '%Y-%m') AS DATE) AS m, {cases} FROM clim GROUP BY 1)"""


def sources_ctes(el_a=(2015, 2025), el_b=(2020, 2025), break_date="1998-01-01") -> str:
    """CTEs: elec_long, carbon_long, climate_long, production_long, gas_long, economy_long."""
    from .q_ingest import ECON_SQL, GAS_SQL, PROD_SQL, austrian_parse_sql, german_parse_sql  # noqa
    return f"""
elec_long AS ({electricity_long_sql(el_a, el_b)}),
{carbon_long_ctes(break_date)},
{climate_wide_cte()},
climate_long AS (SELECT {base('m', 'monthly')}, {', '.join(CLIMATE_COLS)} FROM climate_wide),
production_long AS (SELECT {base('m', 'monthly')}, {', '.join(PROD_COLS)} FROM ({PROD_SQL})),
gas_p AS (SELECT {german_parse_sql('Datum')} AS m, Monat AS oegpi_month, Quartal AS oegpi_quarter,
                 Saison AS oegpi_season, Jahr AS oegpi_year FROM ({GAS_SQL})),
gas_long AS (SELECT {base('m', 'monthly')}, {', '.join(GAS_COLS)} FROM gas_p WHERE m IS NOT NULL),
econ_p AS (SELECT {austrian_parse_sql('Berichtszeitraum')} AS m, Auftraege AS econ_count_orders,
                  Umsatz AS econ_turnover_total, Kunden AS econ_count_customers FROM ({ECON_SQL})
           WHERE coalesce(regexp_full_match(trim(Berichtszeitraum), '[^.]{{0,4}}[.][^.]{{2}}'), false)),
economy_long AS (SELECT {base('m', 'monthly')}, {', '.join(ECON_COLS)} FROM econ_p)"""


def outer_chain_ctes(sources, out_name="consolidated") -> str:
    """Full outer join chain on (date, aggregation_level), shared columns left-first."""
    acc, acc_cols = sources[0]
    ctes = []
    for i, (nm, cols) in enumerate(sources[1:]):
        shared = [c for c in SHARED if c in acc_cols and c in cols]
        sel = ["coalesce(l.date, r.date) AS date",
               "coalesce(l.aggregation_level, r.aggregation_level) AS aggregation_level"]
        sel += [f"coalesce(l.{c}, r.{c}) AS {c}" if c in shared else f"l.{c}" for c in acc_cols]
        sel += [f"r.{c}" for c in cols if c not in shared]
        name = out_name if i == len(sources) - 2 else f"m{i}"
        ctes.append(f"{name} AS (SELECT {', '.join(sel)} FROM {acc} l FULL OUTER JOIN {nm} r "
                    f"ON l.date = r.date AND l.aggregation_level = r.aggregation_level)")
        acc, acc_cols = name, acc_cols + [c for c in cols if c not in shared]
    return ",\n".join(ctes)


SOURCE_LIST = [("elec_long", ELEC_COLS), ("carbon_long", CARBON_COLS),
               ("climate_long", BASE_COLS + CLIMATE_COLS), ("production_long", BASE_COLS + PROD_COLS),
               ("gas_long", BASE_COLS + GAS_COLS), ("economy_long", BASE_COLS + ECON_COLS)]
CONSOLIDATED_COLS = (["date", "aggregation_level"] + ELEC_COLS
                     + ["carbonprices_exchange_rate_eur_usd", "carbonprices_primary_market",
                        "carbonprices_secondary_market"] + CLIMATE_COLS + PROD_COLS + GAS_COLS + ECON_COLS)


def consolidated_ctes(el_a=(2015, 2025), el_b=(2020, 2025), break_date="1998-01-01") -> str:
    return sources_ctes(el_a, el_b, break_date) + ",\n" + outer_chain_ctes(SOURCE_LIST)


def rounded_select(cols, doubles=DOUBLE_COLS, n=4) -> str:
    return ", ".join(f"{r(c, n)} AS {c}" if c in doubles else c for c in cols)


SPLIT_CTES = PANEL_CTES + """,
sp AS (SELECT *, CASE WHEN month <= DATE '1999-12-01' THEN 'train'
                      WHEN month BETWEEN DATE '2000-01-01' AND DATE '2001-06-01' THEN 'test' END AS split,
              CAST(year(month) * 12 + month(month) - 1 AS BIGINT) AS midx FROM panel),
tr AS (SELECT * FROM sp WHERE split = 'train'),
te AS (SELECT * FROM sp WHERE split = 'test')"""

FORECAST_CTES = SPLIT_CTES + """,
f_pers AS (SELECT te.series_id, te.month, 'persistence' AS model, te.y AS actual, l.f AS forecast
           FROM te JOIN (SELECT series_id, arg_max(y, month) AS f FROM tr GROUP BY 1) l USING (series_id)),
last12 AS (SELECT series_id, month(month) AS moy, y AS f FROM tr
           QUALIFY row_number() OVER (PARTITION BY series_id, month(month) ORDER BY month DESC) = 1),
f_seas AS (SELECT te.series_id, te.month, 'seasonal_naive' AS model, te.y AS actual, s.f AS forecast
           FROM te LEFT JOIN last12 s ON te.series_id = s.series_id AND month(te.month) = s.moy),
rc AS (SELECT series_id, regr_intercept(y, x1) AS a, regr_slope(y, x1) AS b, regr_r2(y, x1) AS r2,
              regr_count(y, x1) AS n FROM tr GROUP BY 1),
f_reg AS (SELECT te.series_id, te.month, 'regression_x1' AS model, te.y AS actual, rc.a + rc.b * te.x1 AS forecast
          FROM te JOIN rc USING (series_id)),
trl AS (SELECT *, lag(y) OVER (PARTITION BY series_id ORDER BY month) AS y1 FROM tr),
ac AS (SELECT series_id, regr_intercept(y, y1) AS c, regr_slope(y, y1) AS phi, regr_r2(y, y1) AS r2,
              regr_count(y, y1) AS n, arg_max(y, month) AS yT, max(midx) AS T FROM trl GROUP BY 1),
f_ar AS (SELECT te.series_id, te.month, 'ar1' AS model, te.y AS actual,
                CASE WHEN ac.phi = 1 THEN ac.c * (te.midx - ac.T) + ac.yT
                     ELSE ac.c * (1 - power(ac.phi, te.midx - ac.T)) / (1 - ac.phi)
                          + power(ac.phi, te.midx - ac.T) * ac.yT END AS forecast
         FROM te JOIN ac USING (series_id)),
fc AS (SELECT * FROM f_pers UNION ALL SELECT * FROM f_seas UNION ALL SELECT * FROM f_reg UNION ALL SELECT * FROM f_ar),
fm AS (SELECT series_id, model, count(forecast - actual) AS n, sqrt(avg((forecast - actual) ^ 2)) AS rmse,
              avg(abs(forecast - actual)) AS mae, avg(abs((forecast - actual) / actual)) * 100 AS mape,
              avg(forecast - actual) AS bias, max(abs(forecast - actual)) AS max_abs_error
       FROM fc GROUP BY ALL)"""

# AR(1) residuals on the training months (used by the residual diagnostics)
RESID_CTES = FORECAST_CTES + """,
res AS (SELECT trl.series_id, trl.month, trl.y - (ac.c + ac.phi * trl.y1) AS e
        FROM trl JOIN ac USING (series_id) WHERE trl.y1 IS NOT NULL)"""




def _matching(sql: str, open_idx: int) -> int:
    depth = 0
    for i in range(open_idx, len(sql)):
        if sql[i] == "(":
            depth += 1
        elif sql[i] == ")":
            depth -= 1
            if depth == 0:
                return i
    raise ValueError("unbalanced parentheses")


def _window_suffix(sql: str, k: int) -> int:
    """End index of an ``OVER name`` / ``OVER (...)`` clause starting at ``k`` (or ``k``)."""
    m = k
    while m < len(sql) and sql[m].isspace():
        m += 1
    if sql[m:m + 4].upper() != "OVER":
        return k
    m += 4
    while m < len(sql) and sql[m].isspace():
        m += 1
    if m < len(sql) and sql[m] == "(":
        return _matching(sql, m) + 1
    while m < len(sql) and (sql[m].isalnum() or sql[m] == "_"):
        m += 1
    return m


def bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT and ``regr_count`` as UINTEGER where
    Spark returns BIGINT: rewrite them so both engines agree on the schema
    (a trailing window clause moves inside the cast)."""
    for fn, wrap in (("count_if(", lambda a, w: f"count(CASE WHEN {a} THEN 1 END){w}"),
                     ("regr_count(", lambda a, w: f"CAST(regr_count_({a}){w} AS BIGINT)")):
        out, pos = [], 0
        while True:
            i = sql.find(fn, pos)
            if i < 0:
                break
            if i > 0 and (sql[i - 1].isalnum() or sql[i - 1] == "_"):
                out.append(sql[pos:i + len(fn)])
                pos = i + len(fn)
                continue
            j = _matching(sql, i + len(fn) - 1)
            e = _window_suffix(sql, j + 1)
            out.append(sql[pos:i])
            out.append(wrap(bigint_counts(sql[i + len(fn):j]), sql[j + 1:e]))
            pos = e
        out.append(sql[pos:])
        sql = "".join(out)
    return sql.replace("regr_count_(", "regr_count(")


def eliminate_ctes(src: str, keys: list[str], columns: list[str], name: str, tol: float = 1e-10) -> str:
    """CTEs ``{name}_0`` .. ``{name}_u``: moments of ``columns`` (the response last) of ``src`` by ``keys``, and one
    elimination step a CTE. ``g{i}_{j}`` (i <= j) of ``{name}_u`` is row i when i was the pivot; ``o{i}`` the pivots at first."""
    k = len(columns) - 1
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    key = ", ".join(keys)
    out = [f"{name}_0 AS MATERIALIZED (SELECT {key}, " + ", ".join(f"sum(CAST({columns[i]} AS DOUBLE) * {columns[j]}) AS g{i}_{j}" for i, j in pairs)
           + ", " + ", ".join(f"sum(CAST({columns[i]} AS DOUBLE) * {columns[i]}) AS o{i}" for i in range(k + 1)) + f" FROM {src} GROUP BY ALL)"]
    for p in range(k):
        cells = [f"CASE WHEN g{p}_{p} > {tol} * o{p} THEN g{i}_{j} - g{p}_{i} * g{p}_{j} / g{p}_{p} ELSE g{i}_{j} END AS g{i}_{j}"
                 for i, j in pairs if i > p]
        rest = [f"g{i}_{j}" for i, j in pairs if i <= p] + [f"o{i}" for i in range(k + 1)]
        to = f"{name}_{p + 1}" if p < k - 1 else f"{name}_u"
        out.append(f"{to} AS MATERIALIZED (SELECT {key}, {', '.join(cells + rest)} FROM {name}_{p})")
    return ",\n".join(out)


def solve_cte(name: str, keys: list[str], k: int, tol: float = 1e-10) -> str:
    """CTE ``{name}_b`` after ``eliminate_ctes``: coefficients ``b0`` .. (null where the column was passed over), ``ssr``."""
    terms = []
    for i in reversed(range(k)):
        later = "".join(f" - g{i}_{j} * coalesce(b{j}, 0)" for j in range(i + 1, k))
        terms.append(f"CASE WHEN g{i}_{i} > {tol} * o{i} THEN (g{i}_{k}{later}) / g{i}_{i} END AS b{i}")
    return f"{name}_b AS MATERIALIZED (SELECT {', '.join(keys)}, {', '.join(terms)}, g{k}_{k} AS ssr FROM {name}_u)"
