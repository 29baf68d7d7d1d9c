"""The same queries as plain SQL for DuckDB over the star-schema tables."""

from __future__ import annotations

from shelfcast.plans.reports import PROMO_BOOSTS
from shelfcast.spec import EWM_ALPHAS, MEAN_SPANS, SALES_LAGS, STD_SPANS
from shelfcast.workload.tables import DAY_ZERO, HOLIDAYS, SPEC

START, END, TEST, VAL, FEATURES = (
    f"DATE '{d}'"
    for d in (SPEC.calendar_start, SPEC.calendar_end, SPEC.test_start, SPEC.val_start, SPEC.feature_start)
)
SHOCK = f"BETWEEN DATE '{SPEC.shock_start}' AND DATE '{SPEC.shock_end}'"
BY_DAY = "PARTITION BY store_nbr, family ORDER BY date"


def rounded(expr: str, digits: int = 4) -> str:
    """Rounding that never gives a negative zero."""
    half = 0.5 * 10**-digits
    return f"CASE WHEN abs({expr}) < {half:.12f} THEN 0.0::DOUBLE ELSE round(({expr})::DOUBLE, {digits}) END"


def digest(
    source: str, by: list[str], columns: list[str], where: str = "TRUE", digits: tuple[int, int, int] = (6, 5, 6)
) -> str:
    parts = [*by, "count(*) AS n_rows"]
    for c in columns:
        mean, square = f"avg({c}::DOUBLE)", f"avg({c}::DOUBLE * {c}::DOUBLE)"
        by_day = f"avg({c}::DOUBLE * date_diff('day', {START}, date))"
        parts += [
            f"count({c}) AS {c}_known",
            f"{rounded(mean, digits[0])} AS {c}_mean",
            f"{rounded(by_day, digits[1])} AS {c}_by_day",
            f"{rounded(square, digits[2])} AS {c}_square",
        ]
    keys = ", ".join(by)
    return f"SELECT {', '.join(parts)} FROM {source} WHERE {where} GROUP BY {keys}"


_HOLIDAY_ROWS = ", ".join(
    f"({m}, {d}, '{kind}', '{locale}', '{place}', '{text}', {moved}, {even})"
    for m, d, kind, locale, place, text, moved, even in HOLIDAYS
)

# Each table of the retail model as a CTE, and the CTEs it needs.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "sold": (
        f"""SELECT (store_nbr * {1 << 14} + date_diff('day', DATE '{DAY_ZERO}', date)) * {1 << 30}
                   + (('0x' || md5(family)[1:8])::BIGINT & {(1 << 30) - 1}) AS id, *
            FROM (SELECT l_suppkey AS store_nbr, p_type AS family, l_shipdate::DATE AS date,
                         sum(l_quantity) AS sales,
                         count(*) FILTER (WHERE l_discount >= 0.05) AS onpromotion
                  FROM lineitem JOIN part ON l_partkey = p_partkey
                  GROUP BY ALL)""",
        (),
    ),
    "train": (f"SELECT * FROM sold WHERE date < {TEST}", ("sold",)),
    "test": (
        f"SELECT id, store_nbr, family, date, onpromotion FROM sold WHERE date >= {TEST}",
        ("sold",),
    ),
    "stores": (
        """SELECT s_suppkey AS store_nbr, n_name AS city, r_name AS state,
                  chr((65 + s_suppkey % 5)::INTEGER) AS type, (s_suppkey % 17 + 1)::INTEGER AS cluster
           FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey""",
        (),
    ),
    "oil": (
        """SELECT date, CASE WHEN NOT (month(date) = 1 AND day(date) <= 10) THEN price END AS dcoilwtico
           FROM (SELECT o_orderdate::DATE AS date,
                        sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / (count(*) * 100000) AS price
                 FROM orders GROUP BY ALL)
           WHERE isodow(date) <= 5""",
        (),
    ),
    "regional_oil": (
        """SELECT state, date, CASE WHEN NOT (month(date) = 1 AND day(date) <= 10) THEN price END AS dcoilwtico
           FROM (SELECT r_name AS state, o_orderdate::DATE AS date,
                        sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / (count(*) * 100000) AS price
                 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey
                 GROUP BY ALL)
           WHERE isodow(date) <= 5""",
        (),
    ),
    "holidays": (
        f"""SELECT make_date(year, month, day) AS date, type, locale, locale_name, description,
                   moved AND year % 2 = 0 AS transferred
            FROM (VALUES {_HOLIDAY_ROWS}) h(month, day, type, locale, locale_name, description, moved, even_only),
                 range({SPEC.calendar_start.year}, {SPEC.calendar_end.year + 1}) y(year)
            WHERE year % 2 = 0 OR NOT even_only""",
        (),
    ),
    "transactions": (
        f"""SELECT l_shipdate::DATE AS date, l_suppkey AS store_nbr, count(DISTINCT l_orderkey) AS transactions
            FROM lineitem GROUP BY ALL""",
        (),
    ),
    "days": (f"SELECT unnest(generate_series({START}, {END}, INTERVAL 1 DAY))::DATE AS date", ()),
    "grid": (
        f"""SELECT date, store_nbr, family, id,
                   CASE WHEN closed THEN 0.0 WHEN date < {TEST} THEN sales END::DOUBLE AS sales,
                   CASE WHEN closed THEN 0 ELSE coalesce(onpromotion, 0) END AS onpromotion,
                   date >= {TEST} AS is_test, closed::INTEGER AS is_closed
            FROM (SELECT *, month(date) = 12 AND day(date) = 25 AS closed
                  FROM days CROSS JOIN (SELECT DISTINCT store_nbr FROM train)
                       CROSS JOIN (SELECT DISTINCT family FROM train)
                       LEFT JOIN sold USING (date, store_nbr, family))""",
        ("days", "train", "sold"),
    ),
    "logged": (
        "SELECT *, CASE WHEN sales IS NOT NULL THEN ln(1 + greatest(sales, 0)) END AS log_sales FROM grid",
        ("grid",),
    ),
    # Oil: nearest known values on either side of each day.
    "oil_sides": (
        f"""SELECT date, dcoilwtico AS v,
                   last_value(dcoilwtico IGNORE NULLS) OVER back AS v0,
                   last_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER back AS d0,
                   first_value(dcoilwtico IGNORE NULLS) OVER ahead AS v1,
                   first_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER ahead AS d1
            FROM days LEFT JOIN oil USING (date)
            WHERE date >= (SELECT min(date) FROM oil)
            WINDOW back AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   ahead AS (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        ("days", "oil"),
    ),
    "oil_daily": (
        """SELECT *, avg(dcoilwtico) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS oil_ma7,
                  avg(dcoilwtico) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS oil_ma30
           FROM (SELECT date, CASE WHEN v IS NOT NULL THEN v WHEN v0 IS NULL THEN v1 WHEN v1 IS NULL THEN v0
                        ELSE v0 + (v1 - v0) * (date_diff('day', d0, date) / date_diff('day', d0, d1)) END AS dcoilwtico
                 FROM oil_sides)""",
        ("oil_sides",),
    ),
    "regional_sides": (
        f"""SELECT state, date, dcoilwtico AS v,
                   last_value(dcoilwtico IGNORE NULLS) OVER back AS v0,
                   last_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER back AS d0,
                   first_value(dcoilwtico IGNORE NULLS) OVER ahead AS v1,
                   first_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER ahead AS d1
            FROM (SELECT state, unnest(generate_series(first, {END}, INTERVAL 1 DAY))::DATE AS date
                  FROM (SELECT state, min(date) AS first FROM regional_oil GROUP BY state))
                 LEFT JOIN regional_oil USING (state, date)
            WINDOW back AS (PARTITION BY state ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   ahead AS (PARTITION BY state ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        ("regional_oil",),
    ),
    "regional_daily": (
        """SELECT *, avg(dcoilwtico) OVER (PARTITION BY state ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS oil_ma7,
                  avg(dcoilwtico) OVER (PARTITION BY state ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS oil_ma30
           FROM (SELECT state, date, CASE WHEN v IS NOT NULL THEN v WHEN v0 IS NULL THEN v1 WHEN v1 IS NULL THEN v0
                        ELSE v0 + (v1 - v0) * (date_diff('day', d0, date) / date_diff('day', d0, d1)) END AS dcoilwtico
                 FROM regional_sides)""",
        ("regional_sides",),
    ),
    "kept": ("SELECT * FROM holidays WHERE NOT transferred", ("holidays",)),
    "gold": (
        f"""SELECT g.*, city, state, type, cluster, dcoilwtico, oil_ma7, oil_ma30,
                   nat AS is_holiday_national, reg AS is_holiday_regional, loc AS is_holiday_local,
                   greatest(nat, reg, loc) AS is_holiday_any,
                   (g.date {SHOCK})::INTEGER AS is_earthquake_period
            FROM (SELECT g.*, s.city, s.state, s.type, s.cluster,
                    EXISTS (SELECT 1 FROM kept k WHERE k.locale = 'National' AND k.date = g.date)::INTEGER AS nat,
                    EXISTS (SELECT 1 FROM kept k WHERE k.locale = 'Regional' AND k.date = g.date
                                                       AND k.locale_name = s.state)::INTEGER AS reg,
                    EXISTS (SELECT 1 FROM kept k WHERE k.locale = 'Local' AND k.date = g.date
                                                       AND k.locale_name = s.city)::INTEGER AS loc
                  FROM grid g LEFT JOIN stores s USING (store_nbr)) g LEFT JOIN oil_daily o USING (date)""",
        ("grid", "stores", "oil_daily", "kept"),
    ),
}


def with_ctes(sql: str, *needed: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][1]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    head = ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order)
    return f"WITH {head}\n{sql}"


# ------------------------------------------------------------------------ feature columns


def _frame(newest: int, oldest: int) -> str:
    return f"OVER ({BY_DAY} ROWS BETWEEN {oldest} PRECEDING AND {newest} PRECEDING)"


LAG_SQL = {f"sales_lag_{n}": f"lag(log_sales, {n}) OVER ({BY_DAY})" for n in SALES_LAGS}
MEAN_SQL = {f"sales_roll_mean_{n}": f"avg(log_sales) {_frame(16, 15 + n)}" for n in MEAN_SPANS}
STD_SQL = {
    f"sales_roll_std_{n}": f"coalesce(stddev_samp(log_sales) {_frame(16, 15 + n)}, 0)" for n in STD_SPANS
}
PROMO_SQL = {
    "promo_lag_0": "onpromotion::DOUBLE",
    "promo_lag_16": f"coalesce(lag(onpromotion, 16) OVER ({BY_DAY}), 0)::DOUBLE",
    "promo_roll_mean_14": f"avg(onpromotion) OVER ({BY_DAY} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)",
}
INTENSITY_SQL = {"promo_intensity": "promo_lag_0 / (promo_roll_mean_14 + 1.0)"}
CALENDAR_SQL = {
    "dayofweek": "(isodow(date) - 1)::INTEGER",
    "day": "day(date)::INTEGER",
    "month": "month(date)::INTEGER",
    "year": "year(date)::INTEGER",
    "weekofyear": "weekofyear(date)::INTEGER",
    "is_weekend": "(isodow(date) >= 6)::INTEGER",
    "sin_dow": "sin(2 * pi() * (isodow(date) - 1) / 7)",
    "cos_dow": "cos(2 * pi() * (isodow(date) - 1) / 7)",
    "sin_month": "sin(2 * pi() * month(date) / 12)",
    "cos_month": "cos(2 * pi() * month(date) / 12)",
}
PAYDAY_SQL = {
    "is_payday": "(day(date) = 15 OR date = last_day(date))::INTEGER",
    "days_to_payday": (
        "(CASE WHEN day(date) <= 15 THEN 15 - day(date) ELSE day(last_day(date)) - day(date) END)::INTEGER"
    ),
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


# The weighted mean at each known day from all earlier ones, carried over the gaps.
_EWM_AT_KNOWN = ", ".join(
    f"""sum(pow({1 - a:.1f}::DOUBLE, date_diff('day', j.date, i.date)) * j.log_sales)
        / sum(pow({1 - a:.1f}::DOUBLE, date_diff('day', j.date, i.date))) AS at_{name}"""
    for name, a in EWM_ALPHAS.items()
)
EWM_SQL = {
    name: (
        f"last_value(at_{name} IGNORE NULLS) OVER ({BY_DAY} ROWS BETWEEN UNBOUNDED PRECEDING AND 16 PRECEDING)"
    )
    for name in EWM_ALPHAS
}


def _with_ewm(source: str) -> str:
    return f"""(SELECT * FROM {source} LEFT JOIN (
                  SELECT i.store_nbr, i.family, i.date, {_EWM_AT_KNOWN}
                  FROM logged i JOIN logged j
                       ON i.store_nbr = j.store_nbr AND i.family = j.family AND j.date <= i.date
                  WHERE i.log_sales IS NOT NULL AND j.log_sales IS NOT NULL
                  GROUP BY ALL) USING (store_nbr, family, date))"""


def _window_digest(columns: dict[str, str]) -> str:
    source = f"(SELECT store_nbr, family, date, {_select(columns)} FROM logged)"
    return with_ctes(digest(source, ["store_nbr", "family"], list(columns)), "logged")


CTES["features"] = (
    f"""SELECT * REPLACE ({', '.join(f'coalesce({c}, 0) AS {c}' for c in [*LAG_SQL, *MEAN_SQL, *STD_SQL, *EWM_SQL])}),
               {_select(INTENSITY_SQL)}
        FROM (SELECT *, {_select({**CALENDAR_SQL, **PAYDAY_SQL, **LAG_SQL, **MEAN_SQL, **STD_SQL, **EWM_SQL, **PROMO_SQL})}
              FROM {_with_ewm('gold JOIN (SELECT store_nbr, family, date, log_sales FROM logged) USING (store_nbr, family, date)')})
        WHERE date >= {FEATURES}""",
    ("gold", "logged"),
)

# Model inputs in table order.
FEATURE_NAMES = [
    "store_nbr", "family", "onpromotion", "is_closed", "city", "state", "type", "cluster",
    "dcoilwtico", "oil_ma7", "oil_ma30",
    "is_holiday_national", "is_holiday_regional", "is_holiday_local", "is_holiday_any", "is_earthquake_period",
    *CALENDAR_SQL, *PAYDAY_SQL, *LAG_SQL, *MEAN_SQL, *STD_SQL, *EWM_SQL, *PROMO_SQL, *INTENSITY_SQL,
]
TEXT_NAMES = ("family", "city", "state", "type")

_NAIVE = {c: {**LAG_SQL, **MEAN_SQL}[c] for c in ("sales_lag_16", "sales_lag_21", "sales_roll_mean_7")}
CTES["predicted"] = (
    f"""SELECT *, exp(coalesce(sales_lag_16, 0)) - 1 AS pred_naive,
               exp(coalesce(sales_lag_21, 0)) - 1 AS pred_seasonal_naive,
               exp(coalesce(sales_roll_mean_7, 0)) - 1 AS pred_moving_average
        FROM (SELECT *, {_select(_NAIVE)} FROM logged)""",
    ("logged",),
)
CTES["val"] = (f"SELECT * FROM predicted WHERE date BETWEEN {VAL} AND {TEST} - 1", ("predicted",))
CTES["horizon"] = (
    """SELECT id, store_nbr, family, date, onpromotion, pred_moving_average AS sales_pred
       FROM predicted WHERE is_test""",
    ("predicted",),
)


def _scores(y: str, p: str, digits: int = 6) -> str:
    p = f"greatest({p}, 0)"
    metrics = {
        "rmsle": f"sqrt(avg(pow(ln(1 + greatest({y}, 0)) - ln(1 + {p}), 2)) FILTER (WHERE {y} IS NOT NULL))",
        "mae": f"avg(abs({y} - {p}))",
        "rmse": f"sqrt(avg(pow({y} - {p}, 2)))",
        "wape_pct": f"sum(abs({y} - {p})) / sum(abs({y})) * 100",
        "bias_pct": f"sum({p} - {y}) / sum({y}) * 100",
    }
    cols = [f"{rounded(sql, digits)} AS {name}" for name, sql in metrics.items()]
    return ", ".join([*cols, f"count({y}) AS n_scored"])


def _board(source: str, models: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS model, {_scores('sales', p)} FROM {source}" for name, p in models.items()
    )


_BASELINES = {
    "Naive (Lag 16)": "pred_naive",
    "Seasonal Naive (Lag 21)": "pred_seasonal_naive",
    "Moving Average 7d (Shift 16)": "pred_moving_average",
}
_BLENDS = {
    f"Blend {a}% + {b}%": f"({a / 100} * pred_seasonal_naive + {b / 100} * pred_moving_average)"
    for a, b in ((50, 50), (30, 70), (70, 30))
}
_FILLED = "(SELECT family, coalesce(sales, 0) AS sales FROM grid WHERE NOT is_test)"
_FLAGS = "is_holiday_national, is_holiday_regional, is_holiday_local, is_holiday_any"


def _flagged(kept: str, rows: str = "train") -> str:
    def hit(scope: str, place: str = "") -> str:
        where = f" AND k.locale_name = {place}" if place else ""
        return f"EXISTS (SELECT 1 FROM {kept} k WHERE k.locale = '{scope}' AND k.date = t.date{where})::INTEGER"

    return f"""(SELECT *, greatest(is_holiday_national, is_holiday_regional, is_holiday_local) AS is_holiday_any
                FROM (SELECT t.*, s.city, s.state, {hit('National')} AS is_holiday_national,
                             {hit('Regional', 's.state')} AS is_holiday_regional,
                             {hit('Local', 's.city')} AS is_holiday_local
                      FROM {rows} t JOIN stores s USING (store_nbr)))"""


_STORE_TOTALS = (
    "(SELECT store_nbr, sum(sales) AS sales, any_value(city) AS city, any_value(state) AS state,"
    " any_value(type) AS type, any_value(cluster) AS cluster FROM train JOIN stores USING (store_nbr) GROUP BY store_nbr)"
)
_BOOSTS = f"(SELECT unnest([{', '.join(map(str, PROMO_BOOSTS))}]) AS boost_pct)"
_REQUEST_FAMILIES = "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD', 'BULK', 'GIFT']"
CTES["requests"] = (
    f"""SELECT c_custkey AS request_id, c_custkey % 120 AS store_nbr,
               {_REQUEST_FAMILIES}[c_nationkey % 8 + 1] AS family,
               CASE WHEN c_custkey % 3 > 0 THEN {TEST} + (c_custkey % 5 * 5)::INTEGER ELSE {TEST} END AS start_date,
               {END} AS end_date
        FROM customer""",
    (),
)
CTES["checked"] = (
    """SELECT *, CASE WHEN store_nbr NOT BETWEEN 0 AND 109 THEN 'store_out_of_range'
                      WHEN family NOT IN (SELECT family FROM horizon) THEN 'unknown_family'
                      WHEN store_nbr NOT IN (SELECT store_nbr FROM horizon) THEN 'unknown_store'
                      WHEN NOT EXISTS (SELECT 1 FROM horizon h
                                       WHERE h.store_nbr = r.store_nbr AND h.family = r.family
                                             AND h.date BETWEEN r.start_date AND r.end_date) THEN 'no_data' END AS reason
       FROM requests r""",
    ("requests", "horizon"),
)


def _profile_row(name: str, columns: int, dated: bool) -> str:
    first, last = ("min(date)", "max(date)") if dated else ("NULL::DATE", "NULL::DATE")
    table = "holidays" if name == "holidays_events" else name
    return (
        f"SELECT '{name}' AS dataset, count(*) AS n_rows, {columns} AS n_columns,"
        f" {first} AS first_date, {last} AS last_date FROM {table}"
    )


_GOLD_NUMERIC = [
    "id", "sales", "onpromotion", "is_test", "is_closed", "cluster", "dcoilwtico", "oil_ma7", "oil_ma30",
    "is_holiday_national", "is_holiday_regional", "is_holiday_local", "is_holiday_any", "is_earthquake_period",
]

ORACLES: dict[str, str] = {
    "typed_sales": with_ctes(digest("(SELECT * REPLACE (id % 10007 AS id) FROM train)", ["family"], ["id", "store_nbr", "sales", "onpromotion"]), "train"),
    "union_parts": with_ctes(
        f"""SELECT store_nbr, count(*) AS n_rows, count(*) FILTER (WHERE date < {TEST}) AS n_sales,
                   sum(sales) FILTER (WHERE date < {TEST}) AS sales, sum(onpromotion)::BIGINT AS onpromotion
            FROM sold GROUP BY store_nbr""",
        "sold",
    ),
    "series_list": with_ctes(
        "SELECT * FROM (SELECT DISTINCT store_nbr FROM train) CROSS JOIN (SELECT DISTINCT family FROM train)",
        "train",
    ),
    "grid_rows": with_ctes(
        digest(
            "(SELECT * REPLACE (is_test::INTEGER AS is_test, id % 10007 AS id) FROM grid)",
            ["store_nbr", "family"],
            ["id", "sales", "onpromotion", "is_test", "is_closed"],
        ),
        "grid",
    ),
    "grid_gap_profile": with_ctes(
        """SELECT year(date)::INTEGER AS year, count(*) AS n_rows,
                  count(*) FILTER (WHERE sales IS NULL AND NOT is_test) AS n_gaps,
                  count(*) FILTER (WHERE is_test) AS n_test, sum(is_closed)::BIGINT AS n_closed,
                  count(DISTINCT date) AS n_days
           FROM grid GROUP BY 1""",
        "grid",
    ),
    "oil_interpolated": with_ctes(
        "SELECT date, "
        + ", ".join(f"{c}::FLOAT::DOUBLE AS {c}" for c in ("dcoilwtico", "oil_ma7", "oil_ma30"))
        + " FROM oil_daily",
        "oil_daily",
    ),
    "holiday_calendar": with_ctes(
        """SELECT k.*, type = 'Work Day' AS is_workday, type = 'Bridge' AS is_bridge, type = 'Event' AS is_event, sales
           FROM kept k LEFT JOIN (SELECT date, sum(sales) AS sales FROM train GROUP BY date) USING (date)""",
        "kept",
        "train",
    ),
    "holiday_flags": with_ctes(
        f"SELECT city, {_FLAGS}, count(*) AS n_rows, sum(sales) AS sales FROM {_flagged('kept', 'grid')} GROUP BY ALL",
        "grid",
        "stores",
        "kept",
    ),
    "holiday_flags_without_work_days": with_ctes(
        f"""SELECT state, is_holiday_any, sum(sales) AS sales
            FROM {_flagged("(SELECT * FROM kept WHERE type <> 'Work Day')")} GROUP BY ALL""",
        "train",
        "stores",
        "kept",
    ),
    "shock_flag": with_ctes(
        f"""SELECT store_nbr, (date {SHOCK})::INTEGER AS is_earthquake_period, count(*) AS n_rows,
                   min(date) AS first_date, max(date) AS last_date
            FROM train GROUP BY 1, 2""",
        "train",
    ),
    "gold_digest": with_ctes(
        digest(
            "(SELECT * REPLACE (is_test::INTEGER AS is_test, id % 10007 AS id) FROM gold)",
            ["store_nbr", "family", "city", "state", "type"],
            _GOLD_NUMERIC,
            digits=(5, 3, 3),
        ),
        "gold",
    ),
    "calendar_features": with_ctes(
        "SELECT date, "
        + _select({n: rounded(c, 6) if n[:4] in ("sin_", "cos_") else c for n, c in CALENDAR_SQL.items()})
        + " FROM (SELECT DISTINCT date FROM train)",
        "train",
    ),
    "payday_features": with_ctes(
        f"SELECT date, {_select(PAYDAY_SQL)} FROM (SELECT DISTINCT date FROM train)", "train"
    ),
    "sales_lags": _window_digest(LAG_SQL),
    "rolling_means": _window_digest(MEAN_SQL),
    "rolling_stds": _window_digest(STD_SQL),
    "ewma_features": with_ctes(
        digest(
            f"(SELECT store_nbr, family, date, {_select(EWM_SQL)} FROM {_with_ewm('logged')})",
            ["store_nbr", "family"],
            list(EWM_SQL),
        ),
        "logged",
    ),
    "promo_features": with_ctes(
        digest(
            f"(SELECT *, {_select(INTENSITY_SQL)} FROM (SELECT store_nbr, family, date, {_select(PROMO_SQL)} FROM grid))",
            ["store_nbr", "family"],
            [*PROMO_SQL, "promo_intensity"],
        ),
        "grid",
    ),
    "feature_table": with_ctes(
        digest(
            "features",
            ["store_nbr", "family"],
            ["log_sales", *[c for c in FEATURE_NAMES if c not in TEXT_NAMES and c != "store_nbr"]],
            digits=(5, 3, 3),
        ),
        "features",
    ),
    "feature_list": with_ctes(
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS feature, (SELECT count({c}) FROM features) AS n_known"
            for i, c in enumerate(FEATURE_NAMES)
        ),
        "features",
    ),
    "split_parts": with_ctes(
        f"""SELECT CASE WHEN date >= {TEST} THEN 'test' WHEN date >= {VAL} THEN 'val' ELSE 'train' END AS split,
                   min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS n_days, count(*) AS n_rows
            FROM grid GROUP BY 1""",
        "grid",
    ),
    "split_by_date": with_ctes(
        f"""SELECT store_nbr,
                   CASE WHEN date >= {TEST} THEN 'test'
                        WHEN date >= (SELECT max(date) FROM train) - {SPEC.val_days - 1} THEN 'val' ELSE 'train' END AS split,
                   count(*) AS n_rows, sum(sales) AS sales
            FROM sold GROUP BY 1, 2""",
        "sold",
        "train",
    ),
    "baseline_scores": with_ctes(_board("val", _BASELINES), "val"),
    "scores_by_family": with_ctes(
        f"SELECT family, {_scores('sales', 'pred_seasonal_naive')} FROM val GROUP BY family", "val"
    ),
    "scores_on_test": with_ctes(
        f"""SELECT {_scores('actual', 'sales_pred')}
            FROM horizon JOIN (SELECT id, sales AS actual FROM sold WHERE date >= {TEST}) USING (id)""",
        "horizon",
        "sold",
    ),
    "series_inspection": with_ctes(
        f"""SELECT store_nbr, family, date, sales, {rounded('pred_seasonal_naive')} AS pred_seasonal_naive,
                   {rounded('pred_naive')} AS pred_naive FROM val""",
        "val",
    ),
    "blend_weights": with_ctes(_board("val", _BLENDS), "val"),
    "residual_corr": with_ctes(
        f"""SELECT {rounded("corr(ln(1 + sales) - ln(1 + pred_naive), ln(1 + sales) - ln(1 + pred_moving_average))", 6)}
                   AS residual_corr FROM val""",
        "val",
    ),
    "benchmark_table": with_ctes(
        f"""SELECT model, round(rmsle, 4) AS rmsle, round(mae, 2) AS mae, round(rmse, 2) AS rmse,
                   round(wape_pct, 2) AS wape_pct, round(bias_pct, 2) AS bias_pct,
                   row_number() OVER (ORDER BY rmsle, model) = 1 AS is_champion
            FROM ({_board('val', _BASELINES)})""",
        "val",
    ),
    "dataset_sizes": with_ctes(
        " UNION ALL ".join(
            [
                _profile_row("train", 6, True),
                _profile_row("test", 5, True),
                _profile_row("stores", 5, False),
                _profile_row("oil", 2, True),
                _profile_row("holidays_events", 6, True),
                _profile_row("transactions", 3, True),
            ]
        ),
        "train", "test", "stores", "oil", "holidays", "transactions",
    ),
    "daily_totals": with_ctes("SELECT date, sum(sales) AS sales FROM train GROUP BY date", "train"),
    "shock_day_total": with_ctes(
        f"SELECT date, sum(sales) AS sales FROM train WHERE date = DATE '{SPEC.shock_start}' GROUP BY date", "train"
    ),
    "zero_share": with_ctes(
        f"SELECT {rounded('avg((sales = 0)::INTEGER) * 100', 6)} AS zero_pct FROM {_FILLED}", "grid"
    ),
    "zero_share_by_family": with_ctes(
        f"SELECT family, {rounded('avg((sales = 0)::INTEGER) * 100', 6)} AS zero_pct FROM {_FILLED} GROUP BY family",
        "grid",
    ),
    "weekday_profile": with_ctes(
        f"""SELECT (isodow(date) - 1)::INTEGER AS dayofweek, dayname(date) AS day_name,
                   {rounded('avg(sales)', 6)} AS mean_sales FROM train GROUP BY 1, 2""",
        "train",
    ),
    "month_day_profile": with_ctes(
        f"SELECT day(date)::INTEGER AS day, {rounded('avg(sales)', 6)} AS mean_sales FROM train GROUP BY 1", "train"
    ),
    "year_totals": with_ctes(
        f"SELECT year(date)::INTEGER AS year, {rounded('sum(sales) / 1e6', 6)} AS sales_millions FROM train GROUP BY 1",
        "train",
    ),
    "month_year_matrix": with_ctes(
        "SELECT month(date)::INTEGER AS month, "
        + ", ".join(
            f"{rounded(f'avg(sales) FILTER (WHERE year(date) = {y})', 6)} AS y{y}"
            for y in range(SPEC.calendar_start.year, SPEC.calendar_end.year + 1)
        )
        + " FROM train GROUP BY 1",
        "train",
    ),
    "promo_share_by_month": with_ctes(
        f"""SELECT strftime(date, '%Y-%m') AS period, {rounded('avg((onpromotion > 0)::INTEGER) * 100', 6)} AS promo_pct
            FROM train GROUP BY 1""",
        "train",
    ),
    "pareto": with_ctes(
        f"""SELECT family, sales, {rounded('share', 6)} AS share_pct,
                   {rounded('sum(share) OVER (ORDER BY sales DESC, family ROWS UNBOUNDED PRECEDING)', 6)} AS cumulative_pct
            FROM (SELECT family, sum(sales) AS sales, sum(sales) / (SELECT sum(sales) FROM train) * 100 AS share
                  FROM train GROUP BY family)
            ORDER BY sales DESC, family LIMIT 15""",
        "train",
    ),
    "store_totals": with_ctes(f"SELECT * FROM {_STORE_TOTALS}", "train", "stores"),
    "store_type_boxes": with_ctes(
        f"""SELECT type, q1, median, q3,
                   min(sales) FILTER (WHERE sales BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_low,
                   max(sales) FILTER (WHERE sales BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_high,
                   count(*) FILTER (WHERE sales NOT BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS n_outliers
            FROM {_STORE_TOTALS} JOIN (
              SELECT type, quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.5) AS median,
                     quantile_cont(sales, 0.75) AS q3 FROM {_STORE_TOTALS} GROUP BY type) USING (type)
            GROUP BY ALL""",
        "train",
        "stores",
    ),
    "top_cities": with_ctes(
        f"SELECT city, sum(sales) AS sales FROM {_STORE_TOTALS} GROUP BY city ORDER BY sales DESC, city LIMIT 10",
        "train",
        "stores",
    ),
    "top_families": with_ctes(
        "SELECT family, sum(sales) AS sales FROM train GROUP BY family ORDER BY sales DESC, family LIMIT 15", "train"
    ),
    "forecast_kpis": with_ctes(
        f"""SELECT store_nbr, family, {rounded('sum(sales_pred)')} AS total_forecast,
                   {rounded('avg(sales_pred)')} AS mean_forecast,
                   max(date) FILTER (WHERE place = 1) AS peak_date, count(*) AS horizon_days
            FROM (SELECT *, row_number() OVER (PARTITION BY store_nbr, family
                                               ORDER BY round(sales_pred, 9) DESC, date) AS place FROM horizon)
            GROUP BY ALL""",
        "horizon",
    ),
    "planned_promotions": with_ctes(
        "SELECT store_nbr, family, trunc(avg(onpromotion))::INTEGER AS planned FROM horizon GROUP BY ALL", "horizon"
    ),
    "store_cards": with_ctes("SELECT * FROM stores WHERE store_nbr IN (SELECT store_nbr FROM train)", "stores", "train"),
    "last_history": with_ctes(
        digest("grid", ["store_nbr", "family"], ["sales", "onpromotion"], f"date BETWEEN {TEST} - 60 AND {TEST} - 1"),
        "grid",
    ),
    "demand_view": with_ctes(
        digest(
            f"""(SELECT store_nbr, family, date, onpromotion, 'actual' AS kind, sales AS units FROM grid
                 WHERE date BETWEEN {TEST} - 60 AND {TEST} - 1
                 UNION ALL SELECT store_nbr, family, date, onpromotion, 'forecast', sales_pred FROM horizon)""",
            ["store_nbr", "family", "kind"],
            ["units", "onpromotion"],
        ),
        "grid",
        "horizon",
    ),
    "submitted_forecasts": with_ctes(
        f"""SELECT store_nbr, family, strftime(date, '%Y-%m-%d') AS day, onpromotion AS active_promotions,
                   {rounded('sales_pred', 2)} AS forecast_units FROM horizon WHERE id IS NOT NULL""",
        "horizon",
    ),
    "submission": with_ctes(
        f"SELECT id, {rounded('sales_pred')} AS sales FROM horizon WHERE id IS NOT NULL", "horizon"
    ),
    "promo_scenarios": with_ctes(
        f"""SELECT store_nbr, boost_pct, count(*) AS n_rows, {rounded('sum(sales_pred)')} AS base,
                   {rounded('sum(sales_pred * (1 + boost_pct / 100 * 0.35::DOUBLE))')} AS simulated
            FROM horizon CROSS JOIN {_BOOSTS} GROUP BY ALL""",
        "horizon",
    ),
    "promo_plan": with_ctes(
        f"""SELECT store_nbr, family, planned, boost_pct,
                   trunc(planned * (1 + boost_pct / 100))::INTEGER AS simulated
            FROM (SELECT store_nbr, family, trunc(avg(onpromotion))::INTEGER AS planned
                  FROM horizon WHERE id IS NOT NULL GROUP BY ALL) CROSS JOIN {_BOOSTS}""",
        "horizon",
    ),
    "forecast_slice": with_ctes(
        f"""SELECT request_id, c.store_nbr, c.family, (count(*) OVER (PARTITION BY request_id))::INTEGER AS forecast_horizon,
                   h.date, {rounded('sales_pred', 2)} AS predicted_sales
            FROM checked c JOIN horizon h
                 ON c.store_nbr = h.store_nbr AND c.family = h.family AND h.date BETWEEN c.start_date AND c.end_date
            WHERE c.reason IS NULL""",
        "checked",
    ),
    "request_rejects": with_ctes("SELECT * FROM checked WHERE reason IS NOT NULL", "checked"),
    "catalogue_health": with_ctes(
        """SELECT count(DISTINCT store_nbr) AS n_stores, count(DISTINCT family) AS n_families, count(*) AS n_rows,
                  min(date) AS first_date, max(date) AS last_date,
                  count(DISTINCT store_nbr) * count(DISTINCT family) AS n_series
           FROM grid""",
        "grid",
    ),
}

_RECENT = f"date BETWEEN {TEST} - 60 AND {END}"
ORACLES["raw_round_trip"] = ORACLES["typed_sales"]
ORACLES["layer_round_trip"] = with_ctes(
    f"""SELECT family, count(*) AS n_rows, {rounded('sum(sales)')} AS sales, sum(onpromotion)::BIGINT AS onpromotion,
               0::BIGINT AS n_late
        FROM grid WHERE {_RECENT} GROUP BY family""",
    "grid",
)
ORACLES["report_round_trip"] = with_ctes(
    f"""SELECT family, CASE n_rows % 4 WHEN 0 THEN 'said "' || family || '", then' || chr(10) || 'left, '
                                      WHEN 2 THEN ' a ' || chr(92) || ' b ' END AS note,
               n_rows, {rounded('sales')} AS sales
        FROM (SELECT family, count(*) AS n_rows, sum(sales) AS sales FROM train GROUP BY family)""",
    "train",
)
ORACLES["oil_by_region"] = with_ctes(
    digest(
        "(SELECT * FROM grid LEFT JOIN stores USING (store_nbr) LEFT JOIN regional_daily USING (state, date))",
        ["store_nbr", "state"],
        ["dcoilwtico", "oil_ma7", "oil_ma30"],
        digits=(4, 2, 2),
    ),
    "grid", "stores", "regional_daily",
)
# A day is asked for if some request spans it; a span starts on each such day whose day before is not.
ORACLES["asked_days"] = with_ctes(
    f"""SELECT store_nbr, family, count(*) FILTER (WHERE before IS NULL OR before < day - 1) AS n_spans,
               min(day) AS first_day, count(*) AS n_days,
               count(*) FILTER (WHERE day BETWEEN {TEST} - 60 AND {END}
                                      AND store_nbr IN (SELECT store_nbr FROM train) AND family IN (SELECT family FROM train)) AS n_rows
        FROM (SELECT *, lag(day) OVER (PARTITION BY store_nbr, family ORDER BY day) AS before
              FROM (SELECT DISTINCT store_nbr, family, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY))::DATE AS day
                    FROM (SELECT store_nbr, family, start_date,
                                 CASE WHEN k % 17 > 0 THEN start_date + (k % 4 - 1)::INTEGER ELSE {END} END AS end_date
                          FROM (SELECT c_custkey AS k, c_custkey % 12 AS store_nbr,
                                       CASE WHEN c_custkey % 5 < 4 THEN 'PROMO' ELSE 'SMALL' END AS family,
                                       {TEST} - (c_custkey * 13 % 60)::INTEGER AS start_date FROM customer))))
        GROUP BY ALL""",
    "train",
)

# What must hold of fitted models on any data, as far as SQL can say it.
ORACLES["gbt_scores"] = with_ctes(
    """SELECT model, n AS n_scored, n AS n_not_negative, TRUE AS no_worse_than_naive
       FROM (VALUES ('Boosted trees, leaf-wise'), ('Boosted trees, depth-wise'), ('Blend 50% + 50%'), ('Naive (Lag 16)')) m(model),
            (SELECT count(sales) AS n FROM val) v""",
    "val",
)
ORACLES["gbt_importance"] = (
    f"""SELECT {len(FEATURE_NAMES)}::BIGINT AS n_features, {len(FEATURE_NAMES)}::BIGINT AS n_known, 1.0::DOUBLE AS gain,
               TRUE AS splits_are_inner_nodes, 0::BIGINT AS n_negative"""
)
