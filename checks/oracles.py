"""DuckDB statements that the Spark queries must agree with. Written from the rules, not from the Spark plans."""

from __future__ import annotations

from evenhand.fixed_values import BASELINE_FEATURES, FAIR_FEATURES, FOREST, borough_rows, zone_rows


def r(x: str, n: int) -> str:
    """Half-up rounding of a double by its decimal text."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def sr(x: str, n: int) -> str:
    return r(r(x, 9), n)


def even(x: str, n: int) -> str:
    """Rounding of a double by its decimal text, ties to even."""
    d = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20))"
    half, unit = "0." + "0" * n + "5", ("0." + "0" * (n - 1) + "1") if n else "1"
    up = f"round({d}, {n})"
    odd = f"CAST(abs({up}) * {10 ** n} AS HUGEINT) % 2 = 1"
    return f"CAST(CASE WHEN abs({up} - {d}) = {half} AND {odd} THEN {up} - sign({d}) * {unit} ELSE {up} END AS DOUBLE)"


def sb(x: str, n: int) -> str:
    return even(r(x, 9), n)


def dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def _values(rows) -> str:
    cell = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else dbl(v) if isinstance(v, float) else str(v)
    return ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)


ZONES = f"zones(priority, y0, y1, x0, x1, zip, borough, neighborhood) AS (VALUES {_values(zone_rows())})"
BOROUGHS = f"boroughs(priority, y0, y1, x0, x1, borough) AS (VALUES {_values(borough_rows())})"

TRIPS = f"""
numbered AS (
  SELECT *, l_orderkey * 7 + l_linenumber * 131 + l_partkey * 17 + l_suppkey * 29 AS h FROM lineitem),
timed AS (SELECT *, l_shipdate + to_seconds(h % 86400) AS pickup FROM numbered),
trips AS (
  SELECT CAST(1 + l_linenumber % 2 AS INTEGER) AS VendorID,
    pickup AS tpep_pickup_datetime,
    pickup + to_seconds(h * 13 % 7200) AS tpep_dropoff_datetime,
    CAST(h % 11 AS INTEGER) AS passenger_count,
    CASE WHEN h % 50 = 0 THEN {dbl(0.0)} ELSE l_quantity / 4 END AS trip_distance,
    CASE WHEN h % 89 = 0 THEN {dbl(0.0)} ELSE {dbl(-74.05)} + CAST(h * 5 % 230 AS DOUBLE) / 1000 END AS pickup_longitude,
    CASE WHEN h % 89 = 0 THEN {dbl(0.0)} ELSE {dbl(40.56)} + CAST(h * 3 % 350 AS DOUBLE) / 1000 END AS pickup_latitude,
    CAST(h % 6 + 1 AS INTEGER) AS RatecodeID,
    CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    {dbl(-74.05)} + CAST(h * 19 % 230 AS DOUBLE) / 1000 AS dropoff_longitude,
    {dbl(40.56)} + CAST(h * 11 % 350 AS DOUBLE) / 1000 AS dropoff_latitude,
    CAST(h % 4 + 1 AS INTEGER) AS payment_type,
    CASE WHEN h % 101 = 0 THEN NULL ELSE {r('l_extendedprice / 2000', 2)} END AS fare_amount,
    l_discount, h
  FROM timed),
priced AS (
  SELECT *, {r('fare_amount * l_discount', 2)} AS tip_amount, {r(f'fare_amount * {dbl(1.2)}', 2)} AS total_amount FROM trips)"""

COMPLETE = """tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND pickup_longitude IS NOT NULL
  AND pickup_latitude IS NOT NULL AND dropoff_longitude IS NOT NULL AND dropoff_latitude IS NOT NULL
  AND trip_distance IS NOT NULL AND fare_amount IS NOT NULL"""
LOCATED = "pickup_longitude <> 0 AND pickup_latitude <> 0 AND dropoff_longitude <> 0 AND dropoff_latitude <> 0"
PLAUSIBLE = f"""fare_amount >= 2.5 AND fare_amount <= 500 AND trip_distance > 0 AND trip_distance <= 100
  AND trip_duration_minutes > 0 AND trip_duration_minutes <= 300 AND speed_mph <= 100
  AND passenger_count > 0 AND passenger_count <= 9
  AND pickup_latitude BETWEEN {dbl(40.49)} AND {dbl(40.92)} AND pickup_longitude BETWEEN {dbl(-74.27)} AND {dbl(-73.68)}
  AND dropoff_latitude BETWEEN {dbl(40.49)} AND {dbl(40.92)} AND dropoff_longitude BETWEEN {dbl(-74.27)} AND {dbl(-73.68)}"""

FEATURES = f"""
lasting AS (
  SELECT *, {r("CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) / 60", 2)}
      AS trip_duration_minutes,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week
  FROM priced),
featured AS (
  SELECT *,
    CASE WHEN trip_duration_minutes > 0 THEN {r('trip_distance / (trip_duration_minutes / 60)', 2)} ELSE 0 END AS speed_mph,
    ((hour_of_day BETWEEN 7 AND 9) OR (hour_of_day BETWEEN 17 AND 19)) AND (day_of_week BETWEEN 2 AND 6) AS is_rush_hour,
    day_of_week IN (1, 7) AS is_weekend,
    hour_of_day >= 22 OR hour_of_day <= 5 AS is_night,
    CASE WHEN trip_distance <> 0 THEN {r('fare_amount / trip_distance', 2)} END AS fare_per_mile,
    CAST({even('pickup_latitude', 2)} AS VARCHAR) || '_' || CAST({even('pickup_longitude', 2)} AS VARCHAR) AS pickup_zone,
    substr(sha256(concat_ws('|', CAST(tpep_pickup_datetime AS VARCHAR), CAST(pickup_latitude AS VARCHAR),
      CAST(pickup_longitude AS VARCHAR), CAST(fare_amount AS VARCHAR), CAST(trip_distance AS VARCHAR))), 1, 16) AS trip_id
  FROM lasting)"""

CLEAN = f"clean AS (SELECT *, row_number() OVER () AS rid FROM featured WHERE {COMPLETE} AND {LOCATED} AND {PLAUSIBLE})"
CLEAN_COLUMNS = """trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, pickup_longitude,
  pickup_latitude, dropoff_longitude, dropoff_latitude, fare_amount, total_amount, trip_duration_minutes, speed_mph,
  hour_of_day, day_of_week, is_rush_hour, is_weekend, is_night, fare_per_mile, pickup_zone"""


def census(missing: str = "FALSE") -> str:
    return f"""
coded AS (SELECT c_custkey % 80 AS i, * FROM customer),
census AS (
  SELECT CASE WHEN {missing} THEN CAST(20000 + i AS VARCHAR) WHEN i < 70 THEN z.zip ELSE CAST(1000 + i AS VARCHAR) END AS ZIP,
    CASE WHEN c_custkey % 37 = 0 THEN '-'
      ELSE CAST(25000 + (i * 1237) % 80000 + CAST(floor(c_acctbal / 10) AS BIGINT) AS VARCHAR) END AS income_text
  FROM coded LEFT JOIN zones z ON z.priority = i AND i < 70)"""


def incomes(tested: str = "ZIP") -> str:
    return f"""
incomes AS (
  SELECT lpad(ZIP, 5, '0') AS zip, {sr('avg(TRY_CAST(income_text AS DOUBLE))', 0)} AS median_income
  FROM census WHERE TRY_CAST(income_text AS DOUBLE) > 0 AND ({tested} LIKE '10%' OR {tested} LIKE '11%') GROUP BY 1)"""


MATCHED = """
matched AS (
  SELECT c.rid, arg_min(z.zip, z.priority) AS pickup_zip, arg_min(z.borough, z.priority) AS borough,
    arg_min(z.neighborhood, z.priority) AS neighborhood
  FROM clean c JOIN zones z ON c.pickup_latitude >= z.y0 AND c.pickup_latitude < z.y1
    AND c.pickup_longitude >= z.x0 AND c.pickup_longitude < z.x1
  GROUP BY c.rid)"""

ENRICHED = """
withincome AS (
  SELECT c.*, m.pickup_zip, m.borough, m.neighborhood, coalesce(i.median_income, 60000) AS median_income
  FROM clean c JOIN matched m USING (rid) LEFT JOIN incomes i ON i.zip = m.pickup_zip),
enriched AS (
  SELECT *, CASE WHEN median_income >= 75000 THEN 'high' WHEN median_income >= 45000 THEN 'medium' ELSE 'low' END
    AS income_category FROM withincome)"""

PREDICTED = f"""
guessed AS (
  SELECT *,
    fare_amount * CASE income_category WHEN 'low' THEN {dbl(1.23)} WHEN 'medium' THEN {dbl(1.09)} ELSE {dbl(1.02)} END
      + CAST(h % 101 - 50 AS DOUBLE) / 100 AS predicted_fare_baseline,
    fare_amount * {dbl(1.02)} + CAST(h * 7 % 101 - 50 AS DOUBLE) / 100 AS predicted_fare_fair
  FROM enriched),
predicted AS (
  SELECT *, predicted_fare_baseline - fare_amount AS baseline_error, predicted_fare_fair - fare_amount AS fair_error,
    abs(predicted_fare_baseline - fare_amount) AS baseline_abs_error,
    abs(predicted_fare_fair - fare_amount) AS fair_abs_error
  FROM guessed)"""

RAW = f"WITH {TRIPS}"
WITH_FEATURES = f"WITH {TRIPS}, {FEATURES}"
WITH_CLEAN = f"{WITH_FEATURES}, {CLEAN}"
PLANTED = """planted AS (SELECT * REPLACE (CASE WHEN h % 41 <> 0 THEN fare_amount END AS fare_amount,
  CASE WHEN h % 43 <> 0 THEN passenger_count END AS passenger_count) FROM priced)"""
WITH_PLANTED_FEATURES = f"WITH {TRIPS}, {PLANTED}, {FEATURES.replace('FROM priced', 'FROM planted')}"
WITH_MATCHED = f"{WITH_CLEAN}, {ZONES}, {MATCHED}"
WITH_ENRICHED = f"{WITH_MATCHED}, {census()}, {incomes()}, {ENRICHED}"
WITH_PREDICTED = f"{WITH_ENRICHED}, {PREDICTED}"

OC = {m: f"(avg(predicted_fare_{m}) - avg(fare_amount)) / avg(fare_amount) * 100" for m in ("baseline", "fair")}


def mean(x: str, n: int = 2) -> str:
    return sr(f"avg({x})", n)


def _bias_rows() -> str:
    parts = []
    for m in ("baseline", "fair"):
        parts.append(
            f"""SELECT '{m}' AS model, income_category, count(*) AS trip_count, {mean('trip_distance')} AS avg_distance,
            {mean('fare_amount')} AS avg_actual, {mean(f'predicted_fare_{m}')} AS avg_predicted,
            {mean(f'{m}_error')} AS avg_error, {sr(OC[m], 1)} AS overcharge_pct FROM predicted GROUP BY income_category"""
        )
    return " UNION ALL ".join(parts)


def _rounded(where: str, pick: str) -> str:
    """Overcharge from means that were rounded first."""
    pct = lambda m: sb(f"({m} - actual) / actual * 100", 1)
    return f"""{WITH_PREDICTED}, means AS (
      SELECT income_category, count(*) AS trips, {sb('avg(trip_distance)', 2)} AS avg_dist,
        {sb('avg(fare_amount)', 2)} AS actual, {sb('avg(predicted_fare_baseline)', 2)} AS baseline,
        {sb('avg(predicted_fare_fair)', 2)} AS fair,
        {sb('avg(predicted_fare_baseline - fare_amount)', 2)} AS baseline_avg_error,
        {sb('avg(predicted_fare_fair - fare_amount)', 2)} AS fair_avg_error
      FROM predicted WHERE {where} GROUP BY 1),
    rounded AS (SELECT *, {pct('baseline')} AS baseline_oc_pct, {pct('fair')} AS fair_oc_pct FROM means)
    {pick}"""


def _tests(equal_var: bool) -> str:
    if equal_var:
        error = "sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n))"
        freedom = "CAST(a.n + b.n - 2 AS DOUBLE)"
    else:
        error = "sqrt(a.v / a.n + b.v / b.n)"
        freedom = "power(a.v / a.n + b.v / b.n, 2) / (power(a.v / a.n, 2) / (a.n - 1) + power(b.v / b.n, 2) / (b.n - 1))"
    return f"""{WITH_PREDICTED}, m AS (
      SELECT income_category AS g, count(baseline_error) AS n, avg(baseline_error) AS m, var_samp(baseline_error) AS v
      FROM predicted GROUP BY 1)
    SELECT a.g || '_vs_' || b.g AS test, a.n AS n_a, b.n AS n_b, {sr(f'(a.m - b.m) / {error}', 4)} AS t_stat,
      {sr(freedom, 2)} AS df, {sr('(a.m - b.m) / sqrt((a.v + b.v) / 2)', 4)} AS cohens_d, TRUE AS enough_rows
    FROM m a JOIN m b ON a.g = 'low' AND b.g IN ('high', 'medium') WHERE a.n > 30 AND b.n > 30"""


SCORES = """
scores AS (
  SELECT 'baseline' AS model, income_category AS g, count(*) AS n, avg(predicted_fare_baseline) AS mean_prediction,
    sqrt(avg(power(baseline_error, 2))) AS rmse FROM predicted GROUP BY 2
  UNION ALL SELECT 'fair', income_category, count(*), avg(predicted_fare_fair), sqrt(avg(power(fair_error, 2)))
  FROM predicted GROUP BY 2)"""


def _pairs(sample: int | None, tol: float) -> str:
    """Brute force: every low row against every high row."""
    cut = "" if sample is None else (
        "ORDER BY sha256(trip_id), trip_id, income_category, trip_distance, predicted_fare_baseline, predicted_fare_fair"
        f" LIMIT {sample}"
    )
    return f"""
drawn AS (
  SELECT trip_id, income_category, trip_distance, predicted_fare_baseline AS pb, predicted_fare_fair AS pf
  FROM predicted {cut}),
lows AS (SELECT *, row_number() OVER () AS lid FROM drawn WHERE income_category = 'low'),
ranked AS (
  SELECT l.trip_id, l.trip_distance AS distance, l.pb, l.pf, h.pb AS hb, h.pf AS hf, row_number() OVER (
    PARTITION BY l.lid ORDER BY abs(h.trip_distance - l.trip_distance), h.trip_distance, h.trip_id, h.pb, h.pf) AS rn
  FROM lows l JOIN drawn h ON h.income_category = 'high' AND abs(h.trip_distance - l.trip_distance) < {dbl(tol)}),
pairs AS (SELECT *, abs(pb - hb) AS db, abs(pf - hf) AS df FROM ranked WHERE rn <= 5)"""


def _grade(x: str, low: float, high: float) -> str:
    return f"CASE WHEN {x} < {low} THEN 'GOOD' WHEN {x} < {high} THEN 'MODERATE' ELSE 'POOR' END"


def _individual(sample: int | None, tol: float) -> str:
    one = lambda m, d: f"""SELECT '{m}' AS model, count(*) AS comparisons, {sr(f'avg({d})', 4)} AS score,
      {sr(f'max({d})', 6)} AS max_difference, count(*) FILTER ({d} > 3) AS violation_count,
      {_grade(f'avg({d})', 1, 3)} AS interpretation FROM pairs"""
    return f"{WITH_PREDICTED}, {_pairs(sample, tol)} {one('baseline', 'db')} UNION ALL {one('fair', 'df')}"


COMPARED = f"""{WITH_PREDICTED}, {SCORES}, {_pairs(None, 0.1)},
three AS (
  SELECT 'demographic_parity' AS metric, model, stddev_samp(mean_prediction) AS score FROM scores GROUP BY model
  UNION ALL SELECT 'equalized_odds', model, stddev_pop(rmse) FROM scores GROUP BY model
  UNION ALL SELECT 'individual_fairness', 'baseline', avg(db) FROM pairs
  UNION ALL SELECT 'individual_fairness', 'fair', avg(df) FROM pairs),
gains AS (
  SELECT b.metric, b.score AS baseline_score, f.score AS fair_score,
    CASE WHEN b.score > 0 THEN (b.score - f.score) / b.score * 100 ELSE 0 END AS improvement_pct
  FROM three b JOIN three f USING (metric) WHERE b.model = 'baseline' AND f.model = 'fair')"""

ANNUAL = dbl(165000000.0)


def _impact(part: float) -> str:
    scale = f"({ANNUAL} / (count(*) / {dbl(part)}))"
    low = "count(*) FILTER (income_category = 'low')"
    avg = "avg(baseline_error) FILTER (income_category = 'low')"
    return f"""{WITH_PREDICTED} SELECT count(*) AS rows, {low} AS group_rows,
      {sr(f'CAST({low} AS DOUBLE) * 100 / count(*)', 4)} AS group_share_pct, {sr(avg, 4)} AS avg_overcharge,
      {sr(f'{low} * {scale}', 0)} AS annual_trips, {sr(f'{low} * {scale} * {avg}', 0)} AS annual_impact_usd,
      {sr(f'{low} * {scale} * {avg} * 83', 0)} AS annual_impact_inr FROM predicted"""


DESCRIBED = ("fare_amount", "trip_distance", "trip_duration_minutes", "speed_mph")
BOROUGH_CASE = f"""
placed AS (
  SELECT *, CASE WHEN pickup_latitude <> 0 AND pickup_longitude <> 0 THEN (
    SELECT arg_min(b.borough, b.priority) FROM boroughs b
    WHERE pickup_latitude BETWEEN b.y0 AND b.y1 AND pickup_longitude BETWEEN b.x0 AND b.x1) END AS found
  FROM priced)"""
WITH_PLACED = f"{RAW}, {BOROUGHS}, {BOROUGH_CASE}"

ROUND_TRIP_SUMS = f"""count(*) AS n, count(fare_amount) AS fares, {sr('sum(fare_amount)', 2)} AS fare_sum,
  {sr('sum(trip_distance)', 2)} AS distance_sum, min(tpep_pickup_datetime) AS first_pickup,
  max(tpep_dropoff_datetime) AS last_dropoff, {sr('sum(pickup_latitude)', 3)} AS latitude_sum"""


def _group_mean(by: str, extra: str = "") -> str:
    return f"""{WITH_CLEAN} SELECT {by}, count(*) AS trip_count, {mean('fare_amount')} AS avg_fare,
      {mean('trip_distance')} AS avg_distance FROM clean GROUP BY {by}"""


SUMMARY = f"""SELECT income_category, count(*) AS trip_count, {mean('trip_distance')} AS avg_distance,
  {mean('fare_amount')} AS avg_actual_fare, {mean('predicted_fare_baseline')} AS baseline_predicted,
  {mean('predicted_fare_fair')} AS fair_predicted, {mean('baseline_error')} AS baseline_avg_error,
  {mean('fair_error')} AS fair_avg_error, {sr(OC['baseline'], 1)} AS baseline_overcharge_pct,
  {sr(OC['fair'], 1)} AS fair_overcharge_pct, {mean('median_income', 0)} AS avg_area_income
  FROM predicted GROUP BY income_category"""


def _improvement() -> str:
    gain = "floor(" + r("(abs(b) - abs(f)) / abs(b) * 100", 9) + " + 0.5)"
    return f"""{WITH_PREDICTED}, s AS ({SUMMARY}),
      p AS (SELECT income_category, baseline_overcharge_pct AS b, fair_overcharge_pct AS f FROM s)
      SELECT income_category, b AS baseline_overcharge_pct, f AS fair_overcharge_pct,
        CAST(CASE WHEN abs(b) > 0.1 THEN {gain} ELSE 0 END AS BIGINT) AS improvement_pct FROM p"""


def _p_values(error: str) -> str:
    """Welch's t and its two-sided p: Simpson's rule over the density from 0 to |t|."""
    return f"""m AS (
        SELECT income_category AS g, count(*) AS n, avg({error}) AS m, var_samp({error}) AS v FROM predicted GROUP BY 1),
      w AS (SELECT a.g || '_vs_' || b.g AS test, (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t, (a.m - b.m) / sqrt((a.v + b.v) / 2) AS d,
          power(a.v / a.n + b.v / b.n, 2) / (power(a.v / a.n, 2) / (a.n - 1) + power(b.v / b.n, 2) / (b.n - 1)) AS f
        FROM m a JOIN m b ON a.g = 'low' AND b.g IN ('high', 'medium') WHERE a.n > 30 AND b.n > 30),
      s AS (SELECT test, t, d, f, sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
          * power(1 + power(abs(t) * i / 4000, 2) / f, -(f + 1) / 2)) * abs(t) / 12000 AS area
        FROM w, range(4001) AS steps(i) GROUP BY test, t, d, f),
      p AS (SELECT test, t, d, greatest(0, 1 - 2 * area * exp(lgamma((f + 1) / 2) - lgamma(f / 2)) / sqrt(f * pi())) AS p FROM s)"""


def _reports() -> dict[str, str]:
    low = "income_category = 'low'"
    high = "income_category = 'high'"
    shown = []
    for test in ("low_vs_high", "low_vs_medium"):
        values = {
            "t_stat": sr("t", 4), "p_value": sr("p", 6), "cohens_d": sr("d", 4), "significant": "p < 0.05", "enough_rows": "TRUE",
            "effect_size": "CASE WHEN abs(d) > 0.8 THEN 'large' WHEN abs(d) > 0.5 THEN 'medium' ELSE 'small' END",
        }
        shown += [f"(SELECT {sql} FROM p WHERE test = '{test}') AS {test}_{name}" for name, sql in values.items()]
    pick = f""", {_p_values('baseline_error')} SELECT max(baseline_oc_pct) FILTER ({low}) AS low_pct, max(baseline_oc_pct) FILTER ({high}) AS high_pct,
      max(fair_oc_pct) FILTER ({low}) AS fair_low_pct,
      {r(f'max(baseline_oc_pct) FILTER ({low}) - max(baseline_oc_pct) FILTER ({high})', 9)} AS bias_pp,
      (SELECT {sr(f'avg(baseline_error) FILTER ({low})', 4)} FROM predicted) AS overcharge_per_trip,
      (SELECT {sr(f"count(*) FILTER ({low}) * ({ANNUAL} / count(*))", 0)} FROM predicted) AS annual_trips,
      (SELECT {sr(f"count(*) FILTER ({low}) * ({ANNUAL} / count(*)) * avg(baseline_error) FILTER ({low})", 0)} FROM predicted) AS annual_usd,
      {', '.join(shown)}
      FROM rounded"""
    kept = _rounded("TRUE", pick)
    return {"bias_report": kept, "report_json_roundtrip": f"SELECT bias_pp, overcharge_per_trip FROM ({kept})"}


# What forests are scored on: rows held back by their hash, of those that can be learned from.
HELD_BACK = "CAST(('0x' || substr(sha256(CAST(h AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 >= 8000"
USABLE = "fare_amount > 0 AND trip_distance > 0 AND trip_duration_minutes > 0"

ORACLES: dict[str, str] = {
    # cleaning and features
    "null_critical_drop": f"{RAW} SELECT h, fare_amount, trip_distance FROM priced WHERE {COMPLETE}",
    "clean_trips": f"{WITH_CLEAN} SELECT {CLEAN_COLUMNS} FROM clean",
    "clean_funnel": f"""{WITH_FEATURES}, steps AS (SELECT count(*) AS initial_rows,
        count(*) FILTER ({COMPLETE}) AS after_nulls, count(*) FILTER ({COMPLETE} AND {LOCATED}) AS after_zero_gps,
        count(*) FILTER ({COMPLETE} AND {LOCATED} AND {PLAUSIBLE}) AS after_outliers FROM featured)
      SELECT *, {r('CAST(initial_rows - after_outliers AS DOUBLE) / initial_rows * 100', 1)} AS removed_pct FROM steps""",
    "audit_clean_once": f"""{WITH_PLANTED_FEATURES}, steps AS (SELECT count(*) AS initial_rows,
        count(*) FILTER ({COMPLETE}) AS after_nulls, count(*) FILTER ({COMPLETE} AND {LOCATED}) AS after_zero_gps,
        count(*) FILTER ({COMPLETE} AND {LOCATED} AND {PLAUSIBLE}) AS after_outliers,
        count(*) FILTER (h % 41 = 0 OR h % 43 = 0) AS faulty_rows, count(*) FILTER (h % 41 = 0) AS lost_fares,
        count(*) FILTER (h % 43 = 0) AS lost_passengers FROM featured)
      SELECT *, {r('CAST(initial_rows - after_outliers AS DOUBLE) / initial_rows * 100', 1)} AS removed_pct,
        after_outliers AS cleaned_rows, faulty_rows AS faulty_lines FROM steps""",
    "clean_variant_wide_box": f"""{RAW} SELECT h, fare_amount, trip_distance, pickup_latitude, pickup_longitude FROM priced
      WHERE fare_amount >= 2.5 AND fare_amount <= 500 AND trip_distance > 0 AND trip_distance <= 100
      AND pickup_longitude BETWEEN -74.5 AND -73.5 AND pickup_latitude BETWEEN {dbl(40.4)} AND 41""",
    "typed_normalise": f"""{RAW} SELECT h, CAST(CASE WHEN h % 13 <> 0 AND h % 17 <> 0 AND h % 23 <> 0
          THEN passenger_count END AS INTEGER) AS passenger_count,
        CASE WHEN h % 19 = 0 OR h % 29 = 0 THEN NULL WHEN h % 31 = 0 THEN 25 ELSE {r('fare_amount', 6)} END AS fare_amount,
        {r('pickup_latitude', 6)} AS pickup_latitude,
        CASE WHEN h % 7 <> 0 THEN store_and_fwd_flag END AS store_and_fwd_flag FROM priced""",
    "trip_features": f"""{WITH_FEATURES} SELECT h, trip_duration_minutes, speed_mph, hour_of_day, day_of_week,
        is_rush_hour, is_weekend, is_night FROM featured""",
    "rush_weekend_night_counts": f"""{WITH_CLEAN} SELECT is_rush_hour, is_weekend, is_night, count(*) AS trips
      FROM clean GROUP BY ALL""",
    "fare_per_mile": f"{WITH_FEATURES} SELECT h, trip_distance, fare_per_mile FROM featured",
    "grid_zone_key": f"{WITH_FEATURES} SELECT pickup_zone, count(*) AS trips FROM featured GROUP BY 1",
    "trip_id_hash": f"{WITH_FEATURES} SELECT h, trip_id FROM featured",
    "describe_numeric": WITH_CLEAN + " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, {sr(f'avg({c})', 4)} AS mean, {sr(f'stddev_samp({c})', 4)} AS stddev,
        min({c}) AS min, max({c}) AS max FROM clean""" for c in DESCRIBED),
    "quartiles": WITH_CLEAN + " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, {dbl(p)} AS prob, {sr(f'quantile_cont({c}, {p})', 6)} AS value
        FROM clean""" for c in DESCRIBED for p in (0.25, 0.5, 0.75)),
    # lookup and enrichment
    **dict.fromkeys(
        ("zone_lookup_first_match", "zone_lookup_grid", "zone_lookup_shuffled"),
        f"""{WITH_MATCHED} SELECT c.h, c.pickup_latitude, c.pickup_longitude, m.pickup_zip AS zip, m.borough, m.neighborhood
        FROM clean c LEFT JOIN matched m USING (rid)"""),
    "borough_lookup_closed": f"""{WITH_PLACED} SELECT h, pickup_latitude, pickup_longitude,
        coalesce(found, 'Unknown') AS borough FROM placed""",
    "mapped_share": f"""{WITH_MATCHED} SELECT count(*) AS trips, count(m.rid) AS mapped,
        {r('CAST(count(m.rid) AS DOUBLE) / count(*) * 100', 1)} AS mapped_pct FROM clean c LEFT JOIN matched m USING (rid)""",
    "income_by_zip": f"WITH {ZONES}, {census()}, {incomes()} SELECT * FROM incomes",
    "income_by_zip_padded": f"""WITH {ZONES}, {census()}, {incomes("lpad(ZIP, 5, '0')")} SELECT * FROM incomes""",
    "income_range": f"""WITH {ZONES}, {census()}, {incomes()} SELECT min(median_income) AS min_income,
        {mean('median_income', 0)} AS avg_income, max(median_income) AS max_income FROM incomes""",
    **dict.fromkeys(
        ("enrich_income", "enrich_income_salted"),
        f"""{WITH_MATCHED}, {census('i % 7 = 0')}, {incomes()}, {ENRICHED}
        SELECT h, pickup_zip, median_income, income_category FROM enriched"""),
    "enriched_trips": f"""{WITH_ENRICHED} SELECT {CLEAN_COLUMNS}, pickup_zip, borough, neighborhood, median_income,
        income_category FROM enriched""",
    "income_category_profile": f"""{WITH_ENRICHED} SELECT income_category, count(*) AS trip_count,
        {mean('fare_amount')} AS avg_fare, {mean('trip_distance')} AS avg_distance,
        {mean('median_income', 0)} AS avg_area_income FROM enriched GROUP BY 1""",
    "income_bins_right_closed": f"""WITH {ZONES}, {census()}, entries AS (
        SELECT CASE WHEN TRY_CAST(income_text AS DOUBLE) IS NOT NULL
        THEN least(greatest(TRY_CAST(income_text AS DOUBLE), 15000), 200000) END AS income FROM census),
      snapped AS (SELECT CASE WHEN income BETWEEN 44000 AND 46000 THEN 45000 WHEN income BETWEEN 74000 AND 76000 THEN 75000
        ELSE income END AS income FROM entries)
      SELECT CASE WHEN income <= 45000 THEN 'low' WHEN income <= 75000 THEN 'medium' WHEN income > 75000 THEN 'high' END
        AS income_bin, CASE WHEN income IS NULL THEN NULL WHEN income >= 75000 THEN 'high' WHEN income >= 45000
        THEN 'medium' ELSE 'low' END AS income_band, count(*) AS n FROM snapped GROUP BY 1, 2""",
    # views and ad hoc reports
    "v_income_fare_summary": f"""{WITH_ENRICHED} SELECT income_category, count(*) AS trip_count,
        {mean('trip_distance')} AS avg_distance, {mean('fare_amount')} AS avg_fare, {mean('fare_per_mile')}
        AS avg_fare_per_mile, {mean('median_income', 0)} AS avg_median_income FROM enriched GROUP BY 1""",
    "v_borough_stats": f"""{WITH_ENRICHED} SELECT borough, count(*) AS trip_count, {mean('fare_amount')} AS avg_fare,
        {mean('trip_distance')} AS avg_distance, {mean('median_income', 0)} AS avg_income FROM enriched GROUP BY 1""",
    "v_hourly_demand": f"""{WITH_ENRICHED} SELECT hour_of_day, income_category, count(*) AS trip_count,
        {mean('fare_amount')} AS avg_fare FROM enriched GROUP BY 1, 2""",
    "v_bias_comparison": f"""{WITH_PREDICTED} SELECT income_category, count(*) AS trips, {mean('fare_amount')} AS avg_actual,
        {mean('predicted_fare_baseline')} AS baseline_avg, {mean('predicted_fare_fair')} AS fair_avg,
        {sr(OC['baseline'], 1)} AS baseline_oc_pct, {sr(OC['fair'], 1)} AS fair_oc_pct FROM predicted GROUP BY 1""",
    "trips_by_borough": f"{WITH_ENRICHED} SELECT borough, count(*) AS trip_count FROM enriched GROUP BY 1",
    "fare_by_income": f"""{WITH_ENRICHED} SELECT income_category, {mean('fare_amount', 6)} AS avg_fare, count(*) AS cnt
      FROM enriched GROUP BY 1""",
    "fare_per_mile_by_income": f"""{WITH_ENRICHED} SELECT income_category,
        {mean('fare_amount / nullif(trip_distance, 0)', 6)} AS fare_per_mile
      FROM enriched WHERE trip_distance > 0 GROUP BY 1""",
    "similar_distance_overcharge": f"""{WITH_PREDICTED} SELECT income_category, count(*) AS trips,
        {mean('predicted_fare_baseline')} AS baseline_pred, {mean('predicted_fare_fair')} AS fair_pred,
        {mean('fare_amount')} AS actual FROM predicted WHERE trip_distance BETWEEN 4.5 AND 5.5 GROUP BY 1""",
    "hourly_profile": _group_mean("hour_of_day"),
    "rush_vs_non_rush": _group_mean("is_rush_hour"),
    "weekend_vs_weekday": _group_mean("is_weekend"),
    "fare_by_dow": f"{WITH_CLEAN} SELECT day_of_week, {mean('fare_amount', 6)} AS avg_fare FROM clean GROUP BY 1",
    "top10_expensive": f"""{WITH_CLEAN} SELECT trip_id, fare_amount, trip_distance, tpep_pickup_datetime FROM clean
      ORDER BY fare_amount DESC, trip_id, trip_distance, tpep_pickup_datetime LIMIT 10""",
    "top10_neighborhood_overcharge": f"""{WITH_PREDICTED} SELECT neighborhood, borough, count(*) AS trips,
        {mean('predicted_fare_baseline - fare_amount')} AS avg_overcharge FROM predicted GROUP BY 1, 2
      ORDER BY avg_overcharge DESC, neighborhood, borough LIMIT 10""",
    "expensive_trip_count": f"{WITH_CLEAN} SELECT count(*) AS trips FROM clean WHERE fare_amount > 100",
    "sample_rows": f"""{WITH_ENRICHED} SELECT trip_id, fare_amount, trip_distance, borough, neighborhood, median_income,
        income_category FROM enriched
      ORDER BY trip_id, fare_amount, trip_distance, neighborhood LIMIT 10""",
    "category_share": f"""{WITH_PLACED}, n AS (SELECT coalesce(found, 'Unknown') AS borough, count(*) AS trips FROM placed GROUP BY 1)
      SELECT borough, trips, {r('CAST(trips AS DOUBLE) / sum(trips) OVER () * 100', 1)} AS share_pct,
        {r('CAST(trips AS DOUBLE) / max(trips) OVER () * 100', 1)} AS of_largest_pct FROM n""",
    # disparity
    "prediction_columns": f"""{WITH_PREDICTED} SELECT trip_id, fare_amount, predicted_fare_baseline, predicted_fare_fair,
        baseline_error, fair_error, baseline_abs_error, fair_abs_error, income_category, borough, neighborhood,
        trip_distance, trip_duration_minutes, median_income FROM predicted""",
    "bias_by_income": f"{WITH_PREDICTED} {_bias_rows()}",
    "bias_by_borough": f"""{WITH_PREDICTED} SELECT borough, count(*) AS trips, {mean('median_income', 0)} AS avg_income,
        {mean('fare_amount')} AS avg_actual, {mean('predicted_fare_baseline')} AS baseline_pred,
        {sr(OC['baseline'], 1)} AS overcharge_pct FROM predicted GROUP BY 1""",
    "bias_controlled_distance": f"""{WITH_PREDICTED} SELECT income_category, count(*) AS trips,
        {mean('trip_distance')} AS avg_dist, {mean('fare_amount')} AS actual,
        {mean('predicted_fare_baseline')} AS baseline_pred, {mean('predicted_fare_fair')} AS fair_pred,
        {sr(OC['baseline'], 1)} AS baseline_oc_pct, {sr(OC['fair'], 1)} AS fair_oc_pct
      FROM predicted WHERE trip_distance BETWEEN 4.5 AND 5.5 GROUP BY 1""",
    "bias_summary_wide": f"{WITH_PREDICTED} {SUMMARY}",
    "borough_bias_wide": f"""{WITH_PREDICTED} SELECT borough, count(*) AS trip_count, {mean('median_income', 0)} AS avg_income,
        {mean('fare_amount')} AS avg_actual_fare, {mean('predicted_fare_baseline')} AS baseline_predicted,
        {mean('predicted_fare_fair')} AS fair_predicted, {sr(OC['baseline'], 1)} AS baseline_overcharge_pct,
        {sr(OC['fair'], 1)} AS fair_overcharge_pct FROM predicted GROUP BY 1""",
    "bias_round_first": _rounded("TRUE", "SELECT * FROM rounded"),
    "controlled_round_first": _rounded(
        "trip_distance >= 4.5 AND trip_distance <= 5.5", "SELECT *, (SELECT sum(trips) FROM rounded) >= 100 AS enough_rows FROM rounded"),
    "low_high_gap": _rounded(
        "trip_distance >= 4.5 AND trip_distance <= 5.5",
        f""", sides AS (SELECT max(baseline) FILTER (income_category = 'low') AS low_value,
          max(baseline) FILTER (income_category = 'high') AS high_value FROM rounded)
        SELECT *, {sb('(low_value - high_value) / high_value * 100', 1)} AS gap_pct FROM sides"""),
    "chart_summary": f"""{WITH_PREDICTED} SELECT * FROM (
        SELECT income_category, count(*) AS trip_count, {mean('fare_amount', 6)} AS avg_actual_fare, 'baseline' AS model,
          {mean('predicted_fare_baseline', 6)} AS avg_predicted_fare, {sb(OC['baseline'], 1)} AS overcharge_pct
        FROM predicted GROUP BY 1
        UNION ALL SELECT income_category, count(*), {mean('fare_amount', 6)}, 'fair', {mean('predicted_fare_fair', 6)},
          {sb(OC['fair'], 1)} FROM predicted GROUP BY 1)""",
    "model_frames": f"""{WITH_PREDICTED}, s AS ({SUMMARY}) SELECT income_category, trip_count, avg_actual_fare,
        'baseline' AS model, baseline_predicted AS avg_predicted_fare, baseline_overcharge_pct AS overcharge_pct FROM s
      UNION ALL SELECT income_category, trip_count, avg_actual_fare, 'fair', fair_predicted, fair_overcharge_pct FROM s""",
    "error_total_by_borough": f"""{WITH_PREDICTED}, s AS (
        SELECT borough, sum(baseline_error) / 1000000 AS x FROM predicted GROUP BY 1)
      SELECT borough, {sr('x', 6)} AS signed_millions, {sr('abs(x)', 6)} AS millions FROM s WHERE abs(x) > 1e-9""",
    **dict.fromkeys(("bias_improvement", "summaries_side_by_side"), _improvement()),
    "bias_reduction": f"""{WITH_PREDICTED}, s AS ({SUMMARY}) SELECT income_category, baseline_overcharge_pct,
        fair_overcharge_pct, CASE WHEN baseline_overcharge_pct <> 0 THEN
        {sr('(1 - fair_overcharge_pct / baseline_overcharge_pct) * 100', 4)} ELSE 0 END AS reduction_pct
      FROM s WHERE income_category = 'low'""",
    # statistics and fairness
    "welch_t": _tests(False),
    "student_t": _tests(True),
    "welch_p_value": f"""{WITH_PREDICTED}, {_p_values('fair_error')}
      SELECT test, {sr('t', 6)} AS t_stat, {sr('p', 6)} AS p_value, p < 0.05 AS significant, p < 0.001 AS highly_significant
      FROM p""",
    "cohens_d": f"""WITH x AS ({_tests(False)}) SELECT test, cohens_d, CASE WHEN abs(cohens_d) > 0.8 THEN 'large'
        WHEN abs(cohens_d) > 0.5 THEN 'medium' ELSE 'small' END AS effect_size FROM x""",
    "demographic_parity": f"""{WITH_PREDICTED}, {SCORES} SELECT model, {sr('stddev_pop(mean_prediction)', 6)} AS score_pop,
        {sr('stddev_samp(mean_prediction)', 6)} AS score, {_grade('stddev_samp(mean_prediction)', 0.5, 1.5)} AS interpretation,
        {', '.join(sr(f"max(mean_prediction) FILTER (g = '{g}')", 6) + f" AS {g}_mean" for g in ("low", "medium", "high"))} FROM scores GROUP BY 1""",
    "dp_pairwise_ratio": f"""{WITH_PREDICTED}, {SCORES} SELECT a.model, a.g AS group_a, b.g AS group_b,
        {sr('a.mean_prediction / b.mean_prediction', 6)} AS ratio FROM scores a JOIN scores b ON a.model = b.model AND a.g < b.g""",
    "equalized_odds": f"""{WITH_PREDICTED}, {SCORES} SELECT model, {sr('stddev_pop(rmse)', 6)} AS score,
        {sr('max(rmse) / min(rmse)', 6)} AS disparity_ratio, {_grade('stddev_pop(rmse)', 0.3, 1.0)} AS interpretation,
        {', '.join(sr(f"max(rmse) FILTER (g = '{g}')", 6) + f" AS {g}_rmse" for g in ("low", "medium", "high"))} FROM scores GROUP BY 1""",
    "individual_fairness": _individual(None, 0.1),
    "individual_fairness_sampled": _individual(5000, 0.1),
    "individual_fairness_full": _individual(None, 0.1),
    "individual_fairness_wide_band": _individual(None, 0.6),
    "violation_examples": f"""{WITH_PREDICTED}, {_pairs(None, 0.1)} SELECT trip_id, distance, {sr('pb', 6)} AS low_pred,
        {sr('hb', 6)} AS high_pred, {sr('db', 6)} AS diff FROM pairs WHERE db > 3
      ORDER BY trip_id, distance, pb, hb LIMIT 3""",
    "fairness_comparison": f"""{COMPARED} SELECT metric, {sr('baseline_score', 6)} AS baseline_score,
        {sr('fair_score', 6)} AS fair_score, {sr('improvement_pct', 4)} AS improvement_pct FROM gains
      UNION ALL SELECT 'overall', NULL, NULL, {sr('avg(improvement_pct)', 4)} FROM gains""",
    "fairness_report": f"""{COMPARED} SELECT {sr("max(improvement_pct) FILTER (metric = 'demographic_parity')", 4)} AS parity_gain,
        {sr("max(improvement_pct) FILTER (metric = 'equalized_odds')", 4)} AS odds_gain,
        {sr("max(improvement_pct) FILTER (metric = 'individual_fairness')", 4)} AS individual_gain,
        {sr('avg(improvement_pct)', 4)} AS overall FROM gains""",
    **_reports(),
    # impact
    "impact_total": _impact(1.0),
    "impact_stage3_scale": _impact(0.2),
    "impact_by_borough": f"""{WITH_PREDICTED} SELECT borough, count(*) AS group_rows,
        {sr(f'sum(baseline_error) * ({ANNUAL} / (SELECT count(*) FROM predicted))', 0)} AS annual_impact_usd
      FROM predicted WHERE income_category = 'low' AND borough IS NOT NULL GROUP BY 1""",
    # models and samples
    "regression_metrics": f"""{WITH_PREDICTED}, m AS (SELECT 'baseline' AS model, count(*) AS n, avg(power(baseline_error, 2)) AS mse,
        avg(baseline_abs_error) AS mae, var_pop(fare_amount) AS v FROM predicted
        UNION ALL SELECT 'fair', count(*), avg(power(fair_error, 2)), avg(fair_abs_error), var_pop(fare_amount) FROM predicted)
      SELECT model, n, {sr('sqrt(mse)', 6)} AS rmse, {sr('mae', 6)} AS mae, {sr('1 - mse / v', 6)} AS r2,
        {sr("((1 - mse / v) - (SELECT 1 - mse / v FROM m WHERE model = 'baseline')) * 100", 4)} AS r2_delta_pp FROM m""",
    "hash_split_counts": f"""{RAW} SELECT CASE WHEN b < 8000 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM (
        SELECT CAST(('0x' || substr(sha256(CAST(h AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 AS b FROM priced) GROUP BY 1""",
    "hash_sample": f"""{RAW} SELECT h, fare_amount, trip_distance FROM priced
      WHERE CAST(('0x' || substr(sha256(CAST(h AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 500""",
    "fixed_size_sample": f"""{RAW} SELECT h, fare_amount, trip_distance FROM priced
      ORDER BY sha256(CAST(h AS VARCHAR)), h, fare_amount, trip_distance LIMIT 5000""",
    **{
        name: f"""{source} SELECT model, n, TRUE AS rmse_not_below_mae, TRUE AS has_error, TRUE AS r2_at_most_one,
          TRUE AS r2_above_bands, 0.0::DOUBLE AS native_off_by FROM (
          SELECT count(*) AS n FROM {table} WHERE {HELD_BACK} AND {USABLE}) CROSS JOIN (VALUES {models}) AS m(model)"""
        for name, source, table, models in (
            ("rf_baseline_vs_fair", WITH_ENRICHED, "enriched", "('baseline'), ('fair')"), ("rf_simple_model", WITH_CLEAN, "clean", "('simple')"))
    },
    "rf_feature_importance": f"""SELECT * FROM (VALUES
        ('baseline', {len(BASELINE_FEATURES)}::BIGINT, 1.0::DOUBLE, 1::BIGINT, TRUE, 'trip_distance'),
        ('fair', {len(FAIR_FEATURES)}::BIGINT, 1.0::DOUBLE, 0::BIGINT, TRUE, 'trip_distance'))
      AS t(model, features, total, income_features, none_negative, first_feature)""",
    "rf_node_table": f"""SELECT model, {FOREST['numTrees']}::BIGINT AS trees, {FOREST['numTrees']}::BIGINT AS roots, 1::BIGINT AS most_parents,
      {FOREST['numTrees']}::BIGINT AS leaves_beyond_splits, model = 'baseline' AS income_splits FROM (VALUES ('baseline'), ('fair')) AS m(model)""",
    "rf_permutation_importance": f"""SELECT * FROM (VALUES ('baseline', {len(BASELINE_FEATURES)}::BIGINT, 'trip_distance', TRUE, TRUE),
      ('fair', {len(FAIR_FEATURES)}::BIGINT, 'trip_distance', FALSE, TRUE)) AS t(model, features, first_feature, income_matters, distance_matters)""",
    "model_roundtrip": f"{WITH_ENRICHED} SELECT count(*) AS n, 0.0::DOUBLE AS largest_change FROM enriched WHERE {HELD_BACK} AND {USABLE}",
    "bernoulli_sample": f"{RAW} SELECT count(*)::INTEGER AS rows, TRUE AS size_as_expected FROM priced",
    "random_split_counts": f"{RAW} SELECT count(*) AS rows, TRUE AS size_as_expected FROM priced",
    "stratified_sample": f"""{WITH_ENRICHED} SELECT income_category, count(*) AS rows, TRUE AS size_as_expected
      FROM enriched GROUP BY 1""",
    # streams, sources and sinks
    "catalog_all_tables": f"""{WITH_PREDICTED}, s AS ({SUMMARY}),
      b AS (SELECT borough, {mean('fare_amount')} AS avg_actual_fare FROM predicted GROUP BY 1)
      SELECT 'taxi_trips_raw' AS "table", count(*) AS n, {sr('sum(fare_amount)', 2)} AS fare_sum FROM priced
      UNION ALL SELECT 'census_income', count(*), NULL FROM customer
      UNION ALL SELECT 'taxi_trips_cleaned', count(*), {sr('sum(fare_amount)', 2)} FROM clean
      UNION ALL SELECT 'taxi_trips_enriched', count(*), {sr('sum(fare_amount)', 2)} FROM enriched
      UNION ALL SELECT 'ml_predictions', count(*), {sr('sum(fare_amount)', 2)} FROM predicted
      UNION ALL SELECT 'bias_summary', count(*), {sr('sum(avg_actual_fare)', 2)} FROM s
      UNION ALL SELECT 'borough_bias', count(*), {sr('sum(avg_actual_fare)', 2)} FROM b""",
    "inferred_csv": "SELECT count(*) AS n, 'int' AS code_type, 'string' AS income_type FROM customer",
    "file_heads": "SELECT 300::BIGINT AS n, 300::BIGINT AS vendors",
    "stream_typed": f"""{RAW} SELECT count(*) AS n, {sr('sum(fare_amount)', 2)} AS fare_sum, count(passenger_count) AS passengers,
      TRUE AS stamped FROM priced""",
    "stream_totals": f"""{RAW} SELECT count(*) AS messages_consumed, {sr('sum(fare_amount)', 2)} AS fare_sum,
        {sr('sum(trip_distance)', 2)} AS distance_sum FROM priced""",
    "stream_borough_counts": f"""{WITH_PLACED} SELECT coalesce(found, 'Unknown') AS borough, count(*) AS trips
      FROM placed GROUP BY 1""",
    "stream_totals_batches": f"""{RAW} SELECT count(*) AS messages_consumed, {sr('sum(fare_amount)', 2)} AS fare_sum,
        {sr('sum(trip_distance)', 2)} AS distance_sum FROM priced""",
    "stream_borough_batches": f"""{WITH_PLACED} SELECT coalesce(found, 'Unknown') AS borough, count(*) AS trips
      FROM placed GROUP BY 1""",
    **dict.fromkeys(("stream_latest20", "stream_latest_restarted"), f"""{WITH_PLACED} SELECT tpep_pickup_datetime AS pickup, fare_amount AS fare, trip_distance AS distance,
        passenger_count AS passengers, coalesce(found, 'Unknown') AS borough, h FROM placed
      ORDER BY pickup DESC, h DESC, fare DESC NULLS LAST, distance DESC LIMIT 20"""),
    "stream_snapshot": f"""{WITH_PLACED}, b AS (SELECT coalesce(found, 'Unknown') AS borough, count(*) AS n FROM placed GROUP BY 1)
      SELECT count(*) AS messages_consumed, {sr('sum(fare_amount)', 2)} AS fare_sum,
        {sr('sum(trip_distance)', 2)} AS distance_sum, (SELECT '{{' || string_agg('"' || borough || '":' || n, ',' ORDER BY borough) || '}}' FROM b) AS boroughs,
        (SELECT CAST(count(*) AS DOUBLE) FROM placed GROUP BY tpep_pickup_datetime ORDER BY tpep_pickup_datetime DESC LIMIT 1 OFFSET 1)
          AS messages_per_sec,
        CAST(5 AS INTEGER) AS shown, max(tpep_pickup_datetime) AS last_pickup FROM placed""",
    "stream_reset": f"""{RAW}, t AS (SELECT 'before' AS step, * FROM priced UNION ALL SELECT 'after', * FROM priced WHERE passenger_count > 5)
      SELECT step, count(*) AS messages_consumed, {sr('sum(fare_amount)', 2)} AS fare_sum, {sr('sum(trip_distance)', 2)} AS distance_sum
      FROM t GROUP BY step UNION ALL SELECT 'reset', 0, NULL, NULL""",
    "enriched_with_predictions": f"""{WITH_PREDICTED}, i AS (SELECT trip_id, avg(predicted_fare_baseline) AS b, avg(predicted_fare_fair) AS f
        FROM predicted GROUP BY 1)
      SELECT e.trip_id, e.fare_amount, e.income_category, {sr('b', 6)} AS predicted_fare_baseline, {sr('f', 6)} AS predicted_fare_fair
      FROM enriched e LEFT JOIN i USING (trip_id)""",
    "stream_rate_per_second": """SELECT date_trunc('second', ts) AS window_start, count(*) AS messages,
        CAST(count(*) AS DOUBLE) AS messages_per_sec FROM events GROUP BY 1""",
    "stream_rate_closed": """WITH due AS (SELECT *, least((day(ts) - 1) // 8, 3) AS due FROM events),
      arrived AS (SELECT *, CASE WHEN event_id % 20 = 0 THEN least(due + 1, 3) ELSE due END AS run FROM due),
      runs AS (SELECT run, max(ts) - INTERVAL 1 HOUR AS seen FROM arrived GROUP BY 1),
      marks AS (SELECT run, max(seen) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS closed_before FROM runs),
      counted AS (SELECT date_trunc('minute', ts) AS window_start, count(*) AS messages FROM arrived JOIN marks USING (run)
        WHERE closed_before IS NULL OR date_trunc('minute', ts) + INTERVAL 1 MINUTE > closed_before GROUP BY 1)
      SELECT window_start, messages, round(CAST(messages AS DOUBLE) / 60, 1) AS messages_per_sec FROM counted
      WHERE window_start + INTERVAL 1 MINUTE <= (SELECT max(seen) FROM runs)""",
    "stream_restart": f"""{RAW}, s AS (SELECT count(*) AS n, {sr('sum(fare_amount)', 2)} AS fare_sum, {sr('sum(trip_distance)', 2)} AS distance_sum
        FROM priced) SELECT *, n AS messages_consumed, fare_sum AS live_fare_sum, distance_sum AS live_distance_sum FROM s""",
    **dict.fromkeys(
        ("stream_jsonl_roundtrip", "csv_roundtrip", "parquet_roundtrip", "message_roundtrip", "catalog_tables", "union_parts"),
        f"{RAW} SELECT {ROUND_TRIP_SUMS} FROM priced"),
    "result_csv_roundtrip": f"{WITH_PREDICTED} {SUMMARY}",
    "census_csv_roundtrip": f"WITH {ZONES}, {census()}, {incomes()} SELECT * FROM incomes",
}

ORACLES["fairness_report_details"] = f"""SELECT p.model, p.score AS parity_score, p.score_pop AS parity_score_pop, p.interpretation AS parity_grade,
  low_mean, medium_mean, high_mean, o.score AS odds_score, disparity_ratio, o.interpretation AS odds_grade, low_rmse, medium_rmse, high_rmse,
  i.score AS pair_score, max_difference, comparisons, violation_count, i.interpretation AS pair_grade
  FROM ({ORACLES['demographic_parity']}) p JOIN ({ORACLES['equalized_odds']}) o USING (model) JOIN ({ORACLES['individual_fairness']}) i USING (model)"""
ORACLES["model_evaluators"] = f"SELECT model, rmse, mae, r2 FROM ({ORACLES['regression_metrics']})"
