"""SQL twins of the queries, from shared common table expressions."""

from __future__ import annotations

from tapflow import fixed

DIRECTION = "CASE WHEN event_id % 2 = 0 THEN 'alight' ELSE 'board' END"
TAP = "CAST(floor(value) AS BIGINT)"

# Stand-in tables


def _taps(name: str, station: str, line: str) -> str:
    return f"""{name} AS (
    SELECT CAST(date_trunc('month', ts) AS DATE) AS year_month, {line} AS line, {station} AS station,
           CAST(hour(ts) AS INTEGER) AS hour, {DIRECTION} AS direction, {TAP} AS cnt
    FROM events)"""


BY_USER = _taps("taps", "CAST(user_id AS VARCHAR)", "event_type")
BY_TYPE = _taps("taps", "event_type", "'L' || (user_id % 4)")
BY_PRIORITY = """taps AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS year_month, o_orderpriority AS station,
           CAST(floor(o_totalprice) AS BIGINT) AS cnt
    FROM orders)"""
BY_ORDER = """taps AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS year_month, o_orderpriority AS station,
           CAST(o_orderkey % 24 AS INTEGER) AS hour, CASE WHEN o_custkey % 2 = 0 THEN 'alight' ELSE 'board' END AS direction,
           CAST(floor(o_totalprice) AS BIGINT) AS cnt
    FROM orders)"""
DAILY = f"""daily AS (
    SELECT CAST(ts AS DATE) AS date, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
           'L' || (user_id % 4) AS line, event_type AS station,
           CAST(sum(CASE WHEN event_id % 2 = 1 THEN {TAP} ELSE 0 END) AS BIGINT) AS board_total,
           CAST(sum(CASE WHEN event_id % 2 = 0 THEN {TAP} ELSE 0 END) AS BIGINT) AS alight_total
    FROM events GROUP BY ALL)"""
REGION_ROWS = ", ".join(f"({number}, '{name}', '{code}')" for number, (name, code) in enumerate(fixed.REGIONS))
REGIONS = f"regions(region_no, gu, gu_code) AS (VALUES {REGION_ROWS})"
TRADES = f"""{REGIONS}, trades AS (
    SELECT CAST(l_shipdate AS DATE) AS contract_date, gu_code, p_brand AS dong, p_name AS complex,
           CAST(p_size AS DOUBLE) AS area_m2, CAST(floor(l_extendedprice) AS BIGINT) * 10000 AS deal_krw,
           CAST(CAST(floor(l_extendedprice) AS BIGINT) * 10000 AS DOUBLE) / CAST(p_size AS DOUBLE) AS price_per_m2,
           CAST(l_linenumber AS INTEGER) AS floor, CAST(1985 + l_partkey % 38 AS INTEGER) AS build_year
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN regions ON s_nationkey = region_no)"""
PRICE_INDEX = f"""{TRADES}, price_index AS (
    SELECT gu_code, CAST(date_trunc('month', contract_date) AS DATE) AS year_month,
           median(price_per_m2) AS median_price
    FROM trades GROUP BY ALL)"""
FOCUS = """focus(station, en_name, display_order) AS (
    VALUES ('click', 'Click street', 0), ('view', 'View point', 1), ('purchase', 'Purchase plaza', 2))"""
FOCUS_TAPS = "focus_taps AS (SELECT * FROM taps WHERE station IN (SELECT station FROM focus))"

# Shared steps

HOURS = "hours AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))"
DENSE = f"""{HOURS}, totals AS (
    SELECT station, hour, sum(cnt) AS taps FROM taps GROUP BY ALL),
dense AS (
    SELECT s.station, h.hour, CAST(coalesce(t.taps, 0) AS BIGINT) AS taps
    FROM (SELECT DISTINCT station FROM taps) s CROSS JOIN hours h
    LEFT JOIN totals t ON t.station = s.station AND t.hour = h.hour)"""
SHARES = f"""{DENSE}, shares AS (
    SELECT station, hour, taps, CAST(taps AS DOUBLE) / sum(taps) OVER (PARTITION BY station) AS share FROM dense)"""
WEEKDAYS = """weekdays AS (
    SELECT s.station, CAST(w.range AS INTEGER) AS weekday, coalesce(m.mean_taps, 0.0) AS mean_taps
    FROM (SELECT DISTINCT station FROM daily) s CROSS JOIN range(7) w
    LEFT JOIN (SELECT station, weekday, avg(CAST(board_total + alight_total AS DOUBLE)) AS mean_taps
               FROM daily GROUP BY ALL) m
    ON m.station = s.station AND m.weekday = w.range)"""
SURFACE = f"""{BY_TYPE}, {DAILY}, {SHARES}, {WEEKDAYS}, surface AS (
    SELECT station, weekday, hour, mean_taps * share AS value FROM weekdays JOIN shares USING (station))"""
FEATURES = f"""{DENSE}, day AS (
    SELECT station, sum(taps) AS total,
           max(taps) FILTER (WHERE hour IN (7, 8, 9)) AS morning_max,
           max(taps) FILTER (WHERE hour IN (17, 18, 19)) AS evening_max,
           sum(taps) FILTER (WHERE hour IN (7, 8, 9)) AS morning,
           sum(taps) FILTER (WHERE hour >= 17 OR hour IN (0, 1)) AS evening_night,
           sum(taps) FILTER (WHERE hour IN (22, 23, 0, 1)) AS late,
           stddev_pop(CAST(taps AS DOUBLE)) AS std, avg(CAST(taps AS DOUBLE)) AS mean
    FROM dense GROUP BY station),
directed AS (
    SELECT station,
           coalesce(sum(cnt) FILTER (WHERE hour IN (7, 8, 9) AND direction = 'alight'), 0) AS alighted,
           coalesce(sum(cnt) FILTER (WHERE hour IN (7, 8, 9) AND direction = 'board'), 0) AS boarded
    FROM taps GROUP BY station),
features AS (
    SELECT station,
           CASE WHEN total = 0 THEN 0.0 ELSE CAST(morning_max AS DOUBLE) / total END AS morning_peak_intensity,
           CASE WHEN total = 0 THEN 0.0 ELSE CAST(evening_max AS DOUBLE) / total END AS evening_peak_intensity,
           CAST(evening_night AS DOUBLE) / nullif(CAST(morning AS DOUBLE), 0) AS weekend_weekday_ratio,
           CASE WHEN total = 0 THEN 0.0 ELSE CAST(late AS DOUBLE) / total END AS late_night_share,
           CASE WHEN alighted + boarded = 0 THEN 0.0
                ELSE CAST(alighted - boarded AS DOUBLE) / (alighted + boarded) END AS directional_asymmetry_peak,
           CASE WHEN mean = 0 THEN 0.0 ELSE std / mean END AS cv_hourly
    FROM day JOIN directed USING (station))"""
COMPLETE = f"""{FEATURES}, complete AS (
    SELECT * FROM features WHERE weekend_weekday_ratio IS NOT NULL)"""
CENTROIDS = f"""{FEATURES}, given AS (
    SELECT station, CAST(floor(arg_max(hour, taps * 100 - hour) / 5) AS INTEGER) AS cluster
    FROM totals GROUP BY station),
centroids AS (
    SELECT cluster, {", ".join(f"avg({name}) AS {name}" for name in fixed.FEATURES)}
    FROM features JOIN given USING (station) GROUP BY cluster)"""
NAMES = f"""{CENTROIDS}, ranked AS (
    SELECT *, rank() OVER (ORDER BY late_night_share DESC)
              + (count(*) OVER (PARTITION BY late_night_share) - 1) / 2.0 AS by_night,
           rank() OVER (ORDER BY weekend_weekday_ratio DESC)
              + (count(*) OVER (PARTITION BY weekend_weekday_ratio) - 1) / 2.0 AS by_weekend,
           rank() OVER (ORDER BY cv_hourly)
              + (count(*) OVER (PARTITION BY cv_hourly) - 1) / 2.0 AS by_flatness
    FROM centroids),
based AS (
    SELECT cluster, CASE
        WHEN by_night = 1 OR by_weekend = 1 THEN 'Nightlife District'
        WHEN directional_asymmetry_peak > 0.3 AND morning_peak_intensity > 0.10 THEN 'Business District'
        WHEN directional_asymmetry_peak < -0.3 AND morning_peak_intensity > 0.10 THEN 'Residential Commuter'
        WHEN by_flatness = 1 THEN 'Transit Interchange'
        ELSE 'Mixed Residential-Retail' END AS archetype
    FROM ranked),
names AS (
    SELECT cluster, archetype || CASE WHEN turn > 1 THEN ' ' || turn ELSE '' END AS cluster_name
    FROM (SELECT *, row_number() OVER (PARTITION BY archetype ORDER BY cluster) AS turn FROM based))"""
LABELS = f"{NAMES}, labels AS (SELECT station, cluster, cluster_name FROM given JOIN names USING (cluster))"
RANKED_USERS = f"""{BY_USER}, cells AS (
    SELECT station, hour, direction, avg(CAST(cnt AS DOUBLE)) AS mean_count FROM taps GROUP BY ALL),
columns AS (
    SELECT hour, direction, printf('%02d:00 %s', hour, direction) AS column_label,
           avg(mean_count) AS mean, stddev_pop(mean_count) AS std
    FROM cells GROUP BY hour, direction),
measured AS (
    SELECT hour, direction, column_label, round(round(mean, 9), 1) AS mean_riders,
           round(round(std, 9), 1) AS std_riders,
           round(round(CASE WHEN mean > 0 THEN std / mean ELSE 0 END, 12), 4) AS cv
    FROM columns),
ranked AS (
    SELECT *, CAST(row_number() OVER (ORDER BY cv DESC, hour, direction) AS INTEGER) AS rank FROM measured)"""
KS = f"""{BY_USER}, {SHARES}, pairs AS (
    SELECT a.station AS station_a, b.station AS station_b
    FROM (SELECT min(station) AS station FROM taps) a JOIN (SELECT DISTINCT station FROM taps) b
    ON a.station <> b.station)"""
KS_STEPS = """points AS (
    SELECT station_a, station_b, share, sum(in_a) AS in_a, sum(in_b) AS in_b FROM (
        SELECT station_a, station_b, share, 1 AS in_a, 0 AS in_b
        FROM pairs JOIN shares ON shares.station = station_a
        UNION ALL
        SELECT station_a, station_b, share, 0, 1
        FROM pairs JOIN shares ON shares.station = station_b)
    GROUP BY ALL),
counted AS (
    SELECT station_a, station_b, share,
           CAST(sum(in_a) OVER w AS BIGINT) AS count_a, CAST(sum(in_b) OVER w AS BIGINT) AS count_b
    FROM points WINDOW w AS (PARTITION BY station_a, station_b ORDER BY share)),
best AS (
    SELECT *, abs(count_a - count_b) AS gap FROM counted
    QUALIFY row_number() OVER (PARTITION BY station_a, station_b
                               ORDER BY abs(count_a - count_b) DESC, share) = 1),
ks AS (
    SELECT station_a, station_b, gap / 24.0 AS ks, share AS at_share, count_a / 24.0 AS cdf_a,
           count_b / 24.0 AS cdf_b, gap
    FROM best),
p_values AS (
    SELECT station_a, station_b, ks, at_share, cdf_a, cdf_b,
           CASE WHEN gap = 0 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (
               SELECT sum(CASE WHEN j.range % 2 = 1 THEN 1 ELSE -1 END * (
                   SELECT product((24 - i.range + 1) / CAST(24 + i.range AS DOUBLE))
                   FROM range(1, 25) i WHERE i.range <= j.range * gap))
               FROM range(1, 25) j WHERE j.range * gap <= 24))) END AS p_exact,
           CASE WHEN gap = 0 THEN 1.0 ELSE least(1.0, greatest(0.0, (
               SELECT sum(CASE WHEN j.range % 2 = 1 THEN 2.0 ELSE -2.0 END
                          * exp(-2.0 * j.range * j.range * ks * ks * 12.0))
               FROM range(1, 101) j))) END AS p_limit
    FROM ks)"""

POINTS = f"""{LABELS}, complete AS (SELECT * FROM features WHERE weekend_weekday_ratio IS NOT NULL),
user_focus(station, en_name) AS (VALUES ('1', 'User one'), ('2', 'User two'), ('3', 'User three')),
points AS (
    SELECT c.*, l.cluster, l.cluster_name, coalesce(u.en_name, c.station) AS display_name,
           u.en_name IS NOT NULL AS in_focus,
           (evening_peak_intensity - (SELECT avg(evening_peak_intensity) FROM complete))
               / (SELECT stddev_pop(evening_peak_intensity) FROM complete) AS x,
           (late_night_share - (SELECT avg(late_night_share) FROM complete))
               / (SELECT stddev_pop(late_night_share) FROM complete) AS y
    FROM complete c JOIN labels l ON l.station = c.station LEFT JOIN user_focus u ON u.station = c.station)"""


def _rounded(names: list[str], digits: int) -> str:
    return ", ".join(f'round("{name}", {digits}) + 0.0 AS "{name}"' for name in names)


def _min_max(constant: str) -> str:
    columns = [*fixed.FEATURES, "steady"]
    scaled = []
    for name in columns:
        low, high = f"(SELECT min({name}) FROM c)", f"(SELECT max({name}) FROM c)"
        if constant == "eps":
            formula = f"({name} - {low}) / ({high} - {low} + 1e-9)"
        else:
            other = name if constant == "keep" else "0.0"
            formula = f"CASE WHEN {high} > {low} THEN ({name} - {low}) / ({high} - {low}) ELSE {other} END"
        scaled.append(f"round({formula}, 6) + 0.0 AS {name}")
    return f"""WITH {BY_USER}, {COMPLETE},
    c AS (SELECT *, CAST(7.0 AS DOUBLE) AS steady FROM complete)
    SELECT station, {", ".join(scaled)} FROM c"""


def _ring(source: str, constant: str, axes: list[str], digits: int, keep: str) -> str:
    values = []
    for name in fixed.FEATURES:
        low, high = f"(SELECT min({name}) FROM {source})", f"(SELECT max({name}) FROM {source})"
        if constant == "eps":
            formula = f"({name} - {low}) / ({high} - {low} + 1e-9)"
        else:
            other = name if constant == "keep" else "0.0"
            formula = f"CASE WHEN {high} > {low} THEN ({name} - {low}) / ({high} - {low}) ELSE {other} END"
        values.append(f"printf('%.{digits}f', round({formula}, {digits}))")
    ring = " || ',' || ".join([*values, values[0]])
    theta = ",".join([*axes, axes[0]])
    return f"SELECT {keep}, {ring} AS r, '{theta}' AS theta FROM {source}"


CHANGES = f"""ends AS (
    SELECT gu_code, arg_min(median_price, year_month) AS first_value,
           arg_max(median_price, year_month) AS last_value, count(*) AS n_points
    FROM price_index GROUP BY gu_code),
labelled(gu_code, en_name) AS (VALUES {", ".join(f"('{c}', '{n}')" for c, n in fixed.PRICE_REGION_LABELS.items())})"""


HOUR_COLUMNS_48 = """slots AS (
    SELECT DISTINCT year_month, line, station FROM taps),
cells AS (
    SELECT CAST(h.range AS INTEGER) AS hour, d.direction
    FROM range(24) h CROSS JOIN (VALUES ('alight'), ('board')) d(direction))"""

def _kmeans(k: int, passes: int) -> str:
    """Passes of k-means from the points of the first stations, one pair of tables a pass."""
    names = fixed.FEATURES
    scaled = ", ".join(
        f"({n} - (SELECT avg({n}) FROM complete)) / (SELECT stddev_pop({n}) FROM complete) AS {n}" for n in names
    )
    parts = [f"p AS (SELECT station, {scaled} FROM complete)",
             f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY station) - 1 AS INTEGER) AS cluster, {', '.join(names)}"
             f" FROM (SELECT * FROM p ORDER BY station LIMIT {k}))"]
    apart = " + ".join(f"(p.{n} - c.{n}) ** 2" for n in names)
    for turn in range(passes + 1):
        parts.append(
            f"a{turn} AS (SELECT p.*, c.cluster, {apart} AS gap FROM p CROSS JOIN c{turn} c"
            f" QUALIFY row_number() OVER (PARTITION BY station ORDER BY {apart}, c.cluster) = 1)"
        )
        if turn < passes:
            means = ", ".join(f"avg({n}) AS {n}" for n in names)
            parts.append(f"c{turn + 1} AS (SELECT cluster, {means} FROM a{turn} GROUP BY cluster)")
    back = ", ".join(
        f"round({n} * (SELECT stddev_pop({n}) FROM complete) + (SELECT avg({n}) FROM complete), 6) + 0.0 AS {n}"
        for n in names
    )
    return f"""WITH {BY_USER}, {COMPLETE}, {", ".join(parts)}
        SELECT cluster, (SELECT count(*) FROM a{passes} WHERE a{passes}.cluster = c{passes}.cluster) AS n_stations,
               round((SELECT sum(gap) FROM a{passes}), 6) AS wcss, {back} FROM c{passes}"""


ORACLES: dict[str, str] = {
    "page_ranges": """
        WITH t AS (SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS total FROM lineitem GROUP BY 1)
        SELECT month, total, CAST(s AS BIGINT) AS start_row, CAST(s + 999 AS BIGINT) AS end_row
        FROM (SELECT month, total, unnest(range(1, greatest(total, 1) + 1, 1000)) AS s FROM t)""",
    "page_completeness": """
        WITH lines AS (SELECT l_orderkey, max(l_linenumber) AS total, count(*) AS landed FROM lineitem GROUP BY 1)
        SELECT o_orderkey, CAST(coalesce(total, 1) AS BIGINT) AS expected_rows,
               CAST(coalesce(landed, 0) AS BIGINT) AS landed_rows, coalesce(total, 1) = coalesce(landed, 0) AS complete
        FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey""",
    "union_tagged": """
        SELECT source, flag, priority, count(*) AS n_rows, max(order_key) AS max_key FROM (
            SELECT 'lineitem' AS source, l_returnflag AS flag, NULL AS priority, l_orderkey AS order_key FROM lineitem
            UNION ALL SELECT 'orders', NULL, o_orderpriority, o_orderkey FROM orders)
        GROUP BY source, flag, priority""",
    "parquet_round_trip": f"""
        WITH {BY_TYPE} SELECT station, hour, CAST(sum(cnt) AS BIGINT) AS taps FROM taps GROUP BY ALL""",
    "month_spine": """
        WITH e AS (SELECT date_trunc('month', max(l_shipdate)) AS last FROM lineitem),
        spine AS (SELECT strftime(last - to_months(CAST(r.range AS INTEGER)), '%Y%m') AS month
                  FROM e CROSS JOIN range(24) r),
        sales AS (SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT month, coalesce(n, 0) AS sales FROM spine LEFT JOIN sales USING (month)""",
    "month_day_mix": """
        WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders
                   FROM orders GROUP BY 1),
        d AS (SELECT month, orders, unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS day FROM m)
        SELECT month, orders, CAST(count(*) AS INTEGER) AS n_days,
               CAST(count(*) FILTER (WHERE isodow(day) <= 5) AS INTEGER) AS n_weekdays,
               CAST(count(*) FILTER (WHERE isodow(day) > 5) AS INTEGER) AS n_weekend_days,
               round(orders / CAST(count(*) AS DOUBLE), 4) AS orders_per_day
        FROM d GROUP BY month, orders""",
    "region_dim": f"""
        WITH {REGIONS}, s AS (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1),
        english(gu, gu_en) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in fixed.FOCUS_REGIONS.items())}),
        stations(gu, full_name, hypothesis) AS (VALUES
            {", ".join(f"('{gu}', '{full}', '{h}')" for _, full, _, gu, h in fixed.FOCUS_STATIONS)})
        SELECT r.gu, r.gu_code, e.gu_en, e.gu_en IS NOT NULL AS in_focus, t.full_name, t.hypothesis, s.suppliers
        FROM regions r JOIN s ON r.region_no = s.s_nationkey
        LEFT JOIN english e ON e.gu = r.gu LEFT JOIN stations t ON t.gu = r.gu""",
    "hour_weekday_spines": """
        WITH c AS (SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour, count(*) AS n FROM events GROUP BY ALL)
        SELECT CAST(w.range AS INTEGER) AS weekday,
               ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][w.range + 1] AS weekday_name,
               CAST(h.range AS INTEGER) AS hour, coalesce(n, 0) AS events
        FROM range(7) w CROSS JOIN range(24) h LEFT JOIN c ON c.weekday = w.range AND c.hour = h.range""",
    "hourly_long": f"""
        WITH {_taps("taps", "'Stop' || user_id", "event_type")}, {HOUR_COLUMNS_48},
        t AS (SELECT year_month, line, station, hour, direction, sum(cnt) AS taps FROM taps GROUP BY ALL)
        SELECT s.year_month, s.line, s.station, c.hour, c.direction, CAST(coalesce(t.taps, 0) AS BIGINT) AS count
        FROM slots s CROSS JOIN cells c LEFT JOIN t
        ON t.year_month = s.year_month AND t.line = s.line AND t.station = s.station
           AND t.hour = c.hour AND t.direction = c.direction""",
    "daily_clean": f"WITH {DAILY} SELECT * FROM daily",
    "trades_clean": f"""
        WITH {TRADES} SELECT * REPLACE (round(price_per_m2, 4) AS price_per_m2) FROM trades""",
    "trades_empty": f"""
        WITH {TRADES} SELECT count(*) AS n_rows, 9 AS n_columns, max(dong) AS dong, max(deal_krw) AS deal_krw
        FROM trades WHERE floor < 0""",
    "canonical_names": """
        SELECT regexp_replace(regexp_replace(CASE
                   WHEN p_partkey % 3 = 0 THEN p_name || ' (' || p_brand || ')'
                   WHEN p_partkey % 3 = 1 THEN ' ' || p_name || '（' || p_type || '） '
                   ELSE p_name END, '[(（].*?[)）]', '', 'g'), '\\s+', '', 'g') AS name, count(*) AS n_parts
        FROM part GROUP BY 1""",
    "direction_pivot": f"""
        WITH {BY_USER} SELECT station, CAST(coalesce(sum(cnt) FILTER (WHERE direction = 'alight'), 0) AS BIGINT) AS alight,
               CAST(coalesce(sum(cnt) FILTER (WHERE direction = 'board'), 0) AS BIGINT) AS board
        FROM taps GROUP BY station""",
    "dense_hours": f"WITH {BY_USER}, {DENSE} SELECT station, hour, taps FROM dense",
    "weekday_hour_matrix_wide": f"""
        WITH {SURFACE} SELECT station, weekday,
               ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][weekday + 1] AS weekday_name,
               {", ".join(f'round(max(value) FILTER (WHERE hour = {h}), 6) AS "{h:02d}"' for h in range(24))}
        FROM surface GROUP BY station, weekday""",
    "column_labels": f"""
        WITH {BY_USER} SELECT printf('%02d:00 %s', hour, direction) AS column_label, CAST(sum(cnt) AS BIGINT) AS taps
        FROM taps GROUP BY 1""",
    "entity_ids": f"""
        WITH {BY_USER} SELECT station, CAST(dense_rank() OVER (ORDER BY station) AS BIGINT) AS station_id,
               count(*) AS n_rows, CAST(sum(cnt) AS BIGINT) AS taps
        FROM taps GROUP BY station""",
    "attach_region": """
        WITH places AS (
            SELECT CAST(n_nationkey AS VARCHAR) AS station, CAST(n_nationkey + 0.5 AS DOUBLE) AS lat,
                   CAST(100 + n_nationkey AS DOUBLE) AS lon, r_name AS gu
            FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 2)
        SELECT c.station, lat, lon, gu, c_mktsegment, count(*) AS customers
        FROM (SELECT CAST(c_nationkey AS VARCHAR) AS station, c_mktsegment FROM customer) c
        LEFT JOIN places USING (station) GROUP BY ALL""",
    "display_names": f"""
        WITH {BY_TYPE}, {FOCUS} SELECT t.station, coalesce(f.en_name, t.station) AS display_name,
               CAST(sum(cnt) AS BIGINT) AS taps
        FROM taps t LEFT JOIN focus f ON f.station = t.station GROUP BY ALL""",
    "focus_semi": f"""
        WITH {BY_USER} SELECT station, CAST(sum(cnt) AS BIGINT) AS taps FROM taps WHERE station IN (
            SELECT CAST(user_id AS VARCHAR) FROM events
            WHERE event_type = 'purchase' AND value > (SELECT avg(value) FROM events))
        GROUP BY station""",
    "focus_flags": f"""
        WITH {BY_TYPE}, {FOCUS} SELECT station, station IN (SELECT station FROM focus) AS in_focus, count(*) AS n_rows
        FROM taps GROUP BY ALL""",
    "hypothesis_check": f"""
        WITH {BY_USER}, {LABELS}, h AS (
            SELECT *, ['Business District', 'Nightlife District', 'district mixed'][CAST(station AS BIGINT) % 3 + 1]
                AS hypothesis FROM labels)
        SELECT station, cluster, cluster_name, hypothesis,
               contains(lower(cluster_name), lower(hypothesis)) AS whole_match,
               len(list_filter(string_split(lower(hypothesis), ' '),
                   lambda w: NOT contains(lower(cluster_name), w))) = 0 AS word_match
        FROM h""",
    "common_entities": """
        SELECT o_custkey AS station FROM orders WHERE o_orderpriority = '1-URGENT'
        INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'""",
    "distinct_union": f"""
        WITH {BY_TYPE} SELECT cnt AS value FROM taps WHERE station = 'click'
        UNION SELECT cnt FROM taps WHERE station = 'view'""",
    "hour_totals": f"""
        WITH {BY_USER} SELECT station, hour, CAST(sum(cnt) AS BIGINT) AS taps FROM taps GROUP BY ALL""",
    "hour_direction_mean": f"""
        WITH {BY_USER} SELECT station, hour, direction, round(avg(CAST(cnt AS DOUBLE)), 6) AS mean_count
        FROM taps GROUP BY ALL""",
    "column_distinctiveness": f"WITH {RANKED_USERS} SELECT *, rank <= 8 AS distinctive FROM ranked",
    "monthly_price_index": f"""
        WITH {PRICE_INDEX} SELECT gu_code, year_month, round(median_price, 3) AS median_price_per_m2
        FROM price_index""",
    "weekday_mean": f"""
        WITH {DAILY}, {WEEKDAYS} SELECT station, weekday, round(mean_taps, 6) AS mean_taps FROM weekdays""",
    "hour_share": f"WITH {BY_USER}, {SHARES} SELECT station, hour, taps, round(share, 9) AS share FROM shares",
    "weekday_hour_surface": f"""
        WITH {SURFACE} SELECT station, weekday, hour, round(value, 6) AS value FROM surface""",
    "window_sums": f"""
        WITH {BY_USER} SELECT station,
               {", ".join(f"CAST(coalesce(sum(cnt) FILTER (WHERE {c}), 0) AS BIGINT) AS {n}" for n, c in [
                   ("morning_taps", "hour IN (7, 8, 9)"), ("evening_taps", "hour IN (17, 18, 19)"),
                   ("late_taps", "hour IN (22, 23, 0, 1)"), ("evening_night_taps", "hour >= 17 OR hour <= 1"),
                   ("morning_board", "hour IN (7, 8, 9) AND direction = 'board'"),
                   ("morning_alight", "hour IN (7, 8, 9) AND direction = 'alight'")])}
        FROM taps GROUP BY station""",
    "annual_totals": f"""
        WITH {BY_PRIORITY} SELECT station, CAST(year(year_month) AS INTEGER) AS year, CAST(sum(cnt) AS BIGINT) AS taps,
               round(CAST(sum(cnt) AS DOUBLE) / 1e6, 6) AS taps_millions
        FROM taps GROUP BY ALL""",
    "weekend_balance": f"""
        WITH {DAILY}, m AS (
            SELECT station, avg(CAST(board_total + alight_total AS DOUBLE)) FILTER (WHERE weekday < 5) AS wd,
                   avg(CAST(board_total + alight_total AS DOUBLE)) FILTER (WHERE weekday >= 5) AS we
            FROM daily GROUP BY station)
        SELECT station, round(wd, 6) AS weekday_mean, round(we, 6) AS weekend_mean,
               round(we / wd - 1, 6) AS change,
               CASE WHEN we / wd - 1 > 0 THEN 'weekend-heavy' ELSE 'weekday-heavy' END AS direction,
               printf('%+.4f%%', round(we / wd - 1, 6) * 100) AS change_text
        FROM m""",
    "distinct_entities": f"""
        WITH {BY_USER} SELECT count(DISTINCT station) AS n_stations, count(DISTINCT line) AS n_lines FROM taps""",
    "extrema": f"""
        WITH {SURFACE} SELECT round(max(value), 6) AS max_value, round(min(value), 6) AS min_value FROM surface""",
    "average_tie_rank": f"""
        WITH {BY_USER}, t AS (SELECT station, hour, sum(cnt) AS taps FROM taps GROUP BY ALL),
        b AS (SELECT hour, count(*) AS busy_users FROM t GROUP BY hour)
        SELECT hour, busy_users,
               rank() OVER (ORDER BY busy_users DESC)
                   + (count(*) OVER (PARTITION BY busy_users) - 1) / CAST(2 AS DOUBLE) AS rank_down,
               rank() OVER (ORDER BY busy_users)
                   + (count(*) OVER (PARTITION BY busy_users) - 1) / CAST(2 AS DOUBLE) AS rank_up
        FROM b""",
    "first_last": f"""
        WITH {BY_PRIORITY}, s AS (SELECT station, year_month, CAST(sum(cnt) AS BIGINT) AS taps FROM taps GROUP BY ALL)
        SELECT station, arg_min(taps, year_month) AS first_value, arg_max(taps, year_month) AS last_value,
               count(*) AS n_points
        FROM s GROUP BY station""",
    "dedupe_names": """
        WITH n AS (SELECT n_nationkey, r_name, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS turn
                   FROM nation JOIN region ON n_regionkey = r_regionkey),
        c AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1)
        SELECT n_nationkey, r_name, r_name || CASE WHEN turn > 1 THEN ' ' || turn ELSE '' END AS unique_name, customers
        FROM n JOIN c ON n_nationkey = c_nationkey""",
    "peak_hour": f"""
        WITH {BY_USER}, t AS (SELECT station, hour, CAST(sum(cnt) AS BIGINT) AS taps FROM taps GROUP BY ALL)
        SELECT station, hour AS peak_hour, taps AS peak_value FROM t
        QUALIFY row_number() OVER (PARTITION BY station ORDER BY taps DESC, hour) = 1""",
    "peak_cell": f"""
        WITH {SURFACE} SELECT station, weekday AS peak_weekday, hour AS peak_hour, round(value, 6) AS peak_value
        FROM surface QUALIFY row_number() OVER (PARTITION BY station ORDER BY value DESC, weekday, hour) = 1""",
    "top_columns": f"""
        WITH {RANKED_USERS} SELECT *, rank <= 8 AS distinctive FROM ranked WHERE rank <= 16""",
    "preview_rows": f"""
        WITH {DAILY} SELECT CAST(date AS VARCHAR) AS date, CAST(weekday AS VARCHAR) AS weekday, line, station,
               CAST(board_total AS VARCHAR) AS board_total, CAST(alight_total AS VARCHAR) AS alight_total,
               (SELECT count(*) FROM daily) AS total_rows, 6 AS total_cols
        FROM daily ORDER BY daily.date, line, station LIMIT 15""",
    "station_features": f"""
        WITH {BY_USER}, {FEATURES} SELECT station, {_rounded(fixed.FEATURES, 6)} FROM features""",
    "station_features_with_id": f"""
        WITH {BY_USER}, {FEATURES}, ids AS (
            SELECT *, CAST(dense_rank() OVER (ORDER BY station) AS BIGINT) AS station_id FROM features)
        SELECT * FROM ({" UNION ALL ".join(
            f"SELECT station, station_id, {order} AS feature_order, '{label}' AS label,"
            f" round({name}, 6) + 0.0 AS value FROM ids"
            for order, (name, label) in enumerate(zip(fixed.FEATURES, fixed.FEATURE_LABELS)))})""",
    "feature_rejects": f"""
        WITH {BY_USER}, {FEATURES} SELECT station, weekend_weekday_ratio IS NOT NULL AS complete FROM features""",
    "ecdf": f"""
        WITH {BY_USER}, {SHARES} SELECT station,
               CAST(row_number() OVER (PARTITION BY station ORDER BY share, hour) AS INTEGER) AS step,
               round(share, 9) AS share,
               round(row_number() OVER (PARTITION BY station ORDER BY share, hour) / 24.0, 9) AS cumulative
        FROM shares""",
    "ks_two_sample": f"""
        WITH {KS}, {KS_STEPS} SELECT station_a, station_b, {_rounded(["ks", "at_share", "cdf_a", "cdf_b"], 9)} FROM ks""",
    "ks_p_value": f"""
        WITH {KS}, {KS_STEPS} SELECT station_a, station_b, {_rounded(["ks", "p_exact", "p_limit"], 9)} FROM p_values""",
    "hourly_cv": f"""
        WITH {BY_USER}, {FEATURES} SELECT station, round(cv_hourly, 6) AS cv_hourly FROM features""",
    "standardised": f"""
        WITH {BY_USER}, {COMPLETE} SELECT station, {", ".join(
            f"round(({n} - (SELECT avg({n}) FROM complete)) / (SELECT stddev_pop({n}) FROM complete), 6) + 0.0 AS {n}"
            for n in fixed.FEATURES)}
        FROM complete""",
    "min_max_keep": _min_max("keep"),
    "min_max_zero": _min_max("zero"),
    "min_max_eps": _min_max("eps"),
    "wcss_given": """
        WITH cells AS (SELECT vec_id, label, unnest(range(1, 65)) AS axis, unnest(embedding) AS x FROM embeddings),
        v AS (SELECT label, axis, count(*) AS n, var_pop(CAST(x AS DOUBLE)) AS variance FROM cells GROUP BY ALL)
        SELECT label AS cluster, max(n) AS n_points, round(sum(n * variance), 6) AS wcss FROM v GROUP BY label""",
    "silhouette_given": """
        WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
        sizes AS (SELECT label, count(*) AS n FROM p GROUP BY label),
        sums AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(array_distance(a.v, b.v)) AS total
                 FROM p a CROSS JOIN p b GROUP BY ALL),
        means AS (SELECT vec_id, own, other, CASE WHEN own = other THEN total / nullif(n - 1, 0) ELSE total / n END AS m
                  FROM sums JOIN sizes ON sizes.label = sums.other),
        ab AS (SELECT vec_id, own, max(m) FILTER (WHERE own = other) AS a, min(m) FILTER (WHERE own <> other) AS b
               FROM means GROUP BY ALL)
        SELECT CAST(own AS VARCHAR) AS cluster, count(*) AS n_points,
               round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) + 0.0 AS silhouette
        FROM ab GROUP BY own""",
    "moments_silhouette_given": """
        WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
        sizes AS (SELECT label, count(*) AS n FROM p GROUP BY label),
        sums AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(array_distance(a.v, b.v) ** 2) AS total
                 FROM p a CROSS JOIN p b GROUP BY ALL),
        means AS (SELECT vec_id, own, other, CASE WHEN own = other THEN total / nullif(n - 1, 0) ELSE total / n END AS m
                  FROM sums JOIN sizes ON sizes.label = sums.other),
        ab AS (SELECT vec_id, own, max(m) FILTER (WHERE own = other) AS a, min(m) FILTER (WHERE own <> other) AS b
               FROM means GROUP BY ALL)
        SELECT CAST(own AS VARCHAR) AS cluster, count(*) AS n_points,
               round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) + 0.0 AS silhouette
        FROM ab GROUP BY own""",
    "centroid_silhouette_given": """
        WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
        cells AS (SELECT label, unnest(range(1, 65)) AS axis, unnest(v) AS x FROM p),
        m AS (SELECT label, axis, avg(x) AS x FROM cells GROUP BY ALL),
        c AS (SELECT label, CAST(list(x ORDER BY axis) AS DOUBLE[64]) AS v FROM m GROUP BY label),
        d AS (SELECT vec_id, p.label = c.label AS own, array_distance(p.v, c.v) AS gap FROM p CROSS JOIN c),
        ab AS (SELECT vec_id, max(gap) FILTER (WHERE own) AS a, min(gap) FILTER (WHERE NOT own) AS b
               FROM d GROUP BY vec_id)
        SELECT 'label' AS assignment, round(avg((b - a) / greatest(a, b)), 6) + 0.0 AS silhouette, count(*) AS n_points
        FROM ab""",
    "kmeans_from_given": _kmeans(4, 3),
    "best_k_given": """
        SELECT k FROM (SELECT CAST(o_custkey % 7 + 2 AS INTEGER) AS k, round(avg(CAST(o_totalprice AS DOUBLE)), -3) AS score
                       FROM orders GROUP BY 1)
        ORDER BY score DESC, k LIMIT 1""",
    "inverse_scaled": f"""
        WITH {BY_USER}, {COMPLETE}, given AS (
            SELECT station, CAST(floor(arg_max(hour, taps * 100 - hour) / 5) AS INTEGER) AS cluster
            FROM totals GROUP BY station)
        SELECT cluster, {", ".join(f"round(avg({n}), 6) + 0.0 AS {n}" for n in fixed.FEATURES)}
        FROM complete JOIN given USING (station) GROUP BY cluster""",
    "scaler_reuse": f"""
        WITH {BY_USER}, {COMPLETE}, even AS (SELECT * FROM complete WHERE CAST(station AS BIGINT) % 2 = 0)
        SELECT station, {", ".join(
            f"round(({n} - (SELECT avg({n}) FROM even)) / (SELECT stddev_pop({n}) FROM even), 6) + 0.0 AS {n}"
            for n in fixed.FEATURES)}
        FROM complete WHERE CAST(station AS BIGINT) % 2 = 1""",
    "kmeans_facts": """
        SELECT fact, true AS holds FROM (VALUES ('every label is the nearest centre'),
            ('every centre is the mean of its members'), ('every complete station has a label'),
            ('clusters are numbered by falling size'), ('cost falls with k'),
            ('the chosen k has the largest silhouette'), ('the chosen run settled')) f(fact)""",
    "projection_facts": """
        SELECT fact, true AS holds FROM (VALUES ('every station has a place'), ('the axes are uncorrelated'),
            ('the first axis varies most'), ('the plane varies no more than the table'),
            ('the first axis takes its share')) f(fact)""",
    "archetype_given": f"WITH {BY_USER}, {NAMES} SELECT cluster, cluster_name FROM names",
    "chart_a": f"""
        WITH {SURFACE}, {FOCUS} SELECT station, weekday, hour, round(value, 6) AS value, en_name AS display_name, display_order,
               round(max(value) OVER (), 6) AS scale_max
        FROM surface JOIN focus USING (station)""",
    "chart_b": f"""
        WITH {BY_TYPE}, {FOCUS}, t AS (
            SELECT station, en_name, display_order, hour, sum(cnt) AS taps FROM taps JOIN focus USING (station) GROUP BY ALL),
        s AS (SELECT *, CAST(taps AS DOUBLE) / sum(taps) OVER (PARTITION BY station) * 100 AS share_pct FROM t)
        SELECT station, hour, round(share_pct, 6) AS share_pct, en_name AS display_name, display_order,
               first(hour) OVER w AS peak_hour, round(first(share_pct) OVER w, 6) AS peak_value
        FROM s WINDOW w AS (PARTITION BY station ORDER BY taps DESC, hour
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "chart_c": f"""
        WITH {BY_PRIORITY}, names(station, display_name, display_order) AS (
            VALUES ('1-URGENT', 'Urgent', 0), ('3-MEDIUM', 'Medium', 1), ('5-LOW', 'Low', 2))
        SELECT station, CAST(year(year_month) AS INTEGER) AS year, CAST(sum(cnt) AS BIGINT) AS taps, display_name, display_order,
               round(CAST(sum(cnt) AS DOUBLE) / 1e6, 6) AS taps_millions
        FROM taps JOIN names USING (station) GROUP BY ALL""",
    "chart_d": f"""
        WITH {DAILY}, {FOCUS}, m AS (
            SELECT station, en_name, avg(CAST(board_total + alight_total AS DOUBLE)) FILTER (WHERE weekday < 5) AS wd,
                   avg(CAST(board_total + alight_total AS DOUBLE)) FILTER (WHERE weekday >= 5) AS we
            FROM daily JOIN focus USING (station) GROUP BY ALL)
        SELECT station, round(wd, 6) AS weekday_mean, round(we, 6) AS weekend_mean,
               round(we / wd - 1, 6) AS change,
               CASE WHEN we / wd - 1 > 0 THEN 'weekend-heavy' ELSE 'weekday-heavy' END AS direction,
               printf('%+.4f%%', round(we / wd - 1, 6) * 100) AS change_text,
               en_name AS display_name,
               CAST(row_number() OVER (ORDER BY we / wd, station) AS INTEGER) AS bar_order
        FROM m""",
    "chart_e": f"""
        WITH {BY_TYPE}, {FEATURES}, {FOCUS}, f AS (
            SELECT features.*, en_name AS display_name, display_order FROM features JOIN focus USING (station))
        {_ring("f", "keep", fixed.PROFILE_AXES, 4, "station, display_name, display_order")}""",
    "chart_f": f"""
        WITH {BY_TYPE}, {SHARES}, {FOCUS} SELECT station,
               CAST(row_number() OVER (PARTITION BY station ORDER BY share, hour) AS INTEGER) AS step,
               round(share, 9) AS share,
               round(row_number() OVER (PARTITION BY station ORDER BY share, hour) / 24.0, 9) AS cumulative,
               en_name AS display_name, display_order
        FROM shares JOIN focus USING (station)""",
    "chart_f_ks": f"""
        WITH {BY_TYPE}, {SHARES}, pairs AS (SELECT 'click' AS station_a, 'view' AS station_b), {KS_STEPS}
        SELECT station_a, station_b, {_rounded(["ks", "at_share", "cdf_a", "cdf_b", "p_exact", "p_limit"], 9)}
        FROM p_values""",
    "chart_g": f"""
        WITH {BY_TYPE}, {FOCUS} SELECT station, en_name AS display_name, display_order,
               round(-coalesce(sum(cnt) FILTER (WHERE hour = 8 AND direction = 'alight'), 0) / 1e3, 3) + 0.0
                   AS alight_thousands,
               round(coalesce(sum(cnt) FILTER (WHERE hour = 8 AND direction = 'board'), 0) / 1e3, 3) AS board_thousands
        FROM taps JOIN focus USING (station) GROUP BY ALL""",
    "chart_i_given": f"""
        WITH {BY_USER}, {POINTS} SELECT station, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, cluster, cluster_name,
               printf('%s (%s) | Morning peak: %.3f | Late-night: %.3f | AM asymmetry: %+.3f | Weekend bal.: %.2f',
                      display_name, station, round(morning_peak_intensity, 3), round(late_night_share, 3),
                      round(directional_asymmetry_peak, 3), round(weekend_weekday_ratio, 2)) AS hover,
               CASE WHEN in_focus THEN display_name END AS annotation
        FROM points""",
    "chart_k_given": f"""
        WITH {BY_USER}, {POINTS} SELECT layer, station, display_name, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y,
               cluster, cluster_name
        FROM (SELECT *, 'background' AS layer FROM points
              UNION ALL SELECT *, 'focus' FROM points WHERE in_focus)""",
    "snap_points_given": f"""
        WITH {BY_USER}, {POINTS} SELECT cluster_name, station, display_name, round(x, 3) + 0.0 AS x,
               round(y, 3) + 0.0 AS y, in_focus
        FROM points""",
    "chart_j": f"""
        WITH {BY_USER}, {NAMES}, c AS (SELECT centroids.*, cluster_name FROM centroids JOIN names USING (cluster))
        {_ring("c", "eps", fixed.CENTROID_AXES, 4, "cluster, cluster_name")}""",
    "chart_m": f"""
        WITH {PRICE_INDEX}, {CHANGES}
        SELECT i.gu_code, year_month, round(median_price / 1e6, 8) AS price_millions,
               round(CASE WHEN n_points >= 2 THEN (last_value / first_value - 1) * 100 END, 6) AS change_pct,
               coalesce(en_name, i.gu_code) AS display_name
        FROM price_index i JOIN ends USING (gu_code) LEFT JOIN labelled USING (gu_code)""",
    "chart_n": f"""
        WITH {PRICE_INDEX}, {CHANGES}
        SELECT gu_code, coalesce(en_name, gu_code) AS display_name, round(first_value / 1e6, 8) AS start_price,
               round(last_value / 1e6, 8) AS end_price,
               round(CASE WHEN n_points >= 2 AND first_value <> 0 THEN (last_value / first_value - 1) * 100 END, 6)
                   AS change_pct,
               CAST(row_number() OVER (ORDER BY last_value / 1e6 - first_value / 1e6, gu_code) AS INTEGER) AS slope_order
        FROM ends LEFT JOIN labelled USING (gu_code)""",
    "chart_o": f"""
        WITH {BY_USER}, {LABELS}, listed(cluster_name, place) AS (VALUES
            ('Residential Commuter', 0), ('Transit Interchange', 1), ('Nightlife District', 2),
            ('Business District', 3), ('Business District 2', 4)),
        o AS (SELECT cluster_name, CAST(coalesce(place, 4 + row_number() OVER (
                  PARTITION BY place IS NULL ORDER BY cluster_name)) AS INTEGER) AS stack_order
              FROM (SELECT DISTINCT cluster_name FROM labels) LEFT JOIN listed USING (cluster_name)),
        b AS (SELECT cluster_name, hour, sum(cnt) AS boardings FROM taps JOIN labels USING (station)
              WHERE direction = 'board' GROUP BY ALL),
        d AS (SELECT cluster_name, stack_order, hours.hour, CAST(coalesce(boardings, 0) AS BIGINT) AS boardings
              FROM (SELECT DISTINCT cluster_name FROM labels) l JOIN o USING (cluster_name) CROSS JOIN hours
              LEFT JOIN b USING (cluster_name, hour))
        SELECT cluster_name, hour, boardings, stack_order,
               CAST(sum(boardings) OVER (PARTITION BY hour ORDER BY stack_order) AS BIGINT) AS stack_top
        FROM d""",
    "cluster_hours": f"""
        WITH {BY_USER}, {LABELS}, b AS (
            SELECT cluster_name, hour, sum(cnt) AS boardings FROM taps JOIN labels USING (station)
            WHERE direction = 'board' GROUP BY ALL)
        SELECT cluster_name, hours.hour, CAST(coalesce(boardings, 0) AS BIGINT) AS boardings
        FROM (SELECT DISTINCT cluster_name FROM labels) l CROSS JOIN hours LEFT JOIN b USING (cluster_name, hour)""",
    "cluster_sizes": f"""
        WITH {BY_USER}, {LABELS} SELECT cluster_name, count(*) AS n_stations FROM labels GROUP BY 1""",
    "snap_raw_shape": f"""
        WITH {BY_USER}, n AS (SELECT count(*) AS n_rows FROM (SELECT DISTINCT year_month, line, station FROM taps))
        SELECT kind_order, kind, n_columns, n_rows
        FROM (VALUES (1, 'ID columns', 3), (2, 'Hourly columns', 48), (3, 'Meta columns', 1))
             k(kind_order, kind, n_columns) CROSS JOIN n""",
    "snap_columns": f"""
        WITH {RANKED_USERS} SELECT rank, column_label, cv, rank <= 8 AS distinctive FROM ranked WHERE rank <= 16""",
    "snap_flow": f"""
        WITH {BY_TYPE}, {SHARES}, {FOCUS} SELECT station, hour, round(share * 100, 2) AS share_pct,
               en_name AS display_name, display_order
        FROM shares JOIN focus USING (station)""",
    "snap_profile": f"""
        WITH {BY_TYPE}, {FEATURES}, {FOCUS}, f AS (
            SELECT features.*, en_name AS display_name, display_order FROM features JOIN focus USING (station))
        {_ring("f", "zero", fixed.SNAPSHOT_AXES, 3, "station, display_name, display_order")}""",
    "snap_clusters": f"""
        WITH {BY_USER}, {LABELS} SELECT cluster_name, count(*) AS n_stations FROM labels GROUP BY 1""",
    "incremental_hour_totals": f"""
        WITH {BY_ORDER} SELECT station, hour, CAST(sum(cnt) AS BIGINT) AS taps FROM taps GROUP BY ALL""",
    "incremental_hour_means": f"""
        WITH {BY_ORDER} SELECT station, hour, direction, round(avg(CAST(cnt AS DOUBLE)), 3) AS mean_count,
               round(stddev_pop(CAST(cnt AS DOUBLE)), 3) AS std_count, count(*) AS n_rows
        FROM taps GROUP BY ALL""",
    "incremental_annual_totals": f"""
        WITH {BY_ORDER} SELECT station, CAST(year(year_month) AS INTEGER) AS year, CAST(sum(cnt) AS BIGINT) AS taps
        FROM taps GROUP BY ALL""",
    "incremental_features": f"""
        WITH {BY_ORDER}, {FEATURES} SELECT station, {_rounded(fixed.FEATURES, 6)} FROM features""",
    "approximate_price_index": f"""
        WITH {TRADES} SELECT gu_code, CAST(date_trunc('month', contract_date) AS DATE) AS year_month, count(*) AS n_sales,
               round(quantile_disc(price_per_m2, 0.5), 3) AS median_price_per_m2
        FROM trades GROUP BY ALL""",
    "sketch_errors": f"""
        WITH {TRADES} SELECT gu_code, CAST(year(contract_date) AS INTEGER) AS year, count(*) AS n_sales,
               count(DISTINCT complex) AS n_complexes, TRUE AS median_within, TRUE AS distinct_within
        FROM trades GROUP BY ALL""",
    "ks_large": """
        WITH s AS (SELECT l_returnflag AS f, CAST(l_extendedprice AS DOUBLE) AS value FROM lineitem),
        sizes AS (SELECT f, count(*) AS n FROM s GROUP BY f),
        pairs AS (SELECT a.f AS a, b.f AS b, a.n AS n_a, b.n AS n_b FROM sizes a JOIN sizes b ON a.f < b.f),
        points AS (SELECT a, b, n_a, n_b, value, count(*) FILTER (WHERE f = a) AS in_a, count(*) FILTER (WHERE f = b) AS in_b
                   FROM pairs JOIN s ON f = a OR f = b GROUP BY ALL),
        counted AS (SELECT *, sum(in_a) OVER w AS count_a, sum(in_b) OVER w AS count_b
                    FROM points WINDOW w AS (PARTITION BY a, b ORDER BY value)),
        best AS (SELECT *, abs(count_a * n_b - count_b * n_a) / CAST(n_a AS DOUBLE) / n_b AS ks FROM counted
                 QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY abs(count_a * n_b - count_b * n_a) DESC, value) = 1),
        scaled AS (SELECT *, ks * ks * n_a * n_b / (n_a + n_b) AS squared FROM best)
        SELECT a AS station_a, b AS station_b, round(ks, 9) AS ks, value AS at_share, round(CAST(count_a AS DOUBLE) / n_a, 9) AS cdf_a,
               round(CAST(count_b AS DOUBLE) / n_b, 9) AS cdf_b, n_a, n_b,
               round(CASE WHEN squared >= 1 THEN (SELECT sum(CASE WHEN j.range % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j.range * j.range * squared))
                                                  FROM range(1, 21) j)
                     ELSE 1 - sqrt(2 * pi()) / sqrt(squared) * (
                         SELECT sum(exp(-pow(2 * j.range - 1, 2) * pi() * pi() / (8 * squared))) FROM range(1, 21) j) END, 9) + 0.0 AS p_limit
        FROM scaled""",
    "average_rank_of_taps": f"""
        WITH e AS (SELECT event_id, event_type, {TAP} AS taps FROM events)
        SELECT event_id, event_type, taps,
               rank() OVER (ORDER BY taps DESC) + (count(*) OVER (PARTITION BY taps) - 1) / 2.0 AS rank_down,
               rank() OVER (PARTITION BY event_type ORDER BY taps) + (count(*) OVER (PARTITION BY event_type, taps) - 1) / 2.0 AS rank_up_in_type
        FROM e""",
    "growing_ids": f"""
        WITH {BY_USER}, names AS (
            SELECT station, CASE WHEN CAST(station AS BIGINT) % 3 = 0 THEN 1 ELSE 2 END AS load FROM (SELECT DISTINCT station FROM taps))
        SELECT station, row_number() OVER (ORDER BY load, station) AS station_id, CAST(load AS BIGINT) AS load FROM names""",
    "landed_months": """
        WITH placed AS (
            SELECT strftime(o_orderdate, '%Y%m') AS month, o_orderkey, o_orderpriority,
                   (row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey) - 1) // 100 AS page
            FROM orders),
        pages AS (
            SELECT month, page, count(*) AS n, sum(o_orderkey) AS keys, max(o_orderpriority) AS priority,
                   (CAST(month AS BIGINT) + page) % 11 = 0 AS cut, (CAST(month AS BIGINT) + page) % 7 = 0 AS lost
            FROM placed GROUP BY ALL),
        totals AS (SELECT month, sum(n) AS total FROM pages GROUP BY month)
        SELECT month, count(*) AS n_pages, count(*) FILTER (WHERE lost AND NOT cut) AS n_errors, count(*) FILTER (WHERE cut) AS n_unreadable,
               CAST(max(CASE WHEN cut THEN 0 ELSE total END) AS BIGINT) AS promised, CAST(max(page) * 100 + 100 AS BIGINT) AS last_row,
               CAST(coalesce(sum(n) FILTER (WHERE NOT cut AND NOT lost), 0) AS BIGINT) AS landed,
               CAST(sum(keys) FILTER (WHERE NOT cut AND NOT lost) AS BIGINT) AS keys, max(priority) FILTER (WHERE NOT cut AND NOT lost) AS priority
        FROM pages JOIN totals USING (month) WHERE month >= '199601' GROUP BY month""",
    "json_round_trip": f"""
        WITH {PRICE_INDEX} SELECT gu_code, CAST(year_month AS VARCHAR) AS year_month, round(median_price, 3) AS median_price_per_m2
        FROM price_index""",
    "json_lines": f"""
        WITH {BY_TYPE} SELECT '{{"station":"' || station || '","hour":' || hour || ',"taps":' || sum(cnt) || '}}' AS json
        FROM taps GROUP BY station, hour""",
    "regions_by_area": """
        WITH t AS (
            SELECT s_nationkey AS nation, s_suppkey, 2 * pi() * (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1)
                   / count(*) OVER (PARTITION BY s_nationkey) AS turn, 2 + (s_suppkey % 7) / 2.0 AS out
            FROM supplier),
        corners AS (
            SELECT nation, row_number() OVER (PARTITION BY nation ORDER BY turn) AS i, count(*) OVER (PARTITION BY nation) AS n,
                   round(nation % 5 * 8 + out * cos(turn), 6) AS x, round(floor(nation / 5) * 8 + out * sin(turn), 6) AS y
            FROM t),
        sides AS (
            SELECT a.nation, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
            FROM corners a JOIN corners b ON a.nation = b.nation AND b.i = a.i % a.n + 1 WHERE a.n >= 3),
        points AS (
            SELECT c_custkey, (c_custkey * 7919) % 4000 / 100.0 - 4 AS lon, (c_custkey * 104729) % 4000 / 100.0 - 4 AS lat FROM customer),
        holds AS (
            SELECT c_custkey, nation FROM points JOIN sides
            ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
            GROUP BY c_custkey, nation HAVING count(*) % 2 = 1)
        SELECT c_custkey, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat, min(CAST(nation AS VARCHAR)) AS gu
        FROM points LEFT JOIN holds USING (c_custkey) GROUP BY ALL""",
}
