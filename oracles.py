"""SQL for DuckDB that computes what each registered query must return.

Independent of the Spark code: plain joins, windows and built-in quantiles.
"""

from __future__ import annotations

from lodestat.sources.fixtures import with_views

ORACLES: dict[str, str] = {}

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

MONEY = "try_cast(regexp_replace(price, '[$,]', '', 'g') AS DOUBLE)"

# Cleaned listings, without and with the engineered columns.
BASE = f"""base AS (
  SELECT id, latitude, longitude, {MONEY} AS price,
    coalesce(accommodates, 0) AS accommodates, coalesce(bedrooms, 0) AS bedrooms, beds,
    coalesce(bathrooms, 0.0) AS bathrooms, room_type, property_type, neighbourhood_cleansed, name,
    description, amenities, review_scores_rating, number_of_reviews, reviews_per_month,
    availability_365, availability_30, host_is_superhost, host_response_rate, host_acceptance_rate,
    trim(lower(neighbourhood_cleansed)) AS area
  FROM listings WHERE {MONEY} BETWEEN 20 AND 500)"""


def _has(text: str, words: str) -> str:
    return f"CAST(regexp_matches(lower({text}), '{words}') AS INTEGER)"


LUXURY = "luxury|penthouse|stunning|designer|premium|view|balcony|central"
CLEAN = f"""clean AS (
  SELECT * REPLACE (coalesce(description, '') AS description, coalesce(amenities, '') AS amenities),
    CASE WHEN description IS NULL OR trim(description) = '' THEN 0 ELSE 1 END AS has_description,
    round(CASE WHEN accommodates > 0 THEN price / (accommodates + 0.1) ELSE 0 END, 2) AS price_per_person,
    CAST(latitude > 51.5 AND latitude < 51.52 AS INTEGER) AS is_central_london,
    CAST(length(coalesce(description, '')) AS INTEGER) AS desc_length,
    {_has("coalesce(description, '')", LUXURY)} AS has_luxury_words,
    {_has("coalesce(amenities, '')", "balcony")} AS has_balcony,
    {_has("coalesce(amenities, '')", "view")} AS has_view,
    {_has("coalesce(amenities, '')", "garden")} AS has_garden,
    {_has("coalesce(amenities, '')", "hot tub|jacuzzi")} AS has_hot_tub,
    concat_ws('_', property_type, room_type) AS property_room_combo,
    round(bathrooms * 0.4 + accommodates * 0.3 + bedrooms * 0.2, 6) AS luxury_score
  FROM base)"""

LISTINGS = with_views("listings")
CLEANED = f"{LISTINGS}, {BASE}, {CLEAN}"

SEASON = """CASE WHEN month(date) IN (12, 1, 2) THEN 'winter' WHEN month(date) IN (3, 4, 5) THEN 'spring'
  WHEN month(date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""
SEASONS = f"""booked AS (
  SELECT listing_id, {SEASON} AS season, sum(CASE WHEN available = 'f' THEN 1 ELSE 0 END) AS days
  FROM calendar GROUP BY ALL),
seasons AS (
  SELECT listing_id, season AS dominant_season FROM booked
  QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY days DESC, season) = 1)"""
CRIME = r"""crimes AS (
  SELECT trim(lower(regexp_replace(lsoa_name, '\s\d+[A-Z]$', ''))) AS area, count(*) AS area_crime_count
  FROM crime GROUP BY 1)"""
AREAS = """areas AS (
  SELECT trim(lower(borough)) AS area, avg(median_house_price) AS house_price, avg(mean_household_income) AS income
  FROM income_house GROUP BY 1)"""


def distance(a: str, b: str) -> str:
    h = (f"(pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2) + cos(radians({a}.latitude)) * "
         f"cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2))")
    return f"2 * 6371 * atan2(sqrt({h}), sqrt(1 - {h}))"


ALL_VIEWS = with_views("listings", "calendar", "crime", "stations", "tourist_spots", "income_house")
ORACLES["enriched_listings"] = f"""{ALL_VIEWS}, {BASE}, {CLEAN}, {SEASONS}, {CRIME}, {AREAS},
near_s AS (SELECT l.id, count(*) AS n FROM clean l JOIN stations s ON {distance('l', 's')} <= 1 GROUP BY 1),
near_t AS (SELECT l.id, count(*) AS n FROM clean l JOIN tourist_spots s ON {distance('l', 's')} <= 1 GROUP BY 1)
SELECT c.* REPLACE (coalesce(c.review_scores_rating, 0) AS review_scores_rating),
  s.dominant_season, coalesce(k.area_crime_count, 0) AS area_crime_count,
  coalesce(ns.n, 0) AS stations_within_1km, coalesce(nt.n, 0) AS tourist_spots_within_1km,
  CAST(round(coalesce(a.house_price, 0)) AS INTEGER) AS house_price,
  CAST(round(coalesce(a.income, 0)) AS INTEGER) AS income
FROM clean c LEFT JOIN seasons s ON c.id = s.listing_id LEFT JOIN crimes k ON c.area = k.area
LEFT JOIN near_s ns ON c.id = ns.id LEFT JOIN near_t nt ON c.id = nt.id LEFT JOIN areas a ON c.area = a.area"""

ORACLES["money_clean_filter"] = f"{LISTINGS} SELECT id, {MONEY} AS price FROM listings WHERE {MONEY} BETWEEN 20 AND 500"
ORACLES["row_funnel"] = f"""{LISTINGS}, p AS (SELECT {MONEY} AS price FROM listings)
SELECT 0 AS position, 'read' AS step, count(*) AS n_rows FROM p
UNION ALL SELECT 1, 'price_known', count(*) FROM p WHERE price IS NOT NULL
UNION ALL SELECT 2, 'price_in_range', count(*) FROM p WHERE price BETWEEN 20 AND 500"""
ORACLES["listing_projection"] = f"{LISTINGS} SELECT * FROM listings"
ORACLES["model_columns"] = f"""{CLEANED}
SELECT id, latitude, longitude, price, accommodates, bedrooms, bathrooms, review_scores_rating,
  number_of_reviews AS reviews_total, reviews_per_month, availability_365, availability_30, has_description,
  is_central_london, desc_length, has_luxury_words, has_balcony, has_view, has_garden, has_hot_tub, luxury_score
FROM clean"""
ORACLES["keyed_alignment"] = f"{CLEANED} SELECT id, price, luxury_score, desc_length, property_room_combo FROM clean"
ORACLES["preview"] = f"{LISTINGS} SELECT id, price, room_type, name FROM listings ORDER BY id LIMIT 5"
ORACLES["listing_features"] = f"{CLEANED} SELECT * FROM clean"
ORACLES["listings_without_features"] = f"{LISTINGS}, {BASE} SELECT * FROM base"

ORACLES["cleanse_for_model"] = f"""{LISTINGS},
n AS (SELECT *, try_cast(replace(host_response_rate, '%', '') AS DOUBLE) AS rr,
        try_cast(replace(host_acceptance_rate, '%', '') AS DOUBLE) AS ar FROM listings),
m AS (SELECT median(bedrooms) AS bed, median(beds) AS beds, median(bathrooms) AS bath, median(rr) AS rr,
        median(ar) AS ar FROM n),
o AS (SELECT host_is_superhost AS v FROM n WHERE host_is_superhost IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT DISTINCT n.id, latitude, longitude, price, CAST(accommodates AS DOUBLE) AS accommodates,
  coalesce(CAST(bedrooms AS DOUBLE), m.bed) AS bedrooms, coalesce(CAST(n.beds AS DOUBLE), m.beds) AS beds,
  coalesce(bathrooms, m.bath) AS bathrooms, room_type, property_type, neighbourhood_cleansed, name,
  coalesce(description, 'no description provided') AS description, amenities, review_scores_rating,
  number_of_reviews, coalesce(reviews_per_month, 0) AS reviews_per_month, availability_365, availability_30,
  CASE coalesce(host_is_superhost, o.v) WHEN 't' THEN 1 WHEN 'f' THEN 0 END AS host_is_superhost,
  coalesce(n.rr, m.rr) AS host_response_rate, coalesce(n.ar, m.ar) AS host_acceptance_rate,
  CASE WHEN description IS NULL OR trim(description) = '' THEN 0 ELSE 1 END AS has_description
FROM n, m, o"""
ORACLES["eda_features"] = f"""{CLEANED}
SELECT id, price, round(ln(1 + price), 6) AS log_price, round(price / (accommodates + 1), 6) AS price_per_guest,
  round(price / (bedrooms + 1), 6) AS price_per_bedroom, round(price / (bathrooms + 1), 6) AS price_per_bathroom,
  round(review_scores_rating / (price + 1), 6) AS value_score, CAST(0 AS DOUBLE) AS central_score
FROM clean"""
ORACLES["model_features"] = f"""{LISTINGS}, {BASE},
f AS (SELECT quantile_cont(price, 0.05) AS lo, quantile_cont(price, 0.95) AS hi, avg(latitude) AS la,
        avg(longitude) AS ln FROM base),
w AS (SELECT base.*, f.*, least(greatest(price, lo), hi) AS p FROM base, f)
SELECT id, CAST(len(string_split(coalesce(amenities, 'nan'), ',')) AS INTEGER) AS amenities_count,
  CASE WHEN host_is_superhost = 't' THEN 1 ELSE 0 END AS host_is_superhost,
  round(p, 6) AS price, round(ln(1 + p), 6) AS price_log,
  round(sqrt(pow(latitude - la, 2) + pow(longitude - w.ln, 2)), 6) AS distance_to_center,
  round(bedrooms / (bathrooms + 0.1), 6) AS bed_bath_ratio,
  round(bedrooms / (accommodates + 0.1), 6) AS bedrooms_per_person,
  round((review_scores_rating + review_scores_rating / 2) / 2, 6) AS avg_review_score
FROM w"""
ORACLES["dominant_season"] = f"{with_views('calendar')}, {SEASONS} SELECT listing_id, dominant_season FROM seasons"
ORACLES["top_season_by_window"] = ORACLES["dominant_season"]
ORACLES["suffix_group_count"] = f"{with_views('crime')}, {CRIME} SELECT area, area_crime_count FROM crimes"
ORACLES["borough_averages"] = f"""{with_views('income_house')}, {AREAS}
SELECT area, round(house_price, 4) AS house_price, round(income, 4) AS income FROM areas"""


def _near(km: int) -> str:
    return f"CAST(count(s.station_id) FILTER ({distance('l', 's')} <= {km}) AS BIGINT) AS within_{km}km"


ORACLES["points_within_radius"] = f"""{with_views('listings', 'stations')}
SELECT l.id, {_near(1)}, {_near(3)} FROM listings l, stations s GROUP BY l.id"""
ORACLES["points_within_radius_grid"] = ORACLES["points_within_radius"]
ORACLES["left_join_zero_fill"] = """SELECT d.doc_id, d.lang, coalesce(l.quality, 0) AS quality,
  coalesce(l.toxic, 0) AS toxic, d.source, coalesce(n.n_en, 0) AS n_en
FROM documents d LEFT JOIN labels l USING (doc_id)
LEFT JOIN (SELECT source, count(*) AS n_en FROM documents WHERE lang = 'en' GROUP BY 1) n ON d.source = n.source"""

ORACLES["median_fill"] = f"""{LISTINGS},
n AS (SELECT id, CAST(bedrooms AS DOUBLE) AS b1, CAST(beds AS DOUBLE) AS b2, bathrooms AS b3,
        try_cast(replace(host_response_rate, '%', '') AS DOUBLE) AS r FROM listings),
m AS (SELECT median(b1) AS m1, median(b2) AS m2, median(b3) AS m3, median(r) AS mr FROM n)
SELECT id, coalesce(b1, m1) AS bedrooms, coalesce(b2, m2) AS beds, coalesce(b3, m3) AS bathrooms,
  coalesce(r, mr) AS host_response_rate FROM n, m"""


def _mode(col: str) -> str:
    return (f"(SELECT {col} FROM listings WHERE {col} IS NOT NULL GROUP BY 1 "
            f"ORDER BY count(*) DESC, 1 LIMIT 1)")


ORACLES["mode_fill"] = f"""{LISTINGS}
SELECT id, coalesce(host_is_superhost, {_mode('host_is_superhost')}) AS host_is_superhost,
  coalesce(accommodates, {_mode('accommodates')}) AS accommodates FROM listings"""
ORACLES["percent_fractions"] = f"""{LISTINGS}
SELECT id, round(coalesce(try_cast(rtrim(host_response_rate, '%') AS DOUBLE), 0) / 100, 6) AS host_response_rate,
  round(coalesce(try_cast(rtrim(host_acceptance_rate, '%') AS DOUBLE), 0) / 100, 6) AS host_acceptance_rate
FROM listings"""

LISTING_COLUMNS = [
    "id", "latitude", "longitude", "price", "accommodates", "bedrooms", "beds", "bathrooms", "room_type",
    "property_type", "neighbourhood_cleansed", "name", "description", "amenities", "review_scores_rating",
    "number_of_reviews", "reviews_per_month", "availability_365", "availability_30", "host_is_superhost",
    "host_response_rate", "host_acceptance_rate"]
ORACLES["null_profile"] = LISTINGS + " UNION ALL ".join(
    f""" SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
 round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct FROM listings""" for c in LISTING_COLUMNS)
ORACLES["null_mask"] = f"""{LISTINGS},
b AS (SELECT *, CAST(floor((id - (SELECT min(id) FROM listings)) * 20 /
        (SELECT max(id) - min(id) + 1 FROM listings)) AS INTEGER) AS bucket FROM listings)
""" + " UNION ALL ".join(
    f"""SELECT bucket, count(*) AS n_rows, '{c}' AS "column", count(*) - count({c}) AS nulls
FROM b GROUP BY bucket""" for c in LISTING_COLUMNS[1:])

ORACLES["text_flags"] = f"""SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length,
  {_has('text', LUXURY)} AS has_luxury_words, {_has('text', r'\b(view|the)\b')} AS has_whole_word,
  {_has('text', 'balcony')} AS has_balcony, {_has('text', 'view')} AS has_view,
  {_has('text', 'garden')} AS has_garden, {_has('text', 'hot tub|jacuzzi')} AS has_hot_tub FROM documents"""
ORACLES["dedup"] = "SELECT DISTINCT text, lang FROM documents"
ORACLES["dedup_events"] = """SELECT event_type, by_hour, by_all FROM
(SELECT event_type, count(*) AS by_hour FROM (SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS ts FROM events) GROUP BY 1)
JOIN (SELECT event_type, count(*) AS by_all FROM (SELECT DISTINCT ts, user_id, event_type, value, props FROM events) GROUP BY 1) USING (event_type)"""
ORACLES["host_tenure"] = f"""{with_views("hosts")} SELECT id,
  round(date_diff('day', try_cast(host_since AS DATE), DATE '2025-01-01') / 365, 6) AS tenure FROM hosts"""
ORACLES["duplicate_rows"] = """SELECT a AS n_rows, b AS distinct_rows, a - b AS duplicate_rows
FROM (SELECT count(*) AS a FROM documents), (SELECT count(*) AS b FROM (SELECT DISTINCT text, lang FROM documents))"""

ORACLES["winsorise"] = """SELECT l_orderkey, l_linenumber, round(least(greatest(l_extendedprice,
  (SELECT quantile_cont(l_extendedprice, 0.05) FROM lineitem)),
  (SELECT quantile_cont(l_extendedprice, 0.95) FROM lineitem)), 4) AS l_extendedprice FROM lineitem"""
ORACLES["iqr_report"] = """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
f AS (SELECT *, q3 - q1 AS iqr, greatest(0, q1 - 1.5 * (q3 - q1)) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q),
c AS (SELECT count(*) FILTER (l_extendedprice < f.lower) AS n_low, count(*) FILTER (l_extendedprice > f.upper)
  AS n_high, count(*) AS n FROM lineitem, f)
SELECT round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(iqr, 4) AS iqr,
  round(f.lower, 4) AS lower, round(f.upper, 4) AS upper, n_low, n_high,
  round((n_low + n_high) * 100.0 / n, 4) AS outlier_pct FROM f, c"""
ORACLES["describe_table"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
 round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
 round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM lineitem""" for c in LINE_NUMBERS)

TOP = """SELECT property_type, median(price) AS median, count(*) AS n FROM base GROUP BY 1
  ORDER BY median DESC, property_type LIMIT 10"""
ORACLES["top_categories_by_median"] = f"""{LISTINGS}, {BASE}
SELECT property_type, n, round(median, 4) AS median FROM ({TOP})"""
ORACLES["first_categories"] = f"""{LISTINGS} SELECT DISTINCT property_type FROM listings
WHERE price IS NOT NULL AND property_type IS NOT NULL ORDER BY 1 LIMIT 10"""
ORACLES["top_categories_by_count"] = f"""{LISTINGS} SELECT neighbourhood_cleansed, count(*) AS n FROM listings
WHERE price IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20"""
ORACLES["value_counts"] = f"""{LISTINGS} SELECT amenities, count(*) AS n,
  round(count(*) / (SELECT count(amenities) FROM listings), 6) AS share
FROM listings WHERE amenities IS NOT NULL GROUP BY 1"""
ORACLES["value_counts_with_null"] = f"""{LISTINGS} SELECT coalesce(amenities, 'nan') AS amenities, count(*) AS n
FROM listings GROUP BY 1"""
FLAGS = ["has_luxury_words", "has_balcony", "has_view", "has_garden", "has_hot_tub", "superhost", "is_central_london"]
ORACLES["flag_impact"] = f"""{CLEANED},
s AS (SELECT *, CASE host_is_superhost WHEN 't' THEN 1 WHEN 'f' THEN 0 END AS superhost FROM clean)
""" + " UNION ALL ".join(
    f"""SELECT '{'host_is_superhost' if f == 'superhost' else f}' AS flag, {f} AS value_of_flag,
 round(median(price), 4) AS median, round(avg(price), 4) AS mean, count(*) AS n FROM s WHERE {f} IN (0, 1)
 GROUP BY {f}""" for f in FLAGS)
ORACLES["season_counts_ordered"] = f"""{with_views('calendar')}, {SEASONS}
SELECT CAST(list_position(['winter', 'spring', 'summer', 'autumn'], dominant_season) AS INTEGER) AS position,
  dominant_season, count(*) AS n FROM seasons GROUP BY dominant_season"""
ORACLES["group_mean_profile"] = "SELECT l_returnflag, " + ", ".join(
    f"round(avg({c}), 4) AS {c}" for c in LINE_NUMBERS) + " FROM lineitem GROUP BY 1"


def _corr(a: str, b: str) -> str:
    return f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM lineitem"


ORACLES["correlation_matrix"] = " UNION ALL ".join(
    _corr(a, b) for a in LINE_NUMBERS + ["l_linenumber"] for b in LINE_NUMBERS + ["l_linenumber"])
ORACLES["target_correlates"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 6) AS r FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey"])
ORACLES["drop_constant"] = "SELECT l_orderkey, l_linenumber, l_tax FROM lineitem"
ORDER_COLUMNS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderpriority", "string")]
ORACLES["column_profile"] = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype, true AS nullable,
 '{'Orders' if i == 0 else 'Unknown'}' AS source, '{'Unique order number' if i == 0 else ''}' AS description,
 count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct,
 count(DISTINCT {c}) AS n_distinct FROM orders""" for i, (c, t) in enumerate(ORDER_COLUMNS))
ORACLES["table_shape"] = """SELECT count(*) AS n_rows, 6 AS n_columns, 3 AS n_numeric, 2 AS n_text, 1 AS n_time FROM orders"""
ORACLES["row_mean"] = """SELECT l_orderkey, l_linenumber,
  round((l_quantity + l_discount + l_tax) / 3, 6) AS row_mean FROM lineitem"""


def _histogram(expr: str, source: str, digits: int, bins: int = 60) -> str:
    return f"""WITH v AS (SELECT CAST({expr} AS DOUBLE) AS v FROM {source}),
e AS (SELECT min(v) AS lo, (max(v) - min(v)) / {bins} AS w FROM v),
b AS (SELECT least(CAST(floor((v - lo) / w) AS INTEGER), {bins - 1}) AS bin, count(*) AS n FROM v, e GROUP BY 1)
SELECT CAST(g.i AS INTEGER) AS bin, round(e.lo + g.i * e.w, {digits}) AS bin_lo, coalesce(b.n, 0) AS n
FROM range({bins}) g(i) CROSS JOIN e LEFT JOIN b ON b.bin = g.i"""


ORACLES["histogram"] = _histogram("l_extendedprice", "lineitem", 4)
ORACLES["histogram_log"] = _histogram("ln(1 + value)", "events", 6)
ORACLES["histogram_auto"] = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, bins, least(CAST(floor(({c} - lo) / ((hi - lo) / bins)) AS INTEGER), bins - 1) AS bin,
  count(*) AS n
FROM lineitem, (SELECT lo, hi, CAST(ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, st) ELSE st END) AS INTEGER) AS bins
  FROM (SELECT min({c}) AS lo, max({c}) AS hi, 2 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))
      / pow(count({c}), 1.0 / 3) AS fd, (max({c}) - min({c})) / (log2(count({c})) + 1) AS st FROM lineitem))
GROUP BY ALL""" for c in LINE_NUMBERS)


def _kde(col: str, source: str) -> str:
    return f"""f AS (SELECT min({col}) AS lo, (max({col}) - min({col})) / 199 AS step, count(*) AS n,
  stddev_samp({col}) * pow(count(*), -0.2) AS bw FROM {source}),
d AS (SELECT {col} AS v, count(*) AS c FROM {source} GROUP BY 1),
k AS (SELECT CAST(g.i AS INTEGER) AS point, lo + g.i * step AS x,
  sum(c * exp(-0.5 * pow((lo + g.i * step - v) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS density
  FROM d, f, range(200) g(i) GROUP BY g.i, lo, step)"""


ORACLES["kde_grid"] = f"""WITH {_kde('value', 'events')}
SELECT point, round(x, 8) AS x, round(density, 8) AS density FROM k"""
ORACLES["column_densities"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, point, round(x, 6) AS x, round(density, 8) AS density FROM (WITH {_kde(c, 'lineitem')} SELECT * FROM k)"""
    for c in ("l_quantity", "l_extendedprice"))
ORACLES["violin"] = f"""WITH {_kde('l_quantity', 'lineitem')}
SELECT point, round(x, 8) AS x, round(density, 8) AS density,
  (SELECT quantile_cont(l_quantity, 0.25) FROM lineitem) AS q1,
  (SELECT quantile_cont(l_quantity, 0.5) FROM lineitem) AS median,
  (SELECT quantile_cont(l_quantity, 0.75) FROM lineitem) AS q3 FROM k"""


def _box(col: str, source: str, by: str, digits: int) -> str:
    return f"""SELECT {by} round(q1, {digits}) AS q1, round(median, {digits}) AS median, round(q3, {digits}) AS q3,
  round(min(v) FILTER (ok), {digits}) AS whisker_low, round(max(v) FILTER (ok), {digits}) AS whisker_high,
  count(*) FILTER (NOT ok) AS n_outliers, count(*) AS n
FROM (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM
  (SELECT {by} {col} AS v, quantile_cont({col}, 0.25) OVER w AS q1, quantile_cont({col}, 0.5) OVER w AS median,
    quantile_cont({col}, 0.75) OVER w AS q3 FROM {source}
   WINDOW w AS ({'PARTITION BY ' + by.rstrip(',') if by else ''})))
GROUP BY ALL"""


ORACLES["box_stats"] = _box("value", "events", "event_type,", 6)
ORACLES["box_stats_overall"] = _box("l_extendedprice", "lineitem", "", 4)


def _hex(x: str, y: str) -> str:
    return f"""SELECT '{x}' AS feature, CASE WHEN a THEN 0 ELSE 1 END AS lattice,
  CAST(CASE WHEN a THEN floor(gx + 0.5) ELSE floor(gx) END AS INTEGER) AS i,
  CAST(CASE WHEN a THEN floor(gy + 0.5) ELSE floor(gy) END AS INTEGER) AS j, count(*) AS n
FROM (SELECT *, pow(gx - floor(gx + 0.5), 2) + 3 * pow(gy - floor(gy + 0.5), 2) <
        pow(gx - floor(gx) - 0.5, 2) + 3 * pow(gy - floor(gy) - 0.5, 2) AS a
  FROM (SELECT ({x} - x0 + 1e-9 * (x1 - x0)) / ((x1 - x0 + 2 * (1e-9 * (x1 - x0))) / 30) AS gx,
      ({y} - y0 + 1e-9 * (y1 - y0)) / ((y1 - y0 + 2 * (1e-9 * (y1 - y0))) / 17) AS gy
    FROM l, (SELECT min({x}) AS x0, max({x}) AS x1, min({y}) AS y0, max({y}) AS y1 FROM l)))
GROUP BY ALL"""


LINES = "l AS (SELECT *, CAST(floor(l_discount * 50) AS DOUBLE) AS discount_band FROM lineitem)"
ORACLES["hexbin"] = f"WITH {LINES} {_hex('l_quantity', 'l_extendedprice')}"
ORACLES["numeric_vs_target"] = f"""WITH {LINES}
SELECT 'discount_band' AS feature, 'box' AS kind, discount_band AS level,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
  round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, CAST(NULL AS INTEGER) AS lattice,
  CAST(NULL AS INTEGER) AS i, CAST(NULL AS INTEGER) AS j, count(*) AS n
FROM l GROUP BY discount_band
UNION ALL SELECT feature, 'hex', NULL, NULL, NULL, NULL, lattice, i, j, n
FROM ({_hex('l_quantity', 'l_extendedprice')})
UNION ALL SELECT feature, 'hex', NULL, NULL, NULL, NULL, lattice, i, j, n
FROM ({_hex('l_tax', 'l_extendedprice')})"""
PAIRS = [(a, a) for a in LINE_NUMBERS] + [
    (a, b) for i, a in enumerate(LINE_NUMBERS) for b in LINE_NUMBERS[i + 1:]]
ORACLES["pair_bins"] = "WITH s AS (SELECT " + ", ".join(
    f"least(CAST(floor(({c} - (SELECT min({c}) FROM lineitem)) / ((SELECT max({c}) - min({c}) FROM lineitem) / 20)) "
    f"AS INTEGER), 19) AS {c}" for c in LINE_NUMBERS) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {a} AS bx, {b} AS by, count(*) AS n FROM s GROUP BY {', '.join(dict.fromkeys([a, b]))}"
    for a, b in PAIRS)


def _grid(x: str, y: str, dx: float, dy: float) -> str:
    return f"""{LISTINGS}, {BASE},
p AS (SELECT {x} AS x, {y} AS y, price FROM base WHERE {x} IS NOT NULL AND {y} IS NOT NULL)
SELECT CAST(floor(x / {dx}) AS INTEGER) AS cx, CAST(floor(y / {dy}) AS INTEGER) AS cy,
  round(avg(least(price, (SELECT quantile_cont(price, 0.95) FROM p))), 6) AS mean_value, count(*) AS n
FROM p GROUP BY 1, 2"""


ORACLES["geo_price_grid"] = _grid("longitude", "latitude", "CAST(0.05 AS DOUBLE)", "CAST(0.05 AS DOUBLE)")
ORACLES["availability_review_grid"] = _grid("availability_365", "reviews_per_month", 30, 1)


def unit(key: str, seed: str = "42") -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


SIDES = f"{CLEANED}, sides AS (SELECT *, {unit('id')} < 0.2 AS is_test FROM clean)"
ORACLES["freq_encode"] = f"""{SIDES},
t AS (SELECT property_type, count(*) / (SELECT count(property_type) FROM sides WHERE NOT is_test) AS share
  FROM sides WHERE NOT is_test GROUP BY 1)
SELECT id, CASE WHEN is_test THEN 'test' ELSE 'train' END AS side, round(coalesce(share, 0), 6) AS share
FROM sides LEFT JOIN t USING (property_type)"""
ORACLES["split_assign"] = f"{LISTINGS} SELECT id, CAST({unit('id')} < 0.2 AS INTEGER) AS is_test FROM listings"
ORACLES["fold_assign"] = f"{LISTINGS} SELECT id, " + ", ".join(
    f"CAST(floor({unit('id', '42:fold')} * {k}) AS INTEGER) AS fold_of_{k}" for k in (3, 4, 5)) + " FROM listings"
ROUTED = ["room_type", "property_type", "area", "property_room_combo", "host_is_superhost"]
ORACLES["cardinality_route"] = SIDES + " UNION ALL ".join(
    f""" SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
 CASE WHEN count(DISTINCT {c}) > 20 THEN 'frequency' ELSE 'one_hot' END AS encoding
 FROM sides WHERE NOT is_test""" for c in ROUTED)

# Sorted room types of the test tables; the first one is the dropped level.
HOT = ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
ORACLES["one_hot"] = f"{SIDES} SELECT id, " + ", ".join(
    f"CASE WHEN room_type = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS room_type_{v}" for v in HOT
) + " FROM sides WHERE is_test"
ORACLES["encode_matrix"] = f"""{SIDES},
t AS (SELECT property_type, count(*) / (SELECT count(property_type) FROM sides WHERE NOT is_test) AS share
  FROM sides WHERE NOT is_test GROUP BY 1)
SELECT id, CAST(accommodates AS DOUBLE) AS f0, bathrooms AS f1,
  round(coalesce(try_cast(rtrim(host_response_rate, '%') AS DOUBLE), 0) / 100, 6) AS f2,
  round(coalesce(share, 0), 6) AS f3, """ + ", ".join(
    f"CASE WHEN room_type = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f{i + 4}" for i, v in enumerate(HOT)
) + ", price AS y FROM sides LEFT JOIN t USING (property_type) WHERE is_test"


SIZE = 64
ORACLES["standard_scale"] = "SELECT vec_id, " + ", ".join(
    f"round((x[{i + 1}] - avg(x[{i + 1}]) OVER ()) / stddev_pop(x[{i + 1}]) OVER (), 6) AS d{i}" for i in range(SIZE)
) + " FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
NEAREST = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
c AS (SELECT label, list(m ORDER BY i) AS x FROM
  (SELECT label, i, avg(v) AS m FROM (SELECT label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e)
   GROUP BY label, i) GROUP BY label),
n AS (SELECT e.vec_id, c.label AS cluster, pow(list_distance(e.x, c.x), 2) AS distance FROM e, c
  QUALIFY row_number() OVER (PARTITION BY e.vec_id ORDER BY distance, c.label) = 1)"""
ORACLES["kmeans_assign"] = f"{NEAREST} SELECT vec_id, cluster, round(distance, 6) AS distance FROM n"
ORACLES["kmeans_inertia"] = f"{NEAREST} SELECT round(sum(distance), 4) AS inertia, count(*) AS n FROM n"


def _silhouette(dist: str) -> str:
    return f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT p.vec_id, p.label, q.label AS near, sum({dist}) AS total, count(*) AS size
  FROM e p, e q GROUP BY ALL),
m AS (SELECT vec_id, label, max(CASE WHEN near = label AND size > 1 THEN total / (size - 1) END) AS a,
  min(CASE WHEN near <> label THEN total / size END) AS b FROM d GROUP BY ALL),
s AS (SELECT *, CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM m)"""


ORACLES["silhouette_exact"] = f"""{_silhouette('list_distance(p.x, q.x)')}
SELECT vec_id, CAST(label AS VARCHAR) AS cluster, round(a, 6) AS a, round(b, 6) AS b,
  round(silhouette, 6) AS silhouette FROM s"""
ORACLES["silhouette_squared"] = f"""{_silhouette('pow(list_distance(p.x, q.x), 2)')}
SELECT round(avg(silhouette), 6) AS silhouette_squared FROM s"""

SEGMENTS = f"""{with_views('listings', 'stations')}, {BASE}, {CLEAN},
near AS (SELECT l.id, count(*) AS n FROM clean l JOIN stations s ON {distance('l', 's')} <= 1 GROUP BY 1),
f AS (SELECT id, room_type, ln(1 + price) AS log_price, review_scores_rating / (price + 1) AS value_score, accommodates,
  coalesce(n, 0) * 0.5 AS central_score FROM clean LEFT JOIN near USING (id)),
p AS (SELECT room_type, avg(log_price) AS log_price, avg(value_score) AS value_score,
  avg(accommodates) AS accommodates, avg(central_score) AS central_score FROM f GROUP BY 1),
m AS (SELECT median(central_score) AS c, median(value_score) AS v, median(accommodates) AS a FROM p),
labelled AS (SELECT p.*, CASE WHEN central_score > c THEN 'Premium Central' WHEN value_score > v THEN 'High Value'
  WHEN accommodates > a THEN 'Large Group Premium' ELSE 'Mid-Range' END AS segment FROM p, m)"""
ORACLES["segment_labels"] = f"""{SEGMENTS} SELECT room_type, round(log_price, 6) AS log_price,
  round(value_score, 6) AS value_score, round(accommodates, 6) AS accommodates,
  round(central_score, 6) AS central_score, segment FROM labelled"""
ORACLES["segment_counts"] = f"""{SEGMENTS} SELECT segment, count(*) AS n FROM f JOIN labelled USING (room_type)
GROUP BY 1"""


def _hidden(j: int, hidden: int = 4) -> str:
    terms = " + ".join(f"x[{i + 1}] * ({((i * 7 + j * 13) % 11 - 5) / 8}::DOUBLE)" for i in range(SIZE))
    return f"{(j + 1) / 2}::DOUBLE * greatest(0::DOUBLE, {terms} + ({(j - 1) / 4}::DOUBLE))"


ORACLES["mlp_predict"] = "SELECT vec_id, round(" + " + ".join(_hidden(j) for j in range(4)) + """ + 0.25::DOUBLE, 6)
  AS prediction FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"""


def picked(key: str, n: int, seed: str) -> str:
    return f"CAST(floor({unit(key, seed)} * {n}) AS INTEGER)"


WIDE = [("hidden", ["32", "64", "64,32", "128,64"]), ("activation", ["relu", "tanh"]), ("alpha", [0.0001, 0.001]),
        ("learning_rate", [0.001, 0.005, 0.01]), ("batch_size", [32, 64])]
SPACE = [("hidden", ["32", "64", "64,32"]), ("activation", ["relu", "tanh"]), ("alpha", [0.0001, 0.001]),
         ("learning_rate", [0.001, 0.005]), ("batch_size", [32, 64])]


def _values(options: list) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)
                           for v in options) + "]"


GRID = "grid AS (SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS trial, * FROM (SELECT " + ", ".join(
    n for n, _ in WIDE) + " FROM " + ", ".join(
    f"(SELECT unnest({_values(v)}) AS {n}, generate_subscripts({_values(v)}, 1) AS k{i})"
    for i, (n, v) in enumerate(WIDE)) + " ORDER BY k0, k1, k2, k3, k4))"
ORACLES["param_grid"] = f"""WITH {GRID},
s AS (SELECT {picked('event_id', 96, 'grid')} AS trial, count(*) AS n_events, round(avg(value), 6) AS score
  FROM events GROUP BY 1)
SELECT * FROM grid JOIN s USING (trial)"""
ORACLES["param_sample"] = "SELECT user_id, " + ", ".join(
    f"({_values(v)})[{picked('user_id', len(v), '42:' + n)} + 1] AS {n}" for n, v in SPACE
) + " FROM (SELECT DISTINCT user_id FROM events)"
CV = f"""WITH p AS (SELECT {picked('user_id', 24, 'trial')} AS trial, {picked('event_id', 4, '42:fold')} AS fold,
  ln(1 + value) * 0.9 + user_id * 0.001 - ln(1 + value) AS e FROM events),
f AS (SELECT trial, fold, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM p GROUP BY 1, 2),
c AS (SELECT trial, round(avg(rmse), 6) AS rmse_mean, round(stddev_pop(rmse), 6) AS rmse_std,
  round(avg(mae), 6) AS mae_mean, count(*) AS folds FROM f GROUP BY 1)"""
ORACLES["cv_scores"] = f"{CV} SELECT * FROM c"
ORACLES["best_trial"] = f"{CV} SELECT trial, rmse_mean FROM c ORDER BY rmse_mean, trial LIMIT 1"
RUNGS = [10, 20, 40, 80, 160]
ORACLES["halving_rungs"] = f"""WITH s AS (SELECT {picked('user_id', 64, 'trial')} AS trial,
  ([10, 20, 40, 80, 160])[{picked('event_id', 5, 'rung')} + 1] AS rung, avg(value) AS score FROM events GROUP BY 1, 2)
""" + "".join(f""", r{k} AS (SELECT *, row_number() OVER (ORDER BY score, trial) AS place, count(*) OVER () AS n
  FROM s WHERE rung = {r}{f" AND trial IN (SELECT trial FROM r{k - 1} WHERE place <= greatest(1, n // 2))" if k else ""})
""" for k, r in enumerate(RUNGS)) + " UNION ALL ".join(
    f"SELECT trial, rung, round(score, 6) AS score, CAST(place AS INTEGER) AS place, "
    f"CAST(place <= greatest(1, n // 2) AS INTEGER) AS kept FROM r{k}" for k in range(5))


def _metrics(factor: int) -> str:
    def part(y: str, p: str, s: str) -> str:
        return (f"round(sqrt(avg(pow({p} - {y}, 2))), 4) AS rmse_{s}, round(avg(abs({p} - {y})), 4) AS mae_{s}, "
                f"round(1 - sum(pow({p} - {y}, 2)) / (var_pop({y}) * count(*)), 4) AS r2_{s}")
    return f"""{part('y', 'p', 'log')}, {part('(exp(y) - 1)', '(exp(p) - 1)', 'real')}
FROM (SELECT ln(1 + l_extendedprice) AS y, ln(1 + l_quantity * {factor} * (1 + l_tax)) AS p FROM lineitem)"""


ORACLES["regression_metrics"] = f"SELECT {_metrics(2000)}"
ORACLES["leaderboard"] = " UNION ALL ".join(
    f"SELECT 'factor {f}' AS model, '{{\"factor\": {f}}}' AS best_params, {_metrics(f)}" for f in (1000, 2000, 3000)
) + """ UNION ALL SELECT 'no rows', '{}', NULL, NULL, NULL, NULL, NULL, NULL"""

ORACLES["standard_scale_columns"] = "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in LINE_NUMBERS) + " FROM lineitem"
ORACLES["capped_points"] = f"""{LISTINGS}, {BASE} SELECT longitude AS x, latitude AS y,
  round(least(price, (SELECT quantile_cont(price, 0.95) FROM base)), 6) AS v FROM base"""
