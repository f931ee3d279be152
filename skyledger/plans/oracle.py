"""The registered queries in SQL, written independently of the DataFrame code.

Rounded aggregates follow ``functions.values.round_aggregate``: through eight decimals to two, on
the decimal that the double prints as, which rounds halves up as Spark does.
"""

from __future__ import annotations


def rounded(x: str) -> str:
    return f"round(round(cast(cast({x} as varchar) as decimal(38,18)), 8), 2)::double"


def rounded_row(x: str) -> str:
    return f"round(cast(cast({x} as varchar) as decimal(38,18)), 2)::double"


RUN_DATE = "'2024-02-01'"

# Named subqueries: name -> (names it reads, SQL).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, sql: str, *reads: str) -> None:
    PARTS[name] = (reads, sql)


def sql(body: str, *reads: str) -> str:
    """``body`` behind a WITH clause that holds all it reads, directly and indirectly."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in PARTS[name][0]:
                visit(other)
            if name not in ordered:
                ordered.append(name)

    for name in reads:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in ordered) + "\n" + body


part("ev", "SELECT *, floor(value * 100)::integer % 100 AS k FROM events")

part("manifest", """
SELECT 'GHCND:U' || c_custkey AS noaa_station_id, c_name AS station_name,
  CASE n_nationkey WHEN 24 THEN 'LOST' WHEN 22 THEN '' ELSE n_name END AS state,
  CASE n_nationkey WHEN 23 THEN 'NOLAND' WHEN 21 THEN '' ELSE r_name END AS country,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'TRUE' WHEN 'AUTOMOBILE' THEN ' yes ' WHEN 'MACHINERY' THEN ''
    WHEN 'HOUSEHOLD' THEN '0' ELSE 'no' END AS ingest_enabled,
  (c_custkey + 1)::integer AS priority_rank,
  CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'n/a' ELSE lat END AS latitude,
  lon AS longitude,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'K' || c_custkey END AS nws_station_id,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'M' || c_custkey ELSE '' END AS meteostat_station_id,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN lat ELSE '' END AS meteostat_query_latitude,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN lon ELSE '' END AS meteostat_query_longitude
FROM (
  SELECT *,
    CAST((((n_nationkey * 5 - 60 + CASE WHEN c_mktsegment = 'FURNITURE' THEN 2 ELSE 0 END) * 10000
      + (c_custkey * 7919) % 10000) / 10000.0) AS decimal(9,4))::varchar AS lat,
    CAST((((n_nationkey * 14 - 168) * 10000 + (c_custkey * 6007) % 10000) / 10000.0) AS decimal(9,4))::varchar AS lon
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)""")

part("catalog", """
SELECT p_partkey AS position, 'M' || p_partkey AS id, p_name AS name,
  NULLIF(CASE WHEN p_type = 'LARGE' AND n_nationkey < 20 THEN '' WHEN p_type = 'PROMO' THEN 'ELSEWHERE'
    ELSE coalesce(r_name, 'SEA') END, '') AS country,
  CASE WHEN p_brand = 'Brand#1' AND p_type <> 'LARGE' THEN NULL ELSE coalesce(n_name, 'SEA') END AS region,
  CASE WHEN p_type IN ('SMALL', 'STANDARD') THEN 'U' || (p_partkey // 2) END AS national,
  CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'K' || (p_partkey // 3) END AS icao,
  CASE WHEN p_brand <> 'Brand#2' THEN
    (((p_size % 25) * 5 - 60) * 10000 + (p_partkey * 4447) % 10000)::double / 10000 END AS latitude,
  CASE WHEN p_brand <> 'Brand#2' THEN
    (((p_size % 25) * 14 - 168) * 10000 + (p_partkey * 2741) % 10000)::double / 10000 END AS longitude,
  p_retailprice AS elevation,
  make_date((p_partkey * 31 % 40 + 1990)::bigint, 1, 1) AS daily_start,
  CASE WHEN p_type <> 'MEDIUM' OR p_brand <> 'Brand#3' THEN date '2024-06-30' END AS daily_end
FROM part LEFT JOIN nation ON p_size = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")

part("raw_long", f"""
SELECT {RUN_DATE} AS run_date, CASE WHEN k <> 99 THEN 'GHCND:U' || user_id END AS noaa_station_id,
  'Station ' || user_id AS station_name, 'S' || (user_id % 50) AS state, 'US' AS country,
  (user_id % 90) + 0.25::double AS latitude, -((user_id % 180) + 0.5::double) AS longitude,
  CASE WHEN k <> 97 THEN ts::date END AS day,
  CASE WHEN k = 98 THEN NULL WHEN k < 8 THEN 'SNOW' WHEN k < 14 THEN 'SNWD' ELSE
    CASE event_type WHEN 'view' THEN 'TAVG' WHEN 'click' THEN 'TMIN' WHEN 'purchase' THEN 'TMAX'
      WHEN 'error' THEN 'PRCP' WHEN 'signup' THEN 'AWND' END END AS datatype,
  value FROM ev""", "ev")

part("long_marked", """
SELECT *, CASE WHEN noaa_station_id IS NULL THEN 'missing_station' WHEN datatype IS NULL THEN 'missing_datatype'
  WHEN day IS NULL THEN 'bad_date' END AS reject_reason FROM raw_long""", "raw_long")

part("long_daily", f"""
SELECT 'noaa' AS source, day AS date, noaa_station_id, noaa_station_id AS source_station_id, station_name, state,
  country, latitude, longitude,
  coalesce(tavg, {rounded_row("((tmin + tmax) / 2)")}) AS avg_temp_c, tmin AS min_temp_c, tmax AS max_temp_c,
  prcp AS precip_mm, awnd AS avg_wind_mps, NULL::double AS max_wind_mps, snow AS snow_mm, obs_count,
  run_date AS ingest_run_date
FROM (
  SELECT noaa_station_id, station_name, state, country, latitude, longitude, run_date, day,
    count(*) AS obs_count,
    max(value) FILTER (datatype = 'TAVG') AS tavg, max(value) FILTER (datatype = 'TMIN') AS tmin,
    max(value) FILTER (datatype = 'TMAX') AS tmax, max(value) FILTER (datatype = 'PRCP') AS prcp,
    max(value) FILTER (datatype = 'AWND') AS awnd, max(value) FILTER (datatype = 'SNOW') AS snow
  FROM long_marked WHERE reject_reason IS NULL GROUP BY ALL
)""", "long_marked")

part("obs", f"""
SELECT *, CASE WHEN station_id IS NULL THEN 'missing_station'
  WHEN temperature_c IS NULL AND wind_mps IS NULL THEN 'no_measure' END AS reject_reason
FROM (
  SELECT {RUN_DATE} AS run_date, event_id, ts, ts::varchar || '+00:00' AS stamp, user_id, k, event_type,
    CASE WHEN k <> 99 THEN 'K' || user_id END AS station_id,
    CASE WHEN event_type <> 'click' THEN 'Site ' || user_id || ' ' || (k % 3) END AS station_name,
    (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local_ts,
    ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::date AS day,
    CASE WHEN event_type <> 'error' THEN value END AS temperature_c,
    CASE WHEN event_type NOT IN ('error', 'signup') THEN
      CASE WHEN k < 90 AND k % 2 = 0 THEN k::double / 3.6 ELSE k::double END END AS wind_mps,
    CASE WHEN event_type <> 'purchase' THEN (user_id % 90)::double END AS plat,
    CASE WHEN event_type <> 'purchase' THEN (k % 3 - 100)::double END AS plon
  FROM ev
)""", "ev")

OBS_DAYS = f"""
SELECT station_id, run_date, day,
  arg_min(station_name, ts) FILTER (station_name IS NOT NULL) AS station_name,
  arg_min(plat, ts) FILTER (plat IS NOT NULL) AS latitude,
  arg_min(plon, ts) FILTER (plat IS NOT NULL) AS longitude,
  count(*) AS obs_count, {rounded("avg(temperature_c)")} AS avg_temp_c,
  min(temperature_c) AS min_temp_c, max(temperature_c) AS max_temp_c,
  {rounded("avg(wind_mps)")} AS avg_wind_mps, {rounded("max(wind_mps)")} AS max_wind_mps
FROM obs WHERE reject_reason IS NULL %s GROUP BY station_id, run_date, day"""

# Events arrive in ten files; a day closes when the newest local time, less two days, is past it.
part("fed", """
SELECT *, least(9, least(9, (ts::date - date '2024-01-01') // 3) + CASE k WHEN 7 THEN 4 WHEN 8 THEN 1 ELSE 0 END) AS feed FROM obs
WHERE reject_reason IS NULL""", "obs")
part("marks", """
SELECT feed, (max(max(local_ts)) OVER (ORDER BY feed) - interval 2 day)::date AS open_from FROM fed GROUP BY feed""", "fed")
part("timed", """
SELECT f.*, f.day < coalesce((SELECT max(open_from) FROM marks m WHERE m.feed < f.feed), date '0001-01-01') AS late,
  (SELECT min(feed) FROM marks m WHERE m.feed >= f.feed AND m.open_from > f.day) AS batch
FROM fed f""", "fed", "marks")

OBS_DAILY = """
SELECT 'nws' AS source, day AS date, m.noaa_station_id, station_id AS source_station_id,
  coalesce(m.station_name, d.station_name) AS station_name, m.state, m.country,
  coalesce(try_cast(m.latitude AS double), d.latitude) AS latitude,
  coalesce(try_cast(m.longitude AS double), d.longitude) AS longitude,
  avg_temp_c, min_temp_c, max_temp_c, NULL::double AS precip_mm, avg_wind_mps, max_wind_mps,
  NULL::double AS snow_mm, obs_count, run_date AS ingest_run_date
FROM %s d LEFT JOIN manifest m ON d.station_id = m.nws_station_id"""

part("obs_days", OBS_DAYS % "", "obs")
part("obs_daily", OBS_DAILY % "obs_days", "obs_days", "manifest")
part("earlier_obs_days", OBS_DAYS % "AND ts < timestamp '2024-01-16'", "obs")
part("earlier_obs_daily", OBS_DAILY % "earlier_obs_days", "earlier_obs_days", "manifest")

part("raw_wide", f"""
SELECT *, CASE WHEN noaa_station_id IS NULL THEN 'missing_station' WHEN temp IS NULL THEN 'no_measure' END
  AS reject_reason
FROM (
  SELECT {RUN_DATE} AS run_date,
    CASE WHEN l_tax > 0 OR l_linenumber > 1 THEN 'GHCND:U' || l_suppkey END AS noaa_station_id,
    'Supplier ' || l_suppkey AS station_name, 'S' || (l_suppkey % 50) AS state, 'US' AS country,
    (l_suppkey % 90) + 0.75::double AS latitude, -((l_suppkey % 180) + 0.25::double) AS longitude,
    'M' || l_suppkey AS meteostat_station_id, l_shipdate::date AS day,
    CASE WHEN has THEN l_quantity END AS temp, CASE WHEN has THEN l_quantity - 5 END AS tmin,
    CASE WHEN has THEN l_quantity + 5 END AS tmax, CASE WHEN has THEN l_extendedprice END AS prcp,
    CASE WHEN has THEN l_tax * 100 END AS snwd, CASE WHEN has THEN l_quantity END AS wspd,
    CASE WHEN has AND l_linenumber <> 7 THEN l_quantity * 2 END AS wpgt
  FROM (SELECT *, l_tax > 0 OR l_discount > 0 AS has FROM lineitem)
)""")

part("wide_daily", """
SELECT 'meteostat' AS source, day AS date, noaa_station_id, meteostat_station_id AS source_station_id,
  station_name, state, country, latitude, longitude, temp AS avg_temp_c, tmin AS min_temp_c,
  tmax AS max_temp_c, prcp AS precip_mm, wspd / 3.6::double AS avg_wind_mps, wpgt / 3.6::double AS max_wind_mps,
  snwd * 10 AS snow_mm, 1::bigint AS obs_count, run_date AS ingest_run_date
FROM raw_wide WHERE reject_reason IS NULL""", "raw_wide")

CALENDAR = "SELECT *, year(date)::integer AS year, month(date)::integer AS month FROM"
part("unified", f"""{CALENDAR} (
  SELECT * FROM long_daily UNION ALL BY NAME SELECT * FROM obs_daily UNION ALL BY NAME SELECT * FROM wide_daily
)""", "long_daily", "obs_daily", "wide_daily")

# The choice among several positions of a station-year (least latitude, then longitude) is ours.
YEARLY = f"""
SELECT source, noaa_station_id, station_name, state, country, year,
  first(latitude ORDER BY latitude NULLS LAST, longitude NULLS LAST) AS latitude,
  first(longitude ORDER BY latitude NULLS LAST, longitude NULLS LAST) AS longitude, count(*) AS days_covered, {rounded("avg(avg_temp_c)")} AS annual_avg_temp_c,
  {rounded("avg(min_temp_c)")} AS annual_avg_min_temp_c, {rounded("avg(max_temp_c)")} AS annual_avg_max_temp_c,
  {rounded("sum(precip_mm)")} AS annual_precip_mm, {rounded("avg(avg_wind_mps)")} AS annual_avg_wind_mps
FROM %s GROUP BY source, noaa_station_id, station_name, state, country, year"""
part("yearly_station", YEARLY % "unified", "unified")

part("ghcn", """
SELECT noaa_station_id, station_code, day, datatype,
  CASE WHEN datatype IN ('TAVG', 'TMAX', 'TMIN', 'PRCP', 'AWND') THEN reading / 10 ELSE reading END AS value,
  attributes
FROM (
  SELECT 'GHCND:U' || o_custkey AS noaa_station_id, 'U' || o_custkey AS station_code,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN
      CASE WHEN month(o_orderdate) IN (1, 3, 5, 7, 8, 10, 12)
        THEN make_date(year(o_orderdate), month(o_orderdate), 31) END
      ELSE o_orderdate::date END AS day,
    CASE o_orderpriority WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'O' THEN 'TAVG' ELSE 'TMAX' END
      WHEN '2-HIGH' THEN 'TMIN' WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'O' THEN 'PRCP' ELSE 'SNOW' END
      WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'O' THEN 'WT01' ELSE 'SNWD' END
      ELSE 'AWND' END AS datatype,
    CASE WHEN o_totalprice >= 80000 THEN floor(o_totalprice) END AS reading,
    'mflag=' || CASE o_orderstatus WHEN 'O' THEN 'P' ELSE '' END
      || ',qflag=' || CASE o_orderpriority WHEN '2-HIGH' THEN 'I' ELSE '' END
      || ',sflag=W,obs_time=' || CASE o_orderstatus WHEN 'P' THEN '' ELSE '2400' END AS attributes
  FROM orders
)""")

part("dated", """
SELECT 'M' || o_custkey AS meteostat_station_id,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 20000 THEN 'bad'
    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ok'
    WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') AND o_totalprice >= 50000 THEN 'ok'
    ELSE 'skip' END AS date_status,
  CASE WHEN date_status = 'ok' THEN o_orderdate::date END AS observed_on,
  floor(o_totalprice / 1000) AS temp,
  CASE WHEN o_totalprice > 100000 THEN floor(o_totalprice / 1000) END AS tmin,
  CASE WHEN o_totalprice > 200000 THEN floor(o_totalprice / 1000) END AS tmax,
  CASE WHEN o_totalprice > 300000 THEN floor(o_totalprice / 1000) END AS prcp,
  NULL::double AS snwd, floor(o_totalprice / 1000) AS wspd
FROM orders""")

part("feature", """
SELECT *, CASE WHEN event_type = 'view' THEN 'file:/data/raw/' || ts::date || '/nws_raw.json'
    ELSE 'file:/data/raw/nws/run_date=' || ts::date || '/station=K' || user_id || '/nws_raw.json' END AS path
FROM ev LEFT JOIN (VALUES ('a'), ('b')) f(which)
  ON event_type <> 'signup' AND (which = 'a' OR event_type = 'error')""", "ev")

HAVERSINE = """2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
  + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"""

part("reaching_back", """
SELECT * FROM catalog WHERE daily_start <= date '2014-01-01' AND daily_end >= date '2014-01-01'""", "catalog")

part("place", """
SELECT *, try_cast(coalesce(NULLIF(meteostat_query_latitude, ''), NULLIF(latitude, '')) AS double) AS qlat,
  try_cast(coalesce(NULLIF(meteostat_query_longitude, ''), NULLIF(longitude, '')) AS double) AS qlon
FROM manifest""", "manifest")

part("nearest", f"""
SELECT qlat, qlon, country, state, position, km FROM (
  SELECT q.*, c.position, {HAVERSINE.format(lat1="qlat", lon1="qlon", lat2="c.latitude", lon2="c.longitude")} AS km,
    q.country = '' OR c.country IS NULL OR c.country = q.country AS in_country
  FROM (SELECT DISTINCT qlat, qlon, country, state FROM place WHERE qlat IS NOT NULL AND qlon IS NOT NULL) q
  JOIN reaching_back c ON c.latitude IS NOT NULL AND c.longitude IS NOT NULL
    AND (q.state = '' OR c.region IS NULL OR c.region = q.state)
) QUALIFY row_number() OVER (PARTITION BY qlat, qlon, country, state ORDER BY in_country DESC, km, position) = 1""",
     "place", "reaching_back")

part("matched", f"""
SELECT m.*, CASE WHEN i.position IS NOT NULL THEN 'meteostat_station_id' WHEN n.position IS NOT NULL THEN 'national'
    WHEN o.position IS NOT NULL THEN 'icao' WHEN km <= 100 THEN 'nearest' END AS match_type,
  coalesce(i.position, n.position, o.position, CASE WHEN km <= 100 THEN f.position END) AS position,
  CASE WHEN match_type = 'nearest' THEN {rounded_row("km")} END AS distance_km, km
FROM place m
LEFT JOIN reaching_back i ON i.id = m.meteostat_station_id
LEFT JOIN (SELECT * FROM last_national JOIN reaching_back USING (position)) n
  ON n.code = substr(m.noaa_station_id, 7)
LEFT JOIN (SELECT * FROM last_icao JOIN reaching_back USING (position)) o ON o.code = m.nws_station_id
LEFT JOIN nearest f ON f.qlat = m.qlat AND f.qlon = m.qlon AND f.country = m.country AND f.state = m.state""",
     "place", "last_national", "last_icao", "nearest")
part("last_national", "SELECT national AS code, max(position) AS position FROM catalog WHERE national IS NOT NULL GROUP BY 1",
     "catalog")
part("last_icao", "SELECT icao AS code, max(position) AS position FROM catalog WHERE icao IS NOT NULL GROUP BY 1", "catalog")

DOCUMENT = """
SELECT coalesce(source, 'unknown') || '|' || coalesce(NULLIF(source_station_id, ''), NULLIF(noaa_station_id, ''),
    'unknown_station') || '|' || coalesce(date::varchar, 'unknown_date') AS _id,
  * REPLACE (date::varchar AS date), 'curated' AS "dataLevel", 'climate_daily' AS "recordType"
FROM"""
# Newest first, then the greatest by content in column order, nulls lowest.
CONTENT = (
    "source", "date", "noaa_station_id", "source_station_id", "station_name", "state", "country", "latitude",
    "longitude", "avg_temp_c", "min_temp_c", "max_temp_c", "precip_mm", "avg_wind_mps", "max_wind_mps", "snow_mm",
    "obs_count", "year", "month",
)
LATEST = (
    "SELECT * FROM (%s) QUALIFY row_number() OVER (PARTITION BY _id ORDER BY ingest_run_date DESC, "
    + ", ".join(f"{name} DESC NULLS LAST" for name in CONTENT) + ") = 1"
)
part("documents_all", f"{DOCUMENT} unified", "unified")
part("snapshot", LATEST % f"""{DOCUMENT} ({CALENDAR}
  (SELECT * FROM long_daily UNION ALL BY NAME SELECT * FROM earlier_obs_daily))""",
     "long_daily", "earlier_obs_daily")
part("handed_over", f"""{DOCUMENT} ({CALENDAR}
  (SELECT * FROM obs_daily UNION ALL BY NAME SELECT * FROM wide_daily))""", "obs_daily", "wide_daily")
part("incoming", LATEST % "SELECT * FROM handed_over", "handed_over")
part("incoming_obs", LATEST % f"{DOCUMENT} ({CALENDAR} obs_daily)", "obs_daily")

FIELDS = CONTENT + ("ingest_run_date", '"dataLevel"', '"recordType"')
MERGE = (
    "SELECT _id, " + ", ".join(f"CASE WHEN n._id IS NULL THEN o.{f} ELSE n.{f} END AS {f}" for f in FIELDS)
    + ", CASE WHEN n._id IS NULL THEN 'kept' WHEN o._id IS NULL THEN 'inserted' WHEN "
    + " AND ".join(f"o.{f} IS NOT DISTINCT FROM n.{f}" for f in FIELDS)
    + " THEN 'unchanged' ELSE 'replaced' END AS action FROM snapshot o FULL JOIN %s n USING (_id)"
)
part("merged", MERGE % "incoming", "snapshot", "incoming")

part("metrics", f"""
SELECT source, {RUN_DATE} AS run_date, raw AS raw_input_rows, raw - valid AS invalid_rows_removed,
  valid AS valid_input_rows, output AS output_rows, greatest(0, valid - output) AS rows_consolidated_by_aggregation
FROM (
  SELECT 'noaa' AS source, (SELECT count(*) FROM long_marked) AS raw,
    (SELECT count(*) FROM long_marked WHERE reject_reason IS NULL) AS valid, (SELECT count(*) FROM long_daily) AS output
  UNION ALL
  SELECT 'nws', (SELECT count(*) FROM obs), (SELECT count(*) FROM obs WHERE reject_reason IS NULL),
    (SELECT count(*) FROM obs_days)
  UNION ALL
  SELECT 'meteostat', (SELECT count(*) FROM raw_wide), (SELECT count(*) FROM raw_wide WHERE reject_reason IS NULL),
    (SELECT count(*) FROM wide_daily)
)""", "long_marked", "long_daily", "obs", "obs_days", "raw_wide", "wide_daily")

SHIFTED = """make_date(year({d}) - 10, month({d}),
  least(day({d}), day(last_day(make_date(year({d}) - 10, month({d}), 1)))))"""

ORACLE: dict[str, str] = {
    "ghcn_value_normalize": sql("SELECT * FROM ghcn", "ghcn"),
    "ghcn_station_rows": sql(f"""
SELECT 'noaa' AS source, {RUN_DATE} AS run_date, 'GHCND' AS noaa_dataset_id, g.noaa_station_id, station_name, state,
  country, latitude, longitude, nws_station_id, day::varchar AS date, datatype, value, attributes,
  '1996-01-01' AS request_window_start, '2000-12-31' AS request_window_end
FROM ghcn g JOIN manifest m ON m.noaa_station_id = g.noaa_station_id
WHERE datatype IN ('TAVG', 'TMAX', 'TMIN', 'PRCP', 'AWND', 'SNOW', 'SNWD')
  AND day BETWEEN date '1996-01-01' AND date '2000-12-31'""", "ghcn", "manifest"),
    "result_page_rows": sql(f"""
SELECT 'noaa' AS source, {RUN_DATE} AS run_date, 'GHCND' AS noaa_dataset_id, noaa_station_id, station_name, state,
  country, latitude, longitude, nws_station_id, o_orderdate::date::varchar AS date, datatype,
  CASE datatype WHEN 'TMAX' THEN floor(o_totalprice) END AS value, ',,W,' || o_orderkey AS attributes,
  year(o_orderdate) || '-01-01' AS request_window_start,
  least(year(o_orderdate), 2000) || '-12-31' AS request_window_end
FROM orders JOIN manifest ON noaa_station_id = 'GHCND:U' || o_custkey, (VALUES ('TMAX'), ('TMIN')) t(datatype)
WHERE o_orderstatus = 'O'""", "manifest"),
    "long_rejects": sql("""
SELECT reject_reason, count(*) AS rows FROM long_marked WHERE reject_reason IS NOT NULL GROUP BY 1""", "long_marked"),
    "long_to_wide_daily": sql("SELECT * FROM long_daily", "long_daily"),
    "local_day": sql("""
SELECT user_id, ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::date AS day, count(*) AS rows
FROM events GROUP BY 1, 2"""),
    "obs_daily_summary": sql("SELECT * FROM obs_days", "obs_days"),
    "obs_daily_enriched": sql("SELECT * FROM obs_daily", "obs_daily"),
    "explode_features": sql("""
SELECT ts::date::varchar AS run_date, which || event_id AS feature_id, CASE WHEN which IS NOT NULL THEN 'K' || user_id END AS "stationId",
  CASE WHEN which = 'a' THEN value END AS temperature,
  CASE WHEN which IS NOT NULL AND k < 50 THEN (user_id % 90)::double END AS latitude,
  CASE WHEN which IS NOT NULL THEN (k - 100)::double END AS longitude
FROM feature""", "feature"),
    "path_lineage": sql("""
SELECT regexp_replace(path, '^.*/raw/(nws/run_date=)?([0-9-]+)/.*$', '\\2') AS run_date, count(DISTINCT event_id) AS files
FROM feature GROUP BY 1""", "feature"),
    "raw_observation_docs": sql("""
SELECT CASE WHEN k >= 10 THEN 'obs-' ELSE '' END || which || event_id AS _id, 'nws' AS source, 'raw' AS "dataLevel",
  ts::date::varchar AS "ingestRunDate", ts::varchar || '+00:00' AS timestamp, 'K' || user_id AS "stationId",
  'stations/K' || user_id AS station, 'Site ' || user_id AS "stationName", event_type AS "textDescription",
  CASE WHEN which = 'a' THEN value END AS temperature, (k - 100)::double AS longitude
FROM feature WHERE which IS NOT NULL""", "feature"),
    "observation_samples": sql("""
SELECT station_id AS "stationId", stamp AS timestamp,
  CASE WHEN temperature_c IS NULL THEN 'N/A' ELSE printf('%.1f°C', temperature_c) END AS temperature,
  CASE WHEN wind_mps IS NULL THEN 'N/A' WHEN k < 90 AND k % 2 = 0 THEN printf('%.2f m/s', wind_mps)
    ELSE printf('%.3f', wind_mps) END AS wind
FROM obs ORDER BY stamp, station_id LIMIT 10""", "obs"),
    "wide_daily": sql("SELECT * FROM wide_daily", "wide_daily"),
    "flexible_dates": sql("SELECT meteostat_station_id, observed_on, date_status FROM dated", "dated"),
    "measure_cleanup": sql("SELECT meteostat_station_id, temp, tmin, tmax, prcp, snwd, wspd FROM dated", "dated"),
    "catalog_names": sql("""
SELECT id, name, country, region, national, icao, daily_start, daily_end FROM catalog""", "catalog"),
    "station_all_or_nothing": sql("""
SELECT meteostat_station_id, observed_on, temp::bigint::varchar AS temp FROM dated d WHERE date_status = 'ok' AND NOT EXISTS (
  SELECT 1 FROM dated b WHERE b.meteostat_station_id = d.meteostat_station_id AND b.date_status = 'bad')""", "dated"),
    "station_year_rows": sql(f"""
SELECT 'meteostat' AS source, {RUN_DATE} AS run_date, 'meteostat_bulk' AS provider, noaa_station_id, nws_station_id,
  station_name, m.state, m.country, m.latitude, m.longitude, d.meteostat_station_id, c.name AS meteostat_station_name,
  c.latitude AS meteostat_station_latitude, c.longitude AS meteostat_station_longitude,
  c.elevation AS meteostat_station_elevation_m, distance_km AS meteostat_station_distance_km,
  match_type AS meteostat_match_type, observed_on::varchar AS date, temp, tmin, tmax, prcp, snwd, wspd,
  NULL::double AS wpgt
FROM dated d JOIN catalog c ON c.id = d.meteostat_station_id JOIN matched m ON m.position = c.position
WHERE observed_on BETWEEN date '1996-01-01' AND date '2000-12-31'""", "dated", "catalog", "matched"),
    "unified_daily": sql("SELECT * FROM unified", "unified"),
    "yearly_station": sql("SELECT * FROM yearly_station", "yearly_station"),
    "yearly_source": sql(f"""
SELECT source, year, count(*) AS stations_covered, {rounded("avg(annual_avg_temp_c)")} AS mean_station_temp_c,
  {rounded("avg(annual_precip_mm)")} AS mean_station_precip_mm,
  {rounded("avg(annual_avg_wind_mps)")} AS mean_station_wind_mps
FROM yearly_station GROUP BY source, year""", "yearly_station"),
    "counts_by_source": sql("SELECT source, count(*) AS count FROM unified GROUP BY source", "unified"),
    "stored_extent": sql("""
SELECT source, year, count(*) AS rows, count(avg_temp_c) AS with_mean, min(date) AS first_day, max(date) AS last_day
FROM unified GROUP BY source, year""", "unified"),
    "warmest_stations": sql(f"""
SELECT station_name, source, {rounded("avg(avg_temp_c)")} AS yearly_avg_temp_c, count(*) AS days_counted
FROM unified WHERE year = 1998 AND avg_temp_c IS NOT NULL GROUP BY station_name, source
ORDER BY yearly_avg_temp_c DESC, station_name, source LIMIT 10""", "unified"),
    "sample_rows": sql("""
SELECT source, date, station_name, avg_temp_c, precip_mm, avg_wind_mps FROM unified
WHERE source = 'noaa' AND date = date '2024-01-15'
ORDER BY station_name, avg_temp_c NULLS LAST, precip_mm NULLS LAST, avg_wind_mps NULLS LAST LIMIT 8""", "unified"),
    "ghcn_line_fields": """
WITH lines AS (
  SELECT string_split('U' || o_custkey || ',' || strftime(o_orderdate, '%Y%m%d') || ',TMAX,' || floor(o_totalprice)::bigint || ',,,W'
    || CASE o_orderstatus WHEN 'O' THEN ',2400' WHEN 'F' THEN ',,extra' ELSE '' END, ',') AS f
  FROM orders
)
SELECT f[1] AS station_id, f[2] AS raw_day, f[3] AS datatype, f[4] AS raw_value, f[5] AS mflag, f[6] AS qflag, f[7] AS sflag,
  f[8] AS obs_time
FROM lines WHERE len(f) >= 8""",
    "station_year_fields": """
SELECT 'M' || o_custkey AS meteostat_station_id,
  CASE WHEN k = 0 THEN d::varchar END AS date, CASE WHEN k = 1 THEN d || ' 00:00, noon' END AS time,
  CASE WHEN k = 2 THEN year(d)::varchar END AS year, CASE WHEN k = 2 THEN month(d)::varchar END AS month,
  CASE WHEN k = 2 THEN day(d)::varchar END AS day, CASE WHEN k = 0 THEN price END AS temp,
  CASE WHEN k = 1 THEN ' ' || price END AS tmin, CASE WHEN k = 2 THEN price END AS tmax,
  CASE WHEN k = 1 THEN price END AS prcp, NULL::varchar AS snwd, CASE WHEN k = 0 THEN '7' END AS wspd, NULL::varchar AS wpgt
FROM (SELECT *, o_custkey % 3 AS k, o_orderdate::date AS d, floor(o_totalprice)::bigint::varchar AS price FROM orders)""",
    "manifest_file": sql("""
SELECT noaa_station_id, station_name, nullif(state, '') AS state, nullif(country, '') AS country, nullif(ingest_enabled, '') AS ingest_enabled,
  priority_rank, latitude, longitude, nws_station_id, NULL::varchar AS source_api FROM manifest""", "manifest"),
    "landed_lines": sql("""
SELECT run_date, noaa_station_id, station_name, coalesce(day::varchar, 'bad-date') AS date, datatype, value, NULL::varchar AS malformed
FROM raw_long
UNION ALL SELECT '2024-02-01', NULL, NULL, NULL, NULL, NULL, '{"station_name": {"event_id": ' || event_id || ', "kind": "' || event_type || '"'
  || CASE event_type WHEN 'purchase' THEN ', "value": ' || floor(value)::bigint ELSE '' END || '}' FROM events WHERE event_id % 7 = 0""", "raw_long"),
    "guarded_daily": sql("SELECT * FROM long_daily", "long_daily"),
    "stated_fields": """
SELECT 'event_id' AS field FROM events WHERE event_id % 7 <> 0 GROUP BY 1
UNION ALL SELECT 'kind' FROM events WHERE event_id % 7 <> 0 GROUP BY 1
UNION ALL SELECT 'value' FROM events WHERE event_id % 7 <> 0 AND event_type = 'purchase' GROUP BY 1""",
    "trend_sorted_top": sql("""
SELECT * FROM yearly_station ORDER BY year DESC, source NULLS FIRST, noaa_station_id NULLS FIRST,
  station_name NULLS FIRST, state NULLS FIRST, country NULLS FIRST""", "yearly_station"),
    "run_metrics": sql("SELECT * FROM metrics", "metrics"),
    "metrics_summary": sql("""
SELECT sum(raw_input_rows)::bigint AS raw_input_rows, sum(invalid_rows_removed)::bigint AS invalid_rows_removed,
  sum(valid_input_rows)::bigint AS valid_input_rows, sum(output_rows)::bigint AS output_rows,
  sum(rows_consolidated_by_aggregation)::bigint AS rows_consolidated_by_aggregation, count(*) AS sources_with_metrics
FROM metrics""", "metrics"),
    "raw_counts": sql("""
SELECT 'noaa' AS dataset, count(*) AS records FROM events UNION ALL SELECT 'meteostat', count(*) FROM lineitem
UNION ALL SELECT 'nws', count(which) FROM feature UNION ALL SELECT 'climate_daily', count(*) FROM unified""",
                      "feature", "unified"),
    "retrieved_delta": sql("""
SELECT source, before, after, CASE source WHEN 'meteostat' THEN greatest(0, after - before) ELSE after END AS retrieved
FROM (SELECT source, count(*) FILTER (date < date '2024-01-16') AS before, count(*) AS after FROM unified GROUP BY source)""",
                           "unified"),
    "contract_checks": sql("""
SELECT source, count(*) AS rows, count(*) FILTER (source IS NULL) AS null_source,
  count(*) FILTER (date IS NULL) AS null_date, count(*) FILTER (source_station_id IS NULL) AS null_source_station_id
FROM unified GROUP BY source""", "unified"),
    "duplicate_keys": sql("""
SELECT source, source_station_id, date, count(*) AS rows FROM unified GROUP BY ALL HAVING count(*) > 1""", "unified"),
    "format_run_summary": sql("""
SELECT o_custkey, CASE o_orderstatus WHEN 'O' THEN 'NOAA' WHEN 'F' THEN 'NWS' WHEN 'P' THEN 'Meteostat' ELSE 'other' END
    AS source_name,
  format('{:,}', amount) AS amount_text,
  CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's'
    WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS duration,
  strftime(started, '%Y-%m-%d %H:%M:%S') AS started, CASE WHEN n > 1 THEN n::integer END AS repeats
FROM (
  SELECT *, round_even(amount / 16.0::double, 0)::bigint AS s FROM (
    SELECT o_custkey, o_orderstatus, count(*) AS n, sum(floor(o_totalprice)::bigint)::bigint AS amount,
      min(o_orderdate) AS started
    FROM orders GROUP BY o_custkey, o_orderstatus)
)"""),
    "source_list": sql("""
SELECT c_custkey,
  CASE c_mktsegment WHEN 'BUILDING' THEN CASE WHEN low THEN 'nws|noaa|sonde' ELSE 'nws|noaa' END
    WHEN 'MACHINERY' THEN CASE WHEN low THEN 'meteostat|noaa|sonde' ELSE 'meteostat|noaa|nws' END
    WHEN 'HOUSEHOLD' THEN CASE WHEN low THEN 'noaa|radar|sonde' ELSE 'noaa|radar|nws' END
    ELSE CASE WHEN low THEN 'sonde' ELSE 'nws' END END AS sources,
  concat_ws('|', CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'radar' END, CASE WHEN low THEN 'sonde' END) AS unsupported
FROM (SELECT *, c_acctbal < 0 AS low FROM customer)"""),
    "trailing_window": sql(f"""
SELECT o_orderkey, end_date, {SHIFTED.format(d="end_date")} + 1 AS start_date
FROM (SELECT o_orderkey, o_orderdate::date AS end_date FROM orders)"""),
    "year_windows": sql("""
SELECT o_orderkey, start_date, end_date, y::integer AS year, greatest(start_date, make_date(y, 1, 1)) AS window_start,
  least(end_date, make_date(y, 12, 31)) AS window_end
FROM (
  SELECT *, unnest(range(year(start_date), year(end_date) + 1)) AS y FROM (
    SELECT o_orderkey, o_orderdate::date AS start_date,
      o_orderdate::date + (floor(o_totalprice / 300)::integer - 100) AS end_date FROM orders)
  WHERE start_date <= end_date
)"""),
    "interval_predicates": sql("""
SELECT id, coalesce(daily_start <= f AND daily_end >= f, false) AS covers_start,
  coalesce(daily_start <= f AND daily_end >= l, false) AS covers_window,
  coalesce(daily_start <= l AND daily_end >= f, false) AS overlaps_window
FROM catalog, (SELECT date '2014-01-01' AS f, date '2024-06-30' AS l)""", "catalog"),
    "manifest_slice": sql("""
SELECT noaa_station_id, ingest_enabled, priority_rank, row_number() OVER (ORDER BY priority_rank) - 1 AS ordinal
FROM manifest WHERE ingest_enabled IN ('TRUE', ' yes ', '') ORDER BY priority_rank LIMIT 50 OFFSET 50""", "manifest"),
    "nearest_station": sql(f"""
SELECT qlat AS query_latitude, qlon AS query_longitude, country, state, position, {rounded_row("km")} AS km
FROM nearest""", "nearest"),
    "station_resolve": sql("""
SELECT noaa_station_id, match_type AS meteostat_match_type, distance_km AS meteostat_station_distance_km,
  c.id AS meteostat_station_id, c.name AS meteostat_station_name, c.latitude AS meteostat_station_latitude,
  c.longitude AS meteostat_station_longitude, c.elevation AS meteostat_station_elevation_m
FROM matched m JOIN catalog c ON c.position = m.position""", "matched", "catalog"),
    "resolve_rejects": sql(f"""
SELECT {RUN_DATE} AS run_date, 'meteostat' AS source, noaa_station_id, nws_station_id, station_name, state,
  '2014-01-01' AS start_date, '2023-12-31' AS end_date, 'ValueError' AS error_type,
  CASE WHEN qlat IS NULL OR qlon IS NULL THEN 'Station is missing identifiers and coordinates for Meteostat: ' || noaa_station_id
    WHEN km IS NULL THEN 'No Meteostat station with daily coverage found for ' || noaa_station_id
    ELSE 'Nearest Meteostat station for ' || noaa_station_id || ' is too far away (' || printf('%.1f', km) || ' km)'
  END AS error_message
FROM matched WHERE position IS NULL""", "matched"),
    "resume_anti": sql("""
SELECT noaa_station_id, station_name, priority_rank FROM manifest m
WHERE NOT EXISTS (SELECT 1 FROM raw_long r WHERE r.noaa_station_id = m.noaa_station_id)""", "manifest", "raw_long"),
    "resume_windows": """
WITH ranges AS (
  SELECT 'GHCND:U' || o_custkey AS noaa_station_id, min(o_orderdate)::date - 10 AS s, max(o_orderdate)::date + 20 AS e
  FROM orders GROUP BY o_custkey
), asked AS (
  SELECT noaa_station_id, greatest(s, make_date(y, 1, 1)) AS window_start, least(e, make_date(y, 12, 31)) AS window_end
  FROM (SELECT *, unnest(range(year(s), year(e) + 1)) AS y FROM ranges)
), landed AS (
  SELECT DISTINCT 'GHCND:U' || o_custkey AS noaa_station_id, o_orderdate::date + unnest(range(0, floor(o_totalprice / 20000)::integer + 1))::integer AS day
  FROM orders
), wanted AS (
  SELECT *, unnest(generate_series(window_start, window_end, interval 1 day))::date AS day FROM asked
), islands AS (
  SELECT *, day - (row_number() OVER (PARTITION BY noaa_station_id, window_start, window_end ORDER BY day))::integer AS island
  FROM wanted ANTI JOIN landed USING (noaa_station_id, day)
)
SELECT noaa_station_id, window_start, window_end, min(day) AS missing_start, max(day) AS missing_end
FROM islands GROUP BY noaa_station_id, window_start, window_end, island""",
    "inventory_overlaps": sql("""
SELECT c.region, id, o_custkey, greatest(daily_start, f) AS overlap_start, least(daily_end, l) AS overlap_end
FROM catalog c JOIN (
  SELECT n_name AS region, o_custkey, min(o_orderdate)::date AS f, max(o_orderdate)::date AS l
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, o_custkey
) r ON c.region = r.region AND daily_start <= l AND daily_end >= f AND daily_start <= daily_end""", "catalog"),
    "prune_partitions": sql("""
SELECT station_id AS station, 'feature-' || event_id AS feature_id, stamp AS timestamp FROM obs
WHERE station_id IN (SELECT nws_station_id FROM manifest WHERE nws_station_id IS NOT NULL)""", "obs", "manifest"),
    "prune_semi": sql("""
SELECT station_id AS station, 'feature-' || event_id AS feature_id, stamp AS timestamp FROM obs
WHERE station_id IN (SELECT nws_station_id FROM manifest WHERE nws_station_id IS NOT NULL)""", "obs", "manifest"),
    "publish_documents": sql("SELECT * FROM documents_all", "documents_all"),
    "latest_per_key": sql(LATEST % "SELECT * FROM documents_all", "documents_all"),
    "keyed_upsert": sql("SELECT * FROM merged", "merged"),
    "bucketed_upsert": sql("SELECT * FROM merged", "merged"),
    "cell_lookup": sql("SELECT * FROM unified WHERE source_station_id = 'M7' OR date = date '2024-01-15'", "unified"),
    "upsert_counts": sql("""
SELECT (SELECT count(_id) FROM handed_over) AS to_process, count(*) FILTER (action = 'inserted') AS upserted,
  count(*) FILTER (action = 'replaced') AS modified, count(*) FILTER (action IN ('replaced', 'unchanged')) AS matched
FROM merged""", "merged", "handed_over"),
    "yearly_view": sql(YEARLY % "merged", "merged"),
    "streaming_local_day": sql("""
SELECT * FROM obs_days""", "obs_days"),
    "streaming_upsert": sql(MERGE % "incoming_obs", "snapshot", "incoming_obs"),
    "streaming_closed_days": sql(
        OBS_DAYS.replace("SELECT station_id", "SELECT max(batch)::integer AS batch, station_id").replace("FROM obs", "FROM timed")
        % "AND NOT late AND day < (SELECT max(open_from) FROM marks)", "timed"),
    "streaming_late_rows": sql("""
SELECT feed::integer AS batch, station_id, day, count(*) AS rows, max(local_ts)::varchar AS newest FROM timed WHERE late
GROUP BY feed, station_id, day""", "timed"),
    "streaming_first_arrivals": sql("""
SELECT 'feature-' || event_id AS feature_id, CASE WHEN k >= 10 THEN 'obs-' || event_id ELSE '' END AS observation_id,
  station_id AS "stationId", stamp AS timestamp, temperature_c AS temperature FROM obs""", "obs"),
}
