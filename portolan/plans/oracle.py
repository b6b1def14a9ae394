"""DuckDB SQL for the correctness oracle.

The source views are written a second time, in DuckDB SQL, independently
of the Spark code in ``portolan.sources.testdata``; each registered query
is then stated in SQL over them. Unreferenced CTEs are never evaluated.
"""

from __future__ import annotations

_NOT_MISSING = "({c} IS NOT NULL AND NOT isnan({c}))"

VIEWS = {
    "arrivals_raw": """
SELECT
  CAST(o.o_orderkey * 10 + l.l_linenumber AS DOUBLE) AS cicid,
  CAST(year(o.o_orderdate) AS DOUBLE) AS i94yr,
  CAST(month(o.o_orderdate) AS DOUBLE) AS i94mon,
  CAST(c.c_nationkey AS DOUBLE) AS i94cit,
  CAST(c.c_nationkey AS DOUBLE) AS i94res,
  CAST(l.l_suppkey AS VARCHAR) AS i94port,
  CAST(date_diff('day', DATE '1960-01-01', CAST(o.o_orderdate AS DATE)) AS DOUBLE) AS arrdate,
  CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS i94mode,
  CAST(c.c_nationkey AS VARCHAR) AS i94addr,
  CAST(date_diff('day', DATE '1960-01-01', CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS depdate,
  l.l_quantity + l.l_discount * 5 AS i94bir,
  CAST(o.o_custkey % 3 + 1 AS DOUBLE) AS i94visa,
  CAST(1.0 AS DOUBLE) AS "count",
  CAST(NULL AS VARCHAR) AS dtadfile,
  CAST(NULL AS VARCHAR) AS visapost,
  CAST(NULL AS VARCHAR) AS occup,
  l.l_linestatus AS entdepa,
  CAST(NULL AS VARCHAR) AS entdepd,
  CAST(NULL AS VARCHAR) AS entdepu,
  l.l_linestatus AS matflag,
  CAST(year(o.o_orderdate) AS DOUBLE) - l.l_quantity AS biryear,
  CAST(NULL AS VARCHAR) AS dtaddto,
  CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL
       WHEN l.l_linestatus = 'O' THEN 'F' ELSE 'M' END AS gender,
  CAST(NULL AS VARCHAR) AS insnum,
  c.c_mktsegment AS airline,
  CAST(l.l_partkey AS DOUBLE) AS admnum,
  CAST(l.l_partkey AS VARCHAR) AS fltno,
  l.l_returnflag AS visatype
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey""",
    "ports_raw": """
SELECT
  'P' || CAST(s.s_suppkey AS VARCHAR) AS ident,
  CASE WHEN s.s_acctbal < 0 THEN 'closed' WHEN s.s_acctbal < 3000 THEN 'small_airport'
       WHEN s.s_acctbal < 6000 THEN 'medium_airport' WHEN s.s_acctbal < 9000 THEN 'large_airport'
  END AS type,
  s.s_name AS name,
  CAST(s.s_nationkey * 100 AS INTEGER) AS elevation_ft,
  'NA' AS continent,
  CASE WHEN s.s_nationkey = 24 THEN 'CA' ELSE 'US' END AS iso_country,
  'US-' || CAST(s.s_nationkey AS VARCHAR) AS iso_region,
  n.n_name AS municipality,
  CAST(NULL AS VARCHAR) AS gps_code,
  CAST(s.s_suppkey AS VARCHAR) AS iata_code,
  CAST(NULL AS VARCHAR) AS local_code,
  CAST(NULL AS VARCHAR) AS coordinates
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "cust_seg": """
SELECT c_nationkey, c_mktsegment, count(*) AS n,
       count(*) FILTER (WHERE c_custkey % 2 = 0) AS n_even,
       count(*) FILTER (WHERE c_acctbal < 0) AS n_neg
FROM customer GROUP BY c_nationkey, c_mktsegment""",
    "cities_raw": """
SELECT
  n.n_name AS "City",
  r.r_name AS "State",
  CAST(n.n_nationkey AS DOUBLE) + 30.5 AS "Median Age",
  CAST(sum(s.n_even) OVER w AS INTEGER) AS "Male Population",
  CAST(sum(s.n) OVER w - sum(s.n_even) OVER w AS INTEGER) AS "Female Population",
  CAST(sum(s.n) OVER w AS INTEGER) AS "Total Population",
  CAST(sum(CASE WHEN s.c_mktsegment = 'BUILDING' THEN s.n ELSE 0 END) OVER w AS INTEGER)
    AS "Number of Veterans",
  CAST(sum(s.n_neg) OVER w AS INTEGER) AS "Foreign-born",
  CAST(n.n_regionkey AS DOUBLE) + 1.5 AS "Average Household Size",
  'S' || CAST(n.n_regionkey AS VARCHAR) AS "State Code",
  s.c_mktsegment AS "Race",
  CAST(s.n AS INTEGER) AS "Count"
FROM cust_seg s
JOIN nation n ON s.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WINDOW w AS (PARTITION BY s.c_nationkey)""",
    "temperatures_raw": """
SELECT
  CAST(ts AS DATE) AS dt,
  value AS "AverageTemperature",
  TRY_CAST(nullif(regexp_extract(props, '"k": (\\d+)', 1), '0') AS DOUBLE) / 10.0
    AS "AverageTemperatureUncertainty",
  'CITY_' || CAST(user_id AS VARCHAR) AS "City",
  CASE WHEN event_type = 'error' THEN 'Canada' ELSE 'United States' END AS "Country",
  CAST(NULL AS VARCHAR) AS "Latitude",
  CAST(NULL AS VARCHAR) AS "Longitude"
FROM events""",
    "arrivals_kept": """
SELECT cicid, i94cit, i94port, arrdate, i94mode, i94addr, depdate, i94bir, i94visa, visatype, gender
FROM (SELECT DISTINCT * FROM arrivals_raw) d""",
    "arrivals_clean": """
SELECT
  TRY_CAST(trunc(cicid) AS INTEGER) AS immigration_id,
  TRY_CAST(trunc(i94cit) AS INTEGER) AS origin,
  i94port AS landing_port,
  arrdate AS arrival_date,
  TRY_CAST(trunc(i94mode) AS INTEGER) AS arrival_mode,
  i94addr AS state,
  depdate AS departure_date,
  TRY_CAST(trunc(i94bir) AS INTEGER) AS age,
  TRY_CAST(trunc(i94visa) AS INTEGER) AS visa,
  visatype,
  gender
FROM arrivals_kept
WHERE """ + " AND ".join(
        [_NOT_MISSING.format(c=c) for c in ("cicid", "i94cit", "arrdate", "i94mode", "depdate",
                                           "i94bir", "i94visa")]
        + [f"{c} IS NOT NULL" for c in ("i94port", "i94addr", "visatype", "gender")]
        + [f"{c} > -2147483649 AND {c} < 2147483648" for c in ("cicid", "i94cit", "i94mode", "i94bir", "i94visa")]),
    "cities_clean": """
SELECT "City", "State", "Median Age", "Male Population", "Female Population",
       "Total Population", "Number of Veterans", "Foreign-born", "Average Household Size",
       "State Code"
FROM cities_raw WHERE "State Code" IS NOT NULL AND "City" IS NOT NULL""",
    "ports_clean": """
SELECT ident, type, name, continent, iso_region, municipality, iata_code
FROM ports_raw WHERE iata_code IS NOT NULL AND iso_country = 'US' AND type <> 'closed'""",
    "temps_clean": """
SELECT "City" AS city, "AverageTemperature" AS avg_temp,
       "AverageTemperatureUncertainty" AS avg_temp_uncertainty
FROM temperatures_raw
WHERE "Country" = 'United States' AND "City" IS NOT NULL
  AND "AverageTemperature" IS NOT NULL AND NOT isnan("AverageTemperature")
  AND "AverageTemperatureUncertainty" IS NOT NULL AND NOT isnan("AverageTemperatureUncertainty")""",
    "dim_ports": """
SELECT DISTINCT ident AS port_id, name, municipality AS city, type, iata_code,
  CASE WHEN len(string_split(iso_region, '-')) >= 2 THEN string_split(iso_region, '-')[2] END
    AS iso_region
FROM ports_clean p WHERE EXISTS (SELECT 1 FROM cities_clean c WHERE c."City" = p.municipality)""",
    "dim_cities": """
SELECT DISTINCT "City" AS city, "State" AS state, "Median Age" AS median_age,
  "Male Population" AS male_pop, "Female Population" AS female_pop,
  "Total Population" AS total_pop, "Number of Veterans" AS veterans,
  "Foreign-born" AS foreign_born, "Average Household Size" AS avg_household_size
FROM cities_clean c WHERE EXISTS (SELECT 1 FROM ports_clean p WHERE p.municipality = c."City")""",
    "fact": """
SELECT a.immigration_id, a.origin, a.landing_port, a.arrival_date, a.departure_date,
       a.arrival_mode, p.city, a.age, a.visa, a.visatype, a.gender
FROM arrivals_clean a JOIN dim_ports p ON a.state = p.iso_region AND a.landing_port = p.iata_code""",
    "dim_time": """
SELECT sas_timestamp,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(weekofyear(d) AS INTEGER) AS week,
  CAST(dayofweek(d) + 1 AS INTEGER) AS weekday
FROM (SELECT sas_timestamp, DATE '1960-01-01' + CAST(floor(sas_timestamp) AS INTEGER) AS d
      FROM (SELECT arrival_date AS sas_timestamp FROM fact
            UNION SELECT departure_date FROM fact) u
      WHERE sas_timestamp IS NOT NULL AND NOT isnan(sas_timestamp)) t""",
    "all_days": """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
FROM (SELECT DATE '1960-01-01' + CAST(floor(s) AS INTEGER) AS d
      FROM (SELECT arrival_date AS s FROM arrivals_clean UNION SELECT departure_date FROM arrivals_clean) u) t""",
    "dim_temperatures": """
SELECT city, avg(avg_temp) AS avg_temp, avg(avg_temp_uncertainty) AS avg_temp_uncertainty
FROM temps_clean GROUP BY city""",
}

WITH_ALL = "WITH " + ",\n".join(f"{name} AS ({body}\n)" for name, body in VIEWS.items()) + "\n"


def q(body: str) -> str:
    """A query over the source views."""
    return WITH_ALL + body.strip()


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def _counts(view: str, col: str) -> str:
    return q(f"SELECT {col}, count(*) AS count FROM {view} GROUP BY {col}")


_DQ_TABLES = [("fact_immigrations", "fact", "immigration_id"),
              ("dim_temperatures", "dim_temperatures", "city"),
              ("dim_ports", "dim_ports", "port_id"),
              ("dim_cities", "dim_cities", "city"),
              ("dim_time", "dim_time", "sas_timestamp")]


def _dq_body(check: str, observed: str, passed: str) -> str:
    parts = [f"SELECT '{name}' AS table_name, '{check}' AS check_name, "
             + ("CAST(NULL AS VARCHAR)" if check == "row_count" else f"'{key}'")
             + f" AS key_column, CAST({observed.format(k=key)} AS BIGINT) AS observed, "
             f"{observed.format(k=key)} {passed} AS passed FROM {view}"
             for name, view, key in _DQ_TABLES]
    return "\nUNION ALL\n".join(parts)


def _dq(check: str, observed: str, passed: str) -> str:
    return q(_dq_body(check, observed, passed))


_ROW_COUNT = ("row_count", "count(*)", "> 0")
_NULL_KEY = ("null_key", "count(*) FILTER (WHERE {k} IS NULL)", "= 0")


_MONTH = "strftime(DATE '1960-01-01' + CAST(floor({c}) AS INTEGER), '%Y-%m')"

# key -> SQL. Keys match ``portolan.plans.registry.QUERIES``.
ORACLE: dict[str, str] = {
    "sas_date": q("""
SELECT sas_value,
  strftime(DATE '1960-01-01' + CAST(floor(sas_value) AS INTEGER), '%Y-%m-%d') AS sas_date
FROM (SELECT DISTINCT arrdate + i94bir / 100 - 0.25 AS sas_value FROM arrivals_raw) v"""),
    "region_suffix": q("""
SELECT ident, iso_region,
  CASE WHEN len(string_split(iso_region, '-')) >= 2 THEN string_split(iso_region, '-')[2] END
    AS region
FROM ports_raw"""),
    "arrivals_typed": q("SELECT * FROM arrivals_clean"),
    "cities_clean": q("SELECT * FROM cities_clean"),
    "ports_clean": q("SELECT * FROM ports_clean"),
    "temps_clean": q("SELECT * FROM temps_clean"),
    "drop_any_null": q("SELECT * FROM arrivals_kept WHERE " + " AND ".join(
        [_NOT_MISSING.format(c=c) for c in ("cicid", "i94cit", "arrdate", "i94mode", "depdate",
                                           "i94bir", "i94visa")]
        + [f"{c} IS NOT NULL" for c in ("i94port", "i94addr", "visatype", "gender")])),
    "null_profile": q("SELECT " + ", ".join(
        [f"count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS {c}"
         for c in ("cicid", "i94cit", "arrdate", "i94mode", "depdate", "i94bir", "i94visa")]
        + [f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
           for c in ("i94port", "i94addr", "visatype", "gender")]) + " FROM arrivals_kept"),
    "dedup_full_row": q("""
SELECT DISTINCT * FROM (SELECT * FROM arrivals_raw UNION ALL SELECT * FROM arrivals_raw) u"""),
    "cities_ports_combined": q("""
SELECT DISTINCT * FROM cities_clean c JOIN ports_clean p ON c."City" = p.municipality"""),
    "dim_ports": q("SELECT * FROM dim_ports"),
    "dim_cities": q("SELECT * FROM dim_cities"),
    "dim_time": q("SELECT * FROM dim_time"),
    "union_distinct_dates": q("""
SELECT sas_timestamp FROM (
  SELECT arrival_date AS sas_timestamp FROM arrivals_clean
  UNION SELECT departure_date FROM arrivals_clean) u
WHERE sas_timestamp IS NOT NULL AND NOT isnan(sas_timestamp)"""),
    "dim_temperatures": q("""
SELECT city, """ + r6("avg_temp", "avg_temp") + ", " + r6("avg_temp_uncertainty", "avg_temp_uncertainty")
        + " FROM dim_temperatures"),
    "using_join_aggregates": q("""
SELECT a.city, round(a.t, 6) AS avg_temp, round(u.u, 6) AS avg_temp_uncertainty
FROM (SELECT city, avg(avg_temp) AS t FROM temps_clean GROUP BY city) a
JOIN (SELECT city, avg(avg_temp_uncertainty) AS u FROM temps_clean GROUP BY city) u
  USING (city)"""),
    "fact_arrivals": q("SELECT * FROM fact"),
    "decode_labels": q("""
SELECT a.immigration_id, a.arrival_mode,
  CASE a.arrival_mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land'
       WHEN 9 THEN 'Not reported' ELSE 'Other' END AS mode_label,
  a.visa,
  CASE a.visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student'
       ELSE 'Other' END AS visa_label,
  a.state, coalesce(n.n_name, 'Other') AS state_label
FROM arrivals_clean a LEFT JOIN nation n ON a.state = CAST(n.n_nationkey AS VARCHAR)"""),
    "young_arrivals": q("""
SELECT f.immigration_id, f.age, t.day
FROM fact f JOIN dim_time t ON f.arrival_date = t.sas_timestamp
WHERE f.age < 5 AND f.landing_port = '6'"""),
    "oldest": q("SELECT age FROM fact ORDER BY age DESC NULLS LAST LIMIT 1"),
    "port_types": q("""
SELECT p.type AS port_type, count(*) AS total
FROM fact f JOIN dim_ports p ON f.city = p.city AND f.landing_port = p.iata_code
GROUP BY p.type"""),
    "top_cities": q("""
SELECT city, count(*) AS count FROM fact GROUP BY city ORDER BY count DESC, city LIMIT 5"""),
    "weekday_counts": q("""
SELECT t.weekday AS arrival_day, count(*) AS count
FROM fact f JOIN dim_time t ON f.arrival_date = t.sas_timestamp
GROUP BY t.weekday"""),
    **{f"profile_counts_{c}": _counts("arrivals_clean", c)
       for c in ("visa", "visatype", "arrival_mode", "state", "age", "origin")},
    **{f"profile_counts_{c}": _counts("all_days", c) for c in ("year", "month", "day")},
    "profile_counts_city": _counts("fact", "city"),
    "profile_long": q("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS count "
        f"FROM fact GROUP BY {c}" for c in ("visa", "visatype", "arrival_mode", "age"))),
    "dq_row_counts": _dq(*_ROW_COUNT),
    "dq_null_keys": _dq(*_NULL_KEY),
    "dq_unique_keys": _dq("unique_key", "(count(*) - count(DISTINCT {k}))", "= 0"),
    "dq_report": q("\nUNION ALL\n".join([_dq_body(*_ROW_COUNT), _dq_body(*_NULL_KEY),
                                          _dq_body("unique_key", "(count(*) - count(DISTINCT {k}))", "= 0")])),
    "match_rate_by_month": q(f"""
SELECT i.month, i.rows_in, coalesce(m.rows_matched, 0) AS rows_matched
FROM (SELECT {_MONTH.format(c='arrival_date')} AS month, count(*) AS rows_in
      FROM arrivals_clean GROUP BY 1) i
LEFT JOIN (SELECT {_MONTH.format(c='arrival_date')} AS month, count(*) AS rows_matched
           FROM fact GROUP BY 1) m ON i.month = m.month"""),
    "match_loss_after_load": q(f"""
SELECT month, CAST(sum(matched) AS BIGINT) AS rows_matched, CAST(sum(lost) AS BIGINT) AS rows_lost
FROM (SELECT {_MONTH.format(c='arrival_date')} AS month, 1 AS matched, 0 AS lost FROM fact
      UNION ALL
      SELECT {_MONTH.format(c='arrival_date')}, 0, 1 FROM arrivals_clean a
      WHERE NOT EXISTS (SELECT 1 FROM dim_ports p WHERE a.state = p.iso_region AND a.landing_port = p.iata_code)) x
GROUP BY month"""),
    "city_population_counts": q("""
SELECT c.city, c.state, c.total_pop, f.arrivals
FROM dim_cities c JOIN (SELECT city, count(*) AS arrivals FROM fact GROUP BY city) f ON c.city = f.city"""),
    "monthly_counts": q(f"""
SELECT 'weekday' AS question, CAST(t.weekday AS VARCHAR) AS value, count(*) AS n
FROM fact f JOIN dim_time t ON f.arrival_date = t.sas_timestamp GROUP BY t.weekday
UNION ALL SELECT 'port_type', p.type, count(*)
FROM fact f JOIN dim_ports p ON f.city = p.city AND f.landing_port = p.iata_code GROUP BY p.type
UNION ALL SELECT 'top_city', city, n FROM
  (SELECT city, count(*) AS n FROM fact GROUP BY city ORDER BY n DESC, city LIMIT 5)
UNION ALL SELECT 'month', {_MONTH.format(c='arrival_date')}, count(*) FROM fact GROUP BY 2
UNION ALL SELECT 'oldest', 'age', CAST(max(age) AS BIGINT) FROM fact HAVING count(*) > 0
""" + "\n".join(f"UNION ALL SELECT '{c}', CAST({c} AS VARCHAR), count(*) FROM fact GROUP BY {c}"
                for c in ("visa", "visatype", "arrival_mode", "gender"))),
    "heavy_hitters": q("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS count, "
        f"(SELECT count(*) FROM arrivals_raw) AS n_rows FROM arrivals_raw GROUP BY {c} "
        "HAVING count(*) >= (SELECT count(*) FROM arrivals_raw) * 0.02"
        for c in ("i94port", "i94addr", "i94cit", "arrdate", "visatype", "gender"))),
    "union_months_distinct": q("""
SELECT count(*) AS n_rows FROM (SELECT DISTINCT * FROM fact) d
WHERE immigration_id IS NOT NULL AND origin IS NOT NULL AND landing_port IS NOT NULL
  AND arrival_date IS NOT NULL AND NOT isnan(arrival_date)
  AND departure_date IS NOT NULL AND NOT isnan(departure_date)
  AND arrival_mode IS NOT NULL AND city IS NOT NULL AND age IS NOT NULL
  AND visa IS NOT NULL AND visatype IS NOT NULL AND gender IS NOT NULL"""),
    "ports_csv": q("SELECT * FROM ports_clean"),
    "cities_csv": q("SELECT * FROM cities_clean"),
    "csv_null_semantics": """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS token_text,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS blank_text,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS quoted_text
FROM orders""",
    "code_lists": q("""
SELECT 'i94cntyl' AS list_name, CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation
UNION ALL
SELECT 'i94prtl', 'S' || CAST(s_suppkey AS VARCHAR), s_name || ', ' || CAST(s_nationkey AS VARCHAR)
FROM supplier
UNION ALL
SELECT 'i94addrl', 'S' || CAST(r_regionkey AS VARCHAR), r_name FROM region"""),
    "port_places": q("""
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code,
       s_name || ', ' || CAST(s_nationkey AS VARCHAR) AS label,
       s_name AS place, CAST(s_nationkey AS VARCHAR) AS state, 'valid' AS status
FROM supplier"""),
    "decode_catalog": q("""
SELECT a.immigration_id, a.origin, coalesce(n.n_name, 'Other') AS origin_label
FROM arrivals_clean a LEFT JOIN nation n ON CAST(a.origin AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)"""),
    "star_load": _dq("row_count", "count(*)", "> 0"),
    "stream_fact_load": q("SELECT * FROM fact"),
    "etl_from_files": q("SELECT * FROM fact"),
    "month_files": q(f"""
SELECT {_MONTH.format(c='arrdate')} AS month, count(*) AS rows, sum(arrdate) AS days FROM arrivals_raw GROUP BY 1"""),
    "csv_header_names": q("SELECT * FROM ports_clean"),
    "arrivals_rejected": q("""
SELECT cause, count(*) AS rows FROM (
  SELECT CASE WHEN NOT (""" + " AND ".join(
        [_NOT_MISSING.format(c=c) for c in ("cicid", "i94cit", "arrdate", "i94mode", "depdate", "i94bir", "i94visa")]
        + [f"{c} IS NOT NULL" for c in ("i94port", "i94addr", "visatype", "gender")]) + """) THEN 'incomplete'
""" + "\n".join(f"    WHEN NOT ({c} > -2147483649 AND {c} < 2147483648) THEN '{c} out of range'"
               for c in ("cicid", "i94cit", "i94mode", "i94bir", "i94visa")) + """
  END AS cause FROM arrivals_kept) x WHERE cause IS NOT NULL GROUP BY cause"""),
    "parquet_write_modes": "SELECT o_orderkey, o_orderstatus, TRUE AS refused FROM orders",
    "preview_ports": q("SELECT ident, name, iso_region, municipality FROM ports_raw ORDER BY ident LIMIT 10"),
    "country_status": q("""
SELECT immigration_id, origin, origin_label,
  CASE WHEN starts_with(origin_label, 'INVALID:') THEN 'invalid' WHEN contains(origin_label, 'Collapsed') THEN 'collapsed'
       WHEN starts_with(origin_label, 'No Country Code') THEN 'no_code' ELSE 'valid' END AS status
FROM (SELECT a.immigration_id, CAST(a.origin AS VARCHAR) AS origin, coalesce(CASE n.n_nationkey % 5
               WHEN 1 THEN 'INVALID: ' || n.n_name WHEN 2 THEN 'Collapsed ' || n.n_name
               WHEN 3 THEN 'No Country Code (' || CAST(n.n_nationkey AS VARCHAR) || ')' ELSE n.n_name END, 'Other') AS origin_label
      FROM arrivals_clean a LEFT JOIN nation n ON a.origin = n.n_nationkey) x"""),
    "warehouse_checks": q(_dq_body(*_ROW_COUNT) + "\nUNION ALL\n" + _dq_body(*_NULL_KEY)),
    "star_load_metrics": q(_dq_body(*_ROW_COUNT) + "\nUNION ALL\n" + _dq_body(*_NULL_KEY)),
}

# The SQL-text forms of the example queries give the same rows as their
# DataFrame forms.
ORACLE.update({f"sql_{k}": ORACLE[k]
               for k in ("young_arrivals", "oldest", "port_types", "top_cities", "weekday_counts")})
