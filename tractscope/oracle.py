"""The same results in SQL for DuckDB, on the same test tables."""

from tractscope.registry import PERIOD, TOP_K

YEAR, MONTH = PERIOD

# --- source tables --------------------------------------------------------------

LOANS = """
loans_raw AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS activity_year,
         CASE WHEN year(o_orderdate) <= 1997 THEN 'v1' ELSE 'v2' END AS layout,
         CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END AS action_taken,
         CAST(o_custkey % 2 + 1 AS VARCHAR) AS loan_purpose,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN '1' ELSE '2' END
           AS property_type,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
              THEN 'Single Family (1-4 Units):Site-Built'
              ELSE 'Multifamily:Site-Built' END AS derived_dwelling_category,
         CASE c_nationkey % 3 WHEN 0 THEN 'San Francisco county'
              WHEN 1 THEN 'Los Angeles county' ELSE 'Other county' END AS county_name,
         CASE c_nationkey % 3 WHEN 0 THEN '06075' WHEN 1 THEN '06037' ELSE '06001' END
           AS county_code,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderkey % 89 = 0 THEN 'NA'
              WHEN year(o_orderdate) <= 1997
              THEN lpad(CAST(100 + c_nationkey AS VARCHAR), 4, '0') || '.'
                   || lpad(CAST(o_custkey % 3 AS VARCHAR), 2, '0')
              ELSE county_code || lpad(CAST(100 + c_nationkey AS VARCHAR), 4, '0')
                   || lpad(CAST(o_custkey % 3 AS VARCHAR), 2, '0') END AS census_tract,
         CASE WHEN o_orderkey % 50 = 0 THEN 'NA'
              WHEN o_orderkey % 53 = 0 THEN NULL
              WHEN o_orderkey % 59 = 0 THEN '0'
              WHEN o_orderkey % 7 = 0
              THEN CAST(CAST(floor(c_acctbal / 15) AS BIGINT) AS VARCHAR) || '.5'
              ELSE CAST(CAST(floor(c_acctbal / 15) AS BIGINT) AS VARCHAR) END AS income,
         o_totalprice AS loan_amount,
         1000 + 100 * c_nationkey + o_orderkey % 2 AS tract_population,
         300 + 10 * c_nationkey AS tract_owner_occupied_units,
         400 + 10 * c_nationkey AS tract_one_to_four_family_homes
  FROM orders JOIN customer ON o_custkey = c_custkey
),
loans_parsed AS (
  SELECT *, CASE WHEN regexp_matches(income, '^[+-]?[0-9]+([.][0-9]*)?$')
                 THEN CAST(trunc(CAST(income AS DECIMAL(18, 2))) AS INTEGER) END AS income_int,
         CASE WHEN census_tract IS NULL OR length(census_tract) = 11 THEN census_tract
              ELSE county_code || replace(census_tract, '.', '') END AS full_tract
  FROM loans_raw
),
loans_eligible AS (
  SELECT CASE county_code WHEN '06075' THEN 'SF' ELSE 'LA' END AS city,
         CAST(activity_year AS INTEGER) AS activity_year, loan_amount,
         full_tract AS census_tract, income, income_int,
         CAST(tract_population AS INTEGER) AS tract_population,
         CAST(tract_owner_occupied_units AS INTEGER) AS tract_owner_occupied_units,
         CAST(tract_one_to_four_family_homes AS INTEGER) AS tract_one_to_four_family_homes,
         layout
  FROM loans_parsed
  WHERE action_taken = '1' AND loan_purpose = '1' AND county_code IN ('06075', '06037')
    AND CASE layout WHEN 'v1' THEN property_type = '1'
             ELSE starts_with(derived_dwelling_category, 'Single Family') END
),
loan_details AS (
  SELECT city, activity_year, loan_amount, census_tract, income, income_int,
         CAST(CASE WHEN income_int < 500 THEN floor(income_int / 20.0) + 1 ELSE 25 END
              AS INTEGER) AS level
  FROM loans_eligible WHERE income_int IS NOT NULL
),
loan_counts AS (
  SELECT city, activity_year, level, census_tract, count(*) AS "count"
  FROM loan_details GROUP BY ALL
),
loan_ranks AS (
  SELECT *, CAST(rank() OVER (PARTITION BY city, activity_year, level
                              ORDER BY "count" DESC) AS INTEGER) AS "rank"
  FROM loan_counts
),
tract_facts AS (
  SELECT DISTINCT activity_year, census_tract, tract_population,
         tract_owner_occupied_units, tract_one_to_four_family_homes
  FROM loans_eligible
),
populations AS (
  SELECT census_tract AS tract, activity_year AS year,
         max(tract_population) AS population,
         max(tract_owner_occupied_units) AS owner_occupied_units,
         max(tract_one_to_four_family_homes) AS one_to_four_family_homes
  FROM tract_facts WHERE census_tract IS NOT NULL GROUP BY ALL
)"""

INCIDENTS = """
incidents_all AS (
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'SF' ELSE 'LA' END AS city,
         CASE WHEN l_suppkey % 2 <> 0 OR year(l_shipdate) <= 1997 THEN 'v1' ELSE 'v2' END
           AS version,
         CASE WHEN l_suppkey % 2 <> 0 THEN strftime(l_shipdate, '%m/%d/%Y %H:%M:%S')
              WHEN year(l_shipdate) <= 1997 THEN strftime(l_shipdate, '%m/%d/%Y')
              ELSE strftime(l_shipdate, '%Y/%m/%d') END AS date,
         l_returnflag || l_linestatus AS category,
         CASE WHEN l_orderkey % 101 <> 0
              THEN CAST(CAST((l_partkey % 60 * 10000 + 5000 - 122500000) / 1000000.0
                             AS DECIMAL(9, 6)) AS VARCHAR) END AS longitude,
         CAST(CAST((l_partkey // 60 % 22 * 10000 + 5000 + 37700000) / 1000000.0
                   AS DECIMAL(9, 6)) AS VARCHAR) AS latitude,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS INTEGER) AS month
  FROM lineitem
),
incidents_clean AS (
  SELECT city, year, month, date, category, latitude, longitude
  FROM incidents_all WHERE longitude IS NOT NULL AND latitude IS NOT NULL
)"""

TRACTS = """
tracts AS (
  SELECT CASE n_nationkey % 3 WHEN 0 THEN '06075' WHEN 1 THEN '06037' ELSE '06001' END
         || lpad(CAST(100 + n_nationkey AS VARCHAR), 4, '0') || '00' AS tract,
         (n_nationkey % 5 * 100 - 122500) / 1000.0 AS west,
         (n_nationkey % 5 * 100 - 122400) / 1000.0 AS east,
         (n_nationkey // 5 * 40 + 37700) / 1000.0 AS south,
         (n_nationkey // 5 * 40 + 37740) / 1000.0 AS north
  FROM nation
)"""

INCIDENT_TRACTS = f"""{INCIDENTS}, {TRACTS},
incident_tracts AS (
  SELECT i.*, coalesce(t.tract, 'n/a') AS tract
  FROM incidents_clean i LEFT JOIN tracts t
    ON CAST(i.longitude AS DOUBLE) >= t.west AND CAST(i.longitude AS DOUBLE) < t.east
   AND CAST(i.latitude AS DOUBLE) >= t.south AND CAST(i.latitude AS DOUBLE) < t.north
),
tract_years AS (
  SELECT tract, city, year, count(*) AS total_count FROM incident_tracts GROUP BY ALL
)"""

SCHOOLS = """
schools_raw AS (
  SELECT s_name AS name,
         CASE WHEN s_suppkey % 17 <> 0 THEN s_suppkey * 13 % 900 END AS enrollment,
         CASE s_suppkey % 3 WHEN 0 THEN 'K-5' WHEN 1 THEN '6-8' ELSE '9-12' END AS "gradeRange",
         s_suppkey % 10 + 1 AS "gsRating",
         (s_suppkey * 37 // 60 % 22 * 10000 + 5000 + 37700000) / 1000000.0 AS lat,
         (s_suppkey * 37 % 60 * 10000 + 5000 - 122500000) / 1000000.0 AS lon
  FROM supplier
)"""

SCHOOL_TRACTS = """
school_tracts AS (
  SELECT s.*, coalesce(t.tract, 'n/a') AS tract
  FROM schools_raw s LEFT JOIN tracts t
    ON s.lon >= t.west AND s.lon < t.east AND s.lat >= t.south AND s.lat < t.north
),
tract_schools AS (
  SELECT tract, count(*) AS school_count, CAST(sum(enrollment) AS BIGINT) AS total_enrollment,
         avg("gsRating") AS average_rating
  FROM school_tracts GROUP BY tract
)"""

# Columns of the loan files, old name for new.
V1_COLUMNS = """activity_year AS as_of_year, loan_amount_text AS loan_amount_000s,
  census_tract AS census_tract_number, income AS applicant_income_000s,
  tract_population AS population,
  tract_owner_occupied_units AS number_of_owner_occupied_units,
  tract_one_to_four_family_homes AS number_of_1_to_4_family_units"""
V2_COLUMNS = """activity_year, loan_amount_text AS loan_amount, census_tract, income,
  tract_population, tract_owner_occupied_units, tract_one_to_four_family_homes"""

# The file tables hold every column as text.
LOAN_TEXTS = f"""{LOANS},
loan_texts AS (
  SELECT * REPLACE (CAST(tract_population AS VARCHAR) AS tract_population,
                    CAST(tract_owner_occupied_units AS VARCHAR) AS tract_owner_occupied_units,
                    CAST(tract_one_to_four_family_homes AS VARCHAR)
                      AS tract_one_to_four_family_homes),
         CAST(loan_amount AS VARCHAR) AS loan_amount_text
  FROM loans_raw
)"""

CITY_LOAN_COLUMNS = """city, activity_year, loan_amount, census_tract, income,
  tract_population, tract_owner_occupied_units, tract_one_to_four_family_homes"""


def _sql(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select.strip()}"


PROFILE = """, crime AS (
          SELECT tract, year, CAST(sum(total_count) AS BIGINT) AS incident_count
          FROM tract_years GROUP BY ALL
        ),
        popularity AS (
          SELECT census_tract AS tract, activity_year AS year,
                 CAST(sum("count") AS BIGINT) AS loan_count, min("rank") AS best_rank
          FROM loan_ranks GROUP BY ALL
        ),
        areas AS (
          SELECT tract, year FROM populations
          UNION SELECT tract, year FROM crime
          UNION SELECT tract, year FROM popularity
        )
        SELECT a.tract, a.year, population, owner_occupied_units, one_to_four_family_homes,
               incident_count, CAST(incident_count AS DOUBLE) / population AS crime_rate,
               loan_count, best_rank, school_count, average_rating
        FROM areas a
        LEFT JOIN populations p ON a.tract = p.tract AND a.year = p.year
        LEFT JOIN crime c ON a.tract = c.tract AND a.year = c.year
        LEFT JOIN popularity l ON a.tract = l.tract AND a.year = l.year
        LEFT JOIN tract_schools s ON a.tract = s.tract
        WHERE regexp_full_match(a.tract, '[0-9]{11}') AND a.year IS NOT NULL"""


def _of_periods(schools: str, months: str) -> str:
    """The profile of the year before, and of some months of the year."""
    seen = f""", months_seen AS (
          SELECT tract, city, year, count(*) AS total_count FROM incident_tracts
          WHERE year = {YEAR - 1} OR year = {YEAR} AND month IN {months}
          GROUP BY ALL
        ),
        crime AS"""
    profile = PROFILE.replace("FROM tract_years GROUP", "FROM months_seen GROUP")
    return _sql(
        f"{LOANS}, {INCIDENT_TRACTS}, {schools}, {SCHOOL_TRACTS}",
        profile.replace(", crime AS", seen, 1) + f" AND a.year IN ({YEAR - 1}, {YEAR})",
    ).replace("\n, months_seen", ", months_seen")


ORACLE = {
    "loan_tract_rank": _sql(LOANS, "SELECT * FROM loan_ranks"),
    "top_tracts_per_level": _sql(LOANS, f'SELECT * FROM loan_ranks WHERE "rank" <= {TOP_K}'),
    "loan_level_tract_count": _sql(LOANS, "SELECT * FROM loan_counts"),
    "loan_detail": _sql(LOANS, "SELECT * FROM loan_details"),
    "tract_info": _sql(LOANS, "SELECT * FROM tract_facts"),
    "loan_year": _sql(
        LOANS, f"SELECT {CITY_LOAN_COLUMNS} FROM loans_eligible WHERE activity_year = 1997"
    ),
    "loan_filter_v1": _sql(
        LOAN_TEXTS,
        f"""SELECT action_taken, loan_purpose, property_type, county_name, {V1_COLUMNS}
        FROM loan_texts
        WHERE layout = 'v1' AND action_taken = '1' AND loan_purpose = '1'
          AND property_type = '1'""",
    ),
    "loan_filter_v2": _sql(
        LOAN_TEXTS,
        f"""SELECT action_taken, loan_purpose, derived_dwelling_category, county_code,
               {V2_COLUMNS}
        FROM loan_texts
        WHERE layout = 'v2' AND action_taken = '1' AND loan_purpose = '1'
          AND derived_dwelling_category LIKE 'Single Family%'""",
    ),
    "map_columns_v1": _sql(
        LOAN_TEXTS,
        f"SELECT {V2_COLUMNS}, county_name FROM loan_texts WHERE layout = 'v1'",
    ),
    "map_columns_v2": _sql(
        LOAN_TEXTS,
        f"SELECT {V2_COLUMNS}, county_code FROM loan_texts WHERE layout = 'v2'",
    ),
    "loan_city_by_name": _sql(
        LOANS, f"SELECT {CITY_LOAN_COLUMNS} FROM loans_eligible WHERE layout = 'v1'"
    ),
    "loan_city_by_code": _sql(
        LOANS, f"SELECT {CITY_LOAN_COLUMNS} FROM loans_eligible WHERE layout = 'v2'"
    ),
    "income_parse": _sql(LOANS, "SELECT activity_year, income, income_int FROM loans_parsed"),
    "income_present": _sql(
        LOANS,
        "SELECT activity_year, income, income_int FROM loans_parsed WHERE income_int IS NOT NULL",
    ),
    "income_level": _sql(
        LOANS,
        """SELECT activity_year, income, income_int,
               CAST(CASE WHEN income_int < 500 THEN floor(income_int / 20.0) + 1 ELSE 25 END
                    AS INTEGER) AS level
        FROM loans_parsed""",
    ),
    "tract_normalize": _sql(
        LOANS, "SELECT census_tract, county_code, full_tract FROM loans_parsed"
    ),
    "incident_date_parts": _sql(INCIDENTS, "SELECT city, date, year, month FROM incidents_all"),
    "incident_located": _sql(
        INCIDENTS,
        """SELECT city, version, date, category, longitude, latitude
        FROM incidents_all WHERE longitude IS NOT NULL""",
    ),
    "incident_clean": _sql(INCIDENTS, "SELECT * FROM incidents_clean"),
    "incident_sorted": _sql(INCIDENTS, "SELECT * FROM incidents_clean"),
    "incident_period": _sql(
        INCIDENTS, f"SELECT * FROM incidents_clean WHERE year = {YEAR} AND month = {MONTH}"
    ),
    "incident_year_only": _sql(INCIDENTS, f"SELECT * FROM incidents_clean WHERE year = {YEAR}"),
    "incident_all_time": _sql(INCIDENTS, "SELECT * FROM incidents_clean"),
    "period_exists_semi": _sql(
        INCIDENTS,
        """SELECT DISTINCT r.city, r.year, r.month
        FROM (SELECT CASE o_custkey % 3 WHEN 0 THEN 'SF' WHEN 1 THEN 'LA' ELSE 'SD' END AS city,
                     CAST(year(o_orderdate) AS INTEGER) AS year,
                     CAST(month(o_orderdate) AS INTEGER) AS month FROM orders) r
        JOIN (SELECT DISTINCT city, year, month FROM incidents_clean) i
          ON r.city = i.city AND r.year = i.year AND r.month = i.month""",
    ),
    "distinct_coordinates": _sql(
        INCIDENTS, "SELECT DISTINCT longitude, latitude FROM incidents_clean"
    ),
    "coordinate_tract": _sql(
        INCIDENT_TRACTS, "SELECT DISTINCT longitude, latitude, tract FROM incident_tracts"
    ),
    "coordinate_tract_shuffled": _sql(
        INCIDENT_TRACTS, "SELECT DISTINCT longitude, latitude, tract FROM incident_tracts"
    ),
    "incident_tract_join": _sql(INCIDENT_TRACTS, "SELECT * FROM incident_tracts"),
    "incident_tract_join_shuffled": _sql(INCIDENT_TRACTS, "SELECT * FROM incident_tracts"),
    "incident_tract_year": _sql(INCIDENT_TRACTS, "SELECT * FROM tract_years"),
    "incident_tract_year_shuffled": _sql(INCIDENT_TRACTS, "SELECT * FROM tract_years"),
    "incident_tract_month": _sql(
        INCIDENT_TRACTS,
        """SELECT tract, city, year, month, count(*) AS total_count
        FROM incident_tracts GROUP BY ALL""",
    ),
    "incident_trend": _sql(
        INCIDENT_TRACTS,
        """SELECT t.*, p.total_count AS previous_count, t.total_count - p.total_count AS change,
               CASE sign(t.total_count - p.total_count)
                 WHEN 1 THEN 'up' WHEN -1 THEN 'down' WHEN 0 THEN 'same' END AS direction
        FROM tract_years t LEFT JOIN tract_years p
          ON t.tract = p.tract AND t.city = p.city AND p.year = t.year - 1""",
    ),
    "incident_rate": _sql(
        f"{LOANS}, {INCIDENT_TRACTS}",
        """SELECT t.*, p.population, CAST(t.total_count AS DOUBLE) / p.population AS crime_rate
        FROM tract_years t LEFT JOIN populations p ON t.tract = p.tract AND t.year = p.year""",
    ),
    "school_tract": _sql(
        f"{SCHOOLS}, {TRACTS}, {SCHOOL_TRACTS}", "SELECT * FROM school_tracts"
    ),
    "schools_by_tract": _sql(
        f"{SCHOOLS}, {TRACTS}, {SCHOOL_TRACTS}", "SELECT * FROM tract_schools"
    ),
    "city_county_lookup": """
        WITH places AS (
          SELECT 'City ' || (c_custkey % 1000) || ' district ' || c_custkey AS cityname,
                 CASE c_nationkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'NV' ELSE 'OR' END AS state,
                 'County ' || c_nationkey || ' ' || state AS countyname,
                 lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS countycode
          FROM customer
        ),
        requests AS (
          SELECT DISTINCT 'City ' || (s_suppkey * 7 % 1200) AS city,
                 CASE s_suppkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'NV' ELSE 'WA' END AS state
          FROM supplier
        ),
        matches AS (
          SELECT r.city, r.state, p.countyname, p.countycode,
                 row_number() OVER (PARTITION BY r.city, r.state
                                    ORDER BY p.cityname, p.countyname, p.countycode) AS n
          FROM requests r LEFT JOIN places p
            ON r.state = p.state AND starts_with(p.cityname, r.city)
        )
        SELECT city, state, coalesce(left(countyname, length(countyname) - 3), '') AS county_name,
               coalesce(countycode, '') AS county_code
        FROM matches WHERE n = 1""",
    "area_profile": _sql(
        f"{LOANS}, {INCIDENT_TRACTS}, {SCHOOLS}, {SCHOOL_TRACTS}", PROFILE
    ).replace("\n, crime", ", crime"),
    # The job has seen the year before, and two months of the year, with all its loans.
    "refresh_tables": _of_periods(SCHOOLS, f"({MONTH}, {MONTH + 1})"),
    # One month of the year; the schools without an enrollment have closed.
    "profile_by_changes": _of_periods(
        SCHOOLS.replace("FROM supplier", "FROM supplier WHERE s_suppkey % 17 <> 0"), f"({MONTH})"
    ),
    "src_csv_header": _sql(
        INCIDENTS,
        "SELECT city, version, date, category, longitude, latitude FROM incidents_all",
    ),
    "src_odd_headers": _sql(
        INCIDENTS,
        """SELECT city, version AS kind1, date, category AS "Kind3", longitude, latitude,
               CAST(NULL AS VARCHAR) AS _c6 FROM incidents_all""",
    ),
    "src_rejects": _sql(
        INCIDENTS,
        """SELECT CASE WHEN longitude IS NULL THEN city || ',' || date
               ELSE concat_ws(',', city, date, category, latitude, longitude, 'x') END AS line,
               CASE WHEN longitude IS NULL THEN 'short' ELSE 'long' END AS reason
        FROM incidents_all WHERE longitude IS NULL OR category = 'AF'""",
    ),
    "src_csv_schema": _sql(
        INCIDENTS,
        """SELECT city, category, date,
               CASE WHEN longitude IS NOT NULL THEN CAST(latitude AS DOUBLE) END AS latitude,
               CAST(longitude AS DOUBLE) AS longitude
        FROM incidents_all""",
    ),
    "src_xml_rows": _sql(SCHOOLS, "SELECT * FROM schools_raw"),
    "src_delimited_text": _sql(
        LOAN_TEXTS,
        f"""SELECT action_taken, loan_purpose, derived_dwelling_category, county_code,
               {V2_COLUMNS}
        FROM loan_texts WHERE layout = 'v2'""",
    ),
    "src_year_glob": _sql(
        LOAN_TEXTS,
        f"""SELECT action_taken, loan_purpose, property_type, county_name, {V1_COLUMNS}
        FROM loan_texts WHERE activity_year IN ('1995', '1996', '1997')""",
    ),
    "loan_files": _sql(
        LOANS,
        f"""SELECT {CITY_LOAN_COLUMNS} FROM loans_eligible
        WHERE activity_year IN (1996, 1997, 1998)""",
    ),
    "loan_files_every_year": _sql(LOANS, f"SELECT {CITY_LOAN_COLUMNS} FROM loans_eligible"),
    "src_versioned_union": _sql(INCIDENTS, "SELECT * FROM incidents_clean"),
    # Both files of SF have the reports of two years.
    "incident_ledger": _sql(
        INCIDENTS,
        """SELECT city, f.version, CASE category WHEN 'AF' THEN 2::BIGINT ELSE 1::BIGINT END AS landing,
               count(*) AS row_count, 0::BIGINT AS reject_count
        FROM incidents_all i JOIN (VALUES ('SF', 'v1'), ('SF', 'v2'), ('LA', 'v1')) f(c, version)
          ON i.city = c AND CASE WHEN c = 'LA' THEN true WHEN f.version = 'v1' THEN year <= 1998
                            ELSE year >= 1997 END
        GROUP BY ALL""",
    ),
    "incident_landed": _sql(INCIDENTS, "SELECT * FROM incidents_clean WHERE category <> 'AF'"),
    "src_catalog_dim": _sql(
        INCIDENTS,
        """, sources(city, version, date_format, date_column, category_column, longitude_column,
                     latitude_column, is_latest, city_name, state, county_name, county_code) AS (
          VALUES ('SF', 'v1', 'MM/dd/yyyy', 'Date', 'Category', 'X', 'Y', false,
                  'San Francisco', 'CA', 'San Francisco county', '06075'),
                 ('SF', 'v2', 'yyyy/MM/dd', 'Incident Date', 'Incident Category', 'Longitude',
                  'Latitude', true, 'San Francisco', 'CA', 'San Francisco county', '06075'),
                 ('LA', 'v1', 'MM/dd/yyyy HH:mm:ss', 'DATE OCC', 'Crm Cd Desc', 'LON', 'LAT',
                  true, 'Los Angeles', 'CA', 'Los Angeles county', '06037')
        ),
        found AS (
          SELECT city, version, count(*) AS report_count FROM incidents_all GROUP BY ALL
        )
        SELECT s.*, f.report_count
        FROM sources s LEFT JOIN found f ON s.city = f.city AND s.version = f.version""",
    ).replace("\n, sources", ", sources"),
    "sink_incident_partitions": _sql(INCIDENTS, "SELECT * FROM incidents_clean"),
    "sink_incident_correction": _sql(
        INCIDENTS,
        f"""SELECT * FROM incidents_clean
        WHERE year IS DISTINCT FROM {YEAR} OR month <> {MONTH}""",
    ),
    "sink_loan_partitions": _sql(LOANS, f"SELECT {CITY_LOAN_COLUMNS} FROM loans_eligible"),
}
