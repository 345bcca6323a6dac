"""Source tables of the product, derived from the given test tables.

Orders play loan applications, line items incident reports, nations tracts, suppliers
schools, customers places. All rules are whole-number arithmetic on keys, so the same
rows can be derived in SQL.
"""

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tractscope.catalog import Catalog, Versions, default_catalog

LAST_V1_YEAR = 1997


def fixture_catalog() -> Catalog:
    """The default catalog with file versions placed on the years of the test tables."""
    catalog = default_catalog()
    sf, la = catalog.cities["SF"], catalog.cities["LA"]
    return replace(
        catalog,
        loan_versions=Versions({"v1": (1992, LAST_V1_YEAR)}, "v2"),
        cities={
            "SF": replace(sf, incident_versions=Versions({"v1": (1992, LAST_V1_YEAR)}, "v2")),
            "LA": replace(la, incident_versions=Versions({}, "v1")),
        },
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_third(key: Column, values) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (key % 3 + 1).cast("int"))


def _text(value: Column) -> Column:
    return value.cast("string")


def _digits(value: Column, width: int) -> Column:
    return F.lpad(_text(value), width, "0")


def loans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan applications of both layouts in one table, names as in the later layout.

    Customers grow with the orders, and a file of few compressed bytes may hold very many of
    them: they are shuffled, and never sent through the driver.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    order, cust, nation = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    year = F.year("o_orderdate")
    is_v1 = year <= LAST_V1_YEAR
    home = F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")
    status = F.col("o_orderstatus")
    code = _by_third(nation, ["06075", "06037", "06001"])
    area, part = _digits(nation + 100, 4), _digits(cust % 3, 2)
    tract = F.when(is_v1, F.concat(area, F.lit("."), part)).otherwise(F.concat(code, area, part))
    money = _text(F.floor(F.col("c_acctbal") / 15).cast("bigint"))
    income = (
        F.when(order % 50 == 0, "NA")
        .when(order % 53 == 0, F.lit(None))
        .when(order % 59 == 0, "0")
        .when(order % 7 == 0, F.concat(money, F.lit(".5")))
        .otherwise(money)
    )
    return joined.select(
        _text(year).alias("activity_year"),
        F.when(is_v1, "v1").otherwise("v2").alias("layout"),
        F.when(status == "F", "1").when(status == "O", "2").otherwise("3").alias("action_taken"),
        _text(cust % 2 + 1).alias("loan_purpose"),
        F.when(home, "1").otherwise("2").alias("property_type"),
        F.when(home, "Single Family (1-4 Units):Site-Built")
        .otherwise("Multifamily:Site-Built")
        .alias("derived_dwelling_category"),
        _by_third(
            nation, ["San Francisco county", "Los Angeles county", "Other county"]
        ).alias("county_name"),
        code.alias("county_code"),
        F.when(order % 97 == 0, F.lit(None))
        .when(order % 89 == 0, "NA")
        .otherwise(tract)
        .alias("census_tract"),
        income.alias("income"),
        _text(F.col("o_totalprice")).alias("loan_amount"),
        _text(1000 + 100 * nation + order % 2).alias("tract_population"),
        _text(300 + 10 * nation).alias("tract_owner_occupied_units"),
        _text(400 + 10 * nation).alias("tract_one_to_four_family_homes"),
    )


def loans_in_layout(spark: SparkSession, sf_dir: str, version: str) -> DataFrame:
    """Loan applications of one layout, under the column names of its files."""
    rows = loans_raw(spark, sf_dir).where(F.col("layout") == version)
    names = fixture_catalog().loan_layouts[version].columns
    facts = [F.col(target).alias(source) for target, source in names.items()]
    codes = ["action_taken", "loan_purpose"]
    if version == "v1":
        return rows.select(*codes, "property_type", "county_name", *facts)
    return rows.select(*codes, "derived_dwelling_category", "county_code", *facts)


def _west_millionths(key: Column) -> Column:
    """Degrees west of Greenwich, in millionths."""
    return F.lit(122495000) - key % 60 * 10000


def _north_millionths(key: Column) -> Column:
    return F.floor(key / 60) % 22 * 10000 + 37705000


def _decimal_text(millionths: Column, whole_digits: int) -> Column:
    """``122495000`` as ``122.495000``."""
    digits = _text(millionths)
    return F.concat(
        digits.substr(1, whole_digits), F.lit("."), digits.substr(whole_digits + 1, 6)
    )


def _longitude(key: Column) -> Column:
    return F.concat(F.lit("-"), _decimal_text(_west_millionths(key), 3))


def _latitude(key: Column) -> Column:
    return _decimal_text(_north_millionths(key), 2)


def incidents_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of all cities under the common names, with the file version of each."""
    day = F.col("l_shipdate")
    is_sf = F.col("l_suppkey") % 2 == 0
    is_v1 = ~is_sf | (F.year(day) <= LAST_V1_YEAR)
    date = (
        F.when(~is_sf, F.date_format(day, "MM/dd/yyyy HH:mm:ss"))
        .when(is_v1, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "yyyy/MM/dd"))
    )
    part = F.col("l_partkey")
    located = F.col("l_orderkey") % 101 != 0
    return table(spark, sf_dir, "lineitem").select(
        F.when(is_sf, "SF").otherwise("LA").alias("city"),
        F.when(is_v1, "v1").otherwise("v2").alias("version"),
        date.alias("date"),
        F.concat("l_returnflag", "l_linestatus").alias("category"),
        F.when(located, _longitude(part)).alias("longitude"),
        _latitude(part).alias("latitude"),
    )


def tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries: a 5 x 5 field of rectangles, one per nation."""
    key = F.col("n_nationkey")
    code = _by_third(key, ["06075", "06037", "06001"])
    west = ((key % 5) * 100 - 122500) / 1000
    east = ((key % 5) * 100 - 122400) / 1000
    south = (F.floor(key / 5) * 40 + 37700) / 1000
    north = (F.floor(key / 5) * 40 + 37740) / 1000

    def corner(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(
        corner(west, south), corner(east, south), corner(east, north), corner(west, north)
    )
    return table(spark, sf_dir, "nation").select(
        F.concat(code, _digits(key + 100, 4), F.lit("00")).alias("tract"),
        F.array(ring).alias("rings"),
    )


def schools_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    place = key * 37
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.when(key % 17 != 0, key * 13 % 900).alias("enrollment"),
        _by_third(key, ["K-5", "6-8", "9-12"]).alias("gradeRange"),
        (key % 10 + 1).alias("gsRating"),
        (_north_millionths(place) / 1000000).alias("lat"),
        (-_west_millionths(place) / 1000000).alias("lon"),
    )


def city_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places with their county, one per customer."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    state = _by_third(nation, ["CA", "NV", "OR"])
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("City "), _text(key % 1000), F.lit(" district "), _text(key)).alias(
            "cityname"
        ),
        state.alias("state"),
        F.concat(F.lit("County "), _text(nation), F.lit(" "), state).alias("countyname"),
        _digits(nation, 5).alias("countycode"),
    )


def city_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities to look up, one per supplier; some are in no place list."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("City "), _text(key * 7 % 1200)).alias("city"),
        _by_third(key, ["CA", "NV", "WA"]).alias("state"),
    )


def requested_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods asked for: the months in which orders were placed, for three cities."""
    day = F.col("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .select(
            _by_third(F.col("o_custkey"), ["SF", "LA", "SD"]).alias("city"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
        )
        .distinct()
    )
