"""Source-shaped views over the driver's generated tables.

The generated tables hold no arrival records, so each source of the
pipeline is derived from them in the shape the pipeline reads:

* arrivals     <- lineitem join orders join customer (one row per line)
* ports        <- supplier join nation (one row per supplier)
* cities       <- customer counts per (nation, segment) join nation, region
* temperatures <- events (one row per event)

Every view grows with the tables it reads. The matching DuckDB definitions
live in ``portolan.plans.oracle``; both must produce the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portolan.functions.dates import days_since_sas_epoch
from portolan.schemas import ARRIVALS_RAW, CITIES_RAW, PORTS_RAW, TEMPERATURES_RAW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null(type_name: str = "string"):
    return F.lit(None).cast(type_name)


def arrivals_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """28-column raw arrivals, one row per order line."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(cu, od.o_custkey == cu.c_custkey)
    arr = F.to_date("o_orderdate")
    dbl = lambda c: c.cast("double")
    cols = {
        "cicid": dbl(F.col("o_orderkey") * 10 + F.col("l_linenumber")),
        "i94yr": dbl(F.year(arr)),
        "i94mon": dbl(F.month(arr)),
        "i94cit": dbl(F.col("c_nationkey")),
        "i94res": dbl(F.col("c_nationkey")),
        "i94port": F.col("l_suppkey").cast("string"),
        "arrdate": days_since_sas_epoch(arr),
        "i94mode": F.substring("o_orderpriority", 1, 1).cast("double"),
        "i94addr": F.col("c_nationkey").cast("string"),
        "depdate": days_since_sas_epoch("l_shipdate"),
        "i94bir": F.col("l_quantity") + F.col("l_discount") * 5,
        "i94visa": dbl(F.col("o_custkey") % 3 + 1),
        "count": F.lit(1.0),
        "dtadfile": _null(),
        "visapost": _null(),
        "occup": _null(),
        "entdepa": F.col("l_linestatus"),
        "entdepd": _null(),
        "entdepu": _null(),
        "matflag": F.col("l_linestatus"),
        "biryear": dbl(F.year(arr)) - F.col("l_quantity"),
        "dtaddto": _null(),
        "gender": (F.when(F.col("c_mktsegment") == "HOUSEHOLD", _null())
                   .when(F.col("l_linestatus") == "O", F.lit("F"))
                   .otherwise(F.lit("M"))),
        "insnum": _null(),
        "airline": F.col("c_mktsegment"),
        "admnum": dbl(F.col("l_partkey")),
        "fltno": F.col("l_partkey").cast("string"),
        "visatype": F.col("l_returnflag"),
    }
    return j.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in ARRIVALS_RAW.fields])


def ports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport-code rows: one per supplier, municipality = nation name."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    bal = F.col("s_acctbal")
    cols = {
        "ident": F.concat(F.lit("P"), F.col("s_suppkey").cast("string")),
        "type": (F.when(bal < 0, "closed").when(bal < 3000, "small_airport")
                 .when(bal < 6000, "medium_airport").when(bal < 9000, "large_airport")),
        "name": F.col("s_name"),
        "elevation_ft": F.col("s_nationkey") * 100,
        "continent": F.lit("NA"),
        "iso_country": F.when(F.col("s_nationkey") == 24, "CA").otherwise("US"),
        "iso_region": F.concat(F.lit("US-"), F.col("s_nationkey").cast("string")),
        "municipality": F.col("n_name"),
        "gps_code": _null(),
        "iata_code": F.col("s_suppkey").cast("string"),
        "local_code": _null(),
        "coordinates": _null(),
    }
    return j.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in PORTS_RAW.fields])


def cities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographic rows: one per (nation, market segment), city = nation name.

    As in the real file, the city-level measures repeat on each of the
    rows that differ only in ``Race``/``Count``.
    """
    cu = table(spark, sf_dir, "customer")
    seg = cu.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("c_custkey") % 2 == 0).alias("n_even"),
        F.count_if(F.col("c_acctbal") < 0).alias("n_neg"),
    )
    per_nation = Window.partitionBy("c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = (seg.join(n, seg.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    total = F.sum("n").over(per_nation)
    even = F.sum("n_even").over(per_nation)
    cols = {
        "City": F.col("n_name"),
        "State": F.col("r_name"),
        "Median Age": F.col("n_nationkey").cast("double") + 30.5,
        "Male Population": even,
        "Female Population": total - even,
        "Total Population": total,
        "Number of Veterans": F.sum(F.when(F.col("c_mktsegment") == "BUILDING", F.col("n"))
                                    .otherwise(0)).over(per_nation),
        "Foreign-born": F.sum("n_neg").over(per_nation),
        "Average Household Size": F.col("n_regionkey").cast("double") + 1.5,
        "State Code": F.concat(F.lit("S"), F.col("n_regionkey").cast("string")),
        "Race": F.col("c_mktsegment"),
        "Count": F.col("n"),
    }
    return j.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in CITIES_RAW.fields])


def temperatures_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature rows: one per event; 'error' events are non-US."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1)
    cols = {
        "dt": F.to_date("ts"),
        "AverageTemperature": F.col("value"),
        "AverageTemperatureUncertainty": F.nullif(k, F.lit("0")).try_cast("double") / 10.0,
        "City": F.concat(F.lit("CITY_"), F.col("user_id").cast("string")),
        "Country": F.when(F.col("event_type") == "error", "Canada").otherwise("United States"),
        "Latitude": _null(),
        "Longitude": _null(),
    }
    return ev.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in TEMPERATURES_RAW.fields])


def nation_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State code list (code -> label) derived from the nation table."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
