"""Registered queries: one per operator, each over the whole driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Column names
equal those of the SQL in ``portolan.plans.oracle``. Averages are rounded
to 6 places in both so that summation order cannot change a digit.
Queries that exercise sinks write below the shared scratch folder
(``spark.checkpoint.dir``) and read their own output back.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions.dates import month_key, sas_to_date_text
from portolan.functions.text import region_suffix
from portolan.operators import clean, dims, fact, lookups, profile, quality, skew
from portolan.plans import analytics, job, monthly_counts, warehouse_sql
from portolan.plans.star import (
    LazyTables,
    Sources,
    build_star,
    clean_sources,
    fact_with_copies,
    load_star,
    load_star_observed,
)
from portolan.schemas import ARRIVALS_KEPT, ARRIVALS_RAW, CITIES_RAW, PORTS_RAW
from portolan.session import remove_path, scratch_path
from portolan.sources import code_lists, files, published, testdata, warehouse
from portolan.streaming import read_fact, start_monthly_load

# The database of the warehouse check, made anew by each call.
CHECK_DATABASE = "portolan_warehouse_check"
BUCKET_DATABASE = "portolan_bucket_check"  # and of the tables dealt by city
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the README queries on the generated data (a port code of
# the supplier-derived port list, chosen once).
YOUNG_PORT = "6"
YOUNG_MAX_AGE = 5
TOP_K = 5
ARRIVAL_PROFILE_COLUMNS = ["visa", "visatype", "arrival_mode", "state", "age", "origin"]
TIME_PROFILE_COLUMNS = ["year", "month", "day"]
SKEW_COLUMNS = ["i94port", "i94addr", "i94cit", "arrdate", "visatype", "gender"]


class _LazySources(Sources):
    """Sources read on first use, so a query touches only its own tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):  # noqa: D107 - no dataclass init
        self._readers = {
            "arrivals": lambda: testdata.arrivals_raw(spark, sf_dir),
            "cities": lambda: testdata.cities_raw(spark, sf_dir),
            "ports": lambda: testdata.ports_raw(spark, sf_dir),
            "temperatures": lambda: testdata.temperatures_raw(spark, sf_dir),
        }
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        readers = self.__dict__.get("_readers", {})
        if name not in readers:
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = readers[name]()
        return self._read[name]


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return _LazySources(spark, sf_dir)


def star(spark: SparkSession, sf_dir: str):
    return build_star(sources(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str):
    src = sources(spark, sf_dir)
    return LazyTables({
        "arrivals": lambda t: clean.clean_arrivals(src.arrivals),
        "cities": lambda t: clean.clean_cities(src.cities),
        "ports": lambda t: clean.clean_ports(src.ports),
        "temperatures": lambda t: clean.clean_temperatures(src.temperatures),
    })


_LAST: dict[tuple[str, str], str] = {}


def _scratch(spark: SparkSession, kind: str, sf_dir: str) -> str:
    """A fresh folder per call. The one of the same query's call before is
    removed, so a session keeps one copy per query; run a frame before the
    query is built again."""
    tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    path = scratch_path(spark, "portolan", kind, tag, uuid.uuid4().hex[:12])
    if (kind, tag) in _LAST:
        remove_path(spark, _LAST[kind, tag])
    _LAST[kind, tag] = path
    return path


def _round_avgs(df: DataFrame) -> DataFrame:
    return df.select("city", F.round("avg_temp", 6).alias("avg_temp"),
                     F.round("avg_temp_uncertainty", 6).alias("avg_temp_uncertainty"))


# -- scalar functions ---------------------------------------------------------------

def q_sas_date(spark, sf_dir):
    raw = testdata.arrivals_raw(spark, sf_dir)
    x = (F.col("arrdate") + F.col("i94bir") / 100 - 0.25).alias("sas_value")
    vals = raw.select(x).distinct()
    return vals.select("sas_value", sas_to_date_text("sas_value").alias("sas_date"))


def q_region_suffix(spark, sf_dir):
    return testdata.ports_raw(spark, sf_dir).select(
        "ident", "iso_region", region_suffix("iso_region").alias("region"))


# -- cleaning -------------------------------------------------------------------------

def q_arrivals_typed(spark, sf_dir):
    return cleaned(spark, sf_dir)["arrivals"]


def q_cities_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)["cities"]


def q_ports_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)["ports"]


def q_temps_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)["temperatures"]


def q_drop_any_null(spark, sf_dir):
    kept = clean.select_kept_arrivals(testdata.arrivals_raw(spark, sf_dir))
    return clean.drop_incomplete(kept)


def q_null_profile(spark, sf_dir):
    kept = clean.select_kept_arrivals(testdata.arrivals_raw(spark, sf_dir))
    return profile.null_profile(kept, ARRIVALS_KEPT)


def q_dedup_full_row(spark, sf_dir):
    raw = testdata.arrivals_raw(spark, sf_dir)
    return clean.dedup_rows(raw.unionByName(raw))


# -- joins and dimensions ------------------------------------------------------------

def q_cities_ports_combined(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return dims.cities_ports_combined(c["cities"], c["ports"])


def q_dim_ports(spark, sf_dir):
    return star(spark, sf_dir)["dim_ports"]


def q_dim_cities(spark, sf_dir):
    return star(spark, sf_dir)["dim_cities"]


def q_dim_time(spark, sf_dir):
    return star(spark, sf_dir)["dim_time"]


def q_union_distinct_dates(spark, sf_dir):
    arrivals = clean.clean_arrivals(sources(spark, sf_dir).arrivals, distinct=False)  # copies make no new day
    return dims.distinct_dates(arrivals, ["arrival_date", "departure_date"])


def q_dim_temperatures(spark, sf_dir):
    return _round_avgs(star(spark, sf_dir)["dim_temperatures"])


def q_using_join_aggregates(spark, sf_dir):
    return _round_avgs(dims.dim_temperatures_by_join(cleaned(spark, sf_dir)["temperatures"]))


def q_fact_arrivals(spark, sf_dir):
    return star(spark, sf_dir)["fact_immigrations"]


def q_decode_labels(spark, sf_dir):
    a = cleaned(spark, sf_dir)["arrivals"].select(
        "immigration_id", "arrival_mode",
        lookups.decode_constant("arrival_mode", lookups.ARRIVAL_MODES).alias("mode_label"),
        "visa", lookups.decode_constant("visa", lookups.VISA_CATEGORIES).alias("visa_label"),
        "state")
    return lookups.decode_join(a, "state", testdata.nation_states(spark, sf_dir), "state_label")


# -- analytic queries ----------------------------------------------------------------

def q_young_arrivals(spark, sf_dir):
    # The days of the young arrivals at the port are all that the join can meet.
    facts = star(spark, sf_dir)["fact_immigrations"]
    young = facts.filter((F.col("age") < YOUNG_MAX_AGE) & (F.col("landing_port") == YOUNG_PORT))
    return analytics.young_arrivals(young, dims.dim_time(young), YOUNG_PORT, YOUNG_MAX_AGE)


def q_oldest(spark, sf_dir):
    src = sources(spark, sf_dir)
    return analytics.oldest(fact_with_copies(src, star(spark, sf_dir)["dim_ports"]))


def q_port_types(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.port_types(s["fact_immigrations"], s["dim_ports"])


def q_top_cities(spark, sf_dir):
    return analytics.top_cities(star(spark, sf_dir)["fact_immigrations"], TOP_K)


def q_weekday_counts(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.weekday_counts(s["fact_immigrations"], s["dim_time"])


# -- the analytic queries as SQL text ---------------------------------------------------

def _sql_example(name: str, **params) -> Query:
    def run(spark, sf_dir):
        return warehouse_sql.example_query(spark, name, star(spark, sf_dir), **params)
    run.__doc__ = f"The {name} example query as SQL text over the lazy star."
    return run


# -- profiling and quality -----------------------------------------------------------

def _arrival_counts(col):
    return lambda spark, sf_dir: profile.value_counts(cleaned(spark, sf_dir)["arrivals"], col)


def _time_counts(col):
    """Over the days of all cleaned arrivals, with or without a port."""
    def run(spark, sf_dir):
        arrivals = clean.clean_arrivals(sources(spark, sf_dir).arrivals, distinct=False)
        return profile.value_counts(dims.dim_time(arrivals), col)
    return run


def q_profile_counts_city(spark, sf_dir):
    return profile.value_counts(star(spark, sf_dir)["fact_immigrations"], "city")


def q_profile_long(spark, sf_dir):
    return profile.profile(star(spark, sf_dir)["fact_immigrations"],
                           ["visa", "visatype", "arrival_mode", "age"])


def q_heavy_hitters(spark, sf_dir):
    """Values that hold a share of all raw arrivals, of six wide columns: each
    month's sketches are written, read back and merged; then exact counts."""
    raw = sources(spark, sf_dir).arrivals
    path = _scratch(spark, "skew", sf_dir)
    sketches = files.write_table(skew.sketch_months(raw, month_key("arrdate"), SKEW_COLUMNS), path)
    return skew.heavy_hitters(raw, sketches, SKEW_COLUMNS)


def q_dq_row_counts(spark, sf_dir):
    return quality.row_count_check(star(spark, sf_dir))


def q_dq_null_keys(spark, sf_dir):
    return quality.null_key_check(star(spark, sf_dir))


def q_dq_unique_keys(spark, sf_dir):
    return quality.unique_key_check(star(spark, sf_dir))


def q_dq_report(spark, sf_dir):
    return quality.quality_report(star(spark, sf_dir))


def q_match_rate_by_month(spark, sf_dir):
    s = sources(spark, sf_dir)
    ports = dims.dim_ports(clean.clean_ports(s.ports), clean.clean_cities(s.cities))
    return fact.match_rate_of_raw(s.arrivals, ports)


def q_match_loss_after_load(spark, sf_dir):
    """The star loaded; fact rows per month counted in the written fact, and
    the arrivals that the load left out because they have no port."""
    base = _scratch(spark, "match_loss", sf_dir)
    src = sources(spark, sf_dir)
    tables = load_star(spark, src, base)
    return fact.match_loss(src.arrivals, tables["dim_ports"], tables["fact_immigrations"])


# -- sources and sinks ---------------------------------------------------------------

def q_union_months_distinct(spark, sf_dir):
    """Raw arrivals staged as one partition per month, read back as one
    multi-month dataset, joined into facts; distinct complete rows counted."""
    src = sources(spark, sf_dir)
    base = _scratch(spark, "arrivals_by_month", sf_dir)
    files.stage_monthly(src.arrivals, base, month_key("arrdate"))
    months = files.read_months(spark, base)
    c = clean_sources(Sources(months.select(*ARRIVALS_RAW.fieldNames()), src.cities,
                              src.ports, src.temperatures))
    facts = fact.fact_from_raw(months.select(*ARRIVALS_RAW.fieldNames()), dims.dim_ports(c["ports"], c["cities"]))
    return fact.distinct_complete_count(facts)


def q_ports_csv(spark, sf_dir):
    path = _scratch(spark, "ports_csv", sf_dir)
    files.write_csv(testdata.ports_raw(spark, sf_dir), path, sep=",")
    return clean.clean_ports(files.read_csv(spark, path, PORTS_RAW, sep=","))


def q_cities_csv(spark, sf_dir):
    path = _scratch(spark, "cities_csv", sf_dir)
    files.write_csv(testdata.cities_raw(spark, sf_dir), path, sep=";")
    return clean.clean_cities(files.read_csv(spark, path, CITIES_RAW, sep=";"))


ORDER_TEXTS = T.StructType([T.StructField("o_orderkey", T.LongType()),
                            *[T.StructField(c, T.StringType())
                              for c in ("token_text", "blank_text", "quoted_text")]])


def q_csv_null_semantics(spark, sf_dir):
    """Orders written as CSV with the three kinds of missing text, then read
    back: a literal ``NULL`` token and an empty unquoted field (how the writer
    stores a null when its null token is empty) read as null; a quoted empty
    field reads as the empty string."""
    o = testdata.table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    texts = o.select(
        "o_orderkey",
        F.when(status == "F", F.lit(files.NULL_TOKEN)).otherwise(F.col("o_orderpriority")).alias("token_text"),
        F.when(status != "O", status).alias("blank_text"),
        F.when(status == "P", F.lit("")).otherwise(status).alias("quoted_text"))
    path = _scratch(spark, "orders_csv", sf_dir)
    files.write_csv(texts, path, sep=",", null_token="")
    return files.read_csv(spark, path, ORDER_TEXTS, sep=",")


def catalog_lists(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Code lists derived from the tables: countries (integer keys), ports and
    states (quoted keys)."""
    n = testdata.table(spark, sf_dir, "nation")
    s = testdata.table(spark, sf_dir, "supplier")
    r = testdata.table(spark, sf_dir, "region")
    return {
        "i94cntyl": n.select(F.col("n_nationkey").cast("string").alias("code"),
                             F.col("n_name").alias("label"), F.lit(False).alias("quoted")),
        "$i94prtl": s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code"),
                             F.concat(F.col("s_name"), F.lit(", "),
                                      F.col("s_nationkey").cast("string")).alias("label"),
                             F.lit(True).alias("quoted")),
        "$i94addrl": r.select(F.concat(F.lit("S"), F.col("r_regionkey").cast("string")).alias("code"),
                              F.col("r_name").alias("label"), F.lit(True).alias("quoted")),
    }


def q_code_lists(spark, sf_dir):
    path = _scratch(spark, "catalog", sf_dir)
    code_lists.write_catalog(catalog_lists(spark, sf_dir), path)
    return code_lists.read_code_lists(spark, path)


def q_port_places(spark, sf_dir):
    """Port labels of the parsed catalog split into place and state."""
    return code_lists.port_places(q_code_lists(spark, sf_dir))


def q_decode_catalog(spark, sf_dir):
    """Arrival origins decoded through the country list of the parsed catalog."""
    lists = q_code_lists(spark, sf_dir)
    countries = lists.filter(F.col("list_name") == "i94cntyl").select("code", "label")
    a = cleaned(spark, sf_dir)["arrivals"].select(
        "immigration_id", "origin", F.col("origin").cast("string").alias("origin_code"))
    return lookups.decode_join(a, "origin_code", countries, "origin_label").drop("origin_code")


def q_stream_fact_load(spark, sf_dir):
    """Raw arrivals landed as files, loaded by the incremental stream loader
    (one micro-batch takes all landed files), fact read back."""
    base = _scratch(spark, "stream", sf_dir)
    src = sources(spark, sf_dir)
    src.arrivals.write.parquet(f"{base}/landing")
    c = clean_sources(src)
    ports = dims.dim_ports(c["ports"], c["cities"])
    start_monthly_load(spark, f"{base}/landing", ports, f"{base}/fact", f"{base}/checkpoint").awaitTermination()
    return read_fact(spark, f"{base}/fact")


def q_star_load(spark, sf_dir):
    """Load the five tables into the warehouse folder, then check row counts
    on what was written."""
    base = _scratch(spark, "warehouse", sf_dir)
    return quality.row_count_check(load_star(spark, sources(spark, sf_dir), base))


def q_star_load_metrics(spark, sf_dir):
    """Load the five tables; row-count and null-key checks from the metrics
    the writes observed (no scan of the written tables)."""
    base = _scratch(spark, "warehouse_observed", sf_dir)
    _, metrics = load_star_observed(spark, sources(spark, sf_dir), base)
    return quality.report_from_metrics(spark, metrics)


def q_etl_from_files(spark, sf_dir):
    """The batch job from files: the four sources staged as the raw file
    kinds (monthly arrivals Parquet, ';' cities CSV, comma ports and
    temperatures CSV), read back by the job, star written; the fact as
    loaded."""
    base = _scratch(spark, "etl_files", sf_dir)
    src = sources(spark, sf_dir)
    files.stage_monthly(src.arrivals, f"{base}/in/arrivals", month_key("arrdate"))
    files.write_csv(src.cities, f"{base}/in/cities", sep=";")
    files.write_csv(src.ports, f"{base}/in/ports", sep=",")
    files.write_csv(src.temperatures, f"{base}/in/temperatures", sep=",")
    read = job.read_sources(spark, f"{base}/in/arrivals", f"{base}/in/cities",
                                 f"{base}/in/ports", f"{base}/in/temperatures")
    tables, _ = job.run(spark, read, f"{base}/out")
    remove_path(spark, f"{base}/in")
    return tables["fact_immigrations"]


def q_monthly_counts(spark, sf_dir):
    """The star loaded by the batch job, its last year's months loaded anew,
    and the counts of weekdays, port types, top cities, the highest age, values
    and months summed from the published counts per month."""
    base = _scratch(spark, "monthly_counts", sf_dir)
    src = sources(spark, sf_dir)
    staged = files.stage_monthly(src.arrivals, f"{base}/in", month_key("arrdate"))
    months = [r["month"] for r in staged.select("month").distinct().collect()]  # calendar months
    last = [m for m in months if m[:4] == max(months)[:4]] if months else []
    for loaded in (months, last):
        raw = files.read_months(spark, f"{base}/in", loaded, ARRIVALS_RAW).select(*ARRIVALS_RAW.fieldNames())
        job.run(spark, Sources(raw, src.cities, src.ports, src.temperatures), f"{base}/out", months=loaded)
    tables = published.read(spark, f"{base}/out")
    counts = monthly_counts.read(spark, f"{base}/out")
    answers = {
        "weekday": monthly_counts.weekday_counts(counts, tables["dim_time"]),
        "port_type": monthly_counts.port_types(counts, tables["dim_ports"]),
        "top_city": monthly_counts.top_cities(counts, TOP_K),
        "month": monthly_counts.rows_by_month(counts),
        "oldest": monthly_counts.oldest(counts).select(F.lit("age"), F.col("age").cast("long")),
    }
    named = [df.toDF("value", "n").select(F.lit(name).alias("question"), F.col("value").cast("string"), "n")
             for name, df in answers.items()]
    named.append(monthly_counts.profile(counts, ["visa", "visatype", "arrival_mode", "gender"]).toDF("question", "value", "n"))
    return fact.stack_months(*named)


def q_warehouse_checks(spark, sf_dir):
    """The star written as Parquet folders, registered as external tables,
    and the row-count and null-key checks run as SQL text over those tables.
    The database is made anew by each call."""
    base = _scratch(spark, "warehouse_sql", sf_dir)
    load_star(spark, sources(spark, sf_dir), base)
    spark.sql(f"DROP DATABASE IF EXISTS {CHECK_DATABASE} CASCADE")
    warehouse.register_tables(spark, base, CHECK_DATABASE)
    return warehouse_sql.warehouse_checks(spark, warehouse.read_tables(spark, CHECK_DATABASE))


def q_city_population_counts(spark, sf_dir):
    """Fact and cities as warehouse tables dealt by city, joined and
    counted per city. The database is made anew by each call."""
    base = _scratch(spark, "warehouse_buckets", sf_dir)
    spark.sql(f"DROP DATABASE IF EXISTS {BUCKET_DATABASE} CASCADE")
    warehouse.create_tables(spark, BUCKET_DATABASE, base, buckets=BUCKETS)
    frames = star(spark, sf_dir)
    warehouse.load_tables({name: frames[name] for name in ("fact_immigrations", "dim_cities")}, BUCKET_DATABASE, BUCKETS)
    tables = warehouse.read_tables(spark, BUCKET_DATABASE)
    return analytics.city_populations(tables["fact_immigrations"], tables["dim_cities"])


def q_month_files(spark, sf_dir):
    """Raw arrivals staged as one file per month, read back by a path template
    naming every month; rows per month."""
    base = _scratch(spark, "month_files", sf_dir)
    staged = files.stage_monthly(sources(spark, sf_dir).arrivals, base, month_key("arrdate"))
    months = sorted(r["month"] for r in staged.select("month").distinct().collect())  # calendar months
    raw = files.read_month_files(spark, f"{base}/month={{month}}", months, ARRIVALS_RAW)
    return raw.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum("arrdate").alias("days"))


def q_csv_header_names(spark, sf_dir):
    """Ports written as CSV with their columns in another order and one more,
    read back by header name and cleaned."""
    path = _scratch(spark, "csv_header_names", sf_dir)
    raw = testdata.ports_raw(spark, sf_dir)
    turned = raw.select(F.lit("x").alias("extra"), *reversed(raw.columns))
    files.write_csv(turned, path, sep=",")
    return clean.clean_ports(files.read_csv(spark, path, PORTS_RAW, sep=","))


def q_arrivals_rejected(spark, sf_dir):
    """Distinct raw arrivals that cleaning refuses, per cause."""
    return clean.rejected_arrivals(sources(spark, sf_dir).arrivals)


def q_parquet_write_modes(spark, sf_dir):
    """Finished orders written where nothing may be yet, a second such write
    refused, the other orders appended, and all read back."""
    orders = testdata.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = _scratch(spark, "write_modes", sf_dir)
    finished = orders.filter("o_orderstatus = 'F'")
    files.write_table(finished, path, mode="errorifexists")
    try:
        files.write_table(finished, path, mode="errorifexists")
        refused = False
    except AnalysisException:
        refused = True
    files.write_table(orders.filter("o_orderstatus <> 'F'"), path, mode="append")
    return spark.read.schema(orders.schema).parquet(path).withColumn("refused", F.lit(refused))


def q_preview_ports(spark, sf_dir):
    """The first ten ports by identifier."""
    ports = testdata.ports_raw(spark, sf_dir).select("ident", "name", "iso_region", "municipality")
    return profile.preview(ports, 10, ["ident"])


def q_country_status(spark, sf_dir):
    """Arrival origins decoded through a parsed country list that holds
    invalid, collapsed and uncoded entries, with each entry's status."""
    n = testdata.table(spark, sf_dir, "nation")
    path = _scratch(spark, "country_status", sf_dir)
    turn, name = F.col("n_nationkey") % 5, F.col("n_name")
    label = (F.when(turn == 1, F.concat(F.lit("INVALID: "), name)).when(turn == 2, F.concat(F.lit("Collapsed "), name))
             .when(turn == 3, F.concat(F.lit("No Country Code ("), F.col("n_nationkey").cast("string"), F.lit(")")))
             .otherwise(name))
    code_lists.write_catalog({"i94cntyl": n.select(
        F.col("n_nationkey").cast("string").alias("code"), label.alias("label"), F.lit(False).alias("quoted"))}, path)
    countries = code_lists.read_code_lists(spark, path).select("code", "label")
    a = cleaned(spark, sf_dir)["arrivals"].select("immigration_id", F.col("origin").cast("string").alias("origin"))
    found = lookups.decode_join(a, "origin", countries, "origin_label")
    return found.withColumn("status", code_lists.label_status("origin_label"))


QUERIES: dict[str, Query] = {
    "sas_date": q_sas_date,
    "region_suffix": q_region_suffix,
    "arrivals_typed": q_arrivals_typed,
    "cities_clean": q_cities_clean,
    "ports_clean": q_ports_clean,
    "temps_clean": q_temps_clean,
    "drop_any_null": q_drop_any_null,
    "null_profile": q_null_profile,
    "dedup_full_row": q_dedup_full_row,
    "cities_ports_combined": q_cities_ports_combined,
    "dim_ports": q_dim_ports,
    "dim_cities": q_dim_cities,
    "dim_time": q_dim_time,
    "union_distinct_dates": q_union_distinct_dates,
    "dim_temperatures": q_dim_temperatures,
    "using_join_aggregates": q_using_join_aggregates,
    "fact_arrivals": q_fact_arrivals,
    "decode_labels": q_decode_labels,
    "young_arrivals": q_young_arrivals,
    "oldest": q_oldest,
    "port_types": q_port_types,
    "top_cities": q_top_cities,
    "weekday_counts": q_weekday_counts,
    **{f"profile_counts_{c}": _arrival_counts(c) for c in ARRIVAL_PROFILE_COLUMNS},
    **{f"profile_counts_{c}": _time_counts(c) for c in TIME_PROFILE_COLUMNS},
    "profile_counts_city": q_profile_counts_city,
    "profile_long": q_profile_long,
    "dq_row_counts": q_dq_row_counts,
    "dq_null_keys": q_dq_null_keys,
    "dq_unique_keys": q_dq_unique_keys,
    "dq_report": q_dq_report,
    "match_rate_by_month": q_match_rate_by_month,
    "match_loss_after_load": q_match_loss_after_load,
    "city_population_counts": q_city_population_counts,
    "monthly_counts": q_monthly_counts,
    "heavy_hitters": q_heavy_hitters,
    "union_months_distinct": q_union_months_distinct,
    "ports_csv": q_ports_csv,
    "cities_csv": q_cities_csv,
    "csv_null_semantics": q_csv_null_semantics,
    "code_lists": q_code_lists,
    "port_places": q_port_places,
    "decode_catalog": q_decode_catalog,
    "star_load": q_star_load,
    "stream_fact_load": q_stream_fact_load,
    "star_load_metrics": q_star_load_metrics,
    "warehouse_checks": q_warehouse_checks,
    "etl_from_files": q_etl_from_files,
    "month_files": q_month_files,
    "csv_header_names": q_csv_header_names,
    "arrivals_rejected": q_arrivals_rejected,
    "parquet_write_modes": q_parquet_write_modes,
    "preview_ports": q_preview_ports,
    "country_status": q_country_status,
    "sql_young_arrivals": _sql_example("young_arrivals", port=YOUNG_PORT, max_age=YOUNG_MAX_AGE),
    "sql_oldest": _sql_example("oldest"),
    "sql_port_types": _sql_example("port_types"),
    "sql_top_cities": _sql_example("top_cities", k=TOP_K),
    "sql_weekday_counts": _sql_example("weekday_counts"),
}
