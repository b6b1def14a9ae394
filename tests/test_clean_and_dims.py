import math

from conftest import arrivals, cities, ports, temperatures

from portolan.operators import clean, dims, fact


def test_full_row_distinct_before_projection(spark):
    raw = arrivals(spark, [
        {"cicid": 1.0}, {"cicid": 1.0},                       # fully equal: one stays
        {"cicid": 2.0, "admnum": 7.0}, {"cicid": 2.0, "admnum": 8.0},  # differ in a dropped column
    ])
    out = clean.clean_arrivals(raw)
    ids = sorted(r.immigration_id for r in out.collect())
    assert ids == [1, 2, 2]


def test_missing_kept_values_removed_dropped_column_nulls_kept(spark):
    raw = arrivals(spark, [
        {"cicid": 1.0, "gender": None},
        {"cicid": 2.0, "i94bir": math.nan},
        {"cicid": 3.0, "occup": None, "visapost": None, "airline": None},
        {"cicid": 4.0},
    ])
    assert sorted(r.immigration_id for r in clean.clean_arrivals(raw).collect()) == [3, 4]


def test_typing_truncates_toward_zero(spark):
    raw = arrivals(spark, [{"cicid": 5.9, "i94bir": 4.99, "i94mode": 1.0, "i94visa": 3.0}])
    row = clean.clean_arrivals(raw).first()
    assert (row.immigration_id, row.age, row.arrival_mode, row.visa) == (5, 4, 1, 3)
    assert clean.clean_arrivals(raw).schema["age"].dataType.typeName() == "integer"


def test_cities_filter_and_race_rows_collapse(spark):
    raw = cities(spark, [
        *[{"Race": r, "Count": i} for i, r in enumerate(["A", "B", "C", "D", "E"])],
        {"City": None}, {"City": "Nowhere", "State Code": None},
    ])
    c = clean.clean_cities(raw)
    assert "Race" not in c.columns and "Count" not in c.columns
    assert c.count() == 5
    p = clean.clean_ports(ports(spark, [{}]))
    assert dims.dim_cities(c, p).count() == 1


def test_ports_filter_three_valued_logic(spark):
    raw = ports(spark, [
        {"ident": "ok"}, {"ident": "t-null", "type": None}, {"ident": "closed", "type": "closed"},
        {"ident": "no-iata", "iata_code": None}, {"ident": "ca", "iso_country": "CA"},
    ])
    assert [r.ident for r in clean.clean_ports(raw).collect()] == ["ok"]


def test_region_suffix_in_dim_ports(spark):
    raw = ports(spark, [
        {"ident": "a", "iso_region": "US-CA"}, {"ident": "b", "iso_region": "US-U-A"},
        {"ident": "c", "iso_region": "US"}, {"ident": "d", "iso_region": None},
    ])
    c = clean.clean_cities(cities(spark, [{}]))
    got = {r.port_id: r.iso_region for r in dims.dim_ports(clean.clean_ports(raw), c).collect()}
    assert got == {"a": "CA", "b": "U", "c": None, "d": None}


def test_same_city_name_in_two_states(spark):
    c = clean.clean_cities(cities(spark, [
        {"City": "Portland", "State": "Oregon", "State Code": "OR"},
        {"City": "Portland", "State": "Maine", "State Code": "ME"},
    ]))
    p = clean.clean_ports(ports(spark, [{"ident": "PDX", "municipality": "Portland", "iata_code": "PDX",
                                         "iso_region": "US-OR"}]))
    assert dims.dim_cities(c, p).count() == 2          # grain is (city, state)
    assert dims.dim_ports(p, c).count() == 1           # port not repeated per same-named city
    assert dims.cities_ports_combined(c, p).count() == 2  # the wide form repeats it


def test_two_ports_in_one_city(spark):
    c = clean.clean_cities(cities(spark, [{}]))
    p = clean.clean_ports(ports(spark, [{"ident": "A", "iata_code": "AAA"},
                                        {"ident": "B", "iata_code": "BBB"}]))
    assert dims.dim_ports(p, c).count() == 2
    assert dims.dim_cities(c, p).count() == 1


def test_temperatures_null_measure_removed_before_both_averages(spark):
    raw = temperatures(spark, [
        {"AverageTemperature": 10.0, "AverageTemperatureUncertainty": 1.0},
        {"AverageTemperature": 30.0, "AverageTemperatureUncertainty": None},
        {"AverageTemperature": 50.0, "AverageTemperatureUncertainty": 3.0, "Country": "Canada"},
        {"AverageTemperature": 20.0, "AverageTemperatureUncertainty": 3.0},
    ])
    t = clean.clean_temperatures(raw)
    row = dims.dim_temperatures(t).first()
    assert (row.avg_temp, row.avg_temp_uncertainty) == (15.0, 2.0)
    assert sorted(dims.dim_temperatures_by_join(t).collect()) == sorted(dims.dim_temperatures(t).collect())


def test_dim_time_one_row_per_day_across_months(spark):
    raw = arrivals(spark, [
        {"cicid": 1.0, "arrdate": 20454.0, "depdate": 20485.0},   # departs in February
        {"cicid": 2.0, "arrdate": 20485.0, "depdate": 20490.0},   # arrives that same day
    ])
    c = clean.clean_arrivals(raw)
    p = dims.dim_ports(clean.clean_ports(ports(spark, [{}])), clean.clean_cities(cities(spark, [{}])))
    t = dims.dim_time(fact.fact_arrivals(c, p))
    keys = sorted(r.sas_timestamp for r in t.collect())
    assert keys == [20454.0, 20485.0, 20490.0]
    jan1 = t.filter("sas_timestamp = 20454").first()
    assert (jan1.year, jan1.month, jan1.day, jan1.week, jan1.weekday) == (2016, 1, 1, 53, 6)


def test_fact_join_needs_state_and_port_and_reports_loss(spark):
    raw = arrivals(spark, [
        {"cicid": 1.0, "i94addr": "FL"},
        {"cicid": 2.0, "i94addr": "GA"},   # port matches, state differs
    ])
    c = clean.clean_arrivals(raw)
    p = dims.dim_ports(clean.clean_ports(ports(spark, [{}])), clean.clean_cities(cities(spark, [{}])))
    f = fact.fact_arrivals(c, p)
    assert [r.immigration_id for r in f.collect()] == [1]
    assert f.first().city == "Orlando"
    rate = fact.match_rate_by_month(c, p).first()
    assert (rate.month, rate.rows_in, rate.rows_matched) == ("2016-01", 2, 1)


def test_fact_join_same_rows_above_broadcast_bound(spark):
    raw = arrivals(spark, [{"cicid": float(i), "i94addr": "FL" if i % 2 else "GA"} for i in range(20)])
    c = clean.clean_arrivals(raw)
    p = dims.dim_ports(clean.clean_ports(ports(spark, [{}])), clean.clean_cities(cities(spark, [{}])))
    small = fact.fact_arrivals(c, p)                  # bound holds: broadcast hint
    big = fact.fact_arrivals(c, p, max_rows=0)        # bound fails: no hint, planner decides
    assert sorted(small.collect()) == sorted(big.collect())
    assert len(small.collect()) == 10


def test_size_check_bounds_rows_and_bytes(spark):
    from portolan.operators import joins

    df = spark.createDataFrame([("ab", 1, [1, 2]), (None, None, None), ("é", 3, [])],
                               "s string, i int, a array<int>")
    # 3 rows x (8 null bits + 3 fields x 8) + 4 text bytes + 7 JSON bytes
    assert joins.measure(df) == (3, 3 * 32 + 4 + 7)
    assert joins.has_at_most(df, 3, 107) and not joins.has_at_most(df, 2, 10_000)
    assert not joins.has_at_most(df, 10, 106)
    hinted = joins.maybe_broadcast(df, 10, 106)
    assert "broadcast" not in hinted._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in joins.maybe_broadcast(df, 10, 107)._jdf.queryExecution().analyzed().toString().lower()


def test_name_join_distinct_inputs_equal_distinct_pairs(spark):
    c = clean.clean_cities(cities(spark, [{}, {}, {"Race": "White"}, {"City": "Tampa"}]))
    p = clean.clean_ports(ports(spark, [{}, {}, {"ident": "KXYZ"}, {"municipality": "Miami"}]))
    got = dims.cities_ports_combined(c, p)
    want = c.join(p, c["City"] == p["municipality"]).dropDuplicates()
    assert sorted(got.collect()) == sorted(want.collect())
    # Race/Count are dropped by cleaning, so the Orlando rows are one city row;
    # the two Orlando ports differ in ident: 1 x 2 pairs, none repeated.
    assert got.count() == 2


def test_codes_beyond_int_are_refused_and_counted(spark):
    raw = arrivals(spark, [{"cicid": 3e9}, {"cicid": -2147483648.0}, {"cicid": 2147483647.9}, {"cicid": 5.0, "gender": None},
                           {"cicid": 6.0, "i94bir": float("inf")}])
    out = clean.clean_arrivals(raw)
    assert sorted(r.immigration_id for r in out.collect()) == [-2147483648, 2147483647]
    causes = {r.cause: r["rows"] for r in clean.rejected_arrivals(raw).collect()}
    assert causes == {"cicid out of range": 1, "incomplete": 1, "i94bir out of range": 1}


def test_ports_are_matched_below_the_wide_distinct(spark):
    raw = arrivals(spark, [{"cicid": 1.0}, {"cicid": 1.0}, {"cicid": 2.0, "i94port": "XXX"}])
    p = dims.dim_ports(clean.clean_ports(ports(spark, [{}])), clean.clean_cities(cities(spark, [{}])))
    from portolan.operators import fact

    out = fact.fact_from_raw(raw, p)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda word: min(i for i, line in enumerate(plan) if word in line)
    assert depth("Aggregate") < depth("LeftSemi")
    assert sorted(out.collect()) == sorted(fact.fact_arrivals(clean.clean_arrivals(raw), p).collect())
    copies = fact.fact_from_raw(raw, p, distinct=False)
    assert copies.count() == 2 and dims.dim_time(copies).exceptAll(dims.dim_time(out)).count() == 0


def test_unknown_columns_do_not_pass(spark):
    from pyspark.sql import functions as F

    extra = ports(spark, [{}]).withColumn("surprise", F.lit(1))
    assert "surprise" not in clean.clean_ports(extra).columns
    assert "surprise" not in clean.clean_cities(cities(spark, [{}]).withColumn("surprise", F.lit(1))).columns


def test_distinct_by_digest_is_the_full_row_distinct(spark):
    nan = float("nan")
    rows = [{}, {}, {"admnum": 2.0}, {"admnum": None}, {"admnum": None}, {"admnum": 0.0}, {"admnum": -0.0}, {"admnum": nan},
            {"admnum": nan}, {"airline": None}, {"airline": ""}, {"airline": "X", "fltno": "Y"}, {"airline": "XY", "fltno": ""},
            {"airline": None, "fltno": "XY"}, {"airline": "XY", "fltno": None}, {"cicid": None}, {"gender": None}]
    raw = arrivals(spark, rows)
    kept = clean.select_kept_arrivals(raw)
    want = raw.dropDuplicates().select(*kept.columns)
    assert kept.count() == want.count() == 13
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))


def test_distinct_shuffles_only_kept_columns_and_the_digest(spark):
    import re

    plan = clean.clean_arrivals(arrivals(spark, [{}]))._jdf.queryExecution().optimizedPlan().toString()
    grouped = re.search(r"Aggregate \[([^\]]*)\]", plan)[1]
    assert "_digest3" in grouped and "i94port" in grouped
    assert not any(c in grouped for c in ("admnum", "fltno", "airline", "occup"))


def test_match_rates_of_raw_and_after_a_load_agree(spark):
    from conftest import cities, ports

    rows = [{"cicid": float(i), "arrdate": 20454.0 + 20 * (i % 4), "depdate": 20700.0, "i94port": ["ORL", "MIA", "XXX"][i % 3]}
            for i in range(24)]
    rows += rows[:9] + [{"cicid": 1e12}, {"gender": None}]
    raw = arrivals(spark, rows)
    p = dims.dim_ports(clean.clean_ports(ports(spark, [{}, {"ident": "KMIA", "iata_code": "MIA"}])), clean.clean_cities(cities(spark, [{}])))
    rates = sorted(map(tuple, fact.match_rate_of_raw(raw, p).collect()))
    assert rates == sorted(map(tuple, fact.match_rate_by_month(clean.clean_arrivals(raw), p).collect()))
    loss = {r.month: (r.rows_matched, r.rows_lost) for r in fact.match_loss(raw, p, fact.fact_from_raw(raw, p)).collect()}
    assert loss == {m: (matched, n - matched) for m, n, matched in rates} and sum(b for _, b in loss.values()) == 8
    shuffled = fact.match_rate_of_raw(raw, p, max_rows=0)
    assert sorted(map(tuple, shuffled.collect())) == rates
