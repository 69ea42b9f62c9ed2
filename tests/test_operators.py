import itertools
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from posada.operators import lookup, sketches
from posada.operators.columns import (by_prefix, drop_empty_columns, empty_columns, host_columns,
                                      normalise_nan)
from posada.operators.correlation import spearman_pairs, value_sizes
from posada.operators.dedup import duplicate_count, keep_first
from posada.operators.frequencies import (availability_rates, distinct_counts, group_count, group_size_range,
                                          per_year, top_values, value_counts, value_shares, year_over_year)
from posada.operators.histograms import equal_width_bins, fixed_bins
from posada.operators.hosts import host_concentration, split_hosts
from posada.operators.impute import impute_group_median
from posada.operators.membership import matched_keys, orphan_keys, row_total
from posada.operators.nested import add_amenity_count, amenity_pairs, flatten_quote
from posada.operators.nulls import null_cells, null_counts, null_percentages, structure
from posada.operators.outliers import box_stats, iqr_outlier
from posada.operators.quantiles import (CELLS, FINE_CELLS, exact_quantiles, quantile_struct,
                                        with_cells)
from posada.operators.summaries import describe_numeric, describe_text


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


# ------------------------------------------------------------------ duplicates

def test_keep_first_by_key(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": rng.integers(0, 40, 300), "v": rng.integers(0, 4, 300)})
    df = spark.createDataFrame(pdf)
    want = pdf.sort_values(["id", "v"]).drop_duplicates("id")
    assert rows_of(keep_first(df, ["id"])) == list(want.itertuples(index=False, name=None))
    assert duplicate_count(df, ["id"]).first()[0] == pdf.duplicated("id").sum()
    assert duplicate_count(df).first()[0] == pdf.duplicated().sum()


def test_keep_first_treats_null_keys_as_equal_and_nulls_as_last(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (3, None), (3, 7)], "id long, v long")
    assert rows_of(keep_first(df, ["id"])) == [(None, 1), (3, 7)]


def test_keep_first_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 5000).alias("v"),
                                  F.col("id").alias("w"))
    one = rows_of(keep_first(df.coalesce(1), ["k"], ["v"]))
    many = rows_of(keep_first(df.repartition(8, "w"), ["k"], ["v"]))
    assert one == many and len(one) == 7


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


# ------------------------------------------------------------------ quantiles

@pytest.mark.parametrize("seed", range(4))
def test_exact_quantiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    n = 3000
    values = {0: rng.lognormal(11, 2, n), 1: rng.normal(0, 1e-3, n),
              2: rng.integers(-5, 6, n).astype(float), 3: np.r_[np.zeros(n // 2), rng.uniform(
                  -1e9, 1e9, n - n // 2)]}[seed]
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], n, p=[0.9, 0.09, 0.01]), "x": values})
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = normalise_nan(spark.createDataFrame(pdf))
    got = quantile_struct(df, ["x"], probs).first()["x"]
    assert got == pytest.approx(list(pdf.x.quantile(probs)), rel=1e-12, abs=1e-15)
    for row in exact_quantiles(df, ["x"], probs, ["g"]).collect():
        group = pdf.x[pdf.g == row["g"]]
        assert row["n"] == group.count()
        assert row["q"] == pytest.approx(list(group.quantile(probs)), rel=1e-12, abs=1e-15)


def test_no_window_holds_a_narrow_column(spark):
    n = 2_000_000
    df = spark.range(n).select((F.lit(-74.1) + F.col("id") * (0.05 / n)).alias("x"))
    cells = with_cells(df, "x")
    assert cells.groupBy(CELLS).count().agg(F.max("count")).first()[0] < 100
    assert cells.groupBy(CELLS[0]).agg(F.count_distinct(CELLS[1]).alias("n")).agg(
        F.max("n")).first()[0] <= FINE_CELLS
    got = quantile_struct(df, ["x"], [0.25, 0.5, 0.75]).first()["x"]
    assert got == pytest.approx([-74.0875, -74.075, -74.0625], abs=1e-7)


def test_cells_keep_the_order_of_values(spark):
    rng = np.random.default_rng(8)
    near = 74.05 + rng.uniform(0, 0.1, 4000)
    values = np.r_[near, -near, 10.0 ** rng.uniform(-320, 308, 4000), -10.0 ** rng.uniform(-9, 9, 999),
                   0.0, 5e-324, -5e-324, np.inf, -np.inf, np.nextafter(74.1, 80), 74.1]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [tuple(r) for r in with_cells(df, "x").orderBy("x").select(*CELLS).collect()]
    assert got == sorted(got)


def test_quantiles_with_one_very_frequent_value_and_group(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(
        F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    pdf = df.toPandas()
    got = {r["g"]: r["q"][0] for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == pytest.approx(pdf.groupby("g").x.median().to_dict())


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, None)], "g string, x double")
    assert quantile_struct(df, ["x"], [0.5]).first()["x"] is None
    assert exact_quantiles(df, ["x"], [0.5], ["g"]).count() == 0


def test_describe_numeric_equals_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 10.0], "b": [5, 5, 5, 6]})
    got = {r["columna"]: r.asDict() for r in
           describe_numeric(normalise_nan(spark.createDataFrame(pdf)), ["a", "b"]).collect()}
    for c in "ab":
        want = pdf[c].describe()
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[theirs])


def test_describe_text(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("a",)], "t string")
    assert rows_of(describe_text(df, ["t"])) == [("t", 4, 2, "a", 2)]


# ------------------------------------------------------------------ outliers, bins

def test_iqr_outlier_is_strict_and_null_is_false(spark):
    # Quartiles 0 and 4 put the fences at -6 and 10, which some values meet exactly.
    values = pd.Series([-6.0, 0, 0, 0, 2, 2, 4, 4, 4, 10.0, 10.5, -6.5, None])
    low, high = values.quantile(0.25), values.quantile(0.75)
    assert (low, high) == (0.0, 4.0)
    df = normalise_nan(spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "x": values})))
    got = [r[1] for r in rows_of(df.select("i", iqr_outlier(df, "x").alias("o")), "i")]
    assert got == [bool(v < low - 6 or v > high + 6) for v in values]
    assert sum(got) == 2


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 5.0)],
                               "g string, x double")
    assert rows_of(box_stats(df, "x", ["g"])) == [("a", 2.0, 3.0, 4.0, 1.0, 4.0, 1),
                                                  ("b", 5.0, 5.0, 5.0, 5.0, 5.0, 0)]
    assert box_stats(df.where("g = 'a'"), "x").first()["atipicos"] == 1


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    counts, edges = np.histogram(values, bins=12)
    got = rows_of(equal_width_bins(df, F.col("x"), 12), "orden")
    assert [r[2] for r in got] == list(counts)
    assert [r[1] for r in got] == pytest.approx(list(edges[:-1]))


def test_fixed_bins_report_empty_bins(spark):
    df = spark.createDataFrame([(0,), (1,), (90,), (400,), (None,)], "x int")
    assert rows_of(fixed_bins(df, "x", [-1, 0, 90, 180]), "orden") == [
        (0, "(-1, 0]", 1), (1, "(0, 90]", 2), (2, "(90, 180]", 0)]


# ------------------------------------------------------------------ imputation, lookup

def test_impute_group_then_overall(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, "b", None), (5, None, None), (6, "c", 9.0)],
        "id int, room_type string, beds double")
    got = dict(rows_of(impute_group_median(df, ["beds", "absent"], "room_type").select("id", "beds")))
    # group a -> 2; b and the row without group -> median of 1, 3, 2, 9
    assert got == {1: 1.0, 2: 3.0, 3: 2.0, 4: 2.5, 5: 2.5, 6: 9.0}


def lookup_case(spark, n):
    left = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 1500 + 1).alias("k"), "id").union(
        spark.createDataFrame([(None, -1)] * (n // 10), "k long, id long"))
    return left, spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def test_lookup_join_equals_a_plain_one(spark):
    left, right = lookup_case(spark, 6000)
    found = lookup.lookup_join(left, right, ["k"])
    assert found.columns == ["k", "id", "v"]
    assert sorted(map(str, found.collect())) == sorted(map(str, left.join(right, "k", "left").collect()))
    assert lookup.lookup_join(left.limit(0), right, ["k"]).count() == 0


def test_frequent_keys_stay_out_of_the_shuffle(spark):
    left, right = lookup_case(spark, 6000)
    often = left.select(F.array_contains(lookup.frequent_keys(left, ["k"]), F.xxhash64("k")).alias("often"), "k").distinct()
    assert {r["k"] for r in often.where("often").collect()} == {0, None}
    shuffled = left.where(~F.array_contains(lookup.frequent_keys(left, ["k"]), F.xxhash64("k")))
    assert shuffled.groupBy("k").count().agg(F.max("count")).first()[0] <= 6000 / lookup.FREQUENT_SHARE + 1


@pytest.mark.parametrize("n", [10, 60_000])
def test_lookup_plan_is_the_same_for_every_size(spark, n):
    left, right = spark.range(n).withColumn("k", F.col("id") % 7), lookup_case(spark, n)[1]
    plan = lookup.lookup_join(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    nodes = [line.strip(" :+-").split()[0] for line in plan.splitlines()]
    assert [node for node in nodes if node in ("Join", "Union")] == ["Union", "Join", "Join"]


def test_membership_counts_null_as_orphan(spark):
    child = spark.createDataFrame([(1,)] * 500 + [(2,), (9,), (None,)], "listing_id long")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    assert row_total(orphan_keys(child, "listing_id", parent, "id"), "n").first()["n"] == 2
    assert row_total(matched_keys(child, "listing_id", parent, "id"), "n").first()["n"] == 501


# ------------------------------------------------------------------ correlation

def test_spearman_equals_pandas_with_ties_and_nulls(spark):
    rng = np.random.default_rng(3)
    n = 2500
    pdf = pd.DataFrame({"a": rng.lognormal(size=n), "b": rng.integers(0, 4, n).astype(float)})
    pdf["c"] = np.where(rng.random(n) < 0.4, 0.0, pdf.a + rng.normal(size=n))
    pdf["d"] = 1.0
    for c, share in (("a", 0.1), ("c", 0.3)):
        pdf.loc[rng.random(n) < share, c] = np.nan
    want = pdf.corr(method="spearman")
    got = spearman_pairs(normalise_nan(spark.createDataFrame(pdf)), list("abcd")).collect()
    assert len(got) == 6
    for r in got:
        expected = want.loc[r["variable_a"], r["variable_b"]]
        if np.isnan(expected):
            assert r["rho"] is None
        else:
            assert r["rho"] == pytest.approx(expected, abs=1e-12)


def test_spearman_of_many_patterns_and_frequent_values(spark):
    """Columns that lack different rows, one value that most rows hold, a column that is nearly empty."""
    rng = np.random.default_rng(11)
    n = 4000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": rng.normal(size=n).round(1)})
    pdf.loc[rng.random(n) < 0.7, "a"] = 0.0
    pdf["d"] = pdf.a * 2 + pdf.b + rng.normal(size=n)
    for c, share in (("a", 0.2), ("b", 0.5), ("d", 0.05)):
        pdf.loc[rng.random(n) < share, c] = np.nan
    pdf["e"] = np.where(np.arange(n) < 3, pdf.c, np.nan)
    pdf["f"] = np.nan
    want = pdf.corr(method="spearman", min_periods=1)
    got = {(r["variable_a"], r["variable_b"]): (r["n"], r["rho"]) for r in
           spearman_pairs(spark.createDataFrame(pdf).repartition(7), list("abcdef")).collect()}
    for (x, y), (rows, rho) in got.items():
        assert rows == (pdf[x].notna() & pdf[y].notna()).sum()
        assert rho is None or rho == pytest.approx(want.loc[x, y], abs=1e-11)
    assert set(got) == {p for p in itertools.combinations("abcdef", 2) if (pdf[p[0]].notna() & pdf[p[1]].notna()).any()}


def test_rank_windows_hold_one_range_each(spark):
    """No row is repeated for the pairs of its columns, and no window holds a whole column."""
    width = 3
    rows = spark.range(5000).select(F.col("id").alias("_row"), *[(F.rand(i) * 1e6).alias(f"v{i}") for i in range(width)])
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        sizes = value_sizes(rows, width)
        assert sizes.agg(F.sum("n0")).first()[0] == width * 5000
        held = sizes.groupBy("column", "part").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset(setting)
    assert held <= 5000          # four ranges of 15,000 rows
    assert "Expand" not in sizes._jdf.queryExecution().toString()


# ------------------------------------------------------------------ counts

def test_distinct_counts_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2.0), (None, "b", 2.0)], "x int, y string, z double")
    counts = distinct_counts(df, ["x", "y", "z"])
    assert rows_of(counts) == [(1, 2, 1)] and counts.columns == ["x", "y", "z"]
    assert "Expand" not in counts._jdf.queryExecution().toString()
    assert rows_of(distinct_counts(df, ["y"])) == [(2,)]


def test_approximate_quantiles_keep_their_rank_error(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"m": rng.integers(0, 12, 60_000), "v": rng.lognormal(3, 2, 60_000)})
    pdf.loc[pdf.m == 3, "v"] = 7.0
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    months = sketches.quantile_sketches(spark.createDataFrame(pdf), ["v"], ["m"])
    assert months.count() == 12 and months.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    whole = sketches.sketch_quantiles(sketches.merge_sketches(months), probs).first()
    assert whole["n"] == 60_000
    ordered = np.sort(pdf.v.to_numpy())
    for p, q in zip(probs, whole["q"]):
        low, high = np.searchsorted(ordered, q, "left") / 60_000, np.searchsorted(ordered, q, "right") / 60_000
        assert low - 2 * sketches.RANK_ERROR <= p <= high + 2 * sketches.RANK_ERROR
    same = sketches.approximate_quantiles(spark.createDataFrame(pdf), ["v"], [0.1, 0.9], ["m"]).where("m = 3").first()
    assert same["q"] == [7.0, 7.0]


def test_counts_and_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "t string, k int")
    assert rows_of(value_counts(df, "t")) == [("a", 2), ("b", 1)]
    assert rows_of(value_shares(df, "t")) == [("a", 2 / 3), ("b", 1 / 3)]
    assert rows_of(top_values(df, "t", 1)) == [("a", 2)]
    assert rows_of(group_size_range(df, "k")) == [(1, 3)]
    assert group_count(df, ["t", "k"]).first()[0] == 3


def test_year_over_year_needs_the_year_before(spark):
    days = spark.createDataFrame([("2019-01-01",)] * 4 + [("2020-01-01",)] * 3 + [("2022-05-05",)]
                                 + [(None,)], "d string")
    years = per_year(days, F.to_date("d"))
    assert rows_of(years) == [(2019, 4), (2020, 3), (2022, 1)]
    assert rows_of(year_over_year(years)) == [(2019, 4, None), (2020, 3, -25.0), (2022, 1, None)]


def test_availability_rates(spark):
    days = spark.createDataFrame([("2026-07-06", "t"), ("2026-07-07", "f"), ("2026/08/03", "t"),
                                  ("bad", "t"), ("2026-07-06", None)], "date string, available string")
    months = dict(rows_of(availability_rates(days, "mes")))
    assert months == pytest.approx({"2026-07": 100 / 3, "2026-08": 100.0})
    weekdays = dict(rows_of(availability_rates(days, "dia_semana")))
    assert weekdays == pytest.approx({0: 200 / 3, 1: 0.0})
    assert availability_rates(days, "total").first()["pct"] == 60.0


# ------------------------------------------------------------------ columns, nulls

def test_columns_by_prefix_and_empty_columns(spark):
    df = spark.createDataFrame([(1, 2, "a", None, "u"), (2, 2, None, None, "u")],
                               "id int, host_id int, host_name string, vacio string, scrape_id string")
    assert by_prefix(df, ["host_"]) == ["host_id", "host_name"]
    assert host_columns(df) == ["host_name"]
    assert empty_columns(df) == ["vacio"]
    assert drop_empty_columns(df).columns == ["id", "host_id", "host_name"]
    assert drop_empty_columns(df.where("id > 5")).columns == ["id", "host_id", "host_name", "vacio"]


def test_null_reports(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string")
    assert rows_of(null_counts(df)) == [("a", 1), ("b", 2)]
    assert [r["columna"] for r in null_percentages(df).collect()] == ["b", "a"]
    assert null_cells(df).first()[0] == 3
    assert rows_of(structure(df)) == [(0, "a", "int", 2), (1, "b", "string", 1)]


# ------------------------------------------------------------------ hosts, nested cells

def test_split_hosts(spark):
    df = spark.createDataFrame(
        [(77, 501, "Second name", False, 8.5), (42, 501, "First name", False, 6.0),
         (90, 388, "Other", True, 7.25)],
        "id int, host_id int, host_name string, host_is_superhost boolean, price double")
    listings, hosts = split_hosts(df)
    assert listings.columns == ["id", "host_id", "price"]
    assert rows_of(hosts) == [(388, "Other", True), (501, "First name", False)]


def test_host_concentration(spark):
    df = spark.range(20).select(F.col("id"), F.when(F.col("id") < 12, 1).when(
        F.col("id") < 18, F.col("id")).alias("host_id"))
    row = host_concentration(df).first()
    assert tuple(row) == (7, 6, 12, 12, 6 / 7, 12 / 20)


def test_amenities(spark):
    kinds = ["Sauna", "Desk", "Iron", "Bike rack"]
    lists = {i: [kinds[k] for k in range(4) if i >> k & 1] for i in range(1, 16)}
    cells = [(i, json.dumps(names)) for i, names in lists.items()]
    df = spark.createDataFrame(cells + [(30, None), (31, '["  Desk", "", "Desk "]')],
                               "id long, amenities string")
    assert rows_of(add_amenity_count(df)) == [(i, len(n)) for i, n in lists.items()] + [(30, 0), (31, 2)]
    want = sorted((i, name) for i, names in lists.items() for name in names) + [(31, "Desk")]
    assert rows_of(amenity_pairs(df)) == want == rows_of(amenity_pairs(df, unique_ids=True))
    unique = amenity_pairs(df, unique_ids=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in unique
    bare = df.drop("amenities")
    assert add_amenity_count(bare).columns == ["id", "cantidad_amenities"]
    assert amenity_pairs(bare).count() == 0 and flatten_quote(bare).columns == ["id"]
