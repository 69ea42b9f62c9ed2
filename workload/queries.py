"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posada.audit import Audit, step_report, verification_report
from posada.fixed_values import (AVAILABILITY_EDGES, HOST_PREFIXES, LOOKUP_COLUMNS, PARTITION_COLUMNS,
                                 SHEET_MAX_CHARS)
from posada.functions import dates, documents, flags, numbers, text
from posada.operators import frequencies as freq
from posada.operators import nested, sketches
from posada.operators.columns import by_prefix, drop_empty_columns
from posada.operators.correlation import spearman_pairs
from posada.operators.dedup import duplicate_count, keep_first
from posada.operators.histograms import equal_width_bins, fixed_bins
from posada.operators.hosts import host_concentration, host_sizes, split_hosts
from posada.operators.impute import impute_group_median
from posada.operators.membership import matched_keys, orphan_keys, row_total
from posada.operators.nulls import null_cells, null_counts, null_percentages, shape, structure
from posada.operators.outliers import (between_quantiles, box_stats, iqr_outlier, threshold_counts,
                                       upper_outliers)
from posada.operators.quantiles import exact_quantiles
from posada.operators.summaries import (describe_numeric, describe_text, group_medians,
                                        percentile_list, price_metrics)
from posada.plans import calendar, listings, profile, reviews
from posada.plans.run import PREPARE, prepare_and_write
from posada.plans.calendar_update import update_calendar
from posada.sinks.tables import (export_extracts, publish, read_table, read_tables, truncate_texts, truncation_counts,
                                 verify_contents, write_table, write_tables)
from posada.sources.landing import land
from posada.sources.runlog import log_excerpt, parse_log
from posada.sources.store import Store, scan, union_batches
from posada.staging import Stage
from workload.views import full_listings, table, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CALENDAR_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "available",
                  "minimum_nights", "maximum_nights"]
RANKED = ["precio", "bedrooms", "bathrooms", "minimum_nights", "availability_365",
          "number_of_reviews", "reviews_per_month"]
PROBS = [0.01, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


def query(function: Query) -> Query:
    """Register under the function's name; a closing underscore only avoids a clash with an import."""
    QUERIES[function.__name__.removesuffix("_")] = function
    return function


def rounded(df: DataFrame, columns: list[str], decimals: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), decimals) for c in columns})


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L with its price text parsed."""
    return view(spark, sf_dir, "L").withColumn("precio", numbers.money(F.col("price")))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.clean_days(view(spark, sf_dir, "C"), CALENDAR_ORDER)


# ---------------------------------------------------------------- calendar

@query
def calendar_monthly(spark, sf_dir):
    return rounded(calendar.monthly(days(spark, sf_dir)),
                   ["minimo_noches_promedio", "tasa_no_disponible"])


@query
def calendar_weekly(spark, sf_dir):
    return rounded(calendar.weekly(days(spark, sf_dir)), ["pct_disponible"])


@query
def calendar_daily(spark, sf_dir):
    return calendar.daily(days(spark, sf_dir))


@query
def calendar_dedup_after_dates(spark, sf_dir):
    merged = calendar.clean_days(view(spark, sf_dir, "C"), CALENDAR_ORDER, dedup_after_dates=True)
    return rounded(calendar.monthly(merged), ["minimo_noches_promedio", "tasa_no_disponible"])


@query
def avail_by_month(spark, sf_dir):
    rates = freq.availability_rates(view(spark, sf_dir, "C"), "mes")
    return rates.withColumn("pct", F.bround("pct", 1))


@query
def avail_by_weekday(spark, sf_dir):
    rates = freq.availability_rates(view(spark, sf_dir, "C"), "dia_semana")
    return rates.withColumn("pct", F.bround("pct", 1))


@query
def avail_overall(spark, sf_dir):
    rates = freq.availability_rates(view(spark, sf_dir, "C"), "total")
    return rates.withColumn("pct", F.bround("pct", 1))


# ---------------------------------------------------------------- duplicates

@query
def dedup_keep_first(spark, sf_dir):
    first = keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return first.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


@query
def dup_key_count(spark, sf_dir):
    return duplicate_count(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dup_row_count(spark, sf_dir):
    return duplicate_count(view(spark, sf_dir, "C"))


@query
def dup_day_count(spark, sf_dir):
    """Days that repeat in everything but the columns that only serve as an order."""
    return duplicate_count(view(spark, sf_dir, "C").select(
        "listing_id", "date", "available", "minimum_nights", "maximum_nights"))


# ---------------------------------------------------------------- prices

@query
def price_normalize(spark, sf_dir):
    return priced(spark, sf_dir).select("id", "precio")


@query
def price_category(spark, sf_dir):
    return priced(spark, sf_dir).select("id", numbers.price_class(F.col("precio"))
                                        .alias("categoria_precio"))


@query
def price_category_counts(spark, sf_dir):
    df = priced(spark, sf_dir)
    classes = df.select(numbers.price_class(F.col("precio")).alias("categoria_precio"))
    return freq.value_counts(classes, "categoria_precio")


@query
def price_outliers(spark, sf_dir):
    # Squared prices are skewed enough for the fences to matter.
    df = priced(spark, sf_dir).select("id", (F.col("precio") * F.col("precio") / 1e5).alias("precio"))
    return df.select("id", iqr_outlier(df, "precio").alias("es_outlier_precio"))


@query
def price_outliers_upper(spark, sf_dir):
    df = priced(spark, sf_dir).select((F.col("precio") * F.col("precio") / 1e5).alias("precio"))
    return rounded(upper_outliers(df, "precio"), ["limite_iqr", "proporcion"], 4)


@query
def price_thresholds(spark, sf_dir):
    return threshold_counts(priced(spark, sf_dir), "precio",
                            {"mayor_100k": 1e5, "mayor_400k": 4e5, "mayor_1M": 1e6})


@query
def price_metrics_(spark, sf_dir):
    return rounded(price_metrics(priced(spark, sf_dir), "precio"),
                   ["mediana", "media", "q1", "q3", "p99", "max", "limite_iqr"])


@query
def price_between_p01_p99(spark, sf_dir):
    kept = between_quantiles(priced(spark, sf_dir), "precio", 0.01, 0.99)
    return kept.select("id", "precio",
                       F.round(numbers.log10_positive(F.col("precio")), 8).alias("log10_precio"))


# ---------------------------------------------------------------- text, flags, numbers

@query
def text_clean(spark, sf_dir):
    return view(spark, sf_dir, "R").select(
        "id", text.clean_text(F.col("comments")).alias("comments"),
        text.clean_text(F.col("reviewer_name")).alias("reviewer_name"))


@query
def text_title_case(spark, sf_dir):
    name = text.clean_text(F.col("neighbourhood_cleansed"))
    return view(spark, sf_dir, "L").select("id", text.title_case(name).alias("barrio"))


@query
def text_word_replace(spark, sf_dir):
    return view(spark, sf_dir, "L").select(
        "id", text.replace_word(F.col("host_location"), "Bogota", "Bogotá").alias("host_location"))


@query
def comment_length(spark, sf_dir):
    return view(spark, sf_dir, "R").select(
        "id", F.length(text.clean_text(F.col("comments"))).cast("long").alias("longitud"))


@query
def text_truncate(spark, sf_dir):
    return truncate_texts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), SHEET_MAX_CHARS)


@query
def text_truncate_counts(spark, sf_dir):
    return truncation_counts(table(spark, sf_dir, "documents"), SHEET_MAX_CHARS)


@query
def number_format_es(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", numbers.format_es(price).alias("entero"),
        numbers.format_es(price, 1).alias("un_decimal"), numbers.format_cop(price).alias("pesos"))


@query
def bool_from_tf(spark, sf_dir):
    return view(spark, sf_dir, "L").select(
        "id", flags.from_tf(F.col("host_is_superhost")).alias("host_is_superhost"),
        flags.from_tf(F.col("has_availability")).alias("has_availability"))


@query
def has_availability_fill(spark, sf_dir):
    df = listings.convert_flags(view(spark, sf_dir, "L"))
    return listings.fill_defaults(df).select("id", "has_availability")


@query
def baths_from_text(spark, sf_dir):
    return listings.convert_bathrooms(view(spark, sf_dir, "L")).select("id", "bathrooms",
                                                                       "bano_compartido")


@query
def license_text(spark, sf_dir):
    return listings.fill_defaults(view(spark, sf_dir, "L").select("id", "license"))


@query
def quality_flags(spark, sf_dir):
    df = listings.fill_defaults(priced(spark, sf_dir).drop("price"))
    return listings.quality_flags(df).select(
        "id", "tiene_reviews", "tiene_licencia", "es_estancia_larga", "sin_disponibilidad_anual")


@query
def text_defaults(spark, sf_dir):
    return listings.fill_defaults(
        view(spark, sf_dir, "L").select("id", "description", "host_location"))


@query
def reviews_per_month_fill(spark, sf_dir):
    df = view(spark, sf_dir, "L").select("id", "reviews_per_month")
    return rounded(listings.fill_defaults(df), ["reviews_per_month"])


# ---------------------------------------------------------------- dates

@query
def dates_standardize(spark, sf_dir):
    return listings.standardise_dates(view(spark, sf_dir, "L")).select("id", "last_scraped")


@query
def dates_all_forms(spark, sf_dir):
    """Every accepted way to write a date."""
    return view(spark, sf_dir, "V").select("id", dates.iso_text(dates.parse_date(F.col("escrita"))).alias("fecha"))


@query
def date_parts(spark, sf_dir):
    date = dates.parse_date(F.col("last_scraped"))
    parts = view(spark, sf_dir, "L").select("id", date.alias("fecha"))
    return parts.withColumns(dates.date_parts(F.col("fecha"))).withColumns({
        "fecha": dates.iso_text(F.col("fecha")), "anio_iso": dates.iso_year(F.col("fecha")),
        "semana_iso": dates.iso_week(F.col("fecha"))})


@query
def date_period(spark, sf_dir):
    periods = view(spark, sf_dir, "C").select(
        "listing_id", dates.year_month(dates.parse_date(F.col("date"))).alias("mes"))
    return periods.groupBy("listing_id", "mes").agg(F.count("mes").alias("n")).where("n > 0")


@query
def quote_nights(spark, sf_dir):
    return nested.flatten_quote(view(spark, sf_dir, "Q")).select("id", "cotizacion_noches")


# ---------------------------------------------------------------- missing values, columns

@query
def impute_median_by_group(spark, sf_dir):
    columns = ["bedrooms", "bathrooms", "minimum_nights"]
    df = view(spark, sf_dir, "L").select("id", "room_type", *columns)
    return impute_group_median(df, columns, "room_type", Stage(spark))


@query
def null_pct(spark, sf_dir):
    return null_percentages(view(spark, sf_dir, "L"))


@query
def null_counts_(spark, sf_dir):
    return null_counts(view(spark, sf_dir, "R"))


@query
def null_cells_(spark, sf_dir):
    return null_cells(view(spark, sf_dir, "L"))


@query
def drop_empty_columns_(spark, sf_dir):
    return drop_empty_columns(view(spark, sf_dir, "L"), ["picture_url"])


@query
def select_by_prefix(spark, sf_dir):
    df = view(spark, sf_dir, "L")
    return df.select("id", "host_id", *by_prefix(df, HOST_PREFIXES, excluded=("host_id",)))


# ---------------------------------------------------------------- nested cells

@query
def amenities_long(spark, sf_dir):
    return nested.amenity_pairs(view(spark, sf_dir, "A"))


@query
def amenities_count(spark, sf_dir):
    return nested.add_amenity_count(view(spark, sf_dir, "A"))


@query
def amenities_broken(spark, sf_dir):
    broken = documents.is_broken_list(F.col("amenities"))
    return view(spark, sf_dir, "A").agg(F.count_if(broken).alias("ilegibles"))


@query
def amenities_top20(spark, sf_dir):
    return rounded(profile.amenity_frequency(view(spark, sf_dir, "A")), ["pct"])


@query
def amenities_top20_raw(spark, sf_dir):
    return rounded(profile.amenity_frequency(view(spark, sf_dir, "A"), raw=True), ["pct"])


@query
def amenity_list_stats(spark, sf_dir):
    return profile.amenity_list_stats(view(spark, sf_dir, "A"))


@query
def quote_flatten(spark, sf_dir):
    return nested.flatten_quote(view(spark, sf_dir, "Q"))


@query
def quote_sample(spark, sf_dir):
    first = freq.first_rows(view(spark, sf_dir, "Q").where("price_quote_raw IS NOT NULL"), ["id"], 1)
    return first.select("id", documents.nested_sample(F.col("price_quote_raw"), "$.quote", 700)
                        .alias("muestra"))


@query
def documents_json(spark, sf_dir):
    columns = ["id", "room_type", "host_location", "availability_365"]
    return view(spark, sf_dir, "L").select("id", documents.as_document(columns).alias("documento"))


# ---------------------------------------------------------------- hosts

@query
def hosts_dimension(spark, sf_dir):
    return split_hosts(view(spark, sf_dir, "L"))[1]


@query
def listings_without_hosts(spark, sf_dir):
    return split_hosts(view(spark, sf_dir, "L"))[0]


@query
def host_concentration_(spark, sf_dir):
    return rounded(host_concentration(view(spark, sf_dir, "L")),
                   ["proporcion_con_uno", "proporcion_grandes"])


@query
def host_top5(spark, sf_dir):
    return host_sizes(view(spark, sf_dir, "L")).orderBy(F.desc("alojamientos"), "host_id").limit(5)


# ---------------------------------------------------------------- reviews

@query
def reviews_clean(spark, sf_dir):
    return reviews.review_table(view(spark, sf_dir, "R"))


@query
def reviews_by_year(spark, sf_dir):
    return freq.per_year(view(spark, sf_dir, "R"), dates.parse_date(F.col("date")))


@query
def reviews_yoy(spark, sf_dir):
    years = freq.per_year(table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date"))
    return rounded(freq.year_over_year(years), ["cambio_pct"])


@query
def orphan_reviews(spark, sf_dir):
    return orphan_keys(table(spark, sf_dir, "documents"), "doc_id",
                       table(spark, sf_dir, "labels"), "doc_id")


@query
def matched_reviews(spark, sf_dir):
    return matched_keys(table(spark, sf_dir, "lineitem"), "l_orderkey",
                        table(spark, sf_dir, "orders"), "o_orderkey")


# ---------------------------------------------------------------- summaries

@query
def describe_numeric_(spark, sf_dir):
    summary = describe_numeric(priced(spark, sf_dir), ["precio", "bedrooms", "minimum_nights",
                                                       "availability_365", "reviews_per_month"])
    return rounded(summary, ["mean", "std", "min", "max", "p25", "p50", "p75"], 4)


@query
def describe_text_(spark, sf_dir):
    return describe_text(view(spark, sf_dir, "L"), ["room_type", "host_location",
                                                    "neighbourhood_cleansed", "bathrooms_text"])


@query
def percentile_list_(spark, sf_dir):
    return rounded(percentile_list(priced(spark, sf_dir), "precio", PROBS), ["valor"], 4)


@query
def quantiles_by_group(spark, sf_dir):
    rows = exact_quantiles(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"],
                           [0.1, 0.5, 0.9], ["l_returnflag"])
    return rows.select("l_returnflag", "columna", "n",
                       *[F.round(F.col("q")[i], 4).alias(f"p{p}")
                         for i, p in enumerate((10, 50, 90))])


@query
def quantiles_narrow_range(spark, sf_dir):
    """A column whose values all lie close together, whole and by group."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice").cast("double") / 2e6 - 74.1).alias("x"))
    found = [exact_quantiles(rows, ["x"], [0.1, 0.5, 0.9]).withColumn("l_returnflag", F.lit("all")),
             exact_quantiles(rows, ["x"], [0.1, 0.5, 0.9], ["l_returnflag"])]
    return found[0].unionByName(found[1]).select(
        "l_returnflag", "n", *[F.round(F.col("q")[i], 6).alias(f"p{p}")
                               for i, p in enumerate((10, 50, 90))])


@query
def value_counts(spark, sf_dir):
    return freq.value_counts(view(spark, sf_dir, "L"), "room_type")


@query
def value_shares(spark, sf_dir):
    return rounded(freq.value_shares(view(spark, sf_dir, "C"), "available"), ["proporcion"])


@query
def distinct_counts(spark, sf_dir):
    return freq.distinct_counts(view(spark, sf_dir, "L"), ["host_id", "room_type", "host_location"])


@query
def date_range(spark, sf_dir):
    return freq.value_range(view(spark, sf_dir, "C"), "date")


@query
def group_size_range(spark, sf_dir):
    return freq.group_size_range(view(spark, sf_dir, "C"), "listing_id")


@query
def group_count(spark, sf_dir):
    month = dates.year_month(dates.parse_date(F.col("date")))
    return freq.group_count(view(spark, sf_dir, "C"), ["listing_id", month])


@query
def bins_fixed(spark, sf_dir):
    return fixed_bins(view(spark, sf_dir, "L"), "availability_365", AVAILABILITY_EDGES)


@query
def hist_log_price(spark, sf_dir):
    df = priced(spark, sf_dir)
    return rounded(equal_width_bins(df, numbers.log10_positive(F.col("precio")), 60), ["desde"])


@query
def hist_availability(spark, sf_dir):
    return rounded(equal_width_bins(view(spark, sf_dir, "L"), F.col("availability_365"), 37),
                   ["desde"])


@query
def box_stats_overall(spark, sf_dir):
    df = priced(spark, sf_dir).select((F.col("precio") * F.col("precio") / 1e5).alias("precio"))
    return rounded(box_stats(df, "precio"),
                   ["q1", "mediana", "q3", "bigote_inferior", "bigote_superior"], 3)


@query
def box_stats_by_group(spark, sf_dir):
    df = priced(spark, sf_dir).select("room_type",
                                      (F.col("precio") * F.col("precio") / 1e5).alias("precio"))
    return rounded(box_stats(df, "precio", ["room_type"], stage=Stage(spark)),
                   ["q1", "mediana", "q3", "bigote_inferior", "bigote_superior"], 3)


@query
def median_by_type(spark, sf_dir):
    return rounded(group_medians(priced(spark, sf_dir), "precio", "room_type"), ["mediana"], 4)


@query
def median_by_area_having(spark, sf_dir):
    return rounded(group_medians(priced(spark, sf_dir), "precio", "neighbourhood_cleansed", 50),
                   ["mediana"], 4)


@query
def min_nights_modes(spark, sf_dir):
    return profile.night_modes(view(spark, sf_dir, "L"))


@query
def share_ratios(spark, sf_dir):
    sizes = freq.value_counts(view(spark, sf_dir, "L"), "room_type")
    rows = view(spark, sf_dir, "L").agg(F.count(F.lit(1))).scalar()
    return sizes.select("room_type", F.bround(numbers.share(F.col("n"), rows) * 100, 1).alias("pct"))


@query
def spearman_matrix(spark, sf_dir):
    rho = F.when(F.abs("rho") < 5e-7, 0.0).otherwise(F.round("rho", 6))  # no negative zero
    return spearman_pairs(priced(spark, sf_dir), RANKED).withColumn("rho", rho)


# ---------------------------------------------------------------- rows

@query
def top5_price(spark, sf_dir):
    return freq.largest(priced(spark, sf_dir), "precio", 5, "id").select("id", "room_type", "precio")


@query
def head_rows(spark, sf_dir):
    return freq.first_rows(view(spark, sf_dir, "L").select("id", "host_id", "price", "room_type"),
                           ["id"], 25)


@query
def text_match_counts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return freq.text_matches(pages, "html", {"con_br": text.holds(F.col("html"), "<br"),
                                             "con_tabla": text.holds(F.col("html"), "<table"),
                                             "exacto": F.col("html") == "<html></html>"})


@query
def host_location_top(spark, sf_dir):
    return freq.top_values(view(spark, sf_dir, "L"), "host_location", 6)


@query
def first_match_sample(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return freq.first_match(pages, text.holds(F.col("html"), "<br"), ["page_id"], "html", 200)


@query
def union_batches_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date").cast("string"))
    return union_batches([orders.where("o_orderkey % 2 = 0"),
                          orders.where("o_orderkey % 2 = 1").drop("o_orderpriority")])


@query
def scan_filter_project(spark, sf_dir):
    return scan(table(spark, sf_dir, "events"),
                {"event_type": {"$in": ["click", "purchase"]}, "value": {"$gte": 10.0}},
                {"event_id": 1, "event_type": 1, "value": 1})


@query
def scan_not_equal(spark, sf_dir):
    return scan(table(spark, sf_dir, "events"), {"event_type": {"$ne": "view"}, "user_id": {"$lt": 40}},
                {"ts": 0, "props": 0})


@query
def list_collections(spark, sf_dir):
    """Every collection of the folder with its rows."""
    store = Store(spark, sf_dir)
    return union_batches([shape(store.table(name), name).select(F.col("tabla").alias("coleccion"), "filas") for name in store.names()])


# ---------------------------------------------------------------- sources, sinks, audit

@query
def land_csv_roundtrip(spark, sf_dir):
    stage = Stage(spark)
    source = stage.path("part_csv")
    table(spark, sf_dir, "part").write.csv(source, header=True, escape='"')
    land(spark, source, stage.path("landed"), ["p_partkey"])
    return spark.read.parquet(stage.path("landed"))


@query
def load_verify(spark, sf_dir):
    stage = Stage(spark)
    tables = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")}
    groups = {n: [n] for n in tables}
    report = publish(spark, tables, stage.path("tables"))
    exported = export_extracts(tables, stage.path("extracts"), groups)
    extracted = spark.createDataFrame([(n,) for n in exported], "tabla string")
    return report.drop("exportado").join(
        F.broadcast(extracted.withColumn("en_extracto", F.lit(True))), "tabla", "left").withColumn(
        "en_extracto", flags.certainly(F.col("en_extracto")))


@query
def export_extracts_(spark, sf_dir):
    stage = Stage(spark)
    lines = table(spark, sf_dir, "lineitem") \
        .withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))
    exported = export_extracts({"lineitem": lines}, stage.path("extracts"), {"todo": ["lineitem"]}, max_rows=1000)
    return spark.read.schema(lines.schema).csv(exported["lineitem"], header=True, escape='"')


@query
def land_large_ids(spark, sf_dir):
    """Keys of 19 digits that differ in their last digits only, from a compressed file."""
    stage = Stage(spark)
    source = stage.path("orders_csv")
    table(spark, sf_dir, "orders").withColumn("o_orderkey", F.lit(1012345678900000000) + F.col("o_orderkey")) \
        .withColumn("o_orderdate", F.col("o_orderdate").cast("date")) \
        .write.csv(source, header=True, escape='"', compression="gzip")
    land(spark, source, stage.path("landed"), ["o_orderkey"])
    return spark.read.parquet(stage.path("landed"))


@query
def structure_report(spark, sf_dir):
    return structure(view(spark, sf_dir, "C"))


@query
def table_shapes(spark, sf_dir):
    shapes = [shape(table(spark, sf_dir, n), n) for n in ("orders", "lineitem", "customer")]
    return union_batches(shapes)


def calendar_audit(spark, sf_dir):
    raw, audit = view(spark, sf_dir, "C"), Audit()
    days, seen = Stage(spark).put_measured(calendar.clean_days(raw, CALENDAR_ORDER), "days", calendar.day_measures())
    calendar.audit_calendar(audit, raw.count(), seen, calendar.monthly(days).count(), calendar.weekly(days).count())
    return audit


def listings_audit(spark, sf_dir):
    raw, audit = full_listings(spark, sf_dir), Audit()
    stage = Stage(spark)
    unique = listings.unique_listings(raw)
    unique, held = stage.put_measured(unique, "unique", listings.unique_measures(unique))
    measured = listings.measured_listings(unique, stage, held)
    clean, seen = stage.put_measured(measured, "clean", listings.measures(measured), listings.carried(measured))
    tables = listings.listing_tables(clean)
    pairs = tables["listing_amenities"]
    listings.audit_listings(audit, raw.count(), held, clean.columns, seen, tables["hosts"].count(), pairs.count(),
                            freq.distinct_counts(pairs, ["amenity"]).first()[0])
    return audit


def reviews_audit(spark, sf_dir):
    """Reviews, some of them twice, of listings of which every seventh is unknown."""
    raw, audit = view(spark, sf_dir, "R"), Audit()
    raw = raw.unionByName(raw.where("id % 11 = 0"))
    unique, seen = Stage(spark).put_measured(reviews.dated(reviews.unique_reviews(raw)), "unique", reviews.unique_measures())
    table_ = reviews.enrich(reviews.commented(unique))
    known = raw.where("listing_id % 7 > 0").select(F.col("listing_id").alias("id"))
    orphans = row_total(orphan_keys(table_, "listing_id", known, "id"), "n").first()["n"]
    reviews.audit_reviews(audit, raw.count(), seen, orphans)
    return audit


@query
def step_audit(spark, sf_dir):
    return calendar_audit(spark, sf_dir).step_table(spark)


@query
def step_audit_listings(spark, sf_dir):
    return listings_audit(spark, sf_dir).step_table(spark)


@query
def step_audit_reviews(spark, sf_dir):
    return reviews_audit(spark, sf_dir).step_table(spark)


@query
def dq_listings(spark, sf_dir):
    return listings_audit(spark, sf_dir).finding_table(spark)


@query
def dq_reviews(spark, sf_dir):
    return reviews_audit(spark, sf_dir).finding_table(spark)


@query
def step_report_(spark, sf_dir):
    return step_report(calendar_audit(spark, sf_dir).step_table(spark))


@query
def verification_report_(spark, sf_dir):
    stage = Stage(spark)
    tables = {n: table(spark, sf_dir, n) for n in ("part", "supplier", "region")}
    return verification_report(publish(spark, tables, stage.path("tables")))


@query
def dq_warnings(spark, sf_dir):
    return calendar.calendar_findings(view(spark, sf_dir, "C"), days(spark, sf_dir))


@query
def log_parse(spark, sf_dir):
    return parse_log(view(spark, sf_dir, "G"))


@query
def log_excerpt_(spark, sf_dir):
    return log_excerpt(view(spark, sf_dir, "G"))


# ---------------------------------------------------------------- whole tables

@query
def listings_full(spark, sf_dir):
    stage = Stage(spark)
    unique = stage.put(listings.unique_listings(full_listings(spark, sf_dir)), "unique")
    tables = listings.listing_tables(listings.clean_listings(unique, stage))
    return rounded(tables["listings"], ["reviews_per_month"])


@query
def listings_hosts(spark, sf_dir):
    stage = Stage(spark)
    unique = stage.put(listings.unique_listings(full_listings(spark, sf_dir)), "unique")
    return listings.host_table(unique)


def written_tables(spark, sf_dir):
    """The seven tables as a run writes them, with the digests of their content, and their folder."""
    raw = {"listings": full_listings(spark, sf_dir), "reviews": view(spark, sf_dir, "R"),
           "calendar": view(spark, sf_dir, "C")}
    stage = Stage(spark)
    prepared, written = prepare_and_write(raw, stage, stage.path("out"), {"calendar": CALENDAR_ORDER})
    return prepared.tables, written, stage.path("out")


@query
def run_all_tables(spark, sf_dir):
    tables, _, root = written_tables(spark, sf_dir)
    return union_batches([shape(df, name) for name, df in read_tables(spark, root, tables).items()])


@query
def run_contents(spark, sf_dir):
    """Whether what is read back is what was written, cell by cell, and how many rows that are."""
    tables, written, root = written_tables(spark, sf_dir)
    rows = union_batches([shape(df, name) for name, df in read_tables(spark, root, tables).items()])
    return verify_contents(spark, written, root).select("tabla", "igual").join(rows, "tabla")


def stored(source, name, *decimals):
    """Content of one table, read back from where a run has written it."""
    def run(spark, sf_dir):
        stage = Stage(spark)
        raw = full_listings(spark, sf_dir) if source == "listings" else view(spark, sf_dir, source[0].upper())
        prepared = PREPARE[source](raw, stage, CALENDAR_ORDER if source == "calendar" else None)
        made = prepared.tables[name]
        write_tables({name: made}, stage.path("out"), in_layout=set(prepared.layout))
        return rounded(read_table(spark, stage.path(f"out/{name}"), made.schema), list(decimals))
    run.__name__ = f"run_{name}"
    return query(run)


stored("listings", "listings", "reviews_per_month")
stored("listings", "hosts")
stored("listings", "listing_amenities")
stored("reviews", "reviews")
stored("calendar", "calendar")
stored("calendar", "calendar_mensual", "minimo_noches_promedio", "tasa_no_disponible")
stored("calendar", "calendar_semanal", "pct_disponible")


@query
def calendar_updated(spark, sf_dir):
    """The monthly table after a second batch with days of some months of the first."""
    stage = Stage(spark)
    raw = view(spark, sf_dir, "C")
    late = F.coalesce((F.col("l_orderkey") % 3 == 0) & F.col("date").rlike("^1996.0[56]"), F.lit(False))
    for batch in (raw.where(~late), raw.where(late)):
        update_calendar(spark, batch, stage.path("out"), stage.path("raw"), CALENDAR_ORDER)
    schema = calendar.monthly(calendar.clean_days(raw, CALENDAR_ORDER)).schema
    return rounded(read_table(spark, stage.path("out/calendar_mensual"), schema),
                   ["minimo_noches_promedio", "tasa_no_disponible"])


@query
def calendar_one_month(spark, sf_dir):
    """One month of the written daily table: only its folder is read."""
    stage = Stage(spark)
    days_ = days(spark, sf_dir)
    daily = calendar.daily(days_)
    write_table(daily, stage.path("calendar"), LOOKUP_COLUMNS["calendar"], PARTITION_COLUMNS["calendar"])
    return read_table(spark, stage.path("calendar"), daily.schema).where("anio = 1996 AND mes = 5")


@query
def union_widened(spark, sf_dir):
    """Batches in which a column has different types: keys as text and number, quantities whole and real."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    whole = lines.where("l_linenumber % 2 = 0").withColumns({
        "l_quantity": F.col("l_quantity").cast("long"), "l_linenumber": F.col("l_linenumber").cast("short")})
    text_ = lines.where("l_linenumber % 2 = 1").withColumn("l_orderkey", F.concat(F.lit("k"), F.col("l_orderkey").cast("string")))
    return union_batches([whole, text_])


@query
def quantiles_approximate(spark, sf_dir):
    """Quantiles from merged sketches: whether their rank lies within the stated error of the one asked for."""
    probs = [0.1, 0.5, 0.9]
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("double").alias("v"))
    fine = sketches.quantile_sketches(lines, ["v"], ["l_returnflag", "l_linestatus"])
    found = sketches.sketch_quantiles(sketches.merge_sketches(fine, ["l_returnflag"]), probs)
    near = [F.count_if(F.col("v") <= F.col("q")[i]) / F.count(F.lit(1)) for i in range(len(probs))]
    below = [F.count_if(F.col("v") < F.col("q")[i]) / F.count(F.lit(1)) for i in range(len(probs))]
    slack = 2 * sketches.RANK_ERROR
    return lines.join(F.broadcast(found.select("l_returnflag", "q")), "l_returnflag").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), *[((low - slack <= p) & (high + slack >= p)).alias(f"dentro_p{p * 100:g}")
                                        for p, low, high in zip(probs, below, near)])


@query
def map_points(spark, sf_dir):
    """Points of the price map: coordinates and log price of the rows between two quantiles."""
    kept = between_quantiles(view(spark, sf_dir, "M"), "precio", 0.01, 0.99)
    return rounded(profile.map_points(kept), ["log10_precio"], 8)


def profiled(spark, sf_dir, source):
    raw = full_listings(spark, sf_dir) if source == "listings" else view(spark, sf_dir, source[0].upper())
    return profile.profile({source: raw})


def record_values(metrics, names, decimals=4):
    """metrica, campo, valor: every field of one-row metrics."""
    rows = [df.select(F.lit(name).alias("metrica"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("campo"), F.round(F.col(c).cast("double"), decimals).alias("valor")) for c in df.columns])))
        for name, df in ((n, metrics[n]) for n in names)]
    return union_batches(rows)


@query
def profile_listings(spark, sf_dir):
    """The records of prices, minimum stays, hosts and amenity lists, out of one read of the listings."""
    return record_values(profiled(spark, sf_dir, "listings"),
                         ["precio", "minimum_nights", "hosts", "amenities_listas", "listings_id_duplicados", "precio_umbrales"])


@query
def profile_listing_groups(spark, sf_dir):
    """Median price and number of priced listings by room type and area."""
    metrics = profiled(spark, sf_dir, "listings")
    by_type = metrics["room_type_mediana"].withColumnRenamed("room_type", "grupo")
    by_area = metrics["localidades"].withColumnRenamed("neighbourhood_cleansed", "grupo")
    return rounded(union_batches([by_type, by_area]), ["mediana"], 4)


@query
def profile_reviews(spark, sf_dir):
    return rounded(profiled(spark, sf_dir, "reviews")["reviews_resumen"], ["mean", "std", "min", "max", "p25", "p50", "p75"], 4)


@query
def profile_calendar(spark, sf_dir):
    """Availability by month, by weekday and overall."""
    metrics = profiled(spark, sf_dir, "calendar")
    return rounded(union_batches([
        metrics["disponibilidad_mensual"].select(F.lit("mes").alias("por"), F.col("mes").alias("valor"), "pct"),
        metrics["disponibilidad_dia_semana"].select(F.lit("dia_semana").alias("por"), F.col("dia_semana").cast("string").alias("valor"), "pct"),
        metrics["disponibilidad_global"].select(F.lit("total").alias("por"), F.lit(None).cast("string").alias("valor"), "pct")]),
        ["pct"])
