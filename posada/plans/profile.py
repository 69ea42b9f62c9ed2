"""Exploratory metrics of the raw tables, one small DataFrame per metric."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from posada.fixed_values import AVAILABILITY_EDGES, CORRELATED_COLUMNS
from posada.functions.dates import parse_date, year_month
from posada.functions.documents import raw_list
from posada.functions.flags import certainly
from posada.functions.numbers import log10_positive, money
from posada.functions.text import holds
from posada.operators import counted
from posada.operators import frequencies as freq
from posada.operators.columns import is_numeric, present
from posada.operators.correlation import spearman_pairs
from posada.operators.dedup import duplicate_count
from posada.operators.nested import amenity_pairs
from posada.operators.outliers import between_quantiles
from posada.operators.quantiles import exact_quantiles
from posada.plans.listings import normalise_prices
from posada.staging import Stage

PRICE_PROBS = [0.01, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


def amenity_frequency(listings: DataFrame, k: int = 20, raw: bool = False) -> DataFrame:
    """amenity, n, pct of all listings, the k most frequent."""
    total = listings.agg(F.count(F.lit(1))).scalar()
    counts = (amenity_pairs(listings, raw=raw).groupBy("amenity")
              .agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.desc("n"), "amenity").limit(k)
    return top.select("amenity", "n", (F.col("n") * 100 / total).alias("pct"))


def amenity_list_stats(listings: DataFrame) -> DataFrame:
    """Median and maximum list length and number of distinct elements (elements as they stand)."""
    sizes = listings.select(F.size(raw_list(F.col("amenities"))).alias("largo"))
    median = exact_quantiles(sizes, ["largo"], [0.5]).select(F.max(F.col("q")[0])).scalar()
    distinct = (listings.select(F.explode(raw_list(F.col("amenities"))).alias("a"))
                .agg(F.count_distinct("a")).scalar())
    return sizes.agg(F.max("largo").cast("long").alias("maximo")).select(
        median.alias("mediana"), "maximo", distinct.alias("distintas"))


def night_modes(listings: DataFrame) -> DataFrame:
    """Listings with a minimum stay of 1, 2 and 30 nights, and the longest minimum stay."""
    nights = F.col("minimum_nights")
    return listings.agg(*[F.count_if(nights == n).alias(f"noches_{n}") for n in (1, 2, 30)],
                        F.max(nights.cast("double")).alias("max"))


def map_points(priced: DataFrame) -> DataFrame:
    """longitude, latitude, log10_precio"""
    return priced.select("longitude", "latitude", log10_positive(F.col("precio")).alias("log10_precio"))


@dataclass
class Counted:
    """What the metrics of a raw table are made from: one read of it has written the narrow table and taken
    the aggregates `held`, and one read of that has counted its values."""

    name: str
    schema: StructType
    held: dict
    narrow: DataFrame
    counts: DataFrame

    @property
    def rows(self) -> int:
        return self.held["_rows"]

    def has(self, *columns: str) -> bool:
        return set(columns) <= set(self.narrow.columns)


_PRINT = ["_huella_1", "_huella_2"]


def count_table(raw: DataFrame, name: str, columns: dict[str, Column], entries: list[Column],
                lists: dict[str, Column], extra: dict[str, Column], stage: Stage) -> Counted:
    """columns: the narrow table; entries and lists: what is counted of it; extra: further aggregates
    over the raw table. Rows are fingerprinted by 128 bits, nulls included, to find whole rows that repeat."""
    nulls = [F.col(c).isNull() for c in raw.columns]
    prints = {c: F.xxhash64(F.lit(i), *raw.columns, *nulls) for i, c in enumerate(_PRINT)}
    measures = {"_rows": F.count(F.lit(1)), **{c: F.count(c) for c in raw.columns}, **extra}
    # The aggregates sit below the projection, in the same single read of the raw table.
    seen = Observation()
    measured = raw.observe(seen, *[c.alias(n) for n, c in measures.items()])
    narrow = stage.put(measured.select(*[c.alias(n) for n, c in {**columns, **prints}.items()]), f"narrow_{name}")
    counts = stage.put(counted.count_values(narrow, entries, lists), f"counts_{name}")
    return Counted(name, raw.schema, seen.get, narrow, counts)


def profile(tables: dict[str, DataFrame], stage: Stage | None = None) -> dict[str, DataFrame]:
    """Every metric that the columns of the given raw tables allow.

    A raw table is read once. Metrics are lazy and read the counted values, except the few that need
    rows (largest prices, map points, correlations, repeated rows and keys), which read the narrow table. Both lie
    in `stage`, which must stay open while metrics are read; without one they stay in the staging folder.
    """
    made = {"listings": _listing_metrics, "reviews": _review_metrics, "calendar": _calendar_metrics}
    metrics: dict[str, DataFrame] = {}
    for name, raw in tables.items():
        metrics |= made[name](raw, stage or Stage(raw.sparkSession))
    return metrics


def write_profile(metrics: dict[str, DataFrame], root: str) -> None:
    """One folder of JSON lines per metric."""
    for name, df in metrics.items():
        df.write.mode("overwrite").json(f"{root.rstrip('/')}/{name}")


def _general_metrics(table: Counted, spark: SparkSession, null_share: bool) -> dict[str, DataFrame]:
    held, rows = table.held, table.rows
    names = [f.name for f in table.schema.fields]
    shares = sorted(((100 * (rows - held[c]) / rows, c) for c in names if rows and held[c] < rows),
                    key=lambda x: (-x[0], x[1]))
    nulls = {f"nulos_{table.name}_pct": spark.createDataFrame([(c, s) for s, c in shares], "columna string, pct double")
             .select("columna", F.bround("pct", 2).alias("pct"))} if null_share else \
        {f"{table.name}_nulos": spark.createDataFrame([(c, rows - held[c]) for c in names], "columna string, nulos long")}
    return {
        f"{table.name}_forma": spark.createDataFrame([(table.name, rows, len(names))], "tabla string, filas long, columnas long"),
        f"{table.name}_estructura": spark.createDataFrame(
            [(i, f.name, f.dataType.simpleString(), held[f.name]) for i, f in enumerate(table.schema.fields)],
            "orden long, columna string, tipo string, no_nulos long"),
        f"{table.name}_filas_duplicadas": duplicate_count(table.narrow, _PRINT), **nulls}


def _listing_metrics(raw: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    df = normalise_prices(raw, ["price"]).withColumnRenamed("price", "precio") if "price" in raw.columns else raw
    numbers = present(df, ["precio", "minimum_nights", "availability_365"])
    keys = present(df, ["host_id", "host_location", "room_type", "neighbourhood_cleansed", "host_is_superhost"])
    groups = present(df, ["room_type", "neighbourhood_cleansed"]) if "precio" in numbers else []
    correlated = present(df, CORRELATED_COLUMNS)
    wanted = [*numbers, *keys, *correlated, *present(df, ["id", "name", "accommodates", "longitude", "latitude", "amenities"])]
    parsed = {c: (money(F.col("price")) if not is_numeric(raw, "price") else F.col("price").cast("double"))
              if c == "precio" else F.col(c) for c in dict.fromkeys(wanted)}
    lists = {"amenity": raw_list(F.col("amenities"))} if "amenities" in wanted else {}
    entries = [*[counted.number(c, F.col(c)) for c in numbers], *[counted.key(c, F.col(c)) for c in keys],
               *[counted.number(f"precio por {c}", F.col("precio"), F.col(c)) for c in groups],
               *[counted.number("largo", F.size(items)) for items in lists.values()]]
    table = count_table(raw, "listings", parsed, entries, lists, {}, stage)
    counts, narrow, rows = table.counts, table.narrow, table.rows
    metrics = _general_metrics(table, raw.sparkSession, null_share=True)
    if table.has("id"):
        metrics["listings_id_duplicados"] = duplicate_count(narrow, ["id"])
    if "precio" in numbers:
        prices = counted.numbers(counts, "precio")
        metrics |= {
            "precio": counted.metrics_of_price(prices, rows),
            "precio_percentiles": counted.quantiles(prices, PRICE_PROBS).select(F.inline(F.arrays_zip(
                F.array(*[F.lit(p) for p in PRICE_PROBS]).alias("prob"), F.col("q").alias("valor")))).toDF("prob", "valor"),
            "precio_resumen": counted.describe(counts, ["precio"]),
            "precio_atipicos": counted.upper_outliers(prices, rows),
            "precio_umbrales": prices.agg(*[counted.rows_where(F.col("v") > limit).alias(name) for name, limit in
                                            (("mayor_1M", 1e6), ("mayor_10M", 1e7))]),
            "precio_mayores": freq.largest(narrow, "precio", 5, "id").select(
                *present(narrow, ["id", "name", "room_type", "accommodates", "precio"])),
            "precio_histograma": counted.equal_width_bins(prices, log10_positive(F.col("v")), 60),
            "precio_caja": counted.box_stats(prices),
        }
    if table.has("precio", "longitude", "latitude"):
        metrics["mapa_precio"] = map_points(between_quantiles(narrow, "precio", 0.01, 0.99))
    if "minimum_nights" in numbers:
        nights = counted.numbers(counts, "minimum_nights")
        kind = raw.schema["minimum_nights"].dataType
        metrics |= {
            "minimum_nights": nights.agg(*[counted.rows_where(F.col("v") == n).alias(f"noches_{n}") for n in (1, 2, 30)],
                                         F.max("v").alias("max")),
            "minimum_nights_conteos": nights.select(F.col("v").cast(kind).alias("minimum_nights"), "n"),
            "minimum_nights_resumen": counted.describe(counts, ["minimum_nights"])}
    if "availability_365" in numbers:
        free = counted.numbers(counts, "availability_365")
        metrics |= {"availability_intervalos": counted.fixed_bins(free, AVAILABILITY_EDGES),
                    "availability_histograma": counted.equal_width_bins(free, F.col("v"), 37)}
    if lists:
        items, lengths = counted.keys(counts, "amenity"), counted.numbers(counts, "largo")
        metrics |= {
            "amenities_top": items.orderBy(F.desc("n"), "clave").limit(20).select(
                F.col("clave").alias("amenity"), "n", (F.col("n") * 100 / F.lit(rows)).alias("pct")),
            "amenities_listas": lengths.agg(F.max("v").cast("long").alias("maximo")).select(
                counted.quantiles(lengths, [0.5]).select(F.col("q")[0]).scalar().alias("mediana"), "maximo",
                items.agg(F.count(F.lit(1))).scalar().alias("distintas"))}
    if "host_id" in keys:
        hosts = counted.keys(counts, "host_id")
        kind = raw.schema["host_id"].dataType
        metrics |= {"hosts": counted.host_concentration(hosts, rows),
                    "hosts_top": hosts.select(F.col("clave").cast(kind).alias("host_id"), F.col("n").alias("alojamientos"))
                    .orderBy(F.desc("alojamientos"), "host_id").limit(5)}
    if "host_location" in keys:
        places = counted.keys(counts, "host_location")
        metrics |= {"host_location_top": places.withColumnRenamed("clave", "host_location").orderBy(F.desc("n"), "host_location").limit(6),
                    "texto_bogota": places.agg(counted.rows_where(F.col("clave") == "Bogota, Colombia").alias("bogota_sin_tilde"))}
    if "room_type" in groups:
        by_type = counted.numbers(counts, "precio por room_type").withColumnRenamed("clave", "room_type")
        metrics |= {"room_type": counted.keys(counts, "room_type").withColumnRenamed("clave", "room_type"),
                    "room_type_mediana": _medians(by_type, "room_type"),
                    "room_type_caja": counted.box_stats(by_type, ["room_type"])}
    if "neighbourhood_cleansed" in groups:
        by_area = counted.numbers(counts, "precio por neighbourhood_cleansed").withColumnRenamed("clave", "neighbourhood_cleansed")
        metrics["localidades"] = _medians(by_area, "neighbourhood_cleansed").where("n >= 50").orderBy(
            F.desc("n"), "neighbourhood_cleansed")
    if len(correlated) > 1:
        metrics["correlaciones"] = spearman_pairs(narrow, correlated)
    described = [c for c in ("room_type", "neighbourhood_cleansed", "host_is_superhost") if c in keys]
    if described:
        metrics["listings_texto"] = counted.describe_text(counts, described)
    return metrics


def _medians(values: DataFrame, by: str) -> DataFrame:
    return counted.quantiles(values, [0.5], [by]).select(by, "n", F.col("q")[0].alias("mediana"))


def _review_metrics(raw: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    broken = holds(F.col("comments"), "<br")
    opening = F.substring(F.when(broken, F.col("comments")), 1, 200)
    ids = present(raw, ["listing_id", "reviewer_id"])
    year = F.year(parse_date(F.col("date").cast("string")))
    table = count_table(
        raw, "reviews", {c: F.col(c) for c in ["id", *ids]} | {"longitud": F.length("comments"), "anio": year},
        [*[counted.number(c, F.col(c)) for c in [*ids, "longitud"]], *[counted.key(c, F.col(c)) for c in ids],
         counted.key("anio", F.col("anio"))], {},
        {"_desde": F.min("date"), "_hasta": F.max("date"), "_br": F.count_if(broken),
         "_ejemplo": F.min_by(opening, F.when(broken, F.col("id")))}, stage)
    spark, counts, held = raw.sparkSession, table.counts, table.held
    years = counted.keys(counts, "anio").select(F.col("clave").cast("long").alias("anio"), "n").orderBy("anio")
    distinct = spark.createDataFrame([(0,)], "cero int").select(
        *[counted.keys(counts, c).agg(F.count(F.lit(1))).scalar().alias(c) for c in ids])
    example = [(held["_ejemplo"],)] if held["_br"] else []
    return _general_metrics(table, spark, null_share=False) | {
        "reviews_id_duplicados": duplicate_count(table.narrow, ["id"]),
        "reviews_resumen": counted.describe(counts, [*ids, "longitud"]),
        "reviews_distintos": distinct,
        "reviews_rango": spark.createDataFrame([(held["_desde"], held["_hasta"])], "desde string, hasta string"),
        "reviews_por_anio": years,
        "reviews_cambio_anual": freq.year_over_year(years),
        "comentarios_br": spark.createDataFrame([(held["_br"],)], "comentarios_br long"),
        "comentario_ejemplo": spark.createDataFrame(example, "muestra string"),
    }


def _calendar_metrics(raw: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    limits = present(raw, ["minimum_nights", "maximum_nights"])
    day, free = F.col("_dia"), F.col("_libre")
    month = year_month(day)
    table = count_table(
        raw, "calendar", {c: F.col(c) for c in ["listing_id", "date", "available", *limits]} | {
            "_dia": parse_date(F.col("date")), "_libre": certainly(F.col("available") == "t").cast("int")},
        [*[counted.number(c, F.col(c)) for c in limits], counted.key("available", F.col("available")),
         counted.key("listing_id", F.col("listing_id")),
         counted.key("grupo", F.concat(F.col("listing_id").cast("string"), F.lit("|"), month)),
         counted.number("mes", F.when(day.isNotNull(), free), month),
         counted.number("dia_semana", F.when(day.isNotNull(), free), F.weekday(day)),
         counted.number("total", free, F.lit("total"))], {},
        {"_desde": F.min("date"), "_hasta": F.max("date")}, stage)
    spark, counts, held = raw.sparkSession, table.counts, table.held
    sizes = counted.keys(counts, "listing_id")
    return _general_metrics(table, spark, null_share=False) | {
        "calendar_clave_duplicados": duplicate_count(table.narrow, ["listing_id", "date"]),
        "calendar_resumen": counted.describe(counts, limits),
        "calendar_rango": spark.createDataFrame([(held["_desde"], held["_hasta"])], "desde string, hasta string"),
        "calendar_distintos": sizes.agg(F.count(F.lit(1)).alias("listing_id")),
        "calendar_dias_por_alojamiento": sizes.agg(F.min("n").alias("min"), F.max("n").alias("max")),
        "calendar_available": counted.keys(counts, "available").select(
            F.col("clave").alias("available"), (F.col("n") / F.lit(held["available"])).alias("proporcion")),
        "calendar_grupos_mes": counted.keys(counts, "grupo").agg(F.count(F.lit(1)).alias("grupos")),
        "disponibilidad_mensual": _dated(counted.rates(counts, "mes"), "mes", "string"),
        "disponibilidad_dia_semana": _dated(counted.rates(counts, "dia_semana"), "dia_semana", "long"),
        "disponibilidad_global": counted.rates(counts, "total").select("pct"),
    }


def _dated(rates: DataFrame, name: str, kind: str) -> DataFrame:
    return rates.where("clave IS NOT NULL").select(F.col("clave").cast(kind).alias(name), "pct").orderBy(name)
