"""DuckDB SQL for the registered queries."""

from itertools import combinations

from workload.views import sql

# The labels and edges that the tables must carry, stated here anew so that the SQL does not lean on the library.
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre",
               "Noviembre", "Diciembre"]
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
AVAILABILITY_EDGES = [-1, 0, 90, 180, 270, 364, 365]

ORACLES: dict[str, str] = {}

MONEY = "try_cast(replace(replace(price, '$', ''), ',', '') AS DOUBLE)"
RPT_COLUMNS = ["precio", "bedrooms", "bathrooms", "minimum_nights", "availability_365",
               "number_of_reviews", "reviews_per_month"]


def date_of(column: str) -> str:
    return (f"cast(coalesce(try_strptime({column}, '%Y-%m-%d'), "
            f"try_strptime({column}, '%Y/%m/%d')) AS DATE)")


def iso(date: str) -> str:
    return f"strftime({date}, '%Y-%m-%d')"


def labels(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def parts(date: str) -> str:
    return (f"year({date}) AS anio, month({date}) AS mes, day({date}) AS dia, "
            f"quarter({date}) AS trimestre, {labels(MONTH_NAMES)}[month({date})] AS nombre_mes, "
            f"{labels(WEEKDAY_NAMES)}[isodow({date})] AS dia_semana")


def clean(column: str) -> str:
    blank = r"[\s\x1c-\x1f\x{85}\p{Z}]"
    return (f"trim(regexp_replace(regexp_replace({column}, '<br{blank}*/?>', ' ', 'g'), "
            f"'{blank}+', ' ', 'g'))")


def title(column: str) -> str:
    words = rf"regexp_extract_all({column}, '\p{{L}}+|[^\p{{L}}]+')"
    return f"list_aggregate(list_transform({words}, lambda w: upper(w[1:1]) || lower(w[2:])), " \
           "'string_agg', '')"


def oracle(name: str, body: str, *steps: str, views: str = "L") -> None:
    ctes = [f"{v} AS ({sql(v)})" for v in views] + list(steps)
    ORACLES[name] = ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


PRICED = f"P AS (SELECT *, {MONEY} AS precio FROM L)"
SPREAD = f"S AS (SELECT id, room_type, precio * precio / 1e5 AS v FROM P)"
CAL_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_extendedprice, available, minimum_nights, "
             "maximum_nights")


def calendar_days(key: str = "date") -> str:
    return (f"D AS (SELECT * EXCLUDE (rn, available, date), date AS raw_date, "
            f"available = 't' AS disponible, available NOT IN ('t', 'f') AS sin_dato, "
            f"{date_of('date')} AS fecha FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY listing_id, {key} ORDER BY {CAL_ORDER}) AS rn FROM C) WHERE rn = 1)")


DAYS = calendar_days()
MONTHLY = """
SELECT listing_id, year(fecha) AS anio, month(fecha) AS mes, count(*) AS dias,
  cast(sum(disponible::INT) AS BIGINT) AS dias_disponibles,
  round(avg(minimum_nights), 6) AS minimo_noches_promedio,
  cast(count(*) - sum(disponible::INT) AS BIGINT) AS dias_no_disponibles,
  round((count(*) - sum(disponible::INT)) / count(*)::DOUBLE, 6) AS tasa_no_disponible
FROM D WHERE fecha IS NOT NULL GROUP BY 1, 2, 3"""
WEEKLY = f"""
SELECT isoyear(fecha) AS anio, week(fecha) AS semana, {iso('min(fecha)')} AS fecha_inicio,
  count(*) AS dias_registrados, count(DISTINCT listing_id) AS alojamientos,
  cast(sum(disponible::INT) AS BIGINT) AS dias_disponibles,
  round(100 * sum(disponible::INT) / count(*)::DOUBLE, 6) AS pct_disponible
FROM D WHERE fecha IS NOT NULL GROUP BY 1, 2"""

# ---------------------------------------------------------------- calendar
oracle("calendar_monthly", MONTHLY, DAYS, views="C")
oracle("calendar_weekly", WEEKLY, DAYS, views="C")
oracle("calendar_daily", f"""
SELECT listing_id, {iso('fecha')} AS date, minimum_nights, maximum_nights, l_orderkey, l_linenumber,
  l_partkey, l_extendedprice, disponible, {parts('fecha')} FROM D""", DAYS, views="C")
oracle("calendar_dedup_after_dates", MONTHLY,
       calendar_days(f"coalesce({iso(date_of('date'))}, date)"), views="C")
_RATE = "round_even(avg((available = 't')::INT) * 100, 1) AS pct"
oracle("avail_by_month", f"SELECT strftime({date_of('date')}, '%Y-%m') AS mes, {_RATE} FROM C "
       f"WHERE {date_of('date')} IS NOT NULL GROUP BY 1", views="C")
oracle("avail_by_weekday", f"SELECT isodow({date_of('date')}) - 1 AS dia_semana, {_RATE} FROM C "
       f"WHERE {date_of('date')} IS NOT NULL GROUP BY 1", views="C")
oracle("avail_overall", f"SELECT {_RATE} FROM C", views="C")

# ---------------------------------------------------------------- duplicates
oracle("dedup_keep_first", f"""
SELECT * EXCLUDE (rn, l_shipdate), {iso('l_shipdate')} AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1""", views="")
oracle("dup_key_count", """
SELECT cast(sum(n - 1) AS BIGINT) AS duplicados FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""", views="")
oracle("dup_row_count", """
SELECT (SELECT count(*) FROM C) - (SELECT count(*) FROM (SELECT DISTINCT * FROM C)) AS duplicados""", views="C")
oracle("dup_day_count", """
SELECT (SELECT count(*) FROM C) - (SELECT count(*) FROM (SELECT DISTINCT listing_id, date, available,
  minimum_nights, maximum_nights FROM C)) AS duplicados""", views="C")

# ---------------------------------------------------------------- prices
CLASS = """CASE WHEN precio >= 0 AND precio < 100000 THEN 'Económico'
  WHEN precio >= 100000 AND precio < 200000 THEN 'Medio'
  WHEN precio >= 200000 AND precio < 400000 THEN 'Alto'
  WHEN precio >= 400000 THEN 'Lujo' ELSE 'Sin precio' END"""
oracle("price_normalize", "SELECT id, price_raw AS precio FROM L")
oracle("price_category", f"SELECT id, {CLASS} AS categoria_precio FROM P", PRICED)
oracle("price_category_counts", f"SELECT {CLASS} AS categoria_precio, count(*) AS n FROM P GROUP BY 1",
       PRICED)
QUART = ("F AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT "
         "quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM S))")
oracle("price_outliers", "SELECT id, coalesce(v < lo OR v > hi, false) AS es_outlier_precio FROM S, F", PRICED, SPREAD, QUART)
oracle("price_outliers_upper", """
SELECT round(max(hi), 4) AS limite_iqr, count(*) FILTER (v > hi) AS atipicos,
  round(avg(coalesce(v > hi, false)::INT), 4) AS proporcion FROM S, F""", PRICED, SPREAD, QUART)
oracle("price_thresholds", """
SELECT count(*) FILTER (precio > 1e5) AS mayor_100k, count(*) FILTER (precio > 4e5) AS mayor_400k,
  count(*) FILTER (precio > 1e6) AS "mayor_1M" FROM P""", PRICED)
oracle("price_metrics", """
SELECT round(q[2], 6) AS mediana, round((SELECT avg(precio) FROM P), 6) AS media,
  round(q[1], 6) AS q1, round(q[3], 6) AS q3, round(q[4], 6) AS p99,
  (SELECT max(precio) FROM P) AS max, round(q[3] + 1.5 * (q[3] - q[1]), 6) AS limite_iqr,
  (SELECT count(*) FROM P WHERE precio > q[3] + 1.5 * (q[3] - q[1])) AS atipicos_iqr,
  (SELECT count(*) FROM P WHERE precio > 1e7) AS "mayor_10M",
  (SELECT count(*) FROM P WHERE precio IS NULL) AS sin_precio
FROM (SELECT quantile_cont(precio, [0.25, 0.5, 0.75, 0.99]) AS q FROM P)""", PRICED)
oracle("price_between_p01_p99", """
SELECT id, precio, round(log10(precio), 8) AS log10_precio FROM P
WHERE precio BETWEEN (SELECT quantile_cont(precio, 0.01) FROM P)
  AND (SELECT quantile_cont(precio, 0.99) FROM P)""", PRICED)

# ---------------------------------------------------------------- text, flags, numbers
oracle("text_clean", f"SELECT id, {clean('comments')} AS comments, "
       f"{clean('reviewer_name')} AS reviewer_name FROM R", views="R")
oracle("text_title_case", f"SELECT id, {title(clean('neighbourhood_cleansed'))} AS barrio FROM L")
oracle("text_word_replace", r"SELECT id, regexp_replace(host_location, '\bBogota\b', 'Bogotá', 'g') "
       "AS host_location FROM L")
oracle("comment_length", f"SELECT id, length({clean('comments')}) AS longitud FROM R", views="R")
oracle("text_truncate", "SELECT doc_id, substring(text, 1, 32767) AS text, "
       "substring(source, 1, 32767) AS source FROM documents", views="")
oracle("text_truncate_counts", "\nUNION ALL ".join(
    f"SELECT '{c}' AS columna, count(*) FILTER (length({c}) > 32767) AS recortados FROM documents"
    for c in ("text", "lang", "source")), views="")


def _es(decimals: int) -> str:
    return f"translate(format('{{:,.{decimals}f}}', o_totalprice), ',.', '.,')"


oracle("number_format_es", f"SELECT o_orderkey, {_es(0)} AS entero, {_es(1)} AS un_decimal, "
       f"concat('$', {_es(0)}) AS pesos FROM orders", views="")


def _tf(column: str) -> str:
    return f"CASE {column} WHEN 't' THEN true WHEN 'f' THEN false END"


oracle("bool_from_tf", f"SELECT id, {_tf('host_is_superhost')} AS host_is_superhost, "
       f"{_tf('has_availability')} AS has_availability FROM L")
AVAILABLE = f"coalesce({_tf('has_availability')}, availability_365 > 0, false)"
oracle("has_availability_fill", f"SELECT id, {AVAILABLE} AS has_availability FROM L")
BATHS = (r"coalesce(bathrooms, try_cast(nullif(regexp_extract(lower(bathrooms_text), "
         r"'(\d+(?:\.\d+)?)', 1), '') AS DOUBLE), "
         "CASE WHEN contains(lower(bathrooms_text), 'half') THEN 0.5::DOUBLE END)")
SHARED = "coalesce(contains(lower(bathrooms_text), 'shared'), false)"
oracle("baths_from_text", f"SELECT id, {BATHS} AS bathrooms, {SHARED} AS bano_compartido FROM L")
LICENSE = ("coalesce(cast(try_cast(try_cast(license AS DOUBLE) AS BIGINT) AS VARCHAR), license, "
           "'Sin registro')")
oracle("license_text", f"SELECT id, {LICENSE} AS license, license IS NOT NULL AS tiene_licencia "
       "FROM L")
oracle("quality_flags", """
SELECT id, number_of_reviews > 0 AS tiene_reviews, license IS NOT NULL AS tiene_licencia,
  coalesce(minimum_nights >= 30, false) AS es_estancia_larga,
  availability_365 = 0 AS sin_disponibilidad_anual FROM L""")
oracle("text_defaults", """
SELECT id, coalesce(description, 'Sin información') AS description,
  coalesce(host_location, 'Sin información') AS host_location FROM L""")
oracle("reviews_per_month_fill",
       "SELECT id, round(coalesce(reviews_per_month, 0), 6) AS reviews_per_month FROM L")

# ---------------------------------------------------------------- dates
SCRAPED = date_of("last_scraped")
oracle("dates_standardize", f"SELECT id, {iso(SCRAPED)} AS last_scraped FROM L")
# The date itself, not what a parser makes of its text; day and month are ambiguous up to the twelfth.
oracle("dates_all_forms", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 9 THEN strftime(o_orderdate, '%Y-01-01')
  WHEN o_orderkey % 11 = 10 AND day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%Y-%d-%m')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha FROM orders""", views="")
oracle("date_parts", f"""
SELECT id, {iso('f')} AS fecha, {parts('f')}, isoyear(f) AS anio_iso, week(f) AS semana_iso
FROM (SELECT id, {SCRAPED} AS f FROM L)""")
oracle("date_period", f"SELECT listing_id, strftime({date_of('date')}, '%Y-%m') AS mes, "
       f"count(*) AS n FROM C WHERE {date_of('date')} IS NOT NULL GROUP BY 1, 2", views="C")


def _quote(field: str) -> str:
    return f"json_extract_string(price_quote_raw, '$.quote.{field}')"


NIGHTS = (f"date_diff('day', cast({_quote('requested_checkin_date')} AS DATE), "
          f"cast({_quote('requested_checkout_date')} AS DATE))")
QUOTE_FIELDS = f"""{_quote('currency')} AS cotizacion_moneda,
  cast({_quote('is_available')} AS BOOLEAN) AS cotizacion_disponible,
  cast({_quote('discount_amount')} AS DOUBLE) AS cotizacion_descuento,
  {NIGHTS} AS cotizacion_noches"""
oracle("quote_nights", f"SELECT id, {NIGHTS} AS cotizacion_noches FROM Q", views="Q")

# ---------------------------------------------------------------- missing values, columns


def imputed(source: str, columns: list[str]) -> list[str]:
    """CTEs M (group medians), N (group fill) and O (overall medians) over `source`."""
    medians = ", ".join(f"median({c}) AS m_{c}" for c in columns)
    filled = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in columns)
    overall = ", ".join(f"median({c}) AS o_{c}" for c in columns)
    return [f"M AS (SELECT room_type, {medians} FROM {source} WHERE room_type IS NOT NULL GROUP BY 1)",
            f"N AS (SELECT {source}.* EXCLUDE ({', '.join(columns)}), {filled} FROM {source} "
            f"LEFT JOIN M USING (room_type))",
            f"O AS (SELECT {overall} FROM N)"]


IMPUTED = ["bedrooms", "bathrooms", "minimum_nights"]
FINAL = ", ".join(f"coalesce({c}, o_{c}) AS {c}" for c in IMPUTED)
oracle("impute_median_by_group", f"SELECT id, room_type, {FINAL} FROM N, O", *imputed("L", IMPUTED))

L_COLUMNS = ["id", "host_id", "host_name", "host_segment", "host_location", "host_is_superhost",
             "room_type", "price", "price_raw", "bedrooms", "bathrooms", "bathrooms_text",
             "minimum_nights", "availability_365", "number_of_reviews", "reviews_per_month", "license",
             "has_availability", "neighbourhood_cleansed", "description", "last_scraped",
             "picture_url", "host_thumbnail_url"]
oracle("null_pct", "SELECT columna, round_even(pct, 2) AS pct FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS columna, avg(({c} IS NULL)::INT) * 100 AS pct FROM L" for c in L_COLUMNS)
    + ") WHERE pct > 0")
oracle("null_counts", "\nUNION ALL ".join(
    f"SELECT '{c}' AS columna, count(*) FILTER ({c} IS NULL) AS nulos FROM R"
    for c in ("listing_id", "id", "reviewer_name", "reviewer_id", "date", "comments")), views="R")
oracle("null_cells", "SELECT cast(sum(" + " + ".join(
    f"({c} IS NULL)::INT" for c in L_COLUMNS) + ") AS BIGINT) AS celdas_nulas FROM L")
oracle("drop_empty_columns", "SELECT * EXCLUDE (picture_url, host_thumbnail_url) FROM L")
oracle("select_by_prefix", "SELECT id, host_id, host_name, host_segment, host_location, "
       "host_is_superhost, host_thumbnail_url FROM L")

# ---------------------------------------------------------------- nested cells
RAW_ITEMS = ("coalesce(CASE WHEN json_valid(amenities) THEN from_json(amenities, '[\"VARCHAR\"]') END, "
             "[])")
ITEMS = f"list_filter(list_transform({RAW_ITEMS}, lambda x: trim(x)), lambda x: x <> '')"
oracle("amenities_long", f"SELECT DISTINCT id AS listing_id, unnest({ITEMS}) AS amenity FROM A",
       views="A")
oracle("amenities_count", f"SELECT id, cast(len({ITEMS}) AS BIGINT) AS cantidad_amenities FROM A",
       views="A")
oracle("amenities_broken", f"SELECT count(*) FILTER (amenities IS NOT NULL AND len({ITEMS}) = 0 "
       "AND amenities <> '[]') AS ilegibles FROM A", views="A")
for _name, _items, _kind in (("amenities_top20", ITEMS, "DISTINCT"),
                             ("amenities_top20_raw", RAW_ITEMS, "")):
    oracle(_name, f"""
SELECT amenity, count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM A)::DOUBLE, 6) AS pct
FROM (SELECT {_kind} id, unnest({_items}) AS amenity FROM A)
GROUP BY 1 ORDER BY n DESC, amenity LIMIT 20""", views="A")
oracle("amenity_list_stats", f"""
SELECT (SELECT median(len({RAW_ITEMS})) FROM A)::DOUBLE AS mediana,
  (SELECT max(len({RAW_ITEMS})) FROM A) AS maximo,
  (SELECT count(DISTINCT i) FROM (SELECT unnest({RAW_ITEMS}) AS i FROM A)) AS distintas""", views="A")
oracle("quote_flatten", f"SELECT id, {QUOTE_FIELDS} FROM Q", views="Q")
oracle("quote_sample", "SELECT id, substring(json_extract(price_quote_raw, '$.quote')::VARCHAR, 1, "
       "700) AS muestra FROM Q WHERE price_quote_raw IS NOT NULL ORDER BY id LIMIT 1", views="Q")
oracle("documents_json", """
SELECT id, concat('{"id":', id, CASE WHEN room_type IS NOT NULL THEN concat(',"room_type":"', room_type,
  '"') END, CASE WHEN host_location IS NOT NULL THEN concat(',"host_location":"', host_location, '"')
  END, ',"availability_365":', availability_365, '}') AS documento FROM L""")

# ---------------------------------------------------------------- hosts
FIRST = "row_number() OVER (PARTITION BY host_id ORDER BY id) = 1"
oracle("hosts_dimension", "SELECT host_id, host_name, host_segment, host_location, host_is_superhost, "
       f"host_thumbnail_url FROM L QUALIFY {FIRST}")
oracle("listings_without_hosts", "SELECT * EXCLUDE (host_name, host_segment, host_location, host_is_superhost, "
       "host_thumbnail_url) FROM L")
oracle("host_concentration", """
SELECT count(*) AS distintos, count(*) FILTER (n = 1) AS con_uno,
  cast(coalesce(sum(n) FILTER (n >= 10), 0) AS BIGINT) AS alojamientos_grandes,
  max(n) AS max_alojamientos,
  round(count(*) FILTER (n = 1) / count(*)::DOUBLE, 6) AS proporcion_con_uno,
  round(coalesce(sum(n) FILTER (n >= 10), 0) / sum(n)::DOUBLE, 6) AS proporcion_grandes
FROM (SELECT host_id, count(*) AS n FROM L GROUP BY 1)""")
oracle("host_top5", "SELECT host_id, count(*) AS alojamientos FROM L GROUP BY 1 "
       "ORDER BY alojamientos DESC, host_id LIMIT 5")

# ---------------------------------------------------------------- reviews
oracle("reviews_clean", f"""
SELECT listing_id, id, {clean('reviewer_name')} AS reviewer_name, reviewer_id, {iso('f')} AS date,
  {clean('comments')} AS comments, length({clean('comments')}) AS longitud_comentario, {parts('f')}
FROM (SELECT *, {date_of('date')} AS f FROM R) WHERE comments IS NOT NULL""", views="R")
oracle("reviews_by_year", f"SELECT year({date_of('date')}) AS anio, count(*) AS n FROM R GROUP BY 1",
       views="R")
oracle("reviews_yoy", """
SELECT anio, n, round((n / (lag(n) OVER (ORDER BY anio))::DOUBLE - 1) * 100, 6) AS cambio_pct
FROM (SELECT year(o_orderdate) AS anio, count(*) AS n FROM orders GROUP BY 1)""", views="")
oracle("orphan_reviews", "SELECT doc_id, count(*) AS filas FROM documents d WHERE NOT EXISTS "
       "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1", views="")
oracle("matched_reviews", "SELECT l_orderkey, count(*) AS filas FROM lineitem WHERE EXISTS "
       "(SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) GROUP BY 1", views="")

# ---------------------------------------------------------------- summaries
oracle("describe_numeric", "\nUNION ALL ".join(f"""
SELECT '{c}' AS columna, count({c}) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min,
  round(max({c})::DOUBLE, 4) AS max, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25,
  round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
  round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75 FROM P"""
    for c in ("precio", "bedrooms", "minimum_nights", "availability_365", "reviews_per_month")), PRICED)
oracle("describe_text", "\nUNION ALL ".join(f"""
SELECT '{c}' AS columna, cast(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  first(v ORDER BY n DESC, v) AS top, max(n) AS freq
FROM (SELECT {c} AS v, count(*) AS n FROM L WHERE {c} IS NOT NULL GROUP BY 1)"""
    for c in ("room_type", "host_location", "neighbourhood_cleansed", "bathrooms_text")))
oracle("percentile_list", "\nUNION ALL ".join(
    f"SELECT {p}::DOUBLE AS prob, round(quantile_cont(precio, {p}), 4) AS valor FROM P"
    for p in (0.01, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)), PRICED)
oracle("quantiles_by_group", "\nUNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS columna, count({c}) AS n, " + ", ".join(
        f"round(quantile_cont({c}, {p / 100}), 4) AS p{p}" for p in (10, 50, 90))
    + " FROM lineitem GROUP BY 1" for c in ("l_extendedprice", "l_quantity")), views="")
oracle("quantiles_narrow_range", "\nUNION ALL ".join(
    f"SELECT {flag} AS l_returnflag, count(*) AS n, " + ", ".join(
        f"round(quantile_cont(l_extendedprice::DOUBLE / 2e6 - 74.1, {p / 100}), 6) AS p{p}"
        for p in (10, 50, 90)) + f" FROM lineitem {group}"
    for flag, group in (("'all'", ""), ("l_returnflag", "GROUP BY 1"))), views="")
oracle("value_counts", "SELECT room_type, count(*) AS n FROM L WHERE room_type IS NOT NULL GROUP BY 1")
oracle("value_shares", "SELECT available, round(count(*) / (SELECT count(available) FROM C)::DOUBLE, "
       "6) AS proporcion FROM C GROUP BY 1", views="C")
oracle("distinct_counts", "SELECT " + ", ".join(
    f"count(DISTINCT {c}) AS {c}" for c in ("host_id", "room_type", "host_location")) + " FROM L")
oracle("date_range", "SELECT min(date) AS desde, max(date) AS hasta FROM C", views="C")
oracle("group_size_range", "SELECT min(n) AS min, max(n) AS max FROM (SELECT count(*) AS n FROM C "
       "GROUP BY listing_id)", views="C")
oracle("group_count", f"SELECT count(*) AS grupos FROM (SELECT DISTINCT listing_id, "
       f"strftime({date_of('date')}, '%Y-%m') AS mes FROM C) WHERE mes IS NOT NULL", views="C")
oracle("bins_fixed", "\nUNION ALL ".join(
    f"SELECT {i}::BIGINT AS orden, '({a}, {b}]' AS intervalo, count(*) AS n FROM L "
    f"WHERE availability_365 > {a} AND availability_365 <= {b}"
    for i, (a, b) in enumerate(zip(AVAILABILITY_EDGES, AVAILABILITY_EDGES[1:]))))


def _histogram(value: str, bins: int) -> tuple[str, ...]:
    return (f"H AS (SELECT {value}::DOUBLE AS v FROM P WHERE {value} IS NOT NULL)",
            "E AS (SELECT min(v) AS lo, max(v) AS hi FROM H)",
            f"B AS (SELECT least(cast(floor({bins} * (v - lo) / (hi - lo)) AS BIGINT), {bins - 1}) "
            "AS orden, count(*) AS n FROM H, E GROUP BY 1)",
            f"K AS (SELECT range AS orden, round(lo + (hi - lo) / {bins} * range, 6) AS desde "
            f"FROM range({bins}), E)")


_BINS = "SELECT orden, desde, coalesce(n, 0) AS n FROM K LEFT JOIN B USING (orden)"
oracle("hist_log_price", _BINS, PRICED,
       *_histogram("CASE WHEN precio > 0 THEN log10(precio) END", 60))
oracle("hist_availability", _BINS, PRICED, *_histogram("availability_365", 37))


def _box(group: str) -> tuple[str, ...]:
    return (f"B AS (SELECT {group} AS g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS mediana, "
            f"quantile_cont(v, 0.75) AS q3 FROM S WHERE v IS NOT NULL AND {group} IS NOT NULL GROUP BY 1)",
            f"X AS (SELECT B.*, v, v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside "
            f"FROM S JOIN B ON g = {group} WHERE v IS NOT NULL)")


_BOX = """round(q1, 3) AS q1, round(mediana, 3) AS mediana, round(q3, 3) AS q3,
  round(min(v) FILTER (inside), 3) AS bigote_inferior,
  round(max(v) FILTER (inside), 3) AS bigote_superior, count(*) FILTER (NOT inside) AS atipicos
FROM X GROUP BY g, X.q1, X.mediana, X.q3"""
oracle("box_stats_overall", f"SELECT {_BOX}", PRICED, SPREAD, *_box("1"))
oracle("box_stats_by_group", f"SELECT g AS room_type, {_BOX}", PRICED, SPREAD, *_box("room_type"))
oracle("median_by_type", "SELECT room_type, count(precio) AS n, round(median(precio), 4) AS mediana "
       "FROM P WHERE room_type IS NOT NULL GROUP BY 1", PRICED)
oracle("median_by_area_having", "SELECT neighbourhood_cleansed, count(precio) AS n, "
       "round(median(precio), 4) AS mediana FROM P GROUP BY 1 HAVING count(precio) >= 50", PRICED)
oracle("min_nights_modes", "SELECT " + ", ".join(
    f"count(*) FILTER (minimum_nights = {n}) AS noches_{n}" for n in (1, 2, 30))
    + ", max(minimum_nights) AS max FROM L")
oracle("share_ratios", "SELECT room_type, round_even(count(*) / (SELECT count(*) FROM L)::DOUBLE * 100, "
       "1) AS pct FROM L WHERE room_type IS NOT NULL GROUP BY 1")
oracle("spearman_matrix", "\nUNION ALL ".join(f"""
SELECT '{a}' AS variable_a, '{b}' AS variable_b, count(*) AS n,
  CASE WHEN abs(corr(ra, rb)) < 5e-7 THEN 0 ELSE round(corr(ra, rb), 6) END AS rho FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
    rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
  FROM P WHERE {a} IS NOT NULL AND {b} IS NOT NULL)""" for a, b in combinations(RPT_COLUMNS, 2)), PRICED)

# ---------------------------------------------------------------- rows
oracle("top5_price", "SELECT id, room_type, precio FROM P ORDER BY precio DESC NULLS LAST, id LIMIT 5",
       PRICED)
oracle("head_rows", "SELECT id, host_id, price, room_type FROM L ORDER BY id LIMIT 25")
oracle("text_match_counts", """
SELECT count(*) FILTER (contains(html, '<br')) AS con_br,
  count(*) FILTER (contains(html, '<table')) AS con_tabla,
  count(*) FILTER (html = '<html></html>') AS exacto FROM pages""", views="")
oracle("host_location_top", "SELECT host_location, count(*) AS n FROM L WHERE host_location IS NOT NULL "
       "GROUP BY 1 ORDER BY n DESC, host_location LIMIT 6")
oracle("first_match_sample", "SELECT substring(html, 1, 200) AS muestra FROM pages "
       "WHERE contains(html, '<br') ORDER BY page_id LIMIT 1", views="")
oracle("union_batches", f"""
SELECT * EXCLUDE (o_orderdate, o_orderpriority), {iso('o_orderdate')} AS o_orderdate,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders""", views="")
oracle("scan_filter_project", "SELECT event_id, event_type, value FROM events "
       "WHERE event_type IN ('click', 'purchase') AND value >= 10", views="")
oracle("scan_not_equal", "SELECT event_id, user_id, event_type, value FROM events "
       "WHERE event_type <> 'view' AND user_id < 40", views="")
oracle("list_collections", "\nUNION ALL ".join(f"SELECT '{t}' AS coleccion, count(*) AS filas FROM {t}" for t in (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier")), views="")

# ---------------------------------------------------------------- sources, sinks, audit
oracle("land_csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, "
       "p_retailprice FROM part", views="")
oracle("load_verify", "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabla, count(*) AS esperado, count(*) AS almacenado, true AS ok, "
    f"true AS en_extracto FROM {t}" for t in ("orders", "customer", "nation")), views="")
oracle("export_extracts", "SELECT * REPLACE (CAST(CAST(l_shipdate AS date) AS varchar) AS l_shipdate) "
       "FROM lineitem", views="")
oracle("land_large_ids", "SELECT o_orderkey + 1012345678900000000 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
       "CAST(CAST(o_orderdate AS date) AS varchar) AS o_orderdate, o_orderpriority FROM orders", views="")
oracle("structure_report", "\nUNION ALL ".join(
    f"SELECT {i}::BIGINT AS orden, '{c}' AS columna, '{t}' AS tipo, count({c}) AS no_nulos FROM C"
    for i, (c, t) in enumerate((
        ("listing_id", "bigint"), ("date", "string"), ("available", "string"),
        ("minimum_nights", "double"), ("maximum_nights", "int"), ("l_orderkey", "bigint"),
        ("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_extendedprice", "double")))), views="C")
oracle("table_shapes", "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabla, count(*) AS filas, {n}::BIGINT AS columnas FROM {t}"
    for t, n in (("orders", 6), ("lineitem", 11), ("customer", 5))), views="")
_COUNTS = ("N AS (SELECT (SELECT count(*) FROM C) AS antes, (SELECT count(*) FROM D) AS filas, "
           f"(SELECT count(*) FROM ({MONTHLY})) AS mensual, "
           f"(SELECT count(*) FROM ({WEEKLY})) AS semanal)")
oracle("step_audit", """
SELECT 1::BIGINT AS orden, 'Eliminación de duplicados' AS paso, 'calendar' AS tabla,
  antes AS filas_antes, filas AS filas_despues,
  concat('clave [''listing_id'', ''date''], ', antes - filas, ' duplicados') AS detalle FROM N
UNION ALL SELECT 2, 'Estandarización de fechas a YYYY-MM-DD', 'calendar', filas, filas,
  'columnas [''date'']' FROM N
UNION ALL SELECT 3, 'Variables de fecha derivadas', 'calendar', filas, filas,
  'anio, mes, dia, trimestre, nombre_mes, dia_semana' FROM N
UNION ALL SELECT 4, 'Resumen mensual del calendario', 'calendar_mensual', filas, mensual,
  'agrupado por listing_id, anio, mes' FROM N
UNION ALL SELECT 5, 'Resumen semanal del calendario', 'calendar_semanal', filas, semanal,
  'agrupado por semana ISO' FROM N""", DAYS, _COUNTS, views="C")
def _thousands(column: str) -> str:
    return f"translate(format('{{:,.0f}}', {column}::DOUBLE), ',', '.')"


oracle("step_report", f"""
SELECT 1::BIGINT AS orden, 'calendar' AS tabla, 'Eliminación de duplicados' AS paso,
  {_thousands('antes')} AS antes, {_thousands('filas')} AS despues FROM N
UNION ALL SELECT 2, 'calendar', 'Estandarización de fechas a YYYY-MM-DD', {_thousands('filas')},
  {_thousands('filas')} FROM N
UNION ALL SELECT 3, 'calendar', 'Variables de fecha derivadas', {_thousands('filas')},
  {_thousands('filas')} FROM N
UNION ALL SELECT 4, 'calendar_mensual', 'Resumen mensual del calendario', {_thousands('filas')},
  {_thousands('mensual')} FROM N
UNION ALL SELECT 5, 'calendar_semanal', 'Resumen semanal del calendario', {_thousands('filas')},
  {_thousands('semanal')} FROM N""", DAYS, _COUNTS, views="C")
oracle("verification_report", "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabla, {_thousands('count(*)')} AS esperado, {_thousands('count(*)')} "
    f"AS almacenado, 'no exportado' AS exportado, 'OK' AS resultado FROM {t}"
    for t in ("part", "supplier", "region")), views="")
oracle("dq_warnings", """
SELECT 'calendar' AS tabla, 'duplicados' AS regla,
  (SELECT count(*) FROM C) - (SELECT count(*) FROM D) AS n
UNION ALL SELECT 'calendar', 'disponibilidad inválida', count(*) FROM D WHERE sin_dato
UNION ALL SELECT 'calendar', 'fecha inválida', count(*) FROM D WHERE raw_date IS NOT NULL AND fecha IS NULL
UNION ALL SELECT 'calendar', 'sin fecha', count(*) FROM D WHERE fecha IS NULL""", DAYS, views="C")
oracle("log_parse", r"""
SELECT pos, string_split(value, ' | ')[1] AS momento, string_split(value, ' | ')[2] AS nivel,
  string_split(value, ' | ')[3] AS origen, string_split(value, ' | ')[4] AS mensaje FROM G""", views="G")
oracle("log_excerpt", """
SELECT pos, value FROM (
  SELECT pos, value, row_number() OVER (ORDER BY pos) AS rn, count(*) OVER () AS n FROM G
  WHERE pos >= (SELECT max(pos) FROM G WHERE contains(value, 'INICIO DEL PROCESO ETL'))
    AND (contains(value, 'INICIO') OR contains(value, 'WARNING') OR contains(value, 'ERROR')))
WHERE rn < 48 OR rn = n""", views="G")

# ---------------------------------------------------------------- whole tables
_BASE = (f"W AS (SELECT L.* EXCLUDE (price, bathrooms, has_availability), {MONEY} AS price, "
         f"{BATHS} AS bathrooms, {AVAILABLE} AS has_availability, amenities, price_quote_raw "
         "FROM L LEFT JOIN A USING (id) LEFT JOIN Q USING (id))")
_FENCES = ("F AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT "
           "quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM W))")
_NIGHTS = "coalesce(minimum_nights, o_minimum_nights)"
oracle("listings_full", f"""
SELECT id, host_id, room_type, price, price_raw, {FINAL}, bathrooms_text, availability_365,
  number_of_reviews, round(coalesce(reviews_per_month, 0), 6) AS reviews_per_month,
  {LICENSE} AS license, has_availability, {title(clean('neighbourhood_cleansed'))}
  AS neighbourhood_cleansed, {clean("coalesce(description, 'Sin información')")} AS description,
  {iso(SCRAPED)} AS last_scraped, {QUOTE_FIELDS}, {SHARED} AS bano_compartido,
  number_of_reviews > 0 AS tiene_reviews, license IS NOT NULL AS tiene_licencia,
  {CLASS.replace('precio >', 'price >').replace('precio <', 'price <')} AS categoria_precio,
  coalesce(price < lo OR price > hi, false) AS es_outlier_precio,
  {_NIGHTS} >= 30 AS es_estancia_larga, availability_365 = 0 AS sin_disponibilidad_anual,
  cast(len({ITEMS}) AS BIGINT) AS cantidad_amenities
FROM N, O, F""", _BASE, *imputed("W", IMPUTED), _FENCES, views="LAQ")
oracle("listings_hosts", rf"""
SELECT host_id, host_name, host_segment, regexp_replace({clean("coalesce(host_location, 'Sin información')")},
  '\bBogota\b', 'Bogotá', 'g') AS host_location, {_tf('host_is_superhost')} AS host_is_superhost
FROM L QUALIFY {FIRST}""")
oracle("run_all_tables", f"""
SELECT 'listings' AS tabla, count(*) AS filas, 29::BIGINT AS columnas FROM L
UNION ALL SELECT 'hosts', count(DISTINCT host_id), 5 FROM L
UNION ALL SELECT 'listing_amenities', count(*), 2 FROM (
  SELECT DISTINCT id, unnest({ITEMS}) FROM A WHERE id IN (SELECT id FROM L))
UNION ALL SELECT 'reviews', count(*), 13 FROM R WHERE comments IS NOT NULL
UNION ALL SELECT 'calendar', count(*), 15 FROM D
UNION ALL SELECT 'calendar_mensual', count(*), 8 FROM ({MONTHLY})
UNION ALL SELECT 'calendar_semanal', count(*), 7 FROM ({WEEKLY})""", DAYS, views="LACR")
oracle("run_contents", f"SELECT *, true AS igual FROM ({ORACLES['run_all_tables']})", views="")
for _name, _same in (("listings", "listings_full"), ("hosts", "listings_hosts"), ("reviews", "reviews_clean"),
                     ("calendar", "calendar_daily"), ("calendar_mensual", "calendar_monthly"),
                     ("calendar_semanal", "calendar_weekly")):
    ORACLES[f"run_{_name}"] = ORACLES[_same]
oracle("run_listing_amenities", f"""
SELECT DISTINCT id AS listing_id, unnest({ITEMS}) AS amenity FROM A WHERE id IN (SELECT id FROM L)""", views="LA")
ORACLES["calendar_updated"] = ORACLES["calendar_monthly"]
oracle("calendar_one_month", f"SELECT * FROM ({ORACLES['calendar_daily']}) WHERE anio = 1996 AND mes = 5", views="")
oracle("union_widened", """
SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'k' ELSE '' END || l_orderkey::VARCHAR AS l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 2 = 0 THEN trunc(l_quantity) ELSE l_quantity END AS l_quantity FROM lineitem""", views="")
oracle("quantiles_approximate", """
SELECT l_returnflag, count(*) AS n, true AS dentro_p10, true AS dentro_p50, true AS dentro_p90
FROM lineitem GROUP BY 1""", views="")
oracle("map_points", """
SELECT longitude, latitude, round(log10(precio), 8) AS log10_precio FROM M
WHERE precio BETWEEN (SELECT quantile_cont(precio, 0.01) FROM M) AND (SELECT quantile_cont(precio, 0.99) FROM M)""",
       views="M")

# ---------------------------------------------------------------- audit of listings and reviews
_CELLS_LEFT = ["room_type", "price", "price_raw", "bathrooms_text", "last_scraped", "amenities",
               "cotizacion_moneda", "cotizacion_disponible", "cotizacion_descuento", "cotizacion_noches"]
_CELLS_FILLED = ["bedrooms", "bathrooms", "minimum_nights", "reviews_per_month", "license", "has_availability",
                 "description", "host_location"]
_LISTED = (f"T AS (SELECT id, host_id, host_location, room_type, {MONEY} AS price, price_raw, bedrooms, {BATHS} AS bathrooms, "
           f"bathrooms_text, minimum_nights, reviews_per_month, license, {_tf('has_availability')} AS has_availability, "
           f"description, {SCRAPED} AS last_scraped, last_scraped AS scraped_text, amenities, {QUOTE_FIELDS} "
           "FROM L LEFT JOIN A USING (id) LEFT JOIN Q USING (id))")


def _nulls(columns: list[str]) -> str:
    return "(SELECT " + " + ".join(f"count(*) - count({c})" for c in columns) + " FROM T)"


_LISTED_COUNTS = (f"N AS (SELECT (SELECT count(*) FROM T) AS filas, {_nulls(_CELLS_LEFT + _CELLS_FILLED)} AS antes, "
                  f"{_nulls(_CELLS_LEFT)} AS despues, (SELECT count(DISTINCT host_id) FROM T) AS hosts, "
                  f"(SELECT count(*) FROM P) AS pares, (SELECT count(DISTINCT amenity) FROM P) AS tipos)")
_PAIRS = f"P AS (SELECT DISTINCT id AS listing_id, unnest({ITEMS}) AS amenity FROM T)"
oracle("step_audit_listings", """
SELECT 1::BIGINT AS orden, 'Eliminación de duplicados' AS paso, 'listings' AS tabla, filas AS filas_antes,
  filas AS filas_despues, 'clave [''id''], 0 duplicados' AS detalle FROM N
UNION ALL SELECT 2, 'Eliminación de columnas vacías/sin valor', 'listings', filas, filas,
  '2 columnas: [''picture_url'', ''host_thumbnail_url'']' FROM N
UNION ALL SELECT 3, 'Normalización de precios', 'listings', filas, filas, 'texto a número' FROM N
UNION ALL SELECT 4, 'Desanidado de price_quote_raw', 'listings', filas, filas,
  'moneda, disponibilidad, descuento y noches' FROM N
UNION ALL SELECT 5, 'Estandarización de fechas a YYYY-MM-DD', 'listings', filas, filas,
  'columnas [''last_scraped'']' FROM N
UNION ALL SELECT 6, 'Tratamiento de nulos', 'listings', filas, filas,
  concat('celdas nulas ', antes, ' -> ', despues) FROM N
UNION ALL SELECT 7, 'Estandarización de texto', 'listings', filas, filas,
  'espacios, etiquetas y formato título' FROM N
UNION ALL SELECT 8, 'Categorización de precios y marcas de atípicos', 'listings', filas, filas,
  'categoría de precio y marcas' FROM N
UNION ALL SELECT 9, 'Desanidado de amenities', 'listing_amenities', filas, pares,
  concat(tipos, ' amenities distintas') FROM N
UNION ALL SELECT 10, 'Extracción de dimensión hosts', 'hosts', filas, hosts, '4 columnas de anfitrión' FROM N""",
       _LISTED, _PAIRS, _LISTED_COUNTS, views="LAQ")
oracle("dq_listings", "\nUNION ALL ".join(
    f"SELECT 'listings' AS tabla, '{rule}' AS regla, {n} AS n FROM T" for rule, n in (
        ("duplicados", "0::BIGINT"), ("columnas vacías", "1::BIGINT"), ("imputados en bedrooms", "count(*) - count(bedrooms)"),
        ("imputados en bathrooms", "count(*) - count(bathrooms)"),
        ("imputados en minimum_nights", "count(*) - count(minimum_nights)"),
        ("disponibilidad deducida", "count(*) - count(has_availability)"), ("sin precio", "count(*) - count(price)"),
        ("amenities ilegibles", f"count(*) FILTER (amenities IS NOT NULL AND len({ITEMS}) = 0 AND amenities <> '[]')"),
        ("fecha inválida", "count(*) FILTER (scraped_text IS NOT NULL AND last_scraped IS NULL)"))).replace(
    "0::BIGINT AS n FROM T", "0::BIGINT AS n").replace("1::BIGINT AS n FROM T", "1::BIGINT AS n"), _LISTED, views="LAQ")
_REVIEWED = (f"T AS (SELECT *, {date_of('date')} AS f FROM R)",
             "N AS (SELECT count(*) AS unicas, count(comments) AS filas, count(*) + count(*) FILTER (id % 11 = 0) AS antes FROM T)")
oracle("step_audit_reviews", """
SELECT 1::BIGINT AS orden, 'Eliminación de duplicados' AS paso, 'reviews' AS tabla, antes AS filas_antes,
  unicas AS filas_despues, concat('clave [''id''], ', antes - unicas, ' duplicados') AS detalle FROM N
UNION ALL SELECT 2, 'Eliminación de reseñas sin comentario', 'reviews', unicas, filas, '' FROM N
UNION ALL SELECT 3, 'Estandarización de fechas a YYYY-MM-DD', 'reviews', filas, filas, 'columnas [''date'']' FROM N
UNION ALL SELECT 4, 'Variables de fecha derivadas', 'reviews', filas, filas,
  'anio, mes, dia, trimestre, nombre_mes, dia_semana' FROM N""", *_REVIEWED, views="R")
oracle("dq_reviews", """
SELECT 'reviews' AS tabla, 'duplicados' AS regla, antes - unicas AS n FROM N
UNION ALL SELECT 'reviews', 'sin comentario', unicas - filas FROM N
UNION ALL SELECT 'reviews', 'fecha inválida', count(*) FROM T WHERE comments IS NOT NULL AND f IS NULL
UNION ALL SELECT 'reviews', 'alojamiento ausente', count(*) FROM T
  WHERE comments IS NOT NULL AND listing_id % 7 = 0""", *_REVIEWED, views="R")

# ---------------------------------------------------------------- profile
def _fields(name: str, columns: list[str], record: str) -> str:
    """A one-row record as metrica, campo, valor."""
    return "\nUNION ALL ".join(f"SELECT '{name}' AS metrica, '{c}' AS campo, round(\"{c}\"::DOUBLE, 4) AS valor FROM ({record})"
                               for c in columns)


oracle("profile_listings", "\nUNION ALL ".join([
    _fields("precio", ["mediana", "media", "q1", "q3", "p99", "max", "limite_iqr", "atipicos_iqr", "mayor_10M", "sin_precio"],
            ORACLES["price_metrics"]),
    _fields("minimum_nights", ["noches_1", "noches_2", "noches_30", "max"], ORACLES["min_nights_modes"]),
    _fields("hosts", ["distintos", "con_uno", "alojamientos_grandes", "max_alojamientos", "proporcion_con_uno",
                      "proporcion_grandes"], ORACLES["host_concentration"]),
    _fields("amenities_listas", ["mediana", "maximo", "distintas"],
            f"""SELECT median(len(i))::DOUBLE AS mediana, max(len(i)) AS maximo,
              (SELECT count(DISTINCT x) FROM (SELECT unnest({RAW_ITEMS}) AS x FROM W)) AS distintas
            FROM (SELECT {RAW_ITEMS} AS i FROM W)"""),
    _fields("listings_id_duplicados", ["duplicados"], "SELECT 0 AS duplicados"),
    _fields("precio_umbrales", ["mayor_1M", "mayor_10M"],
            "SELECT count(*) FILTER (precio > 1e6) AS \"mayor_1M\", count(*) FILTER (precio > 1e7) AS \"mayor_10M\" FROM P")]),
       PRICED, "W AS (SELECT id, amenities FROM L LEFT JOIN A USING (id))", views="LA")
oracle("profile_listing_groups", "\nUNION ALL ".join(
    f"SELECT {c} AS grupo, count(precio) AS n, round(median(precio), 4) AS mediana FROM P WHERE {c} IS NOT NULL "
    f"GROUP BY 1 HAVING count(precio) >= {least}" for c, least in (("room_type", 1), ("neighbourhood_cleansed", 50))), PRICED)
oracle("profile_reviews", "\nUNION ALL ".join(
    f"""SELECT '{name}' AS columna, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
  min(x)::DOUBLE AS min, max(x)::DOUBLE AS max, round(quantile_cont(x, 0.25), 4) AS p25, round(quantile_cont(x, 0.5), 4) AS p50,
  round(quantile_cont(x, 0.75), 4) AS p75 FROM (SELECT {x}::DOUBLE AS x FROM R)"""
    for name, x in (("listing_id", "listing_id"), ("reviewer_id", "reviewer_id"), ("longitud", "length(comments)"))), views="R")
_FREE = "round(100 * avg((available = 't')::INT), 6) AS pct"
oracle("profile_calendar", f"""
SELECT 'mes' AS por, strftime(f, '%Y-%m') AS valor, {_FREE} FROM T WHERE f IS NOT NULL GROUP BY 2
UNION ALL SELECT 'dia_semana', (isodow(f) - 1)::VARCHAR, {_FREE} FROM T WHERE f IS NOT NULL GROUP BY 2
UNION ALL SELECT 'total', NULL, {_FREE} FROM T""", f"T AS (SELECT *, {date_of('date')} AS f FROM C)", views="C")
