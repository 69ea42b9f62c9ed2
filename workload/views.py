"""Rental-like views over the test tables, as Spark DataFrames and as DuckDB SQL.

The two dialects differ in four small macros only; missing values, dirty text and bad dates are set in
by modulo rules, every row of the source table is kept.
"""

from pyspark.sql import DataFrame, SparkSession

_SPARK = {"FMT2": "format_number({0}, 2)", "ISO": "cast(cast({0} AS date) AS string)",
          "SLASH": "translate(cast(cast({0} AS date) AS string), '-', '/')",
          "STR": "cast({0} AS string)", "JARR": "to_json(split({0}, ' '))", "DBL": "{0}D",
          **{name: f"date_format({{0}}, '{form}')" for name, form in (
              ("YMD", "yyyyMMdd"), ("MDY", "MM/dd/yyyy"), ("MDY2", "MM/dd/yy"), ("DMY", "dd/MM/yyyy"),
              ("WORDS", "MMM d, yyyy"), ("DWORDS", "d MMM yyyy"), ("YEAR", "yyyy"))}}
_DUCKDB = {"FMT2": "format('{{{{:,.2f}}}}', {0})", "ISO": "strftime({0}, '%Y-%m-%d')",
           "SLASH": "strftime({0}, '%Y/%m/%d')", "STR": "cast({0} AS varchar)",
           "JARR": "cast(to_json(string_split({0}, ' ')) AS varchar)", "DBL": "{0}::DOUBLE",
           **{name: f"strftime({{0}}, '{form}')" for name, form in (
               ("YMD", "%Y%m%d"), ("MDY", "%m/%d/%Y"), ("MDY2", "%m/%d/%y"), ("DMY", "%d/%m/%Y"),
               ("WORDS", "%b %-d, %Y"), ("DWORDS", "%-d %b %Y"), ("YEAR", "%Y"))}}

_LISTINGS = """
SELECT o_orderkey AS id, o_custkey AS host_id, c_name AS host_name, c_mktsegment AS host_segment,
  CASE o_custkey % 3 WHEN 0 THEN 'Bogota, Colombia' WHEN 1 THEN 'Bogotá, Colombia' END AS host_location,
  CASE WHEN o_custkey % 2 = 0 THEN 't' ELSE 'f' END AS host_is_superhost,
  CASE WHEN o_orderkey % 53 <> 0 THEN o_orderpriority END AS room_type,
  CASE WHEN o_orderkey % 37 <> 0 THEN concat('$', <FMT2:o_totalprice>) END AS price,
  CASE WHEN o_orderkey % 37 <> 0 THEN o_totalprice END AS price_raw,
  CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey % 5 AS DOUBLE) END AS bedrooms,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 3 AS DOUBLE) END AS bathrooms,
  CASE o_orderkey % 5 WHEN 0 THEN '1 shared bath' WHEN 1 THEN '2 baths' WHEN 2 THEN 'Shared half-bath'
    WHEN 3 THEN '1.5 baths' END AS bathrooms_text,
  CASE WHEN o_orderkey % 10 < 5 THEN <DBL:1.0> WHEN o_orderkey % 10 < 7 THEN <DBL:2.0>
    WHEN o_orderkey % 10 < 9 THEN <DBL:30.0> END AS minimum_nights,
  o_orderkey % 366 AS availability_365,
  CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 40 END AS number_of_reviews,
  CASE WHEN o_orderkey % 9 <> 0 THEN (o_orderkey % 40) / <DBL:12.0> END AS reviews_per_month,
  CASE o_orderkey % 5 WHEN 1 THEN 'RNT 12345' WHEN 2 THEN concat(<STR:o_orderkey>, '.0')
    WHEN 3 THEN <STR:o_orderkey> WHEN 4 THEN concat('00', <STR:o_orderkey>) END AS license,
  CASE o_orderkey % 3 WHEN 0 THEN 't' WHEN 1 THEN 'f' END AS has_availability,
  concat('  santa-', lower(n_name), ' ') AS neighbourhood_cleansed,
  CASE WHEN o_orderkey % 8 <> 0 THEN concat(c_name, '<br/> ', o_orderpriority) END AS description,
  CASE WHEN o_orderkey % 97 = 0 THEN 'no es fecha' WHEN o_orderkey % 4 = 0 THEN <SLASH:o_orderdate>
    ELSE <ISO:o_orderdate> END AS last_scraped,
  'u' AS picture_url, CAST(NULL AS INT) AS host_thumbnail_url
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""

_CALENDAR = """
SELECT l_suppkey AS listing_id,
  CASE WHEN l_orderkey % 101 = 0 THEN 'fecha-mala' WHEN l_orderkey % 17 = 0 THEN <SLASH:l_shipdate>
    ELSE <ISO:l_shipdate> END AS date,
  CASE l_returnflag WHEN 'A' THEN 't' WHEN 'N' THEN 'f' ELSE 'x' END AS available,
  l_quantity AS minimum_nights, CAST(30 AS INT) AS maximum_nights,
  l_orderkey, l_linenumber, l_partkey, l_extendedprice
FROM {lineitem}"""

_REVIEWS = """
SELECT doc_id % 100 AS listing_id, doc_id AS id, concat(' ', source, '  ') AS reviewer_name,
  doc_id % 37 AS reviewer_id,
  concat(<STR:2015 + doc_id % 10>, '-0', <STR:1 + doc_id % 9>, '-15') AS date,
  CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 49 = 0 THEN '<br/>'
    ELSE concat(text, '<br />fin  ') END AS comments
FROM {documents}"""

_AMENITIES = """
SELECT p_partkey AS id,
  CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN '[bad'
    WHEN p_partkey % 47 = 0 THEN '[]' WHEN p_partkey % 53 = 0 THEN '[" Wifi ","","Wifi"]'
    ELSE <JARR:concat(p_name, ' ', p_type, ' ', p_brand)> END AS amenities
FROM {part}"""

_QUOTES = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN '{{"quote": null}}' ELSE
    concat('{{"quote":{{"currency":"COP","is_available":',
           CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END,
           ',"discount_amount":"', <STR:o_orderkey % 1000>,
           '.50","requested_checkin_date":"2027-04-01","requested_checkout_date":"2027-04-',
           <STR:10 + o_orderkey % 20>, '"}}}}') END AS price_quote_raw
FROM {orders}"""

_LOG = """
SELECT event_id AS pos,
  concat(<ISO:ts>, ' 00:00:00 | ',
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END,
         ' | etl.', event_type, ' | ',
         CASE WHEN event_id IN (0, 400, 800) THEN 'INICIO DEL PROCESO ETL'
           ELSE concat('evento ', <STR:user_id>) END) AS value
FROM {events}"""

_MAPPED = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 37 <> 0 THEN o_totalprice END AS precio,
  (o_orderkey % 997) / <DBL:10000.0> - 74 AS longitude, (o_orderkey % 883) / <DBL:10000.0> + 4 AS latitude
FROM {orders}"""

# One written form of a date for each remainder of the key.
_WRITTEN = """
SELECT o_orderkey AS id, CASE o_orderkey % 11 WHEN 0 THEN <ISO:o_orderdate> WHEN 1 THEN <SLASH:o_orderdate>
  WHEN 2 THEN <YMD:o_orderdate> WHEN 3 THEN concat(<ISO:o_orderdate>, 'T10:20:30') WHEN 4 THEN concat(<ISO:o_orderdate>, ' 10:20 PM')
  WHEN 5 THEN <MDY:o_orderdate> WHEN 6 THEN concat('  ', <MDY2:o_orderdate>) WHEN 7 THEN <WORDS:o_orderdate>
  WHEN 8 THEN <DWORDS:o_orderdate> WHEN 9 THEN <YEAR:o_orderdate> ELSE <DMY:o_orderdate> END AS escrita
FROM {orders}"""

_TEMPLATES = {"L": _LISTINGS, "C": _CALENDAR, "R": _REVIEWS, "A": _AMENITIES, "Q": _QUOTES, "G": _LOG, "M": _MAPPED, "V": _WRITTEN}
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _expand(template: str, macros: dict[str, str]) -> str:
    for name, body in macros.items():
        while (start := template.find(f"<{name}:")) >= 0:
            end = template.index(">", start)
            argument = template[start + len(name) + 2:end]
            template = template[:start] + body.format(argument) + template[end + 1:]
    return template


def sql(view: str) -> str:
    """DuckDB text of a view."""
    return _expand(_TEMPLATES[view], _DUCKDB).format(**{t: t for t in _TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; nothing is registered in the catalog."""
    text = _expand(_TEMPLATES[name], _SPARK)
    used = {t: table(spark, sf_dir, t) for t in _TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def full_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with their amenities and price quote as JSON text."""
    return (view(spark, sf_dir, "L").join(view(spark, sf_dir, "A"), "id", "left")
            .join(view(spark, sf_dir, "Q"), "id", "left"))
