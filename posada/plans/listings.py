"""Listings, their hosts and their amenities."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posada import audit as steps
from posada.audit import Audit
from posada.fixed_values import (CLEANED_TEXT_COLUMNS, DEFAULTED_TEXT_COLUMNS, FLAG_COLUMNS,
                                 HOST_PREFIXES, IMPUTED_COLUMNS, LISTING_DATE_COLUMNS, NO_INFORMATION, NO_LICENSE,
                                 PRICE_COLUMNS, VALUELESS_COLUMNS)
from posada.functions import numbers, text
from posada.functions.dates import iso_text, parse_date
from posada.functions.documents import clean_list, is_broken_list
from posada.functions.flags import certainly, from_tf
from posada.functions.numbers import first_number, integer_text, money
from posada.operators.columns import drop_empty_columns, host_columns, is_boolean, is_numeric, present
from posada.operators.dedup import keep_first
from posada.operators.hosts import split_hosts
from posada.operators.impute import filled_quantiles, group_counts, group_medians, with_medians
from posada.operators.nested import add_amenity_count, amenity_pairs, flatten_quote
from posada.operators.nulls import null_cells_of_row
from posada.operators.outliers import fences
from posada.staging import Stage


def unique_listings(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    return keep_first(raw, ["id"], order_by)


def normalise_prices(df: DataFrame, columns: list[str] = PRICE_COLUMNS) -> DataFrame:
    return df.withColumns({
        c: F.col(c).cast("double") if is_numeric(df, c) else money(F.col(c))
        for c in present(df, columns)})


def convert_flags(df: DataFrame, columns: list[str] = FLAG_COLUMNS) -> DataFrame:
    return df.withColumns({c: from_tf(F.col(c)) for c in present(df, columns)
                           if not is_boolean(df, c)})


def standardise_dates(df: DataFrame, columns: list[str] = LISTING_DATE_COLUMNS) -> DataFrame:
    return df.withColumns({c: iso_text(parse_date(F.col(c).cast("string")))
                           for c in present(df, columns)})


def bathroom_number(df: DataFrame) -> Column:
    """Stated number, else the number in the text ('half' alone is 0.5)."""
    words = F.lower("bathrooms_text")
    stated = F.coalesce(first_number(words), F.when(text.holds(words, "half"), 0.5))
    return F.coalesce(*[F.col(c).cast("double") for c in present(df, ["bathrooms"])], stated)


def convert_bathrooms(df: DataFrame) -> DataFrame:
    """bathrooms completed from its text, and the shared flag."""
    if "bathrooms_text" not in df.columns:
        return df
    return df.withColumns({"bathrooms": bathroom_number(df),
                           "bano_compartido": text.holds(F.lower("bathrooms_text"), "shared")})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Missing values that have a meaning; prices and review scores stay null."""
    new = {}
    if "number_of_reviews" in df.columns:
        new["tiene_reviews"] = certainly(F.col("number_of_reviews") > 0)
    if "reviews_per_month" in df.columns:
        new["reviews_per_month"] = F.coalesce(F.col("reviews_per_month").cast("double"), F.lit(0.0))
    if "license" in df.columns:
        new["tiene_licencia"] = F.col("license").isNotNull()
        new["license"] = text.or_default(integer_text(F.col("license").cast("string")), NO_LICENSE)
    if {"has_availability", "availability_365"} <= set(df.columns):
        stated = F.col("has_availability")
        known = stated if is_boolean(df, "has_availability") else from_tf(stated)
        new["has_availability"] = F.coalesce(known, F.col("availability_365") > 0, F.lit(False))
    for c in present(df, DEFAULTED_TEXT_COLUMNS):
        new[c] = text.or_default(F.col(c).cast("string"), NO_INFORMATION)
    return df.withColumns(new) if new else df


def standardise_text(df: DataFrame) -> DataFrame:
    new = {c: text.clean_text(F.col(c)) for c in present(df, CLEANED_TEXT_COLUMNS)}
    if "neighbourhood_cleansed" in df.columns:
        new["neighbourhood_cleansed"] = text.title_case(
            text.clean_text(F.col("neighbourhood_cleansed")))
    if "host_location" in df.columns:
        new["host_location"] = text.replace_word(text.clean_text(F.col("host_location")),
                                                 "Bogota", "Bogotá")
    return df.withColumns(new) if new else df


def quality_flags(df: DataFrame, price_outlier: Column | None = None) -> DataFrame:
    """Price class and the quality flags whose source columns are present."""
    new = {}
    if "price" in df.columns:
        new["categoria_precio"] = numbers.price_class(F.col("price"))
        if price_outlier is not None:
            new["es_outlier_precio"] = price_outlier
    if "minimum_nights" in df.columns:
        new["es_estancia_larga"] = certainly(F.col("minimum_nights") >= 30)
    if "availability_365" in df.columns:
        new["sin_disponibilidad_anual"] = certainly(F.col("availability_365") == 0)
    return df.withColumns(new) if new else df


#: Columns that only the measures of a run read; they are not part of the table.
_CELLS, _CELLS_AFTER, _BAD_DATES, _BROKEN = "_nulos", "_nulos_despues", "_fechas_malas", "_lista_rota"
_LIST = "_lista"
_MISSING, _GIVEN = "_falta_", "_dada_"


def clean_listings(unique: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Every cleaning step on already unique listings; amenities and host columns still inside.

    All steps are row-wise expressions, so the wide rows are not shuffled again: counts, medians and
    quartiles are aggregated apart over the columns they need and come back as small values. `unique`
    is scanned several times for them and should be a staged table.
    """
    clean = measured_listings(unique, stage)
    return clean.drop(*carried(clean))


def carried(clean: DataFrame) -> list[str]:
    """The columns of measured_listings that are no part of the table."""
    return [c for c in clean.columns
            if c in (_CELLS, _CELLS_AFTER, _BAD_DATES, _BROKEN, _LIST) or c.startswith(_MISSING)]


def with_read_lists(clean: DataFrame) -> DataFrame:
    """measured_listings with the amenities as they were read from their text, so that a staged table has
    them read once."""
    return clean.withColumn("amenities", F.col(_LIST)).drop(_LIST) if _LIST in clean.columns else clean


def measured_listings(unique: DataFrame, stage: Stage | None = None, held: dict | None = None) -> DataFrame:
    """clean_listings with what each row adds to the measures of the run (see `measures`).

    held: the unique_measures of `unique`, if the stage that wrote it has taken them.
    """
    held = held or unique.agg(*[c.alias(n) for n, c in unique_measures(unique).items()]).first()
    rows = held["_rows"]
    empty = [c for c in unique.columns if rows and held[c] == 0]
    df = unique.drop(*empty, *VALUELESS_COLUMNS)
    dates = present(df, LISTING_DATE_COLUMNS)
    given = {_GIVEN + c: F.col(c).isNotNull() for c in dates}
    lists = {_LIST: clean_list(F.col("amenities"))} if "amenities" in df.columns else {}
    df = convert_flags(flatten_quote(normalise_prices(df.withColumns({**given, **lists}))))
    df = standardise_dates(df)
    # Texts that were given and are no dates now.
    bad = sum(((F.col(_GIVEN + c)) & F.col(c).isNull()).cast("long") for c in dates) if dates else F.lit(0)
    broken = is_broken_list(F.col("amenities"), F.col(_LIST)) if lists else F.lit(False)
    df = convert_bathrooms(df.withColumns({_BAD_DATES: bad, _BROKEN: broken}).drop(*given))
    table = [c for c in df.columns if c not in carried(df)]
    watched = present(df, [*IMPUTED_COLUMNS, "has_availability", "price"])
    df = df.withColumns({_CELLS: null_cells_of_row(table),
                         **{_MISSING + c: F.col(c).isNull() for c in watched}})

    # A complete column keeps its type and needs no median.
    completed = "_bathrooms" if "bathrooms_text" in df.columns else "bathrooms"
    incomplete = [c for c in present(df, IMPUTED_COLUMNS)
                  if held[completed if c == "bathrooms" else c] < rows]
    df = df.withColumns({c: F.col(c).cast("double") for c in incomplete})
    measured = incomplete + present(df, ["price"])
    quartiles = {}
    if measured:
        # One read of the few columns that are needed counts their values; the rest is made from the counts.
        group = "room_type" if "room_type" in df.columns else None
        keep = (lambda x, name: x) if stage is None else stage.put
        counts = keep(group_counts(df, measured, group), "value_counts")
        medians = keep(group_medians(counts), "medians")
        quartiles = {r["columna"]: r["q"] for r in
                     filled_quantiles(counts, medians, incomplete, [0.25, 0.5, 0.75]).collect()}
        df = with_medians(df, incomplete, group, medians) if group and incomplete else df
    overall = {c: quartiles[c][1] for c in incomplete if c in quartiles}
    df = fill_defaults(df.fillna(overall) if overall else df)
    df = df.withColumn(_CELLS_AFTER, null_cells_of_row([c for c in df.columns if c not in carried(df)]))
    return quality_flags(standardise_text(df), _outside_fences(df, quartiles))


def measures(clean: DataFrame) -> dict[str, Column]:
    """Aggregates over measured_listings for the audit, to be taken while it is written."""
    missing = [c for c in carried(clean) if c.startswith(_MISSING)]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return {"filas": F.count(F.lit(1)), "antes": total(_CELLS), "despues": total(_CELLS_AFTER),
            "fechas": total(_BAD_DATES), "rotas": F.count_if(_BROKEN),
            **{c.removeprefix(_MISSING): F.count_if(c) for c in missing}}


def unique_measures(unique: DataFrame) -> dict[str, Column]:
    """Aggregates: rows, values per column, and bathrooms once completed from their text."""
    after_text = {"_bathrooms": F.count(bathroom_number(unique))} if "bathrooms_text" in unique.columns else {}
    return {"_rows": F.count(F.lit(1)), **{c: F.count(c) for c in unique.columns}, **after_text}


def _outside_fences(df: DataFrame, quartiles: dict[str, list[float]]) -> Column | None:
    if "price" not in df.columns:
        return None
    if "price" not in quartiles:
        return F.lit(False)
    low, high = fences(F.lit(quartiles["price"][0]), F.lit(quartiles["price"][2]))
    return certainly((F.col("price") < low) | (F.col("price") > high))


def listing_tables(clean: DataFrame) -> dict[str, DataFrame]:
    amenities = amenity_pairs(clean, unique_ids=True)
    listings, hosts = split_hosts(add_amenity_count(clean), ["id"])
    return {"listings": listings, "hosts": hosts, "listing_amenities": amenities}


def host_table(unique: DataFrame) -> DataFrame:
    """The hosts alone, from already unique listings: no medians or quartiles are needed for them."""
    df = drop_empty_columns(unique.select("id", "host_id", *host_columns(unique)))
    return split_hosts(standardise_text(fill_defaults(standardise_dates(convert_flags(df)))), ["id"])[1]


def audit_listings(audit: Audit, raw_rows: int, held: dict, clean_columns: list[str], seen: dict,
                   host_rows: int, amenity_rows: int, amenity_kinds: int) -> None:
    """Steps and findings, from what the staging writes took: `held` are the unique_measures, `seen` the
    measures of the clean table. The rest are rows written."""
    rows = seen["filas"]
    unique_columns = [c for c in held if c not in ("_rows", "_bathrooms")]
    same = (rows, rows)
    audit.step(steps.STEP_DEDUP, "listings", raw_rows, rows,
               f"clave ['id'], {raw_rows - rows} duplicados")
    flattened = "cotizacion_moneda" in clean_columns
    gone = [c for c in unique_columns
            if c not in clean_columns and not (flattened and c == "price_quote_raw")]
    empty = [c for c in unique_columns if rows and held[c] == 0]
    audit.step(steps.STEP_DROP_COLUMNS, "listings", *same, f"{len(gone)} columnas: {gone}")
    audit.step(steps.STEP_PRICES, "listings", *same, "texto a número")
    if flattened:
        audit.step(steps.STEP_QUOTE, "listings", *same, "moneda, disponibilidad, descuento y noches")
    audit.step(steps.STEP_DATES, "listings", *same,
               f"columnas {[c for c in LISTING_DATE_COLUMNS if c in clean_columns]}")
    audit.step(steps.STEP_NULLS, "listings", *same, f"celdas nulas {seen['antes']} -> {seen['despues']}")
    audit.step(steps.STEP_TEXT, "listings", *same, "espacios, etiquetas y formato título")
    audit.step(steps.STEP_FLAGS, "listings", *same, "categoría de precio y marcas")
    audit.step(steps.STEP_AMENITIES, "listing_amenities", rows, amenity_rows,
               f"{amenity_kinds} amenities distintas")
    hosts = [c for c in clean_columns if c.startswith(tuple(HOST_PREFIXES)) and c != "host_id"]
    audit.step(steps.STEP_HOSTS, "hosts", rows, host_rows, f"{len(hosts)} columnas de anfitrión")
    audit.finding("listings", "duplicados", raw_rows - rows)
    audit.finding("listings", "columnas vacías", len(empty))
    for c in IMPUTED_COLUMNS:
        if c in seen:
            audit.finding("listings", f"imputados en {c}", seen[c])
    for c, rule in (("has_availability", "disponibilidad deducida"), ("price", "sin precio")):
        if c in seen:
            audit.finding("listings", rule, seen[c])
    if "amenities" in unique_columns:
        audit.finding("listings", "amenities ilegibles", seen["rotas"])
    if any(c in clean_columns for c in LISTING_DATE_COLUMNS):
        audit.finding("listings", "fecha inválida", seen["fechas"])
