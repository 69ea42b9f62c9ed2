"""Daily availability and its monthly and weekly summaries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posada import audit as steps
from posada.audit import Audit
from posada.fixed_values import LOOKUP_COLUMNS, PARTITION_COLUMNS
from posada.functions.dates import date_parts, iso_text, iso_week, iso_year, parse_date
from posada.functions.flags import certainly, from_tf
from posada.operators.dedup import duplicate_count, first_of_ranges, keep_first

KEYS = ["listing_id", "date"]
# Carried next to the daily rows until the summaries and the findings are made.
DATE, _NO_FLAG, _BAD_DATE = "_fecha", "_sin_dato", "_fecha_invalida"
_CARRIED = [DATE, _NO_FLAG, _BAD_DATE]


def clean_days(raw: DataFrame, order_by: list[str] | None = None,
               dedup_after_dates: bool = False) -> DataFrame:
    """One row per listing and date text, with flags, ISO date and calendar parts.

    Duplicates are found on the date as written unless dedup_after_dates is set, in which case two
    spellings of one day are one day.
    """
    df = raw
    if dedup_after_dates:
        day = F.coalesce(iso_text(parse_date(F.col("date"))), F.col("date"))
        df = df.withColumn("date", day)
    df = keep_first(df, KEYS, order_by)
    return _enriched(df.withColumn(DATE, parse_date(F.col("date"))))


def _enriched(parsed: DataFrame, ready: dict[str, Column] | None = None) -> DataFrame:
    """ready: calendar parts that are there already, under other names."""
    flag = from_tf(F.col("available"))
    return (parsed
            .withColumns({"disponible": certainly(flag), _NO_FLAG: flag.isNull(),
                          _BAD_DATE: F.col("date").isNotNull() & F.col(DATE).isNull()})
            .withColumns({"date": iso_text(F.col(DATE)), **date_parts(F.col(DATE)), **(ready or {})})
            .drop("available"))


def days_in_layout(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """clean_days in the layout of the stored table: by one exchange into ranges of its columns, and by one sort.

    Rows of one key have one parsed date, so they lie in one range, and the order of the layout followed by the
    date as written brings them together. Parsed dates have the order of their ISO texts within a month.
    """
    parsed = raw.withColumn(DATE, parse_date(F.col("date")))
    parts = date_parts(F.col(DATE))
    folders = {c: f"_{c}" for c in PARTITION_COLUMNS["calendar"]}
    layout = [*folders.values(), *[DATE if c == "date" else c for c in LOOKUP_COLUMNS["calendar"]]]
    ranges = parsed.withColumns({own: parts[c] for c, own in folders.items()}).repartitionByRange(*layout)
    unique = first_of_ranges(ranges, [*layout, "date"], order_by or [c for c in raw.columns if c not in KEYS])
    # The parts keep their order through a new name, so that a writer by folders need not sort again.
    return _enriched(unique, {c: F.col(own) for c, own in folders.items()}).drop(*folders.values())


def daily(days: DataFrame) -> DataFrame:
    return days.drop(*_CARRIED)


def monthly(days: DataFrame) -> DataFrame:
    """Per listing, calendar year and month; undated days and days without listing are left out."""
    free = F.sum(F.col("disponible").cast("long"))
    # Undated days make groups without a day. Leaving them out after the count, not by a filter on
    # the date, keeps the optimizer from parsing every date a second time below the deduplication.
    grouped = (days.where(F.col("listing_id").isNotNull())
               .groupBy("listing_id", "anio", "mes")
               .agg(F.count(DATE).alias("dias"), free.alias("dias_disponibles"),
                    F.avg("minimum_nights").alias("minimo_noches_promedio"))
               .where(F.col("dias") > 0))
    taken = F.col("dias") - F.col("dias_disponibles")
    return grouped.withColumns({"dias_no_disponibles": taken,
                                "tasa_no_disponible": taken / F.col("dias")})


def weekly(days: DataFrame) -> DataFrame:
    """Whole city per ISO year and week; the start is the first day seen, not the Monday."""
    date = F.col(DATE)
    grouped = (days.groupBy(iso_year(date).alias("anio"), iso_week(date).alias("semana"))
               .agg(F.min(date).alias("first"), F.count(date).alias("dias_registrados"),
                    F.count_distinct("listing_id").alias("alojamientos"),
                    F.sum(F.col("disponible").cast("long")).alias("dias_disponibles"))
               .where(F.col("dias_registrados") > 0))
    return grouped.select(
        "anio", "semana", iso_text(F.col("first")).alias("fecha_inicio"), "dias_registrados",
        "alojamientos", "dias_disponibles",
        (F.col("dias_disponibles") * 100 / F.col("dias_registrados")).alias("pct_disponible"))


def monthly_of_table(table: DataFrame) -> DataFrame:
    """monthly from the stored daily table."""
    return monthly(_dated(table))


def weekly_of_table(table: DataFrame) -> DataFrame:
    """weekly from the stored daily table."""
    return weekly(_dated(table))


def _dated(table: DataFrame) -> DataFrame:
    return table.withColumn(DATE, F.col("date").try_cast("date"))


def calendar_tables(days: DataFrame) -> dict[str, DataFrame]:
    return {"calendar": daily(days), "calendar_mensual": monthly(days),
            "calendar_semanal": weekly(days)}


def day_measures() -> dict[str, Column]:
    """Aggregates for the audit over clean_days, to be taken while it is written."""
    return {"filas": F.count(F.lit(1)), "sin_dato": F.count_if(_NO_FLAG),
            "fecha_invalida": F.count_if(_BAD_DATE), "sin_fecha": F.count_if(F.col(DATE).isNull())}


def audit_calendar(audit: Audit, raw_rows: int, seen: dict, monthly_rows: int, weekly_rows: int) -> None:
    """Steps and findings; `seen` are the day_measures."""
    rows = seen["filas"]
    audit.step(steps.STEP_DEDUP, "calendar", raw_rows, rows,
               f"clave {KEYS}, {raw_rows - rows} duplicados")
    audit.step(steps.STEP_DATES, "calendar", rows, rows, "columnas ['date']")
    audit.step(steps.STEP_DATE_PARTS, "calendar", rows, rows, steps.DATE_PARTS)
    audit.step(steps.STEP_MONTHLY, "calendar_mensual", rows, monthly_rows,
               "agrupado por listing_id, anio, mes")
    audit.step(steps.STEP_WEEKLY, "calendar_semanal", rows, weekly_rows, "agrupado por semana ISO")
    audit.finding("calendar", "duplicados", raw_rows - rows)
    audit.finding("calendar", "disponibilidad inválida", seen["sin_dato"])
    audit.finding("calendar", "fecha inválida", seen["fecha_invalida"])
    audit.finding("calendar", "sin fecha", seen["sin_fecha"])


def calendar_findings(raw: DataFrame, days: DataFrame) -> DataFrame:
    """The findings as one lazy row set: tabla, regla, n."""
    repeated = duplicate_count(raw, KEYS).select(F.lit("duplicados").alias("regla"),
                                                 F.col("duplicados").alias("n"))
    flags = days.agg(F.count_if(_NO_FLAG).alias("a"), F.count_if(_BAD_DATE).alias("b"),
                     F.count_if(F.col(DATE).isNull()).alias("c"))
    rules = flags.select(F.inline(F.array(
        F.struct(F.lit("disponibilidad inválida").alias("regla"), F.col("a").alias("n")),
        F.struct(F.lit("fecha inválida").alias("regla"), F.col("b").alias("n")),
        F.struct(F.lit("sin fecha").alias("regla"), F.col("c").alias("n")))))
    return repeated.union(rules).select(F.lit("calendar").alias("tabla"), "regla", "n")
