"""The calendar kept up to date batch by batch: only the months and ISO weeks that a batch touches are made again.

Raw days are kept in one folder per month of their date (undated ones in a folder of their own). All rows
that share a listing and a date text lie in one such folder, so removing duplicates month by month
gives what removing them over all rows gives. A batch that arrives twice only adds duplicates, so an
update that failed half-way can be run again.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posada.fixed_values import LOOKUP_COLUMNS
from posada.functions.dates import iso_week, iso_year, parse_date
from posada.plans import calendar
from posada.sinks.tables import read_table, write_table
from posada.staging import Stage, path_exists

MONTH = ["anio", "mes"]
_RAW_MONTH = ["_anio", "_mes"]


def _is_one_of(columns: list[str], pairs: list[tuple]) -> Column:
    """The year and its part are one of these pairs, or both null where one pair is. One number against a list,
    so that a long list costs no more than a short one and the folders of a table are chosen before it is read."""
    number = F.coalesce(F.col(columns[0]) * 100 + F.col(columns[1]), F.lit(-1))
    return number.isin([-1 if year is None else year * 100 + part for year, part in pairs])


def _months(days: DataFrame, columns: list[str]) -> list[tuple]:
    """Months with rows, as many as a calendar has."""
    return [tuple(r) for r in days.select(*columns).distinct().collect()]


def with_neighbours(months: list[tuple]) -> list[tuple]:
    """Months and those before and after, which an ISO week may reach into."""
    found = set()
    for year, month in months:
        if year is not None:
            at = year * 12 + month - 1
            found |= {((at + step) // 12, (at + step) % 12 + 1) for step in (-1, 0, 1)}
    return sorted(found)


def update_calendar(spark: SparkSession, batch: DataFrame, root: str, raw_root: str,
                    order_by: list[str] | None = None) -> dict[str, list[tuple]]:
    """Add raw days and make the touched parts of calendar, calendar_mensual and calendar_semanal under root
    again. Returns the months and the ISO weeks made."""
    path = {n: f"{root.rstrip('/')}/{n}" for n in ("calendar", "calendar_mensual", "calendar_semanal")}
    date = parse_date(F.col("date"))
    dated = batch.withColumns({"_anio": F.year(date), "_mes": F.month(date)})
    with Stage(spark) as stage:
        arrived = stage.put(dated, "batch")
        months = _months(arrived, _RAW_MONTH)
        arrived.repartitionByRange(*_RAW_MONTH, "listing_id", "date").write.mode("append") \
            .partitionBy(*_RAW_MONTH).parquet(raw_root)
        kept = spark.read.schema(arrived.schema).parquet(raw_root)
        raw = kept.where(_is_one_of(_RAW_MONTH, months)).select(*batch.columns)
        days = stage.put(calendar.clean_days(raw, order_by), "days")
        tables = {"calendar": calendar.daily(days), "calendar_mensual": calendar.monthly(days)}
        for name, df in tables.items():
            write_table(df, path[name], LOOKUP_COLUMNS[name], MONTH, only_these_partitions=True)

        # Weeks reach over the ends of months, so they are counted from the daily table as it is now.
        weeks = [(y, w) for y, w in _months(days.select(
            iso_year(F.col(calendar.DATE)).alias("anio"), iso_week(F.col(calendar.DATE)).alias("semana")),
            ["anio", "semana"]) if y is not None]
        daily = read_table(spark, path["calendar"], tables["calendar"].schema)
        near = daily.where(_is_one_of(MONTH, with_neighbours(months))).withColumn(calendar.DATE, F.col("date").cast("date"))
        made = calendar.weekly(near).where(_is_one_of(["anio", "semana"], weeks))
        if path_exists(spark, path["calendar_semanal"]):
            before = read_table(spark, path["calendar_semanal"], made.schema)
            made = before.where(~_is_one_of(["anio", "semana"], weeks)).unionByName(made)
        # One row per week; staged first, as the table is read while it is made.
        write_table(stage.put(made, "weeks"), path["calendar_semanal"], ["anio", "semana"])
    return {"meses": months, "semanas": weeks}
