"""Guest reviews."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posada import audit as steps
from posada.audit import Audit
from posada.functions.dates import date_parts, iso_text, parse_date
from posada.functions.text import clean_text
from posada.operators.dedup import keep_first

DATE = "_fecha"
_BAD_DATE = "_fecha_invalida"


def unique_reviews(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    return keep_first(raw, ["id"], order_by)


def commented(reviews: DataFrame) -> DataFrame:
    """Only null comments go; a comment that is blank after cleaning stays."""
    return reviews.where(F.col("comments").isNotNull())


def dated(reviews: DataFrame) -> DataFrame:
    """With the date as a date, so that a staged table has it parsed once."""
    return reviews.withColumn(DATE, parse_date(F.col("date")))


def enrich(dated_reviews: DataFrame) -> DataFrame:
    """Clean text, comment length, ISO date and calendar parts."""
    return dated_reviews.withColumns({"comments": clean_text(F.col("comments")),
                                      "reviewer_name": clean_text(F.col("reviewer_name"))}) \
        .withColumns({"longitud_comentario": F.length("comments").cast("long"),
                      "date": iso_text(F.col(DATE)), **date_parts(F.col(DATE))}).drop(DATE)


def review_table(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    return enrich(dated(commented(unique_reviews(raw, order_by))))


def measured_reviews(dated_reviews: DataFrame) -> DataFrame:
    """enrich with what each row adds to the measures of the run; a null comment stays null."""
    return enrich(dated_reviews.withColumn(_BAD_DATE, _bad_date()))


def unique_measures(bad: Column | None = None) -> dict[str, Column]:
    """Aggregates for the audit over dated(unique_reviews), to be taken while it is written."""
    bad = _bad_date() if bad is None else bad
    return {"filas": F.count(F.lit(1)), "con_comentario": F.count("comments"), "fecha_invalida": F.count_if(bad)}


def clean_measures() -> dict[str, Column]:
    """The unique_measures, over measured_reviews."""
    return unique_measures(F.col(_BAD_DATE))


def _bad_date() -> Column:
    return F.col("comments").isNotNull() & F.col("date").isNotNull() & F.col(DATE).isNull()


def carried() -> list[str]:
    """The columns of measured_reviews that are no part of the table."""
    return [_BAD_DATE]


def audit_reviews(audit: Audit, raw_rows: int, seen: dict, orphans: int | None) -> None:
    """Steps and findings: `seen` are the unique_measures, orphans the rows of unknown listings."""
    unique, rows = seen["filas"], seen["con_comentario"]
    audit.step(steps.STEP_DEDUP, "reviews", raw_rows, unique,
               f"clave ['id'], {raw_rows - unique} duplicados")
    audit.step(steps.STEP_NO_COMMENT, "reviews", unique, rows)
    audit.step(steps.STEP_DATES, "reviews", rows, rows, "columnas ['date']")
    audit.step(steps.STEP_DATE_PARTS, "reviews", rows, rows, steps.DATE_PARTS)
    audit.finding("reviews", "duplicados", raw_rows - unique)
    audit.finding("reviews", "sin comentario", unique - rows)
    audit.finding("reviews", "fecha inválida", seen["fecha_invalida"])
    if orphans is not None:
        audit.finding("reviews", "alojamiento ausente", orphans)
