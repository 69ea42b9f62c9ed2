"""Dates kept as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from posada.fixed_values import MONTH_NAMES, WEEKDAY_NAMES
from posada.functions.text import strip

_CLOCK = r"(?:[T ](?:[01]?\d|2[0-3]):?[0-5]\d(?::?[0-5]\d(?:\.\d+)?)?(?: ?[AaPp][Mm])?(?:Z|[+-]\d{2}:?\d{2})?)?"

# Accepted numeric shapes. An ambiguous day and month is read month first, and day first only where
# the first number cannot be a month.
_SHAPES = [
    rf"(?<y1>\d{{4}})[-/.](?<m1>\d{{1,2}})[-/.](?<d1>\d{{1,2}}){_CLOCK}",
    rf"(?<y2>\d{{4}})(?<m2>\d{{2}})(?<d2>\d{{2}}){_CLOCK}",
    r"(?<m3>0?[1-9]|1[0-2])[-/.](?<d3>\d{1,2})[-/.](?<y3>\d{4})",
    r"(?<d4>\d{1,2})[-/.](?<m4>\d{1,2})[-/.](?<y4>\d{4})",
    r"(?<y5>\d{4})(?:[-/](?<m5>\d{2}))?(?<d5>)",
]
_ANY_SHAPE = f"^(?:{'|'.join(_SHAPES)})$"
# Only the groups of the matching shape hold text, so this is year-month-day for each of them.
_YEAR_MONTH_DAY = "-".join("".join(f"${{{part}{i}}}" for i in range(1, 6)) for part in "ymd")
_REARRANGED = r"^(\d{4}(?:-\d{1,2}){0,2})-*$"
# Years of two digits: 69 to 99 lie in the 1900s, 00 to 68 in the 2000s (the POSIX rule).
_SHORT_1900 = r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)$"
_SHORT_2000 = r"^(\d{1,2}/\d{1,2}/)([0-5]\d|6[0-8])$"

_MONTH_WORD = r"(?i)\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b"
_WORDED = "[MMM d, yyyy][MMMM d, yyyy][d MMM yyyy][d MMMM yyyy][d-MMM-yyyy][MMM yyyy][MMMM yyyy]"


def parse_date(text: Column) -> Column:
    """Text -> date; unknown shapes and impossible days are null.

    Nearly all rows are already yyyy-mm-dd, most others yyyy/mm/dd or yyyy.mm.dd: they take a cast without any
    regular expression, and the other shapes are only tried on what is left and holds a digit, as every shape does.
    """
    parted = (F.length(text) == 10) & (F.substring(text, 8, 1) == F.substring(text, 5, 1))
    iso = parted & (F.substring(text, 5, 1) == "-")
    # The cast also takes a 'T' at the end, which the shapes do not.
    other_sign = parted & F.substring(text, 5, 1).isin("/", ".") & F.substring(text, 10, 1).between("0", "9")
    full_year = F.regexp_replace(F.regexp_replace(strip(text), _SHORT_1900, "$119$2"), _SHORT_2000, "$120$2")
    rearranged = F.regexp_replace(full_year, _ANY_SHAPE, _YEAR_MONTH_DAY)
    any_shape = F.coalesce(
        F.regexp_extract(rearranged, _REARRANGED, 1).try_cast("date"),
        F.when(text.rlike(_MONTH_WORD), F.try_to_date(strip(text), _WORDED)))
    return F.coalesce(
        F.when(iso, text.try_cast("date")).when(other_sign, F.translate(text, "/.", "--").try_cast("date")),
        F.when(F.translate(text, "0123456789", "") != text, any_shape))


def iso_text(date: Column) -> Column:
    return date.cast("string")


def date_parts(date: Column) -> dict[str, Column]:
    """Calendar parts of a date column, with Spanish labels; a null date gives nulls."""
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    days = F.array(*[F.lit(d) for d in WEEKDAY_NAMES])
    return {
        "anio": F.year(date).cast("long"),
        "mes": F.month(date).cast("long"),
        "dia": F.day(date).cast("long"),
        "trimestre": F.quarter(date).cast("long"),
        # The explicit test is needed: a literal array reports its elements as never null, and a null
        # index would then come out as a label.
        "nombre_mes": F.when(date.isNotNull(), F.element_at(names, F.month(date))),
        "dia_semana": F.when(date.isNotNull(), F.element_at(days, F.weekday(date) + 1)),
    }


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date).cast("long")


def iso_week(date: Column) -> Column:
    return F.weekofyear(date).cast("long")


def year_month(date: Column) -> Column:
    """'2026-07'"""
    return F.substring(iso_text(date), 1, 7)


def nights(check_in: Column, check_out: Column) -> Column:
    return F.date_diff(check_out, check_in).cast("long")
