"""Numeric text, money and number formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from posada.fixed_values import NO_PRICE, PRICE_CLASSES
from posada.functions.text import SPACE_CLASS

_NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf(?:inity)?))$"


def to_number(text: Column) -> Column:
    """Text -> double; anything that is not wholly a number is null.

    The pattern is needed because a plain cast also takes '12d' and 'NaN'.
    """
    return F.regexp_extract(F.trim(text), _NUMBER, 0).try_cast("double")


def money(text: Column) -> Column:
    """'$284,294.01' -> 284294.01; '$', ',' and any white space are removed first."""
    return to_number(F.regexp_replace(text, f"(?U)[$,{SPACE_CLASS}]", ""))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def price_class(price: Column) -> Column:
    label = None
    for name, low, high in PRICE_CLASSES:
        inside = (price >= F.lit(float(low))) & (price < F.lit(float(high)))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(NO_PRICE)


def integer_text(text: Column) -> Column:
    """'112727.0' and '00123' -> '112727' and '123'; other text is kept as it is."""
    value = F.trim(text)
    whole = F.when(value.rlike(r"^[+-]?\d+$"), value.try_cast("bigint"))
    number = to_number(text)
    from_decimal = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(whole.cast("string"), from_decimal.cast("string"), text)


def first_number(text: Column) -> Column:
    """First decimal number inside a text, or null."""
    return F.nullif(F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def format_es(value: Column, decimals: int = 0) -> Column:
    """19187 -> '19.187', 7.34 -> '7,3' (one decimal); rounding is half-even."""
    return F.translate(F.format_number(value, decimals), ",.", ".,")


def format_cop(value: Column) -> Column:
    return F.concat(F.lit("$"), format_es(value))


def log10_positive(value: Column) -> Column:
    return F.when(value > 0, F.log10(value))


def share(part: Column, whole: Column) -> Column:
    """part / whole, null when whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
