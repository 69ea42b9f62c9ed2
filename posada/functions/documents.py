"""JSON text inside a cell."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from posada.functions.dates import nights, parse_date
from posada.functions.numbers import to_number
from posada.functions.text import strip

_ARRAY = r"(?s)^\s*\[.*\]\s*$"
_QUOTE = ("quote struct<currency:string,is_available:boolean,discount_amount:string,"
          "requested_checkin_date:string,requested_checkout_date:string>")


def raw_list(text: Column) -> Column:
    """JSON array text -> array of its elements as they stand; anything else is empty."""
    parsed = F.when(text.rlike(_ARRAY), F.from_json(text, "array<string>"))
    return F.coalesce(parsed, F.array().cast("array<string>"))


def clean_list(text: Column) -> Column:
    """JSON array text -> stripped elements without blanks and nulls."""
    stripped = F.transform(raw_list(text), strip)
    return F.filter(stripped, lambda item: item.isNotNull() & (item != ""))


def is_broken_list(text: Column, items: Column | None = None) -> Column:
    """Text is there, yields no element and is not the empty array. items: its clean_list, if there is one."""
    items = clean_list(text) if items is None else items
    return text.isNotNull() & (F.size(items) == 0) & (text != "[]")


def quote_fields(text: Column) -> dict[str, Column]:
    """Currency, availability, discount and nights of a nested price quote."""
    quote = F.from_json(text, _QUOTE).getField("quote")
    return {
        "cotizacion_moneda": quote.getField("currency"),
        "cotizacion_disponible": quote.getField("is_available"),
        "cotizacion_descuento": to_number(quote.getField("discount_amount")),
        "cotizacion_noches": nights(parse_date(quote.getField("requested_checkin_date")),
                                    parse_date(quote.getField("requested_checkout_date"))),
    }


def nested_sample(text: Column, path: str, max_chars: int) -> Column:
    """Opening characters of one nested object, for a look at its shape."""
    return F.substring(F.get_json_object(text, path), 1, max_chars)


def as_document(columns: list[str]) -> Column:
    """Row -> JSON document; null fields are left out."""
    return F.to_json(F.struct(*columns))
