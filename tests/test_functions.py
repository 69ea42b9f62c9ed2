import datetime
import json

import pytest
from pyspark.sql import functions as F

from posada.functions import dates, documents, flags, numbers, text


def test_money_removes_symbols(column_of):
    amounts = [cents / 100 for cents in range(7, 80_000_000, 9_876_543)]
    assert column_of([f" ${a:,.2f}" for a in amounts], numbers.money) == amounts
    got = column_of([None, "free", "$ 5", "-$3.5", "12d", "NaN", "1e5", ".5", "5.", "1_000", "0x10",
                     "--1", "inf"], numbers.money)
    assert got == [None, None, 5.0, -3.5, None, None, 1e5, 0.5, 5.0, None, None, None, float("inf")]


def test_price_class_edges(column_of):
    edges = {100_000.0: ("Económico", "Medio"), 200_000.0: ("Medio", "Alto"),
             400_000.0: ("Alto", "Lujo")}
    for edge, (below, at) in edges.items():
        assert column_of([edge - 0.01, edge], numbers.price_class, "double") == [below, at]
    assert column_of([None, 0.0, -1.0, float("inf")], numbers.price_class, "double") == [
        "Sin precio", "Económico", "Sin precio", "Sin precio"]


def test_integer_text(column_of):
    got = column_of(["permit B-7", "4410.0", None, "0008", "3.25", "9007199254740993", " 6 "],
                    numbers.integer_text)
    assert got == ["permit B-7", "4410", None, "8", "3.25", "9007199254740993", "6"]


def test_number_formats(column_of):
    assert column_of([52034.0, 700002.5, 0.0], numbers.format_es, "double") == [
        "52.034", "700.002", "0"]
    assert column_of([8.16, -4321.25], lambda x: numbers.format_es(x, 1), "double") == ["8,2", "-4.321,2"]
    assert column_of([3008070.0], numbers.format_cop, "double") == ["$3.008.070"]


def test_log_is_null_without_a_positive_value(column_of):
    assert column_of([100.0, 0.0, -1.0, None], numbers.log10_positive, "double") == [
        2.0, None, None, None]


def test_clean_text(column_of):
    got = column_of(["\tpatio<br />con \n sol ", None, "p<br\u00a0/>q\x1cr<BR>", "<br/>", ""], text.clean_text)
    assert got == ["patio con sol", None, "p q r<BR>", "", ""]


def test_clean_text_takes_very_long_runs(column_of):
    assert column_of(["a" + "<br>\n" * 100_000 + "b"], text.clean_text) == ["a b"]


def test_clean_text_equals_two_step_python(column_of):
    import random
    import re
    rng = random.Random(5)
    parts = ["<br>", "<br/>", "<br />", "<", "br", ">", "/", " ", "\n", "\t", " ", " ", "\x1d",
             "\x85", "a", "é", "<b<br>r>"]
    samples = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(2000)]
    want = [re.sub(r"\s+", " ", re.sub(r"<br\s*/?>", " ", s)).strip() for s in samples]
    assert column_of(samples, text.clean_text) == want


def test_title_case_equals_python(column_of):
    samples = ["chapinero", "o'neil santa-fe 3rd", "LA CANDELARIA", "ñandú ÉL", "中abc", "", "_x_y"]
    assert column_of(samples, text.title_case) == [s.title() for s in samples]


def test_title_case_keeps_characters_of_two_code_units(column_of):
    samples = ["\U0001f600sol y \U0001f600mar", "\U00020000x", None]
    assert column_of(samples, text.title_case) == ["\U0001f600Sol Y \U0001f600Mar", "\U00020000X", None]


def test_whole_word_replacement(column_of):
    got = column_of(["Bogota, Colombia", "Bogotano", "xBogota", "Bogotaé", None],
                    lambda x: text.replace_word(x, "Bogota", "Bogotá"))
    assert got == ["Bogotá, Colombia", "Bogotano", "xBogota", "Bogotaé", None]


def test_flags(column_of):
    assert column_of(["t", "f", None, "T"], flags.from_tf) == [True, False, None, None]
    assert column_of(["t", None], lambda x: flags.certainly(x == "t")) == [True, False]


def test_first_number(column_of):
    got = column_of([f"{n / 4} or 9 rooms" for n in range(12)] + ["none", None], numbers.first_number)
    assert got == [n / 4 for n in range(12)] + [None, None]


@pytest.mark.parametrize("value, want", [
    ("2031-11-09", "2031-11-09"), ("1998/02/17", "1998-02-17"), ("soon", None), (None, None),
    ("2026-7-1", "2026-07-01"), ("20260622", "2026-06-22"), ("2026-07-01T10:00:00", "2026-07-01"),
    ("2026-07-01 10:00", "2026-07-01"), ("2026-06-22 10:00 PM", "2026-06-22"), ("03/04/99", "1999-03-04"),
    ("03/04/68", "2068-03-04"), ("03/04/2026", "2026-03-04"), ("25/12/2026", "2026-12-25"),
    ("3/4/26", "2026-03-04"), ("2026", "2026-01-01"), ("2026-07", "2026-07-01"),
    ("Jan 5, 2026", "2026-01-05"), ("5 January 2026", "2026-01-05"), (" 2026-07-01 ", "2026-07-01"),
    ("2026-02-30", None), ("2026/13/01", None), ("", None), ("2026-07-01 foo", None),
    ("2026-07-01T25:00:00", None), ("5-Jan-2026", "2026-01-05"), ("2026-07-1x", None)])
def test_parse_date(column_of, value, want):
    got = column_of([value], lambda x: dates.iso_text(dates.parse_date(x)))
    assert got == [want]


def test_date_parts(spark):
    rows = spark.createDataFrame([("2024-02-29",), ("2031-11-08",), (None,)], "x string")
    date = rows.select(dates.parse_date(F.col("x")).alias("d"))
    got = [tuple(r) for r in date.select(*[c.alias(n) for n, c in
                                           dates.date_parts(F.col("d")).items()]).collect()]
    assert got == [(2024, 2, 29, 1, "Febrero", "Jueves"), (2031, 11, 8, 4, "Noviembre", "Sábado"),
                   (None,) * 6]


def test_iso_year_differs_from_calendar_year(column_of):
    day = [datetime.date(2027, 1, 1)]
    assert column_of(day, dates.iso_year, "date") == [2026]
    assert column_of(day, dates.iso_week, "date") == [53]


def test_json_lists(column_of):
    samples = ['["Sauna", "Desk"]', '["Iron"]', None, "[cut", "[]", '["  Desk", "", "Desk "]', '["a"] x',
               '{"a": 1}', '["a", null, 3]', "[ ]", '[""]']
    assert column_of(samples, documents.clean_list) == [
        ["Sauna", "Desk"], ["Iron"], [], [], [], ["Desk", "Desk"], [], [], ["a", "3"], [], []]
    assert column_of(samples, documents.is_broken_list) == [
        False, False, False, True, False, False, True, True, False, True, True]


def test_quote_fields(spark):
    quote = {"quote": {"currency": "EUR", "is_available": False, "discount_amount": "64.25",
                       "requested_checkin_date": "2031-12-28",
                       "requested_checkout_date": "2032-01-03"}}
    number = {"quote": {"currency": "COP", "discount_amount": 12.5}}
    rows = spark.createDataFrame(
        [(1, json.dumps(quote)), (2, None), (3, '{"quote": null}'), (4, '{"quote": "x"}'), (5, "[1]"),
         (6, "no json"), (7, json.dumps(number))], "i int, x string")
    got = {r[0]: tuple(r)[1:] for r in rows.select(
        "i", *[c.alias(n) for n, c in documents.quote_fields(F.col("x")).items()]).collect()}
    assert got[1] == ("EUR", False, 64.25, 6)
    assert all(got[i] == (None,) * 4 for i in (2, 3, 4, 5, 6))
    assert got[7] == ("COP", None, 12.5, None)


def test_documents_leave_null_fields_out(spark):
    rows = spark.createDataFrame([(1, None), (2, "a")], "id int, v string")
    got = [r[0] for r in rows.select(documents.as_document(["id", "v"])).collect()]
    assert got == ['{"id":1}', '{"id":2,"v":"a"}']


def test_dates_with_other_signs_take_no_pattern_but_give_the_same(column_of):
    texts = ["2031/01/02", "2031.12.31", "2031/02/30", "2031/01/1T", "2031.01-02", "2031/01/1 ", "fecha-mala", "a/b/c/d/e/", "", None,
             "Jan 5, 2031", "20310102", "2031/1/2", "1/2/2031"]
    day = lambda m, d: datetime.date(2031, m, d)
    assert column_of(texts, dates.parse_date) == [day(1, 2), day(12, 31), None, None, day(1, 2), day(1, 1), None, None, None, None,
                                            day(1, 5), day(1, 2), day(1, 2), day(1, 2)]
