"""Whole tables over rows drawn by the tests, against plain computations in Python."""

import datetime
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from posada.audit import Audit
from posada.plans import calendar, listings, profile, reviews, run
from posada.plans.calendar_update import update_calendar, with_neighbours
from posada.sinks.tables import read_table, read_tables
from posada.sources.landing import land_all
from posada.staging import Stage, path_exists

DAYS = "listing_id long, date string, available string, minimum_nights long"
MONTHS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre",
          "Diciembre"]


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


def drawn_days(seed, n, listings_=30, first=datetime.date(2031, 11, 20), span=80):
    """Days in two spellings, some unreadable, some without listing, with repeats."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        day = first + datetime.timedelta(draw.randrange(span))
        text = draw.choice([day.isoformat()] * 6 + [day.strftime("%Y/%m/%d"), "soon", None])
        rows.append((draw.choice([None, *range(listings_)]), text, draw.choice(["t", "f", "f", "x", None]), draw.randint(1, 9)))
    return rows


def plain_days(rows):
    """(listing, day or None, free, minimum) of the first row of each listing and date text, by the other columns."""
    low = lambda v: (v is None, v if v is not None else 0)
    first = {}
    for row in sorted(rows, key=lambda r: (r[2] is None, r[2] or "", low(r[3]))):
        first.setdefault(row[:2], row)
    out = []
    for listing, text, flag, minimum in first.values():
        readable = text and text != "soon"
        out.append((listing, datetime.date.fromisoformat(text.replace("/", "-")) if readable else None, flag == "t", minimum))
    return out


def plain_monthly(rows):
    held = defaultdict(list)
    for listing, day, free, minimum in plain_days(rows):
        if day and listing is not None:
            held[listing, day.year, day.month].append((free, minimum))
    return sorted((*key, len(v), sum(f for f, _ in v), pytest.approx(statistics.mean(m for _, m in v)), len(v) - sum(f for f, _ in v),
                   pytest.approx(1 - sum(f for f, _ in v) / len(v))) for key, v in held.items())


def plain_weekly(rows):
    held = defaultdict(list)
    for listing, day, free, _ in plain_days(rows):
        if day:
            held[day.isocalendar()[:2]].append((day, listing, free))
    return sorted((*key, min(d for d, _, _ in v).isoformat(), len(v), len({i for _, i, _ in v if i is not None}),
                   sum(f for *_, f in v), pytest.approx(100 * sum(f for *_, f in v) / len(v))) for key, v in held.items())


def test_calendar_equals_plain_version(spark):
    rows = drawn_days(1, 2500)
    tables = calendar.calendar_tables(calendar.clean_days(spark.createDataFrame(rows, DAYS)))
    daily = tables["calendar"]
    assert daily.columns == ["listing_id", "date", "minimum_nights", "disponible", "anio", "mes", "dia", "trimestre", "nombre_mes",
                             "dia_semana"]
    want = Counter((i, d and d.isoformat(), m, f, d and MONTHS[d.month - 1]) for i, d, f, m in plain_days(rows))
    assert Counter(map(tuple, daily.select("listing_id", "date", "minimum_nights", "disponible", "nombre_mes").collect())) == want
    assert daily.where("date IS NULL AND (nombre_mes IS NOT NULL OR dia_semana IS NOT NULL)").isEmpty()
    assert tables["calendar_mensual"].columns == ["listing_id", "anio", "mes", "dias", "dias_disponibles", "minimo_noches_promedio",
                                                  "dias_no_disponibles", "tasa_no_disponible"]
    assert rows_of(tables["calendar_mensual"]) == plain_monthly(rows)
    assert tables["calendar_semanal"].columns == ["anio", "semana", "fecha_inicio", "dias_registrados", "alojamientos",
                                                  "dias_disponibles", "pct_disponible"]
    assert rows_of(tables["calendar_semanal"]) == plain_weekly(rows)


def test_two_spellings_of_a_day(spark):
    raw = spark.createDataFrame([(8, "2033-02-11", "t", 4), (8, "2033/02/11", "f", 4)], DAYS)
    assert calendar.clean_days(raw).count() == 2
    assert calendar.clean_days(raw, dedup_after_dates=True).count() == 1


def test_one_listing_with_most_days(spark):
    """Sums over months and weeks equal the dated daily rows, also with one very large listing."""
    raw = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 500).alias("listing_id"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 700).cast("int"))
        .cast("string").alias("date"),
        F.when(F.col("id") % 4 == 0, "t").otherwise("f").alias("available"),
        (F.col("id") % 9).alias("minimum_nights"))
    days = calendar.clean_days(raw)
    tables = calendar.calendar_tables(days)
    total = tables["calendar"].count()
    assert total == raw.select("listing_id", "date").distinct().count()
    assert tables["calendar_mensual"].agg(F.sum("dias")).first()[0] == total
    assert tables["calendar_semanal"].agg(F.sum("dias_registrados")).first()[0] == total


# ------------------------------------------------------------------ updates

def files_of(spark, path):
    return {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}


def test_updates_equal_a_full_run_and_leave_other_months_alone(spark, tmp_path):
    batches = [drawn_days(5, 900), drawn_days(6, 300, first=datetime.date(2032, 1, 25), span=12), drawn_days(5, 900)[:50]]
    root, raw_root = str(tmp_path / "out"), str(tmp_path / "raw")
    schemas = {}
    for i, batch in enumerate(batches):
        before = files_of(spark, f"{root}/calendar") if i else set()
        done = update_calendar(spark, spark.createDataFrame(batch, DAYS), root, raw_root)
        if i == 1:
            assert set(done["meses"]) == {(None, None), (2032, 1), (2032, 2)}
            kept = {f for f in before if "anio=2031" in f}
            assert kept and kept <= files_of(spark, f"{root}/calendar")
    rows = [r for b in batches for r in b]
    full = calendar.calendar_tables(calendar.clean_days(spark.createDataFrame(rows, DAYS)))
    for name, df in full.items():
        back = read_table(spark, f"{root}/{name}", df.schema)
        assert Counter(map(str, back.collect())) == Counter(map(str, df.collect()))
        schemas[name] = back.columns
    assert schemas["calendar_mensual"] == full["calendar_mensual"].columns


def test_neighbouring_months():
    assert with_neighbours([(2030, 1), (None, None)]) == [(2029, 12), (2030, 1), (2030, 2)]


# ------------------------------------------------------------------ reviews

REVIEWS = "listing_id long, id long, date string, reviewer_id long, reviewer_name string, comments string"


def drawn_reviews(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        body = draw.choice([None, "<br/>", " calm\t street ", "x<br>y", "plain words"])
        date = draw.choice([f"20{draw.randint(10, 29)}-0{draw.randint(1, 9)}-1{draw.randint(0, 9)}", "later", None])
        rows.append((draw.choice([None, *range(40)]), i // 2 if draw.random() < 0.2 else 1000 + i, date, i % 7, f" N{i % 5} ", body))
    return rows


def plain_reviews(rows):
    first = {}
    low = lambda v: (v is None, v if v is not None else 0)
    for r in sorted(rows, key=lambda r: (low(r[0]), (r[2] is None, r[2] or ""), low(r[3]), r[4], (r[5] is None, r[5] or ""))):
        first.setdefault(r[1], r)
    return list(first.values())


def test_reviews_equal_plain_version(spark):
    rows = drawn_reviews(3, 600)
    table = reviews.review_table(spark.createDataFrame(rows, REVIEWS))
    assert table.columns == ["listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments", "longitud_comentario", "anio",
                             "mes", "dia", "trimestre", "nombre_mes", "dia_semana"]
    want = Counter()
    for listing, key, date, _, name, body in plain_reviews(rows):
        if body is not None:
            text = " ".join(body.replace("<br/>", " ").replace("<br>", " ").split())
            day = None if date in (None, "later") else date
            want[listing, key, day, name.strip(), text, len(text), day and int(day[:4])] += 1
    got = table.select("listing_id", "id", "date", "reviewer_name", "comments", "longitud_comentario", "anio").collect()
    assert Counter(map(tuple, got)) == want


# ------------------------------------------------------------------ listings

LISTINGS = """id long, host_id long, host_name string, host_location string, room_type string, bedrooms double, beds double,
bathrooms_text string, price string, minimum_nights long, availability_365 long, number_of_reviews long,
reviews_per_month double, description string, license string, neighbourhood_cleansed string, amenities string,
last_scraped string, has_availability string, picture_url string, nothing string"""


def drawn_listings(seed, n):
    draw = random.Random(seed)
    maybe = lambda v, share=0.2: None if draw.random() < share else v
    rows = []
    for i in range(n):
        host = draw.randrange(n // 4)
        rows.append((
            i, host, f"h{host}", maybe(draw.choice(["Bogota", "Lima"])), maybe(draw.choice(["whole", "room", "shared"]), 0.1),
            maybe(float(draw.randint(0, 5))), maybe(float(draw.randint(1, 6))), maybe(draw.choice(["2 baths", "Half-bath", "1.5 shared baths"])),
            maybe(f"${draw.randint(20, 900) * 1000:,}.00"), maybe(draw.choice([1, 2, 30])), draw.choice([0, 10, 365]), draw.choice([0, 4]),
            maybe(1.5), maybe(draw.choice([" a  b", "c"])), maybe(draw.choice(["0012", "RNT 7", "9.0"])), draw.choice(["la paz", "norte"]),
            maybe(draw.choice(['["Desk"," Desk","Iron"]', "[]", "{", '["Pool"]'])), draw.choice(["2030-01-02", "2030/01/03", "never", None]),
            draw.choice(["t", "f", None]), "p", None))
    return rows


def medians_filled(rows, at, group):
    """Plain imputation: the median of the row's group, then that of the column as filled."""
    values = [r[at] for r in rows]
    by = defaultdict(list)
    for r in rows:
        if r[at] is not None and r[group] is not None:
            by[r[group]].append(r[at])
    filled = [v if v is not None else statistics.median(by[r[group]]) if by.get(r[group]) else None for v, r in zip(values, rows)]
    rest = statistics.median([v for v in filled if v is not None])
    return [rest if v is None else v for v in filled]


def test_listings_equal_plain_version(spark):
    rows = drawn_listings(9, 400)
    raw = spark.createDataFrame(rows + rows[:30], LISTINGS)
    with Stage(spark) as stage:
        unique = stage.put(listings.unique_listings(raw), "unique")
        tables = listings.listing_tables(listings.clean_listings(unique, stage))
        got = {r["id"]: r for r in tables["listings"].collect()}
        hosts = {r["host_id"]: r for r in tables["hosts"].collect()}
        pairs = Counter(map(tuple, tables["listing_amenities"].collect()))
    assert len(got) == len(rows) and not {"picture_url", "nothing", "host_name", "amenities"} & set(tables["listings"].columns)
    bedrooms, nights = medians_filled(rows, 5, 4), medians_filled(rows, 9, 4)
    bands = [("Económico", 0, 100_000), ("Medio", 100_000, 200_000), ("Alto", 200_000, 400_000), ("Lujo", 400_000, float("inf"))]
    baths = {None: None, "2 baths": 2.0, "Half-bath": 0.5, "1.5 shared baths": 1.5}
    items = {'["Desk"," Desk","Iron"]': ["Desk", "Desk", "Iron"], '["Pool"]': ["Pool"]}
    for i, row in enumerate(rows):
        one = got[i]
        price = None if row[8] is None else float(row[8].strip("$").replace(",", ""))
        assert one["price"] == price and (one["bedrooms"], one["minimum_nights"]) == (bedrooms[i], nights[i])
        assert one["categoria_precio"] == next((n for n, a, b in bands if price is not None and a <= price < b), "Sin precio")
        assert row[7] is None or one["bathrooms"] == baths[row[7]]
        assert one["bano_compartido"] == (row[7] is not None and "shared" in row[7])
        assert one["reviews_per_month"] == (row[12] or 0.0) and one["tiene_reviews"] == (row[11] > 0)
        assert one["description"] == {None: "Sin información", " a  b": "a b", "c": "c"}[row[13]]
        assert one["license"] == {None: "Sin registro", "0012": "12", "RNT 7": "RNT 7", "9.0": "9"}[row[14]]
        assert one["neighbourhood_cleansed"] == row[15].title()
        assert one["cantidad_amenities"] == len(items.get(row[16], []))
        assert one["last_scraped"] == {"2030-01-02": "2030-01-02", "2030/01/03": "2030-01-03"}.get(row[17])
        assert one["has_availability"] == (row[18] == "t" if row[18] else row[10] > 0)
        assert one["es_estancia_larga"] == (nights[i] >= 30) and one["sin_disponibilidad_anual"] == (row[10] == 0)
    assert pairs == Counter((r[0], a) for r in rows for a in set(items.get(r[16], [])))
    first = {}
    for row in rows:
        first.setdefault(row[1], row)
    assert {h: r["host_location"] for h, r in hosts.items()} == {
        h: {"Bogota": "Bogotá", "Lima": "Lima", None: "Sin información"}[r[3]] for h, r in first.items()}


def test_listings_with_the_required_columns_only(spark):
    raw = spark.createDataFrame([(1, 5, '["a"]'), (2, 5, None)], "id long, host_id long, amenities string")
    tables = listings.listing_tables(listings.clean_listings(listings.unique_listings(raw)))
    assert rows_of(tables["listings"]) == [(1, 5, 1), (2, 5, 0)]
    assert rows_of(tables["hosts"]) == [(5,)]


# ------------------------------------------------------------------ the complete run

@pytest.fixture
def three(spark):
    return {"listings": (drawn_listings(21, 120), LISTINGS), "reviews": (drawn_reviews(22, 200), REVIEWS),
            "calendar": (drawn_days(23, 500), DAYS)}


def test_complete_run(spark, three, tmp_path):
    """CSV -> landing -> seven tables -> verification and reports; a second run replaces the first."""
    sources = {}
    for name, (rows, schema) in three.items():
        sources[name] = str(tmp_path / "csv" / name)
        spark.createDataFrame(rows, schema).coalesce(1).write.csv(sources[name], header=True, escape='"', compression="gzip")
    counts = land_all(spark, sources, str(tmp_path / "landed"))
    assert [(c.file_rows, c.stored_rows, c.ok) for c in counts] == [(len(rows), len(rows), True) for rows, _ in three.values()]
    for _ in range(2):
        assert run.run(spark, str(tmp_path / "landed"), str(tmp_path / "out"),
                       str(tmp_path / "extracts"), str(tmp_path / "reports")) == 0
    listing_rows, review_rows, day_rows = (rows for rows, _ in three.values())
    unique, days = plain_reviews(review_rows), plain_days(day_rows)
    said = [r for r in unique if r[5] is not None]
    want = {"listings": 120, "hosts": len({r[1] for r in listing_rows}),
            "listing_amenities": sum({'["Desk"," Desk","Iron"]': 2, '["Pool"]': 1}.get(r[16], 0) for r in listing_rows),
            "reviews": len(said), "calendar": len(days), "calendar_mensual": len(plain_monthly(day_rows)),
            "calendar_semanal": len(plain_weekly(day_rows))}
    assert {n: spark.read.parquet(str(tmp_path / "out" / n)).count() for n in want} == want
    report = spark.read.json(str(tmp_path / "reports" / "reporte_verificacion"))
    assert report.where("ok AND esperado = almacenado AND esperado = exportado").count() == 7
    findings = {(r["tabla"], r["regla"]): r["n"] for r in
                spark.read.json(str(tmp_path / "reports" / "calidad")).collect()}
    assert findings == {
        ("listings", "duplicados"): 0, ("listings", "columnas vacías"): 0,
        ("listings", "imputados en bedrooms"): sum(r[5] is None for r in listing_rows),
        ("listings", "imputados en beds"): sum(r[6] is None for r in listing_rows),
        ("listings", "imputados en bathrooms"): sum(r[7] is None for r in listing_rows),
        ("listings", "imputados en minimum_nights"): sum(r[9] is None for r in listing_rows),
        ("listings", "disponibilidad deducida"): sum(r[18] is None for r in listing_rows),
        ("listings", "sin precio"): sum(r[8] is None for r in listing_rows),
        ("listings", "amenities ilegibles"): sum(r[16] == "{" for r in listing_rows),
        ("listings", "fecha inválida"): sum(r[17] == "never" for r in listing_rows),
        ("reviews", "duplicados"): len(review_rows) - len(unique), ("reviews", "sin comentario"): len(unique) - len(said),
        ("reviews", "fecha inválida"): sum(r[2] == "later" for r in said),
        ("reviews", "alojamiento ausente"): sum(r[0] is None for r in said),
        ("calendar", "duplicados"): len(day_rows) - len(days),
        ("calendar", "disponibilidad inválida"): findings["calendar", "disponibilidad inválida"],
        ("calendar", "fecha inválida"): len({r[0] for r in day_rows if r[1] == "soon"}),
        ("calendar", "sin fecha"): sum(d is None for _, d, _, _ in days)}
    steps = {(r["tabla"], r["paso"]): r for r in spark.read.json(str(tmp_path / "reports" / "resumen_transformaciones")).collect()}
    assert steps["hosts", "Extracción de dimensión hosts"]["filas_despues"] == want["hosts"]
    timings = spark.read.json(str(tmp_path / "reports" / "tiempos"))
    assert {"extracción", "transformación", "carga"} <= {r["etapa"] for r in timings.collect()}


def test_null_cells_are_counted_around_the_null_treatment(spark):
    """Cells before are those of the table as it comes into the treatment, cells after those that it leaves."""
    df = spark.createDataFrame([(1, 7, "room", None, "$5", None, "never"), (2, 7, "room", 2.0, None, None, "2030-01-02"),
                                (3, 8, None, None, "x", 0.5, None)],
                               "id long, host_id long, room_type string, bedrooms double, price string, reviews_per_month double, "
                               "last_scraped string")
    measured = listings.measured_listings(df)
    seen = measured.agg(*[c.alias(n) for n, c in listings.measures(measured).items()]).first()
    # Before: bedrooms 2, price 2 (one unreadable), reviews 2, dates 2, room type 1. Price, dates and room type stay.
    assert (seen["antes"], seen["despues"]) == (9, 5)
    assert (seen["bedrooms"], seen["price"], seen["fechas"]) == (2, 2, 1)


def test_texts_are_read_once_before_the_tables_are_laid_out(spark):
    """The layout of a table reads its input twice, so what it reads must hold clean texts and lists."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    given = spark.createDataFrame([(1, 7, "2031-01-02", " a<br/>b ", "x"), (2, 7, "bad", None, "y"), (3, 8, "bad", "c", None)],
                                  "id long, listing_id long, date string, comments string, reviewer_name string")
    homes = spark.createDataFrame([(1, 5, '["a", "a", " b "]', "2031/01/02"), (2, 5, "[bad", "no"), (3, 6, None, None)],
                                  "id long, host_id long, amenities string, last_scraped string")
    with Stage(spark) as stage:
        read = run.prepare_reviews(given, stage)
        table = read.tables["reviews"]
        assert "regexp_replace" not in plan(table)
        assert rows_of(table.select("id", "comments", "date", "longitud_comentario")) == [
            (1, "a b", "2031-01-02", 3), (3, "c", None, 1)]
        assert read.seen["reviews"] == {"filas": 3, "con_comentario": 2, "fecha_invalida": 1}
        made = run.prepare_listings(homes, stage)
        assert not any("from_json" in plan(df) for df in made.tables.values())
        assert rows_of(made.tables["listing_amenities"]) == [(1, "a"), (1, "b")]
        assert rows_of(made.tables["listings"].select("id", "cantidad_amenities", "last_scraped")) == [
            (1, 3, "2031-01-02"), (2, 0, None), (3, 0, None)]
        assert (made.seen["listings"]["rotas"], made.seen["listings"]["fechas"]) == (1, 1)


def test_failed_run_returns_one(spark, tmp_path):
    assert run.run(spark, str(tmp_path / "nowhere"), str(tmp_path / "out")) == 1


def test_audit_of_the_calendar(spark):
    rows = drawn_days(31, 400)
    audit = Audit()
    with Stage(spark) as stage:
        _, seen = stage.put_measured(calendar.clean_days(spark.createDataFrame(rows, DAYS)), "days", calendar.day_measures())
    calendar.audit_calendar(audit, len(rows), seen, 3, 2)
    steps = audit.step_table(spark).orderBy("orden").collect()
    assert (steps[0]["filas_antes"], steps[0]["filas_despues"]) == (len(rows), len(plain_days(rows)))
    assert [s["filas_despues"] for s in steps[-2:]] == [3, 2]


# ------------------------------------------------------------------ profile

def test_profile(spark, three, tmp_path):
    frames = {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in three.items()}
    metrics = profile.profile(frames)
    values = {name: [tuple(r) for r in df.collect()] for name, df in metrics.items()}
    rows, said, days = (r for r, _ in three.values())
    prices = [float(r[8].strip("$").replace(",", "")) for r in rows if r[8]]
    assert values["listings_forma"] == [("listings", 120, 21)]
    assert values["listings_id_duplicados"] == [(0,)]
    assert values["reviews_id_duplicados"] == [(len(said) - len({r[1] for r in said}),)]
    assert values["precio"][0][0] == statistics.median(prices) and values["precio"][0][-1] == 120 - len(prices)
    assert values["precio"][0][1] == pytest.approx(statistics.mean(prices))
    assert values["precio_resumen"][0][1:4] == (len(prices), pytest.approx(statistics.mean(prices)), pytest.approx(statistics.stdev(prices)))
    sizes = Counter(r[1] for r in rows)
    assert values["hosts"][0][:2] == (len(sizes), sum(n == 1 for n in sizes.values()))
    assert dict(values["room_type"]) == Counter(r[4] for r in rows if r[4])
    assert {r[0]: r[2] for r in values["room_type_mediana"]} == {
        t: statistics.median(float(r[8].strip("$").replace(",", "")) for r in rows if r[4] == t and r[8]) for t in ("whole", "room", "shared")}
    years = Counter(int(r[2][:4]) for r in said if r[2] not in (None, "later"))
    assert values["reviews_por_anio"] == sorted(years.items())
    assert values["disponibilidad_global"] == [(pytest.approx(100 * sum(r[2] == "t" for r in days) / len(days)),)]
    assert values["texto_bogota"] == [(0,)]
    profile.write_profile({"hosts": metrics["hosts"]}, str(tmp_path))
    assert spark.read.json(str(tmp_path / "hosts")).first()["distintos"] == len(sizes)


# ------------------------------------------------------------------ calendar in its layout

ODD_DAYS = [(1, "2031-01-02", "t", 3), (1, "2031-01-02", "f", 2), (1, "2031/01/02", "f", 5), (None, "2031-01-02", "x", 1),
            (None, "2031-01-02", "t", None), (2, None, "t", 1), (2, None, "f", 1), (None, None, None, 4), (3, "mala", "t", 2)]


def test_days_in_layout_equal_clean_days_by_one_shuffle(spark):
    raw = spark.createDataFrame(drawn_days(41, 1500) + ODD_DAYS, DAYS)
    for order in (None, ["minimum_nights", "available"]):
        want, found = calendar.clean_days(raw, order), calendar.days_in_layout(raw, order)
        assert Counter(rows_of(found.select(*want.columns))) == Counter(rows_of(want))
    plan = calendar.days_in_layout(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_the_daily_table_is_written_once_and_summed_from_what_is_stored(spark, tmp_path):
    raw = spark.createDataFrame(drawn_days(43, 1500) + ODD_DAYS, DAYS)
    whole = calendar.calendar_tables(calendar.clean_days(raw))
    root = str(tmp_path / "out")
    with Stage(spark) as stage:
        prepared = run.prepare_calendar(raw, stage)
        assert not path_exists(spark, stage.root)
        written = run.write_prepared(prepared, root)
    stored = read_tables(spark, root, prepared.tables)
    for name, df in whole.items():
        assert stored[name].schema.simpleString() == df.schema.simpleString()
        assert Counter(rows_of(stored[name])) == Counter(rows_of(df)) and written[name].rows == df.count()
    assert prepared.layout["calendar"].get["filas"] == written["calendar"].rows
    # Every file holds its rows in the order of the layout.
    keys = ["listing_id", "date"]
    for file in files_of(spark, f"{root}/calendar"):
        rows = [tuple((v is not None, v) for v in r) for r in spark.read.parquet(file).select(*keys).collect()]
        assert rows == sorted(rows, key=lambda r: [(known, v if known else 0) for known, v in r])
