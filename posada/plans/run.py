"""The complete run: read, clean, publish, verify, report."""

import logging
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from posada.audit import Audit
from posada.operators import frequencies as freq
from posada.operators.membership import orphan_keys, row_total
from posada.plans import calendar, listings, reviews
from posada.sinks.tables import Summary, Written, publish, read_tables, write_json, write_tables
from posada.sources.store import Store
from posada.staging import Stage, at_once

log = logging.getLogger(__name__)

INPUTS = ["listings", "reviews", "calendar"]


@dataclass
class Prepared:
    """Output tables, not yet written, and what their staging has counted on the way.

    layout: for tables that are in their layout already what their writing counts, and summaries: how to make a table
    from another one once that is stored.
    """

    tables: dict[str, DataFrame]
    seen: dict[str, dict]
    listing_columns: list[str] = field(default_factory=list)
    layout: dict[str, Observation] = field(default_factory=dict)
    summaries: dict[str, Summary] = field(default_factory=dict)


def prepare_listings(raw: DataFrame, stage: Stage, order_by: list[str] | None = None) -> Prepared:
    """listings, hosts and listing_amenities."""
    unique = listings.unique_listings(raw, order_by)
    unique, held = stage.put_measured(unique, "listings_unique", listings.unique_measures(unique),
                                      dictionary=False)
    measured = listings.with_read_lists(listings.measured_listings(unique, stage, held))
    clean, seen = stage.put_measured(measured, "listings_clean", listings.measures(measured),
                                     listings.carried(measured), dictionary=False)
    return Prepared(listings.listing_tables(clean), {"listings_unique": held, "listings": seen}, clean.columns)


def prepare_reviews(raw: DataFrame, stage: Stage, order_by: list[str] | None = None) -> Prepared:
    # Texts are cleaned before they are staged, as the layout of the table reads its input twice.
    clean, seen = stage.put_measured(reviews.measured_reviews(reviews.dated(reviews.unique_reviews(raw, order_by))),
                                     "reviews_unique", reviews.clean_measures(), reviews.carried())
    return Prepared({"reviews": reviews.commented(clean)}, {"reviews": seen})


def prepare_calendar(raw: DataFrame, stage: Stage, order_by: list[str] | None = None) -> Prepared:
    """calendar, calendar_mensual and calendar_semanal.

    The daily rows are not staged: they are written once, as the table itself, and the summaries are made from it.
    """
    seen = Observation()
    days = calendar.days_in_layout(raw, order_by).observe(seen, *[c.alias(n) for n, c in calendar.day_measures().items()])
    tables = {**calendar.calendar_tables(calendar.clean_days(raw, order_by)), "calendar": calendar.daily(days)}
    return Prepared(tables, {}, layout={"calendar": seen},
                    summaries={"calendar_mensual": Summary("calendar", calendar.monthly_of_table),
                               "calendar_semanal": Summary("calendar", calendar.weekly_of_table)})


PREPARE = {"listings": prepare_listings, "reviews": prepare_reviews, "calendar": prepare_calendar}


def prepare(raw: dict[str, DataFrame], stage: Stage,
            order_by: dict[str, list[str]] | None = None) -> Prepared:
    """The seven output tables.

    Each raw table goes through one shuffle (duplicates by key); its result is staged, or written as the table it
    is, and everything else reads the columns it needs from there. All counts for the audit are taken by the stages
    that write, so that no table is read for them.
    """
    return merged(at_once([partial(PREPARE[name], raw[name], stage, (order_by or {}).get(name)) for name in INPUTS]))


def merged(parts: list[Prepared]) -> Prepared:
    """The tables of all INPUTS, in their order."""
    return Prepared({n: df for part in parts for n, df in part.tables.items()},
                    {n: counts for part in parts for n, counts in part.seen.items()}, parts[0].listing_columns,
                    {n: seen for part in parts for n, seen in part.layout.items()},
                    {n: summary for part in parts for n, summary in part.summaries.items()})


def write_prepared(prepared: Prepared, root: str, audit: Audit | None = None) -> dict[str, Written]:
    return write_tables(prepared.tables, root, audit, in_layout=set(prepared.layout), summaries=prepared.summaries)


def prepare_and_write(raw: dict[str, DataFrame], stage: Stage, root: str,
                      order_by: dict[str, list[str]] | None = None) -> tuple[Prepared, dict[str, Written]]:
    """prepare and write_prepared, with no wait for the other sources before a source's tables are written."""
    def one(name: str) -> tuple[Prepared, dict[str, Written]]:
        part = PREPARE[name](raw[name], stage, (order_by or {}).get(name))
        return part, write_prepared(part, root)

    done = at_once([partial(one, name) for name in INPUTS])
    return merged([part for part, _ in done]), {n: w for _, written in done for n, w in written.items()}


def all_tables(raw: dict[str, DataFrame], stage: Stage,
               order_by: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    return prepare(raw, stage, order_by).tables


def audit_tables(raw: dict[str, DataFrame], prepared: Prepared, published: dict[str, DataFrame],
                 written: dict[str, int], audit: Audit) -> None:
    """Steps and findings once the tables are written; raw rows come from file footers."""
    rows = {name: df.count() for name, df in raw.items()}
    kinds = freq.distinct_counts(published["listing_amenities"], ["amenity"]).first()["amenity"]
    orphans = orphan_keys(published["reviews"], "listing_id", published["listings"], "id")
    listings.audit_listings(audit, rows["listings"], prepared.seen["listings_unique"], prepared.listing_columns,
                            prepared.seen["listings"], written["hosts"], written["listing_amenities"], kinds)
    reviews.audit_reviews(audit, rows["reviews"], prepared.seen["reviews"], row_total(orphans, "n").first()["n"])
    calendar.audit_calendar(audit, rows["calendar"], prepared.layout["calendar"].get,
                            written["calendar_mensual"], written["calendar_semanal"])


def run(spark: SparkSession, source_root: str, target_root: str,
        extract_root: str | None = None, report_root: str | None = None,
        order_by: dict[str, list[str]] | None = None) -> int:
    """0 when every table was stored as expected, 1 on a difference or a failed stage."""
    audit = Audit()
    phase = "extracción"
    try:
        with Stage(spark) as stage:
            with audit.timed(phase) as record:
                store = Store(spark, source_root)
                raw = store.scan_all(INPUTS)
                record["rows"] = sum(store.counts(INPUTS).values())
            phase = "transformación"
            with audit.timed(phase):
                prepared = prepare(raw, stage, order_by)
            phase = "carga"
            with audit.timed(phase):
                report = publish(spark, prepared.tables, target_root, extract_root, audit,
                                 partial(write_prepared, prepared))
            phase = "auditoría"
            with audit.timed(phase):
                written = {r["tabla"]: r["esperado"] for r in report.collect()}
                audit_tables(raw, prepared, read_tables(spark, target_root, prepared.tables), written, audit)
        if report_root:
            root = report_root.rstrip("/")
            write_json(audit.step_table(spark), f"{root}/resumen_transformaciones")
            write_json(audit.finding_table(spark), f"{root}/calidad")
            write_json(audit.timing_table(spark), f"{root}/tiempos")
            write_json(report, f"{root}/reporte_verificacion")
    except Exception:
        log.exception("the run failed in stage %s", phase)
        return 1
    return 0 if report.where("NOT ok").isEmpty() else 1
