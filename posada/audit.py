"""Audit records: steps, data-quality findings, landings and timings.

Counts are taken by aggregates in the writing stages of staged and published tables and from file
footers, not by counters inside shuffle stages: a map task that runs again after the loss of an executor
would count twice there.
"""

import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posada.functions.numbers import format_es

STEP_SCHEMA = ("orden long, paso string, tabla string, filas_antes long, filas_despues long, "
               "detalle string")
FINDING_SCHEMA = "tabla string, regla string, n long"
TIMING_SCHEMA = "etapa string, tabla string, filas long, segundos double"

# Names of the audited steps.
STEP_DEDUP = "Eliminación de duplicados"
STEP_DROP_COLUMNS = "Eliminación de columnas vacías/sin valor"
STEP_PRICES = "Normalización de precios"
STEP_QUOTE = "Desanidado de price_quote_raw"
STEP_DATES = "Estandarización de fechas a YYYY-MM-DD"
STEP_NULLS = "Tratamiento de nulos"
STEP_TEXT = "Estandarización de texto"
STEP_FLAGS = "Categorización de precios y marcas de atípicos"
STEP_AMENITIES = "Desanidado de amenities"
STEP_HOSTS = "Extracción de dimensión hosts"
STEP_NO_COMMENT = "Eliminación de reseñas sin comentario"
STEP_DATE_PARTS = "Variables de fecha derivadas"
STEP_MONTHLY = "Resumen mensual del calendario"
STEP_WEEKLY = "Resumen semanal del calendario"
DATE_PARTS = "anio, mes, dia, trimestre, nombre_mes, dia_semana"


@dataclass(frozen=True)
class LandingCount:
    source: str
    file_rows: int
    stored_rows: int
    seconds: float

    @property
    def ok(self) -> bool:
        return self.file_rows == self.stored_rows


@dataclass
class Audit:
    """Small driver-side records; one entry per step, finding or written table."""

    steps: list[tuple] = field(default_factory=list)
    findings: list[tuple] = field(default_factory=list)
    timings: list[tuple] = field(default_factory=list)

    def step(self, name: str, table: str, before: int, after: int, detail: str = "") -> None:
        self.steps.append((len(self.steps) + 1, name, table, before, after, detail))

    def finding(self, table: str, rule: str, n: int) -> None:
        self.findings.append((table, rule, n))

    @contextmanager
    def timed(self, stage: str, table: str = ""):
        """Clock one action; the caller may set the row count on the yielded record."""
        record = {"rows": None}
        started = time.perf_counter()
        yield record
        self.timings.append((stage, table, record["rows"], time.perf_counter() - started))

    def step_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.steps, STEP_SCHEMA)

    def finding_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.findings, FINDING_SCHEMA)

    def timing_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.timings, TIMING_SCHEMA)


def step_report(steps: DataFrame) -> DataFrame:
    """Printable steps: rows before and after in thousands notation."""
    return steps.select("orden", "tabla", "paso", format_es(F.col("filas_antes")).alias("antes"),
                        format_es(F.col("filas_despues")).alias("despues"))


def verification_report(report: DataFrame) -> DataFrame:
    """Printable verification: counts in thousands notation and OK or ERROR."""
    return report.select(
        "tabla", format_es(F.col("esperado")).alias("esperado"),
        format_es(F.col("almacenado")).alias("almacenado"),
        F.coalesce(format_es(F.col("exportado")), F.lit("no exportado")).alias("exportado"),
        F.when(F.col("ok"), "OK").otherwise("ERROR").alias("resultado"))
