"""Host dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posada.operators.columns import host_columns
from posada.operators.dedup import keep_first


def split_hosts(df: DataFrame, order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(listings without host attributes, one row of attributes per host_id).

    A host's attributes come from its first row, by default by listing id.
    """
    attributes = host_columns(df)
    order = order_by or (["id"] if "id" in df.columns else attributes)
    extra = [c for c in order if c not in ("host_id", *attributes)]
    hosts = keep_first(df.select("host_id", *attributes, *extra), ["host_id"], order)
    return df.drop(*attributes), hosts.drop(*extra)


def host_sizes(df: DataFrame) -> DataFrame:
    """host_id, alojamientos (null hosts excluded)."""
    return (df.dropna(subset=["host_id"]).groupBy("host_id")
            .agg(F.count(F.lit(1)).alias("alojamientos")))


def host_concentration(df: DataFrame, large: int = 10) -> DataFrame:
    """Hosts, hosts with one listing, listings held by large hosts, largest host and the shares."""
    size = F.col("alojamientos")
    held = F.sum(F.when(size >= large, size).otherwise(0))
    rows = df.agg(F.count(F.lit(1))).scalar()
    return host_sizes(df).agg(
        F.count(F.lit(1)).alias("distintos"),
        F.count_if(size == 1).alias("con_uno"),
        F.coalesce(held, F.lit(0)).alias("alojamientos_grandes"),
        F.max(size).alias("max_alojamientos"),
    ).withColumns({
        "proporcion_con_uno": F.try_divide(F.col("con_uno"), F.col("distintos")),
        "proporcion_grandes": F.try_divide(F.col("alojamientos_grandes"), rows),
    })
