"""Spearman rank correlation with pairwise-complete rows."""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posada.functions.numbers import nan_to_null
from posada.staging import Stage

FREQUENT_SHARE = 1000

PAIR_SCHEMA = "variable_a string, variable_b string, n long, rho double"


def spearman_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable_a, variable_b, n, rho for every pair of columns, in the order given.

    Each pair uses the rows where both columns are present, and ties share their average rank. The rank
    of a value depends on the partner column only through the rows that the partner lacks, so each column
    is sorted once, with one running count for each partner. Rows are staged first: they are told apart
    by a running number, which must not change when a task runs again.
    """
    pairs = list(combinations(range(len(columns)), 2))
    with Stage(df.sparkSession) as stage:
        numbers = {_value(i): nan_to_null(F.col(c).cast("double")) for i, c in enumerate(columns)}
        rows = stage.put(df.select(F.monotonically_increasing_id().alias("_row"),
                                   *[x.alias(name) for name, x in numbers.items()]), "rows")
        sizes = stage.put(value_sizes(rows, len(columns)), "sizes")
        ranks = stage.put(average_ranks(sizes, len(columns)), "ranks")
        spreads = {r["column"]: r for r in ranks.groupBy("column").agg(
            *[F.sum(F.col("n")[j]).alias(f"n{j}") for j in range(len(columns))],
            *[F.sum(F.col("n")[j] * F.col("d")[j] * F.col("d")[j]).alias(f"q{j}")
              for j in range(len(columns))]).collect()}
        ranked = with_ranks(rows, ranks, len(columns))
        products = ranked.agg(*[F.sum(_rank(a)[b] * _rank(b)[a]) for a, b in pairs]).first() if pairs else []
    found = []
    for (a, b), product in zip(pairs, products):
        n = spreads[a][f"n{b}"] if a in spreads else 0
        spread = (spreads[a][f"q{b}"] * spreads[b][f"q{a}"]) ** 0.5 if n else 0.0
        if n:
            found.append((columns[a], columns[b], n, product / spread if spread else None))
    return df.sparkSession.createDataFrame(found, PAIR_SCHEMA)


def _value(i: int) -> str:
    return f"v{i}"


def _rank(i: int) -> Column:
    return F.col(f"r{i}")


def value_sizes(rows: DataFrame, width: int) -> DataFrame:
    """column, v, n0, n1, ...: for each distinct value of a column its rows where column 0, 1, ... is
    present, in ranges of column and value; part is the number of the range."""
    present = [F.col(_value(i)).isNotNull().alias(f"p{i}") for i in range(width)]
    values = F.array(*[F.struct(F.lit(i).alias("column"), F.col(_value(i)).alias("v")) for i in range(width)])
    counted = (rows.select(F.explode(values).alias("e"), *present).select("e.*", *[f"p{i}" for i in range(width)])
               .where("v IS NOT NULL").groupBy("column", "v")
               .agg(*[F.count_if(F.col(f"p{i}")).alias(f"n{i}") for i in range(width)]))
    return (counted.repartitionByRange("column", "v").sortWithinPartitions("column", "v")
            .withColumn("part", F.spark_partition_id()))


def average_ranks(sizes: DataFrame, width: int) -> DataFrame:
    """column, v, n, d, frequent: n[j] rows of the value where column j is present, d[j] their average
    rank among the rows of the column where j is present, less the mean rank.

    The rows before a value are those of earlier ranges, from one small row for each range and column,
    and those before it in its own range.
    """
    counts = [f"n{j}" for j in range(width)]
    ranges = sizes.groupBy("column", "part").agg(*[F.sum(c).alias(f"h_{c}") for c in counts])
    whole = W.partitionBy("column")
    earlier = whole.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = ranges.select("column", "part", *[
        x for c in counts for x in ((F.sum(f"h_{c}").over(earlier) - F.col(f"h_{c}")).alias(f"b_{c}"),
                                    F.sum(f"h_{c}").over(whole).alias(f"t_{c}"))])
    inside = W.partitionBy("column", "part").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = sizes.join(placed, ["column", "part"]).withColumns({f"s_{c}": F.sum(c).over(inside) for c in counts})
    centred = [F.col(f"b_{c}") + F.col(f"s_{c}") - (F.col(c) - 1) / 2 - (F.col(f"t_{c}") + 1) / 2 for c in counts]
    own = F.array(*counts)[F.col("column")] * FREQUENT_SHARE > F.array(*[f"t_{c}" for c in counts])[F.col("column")]
    return running.select("column", "v", F.array(*counts).alias("n"), F.array(*centred).alias("d"), own.alias("frequent"))


def with_ranks(rows: DataFrame, ranks: DataFrame, width: int) -> DataFrame:
    """_row and r0, r1, ...: for each column the centred ranks of its value, null where the value is.

    Frequent values, fewer than FREQUENT_SHARE per column, are looked up by broadcast. Only the values that
    are not among them become rows of their own and are joined by shuffle, each key being rare.
    """
    served = rows
    for i in range(width):
        few = ranks.where((F.col("column") == i) & F.col("frequent")).select(F.col("v").alias(_value(i)), F.col("d").alias(f"r{i}"))
        served = served.join(F.broadcast(few), _value(i), "left")
    values = F.array(*[F.struct(F.lit(i).alias("column"), F.col(_value(i)).alias("v"), _rank(i).isNull().alias("open"))
                       for i in range(width)])
    rare = (served.select("_row", F.explode(F.filter(values, lambda e: e["open"] & e["v"].isNotNull())).alias("e"))
            .select("_row", "e.column", "e.v"))
    looked_up = (rare.join(ranks.where("NOT frequent").select("column", "v", "d"), ["column", "v"])
                 .groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("column", "d"))).alias("found")))
    return served.join(looked_up, "_row", "left").select(
        "_row", *[F.coalesce(_rank(i), F.col("found")[F.lit(i)]).alias(f"r{i}") for i in range(width)])
