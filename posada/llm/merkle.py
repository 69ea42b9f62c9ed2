"""A Merkle manifest of a table: a digest for each row, a tree for each group, one root, and a proof for each row.

H is SHA-256 in lower-case hex. A leaf is H over the fields of a row, each `-` if null, else its UTF-8 length, `:` and its text.
The leaves of a tree ascend by key (null first, then by leaf), and while more than one node remains, every `FANOUT` consecutive
ones become their H; a tree of one leaf is that leaf. What remains of each tree, in order of the tree's name (null first, then
by bytes), is reduced to the root in the same way.

No task sees a whole tree. Leaves get their places by `ranks.numbered` and are dealt to superblocks of FANOUT ** LEAF_LEVELS
consecutive ones, so a tree with a third of all rows is many superblocks. Going up, a superblock is reduced to its top, tops
form superblocks of FANOUT ** NODE_LEVELS, until one node is left. Going down, the nodes of each superblock are cogrouped with
the outer siblings of its top; one pass over them reduces the block again, joins the inner and the outer part of each
proof and folds each leaf. All tables between are written, so a lost executor costs a re-read.

Rows with equal key are ordered by leaf; equal rows have equal leaves, each with a place and a proof of its own. An empty table
gives an empty manifest. Columns that are not among the fields play no part, whatever their names.
"""

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posada.llm.ranks import numbered
from posada.staging import Stage

FANOUT = 16
LEAF_LEVELS = 2
NODE_LEVELS = 3

_OUTER = "tree string, block bigint, lefts array<string>, rights array<string>, subroot string, root string"
_PROVED = "key {key}, leaf string, subroot string, root string, lefts array<string>, rights array<string>, folded_root string, " \
    "verified boolean"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The leaf of a row with these values."""
    texts = [f.cast("string") for f in fields]
    framed = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def levels_of(nodes: list[str], total: int, most: int) -> list[list[str]]:
    """The nodes of a superblock and of each level above them, `most` at most, in a tree of `total` nodes on the first level."""
    levels = [nodes]
    while total > 1 and len(levels) <= most:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + FANOUT])) for i in range(0, len(below), FANOUT)])
        total = -(-total // FANOUT)
    return levels


def siblings(levels: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """What stands left and right of a node and of its ancestors inside their runs, joined, level by level."""
    lefts, rights = [], []
    for nodes in levels[:-1]:
        first = place - place % FANOUT
        lefts.append("".join(nodes[first:place]))
        rights.append("".join(nodes[place + 1:first + FANOUT]))
        place //= FANOUT
    return lefts, rights


def fold(leaf: str, lefts, rights) -> str:
    """The root that a leaf leads to with these siblings."""
    for left, right in zip(lefts, rights):
        leaf = digest(left + leaf + right)
    return leaf


# --- on Spark -------------------------------------------------------------------------------------------------

def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / F.lit(FANOUT ** levels)).cast("long"))


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The top of each superblock, itself a node: tree, place, total, digest."""
    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, total = rows.sort_values("place"), int(rows["total"].iat[0])
        top = levels_of(rows["digest"].tolist(), total, levels)[-1]
        return pd.DataFrame({"tree": key[0], "place": key[1], "total": -(-total // FANOUT ** levels), "digest": top})

    return _blocks(nodes.select("tree", "place", "total", "digest"), levels).groupBy("tree", "block") \
        .applyInPandas(reduce, "tree string, place bigint, total bigint, digest string")


def _ascend(nodes: DataFrame, levels: int, above: int, held: Stage, name: str) -> list[tuple[DataFrame, int]]:
    """Tables of nodes with the levels that their superblocks span, from nodes up to single tops."""
    tables = [(nodes, levels)]
    while (tables[-1][0].agg(F.max("total")).first()[0] or 0) > 1:
        tables.append((held.put(_tops(*tables[-1]), f"{name}-{len(tables)}"), above))
    return tables


def _exchange(nodes: DataFrame, outer: DataFrame, levels: int, emit, schema: str) -> DataFrame:
    """Cogroup nodes with the outer nodes of their superblock; emit gets the sorted rows, their siblings and the outer row."""
    def run(rows: pd.DataFrame, out: pd.DataFrame) -> pd.DataFrame:
        rows, out = rows.sort_values("place"), out.iloc[0]
        held = levels_of(rows["digest"].tolist(), int(rows["total"].iat[0]), levels)
        paths = [siblings(held, i) for i in range(len(rows))]
        lefts = [[*left, *out["lefts"]] for left, _ in paths]
        rights = [[*right, *out["rights"]] for _, right in paths]
        return emit(rows, lefts, rights, out)

    return _blocks(nodes, levels).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(run, schema)


def _descend(tables: list[tuple[DataFrame, int]], outer: DataFrame, held: Stage, name: str) -> DataFrame:
    """The outer rows of the superblocks of the lowest table, from those of the highest."""
    def emit(rows, lefts, rights, out):
        return pd.DataFrame({"tree": rows["tree"].tolist(), "block": rows["place"].tolist(), "lefts": lefts, "rights": rights,
                             "subroot": out["subroot"], "root": out["root"]})

    for i, (nodes, levels) in reversed(list(enumerate(tables))[1:]):
        outer = held.put(_exchange(nodes, outer, levels, emit, _OUTER), f"{name}-{i}")
    return outer


def manifest(table: DataFrame, held: Stage, key: str, tree: str, fields: list[str], claimed: Column | None = None,
             leaf_levels: int = LEAF_LEVELS, node_levels: int = NODE_LEVELS) -> DataFrame:
    """key, leaf, subroot, root, lefts and rights (the proof: for each level the joined siblings on either side), folded_root and
    verified, for each row.

    claimed: the leaf that is folded in place of a row's own, where it is not null; verified tells whether it leads to the root.
    """
    kind = table.schema[key].dataType.simpleString()
    named = F.coalesce(F.concat(F.lit("1"), F.col(tree).cast("string")), F.lit("0"))    # null before all others, also before ''
    rows = table.select(named.alias("tree"), F.col(key).alias("key"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
                        (F.lit(None) if claimed is None else claimed).cast("string").alias("claimed"))
    leaves = numbered(rows, held, "leaves", ["tree"], [F.col("key").asc_nulls_first(), "digest"])
    trees = _ascend(leaves, leaf_levels, node_levels, held, "nodes")

    placed = numbered(trees[-1][0].select("tree", "digest"), held, "subroots", [], ["tree"]).withColumnRenamed("tree", "of").withColumn("tree", F.lit(""))
    forest = _ascend(placed, node_levels, node_levels, held, "forest")
    none = F.array().cast("array<string>")
    root = held.put(forest[-1][0].select(F.col("tree"), F.lit(0).cast("long").alias("block"), none.alias("lefts"), none.alias("rights"),
                                F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root")), "root")

    def subroot(rows, lefts, rights, out):
        return pd.DataFrame({"tree": rows["of"].tolist(), "block": 0, "lefts": lefts, "rights": rights,
                             "subroot": rows["digest"].tolist(), "root": out["root"]})

    tops = held.put(_exchange(placed, _descend(forest, root, held, "forest-outer"), node_levels, subroot, _OUTER), "tree-outer")

    def prove(rows, lefts, rights, out):
        own = rows["digest"].tolist()
        start = [leaf if other is None else other for leaf, other in zip(own, rows["claimed"])]
        folded = [fold(*x) for x in zip(start, lefts, rights)]
        return pd.DataFrame({"key": rows["key"].tolist(), "leaf": own, "subroot": out["subroot"], "root": out["root"], "lefts": lefts,
                             "rights": rights, "folded_root": folded, "verified": [f == out["root"] for f in folded]})

    outer = _descend(trees, tops, held, "outer")
    return _exchange(leaves, outer, leaf_levels, prove, _PROVED.format(key=kind)).withColumnRenamed("key", key)
