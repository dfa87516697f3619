"""Pairwise matches consolidated into groups: deterministic Boruvka hooking.

Vertices are 64-bit keys.  In each round

1. every component takes its smallest outgoing edge.  Edges are ordered by
   (smaller end, larger end), a strict total order, so the choice can close no
   cycle but the pair of two components that chose each other; of a vertex's
   edges the smallest is the one to its smallest neighbour, so the choice is one
   hash aggregation of a bigint;
2. the trees collapse by pointer doubling until no pointer moves;
3. the edges are relabelled with the roots, loops dropped, the rest deduplicated.

The rounds end when no edge is left; at least half of the components with an
edge vanish per round.  Each round is written to the shared scratch folder, so
the plan stays short and a lost executor costs one round.  Nothing is collected
to the driver but row counts.  A hub (one vertex with a third of all edges) is
pre-aggregated before the shuffle in 1 and met by the skew join in 3: the join
with the root table has one row per key on that side.

Article ids are mapped to keys by an exact rule: 16 hexadecimal digits are read
as the number they write (order kept), any other id is hashed with a salt that
is changed until no two ids share a key.

Defined cases: a null or blank end and a pair of an id with itself link
nothing; repeated and reversed pairs count once; an empty table gives an empty
result; ids compare in lower case without outer blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.scratch import Scratch

_HEX = "^[0-9a-f]{16}$"


def _half(col: Column, at: int) -> Column:
    return F.conv(F.substring(col, at, 8), 16, 10).cast("bigint")


def hex_key(col: Column) -> Column:
    """The number that 16 hexadecimal digits write, shifted so that signed order is the digits' order."""
    return F.shiftleft(_half(col, 1) - F.lit(1 << 31), 32).bitwiseOR(_half(col, 9))


def hex_text(key: Column) -> Column:
    """The inverse of hex_key."""
    return F.lower(F.lpad(F.hex(key.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch, most_rounds: int = 64) -> DataFrame:
    """(node bigint, root bigint) for every node of edges (a bigint, b bigint); root is one node of the component, not always the smallest."""
    edge = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "edge-0")
    label: DataFrame | None = None
    for k in range(most_rounds):
        both = edge.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edge.select(F.col("b").alias("u"), F.col("a").alias("v")))
        hook = both.groupBy("u").agg(F.min("v").alias("p"))
        hook = scratch.keep(hook, f"hook-{k}")
        back = hook.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        # two components that chose each other: the smaller one becomes the root
        tree = hook.join(back, "p").select("u", F.when((F.col("pp") == F.col("u")) & (F.col("u") < F.col("p")), F.col("u")).otherwise(F.col("p")).alias("p"))
        tree = scratch.keep(tree, f"tree-{k}-0")
        for step in range(1, 64):
            up = tree.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jumped = scratch.keep(tree.join(up, "p").select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), f"tree-{k}-{step}")
            moved = not jumped.where("moved").isEmpty()
            scratch.drop(f"tree-{k}-{step - 1}")
            tree = jumped.select("u", "p")
            if not moved:
                break
        root_a, root_b = tree.select(F.col("u").alias("a"), F.col("p").alias("ra")), tree.select(F.col("u").alias("b"), F.col("p").alias("rb"))
        left = edge.join(root_a, "a").select("b", "ra").join(root_b, "b").where("ra <> rb")
        edge, n_left = scratch.keep_counted(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"edge-{k + 1}")
        if label is None:
            label = tree.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            # a component without an outgoing edge is absent from the tree and keeps its root
            step_up = tree.select(F.col("u").alias("root"), F.col("p").alias("up"))
            label = scratch.keep(label.join(step_up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), f"label-{k}")
        scratch.drop(f"edge-{k}")
        scratch.drop(f"hook-{k}")
        if not n_left:
            return label
    raise RuntimeError(f"edges are left after {most_rounds} rounds")


def group_ids(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """(id string, group_id string): every id of a group of two or more; group_id is the group's smallest id.

    pairs: (a string, b string), normalised ids.
    """
    scratch = Scratch(spark, "components")
    pairs = pairs.where("a is not null and b is not null and a <> b")
    # ids that are no 16 hexadecimal digits: few or none, so the keys of the rest need no table
    other = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("id")).where(~F.col("id").rlike(_HEX)).distinct(), "other")
    n_other = other.limit(1).count()
    salt = 0
    if n_other:
        while other.groupBy(F.xxhash64("id", F.lit(salt))).count().where("count > 1").limit(1).count():
            salt += 1

    def key(c: str) -> Column:
        is_hex = F.col(c).rlike(_HEX)
        return F.when(is_hex, hex_key(F.col(c))).otherwise(F.xxhash64(F.col(c), F.lit(salt)))

    clash = None
    if n_other:  # a hashed key must not be the number of a hexadecimal id either
        hexes = pairs.select(F.explode(F.array("a", "b")).alias("id")).where(F.col("id").rlike(_HEX)).select(hex_key(F.col("id")).alias("k")).distinct()
        clash = other.select(F.xxhash64("id", F.lit(salt)).alias("k")).join(hexes, "k", "left_semi").limit(1).count()
    if clash:
        named = pairs.select(F.concat(F.lit("~"), "a").alias("a"), F.concat(F.lit("~"), "b").alias("b"))
        return group_ids(spark, named).select(F.expr("substring(id, 2)").alias("id"), F.expr("substring(group_id, 2)").alias("group_id"))
    label = components(spark, pairs.select(key("a").alias("a"), key("b").alias("b")), scratch)
    if not n_other:
        least = label.groupBy("root").agg(F.min("node").alias("least"))
        return label.join(least, "root").select(hex_text(F.col("node")).alias("id"), hex_text(F.col("least")).alias("group_id"))
    names = other.select(F.xxhash64("id", F.lit(salt)).alias("node"), "id")
    full = label.join(names, "node", "left").select("root", F.coalesce("id", hex_text(F.col("node"))).alias("id"))
    least = full.groupBy("root").agg(F.min("id").alias("group_id"))
    return full.join(least, "root").select("id", "group_id")
