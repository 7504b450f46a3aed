"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poilake.llm.scratch import Scratch

#: Copies of a node's minimum, so that the links of one hub are spread over as many tasks.
SALTS = 8


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction step: a node's neighbours are linked to the least of them and it."""
    if large:
        arcs = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        arcs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = (
        arcs.groupBy("u")
        .agg(F.least(F.min("v"), F.col("u")).alias("m"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    met = arcs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "salt"])
    if large:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.where("salt = 0").select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long): root is the least node reachable.

    The number of rounds goes with the logarithm of the longest path; each round's links are a
    table in the shared folder. No links give no rows; repeated links and loops change nothing.
    """
    table, path = scratch.store_at(links.select("a", "b").where("a <> b").distinct(), "links")
    state = None
    while True:
        after, new = scratch.store_at(_star(_star(table, large=True), large=False), "star")
        scratch.drop(path)
        table, path = after, new
        found = after.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = table.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return table.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
