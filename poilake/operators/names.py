"""Which names are alike: a set-similarity join over the grams of distinct names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.session import materialize

#: Letters of a gram; numbers of 64 bits that mark a set; keys of a gram that one task compares.
GRAM, MARKS, GROUP = 3, 4, 1024


def grams(key: Column, size: int = GRAM) -> Column:
    """The distinct runs of ``size`` letters of a key with a space on both sides; a short key is its own."""
    padded = F.concat(F.lit(" "), key, F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(padded, i, F.lit(size))))


def _sets(keys: DataFrame, rank: DataFrame, least: float) -> DataFrame:
    """(key, grams, prefix): the grams of each key, rarest first, and how many of them are its prefix.

    A set that is ``least`` alike to another shares a gram with its prefix: all but
    ceil(``least`` * size) - 1 of its grams, the rarest ones. Common grams are in no prefix.
    """
    each = keys.withColumn("gram", F.explode(grams(F.col("key")))).join(rank, "gram")
    ordered = each.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "gram")))["gram"].alias("grams"))
    need = F.ceil(F.size("grams") * F.lit(least) - F.lit(1e-9))
    return ordered.withColumn("prefix", (F.size("grams") - need + 1).cast("int"))


def _prefixed(keys: DataFrame, rank: DataFrame, least: float) -> DataFrame:
    """``_sets`` with a row for each ``gram`` of a key's prefix."""
    return _sets(keys, rank, least).withColumn("gram", F.explode(F.slice("grams", F.lit(1), F.col("prefix"))))


def _marks(grams: Column) -> list[Column]:
    """A bit for each gram, by its hash, in ``MARKS`` numbers; grams may share one."""
    bits = F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(64 * MARKS)).cast("int"))

    def mark(i: int) -> Column:
        def put(all_: Column, bit: Column) -> Column:
            own = F.call_function("shiftleft", F.lit(1).cast("long"), bit % 64)
            return F.when(F.floor(bit / 64) == i, all_.bitwiseOR(own)).otherwise(all_)

        return F.aggregate(bits, F.lit(0).cast("long"), put).alias(f"mark{i}")

    return [mark(i) for i in range(MARKS)]


def similar_keys(left: DataFrame, right: DataFrame, least: float, size: int = GRAM) -> DataFrame:
    """(left_key, right_key, similarity) of all pairs whose grams have a Jaccard similarity of ``least`` or more.

    ``left`` and ``right`` have a column ``key``, and each distinct one is compared once; null
    and empty keys match nothing. Pairs meet in the rare grams of their prefixes and are
    verified where they meet first, if their sizes allow the similarity; no other pair is made.
    Before that, bits that only one of them has bound what they can share, which loses no pair.
    Keys of a frequent gram are split over several tasks. ``least`` is above 0.
    """
    if not 0 < least <= 1:
        raise ValueError(f"least must be above 0 and at most 1, not {least}")
    spark = left.sparkSession
    sides = [materialize(side.select("key").where("key <> ''").distinct(), "keys") for side in (left, right)]
    both = sides[0].unionByName(sides[1]).distinct()
    rank = both.select(F.explode(grams(F.col("key"), size)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    sets = _sets(both, materialize(rank, "grams"), least)
    sets = materialize(sets.select("*", F.size("grams").alias("size"), *_marks(F.col("grams"))), "sets")
    # Merge joins: stored sizes are those of compressed files, so a broadcast could fill the driver.
    a, b = (
        side.join(sets.hint("merge"), "key").select(
            F.explode(F.slice("grams", F.lit(1), F.col("prefix"))).alias("gram"),
            *[F.col(c).alias(f"{name}_{c}") for c in sets.columns],
        )
        for side, name in zip(sides, ("left", "right"))
    )
    met = b.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    frequent = materialize(met.select("gram", F.ceil(F.col("n") / GROUP).cast("int").alias("parts")), "frequent")
    parts = F.coalesce("parts", F.lit(1))
    a = a.join(frequent, "gram", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    b = b.join(frequent, "gram", "left").withColumn("part", F.pmod(F.xxhash64("right_key"), parts).cast("int")).drop("parts")
    # So many partitions whatever their bytes: the work is in the pairs.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a, b = (side.repartition(tasks, "gram", "part") for side in (a, b))
    sizes = F.col("left_size"), F.col("right_size")
    need = F.lit(least / (1 + least)) * (sizes[0] + sizes[1]) - F.lit(1e-6)

    def only(one: str, other: str) -> Column:
        """How many grams at least ``one`` has and ``other`` has not."""
        marks = ((F.col(f"{one}_mark{i}"), F.col(f"{other}_mark{i}")) for i in range(MARKS))
        return reduce(Column.__add__, (F.bit_count(x.bitwiseAND(F.bitwise_not(y))) for x, y in marks))

    prefixes = (F.slice(f"{name}_grams", F.lit(1), F.col(f"{name}_prefix")) for name in ("left", "right"))
    shared = F.size(F.array_intersect("left_grams", "right_grams"))
    return (
        a.join(b.hint("merge"), ["gram", "part"])
        .where((sizes[0] >= F.lit(least - 1e-9) * sizes[1]) & (sizes[1] >= F.lit(least - 1e-9) * sizes[0]))
        .where((sizes[0] - only("left", "right") >= need) & (sizes[1] - only("right", "left") >= need))
        .where(F.array_intersect(*prefixes)[0] == F.col("gram"))
        .withColumn("similarity", shared / (sizes[0] + sizes[1] - shared))
        .where(F.col("similarity") >= least)
        .select("left_key", "right_key", "similarity")
    )
