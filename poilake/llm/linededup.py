"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.llm.scratch import Scratch

#: Copies of a host's lines where they are joined to pages by shuffling.
SALTS = 16


def _mark(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))


def _key(line: Column) -> Column:
    """128 bits that stand for a trimmed line."""
    return _mark(F.trim(line))


def boilerplate(
    docs: DataFrame, host_col: str, text_col: str, ratio: float = 0.1, min_pages: int = 5, once: bool = False
) -> DataFrame:
    """(host, keys): the lines on more than ``ratio`` of a host's pages and on ``min_pages`` at least.

    A line counts once a page, without spaces around it; blank lines never count. A host with p
    pages of l lines on average has fewer than l / ``ratio`` such lines, however large p is,
    which bounds the array. Pages without a host are not judged. With ``once``, pages of equal text
    are one page of their host, on both sides of the ratio: else a low ratio takes every line of a
    large group of copies for boilerplate.
    """
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).where("host is not null")
    mark = _mark(F.col("text"))
    lines = pages.where("text is not null").select(
        "host",
        *([mark.alias("mark")] if once else []),
        F.explode(
            F.array_distinct(
                F.transform(F.filter(F.split("text", "\n"), lambda s: F.trim(s) != ""), _key)
            )
        ).alias("key"),
    )
    n = F.count_distinct("mark") if once else F.count("*")
    counts = lines.groupBy("host", "key").agg(n.alias("n")).where(F.col("n") >= min_pages)
    total = F.count_distinct(F.when(F.col("text").isNotNull(), mark)) if once else F.count("*")
    totals = pages.groupBy("host").agg(total.alias("pages"))
    return (
        counts.join(totals, "host")
        .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("key").alias("keys"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = 0.1,
    min_pages: int = 5,
    once: bool = False,
) -> DataFrame:
    """``docs`` with the boilerplate lines of their host cut out of ``text_col``; every row stays.

    Adds ``n_lines`` and ``n_dropped``, replacing columns of these names; other columns are
    untouched. A page of nothing but boilerplate keeps an empty text. A null text stays null
    with 0 lines, an empty one is one blank line; null hosts lose nothing. Blank lines stay.
    Repeated rows count as pages of their own, unless ``once`` counts equal texts of a host once,
    and are treated alike.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    # The stored table's size lets Spark send it to all tasks if it is small; else it is salted.
    drop = scratch.store(
        boilerplate(docs, host_col, text_col, ratio, min_pages, once).withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        ),
        "boilerplate",
    )
    pages = docs.select(row).withColumns(
        {
            "host": F.col(f"row.`{host_col}`"),
            "text": F.col(f"row.`{text_col}`"),
            "salt": F.pmod(F.xxhash64(F.col(f"row.`{text_col}`")) + F.spark_partition_id(), F.lit(SALTS)).cast("int"),
        }
    )
    keys = F.coalesce("keys", F.array().cast("array<struct<x:bigint,y:bigint>>"))
    kept = F.filter("lines", lambda s: (F.trim(s) == "") | ~F.array_contains(F.col("keys"), _key(s)))
    done = (
        pages.join(drop, ["host", "salt"], "left")
        .withColumns({"lines": F.split("text", "\n"), "keys": keys})
        .withColumn("kept", F.when(F.size("keys") == 0, F.col("lines")).otherwise(kept))
    )
    out = [F.array_join("kept", "\n").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names]
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines"))
    gone = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines") - F.size("kept"))
    return done.select(*out, count.alias("n_lines"), gone.alias("n_dropped"))
