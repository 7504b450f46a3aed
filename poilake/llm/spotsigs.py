"""SpotSigs document fingerprints: chains of content words behind common-word anchors."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from poilake.llm.scratch import Scratch
from poilake.operators.order import global_index

#: Common words of English, German, French and Spanish.
ANCHORS = tuple(
    "a an and are as at be by for from has in is it of on or that the this to was were with "
    "auf das den der des die ein eine für ist mit nicht sich und von zu "
    "au avec ce dans de des du elle en est et la le les par pas pour que qui un une "
    "con del el los no por se su una y".split()
)
#: Ids that share a window when neighbours are paired.
RUN = 256


def _pattern(words: Sequence[str]) -> str:
    """A regular expression of the words that shares their beginnings, longest match first."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def of(node: dict) -> str:
        parts = [re.escape(letter) + of(node[letter]) for letter in sorted(filter(None, node))]
        if not parts:
            return ""
        return f"(?:{'|'.join(parts)})" + ("?" if "" in node else "")

    return of(tree)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def spots(text: Column, anchors: Sequence[str] = ANCHORS) -> Column:
    """The distinct spot signatures of a text, sorted: array of long; empty for null and blank.

    Words are lower-case runs of letters and digits. A run of anchors, or the start of the text,
    makes a signature with the two content words behind it; at the end of the text there may be
    one or none. Texts that differ only in case and punctuation have the same signatures.
    """
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    plain = F.concat(F.trim(plain), F.lit(" "))
    # An anchor is glued to the word behind it, so that each token ends in a content word.
    glued = F.regexp_replace(plain, f"(?<![^ ])({_pattern(anchors)}) ", "$1_")

    def chain(g: Column) -> Column:
        empty = F.array().cast("array<string>")
        return F.when(g == " ", empty).otherwise(F.split(F.concat(F.lit("^_"), F.trim(g)), " "))

    def spot(a: Column, b: Column) -> Column:
        return F.when(
            a.contains("_"), F.xxhash64(a, F.substring_index(F.coalesce(b, F.lit("")), "_", -1))
        )

    def found(c: Column) -> Column:
        following = F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
        return F.filter(F.zip_with(c, following, spot), lambda h: h.isNotNull())

    return F.array_sort(F.array_distinct(_let(_let(glued, chain), found)))


def fingerprint(signatures: Column) -> Column:
    """A short name of a signature set: its size and a hash, equal for equal sets."""
    return F.concat(F.size(signatures).cast("string"), F.lit("-"), F.lower(F.lpad(F.hex(F.xxhash64(signatures)), 16, "0")))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without a comparison if it cannot reach ``least``.

    The similarity is at most the smaller size over the larger one, which prunes most pairs.
    Two empty sets are alike (1), an empty and another one are not (0).
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < F.lit(least) * large), F.lit(0.0))
        .otherwise(both / (F.size(a) + F.size(b) - both))
    )


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors: Sequence[str] = ANCHORS) -> DataFrame:
    """(id, spots, fingerprint) per row. Repeated rows stay; other columns are not read."""
    rows = docs.select(F.col(id_col).alias("id"), spots(F.col(text_col), anchors).alias("spots"))
    return rows.withColumn("fingerprint", fingerprint(F.col("spots")))


def _length_class(size: Column, least: float) -> Column:
    """Number of the partition of set lengths; sets alike are in the same or in neighbouring ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.log(F.lit(1 / least))).cast("int")


def matches(queries: DataFrame, rows: DataFrame, least: float = 0.8) -> DataFrame:
    """(query, id, likeness) of all ``rows`` at least ``least`` like a stated set of ``queries``.

    Both hold (id, spots). Sets are partitioned by length; a query meets the rows of its own and
    the neighbouring partitions that share one of its rarest signatures: of n signatures, any
    n - ceil(least n) + 1 hold one that every set alike has. Rows of equal sets are compared
    once. Empty sets match nothing. ``rows`` may have any number of equal ids.
    """
    scratch = Scratch(rows.sparkSession, "spots")
    rows = rows.where(F.size("spots") > 0).withColumn("name", F.xxhash64("spots"))
    sets = scratch.store(rows.select("spots").distinct().withColumn("set", F.monotonically_increasing_id()), "sets")
    asked = queries.where(F.size("spots") > 0).select(F.col("id").alias("query"), F.col("spots").alias("wanted"))
    df = sets.select(F.explode("spots").alias("s")).groupBy("s").agg(F.count("*").alias("df"))
    keep = F.size("wanted") - F.ceil(F.lit(least) * F.size("wanted")) + 1
    rare = (
        asked.select("query", "wanted", F.explode("wanted").alias("s"))
        .join(df, "s")
        .groupBy("query", "wanted")
        .agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("ranked"))
        .select("query", "wanted", F.explode(F.slice("ranked", 1, keep.cast("int"))).alias("r"))
        .select("query", "wanted", F.col("r.s").alias("s"), F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("step"))
        .withColumn("part", _length_class(F.size("wanted"), least) + F.col("step"))
    )
    index = sets.select("set", F.explode("spots").alias("s"), _length_class(F.size("spots"), least).alias("part"))
    candidates = rare.join(index, ["s", "part"]).select("query", "set").distinct()
    scored = (
        candidates.join(asked, "query")
        .join(sets, "set")
        .withColumn("likeness", likeness(F.col("wanted"), F.col("spots"), least))
        .where(F.col("likeness") >= least)
        .select("query", "likeness", "spots")
    )
    return scored.join(rows, "spots").select("query", "id", "likeness")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Window]:
    """(kind, run, ghost, pos, id, text, next_text) and the window in which neighbours are paired.

    The next document is that of the next larger id, after the last one the first. Null ids come
    before all others, by their texts; rows that repeat an id follow each other by their texts.
    Ids of any type that can be ordered will do. Runs of ``RUN`` consecutive ids, or positions
    where ids are null or no integers, share a window, and the first document of each run is
    copied to the run before (``ghost`` 1), so no task sees more than one run of texts.
    """
    scratch = Scratch(docs.sparkSession, "next")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = F.lit(1).alias("kind")
    if isinstance(rows.schema["id"].dataType, IntegralType):
        known = rows.where("id is not null").withColumns({"kind": kind, "pos": F.col("id").cast("long")})
        lost = global_index(rows.where("id is null"), [F.xxhash64("text"), "text"], "pos").withColumn("kind", F.lit(0))
        rows = known.unionByName(lost)
    else:
        rows = global_index(rows, ["id", F.xxhash64("text"), "text"], "pos").withColumn("kind", kind)
    run = F.floor(F.col("pos") / RUN).alias("run")
    firsts = rows.select("kind", "pos", run).groupBy("kind", "run").agg(F.min("pos").alias("pos"))
    firsts = global_index(firsts, ["kind", "pos"], "idx")
    n = firsts.count()
    before = firsts.select(
        F.pmod(F.col("idx") + 1, F.lit(max(n, 1))).alias("idx"), F.col("kind").alias("kind_before"), "run"
    )
    ghosts = firsts.select("kind", "pos", "idx").join(before, "idx").select("kind", "pos", "kind_before", "run")
    ghosts = scratch.store(ghosts, "firsts")
    columns = ["kind", "run", "ghost", "pos", "id", "text"]
    copied = rows.join(ghosts, ["kind", "pos"]).drop("kind").withColumnRenamed("kind_before", "kind")
    both = rows.withColumns({"run": run, "ghost": F.lit(0)}).select(*columns).unionByName(
        copied.withColumn("ghost", F.lit(1)).select(*columns)
    )
    window = Window.partitionBy("kind", "run").orderBy("ghost", "pos", F.xxhash64("text"), "text")
    return both.withColumn("next_text", F.lead("text").over(window)), window
