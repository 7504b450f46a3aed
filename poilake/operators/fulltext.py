"""Full-text search in a stored inverted index."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from poilake.sources.files import path_exists

#: Saturation of repeated words and weight of a text's length (the usual values).
K1, B = 1.2, 0.75


def terms_of(text: Column) -> Column:
    """A text's words in lower case: runs of letters, digits and underscores."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), "")


def _counted(words: Column) -> Column:
    """Each different word with its count, as structs (term, n): the runs of the sorted words."""

    def runs(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 1)  # of no words 0 and -1, which begin no run
        starts = F.filter(places, lambda i: ~F.get(w, i).eqNullSafe(F.get(w, i - 1)))
        return F.transform(F.array(starts), lambda s: spans(w, s))[0]

    def spans(w: Column, starts: Column) -> Column:
        end = F.size(w)
        return F.transform(
            starts,
            lambda s, j: F.struct(F.get(w, s).alias("term"), (F.coalesce(F.get(starts, j + 1), end) - s).cast("long").alias("n")),
        )

    # One-element arrays, so that the words are sorted and the runs found once.
    return F.transform(F.array(F.sort_array(words)), runs)[0]


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(buckets)).cast("int")


def index_texts(
    docs: DataFrame, path: str, segment: str, id_col: str, text_col: str, stored: Sequence[str] = (), buckets: int = 64
) -> None:
    """Write a segment of the index below ``path``; runs when called.

    ``postings`` hold a row per term and document with its count and length and the ``stored``
    columns, ``terms`` the document frequencies, ``documents`` ids and lengths, ``totals`` their
    sums. Postings are sorted by term within ``buckets`` folders by the term's hash, so a search
    reads the row groups of its terms; all segments have as many as the first. The words of a document are counted in its row, and
    a term of most documents is split over several files.

    Ids are unique in ``docs``. Documents that another segment has are left out, so segments
    don't overlap; writing a segment again replaces it. Null and empty texts are documents
    without terms.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), *stored, F.col(text_col).alias("text"))
    if path_exists(spark, f"{path}/totals"):
        buckets = spark.read.parquet(f"{path}/totals").agg(F.min("buckets")).first()[0]
    if path_exists(spark, f"{path}/documents"):
        known = spark.read.schema(_with(rows.select("id").schema, "segment string")).parquet(f"{path}/documents")
        known = known.where(F.col("segment") != segment).select(F.col("id").alias("known"))
        rows = rows.join(known, F.col("id").eqNullSafe(F.col("known")), "left_anti")
    rows = rows.withColumn("words", terms_of(F.col("text"))).withColumn("length", F.size("words").cast("long"))
    # Texts are shuffled, not their words; rows of one id and length are one document.
    whole = rows.groupBy("id", *stored, "length").agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    postings = whole.select("id", *stored, "length", F.inline(_counted(terms_of(F.col("text")))))
    postings = postings.withColumn("bucket", _bucket(F.col("term"), buckets))
    target = f"{path}/postings/segment={segment}"
    _write(postings, target)
    own = spark.read.schema(postings.schema).parquet(target)
    _write(own.groupBy("bucket", "term").agg(F.count("*").alias("documents")), f"{path}/terms/segment={segment}")
    # Last, and not by folders: these also have a schema when the segment is empty.
    target = f"{path}/documents/segment={segment}"
    rows.select("id", *stored, "length").write.mode("overwrite").parquet(target)
    totals = spark.read.parquet(target).agg(
        F.count("*").alias("documents"), F.coalesce(F.sum("length"), F.lit(0)).alias("words"),
        F.lit(buckets).alias("buckets"),
    )
    totals.write.mode("overwrite").parquet(f"{path}/totals/segment={segment}")


def _with(schema: StructType, more: str) -> StructType:
    return StructType([*schema.fields, *StructType.fromDDL(more).fields])


def _write(df: DataFrame, path: str) -> None:
    dealt = df.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


def _terms(df: DataFrame, words: Sequence[str], buckets: int) -> DataFrame:
    own = sorted({zlib.crc32(w.encode()) % buckets for w in words})
    return df.where(F.col("bucket").isin(own) & F.col("term").isin(list(words)))


def search_index(
    spark: SparkSession, path: str, query: str, k: int, tie: Sequence[str] = ("id",)
) -> DataFrame:
    """The best ``k`` documents of an index for the words of ``query``: id, stored columns, matches, weight.

    A word weighs by its rarity, its count in the text and the text's length (Okapi BM25).
    Only the folders of the query's words are read. A query without words finds nothing.
    """
    documents = spark.read.parquet(f"{path}/documents").drop("segment", "length")
    shown = documents.columns
    words = spark.range(1).select(F.array_distinct(terms_of(F.lit(query)))).first()[0]
    totals = spark.read.parquet(f"{path}/totals").agg(F.sum("documents"), F.sum("words"), F.min("buckets")).first()
    schema = _with(documents.schema, "length long, term string, n long, bucket int, segment string")
    found = _terms(spark.read.schema(schema).parquet(f"{path}/postings"), words, totals[2])
    schema = StructType.fromDDL("term string, documents long, bucket int, segment string")
    counts = _terms(spark.read.schema(schema).parquet(f"{path}/terms"), words, totals[2])
    counts = counts.groupBy("term").agg(F.sum("documents"))
    common = {r[0]: r[1] for r in counts.collect()}  # one row per word of the query at most
    rarity = F.lit(0.0)
    for word, df in common.items():
        rare = F.log(F.lit(1 + (totals[0] - df + 0.5) / (df + 0.5)))
        rarity = F.when(F.col("term") == word, rare).otherwise(rarity)
    mean = (totals[1] / totals[0] if totals[0] else 0.0) or 1.0
    weight = rarity * F.col("n") * (K1 + 1) / (F.col("n") + K1 * (1 - B + B * F.col("length") / mean))
    ranked = found.groupBy(*shown).agg(
        F.count("*").cast("int").alias("matches"), F.round(F.sum(weight), 6).alias("weight")
    )
    return ranked.orderBy(F.desc("weight"), *[F.asc_nulls_last(t) for t in tie]).limit(k)
