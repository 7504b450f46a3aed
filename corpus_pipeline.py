"""The corpus pipeline: documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from poilake.llm import decontaminate, linededup, packing, queries, simhash, toxicity
from poilake.llm.scratch import Scratch

#: Documents that score as much are rejected.
TOXIC = 0.3


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of the row's id and text, never null, and its name.

    Keys sort like ids, a null id last. Only rows that repeat an id and a text share a key.
    """
    name, doc_id = _free(docs, "_key"), F.col("doc_id")
    shown = doc_id.cast("string")
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        shown = F.lpad(F.hex(doc_id.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    front = F.when(doc_id.isNull(), "1").otherwise(F.concat(F.lit("0"), shown, F.lit("\0")))
    mark = F.concat(F.hex(F.xxhash64("text")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "text")))
    return docs.withColumn(name, F.concat(front, mark)), name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; labels are only used to learn the model."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = _free(docs, "_judged")
    kept = docs.withColumn(name, toxicity.judged(model, F.col("text")))
    return kept.where(F.col(name)["score"] < TOXIC).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines; ``n_chars`` follows the text."""
    cut = linededup.drop_boilerplate(docs, ratio=queries.BOILERPLATE, once=True)
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each near-copy group; of repeated rows one."""
    scratch = Scratch(spark, "copies")
    keyed, key = _keyed(docs)
    found = simhash.near_duplicates(keyed, id_col=key)
    marked = found.groupBy("id").agg(F.max(F.col("id") != F.col("component")).alias("copy"), F.count("*").alias("n"))
    marked = scratch.store(marked.where("copy or n > 1").select(F.col("id").alias(key), "copy"), "marked")
    # Texts are shuffled once: repeated rows are few, and a table of their own shows it to the optimizer.
    many = scratch.store(marked.where("not copy").select(key), "repeated")
    kept = keyed.join(marked, key, "left_anti").select(*docs.columns)
    repeated = keyed.join(many, key, "left_semi")
    # The least by the row's JSON, as maps have no order.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = F.min_by(row, F.sha2(F.to_json(row), 256)).alias("one")
    return kept.unionByName(repeated.groupBy(key).agg(one).select("one.*"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    keyed, key = _keyed(docs)
    found = decontaminate.leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    gone = found.select(F.col("doc").alias(key)).distinct()
    return keyed.join(Scratch(spark, "leaked").store(gone, "gone"), key, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    return packing.pack(docs, queries.tokenizer_path()).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: Fingerprints, alignments and a tokenizer's ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.store(docs, name)
    return docs
