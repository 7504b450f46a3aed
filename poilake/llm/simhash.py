"""SimHash near duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.llm.components import components
from poilake.llm.memory import give_back
from poilake.llm.scratch import Scratch

BITS = 64
SEED = 42
#: Shingles whose bits are counted at once: 64 bytes each while they are unpacked.
_AT_ONCE = 1 << 15
#: Above this many fingerprints in a block, centres (see ``links``) cost less than pairs.
CROWDED = 100


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned fingerprint of one text: bit i is set if it is in over half of the shingle hashes.

    A-Z count as a-z, words are runs without ASCII white space, shingles count as often as they
    occur. Fewer words than ``shingle`` make one shingle; null and blank texts give 0.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), _AT_ONCE):
        raw = values[at : at + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(raw, axis=1, bitorder="little"), axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) of every row; fp holds the 64 bits as a long. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # ids are passed on as they are
            bits = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["id", "fp"])
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _long(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(max_bits: int, keep: int) -> list[int]:
    """Masks of every choice of ``keep`` out of ``max_bits`` + ``keep`` equal blocks.

    Two fingerprints that differ in ``max_bits`` bits spoil at most as many blocks, so they
    agree on all bits of one of these masks.
    """
    n = max_bits + keep
    edges = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, keep)]


def centre_masks(max_bits: int) -> tuple[list[int], list[int]]:
    """(near, far): flips that lead from fingerprints to the centres by which links are found.

    Any two within ``max_bits`` have a centre that both reach by near flips, or one by a near
    and the other by a far flip. For an odd ``max_bits`` = 2r + 1 one half of the fingerprint
    holds at least r + 1 of the differing bits, so far flips are r + 1 bits of one half.
    """
    r = max_bits // 2
    near = [sum(1 << b for b in bits) for k in range(r + 1) for bits in combinations(range(BITS), k)]
    half = BITS // 2
    far = [
        sum(1 << (b + start) for b in bits)
        for start in (0, half)
        for bits in combinations(range(half), r + 1)
        if max_bits % 2
    ]
    return near, far


def _hamming(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, scratch: Scratch, max_bits: int = 3, keep: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` with the components of all close pairs.

    Fingerprints meet in the blocks they share. In a block of at most ``CROWDED`` of them, every
    pair is compared. In larger blocks, which hold families of near copies, pairs would go with
    the square of the family: their members meet at centres instead (``centre_masks``). A
    centre's members are linked to its least near member, all of them within ``max_bits`` of it;
    a centre has as many members as there are flips at most. Both ways find every close pair's
    connection, whatever the size of the block; every link is checked by its Hamming distance.
    """
    masks = block_masks(max_bits, keep)
    keys = fps.select(
        "fp",
        F.explode(
            F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_long(m)))) for i, m in enumerate(masks)])
        ).alias("key"),
    )
    sizes = scratch.store(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "blocks")
    shared = scratch.store(keys.join(sizes, "key"), "shared")
    small = shared.where(F.col("n") <= CROWDED)
    pairs = (
        small.select("key", F.col("fp").alias("a"))
        .join(small.select("key", F.col("fp").alias("b")), "key")
        .where(F.col("a") < F.col("b"))
        .where(_hamming("a", "b") <= max_bits)
        .select("a", "b")
    )
    near, far = centre_masks(max_bits)
    flips = [(F.lit(_long(m)), F.lit(m_near)) for m_near, part in ((True, near), (False, far)) for m in part]
    crowd = shared.where(F.col("n") > CROWDED).select("fp").distinct()
    centres = (
        crowd.select("fp", F.explode(F.array(*[F.struct(m.alias("m"), k.alias("near")) for m, k in flips])).alias("f"))
        .select(F.col("fp").bitwiseXOR(F.col("f.m")).alias("z"), "fp", F.col("f.near").alias("near"))
        .groupBy("z")
        .agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.collect_list("fp").alias("members"))
        .where(F.col("b").isNotNull() & (F.size("members") > 1))
        .select("b", F.explode("members").alias("a"))
        .where(F.col("a") != F.col("b"))
        .where(_hamming("a", "b") <= max_bits)
        .select("a", "b")
    )
    return pairs.unionAll(centres)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, keep: int = 3
) -> DataFrame:
    """(id, fp, component) for every row: component is the least id reachable over close fingerprints.

    Fingerprints are close when they differ in at most ``max_bits`` bits. Rows of equal
    fingerprints become one node first, so copies cost one row each. Null, blank and repeated
    texts are linked like any other; rows repeated with their id stay repeated; a null id is
    never a component unless all ids of the component are null. No rows give no rows. Raise
    ``keep`` for more documents: blocks have ``keep`` / (``max_bits`` + ``keep``) of the 64 bits.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.store(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = scratch.store(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    joined = components(links(nodes.select("fp"), scratch, max_bits, keep), scratch)
    member = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = member.groupBy("root").agg(F.min("least").alias("component"))
    # Copies of one text may be a third of all rows: each class is dealt to several tasks.
    salts = 16
    classes = (
        member.join(least, "root")
        .select("fp", "component")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return salted.join(scratch.store(classes, "classes"), ["fp", "salt"]).select("id", "fp", "component")
