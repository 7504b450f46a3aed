"""Hard negatives: exact searches by inner product in cover trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poilake.llm.cover_tree import Ask, CoverTree, build, search
from poilake.llm.scratch import Scratch
from poilake.operators.order import global_index

#: Rows of a tree.
TREE = 2_048
#: Rows of the trees, and anchors, that meet in one task's group.
BLOCK, CHUNK = 4_096, 4_096

#: Where an id is null; such rows come last among equals.
_NULL = np.iinfo(np.int64).max
_PARTS = [name for name in CoverTree._fields if name != "radius"]
_TREE = "tree long, ids binary, labels binary, vectors binary, radius binary, " + ", ".join(f"{n} binary" for n in _PARTS)


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """A float matrix, missing components 0; exact while squared norms stay below 2^53."""
    lists = column.combine_chunks()
    out = np.zeros((len(lists), dim))
    length = np.diff(np.asarray(lists.offsets))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(lists)), length), np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)] = values
    if np.einsum("ij,ij->i", out, out).max(initial=0.0) >= 2.0**53:
        raise ValueError("a squared norm of 2^53 or more: inner products would not be exact")
    return out


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_NULL).to_numpy().astype(np.int64)


def _plant(dim: int):
    """One stored tree of the rows of a group."""

    def run(table: pa.Table) -> pa.Table:
        vectors = _vectors(table.column("vec"), dim)
        tree = build(vectors)
        row = {
            "tree": table.column("tree")[0].as_py(),
            "ids": _longs(table.column("id")).tobytes(),
            "labels": _longs(table.column("label")).tobytes(),
            "vectors": vectors.tobytes(),
            "radius": tree.radius.tobytes(),
        } | {n: getattr(tree, n).astype(np.int64).tobytes() for n in _PARTS}
        kinds = {n: pa.int64() if n == "tree" else pa.binary() for n in row}
        return pa.table({n: pa.array([v], kinds[n]) for n, v in row.items()})

    return run


def _trees(table: pa.Table):
    """The stored trees with their vectors, ids and labels, one after the other."""
    for row in table.to_pylist():
        long = {n: np.frombuffer(row[n], dtype=np.int64) for n in [*_PARTS, "ids", "labels"]}
        tree = CoverTree(radius=np.frombuffer(row["radius"]), **{n: long[n] for n in _PARTS})
        vectors = np.frombuffer(row["vectors"]).reshape(len(long["ids"]), -1)
        yield tree, vectors, long["ids"], long["labels"]


def _found(rows: dict[str, list[np.ndarray]]) -> pa.Table:
    flat = {n: np.concatenate(v) if v else np.empty(0, dtype=np.int64) for n, v in rows.items()}
    return pa.table({n: pa.array(v, pa.int64(), mask=v == _NULL if n == "id" else None) for n, v in flat.items()})


def _positives(dim: int, k: int):
    """The ``k`` best other rows of an anchor's label in the trees of a group."""

    def run(trees: pa.Table, anchors: pa.Table) -> pa.Table:
        queries = _vectors(anchors.column("vec"), dim)
        anchor, own, label = (_longs(anchors.column(n)) for n in ("anchor", "id", "label"))
        asks = [Ask(k, [(-np.inf, np.inf)]) for _ in anchor]
        for tree, vectors, ids, labels in _trees(trees) if len(asks) else ():

            def allowed(q: int, rows: np.ndarray) -> np.ndarray:
                out = labels[rows] == label[q]
                at = np.flatnonzero(out & (ids[rows] == own[q]))  # itself, not another row of its id
                out[at[(vectors[rows[at]] == queries[q]).all(axis=1)]] = False
                return out

            some = np.flatnonzero(np.isin(label, labels))
            search(tree, vectors, ids, queries[some], [asks[q] for q in some], lambda q, rows: allowed(some[q], rows))
        best = [ask.best[0] for ask in asks]
        return _found(
            {
                "anchor": [np.full(len(b.ids), a) for a, b in zip(anchor, best)],
                "id": [b.ids for b in best],
                "score": [b.scores for b in best],
            }
        )

    return run


def _negatives(dim: int, k: int, low: int, high: int):
    """The ``k`` best rows of other labels for each positive of an anchor, in the trees of a group."""

    def run(trees: pa.Table, anchors: pa.Table) -> pa.Table:
        queries = _vectors(anchors.column("vec"), dim)
        anchor, label = (_longs(anchors.column(n)) for n in ("anchor", "label"))
        # 100 * n >= low * p and 100 * n <= high * p, in integers
        asks = [Ask(k, [(-(-low * p // 100), high * p // 100) for p in scores]) for scores in anchors.column("scores").to_pylist()]
        for tree, vectors, ids, labels in _trees(trees) if len(asks) else ():
            search(tree, vectors, ids, queries, asks, lambda q, rows: labels[rows] != label[q])
        found = [(a, place, b) for a, ask in zip(anchor, asks) for place, b in enumerate(ask.best)]
        return _found(
            {
                "anchor": [np.full(len(b.ids), a) for a, _, b in found],
                "place": [np.full(len(b.ids), place) for _, place, b in found],
                "id": [b.ids for _, _, b in found],
                "score": [b.scores for _, _, b in found],
            }
        )

    return run


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives.

    Scores are inner products of integer vectors (array<long>), higher first, ties by smaller
    id. An anchor's positives are its best ``positives`` other rows of its label; for each, the
    best ``negatives`` rows of other labels are returned that score from ``low`` to ``high``
    percent of it. Negative and zero positives follow the same inequality.

    All rows are held in cover trees of bounded size; every anchor searches every tree, in
    groups of ``BLOCK`` rows and ``CHUNK`` anchors, and what the trees return is merged. The
    search is exact. Of rows with one vector and label only those with the smallest ids can be
    returned, so the others are left out beforehand: a vector that a third of all rows have
    is a few rows of one tree.

    Rows with a null label or vector, or a null component, take no part. Fully repeated rows are
    one row; rows that share an id only are different rows. Rows with a null id are never
    anchors of a condition on it and come last among equals. Shorter vectors count as filled up
    with zeros. No rows, or no anchors, give no rows. Other columns are not read. Squared norms
    of 2^53 and more raise an error. The trees are planted when this is called; the result is
    stored.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    whole = F.forall(vec_col, lambda x: x.isNotNull())
    clean = rows.where(F.col(label_col).isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vec_col).cast("array<long>").alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    clean, clean_path = scratch.store_at(clean.dropDuplicates(["id", "label", "vec"]), "rows")
    dim = clean.agg(F.max(F.size("vec"))).first()[0] or 1
    # The anchor itself may be one of the copies.
    copies = Window.partitionBy("label", "vec").orderBy(F.col("id").asc_nulls_last())
    few = clean.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= max(positives + 1, negatives))
    placed = global_index(few.select("id", "label", "vec"), ["label", "vec", "id"])
    grown = (
        placed.withColumn("tree", F.floor(F.col("idx") / TREE))
        .groupBy("tree")
        .applyInArrow(_plant(dim), _TREE)
    )
    trees, trees_path = scratch.store_at(grown, "trees")
    anchors = global_index(clean.where("asks").select("id", "label", "vec"), ["id", "label", "vec"], "anchor")
    counts = trees.agg(F.max("tree")).first()[0], anchors.agg(F.max("anchor")).first()[0]
    blocks, chunks = (0 if n is None else int(n) // size + 1 for n, size in zip(counts, (BLOCK // TREE, CHUNK)))

    def meet(asking: DataFrame, run, kind: str) -> DataFrame:
        """All anchors with all trees, by equal (block, chunk)."""
        left = trees.withColumn("block", F.floor(F.col("tree") / (BLOCK // TREE)).cast("int")).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
        )
        right = asking.withColumn("chunk", F.floor(F.col("anchor") / CHUNK).cast("int")).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        )
        return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(run, kind)

    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not blocks or not chunks:
        return spark.createDataFrame([], names)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    near = meet(anchors, _positives(dim, positives), "anchor long, id long, score long")
    near = near.withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < positives)
    near, near_path = scratch.store_at(near, "positives")
    scores = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score")))["score"].alias("scores"))
    asking = anchors.select("anchor", "label", "vec").join(scores, "anchor")
    hard = meet(asking, _negatives(dim, negatives, low, high), "anchor long, place long, id long, score long")
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    hard = hard.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    out = (
        hard.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(near.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}), ["anchor", "place"])
        .join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
    out = scratch.store(out, "negatives")
    scratch.drop(clean_path, trees_path, near_path)
    return out
