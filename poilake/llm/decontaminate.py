"""Benchmark decontamination: n-gram seeds find passages, local alignment scores them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poilake.llm.memory import give_back
from poilake.llm.scratch import Scratch

#: Words of a seed.
N = 3
#: Bits of the filter that tasks hold: 1 MiB, whatever the size of the benchmark. A fuller
#: filter lets more n-grams through to the join; it never loses one.
FILTER_BITS = 1 << 23
#: Alignment scores of an equal word, another word, a word too many or too few.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Seeds are copied this often where they are joined, as one passage may be in a third of all rows.
SALTS = 8
#: Words around a hit's diagonal that an alignment may drift to by insertions or deletions.
DRIFT = 16
#: Words to both sides of a hit that are compared with an item before an alignment, at most;
#: every hit of an item that needs more is aligned.
REACH = 512
#: Seeds have at most so many times the hits of their item's rarest quarter; of so many places
#: in a row so many are seeds in any case.
RARE, STRETCH, FEWEST = 4, 8, 2
#: Hits that are emitted at once.
_EMIT = 4_096

_SPACES = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)  # any odd number


def words(text: str | None) -> list[bytes]:
    """Lower-case words of UTF-8 bytes; ASCII white space and punctuation separate them."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACES).split()


def grams(tokens: list[bytes], n: int) -> np.ndarray:
    """A 64-bit hash of each n-gram, in order; equal n-grams have equal hashes."""
    if len(tokens) < n:
        return np.empty(0, dtype=np.uint64)
    codes = np.fromiter(map(crc32, tokens), dtype=np.uint64, count=len(tokens)) + np.uint64(1)
    out = np.zeros(len(tokens) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = (out ^ codes[i : len(codes) - n + 1 + i]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def codes(tokens: list[bytes]) -> np.ndarray:
    """A 16-bit hash of each word; equal words have equal codes."""
    return np.fromiter(map(crc32, tokens), dtype=np.uint32, count=len(tokens)).astype(np.uint16)


def align(passage: list[bytes], item: list[bytes]) -> tuple[int, int]:
    """(score, end) of the best local alignment (Smith-Waterman) of an item in a passage."""
    code = {w: i for i, w in enumerate(set(item))}
    text = np.array([code.get(w, -1) for w in passage], dtype=np.int64)
    steps = np.arange(len(text) + 1, dtype=np.int64) * -GAP
    row, best, end = np.zeros(len(text) + 1, dtype=np.int64), 0, 0
    for w in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(text == code[w], MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        # Gaps along the passage: the best of all cells to the left, less a gap for each step.
        row = np.maximum.accumulate(new + steps) - steps
        if row.max() > best:
            best, end = int(row.max()), int(row.argmax())
    return best, end


def _reach(words: int, least: float) -> int:
    """How far from a hit an alignment of ``least`` can go, for items of so many words.

    A power of two, so that few differ; 0 beyond ``REACH``, where words around a hit are not compared.
    """
    reach = math.ceil(words * (1 + 2 * max(0.0, 1 - least))) + 2 * DRIFT
    reach = 1 << (reach - 1).bit_length()
    return reach if reach <= REACH else 0


def _items(benchmark: DataFrame, item_col: str, text_col: str, least: float) -> DataFrame:
    """(item, place, gram, reach) for every n-gram of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                body = words(text.as_py())
                found = grams(body, N)
                if n := len(found):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(np.full(n, i))),
                            pa.array(np.arange(n), pa.int32()),
                            pa.array(found.view(np.int64)),
                            pa.array(np.full(n, _reach(len(body), least)), pa.int32()),
                        ],
                        names=["item", "place", "gram", "reach"],
                    )

    kind = benchmark.schema[item_col].dataType.simpleString()
    return benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).mapInArrow(
        run, f"item {kind}, place int, gram long, reach int"
    )


def _filters(items: DataFrame) -> dict[int, bytes]:
    """For each reach a bit for each of its n-grams; tasks merge what they have, so its size is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            reach, gram = (batch.column(i).to_numpy() for i in (0, 1))
            for r in np.unique(reach).tolist():
                bits.setdefault(r, np.zeros(FILTER_BITS, dtype=bool))[gram[reach == r].view(np.uint64) % np.uint64(FILTER_BITS)] = True
        for r, some in bits.items():
            packed = np.packbits(some).view("<i8")
            at = np.flatnonzero(packed)
            columns = [pa.array(np.full(len(at), r), pa.int32()), pa.array(at), pa.array(packed[at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["reach", "at", "word"])

    rows = items.select("reach", "gram").mapInArrow(run, "reach int, at long, word long")
    found = rows.groupBy("reach", "at").agg(F.bit_or("word").alias("word")).toArrow()  # FILTER_BITS / 64 rows a reach at most
    reach, at, word = (found.column(i).to_numpy() for i in range(3))
    out = {}
    for r in np.unique(reach).tolist():
        whole = np.zeros(FILTER_BITS // 64, dtype="<i8")
        whole[at[reach == r]] = word[reach == r]
        out[r] = whole.tobytes()
    return out


def _vocabulary(benchmark: DataFrame, text_col: str) -> np.ndarray:
    """Whether a code is that of a word of the benchmark, for each of the 65,536 codes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [codes(words(text)) for text in batch["text"]]
            yield pd.DataFrame({"code": np.unique(np.concatenate(found)).astype(np.int32) if found else []})

    rows = benchmark.select(F.col(text_col).alias("text")).mapInPandas(run, "code int").distinct().toPandas()
    known = np.zeros(1 << 16, dtype=bool)
    known[rows["code"].to_numpy(dtype=np.int64)] = True
    return known


def _hits(docs: DataFrame, id_col: str, text_col: str, held, known: np.ndarray) -> DataFrame:
    """(doc, pos, gram, reach, near) for the n-grams of whole texts that pass a filter.

    ``near`` holds the codes of the benchmark's words within ``reach`` words; null for reach 0.
    Ids are passed on as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {r: np.frombuffer(bits, dtype=np.uint8) for r, bits in held.value.items()}
        for batch in batches:
            rows: list[tuple[int, int, int, int, bytes | None]] = []

            def out() -> pa.RecordBatch:
                whose, pos, gram, reach, near = zip(*rows)
                columns = [batch.column(0).take(pa.array(whose, pa.int64()))]
                columns += [pa.array(v, k) for v, k in zip((pos, gram, reach, near), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))]
                rows.clear()
                return pa.RecordBatch.from_arrays(columns, names=["doc", "pos", "gram", "reach", "near"])

            for i, text in enumerate(batch.column(1)):
                body = words(text.as_py())
                hashes = grams(body, N)
                bit = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
                byte, shift, code = bit >> 3, (bit & 7).astype(np.uint8), None
                for reach, bits in filters.items():
                    for p in np.flatnonzero((bits[byte] << shift) & 128).tolist():
                        near = None
                        if reach:
                            code = codes(body) if code is None else code
                            around = code[max(0, p - reach) : p + reach + 1]
                            near = np.unique(around[known[around]]).tobytes()
                        rows.append((i, p, int(hashes[p].view(np.int64)), reach, near))
                        if len(rows) >= _EMIT:
                            yield out()
            if rows:
                yield out()
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc {kind}, pos int, gram long, reach int, near binary"
    )


def _rare(items: DataFrame, hits: DataFrame) -> DataFrame:
    """The n-grams of ``items`` that are seeds: those rare among the ones of their item that occur.

    An n-gram is rare if it has at most ``RARE`` times the hits of the item's rarest quarter, so
    a passage that is copied often has its own n-grams as seeds, but not the common words in it.
    Of each ``STRETCH`` places the ``FEWEST`` rarest are seeds in any case. N-grams that no
    document has do not compete.
    """
    seen = hits.groupBy("gram").agg(F.count("*").alias("df"))
    known = items.join(seen, "gram")
    usual = known.groupBy("item").agg(F.percentile("df", F.lit(0.25)).alias("usual"))
    stretch = Window.partitionBy("item", F.floor(F.col("place") / STRETCH)).orderBy("df", "place")
    known = known.withColumn("nth", F.row_number().over(stretch)).withColumnRenamed("item", "_item")
    rare = (F.col("df") <= RARE * F.col("usual")) | (F.col("nth") <= FEWEST)
    return known.join(usual, F.col("_item").eqNullSafe(F.col("item"))).where(rare).select("item", "place", "gram", "reach")


def _may(near: Column, item_text: Column, least: float) -> Column:
    """Whether so many of an item's words are near a hit that its score can reach ``least``."""

    @F.pandas_udf("boolean")
    def run(near: pd.Series, item_text: pd.Series) -> pd.Series:
        memo: dict[str, np.ndarray] = {}
        out = []
        for some, text in zip(near, item_text):
            if some is None:
                out.append(True)
                continue
            if text not in memo:
                memo[text] = codes(words(text))
            want = memo[text]
            shared = np.isin(want, np.frombuffer(some, dtype=np.uint16)).sum()
            out.append(bool(shared >= least * len(want) - 1e-9))
        return pd.Series(out, dtype=bool)

    return run(near, item_text)


def _spans(starts: list[int], body: int, item: int) -> Iterator[tuple[int, int]]:
    """The parts of a text, merged where they overlap, that alignments from ``starts`` can reach."""
    low = high = None
    for start in sorted(starts):
        a, b = max(0, start - DRIFT), min(body, start + item + 2 * DRIFT)
        if high is not None and a <= high:
            high = max(high, b)
        else:
            if high is not None:
                yield low, high
            low, high = a, b
    if high is not None:
        yield low, high


def _score(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, (text, item_text, starts) in enumerate(zip(*[batch.column(c) for c in (2, 3, 4)])):
                body, want = words(text.as_py()), words(item_text.as_py())
                best, at = 0, (0, 0)
                for a, b in _spans(starts.as_py(), len(body), len(want)):
                    score, end = align(body[a:b], want)
                    if score > best:
                        best, at = score, (a, a + end)
                share = best / (MATCH * len(want)) if want else 0.0
                if share >= least:
                    first = max(0, at[1] - len(want))
                    out.append((i, share, at[1], b" ".join(body[first : at[1]]).decode("utf-8", "replace")))
            if out:
                whose, share, end, passage = zip(*out)
                ids = [batch.column(c).take(pa.array(whose, pa.int64())) for c in (0, 1)]
                found = [pa.array(share, pa.float64()), pa.array(end, pa.int32()), pa.array(passage, pa.string())]
                yield pa.RecordBatch.from_arrays([*ids, *found], names=["doc", "item", "score", "end_word", "passage"])
        give_back()

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = 0.5,
) -> DataFrame:
    """(doc, item, score, end_word, passage): the items found in a document, score 0 to 1.

    The score is the best local alignment of the item's words in the document over that of an
    exact copy; ``least`` and above are returned, once per document and item, with the words
    that end at ``end_word``. The rare n-grams of an item are seeds (see ``_rare``): an edited
    copy is aligned if one of them is left of it; one without ``N`` equal words in a row is not
    found. Whatever the length of other items, an item's hits are judged by its own reach.
    Null and empty texts, and items of fewer than ``N`` words, match nothing. Rows that repeat
    a document or item are one. A null id is an id like any other. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    items = scratch.store(_items(benchmark, item_col, item_text_col, least).distinct(), "items")
    held = spark.sparkContext.broadcast(_filters(items))
    hits = scratch.store(_hits(docs, id_col, text_col, held, _vocabulary(benchmark, item_text_col)), "hits")
    seeds = _rare(items, hits).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    seeds = scratch.store(seeds, "seeds")
    item_text = (
        benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("item_text"))
        .where("item_text is not null")
        .distinct()
    )
    met = (
        hits.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
        .join(seeds, ["gram", "reach", "salt"])
        # An alignment drifts by some words: nearby diagonals are one start.
        .select(
            "doc", "item", (F.floor((F.col("pos") - F.col("place")) / DRIFT) * DRIFT).cast("int").alias("start"), "near"
        )
    )
    met = met.join(item_text, met["item"].eqNullSafe(item_text["item"])).drop(item_text["item"])
    found = (
        met.select("doc", "item", "start", _may(F.col("near"), F.col("item_text"), least).alias("may"))
        .groupBy("doc", "item")
        .agg(F.collect_set("start").alias("starts"), F.max("may").alias("may"))
        .where("may")
        .drop("may")
    )
    found = scratch.store(found, "found")
    text = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("text is not null")
    wanted = found.select("doc").distinct()
    hit_docs = text.join(wanted, text["doc"].eqNullSafe(wanted["doc"]), "left_semi")
    pairs = found.join(item_text, found["item"].eqNullSafe(item_text["item"])).drop(item_text["item"])
    pairs = pairs.join(hit_docs, pairs["doc"].eqNullSafe(hit_docs["doc"])).drop(hit_docs["doc"])
    kinds = f"doc {docs.schema[id_col].dataType.simpleString()}, item {benchmark.schema[item_col].dataType.simpleString()}"
    scored = pairs.select("doc", "item", "text", "item_text", "starts").mapInArrow(
        _score(least), f"{kinds}, score double, end_word int, passage string"
    )
    return (
        scored.groupBy("doc", "item")
        .agg(F.max(F.struct("score", "end_word", "passage")).alias("b"))
        .select("doc", "item", "b.score", "b.end_word", "b.passage")
    )
