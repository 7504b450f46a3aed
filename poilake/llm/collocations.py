"""Phrase collocations by stripes: each prefix keys a counter of its next words."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poilake.llm.memory import give_back
from poilake.llm.scratch import Scratch

#: Bytes of text whose stripes a task merges before it emits them.
BLOCK = 16 << 20
#: Bits of the filter of frequent phrases that tasks hold: 8 MiB, whatever the corpus. A fuller
#: filter lets more rare phrases through to the shuffle; it never loses a frequent one.
FILTER_BITS = 1 << 26

#: Between pieces and texts; no byte of UTF-8.
_BREAK = 0xFF
_MIX = np.uint64(0x9E3779B97F4A7C15)  # any odd number
_KIND = "lang string, prefix string, nexts array<string>, counts array<long>"


def _table() -> bytes:
    """Byte to byte: A-Z lower-cased, piece separators to one mark, tabs to spaces."""
    out = np.arange(256, dtype=np.uint8)
    out[ord("A") : ord("Z") + 1] += 32
    out[list(b".,;:!?\x0a\x0b\x0c\x0d")] = _BREAK
    out[ord("\t")] = ord(" ")
    return out.tobytes()


_TABLE = _table()


def _word_hash(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    low = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    high = np.fromiter((crc32(w, 0x5BD1E995) for w in words), dtype=np.uint64, count=len(words))
    return (low | (high << np.uint64(32))) + np.uint64(1)


def _phrase_bits(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """The filter's bit of each phrase, from its words' hashes in order."""
    out = np.full(len(words[0]), crc32(lang.encode("utf-8", "surrogatepass")), dtype=np.uint64)
    for h in words:
        out = (out ^ h) * _MIX
        out ^= out >> np.uint64(29)
    return (out % np.uint64(FILTER_BITS)).astype(np.int64)


def _words(data: bytes) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(words, piece of each word, first byte of each word) of lower-cased, marked text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = (raw != _BREAK) & (raw != ord(" "))
    turns = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    start, end = turns[::2], turns[1::2]
    piece = np.searchsorted(np.flatnonzero(raw == _BREAK), start).astype(np.int32)
    # The words' bytes back to back are an Arrow array without a copy per word.
    kept = raw[inside]
    offsets = np.append(0, np.cumsum(end - start)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return pc.dictionary_encode(words), piece, start


def _text(values: pa.Array) -> pa.Array:
    return pc.cast(values, pa.string(), safe=False)


def _block(lang: str, data: bytes, carried: int, k: int, bits: np.ndarray | None) -> tuple[pa.RecordBatch | None, bytes, int]:
    """The stripes of one block, and the last ``k`` words for the next one with their number.

    Only phrases that end behind the first ``carried`` words are counted.
    """
    words, piece, start = _words(data)
    n = len(start)
    tail = data[start[n - min(k, n)] :] if k and n else b""
    at = np.arange(max(0, carried - k), max(0, n - k))
    at = at[at + k >= carried]
    at = at[piece[at] == piece[at + k]]
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if bits is not None and len(at):  # a phrase is frequent only if both its parts are
        hashes = _word_hash(words.dictionary.to_pylist())[codes]
        for first in (0, 1):
            bit = _phrase_bits(lang, [hashes[at + first + i] for i in range(k)])
            at = at[(bits[bit >> 3] << (bit & 7).astype(np.uint8) & 128) != 0]
    if not len(at):
        return None, tail, min(k, n)
    size = len(words.dictionary)
    if k == 0:
        counts = np.bincount(codes[at], minlength=size)
        following = np.flatnonzero(counts)
        counts, prefix, cuts = counts[following], pa.array([""]), np.array([0, len(following)])
    else:
        ids, columns = codes[at], [codes[at]]
        for i in range(1, k):  # numbers for prefixes of more than one word
            pairs, first, ids = np.unique(ids * size + codes[at + i], return_index=True, return_inverse=True)
            columns = [codes[at[first] + j] for j in range(i + 1)]
        entries, counts = np.unique(ids * size + codes[at + k], return_counts=True)
        whose, following = entries // size, entries % size
        begins = np.flatnonzero(np.append(True, whose[1:] != whose[:-1]))
        cuts = np.append(begins, len(whose))
        if k == 1:
            columns, picked = [whose[begins]], slice(None)
        else:
            picked = whose[begins]
        parts = [words.dictionary.take(pa.array(c[picked])) for c in columns]
        prefix = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
    offsets = pa.array(cuts, pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(prefix), pa.string()),
            _text(prefix),
            pa.ListArray.from_arrays(offsets, _text(words.dictionary.take(pa.array(following)))),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
        ],
        names=["lang", "prefix", "nexts", "counts"],
    )
    return batch, tail, min(k, n)


def stripes(docs: DataFrame, k: int, held=None, block: int = BLOCK) -> DataFrame:
    """(lang, prefix, nexts, counts): how often which words follow each prefix of ``k`` words.

    ``docs`` has (lang, text). A task merges the stripes of ``block`` bytes of text before it
    emits them, so a prefix comes once per such block. A long text is read in blocks too: the
    last ``k`` words of one are carried into the next. ``held`` is a broadcast filter of the
    frequent phrases of ``k`` words; others are no prefix and end no longer phrase.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, dtype=np.uint8) if held else None
        waiting: dict[str, list[bytes]] = {}  # a bounded number of bytes per language
        sizes: dict[str, int] = {}
        carry: dict[str, int] = {}

        def flush(lang: str, end: bool) -> pa.RecordBatch | None:
            data = b"\xff".join(waiting[lang])
            cut = len(data)
            if not end:  # whole words only
                cut = max(data.rfind(b" "), data.rfind(b"\xff")) + 1
                if not cut:
                    waiting[lang] = [data]
                    return None
            batch, tail, words = _block(lang, data[:cut], carry.get(lang, 0), k, bits)
            waiting[lang] = [tail + data[cut:]]
            sizes[lang], carry[lang] = len(waiting[lang][0]), words
            return batch

        for batch in batches:
            texts = pc.coalesce(batch.column(1), pa.scalar("", batch.column(1).type))
            for lang, text in zip(batch.column(0).to_pylist(), texts):
                data = text.as_buffer().to_pybytes().translate(_TABLE)
                for i in range(0, len(data) or 1, block):
                    part = data[i : i + block]
                    if i:
                        waiting[lang][-1] += part
                    else:
                        waiting.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= block and (out := flush(lang, False)):
                        yield out
            if sum(sizes.values()) >= 4 * block:  # many languages wait
                for lang in list(waiting):
                    if (out := flush(lang, True)) is not None:
                        yield out
                    # Whole texts have ended here: nothing is carried on.
                    del waiting[lang], sizes[lang], carry[lang]
        for lang in list(waiting):
            if (out := flush(lang, True)) is not None:
                yield out
            del waiting[lang]
        give_back()

    return docs.select("lang", "text").mapInArrow(run, _KIND)


def merged(rows: DataFrame) -> DataFrame:
    """(lang, prefix, next, count): the elementwise sum of stripes.

    An element is a group of its own, so the stripe of a prefix that a third of all rows hold
    is summed by many tasks.
    """
    entry = F.explode(F.arrays_zip("nexts", "counts")).alias("e")
    return (
        rows.select("lang", "prefix", entry)
        .groupBy("lang", "prefix", F.col("e.nexts").alias("next"))
        .agg(F.sum("e.counts").alias("count"))
    )


def _filter(spark, phrases: DataFrame) -> bytes:
    """A bit for each (lang, phrase); tasks merge what they have, so its size is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            rows: dict[str, list[list[bytes]]] = {}
            for lang, phrase in zip(batch.column(0).to_pylist(), pc.cast(batch.column(1), pa.binary()).to_pylist()):
                rows.setdefault(lang, []).append(phrase.split(b" "))
            for lang, found in rows.items():
                bits[_phrase_bits(lang, [_word_hash(list(words)) for words in zip(*found)])] = True
        packed = np.packbits(bits).view("<i8")
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(packed[at], pa.int64())], names=["at", "word"])

    found = phrases.mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    whole = np.zeros(FILTER_BITS // 64, dtype="<i8")  # at most as many rows
    whole[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return whole.tobytes()


def _phrase() -> Column:
    return F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat("prefix", F.lit(" "), "next"))


def _score(a: Column, left: Column, right: Column, scale: int) -> Column:
    """floor(scale * a * a / (left * right)), exact for counts below 10^16."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    # Precision 38 holds 10^6 * (10^16)^2; a larger result is an error, never rounded.
    return F.call_function("div", a * a * F.lit(scale).cast("decimal(7,0)"), left * right)


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = 10,
    longest: int = 3,
    top: int = 2000,
    subsumed: int = 50,
    scale: int = 1_000_000,
    block: int = BLOCK,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``longest`` words.

    A-Z count as a-z. Texts are split into pieces at ``.,;:!?`` and line ends, pieces into words
    at spaces and tabs. Candidates occur ``a >= least`` times within pieces, overlaps included.
    A cut into two parts that occur ``l`` and ``r`` times scores floor(scale * a * a / (l * r));
    a phrase has its lowest-scoring cut, the shortest first part of equals. Phrases inside a
    longer candidate with at least ``subsumed`` percent of their occurrences are left out.
    ``n`` are all words of the language. ``top`` rows per language are returned, by score, a
    (both descending) and phrase; the result is stored when this is called.

    Stripes are counted for prefixes of 0, 1, ... words: a prefix's extensions are its entries,
    the counts of its parts are entries of shorter prefixes, ``n`` is the total of the empty one,
    and the maxima over extensions to the right and to the left come from the longer prefixes.
    A prefix of k words is only counted if it and the k words after its first occur ``least``
    times, which every part of a candidate does; nothing else is left out.

    A null language is ``und``; null and empty texts have no words; repeated rows count as
    often as they come; no rows give no rows. Other columns are not read. Counts of 10^16 and
    more raise an error instead of being rounded.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    words, words_path = scratch.store_at(merged(stripes(rows, 0, block=block)), "words")
    totals = words.groupBy("lang").agg(F.sum("count").alias("n"))
    paths, levels = [words_path], [words.where(F.col("count") >= least).select("lang", _phrase().alias("phrase"), "count")]
    tables = []
    for k in range(1, longest):
        held = spark.sparkContext.broadcast(_filter(spark, levels[-1].select("lang", "phrase")))
        found = merged(stripes(rows, k, held, block)).where(F.col("count") >= least)
        found, path = scratch.store_at(found.withColumn("phrase", _phrase()), f"prefixes{k}")
        held.destroy()
        paths.append(path)
        tables.append(found)
        levels.append(found.select("lang", "phrase", "count"))
    scored = []
    for k, found in enumerate(tables, 1):
        best = found.select("lang", "phrase", F.col("count").alias("a"))
        cuts = []
        for i in range(1, k + 1):
            first = F.substring_index("phrase", " ", i)
            rest = F.substring_index("phrase", " ", i - k - 1)
            left = levels[i - 1].select("lang", F.col("phrase").alias("_first"), F.col("count").alias(f"_l{i}"))
            right = levels[k - i].select("lang", F.col("phrase").alias("_rest"), F.col("count").alias(f"_r{i}"))
            best = best.withColumns({"_first": first, "_rest": rest})
            best = best.join(left, ["lang", "_first"]).join(right, ["lang", "_rest"]).drop("_first", "_rest")
            score = _score(F.col("a"), F.col(f"_l{i}"), F.col(f"_r{i}"), scale)
            cuts.append(F.struct(score.alias("score"), F.lit(i).alias("cut"), F.col(f"_l{i}").alias("l"), F.col(f"_r{i}").alias("r")))
        best = best.withColumn("_cut", F.array_min(F.array(*cuts)))
        if k < len(tables):  # what extends the phrase by a word to the right or the left
            longer = tables[k]
            inner = longer.select("lang", F.col("prefix").alias("phrase"), "count").unionByName(
                longer.select("lang", F.substring_index("phrase", " ", -k - 1).alias("phrase"), "count")
            )
            maxima = inner.groupBy("lang", "phrase").agg(F.max("count").alias("_longer"))
            best = best.join(maxima, ["lang", "phrase"], "left")
            best = best.where(F.col("_longer").isNull() | (100 * F.col("_longer") < subsumed * F.col("a")))
        scored.append(best.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score"))
    every = scored[0]
    for more in scored[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    # At most ``top`` rows per language.
    out = ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    out = scratch.store(out, "ranked")
    scratch.drop(*paths)
    return out
