"""Packing by non-negative least squares over the histogram of piece lengths."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poilake.llm.memory import give_back
from poilake.llm.scratch import Scratch

WINDOW = 2048
#: Bins of piece lengths; a piece counts as the upper end of its bin.
BINS = 256
#: Pieces of one sequence that a planned combination has at most.
DEPTH = 3
#: Bytes of the words, and of their ids, that a task remembers in each of two generations.
_REMEMBER = 24 << 20
#: New words that are encoded together.
_TOGETHER = 512
#: Bytes of texts that are split into words at once; a task takes about 50 times as much for them.
_BYTES = 1 << 20
#: Pieces of one bin that are numbered in one task, about.
_GROUP = 1_000
#: A word of its own between words that are encoded together.
_MARK = "\x01"


# The shape of tokenizers whose words can be encoded one by one.
_NORMAL = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Letters that are a character each in all normal forms; words of these alone are one piece.
_LETTERS = "a-z\u00e0-\u00f6\u00f8-\u00ff\u00c0-\u00d6\u00d8-\u00de"
_SIMPLE = re.compile(f"[{_LETTERS}]+").fullmatch
_SIGNS = r"!-/:-@\[-`{-~"
#: Where a space changes no ids: around digits, and between letters and signs, but for
#: contractions, which begin with an apostrophe.
_SPACED = (
    (r"([0-9])", r" \1 "),
    (f"([{_LETTERS}])([{_SIGNS}])", r"\1 \2"),
    (f"([{_SIGNS.replace('!-/', '!-&(-/')}])([{_LETTERS}])", r"\1 \2"),
)


def _by_words(file: dict) -> bool:
    """Whether a tokenizer lower-cases, drops white space and cuts texts as ``_CUT`` says."""
    parts = (file["pre_tokenizer"] or {}).get("pretokenizers", [])
    model = file["model"]
    odd = [k for k, v in model.items() if v and k not in ("type", "vocab", "merges", "end_of_word_suffix")]
    return bool(
        model["type"] == "BPE"
        and not odd
        and model["end_of_word_suffix"]
        and (file["normalizer"] or {}).get("normalizers") == _NORMAL
        and [p["type"] for p in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": _CUT}
        and (parts[0]["behavior"], parts[0]["invert"]) == ("Removed", True)
        and not (parts[1]["add_prefix_space"] or parts[1].get("use_regex", True))
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"])
    )


def _byte_chars() -> dict[int, str]:
    """Latin-1 character of a byte to the one that stands for it in byte-level vocabularies."""
    hidden = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or 0xAE <= b)]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Encoder:
    """Token ids of texts, unsigned 32-bit, by the tokenizer at a path.

    Where the file says that it lower-cases and drops white space, parts of a text between
    white space don't influence each other: every word is encoded once and remembered, in two
    generations of bounded size. Texts that hold the tokenizer's special strings, and all texts
    of other tokenizers, go through it whole.
    """

    def __init__(self, path: str, remember: int = _REMEMBER):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        with open(path, encoding="utf-8") as file:
            content = file.read()
        read = json.loads(content)
        self.special = [t["content"] for t in read["added_tokens"]]
        self.words = _by_words(read)
        self.remember, self.size = remember, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        if self.words:
            self.chars = _byte_chars()
            vocab, suffix = read["model"]["vocab"], read["model"]["end_of_word_suffix"]
            self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)  # whether a token ends a word
            self.last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            del vocab
        del read  # before the tokenizer takes as much
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.words:
            self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids[0]
            # For words that are lower-cased and cut already; both share the model.
            self.plain = Tokenizer(self.tokenizer.model)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _simple(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of ``_LETTERS``."""
        mapped = [w if w.isascii() else w.lower().encode().decode("latin-1").translate(self.chars) for w in words]
        groups = [mapped[i : i + _TOGETHER] for i in range(0, len(mapped), _TOGETHER)]
        for group, got in zip(groups, self.plain.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)):
            ids = np.array(got.ids, dtype="<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
            if len(ends) != len(group):
                raise ValueError("a word of letters has no last token")
            yield from (raw[a:b] for a, b in zip([0, *ends], ends))

    def _other(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words without ``_MARK``."""
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        texts = [f" {_MARK} ".join(g) for g in groups]
        for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(got.ids, dtype="<u4")
            cuts, raw = (4 * np.flatnonzero(ids == self.mark)).tolist(), ids.tobytes()
            yield from (raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)]))

    def _learn(self, words: list[str], again: set[str]) -> dict[str, bytes]:
        """Ids of words that are not in the newer generation, which get those in ``again``."""
        out = {w: self.old[w] for w in words if w in self.old}
        simple, other = [], []
        for w in words:
            if w not in out:
                if _SIMPLE(w):
                    simple.append(w)
                elif _MARK in w:
                    out[w] = self.whole(w).tobytes()
                else:
                    other.append(w)
        out.update(zip(simple, self._simple(simple)))
        out.update(zip(other, self._other(other)))
        for w in again:
            ids = out[w]
            cost = 2 * len(w) + len(ids) + 200  # about what the two objects and their place take
            if self.size + cost > self.remember:
                self.old, self.new, self.size = self.new, {}, 0
            if 2 * cost < self.remember:
                self.new[w] = ids
                self.size += cost
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts one after the other, and where each text's end."""
        if not self.words:
            ids = [self.whole(t) for t in texts.to_pylist()]
            return np.concatenate([*ids, np.empty(0, "<u4")]), np.cumsum([0, *map(len, ids)])
        spaced = pc.ascii_lower(texts)
        for pattern, by in _SPACED:
            spaced = pc.replace_substring_regex(spaced, pattern, by)
        lists = pc.ascii_split_whitespace(spaced)
        flat = pc.dictionary_encode(lists.flatten())
        names = flat.dictionary.to_pylist()
        raw = list(map(self.new.get, names))
        if None in raw:
            # A word that these texts have once is not likely to come again soon.
            often = (np.bincount(flat.indices.to_numpy(zero_copy_only=False)) > 1).tolist()
            new = [w for w, ids in zip(names, raw) if ids is None]
            learnt = self._learn(new, {w for w, ids, more in zip(names, raw, often) if more and ids is None})
            raw = [learnt[w] if ids is None else ids for w, ids in zip(names, raw)]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
        pool = pa.array(np.frombuffer(b"".join(raw), dtype="<u4"))
        begin = pa.array(np.append(0, np.cumsum(size)))
        got = pa.LargeListArray.from_arrays(begin, pool).take(flat.indices)  # the ids of every word
        ids = got.values.to_numpy()
        bounds = np.asarray(lists.offsets, dtype=np.int64)
        ends = got.offsets.to_numpy()[bounds - bounds[0]]
        special = np.zeros(len(texts), dtype=bool)
        for string in self.special:
            special |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        if special.any():
            parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
            for i in np.flatnonzero(special):
                parts[i] = self.whole(texts[i].as_py())
            ids, ends = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, ends


def _pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """(doc, start, length, ids, ids_crc32, doc_tokens): each text's ids, cut every ``window``."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(tokenizer)
        tail = np.array([end_id], dtype="<u4")
        for batch in batches:
            texts = pc.coalesce(batch.column(1), pa.scalar("", batch.column(1).type))
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            share = np.cumsum(sizes, dtype=np.int64) // _BYTES
            cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(texts)]
            for low, high in zip(cuts, cuts[1:]):
                rows = defaultdict(list)
                flat, ends = encoder.encode(texts.slice(low, high - low))
                for i, (first, last) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    ids = np.concatenate([flat[first:last], tail])
                    for start in range(0, len(ids), window):
                        raw = ids[start : start + window].tobytes()
                        rows["at"].append(low + i)
                        rows["start"].append(start)
                        rows["length"].append(len(raw) // 4)
                        rows["ids"].append(raw)
                        rows["ids_crc32"].append(zlib.crc32(raw))
                        rows["doc_tokens"].append(len(ids))
                whose = batch.column(0).take(pa.array(rows.pop("at"), pa.int64()))
                kinds = {"start": pa.int64(), "length": pa.int32(), "ids": pa.binary()}
                columns = [pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()]
                yield pa.RecordBatch.from_arrays([whose, *columns], names=["doc", *rows])
        del encoder  # the worker is kept for other tasks
        give_back()

    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc {kind.simpleString()}, start long, length int, ids binary, ids_crc32 long, doc_tokens long"
    )


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """The x >= 0 that minimises ||a x - b||, by the active-set method."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], dtype=bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(6 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        if not len(gradient) or gradient.max() <= tolerance * scale:
            break
        free[int(gradient.argmax())] = True
        while True:
            at = np.flatnonzero(free)
            solved = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if solved.min(initial=1) > 0:
                x[:] = 0
                x[at] = solved
                break
            low = solved <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - solved[low], 1e-300))
            x[at] += step * (solved - x[at])
            x[at[x[at] <= tolerance * scale * 1e-3]] = 0
            stay = at[x[at] > 0]
            if len(stay) == len(at):  # numerically stuck: give up the lowest
                stay = np.delete(at, int(solved.argmin()))
                x[at[int(solved.argmin())]] = 0
            free[:] = False
            free[stay] = True
            if not len(stay):
                break
    return x


def combinations_of(bins: int, depth: int) -> list[tuple[int, ...]]:
    """Every non-decreasing choice of up to ``depth`` bins that fills the window exactly."""
    out = [(bins,)]
    if depth >= 2:
        out += [(a, bins - a) for a in range(1, bins // 2 + 1)]
    if depth >= 3:
        out += [(a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    return out


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(bins, repeats): how often to use which combination, so that every piece has a place.

    ``histogram[i]`` pieces are of bin i + 1. Repeats solve the least squares problem and are
    rounded down to what is there; the rest is packed greedily, longest first, each time with
    the longest pieces that still fit, in runs of equal sequences.
    """
    bins = len(histogram)
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left.sum():
        chosen = [c for c in combinations_of(bins, depth) if all(left[i - 1] for i in c)]
        if chosen:
            a = np.zeros((bins, len(chosen)))
            for j, c in enumerate(chosen):
                for i in c:
                    a[i - 1, j] += 1
            # Long pieces left over cost more than short ones, which fill gaps.
            weight = np.sqrt(np.arange(1, bins + 1))[:, None]
            repeats = nnls(a * weight, left * weight[:, 0])
            for j in np.argsort(-repeats):
                need = np.bincount([i - 1 for i in chosen[j]], minlength=bins)
                n = min(int(round(repeats[j])), int((left[need > 0] // need[need > 0]).min()))
                if n > 0:
                    left -= n * need
                    out.append((chosen[j], n))
    while left.any():
        first = int(np.flatnonzero(left)[-1]) + 1
        pattern, need, room = [first], np.bincount([first - 1], minlength=bins), bins - first
        while room:
            fits = np.flatnonzero(left[:room] > need[:room])
            if not len(fits):
                break
            pattern.append(int(fits[-1]) + 1)
            need[fits[-1]] += 1
            room -= pattern[-1]
        n = int((left[need > 0] // need[need > 0]).min())
        left -= n * need
        out.append((tuple(pattern), n))
    return out


def _slots(planned: list[tuple[tuple[int, ...], int]], bins: int) -> list[tuple[int, int, int, int, int]]:
    """(bin, first, last, sequence, place): which sequences the pieces numbered first..last get."""
    out, used, sequence = [], np.zeros(bins + 1, dtype=np.int64), 0
    for pattern, n in planned:
        for place, b in enumerate(pattern):
            out.append((b, int(used[b]), int(used[b]) + n - 1, sequence, place))
            used[b] += n
        sequence += n
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = 1,
    bins: int = BINS,
) -> DataFrame:
    """(doc, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    A document is its text's ids and ``end_id``. It is cut every ``window`` ids; whole windows
    are sequences of their own, and the lengths of the last pieces, counted in ``bins`` bins,
    are combined by ``plan``. Sequences have no gaps and at most ``window`` ids.

    ``ids`` are little-endian unsigned 32-bit numbers. A null or empty text is ``end_id`` alone;
    rows are documents of their own, also when they repeat. No rows give no rows. The plan has
    a bounded number of rows; pieces are numbered in many groups per length, so that a length
    that a third of all pieces share is no single task.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.store(
        _pieces(docs, id_col, text_col, tokenizer, window, end_id), "pieces"
    )
    width = -(-window // bins)
    rows = pieces.withColumn("bin", F.ceil(F.col("length") / width).cast("int"))
    counts = rows.groupBy("bin").count().collect()  # a row per bin
    histogram = np.zeros(bins, dtype=np.int64)
    for row in counts:
        histogram[row["bin"] - 1] = row["count"]
    planned = plan(histogram)
    # Number the pieces of a bin: groups by a hash, a window in each, and the groups' starts.
    groups = F.get(F.array(*[F.lit(int(n // _GROUP) + 1) for n in histogram]), F.col("bin") - 1)
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("doc", "start", "ids_crc32"), groups).cast("int"))
    by_bin = Window.partitionBy("bin").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("bin", "grp")
        .agg(F.count("*").alias("n"))
        .withColumn("begin", F.coalesce(F.sum("n").over(by_bin), F.lit(0)))
        .drop("n")
    )
    numbered = (
        rows.withColumn("n", F.row_number().over(Window.partitionBy("bin", "grp").orderBy("doc", "start", "ids_crc32")))
        .join(starts, ["bin", "grp"])
        .withColumn("number", F.col("begin") + F.col("n") - 1)
    )
    slots = defaultdict(list)
    for b, first, last, sequence, place in _slots(planned, bins):
        slots[b].append((first, last, sequence, place, b))
    spark = docs.sparkSession
    table = spark.createDataFrame(
        sorted(slots.items()), "bin int, slots array<struct<first:long,last:long,sequence:long,place:int,bin:int>>"
    )
    # The plan's rows are bounded by bins and combinations, not by documents.
    placed = numbered.join(F.broadcast(table), "bin").withColumn(
        "slot", F.filter("slots", lambda s: (F.col("number") >= s["first"]) & (F.col("number") <= s["last"]))[0]
    )
    placed = placed.withColumn("sequence_id", F.col("slot.sequence") + F.col("number") - F.col("slot.first"))
    ahead = Window.partitionBy("sequence_id").orderBy("slot.place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).select(
        "doc", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
