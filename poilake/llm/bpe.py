"""Byte-level BPE: a segment tree over the ranks of adjacent pairs finds each merge."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.llm.memory import give_back

#: Bytes of the words, and of their ids, that a task remembers in each of two generations.
REMEMBER = 24 << 20
#: Bytes of text that a task encodes at once, if no single text has more.
EMIT = 2 << 20

#: How the public vocabulary's tokenizer cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words whose ids are looked up together.
_WORDS = 200_000
#: Bytes of a word that is merged with others, at most, and how many are merged at once.
_WIDEST, _ROWS = 64, 8_192
#: Position bits below a pair's rank in a tree's leaf: the least leaf is the leftmost of the lowest rank.
_PLACE = 40
_NONE = 1 << 62


def _byte_chars() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself where it is printable."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    out = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [out[b] for b in range(256)]


class Vocabulary:
    """Merges, tokens and special strings of a byte-level BPE file of the tokenizers library."""

    def __init__(self, content: str):
        file = json.loads(content)
        model, split = file["model"], file["pre_tokenizer"] or {}
        plain = {k: v for k, v in model.items() if k not in ("type", "vocab", "merges") and v}
        if model["type"] != "BPE" or plain or file["normalizer"]:
            raise ValueError(f"not a plain BPE vocabulary: {model['type']}, {plain}, {file['normalizer']}")
        if split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
            raise ValueError(f"not cut into words by the byte-level rule: {split}")
        added = file["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"special strings that match more than themselves: {added}")
        vocab: dict[str, int] = model["vocab"]
        chars = _byte_chars()
        byte_of = {c: b for b, c in enumerate(chars)}
        self.first = [vocab.get(c, -1) for c in chars]
        self.special = {t["content"]: t["id"] for t in added}
        #: (left id, right id) as one number -> rank and merged id as one number
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocab[left] << 32 | vocab[right]] = (rank << _PLACE, vocab[left + right])
        self._keys = np.array(sorted(self.merges), dtype=np.int64)
        self._leaf = np.array([self.merges[k][0] for k in self._keys.tolist()], dtype=np.int64)
        self._made = np.array([self.merges[k][1] for k in self._keys.tolist()], dtype=np.int64)
        self.tokens: list[bytes | None] = [None] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the lowest-ranked adjacent pair is merged, leftmost first, while there is one.

        The pair that begins at each position is a leaf of a segment tree of minima. Its root
        names the next merge, which changes three leaves: each costs the height of the tree.
        """
        first = self.first
        ids = [first[b] for b in word]
        if -1 in ids:  # a byte without a token is dropped, as the library does without an unknown token
            ids = [i for i in ids if i >= 0]
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges
        tree = [_NONE] * (2 * n)
        made = [0] * n
        for i in range(n - 1):
            if hit := merges.get(ids[i] << 32 | ids[i + 1]):
                tree[n + i], made[i] = hit[0] | i, hit[1]
        for i in range(n - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left < right else right
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != _NONE:
            i = root & ((1 << _PLACE) - 1)
            gone = after[i]
            ids[i], ids[gone] = made[i], -1
            right = after[i] = after[gone]
            if right < n:
                before[right] = i
            left = before[i]
            changed = [(gone, _NONE)]
            for at, other in ((i, right), (left, i)):
                if at >= 0:
                    hit = merges.get(ids[at] << 32 | ids[other]) if other < n else None
                    if hit:
                        made[at] = hit[1]
                    changed.append((at, hit[0] | at if hit else _NONE))
            for at, value in changed:
                at += n
                tree[at] = value
                while at > 1:
                    other = tree[at ^ 1]
                    at >>= 1
                    low = value if value < other else other
                    if tree[at] == low:
                        break  # nothing changes further up
                    tree[at] = value = low
        return [i for i in ids if i >= 0]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf without its place, merged id) of each pair; ``_NONE`` where no merge is."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        hit = self._keys[at] == wanted
        return np.where(hit, self._leaf[at], _NONE), self._made[at]

    def _forest(self, words: list[bytes], width: int) -> list[bytes]:
        """``merge`` for words of up to ``width`` bytes at once, a power of two: one tree per row."""
        count, none = len(words), len(self.tokens)  # an id that no pair has
        length = np.fromiter(map(len, words), dtype=np.int64, count=count)
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8).reshape(count, width)
        place = np.arange(width + 1)
        ids = np.full((count, width + 1), none, dtype=np.int64)
        ids[:, :width] = np.array(self.first, dtype=np.int64)[raw]
        ids[place >= length[:, None]] = none
        tree = np.full((count, 2 * width), _NONE, dtype=np.int64)
        tree[:, width:], made = self._pairs(ids[:, :-1], ids[:, 1:])
        tree[:, width:] |= np.where(tree[:, width:] < _NONE, place[:-1], 0)
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        after = np.where(place + 1 < length[:, None], place + 1, width)  # ``width``: no such place
        before = np.tile(np.append(width, place[:-1]), (count, 1))
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            i = tree[rows, 1] & ((1 << _PLACE) - 1)
            gone = after[rows, i]
            right = after[rows, gone]
            ids[rows, i], ids[rows, gone] = made[rows, i], none
            after[rows, i] = right
            before[rows, right] = i  # also of no place, which nobody asks
            left = before[rows, i]
            tree[rows, width + gone] = _NONE
            leaf, made[rows, i] = self._pairs(ids[rows, i], ids[rows, right])
            tree[rows, width + i] = np.where(leaf < _NONE, leaf | i, _NONE)
            some = np.flatnonzero(left < width)
            at, l = rows[some], left[some]
            leaf, made[at, l] = self._pairs(ids[at, l], ids[at, i[some]])
            tree[at, width + l] = np.where(leaf < _NONE, leaf | l, _NONE)
            nodes = [(rows, width + gone), (rows, width + i), (at, width + l)]
            for _ in range(width.bit_length() - 1):
                nodes = [(r, up >> 1) for r, up in nodes]
                for r, up in nodes:
                    tree[r, up] = np.minimum(tree[r, 2 * up], tree[r, 2 * up + 1])
            rows = rows[tree[rows, 1] < _NONE]
        kept = ids != none
        pool = ids[kept].astype("<i4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [pool[a:b] for a, b in zip([0, *ends], ends)]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word: short ones together, long ones one by one."""
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        whole = min(self.first) >= 0 and len(self.merges) > 0
        for at, w in enumerate(words):
            width = max(8, 1 << (len(w) - 1).bit_length()) if w and whole else 0
            if 0 < width <= _WIDEST:
                by_width.setdefault(width, []).append(at)
            else:
                out[at] = np.array(self.merge(w), dtype="<i4").tobytes()
        for width, places in by_width.items():
            for i in range(0, len(places), _ROWS):
                some = places[i : i + _ROWS]
                for at, ids in zip(some, self._forest([words[j] for j in some], width)):
                    out[at] = ids
        return out


class Encoder:
    """Ids of texts; the ids of words are remembered in two generations of bounded size."""

    def __init__(self, vocabulary: Vocabulary, remember: int = REMEMBER):
        import regex

        self.vocabulary = vocabulary
        self.words = regex.compile(WORDS)
        strings = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None
        self.remember, self.size = remember, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words that are not in the newer generation."""
        out = {w: self.old[w] for w in words if w in self.old}
        fresh = [w for w in words if w not in out]
        out.update(zip(fresh, self.vocabulary.merge_all([w.encode("utf-8", "surrogatepass") for w in fresh])))
        for w, ids in out.items():
            cost = 2 * len(w) + len(ids) + 200  # about what the two objects and their place take
            if self.size + cost > self.remember:
                self.old, self.new, self.size = self.new, {}, 0
            if 2 * cost < self.remember:
                self.new[w] = ids
                self.size += cost
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        found = list(map(self.new.get, words))
        if None not in found:
            return found
        learnt = self._learn({w for w, ids in zip(words, found) if ids is None})
        return [learnt[w] if ids is None else ids for w, ids in zip(words, found)]

    def _parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """(special, part) of a text: its special strings and what lies between them."""
        if self.special and self.special.search(text):
            for i, part in enumerate(self.special.split(text)):
                yield i % 2 == 1, part
        else:
            yield False, text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of texts; special strings in them are their own ids."""
        out: list[list[bytes]] = [[] for _ in texts]
        words: list[str] = []
        turns: list[tuple[int, int]] = []  # whose words the last ones are, and how many

        def flush() -> None:
            ids, at = self._ids(words), 0
            for whose, n in turns:
                out[whose].append(b"".join(ids[at : at + n]))
                at += n
            words.clear()
            turns.clear()

        for whose, text in enumerate(texts):
            for special, part in self._parts(text):
                if special:
                    flush()
                    out[whose].append(np.array([self.vocabulary.special[part]], dtype="<i4").tobytes())
                    continue
                found = (m.group() for m in self.words.finditer(part)) if len(part) > EMIT else None
                while got := list(islice(found, _WORDS)) if found else self.words.findall(part):
                    words += got
                    turns.append((whose, len(got)))
                    if len(words) >= _WORDS:
                        flush()
                    if not found:
                        break
        flush()
        return [b"".join(ids) for ids in out]


def _content(docs: DataFrame, path: str):
    """The tokenizer's file, read here once and sent to the tasks; its size is fixed."""
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every text, array<int>, as the tokenizer at the path gives them.

    The file holds a plain byte-level BPE vocabulary; another kind raises ``ValueError`` in the
    tasks. Special strings in a text are their ids, none are added. Null and empty texts have
    no ids; repeated rows stay; ids of documents are passed on untouched, null too; no rows
    give no rows. Other columns are not read. Long texts are encoded whole.
    """
    held, kind = _content(docs, tokenizer), docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(held.value))
        for batch in batches:
            texts = pc.coalesce(batch.column(1), pa.scalar("", batch.column(1).type))
            share = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // EMIT
            cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(texts)]
            for low, high in zip(cuts, cuts[1:]):
                got = encoder.encode(texts.slice(low, high - low).to_pylist())
                ends = np.cumsum([0, *map(len, got)]) // 4
                ids = pa.array(np.frombuffer(b"".join(got), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), lists], names=["id", "ids"])
        del encoder  # the worker is kept for other tasks
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, ids array<int>")


def decoder(docs: DataFrame, tokenizer: str):
    """A function from a column of ids to the text they stand for, special strings included.

    Bytes that are no UTF-8 become U+FFFD, as the library does; ids outside the vocabulary are
    left out; null is null.
    """
    held = _content(docs, tokenizer)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = [t if t is not None else b"" for t in Vocabulary(held.value).tokens]
        size = np.array([*map(len, tokens), 0], dtype=np.int64)
        begin = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        for lists in batches:
            out: list[pa.Array] = []
            low = 0
            offsets = np.asarray(lists.offsets)
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            values = lists.values.to_numpy(zero_copy_only=False)
            while low < len(lists):  # some ids at a time: each is eight numbers here
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + EMIT // 16, side="right")) - 1)
                ids = values[offsets[low] : offsets[high]].astype(np.int64)
                ids[(ids < 0) | (ids >= len(tokens))] = len(tokens)
                n = size[ids]
                ends = np.append(0, np.cumsum(n))
                raw = pool[np.repeat(begin[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
                cuts = ends[offsets[low : high + 1] - offsets[low]].tolist()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
                out.append(pa.array([t if v else None for t, v in zip(texts, valid[low:high])], pa.string()))
                low = high
            yield pa.concat_arrays(out) if out else pa.array([], pa.string())
        give_back()

    return run


def decode(docs: DataFrame, ids: Column, tokenizer: str) -> Column:
    """The texts of a column of ids in ``docs``, see ``decoder``."""
    return decoder(docs, tokenizer)(ids)
