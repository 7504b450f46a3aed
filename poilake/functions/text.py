"""Names, identifiers and name similarity."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def clean_name(name: Column) -> Column:
    """Trim, then capitalise each space-separated word."""
    return F.initcap(F.trim(name))


def title_name(name: Column) -> Column:
    """Trim, then capitalise after every non-letter too, so ``o'neil-bar`` gives ``O'Neil-Bar``."""
    runs = F.split(F.trim(name), r"(?<=\P{L})(?=\p{L})|(?<=\p{L})(?=\P{L})")
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def safe_id(name: Column) -> Column:
    """Lower case with spaces and dashes as underscores."""
    return F.regexp_replace(F.lower(name), "[ -]", "_")


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def _accents() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from Unicode decomposition."""
    marked, plain = ["đ", "Đ"], ["d", "D"]
    for point in range(0x00C0, 0x1F00):
        base = unicodedata.normalize("NFD", chr(point))
        if len(base) > 1 and base[0].isascii() and base[0].isalpha():
            marked.append(chr(point))
            plain.append(base[0])
    return "".join(marked), "".join(plain)


def token_sort_key(name: Column, fold: str = "drop_latin1") -> Column:
    """Lower-cased words of a name, sorted and joined by one space.

    ``drop_latin1`` deletes U+0080-U+00FF before splitting, as the similarity library of
    record does by default; ``unaccent`` maps accented letters to their base letter;
    ``keep`` changes nothing.
    """
    text = F.coalesce(name, F.lit(""))
    if fold == "drop_latin1":
        text = F.regexp_replace(text, "[\u0080-ÿ]", "")
    elif fold == "unaccent":
        text = F.translate(text, *_accents())
    elif fold != "keep":
        raise ValueError(f"unknown fold {fold!r}")
    words = F.split(F.trim(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_]", " "))), r"\s+")
    return F.array_join(F.sort_array(words), " ")


def _letters(texts: list[str], width: int, blank: int) -> np.ndarray:
    """Code points of the texts, a row each, filled up with ``blank``."""
    out = np.full((len(texts), width), blank, dtype=np.uint32)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return out


def _common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of the pairs, all pairs at once.

    One bit stands for each letter of ``a``, in as many 64-bit words as it needs; the loop goes
    over the letters of ``b`` and carries sums from word to word.
    """
    wide, long = max(map(len, a)), max(map(len, b))
    words = -(-wide // 64)
    x, y = _letters(a, 64 * words, 0xFFFFFFFF), _letters(b, long, 0xFFFFFFFE)
    still = np.full((len(a), words), np.uint64(0xFFFFFFFFFFFFFFFF))
    for j in range(long):
        hit = np.packbits(x == y[:, j : j + 1], axis=1, bitorder="little").view("<u8")
        both = still & hit
        rest = still & ~hit
        carry = np.zeros(len(a), dtype=np.uint64)
        for k in range(words):
            part = still[:, k] + both[:, k]
            over = part < both[:, k]
            total = part + carry
            carry = (over | (total < part)).astype(np.uint64)
            still[:, k] = total | rest[:, k]
    return np.bitwise_count(~still).sum(axis=1, dtype=np.int64)


#: Letters of ``a`` times pairs that are compared at once.
_AT_ONCE = 1 << 21


def indel_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Rounded 100 * 2 * LCS / (len(a) + len(b)) of each pair; equal texts give 100, one empty text 0."""
    out = np.array([100 if x == y else 0 for x, y in zip(a, b)], dtype=np.int32)
    open_pairs = [i for i, (x, y) in enumerate(zip(a, b)) if x != y and x and y]
    open_pairs.sort(key=lambda i: (len(a[i]), len(b[i])))  # pairs of like lengths share a block
    at = 0
    while at < len(open_pairs):
        size = max(1, _AT_ONCE // max(64, len(a[open_pairs[min(at + 4095, len(open_pairs) - 1)]])))
        block = open_pairs[at : at + min(size, 4096)]
        left, right = [a[i] for i in block], [b[i] for i in block]
        sizes = np.array([len(p) + len(q) for p, q in zip(left, right)])
        out[block] = np.rint(200 * _common_subsequences(left, right) / sizes).astype(np.int32)
        at += len(block)
    return out


def indel_ratio(a: str, b: str) -> int:
    """``indel_ratios`` of one pair."""
    return int(indel_ratios([a], [b])[0])


def similarity_above(a: str, b: str, minimum: int) -> bool:
    """Whether ``indel_ratio`` of one pair is above ``minimum``, for loops over short keys."""
    if a == b or not a or not b:
        return (100 if a == b else 0) > minimum
    size = len(a) + len(b)
    if round(200 * min(len(a), len(b)) / size) <= minimum:
        return False
    masks: dict[str, int] = {}
    for i, letter in enumerate(a):
        masks[letter] = masks.get(letter, 0) | 1 << i
    full = still = (1 << len(a)) - 1
    for letter in b:
        both = still & masks.get(letter, 0)
        still = (still + both) | (still - both)
    return round(200 * (len(a) - (still & full).bit_count()) / size) > minimum


@F.pandas_udf(IntegerType())
def _key_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    asked = pd.DataFrame({"a": a, "b": b}).dropna()
    pairs = asked.drop_duplicates().reset_index(drop=True)
    pairs["ratio"] = indel_ratios(pairs["a"].tolist(), pairs["b"].tolist())
    found = asked.merge(pairs, on=["a", "b"], how="left").set_index(asked.index)["ratio"]
    return found.reindex(a.index).astype("Int32")


def key_similarity(a: Column, b: Column, needed: Column | None = None) -> Column:
    """Similarity 0-100 of two ``token_sort_key`` values.

    Equal keys are answered in the JVM. Where ``needed`` is false the Python side gets
    nulls and the result is null.
    """
    ask = a != b if needed is None else needed & (a != b)
    asked = _key_similarity(F.when(ask, a), F.when(ask, b))
    equal = a == b if needed is None else needed & (a == b)
    return F.when(equal, F.lit(100)).otherwise(asked)


def token_sort_ratio(a: Column, b: Column, fold: str = "drop_latin1") -> Column:
    """Word-order-independent similarity 0-100 of two names; null if either is null."""
    ratio = key_similarity(token_sort_key(a, fold), token_sort_key(b, fold))
    return F.when(a.isNotNull() & b.isNotNull(), ratio)


def may_exceed(a: Column, b: Column, minimum: int) -> Column:
    """False only where the keys' lengths and letters rule out a similarity above ``minimum``.

    A common subsequence has no letter that the other key lacks, and the ratio must be at least
    half above ``minimum`` to be rounded up from it.
    """
    la, lb = F.length(a), F.length(b)
    # Without the other key's letters, what a key has alone is left.
    shared_a = la - F.length(F.call_function("translate", a, b, F.lit("")))
    shared_b = lb - F.length(F.call_function("translate", b, a, F.lit("")))
    return F.least(shared_a, shared_b) * F.lit(200) >= F.lit(minimum + 0.5) * (la + lb)
