import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from poilake.llm import bpe, queries

PATH = queries.byte_tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


def test_every_character_beside_others(library, vocabulary):
    encoder = bpe.Encoder(vocabulary)
    points = [*range(0x3000), *range(0x3000, 0xD800, 23), *range(0xE000, 0x110000, 97)]
    for at in range(0, len(points), 400):
        text = "\x01".join(f"a{x}a1{x}1  {x}  !{x}" for x in map(chr, points[at : at + 400]))
        assert ids(encoder.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_trees_equal_the_library_on_long_words_and_small_memory(library, vocabulary):
    rng = random.Random(2)
    words = ["a" * 5_000, "ab" * 3_000, "=" * 4_001, "".join(rng.choices("abcdefgh", k=8_000)), "é" * 70, "x" * 64, "y" * 65]
    parts = ["a", "the", " ", "  ", "\n", "é", "<|endoftext|>", "1", "23", "'s", "!", "\x00", "𝒳", "ing", "\x1c", "\x85", "aaaa" * 5]
    texts = ["", *words, *("".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(300))]
    for remember in (0, 2_000, bpe.REMEMBER):
        got = bpe.Encoder(vocabulary, remember).encode(texts)
        assert [ids(raw) for raw in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    for w in words + ["", "a", "qz"]:  # one by one and together
        assert np.array(vocabulary.merge(w.encode()), "<i4").tobytes() == vocabulary.merge_all([w.encode()])[0]


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, queries.QUERIES["op12_bpe"](spark, sf).collect()))
    want = []
    for doc, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        found = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(found, skip_special_tokens=False)
        want.append((doc, len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want)


def test_rows_of_every_kind(spark, library):
    rows = [(None, None), ((1 << 60) + 1, ""), ((1 << 60) + 3, "a <|endoftext|> b<|endoftext|>\x00"), (7, "x y" * 400_000), (7, "x y" * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("ids", F.lit(1))
    encoded = bpe.encode(docs, PATH)
    got = encoded.withColumn("text", bpe.decode(encoded, F.col("ids"), PATH)).collect()
    assert sorted(((r["id"], r["text"]) for r in got), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert bpe.encode(docs.where("false"), PATH).collect() == []
    odd = spark.createDataFrame([([50256, -1, 10**8, 128],), (None,), ([],)], "ids array<int>")
    texts = [r[0] for r in odd.select(bpe.decode(odd, F.col("ids"), PATH)).collect()]
    assert texts == [library.decode([50256, 128], skip_special_tokens=False), None, ""]


def test_other_vocabularies_are_refused():
    with open(queries.tokenizer_path(), encoding="utf-8") as file, pytest.raises(ValueError):
        bpe.Vocabulary(file.read())
