import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from poilake.llm import packing, queries


def test_nnls_is_optimal():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.integers(0, 3, (8, 12)).astype(float), rng.integers(0, 50, 8).astype(float)
        x = packing.nnls(a, b)
        g = a.T @ (a @ x - b)
        assert (x >= 0).all() and (g > -1e-5).all() and np.abs(g[x > 1e-9]).max(initial=0) < 1e-4


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(5)
    for histogram in (rng.integers(0, 40, 32), np.zeros(32, int), np.eye(32, dtype=int)[3] * 7, rng.integers(0, 2, 32)):
        used = np.zeros(32, int)
        for pattern, n in packing.plan(histogram):
            assert n > 0 and sum(pattern) <= 32
            for b in pattern:
                used[b - 1] += n
        assert (used == histogram).all()


def test_round_trip(spark):
    rng = random.Random(6)
    letters = ["The", "the", "of.", "naïve", "Éé", "ЖУК", "ΣΑΣ", "x1y22", "don't", "...", "<|endoftext|>", "\x01", "漢字", "é", "İ", "end.,"]
    texts = [None, "", "  ", "a", "a", "word " * 30_000]
    texts += [rng.choice([" ", "\n", " "]).join(rng.choices(letters, k=rng.randint(1, 300))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("doc", F.lit("x")).withColumn("ids", F.lit("y"))
    rows = packing.pack(docs, queries.tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, text in enumerate(texts):
        got = b"".join(bytes(r.ids) for r in sorted(pieces[i], key=lambda r: r.start))
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(got, "<u4").tolist() == want and {r.doc_tokens for r in pieces[i]} == {len(want)}
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, queries.tokenizer_path()).collect() == []


def test_a_task_takes_little_memory_beside_its_texts(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60_000)]
    texts = pa.array([" ".join(rng.choices(words, k=500)) for _ in range(3_000)])  # 10 MB
    taken, largest, rows = {}, 0, 0

    class Docs:
        schema = {"doc_id": type("Field", (), {"dataType": type("Kind", (), {"simpleString": lambda _: "bigint"})()})()}

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            taken["run"] = run

    packing._pieces(Docs(), "doc_id", "text", queries.tokenizer_path(), packing.WINDOW, 1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc", "text"])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    for got in taken["run"](iter([batch])):
        rows += got.num_rows
        largest = max(largest, pa.total_allocated_bytes() - before)
    python = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= len(texts) and largest < 6 << 20 and python < 32 << 20, (rows, largest, python)
