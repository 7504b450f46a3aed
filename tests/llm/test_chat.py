import hashlib
import json
import random

from pyspark.sql import functions as F

from poilake.llm import chat


def turns_of(spark, records):
    df = spark.createDataFrame([(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)], "id long, record string")
    return {r.id: r for r in chat.to_turns(df.withColumn("turns", F.lit(1)), "id", "record").collect()}


def test_layouts_become_the_same_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"value": "a", "from": "gpt"}]},
        {"response": "a", "prompt": "q"},
        {"prompt": "q", "completion": "a"},
        {"question": "q", "answer": "a"},
        {"instruction": "q", "output": "a"},
        {"instruction": "q", "input": "", "output": "a"},
        {"system": "s", "messages": [{"role": "user", "content": None}, {"role": "assistant", "content": "a"}]},
        {"instruction": "q", "input": "more", "output": "a"},
    ]
    got = turns_of(spark, records)
    for i in range(7):
        assert [tuple(t) for t in got[i].turns] == [("user", "q"), ("assistant", "a")], got[i]
    assert [tuple(t) for t in got[7].turns] == [("system", "s"), ("user", ""), ("assistant", "a")]
    assert got[8].turns[0].text == "q\n\nmore" and got[1].layout == "conversations"
    assert len({got[i].fingerprint for i in range(9)}) == 8  # 6 and 8 have the same paths


def test_unknown_records(spark):
    got = turns_of(spark, [None, "", "{broken", "[]", {"messages": []}, {"prompt": "q", "response": "a", "extra": 1}, {"messages": "text"}])
    assert all(r.layout is None and r.turns is None for r in got.values()) and len(got) == 7


def test_round_trip(spark):
    rng = random.Random(3)
    parts = [*chat.CONTROL, "\\", "\\\\", "<", "|", ">", "\n", "[", "INST]", "im_end", "é", "漢", "𝄞", " ", "x", "<|im_end|>\n", "\t", '"', "\x00"]
    rows = []
    for c in range(80):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool use\n<|im_end|>", "é+ %2B", None])
            rows.append((c, turn, role, rng.choice([None, "", "".join(rng.choices(parts, k=rng.randint(1, 14)))])))
    rows += [(900, 0, "assistant", "word " * 100_000), (901, 3, "user", "b"), (901, 3, "user", "a"), (901, 3, "user", "a"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string").withColumn("id", F.lit(7)).withColumn("record", F.lit(7))
    out = chat.format_turns(chat.to_turns(chat.as_messages(df, "conv", "turn", "role", "text"), "id", "record"))
    read = out.select("id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss"))
    want = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r.id: r for r in read.collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].loss == "".join(x for r, x in turns if r == "assistant")
        assert got[c].formatted == "".join(s.text for s in got[c].segments)
        assert got[c].formatted.count(chat.START) == got[c].formatted.count("<|im_end|>") == len(turns)


def test_empty_table_and_empty_turns(spark):
    df = spark.createDataFrame([], "conv long, turn long, role string, text string")
    assert chat.as_messages(df, "conv", "turn", "role", "text").collect() == []
    none = spark.createDataFrame([(1, []), (2, None)], f"id long, turns {chat.TURNS}")
    assert {r.id: r.formatted for r in chat.format_turns(none).collect()} == {1: "", 2: None}


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv long, turn long, role string, text string")
    plan = chat.format_turns(chat.to_turns(chat.as_messages(df, "conv", "turn", "role", "text"), "id", "record"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert hashlib.sha256(b"").hexdigest()  # digests of the query are plain SHA-256
