import hashlib
import random
import re

from pyspark.sql import functions as F

from poilake.llm import blob_ledger as b


def base(text):
    """The base rules as they are stated: match first, then drop what is too short."""
    text, out = text or "", []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


def text_of(rng):
    parts = ["password", "Token", "SECRET", "api_key", "apikey", "=", ":", " ", "  ", "'", '"', "abc", "abcdef", "0123456789abcdef01234567", "AKIA", "ABCDEFGHIJ123456",
             "\n", "é", "ſecret", "toKen", "x", "token=token:abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "https://me:pw123@h/"]
    return "".join(rng.choices(parts, k=rng.randint(0, 40)))


def test_base_spans_are_the_stated_ones():
    rng = random.Random(1)
    for text in [None, "", *(text_of(rng) for _ in range(3000))]:
        assert b.find(text, b.BASE) == base(text)
        assert [s for s in b.find(text) if s[0] in ("assign", "access", "hex")] == base(text)


def test_each_blob_is_read_once_per_rule_version(spark):
    rng = random.Random(2)
    texts = [text_of(rng) for _ in range(40)] + [None, "", "plain " * 100_000 + "token = abcdef"]
    rows = [(i, texts[i % len(texts)]) for i in range(120)] + [(3, texts[3]), (None, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("blob", F.lit("x")).withColumn("path", F.lit("y"))
    found, ledger = b.scan(docs, "doc_id", "text", rules=b.BASE)
    got = {}
    for r in found.collect():
        got.setdefault(r.path, []).append([tuple(s) for s in r.spans])
    assert sum(map(len, got.values())) == len(rows)
    for path, text in rows:
        assert sorted(got[path][0]) == sorted(base(text))
    assert ledger.count() == len({t or "" for t in texts})
    # The same versions again, a new one, and more rules: only unseen pairs are read.
    more = docs.unionByName(spark.createDataFrame([(500, "secret: 'abcdefgh'")], "doc_id long, text string"), allowMissingColumns=True)
    _, news = b.scan_blobs(more, "doc_id", "text", ledger, b.BASE)
    assert [(r.blob, r.rules) for r in news.collect()] == [(hashlib.sha256(b"secret: 'abcdefgh'").hexdigest(), [r.name for r in b.BASE])]
    _, news = b.scan_blobs(docs, "doc_id", "text", ledger, b.RULES)
    assert {tuple(r.rules) for r in news.collect()} == {tuple(r.name for r in b.EXTRA)} and news.count() == ledger.count()
    raised = (*b.BASE[:2], b.Rule("hex", 2, r"[0-9a-f]{30,}"))
    _, news = b.scan_blobs(docs, "doc_id", "text", ledger, raised)
    assert {tuple(r.rules) for r in news.collect()} == {("hex@2",)}
    both, after = b.scan(docs, "doc_id", "text", ledger, b.RULES)
    whole, _ = b.scan(docs, "doc_id", "text", rules=b.RULES)
    kinds = [r.kind for r in b.RULES]
    shown = [{(r.path, r.s) for r in f.select("path", b.listed(F.col("spans"), kinds).alias("s")).collect()} for f in (both, whole)]
    assert shown[0] == shown[1] and after.count() == 2 * ledger.count()


def test_listing_order_and_empty_table(spark):
    df = spark.createDataFrame([([("hex", 5, 40), ("assign", 5, 9), ("assign", 1, 3), ("pem", 0, 4)],), ([],)], f"spans {b.SPANS}")
    got = [r[0] for r in df.select(b.listed(F.col("spans"), ["assign", "access", "hex"])).collect()]
    assert got == ["assign:1:3,assign:5:9,hex:5:40", ""]
    found, ledger = b.scan(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text")
    assert found.collect() == [] and ledger.collect() == []
