"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.llm.scratch import Scratch

#: Copies of a blob's findings, so that a blob on a third of all paths is spread over tasks.
SALTS = 16
SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Raise ``version`` with the pattern, so that old blobs are read again.

    Of the leftmost non-overlapping matches those stay whose ``group`` has ``least`` letters.
    ``needs``: lower-case strings of which a text must hold one, whatever its case.
    """

    kind: str
    version: int
    pattern: str
    needs: tuple[str, ...] = ()
    flags: int = 0
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str, lowered: str) -> list[tuple[int, int]]:
        if self.needs and not any(n in lowered for n in self.needs):
            return []
        found = re.compile(self.pattern, self.flags).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


#: Fixed base rules, in the order of their kinds. A greedy run that is long enough is the same
#: match as any run that is checked for its length afterwards.
BASE = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.IGNORECASE | re.ASCII,
        2,
        6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: Further kinds that the scan adds.
EXTRA = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("private key-----",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyj",)),
    Rule("vendor", 1, r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}", ("gh", "xox", "sk_live_")),
    Rule("url_login", 1, r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]{1,64}:[^\s/:@]{3,128}@", ("://",)),
)
RULES = BASE + EXTRA


def find(text: str | None, rules: Sequence[Rule] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text's secrets in code points, by start, then in order of the rules."""
    text = text or ""
    lowered = text.lower()
    found = [(start, i, r.kind, end) for i, r in enumerate(rules) for start, end in r.spans(text, lowered)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def blob_id(text: Column) -> Column:
    """The content address of a text; null is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_blobs(
    versions: DataFrame, path_col: str, text_col: str, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES
) -> tuple[DataFrame, DataFrame]:
    """(paths, news): (path, blob) of every version, and a ledger row for every blob read now.

    ``ledger`` has (blob, rules, spans): which rule versions have read which blob and what they
    found. Each blob is read once, by the rules that have not read it in their version, at one
    of its paths; blobs that nothing is left to read for cause no work beyond their address.
    """
    spark = versions.sparkSession
    scratch = Scratch(spark, "blobs")
    rows = versions.select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    paths = scratch.store(rows.select("path", blob_id(F.col("text")).alias("blob")), "paths")
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*[F.lit(r.name) for r in rules]).cast("array<string>")
    if ledger is None:
        todo = blobs.withColumn("rules", every)
    else:
        read = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("read"))
        todo = blobs.join(read, "blob", "left").select(
            "blob", "path", F.array_except(every, F.coalesce("read", F.array().cast("array<string>"))).alias("rules")
        )
    todo = scratch.store(todo.where(F.size("rules") > 0), "todo")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {r.name: r for r in rules}
        for batch in batches:
            spans = [find(t, [known[n] for n in names]) for t, names in zip(batch["text"], batch["rules"])]
            out = [[{"kind": k, "start": a, "end": b} for k, a, b in found] for found in spans]
            yield pd.DataFrame({"blob": batch["blob"], "rules": batch["rules"], "spans": out})

    # Texts meet the blobs to read by path and address; the addresses are the side held in memory.
    met = rows.withColumn("own", blob_id(F.col("text"))).join(
        todo.withColumnRenamed("path", "at").hint("shuffle_hash"),
        F.col("path").eqNullSafe(F.col("at")) & (F.col("own") == F.col("blob")),
    )
    news = met.select("blob", "rules", "text").mapInPandas(run, LEDGER)
    # A path that occurs twice with one text is read twice: one row stays.
    return paths, scratch.store(news, "news").dropDuplicates(["blob"])


def findings(paths: DataFrame, ledger: DataFrame) -> DataFrame:
    """(path, blob, spans) of every path: what any rule in ``ledger`` found in its blob."""
    spans = ledger.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = paths.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    return salted.join(spans, ["blob", "salt"]).select("path", "blob", "spans")


def scan(
    versions: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
) -> tuple[DataFrame, DataFrame]:
    """(findings of every version, ledger after the scan).

    Null texts are empty; equal texts share a blob and its findings; a null path is a path like
    any other; repeated rows stay repeated. Give the returned ledger to the next scan.
    """
    paths, news = scan_blobs(versions, path_col, text_col, ledger, rules)
    after = news if ledger is None else ledger.select("blob", "rules", "spans").unionByName(news)
    return findings(paths, after), after


def listed(spans: Column, kinds: Sequence[str]) -> Column:
    """kind:start:end of the spans of ``kinds``, by start, then by the order of ``kinds``."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        F.filter(spans, lambda s: F.array_contains(order, s["kind"])),
        lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("o"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
