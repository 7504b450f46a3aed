"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.llm.memory import give_back
from poilake.llm.scratch import Scratch

#: Labelled rows that a model is fitted on at most; more are sampled by a hash of their id.
MAX_LABELLED = 40_000
#: Lengths of the word beginnings that a word's prior is taken from, shortest first.
PREFIXES = (4, 5)
#: Weight, in tokens, of the prior that a token's counts are mixed with.
PRIOR = 1.0
#: A token is evidence if its log-odds are at least so far above zero, and so many standard errors.
LEAST_ODDS, SIGNIFICANT = 1.5, 3.0
#: Passages with fewer expected by chance in a clean text of the same length are significant.
E_VALUE = 0.05
#: Tokens within which a repeated token counts less.
LOCAL = 100
#: Largest evidence that the calibration tells apart.
MAX_EVIDENCE = 300.0
#: Least hashes of their pairs of words that near copies share.
KIN = 4
_WORD = re.compile(r"[^\W\d_]+")
_BREAK = r"[^\p{L}]+"


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall((text or "").lower())


def segments(scores: list[tuple[int, float]], drift: float, n: int) -> list[tuple[float, int, int]]:
    """(score, first, last) of all maximal scoring segments, left to right (Ruzzo and Tompa).

    ``scores`` are the positions and scores of the tokens with evidence, in order; the other
    tokens up to ``n`` score -``drift``. Linear in the number of scores.
    """
    found: list[list[float]] = []  # sum before, sum after, first, last
    total, at = 0.0, 0
    for pos, score in scores:
        total -= drift * (pos - at)
        at = pos + 1
        if score <= 0:
            total += score
            continue
        part = [total, total + score, pos, pos]
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= part[0]:
                j -= 1
            if j < 0 or found[j][1] >= part[1]:
                found.append(part)
                break
            part = [found[j][0], part[1], found[j][2], part[3]]
            del found[j:]
    return [(right - left, int(first), int(last)) for left, right, first, last in found]


@dataclass
class Model:
    """Scores of tokens and beginnings with evidence, and what calibrates their segments."""

    words: dict[str, float] = field(default_factory=dict)
    drift: float = 0.01
    rate: float = 1.0  # lambda of the extreme-value law
    scale: float = 0.01  # its K
    slope: float = 0.0
    level: float = -4.0

    def odds(self, token: str) -> float:
        """The score of a token: its own, or else that of its longest known beginning."""
        score = self.words.get(token)
        if score is None:
            for k in reversed(PREFIXES):
                if len(token) > k and (score := self.words.get(token[:k] + "*")) is not None:
                    break
        return score or 0.0

    def passages(self, found: list[str], memo: dict[str, float]) -> list[tuple[float, int, int]]:
        """All segments of a tokenised text. memo: scores of tokens seen before.

        The k-th occurrence of a token within ``LOCAL`` tokens counts a k-th, as a word's
        repetitions nearby are no new evidence. What is further off changes nothing, so a passage
        scores alike wherever it is.
        """
        scores: list[tuple[int, float]] = []
        times: dict[str, deque[int]] = {}
        for i, t in enumerate(found):
            s = memo.get(t)
            if s is None:
                s = memo[t] = self.odds(t)
            if s:
                near = times.setdefault(t, deque())
                while near and near[0] <= i - LOCAL:
                    near.popleft()
                near.append(i)
                scores.append((i, s / len(near)))
        return segments(scores, self.drift, len(found)) if scores else []

    def evidence(self, parts: list[tuple[float, int, int]], n: int) -> float:
        """-log of the probability of such segments in a clean text of n tokens.

        Of the r best, normalised by lambda and K n, the sum t has about the probability
        exp(-t) t^(r-1) / (r! (r-1)!); the least over all r counts.
        """
        best, total = 0.0, 0.0
        for r, score in enumerate(sorted((p[0] for p in parts), reverse=True), 1):
            total += self.rate * score - math.log(max(self.scale * n, 1e-300))
            if total > r:
                p = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r)
                best = max(best, p)
        return min(best, MAX_EVIDENCE)

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.level + self.slope * math.log1p(evidence)))))

    def judge(
        self, text: str | None, memo: dict[str, float]
    ) -> tuple[float, int, str | None, list[tuple[int, int, float]]]:
        """(score, significant passages, the best passage, all of them) of a whole text."""
        found = tokens(text)
        parts = self.passages(found, memo)
        score = self.probability(self.evidence(parts, len(found)))
        chance = self.scale * max(1, len(found))
        good = [p for p in parts if chance * math.exp(-min(700.0, self.rate * p[0])) < E_VALUE]
        top = max(good, default=None)
        worst = " ".join(found[top[1] : top[2] + 1]) if top else None
        return score, len(good), worst, [(first, last, float(s)) for s, first, last in good]


#: Tokens whose scores a task remembers.
_REMEMBER = 200_000


def judged(model: Model, text: Column) -> Column:
    """struct(score, passages, worst, spans) of a text column, by one Arrow UDF."""

    @F.pandas_udf("score double, passages int, worst string, spans array<struct<first:int,last:int,score:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo: dict[str, float] = {}
        for batch in batches:
            rows = []
            for t in batch:
                if len(memo) > _REMEMBER:
                    memo.clear()
                rows.append(model.judge(t, memo))
            yield pd.DataFrame(rows, columns=["score", "passages", "worst", "spans"])
        del memo
        give_back()

    return run(text)


def labelled(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int
) -> DataFrame:
    """(text, y) of at most about ``max_labelled`` labelled rows, chosen by a hash of their id.

    Ids with labels that differ count as toxic. The sample's ids are sent to all tasks; their
    number is bounded by ``max_labelled``. Of copies, exact or near, one stays in the sample, as
    the words of one text are no evidence however often it is copied: texts count as copies if
    the least hashes of their pairs of words agree under ``KIN`` hash functions, which texts
    that merely share some pairs do not, and texts of fewer than two words if those are equal.
    """
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")).where("id is not null and y is not null")
    total = known.count()
    span = 1 << 30
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(span)) < int(span * min(1.0, max_labelled / max(total, 1))))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = rows.join(F.broadcast(known), "id").select("text", F.col("y").cast("int").alias("y"))
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), _BREAK), lambda w: w != "")
    sample = sample.withColumn("words", words)
    following = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0)))
    # The last word has no pair; xxhash64 skips nulls, so it is filtered.
    pairs = F.filter(
        F.zip_with("words", following, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))), lambda h: h.isNotNull()
    )
    sample = sample.withColumn("pairs", pairs)
    least = [F.array_min(F.transform("pairs", lambda h, k=k: F.xxhash64(F.lit(k), h))) for k in range(KIN)]
    kin = F.when(F.size("words") > 1, F.array(*least)).otherwise(F.array(F.xxhash64("words")))
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")
    return sample.groupBy("y", kin.alias("kin")).agg(one).select("one.text", "y")


def _root(beta: dict[float, float], drift_mass: float, drift: float) -> float:
    """lambda > 0 with sum of p(s) exp(lambda s) = 1 over the scores of clean tokens."""

    def excess(x: float) -> float:
        return sum(p * math.exp(min(600.0, x * s)) for s, p in beta.items()) + drift_mass * math.exp(-x * drift) - 1.0

    low, high = 1e-6, 1e-6
    while high < 20 and excess(high) <= 0:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) <= 0 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """(level, slope) of a logistic curve, by Newton's method with a small ridge."""
    a = np.stack([np.ones_like(x), x], axis=1)
    b = np.zeros(2)
    ridge = np.diag([0.01, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        g = a.T @ (w * (y - p)) - ridge @ b
        h = (a * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge
        step = np.linalg.solve(h, g)
        b += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(max(b[1], 0.0))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """Learn token scores and their calibration from labelled documents.

    A token's odds of coming from a toxic text, over those of any token, are its document
    counts mixed with a Dirichlet prior: the odds of its beginning, which in turn are mixed
    with those of the shorter one and of all tokens. So unseen words inherit what is known of
    their beginning. Scores clearly above zero are evidence.

    The extreme-value law of the best segment in clean text has lambda from the clean tokens'
    scores and K by maximum likelihood; a logistic curve takes a document's evidence to a
    probability. Without labelled rows of both kinds every text scores the same, below 0.3.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    sample, path = scratch.store_at(labelled(docs, labels, id_col, text_col, label_col, max_labelled), "labelled")
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), _BREAK))
    seen = sample.select("y", F.explode(words).alias("token")).where("token <> ''")
    counts = seen.groupBy("token").agg(F.sum("y").alias("n1"), F.count("*").alias("n"))
    counts = scratch.store(counts.select("token", "n1", (F.col("n") - F.col("n1")).alias("n0")), "counts")
    sums = counts.agg(F.sum("n1"), F.sum("n0")).first()
    model = Model()
    if not sums[0] or not sums[1]:
        return model
    base = sums[0] / (sums[0] + sums[1])

    def mixed(prior: Column) -> Column:
        return (F.col("n1") + F.lit(PRIOR) * prior) / (F.col("n1") + F.col("n0") + F.lit(PRIOR))

    def standing(rho: Column, prior: Column) -> tuple[Column, Column]:
        score = F.log(rho / (1 - rho)) - F.lit(math.log(base / (1 - base)))
        error = F.sqrt(1 / (F.col("n1") + PRIOR * prior) + 1 / (F.col("n0") + PRIOR * (1 - prior)))
        return score, score / error

    level, parts = None, []
    for k in (*PREFIXES, None):
        if k is None:
            here = counts.withColumn("key", F.col("token"))
        else:
            here = (
                counts.where(F.length("token") > k)
                .groupBy(F.concat(F.substring("token", 1, k), F.lit("*")).alias("key"))
                .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
            )
        if level is None:
            here = here.withColumn("prior", F.lit(base))
        else:
            up = level.select(F.col("key").alias("up"), F.col("rho").alias("prior"))
            stem = F.when(F.length(F.rtrim(F.lit("*"), F.col("key"))) >= before + (k is None), F.substring("key", 1, before))
            here = here.withColumn("up", F.concat(stem, F.lit("*"))).join(up, "up", "left").drop("up")
            here = here.withColumn("prior", F.coalesce("prior", F.lit(base)))
        here = here.withColumn("rho", mixed(F.col("prior")))
        score, z = standing(F.col("rho"), F.col("prior"))
        level = here.withColumns({"score": score, "z": z})
        if k is not None:
            level = scratch.store(level, f"level{k}")
            before = k
        parts.append(level.where((F.col("z") > SIGNIFICANT) & (F.col("score") > LEAST_ODDS)).select("key", "score", "n1", "n0"))
        if k is None:
            # A frequent word that the beginning's evidence would misjudge is set to zero.
            parts.append(
                level.where(((F.col("z") <= SIGNIFICANT) | (F.col("score") <= LEAST_ODDS)) & (F.col("n0") >= 3)).join(
                    parts[-2].select(F.expr(f"left(key, {before})").alias("p")), F.expr(f"left(key, {before})") == F.col("p"), "left_semi"
                ).select("key", F.lit(0.0).alias("score"), "n1", "n0")
            )
    rows = []
    for part in parts:
        rows += part.collect()  # tokens with evidence in a bounded sample
    model.words = {r["key"]: float(r["score"]) for r in rows}
    whole = [r for r in rows if not r["key"].endswith("*") and r["score"] > 0]
    toxic, clean = (sum(r[c] for r in whole) + 0.5 for c in ("n1", "n0"))
    share1, share0 = toxic / (sums[0] + 1), clean / (sums[1] + 1)
    model.drift = max(0.01, math.log((1 - min(share0, 0.9)) / (1 - min(share1, 0.9))))
    null: dict[float, float] = {}
    for r in whole:
        s = round(r["score"], 1)
        null[s] = null.get(s, 0.0) + (r["n0"] + 0.5 / len(whole)) / (sums[1] + 1)
    model.rate = _root(null, 1 - min(0.9, sum(null.values())), model.drift)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, float] = {}
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = tokens(text)
                parts = model.passages(found, memo)
                rows.append((len(found), max((p[0] for p in parts), default=0.0)))
            yield pd.DataFrame(rows, columns=["n", "best"])

    law = sample.where("y = 0").select("text").mapInPandas(best, "n long, best double")
    law = law.agg(F.count("*"), F.sum(F.col("n") * F.exp(-F.lit(model.rate) * F.col("best")))).first()
    model.scale = max(1e-12, (law[0] + 1) / ((law[1] or 0.0) + 1))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, float] = {}
        for batch in batches:
            rows = []
            for text, y in zip(batch["text"], batch["y"]):
                found = tokens(text)
                rows.append((round(math.log1p(model.evidence(model.passages(found, memo), len(found))), 2), int(y)))
            yield pd.DataFrame(rows, columns=["x", "y"])

    curve = sample.select("text", "y").mapInPandas(measure, "x double, y int").groupBy("x", "y").count().toPandas()
    model.level, model.slope = _logistic(*(curve[c].to_numpy(dtype=float) for c in ("x", "y", "count")))
    scratch.drop(path)
    return model


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, passages, worst, spans) per row: its probability of being toxic, the number of
    significant passages, the words of the best one, and for each its first and last token and
    its score, in the order of the text.

    Null and empty texts have no evidence and the lowest score. Rows are scored one by one, so
    repeated rows score alike; other columns are not read.
    """
    return (
        docs.select(F.col(id_col).alias("id"), judged(model, F.col(text_col)).alias("j"))
        .select("id", "j.score", "j.passages", "j.worst", "j.spans")
    )
