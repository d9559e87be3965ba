"""Toxic passages as maximum-scoring segments over token log-odds.

Every word has a log-odds score (toxic against other labelled documents) under informative Dirichlet priors: those that find
the telling forms share the whole vocabulary, those that estimate a word lean on its stems. What says nothing scores a small
negative drift. A linear-time scan finds all maximal segments of positive sum. How large such a sum
gets by chance in a clean text of a given length follows an extreme-value law whose two constants are fitted on the clean
labelled documents; the surprise of the segments adds up to the evidence, whose logarithm a logistic curve turns into a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, bounded_sample, shipped, slices, staged, texts

#: Weight of the prior as a part of all counts; each word's share of it is its share of the labelled text.
PRIOR = 0.02
#: Least distance of a log-odds from 0 in standard deviations for it to count.
SURE = 2.5
#: Weight of a shorter form in the estimate of a longer one, in documents.
STEP = 3.0
#: What a word without known odds costs a segment.
DRIFT = 0.5
#: Leading characters that stand for a word where they tell more than it.
STEMS = (6, 5, 4)
#: The odds are fitted on about this many labelled rows, whole texts, chosen by a hash of the text.
FIT_ROWS = 20_000
#: Words whose score a worker remembers.
MEMO_WORDS = 300_000
#: Chance of a segment this good in a clean text, below which it is reported.
SIGNIFICANT = 0.01

SCORED = "struct<score:double,toxic:boolean,evidence:double,segments:array<struct<start:long,stop:long,odds:double,p:double>>>"


def tokens(text: bytes) -> list[str]:
    """Lower-cased words."""
    return text.translate(WORD_BYTES).decode("utf-8", "replace").lower().split()


def forms(word: str) -> list[str]:
    """A word and the stems that may stand for it, longest first; a stem ends with `*`."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


class Scores(dict):
    """Word -> log-odds against the share of toxic documents, looked up once, then remembered.

    The estimate goes from the shortest stem to the word itself. Each step is the mean of a two-way Dirichlet whose prior
    mean is the step before and whose prior weight is `STEP`; a form that was never seen adds nothing.
    """

    def __init__(self, counts: dict[str, tuple[int, int]], base: float):
        super().__init__()
        self.counts, self.base = counts, base

    def __missing__(self, word: str) -> float:
        rate, known = self.base, False
        for form in reversed(forms(word)):
            if form in self.counts:
                a, b = self.counts[form]
                rate, known = (a + STEP * rate) / (a + b + STEP), True
        value = math.log(rate / (1 - rate)) - math.log(self.base / (1 - self.base)) if known else 0.0
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value
        return value


def segments(values: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of (start, stop, score) runs: the linear-time stack of cumulative sums.

    A candidate joins the nearest earlier one that begins lower and ends lower, taking what lies between along.
    """
    held: list[list] = []  # [start, stop, sum before, sum after]
    total = 0.0
    for start, stop, score in values:
        before, total = total, total + score
        if score <= 0:
            continue
        new = [start, stop, before, total]
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][2] >= new[2]:
                k -= 1
            if k < 0 or held[k][3] >= new[3]:
                held.append(new)
                break
            new = [held[k][0], new[1], held[k][2], new[3]]
            del held[k:]
    return [(a, b, after - before) for a, b, before, after in held]


@dataclass
class Model:
    """Counts of the forms that tell something, the share of toxic documents, the two constants of the chance law, and the logistic curve."""

    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    base: float = 0.5
    rate: float = 1.0
    size: float = 1.0
    slope: float = 0.0
    shift: float = -3.0

    def found(self, batch: list[bytes | None], memo: Scores) -> list[tuple[int, list[tuple[int, int, float]]]]:
        """Per text its number of words and its maximal segments."""
        split = [tokens(t) if t else [] for t in batch]
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
        flat = (w for ws in split for w in ws)
        raw = np.fromiter(map(memo.__getitem__, flat), dtype=np.float64, count=int(bounds[-1]))
        value = raw - DRIFT
        running = np.concatenate([[0.0], np.cumsum(value)])
        up = np.flatnonzero(value > 0)
        owner = np.searchsorted(bounds, up, side="right") - 1
        out: list = [(len(w), []) for w in split]
        for doc in np.unique(owner).tolist():
            at = up[np.searchsorted(owner, doc):np.searchsorted(owner, doc, "right")]
            first = int(bounds[doc])
            runs: list[tuple[int, int, float]] = []
            last = first
            for p in at.tolist():
                if p > last:
                    runs.append((last - first, p - first, float(running[p] - running[last])))
                runs.append((p - first, p + 1 - first, float(value[p])))
                last = p + 1
            out[doc] = (out[doc][0], segments(runs))
        return out

    def chance(self, n: int, score: float) -> float:
        """Probability that a clean text of n words has a segment of at least this sum."""
        return -math.expm1(-min(700.0, self.size * max(1, n) * math.exp(-min(700.0, self.rate * score))))

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """Surprise of the best segment plus that of all others."""
        return float(sum(max(0.0, -math.log(max(self.chance(n, s), 1e-300))) for _, _, s in found))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.shift + self.slope * math.log1p(evidence)))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """form -> labelled documents of each kind that hold it, summed within each slice; the empty form counts documents."""
    for batch in batches:
        values, lengths = texts(batch.column("t"))
        labels = batch.column("y").to_pylist()
        for a, b in slices(lengths, 4 << 20):
            toxic, other = Counter(), Counter()
            for text, label in zip(values[a:b], labels[a:b]):
                (toxic if label else other).update({f for w in set(tokens(text)) for f in forms(w)})
            names = list(toxic.keys() | other.keys())
            yield pa.RecordBatch.from_pydict({"f": pa.array(names, pa.string()), "a": pa.array([toxic[f] for f in names], pa.int64()),
                                              "b": pa.array([other[f] for f in names], pa.int64())})


def chance_rate(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(weight * exp(root * value)) = 1, where the mean value is negative."""
    weights = weights / weights.sum()
    if not (values > 0).any():
        return 1.0
    f = lambda x: float((weights * np.exp(np.minimum(x * values, 600))).sum()) - 1
    high = 1e-3
    while f(high) < 0 and high < 1e3:
        high *= 2
    low = high / 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a curve with a weak pull to 0, by Newton's method."""
    scale = max(1.0, float(np.percentile(x, 99)) if len(x) else 1.0)
    data = np.stack([np.minimum(x, scale) / scale * 10, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(data @ w, -30, 30)))
        slope = data.T @ (p - y) + 1e-2 * w * [1, 0]
        curve = (data * (p * (1 - p) + 1e-9)[:, None]).T @ data + 1e-2 * np.diag([1, 1e-6])
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]) * 10 / scale, float(w[1])


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
        fit_rows: int = FIT_ROWS) -> Model:
    """Model of labelled texts; rows without text or label teach nothing, equal texts with equal labels teach once.

    Uses a bounded sample of the label rows (about `fit_rows`, whole texts), so the labels can go to where the documents
    are, and what comes to the driver is bounded as well: the forms whose odds are sure, and one number a sampled row.
    """
    spark = shipped(docs.sparkSession)
    known = labels.select(F.col(key).alias("i"), (F.col(label) != 0).alias("y")).where("i is not null and y is not null")
    few = bounded_sample(known, fit_rows, known.count(), "i")
    sample = docs.select(F.col(key).alias("i"), F.col(text).alias("t")).where("t is not null") \
        .join(F.broadcast(few), "i").select("t", "y").dropDuplicates(["t", "y"])
    sample = staged(sample)
    counted = staged(sample.mapInArrow(_count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    stems = F.col("f").endswith("*")
    total = counted.groupBy(stems.alias("stem")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    model = Model()
    if not total or not sum(r.a for r in total) or not sum(r.b for r in total):
        return model
    sums = [(float(sum(getattr(r, k) for r in total if r.stem is s)) + 1) for s in (False, True) for k in "ab"]
    na, nb = F.when(stems, sums[2]).otherwise(sums[0]), F.when(stems, sums[3]).otherwise(sums[1])
    prior = PRIOR * (F.col("a") + F.col("b"))
    weight = PRIOR * (na + nb)
    odds = F.log((F.col("a") + prior) / (na + weight - F.col("a") - prior)) - F.log((F.col("b") + prior) / (nb + weight - F.col("b") - prior))
    sure = odds / F.sqrt(1 / (F.col("a") + prior) + 1 / (F.col("b") + prior))
    told = counted.where(F.abs(sure) >= SURE).select(F.col("f").alias("g"))
    stem = F.rtrim(F.col("f"), F.lit("*"))
    related = F.array_distinct(F.array("f", *(F.when(F.length(stem) >= n, F.concat(F.substring(stem, 1, n), F.lit("*"))) for n in STEMS)))
    near = counted.select("f", "a", "b", F.explode(related).alias("g")).join(told, "g", "left_semi").select("f", "a", "b").distinct()
    model.counts = {r.f: (r.a, r.b) for r in near.toLocalIterator()}
    kinds = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    model.base = kinds[True] / (kinds[True] + kinds[False])
    held = spark.sparkContext.broadcast(model)

    kind = pa.schema([("y", pa.bool_()), ("n", pa.int64()), ("s", pa.list_(pa.float64())), ("v", pa.float64()), ("k", pa.int64())])

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per sampled row: label, words, sums of its segments; and how often each score occurs in clean rows."""
        model_, memo = held.value, Scores(held.value.counts, held.value.base)
        for batch in batches:
            values, lengths = texts(batch.column("t"))
            labels = batch.column("y").to_pylist()
            for a, b in slices(lengths, 1 << 20):
                got = model_.found(values[a:b], memo)
                seen: Counter = Counter()
                for t, y in zip(values[a:b], labels[a:b]):
                    if not y:
                        seen.update(round(memo[w] - DRIFT, 1) for w in tokens(t))
                yield pa.RecordBatch.from_pylist(
                    [{"y": bool(y), "n": n, "s": [float(x[2]) for x in s]} for y, (n, s) in zip(labels[a:b], got)]
                    + [{"v": float(v), "k": n} for v, n in seen.items()], kind)

    seen = staged(sample.mapInArrow(profile, "y boolean, n long, s array<double>, v double, k long"))
    scores = seen.where("v is not null").groupBy("v").agg(F.sum("k").alias("k")).toPandas()
    per_row = seen.where("y is not null").select("y", "n", "s").toPandas()
    if len(scores):
        model.rate = chance_rate(scores["v"].to_numpy(float), scores["k"].to_numpy(float))
    clean = per_row[~per_row["y"].astype(bool)]
    best = np.array([max(s) if len(s) else 0.0 for s in clean["s"]])
    some = best > 0
    # share of clean rows with a segment at all fixes the size: rows without one say that the chance was not met
    expected = np.maximum(clean["n"].to_numpy(float), 1)
    model.size = float(max(1e-12, (some * np.exp(np.minimum(model.rate * best, 60)) / expected).sum() / max(1, len(clean)))) if len(clean) else 1.0
    model.size = min(model.size, 1.0)
    x = np.log1p([model.evidence(int(n), [(0, 0, v) for v in s]) for n, s in zip(per_row["n"], per_row["s"])]).astype(float)
    model.slope, model.shift = logistic(x, per_row["y"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "toxicity") -> DataFrame:
    """`docs` with a struct column `out`: `score` (0 to 1), `toxic` (score >= 0.5), `evidence`, significant `segments`.

    Segments are word ranges of the whole text with their summed odds and their chance. Null and empty texts have no
    segments and get the score of no evidence. Repeated rows are each answered; ties play no part; a column already called
    `out` is replaced; without labelled rows of both kinds every score is that of no evidence.
    """
    held = shipped(docs.sparkSession).sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("toxic", pa.bool_()), ("evidence", pa.float64()), ("segments", pa.list_(pa.struct([
        ("start", pa.int64()), ("stop", pa.int64()), ("odds", pa.float64()), ("p", pa.float64())])))])

    @F.arrow_udf(SCORED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model_, memo = held.value, Scores(held.value.counts, held.value.base)
        for column in batches:
            values, lengths = texts(column)
            rows: list[dict] = []
            for a, b in slices(lengths, 1 << 20):
                for n, found in model_.found(values[a:b], memo):
                    evidence = model_.evidence(n, found)
                    s = model_.score(evidence)
                    rows.append({"score": s, "toxic": s >= 0.5, "evidence": evidence, "segments": [
                        {"start": i, "stop": j, "odds": v, "p": p} for i, j, v in found if (p := model_.chance(n, v)) <= SIGNIFICANT]})
            yield pa.array(rows, kind)

    return docs.withColumn(out, run.asNondeterministic()(F.col(text)))


def keep_clean(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Rows of `docs` that are not toxic."""
    return score(docs, model, text=text, out="_toxicity").where(~F.col("_toxicity")["toxic"]).select(*docs.columns)
