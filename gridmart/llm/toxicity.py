"""Toxic passages by maximum-scoring segment search.

Tokens are runs of letters, lower-cased.  A token's features are its stems
(first 4 to 8 letters) and the word itself.  Each feature's log-odds between
toxic and other documents are smoothed by a Dirichlet prior: the pseudo-counts
of a feature are those of its nearest shorter significant feature, in the end
the share of toxic documents.  A feature counts only if its log-odds are
``MIN_Z`` standard deviations from even.  A token scores the log-odds of its
longest significant feature less ``DRIFT``, so a run of ordinary words loses.

One linear scan over a text's token scores finds all maximal scoring segments
(every segment that can not be extended or cut to score more, the segments
being disjoint).  Segment scores of texts of n tokens follow an extreme-value
law, P(S >= x) = 1 - exp(-K n exp(-lambda x)); lambda solves
sum p(s) exp(lambda s) = 1 over the token scores of the documents that are not
toxic and K is its maximum-likelihood value on them.  Segments whose expected
number E = K n exp(-lambda S) is below ``MAX_E`` are toxic passages.  A
document's evidence is the sum of -ln E over its passages; logistic regression
on the labelled rows turns it into a probability.

Learning uses at most about ``MAX_DOCS`` labelled rows, drawn by a hash of
their doc_id (all where there are fewer), so the model is bounded whatever the
corpus; every document is scored on its whole text.

Defined results: a null or empty text has no passages and scores like any text
without evidence; without labels of both classes every score is 0.  A doc_id
with several labels is toxic if one says so; rows with a null doc_id or label
are not learned from.  Repeated rows are scored one by one; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bound of the labelled sample, in documents.
MAX_DOCS = 20_000
PSEUDO = 5.0
MIN_Z = 3.0
DRIFT = 1.0
MAX_E = 0.5
STEMS = range(4, 9)

_WORD = regex.compile(r"\p{L}+")
#: Words whose scores a worker remembers.
_REMEMBER = 200_000


def features(word: str) -> list[str]:
    """Stems, shortest first, then the word; a stem ends in ``*``."""
    return [word[:n] + "*" for n in STEMS if n <= len(word)] + [word]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in order of place, in
    linear time.  Open candidates keep the sum before and after them; a new
    one is joined to the nearest candidate that starts lower, when that also
    ends lower than the new one does."""
    open_: list[list] = []         # start, end, sum before, sum after
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total]
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= new[2]:
                j -= 1
            if j < 0 or open_[j][3] >= new[3]:
                open_.append(new)
                break
            new = [open_[j][0], new[1], open_[j][2], new[3]]
            del open_[j:]
    return [(a, b, after - before) for a, b, before, after in open_]


@dataclass
class Model:
    odds: dict[str, float]      # of the significant features
    lam: float = 1.0
    k: float = 1.0
    bias: float = -50.0
    slope: float = 0.0

    def __post_init__(self):
        self._known: dict[str, float] = {}

    def token(self, word: str) -> float:
        score = self._known.get(word)
        if score is None:
            held = next((self.odds[f] for f in reversed(features(word)) if f in self.odds), 0.0)
            score = held - DRIFT
            if len(self._known) >= _REMEMBER:
                self._known.clear()
            self._known[word] = score
        return score

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and the maximal segments in token positions."""
        token = self.token
        scores = [token(w) for w in _WORD.findall(text.lower())]
        if not scores or max(scores) <= 0:
            return len(scores), []
        return len(scores), maximal_segments(scores)

    def expected(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-self.lam * score)

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """(first token, end token, score, expected number) of the toxic passages."""
        n, found = self.segments(text)
        return [(a, b, s, e) for a, b, s in found if (e := self.expected(s, n)) < MAX_E]

    def evidence(self, passages) -> float:
        return sum(-math.log(max(e, 1e-300)) for *_, e in passages)

    def probability(self, evidence: float) -> float:
        z = self.bias + self.slope * math.log1p(evidence)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _solve_lambda(scores: Counter) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1."""
    total = sum(scores.values())
    if not any(s > 0 for s in scores) or sum(s * n for s, n in scores.items()) >= 0:
        return 1.0
    low, high = 1e-6, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        if sum(n / total * math.exp(min(700.0, mid * s)) for s, n in scores.items()) < 1:
            low = mid
        else:
            high = mid
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton's method, with a weak ridge."""
    a = np.column_stack([np.ones_like(x), x])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - 0.1 * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _sample(docs: DataFrame, labels: DataFrame, max_docs: int) -> DataFrame:
    """(text, toxic) of the labelled rows learned from, kept in the shared folder."""
    known = common.columns(labels, {"doc_id": "long", "toxic": "int"}) \
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL") \
        .groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    n = known.count()
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    chosen = known.filter(draw < min(1.0, max_docs / max(n, 1)))
    # at most about max_docs narrow rows: small enough to send whatever the corpus
    return common.cut(common.columns(docs, {"doc_id": "long", "text": "string"})
                      .join(F.broadcast(chosen), "doc_id")
                      .select(F.coalesce("text", F.lit("")).alias("text"), "toxic"))


def _feature_counts(batches):
    zero, one = Counter(), Counter()

    def out():
        names = list(zero.keys() | one.keys())
        for i in range(0, len(names), 50_000):
            part = names[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([zero[f] for f in part], pa.int64()),
                 pa.array([one[f] for f in part], pa.int64())], names=["feature", "n0", "n1"])
        zero.clear()
        one.clear()

    for batch in common.slices(batches, "text"):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            held = set()
            for word in set(_WORD.findall(text.lower())):
                held.update(features(word))
            (one if toxic else zero).update(held)
        if len(zero) + len(one) > 1_000_000:
            yield from out()
    yield from out()


def learn(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """The model of ``labels`` (doc_id, toxic) over their texts in ``docs``."""
    sample = _sample(docs, labels, max_docs)
    classes = {r.toxic: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return Model({})
    base = classes[1] / sum(classes.values())
    a, b = F.col("n1") + PSEUDO * base, F.col("n0") + PSEUDO * (1 - base)
    z = (F.log(a / b) - math.log(base / (1 - base))) / F.sqrt(1 / a + 1 / b)
    strong = {r.feature: (r.n0, r.n1) for r in
              sample.mapInArrow(_feature_counts, "feature string, n0 long, n1 long")
              .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
              .filter(F.abs(z) > MIN_Z).collect()}
    model = Model(_log_odds(strong, base))
    given = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        """Of each sampled document: class, tokens, best segment, token scores."""
        for batch in common.slices(batches, "text"):
            rows = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                n, found = given.value.segments(text)
                counts = Counter(round(given.value.token(w), 2) for w in _WORD.findall(text.lower())) \
                    if not toxic else {}
                rows.append((toxic, n, [s for *_, s in found], [float(s) for s in counts], list(counts.values())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()),
                    pa.list_(pa.int64())))], names=["toxic", "n", "found", "scores", "counts"])

    # narrow rows of the bounded sample
    seen = sample.mapInArrow(
        scan, "toxic int, n long, found array<double>, scores array<double>, counts array<long>").collect()
    spread: Counter = Counter()
    for r in seen:
        for s, c in zip(r.scores, r.counts):
            spread[s] += c
    for odds in model.odds.values():      # the prior's share of each feature in calm documents
        spread[round(odds - DRIFT, 2)] += PSEUDO * (1 - base)
    model.lam = _solve_lambda(spread)
    calm = [r for r in seen if not r.toxic and r.n]
    model.k = len(calm) / max(1e-9, sum(r.n * math.exp(-model.lam * max(r.found, default=0.0)) for r in calm)) \
        if calm else 1.0
    x = [model.evidence([(e,) for s in r.found if (e := model.expected(s, r.n)) < MAX_E]) for r in seen]
    model.bias, model.slope = _logistic(np.log1p(np.array(x)), np.array([float(r.toxic) for r in seen]))
    return model


def _log_odds(strong: dict[str, tuple[int, int]], base: float) -> dict[str, float]:
    """Log-odds of each feature against the base, the prior of each being the
    share of its nearest shorter feature among ``strong``."""
    even, share = math.log(base / (1 - base)), {}
    for f in sorted(strong, key=lambda f: (len(f.rstrip("*")), not f.endswith("*"))):
        word = f.rstrip("*")
        chain = features(word)
        above = next((g for g in reversed(chain[:chain.index(f)]) if g in share), None)
        prior = share[above] if above else base
        n0, n1 = strong[f]
        share[f] = (n1 + PSEUDO * prior) / (n0 + n1 + PSEUDO)
    return {f: math.log(s / (1 - s)) - even for f, s in share.items()}


def score(docs: DataFrame, model: Model, passages: bool = False) -> DataFrame:
    """doc_id, score, predicted for every document; with ``passages`` also its
    toxic passages (start and end character, score, expected number)."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches):
        m = given.value
        for batch in common.slices(batches, "text"):
            scores, spans = [], []
            for text in batch.column("text").to_pylist():
                found = m.passages(text or "")
                scores.append(m.probability(m.evidence(found)))
                if passages:
                    at = [x.span() for x in _WORD.finditer(text.lower())] if found else []
                    spans.append([{"start": at[a][0], "end": at[b - 1][1], "score": s, "expected": e}
                                  for a, b, s, e in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 *([pa.array(spans, kind)] if passages else [])],
                names=["doc_id", "score", "predicted", *(["passages"] if passages else [])])

    ddl = "doc_id long, score double, predicted int" + (
        ", passages array<struct<start:int,end:int,score:double,expected:double>>" if passages else "")
    return common.columns(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, ddl)
