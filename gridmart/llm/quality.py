"""Quality rules by weak supervision.

Every rule votes good (1), bad (-1) or abstains (0) on a document.  The rules'
accuracies are not given: expectation-maximisation over the votes estimates,
for each rule, how often it votes which way on good and on bad documents, and
the share of good documents.  A document's posterior probability of being good
replaces the usual demand that it passes every rule.

Documents are aggregated by their vote pattern first (at most 3 ** rules
patterns, whatever the corpus), so the estimation runs on a few hundred counts
while measuring, voting and scoring are DataFrame operations on all rows.  The
measures are taken once and kept in the shared folder.

The first round takes documents with a bad vote for probably bad, and Beta
pseudo-counts, a fixed share of the documents, hold the two classes to their
meaning, so neither a small table nor one without any bad document can swap
them.  An abstention says nothing.

Defined results: a null text counts as empty (no words, hence the base rules
fail); ties and repeated rows are scored one by one, copies alike; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Fixed values of the base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_upper (A-Z), n_marks (of ``!?``)."""
    def without(chars: str) -> Column:
        return F.length(F.translate("text", chars, ""))

    i64 = "long"
    base = common.columns(docs, {"doc_id": "long", "text": "string"}) \
        .withColumn("text", F.coalesce("text", F.lit("")))
    length = F.length("text")
    rows = base.select(
        "doc_id",
        F.array_remove(F.split("text", r"[ \t\n\x0B\f\r]+"), "").alias("words"),
        without(common.BLANKS).cast(i64).alias("word_chars"),
        (length - without(SYMBOLS)).cast(i64).alias("n_symbols"),
        (length - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast(i64).alias("n_upper"),
        (length - without("!?")).cast(i64).alias("n_marks"),
        F.filter(F.split("text", "\n"),
                 lambda s: F.length(F.btrim(s, F.lit(common.BLANKS))) > 0).alias("lines"))
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast(i64)) \
        .withColumn("n_words", F.size("words").cast("int")).drop("lines")
    return _repeats(rows).withColumn("n_words", F.col("n_words").cast(i64))


def _repeats(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words and drops ``words``.  Only texts that hold some
    window twice sort their windows; sorting puts equal ones side by side."""
    hashes = F.transform(F.sequence(F.lit(0), F.col("n_words") - WINDOW),
                         lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("grams", F.when(F.col("n_words") >= WINDOW, hashes)).drop("words")
    rows = rows.withColumn("grams", F.when(F.size(F.array_distinct("grams")) < F.size("grams"),
                                           F.col("grams")))
    rows = rows.withColumn("pairs", F.when(F.col("grams").isNotNull(), F.sort_array(
        F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("grams")

    def repeated(j: Column) -> Column:
        here = F.get("pairs", j)["h"]
        return F.coalesce(here == F.get("pairs", j - 1)["h"], F.lit(False)) | \
            F.coalesce(here == F.get("pairs", j + 1)["h"], F.lit(False))

    rows = rows.withColumn("starts", F.when(F.col("pairs").isNotNull(), F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("pairs") - 1), repeated),
        lambda j: F.get("pairs", j)["i"])))).drop("pairs")
    # each window adds the words beyond those of the window before it
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["at"])).alias("n"), x.alias("at")),
        lambda a: a["n"])
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts")


@dataclass(frozen=True)
class Rule:
    """Votes by a ratio of two measures: good up to ``good``, bad above
    ``bad``, else it abstains."""
    name: str
    over: str
    under: str
    good: float
    bad: float

    def vote(self) -> Column:
        x, n = F.col(self.over), F.col(self.under)
        return F.when(x > self.bad * n, -1).when(x <= self.good * n, 1).otherwise(0)


#: Each kind of defect is seen by more than one rule; estimation learns which
#: documents are bad from rules that agree.
RULES = (
    Rule("repeats", "n_repeat_words", "n_words", 0.03, 0.15),
    Rule("dup_lines", "n_dup_lines", "one", 0, 3),
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.10),
    Rule("symbol_chars", "n_symbols", "word_chars", 0.004, 0.02),
    Rule("many_symbols", "n_symbols", "n_words", 0.05, 0.20),
    Rule("upper", "n_upper", "word_chars", 0.10, 0.30),
    Rule("marks", "n_marks", "n_words", 0.05, 0.20),
    Rule("word_length", "word_chars", "n_words", 9, 14),
)


@dataclass
class Model:
    prior: float
    #: For each rule that votes, how often it votes good on good documents and
    #: how often it votes bad on bad ones: its accuracies.
    accuracy: list[tuple[float, float]]

    def log_odds(self, rule: int, vote: int) -> float:
        on_good, on_bad = self.accuracy[rule]
        if vote == 0:
            return 0.0
        return math.log(on_good / (1 - on_bad)) if vote > 0 else math.log((1 - on_good) / on_bad)

    def posterior(self, pattern: tuple[int, ...]) -> float:
        z = math.log(self.prior / (1 - self.prior)) + sum(self.log_odds(j, v) for j, v in enumerate(pattern))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


#: Fixed values of the estimation: the chance that a document is good before
#: the first round, without and with a bad vote; the accuracies and the share of
#: good documents that the pseudo-counts stand for (a bad document is expected
#: to fail few of the rules); the pseudo-counts as a share of the documents.
START = (0.95, 0.10)
PRIOR_ACCURACY, PRIOR_GOOD = (0.99, 0.30), 0.85
HOLD = 0.01


def estimate(counts: dict[tuple[int, ...], int], rules: int, rounds: int = 200) -> Model:
    """Expectation-maximisation over vote patterns and their row counts."""
    total = sum(counts.values())
    hold = HOLD * total + 1
    good = {p: START[min(p, default=0) < 0] for p in counts}
    model = Model(PRIOR_GOOD, [PRIOR_ACCURACY] * rules)
    for _ in range(rounds):
        accuracy = []
        for j in range(rules):
            right = [hold * PRIOR_GOOD * PRIOR_ACCURACY[0], hold * (1 - PRIOR_GOOD) * PRIOR_ACCURACY[1]]
            voted = [hold * PRIOR_GOOD, hold * (1 - PRIOR_GOOD)]
            for p, n in counts.items():
                if p[j]:
                    voted[0] += n * good[p]
                    voted[1] += n * (1 - good[p])
                    right[0] += n * good[p] * (p[j] > 0)
                    right[1] += n * (1 - good[p]) * (p[j] < 0)
            accuracy.append((right[0] / voted[0], right[1] / voted[1]))
        n_good = sum(n * good[p] for p, n in counts.items())
        old, model = model, Model((n_good + hold * PRIOR_GOOD) / (total + hold), accuracy)
        good = {p: model.posterior(p) for p in counts}
        if abs(old.prior - model.prior) + sum(
                abs(x - y) for a, b in zip(old.accuracy, accuracy) for x, y in zip(a, b)) < 1e-9:
            break
    return model


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The measures of every document, base_failed, posterior and kept."""
    rows = common.cut(measures(docs)).withColumn("one", F.lit(1))
    names = [f"vote_{r.name}" for r in rules]
    voted = rows.select("*", *[r.vote().alias(n) for r, n in zip(rules, names)])
    counts = {tuple(r[n] for n in names): r["rows"]
              for r in voted.groupBy(*names).agg(F.count("*").alias("rows")).collect()}
    model = estimate(counts, len(rules))
    z = F.lit(math.log(model.prior / (1 - model.prior)))
    for j, n in enumerate(names):
        z = z + F.when(F.col(n) > 0, model.log_odds(j, 1)).when(F.col(n) < 0, model.log_odds(j, -1)).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return voted.withColumn("base_failed", failed) \
        .withColumn("posterior", F.lit(1.0) / (F.lit(1.0) + F.exp(-z))) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", "posterior", *names)
